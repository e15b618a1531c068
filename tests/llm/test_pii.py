import random

from pyspark.sql import functions as F

from conftest import SF01
from helpers import base_spans, frame, joined, sha, written
from nextclick.llm import pii


def texts():
    random.seed(3)
    out = ["", None, "a@b.cc@d.ee", "a@b.c_d@e.ff x", "é a.b+c@d-e.f.g é 1.2.3.4.5.6.7.8 256.1.1.1.1", "4532015112830366 4532015112830366",
           "+1 (706) 555-3138 4532015112830366", "0001.02.3.255 1.2.3.999", "+12.34.56.78 x", "9" * 3000, "a@b.cc@d.ee"]
    out += ["".join(random.choice("0123456789.+- ()@a_é\n") for _ in range(200)) for _ in range(150)]
    parts = ["+1 (706) 555-3138", "a.b@c.de", "1.2.3.4", "4532015112830366", "4532-0151-1283-0366", "x"]
    return out + [" ".join(random.choice(parts) for _ in range(700))]


def test_base_spans_stay_and_split_runs_are_found(spark, tmp_path):
    docs = frame(spark, [(i, t, 1) for i, t in enumerate(texts())], "doc_id long, text string, found int")
    got = {r.doc_id: r for r in pii.op9_pii(spark, written(spark, tmp_path, "documents", docs)).collect()}
    for i, t in enumerate(texts()):
        base = base_spans(t or "")
        assert got[i].base_sha256 == sha(joined(base))
        assert [got[i].n_email, got[i].n_ip, got[i].n_card, got[i].n_phone] == [sum(s[0] == k for s in base) for k in pii.KINDS]
        assert set(joined(base).split(",")) <= set(got[i].spans.split(",") + [""])
    assert got[5].spans == "card:0:16,card:17:33" and got[6].spans == "card:18:34,phone:0:17"


def test_redaction(spark):
    docs = frame(spark, [(i, t, 0, "x") for i, t in enumerate(texts())], "doc_id long, text string, n_chars long, spans string")
    out = {r.doc_id: r for r in pii.pii_stage(spark, docs, "").collect()}
    assert out[2].text == "[EMAIL]@d.ee" and out[5].text == "[CARD] [CARD]" and out[0].text == "" and out[1].text == ""
    assert out[8].text == "[PHONE] x" and all(len(r.text) == r.n_chars for r in out.values())


def test_blocks_give_the_same_pieces(spark):
    text = "".join(random.choice("aé\n😀x") for _ in range(3 * pii.BLOCK))
    places = [(0, 0), (0, 1), (pii.BLOCK - 1, pii.BLOCK + 1), (pii.BLOCK, 3 * pii.BLOCK), (5, 700), (3 * pii.BLOCK, 3 * pii.BLOCK + 1), (3 * pii.BLOCK - 1, 3 * pii.BLOCK)]
    rows = frame(spark, [(text, a, b) for a, b in places], "t string, a int, b int")
    got = rows.select("a", "b", pii.cut(pii.blocks(F.col("t")), F.col("a"), F.col("b")).alias("piece")).collect()
    assert all(r.piece == text[r.a: r.b] for r in got)


def test_one_very_long_text(spark, tmp_path):
    text = " ".join(f"u{i}@m.org" + " and words without any" * 2 for i in range(20_000))
    docs = frame(spark, [(1, text, len(text))], "doc_id long, text string, n_chars long")
    row = pii.op9_pii(spark, written(spark, tmp_path, "documents", docs)).collect()[0]
    assert row.n_email == 20_000 and row.base_sha256 == sha(joined(base_spans(text)))
    assert pii.pii_stage(spark, docs, "").collect()[0].text == " ".join("[EMAIL]" + " and words without any" * 2 for _ in range(20_000))
    assert len(text) > 1_000_000


def test_without_candidates_or_rows(spark, tmp_path):
    docs = frame(spark, [(1, "no data"), (None, None)], "doc_id long, text string")
    rows = pii.op9_pii(spark, written(spark, tmp_path, "documents", docs)).collect()
    assert [r.spans for r in rows] == ["", ""] and rows[0].base_sha256 == sha("")
    assert pii.pii_stage(spark, docs.selectExpr("*", "0 as n_chars").limit(0), "").count() == 0


def test_decoys_of_the_table_are_left(spark):
    texts_ = {r.doc_id: r.text for r in spark.read.parquet(f"{SF01}/documents.parquet").collect()}
    for r in pii.op9_pii(spark, SF01).collect():
        assert r.base_sha256 == sha(joined(base_spans(texts_[r.doc_id])))
