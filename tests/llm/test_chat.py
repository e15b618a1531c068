import pytest

from conftest import SF001
from helpers import frame, sha, written
from nextclick.llm import chat
from nextclick.llm.chat import F
from oracle_harness import compare, duck

TURNS = [[("user", "a<|b<\\|c<\\\\|"), ("assistant", "<|im_start|>x"), ("assistant", ""), ("we%ird\nrole<|", "<"), ("assistant", "é<|im_end|>\n")],
         [], [("assistant", "x")], [("user", chat.PROBE), ("assistant", chat.PROBE)], [("tool", "<" * 50 + "|" * 50)] * 300]


def test_round_trip_and_mask(spark):
    records = frame(spark, [(i, t) for i, t in enumerate(TURNS)], "id int, messages array<struct<role:string,content:string>>")
    out = chat.to_turns(records, ("id",)).withColumn("f", chat.format_turns(F.col("turns"))).withColumn("b", chat.read_back(F.col("f")))
    for r in out.collect():
        assert [tuple(t) for t in r.b.turns] == TURNS[r.id]
        assert [x for x, (role, _) in zip(r.b.learnt, TURNS[r.id], strict=True) if role == "assistant"] == [t for role, t in TURNS[r.id] if role == "assistant"]
        assert all(x == "" for x, (role, _) in zip(r.b.learnt, TURNS[r.id], strict=True) if role != "assistant")
        assert r.f.text.count(chat.START) == r.f.text.count(chat.END) == len(TURNS[r.id])


def test_layouts_by_fingerprint(spark):
    ddl = ("id int, prompt string, completion string, instruction string, input string, output string, "
           "conversations array<struct<from:string,value:string>>, data struct<prompt:string,completion:string>")
    rows = [(1, "p", "c", None, None, None, None, None), (2, None, None, "i", "n", "o", None, None), (3, None, None, "i", None, "o", None, None),
            (4, None, None, None, None, None, [("human", "q"), ("gpt", None), ("other", "z")], None), (5, "p", None, None, None, None, None, None),
            (6, None, None, None, None, None, None, ("p", "c")), (7, *[None] * 7)]
    out = {r.id: (r.layout, r.turns and [tuple(t) for t in r.turns]) for r in chat.to_turns(frame(spark, rows, ddl), ("id",)).collect()}
    assert out[1] == ("prompt", [("user", "p"), ("assistant", "c")])
    assert out[2] == ("instruction", [("user", "i\n\nn"), ("assistant", "o")])
    assert out[3] == ("instruction", [("user", "i"), ("assistant", "o")])
    assert out[4] == ("conversations", [("user", "q"), ("assistant", ""), ("other", "z")])
    assert out[5] == (None, None)
    assert out[6] == ("nested_prompt", [("user", "p"), ("assistant", "c")])
    assert out[7] == ("empty", [])


def test_query_against_sql(spark):
    assert compare(spark, duck(SF001), "op5_chat_format", chat.op5_chat_format, chat.OP5_SQL, SF001)


def test_nulls_ties_and_empty_table(spark, tmp_path):
    rows = frame(spark, [(1, 0, "user", None, 5), (1, 0, "assistant", "b", 5), (1, None, None, "c", 5), (None, 1, "assistant", "d", 5), (1, 0, "user", None, 5)],
                 "conv_id long, turn long, role string, text string, n_turns int")
    got = {r.conv_id: r for r in chat.op5_chat_format(spark, written(spark, tmp_path, "conversations", rows)).collect()}
    assert (got[1].n_turns, got[1].turns_sha256) == (4, sha("\nc\nassistant\nb\nuser\n\nuser\n\n"))
    assert (got[None].loss_chars, got[None].loss_sha256) == (1, sha("d"))
    assert got[-1].loss_sha256 == sha(chat.PROBE)
    empty = tmp_path / "empty"
    assert chat.op5_chat_format(spark, written(spark, empty, "conversations", rows.limit(0))).count() == 1


@pytest.mark.parametrize("text", ["<|", "<\\|", "<\\\\|", "\\<|", "<|im_end|>", "", "<<||"])
def test_escape_is_reversible(spark, text):
    row = spark.range(1).select(chat.escape(F.lit(text)).alias("e"), chat.unescape(chat.escape(F.lit(text))).alias("u")).first()
    assert row.u == text and "<|" not in row.e
