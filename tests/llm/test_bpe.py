import base64
import hashlib
import random

import pytest
import tiktoken
from public_tokenizers import PATTERN, path

from helpers import frame
from nextclick.llm import bpe


@pytest.fixture(scope="module")
def reference():
    with open(path(bpe.RANKS), "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def expected(reference, text):
    ids = reference.encode_ordinary(text)
    return len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(text.encode()).hexdigest()


def texts():
    random.seed(1)
    return ["", None, "a" * 5000, " " * 3000 + "x", "don't we'll 'r" + "e x'll " * 700, "word " * 999, "x", "x", "<|endoftext|>",
            "\n".join("ab  c\t\n 12 345" * 50 for _ in range(9)), "日本語テキスト" * 600, "".join(random.choice("ab 'rel\n\t1é😀.") for _ in range(9000))]


@pytest.mark.parametrize("chunk, overlap", [(1000, 64), (50, 8), (32_768, 1_024)])
def test_ids_equal_the_library_for_any_chunking(spark, reference, chunk, overlap):
    docs = frame(spark, [(i, t, "z") for i, t in enumerate(texts())], "doc_id long, text string, ids string")
    got = {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in bpe.encode(docs, ["doc_id"], chunk=chunk, overlap=overlap).collect()}
    assert got == {i: expected(reference, t or "") for i, t in enumerate(texts())}


def test_round_trip_and_empty(spark):
    docs = frame(spark, [(i, t) for i, t in enumerate(texts())], "doc_id long, text string")
    rows = bpe.encode(docs, ["doc_id"], chunk=100, overlap=20, keep_ids=True).select("doc_id", bpe.decode().alias("b")).collect()
    assert {r.doc_id: bytes(r.b).decode() for r in rows} == {i: t or "" for i, t in enumerate(texts())}
    assert bpe.encode(docs.limit(0), ["doc_id"]).count() == 0


def test_repeated_and_null_ids_stay_rows(spark):
    docs = frame(spark, [(None, "a b"), (None, "c" * 300), (7, "a b"), (7, "a b")], "doc_id long, text string")
    rows = bpe.encode(docs, ["doc_id"], chunk=50, overlap=8).collect()
    assert len(rows) == 4 and sum(r.doc_id is None for r in rows) == 2


def test_pre_tokens_of_odd_characters(reference):
    coding = bpe.coder(path(bpe.RANKS), PATTERN)
    for point in [*range(0x300), *range(0x1680, 0x1690), *range(0x180A, 0x1810), *range(0x2000, 0x2070), 0x3000, 0xFEFF, *range(0x1F600, 0x1F610), 0x10FFFF]:
        text = f"a{chr(point)} {chr(point)}1 {chr(point)}{chr(point)}b\n{chr(point)}"
        assert [i for piece in coding.pieces(text)[1] for i in piece] == reference.encode_ordinary(text)
