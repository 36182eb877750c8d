"""Encoding and decoding against the tokenizers library."""

import hashlib
import random

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from aerolake.llm.bpe_codec import Codec, _grouped, encoded
from aerolake.llm.bpe_counts import PieceCounter
from aerolake.llm.register import queries
from conftest import SF_SMALL

VOCABULARY = public_tokenizers.path("word_bpe_49k.json")
SCHEMA = "doc_id long, text string, ids array<int>, id string, decoded string"


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(VOCABULARY)


@pytest.fixture(scope="module")
def codec():
    return Codec(VOCABULARY)


def odd_texts(n):
    rng = random.Random(8)
    points = [c for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    out = []
    for _ in range(n):
        some = rng.choice(["aab'sre", "aΣσ éß'sİnt 12 ̇́", "x y<|endoftext|><|startoftext|></w>\t\n"])
        out.append("".join(chr(rng.choice(points)) if rng.random() < 0.3 else rng.choice(some) for _ in range(rng.randrange(1, 40))))
    return out + ["", " \n", "a" * 500, "ab" * 3000, "<|endoftext|>", "x<|endoftext|>y<|startoftext|>", "a</w>", "ꟋꟜ", "a֋a \U00018da1b"]


def test_odd_texts_match_the_library(library, codec):
    texts = odd_texts(4000)
    got = codec.encode_all(texts)
    want = [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
    assert got == want
    assert [codec.decode(x) for x in got] == [library.decode(x, skip_special_tokens=False) for x in want]
    counter = PieceCounter(VOCABULARY)
    assert [counter.count(t) for t in texts] == [len(x) for x in want]


def test_verification_tells_right_proposals_from_wrong_ones(codec):
    rng = random.Random(4)
    letters = "aabcdeeghilmnoorstu"
    pieces = sorted({"".join(rng.choice(letters) for _ in range(rng.randrange(1, 14))) for _ in range(4000)})
    data = [p.encode() for p in pieces]
    ids, owner = codec.proposed(data)
    exact = [codec.merged(d) for d in data]
    right = [a == b for a, b in zip(_grouped(ids, owner, len(data)), exact)]
    assert codec.verified(ids, owner, len(data)).tolist() == right and 0.1 < sum(right) / len(right) < 0.95
    assert codec.merged_together(data) == exact


def test_merges_out_of_order_are_merged_exactly(tmp_path):
    import json

    with open(VOCABULARY, encoding="utf-8") as file:
        spec = json.load(file)
    spec["model"]["merges"] = spec["model"]["merges"][::-1]
    path = tmp_path / "v.json"
    path.write_text(json.dumps(spec))
    texts = ["the quick brown foxes", "international understanding"]
    want = [e.ids for e in Tokenizer.from_file(str(path)).encode_batch(texts, add_special_tokens=False)]
    assert Codec(str(path)).encode_all(texts) == want


def test_documents_match_the_library(spark, library):
    rows = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()
    want = {}
    for r, e in zip(rows, library.encode_batch([r.text or "" for r in rows], add_special_tokens=False)):
        decoded = library.decode(e.ids, skip_special_tokens=False)
        want[r.doc_id] = (len(e.ids), *(hashlib.sha256(x.encode()).hexdigest() for x in (" ".join(map(str, e.ids)), decoded)))
    got = queries()["op12_bpe_codec"](spark, SF_SMALL).collect()
    assert {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in got} == want and len(got) == len(want)


def test_odd_tables(spark, library):
    long = "the longest of texts, " * 100_000
    rows = [(1, None, [7], "x", "y"), (2, "", [7], "x", "y"), (None, "ab c", [7], "x", "y"), (3, "ab c", [7], "x", "y"), (3, "ab c", [7], "x", "y"), (4, long, None, None, None)]
    got = encoded(spark.createDataFrame(rows, SCHEMA), VOCABULARY).collect()
    n = len("ab</w> c</w>")
    assert sorted((r.doc_id or 0, len(r.ids), len(r.decoded)) for r in got if r.doc_id != 4) == [(0, 2, n), (1, 0, 0), (2, 0, 0), (3, 2, n), (3, 2, n)]
    assert next(r.ids for r in got if r.doc_id == 4) == library.encode(long, add_special_tokens=False).ids
    empty = encoded(spark.createDataFrame([], SCHEMA), VOCABULARY)
    assert empty.columns == ["doc_id", "ids", "decoded"] and empty.count() == 0
