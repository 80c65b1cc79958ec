import random

import numpy as np
import pytest

tokenizers = pytest.importorskip("tokenizers")

from tallymark.llm import bpe  # noqa: E402
from tallymark.llm.tokenise import token_counts, token_ids  # noqa: E402
from tests.conftest import DATA  # noqa: E402


@pytest.fixture(scope="module")
def reference():
    t = tokenizers.Tokenizer.from_file(bpe.default_vocabulary())
    t.encode_special_tokens = True
    return lambda texts: [x.ids for x in t.encode_batch(texts, add_special_tokens=False)]


@pytest.fixture
def encode():
    e = bpe.Encoder(bpe.default_vocabulary())

    def run(texts):
        parts = [t.encode() for t in texts]
        ids, ends = e.encode(np.frombuffer(b"".join(parts), np.uint8), np.cumsum([0, *map(len, parts)]))
        return [ids[a:b].tolist() for a, b in zip(ends, ends[1:])]

    run.encoder = e
    return run


CASES = [
    "", " ", "  a", "\n\n  x\n", "don't I'LL 're we've'll 'tis 's", "a's'", "'", "''s", " 's", "it's\n", " x 　y", "x\u0085y", "<|endoftext|> hi", "a" * 3000, " " * 1000 + "b",
    "é漢字かな 한국 ١٢٣ Ⅷ²", "\ufeffx", "\r\n\r\n", "👩‍💻 ok ✅", "tab\t\tx", "end  ", "'re", "x're", "'v", "'l", "abc" * 500, "ab " * 3, "\x00\x00a", "longer-than-eight-bytes longer-than-eight-bytex",
]


def test_cases(encode, reference):
    assert encode(CASES) == reference(CASES)


def test_every_character(encode, reference):
    texts = [f"a{chr(c)}b 1{chr(c)} {chr(c)}" for c in range(0x30000) if not 0xD800 <= c < 0xE000]
    assert encode(texts) == reference(texts)


@pytest.mark.parametrize("seed", range(3))
def test_random(encode, reference, seed):
    rnd = random.Random(seed)
    texts = ["".join(rnd.choice("  \n\t'''strevmldaA1.é漢²- ") for _ in range(rnd.randint(0, 40))) for _ in range(3000)]
    assert encode(texts) == reference(texts)


def test_equal_hashes_are_told_apart(encode, reference, monkeypatch):
    """All words of one length share a hash, as the first reading of their bytes gives nothing; the comparison reads them truly."""
    calls = []

    def weak(flat, begin, length):
        calls.append(1)
        first = len(calls) % 3 == 1
        return ((j, a, c * np.uint64(not first)) for j, a, c in real(flat, begin, length))

    monkeypatch.setattr(bpe.Encoder, "_chunks", staticmethod(weak))
    texts = ["abcdefghij abcdefghik bbcdefghij", "abcdefghij"]
    assert encode(texts) == reference(texts) and calls


real = bpe.Encoder._chunks


def test_forgetting_and_growth(encode, reference, monkeypatch):
    monkeypatch.setattr(bpe, "KNOWN_WORDS", 10)
    for i in range(4):
        texts = [" ".join(f"w{i}x{j}" for j in range(300))]
        assert encode(texts) == reference(texts)


def test_documents(spark, reference):
    df = spark.read.parquet(f"{DATA}/documents.parquet")
    got = {r.doc_id: r.ids for r in token_ids(df, ["doc_id"]).collect()}
    rows = df.select("doc_id", "text").collect()
    want = dict(zip([r.doc_id for r in rows], reference([r.text or "" for r in rows])))
    assert got == want
    counts = {r.doc_id: r.n_tokens for r in token_counts(df, ["doc_id"]).collect()}
    assert counts == {k: len(v) for k, v in want.items()}


def test_null_empty_long_repeated_and_clashing(spark, reference, monkeypatch):
    monkeypatch.setattr(bpe, "SLICE_BYTES", 100)
    rows = [(1, None, 5, "x"), (2, "", 5, "x"), (3, "long word " * 30_000, 5, None), (3, "a b", 5, "x"), (3, "a b", 5, "x"), (None, "c", 5, "x")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, ids int, _out string")
    got = token_ids(df, ["doc_id"]).collect()
    assert sorted((r.doc_id is None, r.doc_id, len(r.ids)) for r in got if r.doc_id) == [(False, 1, 0), (False, 2, 0), (False, 3, 2), (False, 3, 2), (False, 3, len(reference(["long word " * 30_000])[0]))]
    assert token_ids(df.limit(0), ["doc_id"]).count() == 0
