import base64
import random

import pytest

from spoolwright.llm import encode

tiktoken = pytest.importorskip("tiktoken")


@pytest.fixture(scope="module")
def plain():
    public = pytest.importorskip("public_tokenizers")
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(encode.VOCABULARY, "rb"))}
    return tiktoken.Encoding("plain", pat_str=public.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_ids_and_round_trip(plain):
    rng = random.Random(1)
    signs = ["a", "B", " ", "  ", "\n", "\t", "\x1c", "\x85", "'s", "é", "日", "😀", "\u0301", "½", "²", "٣", "ß", "_", "\u200b", "\xa0", "<|endoftext|>", "don't", "'LL", "\x00", "\r\n", "the quick"]
    texts = ["".join(rng.choices(signs, k=rng.randint(0, 30))) for _ in range(5000)] + ["a" * 50_000, " " * 20_000, "", None, "x"]
    encoder = encode.Encoder()
    ids, sizes = encoder.encode(texts)
    at = 0
    for text, n in zip(texts, sizes.tolist()):
        own = ids[at : at + n].tolist()
        assert own == (plain.encode_ordinary(text) if text else []) and encode.decode(own) == (text or "")
        at += n
    assert encoder.count(texts).tolist() == sizes.tolist()


def test_starting_anew_changes_nothing(monkeypatch, plain):
    monkeypatch.setattr(encode, "KEPT", 10)
    encoder = encode.Encoder()
    for text in ("one two three four five six seven", "eight nine ten one two", "three four zebra"):
        assert encoder.encode([text])[0].tolist() == plain.encode_ordinary(text)
        assert len(encoder.seen) <= 30


def test_table(spark):
    df = spark.createDataFrame([(1, "hello world", "x"), (2, "", "x"), (3, None, "x"), (None, "a", "x"), (1, "hello world", "x")], "doc_id long, text string, ids string")
    got = sorted(((r.doc_id, list(r.ids)) for r in encode.encoded(df).collect()), key=str)
    assert [x for _, x in got if x] and {str(k): len(v) for k, v in got} == {"1": 2, "2": 0, "3": 0, "None": 1} and len(got) == 5
    assert {r.doc_id: r.tokens for r in encode.token_counts(df).collect()}[1] == 2
    assert encode.encoded(df.limit(0)).collect() == []
