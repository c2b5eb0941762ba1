import gc
import hashlib
import random

import pyarrow as pa
import pytest
import tiktoken

from tariffa.llm import bpe


def codec(spark):
    path, pattern = bpe.vocabulary()
    ranks = bpe.read_ranks(spark, path)
    return bpe.ByteBPE(ranks, pattern), tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def test_equals_tiktoken(spark):
    own, theirs = codec(spark)
    rng = random.Random(3)
    alphabets = ["etaoinshr", "abcdefghijklmnopqrstuvwxyz ABC", "éèüßñ straße", "0123456789.,-+ ", "日本語 한국어 русский", "\n\t   !?*#&", "🙂👩‍👩‍👧 a"]
    texts = ["", "<|endoftext|> don't we'll", "a" * 3000, " " * 500] + ["".join(rng.choice(a) for _ in range(rng.randrange(1, 400))) for a in alphabets for _ in range(80)]
    for t in texts:
        ids = own.encode(t)
        assert list(memoryview(ids).cast("I")) == theirs.encode_ordinary(t)
        assert own.decode(ids) == t.encode()


def test_pairs_take_no_merges(spark):
    """New pairs of tokens are judged by the splits of the vocabulary; the merges of their bytes took a third of the time."""
    own, theirs = codec(spark)
    rng = random.Random(5)
    tokens = list(own.rank)
    for a, b in [(rng.choice(tokens), rng.choice(tokens)) for _ in range(3000)] + [(t, t) for t in tokens[:1500]]:
        assert own.stay(own.rank[a], own.rank[b]) == (own.merge(a + b) == [a, b])

    def merge(*_):
        raise AssertionError("merged")

    own.merge = merge
    for t in ["".join(rng.choice("  aehtnéß") for _ in range(200)) for _ in range(50)]:
        assert list(memoryview(own.encode(t)).cast("I")) == theirs.encode_ordinary(t)


def test_any_vocabulary():
    """Also one with a token that ranks before its parts, or one that no merges make."""
    pattern = bpe.vocabulary()[1]
    seen = set()
    for seed in range(40):
        rng = random.Random(seed)
        tokens = [b"a", b"b", b"c"]
        while len(tokens) < 25:
            tokens.append(t) if (t := rng.choice(tokens) + rng.choice(tokens)) not in tokens else None
        ids = list(range(256, 278))
        if seed % 2:
            rng.shuffle(ids)
        ranks = {bytes([i]): i for i in range(256)} | dict(zip(tokens[3:], ids, strict=True)) | {b"xyz": 300}
        own, theirs = bpe.ByteBPE(ranks, pattern), tiktoken.Encoding("any", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        seen.add(own.ordered)
        for t in ["".join(rng.choice("aabbccxyz") for _ in range(rng.randrange(1, 60))) for _ in range(40)] + ["xyz"]:
            assert list(memoryview(own.encode(t)).cast("I")) == theirs.encode_ordinary(t)
    assert seen == {True, False}
    lacks_z = bpe.ByteBPE({bytes([i]): i for i in range(256) if i != ord("z")} | {b"yz": 256, b"xyz": 257}, pattern)
    assert [list(memoryview(lacks_z.encode(t)).cast("I")) for t in ("yz", "xyz", "yyz", "a xyz")] == [[256], [257], [121, 256], [97, 32, 257]]
    with pytest.raises(ValueError):
        lacks_z.encode("zy")


def test_query_rows(spark):
    path, pattern = bpe.vocabulary()
    _, theirs = codec(spark)
    rows = [(1, "Hello there", "x"), (2, None, "y"), (3, "", None), (3, "", None), (None, "Größe " * 5000, "z")]
    df = spark.createDataFrame(rows, "doc_id long, text string, ids_sha256 string")
    got = sorted(bpe.tokenise(df, path, pattern).collect(), key=str)
    want = sorted(((i, len(x := theirs.encode_ordinary(t or "")), hashlib.sha256(b"".join(n.to_bytes(4, "little") for n in x)).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()) for i, t, _ in rows), key=lambda r: str(r))
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)
    assert bpe.tokenise(df.limit(0), path, pattern).count() == 0


def test_query_on_documents(spark):
    _, theirs = codec(spark)
    sf = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    for r in bpe.op3_byte_bpe(spark, sf).collect():
        assert r.n_tokens == len(theirs.encode_ordinary(texts[r.doc_id]))


def test_workers_keep_no_codec(spark):
    """A worker's codec goes when its next task needs no vocabulary."""

    def held(batches):
        n = sum(type(x).__name__ == "ByteBPE" for x in gc.get_objects())
        for _ in batches:
            yield pa.RecordBatch.from_arrays([pa.array([n])], ["n"])

    path, pattern = bpe.vocabulary()
    texts = spark.range(0, 64, numPartitions=16).selectExpr("id as doc_id", "concat('some words of text ', id) as text")
    assert bpe.tokenise(texts, path, pattern).count() == 64
    assert {r.n for r in spark.range(0, 64, numPartitions=16).mapInArrow(held, "n long").collect()} == {0}
