import zlib
from collections import defaultdict

import numpy as np

from tariffa.llm import sharding as sh


def test_curve_is_a_hilbert_curve():
    for dims, bits in ((2, 4), (3, 3)):
        axes = np.meshgrid(*[np.arange(1 << bits)] * dims, indexing="ij")
        points = np.stack([a.ravel() for a in axes], 1)
        place = sh.hilbert_index(points, bits)
        assert sorted(place) == list(range(len(points)))
        steps = np.abs(np.diff(points[np.argsort(place)], axis=0)).sum(axis=1)
        assert (steps == 1).all()  # each step goes to a neighbour


def check(rows, texts):
    assert sorted(str(r.doc_id) for r in rows) == sorted(str(i) for i, _ in texts)
    slots, want = defaultdict(list), defaultdict(list)
    for i, t in texts:
        want[i].append((len((t or "").encode()) + 16, zlib.crc32((t or "").encode())))
    got = defaultdict(list)
    for r in rows:
        slots[r.shard].append(r.slot)
        got[r.doc_id].append((r.size, r.text_crc32))
        assert r.law == "rows" and r.grown_shard is None and 0 <= r.shard < sh.SHARDS
    assert {k: sorted(v) for k, v in got.items()} == {k: sorted(v) for k, v in want.items()}
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())
    counts = [len(slots[s]) for s in range(sh.SHARDS)]
    assert max(counts) - min(counts) <= 1
    order = sorted(rows, key=lambda r: (r.shard, r.slot))
    assert all(a.hilbert <= b.hilbert for a, b in zip(order, order[1:], strict=False))


def test_rows(spark):
    rows = [(i, f"text {i % 7}" * (i % 50), f"src{i % 3}", ["en", "de", None][i % 3]) for i in range(201)] + [(None, None, None, None), (3, "é" * 60000, "z", "fr"), (3, "é", "z", "fr"), (9, "", "src1", "en"), (9, "", "src1", "en")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string").withColumn("shard", sh.F.lit("clash"))
    check(sh.sharded(df).collect(), [(r[0], r[1]) for r in rows])
    assert sh.sharded(df.limit(0)).count() == 0
    one = sh.sharded(df.limit(1)).collect()
    assert [(r.shard, r.slot) for r in one] == [(0, 0)]


def test_query(spark):
    sf = "/root/testdata/sf0.01"
    rows = spark.read.parquet(f"{sf}/documents.parquet").collect()
    check(sh.op6_hilbert_shards(spark, sf).collect(), [(r.doc_id, r.text) for r in rows])


def test_written_shards(spark, tmp_path):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    sh.write_shards(docs, str(tmp_path / "out"))
    back = spark.read.parquet(str(tmp_path / "out"))
    assert back.count() == docs.count() and back.select("shard").distinct().count() == sh.SHARDS


def test_bins_come_from_whole_values(spark):
    prefix = "https://site.org/a/very/long/shared/path/"
    names = [prefix + x for x in "abcdefgh"] + ["日本", "日記", "語"]
    df = spark.createDataFrame([(n,) for n in names for _ in range(3)] + [(None,)] * 5, "v string")
    assert len(sh.boundaries(df, "v", 4)) == 3
    assert set(sh.boundaries(df, "v", 64)) >= set(sorted(names)[1:])  # each value a bin of its own, however long a prefix they share
    numbers = spark.range(1000).selectExpr("id as v")
    got = sh.boundaries(numbers, "v", 4)
    assert len(got) == 3 and all(abs(x - y) <= 1 for x, y in zip(got, (250, 500, 750), strict=True))
    assert sh.boundaries(df.limit(0), "v", 4) == []


def test_shards_prune(spark):
    rows = [(i, "w" * (i * 37 % 2000), f"{'https://one.org/shared/prefix/'}{i % 20:02d}", ["en", "de", "fr", "es"][i // 20 % 4]) for i in range(4000)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string")
    placed = sh.sharded(df).select("doc_id", "shard").join(df, "doc_id")
    opened = placed.groupBy("source").agg(sh.F.count_distinct("shard").alias("n")).agg(sh.F.avg("n")).first()[0]
    both = placed.groupBy("source", "lang").agg(sh.F.count_distinct("shard").alias("n")).agg(sh.F.avg("n")).first()[0]
    # a filter on a source opens under a third of the shards, one on source and language under a fifth (texts of all sizes)
    assert opened < sh.SHARDS / 3 and both < sh.SHARDS / 5, (opened, both)
