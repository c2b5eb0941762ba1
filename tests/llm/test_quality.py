import math
import random
import zlib
from collections import defaultdict

import pyarrow as pa
import pytest
from pyspark.sql import Row

from tariffa.llm import quality as q


def brute(rows, base):
    """Posteriors from plain sums; rows: (doc_id, host, path, evidence)."""
    own = lambda e: 1 / (1 + math.exp(-(e + base)))
    hosts, paths = defaultdict(list), defaultdict(list)
    for _, h, p, e in rows:
        hosts[h].append(own(e))
        paths[h, p].append(own(e))
    rate = (sum(map(sum, hosts.values())) + 0.5) / (len(rows) + 1)

    def strength(sites):
        n = sum(len(v) for v, _ in sites)
        spread = sum(len(v) * (sum(v) / len(v) - p) ** 2 for v, p in sites)
        between = (spread - sum(p * (1 - p) for _, p in sites)) / n
        level = sum(len(v) * p * (1 - p) for v, p in sites) / n
        return max(q.LEAST, level / between - 1) if between > 0 else math.inf

    def shrunk(good, n, m, prior):
        return prior if math.isinf(m) else (good + m * prior) / (n + m)

    m = strength([(v, rate) for v in hosts.values()])
    whole = {h: shrunk(sum(v), len(v), m, rate) for h, v in hosts.items()}
    k = strength([(v, whole[h]) for (h, _), v in paths.items()])
    out = []
    for d, h, p, e in rows:
        own = 1 / (1 + math.exp(-(e + base)))
        a, b = hosts[h], paths[h, p]
        r = shrunk(sum(a) - own, len(a) - 1, m, rate)
        x = shrunk(sum(b) - own, len(b) - 1, k, r)
        out.append((d, h, p, e, r, x, 1 / (1 + math.exp(-(math.log(x / (1 - x)) + e)))))
    return out


def test_posteriors_equal_plain_sums(spark):
    rng = random.Random(6)
    rows = [(i, h := rng.choice(["a", "a", "a", "b", "c", None]), rng.choice(["x", "y", None]), rng.gauss(2 if h == "a" else -1, 2)) for i in range(400)] + [(1000, "rare", "z", -1.0), (1000, "rare", "z", -1.0)]
    got = q.posteriors(spark.createDataFrame(rows, "doc_id long, host string, path string, evidence double"), 0.4).collect()
    want = brute(rows, 0.4)
    key = lambda r: (str(r[0]), r[3])
    for a, b in zip(sorted(map(tuple, got), key=key), sorted(want, key=key), strict=True):
        assert a[:3] == b[:3] and a[3:] == pytest.approx(b[3:])


def test_strength_has_no_upper_bound(spark):
    # sites alike: rates are their prior's; sites that differ a little: a prior worth more than 10,000 documents
    alike = q.posteriors(spark.createDataFrame([(i, "ab"[i % 2], "x", 0.0) for i in range(60)], "doc_id long, host string, path string, evidence double"), 0.0).collect()
    assert {(r.host_rate, r.path_rate) for r in alike} == {((30 + 0.5) / 61,) * 2}
    assert q._strength(Row(n=10.0, spread=3.0001, drawn=3.0, level=2.5)) == pytest.approx(24999.0)
    assert q._strength(Row(n=10.0, spread=9.0, drawn=1.0, level=2.5)) == q.LEAST
    far = q.posteriors(spark.createDataFrame([(1, "a", "x", 30.0), (2, "a", "x", -30.0), (3, "b", "y", 30.0)], "doc_id long, host string, path string, evidence double"), 0.0).collect()
    assert [r.score > 0.5 for r in sorted(far)] == [True, False, True] and all(0 < r.path_rate < 1 for r in far)


def test_rows(spark):
    docs = spark.createDataFrame([(1, "good words here", "h", "p"), (1, "good words here", "h", "p"), (2, None, None, None), (3, "", "h", None), (None, "bad bad", "h", "p"), (4, "bad junk " * 30000, "g", "p")], "doc_id long, text string, source string, lang string").withColumn("score", q.F.lit("clash"))
    labels = spark.createDataFrame([(1, 1, 0), (4, 0, None), (3, None, 1), (None, 1, 1), (2, 1, 0), (2, 0, 0)], "doc_id long, quality int, toxic int")
    for given in (labels, labels.limit(0), labels.where("quality = 1")):
        rows = q.scored(docs, q.fitted(docs, given)).collect()
        assert len(rows) == 6 and all(0 < r.score < 1 for r in rows)
    got = {r.doc_id: r.score for r in q.scored(docs, q.fitted(docs, labels)).collect()}
    assert got[1] > got[4]
    assert q.scored(docs.limit(0), q.fitted(docs.limit(0), labels)).count() == 0


def test_held_out_labels(spark):
    sf = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    held = q.F.pmod(q.F.crc32(q.F.col("doc_id").cast("string").cast("binary")), q.F.lit(4)) == 2
    model = q.fitted(docs, labels.where(~held))
    score = {r.doc_id: r.score for r in q.scored(docs, model).collect()}
    truth = [(r.doc_id, r.quality == 1 and r.toxic != 1) for r in labels.collect() if zlib.crc32(str(r.doc_id).encode()) % 4 == 2]
    right = sum((score[d] >= 0.5) == t for d, t in truth) / len(truth)
    assert right > 0.85, right


def test_query_equals_plain_sums(spark):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    model = q.fitted(docs, spark.read.parquet(f"{sf}/labels.parquet"))
    rows = [(r.doc_id, r.source, r.lang, float(model.evidence(pa.array([r.text]))[0])) for r in docs.collect()]
    want = {r[0]: r for r in brute(rows, model.base)}
    got = q.op10_site_quality(spark, sf).collect()
    assert len(got) == len(rows) and sum(r.keep for r in got) > 100
    for r in got:
        assert (r.host, r.path) == want[r.doc_id][1:3] and (r.evidence, r.host_rate, r.path_rate, r.score) == pytest.approx(want[r.doc_id][3:], rel=1e-6)
        assert r.keep == (r.score >= 0.5)


def test_sites_of_urls(spark):
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    host, path = q.site_of(q.F.col("url"))
    docs = pages.select(q.F.col("page_id").alias("doc_id"), q.F.col("html").alias("text"), host.alias("h"), path.alias("p"))
    model = q.fitted(docs.limit(0), spark.createDataFrame([], "doc_id long, quality int, toxic int"))
    rows = q.scored(docs, model, "h", "p").collect()
    assert len(rows) == pages.count() and all(r.host and r.path.startswith("/") for r in rows)
    cases = spark.createDataFrame([("https://www.A.org/x/y?z",), ("a.org",), (None,)], "url string").select(*q.site_of(q.F.col("url"))).collect()
    assert [tuple(r) for r in cases] == [("a.org", "/x"), ("a.org", "/"), (None, None)]
