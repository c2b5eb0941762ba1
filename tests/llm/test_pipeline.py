import hashlib
import random

import corpus_pipeline as cp
from tariffa.llm import langid, pii
from test_decontaminate import brute as overlaps
from test_minhash import brute as groups


def test_stages_one_by_one(spark, tmp_path):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    extra = spark.createDataFrame([(9001, None, "en", "x", 0), (9002, "1234 !!", "en", "x", 7), (9003, "", None, None, 0), (None, "Clean words of a text", None, None, None)], docs.schema)
    docs = docs.unionByName(extra)
    columns, given = docs.columns, {}
    for name, stage in cp.STAGES:
        given[name] = {r.doc_id: r for r in docs.collect()}
        docs = stage(spark, docs, sf)
        if name != "byte_bpe":
            assert docs.columns == columns
        docs.write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
    last = {r.doc_id: r for r in docs.collect()}
    a, b, c, d, e = (given[name] for name, _ in cp.STAGES)
    assert set(a) - set(b) == {9001, 9002, 9003}
    named = lambda r: {k: v for k, v in r.asDict().items() if k != "lang"}
    assert all(named(b[i]) == named(a[i]) and b[i].lang in ("de", "en", "es", "fr") and c.get(i, b[i]) == b[i] for i in b)
    assert set(c) - {None} == {g for _, _, _, g, _ in groups([(i, r.text) for i, r in b.items()])}
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    hit = {i for i, _, _ in overlaps([(i, r.text) for i, r in c.items()], items, 5)}
    assert hit == set(c) - set(d)
    assert all(e[i].text == pii.masked(r.text, pii.find_spans(r.text)) for i, r in d.items()) and set(e) == set(d)
    assert {i: r.decoded_sha256 for i, r in last.items()} == {i: hashlib.sha256(r.text.encode()).hexdigest() for i, r in e.items()}
    assert None in last


def test_junk_with_a_language_goes(spark):
    rng = random.Random(3)
    made = lambda alphabet: " ".join("".join(rng.choice(alphabet) for _ in range(rng.randrange(3, 9))) for _ in range(300))
    junk = [made("bcdfghjklmnpqrstvwxz") for _ in range(5)] + [made("αβγδεζηθικλμνξοπρστυφχψω")]  # the last is alone under its label
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    extra = [(9100 + i, t, "en" if i < 5 else "qq", "x", len(t)) for i, t in enumerate(junk)] + [(9110, junk[0], "en", "x", len(junk[0]))]
    kept = {r.doc_id for r in cp.identify(spark, docs.unionByName(spark.createDataFrame(extra, docs.schema)), "").collect()}
    assert {r.doc_id for r in docs.collect()} - kept == set()
    assert kept & {r[0] for r in extra} == set()


def test_run(spark):
    rows = cp.run(spark, "/root/testdata/sf0.001")
    assert rows.columns == ["doc_id", "lang", "source", "n_tokens", "ids_sha256", "decoded_sha256"]
    assert 0 < rows.count() <= 200


def test_odd_tables(spark, tmp_path):
    """Repeated, tied, long and null rows, clashing columns, an empty table, and a run that goes on."""
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").limit(60)
    first = docs.first()
    more = [(first.doc_id, first.text, first.lang, first.source, 1), (9001, first.text, None, None, None), (9002, first.text + " end", "en", "x", 2), (9003, "again and again " * 30000, "en", "x", 3), (None, first.text, None, None, None), (9004, None, None, None, None)]
    docs = docs.unionByName(spark.createDataFrame(more, docs.schema)).withColumn("score", langid.F.lit("own")).withColumn("digest", langid.F.lit(7)).withColumn("rejected", langid.F.lit("r"))
    for name, given in (("some", docs), ("none", docs.limit(0))):
        folder = tmp_path / name
        given.write.parquet(str(folder / "documents.parquet"))
        spark.createDataFrame([(1, "no such passage of a benchmark stands in any of these texts at all today")], "item_id long, text string").write.parquet(str(folder / "benchmark.parquet"))
        now = spark.read.parquet(str(folder / "documents.parquet"))
        for stage_name, stage in cp.STAGES[:-1]:
            now = stage(spark, now, str(folder))
            assert now.columns == docs.columns, stage_name
            assert {(r.score, r.digest, r.rejected) for r in now.collect()} <= {("own", 7, "r")}
        rows = cp.run(spark, str(folder), f"{name}-{tmp_path.name}").collect()
        if name == "none":
            assert rows == []
            continue
        ids = [r.doc_id for r in rows]
        assert len(ids) == len(set(ids)) and None in ids and 9003 in ids and 9004 not in ids
        assert sum(i in (first.doc_id, 9001, 9002) for i in ids) == 1
        again = cp.run(spark, str(folder), f"{name}-{tmp_path.name}").collect()  # every stage is there
        assert sorted(map(str, again)) == sorted(map(str, rows))
