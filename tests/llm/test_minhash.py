import hashlib
import random
from collections import Counter, defaultdict

from tariffa.llm import common
from tariffa.llm import minhash as mh
from tariffa.llm.components import components


def shingles(text):
    w = (text or "").lower().split()
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def brute(rows):
    """doc rows to (class, copies, group, links)."""
    rows = [(i, t or "") for i, t in rows if i is not None]
    classes = defaultdict(list)
    for i, t in rows:
        classes[t].append(i)
    texts = sorted(classes, key=lambda t: min(classes[t]))
    sets = [shingles(t) for t in texts]
    up = list(range(len(texts)))

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    inverted = defaultdict(list)
    for k, s in enumerate(sets):
        for g in s:
            inverted[g].append(k)
    common = Counter((a, b) for v in inverted.values() for i, a in enumerate(v) for b in v[i + 1 :])
    links = Counter()
    for (a, b), n in common.items():
        if n >= 0.8 * (len(sets[a]) + len(sets[b]) - n):
            links.update((a, b))
            a, b = find(a), find(b)
            up[max(a, b)] = min(a, b)
    of = {t: (min(classes[t]), len(classes[t]), min(classes[texts[find(k)]]), links[k]) for k, t in enumerate(texts)}
    return sorted((i, *of[t]) for i, t in rows)


def case():
    rng = random.Random(4)
    word = lambda: rng.choice("abcdefghijklmnop") * rng.randrange(1, 9)
    rows = [(0, None), (1, ""), (2, "  "), (3, "a b"), (4, "A  b"), (5, "a b"), (6, "x"), (None, "a b"), (None, None)]
    n = 10
    for size in (3, 40, 90):
        base = [word() for _ in range(120)]
        for _ in range(size):
            w = list(base)
            for _ in range(rng.randrange(5)):
                w[rng.randrange(120)] = word()
            rows.append((n, " ".join(w)))
            n += 1
            if rng.random() < 0.3:
                rows.append((n, rows[-1][1]))
                n += 1
    rows += [(n + k, " ".join(word() for _ in range(rng.randrange(1, 300)))) for k in range(60)]
    return [*rows, (12, "a b"), rows[20], (5000, "long " * 20000 + "end")]


def test_equals_brute_force(spark):
    rows = case()
    df = spark.createDataFrame([(i, t, k) for k, (i, t) in enumerate(rows)], "doc_id long, text string, class_id long").withColumn("digest", mh.F.lit("clash"))
    want = brute(rows)
    for blocks in ({}, {"block_docs": 16}):
        got = sorted((r.doc_id, r.class_id, r.n_copies, r.group_id, r.n_links) for r in mh.joined(df, **blocks).collect())
        assert got == want
    kept = mh.one_of_each_group(df)
    assert kept.columns == df.columns
    ids = sorted(r.doc_id for r in kept.collect() if r.doc_id is not None)
    assert ids == sorted({g for _, _, _, g, _ in want})
    assert kept.where("doc_id is null").count() == 2
    assert mh.joined(df.limit(0)).count() == 0
    assert mh.one_of_each_group(df.limit(0)).count() == 0


def test_bands():
    n = mh.bands_for(0.8, 0.9999, 5)
    assert 1 - (1 - 0.8**5) ** n >= 0.9999 > 1 - (1 - 0.8**5) ** (n - 1)


def test_components(spark):
    rng = random.Random(1)
    edges = [(i, i + 1) for i in range(100, 140)] + [(rng.randrange(90), rng.randrange(90)) for _ in range(60)] + [(500, 499), (7, 7)]
    up = {x: x for e in edges for x in e}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in edges:
        a, b = sorted((find(a), find(b)))
        up[b] = a
    got = {(r.node, r.root) for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {(x, find(x)) for x in up if find(x) != x}


def test_query_equals_brute_force(spark):
    sf = "/root/testdata/sf0.001"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    got = sorted(map(tuple, mh.op5_minhash_join(spark, sf).collect()))
    assert got == brute(rows)


def test_marks_lose_no_row(spark):
    rows = spark.range(-3000, 3000).withColumn("s", mh.F.col("id").cast("string"))
    got = {r.id: r["__marked"] for r in common.marked(rows, rows.where("id % 7 = 0"), "id", "s").collect()}
    assert len(got) == 6000 and all(got[i] for i in got if i % 7 == 0)
    assert sum(got.values()) <= 6000 // 7 + 10
    assert not any(r["__marked"] for r in common.marked(rows, rows.where("false"), "id").collect())


def test_texts_without_a_partner_are_not_shuffled(spark):
    """1,500 texts of 12 kB, ten of them twice: the files of the shuffles stay far below the texts."""
    rows = [(i, " ".join(hashlib.sha256(b"%d %d" % (i, j)).hexdigest() for j in range(180))) for i in range(1500)]
    docs = spark.createDataFrame(rows + [(2000 + i, rows[i][1] + " x") for i in range(10)] + [rows[20]], "doc_id long, text string").repartition(4).checkpoint()
    blocks = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def held():
        files = blocks.getAllFiles()
        return sum(files.apply(i).length() for i in range(files.length()))

    before = held()
    kept = mh.one_of_each_group(docs).select("doc_id", mh.F.md5("text").alias("t")).collect()
    assert sorted((r.doc_id, r.t) for r in kept) == sorted((i, hashlib.md5(t.encode()).hexdigest()) for i, t in rows)
    assert held() - before < 0.6 * sum(len(t) for _, t in rows)
