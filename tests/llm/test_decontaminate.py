import itertools
import random

import numpy as np

from tariffa.llm import decontaminate as dc


def test_masks_miss_no_window():
    for bad in itertools.combinations(range(dc.WINDOW), dc.SUBSTITUTED):
        assert any(not {s + p for p in m} & set(bad) for m in dc.MASKS for s in range(dc.WINDOW - m[-1]))


def brute(docs, items, least=1):
    """Every alignment of every item, window by window."""
    out, number = set(), {}
    of = lambda text: np.array([number.setdefault(w, len(number)) for w in (text or "").lower().split()], np.int64)
    benchmark = [(i, of(t)) for i, t in items]
    for d, text in docs:
        w = of(text)
        for i, v in benchmark:
            n = len(v)
            if n < least or not n or not len(w):
                continue
            width, most = min(n, dc.WINDOW), 3 * min(n, dc.WINDOW) // 13
            padded = np.concatenate([np.full(n, -1), w, np.full(n, -2)])
            off = np.arange(len(w) + n)  # the item's first word stands at off - n
            spots = off[:, None] + np.arange(n)
            same, inside = padded[spots] == v, (spots >= n) & (spots < n + len(w))
            if n < width:
                continue
            sums = lambda x: np.lib.stride_tricks.sliding_window_view(x, width, axis=1).sum(axis=2)
            for o, j in np.argwhere((sums(same) >= width - most) & (sums(inside) == width)):
                out.update((d, i, int(p)) for p in range(o - n + j, o - n + j + width))
    return out


def covered(rows):
    return {(r.doc_id, r.item_id, p) for r in rows for p in range(r.start_word, r.end_word)}


def case():
    rng = random.Random(9)
    vocab = [f"w{i}" for i in range(60)] + ["É", "ß"]
    items = [(i, " ".join(rng.choice(vocab) for _ in range(n))) for i, n in enumerate([30, 14, 13, 9, 5, 4, 40])] + [(7, None), (8, ""), (9, "w3"), (10, "w5 w6"), (11, "w1 w2 w3 w4 w5 w6 w7"), (12, " ".join(f"w{k}" for k in range(20, 32)))]
    docs = [(0, None), (1, ""), (2, "w1"), (3, items[5][1])]
    for d in range(4, 40):
        words = [rng.choice(vocab) for _ in range(rng.randrange(60))]
        part = items[rng.choice([0, 1, 2, 3, 4, 6, 11, 12])][1].split()
        cut = part[rng.randrange(3) :][: rng.randrange(5, 41)]
        for _ in range(rng.randrange(5)):
            cut[rng.randrange(len(cut))] = "X"
        at = rng.randrange(len(words) + 1)
        docs.append((d, " ".join(words[:at] + cut + words[at:])))
    return [*docs, docs[-1], (99, "w9 " * 30000 + items[0][1].upper())], items


def test_equals_brute_force(spark):
    docs, items = case()
    df = spark.createDataFrame([(d, t, i) for d, (i, t) in enumerate(docs)], "row long, text string, doc_id long").withColumn("item_id", dc.F.lit("clash"))
    bench = spark.createDataFrame(items, "item_id long, text string")
    want = brute(docs, items)
    dropped = brute(docs, items, dc.LEAST)
    assert (99, 0) in {(d, i) for d, i, _ in want} and {i for _, i, _ in want} >= {0, 5, 9}
    for block in (dc.BLOCK_BYTES, 300):
        rows = dc.overlaps(df, bench, block_bytes=block).collect()
        assert covered(rows) == want
        kept = [r.row for r in dc.clean_documents(df, bench, block_bytes=block).collect()]
        hit = {d for d, *_ in dropped}
        assert sorted(kept) == [k for k, (d, _) in enumerate(docs) if d not in hit]
    assert dc.overlaps(df.limit(0), bench).count() == 0
    assert dc.overlaps(df, bench.limit(0)).count() == 0
    assert dc.clean_documents(df, bench.limit(0)).count() == len(docs)


def test_query_equals_brute_force(spark):
    sf = "/root/testdata/sf0.001"
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    rows = dc.op4_spaced_seeds(spark, sf).collect()
    assert covered(rows) == brute(docs, items)
    assert rows
