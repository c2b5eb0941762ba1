import hashlib
import random
import re
import zlib

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from tariffa.llm import periods


def brute(w):
    """(start, length, period) of the runs of a list of words."""
    n, out = len(w), set()
    for q in range(1, n // 2 + 1):
        i = q
        while i < n:
            if w[i] == w[i - q]:
                j = i
                while j < n and w[j] == w[j - q]:
                    j += 1
                s, e = i - q, j
                if e - s >= max(12, 2 * q) and not any(all(w[k] == w[k - r] for k in range(s + r, e)) for r in range(1, q)):
                    out.add((s, e - s, q))
                i = j
            i += 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def digests(doc_id, text):
    """The row of the query, from the words one by one."""
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    if doc_id is not None and w:
        h = zlib.crc32(str(doc_id).encode())
        g, n = h // 10, len(w)
        if h % 10 == 0:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    found = brute(w)
    kept = [x for i, x in enumerate(w) if not any(s + q <= i < s + m for s, m, q in found)]
    best = min(found, key=lambda r: (-r[1], r[0], r[2])) if found else None
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    return (doc_id, len(found), *(best or (None, None, None)), 1000 * best[1] // best[2] if best else None, sha("".join(f"{s},{m},{q}\n" for s, m, q in found)), sha(" ".join(kept)))


pieces = st.tuples(st.lists(st.integers(0, 3), min_size=1, max_size=12), st.integers(1, 9), st.integers(0, 3))
texts = st.lists(pieces, max_size=4).map(lambda ps: sum(([*b * n, *b[:k]] for b, n, k in ps), []))


@settings(max_examples=300, deadline=None)
@given(st.lists(texts, min_size=1, max_size=4))
def test_runs_equal_brute_force(docs):
    offsets = np.concatenate([[0], np.cumsum([len(d) for d in docs])])
    assert periods.runs_of(np.array(sum(docs, []), np.int32), offsets) == [(t, *r) for t, d in enumerate(docs) for r in brute(d)]


def test_one_word_over_and_over_is_quick():
    assert periods.runs_of(np.zeros(300_000, np.int32), np.array([0, 300_000])) == [(0, 0, 300_000, 1)]


def some_rows():
    rng = random.Random(3)
    rows = [(None, None), (None, "x " * 30), (1, ""), (2, " \t\n"), (3, None), (4, "a b " * 40), (4, "a b " * 40), (5, "a" * 100_000), (6, "é ü  " * 20), (7, "A a " * 6 + "b"), (8, "\x1ca \x1ca " * 9)]
    for i in range(10, 400):
        w = [rng.choice("abcdefgh") * rng.randrange(1, 4) for _ in range(rng.randrange(0, 60))]
        at, p = rng.randrange(len(w) + 1), rng.randrange(1, 9)
        w[at:at] = (w[:p] * rng.randrange(0, 12))[: rng.randrange(0, 70)]
        rows.append((i, rng.choice([" ", "\n", " \t "]).join(w)))
    rows.append((500, " ".join(rng.choice(["x", "y", "z"]) for _ in range(3000))))
    return rows


def test_query_equals_brute_force(spark, tmp_path):
    rows = some_rows()
    assert sum(i is not None and zlib.crc32(str(i).encode()) % 10 == 0 for i, _ in rows) > 20
    spark.createDataFrame([(i, t, "odd", 1) for i, t in rows], "doc_id long, text string, runs string, words int").repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    got = periods.op13_periodic_runs(spark, str(tmp_path)).collect()
    assert sorted(map(str, map(tuple, got))) == sorted(str(digests(*r)) for r in rows)


def test_operator_gives_runs_and_text(spark):
    docs = spark.createDataFrame([(1, "go  " + "la la la " * 5 + "end")], "doc_id long, text string")
    row = periods.periodic_runs(docs).first()
    assert (row.words, [tuple(r) for r in row.runs], row.collapsed) == (17, [(1, 15, 1)], "go la end")


def test_empty_table(spark):
    assert periods.periodic_runs(spark.createDataFrame([], "doc_id long, text string")).collect() == []
