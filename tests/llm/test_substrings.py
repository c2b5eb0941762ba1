import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa

from tariffa.llm import substrings as ss
from tariffa.llm.common import _BYTES, text_bytes


def plain_chunks(text):
    """(start, end, words) of the chunks of one text, byte by byte."""
    raw = (text or "").encode()
    spans, at = [], None
    for i, b in enumerate(raw + b" "):
        white = b in b"\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f "
        if not white and at is None:
            at = i
        elif white and at is not None:
            spans.append((at, i))
            at = None
    keys = []
    for _, e in spans:
        keys.append(sum(int(_BYTES[raw[e - 1 - j]]) << (ss.SHIFT * j) for j in range(min(ss.REACH, e))) % (1 << 64))
    chosen = sorted({min(range(i, i + ss.WINDOW), key=lambda k: (keys[k], k)) for i in range(len(keys) - ss.WINDOW + 1)})
    cuts, kept = set(), None
    for before, i in zip([None, *chosen], chosen):  # noqa: B905
        close = before is not None and i - before < ss.WINDOW and keys[i] == keys[before]
        if not close or i - kept >= ss.WINDOW:
            cuts.add(i)
            kept = i
    out, first = [], 0
    for i in range(len(keys)):
        if i == len(keys) - 1 or i in cuts:
            out.append((spans[first][0], spans[i][1], i + 1 - first))
            first = i + 1
    return out


def plain_runs(text):
    """(first word, words, start, end) of the least run of enough words from each chunk on."""
    own, word, out = plain_chunks(text), 0, []
    for i, (a, _, w) in enumerate(own):
        words = 0
        for _, b, more in own[i:]:
            words += more
            if words >= ss.LEAST_WORDS:
                out.append((word, words, a, b))
                break
        word += w
    return out


def brute(rows):
    places, own = defaultdict(list), {}
    for d, t in {(d, t or "") for d, t in rows if d is not None}:
        own[d, t] = plain_runs(t)
    rows_of = Counter((d, t or "") for d, t in rows if d is not None)
    for (d, t), found in own.items():
        for w, n, a, b in found:
            places[t.encode()[a:b]] += [(d, t, w)] * rows_of[d, t]
    out = []
    for (d, t), found in own.items():
        covered, stale, copies = set(), set(), {}
        for w, n, a, b in found:
            p = places[t.encode()[a:b]]
            if len(set(p)) > 1:
                covered |= set(range(w, w + n))
                for k in range(w, w + n):
                    copies[k] = max(copies.get(k, 0), len(p))
                heads = sorted(set(p), key=lambda x: (x[0], x[2]))
                if (d, t, w) != heads[0]:
                    stale |= set(range(w, w + n))
        spans = [(s.start(), s.end()) for s in re.finditer(rb"[^\t\n\x0b\x0c\r\x1c-\x1f ]+", t.encode())]
        for first in sorted(k for k in covered if k - 1 not in covered):
            end = first
            while end in covered:
                end += 1
            out.append((d, spans[first][0], spans[end - 1][1], end - first, max(copies[k] for k in range(first, end)), end - first - len(stale & set(range(first, end)))))
    return sorted(out)


def case():
    rng = random.Random(8)
    word = lambda: "".join(rng.choice("abcdeéß") for _ in range(rng.randrange(1, 9)))
    passages = [[word() for _ in range(n)] for n in (55, 70, 25, 12)]
    rows = [(0, None), (1, ""), (2, " \n"), (3, "one two"), (None, "x " * 100)]
    for i in range(10, 60):
        words = [word() for _ in range(rng.randrange(150))]
        for p in rng.sample(passages, rng.randrange(3)):
            at = rng.randrange(len(words) + 1)
            words[at:at] = p
        rows.append((i, rng.choice([" ", "\n", "  "]).join(words)))
    rows += [(80, "of " * 200), (81, "x y z of " + "of " * 90), (82, "a b " * 60)]
    return rows + [(100, "again and " * 20000), (70, rows[20][1]), (71, rows[20][1])], passages


def test_chunks_equal_plain_ones():
    rows, _ = case()
    data, offsets = text_bytes(pa.array([t for _, t in rows[:40]]))
    first, end, starts, ends, words = ss.chunk_words(data, offsets)
    row = np.searchsorted(words, first, "right") - 1
    got = defaultdict(list)
    for r, a, b in zip(row, first, end, strict=True):
        got[r].append((starts[a] - offsets[r], ends[b - 1] - offsets[r], b - a))
    assert all(got[k] == plain_chunks(t) for k, (_, t) in enumerate(rows[:40]))


def test_equals_brute_force(spark):
    rows, passages = case()
    df = spark.createDataFrame([(t, d, 1) for d, t in rows], "text string, doc_id long, digest int")
    got = sorted(tuple(r)[:6] for r in ss.repeated_spans(df).collect())
    assert got == brute(rows)
    texts = dict(rows)
    holders = [d for d, t in rows if d and d < 60 and " ".join(passages[1]) in " ".join((t or "").split())]
    assert len(holders) > 2 and all(any(g[0] == d and g[3] >= 20 for g in got) for d in holders)
    once = {d for d, t in rows if d and not any(" ".join(p) in " ".join((t or "").split()) for p in passages)} - {100, 70, 71, 80, 81, 82, rows[20][0]}
    assert not once & {g[0] for g in got}
    assert ss.repeated_spans(df.limit(0)).count() == 0
    cut = {r.doc_id: r.text for r in ss.without_repeats(df.where("doc_id is not null")).collect()}
    assert set(cut) == set(texts) - {None} and len(cut[70].split()) < len(texts[70].split()) and all(cut[d] == texts[d] for d in once)
    words = lambda ts: {w for t in ts for w in (t or "").split()}
    assert words(cut.values()) == words(t for d, t in rows if d is not None)
    grams = lambda ts: {tuple(t[i : i + 20]) for t in map(str.split, ts) for i in range(len(t) - 19)}
    assert all(sum(" ".join(p) in " ".join((t or "").split()) for t in cut.values()) <= 3 for p in passages[:2])  # one for each kind of white space
    assert len(grams([cut[71]])) < len(grams([texts[71]]))
    assert len(cut[100]) < 1000


def test_shifts_keep_chunks():
    rng = random.Random(1)
    words = ["".join(rng.choice("abcdefgh") for _ in range(6)) for _ in range(300)]
    a, b = " ".join(words), " ".join(["inserted", "here", *words])
    own = lambda t: Counter(t.encode()[x:y] for x, y, _ in plain_chunks(t))
    assert sum((own(a) & own(b)).values()) >= len(plain_chunks(a)) - 3


def test_query_equals_brute_force(spark):
    sf = "/root/testdata/sf0.001"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    assert sorted(map(tuple, ss.op1_gear_chunks(spark, sf).collect())) == brute(rows)


def test_passages_in_random_contexts(spark):
    """Each passage of 51 to 60 words stands in two documents, between other words."""
    rng = random.Random(51)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(rng.randrange(1, 10)))
    rows, places = [], {}
    for i in range(3000):
        passage = " ".join(word() for _ in range(51 + i % 10))
        for d in (2 * i, 2 * i + 1):
            before = "".join(word() + " " for _ in range(rng.randrange(20, 60)))
            rows.append((d, before + passage + "".join(" " + word() for _ in range(rng.randrange(20, 60)))))
            places[d] = len(before), len(before) + len(passage)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = [r for r in ss.repeated_spans(df).collect() if r.words >= 20]
    # the words around a passage may happen to be equal, too
    assert all(places[r.doc_id][0] - 20 <= r.start < r.end <= places[r.doc_id][1] + 20 for r in got)
    assert sum(places[r.doc_id][0] <= r.start < r.end <= places[r.doc_id][1] for r in got) > 0.98 * len(got)
    assert len(set(places) - {r.doc_id for r in got}) == 0
