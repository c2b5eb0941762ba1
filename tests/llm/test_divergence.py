import random
import re
from collections import Counter, defaultdict

import pytest

from tariffa.llm import divergence


def brute(rows, ranks=200):
    """(lang, source, part, item, value, rank) by the definitions, over all kept terms of all groups."""
    docs = [(lang or "", source or "", re.findall(divergence.BETWEEN.replace("[", "[^", 1), re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))) for text, lang, source in rows]
    seen, counts, groups = Counter(), defaultdict(Counter), {(a, b) for a, b, _ in docs}
    for lang, source, terms in docs:
        seen.update({(lang, t) for t in terms})
        counts[lang, source].update(terms)
    out = []
    for lang in {a for a, _ in groups}:
        kept = sorted(t for (a, t), n in seen.items() if a == lang and n >= 3)
        sources = sorted(b for a, b in groups if a == lang)

        def shares(c, kept=kept):
            total = sum(c[t] for t in kept) + len(kept)
            return {t: 1 + 10**9 * (c[t] + 1) // total for t in kept}

        q = shares(sum((counts[lang, s] for s in sources), Counter()))
        p = {s: shares(counts[lang, s]) for s in sources}
        for s in sources:
            pairs = [(o, sum((p[s][t] - p[o][t]) ** 2 // p[o][t] for t in kept)) for o in sources if o != s]
            terms = [(t, (p[s][t] - q[t]) ** 2 // q[t]) for t in kept if counts[lang, s][t] and p[s][t] > q[t]]
            for part, found in (("pair", pairs), ("term", terms)):
                ordered = sorted(found, key=lambda r: (-r[1], r[0].encode()))
                out += [(lang, s, part, o, v, k) for k, (o, v) in enumerate(ordered, 1) if part == "pair" or k <= ranks]
    return sorted(out)


def some_rows():
    rng = random.Random(8)
    words = ["The", "the", "THE,", "ÉTÉ", "été", "KelvinK", "x1y", "x-y", "日本語", "no break", "7", "--", "a'b", "ſ", "😀smile", "q" * 5000]
    words += ["".join(rng.choice("abcDE1-") for _ in range(rng.randrange(1, 5))) for _ in range(150)]
    rows = [(None, None, None), ("", "en", "bare"), ("1 2 3 !", "xx", "digits"), ("alone", "yy", "s"), (None, "zz", None), ("zig", "zz", "b"), ("zig", "zz", None), ("ZIG zag", "zz", "b"), ("same text", "en", "s1"), ("same text", "en", "s1")]
    for _ in range(300):
        text = rng.choice([" ", "\n", "\x1c", " \t"]).join(rng.choice(words) for _ in range(rng.randrange(0, 40)))
        rows.append((text, rng.choice(["en", "en", "de", None]), rng.choice(["hot", "hot", "s1", "s2", "s3", None])))
    rows += [(" ".join(rng.choice(words) for _ in range(20_000)), "en", "long")]
    return rows


@pytest.mark.parametrize("small", [False, True])
def test_audit_equals_brute_force(spark, monkeypatch, small):
    if small:  # many slices, and terms and chunks that go on in the next ones
        for name, value in (("COUNT_BYTES", 400), ("ROWS", 7), ("PAIRS", 5)):
            monkeypatch.setattr(divergence, name, value)
    rows = some_rows()[: 200 if small else None]
    docs = spark.createDataFrame([(*r, "odd", 1) for r in rows], "text string, lang string, source string, term string, n int").repartition(5)
    got = sorted(map(tuple, divergence.audit(docs).collect()))
    assert got == brute(rows)


def test_empty_table(spark):
    assert divergence.audit(spark.createDataFrame([], "text string, lang string, source string")).collect() == []
