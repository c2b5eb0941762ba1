import math
import random
import zlib
from collections import Counter, defaultdict

import pyarrow as pa
import pytest

from tariffa.llm import langid as li


class Brute:
    """The same model from plain dictionaries."""

    def __init__(self, texts):
        raw = Counter()
        for t in texts:
            for w in self.words(t):
                w = li.START + w + li.END
                for i in range(2, len(w) + 1):
                    raw[w[max(0, i - li.ORDER) : i]] += 1
        self.n = {li.ORDER: {g: c for g, c in raw.items() if len(g) == li.ORDER}}
        for k in range(li.ORDER - 1, 0, -1):
            own = Counter(g[1:] for g in self.n[k + 1])
            if k > 1:
                own.update({g: c for g, c in raw.items() if len(g) == k})
            self.n[k] = own
        self.d, self.total, self.kinds = {}, {}, {}
        for k, grams in self.n.items():
            n1, n2 = (sum(c == x for c in grams.values()) for x in (1, 2))
            self.d[k] = max(0.1, n1 / (n1 + 2 * n2)) if n1 + n2 else 0.5
            self.total[k], self.kinds[k] = defaultdict(int), defaultdict(int)
            for g, c in grams.items():
                self.total[k][g[:-1]] += c
                self.kinds[k][g[:-1]] += 1

    @staticmethod
    def words(text):
        return "".join(c if c.isalpha() else " " for c in (text or "").lower()).split()

    def p(self, g, symbols):
        if not g:
            return 1 / symbols
        k, c = len(g), g[:-1]
        lower = self.p(g[1:], symbols)
        if not self.total[k].get(c):
            return lower
        return max(0, self.n[k].get(g, 0) - self.d[k]) / self.total[k][c] + self.d[k] * self.kinds[k][c] / self.total[k][c] * lower

    def entropy(self, text, symbols):
        bits = n = 0
        for w in self.words(text):
            w = li.START + w + li.END
            for i in range(2, len(w) + 1):
                bits -= math.log2(self.p(w[max(0, i - li.ORDER) : i], symbols))
                n += 1
        return bits / max(n, 1), n


def corpus():
    rng = random.Random(2)
    parts = {"aa": ["ka", "lo", "mi", "tu"], "bb": ["sch", "ung", "ü", "ei", "st"], "cc": ["日", "本", "語", "𠀀"]}
    rows = []
    for i in range(90):
        lang = "abc"[i % 3] * 2
        rows.append((i, " ".join("".join(rng.choice(parts[lang]) for _ in range(rng.randrange(1, 5))) for _ in range(rng.randrange(3, 40))).capitalize() + ", 12.", lang))
    return rows


SCHEMA = "doc_id long, text string, lang string"
#: Prose of languages that the test documents don't have.
FOREIGN = {
    "fi": "Kaikki ihmiset syntyvät vapaina ja tasavertaisina arvoltaan ja oikeuksiltaan. Heille on annettu järki ja omatunto, ja heidän on toimittava toisiaan kohtaan veljeyden hengessä.",
    "pl": "Wszyscy ludzie rodzą się wolni i równi pod względem swej godności i swych praw. Są oni obdarzeni rozumem i sumieniem i powinni postępować wobec innych w duchu braterstwa.",
    "hu": "Minden emberi lény szabadon születik és egyenlő méltósága és joga van. Az emberek, ésszel és lelkiismerettel bírván, egymással szemben testvéri szellemben kell hogy viseltessenek.",
    "el": "Όλοι οι άνθρωποι γεννιούνται ελεύθεροι και ίσοι στην αξιοπρέπεια και τα δικαιώματα. Είναι προικισμένοι με λογική και συνείδηση.",
}


def test_equals_plain_model(spark):
    rows = corpus()
    df = spark.createDataFrame([*rows, (200, None, "aa"), (201, "kalo", None)], SCHEMA)
    texts = [t for _, t, _ in rows[:30]] + ["zzz qqq", "Ka ungka 日", "", None, "12 %", "kalomitu" * 300]
    asked = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    counts = li.counted(df, li.F.lit(0))
    model = li.Model(counts, [(0,)])
    assert model.langs == ["aa", "bb", "cc"]
    brute = {x: Brute([t for _, t, y in rows if y == x]) for x in model.langs}
    symbols = 1 + len({g for b in brute.values() for g in b.n[1] if g != li.START})
    assert model.symbols == symbols
    none = asked.withColumn("lang", li.F.lit(None).cast("string"))
    bits = model.bits(li._windows(li.counted(none, li.F.lit(-1))))
    for table_bytes in (li.TABLE_BYTES, 2000, 1):  # all windows broadcast, some of them, one
        got = {r.doc_id: r for r in li.entropies(asked, model, bits, ["doc_id"], table_bytes=table_bytes).collect()}
        assert len(got) == len(texts)
        for i, t in enumerate(texts):
            for k, x in enumerate(model.langs):
                want, chars = brute[x].entropy(t, symbols)
                assert got[i]["__chars"] == chars
                assert got[i]["__sums"][k] / max(chars, 1) == pytest.approx(want, rel=1e-4, abs=1e-9)


def test_rows(spark):
    rows = [*corpus(), (300, None, "aa"), (301, "12 34", "bb"), (302, "", None), (None, "kalo mitu lomi", None), (303, "xqzj wvyk gfpd xqzj wvyk gfpd bnrh cxzq " * 60, None), (1, *corpus()[1][1:])]
    df = spark.createDataFrame(rows, SCHEMA).withColumn("score", li.F.lit("x"))
    model = li.trained(df)
    got = {r.doc_id: r for r in li.languages(df, model).collect()}
    assert [got[i].lang_pred for i in (300, 301, 302)] == ["und"] * 3
    assert all(got[i].rejected and got[i].score == 0 for i in (300, 301, 302))
    assert got[None].lang_pred == "aa" and 0 < got[None].score <= 1 and not got[None].rejected
    assert got[303].rejected
    assert all(got[i].lang_pred == x and not got[i].rejected for i, _, x in corpus())
    kept = li.identified(df)
    assert kept.columns == df.columns and kept.count() == len(rows) - 4
    assert {(r.lang, r.score) for r in kept.where("doc_id is null").collect()} == {("aa", "x")}
    empty = li.trained(df.limit(0))
    assert {(r.lang_pred, r.rejected) for r in li.languages(df, empty).collect()} == {("und", True), ("und", False)}
    assert li.languages(df.limit(0), model).count() == 0 and li.identified(df.limit(0)).count() == 0
    assert {r.doc_id for r in li.identified(df.withColumn("lang", li.F.lit(None).cast("string"))).collect()} >= {303, None}


def test_unseen_languages_are_rejected(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = li.trained(docs)
    asked = spark.createDataFrame([(i, t * k, x) for i, (x, t) in enumerate(FOREIGN.items()) for k in (1, 5)], SCHEMA)
    rows = li.languages(asked, model).collect()
    assert len(rows) == 2 * len(FOREIGN) and all(r.rejected for r in rows)


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    truth = {r.doc_id: r for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = li.op7_kneser_ney(spark, sf).collect()
    assert len(rows) == len(truth)
    assert {"doc_id", "held_out", "lang_pred", "score"} <= set(rows[0].asDict())
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    held = [r for r in rows if r.held_out]
    assert sum(r.lang_pred == truth[r.doc_id].lang for r in held) / len(held) > 0.99
    assert sum(r.rejected for r in rows) <= 0.002 * len(rows)


def test_counting_takes_no_python_step_a_word(spark, monkeypatch):
    """Words that hardly repeat are counted by arrays: 60,000 distinct words, handed on in several parts, against plain counts."""
    monkeypatch.setattr(li, "COUNTED_GRAMS", 5_000)
    rng = random.Random(5)
    texts = [" ".join("".join(rng.choice("abcdeäß日𠀀") for _ in range(rng.randrange(1, 9))) for _ in range(600)) for _ in range(100)] + ["", "12 !", None]
    docs = spark.createDataFrame([(i % 2, "aa", t) for i, t in enumerate(texts)], "part int, lang string, text string")
    want = Counter()
    for i, t in enumerate(texts):
        for w in Brute.words(t):
            w = li.START + w + li.END
            want.update((i % 2, w[max(0, e - li.ORDER) : e]) for e in range(2, len(w) + 1))
    assert {(r.part, r.gram): r.n for r in li._count(docs.where("text is not null")).collect()} == want
    # no array of characters becomes strings word by word
    codes, lengths, place, offsets = li.distinct_words(pa.array(["ab ab c", None, "c"]))
    assert sorted("".join(map(chr, codes)).replace(li.START, "").split(li.END)) == ["", "ab", "c"]
    assert lengths.sum() == len(codes) and len(place) == 4 and offsets.tolist() == [0, 3, 3, 4]
