import json
import random

import pytest

from tariffa.sources import pieces

ITEM = "a string, b array<struct<x:string>>, c string"
SHELL = "name string, places array<string>, lic struct<n:string,more:array<string>>"


@pytest.fixture
def small_splits(spark):
    # splits and batches far smaller than items
    own = {"spark.sql.files.maxPartitionBytes": "300", "spark.sql.files.openCostInBytes": "0", "spark.sql.execution.arrow.maxRecordsPerBatch": "3"}
    before = {k: spark.conf.get(k) for k in own}
    for k, v in own.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def words(r):
    return "".join(r.choice('ab{}[]"\\ ,:é\n') for _ in range(r.randrange(12)))


def document(r):
    """A document whose strings hold brackets, quotes and backslashes, with items of any size."""
    def item():
        return {"a": words(r), "b": [{"x": words(r)} for _ in range(r.choice([0, 1, 3, 60]))], "c": r.choice([None, "d" * r.randrange(900)])}
    before = {"name": words(r), "places": [words(r) for _ in range(3)], "lic": {"n": "1", "more": [words(r), "{[{"]}}
    items = [item() for _ in range(r.choice([0, 1, 20]))]
    more = {"others": [{"a": "last", "b": [], "c": None}] * r.randrange(3)}
    doc = {"list": items} | before | more if r.random() < 0.5 else before | {"list": items} | more
    return doc, items + more["others"], before


def test_items(spark, tmp_path, small_splits):
    r = random.Random(7)
    want, about = {}, {}
    for k in range(12):
        doc, items, before = document(r)
        path = tmp_path / f"{k}.json"
        path.write_text(json.dumps([doc] if k % 4 == 3 else doc, indent=r.choice([None, 1]), ensure_ascii=False) + r.choice(["", "\n", " \n\n"]), encoding="utf-8-sig" if k % 5 == 0 else "utf-8")
        want[path.name], about[path.name] = items, before
    (tmp_path / "empty.json").write_text("")
    found, shells = pieces.items(spark, str(tmp_path), ITEM, SHELL)
    assert found.rdd.getNumPartitions() > 20
    rows = found.collect()
    got = {name: [] for name in want}
    for row in rows:
        got[row.path.rsplit("/", 1)[1]].append(row.i.asDict(recursive=True))
    order = lambda xs: sorted(json.dumps(x, sort_keys=True) for x in xs)
    assert {k: order(v) for k, v in got.items()} == {k: order(v) for k, v in want.items()}
    assert len({(row.path, row.item_id) for row in rows}) == len(rows)
    assert {x.path.rsplit("/", 1)[1]: x.doc.asDict(recursive=True) for x in shells.collect()} == about


def test_stray_bytes(spark, tmp_path):
    (tmp_path / "a.json").write_bytes(b'{"name": "caf\xe9", "list": [{"a": "\xc3\xa9 \xe9"}]}')
    found, shells = pieces.items(spark, str(tmp_path / "a.json"), ITEM, SHELL)
    assert [r.i.a for r in found.collect()] == ["é é"] and [r.doc.name for r in shells.collect()] == ["café"]
