"""Tables of a store that are published together: readers see one whole build, the old one until the new one has passed its checks.

A build is written beside the others, read back and checked; then an empty marker whose name holds a number and the
build's id is made, and that one step publishes it. The greatest marker is the current build, so nothing is renamed or
overwritten, on any file system; a build that broke off or failed has no marker and is never read.
"""

from __future__ import annotations

import contextlib
import io
import uuid
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: What a check gives: its name and the number of rows that break it.
Checks = Callable[[dict[str, DataFrame]], Mapping[str, DataFrame]]


class Refused(ValueError):
    """A build that broke its checks."""


def _files(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def _names(spark: SparkSession, path: str) -> list[str]:
    fs, p = _files(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []


def builds(spark: SparkSession, root: str) -> list[str]:
    """Ids of the published builds, the current one last."""
    return [name.split("-", 1)[1] for name in _names(spark, f"{root}/published")]


def read(spark: SparkSession, root: str, build: str | None = None) -> dict[str, DataFrame]:
    """The tables of a published build, the current one by default. All are of one build, whatever is published meanwhile."""
    known = builds(spark, root)
    if not known or (build is not None and build not in known):
        raise ValueError(f"no published build {build or ''} below {root}")
    folder = f"{root}/builds/{build or known[-1]}"
    return {name: spark.read.parquet(f"{folder}/{name}") for name in _names(spark, folder)}


def orphans(rows: DataFrame, table: DataFrame, key: str) -> DataFrame:
    """Rows with a key that the table lacks; null keys are none."""
    return rows.where(F.col(key).isNotNull()).join(table.select(key), key, "left_anti")


def repeated(rows: DataFrame, *keys: str) -> DataFrame:
    """Keys that stand in several rows."""
    return rows.groupBy(*keys).count().where("count > 1")


def store_checks(tables: dict[str, DataFrame]) -> Mapping[str, DataFrame]:
    """The checks of a star schema, by the names of the tables of `store.Store` (`vars` of one gives them)."""
    fact, bridge = tables["fact"], tables["bridge"]
    keys = {"dim_code": "code_id", "dim_file": "file_id", "dim_payer": "payer_id", "dim_hospital": "ccn"}
    found = {f"{name}: {key} repeated": repeated(tables[name], key) for name, key in keys.items()}
    found |= {f"fact: {key} unknown": orphans(fact, tables[name], key) for name, key in keys.items() if key in fact.columns}
    return found | {f"bridge: {key} unknown": orphans(bridge, tables[name], key) for name, key in keys.items() if key in bridge.columns}


def publish(spark: SparkSession, root: str, tables: Mapping[str, DataFrame], checks: Checks | None = None, order: Mapping[str, Sequence[str]] | None = None, dry_run: bool = False) -> str | dict[str, str]:
    """Writes the tables as a build, checks what was written and publishes it; its id. A build that breaks a check is refused, and the one before stays current.

    order: by table the columns that its files are ranged and sorted by, so that filters on them open few files.
    dry_run: nothing is written, the plans by table come back.
    """
    laid = dict(tables)
    for name, keys in (order or {}).items():
        laid[name] = laid[name].repartitionByRange(*keys).sortWithinPartitions(*keys)
    if dry_run:
        plans = {}
        for name, df in laid.items():
            with contextlib.redirect_stdout(io.StringIO()) as text:
                df.explain("formatted")
            plans[name] = text.getvalue()
        return plans
    build = uuid.uuid4().hex
    folder = f"{root}/builds/{build}"
    for name, df in laid.items():
        df.write.mode("errorifexists").parquet(f"{folder}/{name}")
    if checks:
        written = {name: spark.read.parquet(f"{folder}/{name}") for name in laid}
        broken = {name: n for name, rows in checks(written).items() if (n := rows.count())}
        if broken:
            raise Refused("; ".join(f"{name} ({n} rows)" for name, n in broken.items()))
    last = _names(spark, f"{root}/published")
    number = int(last[-1].split("-", 1)[0]) + 1 if last else 1
    fs, marker = _files(spark, f"{root}/published/{number:012d}-{build}")
    fs.createNewFile(marker)
    return build


def drop_old(spark: SparkSession, root: str, keep: int = 2) -> list[str]:
    """Takes the oldest published builds away but for the last `keep` (1 at least): their markers first, so that no reader begins one. The ids."""
    names = _names(spark, f"{root}/published")
    gone = names[: len(names) - max(keep, 1)] if len(names) > max(keep, 1) else []
    for name in gone:
        for path, deep in ((f"{root}/published/{name}", False), (f"{root}/builds/{name.split('-', 1)[1]}", True)):
            fs, p = _files(spark, path)
            fs.delete(p, deep)
    return [name.split("-", 1)[1] for name in gone]
