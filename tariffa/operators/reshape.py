"""Unpivots, pivots and generators."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tariffa.functions.text import blank_to_null


def code_slots(df: DataFrame, slots: Sequence[tuple[Column, Column]], keep: Sequence[str]) -> DataFrame:
    """A row for each filled (code, type) slot, with its number."""
    rows = F.array(*(F.struct(F.lit(i + 1).alias("slot"), c.cast("string").alias("code"), t.cast("string").alias("type")) for i, (c, t) in enumerate(slots)))
    return df.select(*keep, F.inline(F.filter(rows, lambda r: r["code"].isNotNull() & (F.trim(r["code"]) != ""))))


#: Metrics of a payer and plan in wide headers. Fixed values.
WIDE_METRICS = ("negotiated_dollar", "negotiated_percentage", "negotiated_algorithm", "methodology", "estimated_amount", "median_amount", "10th_percentile", "90th_percentile", "count", "additional_payer_notes")
#: Those of which a block must have one. Fixed names.
RATE_METRICS = ("negotiated_dollar", "negotiated_percentage", "negotiated_algorithm", "median_amount", "10th_percentile", "90th_percentile", "estimated_amount")


def wide_headers(columns: Sequence[str]) -> dict[tuple[str, str], dict[str, str]]:
    """(payer, plan) to metric to column, from names such as standard_charge|PAYER|PLAN|negotiated_dollar or count|PAYER|PLAN."""
    found: dict[tuple[str, str], dict[str, str]] = {}
    for c in columns:
        p = [x.strip() for x in re.split(r"\s*\|\s*", c.strip())]
        if p[0].lower() == "standard_charge" and len(p) >= 3 and p[-1].lower() in WIDE_METRICS:
            payer, plan, metric = p[1], "|".join(p[2:-1]), p[-1].lower()
        elif p[0].lower() in WIDE_METRICS and len(p) >= 2:
            payer, plan, metric = p[1], "|".join(p[2:]), p[0].lower()
        else:
            continue
        found.setdefault((payer, plan), {})[metric] = c
    return found


def wide_rates(df: DataFrame, keep: Sequence[str]) -> DataFrame:
    """A row for each payer and plan block that has a rate (RATE_METRICS); lines without any keep one row without a payer."""
    blocks = [
        F.struct(F.lit(payer).alias("payer_name"), F.lit(plan or None).cast("string").alias("plan_name"), *((blank_to_null(F.col(f"`{names[m]}`")) if m in names else F.lit(None).cast("string")).alias(m) for m in WIDE_METRICS))
        for (payer, plan), names in wide_headers(df.columns).items()
    ]
    fields = ["payer_name", "plan_name", *WIDE_METRICS]
    if not blocks:
        return df.select(*keep, *(F.lit(None).cast("string").alias(f) for f in fields))
    filled = F.filter(F.array(*blocks), lambda b: F.coalesce(*(b[m] for m in RATE_METRICS)).isNotNull())
    return df.select(*keep, F.inline_outer(filled))


def metrics_long(df: DataFrame, ids: Sequence[str], metrics: Sequence[str], name: str = "metric", value: str = "value") -> DataFrame:
    return df.unpivot(list(ids), list(metrics), name, value)


def headline(df: DataFrame, rows: Sequence[str], column: str, levels: Sequence[str], value: str, first_row: Column | None = None) -> DataFrame:
    """One column for each listed level; the levels are given, so that no job looks for them."""
    out = df.groupBy(*rows).pivot(column, list(levels)).agg(F.first(value, True))
    return out.orderBy(*( [F.when(first_row, 0).otherwise(1)] if first_row is not None else []), *rows)


def numbered(df: DataFrame, low: Column, high: Column, out: str) -> DataFrame:
    """Each row once for every whole number between two."""
    return df.withColumn(out, F.explode(F.sequence(low, high)))


def replicated(df: DataFrame, n: int, out: str = "draw") -> DataFrame:
    """Each row n times, numbered from 1."""
    return df.withColumn(out, F.explode(F.sequence(F.lit(1), F.lit(n))))
