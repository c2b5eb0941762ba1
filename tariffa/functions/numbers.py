"""Money, dates, distances and bounded shares as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tariffa.functions.text import stripped

EARTH_MILES = 3958.8


def money(x: Column) -> Column:
    return F.regexp_replace(x, r"[$,%\s]", "").try_cast("double")


def mrf_date(x: Column) -> Column:
    """ISO, slashed (four or two digits of the year), compact and dashed US dates between 1990 and 2100 as ISO text; other text as it is."""
    t = stripped(x)
    found = F.coalesce(
        F.when(t.rlike(r"^\d{4}-\d{1,2}-\d{1,2}"), F.try_to_date(F.regexp_extract(t, r"^\d{4}-\d{1,2}-\d{1,2}", 0), "yyyy-M-d")),
        F.when(t.rlike(r"^\d{1,2}/\d{1,2}/\d{4}$"), F.try_to_date(t, "M/d/yyyy")),
        F.when(t.rlike(r"^\d{1,2}/\d{1,2}/\d{2}$"), F.try_to_date(t, "M/d/yy")),
        F.when(t.rlike(r"^\d{8}$"), F.try_to_date(t, "yyyyMMdd")),
        F.when(t.rlike(r"^\d{1,2}-\d{1,2}-\d{4}$"), F.try_to_date(t, "M-d-yyyy")),
    )
    good = F.year(found).between(1990, 2100)
    return F.when(good, F.date_format(found, "yyyy-MM-dd")).otherwise(F.nullif(t, F.lit("")))


def haversine(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Great-circle miles."""
    a = F.pow(F.sin(F.radians(lat2 - lat1) / 2), 2) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.pow(F.sin(F.radians(lon2 - lon1) / 2), 2)
    return 2 * EARTH_MILES * F.asin(F.least(F.lit(1.0), F.sqrt(a)))


def similarity(name: Column, address: Column, place: Column) -> Column:
    """Weighted mean of the parts that are there; weights 0.5, 0.35 and 0.15."""
    weights = ((name, 0.5), (address, 0.35), (place, 0.15))
    total = sum((F.when(c.isNotNull(), w).otherwise(0.0) for c, w in weights), F.lit(0.0))
    return F.try_divide(sum((F.coalesce(c * w, F.lit(0.0)) for c, w in weights), F.lit(0.0)), total)


def plausible(x: Column) -> Column:
    """Dollars above 1 and below two million that aren't a filler of five or more nines."""
    nines = x.try_cast("decimal(18,2)").cast("string").rlike(r"^9{5,}(\.(9+|0+))?$")
    return F.coalesce((x > 1) & (x < 2_000_000) & ~nines, F.lit(False))


def jaccard(a: Column, b: Column) -> Column:
    return F.try_divide(F.size(F.array_intersect(a, b)), F.size(F.array_union(a, b)))


def triangular(u: Column, low: Column, mode: Column, high: Column) -> Column:
    """Inverse distribution function of the triangular distribution."""
    cut = F.try_divide(mode - low, high - low)
    return (
        F.when(high == low, low)
        .when(u < cut, low + F.sqrt(u * (high - low) * (mode - low)))
        .otherwise(high - F.sqrt((1 - u) * (high - low) * (high - mode)))
    )
