"""Audit of hand-made exports: each against its specification, everything that is wrong with a file in one row.

An export is tab-separated text: a header, rows, total rows marked in the column Notes, and from a line `---` on the notes
that the exporting service wrote (what was grouped, which years, which filters). The audit reads these notes, so it sees
what a file is and not what was asked for. Files are rows: any number of them is audited in one pass, each in one task,
as an export is some thousand lines by the service's own limits.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Lines of the notes that show the filters of first births at term of one child head first. Fixed values.
MARKS = (
    "^Live Birth Order: 1$",
    "^Plurality: Single$",
    "^Fetal Presentation: Cephalic$",
    "^OE Gestational Age Recode 11:(?=.*37-38 weeks)(?=.*39 weeks)(?=.*40 weeks)(?=.*41 weeks)(?=.*42 weeks or more)",
)
#: The least number of places by the first grouping. Fixed values.
LEAST = {"County": 100, "State": 50}


def read(spark: SparkSession, path: str) -> DataFrame:
    """file, content, sha256 of every file of a folder. Spark's readers leave out files of no bytes, so an audit finds those missing."""
    raw = spark.read.format("binaryFile").load(path)
    return raw.select(F.element_at(F.split("path", "/"), -1).alias("file"), F.col("content").cast("string").alias("content"), F.sha2("content", 256).alias("sha256"))


def squished(x: Column) -> Column:
    return F.trim(F.regexp_replace(x, r"\s+", " "))


def _set(x: Column) -> Column:
    """The parts of "b; a", sorted; none where the text is null."""
    return F.coalesce(F.array_sort(F.transform(F.split(x, ";"), squished)), F.array().cast("array<string>"))


def _value(notes: Column, label: str) -> Column:
    """What the first note with the label says."""
    found = F.filter(notes, lambda n: n.startswith(f"{label}:"))
    return squished(F.substring(F.get(found, F.lit(0)), len(label) + 2, 1 << 30))


def _like(pattern: str) -> Callable[[Column], Column]:
    return lambda x: x.rlike(pattern)


def parsed(files: DataFrame) -> DataFrame:
    """files with parses, rows, n_geo and notes (null: the file has no notes). Without a column Births a file doesn't parse.

    n_geo counts the codes in the first column whose name ends in Code. Null and empty contents don't parse.
    """
    lines = F.split(F.regexp_replace(F.coalesce("content", F.lit("")), "\r\n?", "\n"), "\n")
    cells = lambda x: F.transform(F.split(x, "\t"), lambda c: F.regexp_replace(c, '^"|"$', ""))
    at, names = F.col("__at"), F.col("__names")
    out = files.withColumn("__lines", lines).withColumn("__at", F.array_position(F.transform("__lines", lambda x: x.rlike('^"?---')), True))
    body = F.when(at > 0, F.expr("slice(__lines, 1, int(__at) - 1)")).otherwise(F.col("__lines"))
    out = out.withColumn("notes", F.when(at > 0, F.transform(F.expr("slice(__lines, int(__at), size(__lines))"), lambda x: F.replace(x, F.lit('"'), F.lit("")))))
    out = out.withColumn("__table", F.transform(F.filter(body, lambda x: x.rlike(r"\S")), cells))
    out = out.withColumn("__names", F.transform(F.coalesce(F.get("__table", F.lit(0)), F.array().cast("array<string>")), squished))
    note = F.array_position(names, "Notes").cast("int")
    out = out.withColumns({"__note": note, "__code": F.array_position(F.transform(names, lambda n: n.rlike("Code$")), True).cast("int")})
    rows = F.filter(F.expr("slice(__table, 2, size(__table))"), lambda r: (F.col("__note") == 0) | (F.coalesce(F.get(r, F.col("__note") - 1), F.lit("")) != "Total"))
    out = out.withColumn("__rows", rows).withColumn("parses", F.array_contains(names, "Births"))
    out = out.withColumns({
        "rows": F.when(F.col("parses"), F.size("__rows")),
        "n_geo": F.when(F.col("parses") & (F.col("__code") > 0), F.size(F.array_distinct(F.transform("__rows", lambda r: F.get(r, F.col("__code") - 1))))),
    })
    return out.drop("__lines", "__at", "__table", "__names", "__note", "__code", "__rows")


def audit(files: DataFrame, spec: DataFrame, marks: Sequence[str] = MARKS, dataset: str = "expanded", least: Mapping[str, int] = LEAST) -> DataFrame:
    """key, file, role, present, rows, n_geo, dataset, query_date, sha256, problem: a row for each export of the specification, problem null where all is right.

    files: file, content, sha256. spec: key, file, role ("required" or another), group_by ("a; b"), years ("2022-2024" or
    "2022"), filtered (whether the notes must show all marks, or must not). Files that no export names are left out. Of
    several files with a name (in different folders) each gives a row.
    """
    c = F.col
    notes, made = c("notes"), c("parses")
    both = spec.select("key", "file", "role", "group_by", "years", "filtered").join(parsed(files.select("file", "content", "sha256")).drop("content").withColumn("present", F.lit(True)), "file", "left")
    both = both.withColumn("present", F.coalesce("present", F.lit(False)))
    both = both.withColumns({"dataset": F.when(made, _value(notes, "Dataset")), "query_date": F.when(made, _value(notes, "Query Date"))})
    ends = F.transform(F.split("years", "-"), lambda y: F.trim(y).cast("int"))
    want_years = F.transform(F.sequence(F.get(ends, F.lit(0)), F.element_at(ends, -1)), lambda y: y.cast("string"))
    both = both.withColumns({"__by": _set(_value(notes, "Group By")), "__want_by": _set(c("group_by")), "__years": _set(_value(notes, "Year")), "__want_years": F.array_sort(want_years)})
    shown = [F.exists(notes, _like(mark)) for mark in marks]
    has = reduce(lambda a, b: a & b, shown, F.lit(True))
    list_ = lambda x, sep: F.concat(F.lit("["), F.array_join(x, sep), F.lit("]"))
    noted = notes.isNotNull()
    problems = [
        F.when(~noted, "no notes"),
        F.when(noted & (c("__by") != c("__want_by")), F.concat(F.lit("grouped by "), list_("__by", "; "), F.lit(", not "), list_("__want_by", "; "))),
        F.when(noted & (c("__years") != c("__want_years")), F.concat(F.lit("years "), list_("__years", ", "), F.lit(", not "), list_("__want_years", ", "))),
        F.when(noted & has & ~c("filtered"), "filtered, but must hold all births"),
        F.when(noted & ~has & c("filtered"), "filters absent or not complete"),
        F.when(noted & ~F.contains("dataset", F.lit(dataset)), F.concat(F.lit("dataset "), "dataset", F.lit(f", not {dataset}"))),
        F.when(c("rows") == 0, "no rows"),
    ]
    for grouping, n in least.items():
        problems.append(F.when(c("group_by").startswith(grouping) & (c("n_geo") < n), F.concat(F.lit("only "), c("n_geo").cast("string"), F.lit(f" of {grouping}, less than {n}"))))
    every = F.array_join(F.array_compact(F.array(*problems)), "; ")
    problem = F.when(~c("present"), F.concat(F.lit("missing, "), "role")).when(~made, "no column Births").otherwise(F.nullif(every, F.lit("")))
    return both.withColumn("problem", problem).select("key", "file", "role", "present", "rows", "n_geo", "dataset", "query_date", "sha256", "problem")


def usable(audited: DataFrame) -> bool:
    """Whether every required export is there and right."""
    return audited.where((F.col("role") == "required") & F.col("problem").isNotNull()).isEmpty()
