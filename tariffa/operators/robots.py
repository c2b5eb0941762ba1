"""Robots rules as a table by host, and what they allow.

The rules of a host follow from its answer: one in 400 to 499 or a page in place of the file has none, one from 500 on or no
answer at all forbids everything. In a file the groups that name the agent are united; where none does those for all
agents count. Of the rules that a path matches the longest decide, and allowing wins a tie.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tariffa.functions import text as tx
from tariffa.sources import web


def statuses(responses: DataFrame) -> DataFrame:
    """host, robots_status: ok with any answer, else the class of the failure. responses: host, http_status, message, body."""
    return responses.select("host", F.when(F.col("http_status").isNotNull(), "ok").otherwise(web.outcome(F.col("http_status"), F.col("message"))).alias("robots_status"))


def rules(responses: DataFrame, agent: str) -> DataFrame:
    """host, allowed, pattern: of the files, a row for each rule that counts for the agent. A host's file is short."""
    status, body = F.col("http_status"), F.coalesce("body", F.lit(""))
    closed = responses.where(status.isNull() | (status >= 500)).select("host", F.lit(False).alias("allowed"), F.lit("/").alias("pattern"))
    files = responses.where((status < 400) & ~body.rlike("(?i)<html|<!doctype"))
    text = F.regexp_replace(body, "^﻿", "")
    lines = files.select("host", F.posexplode(F.split(text, "\r\n|\r|\n")).alias("at", "line")).withColumn("line", F.trim(F.regexp_replace("line", "#.*$", "")))
    form = r"^([A-Za-z-]+)\s*:\s*(.*)$"
    said = lines.select("host", "at", F.lower(F.regexp_extract("line", form, 1)).alias("field"), F.trim(F.regexp_extract("line", form, 2)).alias("value")).where(F.col("field").isin("user-agent", "allow", "disallow"))
    by = Window.partitionBy("host").orderBy("at")
    opens = (F.col("field") == "user-agent") & (F.coalesce(F.lag("field").over(by), F.lit("")) != "user-agent")
    said = said.withColumn("opens", opens.cast("int")).withColumn("group", F.sum("opens").over(by)).where("group > 0")
    name, named = F.lower("value"), F.col("field") == "user-agent"
    own = named & (name != "*") & (name != "") & F.lit(agent.lower()).contains(name)
    whole, every = Window.partitionBy("host", "group"), Window.partitionBy("host")
    said = said.withColumns({"own": F.max(own).over(whole), "all": F.max(named & (name == "*")).over(whole), "any_own": F.max(own).over(every)})
    counted = said.where(~named & (F.col("value") != "") & F.when(F.col("any_own"), F.col("own")).otherwise(F.col("all")))
    return counted.select("host", (F.col("field") == "allow").alias("allowed"), F.col("value").alias("pattern")).unionByName(closed)


def judged(urls: DataFrame, responses: DataFrame, agent: str, url: str = "url") -> DataFrame:
    """urls with allowed; what is on a host whose answer isn't known isn't."""
    path = F.regexp_replace(F.regexp_replace(url, r"(?i)^https?://[^/?#]+", ""), "#.*$", "")
    rows = urls.withColumns({"__url": F.col(url), "__host": tx.host(F.col(url)), "__path": F.when(path == "", "/").otherwise(path)})
    # each URL of each host once, with the host's few rules
    asked = rows.select("__url", "__host", "__path").distinct()
    met = asked.join(rules(responses, agent).withColumnRenamed("host", "__host"), "__host").where(F.regexp_like("__path", tx.robots_regex(F.col("pattern"))))
    best = met.groupBy("__url").agg(F.max(F.struct(F.length("pattern").alias("n"), "allowed")).alias("best"))
    known = responses.select(F.col("host").alias("__host"), F.lit(True).alias("__known")).distinct()
    out = rows.join(known, "__host", "left").join(best, "__url", "left")
    return out.withColumn("allowed", F.col("__known").isNotNull() & F.coalesce("best.allowed", F.lit(True))).drop("__url", "__host", "__path", "__known", "best")
