"""Pages, robots rules and location files, parsed by workers; and outcome classes of requests."""

from __future__ import annotations

import re
from collections.abc import Iterator
from html.parser import HTMLParser
from urllib.parse import urljoin

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Elements without an end tag. Fixed values.
_VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
#: Keys of a location file. Fixed values.
LOCATION_KEYS = ("location-name", "source-page-url", "mrf-url", "contact-name", "contact-email")


class _Anchors(HTMLParser):
    def __init__(self, base: str):
        super().__init__(convert_charrefs=True)
        self.base, self.found, self.open, self.stack = base, [], None, []

    def handle_starttag(self, tag, attrs):
        a = dict(attrs)
        if tag == "base" and a.get("href"):
            self.base = urljoin(self.base, a["href"])
        if tag == "a" and a.get("href"):
            self.open = [a["href"], [], a.get("aria-label") or a.get("title") or ""]
        if tag not in _VOID:
            marks = f"{a.get('id') or ''} {a.get('class') or ''}".lower()
            self.stack.append((tag, tag == "footer" or a.get("role") == "contentinfo" or "footer" in marks))

    def handle_endtag(self, tag):
        if tag == "a" and self.open:
            href, text, label = self.open
            self.open = None
            if not re.match(r"(?i)(javascript|mailto|tel|data):|#", href.strip()):
                seen = " ".join("".join(text).split())
                self.found.append((urljoin(self.base, href.strip()), seen or " ".join(label.split()), any(f for _, f in self.stack)))
        # an end tag closes the last element of its name and what stands open in it; a stray one closes nothing
        for i in range(len(self.stack) - 1, -1, -1):
            if self.stack[i][0] == tag:
                del self.stack[i:]
                break

    def handle_data(self, data):
        if self.open:
            self.open[1].append(data)


def anchors(html: str | None, base: str) -> list[tuple[str, str, bool]]:
    """(absolute URL, text or else its label or title, in an element that is or names itself a footer) of a page's links."""
    parser = _Anchors(base)
    parser.feed(html or "")
    parser.close()
    return parser.found


def links(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """A row for each link of each page: page_id, link, text, in_footer."""
    kind = pages.schema[page_id].dataType.simpleString()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = [(i, *a) for i, u, h in zip(b["i"], b["u"], b["h"], strict=True) for a in anchors(h, u or "")]
            yield pd.DataFrame(rows, columns=["page_id", "link", "text", "in_footer"])

    return pages.select(F.col(page_id).alias("i"), F.col(url).alias("u"), F.col(html).alias("h")).mapInPandas(run, f"page_id {kind}, link string, text string, in_footer boolean")


def price_tier(text: Column) -> Column:
    """1 for the words of a price page, 2 for words that count only where a page has no such link, else null."""
    return F.when(text.rlike(r"(?i)pric(e|ing)\s*transparency"), 1).when(text.rlike(r"(?i)standard\s*charges|chargemaster"), 2)


def price_links(found: DataFrame) -> DataFrame:
    """Of each page's links (page_id, link, text, in_footer) those of its best tier, without fragments and repeats: page_id, link, text, in_footer; one in the footer stands for its repeats."""
    ranked = found.withColumn("tier", price_tier(F.col("text"))).where("tier is not null").withColumn("link", F.regexp_replace("link", "#.*$", ""))
    best = F.min("tier").over(Window.partitionBy("page_id"))
    kept = ranked.withColumn("best", best).where("tier = best")
    one = F.min(F.struct((~F.col("in_footer")).alias("outside"), "text")).alias("one")
    return kept.groupBy("page_id", "link").agg(one).select("page_id", "link", "one.text", (~F.col("one.outside")).alias("in_footer"))


def is_data_link(link: Column) -> Column:
    """A URL that has the name of a price file in it, or whose path ends like a data file."""
    path = F.regexp_replace(link, "[?#].*$", "")
    return link.rlike(r"(?i)_standardcharges\.(csv|json)") | path.rlike(r"(?i)\.(csv|json|zip)$")


def robots(text: str, agent: str) -> list[tuple[bool, str]]:
    """(allowed, pattern) of the groups for an agent, else of those for all."""
    groups: dict[str, list[tuple[bool, str]]] = {}
    names: list[str] = []
    ruled = True
    for line in text.lstrip("﻿").splitlines():
        key, _, value = line.split("#", 1)[0].partition(":")
        key, value = key.strip().lower(), value.strip()
        if key == "user-agent":
            names = [value.lower()] if ruled else [*names, value.lower()]
            ruled = False
            groups.setdefault(value.lower(), [])
        elif key in ("allow", "disallow"):
            ruled = True
            if value:
                for n in names:
                    groups[n].append((key == "allow", value))
    own = [n for n in groups if n != "*" and n and n in agent.lower()]
    return groups[max(own, key=len)] if own else groups.get("*", [])


def path_allowed(rules: list[tuple[bool, str]], path: str) -> bool:
    """By the longest pattern that matches; of equal ones the allowing."""
    fits = [(len(p), ok) for ok, p in rules if re.match(re.escape(p).replace(r"\*", ".*").replace(r"\$", "$") if p.endswith("$") else re.escape(p).replace(r"\*", ".*"), path)]
    return max(fits)[1] if fits else True


def locations(text: str) -> list[dict[str, str | None]]:
    """Entries of a location file: key and value lines; a repeated key or location-name begins the next entry."""
    out: list[dict[str, str | None]] = []
    now: dict[str, str | None] = {}
    for line in text.lstrip("﻿").splitlines():
        key, colon, value = line.partition(":")
        key = re.sub(r"[\s_]+", "-", key.strip().lower())
        if not colon or key not in LOCATION_KEYS:
            continue
        if key in now:
            out.append(now)
            now = {}
        now[key] = value.strip() or None
    if now:
        out.append(now)
    return [{k: e.get(k) for k in LOCATION_KEYS} for e in out]


def location_rows(files: DataFrame, key: str, text: str) -> DataFrame:
    """A row for each entry of each location file."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = [(k, n + 1, *e.values()) for k, t in zip(b["k"], b["t"], strict=True) for n, e in enumerate(locations(t or ""))]
            yield pd.DataFrame(rows, columns=["key", "entry", *(c.replace("-", "_") for c in LOCATION_KEYS)])

    cols = ", ".join(f"{c.replace('-', '_')} string" for c in LOCATION_KEYS)
    return files.select(F.col(key).cast("string").alias("k"), F.col(text).alias("t")).mapInPandas(run, f"key string, entry int, {cols}")


def outcome(status: Column, message: Column) -> Column:
    """Class of a request by its status, or by the error where there is none."""
    m = F.lower(F.coalesce(message, F.lit("")))
    answered = F.when(status.between(200, 299), "ok").when(status.isin(404, 410), "not_found").when(status.isin(401, 403), "blocked").otherwise("http_error")
    failed = F.when(m.rlike("timeout|timed out"), "timeout").when(m.rlike("resolve|name or service|getaddrinfo"), "dns_fail").when(m.rlike("ssl|tls|certificate"), "tls_fail").otherwise("network_error")
    return F.when(status.isNotNull(), answered).otherwise(failed)


def extra_urls(cell: Column) -> Column:
    """URLs of a cell that holds a JSON list or values with separators."""
    return F.filter(F.split(F.regexp_replace(cell, r'[\[\]"]', " "), r"[;|\s]+|,\s*(?=https?:)"), lambda u: u.rlike("^https?://"))
