"""URL filters with dated lists: an as-of join of captures against list entries.

A list entry names a pattern (a host or parent domain, or ``host/first-segment``),
a list, an action (``block``, ``allow`` or ``unlist``) and the time it takes
effect. Successive entries of one list and pattern become validity intervals
``[from, to)``. A capture has one key per parent domain and one for its first path
segment; an equi-join on the key with the interval as a range condition finds the
entries active at fetch time. In each list the longest pattern decides; the
capture is blocked if some list's decision is ``block``.

Keys are few per capture, so nothing is paired within a group; a key that holds a
third of all captures is split by the adaptive skew join.

Edge cases: a null or hostless URL and a null fetch time match nothing and are not
blocked; entries with a null pattern or time are ignored; of entries for the same
list, pattern and time, ``unlist`` < ``block`` < ``allow`` and the last wins; repeated captures give repeated rows
with equal results; empty tables work.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_HOST = r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]+)"
_SEGMENT = r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//[^/?#]+/([^/?#]+)"
_RANK = {"unlist": 0, "block": 1, "allow": 2}


def host_of(url: Column) -> Column:
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), _HOST, 1))


def url_keys(url: Column) -> Column:
    """The host, its parent domains of two labels or more, and ``host/segment``."""
    host = host_of(url)
    parts = F.split(host, r"\.")
    n = F.size(parts)
    parents = F.transform(F.sequence(F.lit(1), F.greatest(n - 1, F.lit(1))),
                          lambda i: F.array_join(F.slice(parts, i, n), "."))
    segment = F.regexp_extract(F.coalesce(url, F.lit("")), _SEGMENT, 1)
    return F.when(host == "", F.array().cast("array<string>")).otherwise(
        F.concat(parents, F.when(segment != "", F.array(F.concat(host, F.lit("/"), segment)))
                 .otherwise(F.array().cast("array<string>"))))


def validity(entries: DataFrame) -> DataFrame:
    """``(list_name, pattern, action, valid_from, valid_to)``; the open end is null."""
    rank = F.create_map(*[F.lit(x) for kv in _RANK.items() for x in kv])
    one = (entries.where("pattern IS NOT NULL AND effective IS NOT NULL")
           .groupBy("list_name", "pattern", "effective")
           .agg(F.max_by("action", F.element_at(rank, F.col("action"))).alias("action")))
    w = Window.partitionBy("list_name", "pattern").orderBy("effective")
    return one.select("list_name", "pattern", "action", F.col("effective").alias("valid_from"),
                      F.lead("effective").over(w).alias("valid_to")).where("action <> 'unlist'")


def filter_urls(captures: DataFrame, entries: DataFrame) -> DataFrame:
    """``(page_id, url, fetched, n_active, decided_by, blocked)`` for each capture.

    ``n_active`` counts the entries active at fetch time; ``decided_by`` lists
    ``list:pattern`` of the blocking decisions in order, empty if there are none.
    """
    spans = validity(entries)
    caps = captures.select("page_id", "url", "fetched", F.xxhash64("page_id", "url", "fetched").alias("cap"))
    keys = caps.select("cap", "fetched", F.explode(url_keys(F.col("url"))).alias("pattern")).distinct()
    active = keys.join(spans, "pattern").where(
        "valid_from <= fetched AND (valid_to IS NULL OR fetched < valid_to)")
    longest = active.groupBy("cap", "list_name").agg(
        F.max(F.struct(F.length("pattern"), "pattern", "action")).alias("top"), F.count("*").alias("n"))
    verdict = longest.groupBy("cap").agg(
        F.sum("n").alias("n_active"),
        F.array_join(F.sort_array(F.collect_list(F.when(
            F.col("top.action") == "block", F.concat("list_name", F.lit(":"), "top.pattern")))), ",").alias("decided_by"))
    return caps.join(verdict, "cap", "left").select(
        "page_id", "url", "fetched", F.coalesce("n_active", F.lit(0).cast("long")).alias("n_active"),
        F.coalesce("decided_by", F.lit("")).alias("decided_by"),
        (F.coalesce("decided_by", F.lit("")) != "").alias("blocked"))


def dated_captures(pages: DataFrame) -> DataFrame:
    """Pages with a fetch time: the crawl visits one page a minute modulo a year, from 2024-01-01."""
    minute = F.pmod(F.col("page_id") * 7919, F.lit(525_600))
    return pages.select("page_id", "url", F.expr("TIMESTAMP'2024-01-01 00:00:00'").alias("start"), minute.alias("m")).select(
        "page_id", "url", (F.col("start") + F.make_interval(mins=F.col("m").cast("int"))).alias("fetched"))


def dated_entries(pages: DataFrame) -> DataFrame:
    """A list history for the hosts of ``pages``: the MD5 of a host fixes what happened to it and when.

    ``abuse`` lists each ``spam`` or ``pills`` host at the start and others for part of the
    year; ``review`` lists hosts' parent domains in spring and allows one language section.
    """
    hosts = pages.select(host_of(F.col("url")).alias("host")).where("host <> ''").distinct()
    draw = F.conv(F.substring(F.md5("host"), 1, 7), 16, 10).cast("long")
    h = hosts.select("host", draw.alias("d"), F.regexp_extract("host", r"([^.]+\.[^.]+\.[^.]+)$", 1).alias("parent"))
    day = lambda n: F.expr("TIMESTAMP'2024-01-01 00:00:00'") + F.make_interval(days=n.cast("int"))
    bad = F.col("host").rlike("spam|pills")
    first, last = F.col("d") % 200, F.col("d") % 200 + 20 + F.col("d") % 50
    row = lambda lst, pattern, action, at: F.struct(
        F.lit(lst).alias("list_name"), pattern.alias("pattern"), F.lit(action).alias("action"), at.alias("effective"))
    rows = F.concat(
        F.when(bad, F.array(row("abuse", F.col("host"), "block", day(F.lit(0)))))
        .when(F.col("d") % 3 == 0, F.array(row("abuse", F.col("host"), "block", day(first)),
                                           row("abuse", F.col("host"), "unlist", day(last)),
                                           row("abuse", F.col("host"), "block", day(last + 60))))
        .otherwise(F.array(row("abuse", F.col("host"), "unlist", day(first)))),
        F.when((F.col("d") % 4 == 0) & (F.col("parent") != ""), F.array(
            row("review", F.col("parent"), "block", day(F.lit(60))),
            row("review", F.col("parent"), "unlist", day(F.lit(150))),
            row("review", F.concat("host", F.lit("/en")), "allow", day(F.lit(90)))))
        .otherwise(F.array(row("review", F.concat("host", F.lit("/es")), "block", day(first)))))
    return h.select(F.explode(rows).alias("r")).select("r.*")
