"""Boilerplate lines by their frequency on their own site."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from survista.llm.common import materialise


def _lines(text: Column) -> Column:
    return F.split(text, "\n", -1)


def boilerplate(docs: DataFrame, host_col: str = "source", text_col: str = "text", ratio: float = 0.01,
                min_pages: int = 5, once: bool = False) -> DataFrame:
    """(host, line, pages, host_pages): lines that stand on more than ``ratio`` of their host's pages, and on
    ``min_pages`` at least. A row is a page, or with ``once`` a text of the host, told apart by its SHA-256: exact copies
    are one page. A line counts once a page; empty lines do not count. A null host is a host.

    Lines are first counted by a 64-bit hash and by row, which merges counts but loses none; those that pass are counted
    again by the line itself, and by text with ``once``. All counts are partial before they are shuffled, so neither a
    common line, a large host nor a large group of copies gathers rows in one task.
    """
    page = F.sha2(F.col(text_col).cast("string"), 256).alias("page")
    line = F.explode(F.array_distinct(F.filter(_lines(F.col(text_col).cast("string")), lambda x: x != ""))).alias("line")
    each = docs.select(F.col(host_col).alias("host"), line, *([page] if once else []))
    pages = docs.select(F.col(host_col).alias("host"), *([page] if once else []))
    totals = (pages.distinct() if once else pages).groupBy("host").agg(F.count("*").alias("host_pages"))
    if once:
        totals = materialise(totals, "lines-pages")

    def over(counted: DataFrame) -> DataFrame:
        t = totals.select(F.col("host").alias("total_host"), "host_pages")
        few = counted.filter(F.col("pages") >= min_pages)
        return (few.join(t, few["host"].eqNullSafe(t["total_host"])).drop("total_host")
                .filter(F.col("pages") > F.lit(float(ratio)) * F.col("host_pages")))

    hashed = each.select("host", F.xxhash64("line").alias("hash")).groupBy("host", "hash").agg(F.count("*").alias("pages"))
    maybe = materialise(over(hashed).select(F.col("host").alias("maybe_host"), "hash"), "lines-maybe")
    known = each.join(maybe, each["host"].eqNullSafe(maybe["maybe_host"]) & (F.xxhash64("line") == maybe["hash"]), "left_semi")
    if once:
        known = known.select("host", "line", "page").distinct()
    return over(known.groupBy("host", "line").agg(F.count("*").alias("pages")))


def drop_boilerplate(docs: DataFrame, host_col: str = "source", text_col: str = "text", ratio: float = 0.01,
                     min_pages: int = 5, counts: tuple[str, str] | None = None, once: bool = False) -> DataFrame:
    """``docs`` with the boilerplate lines of each row's host cut out of its text; all rows and columns stay.

    A host has at most (lines of its mean page) / ``ratio`` such lines, so the list that joins its pages is bounded
    whatever its number of pages. A null text stays null; a text of boilerplate only becomes empty; other lines and
    empty lines keep their order. Repeated rows are pages of their own, or one page with ``once``. An empty table stays
    empty.
    ``counts``: names of two columns to add, the lines of a text and those dropped.
    """
    found = boilerplate(docs, host_col, text_col, ratio, min_pages, once)
    lists = materialise(found.groupBy("host").agg(F.collect_set("line").alias("lines")), "lines")
    lists = lists.select(F.col("host").alias("__boiler_host"), F.col("lines").alias("__boiler_lines"))
    joined = docs.join(lists, docs[host_col].eqNullSafe(lists["__boiler_host"]), "left")
    every = _lines(F.col(text_col))
    stay = F.filter(every, lambda x: ~F.array_contains("__boiler_lines", x))
    kept = F.when(F.col("__boiler_lines").isNull(), F.col(text_col)).otherwise(F.array_join(stay, "\n"))
    extra = []
    if counts:
        n = F.when(F.col(text_col).isNull(), 0).otherwise(F.size(every))
        gone = F.when(F.col(text_col).isNull() | F.col("__boiler_lines").isNull(), 0).otherwise(n - F.size(stay))
        extra = [n.alias(counts[0]), gone.alias(counts[1])]
    return joined.select(*[kept.alias(c) if c == text_col else docs[c] for c in docs.columns], *extra)


SQL = """
WITH l AS (SELECT doc_id, source, text, string_split(text, chr(10)) AS lines FROM documents),
h AS (SELECT source, count(*) AS n FROM documents GROUP BY source),
u AS (SELECT source, unnest(list_distinct(list_filter(lines, lambda x: x <> ''))) AS line FROM l),
c AS (SELECT source, line, count(*) AS pages FROM u GROUP BY source, line),
s AS (SELECT c.source, list(line) AS drops FROM c JOIN h ON c.source IS NOT DISTINCT FROM h.source
      WHERE pages >= {min_pages} AND pages > CAST({ratio} AS DOUBLE) * n GROUP BY c.source)
SELECT doc_id, l.source AS source,
       CASE WHEN drops IS NULL THEN text
            ELSE array_to_string(list_filter(lines, lambda x: NOT list_contains(drops, x)), chr(10)) END AS text,
       CAST(coalesce(len(lines), 0) AS INTEGER) AS n_lines,
       CAST(CASE WHEN text IS NULL OR drops IS NULL THEN 0
            ELSE len(list_filter(lines, lambda x: list_contains(drops, x))) END AS INTEGER) AS n_dropped
FROM l LEFT JOIN s ON l.source IS NOT DISTINCT FROM s.source
"""
