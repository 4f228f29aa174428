"""Lines that a site repeats on too many of its pages, dropped by DataFrame operations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegrid.llm.ordering import wrapped
from tidegrid.session import broadcast_if_small, materialize

#: A line goes if it is on more than this share of the pages of its host. A line of a single page repeats nothing.
MAX_SHARE = 0.3
MIN_PAGES = 2


def host_of(url: Column) -> Column:
    """Host of a URL in lower case, without user and port; empty where there is none."""
    host = F.regexp_extract(F.lower(url), r"^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:@]*)", 1)
    return F.coalesce(host, F.lit(""))


def html_lines(html: Column) -> Column:
    """Lines of a page: text between block elements and line ends, without tags and outer spaces."""
    hidden = F.regexp_replace(html, r"(?is)<(script|style)[^>]*>.*?</(script|style)>|<!--.*?-->", " ")
    blocks = F.regexp_replace(
        hidden, r"(?i)</?(p|div|li|ul|ol|nav|br|h[1-6]|tr|td|th|table|article|section|header|footer|title|head|body)[^a-z0-9>]*[^>]*>", "\n"
    )
    plain = F.regexp_replace(blocks, r"<[^>]*>", "")
    lines = F.transform(F.split(plain, "\n"), lambda x: F.regexp_replace(x, r"^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$", ""))
    return F.filter(F.coalesce(lines, F.array().cast("array<string>")), lambda x: x != "")


def site_lines(pages: DataFrame, host: Column, lines: Column, max_share: float = MAX_SHARE, min_pages: int = MIN_PAGES) -> DataFrame:
    """``(host, line_hash, pages, host_pages)`` for every line that counts as boilerplate on a host.

    A page counts once for a line however often the line is on it. Lines are told apart by MD5.
    """
    rows = pages.select(host.alias("host"), F.array_distinct(lines).alias("lines"))
    totals = rows.groupBy("host").agg(F.count("*").alias("host_pages"))
    each = rows.select("host", F.explode("lines").alias("line")).select("host", F.unhex(F.md5("line")).alias("line_hash"))
    counts = each.groupBy("host", "line_hash").agg(F.count("*").alias("pages")).where(F.col("pages") >= min_pages)
    joined = counts.join(totals, counts["host"].eqNullSafe(totals["host"])).drop(totals["host"])
    return joined.where(F.col("pages") > F.lit(max_share) * F.col("host_pages"))


def drop_site_lines(
    pages: DataFrame, host: Column, lines: Column | str, max_share: float = MAX_SHARE, min_pages: int = MIN_PAGES
) -> DataFrame:
    """``pages`` with ``host``, ``kept_lines`` and ``n_lines``: the lines that its host does not repeat.

    The share of a line is the number of pages of the host that have it, divided by all pages of the
    host. Lines on more than ``max_share`` of the pages go wherever they are on the host,
    if at least ``min_pages`` pages have them; the others stay in order, repeated or not. Null
    hosts are one host. Null lines count as no lines; a page without lines counts for its host.
    Each row is a page of its own, repeated or not. Columns named like the result's are replaced.

    Lines are worked out once and written beside the other columns; given by the name of a column, they are
    written only once. A host has at most (lines of a page) / ``max_share`` such lines on average, so they are kept in
    one row for each host.
    """
    own = lines if isinstance(lines, str) else None
    pages_in = pages.drop("host", "kept_lines", "n_lines")
    given = F.coalesce(F.col(f"`{own}`") if own else lines, F.array().cast("array<string>"))
    rest = pages_in.drop(own) if own else pages_in
    rows = pages.select(wrapped(rest), host.alias("_host"), given.alias("_lines"))
    rows = materialize(rows, "lines")
    found = site_lines(rows, F.col("_host"), F.col("_lines"), max_share, min_pages)
    by_host = materialize(
        found.groupBy(F.col("host").alias("_of")).agg(F.collect_list("line_hash").alias("_drop")), "sitelines"
    )
    joined = rows.join(broadcast_if_small(by_host)[0], F.col("_host").eqNullSafe(F.col("_of")), "left")
    stays = F.filter("_lines", lambda x: ~F.array_contains(F.col("_drop"), F.unhex(F.md5(x))))
    kept = F.when(F.col("_drop").isNull(), F.col("_lines")).otherwise(stays)
    done = joined.select("_doc", "_host", "_lines", kept.alias("_kept"))
    named = [F.col("_lines" if c == own else f"_doc.`{c}`").alias(c) for c in pages_in.columns]
    return done.select(
        *named, F.col("_host").alias("host"), F.col("_kept").alias("kept_lines"), F.size("_lines").cast("long").alias("n_lines")
    )
