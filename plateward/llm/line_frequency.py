"""Line dedup by the frequency of a line within its site.

Per host: the share of its pages that hold a line. A line on more than ``RATIO``
of them, and on ``MIN_PAGES`` at least, is boilerplate and goes from every page
of that host. Several times on one page counts once.

How many lines a host can lose is bounded: each takes a share ``RATIO`` of the
pages, so there are at most (distinct lines of a mean page) / ``RATIO``. So each
host's boilerplate is one short array of hashes, and pages meet it in one join
by host, which moves each page once. Pages of a host are dealt to ``SALTS``
partitions, each with a copy of the array, so a hot host isn't one task.

Defined results: a page without a host belongs to no site and keeps all lines.
NULL or empty HTML has no lines and gives an empty text. Repeated rows count as
pages and are all returned. Empty tables give empty results. Only the named columns are read,
so others cannot clash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

RATIO = 0.3
MIN_PAGES = 2
SALTS = 32

# What separates lines in HTML, what is no text, and how a host is written.
NO_TEXT = r"(?is)<!--.*?-->|<script\b.*?</script\s*>|<style\b.*?</style\s*>"
LINE_END = (
    r"(?i)</?(?:p|div|br|li|ul|ol|h[1-6]|tr|td|th|table|nav|header|footer|article|section|title|head|body|html|"
    r"pre|blockquote|main|aside|form)\b[^>]*>"
)
TAG = r"<[^>]*>"
HOST = r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)"


def host(url: Column) -> Column:
    """The lower-case host of a URL; NULL where there is none."""
    return F.nullif(F.lower(F.regexp_extract(url, HOST, 1)), F.lit(""))


def page_lines(html: Column) -> Column:
    """The text lines of a page: trimmed, without mark-up, none empty."""
    text = F.regexp_replace(F.coalesce(html, F.lit("")), NO_TEXT, "")
    text = F.regexp_replace(F.regexp_replace(text, LINE_END, "\n"), TAG, "")
    lines = F.transform(F.split(text, r"[\r\n]+"), lambda line: F.trim(F.regexp_replace(line, r"[ \t]+", " ")))
    return F.array_remove(lines, "")


def hashes(lines: Column) -> Column:
    return F.transform(lines, lambda line: F.xxhash64(line))


def boilerplate(pages: DataFrame, ratio: float = RATIO, min_pages: int = MIN_PAGES) -> DataFrame:
    """Per host with any: ``boilerplate``, the sorted hashes of its lines above the ratio.

    ``pages`` has ``host`` and ``lines``. Both counts are partial sums before
    the shuffle, so a hot host costs no task more than another.
    """
    sited = pages.where(F.col("host").isNotNull())
    totals = sited.groupBy("host").agg(F.count("*").alias("host_pages"))
    holding = (
        sited.select("host", F.explode(F.array_distinct(hashes(F.col("lines")))).alias("line"))
        .groupBy("host", "line")
        .agg(F.count("*").alias("line_pages"))
        .where(F.col("line_pages") >= min_pages)
    )
    return (
        holding.join(totals, "host")
        .where(F.col("line_pages") > ratio * F.col("host_pages"))
        .groupBy("host")
        .agg(F.sort_array(F.collect_list("line")).alias("boilerplate"))
    )


def without_boilerplate(
    pages: DataFrame,
    ratio: float = RATIO,
    min_pages: int = MIN_PAGES,
    id_column: str = "page_id",
    url_column: str = "url",
    html_column: str = "html",
) -> DataFrame:
    """Per page: id, ``host``, ``n_lines``, ``n_dropped``, ``n_kept`` and the cleaned ``text``."""
    lined = pages.select(
        F.col(id_column).alias("id"),
        host(F.col(url_column)).alias("host"),
        page_lines(F.col(html_column)).alias("lines"),
    )
    found = boilerplate(lined, ratio, min_pages)
    none = F.array().cast("array<bigint>")
    kept = F.filter("lines", lambda line: ~F.array_contains("boilerplate", F.xxhash64(line)))
    salts = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt")
    salted = lined.withColumn("salt", F.pmod(F.xxhash64("id", "lines"), F.lit(SALTS)).cast("int"))
    return (
        salted.join(found.select("*", salts), ["host", "salt"], "left")
        .withColumn("boilerplate", F.coalesce("boilerplate", none))
        .withColumn("kept", kept)
        .select(
            F.col("id").alias(id_column),
            "host",
            F.size("lines").cast("bigint").alias("n_lines"),
            (F.size("lines") - F.size("kept")).cast("bigint").alias("n_dropped"),
            F.size("kept").cast("bigint").alias("n_kept"),
            F.array_join("kept", "\n").alias("text"),
        )
    )
