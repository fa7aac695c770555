"""Line dedup by site-relative frequency.

Of each host, the share of its pages that contain a line is taken; lines on more than `ratio` of them are boilerplate
there and are dropped from all its pages. A line on a single page repeats nothing, whatever its share: `least_pages` is 2.
Blank lines are layout: they are neither counted nor dropped. A page whose lines are all boilerplate loses them all,
unless `keep_whole` asks for pages that are copies throughout to stay as they are.

Lines are the parts of a text between line feeds. Null text counts as a page without lines and stays null, an empty one
has one blank line. A null host is a host like any other. A page that occurs twice counts twice. A share that equals the
ratio is not over it. Lines are keyed by 128 bits of digest. Columns beside page, host and text are kept as they are.

What is counted is pages by (host, line), so a host with most of the pages spreads over all tasks; the join back is
salted, because a line that many pages contain is what this looks for. Which lines go from a page is told by their
positions, looked up as a hashed set, so that a long page costs in proportion to its lines.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

RATIO, LEAST_PAGES, SALTS = 0.05, 2, 16
_ROW = ["_page", "_host", "_text"]


def _lines(text: F.Column) -> F.Column:
    return F.split(text, "\n", -1)


def _key(line: F.Column) -> F.Column:
    return F.unhex(F.md5(line))


def _solid(line: F.Column) -> F.Column:
    return F.trim(F.translate(line, "\t\r", "  ")) != ""


def _rows(pages: DataFrame) -> DataFrame:
    """Pages by what tells their texts apart, and their lines: rows that agree in all three have equal lines."""
    return pages.select(F.col("page").alias("_page"), F.col("host").alias("_host"), F.xxhash64("text").alias("_text"), _lines(F.col("text")).alias("_lines"))


def occurrences(pages: DataFrame) -> DataFrame:
    """(host, key): a row for each page and distinct line, blank ones left out."""
    lines = pages.select("host", F.explode(F.array_distinct(_lines(F.col("text")))).alias("line"))
    return lines.where(_solid(F.col("line"))).select("host", _key(F.col("line")).alias("key"))


def boilerplate(pages: DataFrame, ratio: float = RATIO, least_pages: int = LEAST_PAGES) -> DataFrame:
    """(host, key, pages_with, host_pages) of the lines to drop."""
    totals = pages.groupBy("host").agg(F.count("*").alias("host_pages"))
    counts = occurrences(pages).groupBy("host", "key").agg(F.count("*").alias("pages_with")).where(F.col("pages_with") >= least_pages)
    both = counts.alias("c").join(totals.alias("t"), F.expr("c.host <=> t.host"))
    return both.where(F.col("pages_with") > F.lit(ratio) * F.col("host_pages")).select("c.host", "key", "pages_with", "host_pages")


def drop_boilerplate(pages: DataFrame, ratio: float = RATIO, least_pages: int = LEAST_PAGES, keep_whole: bool = False) -> DataFrame:
    """pages (page, host, text and more) with n_lines, n_dropped and the text without its boilerplate."""
    marked = boilerplate(pages, ratio, least_pages).select(
        F.col("host").alias("b_host"), F.col("key").alias("b_key"), F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("b_salt")
    )
    placed = _rows(pages).select(*_ROW, F.posexplode("_lines").alias("_at", "_line")).where(_solid(F.col("_line")))
    salted = placed.select(*_ROW, "_at", _key(F.col("_line")).alias("_key"), F.pmod(F.xxhash64("_page", "_at"), F.lit(SALTS)).cast("int").alias("_salt"))
    hits = salted.join(marked, F.expr("_key = b_key and _salt = b_salt and _host <=> b_host"), "left_semi")
    drops = hits.groupBy(*_ROW).agg(F.collect_set("_at").alias("_drop")).withColumnsRenamed({c: f"{c}_d" for c in _ROW})
    joined = pages.withColumn("_h", F.xxhash64("text")).join(drops, F.expr("page <=> _page_d and host <=> _host_d and _h = _text_d"), "left").drop("_h", *(f"{c}_d" for c in _ROW))
    lines = _lines(F.col("text"))
    out = joined.withColumn("n_lines", F.coalesce(F.size(lines), F.lit(0)))
    stay = F.array_except(F.sequence(F.lit(0), F.col("n_lines") - 1), F.col("_drop"))
    out = out.withColumn("_kept", F.when(F.col("_drop").isNotNull(), F.transform(stay, lambda i: F.get(lines, i))))
    if keep_whole:
        out = out.withColumn("_kept", F.when(F.exists("_kept", _solid), F.col("_kept")))
    return (
        out.withColumn("n_dropped", F.when(F.col("_kept").isNull(), 0).otherwise(F.col("n_lines") - F.size("_kept")))
        .withColumn("text", F.when(F.col("_kept").isNull(), F.col("text")).otherwise(F.array_join("_kept", "\n")))
        .drop("_kept", "_drop")
    )
