"""Line deduplication by site-relative frequency.

Pages are grouped by host. A line's frequency is the number of the host's pages
that contain it (a page counts once) over the number of the host's pages; lines
above ``ratio`` are boilerplate of that host and are dropped from its pages.

Scale. Frequencies are two grouped counts, combined before the shuffle, so a
host with a third of all pages costs no more per page than any other. A host
has at most (lines per page / ratio) boilerplate lines, so they fit one row;
pages meet that row by one join on the host (a broadcast if the rows' counted
bytes allow it) and whole pages are not taken apart and put together again: the
page's own boilerplate lines are a hashed intersection, linear in both lists.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import col, fresh, small, staged

BROADCAST_BYTES = 16 << 20

# Tags that end a line of text.
_BLOCK = (r"(?i)</?(?:address|article|aside|blockquote|body|br|dd|div|dl|dt|footer|form|h[1-6]|head|header|hr|html|li|"
          r"main|nav|ol|option|p|pre|section|table|td|th|title|tr|ul)(?:[\s/][^>]*)?>")
_STEPS = ((r"(?is)<!--.*?-->", ""), (r"(?is)<script[^>]*>.*?</script>", ""), (r"(?is)<style[^>]*>.*?</style>", ""),
          (_BLOCK, "\n"), (r"<[^>]*>", ""))


def html_text(html: Column) -> Column:
    """Text of a page, a line per block element; null stays null."""
    for pattern, put in _STEPS:
        html = F.regexp_replace(html, pattern, put)
    return html


def host_of(url: Column) -> Column:
    """Lower-cased host of a URL; null or a URL without one gives ''."""
    return F.lower(F.coalesce(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1), F.lit("")))


def lines_of(text: Column) -> Column:
    """Lines with blanks collapsed, without empty ones; null has none."""
    lines = F.transform(F.split(F.coalesce(text, F.lit("")), "\n"), lambda s: F.trim(F.regexp_replace(s, r"\s+", " ")))
    return F.filter(lines, lambda s: s != "")


def drop_boilerplate(pages: DataFrame, host_col: str, text_col: str, ratio: float = 0.2, min_pages: int = 1) -> DataFrame:
    """``pages`` with ``n_lines``, ``n_dropped`` and ``kept_text`` appended (an
    underscore is added to a name that is taken).

    A line goes if more than ``ratio`` of its host's pages, and more than one,
    have it; hosts of any size count, unless ``min_pages`` asks for more pages. Null hosts are
    one host of their own; null and empty texts have no lines but count as
    pages; every row is a page, also if it repeats; long lines are kept whole.
    """
    if not 0 < ratio < 1:
        raise ValueError("ratio must lie between 0 and 1")
    out = fresh(pages, "n_lines", "n_dropped", "kept_text")
    lines, host_key, common = fresh(pages, "lines", "host_key", "common")
    rows = pages.withColumn(lines, lines_of(col(text_col)))
    seen = rows.select(col(host_col).alias("host"), F.explode(F.array_distinct(F.col(lines))).alias("line"))
    seen = seen.groupBy("host", "line").agg(F.count("*").alias("n")).filter("n > 1")
    size = pages.groupBy(col(host_col).alias("of")).agg(F.count("*").alias("pages"))
    size = small(staged(size.filter(F.col("pages") >= min_pages), "hosts"))
    often = seen.join(size, F.col("host").eqNullSafe(F.col("of"))).filter(F.col("n") > F.col("pages") * ratio)
    often = often.groupBy("of").agg(F.collect_list("line").alias(common)).withColumnRenamed("of", host_key)
    often = staged(often, "boilerplate")
    size = often.agg(F.sum(F.octet_length(F.array_join(common, "\n"))), F.count("*")).first()
    if (size[0] or 0) <= BROADCAST_BYTES and size[1] <= 200_000:
        often = F.broadcast(often)
    joined = rows.join(often, col(host_col).eqNullSafe(F.col(host_key)), "left")
    joined = joined.withColumn(common, F.array_intersect(lines, F.coalesce(common, F.array().cast("array<string>"))))
    joined = joined.withColumn(out[2], F.filter(F.col(lines), lambda s: ~F.array_contains(F.col(common), s)))
    return joined.select(*[col(c) for c in pages.columns], F.size(lines).cast("long").alias(out[0]),
                         (F.size(lines) - F.size(out[2])).cast("long").alias(out[1]),
                         F.array_join(F.col(out[2]), "\n").alias(out[2]))
