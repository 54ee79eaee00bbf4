"""Line dedup by site-relative frequency.

For every host the pages that hold a line are divided by all pages of the host.
Lines above the ratio are boilerplate of that host and go from all its pages.

DataFrame functions only. Lines are counted by two 64-bit hashes, once a page and
combined before the shuffle. A host has at most (mean lines of a page / ratio)
boilerplate lines, so their list is one small row a host. The lists are written and
joined to the pages by host: below Spark's threshold they are sent to the pages, which
stay where they are; beyond it pages are shuffled by host, and as both sides come from
files, adaptive execution is free to split a host with a third of all pages. Lines are
not shuffled again. A line needs ``min_pages`` pages, so that a host with one page keeps it.

A line is what stands between line feeds, compared as it is; empty lines are
never boilerplate. A null text or host: the row stays as it is. Repeated rows are
pages each. A line at the ratio stays, so no ties are broken. Texts of any length are
cut whole. An empty table gives an empty result. Other columns stay, but the four of the result win over
columns of the same name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from stationflow.llm.staging import staged
from stationflow.operators.skew import one_per_key

#: Share of a host's pages beyond which a line is boilerplate, and pages it needs at least.
RATIO, MIN_PAGES = 0.1, 3


def _hash(line: Column) -> Column:
    return F.struct(F.xxhash64(line).alias("a"), F.xxhash64(F.lit(7), line).alias("b"))


def drop_boilerplate(pages: DataFrame, text_col: str = "text", host: Column | None = None, ratio: float = RATIO, min_pages: int = MIN_PAGES) -> DataFrame:
    """``pages`` with ``text_col`` cut, and ``n_lines``, ``n_dropped``. ``host`` is ``source`` if not given."""
    host = F.col("source") if host is None else host
    lines = F.split(F.col(text_col), "\n", -1)
    seen = pages.select(host.alias("_host"), F.array_distinct(F.transform(F.filter(lines, lambda x: x != ""), _hash)).alias("_lines"))
    totals = one_per_key(seen.filter("_host IS NOT NULL"), ["_host"], F.count("*").alias("_pages"))
    counts = seen.filter("_host IS NOT NULL").select("_host", F.explode("_lines").alias("_line")).groupBy("_host", "_line").agg(F.count("*").alias("_n")).filter(F.col("_n") >= min_pages)
    common = counts.join(totals, "_host").filter(F.col("_n") > F.lit(ratio) * F.col("_pages"))
    # Written, so that the join is planned on their true size: small lists go to the pages, which then aren't shuffled.
    lists = staged(common.groupBy("_host").agg(F.collect_list("_line").alias("_common")), "boilerplate")
    joined = pages.withColumn("_host", host).join(lists, "_host", "left")
    kept = F.filter(lines, lambda x: (x == "") | ~F.array_contains(F.col("_common"), _hash(x)))
    joined = joined.withColumn("_kept", F.when(F.col("_common").isNull(), lines).otherwise(kept))
    out = joined.withColumn("n_lines", F.coalesce(F.size(lines), F.lit(0)).cast("long"))
    out = out.withColumn("n_lines", F.when(F.col(text_col).isNull(), 0).otherwise(F.col("n_lines")))
    out = out.withColumn("n_dropped", F.when(F.col(text_col).isNull(), 0).otherwise(F.col("n_lines") - F.size("_kept")).cast("long"))
    return out.withColumn(text_col, F.when(F.col("_common").isNull(), F.col(text_col)).otherwise(F.array_join("_kept", "\n"))).drop("_host", "_common", "_kept")


def boilerplate_sql(table: str, ratio: float = RATIO, min_pages: int = MIN_PAGES) -> str:
    """The same rows (doc_id, source, n_lines, n_dropped, text) in SQL."""
    return f"""
    WITH cut AS (SELECT *, string_split(text, chr(10)) AS lines FROM {table}),
    totals AS (SELECT source, count(*) AS pages FROM {table} WHERE source IS NOT NULL GROUP BY source),
    seen AS (SELECT source, unnest(list_distinct(lines)) AS line FROM cut WHERE source IS NOT NULL),
    common AS (
        SELECT source, line FROM (SELECT source, line, count(*) AS n FROM seen WHERE line <> '' GROUP BY source, line)
        JOIN totals USING (source) WHERE n >= {min_pages} AND n > CAST({ratio} AS DOUBLE) * pages
    ),
    lists AS (SELECT source, list(line) AS common FROM common GROUP BY source),
    kept AS (
        SELECT doc_id, cut.source, text, lines,
               CASE WHEN common IS NULL THEN lines ELSE list_filter(lines, lambda x: NOT list_contains(common, x)) END AS kept
        FROM cut LEFT JOIN lists ON cut.source = lists.source
    )
    SELECT doc_id, source, coalesce(len(lines), 0) AS n_lines, coalesce(len(lines) - len(kept), 0) AS n_dropped,
           CASE WHEN text IS NULL THEN NULL ELSE array_to_string(kept, chr(10)) END AS text
    FROM kept
    """
