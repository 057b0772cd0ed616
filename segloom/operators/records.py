"""Shaping of records: flattening, cleaning, duplicates by key."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def flatten_children(df: DataFrame, children: str, inherit: dict[str, Column]) -> DataFrame:
    """P1. One row for each element of ``children`` with its fields and the inherited columns.

    Rows of which an inherited value is null (a document without a source) are dropped.
    """
    rows = df.withColumns(inherit).where(reduce(lambda a, b: a & b, (F.col(c).isNotNull() for c in inherit), F.lit(True)))
    return rows.select(*inherit, F.explode(children).alias("__c")).select(*inherit, "__c.*")


def normalize_key(c: Column | str) -> Column:
    """P3. Trimmed, without one leading colon, ``_`` as ``#``, blank as null."""
    c = F.trim(F.col(c) if isinstance(c, str) else c)
    return F.when(F.length(c) > 0, F.translate(F.regexp_replace(c, "^:", ""), "_", "#"))


def clean_number(c: Column | str, kind: str) -> Column:
    """P4. NaN as null, then the cast."""
    c = F.col(c) if isinstance(c, str) else c
    return F.when(~F.isnan(c), c).cast(kind)


def first_non_null(df: DataFrame, keys: list[str], columns: list[str], order_by: str) -> DataFrame:
    """P5. For each key the first non-null value of each column in this order."""
    return df.groupBy(*keys).agg(*(F.min_by(c, F.when(F.col(c).isNotNull(), F.col(order_by))).alias(c) for c in columns))


def join_with_status(left: DataFrame, right: DataFrame, on: list[str], how: str = "left", labels: tuple[str, str, str] = ("matched", "metrics_only", "lanes_only"), status: str = "join_status") -> DataFrame:
    """P6. A join with a label: in both, left only, right only."""
    a, b = left.withColumn("__l", F.lit(True)), right.withColumn("__r", F.lit(True))
    label = F.when(F.col("__l") & F.col("__r"), labels[0]).when(F.col("__l"), labels[1]).otherwise(labels[2])
    return a.join(b, on, how).withColumn(status, label).drop("__l", "__r")


def dedup_fill(df: DataFrame, keys: list[str], fill_cols: list[str], order_by: str) -> DataFrame:
    """P7. The first row of each key; later rows only fill its blanks (null or '') in ``fill_cols``."""
    w = Window.partitionBy(*keys).orderBy(order_by)
    whole = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    filled = {c: F.coalesce(F.first(F.nullif(F.col(c), F.lit("")), ignorenulls=True).over(whole), F.col(c)) for c in fill_cols}
    return df.withColumns({**filled, "__r": F.row_number().over(w)}).where("__r = 1").drop("__r")


def tag_filter(tags: Column | str, any_of: dict[str, list[str]]) -> Column:
    """P12. Whether one of the tags has one of its values."""
    tags = F.col(tags) if isinstance(tags, str) else tags
    return F.coalesce(reduce(lambda a, b: a | b, (F.coalesce(F.try_element_at(tags, F.lit(k)).isin(v), F.lit(False)) for k, v in any_of.items())), F.lit(False))


def first_tag(tags: Column | str, keys: list[str]) -> Column:
    """P12, N7. The first of the tags that is neither missing nor blank."""
    tags = F.col(tags) if isinstance(tags, str) else tags
    return F.coalesce(*(F.nullif(F.try_element_at(tags, F.lit(k)), F.lit("")) for k in keys))


def latest_only(df: DataFrame, time_col: str) -> DataFrame:
    """P11. Rows at the latest time, by an uncorrelated scalar subquery."""
    latest = df.agg(F.max(time_col).alias("__latest"))
    return df.join(F.broadcast(latest), F.col(time_col) == F.col("__latest")).drop("__latest")  # one row


def lag_diff(df: DataFrame, part: str | list[str], order: str, column: str, out: str = "diff") -> DataFrame:
    """W1. Difference from the row before in each part; null in the first."""
    return df.withColumn(out, F.col(column) - F.lag(column).over(Window.partitionBy(part).orderBy(order)))
