"""Declarative enrichment operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import geo


def _expr(c: Column | str) -> Column:
    return F.expr(c) if isinstance(c, str) else c


def _set(df: DataFrame, target: str, value: Column, condition: Column | str | None) -> DataFrame:
    """Rows that fail the condition (or leave it null) keep the old value, null if the column is new."""
    if condition is None:
        return df.withColumn(target, value)
    old = F.col(target) if target in df.columns else F.lit(None)
    return df.withColumn(target, F.when(_expr(condition), value).otherwise(old))


def derive(df: DataFrame, target: str, expression: Column | str, condition: Column | str | None = None) -> DataFrame:
    """E4. A column from a row expression."""
    return _set(df, target, _expr(expression), condition)


def make_point(enr: DataFrame, stg: DataFrame, x: str, y: str, target: str, on: str | list[str], condition: Column | str | None = None) -> DataFrame:
    """E1. Points from two staging columns; rows without a staging row keep the old value."""
    keys = [on] if isinstance(on, str) else on
    found = stg.select(*keys, geo.point(x, y).alias("__p"), F.lit(True).alias("__found"))
    joined = enr.join(found, keys, "left")
    use = F.col("__found") if condition is None else F.col("__found") & _expr(condition)
    return _set(joined, target, F.col("__p"), use).drop("__p", "__found")


def reproject(df: DataFrame, source: str, target: str, from_srid: int, to_srid: int, condition: Column | str | None = None) -> DataFrame:
    """E2. Null geometries are skipped: they leave the target as it is."""
    kind = geo.kind_of(df.schema[source].dataType)
    use = F.col(source).isNotNull() if condition is None else F.col(source).isNotNull() & _expr(condition)
    return _set(df, target, geo.reproject(source, from_srid, to_srid, kind), use)


def snap_to_grid(df: DataFrame, source: str, target: str, cell: float, condition: Column | str | None = None) -> DataFrame:
    """E3."""
    return _set(df, target, geo.snap(source, cell, geo.kind_of(df.schema[source].dataType)), condition)


def normalize(df: DataFrame, source: str, target: str, method: str = "minmax", condition: Column | str | None = None) -> DataFrame:
    """E5. Table-wide min-max or z-score; the condition limits the update, not the statistics; no spread gives null."""
    if method == "minmax":
        stats = df.agg(F.min(source).cast("double").alias("__a"), (F.max(source) - F.min(source)).cast("double").alias("__b"))
    elif method == "zscore":
        stats = df.agg(F.avg(source).alias("__a"), F.stddev_pop(source).alias("__b"))
    else:
        raise ValueError(f"method is minmax or zscore, not {method}")
    joined = df.crossJoin(F.broadcast(stats))  # one row
    return _set(joined, target, F.try_divide(F.col(source) - F.col("__a"), F.col("__b")), condition).drop("__a", "__b")


_FUNCTIONS = {"avg": F.avg, "sum": F.sum, "count": F.count, "max": F.max, "min": F.min}


def _aggregates(aggs: dict[str, tuple[str, Column | str]]) -> list[Column]:
    for f, _ in aggs.values():
        if f not in _FUNCTIONS:
            raise ValueError(f"unknown aggregate {f}")
    return [_FUNCTIONS[f](F.lit(1) if c == "*" else _expr(c)).alias(n) for n, (f, c) in aggs.items()]


def aggregate(src: DataFrame, group_by: dict[str, Column | str], aggs: dict[str, tuple[str, Column | str]], where: Column | str | None = None) -> DataFrame:
    """E6. Groups by expressions; aggs: name to (avg, sum, count, max or min, expression). No group: one row."""
    rows = src if where is None else src.where(_expr(where))
    return rows.groupBy(*(_expr(e).alias(n) for n, e in group_by.items())).agg(*_aggregates(aggs))


def spatial_aggregate(src: DataFrame, geom: str, cell: float, aggs: dict[str, tuple[str, Column | str]], where: Column | str | None = None, target: str = "geometry") -> DataFrame:
    """E7. Points snapped to a grid and grouped in one pass."""
    return aggregate(src, {target: geo.snap(geom, cell)}, aggs, where)


def cast_output(df: DataFrame, spec: dict[str, str]) -> DataFrame:
    """E10. The listed columns in their types; a column that df lacks is null. Fractions are rounded before integers."""

    def one(name: str, kind: str) -> Column:
        if name not in df.columns:
            return F.lit(None).cast(kind)
        whole = kind in ("int", "integer", "bigint", "long") and df.schema[name].dataType.typeName() in ("double", "float")
        return (F.round(F.col(name)) if whole else F.col(name)).cast(kind)

    return df.select(*(one(n, k).alias(n) for n, k in spec.items()))


def hourly_rollup(df: DataFrame, key: str, start_ns: str, avgs: list[str], sums: list[str], maxes: list[str]) -> DataFrame:
    """E11. Slots to hours: hour is the start in nanoseconds, divided whole by one hour."""
    hour = F.expr(f"`{start_ns}` div 3600000000000").alias("hour")
    return df.groupBy(key, hour).agg(*(F.avg(c).alias(c) for c in avgs), *(F.sum(c).alias(c) for c in sums), *(F.max(c).alias(c) for c in maxes))


def json_unpack(df: DataFrame, json_col: str, fields: dict[str, tuple[str, str]]) -> DataFrame:
    """E12. out: (key, type) columns from a JSON object; blank text is null, unreadable numbers too."""
    return df.withColumns({n: F.nullif(F.get_json_object(json_col, f"$.{k}"), F.lit("")).try_cast(t) for n, (k, t) in fields.items()})


def relabel(column: Column | str, labels: dict[str, str]) -> Column:
    """E13. Known values renamed, others kept, blank null."""
    c = F.col(column) if isinstance(column, str) else column
    out = None
    for a, b in labels.items():
        out = F.when(c == a, b) if out is None else out.when(c == a, b)
    return (F.nullif(c, F.lit("")) if out is None else out.otherwise(F.nullif(c, F.lit(""))))


def band(column: Column | str, bands: list[tuple[float, str]], default: str) -> Column:
    """E13. The first band whose lower bound the value reaches (bounds of 0 must be exceeded), else the default."""
    c = F.col(column) if isinstance(column, str) else column
    out = F.lit(default)
    for low, name in sorted(bands):
        out = F.when((c > low) if low == 0 else (c >= low), name).otherwise(out)
    return out


def fill_missing(df: DataFrame, target: str, value: Column | str) -> DataFrame:
    """E15. The value where the target is null."""
    return df.withColumn(target, F.coalesce(F.col(target), _expr(value)))
