"""Change-aware upserts, change sets and incremental mapping."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def one_per_key(source: DataFrame, keys: list[str], order_by: str | None) -> DataFrame:
    """The last row of each key in this order; without an order, keys that repeat are an error."""
    if order_by is None:
        repeated = F.raise_error(F.lit("a key comes twice in the source: give order_by"))
        n = F.count("*").over(Window.partitionBy(*keys))
        return source.withColumn("__n", n).where(F.when(F.col("__n") > 1, repeated.cast("boolean")).otherwise(True)).drop("__n")
    w = Window.partitionBy(*keys).orderBy(F.col(order_by).desc_nulls_last())
    return source.withColumn("__r", F.row_number().over(w)).where("__r = 1").drop("__r")


def _differs(columns: list[str]) -> Column:
    return reduce(lambda a, b: a | b, (~F.col(f"t.{c}").eqNullSafe(F.col(f"s.{c}")) for c in columns), F.lit(False))


def _joined(target: DataFrame, source: DataFrame, keys: list[str]) -> DataFrame:
    t, s = target.withColumn("__t", F.lit(True)).alias("t"), source.withColumn("__s", F.lit(True)).alias("s")
    return t.join(s, reduce(lambda a, b: a & b, (F.col(f"t.{k}").eqNullSafe(F.col(f"s.{k}")) for k in keys)), "full_outer")


def _as_target(c: str, target: DataFrame, source: DataFrame) -> Column:
    """The source's value in the target's type; types that differ in nullability only need no cast."""
    kind = target.schema[c].dataType
    return F.col(f"s.{c}") if source.schema[c].dataType.simpleString() == kind.simpleString() else F.col(f"s.{c}").cast(kind)


def upsert_status(target: DataFrame, source: DataFrame, keys: list[str], columns: list[str] | None = None, order_by: str | None = None) -> DataFrame:
    """U1. The new table with ``change``: inserted, updated, unchanged or kept (not in the source).

    A row counts as updated only if one of the columns is distinct; nulls equal nulls. Columns that the source
    lacks keep their value, and are null in inserted rows.
    """
    source = one_per_key(source, keys, order_by)
    common = columns or [c for c in target.columns if c in source.columns and c not in keys]
    both = _joined(target, source, keys)
    change = F.when(F.col("t.__t").isNull(), "inserted").when(F.col("s.__s").isNull(), "kept").when(_differs(common), "updated").otherwise("unchanged")

    def value(c: str) -> Column:
        if c in keys:
            return F.coalesce(f"t.{c}", f"s.{c}")
        if c not in common:
            return F.col(f"t.{c}")
        return F.when(F.col("s.__s").isNull(), F.col(f"t.{c}")).otherwise(_as_target(c, target, source))

    return both.select(*(value(c).alias(c) for c in target.columns), change.alias("change"))


def upsert_changed(target: DataFrame, source: DataFrame, keys: list[str], columns: list[str] | None = None, order_by: str | None = None) -> DataFrame:
    """U1, U4. Insert new keys, update rows that differ, leave the rest; over the columns that both have."""
    return upsert_status(target, source, keys, columns, order_by).drop("change")


def upsert_counts(target: DataFrame, source: DataFrame, keys: list[str], order_by: str | None = None) -> DataFrame:
    """(inserted, updated, unchanged) in one row."""
    s = upsert_status(target, source, keys, None, order_by)
    return s.agg(*(F.count_if(F.col("change") == c).alias(c) for c in ("inserted", "updated", "unchanged")))


def insert_ignore(target: DataFrame, source: DataFrame, keys: list[str], order_by: str | None = None) -> DataFrame:
    """U3. Rows of the source whose key is new are added; the others are ignored."""
    new = one_per_key(source, keys, order_by).join(target.select(*keys), keys, "left_anti")
    return target.unionByName(new.select(*target.columns))


def upsert(target: DataFrame, source: DataFrame, keys: list[str], update_columns: list[str], order_by: str | None = None) -> DataFrame:
    """U5. Insert new keys; in rows of known keys set exactly the listed columns."""
    source = one_per_key(source, keys, order_by)
    both = _joined(target, source, keys)

    def value(c: str) -> Column:
        if c in keys:
            return F.coalesce(f"t.{c}", f"s.{c}")
        if c not in source.columns:
            return F.col(f"t.{c}")
        fresh = F.col("t.__t").isNull()
        if c in update_columns:
            fresh = fresh | F.col("s.__s").isNotNull()
        return F.when(fresh, _as_target(c, target, source)).otherwise(F.col(f"t.{c}"))

    return both.select(*(value(c).alias(c) for c in target.columns))


def content_hash(geom: Column | str, *columns: Column | str, precision: int = 7) -> Column:
    """U8. md5 (16 bytes) of a line's rounded coordinates and of further columns; null counts as ''."""
    geom = F.col(geom) if isinstance(geom, str) else geom
    pairs = F.transform(geom, lambda p: F.concat_ws(" ", F.round(p["x"], precision).cast("string"), F.round(p["y"], precision).cast("string")))
    parts = [F.array_join(pairs, ","), *((F.col(c) if isinstance(c, str) else c).cast("string") for c in columns)]
    joined: list[Column] = []
    for p in parts:
        joined += [F.lit("|"), F.coalesce(p, F.lit(""))]
    return F.unhex(F.md5(F.concat(*joined[1:])))


def change_set(old: DataFrame, new: DataFrame, keys: list[str], hash_col: str = "content_hash", id_col: str = "id") -> DataFrame:
    """U10. (base_id, keys..., op) of added, removed and modified rows."""
    both = _joined(old, new, keys)
    op = F.when(F.col("t.__t").isNull(), "added").when(F.col("s.__s").isNull(), "removed").when(~F.col(f"t.{hash_col}").eqNullSafe(F.col(f"s.{hash_col}")), "modified")
    out = both.select(F.coalesce(f"s.{id_col}", f"t.{id_col}").alias("base_id"), *(F.coalesce(f"s.{k}", f"t.{k}").alias(k) for k in keys), op.alias("op"))
    return out.where(F.col("op").isNotNull())


def refresh_base(current: DataFrame, source: DataFrame, keys: list[str], hash_col: str, derive: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """U9. The base brought to the source's rows: ``derive`` runs on new and changed rows only, others keep all
    their columns, rows that the source lacks go."""
    same = current.join(source.select(*keys, hash_col), [*keys, hash_col], "left_semi")
    changed = derive(source.join(current.select(*keys, hash_col), [*keys, hash_col], "left_anti"))
    return same.unionByName(changed.select(*current.columns))


def delete_missing(target: DataFrame, source: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of the target whose key the source has."""
    return target.join(source.select(*keys), keys, "left_semi")


def incremental_map(mapping: DataFrame, base: DataFrame, changes: DataFrame, mapper: Callable[[DataFrame], DataFrame], base_id: str = "id", map_id: str = "way_id", aggregating: bool = False) -> DataFrame:
    """U13. Mapping rows of removed and modified segments go; added and modified segments are mapped anew.

    Refused for a mapper that aggregates over segments, as its other rows would be stale.
    """
    if aggregating:
        raise ValueError("a mapping that aggregates can't be brought up to date by parts")
    gone = changes.where(F.col("op").isin("removed", "modified")).select(F.col("base_id").alias(map_id))
    fresh = base.join(changes.where(F.col("op").isin("added", "modified")).select(F.col("base_id").alias(base_id)), base_id, "left_semi")
    return mapping.join(gone, map_id, "left_anti").unionByName(mapper(fresh).select(*mapping.columns))
