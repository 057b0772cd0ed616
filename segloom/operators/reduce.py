"""REDUCE: what the matched rows of a base segment become."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def reduce_agg(pairs: DataFrame, base_id: str | list[str], aggs: dict[str, Column | str]) -> DataFrame:
    """R2, R6, R11, R12. Aggregates of each base row's pairs under the given names."""
    keys = [base_id] if isinstance(base_id, str) else base_id
    return pairs.groupBy(*keys).agg(*((F.expr(a) if isinstance(a, str) else a).alias(n) for n, a in aggs.items()))


def collected(value: Column | str, order: Column | str | None = None, where: Column | None = None, keep_nulls: bool = False) -> Column:
    """R4, W6. Array of values in this order (default: of the values); no rows give an empty array.

    Null values are left out; with keep_nulls an unmatched row adds its null, as the array aggregates of
    PostgreSQL do.
    """
    value = F.col(value) if isinstance(value, str) else value
    order = value if order is None else F.col(order) if isinstance(order, str) else order
    use = F.lit(True) if where is None else where
    if not keep_nulls:
        use = use & value.isNotNull()
    items = F.collect_list(F.when(use, F.struct(order.alias("o"), value.alias("v"))))
    return F.transform(F.array_sort(items), lambda s: s["v"])


def json_list(value: Column | str, order: Column | str | None = None, where: Column | None = None, keep_nulls: bool = False) -> Column:
    """R3, R5. The same as JSON text; no rows give ``[]``. Null fields of objects stay, as JSON builders keep them."""
    return F.to_json(collected(value, order, where, keep_nulls), {"ignoreNullFields": "false"})


def _weight(distance: str, power: float, epsilon: float) -> Column:
    return 1 / F.pow(F.greatest(F.col(distance), F.lit(epsilon)), power)


def idw(pairs: DataFrame, base_id: str, values: list[str], power: float = 2, epsilon: float = 0.001, skip_null_weights: bool = False, distance: str = "distance") -> DataFrame:
    """R8, R10. (base_id, values..., nearest_distance): means weighted by inverse distance.

    A null value adds nothing above the line but keeps its weight below it; skip_null_weights leaves that out.
    """
    if not values:
        raise ValueError("inverse distance weighting needs value columns")
    if distance not in pairs.columns:
        raise ValueError("inverse distance weighting needs the distances of a nearest match")
    w = _weight(distance, power, epsilon)
    out = []
    for v in values:
        below = F.sum(F.when(F.col(v).isNotNull(), w)) if skip_null_weights else F.sum(w)
        out.append(F.try_divide(F.sum(F.col(v) * w), below).alias(v))
    return pairs.groupBy(base_id).agg(*out, F.min(distance).alias("nearest_distance"))


def idw_arrays(pairs: DataFrame, base_id: str, arrays: list[str], power: float = 2, epsilon: float = 0.001, distance: str = "distance") -> DataFrame:
    """R9. The same for each place of the arrays; the longest array of a base row gives the length.

    One grouping, no row for each place. A neighbour takes part up to its longest array; one with a null array doesn't.
    """
    if not arrays:
        raise ValueError("inverse distance weighting needs array columns")
    whole = F.col(arrays[0]).isNotNull()
    for a in arrays[1:]:
        whole = whole & F.col(a).isNotNull()
    length = F.greatest(F.lit(0), *(F.size(a) for a in arrays))
    near = F.struct(_weight(distance, power, epsilon).alias("w"), length.alias("n"), *(F.col(a).alias(f"a{i}") for i, a in enumerate(arrays)))
    grouped = pairs.groupBy(base_id).agg(F.collect_list(F.when(whole & (length > 0), near)).alias("near"), F.min(distance).alias("nearest_distance"))
    places = F.sequence(F.lit(0), F.array_max(F.transform("near", lambda s: s["n"])) - 1)

    def mean(i: int):
        def at(place: Column) -> Column:
            above = F.aggregate("near", F.lit(None).cast("double"), lambda t, s: F.coalesce(t + F.get(s[f"a{i}"], place) * s["w"], t, F.get(s[f"a{i}"], place) * s["w"]))
            below = F.aggregate("near", F.lit(0.0), lambda t, s: t + F.when(place < s["n"], s["w"]).otherwise(0.0))
            return F.try_divide(above, below)

        return F.transform(places, at)

    return grouped.where(F.size("near") > 0).select(base_id, *(mean(i).alias(a) for i, a in enumerate(arrays)), "nearest_distance")
