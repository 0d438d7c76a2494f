"""Caps, samples, splits and folds that are exact, repeatable and free of large groups.

Random order is the order of ``sha2(seed | key)``. Exact sizes come from *cuts*: the value below
which the wanted number of rows of a group lies. A cut needs only the narrow order column, which
is counted in slices first; the one slice that holds the cut is then ranked. Texts are not
shuffled: rows are compared with the cut of their group.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskloom.session import staged

Quota = Callable[[Column], Column]
Order = str | Sequence[str]


def hash_order(key: Column, seed: int = 42) -> Column:
    return F.sha2(F.concat(F.lit(f"{seed}|"), key.cast("string")), 256)


def fraction_cut(fraction: float) -> str:
    """Eight hex digits below which the given fraction of hashes lies."""
    return f"{min(round(fraction * 2**32), 2**32 - 1):08x}"


def in_fraction(order: Column, fraction: float) -> Column:
    return F.substring(order, 1, 8) < F.lit(fraction_cut(fraction)) if fraction < 1 else F.lit(True)


def _matches(keys: Sequence[str], suffix: str) -> Column:
    return reduce(lambda a, b: a & b, [F.col(key).eqNullSafe(F.col(key + suffix)) for key in keys])


def _suffixed(df: DataFrame, keys: Sequence[str], suffix: str) -> DataFrame:
    return df.withColumnsRenamed({key: key + suffix for key in keys})


def _order_of(order: Order) -> Column:
    return F.col(order) if isinstance(order, str) else F.struct(*order)


def cuts(df: DataFrame, keys: Sequence[str], order: Order, quotas: Mapping[str, Quota]) -> DataFrame:
    """(keys, name, cut): per group and named quota, the order value of the quota's last row.

    A quota maps the group's row count to the wanted number; where that is 0 there is no cut.
    ``order`` is a hex hash, or any column or list of columns that can be sorted.
    """
    keys = list(keys)
    narrow = df.select(*keys, _order_of(order).alias("_order"))
    if dict(narrow.dtypes)["_order"] == "string":
        sliced = narrow.withColumn("_slice", F.substring("_order", 1, 3))
    else:
        # Ranges hold equally many rows, whatever the values look like; they are written so that all steps see the same ones.
        ranged = narrow.repartitionByRange(*keys, "_order").withColumn("_slice", F.spark_partition_id())
        sliced = staged(ranged, "order-slices")
    counted = sliced.groupBy(*keys, "_slice").agg(F.count(F.lit(1)).alias("_n"))
    group = Window.partitionBy(*keys)
    running = group.orderBy("_slice").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    summed = counted.withColumns({"_upto": F.sum("_n").over(running), "_rows": F.sum("_n").over(group)})
    wanted = F.array(*[F.struct(F.lit(name).alias("name"), quota(F.col("_rows")).cast("bigint").alias("q")) for name, quota in quotas.items()])
    placed = (
        summed.select(*keys, "_slice", (F.col("_upto") - F.col("_n")).alias("_before"), "_upto", "_rows", F.inline(wanted))
        .withColumn("q", F.least("q", "_rows"))
        .filter((F.col("_before") < F.col("q")) & (F.col("q") <= F.col("_upto")))
    )
    targets = _suffixed(staged(placed.select(*keys, "_slice", "_before", "name", "q"), "cut-slices"), [*keys, "_slice"], "_t")
    inside = sliced.join(targets, _matches([*keys, "_slice"], "_t"))
    place = F.row_number().over(Window.partitionBy(*keys, "name").orderBy("_order"))
    hit = inside.withColumn("_place", place).filter(F.col("_place") == F.col("q") - F.col("_before"))
    return hit.select(*keys, "name", F.col("_order").alias("cut"))


def below_cut(df: DataFrame, keys: Sequence[str], order: Order, quotas: Mapping[str, Quota]) -> DataFrame:
    """Add one flag per quota: whether the row is among the first rows of its group."""
    per_group = [F.max(F.when(F.col("name") == flag, F.col("cut"))).alias(f"_cut_{flag}") for flag in quotas]
    table = staged(cuts(df, keys, order, quotas).groupBy(*keys).agg(*per_group), "cuts")
    if keys:
        joined = df.join(_suffixed(table, keys, "_c"), _matches(keys, "_c"), "left")
    else:
        joined = df.withColumns({f"_cut_{flag}": table.select(f"_cut_{flag}").scalar() for flag in quotas})
    flags = {flag: F.coalesce(_order_of(order) <= F.col(f"_cut_{flag}"), F.lit(False)) for flag in quotas}
    return joined.withColumns(flags).drop(*[f"_cut_{flag}" for flag in quotas], *[key + "_c" for key in keys])


def first_rows(df: DataFrame, keys: Sequence[str], order: Order, limit: int) -> DataFrame:
    """First ``limit`` rows of each group in file order.

    ``order`` may repeat for rows that stem from one raw record; such a record is kept whole, so
    the cap may overshoot as it does in the cleaner.
    """
    return below_cut(df, keys, order, {"_keep": lambda rows: F.lit(limit)}).filter("_keep").drop("_keep")


def class_balanced_cap(df: DataFrame, limit: int, order: Order, label: str = "is_vulnerable", keys: Sequence[str] = ("source",)) -> DataFrame:
    """At most half of ``limit`` rows per class and source, in file order."""
    return first_rows(df, [*keys, label], order, limit // 2)


def balanced_undersample(df: DataFrame, key: str, cap: int = 500, seed: int = 42, label: str = "is_vulnerable") -> DataFrame:
    """Equally many rows of both classes: the smaller class size, at most ``cap``."""
    ordered = df.withColumn("_order", hash_order(F.col(key), seed))
    sizes = ordered.agg(F.least(F.count_if(F.col(label) == 0), F.count_if(F.col(label) == 1), F.lit(cap)).alias("n")).first()["n"]
    return first_rows(ordered, [label], "_order", int(sizes)).drop("_order")


def stratified_flags(df: DataFrame, key: str, fractions: Mapping[str, float], seed: int = 42, label: str = "is_vulnerable") -> DataFrame:
    """One flag per fraction for the first ``round(f * n)`` rows of each class in hash order."""
    ordered = df.withColumn("_order", hash_order(F.col(key), seed))
    quotas = {flag: (lambda rows, f=f: F.round(rows * f)) for flag, f in fractions.items()}
    return below_cut(ordered, [label], "_order", quotas).drop("_order")


def stratified_split(
    df: DataFrame, key: str, test_fraction: float, seed: int = 42, label: str = "is_vulnerable", exact: bool = True, flag: str = "is_test"
) -> DataFrame:
    """Mark the test rows. Exact: ``round(f * n)`` of each class. Otherwise a map-only threshold."""
    if exact:
        return stratified_flags(df, key, {flag: test_fraction}, seed, label)
    return df.withColumn(flag, in_fraction(hash_order(F.col(key), seed), test_fraction))


def three_way_split(df: DataFrame, key: str, valid: float = 0.1, test: float = 0.1, seed: int = 42, label: str = "is_vulnerable") -> DataFrame:
    """Stratified train / valid / test in one ``split`` column."""
    ordered = df.withColumn("_order", hash_order(F.col(key), seed))
    quotas = {"_test": lambda rows: F.round(rows * test), "_held": lambda rows: F.round(rows * test) + F.round(rows * valid)}
    split = F.when(F.col("_test"), F.lit("test")).when(F.col("_held"), F.lit("valid")).otherwise(F.lit("train"))
    return below_cut(ordered, [label], "_order", quotas).withColumn("split", split).drop("_order", "_test", "_held")


def group_split(df: DataFrame, group: str, test_fraction: float, seed: int = 42, exact: bool = False, flag: str = "is_test") -> DataFrame:
    """Mark test rows so that no group is on both sides; the fraction is one of groups.

    By threshold this is a map-only column. ``exact`` takes ``ceil(f * groups)`` groups: only the
    distinct group hashes are ranked, and rows are compared with the one cut value.
    """
    ordered = df.withColumn("_order", hash_order(F.col(group), seed))
    if not exact:
        return ordered.withColumn(flag, in_fraction(F.col("_order"), test_fraction)).drop("_order")
    groups = ordered.select("_order").distinct()
    cut = cuts(groups, [], "_order", {flag: lambda rows: F.ceil(rows * test_fraction)}).select("cut").scalar()
    return ordered.withColumn(flag, F.coalesce(F.col("_order") <= cut, F.lit(False))).drop("_order")


def folds(df: DataFrame, key: str, k: int = 5, seed: int = 42, name: str = "fold") -> DataFrame:
    """Fold number from the hash of the key: map-only, and the same on every run."""
    digits = F.conv(F.substring(hash_order(F.col(key), seed), 1, 8), 16, 10).cast("bigint")
    return df.withColumn(name, F.pmod(digits, F.lit(k)).cast("int"))


def fraction(df: DataFrame, key: str, share: float, seed: int = 42) -> DataFrame:
    return df.filter(in_fraction(hash_order(F.col(key), seed), share))


def preview(df: DataFrame, key: str, rows: int = 3, chars: int = 300, seed: int = 42, code: str = "raw_code") -> DataFrame:
    """A few rows in hash order with the start of their text."""
    picked = df.orderBy(hash_order(F.col(key), seed)).limit(rows)
    return picked.withColumn("preview", F.substring(code, 1, chars)).drop(code)


def shuffled(df: DataFrame, key: str, seed: int = 42) -> DataFrame:
    """Rows in hash order, by range partitioning."""
    return df.orderBy(hash_order(F.col(key), seed))
