"""Report operators: counters per source, top-k with examples, run delta, batches."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def source_counts(sources: DataFrame, rows: DataFrame, key: str, counters: dict[str, Column]) -> DataFrame:
    """Every source with its counters; 0 where it has no rows."""
    counted = rows.groupBy(key).agg(*[c.alias(n) for n, c in counters.items()])
    return sources.join(counted, key, "left").fillna(0, list(counters))


def top_elements(df: DataFrame, group: list[str], array: str, k: int, name: str) -> DataFrame:
    """The k most frequent array elements of each group, ties by name."""
    counts = df.select(*group, F.explode(array).alias(name)).groupBy(*group, name).agg(F.count("*").alias("n"))
    w = Window.partitionBy(*group).orderBy(F.desc("n"), name)
    return counts.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def top_with_examples(df: DataFrame, group: list[str], array: str, example: str, order: list[str], k: int, name: str, sep: str = " | ") -> DataFrame:
    """Counts of array elements per group, each with its first k examples.

    Only k rows a group survive the window (a rank-limited one, pruned before the
    shuffle), so no list of all rows is ever held.
    """
    each = df.select(*group, F.explode(array).alias(name), F.col(example).alias("__x"), F.struct(*order).alias("__o"))
    counts = each.groupBy(*group, name).agg(F.count("*").alias("n"))
    w = Window.partitionBy(*group, name).orderBy("__o")
    few = each.withColumn("__nth", F.row_number().over(w)).where(F.col("__nth") <= k)
    shown = few.groupBy(*group, name).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("__nth", "__x"))), lambda s: s["__x"]), sep).alias("excerpts"))
    return counts.join(shown, [*group, name])


def delta(old: DataFrame, new: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """new - old per key; a key that one side lacks counts 0 there."""
    o = old.select(F.col(key), *[F.col(c).alias(f"__{c}") for c in columns])
    return new.join(o, key, "full_outer").select(key, *[(F.coalesce(c, F.lit(0)) - F.coalesce(f"__{c}", F.lit(0))).alias(f"{c}_delta") for c in columns])


def select_sources(rows: DataFrame, wanted: DataFrame, key: str) -> DataFrame:
    return rows.join(wanted.select(key).distinct(), key, "left_semi")


def most_common(df: DataFrame, column: str, k: int) -> DataFrame:
    """The k most frequent values with counts, ties by value."""
    return df.groupBy(column).agg(F.count("*").alias("n")).orderBy(F.desc("n"), column).limit(k)


def batches(sources: DataFrame, key: str, size: int) -> DataFrame:
    """Sources dealt in order to batches of ``size``; one row a source, so one task numbers them."""
    return sources.withColumn("batch", F.floor((F.row_number().over(Window.orderBy(key)) - 1) / size).cast("int"))


def first_strategy(tries: dict[str, Column], none: str = "none") -> Column:
    """The name of the first strategy that yields something."""
    return F.coalesce(*[F.when(c, F.lit(n)) for n, c in tries.items()], F.lit(none))
