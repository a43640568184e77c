"""Ordered-row operators: first-wins dedup, forward fill, islands, header search, unpivot."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def ordered(partition: list[str], order: list) -> Window:
    return Window.partitionBy(*partition).orderBy(*order)


def first_wins(df: DataFrame, key: list[str], order: list) -> DataFrame:
    """The first row of every key in ``order``; unlike dropDuplicates, always the same one."""
    return df.withColumn("__nth", F.row_number().over(ordered(key, order))).where("__nth = 1").drop("__nth")


def island(df: DataFrame, partition: list[str], order: list, starts: Column, name: str = "island") -> DataFrame:
    """Number the runs of rows; a row that ``starts`` one begins the next (rows before the first are run 0)."""
    upto = ordered(partition, order).rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumn(name, F.sum(F.when(starts, 1).otherwise(0)).over(upto))


def fill_down(df: DataFrame, partition: list[str], order: list, columns: list[str], reset: Column | None = None,
              receives: Column | None = None) -> DataFrame:
    """Carry the last non-blank value down.

    ``reset`` rows clear what is carried; only rows that satisfy ``receives``
    take it, others keep their blank.  Blank is null or ''.
    """
    held = df if reset is None else island(df, partition, order, reset, "__run")
    keys = partition if reset is None else [*partition, "__run"]
    upto = ordered(keys, order).rowsBetween(Window.unboundedPreceding, 0)
    out = {}
    for c in columns:
        own = F.nullif(F.col(c), F.lit("")) if dict(df.dtypes)[c] == "string" else F.col(c)
        filled = F.coalesce(own, F.last(own, ignorenulls=True).over(upto))
        out[c] = filled if receives is None else F.when(receives, filled).otherwise(own)
    return held.withColumns(out).drop("__run")


def header_row(cells: DataFrame, sheet: list[str], row: str, text: str, required: list[str], within: int = 10) -> DataFrame:
    """(sheet, header_row): the first of a sheet's first rows whose texts contain all ``required``."""
    rows = cells.where(F.col(row) <= within).groupBy(*sheet, row).agg(F.collect_set(text).alias("__texts"))
    whole = F.size(F.array_except(F.array(*map(F.lit, required)), "__texts")) == 0
    return rows.where(whole).groupBy(*sheet).agg(F.min(row).alias("header_row"))


def unpivot_filled(df: DataFrame, ids: list[str], columns: list[str], name: str, value: str) -> DataFrame:
    """Columns to rows; blanks give none."""
    return df.unpivot(ids, columns, name, value).where(F.col(value).isNotNull() & (F.col(value).cast("string") != ""))


def argmax_first(df: DataFrame, group: list[str], item: str, score: str) -> DataFrame:
    """Per group the item of the highest score, ties to the smallest item."""
    return df.groupBy(*group).agg(F.min_by(item, F.struct((-F.col(score)).alias("s"), F.col(item).alias("i"))).alias(item), F.max(score).alias(score))


def next_distinct(df: DataFrame, partition: list[str], order: list, value: str, name: str) -> DataFrame:
    """Runs of equal values folded to their first row, with the next run's value."""
    w = ordered(partition, order)
    changed = df.withColumn("__new", ~F.col(value).eqNullSafe(F.lag(value).over(w)) | F.lag(F.lit(1)).over(w).isNull()).where("__new")
    return changed.withColumn(name, F.lead(value).over(w)).drop("__new")


def absorb(df: DataFrame, partition: list[str], order: list, is_anchor: Column, text: str) -> DataFrame:
    """Anchors with the texts of the other rows next to them.

    A row that is no anchor goes to the nearest anchor before it and to the one after it;
    between two it goes to both.
    """
    w = ordered(partition, order)
    upto, onward = w.rowsBetween(Window.unboundedPreceding, 0), w.rowsBetween(0, Window.unboundedFollowing)
    anchor = F.when(is_anchor, F.col("__at"))
    placed = (df.withColumn("__at", F.row_number().over(w)).withColumn("__is", is_anchor)
              .withColumn("__back", F.last(anchor, ignorenulls=True).over(upto)).withColumn("__next", F.first(anchor, ignorenulls=True).over(onward)))
    rest = (placed.where("NOT __is").select(*partition, "__at", text, F.explode(F.array_distinct(F.array_compact(F.array("__back", "__next")))).alias("__to"))
            .groupBy(*partition, "__to").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("__at", text))), lambda s: s[text]), " ").alias("absorbed")))
    keys = [F.col(f"a.{p}").eqNullSafe(F.col(f"r.{p}")) for p in partition]
    joined = placed.where("__is").alias("a").join(rest.alias("r"), [*keys, F.col("a.__at") == F.col("r.__to")], "left")
    return joined.select("a.*", F.coalesce("r.absorbed", F.lit("")).alias("absorbed")).drop("__at", "__is", "__back", "__next")
