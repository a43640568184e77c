"""Row merges: unique-match self-join, continuation runs, incremental upsert."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabulon.operators.rows import island, ordered
from tabulon.sources.scratch import kept


def unique_match(df: DataFrame, slot: list[str], order: list[str], is_host: Column, is_guest: Column, fits: Column, fields: list[str],
                 seps: dict[str, str] | None = None, by: tuple[str, ...] = ()) -> DataFrame:
    """Guests (metadata-only rows) merge into the one host of their slot that fits.

    ``fits`` compares h.* with g.*, of the columns ``by``.  A guest with no fitting host, or with several,
    stays a row of its own.  A host takes its guests' values in order, each distinct one once, joined by the field's entry in ``seps`` or a
    semicolon; ``merged`` counts the guests.
    Hosts do not change while guests are matched, so the set form equals the row-by-row one.  Hosts and guests fold to the distinct values of
    slot and ``by``, hosts with their number; only these meet, so a slot of many rows makes no pairs of rows.  The input is
    read several times and therefore stored.
    """
    df = kept(df, "match-input")
    key, by = F.struct(*order), list(by)
    hosts = df.where(is_host).select("*", key.alias("__host"))
    guests = df.where(is_guest)
    kinds = hosts.groupBy(*slot, *by).agg(F.count("*").alias("__n"), F.min("__host").alias("__host"))
    meet = [F.col(f"h.{c}") == F.col(f"g.{c}") for c in slot] + [fits]
    asked = guests.select(*slot, *by).distinct()
    pairs = kinds.alias("h").join(asked.alias("g"), meet).select("h.__n", "h.__host", *[F.col(f"g.{c}").alias(f"__{c}") for c in (*slot, *by)])
    only = pairs.groupBy(*[f"__{c}" for c in (*slot, *by)]).agg(F.sum("__n").alias("__n"), F.min("__host").alias("__host")).where("__n = 1").drop("__n")
    only = kept(only, "match-kinds")
    same = [F.col(c).eqNullSafe(F.col(f"__{c}")) for c in (*slot, *by)]
    placed = guests.join(only, same, "left")
    in_order = lambda f: F.transform(F.array_sort(F.collect_list(F.struct(key.alias("__guest"), f))), lambda s: s[f])
    taken = placed.where("__host IS NOT NULL").groupBy("__host").agg(F.count("*").alias("merged"), *[in_order(f).alias(f"__{f}") for f in fields])
    joined = hosts.join(taken.withColumnRenamed("__host", "__t"), F.col("__host") == F.col("__t"), "left")
    both = lambda f: F.array_join(F.array_distinct(F.filter(
        F.concat(F.array(F.col(f)), F.coalesce(f"__{f}", F.array().cast("array<string>"))), lambda x: x != "")), (seps or {}).get(f, "; "))
    merged = joined.withColumns({f: both(f) for f in fields}).withColumn("merged", F.coalesce("merged", F.lit(0)).cast("long"))
    alone = lambda rows: rows.withColumn("merged", F.lit(0).cast("long"))
    names = [*df.columns, "merged"]
    return merged.select(names).unionByName(alone(placed.where("__host IS NULL")).select(names)).unionByName(alone(df.where(~is_host & ~is_guest)).select(names))


def continuation_runs(df: DataFrame, partition: list[str], order: list, continues: Column, text: str, first: list[str]) -> DataFrame:
    """Rows that continue the one before fold into its run: texts joined by a space, other fields from the first row."""
    w = ordered(partition, order)
    begun = island(df.withColumn("__go", F.coalesce(continues, F.lit(False)) & (F.row_number().over(w) > 1)), partition, order, ~F.col("__go"), "__run")
    place = begun.withColumn("__at", F.row_number().over(w))
    parts = F.array_sort(F.collect_list(F.struct("__at", text)))
    return place.groupBy(*partition, "__run").agg(
        F.array_join(F.transform(parts, lambda s: s[text]), " ").alias(text), F.count("*").alias("rows_merged"),
        *[F.min_by(c, "__at").alias(c) for c in first]).drop("__run")


def upsert(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """Old rows of keys that ``new`` brings are replaced as a whole."""
    return old.join(new.select(key).distinct(), key, "left_anti").unionByName(new)
