"""Joins over cell grids: range overlap, nearest match by tiers, nearest cluster, words to lines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def overlap_join(left: DataFrame, right: DataFrame, sheet: list[str], low: str, high: str, gap: Column | None = None, bin_width: int = 8,
                 how_many: str = "pairs", near: tuple[str, int] | None = None) -> DataFrame:
    """Pairs of a sheet whose [low, high] column ranges overlap; columns come out as ``a_*`` and ``b_*``.

    Both sides are spread over bins of columns and meet by (sheet, bin), a hash join;
    a pair is kept in the bin of its overlap's first column only.  ``gap`` is a further condition on a_* and b_*.
    ``near`` (column, distance) asks for values at most that far apart: right rows lie in one bin of that width, left rows in three.  There
    pairs may be far more than rows, so tasks follow the shuffle's number and not the bytes of the sides.
    """
    def binned(df: DataFrame, p: str) -> DataFrame:
        named = df.select([F.col(c).alias(f"{p}_{c}") for c in df.columns])
        bins = F.sequence(F.floor(F.col(f"{p}_{low}") / bin_width), F.floor(F.col(f"{p}_{high}") / bin_width))
        named = named.withColumn(f"{p}_bin", F.explode(bins))
        if near is None:
            return named
        stripe = F.floor(F.col(f"{p}_{near[0]}") / max(near[1], 1))
        return named.withColumn(f"{p}_stripe", F.explode(F.sequence(stripe - 1, stripe + 1)) if p == "a" else stripe)

    a, b = binned(left, "a"), binned(right, "b")
    meet = [F.col(f"a_{s}") == F.col(f"b_{s}") for s in sheet] + [F.col("a_bin") == F.col("b_bin")]
    over = (F.col(f"a_{low}") <= F.col(f"b_{high}")) & (F.col(f"b_{low}") <= F.col(f"a_{high}"))
    first = F.floor(F.greatest(f"a_{low}", f"b_{low}") / bin_width) == F.col("a_bin")
    if near is not None:
        meet.append(F.col("a_stripe") == F.col("b_stripe"))
        over &= F.abs(F.col(f"a_{near[0]}") - F.col(f"b_{near[0]}")) <= near[1]
        tasks = int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        a, b = a.repartition(tasks, *[f"a_{s}" for s in sheet], "a_bin", "a_stripe"), b.hint("merge")
    pairs = a.join(b, meet).where(over & first)
    return (pairs if gap is None else pairs.where(gap)).drop("a_bin", "b_bin", "a_stripe", "b_stripe")


def covering(points: DataFrame, cells: DataFrame, sheet: list[str], rows: int = 32, columns: int = 8) -> DataFrame:
    """Points (sheet, row, col) with the cell whose rectangle holds each; points outside all cells are left out.

    A rectangle that lies in one bin of rows and columns goes there; others are spread over bins of eight times the height and width.  A point
    lies in one bin of either kind, and they meet by (sheet, bin) in a sort-merge join: nearly every rectangle is shuffled once, a point twice.  Neither side is broadcast, as both grow.
    Where rectangles overlap, a point gets every one that holds it.
    """
    at = lambda c, width: F.floor(F.col(c) / width)
    # one number a bin: its row bin, its column bin and its kind
    bin_ = lambda r, c, wide: F.shiftleft(r, 33) + F.shiftleft(c, 1) + wide
    one = (at("min_row", rows) == at("max_row", rows)) & (at("min_col", columns) == at("max_col", columns))
    down, across = F.sequence(at("min_row", rows * 8), at("max_row", rows * 8)), F.sequence(at("min_col", columns * 8), at("max_col", columns * 8))
    many = F.flatten(F.transform(down, lambda r: F.transform(across, lambda c: bin_(r, c, 1))))
    spread = cells.withColumn("__bin", F.explode(F.when(one, F.array(bin_(at("min_row", rows), at("min_col", columns), 0))).otherwise(many)))
    placed = points.withColumn("__bin", F.explode(F.array(bin_(at("row", rows), at("col", columns), 0), bin_(at("row", rows * 8), at("col", columns * 8), 1))))
    inside = F.col("row").between(F.col("min_row"), F.col("max_row")) & F.col("col").between(F.col("min_col"), F.col("max_col"))
    return placed.join(spread.hint("merge"), [*sheet, "__bin"]).where(inside).drop("__bin")


def beside(spots: DataFrame, marks: DataFrame, keys: list[str], at: str) -> DataFrame:
    """(keys, at, before, after) of every place of ``spots``: the last mark up to it and the first from it on, as (t: its place, v).

    ``marks`` has one row (keys, at, v) a place.  Places are taken once, so the windows grow with distinct places, and no mark meets every spot.
    """
    both = spots.select(*keys, at).distinct().withColumn("__spot", F.lit(True)).unionByName(marks.withColumn("__spot", F.lit(False)), allowMissingColumns=True)
    placed = both.groupBy(*keys, at).agg(F.bool_or("__spot").alias("__spot"), F.first(F.when(~F.col("__spot"), F.struct(F.col(at).alias("t"), "v")), ignorenulls=True).alias("m"))
    w = Window.partitionBy(*keys).orderBy(at)
    placed = placed.withColumns({"before": F.last("m", ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, 0)),
                                 "after": F.first("m", ignorenulls=True).over(w.rowsBetween(0, Window.unboundedFollowing))})
    return placed.where("__spot").drop("__spot", "m")


def nearest(left: DataFrame, right: DataFrame, left_id: list[str], at: str, value: str, tiers: list[tuple[list[str], int | None]], name: str) -> DataFrame:
    """Each left row's best right row: first tier that has one, then smallest distance in ``at``, then smallest ``value``.

    A tier is (columns that must be equal, distance allowed or None).  Right rows fold to the smallest value a place, and a left row looks
    at the places beside its own: cost follows rows, not pairs.  Rows without any candidate have nulls.
    """
    found, near = left, {}
    for keys in dict.fromkeys(tuple(k) for k, _ in tiers):
        marks = right.where(F.col(at).isNotNull()).groupBy(*keys, at).agg(F.min(value).alias("v"))
        side = lambda c: F.when(F.col(c).isNotNull(), F.struct(F.abs(F.col(at) - F.col(f"{c}.t")).alias("distance"), F.col(f"{c}.v").alias("value")))
        near[keys] = f"__near{len(near)}"
        best = beside(left, marks, list(keys), at).select(*keys, at, F.array_min(F.array(side("before"), side("after"))).alias(near[keys]))
        found = found.join(best, [*keys, at], "left")
    def candidate(i: int, keys: list[str], most: int | None) -> Column:
        n = near[tuple(keys)]
        fits = F.col(n).isNotNull() if most is None else F.col(f"{n}.distance") <= most
        return F.when(fits, F.struct(F.lit(i).alias("tier"), f"{n}.distance", f"{n}.value"))

    best = F.min(F.coalesce(*[candidate(i, *t) for i, t in enumerate(tiers, 1)])).alias("best")
    return found.groupBy(*left_id).agg(best).select(*left_id, F.col("best.value").alias(name), F.col("best.tier").alias("tier"), F.col("best.distance").alias("distance"))


def asof_both_sides(events: DataFrame, key: str, ts: str, is_left: Column, is_right: Column, right_value: str) -> DataFrame:
    """For every left row of a key: nearest right row in time, before or after (ties to before).

    One window pass instead of a join: the last right row so far and the first from
    here on are carried along the ordered rows.
    """
    w = Window.partitionBy(key).orderBy(ts, right_value)
    mark = F.when(is_right, F.struct(F.col(ts).alias("t"), F.col(right_value).alias("v")))
    placed = events.withColumn("__before", F.last(mark, ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, 0)))
    placed = placed.withColumn("__after", F.first(mark, ignorenulls=True).over(w.rowsBetween(0, Window.unboundedFollowing)))
    micros = lambda c: F.unix_micros(F.col(c).cast("timestamp"))
    gap = lambda c: F.abs(micros(ts) - micros(f"{c}.t"))
    before = F.col("__after").isNull() | (gap("__before") <= gap("__after"))
    near = F.when(F.col("__before").isNotNull() & before, F.col("__before")).otherwise(F.col("__after"))
    return placed.where(is_left).withColumn("__near", near).drop("__before", "__after")


def words_to_lines(words: DataFrame, page: list[str], top: str, left: str, text: str, height: int = 12) -> DataFrame:
    """OCR words to lines: half-even rounded rows of ``height``, words from left to right."""
    line = F.bround(F.col(top) / height).cast("long")
    joined = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(left, text))), lambda w: w[text]), " ")
    return words.groupBy(*page, line.alias("line")).agg(joined.alias("text"))
