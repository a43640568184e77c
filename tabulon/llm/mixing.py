"""Mixing sources to target weights by systematic sampling.

A document's expected copies are its source's target over its source's size.
Within a source the documents lie in a fixed order (size class, then a hash of
id, size and text); the running sum of expected copies plus one random offset per
source crosses an integer boundary once for every copy emitted.  Ordering by
size makes the systematic draw a stratified one, so the words taken come near
the target although documents differ by orders of magnitude.

The running sum is taken in two levels: counts per (source, band) first, a
running sum over that small table, then row numbers inside each band.  A band is
a source's size class with one beginning of the hash; there are more of them the more rows there are, so a source that
holds a third of all rows is spread over all tasks, and so are rows that share an id.  Row numbers are integers, so reruns agree to the last copy.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabulon.llm.common import WORD_GAP, passing, stored, table, text_or_empty

#: Rows that a hash band holds about; a source's size class has 256 bands at least, and 16 times as many as often as that needs.
BAND_ROWS = 100_000


def word_count(text: Column) -> Column:
    """Words separated by ASCII white space."""
    trimmed = F.regexp_replace(text, r"^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$", "")
    return F.when(trimmed == "", F.lit(0)).otherwise(F.size(F.split(trimmed, WORD_GAP))).cast("long")


def targets(sizes: DataFrame, weights: tuple[int, ...] = (3, 1, 2), share: float = 1.5, cap: float = 2.0) -> DataFrame:
    """(source, source_size) -> plus target.

    Sources in code-point order, null last, take the weights in turn and split
    ``share`` of all words; none exceeds ``cap`` times its size, and what is cut
    goes to the others by weight until none is above.  In order of cap / weight
    the sources that end at their cap come first, so one pass settles it.  The
    windows run over one row per source.
    """
    order = Window.orderBy(F.col("source").isNull(), "source")
    by_cap = Window.orderBy("ratio", "pos")
    so_far = by_cap.rowsBetween(Window.unboundedPreceding, -1)
    rest = by_cap.rowsBetween(0, Window.unboundedFollowing)
    turn = (F.row_number().over(order) - 1).alias("pos")
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), (F.col("pos") % len(weights) + 1).cast("int"))
    every = Window.partitionBy()
    placed = (
        sizes.select("source", "source_size", turn)
        .withColumn("weight", w)
        .withColumn("cap", F.col("source_size") * F.lit(float(cap)))
        .withColumn("ratio", F.col("cap") / F.col("weight"))
        .withColumn("all_words", F.sum("source_size").over(every) * F.lit(float(share)))
        .withColumn("level", (F.col("all_words") - F.coalesce(F.sum("cap").over(so_far), F.lit(0.0))) / F.sum("weight").over(rest))
        .withColumn("free_level", F.min(F.when(F.col("ratio") > F.col("level"), F.struct("ratio", "pos", "level"))).over(every))
    )
    below = F.col("free_level").isNull() | (F.struct("ratio", "pos", "level") < F.col("free_level"))
    return placed.select("source", "source_size", "pos", F.when(below, F.col("cap")).otherwise(
        F.col("free_level.level") * F.col("weight")).alias("target"))


def _fraction(text: Column) -> Column:
    """A fixed number in [0, 1) from the md5 of a text."""
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        weights: tuple[int, ...] = (3, 1, 2), share: float = 1.5, cap: float = 2.0, seed: str = "mix") -> DataFrame:
    """(id, source, size, source_size, target, copies) for every row.

    Null text has size 0; null sources form a source of their own that comes
    last.  Empty documents take copies like others but no words.  A source
    without words has target 0 and no copies.  Repeated rows count separately
    and share the copies of their places in order.
    """
    placed = _placed(docs, id_col, text_col, source_col, weights, share, cap, seed, False)
    return placed.select("id", "source", "size", "source_size", "target", "copies")


def _row_key(id_col: str, text_col: str, source_col: str) -> list[Column]:
    """128 bits that tell rows apart by id, text and source."""
    parts = [F.col(id_col), text_or_empty(text_col), F.col(source_col)]
    return [F.xxhash64(*parts).alias("k1"), F.xxhash64(F.lit("k2"), *parts[::-1]).alias("k2")]


def _placed(docs: DataFrame, id_col: str, text_col: str, source_col: str, weights, share, cap, seed, keyed: bool) -> DataFrame:
    """The rows of ``mix``; ``keyed``: with the row key k1, k2, which then also orders rows of one id and size."""
    keys = ["k1", "k2"] if keyed else []
    band = F.md5(F.concat(F.coalesce(F.col("id").cast("string"), F.lit("")), F.lit(":"), F.col("size").cast("string"), F.lit(":"), F.col("th")).cast("binary"))
    rows = docs.select(F.col(id_col).alias("id"), F.col(source_col).alias("source"),
                       word_count(text_or_empty(text_col)).alias("size"), F.md5(text_or_empty(text_col).cast("binary")).alias("th"), *(_row_key(id_col, text_col, source_col) if keyed else []))
    rows = stored(rows.withColumn("cls", F.floor(F.log2(F.col("size") + F.lit(1.0))).cast("int")).withColumn("band", band).drop("th"), "mix-sizes")
    digits = 2
    while rows.count() > BAND_ROWS << 4 * digits:
        digits += 1
    rows = rows.withColumn("order", F.col("band")).withColumn("band", F.substring("band", 1, digits))
    bands = rows.groupBy("source", "cls", "band").agg(F.count("*").alias("n"), F.sum("size").alias("words"))
    bands = stored(bands, "mix-bands")
    goal = targets(bands.groupBy("source").agg(F.sum("words").alias("source_size")), weights, share, cap)
    in_source = Window.partitionBy("source").orderBy("cls", "band").rowsBetween(Window.unboundedPreceding, -1)
    placed = bands.withColumn("ahead", F.coalesce(F.sum("n").over(in_source), F.lit(0)))
    goal = stored(goal, "mix-goal").select(F.col("source").alias("g_source"), "source_size", "target")
    placed = placed.join(goal, F.col("source").eqNullSafe(F.col("g_source"))).select(
        F.col("source").alias("b_source"), F.col("cls").alias("b_cls"), F.col("band").alias("b_band"), "ahead", "source_size", "target")
    placed = stored(placed, "mix-places")
    in_band = Window.partitionBy("source", "cls", "band").orderBy("order", "id", *keys)
    numbered = rows.withColumn("nth", F.row_number().over(in_band))
    joined = numbered.join(placed, F.col("source").eqNullSafe(F.col("b_source")) & (F.col("cls") == F.col("b_cls")) & (F.col("band") == F.col("b_band")))
    step = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    offset = _fraction(F.concat(F.lit(seed + ":"), F.coalesce("source", F.lit(""))))
    last = F.col("ahead") + F.col("nth")
    copies = F.floor(last * step + offset) - F.floor((last - 1) * step + offset)
    return joined.select("id", "source", "size", "source_size", "target", copies.cast("long").alias("copies"), *keys)


def mixed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
          weights: tuple[int, ...] = (3, 1, 2), share: float = 1.5, cap: float = 2.0, seed: str = "mix") -> DataFrame:
    """``docs`` with every row as often as the mix takes it; all columns return.

    Copies are counted per row: by id, text and source, and by a row number among rows equal in these, whose
    copies differ by one at most.
    """
    with passing(docs.sparkSession):
        rows = _placed(docs, id_col, text_col, source_col, weights, share, cap, seed, True)
        counts = stored(_row_copies(rows), "mix-copies", lasting=True)
    # whole rows travel as one column, so no name clashes
    numbered = docs.select(F.struct("*").alias("row"), *_row_key(id_col, text_col, source_col))
    numbered = numbered.withColumn("nth", F.row_number().over(Window.partitionBy("k1", "k2").orderBy("k1")))
    taken = numbered.join(counts.hint("merge"), ["k1", "k2"])  # no bound on their number, so never broadcast
    copies = F.when(F.col("nth") <= F.col("high.n"), F.col("high.copies")).otherwise(F.col("low")).cast("int")
    taken = taken.select("row", copies.alias("copies")).where("copies > 0")
    return taken.select("row", F.explode(F.sequence(F.lit(1), "copies"))).select("row.*")


def _row_copies(rows: DataFrame) -> DataFrame:
    """(k1, k2, high, low): the copies of rows that share a key, and how many of them take the higher number."""
    counts = rows.groupBy("k1", "k2", "copies").agg(F.count("*").alias("n")).groupBy("k1", "k2").agg(
        F.max(F.struct("copies", "n")).alias("high"), F.min("copies").alias("low")).where("high.copies > 0")
    return counts


def query(spark, sf_dir):
    found = mix(table(spark, sf_dir, "documents"))
    return found.select(F.col("id").alias("doc_id"), "source", "size", "source_size", "target",
                        (F.col("size") * F.col("copies")).alias("taken"))


SQL = r"""
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size, md5(coalesce(text, '')) AS th FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
p AS (SELECT *, row_number() OVER (ORDER BY source IS NULL, source) - 1 AS pos FROM s),
w AS (SELECT *, ([3.0, 1.0, 2.0])[(pos % 3 + 1)::INT]::DOUBLE AS weight, source_size * 2.0::DOUBLE AS cap FROM p),
r AS (SELECT *, cap / weight AS ratio, (sum(source_size) OVER ())::DOUBLE * 1.5::DOUBLE AS all_words FROM w),
l AS (SELECT *, (all_words - coalesce(sum(cap) OVER (ORDER BY ratio, pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0.0))
        / sum(weight) OVER (ORDER BY ratio, pos ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM r),
f AS (SELECT ratio, pos, level FROM l WHERE ratio > level ORDER BY ratio, pos LIMIT 1),
g AS (SELECT l.source, l.source_size,
        CASE WHEN f.pos IS NULL OR (l.ratio, l.pos) < (f.ratio, f.pos) THEN l.cap ELSE f.level * l.weight END AS target
      FROM l LEFT JOIN f ON true),
o AS (SELECT d.*, row_number() OVER (PARTITION BY source ORDER BY floor(log2(size + 1.0)), md5(coalesce(doc_id::VARCHAR, '') || ':' || size || ':' || th), doc_id) AS k FROM d),
j AS (SELECT o.doc_id, o.source, o.size, g.source_size, g.target, o.k,
        CASE WHEN g.source_size > 0 THEN g.target / g.source_size ELSE 0.0 END AS step,
        ('0x' || substr(md5('mix:' || coalesce(o.source, '')), 1, 8))::UBIGINT::DOUBLE / 4294967296.0::DOUBLE AS u
      FROM o JOIN g ON o.source IS NOT DISTINCT FROM g.source)
SELECT doc_id, source, size, source_size, target,
  (size * (floor(k * step + u) - floor((k - 1) * step + u)))::BIGINT AS taken FROM j
"""
