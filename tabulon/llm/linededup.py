"""Line dedup by content-defined chunks of lines.

1. Lines are hashed, and pairs of adjacent lines are counted by hash over all documents; a pair that occurs once
   can be in no repeated chunk.
2. A document's repeated pairs fall into runs.  A rolling hash over the line hashes cuts each run into chunks of two
   or more lines: a cut depends on three lines only, so shifted or edited copies fall back into step.  Chunks are
   counted by hash over all documents.
3. Cuts may part a passage of two or three lines, or one that was cropped elsewhere.  So every maximal run of lines that
   continues the first occurrence of its pairs is a chunk too: no repeated pair is lost.  A single line of ``MIN_WORDS`` words
   can also count as a chunk (``long_lines``).
4. The bytes of each repeated chunk are compared with those of its first occurrence (smallest id,
   then place), which stays.  Equal ones are removed, but for lines that they share with it.  The earliest
   place of a line is never part of a later copy, so every line stays somewhere.

Blank lines count as no line: they part no run and go only inside a removed chunk.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabulon.llm.common import key_filter, passing, slices, stored, table, text_or_empty, with_maybe
from tabulon.llm.mixing import word_count

#: A single line is a passage by itself from so many words on.
MIN_WORDS = 50
#: One place in so many is a cut.
CUT_ONE_IN = 4
_MULT = np.uint64(0x9E3779B97F4A7C15)


def crossings(pairs: np.ndarray, same_run: np.ndarray) -> np.ndarray:
    """Which pairs of adjacent lines are cut apart: those where the rolling hash of three lines hits a boundary value.

    ``same_run``: whether a pair goes on from the one before.  No two neighbouring pairs are cut, so a chunk has two lines at least.
    """
    before = np.concatenate([pairs[:1], pairs[:-1]])
    h = (before * _MULT) ^ pairs
    h = (h ^ (h >> np.uint64(31))) * _MULT
    hit = same_run & ((h >> np.uint64(33)) % np.uint64(CUT_ONE_IN) == 0)
    return hit & ~np.concatenate([[False], hit[:-1]])


def chunks_of(pairs: np.ndarray, same_run: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first pair, last pair, hash) of each chunk."""
    if not len(pairs):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64)
    cut = crossings(pairs, same_run)
    inside = np.flatnonzero(~cut)
    begins = ~same_run[inside] | np.concatenate([[True], cut[inside[1:] - 1]])
    first = np.flatnonzero(begins)
    size = np.diff(np.append(first, len(inside)))
    power = np.cumprod(np.concatenate([[np.uint64(1)], np.full(size.max(initial=1) - 1, _MULT)]))
    nth = np.arange(len(inside)) - np.repeat(first, size)
    value = np.add.reduceat(pairs[inside] * power[nth], first) if len(first) else np.zeros(0, np.uint64)
    return inside[first], inside[np.append(first[1:], len(inside)) - 1] if len(first) else first, value ^ size.astype(np.uint64)


def continued(doc: np.ndarray, order: np.ndarray, own: np.ndarray, first_doc: np.ndarray, first_order: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(first pair, last pair) of every maximal run that follows, line by line, the first occurrence of its pairs elsewhere or earlier."""
    later = (first_doc != own) | (first_order != order)
    goes_on = np.zeros(len(doc), bool)
    goes_on[1:] = (later[1:] & later[:-1] & (doc[1:] == doc[:-1]) & (order[1:] == order[:-1] + 1)
                   & (first_doc[1:] == first_doc[:-1]) & (first_order[1:] == first_order[:-1] + 1))
    first = np.flatnonzero(later & ~goes_on)
    stops = later & ~np.concatenate([goes_on[1:], [False]])
    return first, np.flatnonzero(stops)


def _lines(text: Column) -> Column:
    numbered = F.transform(F.split(text, "\n", -1), lambda x, i: F.struct(i.alias("pos"), x.alias("line")))
    return F.filter(numbered, lambda s: F.length(F.regexp_replace(s["line"], r"[\x20\x09-\x0D]+", "")) > 0)


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, th, text): rows with the same id and text hash are one document."""
    text = text_or_empty(text_col)
    return docs.select(F.col(id_col).alias("id"), F.xxhash64(text).alias("th"), text.alias("text"))


def _same_doc(a: str, b: str) -> Column:
    return F.col(f"{a}.id").eqNullSafe(F.col(f"{b}.id")) & (F.col(f"{a}.th") == F.col(f"{b}.th"))


def repeated_chunks(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", long_lines: bool = True) -> DataFrame:
    """(id, th, first, last): line ranges whose bytes already stand at an earlier place."""
    keyed = _keyed(docs, id_col, text_col)
    hashed = keyed.select("id", "th", F.transform(_lines(F.col("text")), lambda s: F.struct(
        s["pos"].alias("pos"), F.xxhash64(s["line"]).alias("h"), F.length(s["line"]).alias("size"), (word_count(s["line"]) >= MIN_WORDS).alias("long"))).alias("ls"))

    def with_next(s: Column, i: Column) -> Column:
        after = F.get(F.col("ls"), i + 1)
        gap = after["pos"] - s["pos"]
        return F.struct(s["pos"].alias("pos"), gap.alias("gap"), F.when(after.isNotNull(), F.xxhash64(s["h"], after["h"], gap)).alias("pair"),
                        F.when(s["long"], s["h"]).alias("long"))

    lines = hashed.select("id", "th", F.posexplode(F.transform("ls", with_next)).alias("ord", "s")).select("id", "th", "ord", "s.pos", "s.gap", "s.pair", "s.long")
    lines = stored(lines.where("pair IS NOT NULL OR long IS NOT NULL"), "line-pairs")
    again = lines.where("pair IS NOT NULL").groupBy("pair").agg(F.count("*").alias("n")).where("n > 1").select("pair")
    again = stored(lines.join(again, "pair").select("pair", "id", "th", "ord", "pos", "gap"), "line-again")
    firsts = again.groupBy("pair").agg(F.min(F.struct("id", "th", "ord", "pos")).alias("f"))
    placed = again.join(firsts, "pair").select("id", "th", F.struct(
        "ord", "pos", "gap", "pair", F.xxhash64("f.id", "f.th").alias("first_doc"), F.col("f.ord").alias("first_ord"), F.col("f.pos").alias("first_pos"),
        F.col("f.id").alias("first_id"), F.col("f.th").alias("first_th")).alias("p"))
    # rows that repeat id and text are one document
    per_doc = placed.groupBy("id", "th").agg(F.array_sort(F.collect_set("p")).alias("ps")).select("id", "th", F.xxhash64("id", "th").alias("own"), "ps")
    id_type = dict(docs.dtypes)[id_col]

    def cut(batches):
        for b in slices(batches):
            ps = b.column(3)
            cells = ps.flatten()
            doc = np.repeat(np.arange(b.num_rows), np.diff(ps.offsets.to_numpy()))
            get = lambda name: cells.field(name).to_numpy()  # noqa: E731, B023
            order, pos, gap, pairs = get("ord"), get("pos"), get("gap"), get("pair").view(np.uint64)
            same = np.zeros(len(doc), bool)
            same[1:] = (doc[1:] == doc[:-1]) & (order[1:] == order[:-1] + 1)
            a, z, value = chunks_of(pairs, same)
            own = b.column(2).to_numpy()[doc]
            c, y = continued(doc, order, own, get("first_doc"), get("first_ord"))
            first, last = np.concatenate([a, c]), np.concatenate([z, y])
            # a run's key: where its first occurrence stands
            with np.errstate(over="ignore"):
                key = (get("first_doc")[c].view(np.uint64) * _MULT + get("first_pos")[c].astype(np.uint64)) * _MULT + (pos[y] + gap[y] - pos[c]).astype(np.uint64)
            runs, none = pa.array(c, pa.int64()), len(a)
            kept_first = get("first_pos")[c]
            pad = lambda x, t: pa.concat_arrays([pa.nulls(none, t), x])  # noqa: E731, B023
            rows = pa.array(doc[first], pa.int64())
            yield pa.RecordBatch.from_arrays([
                b.column(0).take(rows), b.column(1).take(rows), pa.array(pos[first], pa.int32()), pa.array(pos[last] + gap[last], pa.int32()),
                pa.array(np.concatenate([value, key]).view(np.int64)), pad(cells.field("first_id").take(runs), b.column(0).type),
                pad(cells.field("first_th").take(runs), pa.int64()), pad(pa.array(kept_first, pa.int32()), pa.int32()),
                pad(pa.array(kept_first + (pos[y] + gap[y] - pos[c]), pa.int32()), pa.int32())],
                names=["id", "th", "first", "last", "ch", "k_id", "k_th", "k_first", "k_last"])

    found = stored(per_doc.mapInArrow(cut, f"id {id_type}, th long, first int, last int, ch long, k_id {id_type}, k_th long, k_first int, k_last int"), "line-chunks")
    place = ["id", "th", "first", "last"]
    chunks = found.where("k_first IS NULL").select(*place, F.xxhash64(F.lit("chunk"), "ch").alias("ch"))
    if long_lines:
        long = lines.where("long IS NOT NULL").select("id", "th", F.col("pos").alias("first"), F.col("pos").alias("last"), F.xxhash64(F.lit("line"), "long").alias("ch"))
        chunks = chunks.unionByName(long.distinct())
    keepers = stored(chunks.groupBy("ch").agg(F.count("*").alias("n"), F.min(F.struct(*place)).alias("keep")).where("n > 1").select("ch", "keep"), "line-keepers")
    runs = found.where("k_first IS NOT NULL").select(*place, F.xxhash64(F.lit("run"), "ch").alias("ch"), F.struct(
        F.col("k_id").alias("id"), F.col("k_th").alias("th"), F.col("k_first").alias("first"), F.col("k_last").alias("last")).alias("keep"))
    kept_runs = runs.select("keep.*", "ch", "keep").distinct()
    ranges = chunks.join(keepers, "ch").select(*place, "ch", "keep").unionByName(runs).unionByName(kept_runs)
    ranges = stored(ranges.groupBy("id", "th").agg(F.collect_list(F.struct("first", "last", "ch", "keep")).alias("rs")), "line-ranges")
    bits = key_filter(ranges, F.xxhash64("id", "th"), "line-range-bits")
    few = with_maybe(keyed, F.xxhash64("id", "th"), bits).where("__maybe")
    whole = few.alias("d").join(ranges.hint("merge").alias("r"), _same_doc("d", "r")).select("d.id", "d.th", F.split("d.text", "\n", -1).alias("all"), "r.rs")
    texts = whole.select("id", "th", "all", F.explode("rs").alias("r")).select(
        "id", "th", "r.first", "r.last", "r.ch", (F.struct("id", "th", "r.first", "r.last").eqNullSafe(F.col("r.keep"))).alias("is_kept"),
        F.when(F.col("id").eqNullSafe(F.col("r.keep.id")) & (F.col("th") == F.col("r.keep.th")), F.col("r.keep.last")).otherwise(F.lit(-1)).alias("shared_to"),
        F.array_join(F.slice("all", F.col("r.first") + 1, F.col("r.last") - F.col("r.first") + 1), "\n").alias("bytes"))
    texts = stored(texts, "line-texts")
    kept = stored(texts.where("is_kept").groupBy("ch").agg(F.min("bytes").alias("kept_bytes")), "line-kept")
    others = texts.where("NOT is_kept").join(kept, "ch").where("bytes = kept_bytes")
    return others.select("id", "th", F.greatest("first", F.col("shared_to") + 1).alias("first"), "last").where("first <= last")


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", long_lines: bool = True, counts: bool = True) -> DataFrame:
    """All rows and columns of ``docs``, repeated chunks removed from the text, plus (``counts``) n_lines and n_removed.

    Null texts stay null and have no lines.  Rows that share id and text are one
    document and fare alike; rows that share an id only are told apart by text.  A
    text whose lines are all removed becomes empty.  An empty table stays empty.
    With ``counts``, columns of ``docs`` that are called n_lines or n_removed are replaced.
    """
    with passing(docs.sparkSession):
        drops, bits = _drops(docs, id_col, text_col, long_lines)
    # only texts that may lose lines are shuffled; whole rows travel as one column, so no name clashes
    rows = docs.select(F.struct("*").alias("row"), F.col(id_col).alias("own_id"), F.xxhash64(text_or_empty(text_col)).alias("own_th"))
    split = with_maybe(rows, F.xxhash64("own_id", "own_th"), bits)
    touched = split.where("__maybe").join(drops.hint("merge"), F.col("own_id").eqNullSafe(F.col("id")) & (F.col("own_th") == F.col("th")), "left").select("row", "drop")
    untouched = split.where("NOT __maybe").select("row", F.lit(None).cast("array<boolean>").alias("drop"))
    text = F.col("row").getField(text_col)
    lines = F.split(text, "\n", -1)
    left = F.filter(lines, lambda x, i: ~F.coalesce(F.get(F.col("drop"), i), F.lit(False)))
    none = text.isNull() | F.col("drop").isNull()
    added = {} if not counts else {"n_lines": F.when(text.isNull(), F.lit(0)).otherwise(F.size(lines)), "n_removed": F.when(none, F.lit(0)).otherwise(F.size(F.filter("drop", lambda x: x)))}
    columns = [F.when(none, text).otherwise(F.array_join(left, "\n")).alias(c) if c == text_col else F.col("row").getField(c).alias(c)
               for c in docs.columns if c not in added]
    return touched.unionByName(untouched).select(*columns, *[n.cast("long").alias(c) for c, n in added.items()])


def _drops(docs: DataFrame, id_col: str, text_col: str, long_lines: bool) -> tuple[DataFrame, DataFrame]:
    """(id, th, drop): for every document that loses lines a flag a line; and a filter of these documents."""
    ranges = repeated_chunks(docs, id_col, text_col, long_lines)
    per_doc = ranges.distinct().groupBy("id", "th").agg(F.collect_list(F.struct("first", "last")).alias("rs"))
    id_type = dict(docs.dtypes)[id_col]

    def flags(batches):
        for b in slices(batches):
            out = []
            for rs in b.column(2).to_pylist():
                drop = np.zeros(max(r["last"] for r in rs) + 1, bool)
                for r in rs:
                    drop[r["first"] : r["last"] + 1] = True
                out.append(drop)
            yield pa.RecordBatch.from_arrays([*b.columns[:2], pa.array(out, pa.list_(pa.bool_()))], names=["id", "th", "drop"])

    drops = stored(per_doc.mapInArrow(flags, f"id {id_type}, th long, drop array<boolean>"), "line-drops", lasting=True)
    return drops, key_filter(drops, F.xxhash64("id", "th"), "line-drop-bits", lasting=True)


def query(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return dedup_lines(docs)
