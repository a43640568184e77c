"""Near copies by five-word Jaccard similarity: candidates from a positional index of minima, verified on the texts.

A text's signature holds ``BANDS`` positional entries, each of ``ROWS`` minima over
its five-word shingles.  Texts of similarity s meet in an entry with probability
1 - (1 - s ** ROWS) ** BANDS: 0.99992 at 0.8.  Texts of equal shingle sets are folded
first.  Every candidate pair is verified by the exact Jaccard similarity of
the two texts' shingle sets, which are made anew for it and never stored; pairs whose sets' sizes alone rule it out are passed over.  Seven minima an entry keep texts that share a common passage only (a similarity of a half) apart:
they meet in fewer than one of a hundred entries.

In two first rounds each row is verified against one other, the smallest member of all its postings: one pair a row, after
which little is left of a group of near copies.  Then members of a posting are verified against its smallest member, in rounds: who is near a smaller one leaves,
the others go on without it.  So a group of near copies, however large, falls to its first in about one round, in linear work.
From the round ``STAR_ROUNDS`` on, postings of at most ``PAIRWISE`` members that are still left make all pairs; what is left
after ``PIVOT_ROUNDS`` does so too, so no pair of rows that stay is skipped.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabulon.llm.common import key_filter, passing, slices, stored, text_or_empty, with_maybe
from tabulon.llm.simhash import SEED, _row_key

SHINGLE = 5
SIMILAR = 0.8
BANDS, ROWS = 40, 7
#: Posting size up to which all pairs are verified at once, from which round on, and rounds against one member in all.
PAIRWISE, STAR_ROUNDS, PIVOT_ROUNDS = 32, 3, 4
#: Rounds before these, in which each row is verified against the smallest member of all its postings only.
FIRST_ROUNDS = 2
#: Rows of one posting that are verified against its smallest member in one task, about; and pairs of a task.
SHARE = 500

_RNG = np.random.default_rng(SEED)
_XOR = _RNG.integers(0, 2**63, BANDS * ROWS).astype(np.uint64)[:, None]
_ODD = (_RNG.integers(0, 2**63, BANDS * ROWS).astype(np.uint64) * np.uint64(2) + np.uint64(1))[:, None]


def shingles(text: str, n: int = SHINGLE) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the ``n``-word shingles; a shorter text is one shingle, an empty one none."""
    words = text.encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    joined = b" ".join(words)
    size = np.fromiter(map(len, words), np.int64, len(words))
    end = np.cumsum(size + 1) - 1
    width = min(n, len(words))
    starts = (end - size)[: len(words) - width + 1].tolist()
    digest = xxhash.xxh64_intdigest
    return np.unique(np.array([digest(joined[a:b], SEED) for a, b in zip(starts, end[width - 1 :].tolist())], dtype=np.uint64))


def bands(hashes: np.ndarray) -> list[int]:
    """The index entries of a shingle set: one signed 64-bit number a position."""
    if not len(hashes):
        return []
    low = np.full(BANDS * ROWS, ~np.uint64(0))
    for i in range(0, len(hashes), 256):  # what a processor's cache holds
        mixed = hashes[i : i + 256] ^ _XOR
        mixed *= _ODD
        np.minimum(low, mixed.min(axis=1), out=low)
    rows = low.reshape(BANDS, ROWS)
    return np.array([xxhash.xxh64_intdigest(r.tobytes(), k) for k, r in enumerate(rows)], np.uint64).view(np.int64).tolist()


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, k1, k2, text) per row; k1 and k2 are hashes of id and text."""
    k1, k2 = _row_key(F.col(id_col), text_or_empty(text_col))
    return docs.select(F.col(id_col).alias("id"), k1.alias("k1"), k2.alias("k2"), text_or_empty(text_col).alias("text"))


def signatures(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, k1, k2, s1, s2, many, bands) per row; s1 and s2 tell shingle sets apart, ``many`` is their size."""
    source = _keyed(docs, id_col, text_col)

    def run(batches):
        for b in slices(batches):
            found, keys, many = [], [], []
            for t in b.column(3):
                s = shingles(t.as_py())
                keys.append([xxhash.xxh64_intdigest(s.tobytes(), seed) for seed in (1, 2)])
                many.append(len(s))
                found.append(bands(s))
            s1, s2 = np.array(keys, np.uint64).reshape(-1, 2).view(np.int64).T
            yield pa.RecordBatch.from_arrays(
                [*b.columns[:3], pa.array(s1), pa.array(s2), pa.array(many, pa.int64()), pa.array(found, pa.list_(pa.int64()))],
                names=["id", "k1", "k2", "s1", "s2", "many", "bands"])

    return source.mapInArrow(run, f"id {dict(source.dtypes)['id']}, k1 long, k2 long, s1 long, s2 long, many long, bands array<long>")


def similar(x: np.ndarray, y: np.ndarray) -> bool:
    """Whether the Jaccard similarity of two shingle sets is ``SIMILAR`` or more."""
    shared = len(np.intersect1d(x, y, assume_unique=True))
    return shared >= SIMILAR * (len(x) + len(y) - shared)


def _verified(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The larger ends ``b`` of those (a, b, n) pairs whose shingle sets are similar; a and b are (is null, id, k1, k2, set size).

    ``n`` is the size of a posting that holds both; the pairs of a smaller end with many are dealt over as many tasks.
    """
    shares = F.ceil(F.max("n") / F.lit(SHARE)).cast("int")
    least, most = F.least("a.many", "b.many"), F.greatest("a.many", "b.many")
    pairs = stored(pairs.where(least >= F.lit(SIMILAR) * most).groupBy("a", "b").agg(shares.alias("shares")), "near-pairs")
    tasks = 1 + pairs.count() // SHARE  # by pairs, not by bytes: each costs two sets

    def side(c: str) -> DataFrame:
        return texts.select(F.col("k1").alias(f"{c}1"), F.col("k2").alias(f"{c}2"), F.col("text").alias(f"{c}_text")).hint("merge")

    firsts = pairs.groupBy(F.col("a.k1").alias("a1"), F.col("a.k2").alias("a2")).agg(F.max("shares").alias("shares"))
    firsts = firsts.join(side("a"), ["a1", "a2"]).withColumn("share", F.explode(F.sequence(F.lit(0), F.col("shares") - 1))).drop("shares")
    keyed = pairs.select("b", *[F.col(f"{c}.k{i}").alias(f"{c}{i}") for c in "ab" for i in (1, 2)],
                         F.pmod(F.xxhash64("b.k1"), F.col("shares")).cast("int").alias("share"))
    keyed = keyed.join(side("b"), ["b1", "b2"]).repartition(tasks, "a1", "a2", "share")
    both = keyed.join(firsts.hint("merge"), ["a1", "a2", "share"]).select("b", "a_text", "b_text")

    def run(batches):
        last, known = None, None
        for batch in slices(batches):
            near = []
            for x, y in zip(batch.column(1), batch.column(2)):
                x = x.as_py()
                if x != last:
                    last, known = x, shingles(x)
                near.append(similar(known, shingles(y.as_py())))
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(pa.array(near, pa.bool_()))], names=["b"])

    return stored(both.mapInArrow(run, f"b {dict(both.dtypes)['b']}").distinct(), "near-found")


def _postings(entries: DataFrame) -> DataFrame:
    """Entries of postings with at least two members, each with their number ``n`` and its smallest member ``a``."""
    sizes = stored(entries.groupBy("band").agg(F.count("*").alias("n"), F.min("b").alias("a")).where("n > 1"), "near-sizes")
    return stored(entries.join(sizes.hint("merge"), "band"), "near-postings")


def _all_pairs(entries: DataFrame) -> DataFrame:
    other = entries.select("band", F.col("b").alias("a"))
    return entries.select("band", "b", "n").join(other.hint("merge"), "band").where("a < b").select("a", "b", "n")


def without_near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without rows that are a near copy of a row with a smaller id.

    No two rows that stay are near copies of each other, and each that goes is one of a row
    with a smaller id (equal or null ids, null last, are ordered by a hash of id and text).  Of
    texts without words, null ones included, one row stays.  All columns return.
    """
    with passing(docs.sparkSession):
        keep = _kept(docs, id_col, text_col)
    k1, k2 = _row_key(F.col(id_col), text_or_empty(text_col))
    rows = docs.select(F.struct("*").alias("row"), k1.alias("k1"), k2.alias("k2")).dropDuplicates(["k1", "k2"])
    return rows.join(keep.hint("merge"), ["k1", "k2"]).select("row.*")


def _candidates(docs: DataFrame, left: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(k1, k2, text) of the rows that stand in a posting of ``left``, once each."""
    ends = left.select("b.k1", "b.k2").distinct()
    bits = key_filter(ends, F.xxhash64("k1", "k2"), "near-bits")
    texts = with_maybe(_keyed(docs, id_col, text_col).select("k1", "k2", "text"), F.xxhash64("k1", "k2"), bits).where("__maybe").drop("__maybe")
    return stored(texts.dropDuplicates(["k1", "k2"]).join(ends.hint("merge"), ["k1", "k2"], "left_semi"), "near-texts", lasting=True)


def _kept(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(k1, k2) of the rows that stay."""
    order = F.struct(F.col("id").isNull().alias("no_id"), "id", "k1", "k2", "many")
    signed = signatures(docs, id_col, text_col).groupBy("s1", "s2").agg(F.min(order).alias("b"), F.first("bands").alias("bands"))
    classes = stored(signed.select("b", "bands"), "near-classes")
    with passing(docs.sparkSession):
        entries = classes.select("b", F.explode("bands").alias("band"))
        shared = entries.groupBy("band").agg(F.count("*").alias("n")).where("n > 1").select("band")
        # a row alone in a posting has no partner there, now or later
        left = stored(entries.join(shared.hint("merge"), "band", "left_semi"), "near-rest", lasting=True)
        texts = _candidates(docs, left, id_col, text_col)
    pairs, gone = None, None

    def without(rows: DataFrame, end: str) -> DataFrame:
        if gone is None:
            return rows
        keys = gone.select(F.col("b.k1").alias("g1"), F.col("b.k2").alias("g2")).hint("merge")
        return rows.join(keys, (F.col(f"{end}.k1") == F.col("g1")) & (F.col(f"{end}.k2") == F.col("g2")), "left_anti")

    for _ in range(FIRST_ROUNDS):
        with passing(docs.sparkSession):
            posted = _postings(left)
            firsts = posted.where("a <> b").groupBy("b").agg(F.min(F.struct("a", "n")).alias("first"))
            found = _verified(firsts.select("first.a", "b", "first.n"), texts)
            gone = stored(found if gone is None else gone.unionByName(found).distinct(), "near-gone", lasting=True)
            left = stored(without(posted.select("band", "b"), "b"), "near-rest", lasting=True)
    for turn in range(PIVOT_ROUNDS + 1):
        with passing(docs.sparkSession):
            posted = _postings(left)
            least = 2 if turn < STAR_ROUNDS else PAIRWISE
            few = posted.where(F.col("n") <= least) if turn < PIVOT_ROUNDS else posted
            more = _all_pairs(few) if least > 2 or turn == PIVOT_ROUNDS else few.where("a <> b").select("a", "b", "n")
            more = stored(more.groupBy("a", "b").agg(F.max("n").alias("n")), "near-left", lasting=True)
            pairs = more if pairs is None else pairs.unionByName(more)
            large = posted.where(F.col("n") > least)
            if turn == PIVOT_ROUNDS or large.isEmpty():
                break
            found = _verified(large.where("a <> b").select("a", "b", "n"), texts)
            gone = stored(found if gone is None else gone.unionByName(found).distinct(), "near-gone", lasting=True)
            left = stored(without(large.where("a <> b").select("band", "b"), "b"), "near-rest", lasting=True)
    found = _verified(without(without(pairs, "a"), "b"), texts)
    gone = found if gone is None else gone.unionByName(found).distinct()
    return stored(classes.select("b.k1", "b.k2").join(gone.select("b.k1", "b.k2").hint("merge"), ["k1", "k2"], "left_anti"), "near-keep", lasting=True)
