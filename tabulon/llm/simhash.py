"""SimHash near-duplicates through a byte-position inverted index with count filtering.

A 64-bit fingerprint is eight positional bytes.  Two fingerprints that differ in
at most ``max_bits`` bits share at least ``8 - max_bits`` of them: the guaranteed
minimum.  A posting of one positional byte would hold 1/256 of all documents, so
the index is kept on tuples of positions of exactly that guaranteed length: a pair
meets in a posting if and only if its tally reaches the minimum, and a posting
cannot hold more than 256 ** max_bits fingerprints however many documents there
are (65,536 for two bits).  Within a posting the tally and the bit distance of
candidates are then verified.  Equal fingerprints are folded first, so thousands of copies
are one entry, and large postings link through one-bit neighbours instead of all
pairs, which keeps reachability exact in linear work.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabulon.llm.common import passing, slices, stored, table, text_or_empty
from tabulon.llm.components import connected

SEED = 42
#: Posting size up to which all pairs are tallied; larger ones link through neighbours.
PAIRWISE = 48

#: byte value -> its eight bits, one in each byte of a 64-bit lane
_SPREAD = np.array([sum((v >> b & 1) << (8 * b) for b in range(8)) for v in range(256)], dtype=np.uint64)


def fingerprint(text: str, n: int = 3) -> int:
    """Unsigned 64-bit SimHash of the ``n``-word shingles of ``text``."""
    words = text.encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    size = np.fromiter(map(len, words), np.int64, len(words))
    end = np.cumsum(size + 1) - 1
    width = min(n, len(words))
    starts = (end - size)[: len(words) - width + 1].tolist()
    digest = xxhash.xxh64_intdigest
    h = np.array([digest(joined[a:b], SEED) for a, b in zip(starts, end[width - 1 :].tolist())], dtype=np.uint64)
    lanes = h.view(np.uint8).reshape(-1, 8)
    counts = np.zeros(64, np.int64)
    for i in range(0, len(lanes), 255):  # a lane's byte counts to 255
        counts += _SPREAD[lanes[i : i + 255]].sum(axis=0, dtype=np.uint64).view(np.uint8)
    return int(np.packbits(2 * counts > len(h), bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n: int = 3) -> DataFrame:
    """(id, k1, k2, fp signed 64-bit) per row; null texts are empty and get fingerprint zero."""
    k1, k2 = _row_key(F.col(id_col), text_or_empty(text_col))
    source = docs.select(F.col(id_col).alias("id"), k1.alias("k1"), k2.alias("k2"), text_or_empty(text_col).alias("text"))

    def run(batches):
        for b in slices(batches):
            fps = np.array([fingerprint(t.as_py(), n) for t in b.column(3)], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays([*b.columns[:3], pa.array(fps.view(np.int64))], names=["id", "k1", "k2", "fp"])

    return source.mapInArrow(run, f"id {dict(source.dtypes)['id']}, k1 long, k2 long, fp long")


def _row_key(id_: Column, text: Column) -> tuple[Column, Column]:
    """128 bits that tell rows apart by id and text."""
    return F.xxhash64(id_, text), F.xxhash64(text, F.lit("k2"), id_)


def _mask(positions: tuple[int, ...]) -> int:
    m = sum(255 << (8 * p) for p in positions)
    return m - (1 << 64) if m >> 63 else m


def postings(fps: DataFrame, max_bits: int = 2) -> DataFrame:
    """(positions, bytes, fps): index entries with at least two fingerprints."""
    keep = list(combinations(range(8), 8 - max_bits))
    entries = F.array(*[
        F.struct(F.lit(i).cast("byte").alias("positions"), F.col("fp").bitwiseAND(F.lit(_mask(c))).alias("bytes"))
        for i, c in enumerate(keep)
    ])
    return (
        fps.select("fp", F.explode(entries).alias("e"))
        .groupBy("e.positions", "e.bytes").agg(F.collect_list("fp").alias("fps"))
        .where(F.size("fps") > 1)
    )


def link_posting(values: np.ndarray, max_bits: int, pairwise: int = PAIRWISE) -> tuple[np.ndarray, np.ndarray]:
    """Verified links among the distinct fingerprints of one posting.

    Up to ``pairwise`` members every pair is tallied and verified.  Beyond that,
    two members are joined when they share a fingerprint at half the distance
    from each (for two bits: one-bit neighbours), chained in sorted order: the
    same reachability in about 65 entries a member.
    """
    v = np.unique(values.astype(np.int64).view(np.uint64))
    if len(v) <= pairwise:
        i, j = np.triu_indices(len(v), 1)
        a, b = v[i], v[j]
    elif max_bits != 2:
        raise ValueError("large postings are linked for two bits only")
    else:
        varying = [b for b in range(64) if len(np.unique(v >> np.uint64(b) & np.uint64(1))) > 1]
        centre = np.concatenate([v] + [v ^ (np.uint64(1) << np.uint64(b)) for b in varying])
        member = np.tile(v, len(varying) + 1)
        order = np.lexsort((member, centre))
        centre, member = centre[order], member[order]
        same = centre[1:] == centre[:-1]
        a, b = np.unique(np.stack([member[:-1][same], member[1:][same]]), axis=1)
    # every candidate, of either kind, is tallied and verified
    x = a ^ b
    shared = (x.view(np.uint8).reshape(-1, 8) == 0).sum(axis=1)
    ok = (shared >= 8 - max_bits) & (np.bitwise_count(x) <= max_bits)
    return a[ok].view(np.int64), b[ok].view(np.int64)


def links(fps: DataFrame, max_bits: int = 2) -> DataFrame:
    """(a, b) verified links whose reachability is that of all pairs within ``max_bits``."""

    def run(batches):
        for batch in batches:
            found = [link_posting(v.values.to_numpy(), max_bits) for v in batch.column(0)]
            ends = [np.concatenate([x[k] for x in found] + [np.empty(0, np.int64)]) for k in (0, 1)]
            yield pa.RecordBatch.from_arrays([pa.array(e) for e in ends], names=["a", "b"])

    # few postings hold two fingerprints: stored, they make few tasks
    shared = stored(postings(fps, max_bits).select("fps"), "simhash-postings")
    return shared.mapInArrow(run, "a long, b long")


def _labelled(docs: DataFrame, id_col: str, text_col: str, n: int, max_bits: int) -> DataFrame:
    """(id, k1, k2, fp, root, component_id) per row; root names the component even where ids repeat."""
    with passing(docs.sparkSession):
        fp = stored(fingerprints(docs, id_col, text_col, n), "simhash-fp", lasting=True)
        labels = stored(_components(fp, max_bits), "simhash-labels", lasting=True)
    return fp.join(labels, "fp").select("id", "k1", "k2", "fp", "root", "component_id")


def _components(fp: DataFrame, max_bits: int) -> DataFrame:
    """(fp, root, component_id) of every distinct fingerprint."""
    classes = stored(fp.groupBy("fp").agg(F.min("id").alias("low")), "simhash-classes")
    roots = connected(links(classes.select("fp"), max_bits))
    named = stored(classes.join(roots, F.col("fp") == F.col("node"), "left")
                   .select("fp", "low", F.coalesce("root", "fp").alias("root")), "simhash-roots")
    lows = stored(named.groupBy("root").agg(F.min("low").alias("component_id")), "simhash-lows")
    return named.join(lows, "root").select("fp", "root", "component_id")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n: int = 3, max_bits: int = 2) -> DataFrame:
    """(id, fp, component_id) for every row of ``docs``.

    component_id is the smallest id reachable over links, the row's own included.
    Null texts count as empty; all documents without words share fingerprint
    zero and so one component.  Repeated rows each return a row.  A null id is
    never the smallest unless all ids of the component are null.  Extra columns
    are not read.  An empty table gives an empty result.
    """
    return _labelled(docs, id_col, text_col, n, max_bits).select("id", "fp", "component_id")


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n: int = 3, max_bits: int = 2) -> DataFrame:
    """``docs`` without near-duplicates: of each component one document stays, with the smallest id.

    All columns return.  Where rows repeat that id, or all ids of a component are null, one of
    them stays, chosen by a hash of id and text.  Texts are shuffled once: the join and the choice among
    repeated rows share their key.
    """
    found = _labelled(docs, id_col, text_col, n, max_bits).where(F.col("id").eqNullSafe(F.col("component_id")))
    first = F.min(F.struct("k1", "k2"))
    keep = stored(found.groupBy("root").agg(first.alias("k")).select("k.k1", "k.k2"), "simhash-keep")
    k1, k2 = _row_key(F.col(id_col), text_or_empty(text_col))
    rows = docs.select(F.struct("*").alias("row"), k1.alias("k1"), k2.alias("k2")).join(keep.hint("merge"), ["k1", "k2"])
    return rows.dropDuplicates(["k1", "k2"]).select("row.*")


def hex16(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def query(spark, sf_dir):
    found = near_duplicates(table(spark, sf_dir, "documents"))
    return found.select(F.col("id").alias("doc_id"), hex16(F.col("fp")).alias("fingerprint"), "component_id")
