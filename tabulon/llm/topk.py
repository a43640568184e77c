"""Exact top-k inner products by norm-bucketed retrieval.

Vectors are grouped by length (norm) into buckets of half octaves.  Within a bucket they lie in the order of their
leading coordinate (the largest, with its sign) and are cut into blocks of about ``BLOCK`` rows, so that neither a common
length, a common direction nor a vector that is repeated a million times makes a large task.  Queries are blocks too.

A first pass scores each query against one block of the longest vectors, which gives a lower bound of
its k-th best score.  Against every other block, that bound over both lengths is the block's
local cosine threshold: over 1, the block cannot hold a result, and the pair is never shipped
(if so for every query of the block) or skipped.  For the others the way is chosen by cost, block by block:

* length pruning takes the products with the vectors that are long enough;
* coordinate pruning takes the products over the coordinates that hold most energy, adds the greatest value
  that the others can add (the product of both remaining lengths), and goes on with the pairs that can still reach the bound.

What the second costs depends on the threshold; it is estimated on a sample of the block.  Survivors' products are
computed exactly in integers (as doubles while these stay below 2^53).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabulon.llm.common import slices, stored, table

BLOCK = 4096
QUERIES = 512
#: Vectors on which the cost of coordinate pruning is estimated, and the cost of a gathered product against one in a block.
SAMPLE, GATHER = 64, 4.0
#: Pairs of blocks that one join key may hold.
SPREAD = 64
LARGEST = 2**63 - 1


def _finite(v: Column) -> Column:
    good = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return v.isNotNull() & F.coalesce(good, F.lit(False))


def scaled(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", scale: int = 1024) -> DataFrame:
    """(id, v array<long>, norm, bucket, cell): floor(scale * x) of every component, cut to 64 bits.

    Vectors that are null or hold a null or non-finite component take no part; every row counts, repeated ones too.
    ``cell`` is the place of the leading coordinate, from 1, negative where that is negative (0 for a zero vector).
    """
    rows = vectors.select(F.col(id_col).alias("id"), F.col(vec_col).cast("array<double>").alias("x")).where(_finite(F.col("x")))
    rows = rows.select("id", F.transform("x", lambda x: F.floor(x * F.lit(float(scale)))).alias("v"))
    norm = F.sqrt(F.aggregate("v", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double")))
    size = F.transform("v", lambda x: F.abs(x.cast("double")))
    lead = F.array_position(size, F.array_max(size)).cast("int")
    sign = F.when(F.element_at("v", F.greatest(lead, F.lit(1))) < 0, -1).otherwise(1)
    rows = rows.withColumn("norm", norm).withColumn("bucket", F.floor(2 * F.log2(F.col("norm") + 1.0)).cast("int"))
    return rows.withColumn("cell", F.when(F.col("norm") > 0, lead * sign).otherwise(F.lit(0)))


def _matrix(lists: pa.ListArray) -> np.ndarray:
    """Lists of integers as the rows of one matrix, shorter ones padded with zeros."""
    size = np.diff(lists.offsets.to_numpy())
    flat = lists.flatten().to_numpy(zero_copy_only=False)
    out = np.zeros((len(size), int(size.max(initial=0))), np.int64)
    out[np.arange(out.shape[1]) < size[:, None]] = flat
    return out


def _same_width(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    width = max(a.shape[1], b.shape[1])
    pad = lambda m: np.pad(m, ((0, 0), (0, width - m.shape[1])))
    return pad(a), pad(b)


def _top(rows: np.ndarray, cols: np.ndarray, scores: np.ndarray, ids: np.ndarray, k: int):
    """The k best of each row: highest scores, ties to smaller ids."""
    order = np.lexsort((ids[cols], -scores, rows))
    rows, cols, scores = rows[order], cols[order], scores[order]
    nth = np.arange(len(rows)) - np.searchsorted(rows, rows, side="left")
    keep = nth < k
    return rows[keep], cols[keep], scores[keep]


def _partial(q, p, q_norm, p_norm, fields):
    """Upper bounds of all products from some coordinates: their products, and the most that the others can add."""
    qf, pf = q[:, fields], p[:, fields]
    rest = lambda norm, part: np.sqrt(np.maximum(norm**2 - (part**2).sum(axis=1), 0) + 1e-9 * norm**2)
    return qf @ pf.T + np.outer(rest(q_norm, qf), rest(p_norm, pf)) * (1 + 1e-9)


def choose_way(q, p, q_norm, p_norm, bound, long_enough) -> tuple[int, float]:
    """(number of leading coordinates, or 0 for length pruning; its estimated cost) of the cheapest way through a block."""
    ways = [(0, float(long_enough.mean()) / len(p))]
    width = q.shape[1]
    at = slice(None, None, max(1, len(p) // SAMPLE))
    for n in (width // 4, width // 2):
        if n >= 2:
            share = (_partial(q, p[at], q_norm, p_norm[at], leading(q, p, n)) >= bound[:, None]).mean()
            ways.append((n, n / width + GATHER * float(share)))
    return min(ways, key=lambda w: w[1])


def leading(q: np.ndarray, p: np.ndarray, n: int) -> np.ndarray:
    """The ``n`` coordinates with most energy in queries and vectors."""
    return np.argsort(-((q**2).sum(axis=0) * (p**2).sum(axis=0)), kind="stable")[:n]


def best_of_block(q_ids, q, q_norm, bound, p_ids, p, p_norm, k: int, stats: dict | None = None):
    """(query row, vector row, score) of what may be among each query's k best.

    ``bound``: a score that k other vectors of the query are known to reach, or -inf.  ``stats`` gets the numbers of
    pairs, of products taken in full, and the way.
    """
    q, p = _same_width(q, p)
    order = np.argsort(-p_norm, kind="stable")
    p, p_norm, p_ids = p[order], p_norm[order], p_ids[order]
    tally = {"pairs": len(q) * len(p), "products": 0, "way": "skipped"}
    if stats is not None:
        stats.update(tally)
    none = np.zeros(0, np.int64)
    with np.errstate(divide="ignore", invalid="ignore"):
        reach = np.where(bound > 0, bound / np.maximum(q_norm, 1e-300) * (1 - 1e-9), 0.0)
    long_enough = np.searchsorted(-p_norm, -reach, side="right")  # a positive bound needs so much length
    live = np.flatnonzero(long_enough > 0)
    if not len(live):
        return none, none, []
    upto = int(long_enough.max())
    p, p_norm, p_ids = p[:upto], p_norm[:upto], p_ids[:upto]
    if float(q_norm.max(initial=0.0)) * float(p_norm[0]) >= 2.0**52:  # beyond exact doubles: plain integers
        rows, cols, scores = [], [], []
        for i in live.tolist():
            at = np.flatnonzero(p_ids[: long_enough[i]] != q_ids[i])
            exact = p[at].astype(object) @ q[i].astype(object) if q.shape[1] else np.zeros(len(at), object)
            best = sorted((-s, int(p_ids[j]), int(j)) for s, j in zip(exact, at) if s >= bound[i])[:k]
            rows += [i] * len(best)
            cols += [j for _, _, j in best]
            scores += [max(-LARGEST - 1, min(LARGEST, -s)) for s, _, _ in best]
        if stats is not None:
            stats.update(products=int(long_enough.sum()), way="integers")
        return np.array(rows, np.int64), order[np.array(cols, np.int64)], scores
    qd, pd_ = q[live].astype(np.float64), p.astype(np.float64)
    least, norms, size = bound[live], q_norm[live], long_enough[live]
    fields, _ = choose_way(qd, pd_, norms, p_norm, least, size)
    if fields:
        rows, cols = np.nonzero(_partial(qd, pd_, norms, p_norm, leading(qd, pd_, fields)) >= least[:, None])
        ok = (cols < size[rows]) & (p_ids[cols] != q_ids[live][rows])
        rows, cols = rows[ok], cols[ok]
        parts = [np.einsum("ij,ij->i", qd[rows[i : i + 50_000]], pd_[cols[i : i + 50_000]]) for i in range(0, len(rows), 50_000)]
        scores = np.concatenate(parts) if parts else np.zeros(0)
        ok = scores >= least[rows]
        rows, cols, scores = rows[ok], cols[ok], scores[ok]
        products = int(ok.size)
    else:
        found = qd @ pd_.T
        found[(p_ids[None, :] == q_ids[live][:, None]) | (np.arange(upto) >= size[:, None]) | (found < least[:, None])] = -np.inf
        if upto > 4 * k:
            kth = np.partition(found, upto - k, axis=1)[:, upto - k]
            found[found < kth[:, None]] = -np.inf
        rows, cols = np.nonzero(found > -np.inf)
        scores, products = found[rows, cols], int(size.sum())
    if stats is not None:
        stats.update(products=products, way="coordinates" if fields else "length")
    rows, cols, scores = _top(rows, cols, scores, p_ids, k)
    return live[rows], order[cols], [int(x) for x in scores]


def _blocks(rows: DataFrame, size: int, by_length: bool) -> DataFrame:
    """Rows gathered to blocks of about ``size``: (block, ids, vs, norms, longest).

    Rows lie in the order of bucket and cell, at a hashed place within these: sizes are known from the cells' counts, so no
    row is numbered.
    """
    groups = ["bucket", "cell"] if by_length else ["cell"]
    counts = rows.groupBy(*groups).agg(F.count("*").alias("n"))  # at most some hundred lengths times twice the width
    before = Window.partitionBy(*groups[:-1]).orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    counts = stored(counts.withColumn("ahead", F.coalesce(F.sum("n").over(before), F.lit(0))), "topk-counts").select(*[F.col(g).alias(f"c_{g}") for g in groups], "n", "ahead")
    same = [F.col(g) == F.col(f"c_{g}") for g in groups]
    dealt = rows.withColumn("row", F.monotonically_increasing_id()).join(F.broadcast(counts), same)
    dealt = dealt.withColumn("part", F.floor((F.col("ahead") + F.pmod(F.xxhash64("row"), F.col("n"))) / size).cast("int"))
    packed = dealt.groupBy(*groups[:-1], "part").agg(F.collect_list(F.struct("id", "v", "norm")).alias("m"), F.max("norm").alias("longest"))
    key = F.struct("bucket", "part") if by_length else F.col("part")
    return packed.select(key.alias("block"), F.col("m.id").alias("ids"), F.col("m.v").alias("vs"), F.col("m.norm").alias("norms"), "longest")


def _pairs(vectors: DataFrame, k: int, is_query: Column | None, id_col: str, vec_col: str) -> DataFrame:
    """Every query block with its bounds beside every vector block that may hold a result of it."""
    is_query = F.col("id") % 100 == 0 if is_query is None else is_query
    rows = stored(scaled(vectors, id_col, vec_col).where(F.col("id").isNotNull()), "topk-scaled")
    blocks = stored(_blocks(rows, BLOCK, True), "topk-blocks")
    queries = stored(_blocks(rows.where(is_query), QUERIES, False), "topk-queries")
    queries = queries.withColumn("reach", F.lit(0.0))
    seed = stored(blocks.orderBy((F.size("ids") > k).desc(), F.desc("longest"), "block").limit(1), "topk-seed")
    found = _joined(queries, seed).mapInArrow(_bounds(k), "part int, bounds array<double>, least double")
    bounded = stored(found, "topk-bounds").select(F.col("part").alias("p"), "bounds", F.col("least").alias("reach"))
    return _joined(queries.drop("reach").join(bounded, F.col("block") == F.col("p")).drop("p"), blocks)


def top_k(vectors: DataFrame, k: int = 10, is_query: Column | None = None, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): each query's k highest products with other rows, ties to smaller ids.

    ``is_query`` picks queries by the column ``id``; rows without an id take no
    part; rows that repeat are as many candidates.  Vectors of other lengths are padded with zeros.
    Queries with fewer than k candidates return all of them.  Components and scores beyond 64 bits are cut to them
    (scores after they were ranked, so only such rows meet the cut).  Extra columns are not read; an empty table gives an empty result.
    """
    found = _pairs(vectors, k, is_query, id_col, vec_col).mapInArrow(_search(k), "query_id long, vec_id long, score long")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return ranked.select(F.col("query_id"), "rank", "vec_id", "score")


def pruning(vectors: DataFrame, k: int = 10, is_query: Column | None = None, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """(bucket, way, blocks, pairs, products): how the pairs of blocks that were shipped were searched, and how many products were taken in full."""

    def run(batches):
        for b in slices(batches, 1):
            stats: dict = {}
            (q_ids, q, q_norm), (p_ids, p, p_norm) = _sides(b, 0)
            best_of_block(q_ids, q, q_norm, _np(b.column(b.schema.get_field_index("bounds")), 0), p_ids, p, p_norm, k, stats)
            bucket = b.column(b.schema.get_field_index("vb")).field("bucket")
            yield pa.RecordBatch.from_arrays([bucket, pa.array([stats["way"]]), pa.array([stats["pairs"]]), pa.array([stats["products"]])], names=["bucket", "way", "pairs", "products"])

    found = _pairs(vectors, k, is_query, id_col, vec_col).mapInArrow(run, "bucket int, way string, pairs long, products long")
    return found.groupBy("bucket", "way").agg(F.count("*").alias("blocks"), F.sum("pairs").alias("pairs"), F.sum("products").alias("products"))


def _joined(queries: DataFrame, blocks: DataFrame) -> DataFrame:
    """Every query block with every vector block that may hold a result of it.

    Both are blocks of thousands of rows.  The pairs are chosen on their keys and two numbers alone: the
    least length that a vector needs for any query of the block, and the block's longest.  Then each side joins on a
    salted key, so that however many blocks the other side has, a key holds about ``SPREAD`` pairs.
    """
    q_keys = stored(queries.select(F.col("block").alias("qb"), "reach"), "topk-query-keys")
    b_keys = blocks.select(F.col("block").alias("vb"), "longest")
    n, m = max(1, q_keys.agg(F.coalesce(F.max("qb"), F.lit(-1)) + 1).first()[0]), max(1, b_keys.count())
    q_salts, b_salts = -(-m // SPREAD), -(-n // SPREAD)
    pairs = b_keys.withColumn("qb", F.explode(F.sequence(F.lit(0), F.lit(n - 1)))).join(q_keys, "qb").where(F.col("longest") * (1 + 1e-9) >= F.col("reach"))
    pairs = pairs.select("qb", "vb", F.pmod(F.xxhash64("vb"), F.lit(q_salts)).alias("s"), F.pmod(F.col("qb"), F.lit(b_salts)).alias("t"))
    copies = lambda k: F.explode(F.sequence(F.lit(0), F.lit(k - 1)).cast("array<long>"))
    q = queries.select(F.col("block").alias("qb"), F.col("ids").alias("q_ids"), F.col("vs").alias("q_vs"), F.col("norms").alias("q_norms"),
                       *(["bounds"] if "bounds" in queries.columns else []), copies(q_salts).alias("s"))
    b = blocks.select(F.col("block").alias("vb"), "ids", "vs", "norms", copies(b_salts).alias("t"))
    return pairs.join(q, ["qb", "s"]).withColumn("t", F.col("t").cast("long")).join(b, ["vb", "t"])


def _np(column, i) -> np.ndarray:
    return column[i].values.to_numpy(zero_copy_only=False)


def _sides(batch, i):
    get = lambda name: batch.column(batch.schema.get_field_index(name))
    side = []
    for ids, vs, norms in (("q_ids", "q_vs", "q_norms"), ("ids", "vs", "norms")):
        side.append((_np(get(ids), i), _matrix(get(vs)[i].values), _np(get(norms), i)))
    return side


def _bounds(k: int):
    def run(batches):
        for b in batches:
            out, least = [], []
            for i in range(b.num_rows):
                (q_ids, q, q_norm), (p_ids, p, p_norm) = _sides(b, i)
                lowest = np.full(len(q), -np.inf)
                at, _, score = best_of_block(q_ids, q, q_norm, lowest, p_ids, p, p_norm, k)
                bound = lowest.copy()
                by: dict[int, list[int]] = {}
                for a, s in zip(at.tolist(), score):
                    by.setdefault(a, []).append(s)
                for a, s in by.items():
                    if len(s) == k:
                        bound[a] = float(min(s))
                out.append(bound)
                with np.errstate(divide="ignore", invalid="ignore"):
                    least.append(float(np.where(bound > 0, bound / np.maximum(q_norm, 1e-300), 0.0).min(initial=np.inf)))
            part = b.column(b.schema.get_field_index("qb"))
            yield pa.RecordBatch.from_arrays([part, pa.array(out, pa.list_(pa.float64())), pa.array(least, pa.float64())], names=["part", "bounds", "least"])

    return run


def _search(k: int):
    def run(batches):
        for b in batches:
            query, vector, score = [], [], []
            for i in range(b.num_rows):
                (q_ids, q, q_norm), (p_ids, p, p_norm) = _sides(b, i)
                bound = _np(b.column(b.schema.get_field_index("bounds")), i)
                at, to, found = best_of_block(q_ids, q, q_norm, bound, p_ids, p, p_norm, k)
                query.append(q_ids[at])
                vector.append(p_ids[to])
                score += found
            none = np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate([*query, none]), pa.int64()), pa.array(np.concatenate([*vector, none]), pa.int64()), pa.array(score, pa.int64())],
                names=["query_id", "vec_id", "score"])

    return run


def query(spark, sf_dir):
    return top_k(table(spark, sf_dir, "embeddings"))


SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_dot_product(q.v, c.v)::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id % 100 = 0 AND c.vec_id <> q.vec_id),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 10
"""
