"""Language-model scoring of documents: a causal attention model and a word-unigram base.

1. ``tokenized``: every text is split and tokenized once, and its subword ids are stored; from here on a word is the
   bytes of its ids.  The same pass counts, per task, words and the neighbours of every subword id in the training documents.
2. Subword classes are clustered from all these neighbours.
3. ``learn``: every window of every training document takes part in one gradient step: a quarter of the
   windows in a first round, the others in a second one that starts from the first round's average.  Each
   task steps by itself; weights are averaged by windows seen.  The first round also counts ids by the class before.
4. ``score``: overlapping windows score each token once, from the stored ids.

Word counts are looked up in two ways.  The ``COMMON`` most frequent short words, a
bounded table, are broadcast; they cover most tokens and every hot word.  All other
words are joined with the count table as (word, document) pairs.

A text's score is the log10 probability of its lower-cased words and its end: each word's
is a mixture of the attention model's (its subword ids given all before) and, with
``CACHE_SHARE``, of a unigram cache of the common words.

What reaches the driver is bounded whatever the corpus: ``COMMON`` words, one count per (id, place) and per
(class, id), and ``SUMS`` vectors of weights.
"""

from __future__ import annotations

from array import array
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabulon.llm import attention
from tabulon.llm.attention import BATCH, CLASSES, END, PLACES, VOCABULARY
from tabulon.llm.common import crc_class, passing, slices, stored, table, text_or_empty
from tabulon.llm.packing import Tokenizer

#: Words of at most this many bytes, and how many of them, are broadcast: at most 8 MB.
COMMON, COMMON_BYTES = 131_072, 48
#: Windows of round 0 are one in so many, the others are of round 1; and the steps' rates.
FIRST_ONE_IN, RATES = 4, (0.1, 0.15)
#: Vectors of weights that are summed on the driver.
SUMS = 16
#: Share of the unigram cache of common words in a word's probability.
CACHE_SHARE = 0.2
HELD_OUT = 7, 2
#: Words that a task counts, or whose ids it remembers, at once.
FLUSH = 300_000
#: Ids of a word that fit into one 64-bit number.
SHORT = 4


def words_of(text: str) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").lower().split()


class Subwords(dict):
    """Subword ids of words, as bytes of 16-bit integers, remembered by word."""

    def __init__(self, ranks_path: str | None = None):
        self._encode = Tokenizer(ranks_path).encode

    def __missing__(self, word: bytes) -> bytes:
        found = array("H", self._encode(" " + word.decode("utf-8", "replace"))).tobytes()
        if len(word) < 40:
            self[word] = found
        return found

    def of(self, words: list[bytes]) -> list[bytes]:
        """The ids of each word."""
        if len(self) > FLUSH:
            self.clear()
        return list(map(self.__getitem__, words))


#: The end of a text as the bytes of its id, which no word holds; and whether an id begins with a space, as the first one of every word does.
END_ID = np.array([END], np.uint16).tobytes()


@cache
def begins_word(ranks_path: str | None = None) -> np.ndarray:
    """Per id: whether a word, or the end of a text, begins with it."""
    out = np.zeros(VOCABULARY, bool)
    for token, i in Tokenizer(ranks_path).ranks.items():
        out[i] = token.startswith(b" ")
    out[END] = True
    return out


@cache
def subwords(ranks_path: str | None = None) -> Subwords:
    """A worker's subwords, kept for its next tasks."""
    return Subwords(ranks_path)


def _chunks(texts: list, limit: int = 400_000) -> Iterator[slice]:
    """Runs of a batch's texts (or ids) of about ``limit`` characters (or bytes)."""
    at = 0
    while at < len(texts):
        upto, size = at, 0
        while upto < len(texts) and (upto == at or size + len(texts[upto]) < limit):
            size += len(texts[upto])
            upto += 1
        yield slice(at, upto)
        at = upto


def _packed(raw: bytes, places: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Words of at most ``SHORT`` ids as one number each, unused places filled with an id that there is none of; of longer ones the first ids."""
    every = np.ndarray(len(raw) // 2, "<u8", raw + bytes(2 * SHORT), strides=(2,))
    fill = np.array([(1 << 64) - (1 << 16 * n) for n in range(SHORT)] + [0], np.uint64)
    return every[places] | fill[np.minimum(size, SHORT)]


def joined(ids: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """All texts' stored ids in one array, and where each text stops."""
    return np.frombuffer(b"".join(ids), np.uint16).astype(np.int64), np.cumsum(np.fromiter(map(len, ids), np.int64, len(ids)) >> 1)


def _before(tokens: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """What stands before each token; the end id before a text's first."""
    before = np.concatenate([[END], tokens[:-1]])
    before[ends[:-1]] = END
    return before


def _counted(at: np.ndarray, n: np.ndarray, columns: list[str], name: str) -> Iterator[pa.RecordBatch]:
    """Rows (``name``, n); the other columns are null."""
    for i in range(0, len(at), 100_000):
        part = {name: pa.array(at[i : i + 100_000], pa.int32()), "n": pa.array(n[i : i + 100_000], pa.int64())}
        yield _rows(part, columns)


_TYPES = {"th": pa.int64(), "held": pa.bool_(), "ids": pa.binary(), "word": pa.binary(), "near": pa.int32(), "pair": pa.int32(),
          "vec": pa.binary(), "n": pa.int64()}


def _rows(part: dict[str, pa.Array], columns: list[str], types: dict | None = None) -> pa.RecordBatch:
    many = len(next(iter(part.values())))
    types = {**_TYPES, **(types or {})}
    return pa.RecordBatch.from_arrays([part[c] if c in part else pa.nulls(many, types[c]) for c in columns], names=columns)


def tokenized(source: DataFrame, ranks_path: str | None = None) -> DataFrame:
    """From (id, held, text), rows of three kinds.

    (id, th, held, ids): every text's hash and subword ids, the end included; (word, n): counts of the training texts'
    words and ends; (near, n): how often each id stands next to each place.  Counts are a task's share.
    """
    id_type = dict(source.dtypes)["id"]
    columns = ["id", "th", "held", "ids", "word", "near", "n"]
    keyed = source.select("id", F.xxhash64("text").alias("th"), "held", "text")

    def run(batches):
        sub = subwords(ranks_path)
        counts: Counter = Counter()
        near = np.zeros((VOCABULARY, 2 * PLACES), np.int32)
        types = None

        def words() -> pa.RecordBatch:
            out = _rows({"word": pa.array(list(counts), pa.binary()), "n": pa.array(list(counts.values()), pa.int64())}, columns, types)
            counts.clear()
            return out

        for b in slices(batches):
            types = {"id": b.schema.field(0).type}
            texts = b.column(3).to_pylist()
            train = [not h for h in b.column(2).to_pylist()]
            found = []
            for part in _chunks(texts):
                ids = []
                for text, t in zip(texts[part], train[part]):
                    words_ids = [*sub.of(words_of(text)), END_ID]
                    ids.append(b"".join(words_ids))
                    if t:
                        counts.update(words_ids)
                found += ids
                learned = [i for i, t in zip(ids, train[part]) if t]
                if learned:
                    tokens, ends = joined(learned)
                    attention.neighbours(_before(tokens, ends), tokens, near)
                if len(counts) > FLUSH:
                    yield words()
            yield _rows({**dict(zip(("id", "th", "held"), b.columns)), "ids": pa.array(found, pa.binary())}, columns, types)
        if counts:
            yield words()
        if types:
            at = np.flatnonzero(near)
            for i in range(0, len(at), 100_000):
                part = at[i : i + 100_000]
                yield _rows({"near": pa.array(part, pa.int32()), "n": pa.array(near.ravel()[part], pa.int64())}, columns, types)

    return keyed.mapInArrow(run, f"id {id_type}, th long, held boolean, ids binary, word binary, near int, n long")


def learn(docs: DataFrame, classes_of: np.ndarray, weights: dict, turn: int) -> DataFrame:
    """Rows of two kinds from the training documents' (th, ids), each task's share.

    (vec, n): weights after steps on all windows of round ``turn``, and how many these are; (pair, n), in round 0:
    counts of (class of the id before, id).
    """
    shared = docs.sparkSession.sparkContext.broadcast((classes_of.astype(np.int16), attention.flat(weights)))
    columns = ["pair", "vec", "n"]

    def run(batches):
        known, first = shared.value
        known = known.astype(np.int64)
        pairs = np.zeros((CLASSES, VOCABULARY), np.int64) if turn == 0 else None
        trainer = attention.Trainer(attention.unflat(first), rate=RATES[turn])
        left: list[np.ndarray] = []
        rng = np.random.default_rng(turn)

        def steps(ids, wanted, valid, least: int):
            """Full batches are learned; what is left over is returned."""
            at = 0
            while len(ids) - at >= least:
                part = slice(at, at + BATCH)
                trainer.step(ids[part], known[wanted[part]], valid[part])
                at += BATCH
            return [x[at:] for x in (ids, wanted, valid)]

        for b in slices(batches):
            stored_ids = b.column(1).to_pylist()
            for part in _chunks(stored_ids):
                tokens, ends = joined(stored_ids[part])
                if pairs is not None:
                    np.add.at(pairs.ravel(), known[_before(tokens, ends)] * VOCABULARY + tokens, 1)
                th = b.column(0).slice(part.start, len(ends)).to_numpy()
                pick = lambda text, nth, th=th: rng.permutation(np.flatnonzero(((th[text] + nth) % FIRST_ONE_IN == 0) == (turn == 0)))
                w = attention.windows(tokens, ends, 0, pick)
                new = [w.ids, w.wanted, w.scored]
                left = steps(*([np.concatenate(x) for x in zip(left, new)] if left else new), BATCH)
        if left and len(left[0]):
            steps(*left, 1)
        if pairs is not None:
            at = np.flatnonzero(pairs)
            yield from _counted(at, pairs.ravel()[at], columns, "pair")
        if trainer.seen:
            yield _rows({"vec": pa.array([attention.flat(trainer.w).tobytes()], pa.binary()), "n": pa.array([trainer.seen], pa.int64())}, columns)

    return docs.select("th", "ids").mapInArrow(run, "pair int, vec binary, n long")


def averaged(vectors: DataFrame, weights: dict) -> dict:
    """The mean of (vec, n) rows' weights by n; ``weights`` where there is no row.  Sums are taken in tasks first."""

    def run(batches):
        total, many = 0.0, 0
        for b in slices(batches, 64):
            for vec, n in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                total, many = total + np.frombuffer(vec, np.float32) * np.float64(n), many + n
        if many:
            yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary()), pa.array([many], pa.int64())], names=["vec", "n"])

    sums = vectors.repartition(SUMS).mapInArrow(run, "vec binary, n long").toArrow()
    if not sums.num_rows:
        return weights
    total = sum(np.frombuffer(v, np.float64) for v in sums["vec"].to_pylist())
    return attention.unflat(total / sum(sums["n"].to_pylist()))


def _table(rows: DataFrame, key: str, shape: tuple[int, int]) -> np.ndarray:
    """Sums of n per key as a table of a fixed shape, which bounds what reaches the driver."""
    out = np.zeros(shape, np.int64)
    found = rows.where(F.col(key).isNotNull()).groupBy(key).agg(F.sum("n").alias("n")).toArrow()
    out.ravel()[found[key].to_numpy()] = found["n"].to_numpy()
    return out


@dataclass
class Fitted:
    """All that scoring needs of the training documents."""

    model: attention.Model
    common: dict[bytes, int]
    cached: int  # tokens that the common words and the ends make up
    ends: int
    n_all: int
    n_distinct: int


def fit(tokens: DataFrame, counts: DataFrame) -> Fitted:
    """The model of the training rows of a stored ``tokenized`` table; ``counts`` are its summed (word, c)."""
    is_end = F.col("word") == F.lit(END_ID)
    totals = counts.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count("*"), F.coalesce(F.sum(F.when(is_end, F.col("c"))), F.lit(0))).first()
    n_all, n_distinct, n_ends = map(int, totals)
    top = counts.where(F.length("word") <= COMMON_BYTES).orderBy(F.desc("c"), "word").limit(COMMON).toArrow()
    common = dict(zip(top["word"].to_pylist(), top["c"].to_pylist()))
    classes_of = attention.cluster(_table(tokens, "near", (VOCABULARY, 2 * PLACES)).astype(np.float32))
    train = tokens.where("ids IS NOT NULL AND NOT held")
    weights, pairs = attention.fresh(), None
    for turn in range(len(RATES)):
        learned = stored(learn(train, classes_of, weights, turn), "lm-learned")
        if turn == 0:
            pairs = _table(learned, "pair", (CLASSES, VOCABULARY))
        weights = averaged(learned.where("vec IS NOT NULL").select("vec", "n"), weights)
    model = attention.Model(weights, classes_of, attention.count_table(pairs, classes_of))
    cached = n_ends + sum(c for w, c in common.items() if w != END_ID)
    return Fitted(model, common, cached, n_ends, n_all, n_distinct)


def text_scores(lm: attention.Model, tokens: np.ndarray, ends: np.ndarray, at: np.ndarray, known: np.ndarray, cached: int) -> np.ndarray:
    """log10 probability of each text's words and end.

    ``known`` has log10(count + 1) of every word and end in order, 0 for a word that is not common; ``at`` tells
    where these begin among the ids.
    """
    model = np.add.reduceat(lm.token_log10(tokens, ends), at, dtype=np.float64)
    with np.errstate(divide="ignore", over="ignore"):
        cache_part = CACHE_SHARE / max(cached, 1) * (10.0**known - 1)
        mixed = np.where(model > -290, np.log10(cache_part + (1 - CACHE_SHARE) * 10.0**model), model + np.log10(1 - CACHE_SHARE))
    words = np.searchsorted(at, ends)
    return np.add.reduceat(mixed, np.concatenate([[0], words[:-1]]))


def score(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", ranks_path: str | None = None) -> DataFrame:
    """(id, held_out, n_tokens, n_known, train_tokens, base_score, score) per row.

    Null texts are empty: the end token alone.  Without training documents every
    count is zero and the model stays at its first weights.  Repeated rows repeat; extra
    columns are not read; an empty table gives an empty result.
    """
    modulus, held = HELD_OUT
    source = docs.select(F.col(id_col).alias("id"), text_or_empty(text_col).alias("text"))
    source = source.select("id", (crc_class("id", modulus) == held).alias("held"), "text")
    tokens = stored(tokenized(source, ranks_path), "lm-tokens")
    counts = stored(tokens.where("word IS NOT NULL").groupBy("word").agg(F.sum("n").alias("c")), "lm-words")
    with passing(docs.sparkSession):
        fitted = fit(tokens, counts)
    return scored(tokens.where("ids IS NOT NULL").select("id", "th", "ids"), counts, fitted, ranks_path)


def scored(texts: DataFrame, counts: DataFrame, fitted: Fitted, ranks_path: str | None = None) -> DataFrame:
    """The rows of ``score`` for stored (id, th, ids)."""
    shared = texts.sparkSession.sparkContext.broadcast(fitted)
    id_type = dict(texts.dtypes)["id"]
    names = ["word", "id", "th", "tf", "logs", "known", "n_tokens", "score"]

    def run(batches):
        f: Fitted = shared.value
        first = begins_word(ranks_path)
        logs = np.log10(np.fromiter(f.common.values(), np.float64, len(f.common)) + 1.0).tolist()
        known_log = {**dict(zip(f.common, logs)), END_ID: float(np.log10(f.ends + 1.0))}
        short = [w for w in known_log if len(w) <= 2 * SHORT]
        packed = np.frombuffer(b"".join([w.ljust(2 * SHORT, b"\xff") for w in short]), "<u8")
        order = np.argsort(packed)
        packed, packed_logs = packed[order], np.array([known_log[w] for w in short])[order]
        for b in slices(batches):
            all_ids = b.column(2).to_pylist()
            for part in _chunks(all_ids):
                tokens, ends = joined(all_ids[part])
                places = np.flatnonzero(first[tokens])  # words and ends
                stops = np.searchsorted(places, ends)
                many = np.diff(stops, prepend=0)
                raw, size = b"".join(all_ids[part]), np.diff(places, append=len(tokens))
                key = _packed(raw, places, size)
                found = np.minimum(np.searchsorted(packed, key), len(packed) - 1)
                common = (packed[found] == key) & (size <= SHORT)
                known = np.where(common, packed_logs[found], 0.0)
                word_at = lambda at, raw=raw, cuts=2 * np.append(places, len(tokens)): [raw[x:y] for x, y in zip(cuts[at].tolist(), cuts[at + 1].tolist())]
                long = np.flatnonzero(size > SHORT)
                logs_of = np.array([known_log.get(w, np.nan) for w in word_at(long)], np.float64)
                common[long] = ~np.isnan(logs_of)
                known[long] = np.where(common[long], logs_of, 0.0)
                text_of, other = np.repeat(np.arange(len(many)), many), np.flatnonzero(~common)
                rest = Counter(zip(text_of[other].tolist(), word_at(other)))
                at, word, tf = [i for i, _ in rest], [w for _, w in rest], list(rest.values())
                scores = text_scores(f.model, tokens, ends, places, known, f.cached)
                begin = stops - many
                sums = np.add.reduceat(known, begin).tolist()
                seen_words = (np.add.reduceat(common.astype(np.int64), begin) - (f.ends == 0)).tolist()
                n, start = len(many), part.start
                rows = pa.array(np.concatenate([np.arange(n), np.array(at, np.int64)]) + start, pa.int64())
                th = b.column(1).slice(start, n).to_numpy()
                keys = [END_ID + x.tobytes() for x in th]  # the document's own row: a key of its own, which no word equals
                pad = [None] * len(word)
                yield pa.RecordBatch.from_arrays([
                    pa.array(keys + word, pa.binary()), b.column(0).take(rows), b.column(1).take(rows), pa.array([0] * n + tf, pa.int64()),
                    pa.array(sums + pad, pa.float64()), pa.array(seen_words + pad, pa.int64()),
                    pa.array(many.tolist() + pad, pa.int64()), pa.array(scores.tolist() + pad, pa.float64())], names=names)

    found = texts.mapInArrow(run, f"word binary, id {id_type}, th long, tf long, logs double, known long, n_tokens long, score double")
    looked = found.join(counts.withColumnRenamed("word", "w"), F.col("word") == F.col("w"), "left")
    c = F.coalesce("c", F.lit(0))
    per_doc = looked.groupBy("id", "th").agg(
        F.count("n_tokens").alias("copies"), F.max("n_tokens").alias("n_tokens"), F.max("score").alias("score"),
        F.max("logs").alias("logs"), F.max("known").alias("known"),
        F.sum(F.col("tf") * F.log10(c + F.lit(1.0))).alias("rare_logs"), F.sum(F.when(c > 0, F.col("tf")).otherwise(F.lit(0))).alias("rare_known"))
    each = per_doc.select("*", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))))
    unit = float(np.log10(fitted.n_all + fitted.n_distinct + 1.0))
    modulus, held = HELD_OUT
    return each.select(
        "id", (crc_class("id", modulus) == held).alias("held_out"), "n_tokens",
        (F.col("known") + F.col("rare_known") / F.col("copies")).cast("long").alias("n_known"),
        F.lit(fitted.n_all).cast("long").alias("train_tokens"),
        (F.col("logs") + F.col("rare_logs") / F.col("copies") - F.col("n_tokens") * F.lit(unit)).alias("base_score"), "score")


def query(spark, sf_dir):
    return score(table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")


SQL = None
