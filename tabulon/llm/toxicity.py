"""Toxicity from subword-bag embeddings averaged into a linear softmax.

A word is the bag of its character n-grams (bytes, with word ends) and itself,
hashed into one embedding table; a window of a few words is the average of its
words' vectors; a softmax over that average is trained jointly with the table in
numpy.  A misspelt or new form shares most n-grams with forms that were seen.

A text is as toxic as its worst window, so a few words do not drown in a long
document.  Labels are per document: training alternates between choosing the worst
windows of each toxic document and fitting them against windows of clean ones.  Windows
are chosen from whole texts, in Spark tasks; the driver gets chosen windows only, at most
four a document.  The threshold is set on whole texts of other labelled documents.

Scoring touches every byte of every text: because vectors are only averaged, each
n-gram bucket contributes one number, and batches are scored with array
operations on their joined bytes.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabulon.llm.common import crc_class, passing, slices, stored, table, text_or_empty

#: Documented bounds of the training sample: labelled documents per class, each with its whole text.
TOXIC_DOCS = 1200
CLEAN_DOCS = 4000
#: Tasks that read the sample.
TASKS = 32
BUCKETS = 1 << 16
DIM = 8
GRAMS = (3, 4, 5)
WINDOW = 6
ROUNDS = 4
EPOCHS = 3
#: Windows of one gradient step.
BATCH = 64
#: Windows chosen in a round: the worst ones of a clean and of a toxic document, and random ones of a clean one.
WORST, RANDOM = (2, 2), 2
#: Bytes that are taken apart at once; a longer text is read in pieces that share a window's words.
PIECE = 200_000
SEED = 7
#: Share of the training documents that set the threshold and take no part in the fit.
HOLD = 5

_FOLD = bytes(
    32 if (c < 128 and not chr(c).isalnum()) else ord(chr(c).lower()) if c < 128 else c for c in range(256)
)
_P1, _P2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(29))) * _P2
    return ((h ^ (h >> np.uint64(32))) & np.uint64(BUCKETS - 1)).astype(np.int64)


@dataclass
class Bags:
    """Words of joined texts and the features of each."""

    feature: np.ndarray  # bucket of every feature
    word: np.ndarray  # the word each feature belongs to
    words: int
    doc: np.ndarray  # the document of every word


def bags(texts: list[bytes]) -> Bags:
    """Words, n-grams and their buckets for a batch of UTF-8 texts."""
    joined = b" " + b" ".join(t.translate(_FOLD) for t in texts) + b" "
    size = np.fromiter(map(len, texts), np.int64, len(texts))
    doc_end = np.cumsum(size + 1)
    b = np.frombuffer(joined, np.uint8)
    gap = b == 32
    start = np.flatnonzero(~gap[1:] & gap[:-1]) + 1
    end = np.flatnonzero(gap[1:] & ~gap[:-1]) + 1  # one past the last byte
    doc = np.searchsorted(doc_end, start - 1, side="right")
    n_words = len(start)
    word_of = np.cumsum(np.concatenate([[False], ~gap[1:] & gap[:-1]])) - 1
    wide = b.astype(np.uint64)
    # n-grams may start on the space before a word and end on the one after it
    inner = np.concatenate([[0], np.cumsum(gap)])
    feats, owners = [], []
    h = wide.copy()
    for n in range(2, max(GRAMS) + 1):
        if len(b) < n:
            break
        h = h[: len(b) - n + 1] * _P1 + wide[n - 1 :]
        if n not in GRAMS:
            continue
        first = np.arange(len(h))
        crosses = inner[first + n - 1] - inner[first + 1]  # spaces strictly inside
        ok = np.flatnonzero((crosses == 0) & ~(gap[first] & gap[first + 1]))
        owner = word_of[ok + 1]
        feats.append(_mix(h[ok] + np.uint64(n)))
        owners.append(owner)
    # the whole word, as a sum of its bytes weighted by place
    place = np.arange(len(b)) - start[np.clip(word_of, 0, None)] if n_words else np.zeros(0, np.int64)
    if n_words:
        weight = (place.astype(np.uint64) * _P2 + _P1) | np.uint64(1)
        value = np.where(gap, np.uint64(0), (wide + np.uint64(1)) * weight * weight)
        total = np.concatenate([[np.uint64(0)], np.cumsum(value)])
        feats.append(_mix(total[end] - total[start]))
        owners.append(np.arange(n_words))
    feature = np.concatenate(feats) if feats else np.zeros(0, np.int64)
    word = np.concatenate(owners) if owners else np.zeros(0, np.int64)
    return Bags(feature, word, n_words, doc)


@dataclass
class Model:
    """Per-bucket log-odds contributions (an embedding times the softmax's difference) and the bias."""

    value: np.ndarray
    bias: float
    shift: float = 0.0

    def word_values(self, bag: Bags) -> np.ndarray:
        total = np.bincount(bag.word, self.value[bag.feature], minlength=bag.words)
        return total / np.maximum(np.bincount(bag.word, minlength=bag.words), 1)

    def windows(self, bag: Bags) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(document, first word, log-odds) of each window of consecutive words."""
        return _window_sums(bag, self.word_values(bag), self.bias)

    def logits(self, texts: list[bytes]) -> np.ndarray:
        """Log-odds of each text's worst window; a text without words has the bias alone."""
        out = np.full(len(texts), -np.inf)
        for pieces, owner, _ in _parts(texts):
            doc, _, odds = self.windows(bags(pieces))
            np.maximum.at(out, owner[doc], odds)
        return np.where(np.isfinite(out), out, self.bias) - self.shift

    def scores(self, texts: list[bytes]) -> np.ndarray:
        return 1.0 / (1.0 + np.exp(-np.clip(self.logits(texts), -40, 40)))


def _window_starts(doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(first word, words) of the windows: runs of WINDOW words at half steps, within a document."""
    n = len(doc)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    head = np.concatenate([[True], doc[1:] != doc[:-1]])
    first = np.flatnonzero(head)
    size = np.diff(np.append(first, n))
    place = np.arange(n) - np.repeat(first, size)
    left = np.repeat(size, size) - place
    starts = np.flatnonzero((place % (WINDOW // 2) == 0) & ((left > WINDOW // 2) | (place == 0)))
    return starts, np.minimum(left[starts], WINDOW)


def _window_sums(bag: Bags, values: np.ndarray, bias: float):
    starts, size = _window_starts(bag.doc)
    total = np.concatenate([[0.0], np.cumsum(values)])
    # short documents are averaged as if full, so that one word does not weigh more there
    return bag.doc[starts] if len(starts) else starts, starts, (total[starts + size] - total[starts]) / WINDOW + bias


@dataclass
class Chosen:
    """Windows: the buckets of their features and the weights of these in the average, all in one array; and labels."""

    feature: np.ndarray  # 16 bits
    weight: np.ndarray
    size: np.ndarray  # features of each window
    label: np.ndarray


def _fit(chosen: Chosen, table_: np.ndarray, soft: np.ndarray, bias: np.ndarray, rng) -> None:
    """Adagrad on windows; the table is trained together with the softmax."""
    g_table, g_soft, g_bias = np.full(len(table_), 1e-8, np.float32), np.full(soft.shape, 1e-8, np.float32), np.full(2, 1e-8, np.float32)
    begin = np.cumsum(chosen.size) - chosen.size
    for _ in range(EPOCHS):
        order = rng.permutation(len(chosen.size))
        size = chosen.size[order]
        stop = np.cumsum(size)
        spot = np.repeat(begin[order] - (stop - size), size) + np.arange(stop[-1])
        features, weights, labels = chosen.feature[spot], chosen.weight[spot], chosen.label[order]
        for i in range(0, len(order), BATCH):
            many = size[i : i + BATCH]
            a, b = stop[i] - size[i], stop[min(i + BATCH, len(order)) - 1]
            ids, w, y = features[a:b], weights[a:b, None], labels[i : i + BATCH]
            mean = np.add.reduceat(table_[ids] * w, np.cumsum(many) - many, axis=0)
            z = mean @ soft + bias
            z -= z.max(axis=1, keepdims=True)
            p = np.exp(z)
            p /= p.sum(axis=1, keepdims=True)
            p[np.arange(len(y)), y] -= 1.0
            d_soft, d_bias, d_mean = mean.T @ p / len(y), p.mean(axis=0), p @ soft.T / len(y)
            by_id = np.argsort(ids, kind="stable")
            used = ids[by_id]
            first = np.flatnonzero(np.concatenate([[True], used[1:] != used[:-1]]))
            d_rows = np.add.reduceat((np.repeat(d_mean, many, axis=0) * w)[by_id], first, axis=0)
            used = used[first]
            g_table[used] += (d_rows**2).mean(axis=1)
            g_soft += d_soft**2
            g_bias += d_bias**2
            table_[used] -= 0.3 * d_rows / np.sqrt(g_table[used])[:, None]
            soft -= 0.1 * d_soft / np.sqrt(g_soft)
            bias -= 0.1 * d_bias / np.sqrt(g_bias)


def _pieces(text: bytes) -> Iterator[bytes]:
    """A text in pieces of at most about PIECE bytes, each beginning with the last words of the one before."""
    at = 0
    while len(text) - at > PIECE:
        stop = text.rfind(b" ", at + PIECE // 2, at + PIECE)
        stop = at + PIECE if stop < 0 else stop
        yield text[at:stop]
        back = stop
        for _ in range(WINDOW):
            back = text.rfind(b" ", max(at, stop - 40 * WINDOW), back) if back >= 0 else back
        at = max(at + 1, back) if back > at else stop
    yield text[at:]


def _parts(texts: list[bytes]) -> Iterator[tuple[list[bytes], np.ndarray, np.ndarray]]:
    """Pieces of about twice PIECE bytes together, the text that each belongs to, and its number there."""
    held, owner, number, size = [], [], [], 0
    for i, text in enumerate(texts):
        for k, piece in enumerate(_pieces(text)):
            if held and size + len(piece) > 2 * PIECE:
                yield held, np.array(owner), np.array(number)
                held, owner, number, size = [], [], [], 0
            held.append(piece)
            owner.append(i)
            number.append(k)
            size += len(piece)
    if held:
        yield held, np.array(owner), np.array(number)


def _held_by(texts: list[bytes], labels: np.ndarray) -> np.ndarray:
    """Per label and bucket: the texts that hold it."""
    held = np.zeros((2, BUCKETS), np.int64)
    seen, last = np.zeros(BUCKETS, bool), -1

    def close() -> None:
        if last >= 0:
            held[labels[last]] += seen
        seen[:] = False

    for pieces, owner, _ in _parts(texts):
        bag = bags(pieces)
        doc = owner[bag.doc[bag.word]]
        order = np.argsort(doc, kind="stable")
        doc, feature = doc[order], bag.feature[order]
        for part in np.split(np.arange(len(doc)), np.flatnonzero(np.diff(doc)) + 1) if len(doc) else ():
            if doc[part[0]] != last:
                close()
                last = int(doc[part[0]])
            seen[feature[part]] = True
    close()
    return held


def _lift(held: np.ndarray, docs: np.ndarray) -> np.ndarray:
    """Per bucket: how much likelier toxic documents hold it, as a log ratio; 0 where few do."""
    lift = np.log((held[1] + 0.5) / (docs[1] + 1)) - np.log((held[0] + 0.5) / (docs[0] + 1))
    lift[held[1] < 3] = 0
    return lift


def _lots(salt: np.ndarray, place: np.ndarray, step: int) -> np.ndarray:
    """A fixed random number of every window, from its document's salt and its place."""
    h = (salt ^ np.uint64(step * 0x9E37 + 1)) + place.astype(np.uint64) * _P1
    h = (h ^ (h >> np.uint64(31))) * _P2
    return h ^ (h >> np.uint64(29))


def _choose(texts: list[bytes], labels: np.ndarray, salts: np.ndarray, value: np.ndarray, step: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(text, lot, buckets, averaging weights) of chosen windows: each text's WORST[label] ones, and RANDOM ones of clean texts.

    ``value``: per bucket, log ratios in step 0 (a window's squares of positive word averages are summed), else the model's contributions.
    """
    found = []
    for pieces, owner, number in _parts(texts):
        bag = bags(pieces)
        starts, size = _window_starts(bag.doc)
        if not len(starts):
            continue
        per_word = np.maximum(np.bincount(bag.word, minlength=bag.words), 1)
        words = np.bincount(bag.word, value[bag.feature], minlength=bag.words) / per_word
        total = np.concatenate([[0.0], np.cumsum(np.maximum(words, 0) ** 2 if step == 0 else words)])
        odds = total[starts + size] - total[starts]
        doc = owner[bag.doc[starts]]
        place = starts - np.searchsorted(bag.doc, bag.doc[starts]) + PIECE * number[bag.doc[starts]]
        lot = _lots(salts[doc], place, step)
        order = np.argsort(bag.word, kind="stable")
        feature, bounds = bag.feature[order], np.searchsorted(bag.word[order], np.arange(bag.words + 1))

        def take(rank: np.ndarray, most: np.ndarray, kind: int) -> None:
            nth = np.arange(len(rank)) - np.searchsorted(doc[rank], doc[rank], side="left")  # noqa: B023
            for k in rank[nth < most[rank]].tolist():
                a, b = starts[k], starts[k] + size[k]  # noqa: B023
                found.append((int(doc[k]), kind, -odds[k] if kind == 0 else lot[k], int(lot[k] >> np.uint64(1)), feature[bounds[a] : bounds[b]].astype(np.uint16),  # noqa: B023
                              np.repeat(1.0 / (WINDOW * per_word[a:b]), np.diff(bounds[a : b + 1])).astype(np.float32)))  # noqa: B023

        y = labels[doc]
        take(np.lexsort((lot, -odds, doc)), np.where(y == 1, WORST[1], WORST[0]), 0)
        take(np.lexsort((lot, doc)), np.where(y == 1, 0, RANDOM), 1)
    # a text in several pieces has chosen windows in each
    found.sort(key=lambda f: f[:4])
    last, nth = None, 0
    for doc, kind, _, lot, feature, weight in found:
        nth = nth + 1 if (doc, kind) == last else 0
        last = doc, kind
        if nth < (RANDOM if kind else WORST[labels[doc]]):
            yield doc, lot, feature, weight


def train(sample: DataFrame, seed: int = SEED) -> Model:
    """Fit on a stored sample (text, y, salt, hold); one without both classes gives a model of one constant.

    Rows of ``hold`` set the threshold and take no part in the fit.
    """
    sample = sample.coalesce(TASKS)
    docs = np.zeros(2, np.int64)
    for r in sample.where("NOT hold").groupBy("y").count().collect():
        docs[r["y"]] = r["count"]
    if not docs.all():
        return Model(np.zeros(BUCKETS), 5.0 if docs[1] else -5.0)
    fit_rows = sample.where("NOT hold")
    spark = sample.sparkSession

    def texts_of(b: pa.RecordBatch) -> tuple[list[bytes], np.ndarray, np.ndarray]:
        return ([t.encode("utf-8", "surrogatepass") for t in b.column(0).to_pylist()], b.column(1).to_numpy(zero_copy_only=False).astype(np.int64),
                b.column(2).to_numpy().view(np.uint64))

    def counted(batches):
        held = np.zeros((2, BUCKETS), np.int64)
        for b in slices(batches):
            held += _held_by(*texts_of(b)[:2])
        yield pa.RecordBatch.from_arrays([pa.array([held.tobytes()], pa.binary())], names=["held"])

    counts = fit_rows.select("text", "y", "salt").mapInArrow(counted, "held binary").toArrow()["held"].to_pylist()
    lift = _lift(sum(np.frombuffer(c, np.int64).reshape(2, BUCKETS) for c in counts), docs)

    def chosen(value: np.ndarray, step: int) -> Chosen:
        shared = spark.sparkContext.broadcast(value)

        def run(batches):
            for b in slices(batches):
                texts, labels, salts = texts_of(b)
                rows = list(_choose(texts, labels, salts, shared.value, step))
                yield pa.RecordBatch.from_arrays([
                    pa.array([int(salts[d]) >> 1 for d, *_ in rows], pa.int64()), pa.array([r[1] for r in rows], pa.int64()), pa.array([int(labels[r[0]]) for r in rows], pa.int32()),
                    pa.array([r[2].tobytes() for r in rows], pa.binary()), pa.array([r[3].tobytes() for r in rows], pa.binary())],
                    names=["salt", "lot", "y", "feature", "weight"])

        found = fit_rows.select("text", "y", "salt").mapInArrow(run, "salt long, lot long, y int, feature binary, weight binary").toArrow()
        found = found.sort_by([("salt", "ascending"), ("lot", "ascending"), ("feature", "ascending")])  # whatever task came first
        feature = [np.frombuffer(x, np.uint16) for x in found["feature"].to_pylist()]
        return Chosen(np.concatenate(feature), np.concatenate([np.frombuffer(x, np.float32) for x in found["weight"].to_pylist()]),
                      np.array([len(x) for x in feature]), found["y"].to_numpy())

    rng = np.random.default_rng(seed)
    table_ = rng.normal(0, 0.1, (BUCKETS, DIM)).astype(np.float32)
    soft, bias = rng.normal(0, 0.5, (DIM, 2)).astype(np.float32), np.zeros(2, np.float32)

    def model() -> Model:
        return Model((table_ @ (soft[:, 1] - soft[:, 0])).astype(np.float64), float(bias[1] - bias[0]))

    for step in range(ROUNDS):
        windows = chosen(model().value if step else lift, step)
        if len(windows.size):
            _fit(windows, table_, soft, bias, rng)
    done = model()
    shared_model = spark.sparkContext.broadcast(done)

    def top(batches):
        for b in slices(batches):
            yield pa.RecordBatch.from_arrays([b.column(1), pa.array(shared_model.value.logits(texts_of(b)[0]), pa.float64())], names=["y", "logit"])

    held = sample.where("hold").select("text", "y", "salt").mapInArrow(top, "y int, logit double").toArrow()
    done.shift = _threshold(held["logit"].to_numpy(), held["y"].to_numpy())
    return done


def _threshold(logits: np.ndarray, labels: np.ndarray) -> float:
    """The log-odds that parts the classes with the fewest errors, in the middle of the widest such gap."""
    if not len(labels):
        return 0.0
    cut = np.unique(logits)
    edges = np.concatenate([[cut[0] - 1], (cut[1:] + cut[:-1]) / 2, [cut[-1] + 1]])
    errors = np.array([((logits >= e) != (labels == 1)).sum() for e in edges])
    best = np.flatnonzero(errors == errors.min())
    width = np.diff(np.concatenate([[cut[0] - 2], cut, [cut[-1] + 2]]))
    return float(edges[best[width[best].argmax()]])


def fit_toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
                 held_out_modulus: int | None = 5) -> Model:
    """Train on a bounded sample of the labelled rows outside the held-out class.

    The sample is the first TOXIC_DOCS and CLEAN_DOCS ids by hash among labelled
    ids (null ids or labels take no part; the higher label counts where one repeats).  Where
    rows repeat an id, the text with the smallest hash stands for it.
    """
    with passing(docs.sparkSession):
        return _fitted(docs, labels, id_col, text_col, label_col, held_out_modulus)


def _fitted(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str, held_out_modulus: int | None) -> Model:
    known = labels.where(F.col(id_col).isNotNull() & F.col(label_col).isin(0, 1)).select(F.col(id_col).alias("id"), F.col(label_col).alias("y"))
    known = known.groupBy("id").agg(F.max("y").alias("y"))
    if held_out_modulus:
        known = known.where(crc_class("id", held_out_modulus) != 0)
    known = stored(known, "toxic-labels")
    picked = [known.where(F.col("y") == y).orderBy(F.xxhash64("id"), "id").limit(most) for y, most in ((1, TOXIC_DOCS), (0, CLEAN_DOCS))]
    picked = picked[0].unionByName(picked[1])
    texts = docs.select(F.col(id_col).alias("id"), text_or_empty(text_col).alias("text"))
    found = texts.join(F.broadcast(picked), "id")  # at most TOXIC_DOCS + CLEAN_DOCS ids
    found = found.groupBy("id", "y").agg(F.min_by("text", F.xxhash64("text")).alias("text"))
    salt = F.xxhash64("id", F.lit("salt"))
    sample = found.select("text", F.col("y").cast("int").alias("y"), salt.alias("salt"), (F.pmod(F.xxhash64("id", F.lit("hold")), F.lit(HOLD)) == 0).alias("hold"))
    return train(stored(sample, "toxic-sample"))


def with_score(docs: DataFrame, model: Model, text_col: str = "text", score_col: str = "__score") -> DataFrame:
    """``docs`` plus a score, which the text alone decides; null texts are scored as empty ones."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast((model.value.astype(np.float32), model.bias, model.shift))
    place = docs.columns.index(text_col)

    def run(batches):
        m = Model(*shared.value)
        for b in slices(batches):
            texts = [(t.as_py() or "").encode("utf-8", "surrogatepass") for t in b.column(place)]
            score = pa.array(m.scores(texts), pa.float64())
            yield pa.RecordBatch.from_arrays([*b.columns, score], names=[*b.schema.names, score_col])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    return docs.mapInArrow(run, schema + f", `{score_col}` double")


def not_toxic(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that the classifier does not reject, with their columns, whatever these are called."""
    name = "score"
    while name in docs.columns:
        name += "_"
    # stored: whole rows pass the workers in small batches
    scored = stored(with_score(docs, fit_toxicity(docs, labels, id_col, text_col), text_col, name), "toxic-scores")
    return scored.where(F.col(name) < 0.5).drop(name)


def toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, held_out, score, predicted) for every row of ``docs``.

    Repeated rows return repeatedly; an empty table gives an empty result; without
    labels of both classes all texts get one constant score.  Extra columns are not read.
    """
    texts = docs.select(F.col(id_col).alias("id"), text_or_empty(text_col).alias("text"))
    scored = with_score(texts, fit_toxicity(docs, labels, id_col, text_col)).select("id", F.col("__score").alias("score"))
    return scored.select("id", (crc_class("id", 5) == 0).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def query(spark, sf_dir):
    return toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")).withColumnRenamed("id", "doc_id")
