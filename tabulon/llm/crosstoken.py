"""Alignment of two tokenizers over the corpus, scored by id-striped dense count matrices.

Every text is encoded by a byte-level vocabulary (A, of space + text) and a piece vocabulary (B).  Tokens that share bytes are linked,
byte offsets where tokens of both end cut the text into groups.  An id pair's count is the number of documents that link it.

1. Map: texts are aligned in batches of at most ``BATCH`` documents.  A batch gives a row for each document and, for every block of A ids
   (id modulo ``BLOCKS``), its sorted distinct pairs with the documents that hold them: runs instead of rows, and one partial sum a batch.
2. Count: partial sums go to their block's task, which adds them into a dense (A id, B id) matrix with ``np.add.at``; row maxima give
   each A id's best count.  A task holds one block's matrix at a time, and its input streams through.
3. Score: links go to (stripe, salt) tasks, a stripe being some blocks and a salt some batches, and the stripe's counts go to each of its
   salts; sorted by block, counts come before links, so nothing but the block's matrices and the salt's sums is held.  No table is broadcast.

A frequent id spreads over the salts of its stripe, so its links do not meet in one task; only its partial sums, one a batch, do.
More documents want more ``blocks``, up to one A id each.
"""

from __future__ import annotations

import hashlib
from array import array
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabulon.llm.common import slices, stored, table
from tabulon.llm.packing import _PART, Tokenizer

BATCH = 1000
BLOCKS = 256
STRIPES = 16
#: Batches of a salt.
SALT = 64
#: Characters of texts of a batch; a longer text is a batch by itself.
BATCH_CHARS = 8_000_000
#: Distinct chunks whose alignment a worker remembers.
CACHE = 250_000


class Aligner(dict):
    """Alignments of chunks, remembered.

    Neither vocabulary joins what a single space between two characters other than white space parts (no piece of B holds a space
    behind anything but spaces), so the chunks between such spaces are encoded, cut and linked by themselves; a chunk is
    (A tokens, B tokens, groups, code bytes, groups as text), or None where the bytes of its tokens differ from its own.
    """

    def __init__(self, ranks_path: str | None = None, pieces_path: str | None = None):
        import public_tokenizers
        import sentencepiece

        self.a = Tokenizer(ranks_path)
        self.a_size = max(self.a.ranks.values()) + 1
        self.a_lengths = np.zeros(self.a_size, np.int64)
        for token, i in self.a.ranks.items():
            self.a_lengths[i] = len(token)
        self.a_lengths = self.a_lengths.tolist()
        model = sentencepiece.SentencePieceProcessor(model_file=pieces_path or public_tokenizers.path("piece_bpe_32k.model"))
        self.b_size = model.get_piece_size()
        self.b_bytes = [bytes([int(p[3:5], 16)]) if model.is_byte(i) else p.replace("▁", " ").encode()
                        for i in range(self.b_size) for p in (model.id_to_piece(i),)]
        self.b_lengths = list(map(len, self.b_bytes))
        self.b_encode = model.encode
        self.names = list(map(str, range(max(self.a_size, self.b_size))))

    def aligned(self, text: str):
        """The alignment of space + ``text`` as one chunk.  A's tokens always give its bytes back: it knows every byte."""
        own = " " + text
        a, b = self.a.encode(own), self.b_encode(text)
        if b"".join([self.b_bytes[i] for i in b]) != own.encode():
            return None
        a_lengths, b_lengths, names, width = self.a_lengths, self.b_lengths, self.names, self.b_size
        codes, cuts, i, j, n = [], "", 0, 0, 1
        x, y = a[0], b[0]
        told_a, told_b = names[x], names[y]  # ids since the last cut
        ahead = a_lengths[x] - b_lengths[y]  # bytes that A's tokens so far have more than B's
        last = len(a) - 1
        while True:
            codes.append(x * width + y)
            if not ahead:
                if i == last:
                    break
                cuts += told_a + "|" + told_b + ";"
                n += 1
                i, j = i + 1, j + 1
                x, y = a[i], b[j]
                told_a, told_b = names[x], names[y]
                ahead = a_lengths[x] - b_lengths[y]
            elif ahead < 0:
                i += 1
                x = a[i]
                told_a += "," + names[x]
                ahead += a_lengths[x]
            else:
                j += 1
                y = b[j]
                told_b += "," + names[y]
                ahead -= b_lengths[y]
        return len(a), len(b), n, array("q", codes).tobytes(), cuts + told_a + "|" + told_b

    def __missing__(self, chunk: str):
        found = self.aligned(chunk)
        if len(chunk) < 40:
            self[chunk] = found
        return found

    def document(self, text: str | None) -> tuple[int, int, int, bytes, str]:
        """(A tokens, B tokens, groups, code bytes, groups as text); zeros where there are no tokens."""
        if text:
            if len(self) > CACHE:
                self.clear()
            parts = list(map(self.__getitem__, _PART.split(text)))
            if None in parts:  # rare: the bytes are compared over the whole text
                parts = [self.aligned(text)]
            if parts[0] is not None:
                a, b, groups, codes, cuts = zip(*parts)
                return sum(a), sum(b), sum(groups), b"".join(codes), ";".join(cuts)
        return 0, 0, 0, b"", ""


@cache
def aligner(ranks_path: str | None = None, pieces_path: str | None = None) -> Aligner:
    """A worker's aligner, kept with what it remembers for the worker's next tasks."""
    return Aligner(ranks_path, pieces_path)


_NAMES = ["id", "batch", "doc", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "block", "codes", "runs", "docs", "times"]
_TYPES = "batch long, doc int, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, block int, codes binary, runs binary, docs binary, times binary"


def block_rows(found: list[tuple[int, np.ndarray]], blocks: int, width: int):
    """(block, codes, runs, docs, times) of a batch: inside a block the code is A id // blocks * width + B id; ``times`` are links a document."""
    if not found:
        return
    code = np.concatenate([c for _, c in found])
    doc = np.repeat(np.array([d for d, _ in found], np.int64), [len(c) for _, c in found])
    a, b = code // width, code % width
    span = 1 << int(np.int64((1 << 31) // blocks * width).item()).bit_length()
    key = (((a % blocks) * span + a // blocks * width + b) << 16) | doc
    key, times = np.unique(key, return_counts=True)
    pair, doc = key >> 16, (key & 0xFFFF).astype(np.uint16)
    begins = np.flatnonzero(np.r_[True, pair[1:] != pair[:-1]])
    runs = np.diff(np.r_[begins, len(pair)]).astype(np.uint32)
    which = pair[begins] // span
    cuts = np.flatnonzero(np.r_[True, which[1:] != which[:-1]])
    for lo, hi in zip(cuts, np.r_[cuts[1:], len(begins)]):
        at, to = begins[lo], begins[hi] if hi < len(begins) else len(pair)
        yield (int(which[lo]), (pair[begins[lo:hi]] % span).astype(np.uint32).tobytes(), runs[lo:hi].tobytes(),
               doc[at:to].tobytes(), times[at:to].astype(np.uint32).tobytes())


def links(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", blocks: int = BLOCKS) -> DataFrame:
    """Rows of documents (``block`` null) and of blocks (``id`` null) of every batch."""
    source = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = dict(source.dtypes)["id"]

    def run(batches):
        from pyspark import TaskContext

        work = aligner()
        number = TaskContext.get().partitionId() << 32
        kinds = None

        def batch(rows, found):
            columns = list(zip(*rows))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], names=_NAMES)
            held = [(None, rows[0][1], None, None, None, None, None, None, *block) for block in block_rows(found, blocks, work.b_size)]
            if held:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), kinds)], names=_NAMES)

        rows, found, chars = [], [], 0
        for part in slices(batches):
            kinds = [part.schema.field(0).type, pa.int64(), pa.int32(), *[pa.int64()] * 4, pa.string(), pa.int32(), *[pa.binary()] * 4]
            for i, text in zip(part.column(0), part.column(1)):
                text = text.as_py()
                size = len(text or "")
                if rows and (len(rows) == BATCH or chars + size > BATCH_CHARS):
                    yield from batch(rows, found)
                    number, rows, found, chars = number + 1, [], [], 0
                n_a, n_b, groups, codes, cuts = work.document(text)
                if codes:
                    found.append((len(rows), np.frombuffer(codes, np.int64)))
                digest = hashlib.sha256(cuts.encode()).hexdigest() if codes else ""
                rows.append((i.as_py(), number, len(rows), n_a, n_b, groups, len(codes) // 8, digest, None, None, None, None, None))
                chars += size
        if rows:
            yield from batch(rows, found)

    return source.mapInArrow(run, f"id {kind}, {_TYPES}")


def counted(rows: DataFrame, blocks: int, a_size: int, b_size: int) -> DataFrame:
    """(block, codes, counts, best): every linked pair's documents, and whether no pair of its A id has more."""
    height = -(-a_size // blocks)
    parts = rows.select("block", "codes", "runs").repartition("block").sortWithinPartitions("block")

    def run(batches):
        matrix = np.zeros((height, b_size), np.int64)
        flat = matrix.reshape(-1)
        now = None

        def done():
            codes = np.flatnonzero(flat)
            most = matrix.max(axis=1)
            best = flat[codes] == most[codes // b_size]
            out = [pa.array([now], pa.int32()), *(pa.array([x.tobytes()], pa.binary()) for x in (codes.astype(np.uint32), flat[codes], best))]
            flat[codes] = 0
            return pa.RecordBatch.from_arrays(out, names=["block", "codes", "counts", "best"])

        for b in batches:
            for block, codes, runs in zip(*(c.to_pylist() for c in b.columns)):
                if now is not None and block != now:
                    yield done()
                now = block
                np.add.at(flat, np.frombuffer(codes, np.uint32), np.frombuffer(runs, np.uint32).astype(np.int64))
        if now is not None:
            yield done()

    return parts.mapInArrow(run, "block int, codes binary, counts binary, best binary")


def scored(rows: DataFrame, counts: DataFrame, salts: int, blocks: int, stripes: int, a_size: int, b_size: int) -> DataFrame:
    """(batch, doc, n_best, count_sum), in one row a stripe."""
    size = -(-a_size // blocks) * b_size
    stripe = (F.col("block") % stripes).alias("stripe")
    none = F.lit(None).cast("binary")
    first = counts.select(stripe, F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("salt"), "block", F.lit(None).cast("long").alias("batch"),
                          "codes", "counts", "best", none.alias("docs"), none.alias("times"))
    salt = F.pmod(F.xxhash64("batch"), F.lit(salts)).cast("int").alias("salt")
    then = rows.select(stripe, salt, "block", "batch", "codes", F.col("runs").alias("counts"), none.alias("best"), "docs", "times")
    dealt = first.unionByName(then).repartition("stripe", "salt").sortWithinPartitions("stripe", "salt", "block", F.col("batch").asc_nulls_first())

    def run(batches):
        count, best = np.zeros(size, np.int64), np.zeros(size, bool)
        now, sums = None, {}

        def done():
            for batch, (a, b) in sums.items():
                held = np.flatnonzero(b)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(held), batch)), pa.array(held.astype(np.int32)), pa.array(a[held]), pa.array(b[held])],
                                                 names=["batch", "doc", "n_best", "count_sum"])
            sums.clear()

        for b in batches:
            for stripe, salt, _block, batch, codes, runs, top, docs, times in zip(*(c.to_pylist() for c in b.columns)):
                if now is not None and now != (stripe, salt):
                    yield from done()
                now = stripe, salt
                codes = np.frombuffer(codes, np.uint32)
                if batch is None:  # a block's counts replace the last block's: its links hold no other pairs
                    count[codes], best[codes] = np.frombuffer(runs, np.int64), np.frombuffer(top, bool)
                    continue
                runs, docs, times = np.frombuffer(runs, np.uint32), np.frombuffer(docs, np.uint16), np.frombuffer(times, np.uint32).astype(np.int64)
                if batch not in sums:
                    sums[batch] = np.zeros(BATCH, np.int64), np.zeros(BATCH, np.int64)
                n_best, count_sum = sums[batch]
                np.add.at(n_best, docs, times * np.repeat(best[codes], runs))
                np.add.at(count_sum, docs, times * np.repeat(count[codes], runs))
        yield from done()

    return dealt.mapInArrow(run, "batch long, doc int, n_best long, count_sum long")


def cross_tokens(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", blocks: int = BLOCKS, stripes: int = STRIPES) -> DataFrame:
    """(id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256) for every row.

    Null and empty texts, and texts that a vocabulary does not give back byte for byte, have no tokens: zeros and an empty digest.
    Repeated rows repeat and count as documents of their own; null ids are carried along; extra columns are not read; an empty
    table gives an empty result.
    """
    work = aligner()
    rows = stored(links(docs, id_col, text_col, blocks), "cross-links")
    held = rows.where("block IS NOT NULL")
    batches = held.agg(F.count_distinct("batch")).first()[0]
    counts = stored(counted(held, blocks, work.a_size, work.b_size), "cross-counts")
    sums = scored(held, counts, max(1, -(-batches // SALT)), blocks, stripes, work.a_size, work.b_size)
    sums = sums.groupBy("batch", "doc").agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))
    zero = F.lit(0).cast("long")
    return rows.where("block IS NULL").join(sums, ["batch", "doc"], "left").select(
        "id", "n_a", "n_b", "n_groups", "n_links", F.coalesce("n_best", zero).alias("n_best"), F.coalesce("count_sum", zero).alias("count_sum"), "groups_sha256")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cross_tokens(table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")
