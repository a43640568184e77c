"""Best-two-fit packing of tokenized documents into fixed-length sequences.

Tokenize: only texts longer than a sequence are cut; the first piece takes the remainder,
so every later piece fills a sequence by itself.

Pack: pieces are dealt over groups of about ``GROUP`` rows (one group is one
task's work, whatever a document's id or source), and each group is packed by itself.  A bin is
filled greedily with the longest piece that fits; then its smallest piece (the only one
of a bin that holds one) is replaced by the two unpacked pieces that fit the expanded gap
most tightly, if these fill more.  A group wastes at most its last bins, about one in a thousand.
"""

from __future__ import annotations

import base64
import re
import zlib
from array import array
from functools import cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabulon.llm.common import slices, stored, table, text_or_empty

LENGTH = 2048
GROUP = 4000
END_ID = 0
#: Distinct chunks whose ids a worker remembers.
CACHE = 600_000
#: A space with no white space on either side, in Unicode's sense or Python's wider one: there pre-tokens always part.
_PART = re.compile(r" (?=\S)(?<=\S )")


class Tokenizer(dict):
    """Token ids of the byte-level BPE vocabulary as little-endian 32-bit bytes.

    Special strings are plain text.  Ids come from the vocabulary's rank file
    through tiktoken; they are those of the tokenizers file (a fuzz test compares
    them), several times faster.  The pre-tokenizer never joins what a space between
    two characters other than white space parts, so the ids of a chunk with its leading
    space are remembered.
    """

    def __init__(self, ranks_path: str | None = None):
        import public_tokenizers
        import tiktoken

        path = ranks_path or public_tokenizers.path("byte_bpe_50k.tiktoken")
        with open(path, "rb") as f:
            self.ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        encoding = tiktoken.Encoding("byte_bpe_50k", pat_str=public_tokenizers.PATTERN, mergeable_ranks=self.ranks, special_tokens={})
        self.encode = encoding.encode_ordinary

    def whole(self, text: str) -> bytes:
        return array("I", self.encode(text)).tobytes()

    def __missing__(self, chunk: str) -> bytes:
        found = self.whole(" " + chunk)
        if len(chunk) < 40:
            self[chunk] = found
        return found

    def ids(self, text: str) -> bytes:
        """The ids of the whole text, without an end."""
        chunks = _PART.split(text)
        if len(self) > CACHE:
            self.clear()
        return self.whole(chunks[0]) + b"".join(map(self.__getitem__, chunks[1:]))


@cache
def tokenizer(ranks_path: str | None = None) -> Tokenizer:
    """A worker's tokenizer, kept with what it remembers for the worker's next tasks."""
    return Tokenizer(ranks_path)


def piece_lengths(n: int, length: int = LENGTH) -> list[int]:
    """Lengths of a document's pieces: the remainder first, then full ones."""
    first = n % length
    return ([first] if first else []) + [length] * (n // length)


def pieces(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH,
           ranks_path: str | None = None, with_ids: bool = False) -> DataFrame:
    """(id, piece, start, length, ids_crc32[, ids]) of every document's tokens and its end id.

    Null and empty texts have one piece: the end id alone.  Repeated rows repeat.
    """
    source = docs.select(F.col(id_col).alias("id"), text_or_empty(text_col).alias("text"))

    def run(batches):
        ids_of = tokenizer(ranks_path).ids
        end = array("I", [END_ID]).tobytes()
        for b in slices(batches):
            at, piece, start, size, crc, kept = [], [], [], [], [], []
            for row, text in enumerate(b.column(1)):
                ids = ids_of(text.as_py()) + end
                begin = 0
                for k, n in enumerate(piece_lengths(len(ids) // 4, length)):
                    part = ids[4 * begin : 4 * (begin + n)]
                    at.append(row), piece.append(k), start.append(begin), size.append(n)
                    crc.append(zlib.crc32(part))
                    if with_ids:
                        kept.append(np.frombuffer(part, np.int32))
                    begin += n
            columns = [b.column(0).take(pa.array(at, pa.int64())), pa.array(piece, pa.int32()), pa.array(start, pa.int64()),
                       pa.array(size, pa.int64()), pa.array(crc, pa.int64())]
            names = ["id", "piece", "start", "length", "ids_crc32"]
            if with_ids:
                columns.append(pa.array(kept, pa.list_(pa.int32())))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(columns, names=names)

    schema = f"id {dict(source.dtypes)['id']}, piece int, start long, length long, ids_crc32 long"
    return source.mapInArrow(run, schema + (", ids array<int>" if with_ids else ""))


def best_two_fit(lengths: np.ndarray, capacity: int = LENGTH) -> tuple[np.ndarray, np.ndarray]:
    """(bin, offset) of each item, for item lengths of 1 to ``capacity``."""
    order = np.argsort(lengths, kind="stable")
    count = np.bincount(lengths, minlength=capacity + 1)
    ends = np.cumsum(count)
    items = order.tolist()
    top = ends.tolist()  # items of length n that are left: items[top[n] - left[n] : top[n]]
    left = count.tolist()
    mask = 0
    for n in np.flatnonzero(count).tolist():
        mask |= 1 << n

    def take(n: int) -> int:
        nonlocal mask
        item = items[top[n] - left[n]]
        left[n] -= 1
        count[n] -= 1
        if not left[n]:
            mask &= ~(1 << n)
        return item

    def put_back(n: int, item: int) -> None:
        nonlocal mask
        left[n] += 1
        count[n] += 1
        items[top[n] - left[n]] = item
        mask |= 1 << n

    def best_pair(gap: int) -> tuple[int, int]:
        have = np.flatnonzero(count[:gap])
        if not len(have):
            return 0, 0
        at = np.searchsorted(have, gap - have, side="right") - 1
        other = np.where(at >= 0, have[at], 0)
        alone = (other == have) & (count[have] < 2)  # a single item can't pair with itself
        other = np.where(alone, np.where(at > 0, have[np.maximum(at, 1) - 1], 0), other)
        total = np.where(other > 0, have + other, 0)
        k = int(total.argmax())
        return (int(have[k]), int(other[k])) if total[k] else (0, 0)

    where, offset = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    bins = 0
    while mask:
        gap, held = capacity, []
        while gap and (fit := (mask & ((1 << (gap + 1)) - 1)).bit_length() - 1) > 0:
            held.append((fit, take(fit)))
            gap -= fit
        if gap and mask:
            small, item = held[-1]  # greedy filling descends, so the last is the smallest
            a, b = best_pair(gap + small)
            if a + b > small:
                held.pop()
                held += [(a, take(a)), (b, take(b))]
                put_back(small, item)
        at = 0
        for n, item in held:
            where[item], offset[item] = bins, at
            at += n
        bins += 1
    return where, offset


def pack(parts: DataFrame, length: int = LENGTH, group: int = GROUP) -> DataFrame:
    """``parts`` (any columns with ``length``) plus sequence_id and offset.

    ``parts`` is a stored table; its rows are dealt by their place in it, so a hot id,
    source or text cannot fill one group, and a rerun of a lost task deals them alike.
    """
    groups = max(1, -(-parts.count() // group))
    dealt = parts.withColumn("__group", F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(groups)).cast("long"))

    def run(key, frame: pd.DataFrame) -> pd.DataFrame:
        where, offset = best_two_fit(frame["length"].to_numpy(np.int64), length)
        return frame.drop(columns="__group").assign(sequence_id=(int(key[0]) << 32) + where, offset=offset)

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in parts.schema)
    return dealt.groupBy("__group").applyInPandas(run, schema + ", sequence_id long, offset long")


def packed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, piece, start, length, ids_crc32, sequence_id, offset) for every piece.

    Ids of repeated or null documents are carried along and never read as keys.
    An empty table gives an empty result; extra columns are not read.
    """
    return pack(stored(pieces(docs, id_col, text_col), "pack-pieces"))


def query(spark, sf_dir):
    return packed(table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")
