"""GIF media columns: lossless 8-bit payloads as timed frames, and a full decoder.

The encoder lays a payload out in rows of 64 samples under a grey palette, so a
sample is its palette index, at most 1,024 rows a frame; longer payloads go on in
further timed frames.  The decoder reads any GIF: LZW code streams of every code
size (also with full tables and deferred clears), global and local palettes,
interlacing, transparency and the four disposal rules; each frame comes with its
delay and colour histogram.
"""

from __future__ import annotations

import struct
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabulon.llm.common import slices, table, text_or_empty

WIDTH = 64
ROWS = 1024
DELAY_CS = 4
TABLE = 4096
#: Codes between two clears: the most before the 12-bit table is full.
RUN = 3837
UNIT = 64

_GREY = bytes(v for i in range(256) for v in (i, i, i))


def _widths(root: int, codes: int) -> np.ndarray:
    """Bit widths of the codes that follow a clear, the first one at index 0."""
    clear = 1 << root
    k = np.arange(1, codes + 1)
    # before the k-th code the decoder holds clear + 2 + max(0, k - 2) entries
    held = clear + 2 + np.maximum(0, k - 2)
    width = np.full(codes, root + 1)
    for w in range(root + 1, 12):
        width[held >= 1 << w] = w + 1
    return width


_ROOT8 = _widths(8, RUN + 1)


def _pack_bits(codes: np.ndarray, widths: np.ndarray) -> bytes:
    """Codes of more than 8 bits each, least significant bit first, with no gaps."""
    offset = np.cumsum(widths) - widths
    at, value = offset >> 3, codes.astype(np.uint32) << (offset & 7).astype(np.uint32)
    out = np.zeros(int(at[-1]) + 3, np.uint8)
    # codes start in different bytes, so each of these adds touches a byte once
    out[at] += value.astype(np.uint8)
    out[at + 1] += (value >> 8).astype(np.uint8)
    out[at + 2] += (value >> 16).astype(np.uint8)
    return out[: (int(offset[-1] + widths[-1]) + 7) >> 3].tobytes()


def lzw_encode(data: bytes) -> bytes:
    """LZW with 8-bit roots: a clear first, after every full table, and an end code."""
    parts: list[np.ndarray] = [np.array([256])]
    widths: list[np.ndarray] = [np.array([9])]
    codes: list[int] = []
    seen: dict[int, int] = {}
    push, get = codes.append, seen.get
    free, full = 258, 258 + RUN
    rest = iter(data)
    prefix = next(rest, -1)
    for b in rest:
        code = get(key := prefix << 8 | b)
        if code is not None:
            prefix = code
            continue
        push(prefix)
        seen[key] = free
        prefix = b
        free += 1
        if free == full:
            push(256)
            parts.append(np.array(codes))
            widths.append(_ROOT8)
            codes.clear()
            seen.clear()
            free = 258
    if prefix >= 0:
        codes.append(prefix)
    codes.append(257)
    parts.append(np.array(codes))
    widths.append(_ROOT8[: len(codes)])
    return _pack_bits(np.concatenate(parts), np.concatenate(widths))


def lzw_decode(stream: bytes, root: int, wanted: int) -> bytes:
    """At most ``wanted`` samples of a code stream; a broken or short stream raises ValueError."""
    clear, end = 1 << root, (1 << root) + 1
    base = [bytes([i]) for i in range(clear)] + [b"", b""]
    padded = np.frombuffer(stream + b"\0\0\0\0", np.uint8).astype(np.uint32)
    window = padded[:-2] | padded[1:-1] << 8 | padded[2:] << 16  # 24 bits from each byte on
    total = len(stream) * 8
    schedule = _widths(root, TABLE)
    offsets = np.concatenate([[0], np.cumsum(schedule)])
    at, out, got = 0, [], 0
    known = list(base)
    prev = b""
    deferred = False
    while got < wanted:
        if deferred:
            n = min(TABLE, (total - at) // 12)
            where, width = at + 12 * np.arange(n), np.full(n, 12)
        else:
            n = int(np.searchsorted(offsets[1:], total - at, side="right"))
            where, width = at + offsets[:n], schedule[:n]
        if not n:
            raise ValueError("LZW stream ends early")
        found = (window[where >> 3] >> (where & 7).astype(np.uint32)) & ((1 << width) - 1).astype(np.uint32)
        stop = np.flatnonzero((found == clear) | (found == end))
        k = int(stop[0]) if len(stop) else n
        codes = iter(found[:k].tolist())
        if not prev:
            first = next(codes, clear)
            if first >= clear and k:
                raise ValueError("LZW run starts with a code that is not defined")
            if k:
                prev = base[first]
                out.append(prev)
                got += 1
        was = len(out)
        grow, push = known.append, out.append
        for c in codes:
            try:
                entry = known[c]
            except IndexError:
                if c != len(known) or c >= TABLE:
                    raise ValueError("LZW code that is not defined") from None
                entry = prev + prev[:1]
            push(entry)
            grow(prev + entry[:1])
            prev = entry
        del known[TABLE:]
        got += sum(map(len, out[was:]))
        if k == n:
            if not deferred and n < TABLE:
                if got < wanted:
                    raise ValueError("LZW stream ends early")
                break
            at = int(where[-1] + width[-1])
            deferred = True
            continue
        at = int(where[k] + width[k])
        if found[k] == end:
            break
        known, prev, deferred = list(base), b"", False
    result = b"".join(out)
    if len(result) < wanted:
        raise ValueError("LZW stream ends early")
    return result[:wanted]


def encode(payload: bytes, delay_cs: int = DELAY_CS) -> bytes:
    """A GIF89a animation whose frames hold ``payload`` (a positive multiple of 64 bytes)."""
    if not payload or len(payload) % WIDTH:
        raise ValueError("payload must be a positive multiple of 64 bytes")
    rows = len(payload) // WIDTH
    parts = [b"GIF89a", struct.pack("<HHBBB", WIDTH, min(rows, ROWS), 0xF7, 0, 0), _GREY]
    for first in range(0, rows, ROWS):
        tall = min(ROWS, rows - first)
        stream = lzw_encode(payload[first * WIDTH : (first + tall) * WIDTH])
        parts += [b"\x21\xf9\x04", struct.pack("<BHB", 1 << 2, delay_cs, 0), b"\0",
                  b"\x2c", struct.pack("<HHHHB", 0, 0, WIDTH, tall, 0), b"\x08"]
        for i in range(0, len(stream), 255):
            block = stream[i : i + 255]
            parts += [bytes([len(block)]), block]
        parts.append(b"\0")
    parts.append(b"\x3b")
    return b"".join(parts)


@dataclass
class Frame:
    """One composed frame: the canvas as it is shown, and the frame's own rectangle."""

    number: int
    delay_cs: int
    disposal: int
    left: int
    top: int
    width: int
    height: int
    canvas: np.ndarray  # rows x columns, each pixel RGBA in one little-endian word

    def own(self) -> np.ndarray:
        """Packed pixels of the frame's own rectangle."""
        return self.canvas[self.top : self.top + self.height, self.left : self.left + self.width]

    def histogram(self, bins: int = 16) -> np.ndarray:
        """Own pixels by level of red, then green, then blue, ``bins`` levels each."""
        own = self.own().ravel()
        levels = [np.bincount((own >> (8 * c)) & 255, minlength=256).reshape(bins, -1).sum(axis=1) for c in range(3)]
        return np.concatenate(levels)


def _blocks(data: bytes, at: int) -> tuple[bytes, int]:
    parts = []
    while n := data[at]:
        parts.append(data[at + 1 : at + 1 + n])
        at += 1 + n
    return b"".join(parts), at + 1


def _palette(data: bytes, at: int, flags: int) -> tuple[np.ndarray, int]:
    n = 2 << (flags & 7)
    rgb = np.frombuffer(data, np.uint8, 3 * n, at).reshape(n, 3)
    return np.concatenate([rgb, np.full((n, 1), 255, np.uint8)], axis=1).view("<u4").ravel(), at + 3 * n


def decode(data: bytes):
    """Yield the composed frames of a GIF; ValueError if it is not one or is broken."""
    try:
        yield from _decode(data)
    except (IndexError, struct.error) as e:
        raise ValueError(f"broken GIF: {e}") from e


def _decode(data: bytes):
    if data[:6] not in (b"GIF87a", b"GIF89a"):
        raise ValueError("not a GIF")
    wide, tall, flags, _, _ = struct.unpack_from("<HHBBB", data, 6)
    at, shared = 13, None
    if flags & 0x80:
        shared, at = _palette(data, at, flags)
    canvas = np.zeros((tall, wide), np.uint32)
    delay, disposal, clear_index, number = 0, 0, -1, 0
    while (kind := data[at]) != 0x3B:
        at += 1
        if kind == 0x21:
            label = data[at]
            block, at = _blocks(data, at + 1)
            if label == 0xF9:
                f, delay, index = struct.unpack_from("<BHB", block)
                disposal, clear_index = f >> 2 & 7, index if f & 1 else -1
            continue
        if kind != 0x2C:
            raise ValueError("unknown GIF block")
        left, top, w, h, f = struct.unpack_from("<HHHHB", data, at)
        at += 9
        colours = shared
        if f & 0x80:
            colours, at = _palette(data, at, f)
        if colours is None:
            raise ValueError("GIF frame without a palette")
        root = data[at]
        stream, at = _blocks(data, at + 1)
        index = np.frombuffer(lzw_decode(stream, root, w * h), np.uint8).reshape(h, w)
        if f & 0x40:
            order = np.concatenate([np.arange(s, h, d) for s, d in ((0, 8), (4, 8), (2, 4), (1, 2))])
            plain = np.empty_like(index)
            plain[order] = index
            index = plain
        if top + h > canvas.shape[0] or left + w > canvas.shape[1]:
            raise ValueError("GIF frame lies outside its screen")
        before = canvas.copy() if disposal == 3 else None
        area = canvas[top : top + h, left : left + w]
        if index.size and index.max() >= len(colours):
            raise ValueError("GIF index outside its palette")
        area[...] = colours[index] if clear_index < 0 else np.where(index == clear_index, area, colours[index])
        yield Frame(number, delay, disposal, left, top, w, h, canvas.copy())
        if disposal == 2:
            area[...] = 0
        elif disposal == 3:
            canvas = before
        number, delay, disposal, clear_index = number + 1, 0, 0, -1


def payload_of(text: str | None) -> tuple[bytes, int]:
    """UTF-8 bytes padded with zeros to a positive multiple of 64, and the unpadded length."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    return raw + b"\0" * (-len(raw) % UNIT if raw else UNIT), len(raw)


def read_payload(frames) -> bytes:
    """The samples of all frames in time order (grey palette: red is the sample)."""
    return b"".join(f.own().astype(np.uint8).tobytes() for f in frames)


def to_media(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_bytes, media): every text as a GIF; null texts count as empty."""
    source = docs.select(F.col(id_col).alias("id"), text_or_empty(text_col).alias("text"))

    def run(batches):
        for b in slices(batches):
            made = [payload_of(t.as_py()) for t in b.column(1)]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array([n for _, n in made], pa.int64()), pa.array([encode(p) for p, _ in made], pa.binary())],
                names=["id", "n_bytes", "media"])

    return source.mapInArrow(run, f"id {dict(source.dtypes)['id']}, n_bytes long, media binary")


def frames(media: DataFrame, id_col: str = "id", media_col: str = "media") -> DataFrame:
    """A row per frame: number, timing, geometry, samples and colour histogram.

    Null media have no rows; a broken GIF gives one row with ``error`` set.
    """
    source = media.where(F.col(media_col).isNotNull()).select(F.col(id_col).alias("id"), F.col(media_col).alias("media"))
    kind = dict(source.dtypes)["id"]
    names = ["id", "frame", "delay_cs", "disposal", "width", "height", "rgba", "histogram", "error"]

    def run(batches):
        for b in slices(batches):
            at, rows = [], []
            for i, m in enumerate(b.column(1)):
                try:
                    for f in decode(m.as_py()):
                        at.append(i)
                        rows.append((f.number, f.delay_cs, f.disposal, f.width, f.height, f.own().tobytes(), f.histogram().tolist(), None))
                except ValueError as e:
                    at.append(i)
                    rows.append((None, None, None, None, None, None, None, str(e)))
            kinds = [pa.int32()] * 5 + [pa.binary(), pa.list_(pa.int64()), pa.string()]
            columns = [pa.array([r[k] for r in rows], t) for k, t in enumerate(kinds)]
            yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(at, pa.int64())), *columns], names=names)

    return source.mapInArrow(run, f"id {kind}, frame int, delay_cs int, disposal int, width int, height int, "
                                  "rgba binary, histogram array<long>, error string")


def with_payload(media: DataFrame) -> DataFrame:
    """``media`` (id, n_bytes, media) plus what its bytes give back: ``payload`` and ``frames``, the timed frames with their grey histograms."""
    kind = dict(media.dtypes)["id"]
    timed = pa.struct([("delay_cs", pa.int32()), ("width", pa.int32()), ("height", pa.int32()), ("histogram", pa.list_(pa.int64()))])

    def run(batches):
        for b in slices(batches, 100):
            payloads, shown = [], []
            for m in b.column(2):
                samples, found = [], []
                for f in decode(m.as_py()):
                    samples.append(read_payload([f]))
                    found.append({"delay_cs": f.delay_cs, "width": f.width, "height": f.height, "histogram": f.histogram()[:16].tolist()})
                payloads.append(b"".join(samples))
                shown.append(found)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(payloads, pa.binary()), pa.array(shown, pa.list_(timed))], names=["id", "n_bytes", "media", "payload", "frames"])

    return media.mapInArrow(run, f"id {kind}, n_bytes long, media binary, payload binary, "
                                 "frames array<struct<delay_cs int, width int, height int, histogram array<long>>>")


def digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: sizes and digests of payload and media, and the histogram feature.

    The payload is what the media column's bytes give back.  Null, empty, repeated and very long texts all give a row;
    equal texts give equal values; an empty table gives an empty result; extra columns are not read.
    """
    read = with_payload(to_media(docs, id_col, text_col))
    none = F.array_repeat(F.lit(0).cast("long"), 16)
    levels = F.aggregate("frames", none, lambda total, f: F.zip_with(total, f["histogram"], lambda x, y: x + y))
    feature = F.concat(F.size("frames").cast("string"), F.lit("x"), F.array_max(F.col("frames.delay_cs")).cast("string"), F.lit("cs:"), F.array_join(levels.cast("array<string>"), ","))
    return read.select(
        "id", "n_bytes", F.length("payload").cast("long").alias("payload_bytes"), F.sha2("payload", 256).alias("payload_sha256"),
        F.crc32(F.substring("payload", -UNIT, UNIT)).alias("tail_crc32"), F.length("media").cast("long").alias("media_bytes"),
        F.sha2("media", 256).alias("media_sha256"), feature.alias("feature"))


def query(spark, sf_dir):
    return digests(table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")
