"""Shared helpers: table reads, the shared scratch folder and batch bounds."""

from __future__ import annotations

import gc
import tempfile
import uuid
from collections.abc import Iterable, Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Java pattern of the word separator used by every word contract.
WORD_GAP = r"[\x20\x09-\x0D]+"
#: Rows that a worker turns into Python objects at once, and of a batch while something is stored.
SLICE_ROWS = 1000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given Parquet tables."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that the driver and all executors see.

    A cluster names it in ``spark.checkpoint.dir``; only where that is unset in local mode
    (single-machine tests) a temporary folder is made and recorded there.
    """
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not spark.conf.get("spark.master", "").startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        found = "file://" + tempfile.mkdtemp(prefix="spark-shared-")
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


@contextmanager
def small_batches(spark: SparkSession) -> Iterator[None]:
    """Fewer rows in an Arrow batch while something is written, so that rows of several columns of texts and lists stay
    small in all tasks of an executor; what was set before comes back."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, str(SLICE_ROWS))
    try:
        yield
    finally:
        spark.conf.set(key, before)


#: Tables stored so far, by open ``passing`` block.
_OPEN: list[list[str]] = []


@contextmanager
def passing(spark: SparkSession) -> Iterator[None]:
    """Tables that are stored inside are removed at the end, but lasting ones, which go to the block around.

    Shuffle files of plans that are done with are let go as well: Spark removes them when the driver collects garbage.
    """
    _OPEN.append([])
    try:
        yield
    finally:
        for path in _OPEN.pop():
            at = spark._jvm.org.apache.hadoop.fs.Path(path)
            at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)
        gc.collect()
        spark._jvm.System.gc()


def stored(df: DataFrame, name: str, lasting: bool = False) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back.

    Cuts lineage: a lost executor costs a reread, not a recomputation.  What a result still reads after a ``passing``
    block ends must be ``lasting``.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    with small_batches(spark):
        df.write.parquet(path)
    blocks = _OPEN[:-1] if lasting else _OPEN
    if blocks:
        blocks[-1].append(path)
    return spark.read.schema(df.schema).parquet(path)


def slices(batches: Iterable[pa.RecordBatch], rows: int = SLICE_ROWS) -> Iterator[pa.RecordBatch]:
    """Batches in parts of at most ``rows`` rows, without copying; Spark itself bounds a batch's bytes."""
    for b in batches:
        for at in range(0, b.num_rows, rows):
            yield b.slice(at, rows)


def text_or_empty(name: str) -> Column:
    return F.coalesce(F.col(name), F.lit(""))


def crc_class(id_col: str, modulus: int) -> Column:
    """crc32 of the id as text, modulo ``modulus``; a null id counts as the text ''."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % modulus


#: Bits of a key filter: at most 4 MB, however many keys it takes.
FILTER_BITS = 1 << 25


def key_filter(keys: DataFrame, key: Column, name: str, lasting: bool = False) -> DataFrame:
    """A bitmap of hashed keys, in at most 1,024 rows of 4 KB: of bounded size, so it may be broadcast."""
    place = F.pmod(key, F.lit(FILTER_BITS))
    bits = keys.select(place.alias("p")).groupBy(F.bitmap_bucket_number("p").alias("__bucket"))
    return stored(bits.agg(F.bitmap_construct_agg(F.bitmap_bit_position("p")).alias("__bits")), name, lasting)


def with_maybe(df: DataFrame, key: Column, bits: DataFrame) -> DataFrame:
    """``df`` plus ``__maybe``: false only for rows whose key the filter surely lacks.

    With many more keys than bits all rows are true, and only the saving is lost.
    """
    place = F.pmod(key, F.lit(FILTER_BITS))
    joined = df.join(F.broadcast(bits), F.bitmap_bucket_number(place) == F.col("__bucket"), "left")
    at = F.bitmap_bit_position(place)
    byte = F.conv(F.hex(F.substring(F.col("__bits"), (F.floor(at / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    hit = F.floor(byte / F.pow(F.lit(2), at % 8)).cast("int") % 2 == 1
    return joined.withColumn("__maybe", F.coalesce(hit, F.lit(False))).drop("__bucket", "__bits")
