"""Helpers of the training-data operators: shared storage, text batches and hashing."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: The bytes of `[\x20\x09-\x0D]`, which separate words everywhere in this subpackage.
WORD_SEPARATORS = b" \t\n\x0b\x0c\r"
#: The same words as a Java and RE2 pattern.
WORD_PATTERN = r"[^\x20\x09-\x0D]+"
#: Multiplier of the polynomial hashes.
PRIME = np.uint64(0x9E3779B97F4A7C15)


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: `spark.checkpoint.dir`; a temporary one only in a single local process."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        base = tempfile.mkdtemp(prefix="formloom-")
        spark.sparkContext.setCheckpointDir(base)
        base = spark.sparkContext.getCheckpointDir() or base
    return base.rstrip("/")


def shared_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder."""
    return f"{shared_dir(spark)}/formloom/{name}-{uuid.uuid4().hex}"


def write_parquet(df: DataFrame, path: str) -> None:
    """Write a table that only this job reads, to a fresh path.

    On a local disk Hadoop starts a `chmod` for each folder and file that it makes, and a process that begins shares all of the
    driver's memory, so that is counted twice for a moment. So no empty file marks success, and the folders that the job's
    committer would make in the driver are there already; were they others, they would be made as ever.
    """
    if path.startswith("file:/"):
        os.makedirs(f"/{path.removeprefix('file:').lstrip('/')}/_temporary/0")
    df.write.mode("append").option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").parquet(path)


def materialize(df: DataFrame, name: str, narrow: bool = False) -> DataFrame:
    """Write df as a table in the shared folder and read it back: cuts lineage, and lost executors lose none of it.

    narrow: rows of a few numbers, of which partitions made for texts hold little; eight such go into one file, as long as
    there are four files for each core, so tables of ids don't become heaps of small files.
    """
    spark = df.sparkSession
    path = shared_path(spark, name)
    if narrow:
        df = df.coalesce(max(4 * spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")) // 8))
    write_parquet(df, path)
    out = spark.read.schema(df.schema).parquet(path)
    out._own_path = path  # what discard() may delete: nothing but what was written here
    return out


def discard(df: DataFrame) -> None:
    """Delete a table that materialize() wrote, once nothing reads it any more; other DataFrames are left alone."""
    if name := getattr(df, "_own_path", None):
        discard_path(df.sparkSession, name)


def discard_path(spark: SparkSession, name: str) -> None:
    """Delete a path that shared_path() gave."""
    path = spark._jvm.org.apache.hadoop.fs.Path(name)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


#: Settings of batches: Spark's default, made for narrow rows, and what suits rows of whole texts.
TEXT_BATCHES = {
    "spark.sql.parquet.columnarReaderBatchSize": ("4096", "256"),
    "spark.sql.execution.arrow.maxRecordsPerBatch": ("10000", "1000"),
    "spark.sql.execution.arrow.maxBytesPerBatch": ("67108864b", "8388608b"),
}


def small_batches(spark: SparkSession) -> None:
    """Bound what a task holds of a table of whole texts at once, in the reader, in Arrow and in Python, where the session
    has Spark's defaults."""
    for key, (default, ours) in TEXT_BATCHES.items():
        if spark.conf.get(key, default) == default:
            spark.conf.set(key, ours)


def lower_ascii(col: Column | str) -> Column:
    """Lower-case A-Z and nothing else."""
    upper = "".join(map(chr, range(65, 91)))
    return F.translate(col, upper, upper.lower())


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value) with value computed once, though use refers to it several times or inside a lambda."""
    return F.element_at(F.transform(F.array(value), use), 1)


def remainder_of_id(col: Column | str, divisor: int) -> Column:
    """crc32 of the id as text, modulo divisor; a null id counts as the empty text."""
    col = F.col(col) if isinstance(col, str) else col
    return F.coalesce(F.crc32(col.cast("string").cast("binary")), F.lit(0)) % divisor


def text_bytes(column: pa.Array) -> list[bytes]:
    """UTF-8 of each text; null is empty."""
    return [b"" if x is None else x for x in column.cast(pa.binary()).to_pylist()]


def slices(batches: Iterable[pa.RecordBatch], column: str, limit: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """The rows in slices whose texts hold about `limit` bytes, which bounds memory whatever the length of a text."""
    for batch in batches:
        lengths = pa.compute.fill_null(pa.compute.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        ends = np.cumsum(lengths)
        start = 0
        while start < batch.num_rows:
            done = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, done + limit, side="right")))
            yield batch.slice(start, stop - start)
            start = stop


def word_spans(buffer: np.ndarray, is_word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of word bytes; is_word: for each byte value whether it belongs to a word."""
    inside = np.zeros(len(buffer) + 2, np.int8)
    inside[1:-1] = is_word[buffer]
    change = np.diff(inside)
    return np.flatnonzero(change == 1), np.flatnonzero(change == -1)


def word_hashes(buffer: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each span, the same for equal bytes wherever they stand."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    lengths = ends - starts
    with np.errstate(over="ignore"):
        powers = np.cumprod(np.full(int(lengths.max()), PRIME | np.uint64(1)), dtype=np.uint64)
        offsets = np.concatenate(([0], np.cumsum(lengths)[:-1]))
        within = np.arange(int(lengths.sum())) - np.repeat(offsets, lengths)
        values = (buffer[np.repeat(starts, lengths) + within].astype(np.uint64) + np.uint64(1)) * powers[within]
        h = np.add.reduceat(values, offsets)
        h ^= h >> np.uint64(29)
        h *= np.uint64(0xBF58476D1CE4E5B9)
        h ^= h >> np.uint64(32)
    return h


class TwoGenerations:
    """A bounded memo: once the young half is full it becomes the old one; what is used of the old one returns."""

    def __init__(self, limit: int):
        self.limit, self.young, self.old = limit, {}, {}

    def missing(self, keys: set) -> list:
        """Those of the keys, none of them young, that nothing is known about; the others are young afterwards."""
        out = []
        young, old = self.young, self.old
        for k in keys:
            if k not in young:
                if (v := old.get(k)) is None:
                    out.append(k)
                else:
                    young[k] = v
        return out

    def turn(self) -> None:
        """Between uses, when nothing that was looked up is needed any more."""
        if len(self.young) > self.limit:
            self.young, self.old = {}, self.young
