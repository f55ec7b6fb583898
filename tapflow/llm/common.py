"""Helpers shared by the training-data operators: tables, scratch, words."""

from __future__ import annotations

import re
import struct

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tapflow.session import ensure_checkpoint_dir, scratch_path, ship_package

#: Rows and bytes of one Arrow batch handed to a Python worker: with the long
#: documents of a corpus, the default of 10,000 rows would not be bounded.
BATCH_ROWS = 256
BATCH_BYTES = "4m"

_WORD = re.compile(r"\w+")


def prepare(spark: SparkSession) -> None:
    """Session settings that the operators rely on, and the shipped package."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)
    ensure_checkpoint_dir(spark)
    ship_package(spark)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written under the shared checkpoint folder and read back."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    out = df.sparkSession.read.parquet(path)
    out._written_to = path
    return out


def drop_written(*frames: DataFrame) -> None:
    """Delete tables made by ``written`` that no later result reads."""
    for frame in frames:
        sc = frame.sparkSession.sparkContext
        path = sc._jvm.org.apache.hadoop.fs.Path(frame._written_to)
        path.getFileSystem(sc._jsc.hadoopConfiguration()).delete(path, True)


def crc_bucket(id_col: str, modulus: int):
    """crc32(id as text) mod ``modulus``; a null id counts as empty text."""
    return F.pmod(F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")),
                  F.lit(modulus))


def words(text: str) -> list[str]:
    """Lower-cased runs of letters, digits and underscores, in order."""
    return _WORD.findall(text.lower())


class WordHashes(dict):
    """word -> 64-bit hash, remembered; start anew with ``trim``."""

    LIMIT = 100_000

    def __missing__(self, word: str) -> int:
        h = self[word] = xxhash.xxh64_intdigest(word.encode("utf-8", "surrogatepass"))
        return h

    def of(self, tokens: list[str]) -> np.ndarray:
        if len(self) > self.LIMIT:
            self.clear()
        return np.fromiter(map(self.__getitem__, tokens), np.uint64, len(tokens))


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective finisher on unsigned 64-bit values (splitmix64)."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def shingle_hashes(h: np.ndarray, width: int) -> np.ndarray:
    """Hash of each run of ``width`` word hashes; a shorter, non-empty text
    is one run."""
    n = len(h)
    if n == 0:
        return h
    width = min(width, n)
    with np.errstate(over="ignore"):
        out = np.full(n - width + 1, width, np.uint64)
        for k in range(width):
            out = mix64(out * np.uint64(0x9E3779B97F4A7C15) + h[k:n - width + 1 + k])
    return out


def texts(batch: pa.RecordBatch, column: str = "text") -> list[str]:
    """The column's strings; null counts as empty."""
    return [t or "" for t in batch.column(column).to_pylist()]


def signed(x: np.ndarray) -> np.ndarray:
    return x.astype(np.uint64, copy=False).view(np.int64)


def pack_u32(values) -> bytes:
    return struct.pack(f"<{len(values)}I", *values)
