"""De-duplication that forgets no key and holds none in memory.

The reproduced job keeps every seen key in streaming state for ever.  Here the
keys lie in files: each micro-batch leaves a segment of key digests and a Bloom
filter per event day over them.  The filter is a table too, a row per 64-bit
word, so a batch probes all days by one equi-join on the word and nothing is
broadcast or held.  Only the days whose filter may know one of the batch's keys
are read, and only the keys in question are compared, digest by digest.  Hash
errors of the filter cost a read and never a row.

Every part is committed once per micro-batch (``sinks.ledger``).  A batch is
judged against the segments of other batches only, so a batch that is run again
after a failure between two commits decides alike.

Of copies in one batch the earliest stays, of copies in several batches the one
that arrives first.  A row without a key is dropped by validation before.

A segment is a folder: a job with many short triggers should run longer ones
(``trigger``) or fold its segments together from time to time while stopped.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tapflow.functions.times import epoch_micros
from tapflow.operators.dedup import dedup_taps
from tapflow.sinks.ledger import CommittedTable, fan_out
from tapflow.sinks.tables import BatchFn

#: Words a day of the filter has at most; a key sets ``BITS`` bits of one word.  With
#: 10 million keys a day it is wrong about fewer than one key in 50.
WORDS, BITS = 1 << 21, 4
_DAY_US = 86_400_000_000
KEY_SCHEMA = "digest binary, day long"
FILTER_SCHEMA = "day long, word long, bits long"


def _digest(key: Column) -> Column:
    return F.unhex(F.sha2(key, 256))


def _word(key: Column, words: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(words))


def _mask(key: Column) -> Column:
    """``BITS`` bits of a word, by six bits of a second hash each."""
    mask = F.lit(0).cast("long")
    for k in range(BITS):
        bit = F.shiftright(F.xxhash64(F.lit("bit"), key), 6 * k).bitwiseAND(63).cast("int")
        mask = mask.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("long"), bit))
    return mask


class KeyStore:
    """Seen keys under ``base``; ``writer`` appends each batch's new rows."""

    def __init__(self, base: str, checkpoint: str, key: str = "transaction_id", words: int = WORDS):
        self.base, self.key, self.words = base.rstrip("/"), key, words
        self.rows = CommittedTable(f"{self.base}/rows", checkpoint, lambda d: d.drop("_day"))
        self.keys = CommittedTable(f"{self.base}/keys", checkpoint, self._key_rows)
        self.filters = CommittedTable(f"{self.base}/filters", checkpoint, self._filter_rows)

    def _key_rows(self, fresh: DataFrame) -> DataFrame:
        return fresh.select(_digest(F.col(self.key)).alias("digest"), F.col("_day").alias("day"))

    def _filter_rows(self, fresh: DataFrame) -> DataFrame:
        key = F.col(self.key)
        return (fresh.groupBy(F.col("_day").alias("day"), _word(key, self.words).alias("word"))
                .agg(F.bit_or(_mask(key)).alias("bits")))

    def _segments(self, spark: SparkSession, table: CommittedTable, schema: str, batch_id: int) -> DataFrame:
        """Rows of all committed batches but this one."""
        own = table.batch_folder(spark, batch_id)
        folders = [f for f in table.folders(spark) if f.rsplit("/", 1)[1] != own]
        if not folders:
            return spark.createDataFrame([], schema)
        return spark.read.schema(schema).parquet(*folders)

    def fresh(self, batch: DataFrame, batch_id: int) -> DataFrame:
        """The batch's rows whose key no earlier batch had, and their day."""
        spark = batch.sparkSession
        key = F.col(self.key)
        one = dedup_taps(batch, self.key)
        one = one.withColumn("_day", F.floor(epoch_micros(one, "event_time") / _DAY_US).cast("long"))
        filters = self._segments(spark, self.filters, FILTER_SCHEMA, batch_id)
        asked = one.select(_digest(key).alias("digest"), _word(key, self.words).alias("word"), _mask(key).alias("mask"))
        maybe = (asked.join(filters, "word").where(F.col("bits").bitwiseAND(F.col("mask")) == F.col("mask"))
                 .select("digest", "day").distinct())
        known = (self._segments(spark, self.keys, KEY_SCHEMA, batch_id).join(maybe, ["digest", "day"], "left_semi")
                 .select(F.col("digest").alias("_digest")))
        return one.join(known, _digest(key) == F.col("_digest"), "left_anti")

    def writer(self) -> BatchFn:
        """foreachBatch callback: new rows, their keys and the filter."""
        write = fan_out({"rows": self.rows, "keys": self.keys, "filters": self.filters})

        def run(batch: DataFrame, batch_id: int) -> None:
            write(self.fresh(batch, batch_id), batch_id)
        return run
