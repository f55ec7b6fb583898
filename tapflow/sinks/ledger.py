"""Micro-batches that are written once, whatever fails in between.

A batch is written to a staging folder, then moved to its place in one rename;
the folder's presence is the commit.  A retry finds it and writes nothing; a
retry after a crash before the rename overwrites the staging folder, which no
reader sees.  So every row of a checkpointed query is in the table exactly
once, for readers of the folder and for streams that follow it.  (A file
system whose rename is not atomic needs a table format instead.)

``fan_out`` serves several sinks from one query, and so from one read of the
source: each sink has its own commit, so a failure between two of them does not
write the first one twice.

``upsert_sql`` is the statement by which a database does the same: the batch
goes to a staging table and is merged by key.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tapflow.sinks.tables import BatchFn, checkpoint_id, observed_write

Hook = Callable[[str, int], None]


def _fs(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


class CommittedTable:
    """A folder of committed batches, ``run-<checkpoint id>-batch-<n>``."""

    def __init__(self, base: str, checkpoint: str, transform: Callable[[DataFrame], DataFrame] | None = None,
                 before_commit: Hook | None = None, after_commit: Hook | None = None):
        self.base, self.checkpoint = base.rstrip("/"), checkpoint
        self.transform = transform or (lambda df: df)
        self.before_commit, self.after_commit = before_commit, after_commit

    def batch_folder(self, spark: SparkSession, batch_id: int) -> str:
        return f"run-{checkpoint_id(spark, self.checkpoint)}-batch-{batch_id}"

    def folders(self, spark: SparkSession) -> list[str]:
        """The committed batches of all runs."""
        path, fs = _fs(spark, self.base)
        fs.mkdirs(path)
        found = [str(s.getPath()) for s in fs.listStatus(path)]
        return sorted(f for f in found if f.rsplit("/", 1)[1].startswith("run-"))

    def committed(self, spark: SparkSession, batch_id: int) -> bool:
        path, fs = _fs(spark, f"{self.base}/{self.batch_folder(spark, batch_id)}")
        return fs.exists(path)

    def write(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        if self.committed(spark, batch_id):
            return
        name = self.batch_folder(spark, batch_id)
        staged = f"{self.base}/_staging/{name}"
        observed_write(self.transform(batch), lambda d: d.write.mode("overwrite").parquet(staged),
                       self.base.rsplit("/", 1)[-1], batch_id)
        if self.before_commit:
            self.before_commit(name, batch_id)
        source, fs = _fs(spark, staged)
        if not fs.rename(source, _fs(spark, f"{self.base}/{name}")[0]):
            raise OSError(f"could not commit {name}")
        if self.after_commit:
            self.after_commit(name, batch_id)


def read_committed(spark: SparkSession, base: str, schema) -> DataFrame:
    """The committed rows; an empty table where nothing is committed yet."""
    path, fs = _fs(spark, base)
    fs.mkdirs(path)
    return spark.read.schema(schema).option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet").parquet(base)


def follow_committed(spark: SparkSession, base: str, schema) -> DataFrame:
    """A stream of the rows as they are committed (staging is hidden from it
    by its leading underscore)."""
    path, fs = _fs(spark, base)
    fs.mkdirs(path)
    return spark.readStream.schema(schema).parquet(f"{base.rstrip('/')}/run-*")


def fan_out(sinks: dict[str, CommittedTable]) -> BatchFn:
    """foreachBatch callback: the batch to every sink that lacks it.  The rows
    are kept while there is more than one sink to write, so the source is read
    once."""
    def write(batch: DataFrame, batch_id: int) -> None:
        missing = [s for s in sinks.values() if not s.committed(batch.sparkSession, batch_id)]
        rows = batch.persist() if len(missing) > 1 else batch
        try:
            for sink in missing:
                sink.write(rows, batch_id)
        finally:
            if len(missing) > 1:
                rows.unpersist()
    return write


def upsert_sql(table: str, staging: str, columns: list[str], key: list[str]) -> str:
    """Merge of a staged batch by key: rows that are there stay as they are."""
    names = ", ".join(columns)
    return (f"INSERT INTO {table} ({names}) SELECT {names} FROM {staging} "
            f"ON CONFLICT ({', '.join(key)}) DO NOTHING")
