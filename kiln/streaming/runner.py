"""Structured Streaming plumbing shared by the stream queries.

* ``stage``: lay a table down as files, batch by batch, so that a file stream
  reads it in that order, one micro-batch per batch;
* ``run_*``: run a stream to the end of its input with
  ``trigger(availableNow=True)``, checkpoint and output in the shared folder,
  and return the output as a batch table.  Output is kept under the batch id,
  so a batch that runs again replaces its own.
"""

from __future__ import annotations

from collections.abc import Callable
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from kiln.operators.joins import full_join_on
from kiln.session import partitions_for, scratch_path


@dataclass
class Staged:
    """Files of a stream: ``files_per_batch`` files make a batch."""
    path: str
    schema: StructType
    files_per_batch: int

    def stream(self, spark: SparkSession) -> DataFrame:
        return (spark.readStream.format("parquet").schema(self.schema)
                .option("maxFilesPerTrigger", self.files_per_batch).load(self.path))


def stage(df: DataFrame, name: str, n_batches: int, id_col: str, closing: DataFrame | None = None) -> Staged:
    """Write ``df`` as ``n_batches`` folders ``chunk=i``, chunk = floor(id /
    ceil((max id + 1) / n_batches)), a rule SQL can repeat.

    The file source takes files by age, so the folders are written one after
    the other, each by as many tasks (and files) as its share of the data
    asks for.  ``closing``: rows for one more batch, e.g. a late time stamp
    that moves the watermark past all windows.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    size = -(-(int(df.agg(F.max(id_col)).first()[0] or 0) + 1) // n_batches)
    files = -(-partitions_for(df, least=1) // n_batches)
    for i in range(n_batches):
        part = df.where((F.col(id_col) >= i * size) & (F.col(id_col) < (i + 1) * size))
        part.repartition(files).write.parquet(f"{path}/chunk={i}")
    if closing is not None:
        closing.select(*df.columns).repartition(1).write.parquet(f"{path}/chunk={n_batches}")
    return Staged(path, spark.read.parquet(path).schema, files)


def queue_stream(name: str, batches: list[DataFrame]) -> DataFrame:
    """A stream whose micro-batches are the given tables (``queueStream``),
    each written as its own folder ``batch=i``."""
    spark = batches[0].sparkSession
    path = scratch_path(spark, name)
    for i, df in enumerate(batches):
        df.repartition(1).write.parquet(f"{path}/batch={i}")
    return Staged(path, spark.read.parquet(path).schema, 1).stream(spark)


def _wait(q) -> None:
    q.awaitTermination()
    if q.exception() is not None:
        raise q.exception()


def run_append(stream: DataFrame, name: str, checkpoint: str | None = None) -> DataFrame:
    spark = stream.sparkSession
    out, ck = scratch_path(spark, f"{name}-out"), checkpoint or scratch_path(spark, f"{name}-ck")
    _wait(stream.writeStream.format("parquet").outputMode("append").option("checkpointLocation", ck)
          .trigger(availableNow=True).start(out))
    return spark.read.schema(stream.schema).parquet(out)


def run_foreach(stream: DataFrame, name: str, fn: Callable[[DataFrame, int], None], mode: str = "update",
                checkpoint: str | None = None) -> None:
    ck = checkpoint or scratch_path(stream.sparkSession, f"{name}-ck")
    _wait(stream.writeStream.outputMode(mode).option("checkpointLocation", ck).foreachBatch(fn)
          .trigger(availableNow=True).start())


def run_batches(stream: DataFrame, name: str, fn: Callable[[DataFrame, int], DataFrame], mode: str = "append") -> DataFrame:
    """Apply ``fn(batch_df, batch_id) -> DataFrame`` to every micro-batch and
    keep each result under its batch id (overwrite per id = idempotent)."""
    spark = stream.sparkSession
    out = scratch_path(spark, f"{name}-batches")

    def each(batch: DataFrame, batch_id: int):
        fn(batch, batch_id).write.mode("overwrite").parquet(f"{out}/batch_id={batch_id}")

    run_foreach(stream, name, each, mode=mode)
    return spark.read.option("basePath", out).parquet(out)


def run_latest(stream: DataFrame, name: str, keys: list[str]) -> DataFrame:
    """An aggregate stream in update mode: a batch writes only the keys it
    changed, and the last value written for a key is the answer."""
    changes = run_batches(stream, name, lambda batch, _: batch, mode="update")
    values = [c for c in stream.columns if c not in keys]
    last = changes.groupBy(*keys).agg(F.max_by(F.struct(*values), "batch_id").alias("_last"))
    return last.select(*keys, "_last.*")


def run_text_folders(stream: DataFrame, name: str) -> str:
    """Write every batch of a one-column stream as a text folder
    ``batch_id=<id>`` (``saveAsTextFiles``); returns the parent folder."""
    out = scratch_path(stream.sparkSession, f"{name}-text")
    run_foreach(stream, name, lambda batch, i: batch.write.mode("overwrite").text(f"{out}/batch_id={i}"), mode="append")
    return out


def update_state_by_key(stream: DataFrame, name: str, key: str, new: dict[str, Column], state: dict[str, Column],
                        keep: Column, state_schema: str) -> DataFrame:
    """``updateStateByKey``: after each batch the state of *every* key is
    renewed, also of keys without new rows, and keys may be dropped.

    ``new``: aggregates of a key's rows in the batch (NULL without rows).
    ``state``: each state column as an expression over the aggregates and the
    old state (NULL if there was none).  ``keep``: condition on the renewed
    state.  ``state_schema``: DDL of the key and the state columns.  The state
    is a table per batch id in the shared folder; batch n reads that of batch
    n - 1, so a batch can run again and a restart goes on from the last one.
    """
    spark = stream.sparkSession
    out = scratch_path(spark, f"{name}-state")
    empty = spark.createDataFrame([], state_schema)
    written = []

    def each(batch: DataFrame, batch_id: int):
        rows = batch.groupBy(key).agg(*(c.alias(n) for n, c in new.items()))
        old = spark.read.schema(empty.schema).parquet(f"{out}/batch_id={batch_id - 1}") if batch_id else empty
        renewed = full_join_on(rows, old, [key]).select(
            key, *(c.cast(empty.schema[n].dataType).alias(n) for n, c in state.items()))
        renewed.where(keep).write.mode("overwrite").parquet(f"{out}/batch_id={batch_id}")
        written[:] = [batch_id]

    run_foreach(stream, name, each, mode="append")
    return spark.read.schema(empty.schema).parquet(f"{out}/batch_id={written[0]}") if written else empty


@contextmanager
def utc_session(spark: SparkSession):
    """Event-time windows need TIMESTAMP (not NTZ); pin the session zone so
    the NTZ -> TIMESTAMP -> NTZ casts are the identity."""
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    try:
        yield
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def slice_batches(batches: DataFrame, first: int, last: int) -> DataFrame:
    """The outputs of micro-batches ``first``..``last`` (``DStream.slice``),
    read back from a ``run_batches`` table by its batch-id partitions."""
    return batches.where(F.col("batch_id").between(first, last))
