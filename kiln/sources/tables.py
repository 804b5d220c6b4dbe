"""Readers for the test tables and generic read/write helpers.

Tables are read lazily with ``spark.read.parquet``; column pruning and
filter pushdown happen in Catalyst when the caller selects / filters.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = ("region", "nation", "customer", "supplier", "part", "orders",
          "lineitem", "events", "documents", "embeddings", "pages",
          "benchmark", "labels", "conversations")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def register_views(spark: SparkSession, sf_dir: str, names=TABLES) -> None:
    """Register each table as a temp view under its own name."""
    for n in names:
        table(spark, sf_dir, n).createOrReplaceTempView(n)


def read_lines(spark: SparkSession, path: str, whole_text: bool = False) -> DataFrame:
    """Text lines (``textFile``) or whole files (``wholeTextFiles``)."""
    # text() sets its own wholetext default, so pass it as an argument
    df = spark.read.text(path, wholetext=whole_text)
    if whole_text:
        return df.select(F.input_file_name().alias("path"), F.col("value").alias("content"))
    return df


def write_table(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite",
                partition_by: list[str] | None = None, options: dict | None = None) -> str:
    w = df.write.format(fmt).mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    for k, v in (options or {}).items():
        w = w.option(k, v)
    w.save(path)
    return path


#: Records of a file that are cut at a time.
RECORDS_A_SLICE = 4096


def _pieces(content: Column, length: int, n: Column) -> Column:
    """The first ``n`` pieces of ``length`` bytes; the last may be shorter.

    The bytes are named by a lambda, which hands them on as they are: a
    column read inside ``transform`` copies the whole value for every piece.
    """
    at = F.when(n > 0, F.sequence(F.lit(0).cast("bigint"), n - 1)).otherwise(F.array().cast("array<bigint>"))
    cut = F.transform(F.array(content), lambda c: F.transform(at, lambda i: F.substring(c, (i * length + 1).cast("int"), F.lit(length))))
    return F.get(cut, F.lit(0))


def fixed_length_records(files: DataFrame, length: int, col: str = "content") -> DataFrame:
    """(path, record): the fixed-length records of binary files (columns
    ``path`` and ``content``, as the ``binaryFile`` source reads them, batch
    or stream).  A tail shorter than a record is dropped, as the reference
    does.  A file is one value, so it must fit a task; write many files.  It
    is cut into slices and these into records, in time linear in its length."""
    size = length * RECORDS_A_SLICE
    slices = files.select("path", F.explode(_pieces(F.col(col), size, F.ceil(F.octet_length(col) / size))).alias("_slice"))
    records = _pieces(F.col("_slice"), length, F.floor(F.octet_length("_slice") / length))
    return slices.select("path", F.explode(records).alias("record"))


def point_text(label: Column, vector: Column) -> Column:
    """A labelled point as text: ``(label,[v0,v1,...])``."""
    return F.concat(F.lit("("), label.cast("string"), F.lit(",["), F.array_join(vector.cast("array<string>"), ","), F.lit("])"))


def parse_point(text: Column) -> tuple[Column, Column]:
    """(label, vector) of a labelled point's text; NULL where it isn't one."""
    form = r"^\(([^,\[\]()]+),\[([^\[\]()]*)\]\)$"
    values = F.split(F.regexp_extract(text, form, 2), ",")
    label = F.regexp_extract(text, form, 1).try_cast("double")
    return label.alias("label"), F.when(label.isNotNull(), F.transform(values, lambda v: v.try_cast("double"))).alias("vector")
