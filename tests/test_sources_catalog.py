"""Catalog tables, whole-file and binary sources, compressed text, local
data, caching, side effects and accumulators (S6, S8, S9, S10, S13, S14,
X3, X4)."""

from __future__ import annotations

import os
import time

import pytest
from pyspark import StorageLevel
from pyspark.sql import Observation
from pyspark.sql import functions as F

from kiln.session import materialize, scratch_path
from kiln.sources.tables import RECORDS_A_SLICE, fixed_length_records, read_lines, table

from kiln_cases import SF_SMALL


def test_catalog_tables(spark):
    n = table(spark, SF_SMALL, "nation")
    n.write.mode("overwrite").saveAsTable("kiln_nation")
    n.limit(5).write.insertInto("kiln_nation")                       # by position, append
    assert spark.table("kiln_nation").count() == 30
    n.limit(2).write.insertInto("kiln_nation", overwrite=True)
    assert spark.table("kiln_nation").count() == 2
    assert "kiln_nation" in [t.name for t in spark.catalog.listTables()]
    path = scratch_path(spark, "ext")
    n.write.parquet(path)
    spark.catalog.createTable("kiln_ext", path=path, source="parquet")
    spark.catalog.refreshTable("kiln_ext")
    assert spark.table("kiln_ext").count() == 25
    spark.sql("DROP TABLE kiln_ext")
    spark.sql("DROP TABLE kiln_nation")


def test_whole_text_and_binary_files(spark):
    path = scratch_path(spark, "docs")
    table(spark, SF_SMALL, "documents").select("text").repartition(3).write.text(path)
    whole = read_lines(spark, path, whole_text=True)
    assert whole.count() == len([f for f in os.listdir(path.replace("file:", "")) if f.startswith("part-")])
    binf = spark.read.format("binaryFile").load(path + "/part-*")
    assert binf.agg(F.sum("length")).first()[0] == whole.agg(F.sum(F.length(F.col("content").cast("binary")))).first()[0]
    # fixed-length records out of a binary file
    n_rec = (F.floor(F.col("length") / 16) - 1).cast("long")
    rec = binf.select(F.explode(F.sequence(F.lit(0).cast("long"), n_rec)).alias("i"), "content") \
              .select(F.substring("content", F.col("i") * 16 + 1, 16).alias("record"))
    assert rec.where(F.length("record") == 16).count() > 0


def test_compressed_text_sink(spark):
    path = scratch_path(spark, "gz")
    table(spark, SF_SMALL, "region").select("r_name").write.option("compression", "gzip").text(path)
    assert any(f.endswith(".gz") for f in os.listdir(path.replace("file:", "")))
    assert sorted(r.value for r in spark.read.text(path).collect()) == \
        sorted(r.r_name for r in table(spark, SF_SMALL, "region").collect())


def test_local_data_and_inspection(spark):
    df = spark.createDataFrame([(1, "a"), (2, None)], ["k", "v"])
    assert df.dtypes == [("k", "bigint"), ("v", "string")]
    assert df.toPandas().shape == (2, 2) and df.take(1)[0].k == 1 and df.first().k == 1
    assert not df.isEmpty() and df.limit(0).isEmpty()
    assert [r.id for r in spark.range(0, 10, 3).collect()] == [0, 3, 6, 9]
    assert sum(1 for _ in df.toLocalIterator()) == 2


def test_persist_and_lineage_cut(spark):
    df = table(spark, SF_SMALL, "orders").select("o_orderkey")
    p = df.persist(StorageLevel.MEMORY_AND_DISK)
    assert p.count() == 1500 and p.storageLevel == StorageLevel.MEMORY_AND_DISK
    p.unpersist()
    cut = materialize(df.where("o_orderkey % 2 = 0"))
    assert cut.count() == df.where("o_orderkey % 2 = 0").count()
    assert "Scan parquet" in cut._jdf.queryExecution().executedPlan().toString()
    ck = df.checkpoint(eager=True)                    # reliable checkpoint in the shared folder
    assert ck.count() == 1500


def test_foreach_partition_and_observe(spark):
    df = table(spark, SF_SMALL, "lineitem")
    obs = Observation("stats")
    observed = df.observe(obs, F.count(F.lit(1)).alias("rows"), F.sum("l_quantity").alias("qty"))
    observed.write.format("noop").mode("overwrite").save()
    assert obs.get["rows"] == df.count()
    acc = spark.sparkContext.accumulator(0)
    df.select("l_orderkey").foreachPartition(lambda it: acc.add(sum(1 for _ in it)))
    assert acc.value == df.count()


def _cut_file(spark, folder, data: bytes, length: int) -> list[bytes]:
    (folder / "a.bin").write_bytes(data)
    files = spark.read.format("binaryFile").load(str(folder))
    return [bytes(r["record"]) for r in fixed_length_records(files, length).select("record").collect()]


@pytest.mark.parametrize("n", [0, 1, RECORDS_A_SLICE, 2 * RECORDS_A_SLICE + 1])
def test_fixed_length_records_at_slice_ends(spark, tmp_path, n):
    data = b"".join(b"%7d" % i for i in range(n))
    assert sorted(_cut_file(spark, tmp_path, data + b"tail", 7)) == [b"%7d" % i for i in range(n)]


def test_fixed_length_records_in_time_linear_in_the_file(spark, tmp_path):
    """Cut with a copy of the file for every record, this takes minutes."""
    n = 300_000
    start = time.monotonic()
    out = _cut_file(spark, tmp_path, b"".join(b"%11d\n" % i for i in range(n)), 12)
    assert len(set(out)) == n
    assert time.monotonic() - start < 45
