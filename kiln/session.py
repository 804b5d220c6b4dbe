"""Session helpers: building a session for tests/bench, and the shared
scratch folder every materialisation goes to.

On a cluster the operator names a shared folder in ``spark.checkpoint.dir``;
we only ever read that setting.  Only when it is unset (local tests, the
bench, the driver's smoke session) do we create a private folder and
register it, so ``DataFrame.checkpoint()`` and written intermediate tables
still work.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(master: str | None = None, app: str = "kiln",
                  shuffle_partitions: int | None = None,
                  extra: dict | None = None) -> SparkSession:
    cpus = os.environ.get("BENCH_CPUS", "8")
    master = master or f"local[{cpus}]"
    parts = shuffle_partitions or int(cpus)
    b = (SparkSession.builder.master(master).appName(app)
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .config("spark.sql.shuffle.partitions", str(parts))
         .config("spark.sql.adaptive.enabled", "true")
         .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
         .config("spark.sql.adaptive.skewJoin.enabled", "true")
         .config("spark.sql.session.timeZone", "UTC")
         .config("spark.sql.execution.arrow.pyspark.enabled", "true")
         .config("spark.driver.memory", "16g"))
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder for lineage cuts and intermediate tables.

    Reads ``spark.checkpoint.dir`` (or the context's checkpoint dir); sets a
    private one only when none is configured and the master is local: on a
    cluster each executor would write to its own disk, so that raises.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current.rsplit("/", 1)[0] if _is_context_subdir(current) else current
    conf_dir = sc.getConf().get("spark.checkpoint.dir", None)
    if conf_dir:
        sc.setCheckpointDir(conf_dir)
        return conf_dir
    if not sc.master.startswith("local[") and sc.master != "local":
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    local = tempfile.mkdtemp(prefix="kiln-ckpt-")
    sc.setCheckpointDir(local)
    return local


def _is_context_subdir(path: str) -> bool:
    # SparkContext appends a random UUID folder to the configured dir.
    tail = path.rstrip("/").rsplit("/", 1)[-1]
    try:
        uuid.UUID(tail)
        return True
    except ValueError:
        return False


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the shared checkpoint folder."""
    root = checkpoint_root(spark)
    return f"{root.rstrip('/')}/kiln-{name}-{uuid.uuid4().hex[:12]}"


def materialize(df: DataFrame, name: str = "cut", compression: str = "snappy") -> DataFrame:
    """Cut lineage: write a Parquet table into the shared checkpoint folder
    and read it back.

    The files live in the shared folder, not on the executor that computed
    them, so a lost executor costs nothing; Parquet is columnar and
    compressed, far cheaper than serialised-row RDD checkpoints.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.mode("overwrite").parquet(path, compression=compression)
    return spark.read.parquet(path)


def bounded_local(df: DataFrame, max_rows: int) -> DataFrame:
    """Re-create a small result whose size is bounded by parameters (e.g.
    buckets x folds models) as a local relation, so later plans do not
    recompute its lineage.  Raises if the bound does not hold."""
    rows = df.limit(max_rows + 1).collect()
    if len(rows) > max_rows:
        raise ValueError(f"expected at most {max_rows} rows")
    return df.sparkSession.createDataFrame(rows, df.schema)


def partitions_for(df: DataFrame, target_bytes: int = 128 << 20, least: int | None = None) -> int:
    """Partition count for an explicit (range) repartition: ``least`` (by
    default ``spark.sql.shuffle.partitions``), and about ``target_bytes`` of
    input per partition.

    The input size is the sum of the plan's leaf relations (file sizes for
    scans).  The optimizer's estimate of the whole plan is not used: without
    cost-based statistics a join is estimated as the product of its sides.
    AQE may merge small range partitions but never splits them, so the
    count must come from the data, not the session default.
    """
    least = least or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    sizes = [int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size())]
    total = sum(n for n in sizes if n < 1 << 62)            # Spark's "unknown size" is left out
    return max(least, -(-total // target_bytes))
