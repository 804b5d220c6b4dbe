"""Physical plan shapes that the scale design relies on, and bounds for the
approximate operators."""

from __future__ import annotations

import contextlib
import io

from pyspark.sql import functions as F

from kiln.plans.registry import load_all
from kiln.session import materialize
from kiln.sources.tables import table

from kiln_cases import SF_SMALL

REG = load_all()


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _formatted(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def test_top_k_is_take_ordered(spark):
    assert "TakeOrderedAndProject" in _plan(REG["o3_top_k"].build(spark, SF_SMALL))
    assert "TakeOrderedAndProject" in _plan(REG["d15_exact_size_sample"].build(spark, SF_SMALL))


def test_dimension_join_is_broadcast(spark):
    p = _formatted(REG["j10_broadcast_dimension_join"].build(spark, SF_SMALL))
    assert "BroadcastHashJoin" in p and "SortMergeJoin" not in p


def test_band_and_theta_joins_have_no_cartesian(spark):
    for name in ("j6_band_join", "j6_theta_join", "u4_subtract_keep_duplicates"):
        p = _formatted(REG[name].build(spark, SF_SMALL))
        assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p, name


def test_scans_are_pruned_and_filters_pushed(spark):
    p = _formatted(REG["d3_filter_where_getitem"].build(spark, SF_SMALL))
    assert "PushedFilters: [IsNotNull(l_quantity), IsNotNull(l_discount), IsNotNull(l_returnflag), " \
           "GreaterThan(l_quantity,20.0), LessThan(l_discount,0.05), EqualTo(l_returnflag,R)]" in p
    assert "ReadSchema: struct<l_orderkey:bigint,l_quantity:double,l_discount:double,l_returnflag:string>" in p


def test_fold_assignment_is_one_range_shuffle_then_narrow(spark):
    from kiln.plans.power_plans import regression_rows
    rows = regression_rows(spark, SF_SMALL)
    p = _formatted(rows.groupBy("bucket", "fold").count())
    # the tagged rows were written once; reading them back needs no shuffle
    # before the aggregate's own exchange
    tree = p.split("\n\n")[0]
    shuffles = [ln for ln in tree.splitlines() if "Exchange" in ln and "Broadcast" not in ln]
    assert len(shuffles) == 1, tree
    assert "Scan parquet" in p and "kiln-cut" in p


def test_scoring_join_is_broadcast_on_bounded_models(spark):
    p = _formatted(REG["p16_validation_rmse"].build(spark, SF_SMALL))
    assert "BroadcastHashJoin" in p and "SortMergeJoin" not in p


def test_keyed_reduce_combines_before_shuffle(spark):
    p = _formatted(REG["a14_reduce_by_key_user_monoid"].build(spark, SF_SMALL))
    assert "MapInPandas" in p and "FlatMapGroupsInPandas" in p


def test_loss_of_all_models_broadcasts_the_model_table(spark):
    p = _formatted(REG["p10_training_loss_fixed_weights"].build(spark, SF_SMALL))
    tree = p.split("\n\n")[0]
    assert "BroadcastHashJoin" in tree and "SortMergeJoin" not in tree
    # the data rows are shuffled only for the final per-model aggregate
    shuffles = [ln for ln in tree.splitlines() if "Exchange" in ln and "Broadcast" not in ln]
    assert len(shuffles) == 1, tree


def test_one_scan_where_one_is_enough(spark):
    for name, scans in (("m20_pearson_matrix", 1), ("a10_describe_population_std", 1), ("d12_dropna", 1), ("a1_group_dict_and_shortcuts", 1),
                        ("m22_kernel_density", 1), ("m25_multiclass_metrics", 1), ("m24_regression_metrics", 1)):
        tree = _formatted(REG[name].build(spark, SF_SMALL)).split("\n\n")[0]
        assert tree.count("Scan parquet") == scans, name


def test_estimates_scan_the_sample_once(spark):
    from kiln.operators.aggregates import clt_estimate
    df = clt_estimate(spark.read.parquet(f"{SF_SMALL}/lineitem.parquet"), "l_quantity", 0.1)
    assert _formatted(df).split("\n\n")[0].count("Scan parquet") == 1


def test_regression_rows_are_written_without_computed_copies(spark, monkeypatch):
    """The inputs of the regression are copies of table columns, so only
    those are written, shuffled and sorted."""
    from kiln.operators import indexing
    from kiln.plans import power_plans
    from kiln.sources.tables import table
    written = []

    def seen(df, *args, **kw):
        written.append(df.columns)
        return materialize(df, *args, **kw)

    monkeypatch.setattr(power_plans, "materialize", seen)
    monkeypatch.setattr(indexing, "materialize", seen)
    rows = power_plans._regression_rows(table(spark, SF_SMALL, "lineitem"), table(spark, SF_SMALL, "part"), True)
    assert rows.columns == ["bucket", "l_orderkey", "l_linenumber", *power_plans.INPUTS, power_plans.TARGET, "idx", "n_in_group", "fold"]
    assert len(written) == 3 and not {*power_plans.INPUTS, power_plans.TARGET} & {c for columns in written for c in columns}
    bucket = rows.where("bucket = 3").orderBy("idx").toPandas()
    assert bucket["idx"].tolist() == list(range(len(bucket))) and (bucket["x1"] > 0).all()


def test_many_parts_are_joined_without_sorting_the_rows(spark, monkeypatch):
    """A side too large to send met the rows of lineitem in a sort of both, which spills."""
    from kiln.operators import joins
    from kiln.plans import power_plans
    small = power_plans._regression_rows(table(spark, SF_SMALL, "lineitem"), table(spark, SF_SMALL, "part"), True)
    plans = []

    def seen(df, name="cut", *a):
        plans.append((name, df._jdf.queryExecution().toString()))
        return materialize(df, name, *a)

    monkeypatch.setattr(power_plans, "materialize", seen)
    monkeypatch.setattr(joins, "BROADCAST_BYTES", 0)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        large = power_plans._regression_rows(table(spark, SF_SMALL, "lineitem"), table(spark, SF_SMALL, "part"), True)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    plan = dict(plans)["regression"].split("== Physical Plan ==")[1]
    assert "ShuffledHashJoin" in plan and "SortMergeJoin" not in plan
    assert large.exceptAll(small).count() == 0 and small.count() == large.count()
