"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Prints ONE JSON line:
{"metric": "total_sec", "value": N, "unit": "sec", "queries": {...}, "sf": ...}

Each query is fully materialised (a no-op write to the "noop" sink), so
the time is the whole plan, not a collect of a few rows.  What several
queries share (fold-assigned rows, standardised models) is prepared first
and timed by itself as ``prepare_*``; the fit reports seconds per iteration.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from kiln.plans.registry import load_all  # noqa: E402
from kiln.session import build_session  # noqa: E402

HEADLINE = [
    "p18_cv_report",                   # flagship: nested CV evaluation, all in Catalyst
    "p10_training_loss_fixed_weights",  # loss of every model in one job
    "p2_parse_records",
    "p22_word_count",
    "a1_group_agg_columns",            # TPC-H Q1 shape
    "s7_temp_view_sql",                # TPC-H Q3 shape through SQL text
    "j2_left_outer_join",
    "a15_group_by_key_long",
    "w1_running_sum_per_key",
    "w3_ranking_functions",
    "m6_exact_tf_idf",
    "m26_ranking_metrics",
    "t6_sliding_event_time_window",
    "t10_update_state_by_key",
]


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    only = sys.argv[1:]
    spark = build_session(master=f"local[{cpus}]", shuffle_partitions=int(cpus) * 2)
    reg = load_all()
    # JVM/JIT warm-up outside the timings (one small scan + aggregate)
    spark.read.parquet(f"{sf_dir}/region.parquet").groupBy("r_name").count().collect()
    times = {}
    if not only:
        from kiln.plans.power_plans import fixed_models, regression_rows
        t0 = time.time()
        rows = regression_rows(spark, sf_dir)
        times["prepare_folds"] = round(time.time() - t0, 3)
        t0 = time.time()
        fixed_models(rows)
        times["prepare_models"] = round(time.time() - t0, 3)
    for name in HEADLINE:
        if only and name not in only:
            continue
        t0 = time.time()
        df = reg[name].build(spark, sf_dir)
        df.write.format("noop").mode("overwrite").save()
        times[name] = round(time.time() - t0, 3)
    extra = {}
    if not only or "nested_cv_fit" in only:
        from kiln.plans import fit_plans
        iters = int(os.environ.get("BENCH_FIT_ITERS", fit_plans.ITERATIONS))
        t0 = time.time()
        rows, fitted, *_ = fit_plans.trained(spark, sf_dir, iterations=iters)
        n_models = fitted.count()
        times["nested_cv_fit"] = round(time.time() - t0, 3)
        extra = {"fit_iterations": iters, "fit_models": n_models,
                 "fit_sec_per_iteration": round(times["nested_cv_fit"] / max(iters, 1), 3)}
        # validation/test scoring of the trained models and the report
        from kiln.operators import cv
        from kiln.operators.layers import layer_sizes
        from kiln.plans.power_plans import INPUTS, K, TARGET
        t0 = time.time()
        rep = cv.cv_report(rows, fitted.drop("reason", "iterations", "final_error"), INPUTS, TARGET,
                           layer_sizes(len(INPUTS), fit_plans.HIDDEN, 1), K, "per_fold")
        rep.write.format("noop").mode("overwrite").save()
        times["nested_cv_report"] = round(time.time() - t0, 3)
    if not only or "power_file_job" in only:
        # the reference's whole job: power text -> parse -> buckets -> folds -> fit -> report
        from kiln.operators.nested import power_file_report
        from kiln.plans.power_plans import events_power_lines
        from kiln.session import scratch_path
        iters = int(os.environ.get("BENCH_FIT_ITERS", "100"))
        path = scratch_path(spark, "bench-power")
        events_power_lines(spark, sf_dir).select("value").write.text(path)
        t0 = time.time()
        report, _, _ = power_file_report(spark, path, max_iter=iters)
        report.write.format("noop").mode("overwrite").save()
        times["power_file_job"] = round(time.time() - t0, 3)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    out = {"metric": "total_sec", "value": round(sum(times.values()), 3), "unit": "sec",
           "queries": times, "sf": float(m.group(1)) if m else sf_dir, **extra}
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
