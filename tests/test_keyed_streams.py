"""Sliding windows with an inverse, and state under a user function: against
plain Python, with the state that the store holds."""

from __future__ import annotations

import datetime as dt
import random

from pyspark.sql import functions as F

from kiln.session import scratch_path
from kiln.streaming import keyed, runner

START = dt.datetime(2024, 1, 1)


def _events(spark, n, n_batches, seed, keys, closing_days=4):
    """Rows in order of time over five days; a closing row moves the watermark on."""
    rng = random.Random(seed)
    times = sorted(rng.randrange(5 * 86400) for _ in range(n))
    rows = [(i, rng.choice(keys), START + dt.timedelta(seconds=t), rng.randint(-5, 9)) for i, t in enumerate(times)]
    df = spark.createDataFrame(rows, "id bigint, k string, ts timestamp, v bigint")
    late = spark.createDataFrame([(n, "closing", START + dt.timedelta(days=5 + closing_days), 0)], df.schema)
    return rows, runner.stage(df, f"keyed{seed}", n_batches, "id", late).stream(spark)


def _brute(rows, slide, panes, keep):
    first, out = int(START.replace(tzinfo=dt.timezone.utc).timestamp()), {}
    for _, k, ts, v in rows:
        pane = (first + int((ts - START).total_seconds())) // slide
        for end in range(pane + 1, pane + 1 + panes):
            n, total = out.get((k, end), (0, 0))
            out[k, end] = n + 1, total + v
    return {(k, (end - panes) * slide * 1000): v for (k, end), v in out.items() if keep(v)}


def test_sliding_windows_equal_plain_sums(spark):
    with runner.utc_session(spark):
        rows, stream = _events(spark, 400, 4, 3, ["a", "b", None])
        calls = spark.sparkContext.accumulator(0)

        def reduce(a, b):
            calls.add(1)
            return a[0] + b[0], a[1] + b[1]

        out = keyed.reduce_by_key_and_window(stream.withColumn("n", F.when(F.col("k").eqNullSafe("closing"), 0).otherwise(1).cast("bigint")),
                                             "sliding", ["k"], "ts", ["n", "v"], 3600, 24, reduce, lambda a, b: (a[0] - b[0], a[1] - b[1]),
                                             lambda v: v[0] > 0, delay="1 hour")
        got = [((r.k, r.window_start_ms), (r.n, r.v)) for r in out.collect()]
    want = _brute(rows, 3600, 24, lambda v: True)
    assert len(got) == len(want) and dict(got) == want
    # each row is reduced once into its pane and each pane once into its key's window: not once per window
    assert calls.value < 2 * len(rows)


def test_state_rows_are_keys_times_panes(spark):
    """What the store holds after the last batch: a pane per key and slide of
    the window, whatever the rows and the windows that were sent."""
    with runner.utc_session(spark):
        rows, stream = _events(spark, 500, 4, 9, ["a", "b", "c"], closing_days=0)
        checkpoint = scratch_path(spark, "panes-ck")
        out = keyed.reduce_by_key_and_window(stream, "panes", ["k"], "ts", ["v"], 3600, 6, lambda a, b: (a[0] + b[0],), lambda a, b: (a[0] - b[0],),
                                             checkpoint=checkpoint)
        sent = out.count()
        panes = spark.read.format("statestore").option("stateVarName", "panes").load(checkpoint).count()
    assert sent > 3 * 100 and 0 < panes <= 3 * (6 + 1) + 1


def test_state_under_a_user_function(spark):
    rng = random.Random(2)
    rows = [(i, rng.choice(["a", "b", "c", None]) if i % 100 < 60 else "a", i) for i in range(400)]
    df = spark.createDataFrame(rows, "id bigint, k string, v bigint")

    def update(new, old):
        """(sum, batches seen); a key whose sum passes 12,000 is removed."""
        total, seen = old or (0, 0)
        total += sum(v[0] for v in new)
        return None if total > 12_000 else (total, seen + 1)

    changes = keyed.update_state_by_key(runner.stage(df, "user-state", 4, "id").stream(spark), "user-state", "k", ["v"],
                                        "total bigint, seen int", update)
    got = {r.k: (r.total, r.seen) for r in keyed.latest_state(changes, "k").collect()}
    want = {}
    for batch in range(4):
        part = [r for r in rows if r[0] // 100 == batch]
        for k in {r[1] for r in part} | set(want):
            state = update([(r[2],) for r in part if r[1] == k], want.get(k))
            if state is None:
                want.pop(k, None)
            else:
                want[k] = state
    assert got == want and None in want
    assert changes.where("removed").count() > 0


def test_only_changed_states_are_written(spark):
    df = spark.createDataFrame([(i, "a" if i < 10 else "b", i) for i in range(40)], "id bigint, k string, v bigint")
    changes = keyed.update_state_by_key(runner.stage(df, "unchanged", 4, "id").stream(spark), "unchanged", "k", ["v"], "most bigint",
                                        lambda new, old: (max([v[0] for v in new] + list(old or ())),), shrink=lambda vs: [max(vs)])
    assert sorted((r.batch_id, r.k, r.most) for r in changes.collect()) == [(0, "a", 9), (1, "b", 19), (2, "b", 29), (3, "b", 39)]


def test_a_call_asks_the_store_at_most_twice():
    """Each access is a message to the store: one read and one write for a key in a batch."""
    import pandas as pd
    from pyspark.sql.types import StructType

    from kiln.streaming.keyed import _KeyState

    class Value:
        def __init__(self):
            self.value, self.asked = None, 0

        def __getattr__(self, name):
            if name not in ("get", "exists", "update", "clear"):
                raise AttributeError(name)

            def access(*given):
                self.asked += 1
                if name in ("update", "clear"):
                    self.value = given[0] if given else None
                return self.value is not None if name == "exists" else self.value
            return access

    class Handle:
        def __init__(self):
            self.values, self.timers = [], []

        def getValueState(self, *_):
            self.values.append(Value())
            return self.values[-1]

        def registerTimer(self, at):
            self.timers.append(at)

    class Time:
        def __init__(self, now):
            self.now = now

        def getCurrentProcessingTimeInMs(self):
            return self.now

    def update(new, old):
        n = (old[0] if old else 0) + len(new)
        return (n,) if new or n < 3 else None

    handle, state = Handle(), StructType.fromDDL("n int")
    p = _KeyState(1, state, StructType.fromDDL("k string, removed boolean, n int"), update)
    p.init(handle)
    sent = [list(p.handleInputRows(("a",), iter([pd.DataFrame({"v": [1, 2]})]), Time(10))),
            list(p.handleExpiredTimer(("a",), Time(10), None)), list(p.handleExpiredTimer(("a",), Time(11), None)),
            list(p.handleInputRows(("a",), iter([pd.DataFrame({"v": [1]})]), Time(12))),
            list(p.handleExpiredTimer(("a",), Time(13), None)), list(p.handleExpiredTimer(("a",), Time(14), None))]
    assert [[f.iloc[0].tolist()[1:] for f in s] for s in sent] == [[[False, 2]], [], [], [[False, 3]], [[True, None]], []]
    assert sum(v.asked for v in handle.values) <= 2 * len(sent)
