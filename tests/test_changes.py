"""Change and escalation streams: parts, repeats, any order, restarts, late events, a hot device."""

import datetime as dt
import itertools
import random
import uuid

import pytest
from pyspark.sql import functions as F

from turnstile.session import mkdirs, path_exists, scratch_path
from turnstile.streaming import changes as ch

SCHEMA = "device_id long, date date, v int"
D1, D2 = dt.date(2024, 1, 1), dt.date(2024, 1, 2)


def paths(spark, name):
    made = [scratch_path(spark, f"{d}/{name}-{uuid.uuid4().hex}") for d in ("landing", "table")]
    mkdirs(spark, made[0])
    return made


def deliver(spark, table, landing, rows):
    spark.createDataFrame(rows, table.schema).coalesce(1).write.mode("append").parquet(landing)
    table.step(landing)


def held(table):
    return sorted((r.device_id, r.date, r.v) for r in table.read().collect())


@pytest.mark.parametrize("order", [0, 1, 2])
def test_any_order_of_parts_ends_alike(spark, order):
    """A day in three parts with corrections, deletes and repeats."""
    landing, path = paths(spark, "cdc")
    table = ch.ChangeTable(spark, path, spark.createDataFrame([], SCHEMA).schema, ["device_id", "date"])
    parts = [[(1, D1, 1, 1, False), (2, D1, 1, 1, False), (9, D2, 7, 1, None)],
             [(2, D1, 5, 3, False), (2, D1, 4, 2, False), (3, D1, 1, 1, False), (1, D1, None, 2, True)],
             [(3, D1, None, 2, True), (3, D1, 8, 3, False), (1, D1, 1, 1, False), (2, D1, 5, 3, False), (4, D1, 1, 1, False)]]
    for k, part in enumerate(list(itertools.permutations(parts))[order * 2]):
        deliver(spark, table, landing, part)
        if k == order % 2:
            table.compact()
    assert held(table) == [(2, D1, 5), (3, D1, 8), (4, D1, 1), (9, D2, 7)]
    table.compact()
    table.compact()  # nothing new
    assert held(table) == [(2, D1, 5), (3, D1, 8), (4, D1, 1), (9, D2, 7)]
    assert not table._folders("log")


def test_compaction_rewrites_touched_days_alone(spark):
    landing, path = paths(spark, "cdc")
    table = ch.ChangeTable(spark, path, spark.createDataFrame([], SCHEMA).schema, ["device_id", "date"])
    assert held(table) == []
    deliver(spark, table, landing, [(1, D1, 1, 1, False), (1, D2, 1, 1, False)])
    table.compact()
    deliver(spark, table, landing, [(1, D2, 2, 2, False), (2, None, 3, 1, False)])
    table.compact()
    assert {(r.date, r.version) for r in table._manifest()[1].collect()} == {(D1, 0), (D2, 1), (None, 1)}
    assert not path_exists(spark, f"{path}/days/0/_day=nothing") and path_exists(spark, f"{path}/days/0")
    deliver(spark, table, landing, [(1, D1, None, 5, True)])
    table.compact()
    again = ch.ChangeTable(spark, path, spark.createDataFrame([], SCHEMA).schema, ["device_id", "date"])  # a restart
    assert sorted((r.device_id, r.date, r.v) for r in again.read().where("date is not null").collect()) == [(1, D2, 2)]
    assert again.read().where("date is null").count() == 1 and table._folders("days") == [1, 2]


def test_snapshot_of_whole_days(spark):
    landing, path = paths(spark, "cdc")
    table = ch.ChangeTable(spark, path, spark.createDataFrame([], SCHEMA).schema, ["device_id", "date"])
    for seq, rows in enumerate([[(1, D1, 1), (2, D1, 1)], [(3, D2, 1)], [(2, D1, 9), (4, D1, 1)]]):
        table.of_snapshot(spark.createDataFrame(rows, SCHEMA), seq).write.mode("append").parquet(landing)
        table.step(landing)
    assert held(table) == [(2, D1, 9), (3, D2, 1), (4, D1, 1)]  # day 1 again: device 1 is gone


LEVELS = ["LOW", "MEDIUM", "HIGH", "CRITICAL", "OTHER"]


def plain_escalations(rows):
    out = []
    for d in {r[0] for r in rows}:
        mine = sorted({r for r in rows if r[0] == d}, key=lambda r: (r[1], r[2]))
        out += [(d, a[4], b[4]) for a, b in zip(mine, mine[1:]) if "OTHER" not in (a[3], b[3]) and LEVELS.index(b[3]) > LEVELS.index(a[3])]
    return sorted(out)


def test_escalations_with_late_events_and_a_hot_device(spark):
    rng = random.Random(3)
    start = dt.datetime(2024, 1, 1)
    rows = [(rng.choice([1, 1, 2, 3, 4, 5]), start + dt.timedelta(minutes=i // 2), i, rng.choice(LEVELS), f"E{i}") for i in range(1200)]
    landing, path = paths(spark, "esc")
    schema = "device_id long, timestamp timestamp, event_id long, severity string, error_code string"
    errors = spark.createDataFrame([], schema)
    # part k has its events but some of the last hour, which come with the next, and repeats
    parts, behind = [], []
    for k in range(4):
        mine = rows[300 * k:300 * (k + 1)]
        slow = [r for r in mine[200:] if rng.random() < 0.4] if k < 3 else []
        part = [r for r in mine if r not in slow] + behind + rng.sample(mine[200:], 20)
        part = [r for r in part if r not in slow] + [r for r in mine[280:] if r not in slow]
        rng.shuffle(part)
        parts.append(part)
        behind = slow
    too_late = (1, start, 5000, "CRITICAL", "E5000")
    parts[3].append(too_late)
    for part in parts:
        spark.createDataFrame(part, schema).write.mode("append").parquet(landing)
        table = ch.EscalationTable(spark.readStream.schema(errors.schema).parquet(landing), "3 hours", path)  # restarted every time
        table.step()
    before = table.read().count()
    table.finish()
    got = sorted((r.device_id, r.from_error, r.to_error) for r in table.read().collect())
    assert got == plain_escalations(rows) and 0 < before < len(got)
    assert [r.event_id for r in table.late().collect()] == [5000]


def test_escalations_of_nothing(spark):
    landing, path = paths(spark, "esc")
    errors = spark.createDataFrame([], "device_id long, timestamp timestamp, event_id long, severity string, error_code string")
    table = ch.EscalationTable(spark.readStream.schema(errors.schema).parquet(landing), "1 hour", path)
    table.step()
    table.finish()
    assert table.read().count() == 0 and table.late().count() == 0


def test_merged_latency_sketches(spark):
    """Heavily skewed latencies in one window, far more distinct values than a sketch keeps; the exact way beside it."""
    from turnstile.streaming import stream as st

    n = 40000
    r = spark.range(n).select(F.timestamp_seconds(F.lit(1704067200) + F.pmod("id", F.lit(1500))).alias("ts"), (F.pmod("id", F.lit(7)) != 0).alias("success"),
                              F.pow(F.pmod(F.xxhash64("id"), F.lit(100003)).cast("double"), F.lit(2.0)).alias("duration_ms"))
    r = r.unionByName(r.limit(0)).withColumn("duration_ms", F.when(F.col("duration_ms") > 10, F.col("duration_ms")))
    values = sorted(x[0] for x in r.select("duration_ms").collect() if x[0] is not None)
    got = st.merged_windows(st.minute_sketches(r), "1 hour").first()
    assert got.requests == n and got.max_ms == values[-1] and abs(got.avg_ms - sum(values) / len(values)) < 1e-3
    for q, v in ((0.5, got.p50_ms), (0.95, got.p95_ms), (0.99, got.p99_ms)):
        rank = sum(x <= v for x in values) / len(values)
        assert abs(rank - q) < 2 * st.RANK_ERROR
    exact = st.request_metrics(r, 60).first()
    import math

    assert [exact.p50_ms, exact.p95_ms, exact.p99_ms] == [values[math.ceil(q * len(values)) - 1] for q in (0.5, 0.95, 0.99)]
    assert st.merged_windows(st.minute_sketches(r), "10 minutes", "5 minutes").count() == 6


def test_stationary_by_joins_equals_dense(spark):
    from turnstile.operators import patterns

    rng = random.Random(9)
    rows = [(i % 7, dt.datetime(2024, 1, 1) + dt.timedelta(minutes=i), i, f"c{min(rng.randint(0, 9), rng.randint(0, 9))}") for i in range(600)]
    e = spark.createDataFrame(rows, "device_id long, timestamp timestamp, event_id long, error_code string")
    dense = {r.error_code: r.stationary_probability for r in patterns.stationary_distribution(e).collect()}
    sparse = {r.error_code: r.stationary_probability for r in patterns.stationary_distribution(e, dense_codes=3).collect()}
    assert dense.keys() == sparse.keys() and all(abs(dense[c] - sparse[c]) < 1e-6 for c in dense)
