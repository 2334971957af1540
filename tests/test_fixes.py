"""Results that must not depend on row counts, partitions, micro-batches or ties."""

import datetime as dt
import uuid

import numpy as np
import pytest
from pyspark.sql import functions as F

from turnstile.operators import anomaly as an
from turnstile.operators import causes as cz
from turnstile.operators import cdc, scoring
from turnstile.operators import survival as sv
from turnstile.session import mkdirs, scratch_path
from turnstile.streaming import stream as st


# ---- isolation forest

def _points(spark, n):
    x = spark.range(n).select(F.col("id").alias("device_id"), F.lit("2024-01-01").cast("date").alias("date"),
                              (F.pmod(F.xxhash64("id"), F.lit(1000)) / 100).alias("a"),
                              (F.pmod(F.xxhash64("id", F.lit(1)), F.lit(1000)) / 100).alias("b"))
    return x


@pytest.mark.parametrize("n", [100, 1000, 20000])
def test_tree_samples_do_not_depend_on_row_count(spark, n):
    model = an.fit_isolation_forest(_points(spark, n), ["a", "b"], n_trees=20)
    assert model["psi"] == min(256, n)
    assert [int(t[4][0]) for t in model["trees"]] == [min(256, n)] * 20


def test_scores_do_not_depend_on_partitions(spark):
    x = _points(spark, 3000)
    got = []
    for k in (1, 16):
        model = an.fit_isolation_forest(x.repartition(k), ["a", "b"], n_trees=20)
        got.append({r.device_id: r.anomaly_score for r in an.score_isolation_forest(x.repartition(k), model).collect()})
    assert got[0] == got[1]


# ---- survival

def test_rul_equals_its_definition(spark):
    ages = [1, 2, 5, 10, 30, 60, 90, 200, 400]
    for lam, rho in ((1000.0, 1.0), (30.0, 0.7), (30.0, 2.5), (5.0, 4.0)):
        df = spark.createDataFrame([(i, a, 1, 50.0) for i, a in enumerate(ages)], "device_id int, duration_days int, event int, health_score double")
        got = {r.device_id: r.rul_median_days for r in sv.rul(df, lam, rho).collect()}
        for i, a in enumerate(ages):
            s = lambda t: np.exp(-((t / lam) ** rho))
            assert got[i] == next((k for k in range(90) if s(a + k) < s(a) * 0.5), 90), (lam, rho, a)


def test_sla_score_without_errors(spark):
    df = spark.createDataFrame([(1, 10, 1, 40.0, 0, 1)], "device_id int, duration_days int, event int, health_score double, cumulative_errors int, is_old_device int")
    r = sv.sla_risk(df, sv.rul(df, 40.0, 1.3)).first()
    assert r.sla_risk_score == pytest.approx(60 * 0.3 + r.sla_breach_prob * 40 + 10, abs=0.06)


def test_concordance_equals_pairs(spark):
    rng = np.random.default_rng(3)
    rows = [(int(rng.integers(1, 40)), int(rng.integers(0, 2)), float(rng.integers(0, 9))) for _ in range(300)]
    num = den = 0.0
    for t, e, r in rows:
        for t2, _, r2 in rows:
            if e and t2 > t:
                den += 1
                num += 1.0 if r > r2 else 0.5 if r == r2 else 0.0
    got = sv.concordance_index(spark.createDataFrame(rows, "duration_days int, event int, partial_hazard double")).first()
    assert got.comparable_pairs == den and got.concordance_index == pytest.approx(num / den)


# ---- scoring, matching, CDC

def test_top_cause_counts_every_factor(spark):
    df = spark.createDataFrame([(["A", "B"],), (["B"],), (["C", "B", "A"],), ([],)], "f array<string>").select(
        F.transform("f", lambda x: F.struct(x.alias("factor"))).alias("risk_factors"))
    assert tuple(scoring.top_fleet_cause(df).first()) == ("B", 3)
    assert tuple(scoring.top_fleet_cause(df.where("size(risk_factors) = 0")).first()) == ("None", 0)


def test_tied_scores_do_not_see_their_own_outcome(spark):
    df = spark.range(4000).select(F.pmod("id", F.lit(2)).cast("int").alias("arm"), F.lit(0.5).alias("ps"),
                                  F.pmod(F.xxhash64("id"), F.lit(2)).cast("int").alias("y"), F.xxhash64("id", F.lit(9)).alias("_key"))
    m = cz.nearest_opposite(df, "arm", "ps", "y", bucket_rows=500)
    agree = m.agg(F.avg((F.col("y") == F.col("matched_outcome")).cast("double"))).first()[0]
    assert 0.45 < agree < 0.55 and m.count() == 4000


def test_changes_keep_types(spark):
    old = spark.createDataFrame([(1, dt.date(2024, 1, 1), 2**60, None), (2, None, 0, "0"), (3, dt.date(2024, 1, 1), 1, "a")],
                                "device_id int, day date, big long, s string")
    new = spark.createDataFrame([(1, dt.date(2024, 1, 2), 2**60, None), (2, None, None, None), (3, dt.date(2024, 1, 1), 1, "a")],
                                "device_id int, day date, big long, s string")
    got = {r.device_id: r.change_type for r in cdc.detect_changes(old, new).collect()}
    assert got == {1: "UPDATE", 2: "UNCHANGED", 3: "UNCHANGED"}
    near = new.withColumn("big", F.col("big") + 1)
    assert {r.device_id: r.change_type for r in cdc.detect_changes(new, near).collect()}[1] == "UPDATE"


def test_hash_sees_null_positions_and_pairs(spark):
    def h(rows):
        return cdc.table_hash(spark.createDataFrame(rows, "a string, b string")).first().content_hash

    assert h([(None, "x")]) != h([("x", None)])
    assert h([("x", "y"), ("x", "y")]) != h([("z", "y"), ("z", "y")])
    assert h([("x", "y"), ("p", "q")]) == h([("p", "q"), ("x", "y")])


def test_watermark_actions(spark):
    b = spark.createDataFrame([(1, 2)], "k int, v int")
    h = cdc.table_hash(b).first()
    state = spark.createDataFrame([("t", dt.date(2024, 1, 5), h.row_count, h.content_hash, None)], cdc.WATERMARK_SCHEMA)

    def act(table, batch, day):
        return cdc.watermark_decision(state, table, batch, day).first().action

    more = b.withColumn("v", F.col("v") + 1)
    assert [act("t", b, "2024-01-05"), act("t", more, "2024-01-05"), act("t", more, "2024-01-06"), act("t", b, "2024-01-06"), act("u", b, "2024-01-01")] \
        == ["skip", "reprocess", "process", "process", "first_load"]


# ---- streams over several batches

def _paths(spark, name):
    tag = uuid.uuid4().hex
    made = [scratch_path(spark, f"{d}/{name}-{tag}") for d in ("landing", "silver", "checkpoint")]
    mkdirs(spark, made[0])
    return made


def test_restarted_update_stream_has_one_row_a_window(spark):
    landing, out, _ = _paths(spark, "tumble")
    e = spark.range(400).select(F.pmod("id", F.lit(3)).alias("user_id"), F.timestamp_seconds(F.lit(1704067200) + F.col("id") * 60).alias("ts"),
                                F.lit("error").alias("event_type"))
    table = st.StreamTable(st.tumbling_device_counts(spark.readStream.schema(e.schema).parquet(landing), 15, "1 hour"), "t", "update",
                           ["device_id", "window_start"], path=out)
    for k in range(4):  # parts interleave within windows
        e.where(F.pmod(F.floor(F.unix_timestamp("ts") / 60), F.lit(4)) == k).where(F.lit(k == 0) | (F.col("ts") >= "2024-01-01 05:45:00")) \
            .write.mode("append").parquet(landing)
        table.step()
        before = sorted(map(tuple, table.read().collect()))
        if k in (1, 2):
            table.compact()
            table.compact()  # nothing new
            assert sorted(map(tuple, table.read().collect())) == before and not table._numbers("out")
    got = table.read()
    assert got.groupBy("device_id", "window_start").count().where("count > 1").count() == 0
    assert got.agg(F.sum("events")).first()[0] == spark.read.parquet(landing).count()


# ---- one day's escalations

def test_daily_escalations_window_by_device_and_hour(spark, capsys):
    from turnstile.operators import patterns as pt

    names = ["Low", "Medium", "High", "Critical", "odd", "low", "medium", "high", "critical", "LOW", "MEDIUM", "HIGH", "CRITICAL", None]
    rows = [(d, dt.datetime(2024, 1, 1 + (i > 190), i % 191 // 8, i % 8 * 7), i, names[(i * i * 7 + i // 3 + (d or 0)) % len(names)]) for d in (1, 2, None) for i in range(200)]
    df = spark.createDataFrame(rows, "device_id long, timestamp timestamp, event_id long, severity string").repartition(5)
    ranked = df.select("device_id", "timestamp", "event_id", F.coalesce(pt.severity_rank("severity"), F.lit(0)).alias("rank")).collect()
    want = 0
    for d in (1, 2, None):
        ranks = [r["rank"] for r in sorted((r for r in ranked if r.device_id == d and r.timestamp.day == 1), key=lambda r: (r.timestamp, r.event_id))]
        want += sum(b > a for a, b in zip(ranks, ranks[1:]))
    got = pt.daily_escalation_count(df, "2024-01-01")
    assert want > 50 and got.first()[0] == want
    got.explain()
    plan = capsys.readouterr().out
    assert "lead(rank" in plan and "_hour" in plan  # no window over all of a device's events


def test_intermediate_tables_go_with_their_run(spark, tmp_path):
    import __spark_entry__ as E
    from tests.conftest import SF_SMALL
    from turnstile.session import materialize, path_exists, scratch_run

    query = E.queries()["d1_daily_split"]  # over the gold table, which is written once
    before = sorted(tuple(r) for r in query(spark, SF_SMALL).collect())
    outer = materialize(spark.range(3), "kept")
    out = f"file://{tmp_path}/result"
    with scratch_run(spark) as folder:
        query(spark, SF_SMALL).write.parquet(out)
        inside = materialize(spark.range(5), "gone")
        assert path_exists(spark, folder) and all(folder.rsplit("/", 1)[1] in f for f in inside.inputFiles())
    assert not path_exists(spark, folder)
    assert sorted(tuple(r) for r in spark.read.parquet(out).collect()) == before
    try:
        with scratch_run(spark) as folder:
            materialize(spark.range(5), "gone")
            raise KeyError
    except KeyError:
        assert not path_exists(spark, folder)
    assert outer.count() == 3 and sorted(tuple(r) for r in query(spark, SF_SMALL).collect()) == before
