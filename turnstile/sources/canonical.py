"""Canonical device-fleet views derived from the driver tables.

The driver ships TPC-H-like tables plus an ``events`` stream; the fleet model
needs ``telemetry`` (device-day readings), ``error_logs``, ``devices``,
``maintenance`` and ``requests``.  Each view is a pure DataFrame derivation so
its size grows with the source tables:

* ``telemetry``   -- events grouped by (user_id, day)
* ``error_logs``  -- one error row per event
* ``devices``     -- customers (joined with nation) that report events
* ``maintenance`` -- orders of customers that report events
* ``requests``    -- events seen as scoring requests

Dirty variants plant NULLs, out-of-range values, duplicate deliveries and
badly formatted text by deterministic key arithmetic, so the cleaning
operators have something to clean at every scale.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from turnstile.functions.exprs import FIRMWARE_VERSIONS, GATE_TYPES
from turnstile.sources.tables import read_table


def _by_mod(key, values):
    k = F.pmod(key, F.lit(len(values)))
    expr = None
    for i, v in enumerate(values):
        expr = F.when(k == i, F.lit(v)) if expr is None else expr.when(k == i, F.lit(v))
    return expr


def telemetry(events: DataFrame) -> DataFrame:
    """One row per (device_id, date): daily readings derived from events."""
    is_err = F.col("event_type") == "error"
    g = events.groupBy(F.col("user_id").alias("device_id"), F.to_date("ts").alias("date")).agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(is_err).alias("n_err"),
        F.count_if(F.col("event_type") == "signup").alias("n_signup"),
        F.avg("value").alias("avg_v"),
        F.max("value").alias("max_v"),
        F.min("value").alias("min_v"),
    )
    err = F.col("n_err")
    return g.select(
        "device_id",
        "date",
        F.col("n").cast("int").alias("daily_taps"),
        (F.lit(1.0) - err / F.col("n")).alias("tap_success_rate"),
        F.least(F.lit(100.0), F.col("avg_v")).alias("signal_strength_dbm"),
        (F.lit(20.0) + F.col("avg_v") / 5).alias("temperature_c"),
        F.col("max_v").alias("response_time_ms"),
        F.col("min_v").alias("network_latency_ms"),
        (F.lit(5.0) - F.lit(0.1) * err).alias("power_voltage"),
        F.least(F.lit(100.0), F.col("max_v") / 5).alias("memory_usage_pct"),
        F.least(F.lit(100.0), F.col("avg_v")).alias("cpu_usage_pct"),
        err.cast("int").alias("error_count"),
        F.col("n_signup").cast("int").alias("reboot_count"),
        (F.lit(24.0) - err).alias("uptime_hours"),
        F.when(err >= 2, 1).otherwise(0).alias("failure_today"),
    )


def error_logs(events: DataFrame) -> DataFrame:
    """One error-log row per event; ``event_id`` is the stable tie-break key."""
    v = F.col("value")
    return events.select(
        F.col("user_id").alias("device_id"),
        F.col("ts").alias("timestamp"),
        "event_id",
        F.upper("event_type").alias("error_code"),
        F.when(v < 15, "LOW").when(v < 35, "MEDIUM").when(v < 70, "HIGH").otherwise("CRITICAL").alias("severity"),
        F.when(F.pmod("event_id", F.lit(7)) != 0, 1).otherwise(0).alias("resolved"),
        F.when(F.pmod("event_id", F.lit(9)) == 0, F.lit(None).cast("double")).otherwise(v).alias("resolution_time_min"),
    )


def active_devices(events: DataFrame) -> DataFrame:
    return events.select(F.col("user_id").alias("device_id")).distinct()


def devices(customer: DataFrame, nation: DataFrame, events: DataFrame) -> DataFrame:
    """Device registry: customers that report events, with nation as station."""
    act = active_devices(events)
    cust = customer.join(act, customer.c_custkey == act.device_id, "left_semi")
    # nation is a fixed 25-row dimension: broadcast is bounded by construction
    j = cust.join(F.broadcast(nation), cust.c_nationkey == nation.n_nationkey, "left")
    age = F.pmod(F.col("c_custkey") * 37, F.lit(1800)).cast("int")
    return j.select(
        F.col("c_custkey").alias("device_id"),
        F.col("n_name").alias("station"),
        _by_mod(F.col("c_custkey"), GATE_TYPES).alias("gate_type"),
        F.col("c_mktsegment").alias("manufacturer"),
        _by_mod(F.col("c_custkey"), FIRMWARE_VERSIONS).alias("firmware_version"),
        F.date_sub(F.lit("2024-01-01").cast("date"), age).alias("install_date"),
        age.alias("age_days"),
        F.greatest(F.lit(0), F.lit(730) - age).alias("warranty_remaining_days"),
        F.when(F.pmod("c_custkey", F.lit(10)) == 0, 1).otherwise(0).alias("failure_prone"),
    )


def maintenance(orders: DataFrame, events: DataFrame) -> DataFrame:
    """Maintenance records: orders of active devices."""
    act = active_devices(events)
    o = orders.join(act, orders.o_custkey == act.device_id, "left_semi")
    pri = F.substring("o_orderpriority", 1, 1)
    mtype = (F.when(pri == "1", "Emergency").when(pri.isin("2", "3"), "Corrective")
             .when(pri == "4", "Preventive").otherwise("Firmware_Update"))
    target = F.when(mtype == "Emergency", 4).when(mtype == "Corrective", 8).otherwise(24)
    actual = F.pmod("o_orderkey", F.lit(30)).cast("double")
    return o.select(
        F.col("o_custkey").alias("device_id"),
        F.to_date("o_orderdate").alias("date"),
        mtype.alias("maintenance_type"),
        F.col("o_orderstatus").alias("issue_description"),
        target.alias("sla_target_hours"),
        actual.alias("actual_resolution_hours"),
        F.when(actual <= target, 1).otherwise(0).alias("sla_met"),
        (F.col("o_totalprice") / 100).alias("cost_gbp"),
        F.concat(F.lit("T"), F.pmod("o_orderkey", F.lit(20)).cast("string")).alias("technician_id"),
        F.pmod("o_orderkey", F.lit(2)).cast("int").alias("parts_replaced"),
        F.col("o_orderkey").alias("maintenance_id"),
    )


def requests(events: DataFrame) -> DataFrame:
    """Scoring-request log: name, duration and success per event."""
    return events.select(
        "event_id",
        F.col("ts").cast("timestamp").alias("ts"),
        F.col("user_id").alias("device_id"),
        F.col("event_type").alias("name"),
        F.col("value").alias("duration_ms"),
        (F.col("event_type") != "error").alias("success"),
    )


# ---------------------------------------------------------------------------
# dirty variants (bronze-like inputs for the silver cleaning operators)
# ---------------------------------------------------------------------------

def dirty_telemetry(events: DataFrame) -> DataFrame:
    """Telemetry as delivered: NULLs, out-of-range readings, re-deliveries.

    * key ``k = device_id*31 + day_of_month``
    * ``k % 11 == 0``  -> signal NULL; ``k % 13 == 0`` -> temperature 150 (out of range)
    * ``k % 17 == 0``  -> response_time NULL; ``k % 19 == 0`` -> uptime -5
    * ``k % 5 == 0``   -> delivered twice; the later delivery (``_ingested_at`` + 1h)
      carries corrected cpu_usage_pct (+1)
    """
    t = telemetry(events)
    k = F.col("device_id") * 31 + F.dayofmonth("date")
    base_ts = F.to_timestamp(F.concat(F.date_format("date", "yyyy-MM-dd"), F.lit(" 06:00:00")))
    t = t.select(
        "device_id", "date", "daily_taps", "tap_success_rate",
        F.when(F.pmod(k, F.lit(11)) == 0, F.lit(None).cast("double")).otherwise(F.col("signal_strength_dbm")).alias("signal_strength_dbm"),
        F.when(F.pmod(k, F.lit(13)) == 0, F.lit(150.0)).otherwise(F.col("temperature_c")).alias("temperature_c"),
        F.when(F.pmod(k, F.lit(17)) == 0, F.lit(None).cast("double")).otherwise(F.col("response_time_ms")).alias("response_time_ms"),
        "network_latency_ms", "power_voltage", "memory_usage_pct", "cpu_usage_pct",
        "error_count", "reboot_count",
        F.when(F.pmod(k, F.lit(19)) == 0, F.lit(-5.0)).otherwise(F.col("uptime_hours")).alias("uptime_hours"),
        "failure_today",
        base_ts.alias("_ingested_at"),
        F.lit("telemetry.csv").alias("_source_file"),
    )
    again = t.filter(F.pmod(k, F.lit(5)) == 0).select(
        *[c for c in t.columns if c not in ("cpu_usage_pct", "_ingested_at")],
        (F.col("cpu_usage_pct") + 1).alias("cpu_usage_pct"),
        (F.col("_ingested_at") + F.expr("INTERVAL 1 HOUR")).alias("_ingested_at"),
    ).select(*t.columns)
    return t.unionByName(again)


def dirty_error_logs(events: DataFrame) -> DataFrame:
    """Error logs as delivered: padded/lower-case text and unknown severities.

    ``event_id % 10 == 3`` -> severity lower-cased with a leading blank;
    ``event_id % 25 == 7`` -> severity 'UNKNOWN'; ``event_id % 6 == 1`` -> code lower-cased + blank.
    """
    e = error_logs(events)
    eid = F.col("event_id")
    return e.select(
        "device_id", "timestamp", "event_id",
        F.when(F.pmod(eid, F.lit(6)) == 1, F.concat(F.lower("error_code"), F.lit(" "))).otherwise(F.col("error_code")).alias("error_code"),
        F.when(F.pmod(eid, F.lit(25)) == 7, F.lit("UNKNOWN"))
        .when(F.pmod(eid, F.lit(10)) == 3, F.concat(F.lit(" "), F.lower("severity")))
        .otherwise(F.col("severity")).alias("severity"),
        "resolved", "resolution_time_min",
        F.col("timestamp").alias("_ingested_at"),
    )


def dirty_devices(customer: DataFrame, nation: DataFrame, events: DataFrame) -> DataFrame:
    """Device registry as delivered: lower/padded text, out-of-range ages, re-deliveries.

    ``device_id % 3 == 0`` -> gate_type lower-cased with blanks; ``% 4 == 1`` ->
    manufacturer lower-case; ``% 7 == 0`` -> age 5000 (clipped to 3650);
    ``% 5 == 0`` delivered twice, the later copy with station upper-cased.
    """
    d = devices(customer, nation, events)
    did = F.col("device_id")
    d = d.select(
        "device_id",
        "station",
        F.when(F.pmod(did, F.lit(3)) == 0, F.concat(F.lit(" "), F.lower("gate_type"), F.lit(" "))).otherwise(F.col("gate_type")).alias("gate_type"),
        F.when(F.pmod(did, F.lit(4)) == 1, F.lower("manufacturer")).otherwise(F.col("manufacturer")).alias("manufacturer"),
        "firmware_version", "install_date",
        F.when(F.pmod(did, F.lit(7)) == 0, F.lit(5000)).otherwise(F.col("age_days")).alias("age_days"),
        "warranty_remaining_days", "failure_prone",
        F.lit("2024-01-01 00:00:00").cast("timestamp").alias("_ingested_at"),
    )
    again = d.filter(F.pmod(did, F.lit(5)) == 0).withColumn("station", F.upper("station")).withColumn(
        "_ingested_at", F.lit("2024-01-02 00:00:00").cast("timestamp"))
    return d.unionByName(again)


def dirty_maintenance(orders: DataFrame, events: DataFrame) -> DataFrame:
    """Maintenance as delivered: lower-case types and out-of-range cost/hours.

    ``maintenance_id % 4 == 0`` -> type lower-cased with blanks; ``% 9 == 0`` ->
    cost 25000; ``% 10 == 0`` -> actual hours 500.
    """
    m = maintenance(orders, events)
    mid = F.col("maintenance_id")
    return m.select(
        "device_id", "date",
        F.when(F.pmod(mid, F.lit(4)) == 0, F.concat(F.lit(" "), F.lower("maintenance_type"), F.lit(" "))).otherwise(F.col("maintenance_type")).alias("maintenance_type"),
        "issue_description", "sla_target_hours",
        F.when(F.pmod(mid, F.lit(10)) == 0, F.lit(500.0)).otherwise(F.col("actual_resolution_hours")).alias("actual_resolution_hours"),
        "sla_met",
        F.when(F.pmod(mid, F.lit(9)) == 0, F.lit(25000.0)).otherwise(F.col("cost_gbp")).alias("cost_gbp"),
        "technician_id", "parts_replaced", "maintenance_id",
        F.lit("2024-01-01 00:00:00").cast("timestamp").alias("_ingested_at"),
    )


class Fleet:
    """Lazily derived canonical views over one ``sf_dir``.

    Views are lazy plans; building one is memoised per (session, sf_dir) so
    repeated queries do not re-analyse the same plan (no data is cached).
    """

    _cache: dict = {}

    def __new__(cls, spark: SparkSession, sf_dir: str):
        key = (id(spark), sf_dir.rstrip("/"))
        inst = cls._cache.get(key)
        if inst is None or inst.spark is not spark:
            inst = super().__new__(cls)
            inst.spark = spark
            inst.sf_dir = sf_dir
            inst._memo = {}
            cls._cache[key] = inst
        return inst

    def __init__(self, spark: SparkSession, sf_dir: str):
        pass

    def _m(self, name, build):
        df = self._memo.get(name)
        if df is None:
            df = build()
            self._memo[name] = df
        return df

    def table(self, name: str) -> DataFrame:
        return read_table(self.spark, self.sf_dir, name)

    @property
    def events(self) -> DataFrame:
        return self.table("events")

    def telemetry(self) -> DataFrame:
        return self._m("telemetry", lambda: telemetry(self.events))

    def error_logs(self) -> DataFrame:
        return self._m("error_logs", lambda: error_logs(self.events))

    def devices(self) -> DataFrame:
        return self._m("devices", lambda: devices(self.table("customer"), self.table("nation"), self.events))

    def maintenance(self) -> DataFrame:
        return self._m("maintenance", lambda: maintenance(self.table("orders"), self.events))

    def requests(self) -> DataFrame:
        return self._m("requests", lambda: requests(self.events))

    def dirty_telemetry(self) -> DataFrame:
        return self._m("dirty_telemetry", lambda: dirty_telemetry(self.events))

    def dirty_error_logs(self) -> DataFrame:
        return self._m("dirty_error_logs", lambda: dirty_error_logs(self.events))

    def dirty_devices(self) -> DataFrame:
        return self._m("dirty_devices", lambda: dirty_devices(self.table("customer"), self.table("nation"), self.events))

    def silver_telemetry(self) -> DataFrame:
        from turnstile.operators.clean import clean_telemetry
        return self._m("silver_telemetry", lambda: clean_telemetry(self.dirty_telemetry()))

    def silver_devices(self) -> DataFrame:
        from turnstile.operators.clean import clean_devices
        return self._m("silver_devices", lambda: clean_devices(self.dirty_devices()))

    def gold_plan(self) -> DataFrame:
        """The gold feature table as a lazy plan from the raw tables."""
        from turnstile.operators.features import gold_features
        return self._m("gold_plan", lambda: gold_features(self.telemetry(), self.error_logs(), self.maintenance(),
                                                          self.devices()))

    def gold(self) -> DataFrame:
        """The gold table written once to the shared checkpoint folder, for the downstream
        analytics (each reads only the columns it needs)."""
        from turnstile.session import materialize
        return self._m("gold", lambda: materialize(self.gold_plan(), "gold"))

    def dirty_maintenance(self) -> DataFrame:
        return self._m("dirty_maintenance", lambda: dirty_maintenance(self.table("orders"), self.events))
