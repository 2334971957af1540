"""Column expressions shared by the operators (all JVM-side, codegen friendly)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Fixed values that must equal the reference's for identical results.
# ---------------------------------------------------------------------------
VALID_SEVERITIES = ["LOW", "MEDIUM", "HIGH", "CRITICAL"]
# severity rank used by the batch analytics (LOW 0 .. CRITICAL 3)
SEVERITY_RANK = {"LOW": 0, "MEDIUM": 1, "HIGH": 2, "CRITICAL": 3}
# severity rank used by the SQL-model layer (LOW 1 .. CRITICAL 4, anything else 0)
SEVERITY_RANK_SQL = {"LOW": 1, "MEDIUM": 2, "HIGH": 3, "CRITICAL": 4}
HIGH_TRAFFIC_STATIONS = [
    "Kings Cross", "Victoria", "Waterloo", "Oxford Circus",
    "Bank", "Canary Wharf", "Liverpool Street",
]
BETA_FIRMWARE = "v4.0.0-beta"
MAINTENANCE_TYPES = ["Preventive", "Corrective", "Emergency", "Firmware_Update"]
GATE_TYPES = ["Entry", "Exit", "Wide_Entry", "Wide_Exit"]
FIRMWARE_VERSIONS = ["v3.1.0", "v3.2.1", "v3.3.0", "v4.0.0-beta"]
# silver clip ranges (lo, hi); NULL stays NULL
DEVICE_RANGES = {"age_days": (0, 3650), "warranty_remaining_days": (0, 1825)}
TELEMETRY_RANGES = {
    "tap_success_rate": (0.0, 1.0),
    "signal_strength_dbm": (0.0, 100.0),
    "temperature_c": (-10.0, 80.0),
    "response_time_ms": (10.0, 5000.0),
    "network_latency_ms": (1.0, 1000.0),
    "power_voltage": (2.0, 6.0),
    "memory_usage_pct": (0.0, 100.0),
    "cpu_usage_pct": (0.0, 100.0),
    "error_count": (0, 100),
    "reboot_count": (0, 50),
    "uptime_hours": (0.0, 24.0),
}
MAINTENANCE_RANGES = {"cost_gbp": (0.0, 10000.0), "actual_resolution_hours": (0.0, 168.0)}
# gold rolling / delta column lists
ROLLING_COLS = [
    "signal_strength_dbm", "temperature_c", "response_time_ms", "network_latency_ms",
    "error_count", "tap_success_rate", "memory_usage_pct", "cpu_usage_pct",
]
DELTA_COLS = ["signal_strength_dbm", "temperature_c", "error_count", "response_time_ms"]
# failure tier bins (right-closed) and serving cut points (left-closed)
TIER_LABELS = ["LOW", "MEDIUM", "HIGH", "CRITICAL"]
BATCH_TIER_EDGES = [-0.01, 0.2, 0.4, 0.7, 1.01]
SERVING_TIERS = [  # (lower bound inclusive, tier, confidence, action)
    (0.7, "CRITICAL", "HIGH", "EMERGENCY: Immediate replacement needed"),
    (0.4, "HIGH", "HIGH", "Schedule corrective maintenance within 48h"),
    (0.2, "MEDIUM", "MEDIUM", "Monitor closely, plan preventive maintenance"),
    (0.0, "LOW", "HIGH", "No immediate action needed"),
]
# rule-based SLA score tiers: (lower bound inclusive, tier, action)
SLA_RULE_TIERS = [
    (70, "CRITICAL", "EMERGENCY: Schedule immediate replacement"),
    (50, "HIGH", "Schedule maintenance within 48 hours"),
    (30, "MEDIUM", "Plan preventive maintenance within 1 week"),
    (0, "LOW", "Continue standard monitoring"),
]
# root-cause threshold rules, in rule order: (factor, column, op, threshold, impact)
ROOT_CAUSE_RULES = [
    ("Low signal strength", "signal_strength_dbm", "<", 60, "HIGH"),
    ("High temperature", "temperature_c", ">", 50, "HIGH"),
    ("High error count", "error_count", ">=", 5, "HIGH"),
    ("High memory usage", "memory_usage_pct", ">", 80, "MEDIUM"),
    ("High CPU usage", "cpu_usage_pct", ">", 75, "MEDIUM"),
    ("Low tap success rate", "tap_success_rate", "<", 0.85, "HIGH"),
    ("Slow response time", "response_time_ms", ">", 300, "MEDIUM"),
    ("Old device", "age_days", ">", 1000, "MEDIUM"),
    ("Low uptime", "uptime_hours", "<", 20, "MEDIUM"),
]
NO_CAUSE = "No significant risk factors"
IMPACT_RANK = {"HIGH": 0, "MEDIUM": 1, "LOW": 2}


def np_round(c: Column | str, digits: int = 0) -> Column:
    """numpy/pandas rounding: scale, round half to even, unscale.

    Spark's ``round`` is half-up on the decimal representation, ``bround`` is
    half-even on it; numpy rounds the scaled binary value, which is what the
    reference's numbers are.
    """
    c = F.col(c) if isinstance(c, str) else c
    scale = float(10 ** digits)
    return F.rint(c * scale) / scale


def clip_keep_null(c: Column | str, lo, hi) -> Column:
    """``Series.clip(lo, hi)``: NULL stays NULL (plain least/greatest would not)."""
    c = F.col(c) if isinstance(c, str) else c
    return F.when(c.isNull(), F.lit(None)).otherwise(F.least(F.greatest(c, F.lit(lo)), F.lit(hi)))


def title_case(c: Column | str) -> Column:
    """Python ``str.title()`` for Latin text: a letter after anything but a letter is upper-cased, every
    other letter lower-cased (``wide_entry`` -> ``Wide_Entry``, ``b-12a`` -> ``B-12A``, ``o'neil`` -> ``O'Neil``)."""
    c = F.col(c) if isinstance(c, str) else c
    # a mark before each letter that begins a word; the parts between marks are capitalised one by one
    marked = F.regexp_replace(F.lower(c), r"(?<!\p{L})(?=\p{L})", "\u0000")
    return F.array_join(F.transform(F.split(marked, "\u0000"), lambda p: F.concat(F.upper(F.substring(p, 1, 1)), F.substring(p, 2, 2147483647))), "")


#: White space that Python's strip() takes off, beyond the blank.
_SPACE = r"[\s\x1c-\x1f\u0085\u00a0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]+"


def strip(c: Column | str) -> Column:
    """Python ``str.strip()``."""
    c = F.col(c) if isinstance(c, str) else c
    return F.regexp_replace(c, f"^{_SPACE}|{_SPACE}$", "")


def std_title(c: Column | str) -> Column:
    return title_case(strip(c))


def std_upper(c: Column | str) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return strip(F.upper(c))


def severity_rank(c: Column | str, sql_model: bool = False) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    ranks = SEVERITY_RANK_SQL if sql_model else SEVERITY_RANK
    expr = None
    for name, r in ranks.items():
        expr = (F.when(c == name, F.lit(r)) if expr is None else expr.when(c == name, F.lit(r)))
    return expr.otherwise(F.lit(0 if sql_model else None))


def health_score(rounded: bool = True, clip_inputs: bool = False) -> Column:
    """Composite 0-100 device health score."""
    sig = F.col("signal_strength_dbm")
    up = F.col("uptime_hours")
    if clip_inputs:
        sig = clip_keep_null(sig, 0, 100)
        up = clip_keep_null(up, 0, 24)
    err = F.least(F.greatest(F.col("error_count"), F.lit(0)), F.lit(10))
    score = (
        F.col("tap_success_rate") * 30
        + (sig / 100) * 20
        + (1 - F.col("memory_usage_pct") / 100) * 15
        + (1 - F.col("cpu_usage_pct") / 100) * 15
        + (up / 24) * 10
        + (1 - err / 10) * 10
    )
    return np_round(score, 2) if rounded else score


def failure_tier_batch(p: Column | str) -> Column:
    """Right-closed bins (-.01,.2],(.2,.4],(.4,.7],(.7,1.01]; outside -> NULL."""
    p = F.col(p) if isinstance(p, str) else p
    e = BATCH_TIER_EDGES
    return (
        F.when((p > e[0]) & (p <= e[1]), "LOW")
        .when((p > e[1]) & (p <= e[2]), "MEDIUM")
        .when((p > e[2]) & (p <= e[3]), "HIGH")
        .when((p > e[3]) & (p <= e[4]), "CRITICAL")
    )


def failure_tier_serving(p: Column | str) -> Column:
    """Left-closed serving tier -> struct(tier, confidence, action)."""
    p = F.col(p) if isinstance(p, str) else p
    expr = None
    for lo, tier, conf, action in SERVING_TIERS:
        val = F.struct(F.lit(tier).alias("tier"), F.lit(conf).alias("confidence"),
                       F.lit(action).alias("action"))
        expr = F.when(p >= lo, val) if expr is None else expr.when(p >= lo, val)
    low = SERVING_TIERS[-1]
    return expr.otherwise(F.struct(F.lit(low[1]).alias("tier"), F.lit(low[2]).alias("confidence"),
                                   F.lit(low[3]).alias("action")))


def safe_div(num: Column, den: Column) -> Column:
    """Division that yields NULL on a zero denominator (ANSI-safe)."""
    return F.try_divide(num, den)


def as_int_flag(cond: Column) -> Column:
    return F.when(cond, F.lit(1)).otherwise(F.lit(0))
