"""Distributed statistics helpers that stay bounded at any scale.

* ``exact_quantiles`` -- exact (pandas-style, linearly interpolated) quantiles
  of whole columns without gathering the column in one task: a count/min/max
  pass, then histogram refinement passes (map-side combined ``groupBy`` over
  ``buckets`` bins) until the bin holding the wanted rank is small enough to
  fetch, or holds a single value.  Only scalar aggregates and at most
  ``max_fetch`` values per wanted rank ever reach the driver.
* ``bucketed_prefix_sums`` -- running sums over a global order, computed as
  (sum of earlier buckets) + (running sum inside the bucket) so that no window
  ever spans the whole table.
* small scalar helpers (normal / KS tails) used on aggregated results.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from turnstile.session import materialize


def _targets_for(n: int, q: float):
    pos = q * (n - 1)
    lo = math.floor(pos)
    hi = math.ceil(pos)
    return lo, hi, pos - lo


def exact_quantiles(df: DataFrame, cols: list[str], q: float = 0.5, buckets: int = 1024,
                    max_fetch: int = 2_000,
                    rank: int | None = None) -> dict[str, float | None]:
    """Exact quantile ``q`` of each column, linearly interpolated.

    NULL and NaN are missing values.  Infinities are values at the ends of the order; between an infinite and a
    finite neighbour the quantile is the infinite one, between the two infinities NaN.  No values: None.  With ``rank`` the exact k-th smallest
    value (0-based) is returned instead."""
    if not cols:
        return {}

    def value(c):  # missing unless a number
        x = F.col(c).cast("double")
        return F.when(~F.isnan(x), x)

    def finite(c):
        return F.when(F.abs(value(c)) != F.lit(math.inf), value(c))

    aggs = []
    for i, c in enumerate(cols):
        aggs += [F.count(finite(c)).alias(f"n{i}"), F.min(finite(c)).alias(f"lo{i}"), F.max(finite(c)).alias(f"hi{i}"),
                 F.count_if(value(c) == F.lit(-math.inf)).alias(f"below{i}"), F.count_if(value(c) == F.lit(math.inf)).alias(f"above{i}")]
    row = df.agg(*aggs).first()
    # one target per (column, rank); state: [col, rank, lo, hi, below, count_in_range, value]
    targets = []
    meta = {}
    for i, c in enumerate(cols):
        n, lo, hi, below = row[f"n{i}"], row[f"lo{i}"], row[f"hi{i}"], row[f"below{i}"]
        total = n + below + row[f"above{i}"]
        if not total or (rank is not None and rank >= total):
            meta[c] = None
            continue
        klo, khi, frac = (rank, rank, 0.0) if rank is not None else _targets_for(total, q)
        meta[c] = (klo, khi, frac)
        for k in sorted({klo, khi}):
            if k < below or k >= below + n:
                val = -math.inf if k < below else math.inf
            else:
                val = lo if lo == hi else None
            targets.append({"col": c, "k": k, "lo": lo, "hi": hi, "below": below, "cnt": n, "val": val})
    while True:  # each pass narrows every open range to one bin of it, or ends it
        open_t = [t for t in targets if t["val"] is None]
        if not open_t:
            break
        for t in open_t:
            t["width"] = t["hi"] / buckets - t["lo"] / buckets
        # a range too narrow to be cut has few different numbers in it
        small = [t for t in open_t if t["cnt"] <= max_fetch or not t["lo"] + t["width"] > t["lo"]]
        if small:
            # one pass fetches the (bounded) different in-range values of every small target
            items = [F.when(finite(t["col"]).between(t["lo"], t["hi"]), F.struct(F.lit(j).alias("t"), finite(t["col"]).alias("v")))
                     for j, t in enumerate(small)]
            rows = (df.select(F.explode(F.array(*items)).alias("s")).where(F.col("s").isNotNull())
                    .groupBy("s.t", "s.v").count().collect())
            per: dict[int, list] = {}
            for r in rows:
                per.setdefault(r[0], []).append((r[1], r[2]))
            for j, t in enumerate(small):
                left = t["k"] - t["below"]
                for v, n in sorted(per[j]):
                    if left < n:
                        t["val"] = v
                        break
                    left -= n
        big = [t for t in open_t if t["val"] is None]
        if not big:
            break
        # one histogram pass for all unresolved targets
        items = []
        for j, t in enumerate(big):
            x, width = finite(t["col"]), t["width"]
            b = F.least(F.floor(x / F.lit(width) - F.lit(t["lo"] / width)), F.lit(buckets - 1)).cast("int")
            items.append(F.when(x.between(t["lo"], t["hi"]), F.struct(F.lit(j).alias("t"), b.alias("b"), x.alias("v"))))
        hist = (df.select(F.explode(F.array(*items)).alias("s")).where(F.col("s").isNotNull())
                .groupBy(F.col("s.t").alias("t"), F.col("s.b").alias("b"))
                .agg(F.count(F.lit(1)).alias("c"), F.min("s.v").alias("mn"), F.max("s.v").alias("mx")))
        # keep only the bin holding each wanted rank (<= buckets rows per target in the window)
        want = F.element_at(F.array(*[F.lit(t["k"] - t["below"]) for t in big]), F.col("t") + 1)
        wb = Window.partitionBy("t").orderBy("b")
        cum = F.sum("c").over(wb.rowsBetween(Window.unboundedPreceding, 0))
        hit = (hist.select("*", (cum - F.col("c")).alias("before"), cum.alias("upto"))
               .where((F.col("before") <= want) & (want < F.col("upto"))).collect())
        for r in hit:
            t = big[r["t"]]
            if (r["mn"], r["mx"]) == (t["lo"], t["hi"]) and r["mn"] != r["mx"]:
                raise ArithmeticError(f"bins of {t['width']} don't part the values of {t['col']}")  # can't be: lo and hi differ by more than a bin
            t.update(lo=r["mn"], hi=r["mx"], below=t["below"] + r["before"], cnt=r["c"])
            if r["mn"] == r["mx"]:
                t["val"] = r["mn"]
    out: dict[str, float | None] = {}
    for c in cols:
        if meta[c] is None:
            out[c] = None
            continue
        klo, khi, frac = meta[c]
        vlo = next(t["val"] for t in targets if t["col"] == c and t["k"] == klo)
        vhi = next(t["val"] for t in targets if t["col"] == c and t["k"] == khi)
        if not frac or vlo == vhi:
            out[c] = vlo
        elif math.isinf(vlo) or math.isinf(vhi):
            out[c] = vlo + vhi
        else:
            out[c] = vlo + (vhi - vlo) * frac if math.isfinite(vhi - vlo) else vlo * (1 - frac) + vhi * frac
    return out


def exact_median(df: DataFrame, cols: list[str]) -> dict[str, float | None]:
    return exact_quantiles(df, cols, 0.5)


def value_at_rank(df: DataFrame, col: str, k: int, n: int) -> float | None:
    """The k-th smallest (0-based) non-NULL value of ``col`` given its count ``n``."""
    if n <= 0 or k < 0 or k >= n:
        return None
    return exact_quantiles(df, [col], rank=k)[col]


def bucketed_prefix_sums(df: DataFrame, part_cols: list[str], order_col: str, sum_cols: list[str],
                         n_buckets: int | None = None, descending: bool = False,
                         inclusive: bool = True, bucket_rows: int = 500_000) -> DataFrame:
    """Running sums of ``sum_cols`` per ``part_cols`` in ``order_col`` order (ties summed together
    when the caller pre-aggregates to distinct order values).

    The buckets are range partitions of (``part_cols``, ``order_col``), as many as the row count asks
    for, written once; the running sum is the total of all earlier buckets (a table with one row
    a bucket) plus a window inside the bucket.  No window spans a whole partition key, so one
    hot key does not serialise into one task, and no bucket grows with the data.
    """
    sign = -1.0 if descending else 1.0
    if n_buckets is None:
        n_buckets = max(16, -(-df.count() // bucket_rows))
    o = (F.col(order_col).cast("double") * F.lit(sign)).alias("_o")
    rows = materialize(df.select("*", o).repartitionByRange(n_buckets, *part_cols, "_o")
                         .withColumn("_bucket", F.spark_partition_id()), "prefix-buckets")
    totals = rows.groupBy(*part_cols, "_bucket").agg(*[F.sum(c).alias(f"_t_{c}") for c in sum_cols])
    wb = Window.partitionBy(*part_cols).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(*part_cols, "_bucket",
                            *[F.coalesce(F.sum(f"_t_{c}").over(wb), F.lit(0)).alias(f"_off_{c}") for c in sum_cols])
    j = rows.join(offsets, part_cols + ["_bucket"], "inner")
    wi = Window.partitionBy(*part_cols, "_bucket").orderBy("_o")
    frame = wi.rowsBetween(Window.unboundedPreceding, 0 if inclusive else -1)
    return j.select(
        *df.columns,
        *[(F.col(f"_off_{c}") + F.coalesce(F.sum(c).over(frame), F.lit(0))).alias(f"cum_{c}") for c in sum_cols],
    )


# ----------------------------------------------------------- scalar helpers
def normal_sf(z: float) -> float:
    return 0.5 * math.erfc(z / math.sqrt(2.0))


def ks_pvalue(d: float, n1: int, n2: int) -> float:
    """Asymptotic two-sample Kolmogorov-Smirnov p-value (Kolmogorov series)."""
    if n1 == 0 or n2 == 0:
        return float("nan")
    en = math.sqrt(n1 * n2 / (n1 + n2))
    lam = (en + 0.12 + 0.11 / en) * d
    if lam < 1e-3:
        return 1.0
    s = 0.0
    for j in range(1, 101):
        term = 2 * (-1) ** (j - 1) * math.exp(-2 * j * j * lam * lam)
        s += term
        if abs(term) < 1e-12:
            break
    return max(0.0, min(1.0, s))


def ks_pvalue_col(d: Column, n1: Column, n2: Column, terms: int = 60) -> Column:
    """Same Kolmogorov series as a Column expression (for per-feature rows)."""
    en = F.sqrt(n1 * n2 / (n1 + n2))
    lam = (en + F.lit(0.12) + F.lit(0.11) / en) * d
    s = None
    for j in range(1, terms + 1):
        term = F.lit(2.0 * (-1) ** (j - 1)) * F.exp(F.lit(-2.0 * j * j) * lam * lam)
        s = term if s is None else s + term
    return F.when(lam < 1e-3, F.lit(1.0)).otherwise(F.least(F.lit(1.0), F.greatest(F.lit(0.0), s)))
