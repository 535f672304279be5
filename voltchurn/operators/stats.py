"""Statistical operators over DataFrames.

All of them aggregate before they order: curves and distribution distances
first collapse rows to one row per distinct value (partial aggregation does
this map-side), then run cumulative sums over the distinct values.  Running
sums use ``prefix_sums``, which cuts the ordered values into balanced ranges, so
no single task holds a whole feature or score column.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from voltchurn.operators.frames import broadcast_if_small, cut_lineage, written
from voltchurn.session import scratch_path


# ---------------------------------------------------------------- basics ----

def quantile(col, p) -> Column:
    """Exact linear-interpolated quantile(s) as an aggregate.

    Spark keeps one value -> count map per group in a task; over rows use
    ``grouped_quantiles``, which splits a group.
    """
    return F.percentile(F.col(col) if isinstance(col, str) else col, p)


def grouped_quantiles(df: DataFrame, groups: Sequence[str], value_exprs: dict[str, Column], probs: Sequence[float],
                      kept: bool = False) -> DataFrame:
    """Exact linear-interpolated quantiles ``probs`` of each expression per group, as arrays; NULLs skipped.

    The values are written down once, unless ``kept`` says that ``df`` is read from
    a written table anyway.  Counts per coarse bin (``_value_bin``, combined
    map-side) tell which bins hold the ranks around (n - 1) * p; only the values
    of these bins are then counted one by one, with running counts by
    ``prefix_sums``.  No task holds a group, and any values give exact results: if
    all lie in one bin, all are counted.  Rows with a NULL group column are left
    out, as are groups without values; without ``groups`` there is one row, of
    NULLs if there are no values.
    """
    g = list(groups)
    names = list(value_exprs)
    known = df.filter(F.expr(" AND ".join(f"`{c}` IS NOT NULL" for c in g))) if g else df
    wide = known.select(*g, *[e.cast("double").alias(f"_v{i}") for i, e in enumerate(value_exprs.values())])
    wide = wide if kept else written(wide, "values")
    columns = [F.col(f"_v{i}") for i in range(len(names))]
    # plain numbers are exploded, each with the place of its expression: no struct and no name per value
    key = [*g, "_of"]
    placed = wide.select(*g, F.posexplode(F.array(*[F.when(v.isNotNull(), _value_bin(v)) for v in columns])).alias("_of", "_bin")) \
        .filter(F.col("_bin").isNotNull())
    values = wide.select(*g, F.posexplode(F.array(*columns)).alias("_of", "value")).filter(F.col("value").isNotNull()) \
        .withColumn("_bin", _value_bin(F.col("value")))
    # a group has at most some 190,000 bins, however many values
    w = Window.partitionBy(*key)
    upto = w.orderBy("_bin").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    bins = placed.groupBy(*key, "_bin").agg(F.count(F.lit(1)).alias("_n")).withColumns(
        {"_upto": F.sum("_n").over(upto), "_size": F.sum("_n").over(w)}).withColumn("_before", F.col("_upto") - F.col("_n"))
    rank = {k: (F.col("_size") - 1) * F.lit(float(p)) for k, p in enumerate(probs)}
    holds = F.lit(False)
    for r in rank.values():
        for end in (F.floor(r), F.ceil(r)):
            holds = holds | ((F.col("_before") <= end) & (end < F.col("_upto")))
    asked = cut_lineage(bins.filter(holds).select(*key, "_bin", "_before", "_size"))
    counts = values.join(broadcast_if_small(asked.select(*key, "_bin")), [*key, "_bin"], "left_semi") \
        .groupBy(*key, "_bin", "value").agg(F.count(F.lit(1)).alias("n"))
    cum = prefix_sums(counts, [*key, "_bin"], "value", ["n"]).join(asked, [*key, "_bin"])
    at = lambda r: F.min(F.when(F.col("_before") + F.col("n_cum") > r, F.col("value")))
    ends = [x for k, r in rank.items() for x in (at(F.floor(r)).alias(f"_lo{k}"), at(F.ceil(r)).alias(f"_hi{k}"))]
    found = cum.groupBy(*key).agg(F.any_value("_size").alias("_size"), *ends)
    result = F.array(*[F.col(f"_lo{k}") + (F.col(f"_hi{k}") - F.col(f"_lo{k}")) * (r - F.floor(r)) for k, r in rank.items()])
    return found.groupBy(*g).agg(*[F.max(F.when(F.col("_of") == i, result)).alias(n) for i, n in enumerate(names)])


#: bins of ``_value_bin`` per e-fold of a value
BINS_PER_EFOLD = 64


def _value_bin(v: Column) -> Column:
    """A whole number that never falls as ``v`` grows: sign and logarithm, 1.6 % of a value wide; infinities and NaN apart."""
    place = lambda x: F.floor(F.ln(x) * BINS_PER_EFOLD) + 800 * BINS_PER_EFOLD
    top = 2000 * BINS_PER_EFOLD
    return F.when(F.isnan(v), F.lit(top + 1)).when(v == float("inf"), F.lit(top)).when(v == float("-inf"), F.lit(-top)) \
        .when(v > 0, place(v)).when(v < 0, -place(-v)).otherwise(F.lit(0)).cast("int")


def grouped_quantile(df: DataFrame, groups: Sequence[str], value_exprs: dict[str, Column], p: float, kept: bool = False) -> DataFrame:
    """One quantile ``p`` of each expression per group: ``grouped_quantiles`` as plain columns."""
    out = grouped_quantiles(df, groups, value_exprs, [p], kept)
    return out.select(*groups, *[F.col(n)[0].alias(n) for n in value_exprs])


def with_group_quantiles(agg: DataFrame, df: DataFrame, groups: Sequence[str], value_exprs: dict[str, Column],
                         probs: Sequence[float]) -> DataFrame:
    """``agg`` (one row per group) with the quantile arrays of ``df``'s groups; NULL for a group without values."""
    q = grouped_quantiles(df, groups, value_exprs, probs)
    return agg.join(q, list(groups), "left") if groups else attach_scalar(agg, q)


def total_of(df: DataFrame, name: str = "_total", expr: Column | None = None) -> DataFrame:
    """One-row table holding ``expr`` (default: row count) -- for broadcast joins."""
    return df.agg((expr if expr is not None else F.count(F.lit(1))).alias(name))


def attach_scalar(df: DataFrame, scalar_df: DataFrame) -> DataFrame:
    """Attach a one-row table's columns to every row.

    Uses a scalar subquery (evaluated once, its value inlined into the
    projection): no join, no cross product, nothing grows with ``df``.
    """
    cols = scalar_df.columns
    sub = scalar_df.select(F.struct(*[F.col(f"`{c}`") for c in cols]).alias("_s")).scalar()
    return df.withColumns({c: sub.getField(c) for c in cols})


def value_counts(df: DataFrame, col: str, normalize: bool = False, dropna: bool = True,
                 count_name: str = "count", share_name: str = "share") -> DataFrame:
    """Counts per value (NULL kept as its own value unless ``dropna``), with share."""
    src = df.filter(F.col(col).isNotNull()) if dropna else df
    out = src.groupBy(col).agg(F.count(F.lit(1)).alias(count_name))
    if normalize:
        out = cut_lineage(out)                    # one row per value: ``df`` is not read again for the total
        tot = total_of(out, "_total", F.sum(count_name))
        out = attach_scalar(out, tot).withColumn(share_name, F.col(count_name) / F.col("_total")).drop("_total")
    return out


def describe(df: DataFrame, value: str, by: Sequence[str] = (),
             percentiles: Sequence[float] = (0.25, 0.5, 0.75), prefix: str = "") -> DataFrame:
    """Count, mean, sample std, min, exact percentiles, max (per group).

    Percentiles interpolate linearly, like pandas ``describe``.  NULLs are
    skipped; groups with a NULL key are dropped (pandas drops them too).
    """
    v = F.col(value)
    src = df
    for b in by:
        src = src.filter(F.col(b).isNotNull())
    aggs = [F.count(v).alias(f"{prefix}count"), F.avg(v).alias(f"{prefix}mean"),
            F.stddev_samp(v).alias(f"{prefix}std"), F.min(v).alias(f"{prefix}min")]
    aggs.append(F.max(v).alias(f"{prefix}max"))
    out = src.groupBy(*by).agg(*aggs)
    if percentiles:
        out = with_group_quantiles(out, src, by, {"_pct": v}, percentiles)
        names = {p: f"{prefix}p{int(round(p * 100)):02d}" for p in percentiles}
        out = out.withColumns({names[p]: F.col("_pct")[i] for i, p in enumerate(percentiles)}).drop("_pct")
        out = out.select(*[c for c in out.columns if c != f"{prefix}max"], f"{prefix}max")
    return out


def rate_by(df: DataFrame, dims: Sequence[str], label: str = "churn", extra: dict | None = None,
            min_group: int = 0, pct: bool = False, count_name: str = "customers",
            rate_name: str = "churn_rate", medians: dict[str, str] | None = None) -> DataFrame:
    """Customers and label rate per group, plus named extra aggregates
    and ``medians`` (name -> column; by ``grouped_quantiles``).

    ``pct`` gives the rate x 100 rounded half-even to 2 places; ``min_group``
    keeps groups with at least that many rows (P15, a HAVING filter).
    """
    src = df
    for d in dims:
        src = src.filter(F.col(d).isNotNull())
    rate = F.avg(F.col(label).cast("double"))
    if pct:
        rate = F.bround(rate * 100, 2)
    aggs = [F.count(F.lit(1)).alias(count_name), rate.alias(rate_name)]
    aggs += [e.alias(n) for n, e in (extra or {}).items()]
    out = src.groupBy(*dims).agg(*aggs)
    if min_group:
        out = out.filter(F.col(count_name) >= min_group)
    if medians:
        out = with_group_quantiles(out, src, dims, {n: F.col(c) for n, c in medians.items()}, [0.5])
        out = out.withColumns({n: F.col(n)[0] for n in medians})
    return out


def crosstab(df: DataFrame, a: str, b: str, margins: bool = True, all_label: str = "All") -> DataFrame:
    """Long-form contingency counts ``(a, b, n)`` with ``All`` margins (CUBE)."""
    src = df.filter(F.col(a).isNotNull() & F.col(b).isNotNull()).select(
        F.col(a).cast("string").alias(a), F.col(b).cast("string").alias(b))
    if not margins:
        return src.groupBy(a, b).agg(F.count(F.lit(1)).alias("n"))
    out = src.cube(a, b).agg(F.count(F.lit(1)).alias("n"), F.grouping_id().alias("_g"))
    return out.select(
        F.when(F.col("_g").bitwiseAND(2) > 0, F.lit(all_label)).otherwise(F.col(a)).alias(a),
        F.when(F.col("_g").bitwiseAND(1) > 0, F.lit(all_label)).otherwise(F.col(b)).alias(b),
        "n")


def upper_gamma(s: Column, y: Column, terms: int = 400) -> Column:
    """Regularised upper incomplete gamma Q(s, y) for whole and half s > 0, as a column.

    Below y = s + 1 one minus the power series, above it the continued fraction
    taken from its far end; ln Gamma(s) from the recurrence down to 1/2 or 1.
    """
    ks = F.transform(F.sequence(F.lit(1), F.lit(terms)), lambda k: k.cast("double"))
    whole = s == F.floor(s)
    steps = F.floor(s - F.when(whole, 1.0).otherwise(0.5)).cast("int")
    factors = F.when(steps > 0, F.transform(F.sequence(F.lit(1), F.greatest(steps, F.lit(1))), lambda k: s - k)).otherwise(F.array().cast("array<double>"))
    log_gamma = F.aggregate(factors, F.when(whole, 0.0).otherwise(math.lgamma(0.5)), lambda acc, f: acc + F.ln(f))
    front = F.exp(s * F.ln(y) - y - log_gamma)
    start = F.struct((1.0 / s).alias("term"), (1.0 / s).alias("total"))
    series = F.aggregate(ks, start, lambda acc, k: F.struct((acc["term"] * y / (s + k)).alias("term"),
                                                            (acc["total"] + acc["term"] * y / (s + k)).alias("total")))["total"]
    fraction = F.aggregate(F.reverse(ks), y + 2 * terms + 1 - s, lambda acc, k: y + 2 * k - 1 - s - k * (k - s) / acc)
    q = F.when(y < s + 1, 1.0 - front * series).otherwise(front / fraction)
    return F.when(y <= 0, F.lit(1.0)).otherwise(F.least(F.greatest(q, F.lit(0.0)), F.lit(1.0)))


def chi2_sf(stat: Column, dof: Column) -> Column:
    """Survival function of the chi-square law (NULL where dof < 1)."""
    return F.when(dof > 0, upper_gamma(dof / 2.0, stat / 2.0))


def expected_counts(df: DataFrame, a: str, b: str) -> DataFrame:
    """Observed and expected count of every pair of observed levels (independence).

    The table is as large as its levels allow; ``b``'s levels reach each of
    ``a``'s as one array.
    """
    cells = cut_lineage(crosstab(df, a, b, margins=False))   # read several times below
    rows = cells.groupBy(a).agg(F.sum("n").alias("_r"))
    cols = cells.groupBy(b).agg(F.sum("n").alias("_c")).agg(F.collect_list(F.struct(b, "_c")).alias("_cols"), F.sum("_c").alias("_n"))
    pairs = attach_scalar(rows, cols).select(a, "_r", "_n", F.explode("_cols").alias("_x")).select(a, "_r", "_n", "_x.*")
    return pairs.join(cells, [a, b], "left").select(
        a, b, F.coalesce("n", F.lit(0)).alias("observed"), (F.col("_r") * F.col("_c") / F.col("_n")).alias("expected"))


def chi_square(df: DataFrame, a: str, b: str, correction: bool = True) -> DataFrame:
    """Chi-square test of independence of two categorical columns.

    Expected count of a cell = row total x column total / N over the observed
    levels.  Without enumerating the (mostly empty) level pairs:
    sum (o - e)^2 / e = sum over observed cells of o^2 / e - N.  With one
    degree of freedom (a 2 x 2 table) the Yates correction applies; there
    |o - e| is the same delta in every cell, so the statistic is
    (delta - min(0.5, delta))^2 * N * (sum 1/r) * (sum 1/c).
    Output: one row ``statistic, dof, n, p_value`` (of the chi-square law).
    """
    cells = cut_lineage(crosstab(df, a, b, margins=False))   # read several times below
    rows = cells.groupBy(a).agg(F.sum("n").cast("double").alias("_r"))
    cols = cells.groupBy(b).agg(F.sum("n").cast("double").alias("_c"))
    rstat = rows.agg(F.count(F.lit(1)).alias("_nr"), F.sum(1.0 / F.col("_r")).alias("_inv_r"),
                     F.sum("_r").alias("_N"))
    cstat = cols.agg(F.count(F.lit(1)).alias("_nc"), F.sum(1.0 / F.col("_c")).alias("_inv_c"))
    obs = attach_scalar(attach_scalar(cells.join(rows, a).join(cols, b), rstat), cstat)
    e = F.col("_r") * F.col("_c") / F.col("_N")
    one = obs.agg(F.sum(F.col("n") * F.col("n") / e).alias("_s"), F.first(F.abs(F.col("n") - e)).alias("_d"),
                  F.first("_N").alias("_N"), F.first("_nr").alias("_nr"), F.first("_nc").alias("_nc"),
                  F.first("_inv_r").alias("_inv_r"), F.first("_inv_c").alias("_inv_c"))
    dof = (F.col("_nr") - 1) * (F.col("_nc") - 1)
    plain = F.col("_s") - F.col("_N")
    stat = plain
    if correction:
        adj = F.col("_d") - F.least(F.lit(0.5), F.col("_d"))
        stat = F.when(dof == 1, adj * adj * F.col("_N") * F.col("_inv_r") * F.col("_inv_c")).otherwise(plain)
    out = one.select(stat.alias("statistic"), dof.cast("long").alias("dof"), F.col("_N").cast("long").alias("n"))
    return out.withColumn("p_value", chi2_sf(F.col("statistic"), F.col("dof")))


def corr_with(df: DataFrame, target: str, columns: Sequence[str] | None = None) -> DataFrame:
    """Pearson correlation of each numeric column with ``target`` (pairwise complete)."""
    num = {"double", "float", "int", "bigint", "smallint", "tinyint"}
    cols = [c for c in (columns or [f.name for f in df.schema.fields
                                    if f.dataType.simpleString() in num]) if c != target]
    def r(c):
        x, y = F.col(c).cast("double"), F.col(target).cast("double")
        both = x.isNotNull() & y.isNotNull()
        xs, ys = F.when(both, x), F.when(both, y)
        # zero variance -> NULL (pandas gives NaN), never a division error
        return F.try_divide(F.covar_samp(xs, ys), F.stddev_samp(xs) * F.stddev_samp(ys))

    one = df.agg(*[r(c).alias(c) for c in cols])
    stack = ", ".join(f"'{c}', `{c}`" for c in cols)
    return one.selectExpr(f"stack({len(cols)}, {stack}) AS (feature, corr)")


def with_quantile_bins(df: DataFrame, value: str, q: int = 5, out: str = "bin",
                       approx: bool = False) -> DataFrame:
    """``pandas.qcut(x, q, duplicates="drop", labels=False)`` as a column.

    Edges are exact linear-interpolated quantiles (approximate on request),
    duplicate edges are dropped, bins are right-closed and the first bin
    includes its lower edge.  NULL values get a NULL bin.
    """
    probs = [i / q for i in range(q + 1)]
    v = F.col(value).cast("double")
    found = df.agg(F.percentile_approx(v, probs, 100000).cast("array<double>").alias("_e")) if approx else \
        grouped_quantiles(df, [], {"_e": v}, probs)
    edges = found.select(F.array_distinct(F.array_sort("_e")).alias("_edges"))
    j = attach_scalar(df, edges)
    # bin index = number of inner edges strictly below the value (right-closed bins)
    inner = F.slice(F.col("_edges"), 2, F.greatest(F.size("_edges") - 2, F.lit(0)))
    idx = F.size(F.filter(inner, lambda e: e < v))
    ok = v.isNotNull() & (v >= F.element_at("_edges", 1)) & (v <= F.element_at("_edges", -1))
    return j.withColumn(out, F.when(ok, idx)).drop("_edges")


# ------------------------------------------------------------ prefix sums ----

def with_range_bucket(df: DataFrame, partition: Sequence[str], order: str, buckets: int | None = None) -> DataFrame:
    """``df`` with ``_bk``: balanced ranges of (partition, order), written to the shared folder.

    Spark samples the rows to cut them into ranges of similar size, whatever the
    values: an outlier, or groups of different magnitude, take no more than their
    share.  Other evaluations would sample other cuts, so the rows are written
    with the number of their range and read back.
    """
    spark = df.sparkSession
    n = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = df.repartitionByRange(n, *[F.col(p) for p in partition], F.col(order)).withColumn("_bk", F.spark_partition_id())
    path = scratch_path(spark, f"ranges-{uuid.uuid4().hex}")
    rows.write.parquet(path)
    return spark.read.schema(rows.schema).parquet(path)


def prefix_sums(df: DataFrame, partition: Sequence[str], order: str, sums: Sequence[str],
                descending: bool = False, buckets: int | None = None, suffix: str = "_cum") -> DataFrame:
    """Inclusive running sums of ``sums`` within ``partition`` in ``order``.

    Rows lie in balanced ranges (``with_range_bucket``); per-range totals
    (combined map-side) give exclusive offsets by a window over the small
    (partition, range) table; rows join their offset on (partition, range) and
    run a window inside the range.  ``order`` is not NULL; rows that tie within a
    partition are counted one after the other, in no fixed order.
    """
    part = list(partition)
    o = F.col(order).desc() if descending else F.col(order).asc()
    step = F.col("_bk").desc() if descending else F.col("_bk").asc()
    rows = with_range_bucket(df, part, order, buckets)
    tot = rows.groupBy(*part, "_bk").agg(*[F.sum(s).alias(f"_t_{s}") for s in sums])
    wb = Window.partitionBy(*part).orderBy(step).rowsBetween(Window.unboundedPreceding, -1)
    offs = tot.select(*[F.col(p).alias(f"_p_{p}") for p in part], F.col("_bk").alias("_pbk"),
                      *[F.coalesce(F.sum(f"_t_{s}").over(wb), F.lit(0)).alias(f"_o_{s}") for s in sums])
    same = rows["_bk"] == offs["_pbk"]
    for p in part:
        same = same & rows[p].eqNullSafe(offs[f"_p_{p}"])
    w = Window.partitionBy(*part, "_bk").orderBy(o).rowsBetween(Window.unboundedPreceding, 0)
    return rows.join(offs, same).select(
        *[rows[c] for c in df.columns], *[(F.col(f"_o_{s}") + F.sum(s).over(w)).alias(f"{s}{suffix}") for s in sums])


# ------------------------------------------------------ drift (two-sample KS) --

def unpivot_numeric(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """Wide numeric columns -> long ``(feature, value)`` rows, NULL and NaN dropped."""
    cols = [c for c in features if c in df.columns]
    stack = ", ".join(f"'{c}', CAST(`{c}` AS DOUBLE)" for c in cols)
    return (df.selectExpr(f"stack({len(cols)}, {stack}) AS (feature, value)")
            .filter(F.col("value").isNotNull() & ~F.isnan("value")))


def ks_from_long(reference: DataFrame, current: DataFrame) -> DataFrame:
    """Q2 core: KS D per feature from two long ``(feature, value)`` samples.

    Counts per distinct value (map-side combined), then D = max
    |ECDF_ref - ECDF_cur| over running sums of the merged distinct values.
    Features missing on either side are dropped.
    """
    u = (reference.select("feature", F.col("value").cast("double").alias("value")).withColumn("side", F.lit(0))
         .unionByName(current.select("feature", F.col("value").cast("double").alias("value"))
                      .withColumn("side", F.lit(1))))
    u = u.filter(F.col("value").isNotNull() & ~F.isnan("value"))
    cnt = u.groupBy("feature", "value").agg(
        F.count_if(F.col("side") == 0).cast("double").alias("c0"),
        F.count_if(F.col("side") == 1).cast("double").alias("c1"))
    return ks_from_counts(cnt)


def ks_from_counts(cnt: DataFrame) -> DataFrame:
    """KS D per feature from ``(feature, value, c0, c1)``: how often each value occurs in either sample."""
    sizes = cnt.groupBy("feature").agg(F.sum("c0").alias("n_ref"), F.sum("c1").alias("n_cur")) \
        .filter((F.col("n_ref") > 0) & (F.col("n_cur") > 0))
    cum = prefix_sums(cnt, ["feature"], "value", ["c0", "c1"]).join(sizes, "feature")
    # try_divide: the filter on sizes may run after the projection
    gap = F.abs(F.try_divide("c0_cum", "n_ref") - F.try_divide("c1_cum", "n_cur"))
    d = cum.groupBy("feature").agg(F.max(gap).alias("ks_statistic"))
    return d.join(sizes, "feature").select(
        "feature", "ks_statistic", F.col("n_ref").cast("long").alias("n_ref"),
        F.col("n_cur").cast("long").alias("n_cur"))


def ks_statistic(reference: DataFrame, current: DataFrame, features: Sequence[str]) -> DataFrame:
    """Q2: two-sample Kolmogorov-Smirnov D per wide numeric feature (+ sample sizes)."""
    return ks_from_long(unpivot_numeric(reference, features), unpivot_numeric(current, features))


def kolmogorov_sf(d: Column, n_ref: Column, n_cur: Column) -> Column:
    """Asymptotic two-sample KS p-value: Q_KS(lam), lam = sqrt(n m / (n + m)) * D.

    Two series of the same function, each where it converges in a few terms:
    below lam = 1 the theta form 1 - sqrt(2 pi)/lam * sum exp(-(2k-1)^2 pi^2 /
    (8 lam^2)), above it the alternating form 2 * sum (-1)^(k-1) exp(-2 k^2 lam^2).
    """
    lam = F.sqrt(n_ref * n_cur / (n_ref + n_cur)) * d

    def total(expr):
        return F.aggregate(F.sequence(F.lit(1), F.lit(8)), F.lit(0.0), lambda acc, k: acc + expr(k.cast("double")))

    theta = total(lambda k: F.exp(-F.pow(2 * k - 1, F.lit(2.0)) * (math.pi**2 / 8) / (lam * lam)))
    alternating = total(lambda k: F.pow(F.lit(-1.0), k - 1) * F.exp(-2.0 * k * k * lam * lam))
    # below 0.05 the value is 1 to the last digit (and 1/lam may overflow)
    p = F.when(lam < 0.05, F.lit(1.0)).when(lam < 1, 1 - math.sqrt(2 * math.pi) / lam * theta).otherwise(2 * alternating)
    return F.least(F.greatest(p, F.lit(0.0)), F.lit(1.0))


#: samples up to this size get the exact law, larger ones the asymptotic one
KS_EXACT_ROWS = 10_000


def ks_exact_sf(d: float, n: int, m: int) -> float:
    """P(D >= d) for two samples of n and m values of one continuous law.

    An ordering of the pooled values is a lattice path from (0, 0) to (n, m), all
    equally likely.  ``v`` is the chance that a path to a cell has left the band
    |i / n - j / m| < d on its way: 1 outside the band, inside it the mean of the
    two cells before, weighted by how many paths come from each.  One diagonal
    i + j = s follows the other, as an array; every term is positive, so small
    chances keep their precision.
    """
    g = math.gcd(n, m)
    a, b = n // g, m // g
    h = round(d * a * m)                          # the band in units of 1 / lcm(n, m)
    if h <= 0:
        return 1.0
    v = np.ones(n + 1)
    for s in range(1, n + m + 1):
        # inside: |i (a + b) - s a| < h, for i steps of the first sample
        lo = max(0, s - m, (s * a - h) // (a + b) + 1)
        hi = min(n, s, (s * a + h - 1) // (a + b))
        if s == 1:
            inner = np.zeros(0) if lo > hi else np.zeros(hi - lo + 1)
        else:
            i = np.arange(lo, hi + 1)
            before = np.where(i > 0, v[np.maximum(i - 1, 0)], 0.0)
            inner = (i * before + (s - i) * v[lo:hi + 1]) / s
        v[max(0, s - m):min(n, s) + 1] = 1.0
        v[lo:hi + 1] = inner
    return float(min(v[n], 1.0))


def ks_p_value(d: Column, n_ref: Column, n_cur: Column) -> Column:
    """Two-sample KS p-value: the exact law where both samples have KS_EXACT_ROWS
    values at most, else the asymptotic one.

    The exact law is worked out once per row (a row is a feature), in batches; its
    cost is bounded by KS_EXACT_ROWS.
    """
    @F.pandas_udf("double")
    def exact(d: pd.Series, n: pd.Series, m: pd.Series) -> pd.Series:
        return pd.Series([ks_exact_sf(x, int(i), int(j)) if x == x and max(i, j) <= KS_EXACT_ROWS else float("nan")
                          for x, i, j in zip(d, n, m)], dtype="float64")

    small = F.greatest(n_ref, n_cur) <= KS_EXACT_ROWS
    return F.when(small, exact(d, n_ref, n_cur)).otherwise(kolmogorov_sf(d, n_ref.cast("double"), n_cur.cast("double")))


# -------------------------------------------------- classifier evaluation ----

def score_table(df: DataFrame, label: str, score: str, group: Sequence[str] = ()) -> DataFrame:
    """Positives and negatives per distinct score (per group)."""
    return df.filter(F.col(score).isNotNull()).groupBy(*group, F.col(score).alias("score")).agg(
        F.sum(F.col(label).cast("long")).cast("double").alias("pos"),
        F.sum(1 - F.col(label).cast("long")).cast("double").alias("neg"))


def pr_curve(df: DataFrame, label: str, score: str, group: Sequence[str] = ()) -> DataFrame:
    """Precision / recall at every distinct score as threshold (score >= t)."""
    keys = list(group) or ["_g"]
    st = score_table(df, label, score, group)
    if not group:
        st = st.withColumn("_g", F.lit(0))
    tot = st.groupBy(*keys).agg(F.sum("pos").alias("P"), F.sum("neg").alias("N"))
    cum = prefix_sums(st, keys, "score", ["pos", "neg"], descending=True)
    # per-group totals: a join on the group keys; a single curve takes them as scalars
    cum = cum.join(tot, keys) if group else attach_scalar(cum, tot.select("P", "N"))
    tp, fp = F.col("pos_cum"), F.col("neg_cum")
    return cum.select(*group, F.col("score").alias("threshold"), tp.alias("tp"), fp.alias("fp"),
                      (tp / (tp + fp)).alias("precision"),
                      F.when(F.col("P") > 0, tp / F.col("P")).alias("recall"),
                      "P", "N", "pos", "neg")


def ranking_metrics(df: DataFrame, label: str, score: str, group: Sequence[str] = ()) -> DataFrame:
    """M8: average precision and ROC-AUC from one pass over the curve."""
    c = pr_curve(df, label, score, group)
    below = F.col("N") - F.col("fp")
    return c.groupBy(*group).agg(
        F.sum(F.col("pos") / F.col("P") * F.col("precision")).alias("pr_auc"),
        (F.sum(F.col("pos") * (below + 0.5 * F.col("neg"))) / (F.first("P") * F.first("N"))).alias("roc_auc"))


def average_precision(df: DataFrame, label: str, score: str, group: Sequence[str] = ()) -> DataFrame:
    """M8: AP = sum over distinct scores (high to low) of (R_k - R_{k-1}) * P_k (step rule)."""
    c = pr_curve(df, label, score, group)
    return c.groupBy(*group).agg(F.sum(F.col("pos") / F.col("P") * F.col("precision")).alias("pr_auc"))


def roc_auc(df: DataFrame, label: str, score: str, group: Sequence[str] = ()) -> DataFrame:
    """M8: ROC-AUC as the Mann-Whitney statistic with tied scores counted half."""
    c = pr_curve(df, label, score, group)
    # negatives strictly below a score = N - (negatives at or above it)
    below = F.col("N") - F.col("fp")
    return c.groupBy(*group).agg(
        (F.sum(F.col("pos") * (below + 0.5 * F.col("neg"))) / (F.first("P") * F.first("N"))).alias("roc_auc"))


def pick_threshold(df: DataFrame, label: str, score: str, target_recall: float = 0.70,
                   group: Sequence[str] = ()) -> DataFrame:
    """M7: highest precision with recall >= target; else best F1.

    Candidate thresholds are the distinct scores down to the first one where
    recall reaches 1, as in ``precision_recall_curve``.  Ties go to the lowest
    threshold (first of the ascending list).
    """
    g = list(group)
    c = pr_curve(df, label, score, g)
    # thresholds at or above the highest score reaching full recall
    full = c.filter(F.col("tp") >= F.col("P")).groupBy(*g).agg(F.max("threshold").alias("_tmin"))
    c = (c.join(full, g) if g else attach_scalar(c, full)).filter(F.col("threshold") >= F.col("_tmin"))
    f1 = 2 * F.col("precision") * F.col("recall") / (F.col("precision") + F.col("recall") + 1e-12)
    c = c.withColumn("f1", f1).withColumn("_valid", F.col("recall") >= target_recall)
    best_f1 = F.max_by("threshold", F.struct(F.col("f1"), -F.col("threshold")))
    agg = c.groupBy(*g).agg(
        F.max_by("threshold", F.when(F.col("_valid"), F.struct(F.col("precision"), -F.col("threshold"))))
        .alias("_tv"),
        best_f1.alias("_tf"))
    return agg.select(*g, F.coalesce("_tv", "_tf").alias("threshold"),
                      F.col("_tv").isNull().alias("used_f1_fallback"))


def pick_threshold_by(df: DataFrame, label: str, score: str, mode: str = "f1", target_recall: float = 0.70,
                      group: Sequence[str] = ()) -> DataFrame:
    """The other rules for a threshold.

    ``f1``: the best F1 (of ties the lowest threshold).  ``recall``: the highest
    threshold whose recall is still ``target_recall`` (recall falls as thresholds
    rise), else as ``f1``.  ``recall_or_half``: the same, else 0.5.
    """
    if mode not in ("f1", "recall", "recall_or_half"):
        raise ValueError(f"unknown mode: {mode}")
    c = pr_curve(df, label, score, group)
    f1 = 2 * F.col("precision") * F.col("recall") / (F.col("precision") + F.col("recall") + 1e-12)
    best = F.max_by("threshold", F.when(f1.isNotNull(), F.struct(f1.alias("f1"), -F.col("threshold"))))
    reaching = F.max(F.when(F.col("recall") >= target_recall, F.col("threshold")))
    chosen = {"f1": best, "recall": F.coalesce(reaching, best), "recall_or_half": F.coalesce(reaching, F.lit(0.5))}[mode]
    return c.groupBy(*group).agg(chosen.cast("double").alias("threshold"))


def confusion_metrics(df: DataFrame, label: str, score: str, threshold, group: Sequence[str] = ()) -> DataFrame:
    """M8: confusion counts and rates at ``score >= threshold``; zero division -> 0."""
    t = threshold if isinstance(threshold, Column) else F.lit(float(threshold))
    y = F.col(label).cast("int")
    pred = (F.col(score) >= t).cast("int")
    agg = df.groupBy(*group).agg(
        F.count_if((pred == 1) & (y == 1)).cast("long").alias("tp"),
        F.count_if((pred == 1) & (y == 0)).cast("long").alias("fp"),
        F.count_if((pred == 0) & (y == 1)).cast("long").alias("fn"),
        F.count_if((pred == 0) & (y == 0)).cast("long").alias("tn"),
        F.first(t).cast("double").alias("threshold"))
    tp, fp, fn, tn = (F.col(c).cast("double") for c in ("tp", "fp", "fn", "tn"))
    prec = F.when(tp + fp > 0, tp / (tp + fp)).otherwise(0.0)
    rec = F.when(tp + fn > 0, tp / (tp + fn)).otherwise(0.0)
    return agg.select(*group, "tp", "fp", "fn", "tn", prec.alias("precision"), rec.alias("recall"),
                      F.when(prec + rec > 0, 2 * prec * rec / (prec + rec)).otherwise(0.0).alias("f1"),
                      ((tp + tn) / (tp + fp + fn + tn)).alias("accuracy"), "threshold")


def calibration_gap(curve: DataFrame) -> DataFrame:
    """Mean over the bins of |observed rate - mean score|."""
    return curve.agg(F.avg(F.abs(F.col("prob_true") - F.col("prob_pred"))).alias("mean_calibration_gap"))


def calibration_curve(df: DataFrame, label: str, score: str, n_bins: int = 10) -> DataFrame:
    """Equal-frequency calibration bins: mean label and mean score per non-empty bin.

    Bin of p = number of inner quantile edges strictly below p (as
    ``searchsorted`` on the edges), edges = exact linear quantiles.
    """
    probs = [i / n_bins for i in range(n_bins + 1)]
    edges = grouped_quantiles(df, [], {"_e": F.col(score)}, probs)
    j = attach_scalar(df.filter(F.col(score).isNotNull()), edges)
    inner = F.slice(F.col("_e"), 2, n_bins - 1)
    binid = F.size(F.filter(inner, lambda e: e < F.col(score)))
    return j.withColumn("bin", binid).groupBy("bin").agg(
        F.count(F.lit(1)).alias("n"), F.avg(F.col(label).cast("double")).alias("prob_true"),
        F.avg(F.col(score).cast("double")).alias("prob_pred"))
