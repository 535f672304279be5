"""Data quality reports.

Each report is one aggregation pass over its table; results are small long
tables (one row per column or per check), never rows pulled to the driver.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voltchurn.constants import DEFAULT_NULL_RATE_LIMIT, KEY, NULL_RATE_LIMITS, PRICE_CONSUMPTION_PAIRS
from voltchurn.functions.exprs import days_between
from voltchurn.operators.stats import attach_scalar, grouped_quantiles, rate_by, with_group_quantiles

NUMERIC = {"double", "float", "int", "bigint", "smallint", "tinyint"}


def _is_missing(df: DataFrame, c: str):
    t = dict(df.dtypes)[c]
    col = F.col(f"`{c}`")
    return col.isNull() | F.isnan(col) if t in ("double", "float") else col.isNull()


def column_profile(df: DataFrame, layer: str = "bronze") -> DataFrame:
    """Q1 per column: null rate (4 dp), numeric min/max, type, and the issue if over the layer limit."""
    limit = NULL_RATE_LIMITS.get(layer, DEFAULT_NULL_RATE_LIMIT)
    dtypes = dict(df.dtypes)
    aggs = [F.count(F.lit(1)).alias("_rows")]
    for i, c in enumerate(df.columns):
        aggs.append(F.count_if(_is_missing(df, c)).alias(f"_n{i}"))
        if dtypes[c] in NUMERIC:
            aggs += [F.min(F.col(f"`{c}`")).cast("double").alias(f"_lo{i}"),
                     F.max(F.col(f"`{c}`")).cast("double").alias(f"_hi{i}")]
    one = df.agg(*aggs)
    parts = []
    for i, c in enumerate(df.columns):
        lo = F.col(f"_lo{i}") if dtypes[c] in NUMERIC else F.lit(None).cast("double")
        hi = F.col(f"_hi{i}") if dtypes[c] in NUMERIC else F.lit(None).cast("double")
        parts.append(F.struct(F.lit(i).alias("position"), F.lit(c).alias("column"), F.lit(dtypes[c]).alias("dtype"),
                              F.col(f"_n{i}").alias("nulls"), lo.alias("min"), hi.alias("max")))
    long = one.select("_rows", F.explode(F.array(*parts)).alias("p")).select("_rows", "p.*")
    rate = F.when(F.col("_rows") > 0, F.col("nulls") / F.col("_rows")).otherwise(F.lit(0.0))
    out = long.withColumn("null_rate", F.bround(rate, 4)).withColumn(
        "issue", F.when(rate > limit, F.format_string(
            "High null rate in '%s': %.1f%% (threshold: %.0f%%)", F.col("column"), rate * 100,
            F.lit(limit * 100))))
    return out.select(F.lit(layer).alias("layer"), "position", "column", "dtype", "nulls", "null_rate",
                      "min", "max", "issue")


def quality_summary(df: DataFrame, layer: str = "bronze", key: str = KEY) -> DataFrame:
    """Q1 summary: rows, columns, duplicate-key rows (every row of a repeated key), issues, pass."""
    prof = column_profile(df, layer)
    n_null_issues = prof.agg(F.count("issue").alias("_ni"))
    rows = df.agg(F.count(F.lit(1)).alias("row_count"))
    out = attach_scalar(rows, n_null_issues)
    if key in df.columns:
        dup = (df.groupBy(key).agg(F.count(F.lit(1)).alias("_c")).filter("_c > 1")
               .agg(F.coalesce(F.sum("_c"), F.lit(0)).cast("long").alias("duplicate_keys")))
        out = attach_scalar(out, dup)
    else:
        out = out.withColumn("duplicate_keys", F.lit(0).cast("long"))
    n_issues = (F.col("_ni") + F.when(F.col("row_count") == 0, 1).otherwise(0)
                + F.when(F.col("duplicate_keys") > 0, 1).otherwise(0))
    return out.select(F.lit(layer).alias("layer"), "row_count", F.lit(len(df.columns)).alias("column_count"),
                      "duplicate_keys", n_issues.cast("long").alias("n_issues"), (n_issues == 0).alias("passed"))


def missingness_scan(df: DataFrame, min_rate: float = 0.05) -> DataFrame:
    """Q10: columns whose missing share exceeds ``min_rate``, highest first."""
    one = df.agg(F.count(F.lit(1)).alias("_rows"),
                 *[F.count_if(_is_missing(df, c)).alias(f"_n{i}") for i, c in enumerate(df.columns)])
    parts = [F.struct(F.lit(c).alias("column"), F.col(f"_n{i}").alias("nulls")) for i, c in enumerate(df.columns)]
    long = one.select("_rows", F.explode(F.array(*parts)).alias("p")).select("_rows", "p.*")
    rate = F.when(F.col("_rows") > 0, F.col("nulls") / F.col("_rows")).otherwise(F.lit(0.0))
    return (long.withColumn("null_rate", F.bround(rate, 4)).filter(F.col("null_rate") > min_rate)
            .select("column", "nulls", "null_rate").orderBy(F.desc("null_rate"), "column"))


def grain_report(df: DataFrame, keys: Sequence[str] = (KEY,)) -> DataFrame:
    """Q11: rows, distinct keys and extra (duplicate) rows."""
    ks = [F.col(k) for k in keys]
    one = df.agg(F.count(F.lit(1)).alias("rows"), F.count_distinct(*ks).alias("unique_keys"))
    return one.withColumn("duplicate_rows", F.col("rows") - F.col("unique_keys"))


def price_validity(scm: DataFrame) -> DataFrame:
    """Q9: per tariff, rows that consumed and how many lack a price (missing, zero, either)."""
    checks = [("elec_tier1", *PRICE_CONSUMPTION_PAIRS[0]), ("elec_tier2", *PRICE_CONSUMPTION_PAIRS[1]),
              ("elec_tier3", *PRICE_CONSUMPTION_PAIRS[2]), ("gas_var_m3", *PRICE_CONSUMPTION_PAIRS[3])]
    aggs, parts = [], []
    for i, (label, price, cons) in enumerate(checks):
        used = F.coalesce(F.col(cons), F.lit(0.0)) > 0
        p = F.col(price)
        aggs += [F.count_if(used).alias(f"u{i}"), F.count_if(p.isNull() & used).alias(f"m{i}"),
                 F.count_if((F.coalesce(p, F.lit(0.0)) == 0) & used).alias(f"z{i}"),
                 F.count_if((p.isNull() | (p == 0)) & used).alias(f"b{i}")]
        parts.append(F.struct(F.lit(label).alias("item"), F.lit(cons).alias("consumption_col"),
                              F.lit(price).alias("price_col"), F.col(f"u{i}").alias("rows_with_consumption"),
                              F.col(f"m{i}").alias("price_missing_where_used"),
                              F.col(f"z{i}").alias("price_zero_where_used"),
                              F.col(f"b{i}").alias("price_missing_or_zero_where_used")))
    return scm.agg(*aggs).select(F.explode(F.array(*parts)).alias("r")).select("r.*")


def remaining_missing(scm: DataFrame) -> DataFrame:
    """Q15: prices still missing after imputation where the matching consumption is > 0."""
    parts, aggs = [], []
    for i, (price, cons) in enumerate(PRICE_CONSUMPTION_PAIRS):
        if price not in scm.columns:
            continue
        used = F.coalesce(F.col(cons), F.lit(0.0)) > 0
        aggs.append(F.count_if(F.col(price).isNull() & used).alias(f"r{i}"))
        parts.append(F.struct(F.lit(price).alias("price_col"), F.col(f"r{i}").alias("remaining_missing")))
    return scm.agg(*aggs).select(F.explode(F.array(*parts)).alias("r")).select("r.*")


def minimum_values(df: DataFrame, cols: Sequence[str] = ("monthly_elec_kwh", "monthly_gas_m3",
                                                         "monthly_gas_kwh")) -> DataFrame:
    """Q12: minimum of each listed column (no impossible negative readings)."""
    one = df.agg(*[F.min(c).cast("double").alias(c) for c in cols])
    stack = ", ".join(f"'{c}', `{c}`" for c in cols)
    return one.selectExpr(f"stack({len(cols)}, {stack}) AS (column, min_value)")


def negative_reading_audit(consumption: DataFrame, cols: Sequence[str] = ("consumption_elec_kwh",
                                                                        "consumption_gas_m3")) -> DataFrame:
    """P3 + P4: share and totals of negative readings per measure (originals kept for audit)."""
    parts, aggs = [], [F.count(F.lit(1)).alias("_n")]
    for i, c in enumerate(cols):
        x = F.col(c)
        aggs += [F.count_if(x < 0).alias(f"neg{i}"), F.sum(F.when(x < 0, x)).alias(f"sum{i}"),
                 F.min(x).alias(f"min{i}")]
        parts.append(F.struct(F.lit(c).alias("measure"), F.col(f"neg{i}").alias("negative_rows"),
                              (F.col(f"neg{i}") / F.col("_n")).alias("negative_share"),
                              F.coalesce(F.col(f"sum{i}"), F.lit(0.0)).alias("negative_total"),
                              F.col(f"min{i}").alias("min_value")))
    return consumption.agg(*aggs).select(F.explode(F.array(*parts)).alias("r")).select("r.*")


READINGS = ("consumption_elec_kwh", "consumption_gas_m3")


def flag_negative_readings(consumption: DataFrame, cols: Sequence[str] = READINGS) -> DataFrame:
    """Every reading with a 0/1 flag per measure and the names of its negative measures.

    The readings themselves stay as they were, for the audit.  NULL and NaN are not negative.
    """
    flags = {f"{c}_negative": F.coalesce(F.col(c) < 0, F.lit(False)) for c in cols}
    names = F.array_compact(F.array(*[F.when(f, F.lit(c)) for c, f in zip(cols, flags.values())]))
    return consumption.withColumns({**{n: f.cast("int") for n, f in flags.items()},
                                    "negative_measures": F.array_join(names, ",")})


def negative_distribution(consumption: DataFrame, cols: Sequence[str] = READINGS,
                          probs: Sequence[float] = (0.01, 0.25, 0.5, 0.75, 0.99)) -> DataFrame:
    """Exact percentiles of the negative readings, one row per (measure, percentile); NULL without any."""
    rows = consumption.select(*[F.when(F.col(c) < 0, F.col(c)).alias(c) for c in cols])
    q = grouped_quantiles(rows, [], {c: F.col(c) for c in cols}, probs)
    cells = [F.struct(F.lit(c).alias("measure"), F.lit(float(p)).alias("percentile"), F.col(c)[k].alias("value"))
             for c in cols for k, p in enumerate(probs)]
    return q.select(F.explode(F.array(*cells)).alias("x")).select("x.*")


def leakage_check(scm: DataFrame, sc: DataFrame) -> DataFrame:
    """Q14: latest month and latest interaction date in the snapshot, plus the label balance."""
    mx = scm.agg(F.max("month").alias("max_month"))
    dt = sc.agg(F.max(F.col("date").try_cast("date")).alias("max_interaction_date"),
                F.avg(F.col("churn").cast("double")).alias("churn_share"),
                F.count_distinct(KEY).alias("customers"))
    return attach_scalar(mx, dt)


def corrupt_report(clean: dict[str, DataFrame], bad: dict[str, DataFrame]) -> DataFrame:
    """Per dataset its clean and corrupt rows and the corrupt share (NULL without rows)."""
    out = None
    for name in sorted(clean):
        rows = clean[name].select(F.lit(0).alias("bad")).unionByName(bad[name].select(F.lit(1).alias("bad")))
        one = rows.agg(F.count_if(F.col("bad") == 0).alias("clean_rows"), F.count_if(F.col("bad") == 1).alias("corrupt_rows"))
        one = one.select(F.lit(name).alias("dataset"), "*", F.try_divide("corrupt_rows", F.col("clean_rows") + F.col("corrupt_rows")).alias("corrupt_share"))
        out = one if out is None else out.unionByName(one)
    return out


# ------------------------------------------------------------ leakage audit ----

def tag_leakage(sc: DataFrame) -> DataFrame:
    """Every customer with its timing against the renewal date.

    ``days_to_renewal`` counts from the interaction to the renewal (negative:
    the interaction came after it), NULL without both dates.  ``scope`` lists the
    cuts a row is eligible for: all, before (0 days or more), safe_7d, safe_30d.
    ``violations`` lists what is suspicious about it: after_renewal, within_1_day,
    sentiment_without_interaction, sentiment_without_dates.
    """
    days = days_between(F.col("next_renewal_date"), F.col("date"))
    scored = F.col("sentiment_label").isNotNull()
    named = lambda rules: F.array_compact(F.array(*[F.when(rule, F.lit(name)) for name, rule in rules]))
    tagged = sc.withColumn("days_to_renewal", F.when(F.col("has_interaction") == 1, days))
    d = F.col("days_to_renewal")
    return tagged.withColumns({
        "has_sentiment": scored,
        "scope": named([("all", F.lit(True)), ("before", d >= 0), ("safe_7d", d >= 7), ("safe_30d", d >= 30)]),
        "violations": named([("after_renewal", d < 0), ("within_1_day", d.between(0, 1)),
                             ("sentiment_without_interaction", scored & (F.col("has_interaction") == 0)),
                             ("sentiment_without_dates", scored & d.isNull())])})


def leakage_sentiment_timing(tagged: DataFrame) -> DataFrame:
    """Q13 A: per sentiment, dated customers, share after renewal and median days to renewal."""
    rows = tagged.where(F.col("has_sentiment") & F.col("days_to_renewal").isNotNull())
    out = rows.groupBy("sentiment_label").agg(F.count("customer_id").alias("customers"),
                                              F.avg((F.col("days_to_renewal") < 0).cast("double")).alias("pct_after_renewal"))
    out = with_group_quantiles(out, rows, ["sentiment_label"], {"_q": F.col("days_to_renewal")}, [0.5])
    return out.withColumn("median_days_to_renewal", F.col("_q")[0]).drop("_q")


def leakage_churn_by_scope(tagged: DataFrame, by: Sequence[str] = ("sentiment_label",)) -> DataFrame:
    """Q13 B-D: churn by sentiment (and other columns) under every buffer before the renewal, in one pass."""
    rows = tagged.where("has_sentiment").withColumn("scope", F.explode("scope"))
    return rate_by(rows, ["scope", *by])


def leakage_violations(tagged: DataFrame) -> DataFrame:
    """Q13: rows and churn of every violated rule."""
    return rate_by(tagged.withColumn("violation", F.explode("violations")), ["violation"])


def leakage_suspicious(tagged: DataFrame) -> DataFrame:
    """Negative churners whose interaction came after the renewal or within a day before it."""
    hit = F.arrays_overlap("violations", F.array(F.lit("after_renewal"), F.lit("within_1_day")))
    return tagged.where((F.col("sentiment_label") == "negative") & (F.col("churn") == 1) & hit).select(
        "customer_id", "date", "next_renewal_date", "days_to_renewal", "sentiment_label",
        "sentiment_neg", "sentiment_neu", "sentiment_pos", "interaction_summary")


def leakage_summary(tagged: DataFrame) -> DataFrame:
    """Q13: how many rows each cut leaves, as (metric, rows)."""
    scored, d = F.col("has_sentiment"), F.col("days_to_renewal")
    counts = {"rows_total": F.count(F.lit(1)), "rows_has_sentiment": F.count_if(scored),
              "rows_has_sentiment_and_dates": F.count_if(scored & d.isNotNull()),
              "rows_sentiment_after_renewal": F.count_if(scored & (d < 0)), "rows_sentiment_pre_renewal": F.count_if(scored & (d >= 0)),
              "rows_sentiment_safe_7d": F.count_if(scored & (d >= 7)), "rows_sentiment_safe_30d": F.count_if(scored & (d >= 30))}
    one = tagged.agg(*[c.alias(n) for n, c in counts.items()])
    return one.select(F.explode(F.array(*[F.struct(F.lit(n).alias("metric"), F.col(n).alias("rows")) for n in counts])).alias("x")).select("x.*")
