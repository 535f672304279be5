"""Stand-in raw tables built from the driver's star-schema test tables.

The reference's raw files (labels, attributes, contracts, prices, costs,
interactions, hourly consumption) are not shipped.  Each function here only
*renames and reshapes* driver columns into the logical schema the pipeline
expects (see FIXTURES.md section 3); none of them does any of the pipeline's
work.  The pipeline must be right on any data of these schemas.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voltchurn.constants import KEY

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


_TABLES: dict = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table; the DataFrame (a plan, not data) is reused within a session so the
    file footer is resolved once."""
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    key = (id(spark), path)
    if key not in _TABLES:
        _TABLES[key] = spark.read.parquet(path)
    return _TABLES[key]


def consumption_from_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly readings: one event = one reading (January 2024, holidays inside)."""
    e = table(spark, sf_dir, "events")
    return e.select(
        F.col("user_id").cast("string").alias(KEY),
        F.col("ts").alias("timestamp"),
        (F.col("value") - 50).alias("consumption_elec_kwh"),
        F.when(F.col("event_type").isin("view", "click"), F.col("value") / 11)
        .otherwise(F.lit(0.0)).alias("consumption_gas_m3"),
    )


def consumption_from_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Readings spread over 1995-2001: one line item = one reading of its order's customer."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity",
                                                 "l_tax", "l_linestatus")
    hour = ((F.col("l_orderkey") * 7 + F.col("l_linenumber") * 5) % 24).cast("int")
    # one row an order on the hashed side: the line items are not sorted for the join
    return li.join(o.hint("shuffle_hash"), li.l_orderkey == o.o_orderkey).select(
        F.col("o_custkey").cast("string").alias(KEY),
        (F.col("o_orderdate") + F.make_interval(hours=hour)).alias("timestamp"),
        (F.col("l_quantity") * 10 - 40).alias("consumption_elec_kwh"),
        F.when(F.col("l_linestatus") == "O", F.col("l_tax") * 100)
        .otherwise(F.lit(0.0)).alias("consumption_gas_m3"),
    )


def churn_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    return c.select(F.col("c_custkey").cast("string").alias(KEY),
                    F.when(F.col("c_acctbal") < 0, 1).otherwise(0).alias("churn"))


def attributes(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    n = table(spark, sf_dir, "nation")
    k = F.col("c_custkey")
    seg = F.col("c_mktsegment")
    channel = (
        F.when(k % 11 == 0, F.lit(None).cast("string"))
        .when(k % 13 == 0, F.lit("partner_store"))
        .when(seg == "AUTOMOBILE", F.lit("comparador"))
        .when(seg == "BUILDING", F.lit(" Presencial_Comercial "))
        .when(seg == "FURNITURE", F.lit("WEB_PROPIA"))
        .when(seg == "HOUSEHOLD", F.lit("telemarketing"))
        .otherwise(F.lit("oficina"))
    )
    return c.join(n, c.c_nationkey == n.n_nationkey, "left").select(
        k.cast("string").alias(KEY),
        F.col("c_nationkey").alias("province_code"),
        F.when(seg.isin("MACHINERY", "BUILDING"), 1).otherwise(0).alias("is_industrial"),
        F.when(k % 4 == 0, 3.5).when(k % 4 == 1, 5.0).when(k % 4 == 2, 10.0)
        .otherwise(50.0).alias("contracted_power_kw"),
        F.when(k % 5 == 0, 1).otherwise(0).alias("is_second_residence"),
        channel.alias("sales_channel"),
        F.when(F.col("n_regionkey").isin(2, 3), 1).otherwise(0).alias("is_high_competition_province"),
    )


def contracts(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    g = o.groupBy("o_custkey").agg(
        F.min("o_orderdate").cast("date").alias("contract_start_date"),
        F.max("o_orderdate").cast("date").alias("last_product_change_date"),
    )
    return g.select(
        F.col("o_custkey").cast("string").alias(KEY),
        "contract_start_date",
        F.add_months("last_product_change_date", (F.col("o_custkey") % 18).cast("int"))
        .alias("next_renewal_date"),
        "last_product_change_date",
    )


def prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One price row per customer-month; NULL when most lines are 'A', 0 when most are 'R'."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate", "o_totalprice")
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_quantity", "l_extendedprice",
                                                 "l_returnflag")
    j = li.join(o.hint("shuffle_hash"), li.l_orderkey == o.o_orderkey)
    # grouped by the month's first day: a text per line item would cost more than the join
    g = j.groupBy("o_custkey", F.trunc(F.col("o_orderdate").cast("date"), "MM").alias("m")).agg(
        F.min("o_orderdate").cast("date").alias("pricing_date"),
        (F.avg(F.col("l_extendedprice") / F.col("l_quantity")) / 10000).alias("base"),
        (F.avg("o_totalprice") / 20000).alias("fee"),
        F.count_if(F.col("l_returnflag") == "A").alias("n_a"),
        F.count_if(F.col("l_returnflag") == "R").alias("n_r"),
        F.count(F.lit(1)).alias("n"),
    )

    def rule(v):
        return (F.when(F.col("n_a") * 2 > F.col("n"), F.lit(None).cast("double"))
                .when(F.col("n_r") * 2 > F.col("n"), F.lit(0.0)).otherwise(v))

    return g.select(
        F.col("o_custkey").cast("string").alias(KEY),
        "pricing_date",
        rule(F.col("base") * 1.25).alias("variable_price_tier1_eur_kwh"),
        rule(F.col("base")).alias("variable_price_tier2_eur_kwh"),
        rule(F.col("base") * 0.75).alias("variable_price_tier3_eur_kwh"),
        rule(F.col("base") * 6).alias("gas_variable_price_eur_m3"),
        rule(F.col("fee")).alias("elec_fixed_fee_eur_month"),
        rule(F.col("fee") * 10).alias("gas_fixed_revenue_eur_year"),
    )


def costs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Province x month costs (bounded: provinces x months, whatever the data volume)."""
    li = table(spark, sf_dir, "lineitem").select("l_suppkey", "l_quantity", "l_discount", "l_tax",
                                                 "l_shipdate")
    s = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    j = li.join(s, li.l_suppkey == s.s_suppkey)
    # a month is a plain number in the keys: dates of first days cost the hashed aggregate more than twice the time
    day = F.col("l_shipdate").cast("date")
    g = j.groupBy(F.col("s_nationkey").alias("province"), (F.year(day) * 12 + F.month(day) - 1).alias("_m")).agg(
        F.avg("l_discount").alias("elec_var_cost_eur_kwh"),
        (F.avg("l_tax") / 2).alias("peaje_elec_eur_kwh"),
        (F.avg("l_quantity") / 5).alias("elec_fixed_cost_eur_month"),
        (F.avg("l_discount") * 4).alias("gas_var_cost_eur_m3"),
        (F.avg("l_quantity") * 2).alias("gas_fixed_cost_eur_year"),
    )
    first = F.make_date(F.floor(F.col("_m") / 12).cast("int"), (F.pmod("_m", F.lit(12)) + 1).cast("int"), F.lit(1))
    return g.select("province", F.date_format(first, "yyyy-MM").alias("month"), *g.columns[2:])


def interactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two documents per customer: ``customer_id = doc_id div 2``; some dates missing."""
    return interactions_with_id(spark, sf_dir).drop("interaction_id")


def interactions_with_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same interactions with the document's id as ``interaction_id``."""
    d = table(spark, sf_dir, "documents")
    day = ((F.col("doc_id") * 37) % 600).cast("int")
    return d.select(
        F.col("doc_id").cast("long").alias("interaction_id"),
        (F.col("doc_id").cast("long") / 2).cast("long").cast("string").alias(KEY),
        F.when(F.col("doc_id") % 10 == 9, F.lit(None).cast("date"))
        .otherwise(F.date_add(F.lit("2000-01-01").cast("date"), day)).alias("date"),
        F.col("text").alias("interaction_summary"),
        F.col("source").alias("channel"),
    )


def raw_tables(spark: SparkSession, sf_dir: str, consumption: str = "orders") -> dict[str, DataFrame]:
    """All seven logical raw tables, keyed like the reference's loader."""
    cons = consumption_from_orders if consumption == "orders" else consumption_from_events
    return {
        "churn": churn_labels(spark, sf_dir),
        "attributes": attributes(spark, sf_dir),
        "contracts": contracts(spark, sf_dir),
        "prices": prices(spark, sf_dir),
        "costs": costs(spark, sf_dir),
        "interactions": interactions(spark, sf_dir),
        "consumption": cons(spark, sf_dir),
    }


def labelled_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores + labels for evaluation operators: documents with a quality label.

    ``label = quality``; the score is a fixed function of the text length
    (equal lengths give tied scores, which the curves must handle).
    """
    d = table(spark, sf_dir, "documents").select("doc_id", "n_chars")
    lab = table(spark, sf_dir, "labels").select("doc_id", "quality")
    return d.join(lab, "doc_id").select(
        "doc_id", F.col("quality").alias("label"),
        (F.col("n_chars") / (F.col("n_chars") + F.lit(2000.0))).alias("score"))


def model_output_from_gold(gold: DataFrame, keep_columns: bool = False) -> DataFrame:
    """A stand-in for a trained model's raw probabilities: a fixed logistic function of a
    few gold features.  It only supplies ``(customer_id, proba)`` rows; scoring,
    tiers and recommendations downstream are the library's own work."""
    z = (F.lit(-2.0) + 2.5 * F.col("is_within_3m_of_renewal")
         + 1.5 * F.col("is_high_competition_province")
         + 1.0 * F.coalesce(F.col("is_negative_sentiment"), F.lit(0))
         + 1.5 * F.coalesce(F.col("recent_complaint_flag"), F.lit(0))
         - 0.005 * F.coalesce(F.col("tenure_months"), F.lit(0.0)))
    p = (F.lit(1.0) / (F.lit(1.0) + F.exp(-z))).alias("proba")
    return gold.select("*", p) if keep_columns else gold.select(KEY, p)


def consumption_stream_from_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The hourly readings of ``consumption_from_events`` as a file-source stream."""
    schema = table(spark, sf_dir, "events").schema
    e = (spark.readStream.format("parquet").schema(schema)
         .load(f"{sf_dir.rstrip('/')}/event[s].parquet"))  # a glob: the file source wants a directory or pattern
    return e.select(
        F.col("user_id").cast("string").alias(KEY),
        F.col("ts").alias("timestamp"),
        (F.col("value") - 50).alias("consumption_elec_kwh"),
        F.when(F.col("event_type").isin("view", "click"), F.col("value") / 11)
        .otherwise(F.lit(0.0)).alias("consumption_gas_m3"),
    )
