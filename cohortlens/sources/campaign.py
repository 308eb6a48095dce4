"""Raw campaign table (one row per customer, 29 columns) derived from the order tables.

The source data are the TPC-H-like tables; the derivation follows FIXTURES.md:
features use orders before the cut-off ``T``, the label uses orders on or after
``T``. All joins are left joins from ``customer``.

Physical plan, designed for a large cluster:

* ``orders`` is scanned once; one ``groupBy(o_custkey)`` with partial aggregation
  yields dates, channel counts, campaign flags and the label.
* ``lineitem`` joins ``part`` (Spark decides broadcast vs shuffle from size
  statistics; nothing is forced), is pre-aggregated per order (about 4x fewer
  rows), joined to the filtered orders on the same key and aggregated per customer.
* ``events`` is filtered to views and counted per user with partial aggregation.
* ``nation`` / ``region`` are broadcast: their size is fixed by the schema
  (25 and 5 rows), not by the data volume.
* the three per-customer aggregates and ``customer`` are joined on the customer
  key, so the aggregates keep their hash partitioning.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import table

# Fixed values of the derivation (FIXTURES.md §2).
CUTOFF = "2001-07-01"
REFERENCE_YEAR = 2001
# spend categories, in column order, and the part type that feeds each
SPEND_BY_TYPE = [
    ("MntWines", "STANDARD"),
    ("MntFruits", "SMALL"),
    ("MntMeatProducts", "MEDIUM"),
    ("MntFishProducts", "LARGE"),
    ("MntSweetProducts", "ECONOMY"),
    ("MntGoldProds", "PROMO"),
]
# channel purchase counts and the order status that feeds each
CHANNEL_BY_STATUS = [
    ("NumWebPurchases", "O"),
    ("NumCatalogPurchases", "F"),
    ("NumStorePurchases", "P"),
]
# AcceptedCmp1..5 = any order in these months of 2001
CAMPAIGN_MONTHS = [2, 3, 4, 5, 6]
DEAL_DISCOUNT = 0.09
Z_COST_CONTACT = 3
Z_REVENUE = 11

RAW_COLUMNS = [
    "ID", "Year_Birth", "Education", "Marital_Status", "Income", "Kidhome", "Teenhome",
    "Dt_Customer", "Recency", "MntWines", "MntFruits", "MntMeatProducts", "MntFishProducts",
    "MntSweetProducts", "MntGoldProds", "NumDealsPurchases", "NumWebPurchases",
    "NumCatalogPurchases", "NumStorePurchases", "NumWebVisitsMonth", "AcceptedCmp3",
    "AcceptedCmp4", "AcceptedCmp5", "AcceptedCmp1", "AcceptedCmp2", "Complain",
    "Z_CostContact", "Z_Revenue", "Response",
]


def _money(c):
    """Amounts as exact 2-decimal numbers so sums do not depend on row order."""
    return F.col(c).cast("decimal(15,2)")


def order_stats(orders: DataFrame, cutoff: str = CUTOFF) -> DataFrame:
    """Per-customer order dates, channel counts, campaign flags and label (one pass)."""
    t = F.lit(cutoff).cast("timestamp")
    d = F.to_date("o_orderdate")
    before = F.col("o_orderdate") < t
    aggs = [
        F.min(F.when(before, d)).alias("first_date"),
        F.max(F.when(before, d)).alias("last_date"),
    ]
    aggs += [F.count(F.when(before & (F.col("o_orderstatus") == s), 1)).alias(name) for name, s in CHANNEL_BY_STATUS]
    aggs += [
        F.max(F.when(before & (F.year(d) == F.lit(int(cutoff[:4]))) & (F.month(d) == m), 1).otherwise(0)).alias(f"AcceptedCmp{i}")
        for i, m in enumerate(CAMPAIGN_MONTHS, start=1)
    ]
    aggs.append(F.max(F.when(~before, 1).otherwise(0)).alias("Response"))
    return (
        orders.select("o_custkey", "o_orderstatus", "o_orderdate")
        .groupBy("o_custkey")
        .agg(*aggs)
    )


def line_stats(lineitem: DataFrame, part: DataFrame, orders: DataFrame, cutoff: str = CUTOFF) -> DataFrame:
    """Per-customer spend by category, deal orders and complaint flag."""
    t = F.lit(cutoff).cast("timestamp")
    # the date filter first: later orders' lines are neither joined to part nor added up
    early = orders.filter(F.col("o_orderdate") < t).select("o_orderkey", "o_custkey", "o_orderpriority")
    lines = (
        lineitem.select("l_orderkey", "l_partkey", "l_extendedprice", "l_discount", "l_returnflag")
        .join(early, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(part.select("p_partkey", "p_type"), F.col("l_partkey") == F.col("p_partkey"), "left")
    )
    net = _money("l_extendedprice") * (F.lit(1).cast("decimal(3,2)") - F.col("l_discount").cast("decimal(4,2)"))
    per_order = lines.groupBy("o_orderkey", "o_custkey", "o_orderpriority").agg(
        *[F.sum(F.when(F.col("p_type") == ptype, net)).alias(name) for name, ptype in SPEND_BY_TYPE],
        F.max((F.col("l_discount") >= DEAL_DISCOUNT).cast("int")).alias("has_deal"),
        F.max((F.col("l_returnflag") == "R").cast("int")).alias("has_return"),
    )
    return per_order.groupBy("o_custkey").agg(
        *[F.round(F.sum(name), 2).alias(name) for name, _ in SPEND_BY_TYPE],
        F.sum("has_deal").alias("NumDealsPurchases"),
        F.sum(F.when(F.col("o_orderpriority") == "1-URGENT", F.col("has_return")).otherwise(0)).alias("urgent_returns"),
    )


def web_visits(events: DataFrame) -> DataFrame:
    """Number of ``view`` events per user."""
    return (
        events.filter(F.col("event_type") == "view")
        .groupBy(F.col("user_id").alias("v_user"))
        .agg(F.count(F.lit(1)).alias("NumWebVisitsMonth"))
    )


def campaign_raw(spark: SparkSession, sf_dir: str, cutoff: str = CUTOFF, with_duplicates: bool = True) -> DataFrame:
    """The 29-column raw campaign table, duplicates included (ID % 50 = 0 twice)."""
    customer = table(spark, sf_dir, "customer")
    nation = table(spark, sf_dir, "nation")
    region = table(spark, sf_dir, "region")
    orders = table(spark, sf_dir, "orders")
    ostats = order_stats(orders, cutoff)
    lstats = line_stats(table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "part"), orders, cutoff)
    visits = web_visits(table(spark, sf_dir, "events"))
    geo = F.broadcast(
        nation.join(F.broadcast(region), F.col("n_regionkey") == F.col("r_regionkey")).select("n_nationkey", "r_name")
    )
    key = F.col("c_custkey")
    base = (
        customer.select("c_custkey", "c_nationkey", "c_acctbal", "c_mktsegment")
        .join(geo, F.col("c_nationkey") == F.col("n_nationkey"), "left")
        .join(ostats, key == F.col("o_custkey"), "left")
        .drop("o_custkey")
        .join(lstats, key == F.col("o_custkey"), "left")
        .join(visits, key == F.col("v_user"), "left")
    )
    t = F.lit(cutoff).cast("date")
    cols = {
        "ID": key.cast("bigint"),
        "Year_Birth": F.when(key % 211 == 0, F.lit(1880)).otherwise(1900 + (key * 37) % 100).cast("int"),
        "Education": F.when(key % 97 == 0, F.lit(None).cast("string")).otherwise(F.col("c_mktsegment")),
        "Marital_Status": F.col("r_name"),
        "Income": F.when(key % 89 == 0, F.lit(None).cast("double")).otherwise(
            (F.col("c_acctbal").cast("decimal(15,2)") * 10).cast("double")
        ),
        "Kidhome": (key % 3).cast("int"),
        "Teenhome": (F.floor(key / 3) % 3).cast("int"),
        "Dt_Customer": F.when(key % 131 == 0, F.lit("99-99-2000")).otherwise(F.date_format("first_date", "dd-MM-yyyy")),
        "Recency": F.datediff(t, F.col("last_date")).cast("int"),
    }
    for name, _ in SPEND_BY_TYPE:
        cols[name] = F.coalesce(F.col(name).cast("double"), F.lit(0.0))
    cols["NumDealsPurchases"] = F.coalesce(F.col("NumDealsPurchases"), F.lit(0)).cast("int")
    for name, _ in CHANNEL_BY_STATUS:
        cols[name] = F.coalesce(F.col(name), F.lit(0)).cast("int")
    cols["NumWebVisitsMonth"] = F.coalesce(F.col("NumWebVisitsMonth"), F.lit(0)).cast("int")
    for i in (3, 4, 5, 1, 2):
        cols[f"AcceptedCmp{i}"] = F.coalesce(F.col(f"AcceptedCmp{i}"), F.lit(0)).cast("int")
    cols["Complain"] = (F.coalesce(F.col("urgent_returns"), F.lit(0)) >= 3).cast("int")
    cols["Z_CostContact"] = F.lit(Z_COST_CONTACT)
    cols["Z_Revenue"] = F.lit(Z_REVENUE)
    cols["Response"] = F.coalesce(F.col("Response"), F.lit(0)).cast("int")
    raw = base.select(*[c.alias(n) for n, c in cols.items()])
    if with_duplicates:
        # every 50th customer twice, produced in the same pass (no second scan)
        copies = F.when(F.col("ID") % 50 == 0, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
        raw = raw.withColumn("_copy", F.explode(copies)).drop("_copy")
    return raw


def reference_date(cutoff: str = CUTOFF) -> _dt.date:
    return _dt.date.fromisoformat(cutoff)
