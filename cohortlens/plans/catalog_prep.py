"""Registered queries: sources, cleaning, labels and feature derivation (S, C, F rows)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators.clean import add_label, clean_campaign, dedup_rows, parse_customer_date
from ..operators.features import AMOUNT_COLUMNS, log_amounts
from ..sources.campaign import CUTOFF, RAW_COLUMNS, REFERENCE_YEAR, campaign_raw
from ..sources.check import data_check
from .catalog import register, sd, si, ss, tidy
from .frames import campaign_clean, campaign_features
from .sql_base import with_base

INT_RAW = {
    "ID", "Year_Birth", "Kidhome", "Teenhome", "Recency", "NumDealsPurchases", "NumWebPurchases",
    "NumCatalogPurchases", "NumStorePurchases", "NumWebVisitsMonth", "AcceptedCmp3", "AcceptedCmp4",
    "AcceptedCmp5", "AcceptedCmp1", "AcceptedCmp2", "Complain", "Z_CostContact", "Z_Revenue", "Response",
}
STR_RAW = {"Education", "Marital_Status", "Dt_Customer"}


def _raw_sql_cols(src_cols):
    out = []
    for c in src_cols:
        if c in INT_RAW:
            out.append(si(c, c))
        elif c in STR_RAW:
            out.append(ss(c, c))
        else:
            out.append(sd(c, c))
    return ", ".join(out)


def _clean_with_raw(spark, sf_dir):
    """Cleaned rows that keep the raw date and birth columns and the raw income: one derivation."""
    raw = campaign_raw(spark, sf_dir).withColumn("income_raw", F.col("Income"))
    return clean_campaign(raw, CUTOFF, REFERENCE_YEAR, drop_raw_date_columns=False)


@register("load_campaign", with_base(f"SELECT {_raw_sql_cols(RAW_COLUMNS)} FROM raw"))
def q_load_campaign(spark, sf_dir):
    """Raw 29-column campaign table including the duplicated rows."""
    return tidy(campaign_raw(spark, sf_dir))


@register("dedup_rows", with_base(f"SELECT {_raw_sql_cols(RAW_COLUMNS)} FROM (SELECT DISTINCT * FROM raw) d"))
def q_dedup_rows(spark, sf_dir):
    return tidy(dedup_rows(campaign_raw(spark, sf_dir)))


@register(
    "tenure_days",
    with_base(
        "SELECT " + ", ".join([
            si("ID", "customer_id"), ss("Dt_Customer", "Dt_Customer"),
            ss("CAST(try_strptime(Dt_Customer, '%d-%m-%Y') AS DATE)", "enrolled"),
            si(f"greatest(coalesce(date_diff('day', CAST(try_strptime(Dt_Customer, '%d-%m-%Y') AS DATE), DATE '{CUTOFF}'), 0), 0)",
               "customer_tenure_days"),
        ]) + " FROM (SELECT DISTINCT * FROM raw) d"
    ),
)
def q_tenure_days(spark, sf_dir):
    rows = _clean_with_raw(spark, sf_dir)
    enrolled = parse_customer_date(F.col("Dt_Customer")).cast("string").alias("enrolled")
    return tidy(rows.select("customer_id", "Dt_Customer", enrolled, "customer_tenure_days"))


@register(
    "age_bounds",
    with_base(
        "SELECT " + ", ".join([si("ID", "customer_id"), si("Year_Birth", "Year_Birth"),
                               sd("CASE WHEN 2001 - Year_Birth BETWEEN 0 AND 120 THEN 2001 - Year_Birth END", "Age")])
        + " FROM (SELECT DISTINCT * FROM raw) d"
    ),
)
def q_age_bounds(spark, sf_dir):
    return tidy(_clean_with_raw(spark, sf_dir).select("customer_id", "Year_Birth", "Age"))


@register(
    "income_sanity",
    with_base(
        "SELECT " + ", ".join([si("ID", "customer_id"), sd("Income", "income_raw"),
                               sd("CASE WHEN Income >= 0 THEN Income END", "Income")])
        + " FROM (SELECT DISTINCT * FROM raw) d"
    ),
)
def q_income_sanity(spark, sf_dir):
    return tidy(_clean_with_raw(spark, sf_dir).select("customer_id", "income_raw", "Income"))


CLEAN_COLUMNS = [
    "customer_id", "Education", "Marital_Status", "Income", "Kidhome", "Teenhome", "Recency",
    "MntWines", "MntFruits", "MntMeatProducts", "MntFishProducts", "MntSweetProducts", "MntGoldProds",
    "NumDealsPurchases", "NumWebPurchases", "NumCatalogPurchases", "NumStorePurchases", "NumWebVisitsMonth",
    "AcceptedCmp3", "AcceptedCmp4", "AcceptedCmp5", "AcceptedCmp1", "AcceptedCmp2", "Complain", "Response",
    "customer_tenure_days", "Age",
]
_INT_CLEAN = INT_RAW | {"customer_id", "customer_tenure_days"}


def _sql_cols(cols, ints=(), strs=()):
    out = []
    for c in cols:
        if c in ints:
            out.append(si(c, c))
        elif c in strs:
            out.append(ss(c, c))
        else:
            out.append(sd(c, c))
    return ", ".join(out)


@register("clean_campaign", with_base(f"SELECT {_sql_cols(CLEAN_COLUMNS, _INT_CLEAN, STR_RAW)} FROM clean"))
def q_clean_campaign(spark, sf_dir):
    return tidy(campaign_clean(spark, sf_dir).select(*CLEAN_COLUMNS))


@register("label_recent", with_base(f"SELECT {si('customer_id', 'customer_id')}, {si('Response', 'label')} FROM clean"))
def q_label_recent(spark, sf_dir):
    return tidy(add_label(campaign_clean(spark, sf_dir), "recent").select("customer_id", "label"))


@register(
    "label_any",
    with_base(
        f"SELECT {si('customer_id', 'customer_id')}, "
        + si("coalesce(AcceptedCmp1,0)+coalesce(AcceptedCmp2,0)+coalesce(AcceptedCmp3,0)+coalesce(AcceptedCmp4,0)"
             "+coalesce(AcceptedCmp5,0)+coalesce(Response,0) > 0", "label")
        + " FROM clean"
    ),
)
def q_label_any(spark, sf_dir):
    return tidy(add_label(campaign_clean(spark, sf_dir), "any").select("customer_id", "label"))


def _feat_query(name, cols, ints=()):
    ints = set(ints) | {"customer_id"}
    sql = with_base(f"SELECT {_sql_cols(['customer_id'] + cols, ints)} FROM feat")

    @register(name, sql)
    def q(spark, sf_dir):
        return tidy(campaign_features(spark, sf_dir).select("customer_id", *cols))

    q.__name__ = f"q_{name}"
    return q


_feat_query("response_history", ["PastAcceptCnt", "EverAccepted"], ["PastAcceptCnt", "EverAccepted"])
_feat_query("rfm", ["Recency", "Frequency", "Monetary", "Spent"], ["Recency", "Frequency"])
_feat_query("household_features", ["Children", "family_size", "has_child"], ["Children", "family_size", "has_child"])
_feat_query("basket_ratios", ["Avg_Basket", "Deal_Sensitivity", "Online_Intensity", "WebVisits_per_purchase"])
_feat_query("channel_ratios", ["Web_Ratio", "Catalog_Ratio", "Store_Ratio"])
_feat_query("variety_index", ["Variety_Index"], ["Variety_Index"])
_feat_query("income_ratios", ["Spent_to_income", "Income_per_member", "Spent_per_member"])


@register(
    "log_amounts",
    with_base(
        "SELECT " + si("customer_id", "customer_id") + ", "
        + ", ".join(sd(f"CASE WHEN {c} IS NOT NULL THEN ln(1 + greatest({c}, 0.0)) END", c) for c in AMOUNT_COLUMNS)
        + " FROM feat"
    ),
)
def q_log_amounts(spark, sf_dir):
    return tidy(log_amounts(campaign_features(spark, sf_dir)).select("customer_id", *AMOUNT_COLUMNS))


@register(
    "data_check",
    with_base(
        "SELECT " + ", ".join([
            si("count(*)", "n_rows"), si(len(RAW_COLUMNS), "n_columns"),
            ss("min(CAST(try_strptime(Dt_Customer, '%d-%m-%Y') AS DATE))", "min_date"),
            ss("max(CAST(try_strptime(Dt_Customer, '%d-%m-%Y') AS DATE))", "max_date"),
            si("count(try_strptime(Dt_Customer, '%d-%m-%Y'))", "n_parsed_dates"),
            si("count(*) - count(try_strptime(Dt_Customer, '%d-%m-%Y'))", "n_unparsed_dates"),
            si("count(*) - count(Income)", "null_income"),
            si("count(*) - count(Education)", "null_education"),
            si("count(*) - count(Recency)", "null_recency"),
        ]) + " FROM raw"
    ),
)
def q_data_check(spark, sf_dir):
    return tidy(data_check(campaign_raw(spark, sf_dir), null_columns=["Income", "Education", "Recency"]))
