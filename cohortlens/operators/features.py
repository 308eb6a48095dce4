"""Row-local feature derivation (F1-F9): pure projections, no shuffle."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import count_positive, log1p_nonneg, ratio_or_zero, row_sum_skip_null
from ..session import require_columns
from .clean import add_response_history, ensure_age_and_tenure

# Feature group lists in the reference's order.
BEHAVIOR_NUMERIC_FEATURES = [
    "Recency", "Frequency", "Monetary", "Spent",
    "Income", "Age", "Kidhome", "Teenhome", "Children", "family_size", "has_child", "customer_tenure_days",
    "Avg_Basket", "Deal_Sensitivity", "Online_Intensity", "WebVisits_per_purchase", "Variety_Index",
    "NumWebPurchases", "NumCatalogPurchases", "NumStorePurchases",
    "Web_Ratio", "Catalog_Ratio", "Store_Ratio",
    "Spent_to_income", "Income_per_member", "Spent_per_member",
    "Complain",
]
RESPONSE_NUMERIC_FEATURES = ["NumDealsPurchases", "NumWebVisitsMonth", "PastAcceptCnt", "EverAccepted"]
CATEGORICAL_FEATURES = ["Education", "Marital_Status"]
FREQUENCY_COLUMNS = ["NumWebPurchases", "NumCatalogPurchases", "NumStorePurchases"]
SPEND_COLUMNS = ["MntWines", "MntFruits", "MntMeatProducts", "MntFishProducts", "MntSweetProducts", "MntGoldProds"]
AMOUNT_COLUMNS = ["Income", "Monetary", "Spent"] + SPEND_COLUMNS
RFM_COLUMNS = ["recency", "frequency", "monetary"]


@dataclass
class FeatureConfig:
    """F8: which columns form the behaviour / response / categorical groups."""

    behavior_numeric: list = field(default_factory=lambda: list(BEHAVIOR_NUMERIC_FEATURES))
    response_numeric: list = field(default_factory=lambda: list(RESPONSE_NUMERIC_FEATURES))
    categorical: list = field(default_factory=lambda: list(CATEGORICAL_FEATURES))

    @classmethod
    def default_for(cls, df: DataFrame) -> "FeatureConfig":
        cols = set(df.columns)
        return cls(
            [c for c in BEHAVIOR_NUMERIC_FEATURES if c in cols],
            [c for c in RESPONSE_NUMERIC_FEATURES if c in cols],
            [c for c in CATEGORICAL_FEATURES if c in cols],
        )


def add_rfm(df: DataFrame) -> DataFrame:
    """Frequency, Monetary, Spent (= Monetary); Recency must exist."""
    require_columns(df, FREQUENCY_COLUMNS, "Frequency")
    require_columns(df, SPEND_COLUMNS, "Monetary")
    require_columns(df, ["Recency"], "RFM")
    return df.withColumns(
        {
            "Frequency": row_sum_skip_null(FREQUENCY_COLUMNS),
            "Monetary": row_sum_skip_null(SPEND_COLUMNS).cast("double"),
        }
    ).withColumn("Spent", F.col("Monetary"))


def add_structural(df: DataFrame) -> DataFrame:
    """Household, basket, channel, variety and income ratios (on raw amounts)."""
    require_columns(df, ["Frequency", "Spent"], "structural features")
    require_columns(df, FREQUENCY_COLUMNS, "channel features")
    cols = set(df.columns)
    kid = F.col("Kidhome") if "Kidhome" in cols else F.lit(0)
    teen = F.col("Teenhome") if "Teenhome" in cols else F.lit(0)
    freq = F.col("Frequency")
    null = F.lit(None).cast("double")
    out = df.withColumn("Children", kid + teen)
    out = out.withColumns(
        {
            "family_size": F.lit(1) + F.col("Children"),
            "has_child": F.coalesce(F.col("Children") > 0, F.lit(False)).cast("int"),
        }
    )
    fam = F.col("family_size").cast("double")
    income = F.col("Income").cast("double")
    return out.withColumns(
        {
            "Avg_Basket": ratio_or_zero(F.col("Spent"), freq),
            "Deal_Sensitivity": ratio_or_zero(F.col("NumDealsPurchases"), freq) if "NumDealsPurchases" in cols else F.lit(0.0),
            "Online_Intensity": ratio_or_zero(F.col("NumWebPurchases"), freq),
            "WebVisits_per_purchase": ratio_or_zero(F.col("NumWebVisitsMonth"), freq) if "NumWebVisitsMonth" in cols else F.lit(0.0),
            "Web_Ratio": ratio_or_zero(F.col("NumWebPurchases"), freq),
            "Catalog_Ratio": ratio_or_zero(F.col("NumCatalogPurchases"), freq),
            "Store_Ratio": ratio_or_zero(F.col("NumStorePurchases"), freq),
            "Variety_Index": count_positive([c for c in SPEND_COLUMNS if c in cols]),
            "Spent_to_income": F.when(income > 0, F.try_divide(F.col("Spent").cast("double"), income)) if "Income" in cols else null,
            "Income_per_member": F.try_divide(income, fam) if "Income" in cols else null,
            "Spent_per_member": F.try_divide(F.col("Spent").cast("double"), fam) if "Income" in cols else null,
        }
    )


def log_amounts(df: DataFrame) -> DataFrame:
    """``log1p(max(x, 0))`` on the long-tailed amounts, after the ratios."""
    return df.withColumns({c: log1p_nonneg(F.col(c)) for c in AMOUNT_COLUMNS if c in df.columns})


def derive_features(df: DataFrame, reference_date=None, reference_year=None) -> DataFrame:
    """Derivations of T6 step 0: only what is missing is computed."""
    kwargs = {}
    if reference_date is not None:
        kwargs["reference_date"] = reference_date
    if reference_year is not None:
        kwargs["reference_year"] = reference_year
    out = ensure_age_and_tenure(df, **kwargs)
    if any(c not in out.columns for c in ("Frequency", "Monetary", "Spent")):
        out = add_rfm(out)
    needed = ["family_size", "Avg_Basket", "Variety_Index", "Web_Ratio", "Catalog_Ratio", "Store_Ratio"]
    if any(c not in out.columns for c in needed):
        out = add_structural(out)
    if any(c not in out.columns for c in ("PastAcceptCnt", "EverAccepted")):
        out = add_response_history(out)
    return out
