"""Delimited campaign source with delimiter fallback.

Only the header line is read on the driver to pick the separator (comma if it
yields the expected columns, else the one of tab, ``;`` and ``|`` that yields the
most); the data are then read by Spark's CSV reader with an explicit schema, so nothing but one
line crosses to the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

CANDIDATE_SEPARATORS = [",", "\t", ";", "|"]

RAW_SCHEMA = {
    "ID": T.LongType(), "Year_Birth": T.IntegerType(), "Education": T.StringType(), "Marital_Status": T.StringType(),
    "Income": T.DoubleType(), "Kidhome": T.IntegerType(), "Teenhome": T.IntegerType(), "Dt_Customer": T.StringType(),
    "Recency": T.IntegerType(), "MntWines": T.DoubleType(), "MntFruits": T.DoubleType(),
    "MntMeatProducts": T.DoubleType(), "MntFishProducts": T.DoubleType(), "MntSweetProducts": T.DoubleType(),
    "MntGoldProds": T.DoubleType(), "NumDealsPurchases": T.IntegerType(), "NumWebPurchases": T.IntegerType(),
    "NumCatalogPurchases": T.IntegerType(), "NumStorePurchases": T.IntegerType(), "NumWebVisitsMonth": T.IntegerType(),
    "AcceptedCmp3": T.IntegerType(), "AcceptedCmp4": T.IntegerType(), "AcceptedCmp5": T.IntegerType(),
    "AcceptedCmp1": T.IntegerType(), "AcceptedCmp2": T.IntegerType(), "Complain": T.IntegerType(),
    "Z_CostContact": T.IntegerType(), "Z_Revenue": T.IntegerType(), "Response": T.IntegerType(),
}


def _header(spark: SparkSession, path: str) -> str:
    first = spark.read.text(path).limit(1).collect()  # one line only
    if not first:
        raise ValueError(f"Empty file: {path}")
    return first[0][0]


def pick_separator(header: str, min_expected_columns: int = 10) -> str:
    best, width = ",", len(header.split(","))
    if width >= min_expected_columns:
        return best
    for sep in CANDIDATE_SEPARATORS[1:]:
        w = len(header.split(sep))
        if w > width:
            best, width = sep, w
    if width < min_expected_columns:
        raise ValueError(
            f"Parsed only {width} columns (expected >= {min_expected_columns}); check the delimiter or the file."
        )
    return best


def load_campaign_csv(spark: SparkSession, path: str, min_expected_columns: int = 10) -> DataFrame:
    """Read a delimited campaign file; the enrolment date stays text (parsed in cleaning)."""
    header = _header(spark, path)
    sep = pick_separator(header, min_expected_columns)
    names = [h.strip().strip('"') for h in header.split(sep)]
    schema = T.StructType([T.StructField(n, RAW_SCHEMA.get(n, T.StringType()), True) for n in names])
    return (
        spark.read.schema(schema)
        .option("header", True)
        .option("sep", sep)
        .option("mode", "PERMISSIVE")
        .option("nanValue", "NaN")
        .csv(path)
    )
