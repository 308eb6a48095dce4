"""Dataset check report as one aggregate pass."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.clean import DATE_FORMAT


def data_check(raw: DataFrame, date_col: str = "Dt_Customer", null_columns=(), date_format: str = DATE_FORMAT) -> DataFrame:
    """Rows, columns, parsed-date range, unparsable dates and NULL counts (one row)."""
    d = F.try_to_date(F.col(date_col), date_format) if date_col in raw.columns else F.lit(None).cast("date")
    aggs = [
        F.count(F.lit(1)).alias("n_rows"),
        F.lit(len(raw.columns)).alias("n_columns"),
        F.min(d).cast("string").alias("min_date"),
        F.max(d).cast("string").alias("max_date"),
        F.count(d).alias("n_parsed_dates"),
        (F.count(F.lit(1)) - F.count(d)).alias("n_unparsed_dates"),
    ]
    aggs += [(F.count(F.lit(1)) - F.count(F.col(c))).alias(f"null_{c.lower()}") for c in null_columns]
    return raw.agg(*aggs)


def data_check_report(raw: DataFrame, **kw) -> dict:
    """Driver-side summary with a warning when no date parses (one small row)."""
    row = data_check(raw, **kw).first().asDict()
    row["columns"] = list(raw.columns)
    if row["n_parsed_dates"] == 0:
        row["warning"] = "no enrolment date could be parsed"
    return row
