"""Deterministic cleaning and labels (no statistic is fitted here).

Every output keeps ``customer_id`` as the row key; the reference drops its id
and relies on positions, which Spark does not have.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import row_sum_skip_null
from ..session import require_columns

# Fixed values (reference defaults).
DATE_FORMAT = "dd-MM-yyyy"
DEFAULT_REFERENCE_DATE = "2014-06-29"
DEFAULT_REFERENCE_YEAR = 2014
AGE_BOUNDS = (0, 120)
CONSTANT_COLUMNS = ["Z_CostContact", "Z_Revenue"]
HISTORY_COLUMNS = ["AcceptedCmp1", "AcceptedCmp2", "AcceptedCmp3", "AcceptedCmp4", "AcceptedCmp5"]
RESPONSE_COLUMN = "Response"
LABEL_COLUMN = "label"


def dedup_rows(raw: DataFrame) -> DataFrame:
    """Drop rows that repeat on every raw column (id and constants included)."""
    return raw.dropDuplicates()


def parse_customer_date(c, date_format: str = DATE_FORMAT):
    """Fixed-format parse; malformed text becomes NULL instead of failing (ANSI)."""
    return F.try_to_date(c, date_format)


def tenure_days(df: DataFrame, reference_date: str = DEFAULT_REFERENCE_DATE, date_format: str = DATE_FORMAT):
    """Days from enrolment to the reference date, NULL -> 0, floored at 0."""
    if "Dt_Customer" not in df.columns:
        return F.lit(0)
    dt_type = dict(df.dtypes)["Dt_Customer"]
    parsed = F.col("Dt_Customer") if dt_type in ("date", "timestamp") else parse_customer_date(F.col("Dt_Customer"), date_format)
    days = F.datediff(F.lit(reference_date).cast("date"), parsed)
    return F.greatest(F.coalesce(days, F.lit(0)), F.lit(0))


def age(df: DataFrame, reference_year: int = DEFAULT_REFERENCE_YEAR, bounded: bool = True):
    """C4 (and C8 when ``bounded=False``): reference year - birth year."""
    if "Year_Birth" not in df.columns:
        return F.lit(None).cast("double")
    a = (F.lit(int(reference_year)) - F.col("Year_Birth")).cast("double")
    if not bounded:
        return a
    lo, hi = AGE_BOUNDS
    return F.when(a.between(lo, hi), a)


def income_sanity(c="Income"):
    """Negative income becomes NULL."""
    col = F.col(c).cast("double")
    return F.when(col >= 0, col)


def clean_campaign(
    raw: DataFrame,
    reference_date: str = DEFAULT_REFERENCE_DATE,
    reference_year: int = DEFAULT_REFERENCE_YEAR,
    drop_identifier_columns: bool = True,
    drop_raw_date_columns: bool = True,
    date_format: str = DATE_FORMAT,
    key: str = "ID",
    dedup: bool = True,
) -> DataFrame:
    """Dedup -> tenure -> age -> income rule -> column drops, as one projection.

    The identifier is kept as ``customer_id`` (never a feature). ``dedup=False`` leaves repeated rows,
    which on a stream would need a state that grows for ever.
    """
    out = dedup_rows(raw) if dedup else raw
    out = out.withColumns(
        {
            "customer_tenure_days": tenure_days(out, reference_date, date_format),
            "Age": age(out, reference_year),
        }
    )
    if "Income" in out.columns:
        out = out.withColumn("Income", income_sanity("Income"))
    if key in out.columns:
        out = out.withColumn("customer_id", F.col(key).cast("bigint"))
    drops = [c for c in CONSTANT_COLUMNS if c in out.columns]
    if drop_identifier_columns and key in out.columns:
        drops.append(key)
    if drop_raw_date_columns:
        drops += [c for c in ("Dt_Customer", "Year_Birth") if c in out.columns]
    return out.drop(*drops)


def ensure_age_and_tenure(
    df: DataFrame, reference_date: str = DEFAULT_REFERENCE_DATE, reference_year: int = DEFAULT_REFERENCE_YEAR
) -> DataFrame:
    """Fallback when cleaning was skipped; same formulas, no age bounds."""
    out = df
    if "Age" not in out.columns:
        out = out.withColumn("Age", age(out, reference_year, bounded=False))
    if "customer_tenure_days" not in out.columns:
        out = out.withColumn("customer_tenure_days", tenure_days(out, reference_date))
    return out


def add_label(df: DataFrame, mode: str = "recent", label_col: str = LABEL_COLUMN) -> DataFrame:
    """``recent`` = Response; ``any`` = any past campaign or Response accepted."""
    if mode == "recent":
        require_columns(df, [RESPONSE_COLUMN], "label")
        return df.withColumn(label_col, F.col(RESPONSE_COLUMN).cast("int"))
    if mode == "any":
        cols = HISTORY_COLUMNS + [RESPONSE_COLUMN]
        require_columns(df, cols, "label")
        return df.withColumn(label_col, (row_sum_skip_null(cols) > 0).cast("int"))
    raise ValueError(f"mode is {mode!r}; use 'recent' or 'any'")


def add_response_history(df: DataFrame) -> DataFrame:
    """C11: PastAcceptCnt (sum of the five flags) and EverAccepted."""
    require_columns(df, HISTORY_COLUMNS, "response history")
    cnt = row_sum_skip_null(HISTORY_COLUMNS).cast("int")
    return df.withColumn("PastAcceptCnt", cnt).withColumn("EverAccepted", (F.col("PastAcceptCnt") > 0).cast("int"))
