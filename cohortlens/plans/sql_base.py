"""Shared ANSI-SQL (DuckDB dialect) derivations used by the oracle queries.

Each oracle is ``WITH <base CTEs> SELECT ...`` over the pre-registered test
tables, so the SQL side recomputes everything from the same parquet inputs.
"""

from __future__ import annotations

from ..sources.campaign import CAMPAIGN_MONTHS, CHANNEL_BY_STATUS, CUTOFF, SPEND_BY_TYPE

T = CUTOFF
REF_YEAR = 2001

_net = "CAST(l_extendedprice AS DECIMAL(15,2)) * (CAST(1 AS DECIMAL(3,2)) - CAST(l_discount AS DECIMAL(4,2)))"

_ostats = (
    "ostats AS (SELECT o_custkey, "
    f"min(CASE WHEN o_orderdate < TIMESTAMP '{T}' THEN CAST(o_orderdate AS DATE) END) AS first_date, "
    f"max(CASE WHEN o_orderdate < TIMESTAMP '{T}' THEN CAST(o_orderdate AS DATE) END) AS last_date, "
    + ", ".join(
        f"count(CASE WHEN o_orderdate < TIMESTAMP '{T}' AND o_orderstatus = '{s}' THEN 1 END) AS {n}"
        for n, s in CHANNEL_BY_STATUS
    )
    + ", "
    + ", ".join(
        f"max(CASE WHEN o_orderdate < TIMESTAMP '{T}' AND year(o_orderdate) = {T[:4]} AND month(o_orderdate) = {m} "
        f"THEN 1 ELSE 0 END) AS AcceptedCmp{i}"
        for i, m in enumerate(CAMPAIGN_MONTHS, start=1)
    )
    + f", max(CASE WHEN o_orderdate >= TIMESTAMP '{T}' THEN 1 ELSE 0 END) AS Response "
    "FROM orders GROUP BY o_custkey)"
)

_per_order = (
    "per_order AS (SELECT l_orderkey, "
    + ", ".join(f"sum(CASE WHEN p_type = '{t}' THEN {_net} END) AS {n}" for n, t in SPEND_BY_TYPE)
    + ", max(CAST(l_discount >= 0.09 AS INTEGER)) AS has_deal, max(CAST(l_returnflag = 'R' AS INTEGER)) AS has_return "
    "FROM lineitem LEFT JOIN part ON l_partkey = p_partkey GROUP BY l_orderkey)"
)

_lstats = (
    "lstats AS (SELECT o_custkey, "
    + ", ".join(f"round(sum({n}), 2) AS {n}" for n, _ in SPEND_BY_TYPE)
    + ", sum(has_deal) AS NumDealsPurchases, "
    "sum(CASE WHEN o_orderpriority = '1-URGENT' THEN has_return ELSE 0 END) AS urgent_returns "
    f"FROM per_order JOIN orders ON l_orderkey = o_orderkey WHERE o_orderdate < TIMESTAMP '{T}' GROUP BY o_custkey)"
)

_visits = (
    "visits AS (SELECT user_id AS v_user, count(*) AS NumWebVisitsMonth FROM events "
    "WHERE event_type = 'view' GROUP BY user_id)"
)

_raw0 = (
    "raw0 AS (SELECT CAST(c_custkey AS BIGINT) AS ID, "
    "CAST(CASE WHEN c_custkey % 211 = 0 THEN 1880 ELSE 1900 + (c_custkey * 37) % 100 END AS INTEGER) AS Year_Birth, "
    "CASE WHEN c_custkey % 97 = 0 THEN NULL ELSE c_mktsegment END AS Education, "
    "r_name AS Marital_Status, "
    "CASE WHEN c_custkey % 89 = 0 THEN NULL ELSE CAST(CAST(c_acctbal AS DECIMAL(15,2)) * 10 AS DOUBLE) END AS Income, "
    "CAST(c_custkey % 3 AS INTEGER) AS Kidhome, CAST((c_custkey // 3) % 3 AS INTEGER) AS Teenhome, "
    "CASE WHEN c_custkey % 131 = 0 THEN '99-99-2000' ELSE strftime(first_date, '%d-%m-%Y') END AS Dt_Customer, "
    f"CAST(date_diff('day', last_date, DATE '{T}') AS INTEGER) AS Recency, "
    + ", ".join(f"coalesce(CAST(l.{n} AS DOUBLE), 0.0) AS {n}" for n, _ in SPEND_BY_TYPE)
    + ", CAST(coalesce(l.NumDealsPurchases, 0) AS INTEGER) AS NumDealsPurchases, "
    + ", ".join(f"CAST(coalesce(o.{n}, 0) AS INTEGER) AS {n}" for n, _ in CHANNEL_BY_STATUS)
    + ", CAST(coalesce(v.NumWebVisitsMonth, 0) AS INTEGER) AS NumWebVisitsMonth, "
    + ", ".join(f"CAST(coalesce(o.AcceptedCmp{i}, 0) AS INTEGER) AS AcceptedCmp{i}" for i in (3, 4, 5, 1, 2))
    + ", CAST(coalesce(l.urgent_returns, 0) >= 3 AS INTEGER) AS Complain, 3 AS Z_CostContact, 11 AS Z_Revenue, "
    "CAST(coalesce(o.Response, 0) AS INTEGER) AS Response "
    "FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey "
    "LEFT JOIN ostats o ON c_custkey = o.o_custkey LEFT JOIN lstats l ON c_custkey = l.o_custkey "
    "LEFT JOIN visits v ON c_custkey = v.v_user)"
)

_raw = "raw AS (SELECT * FROM raw0 UNION ALL SELECT * FROM raw0 WHERE ID % 50 = 0)"

_clean = (
    "clean AS (SELECT ID AS customer_id, Education, Marital_Status, "
    "CASE WHEN Income >= 0 THEN Income END AS Income, Kidhome, Teenhome, Recency, "
    "MntWines, MntFruits, MntMeatProducts, MntFishProducts, MntSweetProducts, MntGoldProds, "
    "NumDealsPurchases, NumWebPurchases, NumCatalogPurchases, NumStorePurchases, NumWebVisitsMonth, "
    "AcceptedCmp3, AcceptedCmp4, AcceptedCmp5, AcceptedCmp1, AcceptedCmp2, Complain, Response, "
    f"greatest(coalesce(date_diff('day', CAST(try_strptime(Dt_Customer, '%d-%m-%Y') AS DATE), DATE '{T}'), 0), 0) "
    "AS customer_tenure_days, "
    f"CASE WHEN {REF_YEAR} - Year_Birth BETWEEN 0 AND 120 THEN CAST({REF_YEAR} - Year_Birth AS DOUBLE) END AS Age "
    "FROM (SELECT DISTINCT * FROM raw) d)"
)


def _ratio(num: str) -> str:
    return f"coalesce(CAST({num} AS DOUBLE) / CAST(nullif(Frequency, 0) AS DOUBLE), 0.0)"


_feat = (
    "feat0 AS (SELECT *, "
    "CAST(coalesce(NumWebPurchases, 0) + coalesce(NumCatalogPurchases, 0) + coalesce(NumStorePurchases, 0) AS BIGINT) "
    "AS Frequency, "
    "CAST(coalesce(MntWines, 0) + coalesce(MntFruits, 0) + coalesce(MntMeatProducts, 0) + coalesce(MntFishProducts, 0) "
    "+ coalesce(MntSweetProducts, 0) + coalesce(MntGoldProds, 0) AS DOUBLE) AS Monetary, "
    "Kidhome + Teenhome AS Children, "
    "CAST(coalesce(AcceptedCmp1, 0) + coalesce(AcceptedCmp2, 0) + coalesce(AcceptedCmp3, 0) + coalesce(AcceptedCmp4, 0) "
    "+ coalesce(AcceptedCmp5, 0) AS INTEGER) AS PastAcceptCnt "
    "FROM clean), "
    "feat AS (SELECT *, Monetary AS Spent, 1 + Children AS family_size, "
    "CAST(coalesce(Children > 0, false) AS INTEGER) AS has_child, "
    f"{_ratio('Monetary')} AS Avg_Basket, {_ratio('NumDealsPurchases')} AS Deal_Sensitivity, "
    f"{_ratio('NumWebPurchases')} AS Online_Intensity, {_ratio('NumWebVisitsMonth')} AS WebVisits_per_purchase, "
    f"{_ratio('NumWebPurchases')} AS Web_Ratio, {_ratio('NumCatalogPurchases')} AS Catalog_Ratio, "
    f"{_ratio('NumStorePurchases')} AS Store_Ratio, "
    "CAST(coalesce(MntWines > 0, false) AS INTEGER) + CAST(coalesce(MntFruits > 0, false) AS INTEGER) "
    "+ CAST(coalesce(MntMeatProducts > 0, false) AS INTEGER) + CAST(coalesce(MntFishProducts > 0, false) AS INTEGER) "
    "+ CAST(coalesce(MntSweetProducts > 0, false) AS INTEGER) + CAST(coalesce(MntGoldProds > 0, false) AS INTEGER) "
    "AS Variety_Index, "
    "CASE WHEN Income > 0 THEN Monetary / Income END AS Spent_to_income, "
    "Income / CAST(1 + Children AS DOUBLE) AS Income_per_member, "
    "Monetary / CAST(1 + Children AS DOUBLE) AS Spent_per_member, "
    "CAST(PastAcceptCnt > 0 AS INTEGER) AS EverAccepted, CAST(Response AS INTEGER) AS label "
    "FROM feat0)"
)

# scored frame (FIXTURES.md §3): rule clusters, a logistic score with ties and four soft memberships
_scored = (
    "scored0 AS (SELECT customer_id, label, "
    "2 * CAST(coalesce(Recency, 9999) <= 180 AS INTEGER) + CAST(Frequency >= 10 AS INTEGER) AS cluster, "
    "CAST(-2.0 AS DOUBLE) + CAST(0.1 AS DOUBLE) * CAST(Frequency - 10 AS DOUBLE) "
    "+ CAST(0.3 AS DOUBLE) * CAST(PastAcceptCnt AS DOUBLE) "
    "- CAST(0.0005 AS DOUBLE) * CAST(coalesce(Recency, 2000) - 250 AS DOUBLE) AS z "
    "FROM feat), "
    "scored AS (SELECT customer_id, label, cluster, z, "
    "floor(CAST(1.0 AS DOUBLE) / (CAST(1.0 AS DOUBLE) + exp(-z)) * CAST(10000.0 AS DOUBLE) + CAST(0.5 AS DOUBLE)) "
    "/ CAST(10000.0 AS DOUBLE) AS score, "
    "list_transform([CAST(-3.0 AS DOUBLE), CAST(-2.5 AS DOUBLE), CAST(-2.0 AS DOUBLE), CAST(-1.0 AS DOUBLE)], "
    "lambda c: exp(-abs(z - c))) AS qe FROM scored0)"
)

BASE_CTES = ",\n".join([_ostats, _per_order, _lstats, _visits, _raw0, _raw, _clean, _feat, _scored])


def with_base(select_sql: str, extra_ctes: str = "") -> str:
    """Prefix a query with the shared derivation CTEs."""
    extra = f",\n{extra_ctes}" if extra_ctes else ""
    return f"WITH {BASE_CTES}{extra}\n{select_sql}"


# ---------------------------------------------------------------- splits and train-fitted transforms
def dbl(x: float) -> str:
    """A double literal both engines read as the same IEEE value."""
    return f"CAST('{float(x)!r}' AS DOUBLE)"


def split_ctes(test_size: float = 0.2, val_size: float = 0.1, seed: int = 42, two_way: bool = False) -> str:
    """CTE ``sp`` (customer_id, label, split) with the exact-count stratified md5 split."""
    rel = float(val_size) / (1.0 - float(test_size))
    need_a = f"CAST(ceil({dbl(val_size if two_way else test_size)} * n) AS BIGINT)"
    first = "val" if two_way else "test"
    parts = [
        f"spb AS (SELECT customer_id, label, coalesce(CAST(label AS VARCHAR), '~null') AS s, "
        f"md5('{seed}' || '|' || CAST(customer_id AS VARCHAR)) AS h FROM feat)",
        "spc1 AS (SELECT s, count(*) AS ns FROM spb GROUP BY s)",
        f"spc2 AS (SELECT s, ns, sum(ns) OVER () AS n, {need_a.replace('n)', '(sum(ns) OVER ()))')} AS need_a FROM spc1)",
        "spc3 AS (SELECT *, (ns * need_a) // n AS base_a, (ns * need_a) % n AS rem_a FROM spc2)",
        "spc4 AS (SELECT *, base_a + CAST(row_number() OVER (ORDER BY rem_a DESC, s ASC) <= need_a - sum(base_a) OVER () AS BIGINT) AS a FROM spc3)",
    ]
    if two_way:
        parts.append("spc7 AS (SELECT s, ns, a, CAST(0 AS BIGINT) AS b FROM spc4)")
    else:
        parts += [
            f"spc5 AS (SELECT *, ns - a AS rest_s, n - need_a AS rest, CAST(ceil({dbl(rel)} * (n - need_a)) AS BIGINT) AS need_b FROM spc4)",
            "spc6 AS (SELECT *, (rest_s * need_b) // rest AS base_b, (rest_s * need_b) % rest AS rem_b FROM spc5)",
            "spc7 AS (SELECT s, ns, a, base_b + CAST(row_number() OVER (ORDER BY rem_b DESC, s ASC) <= need_b - sum(base_b) OVER () AS BIGINT) AS b FROM spc6)",
        ]
    parts += [
        "sprk AS (SELECT spb.*, row_number() OVER (PARTITION BY s ORDER BY h ASC, customer_id ASC) AS r FROM spb)",
        f"sp AS (SELECT customer_id, label, CASE WHEN r <= a THEN '{first}' WHEN r <= a + b THEN 'val' ELSE 'train' END AS split "
        "FROM sprk JOIN spc7 USING (s))",
    ]
    return ", ".join(parts)


def transform_ctes(numeric, categorical, amounts, lo=0.01, hi=0.99) -> str:
    """CTEs ``lg`` (logged features + split), ``imp``, ``clp``, ``tf`` (standardised) and ``cats``."""
    repl = ", ".join(f"CASE WHEN {c} IS NOT NULL THEN ln(1 + greatest(CAST({c} AS DOUBLE), 0.0)) END AS {c}" for c in amounts)
    lg = f"lg AS (SELECT f.* REPLACE ({repl}), sp.split FROM feat f JOIN sp USING (customer_id))"
    prm1 = "prm1 AS (SELECT " + ", ".join(f"quantile_cont(CAST({c} AS DOUBLE), 0.5) AS m_{c}" for c in numeric) + " FROM lg WHERE split = 'train')"
    modes = ", ".join(
        f"mode_{c} AS (SELECT {c} AS v FROM lg WHERE split = 'train' AND {c} IS NOT NULL GROUP BY {c} ORDER BY count(*) DESC, {c} ASC LIMIT 1)"
        for c in categorical
    )
    imp = (
        "imp AS (SELECT customer_id, split, label, "
        + ", ".join(f"coalesce(CAST({c} AS DOUBLE), m_{c}) AS {c}" for c in numeric)
        + (", " if categorical else "")
        + ", ".join(f"coalesce({c}, (SELECT v FROM mode_{c})) AS {c}" for c in categorical)
        + " FROM lg, prm1)"
    )
    prm2 = (
        "prm2 AS (SELECT "
        + ", ".join(f"quantile_cont({c}, [{dbl(lo)}, {dbl(hi)}]) AS q_{c}" for c in numeric)
        + " FROM imp WHERE split = 'train')"
    )
    clp = (
        "clp AS (SELECT customer_id, split, label, "
        + ", ".join(f"least(greatest({c}, q_{c}[1]), q_{c}[2]) AS {c}" for c in numeric)
        + (", " if categorical else "") + ", ".join(categorical)
        + " FROM imp, prm2)"
    )
    prm3 = (
        "prm3 AS (SELECT "
        + ", ".join(f"avg({c}) AS a_{c}, stddev_pop({c}) AS s_{c}" for c in numeric)
        + " FROM clp WHERE split = 'train')"
    )
    tf = (
        "tf AS (SELECT customer_id, split, label, "
        + ", ".join(f"({c} - a_{c}) / (CASE WHEN s_{c} IS NULL OR s_{c} = 0 THEN 1.0 ELSE s_{c} END) AS {c}" for c in numeric)
        + (", " if categorical else "") + ", ".join(categorical)
        + " FROM clp, prm3)"
    )
    cats = "cats AS (" + " UNION ALL ".join(
        f"SELECT DISTINCT '{c}' AS col, {c} AS v FROM imp WHERE split = 'train' AND {c} IS NOT NULL" for c in categorical
    ) + ")"
    return ", ".join([lg, prm1, modes, imp, prm2, clp, prm3, tf, cats])
