"""Cleaning, features, splits, transforms and the delimited source on small frames."""

import os
import tempfile

import pytest
from pyspark.sql import functions as F

from cohortlens.operators import clean, features, split, transform
from cohortlens.sources import delimited


def test_bad_dates(spark):
    df = spark.createDataFrame([("04-09-2012",), ("2012-09-04",), ("99-99-2012",), (None,)], "Dt_Customer string")
    out = [r[0] for r in df.select(clean.parse_customer_date(F.col("Dt_Customer")).cast("string")).collect()]
    assert out == ["2012-09-04", None, None, None]
    t = [r[0] for r in df.select(clean.tenure_days(df, "2012-09-14")).collect()]
    assert t == [10, 0, 0, 0]


def test_zero_frequency_and_null_parts(spark):
    cols = "Recency int, NumWebPurchases int, NumCatalogPurchases int, NumStorePurchases int, NumDealsPurchases int, " \
           "NumWebVisitsMonth int, Kidhome int, Teenhome int, Income double, " + ", ".join(f"{c} double" for c in features.SPEND_COLUMNS)
    rows = [(10, 0, 0, 0, 2, 5, 1, 0, 100.0, 0.0, 0.0, 0.0, 0.0, 0.0, 0.0),
            (10, 2, 1, 1, 1, 3, None, 1, -5.0, 10.0, None, 5.0, 0.0, 0.0, 1.0)]
    df = spark.createDataFrame(rows, cols)
    out = features.add_structural(features.add_rfm(df)).collect()
    z = out[0]
    for c in ("Avg_Basket", "Deal_Sensitivity", "Online_Intensity", "WebVisits_per_purchase", "Web_Ratio", "Catalog_Ratio", "Store_Ratio"):
        assert z[c] == 0.0
    n = out[1]
    assert n["Monetary"] == 16.0  # NULL spend skipped in the sum
    assert n["Children"] is None and n["has_child"] == 0 and n["family_size"] is None
    assert n["Spent_to_income"] is None  # income <= 0
    assert n["Variety_Index"] == 3


def test_split_exact_and_stable(spark):
    df = spark.range(1000).select(F.col("id").alias("customer_id"), (F.col("id") % 7 == 0).cast("int").alias("label"))
    a = split.assign_splits(df).select("customer_id", "split")
    b = split.assign_splits(df.repartition(13)).select("customer_id", "split")
    ra = {r[0]: r[1] for r in a.collect()}
    rb = {r[0]: r[1] for r in b.collect()}
    assert ra == rb
    counts = {s: list(ra.values()).count(s) for s in ("train", "val", "test")}
    assert (counts["train"], counts["val"], counts["test"]) == split.expected_sizes(1000)
    assert split.expected_sizes(2240) == (1568, 224, 448)
    with pytest.raises(ValueError):
        split.assign_splits(df, test_size=0.6, val_size=0.5)


def test_transform_constant_and_unseen(spark):
    train = spark.createDataFrame([(1.0, "a"), (1.0, "b"), (1.0, "a")], "x double, c string")
    other = spark.createDataFrame([(5.0, "z"), (None, None)], "x double, c string")
    cfg = features.FeatureConfig(["x"], [], ["c"])
    ft = transform.fit_transform_params(train, cfg)
    assert ft.stds["x"] == 0.0 and ft.categories["c"] == ["a", "b"]
    rows = transform.apply_transform(other, ft).collect()
    assert rows[0]["x"] == 0.0  # clipped to the train bound, scale 1
    assert rows[0]["c_a"] == 0.0 and rows[0]["c_b"] == 0.0  # unseen -> all zero
    assert rows[1]["c_a"] == 1.0  # NULL -> train mode
    with pytest.raises(ValueError):
        transform.fit_transform_params(train, cfg, clip_quantiles=(0.9, 0.1))


def test_delimited_fallback(spark):
    d = tempfile.mkdtemp(prefix="cl-csv-", dir="/tmp")
    header = list(delimited.RAW_SCHEMA)
    row = ["1", "1970", "PhD", "Single", "1000.5", "0", "1", "04-09-2012", "10"] + ["1"] * (len(header) - 9)
    for name, sep in (("semicolon.csv", ";"), ("tab.csv", "\t")):
        with open(os.path.join(d, name), "w") as fh:
            fh.write(sep.join(header) + "\n" + sep.join(row) + "\n")
        df = delimited.load_campaign_csv(spark, os.path.join(d, name))
        r = df.first()
        assert len(df.columns) == len(header) and r["Income"] == 1000.5 and r["Dt_Customer"] == "04-09-2012"
    with open(os.path.join(d, "narrow.csv"), "w") as fh:
        fh.write("a,b\n1,2\n")
    with pytest.raises(ValueError):
        delimited.load_campaign_csv(spark, os.path.join(d, "narrow.csv"))


def test_comma_comes_first():
    assert delimited.pick_separator(",".join("abcdefghij") + ";;;;;;;;;;;;") == ","
    assert delimited.pick_separator("|".join("abcdefghijkl") + ",") == "|"


def test_labels(spark):
    df = spark.createDataFrame([(0, 0, 0, 0, 1, 0), (0, 0, 0, 0, 0, 0)], "AcceptedCmp1 int, AcceptedCmp2 int, AcceptedCmp3 int, AcceptedCmp4 int, AcceptedCmp5 int, Response int")
    assert [r["label"] for r in clean.add_label(df, "any").collect()] == [1, 0]
    assert [r["label"] for r in clean.add_label(df, "recent").collect()] == [0, 0]
    with pytest.raises(ValueError):
        clean.add_label(df, "other")


def test_sinks_write_and_read_back(spark, tmp_path):
    from cohortlens.sources import sinks

    rows = spark.createDataFrame([(1, 0, "train"), (2, 1, "val"), (3, None, "test")], "customer_id long, cluster int, split string")
    sinks.write_assignments(rows, f"{tmp_path}/assign")
    back = {(r["customer_id"], r["cluster"], r["split"]) for r in sinks.read_assignments(spark, f"{tmp_path}/assign").collect()}
    assert back == {(1, 0, "train"), (2, 1, "val"), (3, None, "test")}
    metrics = spark.createDataFrame([("a", {"0": 0.5})], "model string, rates map<string,double>")
    sinks.write_table(metrics, f"{tmp_path}/csv", "csv")
    assert spark.read.option("header", True).csv(f"{tmp_path}/csv").first()["rates"].startswith("{")
    sinks.write_table(metrics, f"{tmp_path}/parquet")
    assert spark.read.parquet(f"{tmp_path}/parquet").first()["rates"] == {"0": 0.5}


def test_columns_are_found_by_case_and_alias(spark):
    from cohortlens.functions.columns import column_name, resolved
    from cohortlens.operators import profiles

    df = spark.createDataFrame([(0, 3.0, 1.0, 0.0), (1, 1.0, 1.0, 2.0)], "cluster int, NUMWEBPURCHASES double, catalog double, NumStorePurchases double")
    assert column_name(df, "NumWebPurchases") == "NUMWEBPURCHASES"
    assert column_name(df, "NumCatalogPurchases", ("Catalogue", "Catalog")) == "catalog"
    assert column_name(df, "catalog", ("NumStorePurchases",)) == "catalog"
    with pytest.raises(KeyError):
        column_name(df, "Recency", ("days",))
    assert resolved(df, ["numwebpurchases"]).columns == ["cluster", "catalog", "NumStorePurchases", "numwebpurchases"]
    mix = {r["cluster"]: r for r in profiles.channel_mix(df, aliases={"NumCatalogPurchases": ["Catalog"]}).collect()}
    assert mix[0]["NumWebPurchases"] == 0.75 and mix[1]["NumStorePurchases"] == 0.5


def test_labels_align_by_key_or_raise(spark):
    from cohortlens.operators import segment

    df = spark.createDataFrame([(1, 0), (2, 1), (3, 1)], "customer_id long, label int")
    labels = spark.createDataFrame([(3, 2), (1, 0), (2, 0), (9, 1)], "customer_id long, cluster int")
    assert {(r["customer_id"], r["cluster"]) for r in segment.with_labels(df, labels).collect()} == {(1, 0), (2, 0), (3, 2)}
    for bad in (labels.filter("customer_id <> 2"), labels.unionAll(labels.limit(1))):
        with pytest.raises(ValueError):
            segment.with_labels(df, bad)
