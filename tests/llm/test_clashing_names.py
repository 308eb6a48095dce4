"""Columns that happen to have the names of helper columns come back as they went in."""

import pytest

from cohortlens.llm import exact_dedup, mixing, quality, simhash

HELPERS = [
    "_id_hash", "_sha", "_id", "_digest", "_stays", "_rows", "_bitmap", "_bucket", "_maybe", "_simhash_row", "_hash", "_loser", "fp", "_kept",
    "quality_judgement", "h", "label", "weight", "rate", "copies", "copy", "shuffle_key", "_rate", "_source", "_parts", "_cdf", "_mixing_name",
    "given_0", "given_3", "a.b", "with `tick",
]
TEXT = "The committee met on Tuesday and agreed that the bridge over the river should be repaired before the winter comes, number {}."


def frame(spark, names=HELPERS):
    rows = [(TEXT.format(i % 40) if i % 7 else None, i // 2, "s", *[f"{n} {i}" for n in names]) for i in range(120)]
    kinds = ", ".join(f"`{n.replace('`', '``')}` string" for n in names)
    return spark.createDataFrame(rows, f"text string, doc_id long, source string, {kinds}").repartition(3)


@pytest.mark.parametrize("function", [exact_dedup.kept_documents, simhash.representatives, quality.good_documents, mixing.replicated])
def test_columns_unchanged(spark, function, tmp_path):
    frame(spark).write.parquet(str(tmp_path / "d"))
    df = spark.read.parquet(str(tmp_path / "d"))
    given = {tuple(r) for r in df.collect()}
    out = function(df)
    assert out.columns == df.columns
    rows = [tuple(r) for r in out.collect()]
    assert rows and set(rows) <= given
    if function is exact_dedup.kept_documents:
        assert len(rows) == 41  # 40 texts and the rows without one


def test_mixture_replaces_columns_of_its_names(spark):
    out = mixing.mixture(frame(spark))
    added = {"rate", "copies", "copy", "shuffle_key"}
    assert out.columns == ["text", "doc_id", "source", *[n for n in HELPERS if n not in added], "rate", "copies", "copy", "shuffle_key"]
    assert all(r.rate == 1.0 and r["_rate"].startswith("_rate ") for r in out.collect())
