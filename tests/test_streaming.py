import tempfile

import numpy as np
from pyspark.sql import functions as F

from conftest import SMALL
from cohortlens.operators.experts import Expert
from cohortlens.operators.features import FeatureConfig
from cohortlens.operators.joint import JointConfig, JointParams
from cohortlens.operators.transform import fit_transform_params, prepare_for_fit
from cohortlens.operators.clean import clean_campaign
from cohortlens.sources.campaign import CUTOFF, REFERENCE_YEAR, campaign_raw
from cohortlens.streaming.scoring import score_rows, start_scoring


def test_stream_scores_equal_batch(spark):
    raw = campaign_raw(spark, SMALL).dropDuplicates()
    prepared = prepare_for_fit(clean_campaign(raw, CUTOFF, REFERENCE_YEAR), reference_date=CUTOFF, reference_year=REFERENCE_YEAR)
    ft = fit_transform_params(prepared, FeatureConfig.default_for(prepared))
    d, D = len(ft.behavior_feature_names), len(ft.all_feature_names)
    rng = np.random.default_rng(0)
    prm = JointParams(pi=np.full(3, 1 / 3), mu=rng.normal(size=(3, d)), var=np.ones((3, d)),
                      experts=[Expert(coef=rng.normal(size=D + 1) * 0.1) for _ in range(3)],
                      global_expert=Expert(coef=np.zeros(D + 1)), global_rate=0.2)
    cfg = JointConfig(n_clusters=3)
    batch = {r["customer_id"]: (r["cluster"], r["score"]) for r in score_rows(raw, ft, prm, cfg, CUTOFF, REFERENCE_YEAR).collect()}
    src = tempfile.mkdtemp(prefix="cl-stream-", dir="/tmp")
    raw.repartition(3).write.mode("overwrite").parquet(src)
    out, state = (tempfile.mkdtemp(prefix="cl-stream-", dir="/tmp") for _ in range(2))
    stream = score_rows(spark.readStream.schema(raw.schema).parquet(src), ft, prm, cfg, CUTOFF, REFERENCE_YEAR)
    plan = stream._jdf.queryExecution().analyzed().toString()
    assert not [n for n in ("Deduplicate", "Aggregate", "Join", "Window") if n in plan]  # no state
    q = start_scoring(spark, src, raw.schema, ft, prm, cfg, CUTOFF, REFERENCE_YEAR, out, state)
    q.processAllAvailable()
    q.stop()
    got = {r["customer_id"]: (r["cluster"], r["score"]) for r in spark.read.parquet(out).collect()}
    assert got.keys() == batch.keys()
    assert all(got[k][0] == batch[k][0] and abs(got[k][1] - batch[k][1]) < 1e-12 for k in got)
