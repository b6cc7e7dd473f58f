"""Scoring contracts and the upkeep of sessions."""

import pytest
from pyspark.sql import functions as F

from tideline.operators import encode
from tideline.plans import incremental, scoring


def test_contract_refuses_leaks_and_collects_all_errors(spark):
    train = spark.createDataFrame([(1.0, "a"), (2.0, "b")], "x double, c string")
    encoder = encode.fit(train, ["x"], ["c"])
    contract = scoring.Contract.of(encoder, ["k"])
    with pytest.raises(ValueError, match="has_target"):
        scoring.Contract.of(encode.Encoder(["has_target"], []))
    model = (1.0, {n: 2.0 for n in encoder.names})
    asked = spark.createDataFrame([(1, 1.5, "a"), (2, None, "new"), (3, float("nan"), "a")], "k int, x double, c string")
    got = {r.k: r for r in scoring.score(asked, contract, encoder, model).collect()}
    assert got[1].prediction == 3.0 and got[1].errors == [] and got[2].prediction == 1.0 and got[3].errors == ["x: not finite"] and got[3].prediction is None
    bad = scoring.score(asked.drop("c").withColumn("y", F.lit(1)), contract, encoder, model).first()
    assert bad.prediction is None and bad.errors == ["c: absent", "y: unknown"]
    assert scoring.score(asked.limit(0), contract, encoder, model).count() == 0


def test_reuse_needs_every_stage_unchanged(spark):
    rows = spark.createDataFrame([(1, 1.0), (1, 2.0), (2, 3.0), (3, 4.0)], "session_key int, v double")
    raw, laps = incremental.session_digests(rows, "raw"), incremental.session_digests(rows.where("session_key < 3"), "laps")
    recorded = raw.unionByName(incremental.session_digests(rows.withColumn("v", F.when(F.col("session_key") == 2, 0.0).otherwise(F.col("v"))), "laps"))
    got = {r.session_key: (r.reusable, r.first_changed) for r in incremental.reuse(raw.unionByName(laps), recorded, ["raw", "laps"]).collect()}
    assert got == {1: (True, None), 2: (False, "laps"), 3: (False, "laps")}
    assert incremental.session_digests(rows.orderBy(F.desc("v")), "raw").exceptAll(raw).count() == 0
