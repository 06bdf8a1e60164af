"""Stages that survive a run: reused when finished, made again when inputs or parameters change, never read half."""

import os

import pytest
from pyspark.sql import functions as F

from claimtree.operators import claims as ops
from claimtree.plans.attribution import ClaimRun, Cohort
from claimtree.plans.stages import StageStore, input_state
from claimtree.queries import claims as registered
from claimtree.queries.fixtures import Inputs

SMALL = "/root/testdata/sf0.001"


class Killed(Exception):
    pass


def rows(df):
    return sorted(map(str, df.collect()))


def test_a_restarted_run_goes_on_behind_the_finished_stages(spark, tmp_path, monkeypatch):
    src = registered.sources(Inputs(spark, SMALL))
    run = lambda **more: ClaimRun(src, Cohort(patterns=["ring"]), 1999, str(tmp_path), True, inputs="state-1", **more)
    want = rows(ClaimRun(src, Cohort(patterns=["ring"]), 1999, exact_cents=True).by_org)

    def killed(*_):
        raise Killed

    with monkeypatch.context() as patch:
        patch.setattr(ops, "org_claims", killed)
        with pytest.raises(Killed):
            run().by_org
    with monkeypatch.context() as patch:
        patch.setattr(ops, "cohort_by_name", killed)
        patch.setattr(ops, "monthly_physician_plan", killed)
        assert rows(run().by_org) == want
        with pytest.raises(Killed):  # another cohort, other pays and other inputs are other stages
            ClaimRun(src, Cohort(patterns=["bolt"]), 1999, str(tmp_path), True, inputs="state-1").by_org
        with pytest.raises(Killed):
            ClaimRun(src, Cohort(patterns=["ring"]), 1999, str(tmp_path), inputs="state-1").by_org
        with pytest.raises(Killed):
            ClaimRun(src, Cohort(patterns=["ring"]), 1999, str(tmp_path), True, inputs="state-2").by_org
    with pytest.raises(ValueError):
        ClaimRun(src, Cohort(patterns=["ring"]), 1999, inputs="state-1")


def test_a_half_written_stage_is_never_read(spark, tmp_path):
    store = StageStore(spark, str(tmp_path), "s", {"x": 1})
    dies = spark.range(0, 1000, 1, 4).select(F.when(F.col("id") == 999, F.raise_error(F.lit("dies"))).otherwise(F.col("id")).alias("id"))
    with pytest.raises(Exception, match="dies"):
        store.stage("a", lambda: dies)
    assert store.finished("a") is None
    # Whole data without a record, as of a run that died between the two.
    folder = tmp_path / "a" / store.fingerprint("a")[:24]
    spark.range(7).write.parquet(str(folder / "data-x"))
    assert store.finished("a") is None
    assert store.stage("a", lambda: spark.range(5)).count() == 5
    made = []
    assert store.stage("a", lambda: made.append(1)).count() == 5 and made == []
    assert StageStore(spark, str(tmp_path), "s", {"x": 2}).finished("a") is None


def test_input_state_follows_the_files(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(10).repartition(2).write.parquet(path)
    first = input_state(spark, path)
    assert input_state(spark, path) == first != input_state(spark, path, SMALL)
    spark.range(3).write.mode("append").parquet(path)
    second = input_state(spark, path)
    name = next(f for f in os.listdir(path) if f.endswith(".parquet"))
    os.utime(os.path.join(path, name), (1, 1))
    assert len({first, second, input_state(spark, path)}) == 3
