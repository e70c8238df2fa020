import os

from adpulse.session import materialize, work_dir
from helpers import rows


def test_work_dir_lives_under_the_checkpoint_dir(spark):
    path = work_dir(spark, "t")
    base = spark.sparkContext.getCheckpointDir()
    assert base and path.startswith(base.rstrip("/") + "/adpulse/t-")
    assert work_dir(spark, "t") != path  # a fresh folder per call


def test_materialize_is_a_reliable_checkpoint(spark):
    df = spark.range(0, 1000).selectExpr("id % 7 AS k", "id")
    cut = materialize(df.groupBy("k").count())
    assert rows(cut) == rows(df.groupBy("k").count())
    plan = cut._jdf.queryExecution().analyzed().toString()
    assert "LogicalRDD" in plan  # lineage cut: no aggregate left in the plan
    base = spark.sparkContext.getCheckpointDir().replace("file:", "")
    assert any(os.scandir(base))  # written to the shared checkpoint folder
