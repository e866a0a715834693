"""A third of all rows under one key: the plans split or spread it."""

import pytest
from pyspark.sql import functions as F

from annotask.operators.stats import batch_task_detail, project_stats
from annotask.plans import derived as D
from tests.conftest import SF01

SKEW_CONF = {
    # keep the join a sort-merge join, and make "skewed" reachable at test size
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "16k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16k",
}


@pytest.fixture
def skew_conf(spark):
    old = {k: spark.conf.get(k, None) for k in SKEW_CONF}
    for k, v in SKEW_CONF.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        if v is None:
            spark.conf.unset(k)
        else:
            spark.conf.set(k, v)


def hot_tasks(spark):
    t = D.tasks(spark, SF01)
    hot = F.col("id").cast("long") % 3 == 0
    return (
        t.withColumn("project_id", F.when(hot, F.lit("1")).otherwise(F.col("project_id")))
        .withColumn("batch_id", F.when(hot, F.lit("HOT")).otherwise(F.col("batch_id")))
        .repartition(16)  # many map tasks, as a large scan has
    )


def test_hot_batch_join_is_split(spark, skew_conf):
    tasks = hot_tasks(spark)
    jobs = D.batch_jobs(spark, SF01).unionByName(
        spark.createDataFrame(
            [("1", "HOT", "failed", "python_sdk", None, None)],
            "project_id string, batch_id string, status string, tasks_file_name string, "
            "notification_email string, created_at timestamp_ntz",
        )
    )
    df = batch_task_detail(jobs, tasks, omit_failed_task_data=True)
    rows = df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert "SortMergeJoin(skew=true)" in plan
    assert len(rows) == 15000
    assert sum(1 for r in rows if r.batch_id == "HOT" and r.failed and r.data is None) == 5000


def test_hot_project_is_pre_aggregated(spark):
    df = project_stats(hot_tasks(spark))
    rows = {r.project_id: r.n_tasks for r in df.collect()}
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "partial_count" in plan
    assert rows["1"] >= 5000 and sum(rows.values()) == 15000
