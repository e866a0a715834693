"""The client-named facade over task tables, end to end on small tables."""

import datetime as dt
import json
import os

from pyspark.sql import functions as F

from annotask import AnnotationTables, compact_pages, write_tasks
from annotask.sinks.tables import compact_changes
from annotask.schema import TASK_SCHEMA

T0 = dt.datetime(2023, 9, 13)


def make_tasks(spark):
    rows = []
    for i in range(40):
        state = ["new", "in progress", "delivered", "completed"][i % 4]
        rows.append(
            (f"t{i}", f"p{i % 2}", f"b{i % 3}", "batch1" if i % 5 else "other", state, 0,
             T0 + dt.timedelta(days=i), T0 + dt.timedelta(days=i + 1) if state == "completed" else None,
             json.dumps({"url": f"u{i}"}), json.dumps({"k": i}) if state == "delivered" else None)
        )
    return spark.createDataFrame(rows, TASK_SCHEMA)


def test_facade(spark, tmp_path):
    root = str(tmp_path)
    write_tasks(make_tasks(spark), f"{root}/tasks")
    # landed deliveries → Parquet deliveries table
    os.makedirs(f"{root}/landing/project_id=p0")
    body = json.dumps({"tasks": [{"id": "t2", "project_id": "p0", "batch_id": "b2", "answers": {"k": 2},
                                  "delivered_at": "2023-09-15T00:00:00.000000"}]})
    with open(f"{root}/landing/project_id=p0/pages.json", "w") as fh:
        fh.write(json.dumps({"result": "r1", "page": 1, "value": body}) + "\n")
    compact_pages(spark, f"{root}/landing", f"{root}/deliveries")
    compact_pages(spark, f"{root}/landing", f"{root}/deliveries")  # again: replaced, not doubled
    from_landing = AnnotationTables(spark, landing_path=f"{root}/landing")
    assert from_landing.get_delivered_tasks_to_table(spark, "p0").count() == 1
    at = AnnotationTables(spark, tasks_path=f"{root}/tasks", deliveries_path=f"{root}/deliveries",
                          landing_path=f"{root}/landing", requests_path=f"{root}/requests", jobs_path=f"{root}/jobs",
                          changes_path=f"{root}/changes")

    st = at.get_multi_task_status_to_table(spark, "p0", state="delivered", from_timestamp="2023-09-14T00:00:00Z")
    assert st.count() == 10 and "answers" not in st.columns
    plan = st._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(project_id" in plan
    assert "answers" not in [line for line in plan.split("\n") if "ReadSchema" in line][0]

    page1 = at.get_multi_task_status_page("p0", 1, 3, state="delivered")
    page4 = at.get_multi_task_status_page("p0", 4, 3, state="delivered")
    assert [r.id for r in page1.orderBy("created_at").collect()] == ["t2", "t6", "t10"]
    assert [r.id for r in page4.collect()] == ["t38"]
    assert at.get_delivered_tasks_page("p0", 1, 1000).count() == 1
    one = at.get_task_status_to_table(spark, "p0", "t2").collect()
    assert one[0].answers == '{"k":2}'
    assert at.get_delivered_tasks_to_table(spark, "p0").count() == 1
    assert at.get_delivered_tasks_since_last_call_to_table(spark, "p0", consumer="me").count() == 1
    assert at.get_delivered_tasks_since_last_call_to_table(spark, "p0", consumer="me").count() == 0

    inputs = spark.createDataFrame([("https://x/1.jpg", '{"rain": "1"}')], "url string, output_weather string")
    job = at.create_task_batch_from_table(inputs, "p0", batch_priority=-100, batch_id="nb")
    assert job["n_tasks"] == 1
    prof = {r.column_name: r for r in at.get_creation_task_schema("p0").collect()}
    assert prof["url"].non_null == 1 and prof["output_weather"].is_preannotation
    listed = at.create_task_batch("p0", [{"url": "https://x/2.jpg", "n": 3}, {"url": None, "tags": ["a", {"b": 1.0}]}], batch_id="list")
    assert listed["n_tasks"] == 2 and listed["status"] == "committed"
    from annotask.sinks.batches import read_committed_requests

    texts = sorted(r.value for r in read_committed_requests(spark, f"{root}/requests", f"{root}/jobs").where("batch_id = 'list'").collect())
    assert [json.loads(t)["data"] for t in texts] == [{"url": "https://x/2.jpg", "n": 3, "tags": None}, {"url": None, "n": None, "tags": ["a", {"b": 1.0}]}]
    # A committed batch is over: a cancel changes nothing.
    assert [r.status for r in at.cancel_batch_creation_job("p0", "nb").collect()] == ["committed"]
    assert read_committed_requests(spark, f"{root}/requests", f"{root}/jobs").count() == 3

    rej = {r.id: (r.state, r.reject_reasons) for r in at.reject_task("p0", "t0", ["Not accurate"]).collect()}
    assert rej["t0"] == ("rejected", ["Not accurate"]) and "t1" not in rej
    again = {r.id: r.reject_reasons for r in at.reject_task("p0", "t0", ["Wrong label", "Blurred"]).collect()}
    assert again["t0"] == ["Wrong label", "Blurred"] and again["t2"] is None
    assert {r.id: r.priority for r in at.update_task_priorities("p0", ["t0"], -100).collect()}["t0"] == -100
    assert at.delete_tasks("p0", ["t0", "t1"]).count() == 19
    assert at.tasks().count() == 39
    assert {r.state for r in at.tasks("p1").where("id = 't1'").collect()} == {"in progress"}
    at.delete_tasks("p0", [f"t{i}" for i in range(40)])
    assert at.tasks("p0").count() == 0 and at.tasks().count() == 20
    compact_changes(spark, f"{root}/tasks", f"{root}/changes", "p0")
    assert at.tasks("p0").count() == 0 and at.tasks().count() == 20
    plan = at.tasks("p1")._jdf.queryExecution().executedPlan().toString()
    # No change of this project is in the log: its tasks' folder is all that is read.
    assert plan.count("PartitionFilters: [isnotnull(project_id") == plan.count("FileScan parquet") == 1
    stats = at.get_project_stats("p1").collect()[0]
    assert stats.n_tasks == 20 and stats.n_delivered == 0
    fields = at.get_delivery_task_schema("p0").collect()
    assert [(r.field, r.n_present) for r in fields] == [("k", 1)]
