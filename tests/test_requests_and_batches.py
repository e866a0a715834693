"""Task requests, pre-annotations, batch files, commit and round trip."""

import json

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F
from pyspark.sql import types as T

from annotask.functions.json import parse_preannotations
from annotask.operators.requests import task_request_json
from annotask.sinks import batches
from annotask.sinks.batches import (
    read_batch_jobs,
    read_committed_requests,
    commit_batch,
    compact_batch_jobs,
    read_task_requests,
    write_task_batch,
)


def requests_of(df, **kw):
    return [json.loads(r.request_json) for r in task_request_json(df, **kw).collect()]


def test_minimal_record_defaults(spark):
    df = spark.createDataFrame([("test_data",)], "input string")
    assert requests_of(df) == [{"data": {"input": "test_data"}, "priority": 0, "submit": False}]


def test_priority_and_submit(spark):
    df = spark.createDataFrame([("x",)], "input string")
    assert requests_of(df, priority=-100, submit=True)[0] == {"data": {"input": "x"}, "priority": -100, "submit": True}


def test_tutorial_rows_with_preannotations(spark):
    vehicle = {
        "layers": {
            "vector_tagging": [
                {
                    "group_type": None,
                    "shapes": [
                        {
                            "tags": {"transcription": "1234", "type_of_vehicle": "Truck"},
                            "type": "rectangle",
                            "index": 1,
                            "points": [[4, 4], [86, 4], [86, 37], [4, 37]],
                        }
                    ],
                }
            ]
        }
    }
    rows = [
        ("https://x/img1.jpg", "image1", "batch1", json.dumps({"rain": "0", "snow": "0", "clear": "1"}), json.dumps(vehicle)),
        ("https://x/img2.jpg", "image2", None, json.dumps({"rain": "1", "snow": "0", "clear": "0"}), None),
    ]
    schema = "url string, name string, client_batch_id string, output_weather_condition string, output_vehicle_image_annotation string"
    out = requests_of(spark.createDataFrame(rows, schema))
    by_name = {r["data"]["name"]: r for r in out}
    first = by_name["image1"]["data"]
    assert first["output_vehicle_image_annotation"] == vehicle
    assert first["output_weather_condition"] == {"rain": "0", "snow": "0", "clear": "1"}
    second = by_name["image2"]["data"]
    # Nulls are sent as explicit JSON null (client_batch_id and the absent pre-annotation).
    assert "client_batch_id" in second and second["client_batch_id"] is None
    assert second["output_vehicle_image_annotation"] is None


def test_null_int_stays_int_and_struct_stays_object(spark):
    schema = T.StructType(
        [
            T.StructField("n", T.IntegerType()),
            T.StructField("s", T.StructType([T.StructField("a", T.IntegerType())])),
            T.StructField("flag", T.BooleanType()),
        ]
    )
    df = spark.createDataFrame([(1, Row(a=2), True), (None, None, False)], schema)
    out = sorted(requests_of(df), key=lambda r: r["data"]["flag"])
    assert out[1]["data"] == {"n": 1, "s": {"a": 2}, "flag": True}
    assert out[0]["data"] == {"n": None, "s": None, "flag": False}
    assert isinstance(out[1]["data"]["n"], int)


def test_drop_nulls_option(spark):
    df = spark.createDataFrame([(None, "x")], "a string, b string")
    assert requests_of(df, drop_nulls=True)[0]["data"] == {"b": "x"}


def test_nested_preannotation_column_passes_through(spark):
    schema = "name string, output_map map<string,string>"
    df = spark.createDataFrame([("a", {"rain": "1"})], schema)
    assert requests_of(df)[0]["data"]["output_map"] == {"rain": "1"}


def test_bad_preannotation_fails_by_default(spark):
    df = spark.createDataFrame([("a", "not json")], "name string, output_x string")
    with pytest.raises(Exception):
        task_request_json(df).collect()


def test_bad_preannotation_rejected_on_request(spark):
    rows = [("ok", '{"a": 1}'), ("bad", "not json"), ("empty", ""), ("none", None)]
    df = spark.createDataFrame(rows, "name string, output_x string")
    parsed = parse_preannotations(df, on_error="reject")
    flags = {r.name: r._invalid for r in parsed.collect()}
    assert flags == {"ok": False, "bad": True, "empty": True, "none": False}


def test_duplicate_keys_are_refused(spark):
    df = spark.createDataFrame([("d", '{"a": 1, "a": 2}')], "name string, output_x string")
    flags = [r._invalid for r in parse_preannotations(df, on_error="reject").collect()]
    assert flags == [True]


def test_write_commit_and_read_back(spark, tmp_path):
    df = spark.createDataFrame(
        [(i, f"name{i}", json.dumps({"k": i}) if i % 2 else None) for i in range(50)],
        "id int, name string, output_label string",
    )
    req, jobs = str(tmp_path / "requests"), str(tmp_path / "jobs")
    job = write_task_batch(df, req, "p1", "b1", jobs_path=jobs, max_records_per_file=7, notification_email="a@b.c")
    assert job["n_tasks"] == 50 and job["n_failed"] == 0 and job["status"] == "committed"
    # Written but not committed: invisible to readers of committed batches.
    write_task_batch(df, req, "p1", "b2")
    back = read_committed_requests(spark, req, jobs, "id int, name string, output_label string")
    assert back.count() == 50
    assert {r.batch_id for r in back.select("batch_id").distinct().collect()} == {"b1"}
    labels = {r.data.id: r.data.output_label for r in back.collect()}
    assert labels[3] == '{"k":3}' and labels[4] is None
    assert read_task_requests(spark, req).count() == 100
    assert read_batch_jobs(spark, jobs).collect()[0].notification_email == "a@b.c"


def test_rewrite_of_a_batch_does_not_duplicate(spark, tmp_path):
    df = spark.createDataFrame([(i,) for i in range(10)], "id int")
    req, jobs = str(tmp_path / "requests"), str(tmp_path / "jobs")
    write_task_batch(df, req, "p", "b1", jobs_path=jobs)
    write_task_batch(df, req, "p", "b2", jobs_path=jobs)
    write_task_batch(df, req, "p", "b1", jobs_path=jobs)
    back = read_committed_requests(spark, req, jobs)
    assert back.count() == 20


@pytest.mark.parametrize("given", [batches.BROADCAST_BYTES, -1])
def test_one_batch_is_read_by_many_tasks(spark, tmp_path, monkeypatch, given):
    req, jobs = str(tmp_path / "requests"), str(tmp_path / "jobs")
    df = spark.range(4000).select(F.col("id").alias("n")).repartition(4)
    write_task_batch(df, req, "p", "b", jobs_path=jobs)
    write_task_batch(df, req, "p", "uncommitted")
    monkeypatch.setattr(batches, "BROADCAST_BYTES", given)
    before = {c: spark.conf.get(c) for c in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold", "spark.sql.adaptive.coalescePartitions.enabled")}
    for name, value in zip(before, ("-1", "-1", "false")):
        spark.conf.set(name, value)
    try:
        back = read_committed_requests(spark, req, jobs, "n bigint")
        met = back.select("data.n", F.spark_partition_id().alias("task")).collect()
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
    assert sorted(r.n for r in met) == list(range(4000))
    assert len({r.task for r in met}) > 1


def test_rerun_whose_rows_are_all_rejected_shows_none(spark, tmp_path):
    req, jobs = str(tmp_path / "requests"), str(tmp_path / "jobs")
    good = spark.createDataFrame([("a", "1"), ("b", "2")], "name string, output_x string")
    write_task_batch(good, req, "p", "b1", jobs_path=jobs)
    job = write_task_batch(good.withColumn("output_x", F.lit("oops")), req, "p", "b1", on_error="reject", jobs_path=jobs)
    assert (job["n_tasks"], job["n_failed"]) == (0, 2)
    assert read_committed_requests(spark, req, jobs).count() == 0
    assert read_committed_requests(spark, req, jobs, outcome="rejected").count() == 2


def test_a_cancel_before_the_commit_stands(spark, tmp_path):
    import datetime as dt

    req, jobs = str(tmp_path / "requests"), str(tmp_path / "jobs")
    base = {"project_id": "p", "tasks_file_name": "f"}
    # Clocks run backwards: the order of the versions decides.
    clock = iter(dt.datetime(2024, 1, 1) - dt.timedelta(seconds=i) for i in range(100))

    def log(batch, attempt, *events):
        for status in events:
            commit_batch(spark, jobs, {**base, "batch_id": batch, "attempt": attempt, "status": status, "created_at": next(clock)})

    def now():
        return {r.batch_id: (r.status, r.attempt) for r in read_batch_jobs(spark, jobs).collect()}

    log("early", "1", "opened", "cancelled", "committed")
    log("late", "1", "opened", "committed", "cancelled")
    log("again", "1", "opened", "cancelled")
    log("again", "2", "opened", "committed")
    log("open", "1", "opened")
    log("done", "1", "opened", "committed", "completed")
    want = {"early": ("cancelled", "1"), "late": ("committed", "1"), "again": ("committed", "2"), "open": ("opened", "1"), "done": ("completed", "1")}
    assert now() == want
    compact_batch_jobs(spark, jobs, "p")
    assert now() == want
    # Judged after the compaction as before it: a commit after the cancel is void, an
    # older attempt stays the older one, a cancel before the commit stands.
    log("early", "1", "committed")
    log("again", "1", "committed")
    log("open", "1", "cancelled", "committed")
    assert now() == {**want, "open": ("cancelled", "1")}


def test_input_columns_of_any_name_are_data(spark, tmp_path):
    df = spark.createDataFrame([(True, "r", 1), (False, "s", 2)], "_invalid boolean, result string, page int")
    job = write_task_batch(df, str(tmp_path / "requests"), "p", "b")
    assert (job["n_tasks"], job["n_failed"]) == (2, 0)
    data = [json.loads(r.value)["data"] for r in read_task_requests(spark, str(tmp_path / "requests")).collect()]
    assert sorted(d["page"] for d in data) == [1, 2] and {d["_invalid"] for d in data} == {True, False}
    flagged = task_request_json(df.withColumn("output_x", F.lit("oops")), on_error="reject")
    assert flagged.columns == ["_invalid", "request_json"] and {r._invalid for r in flagged.collect()} == {True}


def test_files_follow_the_bytes(spark, tmp_path):
    from annotask.schema import TASK_SCHEMA
    from annotask.sinks.tables import write_tasks

    rows = spark.range(20000).repartition(8).select(F.col("id").cast("string").alias("id"), (F.col("id") % 50).cast("string").alias("project_id"))
    for f in TASK_SCHEMA.fields[2:]:
        rows = rows.withColumn(f.name, F.lit(None).cast(f.dataType))
    write_tasks(rows, str(tmp_path / "tasks"))
    files = list((tmp_path / "tasks").rglob("*.parquet"))
    assert len(files) == 50  # one a project, not tasks times projects


def test_rejected_rows_are_written_apart(spark, tmp_path):
    df = spark.createDataFrame([("a", '{"x": 1}'), ("b", "oops")], "name string, output_x string")
    req = str(tmp_path / "requests")
    job = write_task_batch(df, req, "p", "b", on_error="reject")
    assert job["n_tasks"] == 1 and job["n_failed"] == 1
    assert read_task_requests(spark, req, outcome="rejected").count() == 1


def test_no_driver_collect_in_library():
    import pathlib

    root = pathlib.Path(__file__).resolve().parents[1] / "annotask"
    # Names of the files to open, with their ranks; a row per unread version; at most LOOKUP_IDS ids of a call's own list.
    names = {
        "streaming/feed.py": 1, "operators/rank_index.py": 2, "operators/substring_index.py": 2, "operators/positions.py": 1,
        "sources/landings.py": 1,
    }
    for path in root.rglob("*.py"):
        if "llm" in path.relative_to(root).parts:
            continue  # its models are bounded by parameters, and collected as such
        text = path.read_text()
        assert text.count(".collect()") == names.get(path.relative_to(root).as_posix(), 0), f".collect() in {path}"
        for banned in (".toPandas()", "parallelize(", "localCheckpoint"):
            assert banned not in text, f"{banned} in {path}"


def test_variant_input_is_written_as_nested_json(spark):
    df = spark.range(1).select(F.parse_json(F.lit('{"a": [1, {"b": null}]}')).alias("v"), F.lit("x").alias("name"))
    assert requests_of(df)[0]["data"] == {"v": {"a": [1, {"b": None}]}, "name": "x"}
