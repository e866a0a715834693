"""Landed response pages: envelope, paging cases, completeness, rejects."""

import json

from pyspark.sql import functions as F

from annotask.operators.paging import page_completeness
from annotask.sources.pages import (
    envelope_rejects,
    explode_envelope,
    infer_task_schema,
    page_task_counts,
    read_page_files,
    read_task_pages,
)
from pyspark.sql import types as T

REC = T.StructType([T.StructField("id", T.StringType()), T.StructField("info", T.StringType())])


def task(i):
    return {"id": f"t-{i}", "info": f"about {i}"}


def body(tasks=None, single=None):
    if single is not None:
        return json.dumps({"task": single})
    if tasks is None:
        return "{}"
    return json.dumps({"tasks": tasks})


def land(write_text, root, result, pages):
    files = {f"result={result}/page={n}/body.json": text for n, text in pages.items()}
    return write_text(root, files)


def rows_of(spark, path):
    df = read_task_pages(spark, path, REC)
    return [(r.page, r.position, r.id) for r in df.orderBy("page", "position").collect()]


def completeness(spark, path, page_size):
    return page_completeness(page_task_counts(spark, path), page_size).collect()[0]


def test_empty_body(spark, write_text, tmp_path):
    path = land(write_text, tmp_path, "r1", {1: "{}"})
    assert rows_of(spark, path) == []
    c = completeness(spark, path, 1000)
    assert c.complete and c.n_tasks == 0


def test_single_page(spark, write_text, tmp_path):
    path = land(write_text, tmp_path, "r1", {1: body([task(1), task(2)])})
    assert rows_of(spark, path) == [(1, 1, "t-1"), (1, 2, "t-2")]
    assert completeness(spark, path, 1000).complete


def test_full_then_empty(spark, write_text, tmp_path):
    path = land(write_text, tmp_path, "r1", {1: body([task(1), task(2)]), 2: "{}"})
    assert [r[2] for r in rows_of(spark, path)] == ["t-1", "t-2"]
    c = completeness(spark, path, 2)
    assert c.complete and c.n_pages == 2


def test_full_then_short_keeps_page_order(spark, write_text, tmp_path):
    path = land(write_text, tmp_path, "r1", {1: body([task(1), task(2)]), 2: body([task(3)])})
    assert rows_of(spark, path) == [(1, 1, "t-1"), (1, 2, "t-2"), (2, 1, "t-3")]
    assert completeness(spark, path, 2).complete


def test_single_task_body(spark, write_text, tmp_path):
    path = land(write_text, tmp_path, "r1", {1: body(single=task(1))})
    assert rows_of(spark, path) == [(1, 1, "t-1")]


def test_task_wins_over_tasks(spark):
    df = spark.createDataFrame([(json.dumps({"task": task(9), "tasks": [task(1), task(2)]}),)], "value string")
    assert [r.id for r in explode_envelope(df, "value", REC).collect()] == ["t-9"]


def test_full_last_page_is_incomplete(spark, write_text, tmp_path):
    path = land(write_text, tmp_path, "r1", {1: body([task(1), task(2)])})
    c = completeness(spark, path, 2)
    assert not c.complete and c.last_page_full


def test_missing_page_is_flagged(spark, write_text, tmp_path):
    path = land(write_text, tmp_path, "r1", {1: body([task(1), task(2)]), 3: body([task(3)])})
    c = completeness(spark, path, 2)
    assert not c.complete and c.missing_pages == 1


def test_short_inner_page_is_flagged(spark, write_text, tmp_path):
    path = land(write_text, tmp_path, "r1", {1: body([task(1)]), 2: body([task(2)])})
    c = completeness(spark, path, 2)
    assert not c.complete and c.short_inner_pages == 1


def test_bad_body_goes_to_rejects(spark, write_text, tmp_path):
    path = land(write_text, tmp_path, "r1", {1: "nope", 2: "[1]", 3: "{}", 4: "[]", 5: '{"other": 1}'})
    assert rows_of(spark, path) == []
    rejected = sorted(r.page for r in envelope_rejects(read_page_files(spark, path), "value", REC).collect())
    assert rejected == [1, 2, 5]


def test_result_and_page_are_partition_columns(spark, write_text, tmp_path):
    write_text(tmp_path, {"result=007/page=1/a.json": body([task(1)]), "result=abc/page=1/a.json": body([task(2)])})
    df = read_task_pages(spark, str(tmp_path), REC)
    assert dict(df.dtypes)["result"] == "string" and dict(df.dtypes)["page"] == "int"
    assert sorted(r.result for r in df.collect()) == ["007", "abc"]


def test_answers_captured_as_compact_json(spark):
    rec = T.StructType([T.StructField("id", T.StringType()), T.StructField("answers", T.StringType())])
    text = '{"tasks":[{"id":"a","answers":{"b": [1, 2.0, {"c": "é"}], "a": null}},{"id":"b"}]}'
    df = spark.createDataFrame([(text,)], "value string")
    out = {r.id: r.answers for r in explode_envelope(df, "value", rec).collect()}
    assert out["a"] == '{"b":[1,2.0,{"c":"é"}],"a":null}'
    assert out["b"] is None


def test_infer_schema_pins_answers_to_string(spark, write_text, tmp_path):
    write_text(
        tmp_path,
        {
            "result=r/page=1/a.json": json.dumps({"tasks": [{"id": "1", "answers": {"x": 1}, "n": 3}]}),
            "result=r/page=2/a.json": json.dumps({"task": {"id": "2", "answers": [1, 2], "extra": True}}),
        },
    )
    schema = infer_task_schema(spark, str(tmp_path))
    assert schema["answers"].dataType == T.StringType()
    assert {"id", "n", "extra"} <= set(schema.names)
    rows = {r.id: r.answers for r in read_task_pages(spark, str(tmp_path), schema).collect()}
    assert rows == {"1": '{"x":1}', "2": "[1,2]"}


def test_one_body_per_line(spark, write_text, tmp_path):
    write_text(tmp_path, {"result=r/page=1/a.json": body([task(1)]) + "\n" + body([task(2), task(3)]) + "\n"})
    df = read_task_pages(spark, str(tmp_path), REC, one_body_per_line=True)
    assert sorted(r.id for r in df.collect()) == ["t-1", "t-2", "t-3"]
    assert df.where(F.col("page") != 1).count() == 0


def test_tasks_null_is_an_empty_page(spark, write_text, tmp_path):
    path = land(write_text, tmp_path, "r1", {1: '{"tasks": null}', 2: '{"task": null}'})
    assert rows_of(spark, path) == []
    assert envelope_rejects(read_page_files(spark, path), "value", REC).count() == 0


def test_service_timestamps_with_nanoseconds_and_offsets(spark):
    rec = T.StructType([T.StructField("id", T.StringType()), T.StructField("delivered_at", T.TimestampNTZType())])
    text = json.dumps(
        {
            "tasks": [
                {"id": "ns", "delivered_at": "2023-09-02T10:23:36.536167366Z"},
                {"id": "ms", "delivered_at": "2023-09-13T00:00:00.000Z"},
                {"id": "off", "delivered_at": "2023-09-13T02:00:00+02:00"},
                {"id": "plain", "delivered_at": "2023-09-13T00:00:00"},
            ]
        }
    )
    import datetime as dt

    df = spark.createDataFrame([(text,)], "value string")
    out = {r.id: r.delivered_at for r in explode_envelope(df, "value", rec).collect()}
    assert out["ns"] == dt.datetime(2023, 9, 2, 10, 23, 36, 536167)
    assert out["ms"] == out["off"] == out["plain"] == dt.datetime(2023, 9, 13)


def test_null_and_boolean_values_survive(spark):
    rec = T.StructType(
        [T.StructField("id", T.StringType()), T.StructField("flag", T.BooleanType()), T.StructField("x", T.StringType())]
    )
    text = json.dumps({"tasks": [{"id": "a", "flag": True, "x": None}, {"id": "b", "flag": False, "x": "v"}]})
    df = spark.createDataFrame([(text,)], "value string")
    out = {r.id: (r.flag, r.x) for r in explode_envelope(df, "value", rec).collect()}
    assert out == {"a": (True, None), "b": (False, "v")}


def test_absent_answers_column_is_left_alone(spark):
    from annotask.functions.json import answers_to_json

    df = spark.createDataFrame([("a",)], "id string")
    assert answers_to_json(df).columns == ["id"]


def test_landing_twice_does_not_duplicate(spark, tmp_path):
    import datetime as dt

    from annotask.schema import TASK_SCHEMA
    from annotask.plans.landing import land_pages

    rows = [(f"t{i}", "p", None, None, "new", 0, dt.datetime(2024, 1, 1, 0, 0, i), None, None, None) for i in range(5)]
    df = spark.createDataFrame(rows, TASK_SCHEMA)
    path = str(tmp_path / "landing")
    land_pages(df, path, 2)
    land_pages(df, path, 2, mode="overwrite")
    back = read_task_pages(spark, path, TASK_SCHEMA, lines=True)
    assert sorted(r.id for r in back.collect()) == [f"t{i}" for i in range(5)]
    assert sorted({(r.page, r.position) for r in back.collect()}) == [(1, 1), (1, 2), (2, 1), (2, 2), (3, 1)]
