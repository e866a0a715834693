"""Consumer cursors over landed delivery pages (Structured Streaming)."""

import json
import os

from pyspark.sql import functions as F

from annotask.streaming.deliveries import deliveries_since_last_call, delivery_rejects, delivery_stream, start_delivery_stream
from annotask.streaming.task_batches import stream_task_batches
from annotask.sinks.batches import read_committed_requests


def delivery(i, batch="b1", cb="cb"):
    return {"id": f"d{i}", "project_id": "p", "batch_id": batch, "client_batch_id": cb, "answers": {"k": i}}


def land(root, name, records, project="p", body=None):
    path = os.path.join(root, "landing", f"project_id={project}")
    os.makedirs(path, exist_ok=True)
    with open(os.path.join(path, f"{name}.json"), "w") as fh:
        fh.write(json.dumps({"result": name, "page": 1, "value": body or json.dumps({"tasks": records})}) + "\n")


def ids(df):
    return sorted(r.id for r in df.select("id").collect())


def call(spark, root, consumer, **kw):
    return deliveries_since_last_call(
        spark,
        os.path.join(root, "landing"),
        consumer=consumer,
        output_path=os.path.join(root, "out", consumer),
        checkpoint_path=os.path.join(root, "ckpt", consumer),
        **kw,
    )


def test_two_consumers_have_their_own_cursor(spark, tmp_path):
    root = str(tmp_path)
    land(root, "r1", [delivery(1), delivery(2)])
    assert ids(call(spark, root, "A")) == ["d1", "d2"]
    land(root, "r2", [delivery(3)])
    first = call(spark, root, "A")
    assert ids(first) == ["d3"]
    assert first.where(F.col("answers") == '{"k":3}').count() == 1
    assert ids(call(spark, root, "A")) == []
    assert ids(call(spark, root, "B")) == ["d1", "d2", "d3"]


def test_empty_call_has_declared_schema(spark, tmp_path):
    root = str(tmp_path)
    land(root, "r1", [delivery(1)])
    call(spark, root, "A")
    empty = call(spark, root, "A")
    assert empty.count() == 0 and "answers" in empty.columns and "result" in empty.columns


def test_filters_apply_and_consume(spark, tmp_path):
    root = str(tmp_path)
    land(root, "r1", [delivery(1, batch="b1"), delivery(2, batch="b2", cb="xx_batch")])
    assert ids(call(spark, root, "A", batch_id="b2")) == ["d2"]
    assert ids(call(spark, root, "B", client_batch_id="_b", client_batch_id_match_type="contains")) == ["d2"]
    # Rows failing a filter are consumed as well.
    assert ids(call(spark, root, "A")) == []


def test_replay_after_crash_is_not_doubled(spark, tmp_path):
    root = str(tmp_path)
    land(root, "r1", [delivery(1), delivery(2)])
    assert ids(call(spark, root, "A")) == ["d1", "d2"]
    # Simulate a stop between the sink write and the commit of epoch 0.
    commits = os.path.join(root, "ckpt", "A", "commits")
    os.remove(os.path.join(commits, "0"))
    crc = os.path.join(commits, ".0.crc")
    if os.path.exists(crc):
        os.remove(crc)
    land(root, "r2", [delivery(3)])
    again = call(spark, root, "A")
    assert ids(again) == ["d1", "d2"] or ids(again) == ["d1", "d2", "d3"]
    assert ids(again.union(call(spark, root, "A"))) == ["d1", "d2", "d3"]


def test_max_files_per_trigger_runs_several_epochs(spark, tmp_path):
    root = str(tmp_path)
    for i in range(4):
        land(root, f"r{i}", [delivery(i)])
    out = call(spark, root, "A", max_files_per_trigger=1)
    assert ids(out) == ["d0", "d1", "d2", "d3"]


def test_continuous_stream(spark, tmp_path):
    root = str(tmp_path)
    land(root, "r1", [delivery(1)])
    q = start_delivery_stream(spark, os.path.join(root, "landing"), os.path.join(root, "live"), consumer="L",
                              processing_time="1 second", checkpoint_path=os.path.join(root, "ckpt-live"))
    try:
        q.processAllAvailable()
        land(root, "r2", [delivery(2)])
        q.processAllAvailable()
    finally:
        q.stop()
    assert ids(spark.read.parquet(os.path.join(root, "live"))) == ["d1", "d2"]
    assert delivery_stream(spark, os.path.join(root, "landing")).isStreaming


def test_stream_of_inputs_to_batches(spark, tmp_path):
    root = str(tmp_path)
    df = spark.createDataFrame([(i, f"n{i}") for i in range(20)], "id int, name string")
    df.repartition(4).write.parquet(os.path.join(root, "incoming"))
    stream = spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 2).parquet(os.path.join(root, "incoming"))
    q = stream_task_batches(stream, os.path.join(root, "req"), "p", "s", os.path.join(root, "ck"),
                            jobs_path=os.path.join(root, "jobs"), available_now=True)
    q.awaitTermination()
    back = read_committed_requests(spark, os.path.join(root, "req"), os.path.join(root, "jobs"), "id int, name string")
    assert sorted(r.data.id for r in back.collect()) == list(range(20))
    assert back.select("batch_id").distinct().count() >= 2


def test_max_bytes_per_trigger_bounds_each_epoch(spark, tmp_path):
    root = str(tmp_path)
    for i in range(4):
        land(root, f"r{i}", [dict(delivery(i), answers={"x": "y" * 2000})])
    out = call(spark, root, "A", max_bytes_per_trigger=3000)
    assert ids(out) == ["d0", "d1", "d2", "d3"]
    (folder,) = os.listdir(os.path.join(root, "out", "A"))
    assert len(os.listdir(os.path.join(root, "out", "A", folder))) >= 2


def test_call_before_anything_landed_is_empty(spark, tmp_path):
    root = str(tmp_path)
    empty = call(spark, root, "A")
    assert empty.count() == 0 and "answers" in empty.columns
    land(root, "r1", [delivery(1)])
    assert ids(call(spark, root, "A")) == ["d1"]


def test_files_of_any_age_are_read(spark, tmp_path):
    root = str(tmp_path)
    land(root, "r1", [delivery(1)])
    assert ids(call(spark, root, "A")) == ["d1"]
    land(root, "r2", [delivery(2)])
    old = os.path.join(root, "landing", "project_id=p", "r2.json")
    os.utime(old, (os.path.getmtime(old) - 40 * 86400,) * 2)
    assert ids(call(spark, root, "A")) == ["d2"]


def test_a_call_of_many_epochs_returns_all_of_them(spark, tmp_path):
    root = str(tmp_path)
    for i in range(105):
        land(root, f"r{i}", [delivery(i)])
    assert len(ids(call(spark, root, "A", max_files_per_trigger=1))) == 105


def test_projects_and_consumers_have_their_own_cursor(spark, tmp_path):
    landing = str(tmp_path / "landing")
    land(str(tmp_path), "r1", [delivery(1)], "p")
    land(str(tmp_path), "r2", [dict(delivery(2), project_id="q/1")], "q%2F1")

    def since(consumer, project):
        return ids(deliveries_since_last_call(spark, landing, consumer, project))

    assert since("A", "p") == ["d1"]
    assert since("A", "q/1") == ["d2"]
    assert since("B", "q/1") == ["d2"]
    land(str(tmp_path), "r3", [delivery(3)], "p")
    assert since("A", "q/1") == [] and since("A", "p") == ["d3"] and since("B", "p") == ["d1", "d3"]
    assert since("A", None) == ["d1", "d2", "d3"] and since("A", "none yet") == []


def test_what_cannot_be_read_is_kept_and_does_not_stop_the_cursor(spark, tmp_path):
    root = str(tmp_path)
    land(root, "r1", [dict(delivery(1), completed_at=""), delivery(2), dict(delivery(3), priority="high"), 7])
    land(root, "r2", None, body='{"tasks": [1')
    land(root, "r3", [dict(delivery(4), completed_at="2023-09-02z", created_at="2023-09-02")])
    with open(os.path.join(root, "landing", "project_id=p", "r4.json"), "w") as fh:
        fh.write("not json\n")
    got = call(spark, root, "A")
    assert ids(got) == ["d2", "d4"]
    assert got.where("completed_at = timestamp_ntz'2023-09-02 00:00:00' and created_at = completed_at").count() == 1
    rejects = delivery_rejects(spark, os.path.join(root, "landing"), "A", output_path=os.path.join(root, "out", "A"))
    found = sorted((r.result or "", r.position or 0, r.rejected, (r.text or "")[:12]) for r in rejects.collect())
    assert found == [("", 0, "body", "not json"), ("r1", 1, "record", '{"id":"d1","'), ("r1", 3, "record", '{"id":"d3","'),
                     ("r1", 4, "record", "7"), ("r2", 0, "body", '{"tasks": [1')]
    land(root, "r5", [delivery(5)])
    assert ids(call(spark, root, "A")) == ["d5"]
