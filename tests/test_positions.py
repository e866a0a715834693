"""Changes by position against the change log folded by id."""

import random

import pytest
from pyspark.sql import functions as F

from annotask.operators import positions
from annotask.operators.changes import apply_changes, deletion_changes, priority_changes, rejection_changes
from annotask.operators.positions import deletion_bitmaps, locate, position_log, read_tasks_at, record_position_changes
from annotask.sinks.tables import write_tasks
from annotask.sources.tables import read_tasks
from tests.test_rank_index import tasks


def frame(spark, ids):
    return spark.createDataFrame([(i,) for i in ids], "id string")


def rows(df):
    return sorted(tuple(r) for r in df.select("id", "state", "priority", F.array_join("reject_reasons", "|"), "created_at").fillna("", ["state"]).fillna(0).collect())


@pytest.mark.parametrize("lookup", [10_000, 3])
def test_equals_the_change_log(spark, tmp_path, monkeypatch, lookup):
    monkeypatch.setattr(positions, "LOOKUP_IDS", lookup)
    path, log = str(tmp_path / "tasks"), str(tmp_path / "positions")
    write_tasks(tasks(spark, 400, projects=("p", "q/1")), path, max_records_per_file=60)
    rng, every = random.Random(3), []
    for step in range(3):
        ids = [f"t{i:05}" for i in rng.sample(range(420), 40)]
        for project in ("p", "q/1"):
            why = frame(spark, ids[:20]).withColumn("reasons", F.array(F.lit(f"w{step}")))
            for changes in (
                rejection_changes(why, project, at=f"2024-01-0{step + 1}T00:00:00Z"),
                priority_changes(spark, ids[10:30], project, step, at=f"2024-01-0{step + 1}T00:00:00Z"),
                deletion_changes(spark, ids[30:], project),
            ):
                record_position_changes(changes, path, log, project)
                every.append(changes)
    folded = every[0]
    for changes in every[1:]:
        folded = folded.unionByName(changes)
    for project in ("p", "q/1"):
        assert rows(read_tasks_at(spark, path, log, project)) == rows(apply_changes(read_tasks(spark, path), folded, project))
    assert read_tasks_at(spark, path, log, "none").count() == 0
    assert position_log(spark, log).read().count() < sum(c.count() for c in every)  # ids of no task are not kept


def scan_rows(df):
    """Rows that the scan of the plan has read."""
    df.collect()
    leaf = df._jdf.queryExecution().executedPlan().collectLeaves().head()
    return leaf.metrics().apply("numOutputRows").value()


def test_a_lookup_reads_only_the_files_that_can_hold_the_ids(spark, tmp_path):
    path = str(tmp_path / "tasks")
    write_tasks(tasks(spark, 20_000, projects=("p",)), path, max_records_per_file=500, ranged=True)
    table = read_tasks(spark, path).withColumn("file", F.col("_metadata.file_name"))
    files = sorted(r.file for r in table.select("file").distinct().collect())
    assert len(files) >= 40
    ids = [r.id for r in table.where(F.col("file").isin(files[3:5])).select("id").collect()][:1000]
    assert len(ids) == 1000
    with positions._id_lists_pushed(spark):
        found = locate(spark, path, "p", frame(spark, ids))
        assert found.count() == 1000
        # Two files hold them; a bloom filter may err on a few of 1000 ids in another.
        assert scan_rows(locate(spark, path, "p", frame(spark, ids[:20]))) <= 3 * 500
    assert spark.conf.get(positions._PUSHED_IDS) == "10"


def test_the_longest_list_that_is_looked_up(spark, tmp_path):
    path = str(tmp_path / "tasks")
    write_tasks(tasks(spark, 12_000, projects=("p",)), path, max_records_per_file=6000)
    with positions._id_lists_pushed(spark):
        found = locate(spark, path, "p", frame(spark, [f"t{i:05}" for i in range(4000, 14_000)]))  # 10,000 ids, 8,000 of them there
        assert found.count() == 8000 and found.select("file", "row").distinct().count() == 8000


def test_a_read_shuffles_no_tasks(spark, tmp_path, monkeypatch):
    path, log = str(tmp_path / "tasks"), str(tmp_path / "positions")
    write_tasks(tasks(spark, 500, projects=("p",)), path, max_records_per_file=100)
    record_position_changes(deletion_changes(spark, ["t00001", "t00002"], "p"), path, log, "p")
    record_position_changes(priority_changes(spark, ["t00003"], "p", 9), path, log, "p")
    out = read_tasks_at(spark, path, log, "p")
    assert out.count() == 498 and out.where("priority = 9").select("id").first().id == "t00003"
    def joins():
        out = read_tasks_at(spark, path, log, "p")
        out.collect()
        plan = out._jdf.queryExecution().executedPlan().toString()
        return "SortMergeJoin" in plan, plan.count("BroadcastHashJoin") >= 2, out.count()

    assert joins() == (False, True, 498)
    monkeypatch.setattr(positions, "BROADCAST_BYTES", 1000)
    assert joins()[0] and joins()[2] == 498


def test_bits_of_a_large_file(spark):
    last = 3 * positions.BITMAP_ROWS
    numbers = [0, 1, 7, 8, 32_767, 32_768, 32_769, 65_535, 65_536, last]
    changes = spark.createDataFrame([("p", "delete", "f", n) for n in numbers * 2], "project_id string, kind string, file string, row long")
    bits = deletion_bitmaps(changes)
    assert bits.count() == 4
    every = spark.range(last + 2).withColumn("_bucket", F.floor(F.col("id") / positions.BITMAP_ROWS)).join(bits, "_bucket", "left")
    gone = every.where(positions._bit(F.col("_gone"), F.col("id") % positions.BITMAP_ROWS)).select("id").collect()
    assert sorted(r.id for r in gone) == numbers


def test_a_task_written_again_is_free_of_old_changes(spark, tmp_path):
    path, log = str(tmp_path / "tasks"), str(tmp_path / "positions")
    write_tasks(tasks(spark, 10, projects=("p",)), path)
    record_position_changes(deletion_changes(spark, ["t00001"], "p"), path, log, "p")
    version = position_log(spark, log).version()
    record_position_changes(deletion_changes(spark, ["t00002"], "p"), path, log, "p")
    assert read_tasks_at(spark, path, log, "p", version).count() == 9 and read_tasks_at(spark, path, log, "p").count() == 8
    write_tasks(tasks(spark, 10, projects=("p",)), path)
    assert read_tasks_at(spark, path, log, "p").count() == 10
