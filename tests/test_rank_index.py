"""Pages by the rank index open the files that hold them."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from annotask.operators.paging import read_page
from annotask.operators.rank_index import indexed_page, rank_spans, update_rank_index
from annotask.schema import TASK_SCHEMA
from annotask.sinks.tables import write_tasks
from annotask.sources.tables import read_tasks


def tasks(spark, n, seed=1, start=0, projects=("hot", "hot", "hot", "b/1")):
    rng, first = random.Random(seed), dt.datetime(2024, 1, 1)
    # Few distinct times: ties are told apart by the id.
    rows = [(f"t{start + i:05}", rng.choice(projects), first + dt.timedelta(minutes=rng.randrange(n // 2 + 1))) for i in range(n)]
    df = spark.createDataFrame(rows, "id string, project_id string, created_at timestamp_ntz")
    return df.select(*(F.col(f.name) if f.name in df.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in TASK_SCHEMA.fields))


def ids(df):
    return [r.id for r in df.orderBy("created_at", "id").collect()]


def same_pages(spark, path, size, project="hot"):
    stored = read_tasks(spark, path).where(F.col("project_id") == project)
    whole = ids(stored)
    for page in range(1, len(whole) // size + 3):
        assert ids(indexed_page(spark, path, project, page, size)) == whole[(page - 1) * size : page * size], page
    return whole


@pytest.mark.parametrize("ranged", [True, False])
def test_every_page_equals_the_listing(spark, tmp_path, ranged):
    path = str(tmp_path / "tasks")
    write_tasks(tasks(spark, 300).repartition(5), path, max_records_per_file=20, ranged=ranged)
    assert len(same_pages(spark, path, 37)) + len(same_pages(spark, path, 50, "b/1")) == 300
    assert indexed_page(spark, path, "none", 1, 10).count() == 0
    page = indexed_page(spark, path, "hot", 2, 37)
    assert sorted(page.select("id").collect()) == sorted(read_page(read_tasks(spark, path, project_id="hot"), 2, 37).select("id").collect())


def test_a_page_opens_only_the_files_that_hold_it(spark, tmp_path):
    path = str(tmp_path / "tasks")
    write_tasks(tasks(spark, 2000, projects=("hot",)), path, max_records_per_file=50, ranged=True)
    assert len(read_tasks(spark, path).inputFiles()) >= 40
    update_rank_index(spark, path)
    for page in (1, 7, 20):
        assert len(indexed_page(spark, path, "hot", page, 100).inputFiles()) <= 4
    # The first page of 2000 rows is the table; the index holds no row of it.
    assert len(indexed_page(spark, path, "hot", 1, 2000).inputFiles()) >= 40


def test_files_are_as_large_as_their_rows_need(spark, tmp_path):
    path = tmp_path / "tasks"
    write_tasks(tasks(spark, 2000, projects=("hot",)), str(path), max_records_per_file=50, ranged=True)
    sizes = [f.stat().st_size for f in path.rglob("*.parquet")]
    # A bloom filter of Parquet's own size would take 1 MB in each.
    assert len(sizes) >= 40 and max(sizes) < 16_384
    one = read_tasks(spark, str(path)).where("id = 't00077'")
    assert one.count() == 1


def test_new_and_removed_files_are_noticed(spark, tmp_path, monkeypatch):
    from annotask.operators import rank_index

    path = str(tmp_path / "tasks")
    write_tasks(tasks(spark, 100), path, max_records_per_file=15, ranged=True)
    first = update_rank_index(spark, path)
    write_tasks(tasks(spark, 60, seed=2, start=1000), path, mode="append", max_records_per_file=15)
    read, opened = rank_index.task_files, []
    monkeypatch.setattr(rank_index, "task_files", lambda s, p, files=None: opened.append(files) or read(s, p, files))
    assert update_rank_index(spark, path) == first + 1
    # Only the new files' keys were read.
    assert [len(f) for f in opened if f] == [len([f for f in read(spark, path).inputFiles()]) - index_size(spark, path, first)]
    monkeypatch.undo()
    same_pages(spark, path, 25)
    write_tasks(tasks(spark, 40, seed=3), path, ranged=True)  # replaces both projects' files
    same_pages(spark, path, 25)


def index_size(spark, path, version):
    from annotask.operators.rank_index import ORDER, _stored, _versions

    return _stored(spark, path, ORDER, _versions(spark, path, ORDER).read(version)["folder"]).count()


def test_spans_of_overlapping_files(spark):
    rows = [("p", "a", 10, 1, 5), ("p", "b", 7, 5, 9), ("p", "c", 3, 10, 12), ("p", "d", 2, 2, 11), ("q", "e", 4, 0, 0)]
    files = spark.createDataFrame(rows, "project_id string, file string, n long, k int, l int")
    files = files.select("project_id", "file", "n", F.struct("k").alias("first"), F.struct(F.col("l").alias("k")).alias("last"))
    spans = {r.file: (r.from_rank, r.to_rank, r.n) for r in rank_spans(files).collect()}
    assert spans == {"a": (1, 19, 10), "b": (1, 19, 7), "c": (18, 22, 3), "d": (1, 22, 2), "e": (1, 4, 4)}


def test_bounds_are_checked(spark, tmp_path):
    with pytest.raises(ValueError):
        indexed_page(spark, str(tmp_path), "p", 0, 10)
