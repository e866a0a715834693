"""Substring search by the index against the plain filter."""

import random

import pytest
from pyspark.sql import functions as F

from annotask.functions.filters import filter_tasks
from annotask.operators import substring_index
from annotask.operators.substring_index import candidate_files, grams_of, tasks_containing, update_substring_index
from annotask.schema import TASK_SCHEMA
from annotask.sinks.tables import write_tasks
from annotask.sources.tables import read_tasks


def tasks(spark, rows, project="p"):
    df = spark.createDataFrame([(f"t{i}", project, text, "new") for i, text in enumerate(rows)], "id string, project_id string, client_batch_id string, state string")
    return df.select(*(F.col(f.name) if f.name in df.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in TASK_SCHEMA.fields))


def ids(df):
    return sorted(r.id for r in df.collect())


def plain(spark, path, text, project="p"):
    stored = filter_tasks(read_tasks(spark, path, project_id=project), client_batch_id=text, client_batch_id_match_type="contains")
    return ids(stored)


def test_equals_the_plain_filter(spark, tmp_path):
    rng, path = random.Random(2), str(tmp_path / "tasks")
    texts = [None if rng.random() < 0.05 else "".join(rng.choice("abé%_") for _ in range(rng.randrange(9))) for _ in range(400)]
    write_tasks(tasks(spark, texts), path, max_records_per_file=25)
    searches = ["abé", "a%_b", "é", "ab", "aaaa", "%_%", "zzz", "abéabé"]
    want = [plain(spark, path, s) for s in searches]
    assert [ids(tasks_containing(spark, path, "p", s)) for s in searches] == want  # no index yet
    first = update_substring_index(spark, path)
    assert [ids(tasks_containing(spark, path, "p", s)) for s in searches] == want
    assert update_substring_index(spark, path) == first
    # New files are opened before the index knows them, and judged by it afterwards.
    write_tasks(tasks(spark, ["xxabéxx", None, ""]), path, mode="append")
    again = [plain(spark, path, s) for s in searches]
    assert [ids(tasks_containing(spark, path, "p", s)) for s in searches] == again
    assert update_substring_index(spark, path) == first + 1
    assert [ids(tasks_containing(spark, path, "p", s)) for s in searches] == again
    assert ids(tasks_containing(spark, path, "p", "abé", state="completed")) == ids(tasks_containing(spark, path, "none", "abé")) == []


def test_a_search_opens_only_the_files_that_can_hold_it(spark, tmp_path):
    path = str(tmp_path / "tasks")
    for part in range(12):
        write_tasks(tasks(spark, [f"batch-{part:02}-{i}" for i in range(20)]), path, mode="append")
    update_substring_index(spark, path)
    files = len(read_tasks(spark, path).inputFiles())
    assert files >= 12 and len(candidate_files(spark, path, "p", "batch")) == files
    assert len(candidate_files(spark, path, "p", "ch-07-")) == 1 and candidate_files(spark, path, "p", "nowhere") == []
    assert len(ids(tasks_containing(spark, path, "p", "ch-07-"))) == 20


def test_table_and_index_are_as_large_as_the_rows_need(spark, tmp_path):
    path = str(tmp_path / "tasks")
    write_tasks(tasks(spark, [f"batch {i % 50}" for i in range(1000)]), path, max_records_per_file=25)
    update_substring_index(spark, path)
    files = [f.stat().st_size for f in (tmp_path / "tasks").rglob("*.parquet")]
    assert len(files) >= 40 and sum(files) < len(files) * 16_384


def test_two_updates_at_once(spark, tmp_path, monkeypatch):
    from annotask.sinks.versions import Numbered

    path, put = str(tmp_path / "tasks"), Numbered.put
    write_tasks(tasks(spark, ["one-two"]), path)

    def overtaken(self, number, record):
        monkeypatch.setattr(Numbered, "put", put)
        update_substring_index(spark, path)
        return put(self, number, record)

    monkeypatch.setattr(Numbered, "put", overtaken)
    assert update_substring_index(spark, path) == 0
    assert ids(tasks_containing(spark, path, "p", "e-t")) == ["t0"]


@pytest.mark.parametrize("text,want", [(None, None), ("", []), ("ab", []), ("abc", ["abc"]), ("aaaa", ["aaa"]), ("abcd", ["abc", "bcd"])])
def test_grams(spark, text, want):
    df = spark.createDataFrame([(text,)], "t string")
    assert (df.select(grams_of(F.col("t")).alias("g")).first().g or []) == (want or [])
    assert substring_index.SIZE == 3
