"""Counts from cumulative cells against the scan."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from annotask.operators.frame_counts import FrameCounts, day_counts, state_moves
from annotask.operators.stats import project_state_counts
from annotask.sinks.tables import write_tasks
from annotask.sources.tables import read_tasks

STATES = ["new", "completed", "rejected"]


def tasks(spark, n, seed=1, start=0):
    rng, first = random.Random(seed), dt.datetime(2024, 1, 1)
    rows = []
    for i in range(n):
        at = None if rng.random() < 0.03 else first + dt.timedelta(minutes=rng.randrange(30 * 24 * 60), microseconds=rng.randrange(3))
        rows.append((f"t{start + i}", rng.choice("ppq"), rng.choice(STATES), at))
    return spark.createDataFrame(rows, "id string, project_id string, state string, created_at timestamp_ntz")


def counts(df):
    return sorted((r.project_id, r.state, r.n_tasks) for r in df.collect())


FRAMES = [
    (None, None), ("2024-01-05T10:00:00Z", "2024-01-20T11:30:00Z"), ("2024-01-05T00:00:00Z", "2024-01-06T00:00:00Z"),
    ("2024-01-05T10:00:00Z", "2024-01-05T20:00:00Z"), ("2024-01-05T10:00:00Z", "2024-01-06T09:00:00Z"), (None, "2024-01-10T12:00:00Z"),
    ("2024-01-10T12:00:00Z", None), ("2023-01-01T00:00:00Z", "2023-06-01T00:00:00Z"), ("2023-01-01T00:00:00Z", "2025-01-01T00:00:00Z"),
    ("2025-01-01T00:00:00Z", None), (None, "2024-01-01T00:00:00Z"), ("2024-01-29T00:00:00Z", "2024-03-01T00:00:00Z"),
    ("2024-01-20T00:00:00Z", "2024-01-10T00:00:00Z"),
]


@pytest.mark.parametrize("parts", [1, 3])
def test_every_frame_equals_the_scan(spark, tmp_path, parts):
    every = tasks(spark, 600).cache()
    cells = FrameCounts(spark, str(tmp_path / "cells"))
    for i in range(parts):
        cells.add(day_counts(every.where(F.abs(F.hash("id")) % parts == i)))
    for begin, end in FRAMES:
        assert counts(cells.project_state_counts(every, None, begin, end)) == counts(project_state_counts(every, None, begin, end)), (begin, end)
    begin, end = FRAMES[1]
    assert counts(cells.project_state_counts(every, "q", begin, end)) == counts(project_state_counts(every, "q", begin, end))


def test_moves_between_states_are_merged(spark, tmp_path):
    before = tasks(spark, 200).cache()
    after = before.where("id <> 't7'").withColumn("state", F.when(F.col("state") == "new", "completed").otherwise(F.col("state")))
    cells = FrameCounts(spark, str(tmp_path / "cells"))
    cells.add(day_counts(before))
    cells.add(state_moves(before, after))
    for begin, end in FRAMES[:6]:
        assert counts(cells.project_state_counts(after, None, begin, end)) == counts(project_state_counts(after, None, begin, end))


def test_two_additions_at_once(spark, tmp_path, monkeypatch):
    from annotask.sinks.versions import Numbered

    a, b = tasks(spark, 50), tasks(spark, 40, seed=2, start=100)
    cells, put = FrameCounts(spark, str(tmp_path / "cells")), Numbered.put

    def overtaken(self, number, record):
        monkeypatch.setattr(Numbered, "put", put)
        cells.add(day_counts(b))
        return put(self, number, record)

    monkeypatch.setattr(Numbered, "put", overtaken)
    assert cells.add(day_counts(a)) == 1
    both = a.unionByName(b)
    assert counts(cells.project_state_counts(both, None, *FRAMES[1])) == counts(project_state_counts(both, None, *FRAMES[1]))


def test_only_the_days_at_the_ends_are_read(spark, tmp_path):
    path = str(tmp_path / "tasks")
    write_tasks(tasks(spark, 3000), path, max_records_per_file=60, ranged=True)
    stored = read_tasks(spark, path)
    cells = FrameCounts(spark, str(tmp_path / "cells"))
    cells.add(day_counts(stored))
    out = cells.project_state_counts(stored, "p", *FRAMES[1])
    assert counts(out) == counts(project_state_counts(stored, "p", *FRAMES[1]))
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    try:
        plan = cells.project_state_counts(stored, "p", *FRAMES[1])._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")
    pushed = [line for line in plan.split("\n") if "PushedFilters" in line and "created_at" in line]
    assert pushed and all("GreaterThanOrEqual(created_at" in line and "LessThan(created_at" in line for line in pushed)
    assert plan.count("PushedFilters: [IsNotNull(day), EqualTo(day") >= 2


def test_empty(spark, tmp_path):
    cells = FrameCounts(spark, str(tmp_path / "cells"))
    none = tasks(spark, 1).limit(0)
    with pytest.raises(ValueError):
        cells.project_state_counts(none)
    cells.add(day_counts(none))
    assert counts(cells.project_state_counts(none)) == counts(cells.project_state_counts(none, None, *FRAMES[1])) == []
