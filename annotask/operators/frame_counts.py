"""Counts of a time frame from cumulative cells: two cells and the two days at its ends.

A cell says how many tasks of a project and state were created up to the end of a day. The count of any
frame is the difference of two cells, plus the tasks of the frame's first and last day, which are read from the
table (its files are sorted by creation time). Cells are made from counts per day, and these are added up: what was
written since, or a task that went from one state to another (-1 and +1 on its day), is merged without
reading the tasks again. Cells are kept for every day between the first and the last, so a
lookup is by equality; there are days x states x projects of them, however many tasks.
"""

from __future__ import annotations

import datetime as _dt
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from annotask.functions.filters import filter_tasks, parse_timestamp
from annotask.operators.page_runs import running_within
from annotask.sinks.versions import Numbered

_DAYS = "project_id string, state string, day date, n long"
_CELLS = "project_id string, state string, day date, n long, upto long"


def day_counts(tasks: DataFrame) -> DataFrame:
    """(project_id, state, day, n) of the tasks; a null day holds those without a creation time."""
    return tasks.groupBy("project_id", "state", F.to_date("created_at").alias("day")).agg(F.count("*").alias("n"))


def state_moves(before: DataFrame, after: DataFrame) -> DataFrame:
    """Day counts to add where tasks ``before`` became ``after`` (removed and new tasks included)."""
    out = day_counts(before).withColumn("n", -F.col("n")).unionByName(day_counts(after))
    return out.groupBy("project_id", "state", "day").agg(F.sum("n").alias("n")).where("n <> 0")


def cumulative_cells(counts: DataFrame) -> DataFrame:
    """Day counts with ``upto``, on every day from the first to the last of all; a null day stays as it is."""
    dated = counts.where("day is not null")
    span = dated.agg(F.min("day").alias("first"), F.max("day").alias("last")).first()
    undated = counts.where("day is null").withColumn("upto", F.lit(None).cast("long"))
    if span["first"] is None:
        return undated
    days = F.explode(F.sequence(F.lit(span["first"]), F.lit(span["last"]))).alias("day")
    zeros = dated.select("project_id", "state").distinct().select("project_id", "state", days, F.lit(0).cast("long").alias("n"))
    every = dated.unionByName(zeros).groupBy("project_id", "state", "day").agg(F.sum("n").alias("n"))
    cells = running_within(every, ["project_id", "state"], ["day"], "n", "_rank", "upto").drop("_rank")
    return cells.unionByName(undated)


class FrameCounts:
    """Cumulative cells under a path, in versions (``sinks.versions``)."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self.versions = Numbered(spark, f"{self.path}/versions")

    def _cells(self, record: dict) -> DataFrame:
        return self.spark.read.schema(_CELLS).parquet(f"{self.path}/cells/{record['folder']}")

    def add(self, counts: DataFrame) -> int:
        """Merge day counts into the newest version and make the next one; of two at once each is merged once."""
        version = self.versions.latest()
        while True:
            before, merged = self.versions.read(version), counts.select("project_id", "state", "day", "n")
            if before is not None:
                merged = self._cells(before).select("project_id", "state", "day", "n").unionByName(merged)
            merged = merged.groupBy("project_id", "state", "day").agg(F.sum("n").alias("n"))
            folder = uuid.uuid4().hex
            cells = cumulative_cells(merged)
            cells.hint("rebalance", "project_id").sortWithinPartitions("project_id", "day").write.partitionBy("project_id").parquet(f"{self.path}/cells/{folder}")
            last = self.spark.read.schema(_CELLS).parquet(f"{self.path}/cells/{folder}").agg(F.min("day"), F.max("day")).first()
            first, last = (None if d is None else d.isoformat() for d in last)
            if self.versions.put(version + 1, {"folder": folder, "first": first, "last": last}):
                return version + 1
            version = self.versions.latest(version + 1)

    def project_state_counts(self, tasks: DataFrame, project_id=None, from_timestamp=None, to_timestamp=None) -> DataFrame:
        """(project_id, state, n_tasks) of the tasks created in the strict time frame, as ``stats.project_state_counts``.

        ``tasks`` is the table that the cells count; only the frame's first and last day of it are read.
        """
        record = self.versions.read(self.versions.latest())
        if record is None:
            raise ValueError("nothing was counted yet")
        cells = filter_tasks(self._cells(record), project_id=project_id)
        if from_timestamp is None and to_timestamp is None:
            whole = cells.groupBy("project_id", "state").agg(F.sum("n").alias("n_tasks"))
            return whole.where("n_tasks <> 0")
        begin = None if from_timestamp is None else parse_timestamp(from_timestamp)
        end = None if to_timestamp is None else parse_timestamp(to_timestamp)
        parts = []
        # Whole days: after the first day of the frame, before its last one.
        first = None if begin is None else begin.date()
        last = None if end is None else end.date() - _dt.timedelta(days=1)
        if record["last"] is not None:
            newest, oldest = (_dt.date.fromisoformat(record[k]) for k in ("last", "first"))
            upper = newest if last is None else min(last, newest)
            lower = None if first is None or first < oldest else min(first, newest)
            if upper >= oldest and (lower is None or lower < upper):
                for day, sign in ((upper, 1), (lower, -1)):
                    if day is not None:
                        at = cells.where(F.col("day") == F.lit(day))
                        parts.append(at.select("project_id", "state", (F.col("upto") * sign).alias("n")))
        # The days at the ends, one where they are the same.
        framed = filter_tasks(tasks, project_id=project_id, from_timestamp=from_timestamp, to_timestamp=to_timestamp)
        for day in sorted({t.date() for t in (begin, end) if t is not None}):
            inside = [F.lit(str(d)).cast("timestamp_ntz") for d in (day, day + _dt.timedelta(days=1))]
            of_day = framed.where((F.col("created_at") >= inside[0]) & (F.col("created_at") < inside[1]))
            parts.append(of_day.groupBy("project_id", "state").agg(F.count("*").alias("n")))
        out = parts[0]
        for part in parts[1:]:
            out = out.unionByName(part)
        return out.groupBy("project_id", "state").agg(F.sum("n").alias("n_tasks")).where("n_tasks <> 0")
