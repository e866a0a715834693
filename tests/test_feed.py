"""Calls of exactly so many rows from the numbered feed."""

import json
import os
import random
import threading

import pytest

from annotask import AnnotationTables
from annotask.sinks.versions import Numbered
from annotask.sources.landings import files_of, latest_landing, register_files, register_new
from annotask.streaming import feed as F
from annotask.streaming.feed import call_deliveries, feed_rejects, publish, read_call, read_feed, read_whole_feed


def delivery(i, project="p", batch="b"):
    return {"id": f"d{i}", "project_id": project, "batch_id": batch, "client_batch_id": "cb", "answers": {"k": i}}


def land(landing, name, pages, project="p"):
    """A file with a line per page; returns its path."""
    path = os.path.join(landing, f"project_id={project}")
    os.makedirs(path, exist_ok=True)
    name = os.path.join(path, f"{name}.json")
    with open(name, "w") as out:
        for n, body in enumerate(pages, 1):
            body = body if isinstance(body, str) else json.dumps({"tasks": body})
            out.write(json.dumps({"result": "r", "page": n, "value": body}) + "\n")
    return name


def ids(df):
    return [r.id for r in df.orderBy("seq").collect()]


@pytest.fixture
def paths(tmp_path):
    return str(tmp_path / "landing"), str(tmp_path / "feed")


def test_calls_of_a_limit_stop_and_go_on_inside_a_page(spark, paths):
    landing, feed = paths
    land(landing, "f1", [[delivery(i) for i in range(5)], [delivery(i) for i in range(5, 7)]])

    def call(limit, consumer="A", **more):
        return ids(call_deliveries(spark, landing, feed, "p", consumer, limit, **more))

    assert call(3) == ["d0", "d1", "d2"]
    assert call(3) == ["d3", "d4", "d5"]
    assert call(2, "B") == ["d0", "d1"]
    land(landing, "f0", [[delivery(7)]])  # its name comes first, it landed later
    assert call(1) == ["d6"] and call(5) == ["d7"] and call(5) == []
    assert call(None, "B") == [f"d{i}" for i in range(2, 8)]
    assert call(None, "C") == [f"d{i}" for i in range(8)]


def test_against_a_plain_queue(spark, paths):
    landing, feed = paths
    rng, queue, at, number = random.Random(5), {"p": [], "q": []}, {}, 0
    for step in range(6):
        for name in sorted(rng.sample("abcdef", 2)):
            project = rng.choice(["p", "q"])
            pages = []
            for _ in range(rng.randint(1, 3)):
                page = [delivery(number + i, project, rng.choice("xy")) for i in range(rng.randint(0, 4))]
                number += len(page)
                pages.append(page)
            land(landing, f"{step}-{name}", pages, project)
            # Files of a landing are taken in order of their whole names.
            queue[project] += [(f"{step}-{name}", t) for page in pages for t in page]
        for _ in range(2):
            who, project, limit = rng.choice("AB"), rng.choice(["p", "q"]), rng.choice([1, 3, 5, None])
            batch = rng.choice([None, None, "x"])
            got = call_deliveries(spark, landing, feed, project, who, limit, batch_id=batch)
            assert got.columns[-1] == "seq"
            rest = [t for _, t in queue[project][at.get((who, project), 0) :]]
            want, used = [], 0
            for used, task in enumerate(rest, 1):
                if batch is None or task["batch_id"] == batch:
                    want.append(task["id"])
                if len(want) == limit:
                    break
            at[who, project] = at.get((who, project), 0) + used
            assert ids(got) == want, (step, who, project, limit, batch)
    assert read_whole_feed(spark, feed).count() == number


def test_a_named_call_is_read_again(spark, paths):
    landing, feed = paths
    land(landing, "f1", [[delivery(i, batch="xy"[i % 2]) for i in range(10)]])
    first = ids(call_deliveries(spark, landing, feed, "p", "A", 2, call="monday", batch_id="y"))
    assert first == ["d1", "d3"]
    # The caller died, and asks again; other calls came in between.
    assert ids(call_deliveries(spark, landing, feed, "p", "A", 3)) == ["d4", "d5", "d6"]
    assert ids(call_deliveries(spark, landing, feed, "p", "A", 2, call="monday")) == first
    assert ids(read_call(spark, landing, feed, "p", "monday", "A")) == first
    assert ids(read_call(spark, landing, feed, "p", 1, "A")) == ["d4", "d5", "d6"]
    with pytest.raises(KeyError):
        read_call(spark, landing, feed, "p", "tuesday", "A")
    # Another consumer's call of that name is its own.
    assert ids(call_deliveries(spark, landing, feed, "p", "B", 1, call="monday")) == ["d0"]


def test_two_calls_at_once_get_different_rows(spark, paths):
    landing, feed = paths
    land(landing, "f1", [[delivery(i) for i in range(12)]])
    publish(spark, landing, feed)
    got, barrier = [], threading.Barrier(3)

    def call():
        barrier.wait()
        got.append(ids(call_deliveries(spark, landing, feed, "p", "A", 4, discover=False)))

    threads = [threading.Thread(target=call) for _ in range(3)]
    [t.start() for t in threads]
    [t.join() for t in threads]
    assert sorted(x for g in got for x in g) == sorted(f"d{i}" for i in range(12)) and {len(g) for g in got} == {4}


def test_a_publisher_that_died_or_lost_is_never_seen(spark, paths, monkeypatch):
    landing, feed = paths
    land(landing, "f1", [[delivery(1), delivery(2)]])
    put = Numbered.put

    def overtaken(self, number, record):
        if self.path.endswith("/versions"):
            monkeypatch.setattr(Numbered, "put", put)
            publish(spark, landing, feed)  # another publisher is faster
            assert not put(self, number, record)
            return False
        return put(self, number, record)

    monkeypatch.setattr(Numbered, "put", overtaken)
    assert publish(spark, landing, feed) == 0
    assert len([f for f in os.listdir(f"{feed}/data") if f.startswith("_version")]) == 2
    assert ids(call_deliveries(spark, landing, feed, "p")) == ["d1", "d2"]
    assert read_whole_feed(spark, feed).count() == 2

    def dies(*args):
        raise RuntimeError("lost")

    land(landing, "f2", [[delivery(3)]])
    monkeypatch.setattr(Numbered, "put", lambda self, n, r: dies() if self.path.endswith("/versions") else put(self, n, r))
    with pytest.raises(RuntimeError):
        publish(spark, landing, feed)
    monkeypatch.setattr(Numbered, "put", put)
    assert ids(call_deliveries(spark, landing, feed, "p")) == ["d3"]


def test_a_call_opens_only_the_folders_of_its_rows(spark, paths, monkeypatch):
    landing, feed = paths
    monkeypatch.setattr(F, "VERSIONS_PER_STEP", 2)
    for i in range(5):
        register_files(spark, landing, [land(landing, f"f{i}", [[delivery(2 * i, "pq"[i == 4]), delivery(2 * i + 1)]], "pq"[i == 4])])
        publish(spark, landing, feed, discover=False)
    rows, last, version = read_feed(spark, feed, "p", 3, 5)
    assert ids(rows) == ["d3", "d4"] and (last, version) == (5, 2)
    assert len({os.path.dirname(f) for f in rows.inputFiles()}) == 2
    assert ids(call_deliveries(spark, landing, feed, "p", limit=7, discover=False)) == [f"d{i}" for i in range(7)]
    # The next call starts at the version in which the last one ended.
    assert ids(call_deliveries(spark, landing, feed, "p", limit=7, discover=False)) == ["d7", "d9"]
    assert ids(call_deliveries(spark, landing, feed, "none", discover=False)) == []


def test_registered_landings(spark, paths):
    landing, _ = paths
    assert latest_landing(spark, landing) == -1 and register_new(spark, landing) is None
    one = land(landing, "f1", [[delivery(1)]])
    assert register_files(spark, landing, [one]) == 0 and register_new(spark, landing) is None
    land(landing, "f2", [[delivery(2)]], "q")
    number = register_new(spark, landing)
    assert files_of(spark, landing, number)[-1].endswith("project_id=q/f2.json")
    assert register_new(spark, landing) is None


def test_what_cannot_be_read_does_not_count(spark, paths):
    landing, feed = paths
    land(landing, "f1", [[dict(delivery(1), completed_at=""), delivery(2), 7], "not json", [delivery(3)]])
    assert ids(call_deliveries(spark, landing, feed, "p", limit=2)) == ["d2", "d3"]
    assert sorted((r.page, r.rejected) for r in feed_rejects(spark, feed).collect()) == [(1, "record"), (1, "record"), (2, "body")]


def test_before_anything_landed(spark, paths):
    landing, feed = paths
    empty = call_deliveries(spark, landing, feed, "p", limit=3)
    assert empty.count() == 0 and {"id", "answers", "seq"} <= set(empty.columns)
    assert feed_rejects(spark, feed).count() == 0 and read_whole_feed(spark, feed).count() == 0
    with pytest.raises(ValueError):
        call_deliveries(spark, landing, feed, "p", limit=0)


def test_facade(spark, paths):
    landing, feed = paths
    land(landing, "f1", [[delivery(i) for i in range(3)]])
    at = AnnotationTables(spark, landing_path=landing, feed_path=feed)
    assert ids(at.get_delivered_tasks_since_last_call_to_table(spark, "p", consumer="me", limit=2)) == ["d0", "d1"]
    assert ids(at.get_delivered_tasks_since_last_call_to_table(spark, "p", consumer="me")) == ["d2"]
    with pytest.raises(ValueError):
        AnnotationTables(spark, landing_path=landing).get_delivered_tasks_since_last_call_to_table(spark, "p", limit=2)
