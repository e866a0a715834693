"""Property tests: operators against brute-force Python on random small inputs."""

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from annotask.operators.paging import page_completeness, rank_within
from annotask.operators.retry import request_outcomes
from annotask.schema import RESPONSE_LOG_SCHEMA

SETTINGS = settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))

T0 = dt.datetime(2024, 1, 1)


@SETTINGS
@given(
    rows=st.lists(
        st.tuples(st.sampled_from(["hot", "hot", "hot", "a", "b", None]), st.integers(0, 20)),
        min_size=1,
        max_size=300,
    ),
    parts=st.integers(1, 9),
)
def test_rank_within_equals_sorted_position(spark, rows, parts):
    data = [(k, ts, f"id{i:04d}") for i, (k, ts) in enumerate(rows)]
    df = spark.createDataFrame(data, "key string, ts int, id string")
    got = {r.id: r.rank for r in rank_within(df, ["key"], ["ts", "id"], num_partitions=parts).collect()}
    expected = {}
    for key in {k for k, _, _ in data}:
        members = sorted((ts, i) for k, ts, i in data if k == key)
        expected.update({i: n + 1 for n, (_, i) in enumerate(members)})
    assert got == expected


def brute_completeness(pages, size):
    out = {}
    for result in {r for r, _, _ in pages}:
        mine = sorted((p, n) for r, p, n in pages if r == result)
        last_page, last_n = mine[-1]
        short_inner = sum(1 for p, n in mine if n < size) - (1 if last_n < size else 0)
        missing = last_page - len(mine)
        out[result] = (missing, short_inner, last_n >= size, missing == 0 and short_inner == 0 and last_n < size)
    return out


@SETTINGS
@given(
    pages=st.dictionaries(
        st.tuples(st.sampled_from(["r1", "r2", "r3"]), st.integers(1, 6)), st.integers(0, 3), min_size=1, max_size=15
    ),
)
def test_page_completeness_equals_brute_force(spark, pages):
    rows = [(r, p, n) for (r, p), n in pages.items()]
    df = spark.createDataFrame(rows, "result string, page int, n_tasks int")
    got = {
        r.result: (r.missing_pages, r.short_inner_pages, r.last_page_full, r.complete)
        for r in page_completeness(df, 3).collect()
    }
    assert got == brute_completeness(rows, 3)


def brute_outcome(attempts, max_tries=5):
    """attempts: list of (attempt, status) for one request."""

    def cls(s):
        if s is None or s in (429, 502, 503, 504):
            return "retry"
        return "failed" if s >= 400 else "ok"

    ordered = sorted(attempts)
    for a, s in ordered:
        if cls(s) != "retry":
            return ("finished" if cls(s) == "ok" else "failed", a, s)
    a, s = ordered[-1]
    return ("exhausted" if a >= max_tries else "retry", a, s)


@SETTINGS
@given(
    log=st.dictionaries(
        st.tuples(st.sampled_from(["q1", "q2", "q3", "q4"]), st.integers(1, 5)),
        st.sampled_from([None, 200, 204, 400, 404, 429, 500, 502, 503, 504]),
        min_size=1,
        max_size=20,
    )
)
def test_request_outcomes_equal_brute_force(spark, log):
    rows = [(rid, a, T0 + dt.timedelta(seconds=a), s, None) for (rid, a), s in log.items()]
    df = spark.createDataFrame(rows, RESPONSE_LOG_SCHEMA)
    got = {r.request_id: (r.outcome, r.attempt, r.status) for r in request_outcomes(df).collect()}
    expected = {}
    for rid in {r for r, _ in log}:
        expected[rid] = brute_outcome([(a, s) for (r, a), s in log.items() if r == rid])
    assert got == expected


TEXT = st.text(alphabet=st.characters(blacklist_categories=("Cs",)), max_size=12)


@SETTINGS
@given(
    tasks=st.lists(
        st.tuples(
            st.sampled_from(["p1", "p2", "p3"]),
            st.integers(0, 10**6),
            st.one_of(st.none(), TEXT),
            st.one_of(st.none(), st.dictionaries(st.sampled_from(["a", "b", "c"]), st.one_of(st.integers(-5, 5), TEXT), max_size=3)),
        ),
        min_size=1,
        max_size=40,
    ),
    page_size=st.integers(1, 7),
)
def test_pages_round_trip(spark, tasks, page_size):
    import json as _json

    from annotask.schema import TASK_SCHEMA
    from annotask.plans.landing import pack_pages
    from annotask.sources.pages import explode_envelope

    rows = [
        (f"t{i:03d}", p, None, cb, "new", 0, T0 + dt.timedelta(microseconds=us), None, None,
         None if ans is None else _json.dumps(ans, separators=(",", ":"), ensure_ascii=False))
        for i, (p, us, cb, ans) in enumerate(tasks)
    ]
    df = spark.createDataFrame(rows, TASK_SCHEMA)
    back = explode_envelope(pack_pages(df, page_size), "value", TASK_SCHEMA, keep=("result", "page"))
    # JSON is compared as values: escapes may be spelt differently (\u000b / \u000B).
    def val(text):
        return None if text is None else _json.loads(text)

    got = {r.id: (r.project_id, r.created_at, r.client_batch_id, val(r.answers), r.page, r.position) for r in back.collect()}
    expected = {}
    for p in {r[1] for r in rows}:
        mine = sorted((r for r in rows if r[1] == p), key=lambda r: (r[6], r[0]))
        for n, r in enumerate(mine):
            expected[r[0]] = (p, r[6], r[3], val(r[9]), n // page_size + 1, n % page_size + 1)
    assert got == expected


def brute_page(body):
    """(tasks, rejected) for one body, by the client's rule (bad text and objects without a key are rejects)."""
    import json as _json

    text = (body or "").strip()
    if text in ("", "{}", "[]", "null"):
        return 0, False
    try:
        value = _json.loads(text)
    except ValueError:
        return 0, True
    if not isinstance(value, dict) or ("task" not in value and "tasks" not in value):
        return 0, True
    if value.get("task") is not None:
        return 1, False
    return len(value.get("tasks") or []), False


BODY = st.one_of(
    st.sampled_from(["", "{}", "[]", "null", "nope", "[1]", '{"other": 1}', '{"tasks": null}', '{"task": null}', "{bad"]),
    st.lists(st.integers(0, 9), max_size=4).map(lambda ids: '{"tasks": [%s]}' % ", ".join('{"id": "t%d"}' % i for i in ids)),
    st.integers(0, 9).map(lambda i: '{"task": {"id": "t%d"}}' % i),
)


@SETTINGS
@given(bodies=st.lists(BODY, min_size=1, max_size=12))
def test_page_parsing_equals_brute_force(spark, bodies):
    from pyspark.sql import types as T

    from annotask.sources.pages import explode_envelope, parse_pages

    rec = T.StructType([T.StructField("id", T.StringType())])
    df = spark.createDataFrame([(i, b) for i, b in enumerate(bodies)], "page int, value string")
    pages = {r.page: (r.n_tasks, r.rejected) for r in parse_pages(df, "value").collect()}
    assert pages == {i: brute_page(b) for i, b in enumerate(bodies)}
    rows = explode_envelope(df, "value", rec).groupBy("page").count().collect()
    assert {r.page: r["count"] for r in rows} == {i: n for i, (n, _) in pages.items() if n}


FILTER_ROW = st.tuples(
    st.sampled_from(["p1", "p2", None]),
    st.sampled_from(["b1", "b2", None]),
    st.sampled_from(["50%_off", "50xxoff", "x_y", "plain", None]),
    st.sampled_from(["new", "in progress", "delivered", None]),
    st.integers(0, 20),
    st.one_of(st.none(), st.integers(0, 20)),
)


@SETTINGS
@given(
    rows=st.lists(FILTER_ROW, min_size=1, max_size=25),
    project=st.sampled_from([None, "p1"]),
    batch=st.sampled_from([None, "b2"]),
    cb=st.sampled_from([None, ("%_", "contains"), ("_", "contains"), ("plain", "exact"), ("50%_off", None)]),
    state=st.sampled_from([None, "in progress", "delivered"]),
    window=st.sampled_from([None, ("creation_date", 5, 15), ("completion_date", None, 10), ("creation_date", 3, None)]),
)
def test_task_filters_equal_brute_force(spark, rows, project, batch, cb, state, window):
    from annotask.schema import TASK_SCHEMA
    from annotask.sources.tables import multi_task_status

    def ts(d):
        return None if d is None else T0 + dt.timedelta(days=d)

    data = [(f"t{i}", p, b, c, s, 0, ts(cr), ts(co), None, None) for i, (p, b, c, s, cr, co) in enumerate(rows)]
    df = spark.createDataFrame(data, TASK_SCHEMA)
    kw = dict(project_id=project, batch_id=batch, state=state)
    if cb:
        kw.update(client_batch_id=cb[0], client_batch_id_match_type=cb[1])
    if window:
        kw.update(
            date_type=window[0],
            from_timestamp=None if window[1] is None else ts(window[1]).isoformat() + "Z",
            to_timestamp=None if window[2] is None else ts(window[2]).isoformat() + "Z",
        )
    got = sorted(r.id for r in multi_task_status(df, **kw).collect())

    def keep(r):
        _, p, b, c, s, _, cr, co, _, _ = r
        if project is not None and p != project:
            return False
        if batch is not None and b != batch:
            return False
        if cb:
            if c is None:
                return False
            if (cb[1] or "exact") == "exact" and c != cb[0]:
                return False
            if cb[1] == "contains" and cb[0] not in c:
                return False
        if state is not None and s != state:
            return False
        if window:
            d = cr if window[0] == "creation_date" else co
            if window[1] is not None and (d is None or not d > ts(window[1])):
                return False
            if window[2] is not None and (d is None or not d < ts(window[2])):
                return False
        return True

    assert got == sorted(r[0] for r in data if keep(r))


@SETTINGS
@given(
    projects=st.lists(st.sampled_from(["p1", "p2"]), min_size=1, max_size=20),
    picked=st.lists(st.integers(0, 25), max_size=10),
    scope=st.sampled_from([None, "p1"]),
)
def test_priorities_and_deletes_equal_brute_force(spark, projects, picked, scope):
    from annotask.operators.mutations import delete_tasks, update_priorities
    from annotask.schema import TASK_SCHEMA

    data = [(f"t{i}", p, None, None, "new", 0, T0, None, None, None) for i, p in enumerate(projects)]
    df = spark.createDataFrame(data, TASK_SCHEMA)
    ids = [f"t{i}" for i in picked]  # duplicates and unknown ids included
    hit = {r[0] for r in data if r[0] in ids and (scope is None or r[1] == scope)}
    prio = {r.id: r.priority for r in update_priorities(df, ids, -100, project_id=scope).collect()}
    assert prio == {r[0]: (-100 if r[0] in hit else 0) for r in data}
    left = sorted(r.id for r in delete_tasks(df, ids, project_id=scope).collect())
    assert left == sorted(r[0] for r in data if r[0] not in hit)


@SETTINGS
@given(
    projects=st.lists(st.sampled_from(["p1", "p2"]), min_size=1, max_size=12),
    rejections=st.lists(
        st.tuples(st.integers(0, 14), st.integers(0, 50), st.lists(st.sampled_from(["Not accurate", "Late", "Blurry"]), min_size=1, max_size=2)),
        max_size=12,
    ),
    scope=st.sampled_from([None, "p1"]),
)
def test_rejections_keep_the_latest_reasons(spark, projects, rejections, scope):
    from annotask.operators.mutations import reject_tasks
    from annotask.schema import TASK_SCHEMA

    data = [(f"t{i}", p, None, None, "new", 0, T0, None, None, None) for i, p in enumerate(projects)]
    df = spark.createDataFrame(data, TASK_SCHEMA)
    rej_rows = [(f"t{i}", reasons, T0 + dt.timedelta(minutes=m)) for i, m, reasons in rejections]
    rej = spark.createDataFrame(rej_rows, "id string, reasons array<string>, at timestamp_ntz")
    got = {r.id: (r.state, r.reject_reasons) for r in reject_tasks(df, rej, project_id=scope).collect()}
    expected = {}
    for tid, p, *_ in data:
        mine = [(at, reasons) for i, reasons, at in rej_rows if i == tid]
        if mine and (scope is None or p == scope):
            expected[tid] = ("rejected", max(mine)[1])
        else:
            expected[tid] = ("new", None)
    assert got == expected
