"""Landed response pages → task rows.

A landing is a folder of JSON lines, one response page a line:
``{"result": R, "page": N, "value": "<body>"}``, under ``project_id=<p>/``
folders where pages belong to projects. Many pages share a file, so a
listing of the landing grows with its bytes and not with its pages. Folders
with one body per file (``result=<id>/page=<n>/``) can be read as well.

A body is ``{"task": T}`` (one row), ``{"tasks": [T, ...]}`` (n rows), or an
empty body (``{}``, ``[]``, ``null``, blank: no rows; ``{"tasks": null}`` too).
Anything else is rejected as a body. Of a body that is an envelope, each record
is judged by itself: a record that is no object, or has a value that its column's
type cannot hold, is rejected, and the others are kept. Nothing is both.

A body is parsed once, straight into the record's types. Only where that leaves a
doubt (something did not fit, or the text is no envelope) is it taken apart again,
body, records and fields each as text, to see what exactly was wrong.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from annotask.functions.filters import rfc3339_column
from annotask.functions.json import is_one_json_value
from annotask.schema import CORRUPT_FIELD, ENVELOPE_SCHEMA, PAGE_RECORD_SCHEMA

JSON_OPTIONS = {
    "columnNameOfCorruptRecord": CORRUPT_FIELD,
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
}
# One body per file, with its result and page as folders.
PAGE_FILE_SCHEMA = "value string, result string, page int"
# One page per line; a line that is no JSON object comes whole as a body.
PAGE_LINE_SCHEMA = f"result string, page int, value string, {CORRUPT_FIELD} string"
# What became of a record or body.
ROW, BAD_RECORD, BAD_BODY = "row", "record", "body"
_EMPTY_BODIES = ("", "{}", "[]", "null")


def _is_time(dtype: T.DataType) -> bool:
    return isinstance(dtype, (T.TimestampType, T.TimestampNTZType))


def _fields_as_text(record: Column, record_schema: T.StructType) -> Column:
    """The record's fields as text: what is read does not depend on their types."""
    names = [*(f.name for f in record_schema.fields), CORRUPT_FIELD]
    return F.from_json(record, T.StructType([T.StructField(n, T.StringType()) for n in names]), JSON_OPTIONS)


def _typed(text: Column, dtype: T.DataType) -> Column:
    """A field's text as its type; NULL where it does not fit.

    Service timestamps carry nanoseconds and an offset
    (``2023-09-02T10:23:36.536167366Z``).
    """
    if isinstance(dtype, T.StringType):
        return text
    if _is_time(dtype):
        return rfc3339_column(text, dtype)
    if isinstance(dtype, T.VariantType):
        return F.try_parse_json(text)
    if isinstance(dtype, (T.StructType, T.ArrayType, T.MapType)):
        return F.from_json(text, dtype, JSON_OPTIONS)
    return text.try_cast(dtype)


# A body is parsed inside this text: whatever follows or closes it too early
# leaves the end mark out of place.
_END = "_end_of_the_body"


def _whole(body: Column, envelope: T.StructType) -> Column:
    """The body parsed as one envelope and nothing else: ``v`` (one element), the end mark and, where anything
    did not fit, the corrupt text."""
    schema = T.StructType(
        [T.StructField("v", T.ArrayType(envelope)), T.StructField(_END, T.IntegerType()), T.StructField(CORRUPT_FIELD, T.StringType())]
    )
    strict = JSON_OPTIONS | {"allowNonNumericNumbers": "false"}
    return F.from_json(F.concat(F.lit('{"v":['), body, F.lit(f'],"{_END}":1}}')), schema, strict)


def _fits(whole: Column, body: Column) -> Column:
    """Whether the body is an envelope with a task or tasks, all of whose values fit."""
    env = F.get(whole.getField("v"), F.lit(0))
    holds = env.getField("task").isNotNull() | env.getField("tasks").isNotNull()
    one = (F.size(whole.getField("v")) == 1) & (whole.getField(_END) == 1) & whole.getField(CORRUPT_FIELD).isNull()
    return F.coalesce(one & holds & ~F.contains(body, F.lit(_END)), F.lit(False))


def _is_empty_body(body: Column) -> Column:
    return F.coalesce(F.trim(body), F.lit("")).isin(*_EMPTY_BODIES)


def _slow_parse(df: DataFrame, body: Column, fits: Column) -> DataFrame:
    """For the bodies in doubt: the envelope with its records as text, and whether it is rejected."""
    env = F.from_json(body, ENVELOPE_SCHEMA, JSON_OPTIONS)
    df = df.withColumn("_env", F.when(~fits, env))
    keys = F.json_object_keys(body)
    has_key = F.coalesce(F.array_contains(keys, "task") | F.array_contains(keys, "tasks"), F.lit(False))
    sound = F.col(f"_env.{CORRUPT_FIELD}").isNull() & has_key & is_one_json_value(body)
    rejected = ~_is_empty_body(body) & ~F.coalesce(sound, F.lit(False))
    return df.withColumn("rejected", F.when(fits, F.lit(False)).otherwise(F.coalesce(rejected, F.lit(True))))


def _count(env: Column) -> Column:
    task, tasks = env.getField("task"), env.getField("tasks")
    return F.when(task.isNotNull(), F.lit(1)).when(tasks.isNotNull(), F.size(tasks)).otherwise(F.lit(0))


def parse_pages(df: DataFrame, body_col: str = "value") -> DataFrame:
    """Per page: its record count and a reject flag."""
    body = F.col(body_col)
    text_envelope = T.StructType([f for f in ENVELOPE_SCHEMA.fields if f.name != CORRUPT_FIELD])
    parsed = df.withColumn("_whole", _whole(body, text_envelope))
    parsed = parsed.withColumn("_fits", _fits(F.col("_whole"), body))
    parsed = _slow_parse(parsed, body, F.col("_fits"))
    n = F.when(F.col("_fits"), _count(F.get("_whole.v", F.lit(0)))).when(F.col("rejected"), F.lit(0)).otherwise(_count(F.col("_env")))
    return parsed.withColumn("n_tasks", n.cast("int")).drop("_whole", "_fits", "_env")


def _kept_names(keep, record_schema: T.StructType) -> dict[str, str]:
    """Page columns whose name a record field has too get a leading underscore."""
    taken = {f.name.lower() for f in record_schema.fields}
    return {c: f"_{c}" if c.lower() in taken else c for c in keep}


def explode_all(
    df: DataFrame,
    body_col: str = "value",
    record_schema: T.StructType = PAGE_RECORD_SCHEMA,
    keep: tuple[str, ...] | None = None,
) -> DataFrame:
    """One row per record and per rejected body, with ``_outcome`` (row, record, body)
    and ``_text`` (the text of what was rejected). ``task`` wins over ``tasks``.

    ``position`` is the 1-based place of the record in its page, so pages read
    back in (page, position) order give the service's order. A page column
    that shares its name with a record field is named ``_<name>``.
    """
    keep = tuple(c for c in df.columns if c != body_col) if keep is None else keep
    names = _kept_names((*keep, "position"), record_schema)
    # Times come in several spellings: they are parsed as text first.
    record = T.StructType([T.StructField(f.name, T.StringType() if _is_time(f.dataType) else f.dataType) for f in record_schema.fields])
    typed_envelope = T.StructType([T.StructField("task", record), T.StructField("tasks", T.ArrayType(record))])
    body = F.col("_body")
    pages = df.select(*keep, F.col(body_col).alias("_body")).withColumn("_whole", _whole(body, typed_envelope))
    times = [f for f in record_schema.fields if _is_time(f.dataType)]

    def bad_time(record: Column) -> Column:
        wrong = [record.getField(f.name).isNotNull() & _typed(record.getField(f.name), f.dataType).isNull() for f in times]
        return reduce(lambda a, b: a | b, wrong, F.lit(False))

    def items(env: Column) -> Column:
        return F.when(env.getField("task").isNotNull(), F.array(env.getField("task"))).otherwise(env.getField("tasks"))

    # A body with a time that does not fit is in doubt too. No row carries its page's body.
    sound = _fits(F.col("_whole"), body) & ~F.coalesce(F.exists(items(F.get("_whole.v", F.lit(0))), bad_time), F.lit(False))
    pages = _slow_parse(pages.withColumn("_fits", sound), body, F.col("_fits"))
    as_text = F.when(F.col("_fits"), F.lit(None)).when(F.col("rejected"), F.array(body)).otherwise(items(F.col("_env")))
    as_types = F.when(F.col("_fits"), items(F.get("_whole.v", F.lit(0))))
    pages = pages.withColumn("_types", F.coalesce(as_types, F.array().cast(T.ArrayType(record))))
    pages = pages.withColumn("_texts", F.coalesce(as_text, F.array().cast("array<string>")))
    both = F.arrays_zip("_types", "_texts")
    rows = pages.select(*keep, "rejected", "_fits", F.posexplode(both).alias("_pos", "_item"))
    fits, given, text = F.col("_fits"), F.col("_item").getField("_types"), F.col("_item").getField("_texts")
    rows = rows.withColumn("_fields", F.when(~fits & ~F.col("rejected"), _fields_as_text(text, record_schema)))
    is_object = F.when(fits, given.isNotNull()).otherwise(text.startswith("{") & F.col(f"_fields.{CORRUPT_FIELD}").isNull())

    def typed(f: T.StructField) -> Column:
        fast = _typed(given.getField(f.name), f.dataType) if _is_time(f.dataType) else given.getField(f.name)
        return F.when(fits, fast).otherwise(_typed(F.col("_fields").getField(f.name), f.dataType))

    rows = rows.select("*", F.struct(*[typed(f).alias(f.name) for f in record_schema.fields], F.lit(1).alias("_")).alias("_typed"))

    def misfit(f: T.StructField) -> Column:
        had = F.col("_fields").getField(f.name).isNotNull()
        if _is_time(f.dataType):
            had = F.when(fits, given.getField(f.name).isNotNull()).otherwise(had)
        else:
            had = ~fits & had  # what fits was checked by the parse
        return had & F.col("_typed").getField(f.name).isNull()

    misfits = [misfit(f) for f in record_schema.fields if not isinstance(f.dataType, T.StringType)]
    bad = reduce(lambda a, b: a | b, misfits, ~F.coalesce(is_object, F.lit(False)))
    outcome = F.when(F.col("rejected"), F.lit(BAD_BODY)).when(bad, F.lit(BAD_RECORD)).otherwise(F.lit(ROW))
    position = F.when(~F.col("rejected"), F.col("_pos") + 1).cast("int").alias(names["position"])
    rows = rows.withColumn("_outcome", outcome)
    text = F.when(F.col("_outcome") != ROW, text)
    return rows.select(
        *[F.col(c).alias(names[c]) for c in keep],
        position,
        *[F.col("_typed").getField(f.name).alias(f.name) for f in record_schema.fields],
        "_outcome",
        text.alias("_text"),
    )


def rows_of(exploded: DataFrame) -> DataFrame:
    """The task rows of :func:`explode_all`."""
    return exploded.where(F.col("_outcome") == F.lit(ROW)).drop("_outcome", "_text")


def rejects_of(exploded: DataFrame, record_schema: T.StructType = PAGE_RECORD_SCHEMA) -> DataFrame:
    """What :func:`explode_all` rejected: the page's columns, ``rejected`` (record or body) and ``text``."""
    names = [f.name for f in record_schema.fields]
    page = [c for c in exploded.columns if c not in (*names, "_outcome", "_text")]
    bad = exploded.where(F.col("_outcome") != F.lit(ROW))
    return bad.select(*page, F.col("_outcome").alias("rejected"), F.col("_text").alias("text"))


def explode_envelope(
    df: DataFrame,
    body_col: str = "value",
    record_schema: T.StructType = PAGE_RECORD_SCHEMA,
    keep: tuple[str, ...] | None = None,
) -> DataFrame:
    """One row per sound record of every body, with ``position``."""
    return rows_of(explode_all(df, body_col, record_schema, keep))


def envelope_rejects(
    df: DataFrame,
    body_col: str = "value",
    record_schema: T.StructType = PAGE_RECORD_SCHEMA,
    keep: tuple[str, ...] | None = None,
) -> DataFrame:
    """Records and bodies that give no row: page columns, ``position`` (of a record), ``rejected`` and ``text``."""
    return rejects_of(explode_all(df, body_col, record_schema, keep), record_schema)


def page_lines(df: DataFrame) -> DataFrame:
    """Pages from lines as read: a line that is no JSON object is a body itself."""
    return df.withColumn("value", F.coalesce("value", CORRUPT_FIELD)).drop(CORRUPT_FIELD)


def read_landing(spark: SparkSession, path: str, project_id=None) -> DataFrame:
    """The pages of a landing of lines: ``result``, ``page``, ``value`` (and the
    folders' columns, such as ``project_id``); of one project, only its folder is read."""
    if project_id is not None:
        path = project_folder(path, project_id)
    return page_lines(spark.read.schema(PAGE_LINE_SCHEMA).options(**JSON_OPTIONS).json(path))


def project_folder(path: str, project_id) -> str:
    """The folder of a project's pages; characters that folders cannot hold are escaped as Spark's writers do."""
    unsafe = set('"#%\'*/:=?\\\x7f{[]^') | {chr(i) for i in range(1, 32)}
    name = "".join(f"%{ord(c):02X}" if c in unsafe else c for c in str(project_id))
    return f"{path.rstrip('/')}/project_id={name}"


def read_page_files(spark: SparkSession, path: str, one_body_per_line: bool = False) -> DataFrame:
    """Raw page files: ``value`` (the body), ``result`` and ``page`` from the folders.

    With ``one_body_per_line`` every line of a file is a body; otherwise a
    file is one body (pages are bounded by the service's page size).
    """
    reader = spark.read.schema(PAGE_FILE_SCHEMA)
    if not one_body_per_line:
        reader = reader.option("wholetext", True)
    return reader.text(path)


def read_task_pages(
    spark: SparkSession,
    path: str,
    record_schema: T.StructType = PAGE_RECORD_SCHEMA,
    one_body_per_line: bool = False,
    lines: bool = False,
) -> DataFrame:
    """Every task of every landed page, with ``result``, ``page``, ``position``;
    ``lines``: from a landing of lines."""
    pages = read_landing(spark, path) if lines else read_page_files(spark, path, one_body_per_line)
    return explode_envelope(pages, "value", record_schema, keep=("result", "page"))


def page_task_counts(spark: SparkSession, path: str, lines: bool = False) -> DataFrame:
    """Per landed page: record count and reject flag (input of page completeness)."""
    pages = read_landing(spark, path) if lines else read_page_files(spark, path)
    return parse_pages(pages).select("result", "page", "n_tasks", "rejected")


def _widened(a: T.DataType, b: T.DataType) -> T.DataType:
    """A type for the values of both; text where nothing narrower holds both."""
    if a == b or isinstance(b, T.NullType):
        return a
    if isinstance(a, T.NullType):
        return b
    if isinstance(a, T.StructType) and isinstance(b, T.StructType):
        return _merge_struct(a, b)
    if isinstance(a, T.ArrayType) and isinstance(b, T.ArrayType):
        return T.ArrayType(_widened(a.elementType, b.elementType))
    if {type(a), type(b)} == {T.LongType, T.DoubleType}:
        return T.DoubleType()
    return T.StringType()


def _merge_struct(a: T.StructType | None, b: T.StructType | None) -> T.StructType:
    if a is None or b is None:
        return a if b is None else b
    other = {f.name: f.dataType for f in b.fields}
    merged = [T.StructField(f.name, _widened(f.dataType, other.pop(f.name, T.NullType()))) for f in a.fields]
    return T.StructType(merged + [T.StructField(n, t) for n, t in other.items()])


def infer_task_schema(
    spark: SparkSession, path: str, sampling_ratio: float = 1.0, answers: str = "answers", lines: bool = False
) -> T.StructType:
    """Record schema inferred from landed bodies, with ``answers`` pinned to string.

    Inference is one distributed pass over the files (sampled by
    ``sampling_ratio``); pinning ``answers`` keeps its type independent of the
    data, so it is captured as raw JSON text. A field of several types across
    ``task`` and ``tasks`` bodies gets one that holds both. Every record field is
    kept, whatever its name.
    """
    if lines:
        bodies = read_landing(spark, path)
        if sampling_ratio < 1.0:
            bodies = bodies.sample(fraction=sampling_ratio, seed=0)
        found = bodies.select(F.schema_of_variant_agg(F.try_parse_json("value"))).first()[0]
        env = variant_type(found)
    else:
        env = spark.read.option("multiLine", True).option("samplingRatio", sampling_ratio).json(path).schema
    single = env["task"].dataType if "task" in env.names else None
    many = env["tasks"].dataType if "tasks" in env.names else None
    many = many.elementType if isinstance(many, T.ArrayType) else None
    record = _merge_struct(many if isinstance(many, T.StructType) else None, single if isinstance(single, T.StructType) else None)
    fields = (record or T.StructType([])).fields
    return T.StructType([T.StructField(f.name, T.StringType()) if f.name == answers else f for f in fields])


def variant_type(text: str | None) -> T.StructType:
    """The type that a merged JSON schema names, its values as a JSON reader types them."""
    ddl = (text or "VOID").replace("OBJECT<", "STRUCT<")
    dtype = T.DataType.fromDDL(ddl)

    def read(t: T.DataType) -> T.DataType:
        if isinstance(t, T.StructType):
            return T.StructType([T.StructField(f.name, read(f.dataType)) for f in t.fields])
        if isinstance(t, T.ArrayType):
            return T.ArrayType(read(t.elementType))
        if isinstance(t, T.DecimalType):
            return T.DoubleType()
        return T.StringType() if isinstance(t, (T.VariantType, T.NullType)) else t

    dtype = read(dtype)
    return dtype if isinstance(dtype, T.StructType) else T.StructType([])
