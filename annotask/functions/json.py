"""JSON column expressions: compact text, answers, pre-annotations.

Two paths on purpose. Incoming answers are kept as compact JSON *text*
(string capture keeps key order and number spelling). Outgoing
pre-annotations become VARIANT, which ``to_json`` writes as nested JSON.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from annotask.schema import PREANNOTATION_PREFIX


def is_one_json_value(column) -> Column:
    """Whether the text is exactly one JSON value, with nothing after it.

    Spark's parser stops at the end of the first value, so the text is parsed
    both as the value of a field and as the element of an array: text that
    closes or continues the one does not parse as the other.
    """
    column = F.col(column) if isinstance(column, str) else column
    as_field = F.from_json(F.concat(F.lit('{"v":'), column, F.lit("}")), "v string, _corrupt_record string")
    as_element = F.from_json(F.concat(F.lit("["), column, F.lit("]")), "array<string>")
    return F.coalesce(as_field.getField("_corrupt_record").isNull() & (F.size(as_element) == 1), F.lit(False))


def compact_json(column) -> Column:
    """JSON text → the same value as compact text (no blanks), key order kept.

    The text is wrapped as the value of a one-field object and captured back
    as a string, which Spark re-serialises compactly; a JSON string keeps its
    quotes. Text that is not one JSON value gives NULL.
    """
    column = F.col(column) if isinstance(column, str) else column
    text = F.regexp_replace(column, r"^[ \t\r\n]+|[ \t\r\n]+$", "")
    captured = F.from_json(F.concat(F.lit('{"v":'), column, F.lit("}")), "v string").getField("v")
    plain = F.when(text.startswith('"') | (text == "null"), text).otherwise(captured)
    return F.when(is_one_json_value(column), plain)


def as_json_text(df: DataFrame, name: str) -> Column:
    """Any column as JSON text: strings are compacted, nested values serialised."""
    dtype = df.schema[name].dataType
    if isinstance(dtype, T.StringType):
        # Text that is not JSON is kept as it is rather than lost.
        return F.coalesce(compact_json(name), F.col(name))
    if isinstance(dtype, (T.StructType, T.MapType, T.ArrayType, T.VariantType)):
        return F.to_json(F.col(name))
    return F.regexp_extract(F.to_json(F.array(F.col(name))), r"^\[(.*)\]$", 1)


def answers_to_json(df: DataFrame, name: str = "answers") -> DataFrame:
    """Hold ``answers`` as one JSON string column, whatever its nested type.

    An absent column stays absent; a SQL NULL stays NULL.
    """
    if name not in df.columns:
        return df
    return df.withColumn(name, as_json_text(df, name))


def parse_preannotations(
    df: DataFrame, prefix: str = PREANNOTATION_PREFIX, on_error: str = "fail", flag: str = "_invalid"
) -> DataFrame:
    """Decode ``output_*`` string columns from JSON text to VARIANT.

    Only string columns are decoded (the choice is made from the schema, at
    plan time); nested columns are already structured and stay as they are.
    ``on_error="fail"`` fails the job on bad JSON; ``"reject"`` leaves NULL and
    adds a boolean column ``flag`` that is true where a non-null input did
    not parse, so callers can route those rows to rejects; an input column of
    that name is an error.
    """
    if on_error not in ("fail", "reject"):
        raise ValueError("on_error must be 'fail' or 'reject'")
    targets = [f.name for f in df.schema.fields if f.name.startswith(prefix) and isinstance(f.dataType, T.StringType)]
    if on_error == "reject" and flag in df.columns:
        raise ValueError(f"the input has a column {flag!r}; name another flag")
    if not targets:
        return df.withColumn(flag, F.lit(False)) if on_error == "reject" else df
    if on_error == "fail":
        return df.withColumns({c: F.parse_json(F.col(c)) for c in targets})
    parsed = {c: F.try_parse_json(F.col(c)) for c in targets}
    bad = [F.col(c).isNotNull() & parsed[c].isNull() for c in targets]
    invalid = bad[0]
    for b in bad[1:]:
        invalid = invalid | b
    return df.withColumn(flag, invalid).withColumns(parsed)
