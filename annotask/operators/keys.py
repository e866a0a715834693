"""Id lists as DataFrames.

Id lists have no size limit: callers pass a DataFrame, and a Python list is
turned into one. Ids are made unique before any left join so rows do not
multiply.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def id_frame(spark: SparkSession, ids, name: str = "id", source_col: str | None = None, unique: bool = True) -> DataFrame:
    """A one-column DataFrame of ids (as strings), distinct unless ``unique=False``.

    Semi and anti joins never multiply rows, so they skip the de-duplication
    (and its shuffle).
    """
    if isinstance(ids, DataFrame):
        col = source_col or (name if name in ids.columns else ids.columns[0])
        out = ids.select(F.col(col).cast("string").alias(name)).where(F.col(name).isNotNull())
        return out.distinct() if unique else out
    if isinstance(ids, (str, int)):
        ids = [ids]
    rows = [(str(i),) for i in dict.fromkeys(ids) if i is not None]
    schema = T.StructType([T.StructField(name, T.StringType())])
    return spark.createDataFrame(rows, schema)
