"""Column projections of the status views."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from annotask.schema import DELIVERY_COLUMNS


def omit_answers(df: DataFrame) -> DataFrame:
    """Drop ``answers``; column pruning then keeps it out of the scan."""
    return df.drop("answers")


def same_as_delivery(df: DataFrame) -> DataFrame:
    """Shape a status row like a delivery record (the delivery column set)."""
    return df.select(*[c for c in DELIVERY_COLUMNS if c in df.columns])


def omit_failed_task_data(df: DataFrame, failed_col: str = "failed", data_col: str = "data") -> DataFrame:
    """Blank the input data of tasks that failed creation; the rows stay."""
    return df.withColumn(data_col, F.when(~F.col(failed_col), F.col(data_col)))
