"""Work that is heavy for its bytes, dealt to all cores whatever files its rows come from.

A file of a few megabytes is one task, and small shuffles are joined into one; neither fits rows that take a millisecond each.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Tasks for each core.
TASKS = 4


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """df dealt to a few tasks for each core, by keys if there are any."""
    return df.repartition(TASKS * df.sparkSession.sparkContext.defaultParallelism, *keys)


def distinct_rows(df: DataFrame, *columns: str) -> DataFrame:
    """Each combination of values of some columns once, dealt to all cores."""
    return spread(df.select(*columns).distinct(), *columns)


def made_once(df: DataFrame, name: str, value: Column) -> DataFrame:
    """df with a column that is made once for each row: a filter on what is generated stays above it, one on what is computed repeats it below."""
    return df.withColumn(name, F.explode_outer(F.array(value)))
