"""Array functions on columns, and names for columns in passing."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def prefix_fold(values: Column, join: Callable[[Column, Column], Column]) -> Column:
    """Running fold of an array by an associative function, in log2(size) passes over it."""
    passes = F.sequence(F.lit(0), F.greatest(F.lit(0), F.ceil(F.log2(F.size(values).cast("double"))).cast("int")))

    def once(state: Column, k: Column) -> Column:
        step = F.pow(F.lit(2.0), k).cast("int")
        return F.transform(state, lambda x, i: F.when(i >= step, join(F.get(state, i - step), x)).otherwise(x))

    return F.aggregate(passes, values, once)


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value), with value worked out once however often it is used; inside of other lambdas, too."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def unused_name(df: DataFrame, name: str) -> str:
    """A column name that df does not have."""
    have = {c.lower() for c in df.columns}
    while name.lower() in have:
        name += "_"
    return name
