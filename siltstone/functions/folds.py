"""Steps over an array, each of which depends on the one before, as Arrow functions: linear, a row's array at a time."""

from __future__ import annotations

from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import StructType

from siltstone.session import ship


def fold(work: Callable[..., list], kind: str, *columns: Column) -> Column:
    """The arrays of type `kind` that work makes of each row's values, structs as dicts; null where any value is null.

    Columns should not hold lambdas of commutative operators: Spark 4.1 then
    fails to tell the function's two forms alike and doesn't run it in Python.
    """
    if spark := SparkSession.getActiveSession():
        ship(spark)
    arrow = to_arrow_type(StructType.fromDDL(f"x {kind}").fields[0].dataType)

    def run(*values: pa.Array) -> pa.Array:
        rows = zip(*(v.to_pylist() for v in values), strict=True)
        return pa.array([None if any(x is None for x in r) else work(*r) for r in rows], arrow)

    return F.arrow_udf(run, kind)(*columns)
