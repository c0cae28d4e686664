"""Column functions: built-in expressions first, Arrow-batched kernels where those can't express the semantics."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F


#: Rows of an Arrow batch at most: so many long texts, with what is made of them, fit beside the JVM in every task.
BATCH_ROWS = 256


def small_batches(spark: SparkSession) -> None:
    """A worker holds a batch of rows, whatever the table's size. Results are computed later, so the setting stays with the
    session; a smaller one is left alone."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key)) <= BATCH_ROWS:
        spark.conf.set(key, str(BATCH_ROWS))


def arrow_function(schema: str, make: Callable = F.pandas_udf) -> Callable:
    """A pandas function as a Column function, with F.arrow_udf one of Arrow arrays. The UDF is made when it is called, so that workers, which have no session, can import its module."""

    def wrap(f: Callable) -> Callable[..., Column]:
        def call(*columns: Column | str) -> Column:
            if spark := SparkSession.getActiveSession():
                small_batches(spark)
            return make(f, schema)(*columns)

        call.__doc__, call.__name__ = f.__doc__, f.__name__
        return call

    return wrap
