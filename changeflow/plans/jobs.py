"""Multi-statement jobs: statements run in order, the first failure stops the run."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, SparkSession

Step = str | Callable[[SparkSession], object]


def run_pipeline(spark: SparkSession, statements: Iterable[Step]) -> DataFrame | None:
    """Run SQL statements, or callables for what SQL cannot say, one after the other.

    Returns the rows of the last statement that is SQL. Statements see the views
    and tables of earlier ones, so an INSERT may read one catalog and write
    another.
    """
    result = None
    for number, step in enumerate(statements, 1):
        try:
            if callable(step):
                step(spark)
            else:
                result = spark.sql(step)
        except Exception as error:
            error.add_note(f"in statement {number}: {step}")
            raise
    return result
