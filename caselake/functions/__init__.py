"""Column-level building blocks: every function returns a Column built from built-in expressions."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_col(value: Column | str) -> Column:
    """Accept a column name or a Column."""
    return F.col(value) if isinstance(value, str) else value
