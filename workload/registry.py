"""Registration of queries, and the rounding both engines apply."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a query under a name, with its SQL where SQL can state it."""

    def register(function):
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = function
        if sql is not None:
            ORACLES[name] = sql
        return function

    return register


# Sums of doubles depend on the order of addition, so results are rounded before
# they are compared.  The offset moves the rounding limits off the short
# decimals (halves of a cent, averages of a few cents) that real values hit.
OFFSET = 0.013


def r(expression: str, digits: int = 6) -> str:
    """Rounded SQL expression."""
    return f"round({expression} + {OFFSET * 10 ** -digits:.3e}, {digits})"


def rounded(df: DataFrame, columns: dict[str, int] | list[str]) -> DataFrame:
    """Round columns in place as :func:`r` does."""
    digits = columns if isinstance(columns, dict) else dict.fromkeys(columns, 6)
    return df.withColumns({c: F.round(F.col(c) + F.lit(float(f"{OFFSET * 10 ** -d:.3e}")), d) for c, d in digits.items()})
