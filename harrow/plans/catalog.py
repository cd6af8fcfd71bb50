"""Registry of named queries over the driver tables, each with its DuckDB oracle.

``register(name, sql, doubles)`` records a callable ``(spark, sf_dir) -> DataFrame``.
Double columns are rounded to 6 places on both sides so the value hashes agree.
Queries without SQL (iterative or model-based work) are checked on rows only.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}
PLACES = 6


def finalize(df: DataFrame) -> DataFrame:
    """Round double/float columns so both engines hash the same values."""
    exprs = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            exprs.append(F.round(F.col(f"`{f.name}`").cast("double"), PLACES).alias(f.name))
        else:
            exprs.append(F.col(f"`{f.name}`"))
    return df.select(*exprs)


def _wrap_sql(sql: str, doubles: Sequence[str]) -> str:
    if not doubles:
        return sql.strip()
    repl = ", ".join(f'round(CAST("{c}" AS DOUBLE), {PLACES}) AS "{c}"' for c in doubles)
    return f"SELECT * REPLACE ({repl}) FROM (\n{sql.strip()}\n) AS q"


def register(name: str, sql: str | None = None, doubles: Sequence[str] = ()):
    def deco(fn: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return finalize(fn(spark, sf_dir))
        run.__name__ = fn.__name__
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLE[name] = _wrap_sql(sql, doubles)
        return run
    return deco


def with_ctes(*ctes: str) -> str:
    """Join CTE fragments into one WITH prefix."""
    return "WITH " + ",\n".join(c.strip().rstrip(",") for c in ctes if c.strip())


def load_all() -> None:
    """Import every module that registers queries."""
    from harrow.plans import queries_core  # noqa: F401
    from harrow.plans import queries_eval  # noqa: F401
    from harrow.plans import queries_more  # noqa: F401
    from harrow.plans import queries_ml  # noqa: F401
