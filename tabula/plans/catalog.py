"""Query catalog: every implemented operator as a (Spark plan, DuckDB oracle) pair.

``build(spark, sf_dir)`` returns the raw DataFrame of the operator over the
provided tables; ``spark_query`` rounds floating outputs to 9 significant
digits (``sig_round``) so engine-specific summation order does not change the
value hash, and ``oracle`` wraps the SQL the same way.  A query registered
without SQL is checked rows-only by the driver and by invariant tests here.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tabula.functions.columns import FLOATING, columns_of_type, map_columns
from tabula.functions.scalars import sig_round
from tabula.plans import sqlkit
from tabula.session import release
from tabula.sources.tables import load_tables


from tabula.plans.registry import CATALOG, Query, query  # noqa: F401


def stable(df: DataFrame) -> DataFrame:
    return map_columns(df, lambda c, _: sig_round(c), columns_of_type(df, *FLOATING))


def spark_query(name: str) -> Callable[[SparkSession, str], DataFrame]:
    q = CATALOG[name]

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        # operators keep intermediates they read twice; free those of earlier queries
        # (already consumed).  A freed frame is recomputed if read again.
        release()
        return stable(q.build(load_tables(spark, sf_dir), spark))
    run.__name__ = name
    return run


def oracle(name: str) -> str | None:
    q = CATALOG[name]
    return None if q.sql is None else sqlkit.stable(q.sql, q.doubles)


# Importing the query modules fills CATALOG.
from tabula.plans import queries_core  # noqa: E402,F401
from tabula.plans import queries_stats  # noqa: E402,F401
from tabula.plans import queries_model  # noqa: E402,F401
from tabula.plans import queries_scale  # noqa: E402,F401
from tabula.plans import queries_recipe  # noqa: E402,F401
from tabula.plans import queries_restart  # noqa: E402,F401
from tabula.plans import queries_wide  # noqa: E402,F401
