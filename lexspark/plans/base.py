"""Registration of catalogue queries: a Spark plan and the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(oracle: str | None = None):
    """Register a plan under its function's name, with the SQL of the same result if SQL can express it."""

    def add(f):
        QUERIES[f.__name__] = f
        if oracle:
            ORACLES[f.__name__] = oracle
        return f

    return add


def t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def re2(pattern: str) -> str:
    """A rule's pattern in RE2's dialect, quoted for SQL."""
    for a, b in (("(?iuU)", "(?i)"), ("(?iu)", "(?i)"), ("(?U)", ""), ("(?imuU)", "(?im)")):
        pattern = pattern.replace(a, b)
    return pattern.replace("'", "''")


#: Canonical text in DuckDB.
SQL_CANONICAL = """(SELECT CASE WHEN c = '' THEN '' ELSE c || chr(10) END FROM (SELECT regexp_replace(regexp_replace(regexp_replace(nfc_normalize(coalesce({0}, '')), '\\r\\n?', chr(10), 'g'), '[ \\t\\v\\f]+(\\n|$)', '\\1', 'g'), '\\n+$', '') AS c))"""
