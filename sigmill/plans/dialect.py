"""One SQL text for an operator: run by Spark over DataFrames, and rendered for DuckDB as the oracle."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame

from ..sources.tables import DUCK

RENDER = (
    (r"\bpercentile\(", "quantile_cont("),
    (r"(\d)D\b", r"\1::DOUBLE"),
    (r"\bdiv\b", "//"),
    (r"LEFT ANTI JOIN", "ANTI JOIN"),
    (r"AS STRING\)", "AS VARCHAR)"),
    (r"(first_value|last_value)\(([^()]+)\) IGNORE NULLS", r"\1(\2 IGNORE NULLS)"),
    (r"\bkurtosis\(", "kurtosis_pop("),
    (r"\bformat_string\('%\.2f', ", "printf('%.2f', "),
)


def run(sql: str, **tables: DataFrame) -> DataFrame:
    spark = next(iter(tables.values())).sparkSession
    used = {k: v for k, v in tables.items() if "{" + k + "}" in sql}
    return spark.sql(sql, **used)


def duck(sql: str) -> str:
    for pattern, put in RENDER:
        sql = re.sub(pattern, put, sql)
    names = [x for x in DUCK if "{" + x + "}" in sql]
    for x in names:
        sql = sql.replace("{" + x + "}", f"v_{x}")
    views = ", ".join(f"v_{x} AS ({DUCK[x]})" for x in names)
    if not views:
        return sql
    return f"WITH {views}, {sql.lstrip()[5:]}" if sql.lstrip().startswith("WITH ") else f"WITH {views} {sql}"
