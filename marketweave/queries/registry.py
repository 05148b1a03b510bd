"""Where every query keeps its Spark callable and the SQL that checks it."""

from __future__ import annotations

import re
from collections.abc import Callable
from datetime import date
from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from ..sources.landing import Landing
from .views_sql import VIEWS

TARGET = date(2001, 6, 29)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def _names(text: str) -> list[str]:
    return [t for t in re.split(r"[,\s]+", text) if t]


def present(df: DataFrame, rounds: str = "") -> DataFrame:
    """One spelling of dates, instants and rounded doubles for the comparison."""
    rounded = set(_names(rounds))
    out = []
    for field in df.schema.fields:
        col = F.col(f"`{field.name}`")
        if isinstance(field.dataType, (T.DateType, T.TimestampType, T.TimestampNTZType)):
            col = col.cast("string")
        elif isinstance(field.dataType, T.DecimalType):
            col = col.cast("double")
        elif isinstance(field.dataType, (T.IntegerType, T.ShortType)):
            col = col.cast("long")
        if field.name in rounded:
            col = F.round(col, 6)
        out.append(col.alias(field.name))
    return df.select(*out)


def oracle(body: str, dates: str = "", rounds: str = "", ints: str = "") -> str:
    """The body under the domain views it names, in the spelling of :func:`present`."""
    needed: list[str] = []

    def visit(text: str) -> None:
        for name in VIEWS:
            if re.search(rf"\b{name}\b", text) and name not in needed:
                visit(VIEWS[name])
                if name not in needed:
                    needed.append(name)

    visit(body)
    body = body.strip()
    own = ""
    if re.match(r"(?i)with\s", body):
        body = re.sub(r"(?i)^with\s", "", body)
        own, body = _split_ctes(body)
    parts = [f"{n} AS ({VIEWS[n].strip()})" for n in needed] + ([own] if own else [])
    head = f"WITH {', '.join(parts)} " if parts else ""
    swaps = [f"CAST({d} AS VARCHAR) AS {d}" for d in _names(dates)]
    swaps += [f"round({r}, 6) AS {r}" for r in _names(rounds)]
    swaps += [f"CAST({i} AS BIGINT) AS {i}" for i in _names(ints)]
    star = f"* REPLACE ({', '.join(swaps)})" if swaps else "*"
    return f"{head}SELECT {star} FROM ({body}) AS answer"


def _split_ctes(text: str) -> tuple[str, str]:
    """Cut ``a AS (...), b AS (...) SELECT ...`` before its final SELECT."""
    depth = 0
    for match in re.finditer(r"[()]|\bSELECT\b", text, re.I):
        token = match.group(0)
        if token == "(":
            depth += 1
        elif token == ")":
            depth -= 1
        elif depth == 0:
            return text[: match.start()].strip(), text[match.start():]
    raise ValueError("no final SELECT")


@lru_cache(maxsize=8)
def landing(spark: SparkSession, folder: str) -> Landing:
    """Queries on one folder share the lazy domain tables, so plans are not rebuilt per query."""
    return Landing(spark, folder)


def query(name: str, sql: str | None = None, dates: str = "", rounds: str = "", ints: str = ""):
    """Register ``fn(landing) -> DataFrame`` under ``name`` with its checking SQL."""

    def wrap(fn):
        def run(spark: SparkSession, folder: str) -> DataFrame:
            return present(fn(landing(spark, folder)), rounds)

        run.__name__ = name
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = oracle(sql.replace("$T", f"DATE '{TARGET}'"), dates, rounds, ints)
        return fn

    return wrap
