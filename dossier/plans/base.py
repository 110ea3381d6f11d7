"""Query registry.

Each registered query is a function ``(spark, sf_dir) -> DataFrame`` over
the driver's Parquet tables, plus (where the result is SQL-expressible)
the equivalent DuckDB SQL over the same tables.  Dirty inputs are derived
from the data by SQL expressions shared verbatim by both sides.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class Query:
    name: str
    run: Callable[[SparkSession, str], DataFrame]
    oracle: str | None


REGISTRY: dict[str, Query] = {}


def register(name: str, oracle: str | None = None):
    def deco(fn):
        if name in REGISTRY:
            raise ValueError(f"duplicate query {name}")
        REGISTRY[name] = Query(name, fn, oracle)
        return fn
    return deco


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


_TABLE_REF = re.compile(r"\b(FROM|JOIN)\s+(" + "|".join(
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations".split()) + r")\b")


def sql_on_tables(spark: SparkSession, sf_dir: str, text: str) -> DataFrame:
    """Run Spark SQL text whose FROM/JOIN names are driver tables, binding each name to its
    Parquet DataFrame as a query argument (no session-wide temp views)."""
    names = sorted({m.group(2) for m in _TABLE_REF.finditer(text)})
    bound = _TABLE_REF.sub(lambda m: f"{m.group(1)} {{{m.group(2)}}}", text)
    return spark.sql(bound, **{n: table(spark, sf_dir, n) for n in names})


def load_all() -> dict[str, Query]:
    from . import events_plans, extract_plans, keyed_plans, similar_plans, stream_plans, text_plans  # noqa: F401
    return REGISTRY
