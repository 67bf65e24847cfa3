"""Registry of end-to-end queries over the test tables.

Each entry pairs a Spark callable ``(spark, sf_dir) -> DataFrame`` with the
equivalent DuckDB SQL over the same Parquet tables (or ``None`` where only a
row-count check is meaningful). Column names are aliased identically on both
sides; integers are ``bigint``, doubles are rounded where float summation
order could differ.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Callable

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


@dataclass
class Query:
    name: str
    fn: Callable[[SparkSession, str], DataFrame]
    sql: str | None
    bench: bool = False


REGISTRY: dict[str, Query] = {}


def query(name: str, sql: str | None = None, bench: bool = False):
    def deco(fn):
        if name in REGISTRY:
            raise ValueError(f"duplicate query {name}")
        REGISTRY[name] = Query(name, fn, sql, bench)
        return fn
    return deco


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def q(s: str) -> str:
    """SQL string literal."""
    return "'" + s.replace("'", "''") + "'"


def load_all() -> dict[str, Query]:
    # Importing the plan modules registers their queries.
    import importlib
    for mod in PLAN_MODULES:
        importlib.import_module(f"{__package__}.{mod}")
    return REGISTRY


PLAN_MODULES = ["plan_templates", "plan_chunking", "plan_chatlog", "plan_qa", "plan_assemble", "plan_convo", "plan_eval", "plan_charset", "plan_generate", "plan_similarity", "plan_io"]
