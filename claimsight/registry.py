"""Named queries: one Spark builder and (where SQL can state it) one oracle.

Every operator module registers its public queries here.  A builder takes a
relation set (see :class:`claimsight.sources.mapping.Relations`) and returns a
lazy DataFrame; the oracle is a DuckDB statement over the same mapping.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType


@dataclass(frozen=True)
class Query:
    name: str
    build: Callable[..., DataFrame]
    sql: str | None
    doc: str = ""


REGISTRY: dict[str, Query] = {}


def register(name: str, sql: str | None = None):
    """Decorator: register ``fn(rel) -> DataFrame`` under ``name``."""
    def deco(fn):
        add(name, fn, sql, fn.__doc__ or "")
        return fn
    return deco


def add(name: str, fn, sql: str | None, doc: str = "") -> None:
    if name in REGISTRY:
        raise ValueError(f"query {name} registered twice")
    REGISTRY[name] = Query(name, fn, sql, doc)


def finalize(df: DataFrame) -> DataFrame:
    """Output contract: decimals leave as double (the oracle casts the same)."""
    if not any(isinstance(f.dataType, DecimalType) for f in df.schema.fields):
        return df
    return df.select(*[F.col(f.name).cast("double").alias(f.name)
                       if isinstance(f.dataType, DecimalType) else F.col(f.name)
                       for f in df.schema.fields])


def load_all() -> dict[str, Query]:
    """Import every module that registers queries and return the registry."""
    from .operators import quality, gate, fraud, writes  # noqa: F401
    from .plans import models, features, oversampling, reports, sketches, training  # noqa: F401
    from .streaming import in_force, jobs, keyed_state  # noqa: F401
    return REGISTRY
