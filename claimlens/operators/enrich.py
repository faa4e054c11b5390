"""Provider registry: projection, one row per provider, and the left join."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimlens.functions.joins import join_unique
from claimlens.schemas import REGISTRY_NAMES


def select_registry(raw: DataFrame) -> DataFrame:
    """The five registry columns in use, under their standard names."""
    return raw.select(*[F.col(f"`{old}`").alias(new) for old, new in REGISTRY_NAMES.items()])


def keep_latest(df: DataFrame, key: str, order: Sequence[str] = ()) -> DataFrame:
    """One row per key: the greatest in ``order``, ties broken by the other columns.

    An aggregate rather than a window, for two reasons: it is combined before
    the shuffle, so a key with very many copies sends one row per task; and
    Spark knows its output to be unique on the key, so it drops a later left
    join whose added columns nobody reads. The price is a sort before and after
    the shuffle, both of which can spill.
    """
    rest = [c for c in df.columns if c != key and c not in order]
    best = df.groupBy(key).agg(F.max(F.struct(*order, *rest)).alias("__best"))
    return best.select(*[key if c == key else F.col(f"__best.{c}").alias(c) for c in df.columns])


def enrich(claims: DataFrame, registry: DataFrame, key: str = "npi") -> DataFrame:
    """Left-join the registry (made unique first): every claim row stays, once.

    No broadcast hint: the registry may be large. AQE broadcasts it when it
    turns out small and otherwise splits a hot provider of the sort-merge join.
    """
    return join_unique(claims, registry.transform(keep_latest, key), key)


def unmatched_providers(claims: DataFrame, registry: DataFrame, key: str = "npi") -> DataFrame:
    """Providers with claims but without a registry entry, and their row count."""
    providers = claims.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("claim_rows"))
    return providers.join(registry.select(key), key, "left_anti")
