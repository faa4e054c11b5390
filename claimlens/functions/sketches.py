"""Distinct counts that add up: HyperLogLog sketches, kept with a mart and united to any coarser level.

Exact distinct counts stay the default everywhere; a sketch is for readers who roll up further than a mart's own level.
A sketch takes at most about 2**lg_k bytes, however many values went into it, and is exact for few values.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimlens.operators.aggregate import CLAIMS, Grouping

LG_K = 14


def sketch_sql(column: str, lg_k: int = LG_K) -> str:
    """The aggregate that makes a sketch of a column's distinct values; NULLs don't count."""
    return f"hll_sketch_agg({column}, {lg_k})"


def error_bound(lg_k: int = LG_K, deviations: float = 3.0) -> float:
    """The relative error that a united sketch keeps within, at so many standard deviations."""
    return deviations * 1.04 / math.sqrt(1 << lg_k)


PROVIDER_SKETCHES = Grouping(
    keys=("report_year", "report_quarter", "provider_state", "specialty", "risk_category"),
    measures={"total_claims": CLAIMS, "provider_sketch": sketch_sql("npi")},
)


def roll_up(sketches: DataFrame, keys: Sequence[str], sketch: str = "provider_sketch", name: str = "providers") -> DataFrame:
    """Claims and estimated distinct providers by some of the keys of a table of sketches; without keys, in total."""
    return sketches.groupBy(*keys).agg(
        F.sum("total_claims").alias("total_claims"), F.hll_sketch_estimate(F.hll_union_agg(sketch)).alias(name)
    )
