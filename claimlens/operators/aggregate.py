"""Named aggregates: what each mart groups by and measures, as data.

Each aggregate has at most one DISTINCT measure. Spark then plans a partial
aggregate on (keys, distinct column), a shuffle on both, and a second one on
the keys alone: a hot key is spread over many tasks by the distinct column,
and no row is duplicated as it would be for several DISTINCTs.

An aggregate can also be taken in two steps, so that a part of the input that
didn't change need not be read again: ``partial`` keeps, per part, one row for
each (keys, distinct value) with sums that add up exactly in any order, and
``merged`` makes the aggregate of such rows of all parts. Both ways give the
same rows; floating-point means agree but for their last digits.
"""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CLAIMS = "sum(total_claims)"
# Whole cents: exact in any order of the rows, and half the work of a decimal sum.
CENTS = "sum(cast(cast(total_cost AS decimal(18, 2)) * 100 AS bigint))"
COST = f"cast({CENTS} AS double) / 100"
PROVIDERS = "count(DISTINCT npi)"
PATIENTS = "sum(beneficiary_count)"
UNIT_COST = "avg(cost_per_claim)"
# In steps, a mean is made of an exact sum, so that it depends on no order of parts.
UNIT_COSTS = "sum(cast(cost_per_claim AS decimal(38, 18)))"

# How a measure is made of sums over parts; any other sum is the sum of its sums.
IN_STEPS = {
    COST: ((CENTS,), "cast(sum({0}) AS double) / 100"),
    UNIT_COST: ((UNIT_COSTS, "count(cost_per_claim)"), "try_divide(cast(sum({0}) AS double), sum({1}))"),
}
DISTINCT = re.compile(r"count\(DISTINCT (\w+)\)")


@dataclass(frozen=True)
class Grouping:
    """Keys, measures (name -> SQL aggregate) and an optional row filter."""

    keys: tuple[str, ...]
    measures: Mapping[str, str]
    where: str | None = None

    def of(self, df: DataFrame) -> DataFrame:
        rows = df.filter(self.where) if self.where else df
        measures = [F.expr(f"{measure} AS {name}") for name, measure in self.measures.items()]
        return rows.groupBy(*self.keys).agg(*measures)

    def _steps(self) -> dict[str, tuple[tuple[str, ...], str]]:
        """Per measure that isn't a DISTINCT, its sums over a part, and its SQL over these."""
        out = {}
        for name, measure in self.measures.items():
            if not DISTINCT.fullmatch(measure):
                if measure.startswith("hll_sketch_agg("):
                    sums, whole = (measure,), "hll_union_agg({0})"
                elif measure in IN_STEPS or measure.startswith("sum("):
                    sums, whole = IN_STEPS.get(measure, ((measure,), "sum({0})"))
                else:
                    raise ValueError(f"{measure} can't be taken in two steps")
                out[name] = (sums, whole.format(*(f"{name}__{k}" for k in range(len(sums)))))
        return out

    def distinct_columns(self) -> list[str]:
        found = [m[1] for m in map(DISTINCT.fullmatch, self.measures.values()) if m]
        return [c for c in dict.fromkeys(found) if c not in self.keys]

    def partial(self, df: DataFrame, parts: Sequence[str] = ()) -> DataFrame:
        """The sums of each part, by the columns ``parts``, the keys and the distinct column."""
        rows = df.filter(self.where) if self.where else df
        sums = [F.expr(s).alias(f"{name}__{k}") for name, (sums, _) in self._steps().items() for k, s in enumerate(sums)]
        return rows.groupBy(*parts, *self.keys, *self.distinct_columns()).agg(*sums)

    def merged(self, partials: DataFrame) -> DataFrame:
        """What ``of`` gives for all rows, from the sums of all parts."""
        steps = self._steps()
        measures = [F.expr(f"{steps[n][1] if n in steps else m} AS {n}") for n, m in self.measures.items()]
        kinds = dict(partials.dtypes)
        out = partials.groupBy(*self.keys).agg(*measures)
        # A sum of sums of decimals would have a wider type than the sum itself.
        widened = [n for n, (sums, whole) in steps.items() if whole == f"sum({n}__0)" and kinds[f"{n}__0"].startswith("decimal")]
        return out.withColumns({n: F.col(n).cast(kinds[f"{n}__0"]) for n in widened})
