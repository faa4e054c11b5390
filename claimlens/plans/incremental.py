"""Aggregates of the clean layer that are kept in parts, so that a run reads only what changed.

For every grouping there is a table of sums (``Grouping.partial``) in parts by landed folder, as the clean layer is. Its
manifest notes which version of each clean part it was made of. A refresh compares these with the clean layer's manifest,
reads the clean parts that differ, and replaces their sums; the aggregate is then made of the sums of all parts.

The sums hold a row for each (keys, distinct value) of a part, since distinct counts don't add up: about as many rows as
providers where providers are counted, and those of the clean layer, in few columns, for drugs per provider and providers
per drug. ``functions/sketches.py`` has counts that do add up.
"""

from __future__ import annotations

from collections.abc import Mapping
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession

from claimlens.operators.aggregate import Grouping
from claimlens.sinks.marts import CLEAN_PATH, LANDED_FROM, MARTS, Change, read_clean
from claimlens.sinks.versions import Manifest, current, read_version, write_version

PARTIALS_PATH = "partials"


class Refreshed(NamedTuple):
    """A table of sums before and after, and the landed folders whose sums are new."""

    path: str
    before: Manifest | None
    after: Manifest
    stale: list[str]


def refresh(spark: SparkSession, output: str, name: str, grouping: Grouping) -> Refreshed:
    """Bring one table of sums up to the clean layer; reads nothing where it is already."""
    path = f"{output}/{PARTIALS_PATH}/{name}"
    sources = current(spark, f"{output}/{CLEAN_PATH}").by_value()
    made_by = repr((grouping.keys, sorted(grouping.measures.items()), grouping.where))
    before = current(spark, path)
    same = before is not None and before.notes.get("grouping") == made_by
    known = dict(before.notes["sources"]) if same else {}
    stale = sorted(p for p in known.keys() | sources.keys() if known.get(p) != sources.get(p))
    if same and not stale:
        return Refreshed(path, before, before, [])
    rows = read_clean(spark, output, [p for p in stale if p in sources])
    notes = {"sources": sources, "grouping": made_by}
    sums = grouping.partial(rows, [LANDED_FROM])
    after = write_version(sums, path, (LANDED_FROM,), stale if same else None, in_parts=True, notes=notes)
    return Refreshed(path, before if same else None, after, stale)


def _touched(spark: SparkSession, found: Refreshed, column: str) -> tuple | None:
    """The values of a key that the sums of the stale parts hold, or held before: as many as the mart has folders."""
    if found.before is None:
        return None
    parts = [read_version(spark, found.path, m, found.stale).select(column) for m in (found.before, found.after)]
    return tuple(r[0] for r in parts[0].union(parts[1]).distinct().collect())


def aggregates(
    spark: SparkSession, output: str, groupings: Mapping[str, Grouping], of_mart: Mapping[str, str]
) -> tuple[dict[str, DataFrame], dict[str, Change]]:
    """Every grouping of the whole clean layer, and for the marts in ``of_mart`` (source -> grouping) what changed."""
    found = {name: refresh(spark, output, name, grouping) for name, grouping in groupings.items()}
    made = {name: groupings[name].merged(read_version(spark, f.path, f.after)) for name, f in found.items()}
    changes = {}
    for mart in MARTS:
        if mart.source in of_mart:
            f = found[of_mart[mart.source]]
            folders = _touched(spark, f, mart.partition_by[0]) if mart.partition_by and f.stale else None
            changes[mart.source] = Change(_state(f.after), _state(f.before), folders)
    return made, changes


def _state(manifest: Manifest | None) -> str | None:
    return None if manifest is None else str(manifest.number)
