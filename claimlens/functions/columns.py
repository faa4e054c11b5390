"""Column expressions; all run inside generated code, none in Python.

Arguments are SQL expressions, mostly plain column names. One parsed
expression also costs the driver far fewer calls than a tree of columns.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F


def ratio(top: str, bottom: str) -> Column:
    """top / bottom as double; NULL where the bottom is zero or either is NULL."""
    return F.expr(ratio_sql(top, bottom))


def percent(top: str, bottom: str) -> Column:
    return F.expr(f"{ratio_sql(top, bottom)} * 100")


def ratio_sql(top: str, bottom: str) -> str:
    return f"try_divide(cast({top} AS double), cast({bottom} AS double))"


def text_sql(value: str) -> str:
    """A SQL string literal."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def mentions_any(columns: Iterable[str], words: Iterable[str], whole_word: bool = False) -> Column:
    """1 where any of the columns contains any of the words, else 0.

    A NULL column never matches by itself. The plain form searches bytes
    (``contains``), several times cheaper than a regular expression over the
    same alternatives; ``whole_word`` needs word boundaries and so a pattern.
    """
    words = list(words)
    if not words:
        return F.lit(0)
    if whole_word:
        pattern = text_sql(r"\b(?:" + "|".join(re.escape(w) for w in words) + r")\b")
        hits = [f"rlike({c}, {pattern})" for c in columns]
    else:
        hits = [f"contains({c}, {text_sql(w)})" for c in columns for w in words]
    return F.expr(f"CASE WHEN {' OR '.join(hits)} THEN 1 ELSE 0 END")


def first_true(conditions: Mapping[str, str], otherwise: str) -> Column:
    """The name of the first condition that holds; a NULL condition does not hold."""
    branches = " ".join(f"WHEN {met} THEN {text_sql(name)}" for name, met in conditions.items())
    return F.expr(f"CASE {branches} ELSE {text_sql(otherwise)} END")
