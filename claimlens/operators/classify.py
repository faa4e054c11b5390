"""Risk classification of drugs, by word lists or by a reference table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimlens.config import DEFAULTS, STANDARD, Settings
from claimlens.functions.columns import first_true, mentions_any, percent, text_sql
from claimlens.functions.joins import join_unique

RISK_FLAGS = ("is_opioid", "is_benzodiazepine", "is_stimulant", "is_high_risk")


def flag_risk(df: DataFrame, settings: Settings = DEFAULTS, whole_word: bool = False) -> DataFrame:
    """Add a 0/1 flag per word list, ``is_high_risk`` and ``risk_category``.

    A word may match inside another one; ``whole_word=True`` stops that. The
    flags are projected first and only referenced afterwards, so each word
    list is searched once per row.
    """
    lists = settings.risk_lists
    flagged = df.withColumns({
        flag: mentions_any(("drug_name", "generic_name"), words, whole_word) for _, flag, words in lists
    })
    return flagged.withColumns({
        "is_high_risk": F.greatest(*[flag for _, flag, _ in lists]),
        "risk_category": first_true({name: f"{flag} = 1" for name, flag, _ in lists}, otherwise=STANDARD),
    })


CATEGORY = "upper(trim(risk_category))"


def _known_categories(settings: Settings) -> str:
    return "array(" + ", ".join(text_sql(c) for c in (*[name for name, _, _ in settings.risk_lists], STANDARD)) + ")"


def unknown_categories(reference: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """The reference table's categories that no setting knows, each with its rows and drugs; a missing one is NULL."""
    known = f"array_contains({_known_categories(settings)}, {CATEGORY})"
    return (
        reference.filter(f"NOT coalesce({known}, false)")
        .groupBy(F.expr(f"{CATEGORY} AS risk_category"))
        .agg(F.expr("count(1) AS row_count"), F.expr("count(DISTINCT upper(trim(drug_name))) AS drug_count"))
    )


def risk_from_reference(df: DataFrame, reference: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """Let a reference table (drug_name, risk_category) decide for the drugs it lists.

    Other drugs keep what the word lists said; categories are compared without
    case and outer blanks, and :func:`unknown_categories` tells which rows have
    one that the settings don't know. Where the table lists a drug twice, the
    category that comes first in the settings wins. The join is
    not hinted: AQE broadcasts the table once its real size is known to be
    small, and splits a hot drug when it is not.
    """
    lists = settings.risk_lists
    order = _known_categories(settings)
    listed = (
        reference.withColumn("risk_category", F.expr(CATEGORY))
        .filter(f"array_contains({order}, risk_category)")
        .groupBy(F.expr("upper(trim(drug_name)) AS drug_name"))
        .agg(F.expr(f"element_at({order}, cast(min(array_position({order}, risk_category)) AS int)) AS __listed"))
    )
    decided = {
        flag: F.expr(f"coalesce(cast(__listed = {text_sql(name)} AS int), {flag})") for name, flag, _ in lists
    }
    return (
        join_unique(df, listed, "drug_name")
        .withColumns({**decided, "risk_category": F.coalesce("__listed", "risk_category")})
        .withColumn("is_high_risk", F.greatest(*decided))
        .drop("__listed")
    )


def risk_counts(df: DataFrame) -> DataFrame:
    """One row: all, high-risk and opioid prescriptions, with shares in percent."""
    counts = df.agg(
        F.expr("count(1) AS total_records"),
        F.expr("count_if(is_high_risk = 1) AS high_risk_count"),
        F.expr("count_if(is_opioid = 1) AS opioid_count"),
    )
    return counts.withColumns({
        "high_risk_pct": percent("high_risk_count", "total_records"),
        "opioid_pct": percent("opioid_count", "total_records"),
    })
