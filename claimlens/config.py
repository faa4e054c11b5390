"""Settings of the workload. Pass a changed copy (``replace``) to any operator."""

from __future__ import annotations

from dataclasses import dataclass

# Drug words that put a claim into a risk category.
OPIOID_WORDS = (
    "OXYCODONE", "HYDROCODONE", "FENTANYL", "MORPHINE", "CODEINE",
    "TRAMADOL", "METHADONE", "HYDROMORPHONE", "OXYMORPHONE", "BUPRENORPHINE",
    "TAPENTADOL", "MEPERIDINE", "PERCOCET", "VICODIN", "NORCO",
)
BENZODIAZEPINE_WORDS = (
    "ALPRAZOLAM", "DIAZEPAM", "LORAZEPAM", "CLONAZEPAM", "TEMAZEPAM",
    "XANAX", "VALIUM", "ATIVAN", "KLONOPIN",
)
STIMULANT_WORDS = (
    "AMPHETAMINE", "DEXTROAMPHETAMINE", "METHYLPHENIDATE", "LISDEXAMFETAMINE",
    "ADDERALL", "RITALIN", "VYVANSE", "CONCERTA",
)

# Aggregation levels.
GEO_LEVELS = ("state", "zip", "county")
TIME_LEVELS = ("year", "quarter", "month")

STANDARD = "STANDARD"


@dataclass(frozen=True)
class Settings:
    """Thresholds and word lists; the defaults are the published privacy rules."""

    min_claims: int = 11
    max_cost_per_claim: float = 50000.0
    min_beneficiaries: int = 1
    hotspot_percentile: float = 0.95
    opioid_words: tuple[str, ...] = OPIOID_WORDS
    benzodiazepine_words: tuple[str, ...] = BENZODIAZEPINE_WORDS
    stimulant_words: tuple[str, ...] = STIMULANT_WORDS

    @property
    def risk_lists(self) -> tuple[tuple[str, str, tuple[str, ...]], ...]:
        """(category, flag column, words), first match wins."""
        return (
            ("OPIOID", "is_opioid", self.opioid_words),
            ("BENZODIAZEPINE", "is_benzodiazepine", self.benzodiazepine_words),
            ("STIMULANT", "is_stimulant", self.stimulant_words),
        )


DEFAULTS = Settings()
