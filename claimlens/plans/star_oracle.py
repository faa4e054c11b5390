"""The same queries as plain SQL for another engine, written independently.

Each string is complete: the shared steps are spelled out as WITH clauses.
"""

from __future__ import annotations


def significant(value: str) -> str:
    """Ten significant digits of numbers from 1e-9 up; smaller ones to 19 decimals."""
    steps = " ".join(f"WHEN abs({value}) >= 1e{p} THEN round({value}, {9 - p})" for p in range(11, -10, -1))
    return f"CASE WHEN {value} IS NULL THEN NULL {steps} ELSE round({value}, 19) END"


KEY = "npi, drug_name, generic_name, report_date"

FACT = """
SELECT cast(c_custkey AS varchar) AS npi, c_name AS provider_name,
       concat('CITY_', cast(c_custkey % 50 AS varchar)) AS provider_city,
       n_name AS provider_state, r_name AS provider_region,
       lpad(cast(c_custkey % 97 AS varchar), 5, '0') AS provider_zip,
       c_mktsegment AS specialty,
       upper(trim(p_name)) AS drug_name, upper(trim(p_type)) AS generic_name,
       cast(date_trunc('month', o_orderdate) AS date) AS report_date,
       cast(sum(l_quantity) AS bigint) AS total_claims,
       count(*) AS total_fills,
       cast(sum(l_quantity * (p_size % 3)) AS bigint) AS total_day_supply,
       cast(sum(cast(l_extendedprice AS decimal(18,2))) AS double) AS total_cost,
       count(DISTINCT l_suppkey) AS beneficiary_count
FROM lineitem
JOIN orders   ON l_orderkey = o_orderkey
JOIN customer ON o_custkey = c_custkey
JOIN nation   ON c_nationkey = n_nationkey
JOIN region   ON n_regionkey = r_regionkey
JOIN part     ON l_partkey = p_partkey
GROUP BY 1, 2, 3, 4, 5, 6, 7, 8, 9, 10"""

KEPT = """
SELECT *, total_cost / nullif(total_claims, 0) AS cost_per_claim,
       total_cost / nullif(total_day_supply, 0) AS cost_per_day,
       total_day_supply / nullif(total_fills, 0) AS avg_day_supply,
       'CLEAN' AS data_quality
FROM fact
WHERE npi IS NOT NULL AND drug_name IS NOT NULL AND total_claims >= 11
  AND beneficiary_count >= 1 AND total_cost / nullif(total_claims, 0) <= 5000"""

FLAGS = """
SELECT *, CASE WHEN is_opioid = 1 OR is_benzodiazepine = 1 OR is_stimulant = 1 THEN 1 ELSE 0 END AS is_high_risk,
       CASE WHEN is_opioid = 1 THEN 'OPIOID' WHEN is_benzodiazepine = 1 THEN 'BENZODIAZEPINE'
            WHEN is_stimulant = 1 THEN 'STIMULANT' ELSE 'STANDARD' END AS risk_category
FROM (
  SELECT *,
    CASE WHEN regexp_matches(drug_name, '{o}') OR regexp_matches(generic_name, '{o}') THEN 1 ELSE 0 END AS is_opioid,
    CASE WHEN regexp_matches(drug_name, '{b}') OR regexp_matches(generic_name, '{b}') THEN 1 ELSE 0 END
      AS is_benzodiazepine,
    CASE WHEN regexp_matches(drug_name, '{s}') OR regexp_matches(generic_name, '{s}') THEN 1 ELSE 0 END AS is_stimulant
  FROM {source}) w"""

WORDS = {"o": "HOT|BOLT", "b": "RED|GEAR", "s": "OLD|RING"}
WHOLE_WORDS = {k: rf"\b({v})\b" for k, v in WORDS.items()}

FLAGGED = f"""
SELECT *, cast(year(report_date) AS integer) AS report_year,
       concat('Q', cast(quarter(report_date) AS varchar)) AS report_quarter,
       cast(month(report_date) AS integer) AS report_month
FROM ({FLAGS.format(source="kept", **WORDS)}) f"""

REGISTRY = """
SELECT cast(s_suppkey AS varchar) AS npi, s_name AS org_name, n_name AS npi_state
FROM supplier JOIN nation ON s_nationkey = n_nationkey"""

ENRICHED = "SELECT f.*, r.org_name, r.npi_state FROM flagged f LEFT JOIN registry r ON f.npi = r.npi"

PROVIDER_KEYS = "npi, provider_name, provider_city, provider_state, provider_zip, specialty"
PROVIDER = f"""
SELECT *, cast(provider_opioid_claims AS double) / provider_total_claims * 100 AS opioid_percentage
FROM (
  SELECT {PROVIDER_KEYS},
         cast(sum(total_claims) AS bigint) AS provider_total_claims,
         cast(sum(cast(total_cost AS decimal(18,2))) AS double) AS provider_total_cost,
         cast(sum(CASE WHEN is_opioid = 1 THEN total_claims END) AS bigint) AS provider_opioid_claims,
         cast(sum(CASE WHEN is_high_risk = 1 THEN total_claims END) AS bigint) AS provider_highrisk_claims,
         count(DISTINCT drug_name) AS unique_drugs_prescribed,
         cast(sum(beneficiary_count) AS bigint) AS total_beneficiaries
  FROM flagged GROUP BY {PROVIDER_KEYS}) p"""

MEASURES = """cast(sum(total_claims) AS bigint) AS {p}_claims,
       cast(sum(cast(total_cost AS decimal(18,2))) AS double) AS {p}_cost"""


def _geo(column: str, level: str) -> str:
    return f"""
SELECT {column}, risk_category,
       {MEASURES.format(p=level + '_total')},
       count(DISTINCT npi) AS {level}_provider_count,
       cast(sum(beneficiary_count) AS bigint) AS {level}_beneficiary_count,
       {significant('avg(cost_per_claim)')} AS {level}_avg_cost_per_claim
FROM flagged GROUP BY {column}, risk_category"""


def _trend(prefix: str, *period: str) -> str:
    keys = ", ".join((*period, "provider_state", "risk_category"))
    return f"""
SELECT {keys}, {MEASURES.format(p=prefix)}, count(DISTINCT npi) AS {prefix}_providers,
       {significant('avg(cost_per_claim)')} AS avg_cost_per_claim
FROM flagged GROUP BY {keys} ORDER BY {keys}"""


def _hotspot(order: str = "ASC", percentile: float = 0.95) -> str:
    return f"""
SELECT *, CASE WHEN state_opioid_rank >= {percentile} THEN 1 ELSE 0 END AS is_hotspot
FROM (SELECT *, cast(state_total_claims AS double) / nullif(state_beneficiary_count, 0) AS claims_per_beneficiary,
             percent_rank() OVER (PARTITION BY risk_category ORDER BY state_total_claims {order}) AS state_opioid_rank
      FROM state) h"""


ZIP = f"""
SELECT provider_zip, provider_state, {MEASURES.format(p='zip_opioid')},
       count(DISTINCT npi) AS zip_opioid_providers,
       cast(sum(beneficiary_count) AS bigint) AS zip_opioid_beneficiaries
FROM flagged WHERE is_opioid = 1 GROUP BY provider_zip, provider_state"""

DRUG = f"""
SELECT drug_name, generic_name, risk_category, {MEASURES.format(p='drug_total')},
       count(DISTINCT npi) AS prescriber_count, {significant('avg(cost_per_claim)')} AS avg_cost_per_claim,
       cast(sum(beneficiary_count) AS bigint) AS total_patients
FROM flagged GROUP BY drug_name, generic_name, risk_category"""

SPECIALTY = f"""
SELECT specialty, risk_category, {MEASURES.format(p='specialty')},
       count(DISTINCT npi) AS specialty_provider_count
FROM flagged GROUP BY specialty, risk_category"""

STEPS = {
    "fact": ("", FACT),
    "kept": ("fact", KEPT),
    "flagged": ("kept", FLAGGED),
    "registry": ("", REGISTRY),
    "enriched": ("flagged registry", ENRICHED),
    "provider": ("flagged", PROVIDER),
    "state": ("flagged", _geo("provider_state", "state")),
    "hotspot": ("state", _hotspot()),
    "zip": ("flagged", ZIP),
    "drug": ("flagged", DRUG),
    "specialty_mart": ("flagged", SPECIALTY),
    "yearly": ("flagged", _trend("yearly", "report_year")),
}


def _over(needs: str, body: str) -> str:
    """``body`` behind the WITH clauses of the steps it needs."""
    order: list[str] = []

    def add(name: str) -> None:
        for need in STEPS[name][0].split():
            add(need)
        if name not in order:
            order.append(name)

    for name in needs.split():
        add(name)
    clauses = ",\n".join(f"{name} AS ({STEPS[name][1]})" for name in order)
    return f"WITH {clauses}\n{body.strip()}" if clauses else body.strip()


def _kept_by(condition: str, columns: str) -> str:
    return _over("fact", f"""
SELECT * FROM (SELECT {columns} FROM fact) f WHERE {condition}""")


def _rule_columns(**blanked) -> str:
    names = [*KEY.split(", "), "total_claims", "total_cost", "beneficiary_count"]
    return ", ".join(f"nullif({n}, {blanked[n]}) AS {n}" if n in blanked else n for n in names)


# Columns of the enriched fact and their Spark types.
ENRICHED_TYPES = {
    **dict.fromkeys((
        "npi", "provider_name", "provider_city", "provider_state", "provider_region", "provider_zip", "specialty",
        "drug_name", "generic_name", "data_quality", "risk_category", "report_quarter", "org_name", "npi_state",
    ), "string"),
    **dict.fromkeys(("total_claims", "total_fills", "total_day_supply", "beneficiary_count"), "bigint"),
    **dict.fromkeys(("cost_per_claim", "cost_per_day", "avg_day_supply"), "double"),
    **dict.fromkeys((
        "is_opioid", "is_benzodiazepine", "is_stimulant", "is_high_risk", "report_year", "report_month",
    ), "int"),
    "report_date": "date",
    "total_cost": "decimal(18,2)",
}
PROFILE = """
SELECT *, cast(null_count AS double) / nullif(row_count, 0) * 100 AS null_pct FROM (
""" + "\nUNION ALL ".join(
    f"SELECT '{c}' AS column_name, '{t}' AS column_type, count(*) AS row_count, count(*) - count({c}) AS null_count "
    "FROM enriched"
    for c, t in ENRICHED_TYPES.items()
) + ") c"

TOP_PROVIDER_ORDER = (
    "provider_total_claims DESC, npi, provider_name, provider_city, provider_state, provider_zip, specialty"
)

REFERENCE = "SELECT drug_name FROM (SELECT DISTINCT upper(trim(p_name)) AS drug_name FROM part WHERE upper(p_name) LIKE '%PLATE%') p"

ORACLE: dict[str, str] = {
    "scan_year_filter": _over("fact", """
SELECT * FROM fact WHERE report_date >= DATE '1997-01-01' AND report_date < DATE '1998-01-01'"""),
    "union_years": _over("fact", """
SELECT * REPLACE (CASE WHEN report_date >= DATE '1998-01-01' THEN beneficiary_count END AS beneficiary_count)
FROM fact"""),
    "rename_columns": """
SELECT cast(c_custkey AS varchar) AS npi, c_name AS provider_name,
       concat('CITY_', cast(c_custkey % 50 AS varchar)) AS provider_city,
       n_name AS provider_state, r_name AS provider_region,
       lpad(cast(c_custkey % 97 AS varchar), 5, '0') AS provider_zip, c_mktsegment AS specialty
FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""",
    "filter_required": _kept_by(
        "npi IS NOT NULL AND drug_name IS NOT NULL AND total_claims IS NOT NULL",
        _rule_columns(npi="'7'", drug_name="'RED BOLT'", total_claims="20")),
    "filter_privacy": _kept_by("total_claims >= 11", _rule_columns(total_claims="20")),
    "filter_beneficiaries": _kept_by("beneficiary_count >= 1", _rule_columns(beneficiary_count="2")),
    "filter_cost_cap": _kept_by(
        "total_cost / nullif(total_claims, 0) <= 5000", _rule_columns(total_claims="20")),
    "normalize_text": """
SELECT p_partkey, upper(p_name) AS drug_name, upper(p_type) AS generic_name,
       upper(p_brand) AS provider_state,
       concat(upper(substr(p_type, 1, 1)), lower(substr(p_type, 2))) AS specialty
FROM part""",
    "derived_metrics": _over("fact", f"""
SELECT {KEY}, total_cost / nullif(total_claims, 0) AS cost_per_claim,
       total_cost / nullif(total_day_supply, 0) AS cost_per_day,
       cast(total_day_supply AS double) / nullif(total_fills, 0) AS avg_day_supply
FROM fact"""),
    "clean_full": _over("kept", "SELECT * FROM kept"),
    "clean_counts": _over("kept", """
SELECT i AS initial_count, c AS clean_count, i - c AS removed_count,
       cast(i - c AS double) / nullif(i, 0) * 100 AS removed_pct
FROM (SELECT (SELECT count(*) FROM fact) AS i, (SELECT count(*) FROM kept) AS c) n"""),
    "reject_reasons": _over("fact", """
SELECT reject_reason, count(*) AS row_count FROM (
  SELECT CASE WHEN npi IS NULL THEN 'MISSING_NPI' WHEN drug_name IS NULL THEN 'MISSING_DRUG'
              WHEN total_claims IS NULL THEN 'MISSING_CLAIMS' WHEN total_claims < 11 THEN 'LOW_CLAIMS'
              WHEN beneficiary_count IS NULL OR beneficiary_count < 1 THEN 'LOW_BENEFICIARIES'
              WHEN total_cost IS NULL OR total_cost / total_claims > 5000 THEN 'HIGH_COST_PER_CLAIM'
         END AS reject_reason
  FROM fact) r
WHERE reject_reason IS NOT NULL GROUP BY reject_reason"""),
    "flag_opioid": _over("flagged", f"SELECT {KEY}, is_opioid FROM flagged"),
    "flag_benzo": _over("flagged", f"SELECT {KEY}, is_benzodiazepine FROM flagged"),
    "flag_stimulant": _over("flagged", f"SELECT {KEY}, is_stimulant FROM flagged"),
    "flag_high_risk": _over("flagged", f"SELECT {KEY}, is_high_risk FROM flagged"),
    "risk_category": _over("flagged", f"""
SELECT {KEY}, is_opioid, is_benzodiazepine, is_stimulant, is_high_risk, risk_category FROM flagged"""),
    "flag_whole_word": _over("fact", f"""
SELECT {KEY}, is_opioid, is_benzodiazepine, is_stimulant, is_high_risk, risk_category
FROM ({FLAGS.format(source="fact", **WHOLE_WORDS)}) f"""),
    "risk_from_reference": _over("flagged", f"""
SELECT {KEY},
       CASE WHEN listed THEN 1 ELSE is_opioid END AS is_opioid,
       CASE WHEN listed THEN 0 ELSE is_benzodiazepine END AS is_benzodiazepine,
       CASE WHEN listed THEN 0 ELSE is_stimulant END AS is_stimulant,
       CASE WHEN listed THEN 1 ELSE is_high_risk END AS is_high_risk,
       CASE WHEN listed THEN 'OPIOID' ELSE risk_category END AS risk_category
FROM (SELECT *, drug_name IN (SELECT upper(trim(p_name)) FROM part WHERE upper(p_name) LIKE '%PLATE%') AS listed
      FROM flagged) f"""),
    "risk_counts": _over("flagged", """
SELECT total_records, high_risk_count, opioid_count,
       cast(high_risk_count AS double) / nullif(total_records, 0) * 100 AS high_risk_pct,
       cast(opioid_count AS double) / nullif(total_records, 0) * 100 AS opioid_pct
FROM (SELECT count(*) AS total_records, count(*) FILTER (WHERE is_high_risk = 1) AS high_risk_count,
             count(*) FILTER (WHERE is_opioid = 1) AS opioid_count FROM flagged) c"""),
    "enrich_left_join": _over("enriched", f"SELECT {KEY}, total_claims, org_name, npi_state FROM enriched"),
    "registry_dedupe": """
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, cast(o_orderdate AS date) AS o_orderdate,
       o_orderpriority
FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn
      FROM orders) o WHERE rn = 1""",
    "enrich_unmatched": _over("flagged registry", """
SELECT npi, count(*) AS claim_rows FROM flagged
WHERE npi NOT IN (SELECT npi FROM registry) GROUP BY npi"""),
    "temporal_dims": _over("flagged", f"SELECT {KEY}, report_year, report_quarter, report_month FROM flagged"),
    "trend_yearly": _over("yearly", "SELECT * FROM yearly"),
    "trend_quarterly": _over("flagged", _trend("quarterly", "report_year", "report_quarter")),
    "trend_monthly": _over("flagged", _trend("monthly", "report_year", "report_month")),
    "trend_yoy": _over("yearly", """
SELECT *, yearly_claims - prev_claims AS claims_change,
       cast(yearly_claims - prev_claims AS double) / nullif(prev_claims, 0) * 100 AS claims_change_pct
FROM (SELECT provider_state, risk_category, report_year, yearly_claims,
             lag(report_year) OVER w AS prev_year, lag(yearly_claims) OVER w AS prev_claims
      FROM yearly WINDOW w AS (PARTITION BY provider_state, risk_category ORDER BY report_year)) y"""),
    "trend_reference_avg": _over("yearly", """
SELECT report_year, risk_category, yearly_claims,
       avg(yearly_claims) OVER (PARTITION BY risk_category) AS avg_yearly_claims
FROM (SELECT report_year, risk_category, cast(sum(yearly_claims) AS bigint) AS yearly_claims
      FROM yearly GROUP BY report_year, risk_category) y"""),
    "geo_state": _over("state", "SELECT * FROM state"),
    "geo_zip_opioid": _over("zip", "SELECT * FROM zip"),
    "geo_level_region": _over("flagged", _geo("provider_region", "county")),
    "geo_county": _over("flagged", _geo("provider_county", "county").replace(
        "FROM flagged",
        "FROM (SELECT *, concat('COUNTY_', substr(provider_zip, 4, 1)) AS provider_county FROM flagged) f")),
    "geo_rollup": _over("flagged", """
SELECT provider_state, provider_zip, 'zip' AS geo_level, cast(sum(total_claims) AS bigint) AS total_claims,
       cast(sum(cast(total_cost AS decimal(18,2))) AS double) AS total_cost
FROM flagged GROUP BY provider_state, provider_zip
UNION ALL
SELECT provider_state, NULL, 'state', cast(sum(total_claims) AS bigint),
       cast(sum(cast(total_cost AS decimal(18,2))) AS double) FROM flagged GROUP BY provider_state
UNION ALL
SELECT NULL, NULL, 'all', cast(sum(total_claims) AS bigint),
       cast(sum(cast(total_cost AS decimal(18,2))) AS double) FROM flagged"""),
    "geo_county_weighted": _over("flagged", """
SELECT * FROM (WITH pairs AS (
  SELECT provider_zip, provider_county, sum(weight) AS w, sum(sum(weight)) OVER (PARTITION BY provider_zip) AS ws
  FROM (SELECT DISTINCT provider_zip, 'COUNTY_' || substr(provider_zip, 4, 1) AS provider_county, 3 AS weight FROM flagged
        WHERE substr(provider_zip, 5, 1) <> '9'
        UNION ALL
        SELECT DISTINCT provider_zip, 'COUNTY_' || substr(provider_zip, 5, 1), 4 FROM flagged WHERE substr(provider_zip, 5, 1) <> '9')
  GROUP BY provider_zip, provider_county),
zips AS (
  SELECT provider_state, provider_zip, risk_category, sum(total_claims)::HUGEINT AS claims,
         sum(cast(cast(total_cost AS decimal(18,2)) * 100 AS bigint))::HUGEINT AS cents, sum(beneficiary_count)::HUGEINT AS patients
  FROM flagged GROUP BY ALL),
met AS (
  SELECT z.*, provider_county, coalesce(w, 1)::HUGEINT AS w, coalesce(ws, 1)::HUGEINT AS ws
  FROM zips z LEFT JOIN pairs p ON z.provider_zip = p.provider_zip),
parted AS (
  SELECT provider_state, provider_county, risk_category,
    claims * w // ws + (row_number() OVER (c ORDER BY claims * w % ws DESC, provider_county) <= claims - sum(claims * w // ws) OVER c)::INT AS claims,
    cents * w // ws + (row_number() OVER (c ORDER BY cents * w % ws DESC, provider_county) <= cents - sum(cents * w // ws) OVER c)::INT AS cents,
    patients * w // ws + (row_number() OVER (c ORDER BY patients * w % ws DESC, provider_county) <= patients - sum(patients * w // ws) OVER c)::INT AS patients
  FROM met WINDOW c AS (PARTITION BY provider_state, provider_zip, risk_category))
SELECT provider_state, provider_county, risk_category, sum(claims)::BIGINT AS county_total_claims,
       sum(cents)::DOUBLE / 100 AS county_total_cost, sum(patients)::BIGINT AS county_beneficiary_count
FROM parted GROUP BY ALL) weighted"""),
    "geo_time_sets": _over("flagged", """
SELECT provider_state, provider_zip, provider_county, report_year, report_quarter, report_month,
       CASE WHEN grouping(provider_zip) = 0 THEN 'zip' WHEN grouping(provider_county) = 0 THEN 'county' ELSE 'state' END AS geo_level,
       CASE WHEN grouping(report_month) = 0 THEN 'month' WHEN grouping(report_quarter) = 0 THEN 'quarter' ELSE 'year' END AS time_level,
       sum(total_claims)::BIGINT AS total_claims, sum(cast(total_cost AS decimal(18,2)))::DOUBLE AS total_cost,
       count(DISTINCT npi) AS provider_count
FROM (SELECT *, 'COUNTY_' || substr(provider_zip, 4, 1) AS provider_county FROM flagged)
GROUP BY GROUPING SETS (
  (provider_state, provider_zip, report_year, report_month), (provider_state, provider_zip, report_year, report_quarter),
  (provider_state, provider_zip, report_year), (provider_state, provider_county, report_year, report_month),
  (provider_state, provider_county, report_year, report_quarter), (provider_state, provider_county, report_year),
  (provider_state, report_year, report_month), (provider_state, report_year, report_quarter), (provider_state, report_year))"""),
    "provider_sketch_rollup": _over("flagged", """
SELECT provider_state, sum(total_claims)::BIGINT AS total_claims, count(DISTINCT npi) AS exact_providers, 1 AS within_bound
FROM flagged GROUP BY provider_state"""),
    "geo_per_capita": _over("state", """
SELECT s.*, population, cast(state_total_claims AS double) / population * 100000 AS claims_per_100k
FROM state s LEFT JOIN (
  SELECT n_name, count(*) * 1000 AS population FROM customer JOIN nation ON c_nationkey = n_nationkey
  GROUP BY n_name) c ON provider_state = n_name"""),
    "hotspot_state": _over("state", _hotspot()),
    "hotspot_state_literal": _over("state", _hotspot("DESC")),
    "hotspot_threshold_75": _over("state", _hotspot(percentile=0.75)),
    "hotspot_zip": _over("zip", """
SELECT *, CASE WHEN zip_opioid_rank >= 0.95 THEN 1 ELSE 0 END AS is_hotspot
FROM (SELECT *, percent_rank() OVER (ORDER BY zip_opioid_claims) AS zip_opioid_rank,
             cast(zip_opioid_claims AS double) / nullif(zip_opioid_beneficiaries, 0) AS claims_per_beneficiary
      FROM zip) z"""),
    "hotspot_count": _over("hotspot", """
SELECT risk_category, count(*) AS hotspot_count FROM hotspot WHERE is_hotspot = 1 GROUP BY risk_category"""),
    "top_states_opioid": _over("state", """
SELECT * FROM state WHERE risk_category = 'OPIOID' ORDER BY state_total_claims DESC, provider_state LIMIT 10"""),
    "mart_provider": _over("provider", "SELECT * FROM provider"),
    "mart_provider_zero_fill": _over("provider", """
SELECT * REPLACE (coalesce(provider_opioid_claims, 0) AS provider_opioid_claims,
                  coalesce(provider_highrisk_claims, 0) AS provider_highrisk_claims,
                  coalesce(opioid_percentage, 0) AS opioid_percentage)
FROM provider"""),
    "mart_drug": _over("drug", "SELECT * FROM drug"),
    "mart_specialty": _over("specialty_mart", "SELECT * FROM specialty_mart"),
    "mart_main_dashboard": _over("provider", f"""
SELECT {PROVIDER_KEYS}, provider_total_claims, provider_total_cost, provider_opioid_claims,
       provider_highrisk_claims, opioid_percentage, unique_drugs_prescribed, total_beneficiaries
FROM provider"""),
    "q_state_opioid": _over("provider", """
SELECT provider_state, cast(sum(provider_opioid_claims) AS bigint) AS opioid_claims
FROM provider GROUP BY provider_state ORDER BY 2 DESC"""),
    "q_highrisk_providers": _over("provider", """
SELECT npi, provider_name, specialty, opioid_percentage FROM provider WHERE opioid_percentage > 25"""),
    "q_hotspots_only": _over("hotspot", "SELECT * FROM hotspot WHERE is_hotspot = 1"),
    "q_state_having": _over("provider", f"""
SELECT provider_state, count(DISTINCT npi) AS provider_count,
       cast(sum(provider_opioid_claims) AS bigint) AS total_opioid_claims,
       {significant('avg(opioid_percentage)')} AS avg_opioid_pct
FROM provider WHERE provider_total_claims > 100 GROUP BY provider_state
HAVING avg(opioid_percentage) > 15 ORDER BY total_opioid_claims DESC"""),
    "q_calc_fields": _over("provider", """
SELECT *, provider_total_cost / nullif(provider_total_claims, 0) AS cost_per_claim,
       cast(provider_opioid_claims AS double) / nullif(provider_total_claims, 0) AS opioid_claim_ratio,
       cast(provider_total_claims AS double) / nullif(total_beneficiaries, 0) AS claims_per_beneficiary,
       CASE WHEN opioid_percentage > 25 THEN 'High Risk' WHEN opioid_percentage > 10 THEN 'Moderate Risk'
            ELSE 'Low Risk' END AS risk_tier
FROM provider"""),
    "q_risk_tier": _over("provider", """
SELECT CASE WHEN opioid_percentage > 25 THEN 'High Risk' WHEN opioid_percentage > 10 THEN 'Moderate Risk'
            ELSE 'Low Risk' END AS risk_tier,
       count(*) AS provider_count, cast(sum(provider_total_claims) AS bigint) AS total_claims
FROM provider GROUP BY 1"""),
    "q_top10_states": _over("provider", """
SELECT provider_state, cast(sum(provider_opioid_claims) AS bigint) AS opioid_claims
FROM provider GROUP BY provider_state ORDER BY opioid_claims DESC NULLS LAST, provider_state LIMIT 10"""),
    "q_top100_providers": _over("provider", f"SELECT * FROM provider ORDER BY {TOP_PROVIDER_ORDER} LIMIT 100"),
    "q_top25_drugs": _over("drug", """
SELECT * FROM drug ORDER BY drug_total_claims DESC, drug_name, generic_name, risk_category LIMIT 25"""),
    "q_lod_state_avg": _over("provider", f"""
SELECT npi, provider_state, opioid_percentage,
       {significant('avg(opioid_percentage) OVER (PARTITION BY provider_state)')} AS state_avg_opioid_pct
FROM provider"""),
    "q_rank_in_state": _over("provider", """
SELECT npi, provider_state, provider_opioid_claims,
       rank() OVER (PARTITION BY provider_state ORDER BY provider_opioid_claims DESC NULLS LAST) AS state_rank
FROM provider"""),
    "q_trend_line": _over("provider", f"""
SELECT {significant('regr_slope(opioid_percentage, provider_total_claims)')} AS slope,
       {significant('regr_intercept(opioid_percentage, provider_total_claims)')} AS intercept,
       {significant('regr_r2(opioid_percentage, provider_total_claims)')} AS r2,
       cast(regr_count(opioid_percentage, provider_total_claims) AS bigint) AS provider_count
FROM provider"""),
    "q_drug_quadrants": _over("drug", """
SELECT d.*, concat(CASE WHEN drug_total_claims >= m.claims THEN 'High volume' ELSE 'Low volume' END, ', ',
                   CASE WHEN avg_cost_per_claim >= m.cost THEN 'high cost' ELSE 'low cost' END) AS quadrant
FROM drug d CROSS JOIN (SELECT avg(drug_total_claims) AS claims, avg(avg_cost_per_claim) AS cost FROM drug) m"""),
    "q_specialty_share": _over("specialty_mart", """
SELECT *, cast(specialty_claims AS double) / specialty_total_claims * 100 AS claim_share_pct
FROM (SELECT *, cast(sum(specialty_claims) OVER (PARTITION BY specialty) AS bigint) AS specialty_total_claims
      FROM specialty_mart) s"""),
    "q_topn_by_specialty": _over("provider", """
SELECT * FROM (
  SELECT *, cast(row_number() OVER (PARTITION BY specialty ORDER BY provider_total_claims DESC, npi, provider_name,
         provider_city, provider_state, provider_zip) AS integer) AS specialty_rank
  FROM provider) r WHERE specialty_rank <= 5"""),
    "q_state_tooltip": _over("provider", f"""
SELECT provider_state, cast(sum(provider_opioid_claims) AS bigint) AS total_opioid_claims,
       count(DISTINCT npi) AS provider_count,
       count(DISTINCT CASE WHEN provider_opioid_claims > 0 THEN npi END) AS opioid_provider_count,
       {significant('avg(opioid_percentage)')} AS avg_opioid_pct
FROM provider GROUP BY provider_state"""),
    "q_dashboard_filter": _over("kept", f"""
, flagged AS (SELECT * FROM ({FLAGGED}) a WHERE provider_state IN ('NATION_1', 'NATION_7')
              AND report_year IN (1996, 1997, 1998) AND risk_category IN ('OPIOID', 'STANDARD')),
provider AS ({PROVIDER})
SELECT * FROM provider WHERE opioid_percentage BETWEEN 20 AND 80"""),
    "q_zip_drilldown": _over("zip", "SELECT * FROM zip WHERE provider_state = 'NATION_5'"),
    "profile_nulls": _over("enriched", f"""
SELECT column_name, null_count, null_pct FROM ({PROFILE}) p WHERE null_count > 0"""),
    "profile_columns": _over("enriched", PROFILE),
    "quality_score": _over("enriched", """
SELECT count(*) AS total_records,
       count(*) FILTER (WHERE npi IS NOT NULL AND drug_name IS NOT NULL AND org_name IS NOT NULL) AS complete_records,
       coalesce(cast(count(*) FILTER (WHERE npi IS NOT NULL AND drug_name IS NOT NULL AND org_name IS NOT NULL)
                     AS double) / nullif(count(*), 0) * 100, 0) AS quality_score
FROM enriched"""),
    "duplicates": _over("flagged", """
SELECT npi, drug_name, count(*) AS row_count FROM flagged GROUP BY npi, drug_name HAVING count(*) > 1"""),
    "outliers_zscore": _over("fact", f"""
SELECT {KEY}, cost_per_claim, round(z, 7) AS cost_per_claim_zscore,
       CASE WHEN z > 3 THEN 1 ELSE 0 END AS cost_per_claim_is_outlier
FROM (SELECT r.*, abs((cost_per_claim - m) / nullif(sd, 0)) AS z
      FROM (SELECT *, total_cost / total_claims AS cost_per_claim FROM fact
            WHERE total_claims >= 11 AND beneficiary_count >= 1) r
      CROSS JOIN (SELECT avg(total_cost / total_claims) AS m, stddev_samp(total_cost / total_claims) AS sd FROM fact
                  WHERE total_claims >= 11 AND beneficiary_count >= 1) s) x"""),
    "pipeline_stats": _over("hotspot", """
SELECT *, cast(records_extracted - records_cleaned AS double) / nullif(records_extracted, 0) * 100 AS data_loss_pct,
       cast(high_risk_count AS double) / nullif(records_cleaned, 0) * 100 AS high_risk_pct,
       cast(opioid_count AS double) / nullif(records_cleaned, 0) * 100 AS opioid_pct
FROM (SELECT (SELECT count(*) FROM fact) AS records_extracted, (SELECT count(*) FROM kept) AS records_cleaned,
             (SELECT count(*) FROM flagged WHERE is_high_risk = 1) AS high_risk_count,
             (SELECT count(*) FROM flagged WHERE is_opioid = 1) AS opioid_count,
             (SELECT count(*) FROM hotspot WHERE is_hotspot = 1) AS hotspot_count) n"""),
    "pipeline_stats_reference": _over("flagged", f"""
, listed AS ({REFERENCE} WHERE length(drug_name) % 4 IN (0, 1)),
decided AS (SELECT provider_state, total_claims,
                   CASE WHEN drug_name IN (SELECT drug_name FROM listed) THEN 'OPIOID' ELSE risk_category END AS category
            FROM flagged),
ranked AS (SELECT percent_rank() OVER (PARTITION BY category ORDER BY claims) AS place
           FROM (SELECT provider_state, category, sum(total_claims) AS claims FROM decided GROUP BY 1, 2) g)
SELECT *, cast(records_extracted - records_cleaned AS double) / nullif(records_extracted, 0) * 100 AS data_loss_pct,
       cast(high_risk_count AS double) / nullif(records_cleaned, 0) * 100 AS high_risk_pct,
       cast(opioid_count AS double) / nullif(records_cleaned, 0) * 100 AS opioid_pct
FROM (SELECT (SELECT count(*) FROM fact) AS records_extracted, (SELECT count(*) FROM kept) AS records_cleaned,
             (SELECT count(*) FROM decided WHERE category <> 'STANDARD') AS high_risk_count,
             (SELECT count(*) FROM decided WHERE category = 'OPIOID') AS opioid_count,
             (SELECT count(*) FROM ranked WHERE place >= 0.95) AS hotspot_count) n"""),
    "reference_unknown": f"""
SELECT CASE WHEN length(drug_name) % 4 = 2 THEN 'OPIOID OTHER' END AS risk_category, count(*) AS row_count,
       count(DISTINCT drug_name) AS drug_count
FROM ({REFERENCE}) r WHERE length(drug_name) % 4 IN (2, 3) GROUP BY 1""",
    "q_topn_large": _over("provider", """
SELECT * FROM (
  SELECT *, cast(row_number() OVER (PARTITION BY specialty ORDER BY provider_total_claims DESC, npi, provider_name,
         provider_city, provider_state, provider_zip) AS integer) AS specialty_rank
  FROM provider) r WHERE specialty_rank <= 2000"""),
    "reconcile_geo": _over("fact", """
, own AS (SELECT provider_state, sum(total_claims) AS claims, count(DISTINCT npi) AS providers FROM fact
          WHERE provider_state <> 'NATION_4' GROUP BY provider_state),
ordered AS (SELECT n_name AS provider_state, count(*) * 100 AS claims, count(DISTINCT o_custkey) AS providers
            FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
            WHERE n_name <> 'NATION_9' GROUP BY n_name),
both_sides AS (
  SELECT provider_state, m.measure, CASE m.measure WHEN 'claims' THEN o.claims ELSE o.providers END AS own_value,
         CASE m.measure WHEN 'claims' THEN s.claims ELSE s.providers END AS supplied_value,
         o.claims IS NOT NULL AS mine, s.claims IS NOT NULL AS theirs
  FROM own o FULL JOIN ordered s USING (provider_state), (VALUES ('claims'), ('providers')) m(measure))
SELECT provider_state, measure, cast(own_value AS double) AS own_value, cast(supplied_value AS double) AS supplied_value,
       cast(own_value - supplied_value AS double) AS difference,
       CASE WHEN NOT theirs THEN 'ONLY_OWN' WHEN NOT mine THEN 'ONLY_SUPPLIED'
            WHEN abs(own_value - supplied_value) <= 1000 THEN 'EQUAL' ELSE 'DIFFERENT' END AS status
FROM both_sides"""),
}
