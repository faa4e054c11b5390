"""Column names and types of the raw files.

Identifiers (npi, ZIP) are strings so that leading zeros survive; cost is a
decimal so that sums do not depend on the order of the rows.
"""

from __future__ import annotations

from pyspark.sql import types as T

MONEY = T.DecimalType(18, 2)

# Raw claim file header -> standard name.
PROVIDER_DRUG_NAMES = {
    "npi": "npi",
    "nppes_provider_last_org_name": "provider_name",
    "nppes_provider_first_name": "provider_first_name",
    "nppes_provider_city": "provider_city",
    "nppes_provider_state": "provider_state",
    "nppes_provider_zip5": "provider_zip",
    "specialty_description": "specialty",
    "drug_name": "drug_name",
    "generic_name": "generic_name",
    "total_claim_count": "total_claims",
    "total_30_day_fill_count": "total_fills",
    "total_day_supply": "total_day_supply",
    "total_drug_cost": "total_cost",
    "bene_count": "beneficiary_count",
}

# Registry file header -> standard name.
REGISTRY_NAMES = {
    "NPI": "npi",
    "Provider Organization Name (Legal Business Name)": "org_name",
    "Healthcare Provider Taxonomy Code_1": "taxonomy_code",
    "Provider Business Practice Location Address State Name": "npi_state",
    "Provider Business Practice Location Address Postal Code": "npi_zip",
}

# Raw columns that are not strings.
CLAIM_NUMBERS = {
    "total_claim_count": T.LongType(),
    "total_30_day_fill_count": T.DoubleType(),
    "total_day_supply": T.LongType(),
    "total_drug_cost": MONEY,
    "bene_count": T.LongType(),
}

# The census file, one row per geography: level is 'state', 'zip' or 'county'.
CENSUS = T.StructType([
    T.StructField("geo_level", T.StringType()),
    T.StructField("geo_key", T.StringType()),
    T.StructField("population", T.LongType()),
])

DRUG_REFERENCE = T.StructType([
    T.StructField("drug_name", T.StringType()),
    T.StructField("risk_category", T.StringType()),
])

# Standard claim rows, as the operators take them.
CLAIMS = T.StructType([
    T.StructField("npi", T.StringType()),
    T.StructField("provider_name", T.StringType()),
    T.StructField("provider_city", T.StringType()),
    T.StructField("provider_state", T.StringType()),
    T.StructField("provider_zip", T.StringType()),
    T.StructField("specialty", T.StringType()),
    T.StructField("drug_name", T.StringType()),
    T.StructField("generic_name", T.StringType()),
    T.StructField("total_claims", T.LongType()),
    T.StructField("total_fills", T.DoubleType()),
    T.StructField("total_day_supply", T.LongType()),
    T.StructField("total_cost", MONEY),
    T.StructField("beneficiary_count", T.LongType()),
])
