import os
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()
SMALL_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[4]")
        .appName("claimlens-tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.maxMetadataStringLength", "2000")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def small_dir():
    if not os.path.isdir(SMALL_DIR):
        pytest.skip("test tables are not here")
    return SMALL_DIR


@pytest.fixture
def claims(spark):
    """Five valid claims of four providers in three states: one opioid, one benzodiazepine, three others."""
    return make_claims(spark, [
        {"npi": "7100000001", "provider_state": "OR", "provider_zip": "97035", "drug_name": "TAPENTADOL ER",
         "generic_name": "TAPENTADOL", "total_claims": 64, "total_fills": 32.0, "total_day_supply": 800,
         "total_cost": 1600, "beneficiary_count": 9},
        {"npi": "7100000001", "provider_state": "OR", "provider_zip": "97035", "drug_name": "METFORMIN",
         "generic_name": "METFORMIN", "total_claims": 410, "total_fills": 500.5, "total_day_supply": 15015,
         "total_cost": "2050.40", "beneficiary_count": 120},
        {"npi": "7100000002", "provider_state": "OR", "provider_zip": "97401", "drug_name": "CLONAZEPAM ODT",
         "generic_name": "CLONAZEPAM", "total_claims": 37, "total_fills": 40.0, "total_day_supply": 1200,
         "total_cost": "612.35", "beneficiary_count": 11},
        {"npi": "7100000003", "provider_state": "VT", "provider_zip": "05401", "drug_name": "SERTRALINE",
         "generic_name": "SERTRALINE", "total_claims": 88, "total_fills": 91.0, "total_day_supply": 2730,
         "total_cost": 704, "beneficiary_count": 30},
        {"npi": "7100000004", "provider_state": "KS", "provider_zip": "66044", "drug_name": "AMOXICILLIN",
         "generic_name": "AMOXICILLIN", "total_claims": 23, "total_fills": 23.0, "total_day_supply": 230,
         "total_cost": "57.50", "beneficiary_count": 22},
    ])


def make_claims(spark, rows):
    """Claim rows from dicts; columns not named get a harmless value."""
    from decimal import Decimal

    from claimlens.schemas import CLAIMS

    base = {
        "npi": "1", "provider_name": "NAME", "provider_city": "CITY", "provider_state": "NY",
        "provider_zip": "10001", "specialty": "Cardiology", "drug_name": "LISINOPRIL",
        "generic_name": "LISINOPRIL", "total_claims": 20, "total_fills": 20.0, "total_day_supply": 600,
        "total_cost": 100, "beneficiary_count": 5,
    }

    def money(value):
        return None if value is None else Decimal(str(value))

    filled = [{**base, **r} for r in rows]
    ordered = [tuple(money(r[n]) if n == "total_cost" else r[n] for n in CLAIMS.names) for r in filled]
    return spark.createDataFrame(ordered, CLAIMS)
