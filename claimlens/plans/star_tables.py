"""Binds the operators' inputs to a star schema of orders and line items.

One row of ``claims_fact`` is a customer (the provider), a part name and type
(the drug) and a month. The other functions give the dimension inputs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimlens.config import Settings
from claimlens.operators.classify import flag_risk
from claimlens.operators.clean import clean
from claimlens.operators.temporal import add_calendar

# Thresholds and words that exercise every rule on these tables.
STAR_SETTINGS = Settings(
    max_cost_per_claim=5000.0,
    opioid_words=("HOT", "BOLT"),
    benzodiazepine_words=("RED", "GEAR"),
    stimulant_words=("OLD", "RING"),
)


# Declared, so that opening a table needs no job that looks for its schema.
SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
              "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
                "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, "
                "l_linestatus string, l_shipdate timestamp_ntz",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def claims_fact(spark: SparkSession, sf_dir: str, orders_where: str = "true") -> DataFrame:
    """Claims per provider, drug and month, of the orders that meet a condition.

    Line items are reduced to the fact's grain on the customer key before the
    provider's names are joined, so the wide text columns never go through
    the two shuffles of the aggregate.
    """
    return spark.sql(
        """
        SELECT npi, provider_name, provider_city, provider_state, provider_region, provider_zip,
               specialty, drug_name, generic_name, report_date, total_claims, total_fills,
               total_day_supply, total_cost, beneficiary_count
        FROM (
            SELECT o_custkey, drug_name, generic_name, report_date,
                   cast(sum(l_quantity) AS bigint) AS total_claims,
                   count(1) AS total_fills,
                   cast(sum(l_quantity * (p_size % 3)) AS bigint) AS total_day_supply,
                   cast(cast(sum(cast(cast(l_extendedprice AS decimal(18, 2)) * 100 AS bigint))
                             AS decimal(20, 0)) / 100 AS decimal(18, 2)) AS total_cost,
                   count(DISTINCT l_suppkey) AS beneficiary_count
            FROM {lineitem}
            JOIN (SELECT o_orderkey, o_custkey, trunc(cast(o_orderdate AS date), 'month') AS report_date
                  FROM {orders}) ON l_orderkey = o_orderkey
            JOIN (SELECT p_partkey, p_size, upper(trim(p_name)) AS drug_name, upper(trim(p_type)) AS generic_name
                  FROM {part}) ON l_partkey = p_partkey
            GROUP BY o_custkey, drug_name, generic_name, report_date
        )
        JOIN {providers} USING (o_custkey)
        """,
        lineitem=table(spark, sf_dir, "lineitem"),
        orders=table(spark, sf_dir, "orders").filter(orders_where),
        part=table(spark, sf_dir, "part"),
        providers=providers(spark, sf_dir),
    )


def providers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as providers, with the nation as state."""
    return spark.sql(
        """
        SELECT c_custkey AS o_custkey, cast(c_custkey AS string) AS npi, c_name AS provider_name,
               concat('CITY_', c_custkey % 50) AS provider_city,
               n_name AS provider_state, r_name AS provider_region,
               lpad(cast(c_custkey % 97 AS string), 5, '0') AS provider_zip, c_mktsegment AS specialty
        FROM {customer}
        JOIN (SELECT n_nationkey, n_name, r_name FROM {nation} JOIN {region} ON n_regionkey = r_regionkey)
          ON c_nationkey = n_nationkey
        """,
        customer=table(spark, sf_dir, "customer"),
        nation=table(spark, sf_dir, "nation"),
        region=table(spark, sf_dir, "region"),
    )


def flagged_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fact, cleaned, classified and dated."""
    return (
        claims_fact(spark, sf_dir)
        .transform(clean, STAR_SETTINGS)
        .transform(flag_risk, STAR_SETTINGS)
        .transform(add_calendar, "report_date")
    )


def registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers as the provider registry."""
    return (
        table(spark, sf_dir, "supplier")
        .join(table(spark, sf_dir, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
        .select(
            F.col("s_suppkey").cast("string").alias("npi"),
            F.col("s_name").alias("org_name"),
            F.col("n_name").alias("npi_state"),
        )
    )


def census(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A thousand inhabitants per customer of a nation."""
    return (
        table(spark, sf_dir, "customer")
        .join(table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        .groupBy(F.lit("state").alias("geo_level"), F.col("n_name").alias("geo_key"))
        .agg((F.count(F.lit(1)) * 1000).alias("population"))
    )


def drug_reference(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Part names with PLATE, listed as opioids."""
    return (
        table(spark, sf_dir, "part")
        .select(F.upper(F.trim("p_name")).alias("drug_name"))
        .filter(F.contains("drug_name", F.lit("PLATE")))
        .distinct()
        .withColumn("risk_category", F.lit("OPIOID"))
    )
