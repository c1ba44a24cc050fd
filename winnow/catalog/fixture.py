"""Weighing tables derived from the test tables, with fixed defects."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from winnow.plans.weighings import FACT_COLUMNS

ORDER = ("date", "l_partkey", "l_suppkey", "l_extendedprice")

SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_nationkey int",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int",
    "orders": "o_orderkey bigint, o_custkey bigint",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int,"
    " l_quantity double, l_extendedprice double, l_discount double, l_returnflag string,"
    " l_linestatus string, l_shipdate timestamp_ntz",
    "documents": "doc_id bigint, text string",
}

WEIGHING_COLUMNS = (
    "concat(l_orderkey, '-', l_linenumber) AS id_pesee",
    "CAST(CAST(l_shipdate AS DATE) AS STRING) AS date",
    """CASE WHEN l_orderkey % 991 = 0 THEN 'NATION_0'
            WHEN l_partkey % 33 = 0 THEN lower(n_name)
            WHEN l_partkey % 33 = 1 THEN concat(' ', n_name)
            WHEN l_partkey % 33 = 2 THEN replace(n_name, '_', '-')
            WHEN l_partkey % 33 = 3 THEN concat(n_name, ' ')
            ELSE n_name END AS region""",
    """CASE WHEN l_partkey % 501 = 0 THEN 'Supplier#999999999'
            WHEN l_suppkey % 29 = 0 THEN upper(s_name)
            WHEN l_suppkey % 31 = 0 THEN replace(s_name, '#', '  ')
            ELSE s_name END AS cooperative""",
    "concat('PLT', IF(l_orderkey % 997 = 0, o_custkey + 1000000, o_custkey)) AS id_planteur",
    "l_quantity * IF(l_orderkey % 211 = 0, 250D, 25D) AS tonnage_kg",
    """CASE WHEN l_returnflag = 'A' THEN 'Grade A'
            WHEN l_returnflag = 'N' THEN 'Grade B'
            WHEN l_linestatus = 'F' THEN 'Grade C'
            ELSE 'Hors grade' END AS qualite""",
    """IF(l_partkey % 50 = 7, -1L,
          CAST(rint(400 + l_extendedprice / 150) AS BIGINT)) AS prix_fcfa_kg""",
    "IF(l_partkey % 16 <> 9, 5 + l_discount * 50, NULL) AS humidite_pct",
    "l_partkey",
    "l_suppkey",
    "l_extendedprice",
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A test table under a declared schema, so that no job runs to infer one."""
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def weighings(spark: SparkSession, sf_dir: str, copies: bool = True) -> DataFrame:
    """One weighing per line item with the nine fact columns and the order columns.

    With ``copies``, the rows of every 67th order were scanned twice. Orders meet their customers
    first, as two narrow tables, so that the line items move once, to their orders.
    """
    items = table(spark, sf_dir, "lineitem")
    if copies:
        items = items.selectExpr(
            "*", "explode(IF(l_orderkey % 67 = 0, array(1, 2), array(1))) AS copy"
        )
    orders = table(spark, sf_dir, "orders").join(
        table(spark, sf_dir, "customer"), F.expr("o_custkey = c_custkey")
    )
    joined = (
        items.join(orders, F.expr("l_orderkey = o_orderkey"))
        .join(table(spark, sf_dir, "nation"), F.expr("c_nationkey = n_nationkey"))
        .join(table(spark, sf_dir, "supplier"), F.expr("l_suppkey = s_suppkey"))
    )
    return joined.selectExpr(*WEIGHING_COLUMNS)


def fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The nine fact columns only."""
    return weighings(spark, sf_dir).select(*FACT_COLUMNS)


def growers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Grower reference from the customers."""
    nations = table(spark, sf_dir, "nation")
    joined = table(spark, sf_dir, "customer").join(nations, F.expr("c_nationkey = n_nationkey"))
    return joined.selectExpr(
        "concat('PLT', c_custkey) AS id_planteur",
        "n_name AS region",
        "0.5D + (c_custkey % 59) * 0.5D AS superficie_ha",
        "CAST(2005 + c_custkey % 19 AS BIGINT) AS annee_adhesion",
        "c_custkey % 5 = 0 AS certifie_bio",
    )


def cooperatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cooperative reference from the suppliers."""
    nations = table(spark, sf_dir, "nation").join(
        table(spark, sf_dir, "region"), F.expr("n_regionkey = r_regionkey")
    )
    joined = table(spark, sf_dir, "supplier").join(nations, F.expr("s_nationkey = n_nationkey"))
    return joined.selectExpr(
        "s_name AS code_cooperative",
        "n_name AS region",
        "r_name AS zone_production",
        "IF(r_name IN ('AFRICA', 'ASIA'), 'San Pedro', 'Abidjan') AS port_export",
    )
