"""Reading the supplied parquet tables.

Every read names the columns it needs, so the scan's ``ReadSchema`` carries
only those columns and later filters are pushed into the parquet reader.
The supplied tables are read with their declared schemas (no footer-based
inference). Every read lists the table's files anew, so files added later in a
session are seen.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

SUPPLIED_TABLES = (
    "region",
    "nation",
    "customer",
    "supplier",
    "part",
    "orders",
    "lineitem",
    "events",
    "documents",
    "embeddings",
    "pages",
    "benchmark",
    "labels",
    "conversations",
)

# Declared schemas of the tables the library reads.
SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": (
        "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
        "o_orderdate timestamp_ntz, o_orderpriority string"
    ),
    "lineitem": (
        "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
        "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, "
        "l_linestatus string, l_shipdate timestamp_ntz"
    ),
    "events": (
        "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"
    ),
}


def table_path(sf_dir: str, name: str) -> str:
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


def read_table(
    spark: SparkSession, sf_dir: str, name: str, columns: Sequence[str] | None = None
) -> DataFrame:
    reader = spark.read
    if name in SCHEMAS:
        reader = reader.schema(SCHEMAS[name])
    df = reader.parquet(table_path(sf_dir, name))
    return df.select(*columns) if columns else df


def register_views(spark: SparkSession, sf_dir: str, names: Sequence[str] = SUPPLIED_TABLES) -> None:
    """Expose the supplied tables as temp views for ``spark.sql``."""
    for name in names:
        read_table(spark, sf_dir, name).createOrReplaceTempView(name)
