"""Readers for the input parquet tables.

Every reader returns a lazy DataFrame; Catalyst prunes the columns and pushes
filters into the parquet scan, so a query that needs two columns of
``lineitem`` reads two columns.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations")


#: Columns of the tables that the case studies read; with them given, opening a
#: table starts no job.
SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey long, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey long, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz, "
              "o_orderpriority string",
    "lineitem": "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, "
                "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
                "l_shipdate timestamp_ntz",
    "events": "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string",
}


def path(sf_dir: str, name: str) -> str:
    if name not in TABLES:
        raise KeyError(name)
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    reader = spark.read.schema(SCHEMAS[name]) if name in SCHEMAS else spark.read
    return reader.parquet(path(sf_dir, name))


def table_stream(spark: SparkSession, sf_dir: str, name: str, max_files_per_trigger: int = 1) -> DataFrame:
    """A table read as a file stream: a folder of part files, or one file (a
    stream takes a single file only by a pattern, so the name is given as one)."""
    reader = spark.readStream.schema(SCHEMAS[name]).option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.parquet(f"{path(sf_dir, name)[:-1]}[t]")
