"""The dirty view ``A``: ``orders`` dressed up as raw perimeter records.

The SQL runs unchanged in Spark and DuckDB. It is the test data of the registered queries, not part
of the library: six identifier tiers and none, every placeholder, seven date shapes, garbage and
out-of-range dates, missing names and years, unlisted sources, and null, empty, self-crossing,
touching and overlapping boxes. Coordinates are dyadic, so both engines compute them exactly.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from perimetry.config import Settings
from perimetry.schema import GEOM

SETTINGS = Settings(max_year=2027, validity="in_place")

A_SQL = """
SELECT o_orderkey AS record_no,
  CASE o_orderpriority
    WHEN '1-URGENT' THEN 'Interagency Fire Perimeter History'
    WHEN '2-HIGH' THEN 'Historic GeoMAC (2000-2018)'
    WHEN '3-MEDIUM' THEN 'WFIGS Recent (2016-2025)'
    WHEN '4-NOT SPECIFIED' THEN 'WFIGS Year to Date'
    ELSE 'Unlisted source' END AS source_dataset,
  CASE WHEN o_custkey % 7 = 0 THEN concat(' F-', CAST(o_custkey AS STRING), ' ') ELSE ph END AS incident_id_raw,
  CASE WHEN o_custkey % 7 = 1 THEN concat('{{I-', CAST(o_custkey AS STRING), '}}') ELSE ph END AS irwin_id_raw,
  CASE WHEN o_custkey % 7 = 2 THEN concat('L', CAST(o_custkey AS STRING)) ELSE ph END AS local_incident_id,
  CASE WHEN o_custkey % 7 = 3 THEN concat('FOR', CAST(o_custkey AS STRING)) ELSE ph END AS for_id,
  CASE WHEN o_custkey % 7 = 4 THEN concat('GEO', CAST(o_custkey AS STRING)) ELSE ph END AS geo_id,
  CASE WHEN o_custkey % 7 = 5 THEN concat('{{G-', CAST(o_custkey AS STRING), '}}') ELSE ph END AS global_id,
  CASE WHEN o_orderkey % 43 = 0 THEN NULL WHEN o_orderkey % 47 = 0 THEN '' WHEN o_orderkey % 53 = 0 THEN 'None'
    ELSE concat('Fire ', CAST(o_custkey AS STRING)) END AS incident_name,
  CASE WHEN o_orderkey % 11 = 0 THEN NULL WHEN o_orderkey % 37 = 0 THEN '' WHEN o_orderkey % 41 = 0 THEN 'None'
    WHEN o_orderkey % 17 = 0 THEN concat(yy, '.0') WHEN o_orderkey % 89 = 0 THEN 'n/a' ELSE yy END AS fire_year,
  CASE WHEN o_orderkey % 31 = 0 THEN NULL ELSE concat('U', CAST(o_custkey % 13 AS STRING)) END AS unit_id,
  CASE WHEN o_orderkey % 59 = 0 THEN NULL WHEN o_orderkey % 61 = 0 THEN 'garbage' WHEN o_orderkey % 67 = 0 THEN '18991231'
    WHEN o_orderkey % 71 = 0 THEN '9999-12-31'
    WHEN o_orderkey % 7 = 0 THEN concat(yy, mm, dd, hh, '0000')
    WHEN o_orderkey % 7 = 1 THEN concat(yy, mm, dd)
    WHEN o_orderkey % 7 = 2 THEN concat(yy, '-', mm, '-', dd, ' ', hh, ':00:00')
    WHEN o_orderkey % 7 = 3 THEN concat(yy, '-', mm, '-', dd, 'T', hh, ':00:00')
    WHEN o_orderkey % 7 = 4 THEN concat(yy, '-', mm, '-', dd, 'T', hh, ':00:00Z')
    WHEN o_orderkey % 7 = 5 THEN concat(yy, '-', mm, '-', dd, ' ', hh, ':00:00+05:00')
    ELSE concat(mm, '/', dd, '/', yy) END AS perimeter_date_raw,
  CASE WHEN o_orderkey % 23 = 0 THEN 'null' WHEN o_orderkey % 29 = 0 THEN 'empty' WHEN o_orderkey % 19 = 0 THEN 'bowtie' ELSE 'box' END AS geom_kind,
  -120 + CAST(o_custkey % 512 AS DOUBLE) / 1024 + CAST(o_orderkey % 3 AS DOUBLE) / 64 AS cx,
  35 + CAST(o_custkey % 256 AS DOUBLE) / 1024 AS cy,
  CAST(1 + o_orderkey % 5 AS DOUBLE) / 256 AS half
FROM (SELECT *,
  CASE o_orderkey % 5 WHEN 0 THEN NULL WHEN 1 THEN '' WHEN 2 THEN ' None ' WHEN 3 THEN 'NaN' ELSE 'null' END AS ph,
  CAST(year(o_orderdate) AS STRING) AS yy, lpad(CAST(month(o_orderdate) AS STRING), 2, '0') AS mm,
  lpad(CAST(day(o_orderdate) AS STRING), 2, '0') AS dd, lpad(CAST(o_orderkey % 24 AS STRING), 2, '0') AS hh
  FROM {orders}) o
"""


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _corner(x: str, y: str) -> str:
    return f"named_struct('x', cx {x} half, 'y', cy {y} half)"


_A, _B, _C, _D = _corner("-", "-"), _corner("+", "-"), _corner("+", "+"), _corner("-", "+")
# The polygon of one adapter row.
GEOM_SQL = f"""CASE geom_kind
  WHEN 'box' THEN array(array(array({_A}, {_B}, {_C}, {_D}, {_A})))
  WHEN 'bowtie' THEN array(array(array({_A}, {_C}, {_B}, {_D}, {_A})))
  WHEN 'empty' THEN cast(array() AS {GEOM}) END"""


def dealt_out(df: DataFrame) -> DataFrame:
    """Rows over all shuffle partitions: the given tables are files of one row group."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def adapter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``A`` with the raw text columns, the box parameters and ``geom``."""
    raw = spark.sql(A_SQL, orders=dealt_out(table(spark, sf_dir, "orders")))
    return raw.withColumn("geom", F.expr(GEOM_SQL))


def normalized(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``A`` in the normalized schema; the record number is the reading order."""
    return (
        adapter(spark, sf_dir)
        .withColumnRenamed("record_no", "row_id")
        .withColumn("state", F.lit(None).cast("string"))
        .drop("geom_kind", "cx", "cy", "half")
    )


def oracle_a() -> str:
    """``A`` as DuckDB reads it."""
    return A_SQL.format(orders="orders")
