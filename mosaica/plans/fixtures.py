"""Tables of the data model derived from the driver's tables. The SQL means the same in Spark and DuckDB."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mosaica.functions import geometry as G

SQL = {
    "pixels": """SELECT CAST(p_partkey AS INT) AS ims_idx, concat('S', CAST(CAST(floor(p_partkey / 500) AS INT) AS STRING)) AS sample_id,
        CAST((p_partkey % 500) % 25 AS INT) AS ims_x, CAST(floor((p_partkey % 500) / 25) AS INT) AS ims_y FROM part WHERE p_size % 10 <> 0""",
    "spectra": """SELECT CAST(l_partkey AS INT) AS ims_idx, round(CAST(1000 + l_quantity + (l_linenumber - 4) * 0.006 AS DOUBLE), 3) AS mz,
        CAST(l_extendedprice AS DOUBLE) AS intensity FROM lineitem""",
    "grid_pixels": """SELECT CAST(p_partkey AS INT) AS ims_idx, CAST(floor((p_partkey % 500) / 25) AS INT) AS row, CAST((p_partkey % 500) % 25 + 25 * floor(p_partkey / 500) AS INT) AS col FROM part""",
    "sheet": """SELECT CAST(s_suppkey AS INT) AS seq, s_name AS sample_name, concat('P', CAST(s_nationkey AS STRING)) AS project_name, CASE WHEN s_suppkey % 6 <> 5 THEN concat('c', CAST(99 - s_suppkey % 60 AS STRING)) END AS core_name,
        concat('T', CAST(s_suppkey % 2 AS STRING)) AS reg_type, CASE WHEN s_suppkey % 3 = 0 THEN '' WHEN s_suppkey % 3 = 1 THEN concat(s_name, '.h5') END AS coords_filename, concat('run', CAST(s_suppkey % 50 AS STRING), '.imzML') AS imzml_filename FROM supplier""",
    "peaklist": """SELECT DISTINCT CAST(1000 + l_quantity AS DOUBLE) AS mz FROM lineitem""",
    "boxes": """SELECT concat('S', CAST(o_orderkey % 4 AS STRING)) AS sample_id, CAST(o_orderkey AS INT) AS cell_idx,
        CAST(o_custkey * 7 % 2500 AS DOUBLE) AS cx, CAST(o_orderkey % 2000 AS DOUBLE) AS cy, CAST(20 + (o_orderkey % 7) * 5 AS DOUBLE) AS half FROM orders""",
    "cell_annotation": """SELECT concat('S', CAST(o_orderkey % 4 AS STRING)) AS sample_id, CAST(o_orderkey AS INT) AS cell_idx, o_orderpriority AS celltype,
        o_orderstatus AS status, CAST(o_totalprice AS DOUBLE) AS value FROM orders""",
    "labels_raster": """SELECT CAST(floor((p_partkey % 500) / 25) AS INT) AS row, CAST((p_partkey % 500) % 25 + 25 * floor(p_partkey / 500) AS INT) AS col,
        CAST(CASE WHEN p_size > 45 THEN 0 ELSE p_size END AS INT) AS label FROM part""",
    "raster": """SELECT 1 AS channel, CAST(floor((p_partkey % 500) / 25) AS INT) AS row, CAST((p_partkey % 500) % 25 + 25 * floor(p_partkey / 500) AS INT) AS col,
        CAST(p_retailprice AS DOUBLE) AS value FROM part UNION ALL SELECT 2 AS channel, CAST(floor((p_partkey % 500) / 25) AS INT) AS row,
        CAST((p_partkey % 500) % 25 + 25 * floor(p_partkey / 500) AS INT) AS col, CAST(p_retailprice * (1 + p_size / 100.0) AS DOUBLE) AS value FROM part""",
    "points_a": """SELECT CAST(c_custkey AS INT) AS id, CAST(c_custkey % 40 + abs(CAST(c_acctbal AS DOUBLE)) % 1 AS DOUBLE) AS x,
        CAST(floor(c_custkey / 40) + abs(CAST(c_acctbal AS DOUBLE)) % 1 AS DOUBLE) AS y FROM customer""",
    "points_b": """SELECT CAST(c_custkey AS INT) AS id, CAST(c_custkey % 40 + abs(CAST(c_acctbal AS DOUBLE)) % 1 + 0.3 AS DOUBLE) AS x,
        CAST(floor(c_custkey / 40) + abs(CAST(c_acctbal AS DOUBLE)) % 1 - 0.2 AS DOUBLE) AS y FROM customer""",
    "matches": """SELECT CAST(user_id % 10 AS INT) AS sample, CAST(event_id AS INT) AS id, CAST(value AS DOUBLE) AS p1x, CAST(event_id % 100 AS DOUBLE) AS p1y,
        CAST(1.01 * value + 2 + CASE WHEN event_type = 'error' THEN 50 ELSE 0 END AS DOUBLE) AS p2x, CAST(event_id % 100 - 1 AS DOUBLE) AS p2y,
        event_type = 'error' AS is_error FROM events""",
    "pvalues": """SELECT CAST(s_suppkey AS INT) AS id, CAST(s_nationkey AS INT) AS grp, CAST((s_suppkey % 97 + 1) / 100.0 AS DOUBLE) AS p FROM supplier""",
    "metrics": """SELECT CAST(l_suppkey AS INT) AS sample, CAST(count(*) AS DOUBLE) AS n_found, CAST(count(*) + l_suppkey % 40 AS DOUBLE) AS n_expected,
        CASE WHEN l_suppkey % 7 = 0 THEN NULL ELSE CAST(avg(l_discount) * 100 AS DOUBLE) END AS landmark_error,
        CASE WHEN l_suppkey % 5 = 0 THEN NULL ELSE CAST(avg(l_tax) * 100 AS DOUBLE) END AS region_error,
        CAST(avg(l_quantity) / 50 AS DOUBLE) AS region_dice, CAST(count(*) % 100 AS DOUBLE) AS landmark_n, CAST(l_suppkey % 6 AS DOUBLE) AS region_n,
        CAST(l_suppkey % 9 AS DOUBLE) AS shift_x, CAST(l_suppkey % 4 AS DOUBLE) AS shift_y FROM lineitem GROUP BY l_suppkey""",
}
_TABLES = "region nation customer supplier part orders lineitem events".split()


def fixture(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    text, used = SQL[name], {}
    for t in _TABLES:
        if re.search(rf"\bFROM {t}\b", text):
            text = re.sub(rf"\bFROM {t}\b", f"FROM {{{t}}}", text)
            used[t] = spark.read.parquet(f"{sf_dir}/{t}.parquet")
    return spark.sql(text, **used)


def cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(sample_id, cell_idx, ring): squares in pixel units."""
    x, y, h = (F.col(c) / 100 for c in ("cx", "cy", "half"))
    return fixture(spark, sf_dir, "boxes").select("sample_id", "cell_idx", G.box_ring(x - h, y - h, x + h, y + h).alias("ring"))


def with_sql(*names: str) -> str:
    """WITH clause that defines fixtures for an oracle."""
    return "WITH " + ",\n".join(f"{n} AS ({SQL[n]})" for n in names)
