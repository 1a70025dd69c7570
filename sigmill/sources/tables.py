"""Sample streams in table form: one row a complex sample (file_id, chunk_id, n, i, q), and small capture-like views.

The views over the driver's tables stand for recorded captures in tests and registered queries.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

CHUNK_FRAMES = 4096
FS = 1000.0

#: Each view in Spark SQL over {t}, its base table.
VIEWS: dict[str, tuple[str, str]] = {
    "s": ("events", f"SELECT 'events' AS file_id, event_id div {CHUNK_FRAMES} AS chunk_id, event_id AS n, value / 1000.0D AS i, CAST(get_json_object(props, '$.k') AS DOUBLE) / 100.0D AS q FROM {{t}}"),
    "clips": ("embeddings", "SELECT vec_id AS clip_index, CAST(label AS BIGINT) AS carrier_index, k AS n, CAST(embedding[CAST(2 * k AS INT)] AS DOUBLE) AS i, CAST(embedding[CAST(2 * k + 1 AS INT)] AS DOUBLE) AS q FROM (SELECT vec_id, label, embedding, explode(sequence(0L, CAST(size(embedding) div 2 - 1 AS BIGINT))) AS k FROM {t})"),
    "detections": ("events", "SELECT event_id AS clip_index, user_id % 20 AS carrier_index, CASE WHEN event_id % (2 + user_id % 20) = 0 THEN event_type ELSE 'qam' END AS pred_name, round(least(1.0D, 0.5D + value / 100.0D), 4) AS confidence, user_id * 1000.0D AS f_center_hz_rel, value AS bw_hz_est FROM {t}"),
    "segments": ("events", "SELECT user_id % 10 AS file_id, event_id AS segment_id, event_id * 0.05D AS start_s, event_id * 0.05D + value / 100.0D AS end_s, CASE WHEN value < 5 THEN 'UNKNOWN' ELSE event_type END AS pred_label, round(least(1.0D, value / 100.0D), 4) AS prob, user_id * 10.0D AS offset_hz, value AS bw_hz, value / 10.0D AS snr_db FROM {t}"),
    "features": ("events", "SELECT event_id div 2 AS clip_index, value / 10.0D AS snr_db, event_id AS row_no FROM {t} WHERE event_id % 3 <> 0"),
    "progress": ("orders", "SELECT o_orderkey AS file_id, CASE WHEN o_orderkey % 50 < 25 AND o_custkey % 8 > 0 THEN 'completed' ELSE CASE o_orderstatus WHEN 'F' THEN 'completed' WHEN 'O' THEN 'failed' ELSE 'pending' END END AS status, o_totalprice / 1000.0D AS seconds FROM {t}"),
}

#: The same for DuckDB.
DUCK: dict[str, str] = {
    "bins": "SELECT range AS k FROM range(512)",
    "s": f"SELECT 'events' AS file_id, event_id // {CHUNK_FRAMES} AS chunk_id, event_id AS n, value / 1000.0::DOUBLE AS i, CAST(json_extract_string(props, '$.k') AS DOUBLE) / 100.0::DOUBLE AS q FROM events",
    "clips": "SELECT vec_id AS clip_index, CAST(label AS BIGINT) AS carrier_index, CAST(k AS BIGINT) AS n, CAST(embedding[2 * k + 1] AS DOUBLE) AS i, CAST(embedding[2 * k + 2] AS DOUBLE) AS q FROM (SELECT *, unnest(range(32)) AS k FROM embeddings)",
    "detections": "SELECT event_id AS clip_index, user_id % 20 AS carrier_index, CASE WHEN event_id % (2 + user_id % 20) = 0 THEN event_type ELSE 'qam' END AS pred_name, round(least(1.0::DOUBLE, 0.5::DOUBLE + value / 100.0::DOUBLE), 4) AS confidence, user_id * 1000.0::DOUBLE AS f_center_hz_rel, value AS bw_hz_est FROM events",
    "segments": "SELECT user_id % 10 AS file_id, event_id AS segment_id, event_id * 0.05::DOUBLE AS start_s, event_id * 0.05::DOUBLE + value / 100.0::DOUBLE AS end_s, CASE WHEN value < 5 THEN 'UNKNOWN' ELSE event_type END AS pred_label, round(least(1.0::DOUBLE, value / 100.0::DOUBLE), 4) AS prob, user_id * 10.0::DOUBLE AS offset_hz, value AS bw_hz, value / 10.0::DOUBLE AS snr_db FROM events",
    "features": "SELECT event_id // 2 AS clip_index, value / 10.0::DOUBLE AS snr_db, event_id AS row_no FROM events WHERE event_id % 3 <> 0",
    "progress": "SELECT o_orderkey AS file_id, CASE WHEN o_orderkey % 50 < 25 AND o_custkey % 8 > 0 THEN 'completed' ELSE CASE o_orderstatus WHEN 'F' THEN 'completed' WHEN 'O' THEN 'failed' ELSE 'pending' END END AS status, o_totalprice / 1000.0::DOUBLE AS seconds FROM orders",
}


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    base, sql = VIEWS[name]
    return spark.sql(sql, t=spark.read.parquet(f"{sf_dir}/{base}.parquet"))


def blocks(spark: SparkSession, sf_dir: str, frames: int = CHUNK_FRAMES) -> DataFrame:
    """The sample view as blocks in double precision. Each is a group of `frames` rows."""
    s = view(spark, sf_dir, "s").withColumn("block_id", F.floor(F.col("n") / frames))
    rows = s.groupBy("file_id", "block_id").agg(F.min("chunk_id").alias("chunk_id"), F.min("n").alias("start_sample"), F.count("*").cast("int").alias("n"), F.sort_array(F.collect_list(F.struct("n", "i", "q"))).alias("x"))
    return rows.select("file_id", "chunk_id", F.col("block_id").alias("block_id", metadata={"frames": frames}), "start_sample", "n", F.lit(FS).alias("fs_hz"), F.col("x.i").alias("i"), F.col("x.q").alias("q"))


def recordings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(file_id, frames, fs_hz): customers as recordings of 1 to 400 s at 1000 Hz."""
    return spark.read.parquet(f"{sf_dir}/customer.parquet").select(F.col("c_custkey").cast("string").alias("file_id"), F.floor(F.abs("c_acctbal") * 40 + 1000).cast("long").alias("frames"), F.lit(FS).alias("fs_hz"))
