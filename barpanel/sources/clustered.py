"""Panels clustered by ticker and sorted by date.

Rows are bucketed by ticker and sorted by (ticker, date) inside a bucket, as a
Spark table. A later job's windows by ticker read it without an exchange, and a
date range opens only the row groups whose dates meet it. The folder describes
itself (``_info/clustered.json``), so another session registers the same table.
"""

from __future__ import annotations

import hashlib
import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

_INFO = "_info/clustered.json"


def _name(path: str) -> str:
    return "clustered_" + hashlib.md5(path.rstrip("/").encode()).hexdigest()


def write_clustered(df: DataFrame, path: str, buckets: int, key: str = "ticker",
                    order: str = "date", row_group_bytes: int | None = None) -> DataFrame:
    """Writes ``df`` to ``path`` in ``buckets`` buckets of one file each; the table."""
    spark, path = df.sparkSession, path.rstrip("/")
    w = df.repartition(buckets, key).sortWithinPartitions(key, order).write
    if row_group_bytes:
        w = w.option("parquet.block.size", row_group_bytes)
    spark.sql(f"DROP TABLE IF EXISTS {_name(path)}")
    (w.mode("overwrite").format("parquet").option("path", path)
     .bucketBy(buckets, key).sortBy(key, order).saveAsTable(_name(path)))
    P = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    info = P(f"{path}/{_INFO}")
    out = info.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(info, True)
    try:
        out.write(bytearray(json.dumps({"buckets": buckets, "key": key, "order": order,
                                        "schema": df.schema.jsonValue()}).encode()))
    finally:
        out.close()
    return spark.table(_name(path))


def read_clustered(spark: SparkSession, path: str) -> DataFrame:
    """The clustered table at ``path``, also in a session that did not write it."""
    path = path.rstrip("/")
    info = json.loads("".join(r[0] for r in spark.read.text(f"{path}/{_INFO}").collect()))
    cols = ", ".join(f"`{f.name}` {f.dataType.simpleString()}"
                     for f in StructType.fromJson(info["schema"]).fields)
    spark.sql(f"CREATE TABLE IF NOT EXISTS {_name(path)} ({cols}) USING parquet "
              f"CLUSTERED BY (`{info['key']}`) SORTED BY (`{info['key']}`, `{info['order']}`) "
              f"INTO {info['buckets']} BUCKETS LOCATION '{path}'")
    return spark.table(_name(path))
