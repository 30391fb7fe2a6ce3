"""Session settings the operators rely on.

* UTC session time zone: dates and hour buckets must not shift.
* ANSI mode on (Spark 4 default): divisions go through ``try_divide`` /
  ``nullif`` in the operators, so a zero never raises.
* AQE with skew-join splitting: the only joins against big sides are keyed on
  ``ticker`` (scaler params, per-ticker counts) and AQE splits a hot ticker.
* Checkpoint files go when the frames that wrote them do.
"""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile

from pyspark.sql import SparkSession

_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    "spark.ui.showConsoleProgress": "false",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app: str = "barpanel", extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the settings above.

    ``master`` defaults to ``local[$BENCH_CPUS or 8]`` only when no master is
    configured (on a cluster spark-submit supplies it).
    """
    b = SparkSession.builder.appName(app)
    if master is None and not os.environ.get("SPARK_MASTER"):
        master = f"local[{os.environ.get('BENCH_CPUS', '8')}]"
    if master:
        b = b.master(master)
    conf = dict(_DEFAULTS)
    if shuffle_partitions is not None:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.setdefault("spark.driver.memory", "16g")
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    for k, v in _DEFAULTS.items():
        if k.startswith("spark.sql."):
            spark.conf.set(k, v)
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster the folder must be configured (a shared file system): files in
    a machine's own folder would be lost to the others, so its absence raises.
    Only a local master, as in tests, gets a scratch folder of its own, which is
    removed when the driver ends.
    """
    sc = spark.sparkContext
    d = sc.getCheckpointDir()
    if d:
        return d
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        d = tempfile.mkdtemp(prefix="barpanel-ckpt-", dir="/tmp")
        atexit.register(shutil.rmtree, d, ignore_errors=True)
        spark.conf.set("spark.checkpoint.dir", d)
    sc.setCheckpointDir(d)
    return sc.getCheckpointDir() or d


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))
