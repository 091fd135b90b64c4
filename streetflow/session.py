"""Session construction and the shared work folder.

Jobs that must write intermediate results (stream sinks, keyed tables, lake
snapshots, lineage cuts) write under the cluster's shared checkpoint folder,
read from the session (``spark.checkpoint.dir``).  Without that setting a cluster
session raises; only a single-process ``local[n]`` session, as in tests, gets a
private folder, since there all tasks share the machine.
"""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

UTC = "UTC"


def build_session(
    app: str = "streetflow",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """A session configured the way the library expects.

    AQE stays on (runtime coalescing, skew-join splitting, and broadcast
    conversion once a shuffle stage has *measured* a small side), ANSI mode
    stays on, and the session zone is pinned to UTC so day keys do not depend
    on the machine.
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = {
        "spark.sql.session.timeZone": UTC,
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
    }
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ensure_utc(spark: SparkSession) -> None:
    """Day keys and watermark casts are defined in UTC."""
    if spark.conf.get("spark.sql.session.timeZone", None) != UTC:
        spark.conf.set("spark.sql.session.timeZone", UTC)


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``, also registered as the
    context's checkpoint folder.  Unset, it is an error unless driver and tasks are
    one process (``local[n]``)."""
    sc = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not root:
        if not re.fullmatch(r"local(\[[^\]]*\])?", sc.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        root = tempfile.mkdtemp(prefix="streetflow-ckpt-")
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(root)
    return root.rstrip("/")


def work_dir(spark: SparkSession, name: str) -> str:
    """A fresh, never-reused folder for one run of one job."""
    return f"{checkpoint_root(spark)}/streetflow/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once under the shared folder and read back: a lineage cut that
    survives lost executors, with attributes of its own."""
    path = work_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
