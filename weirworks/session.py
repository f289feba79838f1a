"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def build_session(app: str = "weirworks", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the operators rely on (UTC, AQE, RocksDB state)."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.streaming.stateStore.providerClass": ROCKSDB,
        "spark.ui.enabled": "false",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def pin_utc(spark: SparkSession) -> None:
    """Wall-clock columns (TIMESTAMP_NTZ) convert to instants and back unchanged only in UTC."""
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A new folder below the shared folder named by ``spark.checkpoint.dir``.

    Executors on other machines must see it, so a machine-local folder is used
    only with a local master (tests); on a cluster a missing setting is an error.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        root = tempfile.mkdtemp(prefix="weirworks-")
        spark.conf.set("spark.checkpoint.dir", root)
    return f"{root.rstrip('/')}/weirworks/{label}-{uuid.uuid4().hex}"


def stored(df, label: str):
    """Write ``df`` to the scratch folder and read it back: reliable lineage cut."""
    spark = df.sparkSession
    path = scratch_dir(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
