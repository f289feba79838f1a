from __future__ import annotations

import os
import sys
import time
from pathlib import Path

import pytest
from pyspark.sql import Window, functions as F

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from weirworks.session import build_session  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "weirworks-tests", "local[8]",
        **{"spark.sql.shuffle.partitions": "4", "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "8g"})
    session.sparkContext.setLogLevel("ERROR")
    return session


@pytest.fixture(scope="session")
def sf():
    return SF


@pytest.fixture(scope="session")
def event_files(spark, tmp_path_factory):
    """The event table in five files in time order, each one micro-batch of a stream."""
    from weirworks.tables import load

    folder = tmp_path_factory.mktemp("stream") / "events"
    parted = load(spark, SF, "events").withColumn("part", F.ntile(5).over(Window.orderBy("ts", "event_id"))).cache()
    for i in range(1, 6):
        parted.filter(F.col("part") == i).drop("part").coalesce(1).write.mode("append").parquet(str(folder))
        time.sleep(0.05)
    names = sorted(folder.glob("*.parquet"), key=lambda p: p.stat().st_mtime_ns)
    for i, p in enumerate(names):  # the file source takes files by modification time
        os.utime(p, (1_700_000_000 + i * 10,) * 2)
    return str(folder)
