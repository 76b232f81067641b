"""Session helpers."""

from __future__ import annotations

import atexit
import re
import shutil
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession


def local_session(cpus: int | str = "*", **conf: str) -> SparkSession:
    """A local session for tests and the benchmark."""
    b = SparkSession.builder.master(f"local[{cpus}]").config("spark.sql.session.timeZone", "UTC").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", conf.pop("shuffle", "8")).config("spark.driver.memory", conf.pop("memory", "8g"))
    for k, v in conf.items():
        b = b.config(k, v)
    return b.getOrCreate()


def checkpoint(df: DataFrame) -> DataFrame:
    """`df` written to the shared folder that spark.checkpoint.dir names, its lineage cut.

    Where neither the session nor the context names a folder, a local session, as in tests, gets one of its own, which goes with the process; on a cluster that is an error, as other hosts could not read it.
    """
    sc = df.sparkSession.sparkContext
    if not sc._jsc.sc().getCheckpointDir().isDefined():
        folder = sc.getConf().get("spark.checkpoint.dir")
        if not folder:
            if not re.match(r"local(\[|$)", sc.master):
                raise RuntimeError("spark.checkpoint.dir must name a folder that all hosts share")
            folder = tempfile.mkdtemp(prefix="quirework-checkpoints-")
            atexit.register(shutil.rmtree, folder, ignore_errors=True)
        sc.setCheckpointDir(folder)
    return df.checkpoint()


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Give the executors' Python workers this package, once per application; nothing to do where it was submitted with --py-files, but harmless."""
    sc = spark.sparkContext
    if sc.applicationId in _shipped:
        return
    root = Path(__file__).resolve().parent
    target = Path(tempfile.mkdtemp(prefix="quirework-")) / "quirework_package.zip"  # the driver serves it until it ends
    with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as z:
        for p in sorted(root.rglob("*.py")):
            z.write(p, p.relative_to(root.parent))
    sc.addPyFile(str(target))
    atexit.register(shutil.rmtree, target.parent, ignore_errors=True)
    _shipped.add(sc.applicationId)
