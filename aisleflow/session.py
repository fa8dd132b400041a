"""Session construction and shared-storage locations.

Settings chosen for scale: AQE re-plans joins from runtime sizes (broadcast
when a shuffle stage turns out small, skew splitting when a key is hot) and
coalesces small shuffle partitions.  The checkpoint / scratch location is read
from ``spark.checkpoint.dir`` on the session; only when it is unset (tests,
local runs) do we pick a local folder.
"""

from __future__ import annotations

import os
import re
import shlex
import tempfile
import uuid

from pyspark import SparkConf, SparkContext
from pyspark.sql import SparkSession

# Settings for a session that we start; a value that was submitted wins.
SCALE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def submitted_keys() -> set[str]:
    """Keys that the submitter set: of a running JVM its configuration, else those
    that the JVM will be started with (``PYSPARK_SUBMIT_ARGS``, defaults file)."""
    if SparkContext._gateway is not None or "PYSPARK_GATEWAY_PORT" in os.environ:
        SparkContext._ensure_initialized()
        return {k for k, _ in SparkConf().getAll()}
    args = shlex.split(os.environ.get("PYSPARK_SUBMIT_ARGS", ""))
    keys = {"spark.master" for a in args if a.split("=")[0] == "--master"}
    keys |= {b.split("=", 1)[0] for a, b in zip(args, args[1:]) if a in ("--conf", "-c")}
    keys |= {a.split("=", 2)[1] for a in args if a.startswith("--conf=")}
    files = [b for a, b in zip(args, args[1:]) if a == "--properties-file"]
    conf = os.environ.get("SPARK_CONF_DIR") or os.path.join(os.environ.get("SPARK_HOME", ""), "conf")
    for path in files or [os.path.join(conf, "spark-defaults.conf")]:
        if os.path.isfile(path):
            with open(path) as f:
                keys |= {re.split(r"[\s=]+", x.strip(), maxsplit=1)[0] for x in f if x.strip() and not x.lstrip().startswith("#")}
    return keys


def build_session(master: str | None = None, app: str = "aisleflow",
                  shuffle_partitions: int | None = None,
                  extra: dict | None = None) -> SparkSession:
    """Start a session with the scale settings, or return the running one as it is.

    A key that was submitted (``--conf``, defaults file) is never overridden,
    whether the value here is a default of ours or comes from ``extra``.
    """
    running = SparkSession.getActiveSession()
    if running is not None:
        ensure_checkpoint_dir(running)
        return running
    wanted = {**SCALE_CONF, "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false"}
    if shuffle_partitions:
        wanted["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    wanted.update(extra or {})
    submitted = submitted_keys()
    b = SparkSession.builder.appName(app)
    if master and "spark.master" not in submitted:
        b = b.master(master)
    for k, v in wanted.items():
        if k not in submitted:
            b = b.config(k, v)
    spark = b.getOrCreate()
    ensure_checkpoint_dir(spark)
    return spark


_LOCAL_FALLBACK: str | None = None


def _configured_dir(spark: SparkSession) -> str | None:
    path = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    return path or spark.conf.get("spark.checkpoint.dir", None)


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder of the session.

    ``spark.checkpoint.dir`` names it and is never overridden.  Where it is unset,
    a local run (master ``local[...]``: driver and executors are one process) gets a
    folder of its own; on any other master that would be a folder that executors do
    not share, so this raises before anything is written.
    """
    global _LOCAL_FALLBACK
    sc = spark.sparkContext
    path = _configured_dir(spark)
    if not path:
        if not (sc.master == "local" or sc.master.startswith("local[")):
            raise RuntimeError(f"spark.checkpoint.dir is not set on master {sc.master}; "
                               "name a folder that the driver and all executors share")
        if _LOCAL_FALLBACK is None:  # one folder per process, so repeated calls agree
            _LOCAL_FALLBACK = tempfile.mkdtemp(prefix="aisleflow-ckpt-")
        path = _LOCAL_FALLBACK
    if sc._jsc.sc().getCheckpointDir().isEmpty():
        sc.setCheckpointDir(path)
    return path


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder under the shared checkpoint location."""
    root = ensure_checkpoint_dir(spark)
    return os.path.join(root, "scratch", f"{name}-{uuid.uuid4().hex[:12]}")
