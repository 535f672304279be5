"""Session construction and cluster-safe scratch locations."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings every session of this library wants.  They are safe on a cluster:
# AQE re-plans shuffles at run time, coalesces small partitions and splits
# skewed join partitions; timestamps are read as UTC wall-clock.
BASE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}

#: bytes of one Arrow batch for a Python worker
WORKER_BATCH_BYTES = 4 << 20


def get_spark(master: str | None = None, shuffle_partitions: int | None = None,
              app_name: str = "voltchurn", extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the library defaults.

    On a cluster call it with ``master=None`` so the launcher's master wins.
    """
    b = SparkSession.builder.appName(app_name)
    if master:
        b = b.master(master)
    conf = dict(BASE_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    A cluster names it (a shared file system path) and we use that; without it
    a session on a cluster is refused, since its machines share no local folder.
    Only a local session, whose one process does all, gets a folder of its own.
    """
    sc = spark.sparkContext
    d = sc.getCheckpointDir() or sc.getConf().get("spark.checkpoint.dir", None)
    if not d:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that all machines of the cluster share")
        d = tempfile.mkdtemp(prefix="voltchurn-ckpt-")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(d)
    return sc.getCheckpointDir() or d


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path for an intermediate table under the shared checkpoint folder."""
    return os.path.join(ensure_checkpoint_dir(spark), name)


def bound_batches(spark: SparkSession, most: int = WORKER_BATCH_BYTES) -> None:
    """Limits the Arrow batches that Python workers get to ``most`` bytes.

    Spark bounds a batch by rows and by 64 MB; a worker holds several copies of
    its batch (Python strings, arrays, results).  A smaller setting of the
    session stays as it is, and so does one written with a unit.
    """
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    now = spark.conf.get(key).rstrip("b")
    if now.isdigit() and int(now) > most:
        spark.conf.set(key, str(most))


def put_on_worker_path(spark: SparkSession) -> None:
    """Lets Python workers import this package from where the driver has it.

    Needed where the driver's process was not started in the repository; on a
    cluster whose machines do not share that folder, ship the package with
    ``--py-files`` instead.
    """
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    env = spark.sparkContext.environment
    paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        env["PYTHONPATH"] = os.pathsep.join([root, *paths])
