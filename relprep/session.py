"""Session construction and the shared checkpoint folder.

On a cluster the session is created by the platform; ``build_session`` is
for local runs and tests.  ``checkpoint_dir`` reads the folder the cluster
names in ``spark.checkpoint.dir`` and only invents one for a local master.
"""

from __future__ import annotations

import os
import tempfile
import uuid
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import SparkSession

# Settings that matter at scale as much as locally:
#  * AQE re-plans at every shuffle boundary: coalesces small partitions,
#    splits skewed join partitions and turns sort-merge joins into broadcast
#    joins when the runtime size of a side is under the broadcast threshold.
#  * The broadcast threshold is the size check for every implicit broadcast.
SCALE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.autoBroadcastJoinThreshold": "32m",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(
    master: str | None = None,
    shuffle_partitions: int | None = None,
    app_name: str = "relprep",
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Local/test session with the scale settings applied."""
    master = master or os.environ.get("RELPREP_MASTER", "local[*]")
    builder = SparkSession.builder.master(master).appName(app_name)
    conf = dict(SCALE_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions or 8)
    conf["spark.driver.memory"] = os.environ.get("RELPREP_DRIVER_MEMORY", "8g")
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for checkpoints and scratch tables.

    Uses ``spark.checkpoint.dir`` (or a directory already set on the
    SparkContext).  Only a local master gets a private temporary folder;
    a cluster without a configured shared folder is an error, because a
    machine-local path would not survive executor loss.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # Spark Connect clients have no SparkContext
        configured = spark.conf.get("spark.checkpoint.dir", None)
        if not configured:
            raise RuntimeError("spark.checkpoint.dir is not set on the server session") from None
        return configured
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir() or configured
    if not sc.master.startswith("local"):
        raise RuntimeError(
            "spark.checkpoint.dir is not set; configure a shared folder "
            "(e.g. on HDFS or object storage) for checkpoints and scratch tables"
        )
    local = tempfile.mkdtemp(prefix="relprep-ckpt-")
    sc.setCheckpointDir(local)
    return sc.getCheckpointDir() or local


#: Where scratch tables go while a step of a flow runs (``flows.Flow``).
_SCOPE: ContextVar[str | None] = ContextVar("scratch_scope", default=None)
_MADE: set[str] = set()


@contextmanager
def scratch_in(folder: str):
    """Scratch tables made inside go below ``folder``, whose owner removes them."""
    token = _SCOPE.set(folder)
    try:
        yield
    finally:
        _SCOPE.reset(token)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared checkpoint folder for a written table.

    The scratch tables of an application lie in one folder, which is removed
    when the driver ends.
    """
    scope = _SCOPE.get()
    if scope is None:
        scope = f"{checkpoint_dir(spark).rstrip('/')}/tables"
        try:
            scope = f"{scope}/{spark.sparkContext.applicationId}"
        except Exception:  # Spark Connect clients have no SparkContext: the server's owner clears the folder
            return f"{scope}/{name}-{uuid.uuid4().hex}"
        if scope not in _MADE:
            from relprep.sources.files import remove_on_exit

            remove_on_exit(spark, scope)
            _MADE.add(scope)
    return f"{scope}/{name}-{uuid.uuid4().hex}"

