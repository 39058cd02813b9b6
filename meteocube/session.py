"""Session-level helpers: where shared intermediate data may live."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

_CONF_KEY = "spark.checkpoint.dir"
_local: dict[str, str] = {}  # root per application of a single-machine session without the setting


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Without the setting (and without ``setCheckpointDir``) a session whose master is a cluster gets an
    error: a folder of our own choice would be another disk on every executor.  Only a ``local``
    master, whose tasks run inside the driver, gets a temporary folder.  The folder is also installed
    as the RDD checkpoint directory, so that ``DataFrame.checkpoint()`` writes there too.
    """
    root = spark.conf.get(_CONF_KEY, None)
    try:
        sc = spark.sparkContext
    except Exception:  # Spark Connect: no driver-side context; the server owns the setting
        sc = None
    if sc is not None:
        root = root or sc.getConf().get(_CONF_KEY, None) or sc.getCheckpointDir()
    if not root:
        if sc is None or not _in_driver(sc.master):
            raise RuntimeError(f"set {_CONF_KEY} to a folder that the driver and all executors share")
        root = _local.setdefault(sc.applicationId, "") or tempfile.mkdtemp(prefix="meteocube-ckpt-")
        _local[sc.applicationId] = root
    if sc is not None and sc.getCheckpointDir() is None:
        sc.setCheckpointDir(root)
        if sc.applicationId not in _local:
            _local[sc.applicationId] = root
    # getCheckpointDir() is a sub-folder of what was set; keep the first answer of the application.
    return _local.setdefault(sc.applicationId, root).rstrip("/") if sc is not None else root.rstrip("/")


def _in_driver(master: str) -> bool:
    return master == "local" or master.startswith("local[")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path below the shared folder for one write."""
    return f"{shared_dir(spark)}/meteocube/{name}-{uuid.uuid4().hex[:12]}"
