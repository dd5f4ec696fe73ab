"""Session helpers: a local session for tests/bench and the shared work folder.

Library code never builds its own session; it takes the caller's.  Anything
that has to be written (staged tables, mirror versions, CSV exports, cut
lineage) goes below ``spark.checkpoint.dir`` -- the shared folder a cluster
names for exactly this.  Only when that setting is unset *and* the master is
local (tests) do we pick a folder ourselves.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession


def _driver_gb(cap: int = 8) -> int:
    """Local driver heap: 60% of physical memory, at most ``cap`` GB (a 7 GB machine gets 4 GB)."""
    try:
        total = os.sysconf("SC_PAGE_SIZE") * os.sysconf("SC_PHYS_PAGES")
    except (ValueError, OSError, AttributeError):
        return 2
    return max(1, min(cap, int(total * 0.6 / 2 ** 30)))


def local_session(cores: int | str = "*", app: str = "ledgerlake", shuffle_partitions: int = 8,
                  extra: dict | None = None) -> SparkSession:
    """Local session with the settings the tests and the bench use."""
    b = (SparkSession.builder.master(f"local[{cores}]").appName(app)
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .config("spark.driver.host", "127.0.0.1")
         .config("spark.driver.bindAddress", "127.0.0.1")
         .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
         .config("spark.sql.adaptive.enabled", "true")
         .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
         .config("spark.sql.adaptive.skewJoin.enabled", "true")
         .config("spark.sql.session.timeZone", "UTC")
         .config("spark.driver.memory", f"{_driver_gb()}g"))
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    work_root(spark)
    return spark


_LOCAL_ROOTS: dict[str, str] = {}          # application id -> private folder, on a local master without the setting


def work_root(spark: SparkSession) -> str:
    """Shared folder for staged writes: ``spark.checkpoint.dir`` of the session.

    If it is unset we only fall back to a private folder on a local master;
    on a cluster a machine-local folder would be wrong, so we refuse.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        master = spark.sparkContext.master or ""
        if not master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
        # The setting cannot be changed in a running session; the folder is kept by application.
        root = _LOCAL_ROOTS.setdefault(spark.sparkContext.applicationId, "") or tempfile.mkdtemp(prefix="ledgerlake-work-")
        _LOCAL_ROOTS[spark.sparkContext.applicationId] = root
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(root)
    return root.rstrip("/")


def fresh_dir(spark: SparkSession, tag: str) -> str:
    """A new, unique path below the work root (never reused, never cleared; writers create it)."""
    return f"{work_root(spark)}/ledgerlake/{tag}-{uuid.uuid4().hex[:12]}"
