"""Where derived tables go: the shared folder that the session names."""

from __future__ import annotations

import itertools
import tempfile

from pyspark.sql import SparkSession

_local_dirs: dict[str, str] = {}
_run_numbers = itertools.count(1)


def scratch_root(spark: SparkSession) -> str:
    """Folder of this application under ``spark.checkpoint.dir``.

    Only a local session may run without that setting; it then gets a new temporary folder.
    """
    app = spark.sparkContext.applicationId
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = _local_dirs.setdefault(app, tempfile.mkdtemp(prefix="jsonmart-"))
    return f"{base.rstrip('/')}/jsonmart/{app}"


def fresh_dir(spark: SparkSession, label: str) -> str:
    """A folder that no earlier call of this application has returned."""
    return f"{scratch_root(spark)}/{label}-{next(_run_numbers)}"
