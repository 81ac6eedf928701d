"""Session settings and the shared folders a job may write to."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings the semantics depend on (see README "Semantics"). Shuffle partition
# counts are left to AQE on a cluster.
REQUIRED_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # With pruning on, a FAILFAST CSV scan that reads few columns accepts ragged rows.
    "spark.sql.csv.parser.columnPruning.enabled": "false",
}


# HotSpot does not JIT-compile methods over 8000 bytecodes; a fused stage of the
# silver typing can exceed that and then runs interpreted (several times slower).
# JVM options only take effect when the JVM starts: set them at submit time on a
# cluster (spark.executor.extraJavaOptions); build_session sets them for local runs.
JIT_JAVA_OPTIONS = "-XX:-DontCompileHugeMethods"


def build_session(
    master: str | None = None, app_name: str = "spendstar", extra: dict | None = None
) -> SparkSession:
    """Create (or reuse) a session with the settings the warehouse relies on."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    launch = {
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.driver.extraJavaOptions": JIT_JAVA_OPTIONS,
        "spark.executor.extraJavaOptions": JIT_JAVA_OPTIONS,
    }
    for key, value in {**REQUIRED_CONF, **launch, **(extra or {})}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    apply_runtime_conf(spark)
    return spark


def apply_runtime_conf(spark: SparkSession) -> None:
    """Set the SQL settings the semantics depend on in an existing session."""
    for key, value in REQUIRED_CONF.items():
        spark.conf.set(key, value)


# Local-mode sessions without spark.checkpoint.dir get one temp folder each.
_LOCAL_ROOTS: dict[str, str] = {}


def _is_local(spark: SparkSession) -> bool:
    return spark.sparkContext.master.startswith("local")


def shared_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster it must be set (a machine-local folder is not visible to other
    executors). Only a local-mode session without it gets a fresh temp folder.
    """
    sc = spark.sparkContext
    root = sc.getConf().get("spark.checkpoint.dir", None)
    if not root:
        try:
            root = spark.conf.get("spark.checkpoint.dir")
        except Exception:  # noqa: BLE001 - unset key
            root = None
    if not root:
        if not _is_local(spark):
            raise RuntimeError(
                "spark.checkpoint.dir is not set; name a shared folder (HDFS/S3/ABFS) for it"
            )
        app = sc.applicationId
        if app not in _LOCAL_ROOTS:
            _LOCAL_ROOTS[app] = tempfile.mkdtemp(prefix="spendstar-")
        root = _LOCAL_ROOTS[app]
    return root.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the shared folder for an intermediate write."""
    return f"{shared_root(spark)}/work/{name}-{uuid.uuid4().hex[:12]}"
