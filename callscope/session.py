"""Session settings and the shared scratch folder."""

import os
import shutil
import tempfile
import uuid

from pyspark.sql import SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"


def build_session(app: str = "callscope", master: str | None = None, **conf: str) -> SparkSession:
    """Session with the settings the jobs rely on: UTC, adaptive execution, Arrow."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        # Call site capture costs several round trips to the JVM per column.
        "spark.python.sql.dataFrameDebugging.enabled": "false",
    } | conf
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A new folder below the shared checkpoint folder of the cluster.

    Only a local master, where all tasks share one disk, may go without that setting.
    """
    root = spark.conf.get(CHECKPOINT_DIR, None) or spark.sparkContext.getCheckpointDir()
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError(f"set {CHECKPOINT_DIR} to a folder all executors share")
        # The setting itself cannot be changed in a running session; the context keeps the folder.
        root = tempfile.mkdtemp(prefix="callscope-")
        spark.sparkContext.setCheckpointDir(root)
    return os.path.join(root, f"{name}-{uuid.uuid4().hex}")


def ship_package(spark: SparkSession) -> None:
    """Make this package importable in the Python workers of the session.

    Not needed where the package is installed on the cluster or was submitted with
    `--py-files`.
    """
    context = spark.sparkContext
    if any(path.endswith(_ARCHIVE) for path in getattr(context, "_callscope_shipped", ())):
        return
    package = os.path.dirname(os.path.abspath(__file__))
    folder = tempfile.mkdtemp(prefix="callscope-package-")
    base = os.path.join(folder, _ARCHIVE.removesuffix(".zip"))
    archive = shutil.make_archive(base, "zip", os.path.dirname(package), os.path.basename(package))
    context.addPyFile(archive)
    context._callscope_shipped = (archive,)


_ARCHIVE = "callscope-package.zip"
