"""Session settings and the shared work folder."""

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import SparkSession


def build_session(app_name="ledgerline", master=None, **conf):
    """A session with the settings the jobs rely on; a cluster may override any of them."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.ui.enabled": "false",
        **{key.replace("__", "."): value for key, value in conf.items()},
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark, name):
    """A fresh folder under ``spark.checkpoint.dir``, the folder every executor can reach.

    Only a local-master session (tests) may go without the setting; there it gets a temporary folder, which is
    removed when the process ends.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
        root = tempfile.mkdtemp(prefix="ledgerline-")
        atexit.register(shutil.rmtree, root, ignore_errors=True)
        spark.conf.set("spark.checkpoint.dir", root)
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def use_checkpoint_dir(spark):
    """Give the context a checkpoint folder if the cluster has not set one already."""
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_dir(spark, "checkpoints"))
