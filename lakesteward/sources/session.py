"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str, master: str | None = None, cores: int | None = None) -> SparkSession:
    """A session for tests and local benchmarks; clusters bring their own."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master).config("spark.ui.enabled", "false")
        builder = builder.config("spark.driver.memory", "12g")
    if cores:
        builder = builder.config("spark.sql.shuffle.partitions", str(cores))
    return (
        builder.config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        # Beyond this size the JVM does not compile a generated method.
        .config("spark.sql.codegen.hugeMethodLimit", "8000")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .getOrCreate()
    )


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors see, as the cluster names it.

    A local session without the setting gets a folder of its own; a cluster must
    name one, since a machine's own folder would be lost with the machine.
    """
    sc = spark.sparkContext
    folder = sc.getConf().get("spark.checkpoint.dir") or sc.getCheckpointDir()
    if not folder:
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors see")
        folder = tempfile.mkdtemp(prefix="lakesteward-")
        sc.setCheckpointDir(folder)
    return folder


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/lakesteward/{uuid.uuid4().hex}/{name}"


def cut(df: DataFrame) -> DataFrame:
    """Checkpoint in the shared folder, so later stages survive lost executors."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)
