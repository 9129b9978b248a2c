"""Session settings and the shared staging area."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def get_session(app: str = "simalign", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the library assumes; `conf` overrides any of them."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.ui.showConsoleProgress": "false",
        # call-site capture on every Column costs more than planning for wide aggregates
        "spark.python.sql.dataFrameDebugging.enabled": "false",
    }
    settings.update(conf)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach: `spark.checkpoint.dir` of the session.

    Only a local master may fall back to a folder of its own machine, which goes when the
    process ends.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    fallback = tempfile.mkdtemp(prefix="simalign-")
    atexit.register(shutil.rmtree, fallback, ignore_errors=True)
    spark.conf.set("spark.checkpoint.dir", fallback)
    return fallback


def stage(df: DataFrame, schema: StructType | None = None, **options) -> DataFrame:
    """Write `df` once to the shared folder and read it back; `options` are those of the writer.

    `schema` names types that are stored like those of `df`, such as vectors for their structs.

    Cuts the lineage and fixes values that would differ when recomputed. The files
    outlive any executor, keep column pruning, and give later joins real sizes.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/stage-{uuid.uuid4().hex}"
    df.write.options(**options).parquet(path)
    return spark.read.schema(schema or df.schema).parquet(path)
