"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings every job relies on. The number of shuffle partitions is left to the cluster: AQE
# coalesces small partitions and splits skewed ones.
JOB_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    # HotSpot compiles no method above 8000 bytes of code: a stage that generates more runs faster
    # as separate expressions than as one interpreted method
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # the call site of every expression is a debugging aid; recording it makes building the plans
    # of eleven venues several times slower
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def local_session(app: str = "playbill", cpus: str = "8", **conf: str) -> SparkSession:
    """A local session for tests and for the bench."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.shuffle.partitions", cpus if cpus.isdigit() else "8")
    )
    for key, value in {**JOB_CONF, **conf}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def with_method_limit(spark: SparkSession) -> SparkSession:
    """The session with the job's limit for generated methods, if it still has Spark's own (65535).

    Plans with many expressions a row need it: above 8000 bytes the stage's method is interpreted.
    """
    name = "spark.sql.codegen.hugeMethodLimit"
    if spark.conf.get(name, "65535") == "65535":
        spark.conf.set(name, JOB_CONF[name])
    return spark


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A new folder below the shared checkpoint folder of the cluster.

    Only a local session may fall back to a temporary folder: on a cluster such a folder would be
    visible to one machine only, so a missing setting is an error there.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
        root = tempfile.gettempdir()
    return f"{root.rstrip('/')}/playbill-{name}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: the rows survive the loss of any executor."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(scratch_dir(df.sparkSession, "checkpoint"))
    return df.checkpoint(eager=True)
