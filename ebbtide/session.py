"""Session settings and the shared folder for written intermediate tables."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

#: application id -> its folder
_own: dict[str, str] = {}

DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # split a hot partition even where the split costs one more shuffle
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def session(app: str = "ebbtide", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the operators assume; cluster sizing stays with spark-submit."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """Folder for intermediate tables: the one the cluster names in ``spark.checkpoint.dir``.

    Only a local master may fall back to a folder of its own; on a cluster an executor's local
    disk cannot be read by the others.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that every node can reach")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="run-", dir="/tmp"))
    return context.getCheckpointDir().rstrip("/")


def own_folder(spark: SparkSession) -> str:
    """The folder below the shared one that holds what this application stores."""
    app = spark.sparkContext.applicationId
    if app not in _own:
        _own[app] = f"{shared_folder(spark)}/ebbtide-{app}-{uuid.uuid4().hex}"
    return _own[app]


def new_folder(spark: SparkSession, name: str) -> str:
    """A path below the application's folder that nobody else uses."""
    return f"{own_folder(spark)}/{name}-{uuid.uuid4().hex}"


def drop_stored(spark: SparkSession) -> None:
    """Delete what this application has stored so far.

    Meant for the end of a job: every DataFrame that ``materialise`` returned, and all that is derived from
    one, is of no use afterwards. Results to keep are written elsewhere first. What is stored later goes to a
    new folder.
    """
    folder = _own.pop(spark.sparkContext.applicationId, None)
    if folder is not None:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


#: Bytes of a shuffle that one task reads, and the least it reads where there are free cores.
PARTITION, LEAST_PARTITION = 8 << 20, 1 << 16
_UNITS = {"b": 1, "k": 1 << 10, "m": 1 << 20, "g": 1 << 30}


def _bytes(setting: str) -> int:
    number, unit = re.fullmatch(r"\s*(\d+)\s*([bkmg]?)[a-z]*\s*", setting.lower()).groups()
    return int(number) * _UNITS[unit or "b"]


def bounded_partitions(spark: SparkSession) -> None:
    """Tasks read small parts of a shuffle, and there are enough parts.

    What arrives is compressed, and the rows of a customer's months take many times that when they are sorted. The
    number of parts before Spark joins small ones is four times that of the session. Smaller settings stand.
    """
    for name, most, default in (("advisoryPartitionSizeInBytes", PARTITION, "64MB"),
                                ("coalescePartitions.minPartitionSize", LEAST_PARTITION, "1MB")):
        name = f"spark.sql.adaptive.{name}"
        if _bytes(spark.conf.get(name, default)) > most:
            spark.conf.set(name, f"{most}b")
    name = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    if spark.conf.get(name, None) is None:
        spark.conf.set(name, str(4 * int(spark.conf.get("spark.sql.shuffle.partitions"))))


def materialise(
    df: DataFrame, name: str, partition_by: tuple[str, ...] = (), row_group: int | None = None
) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Several consumers then start from stored files: lineage is cut, and a lost executor costs
    its running tasks only, not the stages before. A task holds a row group of one column whole
    as it reads it; ``row_group`` bounds its bytes where one column is nearly all of the table.
    """
    path = new_folder(df.sparkSession, name)
    writer = df.write.partitionBy(*partition_by)
    if row_group:
        writer = writer.option("parquet.block.size", row_group)
    writer.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
