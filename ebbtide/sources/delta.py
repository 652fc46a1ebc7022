"""Tables with a transaction log in the open Delta format, without its package.

A table is a folder of Parquet files and ``_delta_log``, whose numbered commits add and remove files. A commit is one
new file in that folder, so readers see a table before or after it, never between. Files that a later commit removes
stay where they are: readers of an older version, also plans that are under way, keep what they started with.
"""

from __future__ import annotations

import json
import time
import uuid
from urllib.parse import quote, unquote

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

LOG = "_delta_log"
#: The parts of the log that a reader needs; whatever else commits hold is not read.
ACTIONS = (
    "add struct<path:string,partitionValues:map<string,string>,deletionVector:struct<storageType:string>>, "
    "remove struct<path:string>, "
    "metaData struct<schemaString:string,partitionColumns:array<string>,configuration:map<string,string>>, "
    "protocol struct<minReaderVersion:int,readerFeatures:array<string>>"
)
#: Reader features that change nothing about which rows a file holds, or whose use is seen per file.
READABLE = {"deletionVectors", "timestampNtz", "v2Checkpoint", "vacuumProtocolCheck"}


def _log_files(spark: SparkSession, path: str) -> dict[int, dict[str, list[str]]]:
    """The commits and checkpoints of each version, found by name: one row per commit, none is opened."""
    try:
        found = spark.read.format("binaryFile").load(f"{path}/{LOG}").select("path").collect()
    except AnalysisException as error:
        raise FileNotFoundError(f"no table with a log in {path}") from error
    versions: dict[int, dict[str, list[str]]] = {}
    for row in found:
        head, *rest = row.path.rsplit("/", 1)[-1].split(".")
        kind = {("json",): "commit"}.get(tuple(rest))
        if len(rest) >= 2 and rest[0] == "checkpoint" and rest[-1] == "parquet":
            kind = "checkpoint" if len(rest) == 2 else f"checkpoint of {rest[-2]}"
        if head.isdigit() and kind:
            versions.setdefault(int(head), {}).setdefault(kind, []).append(row.path)
    return versions


def _checkpoint(kinds: dict[str, list[str]]) -> list[str] | None:
    """The files of a complete checkpoint among those of one version."""
    for kind, files in kinds.items():
        *_, parts = kind.split(" ")
        if kind == "checkpoint" or kind != "commit" and parts.isdigit() and len(files) == int(parts):
            return files
    return None


def log_actions(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """(``version``, ``add``, ``remove``, ``metaData``, ``protocol``) from the last checkpoint up to ``version``."""
    files = _log_files(spark, path)
    if version is None:
        version = max(files, default=-1)
    if version not in files:
        raise ValueError(f"{path} has no version {version}")
    starts = [v for v in files if v <= version and _checkpoint(files[v])]
    first = max(starts, default=-1)
    wanted = range(first + 1, version + 1)
    missing = [v for v in wanted if "commit" not in files.get(v, {})]
    if missing:
        raise ValueError(f"{path} lacks the commits {missing}")
    number = F.regexp_extract("_metadata.file_name", r"^(\d+)\.", 1).cast("long").alias("version")
    names = ["add", "remove", "metaData", "protocol"]
    parts = []
    if first >= 0:
        stored = spark.read.schema(ACTIONS).parquet(*_checkpoint(files[first]))
        parts.append(stored.select(F.lit(first).cast("long").alias("version"), *names))
    if wanted:
        commits = spark.read.schema(ACTIONS).json([f for v in wanted for f in files[v]["commit"]])
        parts.append(commits.select(number, *names))
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])


def live_files(actions: DataFrame) -> DataFrame:
    """``add`` of the files whose last action adds them; one exchange of the log's actions, by path."""
    path = F.coalesce("add.path", "remove.path")
    last = actions.filter(path.isNotNull()).groupBy(path.alias("path")).agg(
        # within a commit an addition stands
        F.max_by(F.struct("add"), F.struct("version", F.col("add").isNotNull().alias("added"))).alias("last"))
    return last.filter("last.add IS NOT NULL").select("last.add.*")


def read_delta(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """The table at its newest version, or as it was at ``version``.

    The log is replayed by Spark; only the list of live files comes to the driver, as with every table of files.
    Columns that an older file lacks are null there. Column mapping, deletion vectors and unknown reader features
    change what a file means and are errors. A table without files has no rows.
    """
    path = path.rstrip("/")
    actions = log_actions(spark, path, version)
    newest = actions.agg(*[
        F.max_by(c, F.when(F.col(c).isNotNull(), F.col("version"))).alias(c) for c in ("metaData", "protocol")]).first()
    if newest.metaData is None:
        raise ValueError(f"the log of {path} describes no table")
    unknown = set((newest.protocol and newest.protocol.readerFeatures) or []) - READABLE
    settings = newest.metaData.configuration or {}
    if unknown or settings.get("delta.columnMapping.mode", "none") != "none":
        raise ValueError(f"{path} needs a reader of {sorted(unknown) or 'column mapping'}")
    schema = StructType.fromJson(json.loads(newest.metaData.schemaString))
    partitions = list(newest.metaData.partitionColumns or [])
    files = live_files(actions).select("path", F.col("deletionVector").isNotNull().alias("cut")).collect()
    if any(f.cut for f in files):
        raise ValueError(f"{path} has files with deletion vectors")
    if not files:
        return spark.createDataFrame([], schema)
    names = [unquote(f.path) for f in files]
    if partitions and not all(n.split("/")[: len(partitions)][k].startswith(f"{c}=") for n in names for k, c in enumerate(partitions)):
        raise ValueError(f"{path} has files outside of the folders of their partitions")
    paths = [n if "://" in n or n.startswith(("/", "file:")) else f"{path}/{n}" for n in names]
    return spark.read.schema(schema).option("basePath", path).parquet(*paths).select(schema.names)


def _put_new(spark: SparkSession, target: str, text: str) -> None:
    """Write ``target`` as a whole, or fail if it exists: written aside, then renamed without overwriting."""
    hadoop, conf = spark._jvm.org.apache.hadoop.fs, spark._jsc.hadoopConfiguration()
    aside, final = hadoop.Path(f"{target}.{uuid.uuid4().hex}.tmp"), hadoop.Path(target)
    system = final.getFileSystem(conf)
    out = system.create(aside, False)
    out.write(bytearray(text.encode()))
    out.close()
    options = spark.sparkContext._gateway.new_array(hadoop.Options.Rename, 1)
    options[0] = hadoop.Options.Rename.NONE
    try:
        hadoop.FileContext.getFileContext(system.getUri(), conf).rename(aside, final, options)
    except Exception as error:
        system.delete(aside, False)
        raise FileExistsError(f"{target} exists: another writer was first") from error


def write_delta(df: DataFrame, path: str, mode: str = "overwrite") -> int:
    """Publish ``df`` as the next version of the table at ``path``, instead of its rows or in addition; the version.

    The rows are written to a folder of their own first and become the table with one commit at the end. Whatever
    fails before leaves the table as it was; the plan of ``df`` may read the table it overwrites. Of two writers
    of one version the second fails, and so does an append with other columns. Partition columns are not laid out.
    """
    if mode not in ("overwrite", "append"):
        raise ValueError(f"unknown mode {mode}")
    spark, path = df.sparkSession, path.rstrip("/")
    try:
        newest = max(_log_files(spark, path), default=-1)
    except FileNotFoundError:
        newest = -1
    # files of any version may lack values
    schema = StructType.fromJson(json.loads(json.dumps(df.schema.jsonValue()).replace('"nullable": false', '"nullable": true')))
    removed = []
    if newest >= 0:
        if mode == "overwrite":
            removed = [r.path for r in live_files(log_actions(spark, path, newest)).select("path").collect()]
        elif read_delta(spark, path, newest).schema != schema:
            raise ValueError(f"the columns of {path} are others")
    part = f"part-{uuid.uuid4().hex}"
    df.write.parquet(f"{path}/{part}")
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(f"{path}/{part}").select(
        "path", "length", F.unix_millis("modificationTime").alias("time")).collect()
    now = int(time.time() * 1000)
    lines = [{"commitInfo": {"timestamp": now, "operation": "WRITE", "operationParameters": {"mode": mode}}}]
    if newest < 0 or mode == "overwrite":
        lines += [{"protocol": {"minReaderVersion": 1, "minWriterVersion": 2}}, {"metaData": {
            "id": str(uuid.uuid4()), "format": {"provider": "parquet", "options": {}}, "schemaString": schema.json(),
            "partitionColumns": [], "configuration": {}, "createdTime": now}}]
    lines += [{"remove": {"path": p, "deletionTimestamp": now, "dataChange": True}} for p in removed]
    lines += [{"add": {"path": quote(f"{part}/{f.path.rsplit('/', 1)[-1]}"), "partitionValues": {}, "size": f.length,
                       "modificationTime": f.time, "dataChange": True}} for f in files]
    _put_new(spark, f"{path}/{LOG}/{newest + 1:020d}.json", "".join(json.dumps(line) + "\n" for line in lines))
    return newest + 1
