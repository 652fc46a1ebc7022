import json
import os
import shutil

import pytest

from ebbtide import sources
from ebbtide.sources import delta


def commit(path, version, *actions):
    os.makedirs(f"{path}/_delta_log", exist_ok=True)
    with open(f"{path}/_delta_log/{version:020d}.json", "w") as f:
        f.writelines(json.dumps(a) + "\n" for a in actions)


def described(schema, partitions=(), **settings):
    return {"metaData": {"schemaString": schema.json(), "partitionColumns": list(partitions), "configuration": settings}}


def add(name, **more):
    return {"add": {"path": name, "partitionValues": {}, **more}}


def remove(name):
    return {"remove": {"path": name}}


@pytest.fixture
def files(spark, tmp_path):
    """A folder with the files 0 to 4, each of ten rows."""
    path = str(tmp_path / "t")
    os.makedirs(path)
    for k in range(5):
        spark.range(10 * k, 10 * k + 10).coalesce(1).write.parquet(f"{tmp_path}/{k}")
        part = next(n for n in os.listdir(f"{tmp_path}/{k}") if n.endswith(".parquet"))
        shutil.copy(f"{tmp_path}/{k}/{part}", f"{path}/{k} a.parquet")
    return path


def tens(df):
    return sorted({r.id // 10 for r in df.collect()})


def test_a_log_with_removals_and_a_checkpoint(spark, files):
    schema = spark.range(1).schema
    protocol = {"protocol": {"minReaderVersion": 1, "minWriterVersion": 2}}
    # names are encoded, a file may come back, and within a commit an addition stands
    commit(files, 0, protocol, described(schema), add("0%20a.parquet"), add("1%20a.parquet"), {"commitInfo": {"operation": "x"}})
    commit(files, 1, remove("0%20a.parquet"), add("2%20a.parquet", stats="{}"))
    commit(files, 2, add("0%20a.parquet"), remove("0%20a.parquet"), remove("1%20a.parquet"))
    assert [tens(sources.read_delta(spark, files, v)) for v in range(3)] == [[0, 1], [1, 2], [0, 2]]
    state = delta.log_actions(spark, files).drop("version").filter("add.path LIKE '0%' OR add.path LIKE '2%' OR metaData IS NOT NULL")
    state.coalesce(1).write.parquet(f"{files}-state")
    part = next(n for n in os.listdir(f"{files}-state") if n.endswith(".parquet"))
    shutil.copy(f"{files}-state/{part}", f"{files}/_delta_log/{2:020d}.checkpoint.parquet")
    commit(files, 3, add("3%20a.parquet"), remove("2%20a.parquet"))
    # what a checkpoint covers is not read again, and half a checkpoint is none
    os.remove(f"{files}/_delta_log/{0:020d}.json")
    shutil.copy(f"{files}-state/{part}", f"{files}/_delta_log/{3:020d}.checkpoint.0000000001.0000000002.parquet")
    assert tens(sources.read_delta(spark, files)) == [0, 3] == tens(sources.read_table(spark, files + "/", "delta"))
    with pytest.raises(ValueError, match="lacks the commits"):
        sources.read_delta(spark, files, 1)
    with pytest.raises(ValueError, match="no version 7"):
        sources.read_delta(spark, files, 7)


def test_partitions_nulls_and_added_columns(spark, tmp_path, rows):
    path = str(tmp_path / "t")
    df = spark.createDataFrame([(1, "a b", "01"), (2, None, "02"), (3, "c/d", None)], "n int, p string, q string")
    df.write.partitionBy("p", "q").parquet(path)
    from urllib.parse import quote
    found = [os.path.relpath(os.path.join(d, f), path) for d, _, fs in os.walk(path) for f in fs if f.endswith(".parquet")]
    schema = spark.createDataFrame([], "n int, p string, q string, late double").schema
    commit(path, 0, described(schema, ["p", "q"]), *[add(quote(f)) for f in found])
    table = sources.read_delta(spark, path)
    assert table.schema == schema and rows(table) == rows(df.selectExpr("*", "NULL"))
    assert "PartitionFilters: [isnotnull(q" in table.filter("q = '01'")._jdf.queryExecution().executedPlan().toString()
    commit(path, 1, *[remove(quote(f)) for f in found])
    empty = sources.read_delta(spark, path)
    assert empty.schema == schema and empty.count() == 0
    commit(path, 2, add("x.parquet"))
    with pytest.raises(ValueError, match="outside of the folders"):
        sources.read_delta(spark, path)


def test_what_cannot_be_read_is_an_error(spark, files):
    with pytest.raises(FileNotFoundError):
        sources.read_delta(spark, files)
    schema = spark.range(1).schema
    commit(files, 0, add("0%20a.parquet"))
    with pytest.raises(ValueError, match="describes no table"):
        sources.read_delta(spark, files)
    commit(files, 1, described(schema, **{"delta.columnMapping.mode": "name"}))
    with pytest.raises(ValueError, match="column mapping"):
        sources.read_delta(spark, files)
    commit(files, 2, described(schema), {"protocol": {"minReaderVersion": 3, "readerFeatures": ["unheardOf"]}})
    with pytest.raises(ValueError, match="unheardOf"):
        sources.read_delta(spark, files)
    commit(files, 3, {"protocol": {"minReaderVersion": 3, "readerFeatures": ["deletionVectors"]}})
    assert tens(sources.read_delta(spark, files)) == [0]
    commit(files, 4, add("1%20a.parquet", deletionVector={"storageType": "u"}))
    with pytest.raises(ValueError, match="deletion vectors"):
        sources.read_delta(spark, files)


def test_publishing(spark, tmp_path):
    path = str(tmp_path / "t")
    assert sources.write_delta(spark.range(20), path) == 0
    old = sources.read_delta(spark, path)
    # the plan reads the table that it overwrites
    assert sources.write_delta(old.filter("id >= 10"), path) == 1
    assert sources.write_delta(spark.range(30, 35), path, "append") == 2
    assert tens(sources.read_delta(spark, path)) == [1, 3] and tens(old) == [0, 1] == tens(sources.read_delta(spark, path, 0))
    failing = spark.range(5).selectExpr("raise_error('no') AS id")
    with pytest.raises(Exception, match="no"):
        sources.write_delta(failing, path)
    with pytest.raises(ValueError, match="columns"):
        sources.write_delta(spark.range(3).selectExpr("id", "id AS more"), path, "append")
    assert tens(sources.read_delta(spark, path)) == [1, 3]
    assert sources.write_delta(spark.range(0), path) == 3
    assert sources.read_delta(spark, path).count() == 0


def test_the_second_writer_of_a_version_fails(spark, tmp_path):
    path = str(tmp_path / "t")
    sources.write_delta(spark.range(10), path)
    log = f"{path}/_delta_log/{0:020d}.json"
    before = open(log).read()
    with pytest.raises(FileExistsError):
        delta._put_new(spark, log, "{}")
    assert open(log).read() == before and not [n for n in os.listdir(f"{path}/_delta_log") if n.endswith(".tmp")]
