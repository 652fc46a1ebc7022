import datetime as dt
import os
from decimal import Decimal

import pytest
from pyspark.sql.types import StructType

from ebbtide import sources
from ebbtide.schemas import RAW_TRANSACTION
from ebbtide.session import materialise, shared_folder


def test_latest_period_skips_odd_names(spark):
    names = ["2021_12", "2022_04", "20ab_cd", "2022_4", "1999_12", "2022_13", "backup_x", None]
    df = spark.createDataFrame([(n,) for n in names], "name string")
    assert sources.latest_period_of_names(df).first().period == dt.date(2022, 4, 1)
    empty = sources.latest_period_of_names(df.limit(0))
    assert empty.first().period is None


@pytest.mark.parametrize("new,monitor,last", [
    (False, False, (2022, 1)), (True, False, (2021, 11)), (True, True, (2022, 1)),
])
def test_observation_bounds(new, monitor, last):
    first, end = sources.observation_bounds(2021, 11, 12, new, monitor)
    assert (first, end) == (dt.date(2020, 12, 1), dt.date(*last, 1))


def test_observation_window(spark):
    months = sources.observation_window(spark, dt.date(2020, 11, 1), dt.date(2021, 2, 1)).collect()
    assert [m.period for m in months] == [
        dt.date(2020, 11, 1), dt.date(2020, 12, 1), dt.date(2021, 1, 1), dt.date(2021, 2, 1)]


def _month(spark, root, name, year, month):
    row = [year, month, 1, "c", "a"] + [1] * 11 + ["VND"] + ["1.50"] * 5
    text = ",".join(RAW_TRANSACTION.names) + "\n" + ",".join(map(str, row)) + "\n"
    os.makedirs(f"{root}/{name}")
    with open(f"{root}/{name}/part.csv", "w") as f:
        f.write(text)


def test_scan_months(spark, tmp_path):
    root = str(tmp_path)
    for name, y, m in (("2020_12", 2020, 12), ("2021_01", 2021, 1), ("2021_03", 2021, 3)):
        _month(spark, root, name, y, m)
    bounds = dt.date(2020, 12, 1), dt.date(2021, 1, 1)
    df = sources.scan_months(spark, root, RAW_TRANSACTION, *bounds)
    assert df.schema == RAW_TRANSACTION
    assert sorted((r.YEAR, r.MONTH) for r in df.collect()) == [(2020, 12), (2021, 1)]
    with pytest.raises(FileNotFoundError, match="2021_02"):
        sources.scan_months(spark, root, RAW_TRANSACTION, dt.date(2021, 1, 1), dt.date(2021, 3, 1))
    gap = sources.scan_months(spark, root, RAW_TRANSACTION, dt.date(2021, 1, 1), dt.date(2021, 3, 1), True)
    assert gap.count() == 2
    none = sources.scan_months(spark, root, RAW_TRANSACTION, dt.date(2019, 1, 1), dt.date(2019, 1, 1), True)
    assert none.count() == 0 and none.schema == RAW_TRANSACTION


def _files(folder, **texts):
    folder.mkdir(exist_ok=True)
    for name, text in texts.items():
        (folder / f"{name}.csv").write_text(text)
    return str(folder)


SMALL = StructType().add("id", "string").add("n", "integer").add("amount", "decimal(18,2)")


def test_csv_columns_are_found_by_name(spark, tmp_path, rows):
    one = _files(tmp_path / "one", a="n,id,amount\n1,x,2.50\n", b="n,id,amount\n,y,\n")
    two = _files(tmp_path / "two", a="so tien,id,n\n3.00,z,2\n")
    mapping = spark.createDataFrame([("so tien", "amount"), ("khac", "other")], "VN string, EN string")
    got = sources.read_csv(spark, [one, two], SMALL, mapping)
    assert got.schema == SMALL
    assert rows(got) == [("x", 1, Decimal("2.50")), ("y", None, None), ("z", 2, Decimal("3.00"))]


@pytest.mark.parametrize("header", ["id,n", "id,n,amount,more", "id,n,n", "id,n,total"])
def test_csv_with_other_columns_is_an_error(spark, tmp_path, header):
    path = _files(tmp_path / "t", a=header + "\n")
    with pytest.raises(ValueError, match="header of"):
        sources.read_csv(spark, path, SMALL)


def test_csv_files_of_one_folder_must_agree(spark, tmp_path):
    path = _files(tmp_path / "t", a="id,n,amount\nx,1,1\n", b="n,id,amount\n1,y,1\n")
    with pytest.raises(Exception, match="header"):
        sources.read_csv(spark, path, SMALL).collect()


def test_unparsable_fields(spark, tmp_path, rows):
    path = _files(tmp_path / "t", a="id,n,amount\nx,one,1\ny,2,\nz,two,1.2.3\n")
    with pytest.raises(Exception, match="not a value of n: (one|two)"):
        sources.read_csv(spark, path, SMALL).collect()
    lenient = sources.read_csv(spark, path, SMALL, strict=False)
    assert rows(lenient, "id", "n") == [("x", None), ("y", 2), ("z", None)]
    text = sources.read_csv_text(spark, path, SMALL)
    assert rows(sources.unparsable_report(text, SMALL)) == [("amount", 1), ("n", 2)]


def test_write_table(spark, tmp_path, rows):
    df = spark.createDataFrame([(1, "a"), (2, None)], "n int, s string")
    for csv in (False, True):
        for _ in range(2):  # overwrites
            path = sources.write_table(df, str(tmp_path), "t", csv)
        back = sources.read_csv(spark, path, df.schema) if csv else sources.read_table(spark, path)
        assert rows(back) == rows(df)
    assert sources.write_table(df, "", "t") is None


def test_stored_sample_is_reused(spark, tmp_path):
    calls = []

    def build():
        calls.append(1)
        return {"t": spark.range(len(calls))}

    first = sources.sample_or_stored(spark, str(tmp_path), build, ["t"], reuse=False)["t"].count()
    again = sources.sample_or_stored(spark, str(tmp_path), build, ["t"], reuse=True)["t"].count()
    assert (first, again, len(calls)) == (1, 1, 1)


def test_materialise_is_a_plain_scan(spark):
    df = materialise(spark.range(10).selectExpr("id", "id % 3 AS k"), "t", ("k",))
    assert df.columns == ["id", "k"] and df.filter("k = 1").count() == 3
    assert shared_folder(spark) == shared_folder(spark)
    assert "Range" not in df._jdf.queryExecution().executedPlan().toString()
