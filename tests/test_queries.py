import os

import pytest

import __spark_entry__ as entry
from checks import compare
from checks.oracle import STEPS, with_steps

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
SQL = entry.oracle_sql()
# too slow for every test run; the operators have tests of their own
LONG = {
    "train_candidates", "train_and_monitor", "feature_importances", "select_important", "score_train_and_test",
    "score_with_stored_model",
}


@pytest.fixture(scope="module")
def con():
    with compare.connect(FOLDER) as con:
        yield con


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_agrees_with_sql(spark, con, name):
    assert compare.difference(entry.queries()[name](spark, FOLDER), con, SQL[name]) is None


@pytest.mark.parametrize("name", sorted(set(entry.queries()) - set(SQL) - LONG))
def test_query_has_rows(spark, name):
    assert entry.queries()[name](spark, FOLDER).count() > 0


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns == ["YEAR", "MONTH", "n_customers", "n_churned"] and df.count() > 0


def test_every_text_has_a_query():
    assert set(SQL) <= set(entry.queries())


def test_account_rules_leave_the_known_rows(con):
    """Row counts after every step, as documented for sf0.01."""
    folder = "/root/testdata/sf0.01"
    if not os.path.isdir(folder):
        pytest.skip("no sf0.01")
    with compare.connect(folder) as small:
        tables = ["events", "after_creation", "one_creation", "unshared", "one_product", "by_account", "in_order", "held"]
        counts = [small.execute(with_steps(f"SELECT count(*) FROM {{{t}}}")).fetchone()[0] for t in tables]
    assert counts == [5450, 5405, 5357, 5165, 5111, 4343, 4283, 1429]
    assert set(tables) <= set(STEPS)
