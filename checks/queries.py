"""One query per operator, over whole test tables, with the SQL it must agree with.

Amounts leave as doubles, dates as text and measured numbers rounded, so that both engines print
the same values.
"""

from __future__ import annotations

import datetime as dt
import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import DateType, DecimalType

from ebbtide.functions import human_format
from ebbtide.operators import (
    accounts, churn, clean, demographics, evaluate, grouped, outliers, panel, prepare, profile,
    sample, training, trailing, trees,
)
from ebbtide.plans import fetch, modelling, monitoring, training_set
from ebbtide.schemas import (
    BALANCE, COUNTS, CUSTOMER, MEASURES, PANEL_MEASURES, PREDICTED, RAW_TRANSACTION, TARGET,
    TRANSACTION_COLUMNS,
)
from ebbtide.session import materialise, new_folder
from ebbtide import sources

from . import models
from .fixtures import Inputs
from .oracle import (
    ACCOUNT, DATES, DEMOGRAPHICS, GROUPS, HISTORY, ID, MONTH, MONTHLY, TRANSACTION, YEAR, _human,
    _join, _missing, _plain, with_steps,
)

OBSERVATION = training_set.Observation(YEAR, MONTH, HISTORY)
FIRST, LAST = sources.observation_bounds(YEAR, MONTH, HISTORY)
SEED, TEST_SIZE, SAMPLE = 42, 0.2, 500
ROUND = 4
PANEL = [*MONTHLY, "new_customer_flag", "cif_missing_flag"]
MERGED = [*PANEL, "No_of_Acc_Held", "CIF_CREATE"]

_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
_SQL: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a function of the inputs under its own name, with its SQL if there is one."""

    def register(function):
        def run(spark: SparkSession, folder: str) -> DataFrame:
            return plain(function(Inputs(spark, folder)))

        _QUERIES[function.__name__] = run
        if sql is not None:
            _SQL[function.__name__] = with_steps(sql)
        return function

    return register


def plain(df: DataFrame) -> DataFrame:
    def column(f):
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, DecimalType):
            return c.cast("double").alias(f.name)
        if isinstance(f.dataType, DateType):
            return c.cast("string").alias(f.name)
        return c

    return df.select([column(f) for f in df.schema.fields])


def rounded(df: DataFrame, names: list[str], digits: int = ROUND) -> DataFrame:
    return df.withColumns({c: F.round(F.col(f"`{c}`").cast("double"), digits) for c in names})


# --- shared inputs ------------------------------------------------------------------------------


def tables(t: Inputs) -> training_set.BankTables:
    return training_set.BankTables(
        t.raw_transaction, t.raw_account, t.raw_demographics, t.mapping_data_region,
        t.mapping_data_occupation, t.mapping_data_translation,
    )


def transactions(t: Inputs) -> DataFrame:
    return clean.drop_duplicates(t.raw_transaction)


def dated_demographics(t: Inputs) -> DataFrame:
    return clean.parse_dates(clean.drop_duplicates(t.raw_demographics), {"CIF_CREATE": "dd-MMM-yy"})


def grouped_demographics(t: Inputs) -> DataFrame:
    return demographics.group_demographics(
        dated_demographics(t), t.mapping_data_region, t.mapping_data_occupation
    )


def flagged(t: Inputs) -> DataFrame:
    kept = panel.keep_currency(transactions(t), "VND")
    monthly = panel.add_month_date(panel.rollup_monthly(kept))
    return panel.add_new_customer_flag(monthly, dated_demographics(t))


def bounds(t: Inputs):
    return panel.range_bounds(panel.keep_currency(t.raw_transaction, "VND"))


def whole_panel(t: Inputs) -> DataFrame:
    return panel.monthly_panel(transactions(t), dated_demographics(t))


def window_panel(t: Inputs) -> DataFrame:
    return training_set.transform_transactions(tables(t), dated_demographics(t), OBSERVATION)


def merged(
    t: Inputs, trailing_table: DataFrame | None = None, months: DataFrame | None = None
) -> DataFrame:
    return churn.merge_tables(
        (months or window_panel(t)).drop("date"), accounts.transform_accounts(accounts.clean_account_events(t.raw_account)),
        grouped_demographics(t), YEAR, MONTH, trailing_table,
    )


def labelled(t: Inputs) -> DataFrame:
    months = materialise(window_panel(t), "panel")
    return churn.with_churn_label(merged(t, months=months), churn.churn_label(months), YEAR, MONTH)


_labelled: dict[tuple[str, str], DataFrame] = {}


def stored_labelled(t: Inputs) -> DataFrame:
    """Stored once per session and folder: the input of the steps after this one."""
    key = (t.spark.sparkContext.applicationId, t.folder)
    if key not in _labelled:
        _labelled[key] = materialise(labelled(t), "labelled")
    return _labelled[key]


_features: dict[tuple[str, str], tuple[DataFrame, demographics.OneHot]] = {}


def features(t: Inputs) -> tuple[DataFrame, demographics.OneHot]:
    """The full feature table with its label, stored once per session and folder, and its categories."""
    key = (t.spark.sparkContext.applicationId, t.folder)
    if key not in _features:
        table, encoder = training_set.feature_table(tables(t), OBSERVATION)
        _features[key] = materialise(table, "features"), encoder
    return _features[key]


def fresh_train(t: Inputs) -> DataFrame:
    """The training part of the full feature table, as the selection steps get it."""
    return sample.split_by_hash(features(t)[0].drop(*prepare.NOT_CORRELATED), TEST_SIZE, SEED)[0]


# --- sources and sinks --------------------------------------------------------------------------


@query("SELECT CAST(CAST(date_trunc('month', max(o_orderdate)) AS DATE) AS VARCHAR) AS period FROM orders")
def latest_period(t):
    return sources.latest_period(t.orders, "o_orderdate")


@query("""
SELECT CAST(max(CAST(strptime(name, '%Y_%m') AS DATE)) AS VARCHAR) AS period FROM (
  SELECT strftime(o_orderdate, '%Y_%m') AS name FROM orders UNION ALL SELECT l_shipdate::VARCHAR FROM lineitem
) WHERE name LIKE '20__~___' ESCAPE '~'""")
def latest_period_of_names(t):
    names = t.orders.select(F.date_format("o_orderdate", "yyyy_MM").alias("name")).unionAll(
        t.lineitem.select(F.col("l_shipdate").cast("string"))
    )
    return sources.latest_period_of_names(names)


@query(f"""
SELECT CAST(CAST(p AS DATE) AS VARCHAR) AS period, count(o_orderkey) AS n
FROM (SELECT unnest(generate_series(DATE '{FIRST}', DATE '{LAST}', INTERVAL 1 MONTH)) AS p)
     LEFT JOIN orders ON date_trunc('month', o_orderdate) = p GROUP BY 1""")
def observation_window(t):
    months = sources.observation_window(t.spark, FIRST, LAST)
    inside = t.orders.filter(sources.in_window("o_orderdate", FIRST, LAST))
    counts = inside.groupBy(F.trunc("o_orderdate", "month").alias("period")).agg(F.count("*").alias("n"))
    return months.join(counts, "period", "left").fillna(0)


@query(f"SELECT {_plain(TRANSACTION)} FROM {{raw_transaction}} WHERE YEAR * 12 + MONTH BETWEEN "
       f"{FIRST.year * 12 + FIRST.month} AND {LAST.year * 12 + LAST.month}")
def scan_months(t):
    root = new_folder(t.spark, "months")
    stored = materialise(t.raw_transaction, "raw_transaction", ("YEAR", "MONTH"))
    month = FIRST
    while month <= LAST:
        here = (F.col("YEAR") == month.year) & (F.col("MONTH") == month.month)
        part = stored.filter(here).select(TRANSACTION_COLUMNS)
        part.write.option("header", True).csv(f"{root}/{month:%Y_%m}")
        month = dt.date(month.year + month.month // 12, month.month % 12 + 1, 1)
    return sources.scan_months(t.spark, root, RAW_TRANSACTION, FIRST, LAST)


@query("SELECT r_regionkey, r_name FROM region")
def read_table(t):
    return sources.read_table(t.spark, f"{t.folder}/region.parquet").select("r_regionkey", "r_name")


@query(f"SELECT {_plain(TRANSACTION)} FROM {{raw_transaction}}")
def write_table_parquet(t):
    path = sources.write_table(t.raw_transaction, new_folder(t.spark, "out"), "raw_transaction")
    return sources.read_table(t.spark, path)


@query(f"SELECT {_plain(TRANSACTION)} FROM {{raw_transaction}}")
def write_table_csv(t):
    path = sources.write_table(t.raw_transaction, new_folder(t.spark, "out"), "raw_transaction", csv=True)
    return sources.read_csv(t.spark, path, RAW_TRANSACTION)


@query(f"SELECT {_plain(TRANSACTION)} FROM {{raw_transaction}} WHERE MONTH NOT IN (2, 5)")
def read_table_with_log(t):
    """A table laid out by month, whose log drops one month, is checkpointed and drops another."""
    path = new_folder(t.spark, "logged")
    t.raw_transaction.write.partitionBy("MONTH").parquet(path)
    files = t.spark.read.format("binaryFile").option("recursiveFileLookup", True).option(
        "pathGlobFilter", "*.parquet").load(path).select(F.regexp_extract("path", r"(MONTH=[^/]+/[^/]+)$", 1).alias("path"))
    of_month = F.regexp_extract("path", r"MONTH=(\d+)/", 1)
    add = files.select(F.struct("path", F.create_map(F.lit("MONTH"), of_month).alias("partitionValues")).alias("add"))
    table = F.struct(F.lit(t.raw_transaction.schema.json()).alias("schemaString"), F.array(F.lit("MONTH")).alias("partitionColumns"))
    described = t.spark.range(1).select(table.alias("metaData"))

    def removed(month: int) -> DataFrame:
        return files.filter(of_month == month).select(F.struct("path").alias("remove"))

    steps = [add.unionByName(described, True), removed(2), None, removed(5)]
    steps[2] = add.filter(F.regexp_extract("add.path", r"MONTH=(\d+)/", 1) != 2).unionByName(described, True)
    for version, step in enumerate(steps):
        checkpoint = version == 2
        # Spark names its files itself; a log has the version for a name
        stored = new_folder(t.spark, "step")
        writer = step.coalesce(1).write
        (writer.parquet if checkpoint else writer.json)(stored)
        rename_part(t.spark, stored, f"{path}/_delta_log/{version:020d}.{'checkpoint.parquet' if checkpoint else 'json'}")
    return sources.read_table(t.spark, path, "delta").select(TRANSACTION)


_RAW_DEMOGRAPHICS = f"SELECT CIF_CREATE, {_plain([c for c in DEMOGRAPHICS if c != 'CIF_CREATE'])}"


@query(f"{_RAW_DEMOGRAPHICS}, 'now' AS seen FROM {{raw_demographics}} "
       f"UNION ALL {_RAW_DEMOGRAPHICS}, 'before' FROM {{raw_demographics}}")
def write_table_with_log(t):
    """A table overwritten by a part of itself, added to, and read at its first and its last version."""
    path = new_folder(t.spark, "published")
    first = sources.write_delta(t.raw_demographics, path)
    whole = sources.read_delta(t.spark, path)
    sources.write_delta(whole.filter("GENDER = 'F'"), path)
    sources.write_delta(whole.filter("NOT GENDER <=> 'F'"), path, "append")
    now = sources.read_table(t.spark, path, "delta").withColumn("seen", F.lit("now"))
    before = sources.read_delta(t.spark, path, first).withColumn("seen", F.lit("before"))
    return now.unionByName(before).select(*DEMOGRAPHICS, "seen")


@query(f"SELECT {_plain(ACCOUNT[:2] + ACCOUNT[3:4])}, DATE_OF_STATUS, AC_CREATE, STATUS_ID, PRODUCT_ID "
       f"FROM {{raw_account}} WHERE {ID} IN (SELECT {ID} FROM {{chosen}})")
def sample_or_stored(t):
    def build():
        chosen = sample.sample_customers(t.raw_transaction, SAMPLE, SEED)
        return sample.restrict_to_sample({"account": t.raw_account}, chosen)

    path = new_folder(t.spark, "sample")
    sources.sample_or_stored(t.spark, path, build, ["account"], reuse=False)
    return sources.sample_or_stored(t.spark, path, build, ["account"], reuse=True)["account"]


def rename_part(spark: SparkSession, folder: str, target: str) -> None:
    """Move the one data file of a folder that Spark wrote."""
    part = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(folder).select("path").first().path
    file = spark._jvm.org.apache.hadoop.fs.Path
    system = file(target).getFileSystem(spark._jsc.hadoopConfiguration())
    system.mkdirs(file(target).getParent())
    system.rename(file(part), file(target))


def _csv_folders(t) -> fetch.RawFolders:
    """The raw tables as a bank's files: months apart, columns in another order, two names untranslated."""
    root = new_folder(t.spark, "raw")
    stored = materialise(t.raw_transaction, "raw_transaction", ("YEAR", "MONTH"))
    month = FIRST
    while month <= LAST:
        part = stored.filter((F.col("YEAR") == month.year) & (F.col("MONTH") == month.month))
        names = TRANSACTION_COLUMNS if month.month % 2 else TRANSACTION_COLUMNS[::-1]
        part.select(names).write.option("header", True).csv(f"{root}/transactions/{month:%Y_%m}")
        month = dt.date(month.year + month.month // 12, month.month % 12 + 1, 1)
    t.raw_account.select(t.raw_account.columns[::-1]).write.option("header", True).csv(f"{root}/accounts")
    t.raw_demographics.withColumnsRenamed({"PROVINCE": "TINH", "OCCUPATION": "NGHE_NGHIEP"}).write.option(
        "header", True).csv(f"{root}/demographics")
    return fetch.RawFolders(f"{root}/transactions", f"{root}/accounts", f"{root}/demographics")


def _fetched(t) -> training_set.BankTables:
    return fetch.fetch(t.spark, _csv_folders(t), OBSERVATION, t.mapping_data_region, t.mapping_data_occupation,
                       t.mapping_data_translation)


@query(f"SELECT {_plain(MERGED)}, churn_flag FROM {{labelled_w}}")
def fetch_to_label(t):
    """From raw folders to the labelled table."""
    raw = _fetched(t)
    customers = training_set.transform_demographics(raw)
    months = materialise(training_set.transform_transactions(raw, customers, OBSERVATION), "panel")
    table = churn.merge_tables(
        months.drop("date"), training_set.transform_account_table(raw), customers, YEAR, MONTH, None)
    return churn.with_churn_label(table, churn.churn_label(months), YEAR, MONTH)


@query(f"""
SELECT {_plain([c for c in DEMOGRAPHICS if c != 'CIF_CREATE'])}, CIF_CREATE, n_accounts, n_transactions
FROM (SELECT * FROM {{raw_demographics}} WHERE {ID} IN (SELECT {ID} FROM {{chosen}}))
LEFT JOIN (SELECT {ID}, count(*) AS n_accounts FROM {{raw_account}} GROUP BY 1) USING ({ID})
LEFT JOIN (SELECT {ID}, count(*) AS n_transactions FROM {{raw_transaction}} GROUP BY 1) USING ({ID})""")
def sample_stage(t):
    """All three tables of the sampled customers, stored and read again."""
    path = new_folder(t.spark, "sample")
    fetch.sample_tables(t.spark, tables(t), path, SAMPLE, SEED)
    kept = fetch.sample_tables(t.spark, tables(t), path, SAMPLE, SEED, reuse=True)

    def count(df, name):
        return df.groupBy(CUSTOMER).agg(F.count("*").alias(name))

    return kept.demographics.join(count(kept.accounts, "n_accounts"), CUSTOMER, "left").join(
        count(kept.transactions, "n_transactions"), CUSTOMER, "left")


# --- cleaning and reports -----------------------------------------------------------------------


@query(f"SELECT {_plain(TRANSACTION)} FROM {{trx}}")
def drop_duplicates(t):
    return transactions(t)


@query("""
SELECT 'Transaction Data' AS table_name, b AS rows_before, a AS rows_after, b - a AS rows_dropped,
       round(100.0 * (b - a) / b, 2) AS percentage_dropped
FROM (SELECT count(*) AS b FROM {raw_transaction}), (SELECT count(*) AS a FROM {trx})""")
def duplicate_report(t):
    return clean.duplicate_report(t.raw_transaction, "Transaction Data")


@query(f"SELECT {ID}, PROVINCE, OCCUPATION, GENDER FROM {{raw_demographics}}")
def translate_columns(t):
    original = t.raw_demographics.select(
        CUSTOMER, F.col("PROVINCE").alias("TINH"), F.col("OCCUPATION").alias("NGHE_NGHIEP"), "GENDER"
    )
    return clean.translate_columns(original, t.mapping_data_translation)


@query(f"""
SELECT {_plain([c for c in DEMOGRAPHICS if c not in ('GENDER', 'CIF_CREATE')])}, CIF_CREATE,
       CASE GENDER WHEN 'NAM' THEN 'MALE' WHEN 'NU' THEN 'FEMALE' ELSE GENDER END AS GENDER FROM {{raw_demographics}}""")
def translate_values(t):
    return clean.translate_values(t.raw_demographics, t.mapping_data_translation)


@query(_missing("{raw_demographics}", DEMOGRAPHICS))
def missing_report(t):
    return profile.missing_report(t.raw_demographics)


@query(f"""
SELECT 'created_churn_flag_data' AS file_name, churn_flag, {_human("n")} AS abbrCount,
       concat(CAST(round(n * 100.0 / sum(n) OVER (), 1) AS DOUBLE), ' %') AS percentage, n AS "actualCount"
FROM (SELECT churn_flag, count(*) AS n FROM {{label}} GROUP BY churn_flag)""")
def flag_distribution(t):
    return profile.flag_distribution(churn.churn_label(whole_panel(t)), TARGET, "created_churn_flag_data")


@query(_join([f"""
SELECT 'scored' AS file_name, '{c}' AS flag, CAST({c} AS VARCHAR) AS value, {_human("n")} AS abbrCount,
       concat(CAST(round(n * 100.0 / sum(n) OVER (), 1) AS DOUBLE), ' %') AS percentage, n AS "actualCount"
FROM (SELECT {c}, count(*) AS n FROM {{scored}} GROUP BY {c})""" for c in (TARGET, PREDICTED)], " UNION ALL "))
def stage_report(t):
    return profile.stage_report(t.scored, "scored")["flags"]


@query(f"SELECT l_orderkey * l_partkey AS n, {_human('(l_orderkey * l_partkey)')} AS short FROM lineitem")
def human_format_numbers(t):
    product = F.col("l_orderkey") * F.col("l_partkey")
    return t.lineitem.select(product.alias("n"), human_format(product).alias("short"))


@query(f"""
SELECT 'raw_transaction' AS file_name, {len(TRANSACTION)} AS "TotalColumns", {_human("n")} AS "TotalRowsAbbr",
       n AS "TotalRows", '{", ".join(TRANSACTION)}' AS "ColumnNames", {_human("c")} AS "NumofCustomersAbbr",
       c AS "NumofCustomers" FROM (SELECT count(*) AS n, count(DISTINCT {ID}) AS c FROM {{raw_transaction}})""")
def table_profile(t):
    return profile.table_profile(t.raw_transaction, "raw_transaction")


@query("SELECT HASHED_CIF AS HASHED_CIF, GENDER AS GENDER_CODE, AVG_INCOME::DOUBLE AS AVG_INCOME_VND_ FROM {raw_demographics}")
def sanitize_columns(t):
    odd = t.raw_demographics.select(
        CUSTOMER, F.col("GENDER").alias("GENDER CODE"), F.col("AVG_INCOME").alias("AVG_INCOME(VND)")
    )
    return clean.sanitize_columns(odd)


@query(f"SELECT {_plain(ACCOUNT[:2])}, STATUS_DESCRIPTION FROM {{raw_account}}")
def keep_columns(t):
    projected = clean.keep_columns(t.raw_account, [CUSTOMER, "HASHED_AC", "STATUS_DESCRIPTION", "STATUS_ID"])
    return clean.drop_present(projected, ["STATUS_ID", "not there"])


@query(f"SELECT {_plain(ACCOUNT)} FROM {{events}}")
def parse_dates(t):
    return accounts.clean_account_events(t.raw_account)


@query(f"SELECT {ID}, coalesce(CUS_AGE, 0) AS CUS_AGE, PROVINCE FROM {{raw_demographics}}")
def zero_fill(t):
    return clean.zero_fill(t.raw_demographics.select(CUSTOMER, "CUS_AGE", "PROVINCE"))


@query("SELECT DISTINCT YEAR, MONTH FROM {raw_transaction}")
def distinct_values(t):
    return profile.distinct_values(t.raw_transaction, ["YEAR", "MONTH"])


@query(f"""
SELECT count(*) AS n_rows, count(DISTINCT {ID}) AS n_HASHED_CIF, count(DISTINCT HASHED_AC) AS n_HASHED_AC FROM {{raw_transaction}}""")
def distinct_counts(t):
    return profile.distinct_counts(t.raw_transaction, [CUSTOMER, "HASHED_AC"])


# --- sampling -----------------------------------------------------------------------------------


@query(f"SELECT {ID} FROM {{chosen}}")
def sample_customers(t):
    return sample.sample_customers(t.raw_transaction, SAMPLE, SEED)


@query(f"SELECT {_plain(TRANSACTION)} FROM {{raw_transaction}} WHERE {ID} IN (SELECT {ID} FROM {{chosen}})")
def restrict_to_sample(t):
    chosen = sample.sample_customers(t.raw_transaction, SAMPLE, SEED)
    return sample.restrict_to_sample({"trx": t.raw_transaction}, chosen)["trx"]


# --- demographics -------------------------------------------------------------------------------


@query(f"SELECT {ID}, PROVINCE, PROVINCE_REGION FROM {{grouped}}")
def bin_by_mapping(t):
    df = t.raw_demographics.select(CUSTOMER, "PROVINCE")
    return demographics.bin_by_mapping(df, t.mapping_data_region, "PROVINCE_REGION", "PROVINCE")


@query(f"SELECT {_plain(DEMOGRAPHICS + GROUPS)} FROM {{grouped}}")
def group_demographics(t):
    return grouped_demographics(t)


def _groups(name, column):
    @query(f"SELECT {ID}, {column} FROM {{grouped}}")
    def group(t):
        return grouped_demographics(t).select(CUSTOMER, column)

    _QUERIES[name], _SQL[name] = _QUERIES.pop("group"), _SQL.pop("group")


for _name, _column in (
    ("age_group", "AGE_GROUP"), ("marital_group", "MARITAL_GROUP"), ("country_group", "COUNTRY_GROUP"),
):
    _groups(_name, _column)


def _index_sql(c):
    return (f"(SELECT v, row_number() OVER (ORDER BY n DESC, v) - 1 AS i FROM "
            f"(SELECT {c} AS v, count(*) AS n FROM {{grouped}} GROUP BY {c})) x_{c}")


INDEXED = ["CUSTOMER_SEGMENT", "GENDER", "AGE_GROUP"]


@query(f"SELECT g.{ID}, {_join(f'CAST(x_{c}.i AS DOUBLE) AS {c}_index' for c in INDEXED)} FROM {{grouped}} g "
       + _join([f"JOIN {_index_sql(c)} ON x_{c}.v = g.{c}" for c in INDEXED], " "))
def category_index(t):
    df = grouped_demographics(t).select(CUSTOMER, *INDEXED)
    return demographics.category_index(df, INDEXED).drop(*INDEXED)


ENCODED = {
    "GENDER": ["NAM", "NU"], "MARITAL_GROUP": ["MARRIED", "OTHER", "SINGLE"],
    "AGE_GROUP": ["Others", "boomers", "genX", "genZ", "millennials"],
}


@query(f"SELECT {ID}, " + _join(
    f"CASE WHEN {c} = '{v}' THEN 1 ELSE 0 END AS \"{c}_{v}\"" for c, vs in ENCODED.items() for v in vs
) + " FROM {grouped}")
def one_hot_columns(t):
    df = grouped_demographics(t).select(CUSTOMER, *ENCODED)
    return demographics.fit_one_hot(df, list(ENCODED)).transform(df).drop(*ENCODED)


@query(f"SELECT g.{ID}, CAST(CAST(x_AGE_GROUP.i = 0 AS INT) AS DOUBLE) AS most_frequent, CAST(1 AS DOUBLE) AS total FROM {{grouped}} g "
       f"JOIN {_index_sql('AGE_GROUP')} ON x_AGE_GROUP.v = g.AGE_GROUP")
def one_hot_vectors(t):
    from pyspark.ml.functions import vector_to_array

    df = grouped_demographics(t).select(CUSTOMER, "AGE_GROUP")
    encoded = demographics.fit_category_vectors(df, ["AGE_GROUP"]).transform(df)
    values = vector_to_array("AGE_GROUP_encoded")
    total = F.aggregate(values, F.lit(0.0), lambda a, b: a + b)
    return encoded.select(CUSTOMER, values[0].alias("most_frequent"), total.alias("total"))


# --- accounts -----------------------------------------------------------------------------------


def _account_step(step, table, columns):
    @query(f"SELECT {_plain(columns)} FROM {{{table}}}")
    def account_step(t):
        return accounts.account_steps(accounts.clean_account_events(t.raw_account))[step]

    _QUERIES[f"account_{step}"] = _QUERIES.pop("account_step")
    _SQL[f"account_{step}"] = _SQL.pop("account_step")


ACCOUNT_STEPS = {
    "input": ("events", ACCOUNT), "status_before_creation": ("after_creation", ACCOUNT),
    "several_creation_dates": ("one_creation", ACCOUNT), "shared_accounts": ("unshared", ACCOUNT),
    "several_products": ("one_product", ACCOUNT), "one_row_per_account": ("by_account", DATES),
    "active_after_closed": ("in_order", DATES), "active_filled": ("activated", DATES),
}
for _step, (_table, _columns) in ACCOUNT_STEPS.items():
    if _step != "input":
        _account_step(_step, _table, _columns)


@query("SELECT * FROM {held}")
def accounts_per_customer(t):
    return accounts.transform_accounts(accounts.clean_account_events(t.raw_account))


@query(
    "SELECT step_no, step, n_rows, n_customers, n_accounts, "
    + _join(f"coalesce(lag({c}) OVER (ORDER BY step_no) - {c}, 0) AS {c}_dropped"
            for c in ("n_rows", "n_customers", "n_accounts"))
    + " FROM (" + _join([
        f"SELECT {i} AS step_no, '{step}' AS step, count(*) AS n_rows, count(DISTINCT {ID}) AS n_customers, "
        f"count(DISTINCT HASHED_AC) AS n_accounts FROM {{{table}}}"
        for i, (step, (table, _)) in enumerate(ACCOUNT_STEPS.items())], " UNION ALL ") + ")")
def account_audit(t):
    return accounts.account_audit(accounts.clean_account_events(t.raw_account))


# --- panel --------------------------------------------------------------------------------------


@query(f"SELECT {_plain(TRANSACTION)} FROM {{kept}}")
def keep_currency_rows(t):
    return panel.keep_currency(transactions(t), "VND")


@query(f"SELECT {_plain(TRANSACTION)} FROM {{trx}} WHERE {ID} NOT IN (SELECT {ID} FROM {{trx}} WHERE CCY <> 'VND')")
def keep_currency_customers(t):
    return panel.keep_currency(transactions(t), "VND", mode="customers")


@query(f"SELECT count(DISTINCT {ID}) AS customers_with_other_currency FROM {{raw_transaction}} WHERE CCY <> 'VND'")
def other_currency_report(t):
    return panel.other_currency_report(t.raw_transaction, "VND")


@query(f"SELECT {_plain(MONTHLY)} FROM {{monthly}}")
def rollup_monthly(t):
    return panel.rollup_monthly(panel.keep_currency(transactions(t), "VND"))


@query(f"SELECT {ID}, YEAR, MONTH, CAST(date AS VARCHAR) AS date FROM {{monthly}}")
def add_month_date(t):
    monthly = panel.rollup_monthly(panel.keep_currency(transactions(t), "VND"))
    return panel.add_month_date(monthly).select(CUSTOMER, "YEAR", "MONTH", "date")


@query("SELECT CAST(min(date) AS VARCHAR) AS min_date, CAST(max(date) AS VARCHAR) AS max_date FROM {monthly}")
def date_range(t):
    return panel.date_range(panel.keep_currency(transactions(t), "VND"))


@query(f"SELECT {_plain([*MONTHLY, 'date', 'CIF_CREATE'])}, new_customer_flag FROM {{flagged}}")
def new_customer_flag(t):
    return flagged(t)


GRID = [*MONTHLY, "date", "CIF_CREATE", "new_customer_flag", "cif_missing_flag"]


@query(f"SELECT {_plain(GRID)} FROM {{grid}}")
def fill_month_gaps(t):
    return panel.fill_month_gaps(flagged(t), bounds(t))


@query(f"SELECT {_plain(GRID)} FROM {{carried}}")
def carry_balance_forward(t):
    return panel.carry_balance_forward(panel.fill_month_gaps(flagged(t), bounds(t)))


@query(f"SELECT {_plain(GRID)} FROM {{existing}}")
def drop_months_before_creation(t):
    filled = panel.fill_month_gaps(flagged(t), bounds(t), carry=[BALANCE])
    return panel.drop_months_before_creation(filled)


@query(f"SELECT {_plain(MONTHLY)}, new_customer_flag, cif_missing_flag FROM {{panel}}")
def finish_panel(t):
    filled = panel.fill_month_gaps(flagged(t), bounds(t), carry=[BALANCE])
    return panel.finish_panel(panel.drop_months_before_creation(filled))


@query(f"SELECT {_plain([*MONTHLY, 'date'])}, new_customer_flag, cif_missing_flag FROM {{panel}}")
def monthly_panel(t):
    return whole_panel(t)


@query("SELECT * FROM {label}")
def churn_label(t):
    return churn.churn_label(whole_panel(t))


@query("SELECT * REPLACE (CASE WHEN NO_TRANSATION_n1m_n2m IS NOT NULL THEN churn_flag END AS churn_flag) FROM {label}")
def churn_label_complete(t):
    return churn.churn_label(whole_panel(t), incomplete="null")


@query("SELECT YEAR, MONTH, count(*) AS n_customers, CAST(sum(churn_flag) AS BIGINT) AS n_churned FROM {label} GROUP BY YEAR, MONTH")
def churn_by_month(t):
    return churn.churn_by_month(churn.churn_label(whole_panel(t)))


@query("SELECT HASHED_CIF, YEAR, MONTH, churn_flag FROM {label_w}")
def apply_per_group(t):
    def label(months):
        months = months.sort_values(["YEAR", "MONTH"])
        count = months["NO_TRANSATION"]
        quiet = count.shift(-1) + count.shift(-2) == 0
        return months.assign(churn_flag=quiet.astype("int32"))[[CUSTOMER, "YEAR", "MONTH", TARGET]]

    rows = window_panel(t).select(CUSTOMER, "YEAR", "MONTH", "NO_TRANSATION")
    schema = f"{CUSTOMER} string, YEAR int, MONTH int, {TARGET} int"
    return grouped.apply_per_group(rows, [CUSTOMER], label, schema)


# --- trailing features and merges ---------------------------------------------------------------


def _aggregates(c):
    kind = "BIGINT" if c in COUNTS or c == "No_of_Accounts" else "DOUBLE"
    return _join([
        *[f"CAST({f}({c}) AS {kind}) AS {c}_{f}" for f in ("sum", "max", "min")],
        f"round(avg(CAST({c} AS DOUBLE)), {ROUND}) AS {c}_mean",
        f"round(stddev_samp(CAST({c} AS DOUBLE)), {ROUND}) AS {c}_std",
    ])


LONG_SQL = (f"SELECT {ID}, months, {_join(_aggregates(c) for c in trailing.TRAILING_COLUMNS)} "
            f"FROM {{recent_w}} GROUP BY {ID}, months")
MEASURED = ("_mean", "_std")


@query(LONG_SQL)
def trailing_long(t):
    long = trailing.trailing_long(window_panel(t), YEAR, MONTH, HISTORY)
    return rounded(long, [c for c in long.columns if c.endswith(MEASURED)])


WIDE_SQL = f"SELECT {ID}, " + _join(
    f"max({c}_{a}) FILTER (WHERE months = {i}) AS {c}_l{i}m_{a}"
    for i in range(1, HISTORY + 1) for c in trailing.TRAILING_COLUMNS for a in trailing.AGGREGATES
) + f" FROM ({LONG_SQL}) GROUP BY {ID}"


@query(WIDE_SQL)
def trailing_features(t):
    wide = trailing.trailing_features(window_panel(t), YEAR, MONTH, HISTORY)
    return wide.select(CUSTOMER, *[
        F.round(c, ROUND).alias(c) if c.endswith(MEASURED) else F.col(c) for c in wide.columns[1:]
    ])


@query(f"SELECT {_plain(PANEL)}, No_of_Acc_Held FROM {{panel_w}} JOIN {{held}} USING ({ID})")
def merge_account_counts(t):
    held = accounts.transform_accounts(accounts.clean_account_events(t.raw_account))
    return churn.with_account_counts(window_panel(t).drop("date"), held)


@query(f"SELECT p.YEAR, p.MONTH, p.{ID}, PROVINCE, AGE_GROUP, BRANCH_ID "
       f"FROM {{panel_w}} p LEFT JOIN {{grouped}} g ON g.{ID} = p.{ID}")
def merge_demographics(t):
    joined = churn.with_demographics(window_panel(t), grouped_demographics(t))
    return joined.select("YEAR", "MONTH", CUSTOMER, "PROVINCE", "AGE_GROUP", "BRANCH_ID")


@query(f"SELECT {_plain(PANEL)} FROM {{panel_w}} WHERE YEAR = {YEAR} AND MONTH = {MONTH}")
def observed_month(t):
    return churn.observed(window_panel(t).drop("date"), YEAR, MONTH)


@query(f"SELECT {_plain(MERGED)} FROM {{merged_w}}")
def merge_tables(t):
    return merged(t)


@query(f"SELECT m.*, w.* EXCLUDE ({ID}) FROM (SELECT {_plain(MERGED)} FROM {{merged_w}}) m LEFT JOIN ("
       f"SELECT {ID}, " + _join(
           f"max({c}_{a}) FILTER (WHERE months = {i}) AS {c}_l{i}m_{a}"
           for i in range(1, HISTORY + 1) for c in trailing.TRAILING_COLUMNS for a in trailing.AGGREGATES)
       + f" FROM ({LONG_SQL}) GROUP BY {ID}) w ON w.{ID} = m.{ID}")
def merge_trailing(t):
    months = materialise(window_panel(t), "panel")
    out = merged(t, trailing.trailing_features(months, YEAR, MONTH, HISTORY), months)
    return rounded(out, [c for c in out.columns if c.endswith(MEASURED)])


@query(f"SELECT {_plain(MERGED)}, churn_flag FROM {{labelled_w}}")
def merge_churn_label(t):
    return labelled(t)


# --- training-set preparation -------------------------------------------------------------------

_UNIT = f"CAST(concat('0x', substr(md5(concat('{SEED}', {ID})), 1, 8)) AS BIGINT) / 4294967296.0"


@query(f"SELECT {ID}, CASE WHEN {_UNIT} < {TEST_SIZE} THEN 'test' ELSE 'train' END AS part FROM {{labelled_w}}")
def split_by_hash(t):
    train, test = sample.split_by_hash(stored_labelled(t), TEST_SIZE, SEED)
    parts = [df.select(CUSTOMER, F.lit(name).alias("part")) for name, df in (("train", train), ("test", test))]
    return parts[0].unionAll(parts[1])


FEATURES = [*PANEL_MEASURES, "new_customer_flag", "cif_missing_flag", "No_of_Acc_Held"]
# the steps after this one read the features as they are, not as they are printed
models.add_features(WIDE_SQL.replace(LONG_SQL, re.sub(rf"round\((\w+\(CAST\(\w+ AS DOUBLE\)\)), {ROUND}\)", r"\1", LONG_SQL)))
_TRAIN = f"FROM {{features_w}} WHERE {_UNIT} >= {TEST_SIZE}"
_FOREST = models.forest(f"SELECT {ID} AS id, {models.array([*FEATURES, *models.ENCODED])} AS x {_TRAIN}", SEED)


def training_part(t: Inputs) -> DataFrame:
    """The training part of the full feature table, all columns."""
    return sample.split_by_hash(features(t)[0], TEST_SIZE, SEED)[0]


@query(f"SELECT id AS {ID} FROM (SELECT id, score, max(score) FILTER (k = greatest(1, ceil((1.0::DOUBLE - 0.05::DOUBLE) * n))) OVER () AS cut "
       f"FROM (SELECT *, row_number() OVER (ORDER BY score) AS k, count(*) OVER () AS n FROM ({_FOREST}))) WHERE score <= cut")
def remove_outliers(t):
    return outliers.remove_outliers(training_part(t), 0.05, seed=SEED).select(CUSTOMER)


@query(f"SELECT id AS {ID}, round(score, 6) AS score FROM ({_FOREST})")
def outlier_scores(t):
    table = training_part(t)
    names = outliers.examined_columns(table)
    return outliers.outlier_scores(table, names, seed=SEED).select(CUSTOMER, F.round("outlier_score", 6).alias("score"))


CORRELATED = [*PANEL_MEASURES, "No_of_Acc_Held", "churn_flag"]


@query(_join([
    f"SELECT '{a}' AS feature_1, '{b}' AS feature_2, round(corr(CAST({a} AS DOUBLE), CAST({b} AS DOUBLE)), {ROUND}) AS r "
    "FROM {labelled_w}" for i, a in enumerate(CORRELATED) for b in CORRELATED[i + 1:]], " UNION ALL "))
def correlations(t):
    return rounded(prepare.correlations(stored_labelled(t), CORRELATED), ["r"])


_ALL_FEATURES = [*FEATURES, *models.ENCODED, *models.TRAILING]


@query("SELECT column_name, kept FROM (" + models.elimination(
    f"SELECT {ID} AS id, {models.array([*_ALL_FEATURES, 'churn_flag'])} AS x {_TRAIN}", _ALL_FEATURES, 0.9,
    {ID: True, "YEAR": False, "MONTH": False, "CIF_CREATE": False, "churn_flag": True}) + ")")
def select_uncorrelated(t):
    """Each column of the full feature table, and whether it stays, as the training part decides."""
    table = training_part(t)
    return _kept(table, prepare.select_uncorrelated(table, 0.9))


def _kept(table, names):
    """One row per column of the schema."""
    rows = [(c, c in set(names)) for c in table.columns]
    return table.sparkSession.createDataFrame(rows, "column_name string, kept boolean")


@query()
def feature_importances(t):
    return rounded(prepare.feature_importances(fresh_train(t), seed=SEED), ["Value"])


@query()
def select_important(t):
    train = fresh_train(t)
    return _kept(train, prepare.select_important(train, 0.0, 0.5, seed=SEED))


def _scaled(c):
    x = f"CAST({c} AS DOUBLE)"
    train = f"FILTER (WHERE {_UNIT} >= {TEST_SIZE})"
    return (f"round(coalesce(({x} - avg({x}) {train} OVER ()) / nullif(stddev_samp({x}) {train} OVER (), 0), 0), "
            f"{ROUND}) AS {c}")


@query(f"SELECT * FROM (SELECT {ID}, churn_flag, {_join(_scaled(c) for c in FEATURES)} FROM {{labelled_w}})")
def standardise(t):
    table = stored_labelled(t).select(CUSTOMER, *FEATURES, TARGET)
    train, test = prepare.standardise(*sample.split_by_hash(table, TEST_SIZE, SEED))
    return rounded(train.unionByName(test), FEATURES)


@query(f"SELECT * FROM (SELECT {ID}, churn_flag, {_join(_scaled(c) for c in FEATURES)} FROM {{labelled_w}})")
def standardise_vectors(t):
    table = stored_labelled(t).select(CUSTOMER, *FEATURES, TARGET)
    train, _ = sample.split_by_hash(table, TEST_SIZE, SEED)
    model = prepare.fit_vector_scaling(train, FEATURES)
    scaled = prepare.scale_vectors(model, table, FEATURES)
    return scaled.select(
        CUSTOMER, TARGET,
        *[F.round(F.col("scaled_features")[i], ROUND).alias(c) for i, c in enumerate(FEATURES)],
    )


@query(f"SELECT {ID}, {_plain(MEASURES)}, churn_flag FROM {{labelled_w}}")
def split_ids(t):
    ids, features = prepare.split_ids(stored_labelled(t).select(CUSTOMER, *MEASURES, TARGET))
    return ids.join(features, CUSTOMER)


@query(f"SELECT {ID}, {_plain(MEASURES)}, churn_flag FROM {{labelled_w}}")
def split_ids_new_data(t):
    ids, features = prepare.split_ids_new_data(stored_labelled(t).select(CUSTOMER, *MEASURES, TARGET), monitoring=True)
    return ids.join(features, CUSTOMER)


# --- modelling ----------------------------------------------------------------------------------


def _prepared(t):
    """Both parts of the full feature table, nulls filled, scaled.

    They are not stored: filling and scaling are projections of the stored table, cheaper than writing its columns
    once more. Training stores its vectors itself.
    """
    table = features(t)[0].drop(*prepare.NOT_CORRELATED)
    table = prepare.fill_missing(table, prepare.feature_names(table))
    return prepare.standardise(*sample.split_by_hash(table, TEST_SIZE, SEED))


_trained: dict[tuple[str, str], tuple[training.TrainedModels, DataFrame, DataFrame]] = {}


def trained_models(t: Inputs) -> tuple[training.TrainedModels, DataFrame, DataFrame]:
    """All candidates, trained once per session and folder, with the sets they were trained for."""
    key = (t.spark.sparkContext.applicationId, t.folder)
    if key not in _trained:
        train, test = _prepared(t)
        _trained[key] = training.train_candidates(train, seed=SEED), train, test
    return _trained[key]


@query()
def train_candidates(t):
    return rounded(trained_models(t)[0].leaderboard, ["value"])


def _cut(df, threshold):
    return df.select(
        F.lit(f"cut_{int(threshold * 100)}").alias("model"), TARGET,
        (F.col("p1") >= threshold).cast("int").alias(PREDICTED),
    )


def _cut_board(t):
    parts = [
        evaluate.classification_metrics(_cut(t.scored, cut)).select(
            F.lit(f"cut_{int(cut * 100)}").alias("model"), F.col("metrics").alias("metric"),
            F.col("ndp_score").alias("value"))
        for cut in (0.25, 0.5, 0.75)
    ]
    return parts[0].unionAll(parts[1]).unionAll(parts[2])


@query("SELECT model, metrics AS metric, round(value, 6) AS value FROM {cut_scores} "
       "WHERE metrics = 'f1_score_macro' ORDER BY value DESC, model LIMIT 1")
def select_best(t):
    return rounded(training.select_best(_cut_board(t), "f1_score_macro", "accuracy"), ["value"], 6)


@query("SELECT model, metrics AS metric, round(value, 6) AS value FROM {cut_scores} WHERE model = 'cut_50'")
def metrics_of_run(t):
    pairs = F.map_from_entries(F.collect_list(F.struct("metric", "value")))  # six metrics per model
    runs = _cut_board(t).groupBy("model").agg(F.to_json(pairs).alias("metrics_json"))
    return rounded(training.metrics_of_run(runs, "cut_50"), ["value"], 6)


@query()
def score_train_and_test(t):
    trained, train, test = trained_models(t)
    model = trained.models[training.select_best(trained.leaderboard).first().model]
    scored = [training.score(model, df, trained.columns) for df in (train, test)]
    return rounded(scored[0].unionAll(scored[1]), ["0_predicted_proba", "1_predicted_proba"])


@query()
def score_with_stored_model(t):
    """The best model, saved and loaded, over the test set."""
    trained, _, test = trained_models(t)
    path = new_folder(t.spark, "model")
    tags = {"observation_year": str(YEAR), "observation_month_number": str(MONTH), "historical_months": str(HISTORY)}
    best = training.select_best(trained.leaderboard).first().model
    training.save_model(t.spark, trained.models[best], path, trained.columns, tags)
    model, columns, _ = training.load_model(t.spark, path)
    return rounded(training.score(model, test, columns), ["0_predicted_proba", "1_predicted_proba"])


def _stored_trees(t):
    """A stored model of boosted trees over the panel's features."""
    return materialise(t.spark.createDataFrame(models.stored_trees(), models.STORED_FIELDS), "trees")


@query(f"SELECT id AS {ID}, CAST(margin > 0 AS INT) AS churn_flag_predicted, round(1 / (1 + exp(-2 * margin)), 9) AS probability FROM ("
       + models.walked(f"SELECT {ID} AS id, {models.array(FEATURES)} AS x FROM {{labelled_w}}") + ")")
def score_stored_trees(t):
    """Every labelled customer by a stored model, its nodes walked in Spark SQL."""
    rows = stored_labelled(t).select(CUSTOMER, *FEATURES)
    scored = trees.total_value(rows, trees.numbers(FEATURES), _stored_trees(t), 3, "margin")
    return scored.select(CUSTOMER, (F.col("margin") > 0).cast("int").alias("churn_flag_predicted"),
                         F.round(trees.boosted_probability(F.col("margin")), 9).alias("probability"))


@query('SELECT "Feature", round("Value", 9) AS "Value" FROM (' + models.gains(FEATURES) + ')')
def stored_trees_importances(t):
    """Importances of the stored model, summed over its nodes; the names are columns of the labelled table."""
    names = [c for c in stored_labelled(t).columns if c in FEATURES]
    position = F.create_map(*[F.lit(x) for pair in enumerate(FEATURES) for x in pair if pair[1] in names])
    found = trees.importances(_stored_trees(t), level_trees=False)
    return found.select(position[F.col("feature")].alias("Feature"), F.round("value", 9).alias("Value"))


@query("SELECT * FROM {conf}")
def confusion_counts(t):
    return evaluate.confusion_counts(t.scored)


@query("SELECT metrics, round(ndp_score, 6) AS ndp_score FROM {scores}")
def classification_metrics(t):
    return rounded(evaluate.classification_metrics(t.scored), ["ndp_score"], 6)


@query("""
SELECT metrics, round(ndp_score, 6) AS ndp_score FROM (SELECT
  sum(fp * (tps - tp + tp / 2)) / (sum(tp) * sum(fp)) AS "areaUnderROC",
  sum(tp * (tps / (tps + fps) + coalesce((tps - tp) / nullif(tps - tp + fps - fp, 0), tps / (tps + fps))) / 2)
    / sum(tp) AS "areaUnderPR",
  sum(tp * tps / (tps + fps)) / sum(tp) AS average_precision FROM {curve})
UNPIVOT (ndp_score FOR metrics IN ("areaUnderROC", "areaUnderPR", average_precision))""")
def ranking_metrics(t):
    return rounded(evaluate.ranking_metrics(t.scored, score="p1"), ["ndp_score"], 6)


@query("""
SELECT metrics, round(ndp_score, 6) AS ndp_score, round(value, 6) AS original_model_score,
       round(ndp_score / nullif(value, 0) - 1, 6) AS "% diff"
FROM {scores} JOIN (SELECT * FROM {cut_scores} WHERE model = 'cut_50' AND metrics <> 'accuracy') USING (metrics)""")
def monitoring_table(t):
    original = _cut_board(t).filter("model = 'cut_50' AND metric <> 'accuracy'").select(
        F.col("metric").alias("metrics"), F.col("value").alias("original_model_score"))
    table = evaluate.monitoring_table(evaluate.classification_metrics(t.scored), original)
    return rounded(table, ["ndp_score", "original_model_score", "% diff"], 6)


@query()
def train_and_monitor(t):
    """Everything from raw tables to the monitoring of the next month, which knows the stored run alone."""
    table, encoder = features(t)
    sets = modelling.prepare_sets(table)
    trained, model, _, _ = modelling.train_and_score(sets)
    path = new_folder(t.spark, "run")
    best = training.select_best(trained.leaderboard).first().model
    modelling.save_run(t.spark, path, model, best, sets, encoder, trained.leaderboard)
    later = training_set.Observation(YEAR, MONTH + 1, HISTORY, new_data=True, monitoring=True)
    new, _ = training_set.feature_table(tables(t), later, modelling.load_run(t.spark, path).encoder)
    scored = materialise(monitoring.score_new_data(path, new, monitoring=True), "scored")
    return rounded(monitoring.monitor(scored, path), ["ndp_score", "original_model_score", "% diff"])


def queries():
    return dict(_QUERIES)


def oracle_sql():
    return dict(_SQL)
