"""Bank-style input tables as views over the test tables.

Each view is one SQL text that Spark and DuckDB both understand; names in braces are the tables
and views it reads. All orders, lines and customers take part; conditions on keys put in what the
operators are there to find: copies, nulls, other currencies, contradicting and missing dates.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

from ebbtide.session import bounded_partitions, new_folder

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "documents", "labels"]

_MONTH_NAME = "substr('JanFebMarAprMayJunJulAugSepOctNovDec', CAST((month({0}) - 1) * 3 + 1 AS INT), 3)"


def _day_month_year(date: str) -> str:
    return (
        f"concat(lpad(CAST(day({date}) AS STRING), 2, '0'), '-', {_MONTH_NAME.format(date)}, '-', "
        f"lpad(CAST(year({date}) % 100 AS STRING), 2, '0'))"
    )


def _count(condition: str, name: str) -> str:
    return f"CAST(sum(CASE WHEN {condition} THEN 1 ELSE 0 END) AS BIGINT) AS {name}"


def _amount(condition: str, name: str) -> str:
    price = "CAST(l_extendedprice AS DECIMAL(18,2))"
    return f"CAST(sum(CASE WHEN {condition} THEN {price} ELSE 0 END) AS DECIMAL(18,2)) AS {name}"


_BY_LINE = ["NO_ATM", "NO_SMB", "NO_FUND_TRANSFER", "NO_DEPOSIT", "NO_WITHDRAW", "NO_INTEREST_PAYMENT", "NO_FEE_TRANSACTION"]

_AMOUNTS = ["AMT_CREDIT", "AMT_DEBIT", "AMOUNT_TRANSACTION", "AMOUNT_TRANSACTION_AUTO"]

_ACCOUNT_KEY = "CAST(k AS STRING) AS HASHED_CIF, concat(CAST(k AS STRING), '-', CAST(a AS STRING)) AS HASHED_AC"

VIEWS = {
    "raw_transaction_clean": f"""
SELECT CAST(year(o_orderdate) AS INT) AS YEAR, CAST(month(o_orderdate) AS INT) AS MONTH,
       CAST(floor((day(o_orderdate) - 1) / 7.0) + 1 AS INT) AS WEEK,
       CAST(o_custkey AS STRING) AS HASHED_CIF,
       concat(CAST(o_custkey AS STRING), '-', CAST(l_suppkey % 3 AS STRING)) AS HASHED_AC,
       CAST(count(*) AS BIGINT) AS NO_TRANSATION,
       {_count("l_returnflag = 'R'", "NO_CREDIT")},
       {_count("l_returnflag <> 'R'", "NO_DEBIT")},
       {", ".join(_count(f"l_linenumber = {i}", name) for i, name in enumerate(_BY_LINE, 1))},
       {_count("l_linestatus = 'F'", "NO_TRANSATION_AUTO")},
       CASE WHEN l_suppkey % 20 = 0 THEN 'USD' ELSE 'VND' END AS CCY,
       CAST(max(c_acctbal) AS DECIMAL(18,2)) AS PRE_CLS_BAL,
       {_amount("l_returnflag = 'R'", "AMT_CREDIT")},
       {_amount("l_returnflag <> 'R'", "AMT_DEBIT")},
       {_amount("true", "AMOUNT_TRANSACTION")},
       {_amount("l_linestatus = 'F'", "AMOUNT_TRANSACTION_AUTO")}
FROM {{lineitem}} JOIN {{orders}} ON l_orderkey = o_orderkey JOIN {{customer}} ON o_custkey = c_custkey
GROUP BY 1, 2, 3, 4, 5, 17""",
    "raw_transaction": """
SELECT * FROM {raw_transaction_clean}
UNION ALL
SELECT * FROM {raw_transaction_clean} WHERE CAST(HASHED_CIF AS INT) % 50 = 0""",
    "first_order": """
SELECT o_custkey AS k, CAST(min(o_orderdate) AS DATE) AS d FROM {orders} GROUP BY o_custkey""",
    "raw_demographics": f"""
SELECT CAST(c_custkey AS STRING) AS HASHED_CIF, {_day_month_year("cd")} AS CIF_CREATE,
       CASE WHEN c_custkey % 31 = 0 THEN NULL ELSE n_name END AS PROVINCE,
       CASE WHEN c_custkey % 29 = 0 THEN NULL ELSE concat('JOB_', CAST(c_custkey % 12 AS STRING)) END AS OCCUPATION,
       CASE WHEN c_custkey % 37 = 0 THEN NULL ELSE CAST(1940 + c_custkey % 70 AS INT) END AS CUS_AGE,
       CASE c_custkey % 5 WHEN 0 THEN 'MARRIED' WHEN 1 THEN 'SINGLE' WHEN 2 THEN 'DIVORCED'
                          WHEN 3 THEN NULL ELSE 'MARRIED' END AS MARTIAL_STATUS,
       CASE WHEN c_custkey % 41 = 0 THEN NULL WHEN c_custkey % 10 = 0 THEN 'LAOS' ELSE 'VIETNAM' END AS COUNTRY,
       c_mktsegment AS CUSTOMER_SEGMENT,
       CASE WHEN c_custkey % 2 = 0 THEN 'NAM' ELSE 'NU' END AS GENDER,
       CAST(c_acctbal AS DECIMAL(18,2)) AS AVG_INCOME,
       CAST(c_nationkey AS INT) AS BRANCH_ID
FROM (SELECT c.*, n.n_name,
             CASE WHEN c.c_custkey % 4 = 0 AND f.d >= DATE '2000-01-01' THEN f.d
                  ELSE CAST('2000-01-01' AS DATE) + CAST(c.c_custkey % 500 AS INT) END AS cd
      FROM {{customer}} c JOIN {{nation}} n ON c.c_nationkey = n.n_nationkey
           LEFT JOIN {{first_order}} f ON f.k = c.c_custkey) t""",
    "acct": """
SELECT o_custkey AS k, CAST(l_suppkey % 3 AS INT) AS a, CAST(min(o_orderdate) AS DATE) + CAST(3620 AS INT) AS d0
FROM {orders} JOIN {lineitem} ON l_orderkey = o_orderkey GROUP BY 1, 2""",
    "raw_account": f"""
SELECT HASHED_CIF, HASHED_AC, {_day_month_year("ds")} AS DATE_OF_STATUS,
       STATUS_DESCRIPTION, CAST(ac AS STRING) AS AC_CREATE, STATUS_ID, PRODUCT_ID
FROM (
  SELECT {_ACCOUNT_KEY},
         CASE WHEN k % 97 = 0 THEN d0 + CAST(-3 AS INT) WHEN k % 73 = 0 THEN d0 + CAST(900 AS INT)
              ELSE d0 + CAST(2 AS INT) END AS ds,
         'Active' AS STATUS_DESCRIPTION, d0 AS ac, 1 AS STATUS_ID, CAST(a AS INT) AS PRODUCT_ID
  FROM {{acct}} WHERE k % 71 <> 0
  UNION ALL
  SELECT {_ACCOUNT_KEY}, d0 + CAST(600 AS INT), 'Closed', d0, 2, CAST(a AS INT)
  FROM {{acct}} WHERE k % 6 = 0 OR k % 71 = 0 OR k % 73 = 0
  UNION ALL
  SELECT {_ACCOUNT_KEY}, d0 + CAST(20 AS INT), 'Active', d0 + CAST(10 AS INT), 1, CAST(a AS INT)
  FROM {{acct}} WHERE k % 89 = 0
  UNION ALL
  SELECT CAST(k + 1 AS STRING), concat(CAST(k AS STRING), '-', CAST(a AS STRING)), d0 + CAST(2 AS INT), 'Active', d0, 1, CAST(a AS INT)
  FROM {{acct}} WHERE k % 83 = 0
  UNION ALL
  SELECT {_ACCOUNT_KEY}, d0 + CAST(2 AS INT), 'Active', d0, 1, CAST(a + 10 AS INT)
  FROM {{acct}} WHERE k % 79 = 0
) u""",
    "mapping_data_region": """
SELECT n_name AS ORIGINAL, r_name AS REVISED FROM {nation} JOIN {region} ON n_regionkey = r_regionkey
WHERE n_nationkey % 7 <> 6""",
    "mapping_data_occupation": """
SELECT concat('JOB_', CAST(r_regionkey AS STRING)) AS ORIGINAL,
       CASE WHEN r_regionkey % 2 = 0 THEN 'OFFICE' ELSE 'FIELD' END AS REVISED FROM {region}""",
    "mapping_data_translation": """
SELECT * FROM (VALUES ('NAM', 'MALE'), ('NU', 'FEMALE'), ('NGHE_NGHIEP', 'OCCUPATION'), ('TINH', 'PROVINCE')) AS t(VN, EN)""",
    "scored": """
SELECT CAST(d.doc_id AS BIGINT) AS id, l.quality AS churn_flag,
       CASE WHEN d.n_chars % 10 < 7 THEN l.quality ELSE 1 - l.quality END AS churn_flag_predicted,
       CAST((d.n_chars % 1000) / 1000.0 AS DOUBLE) AS p1
FROM {documents} d JOIN {labels} l ON d.doc_id = l.doc_id""",
}


def _cents(condition: str, name: str) -> str:
    return f"sum(CASE WHEN {condition} THEN cents ELSE 0 END) AS {name}"


# The same rows for Spark: amounts are added up as whole cents, which keeps the sums in 64-bit
# arithmetic, and become decimals once per group.
FOR_SPARK = {
    "raw_transaction_clean": f"""
SELECT YEAR, MONTH, WEEK, CAST(o_custkey AS STRING) AS HASHED_CIF,
       concat(CAST(o_custkey AS STRING), '-', CAST(a AS STRING)) AS HASHED_AC,
       NO_TRANSATION, NO_CREDIT, NO_DEBIT, {", ".join(_BY_LINE)}, NO_TRANSATION_AUTO, CCY,
       CAST(PRE_CLS_BAL AS DECIMAL(18,2)) AS PRE_CLS_BAL,
       {", ".join(f"CAST({c} * 0.01BD AS DECIMAL(18,2)) AS {c}" for c in _AMOUNTS)}
FROM (
  SELECT CAST(year(o_orderdate) AS INT) AS YEAR, CAST(month(o_orderdate) AS INT) AS MONTH,
         CAST((day(o_orderdate) - 1) DIV 7 AS INT) + 1 AS WEEK, o_custkey, l_suppkey % 3 AS a,
         CASE WHEN l_suppkey % 20 = 0 THEN 'USD' ELSE 'VND' END AS CCY, count(*) AS NO_TRANSATION,
         {_count("l_returnflag = 'R'", "NO_CREDIT")}, {_count("l_returnflag <> 'R'", "NO_DEBIT")},
         {", ".join(_count(f"l_linenumber = {i}", name) for i, name in enumerate(_BY_LINE, 1))},
         {_count("l_linestatus = 'F'", "NO_TRANSATION_AUTO")}, max(c_acctbal) AS PRE_CLS_BAL,
         {_cents("l_returnflag = 'R'", "AMT_CREDIT")}, {_cents("l_returnflag <> 'R'", "AMT_DEBIT")},
         sum(cents) AS AMOUNT_TRANSACTION, {_cents("l_linestatus = 'F'", "AMOUNT_TRANSACTION_AUTO")}
  FROM (SELECT *, CAST(round(l_extendedprice * 100) AS BIGINT) AS cents FROM {{lineitem}})
       JOIN {{orders}} ON l_orderkey = o_orderkey JOIN {{customer}} ON o_custkey = c_custkey
  GROUP BY 1, 2, 3, 4, 5, 6)""",
}


# The copies come from the rows themselves, so that lines are joined and added up once.
FOR_SPARK["raw_transaction"] = """
SELECT c.* FROM {raw_transaction_clean} c
LATERAL VIEW explode(CASE WHEN CAST(HASHED_CIF AS INT) % 50 = 0 THEN array(1, 2) ELSE array(1) END) copies AS nth"""


def reads(text: str) -> list[str]:
    """The tables and views named in a text."""
    return sorted(set(re.findall(r"\{(\w+)\}", text)))


# The tables a bank would hand over as files. They are written to the shared folder once per
# session and folder; queries then scan them, with columns pruned and filters pushed down.
STORED = [
    "raw_transaction", "raw_account", "raw_demographics",
    "mapping_data_region", "mapping_data_occupation", "mapping_data_translation",
]
_written: dict[tuple[str, str, str], str] = {}


class Inputs:
    """Test tables and views of one directory as DataFrames: ``Inputs(spark, d).raw_account``."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder
        bounded_partitions(spark)

    def __getattr__(self, name: str) -> DataFrame:
        if name in VIEWS:
            text = FOR_SPARK.get(name, VIEWS[name])
            key = (self.spark.sparkContext.applicationId, self.folder, name)
            if key not in _written:
                df = self.spark.sql(text, **{part: getattr(self, part) for part in reads(text)})
                if name in STORED:
                    _written[key] = new_folder(self.spark, name)
                    df.write.parquet(_written[key])
            if key in _written:
                df = self.spark.read.parquet(_written[key])
        elif name in TABLES:
            df = self.spark.read.parquet(f"{self.folder}/{name}.parquet")
        else:
            raise AttributeError(name)
        setattr(self, name, df)
        return df


