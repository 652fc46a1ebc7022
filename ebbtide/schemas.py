"""Key names, column lists and the declared types of the raw tables."""

from pyspark.sql import types as T

CUSTOMER = "HASHED_CIF"
ACCOUNT = "HASHED_AC"
TARGET = "churn_flag"
PREDICTED = "churn_flag_predicted"
PROBABILITY_0 = "0_predicted_proba"
PROBABILITY_1 = "1_predicted_proba"

# Column names of the raw tables, in table order.
TRANSACTION_COLUMNS = [
    "YEAR", "MONTH", "WEEK", "HASHED_CIF", "HASHED_AC",
    "NO_TRANSATION", "NO_CREDIT", "NO_DEBIT", "NO_ATM", "NO_SMB", "NO_FUND_TRANSFER",
    "NO_DEPOSIT", "NO_WITHDRAW", "NO_INTEREST_PAYMENT", "NO_FEE_TRANSACTION",
    "NO_TRANSATION_AUTO", "CCY", "PRE_CLS_BAL", "AMT_CREDIT", "AMT_DEBIT",
    "AMOUNT_TRANSACTION", "AMOUNT_TRANSACTION_AUTO",
]
ACCOUNT_COLUMNS = [
    "HASHED_CIF", "HASHED_AC", "DATE_OF_STATUS", "STATUS_DESCRIPTION", "AC_CREATE",
    "STATUS_ID", "PRODUCT_ID",
]

COUNTS = [name for name in TRANSACTION_COLUMNS if name.startswith("NO_")]
AMOUNTS = ["AMT_CREDIT", "AMT_DEBIT", "AMOUNT_TRANSACTION", "AMOUNT_TRANSACTION_AUTO"]
BALANCE = "PRE_CLS_BAL"
MEASURES = COUNTS + [BALANCE] + AMOUNTS
PANEL_MEASURES = MEASURES + ["No_of_Accounts"]

MONEY = T.DecimalType(18, 2)


def _field_type(name: str) -> T.DataType:
    if name in ("YEAR", "MONTH", "WEEK", "STATUS_ID", "PRODUCT_ID", "CUS_AGE", "BRANCH_ID"):
        return T.IntegerType()
    if name in COUNTS:
        return T.LongType()
    if name in (BALANCE, "AVG_INCOME", *AMOUNTS):
        return MONEY
    return T.StringType()


def _struct(names: list[str]) -> T.StructType:
    return T.StructType([T.StructField(name, _field_type(name)) for name in names])


RAW_TRANSACTION = _struct(TRANSACTION_COLUMNS)
RAW_ACCOUNT = _struct(ACCOUNT_COLUMNS)
RAW_DEMOGRAPHICS = _struct([
    "HASHED_CIF", "CIF_CREATE", "PROVINCE", "OCCUPATION", "CUS_AGE", "MARTIAL_STATUS",
    "COUNTRY", "CUSTOMER_SEGMENT", "GENDER", "AVG_INCOME", "BRANCH_ID",
])
