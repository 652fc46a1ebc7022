"""DuckDB texts, one per query, over the test tables and the views of ``fixtures``.

Written from the operators' definitions, in plain joins and windows over whole tables, and not
from the way the Spark code goes about it.
"""

from __future__ import annotations

import re

from ebbtide.operators.trailing import TRAILING_COLUMNS
from ebbtide.schemas import COUNTS, MEASURES, PANEL_MEASURES

from .fixtures import VIEWS, reads

YEAR, MONTH, HISTORY = 2001, 5, 6
ID = "HASHED_CIF"


def _join(parts, separator=", "):
    return separator.join(parts)


def _plain(columns):
    """Amounts as doubles, counts as bigint, the rest as it is."""
    out = []
    for c in columns:
        if c in COUNTS or c == "No_of_Accounts":
            out.append(f"CAST({c} AS BIGINT) AS {c}")
        elif c in MEASURES or c == "AVG_INCOME":
            out.append(f"CAST({c} AS DOUBLE) AS {c}")
        elif c in ("date", "CIF_CREATE", "DATE_OF_STATUS", "AC_CREATE", "Active", "Closed"):
            out.append(f"CAST(CAST({c} AS DATE) AS VARCHAR) AS {c}")
        else:
            out.append(c)
    return _join(out)


TRANSACTION = ["YEAR", "MONTH", "WEEK", ID, "HASHED_AC", *COUNTS, "CCY", "PRE_CLS_BAL",
               "AMT_CREDIT", "AMT_DEBIT", "AMOUNT_TRANSACTION", "AMOUNT_TRANSACTION_AUTO"]
ACCOUNT = [ID, "HASHED_AC", "DATE_OF_STATUS", "STATUS_DESCRIPTION", "AC_CREATE", "STATUS_ID", "PRODUCT_ID"]
DATES = [ID, "HASHED_AC", "AC_CREATE", "PRODUCT_ID", "Active", "Closed"]
DEMOGRAPHICS = [ID, "CIF_CREATE", "PROVINCE", "OCCUPATION", "CUS_AGE", "MARTIAL_STATUS", "COUNTRY",
                "CUSTOMER_SEGMENT", "GENDER", "AVG_INCOME", "BRANCH_ID"]
GROUPS = ["PROVINCE_REGION", "OCCUPATION_GROUP", "AGE_GROUP", "MARITAL_GROUP", "COUNTRY_GROUP"]
MONTHLY = ["YEAR", "MONTH", ID, *PANEL_MEASURES]


def _human(n):
    """Three significant digits of a whole number, half to even, with a suffix."""
    digits = f"length(CAST({n} AS VARCHAR))"
    step = f"CASE WHEN {digits} > 3 THEN pow(10, {digits} - 3) ELSE 1 END"
    rounded = f"(round_even({n} / ({step}), 0) * ({step}))"
    power = f"CASE WHEN {rounded} >= 1e9 THEN 3 WHEN {rounded} >= 1e6 THEN 2 WHEN {rounded} >= 1e3 THEN 1 ELSE 0 END"
    shown = f"regexp_replace(printf('%.6f', {rounded} / pow(1000, {power})), '\\.?0+$', '')"
    return f"concat({shown}, CASE {power} WHEN 3 THEN 'B' WHEN 2 THEN 'M' WHEN 1 THEN 'K' ELSE '' END)"


def _missing(table, columns):
    union = _join([
        f"SELECT '{c}' AS column_name, CAST(sum(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS missing_value,"
        f" count(*) AS n FROM {table}" for c in columns], " UNION ALL ")
    return (
        "SELECT column_name, missing_value, round(missing_value * 100.0 / n, 2) AS percentage_missing"
        f" FROM ({union}) WHERE missing_value > 0")


# Intermediate results that several texts build on.
STEPS = {
    # transactions
    "trx": "SELECT DISTINCT * FROM {raw_transaction}",
    "kept": "SELECT * FROM {trx} WHERE CCY = 'VND'",
    "monthly": f"""
SELECT YEAR, MONTH, {ID}, {_join(f"sum({c}) AS {c}" for c in MEASURES)},
       count(DISTINCT HASHED_AC) AS No_of_Accounts, make_date(YEAR, MONTH, 1) AS date
FROM {{kept}} GROUP BY YEAR, MONTH, {ID}""",
    "demo": f"""
SELECT DISTINCT * REPLACE (CAST(strptime(CIF_CREATE, '%d-%b-%y') AS DATE) AS CIF_CREATE) FROM {{raw_demographics}}""",
    "flagged": f"""
SELECT m.*, d.CIF_CREATE, CAST(CAST(date_trunc('month', d.CIF_CREATE) AS DATE) = m.date AS INT) AS new_customer_flag
FROM {{monthly}} m LEFT JOIN {{demo}} d ON m.{ID} = d.{ID}""",
    "all_months": """
SELECT CAST(unnest(generate_series(lo, hi, INTERVAL 1 MONTH)) AS DATE) AS date
FROM (SELECT min(date) AS lo, max(date) AS hi FROM {monthly})""",
    "grid": f"""
SELECT CAST(year(m.date) AS INT) AS YEAR, CAST(month(m.date) AS INT) AS MONTH, c.{ID}, c.CIF_CREATE, m.date,
       {_join(f"f.{c}" for c in PANEL_MEASURES)}, f.new_customer_flag,
       CASE WHEN f.date IS NULL THEN 1 ELSE 0 END AS cif_missing_flag
FROM (SELECT DISTINCT {ID}, CIF_CREATE FROM {{flagged}}) c CROSS JOIN {{all_months}} m
     LEFT JOIN {{flagged}} f ON f.{ID} = c.{ID} AND f.date = m.date""",
    "carried": f"""
SELECT * REPLACE (last_value(PRE_CLS_BAL IGNORE NULLS) OVER
  (PARTITION BY {ID} ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS PRE_CLS_BAL) FROM {{grid}}""",
    "existing": """
SELECT * FROM {carried} WHERE NOT coalesce(cif_missing_flag = 1 AND date < date_trunc('month', CIF_CREATE), false)""",
    "panel": f"""
SELECT YEAR, MONTH, {ID}, date, {_join(f"coalesce({c}, 0) AS {c}" for c in PANEL_MEASURES)},
       coalesce(new_customer_flag, 0) AS new_customer_flag, cif_missing_flag FROM {{existing}}""",
    "label": f"""
SELECT {ID}, YEAR, MONTH, CAST(n1 AS BIGINT) AS NO_TRANSATION_n1m, CAST(n2 AS BIGINT) AS NO_TRANSATION_n2m,
       CAST(n1 + n2 AS BIGINT) AS NO_TRANSATION_n1m_n2m, CASE WHEN n1 + n2 = 0 THEN 1 ELSE 0 END AS churn_flag
FROM (SELECT {ID}, YEAR, MONTH, lead(NO_TRANSATION, 1) OVER w AS n1, lead(NO_TRANSATION, 2) OVER w AS n2
      FROM {{panel}} WINDOW w AS (PARTITION BY {ID} ORDER BY YEAR, MONTH))""",
    # accounts
    "events": f"""
SELECT DISTINCT * REPLACE (CAST(strptime(DATE_OF_STATUS, '%d-%b-%y') AS DATE) AS DATE_OF_STATUS,
                           CAST(AC_CREATE AS DATE) AS AC_CREATE) FROM {{raw_account}}""",
    "after_creation": "SELECT * FROM {events} WHERE DATE_OF_STATUS >= AC_CREATE",
    "one_creation": f"""
SELECT {_join(ACCOUNT)} FROM (SELECT *, row_number() OVER (
  PARTITION BY {ID}, HASHED_AC, STATUS_DESCRIPTION, STATUS_ID, PRODUCT_ID ORDER BY AC_CREATE, DATE_OF_STATUS) AS rn
FROM {{after_creation}}) WHERE rn = 1""",
    "shared": f"SELECT HASHED_AC FROM {{one_creation}} GROUP BY HASHED_AC HAVING count(DISTINCT {ID}) > 1",
    "unshared": f"""
SELECT * FROM {{one_creation}} o WHERE NOT EXISTS (SELECT 1 FROM {{shared}} s WHERE s.HASHED_AC = o.HASHED_AC)
  AND NOT EXISTS (SELECT 1 FROM {{one_creation}} p JOIN {{shared}} s ON s.HASHED_AC = p.HASHED_AC WHERE p.{ID} = o.{ID})""",
    "one_product": f"""
SELECT {_join(ACCOUNT)} FROM (SELECT *, row_number() OVER (
  PARTITION BY {ID}, HASHED_AC, STATUS_DESCRIPTION, DATE_OF_STATUS ORDER BY AC_CREATE, PRODUCT_ID, STATUS_ID) AS rn
FROM {{unshared}}) WHERE rn = 1""",
    "by_account": f"""
SELECT {ID}, HASHED_AC, min(AC_CREATE) AS AC_CREATE, min(PRODUCT_ID) AS PRODUCT_ID,
       min(DATE_OF_STATUS) FILTER (WHERE STATUS_DESCRIPTION = 'Active') AS Active,
       min(DATE_OF_STATUS) FILTER (WHERE STATUS_DESCRIPTION = 'Closed') AS Closed
FROM {{one_product}} GROUP BY {ID}, HASHED_AC""",
    "in_order": "SELECT * FROM {by_account} WHERE NOT coalesce(Active > Closed, false)",
    "activated": "SELECT * REPLACE (coalesce(Active, AC_CREATE + 1) AS Active) FROM {in_order}",
    "held": f"""
SELECT {ID}, count(HASHED_AC) AS No_of_Acc_Held, count(PRODUCT_ID) AS num_of_PRODUCT_ID,
       count(AC_CREATE) AS num_of_AC_CREATE, count(Active) AS num_of_Active, count(Closed) AS num_of_Closed
FROM {{activated}} GROUP BY {ID}""",
    # demographics
    "grouped": f"""
SELECT d.* REPLACE (coalesce(PROVINCE, 'UNDEFINED') AS PROVINCE, coalesce(OCCUPATION, 'UNDEFINED') AS OCCUPATION),
       coalesce(r.REVISED, 'UNDEFINED') AS PROVINCE_REGION, coalesce(o.REVISED, 'UNDEFINED') AS OCCUPATION_GROUP,
       CASE WHEN CUS_AGE BETWEEN 1946 AND 1964 THEN 'boomers' WHEN CUS_AGE BETWEEN 1965 AND 1980 THEN 'genX'
            WHEN CUS_AGE BETWEEN 1981 AND 1996 THEN 'millennials' WHEN CUS_AGE BETWEEN 1997 AND 2005 THEN 'genZ'
            ELSE 'Others' END AS AGE_GROUP,
       CASE WHEN MARTIAL_STATUS IN ('MARRIED', 'SINGLE') THEN MARTIAL_STATUS ELSE 'OTHER' END AS MARITAL_GROUP,
       CASE WHEN COUNTRY = 'VIETNAM' THEN 'VIETNAM' ELSE 'OTHER' END AS COUNTRY_GROUP
FROM {{demo}} d LEFT JOIN {{mapping_data_region}} r ON d.PROVINCE = r.ORIGINAL
     LEFT JOIN {{mapping_data_occupation}} o ON d.OCCUPATION = o.ORIGINAL""",
    # trailing features and merges
    "recent": f"""
SELECT p.*, CAST(i.i AS INT) AS months FROM {{panel}} p JOIN (SELECT unnest(range(1, {HISTORY + 1})) AS i) i
  ON {YEAR * 12 + MONTH} - (YEAR * 12 + MONTH) BETWEEN 0 AND i.i - 1""",
    "merged": f"""
SELECT p.*, h.No_of_Acc_Held, g.* EXCLUDE ({ID}, AVG_INCOME)
FROM {{panel}} p JOIN {{held}} h ON h.{ID} = p.{ID} LEFT JOIN {{grouped}} g ON g.{ID} = p.{ID}
WHERE p.YEAR = {YEAR} AND p.MONTH = {MONTH}""",
    "labelled": f"""
SELECT m.*, l.churn_flag FROM {{merged}} m LEFT JOIN {{label}} l ON l.{ID} = m.{ID} AND l.YEAR = m.YEAR AND l.MONTH = m.MONTH""",
    "digest": f"SELECT DISTINCT {ID}, md5(concat('42', {ID})) AS h FROM {{trx}}",
    "chosen": f"SELECT {ID} FROM {{digest}} ORDER BY h, {ID} LIMIT 500",
    # predictions
    "conf": "SELECT churn_flag AS label, churn_flag_predicted AS prediction, count(*) AS n FROM {scored} GROUP BY 1, 2",
    "per_class": """
SELECT c, sum(n) FILTER (WHERE label = c) AS actual, sum(n) FILTER (WHERE prediction = c) AS predicted,
       coalesce(sum(n) FILTER (WHERE label = c AND prediction = c), 0) AS hits
FROM {conf}, (SELECT unnest([0, 1]) AS c) GROUP BY c""",
    "scores": """
SELECT metrics, ndp_score FROM (
  SELECT sum(hits) / sum(actual) AS accuracy, avg(2 * hits / (actual + predicted)) AS f1_score_macro,
         sum(2 * hits / (actual + predicted) * actual) / sum(actual) AS f1_score_weighted,
         (avg(hits / actual) - 0.5) / 0.5 AS norm_macro_recall, avg(hits / predicted) AS precision_score_macro,
         avg(hits / actual) AS recall_score_macro FROM {per_class}) UNPIVOT (ndp_score FOR metrics IN
  (accuracy, f1_score_macro, f1_score_weighted, norm_macro_recall, precision_score_macro, recall_score_macro))""",
    "curve": """
SELECT p1, sum(tp) OVER w AS tps, sum(fp) OVER w AS fps, tp, fp FROM (
  SELECT p1, sum(churn_flag) AS tp, sum(1 - churn_flag) AS fp FROM {scored} GROUP BY p1)
WINDOW w AS (ORDER BY p1 DESC)""",
    "cut": """
SELECT 'cut_' || CAST(CAST(t * 100 AS INT) AS VARCHAR) AS model, churn_flag AS y, CAST(p1 >= t AS INT) AS yhat
FROM {scored}, (SELECT unnest([0.25, 0.5, 0.75]) AS t)""",
    "cut_class": """
SELECT model, c, count(*) FILTER (WHERE y = c) AS actual, count(*) FILTER (WHERE yhat = c) AS predicted,
       count(*) FILTER (WHERE y = c AND yhat = c) AS hits
FROM {cut}, (SELECT unnest([0, 1]) AS c) GROUP BY model, c""",
    "cut_scores": """
SELECT model, metrics, value FROM (
  SELECT model, sum(hits) / sum(actual) AS accuracy, avg(2 * hits / (actual + predicted)) AS f1_score_macro,
         sum(2 * hits / (actual + predicted) * actual) / sum(actual) AS f1_score_weighted,
         (avg(hits / actual) - 0.5) / 0.5 AS norm_macro_recall, avg(hits / predicted) AS precision_score_macro,
         avg(hits / actual) AS recall_score_macro FROM {cut_class} GROUP BY model) UNPIVOT (value FOR metrics IN
  (accuracy, f1_score_macro, f1_score_weighted, norm_macro_recall, precision_score_macro, recall_score_macro))""",
}

# The same chain over the months around one observation: names end in ``_w``.
_CHAIN = ["kept", "monthly", "flagged", "all_months", "grid", "carried", "existing", "panel", "label",
          "recent", "merged", "labelled"]
_FIRST, _LAST = YEAR * 12 + MONTH - HISTORY + 1, YEAR * 12 + MONTH + 2
for _name in _CHAIN:
    _text = re.sub(r"\{(\w+)\}", lambda m: "{" + m[1] + ("_w" if m[1] in _CHAIN else "") + "}", STEPS[_name])
    if _name == "kept":
        _text += f" AND YEAR * 12 + MONTH BETWEEN {_FIRST} AND {_LAST}"
    STEPS[f"{_name}_w"] = _text


def with_steps(text: str) -> str:
    """Put the views and steps a text reads in front of it, as common table expressions in order."""
    everything = {**VIEWS, **STEPS}
    needed: set[str] = set()

    def collect(part: str) -> None:
        for name in reads(part):
            if name in everything and name not in needed:
                needed.add(name)
                collect(everything[name])

    collect(text)
    ctes = ",\n".join(f"{name} AS ({everything[name]})" for name in everything if name in needed)
    return re.sub(r"\{(\w+)\}", r"\1", (f"WITH {ctes}\n" if ctes else "") + text)
