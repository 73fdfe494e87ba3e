"""Input layouts of the credit tables as CSV files, and their roles.

A layout line is "file column, type, role column". Types are those of a headered CSV where blanks mean NULL; whole
numbers that may be blank are read as double, as the files write them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from relfold.sources.roles import from_columns
from relfold.sources.tables import labelled_union, read_table

# fixed input formats
APPLICANT = """
SK_ID_CURR, bigint, entity_id
TARGET, int, label
AMT_INCOME_TOTAL, double, income
AMT_CREDIT, double, credit
AMT_ANNUITY, double, annuity
AMT_GOODS_PRICE, double, goods_price
CNT_CHILDREN, double, children
CNT_FAM_MEMBERS, double, family
DAYS_BIRTH, double, birth_day
DAYS_EMPLOYED, double, employed_day
DAYS_REGISTRATION, double, registration_day
DAYS_ID_PUBLISH, double, id_day
DAYS_LAST_PHONE_CHANGE, double, phone_day
OWN_CAR_AGE, double, car_age
EXT_SOURCE_1, double, score_1
EXT_SOURCE_2, double, score_2
EXT_SOURCE_3, double, score_3
BASEMENTAREA_AVG, double, basement_area
APARTMENTS_AVG, double, apartment_area
YEARS_BEGINEXPLUATATION_AVG, double, years_in_use
YEARS_BUILD_AVG, double, years_since_build
FLAG_MOBIL, int, flag_mobile
FLAG_EMP_PHONE, int, flag_work_phone
FLAG_WORK_PHONE, int, flag_second_work_phone
FLAG_CONT_MOBILE, int, flag_mobile_reachable
FLAG_PHONE, int, flag_phone
FLAG_EMAIL, int, flag_email
FLAG_OWN_CAR, string, owns_car
FLAG_OWN_REALTY, string, owns_home
CODE_GENDER, string, gender
ORGANIZATION_TYPE, string, employer
NAME_INCOME_TYPE, string, income_type
NAME_EDUCATION_TYPE, string, education
NAME_FAMILY_STATUS, string, family_status
NAME_HOUSING_TYPE, string, housing
"""
DOCUMENTS = [2, *range(4, 22)]
CREDIT = """
SK_ID_CURR, bigint, entity_id
SK_ID_BUREAU, bigint, contract_id
CREDIT_ACTIVE, string, status
CREDIT_TYPE, string, kind
DAYS_CREDIT, int, start_day
DAYS_CREDIT_ENDDATE, double, end_day
DAYS_ENDDATE_FACT, double, closed_day
DAYS_CREDIT_UPDATE, int, update_day
CREDIT_DAY_OVERDUE, int, overdue_days
CNT_CREDIT_PROLONG, int, prolonged
AMT_CREDIT_SUM, double, amount
AMT_CREDIT_SUM_DEBT, double, debt
AMT_CREDIT_SUM_LIMIT, double, credit_limit
AMT_CREDIT_SUM_OVERDUE, double, overdue
AMT_CREDIT_MAX_OVERDUE, double, max_overdue
AMT_ANNUITY, double, annuity
"""
CREDIT_MONTH = """
SK_ID_BUREAU, bigint, contract_id
MONTHS_BALANCE, int, month
STATUS, string, status
"""
SNAPSHOT = """
SK_ID_CURR, bigint, entity_id
SK_ID_PREV, bigint, loan_id
MONTHS_BALANCE, int, month
CNT_INSTALMENT, double, term
CNT_INSTALMENT_FUTURE, double, left_terms
SK_DPD, int, dpd
SK_DPD_DEF, int, dpd_tolerated
NAME_CONTRACT_STATUS, string, status
"""
APPLICATION = """
SK_ID_CURR, bigint, entity_id
SK_ID_PREV, bigint, loan_id
AMT_APPLICATION, double, requested
AMT_CREDIT, double, granted
AMT_DOWN_PAYMENT, double, down_payment
AMT_ANNUITY, double, annuity
AMT_GOODS_PRICE, double, goods_price
RATE_DOWN_PAYMENT, double, rate_down
RATE_INTEREST_PRIMARY, double, rate_primary
RATE_INTEREST_PRIVILEGED, double, rate_privileged
CNT_PAYMENT, double, payments
DAYS_DECISION, int, decision_day
DAYS_FIRST_DUE, double, first_due_day
DAYS_LAST_DUE, double, last_due_day
DAYS_LAST_DUE_1ST_VERSION, double, last_due_first_day
DAYS_TERMINATION, double, termination_day
HOUR_APPR_PROCESS_START, int, hour
SELLERPLACE_AREA, int, area
FLAG_LAST_APPL_PER_CONTRACT, string, last_in_contract
NFLAG_LAST_APPL_IN_DAY, int, last_in_day
NAME_YIELD_GROUP, string, yield_group
NAME_CONTRACT_STATUS, string, contract_status
NAME_CLIENT_TYPE, string, client_type
PRODUCT_COMBINATION, string, product
"""
CARD = """
SK_ID_CURR, bigint, entity_id
SK_ID_PREV, bigint, card_id
MONTHS_BALANCE, int, month
AMT_BALANCE, double, balance
AMT_CREDIT_LIMIT_ACTUAL, double, credit_limit
AMT_DRAWINGS_CURRENT, double, drawings
AMT_DRAWINGS_ATM_CURRENT, double, drawings_atm
AMT_DRAWINGS_POS_CURRENT, double, drawings_pos
AMT_DRAWINGS_OTHER_CURRENT, double, drawings_other
AMT_INST_MIN_REGULARITY, double, min_payment
AMT_PAYMENT_CURRENT, double, payment
AMT_PAYMENT_TOTAL_CURRENT, double, payment_total
AMT_RECEIVABLE_PRINCIPAL, double, principal
AMT_RECIVABLE, double, receivable
CNT_DRAWINGS_CURRENT, double, n_drawings
CNT_DRAWINGS_ATM_CURRENT, double, n_drawings_atm
CNT_DRAWINGS_POS_CURRENT, double, n_drawings_pos
CNT_DRAWINGS_OTHER_CURRENT, double, n_drawings_other
CNT_INSTALMENT_MATURE_CUM, double, matured
NAME_CONTRACT_STATUS, string, status
"""
INSTALMENT = """
SK_ID_CURR, bigint, entity_id
SK_ID_PREV, bigint, loan_id
NUM_INSTALMENT_VERSION, double, version
NUM_INSTALMENT_NUMBER, int, number
DAYS_INSTALMENT, double, due_day
DAYS_ENTRY_PAYMENT, double, paid_day
AMT_INSTALMENT, double, due_amount
AMT_PAYMENT, double, paid_amount
"""
# file: (role, layout)
FILES = {
    "bureau": ("credit", CREDIT), "bureau_balance": ("credit_month", CREDIT_MONTH), "POS_CASH_balance": ("snapshot", SNAPSHOT),
    "previous_application": ("application", APPLICATION), "credit_card_balance": ("card", CARD), "installments_payments": ("instalment", INSTALMENT),
}

# orders of the ordered features; the last columns only break ties
ORDERS = {
    "snapshot": ("month", "loan_id", "status", "term", "left_terms", "dpd"), "card": ("month", "card_id", "status", "balance", "payment"),
    "instalment": ("due_day", "loan_id", "number", "paid_day", "version", "paid_amount", "due_amount"),
}


def lines(layout: str) -> list[list[str]]:
    return [[part.strip() for part in line.split(",")] for line in layout.strip().splitlines()]


def applicant_layout() -> str:
    return APPLICANT + "\n".join(f"FLAG_DOCUMENT_{i}, int, doc_{i}" for i in DOCUMENTS)


def read_role(spark: SparkSession, path: str, layout: str) -> DataFrame:
    """A headered CSV file as a role table. Columns are matched by the header, so their order and others do not matter."""
    header = spark.read.option("header", True).csv(path).columns
    known = {c: t for c, t, _ in lines(layout)}
    schema = ", ".join(f"`{c}` {known.get(c, 'string')}" for c in header)
    return from_columns(read_table(spark, path, schema), {c: role for c, _, role in lines(layout) if c in header})


def read_roles(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """All role tables of a folder; training and test applicants are one table, the label of the latter is NULL."""
    train, test = (read_role(spark, f"{folder}/application_{part}.csv", applicant_layout()) for part in ("train", "test"))
    out = {"applicant": labelled_union(train, test.drop("label"))}
    for name, (role, layout) in FILES.items():
        out[role] = read_role(spark, f"{folder}/{name}.csv", layout)
    out["application"] = out["application"].withColumn("last_in_day", F.col("last_in_day").cast("bigint"))
    return out
