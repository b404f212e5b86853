"""Cleaning of string columns, on dirt made from the tables' own columns."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.functions.text import WHITESPACE
from millrace.operators.clean import clean, cleaning_stats
from millrace.queries import Query, table

DIRTY_NAME = "'  ' || c_name || chr(9) || chr(160)"
DIRTY_SEGMENT = (
    "CASE WHEN c_custkey % 9 = 0 THEN ' null ' WHEN c_custkey % 9 = 1 THEN 'N/A' WHEN c_custkey % 9 = 2 THEN 'Null'"
    " WHEN c_custkey % 9 = 3 THEN '   ' WHEN c_custkey % 9 = 4 THEN 'undefined' ELSE c_mktsegment || ' ' END"
)
EMAIL = (
    "CASE WHEN c_custkey % 5 = 0 THEN c_name WHEN c_custkey % 5 = 1 THEN ' User.' || CAST(c_custkey AS STRING) || '@Example.COM '"
    " WHEN c_custkey % 5 = 2 THEN 'a b@x.org' WHEN c_custkey % 5 = 3 THEN ''"
    " ELSE lower(c_mktsegment) || '+' || CAST(c_custkey AS STRING) || '@mail.example.org' END"
)
PHONE = (
    "CASE WHEN c_custkey % 5 = 0 THEN '+1 (' || CAST(200 + c_custkey % 700 AS STRING) || ') 555-01' || CAST(c_custkey % 90 + 10 AS STRING)"
    " WHEN c_custkey % 5 = 1 THEN '0' || CAST(c_custkey AS STRING) WHEN c_custkey % 5 = 2 THEN 'none'"
    " WHEN c_custkey % 5 = 3 THEN ' n/a ' ELSE '49.' || CAST(c_custkey AS STRING) || '.7' END"
)
_TOKENS = "('', 'null', 'NULL', 'None', 'N/A', 'n/a', 'undefined', 'UNDEFINED')"
_EMAIL_OK = "^[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+[.][a-zA-Z]{2,}$"
_PHONE_OK = "^[+]?[1-9][0-9]{0,15}$"


def _sql_strip(expr: str) -> str:
    chars = " || ".join(f"chr({ord(c)})" for c in WHITESPACE)
    return f"trim({expr}, {chars})"


def _sql_null(expr: str) -> str:
    return f"CASE WHEN {expr} NOT IN {_TOKENS} THEN {expr} END"


def customers(spark, folder):
    return table(spark, folder, "customer").select(
        "c_custkey",
        F.expr(DIRTY_NAME).alias("c_name"),
        F.expr(DIRTY_SEGMENT).alias("segment"),
        F.expr(EMAIL).alias("email"),
        F.expr(PHONE).alias("phone"),
    )


_CUSTOMERS = f"""WITH d AS (SELECT c_custkey, {_sql_strip(DIRTY_NAME)} AS c_name, {DIRTY_NAME} AS raw_name,
  {_sql_strip(DIRTY_SEGMENT)} AS segment, {DIRTY_SEGMENT} AS raw_segment,
  {_sql_strip(EMAIL)} AS email, {EMAIL} AS raw_email, {_sql_strip(PHONE)} AS phone, {PHONE} AS raw_phone FROM customer)
"""
_CLEAN_EMAIL = f"CASE WHEN regexp_matches(lower(email), '{_EMAIL_OK}') THEN lower(email) ELSE email END"
_DIGITS = "regexp_replace(phone, '[^0-9+]', '', 'g')"
_CLEAN_PHONE = f"CASE WHEN regexp_matches({_DIGITS}, '{_PHONE_OK}') THEN {_DIGITS} ELSE phone END"


def clean_trim_nulls(spark, folder):
    return clean(customers(spark, folder).select("c_custkey", "c_name", "segment"))


def clean_email(spark, folder):
    return clean(customers(spark, folder).select("c_custkey", "email"), validate_emails=True)


def clean_phone(spark, folder):
    return clean(customers(spark, folder).select("c_custkey", "phone"), clean_phone_numbers=True)


def clean_all_rules(spark, folder):
    return clean(customers(spark, folder), validate_emails=True, clean_phone_numbers=True)


def clean_keep_empty(spark, folder):
    df = customers(spark, folder).select("c_custkey", "segment", "email")
    return clean(df, standardize_nulls=False, remove_empty_strings=False)


def clean_own_tokens(spark, folder):
    df = customers(spark, folder).select("c_custkey", "segment")
    return clean(df, null_values=["BUILDING", "Null"])


def clean_own_pattern(spark, folder):
    df = customers(spark, folder).select("c_custkey", F.col("c_name").alias("label"), F.col("phone").alias("line"))
    return clean(df, clean_phone_numbers=True, phone_columns=["line"], validation_rules={"phone": r"\d{3,}"})


def clean_without_pattern(spark, folder):
    df = customers(spark, folder).select("c_custkey", "email", "phone")
    return clean(df, validate_emails=True, clean_phone_numbers=True, validation_rules={})


def clean_no_trim(spark, folder):
    return clean(customers(spark, folder).select("c_custkey", "segment"), trim_whitespace=False)


def clean_documents(spark, folder):
    padded = F.concat(F.lit("\u2003"), "text", F.lit("\x85 "))
    return clean(table(spark, folder, "documents").select("doc_id", padded.alias("text"), "lang"))


def clean_conversations(spark, folder):
    return clean(table(spark, folder, "conversations"))


def cleaning_counts(spark, folder):
    df = customers(spark, folder)
    return cleaning_stats(df, validate_emails=True, clean_phone_numbers=True)


QUERIES = {
    "clean_trim_nulls": Query(
        clean_trim_nulls,
        _CUSTOMERS + f"SELECT c_custkey, {_sql_null('c_name')} AS c_name, {_sql_null('segment')} AS segment FROM d",
    ),
    "clean_email": Query(
        clean_email, _CUSTOMERS + f"SELECT c_custkey, CASE WHEN email NOT IN {_TOKENS} THEN {_CLEAN_EMAIL} END AS email FROM d"
    ),
    "clean_phone": Query(
        clean_phone, _CUSTOMERS + f"SELECT c_custkey, CASE WHEN phone NOT IN {_TOKENS} THEN {_CLEAN_PHONE} END AS phone FROM d"
    ),
    "clean_all_rules": Query(
        clean_all_rules,
        _CUSTOMERS
        + f"""SELECT c_custkey, {_sql_null("c_name")} AS c_name, {_sql_null("segment")} AS segment,
        CASE WHEN email NOT IN {_TOKENS} THEN {_CLEAN_EMAIL} END AS email,
        CASE WHEN phone NOT IN {_TOKENS} THEN {_CLEAN_PHONE} END AS phone FROM d""",
    ),
    "clean_keep_empty": Query(clean_keep_empty, _CUSTOMERS + "SELECT c_custkey, segment, email FROM d"),
    "clean_own_tokens": Query(
        clean_own_tokens,
        _CUSTOMERS
        + "SELECT c_custkey, CASE WHEN segment NOT IN ('BUILDING', 'Null', '') THEN segment END AS segment FROM d",
    ),
    "clean_own_pattern": Query(
        clean_own_pattern,
        _CUSTOMERS
        + f"""SELECT c_custkey, {_sql_null("c_name")} AS label, CASE WHEN phone NOT IN {_TOKENS} THEN
        CASE WHEN regexp_matches({_DIGITS}, '^[0-9]{{3,}}') THEN {_DIGITS} ELSE phone END END AS line FROM d""",
    ),
    "clean_without_pattern": Query(
        clean_without_pattern,
        _CUSTOMERS
        + f"""SELECT c_custkey, CASE WHEN email NOT IN {_TOKENS} THEN lower(email) END AS email,
        CASE WHEN phone NOT IN {_TOKENS} THEN nullif({_DIGITS}, '') END AS phone FROM d""",
    ),
    "clean_no_trim": Query(
        clean_no_trim,
        _CUSTOMERS + f"SELECT c_custkey, {_sql_null('raw_segment')} AS segment FROM d",
    ),
    "clean_documents": Query(
        clean_documents,
        f"""WITH d AS (SELECT doc_id, {_sql_strip("text")} AS text, lang FROM documents)
        SELECT doc_id, {_sql_null("text")} AS text, {_sql_null("lang")} AS lang FROM d""",
    ),
    "clean_conversations": Query(
        clean_conversations,
        f"""WITH d AS (SELECT conv_id, turn, {_sql_strip("role")} AS role, {_sql_strip("text")} AS text FROM conversations)
        SELECT conv_id, turn, {_sql_null("role")} AS role, {_sql_null("text")} AS text FROM d""",
    ),
    "cleaning_stats": Query(
        cleaning_counts,
        _CUSTOMERS
        + f"""SELECT count(*) AS records_processed,
        CAST(sum(CAST(c_name <> raw_name AS INT) + CAST(segment <> raw_segment AS INT) + CAST(email <> raw_email AS INT)
          + CAST(phone <> raw_phone AS INT)) AS BIGINT) AS fields_trimmed,
        CAST(sum(CAST(c_name IN {_TOKENS} AS INT) + CAST(segment IN {_TOKENS} AS INT) + CAST(email IN {_TOKENS} AS INT)
          + CAST(phone IN {_TOKENS} AS INT)) AS BIGINT) AS nulls_standardized,
        count(*) FILTER (email NOT IN {_TOKENS} AND regexp_matches(lower(email), '{_EMAIL_OK}')) AS emails_validated,
        count(*) FILTER (phone NOT IN {_TOKENS} AND regexp_matches({_DIGITS}, '{_PHONE_OK}')) AS phones_cleaned,
        count(*) FILTER (email NOT IN {_TOKENS} AND NOT regexp_matches(lower(email), '{_EMAIL_OK}'))
          + count(*) FILTER (phone NOT IN {_TOKENS} AND NOT regexp_matches({_DIGITS}, '{_PHONE_OK}')) AS validation_errors
        FROM d""",
    ),
}
