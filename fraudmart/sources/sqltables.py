"""The warehouse under names: catalog tables with column defaults, six views with
the instant as a session variable, and the rules as SQL table functions.

``create_all(spark, database)`` makes everything that is not there yet. Tables are
Parquet tables of the session's catalog; views and functions are temporary, so they
follow the session's variable and leave nothing behind::

    INSERT INTO bank.terminals (terminal_id, terminal_type, terminal_city, terminal_address) VALUES (...)
    SET VARIABLE fraud_as_of = TIMESTAMP_NTZ '2021-03-04 00:00:00'
    SELECT * FROM v_terminals
    SELECT * FROM fraud_passport(DATE '2021-03-04', TIMESTAMP_NTZ '2021-03-04 00:00:00')

The functions state the same rules as ``operators.rules``: neighbours per client (rule
3) or card (rule 4) by (time, id, city), inside buckets of twelve hours with the rows
near their edges as context, so a busy client spreads over its time span.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from fraudmart import schemas

#: Columns an INSERT may leave out.
DEFAULTS = {
    "cards": {"create_dt": "current_date()"},
    "accounts": {"create_dt": "current_date()"},
    "clients": {"create_dt": "current_date()"},
    "terminals": {"effective_from": "localtimestamp()", "effective_to": f"TIMESTAMP_NTZ '{schemas.OPEN_END}'", "deleted_flg": "0"},
    "passport_blacklist": {"effective_from": "localtimestamp()", "effective_to": f"TIMESTAMP_NTZ '{schemas.OPEN_END}'",
                           "deleted_flg": "0"},
}
PARTITIONED = {"reporting_list": "report_dt"}
TABLES = dict(schemas.WAREHOUSE_TABLES)
AS_OF = "fraud_as_of"
BUCKET = 43_200

_VALID = "deleted_flg = 0 AND {at} >= effective_from AND {at} < effective_to + INTERVAL 1 SECOND"
_NOW = f"coalesce({AS_OF}, localtimestamp())"
VIEWS = {
    "v_cards": "SELECT card_num, account FROM {db}.cards",
    "v_accounts": "SELECT account, valid_to, client FROM {db}.accounts",
    "v_clients": "SELECT client_id, last_name, first_name, patronymic, date_of_birth, passport_num, passport_valid_to, phone "
                 "FROM {db}.clients",
    "v_terminals": "SELECT terminal_id, terminal_type, terminal_city, terminal_address FROM {db}.terminals WHERE "
                   + _VALID.format(at=_NOW),
    "v_passport_blacklist": "SELECT passport_num, entry_dt FROM {db}.passport_blacklist WHERE " + _VALID.format(at=_NOW),
    "v_transactions": "SELECT trans_id, trans_date, card_num, oper_type, amt, oper_result, terminal FROM {db}.transactions",
}

_RETURNS = ("RETURNS TABLE (event_dt TIMESTAMP_NTZ, passport STRING, fio STRING, phone STRING, event_type STRING, "
            "report_dt DATE) RETURN ")
_CHAIN = """chain AS (
  SELECT t.*, c.client_id, c.passport_num, c.passport_valid_to, a.valid_to, c.phone,
         concat(c.last_name, ' ', c.first_name, ' ', c.patronymic) AS fio, unix_timestamp(t.trans_date) AS sec
  FROM {db}.transactions t JOIN {db}.cards k ON k.card_num = t.card_num JOIN {db}.accounts a ON a.account = k.account
  JOIN {db}.clients c ON c.client_id = a.client)"""
_LOCATED = _CHAIN + """,
located AS (
  SELECT ch.*, te.terminal_city AS city FROM chain ch JOIN {db}.terminals te ON te.terminal_id = ch.terminal
  WHERE te.""" + _VALID.format(at="p_as_of") + """)"""
_EVENT = "SELECT {ts} AS event_dt, passport_num AS passport, fio, phone, '{event}' AS event_type, p_report_dt AS report_dt FROM {src}"


def _event(event: str, src: str, where: str) -> str:
    return _EVENT.format(ts="trans_date", event=event, src=src) + f" WHERE {where}"


def _near(filter_: str, before: int, after: int) -> str:
    """``located`` rows in their own bucket (``native``) and as context in the next ones."""
    return f"""placed AS (
  SELECT *, bucket = floor(sec / {BUCKET}) AS native FROM (
    SELECT *, explode(sequence(floor((sec - {after}) / {BUCKET}), floor((sec + {before}) / {BUCKET}))) AS bucket
    FROM located WHERE {filter_} AND sec IS NOT NULL))"""


_LAGS = ", ".join(f"lag(oper_result, {k}) OVER w AS r{k}, lag(amt, {k}) OVER w AS a{k}" for k in range(1, 4))
FUNCTIONS = {
    "fraud_passport(p_report_dt DATE, p_as_of TIMESTAMP_NTZ)":
        "WITH " + _CHAIN + ", listed AS (SELECT passport_num AS listed_num, entry_dt FROM {db}.passport_blacklist WHERE "
        + _VALID.format(at="p_as_of") + ") "
        + _event(schemas.EVENT_PASSPORT, "chain LEFT JOIN listed ON listed_num = passport_num",
                 "oper_result = 'SUCCESS' AND (entry_dt <= trans_date OR passport_valid_to <= trans_date)"),
    "fraud_contract(p_report_dt DATE)":
        "WITH " + _CHAIN + " " + _event(schemas.EVENT_CONTRACT, "chain", "oper_result = 'SUCCESS' AND valid_to <= trans_date"),
    "fraud_city_hop(p_report_dt DATE, p_as_of TIMESTAMP_NTZ)":
        "WITH " + _LOCATED + ", " + _near("oper_result = 'SUCCESS'", schemas.CITY_HOP_SECONDS, schemas.CITY_HOP_SECONDS) + """,
near AS (
  SELECT *, lag(city) OVER w AS p_city, lag(sec) OVER w AS p_sec, lead(city) OVER w AS n_city, lead(sec) OVER w AS n_sec
  FROM placed WINDOW w AS (PARTITION BY client_id, bucket ORDER BY trans_date, trans_id, city)) """
        + _event(schemas.EVENT_CITY_HOP, "near",
                 f"native AND ((city <> p_city AND sec - p_sec <= {schemas.CITY_HOP_SECONDS}) "
                 f"OR (city <> n_city AND n_sec - sec <= {schemas.CITY_HOP_SECONDS}))"),
    "fraud_amount_guess(p_report_dt DATE, p_as_of TIMESTAMP_NTZ)":
        "WITH " + _LOCATED + ", " + _near("oper_type IN ('WITHDRAW', 'PAYMENT')", schemas.AMOUNT_GUESS_SECONDS, 0) + f""",
near AS (
  SELECT *, {_LAGS}, lag(sec, 3) OVER w AS first_sec
  FROM placed WINDOW w AS (PARTITION BY client_id, card_num, bucket ORDER BY trans_date, trans_id, city)) """
        + _event(schemas.EVENT_AMOUNT_GUESS, "near",
                 "native AND oper_result = 'SUCCESS' AND r1 = 'REJECT' AND r2 = 'REJECT' AND r3 = 'REJECT' "
                 f"AND amt < a1 AND a1 < a2 AND a2 < a3 AND sec - first_sec <= {schemas.AMOUNT_GUESS_SECONDS}"),
}


def create_tables(spark: SparkSession, database: str, location: str | None = None) -> None:
    """CREATE IF NOT EXISTS: the database and its seven tables with their defaults."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}" + (f" LOCATION '{location}'" if location else ""))
    for name, schema in TABLES.items():
        columns = []
        for f in schema.fields:
            default = DEFAULTS.get(name, {}).get(f.name)
            columns.append(f"{f.name} {f.dataType.simpleString()}" + (f" DEFAULT {default}" if default else ""))
        by = f" PARTITIONED BY ({PARTITIONED[name]})" if name in PARTITIONED else ""
        spark.sql(f"CREATE TABLE IF NOT EXISTS {database}.{name} ({', '.join(columns)}) USING parquet{by}")


def create_views(spark: SparkSession, database: str) -> None:
    """The six views; the instant of the validity-dated ones is the session variable
    ``fraud_as_of``; it starts as null, which stands for the present."""
    spark.sql(f"DECLARE OR REPLACE VARIABLE {AS_OF} TIMESTAMP_NTZ DEFAULT NULL")
    for name, body in VIEWS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY VIEW {name} AS {body.format(db=database)}")


def create_functions(spark: SparkSession, database: str) -> None:
    for head, body in FUNCTIONS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {head} {_RETURNS}{body.format(db=database)}")


def create_all(spark: SparkSession, database: str, location: str | None = None) -> None:
    create_tables(spark, database, location)
    create_views(spark, database)
    create_functions(spark, database)


def insert(spark: SparkSession, database: str, table: str, rows: DataFrame, columns: list[str] | None = None) -> None:
    """INSERT INTO the table; columns that are left out take their defaults."""
    names = columns or rows.columns
    view = f"_insert_{table}"
    rows.createOrReplaceTempView(view)
    spark.sql(f"INSERT INTO {database}.{table} ({', '.join(names)}) SELECT {', '.join(names)} FROM {view}")
    spark.catalog.dropTempView(view)
