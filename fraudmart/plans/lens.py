"""Binding of the shared test tables to the warehouse model.

The shared parquet tables are a generic star schema; this view makes
customers look like clients (two accounts, one card each), suppliers like
terminals and events like card transactions, with integer arithmetic only so
that Spark and the DuckDB oracle agree. All work grows with the tables: the
dimensions are derived row by row, the fact is ``events``.
"""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fraudmart import schemas
from fraudmart.functions import ts_lit
from fraudmart.warehouse import Warehouse

# --- fixed values of the binding (shared with the oracle SQL) ---
AS_OF = "2024-01-03 12:00:00"
REPORT_DT = "2024-02-01"
EPOCH_START = "2024-01-01 00:00:00"
# --- end of fixed values ---


_DEFINED: dict[tuple, DataFrame] = {}


def _once(fn):
    """Define a binding table once per session and folder, as one would
    register a view: later calls reuse the same (lazy) DataFrame, so file
    listing, schema reads and analysis are not repeated. No data is cached."""
    @functools.wraps(fn)
    def wrapper(spark: SparkSession, sf_dir: str):
        key = (spark.sparkContext.applicationId, id(spark), sf_dir.rstrip("/"), fn.__name__)
        if key not in _DEFINED:
            _DEFINED[key] = fn(spark, sf_dir)
        return _DEFINED[key]
    return wrapper


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return _table(spark, f"{sf_dir.rstrip('/')}/{name}.parquet")


def _table(spark: SparkSession, path: str) -> DataFrame:
    key = (spark.sparkContext.applicationId, id(spark), path, "parquet")
    if key not in _DEFINED:
        _DEFINED[key] = spark.read.parquet(path)
    return _DEFINED[key]


def _str(c: str | Column) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("string")


def _day(base: str, offset: Column) -> Column:
    return F.date_add(F.lit(base).cast("date"), offset.cast("int"))


def _two_accounts(customer: DataFrame) -> DataFrame:
    # Generator, not a join: each customer row becomes two rows.
    return customer.select("c_custkey", F.explode(F.array(F.lit(0), F.lit(1))).alias("a"))


@_once
def clients(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = _read(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_mktsegment", "c_nationkey")
    n = _read(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    k = F.col("c_custkey")
    return (c.join(n, c["c_nationkey"] == n["n_nationkey"])
             .select(_str(k).alias("client_id"),
                     F.col("c_name").alias("last_name"),
                     F.col("c_mktsegment").alias("first_name"),
                     F.col("n_name").alias("patronymic"),
                     F.lit(None).cast("date").alias("date_of_birth"),
                     F.concat(F.lit("P"), _str(k)).alias("passport_num"),
                     F.when(k % 5 < 2, F.lit(None).cast("date"))
                      .otherwise(_day("2023-12-25", k % 60)).alias("passport_valid_to"),
                     F.concat(F.lit("+7 "), _str(k)).alias("phone"),
                     F.lit(None).cast("date").alias("create_dt"),
                     F.lit(None).cast("date").alias("update_dt")))


@_once
def accounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = _two_accounts(_read(spark, sf_dir, "customer"))
    k, a = F.col("c_custkey"), F.col("a")
    return c.select(F.concat(F.lit("A"), _str(k), F.lit("-"), _str(a)).alias("account"),
                    _day("2023-12-20", (k + 35 * a) % 70).alias("valid_to"),
                    _str(k).alias("client"),
                    F.lit(None).cast("date").alias("create_dt"),
                    F.lit(None).cast("date").alias("update_dt"))


@_once
def cards(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = _two_accounts(_read(spark, sf_dir, "customer"))
    k, a = F.col("c_custkey"), F.col("a")
    return c.select(F.concat(F.lit("C"), _str(k), F.lit("-"), _str(a)).alias("card_num"),
                    F.concat(F.lit("A"), _str(k), F.lit("-"), _str(a)).alias("account"),
                    F.lit(None).cast("date").alias("create_dt"),
                    F.lit(None).cast("date").alias("update_dt"))


def _suppliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = _read(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_nationkey")
    n = _read(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    return s.join(n, s["s_nationkey"] == n["n_nationkey"])


@_once
def terminals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Current terminals, stored as open history rows."""
    s = _suppliers(spark, sf_dir)
    k = F.col("s_suppkey")
    return s.select(_str(k).alias("terminal_id"),
                    F.when(k % 2 == 0, "ATM").otherwise("POS").alias("terminal_type"),
                    F.col("n_name").alias("terminal_city"),
                    F.col("s_name").alias("terminal_address"),
                    ts_lit(EPOCH_START).alias("effective_from"),
                    ts_lit(schemas.OPEN_END).alias("effective_to"),
                    F.lit(0).alias("deleted_flg"))


@_once
def terminal_slices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three daily full slices of terminals (2024-01-01..03); some terminals
    skip a day, some change type, addresses alternate."""
    s = _suppliers(spark, sf_dir).select("s_suppkey", "s_name", "n_name",
                                         F.explode(F.array(*[F.lit(i) for i in range(3)])).alias("d"))
    k, d = F.col("s_suppkey"), F.col("d")
    return (s.filter((k + d) % 4 != 0)
             .select(_str(k).alias("terminal_id"),
                     F.when((k + d) % 5 == 0, "POS").otherwise("ATM").alias("terminal_type"),
                     F.col("n_name").alias("terminal_city"),
                     F.concat(F.col("s_name"), F.lit("-"), _str((k + d) % 2)).alias("terminal_address"),
                     F.timestamp_add("DAY", d, ts_lit(EPOCH_START)).alias("effective_from")))


_COUNTS: dict[tuple, int] = {}


def _supplier_count(spark: SparkSession, sf_dir: str) -> int:
    """Number of suppliers (terminal ids are ``event_id % n``): one number,
    counted once per session and folder."""
    key = (spark.sparkContext.applicationId, id(spark), sf_dir.rstrip("/"))
    if key not in _COUNTS:
        _COUNTS[key] = _read(spark, sf_dir, "supplier").count()
    return _COUNTS[key]


@_once
def transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = _read(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type", "value")
    n_terminals = F.lit(_supplier_count(spark, sf_dir))
    i = F.col("event_id")
    return e.select(_str(i).alias("trans_id"),
                    F.col("ts").cast(schemas.TS).alias("trans_date"),
                    F.concat(F.lit("C"), _str("user_id"), F.lit("-"), _str(i % 2)).alias("card_num"),
                    F.when(i % 3 == 0, schemas.TYPE_WITHDRAW)
                     .when(i % 3 == 1, schemas.TYPE_PAYMENT)
                     .otherwise("DEPOSIT").alias("oper_type"),
                    F.col("value").cast(schemas.AMOUNT).alias("amt"),
                    F.when(F.col("event_type").isin("purchase", "signup"), schemas.RESULT_SUCCESS)
                     .otherwise(schemas.RESULT_REJECT).alias("oper_result"),
                    _str(i % n_terminals).alias("terminal"))


@_once
def dense_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One operation a minute in groups of four on one card with falling
    amounts; in two of three groups the last succeeds after three rejects."""
    e = _read(spark, sf_dir, "events").select("event_id")
    i = F.col("event_id")
    group, at = F.floor(i / 4), i % 4
    return e.select(_str(i).alias("trans_id"),
                    F.timestamp_add("MINUTE", i.cast("int"), ts_lit(EPOCH_START)).alias("trans_date"),
                    F.concat(F.lit("C"), _str(1 + group % 100), F.lit("-0")).alias("card_num"),
                    F.lit(schemas.TYPE_WITHDRAW).alias("oper_type"),
                    (F.lit(400) - 100 * at).cast(schemas.AMOUNT).alias("amt"),
                    F.when((at == 3) & (group % 3 != 0), schemas.RESULT_SUCCESS)
                     .otherwise(schemas.RESULT_REJECT).alias("oper_result"),
                    _str(i % F.lit(_supplier_count(spark, sf_dir))).alias("terminal"))


def _blacklisted(customer: DataFrame) -> DataFrame:
    k = F.col("c_custkey")
    first = customer.filter(k % 7 == 0).select(
        F.concat(F.lit("P"), _str(k)).alias("passport_num"), _day("2024-01-01", k % 31).alias("entry_dt"))
    second = customer.filter(k % 21 == 0).select(
        F.concat(F.lit("P"), _str(k)).alias("passport_num"), F.lit("2024-01-10").cast("date").alias("entry_dt"))
    return first.unionByName(second)


@_once
def passport_blacklist(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Current blacklist, stored as open history rows."""
    b = _blacklisted(_read(spark, sf_dir, "customer").select("c_custkey"))
    return b.select("*", ts_lit(EPOCH_START).alias("effective_from"),
                    ts_lit(schemas.OPEN_END).alias("effective_to"), F.lit(0).alias("deleted_flg"))


@_once
def blacklist_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of three cumulative monthly blacklist files (2024-01-01..03)."""
    c = _read(spark, sf_dir, "customer").select(
        "c_custkey", F.explode(F.array(*[F.lit(i) for i in range(3)])).alias("d"))
    k, d = F.col("c_custkey"), F.col("d")
    return (c.filter((k % 7 == 0) & (k % 3 <= d))
             .select(F.concat(F.lit("P"), _str(k)).alias("passport_num"),
                     _day("2024-01-01", k % 31).alias("entry_dt"),
                     F.timestamp_add("DAY", d, ts_lit(EPOCH_START)).alias("effective_from")))


@_once
def warehouse(spark: SparkSession, sf_dir: str) -> Warehouse:
    return Warehouse(
        cards=cards(spark, sf_dir),
        accounts=accounts(spark, sf_dir),
        clients=clients(spark, sf_dir),
        terminals=terminals(spark, sf_dir),
        passport_blacklist=passport_blacklist(spark, sf_dir),
        transactions=transactions(spark, sf_dir),
    )
