"""Named queries over the shared tables: each takes (spark, sf_dir) and
returns a DataFrame whose columns match ``fraudmart.plans.oracle.SQL``."""

from __future__ import annotations

import datetime as _dt
import decimal
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fraudmart import schemas
from fraudmart.functions import amount_from_text, full_name
from fraudmart.functions import epoch_ms_to_date as epoch_ms_to_day
from fraudmart.operators import chain, history, report, rules
from fraudmart.operators.sequence import ordered_neighbours
from fraudmart.plans import daily, lens, staging
from fraudmart.session import scratch_path
from fraudmart.sources import feeds, files, workbook
from fraudmart.sources.store import TableStore, ensure_dimensions

Query = Callable[[SparkSession, str], DataFrame]
AS_OF = lens.AS_OF
REPORT_DT = lens.REPORT_DT
JAN2 = "2024-01-02 12:00:00"


def _wh(spark: SparkSession, sf_dir: str):
    return lens.warehouse(spark, sf_dir)


def ownership_chain(spark, sf_dir):
    return chain.ownership_chain(_wh(spark, sf_dir)).select("trans_id", "card_num", "account", "client_id")


def fraud_passport(spark, sf_dir):
    return rules.report_rows(rules.fraud_passport(_wh(spark, sf_dir), REPORT_DT, AS_OF))


def fraud_contract(spark, sf_dir):
    return rules.report_rows(rules.fraud_contract(_wh(spark, sf_dir), REPORT_DT))


def fraud_city_hop(spark, sf_dir):
    return rules.report_rows(rules.fraud_city_hop(_wh(spark, sf_dir), REPORT_DT, AS_OF, emit="both"))


def fraud_city_hop_later(spark, sf_dir):
    return rules.report_rows(rules.fraud_city_hop(_wh(spark, sf_dir), REPORT_DT, AS_OF, emit="later"))


def city_hop_any_pair(spark, sf_dir):
    return rules.report_rows(rules.city_hop_any_pair(_wh(spark, sf_dir), REPORT_DT, AS_OF))


def _amount_guess(n_rejects: int, seconds: int) -> Query:
    def q(spark, sf_dir):
        return rules.report_rows(rules.fraud_amount_guess(
            _wh(spark, sf_dir), REPORT_DT, AS_OF, n_rejects=n_rejects, seconds=seconds))
    q.__name__ = f"amount_guess_{n_rejects}_{seconds}"
    return q


def fraud_report(spark, sf_dir):
    return rules.report_rows(rules.all_rules(_wh(spark, sf_dir), REPORT_DT, AS_OF))


def report_sorted(spark, sf_dir):
    return fraud_report(spark, sf_dir).orderBy("event_dt")


def _located(spark, sf_dir):
    return rules.located_successes(_wh(spark, sf_dir), AS_OF)


def multi_city_clients(spark, sf_dir):
    return chain.multi_city_clients(_located(spark, sf_dir))


def distinct_client_city(spark, sf_dir):
    return _located(spark, sf_dir).select("client_id", "terminal_city").distinct()


def semi_multi_city(spark, sf_dir):
    rows = _located(spark, sf_dir)
    return chain.in_multi_city(rows, chain.multi_city_clients(rows)).select(
        "trans_id", "client_id", "terminal_city")


def semi_known_cards(spark, sf_dir):
    wh = _wh(spark, sf_dir)
    return chain.known_cards_only(chain.v_transactions(wh), wh).select("trans_id", "card_num")


def chain_with_terminal(spark, sf_dir):
    wh = _wh(spark, sf_dir)
    rows = chain.with_terminal(chain.ownership_chain(wh), chain.current_terminals(wh, AS_OF))
    return rows.select("trans_id", "client_id", "terminal_id", "terminal_type", "terminal_city")


def chain_left_blacklist(spark, sf_dir):
    wh = _wh(spark, sf_dir)
    rows = chain.with_blacklist(chain.ownership_chain(wh), chain.current_blacklist(wh, AS_OF))
    return rows.select("trans_id", "client_id", "passport_num", "entry_dt")


def tx_prev_next(spark, sf_dir):
    rows = ordered_neighbours(_located(spark, sf_dir), ["client_id"], "trans_date", "trans_id",
                              ["trans_date", "terminal_city"], lags=1, leads=1)
    return rows.select("trans_id", "client_id",
                       F.col("prev1_trans_date").alias("prev_trans_date"),
                       F.col("prev1_terminal_city").alias("prev_city"),
                       F.col("next1_trans_date").alias("next_trans_date"),
                       F.col("next1_terminal_city").alias("next_city"))


def _lag3(spark, sf_dir, **ranges) -> DataFrame:
    wh = _wh(spark, sf_dir)
    tx = chain.v_transactions(wh).filter(
        F.col("oper_type").isin(schemas.TYPE_WITHDRAW, schemas.TYPE_PAYMENT))
    rows = chain.with_terminal(chain.ownership_chain(wh, tx), chain.current_terminals(wh, AS_OF))
    rows = ordered_neighbours(rows, ["card_num"], "trans_date", "trans_id",
                              ["trans_date", "oper_result", "amt"], lags=3, **ranges)
    cols = ["trans_id", "card_num"]
    for j in (1, 2, 3):
        cols += [F.col(f"prev{j}_trans_date").alias(f"dt_{j}"),
                 F.col(f"prev{j}_oper_result").alias(f"op_r_{j}"),
                 F.col(f"prev{j}_amt").alias(f"amt_{j}")]
    return rows.select(*cols)


def tx_lag3(spark, sf_dir):
    return _lag3(spark, sf_dir)


def time_gap(spark, sf_dir):
    tx = chain.v_transactions(_wh(spark, sf_dir)).withColumn("_sec", F.unix_timestamp("trans_date"))
    rows = ordered_neighbours(tx, ["card_num"], "trans_date", "trans_id", ["_sec"], lags=1)
    gap = F.abs(F.col("_sec") - F.col("prev1__sec"))
    return (rows.select("trans_id", "card_num", gap.alias("gap_seconds"))
                .filter(F.col("gap_seconds") <= schemas.CITY_HOP_SECONDS))


def tx_success(spark, sf_dir):
    return (chain.v_transactions(_wh(spark, sf_dir))
            .filter(F.col("oper_result") == schemas.RESULT_SUCCESS)
            .select("trans_id", "trans_date", "card_num", "amt"))


def tx_types(spark, sf_dir):
    return (chain.v_transactions(_wh(spark, sf_dir))
            .filter(F.col("oper_type").isin(schemas.TYPE_WITHDRAW, schemas.TYPE_PAYMENT))
            .select("trans_id", "oper_type", "amt"))


def client_full_name(spark, sf_dir):
    return _wh(spark, sf_dir).clients.select("client_id", full_name().alias("fio"))


def dim_projections(spark, sf_dir):
    return chain.v_clients(_wh(spark, sf_dir))


def v_cards(spark, sf_dir):
    return chain.v_cards(_wh(spark, sf_dir))


def v_accounts(spark, sf_dir):
    return chain.v_accounts(_wh(spark, sf_dir))


def v_transactions(spark, sf_dir):
    return chain.v_transactions(_wh(spark, sf_dir))


def table_scan(spark, sf_dir):
    return _wh(spark, sf_dir).cards


def table_scan_accounts(spark, sf_dir):
    return _wh(spark, sf_dir).accounts


def table_scan_clients(spark, sf_dir):
    return _wh(spark, sf_dir).clients


_TERMINAL_KEYS = ["terminal_id", "terminal_type"]
_TERMINAL_ATTRS = ["terminal_city", "terminal_address"]


def scd2_terminal_history(spark, sf_dir):
    return history.scd2_history(lens.terminal_slices(spark, sf_dir), _TERMINAL_KEYS, _TERMINAL_ATTRS)


def _terminals_at(at: str) -> Query:
    def q(spark, sf_dir):
        return history.as_of(scd2_terminal_history(spark, sf_dir), at).select(
            "terminal_id", "terminal_type", "terminal_city", "terminal_address")
    return q


def blacklist_insert_if_absent(spark, sf_dir):
    return history.insert_if_absent(None, lens.blacklist_files(spark, sf_dir),
                                    ["passport_num", "entry_dt"])


def blacklist_as_of(spark, sf_dir):
    return history.as_of(blacklist_insert_if_absent(spark, sf_dir), JAN2).select(
        "passport_num", "entry_dt")


QUERIES: dict[str, Query] = {
    "ownership_chain": ownership_chain,
    "fraud_passport": fraud_passport,
    "fraud_contract": fraud_contract,
    "fraud_city_hop": fraud_city_hop,
    "fraud_city_hop_later": fraud_city_hop_later,
    "city_hop_any_pair": city_hop_any_pair,
    "fraud_amount_guess": _amount_guess(schemas.AMOUNT_GUESS_REJECTS, schemas.AMOUNT_GUESS_SECONDS),
    "amount_guess_1reject_1day": _amount_guess(1, 86400),
    "amount_guess_1reject_6h": _amount_guess(1, 21600),
    "amount_guess_2rejects_1day": _amount_guess(2, 86400),
    "amount_guess_3rejects_1day": _amount_guess(3, 86400),
    "fraud_report": fraud_report,
    "report_sorted": report_sorted,
    "multi_city_clients": multi_city_clients,
    "distinct_client_city": distinct_client_city,
    "semi_multi_city": semi_multi_city,
    "semi_known_cards": semi_known_cards,
    "chain_with_terminal": chain_with_terminal,
    "chain_left_blacklist": chain_left_blacklist,
    "tx_prev_next": tx_prev_next,
    "tx_lag3": tx_lag3,
    "time_gap": time_gap,
    "tx_success": tx_success,
    "tx_types": tx_types,
    "client_full_name": client_full_name,
    "dim_projections": dim_projections,
    "v_cards": v_cards,
    "v_accounts": v_accounts,
    "v_transactions": v_transactions,
    "table_scan": table_scan,
    "table_scan_accounts": table_scan_accounts,
    "table_scan_clients": table_scan_clients,
    "scd2_terminal_history": scd2_terminal_history,
    "scd2_terminals_as_of": _terminals_at(AS_OF),
    "scd2_terminals_as_of_jan2": _terminals_at(JAN2),
    "blacklist_insert_if_absent": blacklist_insert_if_absent,
    "blacklist_as_of": blacklist_as_of,
}


# --- feeds, storage and the mart: stage rows derived from the shared tables
# in a fresh folder under the session's checkpoint folder, run the operator,
# return what it produced ----------------------------------------------------

def _staged_tx_feed(spark, sf_dir) -> str:
    base = scratch_path(spark, "txfeed")
    feeds.write_tx_feed(spark, _wh(spark, sf_dir).transactions, f"{base}/staging", f"{base}/landing")
    return f"{base}/landing"


_TX_COLS = [f.name for f in schemas.TRANSACTIONS.fields]


def tx_feed_scan(spark, sf_dir):
    landing = _staged_tx_feed(spark, sf_dir)
    return feeds.normalise_transactions(feeds.read_tx_feed(spark, landing)).select(*_TX_COLS)


def feed_business_date(spark, sf_dir):
    landing = _staged_tx_feed(spark, sf_dir)
    return (feeds.discover(spark, landing, schemas.TX_FEED_GLOB)
            .select("file_name", "business_dt").distinct())


def amount_normalise(spark, sf_dir):
    landing = _staged_tx_feed(spark, sf_dir)
    feed = feeds.read_tx_feed(spark, landing)
    return feed.select(F.col("transaction_id").alias("trans_id"), "amount",
                       amount_from_text("amount").alias("amt"))


def epoch_ms_to_date(spark, sf_dir):
    bl = lens.passport_blacklist(spark, sf_dir)
    ms = (F.datediff("entry_dt", F.lit("1970-01-01").cast("date")).cast("long") * 86_400_000
          + 43_200_000)
    return bl.select("passport_num", ms.alias("entry_ms")).select(
        "passport_num", "entry_ms", epoch_ms_to_day("entry_ms").alias("entry_dt"))


def tx_append(spark, sf_dir):
    landing = _staged_tx_feed(spark, sf_dir)
    store = TableStore(spark, scratch_path(spark, "wh"))
    daily.load_transactions(spark, store, landing)
    daily.load_transactions(spark, store, landing)  # nothing new: no duplicates
    return store.read("transactions").select("trans_id", "load_dt")


def ingest_ledger(spark, sf_dir):
    landing = _staged_tx_feed(spark, sf_dir)
    store = TableStore(spark, scratch_path(spark, "wh"))
    daily.load_transactions(spark, store, landing)
    daily.load_transactions(spark, store, landing)
    led = store.read("_ingest_ledger")
    per_file = led.groupBy("file_path", "file_name", "business_dt").agg(F.count(F.lit(1)).alias("n"))
    return per_file.groupBy("file_name", "business_dt").agg(F.max("n").alias("loads_per_file"))


def report_for_day(spark, sf_dir):
    store = TableStore(spark, scratch_path(spark, "wh"))
    rep = report.build_report(_wh(spark, sf_dir), REPORT_DT, AS_OF)
    report.write_report(store, rep, REPORT_DT)
    report.write_report(store, rep, REPORT_DT)  # same-day rerun replaces the slice
    out_dir = scratch_path(spark, "export")
    report.export_report(spark, report.report_for_day(store, REPORT_DT), out_dir, REPORT_DT,
                         scratch_path(spark, "export-staging"))
    return report.read_export(spark, out_dir)


def _seeded(spark, sf_dir) -> TableStore:
    store = TableStore(spark, scratch_path(spark, "wh"))
    seeds = {"cards": lens.cards(spark, sf_dir), "accounts": lens.accounts(spark, sf_dir),
             "clients": lens.clients(spark, sf_dir)}
    ensure_dimensions(store, seeds)
    ensure_dimensions(store, seeds)  # second call sees rows and does nothing
    return store


def dim_seed_if_empty(spark, sf_dir):
    return _seeded(spark, sf_dir).read("cards")


def dim_seed_accounts(spark, sf_dir):
    return _seeded(spark, sf_dir).read("accounts")


def dim_seed_clients(spark, sf_dir):
    return _seeded(spark, sf_dir).read("clients")


def _terminal_feed(spark, sf_dir, slices=None) -> str:
    folder = scratch_path(spark, "terminal-feed")
    staging.write_workbooks(lens.terminal_slices(spark, sf_dir) if slices is None else slices, "effective_from",
                            "terminals", schemas.TERMINAL_SHEET, workbook.TERMINAL_COLUMNS, folder)
    return folder


def _blacklist_feed(spark, sf_dir, rows=None) -> str:
    folder = scratch_path(spark, "blacklist-feed")
    rows = lens.blacklist_files(spark, sf_dir) if rows is None else rows
    cells = rows.select(F.col("passport_num").alias("passport"),
                        F.datediff("entry_dt", F.lit("1899-12-30").cast("date")).alias("date"), "effective_from")
    staging.write_workbooks(cells, "effective_from", "passport_blacklist", schemas.BLACKLIST_SHEET,
                            workbook.BLACKLIST_COLUMNS, folder)
    return folder


def terminal_feed_scan(spark, sf_dir):
    """The .xlsx files, found and read from storage."""
    parsed = workbook.read_workbooks(spark, _terminal_feed(spark, sf_dir), schemas.TERMINAL_FEED_GLOB,
                                     schemas.TERMINAL_SHEET, workbook.TERMINAL_COLUMNS)
    return workbook.terminal_slices(parsed).select(*_TERMINAL_KEYS, *_TERMINAL_ATTRS, "effective_from")


def blacklist_feed_scan(spark, sf_dir):
    parsed = workbook.read_workbooks(spark, _blacklist_feed(spark, sf_dir), schemas.BLACKLIST_FEED_GLOB,
                                     schemas.BLACKLIST_SHEET, workbook.BLACKLIST_COLUMNS)
    return workbook.blacklist_rows(parsed).select("passport_num", "entry_dt", "effective_from")


# --- the daily job over several runs -----------------------------------------

MIDDLE = "2024-01-16 00:00:00"


def _move(spark, folder: str, landing: str) -> None:
    for path in files.list_files(spark, folder):
        files.rename(spark, path, f"{landing}/{path.rsplit('/', 2)[-2]}/{path.rsplit('/', 1)[-1]}")


def daily_run_two_days(spark, sf_dir):
    """A first run with part of the days and archive; then late files
    for days already archived, under names used before, and the other days; then a
    rerun without new files. All transactions are in the table, once."""
    wh, base = _wh(spark, sf_dir), scratch_path(spark, "daily")
    tx, landing = wh.transactions, f"{base}/landing"
    late = F.pmod(F.xxhash64("trans_id"), F.lit(10)) == 0
    early = F.col("trans_date") < F.lit(MIDDLE).cast(schemas.TS)
    seeds = {"cards": wh.cards, "accounts": wh.accounts, "clients": wh.clients}
    for part in (early & ~late, ~early | late, None):
        if part is not None:
            feeds.write_tx_feed(spark, tx.filter(part), scratch_path(spark, "staging"), landing)
        daily.run_day(spark, landing, f"{landing}/warehouse", seeds=seeds, report_dt=REPORT_DT, as_of=AS_OF,
                      archive_dir=f"{landing}/archive", since=MIDDLE)
    return TableStore(spark, f"{landing}/warehouse").read("transactions").select(*_TX_COLS)


def report_rerun(spark, sf_dir):
    """A slice and its export are written, the input changes, both
    are written again: exactly the second report is left."""
    store, out_dir = TableStore(spark, scratch_path(spark, "wh")), scratch_path(spark, "export")
    for since in (None, SINCE):
        rep = report.build_report(_wh(spark, sf_dir), REPORT_DT, AS_OF, since=since)
        report.write_report(store, rep, REPORT_DT)
        report.export_report(spark, report.report_for_day(store, REPORT_DT), out_dir, REPORT_DT,
                             scratch_path(spark, "export-staging"))
    return report.read_export(spark, out_dir)


CUTS = ["2024-01-01 00:00:00", "2024-01-08 00:00:00", "2024-01-15 00:00:00", "2024-01-22 00:00:00"]


def report_accumulated_days(spark, sf_dir):
    """Runs with ``since``, each over what had arrived by then, add up to the
    full report."""
    wh, out = _wh(spark, sf_dir), None
    for at, until in zip(CUTS, [*CUTS[1:], None]):
        seen = wh.transactions if until is None else wh.transactions.filter(
            F.col("trans_date") < F.lit(until).cast(schemas.TS))
        rep = report.build_report(wh.with_(transactions=seen), REPORT_DT, AS_OF, since=None if out is None else at)
        out = rep if out is None else out.unionByName(rep)
    return out


def terminals_loaded_out_of_order(spark, sf_dir):
    """The last slice is loaded first, then the others, from files."""
    day = F.dayofmonth("effective_from")
    slices, base = lens.terminal_slices(spark, sf_dir), scratch_path(spark, "wh")
    store = TableStore(spark, base)
    for part in (day == 3, day < 3):
        daily.load_terminals(spark, store, _terminal_feed(spark, sf_dir, slices.filter(part)))
    return store.read("terminals")


def blacklist_loaded_out_of_order(spark, sf_dir):
    """The last file is loaded first, then the others, then all again."""
    day = F.dayofmonth("effective_from")
    rows, store = lens.blacklist_files(spark, sf_dir), TableStore(spark, scratch_path(spark, "wh"))
    for part in (day == 3, day < 3, day > 0):
        daily.load_blacklist(spark, store, _blacklist_feed(spark, sf_dir, rows.filter(part)))
    return store.read("passport_blacklist")


def city_hop_any_pair_null_city(spark, sf_dir):
    """J7 where a third of the terminals have no city."""
    wh = _wh(spark, sf_dir)
    city = F.when(F.col("terminal_id").cast("int") % 3 != 0, F.col("terminal_city"))
    return rules.report_rows(rules.city_hop_any_pair(
        wh.with_(terminals=wh.terminals.withColumn("terminal_city", city)), REPORT_DT, AS_OF))


def fraud_amount_guess_dense(spark, sf_dir):
    """R4 with its real parameters over a binding where it has rows."""
    wh = _wh(spark, sf_dir).with_(transactions=lens.dense_transactions(spark, sf_dir))
    return rules.report_rows(rules.fraud_amount_guess(wh, REPORT_DT, AS_OF))


QUERIES.update({
    "tx_feed_scan": tx_feed_scan,
    "feed_business_date": feed_business_date,
    "amount_normalise": amount_normalise,
    "epoch_ms_to_date": epoch_ms_to_date,
    "tx_append": tx_append,
    "ingest_ledger": ingest_ledger,
    "report_for_day": report_for_day,
    "dim_seed_if_empty": dim_seed_if_empty,
    "dim_seed_accounts": dim_seed_accounts,
    "dim_seed_clients": dim_seed_clients,
    "daily_run_two_days": daily_run_two_days,
    "report_rerun": report_rerun,
    "report_accumulated_days": report_accumulated_days,
    "terminals_loaded_out_of_order": terminals_loaded_out_of_order,
    "blacklist_loaded_out_of_order": blacklist_loaded_out_of_order,
    "city_hop_any_pair_null_city": city_hop_any_pair_null_city,
    "fraud_amount_guess_dense": fraud_amount_guess_dense,
    "terminal_feed_scan": terminal_feed_scan,
    "blacklist_feed_scan": blacklist_feed_scan,
})


# --- streaming extensions: the shared rows arrive as files -------------------

# A transaction far in the future, the last file of a finished stream: it moves
# the watermark past every real row. The rules' status and type filters are
# pushed below the watermark, so it must pass them; its card exists in no
# dimension, so it drops out at the ownership join.
FLUSH_ROW = ("__flush__", _dt.datetime(9999, 1, 1), "__flush__", schemas.TYPE_WITHDRAW,
             decimal.Decimal("0.00"), schemas.RESULT_SUCCESS, "__flush__")


def _staged_tx_stream(spark, sf_dir, transactions=None) -> str:
    """Transactions as Parquet files, one folder per day, plus the marker row."""
    base = scratch_path(spark, "txstream")
    tx = _wh(spark, sf_dir).transactions if transactions is None else transactions
    (tx.withColumn("_day", F.to_date("trans_date")).write.partitionBy("_day")
     .parquet(f"{base}/src/days"))
    spark.createDataFrame([FLUSH_ROW], schemas.TRANSACTIONS).write.parquet(f"{base}/src/zz-flush")
    return base


def _drain(spark, base: str, name: str, build) -> DataFrame:
    from fraudmart.streaming import rules as srules
    stream = spark.readStream.schema(schemas.TRANSACTIONS).option("recursiveFileLookup", "true") \
        .parquet(f"{base}/src")
    return srules.drain_to_table(spark, build(stream), f"{base}/out-{name}", f"{base}/ck-{name}")


def stream_ingest(spark, sf_dir):
    from fraudmart.streaming.ingest import ingest_transactions
    landing = _staged_tx_feed(spark, sf_dir)
    base = scratch_path(spark, "ingest")
    ingest_transactions(spark, landing, f"{base}/tx", f"{base}/ck").awaitTermination()
    ingest_transactions(spark, landing, f"{base}/tx", f"{base}/ck").awaitTermination()
    return spark.read.parquet(f"{base}/tx").select(*_TX_COLS)


def stream_passport(spark, sf_dir):
    from fraudmart.streaming import rules as srules
    wh = _wh(spark, sf_dir)
    return _drain(spark, _staged_tx_stream(spark, sf_dir), "passport",
                  lambda s: srules.stream_passport(wh, s, REPORT_DT, AS_OF))


def stream_contract(spark, sf_dir):
    from fraudmart.streaming import rules as srules
    wh = _wh(spark, sf_dir)
    return _drain(spark, _staged_tx_stream(spark, sf_dir), "contract",
                  lambda s: srules.stream_contract(wh, s, REPORT_DT))


def stream_city_hop_any_pair(spark, sf_dir):
    from fraudmart.streaming import stateful
    wh = _wh(spark, sf_dir)
    out = _drain(spark, _staged_tx_stream(spark, sf_dir), "anypair",
                 lambda s: stateful.stream_city_hop_any_pair(wh, s, REPORT_DT, AS_OF))
    return out.select(*schemas.REPORT_COLUMNS)


def stream_amount_guess_dense(spark, sf_dir):
    """X4 with the rule's real parameters over a binding where it has rows."""
    from fraudmart.streaming import stateful
    tx = lens.dense_transactions(spark, sf_dir)
    out = _drain(spark, _staged_tx_stream(spark, sf_dir, tx), "guess",
                 lambda s: stateful.stream_amount_guess(_wh(spark, sf_dir), s, REPORT_DT, AS_OF))
    return out.select(*schemas.REPORT_COLUMNS)


def _stream_guess(n_rejects: int, seconds: int) -> Query:
    def q(spark, sf_dir):
        from fraudmart.streaming import stateful
        wh = _wh(spark, sf_dir)
        out = _drain(spark, _staged_tx_stream(spark, sf_dir), "guess",
                     lambda s: stateful.stream_amount_guess(wh, s, REPORT_DT, AS_OF,
                                                            n_rejects=n_rejects, seconds=seconds))
        return out.select(*schemas.REPORT_COLUMNS)
    return q


QUERIES.update({
    "stream_ingest": stream_ingest,
    "stream_passport": stream_passport,
    "stream_contract": stream_contract,
    "stream_city_hop_any_pair": stream_city_hop_any_pair,
    "stream_amount_guess": _stream_guess(schemas.AMOUNT_GUESS_REJECTS, schemas.AMOUNT_GUESS_SECONDS),
    "stream_amount_guess_1reject_1day": _stream_guess(1, 86400),
    "stream_amount_guess_dense": stream_amount_guess_dense,
})


# --- behaviour options ----------------------------------------

def terminal_open_rows(spark, sf_dir):
    """Ids with more than one current row (type change keeps old open)."""
    return history.open_rows_per_id(scd2_terminal_history(spark, sf_dir), "terminal_id", AS_OF)


def fraud_passport_distinct(spark, sf_dir):
    """One report row per transaction instead of one per blacklist entry."""
    return rules.report_rows(rules.fraud_passport(_wh(spark, sf_dir), REPORT_DT, AS_OF,
                                                  distinct_events=True))


def scd2_terminal_history_close_missing(spark, sf_dir):
    """A terminal missing from the next full slice is closed."""
    return history.scd2_history(lens.terminal_slices(spark, sf_dir), _TERMINAL_KEYS, _TERMINAL_ATTRS,
                                close_missing=True)


def chain_terminal_at_event_time(spark, sf_dir):
    """The terminal row valid at the operation's time."""
    wh = _wh(spark, sf_dir).with_(terminals=scd2_terminal_history(spark, sf_dir))
    rows = chain.with_terminal_at_event(chain.v_transactions(wh), wh.terminals)
    return rows.select("trans_id", "terminal_id", "terminal_type", "terminal_city", "terminal_address")


def city_hop_point_in_time(spark, sf_dir):
    """Rule 3 (both) with the terminal valid at each operation's time."""
    wh = _wh(spark, sf_dir).with_(terminals=scd2_terminal_history(spark, sf_dir))
    return rules.report_rows(rules.fraud_city_hop(wh, REPORT_DT, AS_OF, point_in_time=True))


SINCE = "2024-01-15 00:00:00"


def fraud_report_since(spark, sf_dir):
    """R5 with ``since``: only events established from that instant on."""
    return report.build_report(_wh(spark, sf_dir), REPORT_DT, AS_OF, since=SINCE)


QUERIES.update({
    "terminal_open_rows": terminal_open_rows,
    "fraud_passport_distinct": fraud_passport_distinct,
    "scd2_terminal_history_close_missing": scd2_terminal_history_close_missing,
    "chain_terminal_at_event_time": chain_terminal_at_event_time,
    "city_hop_point_in_time": city_hop_point_in_time,
    "fraud_report_since": fraud_report_since,
})


# --- small pieces: narrow time buckets and many ranges, so that pairs, chains
# and neighbours cross their edges on the shared data --------------------------

def fraud_city_hop_split(spark, sf_dir):
    return rules.report_rows(rules.fraud_city_hop(_wh(spark, sf_dir), REPORT_DT, AS_OF, emit="both",
                                                  bucket_seconds=7200))


def city_hop_any_pair_split(spark, sf_dir):
    return rules.report_rows(rules.city_hop_any_pair(_wh(spark, sf_dir), REPORT_DT, AS_OF, bucket_seconds=3600))


def amount_guess_1reject_1day_split(spark, sf_dir):
    return rules.report_rows(rules.fraud_amount_guess(_wh(spark, sf_dir), REPORT_DT, AS_OF, n_rejects=1,
                                                      seconds=86400, bucket_seconds=86400))


def tx_lag3_split(spark, sf_dir):
    return _lag3(spark, sf_dir, partitions=97)


QUERIES.update({
    "fraud_city_hop_split": fraud_city_hop_split,
    "city_hop_any_pair_split": city_hop_any_pair_split,
    "amount_guess_1reject_1day_split": amount_guess_1reject_1day_split,
    "tx_lag3_split": tx_lag3_split,
})


def stream_fraud_city_hop(spark, sf_dir):
    from fraudmart.streaming import stateful
    wh = _wh(spark, sf_dir)
    out = _drain(spark, _staged_tx_stream(spark, sf_dir), "hop",
                 lambda s: stateful.stream_city_hop(wh, s, REPORT_DT, AS_OF, emit="both"))
    return out.select(*schemas.REPORT_COLUMNS)


def stream_fraud_report(spark, sf_dir):
    """The report mart fed by one streaming query (rules 1-4), exactly once."""
    from fraudmart.streaming import rules as srules
    from fraudmart.streaming.report import start_report_stream
    wh = _wh(spark, sf_dir)
    base = _staged_tx_stream(spark, sf_dir)
    stream = spark.readStream.schema(schemas.TRANSACTIONS).option("recursiveFileLookup", "true") \
        .parquet(f"{base}/src")
    q = start_report_stream(wh, stream, f"{base}/mart", f"{base}/ck-mart", REPORT_DT, AS_OF)
    q.awaitTermination()
    if q.exception():
        raise q.exception()
    return spark.read.parquet(f"{base}/mart").select(*schemas.REPORT_COLUMNS)


QUERIES.update({
    "stream_fraud_city_hop": stream_fraud_city_hop,
    "stream_fraud_report": stream_fraud_report,
})
