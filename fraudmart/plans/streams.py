"""Registered queries of the stream joins, typed state and the quarantine, and
their DuckDB twins. The shared rows arrive in slices: each slice is written to the
landing folder and drained by a run of its own with the same checkpoint, so state
crosses both micro-batches and restarts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fraudmart import schemas
from fraudmart.functions import ts_lit
from fraudmart.operators import rules
from fraudmart.plans import catalog, lens, oracle
from fraudmart.session import scratch_path
from fraudmart.sources.store import TableStore
from fraudmart.streaming import interval, quarantine, typed
from fraudmart.streaming import rules as srules
from fraudmart.streaming.ingest import ingest_blacklist, ingest_terminals

AS_OF, REPORT_DT = lens.AS_OF, lens.REPORT_DT
#: Slices end at these instants; the last holds what is left.
CUTS = ["2024-01-11 00:00:00", "2024-01-21 00:00:00"]


def _slices(tx: DataFrame, cuts: list[str] = CUTS) -> list[DataFrame]:
    out, t = [], F.col("trans_date")
    for start, end in zip([None, *cuts], [*cuts, None]):
        part = tx
        if start:
            part = part.filter(t >= ts_lit(start))
        if end:
            part = part.filter(t < ts_lit(end))
        out.append(part)
    return out


def _flush(spark) -> DataFrame:
    return spark.createDataFrame([catalog.FLUSH_ROW], schemas.TRANSACTIONS)


def _source(spark, base: str) -> DataFrame:
    return spark.readStream.schema(schemas.TRANSACTIONS).option("recursiveFileLookup", "true").parquet(f"{base}/src")


def _drain_slices(spark, slices: list[DataFrame], name: str, build: Callable[[DataFrame], DataFrame]) -> DataFrame:
    base = scratch_path(spark, name)
    for i, part in enumerate([*slices, _flush(spark)]):
        part.write.parquet(f"{base}/src/slice-{i}")
        out = srules.drain_to_table(spark, build(_source(spark, base)), f"{base}/out", f"{base}/ck")
    return out


def _interval(emit: str):
    def q(spark, sf_dir):
        wh = lens.warehouse(spark, sf_dir)
        return _drain_slices(spark, _slices(wh.transactions), f"interval-{emit}", lambda s: (
            interval.stream_city_hop_interval_join(wh, s, REPORT_DT, AS_OF, emit=emit))).select(*schemas.REPORT_COLUMNS)
    return q


def city_hop_any_pair_both(spark, sf_dir):
    return rules.report_rows(rules.city_hop_any_pair(lens.warehouse(spark, sf_dir), REPORT_DT, AS_OF, emit="both"))


def _typed_guess(transactions, **kw):
    def q(spark, sf_dir):
        wh = lens.warehouse(spark, sf_dir)
        return _drain_slices(spark, _slices(transactions(spark, sf_dir)), "typed-guess", lambda s: (
            typed.stream_amount_guess_typed(wh, s, REPORT_DT, AS_OF, **kw))).select(*schemas.REPORT_COLUMNS)
    return q


def stream_city_hop_typed(spark, sf_dir):
    wh = lens.warehouse(spark, sf_dir)
    return _drain_slices(spark, _slices(wh.transactions), "typed-hop", lambda s: (
        typed.stream_city_hop_typed(wh, s, REPORT_DT, AS_OF))).select(*schemas.REPORT_COLUMNS)


def stream_amount_guess_resumed(spark, sf_dir):
    """The first slice is already in the fact: a stream that starts with the second
    takes its first state from there. Events of both together are the batch rule's."""
    wh = lens.warehouse(spark, sf_dir)
    stored, *arriving = _slices(wh.transactions)
    known = wh.with_(transactions=stored)
    kw = {"n_rejects": 1, "seconds": 86400}
    state = typed.guess_state(known, AS_OF, 1)
    later = _drain_slices(spark, arriving, "typed-resumed", lambda s: (
        typed.stream_amount_guess_typed(wh, s, REPORT_DT, AS_OF, initial=state, **kw)))
    before = rules.fraud_amount_guess(known, REPORT_DT, AS_OF, **kw)
    return rules.report_rows(before).unionByName(later.select(*schemas.REPORT_COLUMNS))


HALF = "2024-01-15 00:00:00"


def _arrivals(spark, sf_dir) -> list[DataFrame]:
    """Two slices; one in twenty operations of the first half comes with the second,
    with copies of some operations whose time or amount did not parse."""
    tx = lens.warehouse(spark, sf_dir).transactions
    i, early = F.col("trans_id").cast("long"), F.col("trans_date") < ts_lit(HALF)
    late = early & (i % 20 == 7)
    no_time = tx.filter(i % 50 == 3).withColumns({"trans_id": F.concat(F.lit("t"), "trans_id"),
                                                  "trans_date": F.lit(None).cast(schemas.TS)})
    no_amount = tx.filter(~early & (i % 50 == 9)).withColumns({
        "trans_id": F.concat(F.lit("a"), "trans_id"), "amt": F.lit(None).cast(schemas.AMOUNT),
        "card_num": F.lit("unknown")})
    return [tx.filter(early & ~late), tx.filter(~early | late).unionByName(no_time).unionByName(no_amount)]


def _watched(spark, sf_dir) -> str:
    base = scratch_path(spark, "watched")
    wh = lens.warehouse(spark, sf_dir)
    for i, part in enumerate([*_arrivals(spark, sf_dir), _flush(spark)]):
        part.write.parquet(f"{base}/src/slice-{i}")
        q = quarantine.start_watched_report(wh, _source(spark, base), f"{base}/report", f"{base}/ck", REPORT_DT, AS_OF)
        q.awaitTermination()
    return f"{base}/report"


def stream_quarantine(spark, sf_dir):
    return quarantine.quarantined(spark, _watched(spark, sf_dir)).select("trans_id", "reason")


def stream_report_repaired(spark, sf_dir):
    """Streamed events, the days that late rows touch computed again: the full report."""
    return quarantine.repaired_report(lens.warehouse(spark, sf_dir), _watched(spark, sf_dir), REPORT_DT, AS_OF)


def _stream_workbooks(spark, rows: DataFrame, stage, ingest) -> TableStore:
    """The last day's workbooks arrive first, then the others, each in a run of its own."""
    base, day = scratch_path(spark, "workbook-stream"), F.dayofmonth("effective_from")
    store = TableStore(spark, f"{base}/wh")
    for i, part in enumerate((day == 3, day < 3)):
        catalog._move(spark, stage(rows.filter(part)), f"{base}/landing/{i}")
        ingest(spark, f"{base}/landing", store, f"{base}/ck").awaitTermination()
    return store


def stream_terminal_history(spark, sf_dir):
    store = _stream_workbooks(spark, lens.terminal_slices(spark, sf_dir),
                              lambda rows: catalog._terminal_feed(spark, sf_dir, rows), ingest_terminals)
    return store.read("terminals")


def stream_blacklist(spark, sf_dir):
    store = _stream_workbooks(spark, lens.blacklist_files(spark, sf_dir),
                              lambda rows: catalog._blacklist_feed(spark, sf_dir, rows), ingest_blacklist)
    return store.read("passport_blacklist")


QUERIES = {
    "stream_city_hop_interval_join": _interval("later"),
    "stream_city_hop_interval_both": _interval("both"),
    "city_hop_any_pair_both": city_hop_any_pair_both,
    "stream_amount_guess_typed": _typed_guess(lens.dense_transactions),
    "stream_amount_guess_typed_1reject_1day": _typed_guess(lens.transactions, n_rejects=1, seconds=86400),
    "stream_city_hop_typed": stream_city_hop_typed,
    "stream_amount_guess_resumed": stream_amount_guess_resumed,
    "stream_quarantine": stream_quarantine,
    "stream_report_repaired": stream_report_repaired,
    "stream_terminal_history": stream_terminal_history,
    "stream_blacklist": stream_blacklist,
}

_BOTH = oracle._q(oracle._report(
    oracle.EVENT_CITY_HOP, "located a",
    "EXISTS (SELECT 1 FROM located b WHERE b.client_id = a.client_id AND b.terminal_city <> a.terminal_city "
    "AND abs(date_diff('second', b.trans_date, a.trans_date)) <= 3600)"))

SQL = {
    "stream_city_hop_interval_join": oracle.SQL["city_hop_any_pair"],
    "stream_city_hop_interval_both": _BOTH,
    "city_hop_any_pair_both": _BOTH,
    "stream_amount_guess_typed": oracle.SQL["fraud_amount_guess_dense"],
    "stream_amount_guess_typed_1reject_1day": oracle.SQL["amount_guess_1reject_1day"],
    "stream_city_hop_typed": oracle.SQL["city_hop_any_pair"],
    "stream_amount_guess_resumed": oracle.SQL["amount_guess_1reject_1day"],
    "stream_quarantine": """
WITH e AS (SELECT event_id AS i, ts, ts < TIMESTAMP '2024-01-15 00:00:00' AS early FROM events),
wm AS (SELECT date_trunc('second', max(ts)) - INTERVAL 1 HOUR AS wm FROM e WHERE early AND i % 20 <> 7)
SELECT CAST(i AS VARCHAR) AS trans_id, 'late' AS reason FROM e, wm WHERE early AND i % 20 = 7 AND date_trunc('second', ts) <= wm
UNION ALL SELECT 't' || CAST(i AS VARCHAR), 'no time' FROM e WHERE i % 50 = 3
UNION ALL SELECT 'a' || CAST(i AS VARCHAR), 'no amount' FROM e WHERE NOT early AND i % 50 = 9""",
    "stream_report_repaired": oracle.SQL["fraud_report"],
    "stream_terminal_history": oracle.SQL["scd2_terminal_history"],
    "stream_blacklist": oracle.SQL["blacklist_insert_if_absent"],
}
