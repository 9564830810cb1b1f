"""Rules 3 (any pair) and 4 on ``transformWithState``: typed list and map state,
event-time timers and a start from the stored fact.

Keys (clients or cards) are dealt by hash into groups (``packed``), and per group the
state holds

* ``pending`` (list): operations the watermark has not passed, so their place in the
  order is not final yet, one packed Arrow table per batch they came with;
* rule 4: ``last`` (list), the last operations of each card, at most as many as a chain
  has rejects; rule 3: ``cities`` (map), the last second each client was seen in a city.

A timer stands at the earliest pending operation; when the watermark passes it, the
ready operations are taken key by key in (time, id, city) order. Another stands where
the kept operations can match nothing any more, and clears them, so idle keys leave no
state. (Spark allows a time to live only with processing time; event-time timers do
that work here.) Calls to the state grow with groups and, in rule 3, with the entries
that change.

``initial`` gives a query that starts today what earlier operations, already in the
fact, would have left in the state.

An operation at or behind the watermark when it arrives is not used (its neighbours
may have been reported); ``fraudmart.streaming.quarantine`` keeps such rows.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from fraudmart import schemas
from fraudmart.functions import date_lit
from fraudmart.operators import chain
from fraudmart.session import ship_package
from fraudmart.streaming.ingest import watermarked
from fraudmart.streaming.packed import fresh, group_of, pack, runs, unpack
from fraudmart.warehouse import Warehouse

TIME_FORMAT = "yyyy-MM-dd HH:mm:ss.SSSSSS"
WHO = ["trans_id", "client_id", "passport_num", "fio", "phone"]
TEXTS = ["key", *WHO, "ts", "terminal_city", "oper_result", "cents"]
ROWS = pa.schema([*((c, pa.string()) for c in TEXTS), ("sec", pa.int64())])
LAST = pa.schema([("key", pa.string()), ("at", pa.int32()), ("oper_result", pa.string()), ("cents", pa.int64()), ("sec", pa.int64())])
OUT = "trans_id string, client_id string, passport_num string, fio string, phone string, ts string, established string"
SUCCESS, REJECT = schemas.RESULT_SUCCESS, schemas.RESULT_REJECT

# Spark also starts a processor beside the driver, in a process that files added to
# the session do not reach: processors travel whole. They use nothing of this package
# but the names of this module and of ``packed``.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


class _InOrder(StatefulProcessor):
    """Holds operations back until the watermark has passed them."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.pending = handle.getListState("pending", "rows binary")
        self.open_kept()

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        found = fresh(rows, ROWS, timerValues.getCurrentWatermarkInMs())
        if found:
            arrived = pa.concat_tables(found)
            self.pending.appendValue((pack(arrived),))
            self.handle.registerTimer(pc.min(arrived["sec"]).as_py() * 1000)
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        second = timerValues.getCurrentWatermarkInMs() // 1000
        held = pa.concat_tables([ROWS.empty_table(), *(unpack(r[0]) for r in self.pending.get())])
        passed = pc.less_equal(held["sec"], second)
        ready, later = held.filter(passed), held.filter(pc.invert(passed))
        if len(ready):
            if len(later):
                self.pending.put([(pack(later),)])
                self.handle.registerTimer(pc.min(later["sec"]).as_py() * 1000)
            else:
                self.pending.clear()
        hits: list[dict] = []
        until = self.take(ready, second, hits)
        if until is not None:
            self.handle.registerTimer(until * 1000 + 1000)
        if hits:
            yield pd.DataFrame({**{c: [h[c] for h in hits] for c in (*WHO, "ts")}, "established": [h["ts"] for h in hits]})


class AmountGuess(_InOrder):
    def __init__(self, n_rejects: int, seconds: int) -> None:
        self.n, self.seconds = n_rejects, seconds

    def open_kept(self) -> None:
        self.last = self.handle.getListState("last", "card string, at int, oper_result string, cents long, sec long")

    def handleInitialState(self, key, initialState, timerValues) -> None:
        texts = pa.Table.from_pandas(initialState[LAST.names], preserve_index=False)
        self.last.appendList([tuple(r.values()) for r in texts.cast(LAST).to_pylist()])
        self.handle.registerTimer((int(initialState["sec"].max()) + self.seconds + 1) * 1000)

    def take(self, ready: pa.Table, second: int, hits: list[dict]) -> int | None:
        """Scan the ready operations and keep what can still match after ``second``;
        gives the last second at which it can."""
        before: dict[str, list[tuple]] = {}
        for card, _, *op in sorted(self.last.get(), key=lambda r: r[1]):
            before.setdefault(card, []).append(tuple(op))
        cards = dict(before)
        for card, rows in runs(ready):
            cards[card] = self.scan(cards.get(card, []), rows, hits)
        kept = {c: ops for c, ops in cards.items() if ops[-1][2] + self.seconds > second}
        if kept != before:
            if kept:
                self.last.put([(c, i, *op) for c, ops in kept.items() for i, op in enumerate(ops)])
            else:
                self.last.clear()
        return max(ops[-1][2] for ops in kept.values()) + self.seconds if kept else None

    def scan(self, last: list[tuple], rows: list[dict], hits: list[dict]) -> list[tuple]:
        for r in rows:
            cents = None if r["cents"] is None else int(r["cents"])
            chain_ = last[-self.n:] + [(r["oper_result"], cents, r["sec"])]
            if len(chain_) > self.n and r["oper_result"] == SUCCESS \
                    and all(x[0] == REJECT for x in chain_[:-1]) \
                    and all(x[1] is not None for x in chain_) \
                    and all(a[1] > b[1] for a, b in zip(chain_, chain_[1:])) and r["sec"] - chain_[0][2] <= self.seconds:
                hits.append(r)
            last = chain_[-self.n:]
        return last


class CityHop(_InOrder):
    def __init__(self, seconds: int) -> None:
        self.seconds = seconds

    def open_kept(self) -> None:
        self.cities = self.handle.getMapState("cities", "client string, city string", "sec long")

    def handleInitialState(self, key, initialState, timerValues) -> None:
        for client, city, sec in zip(*(initialState[c].tolist() for c in ("key", "city", "sec"))):
            self.cities.updateValue((client, city), (sec,))
        self.handle.registerTimer((int(initialState["sec"].max()) + self.seconds + 1) * 1000)

    def take(self, ready: pa.Table, second: int, hits: list[dict]) -> int | None:
        """Scan the ready operations and keep what can still match after ``second``;
        gives the last second at which it can."""
        before = {(k[0], k[1]): v[0] for k, v in self.cities.iterator()}
        clients: dict[str, dict[str, int]] = {}
        for (client, city), sec in before.items():
            clients.setdefault(client, {})[city] = sec
        for client, rows in runs(ready):
            clients[client] = self.scan(clients.get(client, {}), rows, hits)
        kept = {(client, city): sec for client, seen in clients.items() for city, sec in seen.items()
                if sec + self.seconds > second}
        if not kept and before:
            self.cities.clear()
        elif kept:
            for place in before.keys() - kept.keys():
                self.cities.removeKey(place)
            for place, sec in kept.items():
                if before.get(place) != sec:
                    self.cities.updateValue(place, (sec,))
        return max(kept.values()) + self.seconds if kept else None

    def scan(self, seen: dict[str, int], rows: list[dict], hits: list[dict]) -> dict[str, int]:
        at = 0
        while at < len(rows):
            end = at
            while end < len(rows) and rows[end]["sec"] == rows[at]["sec"]:
                end += 1
            sec = rows[at]["sec"]
            seen = seen | {r["terminal_city"]: sec for r in rows[at:end] if r["terminal_city"] is not None}
            seen = {c: s for c, s in seen.items() if s >= sec - self.seconds}
            hits += [r for r in rows[at:end] if r["terminal_city"] is not None and len(seen) > 1]
            at = end
        return seen


def _operations(wh: Warehouse, tx: DataFrame, as_of) -> DataFrame:
    rows = chain.with_terminal(chain.ownership_chain(wh, tx), chain.current_terminals(wh, as_of))
    return rows.withColumns({"ts": F.date_format("trans_date", TIME_FORMAT), "sec": F.unix_timestamp("trans_date"),
                             "city": F.col("terminal_city"),
                             "cents": F.round(F.col("amt") * 100).cast("long")})


def _run(rows: DataFrame, key: str, processor: StatefulProcessor, initial: DataFrame | None, event_type: str,
         report_dt) -> DataFrame:
    ship_package(rows.sparkSession)
    rows = rows.withColumns({"key": F.col(key), "group": group_of(key), "cents": F.col("cents").cast("string")})
    if initial is not None:
        initial = initial.withColumn("group", group_of("key")).groupBy("group")
    out = rows.select("group", "event_time", "sec", *TEXTS).groupBy("group").transformWithStateInPandas(
        processor, OUT, "append", "EventTime", initialState=initial)
    return out.select("trans_id", "client_id", _time("ts").alias("event_dt"), F.col("passport_num").alias("passport"),
                      "fio", "phone", F.lit(event_type).alias("event_type"), date_lit(report_dt).alias("report_dt"),
                      _time("established").alias("established_dt"))


def _time(name: str) -> Column:
    return F.col(name).cast(schemas.TS)


def guess_state(wh: Warehouse, as_of=None, n_rejects: int = schemas.AMOUNT_GUESS_REJECTS) -> DataFrame:
    """``key``, ``last``: the last operations of each card in the fact. One small array
    per card, kept by an aggregate that holds no more than ``n_rejects`` rows."""
    tx = wh.transactions.filter(F.col("trans_date").isNotNull()
                                & F.col("oper_type").isin(schemas.TYPE_WITHDRAW, schemas.TYPE_PAYMENT))
    rows = _operations(wh, tx, as_of)
    newest = Window.partitionBy("card_num").orderBy(F.desc("ts"), F.desc("trans_id"), F.desc("city"))
    rows = rows.withColumn("_at", F.row_number().over(newest)).filter(F.col("_at") <= n_rejects)
    last = F.array_sort(F.collect_list(F.struct(-F.col("_at"), "oper_result", "cents", "sec")))
    return rows.groupBy(F.col("card_num").alias("key")).agg(
        F.transform(last, lambda x: F.struct(x["oper_result"], x["cents"], x["sec"])).alias("last"))


def hop_state(wh: Warehouse, as_of=None, seconds: int = schemas.CITY_HOP_SECONDS) -> DataFrame:
    """``key``, ``seen``: per client the last second of each city within ``seconds`` of its
    last operation."""
    tx = wh.transactions.filter(F.col("trans_date").isNotNull() & (F.col("oper_result") == schemas.RESULT_SUCCESS))
    cities = (_operations(wh, tx, as_of).filter("city is not null").groupBy(F.col("client_id").alias("key"), "city")
              .agg(F.max("sec").alias("sec")))
    newest = F.max("sec").over(Window.partitionBy("key"))
    return (cities.withColumn("_newest", newest).filter(F.col("sec") >= F.col("_newest") - seconds)
            .groupBy("key").agg(F.collect_list(F.struct("city", "sec")).alias("seen")))


def stream_amount_guess_typed(wh: Warehouse, tx_stream: DataFrame, report_dt, as_of=None,
                              n_rejects: int = schemas.AMOUNT_GUESS_REJECTS,
                              seconds: int = schemas.AMOUNT_GUESS_SECONDS, delay: str = "1 hour",
                              initial: DataFrame | None = None) -> DataFrame:
    """Rule 4 on a stream, per card."""
    tx = watermarked(tx_stream, delay).filter(F.col("oper_type").isin(schemas.TYPE_WITHDRAW, schemas.TYPE_PAYMENT))
    if initial is not None:
        initial = initial.select("key", F.posexplode("last").alias("at", "op")).select(
            "key", "at", "op.oper_result", F.col("op.cents").cast("string").alias("cents"), "op.sec")
    return _run(_operations(wh, tx, as_of), "card_num", AmountGuess(n_rejects, seconds), initial,
                schemas.EVENT_AMOUNT_GUESS, report_dt)


def stream_city_hop_typed(wh: Warehouse, tx_stream: DataFrame, report_dt, as_of=None,
                          seconds: int = schemas.CITY_HOP_SECONDS, delay: str = "1 hour",
                          initial: DataFrame | None = None) -> DataFrame:
    """Rule 3, any pair, on a stream, per client."""
    tx = watermarked(tx_stream, delay).filter(F.col("oper_result") == schemas.RESULT_SUCCESS)
    if initial is not None:
        initial = initial.select("key", F.inline("seen"))
    return _run(_operations(wh, tx, as_of), "client_id", CityHop(seconds), initial, schemas.EVENT_CITY_HOP, report_dt)
