"""Rules 3 (adjacent pairs or any pair) and 4 on a transaction stream,
with keyed state; ``stream_sequence_rules`` runs 3 and 4 in one operator
(a streaming query takes one applyInPandasWithState).

Neighbours in a stream are only final once no earlier operation can still
arrive, so each key (client or card) buffers its rows in state until the
watermark passes them, then scans them in (trans_date, trans_id) order.
What the scan keeps between rows is small and bounded: the last n operations
of a card (rule 4), or the last time each city was seen within the look-back
(rule 3). State of a key is dropped once the watermark has moved past
everything it could still match.

Python is called per group, not per key: keys are dealt by hash into ``GROUPS``
groups, a group's waiting rows are one Arrow table and its keys are scanned one
after the other. Calls, timers and state reads then do not grow with the number
of clients or cards.

The inputs are the same joins as in batch (stream-static joins to the owner
dimension and the current terminals), so a finished stream gives the batch
answer, provided no row is later than the watermark delay.
"""

from __future__ import annotations

import copy
import decimal
import json
from collections.abc import Callable, Iterator

import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from fraudmart import schemas
from fraudmart.functions import date_lit
from fraudmart.operators import chain
from fraudmart.session import ship_package
from fraudmart.streaming.ingest import watermarked
from fraudmart.streaming.packed import GROUPS, fresh, group_of, pack, runs, unpack
from fraudmart.warehouse import Warehouse

OUT = T.StructType([T.StructField("trans_id", T.StringType()), T.StructField("client_id", T.StringType()),
                    T.StructField("event_dt", schemas.TS), T.StructField("passport", T.StringType()),
                    T.StructField("fio", T.StringType()), T.StructField("phone", T.StringType()),
                    T.StructField("established_dt", schemas.TS)])
STATE = T.StructType([T.StructField("pending", T.BinaryType()), T.StructField("tails", T.StringType())])
TIME_FORMAT = "yyyy-MM-dd HH:mm:ss.SSSSSS"
PASS = ["trans_id", "client_id", "passport_num", "fio", "phone"]
Step = Callable[[object, list[dict]], tuple[list[dict], object, int | None]]


def _emit(hits: list[dict], with_event_type: bool = False) -> pd.DataFrame:
    out = pd.DataFrame({
        "trans_id": [h["trans_id"] for h in hits], "client_id": [h["client_id"] for h in hits],
        "event_dt": pd.to_datetime([h["ts"] for h in hits]),
        "passport": [h["passport_num"] for h in hits], "fio": [h["fio"] for h in hits],
        "phone": [h["phone"] for h in hits],
        # the first operation of a pair is established by the second
        "established_dt": pd.to_datetime([h.get("by", h["ts"]) for h in hits])})
    if with_event_type:
        out["event_type"] = [h["event_type"] for h in hits]
    return out


def _ordered_scan(step: Step, init, schema: pa.Schema, with_event_type: bool = False):
    """Wrap a row scanner of one key into an ``applyInPandasWithState`` function over a
    group of keys."""
    def fn(_, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        held, tails = [], {}
        if state.exists:
            pending, kept = state.get
            if pending is not None:
                held = [unpack(pending)]
            tails = {k: (tail, live) for k, tail, live in json.loads(kept)}
        wm = state.getCurrentWatermarkMs()
        if not state.hasTimedOut:
            held += fresh(frames, schema, wm)
        rows = pa.concat_tables(held) if held else schema.empty_table()
        passed = pc.less_equal(rows["sec"], wm // 1000)
        hits = []
        for k, ready in runs(rows.filter(passed)):
            tail = tails[k][0] if k in tails else copy.deepcopy(init)  # never share the initial object
            found, tail, live = step(tail, ready)
            hits += found
            tails[k] = (tail, live)
        tails = {k: t for k, t in tails.items() if t[1] is not None and t[1] > wm}
        keep = rows.filter(pc.invert(passed))
        if len(keep) or tails:
            state.update((pack(keep) if len(keep) else None, json.dumps([[k, *t] for k, t in tails.items()])))
            due = pc.min(keep["sec"]).as_py() * 1000 if len(keep) else max(live for _, live in tails.values())
            state.setTimeoutTimestamp(max(due, wm + 1))
        elif state.exists:
            state.remove()
        if hits:
            yield _emit(hits, with_event_type)
    return fn


def amount_guess_step(n_rejects: int, seconds: int) -> Step:
    """Rule 4 scan over one card: the tail is the last n operations."""
    def step(tail, rows):
        hits = []
        for r in rows:
            prev = tail[::-1][:n_rejects]  # prev1 .. prevn
            if r["oper_result"] == schemas.RESULT_SUCCESS and len(prev) == n_rejects and r["amt"] is not None:
                ok = all(p[0] == schemas.RESULT_REJECT and p[1] is not None for p in prev)
                if ok:
                    amts = [decimal.Decimal(r["amt"])] + [decimal.Decimal(p[1]) for p in prev]
                    ok = all(amts[i] < amts[i + 1] for i in range(n_rejects))
                    ok = ok and abs(r["sec"] - prev[-1][2]) <= seconds
                if ok:
                    hits.append(r)
            tail = (tail + [[r["oper_result"], r["amt"], r["sec"]]])[-n_rejects:]
        live = (tail[-1][2] + seconds + 1) * 1000 if tail else None
        return hits, tail, live
    return step


def city_hop_step(lookback: int) -> Step:
    """Rule 3 (any pair) scan over one client: the tail maps each city to
    the last second it was seen, pruned to the look-back."""
    def step(tail, rows):
        hits, i = [], 0
        while i < len(rows):
            j = i
            while j < len(rows) and rows[j]["sec"] == rows[i]["sec"]:
                j += 1
            group, sec = rows[i:j], rows[i]["sec"]
            cities = {r["terminal_city"] for r in group if r["terminal_city"] is not None}
            for r in group:
                c = r["terminal_city"]
                if c is None:
                    continue
                if len(cities) > 1 or any(k != c and s >= sec - lookback for k, s in tail.items()):
                    hits.append(r)
            for c in cities:
                tail[c] = sec
            tail = {k: s for k, s in tail.items() if s >= sec - lookback}
            i = j
        live = (max(tail.values()) + lookback + 1) * 1000 if tail else None
        return hits, tail, live
    return step


def city_hop_adjacent_step(seconds: int, emit: str = "both") -> Step:
    """Rule 3 as the batch rule: neighbouring operations of one client in
    different cities at most ``seconds`` apart. The tail is the last
    operation (with whether it was reported already); with ``emit="both"``
    the earlier operation of a pair is reported when its successor arrives."""
    def step(tail, rows):
        hits = []
        last = tail.get("last")
        for r in rows:
            r = dict(r, done=False)
            if (last is not None and r["terminal_city"] is not None and last["terminal_city"] is not None
                    and r["terminal_city"] != last["terminal_city"] and abs(r["sec"] - last["sec"]) <= seconds):
                hits.append(r)
                r["done"] = True
                if emit == "both" and not last["done"]:
                    hits.append(dict(last, by=r["ts"]))
                    last["done"] = True
            last = r
        tail = {"last": last}
        live = (last["sec"] + seconds + 1) * 1000 if last is not None else None
        return hits, tail, live
    return step


def sequence_rules_step(hop_seconds: int, emit: str, n_rejects: int, guess_seconds: int) -> Step:
    """Rules 3 and 4 in one scan over a client's operations (a streaming
    query takes one applyInPandasWithState only): successes feed the city
    hop, withdrawals/payments feed one amount-guess tail per card."""
    hop = city_hop_adjacent_step(hop_seconds, emit)
    guess = amount_guess_step(n_rejects, guess_seconds)

    def step(tail, rows):
        hop_tail, cards, hits = tail.get("hop", {}), tail.get("cards", {}), []
        succ = [r for r in rows if r["oper_result"] == schemas.RESULT_SUCCESS]
        if succ:
            h, hop_tail, _ = hop(hop_tail, succ)
            hits += [dict(x, event_type=schemas.EVENT_CITY_HOP) for x in h]
        by_card: dict[str, list[dict]] = {}
        for r in rows:
            if r["oper_type"] in (schemas.TYPE_WITHDRAW, schemas.TYPE_PAYMENT):
                by_card.setdefault(r["card_num"], []).append(r)
        for card, rs in by_card.items():
            h, cards[card], _ = guess(cards.get(card, []), rs)
            hits += [dict(x, event_type=schemas.EVENT_AMOUNT_GUESS) for x in h]
        ends = [t[-1][2] + guess_seconds for t in cards.values() if t]
        if hop_tail.get("last"):
            ends.append(hop_tail["last"]["sec"] + hop_seconds)
        live = (max(ends) + 1) * 1000 if ends else None
        return hits, {"hop": hop_tail, "cards": cards}, live
    return step


def _keyed(rows: DataFrame, key: str, step: Step, init, value_cols: list[str],
           with_event_type: bool = False, groups: int = GROUPS) -> DataFrame:
    ship_package(rows.sparkSession)
    texts = ["key", *PASS, "ts", *value_cols]
    schema = pa.schema([*((c, pa.string()) for c in texts), ("sec", pa.int64())])
    rows = rows.withColumns({"key": F.col(key), "ts": F.date_format("trans_date", TIME_FORMAT),
                             "sec": F.unix_timestamp("trans_date"), "group": group_of(key, groups)})
    out = T.StructType(list(OUT.fields) + ([T.StructField("event_type", T.StringType())]
                                           if with_event_type else []))
    return (rows.select("group", "event_time", "sec", *texts).groupBy("group")
            .applyInPandasWithState(_ordered_scan(step, init, schema, with_event_type), out, STATE,
                                    "append", GroupStateTimeout.EventTimeTimeout))


def _report(df: DataFrame, event_type: str, report_dt) -> DataFrame:
    return df.select(*OUT.fieldNames(), F.lit(event_type).alias("event_type"),
                     date_lit(report_dt).alias("report_dt"))


def stream_amount_guess(wh: Warehouse, tx_stream: DataFrame, report_dt, as_of=None,
                        n_rejects: int = schemas.AMOUNT_GUESS_REJECTS,
                        seconds: int = schemas.AMOUNT_GUESS_SECONDS,
                        delay: str = "1 hour") -> DataFrame:
    tx = watermarked(tx_stream, delay).filter(
        F.col("oper_type").isin(schemas.TYPE_WITHDRAW, schemas.TYPE_PAYMENT))
    rows = chain.with_terminal(chain.ownership_chain(wh, tx), chain.current_terminals(wh, as_of))
    rows = rows.withColumn("amt", F.col("amt").cast("string"))
    out = _keyed(rows, "card_num", amount_guess_step(n_rejects, seconds), [], ["oper_result", "amt"])
    return _report(out, schemas.EVENT_AMOUNT_GUESS, report_dt)


def stream_city_hop(wh: Warehouse, tx_stream: DataFrame, report_dt, as_of=None, emit: str = "both",
                    seconds: int = schemas.CITY_HOP_SECONDS, delay: str = "1 hour") -> DataFrame:
    """Rule 3 (neighbouring operations, both or later) on a stream."""
    tx = watermarked(tx_stream, delay).filter(F.col("oper_result") == schemas.RESULT_SUCCESS)
    rows = chain.with_terminal(chain.ownership_chain(wh, tx), chain.current_terminals(wh, as_of))
    out = _keyed(rows, "client_id", city_hop_adjacent_step(seconds, emit), {}, ["terminal_city"])
    return _report(out, schemas.EVENT_CITY_HOP, report_dt)


def stream_sequence_rules(wh: Warehouse, tx_stream: DataFrame, report_dt, as_of=None,
                          emit: str = "both", hop_seconds: int = schemas.CITY_HOP_SECONDS,
                          n_rejects: int = schemas.AMOUNT_GUESS_REJECTS,
                          guess_seconds: int = schemas.AMOUNT_GUESS_SECONDS,
                          delay: str = "1 hour") -> DataFrame:
    """Rules 3 and 4 together on a stream, one keyed state per client."""
    tx = watermarked(tx_stream, delay).filter(
        (F.col("oper_result") == schemas.RESULT_SUCCESS)
        | F.col("oper_type").isin(schemas.TYPE_WITHDRAW, schemas.TYPE_PAYMENT))
    rows = chain.with_terminal(chain.ownership_chain(wh, tx), chain.current_terminals(wh, as_of))
    rows = rows.withColumn("amt", F.col("amt").cast("string"))
    out = _keyed(rows, "client_id", sequence_rules_step(hop_seconds, emit, n_rejects, guess_seconds), {},
                 ["terminal_city", "oper_result", "oper_type", "amt", "card_num"], with_event_type=True)
    return out.select(*OUT.fieldNames(), "event_type", date_lit(report_dt).alias("report_dt"))


def stream_city_hop_any_pair(wh: Warehouse, tx_stream: DataFrame, report_dt, as_of=None,
                             seconds: int = schemas.CITY_HOP_SECONDS, delay: str = "1 hour") -> DataFrame:
    tx = watermarked(tx_stream, delay).filter(F.col("oper_result") == schemas.RESULT_SUCCESS)
    rows = chain.with_terminal(chain.ownership_chain(wh, tx), chain.current_terminals(wh, as_of))
    out = _keyed(rows, "client_id", city_hop_step(seconds), {}, ["terminal_city"])
    return _report(out, schemas.EVENT_CITY_HOP, report_dt)
