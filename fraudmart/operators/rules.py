"""The four fraud rules.

Each rule returns report rows (event_dt, passport, fio, phone, event_type,
report_dt) plus ``trans_id`` and ``client_id`` of the reported operation and
``established_dt``, the time of the operation that established the event (later
than the event for the first operation of a pair); ``report_rows`` projects to
the mart's columns.

Choices where the original's behaviour is undefined (its windows have no
partition and no stable order): neighbours are taken per client (rule 3) or
per card (rule 4), ordered by (trans_date, trans_id). Status and type filters
run before the windows, since they decide which operations are adjacent.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fraudmart import schemas
from fraudmart.functions import date_lit, epoch_seconds
from fraudmart.operators import chain
from fraudmart.operators.sequence import DEFAULT_BUCKET_SECONDS, context_buckets, recent_other_value
from fraudmart.warehouse import Warehouse

#: What the report says of an operation's owner.
_OWNER = ["client_id", "passport_num", "fio", "phone"]
#: Order of neighbours; the city decides between the rows of one operation whose
#: terminal has several current rows.
_ORDER = ["trans_date", "trans_id", "terminal_city"]


def _emit(rows: DataFrame, event_type: str, report_dt, ts: str = "trans_date") -> DataFrame:
    return rows.select(
        "trans_id", "client_id",
        F.col(ts).alias("event_dt"),
        F.col("passport_num").alias("passport"),
        "fio", "phone",
        F.lit(event_type).alias("event_type"),
        date_lit(report_dt).alias("report_dt"),
        F.col(ts).alias("established_dt"),
    )


def report_rows(df: DataFrame) -> DataFrame:
    return df.select(*schemas.REPORT_COLUMNS)


def _success(wh: Warehouse) -> DataFrame:
    return chain.v_transactions(wh).filter(F.col("oper_result") == schemas.RESULT_SUCCESS)


def fraud_passport(wh: Warehouse, report_dt=None, as_of=None,
                   distinct_events: bool = False) -> DataFrame:
    """Rule 1: a successful operation while the passport is expired
    (passport_valid_to <= trans_date) or blacklisted (entry_dt <= trans_date).
    One row per matching blacklist entry, as the left join gives."""
    listed = chain.current_blacklist(wh, as_of)
    if distinct_events:  # the earliest entry decides; no fan-out to undo later
        listed = listed.groupBy("passport_num").agg(F.min("entry_dt").alias("entry_dt"))
    owners = chain.with_blacklist(wh.owners, listed)
    # Cards whose owner has neither an expiry date nor a blacklist entry can
    # never match; dropping them here shrinks the big join's dimension side.
    owners = owners.filter(F.col("entry_dt").isNotNull() | F.col("passport_valid_to").isNotNull())
    rows = chain.ownership_chain(wh, _success(wh), owners)
    rows = rows.filter((F.col("entry_dt") <= F.col("trans_date"))
                       | (F.col("passport_valid_to") <= F.col("trans_date")))
    return _emit(rows, schemas.EVENT_PASSPORT, report_dt)


def fraud_contract(wh: Warehouse, report_dt=None) -> DataFrame:
    """Rule 2: a successful operation on an account whose contract ended
    (valid_to <= trans_date; the end day itself counts from midnight)."""
    owners = wh.owners.filter(F.col("valid_to").isNotNull())
    rows = chain.ownership_chain(wh, _success(wh), owners)
    rows = rows.filter(F.col("valid_to") <= F.col("trans_date"))
    return _emit(rows, schemas.EVENT_CONTRACT, report_dt)


def _locate(rows: DataFrame, wh: Warehouse, as_of, point_in_time: bool | str) -> DataFrame:
    """Attach the terminal: the one current at ``as_of`` (as the original
    does), or with ``point_in_time`` the one valid at the operation's time
    (``"merge"``: found by sorted merge, for large histories)."""
    if point_in_time:
        by_merge = point_in_time == "merge"
        return (chain.with_terminal_as_of if by_merge else chain.with_terminal_at_event)(rows, wh.terminals)
    return chain.with_terminal(rows, chain.current_terminals(wh, as_of))


def _locate_left(rows: DataFrame, wh: Warehouse, as_of, point_in_time: bool) -> DataFrame:
    """As ``_locate`` but keeping operations at unknown terminals
    (``_located`` false). An operation with several current terminal rows
    appears once for each; ``_first`` marks one of them. Terminals come as one
    array per id, so the big side is joined and grouped nowhere."""
    if point_in_time:
        t = chain.merged_intervals(wh.terminals).filter(F.col("deleted_flg") == 0)
        spans = t.groupBy(F.col("terminal_id").alias("_tid")).agg(F.collect_list(F.struct(
            "terminal_type", "terminal_city", "effective_from", "effective_to")).alias("_t"))
        rows = rows.join(spans, F.col("terminal") == F.col("_tid"), "left")
        match = F.filter("_t", lambda x: (F.col("trans_date") >= x["effective_from"])
                         & (F.col("trans_date") < x["effective_to"] + F.expr("INTERVAL 1 SECOND")))
    else:
        spans = chain.current_terminals(wh, as_of).groupBy(F.col("terminal_id").alias("_tid")).agg(
            F.collect_list(F.struct("terminal_type", "terminal_city")).alias("_t"))
        rows = rows.join(spans, F.col("terminal") == F.col("_tid"), "left")
        match = F.col("_t")
    out = rows.withColumn("_m", match).select(
        *rows.drop("_t", "_tid").columns, F.posexplode_outer("_m").alias("_at", "_x"))
    return (out.withColumn("_located", F.col("_x").isNotNull())
            .withColumn("_first", F.coalesce(F.col("_at"), F.lit(0)) == 0)
            .withColumn("terminal_city", F.col("_x.terminal_city")).drop("_at", "_x"))


def located_successes(wh: Warehouse, as_of=None, point_in_time: bool = False) -> DataFrame:
    """Successful operations of known clients at a known terminal."""
    rows = _locate(chain.ownership_chain(wh, _success(wh)), wh, as_of, point_in_time)
    return rows.withColumn("_sec", epoch_seconds("trans_date"))


def _hop_events(rows: DataFrame, seconds: int, emit: str, key: Column | None = None) -> DataFrame:
    """Add ``hop_later`` (this operation follows one in another city within
    ``seconds``), and for ``emit="both"`` ``hop_earlier``: the id and time of the
    previous operation when the pair reports it and no earlier pair has. Rows
    carry ``_cb_bucket`` with a context of twice ``seconds``; ``key`` marks the rows
    that take part."""
    parts = ["client_id", "_cb_bucket"] + ([key] if key is not None else [])
    w = Window.partitionBy(*parts).orderBy(*_ORDER)
    rows = rows.withColumns({"_p_city": F.lag("terminal_city").over(w), "_p_sec": F.lag("_sec").over(w),
                             "_p_id": F.lag("trans_id").over(w), "_p_ts": F.lag("trans_date").over(w)})
    hit = F.coalesce((F.col("terminal_city") != F.col("_p_city"))
                     & (F.col("_sec") - F.col("_p_sec") <= seconds), F.lit(False))
    if key is not None:
        hit = hit & key
    rows = rows.withColumn("hop_later", hit)
    if emit == "both":
        fresh = F.col("hop_later") & ~F.coalesce(F.lag("hop_later").over(w), F.lit(False))
        rows = rows.withColumn("hop_earlier", F.when(fresh, F.struct(
            F.col("_p_id").alias("trans_id"), F.col("_p_ts").alias("trans_date"))))
    return rows.drop("_p_city", "_p_sec", "_p_id", "_p_ts")


def _event(event_type: str, trans_id: str = "trans_id", ts: str = "trans_date") -> Column:
    return F.struct(F.col(trans_id).alias("trans_id"), F.col(ts).alias("event_dt"), F.lit(event_type).alias("event_type"))


def _who() -> Column:
    """Stands for the owner's texts while operations are shuffled: eight bytes. The texts
    of one client differ only where the clients table repeats an id."""
    return F.xxhash64(*_OWNER)


def _texts(owners: DataFrame) -> DataFrame:
    return owners.select(F.col("client_id").alias("_client"), _who().alias("_texts"), *_OWNER[1:]).distinct()


def _report_events(rows: DataFrame, events: Column, report_dt, owners: DataFrame) -> DataFrame:
    """Explode ``events`` (structs of ``_event``) to report rows; an event is
    established by the operation whose row carries it. Only events meet the owners'
    texts; the operations carry ``client_id`` and ``_who``."""
    found = rows.select("client_id", "_who", F.col("trans_date").alias("established_dt"), F.explode(events).alias("e"))
    t = _texts(owners)
    return (found.join(t, (F.col("client_id") == F.col("_client")) & (F.col("_who") == F.col("_texts")))
            .select("e.trans_id", "client_id", "e.event_dt", F.col("passport_num").alias("passport"), "fio", "phone",
                    "e.event_type", date_lit(report_dt).alias("report_dt"), "established_dt"))


def _hop_array(emit: str) -> Column:
    none = F.array().cast("array<struct<trans_id:string,event_dt:timestamp_ntz,event_type:string>>")
    out = F.when(F.col("hop_later"), F.array(_event(schemas.EVENT_CITY_HOP))).otherwise(none)
    if emit == "both":
        out = F.concat(out, F.when(F.col("hop_earlier").isNotNull(), F.array(_event(
            schemas.EVENT_CITY_HOP, "hop_earlier.trans_id", "hop_earlier.trans_date"))).otherwise(none))
    return out


def fraud_city_hop(wh: Warehouse, report_dt=None, as_of=None, emit: str = "both",
                   seconds: int = schemas.CITY_HOP_SECONDS,
                   bucket_seconds: int = DEFAULT_BUCKET_SECONDS,
                   point_in_time: bool = False) -> DataFrame:
    """Rule 3: neighbouring successful operations of one client in different
    cities at most ``seconds`` apart. ``emit="both"`` reports both operations
    of a pair, as the original query does; ``"later"`` only the one that
    establishes the event. An operation without a city takes part as a
    neighbour but makes no pair.

    The gap is bounded, so time buckets with a context of twice ``seconds`` (a
    pair, and the pair before it) decide it in one shuffle."""
    if emit not in ("both", "later"):
        raise ValueError("emit must be 'both' or 'later'")
    rows = located_successes(wh, as_of, point_in_time).select(
        "client_id", _who().alias("_who"), *_ORDER, "_sec")
    rows = context_buckets(rows, "_sec", 2 * seconds, bucket_seconds)
    # explicit: input partitioned by the client alone would satisfy the window
    rows = _hop_events(rows.repartition("client_id", "_cb_bucket"), seconds, emit).filter("_cb_native")
    return _report_events(rows, _hop_array(emit), report_dt, wh.owners)


def city_hop_any_pair(wh: Warehouse, report_dt=None, as_of=None,
                      seconds: int = schemas.CITY_HOP_SECONDS,
                      bucket_seconds: int = DEFAULT_BUCKET_SECONDS,
                      point_in_time: bool = False, emit: str = "later") -> DataFrame:
    """Rule 3 as its text reads: an operation is reported when the same client
    made any successful operation in another city at most ``seconds`` earlier
    (or in the same second), adjacent or not. ``emit="both"`` also reports the
    earlier operations of such pairs."""
    if emit not in ("later", "both"):
        raise ValueError("emit must be 'later' or 'both'")
    rows = located_successes(wh, as_of, point_in_time)
    rows = recent_other_value(rows, ["client_id"], "_sec", "terminal_city", seconds, bucket_seconds,
                              lookahead_seconds=seconds if emit == "both" else 0)
    return _emit(rows, schemas.EVENT_CITY_HOP, report_dt)


def _guess_hit(rows: DataFrame, n_rejects: int, seconds: int, key: Column | None = None) -> DataFrame:
    """Add ``guess``: this success ends a chain of rule 4. Rows carry
    ``_cb_bucket`` with a context of at least ``seconds``."""
    parts = ["client_id", "card_num", "_cb_bucket"] + ([key] if key is not None else [])
    w = Window.partitionBy(*parts).orderBy(*_ORDER)
    hit = F.col("oper_result") == schemas.RESULT_SUCCESS
    if key is not None:
        hit = hit & key
    later = F.col("amt")
    for j in range(1, n_rejects + 1):
        amt = F.lag("amt", j).over(w)
        hit = hit & (F.lag("oper_result", j).over(w) == schemas.RESULT_REJECT) & (later < amt)
        later = amt
    hit = hit & (F.col("_sec") - F.lag("_sec", n_rejects).over(w) <= seconds)
    return rows.withColumn("guess", F.coalesce(hit, F.lit(False)))


def fraud_amount_guess(wh: Warehouse, report_dt=None, as_of=None,
                       n_rejects: int = schemas.AMOUNT_GUESS_REJECTS,
                       seconds: int = schemas.AMOUNT_GUESS_SECONDS,
                       bucket_seconds: int = DEFAULT_BUCKET_SECONDS,
                       point_in_time: bool = False) -> DataFrame:
    """Rule 4: on one card, ``n_rejects`` rejected withdrawals/payments with
    strictly falling amounts, then a success with a still smaller amount, the
    first and last at most ``seconds`` apart. Only the success is reported."""
    tx = chain.v_transactions(wh).filter(
        F.col("oper_type").isin(schemas.TYPE_WITHDRAW, schemas.TYPE_PAYMENT))
    rows = _locate(chain.ownership_chain(wh, tx), wh, as_of, point_in_time).select(
        "client_id", _who().alias("_who"), "card_num", *_ORDER, "amt", "oper_result",
        epoch_seconds("trans_date").alias("_sec"))
    rows = context_buckets(rows, "_sec", seconds, bucket_seconds)
    rows = _guess_hit(rows.repartition("client_id", "_cb_bucket"), n_rejects, seconds).filter("_cb_native and guess")
    return _report_events(rows, F.array(_event(schemas.EVENT_AMOUNT_GUESS)), report_dt, wh.owners)


def all_rules(wh: Warehouse, report_dt=None, as_of=None, city_hop_emit: str = "both",
              point_in_time: bool = False, distinct_events: bool = False,
              bucket_seconds: int = DEFAULT_BUCKET_SECONDS) -> DataFrame:
    """The four rules' rows, duplicates kept (UNION ALL), from one scan.

    Operations that some rule can use are joined to their owner once and to
    their terminal once. Rules 1 and 2 are predicates of the row (a passport's
    blacklist entries come as one array per owner); rules 3 and 4 are windows
    over the same client and time bucket, each over its own rows. Each row then
    gives the array of its events."""
    success = F.col("oper_result") == schemas.RESULT_SUCCESS
    guessable = F.col("oper_type").isin(schemas.TYPE_WITHDRAW, schemas.TYPE_PAYMENT)
    entries = (chain.current_blacklist(wh, as_of).groupBy(F.col("passport_num").alias("_bl"))
               .agg(F.collect_list("entry_dt").alias("_entries"), F.count("*").cast("int").alias("_known")))
    owners = wh.owners.join(entries, F.col("passport_num") == F.col("_bl"), "left").drop("_bl")
    rows = chain.ownership_chain(wh, chain.v_transactions(wh).filter(success | guessable), owners)
    # rules 1 and 2 are decided by the row alone: two numbers go on instead of the owner
    expired = F.coalesce(F.col("passport_valid_to") <= F.col("trans_date"), F.lit(False))
    listed = F.coalesce(F.size(F.filter("_entries", lambda d: d <= F.col("trans_date"))), F.lit(0))
    n1 = F.when(expired, F.greatest(F.lit(1), F.col("_known"))).otherwise(F.greatest(listed, F.lit(0)))
    if distinct_events:
        n1 = F.least(n1, F.lit(1))
    n2 = F.coalesce((F.col("valid_to") <= F.col("trans_date")).cast("int"), F.lit(0))
    rows = rows.select("client_id", _who().alias("_who"), "card_num", "terminal", "trans_date", "trans_id", "amt", "oper_result",
                       success.alias("_success"), guessable.alias("_guessable"),
                       F.when(success, n1).otherwise(0).alias("_n1"), F.when(success, n2).otherwise(0).alias("_n2"))
    located = _locate_left(rows, wh, as_of, point_in_time).drop("terminal")
    rows = context_buckets(located.withColumn("_sec", epoch_seconds("trans_date")), "_sec",
                           max(2 * schemas.CITY_HOP_SECONDS, schemas.AMOUNT_GUESS_SECONDS), bucket_seconds)
    # operations without a time can only meet rules 1 and 2, which they fail
    rows = rows.filter(F.col("_sec").isNotNull()).repartition("client_id", "_cb_bucket")
    # one row per current terminal row; rules 1 and 2 count an operation once
    hop, guess = F.col("_success") & F.col("_located"), F.col("_guessable") & F.col("_located")
    rows = _hop_events(rows, schemas.CITY_HOP_SECONDS, city_hop_emit, hop)
    rows = _guess_hit(rows, schemas.AMOUNT_GUESS_REJECTS, schemas.AMOUNT_GUESS_SECONDS, guess).filter("_cb_native")
    events = F.concat(
        F.array_repeat(_event(schemas.EVENT_PASSPORT), F.when(F.col("_first"), F.col("_n1")).otherwise(0)),
        F.array_repeat(_event(schemas.EVENT_CONTRACT), F.when(F.col("_first"), F.col("_n2")).otherwise(0)),
        _hop_array(city_hop_emit),
        F.array_repeat(_event(schemas.EVENT_AMOUNT_GUESS), F.col("guess").cast("int")))
    return _report_events(rows, events, report_dt, wh.owners)


def default_report_dt() -> _dt.date:
    return _dt.datetime.now(_dt.timezone.utc).date()
