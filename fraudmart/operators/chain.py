"""The ownership chain client -> account -> card -> transaction and its joins.

The dimensions are joined to each other first (one row per card), so the
large transaction fact meets a single card-level dimension in one equi-join.
No side is forced into a broadcast: Spark's size check
(``autoBroadcastJoinThreshold``, re-checked at runtime by AQE with real
sizes) broadcasts a small dimension and falls back to a sort-merge join
otherwise; AQE splits a skewed card or terminal partition.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fraudmart.functions import full_name
from fraudmart.operators.asof import asof_join
from fraudmart.operators.history import as_of
from fraudmart.warehouse import Warehouse


def v_cards(wh: Warehouse) -> DataFrame:
    return wh.cards.select("card_num", "account")


def v_accounts(wh: Warehouse) -> DataFrame:
    return wh.accounts.select("account", "valid_to", "client")


def v_clients(wh: Warehouse) -> DataFrame:
    return wh.clients.select("client_id", "last_name", "first_name", "patronymic",
                             "date_of_birth", "passport_num", "passport_valid_to", "phone")


def v_transactions(wh: Warehouse) -> DataFrame:
    return wh.transactions.select("trans_id", "trans_date", "card_num", "oper_type", "amt",
                                  "oper_result", "terminal")


def owner_dim(wh: Warehouse) -> DataFrame:
    """Card-level owner attributes: clients ⋈ accounts ⋈ cards (inner)."""
    clients = v_clients(wh).select("client_id", "passport_num", "passport_valid_to", "phone",
                                   full_name().alias("fio"))
    accounts = v_accounts(wh)
    cards = v_cards(wh)
    return (cards.join(accounts, "account")
                 .join(clients, accounts["client"] == clients["client_id"])
                 .drop("client"))


def ownership_chain(wh: Warehouse, transactions: DataFrame | None = None,
                    owners: DataFrame | None = None) -> DataFrame:
    """Transactions with their card's owner (inner: unknown cards drop out)."""
    tx = transactions if transactions is not None else v_transactions(wh)
    owners = owners if owners is not None else wh.owners
    return tx.join(owners, "card_num")


def current_terminals(wh: Warehouse, at=None) -> DataFrame:
    return as_of(wh.terminals, at).select("terminal_id", "terminal_type", "terminal_city",
                                          "terminal_address")


def current_blacklist(wh: Warehouse, at=None) -> DataFrame:
    return as_of(wh.passport_blacklist, at).select("passport_num", "entry_dt")


def with_terminal(rows: DataFrame, terminals: DataFrame) -> DataFrame:
    """Inner join to the current terminal rows. A transaction at an unknown
    terminal drops out; a terminal id with two open rows doubles it."""
    t = terminals.select("terminal_id", "terminal_type", "terminal_city")
    return rows.join(t, rows["terminal"] == t["terminal_id"])


def merged_intervals(history: DataFrame) -> DataFrame:
    """Terminal history with equal consecutive intervals merged: a daily slice
    starts a row every day, so an unchanged terminal has one row per day
    loaded. Windows run per terminal key (at most one row per slice)."""
    keys, attrs = ["terminal_id", "terminal_type"], ["terminal_city", "terminal_address"]
    w = Window.partitionBy(*keys).orderBy("effective_from")
    same = F.lit(True)
    for a in (*attrs, "deleted_flg"):
        same = same & F.col(a).eqNullSafe(F.lag(a).over(w))
    joined = same & (F.lag("effective_to").over(w) + F.expr("INTERVAL 1 SECOND") >= F.col("effective_from"))
    runs = history.withColumn("_new", (~F.coalesce(joined, F.lit(False))).cast("int")) \
        .withColumn("_run", F.sum("_new").over(w))
    return (runs.groupBy(*keys, *attrs, "deleted_flg", "_run")
            .agg(F.min("effective_from").alias("effective_from"), F.max("effective_to").alias("effective_to"))
            .drop("_run"))


def with_terminal_at_event(rows: DataFrame, terminal_history: DataFrame) -> DataFrame:
    """Point-in-time variant: the terminal row valid when the operation took
    place, from ``effective_from`` to the end of the second ``effective_to``. An
    equi-join on the id with the interval as a join condition, over merged
    intervals, so an operation meets one candidate per change, not per day."""
    t = (merged_intervals(terminal_history.filter(F.col("deleted_flg") == 0))
         .select("terminal_id", "terminal_type", "terminal_city", "terminal_address",
                 F.col("effective_from").alias("_t_from"), F.col("effective_to").alias("_t_to")))
    cond = ((rows["terminal"] == t["terminal_id"]) & (rows["trans_date"] >= t["_t_from"])
            & (rows["trans_date"] < t["_t_to"] + F.expr("INTERVAL 1 SECOND")))
    return rows.join(t, cond).drop("_t_from", "_t_to")


def with_terminal_as_of(rows: DataFrame, terminal_history: DataFrame, partitions: int | None = None) -> DataFrame:
    """``with_terminal_at_event`` by sorted merge (``operators.asof``), for histories
    too large to broadcast: a row meets one interval per type its terminal ever had,
    however often it changed."""
    t = merged_intervals(terminal_history.filter(F.col("deleted_flg") == 0))
    types = t.groupBy(F.col("terminal_id").alias("_tid")).agg(F.collect_set("terminal_type").alias("_types"))
    typed = (rows.join(types, rows["terminal"] == types["_tid"]).withColumn("terminal_id", F.col("terminal"))
             .withColumn("terminal_type", F.explode("_types")).drop("_tid", "_types"))
    found = asof_join(typed, t.withColumnRenamed("effective_to", "_t_to"), ["terminal_id", "terminal_type"],
                      "trans_date", "effective_from", ["terminal_city", "terminal_address", "_t_to"], partitions)
    return found.filter(F.col("trans_date") < F.col("_t_to") + F.expr("INTERVAL 1 SECOND")).drop("_t_to")


def with_blacklist(rows: DataFrame, blacklist: DataFrame) -> DataFrame:
    """Left join to the current blacklist on passport; several entries of one
    passport fan a row out, one per entry."""
    b = blacklist.select(F.col("passport_num").alias("_bl_passport"), "entry_dt")
    return (rows.join(b, rows["passport_num"] == b["_bl_passport"], "left")
                .drop("_bl_passport"))


def known_cards_only(transactions: DataFrame, wh: Warehouse) -> DataFrame:
    """Semi join: transactions whose card exists in the card dimension."""
    return transactions.join(v_cards(wh).select("card_num"), "card_num", "left_semi")


def multi_city_clients(rows: DataFrame, client_col: str = "client_id",
                       city_col: str = "terminal_city") -> DataFrame:
    """Clients seen in more than one city (GROUP BY ... HAVING count > 1 over
    distinct (client, city)). The distinct step combines map-side, so a hot
    client shuffles one row per city, not one per transaction."""
    return (rows.select(client_col, city_col).distinct()
                .groupBy(client_col).agg(F.count(city_col).alias("n_cities"))
                .filter(F.col("n_cities") > 1))


def in_multi_city(rows: DataFrame, multi: DataFrame, client_col: str = "client_id") -> DataFrame:
    """Semi join of rows on clients that appear in ``multi``."""
    return rows.join(multi.select(client_col), client_col, "left_semi")
