"""DuckDB SQL for each registered query, over the shared tables.

The binding (``LENS``) mirrors ``fraudmart.plans.lens``; each query text is
that CTE list followed by a SELECT. Gaps use ``date_diff('second', a, b)``,
which counts whole-second boundaries like Spark's difference of
``unix_timestamp`` values.
"""

from __future__ import annotations

# Fixed values, written out here so that the oracle does not share them with
# the code it checks.
EVENT_PASSPORT = "Совершение операции при просроченном или заблокированном паспорте"
EVENT_CONTRACT = "Совершение операции при недействующем договоре"
EVENT_CITY_HOP = "Совершение операций в разных городах в течение одного часа"
EVENT_AMOUNT_GUESS = "Попытка подбора суммы"

LENS = """
WITH l_clients AS (
  SELECT CAST(c.c_custkey AS VARCHAR) AS client_id, c.c_name AS last_name, c.c_mktsegment AS first_name,
         n.n_name AS patronymic, CAST(NULL AS DATE) AS date_of_birth,
         'P' || CAST(c.c_custkey AS VARCHAR) AS passport_num,
         CASE WHEN c.c_custkey % 5 < 2 THEN NULL
              ELSE DATE '2023-12-25' + CAST(c.c_custkey % 60 AS INTEGER) END AS passport_valid_to,
         '+7 ' || CAST(c.c_custkey AS VARCHAR) AS phone
  FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey),
l_accounts AS (
  SELECT 'A' || CAST(c_custkey AS VARCHAR) || '-' || CAST(a AS VARCHAR) AS account,
         DATE '2023-12-20' + CAST((c_custkey + 35 * a) % 70 AS INTEGER) AS valid_to,
         CAST(c_custkey AS VARCHAR) AS client
  FROM customer, (VALUES (0), (1)) v(a)),
l_cards AS (
  SELECT 'C' || CAST(c_custkey AS VARCHAR) || '-' || CAST(a AS VARCHAR) AS card_num,
         'A' || CAST(c_custkey AS VARCHAR) || '-' || CAST(a AS VARCHAR) AS account
  FROM customer, (VALUES (0), (1)) v(a)),
l_terminals AS (
  SELECT CAST(s.s_suppkey AS VARCHAR) AS terminal_id,
         CASE WHEN s.s_suppkey % 2 = 0 THEN 'ATM' ELSE 'POS' END AS terminal_type,
         n.n_name AS terminal_city, s.s_name AS terminal_address
  FROM supplier s JOIN nation n ON s.s_nationkey = n.n_nationkey),
l_tx AS (
  SELECT CAST(event_id AS VARCHAR) AS trans_id, ts AS trans_date,
         'C' || CAST(user_id AS VARCHAR) || '-' || CAST(event_id % 2 AS VARCHAR) AS card_num,
         CASE event_id % 3 WHEN 0 THEN 'WITHDRAW' WHEN 1 THEN 'PAYMENT' ELSE 'DEPOSIT' END AS oper_type,
         CAST(value AS DECIMAL(18,2)) AS amt,
         CASE WHEN event_type IN ('purchase', 'signup') THEN 'SUCCESS' ELSE 'REJECT' END AS oper_result,
         CAST(event_id % (SELECT count(*) FROM supplier) AS VARCHAR) AS terminal
  FROM events),
l_blacklist AS (
  SELECT 'P' || CAST(c_custkey AS VARCHAR) AS passport_num,
         DATE '2024-01-01' + CAST(c_custkey % 31 AS INTEGER) AS entry_dt
  FROM customer WHERE c_custkey % 7 = 0
  UNION ALL
  SELECT 'P' || CAST(c_custkey AS VARCHAR), DATE '2024-01-10' FROM customer WHERE c_custkey % 21 = 0),
l_slices AS (
  SELECT CAST(s.s_suppkey AS VARCHAR) AS terminal_id,
         CASE WHEN (s.s_suppkey + d) % 5 = 0 THEN 'POS' ELSE 'ATM' END AS terminal_type,
         n.n_name AS terminal_city,
         s.s_name || '-' || CAST((s.s_suppkey + d) % 2 AS VARCHAR) AS terminal_address,
         TIMESTAMP '2024-01-01 00:00:00' + to_days(CAST(d AS INTEGER)) AS effective_from
  FROM supplier s JOIN nation n ON s.s_nationkey = n.n_nationkey, (VALUES (0), (1), (2)) v(d)
  WHERE (s.s_suppkey + d) % 4 <> 0),
l_blacklist_files AS (
  SELECT 'P' || CAST(c_custkey AS VARCHAR) AS passport_num,
         DATE '2024-01-01' + CAST(c_custkey % 31 AS INTEGER) AS entry_dt,
         TIMESTAMP '2024-01-01 00:00:00' + to_days(CAST(d AS INTEGER)) AS effective_from
  FROM customer, (VALUES (0), (1), (2)) v(d)
  WHERE c_custkey % 7 = 0 AND c_custkey % 3 <= d),
owners AS (
  SELECT c.card_num, a.account, a.valid_to, cl.client_id, cl.passport_num, cl.passport_valid_to,
         cl.phone, cl.last_name || ' ' || cl.first_name || ' ' || cl.patronymic AS fio
  FROM l_clients cl JOIN l_accounts a ON cl.client_id = a.client JOIN l_cards c ON a.account = c.account),
chain AS (
  SELECT t.*, o.account, o.valid_to, o.client_id, o.passport_num, o.passport_valid_to, o.phone, o.fio
  FROM l_tx t JOIN owners o ON t.card_num = o.card_num),
located AS (
  SELECT ch.*, te.terminal_id, te.terminal_type, te.terminal_city
  FROM chain ch JOIN l_terminals te ON ch.terminal = te.terminal_id
  WHERE ch.oper_result = 'SUCCESS')
"""

REPORT_DT = "DATE '2024-02-01'"


def _report(event_type: str, src: str, where: str = "TRUE", ts: str = "trans_date",
            passport: str = "passport_num") -> str:
    return (f"SELECT {ts} AS event_dt, {passport} AS passport, fio, phone, "
            f"'{event_type}' AS event_type, {REPORT_DT} AS report_dt FROM {src} WHERE {where}")


def _q(body: str) -> str:
    return LENS + body


PASSPORT_BODY = _report(
    EVENT_PASSPORT,
    "chain LEFT JOIN l_blacklist b ON b.passport_num = chain.passport_num",
    "(b.entry_dt <= trans_date OR passport_valid_to <= trans_date) AND oper_result = 'SUCCESS'",
    passport="chain.passport_num")
CONTRACT_BODY = _report(EVENT_CONTRACT, "chain",
                        "valid_to <= trans_date AND oper_result = 'SUCCESS'")

CITY_NB = """, nb AS (
  SELECT *, lag(trans_date) OVER w AS p_dt, lag(terminal_city) OVER w AS p_city,
         lead(trans_date) OVER w AS f_dt, lead(terminal_city) OVER w AS f_city
  FROM located WINDOW w AS (PARTITION BY client_id ORDER BY trans_date, trans_id))
"""
CITY_PREV = "(terminal_city <> p_city AND abs(date_diff('second', p_dt, trans_date)) <= 3600)"
CITY_NEXT = "(terminal_city <> f_city AND abs(date_diff('second', trans_date, f_dt)) <= 3600)"

ANY_PAIR_BODY = _report(
    EVENT_CITY_HOP, "located r",
    "EXISTS (SELECT 1 FROM located o WHERE o.client_id = r.client_id "
    "AND o.terminal_city <> r.terminal_city "
    "AND date_diff('second', o.trans_date, r.trans_date) BETWEEN 0 AND 3600)")


def amount_guess_select(n_rejects: int, seconds: int) -> str:
    lags = ", ".join(
        f"lag(oper_result, {j}) OVER w AS r{j}, lag(amt, {j}) OVER w AS a{j}, "
        f"lag(trans_date, {j}) OVER w AS d{j}" for j in range(1, n_rejects + 1))
    conds = ["oper_result = 'SUCCESS'"]
    prev = "amt"
    for j in range(1, n_rejects + 1):
        conds.append(f"r{j} = 'REJECT'")
        conds.append(f"{prev} < a{j}")
        prev = f"a{j}"
    conds.append(f"abs(date_diff('second', d{n_rejects}, trans_date)) <= {seconds}")
    src = (f"(SELECT *, {lags} FROM (SELECT ch.* FROM chain ch JOIN l_terminals te "
           "ON ch.terminal = te.terminal_id WHERE ch.oper_type IN ('WITHDRAW', 'PAYMENT')) "
           "WINDOW w AS (PARTITION BY card_num ORDER BY trans_date, trans_id)) nb")
    return _report(EVENT_AMOUNT_GUESS, src, " AND ".join(conds))


def amount_guess_sql(n_rejects: int, seconds: int) -> str:
    return _q(amount_guess_select(n_rejects, seconds))


SQL: dict[str, str] = {
    "ownership_chain": _q("SELECT trans_id, card_num, account, client_id FROM chain"),
    "fraud_passport": _q(PASSPORT_BODY),
    "fraud_contract": _q(CONTRACT_BODY),
    "fraud_city_hop": _q(CITY_NB + _report(EVENT_CITY_HOP, "nb", f"{CITY_PREV} OR {CITY_NEXT}")),
    "fraud_city_hop_later": _q(CITY_NB + _report(EVENT_CITY_HOP, "nb", CITY_PREV)),
    "city_hop_any_pair": _q(ANY_PAIR_BODY),
    "fraud_amount_guess": amount_guess_sql(3, 1200),
    "amount_guess_1reject_1day": amount_guess_sql(1, 86400),
    "amount_guess_1reject_6h": amount_guess_sql(1, 21600),
    "amount_guess_2rejects_1day": amount_guess_sql(2, 86400),
    "amount_guess_3rejects_1day": amount_guess_sql(3, 86400),
    "multi_city_clients": _q(
        "SELECT client_id, count(terminal_city) AS n_cities FROM "
        "(SELECT DISTINCT client_id, terminal_city FROM located) GROUP BY client_id "
        "HAVING count(terminal_city) > 1"),
    "distinct_client_city": _q("SELECT DISTINCT client_id, terminal_city FROM located"),
    "semi_multi_city": _q(
        "SELECT trans_id, client_id, terminal_city FROM located WHERE client_id IN ("
        "SELECT client_id FROM (SELECT DISTINCT client_id, terminal_city FROM located) "
        "GROUP BY client_id HAVING count(terminal_city) > 1)"),
    "semi_known_cards": _q(
        "SELECT trans_id, card_num FROM l_tx WHERE card_num IN (SELECT card_num FROM l_cards)"),
    "chain_with_terminal": _q(
        "SELECT ch.trans_id, ch.client_id, te.terminal_id, te.terminal_type, te.terminal_city "
        "FROM chain ch JOIN l_terminals te ON ch.terminal = te.terminal_id"),
    "chain_left_blacklist": _q(
        "SELECT ch.trans_id, ch.client_id, ch.passport_num, b.entry_dt "
        "FROM chain ch LEFT JOIN l_blacklist b ON b.passport_num = ch.passport_num"),
    "tx_prev_next": _q(
        "SELECT trans_id, client_id, lag(trans_date) OVER w AS prev_trans_date, "
        "lag(terminal_city) OVER w AS prev_city, lead(trans_date) OVER w AS next_trans_date, "
        "lead(terminal_city) OVER w AS next_city FROM located "
        "WINDOW w AS (PARTITION BY client_id ORDER BY trans_date, trans_id)"),
    "tx_lag3": _q(
        "SELECT trans_id, card_num, "
        + ", ".join(f"lag(trans_date, {j}) OVER w AS dt_{j}, lag(oper_result, {j}) OVER w AS op_r_{j}, "
                    f"lag(amt, {j}) OVER w AS amt_{j}" for j in (1, 2, 3))
        + " FROM (SELECT ch.* FROM chain ch JOIN l_terminals te ON ch.terminal = te.terminal_id "
          "WHERE ch.oper_type IN ('WITHDRAW', 'PAYMENT')) "
          "WINDOW w AS (PARTITION BY card_num ORDER BY trans_date, trans_id)"),
    "time_gap": _q(
        "SELECT trans_id, card_num, gap_seconds FROM (SELECT trans_id, card_num, "
        "abs(date_diff('second', lag(trans_date) OVER w, trans_date)) AS gap_seconds FROM l_tx "
        "WINDOW w AS (PARTITION BY card_num ORDER BY trans_date, trans_id)) WHERE gap_seconds <= 3600"),
    "tx_success": _q(
        "SELECT trans_id, trans_date, card_num, amt FROM l_tx WHERE oper_result = 'SUCCESS'"),
    "tx_types": _q(
        "SELECT trans_id, oper_type, amt FROM l_tx WHERE oper_type IN ('WITHDRAW', 'PAYMENT')"),
    "client_full_name": _q(
        "SELECT client_id, last_name || ' ' || first_name || ' ' || patronymic AS fio FROM l_clients"),
    "dim_projections": _q(
        "SELECT client_id, last_name, first_name, patronymic, date_of_birth, passport_num, "
        "passport_valid_to, phone FROM l_clients"),
    "v_cards": _q("SELECT card_num, account FROM l_cards"),
    "v_accounts": _q("SELECT account, valid_to, client FROM l_accounts"),
    "v_transactions": _q(
        "SELECT trans_id, trans_date, card_num, oper_type, amt, oper_result, terminal FROM l_tx"),
    "table_scan": _q(
        "SELECT card_num, account, CAST(NULL AS DATE) AS create_dt, CAST(NULL AS DATE) AS update_dt "
        "FROM l_cards"),
    "scd2_terminal_history": _q(
        "SELECT terminal_id, terminal_type, terminal_city, terminal_address, effective_from, "
        "coalesce(lead(effective_from) OVER w - INTERVAL 1 SECOND, TIMESTAMP '9999-12-31 23:59:59') "
        "AS effective_to, 0 AS deleted_flg FROM l_slices "
        "WINDOW w AS (PARTITION BY terminal_id, terminal_type ORDER BY effective_from)"),
}

_HISTORY = ("(SELECT terminal_id, terminal_type, terminal_city, terminal_address, effective_from, "
            "coalesce(lead(effective_from) OVER w - INTERVAL 1 SECOND, TIMESTAMP '9999-12-31 23:59:59') "
            "AS effective_to FROM l_slices "
            "WINDOW w AS (PARTITION BY terminal_id, terminal_type ORDER BY effective_from)) h")
SQL["scd2_terminals_as_of"] = _q(
    "SELECT terminal_id, terminal_type, terminal_city, terminal_address FROM " + _HISTORY
    + " WHERE TIMESTAMP '2024-01-03 12:00:00' BETWEEN effective_from AND effective_to")
SQL["scd2_terminals_as_of_jan2"] = _q(
    "SELECT terminal_id, terminal_type, terminal_city, terminal_address FROM " + _HISTORY
    + " WHERE TIMESTAMP '2024-01-02 12:00:00' BETWEEN effective_from AND effective_to")
_INSERTED = ("(SELECT passport_num, entry_dt, min(effective_from) AS effective_from "
             "FROM l_blacklist_files WHERE passport_num IS NOT NULL "
             "GROUP BY passport_num, entry_dt) i")
SQL["blacklist_insert_if_absent"] = _q(
    "SELECT passport_num, entry_dt, effective_from, TIMESTAMP '9999-12-31 23:59:59' AS effective_to, "
    "0 AS deleted_flg FROM " + _INSERTED)
SQL["blacklist_as_of"] = _q(
    "SELECT passport_num, entry_dt FROM " + _INSERTED
    + " WHERE TIMESTAMP '2024-01-02 12:00:00' BETWEEN effective_from AND TIMESTAMP '9999-12-31 23:59:59'")
SQL["fraud_report"] = _q(
    f"({PASSPORT_BODY}) UNION ALL ({CONTRACT_BODY}) UNION ALL ("
    + _report(EVENT_CITY_HOP,
              "(SELECT *, lag(trans_date) OVER w AS p_dt, lag(terminal_city) OVER w AS p_city, "
              "lead(trans_date) OVER w AS f_dt, lead(terminal_city) OVER w AS f_city FROM located "
              "WINDOW w AS (PARTITION BY client_id ORDER BY trans_date, trans_id)) nb",
              f"{CITY_PREV} OR {CITY_NEXT}")
    + f") UNION ALL ({amount_guess_select(3, 1200)})")
SQL["report_sorted"] = SQL["fraud_report"]

# The feed layout carries whole seconds (YYYY-MM-DD HH:MM:SS).
SQL["tx_feed_scan"] = _q(
    "SELECT trans_id, date_trunc('second', trans_date) AS trans_date, card_num, oper_type, amt, "
    "oper_result, terminal FROM l_tx")
SQL["feed_business_date"] = _q(
    "SELECT DISTINCT 'transactions_' || strftime(trans_date, '%d%m%Y') || '.txt' AS file_name, "
    "CAST(CAST(trans_date AS DATE) AS TIMESTAMP) AS business_dt FROM l_tx")
SQL["amount_normalise"] = _q(
    "SELECT trans_id, replace(CAST(amt AS VARCHAR), '.', ',') AS amount, amt FROM l_tx")
SQL["epoch_ms_to_date"] = _q(
    "SELECT passport_num, CAST(date_diff('day', DATE '1970-01-01', entry_dt) AS BIGINT) * 86400000 "
    "+ 43200000 AS entry_ms, entry_dt FROM l_blacklist")
SQL["tx_append"] = _q("SELECT trans_id, CAST(trans_date AS DATE) AS load_dt FROM l_tx")
SQL["ingest_ledger"] = _q(
    "SELECT DISTINCT 'transactions_' || strftime(trans_date, '%d%m%Y') || '.txt' AS file_name, "
    "CAST(CAST(trans_date AS DATE) AS TIMESTAMP) AS business_dt, CAST(1 AS BIGINT) AS loads_per_file "
    "FROM l_tx")
SQL["report_for_day"] = SQL["fraud_report"]
SQL["dim_seed_if_empty"] = SQL["table_scan"]
SQL["terminal_feed_scan"] = _q(
    "SELECT terminal_id, terminal_type, terminal_city, terminal_address, effective_from FROM l_slices")
SQL["blacklist_feed_scan"] = _q("SELECT passport_num, entry_dt, effective_from FROM l_blacklist_files")

SQL["stream_ingest"] = SQL["tx_feed_scan"]
SQL["stream_passport"] = SQL["fraud_passport"]
SQL["stream_contract"] = SQL["fraud_contract"]
SQL["stream_city_hop_any_pair"] = SQL["city_hop_any_pair"]
SQL["stream_amount_guess"] = SQL["fraud_amount_guess"]
SQL["stream_amount_guess_1reject_1day"] = SQL["amount_guess_1reject_1day"]

SQL["terminal_open_rows"] = _q(
    "SELECT terminal_id, count(*) AS open_rows FROM " + _HISTORY
    + " WHERE TIMESTAMP '2024-01-03 12:00:00' BETWEEN effective_from AND effective_to "
    "GROUP BY terminal_id HAVING count(*) > 1")
SQL["fraud_passport_distinct"] = _q(
    "SELECT event_dt, passport, fio, phone, event_type, report_dt FROM (SELECT DISTINCT trans_id, "
    "trans_date AS event_dt, chain.passport_num AS passport, fio, phone, "
    f"'{EVENT_PASSPORT}' AS event_type, {REPORT_DT} AS report_dt "
    "FROM chain LEFT JOIN l_blacklist b ON b.passport_num = chain.passport_num "
    "WHERE (b.entry_dt <= trans_date OR passport_valid_to <= trans_date) AND oper_result = 'SUCCESS')")
SQL["scd2_terminal_history_close_missing"] = _q(
    "SELECT terminal_id, terminal_type, terminal_city, terminal_address, effective_from, "
    "least(coalesce(lead(effective_from) OVER w - INTERVAL 1 SECOND, TIMESTAMP '9999-12-31 23:59:59'), "
    "coalesce(c.next_slice - INTERVAL 1 SECOND, TIMESTAMP '9999-12-31 23:59:59')) AS effective_to, "
    "0 AS deleted_flg FROM l_slices JOIN (SELECT s, lead(s) OVER (ORDER BY s) AS next_slice FROM "
    "(SELECT DISTINCT effective_from AS s FROM l_slices)) c ON l_slices.effective_from = c.s "
    "WINDOW w AS (PARTITION BY terminal_id, terminal_type ORDER BY effective_from)")
# half-open: valid until the next row of the key starts
_HISTORY_AT = ("(SELECT terminal_id, terminal_type, terminal_city, terminal_address, effective_from, "
               "coalesce(lead(effective_from) OVER w, TIMESTAMP '10000-01-01 00:00:00') AS next_from FROM l_slices "
               "WINDOW w AS (PARTITION BY terminal_id, terminal_type ORDER BY effective_from))")
SQL["chain_terminal_at_event_time"] = _q(
    "SELECT t.trans_id, h.terminal_id, h.terminal_type, h.terminal_city, h.terminal_address "
    f"FROM l_tx t JOIN {_HISTORY_AT} h ON t.terminal = h.terminal_id "
    "AND t.trans_date >= h.effective_from AND t.trans_date < h.next_from")
SQL["city_hop_point_in_time"] = _q(
    _report(EVENT_CITY_HOP,
            "(SELECT *, lag(trans_date) OVER w AS p_dt, lag(terminal_city) OVER w AS p_city, "
            "lead(trans_date) OVER w AS f_dt, lead(terminal_city) OVER w AS f_city FROM "
            f"(SELECT ch.*, h.terminal_city FROM chain ch JOIN {_HISTORY_AT} h ON ch.terminal = h.terminal_id "
            "AND ch.trans_date >= h.effective_from AND ch.trans_date < h.next_from WHERE ch.oper_result = 'SUCCESS') "
            "WINDOW w AS (PARTITION BY client_id ORDER BY trans_date, trans_id)) nb",
            f"{CITY_PREV} OR {CITY_NEXT}"))
# Events by the time of the operation that established them: the first operation
# of a pair (not itself the later one of another pair) counts when the second happens.
_NB = ("(SELECT *, lag(trans_date) OVER w AS p_dt, lag(terminal_city) OVER w AS p_city, "
       "lead(trans_date) OVER w AS f_dt, lead(terminal_city) OVER w AS f_city FROM located "
       "WINDOW w AS (PARTITION BY client_id ORDER BY trans_date, trans_id)) nb")
SINCE = "TIMESTAMP '2024-01-15 00:00:00'"
SQL["fraud_report_since"] = _q(
    f"SELECT * FROM (({PASSPORT_BODY}) UNION ALL ({CONTRACT_BODY}) UNION ALL ({amount_guess_select(3, 1200)})) r "
    f"WHERE event_dt >= {SINCE} UNION ALL ("
    + _report(EVENT_CITY_HOP, _NB, f"coalesce({CITY_PREV}, FALSE) AND trans_date >= {SINCE}") + ") UNION ALL ("
    + _report(EVENT_CITY_HOP, _NB, f"NOT coalesce({CITY_PREV}, FALSE) AND {CITY_NEXT} AND f_dt >= {SINCE}") + ")")
SQL["report_rerun"] = SQL["fraud_report_since"]
SQL["report_accumulated_days"] = SQL["fraud_report"]
SQL["daily_run_two_days"] = SQL["tx_feed_scan"]
SQL["terminals_loaded_out_of_order"] = SQL["scd2_terminal_history"]
SQL["blacklist_loaded_out_of_order"] = SQL["blacklist_insert_if_absent"]
SQL["table_scan_accounts"] = _q("SELECT account, valid_to, client, CAST(NULL AS DATE) AS create_dt, "
                                "CAST(NULL AS DATE) AS update_dt FROM l_accounts")
SQL["table_scan_clients"] = _q(
    "SELECT client_id, last_name, first_name, patronymic, date_of_birth, passport_num, passport_valid_to, phone, "
    "CAST(NULL AS DATE) AS create_dt, CAST(NULL AS DATE) AS update_dt FROM l_clients")
SQL["dim_seed_accounts"] = SQL["table_scan_accounts"]
SQL["dim_seed_clients"] = SQL["table_scan_clients"]
_CITY = "n.n_name AS terminal_city, s.s_name AS terminal_address\n  FROM supplier s JOIN nation n ON s.s_nationkey = n.n_nationkey),"
assert LENS.count(_CITY) == 1
SQL["city_hop_any_pair_null_city"] = SQL["city_hop_any_pair"].replace(
    _CITY, _CITY.replace("n.n_name", "CASE WHEN s.s_suppkey % 3 <> 0 THEN n.n_name END"))
_TX = LENS[LENS.index("l_tx AS ("):LENS.index("l_blacklist AS (")]
_DENSE = """l_tx AS (
  SELECT CAST(event_id AS VARCHAR) AS trans_id, TIMESTAMP '2024-01-01 00:00:00' + to_seconds(event_id * 60) AS trans_date,
         'C' || CAST(1 + (event_id // 4) % 100 AS VARCHAR) || '-0' AS card_num, 'WITHDRAW' AS oper_type,
         CAST(400 - 100 * (event_id % 4) AS DECIMAL(18,2)) AS amt,
         CASE WHEN event_id % 4 = 3 AND (event_id // 4) % 3 <> 0 THEN 'SUCCESS' ELSE 'REJECT' END AS oper_result,
         CAST(event_id % (SELECT count(*) FROM supplier) AS VARCHAR) AS terminal
  FROM events),
"""
SQL["fraud_amount_guess_dense"] = SQL["fraud_amount_guess"].replace(_TX, _DENSE)
SQL["stream_amount_guess_dense"] = SQL["fraud_amount_guess_dense"]
SQL["fraud_city_hop_split"] = SQL["fraud_city_hop"]
SQL["city_hop_any_pair_split"] = SQL["city_hop_any_pair"]
SQL["amount_guess_1reject_1day_split"] = SQL["amount_guess_1reject_1day"]
SQL["tx_lag3_split"] = SQL["tx_lag3"]
SQL["stream_fraud_city_hop"] = SQL["fraud_city_hop"]
SQL["stream_fraud_report"] = SQL["fraud_report"]
