"""Warehouse and feed schemas, plus the fixed values the report must carry."""

from __future__ import annotations

from pyspark.sql import types as T

# --- fixed values (must equal the original warehouse's texts and codes) ---
# Report event types, in rule order 1..4.
EVENT_PASSPORT = "Совершение операции при просроченном или заблокированном паспорте"
EVENT_CONTRACT = "Совершение операции при недействующем договоре"
EVENT_CITY_HOP = "Совершение операций в разных городах в течение одного часа"
EVENT_AMOUNT_GUESS = "Попытка подбора суммы"
# Operation result and type codes used by the rules.
RESULT_SUCCESS = "SUCCESS"
RESULT_REJECT = "REJECT"
TYPE_WITHDRAW = "WITHDRAW"
TYPE_PAYMENT = "PAYMENT"
# Open end of a validity interval.
OPEN_END = "9999-12-31 23:59:59"
# Feed file name patterns, the business date is DDMMYYYY.
TX_FEED_GLOB = "transactions_????????.txt"
TERMINAL_FEED_GLOB = "terminals_????????.xlsx"
BLACKLIST_FEED_GLOB = "passport_blacklist_????????.xlsx"
TERMINAL_SHEET = "terminals"
BLACKLIST_SHEET = "blacklist"
FEED_DATE_FORMAT = "ddMMyyyy"
# Rule thresholds: city hop window and amount-guess chain.
CITY_HOP_SECONDS = 3600
AMOUNT_GUESS_REJECTS = 3
AMOUNT_GUESS_SECONDS = 1200
# --- end of fixed values ---

AMOUNT = T.DecimalType(18, 2)
TS = T.TimestampNTZType()  # feeds carry wall-clock times without a zone


def _s(*fields: tuple[str, T.DataType, bool]) -> T.StructType:
    return T.StructType([T.StructField(n, t, nullable) for n, t, nullable in fields])


CARDS = _s(("card_num", T.StringType(), False), ("account", T.StringType(), False),
           ("create_dt", T.DateType(), True), ("update_dt", T.DateType(), True))

# Client ids are strings: the seed mixes numbers and codes such as VIP-9807.
ACCOUNTS = _s(("account", T.StringType(), False), ("valid_to", T.DateType(), True),
              ("client", T.StringType(), False), ("create_dt", T.DateType(), True),
              ("update_dt", T.DateType(), True))

CLIENTS = _s(("client_id", T.StringType(), False), ("last_name", T.StringType(), True),
             ("first_name", T.StringType(), True), ("patronymic", T.StringType(), True),
             ("date_of_birth", T.DateType(), True), ("passport_num", T.StringType(), True),
             ("passport_valid_to", T.DateType(), True), ("phone", T.StringType(), True),
             ("create_dt", T.DateType(), True), ("update_dt", T.DateType(), True))

TERMINALS = _s(("terminal_id", T.StringType(), False), ("terminal_type", T.StringType(), True),
               ("terminal_city", T.StringType(), True), ("terminal_address", T.StringType(), True),
               ("effective_from", TS, False), ("effective_to", TS, False),
               ("deleted_flg", T.IntegerType(), False))

PASSPORT_BLACKLIST = _s(("passport_num", T.StringType(), False), ("entry_dt", T.DateType(), True),
                        ("effective_from", TS, False), ("effective_to", TS, False),
                        ("deleted_flg", T.IntegerType(), False))

TRANSACTIONS = _s(("trans_id", T.StringType(), False), ("trans_date", TS, True),
                  ("card_num", T.StringType(), True), ("oper_type", T.StringType(), True),
                  ("amt", AMOUNT, True), ("oper_result", T.StringType(), True),
                  ("terminal", T.StringType(), True))

REPORT = _s(("event_dt", TS, True), ("passport", T.StringType(), True),
            ("fio", T.StringType(), True), ("phone", T.StringType(), True),
            ("event_type", T.StringType(), False), ("report_dt", T.DateType(), False))

REPORT_COLUMNS = [f.name for f in REPORT.fields]

# Text feed as read: every column a string, decimal comma in amount.
TX_FEED = _s(("transaction_id", T.StringType(), True), ("transaction_date", T.StringType(), True),
             ("amount", T.StringType(), True), ("card_num", T.StringType(), True),
             ("oper_type", T.StringType(), True), ("oper_result", T.StringType(), True),
             ("terminal", T.StringType(), True))

TERMINAL_FEED = _s(("terminal_id", T.StringType(), True), ("terminal_type", T.StringType(), True),
                   ("terminal_city", T.StringType(), True), ("terminal_address", T.StringType(), True))

BLACKLIST_FEED = _s(("passport", T.StringType(), True), ("date", T.DateType(), True))

WAREHOUSE_TABLES = {
    "cards": CARDS,
    "accounts": ACCOUNTS,
    "clients": CLIENTS,
    "terminals": TERMINALS,
    "passport_blacklist": PASSPORT_BLACKLIST,
    "transactions": TRANSACTIONS,
    "reporting_list": REPORT,
}
