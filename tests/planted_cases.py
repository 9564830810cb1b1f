"""Planted rows and helpers shared by the tests (FIXTURES.md section 4)."""

from __future__ import annotations

import datetime as dt
import decimal
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from fraudmart import schemas  # noqa: E402
from fraudmart.warehouse import Warehouse  # noqa: E402

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


def D(s: str) -> dt.date:
    return dt.date.fromisoformat(s)


def TS(s: str) -> dt.datetime:
    return dt.datetime.fromisoformat(s)


OPEN = TS(schemas.OPEN_END)
LONG_AGO = TS("2021-01-01 00:00:00")

# Planted transactions (FIXTURES.md §4), feed layout.
PLANTED_FEED = """transaction_id;transaction_date;amount;card_num;oper_type;oper_result;terminal
1;2021-02-28 23:59:59;10,00;c2;PAYMENT;SUCCESS;T1
2;2021-03-01 00:00:00;10,00;c2;PAYMENT;SUCCESS;T1
3;2021-03-02 00:00:00;10,00;c2;PAYMENT;REJECT;T1
4;2021-03-01 00:00:00;10,00;c3;PAYMENT;SUCCESS;T1
5;2021-03-02 09:00:00;10,00;c3;PAYMENT;SUCCESS;T1
6;2021-02-28 10:00:00;10,00;c3;PAYMENT;SUCCESS;T1
7;2021-03-01 23:59:59;10,00;c4;PAYMENT;SUCCESS;T1
8;2021-03-02 00:00:00;10,00;c4;PAYMENT;SUCCESS;T1
9;2021-03-03 10:00:00;10,00;c1;PAYMENT;SUCCESS;T1
10;2021-03-03 11:00:00;10,00;c1;PAYMENT;SUCCESS;T2
11;2021-03-03 12:00:01;10,00;c1;PAYMENT;SUCCESS;T1
12;2021-03-03 12:30:00;10,00;c1;PAYMENT;SUCCESS;TX
13;2021-03-03 12:40:00;10,00;c1;PAYMENT;SUCCESS;T3
14;2021-03-03 12:50:00;10,00;c1;PAYMENT;REJECT;T2
20;2021-03-03 10:00:00;10,00;c6;PAYMENT;SUCCESS;T2
21;2021-03-03 10:10:00;10,00;c6;PAYMENT;SUCCESS;T1
22;2021-03-03 10:20:00;10,00;c6;PAYMENT;SUCCESS;T1
30;2021-03-03 10:00:00;400,00;c5a;WITHDRAW;REJECT;T1
31;2021-03-03 10:05:00;300,00;c5a;WITHDRAW;REJECT;T1
32;2021-03-03 10:06:00;999,00;c5a;DEPOSIT;SUCCESS;T1
33;2021-03-03 10:10:00;200,00;c5a;PAYMENT;REJECT;T1
34;2021-03-03 10:20:00;100,00;c5a;WITHDRAW;SUCCESS;T1
35;2021-03-03 12:00:00;400,00;c5b;WITHDRAW;REJECT;T1
36;2021-03-03 12:05:00;300,00;c5b;WITHDRAW;REJECT;T1
37;2021-03-03 12:10:00;200,00;c5b;WITHDRAW;REJECT;T1
38;2021-03-03 12:20:01;100,00;c5b;WITHDRAW;SUCCESS;T1
40;2021-03-03 10:00:00;400,00;c7;WITHDRAW;REJECT;T1
41;2021-03-03 10:01:00;300,00;c7;WITHDRAW;REJECT;T1
42;2021-03-03 10:02:00;300,00;c7;WITHDRAW;REJECT;T1
43;2021-03-03 10:03:00;100,00;c7;WITHDRAW;SUCCESS;T1
44;2021-03-03 10:00:00;300,00;c8a;WITHDRAW;REJECT;T1
45;2021-03-03 10:05:00;200,00;c8a;WITHDRAW;REJECT;T1
46;2021-03-03 10:08:00;100,00;c8b;WITHDRAW;REJECT;T1
47;2021-03-03 10:10:00;50,00;c8b;WITHDRAW;SUCCESS;T1
50;2021-03-03 10:00:00;600,00;c9;WITHDRAW;REJECT;T1
51;2021-03-03 10:05:00;500,00;c9;WITHDRAW;REJECT;T1
52;2021-03-03 10:10:00;400,00;c9;WITHDRAW;REJECT;T1
53;2021-03-03 10:15:00;300,00;c9;WITHDRAW;REJECT;T1
54;2021-03-03 10:20:00;200,00;c9;WITHDRAW;REJECT;T1
55;2021-03-03 10:25:00;100,00;c9;WITHDRAW;SUCCESS;T1
"""

CLIENT_IDS = ["1", "2", "3", "VIP-4", "5", "6", "7", "8", "9"]


def planted_transaction_rows():
    lines = PLANTED_FEED.strip().splitlines()[1:]
    rows = []
    for line in lines:
        tid, ts, amount, card, otype, result, term = line.split(";")
        rows.append((tid, TS(ts), card, otype, decimal.Decimal(amount.replace(",", ".")),
                     result, term))
    return rows


def planted_warehouse(spark) -> Warehouse:
    clients, accounts, cards = [], [], []
    for i, cid in enumerate(CLIENT_IDS, start=1):
        valid_to = D("2021-03-01") if cid == "2" else None
        clients.append((cid, f"Last{i}", f"First{i}", f"Middle{i}", None, f"p{i}", valid_to,
                        f"+7 900 000-00-0{i}", None, None))
        accounts.append((f"a{i}", D("2021-03-02") if cid == "VIP-4" else D("2099-01-01"), cid,
                         None, None))
    for i in (1, 2, 3, 4, 6, 7, 9):
        cards.append((f"c{i}", f"a{i}", None, None))
    for i in (5, 8):
        cards += [(f"c{i}a", f"a{i}", None, None), (f"c{i}b", f"a{i}", None, None)]
    terminals = [("T1", "ATM", "Moscow", "addr 1", LONG_AGO, OPEN, 0),
                 ("T2", "POS", "Kazan", "addr 2", LONG_AGO, OPEN, 0),
                 ("T3", "ATM", "Moscow", "addr 3", LONG_AGO, OPEN, 0)]
    blacklist = [("p3", D("2021-03-01"), LONG_AGO, OPEN, 0),
                 ("p3", D("2021-03-02"), LONG_AGO, OPEN, 0)]
    return Warehouse(
        cards=spark.createDataFrame(cards, schemas.CARDS),
        accounts=spark.createDataFrame(accounts, schemas.ACCOUNTS),
        clients=spark.createDataFrame(clients, schemas.CLIENTS),
        terminals=spark.createDataFrame(terminals, schemas.TERMINALS),
        passport_blacklist=spark.createDataFrame(blacklist, schemas.PASSPORT_BLACKLIST),
        transactions=spark.createDataFrame(planted_transaction_rows(), schemas.TRANSACTIONS),
    )


AS_OF = "2021-03-04 00:00:00"
REPORT_DT = "2021-03-04"


def ids(df) -> list[int]:
    return sorted(int(r["trans_id"]) for r in df.select("trans_id").collect())
