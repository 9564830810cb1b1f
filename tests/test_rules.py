"""The four rules on the planted cases (FIXTURES.md §4)."""

from __future__ import annotations

import datetime as dt

from fraudmart import schemas
from fraudmart.operators import rules

from planted_cases import AS_OF, REPORT_DT, ids


def test_passport_expired_or_blacklisted(planted):
    out = rules.fraud_passport(planted, REPORT_DT, AS_OF)
    # expiry day and entry day count from midnight; REJECT ignored (3);
    # two blacklist entries give two rows (5); null expiry never expires.
    assert ids(out) == [2, 4, 5, 5]
    assert ids(rules.fraud_passport(planted, REPORT_DT, AS_OF, distinct_events=True)) == [2, 4, 5]


def test_report_columns_and_values(planted):
    out = rules.report_rows(rules.fraud_passport(planted, REPORT_DT, AS_OF))
    assert out.columns == schemas.REPORT_COLUMNS
    row = out.orderBy("event_dt", "passport").first()  # 2 and 4 share a timestamp
    assert row["event_dt"] == dt.datetime(2021, 3, 1, 0, 0)
    assert row["passport"] == "p2"
    assert row["fio"] == "Last2 First2 Middle2"
    assert row["event_type"] == schemas.EVENT_PASSPORT
    assert row["report_dt"] == dt.date(2021, 3, 4)


def test_invalid_contract(planted):
    # valid_to at midnight counts, 7 is one second early; text client id VIP-4.
    assert ids(rules.fraud_contract(planted, REPORT_DT)) == [8]


def test_city_hop_both_and_later(planted):
    # 3600 s in, 3601 s out (11); unknown terminal dropped (12); same city (13);
    # REJECT (14) never takes part.
    assert ids(rules.fraud_city_hop(planted, REPORT_DT, AS_OF, emit="both")) == [9, 10, 20, 21]
    assert ids(rules.fraud_city_hop(planted, REPORT_DT, AS_OF, emit="later")) == [10, 21]


def test_city_hop_any_pair(planted):
    # 22 has a same-city neighbour but another city within the hour.
    assert ids(rules.city_hop_any_pair(planted, REPORT_DT, AS_OF)) == [10, 21, 22]


def test_amount_guess(planted):
    # 1200 s in, 1201 s out (38); DEPOSIT skipped (32); equal amounts out (43);
    # five rejects are still one event (55); per card, so 47 is not a chain.
    assert ids(rules.fraud_amount_guess(planted, REPORT_DT, AS_OF)) == [34, 55]


def test_small_buckets_do_not_change_rules(planted):
    # The narrowest buckets (their look-back) and odd widths: pairs and chains cross them.
    for width in (1, 7300, 10_007, 86_400):
        assert ids(rules.fraud_amount_guess(planted, REPORT_DT, AS_OF, bucket_seconds=width)) == [34, 55]
        assert ids(rules.fraud_city_hop(planted, REPORT_DT, AS_OF, bucket_seconds=width)) == [9, 10, 20, 21]
        assert ids(rules.city_hop_any_pair(planted, REPORT_DT, AS_OF, bucket_seconds=width)) == [10, 21, 22]
        assert ids(rules.all_rules(planted, REPORT_DT, AS_OF, bucket_seconds=width)) == sorted(
            [2, 4, 5, 5, 8, 9, 10, 20, 21, 34, 55])


def test_all_rules_union_keeps_duplicates(planted):
    out = rules.all_rules(planted, REPORT_DT, AS_OF)
    assert ids(out) == sorted([2, 4, 5, 5, 8, 9, 10, 20, 21, 34, 55])


def test_rule_terminal_as_of(planted):
    # Before the terminals' validity starts nothing is located.
    assert ids(rules.fraud_city_hop(planted, REPORT_DT, "2020-12-31 00:00:00")) == []


def test_report_since_reads_bounded_history_exactly(planted):
    from pyspark.sql import functions as F
    from fraudmart.operators import report
    full = report.build_report(planted, REPORT_DT, AS_OF)
    # Cut points inside chains and pairs, before and after all data.
    for since in ["2021-03-01 00:00:00", "2021-03-03 10:05:00", "2021-03-03 10:20:00",
                  "2021-03-03 11:00:00", "2021-03-03 12:20:01", "2021-03-04 00:00:00"]:
        got = report.build_report(planted, REPORT_DT, AS_OF, since=since)
        want = rules.report_rows(rules.all_rules(planted, REPORT_DT, AS_OF).filter(
            F.col("established_dt") >= F.lit(since).cast("timestamp_ntz")))
        assert sorted(got.collect()) == sorted(want.collect()), since
    # runs that each see what has arrived add up to the full report
    cuts, parts = ["2021-02-28 00:00:00", "2021-03-03 10:05:00", "2021-03-03 10:59:59.7", "2021-03-03 12:00:00"], []
    for at, until in zip(cuts, [*cuts[1:], "2030-01-01 00:00:00"]):
        seen = planted.transactions.filter(F.col("trans_date") < F.lit(until).cast("timestamp_ntz"))
        parts += report.build_report(planted.with_(transactions=seen), REPORT_DT, AS_OF, since=at).collect()
    assert sorted(parts) == sorted(full.collect())


def test_report_sorted_is_ordered(spark):
    from fraudmart.plans import catalog
    from planted_cases import SF001
    rows = catalog.report_sorted(spark, SF001).collect()
    dts = [r["event_dt"] for r in rows]
    assert dts == sorted(dts) and len(dts) > 0
