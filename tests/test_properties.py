"""Properties on the shared tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from fraudmart import schemas
from fraudmart.operators import chain, history, rules
from fraudmart.plans import catalog, lens
from fraudmart.sources.store import TableStore, ensure_history_tables

from planted_cases import SF01

KEYS = ["terminal_id", "terminal_type"]
ATTRS = ["terminal_city", "terminal_address"]


def test_as_of_gives_at_most_one_row_per_key(spark):
    hist = history.scd2_history(lens.terminal_slices(spark, SF01), KEYS, ATTRS)
    for at in ["2024-01-01 00:00:00", "2024-01-01 23:59:59", "2024-01-02 00:00:00",
               "2024-01-02 12:00:00", "2024-01-03 00:00:00", "2030-01-01 00:00:00"]:
        dup = history.as_of(hist, at).groupBy(*KEYS).count().filter(F.col("count") > 1)
        assert dup.count() == 0, at


def test_later_is_subset_of_any_pair(spark):
    wh = lens.warehouse(spark, SF01)
    later = {r["trans_id"] for r in rules.fraud_city_hop(wh, catalog.REPORT_DT, catalog.AS_OF,
                                                          emit="later").collect()}
    anyp = {r["trans_id"] for r in rules.city_hop_any_pair(wh, catalog.REPORT_DT, catalog.AS_OF).collect()}
    both = {r["trans_id"] for r in rules.fraud_city_hop(wh, catalog.REPORT_DT, catalog.AS_OF).collect()}
    assert later <= anyp and later <= both and later


def test_amount_guess_reports_only_successes(spark):
    wh = lens.warehouse(spark, SF01)
    hits = rules.fraud_amount_guess(wh, catalog.REPORT_DT, catalog.AS_OF, n_rejects=1, seconds=86400)
    joined = hits.join(chain.v_transactions(wh).select("trans_id", "oper_result", "oper_type"), "trans_id")
    assert joined.filter(F.col("oper_result") != schemas.RESULT_SUCCESS).count() == 0
    assert joined.filter(~F.col("oper_type").isin("WITHDRAW", "PAYMENT")).count() == 0
    assert joined.count() == hits.count() > 0


def test_report_is_union_of_rules(spark):
    wh = lens.warehouse(spark, SF01)
    parts = [rules.fraud_passport(wh, catalog.REPORT_DT, catalog.AS_OF), rules.fraud_contract(wh, catalog.REPORT_DT),
             rules.fraud_city_hop(wh, catalog.REPORT_DT, catalog.AS_OF),
             rules.fraud_amount_guess(wh, catalog.REPORT_DT, catalog.AS_OF)]
    assert rules.all_rules(wh, catalog.REPORT_DT, catalog.AS_OF).count() == sum(p.count() for p in parts)


def test_ensure_history_tables_is_idempotent(spark, tmp_path):
    store = TableStore(spark, str(tmp_path / "wh"))
    assert sorted(ensure_history_tables(store)) == sorted(
        ["terminals", "passport_blacklist", "transactions", "reporting_list"])
    assert ensure_history_tables(store) == []
    assert store.read("transactions").count() == 0
    assert store.read("terminals").columns == [f.name for f in schemas.TERMINALS.fields]
