"""Typed state per group of keys, and the dense binding beyond 32-bit seconds."""

from __future__ import annotations

from pyspark.sql import functions as F

from fraudmart import schemas
from fraudmart.operators import rules
from fraudmart.plans import lens
from fraudmart.plans.catalog import FLUSH_ROW
from fraudmart.streaming import rules as srules
from fraudmart.streaming import packed, typed
from fraudmart.warehouse import Warehouse

from planted_cases import AS_OF, REPORT_DT, planted_warehouse


def test_typed_state_does_not_grow_with_the_number_of_keys(spark, tmp_path):
    """Waiting operations of 20,000 clients: state rows per group, not per key, and the
    events of rule 4 are the batch rule's."""
    n, k = 20000, F.col("id").cast("string")
    null = F.lit(None).cast("date")
    made = spark.range(n)
    wh = Warehouse(
        clients=made.select(k.alias("client_id"), k.alias("last_name"), k.alias("first_name"), k.alias("patronymic"),
                            null.alias("date_of_birth"), k.alias("passport_num"), null.alias("passport_valid_to"),
                            k.alias("phone"), null.alias("create_dt"), null.alias("update_dt")),
        accounts=made.select(k.alias("account"), null.alias("valid_to"), k.alias("client"), null.alias("create_dt"),
                             null.alias("update_dt")),
        cards=made.select(k.alias("card_num"), k.alias("account"), null.alias("create_dt"), null.alias("update_dt")),
        terminals=planted_warehouse(spark).terminals, passport_blacklist=None, transactions=None)
    at, i = F.col("at"), F.col("id")
    tx = made.withColumn("at", F.explode(F.sequence(F.lit(0), F.lit(2)))).select(
        F.concat_ws("-", "id", "at").alias("trans_id"),
        (F.lit("2021-03-03 10:00:00").cast("timestamp_ntz") + F.make_dt_interval(mins=at * (1 + i % 5 * 20))).alias("trans_date"),
        k.alias("card_num"), F.lit("WITHDRAW").alias("oper_type"), (F.lit(90) - at * (i % 3)).cast(schemas.AMOUNT).alias("amt"),
        F.when((at == 2) | (i % 2 == 0), "SUCCESS").otherwise("REJECT").alias("oper_result"), F.lit("T1").alias("terminal"))
    kw, base = {"n_rejects": 2, "seconds": 3600}, str(tmp_path)

    def build():
        stream = srules.transaction_stream(spark, f"{base}/src/*")
        return typed.stream_amount_guess_typed(wh, stream, REPORT_DT, AS_OF, **kw)

    tx.coalesce(1).write.parquet(f"{base}/src/slice0")
    q = (build().writeStream.format("parquet").option("path", f"{base}/out").option("checkpointLocation", f"{base}/ck")
         .trigger(availableNow=True).start())
    q.awaitTermination()
    held = max(p["stateOperators"][0]["numRowsTotal"] for p in q.recentProgress)
    assert 0 < held <= 6 * packed.GROUPS < n
    spark.createDataFrame([FLUSH_ROW], schemas.TRANSACTIONS).write.parquet(f"{base}/src/slice1")
    out = srules.drain_to_table(spark, build(), f"{base}/out", f"{base}/ck")
    batch = rules.fraud_amount_guess(wh.with_(transactions=tx), REPORT_DT, AS_OF, **kw)
    found = sorted(r["trans_id"] for r in out.collect())
    assert found == sorted(r["trans_id"] for r in batch.collect()) and len(found) > 1000


def test_dense_times_beyond_32_bit_seconds(spark, tmp_path):
    spark.range(40_000_000, 40_000_001).withColumnRenamed("id", "event_id").write.parquet(f"{tmp_path}/events.parquet")
    spark.range(3).write.parquet(f"{tmp_path}/supplier.parquet")
    found = lens.dense_transactions(spark, str(tmp_path)).first()
    assert str(found["trans_date"]) == "2100-01-19 18:40:00"
