"""The warehouse on storage: one Parquet table per folder below a root.

* dimensions (cards, accounts, clients): seeded once, only when empty;
* transactions: partitioned by ``trans_day`` (the day of the operation, so a
  report since an instant prunes) and ``file_id`` (the feed file's path, time and
  size): each file is its own unit, loading it again replaces exactly its
  partitions, and no load touches another file's rows;
* terminals: history in key buckets with a manifest (``sources.buckets``): a load
  writes the open rows of the buckets it touches and the rows it closes;
* passport_blacklist: insert-only, appended; a key seen earlier in an older
  file gets one more row, and readers take its earliest ``effective_from``;
* reporting_list: partitioned by ``report_dt``; a run replaces its own slice,
  also by an empty one;
* _rejects: lines of text feeds that could not be used as they are, by file;
* _ingest_ledger: one row per loaded feed file.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fraudmart import schemas
from fraudmart.sources import files
from fraudmart.sources.buckets import BucketedHistory
from fraudmart.warehouse import Warehouse

#: Validity histories by key bucket: keys and attributes.
HISTORIES = {"terminals": (["terminal_id", "terminal_type"], ["terminal_city", "terminal_address"])}
PARTITIONS = {"transactions": ["trans_day", "file_id"], "reporting_list": ["report_dt"], "_rejects": ["file_id"]}
TX_STORED = schemas.T.StructType(list(schemas.TRANSACTIONS.fields)
                                 + [schemas.T.StructField("load_dt", schemas.T.DateType()),
                                    schemas.T.StructField("file_name", schemas.T.StringType()),
                                    schemas.T.StructField("trans_day", schemas.T.DateType()),
                                    schemas.T.StructField("file_id", schemas.T.StringType())])
LEDGER = (schemas.T.StructType()
          .add("kind", "string").add("file_path", "string").add("file_name", "string")
          .add("business_dt", schemas.TS).add("file_id", "string").add("loaded_at", schemas.TS))
REJECTS = (schemas.T.StructType()
           .add("file_path", "string").add("line", "string").add("reason", "string").add("file_id", "string"))
SCHEMAS = dict(schemas.WAREHOUSE_TABLES, transactions=TX_STORED, _ingest_ledger=LEDGER, _rejects=REJECTS)


class TableStore:
    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def history(self, name: str) -> BucketedHistory:
        keys, attrs = HISTORIES[name]
        return BucketedHistory(self.spark, self.path(name), keys, attrs, SCHEMAS[name])

    def location(self, name: str) -> str | None:
        p = self.path(name)
        return p if files.exists(self.spark, f"{p}/_SUCCESS") or files.list_files(self.spark, p) else None

    def exists(self, name: str) -> bool:
        if name in HISTORIES:
            return self.history(name).exists()
        return self.location(name) is not None

    def read(self, name: str) -> DataFrame:
        if name in HISTORIES:
            return self.history(name).read()
        loc = self.location(name)
        if loc is None:
            return self.spark.createDataFrame([], SCHEMAS[name])
        df = self.spark.read.schema(SCHEMAS[name]).parquet(loc)
        if name == "passport_blacklist":
            df = (df.groupBy("passport_num", "entry_dt")
                  .agg(F.min("effective_from").alias("effective_from"), F.max("effective_to").alias("effective_to"),
                       F.max("deleted_flg").alias("deleted_flg")))
        return df

    def is_empty(self, name: str) -> bool:
        return (not self.exists(name)) or self.read(name).isEmpty()

    def append(self, name: str, df: DataFrame) -> None:
        w = df.write.mode("append")
        if name in PARTITIONS:
            w = w.partitionBy(*PARTITIONS[name])
        w.parquet(self.path(name))

    def overwrite_partitions(self, name: str, df: DataFrame) -> None:
        """Replace exactly the partitions present in ``df`` (dynamic mode)."""
        (df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy(*PARTITIONS[name]).parquet(self.path(name)))

    def replace_partition(self, name: str, df: DataFrame, value: str) -> None:
        """Replace one named partition of a table with a single partition
        column, also when ``df`` has no rows."""
        (column,) = PARTITIONS[name]
        df.drop(column).write.mode("overwrite").parquet(f"{self.path(name)}/{column}={value}")

    def warehouse(self) -> Warehouse:
        return Warehouse(cards=self.read("cards"), accounts=self.read("accounts"),
                         clients=self.read("clients"), terminals=self.read("terminals"),
                         passport_blacklist=self.read("passport_blacklist"),
                         transactions=self.read("transactions"))


def seed_if_empty(store: TableStore, name: str, seed: DataFrame) -> bool:
    """Seed a dimension only when it has no rows; returns whether it wrote."""
    if not store.is_empty(name):
        return False
    cols = [f.name for f in SCHEMAS[name].fields]
    store.append(name, seed.select(*cols))
    return True


def ensure_dimensions(store: TableStore, seeds: dict[str, DataFrame]) -> dict[str, bool]:
    return {name: seed_if_empty(store, name, df) for name, df in seeds.items()}


def ensure_history_tables(store: TableStore) -> list[str]:
    """Create every missing table empty, with its schema (CREATE TABLE IF NOT
    EXISTS). Column defaults (open end, deleted_flg = 0, load time) are set by
    the loaders that write rows. Returns the tables it created."""
    made = []
    for name in ("terminals", "passport_blacklist", "transactions", "reporting_list"):
        if store.exists(name):
            continue
        if name in HISTORIES:
            store.history(name).create()
        else:
            w = store.spark.createDataFrame([], SCHEMAS[name]).write.mode("append")
            if name in PARTITIONS:
                w = w.partitionBy(*PARTITIONS[name])
            w.parquet(store.path(name))
        made.append(name)
    return made
