"""Daily feed files: discovery, scans and normalisation.

Feeds land in one folder: ``transactions_DDMMYYYY.txt`` (``;``-separated
text with a header and a decimal comma), ``terminals_DDMMYYYY.xlsx`` (full
slice) and ``passport_blacklist_DDMMYYYY.xlsx`` (cumulative for the month).
Files are found with ``pathGlobFilter`` (recursively, so a day may arrive as
several part files in sub-folders) and every row carries its file's name and
business date, taken from the name. Order never depends on listing order.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fraudmart import schemas
from fraudmart.functions import amount_from_text, business_date, date_tag
from fraudmart.sources import files


def _file_id() -> Column:
    """A feed file's identity: path, modification time and size. A file that
    arrives under a name used before is another file."""
    return F.substring(F.sha2(F.concat_ws("|", "_metadata.file_path", F.unix_micros("_metadata.file_modification_time"),
                                          "_metadata.file_size"), 256), 1, 20)


def _with_file(df: DataFrame) -> DataFrame:
    name = F.col("_metadata.file_name")
    return df.withColumns({"file_name": name, "file_path": F.col("_metadata.file_path"), "file_id": _file_id(),
                           "business_dt": business_date(name)})


def discover(spark: SparkSession, landing: str, glob: str, exclude: Sequence[str] = ()) -> DataFrame:
    """File listing as a DataFrame (file_path, file_name, file_id, length,
    business_dt); the content column of ``binaryFile`` is pruned, so nothing is
    read. Folders in ``exclude`` are not part of the landing folder."""
    df = (spark.read.format("binaryFile").option("pathGlobFilter", glob)
          .option("recursiveFileLookup", "true").load(landing))
    out = df.select(F.col("path").alias("file_path"), F.element_at(F.split("path", "/"), -1).alias("file_name"),
                    _file_id().alias("file_id"), "length").withColumn("business_dt", business_date("file_name"))
    for folder in exclude:
        out = out.filter(~F.col("file_path").startswith(files.qualify(spark, folder) + "/"))
    return out


def feed_header(spark: SparkSession, path: str) -> tuple[str, ...]:
    """Column names of a transaction feed file, in its order."""
    return tuple(h.strip().strip('"').lstrip("\ufeff") for h in files.first_line(spark, path).split(";"))


def missing_columns(header: tuple[str, ...]) -> list[str]:
    return [f.name for f in schemas.TX_FEED.fields if f.name not in header]


def read_tx_feed(spark: SparkSession, landing: str | list[str]) -> DataFrame:
    """Scan transaction feed files; every column stays a string. Columns are
    taken by the names in each file's header line (one short read per file, as
    the listing is), so files may order them as they like; a file without one of
    the columns is an error. ``bad_line`` is the text of a line with too few or too
    many fields, null for others; which lines those are does not depend on the
    columns a query reads."""
    if isinstance(landing, str):
        paths = [r["file_path"] for r in discover(spark, landing, schemas.TX_FEED_GLOB).select("file_path").collect()]
    else:
        paths = list(landing)
    by_header: dict[tuple[str, ...], list[str]] = {}
    for p in paths:
        by_header.setdefault(feed_header(spark, p), []).append(p)
    names = [f.name for f in schemas.TX_FEED.fields]
    out = None
    for header, group in sorted(by_header.items()):
        if missing_columns(header):
            raise ValueError(f"no column {', '.join(missing_columns(header))} in {group}")
        schema = schemas.T.StructType([schemas.T.StructField(h, schemas.T.StringType()) for h in (*header, "bad_line")])
        df = (spark.read.schema(schema).option("sep", ";").option("header", "true").option("mode", "PERMISSIVE")
              .option("columnNameOfCorruptRecord", "bad_line").option("columnPruning", "false").csv(group))
        df = _with_file(df).select(*names, "bad_line", "file_name", "file_path", "file_id", "business_dt")
        out = df if out is None else out.unionByName(df)
    if out is None:
        out = spark.createDataFrame([], schemas.TX_FEED).withColumns(
            {c: F.lit(None).cast("string") for c in ("bad_line", "file_name", "file_path", "file_id")}
            | {"business_dt": F.lit(None).cast(schemas.TS)})
    return out


def normalise_transactions(feed: DataFrame) -> DataFrame:
    """Feed columns -> the transaction table: renames, decimal comma to point,
    text timestamp to timestamp; ``load_dt`` is the file's business day,
    ``trans_day`` the operation's."""
    return feed.select(
        F.trim("transaction_id").alias("trans_id"),
        F.trim("transaction_date").try_cast(schemas.TS).alias("trans_date"),
        F.trim("card_num").alias("card_num"),
        F.trim("oper_type").alias("oper_type"),
        amount_from_text("amount").alias("amt"),
        F.trim("oper_result").alias("oper_result"),
        F.trim("terminal").alias("terminal"),
        F.col("business_dt").cast("date").alias("load_dt"),
        "file_name",
        F.trim("transaction_date").try_cast(schemas.TS).cast("date").alias("trans_day"),
        "file_id",
    )


def well_formed(feed: DataFrame) -> DataFrame:
    """Lines with the header's number of fields."""
    return feed.filter(F.col("bad_line").isNull())


def transaction_rejects(feed: DataFrame) -> DataFrame:
    """Lines that cannot be used as they are: ``file_path``, ``line``, ``reason``, ``file_id``.
    ``fields``: too few or too many (the line is in no table); ``time``, ``amount``: one that
    does not parse (the row is stored with a null in its place)."""
    bad_time = F.trim("transaction_date").try_cast(schemas.TS).isNull()
    reason = F.concat_ws(", ", F.when(F.col("bad_line").isNotNull(), "fields"),
                         F.when(F.col("bad_line").isNull() & bad_time, "time"),
                         F.when(F.col("bad_line").isNull() & amount_from_text("amount").isNull(), "amount"))
    line = F.concat_ws(";", *[F.coalesce(F.col(f.name), F.lit("")) for f in schemas.TX_FEED.fields])
    return (feed.withColumn("reason", reason).filter("reason <> ''")
            .select("file_path", F.coalesce("bad_line", line).alias("line"), "reason", "file_id"))


def to_feed_text(transactions: DataFrame) -> DataFrame:
    """The transaction table in feed layout (strings, decimal comma, whole
    seconds as the feed has them) with the day it belongs to."""
    return transactions.select(
        F.col("trans_id").alias("transaction_id"),
        F.date_format("trans_date", "yyyy-MM-dd HH:mm:ss").alias("transaction_date"),
        F.regexp_replace(F.col("amt").cast("string"), r"\.", ",").alias("amount"),
        "card_num", "oper_type", "oper_result", "terminal",
        date_tag(F.to_date("trans_date")).alias("_feed_day"),
    )


def publish(spark: SparkSession, staging: str, target: str, prefix: str, ext: str,
            day_col_dir: str = "_feed_day") -> list[str]:
    """Give Spark's part files feed names: ``staging/_feed_day=DDMMYYYY/part-N``
    becomes ``target/part-N/<prefix>_DDMMYYYY.<ext>`` (one metadata rename per
    file, no data moves through the driver)."""
    out = []
    for path in files.list_files(spark, staging):
        parent, name = path.rsplit("/", 2)[-2:]
        if not parent.startswith(day_col_dir + "="):
            continue
        day = parent.split("=", 1)[1]
        part = name.split(".", 1)[0]
        dst = f"{target.rstrip('/')}/{part}-{day}/{prefix}_{day}.{ext}"
        files.rename(spark, path, dst)
        out.append(dst)
    return out


def write_tx_feed(spark: SparkSession, transactions: DataFrame, staging: str, landing: str) -> list[str]:
    """Write transactions as daily feed files into ``landing``."""
    (to_feed_text(transactions).write.mode("overwrite").partitionBy("_feed_day")
     .option("sep", ";").option("header", "true").csv(staging))
    return publish(spark, staging, landing, "transactions", "txt")
