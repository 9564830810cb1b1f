"""The daily job: ensure tables, load new feed files, build the report.

Every step is idempotent, and the ledger is written only after the data, so
a crash anywhere means "run again": each transaction file is its own unit of
the table and replaces only itself, terminal history is what all slices give in
any order, blacklist rows are inserted only when absent, and the report replaces
its report_dt slice. Files that cannot be read as asked (no business date in
the name, a missing sheet or column) are reported, stay in the landing folder
and are neither loaded, listed in the ledger nor archived.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fraudmart import schemas
from fraudmart.operators import history, report, rules
from fraudmart.session import scratch_path
from fraudmart.sources import feeds, files, workbook
from fraudmart.sources.store import TableStore, ensure_dimensions, ensure_history_tables

TERMINAL_KEYS = ["terminal_id", "terminal_type"]
TERMINAL_ATTRS = ["terminal_city", "terminal_address"]
BLACKLIST_KEYS = ["passport_num", "entry_dt"]


@dataclass
class DayResult:
    seeded: dict[str, bool] = field(default_factory=dict)
    loaded_files: dict[str, list[str]] = field(default_factory=dict)
    rejected_files: dict[str, str] = field(default_factory=dict)
    exported: list[str] = field(default_factory=list)
    rejects: dict[str, int] = field(default_factory=dict)


@dataclass
class Loaded:
    """Files of one kind: loaded paths and ids, rejected path -> reason, and
    the number of rows that could not be used."""

    paths: list[str] = field(default_factory=list)
    ids: list[str] = field(default_factory=list)
    rejected: dict[str, str] = field(default_factory=dict)
    rejects: int = 0


def new_files(store: TableStore, listing: DataFrame, kind: str) -> DataFrame:
    """Listed feed files not yet in the ingest ledger (anti join on the file's
    identity: path, time and size)."""
    done = store.read("_ingest_ledger").filter(F.col("kind") == kind).select("file_id")
    return listing.join(done, "file_id", "left_anti")


def _record(store: TableStore, kind: str, loaded: DataFrame) -> None:
    store.append("_ingest_ledger", loaded.select(
        F.lit(kind).alias("kind"), "file_path", "file_name", "business_dt", "file_id",
        F.localtimestamp().cast(schemas.TS).alias("loaded_at")))


def _fresh(spark: SparkSession, store: TableStore, landing: str, glob: str, kind: str,
           exclude: Sequence[str]) -> tuple[DataFrame, dict[str, str]]:
    """New files as a small stored table (the listing must not change while
    they are loaded), and those without a business date."""
    path = scratch_path(spark, "new-files")
    new_files(store, feeds.discover(spark, landing, glob, exclude), kind).write.parquet(path)
    fresh = spark.read.parquet(path)
    undated = fresh.filter(F.col("business_dt").isNull()).select("file_path").collect()
    return (fresh.filter(F.col("business_dt").isNotNull()),
            {r["file_path"]: "no business date in the name" for r in undated})


def load_transactions(spark: SparkSession, store: TableStore, landing: str,
                      exclude: Sequence[str] = ()) -> Loaded:
    """Load every new transaction file as its own unit. Only file names reach
    the driver (one per file, as any file scan lists them)."""
    fresh, rejected = _fresh(spark, store, landing, schemas.TX_FEED_GLOB, "transactions", exclude)
    found = {r["file_path"]: r["file_id"] for r in fresh.select("file_path", "file_id").collect()}
    for path in list(found):
        if missing := feeds.missing_columns(feeds.feed_header(spark, path)):
            rejected[path] = "no column " + ", ".join(missing)
            del found[path]
    out = Loaded(sorted(found), sorted(found.values()), rejected)
    if found:
        feed = feeds.read_tx_feed(spark, out.paths)
        store.overwrite_partitions("_rejects", feeds.transaction_rejects(feed))
        store.overwrite_partitions("transactions", feeds.normalise_transactions(feeds.well_formed(feed)))
        _record(store, "transactions", fresh.filter(F.col("file_path").isin(out.paths)))
        out.rejects = transaction_rejects(store, out.ids)
    return out


def _workbooks(spark: SparkSession, fresh: DataFrame, rejected: dict[str, str], sheet: str,
               columns: Sequence[str]) -> tuple[Loaded, DataFrame | None]:
    rows = {r["file_path"]: r["file_id"] for r in fresh.select("file_path", "file_id").collect()}
    if not rows:
        return Loaded(rejected=rejected), None
    path = scratch_path(spark, "workbooks")  # each workbook is parsed once
    workbook.checked_workbooks(_contents(spark, sorted(rows)), sheet, columns).write.parquet(path)
    parsed = spark.read.parquet(path)
    for r in parsed.filter("problem is not null").select("file_path", "problem").distinct().collect():
        rejected[r["file_path"]] = r["problem"]
        del rows[r["file_path"]]
    done = Loaded(sorted(rows), sorted(rows.values()), rejected)
    return done, parsed.filter("problem is null") if rows else None


def _contents(spark: SparkSession, paths: list[str]) -> DataFrame:
    return spark.read.format("binaryFile").load(paths).select(F.col("path").alias("file_path"), "content")


def load_terminals(spark: SparkSession, store: TableStore, landing: str,
                   close_missing: bool = False, exclude: Sequence[str] = ()) -> Loaded:
    fresh, rejected = _fresh(spark, store, landing, schemas.TERMINAL_FEED_GLOB, "terminals", exclude)
    done, parsed = _workbooks(spark, fresh, rejected, schemas.TERMINAL_SHEET, workbook.TERMINAL_COLUMNS)
    if parsed is None:
        return done
    no_id = F.col("terminal_id").isNull() | (F.col("terminal_id") == "")
    slices = workbook.terminal_slices(parsed).withColumn("_row", F.struct("file_name", "row_no"))
    done.rejects = slices.filter(no_id).count()
    store.history("terminals").load(slices.filter(~no_id), "_row", close_missing)
    _record(store, "terminals", fresh.filter(F.col("file_path").isin(done.paths)))
    return done


def load_blacklist(spark: SparkSession, store: TableStore, landing: str,
                   exclude: Sequence[str] = ()) -> Loaded:
    fresh, rejected = _fresh(spark, store, landing, schemas.BLACKLIST_FEED_GLOB, "passport_blacklist", exclude)
    done, parsed = _workbooks(spark, fresh, rejected, schemas.BLACKLIST_SHEET, workbook.BLACKLIST_COLUMNS)
    if parsed is None:
        return done
    incoming = workbook.blacklist_rows(parsed)
    done.rejects = history.insert_if_absent_rejects(incoming, BLACKLIST_KEYS).count()
    existing = store.read("passport_blacklist") if store.exists("passport_blacklist") else None
    new = history.insert_if_absent(existing, incoming, BLACKLIST_KEYS)
    # Materialise before appending: the join reads the table we append to.
    staged = scratch_path(spark, "blacklist")
    new.write.parquet(staged)
    store.append("passport_blacklist", spark.read.parquet(staged))
    _record(store, "passport_blacklist", fresh.filter(F.col("file_path").isin(done.paths)))
    return done


def archive(spark: SparkSession, paths: list[str], landing: str, archive_dir: str) -> list[str]:
    """Move processed feed files below ``archive_dir``, keeping their place
    below the landing folder. A name already archived gets a numbered folder."""
    base, target = files.qualify(spark, landing), files.qualify(spark, archive_dir)
    if base == target or base.startswith(target + "/"):
        raise ValueError(f"the archive {target} must not hold the landing folder {base}")
    out = []
    for p in paths:
        full = files.qualify(spark, p)
        if not full.startswith(base + "/"):
            raise ValueError(f"{full} is not below {base}")
        rel, n = full[len(base) + 1:], 0
        dst = f"{target}/{rel}"
        while files.exists(spark, dst):
            n += 1
            dst = f"{target}/again-{n}/{rel}"
        files.rename(spark, full, dst)
        out.append(dst)
    return out


def transaction_rejects(store: TableStore, file_ids: list[str]) -> int:
    """Lines of the loaded feed files that could not be used as they are (the table
    ``_rejects`` holds them with file and reason)."""
    if not file_ids:
        return 0
    return store.read("_rejects").filter(F.col("file_id").isin(file_ids)).count()


def load_feeds(spark: SparkSession, landing: str, root: str, close_missing: bool = False,
               exclude: Sequence[str] = ()) -> dict[str, Loaded]:
    """Load every new feed file of the landing folder into the warehouse."""
    store = TableStore(spark, root)
    return {"terminals": load_terminals(spark, store, landing, close_missing, exclude),
            "transactions": load_transactions(spark, store, landing, exclude),
            "passport_blacklist": load_blacklist(spark, store, landing, exclude)}


def run_day(spark: SparkSession, landing: str, root: str, seeds: dict[str, DataFrame] | None = None,
            report_dt: _dt.date | str | None = None, as_of=None, export_dir: str | None = None,
            archive_dir: str | None = None, since=None, close_missing: bool = False,
            city_hop_emit: str = "both", point_in_time: bool = False,
            distinct_events: bool = False) -> DayResult:
    """One daily run. With ``since`` the report holds only events established
    from that instant on (computed from a bounded slice of history) instead of
    the whole history re-reported under the new date. Warehouse, archive and
    export may lie below the landing folder; they are not searched for feeds."""
    store = TableStore(spark, root)
    res = DayResult()
    if seeds:
        res.seeded = ensure_dimensions(store, seeds)
    ensure_history_tables(store)
    base = files.qualify(spark, landing)
    own = [f for f in (root, archive_dir, export_dir) if f and files.qualify(spark, f) != base]
    loaded = load_feeds(spark, landing, root, close_missing, own)
    for kind, done in loaded.items():
        res.loaded_files[kind] = done.paths
        res.rejects[kind] = done.rejects
        res.rejected_files |= done.rejected
    report_dt = report_dt or rules.default_report_dt()
    rep = report.build_report(store.warehouse(), report_dt, as_of, since=since, city_hop_emit=city_hop_emit,
                              point_in_time=point_in_time, distinct_events=distinct_events)
    report.write_report(store, rep, report_dt)
    if export_dir:
        day = report.report_for_day(store, report_dt)
        res.exported = report.export_report(spark, day, export_dir, report_dt,
                                            scratch_path(spark, "export"))
    if archive_dir:
        for paths in res.loaded_files.values():
            archive(spark, paths, landing, archive_dir)
    return res
