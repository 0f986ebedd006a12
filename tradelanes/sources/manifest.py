"""Content hashing, change detection and the ingestion manifest.

One rule for both: an arriving item, named by source and path, is compared with the newest content recorded of that item.
So content that comes back after a change (A, B, A) is a change, and equal content under two paths is two items.

The manifest is a versioned table to which every run appends a partition, so concurrent writers never overwrite each
other and runs are numbered in the order of their commits.  A snapshot of the newest record of every item, with the run it goes up
to, spares change detection the history: it reads the snapshot and the runs after it.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradelanes.operators.ordered import previous_in_order
from tradelanes.sources import versions
from tradelanes.sources.schemas import MANIFEST_SCHEMA


def content_hash(content: str | Column) -> Column:
    """SHA-256 hex digest of text or binary content, computed on the executors."""
    c = F.col(content) if isinstance(content, str) else content
    return F.sha2(c, 256)


ITEM = ("source", "path")


def newest_records(recorded: DataFrame, item: Sequence[str] = ITEM, version: str | Sequence[str] = "timestamp") -> DataFrame:
    """The newest recorded hash of every item: the largest ``version``, of equal ones the largest hash.  A record without a
    hash names no content, so it is left out."""
    order = [F.col(c).alias(f"v{k}") for k, c in enumerate([version] if isinstance(version, str) else version)]
    newest = F.max(F.struct(*order, F.col("sha256").alias("sha256")))
    return (recorded.where("sha256 is not null").groupBy(*item).agg(newest.alias("newest"))
            .select(*item, F.col("newest.sha256").alias("newest_sha256")))


def changed_items(arrivals: DataFrame, recorded: DataFrame, item: Sequence[str] = ITEM, version: str | Sequence[str] = "timestamp") -> DataFrame:
    """Arrivals whose hash differs from the newest one recorded for the same item, or that are not recorded.

    Only the newest record counts, so content that comes back after a change (A, B, A) is a change.  Null item
    columns are equal to each other; an arrival without a hash differs from every recorded content."""
    newest = newest_records(recorded, item, version).select(*[F.col(c).alias(f"_{c}") for c in item], "newest_sha256", F.lit(True).alias("_known"))
    same_item = F.lit(True)
    for c in item:
        same_item = same_item & arrivals[c].eqNullSafe(F.col(f"_{c}"))
    joined = arrivals.join(newest, same_item, "left")
    return joined.where(F.col("_known").isNull() | ~F.col("sha256").eqNullSafe(F.col("newest_sha256"))).select(*arrivals.columns)


NO_HASH = "no content hash"


def ingest(batch: DataFrame, recorded: DataFrame | None, order: str, item: Sequence[str] = ITEM) -> DataFrame:
    """Manifest records of one run, in the order of ``order`` (unique in the run).  An item is skipped if its content is the newest
    known of it: what came last before it in the run, else what ``recorded`` has, manifest records or their ``newest_known``.  An item
    without a hash is skipped with a reason and is not known afterwards; no item is lost.

    An item with many arrivals is split over ranges of its arrivals, no task gets them all."""
    hashed = previous_in_order(batch.where("sha256 is not null"), item, order, "sha256", "_before")
    if recorded is not None:
        if "newest_sha256" not in recorded.columns:
            recorded = newest_records(recorded, item, ("run", "arrival") if "run" in recorded.columns else "timestamp")
        known = recorded.select(*[F.col(c).alias(f"_{c}") for c in item], "newest_sha256")
        same = F.lit(True)
        for c in item:
            same = same & F.col(c).eqNullSafe(F.col(f"_{c}"))
        hashed = hashed.join(known, same, "left").withColumn("_before", F.coalesce("_before", "newest_sha256"))
    hashed = hashed.select(*batch.columns, F.col("sha256").eqNullSafe(F.col("_before")).alias("_skipped"))
    rows = hashed.unionByName(batch.where("sha256 is null").withColumn("_skipped", F.lit(True)))
    return manifest_records(rows, F.col("_skipped"), F.when(F.col("sha256").isNull(), NO_HASH), order=order)


def manifest_records(items: DataFrame, skipped: Column, reason: Column | None = None, timestamp: str | None = None,
                     order: str | None = None) -> DataFrame:
    """Shape items (with source, source_url, filename, path, row_count, sha256) into manifest records with the
    run timestamp (ISO, UTC), the reason an item was refused, if any, and its number in the order of the run."""
    ts = timestamp or dt.datetime.now(dt.timezone.utc).isoformat()
    return items.select(
        F.col("source"), F.col("source_url"), F.col("filename"), F.col("path"), F.lit(ts).alias("timestamp"),
        F.col("row_count").cast("long").alias("row_count"), F.col("sha256"), skipped.alias("skipped"),
        (reason if reason is not None else F.lit(None).cast("string")).alias("reason"),
        (F.col(order) if order else F.lit(None)).cast("long").alias("arrival"))


def append_manifest(records: DataFrame, path: str) -> int:
    """Add the records of a run; the number of the run."""
    return versions.append(records.select(*[f.name for f in MANIFEST_SCHEMA.fields]), f"{path}/log", "run")


def read_manifest(spark: SparkSession, path: str, after_run: int = 0) -> DataFrame:
    """All records with their run, or those of the runs after ``after_run`` alone; older runs are not listed."""
    if versions.commit(spark, f"{path}/log") is None:
        return spark.createDataFrame([], T.StructType([*MANIFEST_SCHEMA.fields, T.StructField("run", T.LongType())]))
    return versions.read(spark, f"{path}/log", parts=lambda part: int(part.split("=")[1]) > after_run)


def newest_known(spark: SparkSession, path: str) -> DataFrame:
    """(source, path, newest_sha256): the snapshot, and the runs appended since."""
    snapshot = versions.commit(spark, f"{path}/snapshot")
    tail = read_manifest(spark, path, snapshot.info["run"] if snapshot else 0)
    tail = tail.select(*ITEM, "sha256", "run", "arrival")
    if snapshot is not None:
        kept = versions.read(spark, f"{path}/snapshot", snapshot.version)
        tail = tail.unionByName(kept.select(*ITEM, F.col("newest_sha256").alias("sha256"), F.lit(0).cast("long").alias("run"), F.lit(0).cast("long").alias("arrival")))
    return newest_records(tail, version=("run", "arrival"))


def compact(spark: SparkSession, path: str) -> int:
    """Write a new snapshot, up to the newest run.  The runs stay; change detection does not read them any more."""
    log = versions.commit(spark, f"{path}/log")
    known = versions.versions(spark, f"{path}/snapshot")
    return versions.replace(newest_known(spark, path), f"{path}/snapshot", based_on=known[-1] if known else 0,
                            info={"run": log.version if log else 0})


def ingest_run(batch: DataFrame, path: str, order: str) -> int:
    """A whole run: compare with what is known, append the records; the number of the run."""
    return append_manifest(ingest(batch, newest_known(batch.sparkSession, path), order), path)
