"""Landed CSV scans, column contracts, landing, refresh, row counts, layout
(S1-S4, S7-S10, S12)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradelanes.operators.ordered import rows_ahead
from tradelanes.session import stored


def read_landed_csv(spark: SparkSession, path: str, schema: T.StructType, glob: str | None = None,
                    recursive: bool = False) -> DataFrame:
    """CSV with a header and a declared schema.

    ``enforceSchema=False`` makes Spark compare every file's header with the
    schema's names, so a file with reordered or renamed columns fails loudly
    instead of loading into the wrong columns.  ``glob`` picks members by file
    name (``pathGlobFilter``), ``recursive`` walks sub-folders.  An unquoted
    empty field and a quoted empty string are both read as NULL.
    """
    r = (spark.read.schema(schema).option("header", True).option("enforceSchema", False)
         .option("mode", "FAILFAST"))
    if glob:
        r = r.option("pathGlobFilter", glob)
    if recursive:
        r = r.option("recursiveFileLookup", True)
    return r.csv(path)


def present(spark: SparkSession, path: str) -> bool:
    """Whether a finished write is at ``path``."""
    done = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
    return done.getFileSystem(spark._jsc.hadoopConfiguration()).exists(done)


def load_dim(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """A seed dimension from CSV with a header and a declared schema.

    No ``nullValue`` is set, so literal text such as ``NA`` (a state code)
    stays text; only empty fields are NULL.  Joins broadcast it if its files are small.
    """
    return (spark.read.schema(schema).option("header", True).option("enforceSchema", False)
            .option("mode", "FAILFAST").csv(path))


def file_headers(spark: SparkSession, path: str, glob: str | None = None, recursive: bool = True) -> DataFrame:
    """First line of every file under ``path``: (file_path, header).

    Read as text with the hidden ``_metadata`` column; only rows of the block
    that starts at offset 0 can be a first line, and within a task rows arrive
    in file order, so the row with the smallest generated id of that block is
    the header.  The per-file pick is a grouped aggregate.
    """
    r = spark.read
    if glob:
        r = r.option("pathGlobFilter", glob)
    if recursive:
        r = r.option("recursiveFileLookup", True)
    t = r.text(path).select("value", F.col("_metadata.file_path").alias("file_path"),
                            F.col("_metadata.file_block_start").alias("block_start"),
                            F.monotonically_increasing_id().alias("_id"))
    first = t.where(F.col("block_start") == 0).groupBy("file_path").agg(F.min_by("value", "_id").alias("header"))
    # From the listing, which Spark's scan of empty files leaves out: a file without any line has a null header
    listed = spark.read.format("binaryFile")
    if glob:
        listed = listed.option("pathGlobFilter", glob)
    if recursive:
        listed = listed.option("recursiveFileLookup", True)
    names = spark.createDataFrame([(f,) for f in listed.load(path).inputFiles()], "file_path string")
    plain = lambda c: F.regexp_replace(c, "^([a-z0-9]+):/+", "$1:/")
    return (names.select(plain("file_path").alias("file_path"))
            .join(first.select(plain("file_path").alias("file_path"), "header"), "file_path", "left"))


def contract_report(spark: SparkSession, path: str, required: Sequence[str], glob: str | None = None,
                    case_sensitive: bool = False) -> DataFrame:
    """S3: one row per landed file and missing required column (NULL when none
    is missing; all of them for an empty file).  Subset check, extra columns allowed."""
    fold = (lambda c: c) if case_sensitive else F.lower
    names = F.split("header", ',(?=(?:[^"]*"[^"]*")*[^"]*$)')  # commas outside quotes
    names = F.transform(names, lambda x: fold(F.regexp_replace(F.trim(x), '^"|"$', "")))
    have = F.coalesce(names, F.array().cast("array<string>"))
    need = F.array(*[F.lit(c) for c in required])
    missing = F.filter(need, lambda c: ~F.array_contains(have, fold(c)))
    return file_headers(spark, path, glob).select("file_path", F.explode_outer(missing).alias("missing_column"))


def require_columns(df: DataFrame, required: Sequence[str]) -> DataFrame:
    """S3 for one frame: fail at plan time if a required column is absent (names compare without case)."""
    have = {c.lower() for c in df.columns}
    missing = [c for c in required if c.lower() not in have]
    if missing:
        raise ValueError(f"missing required columns: {missing}")
    return df


def land(df: DataFrame, base: str, source: str, partition_cols: Sequence[str] = ("year", "month"),
         fmt: str = "csv", mode: str = "append") -> str:
    """Write arriving rows under ``source=/year=/month=`` folders, kept as
    received (CSV with a header by default)."""
    # Rows of a folder meet in few tasks, so there are few files; a large folder is split again
    w = (df.withColumn("source", F.lit(source)).hint("rebalance", *[F.col(c) for c in partition_cols]).write.mode(mode)
         .partitionBy("source", *partition_cols))
    if fmt == "csv":
        w.option("header", True).csv(base)
    else:
        w.format(fmt).save(base)
    return base


def refresh(df: DataFrame, path: str, partition_cols: Sequence[str] = (), fmt: str = "parquet") -> str:
    """Full refresh.  Without partition columns the table is replaced;
    with them only the partitions present in ``df`` are replaced (dynamic
    partition overwrite), so reloading one month keeps every other month."""
    w = df.write.mode("overwrite")
    if partition_cols:
        w = (df.hint("rebalance", *[F.col(c) for c in partition_cols]).write.mode("overwrite")
             .option("partitionOverwriteMode", "dynamic").partitionBy(*partition_cols))
    w.format(fmt).save(path)
    return path


def write_counted(df: DataFrame, path: str, name: str, fmt: str = "parquet") -> int:
    """Write ``df`` and return the number of rows written, counted by an
    observation during the same job (no second pass)."""
    obs = Observation(name)
    df.observe(obs, F.count(F.lit(1)).alias("rows")).write.mode("overwrite").format(fmt).save(path)
    return int(obs.get["rows"])


def materialize(df: DataFrame, path: str, fmt: str = "parquet") -> DataFrame:
    """Write a node's result to the shared folder and read it back,
    cutting lineage so a lost executor does not recompute the upstream plan."""
    df.write.mode("overwrite").format(fmt).save(path)
    return df.sparkSession.read.format(fmt).load(path)


CODE_BITS = 8  # of a column in an interleaved key


def interleaved(df: DataFrame, columns: Sequence[str], name: str = "_z") -> DataFrame:
    """``df`` with a clustering key for several columns at once: each value's place in the order of its column, as CODE_BITS bits of
    equal shares of the rows, and the bits of all columns by turns.  Rows close in the key are close in every column, so a
    filter on any one of them meets few row groups.

    Places come from counts per distinct value (``rows_ahead``), so a column may have any type and number of values; NULLs are last."""
    out = stored(df, "clustered")
    for k, c in enumerate(columns):
        counts = out.groupBy(c).agg(F.count(F.lit(1)).alias("n")).withColumn("all_rows", F.lit(True))
        codes = rows_ahead(counts, ["all_rows"], c, F.col(c).asc_nulls_last()).select(
            F.col(c).alias("_value"), F.floor(F.col("before") * F.lit(1 << CODE_BITS) / F.col("all")).cast("int").alias(f"_code{k}"))
        out = out.join(codes, F.col(c).eqNullSafe(F.col("_value"))).drop("_value")
    key = F.lit(0).cast("long")
    for bit in range(CODE_BITS):
        for k in range(len(columns)):
            one = F.shiftright(F.col(f"_code{k}"), bit).bitwiseAND(F.lit(1)).cast("long")
            key = key.bitwiseOR(F.shiftleft(one, bit * len(columns) + len(columns) - 1 - k))
    return out.withColumn(name, key).drop(*[f"_code{k}" for k in range(len(columns))])


GOLD_CLUSTER = ("origin_state", "commodity_category")
#: Parquet writer options of the big mart: Bloom filters tell the row groups that min and max cannot.
GOLD_OPTIONS = {f"parquet.bloom.filter.enabled#{c}": "true" for c in ("origin_zone", "destination_zone", "origin_name", "commodity_name")}


def gold_layout(flows: DataFrame, cluster: Sequence[str] = GOLD_CLUSTER) -> DataFrame:
    """Rows in the order in which the big mart is written: by year, then by the interleaved key of the other filter
    columns.  Range partitioning spreads one large year over many tasks instead of one task per year."""
    keyed = interleaved(flows, cluster)
    return keyed.repartitionByRange("year", "_z").sortWithinPartitions("year", "_z").drop("_z")


def write_gold_flows(flows: DataFrame, path: str, sort_cols: Sequence[str] = GOLD_CLUSTER,
                     max_records_per_file: int = 5_000_000) -> str:
    """Read-optimised layout of the big mart: year folders for partition pruning, and inside them rows clustered by all
    ``sort_cols`` together, so parquet row-group min/max statistics skip most groups for a filter on any of them."""
    (gold_layout(flows, sort_cols).write.mode("overwrite").option("maxRecordsPerFile", max_records_per_file)
     .options(**GOLD_OPTIONS).partitionBy("year").parquet(path))
    return path
