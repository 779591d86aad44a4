"""The stored trade table: parquet partitioned by FLOW and YEAR."""

from __future__ import annotations

import hashlib
import inspect
import json
import threading
import time
import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import dims as dims_module
from ..dims import Dims, fixture_dims
from ..functions import scalars
from ..operators import enrich
from ..operators.enrich import enrich_trade
from ..operators.load import ARRIVAL, keep_last, without_keys
from ..schema import COMMODITY_TAG, FLOW, FLOWS, MONTH, PARTNER, REPORTER, REPORTER_REGION, YEAR
from ..session import app_id, checkpoint_root
from . import commits, files, testdata
from .testdata import trade_view

PARTITION_COLUMNS = [FLOW, YEAR]
SCHEMA_FILE = "_trade_schema.json"      # of tables written before commits had notes
_SOURCE_TABLES = ["lineitem", "orders", "customer", "supplier", "nation", "region"]
_dims_cache: dict = {}
_table_cache: dict = {}
_table_lock = threading.Lock()


def normalise(df: DataFrame) -> DataFrame:
    """Load-time schema normalisation of older table layouts.

    MONTH_NUM -> MONTH, HS4_TAG -> COMMODITY_TAG, REPORTER_REGION = "Other"
    when the column is missing.
    """
    cols = set(df.columns)
    if "MONTH_NUM" in cols and MONTH not in cols:
        df = df.withColumnRenamed("MONTH_NUM", MONTH)
    if "HS4_TAG" in cols and COMMODITY_TAG not in cols:
        df = df.withColumnRenamed("HS4_TAG", COMMODITY_TAG)
    if REPORTER_REGION not in cols:
        df = df.withColumn(REPORTER_REGION, F.lit("Other"))
    return df


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """Parquet scan of the stored table; Catalyst prunes columns and partitions.

    A table written by ``upsert_table`` carries its schema: files of older
    layouts give null for columns they lack, and null years keep their type.
    """
    schema = commits.last(spark, path)["schema"] or files.read_text(spark, f"{path}/{SCHEMA_FILE}")
    reader = spark.read if schema is None else spark.read.schema(T.StructType.fromJson(json.loads(schema)))
    return normalise(reader.parquet(path))


def layout(df: DataFrame, sort: bool = True) -> DataFrame:
    """Write layout of the stored table: AQE rebalance on the partition
    columns (small partitions merged into one file, oversized ones split by
    the advisory size), rows sorted by reporter and partner inside each
    partition so parquet row-group statistics can skip data for
    reporter/partner filters."""
    df = df.hint("rebalance", *PARTITION_COLUMNS)
    return df.sortWithinPartitions(*PARTITION_COLUMNS, REPORTER, PARTNER) if sort else df


def write_table(df: DataFrame, path: str, mode: str = "overwrite", overwrite_mode: str = "static",
                sort: bool = True) -> None:
    (layout(df, sort).write.mode(mode).option("partitionOverwriteMode", overwrite_mode)
     .partitionBy(*PARTITION_COLUMNS).parquet(path))


def test_dims(spark: SparkSession, sf_dir: str) -> Dims:
    key = (app_id(spark), sf_dir)
    if key not in _dims_cache:
        _dims_cache[key] = fixture_dims(spark, sf_dir)
    return _dims_cache[key]


def enriched_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lazy enriched trade rows straight from the test tables."""
    return enrich_trade(trade_view(spark, sf_dir), test_dims(spark, sf_dir))


def _source_fingerprint(spark: SparkSession, sf_dir: str) -> str:
    """Hash of path, size and modification time of every source file (one
    aggregated row) and of the code that derives the view from them."""
    paths = [f"{sf_dir}/{t}.parquet" for t in _SOURCE_TABLES]
    one = F.xxhash64("path", "length", "modificationTime").cast("decimal(38,0)")
    listing = (spark.read.format("binaryFile").load(paths)
               .agg(F.count(F.lit(1)), F.sum(one)).first())
    h = hashlib.sha1("|".join(map(str, listing)).encode())
    for module in (testdata, enrich, dims_module, scalars):
        h.update(inspect.getsource(module).encode())
    return h.hexdigest()[:16]


def trade_path(spark: SparkSession, sf_dir: str) -> str:
    """Path of the stored trade table for ``sf_dir``, written on first use.

    Keyed by a fingerprint of the source files and the deriving code. A
    changed source folder is noticed within a session by its time stamps; a
    table whose write did not finish (no success mark) is written again.
    """
    key = (app_id(spark), sf_dir, tuple(files.stamp_of(spark, f"{sf_dir}/{t}.parquet") for t in _SOURCE_TABLES))
    with _table_lock:
        path = _table_cache.get(key)
        if path is None:
            path = f"{checkpoint_root(spark)}/tradelens/trade-{_source_fingerprint(spark, sf_dir)}"
            if not files.exists(spark, f"{path}/_SUCCESS"):
                write_table(enriched_view(spark, sf_dir), path)
            _table_cache[key] = path
    return path


def load_trade(spark: SparkSession, sf_dir: str, materialize: bool = True) -> DataFrame:
    """The enriched trade table for ``sf_dir``.

    With ``materialize`` the enriched rows are written once, as the ingest
    does, to a parquet table under the shared checkpoint folder and every
    query scans that table; this also cuts the lineage back to the raw joins.
    """
    if not materialize:
        return enriched_view(spark, sf_dir)
    return read_table(spark, trade_path(spark, sf_dir))


def table_freshness(spark: SparkSession, path: str, slack: float = 2.0) -> DataFrame:
    """Per flow: its latest file time and whether the files are those that the
    commits wrote.

    Every partition's file times are held against the start and end of its
    write in the table's record (``slack`` seconds for clocks). Columns: FLOW,
    LAST_MODIFIED, N_PARTITIONS and ROWS by the record, N_STRANGE (partitions
    with a file from outside their write, or without a record), IS_DATED (none).
    """
    record = record_of(spark, path).select(FLOW, F.col(YEAR).alias("_Y"), "ROWS", "WRITE_STARTED", "WRITE_ENDED")
    times = F.col("_metadata.file_modification_time")
    found = read_table(spark, path).select(FLOW, YEAR, times.alias("_T")).groupBy(FLOW, YEAR).agg(F.min("_T").alias("_LO"), F.max("_T").alias("_HI"))
    both = found.withColumnRenamed(FLOW, "_F").join(record, F.col("_F").eqNullSafe(F.col(FLOW)) & F.col(YEAR).eqNullSafe(F.col("_Y")), "left")
    since, until = F.col("_LO").cast("double") + slack, F.col("_HI").cast("double") - slack
    dated = F.coalesce((since >= F.col("WRITE_STARTED")) & (until <= F.col("WRITE_ENDED")), F.lit(False))
    return (both.groupBy(F.col("_F").alias(FLOW)).agg(
        F.max("_HI").alias("LAST_MODIFIED"), F.count("ROWS").alias("N_PARTITIONS"), F.sum("ROWS").alias("ROWS"), F.count_if(~dated).alias("N_STRANGE"))
        .withColumn("IS_DATED", F.col("N_STRANGE") == 0))


def record_of(spark: SparkSession, path: str) -> DataFrame:
    """The write record: one row per partition (flows x years, so a small one)."""
    note = commits.last(spark, path)
    rows = []
    for part, entry in note["partitions"].items():
        flow, year = files.partition_values(part)
        rows.append((flow, None if year is None else int(year), entry["rows"], entry["version"], entry["started"], entry["ended"]))
    return spark.createDataFrame(rows, f"{FLOW} string, {YEAR} int, ROWS long, VERSION long, WRITE_STARTED double, WRITE_ENDED double")


def recorded_audit(spark: SparkSession, path: str) -> DataFrame:
    """Load audit of the last commit from its note, without a scan: as ``load.load_audit``."""
    audit = commits.last(spark, path)["audit"]
    flows = sorted({*audit["before"], *audit["after"], *audit.get("fetched", {})}, key=str)
    rows = []
    for flow in flows:
        before, fetched, after = (audit.get(k, {}).get(flow, 0) for k in ("before", "fetched", "after"))
        rows.append((flow, before, fetched, after, before + fetched, after - before, before + fetched - after))
    return spark.createDataFrame(rows, f"{FLOW} string, ROWS_BEFORE long, ROWS_FETCHED long, ROWS_AFTER long, ROWS_MERGED long, ROWS_NEW long, ROWS_REMOVED_BY_DEDUP long")


def table_exists(spark: SparkSession, path: str) -> bool:
    """Whether the folder holds partitions; told by its path, never by a failed read."""
    return any(c.startswith(f"{FLOW}=") for c in files.children(spark, path))


def recover(spark: SparkSession, path: str) -> None:
    """Carry out the last commit if its job did not get to the end."""
    commits.settle(spark, path)


def _partitions(spark: SparkSession, folder: str) -> list[str]:
    """Partition folders below ``folder``, as FLOW=.../YEAR=..."""
    return [f"{flow}/{year}" for flow in files.children(spark, folder) if flow.startswith(f"{FLOW}=")
            for year in files.children(spark, f"{folder}/{flow}") if year.startswith(f"{YEAR}=")]


def _row_counts(spark: SparkSession, folder: str, schema: T.StructType) -> dict[str, int]:
    """Rows per partition folder, from the files' footers (no column is read). Written
    files can't count a task twice, as an observation may when a stage is run again."""
    df = spark.read.schema(schema).parquet(folder)
    return {_folder(r[0], r[1]): r[2] for r in df.groupBy(FLOW, YEAR).agg(F.count(F.lit(1))).collect()}


def _folder(flow, year) -> str:
    none = "__HIVE_DEFAULT_PARTITION__"
    return f"{FLOW}={none if flow is None else escape(flow)}/{YEAR}={none if year is None else year}"


def escape(value: str) -> str:
    """A partition value as Spark writes it into a folder name."""
    return "".join(f"%{ord(c):02X}" if c in '"#%\'*/:=?\\{[]^\x7f' or c < " " else c for c in value)


def _stored_schema(spark: SparkSession, path: str) -> T.StructType | None:
    """The stored table's schema: of its last note, its schema file, or its files."""
    note = commits.last(spark, path)["schema"] or files.read_text(spark, f"{path}/{SCHEMA_FILE}")
    if note is not None:
        return T.StructType.fromJson(json.loads(note))
    return spark.read.parquet(path).schema if table_exists(spark, path) else None


def _checked(new: DataFrame, stored: T.StructType | None) -> DataFrame:
    """``new`` with the stored types; a month outside 1..12 stops the write."""
    if stored is not None:
        have = {f.name: f.dataType for f in stored.fields}
        wrong = [f"{f.name}: {have[f.name].simpleString()} stored, {f.dataType.simpleString()} new"
                 for f in new.schema.fields if f.name in have and f.dataType != have[f.name]]
        if wrong:
            raise ValueError(f"Column types differ from the stored table: {wrong}")
    if MONTH not in new.columns:
        return new
    month = F.col(MONTH)
    bad = F.raise_error(F.concat(F.lit(f"{MONTH} must be 1..12, got "), month.cast("string")))
    return new.withColumn(MONTH, F.when(month.isNull() | month.between(1, 12), month).otherwise(bad))


def _of_partitions(df: DataFrame, parts: list[str]) -> DataFrame:
    """Rows of some partitions: a literal predicate that prunes the scan to their folders."""
    cond = F.lit(False)
    for flow, year in map(files.partition_values, parts):
        cond = cond | (F.col(FLOW).eqNullSafe(F.lit(flow)) & F.col(YEAR).eqNullSafe(F.lit(None if year is None else int(year)).cast(df.schema[YEAR].dataType)))
    return df.where(cond)


def upsert_table(new: DataFrame, path: str, full: bool = False, fetched: dict[str, int] | None = None) -> dict | None:
    """Keep-last upsert of ``new`` into the table at ``path``; returns the commit's note.

    The batch is deduplicated and written once, in the stored layout, to the
    run's folder inside the table. Partitions the table does not have yet take
    these files as they are; only for those it has are the stored rows read and
    merged with them. The commit (``commits``) renames the files into place.
    Runs may overlap: when another one commits to the same partition first, the
    merge is made again from its result, so no run undoes another's rows; runs
    on other partitions don't meet. A job lost before its commit changes
    nothing; one lost behind it is finished by the next run.

    With ``full`` the new rows replace everything stored for the flows they
    hold; a full load without rows is refused. Columns only one side has are
    null on the other; differing types raise. ``fetched`` are the rows per flow
    that the caller knows it read; else they are observed while the batch is
    written.
    """
    spark, run, started = new.sparkSession, uuid.uuid4().hex, time.time()
    commits.settle(spark, path)
    stored_schema = _stored_schema(spark, path)
    if stored_schema is not None and commits.last(spark, path)["version"] == 0:
        commits.adopt(spark, path, _ordered_schema(stored_schema).json(), _row_counts(spark, path, stored_schema))
    home, batch = f"{path}/{commits.RUNS}/{run}", _checked(new, stored_schema)
    seen = None
    if fetched is None:
        seen = Observation()
        batch = batch.observe(seen, *[F.count_if(F.col(FLOW) == f).alias(f) for f in FLOWS])
    fresh_schema = _ordered_schema(T.StructType([f for f in batch.schema.fields if f.name != ARRIVAL]))
    try:
        write_table(keep_last(batch), f"{home}/fresh")
    except Exception as e:
        files.delete(spark, home)
        if f"{MONTH} must be 1..12" in str(e):
            raise ValueError(f"{MONTH} must be 1..12") from e
        raise
    fresh = spark.read.schema(fresh_schema).parquet(f"{home}/fresh")
    touched = _partitions(spark, f"{home}/fresh")
    if not touched:
        files.delete(spark, home)
        if full:
            raise ValueError("a full load without rows would erase the table")
        return None
    if seen is not None:        # only now: the plan of an empty batch may observe nothing
        fetched = seen.get
    counts = _row_counts(spark, f"{home}/fresh", fresh_schema)
    flows = sorted({p.split("/")[0] for p in touched}) if full else None
    attempt = 0
    while True:
        base, attempt = commits.settle(spark, path), attempt + 1
        staged = {p: ([f"fresh/{p}/{n}" for n in commits.data_files(spark, f"{home}/fresh/{p}")], counts[p]) for p in touched}
        both = [] if full else [p for p in touched if p in base["partitions"]]
        if both:
            merged = f"{home}/merged-{attempt}"
            try:
                staged |= _merge(spark, path, base, fresh, both, merged)
            except Exception:
                now = commits.last(spark, path)
                if now["version"] == base["version"]:
                    raise
                continue        # another run replaced files that were being read
        note = commits.commit(spark, path, base, run, staged, fresh_schema.json(), started, flows, {"fetched": {k: v for k, v in fetched.items() if v}})
        if note is not None:
            return note


def _merge(spark: SparkSession, path: str, base: dict, fresh: DataFrame, parts: list[str], out: str) -> dict:
    """Stored and fresh rows of ``parts`` written below ``out``: partition -> (files, rows)."""
    schema = T.StructType.fromJson(json.loads(base["schema"]))
    stored = _of_partitions(spark.read.schema(schema).parquet(path), parts)
    new = _of_partitions(fresh, parts)
    write_table(without_keys(stored, new).unionByName(new, allowMissingColumns=True), out)
    schema = T.StructType.fromJson(json.loads(commits.merged_schema(base["schema"], _ordered_schema(fresh.schema).json())))
    counts, name = _row_counts(spark, out, schema), out.rsplit("/", 1)[-1]
    return {p: ([f"{name}/{p}/{n}" for n in commits.data_files(spark, f"{out}/{p}")], counts[p]) for p in parts}


def _ordered_schema(schema: T.StructType) -> T.StructType:
    """Partition columns last, as a scan returns them."""
    return T.StructType([*(f for f in schema.fields if f.name not in PARTITION_COLUMNS), *(schema[c] for c in PARTITION_COLUMNS)])
