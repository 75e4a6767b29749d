"""Ingest: headed CSV exports -> raw tables (all columns as strings).

The reference downloads each export, reads it with pandas on one machine,
cleans the header names and replaces a warehouse table.  Here every file is a
distributed `spark.read.csv` (no schema inference: staging types the columns),
headers are normalised on the driver (names only, never data), and the sink
replaces a Parquet folder or catalog table all at once (store.py).

An empty CSV field and the usual missing markers (`NA`, `null`, ...) read as
NULL, as with the reference's loader; a record with too few fields is filled
with NULL.  A record with too many fields, which the reference's loader refuses
together with its file, is malformed: it never reaches the raw table with its
surplus cut off.  The batch load puts such records into a quarantine table and
names them in the log, or fails the file, as asked.
"""

from __future__ import annotations

import re
import uuid
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from vitrine.fixed_values import HEADER_ACCENTS, HEADER_PUNCTUATION, MISSING_MARKERS
from vitrine.session import ensure_checkpoint_dir
from vitrine.sources import store

# Standard quoting: a quote inside a quoted field is doubled, and a field may span lines.
# A file with quoted line breaks cannot be split, so one file is one task: large exports
# are delivered as several files of a folder, or read with multi_line=False where no
# field holds a line break.
CSV_READ_OPTIONS = {"header": "true", "inferSchema": "false", "mode": "PERMISSIVE", "quote": '"', "escape": '"'}
#: the raw text of a malformed record, NULL for the others
MALFORMED = "_malformed_record"
CSV_WRITE_OPTIONS = {"header": "true", "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false",
                     "quote": '"', "escape": '"'}


def normalize_header(name: str) -> str:
    """Punctuation -> '_', é/è/ê -> e, â -> a, ô -> o, strip, lower (lower-casing last:
    a capital É is not in the accent list and survives as é)."""
    out = re.sub("[" + re.escape(HEADER_PUNCTUATION) + "]", "_", name)
    for src, dst in HEADER_ACCENTS:
        out = out.replace(src, dst)
    return out.strip().lower()


def ingest_normalize_headers(df: DataFrame) -> DataFrame:
    return df.toDF(*[normalize_header(c) for c in df.columns])


def _too_many_fields(record: Column, expected: int) -> Column:
    """Whether a record of another length than the header has more fields, or a quote that isn't closed.

    Between quotes lies every second piece of the record; delimiters in the other pieces part fields.
    """
    pieces = F.split(record, '"')
    outside = F.concat_ws("", F.filter(pieces, lambda _, i: i % 2 == 0))
    fields = F.length(outside) - F.length(F.replace(outside, F.lit(","), F.lit(""))) + 1
    return (fields > expected) | (F.size(pieces) % 2 == 0)


def read_records(spark: SparkSession, path: str, normalize: bool = True, missing: tuple[str, ...] = MISSING_MARKERS, multi_line: bool = True) -> DataFrame:
    """Every record of a headed CSV file or folder: the header's columns as strings, and MALFORMED.

    multi_line=False reads large files in splits; their fields must not hold line breaks.
    """
    # a parser that skips columns would not see that a record is too long
    options = CSV_READ_OPTIONS | {"multiLine": str(multi_line).lower(), "columnNameOfCorruptRecord": MALFORMED, "columnPruning": "false"}
    names = spark.read.options(**options).csv(path).columns
    schema = StructType([StructField(c, StringType()) for c in (*names, MALFORMED)])
    df = spark.read.options(**options).schema(schema).csv(path)
    columns = [F.col(f"`{c}`") for c in names]
    if missing:
        columns = [F.when(~c.isin(*missing), c).alias(n) for c, n in zip(columns, names)]
    record = F.col(MALFORMED)
    # Spark refuses a plan that reads nothing but the record's text, so its test names a data column too.
    read = F.length(F.concat_ws("", record, F.col(f"`{names[0]}`"))) >= 0
    df = df.select(*columns, F.when(read & record.isNotNull() & _too_many_fields(record, len(names)), record).alias(MALFORMED))
    return df.toDF(*[normalize_header(c) for c in names], MALFORMED) if normalize else df


def ingest_csv(spark: SparkSession, path: str, normalize: bool = True, missing: tuple[str, ...] = MISSING_MARKERS, multi_line: bool = True) -> DataFrame:
    """The well-formed records of one headed CSV file or folder; every column is a string, fields that are a missing marker are NULL."""
    return read_records(spark, path, normalize, missing, multi_line).where(F.col(MALFORMED).isNull()).drop(MALFORMED)


def quarantined(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """The malformed records of a CSV file or folder, as text: record."""
    return read_records(spark, path, multi_line=multi_line).where(F.col(MALFORMED).isNotNull()).select(F.col(MALFORMED).alias("record"))


def write_csv(df: DataFrame, path: str, **options: str) -> None:
    df.write.mode("overwrite").options(**(CSV_WRITE_OPTIONS | options)).csv(path)


def ingest_overwrite_sink(df: DataFrame, target: str, as_table: bool = False) -> None:
    """Replace the target (Parquet folder read by `store.read_table`, or catalog table when `as_table`) all at once."""
    if as_table:
        store.replace_catalog_table(df, target)
    else:
        store.replace_table(df, target)


stg_table_sink = ingest_overwrite_sink  # staging results are stored by the same operator


@dataclass
class LoadResult:
    table: str
    status: str
    rows: int
    error: str
    quarantined: int = 0


LOG_SCHEMA = StructType([StructField("table_name", StringType()), StructField("status", StringType()),
                         StructField("rows", LongType()), StructField("error", StringType()), StructField("quarantined", LongType())])


class MalformedRecords(Exception):
    """A file holds records with too many fields."""


def _load(spark: SparkSession, name: str, path: str, target_dir: str, on_malformed: str, multi_line: bool) -> LoadResult:
    """One pass over the file writes its rows and counts both kinds; only a file with malformed records is read again, for them."""
    table = name.lower()
    target, aside = f"{target_dir.rstrip('/')}/{table}", f"{target_dir.rstrip('/')}_quarantine/{table}"
    seen = Observation()
    records = read_records(spark, path, multi_line=multi_line).observe(seen, F.count(F.lit(1)).alias("records"), F.count(MALFORMED).alias("malformed"))
    run = store.write_run(records.where(F.col(MALFORMED).isNull()).drop(MALFORMED), target)
    bad, rows = seen.get["malformed"], seen.get["records"] - seen.get["malformed"]
    if bad or store.has_table(spark, aside):  # an earlier load's records must not stay
        store.replace_table(quarantined(spark, path, multi_line), aside)
    if bad and on_malformed == "fail":
        raise MalformedRecords(f"[MALFORMED_RECORDS] {bad} records of {path} have too many fields; they are in {aside}")
    store.switch(spark, target, run)
    return LoadResult(table, "success", rows, f"[MALFORMED_RECORDS] {bad} records are in {aside}" if bad else "", bad)


def ingest_batch_log(spark: SparkSession, files: dict[str, str], target_dir: str, on_malformed: str = "quarantine", multi_line: bool = True,
                     at_once: int = 4) -> DataFrame:
    """Load each (name -> CSV path) into `target_dir/<lower(name)>`, `at_once` files at a time; a failing file is logged,
    keeps its previous table and does not stop the others.  Returns one log row per file.

    Malformed records go to `target_dir`_quarantine/<lower(name)>; on_malformed="fail" also fails their file.
    """
    if on_malformed not in ("quarantine", "fail"):
        raise ValueError(f"on_malformed must be 'quarantine' or 'fail', not {on_malformed!r}")

    def one(item: tuple[str, str]) -> LoadResult:
        try:
            return _load(spark, *item, target_dir, on_malformed, multi_line)
        except Exception as exc:  # noqa: BLE001 - the reference logs any failure and goes on
            return LoadResult(item[0].lower(), "failed", 0, str(exc))

    with ThreadPoolExecutor(at_once) as pool:
        log = list(pool.map(inheritable_thread_target(spark)(one), files.items()))
    return spark.createDataFrame([(r.table, r.status, r.rows, r.error, r.quarantined) for r in log], LOG_SCHEMA)


def scratch_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh folder under the session's shared checkpoint directory."""
    base = ensure_checkpoint_dir(spark)
    return f"{base.rstrip('/')}/vitrine-{purpose}/{uuid.uuid4().hex}"
