"""Bronze zone: files exactly as received, one ``ingested_date`` folder per landing day, with a manifest per landing.

A day consists of the files that its last manifest names; ``landing.py`` writes them. A dataset that was delivered
without manifests is read by its folders.
"""

import csv
import logging
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.schemas import BRONZE_COLUMNS
from ledgerline.sources.landing import copy_files, entries_of, exists, landed_days, names_in, path_on, switch_day

log = logging.getLogger(__name__)

# The same options on both sides, so that quotes, blanks and empty texts survive a round trip.
CSV_READ = {"header": "true", "quote": '"', "escape": '"', "emptyValue": ""}
CSV_WRITE = {
    **CSV_READ,
    "emptyValue": '""',
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
}
#: How large tables are delivered: compressed, in files that one task each reads in moderate time.
DELIVERY = {"compression": "gzip", "maxRecordsPerFile": 1_000_000}
#: Holds the text of a record that does not fit its header; null elsewhere.
CORRUPT = "_corrupt_record"
#: Files opened at a time.
PARALLEL = 16


def data_files(spark, path):
    """The file, or the files of a folder, without markers such as ``_SUCCESS``."""
    fs, hadoop_path = path_on(spark, path)
    if not fs.getFileStatus(hadoop_path).isDirectory():
        return [path]
    names = [s.getPath().getName() for s in fs.listStatus(hadoop_path) if not s.isDirectory()]
    return [f"{path.rstrip('/')}/{n}" for n in sorted(names) if n[0] not in "_."]


def day_files(spark, root, dataset, day):
    """The files of a landing day: those its manifest names."""
    folder = f"{root}/{dataset}/ingested_date={day}"
    entries = entries_of(spark, root, dataset, day)
    return data_files(spark, folder) if entries is None else [f"{folder}/{e['file']}" for e in entries]


def ingested_dates(spark, root, dataset):
    """Landing days of a dataset, from a listing of manifests or day folders; no data is read."""
    days = landed_days(spark, root, dataset)
    if days is None:
        days = [n.split("=", 1)[1] for n in names_in(spark, f"{root}/{dataset}") if n.startswith("ingested_date=")]
    return sorted(days)


def read_csv(spark, path):
    """Every column as text, by the header."""
    return spark.read.options(**CSV_READ).csv(path)


def write_csv(df, path, mode="overwrite", **options):
    df.write.mode(mode).options(**CSV_WRITE, **options).csv(path)


def land_bronze(spark, source, root, dataset, run_date):
    """Land a received file, or a folder of files, as it is: the tasks copy, then the day's manifest switches.

    A second landing of a day replaces it, other days stay. Gives the manifest entries.
    """
    entries = copy_files(spark, data_files(spark, source), root, dataset, run_date)
    switch_day(spark, root, dataset, run_date, entries)
    return entries


def land_all(spark, files, root, run_date):
    """Land (path, dataset) pairs; a missing file is skipped with a warning. Gives the outcomes."""
    outcomes = []
    for path, dataset in files:
        if exists(spark, path):
            land_bronze(spark, path, root, dataset, run_date)
            outcomes.append((dataset, "landed"))
        else:
            log.warning("file not found, skipping: %s", path)
            outcomes.append((dataset, "skipped"))
    return outcomes


def header_of(spark, path):
    """Column names of a file, which may be compressed; a repeated name gets a number. Empty for an empty file.

    A quoted name may hold line breaks: lines are read until the quotes are closed.
    """
    fs, hadoop_path = path_on(spark, path)
    io, compress = spark.sparkContext._jvm.java.io, spark.sparkContext._jvm.org.apache.hadoop.io.compress
    codec = compress.CompressionCodecFactory(fs.getConf()).getCodec(hadoop_path)
    stream = fs.open(hadoop_path)
    reader = io.BufferedReader(io.InputStreamReader(codec.createInputStream(stream) if codec else stream, "UTF-8"))
    try:
        text = reader.readLine() or ""
        while text.count('"') % 2:
            line = reader.readLine()
            if line is None:
                break
            text += "\n" + line
    finally:
        reader.close()
    lines = text.removeprefix("\ufeff").splitlines(keepends=True)
    names = next(csv.reader(lines), [])
    out = []
    for i, name in enumerate(names):
        again = f"{name}_{i}"
        while again in names or again in out:
            again += "_"
        out.append(again if name in names[:i] else name)
    return tuple(out)


def landed(spark, root, dataset, days=None, multi_line=False, **options):
    """Landings as text with all their columns, found by name in each file's own header.

    Gives one DataFrame per distinct header: its columns, ``_corrupt_record`` and ``ingested_date``. The header of
    each file is one small read. ``multi_line`` is for sources whose records may hold line breaks; a file is then
    read by one task.
    """
    if days is None:
        days = ingested_dates(spark, root, dataset)
    with ThreadPoolExecutor(PARALLEL) as pool:
        paths = [f for found in pool.map(lambda day: day_files(spark, root, dataset, day), days) for f in found]
        headers = list(pool.map(lambda path: header_of(spark, path), paths))
    groups = {}
    for header, path in zip(headers, paths):
        if header:
            groups.setdefault(header, []).append(path)
    reader = spark.read.options(**CSV_READ).option("basePath", f"{root}/{dataset}")
    reader = reader.option("columnNameOfCorruptRecord", CORRUPT).option("multiLine", multi_line).options(**options)
    return [
        reader.schema(
            T.StructType([T.StructField(c, T.StringType()) for c in [*header, CORRUPT, "ingested_date"]])
        ).csv(group)
        for header, group in groups.items()
    ]


def read_bronze(spark, root, dataset, days=None, multi_line=False):
    """Landings of a dataset as text, with ``ingested_date``.

    A known dataset has its columns, by name: missing ones are null, others stay in the files. An unmodelled one
    has the columns of all its files.
    """
    parts = landed(spark, root, dataset, days, multi_line)
    columns = BRONZE_COLUMNS.get(dataset)
    if columns is None:
        columns = list(dict.fromkeys(c for df in parts for c in df.columns if c not in (CORRUPT, "ingested_date")))
    if not parts:
        return spark.createDataFrame([], ", ".join(f"`{c}` string" for c in [*columns, "ingested_date"]))
    picked = [
        df.select(
            *[F.col(f"`{c}`") if c in df.columns else F.lit(None).cast("string").alias(c) for c in columns],
            "ingested_date",
        )
        for df in parts
    ]
    out = picked[0]
    for df in picked[1:]:
        out = out.unionByName(df)
    return out


def corrupt_records(spark, root, dataset, days=None, multi_line=False):
    """Records per landing day, how many have no first field, and how many do not fit the header of their file.

    Every field is parsed, because a misfit shows only in the columns that are read.
    """
    parts = [
        df.select("ingested_date", F.col(CORRUPT).isNotNull().alias("bad"), F.col(f"`{df.columns[0]}`").alias("first"))
        for df in landed(spark, root, dataset, days, multi_line, columnPruning="false")
    ]
    if not parts:
        return spark.createDataFrame([], "ingested_date string, records long, blank long, corrupt long")
    out = parts[0]
    for df in parts[1:]:
        out = out.unionByName(df)
    return out.groupBy("ingested_date").agg(
        F.count("*").alias("records"),
        F.count_if(F.col("first").isNull()).alias("blank"),
        F.count_if("bad").alias("corrupt"),
    )


def bronze_snapshot(spark, root, dataset, as_of=None, multi_line=False):
    """The latest landing (on or before ``as_of``): one day folder, the others are not opened."""
    days = [d for d in ingested_dates(spark, root, dataset) if as_of is None or d <= as_of]
    if not days:
        raise ValueError(f"nothing landed for {dataset} under {root}")
    return read_bronze(spark, root, dataset, days[-1:], multi_line)


def register_sources(spark, root):
    """Name the raw tables for SQL users: one view per known dataset, on its latest landing."""
    for dataset in BRONZE_COLUMNS:
        bronze_snapshot(spark, root, dataset).createOrReplaceTempView(dataset)
