"""Landing of received files: tasks copy the bytes, and a manifest per landing switches the day.

``<root>/<dataset>/ingested_date=<day>/`` holds the files of every landing of a day, under names that no other attempt uses.
``<root>/<dataset>/manifests/ingested_date=<day>/<number>.json`` names the files of one landing that count, with length
and sha256, one JSON object a line after a first line with their number. The highest complete manifest of a day is
in force. So a landing that is lost between copy and switch, or a task that runs twice, leaves files that nobody reads, and
readers never see half a day. ``drop_replaced`` removes what no manifest in force names.

The copy is the one place outside ``llm`` where Python runs in tasks: Spark has no writer for bytes as they are. A task
streams its files piece by piece through Arrow's file systems (local, hdfs, s3, gs and abfs addresses); no byte of them passes the driver.
"""

import json
import uuid
from math import ceil

from pyspark.sql import functions as F

ENTRY = "file string, length long, sha256 string"
PIECE = 4 << 20
#: Files a task copies at least.
FILES_PER_TASK = 1


def path_on(spark, path):
    hadoop_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hadoop_path


def exists(spark, path):
    fs, hadoop_path = path_on(spark, path)
    return fs.exists(hadoop_path)


def names_in(spark, folder):
    """Names in a folder; empty if there is none."""
    fs, hadoop_path = path_on(spark, folder)
    if not fs.exists(hadoop_path):
        return []
    return [status.getPath().getName() for status in fs.listStatus(hadoop_path)]


def address(spark, path):
    """The path as tasks can open it: an encoded address with its file system, s3 under Arrow's name for it."""
    fs, hadoop_path = path_on(spark, path)
    scheme, _, rest = fs.makeQualified(hadoop_path).toUri().toString().partition(":")
    if scheme == "file":
        return "file://" + "/" + rest.lstrip("/")
    return f"{ {'s3a': 's3', 's3n': 's3'}.get(scheme, scheme) }:{rest}"


def copier(target):
    """Task code: copies files into ``target`` under fresh names, and tells what it wrote."""

    def copy(frames):
        import hashlib
        import uuid

        import pandas as pd
        from pyarrow import fs

        to, folder = fs.FileSystem.from_uri(target)
        for frame in frames:
            rows = []
            for source, name in zip(frame["source"], frame["name"]):
                system, path = fs.FileSystem.from_uri(source)
                file, length, digest = f"{uuid.uuid4().hex[:12]}-{name}", 0, hashlib.sha256()
                # compressed files too are copied as they are
                read = system.open_input_stream(path, compression=None)
                with read, to.open_output_stream(f"{folder}/{file}", compression=None) as write:
                    while piece := read.read(PIECE):
                        write.write(piece)
                        digest.update(piece)
                        length += len(piece)
                rows.append((file, length, digest.hexdigest()))
            yield pd.DataFrame(rows, columns=["file", "length", "sha256"])

    return copy


def copy_files(spark, paths, root, dataset, day):
    """Copy files beside those of the day; gives an entry (file, length, sha256) for each. They do not count yet."""
    folder = f"{root}/{dataset}/ingested_date={day}"
    fs, hadoop_path = path_on(spark, folder)
    fs.mkdirs(hadoop_path)
    if not paths:
        return []
    rows = [(address(spark, path), path.rstrip("/").rsplit("/", 1)[1]) for path in paths]
    tasks = ceil(len(rows) / FILES_PER_TASK)
    files = spark.createDataFrame(rows, "source string, name string").repartitionByRange(tasks, "source")
    copied = files.mapInPandas(copier(address(spark, folder)), ENTRY)
    # one small row per file; their names are the manifest
    return sorted((row.asDict() for row in copied.collect()), key=lambda e: e["file"].split("-", 1)[1])


def manifest_folder(root, dataset, day):
    return f"{root}/{dataset}/manifests/ingested_date={day}"


def switch_day(spark, root, dataset, day, entries):
    """Put a landing in force: its manifest is written aside and renamed to the next number."""
    folder = manifest_folder(root, dataset, day)
    numbers = [int(n.split(".")[0]) for n in names_in(spark, folder) if n.endswith(".json") and n[0] != "."]
    lines = [{"files": len(entries)}, *entries]
    fs, waiting = path_on(spark, f"{folder}/.{uuid.uuid4().hex}")
    stream = fs.create(waiting)
    try:
        stream.write(("\n".join(json.dumps(line) for line in lines) + "\n").encode())
    finally:
        stream.close()
    final = path_on(spark, f"{folder}/{max(numbers, default=0) + 1:08d}.json")[1]
    if fs.exists(final) or not fs.rename(waiting, final):
        raise RuntimeError(f"{dataset} of {day} is being landed by another run")


def landed_days(spark, root, dataset):
    """Days with a manifest; None for a dataset that never had one."""
    names = names_in(spark, f"{root}/{dataset}/manifests")
    return [n.split("=", 1)[1] for n in names if n.startswith("ingested_date=")] or None


def entries_of(spark, root, dataset, day):
    """Entries of the day's manifest in force; None if the day has none."""
    folder = manifest_folder(root, dataset, day)
    for name in sorted(names_in(spark, folder), reverse=True):
        if name.endswith(".json") and name[0] != ".":
            fs, hadoop_path = path_on(spark, f"{folder}/{name}")
            stream = fs.open(hadoop_path)
            try:
                text = spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
            finally:
                stream.close()
            head, *lines = text.splitlines() or [""]
            entries = [json.loads(line) for line in lines]
            if head and json.loads(head)["files"] == len(entries):
                return entries
    return None


def manifests(spark, root, dataset):
    """All manifest entries in force: ingested_date, file, length, sha256."""
    rows = [
        (day, e["file"], e["length"], e["sha256"])
        for day in landed_days(spark, root, dataset) or []
        for e in entries_of(spark, root, dataset, day) or []
    ]
    return spark.createDataFrame(rows, f"ingested_date string, {ENTRY}")


def verify(spark, root, dataset):
    """Every entry in force with the length and digest of the file as it is now; null where the file is gone."""
    entries = manifests(spark, root, dataset)
    days = landed_days(spark, root, dataset) or []
    folders = [f"{root}/{dataset}/ingested_date={day}" for day in days]
    found = (
        spark.read.format("binaryFile")
        .load(folders)
        .select(
            F.regexp_extract("path", r"ingested_date=([^/]+)/([^/]+)$", 1).alias("ingested_date"),
            F.element_at(F.split("path", "/"), -1).alias("file"),
            F.col("length").alias("length_now"),
            F.sha2("content", 256).alias("sha256_now"),
        )
    )
    return entries.join(found, ["ingested_date", "file"], "left")


def drop_replaced(spark, root, dataset, day):
    """Remove the day's files that the manifest in force does not name. Gives their number."""
    kept = {e["file"] for e in entries_of(spark, root, dataset, day) or []}
    folder = f"{root}/{dataset}/ingested_date={day}"
    gone = [name for name in names_in(spark, folder) if name not in kept]
    for name in gone:
        fs, hadoop_path = path_on(spark, f"{folder}/{name}")
        if not fs.delete(hadoop_path, False):
            raise RuntimeError(f"{folder}/{name} could not be removed")
    return len(gone)
