"""Token-ID files: whole texts as ids, written in ascending document order in a compact binary format.

``write`` deals the documents to ranges of the id, one task and file each. A task encodes its texts, puts an end id
after each document, cuts the stream of ids every ``BLOCK_IDS`` ids and codes each block with the adaptive
range coder. A block stands alone: a header, the documents' parts in it, the coded ids and a checksum:

    4 bytes   format name and version
    uint32    ids in the block
    uint32    largest id
    uint32    parts of documents
    uint64    place of its first id in the file
    parts     number of the document in the file (uint64), doc_id (int64), flags (uint8: 1 null id, 2 first part,
              4 last part), ids of the part (uint32)
    words     uint16 words of the range coder
    uint32    crc32 of all bytes before

Blocks are rows (file_no, block_no, n_ids, payload) of a Parquet table, which gives them Spark's commit protocol and any
file system Spark can write to. ``read_parts`` decodes blocks independently of one another, so any task may read any
block; ``documents`` puts the parts together again.

Null texts count as empty (the end id alone). Rows with a null id come first, as rows of a null id; rows that share an id are
ordered by the hash of their text and keep a row each. An empty table gives an empty table of files. Other columns
are ignored. A block whose checksum or format is wrong raises ``ValueError``. Ids may use 32 bits.
"""

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerline.llm import common, range_coder
from ledgerline.llm.token_ids import Encoder
from ledgerline.session import shared_dir

NAME = b"LTB1"
HEADER = "<4sIIIQ"
HEADER_BYTES = struct.calcsize(HEADER)
PART = np.dtype([("document", "<u8"), ("doc_id", "<i8"), ("flags", "u1"), ("n_ids", "<u4")])
NULL_ID, FIRST, LAST = 1, 2, 4
#: Blocks that are coded in step.
LANES = 2048

FILES = "file_no int, block_no long, n_ids long, payload binary"
PARTS = "file_no int, document long, doc_id long, start long, first boolean, last boolean, n_ids long, ids array<long>"
DIGESTS = "file_no int, document long, doc_id long, start long, n_ids long, crc32 long"


def pack_block(ids: np.ndarray, stream: bytes, parts: np.ndarray, start: int) -> bytes:
    head = struct.pack(HEADER, NAME, len(ids), int(ids.max(initial=0)), len(parts), start)
    body = head + parts.tobytes() + stream
    return body + struct.pack("<I", zlib.crc32(body))


def unpack_block(payload: bytes) -> tuple[int, int, int, np.ndarray, bytes]:
    """ids, largest id, place of the first id, parts, words."""
    body, check = payload[:-4], payload[-4:]
    if len(payload) < HEADER_BYTES + 4 or struct.unpack("<I", check)[0] != zlib.crc32(body):
        raise ValueError("token block with a wrong checksum")
    name, n_ids, largest, n_parts, start = struct.unpack_from(HEADER, body)
    if name != NAME:
        raise ValueError(f"token block of an unknown format {name!r}")
    after = HEADER_BYTES + n_parts * PART.itemsize
    return n_ids, largest, start, np.frombuffer(body[HEADER_BYTES : after], dtype=PART), body[after:]


class _BlockWriter:
    """Collects a file's ids and documents; gives out coded blocks, LANES at a time."""

    def __init__(self, file_no: int, block_ids: int):
        self.file_no, self.block_ids = file_no, block_ids
        self.ids: list[np.ndarray] = []
        self.parts: list[tuple] = []
        self.held = self.written = self.blocks = self.documents = 0

    def add(self, doc_ids: list, ids: np.ndarray, counts: np.ndarray) -> None:
        self.ids.append(ids)
        self.held += len(ids)
        for doc_id, count in zip(doc_ids, counts.tolist()):
            self.parts.append((self.documents, doc_id, count, True))
            self.documents += 1

    def blocks_out(self, final: bool) -> Iterator[pa.RecordBatch]:
        """Whole blocks; with ``final`` also the rest."""
        size = self.block_ids
        while self.held >= size * LANES or (final and self.held):
            ids = np.concatenate(self.ids)
            take = min(len(ids) if final else len(ids) // size * size, size * LANES)
            ids, rest = ids[:take], ids[take:]
            self.ids, self.held = [rest], len(rest)
            blocks = [ids[i : i + size] for i in range(0, take, size)]
            streams = range_coder.encode(blocks)
            parts = self._parts([len(b) for b in blocks])
            payloads = []
            for block, stream, own in zip(blocks, streams, parts):
                payloads.append(pack_block(block, stream, own, self.written))
                self.written += len(block)
            numbers = list(range(self.blocks, self.blocks + len(blocks)))
            self.blocks += len(blocks)
            for i in range(0, len(blocks), 256):
                part = payloads[i : i + 256]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([self.file_no] * len(part), pa.int32()),
                        pa.array(numbers[i : i + 256], pa.int64()),
                        pa.array([len(b) for b in blocks[i : i + 256]], pa.int64()),
                        pa.array(part, pa.binary()),
                    ],
                    names=["file_no", "block_no", "n_ids", "payload"],
                )

    def _parts(self, sizes: list[int]) -> list[np.ndarray]:
        """The documents' parts of each block, in order; what reaches past the last block stays."""
        out, waiting, at = [], self.parts, 0
        for size in sizes:
            own = []
            while size:
                number, doc_id, count, first = waiting[at]
                taken = min(size, count)
                flags = (NULL_ID if doc_id is None else 0) | FIRST * first | LAST * (taken == count)
                own.append((number, doc_id or 0, flags, taken))
                size -= taken
                if taken == count:
                    at += 1
                else:
                    waiting[at] = (number, doc_id, count - taken, False)
            out.append(np.array(own, dtype=PART))
        self.parts = waiting[at:]
        return out


def write(
    df: DataFrame, path: str, tokenizer_file: str, end_id: int, doc_id="doc_id", text="text", block_ids=None
) -> None:
    """Write the token files of ``df`` to ``path``; see the module's docstring."""
    block_ids = block_ids or range_coder.BLOCK_IDS
    if not 0 < block_ids <= range_coder.BLOCK_IDS:
        raise ValueError(f"a block has 1 to {range_coder.BLOCK_IDS} ids")

    def files(batches):
        encode = Encoder(tokenizer_file)
        out = _BlockWriter(TaskContext.get().partitionId(), block_ids)
        for batch in batches:
            ids, counts = encode(batch.column(1).to_pylist())
            ids = np.insert(ids, np.cumsum(counts), end_id)
            out.add(batch.column(0).to_pylist(), ids, counts + 1)
            yield from out.blocks_out(final=False)
        yield from out.blocks_out(final=True)

    common.bound_batches(df.sparkSession)
    rows = df.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    order = F.xxhash64("text")
    ordered = rows.repartitionByRange(F.asc_nulls_first("doc_id"), order)
    ordered = ordered.sortWithinPartitions(F.asc_nulls_first("doc_id"), order, "text")
    ordered.mapInArrow(files, FILES).write.option("compression", "none").parquet(path)


def files(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(FILES).parquet(path)


def _blocks_of(batches) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """file_no, place of the first id, parts and ids of every block of the batches, LANES decoded together."""
    waiting: list[tuple] = []

    def decoded():
        ids = range_coder.decode([w[4] for w in waiting], [w[1] for w in waiting], [w[2] for w in waiting])
        for (file_no, _, _, (start, parts), _), own in zip(waiting, ids):
            yield file_no, start, parts, own

    for batch in batches:
        for file_no, payload in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            n_ids, largest, start, parts, words = unpack_block(payload)
            waiting.append((file_no, n_ids, largest, (start, parts), words))
            if len(waiting) >= LANES:
                yield from decoded()
                waiting.clear()
    if waiting:
        yield from decoded()


def read_parts(spark: SparkSession, path: str) -> DataFrame:
    """One row per document and block: which document, where its part starts in the file, and the ids."""

    def parts_of(batches):
        rows, held = [], 0
        for file_no, start, parts, ids in _blocks_of(batches):
            for number, doc_id, flags, n in parts.tolist():
                own = None if flags & NULL_ID else doc_id
                taken, ids = ids[:n], ids[n:]
                rows.append((file_no, number, own, start, bool(flags & FIRST), bool(flags & LAST), n, taken))
                start += n
                held += n
            if held > 1 << 20:
                yield pd.DataFrame(rows, columns=[c.split()[0] for c in PARTS.split(", ")])
                rows, held = [], 0
        if rows:
            yield pd.DataFrame(rows, columns=[c.split()[0] for c in PARTS.split(", ")])

    def as_pandas(frames):
        return parts_of(pa.RecordBatch.from_pandas(f, preserve_index=False) for f in frames)

    common.bound_batches(spark)
    return files(spark, path).select("file_no", "payload").mapInPandas(as_pandas, PARTS)


def documents(spark: SparkSession, path: str) -> DataFrame:
    """file_no, document, doc_id, start (in the file) and all ids of every document."""
    parts = read_parts(spark, path).groupBy("file_no", "document", "doc_id")
    whole = parts.agg(F.sort_array(F.collect_list(F.struct("start", "ids"))).alias("parts"))
    return whole.select(
        "file_no", "document", "doc_id", F.col("parts")[0]["start"].alias("start"), F.flatten("parts.ids").alias("ids")
    )


# ---- digests without shipping the ids ----


def _times(matrix: list[int], vector: int) -> int:
    total, i = 0, 0
    while vector:
        if vector & 1:
            total ^= matrix[i]
        vector >>= 1
        i += 1
    return total


def zero_bytes() -> list[list[int]]:
    """The effect of 2 ** i zero bytes on a crc32, as 32 columns over the field of two elements, for i below 63."""
    one = [0xEDB88320] + [1 << n for n in range(31)]  # one zero bit
    for _ in range(3):
        one = [_times(one, column) for column in one]
    out = [one]
    while len(out) < 63:
        out.append([_times(out[-1], column) for column in out[-1]])
    return out


ZERO_BYTES = zero_bytes()


def joined_crc(first: int, second: int, n_bytes: int) -> int:
    """crc32 of two strings one after the other, from theirs and the length of the second."""
    power = 0
    while n_bytes:
        if n_bytes & 1:
            first = _times(ZERO_BYTES[power], first)
        n_bytes >>= 1
        power += 1
    return first ^ second


def digests(spark: SparkSession, path: str) -> DataFrame:
    """file_no, document, doc_id, start (in the file), n_ids and the crc32 of the ids as 32-bit little-endian numbers.

    Decodes every block; a document in one block is finished there, the parts of others meet as digests.
    """

    def parts_of(batches):
        columns: list[list] = [[] for _ in range(7)]
        for file_no, start, parts, ids in _blocks_of(batches):
            raw = ids.astype("<u4").tobytes()
            ends = np.cumsum(parts["n_ids"].astype(np.int64))
            starts = ends - parts["n_ids"]
            for at, end, (number, doc_id, flags, n) in zip(starts.tolist(), ends.tolist(), parts.tolist()):
                whole = flags & (FIRST | LAST) == FIRST | LAST
                row = (file_no, number, None if flags & NULL_ID else doc_id, start + at, n)
                for column, value in zip(columns, (*row, zlib.crc32(raw[4 * at : 4 * end]), whole)):
                    column.append(value)
        kinds = (pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.bool_())
        names = [c.split()[0] for c in DIGESTS.split(", ")] + ["whole"]
        arrays = [pa.array(c, k) for c, k in zip(columns, kinds)]
        yield from pa.Table.from_arrays(arrays, names=names).to_batches(max_chunksize=10_000)

    @F.pandas_udf("long")
    def crc_of_parts(parts: pd.Series) -> pd.Series:
        out = []
        for own in parts:
            total = 0
            for part in own:
                total = joined_crc(total, part["crc32"], 4 * part["n_ids"])
            out.append(total)
        return pd.Series(out, dtype="int64")

    common.bound_batches(spark)
    found = files(spark, path).select("file_no", "payload").mapInArrow(parts_of, DIGESTS + ", whole boolean")
    found = common.stored(found, "token-digests")
    whole = found.where("whole").drop("whole")
    cut = found.where("not whole").groupBy("file_no", "document", "doc_id")
    cut = cut.agg(
        F.min("start").alias("start"),
        F.sum("n_ids").alias("n_ids"),
        F.sort_array(F.collect_list(F.struct("start", "n_ids", "crc32"))).alias("parts"),
    )
    return whole.unionByName(cut.withColumn("crc32", crc_of_parts("parts")).drop("parts"))


def file_starts(spark: SparkSession, path: str) -> DataFrame:
    """file_no and the number of ids in all files before it; one small row per file."""
    sizes = files(spark, path).groupBy("file_no").agg(F.sum("n_ids").alias("n_ids"))
    before = Window.orderBy("file_no").rowsBetween(Window.unboundedPreceding, -1)
    return sizes.select("file_no", F.coalesce(F.sum("n_ids").over(before), F.lit(0)).alias("file_start"))


def written(df: DataFrame, tokenizer_file: str, end_id: int, **options) -> str:
    """Write ``df``'s token files to a fresh folder in the shared place; its path."""
    path = shared_dir(df.sparkSession, "token-files")
    write(df, path, tokenizer_file, end_id, **options)
    return path
