"""Vector code compression: product quantisation by active-entry Lloyd rounds in whole numbers.

Components become ``floor(SCALE * x)``; a vector is cut into ``parts`` equal parts, and each part position has a codebook of up
to ``entries`` entries, at first the parts of the smallest ids. A round assigns every part to the nearest entry of its
codebook (squared distance, ties to the lower index) and moves each used entry to the floor of its parts' mean.

Each row carries its parts' entries and exact distances from round to round. If a part's entry did not move in the last update,
every entry that stayed loses against it as before, so only the moved entries are compared with the stored distance; a
part whose entry moved is compared with all. Assignment and the sums for the next update are one pass over a table
in the shared folder, written anew each round; a lost executor repeats its tasks of one round. Only
the sums per entry and component reach the driver: ``entries`` x (dimension + parts) numbers, whatever the number of rows.

Vectors that are null or hold a null or non-finite component are left out. Components beyond +-2**24 after scaling count as
that bound, so that distances fit 64 bits. Shorter vectors are filled with zeros to the longest one's length, and all to a
multiple of ``parts``. Rows with equal ids are rows of their own (the first codebooks order them by vector); null ids
come last. With fewer rows than entries the codebook is as long as the table. Labels may be null; null labels
are one label. An empty table gives no rows; other columns are ignored.
"""

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm import common

SCALE, BOUND = 4096, 1 << 24
#: Rows taken together in a task, by components.
HELD = 1 << 20

STATE = "ints array<long>, codes array<long>, distances array<long>, sums array<long>"


def nearest(x, book, codes, distances, moved) -> tuple[np.ndarray, np.ndarray]:
    """Entry and distance of each row of ``x`` (n, width) in ``book`` (entries, width).

    ``codes`` and ``distances`` are those before ``moved`` entries (booleans) moved; None if there are none yet.
    """

    def best_of(rows, code, distance, tried):
        for entry in tried:
            d = ((rows - book[entry]) ** 2).sum(axis=1)
            better = (d < distance) | ((d == distance) & (entry < code))
            code, distance = np.where(better, entry, code), np.where(better, d, distance)
        return code, distance

    def rescan(rows):
        far = np.full(len(rows), np.iinfo(np.int64).max)
        return best_of(rows, np.full(len(rows), len(book)), far, range(len(book)))

    if codes is None:
        return rescan(x)
    lost = moved[codes]
    code, distance = codes.copy(), distances.copy()
    still = np.flatnonzero(~lost)
    code[still], distance[still] = best_of(x[still], codes[still], distances[still], np.flatnonzero(moved).tolist())
    again = np.flatnonzero(lost)
    code[again], distance[again] = rescan(x[again])
    return code, distance


def sums_by_entry(x: np.ndarray, codes: np.ndarray, entries: int) -> np.ndarray:
    """(entries, 1 + width): rows and component sums of each entry, exact."""
    order = np.argsort(codes, kind="stable")
    at = np.searchsorted(codes[order], np.arange(entries))
    running = np.vstack([np.zeros((1, x.shape[1] + 1), np.int64), np.cumsum(np.insert(x[order], 0, 1, axis=1), axis=0)])
    return running[np.append(at[1:], len(x))] - running[at]


def as_matrix(column) -> np.ndarray:
    """A list column whose lists have one length, as a matrix."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def assignment(books: np.ndarray, moved: np.ndarray | None):
    """The pass of one round: rows with their new entries and distances, and one row of sums per task."""
    parts, entries, width = books.shape

    def gathered(batches) -> Iterator[pa.Table]:
        held, rows = [], 0
        for batch in batches:
            held.append(batch)
            rows += batch.num_rows
            if rows * parts * width >= HELD:
                yield pa.Table.from_batches(held)
                held, rows = [], 0
        if rows:
            yield pa.Table.from_batches(held)

    def run(batches):
        total = np.zeros((parts, entries, 1 + width), dtype=np.int64)
        schema = None
        for table in gathered(batches):
            table = table.filter(pc.is_valid(table["ints"]))
            if not table.num_rows:
                continue
            x = as_matrix(table["ints"]).reshape(-1, parts, width)
            codes, distances = np.empty((2, len(x), parts), dtype=np.int64)
            before = None if moved is None else (as_matrix(table["codes"]), as_matrix(table["distances"]))
            for p in range(parts):
                old = (None, None) if before is None else (before[0][:, p], before[1][:, p])
                changed = None if moved is None else moved[p]
                codes[:, p], distances[:, p] = nearest(x[:, p], books[p], *old, changed)
                total[p] += sums_by_entry(x[:, p], codes[:, p], entries)
            ends = pa.array(np.arange(0, (len(x) + 1) * parts, parts, dtype=np.int32))
            kind = table.schema.field("codes").type
            for name, matrix in (("codes", codes), ("distances", distances)):
                lists = pa.ListArray.from_arrays(ends, pa.array(matrix.reshape(-1))).cast(kind)
                table = table.set_column(table.schema.get_field_index(name), name, lists)
            schema = table.schema
            yield from table.to_batches(max_chunksize=10_000)
        if schema is not None:
            row = {name: [None] for name in schema.names} | {"sums": [total.reshape(-1).tolist()]}
            yield pa.RecordBatch.from_pydict(row, schema=schema)

    return run


def moved_books(state: DataFrame, books: np.ndarray) -> np.ndarray:
    """The codebooks after an update; entries without parts stay."""
    parts, entries, width = books.shape
    cells = state.where("sums is not null").select(F.posexplode("sums").alias("at", "n")).groupBy("at")
    total = np.zeros(parts * entries * (1 + width), dtype=np.int64)
    for row in cells.agg(F.sum("n").alias("n")).collect():
        total[row["at"]] = row["n"]
    total = total.reshape(parts, entries, 1 + width)
    count = total[:, :, :1]
    return np.where(count > 0, total[:, :, 1:] // np.maximum(count, 1), books)


def whole_numbers(df: DataFrame, vector) -> tuple[DataFrame, int]:
    """Rows with a usable vector plus ``ints``, and the longest vector's length."""
    usable = F.col(vector).isNotNull() & F.forall(
        vector, lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < float("inf"))
    )
    scaled = F.transform(
        vector,
        lambda x: F.floor(
            F.greatest(F.lit(-float(BOUND)), F.least(F.lit(float(BOUND)), x.cast("double") * F.lit(float(SCALE))))
        ).cast("long"),
    )
    rows = df.where(F.coalesce(usable, F.lit(False))).withColumn("ints", scaled)
    return rows, rows.agg(F.max(F.size("ints"))).first()[0]


def compress(
    df: DataFrame, vec_id="vec_id", vector="embedding", label="label", parts=8, entries=16, rounds=6
) -> tuple[DataFrame, np.ndarray]:
    """vec_id, label, codes (an entry per part), error (squared distance over all parts); and the codebooks."""
    spark = df.sparkSession
    rows = df.select(F.col(vec_id).alias("vec_id"), F.col(label).alias("label"), F.col(vector).alias("vector"))
    rows, longest = whole_numbers(rows, "vector")
    width = -(-(longest or 0) // parts)
    size = F.lit(width * parts)
    padded = F.when(F.size("ints") == size, F.col("ints")).otherwise(
        F.concat("ints", F.array_repeat(F.lit(0).cast("long"), size - F.size("ints")))
    )
    nothing = F.lit(None).cast("array<long>")
    rows = rows.select("vec_id", "label", padded.alias("ints"), *[nothing.alias(c) for c in ("codes", "distances", "sums")])
    first = rows.orderBy(F.asc_nulls_last("vec_id"), "ints").select("ints").limit(entries).collect()
    books = np.array([r["ints"] for r in first], dtype=np.int64).reshape(len(first), parts, width).transpose(1, 0, 2)
    if not len(first) or not width:
        zero = F.lit(0).cast("long")
        codes = F.array_repeat(zero, parts)
        return rows.select("vec_id", "label", codes.alias("codes"), zero.alias("error")), books
    state, moved = rows, None
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema)
    for i in range(rounds + 1):
        after = common.stored(state.mapInArrow(assignment(books, moved), schema), f"vector-codes-{i}")
        if i:
            common.discard(state)
        state = after
        if i < rounds:
            new = moved_books(state, books)
            moved = (new != books).any(axis=2)
            books = new
    error = F.aggregate("distances", F.lit(0).cast("long"), lambda a, b: a + b)
    return state.where("sums is null").select("vec_id", "label", "codes", error.alias("error")), books


def decoded(codes: np.ndarray, books: np.ndarray) -> np.ndarray:
    """The vectors that codes (n, parts) stand for, in scaled whole numbers."""
    return books[np.arange(books.shape[0]), codes].reshape(len(codes), -1)


def digest(books: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, books.reshape(-1).tolist())).encode()).hexdigest()


def coded(df: DataFrame, **options) -> DataFrame:
    """vec_id, code (two hex digits per part), error, label_error (error of all rows of a label), codebooks_sha256."""
    rows, books = compress(df, **options)
    two = F.transform("codes", lambda c: F.lpad(F.lower(F.hex(c)), 2, "0"))
    rows = rows.select("vec_id", "label", F.array_join(two, "").alias("code"), "error")
    by_label = rows.groupBy(F.col("label").alias("of")).agg(F.sum("error").alias("label_error"))
    joined = rows.join(by_label, F.col("label").eqNullSafe(F.col("of")))
    return joined.select("vec_id", "code", "error", "label_error", F.lit(digest(books)).alias("codebooks_sha256"))
