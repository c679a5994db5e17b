"""An exchange in which every task first reduces what it sends.

Operators that look for content shared between documents work in chunks of documents. A chunk
numbers its distinct keys, sends each key once to the block that the key belongs to, and keeps
a row per document that says which numbers the document holds where. A block compares the keys
of all chunks and replies to a chunk with numbers. Rows and replies of a chunk meet again, and
the documents are resolved. However many documents share a key, a block gets it once a chunk.

All rows pass through one schema: KEYS rows go to their block, DOC and REPLY rows to the chunk.
Chunk numbers come from the partition and are only used within one evaluation of the plan.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

DOC, REPLY, KEYS = 0, 1, 2
SCHEMA = "kind int, token long, dest long, id long, th int, a binary, b binary, c binary"
ARROW = pa.schema(
    [
        ("kind", pa.int32()), ("token", pa.int64()), ("dest", pa.int64()), ("id", pa.int64()),
        ("th", pa.int32()), ("a", pa.binary()), ("b", pa.binary()), ("c", pa.binary()),
    ]
)
CHUNK_KEYS = 1 << 20  # distinct and repeated keys a chunk may hold before it is sent
CHUNK_BYTES = 48 << 20  # texts a chunk may hold
ROWS_AT_ONCE = 2000


class Rows:
    """Rows of SCHEMA, handed over in batches."""

    def __init__(self):
        self.rows: list[tuple] = []

    def add(self, kind, token, dest, id_=None, th=None, a=None, b=None, c=None) -> None:
        as_bytes = [x if x is None or isinstance(x, bytes) else x.tobytes() for x in (a, b, c)]
        self.rows.append((kind, token, dest, id_, th, *as_bytes))

    def batches(self) -> Iterator[pa.RecordBatch]:
        for at in range(0, len(self.rows), ROWS_AT_ONCE):
            columns = zip(*self.rows[at : at + ROWS_AT_ONCE], strict=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(c), f.type) for c, f in zip(columns, ARROW, strict=True)],
                schema=ARROW,
            )
        self.rows = []


class Tokens:
    """Numbers for the chunks of this task."""

    def __init__(self):
        context = TaskContext.get()
        self.next = (context.partitionId() if context else 0) << 24

    def new(self) -> int:
        self.next += 1
        return self.next


def blocks_of(spark: SparkSession) -> int:
    """How many blocks the keys are dealt to: a few for each shuffle partition."""
    return 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))


def by_block(
    rows: Rows, token: int, block: np.ndarray, columns: list[np.ndarray], form=None
) -> None:
    """Add a KEYS row for each block; columns are cut alike, the order within is kept.

    `form` turns the columns of a block into those of its row.
    """
    order = np.argsort(block, kind="stable")
    block = block[order]
    cuts = np.flatnonzero(np.diff(block)) + 1
    for part in np.split(np.arange(len(block)), cuts):
        if len(part):
            chosen = order[part]
            own = [c[chosen] for c in columns]
            rows.add(
                KEYS, token, int(block[part[0]]), None, None, *(form(*own) if form else own)
            )


def pack(values: np.ndarray) -> bytes:
    """Some whole numbers, at least one, in as few bytes each as their range needs."""
    low, high = int(values.min()), int(values.max())
    for width in (1, 2, 4):
        if high - low < 1 << 8 * width:
            break
    else:
        low, width = 0, 8
    return np.array([low, width], "<i8").tobytes() + (values - low).astype(f"<i{width}").tobytes()


def unpack(data: bytes) -> np.ndarray:
    low, width = np.frombuffer(data, "<i8", 2).tolist()
    kind = "<i8" if width == 8 else f"<u{width}"
    return np.frombuffer(data, kind, offset=16).astype(np.int64) + low


def home(token: int) -> int:
    """Where rows for a chunk go; negative, so apart from all blocks."""
    return -token


def _grouped(batches, column: str) -> Iterator[tuple[int, list[dict]]]:
    """Runs of rows with one value of `column`; the rows are sorted by it."""
    key, held = None, []
    for batch in batches:
        for row in batch.to_pylist():
            if held and row[column] != key:
                yield key, held
                held = []
            key = row[column]
            held.append(row)
    if held:
        yield key, held


def compare(
    sent: DataFrame, compare_block: Callable[[list[dict], Rows], None]
) -> DataFrame:
    """Let each block turn its KEYS rows into REPLY rows; all other rows pass."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def own(rows_of_blocks):
            for dest, rows in rows_of_blocks:
                out = Rows()
                if dest >= 0:
                    compare_block(rows, out)
                yield from out.batches()

        passing: list[pa.RecordBatch] = []

        def keys_only():
            for batch in batches:
                mask = pa.array(np.asarray(batch.column("dest")) < 0)
                other = batch.filter(mask)
                if other.num_rows:
                    passing.append(other)
                keys = batch.filter(pc.invert(mask))
                if keys.num_rows:
                    yield keys

        for out in own(_grouped(keys_only(), "dest")):
            while passing:
                yield passing.pop()
            yield out
        yield from passing

    return sent.repartition("dest").sortWithinPartitions("dest").mapInArrow(run, SCHEMA)


def resolve(
    rows: DataFrame, resolve_doc: Callable[[dict, list[dict]], bytes | None], prepare=None
) -> DataFrame:
    """(id, th, found): what the documents make of their chunk's replies; none if nothing.

    `prepare` turns the replies of a chunk into what `resolve_doc` gets as its second argument.
    """
    schema = pa.schema([("id", pa.int64()), ("th", pa.int32()), ("found", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        replies: list[dict] = []
        ready = token = None

        for batch in batches:
            out: list[tuple] = []
            for row in batch.to_pylist():
                if row["token"] != token:
                    token, replies, ready = row["token"], [], None
                if row["kind"] == REPLY:
                    replies.append(row)
                    continue
                # REPLY rows sort before DOC rows.
                if ready is None:
                    ready = prepare(replies)
                found = resolve_doc(row, ready)
                if found:
                    out.append((row["id"], row["th"], found))
            if out:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(list(c), f.type) for c, f in
                     zip(zip(*out, strict=True), schema, strict=True)],
                    schema=schema,
                )

    found = (
        rows.repartition("token").sortWithinPartitions("token", F.col("kind").desc())
        .mapInArrow(run, "id long, th int, found binary")
    )
    # Rows equal in id and text have one result.
    return found.groupBy("id", "th").agg(F.max("found").alias("found"))


def runs(values: np.ndarray, *more: np.ndarray) -> np.ndarray:
    """Rows (first value, firsts of more..., length) of runs in which all go up by one."""
    if not len(values):
        return np.zeros((0, 2 + len(more)), "<u4")
    breaks = np.zeros(len(values) - 1, bool)
    for array in (values, *more):
        breaks |= np.diff(array) != 1
    starts = np.concatenate(([0], np.flatnonzero(breaks) + 1))
    lengths = np.diff(np.append(starts, len(values)))
    return np.stack([a[starts] for a in (values, *more)] + [lengths], axis=1).astype("<u4")


def intervals(starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The union of the intervals [start, end) as disjoint ones, ascending."""
    order = np.argsort(starts, kind="stable")
    starts, ends = starts[order], np.maximum.accumulate(ends[order])
    fresh = np.append(True, starts[1:] > ends[:-1])[: len(starts)]
    first = np.flatnonzero(fresh)
    last = np.append(first[1:], len(starts)) - 1
    return np.stack((starts[first], ends[last[: len(first)]]), axis=1).astype("<u4")


def keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, text, th): th tells rows apart that share an id."""
    return docs.select(
        F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")
    ).withColumn("th", F.hash("text"))


def same_document(left: DataFrame, right: DataFrame, how: str) -> DataFrame:
    """Join by id and th; null ids match, so that no filter sets the two uses of a table apart."""
    renamed = right.withColumnsRenamed({"id": "right_id", "th": "right_th"})
    condition = F.col("id").eqNullSafe(F.col("right_id")) & (F.col("th") == F.col("right_th"))
    return left.join(renamed, condition, how).drop("right_id", "right_th")
