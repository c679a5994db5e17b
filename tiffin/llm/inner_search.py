"""Exact top-k search by inner product over norm-sorted, SVD-rotated vectors.

Vectors are sorted by length, longest first, and packed into blocks of neighbours. Queries are
packed too, and every task scans some blocks for some queries. By Cauchy-Schwarz no vector of a
block scores above |q| times the block's greatest length, which skips whole blocks. In the
rotation of the SVD the first coordinates hold most of the length: a partial inner product over
them, plus the product of the two residual lengths, bounds the score from above. Only vectors
whose bound reaches the query's k-th score so far are scored, with exact integers. Bounds have a
margin for rounding, so nothing is lost, ties included.

Each component x becomes floor(scale * x), which a double holds exactly; scores are summed in
64 bits where no sum can leave them, and in Python's integers otherwise. They travel in a form
whose bytes sort like the numbers, so the order is exact at any size.

Defined results: vectors that are null, or hold a null or non-finite component, take no part, nor
do those with a component that scaling takes out of the doubles. A score beyond 64 bits has its
rank but is given as null. Vectors of different lengths are compared as if filled up with zeros.
A row is left out of its own query only, not rows that share its id. Ties go to the smaller id,
null last, then to the earlier row. Rows without an id are no queries. Other columns are not
carried on.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tiffin.llm.common import stored

SCALE = 1024
LONG = 1 << 63
BLOCK = 2048  # vectors of a block
GROUP = 4096  # queries of a group
STRIPES = 16  # tasks that share the blocks for one group
FIRST = 4  # one in FIRST of the rotated coordinates makes the partial sum
SLACK = 1e-9


def integers(vectors: DataFrame, id_col: str, vector_col: str, scale: int) -> DataFrame:
    """(seq, id, x, norm): usable vectors as packed whole numbers in doubles."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seqs, ids, packed, norms = [], [], [], []
            names = zip(batch.column("seq").to_pylist(), batch.column("id").to_pylist(), strict=True)
            for (seq, id_), value in zip(names, batch.column("v"), strict=True):
                if not value.is_valid or value.values.null_count:
                    continue
                with np.errstate(over="ignore"):
                    x = np.floor(np.asarray(value.values.cast(pa.float64())) * scale)
                if not np.isfinite(x).all():
                    continue
                seqs.append(seq)
                ids.append(id_)
                packed.append(x.astype("<f8").tobytes())
                norms.append(length(x))
            yield pa.RecordBatch.from_arrays(
                [pa.array(seqs, pa.int64()), pa.array(ids, pa.int64()),
                 pa.array(packed, pa.binary()), pa.array(norms, pa.float64())],
                ["seq", "id", "x", "norm"],
            )

    rows = vectors.select(
        F.monotonically_increasing_id().alias("seq"), F.col(id_col).cast("long").alias("id"),
        F.col(vector_col).alias("v"),
    )
    return rows.mapInArrow(run, "seq long, id long, x binary, norm double")


def length(x: np.ndarray) -> float:
    """The length of a vector, never less than rounding could make it."""
    largest = float(np.abs(x).max()) if len(x) else 0.0
    return largest * float(np.linalg.norm(x / largest)) if largest else 0.0


def matrix(packed: list[bytes], width: int) -> np.ndarray:
    out = np.zeros((len(packed), width))
    for row, data in zip(out, packed, strict=True):
        row[: len(data) // 8] = np.frombuffer(data, "<f8")
    return out


def exact_scores(x: np.ndarray, query: np.ndarray) -> np.ndarray:
    """The inner products of whole numbers held in doubles, exactly: 64-bit or Python integers."""
    largest, most = np.abs(x).max(initial=0.0), np.abs(query).max(initial=0.0)
    if max(largest, most) < LONG / 4 and largest * most * len(query) < LONG / 4:
        return x.astype(np.int64) @ query.astype(np.int64)
    wide = [int(v) for v in query.tolist()]
    return np.array(
        [sum(int(a) * b for a, b in zip(row, wide, strict=True)) for row in x.tolist()], object
    )


def sortable(value: int) -> bytes:
    """Bytes that sort like the numbers: sign, length and magnitude, inverted below zero."""
    size = (abs(value).bit_length() + 7) // 8
    data = b"\x01" + size.to_bytes(2, "big") + abs(value).to_bytes(size, "big")
    return data if value >= 0 else bytes(255 - b for b in data)


def rotation(rows: DataFrame, width: int) -> np.ndarray:
    """The right singular vectors of all rows, greatest first: one small matrix per task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((width, width))
        for batch in batches:
            x = matrix(batch.column("x").to_pylist(), width)
            # Few very long vectors must not take the sums out of the doubles.
            x /= np.maximum(1.0, np.abs(x).max(axis=1, initial=0.0) / 2.0**100)[:, None]
            total += x.T @ x
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(width * width)), pa.array(total.ravel())], ["place", "part"]
        )

    sums = rows.select("x").mapInArrow(run, "place long, part double")
    gram = np.zeros(width * width)
    totals = sums.groupBy("place").agg(F.sum("part").alias("part"))
    # As many numbers as the square of the width, however many rows there are.
    for place, part in totals.agg(F.collect_list(F.struct("place", "part"))).first()[0]:
        gram[place] = part
    _, vectors = np.linalg.eigh(gram.reshape(width, width))
    return vectors[:, ::-1]


def packed(rows: DataFrame, size: int) -> DataFrame:
    """(norm, seqs, ids, xs): neighbouring rows of a partition in one, norm being the greatest."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, size):
                part = batch.slice(at, size).to_pydict()
                yield pa.RecordBatch.from_pydict(
                    {"norm": [max(part["norm"])], "seqs": [part["seq"]], "ids": [part["id"]],
                     "xs": [part["x"]]},
                    schema=pa.schema([
                        ("norm", pa.float64()), ("seqs", pa.list_(pa.int64())),
                        ("ids", pa.list_(pa.int64())), ("xs", pa.list_(pa.binary())),
                    ]),
                )

    schema = "norm double, seqs array<long>, ids array<long>, xs array<binary>"
    return rows.select("seq", "id", "x", "norm").mapInArrow(run, schema)


class Group:
    """The queries of a task and their best rows so far."""

    def __init__(self, row: dict, k: int, turn: np.ndarray):
        self.k, self.turn, self.width = k, turn, len(turn)
        self.first = -(-self.width // FIRST)
        self.seqs, self.ids = np.array(row["seqs"]), row["ids"]
        self.x = matrix(row["xs"], self.width)
        self.turned, self.norm, self.rest = self._turn(self.x)
        self.least = np.full(len(self.x), -np.inf)
        self.best: list[list[tuple]] = [[] for _ in self.ids]

    def _turn(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Rotated vectors, their lengths and those of what the partial sum leaves out."""
        with np.errstate(over="ignore", invalid="ignore"):
            turned = x @ self.turn
            return (
                turned, np.linalg.norm(turned, axis=1),
                np.linalg.norm(turned[:, self.first :], axis=1),
            )

    def scan(self, block: dict) -> None:
        # Scores are integers: a bound short of the k-th by rounding must still pass.
        # A bound that has left the doubles rules nothing out.
        def reaches(bound, size, rows=slice(None)):
            with np.errstate(over="ignore", invalid="ignore"):
                total = bound + SLACK * size + 0.5
            least = self.least[rows].reshape(-1, *[1] * (bound.ndim - 1))
            return (total >= least) | ~np.isfinite(total)

        with np.errstate(over="ignore", invalid="ignore"):
            at_most = self.norm * block["norm"]
        live = np.flatnonzero(reaches(at_most, at_most))
        if not len(live):
            return
        x = matrix(block["xs"], self.width)
        turned, norm, rest = self._turn(x)
        with np.errstate(over="ignore", invalid="ignore"):
            bound = self.turned[live, : self.first] @ turned[:, : self.first].T
            bound += self.rest[live, None] * rest
            size = self.norm[live, None] * norm
        mask = reaches(bound, size, live)
        seqs = np.array(block["seqs"])
        ids = np.array([np.iinfo(np.int64).max if i is None else i for i in block["ids"]])
        missing = np.array([i is None for i in block["ids"]])
        for place, query in enumerate(live.tolist()):
            found = np.flatnonzero(mask[place] & (seqs != self.seqs[query]))
            if not len(found):
                continue
            scores = exact_scores(x[found], self.x[query])
            order = np.arange(len(found))
            if scores.dtype != object:
                order = np.lexsort((seqs[found], ids[found], missing[found], -scores))[: self.k]
            rows = [
                (-int(scores[i]), bool(missing[found[i]]), int(ids[found[i]]), int(seqs[found[i]]))
                for i in order
            ]
            best = self.best[query] = sorted(self.best[query] + rows)[: self.k]
            if len(best) == self.k:
                # Not above the true score, also where a double cannot hold it.
                least = -best[-1][0]
                self.least[query] = np.nextafter(float(least), -np.inf) if abs(least) < 10**300 else -np.inf

    def results(self) -> pa.RecordBatch:
        rows = [
            (int(seq), id_, None if missing else other, other_seq,
             -score if -LONG <= -score < LONG else None, sortable(-score))
            for seq, id_, best in zip(self.seqs, self.ids, self.best, strict=True)
            for score, missing, other, other_seq in best
        ]
        names = ["query_seq", "query_id", "id", "seq", "score", "place"]
        columns = zip(*rows, strict=True) if rows else [[] for _ in names]
        kinds = [*[pa.int64()] * 5, pa.binary()]
        return pa.RecordBatch.from_arrays(
            [pa.array(list(c), kind) for c, kind in zip(columns, kinds, strict=True)], names
        )


def top_k(
    vectors: DataFrame, is_query: Column, k: int = 10, scale: int = SCALE,
    id_col: str = "vec_id", vector_col: str = "embedding",
) -> DataFrame:
    """(query_id, rank, id, score): the k best rows for each row where `is_query` holds of `id`."""
    rows = stored(integers(vectors, id_col, vector_col, scale), "search-rows")
    width = (rows.agg(F.max(F.length("x"))).first()[0] or 0) // 8
    turn = rotation(rows, width) if width else np.zeros((0, 0))
    blocks = stored(
        packed(
            rows.repartitionByRange(F.desc("norm"), "seq").sortWithinPartitions(F.desc("norm")),
            BLOCK,
        ).withColumn("place", F.monotonically_increasing_id()),
        "search-blocks",
    )
    queries = rows.where(is_query & F.col("id").isNotNull())
    groups = stored(
        packed(queries.repartition(-(-queries.count() // GROUP) or 1), 2 * GROUP).withColumn(
            "grp", F.monotonically_increasing_id()
        ),
        "search-groups",
    )
    # Neighbours in length go to different stripes, so that each begins with long vectors.
    stripes = F.explode(F.sequence(F.lit(0), F.lit(STRIPES - 1))).alias("stripe")
    asked = groups.select("grp", stripes, F.lit(0).alias("kind"), "norm", "seqs", "ids", "xs")
    # One row per block and group of queries: the query set against all rows, in blocks.
    numbers = groups.agg(F.collect_list("grp").alias("grps"))
    offered = blocks.join(F.broadcast(numbers)).select(
        F.explode("grps").alias("grp"),
        F.pmod(F.xxhash64("place"), F.lit(STRIPES)).cast("int").alias("stripe"),
        F.lit(1).alias("kind"), "norm", "seqs", "ids", "xs",
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group = None
        for batch in batches:
            for at in range(batch.num_rows):
                row = batch.slice(at, 1).to_pylist()[0]
                if row["kind"] == 0:
                    if group is not None:
                        yield group.results()
                    group = Group(row, k, turn)
                else:
                    group.scan(row)
        if group is not None:
            yield group.results()

    keys = ["grp", "stripe"]
    found = asked.unionByName(offered).repartition(*keys).sortWithinPartitions(
        *keys, "kind", F.desc("norm")
    ).mapInArrow(run, "query_seq long, query_id long, id long, seq long, score long, place binary")
    # At most k rows of a stripe meet here.
    ranked = Window.partitionBy("query_seq").orderBy(
        F.desc("place"), F.asc_nulls_last("id"), "seq"
    )
    return found.withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= k).select(
        "query_id", "rank", "id", "score"
    )
