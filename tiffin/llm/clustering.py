"""Exact k-means over integer vectors, with geometric drift tightening.

Every vector keeps its cluster, its exact distance to that centroid and a lower bound on the
distance to every other one. When the centroids have moved, the bound would be safe if it were
lowered by the largest move (the drift). It is lowered by less: all vectors of a cluster lie in
a sphere around its old centroid, and how much closer a centroid that moves from p to q can come
to points of that sphere is a matter of plane geometry. With the midpoint O of pq,

    |x - p| - |x - q|  =  (|x-p|^2 - |x-q|^2) / (|x-p| + |x-q|)  <=  |pq| cos(angle of x at O
    to the direction of the move),

since |x-p| + |x-q| >= 2 |x-O|. Seen from O, the sphere of centre m and radius r spans the angles
within arcsin(r / |m-O|) of the direction to m, so the largest cosine is known in closed form;
it is 0 for a centroid that moves away. A vector nearer to its own centroid than its bound stays;
the others are ambiguous and are compared with every centroid exactly.

Bounds are floating-point numbers with a margin; what decides between centroids is integers.
Squared distances come from floating-point products where all terms are below 2^53, from 64-bit
integers up to components of 2^27, and from Python's integers beyond.

Each round writes the vectors with their state and removes the round's before; only one row per
cluster, component and limb reaches the driver.

Defined results: vectors of another width, null ones and ones with null or non-finite components
take no part. Fewer vectors than `k` give as many centroids; no vectors give no rows. Null ids
start a centroid only after all others; of equal ids the smaller vector comes first. Ties go to
the smaller centroid number. A distance that does not fit into 64 bits is null, and so are sums
that include one or do not fit. Equal rows give equal rows. Other columns are not carried on, so
their names cannot clash.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tiffin.session import remove_path, work_path

EXACT_FLOAT = float(1 << 22)  # below this, for up to 64 components, products stay under 2^53
EXACT_LONG = float(1 << 27)
LONG = (1 << 63) - 1
RELATIVE = 1e-11
MARGIN = 1e-9
LIMB = 31


def scaled(x: float, scale: int) -> int:
    """floor(scale * x) for a finite x, also where the product leaves the doubles."""
    product = scale * x
    return math.floor(product) if math.isfinite(product) else int(x) * scale


class Centroids:
    """The centroids as exact integers, as floating-point numbers and with their sizes."""

    def __init__(self, rows: list[list[int]]):
        self.rows = rows
        big = 10**300
        self.floats = np.array(
            [[float(max(-big, min(big, c))) for c in row] for row in rows], np.float64
        )
        largest = np.abs(self.floats).max(axis=1)
        self.narrow = largest <= EXACT_FLOAT
        self.longs = np.array(
            [row if m <= EXACT_LONG else [0] * len(row) for row, m in zip(rows, largest, strict=True)],
            np.int64,
        )
        self.fits = largest <= EXACT_LONG
        with np.errstate(over="ignore"):
            self.squares = (self.floats**2).sum(axis=1)


class Vectors:
    """Some vectors as integers in floating-point form; `exact` gives true integers."""

    def __init__(self, raw: np.ndarray, scale: int):
        self.raw, self.scale = raw, scale
        with np.errstate(over="ignore"):
            self.floats = np.floor(raw * scale)
            self.squares = (self.floats**2).sum(axis=1)
        largest = np.abs(self.floats).max(axis=1) if len(raw) else np.zeros(0)
        self.narrow = largest <= EXACT_FLOAT
        self.fits = largest <= EXACT_LONG

    def exact(self, place: int) -> list[int]:
        return [scaled(x, self.scale) for x in self.raw[place].tolist()]

    def taken(self, places: np.ndarray) -> Vectors:
        return Vectors(self.raw[places], self.scale)


def distances(vectors: Vectors, places: np.ndarray, numbers: np.ndarray, centroids: Centroids):
    """The exact squared distance of each (place, centroid number), as Python integers if large."""
    plain = vectors.fits[places] & centroids.fits[numbers]
    out = np.zeros(len(places), np.int64)
    at = places[plain]
    gap = vectors.floats[at].astype(np.int64) - centroids.longs[numbers[plain]]
    out[plain] = (gap * gap).sum(axis=1)
    if plain.all():
        return out
    out = out.astype(object)
    for i in np.flatnonzero(~plain).tolist():
        x, c = vectors.exact(int(places[i])), centroids.rows[int(numbers[i])]
        out[i] = sum((a - b) ** 2 for a, b in zip(x, c, strict=True))
    return out


def root(squared: np.ndarray) -> np.ndarray:
    if squared.dtype == object:
        return np.array([math.sqrt(min(s, 10**300)) if s < 10**300 else math.inf for s in squared])
    return np.sqrt(squared.astype(np.float64))


def scan(vectors: Vectors, centroids: Centroids):
    """(cluster, squared distance, lower bound for all other centroids) against every centroid."""
    n, k = len(vectors.raw), len(centroids.rows)
    with np.errstate(over="ignore", invalid="ignore"):
        near = vectors.squares[:, None] - 2 * (vectors.floats @ centroids.floats.T) + centroids.squares
        slack = RELATIVE * (vectors.squares[:, None] + centroids.squares)
    slack[vectors.narrow[:, None] & centroids.narrow[None, :]] = 0
    lost = ~np.isfinite(near) | ~np.isfinite(slack)
    low = np.where(lost, 0, near - slack)
    high = np.where(lost, np.inf, near + slack)
    open_ = low <= high.min(axis=1)[:, None]
    cluster = np.where(open_, low, np.inf).argmin(axis=1)
    # Exact values settle what the bounds leave open; equal exact ones keep the first.
    unsure = np.flatnonzero((open_.sum(axis=1) > 1) & (np.where(open_, slack, 0).max(axis=1) > 0)
                            | (open_ & lost).any(axis=1))
    for i in unsure.tolist():
        numbers = np.flatnonzero(open_[i])
        exact = distances(vectors, np.full(len(numbers), i), numbers, centroids).tolist()
        cluster[i] = numbers[exact.index(min(exact))]
    squared = distances(vectors, np.arange(n), cluster, centroids)
    if k > 1:
        others = low.copy()
        others[np.arange(n), cluster] = np.inf
        lower = np.sqrt(np.maximum(others.min(axis=1), 0)) * (1 - MARGIN)
    else:
        lower = np.full(n, np.inf)
    return cluster, squared, lower


def tightened_drifts(
    old: np.ndarray, new: np.ndarray, radius: np.ndarray
) -> np.ndarray:
    """By how much the lower bounds of each cluster's vectors must be lowered.

    `old` and `new` are the centroids, `radius` that of the sphere of each cluster around its old
    centroid, negative for a cluster without vectors.
    """
    k = len(old)
    out = np.zeros(k)
    with np.errstate(over="ignore", invalid="ignore", divide="ignore"):
        moves = new - old
        lengths = np.sqrt((moves**2).sum(axis=1))
        middles = (new + old) / 2
        for i in range(k):
            if radius[i] < 0:
                continue
            away = old[i] - middles
            far = np.sqrt((away**2).sum(axis=1))
            angle = np.arccos(np.clip((away * moves).sum(axis=1) / (far * lengths), -1, 1))
            spread = np.arcsin(np.clip(radius[i] * (1 + MARGIN) / far, 0, 1))
            closest = np.where(radius[i] * (1 + MARGIN) >= far, 0, np.maximum(0, angle - spread))
            drift = lengths * np.maximum(0, np.cos(closest)) * (1 + MARGIN) + MARGIN
            drift = np.where(lengths == 0, 0, np.where(np.isfinite(drift), drift, np.inf))
            drift[i] = 0
            out[i] = drift.max()
    return out


def advance(vectors: Vectors, cluster, lower, centroids: Centroids, drifts: np.ndarray):
    """The same for vectors whose cluster and bound are known from the round before, and which
    of them were ambiguous."""
    squared = distances(vectors, np.arange(len(vectors.raw)), cluster, centroids)
    lower = lower - drifts[cluster]
    upper = root(squared)
    ambiguous = np.flatnonzero(~(upper * (1 + MARGIN) + MARGIN < lower))
    if len(ambiguous):
        found = scan(vectors.taken(ambiguous), centroids)
        cluster, lower = cluster.copy(), lower.copy()
        if found[1].dtype == object:
            squared = squared.astype(object)
        cluster[ambiguous], squared[ambiguous], lower[ambiguous] = found
    again = np.zeros(len(squared), bool)
    again[ambiguous] = True
    return cluster, squared, lower, again


def _matrix(column) -> np.ndarray:
    values = np.asarray(column.flatten()).astype(np.float64)
    return values.reshape(len(column), -1) if len(column) else np.zeros((0, 1))


def _limbs(value: int) -> list[int]:
    """Parts of a whole number to the base 2^LIMB, all of its sign."""
    sign, value, out = (1 if value >= 0 else -1), abs(value), []
    while value:
        out.append(sign * (value & ((1 << LIMB) - 1)))
        value >>= LIMB
    return out


def component_sums(state: DataFrame, scale: int) -> DataFrame:
    """(cluster, component, limb, total): exact sums over the vectors of each cluster."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[int, list[int]] = {}
        for batch in batches:
            vectors = Vectors(_matrix(batch.column("x")), scale)
            cluster = np.asarray(batch.column("cluster"))
            for number in np.unique(cluster).tolist():
                mine = (cluster == number) & vectors.fits
                part = vectors.floats[mine].astype(np.int64).sum(axis=0).tolist()
                for place in np.flatnonzero((cluster == number) & ~vectors.fits).tolist():
                    part = [a + b for a, b in zip(part, vectors.exact(place), strict=True)]
                held = totals.get(number)
                totals[number] = (
                    part if held is None else [a + b for a, b in zip(held, part, strict=True)]
                )
        rows = [
            (number, component, limb, part)
            for number, sums in totals.items()
            for component, value in enumerate(sums)
            for limb, part in enumerate(_limbs(value))
        ]
        if rows:
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(c), t) for c, t in zip(
                    zip(*rows, strict=True), (pa.int32(), pa.int32(), pa.int32(), pa.int64()),
                    strict=True)],
                ["cluster", "component", "limb", "part"],
            )

    parts = state.select("cluster", "x").mapInArrow(
        run, "cluster int, component int, limb int, part long"
    )
    return parts.groupBy("cluster", "component", "limb").agg(F.sum("part").alias("total"))


def _rows(df: DataFrame) -> list:
    """A table of a known, small number of rows, handed over as one."""
    return df.agg(F.collect_list(F.struct(*df.columns)).alias("rows")).first()["rows"]


def moved(state: DataFrame, centroids: Centroids, scale: int) -> tuple[Centroids, np.ndarray]:
    """The centroids after a round, and the radius of each cluster around its old centroid."""
    k, dims = centroids.floats.shape
    radius, counts = np.full(k, -1.0), [0] * k
    for row in _rows(
        state.groupBy("cluster").agg(F.count("*").alias("n"), F.max("distance").alias("radius"))
    ):
        counts[row["cluster"]], radius[row["cluster"]] = row["n"], row["radius"]
    sums = [[0] * dims for _ in range(k)]
    for row in _rows(component_sums(state, scale)):
        sums[row["cluster"]][row["component"]] += row["total"] << LIMB * row["limb"]
    rows = [
        [s // n for s in total] if n else old
        for total, n, old in zip(sums, counts, centroids.rows, strict=True)
    ]
    return Centroids(rows), radius


class Clustering:
    """Vectors with their clusters, and the centroids that they were assigned to.

    `state` also says for each vector whether the last round had to scan it."""

    def __init__(self, state: DataFrame | None, centroids: Centroids | None):
        self.state, self.centroids = state, centroids


def usable(
    vectors: DataFrame, dims: int, id_col: str = "vec_id", vector_col: str = "embedding"
) -> DataFrame:
    """(id, x): the vectors of `dims` components, none null or non-finite."""
    x = F.col("x")
    bad = F.exists(
        x, lambda v: v.isNull() | F.isnan(v) | (F.abs(v.cast("double")) == float("inf"))
    )
    return vectors.select(F.col(id_col).alias("id"), F.col(vector_col).alias("x")).where(
        (F.size(x) == dims) & ~bad
    )


def fit(
    vectors: DataFrame, k: int = 16, rounds: int = 3, dims: int = 64, scale: int = 64,
    seed: int = 1, id_col: str = "vec_id", vector_col: str = "embedding",
) -> Clustering:
    """Assign and move `rounds` times, then assign once more."""
    spark = vectors.sparkSession
    rows = usable(vectors, dims, id_col, vector_col)
    place = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("id").cast("string")), 256)
    first = (
        rows.select(place.alias("place"), "x").orderBy(F.col("place").asc_nulls_last(), "x").limit(k)
    )
    chosen = sorted(_rows(first), key=lambda r: (r["place"] is None, r["place"] or "", r["x"]))
    if not chosen:
        return Clustering(None, None)
    centroids = Centroids([[scaled(v, scale) for v in r["x"]] for r in chosen])
    schema = T.StructType(
        [
            *rows.schema.fields,
            T.StructField("cluster", T.IntegerType(), False),
            T.StructField("squared", T.LongType()),
            T.StructField("distance", T.DoubleType(), False),
            T.StructField("lower", T.DoubleType(), False),
            T.StructField("scanned", T.BooleanType(), False),
        ]
    )

    def assigned(frame: DataFrame, now: Centroids, drifts: np.ndarray | None) -> DataFrame:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                if not batch.num_rows:
                    continue
                held = Vectors(_matrix(batch.column("x")), scale)
                if drifts is None:
                    cluster, squared, lower = scan(held, now)
                    again = np.ones(batch.num_rows, bool)
                else:
                    cluster, squared, lower, again = advance(
                        held, np.asarray(batch.column("cluster")),
                        np.asarray(batch.column("lower")), now, drifts,
                    )
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("id"), batch.column("x"), pa.array(cluster.astype(np.int32)),
                        pa.array([s if s <= LONG else None for s in squared.tolist()], pa.int64()),
                        pa.array(root(squared)), pa.array(lower), pa.array(again),
                    ],
                    schema.names,
                )

        return frame.mapInArrow(run, schema)

    frame, drifts, old_path = rows, None, None
    for turn in range(rounds + 1):
        path = work_path(spark, f"clusters-{turn}")
        assigned(frame, centroids, drifts).write.parquet(path)
        frame = spark.read.schema(schema).parquet(path)
        if old_path:
            remove_path(spark, old_path)
        old_path = path
        if turn < rounds:
            after, radius = moved(frame, centroids, scale)
            drifts = tightened_drifts(centroids.floats, after.floats, radius)
            centroids = after
    return Clustering(frame, centroids)


def clusters(
    vectors: DataFrame, k: int = 16, rounds: int = 3, dims: int = 64, scale: int = 64,
    seed: int = 1, id_col: str = "vec_id", vector_col: str = "embedding",
) -> DataFrame:
    """(id, cluster, distance, cluster_inertia, inertia, centroid) per vector that takes part.

    `centroid` is the final one's components as text, joined by commas.
    """
    spark = vectors.sparkSession
    done = fit(vectors, k, rounds, dims, scale, seed, id_col, vector_col)
    names = "cluster int, distance long, cluster_inertia long, inertia long, centroid string"
    if done.state is None:
        kind = vectors.schema[id_col].dataType.simpleString()
        return spark.createDataFrame([], f"id {kind}, {names}")
    exact = F.sum(F.col("squared").cast("decimal(20,0)"))
    complete = F.count("squared") == F.count("*")
    per_cluster = _rows(
        done.state.groupBy("cluster").agg(
            F.when(complete, exact).alias("inertia"), F.count("*").alias("n")
        )
    )
    sums = {r["cluster"]: None if r["inertia"] is None else int(r["inertia"]) for r in per_cluster}
    total = None if None in sums.values() else sum(sums.values())

    def fitting(value: int | None) -> int | None:
        return value if value is not None and value <= LONG else None

    # One row per centroid.
    table = spark.createDataFrame(
        [
            (number, fitting(sums[number]), fitting(total),
             ",".join(map(str, done.centroids.rows[number])))
            for number in sums
        ],
        "number int, cluster_inertia long, inertia long, centroid string",
    )
    return done.state.join(F.broadcast(table), F.col("cluster") == F.col("number")).select(
        "id", "cluster", F.col("squared").alias("distance"), "cluster_inertia", "inertia", "centroid"
    )
