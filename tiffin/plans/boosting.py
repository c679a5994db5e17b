"""Boosted trees: the fit of Spark's `GBTRegressor`, over rows kept as a few small codes.

Spark's own fit holds a row as one number per slot of its vector and adds to the totals of every
slot, in each of `maxDepth` passes a tree. Here a category is one code and not a slot per label, and
several columns share a code as long as their combinations are few, so a row is some 16 bytes with
its error. Totals of the combinations are counted in Arrow batches and summed to those of each
column at the end of a task. Sampled split points, bins, gains, stopping rules and weights are
Spark's (squared error, no subsampling, all features), and so is the model.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import TaskContext, cloudpickle
from pyspark.ml.feature import OneHotEncoderModel, VectorAssembler
from pyspark.ml.regression import GBTRegressionModel, GBTRegressor
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.classic.dataframe import DataFrame as ClassicDataFrame
from pyspark.storagelevel import StorageLevel

from tiffin.session import delete_folder, ensure_checkpoint_dir

SPLIT_ROWS = 10_000  # Spark looks for split points in about so many rows
GROUP_CODES = 1 << 11  # combinations of the columns that share a code, at most
CHUNK_ROWS = 1 << 15
PARTITION_ROWS = 1 << 23
BATCH_BYTES = "4m"  # Spark fills a batch of tens of megabytes of chunks much slower
EPSILON = 2.0**-52
NO_GAIN = 2.0**-40  # a gain below this part of the impurity is rounding

# Tasks get the functions themselves, so the workers need not have this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

_CHUNK = "codes binary, errors binary, squares binary"
_TOTALS = "part int, totals binary, squares binary, leaves binary"


@dataclass(frozen=True)
class Feature:
    """A column behind the vector: a number in one slot, or a category with a slot per label."""

    column: str
    slot: int
    labels: int | None = None


def vector_features(stages: list) -> list[Feature]:
    """The columns that the fitted feature stages put into the vector, in its order."""
    encoder = next(s for s in stages if isinstance(s, OneHotEncoderModel))
    assembler = next(s for s in stages if isinstance(s, VectorAssembler))
    index = dict(zip(encoder.getOutputCols(), encoder.getInputCols(), strict=True))
    # The last label is dropped: the indexer's place for unknown ones.
    labels = dict(zip(encoder.getOutputCols(), [n - 1 for n in encoder.categorySizes], strict=True))
    features, slot = [], 0
    for column in assembler.getInputCols():
        features.append(Feature(index.get(column, column), slot, labels.get(column)))
        slot += labels.get(column, 1)
    return features


def split_points(values: np.ndarray, expected: float, most: int) -> np.ndarray:
    """Thresholds of one numeric column out of a sample, as Spark chooses them.

    Zeros are not counted but told from the expected size of the sample. Few values are all
    parted; of many, the thresholds cut the sample in `most + 1` parts of about one size.
    """
    distinct, counts = np.unique(values[values != 0.0], return_counts=True)
    if not len(distinct):
        return distinct
    counts = counts.astype(float)
    n = counts.sum()
    if expected - n > EPSILON * n * 100:
        at = np.searchsorted(distinct, 0.0)
        distinct, counts = np.insert(distinct, at, 0.0), np.insert(counts, at, expected - n)
    between = (distinct[:-1] + distinct[1:]) / 2.0
    if len(between) <= most:
        return between
    stride = expected / (most + 1)
    found, target, so_far = [], stride, counts[0]
    for k, count in enumerate(counts[1:]):
        before, so_far = so_far, so_far + count
        if abs(before - target) < abs(so_far - target):
            found.append(between[k])
            target += stride
    return np.array(found)


@dataclass
class Layout:
    """How the columns of a row lie in its codes, and their bins in the totals."""

    features: list[Feature]
    thresholds: list[np.ndarray]
    sizes: list[int] = field(init=False)
    groups: list[list[int]] = field(init=False)

    def __post_init__(self) -> None:
        self.sizes = [
            len(cuts) + 1 if f.labels is None else f.labels + 1
            for f, cuts in zip(self.features, self.thresholds, strict=True)
        ]
        self.groups, room = [], []
        for f in sorted(range(len(self.sizes)), key=lambda f: -self.sizes[f]):
            fits = [g for g, left in enumerate(room) if left >= self.sizes[f]]
            if fits:
                self.groups[fits[0]].append(f)
                room[fits[0]] //= self.sizes[f]
            else:
                self.groups.append([f])
                room.append(GROUP_CODES // self.sizes[f])

    @property
    def widths(self) -> list[int]:
        return [int(np.prod([self.sizes[f] for f in group])) for group in self.groups]

    @property
    def offsets(self) -> np.ndarray:
        """Where the bins of each column begin in the totals of a node."""
        return np.concatenate([[0], np.cumsum(self.sizes)])

    @property
    def code_type(self) -> str:
        return "uint16" if max(self.widths) <= 1 << 16 else "int64"

    def bins_of_codes(self, f: int) -> tuple[int, np.ndarray]:
        """The group of a column, and the column's bin for every code of that group."""
        g = next(g for g, group in enumerate(self.groups) if f in group)
        shape = [self.sizes[k] for k in self.groups[g]]
        return g, np.indices(shape)[self.groups[g].index(f)].ravel()

    def codes(self, batch: pa.RecordBatch) -> np.ndarray:
        """One row of codes per group."""
        bins = []
        for feature, cuts in zip(self.features, self.thresholds, strict=True):
            values = batch.column(feature.column).to_numpy(zero_copy_only=False)
            if batch.column(feature.column).null_count or np.isnan(values).any():
                raise ValueError(f"a missing value in {feature.column} cannot be in a vector")
            bins.append(
                values.astype("int64")
                if feature.labels is not None
                else np.searchsorted(cuts, values, side="left")
            )
        found = np.empty((len(self.groups), batch.num_rows), self.code_type)
        for row, group in zip(found, self.groups, strict=True):
            row[:] = np.ravel_multi_index([bins[f] for f in group], [self.sizes[f] for f in group])
        return found


@dataclass
class Node:
    count: float = 0.0
    total: float = 0.0
    squares: float = 0.0
    gain: float = 0.0
    feature: int | None = None
    bin: int = 0
    below: bool = True  # of a category: rows without the label go left
    left: int = 0
    right: int = 0

    @property
    def prediction(self) -> float:
        return self.total / self.count

    @property
    def impurity(self) -> float:
        return (self.squares - self.total * self.total / self.count) / self.count

    def goes_left(self, bins: np.ndarray, feature: Feature) -> np.ndarray:
        if feature.labels is None:
            return bins <= self.bin
        return (bins != self.bin) if self.below else (bins == self.bin)


@dataclass
class Tree:
    """Nodes, the root first; they were fitted on `scale` times the errors."""

    nodes: list[Node]
    weight: float
    scale: float


def _routes(layout: Layout, nodes: list[Node]) -> tuple[np.ndarray, np.ndarray]:
    """Per node the group it looks at, and the node after it for each code of that group."""
    groups = np.zeros(len(nodes), "int64")
    after = np.repeat(np.arange(len(nodes)), max(layout.widths)).reshape(len(nodes), -1)
    for at, node in enumerate(nodes):
        if node.feature is not None:
            groups[at], bins = layout.bins_of_codes(node.feature)
            left = node.goes_left(bins, layout.features[node.feature])
            after[at, : len(bins)] = np.where(left, node.left, node.right)
    return groups, after


def _places(codes: np.ndarray, routes: tuple[np.ndarray, np.ndarray], steps: int) -> np.ndarray:
    """The node that each row of a chunk has come to after so many splits."""
    groups, after = routes
    n, width = codes.shape[1], after.shape[1]
    flat, follow, rows = codes.ravel(), after.ravel(), np.arange(codes.shape[1])
    place = np.zeros(n, "int64")
    for _ in range(steps):
        code = flat.take(groups.take(place) * n + rows)
        place = follow.take(place * width + code)
    return place


def _chunk(codes: np.ndarray, errors: np.ndarray, squares: np.ndarray) -> pa.RecordBatch:
    parts = [pa.array([part.tobytes()], pa.binary()) for part in (codes, errors, squares)]
    return pa.RecordBatch.from_arrays(parts, names=["codes", "errors", "squares"])


def _chunks(batches: Iterator[pa.RecordBatch], layout: Layout):
    for batch in batches:
        for codes, errors, squares in zip(*batch.columns, strict=True):
            found = np.frombuffer(codes.as_buffer(), layout.code_type)
            yield (
                found.reshape(len(layout.groups), -1),
                np.frombuffer(errors.as_buffer(), "float64"),
                np.frombuffer(squares.as_buffer(), "float64"),
            )


def _encoded(layout: Layout, label: str):
    """Function over Arrow batches: rows to chunks of codes, whose errors are the labels."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes, errors, held = [], [], 0
        for batch in batches:
            labels = batch.column(label).to_numpy(zero_copy_only=False)
            if batch.column(label).null_count or not np.isfinite(labels).all():
                raise ValueError(f"a label in {label} is missing or no finite number")
            codes.append(layout.codes(batch))
            errors.append(labels)
            held += batch.num_rows
            if held >= CHUNK_ROWS:
                yield _chunk(np.hstack(codes), np.hstack(errors), np.zeros(0))
                codes, errors, held = [], [], 0
        if held:
            yield _chunk(np.hstack(codes), np.hstack(errors), np.zeros(0))

    return encode


def _advanced(layout: Layout, nodes: list[Node], weight: float, steps: int):
    """Function over chunks: the errors that a finished tree leaves, and its leaves' squares."""

    def advance(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        routes = _routes(layout, nodes)
        values = weight * np.array([node.prediction for node in nodes])
        for codes, errors, _ in _chunks(batches, layout):
            place = _places(codes, routes, steps)
            squares = np.bincount(place, weights=errors * errors, minlength=len(nodes))
            yield _chunk(codes, errors - values.take(place), squares)

    return advance


def _counted(layout: Layout, nodes: list[Node], growing: list[int], steps: int):
    """Function over chunks: one row per task, the rows and errors per growing node and bin."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        routes = _routes(layout, nodes)
        slots = np.full(len(nodes), -1)
        slots[growing] = np.arange(len(growing))
        widths = layout.widths
        rows = [np.zeros(len(growing) * width, "int64") for width in widths]
        sums = [np.zeros(len(growing) * width) for width in widths]
        squares, leaves, seen = np.zeros(len(growing)), 0.0, False
        for codes, errors, before in _chunks(batches, layout):
            seen, leaves = True, leaves + before
            slot = slots.take(_places(codes, routes, steps))
            inside = slot >= 0
            if not inside.all():
                codes, errors, slot = codes[:, inside], errors[inside], slot[inside]
            squares += np.bincount(slot, weights=errors * errors, minlength=len(growing))
            for g, width in enumerate(widths):
                cell = slot * width + codes[g]
                rows[g] += np.bincount(cell, minlength=len(rows[g]))
                sums[g] += np.bincount(cell, weights=errors, minlength=len(sums[g]))
        if not seen:
            return
        totals = np.empty((2, len(growing), layout.offsets[-1]))
        for g, group in enumerate(layout.groups):
            shape = [len(growing), *[layout.sizes[f] for f in group]]
            for kind, counted in enumerate((rows, sums)):
                cells = counted[g].reshape(shape)
                for axis, f in enumerate(group, start=1):
                    others = tuple(k for k in range(1, len(shape)) if k != axis)
                    at = layout.offsets[f]
                    totals[kind, :, at : at + layout.sizes[f]] = cells.sum(axis=others)
        parts = [totals.tobytes(), squares.tobytes(), np.asarray(leaves, "float64").tobytes()]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([TaskContext.get().partitionId()], pa.int32()),
                *[pa.array([part], pa.binary()) for part in parts],
            ],
            names=["part", "totals", "squares", "leaves"],
        )

    return count


def _summed(column: pa.ChunkedArray) -> np.ndarray:
    return sum(np.frombuffer(part.as_buffer(), "float64") for part in column)


def _splits(layout: Layout, totals: np.ndarray) -> list[np.ndarray]:
    """All splits of all nodes in the order of the vector: left rows, left sums, column and bin."""
    rows, sums, of, bins = [], [], [], []
    for f, feature in enumerate(layout.features):
        at, last = layout.offsets[f], layout.offsets[f + 1] - 1
        part = totals[:, :, at:last]
        if feature.labels is None:
            part = part.cumsum(axis=2)
        rows.append(part[0])
        sums.append(part[1])
        of.append(np.full(last - at, f))
        bins.append(np.arange(last - at))
    return [np.hstack(parts) for parts in (rows, sums, of, bins)]


def _split(layout: Layout, nodes: list[Node], growing: list[int], totals, params) -> list[int]:
    """Give each node its best split, if one gains; returns the new nodes."""
    rows, sums, of, bins = _splits(layout, totals)
    if not len(of):
        return []
    new, least = [], params.getMinInstancesPerNode()
    for slot, at in enumerate(growing):
        node = nodes[at]
        n, s = rows[slot], sums[slot]
        rest, rest_s = node.count - n, node.total - s
        allowed = (n >= least) & (rest >= least)
        with np.errstate(divide="ignore", invalid="ignore"):
            gain = s * s / n + rest_s * rest_s / rest - node.total * node.total / node.count
        gain = np.where(allowed, gain / node.count, -np.inf)
        best = int(np.argmax(gain))
        if gain[best] <= node.impurity * NO_GAIN or gain[best] < params.getMinInfoGain():
            continue
        node.gain, node.feature, node.bin = float(gain[best]), int(of[best]), int(bins[best])
        sides = [(n[best], s[best]), (rest[best], rest_s[best])]
        if layout.features[node.feature].labels is not None:
            # The lower mean goes left, that of the rows without the label if they are equal.
            node.below = bool(rest_s[best] / rest[best] <= s[best] / n[best])
            sides = sides[::-1] if node.below else sides
        node.left, node.right = len(nodes), len(nodes) + 1
        nodes.extend(Node(float(count), float(total)) for count, total in sides)
        new += [node.left, node.right]
    return new


def _finish(tree: Tree, leaves: np.ndarray) -> None:
    """The squares of the leaves, which are told when the tree is applied."""
    for node, squares in zip(tree.nodes, leaves, strict=True):
        if node.feature is None:
            node.squares = float(squares) * tree.scale**2


def _grow(frame: DataFrame, layout: Layout, params: GBTRegressor, scale: float):
    """One tree on `scale` times the errors; also what the tree before left in its leaves."""
    nodes, growing, before = [Node()], [0], None
    for level in range(max(1, params.getMaxDepth())):
        counting = _counted(layout, nodes, growing, level)
        told = frame.mapInArrow(counting, _TOTALS).toArrow().sort_by("part")
        totals = _summed(told["totals"]).reshape(2, len(growing), -1)
        totals[1] *= scale
        squares = _summed(told["squares"]) * scale * scale
        if level == 0:
            before = _summed(told["leaves"])
            first = totals[:, 0, : layout.sizes[0]].sum(axis=1)
            nodes[0].count, nodes[0].total = map(float, first)
        for at, found in zip(growing, squares, strict=True):
            nodes[at].squares = float(found)
        growing = _split(layout, nodes, growing, totals, params) if params.getMaxDepth() else []
        if not growing:
            break
    return nodes, before


def _from_rdd(frame: DataFrame, java_rdd) -> DataFrame:
    """Rows in the JVM with the columns of `frame`, as a plan without anything below it."""
    spark = frame.sparkSession
    made = spark._jsparkSession.createDataFrame(java_rdd, frame._jdf.schema())
    return ClassicDataFrame(made, spark)


def _cut(frame: DataFrame) -> tuple[DataFrame, str]:
    """The frame read from a checkpoint, and where that lies."""
    saved = frame.checkpoint()
    return saved, saved._jdf.queryExecution().analyzed().rdd().getCheckpointFile().get()


def _boost(frame: DataFrame, layout: Layout, params: GBTRegressor) -> list[Tree]:
    """The trees one after the other. `frame` holds the chunks of the rows."""
    spark, trees, files = frame.sparkSession, [], []
    depth, every = max(1, params.getMaxDepth()), params.getCheckpointInterval()
    # Plans that hold all trees so far take longer to plan than to run, so each frame starts anew.
    kept = older = _from_rdd(frame, frame._jdf.toJavaRDD()).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        for k in range(params.getMaxIter()):
            # The first tree fits the labels, the others the slope of the squared error.
            scale, weight = (1.0, 1.0) if k == 0 else (2.0, params.getStepSize())
            nodes, before = _grow(kept, layout, params, scale)
            if trees:
                _finish(trees[-1], before)
                older.unpersist()
            trees.append(Tree(nodes, weight, scale))
            older, kept = kept, kept.mapInArrow(_advanced(layout, nodes, weight, depth), _CHUNK)
            kept = _from_rdd(kept, kept._jdf.toJavaRDD())
            if k + 1 == params.getMaxIter():
                break
            if every > 0 and (k + 1) % every == 0:
                kept, file = _cut(kept)
                files.append(file)
            kept = kept.persist(StorageLevel.MEMORY_AND_DISK)
        told = kept.mapInArrow(_counted(layout, [Node()], [0], 0), _TOTALS).toArrow()
        _finish(trees[-1], _summed(told.sort_by("part")["leaves"]))
    finally:
        for stored in (older, kept):
            stored.unpersist()
        for file in files:
            delete_folder(spark, file)
    return trees


def _spark_model(
    trees: list[Tree], layout: Layout, params: GBTRegressor, spark: SparkSession
) -> GBTRegressionModel:
    """The trees as a model of Spark."""
    jvm, gateway = spark._jvm, spark.sparkContext._gateway
    last = layout.features[-1]
    slots = last.slot + (1 if last.labels is None else last.labels)
    # Each name below a package is a call of its own, so the names are looked up once.
    package, buffer = jvm.org.apache.spark.ml.tree, jvm.java.nio.ByteBuffer
    leaf, inner = package.LeafNode, package.InternalNode
    cut_at, is_label = package.ContinuousSplit, package.CategoricalSplit
    variance = jvm.org.apache.spark.mllib.tree.impurity.VarianceCalculator
    part_of = jvm.java.util.Arrays.copyOfRange

    def doubles(values: list[float]):
        array = gateway.new_array(jvm.double, len(values))
        buffer.wrap(np.array(values, ">f8").tobytes()).asDoubleBuffer().get(array)
        return array

    sides = {below: doubles([0.0 if below else 1.0]) for below in (True, False)}

    def built(nodes: list[Node], stats, at: int):
        """The node and, if it is a leaf, its prediction."""
        node = nodes[at]
        own = variance(part_of(stats, 3 * at, 3 * at + 3), int(node.count))
        if node.feature is not None:
            left, left_value = built(nodes, stats, node.left)
            right, right_value = built(nodes, stats, node.right)
            # Two leaves that say the same are one.
            if left_value is None or left_value != right_value:
                feature = layout.features[node.feature]
                if feature.labels is None:
                    split = cut_at(feature.slot, float(layout.thresholds[node.feature][node.bin]))
                else:
                    split = is_label(feature.slot + node.bin, sides[node.below], 2)
                return inner(node.prediction, node.impurity, node.gain, left, right, split, own), None
        return leaf(node.prediction, node.impurity, own), node.prediction

    params._transfer_params_to_java()
    regression = jvm.org.apache.spark.ml.regression
    nothing = jvm.org.apache.spark.ml.param.ParamMap.empty()
    made = gateway.new_array(regression.DecisionTreeRegressionModel, len(trees))
    for k, grown in enumerate(trees):
        stats = doubles([x for n in grown.nodes for x in (n.count, n.total, n.squares)])
        one = regression.DecisionTreeRegressionModel(built(grown.nodes, stats, 0)[0], slots)
        made[k] = params._java_obj.copyValues(one, nothing)
    weights = doubles([grown.weight for grown in trees])
    model = regression.GBTRegressionModel(params.uid, made, weights, slots)
    model = params._java_obj.copyValues(model.setParent(params._java_obj), nothing)
    return params._copyValues(params._create_model(model))


def _sampled(rows: DataFrame, columns: list[str], fraction: float, seed: int) -> list[np.ndarray]:
    """The values of each column in the rows that Spark's trainer would look at."""
    jvm, narrow = rows.sparkSession._jvm, rows.select(*columns)
    drawn = jvm.org.apache.spark.util.random.XORShiftRandom(seed).nextInt()
    sample = _from_rdd(narrow, narrow._jdf.toJavaRDD().sample(False, fraction, drawn))
    # About `SPLIT_ROWS` rows, however many there are.
    found = sample.agg(*[F.collect_list(c).alias(c) for c in columns]).first()
    return [np.array(values, "float64") for values in found]


def fit_trees(params: GBTRegressor, stages: list, prepared: DataFrame) -> GBTRegressionModel:
    """`params` fitted on the output of the fitted feature stages, without its vectors."""
    spark = prepared.sparkSession
    ensure_checkpoint_dir(spark)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)
    features, label = vector_features(stages), params.getLabelCol()
    numbers = [f.column for f in features if f.labels is None]
    rows = prepared.select(
        *[F.col(f.column).cast("double" if f.labels is None else "int") for f in features],
        F.col(label).cast("double"),
    ).persist(StorageLevel.DISK_ONLY)
    try:
        n = rows.count()
        if n == 0:
            raise ValueError("no training rows")
        fraction = min(1.0, max(params.getMaxBins() ** 2, SPLIT_ROWS) / n)
        values = dict(zip(numbers, _sampled(rows, numbers, fraction, params.getSeed()), strict=True))
        most = min(params.getMaxBins(), n) - 1
        thresholds = [
            split_points(values[f.column], fraction * n, most) if f.labels is None else np.zeros(0)
            for f in features
        ]
        layout = Layout(features, thresholds)
        # Every task calls Python once a pass, so a core has no more of them than its rows ask for.
        cores = spark.sparkContext.defaultParallelism
        tasks = cores * -(-n // (cores * PARTITION_ROWS))
        chunks = rows.coalesce(tasks).mapInArrow(_encoded(layout, label), _CHUNK)
        trees = _boost(chunks, layout, params)
    finally:
        rows.unpersist()
    return _spark_model(trees, layout, params, spark)
