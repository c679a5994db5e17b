"""SimHash near-duplicates by multi-index hashing.

A fingerprint has one bit per position of the 64-bit shingle hashes: whether over half of them
set it. Distinct fingerprints are entered in a table under each of their segments and look
there for the small Hamming ball of each of them; matches are verified over all bits.

Two layouts of that index. `NEAR`: 64 bits in three segments, links at four bits; two such
fingerprints differ in at most one bit of some segment, so no link is lost. `SIMILAR`: links
for a similarity of 0.8 and more. The share of bits in which two fingerprints differ is the
angle between the shingle sets over pi: 0.15 at a similarity of 0.8, some 10 of 64 bits with
a wide spread. So the fingerprint has 256 bits, made from four mixes of every distinct
shingle's hash, ten segments of 16 bits, and matches at 48 bits. By this model it finds pairs of
similarity 0.8 with 0.92 and of 0.85 with 0.99. An exact check of the shingle sets follows, so
that matches of a smaller similarity make no link.

Copies collapse to one fingerprint first. Of the verified matches of a bucket only a forest of
the least distances is kept, which connects the same documents. Buckets above HOT_ROWS are dealt
out in pairs of blocks, each a task of bounded size, so every pair is still compared.

The exact check has two rounds, since a refuted edge of a forest may have displaced a true link.
The first judges the forests. What it leaves open are the matches between components that a
refuted edge touches; the second round looks all of them up and judges each. So the result is
that of the exact check of every match, and only pairs within one component go unjudged.

Defined results: a null text counts as empty; texts without words have fingerprint zero and
link like any other; a text with fewer words than a shingle is one shingle. Each input row
gives one output row, equal rows equal ones. A null id never names a component unless all its
ids are null. Other columns of the input are not carried on, so their names cannot clash.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tiffin.llm.common import mixed, ragged, slices, stored
from tiffin.llm.routing import may_match
from tiffin.llm.components import components

SEED = 42
BITS = 64
STRIDE = np.uint64(0x9E3779B97F4A7C15)  # sets the mixes of a hash apart
HOT_ROWS = 20_000
MAX_HOT = 65_536  # the most buckets that can be hot, which bounds the broadcast
PAIRS_AT_ONCE = 1 << 21
SHINGLES_AT_ONCE = 1 << 16


@dataclass(frozen=True)
class Index:
    """Fingerprints of `words` times 64 bits, their segments and the distance of a link.

    Segments are given as (word, lowest bit, width). With a `similarity`, a repeated shingle
    counts once, and a link needs that share of common shingles among all of both documents.
    """

    words: int
    segments: tuple[tuple[int, int, int], ...]
    radius: int
    distance: int
    similarity: float | None = None

    @property
    def columns(self) -> list[str]:
        return [f"fp{i}" if i else "fp" for i in range(self.words)]


NEAR = Index(1, ((0, 0, 21), (0, 21, 21), (0, 42, 22)), 1, 4)
SIMILAR = Index(4, tuple((i // 4, i % 4 * 16, 16) for i in range(10)), 1, 48, 0.8)


def shingle_hashes(text: bytes, size: int) -> np.ndarray:
    """XXH64 of each run of `size` words joined by blanks, A-Z lower-cased."""
    words = text.lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    joined = b" ".join(words)
    digest = xxhash.xxh64_intdigest
    if len(words) <= size:
        return np.array([digest(joined, SEED)], np.uint64)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[: -size] + 1))
    return np.array(
        [
            digest(joined[a:b], SEED)
            for a, b in zip(starts.tolist(), ends[size - 1 :].tolist(), strict=True)
        ],
        np.uint64,
    )


def fingerprint(hashes: np.ndarray) -> int:
    """Bit by bit whether over half the hashes set it; zero for no hashes."""
    counts = np.zeros(BITS, np.int64)
    for at in range(0, len(hashes), SHINGLES_AT_ONCE):
        part = hashes[at : at + SHINGLES_AT_ONCE].astype(">u8")
        counts += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1).sum(
            axis=0, dtype=np.int32
        )
    return int.from_bytes(np.packbits(2 * counts > len(hashes)).tobytes(), "big", signed=True)


def long_fingerprint(hashes: np.ndarray, index: Index) -> list[int]:
    """The 64 bits of the hashes, then those of further mixes of them."""
    if index.similarity is not None:
        hashes = np.unique(hashes)
    with np.errstate(over="ignore"):
        more = [mixed(hashes + STRIDE * np.uint64(i)) for i in range(1, index.words)]
    return [fingerprint(h) for h in (hashes, *more)]


def fingerprints(
    docs: DataFrame, shingle: int = 4, id_col: str = "doc_id", text_col: str = "text",
    index: Index = NEAR,
) -> DataFrame:
    """(id, fp, ...) per row; each column holds 64 bits of the fingerprint as a signed long."""
    schema = T.StructType(
        [
            T.StructField("id", docs.schema[id_col].dataType),
            *[T.StructField(name, T.LongType(), False) for name in index.columns],
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            texts = batch.column("text").cast(pa.binary()).to_pylist()
            fps = np.array(
                [long_fingerprint(shingle_hashes(t or b"", shingle), index) for t in texts],
                np.int64,
            )
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), *[pa.array(column) for column in fps.T.copy()]],
                ["id", *index.columns],
            )

    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(
        run, schema
    )


def ball(width: int, radius: int) -> np.ndarray:
    """All masks of `width` bits with at most `radius` of them set, the empty one first."""
    found = {0}
    for _ in range(radius):
        found |= {m ^ (1 << b) for m in found for b in range(width)}
    return np.array(sorted(found, key=lambda m: (m.bit_count(), m)), np.uint64)


def entries(fps: np.ndarray, index: Index = NEAR):
    """Arrays (bucket, row, probe): the table entries and the look-ups of rows of fingerprints.

    Of two keys of a segment the larger looks for the smaller; that finds each pair once.
    """
    buckets, owners, probes = [], [], []
    for place, (word, low, width) in enumerate(index.segments):
        key = (fps[:, word] >> np.uint64(low)) & np.uint64((1 << width) - 1)
        for mask in ball(width, index.radius):
            other = key ^ mask
            looks = np.flatnonzero(other < key) if mask else np.arange(len(key))
            buckets.append(other[looks] | np.uint64(place << 32))
            owners.append(looks)
            probes.append(np.full(len(looks), bool(mask)))
    return np.concatenate(buckets), np.concatenate(owners), np.concatenate(probes)


def local_roots(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """The smallest index that each of n items reaches over the links (a, b)."""
    label = np.arange(n)
    while True:
        least = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, a, least)
        np.minimum.at(new, b, least)
        new = new[new]
        if np.array_equal(new, label):
            return label
        label = new


def least_forest(a: np.ndarray, b: np.ndarray, weight: np.ndarray, n: int) -> np.ndarray:
    """The links (a, b) of a forest of least weight that connects n items as all links do."""
    rank = np.empty(len(a), np.int64)
    rank[np.argsort(weight, kind="stable")] = np.arange(len(a))
    label, still, picked = np.arange(n), np.arange(len(a)), []
    while True:
        still = still[label[a[still]] != label[b[still]]]
        if not len(still):
            return np.concatenate(picked) if picked else still
        best = np.full(n, len(a))
        np.minimum.at(best, label[a[still]], rank[still])
        np.minimum.at(best, label[b[still]], rank[still])
        chosen = still[np.isin(rank[still], best)]
        picked.append(chosen)
        label = local_roots(label[a[chosen]], label[b[chosen]], n)[label]


def met_before(left: np.ndarray, right: np.ndarray, place: np.ndarray, index: Index) -> np.ndarray:
    """Whether pairs of fingerprints share a bucket of a segment before `place`."""
    found = np.zeros(len(left), bool)
    for at, (word, low, width) in enumerate(index.segments):
        mask = np.uint64((1 << width) - 1)
        differ = (left[:, word] ^ right[:, word]) >> np.uint64(low) & mask
        found |= (at < place) & (np.bitwise_count(differ) <= index.radius)
    return found


def bucket_links(
    bucket: np.ndarray, fps: np.ndarray, probe: np.ndarray, index: Index,
    label: np.ndarray | None = None, place: np.ndarray | None = None,
):
    """Yield (x, y) row numbers of links within buckets; rows sorted by bucket.

    A forest of the links; with a `label` per row all of them whose labels differ, each only in
    the bucket of the first segment (`place`) that has it.
    """
    order = np.lexsort((probe, bucket))
    bucket, probe = bucket[order], probe[order]
    last = np.flatnonzero(np.append(bucket[1:] != bucket[:-1], True))
    end = np.repeat(last, np.diff(np.concatenate(([-1], last))))
    # Each table entry is compared with what follows it in the bucket.
    first = np.flatnonzero(~probe & (end > np.arange(len(bucket))))
    partners = (end - np.arange(len(bucket)))[first]
    chunk = np.cumsum(partners) // PAIRS_AT_ONCE
    cuts = np.flatnonzero(np.diff(chunk)) + 1
    for rows in np.split(np.arange(len(first)), cuts):
        if not len(rows):
            continue
        left = np.repeat(first[rows], partners[rows])
        right = order[ragged(first[rows] + 1, partners[rows])]
        left = order[left]
        apart = np.zeros(len(left), np.uint16)
        for word in range(fps.shape[1]):
            apart += np.bitwise_count(fps[left, word] ^ fps[right, word])
        close = apart <= index.distance
        if label is not None:
            close &= label[left] != label[right]
        left, right, apart = left[close], right[close], apart[close]
        if label is not None:
            fresh = ~met_before(fps[left], fps[right], place[left], index)
            yield left[fresh], right[fresh]
            continue
        used, inverse = np.unique(np.concatenate((left, right)), return_inverse=True)
        a, b = inverse[: len(left)], inverse[len(left) :]
        kept = least_forest(a, b, apart, len(used))
        yield left[kept], right[kept]


def matrix(rows: pa.RecordBatch | pa.Table, index: Index) -> np.ndarray:
    """The fingerprints of the rows, one column per 64 bits."""
    words = [np.asarray(rows.column(name)).view(np.uint64) for name in index.columns]
    return np.stack(words, axis=1)


def links(
    distinct: DataFrame, index: Index = NEAR, node: str = "fp", label: str | None = None
) -> DataFrame:
    """(x, y): links between values of `node`, which names a fingerprint.

    They connect the same fingerprints as all pairs within the distance that share a bucket do.
    With a column `label` they are all those pairs whose labels differ.
    """
    names = list(dict.fromkeys([node, *index.columns, *([label] if label else [])]))

    def expand(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 4096):
                part = batch.slice(at, 4096)
                bucket, owner, probe = entries(matrix(part, index), index)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(bucket.view(np.int64)), pa.array(probe),
                     *part.take(pa.array(owner)).columns],
                    ["bucket", "probe", *names],
                )

    def match(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def found(parts: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            table = pa.Table.from_batches(parts)
            # Bucket and block are one number here, since only equality counts.
            marks = [np.asarray(table.column(c)) for c in ("bucket", "block")]
            fresh = (marks[0][1:] != marks[0][:-1]) | (marks[1][1:] != marks[1][:-1])
            group = np.concatenate(([0], np.cumsum(fresh)))
            nodes, probe = (np.asarray(table.column(c)) for c in (node, "probe"))
            of, place = (np.asarray(table.column(label)), marks[0] >> 32) if label else (None, None)
            for x, y in bucket_links(group, matrix(table, index), probe, index, of, place):
                if len(x):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(nodes[x]), pa.array(nodes[y])], ["x", "y"]
                    )

        held: list[pa.RecordBatch] = []
        key = None
        for batch in batches:
            if not batch.num_rows:
                continue
            buckets, blocks = (np.asarray(batch.column(c)) for c in ("bucket", "block"))
            if held and key != (buckets[0], blocks[0]):
                yield from found(held)
                held = []
            # The last bucket of a batch may go on in the next one.
            key = (buckets[-1], blocks[-1])
            before = np.flatnonzero((buckets != key[0]) | (blocks != key[1]))
            cut = int(before[-1]) + 1 if len(before) else 0
            if cut:
                yield from found([*held, batch.slice(0, cut)])
                held = []
            held.append(batch.slice(cut))
        if held:
            yield from found(held)

    types = ", ".join(f"{name} long" for name in names)
    rows = distinct.select(*names).mapInArrow(expand, f"bucket long, probe boolean, {types}")
    sizes = rows.groupBy("bucket").agg(F.count("*").alias("n"))
    total = distinct.count() * sum(
        (len(ball(width, index.radius)) + 1) // 2 for _, _, width in index.segments
    )
    hot = stored(
        sizes.where(F.col("n") > max(HOT_ROWS, total // MAX_HOT))
        .withColumn("blocks", F.ceil(F.col("n") / HOT_ROWS).cast("int")).drop("n"),
        "simhash-hot",
    )
    # A row of a hot bucket goes to every pair of blocks that its own block is part of.
    blocks = F.coalesce("blocks", F.lit(1))
    own = F.pmod(F.xxhash64(node), blocks).cast("int")
    others = F.sequence(F.lit(0), blocks - 1)
    dealt = rows.join(F.broadcast(hot), "bucket", "left").withColumn("own", own).select(
        "bucket", "probe", *names,
        F.explode(
            F.transform(others, lambda o: F.least(o, "own") * blocks + F.greatest(o, "own"))
        ).alias("block"),
    )
    keys = ["bucket", "block"]
    return dealt.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(match, "x long, y long")


def ordered(matches: DataFrame) -> DataFrame:
    """The distinct matches (x, y), x being the smaller."""
    return matches.select(F.least("x", "y").alias("x"), F.greatest("x", "y").alias("y")).distinct()


def shingle_sets(
    matches: DataFrame, distinct: DataFrame, docs: DataFrame, shingle: int, index: Index
) -> DataFrame:
    """(number, shingles) of each document in the matches; only their texts are read.

    `distinct` has the fingerprints with their number and a document `least` that has them;
    `docs` has id and text.
    """
    nodes = matches.select(F.col("x").alias("number")).union(matches.select("y"))
    wanted = stored(distinct.join(nodes.distinct(), "number", "left_semi"), "simhash-wanted")

    def shingles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            numbers, sets = [], []
            texts = batch.column("text").cast(pa.binary()).to_pylist()
            expected = matrix(batch, index).view(np.int64).tolist()
            for number, text, words in zip(
                batch.column("number").to_pylist(), texts, expected, strict=True
            ):
                hashes = shingle_hashes(text or b"", shingle)
                # Another text may have the same id.
                if long_fingerprint(hashes, index) == words:
                    numbers.append(number)
                    sets.append(np.unique(hashes).view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [pa.array(numbers, pa.int64()), pa.array(sets, pa.list_(pa.int64()))],
                ["number", "shingles"],
            )

    # Only texts with a match leave the task that reads them.
    read = may_match(docs, F.col("id"), wanted.select("least"), "matched").where("matched")
    texts = read.join(wanted, F.col("id").eqNullSafe(F.col("least"))).select(
        "number", "text", *index.columns
    )
    return texts.mapInArrow(shingles, "number long, shingles array<long>").dropDuplicates(
        ["number"]
    )


def similar(matches: DataFrame, sets: DataFrame, index: Index) -> DataFrame:
    """The matches (x, y) whose documents share shingles to `index.similarity` or more."""
    left = sets.select(F.col("number").alias("x"), F.col("shingles").alias("of_x"))
    right = sets.select(F.col("number").alias("y"), F.col("shingles").alias("of_y"))
    common = F.size(F.array_intersect("of_x", "of_y"))
    both = F.size("of_x") + F.size("of_y") - common
    return (
        matches.join(left, "x").join(right, "y")
        .where(common >= F.lit(index.similarity) * both).select("x", "y")
    )


def similar_links(distinct: DataFrame, docs: DataFrame, shingle: int, index: Index) -> DataFrame:
    """(x, y): links that connect the same documents as all matches of the similarity do."""
    matches = stored(ordered(links(distinct, index, "number")), "simhash-matches")
    sets = stored(shingle_sets(matches, distinct, docs, shingle, index), "simhash-shingles")
    roots = stored(components(similar(matches, sets, index), "x", "y"), "simhash-first")

    def named(name: str) -> DataFrame:
        return roots.select(F.col("node").alias(name), F.col("root").alias(f"{name}_root"))

    # A match between two components lies on a path of forest edges: a refuted one leaves the
    # one component, a refuted one enters the other.
    x_root, y_root = F.coalesce("x_root", "x"), F.coalesce("y_root", "y")
    refuted = matches.join(named("x"), "x", "left").join(named("y"), "y", "left").where(
        x_root != y_root
    )
    touched = stored(
        refuted.select(F.explode(F.array(x_root, y_root)).alias("root")).distinct(),
        "simhash-touched",
    )
    undecided = stored(
        distinct.join(named("number"), "number", "left")
        .withColumn("root", F.coalesce("number_root", "number")).drop("number_root")
        .join(touched, "root", "left_semi"),
        "simhash-undecided",
    )
    rest = stored(
        ordered(links(undecided, index, "number", "root")).join(matches, ["x", "y"], "left_anti"),
        "simhash-rest",
    )
    stars = roots.select(F.col("node").alias("x"), F.col("root").alias("y"))
    return stars.union(similar(rest, sets, index))


def near_duplicates(
    docs: DataFrame, shingle: int = 4, index: Index = NEAR, id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """(id, fp, ..., component_id) per row; the component is named by its smallest id."""
    columns = index.columns
    prints = stored(fingerprints(docs, shingle, id_col, text_col, index), "simhash-prints")
    distinct = prints.groupBy(*columns).agg(F.min("id").alias("least"))
    node = "fp"
    if index.similarity is not None:
        node = "number"  # fixed by writing it
        distinct = distinct.withColumn(node, F.monotonically_increasing_id())
    distinct = stored(distinct, "simhash-distinct")
    if index.similarity is None:
        found = links(distinct, index, node)
    else:
        texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
        found = similar_links(distinct, texts, shingle, index)
    roots = components(found, "x", "y")
    rooted = stored(
        distinct.join(roots, F.col(node) == F.col("node"), "left").select(
            *columns, "least", F.coalesce("root", node).alias("root")
        ),
        "simhash-roots",
    )
    names = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    named = rooted.join(names, "root").select(*columns, "component_id")
    return prints.join(named, columns, "left").select("id", *columns, "component_id")
