"""Exact clustering against whole numbers in plain loops."""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pytest

from tiffin.llm import clustering

SCHEMA = "vec_id long, embedding array<double>, id long, cluster int, distance long, number int"


def plain(rows, k=16, rounds=3, dims=64, scale=64):
    def whole(x):
        return math.floor(scale * x) if math.isfinite(scale * x) else int(x) * scale

    kept = [
        (i, v, [whole(x) for x in v]) for i, v in rows
        if v is not None and len(v) == dims and all(x is not None and math.isfinite(x) for x in v)
    ]

    def place(row):
        i = row[0]
        return (i is None, "" if i is None else hashlib.sha256(f"1:{i}".encode()).hexdigest(), row[1])

    centroids = [v for *_, v in sorted(kept, key=place)[:k]]

    def nearest(v):
        gaps = [sum((a - b) ** 2 for a, b in zip(v, c, strict=True)) for c in centroids]
        return gaps.index(min(gaps)), min(gaps)

    for turn in range(rounds + 1):
        found = [nearest(v) for *_, v in kept]
        if turn < rounds:
            for number in range(len(centroids)):
                mine = [v for (*_, v), (c, _) in zip(kept, found, strict=True) if c == number]
                if mine:
                    centroids[number] = [sum(column) // len(mine) for column in zip(*mine, strict=True)]
    out = []
    for (i, *_), (cluster, gap) in zip(kept, found, strict=True):
        of_cluster = sum(g for c, g in found if c == cluster)
        fit = [g if g < 1 << 63 else None for g in (gap, of_cluster, sum(g for _, g in found))]
        out.append((str(i), cluster, *fit, ",".join(map(str, centroids[cluster]))))
    return sorted(out, key=str)


def found(frame, **options):
    return sorted(
        (
            (str(r["id"]), r["cluster"], r["distance"], r["cluster_inertia"], r["inertia"], r["centroid"])
            for r in clustering.clusters(frame, **options).collect()
        ),
        key=str,
    )


def table(spark, rows):
    return spark.createDataFrame([(i, v, 9, 9, 9, 9) for i, v in rows], SCHEMA).repartition(3)


def test_odd_vectors_and_clashing_names(spark):
    chance = np.random.default_rng(4)
    rows = [(i, chance.normal(size=64).tolist()) for i in range(150)]
    rows += [(200, None), (201, [1.0] * 63), (202, [None] + [1.0] * 63), (203, [float("nan")] * 64),
             (204, [float("inf")] * 64), (None, rows[0][1]), (None, rows[1][1]), (7, rows[3][1]),
             (7, rows[7][1]), (205, [0.0] * 64), (206, []), (207, [0.5] * 64), (208, [0.5] * 64)]
    assert found(table(spark, rows)) == plain(rows)


@pytest.mark.parametrize("size", [1e5, 1e9, 1e40, 1e307])
def test_large_components(spark, size):
    """One vector far out, near ties between large ones, and sums beyond 64 bits."""
    chance = np.random.default_rng(8)
    rows = [(i, chance.normal(size=64).tolist()) for i in range(60)]
    rows += [(60 + i, (chance.normal(size=64) * size).clip(-1.7e308, 1.7e308).tolist()) for i in range(4)]
    rows += [(70, [size] * 64), (71, [size * (1 + 1e-15)] * 64)]
    assert found(table(spark, rows)) == plain(rows)


def test_fewer_vectors_than_centroids(spark):
    rows = [(i, [float(i)] * 64) for i in range(5)]
    assert found(table(spark, rows)) == plain(rows)
    assert found(table(spark, [])) == []
    assert found(table(spark, [(1, None)])) == []


def test_other_parameters_and_ties(spark):
    rows = [(i, [float(i % 3), float(i % 5)]) for i in range(40)]
    options = {"k": 4, "rounds": 5, "dims": 2, "scale": 3}
    assert found(table(spark, rows), **options) == plain(rows, **options)


def test_drifts_are_sound_and_less_than_the_full_move():
    chance = np.random.default_rng(1)
    for dims in (2, 5, 64):
        for _ in range(30):
            old = chance.normal(size=(6, dims)) * 10
            new = old + chance.normal(size=(6, dims)) * chance.choice([0.01, 1, 10])
            radius = np.abs(chance.normal(size=6)) * 4
            drifts = clustering.tightened_drifts(old, new, radius)
            full = np.sqrt(((new - old) ** 2).sum(axis=1))
            for i in range(6):
                others = [j for j in range(6) if j != i]
                assert drifts[i] <= max(full[others]) * (1 + 1e-8) + 1e-8
                inside = chance.normal(size=(200, dims))
                inside *= radius[i] / np.sqrt((inside**2).sum(axis=1, keepdims=True))
                inside += old[i]
                for j in others:
                    closer = np.sqrt(((inside - old[j]) ** 2).sum(axis=1)) - np.sqrt(
                        ((inside - new[j]) ** 2).sum(axis=1))
                    assert closer.max() <= drifts[i] + 1e-9


def test_most_vectors_of_clear_clusters_are_not_scanned_again(spark):
    chance = np.random.default_rng(2)
    centres = chance.normal(size=(8, 64)) * 20
    rows = [(i, (centres[i % 8] + chance.normal(size=64) * 0.1).tolist()) for i in range(400)]
    done = clustering.fit(table(spark, rows), k=8)
    assert done.state.where("scanned").count() < 200
    assert found(table(spark, rows), k=8) == plain(rows, k=8)
