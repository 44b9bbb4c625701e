import numpy as np
import pytest
from pyspark.sql import functions as F

from stocktide.llm import negatives
from stocktide.llm.negatives import _norms, angle_bounds, hard_negatives, score_bounds

CLASHING = ("rank", "score", "norm", "near", "vector", "is_anchor", "anchor", "place", "angles")


def frame(spark, rows):
    made = spark.createDataFrame(rows, "vec_id bigint, label int, embedding array<double>").repartition(3)
    return made.withColumns({c: F.lit("x") for c in CLASHING})


def usable(v, width):
    return v is not None and len(v) == width and all(x is not None and np.isfinite(x) for x in v)


def expected(rows, every, width):
    whole = [(i, lab, [int(np.floor(256 * x)) for x in v]) for i, lab, v in rows if None not in (i, lab) and usable(v, width)]
    anchors = {(i, lab, tuple(v)) for i, lab, v in whole if i % every == 0}
    out = []
    for i, label, v in anchors:
        scored = sorted((-sum(a * b for a, b in zip(v, x)), j, lab) for j, lab, x in whole if j != i)
        for s, j, _ in [r for r in scored if r[2] == label][:5]:
            fits = [r for r in scored if r[2] != label and 30 * -s <= 100 * -r[0] <= 90 * -s][:10]
            out += [(i, j, n + 1, d, -s, -t) for n, (t, d, _) in enumerate(fits)]
    return sorted(out)


def found(spark, rows, every):
    return sorted(tuple(r) for r in hard_negatives(frame(spark, rows), F.col("vec_id") % every == 0).collect())


@pytest.mark.parametrize("clustered", [False, True])
def test_against_brute_force(spark, monkeypatch, clustered):
    monkeypatch.setattr(negatives, "ANCHOR_BLOCK", 20)
    monkeypatch.setattr(negatives, "GROUP", 64)
    monkeypatch.setattr(negatives, "SAMPLE", 100)
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(6, 8)) * 3
    vectors = [(centres[i % 6] if clustered else 0) + rng.normal(size=8) * (0.3 if clustered else 1) for i in range(700)]
    rows = [(i, int(rng.integers(4)), v.tolist()) for i, v in enumerate(vectors)]
    rows += [(2000 + i, 1, rows[10][2]) for i in range(200)]  # a hot vector: ties go to smaller ids
    rows += [(3000, None, rows[1][2]), (3010, 1, None), (3020, 1, [0.0] * 8), (3030, 2, [None] + [1.0] * 7),
             (3040, 2, [float("nan")] * 8), (3050, 2, [float("inf")] * 8), (3060, 2, [1.0]), (None, 2, rows[2][2]),
             (3070, 2, []), (3080, 9, rows[5][2]), (20, rows[20][1], rows[20][2]), (21, 3, rows[40][2])]
    assert found(spark, rows, 10) == expected(rows, 10, 8)


def test_large_components_are_scored_exactly(spark):
    rng = np.random.default_rng(4)
    rows = [(i, i % 3, (rng.normal(size=4) * 1e5).tolist()) for i in range(120)]
    assert found(spark, rows, 10) == expected(rows, 10, 4)


def test_few_or_no_rows(spark):
    assert found(spark, [], 10) == []
    assert found(spark, [(1, 1, [1.0])], 10) == []
    assert found(spark, [(0, 1, [1.0]), (1, 1, [2.0])], 10) == []
    rows = [(0, 1, [1.0]), (1, 1, [2.0]), (2, 2, [1.0])]
    assert found(spark, rows, 10) == expected(rows, 10, 1) == [(0, 1, 1, 2, 131072, 65536)]


def test_bounds_hold_and_rule_out():
    rng = np.random.default_rng(5)
    points = np.concatenate([rng.normal(size=(300, 6)) * 100, np.zeros((1, 6)), np.eye(6) * 3, rng.normal(size=(1, 6)) * 1e200])
    references = negatives._references(points[:50])
    angles = negatives._angles(points, references).astype(np.float32).astype(float)
    low, high = angle_bounds(angles, angles, angles)
    norms = _norms(points)
    with np.errstate(over="ignore", invalid="ignore"):
        product = norms[:, None] * norms[None]
        scores = points @ points.T
    bottom, top = score_bounds(low, high, product, product)
    fine = np.isfinite(scores)
    assert (bottom[fine] <= scores[fine]).all() and (scores[fine] <= top[fine]).all()
    assert (top[:300, :300] < product[:300, :300] * 0.95).mean() > 0.3


def test_most_pairs_of_clusters_are_never_scored():
    rng = np.random.default_rng(6)
    centres = rng.normal(size=(8, 16)) * 200
    labels = np.repeat(np.arange(8), 200).astype(str).astype(object)
    vectors = np.floor(np.repeat(centres, 200, axis=0) + rng.normal(size=(1600, 16)) * 10)
    references = negatives._references(vectors)
    angles, norms = negatives._angles(vectors, references), _norms(vectors)
    some, n = slice(0, 1600, 100), 16
    asked = (np.arange(1600)[some], labels[some], vectors[some], norms[some], angles[some])
    low, high = (0.3 * norms[some] ** 2)[:, None], (0.9 * norms[some] ** 2)[:, None]
    least = np.full((n, 1), -np.inf)
    best = negatives._Best(negatives._Anchors(*asked, False, True, 10, np.ones((n, 1), bool), low, high, least))
    for at in range(0, 1600, 200):
        part = slice(at, at + 200)
        best.add(np.arange(1600)[part], labels[part], vectors[part], norms[part], angles[part])
    assert best.scored < n * 1400 / 2
    scores = vectors[some] @ vectors.T
    fits = (labels[some, None] != labels[None]) & (scores >= low) & (scores <= high)
    assert {i for i, _ in best.found} == set(np.flatnonzero(fits.any(axis=1)).tolist())
