"""Hard negatives against plain loops, the curve and the zone bounds."""

import itertools
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from cohortlens.llm import negatives

SCHEMA = "vec_id long, label int, vector array<long>, rank string, g int"


def mined(rows, is_anchor, positives=5, wanted=5):
    rows = [r for r in rows if r[1] is not None and r[2] is not None and None not in r[2]]
    dot = lambda a, b: sum(x * y for x, y in itertools.zip_longest(a, b, fillvalue=0))
    first = lambda r: (-r[0], r[1] is None, r[1] or 0)
    out = []
    for k, (i, label, v) in enumerate(rows):
        if not is_anchor(i):
            continue
        scored = [(dot(v, w), j, other) for n, (j, other, w) in enumerate(rows) if n != k]
        for score, j, _ in sorted((s for s in scored if s[2] == label), key=first)[:positives]:
            fit = [s for s in scored if s[2] != label and 80 * score <= 100 * s[0] <= 100 * score]
            out += [(i, j, r, n, score, s) for r, (s, n, _) in enumerate(sorted(fit, key=first)[:wanted], 1)]
    return sorted(out, key=repr)


def found(df):
    return sorted(((r.anchor_id, r.positive_id, r["rank"], r.negative_id, r.positive_score, r.negative_score) for r in df.collect()), key=repr)


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", 3) for r in rows], SCHEMA)


@pytest.mark.parametrize("block, group", [(512, 256), (4, 3)])
def test_negatives_equal_brute_force(spark, block, group):
    rng = random.Random(block)
    centres = [[rng.randrange(-60, 60) for _ in range(12)] for _ in range(6)]
    rows = []
    for i in range(420):
        c = rng.choice(centres)
        rows.append((i, rng.randrange(3), [x + rng.randrange(-25, 25) for x in c]))
    got = found(negatives.hard_negatives(frame(spark, rows), F.col("vec_id") % 14 == 0, block_rows=block, group_anchors=group))
    assert got == mined(rows, lambda i: i % 14 == 0) and len(got) > 300


def test_negatives_of_odd_rows(spark):
    same = [5, 5, 0, 1]
    rows = [(0, 1, same), (0, 1, same), (1, 1, same), (2, 2, same), (3, 2, [5, 4, 0, 1]), (4, None, same), (5, 2, None), (6, 2, [1, None]),
            (None, 2, same), (None, 1, same), (7, 2, [5, 5]), (8, 1, []), (9, 2, []), (10, 1, [-9, -9, 0, 0]), (20, 3, [0, 0, 0, 0]), (7, 2, [5, 5])]
    anchor = F.col("vec_id") % 10 == 0
    want = mined(rows, lambda i: i is not None and i % 10 == 0)
    for block, group in ((512, 256), (2, 1)):
        assert found(negatives.hard_negatives(frame(spark, rows), anchor, block_rows=block, group_anchors=group)) == want
    assert any(r[0] == r[1] == 0 for r in want)           # a copy of an anchor is a positive of it
    assert negatives.hard_negatives(frame(spark, []), anchor).count() == 0
    assert negatives.hard_negatives(frame(spark, rows), F.lit(False)).count() == 0
    assert negatives.hard_negatives(frame(spark, [(0, 1, [])]), anchor).count() == 0


@pytest.mark.parametrize("axes, bits", [(1, 4), (2, 4), (3, 3), (5, 2)])
def test_the_curve_visits_neighbours(axes, bits):
    cells = np.array(list(itertools.product(range(1 << bits), repeat=axes)))
    key = negatives.hilbert(cells, bits)
    assert sorted(key.tolist()) == list(range(len(cells)))
    path = cells[np.argsort(key)]
    assert (np.abs(np.diff(path, axis=0)).sum(axis=1) == 1).all()


def test_bounds_hold_and_rule_blocks_out():
    rng = np.random.default_rng(3)
    anchors = rng.integers(-99, 99, (7, 6))
    block = rng.integers(-20, 90, (30, 6))
    least, most = negatives.limits(anchors, block.min(axis=0)[None], block.max(axis=0)[None])
    scores = negatives.products(anchors, block)
    assert (least[:, 0] <= scores.min(axis=1)).all() and (most[:, 0] >= scores.max(axis=1)).all()
    big = np.array([[1 << 40, 3]])
    assert negatives.products(big, np.array([[5, 1 << 20]])).tolist() == [[5 * (1 << 40) + 3 * (1 << 20)]]
    with pytest.raises(ValueError):
        negatives.products(big, big)


def test_zones_choose_few_blocks_of_clustered_vectors():
    """With clusters far apart, an anchor's windows need a small part of the blocks."""
    rng = random.Random(8)
    rows = []
    for i in range(800):
        c = i % 40
        rows.append((i, rng.randrange(2), [2000 * (c % 8 == d) + 900 * (c // 8 == d - 8) + rng.randrange(20) for d in range(13)]))
    order = np.argsort(negatives.hilbert(np.array([r[2] for r in rows])[:, :10].clip(0, 2047) // 32, 6), kind="stable")
    values, labels = np.array([rows[k][2] for k in order]), np.array([rows[k][1] for k in order])
    blocks = pa.Table.from_pylist([
        {"block": b, "wide": 13, "width": 8, "labels": labels[b * 20:b * 20 + 20].astype("<i8").tobytes(),
         "lo": values[b * 20:b * 20 + 20].min(axis=0).astype("<i8").tobytes(), "hi": values[b * 20:b * 20 + 20].max(axis=0).astype("<i8").tobytes()}
        for b in range(40)])
    scores = values[:1] @ values[:20].T
    groups = pa.Table.from_pylist([{"g": 0, "n": 1, "wide": 13, "width": 8, "labels": labels[:1].astype("<i8").tobytes(),
                                    "floors": np.sort(scores[0])[-8:-7].astype("<i8").tobytes(), "vectors": values[:1].astype("<i8").tobytes()}])
    assert 0 < negatives._choose(negatives._wants_positives)(groups, blocks).num_rows <= 12
