"""Ranked search against a plain scorer."""

import collections
import math
import random
import re

import pytest

from cohortlens.llm import search
from llm_samples import prose

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")


def terms(text):
    return TERM.findall("".join(c.lower() if c.isascii() else c for c in text or ""))


def ranked(rows, items, top=20):
    counts = [(i, collections.Counter(terms(t))) for i, t in rows]
    sizes = [sum(c.values()) for _, c in counts]
    n, length = sum(s > 0 for s in sizes), sum(sizes)
    df = collections.Counter(t for _, c in counts for t in c)
    out = []
    for key, text in items:
        scores = []
        for (i, c), size in zip(counts, sizes):
            m = 75 + (25 * size * n) // length if length else 75
            score = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * ((1000000000 * c[t]) // (1000 * c[t] + 12 * m))
                        for t in terms(text) if t in c)
            if score:
                scores.append((-score, i is None, i or 0))
        out += [(key, r, None if missing else i, -s) for r, (s, missing, i) in enumerate(sorted(scores)[:top], 1)]
    return sorted(out, key=repr)


def found(df):
    return sorted(((r.item_id, r.rank, r.doc_id, r.score) for r in df.collect()), key=repr)


def items_of(spark, items):
    return spark.createDataFrame([(i, t, "x", 1) for i, t in items], "item_id long, text string, score string, rank int")


@pytest.mark.parametrize("size", [7, 1 << 14])
def test_ranks_equal_brute_force(spark, corpus, size):
    rng = random.Random(size)
    rows = [(i, prose(i % 60, rng.randrange(1, 120), 60) + " É élan x" + str(rng.randrange(9))) for i in range(150)]
    rows += [(500 + i, rows[3][1]) for i in range(30)]          # ties beyond the last rank
    items = [(k, prose(k, 14, 60) + " Élan x1 x1 X2") for k in range(12)] + [(3, "nothing here 404040"), (90, "x1"), (91, "x1 x1 x2")]
    got = found(search.search(corpus(rows), items_of(spark, items), shard_documents=size))
    assert got == ranked(rows, items) and len(got) > 200


def test_rounds_of_items_and_odd_rows(spark, corpus, odd_rows):
    items = [(1, prose(1, 30)), (1, "no id here"), (None, "one text"), (2, None), (3, ""), (4, " .,- "), (5, "the the one")]
    want = ranked(odd_rows, items)
    assert found(search.search(corpus(odd_rows), items_of(spark, items))) == want
    assert found(search.search(corpus(odd_rows), items_of(spark, items), item_bytes=40)) == want
    assert search.search(corpus([]), items_of(spark, items)).count() == 0
    assert search.search(corpus([(1, None)]), items_of(spark, items)).count() == 0
    assert search.search(corpus(odd_rows), items_of(spark, [])).count() == 0


def test_bounds_of_pairs_hold_and_tighten(spark):
    """No document gains more from a pair than its bound, which lies below the sum of the terms' own maxima."""
    import pyarrow as pa
    rng = random.Random(5)
    rows = [(i, " ".join(["aa"] * rng.randrange(1, 9) + ["bb"] * rng.randrange(9) + ["cc"] * rng.randrange(3) + ["zz"] * 5)) for i in range(200)]
    queries = search.Queries(pa.table({"item_id": [1], "text": ["aa aa bb cc"]}))
    batch = pa.RecordBatch.from_pydict({"doc_id": pa.array([i for i, _ in rows], pa.int64()), "text": [t for _, t in rows]})
    counted = list(search._count(queries)([batch]))
    n, length = (sum(b.column(c)[0].as_py() for b in counted) for c in ("documents", "length"))
    queries.weigh(n, search.np.array([sum(t in x.split() for _, x in rows) // 2 for t in ("aa", "bb", "cc")]))
    row = next(iter(search._build(queries, n, length, 1 << 14)(counted))).to_pylist()[0]
    shard = search.Shard(row, queries)
    tighter = False
    for unit in queries.paired[0]:
        gains = search.np.zeros(len(rows), search.np.int64)
        for t in unit:
            places, impacts = shard.lists[t]
            gains[places] += queries.items[0][t] * impacts
        assert gains.max() <= shard.bound(unit, queries.items[0])
        tighter |= shard.bound(unit, queries.items[0]) < sum(queries.items[0][t] * shard.most[t] for t in unit)
    assert tighter
    best, value = shard.best(0, 0, 20)
    assert (shard.exact(0, search.np.sort(best))[search.np.argsort(search.np.argsort(best))] == value).all()
    assert shard.seeded(0)[-1] <= value[-1] and len(shard.seeded(0)) == 20
