"""Near-duplicates, repeated strings and repeated passages against brute force."""

import collections
import hashlib
import itertools
import random

import pytest

from cohortlens.llm import anchors, near_dedup, queries, suffixes
from llm_samples import prose

SF = "/root/testdata/sf0.001"


def rows_of(df):
    return [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]


def near_brute(rows, width, percent):
    sets = []
    for _, t in rows:
        w = (t or "").encode().lower().split()
        sets.append(frozenset(tuple(w[k:k + width]) for k in range(len(w) - width + 1)) if len(w) >= width else frozenset([tuple(w)] if w else []))
    top = {i: i for i, _ in rows if i is not None}

    def find(x):
        while top[x] != x:
            x = top[x]
        return x
    keyed = [k for k, (i, _) in enumerate(rows) if i is not None]
    for a, b in itertools.combinations(keyed, 2):
        common = len(sets[a] & sets[b])
        if common and 100 * common >= percent * len(sets[a] | sets[b]):
            x, y = find(rows[a][0]), find(rows[b][0])
            top[max(x, y)] = min(x, y)
    return sets, find


@pytest.mark.parametrize("width", [2, 5])
def test_near_duplicates_equal_brute_force(spark, corpus, width):
    rng = random.Random(width)
    base, rows = [prose(s, 90) for s in range(4)], []
    for k, text in enumerate(base):
        for c in range(12):      # copies around the threshold, so that groups stay partly undecided
            w = text.split()
            for _ in range(rng.randrange(0, 8)):
                w[rng.randrange(len(w))] = "x" + str(rng.randrange(1000))
            rows.append((100 * k + c, " ".join(w)))
    rows += [(900, None), (901, ""), (902, "Two Words"), (903, "two words"), (904, "alone")]
    got = {r.doc_id: r for r in near_dedup.near_duplicates(corpus(rows), width=width).collect()}
    sets, find = near_brute(rows, width, 80)
    assert {i: (r.n_shingles, r.component_id, r.kept) for i, r in got.items()} == {
        i: (len(s), find(i), find(i) == i) for (i, _), s in zip(rows, sets)}


def test_near_duplicates_of_odd_rows(spark, corpus, odd_rows):
    got = near_dedup.near_duplicates(corpus(odd_rows), width=2).collect()
    assert len(got) == len(odd_rows)
    assert {r.component_id for r in got if r.doc_id in (1, 2)} == {1} and all(r.kept for r in got if r.doc_id is None)
    assert near_dedup.near_duplicates(corpus([]), width=2).count() == 0


def test_links_of_every_text_of_an_id(spark, corpus):
    """An id before two texts joins what either links to, also across classes whose smallest ids differ."""
    a, b, c = prose(31, 80), prose(32, 80), prose(33, 80)
    rows = [(5, a), (5, b), (6, a + " x"), (7, b + " y"), (3, c), (5, c), (9, prose(34, 80))]
    got = {(r.doc_id, r.component_id) for r in near_dedup.near_duplicates(corpus(rows), width=2).collect()}
    _, find = near_brute(rows, 2, 80)
    assert got == {(i, find(i)) for i, _ in rows} and (7, 3) in got and (9, 9) in got


def alternating(n):
    """Thue-Morse words of 2**n letters: polynomial hashes modulo 2**64 can't tell such a word from its complement."""
    word = "a"
    for _ in range(n):
        word += word.translate(str.maketrans("ab", "ba"))
    return word, word.translate(str.maketrans("ab", "ba"))


def test_long_repetitive_words_are_told_apart(spark, corpus):
    one, other = alternating(10)
    texts = corpus([(1, f"x {one}"), (2, f"x {other}")])
    assert {r.component_id for r in near_dedup.near_duplicates(texts, width=2).collect()} == {1, 2}
    head = prose(40, 34)
    texts = corpus([(1, f"{head} {one}"), (2, f"{head} {other}")])
    assert {r.n_removed for r in anchors.repeated_words(texts, window=35).collect()} == {0}


def test_min_max_values_of_small_sets_band_alike(spark, corpus):
    rows = [(i, "a b c d e f") for i in range(5)] + [(9, "a b c d e f g")]
    got = {r.doc_id: r.component_id for r in near_dedup.near_duplicates(corpus(rows), width=2).collect()}
    assert set(got.values()) == {0}          # 5 of 6 shingles in common


def strings_brute(rows, width):
    seen, out = collections.Counter(), []
    data = [(t or "").encode() for _, t in rows]
    for b in data:
        seen.update(b[k:k + width] for k in range(len(b) - width + 1))
    for b in data:
        gone = bytearray(len(b))
        for k in range(len(b) - width + 1):
            if seen[b[k:k + width]] > 1:
                gone[k:k + width] = b"\1" * width
        out.append((len(b), sum(gone), len([x for x in bytes(gone).split(b"\0") if x]), bytes(x for x, g in zip(b, gone) if not g)))
    return out


@pytest.mark.parametrize("width, sizes", [(200, (1 << 20, 1 << 20)), (70, (3000, 2000)), (9, (400, 300))])
def test_repeated_strings_equal_brute_force(spark, corpus, odd_rows, width, sizes):
    shared, rng = prose(50, 80), random.Random(3)
    rows = [r for r in odd_rows if r[0] != 7] + [(20 + k, prose(60 + k, 40) + " " + shared[rng.randrange(90):] + " é" * k) for k in range(9)]
    got = suffixes.repeated_bytes(corpus(rows), width=width, group_bytes=sizes[0], bucket_bytes=sizes[1]).collect()
    mine = sorted(((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in got), key=repr)
    assert mine == sorted(((i, *x) for (i, _), x in zip(rows, strings_brute(rows, width))), key=repr)
    assert suffixes.repeated_bytes(corpus([])).count() == 0


@pytest.mark.parametrize("seed", range(6))
def test_suffix_array_and_common_prefixes(seed):
    import numpy as np
    rng = random.Random(seed)
    text = np.array([rng.randrange(1, 3 if seed % 2 else 60) for _ in range(300)], np.uint16)
    order, rank = suffixes.suffix_array(text, len(text))
    whole = text.tolist()
    assert order.tolist() == sorted(range(300), key=lambda i: whole[i:])
    prefix = suffixes.common_prefixes(text, order, rank, np.full(300, 300), 20)
    for k in range(1, 300):
        a, b = whole[order[k - 1]:], whole[order[k]:]
        true = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
        assert prefix[k] == true if true < 20 else prefix[k] >= 20


def words_brute(rows, window):
    seen, out = collections.Counter(), []
    data = [(t or "").encode().split() for _, t in rows]
    for w in data:
        seen.update(tuple(w[k:k + window]) for k in range(len(w) - window + 1))
    for w in data:
        gone = [False] * len(w)
        for k in range(len(w) - window + 1):
            if seen[tuple(w[k:k + window])] > 1:
                gone[k:k + window] = [True] * window
        out.append((len(w), sum(gone), b" ".join(x for x, g in zip(w, gone) if not g).decode()))
    return out


@pytest.mark.parametrize("window, sizes", [(35, (1 << 20, 1 << 20)), (8, (3000, 2000)), (3, (500, 400)), (1, (5000, 5000))])
def test_repeated_passages_equal_brute_force(spark, corpus, odd_rows, window, sizes):
    shared = prose(50, 80).split()
    rows = [r for r in odd_rows if r[0] != 7] + [(20 + k, prose(60 + k, 40) + " " + " ".join(shared[7 * k:])) for k in range(9)]
    got = anchors.repeated_words(corpus(rows), window=window, group_bytes=sizes[0], bucket_bytes=sizes[1]).collect()
    mine = sorted(((r.doc_id, r.n_words, r.n_removed, r.kept_text) for r in got), key=repr)
    assert mine == sorted(((i, *x) for (i, _), x in zip(rows, words_brute(rows, window))), key=repr)
    assert anchors.repeated_words(corpus([])).count() == 0


def test_queries_equal_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = rows_of(docs)
    two = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in queries.op2_suffix_array_dedup(spark, SF).collect()}
    assert two == {i: (*x[:3], hashlib.sha256(x[3]).hexdigest()) for (i, _), x in zip(rows, strings_brute(rows, 200))}
    six = {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in queries.op6_substring_dedup(spark, SF).collect()}
    assert six == {i: (*x[:2], hashlib.sha256(x[2].encode()).hexdigest()) for (i, _), x in zip(rows, words_brute(rows, 35))}
    sets, find = near_brute(rows, 2, 80)
    four = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in queries.op4_minhash_near_dedup(spark, SF).collect()}
    assert four == {i: (len(s), find(i), find(i) == i) for (i, _), s in zip(rows, sets)}


def test_digests_that_agree_in_64_bits_are_told_apart():
    import numpy as np
    highs = [np.array(k, np.uint64) for k in ([9, 5], [5, 9], [12])]
    # The lowest bit says that the list itself holds the string several times.
    for lows, want in ([[4, 2], [8, 4], [3]], [[True, False], [False, True], [True]]), ([[4, 2], [2, 5], [2]], [[True, True], [True, True], [False]]):
        assert [g.tolist() for g in suffixes._elsewhere(highs, [np.array(low, np.uint64) for low in lows])] == want


def test_places_round_trip():
    import numpy as np
    for places in ([], [0], [3, 4, 5, 65_540, 65_541, 200_000, 2_000_000_000], [65_534, 131_069, 196_605]):
        places = np.array(places, np.int64)
        assert suffixes.unpack_places(suffixes.pack_places(places), len(places)).tolist() == places.tolist()
