"""Personal data: patterns against plain regular expressions, the random field against enumeration, and held-out accuracy."""

import hashlib
import itertools
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings, strategies as st

from cohortlens.llm import personal, personal_examples, queries

SF = "/root/testdata/sf0.001"
# The patterns as they are stated, matched by the standard engine.
STATED = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def passes(kind, text):
    digits = "".join(c for c in text if c in "0123456789")
    if kind == "ip":
        return all(int(x) <= 255 for x in text.split("."))
    if kind == "card":
        total = sum(int(c) if k % 2 == 0 else sum(divmod(2 * int(c), 10)) for k, c in enumerate(reversed(digits)))
        return 12 <= len(digits) <= 19 and total % 10 == 0
    return kind == "email" or 9 <= len(digits) <= 15


def plain(text):
    return sorted((m.start(), k, m.end()) for k, (kind, p) in enumerate(STATED.items()) for m in re.finditer(p, text) if passes(kind, m.group()))


PIECES = st.sampled_from(["a", "x.y", "@", "@a.b", "_", "..", ".", "1", "12", "255", "256", ".1.2.3", "+1", " ", "-", "(", ")", "é", "\n", "4111 1111 1111 1111",
                          "378282246310005", "+1 (743) 555-3824", "0007", "9.9.9.9.9", "b@c.d_e@f.g", ",", "%"])


@settings(max_examples=400, deadline=None)
@given(st.lists(PIECES, max_size=14))
def test_patterns_are_those_stated(pieces):
    text = "".join(pieces)
    assert personal.patterns(text) == plain(text)


def test_patterns_of_long_runs():
    assert personal.patterns("a" * 300_000) == personal.patterns("1." * 2) == []
    assert len(personal.patterns("1" * 200_000 + "@" * 50_000 + "-" * 50_000 + "+" * 50_000)) == 0
    assert personal.patterns("0" * 5_000 + ".0.0.1")[0][1] == 1


def scores_of(labels, emissions, steps):
    path = [0, *labels, 0]
    return sum(e[k] for e, k in zip(emissions, labels)) + sum(steps[a, b] for a, b in itertools.pairwise(path))


@pytest.mark.parametrize("seed", range(4))
def test_decoding_and_marginals_equal_enumeration(seed):
    rng = np.random.default_rng(seed)
    k = 3
    steps, run = rng.normal(size=(k, k)), np.array([0, 0, 0, 1, 2, 2, 3, 3, 3, 3])
    emissions = rng.normal(size=(len(run), k))
    got = personal.best_labels(run, emissions, steps)
    scores, mask, row, place = personal._padded(run, emissions)
    total, chance, counts = personal._marginals(scores, mask, steps)
    want_total, want_chance, want_counts = 0, np.zeros_like(emissions), np.zeros_like(steps)
    for r in range(4):
        at = np.flatnonzero(run == r)
        paths = list(itertools.product(range(k), repeat=len(at)))
        value = np.array([scores_of(p, emissions[at], steps) for p in paths])
        assert tuple(got[at]) == paths[int(value.argmax())]
        weight = np.exp(value)
        want_total += np.log(weight.sum())
        for p, w in zip(paths, weight / weight.sum()):
            for i, label in zip(at, p):
                want_chance[i, label] += w
            for a, b in itertools.pairwise([0, *p, 0]):
                want_counts[a, b] += w
    assert np.isclose(total, want_total) and np.allclose(chance[row, place], want_chance) and np.allclose(counts, want_counts)


def test_runs_alone_decode_as_the_whole_chain(monkeypatch):
    """With words in between fixed to O, decoding the whole text gives what decoding its runs gives."""
    rng = np.random.default_rng(1)
    steps = rng.normal(size=(3, 3))
    emissions = rng.normal(size=(9, 3))
    fixed = np.array([0, 0, 1, 0, 1, 1, 0, 0, 0], bool)
    emissions[fixed] = [0, -1e9, -1e9]
    whole = personal.best_labels(np.zeros(9, np.int64), emissions, steps)
    run = np.array([0, 0, 1, 2, 2, 2])
    assert (whole[~fixed] == personal.best_labels(run, emissions[~fixed], steps)).all()
    monkeypatch.setattr(personal, "PADDED", 3)
    assert (whole[~fixed] == personal.best_labels(run, emissions[~fixed], steps)).all()


def split(text):
    return [(int(a), personal.KINDS.index(k), int(z)) for k, a, z in (s.split(":") for s in text.split(",") if s)]


@pytest.fixture(scope="module")
def model():
    rows = [r for k, r in enumerate(personal_examples.examples()) if zlib.crc32(str(k).encode()) % 4]
    return personal.fit([t for t, _ in rows], [split(s) for _, s in rows])


def test_held_out_accuracy(model):
    rows = [r for k, r in enumerate(personal_examples.examples()) if zlib.crc32(str(k).encode()) % 4 == 0]
    words = personal.Words(pa.array([t for t, _ in rows]))
    found = {}
    for text, *span in personal._tagged(words, model.labels(words)):
        if personal.plausible(span[1], rows[text][0][span[0]:span[2]]):
            found.setdefault(text, set()).add(tuple(span))
    want = [set(split(s)) for _, s in rows]
    right = sum(len(found.get(k, set()) & w) for k, w in enumerate(want))
    assert right >= 0.97 * sum(map(len, want)) and right >= 0.97 * sum(map(len, found.values())) and right > 200


def test_spans_of_texts(spark, corpus, odd_rows, model):
    texts = ["ring (743) 555-3824 now", "Zoë +1 (743) 555-3824, é 10.0.0.300 or 10.0.0.30", "mail josé@müller.de, or a.b@c.org!", "in 2019 we had 42 of 100",
             "user(at)host.com wrote", "visa 4111.1111.1111.1111 x", "host 2001:db8::1f is up", "12:30:45 on 2020-10-11 v1.2.3", "9" * 4000 + " 1" * 4000]
    want = ["phone:5:19:added", "phone:4:21:base,ip:39:48:base", "email:5:19:added,email:24:33:base", "", "email:0:16:added", "card:5:24:added",
            "ip:5:17:added", "", ""]
    rows = [(100 + k, t) for k, t in enumerate(texts)] + odd_rows
    got = personal.personal_data(corpus(rows), model).collect()
    text = lambda r: ",".join(f"{s.kind}:{s.start}:{s.end}:{'base' if s.base else 'added'}" for s in r.spans)
    assert [text(r) for r in sorted((r for r in got if (r.doc_id or 0) >= 100), key=lambda r: r.doc_id)] == want
    assert sorted(((r.doc_id, text(r)) for r in got if (r.doc_id or 0) < 100), key=repr) == sorted(((i, "") for i, _ in odd_rows), key=repr)
    assert personal.personal_data(corpus([]), model).count() == 0


def test_training_rows_may_lack_spans_or_text(spark, corpus):
    schema = "text string, spans string"
    empty = personal.train(spark.createDataFrame([(None, "email:0:3"), ("7 of 8", None), ("9", "")], schema))
    assert not personal.personal_data(corpus([(1, "ring (743) 555-3824")]), empty).first().spans


def test_query_equals_stated_patterns(spark):
    rows = queries.QUERIES["op11_personal_data"](spark, SF).collect()
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    assert len(rows) == len(texts) and sum(r.n_email + r.n_ip + r.n_card + r.n_phone for r in rows) > 20
    for r in rows:
        base = plain(texts[r.doc_id])
        line = ",".join(f"{personal.KINDS[k]}:{a}:{z}" for a, k, z in base)
        assert r.base_sha256 == hashlib.sha256(line.encode()).hexdigest()
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(k == kind for _, k, _ in base) for kind in range(4)]
        assert set(line.split(",")) - {""} <= set(r.spans.split(",")) and len(r.spans.split(",") if r.spans else []) == len(base) + r.n_added
