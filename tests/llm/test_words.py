import numpy as np
import pyarrow as pa
from hypothesis import given, strategies as st

from cohortlens.llm import exchange
from cohortlens.llm.words import rolling, slices, text_bytes, window_starts, words

TEXTS = st.lists(st.one_of(st.none(), st.text("ab é\n\t", max_size=30)), max_size=8)


@given(TEXTS)
def test_words_are_those_of_split(texts):
    hashes, bounds = words(pa.array(texts, pa.string()))
    plain = [(t or "").encode().split() for t in texts]
    assert np.diff(bounds).tolist() == [len(p) for p in plain]
    flat = [w for p in plain for w in p]
    assert len({(h, w) for h, w in zip(hashes.tolist(), flat)}) == len(set(hashes.tolist())) == len(set(flat))


@given(TEXTS, st.integers(1, 40))
def test_slices_keep_all_rows(texts, limit):
    batch = pa.RecordBatch.from_arrays([pa.array(texts, pa.string())], ["text"])
    assert [t for part in slices(batch, "text", limit) for t in part.column(0).to_pylist()] == texts
    buf, starts = text_bytes(batch.column(0))
    assert [bytes(buf[a:b]).decode() for a, b in zip(starts[:-1], starts[1:])] == [t or "" for t in texts]


@given(st.lists(st.integers(0, 2), max_size=40), st.integers(1, 12))
def test_rolling_hashes_tell_windows_apart(codes, width):
    array = np.array(codes, np.uint64)
    got = rolling(array, width).tolist()
    windows = [tuple(codes[i:i + width]) for i in range(len(codes) - width + 1)]
    assert len(got) == len(windows) and len(set(zip(got, windows))) == len(set(got)) == len(set(windows))
    assert window_starts(np.array([0, len(codes)]), width).tolist() == list(range(len(windows)))


@given(st.lists(st.integers(0, 2 ** 64 - 1), min_size=1, max_size=20), st.integers(0, 40), st.integers(1, 7))
def test_packing_round_trip(values, zeros, buckets):
    keys = np.unique(np.array(values, np.uint64) >> np.uint64(zeros) << np.uint64(zeros))
    assert (exchange.unpack(exchange.pack(keys)) == keys).all()
    at = exchange.cuts(keys, buckets)
    assert at[0] == 0 and at[-1] == len(keys) and len(at) == buckets + 1 and (np.diff(at) >= 0).all()
    counts = keys.astype(np.int64) & 0x3FF
    assert (exchange.widen(exchange.narrow(counts), len(counts)) == counts).all()
