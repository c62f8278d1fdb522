"""Repeated passages by fixed blocks as anchors: windows of words whose sequence also starts anywhere else.

Reference blocks are cut from every text at multiples of the block's length, without overlap; with blocks of at most
half a window every window holds a whole one. Every rolling window of a block's length is probed against the index of
blocks. Hits are extended: the windows around a hit are compared in full (128 bits of their words) with those around
all other hits, and neighbouring repeated windows grow into maximal repeats.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from cohortlens.llm import exchange
from cohortlens.llm.words import U, rolling, span_hashes, text_bytes, window_starts, word_spans

BUCKET_BYTES = 16 << 20      # text whose probes meet in one bucket
RESULT = "doc_id long, n_words long, n_removed long, n_repeats long, kept_text string"


def block_length(window: int) -> int:
    return (window + 1) // 2


class Group:
    """The texts of a group as word hashes, with its rolling blocks and windows."""

    def __init__(self, table: pa.Table, window: int):
        self.table = exchange.ordered(table)
        self.buf, starts = text_bytes(self.table.column("text"))
        self.first, self.last, self.bounds = word_spans(self.buf, starts)
        self.words = span_hashes(self.buf, self.first, self.last)
        self.window, self.block = window, block_length(window)
        self.n = len(self.words)

    def probes(self, bits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Positions of the rolling blocks, their keys, and whether each is a reference block."""
        at = window_starts(self.bounds, self.block)
        keys = exchange.short(rolling(self.words, self.block)[at], bits) if len(at) else np.empty(0, U)
        text = np.searchsorted(self.bounds, at, "right") - 1
        return at, keys, (at - self.bounds[text]) % self.block == 0

    def candidates(self, hit: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Starts of the windows that hold a rolling block with a hit."""
        starts = window_starts(self.bounds, self.window)
        marks = np.zeros(self.n + 1, np.int64)
        marks[at[hit] + 1] = 1
        before = np.cumsum(marks)
        reach = self.window - self.block
        return starts[before[np.minimum(starts + reach + 1, self.n)] > before[starts]] if len(starts) else starts

    def digests(self, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """128 bits of each window: two rolling hashes with different factors, over independent hashes of the words."""
        if not len(starts):
            return np.empty(0, U), np.empty(0, U)
        other = span_hashes(self.buf, self.first, self.last, 2)
        return rolling(self.words, self.window, 5)[starts], rolling(other, self.window, 9)[starts]


def distinct(keys: np.ndarray, flag: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct keys with a byte each: bit 0, one of its rows has the flag; bit 1, it has several rows."""
    order = np.argsort(keys)
    keys, flag = keys[order], flag[order]
    at = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]]) if len(keys) else np.empty(0, np.int64)
    if not len(at):
        return keys, np.empty(0, np.uint8)
    several = np.diff(np.r_[at, len(keys)]) > 1
    return keys[at], np.maximum.reduceat(flag, at).astype(np.uint8) | (several.astype(np.uint8) << 1)


def _probe_answers(keys: list[np.ndarray], more: list[bytes]) -> list[np.ndarray]:
    """1 for each probe that equals a reference block and has more than one place."""
    all_keys, places = exchange.merged(keys)
    block, rows = np.zeros(len(all_keys), bool), np.zeros(len(all_keys), np.int32)
    for at, bits in zip(places, more):
        bits = np.frombuffer(bits, np.uint8)
        block[at] |= (bits & 1).astype(bool)
        rows[at] += 1 + (bits >> 1)
    good = block & (rows > 1)
    return [np.packbits(good[at]) for at in places]


def _windows(group: Group, answers: pa.Table, buckets: int, bits: int):
    """Candidate windows of a group: starts, and for the distinct ones the key, the rest and the row of each start."""
    at, keys, flag = group.probes(bits)
    known, _ = distinct(keys, flag)
    good = exchange.bits(answers, np.diff(exchange.cuts(known, buckets)))
    hit = good[np.searchsorted(known, keys)] if len(known) else np.empty(0, bool)
    starts = group.candidates(hit, at)
    high, low = group.digests(starts)
    low = low | U(1)
    order = exchange.order_by(high, low)
    h, s = high[order], low[order]
    new = np.r_[True, (h[1:] != h[:-1]) | (s[1:] != s[:-1])] if len(h) else np.empty(0, bool)
    row = np.empty(len(h), np.int64)
    row[order] = np.cumsum(new) - 1
    once = np.bincount(row, minlength=int(new.sum())) == 1
    return starts, h[new], np.where(once, s[new] - U(1), s[new]), row


def covered(n: int, starts: np.ndarray, width: int) -> np.ndarray:
    """Which of n items lie in a window of ``width`` that begins at one of ``starts``."""
    steps = np.bincount(starts, minlength=n + 1) - np.bincount(np.minimum(starts + width, n), minlength=n + 1)
    return np.cumsum(steps[:n]) > 0


def repeated_words(docs: DataFrame, id_column: str = "doc_id", text: str = "text", window: int = 35,
                   group_bytes: int = exchange.GROUP_BYTES, bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """(doc_id, n_words, n_removed, n_repeats, kept_text) for every row.

    A word is removed if a window of ``window`` consecutive words of its text covers it whose sequence also starts
    anywhere else, in the same text or another; windows are judged on the input. ``n_repeats`` counts the maximal removed
    runs and ``kept_text`` joins the other words by one blank. A missing text has no words. Each row counts as a text of its
    own, also when rows repeat an id or have none. Other columns are ignored.
    """
    groups, n_groups = exchange.grouped(docs, id_column, text, group_bytes)
    buckets = max(1, -(-n_groups * group_bytes // bucket_bytes))
    bits = exchange.key_bits(n_groups * group_bytes, 16)    # a false hit costs a comparison of windows and nothing else

    def probe(table: pa.Table) -> pa.Table:
        group = Group(table, window)
        _, keys, flag = group.probes(bits)
        return exchange.ask_rows(table.column("g")[0].as_py(), *distinct(keys, flag), buckets)

    def extend(table: pa.Table, answers: pa.Table) -> pa.Table:
        if not table.num_rows:
            return exchange.ask_rows(0, np.empty(0, U), np.empty(0, U), buckets)
        _, high, low, _ = _windows(Group(table, window), answers, buckets, bits)
        return exchange.ask_rows(table.column("g")[0].as_py(), high, low, buckets)

    def remove(table: pa.Table, answers: pa.Table) -> pa.Table:
        if not table.num_rows:
            return _empty()
        group = Group(table, window)
        kind = answers.column("kind").to_numpy()
        starts, high, _, row = _windows(group, answers.filter(pa.array(kind == 0)), buckets, bits)
        good = exchange.bits(answers.filter(pa.array(kind == 1)), np.diff(exchange.cuts(high, buckets)))
        return _removed(group, starts[good[row]] if len(starts) else starts)

    probes = exchange.answer(groups.groupBy("g").applyInArrow(probe, exchange.ASKED), _probe_answers)
    windows = exchange.answer(
        groups.groupBy("g").cogroup(probes.groupBy("g")).applyInArrow(extend, exchange.ASKED), exchange.several_places)
    both = probes.selectExpr("g", "bucket", "answer", "0 AS kind").union(windows.selectExpr("g", "bucket", "answer", "1 AS kind"))
    return groups.groupBy("g").cogroup(both.groupBy("g")).applyInArrow(remove, RESULT)


def _empty() -> pa.Table:
    return pa.table({"doc_id": pa.array([], pa.int64()), "n_words": pa.array([], pa.int64()), "n_removed": pa.array([], pa.int64()),
                     "n_repeats": pa.array([], pa.int64()), "kept_text": pa.array([], pa.string())})


def _removed(group: Group, starts: np.ndarray) -> pa.Table:
    gone = covered(group.n, starts, group.window)
    begins = gone.copy()
    begins[1:] &= ~gone[:-1]
    begins[group.bounds[:-1][group.bounds[:-1] < group.n]] = gone[group.bounds[:-1][group.bounds[:-1] < group.n]]
    data, texts = group.buf.tobytes(), []
    total, runs = np.r_[0, np.cumsum(gone)], np.r_[0, np.cumsum(begins)]
    for a, z in zip(group.bounds[:-1], group.bounds[1:]):
        if a == z:
            texts.append("")
            continue
        piece = data[group.first[a]:group.last[z - 1]].split()
        if total[z] > total[a]:
            piece = [w for w, g in zip(piece, gone[a:z].tolist()) if not g]
        texts.append(b" ".join(piece).decode())
    a, z = group.bounds[:-1], group.bounds[1:]
    return pa.table({"doc_id": group.table.column("doc_id"), "n_words": pa.array(z - a, pa.int64()),
                     "n_removed": pa.array(total[z] - total[a], pa.int64()), "n_repeats": pa.array(runs[z] - runs[a], pa.int64()),
                     "kept_text": pa.array(texts, pa.string())})
