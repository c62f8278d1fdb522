"""Language-model scores by stupid backoff, from n-gram counts of the whole corpus.

Count tables are partitioned by the hash of the n-gram. The n-grams of all texts are joined to them group by group (see
``exchange``), each distinct n-gram of a group once, and the scores of the words are summed up per document. A
document is scored by the counts of all other documents: its own are taken off, so a text does not predict itself.

    S(w | context) = count(context w) / count(context)   if that n-gram occurs elsewhere,
                   = 0.4 * S(w | shorter context)        otherwise,

down to count(w) / N, or 1 / (N + 1) for a word that occurs nowhere else.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from cohortlens.llm import exchange
from cohortlens.llm.words import U, mix, words

ORDER = 3
BACKOFF = 0.4
BUCKET_BYTES = 12 << 20      # text whose n-grams meet in one bucket
RESULT = "doc_id long, n_words long, log_score double, mean_log_score double, backed_off long, unseen long"


class Grams:
    """The n-grams of a group: for each order the key at each word that ends one, and -1 texts for none."""

    def __init__(self, table: pa.Table, order: int, bits: int):
        self.table = exchange.ordered(table)
        codes, self.bounds = words(self.table.column("text"), lower=True)
        n = len(codes)
        self.text = np.repeat(np.arange(len(self.bounds) - 1), np.diff(self.bounds))
        place = np.arange(n) - self.bounds[:-1][self.text] if n else np.empty(0, np.int64)
        self.keys, self.ends = [], []
        gram = codes
        for k in range(order):
            if k:
                gram = mix(gram[:-1] * U(0xD6E8FEB86659FD93) + codes[k:] + U(k)) if len(gram) > 1 else gram[:0]
            ends = np.flatnonzero(place >= k)
            self.ends.append(ends)
            self.keys.append(exchange.short(gram[ends - k] if len(ends) else gram[:0], bits))
        self.root = exchange.short(mix(np.array([1], U)), bits)     # the n-gram of no words, which every word ends

    def counts(self) -> tuple[np.ndarray, np.ndarray]:
        """All distinct n-grams of the group, sorted, and how often it holds each."""
        keys = np.concatenate([np.repeat(self.root, len(self.keys[0])), *self.keys])
        keys.sort()
        at = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]]) if len(keys) else np.empty(0, np.int64)
        return keys[at], np.diff(np.r_[at, len(keys)])

    def elsewhere(self, known: np.ndarray, totals: np.ndarray) -> list[np.ndarray]:
        """For each order from 0 on, how often other documents hold the n-gram that ends at each word (0 if none does)."""
        n, sizes = len(self.text), np.diff(self.bounds)
        total = int(totals[np.searchsorted(known, self.root[0])]) if n else 0
        out = [total - sizes[self.text]]
        for keys, ends in zip(self.keys, self.ends):
            here = np.zeros(n, np.int64)
            if len(ends):
                row = np.searchsorted(known, keys)
                own = (self.text[ends] << 32) | row          # a group holds fewer than 2**31 texts and n-grams
                order = np.argsort(own)
                at = np.flatnonzero(np.r_[True, np.diff(own[order]) != 0])
                count = np.diff(np.r_[at, len(own)])
                mine = np.empty(len(own), np.int64)
                mine[order] = np.repeat(count, count)
                here[ends] = totals[row] - mine
            out.append(here)
        return out


def word_scores(counts: list[np.ndarray], place: np.ndarray, backoff: float) -> tuple[np.ndarray, np.ndarray]:
    """The log score of each word and the order of the n-gram that gave it, 0 for a word seen nowhere else.

    ``counts[k]`` is the count of the k words up to and with this one; a context is the k - 1 words before it.
    """
    n, order = len(place), len(counts) - 1
    level, score = np.zeros(n, np.int64), -np.log(counts[0] + 1.0)
    for k in range(1, order + 1):
        seen = np.flatnonzero((counts[k] > 0) & (place >= k - 1))
        context = counts[0][seen] if k == 1 else counts[k - 1][seen - 1]
        score[seen] = np.log(counts[k][seen] / np.maximum(context, 1))
        level[seen] = k
    longest = np.minimum(place + 1, order)                    # the longest n-gram that the text allows here
    return score + np.log(backoff) * (longest - np.maximum(level, 1)), level


def _totals(keys: list[np.ndarray], more: list[bytes]) -> list[bytes]:
    counts = [exchange.widen(m, len(k)) for k, m in zip(keys, more)]
    known, places = exchange.merged(keys)
    totals = np.zeros(len(known), np.int64)
    for at, n in zip(places, counts):
        totals[at] += n
    return [exchange.narrow(totals[at]) for at in places]      # most counts are small


def _read(answers: pa.Table, sizes: np.ndarray) -> np.ndarray:
    parts = [exchange.widen(a, n)
             for a, n in zip(answers.sort_by("bucket").column("answer").to_pylist(), [n for n in sizes if n])]
    return np.concatenate([*parts, np.empty(0, np.int64)])


def scores(docs: DataFrame, id_column: str = "doc_id", text: str = "text", order: int = ORDER, backoff: float = BACKOFF,
           group_bytes: int = exchange.GROUP_BYTES, bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """(doc_id, n_words, log_score, mean_log_score, backed_off, unseen) for every row.

    Words are lower-cased (A-Z). ``log_score`` sums the natural logarithms of the words' scores, the mean divides by
    the words, ``backed_off`` counts the words scored by a shorter n-gram than their place allows and ``unseen`` those
    that no other document holds. A missing or empty text has no words, a log score of 0 and no mean. Rows that repeat an id
    or a text are documents of their own and predict each other. Other columns are ignored.
    """
    groups, n_groups = exchange.grouped(docs, id_column, text, group_bytes)
    buckets = max(1, -(-n_groups * group_bytes // bucket_bytes))
    bits = exchange.key_bits(n_groups * group_bytes, 18)

    def ask(table: pa.Table) -> pa.Table:
        return exchange.ask_rows(table.column("g")[0].as_py(), *Grams(table, order, bits).counts(), buckets, exchange.narrow)

    def score(table: pa.Table, answers: pa.Table) -> pa.Table:
        grams = Grams(table, order, bits)
        known, _ = grams.counts()
        totals = _read(answers, np.diff(exchange.cuts(known, buckets)))
        a, z = grams.bounds[:-1], grams.bounds[1:]
        n = len(grams.text)
        place = np.arange(n) - a[grams.text] if n else np.empty(0, np.int64)
        value, level = word_scores(grams.elsewhere(known, totals), place, backoff)
        sums = lambda x: np.array([x[i:k].sum() for i, k in zip(a, z)])
        log, size = sums(value).astype(float), z - a
        short = level < np.minimum(place + 1, order)
        return pa.table({
            "doc_id": grams.table.column("doc_id"), "n_words": pa.array(size, pa.int64()), "log_score": pa.array(log, pa.float64()),
            "mean_log_score": pa.array(log / np.maximum(size, 1), pa.float64(), mask=size == 0),
            "backed_off": pa.array(sums(short), pa.int64()), "unseen": pa.array(sums(level == 0), pa.int64())})

    totals = exchange.answer(groups.groupBy("g").applyInArrow(ask, exchange.ASKED), _totals)
    return groups.groupBy("g").cogroup(totals.groupBy("g")).applyInArrow(score, RESULT)
