"""Ranked lexical search by MaxScore with bounds of term pairs.

The index is cut by documents. A shard holds, for each term of the query set, the documents that hold it with their impacts
(the term's share of a document's score), and the greatest impact. Terms of an item are paired, the most frequent ones first,
and for each pair the shard keeps what its intersection list has at most: the greatest joint impact, and the documents that reach the
most. A pair's bound is never above the sum of its terms' own maxima, and far below it where the terms are not great in
the same documents; so more of an item's terms together stay below the score that is needed, and documents that hold only such
terms are never looked at.

Scores are whole numbers. With N documents that have a term, L terms in all, n terms of a document, df documents that hold a term
and tf times that a document holds it: w = floor(1000 ln((2N + 2) / (2df + 1))), m = 75 + 25 n N div L, and an impact is
w (1000000000 tf div (1000 tf + 12 m)).
"""

import math
from collections import Counter
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from cohortlens.llm.words import LOWER, slices, span_hashes, text_bytes, word_spans
from cohortlens.plans.staging import stage

TOP = 20
ITEM_BYTES = 8 << 20         # text of the items that are searched at once; more items take more rounds
SHARD_DOCUMENTS = 1 << 14
# A term is a run of ASCII letters, digits and bytes of other characters.
NO_TERM = np.ones(256, bool)
NO_TERM[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = False

COUNTED = ("documents long, length long, ids binary, missing binary, sizes binary, terms binary, places binary, times binary")
SHARD = ("documents long, ids binary, missing binary, terms binary, ends binary, places binary, impacts binary, most binary, "
         "pairs binary, joint binary, seeds binary")
FOUND = "item int, item_id long, doc_id long, score long"


def terms_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The bytes of the texts with A-Z lower-cased, where each term starts and ends, and the first term of each text."""
    buf, starts = text_bytes(column)
    buf = LOWER[buf]
    return buf, *word_spans(buf, starts, NO_TERM)


class Queries:
    """The items of a round: their terms as numbers, and the pairs that bounds are kept for."""

    def __init__(self, table: pa.Table):
        self.ids = table.column("item_id").to_pylist()
        buf, first, last, bounds = terms_of(table.column("text"))
        data = buf.tobytes()
        words = [data[a:z] for a, z in zip(first.tolist(), last.tolist())]
        known = sorted(set(words))
        number = {w: k for k, w in enumerate(known)}
        text = np.frombuffer(b"".join(known), np.uint8)
        ends = np.cumsum([len(w) for w in known], dtype=np.int64)
        starts = ends - [len(w) for w in known] if known else ends
        high, low = (span_hashes(text, starts, ends, seed) for seed in (1, 2))
        order = np.argsort(high)
        self.high, self.low, self.number = high[order], low[order], order.astype(np.int32)
        self.items = [Counter(number[w] for w in words[a:z]) for a, z in zip(bounds[:-1], bounds[1:])]
        self.size = len(known)

    def look_up(self, buf: np.ndarray, first: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which spans are terms of the items, and their numbers; by 128 bits of hash."""
        if not self.size or not len(first):
            return np.empty(0, np.int64), np.empty(0, np.int32)
        hashes = span_hashes(buf, first, last, 1)
        at = np.minimum(np.searchsorted(self.high, hashes), self.size - 1)
        hit = np.flatnonzero(self.high[at] == hashes)
        hit = hit[span_hashes(buf, first[hit], last[hit], 2) == self.low[at[hit]]]
        return hit, self.number[at[hit]]

    def weigh(self, documents: int, frequency: np.ndarray) -> None:
        """The terms' weights, and each item's terms in pairs by ascending weight, so that frequent terms meet."""
        self.weights = np.array([math.floor(1000 * math.log((2 * documents + 2) / (2 * df + 1))) for df in frequency.tolist()], np.int64)
        self.paired = []
        for item in self.items:
            terms = sorted((t for t in item if self.weights[t] and frequency[t]), key=lambda t: (self.weights[t], t))
            self.paired.append([terms[k:k + 2] for k in range(0, len(terms), 2)])
        self.pairs = sorted({tuple(p) for units in self.paired for p in units if len(p) == 2})


def _count(queries: Queries):
    def count(batches):
        for batch in batches:
            for part in slices(batch, "text"):
                buf, first, last, bounds = terms_of(part.column("text"))
                n = np.diff(bounds)
                hit, number = queries.look_up(buf, first, last)
                place = np.repeat(np.arange(len(n)), n)[hit]
                key, times = np.unique(number.astype(np.int64) * max(len(n), 1) + place, return_counts=True)
                ids = part.column("doc_id")
                row = [int(np.count_nonzero(n)), int(n.sum()), ids.fill_null(0).to_numpy().tobytes(),
                       ids.is_null().to_numpy(zero_copy_only=False).tobytes(), n.astype("<i8").tobytes(),
                       (key // max(len(n), 1)).astype("<i4").tobytes(), (key % max(len(n), 1)).astype("<i4").tobytes(), times.astype("<i4").tobytes()]
                yield pa.RecordBatch.from_pylist([dict(zip(_names(COUNTED), row))], schema=_schema(COUNTED))
    return count


def _names(columns: str) -> list[str]:
    return [c.split()[0] for c in columns.split(", ")]


def _schema(columns: str) -> pa.Schema:
    kinds = {"long": pa.int64(), "int": pa.int32(), "binary": pa.binary()}
    return pa.schema([(name, kinds[kind]) for name, kind in (c.split() for c in columns.split(", "))])


def _document_frequencies(batches, size: int):
    total = np.zeros(size, np.int64)
    for batch in batches:
        for terms in batch.column("terms").to_pylist():
            total += np.bincount(np.frombuffer(terms, "<i4"), minlength=size)
    held = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(held, pa.int64()), pa.array(total[held])], ["term", "df"])


def _build(queries: Queries, documents: int, length: int, shard_documents: int):
    """Shards from counted slices, as many to a shard as hold ``shard_documents`` documents."""
    def shard(rows: list[dict]):
        column = lambda name, kind: [np.frombuffer(r[name], kind) for r in rows]
        sizes, places = column("sizes", "<i8"), column("places", "<i4")
        before = np.cumsum([0, *[len(s) for s in sizes]])
        place = np.concatenate([p + b for p, b in zip(places, before)]).astype(np.int64)
        term, times = np.concatenate(column("terms", "<i4")), np.concatenate(column("times", "<i4")).astype(np.int64)
        order = np.argsort(term, kind="stable")       # slices come in order, so documents ascend within a term
        term, place, times = term[order], place[order], times[order]
        slow = 75 + (25 * np.concatenate(sizes) * documents) // length
        impact = queries.weights[term] * ((1_000_000_000 * times) // (1000 * times + 12 * slow[place]))
        held, starts = np.unique(term, return_index=True)
        ends = np.r_[starts[1:], len(term)]
        lists = {int(t): (place[a:z], impact[a:z]) for t, a, z in zip(held, starts, ends)}
        pairs, joint, seeds = [], [], []
        for k, (one, other) in enumerate(queries.pairs):
            if one not in lists or other not in lists:
                continue
            both, i, j = np.intersect1d(lists[one][0], lists[other][0], assume_unique=True, return_indices=True)
            if len(both):
                sums = lists[one][1][i] + lists[other][1][j]
                best = both[np.argsort(-sums, kind="stable")[:TOP]]
                pairs.append(k)
                joint.append(sums.max())
                seeds.append(np.pad(best, (0, TOP - len(best)), constant_values=-1))
        most = np.maximum.reduceat(impact, starts) if len(held) else impact
        values = [int(before[-1]), b"".join(r["ids"] for r in rows), b"".join(r["missing"] for r in rows), held.astype("<i4").tobytes(),
                  ends.astype("<i8").tobytes(), place.astype("<i4").tobytes(), impact.tobytes(), most.tobytes(),
                  np.array(pairs, "<i4").tobytes(), np.array(joint, "<i8").tobytes(), np.array(seeds, "<i4").tobytes()]
        return pa.RecordBatch.from_pylist([dict(zip(_names(SHARD), values))], schema=_schema(SHARD))

    def build(batches):
        rows, held = [], 0
        for batch in batches:
            for i in range(batch.num_rows):
                rows.append(batch.slice(i, 1).to_pylist()[0])
                held += len(rows[-1]["missing"])
                if held >= shard_documents:
                    yield shard(rows)
                    rows, held = [], 0
        if rows:
            yield shard(rows)
    return build


class Shard:
    """One shard of the index, searched item by item."""

    def __init__(self, row: dict, queries: Queries):
        get = lambda name, kind: np.frombuffer(row[name], kind)
        self.queries, self.documents = queries, row["documents"]
        self.ids, self.missing = get("ids", "<i8"), get("missing", bool)
        ends, places, impacts, most = get("ends", "<i8"), get("places", "<i4"), get("impacts", "<i8"), get("most", "<i8")
        self.lists, self.most = {}, {}
        for t, a, z, m in zip(get("terms", "<i4").tolist(), np.r_[0, ends[:-1]].tolist(), ends.tolist(), most.tolist()):
            self.lists[t], self.most[t] = (places[a:z], impacts[a:z]), m
        pairs = [queries.pairs[k] for k in get("pairs", "<i4").tolist()]
        self.joint = dict(zip(pairs, get("joint", "<i8").tolist()))
        self.seeds = dict(zip(pairs, get("seeds", "<i4").reshape(len(pairs), TOP)))
        self.scores = np.zeros(self.documents, np.int64)

    def bound(self, unit: list[int], wanted: Counter) -> int:
        """The most that a document can gain from a term, or from a pair of terms, by what both reach together."""
        alone = [wanted[t] * self.most.get(t, 0) for t in unit]
        if len(unit) == 1:
            return alone[0]
        joint = self.joint.get(tuple(unit))
        if joint is None:          # no document holds both
            return max(alone)
        times = min(wanted[t] for t in unit)
        together = times * joint + sum((wanted[t] - times) * self.most[t] for t in unit)
        return min(sum(alone), max(together, *alone))

    def exact(self, item: int, documents: np.ndarray) -> np.ndarray:
        """The scores of a few documents, given in ascending order."""
        out = np.zeros(len(documents), np.int64)
        for t, times in self.queries.items[item].items():
            if t in self.lists:
                self._add(out, documents, t, times)
        return out

    def _add(self, out: np.ndarray, documents: np.ndarray, term: int, times: int) -> None:
        places, impacts = self.lists[term]
        at = np.minimum(np.searchsorted(places, documents), len(places) - 1)
        out += np.where(places[at] == documents, times * impacts[at], 0)

    def seeded(self, item: int) -> np.ndarray:
        """Exact scores of the documents that lead the intersection lists of the item's pairs: below them a search need not look."""
        leading = [self.seeds[tuple(u)] for u in self.queries.paired[item] if tuple(u) in self.seeds]
        if not leading:
            return np.empty(0, np.int64)
        documents = np.unique(np.concatenate(leading))
        scores = self.exact(item, documents[documents >= 0])
        return -np.sort(-scores[scores > 0])[:TOP]

    def best(self, item: int, floor: int, top: int) -> tuple[np.ndarray, np.ndarray]:
        """The documents of the shard that may be among the ``top``, and their scores; ``floor`` is a score that so many reach."""
        wanted = self.queries.items[item]
        units = [([t for t in u if t in self.lists], self.bound(u, wanted)) for u in self.queries.paired[item]]
        units = sorted((u for u in units if u[0]), key=lambda u: u[1])
        reach = np.cumsum([0, *[b for _, b in units]])            # what the first units can give together
        scores = self.scores
        scores[:] = 0
        left = len(units)
        while left and reach[left] >= max(floor, 1):              # essential units: any document of theirs may do
            left -= 1
            for t in units[left][0]:
                places, impacts = self.lists[t]
                scores[places] += wanted[t] * impacts
        found = np.flatnonzero(scores)
        value = scores[found]
        while True:
            if len(value) > top:                                  # partial scores are never too high
                floor = max(floor, int(np.partition(value, -top)[-top]))
            keep = value + reach[left] >= floor
            if not keep.all():
                found, value = found[keep], value[keep]
            if not left or not len(found):
                break
            left -= 1
            for t in units[left][0]:
                self._add(value, found, t, wanted[t])
        order = np.lexsort((self.ids[found], self.missing[found], -value))[:top]
        return found[order], value[order]


def _search(queries: Queries, floors: dict[int, int], top: int):
    def search(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                shard = Shard(batch.slice(i, 1).to_pylist()[0], queries)
                for item, key in enumerate(queries.ids):
                    found, value = shard.best(item, floors.get(item, 0), top)
                    if len(found):
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(np.full(len(found), item, np.int32)), pa.array([key] * len(found), pa.int64()),
                             pa.array(shard.ids[found], mask=shard.missing[found]), pa.array(value)], ["item", "item_id", "doc_id", "score"])
    return search


def _seed(queries: Queries):
    def seed(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                shard = Shard(batch.slice(i, 1).to_pylist()[0], queries)
                for item in range(len(queries.ids)):
                    scores = shard.seeded(item)
                    if len(scores):
                        yield pa.RecordBatch.from_arrays([pa.array(np.full(len(scores), item, np.int32)), pa.array(scores)], ["item", "score"])
    return seed


def _ranked(found: DataFrame, top: int) -> DataFrame:
    by = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return found.withColumn("rank", F.row_number().over(by)).where(F.col("rank") <= top)


def _round(docs: DataFrame, items: DataFrame, top: int, shard_documents: int) -> DataFrame:
    queries = Queries(items.toArrow())
    counted = stage(docs.mapInArrow(_count(queries), COUNTED), "counts")
    documents, length = counted.agg(F.coalesce(F.sum("documents"), F.lit(0)), F.coalesce(F.sum("length"), F.lit(0))).first()
    frequency, size = np.zeros(queries.size, np.int64), queries.size
    if documents and size:
        held = (counted.select("terms").mapInArrow(lambda b: _document_frequencies(b, size), "term long, df long")
                .groupBy("term").agg(F.sum("df").alias("df")).toArrow())       # at most one row for each term of the items
        frequency[held.column("term").to_numpy()] = held.column("df").to_numpy()
    queries.weigh(documents, frequency)
    index = stage(counted.mapInArrow(_build(queries, documents, max(length, 1), shard_documents), SHARD), "index")
    by = Window.partitionBy("item").orderBy(F.desc("score"))
    seeds = (index.mapInArrow(_seed(queries), "item int, score long").withColumn("rank", F.row_number().over(by))
             .where(F.col("rank") <= top).groupBy("item").agg(F.count(F.lit(1)).alias("n"), F.min("score").alias("score"))
             .where(F.col("n") == top).toArrow())                              # at most one row for each item
    floors = dict(zip(seeds.column("item").to_pylist(), seeds.column("score").to_pylist()))
    return _ranked(index.mapInArrow(_search(queries, floors, top), FOUND), top).select("item_id", "rank", "doc_id", "score")


def search(docs: DataFrame, items: DataFrame, id_column: str = "doc_id", text: str = "text", item_column: str = "item_id",
           item_text: str = "text", top: int = TOP, item_bytes: int = ITEM_BYTES, shard_documents: int = SHARD_DOCUMENTS) -> DataFrame:
    """(item_id, rank, doc_id, score): the ``top`` documents of each item by score, of those with a score above 0.

    Equal scores rank by ascending id, a missing id last; rows that repeat an id are documents of their own. Items are rows too: one that
    repeats an id, or has none, is ranked by itself. A missing or empty text has no terms, so a document is never found and counts
    nowhere, and an item finds nothing. Empty tables give no rows. Other columns are ignored.

    ``top`` is at most 20, the number of leading documents that the index keeps of a pair.
    """
    if not 0 < top <= TOP:
        raise ValueError(f"top must be 1 to {TOP}")
    rows = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    asked = items.select(F.col(item_column).cast("long").alias("item_id"), F.col(item_text).cast("string").alias("text"))
    size = asked.agg(F.coalesce(F.sum(F.octet_length("text") + 16), F.lit(0))).first()[0]
    rounds = max(1, -(-size // item_bytes))
    dealt = F.pmod(F.xxhash64("item_id", "text"), F.lit(rounds))
    found = [_round(rows, asked.where(dealt == r), top, shard_documents) for r in range(rounds)]
    return reduce(DataFrame.unionByName, found)
