"""Benchmark decontamination by the q-gram lemma.

Texts are compared after two changes that keep the length: A-Z becomes lower case and white space becomes a blank.
An occurrence of an item of m characters with at most k edits shares at least m - q + 1 - k * q of the item's
q-grams with the text, on diagonals that lie within k of each other. Shared q-grams are therefore counted in
bands of 2 * (k + 1) diagonals that overlap by half; bands that reach the bound are aligned.

An item of fewer than q characters allows no edit and is found as it stands, not inside a longer word: a letter or digit at its
end must not touch another one (letters are those of Latin scripts here, as others often go without blanks).
"""

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from cohortlens.llm.words import U, mix, slices
from cohortlens.plans.sizing import measured_bytes
from cohortlens.plans.staging import stage

GRAM = 8
EDIT_RATE = 0.08                 # edits allowed per character of an item
CHUNK_BYTES = 16 << 20           # of benchmark text held by a task at once; a larger benchmark takes several passes
TABLE_BITS = 22
CELLS = 1 << 22                  # texts times items that are counted at once
ENTRIES = 1 << 21                # shared q-grams held at once, however many items hold the same
RESULT = "doc_id long, item_id long, start long, end long, edits int"


def code_points(text: str) -> np.ndarray:
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    small = points < 0x80
    out = np.where(small & (points >= 65) & (points <= 90), points + 32, points)
    return np.where((points >= 9) & (points <= 13), 32, out).astype(np.uint32)


def grams(points: np.ndarray, q: int = GRAM) -> np.ndarray:
    """A 64-bit hash of each run of q characters (q is a power of two)."""
    h, span = points.astype(U) * U(0x9E3779B97F4A7C15), 1
    while span < q:
        h = h[:-span] * U(0xD6E8FEB86659FD93) + h[span:] if len(h) > span else h[:0]
        h ^= h >> U(31)
        span *= 2
    return mix(h)


def budget(m: int, q: int, rate: float) -> int:
    """The edits allowed in an item of m characters; small items get fewer, so that one shared q-gram is still asked for."""
    return max(0, min(int(rate * m), (m - q) // q))


def runs_of(points: np.ndarray, m: int) -> np.ndarray:
    """A 64-bit hash of each run of m characters."""
    n = max(0, len(points) - m + 1)
    h = np.zeros(n, U)
    for k in range(m):
        h = mix(h + points[k:k + n].astype(U) + U(1))
    return h


def of_word(points: np.ndarray) -> np.ndarray:
    """Which characters are digits or letters of Latin scripts (A-Z are lower case already)."""
    digit, ascii_, more = (points >= 48) & (points <= 57), (points >= 97) & (points <= 122), (points >= 0xC0) & (points < 0x250)
    return digit | ascii_ | (more & (points != 0xD7) & (points != 0xF7))


@dataclass
class Index:
    """The q-grams of a bounded set of items, and the whole of items that are shorter."""
    ids: list[int | None]
    texts: list[np.ndarray]
    edits: np.ndarray
    least: np.ndarray        # shared q-grams that an occurrence must have
    keys: np.ndarray         # sorted q-gram hashes; item and position of each
    item: np.ndarray
    at: np.ndarray
    known: np.ndarray        # a table that rules out most q-grams of a text
    short: dict[int, tuple[np.ndarray, np.ndarray]]      # by length: sorted hashes of short items, and the items

    @property
    def longest(self) -> int:
        return max(map(len, self.texts), default=0)

    @classmethod
    def of(cls, rows: list[tuple[int | None, str | None]], q: int, rate: float) -> "Index":
        rows = [(i, p) for i, p in ((i, code_points(t or "")) for i, t in rows) if (p != 32).any()]
        sizes = np.array([len(p) for _, p in rows], np.int64)
        edits = np.array([budget(m, q, rate) for m in sizes], np.int64)
        hashes = [grams(p, q) for _, p in rows]
        keys = np.concatenate([*hashes, np.empty(0, U)])
        order = np.argsort(keys, kind="stable")
        item = np.repeat(np.arange(len(rows)), [len(h) for h in hashes])[order]
        at = np.concatenate([*(np.arange(len(h)) for h in hashes), np.empty(0, np.int64)]).astype(np.int64)[order]
        known = np.zeros(1 << TABLE_BITS, bool)
        known[keys >> U(64 - TABLE_BITS)] = True
        short = {}
        for m in set(sizes[sizes < q].tolist()):
            its = np.flatnonzero(sizes == m)
            whole = np.concatenate([runs_of(rows[i][1], m) for i in its])
            by = np.argsort(whole, kind="stable")
            short[m] = whole[by], its[by]
        return cls([i for i, _ in rows], [p for _, p in rows], edits, sizes - q + 1 - edits * q, keys[order], item, at, known, short)

    def hits(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Positions in the text whose q-gram the index holds, the first of its entries and their number."""
        where = np.flatnonzero(self.known[hashes >> U(64 - TABLE_BITS)])
        low = np.searchsorted(self.keys, hashes[where])
        high = np.searchsorted(self.keys, hashes[where], "right")
        return where[high > low], low[high > low], (high - low)[high > low]

    def whole(self, points: np.ndarray) -> list[tuple[int, int, int]]:
        """(item, start, end) of the short items in one text or several, by length and place."""
        out, word = [], of_word(points) if self.short else None
        for m, (keys, its) in sorted(self.short.items()):
            hashes = runs_of(points, m)
            at = np.arange(len(hashes))
            inside = np.zeros(len(hashes), bool)           # of a longer word
            inside[1:] |= word[:-1][:len(hashes) - 1] & word[1:len(hashes)] if len(hashes) > 1 else False
            after = at + m < len(points)
            inside[after] |= word[at[after] + m - 1] & word[at[after] + m]
            at = at[~inside]
            low, high = np.searchsorted(keys, hashes[at]), np.searchsorted(keys, hashes[at], "right")
            for p, a, z in zip(at[high > low].tolist(), low[high > low].tolist(), high[high > low].tolist()):
                out += [(int(i), p, p + m) for i in its[a:z] if np.array_equal(self.texts[i], points[p:p + m])]
        return out


def pieces(where: np.ndarray, low: np.ndarray, n: np.ndarray):
    """(positions, entries) of hits, written out in pieces of about ENTRIES."""
    total = np.cumsum(n)
    edges = np.unique(np.r_[0, np.searchsorted(total, np.arange(ENTRIES, int(n.sum()), ENTRIES)), len(n)])
    for a, z in zip(edges[:-1], edges[1:]):
        count = n[a:z]
        yield np.repeat(where[a:z], count), np.repeat(low[a:z] - np.cumsum(count) + count, count) + np.arange(count.sum())


def align(item: np.ndarray, text: np.ndarray, low: int, high: int, most: int) -> tuple[int, int, int] | None:
    """The best occurrence of a whole item in a text, on diagonals low..high: (edits, start, end), or nothing.

    One row of the edit-distance table per character of the item, only the band's cells. A cell holds the cost and the
    start of its occurrence in one number, so the earliest of the cheapest starts wins.
    """
    width, shift = high - low + 1, 1 << (len(text) + 1).bit_length()     # room for any start below the cost
    far = (most + width + len(item) + 2) * shift
    span = np.arange(width, dtype=np.int64)
    start, padded = low + span, np.append(text, text.dtype.type(0))
    row = np.where((start >= 0) & (start <= len(text)), start, far)       # an occurrence may begin anywhere
    for i, c in enumerate(item):
        at = low + i + span                                               # text position of the diagonal step
        inside = (at >= 0) & (at < len(text))
        step = row + np.where(inside & (padded[np.clip(at, 0, len(text))] == c), 0, shift)
        step[~inside] = far
        step[:-1] = np.minimum(step[:-1], row[1:] + shift)                # a character of the item is missing
        row = np.minimum.accumulate(step - span * shift) + span * shift   # extra characters in the text
        row[(at + 1 < 0) | (at + 1 > len(text))] = far
        if row.min() >= (most + 1) * shift:
            return None
    best = int(np.argmin(row))
    cost, begin = divmod(int(row[best]), shift)
    return (cost, begin, low + best + len(item)) if cost <= most else None


def equal(item: np.ndarray, text: np.ndarray, first: int, last: int) -> tuple[int, int, int] | None:
    """The first exact occurrence that starts in first..last, which needs no alignment."""
    first = max(first, 0)
    whole, part = text[first:max(first, last + len(item) + 1)].tobytes(), item.tobytes()
    at = whole.find(part)
    while at % 4 and at >= 0:
        at = whole.find(part, at + 1)
    return (0, first + at // 4, first + at // 4 + len(item)) if at >= 0 else None


def find(index: Index, points: np.ndarray, pos: np.ndarray, entry: np.ndarray) -> list[tuple[int, int, int, int]]:
    """(item, start, end, edits) in one text, given its shared q-grams; of overlapping occurrences the best stays."""
    item = index.item[entry]
    step = index.edits[item] + 1
    # Diagonals are counted from minus the longest item on, so that none is negative.
    band = (pos - index.at[entry] + index.longest) // step + 1
    wide = int(band.max()) + 1
    key = np.concatenate([item * wide + band, item * wide + band - 1])
    once = np.unique(key * (len(points) + 1) + np.concatenate([pos, pos]))   # a q-gram of the text counts once in a band
    keys, shared = np.unique(once // (len(points) + 1), return_counts=True)
    its, bands = keys // wide, keys % wide
    enough = shared >= index.least[its]
    found: dict[int, set] = {}
    for i, band in zip(its[enough].tolist(), bands[enough].tolist()):
        k = int(index.edits[i])
        low = (band - 1) * (k + 1) - index.longest
        low, high = low - k, low + 2 * (k + 1) - 1 + k
        if hit := equal(index.texts[i], points, low, high) or align(index.texts[i], points, low, high, k):
            found.setdefault(i, set()).add(hit)
    out = []
    for i, hits in found.items():
        kept: list[tuple[int, int, int]] = []
        for cost, a, z in sorted(hits):
            if all(z <= b or a >= e for _, b, e in kept):
                kept.append((cost, a, z))
        out += [(i, a, z, cost) for cost, a, z in sorted(kept, key=lambda h: h[1])]
    return out


def search(index: Index, texts: list[str], q: int) -> list[tuple[int, int, int, int, int]]:
    """(text, item, start, end, edits) in a slice of texts, which are looked up together and aligned one by one.

    A q-gram that many items share is not written out for all its places at once: shared q-grams are counted piece by piece
    for each text and item, and only those of pairs that reach the item's bound are kept.
    """
    if not index.ids:
        return []
    if len(texts) > 1 and len(texts) * len(index.ids) > CELLS:
        half = len(texts) // 2
        return search(index, texts[:half], q) + [(t + half, *hit) for t, *hit in search(index, texts[half:], q)]
    points = code_points("".join(texts))
    starts = np.cumsum([0, *map(len, texts)])
    where, low, n = index.hits(grams(points, q))
    text = np.searchsorted(starts, where, "right") - 1
    inside = where + q <= starts[text + 1]
    where, low, n = where[inside], low[inside], n[inside]

    def codes(pos, entry):
        return (np.searchsorted(starts, pos, "right") - 1) * len(index.ids) + index.item[entry]
    counts = np.zeros(len(texts) * len(index.ids) if len(where) else 0, np.int64)
    for pos, entry in pieces(where, low, n):
        code, more = np.unique(codes(pos, entry), return_counts=True)
        counts[code] += more
    # An item with too few shared q-grams in a whole text has no crowded band in it.
    kept = [(pos[enough], entry[enough]) for pos, entry in pieces(where, low, n)
            for enough in [counts[codes(pos, entry)] >= index.least[index.item[entry]]]]
    pos = np.concatenate([p for p, _ in kept] + [np.empty(0, np.int64)])
    entry = np.concatenate([e for _, e in kept] + [np.empty(0, np.int64)])
    text = np.searchsorted(starts, pos, "right") - 1
    out = []
    for t in np.unique(text):
        mine = text == t
        out += [(int(t), *hit) for hit in find(index, points[starts[t]:starts[t + 1]], pos[mine] - starts[t], entry[mine])]
    for t in range(len(texts) if index.short else 0):
        last: dict[int, int] = {}
        for i, a, z in index.whole(points[starts[t]:starts[t + 1]]):
            if a >= last.get(i, 0):
                last[i] = z
                out.append((t, i, a, z, 0))
    return out


def _scan(batches, shared, q: int):
    index = shared.value
    for batch in batches:
        for part in slices(batch, "text"):
            docs = part.column("doc_id").to_pylist()
            rows = [(docs[t], index.ids[i], a, z, c)
                    for t, i, a, z, c in search(index, [t or "" for t in part.column("text").to_pylist()], q)]
            columns = list(zip(*rows)) or [()] * 5
            yield pa.RecordBatch.from_arrays(
                [*(pa.array(c, pa.int64()) for c in columns[:4]), pa.array(columns[4], pa.int32())],
                ["doc_id", "item_id", "start", "end", "edits"])


def contaminated(docs: DataFrame, benchmark: DataFrame, id_column: str = "doc_id", text: str = "text",
                 item_column: str = "item_id", item_text: str = "text", q: int = GRAM,
                 edit_rate: float = EDIT_RATE, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """One row for each occurrence of an item in a document: (doc_id, item_id, start, end, edits).

    ``start`` and ``end`` count characters of the document. Missing and empty texts and items, and items of white space,
    match nothing; items of fewer than q characters match as they stand, where they are not part of a longer word. A
    repeated row is searched as often as it occurs; a repeated item is found under each of its ids. Rows and items
    without an id are searched too and carry a null. Other columns are ignored.

    The items are read into a broadcast index while their measured size is below ``chunk_bytes``. A larger benchmark is cut
    by a hash into chunks below it, each searched in a pass of its own whose matches are written before the next begins.
    """
    source = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    found = []
    for index, last in _indexes(benchmark, item_column, item_text, q, edit_rate, chunk_bytes):
        hits = source.mapInArrow(lambda b, shared=index: _scan(b, shared, q), RESULT)
        found.append(hits if last and not found else stage(hits, "contaminated"))
    out = found[0]
    for more in found[1:]:
        out = out.union(more)
    return out


def without_items(docs: DataFrame, benchmark: DataFrame, text: str = "text", item_column: str = "item_id", item_text: str = "text",
                  q: int = GRAM, edit_rate: float = EDIT_RATE, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """The rows of ``docs`` in whose text no item occurs, by the rules of ``contaminated``.

    A row is decided by its own text where it stands, so ids may be missing or repeated.
    """
    schema, passes = docs.schema, 0
    for index, last in _indexes(benchmark, item_column, item_text, q, edit_rate, chunk_bytes):
        docs = docs.mapInArrow(lambda b, shared=index: _clean(b, shared, text, q), schema)
        docs = docs if last and not passes else stage(docs, "clean")
        passes += 1
    return docs


def _clean(batches, shared, text: str, q: int):
    index = shared.value
    for batch in batches:
        for part in slices(batch, text):
            hit = {t for t, *_ in search(index, [t or "" for t in part.column(text).to_pylist()], q)}
            yield part.filter(pa.array([t not in hit for t in range(part.num_rows)]))


def _indexes(benchmark: DataFrame, item_column: str, item_text: str, q: int, edit_rate: float, chunk_bytes: int):
    """(broadcast index, is it the last) for each chunk of the items."""
    items = (benchmark.select(F.col(item_column).cast("long").alias("item_id"), F.col(item_text).cast("string").alias("text"))
             .where(F.length("text") > 0).distinct())
    chunks = max(1, -(-measured_bytes(items) // chunk_bytes))
    for c in range(chunks):
        rows = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(chunks)) == c)
        held = sorted(((r.item_id, r.text) for r in rows.toLocalIterator()), key=lambda r: (r[0] is None, r[0] or 0, r[1]))
        yield benchmark.sparkSession.sparkContext.broadcast(Index.of(held, q, edit_rate)), c == chunks - 1
