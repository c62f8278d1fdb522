"""Repeated strings of bytes by suffix arrays: per shard by Larsson-Sadakane refinement, common prefixes after Kasai, and
shards merged by binary search.

A string of ``width`` bytes that starts at two places holds the same ``GRAM``-byte string of least hash, at the same
distance from its start. The starts of a text therefore fall into runs by the place of that least hash; no string starts
twice in a run, and a run can only repeat something if its hash has another run. Shards ask for that first; all else (most of a corpus) never enters an array.

If all runs of a hash are equal, they repeat as a whole. Each shard sorts the suffixes of its other runs down to ``width`` bytes. Neighbours with a common prefix of
``width`` bytes repeat within the shard. One string of each class of equal ones goes to the merge as a digest of 120 bits with its
place; lists are in order of place, which packs into a byte or two each. There each list is found by binary search in the sorted
union of all lists of its key range. The places of strings that another shard holds too go back to their shard, so arrays and
prefixes are made once.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from cohortlens.llm import exchange
from cohortlens.llm.anchors import covered
from cohortlens.llm.words import U, mix, random_words, rolling, running_hashes, text_bytes, window_starts

GRAM = 64
SLICE = 1 << 18
GROUP_BYTES = 3 << 20       # of text in a shard, whose suffixes one task holds
BUCKET_BYTES = 24 << 20      # text whose runs meet in one bucket
RESULT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary"
LOW_BYTES = 7               # of the second half of a digest
LOW = U((1 << 8 * LOW_BYTES) - 1)
WIDE = (1 << 16) - 1        # gaps between places from here on take four bytes more; a shard's text is below 2 GB


def suffix_array(text: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """The suffixes of a text sorted by their first ``depth`` characters at least, and the rank of each position.

    Larsson and Sadakane: suffixes begin sorted by 8 bytes; each round doubles the length by which they are sorted, with
    the rank of the suffix that far ahead as the key, and touches only the suffixes of groups that are still tied. A
    rank is the last row of its group, so ranks of finished suffixes never change. ``text`` holds numbers
    below 2**16; the end of the text sorts before all else.
    """
    n = len(text)
    if not n:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    padded = np.zeros(n + 8, U)
    padded[:n] = text.astype(U) + U(1)
    # Characters are renumbered densely, so that as many as possible fit into the first key.
    used = np.zeros(1 << 16, bool)
    used[padded] = True
    used[0] = True
    code = (np.cumsum(used) - 1).astype(U)
    bits = max(1, int(code.max()).bit_length())
    step = min(8, 64 // bits)
    key = np.zeros(n, U)
    for k in range(step):
        key = (key << U(bits)) | code[padded[k:k + n]]
    order = np.argsort(key)
    new = np.r_[True, key[order][1:] != key[order][:-1]] if n else np.empty(0, bool)

    def last_rows(starts: np.ndarray, size: int) -> np.ndarray:
        at = np.flatnonzero(starts)
        return np.repeat(np.r_[at[1:], size] - 1, np.diff(np.r_[at, size]))
    rank = np.empty(n + 1, np.int64)
    rank[n] = -1
    rank[order] = last_rows(new, n)
    tied = np.flatnonzero(~(new & np.r_[new[1:], True])) if n else np.empty(0, np.int64)   # rows of groups of several
    length = step
    while length < depth and len(tied):
        rows = order[tied]
        group = rank[rows]
        ahead = rank[np.minimum(rows + length, n)] + 1
        sub = np.lexsort((ahead, group)) if n > 1 << 31 else np.argsort((group << 32) | ahead)
        rows, group, ahead = rows[sub], group[sub], ahead[sub]
        order[tied] = rows
        new = np.r_[True, (group[1:] != group[:-1]) | (ahead[1:] != ahead[:-1])]
        at = np.flatnonzero(new)
        sizes = np.diff(np.r_[at, len(rows)])
        rank[rows] = np.repeat(tied[np.r_[at[1:], len(rows)] - 1], sizes)
        tied = tied[np.repeat(sizes > 1, sizes)]
        length *= 2
    return order, rank[:n]


def common_prefixes(text: np.ndarray, order: np.ndarray, rank: np.ndarray, ends: np.ndarray, width: int) -> np.ndarray:
    """For each row of a suffix array the common prefix with the row before, not beyond either suffix's ``ends``.

    Kasai: if the row before position i is j, and that before i + 1 is j + 1, then these agree on one character less.
    Positions whose predecessor moves along form a chain, of which only the head is compared. A chain begins anew after
    ``width`` positions and a head is compared over 2 * ``width`` characters at most, so every value below ``width`` is exact and
    the others are told to be at least that. Suffixes of one rank agree on ``width`` characters as they are sorted that far.
    """
    n = len(text)
    if not n:
        return np.empty(0, np.int64)
    places = np.arange(n)
    before = np.full(n, -1, np.int64)
    before[order[1:]] = order[:-1]
    head = np.ones(n, bool)
    head[1:] = (before[1:] != before[:-1] + 1) | (before[1:] < 0) | (before[:-1] < 0) | (ends[1:] != ends[:-1])
    head[1:] |= ends[np.maximum(before[1:], 0)] != ends[np.maximum(before[:-1], 0)]      # bounds hold for one region
    chain = np.maximum.accumulate(np.where(head, places, 0)) if n else places
    tied = (before >= 0) & (rank == rank[np.maximum(before, 0)])
    head |= ((places - chain) % width == 0) | np.r_[False, tied[:-1]]
    head &= ~tied
    chain = np.maximum.accumulate(np.where(head, places, 0)) if n else places
    i = np.flatnonzero(head & (before >= 0))      # none of them tied
    j = before[i]
    most = np.minimum(2 * width, np.minimum(ends[i] - i, ends[j] - j))
    padded = np.zeros(n + 16, np.uint16)
    padded[:n] = text
    fours = np.lib.stride_tricks.as_strided(padded, (n + 8, 4), (2, 2)).copy().view(U).ravel()   # four characters from each place on
    same, open_ = np.zeros(len(i), np.int64), np.arange(len(i))
    while len(open_):
        equal = fours[i[open_] + same[open_]] == fours[j[open_] + same[open_]]
        same[open_[equal]] += 4
        open_ = open_[equal]
        open_ = open_[same[open_] < most[open_]]
    for _ in range(3):       # what is left of the first group of four that differs
        at = np.flatnonzero(same < most)
        more = padded[i[at] + same[at]] == padded[j[at] + same[at]]
        same[at[more]] += 1
    reach = np.zeros(n, np.int64)
    reach[i] = np.minimum(same, most) + i
    agreed = np.where(tied, width, np.where(before >= 0, np.maximum(reach[chain] - places, 0), 0))
    bound = np.minimum(ends - places, np.where(before >= 0, ends[before] - before, 0))
    return np.minimum(agreed, bound)[order]


class Shard:
    """The texts of a group as bytes, cut into runs of starts with the same place of the least hash."""

    def __init__(self, table: pa.Table, width: int):
        self.table = exchange.ordered(table)
        self.buf, self.bounds = text_bytes(self.table.column("text"))
        self.width = width
        self.gram = min(GRAM, width)
        self.first, self.length, self.key = self._runs()

    def _runs(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        starts = window_starts(self.bounds, self.width)
        if not len(starts):
            return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, U)
        # The upper half of a hash with the place below it: the least is the leftmost of the least hashes. Cut into
        # slices that fit a cache; each reads on by one string, so its starts see what they would see in the whole.
        reach = self.width - self.gram + 1
        place, key = np.empty(len(self.buf) - self.width + 1, np.int64), np.empty(len(self.buf) - self.width + 1, U)
        for lo in range(0, len(place), SLICE):
            hashes = rolling(self.buf[lo:lo + SLICE + self.width - 1], self.gram, 3)
            least = (hashes >> U(32) << U(32)) | np.arange(len(hashes), dtype=U)
            span = 1
            while 2 * span <= reach:         # the least of each run of ``reach`` hashes, by doubling
                least = np.minimum(least[:-span], least[span:])
                span *= 2
            if reach > span:
                least = np.minimum(least[:len(least) - (reach - span)], least[reach - span:])
            at = (least & U(0xFFFFFFFF)).astype(np.int64)
            place[lo:lo + len(at)], key[lo:lo + len(at)] = at + lo, hashes[at]
        place = place[starts]
        new = np.r_[True, (place[1:] != place[:-1]) | (starts[1:] != starts[:-1] + 1)]
        # A new text that follows without a gap begins a new run.
        text_starts = np.zeros(len(self.buf) + 1, bool)
        text_starts[self.bounds] = True
        new |= text_starts[starts]
        at = np.flatnonzero(new)
        return starts[at], np.diff(np.r_[at, len(starts)]), mix(key[starts[at]])

    def contents(self) -> np.ndarray:
        """64 bits of all bytes of each run, by running sums of a polynomial."""
        return running_hashes(self.buf, self.first, self.first + self.length + self.width - 1, 21)

    def pairs(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The distinct (key, content) of the runs, sorted, with the several-runs bit in the content's lowest bit, and each run's row."""
        content = self.contents() | U(1)
        order = np.lexsort((content, self.key))
        k, c = self.key[order], content[order]
        new = np.r_[True, (k[1:] != k[:-1]) | (c[1:] != c[:-1])] if len(k) else np.empty(0, bool)
        row = np.empty(len(k), np.int64)
        row[order] = np.cumsum(new) - 1
        once = np.bincount(row, minlength=int(new.sum())) == 1
        return k[new], np.where(once, c[new] - U(1), c[new]), row


def _run_answers(keys: list[np.ndarray], more: list[bytes]) -> list[np.ndarray]:
    """For each run: 0 no other run has its hash; 1 others have it, all with the same bytes; 2 with other bytes as well."""
    key, content = np.concatenate(keys), np.concatenate([np.frombuffer(m, "<u8") for m in more])
    several, content = (content & U(1)).astype(np.int64), content | U(1)
    order = np.lexsort((content, key))
    k, c = key[order], content[order]
    new_key = np.r_[True, k[1:] != k[:-1]]
    new = new_key | np.r_[True, c[1:] != c[:-1]]
    group = np.cumsum(new_key) - 1
    rows = np.bincount(group, weights=1 + several[order])
    kinds = np.bincount(group, weights=new)
    out = np.empty(len(k), np.uint8)
    out[order] = np.where(kinds[group] > 1, 2, rows[group] > 1)
    return np.split(out, np.cumsum([len(x) for x in keys])[:-1])


class Strings:
    """The candidate strings of a shard in sorted order: classes of equal ones, and what the shard alone can say of them.

    Strings of runs whose hash only has equal runs repeat as a whole and need no order. The other candidate runs are joined to
    regions where they touch, and the suffixes of all regions are sorted together.
    """

    def __init__(self, shard: Shard, answers: np.ndarray):
        _, _, row = shard.pairs()
        state = answers[row] if len(row) else np.empty(0, np.uint8)
        self.width, self.shard, self.whole = shard.width, shard, np.flatnonzero(state == 1)
        first, length = shard.first[state == 2], shard.length[state == 2]
        new = np.ones(len(first), bool)
        # Runs of two texts never touch: a string ends before its text does.
        new[1:] = first[1:] != first[:-1] + length[:-1]
        begin = np.flatnonzero(new)
        self.first = first[begin]
        size = (np.add.reduceat(length, begin) if len(begin) else length) + shard.width - 1
        self.at = np.cumsum(size + 1) - size - 1                 # a separator follows each region
        total = int((size + 1).sum())
        where = np.repeat(self.first - self.at, size + 1) + np.arange(total)
        text = shard.buf[np.minimum(where, max(len(shard.buf) - 1, 0))].astype(np.uint16) + 1 if total else np.empty(0, np.uint16)
        ends = np.repeat(self.at + size, size + 1)
        text[self.at + size] = 0
        order, rank = suffix_array(text, self.width)
        prefix = common_prefixes(text, order, rank, ends, self.width)
        full = ends[order] - order >= self.width                 # rows at which a whole string starts
        order, prefix = order[full], self._least_since(prefix, full)
        new = prefix < self.width
        if len(new):
            new[0] = True
        self.order, self.cls = order, np.cumsum(new) - 1
        self.repeated = np.bincount(self.cls, minlength=int(new.sum())) > 1
        self.sample = order[np.flatnonzero(new)]
        self.text = text

    @staticmethod
    def _least_since(prefix: np.ndarray, full: np.ndarray) -> np.ndarray:
        """The common prefix of each kept row with the kept row before it: the least over the rows between."""
        at = np.flatnonzero(full)
        if not len(at):
            return prefix[:0]
        return np.minimum.reduceat(prefix[:at[-1] + 1], np.r_[0, at[:-1] + 1])

    def keys(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """A digest in two halves of one string of each class, and the strings' places, in order of place.

        The lowest bit of the second half says that the shard holds the string several times.
        """
        order = np.argsort(self.sample)
        places = self.sample[order]
        codes = random_words(1 << 9, 31)
        high, low = np.empty(len(places), U), np.empty(len(places), U)
        for lo in range(0, len(self.text) - self.width + 1, SLICE):
            a, z = np.searchsorted(places, (lo, lo + SLICE))
            part = self.text[lo:lo + SLICE + self.width - 1]
            at = places[a:z] - lo
            high[a:z] = rolling(part, self.width, 5)[at]
            low[a:z] = rolling(codes[part], self.width, 9)[at]
        low = (low & LOW) | U(1)
        return high, np.where(self.repeated[order], low, low - U(1)), self._places(places)

    def _places(self, at: np.ndarray) -> np.ndarray:
        """Where in the shard's bytes rows of the joined regions start."""
        region = np.searchsorted(self.at, at, "right") - 1
        return self.first[region] + at - self.at[region] if len(at) else at

    def known(self) -> np.ndarray:
        """Runs (first, length) of starts that this shard knows to be repeated, in order."""
        at = np.sort(self._places(self.order[self.repeated[self.cls]]))
        begin = np.flatnonzero(np.r_[True, at[1:] != at[:-1] + 1]) if len(at) else at
        first = np.concatenate([self.shard.first[self.whole], at[begin]])
        length = np.concatenate([self.shard.length[self.whole], np.diff(np.r_[begin, len(at)])])
        return np.stack([first, length], axis=1).astype("<u4")


def pack_places(places: np.ndarray) -> bytes:
    """Ascending places as gaps of two bytes, all low bytes first, and the wide ones behind."""
    gaps = np.diff(places, prepend=0)
    return np.minimum(gaps, WIDE).astype("<u2").view(np.uint8).reshape(-1, 2).T.tobytes() + gaps[gaps >= WIDE].astype("<u4").tobytes()


def unpack_places(data: bytes, n: int) -> np.ndarray:
    gaps = np.frombuffer(data, np.uint8, 2 * n).reshape(2, n).T.copy().view("<u2").ravel().astype(np.int64)
    gaps[gaps == WIDE] = np.frombuffer(data, "<u4", offset=2 * n)
    return np.cumsum(gaps)


def _ask(g: int, high: np.ndarray, low: np.ndarray, places: np.ndarray, runs: np.ndarray, buckets: int) -> pa.Table:
    """One row for each bucket of keys, and one with the runs that the shard knows, which has no keys."""
    edges = np.array([i * exchange.FULL // buckets for i in range(1, buckets)], dtype=U)
    bucket = np.searchsorted(edges, high, "right")
    order = np.argsort(bucket, kind="stable")
    high, low, places = high[order], low[order], places[order]
    at = np.searchsorted(bucket[order], np.arange(buckets + 1))
    rows = [(b, high[a:z].tobytes(), low[a:z].view(np.uint8).reshape(-1, 8)[:, :LOW_BYTES].tobytes() + pack_places(places[a:z]))
            for b, (a, z) in enumerate(zip(at[:-1], at[1:])) if a < z]
    rows.append((g % buckets, b"", runs.tobytes()))
    return pa.table({"g": pa.array([g] * len(rows), pa.int32()), "bucket": pa.array([r[0] for r in rows], pa.int32()),
                     "keys": pa.array([r[1] for r in rows], pa.binary()), "more": pa.array([r[2] for r in rows], pa.binary())})


def _elsewhere(highs: list[np.ndarray], lows: list[np.ndarray]) -> list[np.ndarray]:
    """Which strings of each list have several places, by binary search of each list in the sorted union of all."""
    union, at = exchange.merged(highs)
    # Where 64 bits agree the others must too; if any differ, all lists are ordered by both.
    second = np.empty(len(union), U)
    for k, low in zip(at, lows):
        second[k] = low | U(1)
    if any((second[k] != low | U(1)).any() for k, low in zip(at, lows)):
        packed = exchange.several_places(highs, [low.tobytes() for low in lows])
        return [np.unpackbits(b)[:len(k)].astype(bool) for b, k in zip(packed, highs)]
    held = np.zeros(len(union), np.int64)
    for k, low in zip(at, lows):
        held[k] += 1 + (low & U(1)).astype(np.int64)
    return [held[k] > 1 for k in at]


def _merge(table: pa.Table) -> pa.Table:
    """The places that each shard learns from a bucket; what a shard knows itself passes through."""
    highs, lows, places, out = [], [], [], []
    for row in table.sort_by("g").to_pylist():
        if not row["keys"]:
            out.append((row["g"], 0, b"", row["more"]))
            continue
        highs.append(np.frombuffer(row["keys"], "<u8"))
        n = len(highs[-1])
        low = np.zeros((n, 8), np.uint8)
        low[:, :LOW_BYTES] = np.frombuffer(row["more"], np.uint8, n * LOW_BYTES).reshape(n, LOW_BYTES)
        lows.append(low.view("<u8").ravel())
        places.append((row["g"], unpack_places(row["more"][n * LOW_BYTES:], n)))
    for (g, at), low, several in zip(places, lows, _elsewhere(highs, lows) if highs else []):
        learnt = at[several & (low & U(1) == 0)]       # the shard knows what it holds several times
        out.append((g, len(learnt), pack_places(learnt), b""))
    return pa.table({"g": pa.array([r[0] for r in out], pa.int32()), "n": pa.array([r[1] for r in out], pa.int32()),
                     "places": pa.array([r[2] for r in out], pa.binary()), "runs": pa.array([r[3] for r in out], pa.binary())})


def repeated_bytes(docs: DataFrame, id_column: str = "doc_id", text: str = "text", width: int = 200,
                   group_bytes: int = GROUP_BYTES, bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept) for every row, of the UTF-8 bytes of its whole text.

    A byte is removed if a string of ``width`` bytes covers it that also starts anywhere else, in the same text or
    another, overlaps included; strings are judged on the input and never cross texts. ``n_spans`` counts the maximal removed
    runs, ``kept`` has the other bytes (a cut may fall into a character). A missing text has no bytes. Each
    row counts as a text of its own, also when rows repeat an id or have none. Other columns are ignored.
    """
    groups, n_groups = exchange.grouped(docs, id_column, text, group_bytes)
    buckets = max(1, -(-n_groups * group_bytes // bucket_bytes))

    def candidates(table: pa.Table) -> pa.Table:
        key, content, _ = Shard(table, width).pairs()
        return exchange.ask_rows(table.column("g")[0].as_py(), key, content, buckets)

    def sort(table: pa.Table, answers: pa.Table) -> pa.Table:
        if not table.num_rows:
            return exchange.ask_rows(0, np.empty(0, U), np.empty(0, U), buckets)
        strings = Strings(Shard(table, width), exchange.gathered(answers, np.uint8))
        return _ask(table.column("g")[0].as_py(), *strings.keys(), strings.known(), buckets)

    def remove(table: pa.Table, answers: pa.Table) -> pa.Table:
        runs = np.frombuffer(b"".join(answers.column("runs").to_pylist()), "<u4").reshape(-1, 2).astype(np.int64)
        first, length = runs[:, 0], runs[:, 1]
        known = np.repeat(first - np.cumsum(length) + length, length) + np.arange(length.sum())
        places = [unpack_places(p, n) for p, n in zip(answers.column("places").to_pylist(), answers.column("n").to_pylist())]
        return _removed(exchange.ordered(table), np.concatenate([known, *places]), width)

    runs = exchange.answer(groups.groupBy("g").applyInArrow(candidates, exchange.ASKED), _run_answers)
    asked = groups.groupBy("g").cogroup(runs.groupBy("g")).applyInArrow(sort, exchange.ASKED)
    found = asked.groupBy("bucket").applyInArrow(_merge, "g int, n int, places binary, runs binary")
    return groups.groupBy("g").cogroup(found.groupBy("g")).applyInArrow(remove, RESULT)


def _removed(table: pa.Table, starts: np.ndarray, width: int) -> pa.Table:
    buf, bounds = text_bytes(table.column("text"))
    gone = covered(len(buf), starts, width)
    begins = gone.copy()
    begins[1:] &= ~gone[:-1]
    a, z = bounds[:-1], bounds[1:]
    full = a < z
    begins[a[full]] = gone[a[full]]
    total, runs = np.r_[0, np.cumsum(gone)], np.r_[0, np.cumsum(begins)]
    kept = [buf[i:k][~gone[i:k]].tobytes() for i, k in zip(a, z)]
    return pa.table({"doc_id": table.column("doc_id"), "n_bytes": pa.array(z - a, pa.int64()),
                     "n_removed": pa.array(total[z] - total[a], pa.int64()), "n_spans": pa.array(runs[z] - runs[a], pa.int64()),
                     "kept": pa.array(kept, pa.binary())})
