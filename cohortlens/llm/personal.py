"""Personal data by patterns, and by a linear-chain conditional random field over word shapes for what the patterns miss.

Patterns find e-mail addresses, IP numbers, card and telephone numbers of fixed forms. The random field tags words with B and I labels
of the same four kinds by features of their shapes, their neighbours' shapes and cue words before them. A word without a digit, an at sign
or a bracketed "at" cannot belong to a span: its label is fixed to O, in training as in decoding. Given the fixed labels the chain of a
text falls apart into the runs of words in between, each with O at both ends, so decoding the runs alone is exact.
"""

import re
from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from cohortlens.llm.words import slices, text_bytes, word_spans

KINDS = ["email", "ip", "card", "phone"]                     # in the order that breaks ties of starts
LABELS = ["O", *(f"{p}-{k}" for k in KINDS for p in "BI")]
MOST_EXAMPLES = 5_000        # labelled rows that a model is fitted to, those of the smallest hashes
ROUNDS, RATE, PENALTY = 200, 0.15, 0.02
PADDED = 1 << 16             # words, with padding, that are decoded at once
MOST_SHAPES = 100_000        # distinct words whose features a worker keeps
RESULT = "doc_id long, spans array<struct<kind: string, start: long, end: long, base: boolean>>"

LOCAL = re.compile(r"[A-Za-z0-9._%+-]+")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
NUMBERS = re.compile(r"[0-9]+(?:\.[0-9]+)*")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
NO_DIGIT = re.compile(r"[^0-9]+")

# Words that announce a kind, in the languages of the corpus.
CUES = {
    "email": ["email", "e-mail", "mail", "contact", "correo", "courriel", "write"],
    "ip": ["ip", "host", "server", "address", "ping", "adresse", "node"],
    "card": ["card", "visa", "mastercard", "amex", "credit", "karte", "carte", "tarjeta"],
    "phone": ["tel", "telephone", "phone", "call", "fax", "mobile", "ring", "text", "telefon", "téléphone", "teléfono", "dial"],
}
CUE_OF = {word: kind for kind, words in CUES.items() for word in words}
LEADING, TRAILING = "\"'<[{,;:.!?*#&%$=", "\"'>]},;:.!?*#&%$="


# --- Patterns --------------------------------------------------------------------------------

def emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches, looked for at each at sign, so that long runs of letters cost no more than their length."""
    low, at = 0, text.find("@")
    while at >= 0:
        before = LOCAL.match(text[low:at][::-1])
        after = DOMAIN.match(text, at + 1) if before else None
        if after:
            yield at - before.end(), after.end()
        low = after.end() if after else at + 1
        at = text.find("@", low)


def addresses(text: str) -> Iterator[tuple[int, int]]:
    """Four numbers of at most 255 with dots between; a longer row of numbers is taken four by four."""
    for run in NUMBERS.finditer(text):
        parts, place = run.group().split("."), run.start()
        for k in range(0, len(parts) - 3, 4):
            four = parts[k:k + 4]
            size = sum(map(len, four)) + 3
            if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in four):
                yield place, place + size
            place += size + 1


def luhn(digits: str) -> bool:
    values = [int(d) for d in digits[::-1]]
    return sum(values[0::2] + [2 * v - 9 * (v > 4) for v in values[1::2]]) % 10 == 0


def cards(text: str) -> Iterator[tuple[int, int]]:
    for found in CARD.finditer(text):
        digits = NO_DIGIT.sub("", found.group())
        if 12 <= len(digits) <= 19 and luhn(digits):
            yield found.span()


def phones(text: str) -> Iterator[tuple[int, int]]:
    for found in PHONE.finditer(text):
        if 9 <= len(NO_DIGIT.sub("", found.group())) <= 15:
            yield found.span()


def patterns(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of all pattern matches, by start, then kind."""
    found = [(a, k, z) for k, find in enumerate((emails, addresses, cards, phones)) for a, z in find(text)]
    return sorted(found)


# --- Words and their features ----------------------------------------------------------------

def core(word: str) -> tuple[int, int]:
    """What is left of a word without the punctuation around it; brackets stay where both of a pair do."""
    a, z = 0, len(word)
    while True:
        before = a, z
        while a < z and word[a] in LEADING:
            a += 1
        while a < z and word[z - 1] in TRAILING:
            z -= 1
        if a < z and word[a] == "(" and (")" not in word[a:z] or word[z - 1] == ")" and z - a > 6):   # an area code keeps them
            a += 1
        if a < z and word[z - 1] == ")" and "(" not in word[a:z]:
            z -= 1
        if (a, z) == before:
            return a, z


def shape(word: str) -> str:
    """Digits as 9, letters as X or x, runs of one kind collapsed."""
    kinds = ("9" if c in "0123456789" else "X" if c.isupper() else "x" if c.isalpha() else c for c in word)
    return "".join(k for k, _ in groupby(kinds))


def word_features(word: str) -> tuple[str, str, list[str]]:
    """(shape, size class of the digits, features) of a word without the punctuation around it."""
    form = shape(word)
    runs = [len(r) for r in re.findall("[0-9]+", word)]
    digits = sum(runs)
    size = next((str(n) for n in (0, 1, 2, 3, 4, 5, 6, 8, 11, 15, 19) if digits <= n), "more")
    marks = [f"{m}{min(word.count(m), 8)}" for m in "@.-:/()+%$#_=," if m in word]
    letters = re.sub("[^A-Za-z\u0080-\U0010ffff]", "", word)
    out = ["bias", f"shape {form[:16]}", f"digits {size}", f"runs {'-'.join(map(str, runs[:5]))}", *(f"mark {m}" for m in marks)]
    if re.search(r"[(\[][aA][tT][)\]]", word):
        out.append("bracketed at")
    if letters:
        out.append("hex letters" if re.fullmatch("[A-Fa-f]+", letters) else "letters")
    if len(runs) == 4 and all(r <= 3 for r in runs) and not letters:
        out.append("four short numbers")
    if word.count(":") >= 2 and re.fullmatch("[0-9A-Fa-f:]+", word):
        out.append("colons and hex digits")
    return form[:16], size, out


def cue(word: str) -> str | None:
    return CUE_OF.get(word.strip("\"'<>[](){},;:.!?*#&%$=").lower())


class Words:
    """The words of a slice that may belong to a span, in runs of neighbours."""

    def __init__(self, column: pa.Array):
        self.buf, self.starts = text_bytes(column)
        first, last, bounds = word_spans(self.buf, self.starts)
        held = np.flatnonzero((self.buf - np.uint8(0x30) < 10) | (self.buf == 0x40))
        for at in np.flatnonzero((self.buf == 0x28) | (self.buf == 0x5B)).tolist():
            if self.buf[at:at + 4].tobytes().lower() in (b"(at)", b"[at]"):
                held = np.append(held, at)
        at = np.unique(np.searchsorted(first, held, "right") - 1)
        self.text = np.searchsorted(bounds, at, "right") - 1
        self.first, self.last = first[at], last[at]
        joined = np.zeros(len(at), bool)
        joined[1:] = (at[1:] == at[:-1] + 1) & (self.text[1:] == self.text[:-1])
        self.run = np.cumsum(~joined) - 1
        data = self.buf.tobytes()
        self.words = [data[a:z].decode() for a, z in zip(self.first.tolist(), self.last.tolist())]
        self.cores = [core(w) for w in self.words]
        self.cues = []
        low = bounds[self.text]
        for i, least in zip(at.tolist(), low.tolist()):
            near = (cue(data[first[j]:last[j]].decode()) for j in range(i - 1, max(least, i - 3) - 1, -1))
            self.cues.append(next((c for c in near if c), None))

    def characters(self) -> tuple[np.ndarray, np.ndarray]:
        """Start and end of each word's core in characters of its text."""
        count = np.r_[0, np.cumsum(self.buf & 0xC0 != 0x80)]
        start = count[self.first] - count[self.starts[self.text]]
        cores = np.array(self.cores, np.int64).reshape(-1, 2)
        return start + cores[:, 0], start + cores[:, 1]

    def features(self, known: dict) -> Iterator[list[str]]:
        own = []
        for word, (a, z) in zip(self.words, self.cores):
            word = word[a:z]
            got = known.get(word)
            if got is None:
                got = word_features(word)
                if len(known) < MOST_SHAPES:
                    known[word] = got
            own.append(got)
        run, n = self.run.tolist(), len(own)
        for k, (form, size, out) in enumerate(own):
            more = [f"cue {self.cues[k]}"] if self.cues[k] else []
            for side, j in (("before", k - 1), ("after", k + 1)):
                if 0 <= j < n and run[j] == run[k]:
                    more += [f"{side} {own[j][0]}", f"{side} digits {own[j][1]}", f"{side} {own[j][0]} here {form}"]
                else:
                    more.append(f"{side} nothing")
            yield out + more


# --- The random field ------------------------------------------------------------------------

def _padded(run: np.ndarray, emissions: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Runs as rows of one array with a mask, and where each word stands in it."""
    sizes = np.bincount(run)
    row = run
    place = np.arange(len(run)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    out = np.zeros((len(sizes), int(sizes.max()), emissions.shape[1]))
    out[row, place] = emissions
    return out, np.arange(out.shape[1]) < sizes[:, None], row, place


def _log_sum(x: np.ndarray, axis: int) -> np.ndarray:
    most = x.max(axis=axis, keepdims=True)
    return np.squeeze(most, axis) + np.log(np.exp(x - most).sum(axis=axis))


def _marginals(scores: np.ndarray, mask: np.ndarray, steps: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
    """The log normaliser of all runs, each word's label probabilities and the expected number of each transition."""
    rows, length, labels = scores.shape
    ahead = np.zeros_like(scores)
    ahead[:, 0] = steps[0] + scores[:, 0]
    for t in range(1, length):
        here = _log_sum(ahead[:, t - 1, :, None] + steps, 1) + scores[:, t]
        ahead[:, t] = np.where(mask[:, t, None], here, ahead[:, t - 1])
    total = _log_sum(ahead[:, -1] + steps[:, 0], 1)
    back = np.zeros_like(scores)
    back[:, -1] = steps[:, 0]
    counts = np.zeros_like(steps)
    for t in range(length - 1, 0, -1):
        both = steps + (scores[:, t] + back[:, t])[:, None, :]
        counts += (np.exp(ahead[:, t - 1, :, None] + both - total[:, None, None]) * mask[:, t, None, None]).sum(axis=0)
        back[:, t - 1] = np.where(mask[:, t, None], _log_sum(both, 2), steps[:, 0])
    chance = np.exp(ahead + back - total[:, None, None]) * mask[..., None]
    counts[0] += chance[:, 0].sum(axis=0)
    last = mask.sum(axis=1) - 1
    counts[:, 0] += chance[np.arange(rows), last].sum(axis=0)
    return float(total.sum()), chance, counts


def best_labels(run: np.ndarray, emissions: np.ndarray, steps: np.ndarray) -> np.ndarray:
    """The likeliest labels of the words of each run, by Viterbi's algorithm on many runs at once."""
    out = np.zeros(len(run), np.int64)
    if not len(run):
        return out
    sizes = np.bincount(run)
    starts = np.cumsum(sizes) - sizes
    order = np.argsort(sizes, kind="stable")
    at = 0
    while at < len(order):
        fit = sizes[order[at:]] * np.arange(1, len(order) - at + 1) <= PADDED
        some = order[at:at + max(1, int(np.argmin(fit)) if not fit.all() else len(fit))]
        at += len(some)
        words = np.concatenate([np.arange(starts[r], starts[r] + sizes[r]) for r in some])
        scores, mask, row, place = _padded(np.repeat(np.arange(len(some)), sizes[some]), emissions[words])
        value, came = steps[0] + scores[:, 0], np.zeros(scores.shape, np.int8)
        for t in range(1, scores.shape[1]):
            reach = value[:, :, None] + steps
            came[:, t] = reach.argmax(axis=1)
            value = np.where(mask[:, t, None], reach.max(axis=1) + scores[:, t], value)
        label = (value + steps[:, 0]).argmax(axis=1)
        found = np.zeros(mask.shape, np.int64)
        for t in range(scores.shape[1] - 1, -1, -1):
            found[:, t] = label
            if t:
                label = np.where(mask[:, t], came[np.arange(len(label)), t, label], label)
        out[words] = found[row, place]
    return out


class Model:
    """Weights by feature and label, and by pair of labels."""

    def __init__(self, features: dict[str, int], weights: np.ndarray, steps: np.ndarray):
        self.features, self.weights, self.steps, self.known = features, weights, steps, {}

    def emissions(self, rows: Iterator[list[str]], n: int) -> np.ndarray:
        ids, at = [], []
        for k, row in enumerate(rows):
            found = [self.features[f] for f in row if f in self.features]
            ids += found
            at += [k] * len(found)
        out = np.zeros((n, len(LABELS)))
        np.add.at(out, np.array(at, np.int64), self.weights[np.array(ids, np.int64)])
        return out

    def labels(self, words: Words) -> np.ndarray:
        return best_labels(words.run, self.emissions(words.features(self.known), len(words.words)), self.steps)


def _labelled(words: Words, spans: list[list[tuple[int, int, int]]]) -> np.ndarray:
    """The label of each word by the (start, kind, end) spans of its text."""
    starts, ends = words.characters()
    out = np.zeros(len(starts), np.int64)
    for k, (text, a, z) in enumerate(zip(words.text.tolist(), starts.tolist(), ends.tolist())):
        for start, kind, end in spans[text]:
            if a < end and z > start:
                out[k] = 1 + 2 * kind + (a > start)
    return out


def fit(texts: list[str], spans: list[list[tuple[int, int, int]]]) -> Model:
    """Maximum likelihood with an L2 penalty by full-batch gradient steps of adaptive size."""
    words = Words(pa.array(texts, pa.string()))
    rows = list(words.features({}))
    features = {f: k for k, f in enumerate(sorted({f for r in rows for f in r}))}
    at = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    ids = np.array([features[f] for r in rows for f in r], np.int64)
    gold = _labelled(words, spans)
    k = len(LABELS)
    weights, steps = np.zeros((len(features), k)), np.zeros((k, k))
    seen, walked = np.zeros_like(weights), np.zeros_like(steps)
    np.add.at(seen, (ids, gold[at]), 1.0)
    new = np.r_[True, words.run[1:] != words.run[:-1]]
    np.add.at(walked, (np.where(new, 0, np.r_[0, gold[:-1]]), gold), 1.0)
    np.add.at(walked, (gold[np.r_[new[1:], True]], 0), 1.0)
    _, mask, row, place = _padded(words.run, np.zeros((len(rows), k)))
    moments = [np.zeros_like(x) for x in (weights, steps, weights, steps)]
    for n in range(1, ROUNDS + 1):
        emissions = np.zeros((len(rows), k))
        np.add.at(emissions, at, weights[ids])
        scores = np.zeros((*mask.shape, k))
        scores[row, place] = emissions
        _, chance, counts = _marginals(scores, mask, steps)
        expected = np.zeros_like(weights)
        np.add.at(expected, ids, chance[row, place][at])
        for j, (x, gradient) in enumerate(((weights, seen - expected - PENALTY * weights), (steps, walked - counts - PENALTY * steps))):
            moments[j] = 0.9 * moments[j] + 0.1 * gradient
            moments[j + 2] = 0.99 * moments[j + 2] + 0.01 * gradient ** 2
            x += RATE * (moments[j] / (1 - 0.9 ** n)) / (np.sqrt(moments[j + 2] / (1 - 0.99 ** n)) + 1e-8)
    return Model(features, weights.round(6), steps.round(6))


def train(labelled: DataFrame, most: int = MOST_EXAMPLES) -> Model:
    """A model from a labelled table (text, spans as kind:start:end joined by commas), of at most ``most`` rows: those of the smallest hashes.

    Rows without a text are left out; missing or empty spans mean that the text has none. Without rows nothing is ever added.
    """
    rows = (labelled.where("text IS NOT NULL").orderBy(F.xxhash64("text", "spans"), "text", "spans").limit(most)
            .select("text", F.coalesce("spans", F.lit("")).alias("spans")).collect())
    spans = [[(int(a), KINDS.index(k), int(z)) for k, a, z in (s.split(":") for s in r.spans.split(",") if s)] for r in rows]
    if not any(spans):
        return Model({}, np.zeros((0, len(LABELS))), np.zeros((len(LABELS), len(LABELS))))
    return fit([r.text for r in rows], spans)


# --- Spans -----------------------------------------------------------------------------------

def plausible(kind: int, text: str) -> bool:
    """Whether a tagged text can be of its kind at all: the numbers and marks that each kind needs."""
    digits = NO_DIGIT.sub("", text)
    if KINDS[kind] == "phone":
        return 7 <= len(digits) <= 15 and not re.search(r"[^0-9 ()+./-]", text)
    if KINDS[kind] == "card":
        return 12 <= len(digits) <= 19 and luhn(digits) and not re.search(r"[^0-9 .-]", text)
    if KINDS[kind] == "ip":
        numbers = re.findall("[0-9]+", text)
        if re.fullmatch(r"[0-9]+(\W{1,3}[0-9]+){3}", text):
            return all(len(x) <= 3 and int(x) <= 255 for x in numbers)
        return bool(re.fullmatch(r"[0-9A-Fa-f:]{3,39}", text)) and 2 <= text.count(":") <= 7 and (text.count(":") == 7 or "::" in text)
    return bool(re.search(r"\w(@|[(\[][aA][tT][)\]])\w[\w-]*(\.\w[\w-]*)+$", text))


def _tagged(words: Words, labels: np.ndarray) -> Iterator[tuple[int, int, int, int]]:
    """(text, start, kind, end) of the runs of one kind; an I that follows no label of its kind begins a span."""
    starts, ends = words.characters()
    kind, inner = (labels - 1) // 2, (labels > 0) & (labels % 2 == 0)
    current = None
    for k in np.flatnonzero(labels).tolist():
        if current and inner[k] and current[2] == kind[k] and current[4] == k - 1 and words.run[k] == words.run[k - 1]:
            current[3], current[4] = int(ends[k]), k
            continue
        if current:
            yield tuple(current[:4])
        current = [int(words.text[k]), int(starts[k]), int(kind[k]), int(ends[k]), k]
    if current:
        yield tuple(current[:4])


def _find(model: Model):
    def rows(part: pa.RecordBatch):
        texts, words = part.column("text"), Words(part.column("text"))
        tagged = {}
        for text, *span in _tagged(words, model.labels(words)):
            tagged.setdefault(text, []).append(span)
        for k in np.unique(words.text).tolist():              # a text without such words has no pattern either
            text = texts[k].as_py()
            base = patterns(text)
            added, low = [], 0
            for start, kind, end in tagged.get(k, []):        # in order, as the matches are
                while low < len(base) and base[low][2] <= start:
                    low += 1
                if (low == len(base) or base[low][0] >= end) and plausible(kind, text[start:end]):
                    added.append((start, kind, end))
            spans = sorted([(*s, True) for s in base] + [(*s, False) for s in added])
            yield k, [{"kind": KINDS[kind], "start": a, "end": z, "base": b} for a, kind, z, b in spans]

    def find(batches):
        for batch in batches:
            for part in slices(batch, "text"):
                spans = [[]] * part.num_rows
                for k, found in rows(part):
                    spans[k] = found
                kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("base", pa.bool_())]))
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(spans, kind)], ["doc_id", "spans"])
    return find


def personal_data(docs: DataFrame, model: Model, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, spans) for every row: personal data in its whole text as (kind, start, end, base), by start, then kind.

    Places are characters, ends exclusive. ``base`` marks pattern matches: of each kind the leftmost that do not overlap, without those that
    fail their test. The others are what the model adds: tagged words that can be of their kind and overlap no match. A missing
    or empty text has no spans. Each row counts by itself, also when rows repeat an id or have none. Other columns are ignored.
    """
    rows = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return rows.mapInArrow(_find(model), RESULT)


def as_string(spans: Column) -> Column:
    """Spans as kind:start:end, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s.kind, s.start.cast("string"), s.end.cast("string"))), ",")
