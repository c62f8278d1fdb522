"""Quality classifier: a sparse rule ensemble over text statistics, compiled into Spark column expressions.

Shallow trees are grown on resampled rows; every path from a root becomes a conjunction of thresholds. A logistic
model with a lasso penalty picks and weighs the rules. Training sees a bounded sample of labelled rows on
the driver; scoring is a sum of CASE expressions over statistics computed from the whole text, without Python.
"""

from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

FIT_ROWS = 20_000        # at most so many labelled rows are used to fit, those with the smallest hash of their id
TREES, DEPTH, LEAST_ROWS = 40, 3, 20
PENALTY, STEPS = 0.002, 400


def statistics(text: Column | str) -> dict[str, Column]:
    """Statistics of a whole text; a missing text counts as an empty one."""
    body = F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit("")).cast("string")
    # Runs are counted, not single characters, where that says the same: it builds fewer strings.
    return {
        "chars": F.length(body),
        "letters": F.length(F.regexp_replace(body, r"[^\p{L}]+", "")),
        "capitals": F.length(F.regexp_replace(body, r"[^\p{Lu}]+", "")),
        "marks": F.length(F.regexp_replace(body, r"[\p{L}\p{N}\s.,;:'\"()?-]+", "")),
        "digits": F.length(F.regexp_replace(body, r"[^0-9]+", "")),
        "stops": F.length(F.regexp_replace(body, r"[^.?!]+", "")),
        "bag": F.filter(F.split(body, r"[\s]+"), lambda w: w != ""),
        "rows": F.split(body, "\n"),
    }


def features(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with one double column f_... for each feature; none depends on a label, a language or a source."""
    counted = docs.select("*", F.struct(*[c.alias(n) for n, c in statistics(text).items()]).alias("_s"))
    s = F.col("_s")
    letters, chars = F.greatest(s["letters"], F.lit(1)), F.greatest(s["chars"], F.lit(1))
    n_words, n_rows = F.greatest(F.size(s["bag"]), F.lit(1)), F.greatest(F.size(s["rows"]), F.lit(1))
    made = {
        "f_log_words": F.log1p(F.size(s["bag"])),
        "f_letters": s["letters"] / chars,
        "f_capitals": s["capitals"] / letters,
        "f_marks": s["marks"] / chars,
        "f_marks_per_word": s["marks"] / n_words,
        "f_digits": s["digits"] / chars,
        "f_stops_per_word": s["stops"] / n_words,
        "f_word_length": s["letters"] / n_words,
        "f_distinct_words": F.size(F.array_distinct(s["bag"])) / n_words,
        "f_distinct_rows": F.size(F.array_distinct(s["rows"])) / n_rows,
        "f_words_per_row": F.log1p(n_words / n_rows),
    }
    return counted.select(*docs.columns, *[c.cast("double").alias(n) for n, c in made.items()])


@dataclass(frozen=True)
class Rule:
    """A conjunction: every (feature, above, threshold) holds. ``above`` means >, otherwise <=."""
    tests: tuple[tuple[str, bool, float], ...]

    def column(self) -> Column:
        out = F.lit(True)
        for name, above, at in self.tests:
            out = out & (F.col(name) > at if above else F.col(name) <= at)
        return out

    def array(self, x: dict[str, np.ndarray]) -> np.ndarray:
        out = np.ones(len(next(iter(x.values()))), bool)
        for name, above, at in self.tests:
            out &= (x[name] > at) if above else (x[name] <= at)
        return out


@dataclass
class RuleModel:
    bias: float
    rules: list[Rule] = field(default_factory=list)
    weights: list[float] = field(default_factory=list)

    def score(self) -> Column:
        """The probability of label 1 as one column over the features."""
        total = F.lit(self.bias)
        for rule, weight in zip(self.rules, self.weights):
            total = total + F.when(rule.column(), F.lit(weight)).otherwise(F.lit(0.0))
        return 1.0 / (1.0 + F.exp(-total))


def _split(x: np.ndarray, y: np.ndarray, names: list[str], columns: np.ndarray):
    """The best (gain, column, threshold) by the Gini index, over the midpoints of each column's values."""
    best = (1e-9, None, 0.0)
    n, ones = len(y), y.sum()
    whole = ones * (n - ones) / n
    for c in columns:
        order = np.argsort(x[:, c], kind="stable")
        v, left = x[order, c], np.cumsum(y[order])[:-1]
        size = np.arange(1, n)
        ok = (v[1:] > v[:-1]) & (size >= LEAST_ROWS) & (n - size >= LEAST_ROWS)
        if ok.any():
            right = ones - left
            impure = left * (size - left) / size + right * (n - size - right) / (n - size)
            i = np.flatnonzero(ok)[np.argmin(impure[ok])]
            if whole - impure[i] > best[0]:
                best = (whole - impure[i], c, float((v[i] + v[i + 1]) / 2))
    return best


def _paths(x, y, names, rng, tests=(), depth=DEPTH):
    if tests:
        yield Rule(tuple(sorted(tests)))
    if depth and len(y) >= 2 * LEAST_ROWS and 0 < y.sum() < len(y):
        columns = rng.choice(len(names), size=max(2, len(names) // 2), replace=False)
        _, c, at = _split(x, y, names, columns)
        if c is not None:
            above = x[:, c] > at
            for side in (False, True):
                rows = above == side
                yield from _paths(x[rows], y[rows], names, rng, (*tests, (names[c], side, at)), depth - 1)


def _lasso(r: np.ndarray, y: np.ndarray) -> tuple[float, np.ndarray]:
    """Logistic regression with an L1 penalty by accelerated proximal gradient steps; the bias is free."""
    n, m = r.shape
    step = 4 * n / max(np.linalg.norm(np.c_[r, np.ones(n)], 2) ** 2, 1e-9)
    w = z = np.zeros(m + 1)
    t, full = 1.0, np.c_[r, np.ones(n)]
    for _ in range(STEPS):
        p = 1 / (1 + np.exp(-np.clip(full @ z, -30, 30)))
        new = z - step * (full.T @ (p - y) / n)
        new[:-1] = np.sign(new[:-1]) * np.maximum(np.abs(new[:-1]) - step * PENALTY, 0)
        after = (1 + (1 + 4 * t * t) ** 0.5) / 2
        z, w, t = new + (t - 1) / after * (new - w), new, after
    return float(w[-1]), w[:-1]


def fit(x: dict[str, np.ndarray], y: np.ndarray, seed: int = 7) -> RuleModel:
    """Fit on labelled rows. Without rows of both labels the score is the smoothed share of label 1."""
    if len(y) < 2 * LEAST_ROWS or not 0 < y.sum() < len(y):
        share = (y.sum() + 1) / (len(y) + 2)
        return RuleModel(float(np.log(share / (1 - share))))
    names, rng = list(x), np.random.default_rng(seed)
    table = np.column_stack([x[n] for n in names])
    weight = np.where(y == 1, 0.5 / y.sum(), 0.5 / (len(y) - y.sum()))   # resample both labels alike
    rules: dict[Rule, np.ndarray] = {}
    for _ in range(TREES):
        rows = rng.choice(len(y), size=min(len(y), 4000), p=weight)
        for rule in _paths(table[rows], y[rows], names, rng):
            rules.setdefault(rule, rule.array(x))
    kept = [k for k, v in rules.items() if 0 < v.mean() < 1]
    bias, w = _lasso(np.column_stack([rules[k] for k in kept]).astype(float), y.astype(float))
    chosen = [i for i in np.argsort(-np.abs(w)) if abs(w[i]) > 1e-3]
    return RuleModel(bias, [kept[i] for i in chosen], [float(w[i]) for i in chosen])


def train(docs: DataFrame, labels: DataFrame, label: str = "quality", id_column: str = "doc_id", text: str = "text",
          usable: Column | None = None, fit_rows: int = FIT_ROWS) -> RuleModel:
    """Fit on at most ``fit_rows`` labelled documents; ``usable`` says which labels may be seen (default: all).

    Labels other than 0 and 1 and missing ids are left out; of repeated rows of an id any may count.
    """
    seen = labels.where(F.col(label).isin(0, 1) & F.col(id_column).isNotNull())
    seen = seen.where(usable) if usable is not None else seen
    sample = (seen.select(F.col(id_column).alias("_id"), F.col(label).cast("int").alias("_y"))
              .orderBy(F.xxhash64("_id"), "_id", "_y").limit(fit_rows))
    texts = docs.select(F.col(id_column).alias("_id"), F.col(text).alias("text"))
    rows = features(texts.join(F.broadcast(sample), "_id")).drop("text").toPandas()   # at most fit_rows ids
    rows = rows.sort_values(list(rows.columns), kind="stable")
    return fit({n: rows[n].to_numpy() for n in rows.columns if n.startswith("f_")}, rows["_y"].to_numpy())


def score(docs: DataFrame, model: RuleModel, text: str = "text", threshold: float = 0.7) -> DataFrame:
    """``docs`` with ``score`` (0 to 1) and ``predicted`` (1 from ``threshold`` on).

    Every row gets a score, empty and missing texts too; columns of ``docs`` by these names are replaced.
    """
    rest = [c for c in docs.columns if c not in ("score", "predicted")]
    scored = features(docs.select(*[F.col(f"`{c}`") for c in rest]), text).withColumn("score", model.score())
    return scored.select(*[F.col(f"`{c}`") for c in rest], "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def held_out(id_column: str = "doc_id") -> Column:
    """The fold that training never sees: crc32 of the id as text leaves 2 when divided by 4."""
    return F.coalesce(F.crc32(F.col(id_column).cast("string").cast("binary")) % 4 == 2, F.lit(False))
