"""Hard negatives from blocks in Hilbert order, chosen by zone maps.

Candidate rows are ordered along a Hilbert curve through the dimensions of greatest variance and cut into blocks, one Parquet row
each: ids, labels and the packed vectors, beside a zone map with the least and greatest component of each dimension. Interval
arithmetic over a zone gives the least and the greatest inner product that an anchor can have with any row of the block. Twice these
bounds choose the blocks that are read: for the positives, those that can reach the anchor's worst positive so far, and for the
negatives, those that can fall into the score window of one of its positives. What is read is scored in whole numbers, so the result
is exact whatever the zones leave out.

Anchors are a stated set of queries, taken in groups that are neighbours on the curve. All sizes here are bounded: blocks, groups, the cells of
groups and zones that meet in a task, and the blocks of one group that a task scores.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from cohortlens.plans.numbering import number_rows
from cohortlens.plans.staging import stage

BLOCK_ROWS = 512
GROUP_ANCHORS = 256
CELL_GROUPS, CELL_BLOCKS = 8, 4096       # groups and zones that meet in one task
SCORED_BLOCKS = 64                       # blocks that one task scores for a group
KEY_DIMENSIONS, KEY_BITS = 10, 6         # of the curve: 60 bits
EXACT = 1 << 53                          # whole numbers below it are exact as floats

BLOCK = "block long, n int, wide int, width int, ids binary, missing binary, labels binary, anchors binary, vectors binary, lo binary, hi binary"
GROUP = "g long, n int, wide int, width int, places binary, ids binary, missing binary, labels binary, floors binary, vectors binary"
CHOSEN = "g long, block long, who binary"


def hilbert(levels: np.ndarray, bits: int) -> np.ndarray:
    """The place of each row of whole numbers below 2**bits along the Hilbert curve, by gray codes and rotations of axes."""
    x = levels.T.astype(np.uint64).copy()
    one, zero = np.uint64(1), np.uint64(0)
    for bit in range(bits - 1, 0, -1):
        q = np.uint64(1 << bit)
        low = q - one
        for axis in x:
            hit = (axis & q) != 0
            swap = np.where(hit, zero, (x[0] ^ axis) & low)
            x[0] ^= np.where(hit, low, swap)
            axis ^= swap
    for i in range(1, len(x)):
        x[i] ^= x[i - 1]
    turn = np.zeros(x.shape[1], np.uint64)
    for bit in range(bits - 1, 0, -1):
        turn ^= np.where(x[-1] & np.uint64(1 << bit), np.uint64((1 << bit) - 1), zero)
    x ^= turn
    key = np.zeros(x.shape[1], np.uint64)
    for bit in range(bits - 1, -1, -1):
        for axis in x:
            key = key << one | (axis >> np.uint64(bit) & one)
    return key


def products(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """All inner products of two lists of whole-number vectors, exactly; beyond 64 bits it fails."""
    most = int(np.abs(left).max(initial=0)) * int(np.abs(right).max(initial=0)) * left.shape[1]
    if most < EXACT:
        return (left.astype(float) @ right.astype(float).T).astype(np.int64)
    if most >= 1 << 63:
        raise ValueError("inner products of these vectors may not fit 64 bits")
    return left @ right.T


def limits(anchors: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The least and the greatest inner product of each anchor with any vector between ``lo`` and ``hi``, by interval arithmetic."""
    up, down = np.maximum(anchors, 0), np.minimum(anchors, 0)
    return products(up, lo) + products(down, hi), products(up, hi) + products(down, lo)


def _padded(column: pa.ListArray, wide: int) -> np.ndarray:
    """Vectors as rows of one array, shorter ones filled up with zeros."""
    sizes = np.asarray(column.value_lengths())
    out = np.zeros((len(column), wide), np.int64)
    out[np.arange(wide) < sizes[:, None]] = column.flatten().to_numpy()
    return out


def _packed(values: np.ndarray) -> tuple[int, bytes]:
    """Whole numbers in as few bytes each as all of them need."""
    most = int(np.abs(values).max(initial=0))
    width = 2 if most < 1 << 15 else 4 if most < 1 << 31 else 8
    return width, values.astype(f"<i{width}").tobytes()


def _vectors(row: dict, name: str = "vectors") -> np.ndarray:
    return np.frombuffer(row[name], f"<i{row['width']}").reshape(-1, row["wide"]).astype(np.int64)


def _schema(columns: str) -> pa.Schema:
    kinds = {"long": pa.int64(), "int": pa.int32(), "binary": pa.binary()}
    return pa.schema([(name, kinds[kind]) for name, kind in (c.split() for c in columns.split(", "))])


def _moments(batches) -> Iterator[pa.RecordBatch]:
    """Count, sum and sum of squares by dimension, one row for each dimension and task."""
    n, total, squares = np.zeros(0), np.zeros(0), np.zeros(0)
    for batch in batches:
        column = batch.column("v")
        wide = max(len(n), int(np.asarray(column.value_lengths()).max(initial=0)))
        n, total, squares = (np.pad(x, (0, wide - len(x))) for x in (n, total, squares))
        values = _padded(column, wide).astype(float)
        n, total, squares = n + len(values), total + values.sum(axis=0), squares + (values ** 2).sum(axis=0)
    yield pa.RecordBatch.from_arrays([pa.array(range(len(n)), pa.int64()), pa.array(n), pa.array(total), pa.array(squares)], ["d", "n", "s", "q"])


def _keyed(dimensions: np.ndarray, centre: np.ndarray, spread: np.ndarray, wide: int):
    """Add the place on the curve: two standard deviations either way are cut into levels, all beyond is at the ends."""
    def key(batches):
        for batch in batches:
            values = _padded(batch.column("v"), wide)[:, dimensions]
            levels = np.clip(((values - centre) / (4 * spread) + 0.5) * (1 << KEY_BITS), 0, (1 << KEY_BITS) - 1).astype(np.int64)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(hilbert(levels, KEY_BITS).astype(np.int64))], [*batch.schema.names, "key"])
    return key


def _block(wide: int, block_rows: int):
    def pack(table: pa.Table) -> pa.Table:
        table = table.sort_by("n").combine_chunks()
        column = table.column("v").combine_chunks()
        values = _padded(column, wide)
        width, vectors = _packed(values)
        ids = table.column("vec_id")
        row = {"block": table.column("n")[0].as_py() // block_rows, "n": len(values), "wide": wide, "width": width,
               "ids": ids.fill_null(0).to_numpy().tobytes(), "missing": ids.is_null().to_numpy().tobytes(),
               "labels": table.column("label").to_numpy().tobytes(), "anchors": table.column("anchor").to_numpy().tobytes(), "vectors": vectors,
               "lo": values.min(axis=0).astype(f"<i{width}").tobytes(), "hi": values.max(axis=0).astype(f"<i{width}").tobytes()}
        return pa.Table.from_pylist([row], schema=_schema(BLOCK))
    return pack


def _anchors(positives: int, block_rows: int):
    """Each anchor with its place and the score of its worst positive within its own block, a bound for all other blocks."""
    def take(batches):
        for batch in batches:
            for row in batch.to_pylist():
                mine = np.flatnonzero(np.frombuffer(row["anchors"], bool))
                if not len(mine):
                    continue
                values, labels = _vectors(row), np.frombuffer(row["labels"], "<i8")
                scores = products(values[mine], values)
                scores[labels[mine][:, None] != labels] = np.iinfo(np.int64).min
                scores[np.arange(len(mine)), mine] = np.iinfo(np.int64).min
                floors = np.sort(scores, axis=1)[:, -positives] if row["n"] >= positives else np.full(len(mine), np.iinfo(np.int64).min)
                ids, missing = np.frombuffer(row["ids"], "<i8")[mine], np.frombuffer(row["missing"], bool)[mine]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(row["block"] * block_rows + mine), pa.array(ids, mask=missing), pa.array(labels[mine]), pa.array(floors),
                     pa.array(list(values[mine]), pa.list_(pa.int64()))], ["place", "vec_id", "label", "floor", "v"])
    return take


def _group(wide: int):
    def pack(table: pa.Table) -> pa.Table:
        table = table.sort_by("place").combine_chunks()
        width, vectors = _packed(_padded(table.column("v").combine_chunks(), wide))
        ids, get = table.column("vec_id"), lambda name: table.column(name).to_numpy().tobytes()
        row = {"g": table.column("g")[0].as_py(), "n": table.num_rows, "wide": wide, "width": width, "places": get("place"),
               "ids": ids.fill_null(0).to_numpy().tobytes(), "missing": ids.is_null().to_numpy().tobytes(), "labels": get("label"),
               "floors": get("floor"), "vectors": vectors}
        return pa.Table.from_pylist([row], schema=_schema(GROUP))
    return pack


def _wants_positives(group: dict, least: np.ndarray, most: np.ndarray, same: np.ndarray, other: np.ndarray) -> np.ndarray:
    """Which zones may hold a positive of which anchor: a row of its label, and a score that reaches its worst one so far."""
    return same & (most >= np.frombuffer(group["floors"], "<i8")[:, None])


def _wants_negatives(group: dict, least: np.ndarray, most: np.ndarray, same: np.ndarray, other: np.ndarray) -> np.ndarray:
    """Which zones may hold a row of another label within the window of one of the anchor's positives."""
    out = np.zeros(least.shape, bool)
    for anchor, low, high in zip(*(np.frombuffer(group[c], "<i8") for c in ("window_anchor", "low", "high"))):
        out[anchor] |= (most[anchor] >= low) & (least[anchor] <= high)
    return out & other


def _choose(wants):
    """The blocks that a cell's groups must read, with the anchors of the group that want each."""
    def choose(groups: pa.Table, zones: pa.Table) -> pa.Table:
        rows, zones = [], zones.to_pylist()
        if zones:
            lo, hi = (np.stack([_vectors({**z, "v": z[name]}, "v")[0] for z in zones]) for name in ("lo", "hi"))
            held = [np.unique(np.frombuffer(z["labels"], "<i8")) for z in zones]
            at, labels = np.repeat(np.arange(len(zones)), [len(x) for x in held]), np.concatenate(held)
            single = np.array([len(x) == 1 for x in held])
            for group in groups.to_pylist():
                least, most = limits(_vectors(group), lo, hi)
                mine = np.frombuffer(group["labels"], "<i8")
                same = np.zeros(least.shape, bool)
                for label in np.unique(mine):
                    has = np.zeros(len(zones), bool)
                    has[at[labels == label]] = True
                    same[mine == label] = has
                wanted = wants(group, least, most, same, ~(same & single))
                rows += [{"g": group["g"], "block": zones[z]["block"], "who": np.packbits(wanted[:, z]).tobytes()} for z in np.flatnonzero(wanted.any(axis=0))]
        return pa.Table.from_pylist(rows, schema=_schema(CHOSEN))
    return choose


def _chosen(groups: DataFrame, blocks: DataFrame, wants, n_groups: int, n_blocks: int) -> DataFrame:
    """Groups and zones meet in cells of bounded size; only the columns of the zone maps are read."""
    rows, columns = -(-n_groups // CELL_GROUPS), -(-n_blocks // CELL_BLOCKS)
    one = groups.withColumn("r", F.expr(f"g div {CELL_GROUPS}")).withColumn("s", F.explode(F.sequence(F.lit(0), F.lit(columns - 1))))
    zones = blocks.select("block", "wide", "width", "labels", "lo", "hi")
    other = zones.withColumn("s", F.expr(f"int(block div {CELL_BLOCKS})")).withColumn("r", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(rows - 1).cast("long"))))
    return stage(one.groupBy("r", "s").cogroup(other.groupBy("r", "s")).applyInArrow(_choose(wants), CHOSEN), "chosen")


def _scored(groups: DataFrame, blocks: DataFrame, chosen: DataFrame, score, schema: str, n_blocks: int) -> DataFrame:
    """Each group's chosen blocks, ``SCORED_BLOCKS`` of them to a task, scored with those of its anchors that want them."""
    parts = -(-n_blocks // SCORED_BLOCKS)
    piece = F.expr(f"int(block div {SCORED_BLOCKS})")
    read = (chosen.join(blocks.select("block", "n", "wide", "width", "ids", "missing", "labels", "vectors"), "block")
            .withColumn("piece", piece))
    wanted = chosen.select("g", piece.alias("piece")).distinct()
    ask = groups.join(wanted, "g")
    return ask.groupBy("g", "piece").cogroup(read.groupBy("g", "piece")).applyInArrow(score, schema)


def _asked(group: dict, block: dict):
    """The anchors that want a block, their scores with its rows, and what is known of both."""
    who = np.flatnonzero(np.unpackbits(np.frombuffer(block["who"], np.uint8), count=group["n"]))
    return (who, products(_vectors(group)[who], _vectors(block)), np.frombuffer(group["labels"], "<i8")[who],
            np.frombuffer(block["labels"], "<i8"), np.frombuffer(block["ids"], "<i8"), np.frombuffer(block["missing"], bool))


def _first(scores: np.ndarray, ids: np.ndarray, missing: np.ndarray, wanted: int) -> np.ndarray:
    """The places of the first rows: higher scores, then smaller ids, missing ids last."""
    if len(scores) > 4 * wanted:
        at = np.flatnonzero(scores >= np.partition(scores, -wanted)[-wanted])
        return at[np.lexsort((ids[at], missing[at], -scores[at]))][:wanted]
    return np.lexsort((ids, missing, -scores))[:wanted]


class Best:
    """The first rows seen so far for each of some questions."""

    def __init__(self, wanted: int):
        self.wanted, self.held = wanted, {}

    def add(self, key, scores, ids, missing) -> None:
        if key in self.held:
            scores, ids, missing = (np.concatenate([a, b]) for a, b in zip(self.held[key], (scores, ids, missing)))
        at = _first(scores, ids, missing, self.wanted)
        self.held[key] = scores[at], ids[at], missing[at]

    def floor(self, key) -> int | None:
        """The score of the last wanted row, once there are enough."""
        found = self.held.get(key)
        return int(found[0][-1]) if found and len(found[0]) == self.wanted else None


POSITIVE = "g long, anchor long, positive_id long, positive_score long"


def _score_positives(positives: int, block_rows: int):
    def score(groups: pa.Table, blocks: pa.Table) -> pa.Table:
        out = []
        for group in groups.to_pylist():
            best, places = Best(positives), np.frombuffer(group["places"], "<i8")
            for block in blocks.to_pylist():
                who, scores, mine, labels, ids, missing = _asked(group, block)
                at = block["block"] * block_rows + np.arange(block["n"])
                for k, anchor in enumerate(who.tolist()):
                    fit = (labels == mine[k]) & (at != places[anchor])
                    if (floor := best.floor(anchor)) is not None:
                        fit &= scores[k] >= floor
                    if fit.any():
                        best.add(anchor, scores[k][fit], ids[fit], missing[fit])
            out += [pa.table({"g": pa.array([group["g"]] * len(s), pa.int64()), "anchor": pa.array([anchor] * len(s), pa.int64()),
                              "positive_id": pa.array(i, mask=m), "positive_score": s}) for anchor, (s, i, m) in best.held.items()]
        return pa.concat_tables(out) if out else _schema(POSITIVE).empty_table()
    return score


NEGATIVE = "g long, anchor long, positive long, negative_id long, negative_score long"
WINDOWED = GROUP + ", window_anchor binary, low binary, high binary, number binary"


def _windows(low: int, high: int):
    """A group with the score windows of its positives: low * positive <= 100 * score <= high * positive."""
    def add(groups: pa.Table, positives: pa.Table) -> pa.Table:
        rows = groups.to_pylist()
        for row in rows:
            table = positives.sort_by([("anchor", "ascending"), ("p", "ascending")])
            anchor, score, number = (table.column(c).to_numpy().astype("<i8") for c in ("anchor", "positive_score", "p"))
            bounds = [(-(-low * s // 100), high * s // 100) for s in score.tolist()]
            row |= {"window_anchor": anchor.tobytes(), "number": number.tobytes(),
                    "low": np.array([b[0] for b in bounds], "<i8").tobytes(), "high": np.array([b[1] for b in bounds], "<i8").tobytes()}
        return pa.Table.from_pylist(rows, schema=_schema(WINDOWED))
    return add


def _score_negatives(negatives: int):
    def score(groups: pa.Table, blocks: pa.Table) -> pa.Table:
        out = []
        for group in groups.to_pylist():
            best = Best(negatives)
            windows = {}
            for a, *window in zip(*(np.frombuffer(group[c], "<i8").tolist() for c in ("window_anchor", "number", "low", "high"))):
                windows.setdefault(a, []).append(window)
            for block in blocks.to_pylist():
                who, scores, mine, labels, ids, missing = _asked(group, block)
                for k, anchor in enumerate(who.tolist()):
                    fit = (labels != mine[k]) & (scores[k] >= min(w[1] for w in windows[anchor]))
                    if not fit.any():
                        continue
                    value, name, none = scores[k][fit], ids[fit], missing[fit]
                    for number, low, high in windows[anchor]:
                        floor = best.floor((anchor, number))
                        at = (value >= (low if floor is None else max(low, floor))) & (value <= high)
                        if at.any():
                            best.add((anchor, number), value[at], name[at], none[at])
            out += [pa.table({"g": pa.array([group["g"]] * len(s), pa.int64()), "anchor": pa.array([a] * len(s), pa.int64()),
                              "positive": pa.array([p] * len(s), pa.int64()), "negative_id": pa.array(i, mask=m), "negative_score": s})
                    for (a, p), (s, i, m) in best.held.items()]
        return pa.concat_tables(out) if out else _schema(NEGATIVE).empty_table()
    return score


def _numbered(rows: DataFrame, keys: list[str], score: str, name: str, number: str, wanted: int) -> DataFrame:
    by = Window.partitionBy(*keys).orderBy(F.desc(score), F.asc_nulls_last(name))
    return rows.withColumn(number, F.row_number().over(by)).where(F.col(number) <= wanted)


def hard_negatives(rows: DataFrame, anchor: Column, id_column: str = "vec_id", label: str = "label", vector: str = "vector",
                   positives: int = 5, negatives: int = 5, low: int = 80, high: int = 100,
                   block_rows: int = BLOCK_ROWS, group_anchors: int = GROUP_ANCHORS) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) for the rows that ``anchor`` marks.

    ``vector`` is an array of whole numbers; scores are inner products. An anchor's positives are its first other rows of the same label by
    score, and a positive's negatives the first rows of another label with low * positive score <= 100 * score <= high * positive score.
    Higher scores come first, ties by smaller id, missing ids last. Fewer rows than wanted give all there are.

    Rows with no label, no vector or a missing component take no part. Shorter vectors count as filled up with zeros. Rows that repeat
    an id, or have none, are rows of their own: an anchor of which there is a copy finds the copy. ``anchor`` false or missing is no anchor.
    Products that may exceed 64 bits fail. No rows or no anchors give none. Other columns are ignored.
    """
    whole = F.col(vector).isNotNull() & F.forall(vector, lambda x: x.isNotNull())
    taken = stage(rows.where(F.col(label).isNotNull() & whole).select(
        F.col(id_column).cast("long").alias("vec_id"), F.col(label).cast("long").alias("label"),
        F.col(vector).cast("array<long>").alias("v"), F.coalesce(anchor, F.lit(False)).alias("anchor")), "vectors")
    moments = (taken.select("v").mapInArrow(_moments, "d long, n double, s double, q double").groupBy("d")
               .agg(F.sum("s").alias("s"), F.sum("q").alias("q")).orderBy("d").toPandas())     # a row for each dimension
    n, wide = taken.count(), max(1, len(moments))
    centre, squares = np.zeros(wide), np.zeros(wide)
    if n and len(moments):
        centre, squares = moments["s"].to_numpy() / n, moments["q"].to_numpy() / n
    spread = np.sqrt(np.maximum(squares - centre ** 2, 0))
    axes = np.argsort(-spread, kind="stable")[:KEY_DIMENSIONS]
    key = _keyed(axes, centre[axes], np.maximum(spread[axes], 1e-9), wide)
    keyed = taken.mapInArrow(key, "vec_id long, label long, v array<long>, anchor boolean, key long")
    placed = number_rows(keyed, ["key", "vec_id", "label", "v"])
    blocks = stage(placed.withColumn("block", F.expr(f"n div {block_rows}")).groupBy("block")
                   .applyInArrow(_block(wide, block_rows), BLOCK).orderBy("block"), "blocks")
    n_blocks = -(-n // block_rows)
    found = blocks.select("block", "n", "wide", "width", "ids", "missing", "labels", "anchors", "vectors").mapInArrow(
        _anchors(positives, block_rows), "place long, vec_id long, label long, floor long, v array<long>")
    grouped = number_rows(found, ["place"]).withColumn("g", F.expr(f"n div {group_anchors}")).groupBy("g").applyInArrow(_group(wide), GROUP)
    groups = stage(grouped, "groups")
    n_groups = groups.agg(F.coalesce(F.max("g") + 1, F.lit(0))).first()[0]

    if not n_groups:
        empty = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
        return rows.sparkSession.createDataFrame([], empty)
    chosen = _chosen(groups, blocks, _wants_positives, n_groups, n_blocks)
    first = _scored(groups, blocks, chosen, _score_positives(positives, block_rows), POSITIVE, n_blocks)
    best = stage(_numbered(first, ["g", "anchor"], "positive_score", "positive_id", "p", positives), "positives")
    windowed = stage(groups.groupBy("g").cogroup(best.groupBy("g")).applyInArrow(_windows(low, high), WINDOWED), "windows")
    chosen = _chosen(windowed, blocks, _wants_negatives, n_groups, n_blocks)
    second = _scored(windowed, blocks, chosen, _score_negatives(negatives), NEGATIVE, n_blocks)
    last = _numbered(second, ["g", "anchor", "positive"], "negative_score", "negative_id", "rank", negatives)
    names = groups.select("g", "ids", "missing").mapInArrow(_names, "g long, anchor long, anchor_id long")
    return (last.join(best.withColumnRenamed("p", "positive"), ["g", "anchor", "positive"]).join(names, ["g", "anchor"])
            .select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), "negative_id", "positive_score", "negative_score"))


def _names(batches):
    for batch in batches:
        for row in batch.to_pylist():
            ids, missing = np.frombuffer(row["ids"], "<i8"), np.frombuffer(row["missing"], bool)
            yield pa.RecordBatch.from_arrays([pa.array([row["g"]] * len(ids), pa.int64()), pa.array(range(len(ids)), pa.int64()),
                                              pa.array(ids, mask=missing)], ["g", "anchor", "anchor_id"])
