"""MinHash near-duplicates by min-max hashing: the minimum and the maximum under each permutation.

One pass over a set gives two values for each hash evaluation, so ``permutations`` hashes make twice as many
values. Bands never mix minima and maxima of one permutation, so a band's values are independent and two sets of
similarity s agree on a band with probability s**rows.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from cohortlens.llm.graph import components, forest
from cohortlens.llm.words import U, mix, random_words, slices, window_starts, words
from cohortlens.plans.staging import stage

PERMUTATIONS = 64
ROWS = 4                 # 32 bands: a pair of similarity 0.8 is missed with probability 5e-8
TILE = 512               # members of an undecided group that are compared with as many others in one task
COLUMNS = 1 << 15        # shared shingles of two tiles that are laid out as bits at once


def shingle_sets(batch: pa.RecordBatch, text: str, width: int):
    """For each text of a slice its sorted distinct shingles as 64-bit hashes."""
    for part in slices(batch, text):
        codes, bounds = words(part.column(text), lower=True)
        grams = codes
        for k in range(1, width):   # a shingle's hash depends on its words, their order and their number
            grams = mix(grams[:max(0, len(codes) - k)] * U(0xD6E8FEB86659FD93) + codes[k:] + U(k)) if len(codes) > k else codes[:0]
        sets = []
        for a, b in zip(bounds[:-1], bounds[1:]):
            if b - a >= width:
                sets.append(np.unique(grams[a:b - width + 1]))
            elif b > a:             # fewer words: the whole sequence is one shingle
                whole = codes[a]
                for k in range(1, b - a):
                    whole = mix(whole * U(0xA24BAED4963EE407) + codes[a + k] + U(k))[()]
                sets.append(np.array([whole ^ U(0x5555555555555555)], U))
            else:
                sets.append(codes[:0])
        yield part, sets


def _signatures(sets: list[np.ndarray], permutations: int) -> np.ndarray:
    """Minima (first half) and maxima of each non-empty set under each permutation."""
    everything = np.concatenate(sets)
    at = np.cumsum([0, *map(len, sets)])[:-1]
    out = np.empty((len(sets), 2 * permutations), U)
    factors, shifts = random_words(permutations, 11) | U(1), random_words(permutations, 12)
    for k in range(permutations):
        value = everything * factors[k]
        value ^= value >> U(32)
        value *= shifts[k] | U(1)
        out[:, k] = np.minimum.reduceat(value, at)
        out[:, permutations + k] = np.maximum.reduceat(value, at)
    return out


def _sketch(batches, id_column: str, text: str, width: int, permutations: int, rows: int):
    for batch in batches:
        for part, sets in shingle_sets(batch, text, width):
            sizes = np.array([len(s) for s in sets], np.int64)
            full = np.flatnonzero(sizes)
            bands = np.zeros((len(sets), 2 * permutations // rows), U)
            keys = [None] * len(sets)
            if len(full):
                values = _signatures([sets[i] for i in full], permutations)
                code = values[:, 0::rows].copy()
                for k in range(1, rows):
                    code = mix(code) + values[:, k::rows]
                bands[full] = mix(code)
                for i in full:      # 128 bits of the set, whatever the order
                    a, b = mix(sets[i]), mix(sets[i] + U(77))
                    keys[i] = np.array([a.sum(dtype=U), b.sum(dtype=U)]).tobytes()
            lists = pa.ListArray.from_arrays(np.arange(len(sets) + 1, dtype=np.int32) * bands.shape[1],
                                             pa.array(bands.view(np.int64).ravel()))
            yield pa.RecordBatch.from_arrays(
                [part.column(id_column).cast(pa.int64()), pa.array(sizes), pa.array(keys, pa.binary()), lists],
                ["doc_id", "n_shingles", "set_key", "bands"])


def _sets(batches, width: int):
    for batch in batches:
        for part, sets in shingle_sets(batch, "text", width):
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), pa.array([s.tobytes() for s in sets], pa.binary())], ["doc_id", "shingles"])


def _confirmed(batches, percent: int):
    """Links whose full sets reach the threshold: 100 * intersection >= percent * union, in whole numbers."""
    for batch in batches:
        keep = []
        for a, b in zip(batch.column("left").to_pylist(), batch.column("right").to_pylist()):
            a, b = np.frombuffer(a, U), np.frombuffer(b, U)
            both = np.concatenate([a, b])
            both.sort()
            common = int(np.count_nonzero(both[1:] == both[:-1]))
            keep.append(100 * common >= percent * (len(both) - common))
        yield pa.RecordBatch.from_arrays([batch.column("u"), batch.column("v")], ["u", "v"]).filter(pa.array(keep))


def _full_sets(docs: DataFrame, ids: DataFrame, width: int) -> DataFrame:
    # The ids grow with the corpus, so they are never broadcast.
    return stage(docs.join(ids.hint("merge"), "doc_id", "left_semi")
                 .mapInArrow(lambda b: _sets(b, width), "doc_id long, shingles binary").distinct(), "sets")


def _confirm(pairs: DataFrame, full: DataFrame, percent: int) -> DataFrame:
    left = full.select(F.col("doc_id").alias("u"), F.col("shingles").alias("left"))
    right = full.select(F.col("doc_id").alias("v"), F.col("shingles").alias("right"))
    return stage(pairs.join(left, "u").join(right, "v").select("u", "v", "left", "right")
                 .mapInArrow(lambda b: _confirmed(b, percent), "u long, v long"), "confirmed")


def _same_row_ids(some: DataFrame, classes: DataFrame) -> DataFrame:
    """Links between the classes that share an id, for ids that stand before different texts."""
    texts = some.groupBy("doc_id").agg(F.min("set_key").alias("a"), F.max("set_key").alias("z")).where("a < z").select("doc_id")
    return (some.join(texts, "doc_id").select("doc_id", "set_key").distinct().join(classes, "set_key")
            .select(F.col("doc_id").alias("u"), F.col("rep").alias("v")).where("u != v"))


def common_shingles(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """The size of the intersection of each left set with each right one, by bits of the shingles that both sides hold."""
    shared = np.intersect1d(np.concatenate(left), np.concatenate(right))
    out = np.zeros((len(left), len(right)), np.int32)
    for at in range(0, len(shared), COLUMNS):
        block = shared[at:at + COLUMNS]
        one, other = (np.packbits(np.stack([np.isin(block, s, assume_unique=True) for s in side]), axis=1) for side in (left, right))
        for i, row in enumerate(one):
            out[i] += np.bitwise_count(other & row).sum(axis=1, dtype=np.int32)
    return out


def _open_links(table: pa.Table, percent: int) -> pa.Table:
    """Links between members of two tiles of a group that join components, no more than join them."""
    ids, parts, tiles = (table.column(c).to_numpy() for c in ("doc_id", "component", "tile"))
    sets = [np.frombuffer(s, U) for s in table.column("shingles").to_pylist()]
    one, other = table.column("one")[0].as_py(), table.column("other")[0].as_py()
    mine, theirs = np.flatnonzero(tiles == one), np.flatnonzero(tiles == other)
    found = []
    if len(mine) and len(theirs):
        sizes = np.array([len(s) for s in sets])
        common = common_shingles([sets[i] for i in mine], [sets[i] for i in theirs])
        union = sizes[mine][:, None] + sizes[theirs][None, :] - common
        linked = (100 * common.astype(np.int64) >= percent * union) & (parts[mine][:, None] != parts[theirs][None, :])
        root: dict[int, int] = {}

        def top(x):
            while root.get(x, x) != x:
                x = root[x]
            return x
        for i, j in zip(*np.nonzero(linked)):
            a, b = top(int(parts[mine[i]])), top(int(parts[theirs[j]]))
            if a != b:
                root[max(a, b)] = min(a, b)
                found.append((int(ids[mine[i]]), int(ids[theirs[j]])))
    columns = list(zip(*found)) or [(), ()]
    return pa.table({"u": pa.array(columns[0], pa.int64()), "v": pa.array(columns[1], pa.int64())})


def near_duplicates(docs: DataFrame, id_column: str = "doc_id", text: str = "text", width: int = 5,
                    percent: int = 80, permutations: int = PERMUTATIONS, rows: int = ROWS) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for every row: the smallest id reachable over confirmed links.

    Texts are lower-cased (A-Z) and cut into words; the set of a text is its distinct ``width``-word shingles, or
    the whole sequence if it has fewer words. A text without words, or a missing one, has an empty set and links to
    nothing. Rows without an id are returned with no component and kept. Rows that repeat an id are returned once
    each and belong together, whatever their texts link to. Equal sets form a class; only its smallest id takes part in the
    search. Other columns are ignored.

    Search: in each bucket of a band every class is compared with the bucket's smallest id, one row for each
    class and band, so a group of any size costs as many comparisons as it has members. Confirmed links give components.
    What then shares a bucket but not a component is undecided. Undecided buckets that overlap form a group; its
    members' full sets are compared across components in tiles of 512 by 512, and only links that join components leave
    a tile. That work, and the sets sent to tiles, grow with the square of a group of which most members are near, yet below
    the threshold.
    """
    source = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    sketches = stage(source.mapInArrow(
        lambda b: _sketch(b, "doc_id", "text", width, permutations, rows),
        "doc_id long, n_shingles long, set_key binary, bands array<long>"), "sketches")
    some = sketches.where("doc_id IS NOT NULL AND set_key IS NOT NULL")
    classes = stage(some.groupBy("set_key").agg(F.min("doc_id").alias("rep")), "classes")
    banded = (some.join(classes.select(F.col("rep").alias("doc_id"), F.col("set_key")), ["doc_id", "set_key"])
              .select("doc_id", F.posexplode("bands").alias("band", "value")))
    buckets = banded.groupBy("band", "value").agg(F.min("doc_id").alias("leader"), F.max("doc_id").alias("last"))
    members = stage(banded.join(buckets.where("leader < last").drop("last"), ["band", "value"]), "members")
    stars = members.where("leader < doc_id").select(F.col("leader").alias("u"), F.col("doc_id").alias("v")).distinct()
    stars = stage(stars, "stars")
    full = _full_sets(source, stars.select(F.explode(F.array("u", "v")).alias("doc_id")).distinct(), width)
    links = _confirm(stars, full, percent).union(stage(_same_row_ids(some, classes), "same"))
    parts = forest(links).toDF("doc_id", "component")    # without the smallest of each component

    placed = (members.join(parts, "doc_id", "left")
              .withColumn("component", F.coalesce("component", "doc_id")))
    undecided = (placed.groupBy("band", "value")
                 .agg(F.min("component").alias("a"), F.max("component").alias("z"), F.count(F.lit(1)).alias("n"))
                 .where("a < z AND n > 2").select("band", "value"))
    left = stage(placed.join(undecided, ["band", "value"]).where("leader < doc_id")
                 .select(F.col("leader").alias("u"), F.col("doc_id").alias("v")).distinct(), "undecided")
    if not left.isEmpty():
        groups = stage(components(left), "groups").select(F.col("node").alias("doc_id"), F.col("component").alias("grp"))
        sizes = groups.groupBy("grp").agg(F.ceil(F.count(F.lit(1)) / TILE).cast("int").alias("tiles"))
        rows = (groups.join(sizes, "grp").join(parts, "doc_id", "left")
                .withColumn("component", F.coalesce("component", "doc_id"))
                .withColumn("tile", F.pmod(F.xxhash64("doc_id"), F.col("tiles")).cast("int"))
                .withColumn("_t", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
                .select("doc_id", "grp", "component", "tile", F.least("tile", "_t").alias("one"), F.greatest("tile", "_t").alias("other"))
                .join(full, "doc_id"))
        more = stage(rows.groupBy("grp", "one", "other").applyInArrow(lambda t: _open_links(t, percent), "u long, v long"), "links")
        parts = forest(parts.toDF("u", "v").union(more)).toDF("doc_id", "component")
    named = (classes.join(parts.withColumnRenamed("doc_id", "rep"), "rep", "left")
             .select("set_key", F.coalesce("component", "rep").alias("component_id")))
    return (sketches.select("doc_id", "n_shingles", "set_key").join(named, "set_key", "left")
            .select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"))
            .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True))))
