"""Token ids as binary shards with a minimal perfect hash index from document keys to shard offsets.

Files of an output folder, all Parquet so that any store that Spark writes to will do:

* ``payload``: one row for each block of documents: shard, block, the first token's place in the shard, and ``ids``, the raw
  little-endian ids of the block's documents one after another (2 bytes each if the vocabulary allows, else 4),
  with the keys and lengths of its documents. Shards follow ascending keys.
* ``shards``: one row per shard: documents, tokens, blocks, and tokens of all shards before it.
* ``index``: one row per index part: the pilots of its hash function and, by slot, the fingerprint of the key, the shard, block,
  offset and length of its first document, and the last block that holds the key.
  A key takes one hash, one pilot and one slot, whatever the number of keys.

``fetch`` goes from keys through the index to the blocks that hold them and takes the ids from there.
"""

import os
from array import array
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from cohortlens.llm.words import U, mix, slices
from cohortlens.plans.sizing import lookup_join
from cohortlens.plans.staging import stage

END_ID = 2
BLOCK_TOKENS = 1 << 18
CACHED_CHUNKS = 1_200_000      # distinct chunks of text whose ids a worker keeps, about 200 bytes each
JOINED = 64                    # chunks that are encoded as one text
ENCODED_BYTES = 4 << 20        # of text that is encoded at once
KEYS_PER_PART = 50_000
KEYS_PER_PILOT = 4
PILOTS_TRIED = 1 << 14         # times keys, in one round
PAYLOAD = ("shard int, block int, first_token long, width int, keys binary, lengths binary, key_missing binary, ids binary")
# What the index holds of a key, by slot.
PLACE = {"shard": "<i4", "block": "<i4", "offset": "<i8", "length": "<i8", "last_shard": "<i4", "last_block": "<i4"}
INDEX = ", ".join(["part int, keys long, pilots binary, fingerprints binary", *(f"{c} binary" for c in PLACE)])
FOUND = ", ".join(["doc_id long", *(f"{c} {'int' if kind == '<i4' else 'long'}" for c, kind in PLACE.items())])
NAMED_SHARDS = 256             # so many shards are named in the filter of a fetch


class Encoder:
    """The ids of whole texts, from the ids of the chunks that a blank starts.

    The pre-tokenizer never joins characters across the start of a blank that follows other text, so chunks between
    blanks encode alone as they do in place, and most repeat. Texts with two blanks in a row or other white space than
    blanks and line ends do not allow that cut and are encoded whole, as are texts that hold a token added to the vocabulary,
    which the tokenizer takes before it cuts anything.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"    # a task has one core
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.dtype = np.dtype("<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4")
        self.known: dict[str, bytes] = {}
        self.blank_first = np.array([(self.tokenizer.id_to_token(i) or "").startswith("\u0120")
                                     for i in range(self.tokenizer.get_vocab_size())])
        import re
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.other_space = re.compile(r"[^\S \n]")

    def _ids(self, texts: list[str]) -> list[bytes]:
        code = "H" if self.dtype.itemsize == 2 else "I"
        return [array(code, e.ids).tobytes()
                for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _chunk_ids(self, chunks: list[str]) -> list[bytes]:
        """The ids of chunks that each begin with their only blank, many to a call: a token that begins with a blank begins
        a chunk. Every chunk has one at least, so if there are as many as chunks, each has exactly one."""
        code, size = "H" if self.dtype.itemsize == 2 else "I", self.dtype.itemsize
        joined = ["".join(chunks[i:i + JOINED]) for i in range(0, len(chunks), JOINED)]
        data = b"".join(array(code, e.ids).tobytes() for e in self.tokenizer.encode_batch_fast(joined, add_special_tokens=False))
        starts = np.flatnonzero(self.blank_first[np.frombuffer(data, self.dtype)])
        if len(starts) != len(chunks):
            return self._ids(chunks)
        at = (starts * size).tolist()
        return [data[a:z] for a, z in zip(at, [*at[1:], len(data)])]

    def uncut(self, text: str) -> bool:
        return "  " in text or any(a in text for a in self.added) or bool(self.other_space.search(text))

    def encode(self, texts: list[str]) -> list[bytes]:
        whole = {i for i, t in enumerate(texts) if self.uncut(t)}
        # A chunk after the first keeps its blank, so the two kinds cannot be mistaken for each other.
        cut = [None if i in whole else t.split(" ") for i, t in enumerate(texts)]
        known, fresh = self.known, {}
        first = [" " if c is None else c[0] for c in cut]
        wanted: set[str] = set()
        for c in cut:
            if c is not None:
                wanted.update(c[1:])
        new = [" " + w for w in wanted.difference(known)]
        heads = list({f for f, c in zip(first, cut) if c is not None})
        if new:
            fresh = {w[1:]: ids for w, ids in zip(new, self._chunk_ids(new))}
            if len(known) < CACHED_CHUNKS:
                known.update(fresh)
                fresh = {}
        head = dict(zip(heads, self._ids(heads)))
        direct = dict(zip(sorted(whole), self._ids([texts[i] for i in sorted(whole)])))
        look = (lambda w: known[w] if w in known else fresh[w]) if fresh else known.__getitem__
        return [direct[i] if c is None else head[c[0]] + b"".join(map(look, c[1:])) for i, c in enumerate(cut)]


@cache
def encoder(path: str) -> Encoder:
    return Encoder(path)


def _encode(batches: Iterator[pa.RecordBatch], path: str, end_id: int) -> Iterator[pa.RecordBatch]:
    """Blocks of documents in the order given; one input partition is one shard."""
    from pyspark import TaskContext
    shard, block, token = TaskContext.get().partitionId(), 0, 0
    make = encoder(path)
    end = np.array([end_id], make.dtype).tobytes()
    keys, ids, size = [], [], 0

    def flush():
        lengths = np.array([len(i) // make.dtype.itemsize for i in ids], "<i8")
        return pa.RecordBatch.from_arrays([
            pa.array([shard], pa.int32()), pa.array([block], pa.int32()), pa.array([token], pa.int64()),
            pa.array([make.dtype.itemsize], pa.int32()),
            pa.array([np.array([k or 0 for k in keys], "<i8").tobytes()], pa.binary()), pa.array([lengths.tobytes()], pa.binary()),
            pa.array([np.array([k is None for k in keys], bool).tobytes()], pa.binary()), pa.array([b"".join(ids)], pa.binary())],
            ["shard", "block", "first_token", "width", "keys", "lengths", "key_missing", "ids"]), int(lengths.sum())

    for batch in batches:
        for part in slices(batch, "text", ENCODED_BYTES):
            keys += part.column("doc_id").to_pylist()
            for one in make.encode([t or "" for t in part.column("text").to_pylist()]):
                ids.append(one + end)
                size += len(one) // make.dtype.itemsize + 1
            if size >= BLOCK_TOKENS:
                row, n = flush()
                yield row
                token, block, keys, ids, size = token + n, block + 1, [], [], 0
    if keys:
        yield flush()[0]


def documents_of(row: dict, asked: np.ndarray, offsets: np.ndarray, keyless: bool) -> pa.RecordBatch:
    """(doc_id, shard, offset, n_tokens, ids, indexed) of the documents of a payload row whose keys are asked for, and of those
    without a key if wanted. ``indexed`` marks those that are where the index sends their key.

    A key is compared with the stored one, so a key that was never indexed finds nothing. Its documents lie one after
    another; they begin at the place that the index names, or with the block if they began in an earlier one (offset -1).
    """
    keys, lengths = np.frombuffer(row["keys"], "<i8"), np.frombuffer(row["lengths"], "<i8")
    missing = np.frombuffer(row["key_missing"], bool)
    ends = np.cumsum(lengths)
    starts = ends - lengths
    at = np.where(offsets < 0, 0, np.minimum(np.searchsorted(starts, offsets - row["first_token"]), len(keys) - 1))
    held = (keys[at] == asked) & ~missing[at]
    first = np.zeros(len(keys), bool)
    first[at[held & (offsets >= 0)]] = True
    run = np.cumsum(np.r_[True, (keys[1:] != keys[:-1]) | (missing[1:] != missing[:-1])]) - 1
    begin = np.full(run[-1] + 1, len(keys))      # of the run that holds a place, everything from there on
    np.minimum.at(begin, run[at[held]], at[held])
    wanted = (np.arange(len(keys)) >= begin[run]) | (missing & keyless)
    ids = np.frombuffer(row["ids"], f"<u{row['width']}").astype("<u4", copy=False)
    data = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(keys), [
        None, pa.py_buffer(np.r_[0, ends].astype("<i8") * 4), pa.py_buffer(ids)])
    return pa.RecordBatch.from_arrays(
        [pa.array(keys, mask=missing), pa.array(np.full(len(keys), row["shard"], np.int32)), pa.array(row["first_token"] + starts),
         pa.array(lengths), data.cast(pa.binary()), pa.array(first)],
        ["doc_id", "shard", "offset", "n_tokens", "ids", "indexed"]).filter(pa.array(wanted))


def hash_key(keys: np.ndarray, seed: int | np.ndarray = 0) -> np.ndarray:
    return mix(mix(keys.astype(np.int64).view(U) + U(0x9E3779B97F4A7C15)) ^ (np.asarray(seed).astype(U) * U(0xD1B54A32D192ED03)))


def fingerprint(keys: np.ndarray) -> np.ndarray:
    return (hash_key(keys, 0x51ED) >> U(32)).astype("<u4")


def perfect_hash(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pilots of a minimal perfect hash of distinct keys, and each key's slot: hash and displace.

    Keys fall into groups of about KEYS_PER_PILOT; from the largest group on, each takes the first pilot that sends its
    keys to free slots. Groups of one size are placed together, round by round: of those whose slots overlap, the one that
    comes first takes them and the others go on to their next pilot. A part is built in its own task, independent of others.
    """
    n = len(keys)
    groups = max(1, -(-n // KEYS_PER_PILOT))
    base = hash_key(keys)
    group = (base % U(groups)).astype(np.int64)
    order = np.argsort(group, kind="stable")
    counts = np.bincount(group, minlength=groups)
    starts = np.cumsum(counts) - counts
    pilots, taken, slot = np.zeros(groups, "<u4"), np.zeros(n, bool), np.zeros(n, np.int64)
    for size in range(int(counts.max(initial=0)), 0, -1):
        open_groups = np.flatnonzero(counts == size)
        rows = order[starts[open_groups][:, None] + np.arange(size)]
        after = np.zeros(len(open_groups), np.int64)      # the pilot that each tries next
        while len(open_groups):
            tried = after[:, None] + np.arange(max(1, PILOTS_TRIED // (len(open_groups) * size)))
            at = (mix(base[rows][:, None, :] ^ mix(tried.astype(U) + U(1))[:, :, None]) % U(n)).astype(np.int64)
            ok = ~taken[at].any(axis=2)
            if size > 1:
                ordered = np.sort(at, axis=2)
                ok &= (ordered[:, :, 1:] != ordered[:, :, :-1]).all(axis=2)
            which = np.argmax(ok, axis=1)
            fits = np.flatnonzero(ok.any(axis=1))
            after += tried.shape[1]
            chosen = at[fits, which[fits]]
            held, first = np.unique(chosen, return_index=True)
            owner = np.zeros(n, np.int64)
            owner[held] = first // size
            wins = (owner[chosen] == np.arange(len(fits))[:, None]).all(axis=1)
            after[fits] = tried[fits, which[fits]] + 1
            done, places = fits[wins], chosen[wins]
            pilots[open_groups[done]] = tried[done, which[done]]
            slot[rows[done]] = places
            taken[places] = True
            left = np.ones(len(open_groups), bool)
            left[done] = False
            open_groups, rows, after = open_groups[left], rows[left], after[left]
    return pilots, slot


def slots_of(keys: np.ndarray, n: int, pilots: np.ndarray) -> np.ndarray:
    base = hash_key(keys)
    pilot = pilots[(base % U(len(pilots))).astype(np.int64)]
    return (mix(base ^ mix(pilot.astype(U) + U(1))) % U(n)).astype(np.int64)


def _index_part(table: pa.Table) -> pa.Table:
    """One part of the index, of distinct keys."""
    keys = table.column("doc_id").to_numpy()
    pilots, slot = perfect_hash(keys)
    put = np.empty(len(keys), np.int64)
    put[slot] = np.arange(len(keys))
    return pa.table({
        "part": pa.array([table.column("part")[0].as_py()], pa.int32()), "keys": pa.array([len(keys)], pa.int64()),
        "pilots": [pilots.tobytes()], "fingerprints": [fingerprint(keys[put]).tobytes()],
        **{c: [table.column(c).to_numpy()[put].astype(kind).tobytes()] for c, kind in PLACE.items()}})


def _look_up(part: pa.Table, asked: pa.Table) -> pa.Table:
    keys = asked.column("doc_id").to_numpy()
    found, place = np.zeros(len(keys), bool), {c: np.zeros(len(keys), kind) for c, kind in PLACE.items()}
    for row in part.to_pylist():
        slot = slots_of(keys, row["keys"], np.frombuffer(row["pilots"], "<u4"))
        found = np.frombuffer(row["fingerprints"], "<u4")[slot] == fingerprint(keys)
        place = {c: np.frombuffer(row[c], kind)[slot] for c, kind in PLACE.items()}
    return pa.table({"doc_id": asked.column("doc_id"), **place}).filter(pa.array(found))


def _part(parts: int):
    return F.pmod(F.xxhash64("doc_id"), F.lit(parts)).cast("int").alias("part")


def write(docs: DataFrame, folder: str, tokenizer: str, end_id: int = END_ID, id_column: str = "doc_id",
          text: str = "text", keys_per_part: int = KEYS_PER_PART) -> int:
    """Write payload, shards and index of ``docs`` to a new folder; returns the number of index parts.

    Documents are written in ascending key order, missing keys first; a missing text is an empty one and still gets the end id.
    Rows that repeat a key are all written, next to each other in the order of a hash of their texts, so that many of them
    fill several shards, and the index holds where they begin and end; rows without a key are written and not indexed. No rows give empty files. Other columns are ignored. ``tokenizer`` is the path of a
    tokenizer file that every executor has.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    (rows.orderBy("doc_id", F.xxhash64("text")).mapInArrow(lambda b: _encode(b, tokenizer, end_id), PAYLOAD)
     .write.option("compression", "zstd").parquet(f"{folder}/payload"))
    entries = _entries(spark, folder)
    sums = entries.groupBy("shard").agg(F.count(F.lit(1)).alias("documents"), F.sum("length").alias("tokens"),
                                        (F.max("block") + 1).alias("blocks"))
    before = Window.partitionBy(F.lit(0)).orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)   # one row per shard
    sums.withColumn("before", F.coalesce(F.sum("tokens").over(before), F.lit(0))).write.parquet(f"{folder}/shards")
    n = spark.read.parquet(f"{folder}/shards").agg(F.coalesce(F.sum("documents"), F.lit(0))).first()[0]
    parts = max(1, -(-n // keys_per_part))
    places = (entries.where("doc_id IS NOT NULL").groupBy("doc_id")
              .agg(F.min(F.struct("shard", "block", "offset", "length")).alias("first"), F.max(F.struct("shard", "block")).alias("last"))
              .select("doc_id", _part(parts), "first.*", F.col("last.shard").alias("last_shard"), F.col("last.block").alias("last_block")))
    places.groupBy("part").applyInArrow(_index_part, INDEX).write.parquet(f"{folder}/index")
    return parts


def _entries(spark: SparkSession, folder: str) -> DataFrame:
    """Key, shard, block, offset and length of every document, from the payload without its ids."""
    def entries(batches):
        for batch in batches:
            for row in batch.to_pylist():
                lengths = np.frombuffer(row["lengths"], "<i8")
                keys = pa.array(np.frombuffer(row["keys"], "<i8"), mask=np.frombuffer(row["key_missing"], bool))
                yield pa.RecordBatch.from_arrays(
                    [keys, *(pa.array(np.full(len(lengths), row[c], np.int32)) for c in ("shard", "block")),
                     pa.array(row["first_token"] + np.cumsum(lengths) - lengths), pa.array(lengths)],
                    ["doc_id", "shard", "block", "offset", "length"])
    return (spark.read.parquet(f"{folder}/payload").select("shard", "block", "first_token", "keys", "lengths", "key_missing")
            .mapInArrow(entries, "doc_id long, shard int, block int, offset long, length long"))


def look_up(spark: SparkSession, folder: str, keys: DataFrame, parts: int) -> DataFrame:
    """(doc_id, shard, block, offset, length, last_shard, last_block) of the keys that the index holds, by hash, pilot, slot and
    fingerprint: the place of the key's first document and the last block that holds it.

    A key that was never indexed passes the fingerprint once in 2**32. Missing keys are not found.
    """
    index = spark.read.parquet(f"{folder}/index")
    asked = keys.select("doc_id").where("doc_id IS NOT NULL").withColumn("part", _part(parts))
    return index.groupBy("part").cogroup(asked.groupBy("part")).applyInArrow(_look_up, FOUND)


def _block_id():
    return F.shiftleft(F.col("shard").cast("long"), 32) + F.col("block")


def _asked_blocks(spark: SparkSession, folder: str, keys: DataFrame, parts: int) -> DataFrame:
    """One row for each block that holds an asked key: its shard, and the keys with their offsets, -1 behind their first block.

    A block holds at most BLOCK_TOKENS documents and those encoded with its last one, which bounds its list.
    """
    found = look_up(spark, folder, keys, parts).withColumnsRenamed({"shard": "first_shard", "block": "first_block"})
    reach = lookup_join(found.withColumn("shard", F.explode(F.sequence("first_shard", "last_shard"))),
                        spark.read.parquet(f"{folder}/shards").select("shard", "blocks"), "shard")
    begins = F.col("shard") == F.col("first_shard")
    from_block = F.when(begins, F.col("first_block")).otherwise(0)
    to_block = F.when(F.col("shard") == F.col("last_shard"), F.col("last_block")).otherwise(F.col("blocks") - 1)
    here = reach.withColumn("block", F.explode(F.sequence(from_block, to_block)))
    offset = F.when(begins & (F.col("block") == F.col("first_block")), F.col("offset")).otherwise(-1)
    return here.groupBy("shard", _block_id().alias("block_id")).agg(
        F.collect_list(F.struct("doc_id", offset.alias("offset"))).alias("asked"))


def _read(payload: DataFrame, asked: DataFrame, keyless: bool) -> DataFrame:
    """(doc_id, shard, offset, n_tokens, ids, indexed) from the payload's blocks; the blocks are shuffled only if what
    is asked of them is too large to broadcast."""
    def documents(batches):
        for batch in batches:
            lists = batch.column("asked")
            for i, row in enumerate(batch.drop_columns(["asked"]).to_pylist()):
                asked = lists[i].values
                key, offset = ((asked.field(c).to_numpy() for c in ("doc_id", "offset")) if asked is not None
                               else (np.zeros(0, np.int64), np.zeros(0, np.int64)))
                yield documents_of(row, key, offset, keyless)
    blocks = lookup_join(payload.withColumn("block_id", _block_id()), asked.select("block_id", "asked"), "block_id",
                         "left" if keyless else "inner")
    return (blocks.select("shard", "first_token", "width", "keys", "lengths", "key_missing", "ids", "asked")
            .mapInArrow(documents, "doc_id long, shard int, offset long, n_tokens long, ids binary, indexed boolean"))


def fetch(spark: SparkSession, folder: str, keys: DataFrame, parts: int) -> DataFrame:
    """(doc_id, shard, offset, n_tokens, ids, indexed) of the documents of the asked keys, ids as little-endian 32-bit integers.

    The index leads to the blocks; if they lie in few shards, no other shard's file is read. All documents of a repeated key come,
    ``indexed`` marking the first. Keys that are asked twice come once; missing and unknown keys give nothing.
    """
    asked = stage(_asked_blocks(spark, folder, keys.select("doc_id").distinct(), parts), "asked")
    payload = spark.read.parquet(f"{folder}/payload")
    shards = [r.shard for r in asked.select("shard").distinct().limit(NAMED_SHARDS + 1).collect()]
    if len(shards) <= NAMED_SHARDS:
        payload = payload.where(F.col("shard").isin(shards))
    return _read(payload, asked, keyless=False)


def read_back(spark: SparkSession, folder: str, parts: int) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32, indexed) of every document of a folder, fetched by its key through the index;
    rows without a key, which no index can hold, come from the same blocks.

    ``start`` counts the ids of all documents before it. ``indexed`` says that the index leads from the key to the
    document's place; of rows with the same key it is true for the first, and false for rows without a key.
    """
    asked = stage(_asked_blocks(spark, folder, _entries(spark, folder).select("doc_id").distinct(), parts), "asked")
    rows = _read(spark.read.parquet(f"{folder}/payload"), asked, keyless=True)
    digests = rows.select("doc_id", "shard", "offset", "n_tokens", F.crc32("ids").alias("ids_crc32"), "indexed")
    shards = spark.read.parquet(f"{folder}/shards").select("shard", "before")
    return (lookup_join(digests, shards, "shard")
            .select("doc_id", (F.col("before") + F.col("offset")).alias("start"), "n_tokens", "ids_crc32", "indexed"))
