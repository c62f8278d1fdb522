"""Questions about the whole corpus, asked by groups of documents and answered by hash range.

Documents are dealt to groups of a bounded number of bytes. A group asks with its distinct keys, each once however often
the group holds it, cut by range of the key into buckets. A bucket merges the sorted keys of all groups and answers
each group with one value for each of its keys, in the same order. So a key that a third of all documents hold costs one entry for
each group, no row of one document meets the rows of another, and all traffic is packed sorted numbers.

Groups read the documents by the same exchange in every step, which Spark then runs once.
"""

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from cohortlens.llm.words import U

GROUP_BYTES = 4 << 20
FULL = 1 << 64


def total_bytes(docs: DataFrame, text: str) -> int:
    return docs.agg(F.coalesce(F.sum(F.octet_length(F.col(text))), F.lit(0))).first()[0]


def grouped(docs: DataFrame, id_column: str, text: str, group_bytes: int = GROUP_BYTES) -> tuple[DataFrame, int]:
    """(doc_id, text, g) with about ``group_bytes`` of text in each group, and the number of groups.

    Rows without an id are dealt by their text.
    """
    rows = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    groups = max(1, -(-total_bytes(rows, "text") // group_bytes))
    by = F.when(F.col("doc_id").isNull(), F.xxhash64("text")).otherwise(F.xxhash64("doc_id"))
    return rows.withColumn("g", F.pmod(by, F.lit(groups)).cast("int")), groups


def ordered(table: pa.Table) -> pa.Table:
    """The rows of a group in an order that does not depend on how they were fetched."""
    return table.sort_by([("doc_id", "ascending"), ("text", "ascending")])


def cuts(keys: np.ndarray, buckets: int) -> np.ndarray:
    """Where each bucket's share of sorted 64-bit keys begins, and the end."""
    edges = np.array([i * FULL // buckets for i in range(1, buckets)], dtype=U)
    return np.r_[0, np.searchsorted(keys, edges), len(keys)]


def key_bits(size: int, spare: int) -> int:
    """Bits of a hash that tell ``size`` keys apart but for one in 2**spare; 64 at most."""
    return min(64, max(size, 1).bit_length() + spare)


def short(keys: np.ndarray, bits: int) -> np.ndarray:
    """The leading bits of hashes, the others zero."""
    return keys >> U(64 - bits) << U(64 - bits)


def pack(values: np.ndarray) -> bytes:
    """Sorted 64-bit numbers, without trailing zero bits that all have, as steps of 4 bytes where they fit, else as they are."""
    shift = 0
    if len(values):
        every = int(np.bitwise_or.reduce(values))
        shift = (every & -every).bit_length() - 1 if every else 0
        steps = np.diff(values >> U(shift))
        if not len(steps) or steps.max() < 1 << 32:
            return bytes([4, shift]) + (values[:1] >> U(shift)).tobytes() + steps.astype("<u4").tobytes()
    return bytes([8, shift]) + (values >> U(shift)).astype("<u8").tobytes()


def unpack(data: bytes) -> np.ndarray:
    if data[0] == 8:
        return np.frombuffer(data, "<u8", offset=2).astype(U) << U(data[1])
    values = np.empty((len(data) - 10) // 4 + 1, U)
    values[0] = np.frombuffer(data, "<u8", 1, 2)[0]
    values[1:] = np.frombuffer(data, "<u4", offset=10)
    return np.cumsum(values, dtype=U) << U(data[1])


def narrow(counts: np.ndarray) -> bytes:
    """Counts of 0 or more as one byte each, and those of 255 or more as eight bytes behind."""
    wide = counts[counts >= 255].astype("<u8")
    return np.minimum(counts, 255).astype(np.uint8).tobytes() + wide.tobytes()


def widen(data: bytes, n: int) -> np.ndarray:
    counts = np.frombuffer(data, np.uint8, n).astype(np.int64)
    counts[counts == 255] = np.frombuffer(data, "<u8", offset=n)
    return counts


def order_by(high: np.ndarray, low: np.ndarray) -> np.ndarray:
    """An order by both; ``low`` only matters where ``high`` collides."""
    order = np.argsort(high)
    h, l = high[order], low[order] | U(1)
    return np.lexsort((low | U(1), high)) if ((h[1:] == h[:-1]) & (l[1:] != l[:-1])).any() else order


ASKED = "g int, bucket int, keys binary, more binary"
ANSWERED = "g int, bucket int, answer binary"


def ask_rows(g: int, keys: np.ndarray, more: np.ndarray, buckets: int, write=np.ndarray.tobytes) -> pa.Table:
    """One row for each bucket that has keys; ``keys`` sorted, ``more`` an array aligned with them, written by ``write``."""
    at = cuts(keys, buckets)
    filled = np.flatnonzero(np.diff(at))
    return pa.table({
        "g": pa.array([g] * len(filled), pa.int32()), "bucket": pa.array(filled, pa.int32()),
        "keys": pa.array([pack(keys[at[b]:at[b + 1]]) for b in filled], pa.binary()),
        "more": pa.array([write(more[at[b]:at[b + 1]]) for b in filled], pa.binary())})


def answer(asked: DataFrame, merge: Callable[[list[np.ndarray], list[bytes]], list[np.ndarray]]) -> DataFrame:
    """Each bucket answers its groups; ``merge`` gets their sorted keys and further bytes, and gives arrays or bytes."""
    def of(table: pa.Table) -> pa.Table:
        table = table.sort_by("g")
        keys = [unpack(k) for k in table.column("keys").to_pylist()]
        return pa.table({"g": table.column("g"), "bucket": table.column("bucket"),
                         "answer": pa.array([bytes(a) for a in merge(keys, table.column("more").to_pylist())], pa.binary())})
    return asked.groupBy("bucket").applyInArrow(of, ANSWERED)


def gathered(table: pa.Table, dtype) -> np.ndarray:
    """The answers to one group, in the order of its keys."""
    return np.frombuffer(b"".join(table.sort_by("bucket").column("answer").to_pylist()), dtype)


def merged(keys: list[np.ndarray]) -> tuple[np.ndarray, list[np.ndarray]]:
    """The distinct keys of several sorted lists, and where each list's keys stand among them, by binary search."""
    everything = np.concatenate(keys)
    everything.sort()
    new = np.ones(len(everything), bool)
    new[1:] = everything[1:] != everything[:-1]
    distinct = everything[new]
    return distinct, [np.searchsorted(distinct, k) for k in keys]


def several_places(keys: list[np.ndarray], more: list[bytes]) -> list[np.ndarray]:
    """1 for each string (64 bits of it as key, as many beside it) that has more than one place, as packed bits."""
    low = [np.frombuffer(m, "<u8") for m in more]
    high, second = np.concatenate(keys), np.concatenate(low)
    several = (second & U(1)).astype(bool)      # the lowest bit says that the group holds it more than once
    second = second | U(1)
    order = order_by(high, second)
    h, s = high[order], second[order]
    new = np.r_[True, (h[1:] != h[:-1]) | (s[1:] != s[:-1])]
    group = np.cumsum(new) - 1
    rows = np.bincount(group) + np.bincount(group, weights=several[order]).astype(np.int64)
    good = np.empty(len(h), bool)
    good[order] = rows[group] > 1
    return [np.packbits(part) for part in np.split(good, np.cumsum([len(k) for k in keys])[:-1])]


def bits(table: pa.Table, counts: list[int]) -> np.ndarray:
    """The packed answers of all buckets as one array; a bucket without keys was not asked."""
    parts = [np.unpackbits(np.frombuffer(a, np.uint8))[:n].astype(bool)
             for a, n in zip(table.sort_by("bucket").column("answer").to_pylist(), [n for n in counts if n])]
    return np.concatenate([*parts, np.empty(0, bool)])
