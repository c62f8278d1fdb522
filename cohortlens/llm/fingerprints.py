"""Homomorphic fingerprints of documents, with DataFrame functions only.

A text is cut into pieces: paragraphs at line ends, those into sentences, and longer ones every 160 characters. A piece is hashed
to a vector of 240 signs; the fingerprint of a text is the sum of its pieces' vectors and their number. Three counters of
20 bits share a number, and sums are taken modulo 2**60, so they form a group: the order of pieces does
not matter, and pieces can be added to or taken from a fingerprint without the rest of the text (``combine``).

Equal multisets of pieces have equal fingerprints. Unequal ones differ unless 240 sums agree. As the signs are random, the
inner product of two fingerprints estimates the pieces that the texts share.
"""

from pyspark.sql import Column, DataFrame, functions as F

from cohortlens.plans.numbering import number_rows
from cohortlens.plans.staging import stage

PIECE = r"[^\n.!?]{1,160}[\n.!?]*|[\n.!?]+"      # every character of a text lies in one piece
HASHES, SHIFTS, COUNTER = 4, 20, 20
LOWEST = (1 << 40) | (1 << 20) | 1               # the lowest bit of each of a number's three counters
MODULUS = (1 << 60) - 1
LANES = HASHES * SHIFTS * 3


def text_of(column: Column | str) -> Column:
    return F.coalesce((F.col(column) if isinstance(column, str) else column).cast("string"), F.lit(""))


def _hashes(pieces: Column, seed: int) -> Column:
    return F.transform(pieces, lambda piece: F.xxhash64(piece, F.lit(seed)))


def _sum(hashes: Column, shift: int) -> Column:
    def add(total: Column, h: Column) -> Column:
        return (total + F.shiftright(h, shift).bitwiseAND(F.lit(LOWEST))).bitwiseAND(F.lit(MODULUS))
    return F.aggregate(hashes, F.lit(0).cast("bigint"), add)


def fingerprinted(df: DataFrame, text: str, name: str) -> DataFrame:
    """``df`` with the fingerprint of a text column: 80 numbers of three counters each, and the number of pieces.

    A missing text counts as an empty one, whose fingerprint is all zeros. Each step is a projection of its own, so that pieces
    and hashes are made once.
    """
    # The pattern cannot stall: its two branches begin with different characters.
    cut = df.withColumn("_pieces", F.regexp_extract_all(text_of(text), F.lit(PIECE), F.lit(0)))
    hashed = cut.select("*", *[_hashes(F.col("_pieces"), k).alias(f"_h{k}") for k in range(HASHES)])
    sums = [_sum(F.col(f"_h{k}"), s) for k in range(HASHES) for s in range(SHIFTS)]
    return (hashed.withColumn(name, F.array(*sums, F.size("_pieces").cast("bigint")))
            .drop("_pieces", *[f"_h{k}" for k in range(HASHES)]))


def combine(one: Column, other: Column, sign: int = 1) -> Column:
    """The fingerprint of the pieces of both, or with sign -1 of the first's without the second's."""
    add = (lambda a, b: (a + b).bitwiseAND(F.lit(MODULUS))) if sign > 0 else (
        lambda a, b: (a - b + F.lit(MODULUS + 1)).bitwiseAND(F.lit(MODULUS)))
    return F.zip_with(one, other, add)


def _product(a: Column, b: Column) -> Column:
    """The mean over all lanes of the product of the sums of signs."""
    na, nb = F.element_at(a, -1), F.element_at(b, -1)
    low = F.lit((1 << COUNTER) - 1)

    def lane(x: Column, n: Column, at: int) -> Column:
        return (2 * F.shiftright(x, at * COUNTER).bitwiseAND(low) - n).cast("double")
    each = F.zip_with(F.slice(a, 1, HASHES * SHIFTS), F.slice(b, 1, HASHES * SHIFTS), lambda x, y: (
        lane(x, na, 0) * lane(y, nb, 0) + lane(x, na, 1) * lane(y, nb, 1) + lane(x, na, 2) * lane(y, nb, 2)))
    return F.aggregate(each, F.lit(0.0), lambda total, x: total + x) / LANES


def likeness(a: Column, b: Column) -> Column:
    """An estimate of what two texts share of all their pieces, 0 to 1; 1 for equal fingerprints."""
    ab = F.greatest(_product(a, b), F.lit(0.0))
    return F.when(a == b, 1.0).otherwise(F.least(F.lit(1.0), F.greatest(
        F.lit(0.0), F.coalesce(F.try_divide(ab, _product(a, a) + _product(b, b) - ab), F.lit(0.0)))))


def as_string(vector: Column) -> Column:
    return F.array_join(F.transform(vector, lambda x: F.lpad(F.hex(x), 15, "0")), "")


def with_next(docs: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, text, print, next_text, next_print) for every row; ``next_text`` holds as many characters of the next document
    as half the row's own (rounded down), or all.

    The next document has the next smaller id, missing ids last; after the last comes the first. Rows that share an id follow
    each other by a hash of their texts, and equal rows have the same next document. A missing text is an empty one.

    Only keys are sorted. Whole texts are shuffled once, as both joins read the same exchange; half of each follows to its owner.
    """
    own = ["_id", "_none", "_h"]
    body, smallest = text_of(text), F.lit(-(1 << 63)).cast("bigint")
    keyed = docs.select(F.coalesce(F.col(id_column).cast("bigint"), smallest).alias("_id"), F.col(id_column).isNull().alias("_none"),
                        F.xxhash64(body).alias("_h"), body.alias("text"))
    rows = fingerprinted(keyed, "text", "print")
    keys = keyed.select(*own, F.expr("length(text) div 2").cast("int").alias("_half")).distinct()
    placed = stage(number_rows(stage(keys, "keys"), ["_none", F.col("_id").desc(), "_h"]), "places")
    total = max(placed.count(), 1)
    owners = placed.select(F.pmod(F.col("n") + 1, F.lit(total)).alias("n"), *[F.col(c).alias(f"o{c}") for c in own],
                           F.col("_half").alias("_wanted"))
    needed = placed.drop("_half").join(owners, "n").drop("n")
    following = (rows.join(needed, own)
                 .select(*[F.col(f"o{c}").alias(c) for c in own], F.expr("substring(text, 1, _wanted)").alias("next_text"),
                         F.col("print").alias("next_print"))
                 .dropDuplicates(own))     # equal rows share a key, and one of them serves its owner
    return rows.join(following, own).select(
        F.when(~F.col("_none"), F.col("_id")).alias("doc_id"), "text", "print", "next_text", "next_print")


def edited(text: Column | str, next_text: Column | str) -> Column:
    """A text whose last half (rounded down) is replaced by the beginning of another."""
    whole = text_of(text)
    return F.concat(F.left(whole, F.length(whole) - F.floor(F.length(whole) / 2).cast("int")), text_of(next_text))
