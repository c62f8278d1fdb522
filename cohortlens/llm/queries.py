"""The operators of this subpackage as queries over the synthetic corpus tables."""

from pyspark.sql import DataFrame, SparkSession, functions as F

from cohortlens.llm import (
    anchors, backoff, decontaminate, fingerprints, licences, mixing, near_dedup, negatives, personal, personal_examples,
    quality, search, suffixes, token_output,
)
from cohortlens.plans.staging import fresh_path, stage

QUERIES, SQL = {}, {}


def query(function):
    QUERIES[function.__name__] = function
    return function


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def tokenizer() -> str:
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json")


@query
def op1_token_output(spark: SparkSession, sf: str) -> DataFrame:
    """Every document's place, length and checksum in the token files, found through their index."""
    folder = fresh_path(spark, "tokens")
    parts = token_output.write(table(spark, sf, "documents"), folder, tokenizer())
    return token_output.read_back(spark, folder, parts)


@query
def op2_suffix_array_dedup(spark: SparkSession, sf: str) -> DataFrame:
    """What is left of every document without strings of 200 bytes that also start anywhere else."""
    left = suffixes.repeated_bytes(table(spark, sf, "documents"), width=200)
    return left.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


@query
def op3_source_mix(spark: SparkSession, sf: str) -> DataFrame:
    """The words that a mix of the sources by their weights takes of each document."""
    docs = table(spark, sf, "documents").select("doc_id", "source", mixing.word_count("text").alias("size"))
    return mixing.mixed(stage(docs, "sizes")).select(
        "doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))


SQL["op3_source_mix"] = """
WITH RECURSIVE sized AS (
  SELECT doc_id, source,
         CASE WHEN text IS NULL THEN 0 ELSE len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) END::BIGINT AS size
  FROM documents),
sums AS (
  SELECT source, sum(size)::DOUBLE AS s, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS place FROM sized GROUP BY source),
placed AS (
  SELECT source, s, CASE place % 3 WHEN 0 THEN 3.0 WHEN 1 THEN 1.0 ELSE 2.0 END::DOUBLE AS w, 2.0::DOUBLE * s AS room FROM sums),
-- A source is full once the level reaches room / w, so sources fill up in that order and each prefix of it gives a level.
levels AS (
  SELECT source, s, w, room, 1.5::DOUBLE * (SELECT sum(s) FROM placed) AS everything,
         coalesce(sum(room) OVER before, 0) AS full_room, (SELECT sum(w) FROM placed) - coalesce(sum(w) OVER before, 0) AS open_w
  FROM placed WINDOW before AS (ORDER BY room / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
level AS (   -- the first level that does not fill the source it is taken at
  SELECT (everything - full_room) / open_w AS filled FROM levels WHERE w * ((everything - full_room) / open_w) <= room
  ORDER BY room / w, source NULLS LAST LIMIT 1),
targets AS (
  SELECT source, s, least(w * coalesce((SELECT filled FROM level), room / w), room) AS target FROM placed),
ranked AS (
  SELECT d.doc_id, d.size, t.s, t.target, CASE WHEN t.s > 0 THEN t.target / t.s ELSE 0 END AS rate,
         row_number() OVER (PARTITION BY d.source ORDER BY d.size, d.doc_id) - 1 AS k,
         ('0x' || substr(md5('mix' || coalesce('s' || d.source, '')), 1, 8))::BIGINT::DOUBLE / 4294967296.0::DOUBLE AS u
  FROM sized d JOIN targets t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, s::BIGINT AS source_size, target,
       ((floor(rate * (k + 1) + u) - floor(rate * k + u)) * size)::BIGINT AS taken
FROM ranked
"""


@query
def op4_minhash_near_dedup(spark: SparkSession, sf: str) -> DataFrame:
    """Classes of documents whose sets of 2-word shingles have a similarity of at least 0.8."""
    return near_dedup.near_duplicates(table(spark, sf, "documents"), width=2, percent=80)


@query
def op5_licence_scan(spark: SparkSession, sf: str) -> DataFrame:
    """The licence family of every document, from its whole text."""
    docs = table(spark, sf, "documents")
    return licences.scan(docs, licences.train(docs))


@query
def op6_substring_dedup(spark: SparkSession, sf: str) -> DataFrame:
    """What is left of every document without windows of 35 words that also start anywhere else."""
    left = anchors.repeated_words(table(spark, sf, "documents"), window=35)
    return left.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256"),
                       "n_repeats")


@query
def op7_quality_classifier(spark: SparkSession, sf: str) -> DataFrame:
    """Scores of all documents by a model fitted to the labels outside the held-out fold."""
    docs = table(spark, sf, "documents")
    model = quality.train(docs, table(spark, sf, "labels"), usable=~quality.held_out())
    return quality.score(docs, model).select("doc_id", quality.held_out().alias("held_out"), "score", "predicted")


@query
def op8_document_fingerprints(spark: SparkSession, sf: str) -> DataFrame:
    """Fingerprints of every document and of its edited text, and how alike they and the next document's are."""
    rows = (fingerprints.with_next(table(spark, sf, "documents"))
            .select("doc_id", F.length("text").cast("bigint").alias("n_chars"), "print", "next_print",
                    fingerprints.edited("text", "next_text").alias("edited")))
    return fingerprints.fingerprinted(rows, "edited", "edited_print").select(
        "doc_id", "n_chars", F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        fingerprints.as_string(F.col("print")).alias("fingerprint"),
        fingerprints.as_string(F.col("edited_print")).alias("edited_fingerprint"),
        fingerprints.likeness(F.col("print"), F.col("edited_print")).alias("near_edited"),
        fingerprints.likeness(F.col("print"), F.col("next_print")).alias("near_next"))


@query
def op9_lm_scores(spark: SparkSession, sf: str) -> DataFrame:
    """Stupid-backoff scores of all documents by trigram counts of all other documents."""
    return backoff.scores(table(spark, sf, "documents"), order=3)


@query
def op10_benchmark_decontamination(spark: SparkSession, sf: str) -> DataFrame:
    """Occurrences of benchmark items in documents, exact or with few edits."""
    return decontaminate.contaminated(table(spark, sf, "documents"), table(spark, sf, "benchmark"))


@query
def op13_lexical_search(spark: SparkSession, sf: str) -> DataFrame:
    """The 20 documents that score highest for each benchmark item."""
    return search.search(table(spark, sf, "documents"), table(spark, sf, "benchmark"))


SQL["op13_lexical_search"] = r"""
WITH words AS (
  SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS t FROM documents),
wanted AS (
  SELECT item_id, t, count(*) AS q FROM (
    SELECT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS t FROM benchmark) GROUP BY ALL),
sizes AS (SELECT doc_id, count(*) AS n FROM words GROUP BY doc_id),
totals AS (SELECT count(*) AS docs, sum(n)::BIGINT AS len FROM sizes),
tfs AS (SELECT doc_id, t, count(*) AS tf FROM words WHERE t IN (SELECT t FROM wanted) GROUP BY ALL),
weights AS (SELECT t, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w FROM tfs, totals GROUP BY t, docs),
impacts AS (
  SELECT doc_id, t, w * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * docs) // len))) AS impact
  FROM tfs JOIN weights USING (t) JOIN sizes USING (doc_id), totals),
scored AS (SELECT item_id, doc_id, sum(q * impact)::BIGINT AS score FROM wanted JOIN impacts USING (t) GROUP BY ALL HAVING sum(q * impact) > 0)
SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INTEGER AS rank, doc_id, score FROM scored
QUALIFY rank <= 20
"""


@query
def op12_hard_negatives(spark: SparkSession, sf: str) -> DataFrame:
    """Hard negatives of every hundredth vector: rows of other labels that score just below its positives."""
    x = F.col("embedding")
    finite = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))))
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = table(spark, sf, "embeddings").where(finite).select(
        "vec_id", moved.alias("label"), F.transform(x, lambda c: F.floor(c.cast("double") * 256)).alias("vector"))
    return negatives.hard_negatives(rows, F.col("vec_id") % 100 == 0)


SQL["op12_hard_negatives"] = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS q
  FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.vec_id AS anchor_id, a.label AS mine, v.vec_id, v.label, list_inner_product(a.q, v.q)::BIGINT AS score
  FROM v a, v WHERE a.vec_id % 100 = 0 AND v.vec_id <> a.vec_id),
p AS (
  SELECT * FROM s WHERE label = mine QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT p.anchor_id, p.vec_id AS positive_id,
       row_number() OVER (PARTITION BY p.anchor_id, p.vec_id ORDER BY s.score DESC, s.vec_id)::INTEGER AS rank,
       s.vec_id AS negative_id, p.score AS positive_score, s.score AS negative_score
FROM p JOIN s ON p.anchor_id = s.anchor_id AND s.label <> s.mine AND 80 * p.score <= 100 * s.score AND 100 * s.score <= 100 * p.score
QUALIFY rank <= 5
"""


@query
def op11_personal_data(spark: SparkSession, sf: str) -> DataFrame:
    """Personal data in every document: matches of fixed patterns, and what the tagger adds."""
    labelled = spark.createDataFrame(personal_examples.examples(), "text string, spans string")
    found = personal.personal_data(table(spark, sf, "documents"), personal.train(labelled))
    base = F.filter("spans", lambda s: s.base)
    count = lambda kind: F.size(F.filter("spans", lambda s: s.base & (s.kind == kind))).cast("bigint")
    return found.select(
        "doc_id", *[count(kind).alias(f"n_{kind}") for kind in personal.KINDS],
        F.sha2(personal.as_string(base).cast("binary"), 256).alias("base_sha256"), personal.as_string(F.col("spans")).alias("spans"),
        F.size(F.filter("spans", lambda s: ~s.base)).cast("bigint").alias("n_added"))
