"""Every operator as a query over the star-schema tables, with the same query in SQL.

Stand-ins: a sample is a line item with its part, a submission is an order, a class is a brand, the
cattle table is the orders and the movement table the line items. Sequences are the embeddings with
each number turned into a base.
"""

import hashlib

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from cohortlens import functions as fn
from cohortlens.model import DEFAULT_BUCKET, DEFAULT_CRITERIA, KEY, SAMPLE_COLUMNS
from cohortlens.operators import consistency, dedup, distances, filters, report, sites, thresholds
from cohortlens.plans.curation import (
    consistify, curate, de_duplicate, full_pipeline, phylo, production_pipeline, sample_filter, save_metrics, threshold_job, update_samples,
)
from cohortlens.plans import incremental
from cohortlens.plans.staging import fresh_path, stage
from cohortlens.sources import batches, fasta, sinks, store, tables
from cohortlens.streaming.ingest import ingest_stream

QUERIES, SQL = {}, {}


def query(name: str, sql: str | None = None):
    def register(function):
        QUERIES[name] = function
        if sql is not None:
            SQL[name] = sql
        return function
    return register


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


# --- Stand-in tables -------------------------------------------------------------------------

def line_order():
    return F.struct("l_linenumber", "l_partkey", "l_suppkey", "l_shipdate").alias("_ord")


def samples(spark: SparkSession, sf: str) -> DataFrame:
    lines = table(spark, sf, "lineitem")
    parts = table(spark, sf, "part").select("p_partkey", "p_brand")
    return lines.join(parts, F.col("l_partkey") == F.col("p_partkey")).select(
        F.col("l_orderkey").alias("Submission"),
        F.when(F.col("l_returnflag") == "R", "Pass").otherwise(F.col("l_returnflag")).alias("Outcome"),
        F.when(F.col("l_linestatus") == "O", "BritishbTB").otherwise(F.col("l_linestatus")).alias("flag"),
        F.col("l_quantity").alias("pcMapped"), F.col("l_extendedprice").alias("Ncount"),
        F.col("p_brand").alias("group"), line_order())


def cattle(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "orders").where("o_totalprice > 150000").select(
        F.col("o_orderkey").alias("CVLRef"), F.col("o_orderstatus").alias("clade"),
        F.col("o_orderpriority").alias("RawEartag2"))


def movement(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "lineitem").where("l_tax >= 0.03").select(
        F.col("l_orderkey").alias("SampleName"), F.col("l_partkey").cast("string").alias("StandardEartag"),
        line_order())


def outliers(spark: SparkSession, sf: str) -> DataFrame:
    return (table(spark, sf, "orders").where("o_orderpriority = '1-URGENT' AND o_totalprice > 400000")
            .select(F.col("o_orderkey").alias("Submission")))


def brand_bounds(spark: SparkSession, sf: str) -> DataFrame:
    """A bound for most brands, as a threshold table from elsewhere would give."""
    return (table(spark, sf, "part").where("p_retailprice > 905").groupBy(F.col("p_brand").alias("clade"))
            .agg((F.max("p_retailprice") * 45).alias("maxN")))


def sequences(spark: SparkSession, sf: str) -> DataFrame:
    def base(x):
        x = x.cast("double")
        return (F.when(F.abs(x) < 0.0001, "N").when(x < -0.1, "A").when(x < 0.0, "C")
                .when(x < 0.1, "g").otherwise("T"))
    name = F.concat(F.lit("AF-"), number_of("vec_id"), F.lit("_consensus"))
    return table(spark, sf, "embeddings").select(
        name.alias("id"), F.array_join(F.transform("embedding", base), "").alias("seq"),
        F.struct("vec_id").alias("_ord"))


def number_of(key: str) -> Column:
    """An id as the middle of a name, NN-NNNNN-NN; higher digits go to the front and then to the end."""
    digits = lambda value, n: F.lpad(value.cast("string"), n, "0")
    return F.concat(digits(F.expr(f"{key} div 100000 % 100"), 2), F.lit("-"), digits(F.col(key) % 100000, 5), F.lit("-"),
                    digits(F.expr(f"{key} div 10000000 % 100"), 2))


def number_text(key: str) -> str:
    return (f"(lpad(CAST({key} // 100000 % 100 AS VARCHAR), 2, '0') || '-' || lpad(CAST({key} % 100000 AS VARCHAR), 5, '0') || '-' "
            f"|| lpad(CAST({key} // 10000000 % 100 AS VARCHAR), 2, '0'))")


SM = """sm AS (
  SELECT l_orderkey AS sub, CASE l_returnflag WHEN 'R' THEN 'Pass' ELSE l_returnflag END AS oc,
         CASE l_linestatus WHEN 'O' THEN 'BritishbTB' ELSE l_linestatus END AS fl, l_quantity AS pm,
         l_extendedprice AS nc, p_brand AS grp, l_linenumber AS ln, l_partkey AS pk, l_suppkey AS sk,
         l_shipdate AS sd
  FROM lineitem JOIN part ON l_partkey = p_partkey)"""
DD = SM + """, dd AS (
  SELECT * FROM sm QUALIFY row_number() OVER (PARTITION BY sub ORDER BY (oc = 'Pass') DESC,
    (fl = 'BritishbTB') DESC, pm DESC NULLS LAST, nc ASC NULLS LAST, ln, pk, sk, sd) = 1)"""
CA = """ca AS (SELECT o_orderkey AS k, o_orderstatus AS clade, o_orderpriority AS tag FROM orders
  WHERE o_totalprice > 150000)"""
MO = """mo AS (SELECT l_orderkey AS k, CAST(l_partkey AS VARCHAR) AS tag, l_linenumber AS ln, l_partkey AS pk,
  l_suppkey AS sk, l_shipdate AS sd FROM lineitem WHERE l_tax >= 0.03)"""
EX = "ex AS (SELECT o_orderkey AS k FROM orders WHERE o_orderpriority = '1-URGENT' AND o_totalprice > 400000)"
TH = """th AS (SELECT grp AS clade, round_even(quantile_cont(nc, 0.85), 0) AS mx FROM dd WHERE oc = 'Pass'
  GROUP BY grp)"""
BB = """bb AS (SELECT p_brand AS clade, max(p_retailprice) * 45 AS mx FROM part WHERE p_retailprice > 905
  GROUP BY p_brand)"""
PS = """ps AS (SELECT dd.* FROM dd JOIN th ON dd.grp = th.clade WHERE oc = 'Pass' AND nc BETWEEN 0 AND mx
  AND sub NOT IN (SELECT k FROM ex))"""
INC = """inc AS (SELECT * FROM ps WHERE sub IN (SELECT k FROM ca) AND sub IN (SELECT k FROM mo))"""
BEST = "sub AS \"Submission\", oc AS \"Outcome\", fl AS flag, pm AS \"pcMapped\", nc AS \"Ncount\", grp AS \"group\""
SQ = f"""sq AS (SELECT 'AF-' || {number_text('vec_id')} || '_consensus' AS id, vec_id,
  array_to_string(list_transform(embedding, lambda x: CASE WHEN abs(x::DOUBLE) < 0.0001::DOUBLE THEN 'N'
    WHEN x::DOUBLE < -0.1::DOUBLE THEN 'A' WHEN x < 0 THEN 'C' WHEN x::DOUBLE < 0.1::DOUBLE THEN 'g'
    ELSE 'T' END), '') AS seq FROM embeddings)"""
ST = SQ + """, ba AS (
  SELECT id, vec_id, p AS pos, upper(substr(seq, p, 1)) AS b
  FROM sq, LATERAL (SELECT unnest(range(1, length(seq) + 1)) AS p) r),
  st AS (SELECT pos, CAST(sum(DISTINCT CASE b WHEN 'A' THEN 1 WHEN 'C' THEN 2 WHEN 'G' THEN 4 ELSE 8 END) AS INTEGER)
    AS alleles FROM ba GROUP BY pos HAVING bool_and(b IN ('A', 'C', 'G', 'T')) AND count(DISTINCT b) > 1)"""
AL = ST + """, al AS (SELECT id, vec_id, string_agg(b, '' ORDER BY pos) AS snp_seq FROM ba
  WHERE pos IN (SELECT pos FROM st) GROUP BY id, vec_id)"""


def best_columns(df: DataFrame) -> DataFrame:
    return df.select("Submission", "Outcome", "flag", "pcMapped", "Ncount", "group")


# --- Filters ---------------------------------------------------------------------------------

@query("p1_range", """SELECT c_custkey, a AS acctbal FROM (SELECT c_custkey, nullif(c_acctbal, 0) AS a FROM customer)
  WHERE a BETWEEN 100 AND 5000""")
def p1_range(spark, sf):
    rows = table(spark, sf, "customer").select("c_custkey", F.nullif("c_acctbal", F.lit(0.0)).alias("acctbal"))
    return filters.range_filter(rows, {"acctbal": (100, 5000)})


@query("p2_member", """SELECT event_id, event_type FROM events WHERE event_type IN ('error', 'click')""")
def p2_member(spark, sf):
    return filters.member_filter(table(spark, sf, "events").select("event_id", "event_type"),
                                 {"event_type": ["error", "click"]})


@query("p3_not_member", """SELECT c_custkey, g AS segment FROM
  (SELECT c_custkey, nullif(c_mktsegment, 'BUILDING') AS g FROM customer) WHERE (g IN ('MACHINERY')) IS NOT TRUE""")
def p3_not_member(spark, sf):
    rows = table(spark, sf, "customer").select(
        "c_custkey", F.nullif("c_mktsegment", F.lit("BUILDING")).alias("segment"))
    return filters.member_filter(rows, {"not_segment": ["MACHINERY"]})


@query("p4_combined", """SELECT l_orderkey, l_linenumber, l_quantity, l_discount, l_linestatus,
  l_returnflag AS "Outcome" FROM lineitem WHERE l_returnflag = 'R' AND l_quantity BETWEEN 10 AND 40
  AND l_discount BETWEEN 0 AND 0.05 AND l_linestatus NOT IN ('F')""")
def p4_combined(spark, sf):
    rows = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_quantity", "l_discount", "l_linestatus",
        F.col("l_returnflag").alias("Outcome"))
    return filters.apply_filter(rows, {"l_quantity": [10, 40], "l_discount": [0, 0.05],
                                       "not_l_linestatus": ["F"]}, {"Outcome": ["R"]})


@query("p6_absent_values", """SELECT 'event_type' AS "column", v AS value
  FROM (VALUES ('error'), ('nowhere'), ('click'), ('never')) t(v) WHERE v NOT IN (SELECT event_type FROM events)""")
def p6_absent_values(spark, sf):
    return filters.absent_values(table(spark, sf, "events"),
                                 {"event_type": ["error", "nowhere", "click", "never"]})


@query("p7_filter_with_count", f"""WITH {SM} SELECT sub AS "Submission", nc AS "Ncount", count(*) OVER () AS passed FROM sm
  WHERE oc = 'Pass' AND nc BETWEEN 20000 AND 50000""")
def p7_filter_with_count(spark, sf):
    """The filtered rows, each with the count that was observed while they were written."""
    passed, seen = filters.filter_with_count(samples(spark, sf), {"Ncount": (20000, 50000)})
    kept = stage(passed.select("Submission", "Ncount"), "passed")
    return kept.withColumn("passed", F.lit(seen.get["number_of_passed_samples"]).cast("bigint"))


# --- One row per key -------------------------------------------------------------------------

@query("d1_best_per_key", f"WITH {DD} SELECT {BEST} FROM dd")
def d1_best_per_key(spark, sf):
    return best_columns(dedup.best_per_key(samples(spark, sf), DEFAULT_CRITERIA))


@query("d2_stage_numeric", """SELECT l_orderkey, l_partkey, l_quantity FROM
  (SELECT *, max(l_quantity) OVER w AS m, count(*) OVER w AS n FROM lineitem WINDOW w AS (PARTITION BY l_orderkey))
  WHERE n > 1 AND l_quantity <> m""")
def d2_stage_numeric(spark, sf):
    rows = table(spark, sf, "lineitem").select("l_orderkey", "l_partkey", "l_quantity")
    return dedup.stage_removals(rows, "l_quantity", "max", "l_orderkey")


@query("d2_stage_category", """SELECT l_orderkey, l_partkey, l_returnflag FROM
  (SELECT *, bool_or(l_returnflag = 'R') OVER w AS m, count(*) OVER w AS n FROM lineitem
   WINDOW w AS (PARTITION BY l_orderkey)) WHERE n > 1 AND m AND l_returnflag <> 'R'""")
def d2_stage_category(spark, sf):
    rows = table(spark, sf, "lineitem").select("l_orderkey", "l_partkey", "l_returnflag")
    return dedup.stage_removals(rows, "l_returnflag", "R", "l_orderkey")


@query("d3_first_per_key", """SELECT l_orderkey, l_partkey, l_suppkey FROM lineitem QUALIFY row_number() OVER
  (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_shipdate) = 1""")
def d3_first_per_key(spark, sf):
    rows = table(spark, sf, "lineitem").select("*", line_order())
    return dedup.first_per_key(rows, "l_orderkey", ["l_partkey", "l_suppkey"])


# --- Class thresholds ------------------------------------------------------------------------

@query("c1_class_bounded", f"""WITH {SM}, {BB} SELECT {BEST} FROM sm JOIN bb ON grp = clade
  WHERE nc BETWEEN 0 AND mx""")
def c1_class_bounded(spark, sf):
    return best_columns(thresholds.class_bounded(samples(spark, sf), brand_bounds(spark, sf)))


@query("c2_thresholds", f"WITH {DD}, {TH} SELECT clade, mx AS \"maxN\" FROM th")
def c2_thresholds(spark, sf):
    passing = filters.apply_filter(dedup.best_per_key(samples(spark, sf), DEFAULT_CRITERIA, check_values=False), {})
    return thresholds.derive_thresholds(passing)


@query("c2_quantile", """SELECT event_type, round(quantile_cont(value, 0.37), 6) AS q FROM events GROUP BY event_type""")
def c2_quantile(spark, sf):
    q = thresholds.class_quantile(table(spark, sf, "events"), "event_type", "value", 0.37, "q")
    return q.select("event_type", F.round("q", 6).alias("q"))


@query("c3_drop_excluded", f"WITH {SM}, {EX} SELECT {BEST} FROM sm WHERE sub NOT IN (SELECT k FROM ex)")
def c3_drop_excluded(spark, sf):
    return best_columns(thresholds.drop_excluded(samples(spark, sf), outliers(spark, sf)))


# --- Consistency -----------------------------------------------------------------------------

def three_tables(spark, sf) -> consistency.Keyed:
    passing = filters.apply_filter(samples(spark, sf), {})
    return {"wgs": (passing, KEY), "cattle": (cattle(spark, sf), "CVLRef"),
            "movement": (movement(spark, sf), "SampleName")}


PA = SM + ", pa AS (SELECT * FROM sm WHERE oc = 'Pass')"
KEYS = f"""WITH {PA}, {CA}, {MO}, ky AS (SELECT sub AS k FROM pa UNION SELECT k FROM ca UNION SELECT k FROM mo)"""
COMMON = "(SELECT sub FROM pa INTERSECT SELECT k FROM ca INTERSECT SELECT k FROM mo)"


@query("j1_consistent_samples", f"WITH {PA}, {CA}, {MO} SELECT {BEST} FROM pa WHERE sub IN {COMMON}")
def j1_consistent_samples(spark, sf):
    return best_columns(consistency.consistent(three_tables(spark, sf))["wgs"])


@query("j1_consistent_movement", f"""WITH {PA}, {CA}, {MO} SELECT k AS "SampleName", tag AS "StandardEartag" FROM mo
  WHERE k IN {COMMON}""")
def j1_consistent_movement(spark, sf):
    return consistency.consistent(three_tables(spark, sf))["movement"].select("SampleName", "StandardEartag")


@query("j2_missing", f"""{KEYS}
  SELECT 'wgs' AS source, k AS "key" FROM ky WHERE k NOT IN (SELECT sub FROM pa)
  UNION ALL SELECT 'cattle', k FROM ky WHERE k NOT IN (SELECT k FROM ca)
  UNION ALL SELECT 'movement', k FROM ky WHERE k NOT IN (SELECT k FROM mo)""")
def j2_missing(spark, sf):
    return consistency.missing_all(three_tables(spark, sf))


FIRST_GROUP = """fg AS (SELECT sub, grp FROM pa QUALIFY row_number() OVER
  (PARTITION BY sub ORDER BY ln, pk, sk, sd) = 1)"""


@query("j3_overwrite", f"""WITH {PA}, {CA}, {FIRST_GROUP} SELECT k AS "CVLRef", grp AS clade, tag AS "RawEartag2"
  FROM ca LEFT JOIN fg ON k = sub""")
def j3_overwrite(spark, sf):
    passing = filters.apply_filter(samples(spark, sf), {})
    return consistency.overwrite_from(cattle(spark, sf), passing)


@query("j4_consistent_cattle", f"""WITH {PA}, {CA}, {MO}, {FIRST_GROUP}
  SELECT k AS "CVLRef", grp AS clade, tag AS "RawEartag2" FROM ca JOIN fg ON k = sub WHERE k IN {COMMON}""")
def j4_consistent_cattle(spark, sf):
    keyed = three_tables(spark, sf)
    out, _ = consistency.consistent_with_counts(*[df for df, _ in keyed.values()])
    return out["cattle"]


@query("j4_counts", f"""WITH {PA}, {CA}, {MO}, cm AS {COMMON} SELECT
  (SELECT count(*) FROM pa) AS original_number_of_wgs_records,
  (SELECT count(*) FROM ca) AS original_number_of_cattle_records,
  (SELECT count(*) FROM mo) AS original_number_of_movement_records,
  (SELECT count(*) FROM pa WHERE sub IN (FROM cm)) AS consistified_number_of_wgs_records,
  (SELECT count(*) FROM ca WHERE k IN (FROM cm)) AS consistified_number_of_cattle_records,
  (SELECT count(*) FROM mo WHERE k IN (FROM cm)) AS consistified_number_of_movement_records""")
def j4_counts(spark, sf):
    keyed = three_tables(spark, sf)
    return consistency.consistent_with_counts(*[df for df, _ in keyed.values()])[1]


@query("j5_excluded", f"WITH {DD} SELECT {BEST} FROM dd WHERE oc <> 'Pass'")
def j5_excluded(spark, sf):
    deduped = stage(dedup.best_per_key(samples(spark, sf), DEFAULT_CRITERIA), "deduped")
    return best_columns(report.excluded(deduped, filters.apply_filter(deduped, {})))


# --- Exclusion report ------------------------------------------------------------------------

@query("r2_reasons", f"""WITH {DD}, {TH}, {EX} SELECT sub AS "Submission", oc AS "Outcome",
  CASE WHEN nc <= mx THEN 'Pass' ELSE 'Fail' END AS "Ncount", sub IN (SELECT k FROM ex) AS outlier
  FROM dd LEFT JOIN th ON grp = clade""")
def r2_reasons(spark, sf):
    deduped = stage(dedup.best_per_key(samples(spark, sf), DEFAULT_CRITERIA), "deduped")
    bounds = thresholds.derive_thresholds(filters.apply_filter(deduped, {}))
    return report.exclusion_reasons(deduped, bounds, outliers(spark, sf))


RP = f"""WITH {DD}, {TH}, {CA}, {MO}, {EX}, {PS}, {INC}, ks AS (
    SELECT sub AS k, oc, CASE WHEN nc <= mx THEN 'Pass' ELSE 'Fail' END AS nm, sub IN (SELECT k FROM ex) AS outl, TRUE AS w
    FROM dd LEFT JOIN th ON grp = clade WHERE sub NOT IN (SELECT sub FROM inc)
    UNION ALL SELECT k, NULL, NULL, NULL, FALSE FROM (SELECT k FROM ca UNION SELECT k FROM mo)
      WHERE k NOT IN (SELECT sub FROM dd)),
  fm AS (SELECT k, tag FROM mo QUALIFY row_number() OVER (PARTITION BY k ORDER BY ln, pk, sk, sd) = 1)
  SELECT ks.k AS "Submission", CASE WHEN ca.k IS NOT NULL THEN ca.tag ELSE fm.tag END AS eartag, oc AS "Outcome",
    nm AS "Ncount", outl AS outlier, w AS wgs_data, ca.k IS NOT NULL AS cattle_data, fm.k IS NOT NULL AS movement_data
  FROM ks LEFT JOIN ca ON ks.k = ca.k LEFT JOIN fm ON ks.k = fm.k"""


def curated(spark, sf):
    return curate(samples(spark, sf), cattle(spark, sf), movement(spark, sf), outliers(spark, sf))


@query("r5_report", RP)
def r5_report(spark, sf):
    parts = curated(spark, sf)
    return report.exclusion_report(parts["deduped"], parts["cohort"], cattle(spark, sf), movement(spark, sf),
                                   parts["bounds"], outliers(spark, sf))


@query("r3_r4_report_steps", RP)
def r3_r4_report_steps(spark, sf):
    parts = curated(spark, sf)
    cows, moves = cattle(spark, sf), movement(spark, sf)
    present = consistency.presence({"wgs": (parts["deduped"], KEY), "cattle": (cows, "CVLRef"),
                                    "movement": (moves, "SampleName")})
    rows = report.excluded(parts["deduped"], parts["cohort"])
    reasons = report.exclusion_reasons(rows, parts["bounds"], outliers(spark, sf))
    return report.add_eartag(report.presence_flags(reasons, present), cows, moves)


# --- Scalar functions ------------------------------------------------------------------------

def names(spark, sf):
    key = F.col("c_custkey").cast("string")
    number = number_of("c_custkey")
    name = (F.when(F.col("c_mktsegment") == "BUILDING", F.concat(F.lit("AFx-"), number, F.lit("-L1")))
            .when(F.col("c_mktsegment") == "MACHINERY", F.concat(F.lit("af"), number, F.lit("_consensus")))
            .when(F.col("c_mktsegment") == "HOUSEHOLD", F.concat(F.lit("x"), key, F.lit("_consensus")))
            .otherwise(F.concat(F.lit("ab-"), key)))
    return table(spark, sf, "customer").select("c_custkey", name.alias("name"))


NM = f"""nm AS (SELECT c_custkey, CASE c_mktsegment WHEN 'BUILDING' THEN 'AFx-' || num || '-L1'
  WHEN 'MACHINERY' THEN 'af' || num || '_consensus' WHEN 'HOUSEHOLD' THEN 'x' || c_custkey || '_consensus'
  ELSE 'ab-' || c_custkey END AS name FROM (SELECT *, {number_text('c_custkey')} AS num FROM customer))"""
NUMBER = r"\d{2}-\d{4,5}-\d{2}"


def number_sql(column: str) -> str:
    return f"""upper(CASE WHEN regexp_matches({column}, '{NUMBER}')
      THEN 'AF-' || regexp_extract({column}, '{NUMBER}', 0) ELSE {column} END)"""


@query("f1_submission_number", f"WITH {NM} SELECT c_custkey, {number_sql('name')} AS submission FROM nm")
def f1_submission_number(spark, sf):
    return names(spark, sf).select("c_custkey", fn.submission_number(F.col("name")).alias("submission"))


@query("f2_matrix_label", f"""WITH {NM} SELECT c_custkey, {number_sql("regexp_replace(name, '_consensus$', '')")}
  AS label FROM nm""")
def f2_matrix_label(spark, sf):
    return names(spark, sf).select("c_custkey", fn.matrix_label(F.col("name")).alias("label"))


def uris(spark, sf):
    slashes = F.when(F.col("s_acctbal") > 5000, "//").otherwise("/")
    rest = (F.when(F.col("s_nationkey") < 3, "").when(F.col("s_nationkey") < 12, "v3-2/batch/")
            .otherwise("v3-2/batch"))
    uri = F.concat(F.lit("s3://s3-csu-"), F.lpad(F.col("s_nationkey").cast("string"), 3, "0"), slashes, rest)
    return table(spark, sf, "supplier").select("s_suppkey", "s_name", uri.alias("uri"))


UR = """ur AS (SELECT s_suppkey, s_name, 's3://s3-csu-' || lpad(CAST(s_nationkey AS VARCHAR), 3, '0') ||
  CASE WHEN s_acctbal > 5000 THEN '//' ELSE '/' END || CASE WHEN s_nationkey < 3 THEN ''
  WHEN s_nationkey < 12 THEN 'v3-2/batch/' ELSE 'v3-2/batch' END AS uri FROM supplier)"""


@query("f3_f4_locations", f"""WITH {UR} SELECT s_suppkey, regexp_extract(uri, '^s3://(s3-csu-\\d{{3}})/+', 1) AS bucket,
  CASE WHEN rest = '' OR rest LIKE '%/' THEN rest ELSE rest || '/' END || 'consensus/' || s_name || '_consensus.fas'
  AS "key" FROM (SELECT *, regexp_replace(uri, '^s3://s3-csu-\\d{{3}}/+', '') AS rest FROM ur)""")
def f3_f4_locations(spark, sf):
    uri = F.col("uri")
    return uris(spark, sf).select("s_suppkey", fn.uri_bucket(uri).alias("bucket"),
                                  fn.consensus_key(uri, F.col("s_name")).alias("key"))


@query("f5_f6_listing", r"""SELECT page_id, regexp_extract(url, '^(.*)/[^/]*$', 1) AS folder,
  's3://s3-csu-003/' || regexp_extract(url, '^(.*)/[^/]*$', 1) || '/' AS location, url AS token FROM pages""")
def f5_f6_listing(spark, sf):
    line = F.concat(F.lit("2023-01-05 10:20:30  "), F.col("page_id").cast("string"), F.lit(" "), F.col("url"))
    token = fn.last_token(line)
    return table(spark, sf, "pages").select(
        "page_id", fn.directory(F.col("url")).alias("folder"),
        fn.result_location(F.col("url")).alias("location"), token.alias("token"))


@query("f7_values", """SELECT s_suppkey, nullif(nullif(CAST(s_nationkey AS VARCHAR), '7'), '11') AS nation,
  round_even(s_acctbal, 0) AS balance FROM supplier""")
def f7_values(spark, sf):
    key = F.col("s_nationkey")
    token = F.when(key == 7, "N/A").when(key == 11, "nan").otherwise(key.cast("string"))
    return table(spark, sf, "supplier").select(
        "s_suppkey", fn.null_tokens_to_null(token).alias("nation"),
        F.bround(fn.number(F.col("s_acctbal").cast("string")), 0).alias("balance"))


# --- Sources and sinks -----------------------------------------------------------------------

def batch_rows(spark, sf):
    """Customers as batch result rows, one batch per nation."""
    location = F.concat(F.lit(f"s3://{DEFAULT_BUCKET}/v3-2/FinalOut/c_nationkey="), F.col("c_nationkey"), F.lit("/"))
    number = F.concat(F.lit("AF-"), number_of("c_custkey"), F.lit("-x"))
    return table(spark, sf, "customer").select(
        "c_nationkey", number.alias("Sample"), F.col("c_acctbal").alias("pcMapped"),
        F.when(F.col("c_acctbal") > 0, "Pass").otherwise("NA").alias("Outcome"),
        F.col("c_mktsegment").alias("group"), location.alias("ResultLoc"))


BR = f"""br AS (SELECT c_custkey, 'AF-' || {number_text('c_custkey')} AS sub,
  c_acctbal, CASE WHEN c_acctbal > 0 THEN 'Pass' END AS oc, c_mktsegment,
  's3://s3-csu-003/v3-2/FinalOut/c_nationkey=' || c_nationkey || '/' AS loc FROM customer)"""
BATCH_SQL = """sub || '-x' AS "Sample", c_acctbal AS "pcMapped", oc AS "Outcome", c_mktsegment AS "group",
  loc AS "ResultLoc", sub AS "Submission\""""
BATCH_COLUMNS = ["Sample", "pcMapped", "Outcome", "group", "ResultLoc", "Submission"]


def write_batches(spark, sf, files: int = 1, comments: bool = True, depth: bool = False) -> str:
    """Batch result files in a bucket folder, two column orders, a comment in every second one, perhaps a column of their own."""
    root = fresh_path(spark, "buckets")
    rows = batch_rows(spark, sf)
    added = [(F.col("c_nationkey") * 2.5).alias("depth")] if depth else []
    rows = rows.select("*", *added)
    rows = rows.repartition("c_nationkey") if files == 1 else rows.repartition(files, F.xxhash64("Sample"))
    first = F.col("c_nationkey") < 12
    note = F.concat("ResultLoc", F.lit(" # checked" if comments else "")).alias("ResultLoc")
    target = f"{root}/{DEFAULT_BUCKET}/v3-2/FinalOut"
    (rows.where(first).write.partitionBy("c_nationkey").option("header", True).csv(target))
    (rows.where(~first).select("c_nationkey", "group", "Outcome", "Sample", "pcMapped", note, *(["depth"] if depth else []))
     .withColumnRenamed("pcMapped", " pcMapped")
     .write.mode("append").partitionBy("c_nationkey").option("header", True).csv(target))
    return root


def trimmed(df: DataFrame) -> DataFrame:
    return df.select(*[F.rtrim(c).alias(c) if c == "ResultLoc" else F.col(c) for c in BATCH_COLUMNS])


@query("s1_read_by_name", """SELECT replace(s_name, '#', '') AS "Sample", CASE WHEN s_nationkey <> 7 THEN s_acctbal END AS "pcMapped",
  CASE WHEN s_nationkey < 12 THEN CAST(s_nationkey AS DOUBLE) END AS extra FROM supplier""")
def s1_read_by_name(spark, sf):
    """Suppliers written as CSV in two column orders, with null tokens and comments, and read by name."""
    path = fresh_path(spark, "csv")
    value = F.when(F.col("s_nationkey") == 7, "nan").otherwise(F.col("s_acctbal").cast("string"))
    rows = table(spark, sf, "supplier").select(
        F.replace("s_name", F.lit("#"), F.lit("")).alias("name"), value.alias("value"),
        F.col("s_nationkey").alias("extra"))
    one = rows.where("extra < 12").select(F.col("value").alias(" pcMapped"), F.col("name").alias("Sample"), "extra")
    note = F.concat("value", F.lit(" # checked"))
    two = rows.where("extra >= 12").select(F.col("name").alias("Sample"), note.alias("pcMapped"))
    for part in (one, two):
        part.write.mode("append").option("header", True).csv(path)
    return tables.read_samples(spark, path).select("Sample", "pcMapped", "extra")


@query("s2_list_batches", f"WITH {BR} SELECT DISTINCT loc AS location FROM br")
def s2_list_batches(spark, sf):
    root = write_batches(spark, sf)
    return batches.list_batches(spark, f"{root}/{{bucket}}/").select("location").distinct()


@query("s2_new_batches", """SELECT doc_id, 'v3-2/' || source || '/FinalOut_' || doc_id || '.csv' AS "key" FROM documents
  WHERE source NOT IN (SELECT source FROM documents WHERE n_chars > 25000)""")
def s2_new_batches(spark, sf):
    key = F.concat(F.lit("v3-2/"), "source", F.lit("/FinalOut_"), F.col("doc_id").cast("string"), F.lit(".csv"))
    docs = table(spark, sf, "documents").select("doc_id", "n_chars", key.alias("key"))
    listing = docs.select("doc_id", "key", fn.result_location(F.col("key")).alias("location"))
    known = docs.where("n_chars > 25000").select(fn.result_location(F.col("key")).alias("ResultLoc"))
    return batches.new_batches(listing, known).select("doc_id", "key")


@query("s3_stream_ingest", f"WITH {BR} SELECT {BATCH_SQL} FROM br")
def s3_stream_ingest(spark, sf):
    """All batch files through the stream, run a second time to show that nothing loads twice."""
    root, target = write_batches(spark, sf), fresh_path(spark, "store")
    for _ in range(2):
        ingest_stream(spark, root, target, f"{target}-checkpoint", identity="file")
    return trimmed(store.read_store(spark, target))


@query("s3_stream_by_directory", f"WITH {BR} SELECT {BATCH_SQL} FROM br")
def s3_stream_by_directory(spark, sf):
    """Directories of several files, one file to a micro-batch; a second run finds every directory known."""
    root, target = write_batches(spark, sf, files=3), fresh_path(spark, "store")
    for _ in range(2):
        ingest_stream(spark, root, target, f"{target}-checkpoint", files_per_batch=8)
    return trimmed(store.read_store(spark, target))


@query("s4_append", f"WITH {BR} SELECT {BATCH_SQL} FROM br")
def s4_append(spark, sf):
    """All batch files appended to an empty table."""
    root = write_batches(spark, sf)
    listing = batches.list_batches(spark, f"{root}/{{bucket}}/")
    empty = tables.empty_samples(spark)
    paths = [r.path for r in batches.new_batches(listing, empty).select("path").collect()]
    rows = batches.load_batches(spark, paths, run=0)
    return trimmed(batches.append_batches(empty, rows).select(*SAMPLE_COLUMNS))


@query("s1_mixed_headers", """SELECT CAST(o_orderkey AS VARCHAR) AS "Sample", CAST(o_custkey AS DOUBLE) AS matches, o_orderpriority || '
' || o_orderstatus AS "note, quoted", CAST(o_orderkey % 1200 AS DOUBLE) AS extra FROM orders""")
def s1_mixed_headers(spark, sf):
    """Orders in files of 1,200 different headers, with commas and line breaks inside quotes; the extra numbers are typed."""
    path = fresh_path(spark, "csv")
    kind = (F.col("o_orderkey") % 1200).cast("string")
    note = F.concat(F.lit('"'), "o_orderpriority", F.lit("\n"), "o_orderstatus", F.lit('"'))
    line = F.concat_ws(",", F.col("o_orderkey").cast("string"), kind, note, F.col("o_custkey").cast("string"))
    head = F.concat(F.lit('Sample,extra,"note, quoted",matches,unused '), kind)
    rows = table(spark, sf, "orders").select(kind.alias("folder"), head.alias("head"), line.alias("line"))
    heads = rows.select("folder", F.col("head").alias("value"), F.lit(0).alias("place")).distinct()
    lines = rows.select("folder", F.col("line").alias("value"), F.lit(1).alias("place"))
    _write_files(heads.unionByName(lines), path, "{}.csv")
    return tables.read_samples(spark, path).select("Sample", "matches", "note, quoted", "extra")


@query("s6_text_table", """SELECT CAST(o_orderkey AS VARCHAR) AS "CVLRef", o_orderpriority AS "RawEartag2",
  o_orderstatus AS clade FROM orders""")
def s6_text_table(spark, sf):
    path = fresh_path(spark, "csv")
    table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("CVLRef"), F.col("o_orderpriority").alias("RawEartag2"),
        F.col("o_orderstatus").alias("clade")).write.option("header", True).csv(path)
    return tables.read_text_table(spark, path).select("CVLRef", "RawEartag2", "clade")


@query("s7_thresholds", f"WITH {BB} SELECT clade, mx AS \"maxN\" FROM bb")
def s7_thresholds(spark, sf):
    path = fresh_path(spark, "csv")
    sinks.write_table(brand_bounds(spark, sf), path)
    return tables.read_thresholds(spark, path).select("clade", "maxN")


@query("s8_exclusions", """SELECT DISTINCT c_name AS "Submission" FROM customer JOIN orders ON c_custkey = o_custkey
  WHERE o_totalprice > 300000""")
def s8_exclusions(spark, sf):
    path = fresh_path(spark, "list")
    big = table(spark, sf, "orders").where("o_totalprice > 300000")
    (table(spark, sf, "customer").join(big, F.col("c_custkey") == F.col("o_custkey"))
     .select(F.concat("c_name", F.lit("  "))).write.text(path))
    return tables.read_exclusions(spark, path)


@query("s10_s12_fasta", f"WITH {SQ} SELECT id, seq FROM sq")
def s10_s12_fasta(spark, sf):
    path = fresh_path(spark, "fasta")
    sinks.write_fasta(sequences(spark, sf), path)
    return fasta.read_fasta(spark, path).select("id", "seq")


@query("s10_read_consensus", f"WITH {SQ} SELECT id, vec_id % 7 || ' 50%' AS folder, upper(seq) AS seq FROM sq WHERE vec_id % 3 = 0")
def s10_read_consensus(spark, sf):
    """The sequences of every third sample, from folders with blanks and percent signs that hold the others as well."""
    root = fresh_path(spark, "buckets")
    n = F.col("_ord.vec_id")
    folder = F.concat((n % 7).cast("string"), F.lit(" 50%"))
    seqs = sequences(spark, sf).select("id", F.upper("seq").alias("seq"), folder.alias("folder"), n.alias("n"), "_ord")
    written = stage(seqs, "sequences")
    _write_consensus(written, f"{root}/{DEFAULT_BUCKET}")
    uri = F.concat(F.lit(f"s3://{DEFAULT_BUCKET}/v3-2/"), "folder", F.lit("/"))
    wanted = written.where("n % 3 = 0").select(F.replace("id", F.lit("_consensus"), F.lit("")).alias("Sample"),
                                               uri.alias("ResultLoc"), "folder", "_ord")
    found = fasta.read_consensus(spark, wanted, f"{root}/{{bucket}}/")
    return found.join(wanted.select("Sample", "folder"), "Sample").select("id", "folder", "seq")


def _write_consensus(seqs: DataFrame, bucket: str) -> None:
    """One file for each sequence under v3-2/<folder>/consensus/, written by the tasks that hold the sequences."""
    def write(batches):
        (system, root), made = _file_system(bucket), set()
        for batch in batches:
            for row in batch.to_pylist():
                folder = f"{root}/v3-2/{row['folder']}/consensus"
                if folder not in made:
                    system.create_dir(folder)
                    made.add(folder)
                with system.open_output_stream(f"{folder}/{row['id']}.fas") as out:
                    out.write(f">{row['id']}\n{row['seq']}\n".encode())
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows], pa.int64())], ["n"])
    rows = seqs.select("folder", "id", "seq").repartition(2 * seqs.sparkSession.sparkContext.defaultParallelism, "folder", "id")
    rows.mapInArrow(write, "n long").agg(F.sum("n")).collect()


# --- Sequences -------------------------------------------------------------------------------

@query("g1_sites", f"WITH {ST} SELECT pos, alleles FROM st")
def g1_sites(spark, sf):
    return sites.snp_sites(sequences(spark, sf))


def alignment(spark, sf) -> DataFrame:
    seqs = sequences(spark, sf)
    return sites.snp_alignment(seqs, stage(sites.snp_sites(seqs), "sites"))


@query("g1_alignment", f"WITH {AL} SELECT id, snp_seq FROM al")
def g1_alignment(spark, sf):
    return alignment(spark, sf).select("id", "snp_seq")


def sequence_batches(spark, sf) -> str:
    """Two rounds of sequences, each read once, in a folder of masks and reduced rows."""
    folder, seqs = fresh_path(spark, "masks"), sequences(spark, sf)
    for n in range(2):
        incremental.add_sequences(seqs.where(F.col("_ord.vec_id") % 5 > 2 if n else F.col("_ord.vec_id") % 5 <= 2), folder, f"round-{n}")
    return folder


@query("g1_incremental", f"WITH {ST} SELECT pos, alleles FROM st")
def g1_incremental(spark, sf):
    """Sites after two rounds of sequences, from the masks that the rounds left."""
    return incremental.stored_sites(spark, sequence_batches(spark, sf))


@query("g1_incremental_alignment", f"WITH {AL} SELECT id, snp_seq FROM al")
def g1_incremental_alignment(spark, sf):
    """All sequences reduced to the sites of both rounds, without reading a sequence again."""
    return incremental.stored_alignment(spark, sequence_batches(spark, sf)).select("id", "snp_seq")


@query("g2_snp_count", f"WITH {ST} SELECT count(*) AS number_of_snps FROM st")
def g2_snp_count(spark, sf):
    return sites.snp_count(sites.snp_sites(sequences(spark, sf)))


NEAR = 12
PAIRS = f"""WITH {AL}, pr AS (SELECT a.id AS i, b.id AS j, CAST(hamming(a.snp_seq, b.snp_seq) AS BIGINT) AS dist
  FROM al a, al b) SELECT * FROM pr WHERE dist <= {NEAR}"""


@query("g3_near_pairs", PAIRS)
def g3_near_pairs(spark, sf):
    return distances.snp_distances(alignment(spark, sf), NEAR)


LABEL = "upper('AF-' || regexp_extract(%s, '\\d{2}-\\d{4,5}-\\d{2}', 0))"


@query("g5_near_relabel", f"SELECT {LABEL % 'i'} AS i, {LABEL % 'j'} AS j, dist FROM ({PAIRS})")
def g5_near_relabel(spark, sf):
    return distances.snp_distances(distances.relabel(alignment(spark, sf)), NEAR)


# Families of mutants: 14 suppliers share a sequence of 9,600 bases, in which seven of them change 0 to 12 bases and seven copy those.
MUTANT = "s_suppkey % 7"
MU = f"""mu AS (SELECT 'AF-' || {number_text('s_suppkey')} || '_consensus' AS id, string_agg(translate(
    CASE WHEN p % 24 = 1 + 12 * ({MUTANT} % 2) AND p // 24 < {MUTANT} * 5 % 13 THEN translate(h[1], '0123456789abcdef', '1230123012301230') ELSE h[1] END
    || h[2:], '0123456789abcdef', 'ACGTACGTACGTACGT'), '' ORDER BY p) AS seq
  FROM (SELECT s_suppkey, p, md5(CAST(s_suppkey // 14 AS VARCHAR) || '-' || p) AS h FROM supplier, range(300) r(p)) GROUP BY s_suppkey)"""
MUTANT_PAIRS = f"""WITH {MU}, pr AS (SELECT a.id AS i, b.id AS j, CAST(hamming(a.seq, b.seq) AS BIGINT) AS dist
  FROM mu a, mu b) SELECT * FROM pr WHERE dist <= {NEAR}"""


def mutants(spark, sf) -> DataFrame:
    """One sequence per supplier; members of a family differ at 0 to 22 places, those of different families nearly everywhere."""
    def piece(p):
        text = F.md5(F.concat(F.expr("s_suppkey div 14").cast("string"), F.lit("-"), p.cast("string")))
        changed = (p % 24 == 1 + 12 * (F.expr(MUTANT) % 2)) & (F.floor(p / 24) < F.expr(MUTANT) * 5 % 13)
        first = F.substring(text, 1, 1)
        return F.concat(F.when(changed, F.translate(first, "0123456789abcdef", "1230123012301230")).otherwise(first), F.substring(text, 2, 31))
    bases = F.translate(F.array_join(F.transform(F.sequence(F.lit(0), F.lit(299)), piece), ""), "0123456789abcdef", "ACGTACGTACGTACGT")
    name = F.concat(F.lit("AF-"), number_of("s_suppkey"), F.lit("_consensus"))
    return built(table(spark, sf, "supplier").select("s_suppkey"), name.alias("id"), bases.alias("seq"), F.struct("s_suppkey").alias("_ord"))


def built(rows: DataFrame, *columns: Column) -> DataFrame:
    """Sequences made from the rows of a small file, by all cores and once, as several steps read them."""
    tasks = 4 * rows.sparkSession.sparkContext.defaultParallelism
    return stage(rows.repartition(tasks).select(*columns), "sequences")


def mutant_alignment(spark, sf) -> DataFrame:
    seqs = mutants(spark, sf)
    return sites.snp_alignment(seqs, stage(sites.snp_sites(seqs), "sites"))


@query("g3_near_mutants", MUTANT_PAIRS)
def g3_near_mutants(spark, sf):
    """Near pairs of different sequences, beside copies and members of a family that are further apart."""
    return distances.snp_distances(mutant_alignment(spark, sf), NEAR)


@query("g5_mutant_relabel", f"SELECT {LABEL % 'i'} AS i, {LABEL % 'j'} AS j, dist FROM ({MUTANT_PAIRS})")
def g5_mutant_relabel(spark, sf):
    return distances.snp_distances(distances.relabel(mutant_alignment(spark, sf)), NEAR)


# A clonal cohort: one sequence per part, the common genome with six sites of the part's clade and up to four of its own changed.
CLONAL_NEAR, CLONAL_SITES, CLADES = 4, 960, 25
CL = f"""ge AS (SELECT s * 32 + q AS p, md5('genome-' || s)[q + 1] AS h FROM range({CLONAL_SITES // 32}) r(s), range(32) t(q)),
  cl AS (SELECT 'AF-' || {number_text('p_partkey')} || '_consensus' AS id, string_agg(translate(h, '0123456789abcdef',
    CASE WHEN list_contains(own, p) THEN 'CGTACGTACGTACGTA' ELSE 'ACGTACGTACGTACGT' END), '' ORDER BY p) AS seq
  FROM (SELECT p_partkey, list_concat(list_transform(range(6), lambda j: (p_partkey % {CLADES} * 37 + j * 101) % {CLONAL_SITES}),
    list_transform(range(p_partkey // {CLADES} % 5), lambda j: (p_partkey * 131 + j * 211) % {CLONAL_SITES})) AS own FROM part), ge GROUP BY p_partkey)"""


def clonal_alignment(spark, sf) -> DataFrame:
    """(id, order, snp_seq): the sites of a cohort of which all members are near the same genome."""
    genome = "".join(hashlib.md5(f"genome-{n}".encode()).hexdigest() for n in range(CLONAL_SITES // 32))
    common, other = (genome.translate(str.maketrans("0123456789abcdef", bases)) for bases in ("ACGTACGTACGTACGT", "CGTACGTACGTACGTA"))
    part = F.col("p_partkey")
    clade = F.transform(F.sequence(F.lit(0), F.lit(5)), lambda j: (part % CLADES * 37 + j * 101) % CLONAL_SITES)
    changes = F.floor(part / CLADES) % 5
    private = F.when(changes > 0, F.transform(F.sequence(F.lit(0), F.greatest(changes - 1, F.lit(0))), lambda j: (part * 131 + j * 211) % CLONAL_SITES))
    own = F.filter(F.concat(clade, F.coalesce(private, F.array().cast("array<bigint>"))), lambda p: p.isNotNull())
    seq = F.aggregate(own, F.lit(common), lambda text, p: F.overlay(text, F.substr(F.lit(other), (p + 1).cast("int"), F.lit(1)), (p + 1).cast("int")))
    name = F.concat(F.lit("AF-"), number_of("p_partkey"), F.lit("_consensus"))
    seqs = built(table(spark, sf, "part").select("p_partkey"), name.alias("id"), seq.alias("seq"), F.struct("p_partkey").alias("_ord"))
    return sites.snp_alignment(seqs, stage(sites.snp_sites(seqs), "sites"))


@query("g3_near_clonal", f"""WITH {CL}, pr AS (SELECT a.id AS i, b.id AS j, CAST(hamming(a.seq, b.seq) AS BIGINT) AS dist
  FROM cl a, cl b) SELECT * FROM pr WHERE dist <= {CLONAL_NEAR}""")
def g3_near_clonal(spark, sf):
    """Near pairs of a cohort of low diversity, where bands of sites are shared by nearly all sequences."""
    return distances.snp_distances(clonal_alignment(spark, sf), CLONAL_NEAR, plan="sparse")


# Sequences long enough for several pieces: hashes of the order's id turned into bases.
LONG_WIDTH = 9_600
LQ = f"""lq AS (SELECT 'AF-' || {number_text('s_suppkey')} || '_consensus' AS id, s_suppkey,
  translate(string_agg(md5(CAST(s_suppkey % 7 AS VARCHAR) || '-' || p), '' ORDER BY p), '0123456789abcdef', 'ACGTACGTACGTACGT') AS seq
  FROM supplier, range(300) r(p) GROUP BY s_suppkey)"""


def long_sequences(spark, sf) -> DataFrame:
    """One sequence of 9,600 bases per supplier, seven different ones in all."""
    parts = F.transform(F.sequence(F.lit(0), F.lit(299)), lambda p: F.md5(F.concat(
        (F.col("s_suppkey") % 7).cast("string"), F.lit("-"), p.cast("string"))))
    name = F.concat(F.lit("AF-"), number_of("s_suppkey"), F.lit("_consensus"))
    return table(spark, sf, "supplier").select(
        name.alias("id"), F.translate(F.array_join(parts, ""), "0123456789abcdef", "ACGTACGTACGTACGT").alias("seq"),
        F.struct("s_suppkey").alias("_ord"))


@query("g1_long_sequences", f"""WITH {LQ}, ba AS (SELECT id, s_suppkey, p AS pos, substr(seq, p, 1) AS b
    FROM lq, LATERAL (SELECT unnest(range(1, length(seq) + 1)) AS p) r),
  st AS (SELECT pos FROM ba GROUP BY pos HAVING count(DISTINCT b) > 1)
  SELECT id, md5(string_agg(b, '' ORDER BY pos)) AS kept, way FROM ba, (VALUES ('direct'), ('shuffled')) w(way)
  WHERE pos IN (SELECT pos FROM st) GROUP BY s_suppkey, id, way""")
def g1_long_sequences(spark, sf):
    """Both ways of reducing sequences of more than one piece."""
    seqs = long_sequences(spark, sf)
    found = stage(sites.snp_sites(seqs), "sites")
    ways = [sites.snp_alignment(seqs, found, broadcast_limit=limit).select("id", F.md5("snp_seq").alias("kept"), F.lit(way).alias("way"))
            for way, limit in (("direct", None), ("shuffled", 0))]
    return ways[0].union(ways[1])


@query("g6_equal_length", f"WITH {SQ} SELECT id, length(seq) AS bases FROM sq")
def g6_equal_length(spark, sf):
    return sites.require_equal_length(sequences(spark, sf)).select("id", F.length("seq").alias("bases"))


# --- Combinations ----------------------------------------------------------------------------

@query("x7_curate", f"WITH {DD}, {TH}, {CA}, {MO}, {EX}, {PS}, {INC} SELECT {BEST} FROM inc")
def x7_curate(spark, sf):
    return best_columns(curated(spark, sf)["cohort"])


@query("x6_selection", f"""WITH {DD} SELECT {BEST} FROM dd WHERE oc = 'Pass' AND pm BETWEEN 10 AND 45
  AND nc BETWEEN 0 AND 60000 AND grp IN ('Brand#1', 'Brand#2', 'Brand#3')""")
def x6_selection(spark, sf):
    deduped = dedup.best_per_key(samples(spark, sf), DEFAULT_CRITERIA)
    return best_columns(filters.apply_filter(deduped, {
        "pcMapped": [10, 45], "Ncount": [0, 60000], "group": ["Brand#1", "Brand#2", "Brand#3"]}))


@query("x1_update", f"WITH {BR} SELECT {BATCH_SQL}, (SELECT count(*) FROM br) AS total FROM br")
def x1_update(spark, sf):
    """The store after two updates; the second finds nothing new."""
    root, target = write_batches(spark, sf, comments=False), fresh_path(spark, "store")
    for _ in range(2):
        metrics, stored = update_samples(spark, target, f"{root}/{{bucket}}/", prefix="v3-2")
    return trimmed(stored).withColumn("total", F.lit(metrics["total_number_of_wgs_samples"]).cast("bigint"))


@query("x1_update_csv", f"""WITH {BR}, wide AS (SELECT {BATCH_SQL}, CAST(c_nationkey * 2.5 AS DOUBLE) AS depth FROM customer JOIN br USING (c_custkey))
  SELECT *, (SELECT count(*) FROM br) AS total FROM wide WHERE depth BETWEEN 5 AND 50""".replace("FROM customer JOIN br USING (c_custkey)",
  "FROM (SELECT br.*, customer.c_nationkey FROM customer JOIN br USING (c_custkey))"))
def x1_update_csv(spark, sf):
    """An update that begins with a samples table kept as CSV, adds what it lacks, and writes it; filtered by an added number."""
    root, target = write_batches(spark, sf, comments=False, depth=True), fresh_path(spark, "store")
    old = batch_rows(spark, sf).where("c_nationkey < 9").select(
        "Sample", "pcMapped", "Outcome", "group", "ResultLoc", fn.submission_number(F.col("Sample")).alias("Submission"),
        (F.col("c_nationkey") * 2.5).alias("depth"))
    path = fresh_path(spark, "samples-csv")
    old.write.option("header", True).csv(path)
    metrics, stored = update_samples(spark, target, f"{root}/{{bucket}}/", prefix="v3-2", samples_csv=path)
    back = filters.range_filter(tables.read_samples(spark, path), {"depth": (5, 50)})
    if back.count() != filters.range_filter(stored, {"depth": (5, 50)}).count():
        raise ValueError("the table in the store and its CSV differ")
    return back.select(*BATCH_COLUMNS, "depth").withColumn("total", F.lit(metrics["total_number_of_wgs_samples"]).cast("bigint"))


# --- Whole pipelines: customers as samples, some sequenced twice, with consensus files, cattle, movements, bounds and exclusions --------

PIPELINE_NEAR = 2
PW = f"""wn AS (SELECT c_custkey, c_nationkey, c_acctbal, c_mktsegment, c_name, 'AF-' || {number_text('c_custkey')} AS sub,
    translate(md5('n' || c_nationkey % 3), '0123456789abcdef', 'ACGTACGTACGTACGT')
      || translate(lpad(bin(c_custkey % 16), 4, '0'), '01', 'AC') || translate(lpad(bin(c_custkey // 16 % 8), 3, '0'), '01', 'GT') AS seq FROM customer),
  sm AS (SELECT sub, sub || '-x' AS sample, CASE WHEN c_acctbal > 0 THEN 'Pass' END AS oc, c_acctbal AS pm, 1000 + c_custkey % 500 AS nc, c_mktsegment AS grp, c_custkey AS ck FROM wn
    UNION ALL SELECT sub, sub || '-y', CASE WHEN c_nationkey % 3 = 0 THEN 'Pass' ELSE 'Fail' END, 5000 - c_acctbal, 1000 + c_custkey % 500, c_mktsegment, c_custkey
    FROM wn WHERE c_custkey % 4 = 0),
  dd AS (SELECT * FROM sm QUALIFY row_number() OVER (PARTITION BY sub ORDER BY coalesce(oc = 'Pass', FALSE) DESC, pm DESC, sample) = 1),
  th AS (SELECT c_mktsegment AS clade, 1000 + 90 * count(DISTINCT c_nationkey) % 400 + 60 AS mx FROM customer WHERE c_mktsegment <> 'HOUSEHOLD' GROUP BY 1),
  ps AS (SELECT dd.* FROM dd JOIN th ON grp = clade WHERE oc = 'Pass' AND nc <= mx AND ck % 50 <> 3),
  inc AS (SELECT * FROM ps WHERE ck % 5 <> 1 AND ck % 7 <> 2)"""
PIPELINE_SQL = f"""WITH {PW}
  SELECT 'cohort' AS part, sub AS a, sample AS b, grp AS c FROM inc
  UNION ALL SELECT 'report', sub, CASE WHEN ck % 5 <> 1 THEN 'cow ' || c_nationkey WHEN ck % 7 <> 2 THEN c_name END,
    concat_ws('|', oc, CASE WHEN nc <= mx THEN 'Pass' ELSE 'Fail' END, CAST(ck % 50 = 3 AS VARCHAR), 'true', CAST(ck % 5 <> 1 AS VARCHAR), CAST(ck % 7 <> 2 AS VARCHAR))
    FROM dd LEFT JOIN th ON grp = clade JOIN wn USING (sub) WHERE sub NOT IN (SELECT sub FROM inc)
  UNION ALL SELECT 'pair', i.sub, j.sub, CAST(hamming(a.seq, b.seq) AS VARCHAR) FROM inc i JOIN wn a USING (sub), inc j JOIN wn b USING (sub)
    WHERE hamming(a.seq, b.seq) <= {PIPELINE_NEAR}"""


def pipeline_world(spark, sf) -> dict[str, str]:
    """Batch result files, consensus files, cattle and movement tables, class bounds and an exclusion list, in a folder."""
    root = fresh_path(spark, "world")
    customers = table(spark, sf, "customer").repartition(spark.sparkContext.defaultParallelism)
    nation, key = F.col("c_nationkey"), F.col("c_custkey")
    sub = F.concat(F.lit("AF-"), number_of("c_custkey"))
    binary = lambda value, n: F.lpad(F.bin(value), n, "0")
    seq = F.concat(F.translate(F.md5(F.concat(F.lit("n"), (nation % 3).cast("string"))), "0123456789abcdef", "ACGTACGTACGTACGT"),
                   F.translate(binary(key % 16, 4), "01", "AC"), F.translate(binary(F.floor(key / 16) % 8, 3), "01", "GT"))
    rows = stage(customers.select("*", sub.alias("sub"), seq.alias("seq")), "customers")
    location = F.concat(F.lit(f"s3://{DEFAULT_BUCKET}/v3-2/batch"), nation.cast("string"), F.lit("/"))
    common = [F.lit("BritishbTB").alias("flag"), F.col("c_mktsegment").alias("group"), (1000 + key % 500).alias("Ncount"), location.alias("ResultLoc"),
              F.concat(F.lit("batch"), nation.cast("string")).alias("folder"), "seq"]
    first = rows.select(F.concat("sub", F.lit("-x")).alias("Sample"), F.col("c_acctbal").alias("pcMapped"),
                        F.when(F.col("c_acctbal") > 0, "Pass").otherwise("NA").alias("Outcome"), *common)
    again = rows.where("c_custkey % 4 = 0").select(F.concat("sub", F.lit("-y")).alias("Sample"), (5000 - F.col("c_acctbal")).alias("pcMapped"),
                                                   F.when(nation % 3 == 0, "Pass").otherwise("Fail").alias("Outcome"), *common)
    samples = stage(first.union(again), "samples")
    names = ["Sample", "pcMapped", "Outcome", "flag", "group", "Ncount", "ResultLoc"]
    lines = samples.select("folder", F.concat_ws(",", *names).alias("value"), F.lit(1).alias("place"))
    heads = samples.select("folder", F.lit(",".join(names)).alias("value"), F.lit(0).alias("place")).distinct()
    _write_files(heads.unionByName(lines), f"{root}/{DEFAULT_BUCKET}", "v3-2/{}/FinalOut.csv")
    _write_consensus(samples.select("folder", F.concat("Sample", F.lit("_consensus")).alias("id"), "seq"), f"{root}/{DEFAULT_BUCKET}")
    cows = rows.where("c_custkey % 5 <> 1").select(F.col("sub").alias("CVLRef"), F.lit("old").alias("clade"), F.concat(F.lit("cow "), nation.cast("string")).alias("RawEartag2"))
    moves = rows.where("c_custkey % 7 <> 2").select(F.col("sub").alias("SampleName"), F.col("c_name").alias("StandardEartag"), F.lit(3).alias("Stay_Length"))
    bounds = (customers.where("c_mktsegment <> 'HOUSEHOLD'").groupBy(F.col("c_mktsegment").alias("clade"))
              .agg((1000 + 90 * F.count_distinct("c_nationkey") % 400 + 60).alias("maxN")))
    for df, name in ((cows, "cm/cattle.csv"), (moves.union(moves), "cm/movement.csv"), (bounds, "clades.csv")):
        df.write.option("header", True).csv(f"{root}/{name}")
    rows.where("c_custkey % 50 = 3").select("sub").write.text(f"{root}/outliers.txt")
    return {"store": f"{root}/store", "base": f"{root}/{{bucket}}/", "root": root}


def _write_files(lines: DataFrame, root: str, name: str) -> None:
    """A text file for each ``folder``, its lines by ``place``, written by the task that holds them."""
    def write(batches):
        system, base = _file_system(root)
        last, out, n = None, None, 0
        for batch in batches:
            for row in batch.to_pylist():
                if row["folder"] != last:
                    if out:
                        out.close()
                    last, n = row["folder"], n + 1
                    path = f"{base}/{name.format(last)}"
                    system.create_dir(path.rsplit("/", 1)[0])
                    out = system.open_output_stream(path)
                out.write((row["value"] + "\n").encode())
        if out:
            out.close()
        yield pa.RecordBatch.from_arrays([pa.array([n], pa.int64())], ["n"])
    ordered = lines.repartition("folder").sortWithinPartitions("folder", "place").select("folder", "value")
    ordered.mapInArrow(write, "n long").agg(F.sum("n")).collect()


def _file_system(root: str) -> tuple[pa.fs.FileSystem, str]:
    if root.startswith(("/", "file:")):
        return pa.fs.LocalFileSystem(), "/" + root.removeprefix("file:").lstrip("/")
    return pa.fs.FileSystem.from_uri(root)


def results_of(spark, results: str, cohort: str) -> DataFrame:
    """The tables that a pipeline left, read back: cohort, report if there is one, and near pairs."""
    kept = tables.read_samples(spark, f"{results}/metadata/{cohort}").select(
        F.lit("cohort").alias("part"), F.col("Submission").alias("a"), F.col("Sample").alias("b"), F.col("group").alias("c"))
    pairs = tables.read_text_table(spark, f"{results}/snps", once=True).select(F.lit("pair").alias("part"), F.col("i").alias("a"), F.col("j").alias("b"), F.col("dist").alias("c"))
    return kept.unionByName(pairs)


@query("x7_production", PIPELINE_SQL)
def x7_production(spark, sf):
    """The production pipeline itself, from batch files to near pairs: its cohort, its report and its pairs read back."""
    world, results = pipeline_world(spark, sf), fresh_path(spark, "results")
    root = world.pop("root")
    production_pipeline(spark, results, cattle_movements=f"{root}/cm", thresholds=f"{root}/clades.csv", exclusions=f"{root}/outliers.txt",
                        max_distance=PIPELINE_NEAR, **world)
    report = tables.read_text_table(spark, f"{results}/metadata/report").select(
        F.lit("report").alias("part"), F.col("Submission").alias("a"), F.col("eartag").alias("b"),
        F.concat_ws("|", "Outcome", "Ncount", "outlier", "wgs_data", "cattle_data", "movement_data").alias("c"))
    return results_of(spark, results, "consistified_wgs").unionByName(report)


@query("x6_full", f"""WITH {PW}, fl AS (SELECT * FROM dd WHERE oc = 'Pass' AND nc BETWEEN 1000 AND 1200 AND grp IN ('BUILDING', 'MACHINERY'))
  SELECT 'cohort' AS part, sub AS a, sample AS b, grp AS c FROM fl
  UNION ALL SELECT 'pair', i.sample || '_consensus', j.sample || '_consensus', CAST(hamming(a.seq, b.seq) AS VARCHAR) FROM fl i JOIN wn a USING (sub), fl j JOIN wn b USING (sub)
    WHERE hamming(a.seq, b.seq) <= {PIPELINE_NEAR}""")
def x6_full(spark, sf):
    """The full pipeline itself, with filters and without the other tables: its cohort and its pairs read back."""
    world, results = pipeline_world(spark, sf), fresh_path(spark, "results")
    world.pop("root")
    full_pipeline(spark, results, max_distance=PIPELINE_NEAR, Ncount=[1000, 1200], group=["BUILDING", "MACHINERY"], **world)
    return results_of(spark, results, "passed_wgs")


@query("x8_job", f"""WITH {PW}, pd AS (SELECT * FROM sm WHERE oc = 'Pass' QUALIFY row_number() OVER (PARTITION BY sub ORDER BY pm DESC, sample) = 1)
  SELECT grp AS clade, round_even(quantile_cont(nc, 0.6), 0) AS "maxN", (SELECT count(*) FROM sm WHERE oc = 'Pass') - (SELECT count(*) FROM pd) AS removed
  FROM pd GROUP BY grp""")
def x8_job(spark, sf):
    """The threshold job itself, its table read back, with the number of repeated submissions."""
    world, results = pipeline_world(spark, sf), fresh_path(spark, "results")
    world.pop("root")
    metrics, _ = threshold_job(spark, results, p=0.6, **world)
    found = tables.read_thresholds(spark, f"{results}/thresholds").select("clade", "maxN")
    return found.withColumn("removed", F.lit(metrics["number_of_duplicate_WGS_submissions"]).cast("bigint"))


@query("x5_phylo", f"""WITH {PW} SELECT i.sample || '_consensus' AS i, j.sample || '_consensus' AS j, CAST(hamming(a.seq, b.seq) AS VARCHAR) AS dist
  FROM sm i JOIN wn a USING (sub), sm j JOIN wn b USING (sub) WHERE i.pm > 3000 AND j.pm > 3000 AND hamming(a.seq, b.seq) <= {PIPELINE_NEAR}""")
def x5_phylo(spark, sf):
    """The comparison step alone, on samples read from their batch files, its pairs read back."""
    world, results = pipeline_world(spark, sf), fresh_path(spark, "results")
    _, stored = update_samples(spark, world["store"], world["base"])
    phylo(spark, results, stored.where("pcMapped > 3000"), world["base"], light_mode=True, max_distance=PIPELINE_NEAR)
    return tables.read_text_table(spark, f"{results}/snps", once=True).select("i", "j", "dist")


@query("s5_update_table", f"WITH {PW} SELECT sample AS \"Sample\", sub AS \"Submission\", CAST(nc AS DOUBLE) AS \"Ncount\" FROM sm")
def s5_update_table(spark, sf):
    """The samples table as CSV, read with the types of its known columns."""
    world = pipeline_world(spark, sf)
    path = fresh_path(spark, "samples-csv")
    update_samples(spark, world["store"], world["base"], samples_csv=path)
    return tables.read_samples(spark, path).select("Sample", "Submission", "Ncount")


@query("p5_require_rows", "SELECT c_custkey FROM customer WHERE c_acctbal > 0")
def p5_require_rows(spark, sf):
    return filters.require_rows(table(spark, sf, "customer").where("c_acctbal > 0").select("c_custkey"))


BEST_TEXT = BEST.replace('sub AS', 'CAST(sub AS VARCHAR) AS')


@query("x2_de_duplicate", f"""WITH {DD} SELECT {BEST_TEXT}, (SELECT count(*) FROM sm) - (SELECT count(*) FROM dd) AS removed FROM dd""")
def x2_de_duplicate(spark, sf):
    """The step's table read back, with the number of rows that went."""
    results = fresh_path(spark, "results")
    metrics, _ = de_duplicate(results, samples(spark, sf))
    back = best_columns(tables.read_samples(spark, f"{results}/metadata/deduped_wgs"))
    return back.withColumn("removed", F.lit(metrics["number_of_duplicate_WGS_submissions"]).cast("bigint"))


@query("x2_incremental", f"""WITH {DD} SELECT {BEST_TEXT}, (SELECT count(*) FROM sm) - (SELECT count(*) FROM dd) AS removed FROM dd""")
def x2_incremental(spark, sf):
    """Best rows after three ingests, each taken into a bucketed table of survivors, with the number of rows that went."""
    target, kept = fresh_path(spark, "store"), fresh_path(spark, "best")
    order = F.struct(F.lit(0).cast("bigint").alias("run"), F.format_string("%03d-%012d-%012d", "_ord.l_linenumber", "_ord.l_partkey", "_ord.l_suppkey").alias("path"),
                     F.unix_date(F.col("_ord.l_shipdate").cast("date")).cast("bigint").alias("block"), F.lit(0).cast("bigint").alias("row"))
    rows = samples(spark, sf).withColumn("ResultLoc", F.col("group")).withColumn("_ord", order)
    for n in range(3):       # lines are numbered within an order, so most keys come again
        store.append_ingest(rows.where(F.pmod(F.xxhash64("_ord.path"), F.lit(3)) == n), target, f"run-{n}")
        metrics = incremental.update_best(spark, target, kept, buckets=32)
    back = best_columns(incremental.read_best(spark, target, kept))
    return back.withColumn("removed", F.lit(metrics["number_of_duplicate_WGS_submissions"]).cast("bigint"))


@query("x3_filter_by_file", f"""WITH {SM} SELECT {BEST_TEXT}, count(*) OVER () AS passed FROM sm WHERE oc = 'Pass'
  AND nc BETWEEN 20000 AND 50000 AND grp IN ('Brand#1', 'Brand#2', 'Brand#3')""")
def x3_filter_by_file(spark, sf):
    """Samples filtered by a specification file, the step's table read back, with its count."""
    results, config = fresh_path(spark, "results"), fresh_path(spark, "spec")
    sinks.write_json(spark, {"Ncount": [20000, 50000], "group": ["Brand#1", "Brand#2", "Brand#3"]}, config)
    metrics, _, _ = sample_filter(results, samples(spark, sf), config)
    back = best_columns(tables.read_samples(spark, f"{results}/metadata/passed_wgs"))
    return back.withColumn("passed", F.lit(metrics["number_of_passed_samples"]).cast("bigint"))


@query("x4_consistify", f"""WITH {PA}, {CA}, {MO} SELECT {BEST_TEXT}, (SELECT count(*) FROM mo WHERE k IN {COMMON}) AS movements
  FROM pa WHERE sub IN {COMMON}""")
def x4_consistify(spark, sf):
    """Samples reduced to the keys that all three tables hold, read back, with the number of movements kept."""
    results = fresh_path(spark, "results")
    passing = filters.apply_filter(samples(spark, sf), {})
    cows = cattle(spark, sf).withColumn("_ord", F.struct("CVLRef"))
    metrics, _ = consistify(results, passing, cows, movement(spark, sf))
    back = best_columns(tables.read_samples(spark, f"{results}/metadata/consistified_wgs"))
    return back.withColumn("movements", F.lit(metrics["consistified_number_of_movement_records"]).cast("bigint"))


@query("s14_run_record", f"""WITH {SM}, passed AS (SELECT count(*) AS n FROM sm WHERE oc = 'Pass')
  SELECT (SELECT count(*) FROM sm) AS samples, n AS passed FROM passed""")
def s14_run_record(spark, sf):
    """The record of a run, written and read back."""
    results, rows = fresh_path(spark, "results"), samples(spark, sf)
    save_metrics(spark, results, {"samples": rows.count(), "passed": filters.apply_filter(rows, {}).count()})
    text = spark.read.text(f"{results}/metadata/metadata.json", wholetext=True)
    return text.select(F.from_json("value", "samples bigint, passed bigint").alias("r")).select("r.*")


@query("x8_thresholds", f"""WITH {SM}, pd AS (SELECT * FROM sm WHERE oc = 'Pass' QUALIFY row_number() OVER
    (PARTITION BY sub ORDER BY (fl = 'BritishbTB') DESC, pm DESC, nc, ln, pk, sk, sd) = 1)
  SELECT grp AS clade, round_even(quantile_cont(nc, 0.85), 0) AS "maxN" FROM pd GROUP BY grp""")
def x8_thresholds(spark, sf):
    passing = filters.apply_filter(samples(spark, sf), {})
    return thresholds.derive_thresholds(dedup.best_per_key(passing, DEFAULT_CRITERIA))
