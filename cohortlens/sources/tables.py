"""CSV tables read by header name, whatever the column order of each file and however files are split.

Files are scanned once: each line is parsed into its fields and written, in a long form in which a row holds its file's names beside its own
values. Headers, layouts, widths and the kinds of unknown columns all come from that. A column is picked from the long form only
where it is selected, so tables of very many names cost what is read of them.

A file's header is the first line of its first split. Files are cut at line ends as long as no line of theirs has an odd number of quotes;
the others may hold line breaks inside quotes, and their lines are put together by one task each, record by record. Which way a file goes
depends on its contents alone.
"""

import csv
import re
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from cohortlens.functions import null_tokens_to_null, number, submission_number
from cohortlens.model import EXTRA, NULL_TOKENS, ORDER, SAMPLE_COLUMNS, SAMPLES, STORED_SAMPLES
from cohortlens.plans.listing import few_listing_tasks
from cohortlens.plans.sizing import lookup_join
from cohortlens.plans.staging import stage

PARSED = "path string, block bigint, row bigint, first boolean, broken boolean, line string, fields array<string>"
LONGEST_FIELD = 2**31 - 1
BEFORE_COMMENT = re.compile(r'(?:[^"#]++|"(?:[^"]++|"")*+"|")*+')     # up to the first # that is not inside double quotes


def file_order(run: int | Column = 0) -> Column:
    """The ordinal that sorts rows in file order; a row number alone does not, over several files."""
    run = F.lit(run).cast("bigint") if isinstance(run, int) else run
    return F.struct(run.alias("run"), F.col("_metadata.file_path").alias("path"),
                    F.col("_metadata.file_block_start").alias("block"),
                    F.monotonically_increasing_id().alias("row"))


def _fields(record: str, header: bool) -> list[str | None]:
    """The fields of a record; null tokens are missing values, but not in a header."""
    fields = next(csv.reader([record])) if '"' in record else record.split(",")
    return fields if header else [None if f in NULL_TOKENS else f for f in fields]


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.string(), pa.int64(), pa.int64(), pa.bool_(), pa.bool_(), pa.string(), pa.list_(pa.string())]
    columns = list(zip(*rows)) or [()] * len(kinds)
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["path", "block", "row", "first", "broken", "line", "fields"])


def _simple(lines: pa.Array, comment: bool) -> bool:
    """Whether no line holds a quote, a byte order mark or, where they count, a comment, so that all are cut at commas alone."""
    lines.validate(full=True)      # text that is no UTF-8 fails here
    marks = ['"', "\ufeff", "#"] if comment else ['"', "\ufeff"]
    return not any(pc.any(pc.match_substring(lines, mark)).as_py() for mark in marks)


def _simple_rows(batch: pa.RecordBatch, row: int) -> pa.RecordBatch:
    """The lines of one split, cut at commas and numbered from ``row``: as ``_lines`` does for one line after another."""
    lines, n = batch.column("value"), batch.num_rows
    fields = pc.split_pattern(lines, ",")
    values = fields.flatten()
    values = pc.if_else(pc.is_in(values, pa.array(list(NULL_TOKENS), pa.string())), pa.scalar(None, pa.string()), values)
    blank = pc.equal(pc.utf8_trim(lines, " "), "").to_numpy(zero_copy_only=False)
    fields = pa.ListArray.from_arrays(fields.offsets, values, mask=pa.array(blank))
    never = pa.array(np.zeros(n, bool))
    return pa.RecordBatch.from_arrays([batch.column("path"), batch.column("block"), pa.array(np.arange(row, row + n)), never, never, lines, fields],
                                      ["path", "block", "row", "first", "broken", "line", "fields"])


def _lines(batches: Iterator[pa.RecordBatch], comment: bool) -> Iterator[pa.RecordBatch]:
    """Parse the lines of each split and number them; a task reads its splits one after another. Blank lines have no fields.

    Behind the header, a batch of lines that are all simple is parsed as a whole.
    """
    csv.field_size_limit(LONGEST_FIELD)
    path, block, row, headed = None, None, 0, False
    for batch in batches:
        if headed and batch.num_rows and all(pc.all(pc.equal(batch.column(c), at)).as_py() for c, at in (("path", path), ("block", block))) \
                and _simple(batch.column("value"), comment):
            yield _simple_rows(batch, row + 1)
            row += batch.num_rows
            continue
        out = []
        for line, *place in zip(*(batch.column(c).to_pylist() for c in ("value", "path", "block"))):
            if place != [path, block]:
                (path, block), row, headed = place, -1, place[1] > 0
            row += 1
            line = line.removeprefix("\ufeff")
            broken = line.count('"') % 2 == 1
            kept = BEFORE_COMMENT.match(line).group() if comment and "#" in line else line
            filled = bool(kept.strip(" "))
            header = filled and not headed
            out.append((path, block, row, header, broken, line, _fields(kept, header) if filled and not broken else None))
            headed |= filled
        yield _rows(out)


def _records(lines: Iterator[tuple[int, int, str]], comment: bool) -> Iterator[tuple[int, int, str]]:
    """(block, row, record) of the lines of a file: a line break inside quotes belongs to its field."""
    record, quoted, place = "", False, None
    for block, row, line in lines:
        place = place if quoted else (block, row)
        if comment and "#" in line:
            before = BEFORE_COMMENT.match('"' + line if quoted else line).group()
            line = before[1:] if quoted else before
        quoted ^= line.count('"') % 2 == 1
        record += line
        if quoted:
            record += "\n"
            continue
        if record.strip():
            yield *place, record
        record = ""
    if quoted:
        raise ValueError(f"a quote is not closed before the end, in the record that begins in line {place[1] + 1} of the part at byte {place[0]}")


def _stitched(comment: bool):
    """The records of one file from its lines, for files whose records may go over several lines."""
    def stitch(table: pa.Table) -> pa.Table:
        csv.field_size_limit(LONGEST_FIELD)
        table = table.sort_by([("block", "ascending"), ("row", "ascending")])
        path = table.column("path")[0].as_py()
        lines = zip(*(table.column(c).to_pylist() for c in ("block", "row", "line")))
        try:
            rows = [(path, block, row, n == 0, False, None, _fields(record, n == 0)) for n, (block, row, record) in enumerate(_records(lines, comment))]
        except ValueError as error:
            raise ValueError(f"{path}: {error}") from None
        return pa.Table.from_batches([_rows(rows)])
    return stitch


def _parsed(spark: SparkSession, paths: list[str] | str, comment: bool) -> DataFrame:
    """The records of all files, written out; blank ones and comments are left out. The files themselves are read once."""
    path, block = F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("block")
    with few_listing_tasks(spark):
        files = spark.read.text(paths)
    lines = stage(files.select("value", path, block).mapInArrow(lambda b: _lines(b, comment), PARSED), "csv-lines")
    broken = lines.where("broken").select("path").distinct()
    plain = lines.where("fields IS NOT NULL").drop("line")
    if lines.where("broken").isEmpty():
        return plain
    broken = stage(broken, "multi-line-files")
    stitched = stage(lookup_join(lines, broken, "path", "left_semi").groupBy("path").applyInArrow(_stitched(comment), PARSED).drop("line"), "csv-records")
    return lookup_join(plain, broken, "path", "left_anti").unionByName(stitched)


def _header_names(fields: Column) -> Column:
    """Trimmed names; one without a name is called by its position, and repeated ones are numbered."""
    named = F.transform(fields, lambda f, i: F.coalesce(F.nullif(F.trim(f), F.lit("")), F.concat(F.lit("Unnamed: "), i.cast("string"))))
    earlier = lambda n, i: F.size(F.filter(F.slice(named, 1, i), lambda x: x == n))
    return F.transform(named, lambda n, i: F.when((i > 0) & (earlier(n, i) > 0), F.concat(n, F.lit("."), earlier(n, i).cast("string"))).otherwise(n))


class LongTable:
    """Rows with their own file's names and their values, and all names in order of appearance; only these reach the driver."""

    def __init__(self, spark: SparkSession, paths: list[str] | str, comment: bool = False, run: int = 0):
        parsed = _parsed(spark, paths, comment)
        headers = parsed.where("first").select("path", _header_names(F.col("fields")).alias("names"))
        layouts = headers.groupBy("names").agg(F.min("path").alias("path")).orderBy("path").collect()
        self.names = list(dict.fromkeys(name for r in layouts for name in r.names))
        self.layout = layouts[0].names if len(layouts) == 1 else None
        rows = parsed.where("NOT first")
        if self.layout is not None:      # one layout for all files needs no join
            rows = rows.withColumn("names", F.lit(self.layout))
        else:
            rows = lookup_join(rows, headers, "path")
        where = F.concat(F.lit("line "), (F.col("row") + 1).cast("string"), F.lit(" of the part of "), "path",
                         F.lit(" that starts at byte "), F.col("block").cast("string"), F.lit(" has more fields than its header"))
        fields = F.when(F.size("fields") <= F.size("names"), F.col("fields")).otherwise(F.raise_error(where).cast("array<string>"))
        order = F.struct(F.lit(run).cast("bigint").alias("run"), "path", "block", "row").alias(ORDER)
        self.rows = rows.select("names", fields.alias("fields"), order)

    def text(self, name: str) -> Column:
        """The column of a name: NULL where a row's file lacks it, where the row ends before it, and for null tokens."""
        if name not in self.names:
            return F.lit(None).cast("string")
        if self.layout is not None:
            return F.expr(f"get(fields, {self.layout.index(name)})")
        literal = name.replace("\\", "\\\\").replace("'", "\\'")
        return F.expr(f"get(fields, int(array_position(names, '{literal}')) - 1)")

    def values(self) -> Column:
        """The (name, value) pairs of a row, without missing values."""
        return F.filter(F.zip_with("names", "fields", lambda n, v: F.struct(n.alias("name"), v.alias("value"))), lambda p: p["value"].isNotNull())

    def known(self, with_key: bool, permissive: bool) -> list[Column]:
        """The columns of the samples table, typed; absent ones are NULL."""
        out = []
        for name in SAMPLE_COLUMNS if with_key else SAMPLE_COLUMNS[:-1]:
            text = isinstance(SAMPLES[name].dataType, T.StringType)
            out.append((self.text(name) if text else number(self.text(name), permissive)).alias(name))
        return out

    def numeric(self, names: list[str]) -> set[str]:
        """Which of the names have values, all of them numbers: one aggregation over (name, value) rows."""
        if not names:
            return set()
        values = self.rows.select(F.explode(self.values()).alias("v")).select("v.*")
        if len(names) < len(self.names):
            values = values.where(~F.col("name").isin([n for n in self.names if n not in names]))
        counted = values.groupBy("name").agg(F.count(F.lit(1)).alias("n"), F.count(number(F.col("value"), True)).alias("numbers"))
        return {r.name for r in counted.where("n = numbers").collect()}


def _plain_rows(spark: SparkSession, paths: list[str] | str, comment: bool) -> tuple[list[str], DataFrame] | None:
    """The names, and (path, block, row, fields) cut from the lines as they are read, of files that allow it by what all their lines hold.

    These are files that all begin with one header, which comes nowhere else, and have neither quotes, comments nor byte order marks, text that is no
    UTF-8, nor lines with more fields than the header. One aggregation by file finds out; for other files there is None.
    """
    path, block = F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("block")
    with few_listing_tasks(spark):
        files = spark.read.text(paths)
    value, filled = F.col("value"), F.trim("value") != ""
    lines = files.select("value", path, block, F.monotonically_increasing_id().alias("row"))
    header = lines.where(filled & (F.col("block") == 0)).select("value").first()
    if header is None:
        return None
    marks = ['"', "\ufeff", "#"] if comment else ['"', "\ufeff"]
    odd = reduce(Column.__or__, [value.contains(mark) for mark in marks], ~F.is_valid_utf8(value))
    odd = odd | (F.octet_length(value) > F.octet_length(F.substring_index(value, ",", header.value.count(",") + 1)))
    by_file = lines.groupBy(F.xxhash64("path")).agg(F.bool_or(odd).alias("odd"), F.min(F.when(filled & (F.col("block") == 0), F.col("row"))).alias("first"),
                                                    F.min(F.when(value == header.value, F.col("row"))).alias("head"), F.count_if(value == header.value).alias("heads"))
    if not by_file.where("odd OR first IS NULL OR head IS NULL OR first <> head OR heads <> 1").isEmpty():
        return None
    names = spark.range(1).select(_header_names(F.split(F.lit(header.value), ",")).alias("names")).first().names
    return names, lines.where(filled & (value != header.value)).select("path", "block", "row", F.split("value", ",").alias("fields"))


def read_by_name(spark: SparkSession, paths: list[str] | str, comment: bool = False,
                 run: int = 0, once: bool = False) -> DataFrame:
    """All columns of all files as strings, matched by trimmed header name, null tokens as NULL.

    A line with more fields than its header, or with a quote that is not closed, fails with its file; one with
    fewer fields has NULLs at the end. A column without a name is called by its position, a repeated name is numbered.

    ``once`` is for tables that one job reads, before anything is written in their place: plain files are looked through and then parsed where
    they are selected from, without a copy. Their row ordinals sort as the others do.
    """
    if once and (plain := _plain_rows(spark, paths, comment)):
        names, rows = plain
        order = F.struct(F.lit(run).cast("bigint").alias("run"), "path", "block", "row").alias(ORDER)
        return rows.select(*[null_tokens_to_null(F.get("fields", F.lit(i))).alias(name) for i, name in enumerate(names)], order)
    table = LongTable(spark, paths, comment, run)
    return table.rows.select(*[table.text(name).alias(name) for name in table.names], ORDER)


def empty_samples(spark: SparkSession) -> DataFrame:
    """The samples table before its first batch."""
    return spark.createDataFrame([], T.StructType([*SAMPLES.fields, STORED_SAMPLES[ORDER]]))


def read_samples(spark: SparkSession, paths: list[str] | str, permissive: bool = False) -> DataFrame:
    """The samples table from CSV; ``#`` starts a comment anywhere in a line.

    Columns beyond the known ones are numbers where every value is one, else text.
    """
    table = LongTable(spark, paths, comment=True)
    extra = [n for n in table.names if n not in SAMPLE_COLUMNS]
    numeric = table.numeric(extra)
    others = [(number(table.text(n), True) if n in numeric else table.text(n)).alias(n) for n in extra]
    return table.rows.select(*table.known(True, permissive), *others, ORDER)


def read_batches(spark: SparkSession, paths: list[str] | str, permissive: bool = False, run: int = 0,
                 with_key: bool = False) -> DataFrame:
    """Batch result files as they are stored: the samples table, without the submission key unless the files have it, and the other
    columns as one map from name to text."""
    table = LongTable(spark, paths, comment=True, run=run)
    others = F.filter(table.values(), lambda p: ~p["name"].isin(SAMPLE_COLUMNS))
    return table.rows.select(*table.known(with_key, permissive), F.map_from_entries(others).alias(EXTRA), ORDER)


def read_text_table(spark: SparkSession, path: str, once: bool = False) -> DataFrame:
    """A CSV table of strings, with the row ordinal. A missing file fails here, by its path."""
    return read_by_name(spark, path, once=once)


def read_thresholds(spark: SparkSession, path: str) -> DataFrame:
    """(clade, maxN, position): the bound of each class and its place in the file."""
    rows = read_by_name(spark, path)
    return rows.select("clade", number(F.col("maxN")).alias("maxN"), F.col(ORDER).alias("position"))


def read_exclusions(spark: SparkSession, path: str, key: str = "Submission",
                    normalise: bool = False) -> DataFrame:
    """One key per line without trailing blanks; ``normalise`` brings them into the form of keys."""
    line = F.rtrim("value")
    return spark.read.text(path).select((submission_number(line) if normalise else line).alias(key)).distinct()
