import json
import shutil

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from cohortlens.model import SAMPLE_COLUMNS
from cohortlens.operators.filters import apply_filter
from cohortlens.sources import batches, fasta, sinks, specs, store, tables
from cohortlens.streaming.ingest import ingest_stream


def write(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text)
    return str(path)


def in_order(df, *columns):
    return [tuple(r) for r in df.orderBy("_ord").select(*columns).collect()]


def test_files_of_different_column_order(spark, tmp_path):
    write(tmp_path / "a.csv", "Sample, pcMapped,Outcome\nS1,99.5,Pass\n\nS2,nan,NA\n")
    write(tmp_path / "b.csv", "Outcome,extra,Sample\n# a comment\nFail,7,S3 # checked\n\"Fa,il\",,S4\n")
    df = tables.read_samples(spark, str(tmp_path))
    assert df.columns == [*SAMPLE_COLUMNS, "extra", "_ord"]
    assert in_order(df, "Sample", "pcMapped", "Outcome", "extra") == [
        ("S1", 99.5, "Pass", None), ("S2", None, None, None), ("S3 ", None, "Fail", 7.0), ("S4", None, "Fa,il", None)]
    assert dict(df.dtypes)["Ncount"] == "double" and dict(df.dtypes)["group"] == "string"


def test_comments_cut_lines_anywhere_but_in_quotes(spark, tmp_path):
    path = write(tmp_path / "a.csv", 'Sample,Outcome,group\nS#1,Pass,x\nS2,"a#b",y # z\n#S3,Pass,x\nS4,"q""#",w\n')
    assert in_order(tables.read_samples(spark, path), "Sample", "Outcome", "group") == [
        ("S", None, None), ("S2", "a#b", "y "), ("S4", 'q"#', "w")]


def test_text_tables_keep_hashes_and_all_columns(spark, tmp_path):
    path = write(tmp_path / "cattle.csv", "CVLRef,clade,RawEartag2,other\nA#1,x,007,\nB,NULL,None,z\n")
    df = tables.read_text_table(spark, path)
    assert in_order(df, "CVLRef", "clade", "RawEartag2", "other") == [("A#1", "x", "007", None), ("B", None, None, "z")]
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        tables.read_text_table(spark, str(tmp_path / "movement.csv"))


def test_no_number_fails_unless_permissive(spark, tmp_path):
    path = write(tmp_path / "a.csv", "Sample,Ncount\nS1,many\n")
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        tables.read_samples(spark, path).collect()
    assert in_order(tables.read_samples(spark, path, permissive=True), "Sample", "Ncount") == [("S1", None)]


def test_order_over_splits_and_files(spark, tmp_path):
    for name, start in (("a", 0), ("b", 3000)):
        write(tmp_path / f"{name}.csv", "Sample,ID\n" + "".join(f"S{i},{i}\n" for i in range(start, start + 3000)))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", 4000)
    try:
        df = tables.read_samples(spark, str(tmp_path))
        assert df.rdd.getNumPartitions() > 8
        assert in_order(df, "ID") == [(str(i),) for i in range(6000)]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_thresholds_and_exclusions(spark, tmp_path, rows):
    bounds = tables.read_thresholds(spark, write(tmp_path / "c.csv", "clade,maxN\nB1-11,56819.0\nB6-84,59319.0\nB2,\n"))
    assert [(r.clade, r.maxN) for r in bounds.orderBy("position").collect()] == \
        [("B1-11", 56819.0), ("B6-84", 59319.0), ("B2", None)]
    path = write(tmp_path / "o.txt", "AF-1  \nA15u\nAF-1\n 12-3456-78x\n")
    assert rows(tables.read_exclusions(spark, path)) == [(" 12-3456-78x",), ("A15u",), ("AF-1",)]
    assert rows(tables.read_exclusions(spark, path, normalise=True)) == [("A15U",), ("AF-1",), ("AF-12-3456-78",)]


def test_specs(spark, tmp_path):
    path = write(tmp_path / "c.json", json.dumps({"group": ["a"], "Ncount": [0, 5]}, indent=2))
    assert specs.resolve_spec(spark, path, {"group": None, "flag": []}) == {"group": ["a"], "Ncount": [0, 5]}
    assert specs.resolve_spec(spark, None, {"group": None, "flag": ["x"]}) == {"flag": ["x"]}
    with pytest.raises(ValueError, match="flag"):
        specs.resolve_spec(spark, path, {"flag": ["x"]})


def test_csv_keeps_order_and_missing_values(spark, tmp_path, frame):
    df = frame("Sample string, Ncount double, Outcome string",
               [(f"S{i}", None if i % 3 else float(i), 'a"b,' if i == 1 else "x") for i in range(50)])
    sinks.write_table(df.repartition(5), str(tmp_path / "out"), "_ord")
    back = tables.read_samples(spark, str(tmp_path / "out"))
    assert in_order(back, "Sample", "Ncount", "Outcome") == in_order(df, "Sample", "Ncount", "Outcome")


def test_fasta_records(spark, tmp_path, frame):
    write(tmp_path / "f" / "a.fas", ">one first record\nACG\nT\n>two\r\nAC\r\nGT\r\n\n>three\nacNt-")
    write(tmp_path / "f" / "b.fas", ">four\nAAAA\n>empty\n")
    df = fasta.read_fasta(spark, str(tmp_path / "f"))
    expected = [("one", "ACGT"), ("two", "ACGT"), ("three", "acNt-"), ("four", "AAAA"), ("empty", "")]
    assert in_order(df, "id", "seq") == expected
    sinks.write_fasta(df, str(tmp_path / "g"))
    assert in_order(fasta.read_fasta(spark, str(tmp_path / "g")), "id", "seq") == expected


def test_fasta_file_in_many_splits(spark, tmp_path):
    path = write(tmp_path / "a.fas", "".join(f">s{i}\n{'ACGT' * 20}\n" for i in range(500)))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", 3000)
    try:
        df = fasta.read_fasta(spark, path)
        assert df.rdd.getNumPartitions() > 8
        assert in_order(df, "id", "seq") == [(f"s{i}", "ACGT" * 20) for i in range(500)]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def base_of(tmp_path):
    return f"file:{tmp_path}/{{bucket}}/"


@pytest.mark.parametrize("files", [10_000, 1])
def test_consensus_of_samples(spark, tmp_path, frame, monkeypatch, files):
    monkeypatch.setattr(fasta, "FILES_PER_SCAN", files)
    for name in "ABCX":
        batch = "one" if name in "AX" else "two"
        write(tmp_path / "s3-csu-003" / "v" / batch / "consensus" / f"{name}_consensus.fas", f">{name}_consensus\nAC{name}\n")
    df = frame("Sample string, ResultLoc string", [
        ("C", "s3://s3-csu-003/v/two/"), ("A", "s3://s3-csu-003//v/one"), ("B", "s3://s3-csu-003/v/two")])
    for limit in (None, 0):
        seqs = fasta.read_consensus(spark, df, base_of(tmp_path), broadcast_limit=limit)
        assert in_order(seqs, "id", "seq") == [("C_consensus", "ACC"), ("A_consensus", "ACA"), ("B_consensus", "ACB")]
    lost = frame("Sample string, ResultLoc string", [("Q", "s3://s3-csu-003/v/two/")])
    with pytest.raises(FileNotFoundError, match="of sample 'Q'"):
        fasta.read_consensus(spark, lost, base_of(tmp_path))


def test_consensus_paths_with_odd_characters(spark, tmp_path, frame):
    names = ["c", "a b", "a#b", "a%b", "a\u00e9b", "a+b", "a%20b", "a[b]"]
    for name in names:
        write(tmp_path / "s3-csu-003" / "v 50%" / "consensus" / f"{name}_consensus.fas", f">{name.split()[0]}\nAC\n")
    df = frame("Sample string, ResultLoc string", [(n, "s3://s3-csu-003/v 50%/") for n in names])
    assert in_order(fasta.read_consensus(spark, df, base_of(tmp_path)), "Sample") == [(n,) for n in names]
    write(tmp_path / "s3-csu-003" / "v 50%" / "consensus" / "empty_consensus.fas", "")
    with pytest.raises(FileNotFoundError, match="of sample 'empty'"):
        fasta.read_consensus(spark, frame("Sample string, ResultLoc string", [("empty", "s3://s3-csu-003/v 50%/")]), base_of(tmp_path))


@pytest.fixture
def split_bytes(spark):
    """Set how many bytes of a file a task reads."""
    settings = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    before = [spark.conf.get(s) for s in settings]

    def cut(size):
        for setting, value in zip(settings, (size, "1")):
            spark.conf.set(setting, value)
    yield cut
    for setting, value in zip(settings, before):
        spark.conf.set(setting, value)


def test_headers_and_records_whatever_the_split(spark, tmp_path, split_bytes):
    for i in range(4):
        head, line = ("k,v", "k{0}_{1},{1}") if i % 2 else ("v,k", "{1},k{0}_{1}")
        write(tmp_path / "t" / f"f{i:02}.csv", "\n".join([head, *[line.format(i, j) for j in range(30)]]) + "\n")
    write(tmp_path / "t" / "g.csv", 'k,"a,b",v\nx,"1\n2",7\n"q""r",z,8\nk,"a,b",v\n')
    results = []
    for size in ("128m", "1000", "90"):
        split_bytes(size)
        df = tables.read_by_name(spark, str(tmp_path / "t"))
        results.append(sorted(((r.k, r.v, r["a,b"]) for r in df.collect()), key=repr))
    assert len(results[0]) == 123 and all(r == results[0] for r in results)
    assert ("x", "7", "1\n2") in results[0] and ('q"r', "8", "z") in results[0] and ("k", "v", "a,b") in results[0]


def test_lines_that_do_not_fit_their_header_fail(spark, tmp_path):
    for text, message in (("k,v\n1,2,EXTRA\n", "more fields"), ('k,v\n1,"2\n3,4\n', "not closed")):
        write(tmp_path / "bad.csv", text)
        with pytest.raises(Exception, match=message):
            tables.read_by_name(spark, str(tmp_path / "bad.csv")).collect()
    write(tmp_path / "short.csv", "k,v,w\n1\n,2\n")
    df = tables.read_by_name(spark, str(tmp_path / "short.csv"))
    assert in_order(df, "k", "v", "w") == [("1", None, None), (None, "2", None)]


def test_unknown_columns_become_numbers_where_all_values_are(spark, tmp_path):
    write(tmp_path / "t.csv", "Sample,depth,note,none\na,1.5,x,\nb,NA,2,\n")
    df = tables.read_samples(spark, str(tmp_path / "t.csv"))
    assert dict(df.dtypes)["depth"] == "double" and dict(df.dtypes)["note"] == dict(df.dtypes)["none"] == "string"


def batch(tmp_path, folder, name="FinalOut.csv", sample=None, location=None):
    location = location or f"s3://s3-csu-003/v3-2/{folder}/"
    write(tmp_path / "s3-csu-003" / "v3-2" / folder / name,
          f"Sample,ResultLoc,Ncount\n{sample or 'AFx-12-3456-' + folder},{location},1\n")


def test_new_batches_by_directory(spark, tmp_path, frame, rows):
    for folder in ("01", "02"):
        batch(tmp_path, folder)
    batch(tmp_path, "02", "x_FinalOut_2.csv")
    batch(tmp_path, "01", "Other.csv")
    listing = batches.list_batches(spark, base_of(tmp_path))
    assert rows(listing, "key") == [("v3-2/01/FinalOut.csv",), ("v3-2/02/FinalOut.csv",), ("v3-2/02/x_FinalOut_2.csv",)]
    known = frame("ResultLoc string", [("s3://s3-csu-003/v3-2/01/",), (None,), ("s3://s3-csu-003/v3-2/01/",)])
    assert rows(batches.new_batches(listing, known), "key") == [("v3-2/02/FinalOut.csv",), ("v3-2/02/x_FinalOut_2.csv",)]
    keys = batches.listed_keys(spark.createDataFrame(
        [("2023-01-01 10:00:00 5 v/a/FinalOut.csv",), ("2023-01-01 10:00:00 5 v/a/x.csv",)], "value string"))
    assert rows(keys) == [("v/a/FinalOut.csv",)]


def test_append_by_name(spark, rows):
    empty = tables.empty_samples(spark)
    assert empty.columns == [*SAMPLE_COLUMNS, "_ord"] and empty.count() == 0
    one = spark.createDataFrame([("a", 1.0)], "Sample string, Ncount double")
    two = spark.createDataFrame([(2.0, "b", "n")], "Ncount double, Sample string, note string")
    df = batches.append_batches(batches.append_batches(empty, batches.add_submission(one)), two)
    assert rows(df, "Sample", "Ncount", "Submission", "note") == [("a", 1.0, "A", None), ("b", 2.0, None, "n")]


@pytest.mark.parametrize("identity, late", [("file", 1), ("directory", 0)])
def test_stream_loads_each_file_once(spark, tmp_path, rows, identity, late):
    def run():
        ingest_stream(spark, str(tmp_path / "s3-csu-003"), str(tmp_path / "store"), str(tmp_path / "state"),
                      identity, files_per_batch=1)
        return rows(store.read_store(spark, str(tmp_path / "store")), "Submission")
    for folder in ("01", "02"):
        batch(tmp_path, folder)
    assert run() == [("AF-12-3456-01",), ("AF-12-3456-02",)]
    assert len(run()) == 2
    batch(tmp_path, "03")
    batch(tmp_path, "01", "FinalOut_late.csv")
    assert len(run()) == 3 + late
    orders = [r.run for r in store.read_store(spark, str(tmp_path / "store")).select("_ord.run").collect()]
    assert len(set(orders)) > 1


def test_new_directory_loads_whole_however_it_falls_into_micro_batches(spark, tmp_path, rows):
    for i in range(3):
        batch(tmp_path, "01", f"FinalOut_{i}.csv", sample=f"AFx-12-345{i}-01")
    ingest_stream(spark, str(tmp_path / "s3-csu-003"), str(tmp_path / "store"), str(tmp_path / "state"), files_per_batch=1)
    assert len(rows(store.read_store(spark, str(tmp_path / "store")), "Submission")) == 3


def test_repeated_micro_batch_replaces_its_rows(spark, tmp_path, rows):
    target = str(tmp_path / "store")
    batch(tmp_path, "01")
    paths = [r.path for r in batches.list_batches(spark, base_of(tmp_path)).collect()]
    store.append_ingest(batches.load_batches(spark, paths, 0), target, "run-0")
    for _ in range(2):
        run = store.next_run(store.read_log(spark, target, without="stream-0"))
        store.append_ingest(batches.load_batches(spark, paths, run), target, "stream-0")
    table = store.read_store(spark, target)
    assert run == 1 and table.count() == 2 and table.columns == [*SAMPLE_COLUMNS, "_ord"]


def test_repeated_header_names_are_numbered(spark, tmp_path):
    path = write(tmp_path / "a.csv", "x,x,,y,x\n1,2,3,4,5\n")
    assert in_order(tables.read_by_name(spark, path), "x", "`x.1`", "`Unnamed: 2`", "y", "`x.2`") == [("1", "2", "3", "4", "5")]


def test_readers_see_logged_ingests_only(spark, tmp_path, rows):
    """An ingest whose log entry was lost is not read until the log is repaired; a half-written one never counts."""
    target = str(tmp_path / "store")
    assert store.repair_log(spark, target) == [] and store.read_store(spark, target).count() == 0
    for n, folder in enumerate(("01", "02")):
        batch(tmp_path, folder)
        path = str(tmp_path / "s3-csu-003" / "v3-2" / folder / "FinalOut.csv")
        store.append_ingest(batches.load_batches(spark, [path], n), target, f"run-{n}-0")
    (tmp_path / "store" / "ingest=run-9-0" / "_temporary").mkdir(parents=True)
    assert store.repair_log(spark, target) == []
    shutil.rmtree(tmp_path / "store-log" / "ingest=run-1-0")
    assert rows(store.read_store(spark, target), "Submission") == [("AF-12-3456-01",)]
    assert store.repair_log(spark, target) == ["run-1-0"] and store.repair_log(spark, target) == []
    log = store.read_log(spark, target)
    assert store.stored_rows(log) == store.read_store(spark, target).count() == 2 and store.next_run(log) == 2
    assert rows(store.known_locations(log)) == [(f"s3://s3-csu-003/v3-2/{f}/",) for f in ("01", "02")]
    shutil.rmtree(tmp_path / "store" / "ingest=run-1-0")
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        store.read_store(spark, target)


def test_added_columns_have_the_kind_of_all_their_values(spark, tmp_path, rows):
    target = str(tmp_path / "store")
    for n, (depth, note) in enumerate((("1.5", "x"), ("2", "7"))):
        path = write(tmp_path / f"{n}" / "FinalOut.csv", f"Sample,depth,note,empty\nAF-12-3456-0{n},{depth},{note},NA\n")
        store.append_ingest(batches.load_batches(spark, [path], n), target, f"run-{n}-0")
    table = store.read_store(spark, target)
    assert table.columns == [*SAMPLE_COLUMNS, "depth", "note", "_ord"]
    assert dict(table.dtypes)["depth"] == "double" and dict(table.dtypes)["note"] == "string"
    assert rows(apply_filter(table, {"depth": [1.6, 9]}, {}), "Submission", "depth", "note") == [("AF-12-3456-01", 2.0, "7")]


def test_stream_rejects_unknown_identity(spark):
    with pytest.raises(ValueError):
        ingest_stream(spark, "a", "b", "c", "name")


def test_mismatched_locations(spark, tmp_path):
    batch(tmp_path, "01")
    batch(tmp_path, "02", location="s3://s3-csu-003/elsewhere/")
    paths = [r.path for r in batches.list_batches(spark, base_of(tmp_path)).collect()]
    found = batches.mismatched_batches(batches.load_batches(spark, paths, 0)).collect()
    assert len(found) == 1 and found[0].path.endswith("/02/FinalOut.csv")


def test_a_bucket_is_scanned_once(spark, tmp_path):
    """What follows from the list of batch files reads the list and not the folder."""
    folder = tmp_path / "s3-csu-003" / "v3-2" / "one"
    folder.mkdir(parents=True)
    (folder / "FinalOut_1.csv").write_text("Sample\n")
    (folder / "a_consensus.fas").write_text(">a\nA\n")
    listing = batches.list_batches(spark, f"{tmp_path}/{{bucket}}/")
    assert not any("s3-csu-003" in path for path in listing.inputFiles())
    assert [r.key for r in listing.collect()] == ["v3-2/one/FinalOut_1.csv"]


def test_files_are_listed_by_few_tasks(spark, frame, tasks, tmp_path):
    """Each task of a listing sends kilobytes to the driver, so named files do not get one each (F10)."""
    names = [f"s{i:03d}" for i in range(120)]
    for name in names:
        write(tmp_path / "s3-csu-003" / "v" / "consensus" / f"{name}_consensus.fas", f">{name}\nACGT\n")
    df = frame("Sample string, ResultLoc string", [(name, "s3://s3-csu-003/v/") for name in names])
    setting = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
    before = spark.conf.get(setting)
    counts, seqs = tasks("consensus", lambda: fasta.read_consensus(spark, df, base_of(tmp_path)))
    assert max(counts) <= 2 * spark.sparkContext.defaultParallelism and spark.conf.get(setting) == before
    assert in_order(seqs, "id", "seq") == [(name, "ACGT") for name in names]


def test_other_files_take_no_tasks_of_the_listing(spark, tasks, tmp_path):
    """Only batch result files are scanned, not the consensus files below the same prefix (F9)."""
    for i in range(400):
        write(tmp_path / "s3-csu-003" / "v3-2" / "a" / "consensus" / f"{i}.fas", ">x\nA\n")
    work = lambda: batches.list_batches(spark, base_of(tmp_path)).collect()
    counts, found = tasks("no batch file", work)
    assert found == []
    write(tmp_path / "s3-csu-003" / "v3-2" / "a b%" / "x FinalOut.csv", "Sample\nx\n")
    write(tmp_path / "s3-csu-003" / "v3-2" / "FinalOut 1" / "old.csv", "Sample\nx\n")     # the mark may stand in a folder's name
    counts, found = tasks("two batch files", work)
    assert sorted(r.key for r in found) == ["v3-2/FinalOut 1/old.csv", "v3-2/a b%/x FinalOut.csv"] and max(counts) <= 2


def test_plain_lines_are_parsed_as_a_whole(monkeypatch):
    """Batches of lines without quotes and comments equal those that are parsed line by line, and call nothing per line (F1, F5, F6)."""
    texts = ["a,b", "1,NA", "", "  ", "x, y ,", "é,nan,#", "#", ",", "2,\"q,r\"", "3,\"open", "\t"]

    def batch(lines, path="f", block=0):
        n = len(lines)
        return pa.RecordBatch.from_arrays([pa.array(lines, pa.string()), pa.array([path] * n), pa.array([block] * n, pa.int64())], ["value", "path", "block"])
    parts = [batch(texts[:2]), batch(texts), batch(texts[1:5]), batch(texts[1:6]), batch(texts[:3], block=90), batch(texts[1:5], block=90), batch(texts[1:3], "g")]
    for comment in (False, True):
        whole = pa.Table.from_batches(list(tables._lines(iter(parts), comment))).to_pylist()
        with monkeypatch.context() as patch:
            patch.setattr(tables, "_simple", lambda *_: False)
            assert whole == pa.Table.from_batches(list(tables._lines(iter(parts), comment))).to_pylist()
    calls, fields = [], tables._fields
    monkeypatch.setattr(tables, "_fields", lambda *given: calls.append(given) or fields(*given))
    list(tables._lines(iter([batch(["a,b"]), batch(["1,2"] * 1000)]), True))
    assert len(calls) == 1


def test_a_log_entry_of_many_files_is_not_made_by_one_task(spark, tmp_path):
    """One row per source file: few stand in one file, very many are combined and written by several tasks (F11)."""
    path = F.concat(F.lit("folder/with/a/long/name/"), F.sha2(F.col("id").cast("string"), 256))
    order = F.struct(F.lit(0).cast("bigint").alias("run"), path.alias("path"), F.lit(0).cast("bigint").alias("block"), F.col("id").alias("row"))
    rows = spark.range(200_000).select(F.concat(F.lit("s"), "id").alias("Sample"), order.alias("_ord"))
    for name, n in (("few", 100), ("many", 200_000)):
        store.append_ingest(rows.limit(n), str(tmp_path / "store"), name)
        files = list((tmp_path / "store-log" / f"ingest={name}").glob("part-*"))
        assert len(files) == 1 if n == 100 else len(files) > 1
    log = store.read_log(spark, str(tmp_path / "store"))
    assert store.stored_rows(log) == 200_100 and log.where("ingest = 'many'").count() == 200_000


def test_plain_tables_are_read_without_a_copy(spark, tmp_path, monkeypatch):
    """Read once, files of one header are parsed where they are selected from; any other file goes the way of all, with the same rows."""
    staged, stage = [], tables.stage
    monkeypatch.setattr(tables, "stage", lambda df, name: staged.append(name) or stage(df, name))
    plain = {"a": "i,j, d\nx,#y,1\n\n  \nNA,,3\nz\n", "b": "\ufeff\ni,j, d\n\u00e9,n/a,9\n"}
    others = {"names": "j,i, d\n1,2,3\n", "quote": 'i,j, d\n"1,1",2,3\n', "mark": "i,j, d\n\ufeff1,2,3\n", "again": "i,j, d\n1,2,3\ni,j, d\n",
              "behind": "k,l,m\ni,j, d\n"}

    def read(name, files, **options):
        folder = tmp_path / name
        folder.mkdir(exist_ok=True)
        for file, text in files.items():
            (folder / f"{file}.csv").write_text(text)
        staged.clear()
        df = tables.read_text_table(spark, str(folder), **options)
        ordered = [tuple(r) for r in df.orderBy("_ord").drop("_ord").collect()]
        return df.columns, ordered, list(staged)
    columns, ordered, copies = read("plain", plain, once=True)
    assert columns == ["i", "j", "d", "_ord"] and copies == []
    assert ordered == [("x", "#y", "1"), (None, None, "3"), ("z", None, None), ("\u00e9", None, "9")]
    assert read("plain", plain)[:2] == (columns, ordered)
    for name, text in others.items():
        files = plain | {"c": text}
        found = read(name, files, once=True)
        assert found[:2] == read(name, files)[:2] and found[2]
    with pytest.raises(Exception, match="more fields than its header"):
        read("wide", plain | {"c": "i,j, d\n1,2,3,4\n"}, once=True)
    assert read("none", {"a": ""}, once=True)[:2] == (["_ord"], [])
