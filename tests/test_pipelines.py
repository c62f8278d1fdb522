import glob
import json
import shutil

import pytest

from cohortlens.operators.dedup import best_per_key
from cohortlens.plans import curation, incremental
from cohortlens.sources import tables

BUCKET = "s3-csu-003"
SEQUENCES = {"A": "ACGTACGTAA", "B": "ACGTACGTCA", "C": "ATGTACGTCN", "D": "ATGTACGTGA"}


def write(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text)
    return str(path)


def sample(name, number, outcome="Pass", group="x", ncount=10, mapped=95, folder="b1"):
    return f"AFx-12-{number}-20-{name},{mapped},{outcome},BritishbTB,{group},{ncount},s3://{BUCKET}/v3-2/{folder}/"


HEADER = "Sample,pcMapped,Outcome,flag,group,Ncount,ResultLoc\n"


@pytest.fixture
def world(tmp_path):
    """Two batches in a bucket folder, their sequences, cattle, movements, bounds and exclusions."""
    first = [sample("A", 1111), sample("Z", 1111, mapped=80), sample("B", 2222), sample("C", 3333, group="y", ncount=5)]
    second = [sample("D", 4444, folder="b2"), sample("E", 5555, outcome="Fail", folder="b2"),
              sample("F", 6666, ncount=99, folder="b2"), sample("G", 7777, folder="b2"), sample("H", 8888, folder="b2")]
    for folder, lines in (("b1", first), ("b2", second)):
        write(tmp_path / BUCKET / "v3-2" / folder / "FinalOut.csv", HEADER + "\n".join(lines) + "\n")
        for line in lines:
            name = line.split(",")[0]
            seq = SEQUENCES.get(name[-1], "ACGTACGTAA")
            write(tmp_path / BUCKET / "v3-2" / folder / "consensus" / f"{name}_consensus.fas", f">{name}_consensus\n{seq}\n")
    keys = ["1111", "2222", "3333", "4444", "7777", "9999"]
    write(tmp_path / "cm" / "cattle.csv", "CVLRef,clade,RawEartag2\n" + "".join(f"AF-12-{k}-20,old,c{k}\n" for k in keys))
    write(tmp_path / "cm" / "movement.csv", "SampleName,StandardEartag,Stay_Length\n" + "".join(
        f"AF-12-{k}-20,m{k},\n" * 2 for k in [*keys, "8888"]))
    write(tmp_path / "clades.csv", "clade,maxN\ny,7\nx,50\n")
    write(tmp_path / "outliers.txt", "AF-12-7777-20\nnobody\n")
    return tmp_path


def lines(path):
    return [line for part in sorted(glob.glob(f"{path}/part-*")) for line in open(part).read().splitlines()]


def record(path):
    return json.loads("\n".join(lines(path)))


def common(world):
    return {"store": f"{world}/store", "base": f"file:{world}/{{bucket}}/"}


def test_production(spark, world):
    results = f"{world}/results"
    metrics = curation.production_pipeline(
        spark, results, cattle_movements=f"{world}/cm", thresholds=f"{world}/clades.csv",
        exclusions=f"{world}/outliers.txt", light_mode=False, max_distance=None, **common(world))
    assert {k: v for k, v in metrics.items() if k not in ("datetime", "git_commit")} == {
        "total_number_of_wgs_samples": 9, "batches_with_mismatched_location": 0,
        "number_of_duplicate_WGS_submissions": 1, "number_of_passed_samples": 5,
        "original_number_of_wgs_records": 5, "original_number_of_cattle_records": 6,
        "original_number_of_movement_records": 14, "consistified_number_of_wgs_records": 4,
        "consistified_number_of_cattle_records": 4, "consistified_number_of_movement_records": 8,
        "number_of_snps": 2}
    # Rows follow the threshold table (class y first), then the order of the batch files.
    names = [f"AF-12-{k}-20" for k in ("3333", "1111", "2222", "4444")]
    grid = ["0211", "2012", "1102", "1220"]
    assert [line for line in lines(f"{results}/snps") if line != "i,j,dist"] == [
        f"{a},{b},{d}" for a, row in zip(names, grid) for b, d in zip(names, row)]
    assert lines(f"{results}/snps_fasta") == [
        ">AFx-12-3333-20-C_consensus", "TC", ">AFx-12-1111-20-A_consensus", "CA",
        ">AFx-12-2222-20-B_consensus", "CC", ">AFx-12-4444-20-D_consensus", "TG"]
    report = tables.read_text_table(spark, f"{results}/metadata/report")
    assert sorted(tuple(r) for r in report.select(
        "Submission", "eartag", "Outcome", "Ncount", "outlier", "wgs_data", "cattle_data", "movement_data").collect()) == [
        ("AF-12-5555-20", None, "Fail", "Pass", "false", "true", "false", "false"),
        ("AF-12-6666-20", None, "Pass", "Fail", "false", "true", "false", "false"),
        ("AF-12-7777-20", "c7777", "Pass", "Pass", "true", "true", "true", "true"),
        ("AF-12-8888-20", "m8888", "Pass", "Pass", "false", "true", "false", "true"),
        ("AF-12-9999-20", "c9999", None, None, None, "false", "true", "true")]
    cattle = tables.read_text_table(spark, f"{results}/cattle")
    assert {r.CVLRef: r.clade for r in cattle.collect()} == {
        "AF-12-1111-20": "x", "AF-12-2222-20": "x", "AF-12-3333-20": "y", "AF-12-4444-20": "x"}
    named = record(f"{results}/metadata/filters.json")
    assert lines(named["not_Submission"]) == ["AF-12-7777-20", "nobody"]
    assert [json.loads(line) for line in lines(named["classes"])] == [
        {"clade": "y", "Ncount": [0.0, 7.0]}, {"clade": "x", "Ncount": [0.0, 50.0]}]
    assert record(f"{results}/metadata/metadata.json")["number_of_snps"] == 2
    # A second phylo run finds the consistent samples of the first.
    assert curation.phylo(spark, results, base=f"file:{world}/{{bucket}}/", light_mode=True) == {"number_of_snps": 2}


def test_full_pipeline_and_second_update(spark, world):
    results = f"{world}/results"
    spec = write(world / "config.json", json.dumps({"pcMapped": [90, 100], "Ncount": [0, 50]}))
    metrics = curation.full_pipeline(spark, results, config=spec, cattle_movements=f"{world}/cm", max_distance=None, **common(world))
    assert metrics["number_of_passed_samples"] == 6 and metrics["consistified_number_of_wgs_records"] == 5
    assert record(f"{results}/metadata/filters.json") == {"pcMapped": [90, 100], "Ncount": [0, 50]}
    assert len([line for line in lines(f"{results}/snps") if line != "i,j,dist"]) == 25
    metrics, samples = curation.update_samples(spark, **common(world))
    assert metrics["total_number_of_wgs_samples"] == 9
    write(world / BUCKET / "v3-2" / "b3" / "FinalOut.csv", HEADER + sample("A", 1111, folder="b3") + "\n")
    metrics, samples = curation.update_samples(spark, **common(world))
    assert metrics["total_number_of_wgs_samples"] == 10
    # All criteria tie, so the row of the earlier batch stays.
    _, deduped = curation.de_duplicate(results, samples)
    kept = deduped.where("Submission = 'AF-12-1111-20'").first()
    assert kept.ResultLoc.endswith("/b1/") and kept.Sample.endswith("-A")
    metrics, _, _ = curation.sample_filter(results, samples, Ncount=[0, 50], group=None)
    assert metrics == {"number_of_passed_samples": 8}


def test_pipelines_put_out_far_pairs_unless_limited(spark, world):
    letters = {"A": "A", "B": "C", "C": "G", "D": "T"}     # unlike letters differ at 20 sites; four sequences that pass all filters hold A
    for path in glob.glob(f"{world}/{BUCKET}/v3-2/*/consensus/*.fas"):
        head = open(path).readline()
        open(path, "w").write(f"{head}{letters.get(head.split('_')[0][-1], 'A') * 20}\n")
    production = {"cattle_movements": f"{world}/cm", "thresholds": f"{world}/clades.csv", "exclusions": f"{world}/outliers.txt"}
    for name, arguments, limit, count in (("production_pipeline", production, None, 16), ("full_pipeline", {}, 19, 19)):
        results = f"{world}/{name}"
        getattr(curation, name)(spark, results, **arguments, max_distance=limit, **common(world))
        assert len([line for line in lines(f"{results}/snps") if line != "i,j,dist"]) == count
        assert record(f"{results}/metadata/metadata.json").get("max_distance") == limit


def test_production_that_failed_goes_on_behind_its_last_step(spark, world, monkeypatch):
    arguments = {"cattle_movements": f"{world}/cm", "thresholds": f"{world}/clades.csv", "exclusions": f"{world}/outliers.txt", "max_distance": 2}
    ran = []

    def counted(name, fail=False):
        function = getattr(curation, name)

        def call(*args, **options):
            ran.append(name)
            if fail and ran.count(name) == 1:
                raise OSError("lost")
            return function(*args, **options)
        monkeypatch.setattr(curation, name, call)
    counted("best_per_key"), counted("consistify"), counted("exclusion_report", fail=True)
    with pytest.raises(OSError, match="lost"):
        curation.production_pipeline(spark, f"{world}/r", **arguments, **common(world))
    assert ran == ["best_per_key", "consistify", "exclusion_report"]
    metrics = curation.production_pipeline(spark, f"{world}/r", **arguments, **common(world))
    assert ran[3:] == ["exclusion_report"] and metrics["consistified_number_of_wgs_records"] == 4
    assert metrics["number_of_duplicate_WGS_submissions"] == 1 and metrics["number_of_snps"] == 2 and len(lines(f"{world}/r/metadata/report")) > 5
    again = curation.production_pipeline(spark, f"{world}/r", **arguments, **common(world))     # a run that ended begins anew
    assert ran[4:] == ["best_per_key", "consistify", "exclusion_report"]
    assert {k: v for k, v in again.items() if k != "datetime"} == {k: v for k, v in metrics.items() if k != "datetime"}


def test_samples_table_as_csv_in_and_out(spark, world):
    """The table begins with a CSV that knows the first batch already, and is written back with the second."""
    old = HEADER.replace("\n", ",Submission,depth\n") + sample("A", 1111) + ",AF-12-1111-20,4\n"
    path = write(world / "samples.csv" / "old.csv", old).rsplit("/", 1)[0]
    metrics, stored = curation.update_samples(spark, samples_csv=path, **common(world))
    assert metrics["total_number_of_wgs_samples"] == 6 == stored.count()      # batch b1 is known, so only b2 loads
    back = tables.read_samples(spark, path)
    columns = ["Submission", "Ncount", "depth"]
    assert sorted(map(tuple, back.select(columns).collect()), key=repr) == sorted(map(tuple, stored.select(columns).collect()), key=repr)
    assert curation.update_samples(spark, samples_csv=path, **common(world))[0]["total_number_of_wgs_samples"] == 6


def test_second_update_reads_no_stored_samples(spark, world):
    """What is known comes from the log: an update that finds nothing new does not open the samples' files."""
    curation.update_samples(spark, **common(world))
    for path in glob.glob(f"{world}/store/ingest=*/part-*"):
        open(path, "wb").write(b"no longer a Parquet file")
    metrics, samples = curation.update_samples(spark, **common(world))
    assert metrics == {"total_number_of_wgs_samples": 9, "batches_with_mismatched_location": 0}
    with pytest.raises(Exception):
        samples.collect()


def test_survivors_of_ingests(spark, world):
    """An ingest rewrites the buckets of its keys alone; the table equals the survivors of all samples."""
    store, kept = f"{world}/store", f"{world}/best"
    update = lambda: incremental.update_best(spark, store, kept, buckets=64)
    curation.update_samples(spark, **common(world))
    # Of 8 keys two share a bucket.
    assert update() == {"number_of_duplicate_WGS_submissions": 1, "rewritten_buckets": 7}
    assert update()["rewritten_buckets"] == 0
    write(world / BUCKET / "v3-2" / "b3" / "FinalOut.csv", HEADER + sample("Y", 2222, mapped=99, folder="b3") + "\n")
    _, samples = curation.update_samples(spark, **common(world))
    shutil.rmtree(kept + "-log/entry=0/_temporary", ignore_errors=True)
    assert update() == {"number_of_duplicate_WGS_submissions": 2, "rewritten_buckets": 1}
    best = {tuple(r) for r in best_per_key(samples, curation.DEFAULT_CRITERIA).select("Submission", "Sample").collect()}
    assert {tuple(r) for r in incremental.read_best(spark, store, kept).select("Submission", "Sample").collect()} == best and len(best) == 8
    # A version whose log entry was lost counts for nothing, and the next update writes it again.
    shutil.rmtree(f"{kept}-log/entry=1")
    assert incremental.read_best(spark, store, kept).where("Sample LIKE '%Y'").isEmpty()
    assert update()["rewritten_buckets"] == 1 and not incremental.read_best(spark, store, kept).where("Sample LIKE '%Y'").isEmpty()
    with pytest.raises(ValueError, match="other rules"):
        incremental.update_best(spark, store, kept, buckets=3)


def test_full_pipeline_on_all_samples(spark, world):
    metrics = curation.full_pipeline(spark, f"{world}/r", filter_input="all", download_only=True,
                                     group=["x"], max_distance=None, **common(world))
    assert metrics["number_of_passed_samples"] == 7 and "number_of_snps" not in metrics
    assert len(lines(f"{world}/r/multi_fasta")) == 14


def test_threshold_job(spark, world):
    metrics, bounds = curation.threshold_job(spark, f"{world}/r", p="0.5", **common(world))
    assert {r.clade: r.maxN for r in bounds.collect()} == {"x": 10.0, "y": 5.0}
    assert metrics["number_of_passed_samples"] == 8 and metrics["number_of_duplicate_WGS_submissions"] == 1


def test_phylo_needs_a_cohort(spark, tmp_path):
    with pytest.raises(ValueError, match="no filtered samples"):
        curation.phylo(spark, str(tmp_path))


def test_update_in_rounds_loads_every_file(spark, world, monkeypatch):
    monkeypatch.setattr(curation, "PATHS_PER_ROUND", 1)
    metrics, samples = curation.update_samples(spark, **common(world))
    assert metrics["total_number_of_wgs_samples"] == 9
    assert curation.update_samples(spark, **common(world))[0]["total_number_of_wgs_samples"] == 9


@pytest.mark.parametrize("failing", [2, 3])
def test_update_that_failed_after_a_round_is_completed(spark, world, monkeypatch, failing):
    """The files of directory b1 are cut by a round border."""
    extra = HEADER + sample("I", 9999) + "\n"
    write(world / BUCKET / "v3-2" / "b1" / "MoreFinalOut.csv", extra)
    monkeypatch.setattr(curation, "PATHS_PER_ROUND", 1)
    calls, append = [], curation.append_ingest

    def fail(*args):
        calls.append(args)
        if len(calls) == failing:
            raise OSError("lost")
        append(*args)
    monkeypatch.setattr(curation, "append_ingest", fail)
    with pytest.raises(OSError, match="lost"):
        curation.update_samples(spark, **common(world))
    write(world / BUCKET / "v3-2" / "a0" / "FinalOut.csv", HEADER + sample("J", 1010, folder="a0") + "\n")
    for _ in range(2):
        metrics, samples = curation.update_samples(spark, **common(world))
        assert metrics["total_number_of_wgs_samples"] == 11 == samples.select("Sample").distinct().count()
    assert metrics["batches_with_mismatched_location"] == 0


def test_update_needs_batches(spark, tmp_path):
    (tmp_path / BUCKET / "v3-2").mkdir(parents=True)
    with pytest.raises(FileNotFoundError):
        curation.update_samples(spark, f"{tmp_path}/s", f"file:{tmp_path}/{{bucket}}/")


def test_large_buckets_are_written_in_pieces(spark, world, monkeypatch):
    """A bucket of survivors is cut by keys, so that no task holds a whole one however large it is (F11)."""
    monkeypatch.setattr(incremental, "PIECE_ROWS", 2)
    store, kept = f"{world}/store", f"{world}/best"
    _, samples = curation.update_samples(spark, **common(world))
    assert incremental.update_best(spark, store, kept, buckets=1) == {"number_of_duplicate_WGS_submissions": 1, "rewritten_buckets": 1}
    assert len(glob.glob(f"{kept}/version=0/bucket=0/part-*")) > 1
    best = sorted(tuple(r) for r in best_per_key(samples, curation.DEFAULT_CRITERIA).select("Submission", "Sample").collect())
    assert sorted(tuple(r) for r in incremental.read_best(spark, store, kept).select("Submission", "Sample").collect()) == best and len(best) == 8


def test_near_pairs_are_not_sorted(spark, world, monkeypatch):
    """The pairs of a pipeline come in record order by themselves, and are compressed where they are many."""
    monkeypatch.setattr(curation, "write_distances", None)
    results = f"{world}/results"
    curation.full_pipeline(spark, results, max_distance=None, **common(world))
    found = [line for line in lines(f"{results}/snps") if line != "i,j,dist"]
    monkeypatch.setattr(curation, "PLAIN_PAIRS", 10)
    curation.full_pipeline(spark, f"{world}/packed", max_distance=None, **common(world))
    assert len(found) == 49 and not glob.glob(f"{world}/packed/snps/*.txt")
    packed = tables.read_text_table(spark, f"{world}/packed/snps", once=True)
    assert [",".join(r) for r in packed.orderBy("_ord").select("i", "j", "dist").collect()] == found
