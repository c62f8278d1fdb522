"""The other operators: round trips, plain-Python versions and held-out accuracy, with odd rows."""

import collections
import hashlib
import math
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from llm_samples import prose
from cohortlens.llm import backoff, decontaminate, fingerprints, licences, mixing, quality, queries, token_output

SF = "/root/testdata/sf0.001"


# --- Token output ----------------------------------------------------------------------------

def test_tokens_round_trip_through_the_index(spark, corpus, odd_rows, tmp_path):
    from tokenizers import Tokenizer
    path = queries.tokenizer()
    whole = Tokenizer.from_file(path)
    rows = [*odd_rows, (30, "two  blanks\tand é tabs"), (31, " <|endoftext|> as text "), (32, "a <|endoftext|> b")]
    parts = token_output.write(corpus(rows), str(tmp_path / "out"), path, keys_per_part=3)
    got = token_output.read_back(spark, str(tmp_path / "out"), parts).orderBy("start").collect()
    coded = collections.Counter()
    for i, t in rows:
        ids = np.array([*whole.encode(t or "", add_special_tokens=False).ids, 2], "<u4")
        coded[i, len(ids), zlib.crc32(ids.tobytes())] += 1
    assert collections.Counter((r.doc_id, r.n_tokens, r.ids_crc32) for r in got) == coded
    starts = np.cumsum([0, *[r.n_tokens for r in got]])[:-1].tolist()
    assert [r.start for r in got] == starts
    ids = [r.doc_id for r in got]
    assert ids == sorted(ids, key=lambda i: (i is not None, i))
    assert collections.Counter(r.doc_id for r in got if r.indexed) == {i: 1 for i, _ in rows if i is not None}
    asked = spark.createDataFrame([(i,) for i in (30, 31, 12345, None)], "doc_id bigint")
    assert sorted(r.doc_id for r in token_output.look_up(spark, str(tmp_path / "out"), asked, parts).collect()) == [30, 31]


@pytest.fixture
def small_shards(spark):
    """Keeps the small partitions of a few rows apart, so that there are several shards."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


@pytest.mark.parametrize("tokens", [1, 50, 1 << 18])
def test_ids_are_fetched_by_key(spark, corpus, odd_rows, tmp_path, monkeypatch, small_shards, tokens):
    """Blocks of any size: a repeated key's rows may fill several blocks and shards."""
    from tokenizers import Tokenizer
    monkeypatch.setattr(token_output, "BLOCK_TOKENS", tokens)
    monkeypatch.setattr(token_output, "ENCODED_BYTES", 200)
    whole = Tokenizer.from_file(queries.tokenizer())
    rows = [*odd_rows, *((40, prose(100 + k, 30)) for k in range(25)), (41, "behind them"), (-5, "a negative key"), (-5, None)]
    folder = str(tmp_path / "out")
    parts = token_output.write(corpus(rows).repartition(3), folder, queries.tokenizer(), keys_per_part=3)
    held = token_output._entries(spark, folder).where("doc_id = 40").select("shard", "block").distinct().collect()
    assert len({r.shard for r in held}) > 1 and (tokens > 50 or len(held) > 4)
    wanted = [40, 8, 3, -5, 2, 2, 777, None]
    got = token_output.fetch(spark, folder, spark.createDataFrame([(i,) for i in wanted], "doc_id bigint"), parts).collect()
    coded = collections.Counter((i, tuple([*whole.encode(t or "", add_special_tokens=False).ids, 2])) for i, t in rows if i in (40, 8, 3, -5, 2))
    assert collections.Counter((r.doc_id, tuple(np.frombuffer(r.ids, "<u4").tolist())) for r in got) == coded
    assert sorted(r.doc_id for r in got if r.indexed) == [-5, 2, 3, 8, 40] and all(r.n_tokens * 4 == len(r.ids) for r in got)
    back = token_output.read_back(spark, folder, parts).collect()
    assert len(back) == len(rows) and sum(r.indexed for r in back) == len({i for i, _ in rows if i is not None})
    nothing = token_output.fetch(spark, folder, spark.createDataFrame([(777,)], "doc_id bigint"), parts)
    assert nothing.count() == 0


def test_a_fetch_reads_the_shards_of_its_keys(spark, corpus, tmp_path, small_shards):
    folder = str(tmp_path / "out")
    parts = token_output.write(corpus([(i, prose(i, 20)) for i in range(200)]).repartition(4), folder, queries.tokenizer())
    assert spark.read.parquet(f"{folder}/shards").count() > 1
    one = token_output.fetch(spark, folder, spark.createDataFrame([(150,)], "doc_id bigint"), parts)
    assert [r.doc_id for r in one.collect()] == [150]
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [" in plan and "EqualTo(shard," in plan


def test_no_documents_give_empty_files(spark, corpus, tmp_path):
    parts = token_output.write(corpus([]), str(tmp_path / "out"), queries.tokenizer())
    assert token_output.read_back(spark, str(tmp_path / "out"), parts).count() == 0


@pytest.mark.parametrize("n", [1, 2, 7, 5000])
def test_the_perfect_hash_is_minimal(n):
    keys = np.array(random.Random(n).sample(range(-10 ** 15, 10 ** 15), n))
    pilots, slot = token_output.perfect_hash(keys)
    assert sorted(slot.tolist()) == list(range(n))
    assert (token_output.slots_of(keys, n, pilots) == slot).all()


# --- Mixing ----------------------------------------------------------------------------------

def test_targets_and_copies(spark, corpus):
    rng = random.Random(4)
    sources = [rng.choice(["a", "a", "a", "b", "é", None]) for _ in range(400)]
    rows = [(k, " w" * rng.randrange(0, 60)) for k in range(400)]
    docs = corpus(rows, sources).withColumn("size", mixing.word_count("text"))
    got = mixing.mixed(docs).collect()
    assert len(got) == 400
    size, target, taken = collections.Counter(), {}, collections.Counter()
    for r in got:
        size[r.source] += r.size
        target[r.source] = r.target
        taken[r.source] += r.copies * r.size
        assert 0 <= r.copies <= 2
    total, weights, full = 1.5 * sum(size.values()), dict(zip(sorted(size, key=lambda s: (s is None, s)), [3, 1, 2, 3])), set()
    while True:
        level = (total - sum(2 * size[s] for s in full)) / sum(w for s, w in weights.items() if s not in full)
        more = {s for s in weights if s not in full and weights[s] * level > 2 * size[s]}
        if not more:
            break
        full |= more
    for s in size:
        assert target[s] == pytest.approx(2 * size[s] if s in full else weights[s] * level)
        assert abs(taken[s] - target[s]) <= 2 * 60
    again = {r.doc_id: r.copies for r in mixing.mixed(docs).collect()}
    assert again == {r.doc_id: r.copies for r in got}


def test_mix_of_odd_rows(spark, corpus, odd_rows):
    docs = corpus(odd_rows).withColumn("size", mixing.word_count("text"))
    got = mixing.mixed(docs).collect()
    assert len(got) == len(odd_rows) and all(r.source_size == sum(len((t or "").split()) for _, t in odd_rows) for r in got)
    assert mixing.mixed(docs.where("false")).count() == 0
    nothing = mixing.mixed(docs.withColumn("size", F.lit(None).cast("bigint"))).collect()
    assert {(r.size, r.target, r.copies) for r in nothing} == {(0, 0.0, 0)}


# --- Decontamination -------------------------------------------------------------------------

def test_items_are_found_within_the_edit_budget():
    rng = random.Random(8)
    items = [(i, prose(i, 25)) for i in range(12)]
    index = decontaminate.Index.of(items, 8, decontaminate.EDIT_RATE)
    for n in range(80):
        i, text = rng.choice(items)
        k = decontaminate.budget(len(text), 8, decontaminate.EDIT_RATE)
        letters = list(text)
        for _ in range(rng.randrange(k + 1)):
            at = rng.randrange(len(letters))
            letters[at:at + 1] = rng.choice([["é"], [], [letters[at], "q"]])
        doc = prose(100 + n, 40) + " " + "".join(letters).upper() + "\n" + prose(200 + n, 40)
        found = decontaminate.search(index, ["", doc, "short"], 8)
        assert any(t == 1 and index.ids[item] == i and e <= k for t, item, _, _, e in found)
        assert not decontaminate.search(index, [prose(300 + n, 200)], 8)


def test_alignment_equals_full_table():
    rng = random.Random(2)
    for _ in range(60):
        item, text = ("".join(rng.choice("abc") for _ in range(n)) for n in (rng.randrange(1, 9), rng.randrange(0, 14)))
        table = [[0] * (len(text) + 1)]
        for c in item:
            row = [table[-1][0] + 1]
            for j, d in enumerate(text):
                row.append(min(table[-1][j] + (c != d), table[-1][j + 1] + 1, row[-1] + 1))
            table.append(row)
        wide = len(item) + len(text)
        hit = decontaminate.align(decontaminate.code_points(item), decontaminate.code_points(text), -wide, wide, wide)
        assert hit[0] == min(table[-1])


def test_contamination_of_odd_rows(spark, corpus, odd_rows):
    item = prose(70, 30)
    rows = [*odd_rows, (40, "x " + item + " y"), (41, item.upper()), (None, item)]
    bench = spark.createDataFrame([(1, item), (2, None), (3, "tiny"), (None, item), (1, item), (4, prose(71, 30))], "item_id bigint, text string")
    for size in (decontaminate.CHUNK_BYTES, 200):
        got = decontaminate.contaminated(corpus(rows), bench, chunk_bytes=size).collect()
        assert sorted(((r.doc_id, r.item_id, r.start, r.end, r.edits) for r in got), key=repr) == sorted(
            [(d, i, at, at + len(item), 0) for d, at in ((40, 2), (41, 0), (None, 0)) for i in (1, None)], key=repr)
    assert decontaminate.contaminated(corpus(rows), bench.where("false")).count() == 0
    assert decontaminate.contaminated(corpus([]), bench).count() == 0


def test_items_equal_a_full_edit_table():
    rng = random.Random(12)
    for seed in range(25):
        items = [(i, "".join(rng.choice("abcde ") for _ in range(n)).strip() or "a") for i, n in enumerate([9, 14, 26, 30, 52, 60])]
        texts = []
        for _ in range(6):
            parts = ["".join(rng.choice("abcde ") for _ in range(rng.randrange(60)))]
            for _, item in rng.sample(items, 2):
                letters = list(item)
                for _ in range(rng.randrange(7)):
                    at = rng.randrange(len(letters))
                    letters[at:at + 1] = rng.choice([["z"], [], [letters[at], "q"]])
                    letters = letters or ["a"]
                parts += ["".join(letters), "".join(rng.choice("abcde ") for _ in range(rng.randrange(30)))]
            texts.append("".join(parts))
        index = decontaminate.Index.of(items, 8, decontaminate.EDIT_RATE)
        found = {(t, index.ids[i]) for t, i, *_ in decontaminate.search(index, texts, 8)}
        expected = set()
        for t, text in enumerate(texts):
            for i, item in items:
                row = [0] * (len(text) + 1)
                for c in item:
                    new = [row[0] + 1]
                    for j, d in enumerate(text):
                        new.append(min(row[j] + (c != d), row[j + 1] + 1, new[-1] + 1))
                    row = new
                if len(item) >= 8 and min(row) <= decontaminate.budget(len(item), 8, decontaminate.EDIT_RATE):
                    expected.add((t, i))
        assert {(t, i) for t, i in found if len(items[i][1]) >= 8} == expected


def test_short_items_match_as_they_stand():
    index = decontaminate.Index.of([(1, "Cat"), (2, "cat"), (3, "北京"), (None, "a b"), (5, "--"), (6, " \n"), (7, "é")], 8, 0.08)
    texts = ["a cat, concat cats CAT", "我在北京市", "cat", "", "a\tb a  b ----", "caté é", "ca", "t"]
    got = [(t, index.ids[i], a, z) for t, i, a, z, _ in decontaminate.search(index, texts, 8)]
    assert sorted(got, key=repr) == sorted([
        (0, 1, 2, 5), (0, 2, 2, 5), (0, 1, 19, 22), (0, 2, 19, 22), (1, 3, 2, 4), (2, 1, 0, 3), (2, 2, 0, 3),
        (4, None, 0, 3), (4, 5, 9, 11), (4, 5, 11, 13), (5, 7, 5, 6)], key=repr)


def test_frequent_grams_in_pieces(monkeypatch):
    items = [(i, "the same beginning of all " + prose(i, 12)) for i in range(40)]
    texts = [t for _, t in items[:9]] + ["the same beginning of all " * 30]
    index = decontaminate.Index.of(items, 8, 0.08)
    whole = decontaminate.search(index, texts, 8)
    assert {(t, index.ids[i]) for t, i, *_ in whole} == {(k, k) for k in range(9)}
    monkeypatch.setattr(decontaminate, "ENTRIES", 100)
    monkeypatch.setattr(decontaminate, "CELLS", 90)
    assert sorted(decontaminate.search(index, texts, 8)) == sorted(whole)


# --- Quality ---------------------------------------------------------------------------------

def test_quality_on_the_held_out_fold(spark):
    sf = "/root/testdata/sf0.01"
    got = {r.doc_id: r for r in queries.op7_quality_classifier(spark, sf).collect()}
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 4 == 2) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.7)
               for i, r in got.items())
    labels = spark.read.parquet(f"{sf}/labels.parquet").collect()
    held = [(got[r.doc_id].predicted, r.quality) for r in labels if got[r.doc_id].held_out]
    assert len(held) > 50 and np.mean([p == q for p, q in held]) > 0.95


def test_quality_of_odd_rows_and_labels(spark, corpus, odd_rows):
    labels = spark.createDataFrame([(1, 1), (None, 0), (2, None), (3, 5)], "doc_id bigint, quality int")
    model = quality.train(corpus(odd_rows), labels)
    got = quality.score(corpus(odd_rows).withColumn("score", F.lit("clash")), model).collect()
    assert len(got) == len(odd_rows) and all(r.score == pytest.approx(2 / 3) for r in got)
    assert quality.score(corpus([]), model).count() == 0


# --- Licences --------------------------------------------------------------------------------

def test_licence_families(spark, corpus, odd_rows):
    plain = [prose(s, 40).capitalize() + "." for s in range(60)]
    model = licences.fit(plain)
    rows = [*odd_rows, *[(50 + k, plain[k] + "\n" + t[0] + ".\n" + plain[k + 1]) for k, t in enumerate(licences.TEMPLATES.values())],
            (90, "Use is subject to license terms of the vendor.")]
    got = {r.doc_id: r for r in licences.scan(corpus(rows), model).collect()}
    for k, name in enumerate(licences.TEMPLATES):
        assert (got[50 + k].family, got[50 + k].confirmed) == (name, True)
    assert got[90].family == "unknown" and not got[90].confirmed
    assert {got[i].family for i in (1, 3, 4, 5, 7, None)} == {"none"}
    assert licences.scan(corpus([]), model).count() == 0


def plain_scan(model, text):
    """What the model says of one text, without Spark."""
    best, n = None, 0
    for paragraph in (text or "").split("\n"):
        held = licences.grams_of(paragraph) & model.weights.keys()
        if not held:
            continue
        logits = (np.sum([model.weights[g] for g in held], axis=0) + model.bias) / model.temperature
        p = np.exp(logits - logits.max()) / np.exp(logits - logits.max()).sum()
        at, top = int(np.argmax(p[:-2])), float(p[:-2].max())
        family = model.classes[at] if top >= licences.THRESHOLD else licences.UNKNOWN if p[-1] < 1 - licences.THRESHOLD else None
        if family is None:
            continue
        n += 1
        parts = [licences.grams_of(t) & model.weights.keys() for t in licences.TEMPLATES.get(family, [])]
        similar = max([len(held & part) / len(part) for part in parts if part], default=0.0)
        notice = (similar >= licences.SIMILAR, round(top, 9), round(similar, 9), family)
        best = max(best or notice, notice)
    confirmed, top, similar, family = best or (False, 0.0, 0.0, "none")
    return family, top, similar, confirmed, n


def test_licences_equal_a_plain_scan_row_by_row(spark, corpus, odd_rows):
    plain = [prose(s, 40).capitalize() + "." for s in range(60)]
    model = licences.fit(plain)
    notices = [t for ts in [*licences.TEMPLATES.values(), licences.GENERAL] for t in ts]
    rng = random.Random(4)
    rows = [*odd_rows, (None, "nothing at all here"), (None, "Released under the MIT License"), (None, "Released under the MIT License")]
    for k in range(60):
        words = rng.choice(notices).split()
        text = " ".join(words[rng.randrange(3):len(words) - rng.randrange(3)])
        rows.append((rng.choice([None, 70, 100 + k]), "\n".join([plain[k], plain[k - 1] + " " + text + " " + plain[k - 2], rng.choice(notices), text])))
    got = sorted(((r.doc_id, r.family, round(r.probability, 6), round(r.similarity, 6), r.confirmed, r.n_notices)
                  for r in licences.scan(corpus(rows), model).collect()), key=repr)
    want = sorted(((i, f, round(p, 6), round(s, 6), c, n) for i, (f, p, s, c, n) in ((i, plain_scan(model, t)) for i, t in rows)), key=repr)
    assert got == want


def test_licence_training_takes_different_whole_paragraphs(spark, corpus, monkeypatch):
    monkeypatch.setattr(licences, "fit", lambda paragraphs: paragraphs)
    many = [prose(s, 6) for s in range(300)]
    docs = corpus([(k, "\n".join([p, "one line that all have", "", "x" * 20_000])) for k, p in enumerate(many)] + [(None, None)])
    got = licences.train(docs, sample=50)
    assert len(got) == len(set(got)) == 50 and set(got) <= {*many, "one line that all have"}
    assert sorted(licences.train(docs, sample=1000)) == sorted({*many, "one line that all have"})
    assert licences.train(corpus([])) == []


# --- Fingerprints ----------------------------------------------------------------------------

def prints(df):
    return {r.name: r.p for r in fingerprints.fingerprinted(df, "text", "p").select("name", "p").collect()}


def test_fingerprints_ignore_order_and_take_edits(spark):
    one, two = "First part. Second part.\n", "Third part!\n"
    df = spark.createDataFrame([("ab", one + two), ("ba", two + one), ("a", one), ("b", two), ("none", None), ("empty", "")], "name string, text string")
    p = prints(df)
    assert p["ab"] == p["ba"] != p["a"] and p["none"] == p["empty"] == [0] * 81
    rows = spark.createDataFrame([(p["a"], p["b"], p["ab"])], "a array<bigint>, b array<bigint>, ab array<bigint>")
    both = rows.select(fingerprints.combine(F.col("a"), F.col("b")).alias("x"), fingerprints.combine(F.col("ab"), F.col("b"), -1).alias("y")).first()
    assert both.x == p["ab"] and both.y == p["a"]


def test_next_documents_and_edits(spark, corpus, odd_rows):
    rows = [r for r in odd_rows if r[0] is not None and r[0] not in (2, 8)]
    got = {r.doc_id: (r.text, r.next_text) for r in fingerprints.with_next(corpus(rows)).collect()}
    order = sorted(rows, key=lambda r: -r[0])
    for k, (i, t) in enumerate(order):
        t, after = t or "", order[(k + 1) % len(order)][1] or ""
        assert got[i] == (t, after[:len(t) // 2])
    assert fingerprints.with_next(corpus(odd_rows)).count() == len(odd_rows)
    assert fingerprints.with_next(corpus([])).count() == 0


def test_fingerprint_query(spark):
    docs = sorted(((r.doc_id, r.text or "") for r in spark.read.parquet(f"{SF}/documents.parquet").collect()), reverse=True)
    got = {r.doc_id: r for r in queries.op8_document_fingerprints(spark, SF).collect()}
    by_text = collections.defaultdict(set)
    for k, (i, t) in enumerate(docs):
        half = len(t) // 2
        edit = t[:len(t) - half] + docs[(k + 1) % len(docs)][1][:half]
        assert (got[i].n_chars, got[i].edited_sha256) == (len(t), hashlib.sha256(edit.encode()).hexdigest())
        assert (got[i].near_edited == 1) == (got[i].fingerprint == got[i].edited_fingerprint)
        by_text[t].add(got[i].fingerprint)
    assert all(len(p) == 1 for p in by_text.values()) and len({p for s in by_text.values() for p in s}) == len(by_text)
    assert np.mean([r.near_edited for r in got.values()]) > 0.2 > 0.05 > np.mean([r.near_next for r in got.values()])


# --- Language-model scores -------------------------------------------------------------------

def test_scores_equal_brute_force(spark, corpus, odd_rows):
    rows = [r for r in odd_rows if r[0] != 7] + [(20 + k, prose(k % 3, 60)[k:]) for k in range(8)]
    data = [(t or "").lower().split() for _, t in rows]
    tables = [collections.Counter(tuple(w[j:j + k]) for k in range(4) for j in range(len(w) - k + 1) if k) for w in data]
    everything = sum(tables, collections.Counter())
    expected = []
    for (i, _), w, own in zip(rows, data, tables):
        count = lambda g: (sum(map(len, data)) - len(w)) if not g else everything[g] - own[g]   # noqa: B023, E731
        total, short, unseen = 0.0, 0, 0
        for j in range(len(w)):
            factor, k = 1.0, min(j + 1, 3)
            short += count(tuple(w[j - k + 1:j + 1])) == 0
            while k and count(tuple(w[j - k + 1:j + 1])) == 0:
                k, factor = k - 1, factor * (0.4 if k > 1 else 1)
            unseen += k == 0
            total += math.log(factor * count(tuple(w[j - k + 1:j + 1])) / max(count(tuple(w[j - k + 1:j])), 1)) if k else math.log(factor / (count(()) + 1))
        expected.append((i, len(w), round(total, 6), short, unseen))
    for size in (1 << 20, 500):
        got = backoff.scores(corpus(rows), group_bytes=size, bucket_bytes=size).collect()
        assert sorted(((r.doc_id, r.n_words, round(r.log_score, 6), r.backed_off, r.unseen) for r in got), key=repr) == sorted(expected, key=repr)
    assert backoff.scores(corpus([])).count() == 0


# --- The pipeline ----------------------------------------------------------------------------

def test_pipeline_stages_keep_their_promises(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, before = docs.columns, {r.doc_id for r in docs.collect()}
    from cohortlens.plans.staging import stage
    for name, function in corpus_pipeline.STAGES:
        docs = stage(function(spark, docs, SF), "stage")
        ids = [r.doc_id for r in docs.collect()]
        assert set(ids) <= before and ids
        if name != corpus_pipeline.STAGES[-1][0]:
            assert docs.columns == columns
        before = set(ids)
    assert docs.columns[:4] == ["doc_id", "start", "n_tokens", "ids_crc32"]


def test_pipeline_stages_decide_rows_without_or_with_repeated_ids(spark, corpus):
    stages = {name.split()[0]: function for name, function in corpus_pipeline.STAGES}
    rows = lambda df: sorted(((r.doc_id, r.text) for r in df.collect()), key=repr)
    same, twin, other, lone = (prose(seed, 60) for seed in (1, 2, 3, 4))
    docs = [(None, same), (None, same), (5, same), (6, same), (5, other), (None, twin), (None, twin), (None, lone), (8, None)]
    assert rows(stages["minhash"](spark, corpus(docs), SF)) == sorted(
        [(5, same), (5, other), (None, twin), (None, lone), (8, None)], key=repr)

    item = spark.read.parquet(f"{SF}/benchmark.parquet").where("length(text) > 60").first().text
    docs = [(None, f"{other} {item} {same}"), (7, item), (7, other), (None, lone), (None, None), (9, "")]
    clean = [(7, other), (None, lone), (None, None), (9, "")]
    assert rows(stages["benchmark"](spark, corpus(docs), SF)) == sorted(clean, key=repr)
    chunked = decontaminate.without_items(corpus(docs), spark.read.parquet(f"{SF}/benchmark.parquet"), chunk_bytes=2000)
    assert rows(chunked) == sorted(clean, key=repr)

    mixed, written = stages["mixing"](spark, corpus(docs), SF), stages["token-id"](spark, corpus(docs), SF)
    assert {t for _, t in rows(mixed)} <= {t for _, t in docs} and written.count() == len(docs)
    source = spark.read.parquet(f"{SF}/documents.parquet")
    nameless = source.withColumn("doc_id", F.lit(None).cast("bigint"))
    good = stages["quality"](spark, source.union(nameless), SF).collect()
    assert sorted(r.text for r in good if r.doc_id is None) == sorted(r.text for r in good if r.doc_id is not None) != []
