import random

import pytest
from pyspark.sql import functions as F

from cohortlens import functions as fn

SEPARATORS = ["", "-", "_", " ", "/", "é"]


def apply(spark, function, values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    return [r[0] for r in df.orderBy("i").select(function(F.col("v"))).collect()]


def names(seed, count, digits):
    """Random names around a number of the given middle length, from letters and separators only."""
    rng = random.Random(seed)
    out = []
    for _ in range(count):
        number = "-".join(str(rng.randrange(10 ** (n - 1), 10 ** n)) for n in (2, digits, 2))
        around = ["".join(rng.choice("QrsTUvwé") for _ in range(rng.randrange(4))) for _ in range(2)]
        out.append((around[0] + rng.choice(SEPARATORS) + number + rng.choice(SEPARATORS) + around[1], number))
    return out


@pytest.mark.parametrize("digits", [4, 5])
def test_the_number_is_found_anywhere(spark, digits):
    cases = names(digits, 40, digits)
    expected = [f"AF-{number}" for _, number in cases]
    assert apply(spark, fn.submission_number, [name for name, _ in cases]) == expected
    assert apply(spark, fn.matrix_label, [name + "_consensus" for name, _ in cases]) == expected


@pytest.mark.parametrize("digits", [2, 3])
def test_short_middles_are_no_number(spark, digits):
    cases = [name for name, _ in names(digits, 20, digits)]
    assert apply(spark, fn.submission_number, cases) == [name.upper() for name in cases]


def test_long_middles_match_their_first_digits_never(spark):
    assert apply(spark, fn.submission_number, ["71-600500-08"]) == ["71-600500-08"]


def test_other_names_are_upper_cased(spark):
    rng = random.Random(9)
    values = ["".join(rng.choice("mnOP78") for _ in range(n)) for n in range(12)]
    assert apply(spark, fn.submission_number, [*values, None]) == [*[v.upper() for v in values], None]


def test_the_first_of_several_numbers_wins(spark):
    cases = [" ".join(number for _, number in names(s, 3, 4)) for s in range(5)]
    assert apply(spark, fn.submission_number, cases) == ["AF-" + c.split()[0] for c in cases]


def test_a_label_loses_one_suffix(spark):
    values = ["tuv_consensus" * n for n in (1, 2, 3)] + ["_consensus" * 2, "consensus_tuv"]
    expected = [v.removesuffix("_consensus").upper() for v in values]
    assert apply(spark, fn.matrix_label, values) == expected


@pytest.mark.parametrize("slashes", [1, 2, 5])
@pytest.mark.parametrize("rest", ["", "run 7", "run/7/deep", "run/7/"])
def test_bucket_and_key(spark, slashes, rest):
    uri = "s3://s3-csu-" + "417" + "/" * slashes + rest
    assert apply(spark, fn.uri_bucket, [uri]) == ["s3-csu-417"]
    folder = rest.rstrip("/") + "/" if rest else ""
    assert apply(spark, lambda u: fn.consensus_key(u, F.lit("smp")), [uri]) == [f"{folder}consensus/smp_consensus.fas"]


def broken_uris():
    """A good address with one thing wrong: scheme, colon, bucket name, number of digits, or no path."""
    good = "s3://s3-csu-417/run/"
    return [good.replace("s3:", "gs:", 1), good.replace("://", "//", 1), good.replace("csu", "usc"), good.replace("417", "41"),
            good.replace("417", "4171"), good.replace("417", "x17"), good[:-len("/run/")], " " + good, "", None]


@pytest.mark.parametrize("uri", broken_uris())
def test_malformed_addresses_fail(spark, uri):
    assert apply(spark, fn.valid_uri, [uri]) == [False]
    with pytest.raises(Exception, match="Incorrectly formatted s3 uri"):
        apply(spark, fn.uri_bucket, [uri])


def test_bucket_pattern_is_a_parameter(spark):
    assert apply(spark, lambda u: fn.uri_bucket(u, "lab-[a-z]+"), ["s3://lab-west/x"]) == ["lab-west"]


def test_listing_and_directories(spark):
    key = "top/mid/batch_FinalOut.csv"
    assert apply(spark, fn.last_token, [f"2031-12-30 01:02:03 {7 * 10 ** n} {key}" for n in range(3)]) == [key] * 3
    assert apply(spark, fn.last_token, ["word", ""]) == ["word", ""]
    assert apply(spark, fn.directory, [key, "flat.csv"]) == ["top/mid", ""]
    assert apply(spark, lambda k: fn.result_location(k, "lab-west"), [key]) == ["s3://lab-west/top/mid/"]
    for scheme in ("s3a://", "file:/mnt/", "hdfs://host:9/data/"):
        assert apply(spark, lambda p: fn.key_in_bucket(p, "lab-west"), [f"{scheme}lab-west/{key}"]) == [key]


def test_numbers_and_null_tokens(spark):
    assert apply(spark, fn.null_tokens_to_null, ["<NA>", "#N/A", "-NaN", "null", "1.#IND", "NAN", "none"]) == [None] * 5 + ["NAN", "none"]
    assert apply(spark, fn.number, ["7.25", "  -3", "N/A", "", "2E2", "-nan"]) == [7.25, -3.0, None, None, 200.0, None]
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        apply(spark, fn.number, ["seven"])
    assert apply(spark, lambda c: fn.number(c, permissive=True), ["seven", "7"]) == [None, 7.0]
