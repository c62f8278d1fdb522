import random
import warnings

import pytest

from cohortlens.model import ColumnTypeError
from cohortlens.operators import filters
from cohortlens.operators.filters import apply_filter, member_filter, range_filter


HERDS = [("h1", "Pass", "north", 12.5, 40), ("h2", "Fail", "north", 30.0, 15), ("h3", "Pass", "south", 7.75, 22),
         ("h4", "Pass", "west", 18.0, 40), ("h5", "Fail", "west", 2.5, 61), ("h6", "Pass", "north", 44.0, 3)]


@pytest.fixture
def herds(frame):
    return frame("name string, Outcome string, region string, weight double, age int", HERDS)


def kept(df, column="name"):
    return [r[0] for r in df.orderBy("_ord").select(column).collect()]


def plain(spec, default=True):
    """The names a specification keeps, in plain Python."""
    columns = ["name", "Outcome", "region", "weight", "age"]
    rules = spec if not default or "Outcome" in spec else {"Outcome": ["Pass"], **spec}

    def passes(row):
        values = dict(zip(columns, row))
        for key, rule in rules.items():
            if key in ("weight", "age"):
                ok = rule[0] <= values[key] <= rule[1]
            elif key.startswith("not_"):
                ok = values[key[4:]] not in rule
            else:
                ok = values[key] in rule
            if not ok:
                return False
        return True
    return [row[0] for row in HERDS if passes(row)]


def random_spec(rng):
    spec = {}
    for column, low, high in (("weight", 0, 50), ("age", 0, 70)):
        if rng.random() < 0.6:
            a = rng.uniform(low, high)
            spec[column] = [round(a, 1), round(a + rng.uniform(1, high), 1)]
    for column, values in (("region", ["north", "south", "west", "east"]), ("name", [h[0] for h in HERDS])):
        if rng.random() < 0.6:
            spec[rng.choice(["", "not_"]) + column] = rng.sample(values, rng.randrange(1, len(values)))
    if rng.random() < 0.3:
        spec["Outcome"] = rng.choice([["Fail"], ["Pass", "Fail"]])
    return spec


@pytest.mark.parametrize("seed", range(12))
def test_combined_filter_equals_plain_python(herds, seed):
    spec = random_spec(random.Random(seed))
    assert kept(apply_filter(herds, spec)) == plain(spec)


def test_default_rule_and_its_negation(herds):
    assert kept(apply_filter(herds, {})) == plain({})
    assert kept(apply_filter(herds, {"not_Outcome": ["Fail"]})) == plain({"Outcome": ["Pass"]})


def test_unknown_name(herds):
    with pytest.raises(ValueError, match="colour"):
        apply_filter(herds, {"colour": ["red"]})


def test_wipe_out(herds):
    none, single = {"weight": [100, 200]}, {"region": ["south"]}
    for spec in (none, single):
        with pytest.raises(ValueError):
            filters.filter_with_count(herds, spec)
    passed, seen = filters.filter_with_count(herds, none, allow_wipe_out=True)
    assert passed.collect() == [] and seen.get["number_of_passed_samples"] == 0
    passed, seen = filters.filter_with_count(herds, {})
    passed.collect()
    assert seen.get["number_of_passed_samples"] == len(plain({}))


@pytest.mark.parametrize("ranges", [{"age": (15, 40)}, {"weight": (7.75, 18)}, {"age": [40, 41], "weight": (0, 15)}, {"age": (62, 63)}, {}])
def test_ranges_include_their_ends(herds, ranges):
    assert kept(range_filter(herds, ranges)) == plain(ranges, default=False)


@pytest.mark.parametrize("bounds", [(9,), (9, 10, 11), 9, "wide", ("low", "high"), ("low",), (10, 9), (9, 9)])
def test_bad_bounds(herds, bounds):
    with pytest.raises(ValueError):
        range_filter(herds, {"age": bounds})


def test_ranges_of_wrong_columns(herds):
    for ranges, error in (({"region": (1, 2)}, ColumnTypeError), ({"colour": (1, 2)}, KeyError)):
        with pytest.raises(error):
            range_filter(herds, ranges)


@pytest.mark.parametrize("members", [
    {"region": ["south"]}, {"not_region": ["north", "west"]}, {"name": ["h6", "h1"], "not_region": ["south"]},
    {"not_name": [h[0] for h in HERDS]}, {"region": []}, {"not_region": []}, {"region": ["east"]}, {}])
@pytest.mark.parametrize("inline", [10_000, 0])
def test_members(herds, monkeypatch, members, inline):
    monkeypatch.setattr(filters, "INLINE_VALUES", inline)
    assert kept(member_filter(herds, members)) == plain(members, default=False)


def test_members_of_wrong_columns_and_forms(herds):
    for members, error in (({"weight": ["x"]}, ColumnTypeError), ({"not_age": ["x"]}, ColumnTypeError), ({"colour": ["x"]}, KeyError),
                           ({"region": "north"}, ValueError), ({"region": ("north",)}, ValueError), ({"region": ["north", 4]}, ValueError)):
        with pytest.raises(error):
            member_filter(herds, members)


@pytest.mark.parametrize("inline", [10_000, 0])
def test_missing_values(frame, monkeypatch, inline):
    monkeypatch.setattr(filters, "INLINE_VALUES", inline)
    df = frame("name string, ward string, dose double",
               [("p", "low", 3.0), ("q", None, 6.0), ("r", "high", float("nan")), ("s", "low", None)])
    assert kept(member_filter(df, {"ward": ["low", "high"]})) == ["p", "r", "s"]
    assert kept(member_filter(df, {"not_ward": ["low"]})) == ["q", "r"]
    for top in (8, float("inf")):
        assert kept(range_filter(df, {"dose": (0, top)})) == ["p", "q"]


def test_a_column_that_starts_like_the_negation(frame):
    df = frame("name string, Outcome string, noCoverage double", [("p", "Pass", 4.0), ("q", "Pass", 40.0)])
    assert kept(apply_filter(df, {"noCoverage": (0, 20)})) == ["p"]


def test_absent_values(herds, rows):
    df = filters.absent_values(herds, {"region": ["north", "east", "moon"], "name": ["h3"], "not_name": ["h9"]})
    assert rows(df) == [("region", "east"), ("region", "moon")]


def test_absent_values_warn(herds):
    with pytest.warns(UserWarning, match="region.*east, moon"):
        filters.warn_absent_values(herds, {"region": ["moon", "west", "east"]})
    with warnings.catch_warnings():
        warnings.simplefilter("error")
        filters.warn_absent_values(herds, {"region": ["west"], "not_region": ["moon"]})


def test_filters_reach_the_scan(spark, tmp_path, herds):
    herds.write.parquet(str(tmp_path / "t"))
    df = apply_filter(spark.read.parquet(str(tmp_path / "t")), {"weight": (5, 20), "Outcome": ["Pass", "Fail"]})
    plan = df.select("name")._jdf.queryExecution().executedPlan().toString()
    pushed = plan[plan.index("PushedFilters"):]
    assert "GreaterThanOrEqual(weight,5.0)" in pushed and "In(Outcome" in pushed
    assert "age" not in plan[plan.index("ReadSchema"):]
