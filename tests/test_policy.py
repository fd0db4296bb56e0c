import json

import pytest

from maskflow import MaskOptions, Salts, load_policies, match_policy, parse_policies, parse_table_policy
from maskflow.plans.policy import Strategy, TablePolicy

DOCUMENT = {
    "people": {
        "_meta": {"partitioningColumn": "id", "owner": {"name": "x"}},
        "id": {"strategy": [{"type": "Hash", "salt_key": "person"}], "comment": [1, 2]},
        "born": {"strategy": [{"type": "EpochStart"}, {"type": "DateEpoch", "date_epoch": "EPOCH_START"}]},
    },
    "visits": {"id": {"strategy": [{"type": "Identity"}]}, "nothing": {"other": 1}},
}


def test_many_tables():
    people, visits = parse_policies(json.dumps(DOCUMENT))
    assert people == TablePolicy(
        "people",
        (
            Strategy("id", "Hash", "person"),
            Strategy("born", "EpochStart"),
            Strategy("born", "DateEpoch", None, "EPOCH_START"),
        ),
        "id",
    )
    assert visits.partition_column is None
    assert visits.strategies == (Strategy("id", "Identity"),)


def test_one_table():
    policy = parse_table_policy(json.dumps(DOCUMENT["visits"]), "v")
    assert policy == TablePolicy("v", (Strategy("id", "Identity"),))


@pytest.mark.parametrize(
    "text",
    ["", "{", "[]", '{"t": 1}', '{"t": {"c": 1}}', '{"t": {"c": {"strategy": [1]}}}',
     '{"t": {"c": {"strategy": [{"salt_key": "k"}]}}}'],
)
def test_malformed(text):
    with pytest.raises(ValueError):
        parse_policies(text)


def test_missing_text():
    with pytest.raises(ValueError):
        parse_policies(None)


def test_chains_join_columns_of_any_case():
    policy = TablePolicy("t", (Strategy("A", "Identity"), Strategy("b", "Drop"), Strategy("a", "Hash")))
    assert {name: [s.type for s in chain] for name, chain in policy.chains().items()} == {
        "A": ["Identity", "Hash"],
        "b": ["Drop"],
    }


def test_load_with_and_without_spark(spark, tmp_path):
    path = tmp_path / "policies.json"
    path.write_text(json.dumps(DOCUMENT, indent=2))
    assert load_policies(str(path)) == load_policies(str(path), spark)
    assert [p.name for p in load_policies(str(path))] == ["people", "visits"]


def test_match():
    policies = [TablePolicy(name, ()) for name in ("visit", "visit_notes", "People")]
    assert match_policy("PEOPLE", policies).name == "People"
    assert match_policy("2020_visit_notes.csv", policies).name == "visit_notes"
    assert match_policy("old-Visit.csv", policies).name == "visit"
    with pytest.raises(ValueError, match="no policy"):
        match_policy("doctors", policies)


def test_types_matter_only_where_passed_on():
    def policy(*types):
        return TablePolicy("t", tuple(Strategy(f"c{i}", t) for i, t in enumerate(types)))

    assert not policy("Hash", "Year", "Zip3Digit", "Clear", "DateShift").keeps_types()
    assert policy("Hash", "Identity").keeps_types() and policy("Age").keeps_types()


def test_date_epoch_needs_a_column():
    with pytest.raises(ValueError, match="date_epoch"):
        TablePolicy("t", (Strategy("a", "DateEpoch"),)).check()


# -- salts and options


def test_salts_are_created_once_and_kept(tmp_path):
    path = tmp_path / "salts.json"
    salts = Salts.load(path, create=True)
    first = salts.get("a")
    assert len(first) == 256 and int(first, 16) >= 0
    assert salts.get("b") != first
    assert Salts.load(path).get("a") == first
    assert path.stat().st_mode & 0o077 == 0


def test_unknown_salts_fail(tmp_path):
    with pytest.raises(KeyError):
        Salts({"a": "x"}).get("b")
    with pytest.raises(FileNotFoundError):
        Salts.load(tmp_path / "none.json")


def test_salts_do_not_show():
    assert "secret" not in repr(Salts({"a": "secret"}))


@pytest.mark.parametrize(
    "option",
    [{"random": "x"}, {"hash_bits": 1}, {"salt_by": "x"}, {"on_missing": "x"}, {"given_names": {"female": ["a"]}}],
)
def test_bad_options(option):
    with pytest.raises(ValueError):
        MaskOptions(**option)


def test_default_year_is_now():
    import datetime

    assert MaskOptions().year == datetime.date.today().year
