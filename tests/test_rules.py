import pytest
from pyspark.sql import functions as F

from orrery.operators.rules import (
    WARNING,
    ReferenceRule,
    RowRule,
    RuleSet,
    RuleViolation,
    SameSizeRule,
    TableRule,
    UniqueRule,
    must,
    not_null,
    one_of,
    outside,
)

ROWS = [
    (1, "a", 5), (2, "b", -1), (2, "c", 7), (None, "a", 3), (4, "z", None), (5, None, 9),
]


@pytest.fixture()
def df(table):
    return table("id int, code string, n int", *ROWS)


def rules(parent=None):
    made = [
        *not_null(["id"]),
        one_of("code", ["a", "b", "c"], "unknown code"),
        RowRule("negative n", "n", F.col("n") < 0),
        UniqueRule("repeated id", ("id",), skip_null=True),
        RowRule("large n", "n", F.col("n") > 8, WARNING),
        TableRule("too few rows", F.when(F.count(F.lit(1)) < 10, 10 - F.count(F.lit(1)))),
    ]
    if parent is not None:
        made.append(ReferenceRule("unknown id", ("id",), parent))
    return RuleSet("things", ("id", "code", "n"), made)


def test_counts_and_report(df, table):
    report = rules(table("id int", (1,), (2,))).report(df)
    assert report.row_count == 6
    found = {f.rule: (f.bad_rows, f.example) for f in report.findings}
    assert found == {
        "id is null": (1, None),
        "unknown code": (1, "z"),
        "negative n": (1, "-1"),
        "repeated id": (1, "2"),
        "large n": (1, "9"),
        "too few rows": (4, None),
        "unknown id": (3, ""),
    }
    assert not report.passed and len(report.warnings) == 1 and len(report.errors) == 6
    with pytest.raises(RuleViolation, match="things: id is null \\(1 rows\\)"):
        report.raise_first()


def test_null_never_breaks_a_list_or_range_rule(table):
    df = table("code string, n int", (None, None))
    checked = RuleSet("t", ("code", "n"), [one_of("code", ["a"], "list"), outside("n", 1, 5, "range")])
    assert checked.report(df).passed
    assert RuleSet("t", ("n",), [must("n is there", "n", F.col("n") > 0)]).accept(df).count() == 0


def test_split_keeps_every_row_once(df, table):
    accepted, rejected = rules(table("id int", (1,), (2,), (4,), (5,))).split(df)
    assert accepted.columns == df.columns
    assert sorted(r["code"] or "-" for r in accepted.collect()) == ["-", "a"]
    assert rejected.count() + accepted.count() == df.count()
    broken = {r["code"]: [b["rule"] for b in r["broken_rules"]] for r in rejected.collect()}
    assert broken["b"] == ["negative n", "repeated id"] and broken["z"] == ["unknown code"]


def test_invalid_rows_name_column_rule_and_value(df):
    rows = {tuple(r) for r in rules().invalid_rows(df).collect()}
    assert ("things", "n", "negative n", "-1") in rows
    assert ("things", "id", "id is null", None) in rows
    assert sum(r[2] == "repeated id" for r in rows) == 1  # both rows show the same value


def test_unique_measures(table):
    df = table("k int", (1,), (1,), (1,), (2,), (None,), (None,))
    count = lambda **o: UniqueRule("u", ("k",), **o).counts(df).first()["bad_rows"]
    assert (count(), count(count="rows"), count(count="surplus")) == (2, 5, 3)
    assert count(count="surplus", skip_null=True) == 2


def test_same_size(table):
    rule = SameSizeRule("size", ("k",), table("k int", (1,), (1,), (2,)))
    assert rule.counts(table("k int", (7,), (8,))).first()["bad_rows"] == 0
    assert rule.counts(table("k int")).first()["bad_rows"] == 2


def test_schema_comes_first(table):
    report = rules().report(table("id int", (1,)))
    assert report.row_count is None and "missing required column(s): ['code', 'n']" in report.errors[0]


def test_one_job_reads_the_table_once_per_branch(spark, df, tmp_path):
    path = str(tmp_path / "t")
    df.write.parquet(path)
    stored = spark.read.parquet(path)
    plan = rules().counts(stored)._jdf.queryExecution().executedPlan().toString()
    # all row and table rules share one scan, the unique rule has the other
    assert plan.count("FileScan") == 2


def test_offenders_are_complete(df):
    rows = rules().offenders(df, "unknown code").collect()
    assert [tuple(r) for r in rows] == [("z", 1)]
