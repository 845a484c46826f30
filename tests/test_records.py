"""Multi-line CSV files in parts, and lines that a reader cannot place."""

import random

import pytest

from orrery import fixed
from orrery.plans import runs, silver
from orrery.sources import files, records

COLUMNS = ["a", "b", "c"]


@pytest.fixture()
def small_parts(spark):
    """Byte ranges of a few dozen bytes, shorter than many records."""
    settings = {"spark.sql.files.maxPartitionBytes": "48", "spark.sql.files.openCostInBytes": "0"}
    before = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def in_one_task(spark, path, names=COLUMNS):
    schema = ", ".join(f"{c} string" for c in names)
    return spark.read.schema(schema).options(header=True, quote='"', escape='"', multiLine=True).csv(path)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_equals_the_reader_of_one_task(spark, tmp_path, small_parts, end):
    rng = random.Random(1)
    pieces = ["x", "word", "", "line\nbreak", 'a "quote"', ",", "\n\n", "über", '"', "long " * 40, " padded ", "end\r\nhere", '\n"']

    def field():
        value = "".join(rng.choice(pieces) for _ in range(rng.randrange(4)))
        needs = any(c in value for c in '",\n\r')
        return '"' + value.replace('"', '""') + '"' if needs or rng.random() < 0.1 else value

    for n in range(3):
        lines = ["a,b,c"] + [",".join([f"k{n}{k}", field(), field()]) for k in range(150)]
        (tmp_path / f"{n}.csv").write_bytes((end.join(lines) + (end if n else "")).encode())
    got = records.read_split_csv(spark, str(tmp_path), COLUMNS)
    assert records._lines(spark, str(tmp_path)).select("file", "range").distinct().count() > 50
    assert rows(got) == rows(in_one_task(spark, str(tmp_path)))
    assert got.count() == 450


def test_one_record_over_many_parts(spark, tmp_path, small_parts):
    text = "\n".join(f"line {k}" for k in range(200))
    (tmp_path / "one.csv").write_text(f'a,b,c\n1,"{text}",x\n\n2,y,"{text}"\n')
    got = records.read_split_csv(spark, str(tmp_path), COLUMNS)
    assert rows(got) == [("1", text, "x"), ("2", "y", text)] == rows(in_one_task(spark, str(tmp_path)))


def test_files_without_rows(spark, tmp_path, small_parts):
    (tmp_path / "empty.csv").write_text("")
    (tmp_path / "header.csv").write_text("a,b,c\n")
    assert records.read_split_csv(spark, str(tmp_path), COLUMNS).collect() == []


def test_lines_are_exchanged_once(spark, tmp_path):
    (tmp_path / "x.csv").write_text('a,b,c\n1,"u\nv",3\n')
    inside = records.read_split_csv(spark, str(tmp_path), COLUMNS)
    plan = inside._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "InPandas" not in plan and "InArrow" not in plan


def test_records_without_their_fields(spark, tmp_path, small_parts):
    (tmp_path / "x.csv").write_text('a,b,c\n1,"u\nv",3\n4,"5\n5"\n6,7,8,9\n')
    got = records.read_split_csv(spark, str(tmp_path), COLUMNS, "bad")
    assert rows(got.select("bad")) == rows(spark.createDataFrame([(None,), ('4,"5\n5"',), ("6,7,8,9",)], "bad string"))


def _payments(tmp_path):
    good = ["a" * 32 + ",1,boleto,1,5.0", "b" * 32 + ",1,voucher,0,7.5", "c" * 32 + ",0,voucher,0,7.5"]
    bad = ["d" * 32 + ",1,boleto", "e" * 32 + ",1,boleto,1,5.0,6"]
    (tmp_path / "p.csv").write_text("\n".join([",".join(fixed.PAYMENT_COLUMNS), good[0], bad[0], good[1], bad[1], good[2]]) + "\n")
    return bad


def test_malformed_lines_are_seen_whatever_is_selected(spark, tmp_path):
    bad = _payments(tmp_path)
    raw = files.read_raw_order_payments(spark, str(tmp_path), silver.MALFORMED_LINE)
    lines = raw.where("malformed_line IS NOT NULL").select("malformed_line")
    assert sorted(r[0] for r in lines.collect()) == sorted(bad)
    assert raw.select("order_id").count() == 5
    assert files.read_raw_order_payments(spark, str(tmp_path)).columns == list(fixed.PAYMENT_COLUMNS)


def test_malformed_lines_go_to_quarantine_logs_and_counts(spark, tmp_path):
    bad = _payments(tmp_path)
    raw = files.read_raw_order_payments(spark, str(tmp_path), silver.MALFORMED_LINE)
    accepted, rejected = silver.quarantine("order_payments", raw)
    assert accepted.count() == 2 and rejected.count() == 3
    reasons = rejected.selectExpr("inline(broken_rules)")
    assert sorted(r.invalid_value for r in reasons.where("rule = 'line is well formed'").collect()) == sorted(bad)
    assert rows(silver.rejected_values("order_payments", raw).drop("dataset")) == rows(reasons)
    assert rows(silver.tally("order_payments", raw)) == [(5, 2, 3)]
    assert silver.clean_order_payments(raw).count() == 2
    spark.sql("DROP DATABASE IF EXISTS malformed CASCADE")
    spark.sql("CREATE DATABASE malformed")
    before = spark.catalog.currentDatabase()
    spark.catalog.setCurrentDatabase("malformed")
    try:
        table = runs.run_silver(spark, "order_payments", raw, silver.clean_order_payments)
        assert table.count() == 2 and spark.table("quarantine_order_payments").count() == 3
        counts = {r.stage: r.row_count for r in spark.table(fixed.LOG_TABLES["rowcount"]).collect()}
        assert counts == {fixed.STAGE_BEFORE: 5, fixed.STAGE_AFTER: 2}
        assert spark.table(fixed.LOG_TABLES["invalid_summary"]).first().invalid_rows == 3
    finally:
        spark.catalog.setCurrentDatabase(before)
        spark.sql("DROP DATABASE malformed CASCADE")


def test_a_reader_of_one_task_keeps_no_malformed_records(spark, tmp_path):
    with pytest.raises(ValueError, match="splittable"):
        files.load_reviews(spark, str(tmp_path), malformed="bad")
