import pytest
from conftest import strings, values
from pyspark.sql import functions as F

from orrery import fixed
from orrery.operators import quality_log
from orrery.plans import facts, runs, silver
from orrery.session import get_session, scratch, shared_folder
from orrery.sources import files, inventory, tables

SF = "/root/testdata/sf0.001"


@pytest.fixture(autouse=True)
def clean_catalog(spark):
    yield
    for t in spark.catalog.listTables():
        spark.sql(f"DROP {'VIEW' if t.isTemporary else 'TABLE'} IF EXISTS `{t.name}`")


# --------------------------------------------------------------------- tables
def test_table_sinks(spark, table):
    tables.overwrite_table(table("a int", (1,)), "t")
    tables.append_table(table("a int", (2,)), "t")
    assert sorted(values(tables.read_table(spark, "t"), "a")) == [1, 2]
    tables.overwrite_table(table("b string", ("x",)), "t", replace_schema=True)
    assert spark.table("t").columns == ["b"]
    tables.ensure_table(spark, "t", "c int")
    assert spark.table("t").columns == ["b"]


def test_publish_keeps_the_old_table_when_the_check_fails(spark, table):
    tables.publish_table(table("a int", (1,)), "p")

    def refuse(_):
        raise ValueError("no")

    with pytest.raises(ValueError):
        tables.publish_table(table("a int", (2,)), "p", check=refuse)
    assert values(spark.table("p"), "a") == [1]
    tables.publish_table(table("a int", (3,)), "p", check=lambda df: df.count())
    assert values(spark.table("p"), "a") == [3]


class Killed(Exception):
    pass


@pytest.mark.parametrize("step", range(6))
def test_a_publish_killed_between_its_steps_leaves_a_table(spark, table, monkeypatch, step):
    tables.publish_table(table("a int", (1,)), "p")
    calls = {"n": 0}

    def killed_before(step_function):
        def call(*args):
            calls["n"] += 1
            if calls["n"] > step:
                raise Killed
            return step_function(*args)

        return call

    with monkeypatch.context() as m:
        m.setattr(tables, "_drop", killed_before(tables._drop))
        m.setattr(tables, "_rename", killed_before(tables._rename))
        try:
            tables.publish_table(table("a int", (2,)), "p")
        except Killed:
            pass
    tables.recover_table(spark, "p")
    assert values(spark.table("p"), "a") in ([1], [2])
    tables.publish_table(table("a int", (3,)), "p")
    assert values(spark.table("p"), "a") == [3] and not spark.catalog.tableExists("p__before")


# ---------------------------------------------------------------------- files
def write_payments(folder, **files):
    for name, lines in files.items():
        (folder / f"{name}.csv").write_text("\n".join([",".join(fixed.PAYMENT_COLUMNS), *lines, ""]))


def test_the_first_payment_in_file_order_survives(spark, tmp_path):
    """A small first file with one copy, a large second file with another."""
    key, rest = "7" * 32, [f"{k:032d},1,voucher,1,{k}" for k in range(3000)]
    write_payments(tmp_path, a=[f"{key},1,boleto,1,10"], b=[*rest, f"{key},1,voucher,1,99", f"{key},1,debit_card,1,5"])
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        for size in ("2k", "64m"):
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
            clean = silver.clean_order_payments(files.read_raw_order_payments(spark, str(tmp_path)))
            assert clean.count() == 3001
            assert [tuple(r)[2:] for r in clean.where(F.col("order_id") == key).collect()] == [("boleto", 1, 10.0)]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_rows_that_are_not_read_from_files_need_an_order(table):
    df = table(strings(fixed.PAYMENT_COLUMNS), ("7" * 32, "1", "boleto", "1", "1"))
    with pytest.raises(ValueError, match="order_by"):
        silver.clean_order_payments(df)


def test_payments_csv(spark, tmp_path):
    key = "30" * 16
    write_payments(tmp_path, only=[f'"{key}",4,debit_card,3,"12.75"', f'"{key}",5,voucher,two,1'])
    raw = files.read_raw_order_payments(spark, str(tmp_path))
    assert set(dict(raw.dtypes).values()) == {"string"} and raw.count() == 2
    out = str(tmp_path / "out")
    clean = runs.clean_order_payments_path(spark, str(tmp_path / "only.csv"), out, output_format="orc")
    assert [tuple(r) for r in clean.collect()] == [(key, 4, "debit_card", 3, 12.75)]
    assert spark.read.orc(out).count() == 1
    assert runs.clean_order_payments_path(spark, str(tmp_path / "only.csv")).count() == 1


@pytest.mark.parametrize("line_breaks", [True, False])
def test_reviews_csv(spark, tmp_path, line_breaks):
    message = "first line\nand \"\"quoted\"\" words" if line_breaks else "one line and \"\"quoted\"\" words"
    (tmp_path / "r.csv").write_text(",".join(fixed.REVIEW_COLUMNS) + f'\nrev,ord,3,Tidy,"{message}",2018-03-01 00:00:00,2018-03-02 10:00:00\n')
    df = files.load_reviews(spark, str(tmp_path / "r.csv"), line_breaks=line_breaks)
    assert df.columns == list(fixed.REVIEW_COLUMNS) and df.count() == 1
    text = silver.clean_reviews(df).first()["review_comment_message"]
    assert text == message.replace("\n", " ").replace('""', '"')


def test_inventory_export_and_conversion(spark, table, tmp_path):
    tables.overwrite_table(table("a int, b string", (1, "x"), (2, "y")), "things")
    tables.overwrite_table(table("n bigint", (1,)), "dq_things")
    folder = str(tmp_path / "export")
    profile = inventory.export_tables(spark, folder, ["things", "dq_things"])
    assert {tuple(r) for r in profile.collect()} == {("things", 2, 2), ("dq_things", 1, 1)}
    assert spark.read.option("header", True).csv(f"{folder}/audit_logs/dq_things").count() == 1
    listed = inventory.list_files(spark, folder)
    assert listed.columns == ["path", "length"]
    assert listed.where(F.col("path").endswith(".parquet")).count() >= 2
    assert "content" not in listed._jdf.queryExecution().executedPlan().toString()
    assert inventory.convert_exports(spark, folder, ["things"], "orc", "_orc") == ["things_orc"]
    assert spark.table("things_orc").schema == spark.table("things").schema
    assert spark.table("things_orc").count() == 2


# ------------------------------------------------------------------------ logs
def test_logs_and_summary(spark, table):
    log = lambda *a: quality_log.log_row_count(spark, *a)
    for count in (90, 100):
        log("orders", fixed.STAGE_BEFORE, count)
    log("orders", fixed.STAGE_AFTER, 80)
    log("items", fixed.STAGE_BEFORE, 5)
    log("items", fixed.STAGE_AFTER, 0)
    table("a int", (1,), (2,)).createOrReplaceTempView("all_invalid")
    assert quality_log.log_invalid_summary(spark, "orders") == 2
    assert quality_log.log_invalid_summary(spark, "orders", view="not_there") == 0
    quality_log.log_invalid_summary(spark, "orders")
    summary = quality_log.generate_dq_summary(spark)
    assert {r["dataset"]: tuple(r)[1:6] for r in summary.collect()} == {
        "orders": (100, 80, 20, 4, True), "items": (5, 0, 5, None, False),
    }
    newest = quality_log.generate_dq_summary(spark, latest_only=True)
    assert newest.where("dataset = 'orders'").first()["invalid_rows"] == 2
    assert newest.schema.simpleString() == summary.schema.simpleString()


def test_invalid_row_log(spark, table):
    raw = table(strings(fixed.SELLER_COLUMNS), ("s1", "50", "x", "SP"), (None, "1234", "x", "SP"))
    quality_log.log_invalid_rows("sellers", silver.rejected_values("sellers", raw))
    rows = spark.table(fixed.LOG_TABLES["invalid_rows"]).collect()
    assert {tuple(r)[:4] for r in rows} == {
        ("sellers", "seller_zip_code_prefix", "zip code in range", "50"),
        ("sellers", "seller_id", "seller_id is present", None),
    }


# ------------------------------------------------------------------------ runs
def test_facts_with_unknown_keys_stop_a_run_unless_they_are_to_be_dropped(spark):
    from orrery.queries import STUDY_YEAR, Silver

    s = Silver(spark, SF)
    raw = {name: s.raw(name) for name in silver.SHAPES}
    raw["product_category"] = s.raw("category_translation")
    runs.run_all_silver(spark, raw, cleaners={"order_payments": lambda df: silver.clean_order_payments(df, order_by=["source_row"])})
    for name in silver.SHAPES:
        assert spark.catalog.tableExists(f"quarantine_{name}")
    calendar = ("1995-01-01", "2001-12-31")
    with pytest.raises(ValueError, match="Order items without a known order"):
        runs.run_all_gold(spark, calendar=calendar, study_year=STUDY_YEAR)
    assert not spark.catalog.tableExists(fixed.GOLD_TABLES["fact_order_item"])
    gold = runs.run_all_gold(spark, orphans="drop", calendar=calendar, study_year=STUDY_YEAR)
    items = gold["fact_order_item"]
    assert items.count() > 0 and items.where("seller_key IS NULL OR product_key IS NULL").isEmpty()
    lost = spark.table(f"quarantine_{fixed.GOLD_TABLES['fact_order_item']}")
    accepted = facts.clean_fact_order_item(spark.table("silver_order_items"))
    assert lost.count() + items.count() == accepted.count()
    summary = {r["dataset"]: r for r in runs.run_summary(spark).collect()}
    for name in silver.SHAPES:
        assert summary[name]["invalid_rows"] == spark.table(f"quarantine_{name}").count()


def test_sessions(spark):
    assert get_session() is not None
    folder = shared_folder(spark)
    assert shared_folder(spark) == folder
    path = scratch(spark, "x")
    assert path.startswith(folder) and scratch(spark, "x") != path
    spark.range(3).write.parquet(path)
    assert spark.read.parquet(path).count() == 3


def test_a_cluster_has_to_name_its_folder():
    class Context:
        master = "spark://somewhere:7077"

    class Session:
        sparkContext = Context

        class conf:
            @staticmethod
            def get(name, default):
                return default

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_folder(Session)
