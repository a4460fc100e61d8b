"""The campaign job: rejects, restart, options, planned files, buckets, hot codes."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from offerline import schemas as S
from offerline.operators.enrich import column_split, enrich_base, left_enrich
from offerline.operators.loads import board_loads, board_loads_of_distinct, dedupe_rows, distinct_campaign, with_digest
from offerline.operators.quality import require_schema
from offerline.operators.skew import SALT, deal, hot_keys, salted_join
from offerline.plans import jobs, standin
from offerline.plans.staging import Stages
from offerline.sources.io import read_message_loads, write_message_loads, write_partitioned
from offerline.sources.landing import layouts, positions, read_landed_csv, split_rejects, weekday_headers

SF = "/root/testdata/sf0.001"
needs_data = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")


def rows_of(df):
    return sorted(map(str, df.collect()))


# --- landing ------------------------------------------------------------------

def test_weekday_headers_by_date():
    cells = ["x", "Segunda Feira - 01/01", "Sexta Feira - 29/12", "Quinta Feira - 28/12", "Terça Feira - 02/01", "Quarta Feira - 03/01"]
    assert weekday_headers(cells, "2023-12-30") == (
        "Quinta Feira - 28/12", "Sexta Feira - 29/12", "Segunda Feira - 01/01", "Terça Feira - 02/01", "Quarta Feira - 03/01")
    assert weekday_headers([*S.WEEKDAY_COLUMNS, "Base"], "2024-04-25") == S.WEEKDAY_COLUMNS
    for bad in (cells[:4], [*cells[1:5], "Quarta Feira - 30/02"], [*cells, "Sexta Feira - 05/01"]):
        with pytest.raises(ValueError):
            weekday_headers(bad, "2023-12-30")


def test_positions_names_all_missing_columns():
    assert positions(("b", "a", "a"), ["a", "c"], {"c": "b"}) == {"a": 1, "c": 0}
    with pytest.raises(ValueError, match="x.*y"):
        positions(("a",), ["a", "x", "y"])
    assert positions(("a",), ["a", "x"], optional=("x",)) == {"a": 0, "x": None}


def test_landed_layouts_and_bad_rows(spark, tmpdir_fresh):
    files = {"1.csv": '﻿id,price,name\n1,2.5,"a, ""b"""\n2,x,c\n3\n,4,d,5\n', "2.csv": "name , extra,price,id\ne,z,,7\n", "3.csv": "", "4.csv": "id,price,name\n"}
    for name, text in files.items():
        with open(f"{tmpdir_fresh}/{name}", "w", encoding="utf-8") as out:
            out.write(text)
    path = f"{tmpdir_fresh}/*.csv"
    assert {len(f) for f in layouts(spark, path, {}).values()} == {1, 2}
    schema = spark.createDataFrame([], "name string, id long, price double").schema
    good, bad = split_rejects(read_landed_csv(spark, path, schema))
    assert rows_of(good) == sorted(["Row(name='a, \"b\"', id=1, price=2.5)", "Row(name='e', id=7, price=None)"])
    found = {r["record"]: (r["reasons"], r["file"].rsplit("/", 1)[1]) for r in bad.collect()}
    assert found == {"2,x,c": (["value: price"], "1.csv"), "3": (["width"], "1.csv"), ",4,d,5": (["width"], "1.csv")}
    with pytest.raises(ValueError):
        read_landed_csv(spark, path, spark.createDataFrame([], "other string").schema)


# --- stages -------------------------------------------------------------------

def test_stages_resume_and_replace_what_broke(spark, tmpdir_fresh):
    built = []

    def frame(n):
        built.append(n)
        return spark.range(n)

    first = Stages(spark, tmpdir_fresh, "2024-04-25")
    assert first.stored("a", lambda: frame(3), metrics={"rows": F.count(F.lit(1))}).count() == 3

    def broken(observed):
        frame(4).write.parquet(f"{first.path}/b")      # rows are out, the report is not
        raise RuntimeError("killed")

    with pytest.raises(RuntimeError):
        first.run("b", broken)
    again = Stages(spark, tmpdir_fresh, "2024-04-25")
    assert again.stored("a", lambda: frame(30)).count() == 3
    assert again.stored("b", lambda: frame(5), metrics={"rows": F.count(F.lit(1))}).count() == 5
    assert built == [3, 4, 5] and again.built == ["b"]
    report = {(r["stage"], r["metric"]): r["value"] for r in again.report().collect()}
    assert report == {("a", "rows"): 3, ("a", "finished"): 1, ("b", "rows"): 5, ("b", "finished"): 1}
    other_day = Stages(spark, tmpdir_fresh, "2024-04-26")
    assert other_day.stored("a", lambda: frame(1)).count() == 1


def test_observed_empty_frame(spark, tmpdir_fresh):
    stages = Stages(spark, tmpdir_fresh, "2024-04-25")
    assert stages.stored("a", lambda: spark.range(0), metrics={"rows": F.count(F.lit(1))}).count() == 0
    assert {r["metric"]: r["value"] for r in stages.report().collect()}["finished"] == 1


# --- hot codes ----------------------------------------------------------------

def hot_rows(spark):
    return spark.range(30_000).select(F.col("id").alias("row"), F.when(F.col("id") % 3 == 0, 1).when(F.col("id") % 3 == 1, F.col("id")).alias("code"))


@pytest.mark.parametrize("how", ["left", "inner", "left_semi", "left_anti"])
def test_salted_join_equals_join(spark, how):
    left, right = hot_rows(spark), spark.createDataFrame([(1, "a"), (1, "b"), (4, "c"), (None, "d"), (-5, "e")], "code long, v string")
    assert rows_of(salted_join(left, right, "code", how)) == rows_of(left.join(right, "code", how).select(*salted_join(left, right, "code", how).columns))
    cold = left.filter("row % 3 = 1")
    assert hot_keys(cold, "code") is None
    assert rows_of(salted_join(cold, right, "code", how)) == rows_of(cold.join(right, "code", how))
    with pytest.raises(ValueError):
        salted_join(left, right, "code", "full")


def test_hot_code_is_dealt_to_even_tasks(spark):
    """A third of the rows on one code, another third without one: no task of
    the join holds over twice the rows of the median task."""
    left = hot_rows(spark)
    hot = hot_keys(left, "code")
    assert [(r["code"], r["n_salts"]) for r in hot.collect()] == [(1, 67)]
    dealt = deal(left, "code", hot)
    sizes = sorted(r["n"] for r in dealt.repartition(16, "code", SALT).groupBy(F.spark_partition_id()).agg(F.count(F.lit(1)).alias("n")).collect())
    plain = sorted(r["n"] for r in left.repartition(16, "code").groupBy(F.spark_partition_id()).agg(F.count(F.lit(1)).alias("n")).collect())
    assert sizes[-1] <= 2 * sizes[len(sizes) // 2] < plain[-1]


def test_dealt_joins_share_one_partitioning(spark):
    """The base is shuffled once for the three joins."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold"), spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    spark.conf.set("spark.sql.adaptive.enabled", False)
    try:
        base = hot_rows(spark).withColumnRenamed("code", S.CODE)
        hot = hot_keys(base, S.CODE)
        lists = [spark.range(50).select(F.col("id").cast("string").alias("k"), F.lit("x").alias(f"v{i}")) for i in range(3)]
        out = deal(base, S.CODE, hot)
        for right in lists:
            out = left_enrich(out, right, S.CODE, right_key="k", hot=hot)
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert plan.count("SortMergeJoin") == 3 and plan.count("Exchange hashpartitioning") == 4
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before[0])
        spark.conf.set("spark.sql.adaptive.enabled", before[1])


# --- columns, dedupe, files, buckets ------------------------------------------

def test_column_split():
    assert column_split(["a", "b", "c"], ["a", "b"], ["b", "c"]) == ["c"]
    assert column_split(["a", "b", "c"], ["a", "b"], ["b", "c"], ["b"]) == ["b", "c"]
    with pytest.raises(ValueError, match="d"):
        column_split(["a", "d"], ["a"], ["b"])
    with pytest.raises(ValueError, match="b"):
        column_split(["a"], ["a"], [], ["b"])


def test_distinct_campaign_and_boards_equal_full_dedupe(spark):
    names = ["Canal", "10", S.MOBILE, S.LANDLINE, "x"]
    values = [(c, ten, m, l, x) for c in ("DIS", "WhatsApp", None) for ten in (None, "", "1", "2") for m in (None, "1") for l in (None, "2") for x in (None, 0.0)]
    df = spark.createDataFrame(values * 2 + values[:7] + [("DIS", "1", None, None, -0.0)] * 500, ", ".join(f"`{n}` {'double' if n == 'x' else 'string'}" for n in names))
    once = distinct_campaign(with_digest(df))
    assert rows_of(once.select(*names)) == rows_of(dedupe_rows(df))
    for channels in (None, ["WhatsApp"]):
        want = board_loads(df, channels)
        assert rows_of(board_loads_of_distinct(once, channels).select(*want.columns)) == rows_of(want)


def test_equal_digests_are_compared(spark, monkeypatch):
    from offerline.operators import loads

    df = spark.createDataFrame([("a", "1"), ("b", "1"), ("a", "1"), (None, "2")], "x string, `10` string")
    same = df.withColumns({loads.DIGEST[0]: F.lit(7).cast("long"), loads.DIGEST[1]: F.lit(7).cast("long")})
    assert rows_of(distinct_campaign(same).select("x", "10")) == rows_of(df.dropDuplicates())


def test_rows_alone_are_not_shuffled(spark, tmpdir_fresh):
    spark.range(20_000).select((F.col("id") % 19_000).cast("string").alias("x"), F.lit("1").alias("10")).write.parquet(f"{tmpdir_fresh}/rows")
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "60000")
    try:
        once = distinct_campaign(with_digest(spark.read.parquet(f"{tmpdir_fresh}/rows")))
        plan = once._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
        assert once.count() == 19_000
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)


def test_planned_message_files(spark, tmpdir_fresh):
    load = spark.range(1000).select((F.col("id") % 50).alias("VALOR_DO_REGISTRO"), F.lit("t").alias("CORINGA5"), (F.col("id") % 2 + 1).alias("n_offers"))
    write_message_loads(load, f"{tmpdir_fresh}/x", rows_per_file=100)
    back = read_message_loads(spark, f"{tmpdir_fresh}/x")
    per_file = [r["n"] for r in back.groupBy("_metadata.file_path").agg(F.count(F.lit(1)).alias("n")).collect()]
    assert back.count() == 1000 and max(per_file) <= 100
    spread = back.groupBy("n_offers", "VALOR_DO_REGISTRO").agg(F.countDistinct("_metadata.file_path").alias("n")).agg(F.max("n")).first()[0]
    assert spread <= 2      # a client's rows stand together


def test_bucketed_registry_is_not_shuffled(spark):
    from offerline.operators.registry import new_codes

    table = "offerline_bucketed_registry"
    spark.sql(f"DROP TABLE IF EXISTS {table}")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold"), spark.conf.get("spark.sql.adaptive.enabled")
    try:
        for day, codes in (("2024-04-24", range(100)), ("2024-04-25", range(50, 80))):
            ids = spark.createDataFrame([(c, f"{day}-{c}", dt.date.fromisoformat(day)) for c in codes], S.REGISTRY_SCHEMA)
            write_partitioned(ids, table, "dt_oportunidade", "append", bucket_by=(8, "cod_sap"))
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
        spark.conf.set("spark.sql.adaptive.enabled", False)
        fresh = new_codes(spark.range(200).select(F.col("id").alias("cod_sap")), spark.table(table), "2024-04-25")
        plan = fresh._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange hashpartitioning") == 1 and "SelectedBucketsCount: 8 out of 8" in plan
        assert fresh.count() == 170
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before[0])
        spark.conf.set("spark.sql.adaptive.enabled", before[1])
        spark.sql(f"DROP TABLE IF EXISTS {table}")
    with pytest.raises(ValueError):
        write_partitioned(spark.range(1), "/tmp/x", "id", bucket_by=(8, "id"))


def test_require_schema(spark):
    df = spark.range(1)
    assert require_schema(df, df.schema) is df
    with pytest.raises(ValueError):
        require_schema(df, S.MESSAGE_SCHEMA)


# --- the job ------------------------------------------------------------------

def land(spark, root, bad_rows=0):
    base = standin.base(spark, SF).filter(F.col(S.CODE).cast("bigint") % 7 == 0)
    if bad_rows:
        base = base.unionByName(base.limit(bad_rows).withColumn(S.CODE, F.lit("n/d")))
    inputs = {"base": base, "insights": standin.insights(spark, SF), "Quentes": standin.hot_contacts(spark, SF), "Whatsapp": standin.whatsapp_contacts(spark, SF)}
    for name, df in inputs.items():
        df.write.option("header", True).option("escape", '"').csv(f"{root}/in/{name}.csv")
    return jobs.CampaignPaths(
        base=f"{root}/in/base.csv", insights=f"{root}/in/insights.csv", hot_contacts=f"{root}/in/Quentes*.csv", whatsapp_contacts=f"{root}/in/Whatsapp*.csv",
        message_loads=f"{root}/out/loads", board_loads=f"{root}/out/boards", registry=f"{root}/out/registry", mailing=f"{root}/out/mailing",
        staging=f"{root}/stages", rejects=f"{root}/out/rejects", report=f"{root}/out/report"), base


@needs_data
def test_job_rejects_stops_and_resumes(spark, tmpdir_fresh, monkeypatch):
    paths, base = land(spark, tmpdir_fresh, bad_rows=3)
    with pytest.raises(ValueError, match="3 input rows"):
        jobs.run_campaign(spark, paths, "2024-04-25")
    bad = spark.read.parquet(paths.rejects)
    assert [(r["input"], r["reasons"]) for r in bad.collect()] == [("base", [f"id: {S.CODE}"])] * 3
    assert not os.path.exists(paths.mailing)

    def killed(*args, **kwargs):
        raise RuntimeError("killed")

    with monkeypatch.context() as m:
        m.setattr(jobs, "write_board_loads", killed)
        with pytest.raises(RuntimeError):
            jobs.run_campaign(spark, paths, "2024-04-25", on_bad_row="reject")
    # What was finished is not built again.
    monkeypatch.setattr(jobs, "prepare_base", lambda *a, **k: spark.read.parquet(f"{paths.staging}/2024-04-25/campaign").drop("__d1", "__d2"))
    monkeypatch.setattr(jobs, "write_message_loads", killed)
    report = jobs.run_campaign(spark, paths, "2024-04-25", on_bad_row="reject", table_format="parquet", loaded_at="2024-04-25 12:00:00")
    found = {(r["stage"], r["metric"]): r["value"] for r in report.collect()}
    assert found["base", "rejected"] == 3 and found["base", "rows"] == base.count()
    assert found["campaign", f"present: {S.CODE}"] == found["campaign", "rows"] >= base.count() - 3
    assert found["messages", "groups_without_price"] >= 0 and found["mailing", "without_id"] == 0
    mailing = spark.read.parquet(paths.mailing)
    assert mailing.count() == found["mailing", "rows"] == found["distinct", "rows"]
    assert str(mailing.first()["ts_carga"]) == "2024-04-25 09:00:00"
    assert spark.read.parquet(paths.board_loads + "/2024-04-25").count() == found["boards", "rows"]
    assert spark.read.parquet(paths.report).count() == report.count()


@needs_data
def test_job_options(spark, tmpdir_fresh):
    paths, base = land(spark, tmpdir_fresh)
    report = jobs.run_campaign(
        spark, jobs.CampaignPaths(**{**paths.__dict__, "second_base": paths.base}), "2024-04-25", mode="positional", phone_policy="first_valid",
        channels=("WhatsApp",), max_offers=2, strict_phones=True, channel_policy="mobile_is_whatsapp", separator="__",
        exclude=("Market", "M1"), fill=("COMPLEMENTO",), on_unmappable="replace", rows_per_file=50, table_format="orc")
    found = {(r["stage"], r["metric"]): r["value"] for r in report.collect()}
    kept = base.filter("Market <> 'M1'").count()
    assert found["base", "rows"] == 2 * kept and found["base", "rejected"] == 0
    mailing = spark.read.orc(paths.mailing)
    assert mailing.filter("market = 'M1'").count() == 0 and mailing.filter("fone_1 is not null and canal <> 'WhatsApp'").count() == 0
    assert found["messages", "offers_3"] == 0 and found["messages", "rows"] > 0
    assert found["distinct", "rows"] < found["campaign", "rows"]      # the second base is the first again
    with pytest.raises(ValueError):
        jobs.CampaignConfig(on_bad_row="drop")


@needs_data
def test_enrich_base_dealt_equals_plain(spark):
    from offerline.operators.ingest import clean_base

    base = clean_base(standin.base(spark, SF))
    hot = spark.createDataFrame([(base.first()[S.CODE], 5)], f"`{S.CODE}` long, n_salts int")
    lists = (standin.insights(spark, SF), standin.hot_contacts(spark, SF), standin.whatsapp_contacts(spark, SF))
    plain, dealt = enrich_base(base, *lists), enrich_base(base, *lists, hot=hot)
    assert plain.columns == dealt.columns
    assert plain.exceptAll(dealt).count() == 0 and plain.count() == dealt.count()
