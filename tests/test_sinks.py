"""Sinks and the end-to-end job: CSV loads, registry re-runs, day partitions."""

import datetime as dt
import os
import uuid

import pytest
from pyspark.sql import functions as F

from offerline import schemas as S
from offerline.operators import issue_ids
from offerline.plans import jobs, standin
from offerline.sources.io import read_message_loads, read_table, write_message_loads, write_partitioned

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")


def _campaign(spark):
    return jobs.prepare_base(standin.base(spark, SF), standin.insights(spark, SF),
                             standin.hot_contacts(spark, SF), standin.whatsapp_contacts(spark, SF))


def test_message_load_csv_round_trip(spark, tmpdir_fresh):
    load = jobs.message_job(_campaign(spark)).filter(F.col("n_offers").isNotNull())
    path = f"{tmpdir_fresh}/loads"
    write_message_loads(load, path)
    buckets = sorted(d for d in os.listdir(path) if d.startswith("n_offers="))
    assert buckets == [f"n_offers={k}" for k in (1, 2, 3) if load.filter(F.col("n_offers") == k).count()]
    back = read_message_loads(spark, path)
    assert back.count() == load.count()
    # the load's accented labels survive windows-1252
    assert back.filter(F.col("CORINGA5").contains("Preço mín por litro")).count() == back.count()


def test_registry_reruns_and_days(spark, tmpdir_fresh):
    path = f"{tmpdir_fresh}/registry"
    codes = spark.createDataFrame([(i,) for i in (5, 3, 9, 3)], "cod_sap bigint")
    empty = spark.createDataFrame([], S.REGISTRY_SCHEMA)
    write_partitioned(issue_ids(codes, empty, "2024-04-24"), path, "dt_oportunidade")
    for _ in range(2):  # second run of the same day issues nothing
        write_partitioned(issue_ids(codes, read_table(spark, path), "2024-04-25"), path, "dt_oportunidade")
    rows = sorted((r.cod_sap, r.id_oportunidade, r.dt_oportunidade) for r in read_table(spark, path).collect())
    assert rows == [
        (3, "240424000001", dt.date(2024, 4, 24)), (3, "240425000001", dt.date(2024, 4, 25)),
        (5, "240424000002", dt.date(2024, 4, 24)), (5, "240425000002", dt.date(2024, 4, 25)),
        (9, "240424000003", dt.date(2024, 4, 24)), (9, "240425000003", dt.date(2024, 4, 25)),
    ]
    more = spark.createDataFrame([(1,), (5,), (11,)], "cod_sap bigint")
    write_partitioned(issue_ids(more, read_table(spark, path), "2024-04-25"), path, "dt_oportunidade")
    day = {r.cod_sap: r.id_oportunidade for r in read_table(spark, path).filter("dt_oportunidade = '2024-04-25'").collect()}
    assert day[1] == "240425000004" and day[11] == "240425000005" and day[5] == "240425000002"


def test_run_campaign_end_to_end(spark, tmpdir_fresh):
    root = tmpdir_fresh
    inputs = {
        "base": standin.base(spark, SF), "insights": standin.insights(spark, SF),
        "hot": standin.hot_contacts(spark, SF), "wpp": standin.whatsapp_contacts(spark, SF),
    }
    for name, df in inputs.items():
        df.write.parquet(f"{root}/in/{name}.parquet")
    paths = jobs.CampaignPaths(
        base=f"{root}/in/base.parquet", insights=f"{root}/in/insights.parquet",
        hot_contacts=f"{root}/in/hot.parquet", whatsapp_contacts=f"{root}/in/wpp.parquet",
        message_loads=f"{root}/out/loads", board_loads=f"{root}/out/boards",
        registry=f"{root}/out/registry", mailing=f"{root}/out/mailing")
    jobs.run_campaign(spark, paths, "2024-04-25")
    jobs.run_campaign(spark, paths, "2024-04-25")  # re-run: same ids, same day partition
    jobs.run_campaign(spark, paths, "2024-04-26")
    registry = spark.read.parquet(paths.registry)
    per_day = {r.dt_oportunidade: r.n for r in registry.groupBy("dt_oportunidade").agg(F.count("*").alias("n")).collect()}
    codes = standin.base(spark, SF).select(F.col(S.CODE).cast("bigint")).distinct().count()
    assert per_day == {dt.date(2024, 4, 25): codes, dt.date(2024, 4, 26): codes}
    assert registry.groupBy("dt_oportunidade", "id_oportunidade").count().filter("count > 1").count() == 0
    mailing = spark.read.parquet(paths.mailing)
    assert sorted(r.dt_mailing for r in mailing.select("dt_mailing").distinct().collect()) == [
        dt.date(2024, 4, 25), dt.date(2024, 4, 26)]
    assert mailing.filter(F.col("id_oportunidade").isNull()).count() == 0
    day1 = mailing.filter("dt_mailing = '2024-04-25'")
    assert day1.count() == _campaign(spark).dropDuplicates().count()
    assert len(mailing.columns) == 68


def test_load_writer_guards_charset(spark, tmpdir_fresh):
    df = spark.createDataFrame([("Preço 数 €", 1), ("ok", 1)], "CORINGA5 string, n_offers int")
    with pytest.raises(Exception):
        write_message_loads(df, f"{tmpdir_fresh}/raise")
    write_message_loads(df, f"{tmpdir_fresh}/replace", on_unmappable="replace")
    back = sorted(r.CORINGA5 for r in read_message_loads(spark, f"{tmpdir_fresh}/replace").collect())
    assert back == ["Preço ? €", "ok"]


def test_csv_landed_inputs_read_with_schema(spark, tmpdir_fresh):
    from offerline.sources.io import read_input

    base = standin.base(spark, SF)
    base.write.option("header", True).csv(f"{tmpdir_fresh}/base_csv")
    standin.hot_contacts(spark, SF).write.option("header", True).csv(f"{tmpdir_fresh}/Contatos_Quentes_1")
    back = read_input(spark, f"{tmpdir_fresh}/base_csv", S.base_input_schema(), fmt="csv")
    hot = read_input(spark, f"{tmpdir_fresh}/Contatos_Quentes*", S.HOT_CONTACTS_SCHEMA, fmt="csv")
    assert back.count() == base.count() and hot.count() == standin.hot_contacts(spark, SF).count()
    campaign = jobs.prepare_base(back, standin.insights(spark, SF), hot, standin.whatsapp_contacts(spark, SF))
    expected = _campaign(spark)
    assert campaign.select(S.SALE_DATE).distinct().count() == expected.select(S.SALE_DATE).distinct().count()
    assert campaign.exceptAll(expected).count() == 0


def test_csv_landing_lands_compressed_files(spark):
    import glob
    import os

    from offerline.plans.queries import QUERIES
    from offerline.session import ensure_checkpoint_dir

    ensure_checkpoint_dir(spark)
    root = spark.sparkContext.getCheckpointDir().removeprefix("file:")
    before = set(glob.glob(f"{root}/landing-*"))
    QUERIES["csv_landing"](spark, "/root/testdata/sf0.001")
    (landed,) = set(glob.glob(f"{root}/landing-*")) - before
    files = [f for f in glob.glob(f"{landed}/*.csv/part-*")]
    assert files and all(f.endswith(".csv.gz") and os.path.getsize(f) for f in files)
