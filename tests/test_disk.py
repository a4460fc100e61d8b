"""What the campaign's queries write to disk: no shuffle of the text columns on the way to the
contacts, board loads moved once for all three, shuffle files gone with their stage."""

import datetime as dt
import glob

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from offerline import schemas as S
from offerline.operators.loads import DIGEST, ENTRIES, board_loads, board_loads_of_distinct, distinct_campaign, unpacked, with_digest
from offerline.plans import queries, standin
from offerline.plans.staging import Stages
from offerline.session import CAMPAIGN_CONF, apply_job_conf, ensure_checkpoint_dir
from offerline.sources.io import write_board_loads


def _tables(spark, root, hot_lines=0, n_orders=60):
    """Small driver tables with keys that match nothing and NULL keys; ``hot_lines`` lines of order 1."""
    day = dt.datetime(2024, 4, 16)
    made = {
        "region": ([(0, "SUL"), (1, "NORTE")], "r_regionkey int, r_name string"),
        "nation": ([(k, f"N{k}", k % 2) for k in range(4)], "n_nationkey int, n_name string, n_regionkey int"),
        "customer": ([(k, f"Customer#{k}", k % 5, 1.5 * k, "AUTO") for k in range(20)],
                     "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"),
        "supplier": ([(k, f"Supplier#{k}", 0, 0.0) for k in range(5)], "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double"),
        "part": ([(k, f"p {k}", "B", f"T{k % 3}", k, 1.0) for k in range(10)],
                 "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double"),
        "orders": ([(k if k else None, k % 22, "O", 10.0 * k, day, "1-URGENT") for k in range(n_orders)],
                   "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, o_orderdate timestamp, o_orderpriority string"),
        "lineitem": ([(k % 70 if k % 71 else None, k % 11, k % 6, 1 + k % 7, 2.0, 100.0 + k % 9, 0.1, 0.0, "A", "O", day) for k in range(400)]
                     + [(1, k % 10, k % 5, 1, 2.0, 50.0 + k, 0.1, 0.0, "A", "O", day) for k in range(hot_lines)],
                     "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, l_extendedprice double, "
                     "l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp"),
        "events": ([(1,)], "event_id bigint"),
        "documents": ([(1,)], "doc_id bigint"),
    }
    for name, (rows, schema) in made.items():
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{root}/{name}.parquet")
    return root


def _rows(df, columns=None):
    return sorted(str(tuple(r)) for r in df.select(*[f"`{c}`" for c in columns or df.columns]).collect())


@pytest.mark.parametrize("by_code", [True, False])
def test_base_has_the_rows_of_its_sql(spark, tmpdir_fresh, by_code):
    d = _tables(spark, tmpdir_fresh)
    plain = standin.sql(spark, standin.BASE_SQL, d).withColumnsRenamed(standin._to_headers())
    base = standin.base(spark, d, by_code=by_code)
    assert base.schema.simpleString() == plain.schema.simpleString()
    rows = _rows(base)
    assert rows == _rows(plain) and len(rows) > 100


def test_campaign_joins_find_the_base_by_code(spark, tmpdir_fresh):
    d = _tables(spark, tmpdir_fresh, n_orders=400)
    joined = queries.jobs.prepare_base(standin.base(spark, d), *[lists(spark, d).hint("merge") for lists in (
        standin.insights, standin.hot_contacts, standin.whatsapp_contacts)])
    text = joined._jdf.queryExecution().executedPlan().toString()
    assert text.count(f"Exchange hashpartitioning({S.CODE}") == 3       # the lists; the base stays where it is


def test_hot_code_is_dealt_to_salts(spark, tmpdir_fresh):
    hot = _tables(spark, tmpdir_fresh, hot_lines=300)
    found = queries._base(spark, hot)[1]
    assert [r[S.CODE] for r in found.filter("n_salts > 20").collect()] == [1]
    rows = queries._campaign(spark, hot)
    plain = queries.jobs.prepare_base(standin.sql(spark, standin.BASE_SQL, hot).withColumnsRenamed(standin._to_headers()), standin.insights(spark, hot),
                                      standin.hot_contacts(spark, hot), standin.whatsapp_contacts(spark, hot))
    found = _rows(rows)
    assert found == _rows(plain) and len(found) > 300


def _once(spark, root):
    """A stored campaign with copies and rows that differ in contact 10 alone, and its distinct rows."""
    ensure_checkpoint_dir(spark)
    rows = queries._campaign(spark, _tables(spark, f"{root}/in"))
    rows.coalesce(1).write.parquet(f"{root}/once")
    rows = spark.read.parquet(f"{root}/once")
    rows = rows.unionByName(rows.withColumn("10", F.lit("outro"))).unionByName(rows.limit(20))
    with_digest(rows).coalesce(1).write.parquet(f"{root}/rows")
    rows = spark.read.parquet(f"{root}/rows")
    distinct_campaign(rows).coalesce(1).write.parquet(f"{root}/distinct")
    return rows.drop(*DIGEST), spark.read.parquet(f"{root}/distinct")


@pytest.mark.parametrize("channels", [None, ("DIS",)])
def test_packed_board_loads_are_the_board_loads(spark, tmpdir_fresh, channels):
    rows, once = _once(spark, tmpdir_fresh)
    want = _rows(board_loads(rows, channels))
    packed = board_loads_of_distinct(once, channels, packed=True)
    packed.coalesce(1).write.parquet(f"{tmpdir_fresh}/packed")
    stored = spark.read.parquet(f"{tmpdir_fresh}/packed")
    assert _rows(unpacked(stored), board_loads(rows).columns) == want
    assert stored.filter(F.size(ENTRIES) > 1).count() > 0 and stored.count() < len(want)


@pytest.mark.parametrize("passes", [3])
def test_packed_board_loads_are_moved_once_and_written_in_planned_files(spark, tmpdir_fresh, passes):
    rows, once = _once(spark, tmpdir_fresh)
    path = f"{tmpdir_fresh}/boards"
    spark.range(1).select(F.lit("old").alias("load"), "id").write.partitionBy("load").parquet(path)
    write_board_loads(board_loads_of_distinct(once, packed=True), path, rows_per_file=50, passes=passes)
    want = board_loads(rows)
    assert _rows(spark.read.parquet(path), want.columns) == _rows(want)
    files = glob.glob(f"{path}/load=*/*.parquet")
    assert files and all(f.endswith(".zstd.parquet") for f in files)
    for f in files:
        part = pq.read_table(f, columns=[S.CLIENT_NAME, S.CODE]).to_pylist()
        held = [(r[S.CLIENT_NAME] is not None, r[S.CLIENT_NAME] or "", r[S.CODE]) for r in part]
        assert 0 < len(held) <= 50 and held == sorted(held)


def test_campaign_queries_clean_their_shuffles_and_stages_are_small(spark, tmpdir_fresh):
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    assert CAMPAIGN_CONF[key] == "true"
    kept = {k: spark.conf.get(k, None) for k in CAMPAIGN_CONF}
    try:
        apply_job_conf(spark)
        df = spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count()
        assert sorted(df.collect()) == sorted(df.collect())     # an action run again after its files went
        Stages(spark, tmpdir_fresh, "2024-04-25").stored("s", lambda: df)
        assert glob.glob(f"{tmpdir_fresh}/2024-04-25/s/*.zstd.parquet")
    finally:
        apply_job_conf(spark, campaign=False)
        for k, v in kept.items():
            if v is not None:
                spark.conf.set(k, v)
