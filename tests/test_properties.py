
import os

import pytest
from pyspark.sql import functions as F

from offerline import schemas as S
from offerline.operators import cheapest_offer, fold_offers, issue_ids, message_load, publish_mailing
from offerline.operators.ingest import round_prices
from offerline.plans import jobs, standin

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")


@pytest.fixture(scope="module")
def campaign(spark):
    return jobs.prepare_base(standin.base(spark, SF), standin.insights(spark, SF),
                             standin.hot_contacts(spark, SF), standin.whatsapp_contacts(spark, SF)).cache()


def test_cheapest_is_minimum_of_its_group(spark):
    offers = round_prices(standin.offers(spark, SF))
    best = cheapest_offer(offers)
    keys = list(S.OFFER_KEYS)
    mins = offers.filter(F.col(S.LIMIT_PRICE).isNotNull()).groupBy(*keys).agg(F.min(S.LIMIT_PRICE).alias("m"))
    joined = best.join(mins, [best[k].eqNullSafe(mins[k]) for k in keys])
    assert joined.filter(F.col(S.LIMIT_PRICE) != F.col("m")).count() == 0
    assert best.count() == mins.count()


@pytest.mark.parametrize("mode", ["aligned", "positional"])
def test_one_row_per_client_and_buckets_partition(spark, campaign, mode):
    folded = jobs.fold_campaign(campaign, mode=mode)
    assert folded.count() == folded.select(*S.CLIENT_KEYS).distinct().count()
    load = message_load(folded, mode=mode)
    per_bucket = {r.n_offers: r["count"] for r in load.groupBy("n_offers").count().collect()}
    assert sum(per_bucket.values()) == load.count()
    assert set(per_bucket) <= {1, 2, 3, None}
    # aligned offers are never missing in the middle
    if mode == "aligned":
        assert per_bucket.get(None, 0) == 0


def test_ids_unique_and_dense(spark, campaign):
    registry = standin.registry(spark, SF)
    fresh = issue_ids(campaign.select(F.col(S.CODE).alias("cod_sap")), registry, standin.RUN_DATE)
    day = registry.filter(F.col("dt_oportunidade") == F.lit(standin.RUN_DATE).cast("date"))
    start = day.select(F.max(F.substring("id_oportunidade", 7, 6).cast("long"))).first()[0] or 0
    seqs = sorted(int(r.id_oportunidade[6:]) for r in fresh.collect())
    assert seqs == list(range(start + 1, start + 1 + len(seqs)))
    assert fresh.join(day, "cod_sap").count() == 0


def test_mailing_rows_equal_deduplicated_base(spark, campaign):
    mailing = publish_mailing(campaign, standin.registry(spark, SF), standin.RUN_DATE)
    assert mailing.count() == campaign.dropDuplicates().count()
    assert len(mailing.columns) == 68
