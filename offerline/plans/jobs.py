"""End-to-end jobs: message load, board loads, ids and the mailing table.

Each job is one lazy plan from the inputs to its result; ``run_campaign``
adds the writes. The registry is written before the mailing table reads it,
so ids come from storage and are never recomputed.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass, replace

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from offerline import schemas as S
from offerline.functions.channel import DIS, WHATSAPP
from offerline.functions.numbers import is_invalid_number, strict_id
from offerline.functions.phones import CONTACT_SEPARATOR, MOBILE_PATTERN
from offerline.operators.contacts import assign_channels, campaign_base, normalize_contacts
from offerline.operators.enrich import column_split, enrich_base, fill_from_group, stack_bases
from offerline.operators.ingest import clean_base, exclude_value
from offerline.operators.loads import DIGEST, ENTRIES, board_loads, board_loads_of_distinct, display_columns, distinct_campaign, with_digest
from offerline.operators.messages import message_load
from offerline.operators.offers import cheapest_offer, fold_offers, with_address
from offerline.operators.publish import attach_ids, conform, with_load_timestamp
from offerline.operators.quality import NOT_CP1252, require_schema
from offerline.operators.registry import issue_ids
from offerline.operators.skew import hot_keys
from offerline.plans.staging import Stages
from offerline.session import ensure_checkpoint_dir
from offerline.sources.io import read_table, write_board_loads, write_message_loads, write_partitioned
from offerline.sources.landing import (
    REASONS,
    for_storing,
    layouts,
    read_landed_csv,
    read_landed_parquet,
    split_rejects,
    weekday_headers,
    with_id_reasons,
)


def prepare_base(base: DataFrame, insights: DataFrame, hot_contacts: DataFrame, whatsapp_contacts: DataFrame,
                 weekday_headers=S.WEEKDAY_COLUMNS, strict_phones: bool = False, prefer_insights=(),
                 channel_policy: str = "whatsapp_needs_mobile", mobile_pattern: str = MOBILE_PATTERN,
                 separator: str = CONTACT_SEPARATOR, hot: DataFrame | None = None) -> DataFrame:
    """Typed, enriched 64-column campaign base with phones and channels, and
    the insights' Flag and Score where they have them. Columns the base lacks
    come from the insights, and so do those of ``prefer_insights``."""
    cleaned = clean_base(base)
    wanted = [c for c in S.base_columns(weekday_headers) if c not in (S.MOBILE, S.LANDLINE)]
    from_insights = column_split(wanted, base.columns, [c for c in insights.columns if c != S.INSIGHTS_KEY], prefer_insights)
    # The insights' company number is joined for its own sake no more than other columns the base has.
    extra = [c for c in S.OPTIONAL_COLUMNS if c in insights.columns]
    enriched = enrich_base(cleaned, insights, hot_contacts, whatsapp_contacts, insight_columns=[*from_insights, *extra],
                           prefer_insights=prefer_insights, hot=hot)
    with_phones = normalize_contacts(enriched, strict=strict_phones, sep=separator, mobile_pattern=mobile_pattern)
    return assign_channels(campaign_base(with_phones, weekday_headers), policy=channel_policy)


# Ties on price are broken by the code, the client name, then the offer's own
# fields: rows equal in all of them give the same load, so the full base rows
# (64 columns) never have to travel through the arg-min shuffle.
OFFER_TIE_KEYS = (S.CODE, S.CLIENT_NAME, S.PRICE, S.SLA, S.DELIVERY_MODE, S.TERM, S.BASE, S.ADDRESS)


def cheapest_of_campaign(campaign: DataFrame, channels=None, keep_unpriced: bool = False) -> DataFrame:
    """Cheapest offer per (group, company, product, phone)."""
    rows = campaign if channels is None else campaign.filter(F.col(S.CHANNEL).isin(list(channels)))
    rows = with_address(rows).select(*S.OFFER_KEYS, S.LIMIT_PRICE, *OFFER_TIE_KEYS)
    return cheapest_offer(rows, tie_keys=OFFER_TIE_KEYS, keep_unpriced=keep_unpriced)


def fold_campaign(campaign: DataFrame, mode: str = "aligned", phone_policy: str = "first",
                  channels=None, n: int = 3) -> DataFrame:
    """Cheapest offer per (group, company, product, phone), folded per client."""
    return fold_offers(cheapest_of_campaign(campaign, channels), mode=mode, phone_policy=phone_policy, n=n)


def message_job(campaign: DataFrame, mode: str = "aligned", phone_policy: str = "first",
                channels=None, n: int = 3) -> DataFrame:
    """The message load (13 columns + n_offers)."""
    folded = fold_campaign(campaign, mode, phone_policy, channels, n)
    return message_load(folded, n=n, mode=mode)


def board_job(campaign: DataFrame, channels=None, display: bool = True) -> DataFrame:
    loads = board_loads(campaign.drop(*S.OPTIONAL_COLUMNS), channels)
    return display_columns(loads) if display else loads


def ids_job(campaign: DataFrame, registry: DataFrame, run_date) -> DataFrame:
    return issue_ids(campaign.select(F.col(S.CODE).alias("cod_sap")), registry, run_date)


@dataclass
class CampaignPaths:
    """Inputs (CSV or Parquet, globs allowed) and outputs of a run.

    ``staging``: where finished stages are kept, so that a run which starts
    again goes on behind them; without it they lie in the session's shared
    folder under a name of their own. ``rejects`` and ``report``: tables
    partitioned by run date, written if given.
    """
    base: str
    insights: str
    hot_contacts: str
    whatsapp_contacts: str
    message_loads: str
    board_loads: str
    registry: str
    mailing: str
    debug: str | None = None
    second_base: str | None = None
    staging: str | None = None
    rejects: str | None = None
    report: str | None = None


@dataclass(frozen=True)
class CampaignConfig:
    """Everything a run can be told; the defaults are the load format's.

    ``weekday_headers``: None finds them in the base's header.
    ``on_bad_row``: ``stop`` ends the job once all bad rows are known and
    stored, ``reject`` goes on without them.
    ``exclude``: (column, value), rows of the base left out (NULL stays).
    ``fill``: columns whose NULLs take the first value of the same code in
    the order of ``fill_order``.
    ``registry_buckets``: a new registry (a catalog table) is laid out in so
    many buckets of the code within each day.
    ``loaded_at``: UTC instant stamped on the mailing table as ``ts_carga``.
    """
    mode: str = "aligned"
    phone_policy: str = "first"
    channels: tuple | None = None
    max_offers: int = 3
    weekday_headers: tuple | None = None
    strict_phones: bool = False
    mobile_pattern: str = MOBILE_PATTERN
    separator: str = CONTACT_SEPARATOR
    channel_policy: str = "whatsapp_needs_mobile"
    prefer_insights: tuple = ()
    insight_columns: tuple = ()
    exclude: tuple | None = None
    fill: tuple = ()
    fill_order: tuple = (S.SALE_DATE, "VEDI_COD_MAT")
    on_bad_row: str = "stop"
    on_unmappable: str = "raise"
    loaded_at: str | None = None
    table_format: str = "parquet"
    rows_per_file: int | None = None
    registry_buckets: int | None = None
    resume: bool = True

    def __post_init__(self):
        if self.on_bad_row not in ("stop", "reject"):
            raise ValueError("on_bad_row must be 'stop' or 'reject'")


def _is_csv(path: str) -> bool:
    return path.rstrip("/").lower().endswith((".csv", "_csv"))


def _landed(spark: SparkSession, path: str, schema, optional=()) -> DataFrame:
    if _is_csv(path):
        return read_landed_csv(spark, path, schema, optional=optional)
    return read_landed_parquet(spark, path, schema, optional=optional)


def _weekdays(spark: SparkSession, path: str, run_date) -> tuple:
    """The weekday headers of the base's first layout."""
    if _is_csv(path):
        cells = next(iter(layouts(spark, path, {"sep": ",", "quote": '"', "escape": '"'})), ())
    else:
        cells = spark.read.parquet(path).columns
    return weekday_headers(cells, run_date)


def land_base(spark: SparkSession, paths: CampaignPaths, config: CampaignConfig, weekdays) -> DataFrame:
    """The priced base (and a second one stacked on it) with the reasons of
    its bad rows: width, values, ids. Columns the config takes from the
    insights may be missing."""
    fields = [f for f in S.base_input_schema(weekdays).fields if f.name not in config.prefer_insights]
    if config.exclude and config.exclude[0] not in [f.name for f in fields]:
        fields.append(T.StructField(config.exclude[0], T.StringType()))
    fields = [f for f in fields if f.name not in config.insight_columns]
    parts = [_landed(spark, p, T.StructType(fields)) for p in (paths.base, paths.second_base) if p]
    rows = with_id_reasons(stack_bases(*parts))
    return exclude_value(rows, *config.exclude) if config.exclude else rows


def _stored_input(stages: Stages, name: str, df: DataFrame, **metrics) -> tuple[DataFrame, DataFrame]:
    """(good rows, rejects) of a landed input, split by one stored pass."""
    bad = F.size(REASONS) > 0
    stored = stages.stored(name, lambda: for_storing(df), metrics={"rows": F.count(F.lit(1)), "rejected": F.count_if(bad), **metrics})
    return split_rejects(stored)


def campaign_metrics(campaign: DataFrame) -> dict:
    """Counts of the campaign write: rows, present values of each column,
    rows a channel load takes."""
    return {"rows": F.count(F.lit(1)), "dis_rows": F.count_if(F.col(S.CHANNEL) == DIS), "whatsapp_rows": F.count_if(F.col(S.CHANNEL) == WHATSAPP),
            **{f"present: {c}": F.count(F.col(f"`{c}`")) for c in campaign.columns}}


def run_campaign(spark: SparkSession, paths: CampaignPaths, run_date, config: CampaignConfig | None = None, **options) -> DataFrame:
    """Read the landed inputs, write every output of a run, return its report.

    Every step is a stage (``staging.Stages``): inputs and the campaign are
    stored as Parquet, which the writers read column by column, and a run
    that is started again with the same ``staging`` goes on where it ended.
    ``options`` are fields of ``CampaignConfig``.
    """
    config = replace(config or CampaignConfig(), **options)
    root = paths.staging or f"{ensure_checkpoint_dir(spark).rstrip('/')}/campaign-{uuid.uuid4().hex}"
    stages = Stages(spark, root, run_date, config.resume)
    weekdays = config.weekday_headers or _weekdays(spark, paths.base, run_date)

    insight_schema = T.StructType([*S.INSIGHTS_SCHEMA.fields, *[
        T.StructField(c, T.StringType()) for c in dict.fromkeys((*config.insight_columns, *config.prefer_insights)) if c not in S.INSIGHTS_SCHEMA.fieldNames()]])
    landed = land_base(spark, paths, config, weekdays)
    base, bad_base = _stored_input(stages, "base", landed, bad_numbers=F.count_if(is_invalid_number(S.DISTANCE)))
    insights, bad_insights = _stored_input(stages, "insights", _landed(spark, paths.insights, insight_schema, optional=("CNPJ", *S.OPTIONAL_COLUMNS)))
    hot_list, bad_hot = _stored_input(stages, "hot_contacts", _landed(spark, paths.hot_contacts, S.HOT_CONTACTS_SCHEMA))
    wpp, bad_wpp = _stored_input(stages, "whatsapp_contacts", _landed(spark, paths.whatsapp_contacts, S.WHATSAPP_CONTACTS_SCHEMA))
    named = [(n, b.withColumn("input", F.lit(n))) for n, b in (("base", bad_base), ("insights", bad_insights), ("hot_contacts", bad_hot), ("whatsapp_contacts", bad_wpp))]
    rejects = stack_bases(*[b for _, b in named]).withColumn("dt_run", F.lit(str(run_date)).cast("date"))
    if paths.rejects:
        stages.run("rejects", lambda observed: write_partitioned(
            observed(rejects, rows=F.count(F.lit(1))), paths.rejects, "dt_run", "overwrite", config.table_format))
    if config.on_bad_row == "stop":
        n_bad = stages.report().filter("metric = 'rejected'").agg(F.sum("value")).first()[0]
        if n_bad:
            raise ValueError(f"{n_bad} input rows are not valid; they are in the stages of {stages.path}" + (f" and in {paths.rejects}" if paths.rejects else ""))

    base = base.drop(config.exclude[0]) if config.exclude and config.exclude[0] not in S.base_columns(weekdays) else base
    if config.fill:
        base = fill_from_group(base, S.CODE, list(config.fill), [*config.fill_order, *[c for c in base.columns if c not in config.fill_order]])

    def prepared() -> DataFrame:
        coded = base.withColumn(S.CODE, strict_id(S.CODE, S.CODE, base.schema[S.CODE].dataType))
        return prepare_base(base, insights, hot_list, wpp, weekdays, config.strict_phones, config.prefer_insights, config.channel_policy,
                            config.mobile_pattern, config.separator, hot_keys(coded.select(S.CODE), S.CODE))

    lazy = prepare_base(base, insights, hot_list, wpp, weekdays, prefer_insights=config.prefer_insights)
    stored = stages.stored("campaign", lambda: with_digest(prepared()), metrics=campaign_metrics(lazy))
    campaign = stored.drop(*DIGEST)
    if paths.debug:  # intermediate frames for inspection
        folded = fold_campaign(campaign, config.mode, config.phone_policy, config.channels, config.max_offers)
        campaign.write.mode("overwrite").parquet(f"{paths.debug}/{run_date}/campaign")
        folded.write.mode("overwrite").parquet(f"{paths.debug}/{run_date}/folded")

    def messages(observed) -> None:
        offers = observed(cheapest_of_campaign(campaign, config.channels, keep_unpriced=True), offer_groups=F.count(F.lit(1)),
                          groups_without_price=F.count_if(F.col(S.LIMIT_PRICE).isNull()))
        load = message_load(fold_offers(offers.filter(F.col(S.LIMIT_PRICE).isNotNull()), mode=config.mode, phone_policy=config.phone_policy,
                                        n=config.max_offers), n=config.max_offers, mode=config.mode)
        require_schema(load, S.MESSAGE_SCHEMA)
        lost = {f"unmappable: {c}": F.count_if(F.col(c).rlike(NOT_CP1252)) for c in load.columns if load.schema[c].dataType.typeName() == "string"}
        write_message_loads(observed(load, rows=F.count(F.lit(1)), **{f"offers_{k}": F.count_if(F.col("n_offers") == k) for k in (1, 2, 3)}, **lost),
                            f"{paths.message_loads}/{run_date}", on_unmappable=config.on_unmappable, rows_per_file=config.rows_per_file)

    stages.run("messages", messages)
    # One dedupe of the campaign serves the board loads and the mailing table.
    once = stages.stored("distinct", lambda: distinct_campaign(stored), metrics={"rows": F.count(F.lit(1))})
    stages.run("boards", lambda observed: write_board_loads(
        observed(display_columns(board_loads_of_distinct(once.drop(*S.OPTIONAL_COLUMNS), config.channels, packed=True)), rows=F.sum(F.size(ENTRIES))),
        f"{paths.board_loads}/{run_date}", rows_per_file=config.rows_per_file))

    def ids(observed) -> None:
        registry = _read_registry(spark, paths.registry, config.table_format)
        fresh = ids_job(campaign, registry, run_date).checkpoint()     # what is appended is read by the same plan
        write_partitioned(observed(fresh, rows=F.count(F.lit(1))), paths.registry, "dt_oportunidade", "append", config.table_format,
                          (config.registry_buckets, "cod_sap") if config.registry_buckets else None)

    def mailing(observed) -> None:
        registry = read_table(spark, paths.registry, S.REGISTRY_SCHEMA, config.table_format)
        rows = conform(once.drop(*DIGEST), weekdays)
        require_schema(rows, S.mailing_schema(weekdays))
        rows = attach_ids(rows, registry, run_date)
        if config.loaded_at:
            rows = with_load_timestamp(rows, config.loaded_at)
        write_partitioned(observed(rows, rows=F.count(F.lit(1)), without_id=F.count_if(F.col("id_oportunidade").isNull())),
                          paths.mailing, "dt_mailing", "overwrite", config.table_format)

    stages.run("ids", ids)
    stages.run("mailing", mailing)
    report = stages.report()
    if paths.report:
        write_partitioned(report.withColumn("dt_run", F.lit(str(run_date)).cast("date")), paths.report, "dt_run", "overwrite", config.table_format)
    return report


def _read_registry(spark: SparkSession, target: str, fmt: str = "parquet") -> DataFrame:
    """The registry; empty on the first run only. Any other failure to read
    it stops the job, or codes would be numbered again."""
    empty = spark.createDataFrame([], S.REGISTRY_SCHEMA)
    if "/" not in target:
        return read_table(spark, target) if spark.catalog.tableExists(target) else empty
    try:
        return read_table(spark, target, S.REGISTRY_SCHEMA, fmt)
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return empty
        raise
