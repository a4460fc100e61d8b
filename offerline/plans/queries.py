"""Driver-table queries: each runs library operators on whole driver tables
(or stand-in inputs Spark derives from them) and returns flat columns whose
names match the SQL oracle of the same name (``oracles.py``)."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from offerline import schemas as S
from offerline.functions.numbers import (
    fixed_decimals,
    lenient_number,
    number_text,
    round_half_even,
    serial_day_to_date,
    serial_day_to_timestamp,
    strict_id,
)
from offerline.functions.phones import LEGACY_CONTACT_SEPARATOR, STRICT_MOBILE_BODY, find_landline, find_mobile
from offerline.functions.text import address_text, display_value
from offerline.operators.contacts import (
    assign_channels,
    dis_rows,
    normalize_contacts,
    overwrite_contact,
    whatsapp_rows,
)
from offerline.operators.enrich import fill_from_group, left_enrich, stack_bases
from offerline.operators.ingest import authorised_contacts, exclude_value, round_prices, split_invalid_ids
from offerline.operators.loads import (
    DIGEST,
    board_loads_of_distinct,
    dedupe_rows,
    display_columns,
    distinct_campaign,
    with_digest,
)
from offerline.operators.messages import message_load
from offerline.operators.offers import NUMBERED_COLUMNS, cheapest_offer, fold_offers
from offerline.operators.publish import attach_ids, conform, with_load_timestamp, with_placeholder_id
from offerline.operators.quality import encoding_loss, invalid_number_profile, key_multiplicity, nonnull_profile, null_columns
from offerline.operators.registry import issue_ids, new_codes
from offerline.operators.skew import deal, hot_keys
from offerline.plans import jobs, standin
from offerline.plans.staging import Stages
from offerline.sources.io import (
    STORED_CODEC,
    read_board_loads,
    read_message_loads,
    write_board_loads,
    write_message_loads,
    write_partitioned,
)
from offerline.sources.landing import (
    REASONS,
    for_storing,
    layouts,
    read_landed_csv,
    split_rejects,
    weekday_headers,
    with_id_reasons,
)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(fn):
    """Register a query under its function name (a trailing ``_q`` only
    avoids shadowing the operator of the same name)."""
    QUERIES[fn.__name__.removesuffix("_q")] = fn
    return fn


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return standin.table(spark, sf_dir, table)


def _scratch(spark: SparkSession, name: str) -> str:
    """A fresh folder under the session's shared checkpoint directory."""
    root = spark.sparkContext.getCheckpointDir()
    if root is None:
        from offerline.session import ensure_checkpoint_dir
        root = ensure_checkpoint_dir(spark)
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"


# Offer-grain headers -> flat output names.
FLAT = {
    S.CLIENT_NAME: "name", S.CLIENT_GROUP: "grp", S.COMPANY: "company", S.CODE: "code", S.MOBILE: "phone",
    S.PRODUCT: "product", S.ADDRESS: "address", S.PRICE: "price", S.LIMIT_PRICE: "lim", S.SLA: "sla",
    S.DELIVERY_MODE: "mode", S.TERM: "term", S.BASE: "base",
}


def _flat_fold(folded: DataFrame, n: int = 3) -> DataFrame:
    names = {c: FLAT[c] for c in S.CLIENT_KEYS}
    names.update({f"{c}_{i}": f"{FLAT[c]}_{i}" for c in NUMBERED_COLUMNS for i in range(1, n + 1)})
    return folded.withColumnsRenamed(names)


def _cheapest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cheapest_offer(round_prices(standin.offers(spark, sf_dir)))


def _base(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame | None]:
    """The priced base, dealt by code unless some code is hot, and the hot codes."""
    hot = hot_keys(standin.codes(spark, sf_dir), S.CODE)
    return standin.base(spark, sf_dir, by_code=hot is None), hot


def _campaign(spark: SparkSession, sf_dir: str) -> DataFrame:
    base, hot = _base(spark, sf_dir)
    return jobs.prepare_base(base, standin.insights(spark, sf_dir),
                             standin.hot_contacts(spark, sf_dir), standin.whatsapp_contacts(spark, sf_dir), hot=hot)


def _stored_campaign(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The campaign with its digest, stored as the job stores it."""
    path = _scratch(spark, "campaign")
    with_digest(_campaign(spark, sf_dir)).write.option("compression", STORED_CODEC).parquet(path)
    return spark.read.parquet(path)


def _contacts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return normalize_contacts(standin.contacts(spark, sf_dir))


# --- filters ------------------------------------------------------------------

@query
def authorised_filter(spark, sf_dir):
    """Authorised contacts, then the DIS and WhatsApp splits."""
    rows = authorised_contacts(standin.sql(spark, standin.EVENTS_CONTACTS_SQL, sf_dir).withColumnsRenamed(
        {"podemos_atuar": S.AUTHORISED, "canal": S.CHANNEL}))
    return dis_rows(rows).select("event_id", F.lit("DIS").alias("split")).unionByName(
        whatsapp_rows(rows).select("event_id", F.lit("WhatsApp").alias("split")))


@query
def exclude_origin(spark, sf_dir):
    """drop one origin, keep NULL origins."""
    return exclude_value(standin.sql(spark, standin.CUSTOMER_ORIGIN_SQL, sf_dir), "origem", "REATIVAÇÃO")


# --- casts ----------------------------------------------------------------------

@query
def strict_ids(spark, sf_dir):
    """Strict integer ids from text and from floats, and back to text."""
    df = standin.sql(spark, standin.CUSTOMER_ID_TEXT_SQL, sf_dir)
    code = strict_id(F.col("id_text"), "id_text", df.schema["id_text"].dataType)
    return df.select("c_custkey", code.alias("code"), code.cast("string").alias("code_text"),
                     strict_id(F.col("c_acctbal"), "c_acctbal", df.schema["c_acctbal"].dataType).alias("acct_int"))


@query
def serial_dates(spark, sf_dir):
    """Serial day numbers (with fractions) to dates and timestamps."""
    orders = _read(spark, sf_dir, "orders")
    serial = (F.datediff(F.to_date("o_orderdate"), F.lit("1899-12-30").cast("date"))
              + (F.col("o_orderkey") % 4) * F.lit(0.25))
    df = orders.select("o_orderkey", serial.alias("serial"))
    return df.select("o_orderkey", "serial",
                     F.date_format(serial_day_to_date("serial"), "yyyy-MM-dd").alias("sale_date"),
                     F.date_format(serial_day_to_timestamp("serial"), "yyyy-MM-dd HH:mm:ss").alias("sale_ts"))


@query
def coerce_round(spark, sf_dir):
    """Lenient numbers from text, numpy-equal rounding to 4 digits."""
    df = standin.sql(spark, standin.LINEITEM_TEXT_SQL, sf_dir)
    return df.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "dist_text",
                     round_half_even(lenient_number("dist_text")).alias("distance"),
                     round_half_even(F.col("l_extendedprice") / F.col("l_quantity")).alias("unit_price"))


@query
def invalid_number_profile_q(spark, sf_dir):
    """F8, V2: count and examples of present values that are not numbers."""
    df = standin.sql(spark, standin.LINEITEM_TEXT_SQL, sf_dir)
    return invalid_number_profile(df, ["dist_text", "qty_text"])


# --- checks ---------------------------------------------------------------------

@query
def nonnull_profile_q(spark, sf_dir):
    """Non-NULL count per column of customer LEFT JOIN urgent orders."""
    customer = _read(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_acctbal")
    orders = _read(spark, sf_dir, "orders").withColumn(
        "o_custkey", F.when(F.col("o_orderpriority") == "1-URGENT", F.col("o_custkey")))
    joined = left_enrich(customer, orders, "c_custkey", right_key="o_custkey",
                         columns=["o_orderkey", "o_totalprice", "o_orderdate"])
    return nonnull_profile(joined).select([F.col(c).cast("bigint").alias(c) for c in joined.columns])


# --- joins ----------------------------------------------------------------------

@query
def enrich_left(spark, sf_dir):
    """Rename key, narrow lookup sides, left joins with fan-out."""
    customer = _read(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey")
    orders = _read(spark, sf_dir, "orders").withColumn(
        "o_custkey", F.when(F.col("o_orderpriority") == "1-URGENT", F.col("o_custkey")))
    nation = _read(spark, sf_dir, "nation").withColumnRenamed("n_nationkey", "c_nationkey")
    out = left_enrich(customer, orders, "c_custkey", right_key="o_custkey", columns=["o_orderkey", "o_totalprice"])
    out = left_enrich(out, nation, "c_nationkey", columns=["n_name"])
    return out.select("c_custkey", "c_name", "o_orderkey", "o_totalprice", "n_name")


@query
def collision_suffix(spark, sf_dir):
    """Shared column names get _x/_y."""
    part = _read(spark, sf_dir, "part").select(F.col("p_partkey").alias("key"), F.col("p_name").alias("name"),
                                               F.col("p_retailprice").alias("price"))
    supplier = _read(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("key"), F.col("s_name").alias("name"),
                                                       F.col("s_acctbal").alias("price"))
    return left_enrich(part, supplier, "key").select("key", "name_x", "price_x", "name_y", "price_y")


@query
def stack_bases_q(spark, sf_dir):
    """Stack two bases by name, missing columns NULL."""
    customer = _read(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("key"), F.col("c_name").alias("name"), F.col("c_nationkey").alias("nationkey"),
        F.col("c_acctbal").alias("acctbal"), F.col("c_mktsegment").alias("mktsegment"))
    supplier = _read(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("key"), F.col("s_name").alias("name"), F.col("s_nationkey").alias("nationkey"),
        F.col("s_acctbal").alias("acctbal"))
    return stack_bases(customer, supplier)


# --- windows --------------------------------------------------------------------

@query
def fill_from_group_q(spark, sf_dir):
    """Fill NULLs from the first non-NULL value of the same part."""
    li = _read(spark, sf_dir, "lineitem")
    li = li.withColumns({
        "qty": F.when(F.col("l_linenumber") % 3 != 0, F.col("l_quantity")),
        "flag": F.when(F.col("l_orderkey") % 4 != 0, F.col("l_returnflag")),
    })
    order = ["l_orderkey", "l_linenumber", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
             "l_returnflag", "l_linestatus", "l_shipdate"]
    out = fill_from_group(li, "l_partkey", ["qty", "flag"], order)
    return out.select("l_orderkey", "l_partkey", "l_linenumber", "l_suppkey", "qty", "flag")


# --- contacts -------------------------------------------------------------------

@query
def contact_text(spark, sf_dir):
    """Contact fields joined into one text."""
    return _contacts(spark, sf_dir).select("code", F.col(S.CONTACT_TEXT).alias("contact_text"))


@query
def phones_synthetic(spark, sf_dir):
    """Mobile and landline from synthetic contact texts."""
    return _contacts(spark, sf_dir).select("code", F.col(S.MOBILE).alias("mobile"), F.col(S.LANDLINE).alias("landline"))


@query
def phones_documents(spark, sf_dir):
    """T2, T3 over whole document texts."""
    docs = _read(spark, sf_dir, "documents")
    return docs.select("doc_id", find_mobile("text").alias("mobile"), find_landline("text").alias("landline"))


@query
def assign_channel(spark, sf_dir):
    """WhatsApp rows without a mobile move to DIS."""
    df = _contacts(spark, sf_dir)
    return assign_channels(df.withColumn("canal_in", F.col(S.CHANNEL))).select(
        "code", "canal_in", F.col(S.CHANNEL).alias("canal"))


@query
def overwrite_contact_q(spark, sf_dir):
    """Contact column 10 takes the landline (DIS) / mobile (WhatsApp) when known."""
    df = _contacts(spark, sf_dir)
    dis = overwrite_contact(df, S.LANDLINE).select("code", F.lit("dis").alias("load"), F.col("10").alias("contact_10"))
    wpp = overwrite_contact(df, S.MOBILE).select("code", F.lit("wpp").alias("load"), F.col("10").alias("contact_10"))
    return dis.unionByName(wpp)


# --- offers ---------------------------------------------------------------------

@query
def cheapest_offer_q(spark, sf_dir):
    """A1, A2, P5: lowest limit price per (group, company, product, phone)."""
    df = _cheapest(spark, sf_dir).withColumnsRenamed({h: a for a, h in standin.OFFER_HEADERS.items()})
    return df.drop("l_shipdate")


@query
def address_text_q(spark, sf_dir):
    """T5: distinct non-NULL address parts joined by ', '."""
    df = standin.sql(spark, standin.ADDRESS_PARTS_SQL, sf_dir)
    parts = ["cep", "bairro", "rua", "num", "complemento", "municipio", "estado"]
    return df.select("c_custkey", address_text(parts).alias("address"))


def _list_text(c: str, dtype) -> F.Column:
    return F.concat_ws(" || ", *[(number_text(F.col(f"{c}_{i}")) if dtype == "double" else F.col(f"{c}_{i}").cast("string"))
                                for i in (1, 2, 3)])


@query
def client_lists(spark, sf_dir):
    """A3, A4: per client, first three distinct / full list entries as text."""
    folded = _flat_fold(fold_offers(_cheapest(spark, sf_dir), mode="positional"))
    lists = [("code", "bigint"), ("phone", "string"), ("product", "string"), ("address", "string"),
             ("price", "double"), ("lim", "double"), ("sla", "string"), ("mode", "string"), ("term", "string"),
             ("base", "string")]
    return folded.select("name", "grp", "company", *[_list_text(c, t).alias(f"{c}_list") for c, t in lists])


@query
def offers_wide(spark, sf_dir):
    """Aligned fold, up to three offers per client."""
    return _flat_fold(fold_offers(_cheapest(spark, sf_dir), mode="aligned"))


@query
def offers_wide_positional(spark, sf_dir):
    """A3, A4, P18 with the load format's positional lists."""
    return _flat_fold(fold_offers(_cheapest(spark, sf_dir), mode="positional"))


@query
def offers_wide_first_valid(spark, sf_dir):
    """F4 with phone_policy='first_valid'."""
    return _flat_fold(fold_offers(_cheapest(spark, sf_dir), mode="aligned", phone_policy="first_valid"))


@query
def offer_text(spark, sf_dir):
    """Offer blocks with escaped line breaks."""
    load = message_load(fold_offers(_cheapest(spark, sf_dir)), keep_keys=True)
    return load.select(F.col(S.CLIENT_NAME).alias("name"), F.col(S.CLIENT_GROUP).alias("grp"),
                       F.col(S.COMPANY).alias("company"), "CORINGA5")


@query
def message_fields(spark, sf_dir):
    """product/price fields and the code list."""
    load = message_load(fold_offers(_cheapest(spark, sf_dir), mode="positional"), mode="positional", keep_keys=True)
    return load.select(F.col(S.CLIENT_NAME).alias("name"), F.col(S.CLIENT_GROUP).alias("grp"),
                       F.col(S.COMPANY).alias("company"), "VALOR_DO_REGISTRO", "CORINGA1", "CORINGA2", "CORINGA3",
                       "CORINGA4", "CORINGA5")


# --- jobs -----------------------------------------------------------------------

@query
def message_load_q(spark, sf_dir):
    """N4 (flagship): the whole message job over the stand-in campaign."""
    return jobs.message_job(_campaign(spark, sf_dir))


@query
def offer_buckets(spark, sf_dir):
    """rows per offer count of the message load."""
    load = jobs.message_job(_campaign(spark, sf_dir))
    return load.filter(F.col("n_offers").isNotNull()).groupBy(F.col("n_offers").cast("bigint").alias("n_offers")).agg(
        F.count(F.lit(1)).alias("n_rows"))


@query
def dedupe_rows_q(spark, sf_dir):
    """Full-row dedupe of a narrow projection."""
    li = _read(spark, sf_dir, "lineitem").select("l_partkey", "l_returnflag", "l_linestatus", "l_quantity")
    return dedupe_rows(li)


@query
def display_formats(spark, sf_dir):
    """4-decimal, integer and date display texts."""
    orders = _read(spark, sf_dir, "orders")
    return orders.select(
        "o_orderkey",
        display_value("o_totalprice", "0.0000").alias("total_4"),
        display_value("o_custkey", "0").alias("cust_0"),
        display_value(F.to_date("o_orderdate"), "dd/mm/yyyy").alias("date_br"),
        F.date_format("o_orderdate", "yyMMdd").alias("yymmdd"),
        fixed_decimals(F.col("o_totalprice") / 7).alias("ratio_4"),
    )


def _dates_as_text(df: DataFrame) -> DataFrame:
    return df.select([F.date_format(F.col(f.name), "yyyy-MM-dd").alias(f.name) if f.dataType.typeName() == "date"
                      else F.col(f.name) for f in df.schema.fields])


@query
def conform_schema(spark, sf_dir):
    """The 66 typed table columns of the campaign base."""
    return _dates_as_text(conform(_campaign(spark, sf_dir)))


@query
def board_loads(spark, sf_dir):
    """The three deduplicated board loads with display formats."""
    once = distinct_campaign(_stored_campaign(spark, sf_dir)).drop(*S.OPTIONAL_COLUMNS)
    loads = display_columns(board_loads_of_distinct(once))
    renames = {k: v for k, v in S.MAILING_RENAMES.items() if k in loads.columns}
    return loads.withColumnsRenamed(renames)


def _customer_codes(spark, sf_dir):
    return _read(spark, sf_dir, "customer").select(F.col("c_custkey").alias("cod_sap"))


@query
def new_codes_q(spark, sf_dir):
    """Customers with no id on the run date (anti join)."""
    registry = standin.sql(spark, standin.CUSTOMER_REGISTRY_SQL, sf_dir)
    return new_codes(_customer_codes(spark, sf_dir), registry, standin.CUSTOMER_RUN_DATE)


@query
def issue_ids_q(spark, sf_dir):
    """Ids for the new codes after the day's highest number."""
    registry = standin.sql(spark, standin.CUSTOMER_REGISTRY_SQL, sf_dir)
    ids = issue_ids(_customer_codes(spark, sf_dir), registry, standin.CUSTOMER_RUN_DATE, bucket_width=256)
    return _dates_as_text(ids)


@query
def attach_ids_q(spark, sf_dir):
    """Orders as mailing rows LEFT JOIN the day's ids."""
    registry = standin.sql(spark, standin.CUSTOMER_REGISTRY_SQL, sf_dir)
    rows = _read(spark, sf_dir, "orders").select("o_orderkey", F.col("o_custkey").cast("string").alias("vedi_cod_cli"))
    return _dates_as_text(attach_ids(rows, registry, standin.CUSTOMER_RUN_DATE))


@query
def ids_job(spark, sf_dir):
    """Ids for the campaign's codes over the stand-in registry."""
    return _dates_as_text(jobs.ids_job(_campaign(spark, sf_dir), standin.registry(spark, sf_dir), standin.RUN_DATE))


@query
def mailing_table(spark, sf_dir):
    """The 68-column mailing rows of the run date."""
    once = distinct_campaign(_stored_campaign(spark, sf_dir)).drop(*DIGEST)
    return _dates_as_text(attach_ids(conform(once), standin.registry(spark, sf_dir), standin.RUN_DATE))


# --- sinks ----------------------------------------------------------------------

@query
def csv_round_trip(spark, sf_dir):
    """K1, K5: message load written as windows-1252 CSV by offer count under
    its run date, in files of few rows, and read back."""
    path = f"{_scratch(spark, 'message-loads')}/{standin.RUN_DATE}"
    write_message_loads(jobs.message_job(_campaign(spark, sf_dir)), path, rows_per_file=1000)
    back = read_message_loads(spark, path)
    return back.select(*[c for c in back.columns if c not in ("VALOR_DO_REGISTRO", "n_offers")],
                       F.col("VALOR_DO_REGISTRO").cast("bigint"), F.col("n_offers").cast("bigint"),
                       F.element_at(F.split(F.col("_metadata.file_path"), "/"), -3).alias("run_date"))


@query
def board_loads_written(spark, sf_dir):
    """K2, K5: the board loads written in planned files under their run date
    and read back; rows, codes and prices of each load."""
    path = f"{_scratch(spark, 'boards')}/{standin.RUN_DATE}"
    once = distinct_campaign(_stored_campaign(spark, sf_dir)).drop(*S.OPTIONAL_COLUMNS)
    write_board_loads(display_columns(board_loads_of_distinct(once, packed=True)), path, rows_per_file=20_000, passes=3)
    back = read_board_loads(spark, path)
    present = lambda c: F.count(F.col(f"`{c}`"))
    return back.groupBy("load").agg(
        F.count(F.lit(1)).alias("n_rows"), F.countDistinct(S.CODE).alias("n_codes"), present("10").alias("n_contact_10"),
        F.countDistinct("10").alias("n_contacts"), F.min(S.PRICE).alias("min_price_text"), F.max(S.SALE_DATE).alias("max_date_text"),
        present(S.LIMIT_PRICE).alias("n_limit_prices")).withColumn("run_date", F.lit(path.rsplit("/", 1)[1]))


@query
def csv_landing(spark, sf_dir):
    """The inputs landed as CSV in two layouts (other column
    order, further columns), read by header; the same campaign comes out."""
    root = _scratch(spark, "landing")
    base, hot = _base(spark, sf_dir)
    even = F.col(S.CODE).cast("bigint") % 2 == 0
    base.filter(even).write.option("header", True).option("escape", '"').option("compression", "gzip").csv(f"{root}/base.csv")
    other = base.filter(~even).withColumn("Observação", F.lit('livre, "sem" uso'))
    other.select(*reversed(other.columns)).write.mode("append").option("header", True).option("escape", '"').option("compression", "gzip").csv(f"{root}/base.csv")
    lists = {"insights": standin.insights(spark, sf_dir), "Contatos_Quentes_1": standin.hot_contacts(spark, sf_dir),
             "Contatos_1_Whatsapp": standin.whatsapp_contacts(spark, sf_dir)}
    for name, df in lists.items():
        df.select(*reversed(df.columns)).write.option("header", True).option("compression", "gzip").csv(f"{root}/{name}.csv")
    cells = next(iter(layouts(spark, f"{root}/base.csv", {})))
    weekdays = weekday_headers(cells, standin.RUN_DATE)
    read = lambda name, schema: split_rejects(read_landed_csv(spark, f"{root}/{name}.csv", schema))[0]
    campaign = jobs.prepare_base(read("base", S.base_input_schema(weekdays)), read("insights", S.INSIGHTS_SCHEMA),
                                 read("Contatos_Quentes*", S.HOT_CONTACTS_SCHEMA), read("Contatos_*Whatsapp", S.WHATSAPP_CONTACTS_SCHEMA), weekdays, hot=hot)
    return _dates_as_text(conform(campaign, weekdays))


@query
def campaign_rejects(spark, sf_dir):
    """One stored pass parts the landed rows; the others keep their
    line and every reason (width, value, id)."""
    root = _scratch(spark, "rejects")
    lines = standin.sql(spark, standin.LANDED_LINES_SQL, sf_dir).select(F.col("line").alias(standin.LANDED_HEADER))
    lines.write.option("header", True).option("sep", "\t").csv(f"{root}/base.csv")
    schema = T.StructType([T.StructField(S.LIMIT_PRICE, T.DoubleType()), T.StructField("pedido", T.LongType()),
                           T.StructField("linha", T.LongType()), T.StructField(S.CODE, T.StringType())])
    landed = with_id_reasons(read_landed_csv(spark, f"{root}/base.csv", schema), [S.CODE])
    stages = Stages(spark, root, standin.RUN_DATE)
    good, bad = split_rejects(stages.stored("base", lambda: for_storing(landed), metrics={"rejected": F.count_if(F.size(REASONS) > 0)}))
    none = F.lit(None).cast("string")
    return good.select(F.col("pedido").alias("order_key"), F.col("linha").alias("line_number"), strict_id(S.CODE, S.CODE, T.StringType()).alias("code"),
                       F.col(f"`{S.LIMIT_PRICE}`").alias("price"), none.alias("record"), none.alias("reasons")).unionByName(
        bad.select(F.lit(None).cast("long").alias("order_key"), F.lit(None).cast("long").alias("line_number"), F.lit(None).cast("long").alias("code"),
                   F.lit(None).cast("double").alias("price"), "record", F.array_join("reasons", "; ").alias("reasons")))


@query
def run_report(spark, sf_dir):
    """V1, Q9: counts observed by the campaign's and the offers' own writes:
    present values of every column, channel rows, offer groups without any price."""
    stages = Stages(spark, _scratch(spark, "report"), standin.RUN_DATE)
    lazy = _campaign(spark, sf_dir)
    campaign = stages.stored("campaign", lambda: lazy, metrics=jobs.campaign_metrics(lazy))
    stages.stored("offers", lambda: jobs.cheapest_of_campaign(campaign, keep_unpriced=True), metrics={
        "offer_groups": F.count(F.lit(1)), "groups_without_price": F.count_if(F.col(S.LIMIT_PRICE).isNull())})
    renames = F.create_map(*[F.lit(x) for k, v in S.MAILING_RENAMES.items() for x in (f"present: {k}", f"present: {v}")])
    return stages.report().select("stage", F.coalesce(renames[F.col("metric")], F.col("metric")).alias("metric"), "value")


@query
def enrich_hot_code(spark, sf_dir):
    """J1-J3 with one code on a third of the rows: hot codes are measured,
    their rows dealt out and only their contacts repeated."""
    rows = standin.sql(spark, standin.HOT_CODE_ROWS_SQL, sf_dir)
    contacts = standin.sql(spark, standin.HOT_CODE_CONTACTS_SQL, sf_dir)
    hot = hot_keys(rows, "code")
    joined = left_enrich(deal(rows, "code", hot), contacts, "code", right_key="codigo_sap", columns=["telefone"], hot=hot)
    return joined.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "code", "telefone")


@query
def campaign_column_split(spark, sf_dir):
    """Campaign columns from base or insights by declared priority."""
    base, hot = _base(spark, sf_dir)
    base = base.drop(*standin.SPLIT_MOVED)
    insights = standin.sql(spark, standin.SPLIT_INSIGHTS_SQL, sf_dir).withColumnsRenamed(
        {"sap_code": S.INSIGHTS_KEY, "score": "Score", "territorio": "Território", "grupo": "Grupo", "cluster": standin.SPLIT_PREFERRED})
    campaign = jobs.prepare_base(base, insights, standin.hot_contacts(spark, sf_dir), standin.whatsapp_contacts(spark, sf_dir),
                                 prefer_insights=(standin.SPLIT_PREFERRED,), hot=hot)
    return campaign.select(F.col(S.CODE).alias("code"), F.col("VEDI_COD_MAT").alias("material"), F.col("VEDI_COD_BAS").alias("base_code"),
                           F.col("Território").alias("territorio"), F.col("Grupo").alias("grupo"), F.col("Cluster").alias("cluster"),
                           F.col("Segmento").alias("segmento"), F.col("Score").alias("score"), F.col(S.MOBILE).alias("fone_1"))


@query
def registry_two_runs(spark, sf_dir):
    """Two days of ids and a re-run of the second day, whose
    codes are all customers under another number."""
    path = _scratch(spark, "registry")
    customer = _read(spark, sf_dir, "customer")
    day1 = customer.select(F.col("c_custkey").alias("cod_sap"))
    day2 = customer.select((F.col("c_custkey") + 500).alias("cod_sap"))
    empty = spark.createDataFrame([], S.REGISTRY_SCHEMA)
    for codes, day in ((day1, "2024-04-24"), (day2, "2024-04-25"), (day2, "2024-04-25")):
        current = spark.read.parquet(path) if day != "2024-04-24" else empty
        fresh = issue_ids(codes, current, day, bucket_width=256)
        write_partitioned(fresh, path, "dt_oportunidade", "append")
    return _dates_as_text(spark.read.parquet(path).select("cod_sap", "id_oportunidade", "dt_oportunidade"))


@query
def mailing_two_days(spark, sf_dir):
    """K4: dynamic partition overwrite replaces only the run's day: a first
    day, a second one, and the second again with other values."""
    path = _scratch(spark, "mailing")
    orders = _read(spark, sf_dir, "orders")
    for more, day in ((0, "2024-04-24"), (1, "2024-04-25"), (2, "2024-04-25")):
        out = orders.select("o_orderkey", (F.col("o_custkey") + more).alias("o_custkey"), F.lit(day).cast("date").alias("dt_mailing"))
        write_partitioned(out, path, "dt_mailing", "overwrite")
    return _dates_as_text(spark.read.parquet(path).select("o_orderkey", "o_custkey", "dt_mailing"))


# --- added checks -----------------------------------------------------------------

@query
def phones_strict(spark, sf_dir):
    """T2, T3 strict: digit-bounded matches, a matched 55 not doubled."""
    docs = _read(spark, sf_dir, "documents")
    return docs.select("doc_id", find_mobile("text", strict=True).alias("mobile"),
                       find_landline("text", strict=True).alias("landline"))


@query
def null_columns_q(spark, sf_dir):
    """Which columns of customer LEFT JOIN urgent orders hold a NULL."""
    customer = _read(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_acctbal")
    orders = _read(spark, sf_dir, "orders").withColumn(
        "o_custkey", F.when(F.col("o_orderpriority") == "1-URGENT", F.col("o_custkey")))
    joined = left_enrich(customer, orders, "c_custkey", right_key="o_custkey",
                         columns=["o_orderkey", "o_totalprice", "o_orderdate"])
    return null_columns(joined)


@query
def duplicate_contacts(spark, sf_dir):
    """Q4 report: contact keys listed more than once (each multiplies base rows)."""
    hot = standin.hot_contacts(spark, sf_dir)
    return key_multiplicity(hot, S.CONTACTS_KEY).withColumnRenamed(S.CONTACTS_KEY, "codigo_sap")


# --- variants and reports -----------------------------------------------------------

@query
def phones_older_pattern(spark, sf_dir):
    """Mobiles by the earlier, stricter pattern."""
    rows = normalize_contacts(standin.contacts(spark, sf_dir), mobile_pattern=STRICT_MOBILE_BODY)
    return rows.select("code", F.col(S.MOBILE).alias("mobile"))


@query
def contact_text_separator(spark, sf_dir):
    """Contact fields joined by the earlier separator."""
    rows = normalize_contacts(standin.contacts(spark, sf_dir), sep=LEGACY_CONTACT_SEPARATOR)
    return rows.select("code", F.col(S.CONTACT_TEXT).alias("contact_text"))


@query
def channel_from_mobile(spark, sf_dir):
    """Every row with a mobile becomes WhatsApp."""
    df = _contacts(spark, sf_dir).withColumn("canal_in", F.col(S.CHANNEL))
    return assign_channels(df, policy="mobile_is_whatsapp").select("code", "canal_in", F.col(S.CHANNEL).alias("canal"))


@query
def load_timestamp(spark, sf_dir):
    """The load instant, a job argument in UTC, in local time."""
    orders = _read(spark, sf_dir, "orders").select("o_orderkey")
    return with_load_timestamp(orders, "2024-04-25 12:00:00").select(
        "o_orderkey", F.date_format("ts_carga", "yyyy-MM-dd HH:mm:ss").alias("ts_carga"))


@query
def placeholder_id(spark, sf_dir):
    """A constant id column placed first."""
    return with_placeholder_id(_read(spark, sf_dir, "orders").select("o_orderkey", "o_custkey"))


@query
def reject_ids(spark, sf_dir):
    """Rows with an invalid id go to the rejects with the columns at fault."""
    good, bad = split_invalid_ids(standin.sql(spark, standin.CUSTOMER_BAD_IDS_SQL, sf_dir), ["code", "company"])
    return good.withColumn("reject_reason", F.lit(None).cast("string")).unionByName(bad)


@query
def encoding_loss_q(spark, sf_dir):
    """Q25 report: values per column that windows-1252 cannot hold."""
    return encoding_loss(standin.sql(spark, standin.DOCUMENT_TEXTS_SQL, sf_dir), ["text", "marked"])
