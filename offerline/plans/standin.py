"""Stand-in campaign inputs derived from the driver tables.

The campaign's own inputs (priced base, insights, contact lists, id
registry) are mapped onto the TPC-H-style driver tables: a base row is a
lineitem with its order, customer, part and supplier; the SAP code of a
point of consumption is the order key; the client is the customer; the
product is the part type; the base is the supplier; prices are unit prices.
Phones are built from keys with integer arithmetic only.

The derivations are SQL in the subset both Spark SQL and DuckDB accept, so
the Spark jobs and the DuckDB oracles start from identical inputs. Table
names are placeholders: Spark reads the Parquet files directly, DuckDB
uses its registered views.
"""

from __future__ import annotations

import hashlib
import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from offerline import schemas as S
from offerline.functions.numbers import strict_id

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents")

RUN_DATE = "2024-04-25"
PREVIOUS_DATE = "2024-04-24"


def spark_refs(spark: SparkSession, sf_dir: str) -> dict[str, str]:
    """Temp views of the driver tables of ``sf_dir`` (names unique per folder)."""
    tag = "ol_" + hashlib.sha1(sf_dir.encode()).hexdigest()
    refs = {}
    for t in TABLES:
        name = f"{tag}_{t}"
        if not spark.catalog.tableExists(name):
            spark.read.parquet(f"{sf_dir}/{t}.parquet").createOrReplaceTempView(name)
        refs[t] = name
    return refs


DUCKDB_REFS = {t: t for t in TABLES}


def sql(spark: SparkSession, template: str, sf_dir: str, dealt: bool = False) -> DataFrame:
    """The template over the driver tables. ``dealt``: lineitem's narrow rows
    are dealt to tasks first (a file of one row group is one task, which would
    build all of a campaign's text columns)."""
    refs = dict(spark_refs(spark, sf_dir))
    if dealt:
        name = f"{refs['lineitem']}_dealt"
        if not spark.catalog.tableExists(name):
            spark.table(refs["lineitem"]).repartition("l_orderkey", "l_linenumber").createOrReplaceTempView(name)
        refs["lineitem"] = name
    return spark.sql(template.format(**refs))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One driver table."""
    return spark.table(spark_refs(spark, sf_dir)[name])


# --- phone texts built from an integer key ----------------------------------

def mobile_text(k: str) -> str:
    return (f"'(' || CAST(11 + ({k}) % 89 AS STRING) || ') 9' || LPAD(CAST(({k}) % 10000 AS STRING), 4, '0') "
            f"|| '-' || LPAD(CAST((({k}) * 7) % 10000 AS STRING), 4, '0')")


def intl_text(k: str) -> str:
    return (f"'+55 ' || CAST(11 + ({k}) % 89 AS STRING) || ' 9' || LPAD(CAST((({k}) * 3) % 10000 AS STRING), 4, '0') "
            f"|| LPAD(CAST((({k}) * 11) % 10000 AS STRING), 4, '0')")


def landline_text(k: str) -> str:
    return (f"'(' || CAST(11 + ({k}) % 89 AS STRING) || ') ' || CAST(2 + ({k}) % 4 AS STRING) "
            f"|| LPAD(CAST(({k}) % 1000 AS STRING), 3, '0') || '-' || LPAD(CAST((({k}) * 13) % 10000 AS STRING), 4, '0')")


def bare_text(k: str) -> str:
    return f"CAST(1100000000 + (({k}) * 7919) % 8900000000 AS STRING)"


# --- the priced base: stand-in name -> expression ----------------------------
# Names are the mailing table's column names (contacts "1".."10" are c1..c10).
BASE_EXPRESSIONS = {
    # Some clients have no name, some one or two products only, some products no price.
    "nome_cliente": "CASE WHEN c.c_custkey % 41 = 0 THEN NULL ELSE c.c_name END",
    "grupo_cliente": "c.c_mktsegment",
    "aeco": "'AECO ' || CAST(c.c_nationkey AS STRING)",
    "segmento": "p.p_brand",
    "lbr_medio_mensal": "c.c_acctbal",
    "volume_medio_mensal": "o.o_totalprice",
    "zv_br": "'ZV' || CAST(n.n_regionkey AS STRING)",
    "titular": "'T' || CAST(c.c_custkey % 13 AS STRING)",
    "h_n3": "'N3-' || CAST(c.c_nationkey % 4 AS STRING)",
    "h_n2": "'N2-' || CAST(c.c_nationkey % 2 AS STRING)",
    "canal_fonte": "CASE WHEN o.o_orderkey % 2 = 0 THEN 'Ativo' ELSE 'Receptivo' END",
    "vedi_cod_cli": "CAST(o.o_orderkey AS STRING)",
    "clie_nom_municipio": "n.n_name",
    "clie_nom_estado": "r.r_name",
    "cnpj_basico": "CAST(c.c_custkey AS STRING)",
    "cep": "LPAD(CAST((o.o_orderkey * 37) % 100000 AS STRING), 5, '0')",
    "bairro": "n.n_name",
    "rua": "'Rua ' || CAST(o.o_orderkey % 50 AS STRING)",
    "num": "CASE WHEN o.o_orderkey % 3 = 0 THEN NULL ELSE CAST(o.o_orderkey % 1000 AS STRING) END",
    "complemento": "CASE WHEN o.o_orderkey % 4 = 0 THEN 'Rua ' || CAST(o.o_orderkey % 50 AS STRING) ELSE NULL END",
    "vedi_cod_mat": "CAST(l.l_partkey AS STRING)",
    "vedi_dsc_mat": ("CASE c.c_custkey % 7 WHEN 0 THEN 'DIESEL' WHEN 1 THEN CASE WHEN l.l_partkey % 2 = 0 THEN 'DIESEL' ELSE 'ETANOL' END "
                     "ELSE p.p_type END"),
    "vedi_dat_ven": "CAST(l.l_shipdate AS DATE)",
    "vedi_vol": "l.l_quantity",
    "vedi_dsc_ict": "CASE l.l_returnflag WHEN 'A' THEN 'CIF' WHEN 'N' THEN 'FOB' ELSE 'RETIRA' END",
    "produto_d": "p.p_name",
    "vedi_cod_bas": "CAST(l.l_suppkey AS STRING)",
    "base": "s.s_name",
    "lista_de_preco": "'LP' || CAST(p.p_size AS STRING)",
    "exposicao_total": "CAST(c.c_custkey % 97 AS STRING)",
    "exposicao": "CAST(c.c_custkey % 89 AS STRING) || '%'",
    "limite_de_credito": "CAST((c.c_custkey * 1000) % 50000 AS STRING)",
    "limite_de_credito_2": "CAST((c.c_custkey * 700) % 50000 AS STRING)",
    "distancia": ("CASE WHEN l.l_linenumber % 7 = 0 THEN 'n/d' ELSE CAST(l.l_partkey % 500 AS STRING) || '.' "
                  "|| LPAD(CAST((l.l_suppkey * 7 + l.l_orderkey) % 100000 AS STRING), 5, '0') END"),
    "market": "'M' || CAST(o.o_orderkey % 5 AS STRING)",
    "sla_de_entrega": "o.o_orderpriority",
    "c1": f"CASE WHEN l.l_linenumber % 2 = 0 THEN {landline_text('o.o_orderkey')} ELSE NULL END",
    "c2": "CASE WHEN o.o_orderkey % 11 = 0 THEN 'sem contato' ELSE NULL END",
    **{f"c{i}": f"CASE WHEN o.o_orderkey % {11 + 2 * i} = 0 THEN {text} ELSE NULL END" for i, text in (
        (3, mobile_text("o.o_orderkey + 3")), (4, "'n/a'"), (5, landline_text("o.o_orderkey + 5")), (6, "'ramal 12'"),
        (7, intl_text("o.o_orderkey + 7")), (8, bare_text("o.o_orderkey + 8")), (9, "'(11) 4'"))},
    "c10": f"CASE WHEN l.l_linenumber % 5 = 0 THEN {bare_text('c.c_custkey')} ELSE NULL END",
    "novo_preco_final_r_l": "l.l_extendedprice / l.l_quantity",
    "dias_de_prazo": "CAST(7 * (1 + l.l_linenumber % 3) AS STRING)",
    "grupo_cnpj_basico": "c.c_mktsegment || '-' || CAST(c.c_custkey AS STRING)",
    "novo_preco_final_limite": "CASE WHEN l.l_partkey % 37 = 0 THEN NULL ELSE l.l_extendedprice * (1 - l.l_discount) / l.l_quantity END",
    "cnpj": "CAST(c.c_custkey * 1000000 + l.l_suppkey AS STRING)",
    "flag_mkt": "CASE WHEN c.c_custkey % 2 = 0 THEN 'S' ELSE 'N' END",
    "fonte": "'F' || CAST(l.l_suppkey % 3 AS STRING)",
    "territorio": "r.r_name",
    "grupo": "c.c_mktsegment",
    "cluster": "'K' || CAST(c.c_custkey % 6 AS STRING)",
    **{w: f"CASE WHEN (o.o_orderkey + {k}) % 5 = 0 THEN 'X' ELSE NULL END"
       for k, w in enumerate(("terca_feira_16_04", "quarta_feira_17_04", "quinta_feira_18_04",
                              "sexta_feira_19_04", "segunda_feira_22_04"))},
    "canal": "CASE o.o_orderkey % 4 WHEN 0 THEN 'WhatsApp' WHEN 1 THEN 'WhatsApp' WHEN 2 THEN 'DIS' ELSE 'Outro' END",
}

BASE_FROM = (
    "{lineitem} l JOIN {orders} o ON l.l_orderkey = o.o_orderkey "
    "JOIN {customer} c ON o.o_custkey = c.c_custkey "
    "JOIN {part} p ON l.l_partkey = p.p_partkey "
    "JOIN {supplier} s ON l.l_suppkey = s.s_suppkey "
    "JOIN {nation} n ON c.c_nationkey = n.n_nationkey "
    "JOIN {region} r ON n.n_regionkey = r.r_regionkey"
)

BASE_SQL = "SELECT " + ", ".join(f"{e} AS {a}" for a, e in BASE_EXPRESSIONS.items()) + " FROM " + BASE_FROM

def _unqualified(expression: str) -> str:
    """Without table aliases: no two driver tables share a column name."""
    return re.sub(r"\b([a-z])\.(?=\1_)", "", expression)


# The two halves of the same join as the driver tables' own columns, without nation and region.
_USED = set(re.findall(r"\b([locps])\.(?=\1_)(\w+)", " ".join(BASE_EXPRESSIONS.values()))) | {("l", "l_orderkey"), ("c", "c_nationkey")}
LINES_SQL = (
    "SELECT " + ", ".join(sorted(c for t, c in _USED if t in "lps")) + " FROM "
    "{lineitem} l JOIN {part} p ON l.l_partkey = p.p_partkey JOIN {supplier} s ON l.l_suppkey = s.s_suppkey WHERE l.l_orderkey IS NOT NULL"
)
ORDERS_SQL = (
    "SELECT " + ", ".join(sorted(c for t, c in _USED if t in "oc")) + " FROM "
    "{orders} o JOIN {customer} c ON o.o_custkey = c.c_custkey WHERE o.o_orderkey IS NOT NULL"
)


def listed(condition: str) -> str:
    """The code of an order, negative where ``condition`` fails: every order
    is in the list, and some codes match no client."""
    return f"CAST(CASE WHEN {condition} THEN o_orderkey ELSE -o_orderkey END AS STRING)"


INSIGHTS_SQL = (
    f"SELECT {listed('o_orderkey % 2 = 0')} AS sap_code, CAST(o_custkey AS STRING) AS cnpj, "
    "CAST(o_orderkey % 100 AS STRING) AS score, CASE WHEN o_orderkey % 4 = 0 THEN 'A' ELSE 'B' END AS flag "
    "FROM {orders}"
)

HOT_CONTACTS_SQL = (
    f"SELECT {listed('o_orderkey % 5 <> 0')} AS codigo_sap, "
    "CASE WHEN o_orderkey % 7 = 0 THEN 'Não' ELSE 'Sim' END AS podemos_atuar, "
    f"{mobile_text('o_orderkey')} AS telefone_contato_2 FROM {{orders}} "
    "UNION ALL "
    f"SELECT {listed('o_orderkey % 13 = 0')}, 'Sim', {intl_text('o_orderkey + 1')} FROM {{orders}}"
)

WHATSAPP_CONTACTS_SQL = (
    f"SELECT {listed('o_orderkey % 3 = 0')} AS codigo_sap, {intl_text('o_orderkey * 3')} AS whatsapp_telefone "
    "FROM {orders}"
)

# Ids already issued: some codes on the run date, others the day before.
REGISTRY_SQL = (
    "SELECT o_orderkey AS cod_sap, CASE WHEN o_orderkey % 4 = 1 THEN '240425' ELSE '240424' END "
    "|| LPAD(CAST(o_orderkey AS STRING), 6, '0') AS id_oportunidade, "
    f"CASE WHEN o_orderkey % 4 = 1 THEN DATE '{RUN_DATE}' ELSE DATE '{PREVIOUS_DATE}' END AS dt_oportunidade "
    "FROM {orders}"
)

# Synthetic contact rows per customer (phone fields of every shape).
CONTACTS_SQL = (
    "SELECT c_custkey AS code, "
    f"CASE c_custkey % 5 WHEN 0 THEN NULL WHEN 1 THEN {mobile_text('c_custkey')} WHEN 2 THEN {intl_text('c_custkey')} "
    f"WHEN 3 THEN {landline_text('c_custkey')} ELSE {bare_text('c_custkey')} END AS hot_phone, "
    f"CASE WHEN c_custkey % 3 = 0 THEN {intl_text('c_custkey * 7')} ELSE NULL END AS wpp_phone, "
    f"CASE WHEN c_custkey % 2 = 0 THEN {bare_text('c_custkey + 5')} ELSE NULL END AS c1, "
    "CASE WHEN c_custkey % 7 = 0 THEN 'sem contato' ELSE NULL END AS c2, "
    + ", ".join(f"CAST(NULL AS STRING) AS c{i}" for i in range(3, 10)) + ", "
    f"CASE WHEN c_custkey % 4 = 0 THEN {landline_text('c_custkey + 1')} ELSE NULL END AS c10, "
    "CASE c_custkey % 4 WHEN 0 THEN 'WhatsApp' WHEN 1 THEN 'WhatsApp' WHEN 2 THEN 'DIS' ELSE 'Outro' END AS canal "
    "FROM {customer}"
)

# Narrow priced offers: one row per lineitem with the offer-grain columns.
# A client has up to three phones (one of every seventh order is missing).
OFFER_EXPRESSIONS = {
    "nome_cliente": "c.c_name",
    "grupo_cliente": "c.c_mktsegment",
    "cnpj_basico": "c.c_custkey",
    "vedi_cod_cli": "o.o_orderkey",
    "vedi_dsc_mat": "p.p_type",
    "fone_1": ("CASE WHEN o.o_orderkey % 7 = 0 THEN NULL ELSE '55' || CAST(11 + c.c_custkey % 89 AS STRING) || '9' "
               "|| LPAD(CAST((c.c_custkey * 3 + o.o_orderkey % 3) % 100000000 AS STRING), 8, '0') END"),
    "novo_preco_final_r_l": "l.l_extendedprice / l.l_quantity",
    "novo_preco_final_limite": "l.l_extendedprice * (1 - l.l_discount) / l.l_quantity",
    "sla_de_entrega": "o.o_orderpriority",
    "vedi_dsc_ict": "l.l_returnflag",
    "dias_de_prazo": "CAST(7 * (1 + l.l_linenumber % 3) AS STRING)",
    "base": "s.s_name",
    "endereco_concatenado": "n.n_name || ', ' || r.r_name || ', ' || CAST(o.o_orderkey % 50 AS STRING)",
    "vedi_cod_mat": "l.l_partkey",
    "l_linenumber": "l.l_linenumber",
    "l_quantity": "l.l_quantity",
    "l_tax": "l.l_tax",
    "l_shipdate": "l.l_shipdate",
}
OFFERS_SQL = (
    "SELECT " + ", ".join(f"{e} AS {a}" for a, e in OFFER_EXPRESSIONS.items()) + " FROM "
    "{lineitem} l JOIN {orders} o ON l.l_orderkey = o.o_orderkey "
    "JOIN {customer} c ON o.o_custkey = c.c_custkey "
    "JOIN {part} p ON l.l_partkey = p.p_partkey "
    "JOIN {supplier} s ON l.l_suppkey = s.s_suppkey "
    "JOIN {nation} n ON c.c_nationkey = n.n_nationkey "
    "JOIN {region} r ON n.n_regionkey = r.r_regionkey"
)
# Headers of the offer-grain columns (the rest keep their stand-in names).
OFFER_HEADERS = {
    "nome_cliente": S.CLIENT_NAME, "grupo_cliente": S.CLIENT_GROUP, "cnpj_basico": S.COMPANY,
    "vedi_cod_cli": S.CODE, "vedi_dsc_mat": S.PRODUCT, "fone_1": S.MOBILE, "novo_preco_final_r_l": S.PRICE,
    "novo_preco_final_limite": S.LIMIT_PRICE, "sla_de_entrega": S.SLA, "vedi_dsc_ict": S.DELIVERY_MODE,
    "dias_de_prazo": S.TERM, "base": S.BASE, "endereco_concatenado": S.ADDRESS, "vedi_cod_mat": "VEDI_COD_MAT",
}


def _to_headers() -> dict[str, str]:
    back = {v: k for k, v in S.MAILING_RENAMES.items()}
    out = {a: back[a] for a in BASE_EXPRESSIONS if a in back}
    out.update({f"c{i}": str(i) for i in range(1, 11)})
    out["cnpj"] = "CNPJ"
    return out


def base(spark: SparkSession, sf_dir: str, by_code: bool = True) -> DataFrame:
    """The priced base with the campaign headers (ids as text, sale date,
    lenient distance text, raw prices): the rows of ``BASE_SQL``.

    The driver tables' own narrow columns are joined, then the text columns
    are built. ``by_code``: both halves are dealt by and joined on the strict
    code (an order key, its own text's number), so that later joins on the
    code find the rows in place and the text columns are not shuffled. A
    code's rows are in one task then; with ``by_code=False`` the joined rows
    are dealt one by one."""
    refs = spark_refs(spark, sf_dir)
    lines, orders = spark.sql(LINES_SQL.format(**refs)), spark.sql(ORDERS_SQL.format(**refs))
    if by_code:
        text = _unqualified(BASE_EXPRESSIONS["vedi_cod_cli"])
        of_order = strict_id(F.expr(text), S.CODE, T.StringType())
        of_line = strict_id(F.expr(text.replace("o_orderkey", "l_orderkey")), S.CODE, T.StringType())
        narrow = lines.repartition(of_line).join(orders, of_line == of_order)
    else:
        narrow = lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).repartition("l_orderkey", "l_linenumber")
    named = (narrow.join(table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
             .join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey")))
    return named.selectExpr(*[f"{_unqualified(e)} AS {a}" for a, e in BASE_EXPRESSIONS.items()]).withColumnsRenamed(_to_headers())


def codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The client code of each lineitem."""
    return table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias(S.CODE))


def insights(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sql(spark, INSIGHTS_SQL, sf_dir).withColumnsRenamed(
        {"sap_code": S.INSIGHTS_KEY, "cnpj": "CNPJ", "score": "Score", "flag": "Flag"})


def hot_contacts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sql(spark, HOT_CONTACTS_SQL, sf_dir).withColumnsRenamed(
        {"codigo_sap": S.CONTACTS_KEY, "podemos_atuar": S.AUTHORISED, "telefone_contato_2": S.HOT_PHONE})


def whatsapp_contacts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sql(spark, WHATSAPP_CONTACTS_SQL, sf_dir).withColumnsRenamed(
        {"codigo_sap": S.CONTACTS_KEY, "whatsapp_telefone": S.WHATSAPP_PHONE})


def registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sql(spark, REGISTRY_SQL, sf_dir)


def contacts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sql(spark, CONTACTS_SQL, sf_dir).withColumnsRenamed(
        {"hot_phone": S.HOT_PHONE, "wpp_phone": S.WHATSAPP_PHONE, "canal": S.CHANNEL,
         **{f"c{i}": str(i) for i in range(1, 11)}})


def offers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sql(spark, OFFERS_SQL, sf_dir, dealt=True).withColumnsRenamed(OFFER_HEADERS)


# --- small derived inputs of single-operator queries -------------------------

EVENTS_CONTACTS_SQL = (
    "SELECT event_id, user_id, event_type, "
    "CASE event_type WHEN 'click' THEN 'Sim' WHEN 'purchase' THEN 'Sim' WHEN 'error' THEN NULL ELSE 'Não' END "
    "AS podemos_atuar, "
    "CASE user_id % 3 WHEN 0 THEN 'WhatsApp' WHEN 1 THEN 'DIS' ELSE 'Outro' END AS canal FROM {events}"
)

CUSTOMER_ORIGIN_SQL = (
    "SELECT c_custkey, CASE c_custkey % 5 WHEN 0 THEN 'REATIVAÇÃO' WHEN 1 THEN NULL ELSE 'NOVO' END AS origem "
    "FROM {customer}"
)

CUSTOMER_ID_TEXT_SQL = (
    "SELECT c_custkey, c_acctbal, CASE WHEN c_custkey % 2 = 0 THEN CAST(c_custkey AS STRING) "
    "ELSE ' ' || CAST(c_custkey AS STRING) || ' ' END AS id_text FROM {customer}"
)

CUSTOMER_BAD_IDS_SQL = (
    "SELECT c_custkey, CASE c_custkey % 5 WHEN 0 THEN NULL WHEN 1 THEN CAST(c_custkey AS STRING) || 'x' "
    "ELSE CAST(c_custkey AS STRING) END AS code, "
    "CASE c_custkey % 3 WHEN 0 THEN '1.5' ELSE ' ' || CAST(c_custkey AS STRING) END AS company FROM {customer}"
)

DOCUMENT_TEXTS_SQL = "SELECT text, CASE WHEN doc_id % 3 = 0 THEN text || ' Ω' ELSE text END AS marked FROM {documents}"

DISTANCE_TEXT = ("CASE WHEN l_linenumber % 7 = 0 THEN 'n/d' ELSE CAST(l_partkey % 500 AS STRING) || '.' "
                 "|| LPAD(CAST((l_suppkey * 7 + l_orderkey) % 100000 AS STRING), 5, '0') END")
QUANTITY_TEXT = ("CASE WHEN l_linenumber % 3 = 0 THEN CAST(l_partkey AS STRING) || 'x' "
                 "WHEN l_linenumber % 5 = 0 THEN NULL ELSE CAST(l_partkey AS STRING) END")
LINEITEM_TEXT_SQL = (
    f"SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_quantity, "
    f"{DISTANCE_TEXT} AS dist_text, {QUANTITY_TEXT} AS qty_text FROM {{lineitem}}"
)

ADDRESS_PARTS_SQL = (
    "SELECT c.c_custkey, "
    "CASE WHEN c.c_custkey % 6 = 0 THEN NULL ELSE LPAD(CAST((c.c_custkey * 37) % 100000 AS STRING), 5, '0') END AS cep, "
    "n.n_name AS bairro, 'Rua ' || CAST(c.c_custkey % 50 AS STRING) AS rua, "
    "CASE WHEN c.c_custkey % 3 = 0 THEN NULL ELSE CAST(c.c_custkey % 1000 AS STRING) END AS num, "
    "CASE WHEN c.c_custkey % 4 = 0 THEN 'Rua ' || CAST(c.c_custkey % 50 AS STRING) ELSE NULL END AS complemento, "
    "CASE WHEN c.c_custkey % 5 = 0 THEN NULL ELSE n.n_name END AS municipio, "
    "CASE WHEN c.c_custkey % 7 = 0 THEN NULL ELSE r.r_name END AS estado "
    "FROM {customer} c JOIN {nation} n ON c.c_nationkey = n.n_nationkey JOIN {region} r ON n.n_regionkey = r.r_regionkey"
)

# Customer-level registry: a customer with an order in a month holds an id on
# the first day of that month.
CUSTOMER_RUN_DATE = "1996-01-01"
CUSTOMER_REGISTRY_SQL = (
    "SELECT DISTINCT o_custkey AS cod_sap, '960101' || LPAD(CAST(o_custkey AS STRING), 6, '0') AS id_oportunidade, "
    "CAST(date_trunc('month', o_orderdate) AS DATE) AS dt_oportunidade FROM {orders}"
)

# Landed rows with ids and prices at fault, and lines of another width.
LANDED_HEADER = "VEDI_COD_CLI,pedido,linha,Novo Preço Final Limite"
LANDED_LINES_SQL = (
    "SELECT code || ',' || CAST(l_orderkey AS STRING) || ',' || CAST(l_linenumber AS STRING) "
    "|| CASE WHEN l_orderkey % 29 = 0 THEN '' ELSE ',' || price END || CASE WHEN l_orderkey % 23 = 0 THEN ',mais' ELSE '' END AS line, "
    "code, l_orderkey, l_linenumber, price, l_orderkey % 29 = 0 AS short, l_orderkey % 23 = 0 AS long FROM ("
    "SELECT l_orderkey, l_linenumber, CASE WHEN l_partkey % 17 = 0 THEN '' WHEN l_partkey % 19 = 0 THEN CAST(l_partkey AS STRING) || 'x' "
    "ELSE CAST(l_partkey AS STRING) END AS code, CASE WHEN l_suppkey % 13 = 0 THEN 'n/d' WHEN l_suppkey % 7 = 0 THEN '' "
    "ELSE CAST(l_suppkey AS STRING) || '.25' END AS price FROM {lineitem}) x"
)

# A third of the rows has one code; that code and some others have several contacts.
HOT_CODE_ROWS_SQL = (
    "SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CASE WHEN l_orderkey % 3 = 0 THEN 1 ELSE l_orderkey END AS code FROM {lineitem}"
)
HOT_CODE_CONTACTS_SQL = (
    f"SELECT CAST(o_orderkey AS STRING) AS codigo_sap, {mobile_text('o_orderkey')} AS telefone FROM {{orders}} WHERE o_orderkey % 5 <> 0 "
    f"UNION ALL SELECT CAST(o_orderkey AS STRING), {intl_text('o_orderkey + 1')} FROM {{orders}} WHERE o_orderkey % 13 = 1 "
    f"UNION ALL SELECT 'sem codigo', {mobile_text('o_orderkey')} FROM {{orders}} WHERE o_orderkey % 97 = 0"
)

# Columns of the campaign that another split takes from the insights.
SPLIT_PREFERRED = "Cluster"
SPLIT_MOVED = ("Território", "Grupo")
SPLIT_INSIGHTS_SQL = (
    f"SELECT {listed('o_orderkey % 2 = 0')} AS sap_code, CAST(o_orderkey % 100 AS STRING) AS score, "
    "'T' || CAST(o_orderkey % 9 AS STRING) AS territorio, 'G' || CAST(o_orderkey % 4 AS STRING) AS grupo, "
    "'C' || CAST(o_orderkey % 6 AS STRING) AS cluster FROM {orders}"
)
