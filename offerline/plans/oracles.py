"""DuckDB SQL oracles: an independent SQL formulation of every query in
``queries.py`` over the same driver tables (pre-registered views)."""

from __future__ import annotations

from offerline import schemas as S
from offerline.functions.numbers import NUMBER_PATTERN
from offerline.functions.phones import LANDLINE_PATTERN, MOBILE_PATTERN
from offerline.plans import standin

R = standin.DUCKDB_REFS


def _f(template: str) -> str:
    return template.format(**R)


# --- scalar snippets ----------------------------------------------------------

def phone(t: str, pattern: str) -> str:
    return (f"CASE WHEN regexp_matches({t}, '{pattern}') THEN '55' || "
            f"regexp_replace(regexp_extract({t}, '{pattern}', 0), '\\D', '', 'g') END")


def mobile(t: str) -> str:
    return phone(t, MOBILE_PATTERN)


def landline(t: str) -> str:
    return phone(t, LANDLINE_PATTERN)


def round4(x: str) -> str:
    return f"(round_even(({x}) * 10000.0::DOUBLE, 0) / 10000.0::DOUBLE)"


def lenient(t: str) -> str:
    return f"(CASE WHEN regexp_full_match({t}, '{NUMBER_PATTERN}') THEN TRY_CAST(trim({t}) AS DOUBLE) END)"


def num_text(x: str) -> str:
    return f"regexp_replace(CAST(CAST(({x}) AS DECIMAL(18,4)) AS VARCHAR), '(\\.\\d+?)0+$', '\\1')"


def address(parts) -> str:
    terms = []
    for k, p in enumerate(parts):
        cond = " AND ".join(f"{p} IS DISTINCT FROM {q}" for q in parts[:k])
        terms.append(f"CASE WHEN {cond} THEN {p} END" if cond else p)
    return "concat_ws(', ', " + ", ".join(terms) + ")"


def contact_text(always, optional) -> str:
    return "concat_ws(' || ', " + ", ".join([f"coalesce({a}, '')" for a in always] + list(optional)) + ")"


CONTACTS = [f"c{i}" for i in range(1, 11)]

# --- the campaign base (clean -> enrich -> phones -> 64 columns -> channel) ----

ID_ALIASES = ("vedi_cod_cli", "cnpj", "cnpj_basico", "vedi_cod_mat", "vedi_cod_bas")


def _campaign_names() -> list[str]:
    """Stand-in names of the 64 campaign columns, in campaign order."""
    out = []
    for h in S.BASE_COLUMNS:
        if h in S.CONTACT_COLUMNS:
            out.append(f"c{h}")
        else:
            out.append(S.MAILING_RENAMES[h])
    return out


CAMPAIGN_NAMES = _campaign_names()


def campaign_ctes() -> str:
    ids = ", ".join(f"CAST(trim({c}) AS BIGINT) AS {c}" for c in ID_ALIASES)
    select = []
    for c in CAMPAIGN_NAMES:
        if c in ("novo_preco_final_r_l", "novo_preco_final_limite"):
            select.append(f"{round4(c)} AS {c}")
        elif c == "fone_1":
            select.append(f"{mobile('ctext')} AS fone_1")
        elif c == "fone_2":
            select.append(f"{landline('ctext')} AS fone_2")
        else:
            select.append(c)
    select += ["score", "flag"]
    return f"""
base0 AS ({_f(standin.BASE_SQL)}),
ins AS ({_f(standin.INSIGHTS_SQL)}),
hot AS ({_f(standin.HOT_CONTACTS_SQL)}),
wpp AS ({_f(standin.WHATSAPP_CONTACTS_SQL)}),
cleaned AS (SELECT * REPLACE ({ids}, {round4(lenient('distancia'))} AS distancia) FROM base0),
enriched AS (
  SELECT b.*, i.score, i.flag, h.telefone_contato_2, w.whatsapp_telefone
  FROM cleaned b
  LEFT JOIN ins i ON b.vedi_cod_cli = TRY_CAST(i.sap_code AS BIGINT)
  LEFT JOIN (SELECT codigo_sap, telefone_contato_2 FROM hot WHERE podemos_atuar = 'Sim') h
    ON b.vedi_cod_cli = TRY_CAST(h.codigo_sap AS BIGINT)
  LEFT JOIN wpp w ON b.vedi_cod_cli = TRY_CAST(w.codigo_sap AS BIGINT)),
phoned AS (SELECT *, {contact_text(['telefone_contato_2', 'whatsapp_telefone'], CONTACTS)} AS ctext FROM enriched),
projected AS (SELECT {', '.join(select)} FROM phoned),
campaign AS (SELECT * REPLACE (CASE WHEN canal = 'WhatsApp' THEN CASE WHEN fone_1 IS NULL OR fone_1 = ''
  THEN 'DIS' ELSE 'WhatsApp' END ELSE canal END AS canal) FROM projected)"""


def cheapest_cte(src: str, names, name: str = "cheap", drop=(), tie_keys=None) -> str:
    keys = ["grupo_cliente", "cnpj_basico", "vedi_dsc_mat", "fone_1"]
    price = "novo_preco_final_limite"
    first = ["vedi_cod_cli", "nome_cliente"]
    rest = [c for c in names if c not in keys and c != price and c not in first]
    if tie_keys is not None:
        first, rest = list(tie_keys), []
    order = ", ".join(f"{c} ASC NULLS FIRST" for c in [price] + first + rest)
    keep = ", ".join(c for c in names if c not in drop)
    return (f"{name} AS (SELECT {keep} FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY {', '.join(keys)} "
            f"ORDER BY {order}) AS rn FROM {src} WHERE grupo_cliente IS NOT NULL AND cnpj_basico IS NOT NULL "
            f"AND vedi_dsc_mat IS NOT NULL AND {price} IS NOT NULL) WHERE rn = 1)")


# --- the fold -------------------------------------------------------------------

FOLD_COLUMNS = ("code", "phone", "product", "base", "address", "price", "lim", "sla", "mode", "term")
DISTINCT_LISTS = ("code", "phone", "product", "address", "price", "lim")
FULL_LISTS = ("sla", "mode", "term", "base")
K = "name, grp, company"


def fold_ctes(src: str, mode: str = "aligned", phone_policy: str = "first", n: int = 3) -> str:
    """CTEs ending in ``wide``: one row per client with {col}_{i} and n_offers."""
    ctes = [f"fr AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY {K} ORDER BY product, phone IS NULL, phone) AS ok "
            f"FROM {src})"]

    def piv(name, table, cols, where=""):
        sel = ", ".join(f"MAX(CASE WHEN pos = {i} THEN {c} END) AS {c}_{i}" for c in cols for i in range(1, n + 1))
        return f"{name} AS (SELECT {K}, {sel} FROM {table} {where} GROUP BY {K})"

    lists = DISTINCT_LISTS if mode == "positional" else ("code", "phone")
    joins = []
    for c in lists:
        skip = "WHERE phone IS NOT NULL" if (c == "phone" and phone_policy == "first_valid") else ""
        ctes.append(f"d_{c} AS (SELECT {K}, {c}, ROW_NUMBER() OVER (PARTITION BY {K} ORDER BY MIN(ok)) AS pos "
                    f"FROM fr {skip} GROUP BY {K}, {c})")
        ctes.append(piv(f"p_{c}", f"d_{c}", [c], f"WHERE pos <= {n}"))
        joins.append(f"p_{c}")
    if mode == "positional":
        ctes.append(f"fullr AS (SELECT *, ok AS pos FROM fr WHERE ok <= {n})")
        ctes.append(piv("p_full", "fullr", FULL_LISTS))
        joins.append("p_full")
    else:
        ctes.append(f"best AS (SELECT * FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY {K}, product "
                    f"ORDER BY lim ASC NULLS LAST, ok) AS rn FROM fr) WHERE rn = 1)")
        ctes.append(f"offr AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY {K} ORDER BY ok) AS pos FROM best)")
        offer_cols = [c for c in FOLD_COLUMNS if c not in ("code", "phone")]
        ctes.append(piv("p_off", "offr", offer_cols, f"WHERE pos <= {n}"))
        joins.append("p_off")
    ctes.append(f"cl AS (SELECT DISTINCT {K} FROM fr)")
    join_sql = " ".join(f"LEFT JOIN {j} USING (name, grp, company)" for j in joins)
    cols = ", ".join(f"{c}_{i}" for c in FOLD_COLUMNS for i in range(1, n + 1))
    n_offers = " + ".join(f"CAST(product_{i} IS NOT NULL AS INTEGER)" for i in range(1, n + 1))
    ctes.append(f"wide0 AS (SELECT {K}, {cols} FROM cl {join_sql})")
    ctes.append(f"wide AS (SELECT *, {n_offers} AS n_offers FROM wide0 WHERE phone_1 IS NOT NULL)")
    return ",\n".join(ctes)


# --- message load ---------------------------------------------------------------

def offer_block(i: int, mode: str) -> str:
    present = f"product_{i} IS NOT NULL"
    if mode == "positional" and i > 1:
        present += f" AND code_{i} IS NOT NULL"
    fields = {
        "base": f"base_{i}", "company": "CAST(company AS VARCHAR)", "product": f"product_{i}",
        "price": num_text(f"price_{i}"), "limit": num_text(f"lim_{i}"), "mode": f"mode_{i}",
        "term": f"term_{i}", "sla": f"sla_{i}", "address": f"address_{i}",
    }
    from offerline.functions.text import OFFER_LINES

    parts = []
    for label, key in OFFER_LINES:
        parts.append("'" + label.format(i=i).replace("'", "''") + "'")
        if key is not None:
            parts.append(f"coalesce({fields[key]}, '')")
        parts.append("chr(10)")
    return f"CASE WHEN {present} THEN {' || '.join(parts)} END"


def message_select(mode: str, keys: bool = False) -> str:
    def field(i):
        return (f"CASE WHEN product_{i} IS NOT NULL THEN '*' || product_{i} || '* - A partir de *R$' || "
                f"coalesce({num_text(f'lim_{i}')}, '') || '*/litro' END")
    cols = []
    if keys:
        cols += ["name", "grp", "company"]
    cols += ["'TELEFONE' AS TIPO_DE_REGISTRO", "CAST(phone_1 AS BIGINT) AS VALOR_DO_REGISTRO"]
    cols += [f"'' AS {c}" for c in ("MENSAGEM", "NOME_CLIENTE", "CPFCNPJ", "CODCLIENTE", "TAG")]
    cols += [f"{field(i)} AS CORINGA{i}" for i in (1, 2, 3)]
    cols.append("concat_ws(' || ', CAST(code_1 AS VARCHAR), CAST(code_2 AS VARCHAR), CAST(code_3 AS VARCHAR)) AS CORINGA4")
    blocks = ", ".join(offer_block(i, mode) for i in (1, 2, 3))
    cols.append(f"replace(concat_ws('', {blocks}), chr(10), '\\n ') AS CORINGA5")
    cols.append("'ALTA' AS PRIORIDADE")
    return ", ".join(cols)


BUCKET = ("CASE WHEN CORINGA1 IS NOT NULL AND CORINGA2 IS NULL AND CORINGA3 IS NULL THEN 1 "
          "WHEN CORINGA1 IS NOT NULL AND CORINGA2 IS NOT NULL AND CORINGA3 IS NULL THEN 2 "
          "WHEN CORINGA1 IS NOT NULL AND CORINGA2 IS NOT NULL AND CORINGA3 IS NOT NULL THEN 3 END")

OFFER_SRC = ("SELECT nome_cliente AS name, grupo_cliente AS grp, cnpj_basico AS company, vedi_cod_cli AS code, "
             "fone_1 AS phone, vedi_dsc_mat AS product, {addr} AS address, novo_preco_final_r_l AS price, "
             "novo_preco_final_limite AS lim, sla_de_entrega AS sla, vedi_dsc_ict AS mode, dias_de_prazo AS term, "
             "base FROM {src}")

ADDRESS_PARTS = ("cep", "bairro", "rua", "num", "complemento", "clie_nom_municipio", "clie_nom_estado")


MESSAGE_TIE_KEYS = ("vedi_cod_cli", "nome_cliente", "novo_preco_final_r_l", "sla_de_entrega", "vedi_dsc_ict",
                    "dias_de_prazo", "base", "endereco")


def message_load_sql(mode: str = "aligned") -> str:
    src = OFFER_SRC.format(addr="endereco", src="cheap")
    addressed = f"addressed AS (SELECT *, {address(ADDRESS_PARTS)} AS endereco FROM campaign)"
    return (f"WITH {campaign_ctes()},\n{addressed},\n"
            f"{cheapest_cte('addressed', CAMPAIGN_NAMES + ['endereco'], drop=CONTACTS, tie_keys=MESSAGE_TIE_KEYS)},\n"
            f"src AS (SELECT * FROM ({src}) WHERE name IS NOT NULL AND grp IS NOT NULL AND company IS NOT NULL),\n{fold_ctes('src', mode)},\n"
            f"msg AS (SELECT {message_select(mode)} FROM wide)\n")


OFFER_NAMES = list(standin.OFFER_EXPRESSIONS)
OFFERS_CTE = (f"offers AS (SELECT * REPLACE ({round4('novo_preco_final_r_l')} AS novo_preco_final_r_l, "
              f"{round4('novo_preco_final_limite')} AS novo_preco_final_limite) FROM ({_f(standin.OFFERS_SQL)}))")


def narrow_fold_sql(mode: str = "aligned", phone_policy: str = "first") -> str:
    src = OFFER_SRC.format(addr="endereco_concatenado", src="cheap")
    return (f"WITH {OFFERS_CTE},\n{cheapest_cte('offers', OFFER_NAMES)},\n"
            f"src AS ({src}),\n{fold_ctes('src', mode, phone_policy)}\n")


def conformed_select(src: str) -> str:
    out = []
    for h in S.BASE_COLUMNS:
        name = S.MAILING_RENAMES[h]
        col = f"c{h}" if h in S.CONTACT_COLUMNS else name
        if name in S.MAILING_DOUBLE_COLUMNS:
            out.append(f"CAST({col} AS DOUBLE) AS \"{name}\"")
        elif name in S.MAILING_DATE_COLUMNS:
            out.append(f"strftime({col}, '%Y-%m-%d') AS \"{name}\"")
        else:
            out.append(f"CAST({col} AS VARCHAR) AS \"{name}\"")
    out += ["score", "flag"]
    return ", ".join(out)


def _display(c: str, fmt: str) -> str:
    if fmt == "dd/mm/yyyy":
        return f"strftime({c}, '%d/%m/%Y')"
    if fmt == "0":
        return f"CAST(CAST({c} AS BIGINT) AS VARCHAR)"
    return f"printf('%.4f', {c})"


def board_loads_sql() -> str:
    fmt = {S.MAILING_RENAMES[h]: f for h, f in S.DISPLAY_FORMATS.items()}
    names = CAMPAIGN_NAMES
    dis = ", ".join("coalesce(fone_2, c10) AS c10" if c == "c10" else c for c in names)
    wpp = ", ".join("coalesce(fone_1, c10) AS c10" if c == "c10" else c for c in names)
    plain = ", ".join(names)
    out = []
    for c in names:
        alias = c[1:] if c in CONTACTS else c
        expr = _display(c, fmt[c]) if c in fmt else c
        out.append(f"{expr} AS \"{alias}\"")
    return (f"WITH {campaign_ctes()},\nloads AS (SELECT DISTINCT * FROM ("
            f"SELECT {dis}, 'dis' AS load FROM campaign WHERE canal = 'DIS' UNION ALL "
            f"SELECT {wpp}, 'wpp' AS load FROM campaign UNION ALL "
            f"SELECT {plain}, 'todo' AS load FROM campaign))\n"
            f"SELECT {', '.join(out)}, load FROM loads")


def _ids_sql(codes: str, registry: str, day: str, prefix: str) -> str:
    """New ids for the distinct ``codes`` (column cod_sap) against ``registry``."""
    return f"""
reg_day AS (SELECT * FROM ({registry}) WHERE dt_oportunidade = DATE '{day}'),
start AS (SELECT coalesce(max(CAST(substr(id_oportunidade, 7) AS BIGINT)), 0) AS s FROM reg_day),
fresh AS (SELECT DISTINCT cod_sap FROM ({codes}) WHERE cod_sap IS NOT NULL
          AND cod_sap NOT IN (SELECT cod_sap FROM reg_day)),
ids AS (SELECT cod_sap, '{prefix}' || printf('%06d', (SELECT s FROM start) + ROW_NUMBER() OVER (ORDER BY cod_sap))
        AS id_oportunidade, '{day}' AS dt_oportunidade FROM fresh)"""


# --- the oracle texts -------------------------------------------------------------

def oracle_sql() -> dict[str, str]:
    q: dict[str, str] = {}
    ev = _f(standin.EVENTS_CONTACTS_SQL)
    q["authorised_filter"] = (
        f"WITH ev AS ({ev}) SELECT event_id, 'DIS' AS split FROM ev WHERE podemos_atuar = 'Sim' AND canal = 'DIS' "
        f"UNION ALL SELECT event_id, 'WhatsApp' FROM ev WHERE podemos_atuar = 'Sim' AND canal = 'WhatsApp'")
    q["exclude_origin"] = (f"SELECT * FROM ({_f(standin.CUSTOMER_ORIGIN_SQL)}) "
                           f"WHERE origem IS DISTINCT FROM 'REATIVAÇÃO'")
    q["strict_ids"] = (
        f"SELECT c_custkey, CAST(trim(id_text) AS BIGINT) AS code, CAST(CAST(trim(id_text) AS BIGINT) AS VARCHAR) "
        f"AS code_text, CAST(trunc(c_acctbal) AS BIGINT) AS acct_int FROM ({_f(standin.CUSTOMER_ID_TEXT_SQL)})")
    q["serial_dates"] = (
        "WITH s AS (SELECT o_orderkey, CAST(date_diff('day', DATE '1899-12-30', CAST(o_orderdate AS DATE)) AS DOUBLE) "
        "+ (o_orderkey % 4) * 0.25::DOUBLE AS serial FROM orders) "
        "SELECT o_orderkey, serial, strftime(DATE '1899-12-30' + CAST(floor(serial) AS INTEGER), '%Y-%m-%d') AS sale_date, "
        "strftime(TIMESTAMP '1899-12-30 00:00:00' + to_microseconds(CAST(serial * 86400000000 AS BIGINT)), "
        "'%Y-%m-%d %H:%M:%S') AS sale_ts FROM s")
    lt = _f(standin.LINEITEM_TEXT_SQL)
    q["coerce_round"] = (
        f"SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, dist_text, {round4(lenient('dist_text'))} AS distance, "
        f"{round4('l_extendedprice / l_quantity')} AS unit_price FROM ({lt})")
    bad = "{c} IS NOT NULL AND NOT regexp_full_match({c}, '" + NUMBER_PATTERN + "')"
    q["invalid_number_profile"] = (
        f"WITH t AS ({lt}), s AS (SELECT 'dist_text' AS column_name, dist_text AS value FROM t WHERE "
        f"{bad.format(c='dist_text')} UNION ALL SELECT 'qty_text', qty_text FROM t WHERE {bad.format(c='qty_text')}) "
        "SELECT column_name, count(*) AS n_invalid, min(value) AS example_min, max(value) AS example_max "
        "FROM s GROUP BY column_name")
    q["nonnull_profile"] = (
        "SELECT count(c_custkey) AS c_custkey, count(c_name) AS c_name, count(c_acctbal) AS c_acctbal, "
        "count(o_orderkey) AS o_orderkey, count(o_totalprice) AS o_totalprice, count(o_orderdate) AS o_orderdate "
        "FROM customer c LEFT JOIN (SELECT * FROM orders WHERE o_orderpriority = '1-URGENT') o "
        "ON c.c_custkey = o.o_custkey")
    q["enrich_left"] = (
        "SELECT c.c_custkey, c.c_name, o.o_orderkey, o.o_totalprice, n.n_name FROM customer c "
        "LEFT JOIN (SELECT * FROM orders WHERE o_orderpriority = '1-URGENT') o ON c.c_custkey = o.o_custkey "
        "LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey")
    q["collision_suffix"] = (
        "SELECT p.p_partkey AS key, p.p_name AS name_x, p.p_retailprice AS price_x, s.s_name AS name_y, "
        "s.s_acctbal AS price_y FROM part p LEFT JOIN supplier s ON p.p_partkey = s.s_suppkey")
    q["stack_bases"] = (
        "SELECT c_custkey AS key, c_name AS name, c_nationkey AS nationkey, c_acctbal AS acctbal, "
        "c_mktsegment AS mktsegment FROM customer UNION ALL "
        "SELECT s_suppkey, s_name, s_nationkey, s_acctbal, NULL FROM supplier")
    q["fill_from_group"] = (
        "WITH t AS (SELECT *, CASE WHEN l_linenumber % 3 <> 0 THEN l_quantity END AS qty, "
        "CASE WHEN l_orderkey % 4 <> 0 THEN l_returnflag END AS flag FROM lineitem), "
        "o AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY l_partkey ORDER BY l_orderkey, l_linenumber, l_suppkey, "
        "l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate) AS pos FROM t), "
        "fq AS (SELECT l_partkey, qty AS fqty FROM (SELECT l_partkey, qty, ROW_NUMBER() OVER (PARTITION BY l_partkey "
        "ORDER BY pos) AS r FROM o WHERE qty IS NOT NULL) WHERE r = 1), "
        "ff AS (SELECT l_partkey, flag AS fflag FROM (SELECT l_partkey, flag, ROW_NUMBER() OVER (PARTITION BY l_partkey "
        "ORDER BY pos) AS r FROM o WHERE flag IS NOT NULL) WHERE r = 1) "
        "SELECT t.l_orderkey, t.l_partkey, t.l_linenumber, t.l_suppkey, coalesce(t.qty, fq.fqty) AS qty, "
        "coalesce(t.flag, ff.fflag) AS flag FROM t LEFT JOIN fq ON t.l_partkey = fq.l_partkey "
        "LEFT JOIN ff ON t.l_partkey = ff.l_partkey")

    ct = f"WITH k AS (SELECT *, {contact_text(['hot_phone', 'wpp_phone'], CONTACTS)} AS t FROM ({_f(standin.CONTACTS_SQL)})) "
    q["contact_text"] = ct + "SELECT code, t AS contact_text FROM k"
    q["phones_synthetic"] = ct + f"SELECT code, {mobile('t')} AS mobile, {landline('t')} AS landline FROM k"
    q["phones_documents"] = f"SELECT doc_id, {mobile('text')} AS mobile, {landline('text')} AS landline FROM documents"
    q["assign_channel"] = ct + (
        f", m AS (SELECT code, canal, {mobile('t')} AS f1 FROM k) SELECT code, canal AS canal_in, "
        "CASE WHEN canal = 'WhatsApp' THEN CASE WHEN f1 IS NULL OR f1 = '' THEN 'DIS' ELSE 'WhatsApp' END "
        "ELSE canal END AS canal FROM m")
    older = r"(?:\+?55)? ?(?:\(?([1-9]{2})\)? ?)?(?:9[6-9])\d{3}[- ]?\d{4}"
    q["phones_older_pattern"] = ct + f"SELECT code, {phone('t', older)} AS mobile FROM k"
    q["contact_text_separator"] = (
        "SELECT code, concat_ws('__', coalesce(hot_phone, ''), coalesce(wpp_phone, ''), c1, c2, c3, c4, c5, c6, c7, c8, c9, c10) "
        f"AS contact_text FROM ({_f(standin.CONTACTS_SQL)})")
    q["channel_from_mobile"] = ct + (
        f"SELECT code, canal AS canal_in, CASE WHEN {mobile('t')} IS NOT NULL THEN 'WhatsApp' ELSE canal END AS canal FROM k")
    q["load_timestamp"] = ("SELECT o_orderkey, strftime(TIMESTAMP '2024-04-25 12:00:00' - INTERVAL 3 HOUR, '%Y-%m-%d %H:%M:%S') "
                           "AS ts_carga FROM orders")
    q["placeholder_id"] = "SELECT 0 AS id_oportunidade, o_orderkey, o_custkey FROM orders"
    no_id = "({c} IS NULL OR NOT regexp_full_match({c}, '\\s*[+-]?[0-9]+\\s*'))"
    q["reject_ids"] = (
        "SELECT *, NULLIF(concat_ws(',', " + ", ".join(f"CASE WHEN {no_id.format(c=c)} THEN '{c}' END" for c in ("code", "company"))
        + f"), '') AS reject_reason FROM ({_f(standin.CUSTOMER_BAD_IDS_SQL)})")
    lost = "[^\\x{0000}-\\x{007F}\\x{00A0}-\\x{00FF}€‚ƒ„…†‡ˆ‰Š‹ŒŽ‘’“”•–—˜™š›œžŸ]"
    q["encoding_loss"] = ("SELECT " + ", ".join(f"count(*) FILTER (WHERE regexp_matches({c}, '{lost}')) AS {c}" for c in ("text", "marked"))
                          + f" FROM ({_f(standin.DOCUMENT_TEXTS_SQL)})")
    q["overwrite_contact"] = ct + (
        f"SELECT code, 'dis' AS load, coalesce({landline('t')}, c10) AS contact_10 FROM k UNION ALL "
        f"SELECT code, 'wpp', coalesce({mobile('t')}, c10) FROM k")

    out_cols = [c for c in OFFER_NAMES if c != "l_shipdate"]
    q["cheapest_offer"] = (f"WITH {OFFERS_CTE},\n{cheapest_cte('offers', OFFER_NAMES)}\n"
                           f"SELECT {', '.join(out_cols)} FROM cheap")
    parts = ["cep", "bairro", "rua", "num", "complemento", "municipio", "estado"]
    q["address_text"] = f"SELECT c_custkey, {address(parts)} AS address FROM ({_f(standin.ADDRESS_PARTS_SQL)})"

    def list_text(c, dbl):
        items = [num_text(f"{c}_{i}") if dbl else f"CAST({c}_{i} AS VARCHAR)" for i in (1, 2, 3)]
        return f"concat_ws(' || ', {', '.join(items)}) AS {c}_list"
    lists = ", ".join(list_text(c, c in ("price", "lim")) for c in
                      ("code", "phone", "product", "address", "price", "lim", "sla", "mode", "term", "base"))
    q["client_lists"] = narrow_fold_sql("positional") + f"SELECT name, grp, company, {lists} FROM wide"
    q["offers_wide"] = narrow_fold_sql("aligned") + "SELECT * FROM wide"
    q["offers_wide_positional"] = narrow_fold_sql("positional") + "SELECT * FROM wide"
    q["offers_wide_first_valid"] = narrow_fold_sql("aligned", "first_valid") + "SELECT * FROM wide"
    q["offer_text"] = narrow_fold_sql("aligned") + (
        f", m AS (SELECT {message_select('aligned', keys=True)} FROM wide) SELECT name, grp, company, CORINGA5 FROM m")
    q["message_fields"] = narrow_fold_sql("positional") + (
        f", m AS (SELECT {message_select('positional', keys=True)} FROM wide) SELECT name, grp, company, "
        "VALOR_DO_REGISTRO, CORINGA1, CORINGA2, CORINGA3, CORINGA4, CORINGA5 FROM m")

    q["message_load"] = message_load_sql() + f"SELECT *, {BUCKET} AS n_offers FROM msg"
    q["offer_buckets"] = message_load_sql() + (
        f", b AS (SELECT {BUCKET} AS n_offers FROM msg) SELECT CAST(n_offers AS BIGINT) AS n_offers, "
        "count(*) AS n_rows FROM b WHERE n_offers IS NOT NULL GROUP BY n_offers")
    q["csv_round_trip"] = message_load_sql() + (
        f", b AS (SELECT *, {BUCKET} AS n_offers FROM msg) SELECT TIPO_DE_REGISTRO, VALOR_DO_REGISTRO, "
        "NULLIF(MENSAGEM, '') AS MENSAGEM, NULLIF(NOME_CLIENTE, '') AS NOME_CLIENTE, NULLIF(CPFCNPJ, '') AS CPFCNPJ, "
        "NULLIF(CODCLIENTE, '') AS CODCLIENTE, NULLIF(TAG, '') AS TAG, CORINGA1, CORINGA2, CORINGA3, "
        "NULLIF(CORINGA4, '') AS CORINGA4, NULLIF(CORINGA5, '') AS CORINGA5, PRIORIDADE, "
        f"CAST(n_offers AS BIGINT) AS n_offers, '{standin.RUN_DATE}' AS run_date FROM b WHERE n_offers IS NOT NULL")
    q["dedupe_rows"] = "SELECT DISTINCT l_partkey, l_returnflag, l_linestatus, l_quantity FROM lineitem"
    q["display_formats"] = (
        "SELECT o_orderkey, printf('%.4f', o_totalprice) AS total_4, CAST(o_custkey AS VARCHAR) AS cust_0, "
        "strftime(CAST(o_orderdate AS DATE), '%d/%m/%Y') AS date_br, strftime(o_orderdate, '%y%m%d') AS yymmdd, "
        "printf('%.4f', o_totalprice / 7) AS ratio_4 FROM orders")
    q["conform_schema"] = f"WITH {campaign_ctes()}\nSELECT {conformed_select('campaign')} FROM campaign"
    q["board_loads"] = board_loads_sql()

    creg = _f(standin.CUSTOMER_REGISTRY_SQL)
    cday = standin.CUSTOMER_RUN_DATE
    q["new_codes"] = (f"WITH reg_day AS (SELECT * FROM ({creg}) WHERE dt_oportunidade = DATE '{cday}') "
                      "SELECT DISTINCT c_custkey AS cod_sap FROM customer WHERE c_custkey NOT IN (SELECT cod_sap FROM reg_day)")
    q["issue_ids"] = ("WITH " + _ids_sql("SELECT c_custkey AS cod_sap FROM customer", creg, cday, "960101").lstrip()
                      + " SELECT * FROM ids")
    q["attach_ids"] = (
        f"WITH reg_day AS (SELECT * FROM ({creg}) WHERE dt_oportunidade = DATE '{cday}') "
        "SELECT o.o_orderkey, CAST(o.o_custkey AS VARCHAR) AS vedi_cod_cli, r.id_oportunidade, "
        f"'{cday}' AS dt_mailing FROM orders o LEFT JOIN reg_day r ON o.o_custkey = r.cod_sap")
    reg = _f(standin.REGISTRY_SQL)
    run = standin.RUN_DATE
    q["ids_job"] = (f"WITH {campaign_ctes()},\n"
                    + _ids_sql("SELECT vedi_cod_cli AS cod_sap FROM campaign", reg, run, "240425").lstrip()
                    + " SELECT * FROM ids")
    q["mailing_table"] = (
        f"WITH {campaign_ctes()},\nconf AS (SELECT DISTINCT {conformed_select('campaign')} FROM campaign),\n"
        f"reg_day AS (SELECT * FROM ({reg}) WHERE dt_oportunidade = DATE '{run}')\n"
        f"SELECT c.*, r.id_oportunidade, '{run}' AS dt_mailing FROM conf c LEFT JOIN reg_day r "
        "ON TRY_CAST(c.vedi_cod_cli AS BIGINT) = r.cod_sap")
    q["registry_two_runs"] = (
        "SELECT c_custkey AS cod_sap, '240424' || printf('%06d', ROW_NUMBER() OVER (ORDER BY c_custkey)) "
        "AS id_oportunidade, '2024-04-24' AS dt_oportunidade FROM customer UNION ALL "
        "SELECT c_custkey + 500, '240425' || printf('%06d', ROW_NUMBER() OVER (ORDER BY c_custkey)), '2024-04-25' FROM customer")
    q["csv_landing"] = q["conform_schema"]
    q["board_loads_written"] = (
        f"SELECT load, count(*) AS n_rows, count(DISTINCT vedi_cod_cli) AS n_codes, count(\"10\") AS n_contact_10, "
        f"count(DISTINCT \"10\") AS n_contacts, min(novo_preco_final_r_l) AS min_price_text, max(vedi_dat_ven) AS max_date_text, "
        f"count(novo_preco_final_limite) AS n_limit_prices, '{run}' AS run_date FROM ({board_loads_sql()}) GROUP BY load")
    q["campaign_rejects"] = f"""
WITH cells AS (SELECT *, CASE WHEN short AND long THEN 'mais' WHEN short THEN NULL ELSE NULLIF(price, '') END AS price_text,
  short <> long AS other_width, code = '' OR code LIKE '%x' AS no_id FROM ({_f(standin.LANDED_LINES_SQL)})),
checked AS (SELECT *, NULLIF(concat_ws('; ', CASE WHEN other_width THEN 'width' END,
  CASE WHEN price_text IS NOT NULL AND TRY_CAST(price_text AS DOUBLE) IS NULL THEN 'value: Novo Preço Final Limite' END,
  CASE WHEN no_id THEN 'id: VEDI_COD_CLI' END), '') AS reasons FROM cells)
SELECT CASE WHEN reasons IS NULL THEN l_orderkey END AS order_key, CASE WHEN reasons IS NULL THEN l_linenumber END AS line_number,
  CASE WHEN reasons IS NULL THEN TRY_CAST(code AS BIGINT) END AS code, CASE WHEN reasons IS NULL THEN TRY_CAST(price_text AS DOUBLE) END AS price,
  CASE WHEN reasons IS NOT NULL THEN line END AS record, reasons FROM checked"""
    counted = ", ".join(f'count({n}) AS "present: {n[1:] if n in CONTACTS else n}"' for n in [*CAMPAIGN_NAMES, "score", "flag"])
    q["run_report"] = f"""
WITH {campaign_ctes()},
counted AS (SELECT count(*) AS "rows", count(*) FILTER (WHERE canal = 'DIS') AS dis_rows,
  count(*) FILTER (WHERE canal = 'WhatsApp') AS whatsapp_rows, 1::BIGINT AS finished, {counted} FROM campaign),
groups AS (SELECT max(novo_preco_final_limite) AS price FROM campaign
  WHERE grupo_cliente IS NOT NULL AND cnpj_basico IS NOT NULL AND vedi_dsc_mat IS NOT NULL
  GROUP BY grupo_cliente, cnpj_basico, vedi_dsc_mat, fone_1)
SELECT 'campaign' AS stage, metric, value FROM (UNPIVOT counted ON COLUMNS(*) INTO NAME metric VALUE value)
UNION ALL SELECT 'offers', 'offer_groups', count(*) FROM groups
UNION ALL SELECT 'offers', 'groups_without_price', count(*) FROM groups WHERE price IS NULL
UNION ALL SELECT 'offers', 'finished', 1"""
    q["enrich_hot_code"] = (
        f"SELECT r.*, c.telefone FROM ({_f(standin.HOT_CODE_ROWS_SQL)}) r LEFT JOIN ({_f(standin.HOT_CODE_CONTACTS_SQL)}) c "
        "ON r.code = TRY_CAST(c.codigo_sap AS BIGINT)")
    q["campaign_column_split"] = (
        f"WITH {campaign_ctes()}\nSELECT vedi_cod_cli AS code, vedi_cod_mat AS material, vedi_cod_bas AS base_code, s.territorio, s.grupo, "
        f"s.cluster, segmento, s.score, fone_1 FROM campaign c LEFT JOIN ({_f(standin.SPLIT_INSIGHTS_SQL)}) s "
        "ON c.vedi_cod_cli = TRY_CAST(s.sap_code AS BIGINT)")
    q["mailing_two_days"] = (
        "SELECT o_orderkey, o_custkey, '2024-04-24' AS dt_mailing FROM orders UNION ALL "
        "SELECT o_orderkey, o_custkey + 2, '2024-04-25' FROM orders")
    strict = {}
    for kind, pattern in (("mobile", MOBILE_PATTERN), ("landline", LANDLINE_PATTERN)):
        bounded = "(^|[^0-9])(" + "(" + pattern[3:] + ")([^0-9]|$)"
        match = f"regexp_extract(text, '{bounded}', 2)"
        country = f"regexp_extract(text, '{bounded}', 3)"
        digits = f"regexp_replace({match}, '\\D', '', 'g')"
        strict[kind] = (f"CASE WHEN regexp_matches(text, '{bounded}') THEN CASE WHEN {country} <> '' THEN {digits} "
                        f"ELSE '55' || {digits} END END")
    q["phones_strict"] = f"SELECT doc_id, {strict['mobile']} AS mobile, {strict['landline']} AS landline FROM documents"
    q["null_columns"] = (
        "SELECT bool_or(c_custkey IS NULL) AS c_custkey, bool_or(c_name IS NULL) AS c_name, "
        "bool_or(c_acctbal IS NULL) AS c_acctbal, bool_or(o_orderkey IS NULL) AS o_orderkey, "
        "bool_or(o_totalprice IS NULL) AS o_totalprice, bool_or(o_orderdate IS NULL) AS o_orderdate "
        "FROM customer c LEFT JOIN (SELECT * FROM orders WHERE o_orderpriority = '1-URGENT') o "
        "ON c.c_custkey = o.o_custkey")
    q["duplicate_contacts"] = (f"SELECT codigo_sap, count(*) AS n_rows FROM ({_f(standin.HOT_CONTACTS_SQL)}) "
                               "GROUP BY codigo_sap HAVING count(*) > 1")
    return q
