"""Micro-fixtures of the operators (FIXTURES.md §3, hand-derived)."""

import datetime as dt

from pyspark.sql import functions as F

from offerline import schemas as S
from offerline.operators import (
    assign_channels,
    cheapest_offer,
    fold_offers,
    issue_ids,
    message_load,
)

FOLD_SCHEMA = (
    "`Nome Cliente` string, `Grupo Cliente` string, CNPJ_BASICO bigint, VEDI_DSC_MAT string, "
    "fone_1 string, VEDI_COD_CLI bigint, `Novo Preço Final (R$/l)` double, `Novo Preço Final Limite` double, "
    "`SLA DE ENTREGA` string, VEDI_DSC_ICT string, `Dias De Prazo` string, Base string, endereco_concatenado string"
)
FOLD_ROWS = [
    ("C", "G", 100, "DIESEL", "5521999990001", 11, 5.1, 5.0, "D1", "CIF", "7", "BASE1", "A1"),
    ("C", "G", 100, "DIESEL", "5521999990002", 12, 5.1, 5.0, "D2", "FOB", "14", "BASE1", "A1"),
    ("C", "G", 100, "GASOLINA", "5521999990001", 11, 6.2, 6.0, "D1", "CIF", "7", "BASE2", "A1"),
]


def _fold(spark, rows, **kw):
    return fold_offers(spark.createDataFrame(rows, FOLD_SCHEMA), **kw).collect()


def test_fold_positional(spark):
    (r,) = _fold(spark, FOLD_ROWS, mode="positional")
    assert (r["VEDI_COD_CLI_1"], r["VEDI_COD_CLI_2"], r["VEDI_COD_CLI_3"]) == (11, 12, None)
    assert (r["fone_1_1"], r["fone_1_2"]) == ("5521999990001", "5521999990002")
    assert (r["VEDI_DSC_MAT_2"], r["Base_2"], r["SLA DE ENTREGA_2"], r["VEDI_DSC_ICT_2"], r["Dias De Prazo_2"],
            r["endereco_concatenado_2"]) == ("GASOLINA", "BASE1", "D2", "FOB", "14", None)
    assert (r["Novo Preço Final Limite_1"], r["Novo Preço Final Limite_2"]) == (5.0, 6.0)
    assert r["n_offers"] == 2


def test_fold_aligned(spark):
    (r,) = _fold(spark, FOLD_ROWS, mode="aligned")
    assert (r["VEDI_DSC_MAT_2"], r["Base_2"], r["SLA DE ENTREGA_2"], r["VEDI_DSC_ICT_2"], r["Dias De Prazo_2"],
            r["endereco_concatenado_2"]) == ("GASOLINA", "BASE2", "D1", "CIF", "7", "A1")
    assert (r["VEDI_COD_CLI_1"], r["VEDI_COD_CLI_2"]) == (11, 12)


def test_fold_null_phone_sorts_last(spark):
    rows = FOLD_ROWS + [("C", "G", 100, "DIESEL", None, 13, 5.1, 5.0, "D3", "CIF", "7", "BASE1", "A1")]
    (r,) = _fold(spark, rows, mode="positional")
    assert (r["fone_1_1"], r["fone_1_2"], r["fone_1_3"]) == ("5521999990001", "5521999990002", None)
    assert (r["VEDI_COD_CLI_1"], r["VEDI_COD_CLI_2"], r["VEDI_COD_CLI_3"]) == (11, 12, 13)


def test_message_fields(spark):
    folded = fold_offers(spark.createDataFrame(FOLD_ROWS, FOLD_SCHEMA), mode="aligned")
    (m,) = message_load(folded).collect()
    assert m["CORINGA2"] == "*GASOLINA* - A partir de *R$6.0*/litro"
    assert m["CORINGA4"] == "11 || 12"
    assert m["VALOR_DO_REGISTRO"] == 5521999990001
    assert m["n_offers"] == 2
    assert m["CORINGA5"].startswith("Oferta 1\\n Base: BASE1\\n CNPJ_RAIZ: 100\\n Produto: DIESEL\\n ")
    assert "Preço máx por litro:\\n " in m["CORINGA5"]
    assert "\n" not in m["CORINGA5"]


def test_one_code_two_products(spark):
    rows = [
        ("C", "G", 100, "DIESEL", "5521999990001", 11, 5.1, 5.0, "D1", "CIF", "7", "BASE1", "A1"),
        ("C", "G", 100, "GASOLINA", "5521999990001", 11, 6.2, 5.0, "D1", "CIF", "7", "BASE2", "A1"),
    ]
    pos = fold_offers(spark.createDataFrame(rows, FOLD_SCHEMA), mode="positional")
    (r,) = pos.collect()
    assert r["Novo Preço Final Limite_2"] is None
    (m,) = message_load(pos, mode="positional").collect()
    assert m["CORINGA2"] == "*GASOLINA* - A partir de *R$*/litro"
    assert "Oferta 2" not in m["CORINGA5"]
    (a,) = message_load(fold_offers(spark.createDataFrame(rows, FOLD_SCHEMA), mode="aligned")).collect()
    assert "Oferta 2" in a["CORINGA5"] and a["CORINGA2"] == "*GASOLINA* - A partir de *R$5.0*/litro"


def test_missing_first_phone(spark):
    rows = [
        ("C", "G", 100, "A", None, 11, 5.1, 5.0, "D1", "CIF", "7", "BASE1", "A1"),
        ("C", "G", 100, "B", "5521999990001", 11, 6.2, 6.0, "D1", "CIF", "7", "BASE2", "A1"),
    ]
    assert _fold(spark, rows, phone_policy="first") == []
    (r,) = _fold(spark, rows, phone_policy="first_valid")
    assert r["fone_1_1"] == "5521999990001"


def test_cheapest_ties_and_nulls(spark):
    df = spark.createDataFrame(
        [("G", 1, "P", "x", None, 4), ("G", 1, "P", "x", 2.0, 3), ("G", 1, "P", "x", 1.0, 2),
         ("G", 1, "P", "x", 1.0, 1), ("G", 2, "P", "x", None, 5), (None, 3, "P", "x", 1.0, 6)],
        "`Grupo Cliente` string, CNPJ_BASICO bigint, VEDI_DSC_MAT string, fone_1 string, "
        "`Novo Preço Final Limite` double, VEDI_COD_CLI bigint")
    got = cheapest_offer(df).collect()
    assert [(r.CNPJ_BASICO, r["Novo Preço Final Limite"], r.VEDI_COD_CLI) for r in got] == [(1, 1.0, 1)]


def test_channel(spark):
    df = spark.createDataFrame([("WhatsApp", "55"), ("WhatsApp", None), ("DIS", "55"), ("Outro", None)],
                               "Canal string, fone_1 string")
    got = [r.Canal for r in assign_channels(df).collect()]
    assert got == ["WhatsApp", "DIS", "DIS", "Outro"]


def test_issue_ids(spark):
    codes = spark.createDataFrame([(30,), (10,), (20,), (10,)], "cod_sap bigint")
    registry = spark.createDataFrame(
        [(20, "240425000001", dt.date(2024, 4, 25)), (10, "240424000007", dt.date(2024, 4, 24))], S.REGISTRY_SCHEMA)
    got = sorted((r.cod_sap, r.id_oportunidade, r.dt_oportunidade) for r in issue_ids(codes, registry, "2024-04-25").collect())
    assert got == [(10, "240425000002", dt.date(2024, 4, 25)), (30, "240425000003", dt.date(2024, 4, 25))]
    # small buckets give the same numbering
    got2 = sorted((r.cod_sap, r.id_oportunidade) for r in issue_ids(codes, registry, "2024-04-25", bucket_width=4).collect())
    assert got2 == [(10, "240425000002"), (30, "240425000003")]
    rerun = registry.unionByName(issue_ids(codes, registry, "2024-04-25"))
    assert issue_ids(codes, rerun, "2024-04-25").count() == 0
