"""Column sets, rename maps, output types and display formats.

Everything here is a fixed value of the campaign-load format: the business
headers of the priced customer base, the snake_case names of the published
mailing table, and the types that table is written with.
"""

from __future__ import annotations

from pyspark.sql import types as T

# --- Fixed values: headers of the priced customer base -----------------------
CLIENT_NAME = "Nome Cliente"
CLIENT_GROUP = "Grupo Cliente"
COMPANY = "CNPJ_BASICO"
CODE = "VEDI_COD_CLI"
PRODUCT = "VEDI_DSC_MAT"
PRICE = "Novo Preço Final (R$/l)"
LIMIT_PRICE = "Novo Preço Final Limite"
SLA = "SLA DE ENTREGA"
DELIVERY_MODE = "VEDI_DSC_ICT"
TERM = "Dias De Prazo"
BASE = "Base"
CHANNEL = "Canal"
SALE_DATE = "VEDI_DAT_VEN"
DISTANCE = "Distância"
HOT_PHONE = "TELEFONE CONTATO 2"
WHATSAPP_PHONE = "WhatsApp Telefone"
AUTHORISED = "PODEMOS ATUAR?"
INSIGHTS_KEY = "Sap Code"
CONTACTS_KEY = "Código SAP"
MOBILE = "fone_1"
LANDLINE = "fone_2"
ADDRESS = "endereco_concatenado"
CONTACT_TEXT = "contatos_concatenados"

# Integer id columns of the base (strict casts).
ID_COLUMNS = ("CNPJ", "VEDI_COD_CLI", "CNPJ_BASICO", "VEDI_COD_MAT", "VEDI_COD_BAS")

# Free-text contact columns of the base.
CONTACT_COLUMNS = tuple(str(i) for i in range(1, 11))

# Address parts, in the order they are joined.
ADDRESS_COLUMNS = ("CEP", "BAIRRO", "RUA", "NUM", "COMPLEMENTO", "CLIE_NOM_MUNICIPIO", "CLIE_NOM_ESTADO")

# Client grain and offer grain.
CLIENT_KEYS = (CLIENT_NAME, CLIENT_GROUP, COMPANY)
OFFER_KEYS = (CLIENT_GROUP, COMPANY, PRODUCT, MOBILE)

# The 64-column campaign base, in order (after the join suffix
# of the company number is resolved and the phones are named fone_1/fone_2).
BASE_COLUMNS = (
    "Nome Cliente", "Grupo Cliente", "AECO", "Segmento", "LBR Médio Mensal",
    "Volume Médio Mensal", "ZV_BR", "TITULAR", "H_N3", "H_N2", "Canal Fonte",
    "VEDI_COD_CLI", "CLIE_NOM_MUNICIPIO", "CLIE_NOM_ESTADO", "CNPJ_BASICO", "CEP",
    "BAIRRO", "RUA", "NUM", "COMPLEMENTO", "VEDI_COD_MAT", "VEDI_DSC_MAT",
    "VEDI_DAT_VEN", "VEDI_VOL", "VEDI_DSC_ICT", "Produto_D", "VEDI_COD_BAS", "Base",
    "Lista de Preço", "Exposição Total", "% Exposição", "Limite de credito",
    "Limite de Crédito", "Distância", "Market", "SLA DE ENTREGA",
    "1", "2", "3", "4", "5", "6", "7", "8", "9", "10",
    "Novo Preço Final (R$/l)", "Dias De Prazo", "GRUPO_CNPJ_BASICO",
    "Novo Preço Final Limite", "CNPJ", "fone_1", "fone_2", "flag_mkt", "Fonte",
    "Território", "Grupo", "Cluster", "Terça Feira - 16/04", "Quarta Feira - 17/04",
    "Quinta Feira - 18/04", "Sexta Feira - 19/04", "Segunda Feira - 22/04", "Canal",
)

# The five weekday headers of the campaign week. They are dated,
# so a new week passes its own headers (``weekday_headers``) to the jobs.
WEEKDAY_COLUMNS = (
    "Terça Feira - 16/04", "Quarta Feira - 17/04", "Quinta Feira - 18/04",
    "Sexta Feira - 19/04", "Segunda Feira - 22/04",
)

# Header -> table column name of the published mailing table.
MAILING_RENAMES = {
    "Nome Cliente": "nome_cliente",
    "Grupo Cliente": "grupo_cliente",
    "AECO": "aeco",
    "Segmento": "segmento",
    "LBR Médio Mensal": "lbr_medio_mensal",
    "Volume Médio Mensal": "volume_medio_mensal",
    "ZV_BR": "zv_br",
    "TITULAR": "titular",
    "H_N3": "h_n3",
    "H_N2": "h_n2",
    "Canal Fonte": "canal_fonte",
    "VEDI_COD_CLI": "vedi_cod_cli",
    "CLIE_NOM_MUNICIPIO": "clie_nom_municipio",
    "CLIE_NOM_ESTADO": "clie_nom_estado",
    "CNPJ_BASICO": "cnpj_basico",
    "CEP": "cep",
    "BAIRRO": "bairro",
    "RUA": "rua",
    "NUM": "num",
    "COMPLEMENTO": "complemento",
    "VEDI_COD_MAT": "vedi_cod_mat",
    "VEDI_DSC_MAT": "vedi_dsc_mat",
    "VEDI_DAT_VEN": "vedi_dat_ven",
    "VEDI_VOL": "vedi_vol",
    "VEDI_DSC_ICT": "vedi_dsc_ict",
    "Produto_D": "produto_d",
    "VEDI_COD_BAS": "vedi_cod_bas",
    "Base": "base",
    "Lista de Preço": "lista_de_preco",
    "Exposição Total": "exposicao_total",
    "% Exposição": "exposicao",
    "Limite de credito": "limite_de_credito",
    "Limite de Crédito": "limite_de_credito_2",
    "Distância": "distancia",
    "Market": "market",
    "SLA DE ENTREGA": "sla_de_entrega",
    "1": "1",
    "2": "2",
    "3": "3",
    "4": "4",
    "5": "5",
    "6": "6",
    "7": "7",
    "8": "8",
    "9": "9",
    "10": "10",
    "Novo Preço Final (R$/l)": "novo_preco_final_r_l",
    "Dias De Prazo": "dias_de_prazo",
    "GRUPO_CNPJ_BASICO": "grupo_cnpj_basico",
    "Novo Preço Final Limite": "novo_preco_final_limite",
    "CNPJ": "cnpj",
    "fone_1": "fone_1",
    "fone_2": "fone_2",
    "flag_mkt": "flag_mkt",
    "Fonte": "fonte",
    "Território": "territorio",
    "Grupo": "grupo",
    "Cluster": "cluster",
    "Terça Feira - 16/04": "terca_feira_16_04",
    "Quarta Feira - 17/04": "quarta_feira_17_04",
    "Quinta Feira - 18/04": "quinta_feira_18_04",
    "Sexta Feira - 19/04": "sexta_feira_19_04",
    "Segunda Feira - 22/04": "segunda_feira_22_04",
    "Canal": "canal",
    "Score": "score",
    "Flag": "flag",
}

# The six double columns of the mailing table; every other of the
# 66 columns is a string, except vedi_dat_ven, which is published as a date.
MAILING_DOUBLE_COLUMNS = (
    "lbr_medio_mensal", "volume_medio_mensal", "vedi_vol", "distancia",
    "novo_preco_final_r_l", "novo_preco_final_limite",
)
MAILING_DATE_COLUMNS = ("vedi_dat_ven",)

# Columns created empty when the insights file lacks them.
OPTIONAL_COLUMNS = ("Flag", "Score")

# Display formats of the board loads (number format per column).
DISPLAY_FORMATS = {
    "Novo Preço Final Limite": "0.0000",
    "Novo Preço Final (R$/l)": "0.0000",
    "CNPJ": "0",
    "LBR Médio Mensal": "0.0000",
    "VEDI_COD_CLI": "0",
    "CNPJ_BASICO": "0",
    "VEDI_COD_MAT": "0",
    "VEDI_DAT_VEN": "dd/mm/yyyy",
    "VEDI_COD_BAS": "0",
    "Distância": "0.0000",
}

# The 13 columns of the message load, in order.
MESSAGE_COLUMNS = (
    "TIPO_DE_REGISTRO", "VALOR_DO_REGISTRO", "MENSAGEM", "NOME_CLIENTE", "CPFCNPJ",
    "CODCLIENTE", "TAG", "CORINGA1", "CORINGA2", "CORINGA3", "CORINGA4", "CORINGA5",
    "PRIORIDADE",
)


def mailing_columns(weekday_headers=WEEKDAY_COLUMNS) -> list[str]:
    """The 66 table columns in order (64 base columns + score + flag)."""
    renames = mailing_renames(weekday_headers)
    return [renames[c] for c in base_columns(weekday_headers)] + ["score", "flag"]


def base_columns(weekday_headers=WEEKDAY_COLUMNS) -> list[str]:
    cols = list(BASE_COLUMNS)
    if tuple(weekday_headers) != WEEKDAY_COLUMNS:
        start = cols.index(WEEKDAY_COLUMNS[0])
        cols[start:start + len(WEEKDAY_COLUMNS)] = list(weekday_headers)
    return cols


def mailing_renames(weekday_headers=WEEKDAY_COLUMNS) -> dict[str, str]:
    """Header -> table column. Another week's weekday headers take the table
    columns of the same positions, so all weeks fit one table."""
    renames = dict(MAILING_RENAMES)
    columns = [renames.pop(old) for old in WEEKDAY_COLUMNS]
    return renames | dict(zip(weekday_headers, columns, strict=True))


def mailing_schema(weekday_headers=WEEKDAY_COLUMNS) -> T.StructType:
    """Typed schema of the 66 conformed columns."""
    fields = []
    for name in mailing_columns(weekday_headers):
        if name in MAILING_DOUBLE_COLUMNS:
            t = T.DoubleType()
        elif name in MAILING_DATE_COLUMNS:
            t = T.DateType()
        else:
            t = T.StringType()
        fields.append(T.StructField(name, t, True))
    return T.StructType(fields)


def base_input_schema(weekday_headers=WEEKDAY_COLUMNS) -> T.StructType:
    """Schema of the landed priced base (CSV or Parquet).

    Ids are read as text so the strict cast can reject bad values, the sale
    date may be a date or a serial day number, the distance is lenient text.
    The two phones and the insights' company number are not base columns.
    """
    doubles = {"LBR Médio Mensal", "Volume Médio Mensal", "VEDI_VOL", PRICE, LIMIT_PRICE}
    skip = {MOBILE, LANDLINE}
    fields = []
    for name in base_columns(weekday_headers):
        if name in skip:
            continue
        t = T.DoubleType() if name in doubles else T.StringType()
        fields.append(T.StructField(name, t, True))
    return T.StructType(fields)


INSIGHTS_SCHEMA = T.StructType([
    T.StructField(INSIGHTS_KEY, T.StringType(), True),
    T.StructField("CNPJ", T.StringType(), True),
    T.StructField("Score", T.StringType(), True),
    T.StructField("Flag", T.StringType(), True),
])

HOT_CONTACTS_SCHEMA = T.StructType([
    T.StructField(CONTACTS_KEY, T.StringType(), True),
    T.StructField(AUTHORISED, T.StringType(), True),
    T.StructField(HOT_PHONE, T.StringType(), True),
])

WHATSAPP_CONTACTS_SCHEMA = T.StructType([
    T.StructField(CONTACTS_KEY, T.StringType(), True),
    T.StructField(WHATSAPP_PHONE, T.StringType(), True),
])

REGISTRY_SCHEMA = T.StructType([
    T.StructField("cod_sap", T.LongType(), False),
    T.StructField("id_oportunidade", T.StringType(), True),
    T.StructField("dt_oportunidade", T.DateType(), True),
])

# The message load's columns, and the bucket they are written by.
MESSAGE_SCHEMA = T.StructType([
    T.StructField(name, T.LongType() if name == "VALOR_DO_REGISTRO" else T.StringType(), True)
    for name in ("TIPO_DE_REGISTRO", "VALOR_DO_REGISTRO", "MENSAGEM", "NOME_CLIENTE", "CPFCNPJ", "CODCLIENTE", "TAG",
                 "CORINGA1", "CORINGA2", "CORINGA3", "CORINGA4", "CORINGA5", "PRIORIDADE")
] + [T.StructField("n_offers", T.IntegerType(), True)])
