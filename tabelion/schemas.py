"""Registry table definitions: column order, VARCHAR widths, file suffixes.

Everything in this module is data. The registry publishes headerless,
semicolon-separated Latin-1 extracts; each table has a fixed column order
and each target column a fixed VARCHAR width.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# They must equal the registry layout for loads to line up.
# Table -> (file suffix, [(column, VARCHAR width), ...] in file order).
# ---------------------------------------------------------------------------
CODE_WIDTHS = {
    "cnae": (".CNAECSV", 7),
    "motivo": (".MOTICSV", 2),
    "municipio": (".MUNICCSV", 4),
    "natureza_juridica": (".NATJUCSV", 4),
    "pais": (".PAISCSV", 3),
    "qualificacao_socio": (".QUALSCSV", 2),
}
CODE_DESCRIPTION_WIDTH = 200

MAIN_TABLES = {
    "empresas": (
        ".EMPRECSV",
        [
            ("cnpj_basico", 8),
            ("razao_social", 200),
            ("natureza_juridica", 4),
            ("qualificacao_responsavel", 2),
            ("capital_social_str", 20),
            ("porte_empresa", 2),
            ("ente_federativo_responsavel", 50),
        ],
    ),
    "estabelecimento": (
        ".ESTABELE",
        [
            ("cnpj_basico", 8),
            ("cnpj_ordem", 4),
            ("cnpj_dv", 2),
            ("matriz_filial", 1),
            ("nome_fantasia", 200),
            ("situacao_cadastral", 2),
            ("data_situacao_cadastral", 8),
            ("motivo_situacao_cadastral", 2),
            ("nome_cidade_exterior", 200),
            ("pais", 3),
            ("data_inicio_atividades", 8),
            ("cnae_fiscal", 7),
            ("cnae_fiscal_secundaria", 1000),
            ("tipo_logradouro", 20),
            ("logradouro", 200),
            ("numero", 10),
            ("complemento", 200),
            ("bairro", 200),
            ("cep", 8),
            ("uf", 2),
            ("municipio", 4),
            ("ddd1", 4),
            ("telefone1", 8),
            ("ddd2", 4),
            ("telefone2", 8),
            ("ddd_fax", 4),
            ("fax", 8),
            ("correio_eletronico", 200),
            ("situacao_especial", 200),
            ("data_situacao_especial", 8),
        ],
    ),
    "socios_original": (
        ".SOCIOCSV",
        [
            ("cnpj_basico", 8),
            ("identificador_de_socio", 1),
            ("nome_socio", 200),
            ("cnpj_cpf_socio", 14),
            ("qualificacao_socio", 2),
            ("data_entrada_sociedade", 8),
            ("pais", 3),
            ("representante_legal", 11),
            ("nome_representante", 200),
            ("qualificacao_representante_legal", 2),
            ("faixa_etaria", 1),
        ],
    ),
    # The load pattern is "*.SIMPLES.CSV*": extracts are named
    # "<x>.SIMPLES.CSV.D<date>" and the suffix is not at the end.
    "simples": (
        ".SIMPLES.CSV",
        [
            ("cnpj_basico", 8),
            ("opcao_simples", 1),
            ("data_opcao_simples", 8),
            ("data_exclusao_simples", 8),
            ("opcao_mei", 1),
            ("data_opcao_mei", 8),
            ("data_exclusao_mei", 8),
        ],
    ),
}

# Table comments set at creation (fixed values).
TABLE_COMMENTS = {
    "cnae": "Classificação Nacional de Atividades Econômicas",
    "empresas": "Dados das empresas matrizes",
    "estabelecimento": "Dados dos estabelecimentos (matrizes e filiais)",
    "motivo": "Motivos da situação cadastral",
    "municipio": "Municípios brasileiros",
    "natureza_juridica": "Naturezas jurídicas das empresas",
    "pais": "Países",
    "qualificacao_socio": "Qualificações dos sócios",
    "simples": "Dados do Simples Nacional",
    "socios_original": "Dados originais dos sócios",
}

# Tokens that the code-list loader turns into NULL: the default missing-value
# list of pandas.read_csv (fixed values, pandas 2.x documentation order).
MISSING_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
    "nan", "null",
]

# Reference-date fallback when the company file name has no D-date part.
REFERENCE_DATE_FALLBACK = "dd/mm/2025"

# Table lists used by the checks (fixed values, in the registry tool's order).
CODE_TABLES = list(CODE_WIDTHS)
BASE_TABLES = [
    "cnae", "empresas", "estabelecimento", "motivo", "municipio",
    "natureza_juridica", "pais", "qualificacao_socio", "simples", "socios_original",
]
MONITOR_TABLES = [
    "estabelecimento", "empresas", "socios_original", "simples", "cnae", "motivo",
    "municipio", "natureza_juridica", "pais", "qualificacao_socio",
]
INTEGRITY_TABLES = [
    "empresas", "estabelecimento", "simples", "cnae", "motivo", "municipio",
    "natureza_juridica", "pais", "qualificacao_socio", "socios", "_referencia",
]
STATE_TABLES = [
    "cnae", "motivo", "municipio", "natureza_juridica", "pais", "qualificacao_socio",
    "estabelecimento", "socios_original", "empresas", "simples", "socios", "_referencia",
]
DERIVED_TABLES = ["socios", "_referencia"]
# Columns by which rows are looked up (fixed values).
ACCESS_PATHS = {t: ["codigo"] for t in CODE_TABLES} | {
    "estabelecimento": ["cnpj", "cnpj_basico"],
    "empresas": ["cnpj_basico", "razao_social"],
    "socios_original": ["cnpj_basico"],
    "socios": ["cnpj", "cnpj_basico", "cnpj_cpf_socio", "nome_socio"],
    "simples": ["cnpj_basico"],
}
# Those of them that neither buckets nor the order of the rows serve: row groups get Bloom filters of their values.
BLOOM_COLUMNS = {
    "estabelecimento": ["cnpj"],
    "empresas": ["razao_social"],
    "socios_original": ["cnpj_basico"],
    "socios": ["cnpj", "cnpj_cpf_socio", "nome_socio"],
}
REFERENCE_WIDTH = 100


@dataclass(frozen=True)
class TableSpec:
    name: str
    suffix: str
    columns: tuple[tuple[str, int], ...]
    is_code: bool

    @property
    def names(self) -> list[str]:
        return [c for c, _ in self.columns]

    @property
    def widths(self) -> dict[str, int]:
        return dict(self.columns)

    @property
    def glob(self) -> str:
        """File-name pattern of the table's extracts (suffix may be followed by more)."""
        return f"*{self.suffix}*" if self.name == "simples" else f"*{self.suffix}"

    def read_schema(self) -> T.StructType:
        """All-text schema used to parse extracts; no inference."""
        return T.StructType([T.StructField(c, T.StringType(), True) for c in self.names])

    def ddl(self) -> str:
        return ", ".join(f"{c} VARCHAR({w})" for c, w in self.columns)


def spec(name: str) -> TableSpec:
    if name in CODE_WIDTHS:
        suffix, width = CODE_WIDTHS[name]
        cols = (("codigo", width), ("descricao", CODE_DESCRIPTION_WIDTH))
        return TableSpec(name, suffix, cols, True)
    suffix, cols = MAIN_TABLES[name]
    return TableSpec(name, suffix, tuple(cols), False)


ALL_SPECS = {name: spec(name) for name in BASE_TABLES}


def final_columns(table: str) -> list[tuple[str, str]]:
    """(column, type) of a table as it stands after the load."""
    text = lambda t: [(c, f"VARCHAR({w})") for c, w in spec(t).columns]
    if table == "empresas":
        return [c for c in text(table) if c[0] != "capital_social_str"] + [("capital_social", "DECIMAL(18,2)")]
    if table == "estabelecimento":
        return [*text(table), ("cnpj", "VARCHAR(14)")]
    if table == "socios":
        return [("cnpj", "VARCHAR(14)"), *text("socios_original")]
    return text(table)
