"""Registry-shaped views over the driver's tables (fixture plumbing).

Each view is one SQL text accepted by both Spark and DuckDB. Base tables are
written as ``{name}`` placeholders: Spark binds them to DataFrames through
``spark.sql(text, name=df)``, the DuckDB oracle binds them to its views. The
oracle for a query is a ``WITH`` chain of these texts, so both sides start
from the same rows.
"""

from __future__ import annotations

import re
import uuid

from pyspark.sql import DataFrame, SparkSession

SOURCE_TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]

VIEWS: dict[str, str] = {
    "cnae": "select lpad(cast(p_partkey as string),7,'0') codigo, p_name descricao from {part}",
    "motivo": (
        "select distinct lpad(substr(o_orderpriority,1,1),2,'0') codigo, "
        "substr(o_orderpriority,3) descricao from {orders}"
    ),
    "municipio": "select lpad(cast(n_nationkey as string),4,'0') codigo, n_name descricao from {nation}",
    "natureza_juridica": (
        "select lpad(cast(row_number() over (order by s) as string),4,'0') codigo, s descricao "
        "from (select distinct c_mktsegment s from {customer}) x"
    ),
    "pais": "select lpad(cast(n_nationkey as string),3,'0') codigo, n_name descricao from {nation}",
    "qualificacao_socio": (
        "select lpad(cast(r_regionkey as string),2,'0') codigo, r_name descricao from {region}"
    ),
    "empresas_raw": (
        "select lpad(cast(c_custkey as string),8,'0') cnpj_basico, "
        "concat(c_name,' COMERCIO DE ARTIGOS EM GERAL LTDA') razao_social, "
        "lpad(cast(c_nationkey as string),4,'0') natureza_juridica, "
        "lpad(cast(c_custkey % 5 as string),2,'0') qualificacao_responsavel, "
        "replace(cast(cast(c_acctbal as decimal(18,2)) as string),'.',',') capital_social_str, "
        "case when c_acctbal<0 then '00' when c_acctbal<3000 then '01' "
        "when c_acctbal<6000 then '03' else '05' end porte_empresa, "
        "'' ente_federativo_responsavel from {customer}"
    ),
    "estabelecimento_raw": (
        "select lpad(cast(o_custkey as string),8,'0') cnpj_basico, lpad(cast(rn as string),case when rn > 9999 then 9 else 4 end,'0') cnpj_ordem, "
        "lpad(cast(o_orderkey % 100 as string),2,'0') cnpj_dv, "
        "case when rn=1 then '1' else '2' end matriz_filial, "
        "concat('LOJA ',cast(o_orderkey as string),' ARTIGOS EM GERAL E SERVICOS') nome_fantasia, "
        "case o_orderstatus when 'F' then '08' when 'O' then '02' else '03' end situacao_cadastral, "
        "replace(cast(cast(o_orderdate as date) as string),'-','') data_situacao_cadastral, "
        "lpad(substr(o_orderpriority,1,1),2,'0') motivo_situacao_cadastral, "
        "lpad(cast(o_custkey % 25 as string),4,'0') municipio, "
        "lpad(cast(o_orderkey % 25 as string),3,'0') pais, "
        "lpad(cast(o_custkey % 27 as string),2,'0') uf "
        "from (select *, row_number() over (partition by o_custkey order by o_orderkey) rn from {orders}) x"
    ),
    "socios_original": (
        "select lpad(cast(l_partkey as string),8,'0') cnpj_basico, "
        "cast(1 + l_linenumber % 3 as string) identificador_de_socio, "
        "concat('SOCIO ',cast(l_suppkey as string)) nome_socio, "
        "lpad(cast(l_orderkey as string),11,'0') cnpj_cpf_socio, "
        "lpad(cast(l_linenumber % 5 as string),2,'0') qualificacao_socio, "
        "replace(cast(cast(l_shipdate as date) as string),'-','') data_entrada_sociedade from {lineitem}"
    ),
    "simples": (
        "select lpad(cast(c_custkey as string),8,'0') cnpj_basico, "
        "case when c_custkey % 2=0 then 'S' else 'N' end opcao_simples, "
        "case when c_custkey % 7=0 then 'S' else 'N' end opcao_mei, "
        "case when c_custkey % 3=0 then '20240131' else '' end data_exclusao_simples from {customer}"
    ),
}

# Spark-side text of ``estabelecimento_raw``: the same columns over orders that
# already carry ``rn`` (numbered by ``operators.numbering``, which stays
# balanced when one customer holds most orders). The oracle keeps the window.
ESTABELECIMENTO_SPARK = VIEWS["estabelecimento_raw"].replace(
    "from (select *, row_number() over (partition by o_custkey order by o_orderkey) rn from {orders}) x",
    "from {orders_rn} x",
)
assert ESTABELECIMENTO_SPARK != VIEWS["estabelecimento_raw"]

# The registry file name of a main table carries the view under this name.
RAW_OF = {"empresas": "empresas_raw", "estabelecimento": "estabelecimento_raw"}

_PLACEHOLDER = re.compile(r"\{(\w+)\}")


def source(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


_NUMBERED_ORDERS: dict[tuple[str, str], DataFrame] = {}


def numbered_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with ``rn`` = position of the order among its customer's orders (once per session)."""
    from tabelion.operators.numbering import row_number_within

    from tabelion.session import scratch_path

    key = (spark.sparkContext.applicationId, sf_dir.rstrip("/"))
    if key not in _NUMBERED_ORDERS:
        cols = ["o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate", "o_orderpriority"]
        orders = source(spark, sf_dir, "orders").select(*cols)
        path = scratch_path(spark, "numbered_orders", uuid.uuid4().hex)
        row_number_within(orders, "o_custkey", "o_orderkey").write.parquet(path)
        _NUMBERED_ORDERS[key] = spark.read.parquet(path)
    return _NUMBERED_ORDERS[key]


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One registry-shaped view as a lazy DataFrame over the parquet tables."""
    if name == "estabelecimento_raw":
        return spark.sql(ESTABELECIMENTO_SPARK, orders_rn=numbered_orders(spark, sf_dir))
    text = VIEWS[name]
    args = {t: source(spark, sf_dir, t) for t in set(_PLACEHOLDER.findall(text))}
    return spark.sql(text, **args)


def registry_view(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    """View standing for the extract of a base table (``empresas`` -> ``empresas_raw``)."""
    return view(spark, sf_dir, RAW_OF.get(table, table))


def oracle_with(*names: str) -> str:
    """``WITH`` clause binding the named views for the DuckDB oracle."""
    parts = []
    for n in names:
        text = _PLACEHOLDER.sub(lambda m: m.group(1), VIEWS[n])
        parts.append(f"{n} AS ({text})")
    return "WITH " + ",\n".join(parts) + "\n"
