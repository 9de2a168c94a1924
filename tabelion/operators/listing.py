"""Ordered listings: latest records, code previews, table names.

Each listing is ``orderBy(...).limit(k)``, which Spark plans as
TakeOrderedAndProject: every task keeps its own top k and one task merges
them, so no full sort or shuffle of the table happens.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabelion.functions import left_chars


def latest_establishments(estabelecimento: DataFrame, k: int = 5) -> DataFrame:
    """Last k establishments by company key, descending (NULL keys first), name cut to 30."""
    return estabelecimento.orderBy(F.col("cnpj_basico").desc_nulls_first(), F.col("cnpj").desc_nulls_first()).limit(
        k
    ).select("cnpj_basico", left_chars("nome_fantasia", 30).alias("nome_fantasia"), "uf", "municipio")


def latest_companies(empresas: DataFrame, k: int = 3) -> DataFrame:
    """Last k companies by key, descending (NULL keys first), name cut to 40."""
    return empresas.orderBy(
        F.col("cnpj_basico").desc_nulls_first(), F.col("razao_social").desc_nulls_first()
    ).limit(k).select("cnpj_basico", left_chars("razao_social", 40).alias("razao_social"), "porte_empresa")


def first_code(codes: DataFrame) -> DataFrame:
    """Smallest code, ascending with NULLs last."""
    return codes.orderBy(F.col("codigo").asc_nulls_last()).limit(1).select("codigo")


def last_code(codes: DataFrame) -> DataFrame:
    """Largest code, descending with NULLs first."""
    return codes.orderBy(F.col("codigo").desc_nulls_first()).limit(1).select("codigo")


def code_preview(tables: dict[str, DataFrame], k: int = 5) -> DataFrame:
    """First k rows of each code list in code order (file order is not defined)."""
    frames = [
        df.orderBy(F.col("codigo").asc_nulls_last(), F.col("descricao").asc_nulls_last())
        .limit(k)
        .select(F.lit(n).alias("table_name"), "codigo", "descricao")
        for n, df in tables.items()
    ]
    return reduce(lambda a, b: a.unionByName(b), frames)
