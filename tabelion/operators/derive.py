"""Derived relations: exact-decimal capital, registration number, partners per head office."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabelion.functions import decimal_from_comma, registration_number

HEAD_OFFICE = "1"


def companies_with_capital(empresas: DataFrame, strict: bool = True) -> DataFrame:
    """Replace ``capital_social_str`` by ``capital_social DECIMAL(18,2)`` as the last column."""
    keep = [c for c in empresas.columns if c != "capital_social_str"]
    return empresas.select(*keep, decimal_from_comma("capital_social_str", strict).alias("capital_social"))


def rejected_capital(empresas: DataFrame) -> DataFrame:
    """Rows whose amount text is not a valid decimal (the lenient load's reject list)."""
    parsed = decimal_from_comma("capital_social_str", strict=False)
    return empresas.filter(parsed.isNull())


def establishments_with_number(estabelecimento: DataFrame) -> DataFrame:
    """Append the 14-character ``cnpj`` as the last column."""
    return estabelecimento.withColumn("cnpj", registration_number())


def head_offices(estabelecimento: DataFrame) -> DataFrame:
    """Company key and number of the head offices; the filter and the two columns reach the scan."""
    heads = estabelecimento.filter(F.col("matriz_filial") == F.lit(HEAD_OFFICE))
    return heads.select(F.col("cnpj_basico").alias("_hq_basico"), F.col("cnpj"))


def partners_of(socios_original: DataFrame, heads: DataFrame) -> DataFrame:
    """Partners joined to ``head_offices``: the number first, then all columns of the partners."""
    joined = socios_original.join(heads, socios_original["cnpj_basico"] == heads["_hq_basico"], "inner")
    return joined.select("cnpj", *[socios_original[c] for c in socios_original.columns])


def partners_or_waiting(socios_original: DataFrame, heads: DataFrame, flag: str) -> DataFrame:
    """``partners_of`` plus the partners without a head office (their number is NULL), which ``flag`` tells."""
    joined = socios_original.join(heads, socios_original["cnpj_basico"] == heads["_hq_basico"], "left")
    return joined.select("cnpj", *[socios_original[c] for c in socios_original.columns], F.col("_hq_basico").isNull().alias(flag))


def partners_head_office(socios_original: DataFrame, estabelecimento: DataFrame) -> DataFrame:
    """Partners keyed by their company's head-office number.

    The registry tool writes this as a LEFT JOIN followed by
    ``WHERE matriz_filial = '1'``; the filter rejects the NULL-extended rows,
    so the result is the inner join. Partners of a company with no head office
    drop out; a company with two head offices yields two rows per partner.
    """
    return partners_of(socios_original, head_offices(estabelecimento))
