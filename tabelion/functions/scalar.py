"""Column expressions used by the registry jobs (all JVM-side built-ins)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tabelion.schemas import REFERENCE_DATE_FALLBACK

MB = 1024 * 1024
GB = 1024 * 1024 * 1024


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def decimal_from_comma(x, strict: bool = True, precision: int = 18, scale: int = 2) -> Column:
    """Decimal-comma text ("1234,56") to DECIMAL(p,s), rounding half up.

    Strict follows ANSI: one malformed amount fails the job, as the target
    database's UPDATE does. Lenient gives NULL for malformed text.
    """
    text = F.replace(_c(x), F.lit(","), F.lit("."))
    target = f"decimal({precision},{scale})"
    return text.cast(target) if strict else text.try_cast(target)


def registration_number(basico="cnpj_basico", ordem="cnpj_ordem", dv="cnpj_dv") -> Column:
    """14-character number: the three parts concatenated, NULL parts skipped."""
    return F.concat_ws("", _c(basico), _c(ordem), _c(dv))


def left_chars(x, n: int) -> Column:
    """First n characters; NULL stays NULL."""
    return F.left(_c(x), F.lit(n))


def file_name(path) -> Column:
    """Last path or URL segment."""
    return F.element_at(F.split(_c(path), "/"), -1)


def reference_date(name) -> Column:
    """Reference date from an extract name "<a>.<b>.DYMMDD.<suffix>" as dd/mm/202Y.

    The decade is fixed by the registry tool; names without a six-character
    D-part in the third dot-separated place give the fallback text.
    """
    part = F.try_element_at(F.split(_c(name), r"[.]"), F.lit(3))
    formatted = F.concat(
        F.substring(part, 5, 2), F.lit("/"), F.substring(part, 3, 2), F.lit("/202"), F.substring(part, 2, 1)
    )
    ok = (F.length(part) == 6) & part.startswith("D")
    return F.when(ok, formatted).otherwise(F.lit(REFERENCE_DATE_FALLBACK))


def resolve_link(href, base) -> Column:
    """Absolute links kept, relative ones appended to the page address."""
    h = _c(href)
    return F.when(h.startswith("http"), h).otherwise(F.concat(_c(base), h))


def megabytes(n) -> Column:
    return _c(n) / F.lit(MB)


def gigabytes(n) -> Column:
    return _c(n) / F.lit(GB)


def excess_percent(existing, expected) -> Column:
    """(existing - expected) / expected * 100; NULL when nothing is expected."""
    exp = _c(expected).cast("double")
    return (_c(existing) - exp) / F.nullif(exp, F.lit(0.0)) * F.lit(100.0)


def thousands(n) -> Column:
    """Integer count as text with comma thousands separators."""
    return F.format_number(_c(n), 0)


def exceeds_fields(line, n, sep: str = ";") -> Column:
    """True when a delimited line has more than ``n`` fields (quoted separators ignored).

    A plain separator count bounds the field count from above, so the quote
    aware count (a regex) only runs on lines that could be too long.
    """
    raw_seps = _times(line, sep)
    limit = n if isinstance(n, Column) else F.lit(n)
    # ``when`` evaluates the regex only for lines that pass the cheap bound
    return F.when(raw_seps >= limit, count_fields(line, sep) > limit).otherwise(F.lit(False))


def _times(text, char: str) -> Column:
    """How often an ASCII character occurs in a text; bytes are compared, which is quicker than splitting."""
    return F.octet_length(_c(text)) - F.octet_length(F.replace(_c(text), F.lit(char), F.lit("")))


def count_fields(line, sep: str = ";") -> Column:
    """Number of fields in one delimited line, separators inside quotes ignored."""
    unquoted = F.regexp_replace(_c(line), r'"[^"]*+(?:""[^"]*+)*+"', "")
    return F.length(unquoted) - F.length(F.replace(unquoted, F.lit(sep), F.lit(""))) + F.lit(1)


TOO_LONG, OPEN_QUOTE = "too_long", "open_quote"


def reject_cause(line, n) -> Column:
    """Why a record cannot be stored, or NULL: an unclosed quote (a record cut by a line break), or too many fields."""
    return F.when(_times(line, '"') % 2 == 1, F.lit(OPEN_QUOTE)).when(exceeds_fields(line, n), F.lit(TOO_LONG))
