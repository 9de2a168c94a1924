from tabelion.functions.scalar import (  # noqa: F401
    count_fields,
    decimal_from_comma,
    exceeds_fields,
    excess_percent,
    file_name,
    gigabytes,
    left_chars,
    megabytes,
    reference_date,
    registration_number,
    reject_cause,
    resolve_link,
    thousands,
)
