"""DuckDB oracle text for each registered query (same names and column aliases).

Oracles are written independently of the Spark code, as plain SQL over the
fixture views (``WITH`` chains of ``tabelion.fixtures.VIEWS``).
"""

from __future__ import annotations

from tabelion import schemas
from tabelion.fixtures import VIEWS
from tabelion.fixtures import oracle_with as W

CODES = schemas.CODE_TABLES
ALL_VIEWS = list(VIEWS)

DERIVED = """,
empresas AS (SELECT cnpj_basico, razao_social, natureza_juridica, qualificacao_responsavel, porte_empresa,
    ente_federativo_responsavel, CAST(replace(capital_social_str, ',', '.') AS DECIMAL(18,2)) AS capital_social
    FROM empresas_raw),
estabelecimento AS (SELECT *, concat(cnpj_basico, cnpj_ordem, cnpj_dv) AS cnpj FROM estabelecimento_raw),
socios AS (SELECT te.cnpj AS cnpj, ts.* FROM socios_original ts
    LEFT JOIN estabelecimento te ON te.cnpj_basico = ts.cnpj_basico WHERE te.matriz_filial = '1')
"""

BASE = W(*ALL_VIEWS) + DERIVED

EXTRACT = {n: n for n in schemas.BASE_TABLES} | {"empresas": "empresas_raw", "estabelecimento": "estabelecimento_raw"}


def _union(parts: list[str]) -> str:
    return "\nUNION ALL\n".join(parts)


def _counts(tables: list[str]) -> str:
    return _union([f"SELECT '{t}' AS table_name, count(*) AS n_rows, true AS present FROM {t}" for t in tables])


def _ends(src: str) -> str:
    return (
        f"SELECT count(*) AS n, min(codigo) AS first_code, "
        f"CASE WHEN count(codigo) < count(*) THEN NULL ELSE max(codigo) END AS last_code FROM {src}"
    )


SCENARIOS = (
    "scen AS (SELECT * FROM (VALUES ('first_run', 0, 0, false), ('rerun', 1, 1, false), ('double_load', 2, 2, false), "
    "('half_loaded', 1, 0, false), ('half_twice', 2, 0, false), ('half_three_times', 3, 0, false), "
    "('half_five_times', 5, 0, false), ('empty_extract', 1, 1, true)) v(scenario, e, o, nothing))"
)
EVEN = "right({c}, 1) IN ('0', '2', '4', '6', '8')"


def _copies(view: str, cols: str, key: str) -> str:
    """The stored rows of a scenario: each row of the view as often as the scenario says."""
    even = EVEN.format(c=key)
    return (
        f"SELECT scenario, {cols} FROM {view}, scen, unnest(range(CASE WHEN {even} THEN e ELSE o END)) AS u(i)"
    )


def _code_decision() -> str:
    parts = []
    for t in CODES:
        parts.append(
            f"SELECT scen.scenario, '{t}' AS table_name, coalesce(st.n, 0) AS existing, st.f AS stored_first, "
            f"st.l AS stored_last, CASE WHEN nothing THEN 0 ELSE ic.n END AS expected, "
            f"CASE WHEN NOT nothing THEN ic.f END AS incoming_first, CASE WHEN NOT nothing THEN ic.l END AS incoming_last "
            f"FROM scen LEFT JOIN (SELECT scenario, count(*) AS n, min(codigo) AS f, max(codigo) AS l FROM "
            f"({_copies(t, 'codigo', 'codigo')}) GROUP BY scenario) st ON st.scenario = scen.scenario, "
            f"(SELECT count(*) AS n, min(codigo) AS f, max(codigo) AS l FROM {t}) ic"
        )
    return f"""{SCENARIOS}, stats AS ({_union(parts)}),
d AS (SELECT *, (stored_first IS NOT DISTINCT FROM incoming_first AND stored_last IS NOT DISTINCT FROM incoming_last)
        AS ends_equal,
    (existing - CAST(expected AS DOUBLE)) / nullif(CAST(expected AS DOUBLE), 0) * 100 AS pct FROM stats),
k AS (SELECT *, CASE WHEN existing = 0 THEN 'insert' WHEN expected = 0 THEN 'skip_empty_input'
       WHEN existing >= expected AND ends_equal THEN 'skip'
       WHEN existing > expected AND pct > 50 THEN 'inconsistent_severe'
       WHEN existing > expected THEN 'inconsistent_moderate' ELSE 'append' END AS decision FROM d)
SELECT scenario, table_name, CAST(existing AS BIGINT) AS existing, stored_first, stored_last,
  CAST(expected AS BIGINT) AS expected, incoming_first, incoming_last, ends_equal, round(pct, 1) AS excess_pct, decision,
  decision IN ('insert', 'append') OR (force AND decision LIKE 'inconsistent%') AS will_insert, force
FROM k, (VALUES (false), (true)) f(force)"""


def _main_decision() -> str:
    parts = []
    for t in ["estabelecimento", "socios_original", "empresas", "simples"]:
        parts.append(
            f"SELECT scen.scenario, '{t}' AS table_name, coalesce(st.n, 0) AS existing, "
            f"CASE WHEN nothing THEN 0 ELSE ic.n END AS expected FROM scen LEFT JOIN (SELECT scenario, count(*) AS n FROM "
            f"({_copies(EXTRACT[t], 'cnpj_basico', 'cnpj_basico')}) GROUP BY scenario) st ON st.scenario = scen.scenario, "
            f"(SELECT count(*) AS n FROM {EXTRACT[t]}) ic"
        )
    return f"""{SCENARIOS}, stats AS ({_union(parts)})
SELECT scenario, table_name, CAST(existing AS BIGINT) AS existing, CAST(expected AS BIGINT) AS expected,
  CASE WHEN existing = 0 THEN 'insert' WHEN existing >= expected THEN 'skip' ELSE 'append' END AS decision,
  NOT (existing > 0 AND existing >= expected) AS will_insert FROM stats"""


def _width_report() -> str:
    parts = []
    for t in schemas.BASE_TABLES:
        src, have, spec = EXTRACT[t], set(_view_columns(EXTRACT[t])), schemas.spec(t)
        key = spec.names[0]
        for i, (c, w) in enumerate(spec.columns):
            value = c if c in have else "''"
            if i:
                value = f"CASE WHEN right({key}, 1) = '7' THEN rpad(coalesce({value}, ''), {w + 1}, 'x') ELSE {value} END"
            parts.append(
                f"SELECT '{t}' AS table_name, '{c}' AS column_name, {w} AS width, "
                f"CAST(max(length({value})) AS INTEGER) AS max_length, "
                f"CAST(count(*) FILTER (WHERE length({value}) > {w}) AS BIGINT) AS n_over FROM {src}"
            )
    return _union(parts)


_VIEW_COLUMNS = {
    "empresas_raw": ["cnpj_basico", "razao_social", "natureza_juridica", "qualificacao_responsavel",
                     "capital_social_str", "porte_empresa", "ente_federativo_responsavel"],
    "estabelecimento_raw": ["cnpj_basico", "cnpj_ordem", "cnpj_dv", "matriz_filial", "nome_fantasia",
                            "situacao_cadastral", "data_situacao_cadastral", "motivo_situacao_cadastral",
                            "municipio", "pais", "uf"],
    "socios_original": ["cnpj_basico", "identificador_de_socio", "nome_socio", "cnpj_cpf_socio",
                        "qualificacao_socio", "data_entrada_sociedade"],
    "simples": ["cnpj_basico", "opcao_simples", "opcao_mei", "data_exclusao_simples"],
}


def _view_columns(name: str) -> list[str]:
    return _VIEW_COLUMNS.get(name, ["codigo", "descricao"])


ORACLES: dict[str, str] = {
    "partners_head_office": BASE + "SELECT * FROM socios",
    "companies_capital": BASE + "SELECT * FROM empresas",
    "establishment_number": BASE + "SELECT * FROM estabelecimento",
    "company_establishment_count": BASE
    + "SELECT 'empresas_estabelecimento' AS check_name, count(*) AS n_rows "
    "FROM empresas e INNER JOIN estabelecimento est ON e.cnpj_basico = est.cnpj_basico",
    "establishment_partner_count": BASE
    + "SELECT 'estabelecimento_socios' AS check_name, count(*) AS n_rows "
    "FROM estabelecimento e INNER JOIN socios s ON e.cnpj = s.cnpj",
    "table_counts": BASE
    + f"SELECT *, format('{{:,}}', n_rows) AS n_rows_text FROM ({_counts(schemas.MONITOR_TABLES)}) c",
    "code_distinct": BASE
    + _union([f"SELECT '{t}' AS table_name, count(*) AS n_rows, count(DISTINCT codigo) AS n_distinct FROM {t}"
              for t in CODES]),
    "code_ends": BASE
    + _union([f"SELECT '{t}' AS table_name, first_code, last_code FROM ({_ends(t)}) e" for t in CODES]),
    "latest_establishments": BASE
    + "SELECT cnpj_basico, left(nome_fantasia, 30) AS nome_fantasia, uf, municipio FROM estabelecimento "
    "ORDER BY cnpj_basico DESC NULLS FIRST, cnpj DESC NULLS FIRST LIMIT 5",
    "latest_companies": BASE
    + "SELECT cnpj_basico, left(razao_social, 40) AS razao_social, porte_empresa FROM empresas "
    "ORDER BY cnpj_basico DESC NULLS FIRST, razao_social DESC NULLS FIRST LIMIT 3",
    "code_preview": BASE
    + _union([f"SELECT * FROM (SELECT '{t}' AS table_name, codigo, descricao FROM {t} "
              f"ORDER BY codigo ASC NULLS LAST, descricao ASC NULLS LAST LIMIT 5) p_{t}" for t in CODES]),
    "code_load_decision": BASE + ", " + _code_decision(),
    "main_load_decision": BASE + ", " + _main_decision(),
    "width_report": BASE + _width_report(),
}


# ---------------------------------------------------------------------------
# Oracles for the queries over registry files. The extract names, lines and
# archive names are stated in SQL from the same views.
# ---------------------------------------------------------------------------

TAG = ("(SELECT 'D' || substr(strftime(max(o_orderdate), '%Y'), 4, 1) || strftime(max(o_orderdate), '%m%d') "
       "FROM orders)")
NUMBERED = ("empresas", "estabelecimento", "socios_original")
ARCHIVE_LABEL = {
    "cnae": "Cnaes", "empresas": "Empresas", "estabelecimento": "Estabelecimentos", "motivo": "Motivos",
    "municipio": "Municipios", "natureza_juridica": "Naturezas", "pais": "Paises",
    "qualificacao_socio": "Qualificacoes", "simples": "Simples", "socios_original": "Socios",
}


def _file_expr(t: str) -> str:
    suffix = schemas.spec(t).suffix
    if t in NUMBERED:
        return f"'K3241.K03200Y' || right(cnpj_basico, 1) || '.' || {TAG} || '{suffix}'"
    if t == "simples":
        return f"'F.K03200W{suffix}.' || {TAG}"
    return f"'F.K03200Z.' || {TAG} || '{suffix}'"


def _archive_expr(t: str) -> str:
    if t in NUMBERED:
        return f"'{ARCHIVE_LABEL[t]}' || right(cnpj_basico, 1) || '.zip'"
    return f"'{ARCHIVE_LABEL[t]}.zip'"


def _padded_cols(t: str) -> list[str]:
    have = set(_view_columns(EXTRACT[t]))
    return [c if c in have else f"'' AS {c}" for c in schemas.spec(t).names]


def _line_expr(t: str) -> str:
    have = set(_view_columns(EXTRACT[t]))
    parts = [
        (f"'\"' || replace(coalesce({c}, ''), '\"', '\"\"') || '\"'" if c in have else "'\"\"'")
        for c in schemas.spec(t).names
    ]
    return " || ';' || ".join(parts)


def _lines() -> str:
    return _union(
        [f"SELECT '{t}' AS table_name, {_archive_expr(t)} AS archive, {_file_expr(t)} AS entry, "
         f"{_line_expr(t)} AS line FROM {EXTRACT[t]}" for t in schemas.BASE_TABLES]
    )


FILES = BASE + f", lines AS ({_lines()})\n"

_INTEGRITY = _union(
    [f"SELECT '{t}' AS check_name, 'table' AS kind, count(*) AS n_rows, true AS ok FROM {t}"
     for t in schemas.INTEGRITY_TABLES if t != "_referencia"]
    + ["SELECT '_referencia' AS check_name, 'table' AS kind, CAST(2 AS BIGINT) AS n_rows, true AS ok",
       "SELECT 'empresas_estabelecimento', 'relationship', count(*), true FROM empresas e "
       "JOIN estabelecimento est ON e.cnpj_basico = est.cnpj_basico",
       "SELECT 'estabelecimento_socios', 'relationship', count(*), true FROM estabelecimento e "
       "JOIN socios s ON e.cnpj = s.cnpj"]
)

_STATE = _union(
    [f"SELECT '{t}' AS table_name, CASE WHEN count(*) = 0 THEN 'empty' ELSE 'filled' END AS state, "
     f"count(*) AS n_rows FROM {EXTRACT.get(t, t)}" for t in schemas.STATE_TABLES
     if t not in ("socios_original", "_referencia")]
    + ["SELECT 'socios_original', 'absent', CAST(0 AS BIGINT)",
       "SELECT '_referencia', 'filled', CAST(2 AS BIGINT)"]
)

# Anchors by cutting the text at tags, not by the pattern that the Spark side uses.
LINKS = """cuts AS (SELECT page_id, url, unnest(string_split(html, '<a ')[2:]) AS cut,
    generate_subscripts(string_split(html, '<a ')[2:], 1) AS nth FROM pages),
tags AS (SELECT page_id, url, nth, split_part(cut, '>', 1) AS tag FROM cuts WHERE strpos(split_part(cut, '>', 1), 'href="') > 0),
links AS (SELECT page_id, url, CAST(row_number() OVER (PARTITION BY page_id, url ORDER BY nth) - 1 AS INTEGER) AS link_pos,
    replace(split_part(split_part(tag, 'href="', 2), '"', 1), '&amp;', '&') AS href FROM tags)
"""
HOST = "regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://([^/:?#]+)', 1)"


def _digest(t: str) -> str:
    cols = ", ".join(c.split(" AS ")[0] for c in _padded_cols(t))
    return f"SELECT '{t}' AS table_name, cnpj_basico, md5(concat_ws(';', {cols})) AS fields_md5 FROM {EXTRACT[t]}"


def _final_digest(t: str) -> str:
    """A loaded table's rows, all columns in order as text."""
    have = {"empresas": [*_view_columns("empresas_raw"), "capital_social"], "socios": ["cnpj", *_view_columns("socios_original")],
            "estabelecimento": [*_view_columns("estabelecimento_raw"), "cnpj"], "simples": _view_columns("simples")}[t]
    cols = ", ".join(f"CAST({c} AS VARCHAR)" if c in have else "''" for c, _ in schemas.final_columns(t))
    return f"SELECT '{t}' AS table_name, cnpj_basico, md5(concat_ws(';', {cols})) AS row_md5 FROM {t}"


MAIN = ["estabelecimento", "socios_original", "empresas", "simples"]
READERS = BASE + _union([_digest(t) for t in MAIN])
LOADED = sorted({*schemas.BASE_TABLES, "socios"} - {"socios_original"})


BROKEN_COLUMN = {
    "empresas": "razao_social", "estabelecimento": "nome_fantasia", "socios_original": "nome_socio", "simples": "opcao_simples",
}


def _key_of(t: str) -> str:
    return "codigo" if schemas.spec(t).is_code else "cnpj_basico"


def _damaged(t: str) -> str:
    return (
        f"SELECT '{t}' AS table_name, 'X.Y.D30610{schemas.spec(t).suffix}' AS file_name, count(*) AS n, "
        f"count(*) FILTER (WHERE right({_key_of(t)}, 1) = '3') AS long FROM {EXTRACT[t]}"
    )


def _broken_texts(reader: str, t: str) -> str:
    name = BROKEN_COLUMN.get(t, "descricao")
    breaks = (
        f"CASE right({_key_of(t)}, 1) WHEN '4' THEN 'A' || chr(10) "
        f"WHEN '5' THEN 'B' || chr(10) || chr(10) || 'C;' || chr(13) || chr(10) ELSE '' END"
    )
    return (
        f"SELECT '{reader}' AS reader, '{t}' AS table_name, {_key_of(t)} AS key, md5({breaks} || {name}) AS text_md5 "
        f"FROM {EXTRACT[t]} WHERE right({_key_of(t)}, 1) <> '3'"
    )


DAMAGED = BASE + f", damaged AS ({_union([_damaged(t) for t in schemas.BASE_TABLES])})\n"
GONE = "(regexp_matches(entry, 'Y[02468][.].*EMPRECSV$') OR entry LIKE '%CNAECSV')"

ORACLES.update(
    {
        "main_reader": READERS,
        "archive_reader": READERS,
        "code_reader": BASE + _union([f"SELECT '{t}' AS table_name, codigo, descricao FROM {t}" for t in CODES]),
        "rows_per_file": FILES
        + "SELECT table_name, entry AS file_name, count(*) AS n_rows, CAST(0 AS BIGINT) AS n_rejected "
        "FROM lines GROUP BY table_name, entry UNION ALL SELECT 'pais', 'F.K03200Z.D00101.PAISCSV', 0, 0 "
        "UNION ALL SELECT 'estabelecimento', 'K3241.K03200Y9.D00101.ESTABELE', 0, 0",
        "rejected_rows": DAMAGED
        + "SELECT table_name, file_name, 'too_long' AS cause, long AS n_rows FROM damaged WHERE long > 0 "
        "UNION ALL SELECT table_name, file_name, 'open_quote', 1 FROM damaged",
        "damaged_reconciliation": DAMAGED
        + "SELECT table_name, CAST(1 AS BIGINT) AS n_files, n - long AS expected, long + 1 AS rejected, "
        "n - long AS stored, CAST(0 AS BIGINT) AS difference, false AS matches FROM damaged",
        "records_of_lines": BASE
        + _union([_broken_texts(reader, t) for reader in ("folder", "archive") for t in schemas.BASE_TABLES]),
        "load_append": BASE + _union([_final_digest(t) for t in ("empresas", "estabelecimento", "socios", "simples")]),
        "load_append_parts": BASE + _union([_final_digest(t) for t in ("empresas", "estabelecimento", "socios", "simples")]),
        "archive_rerun": BASE
        + "SELECT 'A.zip' AS archive, 'X.Y.D30610.CNAECSV' AS entry, true AS all_present, count(*) AS n_lines FROM cnae "
        "UNION ALL SELECT 'B.zip', 'X.Y.D30610.EMPRECSV', true, count(*) FROM empresas_raw "
        "UNION ALL SELECT 'A.zip', 'LEIAME.txt', true, 0 UNION ALL SELECT 'B.zip', 'E.Y.D30610.MOTICSV', true, 0",
        "file_sizes": FILES
        + "SELECT entry AS file_name, size_bytes, round(size_bytes / 1048576.0, 2) AS size_mb, "
        "round(size_bytes / 1073741824.0, 6) AS size_gb FROM "
        "(SELECT entry, CAST(sum(length(line) + 1) AS BIGINT) AS size_bytes FROM lines GROUP BY entry) f",
        "file_summary": FILES
        + "SELECT table_name, count(DISTINCT entry) AS n_files, CAST(sum(length(line) + 1) AS BIGINT) AS total_bytes "
        "FROM lines GROUP BY table_name",
        "reconciliation": FILES
        + "SELECT table_name, count(DISTINCT entry) AS n_files, count(*) AS expected, CAST(0 AS BIGINT) AS rejected, "
        "count(*) AS stored, CAST(0 AS BIGINT) AS difference, true AS matches FROM lines "
        "WHERE table_name <> 'socios_original' GROUP BY table_name",
        "reference_metadata": BASE
        + f", t AS (SELECT {TAG} AS tag)\n"
        "SELECT 'CNPJ' AS referencia, substr(tag, 5, 2) || '/' || substr(tag, 3, 2) || '/202' || substr(tag, 2, 1) "
        "AS valor FROM t UNION ALL SELECT 'cnpj_qtde', CAST(count(*) AS VARCHAR) FROM estabelecimento_raw",
        "integrity_report": BASE + _INTEGRITY,
        "lookups": BASE + _union(
            [f"SELECT '{t}' AS table_name, '{c}' AS column_name, max({c}) AS key, "
             f"count(*) FILTER ({c} = (SELECT max({c}) FROM {t})) AS n_rows FROM {t}"
             for t, columns in schemas.ACCESS_PATHS.items() if t != "socios_original" for c in columns]),
        "tables_missing": BASE + _union(
            [f"SELECT '{t}' AS table_name, true AS present, count(*) AS n_rows FROM {EXTRACT[t]}"
             for t in schemas.BASE_TABLES if t != "socios_original"] + ["SELECT 'socios_original', false, CAST(0 AS BIGINT)"]),
        "tables_listed": BASE
        + "SELECT CAST(row_number() OVER (ORDER BY table_name) AS INTEGER) AS position, table_name, n_rows FROM ("
        + _union([f"SELECT '{t}' AS table_name, count(*) AS n_rows FROM {t}" for t in LOADED]
                 + ["SELECT '_referencia', CAST(2 AS BIGINT)"]) + ") l",
        "table_definitions": BASE + _union(
            [f"SELECT '{t}' AS table_name, CAST({i} AS INTEGER) AS position, '{c}' AS column_name, '{k.lower()}' AS data_type, "
             + ("NULL" if t not in schemas.TABLE_COMMENTS else "'" + schemas.TABLE_COMMENTS[t].replace("'", "''") + "'")
             + f" AS table_comment, (SELECT count(*) FROM {t}) AS n_rows"
             for t in LOADED for i, (c, k) in enumerate(schemas.final_columns(t), 1)]),
        "purge_report": BASE + _union(
            [f"SELECT '{t}' AS table_name, count(*) AS before, "
             + ("count(*) AS after, CAST(0 AS BIGINT) AS removed, 'failed' AS status, true AS has_cause" if t == "pais"
                else "CAST(0 AS BIGINT) AS after, count(*) AS removed, 'emptied' AS status, false AS has_cause")
             + f" FROM {EXTRACT[t]}" for t in schemas.BASE_TABLES if t != "motivo"]
            + ["SELECT 'motivo', CAST(0 AS BIGINT), CAST(0 AS BIGINT), CAST(0 AS BIGINT), 'already_empty', false"]),
        "purge_summary": BASE + "SELECT count(*) AS total_left, 'pais' AS tables_with_rows FROM pais",
        "derived_state": BASE + _STATE,
        "archive_lines": FILES + "SELECT archive, entry, line FROM lines",
        "archive_manifest": FILES
        + "SELECT archive, count(DISTINCT entry) AS n_entries, CAST(sum(length(line) + 1) AS BIGINT) "
        "AS uncompressed_bytes FROM lines GROUP BY archive",
        "archive_entry_status": FILES
        + "SELECT archive, count(DISTINCT entry) AS n_entries, "
        f"count(DISTINCT CASE WHEN NOT {GONE} THEN entry END) AS n_present, "
        f"count(*) FILTER (WHERE {GONE}) = 0 AS all_present FROM lines GROUP BY archive",
        "entries_missing": FILES + f"SELECT DISTINCT archive, entry FROM lines WHERE {GONE}",
        "links_all": "WITH " + LINKS + "SELECT page_id, link_pos, href FROM links",
        "links_resolved": "WITH " + LINKS
        + "SELECT page_id, link_pos, href, CASE WHEN starts_with(href, 'http') THEN href ELSE url || href END "
        "AS resolved_url FROM links UNION ALL SELECT page_id, 0, url, url FROM pages",
        "latest_link": "WITH " + LINKS
        + f"SELECT {HOST} AS host, max(href) AS latest_href, "
        "count(*) AS n_links FROM links WHERE starts_with(href, '/') GROUP BY 1",
        "latest_folder_archives": f"""WITH p AS (SELECT page_id, {HOST} AS host,
    '202' || (page_id % 3) || '-0' || (page_id % 7 + 1) || '/' AS folder FROM pages),
latest AS (SELECT host, max(folder) AS folder FROM p GROUP BY host)
SELECT p.host, 'http://' || p.host || '/' || p.folder AS folder_url, page_id || '.zip' AS href,
  'http://' || p.host || '/' || p.folder || page_id || '.zip' AS resolved_url
FROM p JOIN latest ON p.host = latest.host AND p.folder = latest.folder WHERE page_id % 5 <> 0""",
        "live_latest_companies": BASE
        + "SELECT cnpj_basico, left(razao_social, 40) AS razao_social, porte_empresa FROM empresas_raw "
        "ORDER BY cnpj_basico DESC NULLS FIRST, razao_social DESC NULLS FIRST LIMIT 3",
        "live_counts": FILES + "SELECT table_name, count(*) AS n_rows, CAST(0 AS BIGINT) AS n_rejected FROM lines GROUP BY table_name",
        "live_latest_establishments": BASE
        + "SELECT cnpj_basico, left(nome_fantasia, 30) AS nome_fantasia, uf, municipio FROM estabelecimento "
        "ORDER BY cnpj_basico DESC NULLS FIRST, cnpj DESC NULLS FIRST LIMIT 5",
    }
)
