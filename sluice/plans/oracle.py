"""DuckDB twins of the registered queries (``oracle_sql``), written by hand.

They run over the same parquet tables as views. File-based twins read
the sf0.01 folder with ``read_blob`` (the oracle runs at that scale).
"""

from __future__ import annotations

import json

from sluice.operators.extract import HOSTED_PREFIX, json_schema_of
from sluice.plans import specs
from sluice.plans.fixtures import EXTENSIONS, STEMS

ORACLE_DIR = "/root/testdata/sf0.01"


def _q(s: str) -> str:
    """A SQL string literal; newlines become ``chr(10)``."""
    parts = s.split("\n")
    lits = ["'" + p.replace("'", "''") + "'" for p in parts]
    return " || chr(10) || ".join(lits)


def _case(expr: str, values: list[str]) -> str:
    whens = " ".join(f"WHEN {i} THEN {_q(v)}" for i, v in enumerate(values))
    return f"CASE {expr} {whens} END"


LANDING = f"""
base AS (
  SELECT doc_id AS src_id, text, lang, n_chars, source,
         {_case('doc_id % 6', STEMS)} AS stem,
         {_case('(doc_id // 6) % 5', EXTENSIONS)} AS ext
  FROM documents
),
named AS (
  SELECT *, '/landing/' || source || '/' || lang || '/' || stem || '_' || CAST(src_id AS VARCHAR) || ext AS uri,
         CASE ext WHEN '.pdf' THEN 'application/pdf' WHEN '.PDF' THEN '' WHEN '.txt' THEN 'text/plain' END AS mime_type,
         CASE ext WHEN '.PDF' THEN 'application/pdf' END AS content_type
  FROM base
),
landing AS (
  SELECT *, sha256(uri) AS doc_id,
         regexp_extract(uri, '[^/]*$') AS filename,
         CASE WHEN contains(regexp_extract(uri, '[^/]*$'), '.')
              THEN lower(regexp_extract(regexp_extract(uri, '[^/]*$'), '[^.]*$')) ELSE '' END AS extension,
         coalesce(nullif(mime_type, ''), content_type) AS mime
  FROM named
)"""

META_JSON = """('{"source":"landing","lang":"' || lang || '"'
  || coalesce(',"mime_type":"' || mime_type || '"', '')
  || coalesce(',"content_type":"' || content_type || '"', '') || '}')"""

RULES_CASE = """(CASE
  WHEN extension IN ('pdf') AND regexp_matches(filename, '(?i)invoice') THEN 'invoice'
  WHEN extension IN ('pdf', 'docx') AND regexp_matches(filename, '(?i)(contract|agreement|msa)') THEN 'contract'
  WHEN extension IN ('txt') THEN 'plain' END)"""

# Flagship routing: exact label, else the default pipeline.
ROUTE_CASE = """(CASE {dt} WHEN 'invoice' THEN 'invoice_pipeline' WHEN 'contract' THEN 'contract_pipeline'
  ELSE 'unclassified_pipeline' END)"""

def _lang_ctes() -> str:
    """CTEs ending in ``lang(uri, lang_label)``: keyword counts per document from
    its tokens via ``unnest`` and ``GROUP BY`` (no list lambdas, so any DuckDB
    version runs it); highest count wins, ties to the earlier label, none → NULL."""
    counts, names = [], []
    for i, (label, kws) in enumerate(specs.LANGUAGE_KEYWORDS.items()):
        inlist = ", ".join(_q(k) for k in kws)
        counts.append(f"count(t.w) FILTER (WHERE t.w IN ({inlist})) AS s{i}")
        names.append(label)
    best = "greatest(" + ", ".join(f"s{i}" for i in range(len(names))) + ")"
    whens = " ".join(f"WHEN s{i} = {best} THEN {_q(label)}" for i, label in enumerate(names))
    return f"""toks AS (SELECT uri, unnest(regexp_split_to_array(lower(text), '[^\\p{{L}}\\p{{N}}]+')) AS w FROM landing),
counts AS (SELECT l.uri, {", ".join(counts)} FROM landing l LEFT JOIN toks t ON t.uri = l.uri GROUP BY l.uri),
lang AS (SELECT uri, CASE WHEN {best} = 0 THEN NULL {whens} END AS lang_label FROM counts)"""


SCRIPT_STYLE = r"(?is)<(script|style)[^>]*>.*?</(script|style)>"
COMMENT = r"(?s)<!--.*?-->"
TAG = r"<[^>]*>"
SPACE_RUN = r"[ \t\r\n]+"
TITLE = r"(?is)<title[^>]*>(.*?)</title>"
# Elements are counted by their opening tags.
HEADING = r"(?i)<h[1-6][ >]"
PARAGRAPH = r"(?i)<p[ >]"
LOOKS_HTML = r"(?i)^[ \t\r\n]*<(!doctype|html|head|body)"
ENTITY_PAIRS = [("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&nbsp;", " "),
                ("&copy;", "©"), ("&middot;", "·"), ("&amp;", "&")]


def _entities(x: str) -> str:
    for ent, ch in ENTITY_PAIRS:
        x = f"replace({x}, {_q(ent)}, {_q(ch)})"
    return x


def _squash(x: str) -> str:
    return f"trim(regexp_replace({x}, '{SPACE_RUN}', ' ', 'g'))"


def _inner(x: str) -> str:
    return _squash(_entities(f"regexp_replace({x}, '{TAG}', ' ', 'g')"))


def _no_code(html: str) -> str:
    no_code = f"regexp_replace({html}, '{SCRIPT_STYLE}', ' ', 'g')"
    return f"regexp_replace({no_code}, '{COMMENT}', ' ', 'g')"


def _visible(html: str) -> str:
    return _inner(_no_code(html))


def _page_columns(html: str = "html") -> dict[str, str]:
    is_html = f"regexp_matches({html}, '{LOOKS_HTML}')"
    has = f"strlen({html}) > 0"
    text = f"CASE WHEN {is_html} THEN {_visible(html)} ELSE {html} END"
    return {
        "title": f"CASE WHEN {has} AND {is_html} THEN nullif({_inner(f'regexp_extract({html}, {_q(TITLE)}, 1)')}, '') END",
        "text": f"CASE WHEN {has} THEN {text} END",
        "n_headings": f"CASE WHEN {has} THEN CASE WHEN {is_html} THEN len(regexp_extract_all({_no_code(html)}, {_q(HEADING)})) ELSE 0 END END",
        "n_paragraphs": f"CASE WHEN {has} THEN CASE WHEN {is_html} THEN len(regexp_extract_all({_no_code(html)}, {_q(PARAGRAPH)})) ELSE 1 END END",
    }


# Pages cut at every "<"; what a piece begins with tells a tag from text, and running maxima tell script bodies.
PAGE_STRUCTURE = f"""WITH cut AS (
  SELECT url, unnest(string_split(html, '<')) AS piece, generate_subscripts(string_split(html, '<'), 1) AS k FROM pages),
tag AS (
  SELECT url, k, piece, strpos(piece, '>') AS stop, lower(left(ltrim(piece, '/'), 1)) AS c,
         lower(split_part(split_part(replace(ltrim(piece, '/'), '/', ' '), '>', 1), ' ', 1)) AS name, left(piece, 1) = '/' AS closing
  FROM cut),
marked AS (
  SELECT *, k > 1 AND stop > 0 AND (c BETWEEN 'a' AND 'z' OR left(piece, 1) IN ('!', '?')) AS is_tag FROM tag),
told AS (
  SELECT *, coalesce(max(CASE WHEN is_tag AND NOT closing AND name IN ('script', 'style') THEN k END) OVER w, 0)
          > coalesce(max(CASE WHEN is_tag AND closing AND name IN ('script', 'style') THEN k END) OVER w, 0) AS hidden,
         CASE WHEN NOT is_tag THEN CASE WHEN k > 1 THEN '<' ELSE '' END || piece
              WHEN starts_with(piece, '!--') THEN substr(piece, strpos(piece, '-->') + 3)
              ELSE CASE WHEN name IN ('a', 'b') THEN '' ELSE ' ' END || substr(piece, stop + 1) END AS rest
  FROM marked WINDOW w AS (PARTITION BY url ORDER BY k)),
grouped AS (
  SELECT *, sum(CASE WHEN is_tag AND NOT hidden AND name IN ('html', 'head', 'title', 'body', 'nav', 'ul', 'li', 'div', 'article',
                                                              'h1', 'p', 'footer') THEN 1 ELSE 0 END) OVER (PARTITION BY url ORDER BY k) AS block,
         sum(CASE WHEN hidden OR NOT is_tag OR name <> 'ul' THEN 0 WHEN closing THEN -1 ELSE 1 END) OVER (PARTITION BY url ORDER BY k) AS lists
  FROM told),
blocks AS (
  SELECT url, block, arg_min(CASE WHEN closing THEN '/' ELSE '' END || name, k) AS name, arg_min(lists, k) AS lists,
         {_squash(_entities("string_agg(CASE WHEN hidden THEN ' ' ELSE rest END, '' ORDER BY k)"))} AS content
  FROM grouped GROUP BY url, block),
shown AS (
  SELECT url, block, lists, content, CASE name WHEN 'h1' THEN 'heading' WHEN 'p' THEN 'paragraph' WHEN 'li' THEN 'list_item' END AS type
  FROM blocks)
SELECT url AS uri, nullif(any_value(b.title), '') AS title, CAST(length(any_value(b.text)) AS BIGINT) AS text_chars,
       md5(any_value(b.text)) AS text_md5, count(*) FILTER (WHERE type = 'heading') AS n_headings,
       count(*) FILTER (WHERE type = 'paragraph') AS n_paragraphs, count(*) FILTER (WHERE type = 'list_item') AS n_list_items,
       md5(string_agg(type || ':' || lists || ':' || content, '|' ORDER BY block) FILTER (WHERE type IS NOT NULL)) AS elements_md5
FROM shown JOIN (
  SELECT url, {_squash(_entities("string_agg(CASE WHEN hidden THEN ' ' ELSE rest END, '' ORDER BY k)"))} AS text FROM told GROUP BY url) t USING (url)
JOIN (SELECT url, max(CASE WHEN name = 'title' THEN content END) AS title FROM blocks GROUP BY url) x USING (url), LATERAL (
  SELECT t.text, x.title) b
GROUP BY url"""


def _text_json() -> str:
    return "to_json(struct_pack(text := text, length := CAST(length(text) AS INTEGER)))"


def _files(glob: str | list[str], md5: bool = True, flag: bool = False, distinct: bool = False) -> str:
    src = (f"'{ORACLE_DIR}/{glob}'" if isinstance(glob, str)
           else "[" + ", ".join(f"'{ORACLE_DIR}/{g}'" for g in glob) + "]")
    name = "regexp_extract(filename, '[^/]*$')"
    cols = [f"{name} AS filename",
            f"CASE WHEN contains({name}, '.') THEN lower(regexp_extract({name}, '[^.]*$')) ELSE '' END AS extension",
            "CAST(size AS BIGINT) AS size_bytes"]
    if md5:
        cols.append("md5(content) AS content_md5")
    if flag:
        cols.append("false AS has_content")
    return f"SELECT {'DISTINCT ' if distinct else ''}{', '.join(cols)} FROM read_blob({src})"


def _events(where: str = "") -> str:
    return f"""SELECT 'event://' || CAST(event_id AS VARCHAR) AS uri, ts, event_type,
  CAST(user_id AS VARCHAR) AS user_id, CAST(strlen(props) AS BIGINT) AS content_bytes
FROM events {where}"""


MARK = "TIMESTAMP '2024-01-15 00:00:00'"


def _flow(select: str, where: str = "", tail: str = "") -> str:
    return f"""WITH {LANDING},
flow AS (SELECT *, {RULES_CASE} AS doc_type FROM landing),
routed AS (SELECT *, {ROUTE_CASE.format(dt='doc_type')} AS pipeline_name FROM flow)
SELECT {select} FROM routed {where} {tail}"""


def oracle_sql() -> dict[str, str]:
    lang = _lang_ctes()
    page = _page_columns()
    web_rules = """(CASE WHEN CASE WHEN contains(regexp_extract(url, '[^/]*$'), '.')
      THEN lower(regexp_extract(regexp_extract(url, '[^/]*$'), '[^.]*$')) ELSE '' END IN ('html') THEN 'html_page'
    WHEN regexp_matches(url, '(spam-farm|cheap-pills)') THEN 'spam' END)"""
    email, ip, card, phone = (f["pattern"] for f in specs.PII_FIELDS)
    cut = "text"
    schema_json = json.dumps(json_schema_of(specs.PII_FIELDS))
    prompt = f"({_q(HOSTED_PREFIX.format(schema=schema_json))} || {cut})"
    short = f"length(text) < {specs.MIN_CHARS}"
    return {
        "doc_normalize": f"""WITH {LANDING}
SELECT doc_id, uri, filename, extension, CAST(strlen(text) AS BIGINT) AS content_bytes,
       md5(text) AS content_md5, {META_JSON} AS metadata_json FROM landing""",
        "files_scan": _files("*.parquet"),
        "files_pattern": _files(["n*.parquet", "*ion*.parquet"], md5=False, distinct=True),
        "files_no_content": _files("*.parquet", md5=False, flag=True),
        "files_incremental": f"""WITH {LANDING}
SELECT uri, doc_id FROM landing
WHERE uri NOT IN (SELECT l.uri FROM landing l JOIN labels b ON l.src_id = b.doc_id)""",
        "files_stream": _files("*.parquet"),
        "files_stream_formats": """SELECT 'json' AS kind, 'json://' || doc_id AS uri, md5(text) AS content_md5, lang,
       CAST(n_chars AS VARCHAR) AS n_chars, CAST(NULL AS VARCHAR) AS line FROM documents
UNION ALL SELECT 'text', NULL, NULL, NULL, NULL, concat_ws(chr(9), doc_id, source) FROM documents""",
        "files_incremental_passes": f"""WITH {LANDING}
SELECT src_id % 3 AS pass, CASE WHEN src_id % 3 = 1 THEN '.' ELSE '' END || doc_id || '.' ||
       CASE WHEN extension = '' THEN 'bin' ELSE extension END AS name, CAST(0 AS BIGINT) AS n_errors,
       CAST(strlen(text) AS BIGINT) AS size_bytes, md5(text) AS content_md5 FROM landing
UNION ALL SELECT k, 'empty-' || k || '.txt', 0, 0, md5('') FROM range(3) AS r(k)""",
        "landing_increment": _events(f"WHERE ts > {MARK}"),
        "landing_watermark": f"""SELECT {MARK} AS old_mark, coalesce(max(ts), {MARK}) AS new_mark, count(*) AS n_new
FROM events WHERE ts > {MARK}""",
        "landing_stream": _events(),
        "landing_append": _events(),
        "submissions_ingest": """SELECT 'conv://' || CAST(conv_id AS VARCHAR) || '/' || CAST(turn AS VARCHAR) AS uri,
  role, 'api' AS source,
  CASE WHEN role <> 'system' THEN CAST(strlen(text) AS BIGINT) END AS content_bytes,
  CASE WHEN role <> 'system' THEN md5(text) END AS content_md5
FROM conversations""",
        "submissions_stream": """SELECT DISTINCT 'conv://' || CAST(conv_id AS VARCHAR) || '/' || CAST(turn AS VARCHAR) AS uri,
  role, 'api' AS source,
  CASE WHEN role <> 'system' THEN CAST(strlen(text) AS BIGINT) END AS content_bytes,
  CASE WHEN role <> 'system' THEN md5(text) END AS content_md5
FROM conversations""",
        "stream_stats": """WITH counted AS (
  SELECT 'files' AS stream, count(*) AS n, 0 AS bad FROM documents
  UNION ALL SELECT 'landing', count(*), 0 FROM documents
  UNION ALL SELECT 'submissions', count(*), count(*) FILTER (WHERE role = 'user') FROM conversations)
SELECT stream, n AS discovered, CAST(0 AS BIGINT) AS received, CAST(0 AS BIGINT) AS unrouted, n - bad AS processed,
       CAST(bad AS BIGINT) AS failed, 'run-0' AS run_id FROM counted""",
        "rule_extension": f"""WITH {LANDING}
SELECT uri, extension, extension IN ('pdf') AS is_pdf, extension IN ('pdf', 'docx') AS is_office,
       false AS is_none FROM landing""",
        "rule_mime": f"""WITH {LANDING}
SELECT uri, mime, coalesce(mime IN ('application/pdf'), false) AS is_pdf_mime,
       coalesce(mime IN ('text/plain', 'application/pdf'), false) AS is_known_mime FROM landing""",
        "rule_filename": f"""WITH {LANDING}
SELECT uri, filename, regexp_matches(filename, '(?i)invoice') AS is_invoice,
       regexp_matches(filename, '(?i)(contract|agreement|msa)') AS is_contract,
       regexp_matches(filename, '^notes_[0-9]+[.]txt$') AS is_notes_txt FROM landing""",
        "rule_path": f"""WITH {LANDING}
SELECT uri, regexp_matches(uri, '^/landing/src1[0-9]?/(en|de)/') AS matched FROM landing""",
        "rule_all_conditions": f"""WITH {LANDING}
SELECT uri, (extension IN ('pdf') AND coalesce(mime IN ('application/pdf'), false)
             AND regexp_matches(filename, '(?i)^(invoice|msa)') AND regexp_matches(uri, '/(en|fr)/')) AS m_all,
       true AS m_none FROM landing""",
        "rule_first_match": f"WITH {LANDING}\nSELECT uri, {RULES_CASE} AS doc_type FROM landing",
        "model_classify": f"WITH {LANDING},\n{lang}\nSELECT uri, lang_label AS label FROM lang",
        "udf_classifier": f"""WITH {LANDING}
SELECT uri, CASE WHEN strlen(text) < 100 THEN NULL WHEN contains(text, 'token = "') THEN 'secret'
                 WHEN strlen(text) - strlen(replace(text, chr(10), '')) > 20 THEN 'long_form' END AS doc_type
FROM landing""",
        "chain_first": f"""WITH {LANDING},
{lang}
SELECT l.uri, coalesce(CASE WHEN b.toxic = 1 THEN 'quarantine' END, {RULES_CASE}, g.lang_label) AS doc_type
FROM landing l JOIN lang g ON g.uri = l.uri LEFT JOIN labels b ON b.doc_id = l.src_id""",
        "chain_last": f"""WITH {LANDING},
{lang}
SELECT l.uri, coalesce(CASE WHEN l.n_chars > 20000 THEN 'oversized' END, g.lang_label, {RULES_CASE}) AS doc_type
FROM landing l JOIN lang g ON g.uri = l.uri""",
        "route_resolve": f"""WITH {LANDING}, flow AS (SELECT *, {RULES_CASE} AS doc_type FROM landing)
SELECT uri, doc_type, CASE doc_type WHEN 'invoice' THEN 'invoice_pipeline' WHEN 'contract' THEN 'contract_pipeline'
                      ELSE 'catchall_pipeline' END AS pipeline FROM flow""",
        "route_unrouted": f"""WITH {LANDING}, flow AS (SELECT *, {RULES_CASE} AS doc_type FROM landing)
SELECT uri, doc_type FROM flow WHERE doc_type IS NULL OR doc_type NOT IN ('invoice', 'contract')""",
        "route_fanout": _flow("uri, pipeline_name"),
        "route_strict": _flow("uri, pipeline_name AS pipeline"),
        "route_by_table": f"""WITH {LANDING}
SELECT uri, CASE WHEN lang IN ('en', 'de') THEN lang || '_pipeline' ELSE 'other_pipeline' END AS pipeline FROM landing""",
        "user_source": """SELECT 'event://' || CAST(event_id AS VARCHAR) AS uri, CAST(length(props) AS BIGINT) AS text_chars,
  md5(props) AS text_md5 FROM events""",
        "user_sink": _flow("uri, pipeline_name, CAST(length(text) AS BIGINT) AS text_chars"),
        "model_errors": f"""WITH {LANDING}
SELECT uri, CASE WHEN stem = 'Invoice' THEN 'invoice' WHEN stem NOT IN ('scan', 'memo') THEN 'contract' END AS doc_type,
       CASE WHEN stem = 'scan' THEN 'model timed out' END AS error FROM landing""",
        "extract_bad_reply": f"""WITH {LANDING}
SELECT uri, CASE WHEN stem NOT IN ('scan', 'memo', 'notes') THEN filename END AS vendor_name,
       CASE WHEN stem NOT IN ('scan', 'memo', 'notes') THEN CAST(1.5 AS DOUBLE) END AS total_amount,
       CASE WHEN stem = 'scan' THEN 'model timed out' WHEN stem IN ('memo', 'notes')
            THEN 'extraction: model response did not include the expected structured output' END AS error FROM landing""",
        "dedicated_pipeline": f"""SELECT url AS uri, {web_rules} AS doc_type, {page['title']} AS title,
  CAST(length({page['text']}) AS BIGINT) AS text_chars FROM pages""",
        "parse_text": f"""WITH {LANDING}
SELECT uri, CAST(length(text) AS BIGINT) AS text_chars, md5(text) AS text_md5 FROM landing""",
        "parse_document": PAGE_STRUCTURE,
        "extract_fields": f"""WITH {LANDING}
SELECT uri, nullif(regexp_extract({cut}, {_q(email)}), '') AS email,
       nullif(regexp_extract({cut}, {_q(ip)}), '') AS ip,
       nullif(regexp_extract({cut}, {_q(card)}), '') AS card,
       CASE WHEN len(regexp_extract_all({cut}, {_q(phone)})) > 0
            THEN array_to_string(regexp_extract_all({cut}, {_q(phone)}), '|') END AS phones,
       false AS failed FROM landing""",
        "extract_prompt": f"""WITH {LANDING}
SELECT uri, CAST(length({prompt}) AS BIGINT) AS prompt_chars, md5({prompt}) AS prompt_md5 FROM landing""",
        "extract_map": f"""WITH {LANDING}
SELECT uri, CASE WHEN NOT {short} THEN CAST(strlen(text) - strlen(replace(text, chr(10), '')) + 1 AS VARCHAR) END AS n_lines,
       CASE WHEN NOT {short} THEN CAST(length(text) AS VARCHAR) END AS n_chars,
       CASE WHEN {short} THEN 'too short' END AS error FROM landing""",
        "udf_parser": f"""WITH {LANDING}
SELECT uri, CAST(strlen(text) - strlen(replace(text, chr(10), '')) + 1 AS BIGINT) AS n_lines,
       split_part(text, ' ', 1) AS first_word, false AS failed FROM landing""",
        "sink_table": _flow(f"doc_id, uri, doc_type, {META_JSON} AS metadata_json, md5({_text_json()}) AS extracted_md5, "
                            "pipeline_name, 'run-0' AS run_id"),
        "sink_json": _flow("uri, doc_type, pipeline_name, CAST(0 AS BIGINT) AS n_errors, "
                           f"CAST(length(text) AS BIGINT) AS text_chars, md5(text) AS text_md5, {META_JSON} AS metadata_json"),
        "sink_content": f"""WITH {LANDING}
SELECT doc_id || '.' || CASE WHEN extension = '' THEN 'bin' ELSE extension END AS name, md5(text) AS content_md5
FROM landing""",
        "multi_sink": _flow(f"'table' AS sink, uri, pipeline_name, {META_JSON} AS metadata_json, md5(text) AS text_md5") + " UNION ALL " +
                      f"SELECT 'json' AS sink, uri, pipeline_name, {META_JSON} AS metadata_json, md5(text) AS text_md5 FROM routed",
        "on_error_skip": _flow("uri, pipeline_name, CAST(length(text) AS BIGINT) AS text_chars", f"WHERE NOT {short}"),
        "on_error_dead_letter": _flow("uri, pipeline_name, 'too short' AS error", f"WHERE {short}"),
        "on_error_fail": _flow("uri, pipeline_name"),
        "router_rerun": _flow(f"uri, doc_type, pipeline_name, md5(text) AS text_md5, {META_JSON} AS metadata_json, 'run-0' AS run_id"),
        "router_stream_dead_letter": _flow(f"uri, pipeline_name, 'too short' AS error, {META_JSON} AS metadata_json, "
                                           "'run-0' AS run_id", f"WHERE {short}"),
        "router_stream_replay": _flow(f"doc_id, uri, doc_type, {META_JSON} AS metadata_json, md5({_text_json()}) AS extracted_md5, "
                                      "pipeline_name, 'run-0' AS run_id"),
        "sink_overwrite_twice": _flow(f"'table' AS sink, uri, doc_type, pipeline_name, md5({_text_json()}) AS extracted_md5",
                                      "WHERE doc_type = 'contract'") +
                                " UNION ALL SELECT 'json' AS sink, uri, doc_type, pipeline_name, md5(text) AS extracted_md5 FROM routed "
                                "WHERE doc_type = 'contract'",
        "router_stream_table": _flow(f"doc_id, uri, doc_type, {META_JSON} AS metadata_json, md5({_text_json()}) AS extracted_md5, "
                                     "pipeline_name, 'run-0' AS run_id"),
        "run_stats": f"""WITH {LANDING}, flow AS (SELECT *, {RULES_CASE} AS doc_type FROM landing),
routed AS (SELECT *, coalesce(doc_type IN ('invoice', 'contract'), false) AS is_routed FROM flow)
SELECT count(*) AS discovered, count(*) AS received, count(*) FILTER (WHERE NOT is_routed) AS unrouted,
       count(*) FILTER (WHERE is_routed AND NOT {short}) AS processed,
       count(*) FILTER (WHERE is_routed AND {short}) AS failed, 'run-0' AS run_id FROM routed""",
        "router_batch": _flow("pipeline_name, doc_type, count(*) AS n_docs, CAST(sum(length(text)) AS BIGINT) AS text_chars",
                              tail="GROUP BY pipeline_name, doc_type"),
        "router_stream": _flow("pipeline_name, doc_type, count(*) AS n_docs, CAST(sum(length(text)) AS BIGINT) AS text_chars",
                               tail="GROUP BY pipeline_name, doc_type"),
        "gold_tables": _flow("pipeline_name AS table_name, uri, doc_type, CAST(length(text) AS BIGINT) AS text_chars, "
                             "md5(text) AS text_md5"),
    }
