"""SQL that states each registered query's result independently, for DuckDB on the same tables.

Parsing is checked against DuckDB's own JSON functions; extraction and repair against what the
response shapes of the fixture must give.
"""

from __future__ import annotations

import re
import string

from tessella.functions.text import WHITESPACE
from tessella.operators.responses import INSTRUCTION
from tessella.plans.fixtures import SOURCE_SHAPES, with_fixtures
from tessella.plans.registry import PRIORITY, SYMBOLS, TEMPLATES

ORACLE: dict[str, str] = {}

_SPACE = "||".join(f"chr({ord(c)})" for c in WHITESPACE)
_NL = "chr(10)"
_PRETTY_SYMBOLS = f"""'[{{0}}  {{{{{{0}}    "symbolName": "t",{{0}}    "symbolKind": "variable"{{0}}  }}}}{{0}}]'""".format(
    f"' || {_NL} || '"
)


def _input(code: str, symbols: str) -> str:
    """The input frame around a source and a laid-out symbol list."""
    return (
        f"'**Swift Source Code:**' || {_NL} || '```swift' || {_NL} || {code} || {_NL} || '```' || {_NL} || {_NL} || "
        f"'**AST Symbol Information (JSON):**' || {_NL} || '```' || {_NL} || {symbols} || {_NL} || '```'"
    )


def _pct(part: str, whole: str) -> str:
    return f"round({part} * 100.0 / nullif({whole}, 0), 6)"


_STATS = """
    count(*) AS total, count(*) FILTER (valid) AS valid, count(*) FILTER (NOT valid) AS invalid,
    count(*) FILTER (category = 'secure') AS secure, count(*) FILTER (category = 'vulnerable') AS vulnerable"""
_USES = """
    uses AS (SELECT dataset, entry_id, item, pos FROM (SELECT dataset, entry_id, unnest(items) AS item,
             unnest(range(len(items))) AS pos FROM parsed WHERE category = 'vulnerable')),
    counts AS (SELECT dataset, item AS identifier, count(*) AS n, min(entry_id) AS first_entry,
               min(entry_id * 1000000 + pos) AS first_seen FROM uses GROUP BY ALL),
    totals AS (SELECT dataset, count(*) AS unique_ids, CAST(sum(n) AS BIGINT) AS instances FROM counts GROUP BY ALL),
    ranked AS (SELECT *, CAST(row_number() OVER (PARTITION BY dataset ORDER BY n DESC, first_seen) AS INTEGER) AS rank FROM counts),
    stats AS (SELECT dataset, """ + _STATS + """ FROM parsed GROUP BY dataset)"""
_BUCKETS = """
    binned AS (SELECT dataset, CASE WHEN reasoning_len <= 100 THEN 0 WHEN reasoning_len <= 200 THEN 1
        WHEN reasoning_len <= 400 THEN 2 WHEN reasoning_len <= 600 THEN 3 ELSE 4 END AS bucket
        FROM parsed WHERE reasoning_len IS NOT NULL),
    buckets AS (SELECT dataset, bucket, ['Very Short', 'Short', 'Medium', 'Long', 'Very Long'][bucket + 1] AS label,
        count(*) AS n FROM binned GROUP BY ALL)"""


def _on_parsed(body: str, extra: str = "") -> str:
    return with_fixtures(body, "parsed").replace("\nSELECT", (", " + extra if extra else "") + "\nSELECT", 1)


def _lengths(column: str, where: str) -> str:
    return _on_parsed(
        f"""SELECT dataset, min({column}) AS min_len, max({column}) AS max_len, round(avg({column}), 6) AS mean_len,
        round(median({column}), 6) AS median_len FROM parsed WHERE {where} GROUP BY dataset"""
    )


# --- datasets -----------------------------------------------------------------------------------

ORACLE["entry_lines"] = with_fixtures(
    """SELECT line_no, 'find' AS instruction, md5(rs) AS input_md5,
       CASE WHEN line_no % 9 <> 6 THEN md5(good) END AS output_md5 FROM lines WHERE line_no % 9 NOT BETWEEN 2 AND 5""",
    "lines",
)
ORACLE["entry_line_rejects"] = with_fixtures(
    """SELECT line_no, CASE line_no % 9 WHEN 3 THEN 'not_object' WHEN 5 THEN 'output_not_text' ELSE 'not_json' END AS reject,
       md5(trim(CASE line_no % 9 WHEN 2 THEN entry || ' xx' WHEN 3 THEN '["' || rs || '"]'
           WHEN 4 THEN '{"instruction":"find","input":"' || rs
           ELSE '{"instruction":"find","input":"' || rs || '","output":7}' END)) AS line_md5
       FROM lines WHERE line_no % 9 IN (2, 3, 4, 5)""",
    "lines",
)
ORACLE["dataset_selection"] = with_fixtures("SELECT dataset, entry_id FROM entries WHERE dataset = 'gen_b'", "entries")
ORACLE["combined_entries"] = with_fixtures(
    "SELECT 'combined' AS dataset, dataset AS part, entry_id, md5(output) AS output_md5 FROM entries", "entries"
)
ORACLE["parsed_outputs"] = _on_parsed(
    """SELECT dataset, entry_id, valid, category, n_items, reasoning_len, array_to_string(items, '|') AS items FROM parsed"""
)
ORACLE["category_counts"] = _on_parsed("SELECT dataset, category, count(*) AS n FROM parsed GROUP BY ALL")
ORACLE["basic_stats"] = _on_parsed(
    f"SELECT dataset, total, valid, invalid, {_pct('valid', 'total')} AS success_pct FROM stats", _USES
)
ORACLE["class_split"] = _on_parsed(
    f"""SELECT dataset, secure, vulnerable, {_pct('secure', 'valid')} AS secure_pct,
        {_pct('vulnerable', 'valid')} AS vulnerable_pct FROM stats""",
    _USES,
)
ORACLE["count_distribution"] = _on_parsed(
    f"""SELECT dataset, n_items, count(*) AS n, {_pct('count(*)', 'sum(count(*)) OVER (PARTITION BY dataset)')} AS pct
        FROM parsed WHERE category = 'vulnerable' GROUP BY dataset, n_items"""
)
ORACLE["count_stats"] = _lengths("n_items", "category = 'vulnerable'")
ORACLE["reasoning_stats"] = _lengths("reasoning_len", "reasoning_len IS NOT NULL")
ORACLE["length_histogram"] = _on_parsed(
    f"SELECT dataset, bucket, label, n, {_pct('n', 'sum(n) OVER (PARTITION BY dataset)')} AS pct FROM buckets", _BUCKETS
)
ORACLE["top_identifiers"] = _on_parsed(
    f"""SELECT dataset, rank, identifier, n, {_pct('n', 'instances')} AS pct
        FROM ranked JOIN totals USING (dataset) WHERE rank <= 15""",
    _USES,
)
ORACLE["identifier_frequency"] = _on_parsed("SELECT dataset, identifier, n, first_entry FROM counts", _USES)
ORACLE["diversity"] = _on_parsed(
    "SELECT dataset, unique_ids, instances, round(instances / unique_ids, 6) AS avg_frequency FROM totals", _USES
)
ORACLE["merged_sketch_stats"] = _on_parsed(
    """SELECT dataset, total, valid, instances, true AS ids_ok, true AS items_ok, true AS lengths_ok, true AS top_ok
       FROM stats JOIN totals USING (dataset)""",
    _USES,
)
ORACLE["dataset_comparison"] = _on_parsed(
    """SELECT dataset, total, valid, secure, vulnerable, coalesce(unique_ids, 0) AS unique_ids
       FROM stats LEFT JOIN totals USING (dataset)""",
    _USES,
)
ORACLE["percent_comparison"] = _on_parsed(
    f"""SELECT dataset, {_pct('valid', 'total')} AS success_pct, {_pct('secure', 'valid')} AS secure_pct,
        {_pct('vulnerable', 'valid')} AS vulnerable_pct FROM stats""",
    _USES,
)
ORACLE["category_members"] = _on_parsed("SELECT dataset, category, entry_id FROM parsed WHERE valid")
ORACLE["dataset_totals"] = with_fixtures("SELECT dataset, count(*) AS total FROM entries GROUP BY ALL", "entries")
ORACLE["full_report"] = _on_parsed(
    """SELECT dataset, total, valid, invalid, secure, vulnerable, unique_ids, instances,
        (SELECT max(n_items) FROM parsed p WHERE p.dataset = stats.dataset AND category = 'vulnerable') AS items_max,
        (SELECT max(reasoning_len) FROM parsed p WHERE p.dataset = stats.dataset) AS reasoning_max,
        (SELECT string_agg(identifier || ':' || n, '|' ORDER BY rank) FROM ranked r WHERE r.dataset = stats.dataset AND rank <= 15) AS top,
        (SELECT string_agg(label || ':' || n, '|' ORDER BY bucket) FROM buckets b WHERE b.dataset = stats.dataset) AS buckets
        FROM stats LEFT JOIN totals USING (dataset)""",
    _USES + "," + _BUCKETS,
)
ORACLE["report_file"] = _on_parsed(
    """SELECT dataset, total, unique_ids, (SELECT identifier FROM ranked r WHERE r.dataset = stats.dataset AND rank = 1)
        AS top_identifier, valid AS members FROM stats LEFT JOIN totals USING (dataset)""",
    _USES,
)
_GOOD_LINES = "SELECT *, CASE WHEN line_no % 2 = 0 THEN 'gen_a' ELSE 'gen_b' END AS dataset FROM lines WHERE line_no % 9 NOT BETWEEN 2 AND 5"
ORACLE["entry_file_round_trip"] = with_fixtures(
    f"""SELECT dataset, md5(rs) AS input_md5, CASE WHEN line_no % 9 <> 6 THEN md5(good) END AS output_md5, count(*) AS n
        FROM ({_GOOD_LINES}) GROUP BY ALL""",
    "lines",
)
_MD5_LINES = f"""(SELECT dataset AS project, md5(rs) AS input_md5, CASE WHEN line_no % 9 <> 6 THEN md5(good) END AS output_md5
    FROM ({_GOOD_LINES}))"""
ORACLE["project_file_round_trip"] = with_fixtures(
    f"""SELECT *, count(*) AS n FROM (SELECT * FROM {_MD5_LINES} UNION ALL SELECT * REPLACE ('all' AS project) FROM {_MD5_LINES})
        GROUP BY ALL""",
    "lines",
)
ORACLE["stored_dataset_stats"] = ORACLE["basic_stats"]

# --- manifest -----------------------------------------------------------------------------------

ORACLE["pattern_index"] = ORACLE["catalog_file_scan"] = with_fixtures(
    "SELECT category, domain, idx, pattern_id, text, sensitive FROM patterns", "catalog"
)
ORACLE["class_sizes"] = with_fixtures(
    """SELECT CASE WHEN sensitive THEN 'sensitive' ELSE 'other' END AS class, count(*) AS n,
       count(DISTINCT category) AS categories FROM patterns GROUP BY ALL""",
    "catalog",
)
for _kind in ("single", "pair", "mixed"):
    ORACLE[f"{_kind}_tasks"] = with_fixtures(
        f"SELECT filename, task_type, concat_ws('|', text1, text2) AS texts FROM {_kind}_tasks", "catalog"
    )
ORACLE["manifest_tasks"] = with_fixtures(
    """SELECT filename, task_type || '*' AS task_type, concat_ws('|', text1, text2) AS texts,
       CASE task_type WHEN 'Pure_nC1' THEN 0 WHEN 'Pure_nC2' THEN 1 ELSE 2 END AS branch FROM manifest""",
    "catalog",
)
ORACLE["manifest_summary"] = with_fixtures(
    "SELECT task_type, count(*) AS n FROM manifest GROUP BY ROLLUP (task_type)", "catalog"
)
_SAMPLES = """(SELECT *, filename || '_' || polarity AS base_filename FROM manifest, (VALUES ('gen_a'), ('gen_b')) g(generator),
    (VALUES ('positive'), ('negative')) p(polarity))"""
ORACLE["sample_expansion"] = with_fixtures(
    f"SELECT generator, filename, polarity, base_filename FROM {_SAMPLES}", "catalog"
)
_SLOTS = {
    "{pattern}": "text1", "{pattern1}": "text1", "{pattern2}": "text2",
    "{sensitive_pattern}": "text1", "{nonsensitive_pattern}": "text2",
}


def _prompt_case() -> str:
    cases = []
    for (task_type, polarity), template in TEMPLATES.items():
        expr = f"'{template}'"
        for slot, column in _SLOTS.items():
            expr = expr.replace(slot, f"' || {column} || '")
        cases.append(f"WHEN task_type = '{task_type}' AND polarity = '{polarity}' THEN {expr}")
    return "CASE " + " ".join(cases) + " END"


ORACLE["generation_prompts"] = with_fixtures(
    f"SELECT generator, base_filename, {_prompt_case()} AS prompt FROM {_SAMPLES}", "catalog"
)
ORACLE["artifact_layout"] = with_fixtures(
    f"""SELECT generator, base_filename,
        'output/generated_code/' || generator || '_generated/' || base_filename || '.swift' AS code_path,
        'output/outputs/' || generator || '_generated/' || base_filename || '.json' AS label_path,
        'output/inputs/' || generator || '_generated/' || base_filename || '.txt' AS prompt_path FROM {_SAMPLES}""",
    "catalog",
)

# --- requests and responses ---------------------------------------------------------------------

ORACLE["system_prompts"] = """SELECT conv_id, string_agg(text, chr(10) ORDER BY turn) FILTER (role = 'system') AS system_prompt
    FROM conversations GROUP BY conv_id"""
ORACLE["user_messages"] = "SELECT conv_id, turn, role, text FROM conversations WHERE role <> 'system'"
ORACLE["empty_requests"] = """SELECT doc_id AS conv_id FROM documents
    WHERE doc_id NOT IN (SELECT conv_id FROM conversations)"""
ORACLE["label_prompts"] = """SELECT doc_id, md5('Code:' || chr(10) || text || chr(10) || 'Symbols:' || chr(10) || '[]' || chr(10)
    || 'Answer {}') AS prompt_md5 FROM documents"""
ORACLE["fence_strip"] = f"""SELECT doc_id, false AS is_empty, md5(trim(text, {_SPACE})) AS code_md5 FROM documents
    UNION ALL SELECT doc_id, true, NULL FROM documents WHERE doc_id % 3 = 0"""

_VARIANTS = "SELECT request_id, attempt, CASE {} END AS {} FROM attempts"
ORACLE["fenced_json"] = with_fixtures(
    _VARIANTS.format("WHEN variant <= 1 THEN md5(good) WHEN variant = 5 THEN md5(bare)", "block_md5"), "responses"
)
ORACLE["balanced_json"] = with_fixtures(
    _VARIANTS.format("WHEN variant IN (0, 1, 2, 4, 5) THEN md5(good)", "object_md5"), "responses"
)
ORACLE["label_validation"] = with_fixtures(
    _VARIANTS.format("WHEN variant <= 5 THEN md5(good)", "label_md5"), "responses"
)
ORACLE["json_repair"] = with_fixtures(
    _VARIANTS.format(
        """WHEN variant <= 5 THEN md5(good) WHEN variant = 6 THEN md5(raw_response)
           WHEN variant = 7 THEN md5('{"reasoning":"x"}')""",
        "repaired_md5",
    ),
    "responses",
)
ORACLE["brace_slice"] = with_fixtures(
    _VARIANTS.format(
        """WHEN variant <= 3 THEN md5(good) WHEN variant IN (4, 5) THEN md5(bare)
           WHEN variant = 7 THEN md5('{"reasoning":"x"}')""",
        "slice_md5",
    ),
    "responses",
)
ORACLE["event_json_check"] = """SELECT event_id, json_valid(props) AS strict, json_valid(props || ' x') AS strict_with_tail,
    json_valid(props) AND coalesce(json_exists(props, '$.reasoning') AND json_exists(props, '$.identifiers'), false) AS is_label FROM events"""
_METHOD = "CASE variant WHEN 0 THEN 'fenced' WHEN 1 THEN 'fenced' WHEN 2 THEN 'balanced' WHEN 3 THEN 'slice' WHEN 4 THEN 'repaired' END"
ORACLE["label_resolution"] = with_fixtures(
    f"SELECT request_id, attempt, {_METHOD} AS method, CASE WHEN variant <= 4 THEN md5(good) END AS label_md5 FROM attempts",
    "responses",
)


def _first(limit: int) -> str:
    return f"""(SELECT request_id, any_value(good) AS good, min(attempt) FILTER (variant <= 4 AND attempt <= {limit}) AS won,
        min_by({_METHOD}, attempt) FILTER (variant <= 4 AND attempt <= {limit}) AS method,
        any_value(rs) AS rs, any_value(ids) AS ids FROM attempts GROUP BY request_id)"""


ORACLE["first_success"] = with_fixtures(
    f"""SELECT request_id, CASE WHEN won IS NULL THEN 'failed' ELSE 'ok' END AS status, won AS attempt, method,
        CASE WHEN won IS NOT NULL THEN md5(good) END AS label_md5 FROM {_first(3)}""",
    "responses",
)
ORACLE["incremental_labels"] = ORACLE["first_success"]
ORACLE["streamed_winners"] = ORACLE["first_success"]
ORACLE["incremental_rejects"] = with_fixtures(
    """SELECT CASE attempt WHEN 1 THEN 'not_json' ELSE 'bad_field' END AS reject, count(*) AS n FROM attempts
       WHERE error_class IS NOT NULL GROUP BY ALL""",
    "responses",
)
ORACLE["stored_labels"] = with_fixtures(
    f"""SELECT request_id, md5(rs) AS reasoning_md5, CAST(json_array_length(ids) AS BIGINT) AS n_items,
        CAST(length(good) + 9 + CASE json_array_length(ids) WHEN 0 THEN 0 ELSE 5 * json_array_length(ids) + 3 END AS BIGINT) AS n_chars
        FROM {_first(3)} WHERE won IS NOT NULL""",
    "responses",
)
ORACLE["outcome_counts"] = with_fixtures(
    """SELECT CASE variant WHEN 8 THEN 'blocked_no_candidates' WHEN 9 THEN 'quota' ELSE 'ok' END AS outcome, count(*) AS n
       FROM attempts GROUP BY ALL""",
    "responses",
)
ORACLE["retry_waits"] = with_fixtures(
    """SELECT request_id,
       CAST(sum(CASE variant WHEN 8 THEN 5 * 2 ** (attempt - 1) WHEN 9 THEN 300 ELSE 0 END) AS BIGINT) AS client_wait,
       CAST(sum(CASE WHEN variant >= 8 AND attempt < 3 THEN 2 ** (attempt - 1) ELSE 0 END) AS BIGINT) AS caller_wait
       FROM attempts GROUP BY request_id""",
    "responses",
)
ORACLE["training_inputs"] = f"""SELECT doc_id, md5({_input('text', f"CASE WHEN doc_id % 2 = 0 THEN {_PRETTY_SYMBOLS} ELSE 'not json' END")})
    AS input_md5 FROM documents"""
ORACLE["symbol_recovery"] = with_fixtures(
    "SELECT base_filename, '[]' AS symbols, CAST(NULL AS VARCHAR) AS compat_symbols FROM keyed WHERE has_prompt", "keyed"
)
ORACLE["artifact_names"] = """
    WITH u AS (SELECT page_id, url, regexp_replace(url, '^http://', '') AS r, split_part(url, '/', -1) AS last FROM pages),
    s AS (SELECT *, CASE WHEN last LIKE '%.%' AND ltrim(last, '.') LIKE '%.%' THEN regexp_extract(last, '^(.*)\\.[^.]*$', 1) ELSE last END AS stem FROM u)
    SELECT page_id, translate(r, '/-', '__') AS repo, split_part(r, '/', -1) AS module,
        translate(r, '/-', '__') || '_' || stem || '_labels.json' AS file,
        'corelib_' || replace(lower('Page ' || url), ' ', '_') || '.swift' AS snippet,
        CASE WHEN last = '' THEN 'text/plain' WHEN page_id % 2 = 0 THEN 'application/json' ELSE 'text/x-swift' END AS mime FROM s"""
ORACLE["entry_rows"] = f"""SELECT doc_id, '{INSTRUCTION}' AS instruction, md5({_input('text', _PRETTY_SYMBOLS)}) AS input_md5,
    '{{}}' AS output FROM documents"""

# --- resuming -----------------------------------------------------------------------------------

_LABEL_OK = "has_label AND doc_id % 11 NOT IN (0, 3)"
_CODE_OK = "has_code AND doc_id % 23 <> 0"
_DONE = f"{_LABEL_OK} AND {_CODE_OK} AND has_symbols"
_LABELLED = "doc_id % 11 NOT IN (0, 2, 3)"
ORACLE["work_states"] = with_fixtures(
    f"""SELECT generator, base_filename, CASE WHEN {_DONE} THEN 'complete' WHEN {_CODE_OK} THEN 'reuse_code'
        ELSE 'generate' END AS state FROM keyed""",
    "keyed",
)
ORACLE["labelled_flags"] = with_fixtures(
    f"SELECT base_filename, {_LABELLED} AS labelled FROM keyed WHERE has_label", "keyed"
)
ORACLE["pending_samples"] = with_fixtures(
    f"SELECT generator, base_filename FROM keyed WHERE NOT ({_DONE})", "keyed"
)
ORACLE["pending_labels"] = with_fixtures(
    f"SELECT generator, base_filename FROM keyed WHERE NOT (has_label AND {_LABELLED})", "keyed"
)
ORACLE["failure_marks"] = with_fixtures(
    f"""SELECT request_id, CASE WHEN won IS NULL THEN 'failed' ELSE 'ok' END AS status,
        md5(CASE WHEN won IS NULL THEN '{{"error": "generation_failed"}}' ELSE good END) AS label_md5 FROM {_first(3)}
        UNION ALL SELECT DISTINCT -request_id - 1, 'failed', md5('{{"error": "generation_failed"}}') FROM attempts""",
    "responses",
)
_JUDGED = """(SELECT *, CASE WHEN doc_id % 11 IN (0, 2) THEN 'label_too_small' WHEN doc_id % 11 = 3 THEN 'label_not_json'
    WHEN NOT (has_code AND has_prompt) THEN 'artifact_missing' WHEN doc_id % 23 = 0 THEN 'code_blank'
    WHEN generator = 'gen_b' AND NOT has_symbols THEN 'no_symbols' END AS reject FROM keyed WHERE has_label)"""
ORACLE["assembled_entries"] = with_fixtures(
    f"""SELECT project, base_filename, md5({_input('code', f"CASE generator WHEN 'gen_a' THEN '[]' ELSE {_PRETTY_SYMBOLS} END")})
        AS input_md5, md5(label) AS output_md5 FROM {_JUDGED} WHERE reject IS NULL""",
    "keyed",
)
ORACLE["assembly_rejects"] = with_fixtures(
    f"SELECT project, base_filename, reject FROM {_JUDGED} WHERE reject IS NOT NULL", "keyed"
)
ORACLE["assembly_counts"] = with_fixtures(
    f"""SELECT n.project, count(*) FILTER (j.project IS NOT NULL AND reject IS NULL) AS success, count(reject) AS errors
        FROM (SELECT DISTINCT project FROM artifacts UNION ALL SELECT n_name FROM nation) n
        LEFT JOIN {_JUDGED} j USING (project) GROUP BY ROLLUP (n.project)""",
    "artifacts",
)

# --- artefacts ----------------------------------------------------------------------------------

_EXT = "CASE kind WHEN 'code' THEN '.swift' WHEN 'label' THEN '.json' ELSE '.txt' END"
ORACLE["artifact_keys"] = with_fixtures(
    f"SELECT generator AS folder, base_filename, {_EXT} AS ext, kind, polarity FROM artifacts", "artifacts"
)
ORACLE["artifact_file_scan"] = with_fixtures(
    """SELECT generator, project, base_filename, kind AS stored_kind, CAST(octet_length(encode(content)) + 1 AS BIGINT) AS n_bytes,
       md5(content || chr(10)) AS content_md5 FROM artifacts""",
    "artifacts",
)
ORACLE["stored_work_states"] = ORACLE["work_states"]
ORACLE["artifact_snapshot"] = with_fixtures(
    """SELECT generator, kind, base_filename,
       md5(CASE WHEN kind = 'label' AND generator = 'gen_a' THEN 'new ' || content ELSE content END) AS content_md5 FROM artifacts""",
    "artifacts",
)
ORACLE["project_order"] = with_fixtures(
    f"""SELECT project, nullif(coalesce(list_position({PRIORITY!r}, project), 0), 0)::BIGINT AS priority
        FROM (SELECT DISTINCT project FROM artifacts)""",
    "artifacts",
)
ORACLE["source_discovery"] = with_fixtures(
    "SELECT project, count(*) FILTER (kind = 'code') AS n_code FROM artifacts GROUP BY project", "artifacts"
)

# --- audit --------------------------------------------------------------------------------------

_FLAGGED = "(kind = 'label' AND polarity = 'positive' AND content = good AND ids = '[]')"
_WITH_IDS = "(SELECT a.*, k.good, k.ids FROM artifacts a JOIN keyed k USING (base_filename))"
ORACLE["contradiction_audit"] = with_fixtures(
    f"""SELECT generator, base_filename, kind, {_FLAGGED} AS flagged FROM {_WITH_IDS}
        WHERE kind = 'label' AND polarity = 'positive'""",
    "artifacts",
)
ORACLE["pruned_snapshot"] = with_fixtures(
    f"SELECT generator, base_filename, kind FROM {_WITH_IDS} WHERE NOT {_FLAGGED}", "artifacts"
)
ORACLE["audit_summary"] = with_fixtures(
    f"""SELECT generator, count(*) AS scanned, count(*) FILTER {_FLAGGED} AS flagged FROM {_WITH_IDS}
        WHERE kind = 'label' AND polarity = 'positive' GROUP BY ROLLUP (generator)""",
    "artifacts",
)
ORACLE["negative_artifacts"] = with_fixtures(
    "SELECT generator, base_filename, kind FROM artifacts WHERE polarity = 'negative' AND generator = 'gen_a'", "artifacts"
)
ORACLE["negative_removal"] = with_fixtures(
    "SELECT generator, kind, count(*) AS n FROM artifacts WHERE polarity = 'positive' GROUP BY ALL", "artifacts"
)
ORACLE["removal_counts"] = with_fixtures(
    "SELECT count(*) AS deleted, count(*) AS failed FROM artifacts WHERE polarity = 'negative'", "artifacts"
)

# --- symbols ------------------------------------------------------------------------------------
# Runs of seven words give, by turns, the tokens of these two shapes, after the two of the import line.

_SHAPES = tuple(
    shape.split()
    for shape in (
        "@objc class T_{w1} : P_{w2} , P_{w3} { var v_{w4} : Int func f_{w5} ( x : Int ) -> Bool "
        "{ c_{w6} ( v_{w4} . m_{w7} ( ) ) } }",
        "public struct S_{w1} < A , B : P_{w2} > : Q_{w3} < A , B > { "
        "struct N_{w4} { let p_{w5} : D < Int , [ K_{w6} ] > = e_{w6} ( /}{w7}{2}/ ) } "
        "func g_{w5} < C > ( _ y : [ C ] , by z : D < C , Int > ) -> [ C ] where C : P_{w2} { "
        "y . filter { k in h_{w6} ( k , R < Int , C > ( x : i_{w7} ) ) } } }",
    )
)
_STARTS = ((0, 8, 12, 31), (0, 18, 21, 37, 38, 70, 93, 94))
_EVEN, _ODD = (f"(SELECT * FROM cw WHERE c % 2 = {k})" for k in (0, 1))


def _at(shape: int, i: int) -> str:
    return f"CAST({2 + len(_SHAPES[0]) * shape + i} + {sum(map(len, _SHAPES))} * (c // 2) AS INTEGER) AS pos"


def _token_rows() -> str:
    rows = []
    for shape, tokens in enumerate(_SHAPES):
        depth = 0
        for i, token in enumerate(tokens):
            depth += (token == "{") - (token == "}")
            parts = re.split(r"\{(w\d)\}", token)
            text = " || ".join(part if k % 2 else f"'{part}'" for k, part in enumerate(parts))
            rows.append(f"SELECT {text} AS tok, {depth} AS depth, {_at(shape, i)}, {str(i in _STARTS[shape]).lower()} AS nl FROM {(_EVEN, _ODD)[shape]}")
    rows.append("SELECT unnest(['import', 'Foundation']) AS tok, 0 AS depth, unnest([0, 1]) AS pos, false AS nl FROM fw")
    return " UNION ALL ".join(rows)


ORACLE["source_tokens"] = with_fixtures(
    f"""SELECT tok, depth, count(*) AS n, CAST(sum(pos) AS BIGINT) AS pos_sum, count(*) FILTER (nl) AS line_starts
        FROM ({_token_rows()}) GROUP BY tok, depth""",
    "source_words",
)
_SIG, _SIG_B = "(x: Int) -> Bool", "(_ y: [C], by z: D<C, Int>) -> [C]"
_CALLS = "list_sort(list_distinct(['c_' || w6, 'm_' || w7]))"
_REFS = "list_sort(list_distinct(['c_' || w6, 'm_' || w7, 'v_' || w4]))"
_CALLS_B, _REFS_B = "['filter', 'h_' || w6]", "['R', 'filter', 'h_' || w6, 'i_' || w7, 'k', 'y']"
ORACLE["type_declarations"] = with_fixtures(
    f"""SELECT file_id, {_at(0, 1)}, 'T_' || w1 AS symbolName, 'class' AS symbolKind,
        'P_' || w2 || '|P_' || w3 AS conforms, '@objc' AS attributes FROM {_EVEN}
        UNION ALL SELECT file_id, {_at(1, 1)}, 'S_' || w1, 'struct', 'Q_' || w3 || '<A, B>', '' FROM {_ODD}
        UNION ALL SELECT file_id, {_at(1, 18)}, 'N_' || w4, 'struct', '', '' FROM {_ODD}""",
    "source_words",
)
ORACLE["function_declarations"] = with_fixtures(
    f"""SELECT file_id, {_at(0, 12)}, 'f_' || w5 || '({_SIG})' AS symbolName, 'method' AS symbolKind,
        '{_SIG}' AS typeSignature FROM {_EVEN}
        UNION ALL SELECT file_id, {_at(1, 38)}, 'g_' || w5 || '({_SIG_B})', 'method', '{_SIG_B}' FROM {_ODD}""",
    "source_words",
)
ORACLE["variable_declarations"] = with_fixtures(
    f"""SELECT file_id, {_at(0, 8)}, 'v_' || w4 AS symbolName, 'variable' AS symbolKind, 'Int' AS typeSignature FROM {_EVEN}
        UNION ALL SELECT file_id, {_at(1, 21)}, 'p_' || w5, 'variable', 'D<Int, [K_' || w6 || ']>' FROM {_ODD}""",
    "source_words",
)
ORACLE["qualified_symbols"] = with_fixtures(
    f"""SELECT file_id, {_at(0, 1)}, 'T_' || w1 AS symbolName, 'class' AS symbolKind FROM {_EVEN}
        UNION ALL SELECT file_id, {_at(0, 8)}, 'T_' || w1 || '.v_' || w4, 'property' FROM {_EVEN}
        UNION ALL SELECT file_id, {_at(0, 12)}, 'T_' || w1 || '.f_' || w5 || '({_SIG})', 'method' FROM {_EVEN}
        UNION ALL SELECT file_id, {_at(1, 1)}, 'S_' || w1, 'struct' FROM {_ODD}
        UNION ALL SELECT file_id, {_at(1, 18)}, 'S_' || w1 || '.N_' || w4, 'struct' FROM {_ODD}
        UNION ALL SELECT file_id, {_at(1, 21)}, 'S_' || w1 || '.N_' || w4 || '.p_' || w5, 'property' FROM {_ODD}
        UNION ALL SELECT file_id, {_at(1, 38)}, 'S_' || w1 || '.g_' || w5 || '({_SIG_B})', 'method' FROM {_ODD}""",
    "source_words",
)
ORACLE["body_calls"] = with_fixtures(
    f"""SELECT file_id, {_at(0, 12)}, array_to_string({_CALLS}, '|') AS calls_out FROM {_EVEN}
        UNION ALL SELECT file_id, {_at(1, 38)}, array_to_string({_CALLS_B}, '|') FROM {_ODD}""",
    "source_words",
)
ORACLE["body_references"] = with_fixtures(
    f"""SELECT file_id, {_at(0, 12)}, array_to_string({_REFS}, '|') AS "references" FROM {_EVEN}
        UNION ALL SELECT file_id, {_at(1, 38)}, array_to_string({_REFS_B}, '|') FROM {_ODD}""",
    "source_words",
)
_ONE_JSON = f"""CASE WHEN c % 2 = 0 THEN
    '{{"symbolName":"T_' || w1 || '","symbolKind":"class","conforms":["P_' || w2 || '","P_' || w3 || '"],"attributes":["@objc"]}},'
    || '{{"symbolName":"v_' || w4 || '","symbolKind":"variable","typeSignature":"Int"}},'
    || '{{"symbolName":"f_' || w5 || '({_SIG})","symbolKind":"method","typeSignature":"{_SIG}","calls_out":["'
    || array_to_string({_CALLS}, '","') || '"],"references":["' || array_to_string({_REFS}, '","') || '"]}}'
    ELSE '{{"symbolName":"S_' || w1 || '","symbolKind":"struct","conforms":["Q_' || w3 || '<A, B>"]}},'
    || '{{"symbolName":"N_' || w4 || '","symbolKind":"struct"}},'
    || '{{"symbolName":"p_' || w5 || '","symbolKind":"variable","typeSignature":"D<Int, [K_' || w6 || ']>"}},'
    || '{{"symbolName":"g_' || w5 || '({_SIG_B})","symbolKind":"method","typeSignature":"{_SIG_B}","calls_out":["'
    || array_to_string({_CALLS_B}, '","') || '"],"references":["' || array_to_string({_REFS_B}, '","') || '"]}}' END"""
_LISTS = f"""(SELECT file_id, '[' || coalesce(string_agg({_ONE_JSON}, ',' ORDER BY c), '') || ']' AS symbols_json
    FROM fw LEFT JOIN cw USING (file_id) GROUP BY file_id)"""
ORACLE["symbol_lists"] = with_fixtures(f"SELECT file_id, md5(symbols_json) AS symbols_md5 FROM {_LISTS}", "source_words")
ORACLE["symbol_failures"] = with_fixtures(
    f"""SELECT file_id, NULL AS reject, md5(symbols_json) AS symbols_md5 FROM {_LISTS}
        UNION ALL SELECT -3 * doc_id - 1, 'no_symbols', NULL FROM documents
        UNION ALL SELECT -3 * doc_id - 2, NULL, md5('[]') FROM documents""",
    "source_words",
)

# --- whole runs ---------------------------------------------------------------------------------


def _shape_text(shape: str) -> str:
    """A shape of source, filled with the words of a run."""
    parts = []
    for text, field, _, _ in string.Formatter().parse(shape):
        parts.append("'" + text.replace("'", "''") + "'")
        if field is not None:
            parts.append(f"w{int(field) + 1}")
    return " || ".join(parts)


def _laid_out(**fields: str) -> str:
    """A symbol with two-space indents. Values are SQL: texts, or lists for names in the plural."""
    lines = []
    for name, value in fields.items():
        if name in ("calls_out", "references", "conforms", "attributes"):
            lines.append(f"""'    "{name}": [\n      "' || array_to_string({value}, '",\n      "') || '"\n    ]'""")
        else:
            lines.append(f"""'    "{name}": "' || {value} || '"'""")
    return "'  {\n' || " + " || ',\n' || ".join(lines) + " || '\n  }'"


_EVEN_SYMBOLS = " || ',\n' || ".join((
    _laid_out(symbolName="'T_' || w1", symbolKind="'class'", conforms="['P_' || w2, 'P_' || w3]", attributes="['@objc']"),
    _laid_out(symbolName="'v_' || w4", symbolKind="'variable'", typeSignature="'Int'"),
    _laid_out(symbolName=f"'f_' || w5 || '({_SIG})'", symbolKind="'method'", typeSignature=f"'{_SIG}'", calls_out=_CALLS, references=_REFS),
))
_ODD_SYMBOLS = " || ',\n' || ".join((
    _laid_out(symbolName="'S_' || w1", symbolKind="'struct'", conforms="['Q_' || w3 || '<A, B>']"),
    _laid_out(symbolName="'N_' || w4", symbolKind="'struct'"),
    _laid_out(symbolName="'p_' || w5", symbolKind="'variable'", typeSignature="'D<Int, [K_' || w6 || ']>'"),
    _laid_out(symbolName=f"'g_' || w5 || '({_SIG_B})'", symbolKind="'method'", typeSignature=f"'{_SIG_B}'", calls_out=_CALLS_B, references=_REFS_B),
))
_RUNS = f"""(SELECT file_id, 'import Foundation\n' || coalesce(string_agg(code, '' ORDER BY c), '') AS code,
    CASE WHEN count(c) = 0 THEN '[]' ELSE '[\n' || string_agg(symbols, ',\n' ORDER BY c) || '\n]' END AS symbols
    FROM fw LEFT JOIN (SELECT file_id, c, CASE WHEN c % 2 = 0 THEN {_shape_text(SOURCE_SHAPES[0])} ELSE {_shape_text(SOURCE_SHAPES[1])} END AS code,
      CASE WHEN c % 2 = 0 THEN {_EVEN_SYMBOLS} ELSE {_ODD_SYMBOLS} END AS symbols FROM cw) USING (file_id) GROUP BY file_id)"""


def _run(label: str) -> str:
    return f"""SELECT 'p_' || (file_id % 20) AS project, 'f_' || file_id AS base_filename, md5({_input('code', 'symbols')}) AS input_md5,
        md5({label}) AS output_md5 FROM {_RUNS} JOIN {_first(3)} ON request_id = file_id"""


_LABEL = """CASE WHEN won IS NULL THEN '{"error": "generation_failed"}' ELSE good END"""
ORACLE["built_entries"] = with_fixtures(_run(_LABEL), "responses", "source_words")
_KEPT = f"""CASE WHEN file_id % 3 = 0 THEN '{{"reasoning":"kept","identifiers":[]}}' ELSE {_LABEL} END"""
ORACLE["project_entries"] = with_fixtures(_run(_KEPT), "responses", "source_words")

# --- snapshots in buckets -----------------------------------------------------------------------

ORACLE["bucketed_work_states"] = ORACLE["work_states"]
ORACLE["bucketed_snapshot"] = ORACLE["artifact_snapshot"]
ORACLE["bucketed_prune"] = ORACLE["pruned_snapshot"]
ORACLE["bucketed_assembly"] = ORACLE["assembled_entries"]
