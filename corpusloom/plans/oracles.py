"""The queries of queries.py as SQL."""

from __future__ import annotations

from corpusloom.plans.roles import _WS, SQL, words_sql

_ROLES = "WITH " + SQL


def _with(more: str) -> str:
    return _ROLES + ", " + more


_CLEAN = rf"""trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(text, '^{_WS}+|{_WS}+$', '', 'g'), '^["'']+|["'']+$', '', 'g'),
  '[\x{{FEFF}}\x{{200B}}-\x{{200D}}]', '', 'g'), '[\x{{1F300}}-\x{{1FAFF}}\x{{2600}}-\x{{27BF}}]', '', 'g'), '{_WS}+', ' ', 'g'), ' ')"""
_MARKS = r"[\x{064B}-\x{0652}\x{0670}\x{0640}]"


def _hash(x: str) -> str:
    light = rf"regexp_replace(regexp_replace(nfc_normalize({x}), '{_MARKS}', '', 'g'), '[\x{{06D6}}-\x{{06ED}}]', '', 'g')"
    return f"sha1(trim(regexp_replace({light}, '{_WS}+', ' ', 'g'), ' '))[1:12]"


def _normal(x: str) -> str:
    return rf"lower(trim(regexp_replace(translate(regexp_replace(nfc_normalize({x}), '{_MARKS}', '', 'g'), '٠١٢٣٤٥٦٧٨٩آأإةى', '0123456789اااهي'), '[^\p{{L}}\p{{N}}_]+', ' ', 'g'), ' '))"


def _export(gate: str) -> str:
    return _ROLES + f"""
SELECT id, audio_path AS audio_relpath, coalesce(nullif(final_text, ''), text) AS text, text AS original_prompt, category, voice_provider, voice_id,
  voice_gender, voice_dialect, duration_sec, sample_rate, transcript AS asr_transcript, cer AS asr_cer, wer AS asr_wer,
  CASE WHEN has_quality THEN array_to_string(flags, ',') ELSE '' END AS auto_flags, auto_status, decision AS review_decision, note AS review_note,
  true AS is_synthetic, 'ar-EG' AS language
FROM joined WHERE {gate}"""


_REVIEWED, _NOT_REJECTED = "decision IS NOT NULL", "decision <> 'reject'"
_NOT_FLAGGED = "NOT (coalesce(auto_status, '') = 'flagged' AND decision = 'accept')"
_DEFAULT = f"{_REVIEWED} AND {_NOT_REJECTED} AND {_NOT_FLAGGED}"

_VALID = f"""
cand AS (SELECT doc_id AS seq, lang AS category, {_CLEAN} AS cleaned FROM documents),
prep AS (SELECT *, {words_sql('cleaned')}::INT AS word_count, {_hash('cleaned')} AS hash,
  length(regexp_replace(cleaned, '[^A-Za-z]', '', 'g')) AS own, length(regexp_replace(cleaned, '{_WS}', '', 'g')) AS total FROM cand),
ruled AS (SELECT *, CASE WHEN cleaned = '' THEN 'empty_after_cleaning' WHEN word_count < 20 THEN 'too_short_' || word_count || 'w'
  WHEN word_count > 600 THEN 'too_long_' || word_count || 'w' WHEN total = 0 OR own / total < 0.8::DOUBLE THEN 'not_arabic_enough' ELSE '' END AS rule FROM prep),
valid AS (SELECT *, CASE WHEN rule = '' AND seq > min(seq) FILTER (WHERE rule = '') OVER (PARTITION BY hash) THEN 'duplicate' ELSE rule END AS reason FROM ruled)"""

_PLAN = """
plan(category, target) AS (VALUES ('en', 165), ('de', 45), ('fr', 52), ('es', 38)),
missing AS (SELECT category, (target - coalesce(have, 0))::INT AS deficit FROM plan LEFT JOIN
  (SELECT category, count(*) AS have FROM reviews JOIN audio USING (id) WHERE decision = 'edit' GROUP BY category) USING (category)
  WHERE target - coalesce(have, 0) > 0)"""

_QUEUE = """
queue AS (
  SELECT a.*, CASE WHEN q.id IS NULL THEN 'unknown' ELSE q.auto_status END AS auto_status, CASE WHEN q.id IS NULL THEN [] ELSE q.flags END AS flags, q.cer, q.wer, q.chars_per_sec
  FROM audio a LEFT JOIN quality q USING (id) WHERE a.status = 'ok'),
ranked AS (SELECT *, CASE auto_status WHEN 'flagged' THEN 0 WHEN 'error' THEN 1 WHEN 'ok' THEN 2 WHEN 'unknown' THEN 3 ELSE 4 END AS priority FROM queue),
placed AS (SELECT *, row_number() OVER (ORDER BY priority, seq) - 1 AS position FROM ranked)"""


def _sorted(index: str, where: str = "list_sort(list(cer) FILTER (WHERE cer IS NOT NULL))") -> str:
    return f"({where})[({index})::INT + 1]"


_N = "count(cer)"
_UPPER, _P90 = _sorted(f"{_N} // 2"), _sorted(f"floor({_N} * 0.9::DOUBLE)")
_RATES = """count(*) AS n, round(avg(cer), 9) AS mean_cer, count(*) FILTER (WHERE auto_status = 'flagged') AS n_flagged,
  round(100.0::DOUBLE * count(*) FILTER (WHERE auto_status = 'flagged') / count(*), 9) AS pct_flagged, count(*) FILTER (WHERE decision = 'reject') AS n_rejected,
  round(100.0::DOUBLE * count(*) FILTER (WHERE decision = 'reject') / count(*), 9) AS pct_rejected"""

_ROUND_ROBIN = """
rr AS (SELECT doc_id AS seq, lang AS category, row_number() OVER (ORDER BY doc_id) - 1 AS position FROM documents),
named AS (SELECT *, ['ar-EG-SalmaNeural', 'ar-EG-ShakirNeural', 'ar'][(position % 3 + 1)::INT] AS voice_id, ['edge', 'edge', 'gtts'][(position % 3 + 1)::INT] AS provider,
  ['female', 'male', 'unknown'][(position % 3 + 1)::INT] AS gender, ['egyptian', 'egyptian', 'msa_leaning'][(position % 3 + 1)::INT] AS dialect FROM rr)"""

# Word edit distance: rows of the distance table are folded over the hypothesis' words.
_WER = f"""
n AS (SELECT conv_id, turn, {_normal('ref')} AS ref, {_normal('hyp')} AS hyp FROM pairs),
w AS (SELECT conv_id, turn, ref, hyp, string_split(ref, ' ') AS r, string_split(hyp, ' ') AS h FROM n),
d AS (SELECT *, list_reduce(
    list_prepend(list_transform(range(0, len(r) + 1), lambda x: x::INT), list_transform(h, lambda y: [list_position(h, y)::INT * 0 - list_position(list_distinct(list_concat(r, h)), y)::INT])),
    lambda prev, y: list_reduce(
      list_prepend([prev[1] + 1], list_transform(range(1, len(r) + 1), lambda j: [least(prev[j + 1] + 1, prev[j] + CASE WHEN -list_position(list_distinct(list_concat(r, h)), r[j])::INT = y[1] THEN 0 ELSE 1 END)::INT])),
      lambda acc, t: list_append(acc, least(acc[len(acc)] + 1, t[1])::INT)))[len(r) + 1] AS dist FROM w)"""

#: DuckDB's levenshtein counts bytes, so each pair's letters become single ones (at most 127 a pair).
_LETTERS = f"""
n AS (SELECT conv_id, turn, {_normal('ref')} AS ref, {_normal('hyp')} AS hyp FROM pairs),
l AS (SELECT *, list_distinct(string_split(ref || hyp, '')) AS letters FROM n),
c AS (
  SELECT conv_id, turn, length(ref)::INT AS n_ref, ref, hyp,
    levenshtein(translate(ref, array_to_string(letters, ''), array_to_string(list_transform(range(1, len(letters) + 1), lambda k: chr(k::INT)), '')),
                translate(hyp, array_to_string(letters, ''), array_to_string(list_transform(range(1, len(letters) + 1), lambda k: chr(k::INT)), ''))) AS edits
  FROM l
)"""

_SIGNALS = _LETTERS + "," + _WER.replace("n AS (", "n2 AS (", 1).replace("FROM n)", "FROM n2)", 1) + """,
clips AS (
  SELECT p.*, conv_id * 31 + turn AS k, """ + words_sql("ref") + """ * 4 / 10.0::DOUBLE AS seconds FROM pairs p
),
paired AS (
  SELECT clips.*, k % 11 = 0 AS missing, k % 11 <> 0 AND k % 13 = 0 AS unreadable, k % 7 = 0 AS failed, c.hyp AS heard,
    CASE WHEN c.ref <> '' AND c.hyp <> '' THEN c.edits / c.n_ref END AS cer0, CASE WHEN d.ref <> '' AND d.hyp <> '' THEN d.dist / len(d.r) END AS wer0
  FROM clips JOIN c USING (conv_id, turn) JOIN d USING (conv_id, turn)
),
rated AS (
  SELECT *, NOT missing AND NOT unreadable AND NOT failed AS ok, round_even(cer0, 3) AS cer3, round_even(wer0, 3) AS wer3,
    CASE WHEN NOT missing AND NOT unreadable THEN length(replace(ref, ' ', '')) / greatest(seconds, 1e-6::DOUBLE) END AS cps
  FROM paired
),
listed AS (
  SELECT *, CASE WHEN missing THEN 'missing_audio' WHEN unreadable THEN 'duration_read_error' ELSE array_to_string(list_filter([
    CASE WHEN seconds < 0.5::DOUBLE THEN 'too_short' END, CASE WHEN seconds > 1000.0::DOUBLE THEN 'too_long' END,
    CASE WHEN cps < 12.0::DOUBLE THEN 'too_slow' END, CASE WHEN cps > 15.0::DOUBLE THEN 'too_fast' END,
    CASE WHEN NOT failed AND cer3 > 0.25::DOUBLE THEN 'high_cer' END, CASE WHEN NOT failed AND heard = '' THEN 'empty_transcript' END,
    CASE WHEN failed THEN 'asr_error' END], lambda x: x IS NOT NULL), ', ') END AS flags
  FROM rated
)
SELECT conv_id || '_' || turn AS id, conv_id::VARCHAR AS prompt_id, conv_id || '/' || turn AS audio_path,
  CASE WHEN k % 13 <> 0 THEN round_even(seconds, 3) END AS duration_sec, CASE WHEN ok THEN hyp END AS transcript,
  CASE WHEN ok THEN cer3 END AS cer, CASE WHEN ok THEN wer3 END AS wer, round_even(cps, 2) AS chars_per_sec, flags,
  CASE WHEN missing OR unreadable THEN 'error' WHEN flags <> '' THEN 'flagged' ELSE 'ok' END AS auto_status,
  CASE WHEN missing THEN 'audio file not found: ' || conv_id || '/' || turn WHEN unreadable THEN 'duration: not readable' WHEN failed THEN 'asr: no answer' END AS error,
  k AS seq
FROM listed"""

ORACLES = {
    "plan_total_deficit": _with(_PLAN) + " SELECT coalesce(sum(deficit), 0)::BIGINT AS total FROM missing",
    "category_share_total": """
SELECT round(sum(p), 9) AS total, count(*) AS n FROM (VALUES ('daily_conversation', 0.25::DOUBLE), ('customer_service', 0.15::DOUBLE), ('questions', 0.15::DOUBLE),
  ('code_switching', 0.15::DOUBLE), ('numbers_dates', 0.10::DOUBLE), ('commands_requests', 0.10::DOUBLE), ('emotional', 0.05::DOUBLE), ('formal_news', 0.05::DOUBLE)) AS t(category, p)""",
    "cer_pairs_whole": _with(_LETTERS) + " SELECT conv_id, turn, n_ref AS n, CASE WHEN ref <> '' AND hyp <> '' THEN edits / n_ref END AS cer FROM c",
    "signals_records": _with(_SIGNALS),
    "batch_outcomes": _ROLES + "SELECT count(*) FILTER (auto_status = 'ok') AS n_ok, count(*) FILTER (auto_status = 'flagged') AS n_flagged, count(*) FILTER (auto_status = 'error') AS n_error FROM quality",
    "cer_by_category_ranked": _with("m AS (SELECT category, count(*) AS n, round(avg(cer), 9) AS mean_cer FROM report GROUP BY category)") + """
SELECT *, row_number() OVER (ORDER BY category)::INT AS by_key, row_number() OVER (ORDER BY n DESC, category)::INT AS by_size, row_number() OVER (ORDER BY mean_cer DESC NULLS LAST, category)::INT AS by_mean FROM m""",
    "first_leaks": "SELECT lpad(page_id::VARCHAR, 12, '0') AS id, 'url' AS field, url AS value FROM pages WHERE starts_with(url, 'http:') ORDER BY page_id LIMIT 3",
    "log_in_order": _ROLES + "SELECT id, decision, final_text, note, (row_number() OVER (ORDER BY seq) - 1)::BIGINT AS seq FROM log",
    "log_overwrite": _ROLES + "SELECT id, arg_max(decision, seq) AS decision, arg_max(final_text, seq) AS final_text, NULL::VARCHAR AS note, min(seq) AS first_seq FROM log GROUP BY id",
    "wav_durations": """
SELECT doc_id::VARCHAR AS path, CASE WHEN doc_id % 7 <> 0 THEN (doc_id % 5000 + 1) / 16000.0::DOUBLE END AS duration_sec, CASE WHEN doc_id % 7 <> 0 THEN 16000 END AS sample_rate FROM documents""",
    "wav_clips": """
SELECT path, n_bytes FROM (
  SELECT doc_id::VARCHAR AS path, (CASE WHEN doc_id % 7 = 0 THEN 4 + doc_id % 400 ELSE 44 + 2 * (doc_id % 5000 + 1) + CASE WHEN doc_id % 5 = 0 THEN 12 ELSE 0 END END)::BIGINT AS n_bytes FROM documents)
WHERE n_bytes >= 256""",
    "dataset_schema": """
SELECT name, type FROM (VALUES ('id', 'string'), ('audio', 'string'), ('audio_relpath', 'string'), ('text', 'string'), ('original_prompt', 'string'), ('category', 'string'),
  ('voice_provider', 'string'), ('voice_id', 'string'), ('voice_gender', 'string'), ('voice_dialect', 'string'), ('duration_sec', 'float'), ('sample_rate', 'int'),
  ('asr_transcript', 'string'), ('asr_cer', 'float'), ('asr_wer', 'float'), ('auto_flags', 'array<string>'), ('auto_status', 'string'), ('review_decision', 'string'),
  ('review_note', 'string'), ('is_synthetic', 'boolean'), ('language', 'string')) AS t(name, type)""",
    "export_join": _export(_DEFAULT),
    "export_include_rejected": _export(f"{_REVIEWED} AND {_NOT_FLAGGED}"),
    "export_include_flagged": _export(f"{_REVIEWED} AND {_NOT_REJECTED}"),
    "export_skip_reasons": _ROLES + f"""
SELECT CASE WHEN decision IS NULL THEN 'unreviewed' WHEN decision = 'reject' THEN 'rejected' WHEN NOT ({_NOT_FLAGGED}) THEN 'flagged_accept_only' END AS skip_reason, count(*) AS n
FROM joined GROUP BY 1 HAVING skip_reason IS NOT NULL""",
    "latest_decision": _ROLES + "SELECT id, arg_max(decision, seq) AS decision, arg_max(final_text, seq) AS final_text, arg_max_null(note, seq) AS note, max(seq) AS seq, min(seq) AS first_seq FROM log GROUP BY id",
    "decision_compaction": _ROLES + "SELECT id, arg_max(decision, seq) AS decision, arg_max(final_text, seq) AS final_text, NULL::VARCHAR AS note, min(seq) AS first_seq FROM log GROUP BY id",
    "decision_tally": _ROLES + "SELECT decision, count(*) AS n FROM (SELECT id, arg_max(decision, seq) AS decision FROM log GROUP BY id) GROUP BY decision",
    "decision_audit_count": _ROLES + """
SELECT (SELECT count(*) FROM log) AS n_entries, count(*) AS n_ids, count(*) FILTER (WHERE coalesce(note, '') <> '') AS n_notes
FROM (SELECT id, arg_max_null(note, seq) AS note FROM log GROUP BY id)""",
    "review_progress": _ROLES + """
SELECT count(*) AS reviewed, count(*) FILTER (WHERE decision = 'accept') AS n_accept, count(*) FILTER (WHERE decision = 'edit') AS n_edit,
  count(*) FILTER (WHERE decision = 'reject') AS n_reject, (SELECT count(*) FROM audio WHERE status = 'ok') AS total FROM reviews""",
    "resume_pending_ok_only": _ROLES + "SELECT id, seq FROM audio a WHERE NOT EXISTS (SELECT 1 FROM audio b WHERE b.id = a.id AND b.status = 'ok')",
    "resume_pending_any": _ROLES + "SELECT id, seq FROM audio a WHERE status = 'ok' AND NOT EXISTS (SELECT 1 FROM quality q WHERE q.id = a.id)",
    "dedup_against_existing": f"""
WITH known AS (SELECT {_hash('line')} AS hash FROM (SELECT unnest(string_split(text, chr(10))) AS line FROM benchmark)),
lines AS (SELECT doc_id AS seq, (i - 1)::INT AS line, {_hash('string_split(text, chr(10))[i]')} AS hash FROM (SELECT doc_id, text, unnest(range(1, len(string_split(text, chr(10))) + 1)) AS i FROM documents))
SELECT seq, line, hash FROM lines WHERE hash NOT IN (SELECT hash FROM known)""",
    "clean_text": f"SELECT doc_id AS seq, {_CLEAN} AS cleaned FROM documents",
    "word_count": f"SELECT doc_id AS seq, {words_sql('text')}::INT AS word_count FROM documents",
    "script_ratio": f"""
SELECT seq, CASE WHEN total > 0 THEN own / total END AS ratio, coalesce(total > 0 AND own / total >= 0.8::DOUBLE, false) AS passes
FROM (SELECT doc_id AS seq, length(regexp_replace(text, '[^A-Za-z]', '', 'g')) AS own, length(regexp_replace(text, '{_WS}', '', 'g')) AS total FROM documents)""",
    "text_hash": f"SELECT doc_id AS seq, {_hash('text')} AS hash FROM documents",
    "validate_reasons": f"WITH {_VALID} SELECT seq, word_count, hash, reason FROM valid",
    "validate_reason_counts": f"WITH {_VALID} SELECT reason, count(*) AS n FROM valid WHERE reason <> '' GROUP BY reason",
    "accept_candidates": _with(_VALID + "," + _PLAN) + """
SELECT hash AS id, hash, cleaned AS text, category, word_count, 'llm:stub' AS source, seq
FROM (SELECT *, row_number() OVER (PARTITION BY category ORDER BY seq) AS r FROM valid WHERE reason = '') JOIN missing USING (category) WHERE r <= deficit""",
    "plan_targets": """
SELECT category, round_even(p * 75, 0)::INT AS target FROM (VALUES ('daily_conversation', 0.25::DOUBLE), ('customer_service', 0.15::DOUBLE), ('questions', 0.15::DOUBLE),
  ('code_switching', 0.15::DOUBLE), ('numbers_dates', 0.10::DOUBLE), ('commands_requests', 0.10::DOUBLE), ('emotional', 0.05::DOUBLE), ('formal_news', 0.05::DOUBLE)) AS t(category, p)""",
    "plan_deficit": _with(_PLAN) + " SELECT category, deficit FROM missing",
    "plan_next_category": _with(_PLAN) + " SELECT category, deficit, least(15, deficit + 5)::INT AS batch_n FROM missing ORDER BY deficit DESC, sha1(category) LIMIT 1",
    "append_union": _ROLES + "SELECT decision, count(*) AS n, count(note) AS n_notes FROM (SELECT decision, note FROM reviews UNION ALL SELECT decision, NULL FROM log) GROUP BY decision",
    "distinct_hashes": f"SELECT count(DISTINCT {_hash('text')}) AS n FROM documents",
    "round_robin_voice": f"WITH {_ROUND_ROBIN} SELECT seq, position, voice_id, provider || '-' || voice_id AS voice_slug, seq || '_' || provider || '-' || voice_id AS sample_id FROM named",
    "audio_record_defaults": f"""WITH {_ROUND_ROBIN}
SELECT seq || '_' || provider || '-' || voice_id AS id, seq::VARCHAR AS prompt_id, category, provider AS voice_provider, voice_id, gender AS voice_gender, dialect AS voice_dialect,
  NULL::VARCHAR AS audio_path, NULL::DOUBLE AS duration_sec, 16000 AS sample_rate, 'failed' AS status, NULL::VARCHAR AS error, seq FROM named""",
    "voice_slug_id": _ROLES + """
SELECT seq, translate(voice_provider || ':x-' || audio_path || '/' || voice_id, '/:', '__') AS slug, prompt_id || '_' || translate(voice_provider || ':x-' || audio_path || '/' || voice_id, '/:', '__') AS composite FROM audio""",
    "qa_normalize": f"SELECT doc_id AS seq, {_normal('text')} AS normalized FROM documents",
    "cer_pairs": _with(rf"n AS (SELECT conv_id, turn, regexp_replace({_normal('ref')}, '[^\x00-\x7f]', '?', 'g') AS ref, regexp_replace({_normal('hyp')}, '[^\x00-\x7f]', '?', 'g') AS hyp FROM pairs)") + """
SELECT conv_id, turn, length(ref)::INT AS n, CASE WHEN ref <> '' AND hyp <> '' THEN levenshtein(ref, hyp) / length(ref) END AS cer FROM n""",
    "wer_pairs": _with(_WER) + " SELECT conv_id, turn, len(r)::INT AS n, CASE WHEN ref <> '' AND hyp <> '' THEN dist / len(r) END AS wer FROM d",
    "speaking_rate": _ROLES + "SELECT seq, length(replace(text, ' ', '')) / greatest(duration_sec, 1e-6::DOUBLE) AS cps FROM audio",
    "quality_flags": _ROLES + "SELECT id, duration_sec, cer, wer, chars_per_sec, CASE WHEN len(flags) = 0 THEN 'none' ELSE array_to_string(flags, ', ') END AS flags, auto_status FROM quality",
    "auto_status_counts": _ROLES + "SELECT auto_status, count(*) AS n FROM quality GROUP BY auto_status",
    "flag_reason_counts": _ROLES + "SELECT flag, count(*) AS n FROM (SELECT unnest(flags) AS flag FROM quality) GROUP BY flag",
    "review_queue": _with(_QUEUE) + " SELECT id, auto_status, priority::INT AS priority, position, array_to_string(flags, ',') AS flags FROM placed",
    "review_decisions": _with(_QUEUE) + " SELECT p.id, position, r.decision, r.final_text AS decided_text, r.note FROM placed p LEFT JOIN reviews r USING (id)",
    "next_unreviewed": _with(_QUEUE) + """
SELECT coalesce(min(position) FILTER (WHERE position > 40), min(position) FILTER (WHERE position < 40), 40)::BIGINT AS next_position
FROM placed WHERE position <> 40 AND id NOT IN (SELECT id FROM reviews)""",
    "navigation": _with(_QUEUE) + " SELECT position, least(position + 1, count(*) OVER () - 1) AS following, greatest(0, position - 1)::BIGINT AS previous FROM placed",
    "review_display": _with(_QUEUE) + """
SELECT id, position, CASE WHEN len(flags) = 0 THEN 'none' ELSE array_to_string(flags, ', ') END AS flags_text,
  coalesce(printf('%.2f', cer), '-') AS cer_text, coalesce(printf('%.2f', wer), '-') AS wer_text, coalesce(printf('%.1f', chars_per_sec), '-') AS cps_text,
  coalesce(printf('%.2fs', duration_sec), '-') AS duration_text, CASE WHEN length(text) > 80 THEN text[1:77] || '...' ELSE text END AS text_short FROM placed""",
    "review_record": _with(_QUEUE) + " SELECT id, 'edit' AS decision, 'an edit' AS final_text, NULL::VARCHAR AS note FROM placed",
    "cer_summary": _ROLES + f"""
SELECT count(*) AS n, round(avg(cer), 9) AS mean_cer, {_UPPER} AS median_cer, {_P90} AS p90_cer, max(cer) AS max_cer, count(*) FILTER (WHERE auto_status = 'flagged') AS n_flagged,
  round(100.0::DOUBLE * count(*) FILTER (WHERE auto_status = 'flagged') / count(*), 9) AS pct_flagged FROM quality""",
    "cer_by_voice": _ROLES + f"SELECT voice_id, {_RATES}, round(median(cer), 9) AS median_cer, {_P90} AS p90_cer FROM report GROUP BY voice_id",
    "cer_by_category": _ROLES + f"SELECT category, {_RATES} FROM report GROUP BY category",
    "category_ratio": _ROLES + """
SELECT count(*) FILTER (WHERE category = 'fr') AS n_in, round(avg(cer) FILTER (WHERE category = 'fr'), 9) AS mean_in, count(*) FILTER (WHERE category <> 'fr') AS n_out,
  round(avg(cer) FILTER (WHERE category <> 'fr'), 9) AS mean_out, round(avg(cer) FILTER (WHERE category = 'fr') / avg(cer) FILTER (WHERE category <> 'fr'), 9) AS ratio FROM report""",
    "reject_rate_by_voice": _ROLES + """
SELECT voice_id, count(*) AS n, count(*) FILTER (WHERE decision = 'reject') AS n_reject, count(*) FILTER (WHERE decision = 'accept') AS n_accept, count(*) FILTER (WHERE decision = 'edit') AS n_edit,
  round(100.0::DOUBLE * count(*) FILTER (WHERE decision = 'reject') / greatest(count(*), 1), 9) AS pct_reject FROM report WHERE decision IS NOT NULL GROUP BY voice_id""",
    "histogram_18": _ROLES + """
SELECT least(floor((cer - low) / ((high - low) / 18)) + 1, 18)::INT AS bin, count(*) AS n, low, high
FROM quality, (SELECT min(cer) AS low, max(cer) AS high FROM quality) WHERE cer IS NOT NULL GROUP BY ALL""",
    "order_statistics_by_category": _ROLES + f"""
SELECT category, {_N} AS n, {_UPPER} AS upper_median, ({_sorted(f"({_N} - 1) // 2")} + {_UPPER}) / 2 AS median, {_P90} AS p90 FROM report GROUP BY category""",
    "cube_voice_category": _ROLES + "SELECT voice_id, category, count(*) AS n, round(avg(cer), 9) AS mean_cer FROM report GROUP BY CUBE (voice_id, category)",
    "stratified_sample_24": _with(f"""
m AS (SELECT id, voice_id, category, audio_path, seq FROM joined WHERE {_REVIEWED} AND {_NOT_REJECTED}),
r AS (SELECT *, row_number() OVER (PARTITION BY voice_id, category ORDER BY seq) AS rnd, min(seq) OVER (PARTITION BY voice_id, category) AS bf FROM m)""") + """
SELECT (row_number() OVER (ORDER BY rnd, bf))::INT AS place, id, voice_id, category, 'audio/' || string_split(audio_path, '/')[-1] AS audio_relpath FROM r ORDER BY rnd, bf LIMIT 24""",
    "dataset_card_stats": _ROLES + f"""
SELECT count(*) AS n_samples, round(coalesce(sum(coalesce(duration_sec, 0)), 0), 9) AS total_sec, round(coalesce(sum(coalesce(duration_sec, 0)), 0) / 60, 9) AS total_min, round(coalesce(avg(cer), 0), 9) AS mean_cer
FROM joined WHERE {_DEFAULT}""",
    "verify_distribution": _with(f"""
m AS (SELECT voice_id, category, decision, seq FROM joined WHERE {_DEFAULT}),
u AS (SELECT 'voice_id' AS "column", voice_id AS value, seq FROM m UNION ALL SELECT 'category', category, seq FROM m UNION ALL SELECT 'review_decision', decision, seq FROM m)""") + """
SELECT "column", value, count(*) AS n, (row_number() OVER (PARTITION BY "column" ORDER BY count(*) DESC, min(seq)))::INT AS place FROM u GROUP BY "column", value""",
    "verify_durations": _ROLES + f"SELECT round(sum(duration_sec), 9) AS total_sec, round(avg(duration_sec), 9) AS mean_sec, round(avg(cer), 9) AS mean_cer, max(cer) AS max_cer FROM joined WHERE {_DEFAULT}",
    "verify_paths": """
WITH p AS (SELECT regexp_extract(url, '^https?://[^/]*(/.*)?$', 1) AS path FROM pages)
SELECT count(*) AS n, count(*) FILTER (WHERE regexp_matches(path, '^([A-Za-z]:|/)')) AS n_absolute,
  count(*) FILTER (WHERE NOT regexp_matches(path, '^([A-Za-z]:|/)') AND NOT starts_with(path, '/en/')) AS n_outside, count(*) FILTER (WHERE path IS NULL) AS n_null FROM p""",
    "leaked_paths": """
WITH p AS (SELECT page_id::VARCHAR AS id, url, string_split(url, '://')[-1] AS rest FROM pages),
u AS (SELECT id, 'id' AS field, id AS value FROM p UNION ALL SELECT id, 'url', url FROM p UNION ALL SELECT id, 'rest', rest FROM p)
SELECT id, field, value FROM u WHERE starts_with(value, 'http:') OR starts_with(value, 'm.') OR starts_with(value, 'blog.')""",
    "relative_paths": """
SELECT page_id, 'audio/' || string_split(url, '/')[-1] AS relative, url AS posix, '/base/' || string_split(url, '/')[-1] AS absolute, regexp_matches(url, '^([A-Za-z]:|/)') AS is_absolute FROM pages""",
    "missing_audio_files": _ROLES + "SELECT id, audio_path FROM audio WHERE audio_path NOT IN (SELECT source || '/' || d.doc_id || '.wav' FROM labels JOIN documents d USING (doc_id))",
    "final_schema_cast": _ROLES + f"""
SELECT id, 'audio/' || string_split(audio_path, '/')[-1] AS audio, coalesce(nullif(final_text, ''), text) AS text, duration_sec::FLOAT AS duration_sec, sample_rate, cer::FLOAT AS asr_cer, wer::FLOAT AS asr_wer,
  true AS is_synthetic, CASE WHEN has_quality THEN array_to_string(flags, ',') ELSE '' END AS auto_flags FROM joined WHERE {_DEFAULT}""",
    "display_labels": _ROLES + """
SELECT CASE voice_id WHEN 'ar-EG-SalmaNeural' THEN 'Salma' WHEN 'ar-EG-ShakirNeural' THEN 'Shakir' ELSE voice_id END AS label, count(*) AS n, round(sum(duration_sec), 6) AS total_sec FROM audio GROUP BY 1""",
    "error_texts": _ROLES + "SELECT seq, concat_ws(': ', decision, final_text) AS error FROM log",
    "json_props": _ROLES + "SELECT seq, json_extract_string(final_text, '$.k')::INT AS k, 2 AS n FROM log",
    "segments_joined": "SELECT doc_id AS seq, trim(array_to_string(list_transform(string_split(text, chr(10)), lambda x: trim(x, ' ')), ' '), ' ') AS joined FROM documents",
    "jsonl_roundtrip": _ROLES + "SELECT id, decision, final_text, note, seq FROM log",
    "export_parquet_roundtrip": _ROLES + f"SELECT category, count(*) AS n, count(*) FILTER (WHERE cer IS NULL) AS n_null, max(duration_sec)::FLOAT::DOUBLE AS longest FROM joined WHERE {_DEFAULT} GROUP BY category",
    "stream_latest": _ROLES + "SELECT id, arg_max(decision, seq) AS decision, max(seq) AS seq FROM log GROUP BY id",
    "stream_dedup": _ROLES + "SELECT DISTINCT id, decision FROM log",
    "stream_resume": _ROLES + "SELECT id, min(seq) AS seq FROM log GROUP BY id",
}
# over several files a stream ends where it ends over one
ORACLES |= {f"{name}_files": ORACLES[name] for name in ("stream_latest", "stream_dedup", "stream_resume")}
