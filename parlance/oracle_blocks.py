"""DuckDB SQL of queries_blocks, with literals of its own."""

from __future__ import annotations

SAMPLES = """
    SELECT session_id, printf('SPEAKER_%02d', p) AS speaker, i, greatest(-1, least(1, ((session_id * 131 + i * (i % 97) * 7 + p * 17) % 2001 - 1000) * [0, 4, 300, 1200][(i // 200 + session_id + p) % 4 + 1] / 1e6))::FLOAT::DOUBLE AS x
    FROM (SELECT DISTINCT session_id FROM turns), (SELECT unnest([0, 1]) AS p), (SELECT unnest(range(2000)) AS i)"""

SQL = {
    "record_default_blocks": """
        SELECT DISTINCT session_id,
          '{"estimated_word_accuracy":null,"estimated_timestamp_accuracy":null,"estimated_code_switch_accuracy":null,"benchmark_evaluated":false,"human_review_completed":false}' AS quality_metrics,
          '{"required":true,"status":"pending","review_stage":"transcript_review","priority":{"level":"normal","score":0.0,"reasons":[]},"reviewer_id":null,"notes":null}' AS human_review,
          '{"pipeline_mode":"offline_standard","paid_api_used":false,"engines_used":["whisper_local"],"consensus_applied":false,"timestamp_refinement_applied":false,"human_review_required":true}' AS premium_processing,
          '{"pipeline_mode":"offline_standard","paid_api_allowed":false,"local_first":true,"difficulty_score":0.0,"should_escalate":false,"escalated_to_paid":false,"reasons":[],"attempted_engines":["whisper_local"],"skipped_engines":[],"engines_attempted":["whisper_local"],"engines_skipped":[],"engines_used":["whisper_local"]}' AS routing_decision,
          '{"timestamp_method":null,"timestamp_confidence":null,"word_timestamps_available":false,"segment_timestamps_available":false,"refinement_applied":false,"synthetic_word_timestamps":false,"timing_quality":"low","notes":[]}' AS timestamp_refinement,
          CASE WHEN session_id % 3 = 0 THEN '{"passed":true}' ELSE '{"target_word_accuracy":0.99,"estimated_word_accuracy":0.0,"verified_word_accuracy":null,"target_speaker_accuracy":0.99,"estimated_speaker_accuracy":0.0,"verified_speaker_accuracy":null,"target_timestamp_accuracy":0.98,"estimated_timestamp_accuracy":0.0,"verified_timestamp_accuracy":null,"target_code_switch_accuracy":0.99,"estimated_code_switch_accuracy":0.0,"verified_code_switch_accuracy":null,"estimated":true,"verified_accuracy":false,"passed":false,"human_review_required":true,"human_review_completed":false,"human_review_required_for_delivery":true,"word_accuracy_basis":"reviewed_delivery_confidence","asr_accuracy_basis":"asr_vs_review_only_not_delivery_claim","reviewed_delivery_target_met":false,"measured_word_accuracy_available":false,"measured_word_accuracy":null,"reviewed_delivery_confidence":null,"reasons":["accuracy_gate_not_evaluated"]}' END AS accuracy_gate,
          '{"stage":"review_required","approved_for_client_delivery":false,"reason":"accuracy_gate_not_evaluated"}' AS delivery_status
        FROM turns""",
    "quality_target_policy": """
        SELECT DISTINCT session_id, [0.98, 0.97, 0.95][session_id % 3 + 1]::DOUBLE AS transcript_accuracy_target, [0.98, 0.97, 0.95][session_id % 3 + 1]::DOUBLE AS word_accuracy_target, 0.99::DOUBLE AS speaker_accuracy_target,
          0.98::DOUBLE AS timestamp_accuracy_target, [0.98, 0.98, 0.95][session_id % 3 + 1]::DOUBLE AS code_switch_accuracy_target, session_id % 3 = 0 AS human_review_required FROM turns""",
    "model_versions": "SELECT DISTINCT session_id, m.model, m.version FROM turns, (VALUES ('whisper', 'large-v3'), ('vad', 'energy')) m(model, version)",
    "review_target_precedence": """
        SELECT DISTINCT session_id, CASE WHEN session_id % 3 = 0 THEN 0.9 WHEN session_id % 2 = 0 THEN 0.95 ELSE 0.99 END::DOUBLE AS word, CASE WHEN session_id % 5 <> 0 THEN 0.96 ELSE 0.99 END::DOUBLE AS speaker,
          CASE WHEN session_id % 5 = 0 THEN 0.5 ELSE 0.98 END::DOUBLE AS "timestamp", 0.99::DOUBLE AS code_switch FROM turns""",
    "second_pass": "SELECT DISTINCT session_id, session_id % 7 = 0 OR session_id % 11 = 0 OR session_id % 13 = 0 OR session_id % 17 = 0 OR session_id % 19 = 0 OR session_id % 6 = 0 AS second_pass_required FROM turns",
    "review_baseline": """
        SELECT session_id, CASE WHEN session_id % 3 = 0 THEN string_agg(text || '!', '|' ORDER BY idx) ELSE string_agg(text, '|' ORDER BY idx) END AS text,
          CASE WHEN session_id % 3 = 0 THEN 'asr_transcript_before_review' ELSE 'current_transcript_before_first_review' END AS source FROM turns GROUP BY session_id""",
    "known_speakers": """
        SELECT session_id, coalesce(string_agg(DISTINCT s, ',' ORDER BY s), '') AS speakers FROM (
          SELECT DISTINCT session_id FROM turns) LEFT JOIN (
          SELECT session_id, speaker AS s FROM turns WHERE session_id % 2 = 0 UNION SELECT session_id, 'SPEAKER_07' FROM turns WHERE session_id % 3 = 0
          UNION SELECT session_id, unnest(['SPEAKER_00', 'SPEAKER_01']) FROM turns WHERE session_id % 2 = 0 OR session_id % 3 = 0) USING (session_id) GROUP BY session_id""",
    "delivery_at_processing": """
        SELECT session_id, CASE WHEN ok THEN 'approved' WHEN session_id % 5 = 0 THEN 'review_required' ELSE 'rejected' END AS stage, ok AS approved_for_client_delivery,
          CASE WHEN ok THEN '' WHEN session_id % 4 = 0 THEN 'word_below_target;no_review' WHEN session_id % 5 = 0 THEN 'human_review_pending' WHEN session_id % 3 = 0 THEN 'validation_failed' ELSE '' END AS reason
        FROM (SELECT DISTINCT session_id, session_id % 2 = 0 AND session_id % 3 <> 0 AND session_id % 5 <> 0 AS ok FROM turns)""",
    "basic_metadata": "SELECT session_id, count(*) AS turn_count, count(DISTINCT speaker) AS speaker_count, 'basic' AS metadata_depth FROM turns GROUP BY session_id",
    "basic_speaker_metadata": "SELECT session_id, speaker, count(*) AS turn_count FROM turns GROUP BY ALL",
    "language_aliases": """
        WITH s AS (SELECT *, CASE WHEN length(text) % 7 <> 0 THEN language ELSE 'unknown' END AS lang, coalesce(nullif(CASE WHEN length(text) % 3 <> 0 THEN quality_score ELSE 0.7 END, 0), 0.5) AS conf FROM segments),
        m AS (SELECT *, lag(lang) OVER (PARTITION BY session_id ORDER BY idx) AS l FROM s),
        p AS (SELECT session_id, l || '→' || lang AS p, min(idx) AS place, count(*) AS c FROM m WHERE l <> lang GROUP BY ALL),
        q AS (SELECT session_id, sum(c) AS n, string_agg(p, ',' ORDER BY place) AS p FROM p GROUP BY session_id)
        SELECT session_id, t AS segments, coalesce(n, 0)::INTEGER AS switch_count, coalesce(p, '') AS patterns
        FROM (SELECT session_id, string_agg(printf('%.3f-%.3f:%s:%.3f', s_ms / 1000.0::DOUBLE, e_ms / 1000.0::DOUBLE, lang, conf::DOUBLE), ',' ORDER BY idx) AS t FROM s GROUP BY session_id) LEFT JOIN q USING (session_id)""",
    "interaction_aliases": """
        SELECT session_id, count(*) AS total_turns, sum(CASE WHEN contains(text, '?') THEN 1 END)::BIGINT AS interruption_count, count(*) AS turn_count, coalesce(sum(CASE WHEN contains(text, '?') THEN 1 END), 0)::BIGINT AS interruptions,
          0.0::DOUBLE AS overlap_duration, NULL::DOUBLE AS avg_response_latency, any_value(shares) AS speaker_dominance
        FROM turns JOIN (SELECT session_id, string_agg(speaker || ':' || printf('%.9f', ms / CASE WHEN total = 0 THEN 1 ELSE total END::DOUBLE), ',' ORDER BY speaker) AS shares
          FROM (SELECT session_id, speaker, sum(e_ms - s_ms) AS ms, sum(sum(e_ms - s_ms)) OVER (PARTITION BY session_id) AS total FROM turns GROUP BY session_id, speaker) GROUP BY session_id) USING (session_id) GROUP BY session_id""",
    "candidate_payload": r"""
        SELECT session_id, engine, count(*)::INTEGER AS full_segments, sum(n)::INTEGER AS full_inner, sum(n)::INTEGER AS full_words, count(*)::INTEGER AS slim_segments, 0 AS slim_inner, 0 AS slim_words, 0 AS bare_segments, 0 AS bare_inner, sum(n)::INTEGER AS bare_words
        FROM (SELECT *, len(regexp_extract_all(text, '[^ \t\n\r\f]+')) AS n FROM candidates) GROUP BY ALL""",
    "normalisation_notes": r"""
        SELECT session_id, idx, array_to_string(list_filter([CASE WHEN k % 3 = 0 THEN 'vendor_note' END,
            CASE WHEN regexp_matches(t, '[^\p{L}\p{N}_\s]') THEN 'punctuation_normalisation_applied_for_comparison' END, CASE WHEN regexp_matches(t, '[0-9०-९੦-੯]') THEN 'numeral_normalisation_applied_for_comparison' END,
            CASE WHEN len(list_intersect(string_split_regex(lower(trim(t)), '\s+'), ['hai', 'hain', 'nahi', 'nahin', 'kya', 'kyun', 'kaise', 'mera', 'meri', 'tera', 'aap', 'hum', 'tum', 'mein', 'aur', 'lekin', 'bahut', 'accha', 'namaste', 'thik', 'abhi', 'kal', 'aaj', 'raha', 'rahi', 'karo', 'karna', 'gaya', 'tha', 'thi', 'kuch', 'sab', 'yeh', 'woh', 'tusi', 'tussi', 'assi', 'menu', 'tenu', 'kiven', 'kidda', 'changa', 'vadiya', 'sanu', 'ohna', 'kithe', 'hunda', 'karda', 'kardi', 'hega', 'paaji', 'sat', 'sri', 'akal', 'nu', 'vich', 'mhare', 'mharo', 'tharo', 'thare', 'kain', 'padharo', 'ghano', 'ghani', 'sa', 'khamma', 'chhe', 'konni', 'hukum', 'mhane', 'thane', 'bega'])) > 0 THEN 'romanized_indic_tokens_present' END,
            CASE WHEN contains(t, '-') THEN 'provider_token_split_merge_variation_detected' END], lambda x: x IS NOT NULL), ',') AS notes
        FROM (SELECT *, session_id + idx AS k, CASE WHEN (session_id + idx) % 4 = 0 THEN regexp_replace(text, '[^A-Za-z0-9 ]', '', 'g') ELSE text END || CASE WHEN (session_id + idx) % 5 = 0 THEN ' namaste' ELSE '' END || CASE WHEN (session_id + idx) % 7 = 0 THEN ' ४२ co-op' ELSE '' END AS t FROM turns)""",
    "candidate_rationale": """
        SELECT session_id, engine, 'token_agreement=' || printf('%.4f', conf) || ';timing_agreement=' || printf('%.4f', word_conf) || ';code_switch_preservation=' || printf('%.4f', ts_conf) || ';switch_structure_agreement=' || printf('%.4f', conf)
          || CASE WHEN switch_count = 1 THEN ';normalisation=a,b' ELSE '' END || CASE WHEN ts_conf < 0.55 THEN ';weak_timestamp_confidence' ELSE '' END || CASE WHEN len(langs) < 2 AND switch_count > 0 THEN ';collapsed_multilingual_boundaries' ELSE '' END AS rationale FROM signals""",
    "diarisation_fallback": "SELECT DISTINCT session_id, CASE WHEN session_id % 3 = 0 THEN 'kmeans' WHEN session_id % 4 = 0 THEN 'kmeans_fallback' ELSE 'pyannote' END AS backend FROM turns",
    "document_language": """
        SELECT session_id, CASE k WHEN 0 THEN CASE WHEN m >= 0.25 THEN 'mwr' ELSE 'hi' END WHEN 1 THEN CASE WHEN m >= 0.25 THEN 'mwr' ELSE 'hi' END WHEN 2 THEN 'pa' WHEN 3 THEN 'pa' ELSE CASE WHEN session_id % 2 = 0 THEN 'pa' ELSE 'en' END END AS language,
          CASE k WHEN 0 THEN CASE WHEN m >= 0.25 THEN greatest(0.70, m) ELSE 0.9 END WHEN 1 THEN CASE WHEN m >= 0.25 THEN greatest(0.65, m) ELSE 0.75 END WHEN 2 THEN 0.9 WHEN 3 THEN 0.75 ELSE CASE WHEN session_id % 2 = 0 THEN 0.55 + 0.3 * (session_id % 7) / 10.0 ELSE 0.6 END END::DOUBLE AS confidence
        FROM (SELECT DISTINCT session_id, session_id % 5 AS k, (session_id % 11) / 20.0::DOUBLE AS m FROM turns)""",
    "bcp47_tags": """
        SELECT DISTINCT session_id, c.code, c.tag FROM turns JOIN (VALUES (0, 'hi', 'hi-Deva'), (1, 'pa', 'pa-Guru'), (2, 'mr', 'mr-Deva'), (3, 'en', 'en-IN'), (4, 'hinglish', 'hi-Latn'), (5, 'ur', 'ur-Arab'), (6, 'gu', 'gu-Gujr'), (7, 'bn', 'bn-Beng'),
          (8, 'ta', 'ta-Taml'), (9, 'te', 'te-Telu'), (10, 'kn', 'kn-Knda'), (11, 'ml', 'ml-Mlym'), (12, 'mwr', 'mwr-Latn'), (13, 'fr', 'fr'), (14, 'pa-Latn', 'pa-Latn'), (15, 'HI', 'HI')) c(k, code, tag) ON session_id % 16 = c.k""",
    "conversation_manifest": """
        SELECT session_id::VARCHAR AS session, 'pair' AS input_mode, '' AS generated_at, NULL::DOUBLE AS duration_s, NULL::DOUBLE AS conversation_duration_s, count(*) AS turn_count, count(DISTINCT speaker) AS speaker_count, NULL::VARCHAR AS primary_language, NULL::VARCHAR AS dominant_language,
          session_id % 2 = 0 AS multilingual, NULL::DOUBLE AS switching_score, NULL::DOUBLE AS engagement_score, NULL::VARCHAR AS dominant_speaker, NULL::BOOLEAN AS alignment_applied, NULL::DOUBLE AS alignment_confidence, NULL::DOUBLE AS mono_mix_peak_after, NULL::DOUBLE AS mean_quality_score,
          NULL::BOOLEAN AS validation_passed, count(*) % 3 AS validation_issue_count, '' AS mono_audio_path, '/data/annotations/' || session_id || '.json' AS annotation_path FROM turns GROUP BY session_id""",
    "speaker_manifest": """
        WITH s AS (SELECT session_id AS session, speaker, speaker AS label, count(*) AS turn_count, CASE session_id % 3 WHEN 0 THEN speaker || '.wav' WHEN 1 THEN '' END AS monologue_path FROM turns GROUP BY session_id, speaker)
        SELECT 'speakers' AS manifest, * FROM s UNION ALL SELECT 'monologues', * FROM s WHERE monologue_path <> ''""",
    "studio_folders": "SELECT DISTINCT printf('conversation_%03d', page_id % 40) AS folder FROM pages WHERE page_id % 3 <> 0",
    "waveform_measures": f"""
        WITH x AS ({SAMPLES}), l AS (SELECT session_id, speaker, 20 * log10(sqrt(avg(x * x))) AS db, avg((abs(x) >= 0.99::FLOAT)::INTEGER) AS clip FROM x GROUP BY ALL),
        q AS (SELECT session_id, speaker, avg((v < 0.005)::INTEGER) AS quiet FROM (SELECT session_id, speaker, i // 50 AS f, sqrt(avg(x * x)) AS v FROM x GROUP BY ALL) GROUP BY ALL)
        SELECT session_id, speaker, 2.0::DOUBLE AS duration_s, round(db, 3) AS rms_db, clip AS clipping_ratio, quiet AS silence_ratio,
          concat_ws(',', CASE WHEN clip >= 0.05 THEN speaker || ': heavy clipping' END, CASE WHEN quiet >= 0.8 THEN speaker || ': mostly silent' END) AS errors,
          concat_ws(',', CASE WHEN clip >= 0.01 AND clip < 0.05 THEN speaker || ': mild clipping' END, CASE WHEN quiet >= 0.5 AND quiet < 0.8 THEN speaker || ': high silence ratio' END) AS warnings
        FROM l JOIN q USING (session_id, speaker)""",
    "waveform_segment_snr": f"""
        WITH x AS ({SAMPLES}), s(k, a, b) AS (VALUES (0, 0, 800), (1, 800, 1000), (2, 200, 1400), (3, 1000, 2000)),
        m AS (SELECT session_id, speaker, k, b - a AS n, CASE WHEN avg(x * x) > 0 THEN 20 * log10(sqrt(avg(x * x))) ELSE -120 END AS db, stddev_pop(x) AS sd, quantile_cont(abs(x), 0.2) AS lo, quantile_cont(abs(x), 0.9) AS hi, avg((abs(x) >= 0.99::FLOAT)::INTEGER) AS clip FROM x JOIN s ON i >= a AND i < b GROUP BY ALL),
        r AS (SELECT *, n >= 500 AND db >= -60 AND sd >= 1e-6 AND lo > 1e-9 AND hi > lo AS known FROM m)
        SELECT session_id, speaker, k, CASE WHEN known THEN round(greatest(-10, least(60, 20 * log10(hi / nullif(lo, 0)))), 3) END AS snr_db,
          CASE WHEN n < 500 THEN 'short_segment' WHEN db < -60 THEN 'below_noise_floor' WHEN clip > 0.005 THEN 'clipped' WHEN NOT known THEN 'unreliable_estimate' END AS snr_reason, CASE WHEN n < 500 THEN 0 ELSE round(clip, 6) END::DOUBLE AS clipping_ratio FROM r""",
    "channel_mix": f"""
        WITH x AS ({SAMPLES}), l AS (SELECT session_id, speaker, sqrt(avg(x * x)) AS v FROM x GROUP BY ALL), t AS (SELECT session_id, greatest(0.01, least(0.35, median(v))) AS target FROM l GROUP BY ALL),
        m AS (SELECT session_id, i, sum(x * least(2.0, target / v)) / 2 AS y FROM x JOIN l USING (session_id, speaker) JOIN t USING (session_id) GROUP BY ALL), p AS (SELECT session_id, max(abs(y)) AS top FROM m GROUP BY ALL)
        SELECT session_id, round(top, 4) AS peak_before, round(CASE WHEN top > 0.98 THEN 0.95 ELSE top END, 4) AS peak_after, top > 0.98 AS clipping_prevented FROM p""",
    "waveform_speech": f"""
        WITH x AS ({SAMPLES}), l AS (SELECT session_id, speaker, (sqrt(avg(x * x)) + 1e-9) * 0.15 AS bar FROM x GROUP BY ALL),
        f AS (SELECT session_id, speaker, i // 30 AS f, sqrt(sum(x * x) / count(*)) AS v FROM x GROUP BY ALL), h AS (SELECT session_id, speaker, f, f - row_number() OVER (PARTITION BY session_id, speaker ORDER BY f) AS g FROM f JOIN l USING (session_id, speaker) WHERE v >= bar),
        r AS (SELECT session_id, speaker, min(f) * 30 AS a, least((max(f) + 1) * 30, 2000) AS b FROM h GROUP BY session_id, speaker, g), k AS (SELECT *, max(b) OVER (PARTITION BY session_id, speaker ORDER BY a ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before FROM r WHERE b - a >= 250),
        n AS (SELECT *, sum(CASE WHEN before IS NULL OR a - before > 300 THEN 1 ELSE 0 END) OVER (PARTITION BY session_id, speaker ORDER BY a) AS g FROM k)
        SELECT session_id, speaker, row_number() OVER (PARTITION BY session_id, speaker ORDER BY min(a)) - 1 AS idx, greatest(0, min(a) - 120)::BIGINT AS s_ms, least(2000, max(b) + 120)::BIGINT AS e_ms FROM n GROUP BY session_id, speaker, g""",
    "channel_offset": """
        SELECT session_id, s.speaker, CASE WHEN s.speaker = 'SPEAKER_01' THEN 30 - session_id % 61 ELSE 0 END::INTEGER AS offset_ms, TRUE AS passed, s.speaker = 'SPEAKER_01' AND session_id % 61 <> 30 AS applied, 2000::DOUBLE AS samples, TRUE AS whole
        FROM (SELECT DISTINCT session_id FROM turns), (VALUES ('SPEAKER_00'), ('SPEAKER_01')) s(speaker)""",
    "waveform_wav": "SELECT session_id, s.speaker, 1000 AS sample_rate, 1 AS channels, 16 AS bits, 44 + 2 * 2000 AS bytes FROM (SELECT DISTINCT session_id FROM turns), (VALUES ('SPEAKER_00'), ('SPEAKER_01')) s(speaker)",
    "schema_gate_compiled": """
        SELECT session_id, len(x)::BIGINT AS n_errors, list_sort(list_transform(x, lambda e: {'d': -len(string_split(split_part(e, ': ', 1), ' -> ')) + CASE WHEN starts_with(e, '(root)') THEN 1 ELSE 0 END, 'e': e}))[1].e AS first_error,
               array_to_string(list_sort(x), '; ') AS errors
        FROM (SELECT session_id, list_concat(list_filter([
            CASE WHEN j->>'$.schema_version' <> '3.0.0' THEN 'schema_version: const' END,
            CASE WHEN length(j->>'$.session_name') < 1 THEN 'session_name: minLength' END,
            CASE WHEN NOT json_exists(j, '$.transcript.raw') THEN 'transcript: required raw' END,
            CASE WHEN json_type(j, '$.metadata') <> 'OBJECT' THEN 'metadata: type' END,
            CASE WHEN json_type(j, '$.validation.passed') <> 'BOOLEAN' THEN 'validation -> passed: type' END,
            CASE WHEN (j->>'$.accuracy_gate.estimated_word_accuracy')::DOUBLE > 1 THEN 'accuracy_gate -> estimated_word_accuracy: maximum' END,
            CASE WHEN json_type(j, '$.accuracy_gate.verified_word_accuracy') NOT IN ('NULL', 'DOUBLE') THEN 'accuracy_gate -> verified_word_accuracy: anyOf' END,
            CASE WHEN json_type(j, '$.accuracy_gate.reasons[0]') <> 'VARCHAR' THEN 'accuracy_gate -> reasons -> 0: type' END,
            CASE WHEN j->>'$.delivery_status.stage' NOT IN ('review_required', 'reviewed', 'approved', 'rejected') THEN 'delivery_status -> stage: enum' END,
            CASE WHEN j->>'$.pipeline_mode' = 'premium_accuracy' AND NOT json_exists(j, '$.consensus') THEN '(root): required consensus' END,
            CASE WHEN j->>'$.pipeline_mode' = 'premium_accuracy' AND NOT json_exists(j, '$.review_artifacts') THEN '(root): required review_artifacts' END,
            CASE WHEN j->>'$.pipeline_mode' = 'premium_accuracy' AND NOT json_exists(j, '$.transcript_candidates') THEN '(root): required transcript_candidates' END],
          lambda e: e IS NOT NULL), flatten(list_transform(range(json_array_length(j, '$.transcript.segments')::BIGINT), lambda i: list_filter([
            CASE WHEN length(json_extract_string(j, '$.transcript.segments[' || i || '].segment_id')) < 1 THEN 'transcript -> segments -> ' || i || ' -> segment_id: minLength' END,
            CASE WHEN json_extract_string(j, '$.transcript.segments[' || i || '].start')::DOUBLE < 0 THEN 'transcript -> segments -> ' || i || ' -> start: minimum' END,
            CASE WHEN json_extract_string(j, '$.transcript.segments[' || i || '].sample_rate')::BIGINT < 1 THEN 'transcript -> segments -> ' || i || ' -> sample_rate: minimum' END,
            CASE WHEN json_extract(j, '$.transcript.segments[' || i || '].speaker_id') IS NULL THEN 'transcript -> segments -> ' || i || ': required speaker_id' END],
          lambda e: e IS NOT NULL)))) AS x
        FROM (SELECT session_id, json_object('schema_version', CASE WHEN k = 1 THEN '2.0.0' ELSE '3.0.0' END, 'session_name', CASE WHEN k = 2 THEN '' ELSE 'session_' || session_id END, 'session_id', session_id::VARCHAR,
            'pipeline_mode', CASE WHEN session_id % 2 = 1 THEN 'premium_accuracy' ELSE 'offline_standard' END, 'metadata', CASE WHEN k = 13 THEN '[]' ELSE '{}' END::JSON, 'validation', json_object('passed', CASE WHEN k = 7 THEN '"yes"' ELSE 'true' END::JSON),
            'transcript', json_merge_patch(json_object('segments', segs), CASE WHEN k = 3 THEN '{}'::JSON ELSE json_object('raw', raw) END),
            'accuracy_gate', json_object('estimated_word_accuracy', CASE WHEN k = 8 THEN 1.5 ELSE 0.5 END, 'verified_word_accuracy', CASE WHEN k = 11 THEN '"x"' ELSE 'null' END::JSON, 'reasons', CASE WHEN k = 12 THEN '[1]' ELSE '["a"]' END::JSON),
            'delivery_status', json_object('stage', CASE WHEN k = 9 THEN 'sent' ELSE 'approved' END)) AS base,
            CASE WHEN session_id % 3 <> 0 THEN (rtrim(base::VARCHAR, '}') || repeat('}', length(base::VARCHAR) - length(rtrim(base::VARCHAR, '}')) - 1) || ',"consensus":{},"review_artifacts":{},"transcript_candidates":[]}')::JSON ELSE base END AS j
          FROM (SELECT session_id, session_id % 14 AS k, string_agg(coalesce(text, ''), ' ' ORDER BY idx) AS raw,
                  list(CASE WHEN session_id % 14 = 6 THEN json_object('segment_id', printf('%d_%04d', session_id, idx), 'start', s_ms / 1000.0, 'sample_rate', 16000)
                            ELSE json_object('segment_id', CASE WHEN session_id % 14 = 5 AND idx = 0 THEN '' ELSE printf('%d_%04d', session_id, idx) END, 'start', CASE WHEN session_id % 14 = 4 AND idx = 0 THEN -1.0 ELSE s_ms / 1000.0 END,
                                             'speaker_id', speaker, 'sample_rate', CASE WHEN session_id % 14 = 10 THEN 0 ELSE 16000 END) END ORDER BY idx) AS segs
                FROM turns GROUP BY session_id)))""",
}
