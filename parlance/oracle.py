"""DuckDB SQL for the queries: each over the shared relations below, in the same integers."""

from __future__ import annotations

import re

from . import lexicons as lex
from . import oracle_blocks
from .operators.language import PUNCTUATED
from .operators.speakers import DOMAINS, EDGE, INTENTS

TOKEN = r"[\p{L}\p{N}_'']+"
WORD = r"[^ \t\n\r\f]+"


def _list(words: tuple[str, ...]) -> str:
    return "[" + ", ".join("'" + w.replace("'", "''") + "'" for w in words) + "]"


RELATIONS = {
    "turns": rf"""
        SELECT session_id, idx, speaker, s_ms, s_ms + dur AS e_ms, text, turn FROM (
          SELECT *, coalesce(sum(dur + gap) OVER (PARTITION BY session_id ORDER BY idx ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS s_ms FROM (
            SELECT conv_id AS session_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS idx,
                   CASE WHEN role = 'user' THEN 'SPEAKER_00' ELSE 'SPEAKER_01' END AS speaker,
                   (300 + 40 * least(len(regexp_extract_all(lower(text), '{TOKEN}')), 200))::BIGINT AS dur,
                   ((conv_id * 31 + turn * 17) % 11 - 4) * 100 AS gap, text, turn
            FROM conversations WHERE role IN ('user', 'assistant')))""",
    "segments": rf"""
        SELECT session_id, idx, speaker, s_ms, e_ms, text, turn,
               ['en', 'hi-Latn', 'pa-Latn', 'mwr-Latn', 'hi'][(session_id + turn * 3) % 5 + 1] AS language,
               -((session_id * 7 + turn * 13) % 100) / 50.0::DOUBLE AS avg_logprob,
               1 + ((session_id * 3 + turn * 5) % 30) / 10.0::DOUBLE AS compression_ratio,
               ((session_id + turn * 11) % 50) / 100.0::DOUBLE AS no_speech_prob,
               (-50 + (session_id * 5 + turn) % 40)::DOUBLE AS rms_db,
               CASE WHEN (session_id + turn) % 5 <> 0 THEN ((session_id * 11 + turn * 7) % 35)::DOUBLE END AS snr_db,
               ((session_id + turn) % 200) / 10000.0::DOUBLE AS clipping_ratio,
               ((session_id * 17 + turn * 29) % 101) / 100.0::DOUBLE AS quality_score,
               len(regexp_extract_all(text, '{WORD}'))::BIGINT AS n_words
        FROM turns""",
    "words": rf"""
        SELECT session_id, seg_idx, i AS word_idx, speaker, w[i + 1] AS word, s_ms + (i * (e_ms - s_ms)) // n AS ws_ms, s_ms + ((i + 1) * (e_ms - s_ms)) // n AS we_ms
        FROM (SELECT *, len(w) AS n, unnest(range(len(w))) AS i FROM (SELECT session_id, idx AS seg_idx, speaker, s_ms, e_ms, regexp_extract_all(text, '{WORD}') AS w FROM turns))""",
    "intervals": """
        SELECT user_id AS session_id, event_type AS speaker, epoch_us(ts) // 1000 AS s_ms, epoch_us(ts) // 1000 + floor(value * 60000)::BIGINT AS e_ms, event_id AS idx FROM events WHERE value IS NOT NULL""",
    "candidates": rf"""
        SELECT session_id, e.engine AS engine, idx, turn, s_ms + e.k * 40 AS s_ms, e_ms + e.k * 40 AS e_ms,
               CASE e.k WHEN 0 THEN text WHEN 1 THEN lower(array_to_string(list_filter(w, lambda x, i: i % 7 <> 0), ' '))
                        ELSE array_to_string(flatten(list_transform(w, lambda x, i: CASE WHEN i % 5 = 0 THEN [x, x] ELSE [x] END)), ' ') END AS text
        FROM (SELECT *, regexp_extract_all(text, '{WORD}') AS w FROM turns), (VALUES (0, 'whisper_local'), (1, 'deepgram'), (2, 'google')) e(k, engine)""",
    "signals": """
        SELECT session_id, engine, (500 + (session_id * 37 + k * 211) % 500) / 1000.0::DOUBLE AS conf, (450 + (session_id * 53 + k * 97) % 500) / 1000.0::DOUBLE AS word_conf,
               (300 + (session_id * 29 + k * 331) % 700) / 1000.0::DOUBLE AS ts_conf, (session_id + k * 2) % 4 AS switch_count,
               ['en', 'hi', 'pa'][1:(session_id + k) % 3 + 1] AS langs, ['en→hi', 'hi→en'][1:(session_id + k * 2) % 3] AS patterns
        FROM (SELECT DISTINCT session_id FROM turns), (VALUES (0, 'whisper_local'), (1, 'deepgram'), (2, 'google')) e(k, engine)""",
    "reviews": """
        SELECT t.session_id, t.idx, printf('%d_%04d', t.session_id, t.idx) AS segment_id, t.speaker, t.s_ms, t.e_ms, c.text AS asr_text, t.text AS reviewed_text,
               CASE WHEN (t.session_id + t.turn) % 13 = 0 THEN CASE t.speaker WHEN 'SPEAKER_00' THEN 'SPEAKER_01' ELSE 'SPEAKER_00' END ELSE t.speaker END AS r_speaker,
               t.s_ms + ((t.session_id * 7 + t.turn * 3) % 5) * 100 AS rs_ms, t.e_ms + ((t.session_id * 7 + t.turn * 3) % 5) * 100 AS re_ms,
               CASE WHEN (t.session_id * 3 + t.turn) % 17 = 0 THEN 1 ELSE 0 END AS n_open
        FROM turns t JOIN candidates c ON t.session_id = c.session_id AND t.idx = c.idx AND c.engine = 'deepgram'""",
    "ordered": "SELECT *, row_number() OVER (PARTITION BY session_id ORDER BY s_ms, idx) AS ord FROM turns",
    "crossings": """
        SELECT a.session_id, a.idx AS ia, b.idx AS ib, a.speaker AS speaker_a, b.speaker AS speaker_b, greatest(a.s_ms, b.s_ms) AS o_start, least(a.e_ms, b.e_ms) AS o_end,
               least(a.e_ms, b.e_ms) - greatest(a.s_ms, b.s_ms) AS dur_ms
        FROM ordered a JOIN ordered b ON a.session_id = b.session_id AND a.ord < b.ord AND a.speaker <> b.speaker AND b.s_ms < a.e_ms AND a.s_ms < b.e_ms""",
    "gaps": "SELECT *, lead(speaker) OVER w AS nxt, lead(s_ms) OVER w - e_ms AS gap FROM ordered WINDOW w AS (PARTITION BY session_id ORDER BY ord)",
    "talk": "SELECT session_id, speaker, sum(greatest(0, e_ms - s_ms))::BIGINT AS speaking_ms, count(*) AS n_turns FROM turns GROUP BY ALL",
    "soft": """
        SELECT session_id, idx, len(w) = 0 OR len(list_filter(w, lambda x: list_contains(l, x))) >= 0.7 * len(w) AS soft FROM (
          SELECT session_id, idx, list_transform(list_filter(regexp_split_to_array(trim(coalesce(x.text, '')), '\\s+'), lambda x: x <> ''), lambda x: lower(regexp_replace(x, '^[.,!?;:''"-]+|[.,!?;:''"-]+$', '', 'g'))) AS w,
                 CASE split_part(lower(coalesce(x.language, '')), '-', 1) """
    + " ".join(f"WHEN '{k}' THEN {_list((*lex.BACKCHANNELS['default'], *lex.BACKCHANNELS[v]))}" for k, v in lex.PROFILES.items())
    + f""" ELSE {_list(lex.BACKCHANNELS["default"])} END AS l FROM (
            SELECT t.session_id, t.idx, coalesce(arg_min({{'text': s.text, 'language': s.language}}, s.idx) FILTER (s.s_ms * 2 <= t.s_ms + t.e_ms AND t.s_ms + t.e_ms <= s.e_ms * 2),
                     arg_max({{'text': s.text, 'language': s.language}}, s.idx) FILTER (least(t.e_ms, s.e_ms) > greatest(t.s_ms, s.s_ms))) AS x
            FROM turns t JOIN segments s ON t.session_id = s.session_id GROUP BY t.session_id, t.idx))""",
    "regions": """
        SELECT o.session_id, speaker_a, speaker_b, o_start, o_end, dur_ms, CASE WHEN dur_ms < 600 AND (a.soft OR b.soft) THEN 'backchannel' ELSE 'crosstalk' END AS overlap_type
        FROM crossings o JOIN soft a ON o.session_id = a.session_id AND ia = a.idx JOIN soft b ON o.session_id = b.session_id AND ib = b.idx WHERE dur_ms >= 200""",
    "tagged": f"""
        SELECT *, CASE WHEN (session_id + word_idx) % 9 = 0 THEN 'hi-Latn' WHEN (session_id + word_idx) % 11 = 0 THEN 'pa-Latn' WHEN (session_id + word_idx) % 13 = 0 THEN 'hi' ELSE wl END AS lang FROM wlang""",
    "wlang": rf"""
        SELECT *, CASE WHEN list_contains({_list(lex.ROMAN_HINDI)}, tok) THEN 'hi-Latn' WHEN list_contains({_list(lex.ROMAN_PUNJABI)}, tok) THEN 'pa-Latn'
                       WHEN list_contains({_list(lex.ROMAN_MARWADI)}, tok) THEN 'mwr-Latn' ELSE 'en' END AS wl,
               CASE WHEN list_contains({_list(lex.ROMAN_HINDI)}, tok) THEN 0.78 WHEN list_contains({_list((*lex.ROMAN_PUNJABI, *lex.ROMAN_MARWADI))}, tok) THEN 0.76
                    WHEN regexp_matches(tok, '\p{{Latin}}') THEN 0.68 ELSE 0.5 END::DOUBLE AS confidence
        FROM (SELECT *, regexp_replace(lower(word), '[^\p{{L}}\p{{N}}'']', '', 'g') AS tok FROM words)""",
    "islands": """
        SELECT session_id, min(s_ms) AS s_ms, max(e_ms) AS e_ms FROM (
          SELECT *, sum(CASE WHEN b IS NULL OR s_ms - b > 0 THEN 1 ELSE 0 END) OVER (PARTITION BY session_id ORDER BY s_ms, e_ms ROWS UNBOUNDED PRECEDING) AS island FROM (
            SELECT *, max(e_ms) OVER (PARTITION BY session_id ORDER BY s_ms, e_ms ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS b FROM intervals))
        GROUP BY session_id, island""",
    "spans": """
        SELECT session_id, turn_idx, span, speaker, min(ws_ms) AS s_ms, arg_max(we_ms, (ws_ms, seg_idx, word_idx)) AS e_ms, count(*) AS n_words, sum(greatest(0, we_ms - ws_ms)) AS spoken
        FROM (SELECT *, sum(n) OVER (PARTITION BY session_id, turn_idx ORDER BY ws_ms, seg_idx, word_idx ROWS UNBOUNDED PRECEDING) AS span FROM (
          SELECT w.session_id, t.idx AS turn_idx, t.speaker, w.seg_idx, w.word_idx, w.ws_ms, w.we_ms, CASE WHEN w.ws_ms - lag(w.we_ms) OVER (PARTITION BY w.session_id, t.idx ORDER BY w.ws_ms, w.seg_idx, w.word_idx) > 100 THEN 1 ELSE 0 END AS n
          FROM words w JOIN turns t ON w.session_id = t.session_id AND w.ws_ms + w.we_ms BETWEEN t.s_ms * 2 - 2 AND t.e_ms * 2 + 2)) GROUP BY ALL""",
    "scored_spans": """
        SELECT session_id, turn_idx, span::BIGINT AS span, speaker, s_ms, e_ms, n_words, ms BETWEEN 2000 AND 8000 AS in_range, silence AS silence_ratio, free AS interruption_free,
               (CASE WHEN ms < 2000 THEN ms / 2000.0::DOUBLE * 0.5::DOUBLE WHEN ms > 8000 THEN 0.7::DOUBLE WHEN ms BETWEEN 3000 AND 6000 THEN 1.0::DOUBLE
                     WHEN ms < 3000 THEN 0.7::DOUBLE + 0.3::DOUBLE * (ms - 2000) / 1000.0::DOUBLE ELSE 0.7::DOUBLE + 0.3::DOUBLE * (8000 - ms) / 2000.0::DOUBLE END)
               * greatest(0.0::DOUBLE, 1.0::DOUBLE - silence * 1.5::DOUBLE) * CASE WHEN free THEN 1.0::DOUBLE ELSE 0.5::DOUBLE END AS score
        FROM (SELECT s.*, s.e_ms - s.s_ms AS ms, CASE WHEN s.e_ms <= s.s_ms THEN 1.0::DOUBLE ELSE greatest(0.0::DOUBLE, 1.0::DOUBLE - spoken / (s.e_ms - s.s_ms)::DOUBLE) END AS silence,
                     NOT EXISTS (SELECT 1 FROM turns o WHERE o.session_id = s.session_id AND o.speaker <> s.speaker AND o.e_ms > s.s_ms AND o.s_ms < s.e_ms) AS free FROM spans s)""",
    "snr": """
        SELECT session_id, idx, turn, s_ms, e_ms, n_words, language, avg_logprob, quality_score, short, CASE WHEN short THEN l.snr ELSE snr_db END AS snr_db,
               CASE WHEN short THEN coalesce(l.clip, 0.0::DOUBLE) ELSE clipping_ratio END AS clipping_ratio, clipping_ratio AS own_clip, snr_db AS own_snr, l IS NOT NULL AS inherits
        FROM (SELECT *, last_value(CASE WHEN NOT short AND snr_db IS NOT NULL THEN {'snr': snr_db, 'clip': clipping_ratio} END IGNORE NULLS) OVER (PARTITION BY session_id ORDER BY idx ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS l
              FROM (SELECT *, e_ms - s_ms < @SHORT AS short FROM segments))""",
    "banded": "SELECT *, CASE WHEN clipping_ratio > 0.005 OR snr_db IS NULL THEN 'low' WHEN snr_db >= 20 THEN 'high' WHEN snr_db >= 10 THEN 'medium' ELSE 'low' END AS snr_band FROM snr",
    "fused": """
        SELECT *, abs(z) > 2.5 AS odd, greatest(e_ms - s_ms, 1) < 300 AS brief,
               least(1.0::DOUBLE, greatest(0.0::DOUBLE, 0.45::DOUBLE * asr + 0.25::DOUBLE * CASE snr_band WHEN 'high' THEN 1.0 WHEN 'medium' THEN 0.72 ELSE 0.38 END::DOUBLE
                     + 0.15::DOUBLE * CASE WHEN abs(z) > 2.5 THEN 0.72 ELSE 1.0 END::DOUBLE + 0.15::DOUBLE * CASE WHEN n_words > 0 THEN 1.0 ELSE 0.55 END::DOUBLE)) AS f
        FROM (SELECT *, least(1.0::DOUBLE, greatest(0.0::DOUBLE, CASE WHEN ent OR mid THEN raw * 0.75::DOUBLE ELSE raw END)) AS asr FROM (
          SELECT *, (session_id + turn) % 7 = 0 AS overlap, (session_id + turn) % 10 = 3 AS mid, (session_id + turn) % 19 = 0 AS ent,
                 CASE WHEN avg_logprob < 0 THEN exp(greatest(avg_logprob, -6.0::DOUBLE)) ELSE quality_score END AS raw,
                 (n_words * 60000.0::DOUBLE / greatest(e_ms - s_ms, 1) - CASE split_part(language, '-', 1) WHEN 'hi' THEN 130.0 WHEN 'pa' THEN 120.0 WHEN 'mwr' THEN 110.0 ELSE 145.0 END::DOUBLE)
                   / CASE split_part(language, '-', 1) WHEN 'hi' THEN 30.0 WHEN 'pa' THEN 28.0 WHEN 'mwr' THEN 25.0 ELSE 35.0 END::DOUBLE AS z
          FROM banded))""",
    "scored": """
        SELECT *, CASE WHEN capped >= 0.8 THEN 'gold' WHEN capped >= 0.55 THEN 'silver' ELSE 'bronze' END AS confidence_band, round(capped, 6) AS confidence
        FROM (SELECT *, least(f, CASE WHEN overlap OR brief THEN 0.74 ELSE 1.0 END::DOUBLE, CASE WHEN clipping_ratio > 0.005 THEN 0.54 ELSE 1.0 END::DOUBLE) AS capped FROM fused)""",
    "tiered": """
        SELECT *, CASE WHEN snr_band = 'low' OR clipping_ratio > 0.005 THEN 'bronze' WHEN overlap AND confidence_band = 'gold' THEN 'silver' ELSE confidence_band END AS quality_tier,
               list_sort(list_filter([CASE WHEN asr < 0.55 THEN 'low_asr_quality' END, CASE WHEN ent THEN 'high_lid_entropy' END, CASE WHEN mid THEN 'mid_segment_script_change' END, CASE WHEN snr_band = 'low' THEN 'snr_low' END,
                 CASE WHEN overlap THEN 'overlap_crosstalk' END, CASE WHEN n_words = 0 THEN 'missing_word_timestamps' END, CASE WHEN brief THEN 'short_duration' END, CASE WHEN clipping_ratio > 0.005 THEN 'clipping_detected' END,
                 CASE WHEN overlap THEN 'overlap' END], lambda x: x IS NOT NULL)) AS reasons FROM scored""",
    "ctext": r"""
        SELECT session_id, engine, count(*) FILTER (length(trim(text)) > 0) AS n_segments,
               list_filter(string_split(trim(regexp_replace(regexp_replace(lower(string_agg(trim(text), ' ' ORDER BY idx) FILTER (length(trim(text)) > 0)), '[^\p{L}\p{N}_\s]', ' ', 'g'), '\s+', ' ', 'g')), ' '), lambda x: x <> '') AS words
        FROM candidates GROUP BY ALL""",
    "gate_in": """
        SELECT session_id AS k, session_id, CASE WHEN session_id % 10 <> 0 THEN (800 + session_id * 7 % 200) / 1000.0::DOUBLE END AS consensus_score, CASE WHEN session_id % 8 <> 0 THEN (900 + session_id * 3 % 100) / 1000.0::DOUBLE END AS ts,
               session_id % 3 = 0 AS cs, CASE WHEN session_id % 9 <> 0 THEN (session_id * 11 % 100) / 100.0::DOUBLE END AS cs_conf, (950 + session_id % 50) / 1000.0::DOUBLE AS spk
        FROM (SELECT DISTINCT session_id FROM turns)""",
    "gate": """
        SELECT *, list_filter([CASE WHEN word < 0.99 THEN 'estimated_word_accuracy_below_target' END, CASE WHEN spk < 0.99 THEN 'estimated_speaker_accuracy_below_target' END, CASE WHEN est_ts < 0.98 THEN 'estimated_timestamp_accuracy_below_target' END,
                 CASE WHEN cs AND est_cs < 0.99 THEN 'estimated_code_switch_accuracy_below_target' END, CASE WHEN consensus_score < 0.95 THEN 'consensus_score_below_review_threshold' END], lambda x: x IS NOT NULL) AS reasons
        FROM (SELECT *, least(coalesce(consensus_score, 0), 0.99::DOUBLE) AS word, coalesce(ts, 0) AS est_ts,
                CASE WHEN cs THEN coalesce(nullif(coalesce(cs_conf, 0), 0), least(coalesce(consensus_score, 0), 0.75::DOUBLE)) ELSE least(1.0::DOUBLE, greatest(coalesce(consensus_score, 0), 0.99::DOUBLE)) END AS est_cs FROM gate_in)""",
    "utt": r"""
        SELECT *, speaker || '-' || session_id || '-' || lpad(idx::VARCHAR, 4, '0') AS u, printf('%d.%03d', s_ms // 1000, s_ms % 1000) AS s, printf('%d.%03d', e_ms // 1000, e_ms % 1000) AS e, printf('%d.%03d', (e_ms - s_ms) // 1000, (e_ms - s_ms) % 1000) AS d,
               trim(regexp_replace(text, '\s+', ' ', 'g')) AS t FROM segments""",
    "listed": """
        SELECT *, '/in/' || rel || '#' || page_id AS path, page_id * 13 % 997 AS size, page_id * 7 % 31 / 2.0::DOUBLE AS dur FROM (SELECT *, l || '/' || c || '/' || w || '/' || n AS rel FROM (
          SELECT page_id, ['English', 'hindi', 'punjabi', 'other'][page_id % 4 + 1] AS l, 'conv ' || (page_id // 7 % 40) AS c, ['Speaker 1', 'speaker-2', 'spk_1', 'misc', 'SPK 02'][page_id % 5 + 1] AS w, ['audio.wav', 's1.wav', 'take.mp3', 'Speaker_2.wav'][page_id // 5 % 4 + 1] AS n FROM pages))""",
    "picked": """
        SELECT lower(l) AS language, c AS conversation, arg_max(path, (CASE WHEN n = 's1.wav' THEN 2 ELSE 1 END, dur, size, path)) FILTER (n <> 'take.mp3' AND (n = 's1.wav' OR w IN ('Speaker 1', 'spk_1'))) AS path_1,
               arg_max(path, (CASE WHEN n = 'Speaker_2.wav' THEN 2 ELSE 1 END, dur, size, path)) FILTER (n <> 'take.mp3' AND (n = 'Speaker_2.wav' OR w IN ('speaker-2', 'SPK 02'))) AS path_2, count(*) FILTER (n <> 'take.mp3') AS wavs FROM listed WHERE l <> 'other' GROUP BY ALL""",
    "reasoned": """
        SELECT *, CASE WHEN wavs = 0 THEN 'unsupported_audio_format' WHEN path_1 = path_2 THEN 'ambiguous_speaker_assignment' WHEN path_1 IS NULL AND path_2 IS NULL THEN 'missing_speaker_pair' WHEN path_1 IS NULL THEN 'missing_speaker_1' WHEN path_2 IS NULL THEN 'missing_speaker_2' END AS reason FROM picked""",
    "folders": """
        SELECT language, conversation, path_1, path_2, reason, CASE language WHEN 'english' THEN 'en' WHEN 'hindi' THEN 'hi' ELSE 'pa' END AS code,
               CASE WHEN reason IS NULL THEN printf('conversation_%04d', row_number() OVER (PARTITION BY language ORDER BY reason IS NOT NULL, split_part(conversation, ' ', 2)::BIGINT, conversation)) END AS conversation_id FROM reasoned""",
    "attribution": """
        SELECT session_id, count(*) AS n, count(*) FILTER (r_speaker = speaker) AS same_speaker, avg(CASE WHEN r_speaker = speaker THEN 1.0 ELSE 0.0 END::DOUBLE) AS speaker_accuracy,
               sum(greatest(0, 2000 - abs(rs_ms - s_ms) - abs(re_ms - e_ms))) / (count(*) * 2000)::DOUBLE AS timestamp_accuracy FROM reviews GROUP BY session_id""",
    "final": """
        SELECT *, CASE WHEN passed AND k % 4 <> 0 THEN 'approved' WHEN passed THEN 'reviewed' WHEN NOT completed AND k % 4 = 0 THEN 'review_required' ELSE 'rejected' END AS stage FROM (
          SELECT *, completed AND k % 9 <> 0 AND len(why) = 0 AS passed FROM (
            SELECT *, list_filter([CASE WHEN NOT completed THEN 'review_status_not_completed' END, CASE WHEN conf < 0.9 THEN 'verified_word_accuracy_below_target' END, CASE WHEN speaker_accuracy < 0.8 THEN 'verified_speaker_accuracy_below_target' END,
                     CASE WHEN timestamp_accuracy < 0.7 THEN 'verified_timestamp_accuracy_below_target' END, CASE WHEN csa < 0.5 THEN 'verified_code_switch_accuracy_below_target' END, CASE WHEN k % 9 = 0 THEN 'validation_failed' END], lambda x: x IS NOT NULL) AS why FROM (
              SELECT a.*, a.session_id AS k, a.session_id % 7 <> 0 AS completed, CASE WHEN a.session_id % 7 <> 0 AND d.empty = 0 AND d.open = 0 THEN 0.995::DOUBLE ELSE greatest(0.0::DOUBLE, least(0.98::DOUBLE, (d.n - d.empty) / d.n::DOUBLE - d.open * 0.05::DOUBLE)) END AS conf,
                     CASE WHEN d.open > 0 THEN 0.0 ELSE 0.99 END::DOUBLE AS csa
              FROM attribution a JOIN (SELECT session_id, count(*) AS n, count(*) FILTER (trim(coalesce(reviewed_text, '')) = '') AS empty, sum(n_open) AS open FROM reviews GROUP BY session_id) d ON a.session_id = d.session_id)))""",
}

def _with(sql: str, short: int = 400) -> str:
    """sql after the relations that it reads, in order of need."""
    done: list[str] = []

    def need(text: str) -> None:
        for name in RELATIONS:
            if name not in done and re.search(rf"(?:FROM|JOIN|,)\s+{name}\b", text):
                need(RELATIONS[name])
                done.append(name)

    need(sql)
    if done and sql.lstrip().startswith("WITH "):
        head = ",\n".join(f"{n} AS ({RELATIONS[n].strip()})" for n in done).replace("@SHORT", str(short))
        return f"WITH {head},\n{sql.strip().removeprefix('WITH ')}"
    return "WITH " + ",\n".join(f"{n} AS ({RELATIONS[n].strip()})" for n in done).replace("@SHORT", str(short)) + "\n" + sql.strip() if done else sql.strip()


def _rules(rules: tuple[tuple[str, str], ...]) -> str:
    edge = EDGE.replace("'", "''")
    hit = lambda n, w: f"CASE WHEN regexp_matches(lower(text), '(^|{edge})({w})({edge}|$)')" + (" OR contains(text, '?')" if n == "question" else "") + f" THEN '{n}' END"
    return "list_filter([" + ", ".join(hit(n, w) for n, w in rules) + "], lambda x: x IS NOT NULL)"


def _joined(*pairs: tuple[str, str]) -> str:
    return "array_to_string(list_filter([" + ", ".join(f"CASE WHEN {c} THEN '{n}' END" for c, n in pairs) + "], lambda x: x IS NOT NULL), ',')"


_PROBE = rf"""
    SELECT *, CASE WHEN best >= 2 AND best / greatest(n, 1)::DOUBLE >= 0.05 THEN CASE WHEN m = best THEN 'mwr-Latn' WHEN p = best THEN 'pa-Latn' ELSE 'hi-Latn' END END AS plang,
           CASE WHEN best >= 2 AND best / greatest(n, 1)::DOUBLE >= 0.05 THEN least(1.0::DOUBLE, best / greatest(n, 1)::DOUBLE * 4.0::DOUBLE) ELSE 0.0::DOUBLE END AS strength
    FROM (SELECT *, greatest(m, p, h) AS best FROM (SELECT doc_id, text, len(w) AS n, len(list_filter(w, lambda x: list_contains({_list(lex.ROMAN_MARWADI)}, x))) AS m,
        len(list_filter(w, lambda x: list_contains({_list((*lex.ROMAN_PUNJABI, *lex.LEGACY_COLLISIONS["pa"]))}, x))) AS p, len(list_filter(w, lambda x: list_contains({_list((*lex.ROMAN_HINDI, *lex.LEGACY_COLLISIONS["hi"]))}, x))) AS h
        FROM (SELECT doc_id, text, regexp_extract_all(lower(text), '{TOKEN}') AS w FROM documents)))"""

_DUR = "CASE WHEN e_ms > s_ms THEN e_ms - s_ms ELSE 1000 END"


def _report(key: str) -> str:
    return f"""
        SELECT {key}, dominant_language, n_languages, n_languages >= 2 AS multilingual, switch_count, f AS switching_frequency, least(1.0::DOUBLE, f / 10.0::DOUBLE) AS switching_score FROM (
          SELECT *, CASE WHEN span > 0 THEN switch_count * 60000.0::DOUBLE / span ELSE 0.0 END AS f FROM
            (SELECT {key}, arg_max(language, (t, -first)) AS dominant_language, count(*) AS n_languages FROM (SELECT {key}, language, sum({_DUR}) AS t, min(idx) AS first FROM segments GROUP BY ALL) GROUP BY ALL)
            JOIN (SELECT {key}, count(*) FILTER (language <> l) AS switch_count, max(e_ms) - min(s_ms) AS span FROM (SELECT *, lag(language) OVER (PARTITION BY {key} ORDER BY s_ms, idx) AS l FROM segments) GROUP BY ALL) USING ({key}))"""


SQL = {
    "interaction_report": """
        SELECT g.*, coalesce(o.n, 0) AS overlap_segments, coalesce(o.ms, 0)::BIGINT AS overlap_ms, coalesce(o.i, 0) AS interruption_count, d.speaker AS dominant_speaker,
               round(least(1.0, greatest(0.0, pow(exp(-coalesce(latency_mean_ms / 1000.0::DOUBLE, 5.0) / 3.0::DOUBLE) * least(1.0, greatest(0.0, switches_per_min / 20.0::DOUBLE))
                 * CASE WHEN coalesce(o.i, 0) / total_turns::DOUBLE < 0.05 THEN 0.5 WHEN coalesce(o.i, 0) / total_turns::DOUBLE < 0.2 THEN 0.5 + 0.5 * (coalesce(o.i, 0) / total_turns::DOUBLE - 0.05) / 0.15
                        ELSE greatest(0.25, 1.0 - coalesce(o.i, 0) / total_turns::DOUBLE * 2) END::DOUBLE, 1.0::DOUBLE / 3.0::DOUBLE))), 6) AS engagement_score
        FROM (SELECT *, coalesce(switches * 60000.0::DOUBLE / greatest(duration_ms, 1), 0.0) AS switches_per_min FROM (
          SELECT session_id, count(*) AS total_turns, count(*) FILTER (speaker <> nxt) AS switches, arg_max(e_ms, ord) - min(s_ms) AS duration_ms,
                 sum(gap) FILTER (speaker <> nxt AND gap >= 0) / count(*) FILTER (speaker <> nxt AND gap >= 0)::DOUBLE AS latency_mean_ms, median(gap) FILTER (speaker <> nxt AND gap >= 0)::DOUBLE AS latency_median_ms,
                 min(gap) FILTER (speaker <> nxt AND gap >= 0) AS latency_min_ms, max(gap) FILTER (speaker <> nxt AND gap >= 0) AS latency_max_ms FROM gaps GROUP BY session_id)) g
        LEFT JOIN (SELECT session_id AS s, count(*) AS n, sum(dur_ms) AS ms, count(*) FILTER (dur_ms < 500) AS i FROM crossings WHERE dur_ms >= 50 GROUP BY session_id) o ON g.session_id = o.s
        LEFT JOIN (SELECT session_id AS s2, arg_min(speaker, (-speaking_ms, speaker)) AS speaker FROM talk GROUP BY session_id) d ON g.session_id = d.s2""",
    "response_latency": "SELECT session_id, ord, speaker AS from_speaker, nxt AS to_speaker, gap AS latency_ms FROM gaps WHERE speaker <> nxt AND gap >= 0",
    "turn_overlap_short": "SELECT session_id, speaker_a, speaker_b, o_start, o_end, dur_ms, dur_ms < 500 AS is_interruption, CASE WHEN dur_ms < 500 THEN 'backchannel' ELSE 'crosstalk' END AS overlap_type FROM crossings WHERE dur_ms >= 50",
    "turn_overlap_bucketed": """
        SELECT a.session_id, a.idx AS a, b.idx AS b, least(a.e_ms, b.e_ms) - greatest(a.s_ms, b.s_ms) AS dur_ms FROM intervals a JOIN intervals b
        ON a.session_id = b.session_id AND (a.s_ms, a.idx) < (b.s_ms, b.idx) AND a.speaker <> b.speaker AND least(a.e_ms, b.e_ms) - greatest(a.s_ms, b.s_ms) >= 50""",
    "turn_overlap_typed": "SELECT * FROM regions",
    "speaker_dominance": """
        SELECT session_id, speaker, speaking_ms, speaking_ms / CASE WHEN t = 0 THEN 1 ELSE t END::DOUBLE AS share, r = 1 AS dominant
        FROM (SELECT *, sum(speaking_ms) OVER (PARTITION BY session_id) AS t, row_number() OVER (PARTITION BY session_id ORDER BY speaking_ms DESC, speaker) AS r FROM talk)""",
    "overlap_ratio_by_speaker": """
        SELECT t.session_id, t.speaker, coalesce(ms, 0)::BIGINT AS overlap_ms, coalesce(ms, 0) / greatest(speaking_ms, 1)::DOUBLE AS overlap_ratio FROM talk t
        LEFT JOIN (SELECT session_id, speaker, sum(dur_ms) AS ms FROM (SELECT session_id, unnest([speaker_a, speaker_b]) AS speaker, dur_ms FROM crossings WHERE dur_ms >= 50) GROUP BY ALL) o ON t.session_id = o.session_id AND t.speaker = o.speaker""",
    "adjacent_overlap_markers": """
        SELECT session_id, idx, p AS speaker_a, speaker AS speaker_b, s_ms, least(e_ms, e) AS e_ms FROM (SELECT *, lag(e_ms) OVER w AS e, lag(speaker) OVER w AS p FROM turns WINDOW w AS (PARTITION BY session_id ORDER BY s_ms, idx)) WHERE s_ms < e AND speaker <> p""",
    "word_to_turn_nearest": """
        SELECT w.session_id, w.seg_idx, w.word_idx, ws_ms + we_ms AS mid,
               arg_min(t.speaker, (CASE WHEN t.s_ms * 2 <= ws_ms + we_ms AND ws_ms + we_ms < t.e_ms * 2 THEN 0 ELSE 1 END, CASE WHEN t.s_ms * 2 <= ws_ms + we_ms AND ws_ms + we_ms < t.e_ms * 2 THEN 0 ELSE least(abs(t.s_ms * 2 - ws_ms - we_ms), abs(t.e_ms * 2 - ws_ms - we_ms)) END, t.idx)) AS speaker
        FROM words w JOIN turns t ON w.session_id = t.session_id GROUP BY ALL""",
    "segment_to_turn_closed": """
        SELECT w.session_id, w.idx AS seg_idx, w.s_ms + w.e_ms AS mid,
               arg_min(t.speaker, (CASE WHEN t.s_ms * 2 <= w.s_ms + w.e_ms AND w.s_ms + w.e_ms <= t.e_ms * 2 THEN 0 ELSE 1 END, CASE WHEN t.s_ms * 2 <= w.s_ms + w.e_ms AND w.s_ms + w.e_ms <= t.e_ms * 2 THEN 0 ELSE least(abs(t.s_ms * 2 - w.s_ms - w.e_ms), abs(t.e_ms * 2 - w.s_ms - w.e_ms)) END, t.idx)) AS speaker
        FROM segments w JOIN turns t ON w.session_id = t.session_id GROUP BY ALL""",
    "segment_best_speaker": """
        SELECT s.session_id, s.idx AS seg_idx, arg_max(t.speaker, (greatest(0, least(s.e_ms + 150, t.e_ms) - greatest(s.s_ms + 150, t.s_ms)), -t.idx)) AS speaker FROM segments s JOIN turns t ON s.session_id = t.session_id GROUP BY ALL""",
    "utterance_manifest": """
        SELECT t.session_id || '_' || t.speaker || '_' || lpad(t.s_ms::VARCHAR, 8, '0') || '_' || lpad(t.e_ms::VARCHAR, 8, '0') AS utterance_id, t.session_id, t.speaker, t.s_ms, t.e_ms,
               string_agg(trim(s.text), ' ' ORDER BY s.idx) AS text, arg_min(s.language, s.idx) AS language, avg(s.quality_score) AS quality
        FROM turns t JOIN segments s ON t.session_id = s.session_id AND t.s_ms < s.e_ms AND s.s_ms < t.e_ms GROUP BY ALL""",
    "segment_overlap_annotation": """
        SELECT s.session_id, s.idx, o IS NOT NULL AS overlap, o.overlap_type, o.o_start AS overlap_start, o.o_end AS overlap_end FROM segments s
        LEFT JOIN (SELECT s.session_id, s.idx, arg_max({'overlap_type': r.overlap_type, 'o_start': r.o_start, 'o_end': r.o_end}, (r.o_end - r.o_start, -r.o_start, -r.o_end)) AS o
                   FROM segments s JOIN regions r ON s.session_id = r.session_id AND s.s_ms < r.o_end AND r.o_start < s.e_ms GROUP BY ALL) x ON s.session_id = x.session_id AND s.idx = x.idx""",
    "interval_union": "SELECT * FROM islands",
    "vad_merge_pad": """
        SELECT session_id, speaker, greatest(0, min(s_ms) - 120) AS s_ms, least(4000000000000, max(e_ms) + 120) AS e_ms FROM (
          SELECT *, sum(CASE WHEN b IS NULL OR s_ms - b > 300000 THEN 1 ELSE 0 END) OVER (PARTITION BY session_id, speaker ORDER BY s_ms, e_ms ROWS UNBOUNDED PRECEDING) AS island FROM (
            SELECT *, max(e_ms) OVER (PARTITION BY session_id, speaker ORDER BY s_ms, e_ms ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS b FROM intervals)) GROUP BY session_id, speaker, island""",
    "speech_total": "SELECT session_id, sum(e_ms - s_ms)::BIGINT AS speech_ms, count(*) AS n FROM islands GROUP BY session_id",
    "pairwise_overlap_seconds": """
        SELECT a.session_id, sum(least(a.e_ms, b.e_ms) - greatest(a.s_ms, b.s_ms))::BIGINT AS overlap_ms FROM intervals a JOIN intervals b ON a.session_id = b.session_id AND a.speaker = 'click' AND b.speaker = 'view' AND a.s_ms < b.e_ms AND b.s_ms < a.e_ms GROUP BY a.session_id""",
    "turns_from_vad": """
        SELECT session_id, speaker, s_ms, e_ms, row_number() OVER (PARTITION BY session_id ORDER BY s_ms, e_ms, speaker) - 1 AS idx, 1.0::DOUBLE AS confidence FROM (
          SELECT session_id, speaker, min(s_ms) AS s_ms, max(e_ms) AS e_ms FROM (
            SELECT *, sum(CASE WHEN b IS NULL OR s_ms - b > 60000 THEN 1 ELSE 0 END) OVER (PARTITION BY session_id, speaker ORDER BY s_ms, e_ms ROWS UNBOUNDED PRECEDING) AS island FROM (
              SELECT *, max(e_ms) OVER (PARTITION BY session_id, speaker ORDER BY s_ms, e_ms ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS b FROM intervals WHERE e_ms - s_ms >= 1)) GROUP BY session_id, speaker, island)
        WHERE e_ms - s_ms >= 120000""",
    "sliding_windows": """
        SELECT session_id, idx, w.s AS s_ms, w.e AS e_ms FROM (SELECT session_id, idx, unnest(CASE WHEN e_ms - s_ms <= 1500 THEN [{'s': s_ms, 'e': e_ms}]
            ELSE list_concat(list_transform(range(0, k + 1), lambda i: {'s': s_ms + i * 750, 'e': s_ms + i * 750 + 1500}), CASE WHEN e_ms - s_ms - (k * 750 + 1500) > 50 THEN [{'s': e_ms - 1500, 'e': e_ms}] ELSE [] END) END) AS w
          FROM (SELECT *, (e_ms - s_ms - 1500) // 750 AS k FROM turns))""",
    "undisturbed_turns": "SELECT session_id, idx, speaker, s_ms, e_ms FROM turns a WHERE NOT EXISTS (SELECT 1 FROM turns b WHERE a.session_id = b.session_id AND a.speaker <> b.speaker AND b.s_ms < a.e_ms AND a.s_ms < b.e_ms)",
    "tokenise_count": f"SELECT doc_id, len(w)::INTEGER AS n, len(list_distinct(w))::INTEGER AS n_distinct, w[1] AS first FROM (SELECT doc_id, regexp_extract_all(lower(coalesce(text, '')), '{TOKEN}') AS w FROM documents)",
    "script_detect": r"SELECT doc_id, s AS scripts, CASE s WHEN 'Latin' THEN 'Latn' ELSE 'unknown' END AS tag, CASE s WHEN 'Latin' THEN 'Latn' ELSE 'unknown' END AS major FROM (SELECT doc_id, CASE WHEN regexp_matches(text, '\p{Latin}') THEN 'Latin' ELSE '' END AS s FROM documents)",
    "text_normalise": r"SELECT conv_id, turn, t AS wer_text, t AS consensus_text FROM (SELECT conv_id, turn, trim(regexp_replace(regexp_replace(lower(coalesce(text, '')), '[^\p{L}\p{N}_\s]', ' ', 'g'), '\s+', ' ', 'g')) AS t FROM conversations)",
    "roman_lexicon_probe": f"SELECT doc_id, plang AS lang, best::INTEGER AS hits, strength FROM ({_PROBE})",
    "segment_language": f"SELECT doc_id, CASE WHEN strength > 0.1 THEN plang ELSE 'en' END AS lang, CASE WHEN strength > 0.1 THEN 0.55::DOUBLE + 0.3::DOUBLE * strength ELSE 0.6 END::DOUBLE AS confidence FROM ({_PROBE})",
    "language_report": _report("session_id"),
    "speaker_language_report": _report("session_id, speaker"),
    "code_switch_report": """
        SELECT a.session_id, n AS switch_count, coalesce(p, '') AS patterns, CASE WHEN span > 0 THEN n * 60000.0::DOUBLE / span ELSE 0.0 END AS switching_frequency
        FROM (SELECT session_id, count(*) FILTER (l <> language) AS n, max(e_ms) - min(s_ms) AS span FROM (SELECT *, lag(language) OVER (PARTITION BY session_id ORDER BY s_ms, e_ms, idx) AS l FROM segments) GROUP BY session_id) a
        LEFT JOIN (SELECT session_id, string_agg(x, ',' ORDER BY f) AS p FROM (SELECT session_id, l || '→' || language AS x, min((s_ms, e_ms, idx)) AS f FROM (SELECT *, lag(language) OVER (PARTITION BY session_id ORDER BY s_ms, e_ms, idx) AS l FROM segments) WHERE l <> language GROUP BY ALL) GROUP BY session_id) b ON a.session_id = b.session_id""",
    "bcp47_distribution": "SELECT session_id, string_agg(tag || ':' || c, ',' ORDER BY tag) AS distribution FROM (SELECT session_id, CASE language WHEN 'en' THEN 'en-IN' WHEN 'hi' THEN 'hi-Deva' WHEN 'mwr' THEN 'mwr-Latn' WHEN 'pa' THEN 'pa-Guru' ELSE language END AS tag, count(*) AS c FROM segments GROUP BY ALL) GROUP BY session_id",
    "word_language": r"SELECT session_id, seg_idx, word_idx, CASE WHEN wl = 'en' AND NOT regexp_matches(tok, '\p{Latin}') THEN 'en' ELSE wl END AS lang, confidence FROM wlang",
    "switch_points": r"""
        SELECT session_id, seg_idx, word_idx, p AS from_lang, lang AS to_lang, CASE WHEN split_part(p, '-', 1) = split_part(lang, '-', 1) THEN 'intra_word' WHEN n >= 3 AND p = nx THEN 'tag' WHEN regexp_matches(pw, '[.?!]\s*$') THEN 'inter_sentential' ELSE 'intra_sentential' END AS switch_type
        FROM (SELECT *, lag(lang) OVER w AS p, lead(lang) OVER w AS nx, lag(word) OVER w AS pw, count(*) OVER (PARTITION BY session_id, seg_idx) AS n FROM tagged WINDOW w AS (PARTITION BY session_id, seg_idx ORDER BY word_idx)) WHERE p <> lang""",
    "cs_density": """
        SELECT *, n_switches * 100.0::DOUBLE / greatest(n_words, 1) AS cs_density FROM (SELECT session_id, seg_idx, sum(c)::BIGINT AS n_words, arg_max(lang, (c, -first)) AS matrix_language FROM (SELECT session_id, seg_idx, lang, count(*) AS c, min(word_idx) AS first FROM tagged GROUP BY ALL) GROUP BY ALL)
        JOIN (SELECT session_id, seg_idx, count(*) FILTER (lang <> p) AS n_switches FROM (SELECT *, lag(lang) OVER (PARTITION BY session_id, seg_idx ORDER BY word_idx) AS p FROM tagged) GROUP BY ALL) USING (session_id, seg_idx)""",
    "cs_density_session": """
        SELECT session_id, count(*) FILTER (lang <> p) AS switches, count(*) AS words, count(*) FILTER (lang <> p) * 100.0::DOUBLE / count(*) AS density FROM (SELECT *, lag(lang) OVER (PARTITION BY session_id, seg_idx ORDER BY word_idx) AS p FROM tagged) GROUP BY session_id""",
    "punctuation_split": rf"""
        SELECT session_id, seg_idx, word_idx, CASE WHEN bare = '' THEN word ELSE bare END AS text, CASE WHEN trail = '' AND r = 1 AND sk IS NULL THEN '.' ELSE trail END AS trailing_punct, sk AS punct_skipped FROM (
          SELECT w.*, regexp_extract(word, '(\p{{P}}+)$', 1) AS trail, regexp_replace(word, '\p{{P}}+$', '') AS bare, row_number() OVER (PARTITION BY w.session_id, seg_idx ORDER BY word_idx DESC) AS r,
                 CASE WHEN language = 'hi' THEN 'hindi_model_unavailable' WHEN NOT list_contains({_list(PUNCTUATED)}, language) THEN 'unsupported_language' END AS sk FROM words w JOIN segments s ON w.session_id = s.session_id AND w.seg_idx = s.idx)""",
    "speaker_profile": rf"""
        SELECT session_id, speaker, word_count, filler_count, gaps, pauses, speaking_ms, n_turns, wpm, pause_rate, pauses_per_min, filler_ratio, speech_ratio, s.v AS speaking_style, s.c::DOUBLE AS style_confidence,
               CASE WHEN filler_ratio > 0.08 THEN 'informal' WHEN pause_rate > 0.35 THEN 'deliberate_or_formal' ELSE 'unknown' END AS formality FROM (
          SELECT *, CASE WHEN wpm = 0 THEN {{'v': 'silent', 'c': 0.9}} WHEN filler_ratio > 0.12 THEN {{'v': 'hesitant', 'c': 0.8}} WHEN filler_ratio > 0.08 THEN {{'v': 'hesitant', 'c': 0.65}} WHEN wpm < 80 AND pause_rate > 0.4 THEN {{'v': 'deliberate', 'c': 0.75}}
                   WHEN wpm < 90 AND pause_rate > 0.35 THEN {{'v': 'deliberate', 'c': 0.6}} WHEN wpm > 190 THEN {{'v': 'rapid', 'c': 0.8}} WHEN wpm > 170 THEN {{'v': 'rapid', 'c': 0.65}} WHEN pause_rate < 0.08 THEN {{'v': 'fluent', 'c': 0.7}} WHEN pause_rate < 0.1 THEN {{'v': 'fluent', 'c': 0.6}} ELSE {{'v': 'conversational', 'c': 0.55}} END AS s FROM (
            SELECT t.session_id, t.speaker, coalesce(word_count, 0) AS word_count, coalesce(filler_count, 0) AS filler_count, coalesce(gaps, 0) AS gaps, coalesce(pauses, 0) AS pauses, speaking_ms, n_turns,
                   coalesce(word_count, 0) * 60000.0::DOUBLE / speaking_ms AS wpm, coalesce(pauses, 0) / greatest(coalesce(gaps, 0), 1)::DOUBLE AS pause_rate, coalesce(pauses, 0) * 60000.0::DOUBLE / greatest(speaking_ms, 1) AS pauses_per_min,
                   coalesce(filler_count, 0) / greatest(coalesce(word_count, 0), 1)::DOUBLE AS filler_ratio, speaking_ms / audio::DOUBLE AS speech_ratio
            FROM talk t JOIN (SELECT session_id, max(e_ms) AS audio FROM turns GROUP BY session_id) a ON t.session_id = a.session_id
            LEFT JOIN (SELECT session_id, speaker, count(*) AS word_count, count(*) FILTER (list_contains({_list(("the", "and", "la", "de", "die", *lex.FILLERS))}, regexp_replace(lower(word), '^[''.,!?]+|[''.,!?]+$', '', 'g'))) AS filler_count,
                              count(n) AS gaps, count(*) FILTER (greatest(0, n - we_ms) > 400) AS pauses FROM (SELECT *, lead(ws_ms) OVER (PARTITION BY session_id, speaker ORDER BY ws_ms, seg_idx, word_idx) AS n FROM words) GROUP BY ALL) w ON t.session_id = w.session_id AND t.speaker = w.speaker))""",
    "pause_stats": "SELECT session_id, speaker, count(n) AS gaps, count(*) FILTER (greatest(0, n - we_ms) > 100) AS pauses FROM (SELECT *, lead(ws_ms) OVER (PARTITION BY session_id, speaker ORDER BY ws_ms, seg_idx, word_idx) AS n FROM words) GROUP BY ALL",
    "conversation_quality_summary": """
        SELECT session_id, avg(quality_score) AS mean_quality, median(quality_score) AS median_quality, sum(quality_score * greatest(0, e_ms - s_ms)) / sum(greatest(0, e_ms - s_ms)) AS weighted_quality,
               avg(CASE WHEN quality_score < 0.35 THEN 1.0 ELSE 0.0 END::DOUBLE) AS low_ratio, avg(CASE WHEN quality_score >= 0.7 THEN 1.0 ELSE 0.0 END::DOUBLE) AS high_ratio, count(*) AS segment_count FROM segments WHERE length(trim(text)) > 0 GROUP BY session_id""",
    "conversation_profile": "SELECT session_id, count(*) AS turn_count, count(DISTINCT speaker) AS speaker_count, avg(e_ms - s_ms) AS mean_turn_ms, sum(e_ms - s_ms)::BIGINT AS speech_ms FROM turns GROUP BY session_id",
    "keyword_topk": rf"""
        SELECT source, keyword, n, r::INTEGER AS rank FROM (SELECT *, row_number() OVER (PARTITION BY source ORDER BY n DESC, first) AS r FROM (SELECT source, keyword, count(*) AS n, min((doc_id, pos)) AS first
          FROM (SELECT source, doc_id, unnest(w) AS keyword, generate_subscripts(w, 1) AS pos FROM (SELECT source, doc_id, regexp_extract_all(lower(text), '{TOKEN}') AS w FROM documents))
          WHERE length(keyword) >= 3 AND NOT list_contains({_list(lex.STOPWORDS)}, keyword) AND NOT regexp_full_match(keyword, '\p{{N}}+') GROUP BY source, keyword)) WHERE r <= 10""",
    "intent_multilabel": f"SELECT doc_id, CASE WHEN len(i) > 0 THEN array_to_string(i, ',') ELSE 'informational' END AS intents FROM (SELECT doc_id, {_rules(INTENTS)} AS i FROM documents)",
    "domain_infer": f"""
        SELECT doc_id, CASE WHEN len(d) >= 2 THEN 'mixed' WHEN len(d) = 1 THEN d[1] WHEN list_has_any(i, ['support_inquiry', 'complaint']) THEN 'customer_support' WHEN list_contains(i, 'transaction') THEN 'sales' WHEN length(text) > 20 THEN 'casual' ELSE 'unknown' END AS domain,
               CASE WHEN len(d) >= 2 THEN 0.55 WHEN len(d) = 1 THEN 0.68 WHEN list_has_any(i, ['support_inquiry', 'complaint']) THEN 0.58 WHEN list_contains(i, 'transaction') THEN 0.56 WHEN length(text) > 20 THEN 0.42 ELSE 0.2 END::DOUBLE AS confidence
        FROM (SELECT doc_id, text, {_rules(INTENTS)} AS i, {_rules(DOMAINS)} AS d FROM documents)""",
    "monologue_spans": "SELECT * FROM scored_spans",
    "monologue_best": """
        SELECT session_id, turn_idx, speaker, s_ms, CASE WHEN long THEN cut_e ELSE e_ms END AS e_ms, CASE WHEN long THEN cut_n ELSE n_words END::INTEGER AS n_words,
               CASE WHEN long THEN cut_e ELSE e_ms END - s_ms BETWEEN 2000 AND 8000 AS in_range, score
        FROM (SELECT b.*, NOT b.in_range AND b.e_ms - b.s_ms > 8000 AS long, (SELECT max(we_ms) FROM words w JOIN turns t ON w.session_id = t.session_id AND t.idx = b.turn_idx WHERE w.session_id = b.session_id AND w.ws_ms + w.we_ms BETWEEN t.s_ms * 2 - 2 AND t.e_ms * 2 + 2 AND w.ws_ms BETWEEN b.s_ms AND b.s_ms + 8000) AS cut_e,
                (SELECT count(*) FROM words w JOIN turns t ON w.session_id = t.session_id AND t.idx = b.turn_idx WHERE w.session_id = b.session_id AND w.ws_ms + w.we_ms BETWEEN t.s_ms * 2 - 2 AND t.e_ms * 2 + 2 AND w.ws_ms BETWEEN b.s_ms AND b.s_ms + 8000) AS cut_n
              FROM (SELECT *, row_number() OVER (PARTITION BY session_id ORDER BY in_range DESC, score DESC, turn_idx, span) AS r FROM scored_spans) b WHERE r = 1)""",
    "asr_quality_score": """
        SELECT session_id, idx, round(exp(greatest(avg_logprob, -6.0::DOUBLE)) * CASE WHEN compression_ratio <= 2.4 THEN 1.0 ELSE least(1.0, greatest(0.0, 3.4::DOUBLE - compression_ratio)) END::DOUBLE * greatest(0.0, 1.0::DOUBLE - no_speech_prob) * least(1.0, greatest(0.0, (rms_db + 45.0::DOUBLE) / 25.0::DOUBLE)), 6) AS quality FROM segments""",
    "snr_forward_fill": """
        SELECT session_id, idx, snr_db, snr_band, CASE WHEN short AND inherits THEN 'short_segment_inherited' WHEN short THEN 'short_segment' WHEN own_clip > 0.005 THEN 'clipped' WHEN own_snr IS NULL THEN 'unreliable_estimate' END AS snr_reason,
               CASE WHEN short THEN 'inherited' ELSE 'wada_snr' END AS snr_source, clipping_ratio, CASE WHEN clipping_ratio > 0.005 THEN 'clipped' END AS snr_quality FROM banded""",
    "composite_confidence": "SELECT session_id, idx, confidence, confidence_band, round(z, 6) AS wpm_z FROM scored",
    "confidence_band_relative": "SELECT session_id, idx, CASE WHEN c >= 0.7 THEN 'gold' WHEN c >= 0.35 THEN 'silver' ELSE 'bronze' END AS confidence_band_relative FROM (SELECT *, cume_dist() OVER (PARTITION BY session_id ORDER BY confidence) AS c FROM scored)",
    "quality_tier": "SELECT session_id, idx, quality_tier, array_to_string(reasons, ',') AS tier_reasons, quality_tier = 'bronze' OR overlap OR snr_band = 'low' OR clipping_ratio > 0.005 AS flagged_for_review FROM tiered",
    "tier_histogram": "SELECT session_id, count(*) FILTER (quality_tier = 'gold') AS gold, count(*) FILTER (quality_tier = 'silver') AS silver, count(*) FILTER (quality_tier = 'bronze') AS bronze FROM tiered GROUP BY session_id",
    "review_queue": "SELECT session_id, printf('%d_%04d', session_id, idx) AS segment_id, session_id || '.wav' AS audio_filepath, s_ms, e_ms, quality_tier, confidence FROM tiered WHERE quality_tier = 'bronze' OR overlap OR snr_band = 'low' OR clipping_ratio > 0.005",
    "transcript_quality": "SELECT session_id, count(*) FILTER (length(trim(text)) > 0) AS segment_count, coalesce(sum(n_words) FILTER (length(trim(text)) > 0), 0)::BIGINT AS word_count, coalesce(avg(quality_score) FILTER (length(trim(text)) > 0), 0) AS mean_quality, coalesce(avg(CASE WHEN quality_score < 0.35 THEN 1.0 ELSE 0.0 END::DOUBLE) FILTER (length(trim(text)) > 0), 1.0) AS low_ratio, count(*) FILTER (length(trim(text)) > 0) = 0 AS empty_transcript FROM segments GROUP BY session_id",
    "environment_labels": """
        SELECT o_orderkey, e.v AS environment, e.c::DOUBLE AS environment_confidence, CASE WHEN snr >= 20 THEN 'low' WHEN snr >= 12 THEN 'moderate' WHEN snr >= 5 THEN 'high' WHEN snr > 0 THEN 'very_high' ELSE 'unknown' END AS noise,
               CASE WHEN khz < 1.5 THEN 'telephony_or_lapel' WHEN khz < 2.5 THEN 'phone_mic' WHEN khz < 3.5 THEN 'laptop_or_headset' ELSE 'studio_mic' END AS device, CASE WHEN khz * 1000 <= 3800 THEN 'narrowband' ELSE 'wideband' END AS band
        FROM (SELECT *, CASE WHEN snr >= 20 AND rt60 < 0.3 THEN {'v': 'studio', 'c': 0.85} WHEN snr >= 15 AND rt60 < 0.4 THEN {'v': 'quiet_indoor', 'c': 0.8} WHEN snr >= 12 AND rt60 < 0.5 THEN {'v': 'quiet_indoor', 'c': 0.65} WHEN rt60 >= 0.7 THEN {'v': 'reverberant_indoor', 'c': 0.75}
                 WHEN rt60 >= 0.5 THEN {'v': 'reverberant_indoor', 'c': 0.6} WHEN snr < 5 THEN {'v': 'noisy', 'c': 0.7} WHEN snr < 8 THEN {'v': 'noisy', 'c': 0.55} ELSE {'v': 'unknown', 'c': 0.3} END AS e
              FROM (SELECT o_orderkey, (o_orderkey % 31 - 3)::DOUBLE AS snr, (o_orderkey % 17 / 10.0::DOUBLE) AS rt60, (o_orderkey % 43 / 10.0::DOUBLE) AS khz FROM orders))""",
    "candidate_bag_overlap": """
        SELECT a.session_id, a.engine, b.engine AS peer, CASE WHEN len(a.words) = 0 AND len(b.words) = 0 THEN 1.0 ELSE list_sum(list_transform(list_distinct(a.words), lambda x: least(len(list_filter(a.words, lambda y: y = x)), len(list_filter(b.words, lambda y: y = x)))))::DOUBLE / greatest(len(a.words), len(b.words), 1) END AS bag
        FROM ctext a JOIN ctext b ON a.session_id = b.session_id AND a.engine <> b.engine""",
    "timing_agreement": """
        SELECT a.session_id, a.engine, b.engine AS peer, greatest(0.0, 1.0 - least(1.0, d / m::DOUBLE / 1200.0::DOUBLE)) * 0.7::DOUBLE + (1.0::DOUBLE - abs(a.n - b.n) / greatest(a.n, b.n)::DOUBLE) * 0.3::DOUBLE AS timing, 1.0::DOUBLE - abs(a.n - b.n) / greatest(a.n, b.n)::DOUBLE AS count_score
        FROM (SELECT session_id, engine, count(*) AS n FROM candidates WHERE length(trim(text)) > 0 GROUP BY ALL) a JOIN (SELECT session_id, engine, count(*) AS n FROM candidates WHERE length(trim(text)) > 0 GROUP BY ALL) b ON a.session_id = b.session_id AND a.engine <> b.engine
        JOIN (SELECT x.session_id, x.engine, y.engine AS peer, sum(abs(x.s_ms - y.s_ms) + abs(x.e_ms - y.e_ms)) AS d, 2 * count(*) AS m FROM (SELECT *, row_number() OVER (PARTITION BY session_id, engine ORDER BY idx) AS p FROM candidates WHERE length(trim(text)) > 0) x
              JOIN (SELECT *, row_number() OVER (PARTITION BY session_id, engine ORDER BY idx) AS p FROM candidates WHERE length(trim(text)) > 0) y ON x.session_id = y.session_id AND x.p = y.p AND x.engine <> y.engine GROUP BY ALL) z ON a.session_id = z.session_id AND a.engine = z.engine AND b.engine = z.peer""",
    "switch_structure": """
        SELECT a.session_id, a.engine, b.engine AS peer, len(list_intersect(a.langs, b.langs)) / greatest(len(list_distinct(list_concat(a.langs, b.langs))), 1)::DOUBLE * 0.4::DOUBLE
               + (1.0::DOUBLE - least(1.0, abs(a.switch_count - b.switch_count) / greatest(a.switch_count, b.switch_count, 1)::DOUBLE)) * 0.3::DOUBLE
               + CASE WHEN len(a.patterns) = 0 AND len(b.patterns) = 0 THEN 1.0 ELSE len(list_intersect(a.patterns, b.patterns)) / greatest(len(list_distinct(list_concat(a.patterns, b.patterns))), 1)::DOUBLE END * 0.3::DOUBLE AS agreement
        FROM signals a JOIN signals b ON a.session_id = b.session_id AND a.engine <> b.engine""",
    "even_word_times": "SELECT session_id, idx AS seg_idx, i::INTEGER AS word_idx, floor(s_ms + i * (e_ms - s_ms) / len(w)::DOUBLE + 1e-6)::BIGINT AS ws_ms FROM (SELECT *, unnest(range(len(w))) AS i FROM (SELECT *, regexp_extract_all(text, '[^ \\t\\n\\r\\f]+') AS w FROM turns))",
    "timestamp_refinement": """
        SELECT session_id, engine, CASE WHEN t THEN 'vendor_word_timestamps' ELSE 'local_alignment_fallback' END AS timestamp_method, CASE WHEN t THEN ts_conf WHEN s THEN least(0.35::DOUBLE, ts_conf) ELSE least(0.55::DOUBLE, greatest(0.4::DOUBLE, ts_conf)) END AS timestamp_confidence, s AS synthetic, CASE WHEN t THEN 'high' WHEN s THEN 'low' ELSE 'medium' END AS timing_quality
        FROM (SELECT *, engine = 'deepgram' AND ts_conf >= 0.75 AND session_id % 3 <> 0 AS t, NOT (engine = 'deepgram' AND ts_conf >= 0.75 AND session_id % 3 <> 0) AND session_id % 3 = 0 AND session_id % 5 <> 0 AS s FROM signals)""",
    "merged_transcript": "SELECT session_id, row_number() OVER (PARTITION BY session_id ORDER BY s_ms, e_ms, speaker, idx) - 1 AS idx, speaker, s_ms FROM segments",
    "transcript_header": "SELECT session_id, arg_max(language, (quality_score, -idx)) AS language, max(quality_score) AS language_probability, max(e_ms) AS duration_ms, length(string_agg(trim(text), ' ' ORDER BY idx) FILTER (length(trim(text)) > 0))::INTEGER AS chars FROM segments GROUP BY session_id",
    "speaker_texts": "SELECT session_id, speaker, string_agg(trim(text), ' ' ORDER BY idx) AS text FROM segments WHERE length(trim(text)) > 0 GROUP BY ALL",
    "forced_alignment": "SELECT session_id, idx, CASE WHEN length(text) > 80 THEN s_ms + 100 ELSE s_ms END AS s_ms, CASE WHEN length(text) > 80 THEN e_ms + 100 ELSE e_ms END AS e_ms, length(text) > 80 AS aligned FROM segments",
    "accuracy_gate": "SELECT session_id, word AS estimated_word, est_ts AS estimated_timestamp, est_cs AS estimated_code_switch, array_to_string(reasons, ',') AS gate_reasons, len(reasons) = 0 AS gate_passed FROM gate",
    "tts_suitability": f"""
        SELECT session_id, r AS tts_reasons, r = '' AS tts_eligible, CASE WHEN r = '' THEN 0.92 ELSE 0.2 END::DOUBLE AS tts_confidence FROM (SELECT session_id, {_joined(("k % 2 + 1 <> 1", "multi_speaker_segment"), ("k % 4 > 0", "overlap_detected"), ("k % 3 = 2", "noise_not_low"), ("k % 4 = 0", "outdoor_condition"), ("k % 5 >= 3", "review_not_final"), ("k % 8 = 0", "timing_not_verified"), ("k % 8 <> 0 AND k % 5 = 0", "synthetic_timestamps"), ("k % 8 <> 0 AND k % 5 = 0", "timing_not_stable"))} AS r FROM gate_in)""",
    "dataset_purpose": f"""
        SELECT session_id, {_joined(("x", "stt"), ("t", "diarisation"), ("x AND t AND (sc >= 2 OR ov > 0 OR pair)", "conversation_modelling"))} AS purpose_primary, {_joined(("x AND seg", "evaluation"), ("sc >= 2 AND pair", "speaker_separation"), ("tts", "tts"))} AS purpose_secondary, {_joined(("NOT tts", "tts"))} AS not_recommended_for
        FROM (SELECT *, pair AND k % 11 <> 0 AND k % 40 >= 20 AND ov <= 0.1 AND t AND seg AS tts FROM (SELECT session_id, session_id AS k, session_id % 6 <> 0 AS x, session_id % 5 <> 0 AS seg, session_id % 7 <> 0 AS t, session_id % 3 / 5.0::DOUBLE AS ov, session_id % 2 = 0 AS pair, count(DISTINCT speaker) AS sc FROM turns GROUP BY ALL))""",
    "wer_by_session": None,
    "cer_by_session": None,
    "attribution_accuracy": "SELECT * FROM attribution",
    "code_switch_stats": "SELECT session_id, sum(n_open)::BIGINT AS code_switch_segments, sum(n_open)::BIGINT AS unresolved_code_switch, CASE WHEN sum(n_open) > 0 THEN 0.0 ELSE 0.99 END::DOUBLE AS code_switch_accuracy FROM reviews GROUP BY session_id",
    "review_errors": r"""
        SELECT session_id, idx, spk AS speaker, array_to_string(list_filter([CASE WHEN sid = '' THEN 'segment_' || (idx + 1) || '_missing_segment_id' END, CASE WHEN sid <> '' AND rn > 1 THEN 'segment_' || (idx + 1) || '_duplicate_segment_id' END,
                 CASE WHEN raw = 'speaker_01' THEN 'ambiguous_speaker_alias:speaker_01' END, CASE WHEN spk NOT IN ('SPEAKER_00', 'SPEAKER_01') THEN place || '_unknown_speaker' END, CASE WHEN s < 0 THEN place || '_start_negative' END, CASE WHEN e <= s THEN place || '_end_not_after_start' END,
                 CASE WHEN s < before THEN place || '_segments_not_sorted' END, CASE WHEN trim(txt) = '' THEN place || '_empty_reviewed_text' END], lambda x: x IS NOT NULL), ',') AS errors
        FROM (SELECT *, CASE WHEN raw = 'speaker_01' THEN 'SPEAKER_01' WHEN raw = 'spk-2' THEN 'SPEAKER_01' ELSE raw END AS spk, CASE WHEN sid = '' THEN (idx + 1)::VARCHAR ELSE sid END AS place, row_number() OVER (PARTITION BY session_id, sid ORDER BY idx) AS rn, lag(s) OVER (PARTITION BY session_id ORDER BY idx) AS before
          FROM (SELECT session_id, idx, CASE WHEN k % 19 = 0 THEN '' WHEN k % 23 = 0 THEN 'dup' ELSE segment_id END AS sid, CASE WHEN k % 17 = 0 THEN 'speaker_01' WHEN k % 11 = 0 THEN 'spk-2' WHEN k % 13 = 0 THEN 'narrator' ELSE r_speaker END AS raw, rs_ms AS s, CASE WHEN k % 31 = 0 THEN rs_ms ELSE re_ms END AS e, CASE WHEN k % 29 = 0 THEN ' ' ELSE reviewed_text END AS txt
            FROM (SELECT *, session_id + idx AS k FROM reviews)))""",
    "finalise_status": """
        SELECT session_id, conf AS delivery_confidence, array_to_string(why, ',') AS verify_reasons, passed, stage, CASE WHEN stage IN ('approved', 'reviewed') THEN 'completed' WHEN stage = 'review_required' THEN 'pending' ELSE 'needs_correction' END AS review_status,
               CASE stage WHEN 'approved' THEN '' WHEN 'reviewed' THEN 'manual_approval_withheld' ELSE array_to_string(why, ';') END AS delivery_reason FROM final""",
    "manifest_upsert": "SELECT session_id, stage, CASE WHEN stage = 'review_required' THEN 'old' ELSE 'new' END AS row FROM final",
    "status_sync": "SELECT session_id, stage, CASE WHEN stage IN ('approved', 'rejected') THEN stage ELSE 'review_required' END AS manifest FROM final",
    "routing_difficulty": f"""
        SELECT session_id, rc AS recording_condition, nl AS noise_level, sd AS switch_density,
               floor(round(least(1.0::DOUBLE, CASE WHEN rc = 'outdoor' THEN 0.2 ELSE 0.0 END::DOUBLE + CASE nl WHEN 'moderate' THEN 0.08 WHEN 'high' THEN 0.18 ELSE 0.0 END::DOUBLE + greatest(0.0, 0.6::DOUBLE - mq) * 0.8::DOUBLE + least(0.25::DOUBLE, lr * 0.35::DOUBLE)
                 + least(0.2::DOUBLE, greatest(0.0, 0.75::DOUBLE - wt) * 0.4::DOUBLE) + least(0.2::DOUBLE, sd * 0.3::DOUBLE) + least(0.12::DOUBLE, ov / 10.0::DOUBLE) + CASE WHEN urgent THEN 0.1 ELSE 0.0 END::DOUBLE), 4) * 1000)::BIGINT AS difficulty_milli,
               {_joined(("rc = 'outdoor'", "outdoor_audio"), ("nl = 'high'", "high_noise"), ("mq < 0.58", "low_local_confidence"), ("lr > 0.3", "many_low_quality_segments"), ("wt < 0.65", "unstable_timestamps"), ("sd >= 0.45", "dense_code_switching"), ("ov > 0.75", "heavy_overlap"), ("urgent", "high_review_priority"))} AS reasons
        FROM (SELECT *, ['outdoor', 'indoor', 'unknown'][session_id % 3 + 1] AS rc, CASE WHEN session_id % 25 >= 20 THEN 'low' WHEN session_id % 25 >= 12 THEN 'moderate' WHEN session_id % 25 > 0 THEN 'high' ELSE 'unknown' END AS nl,
                least(1.0::DOUBLE, greatest(session_id % 7 / 10.0::DOUBLE, least(1.0::DOUBLE, session_id % 11 / 2.0::DOUBLE / 10.0::DOUBLE), least(1.0::DOUBLE, session_id % 5 / 8.0::DOUBLE), CASE WHEN session_id % 4 = 0 THEN 0.45 ELSE 0.0 END::DOUBLE)) AS sd,
                session_id % 9 / 4.0::DOUBLE AS ov, session_id % 6 = 0 AS urgent
              FROM (SELECT session_id, avg(quality_score) AS mq, avg(CASE WHEN quality_score < 0.45 THEN 1.0 ELSE 0.0 END::DOUBLE) AS lr, sum(n_words) / greatest(sum(greatest(n_words, 1)), 1)::DOUBLE AS wt FROM segments WHERE length(trim(text)) > 0 GROUP BY session_id))""",
    "review_priority": f"""
        SELECT session_id, p AS priority_score, CASE WHEN p >= 0.75 THEN 'high' WHEN p >= 0.45 THEN 'medium' ELSE 'normal' END AS priority_level,
               array_to_string((SELECT list(x ORDER BY i) FROM (SELECT x, min(i) AS i FROM (SELECT unnest(why) AS x, generate_subscripts(why, 1) AS i) GROUP BY x)), ',') AS priority_reasons
        FROM (SELECT *, round(least(1.0::DOUBLE, CASE WHEN k % 4 = 0 THEN 0.2 ELSE 0 END::DOUBLE + CASE WHEN consensus_score < 0.9 THEN 0.8 WHEN consensus_score < 0.95 THEN 0.45 ELSE 0 END::DOUBLE + CASE WHEN ts < 0.98 THEN 0.2 ELSE 0 END::DOUBLE + CASE WHEN ts IS NOT NULL AND k % 5 = 0 THEN 0.4 ELSE 0 END::DOUBLE
                 + CASE WHEN k % 3 > 0 THEN 0.15 ELSE 0 END::DOUBLE + CASE WHEN cs THEN 0.3 ELSE 0 END::DOUBLE + CASE WHEN cs AND coalesce(cs_conf, 0) < 0.99 THEN 0.2 ELSE 0 END::DOUBLE + CASE WHEN spk < 0.99 THEN 0.2 ELSE 0 END::DOUBLE + CASE WHEN word < 0.97 THEN 0.8 WHEN word < 0.99 THEN 0.35 ELSE 0 END::DOUBLE
                 + CASE WHEN k % 6 = 0 THEN 0.16 ELSE 0 END::DOUBLE + CASE WHEN k % 7 = 0 THEN 0.12 ELSE 0 END::DOUBLE), 4) AS p,
               list_concat(list_concat(string_split({_joined(("k % 4 = 0", "outdoor_audio"), ("consensus_score < 0.95", "low_consensus_score"), ("ts < 0.98", "low_timestamp_confidence"), ("ts IS NOT NULL AND k % 5 = 0", "synthetic_word_timestamps"), ("ts IS NOT NULL AND k % 5 = 0", "low_timing_quality"), ("k % 3 > 0", "multi_engine_disagreement"), ("cs", "code_switch_detected"), ("cs AND coalesce(cs_conf, 0) < 0.99", "low_code_switch_confidence"), ("spk < 0.99", "low_speaker_attribution_confidence"), ("word < 0.99", "estimated_word_accuracy_below_target"))}, ','), reasons),
                 list_filter([CASE WHEN k % 6 = 0 THEN 'timestamp_region_disagreement' END, CASE WHEN k % 7 = 0 THEN 'transcript_disagreement' END], lambda x: x IS NOT NULL)) AS why FROM gate)""",
    "validation_issues": f"""
        SELECT session_id, codes, CASE WHEN codes = '' THEN 0 ELSE len(string_split(codes, ',')) END::INTEGER AS issue_count, k % 23 <> 0 AND sc > 0 AS passed FROM (SELECT *, {_joined(("k % 23 = 0", "audio_quality_error"), ("k % 6 = 0", "audio_quality_warning,audio_quality_warning"), ("sc = 0", "empty_transcript"), ("sc > 0 AND lr > 0.35", "low_transcript_quality"), ("k % 4 = 0", "no_speech_segments"), ("tc = 0", "no_speaker_turns"), ("tc > 0 AND k % 4 < 2", "too_few_speech_segments"), ("k % 30 >= 10", "excessive_clipping"), ("k % 5 = 0", "diarisation_fallback"), ("k % 3 <> 0 AND k % 2 <> 0", "alignment_not_applied"), ("k % 3 <> 0 AND k % 100 < 35", "low_alignment_confidence"), ("k % 3 <> 0 AND k % 90 > 60", "speaker_duration_mismatch"), ("k % 20 > 8", "mono_mix_clipping"), ("k % 5 >= 2 AND k % 3 = 0", "missing_expected_overlap"), ("dur >= 60000 AND tc < 3", "suspiciously_low_turn_count"))} AS codes
          FROM (SELECT session_id, session_id AS k, count(*) AS tc, max(e_ms) AS dur, count(*) FILTER (length(trim(text)) > 0) AS sc, coalesce(avg(CASE WHEN quality_score < 0.35 THEN 1.0 ELSE 0.0 END::DOUBLE) FILTER (length(trim(text)) > 0), 1.0) AS lr FROM segments GROUP BY session_id))""",
    "speaker_file_selection": "SELECT * FROM folders",
    "conversation_folders_report": "SELECT language, code, count(*) FILTER (reason IS NULL) AS valid, count(reason) AS skipped FROM folders GROUP BY ALL",
    "user_metadata_precedence": """
        SELECT session_id, speaker, CASE WHEN session_id % 5 = 2 THEN 'travel' ELSE 'sales' END AS domain, CASE WHEN speaker = 'SPEAKER_01' THEN 'f' ELSE 'x' END AS gender, NULL::VARCHAR AS age, CASE WHEN session_id % 5 = 2 THEN 'northern' END AS accent FROM (SELECT DISTINCT session_id, speaker FROM turns)""",
    "wrapped_fields": """
        SELECT o_orderkey, CASE WHEN o_orderkey % 5 = 0 OR o_orderkey % 100 < 50 THEN 'uncertain' ELSE trim(o_orderpriority) END AS inferred, (o_orderkey % 100) / 100.0::DOUBLE AS confidence, CASE WHEN o_orderkey % 3 = 0 THEN o_orderstatus ELSE trim(o_orderpriority) END AS known, CASE WHEN o_orderkey % 3 = 0 THEN 'user_provided' ELSE 'inferred' END AS source FROM orders""",
    "flatten_record": f"""
        SELECT a.session_id, '3.0.0' AS schema_version, raw AS transcript_raw, a.n AS interaction_total_turns, coalesce(o.ms, 0)::BIGINT AS interaction_overlap_ms, l.dominant_language AS language_dominant_language, l.switch_count AS language_switch_count
        FROM (SELECT session_id, count(*) AS n, string_agg(trim(text), ' ' ORDER BY idx) FILTER (length(trim(text)) > 0) AS raw FROM segments GROUP BY session_id) a
        LEFT JOIN (SELECT session_id, sum(dur_ms) AS ms FROM crossings WHERE dur_ms >= 50 GROUP BY session_id) o ON a.session_id = o.session_id JOIN ({_report("session_id")}) l ON a.session_id = l.session_id""",
    "kaldi_lines": r"""
        SELECT session_id::VARCHAR AS recording_id, f.file AS file, f.line AS line FROM (SELECT session_id, unnest([{'file': 'segments', 'line': u || ' ' || session_id || ' ' || s || ' ' || e}, {'file': 'text', 'line': CASE WHEN t <> '' THEN u || ' ' || t END}, {'file': 'utt2spk', 'line': u || ' ' || speaker}, {'file': 'utt2dur', 'line': u || ' ' || d}, {'file': 'utt2lang', 'line': u || ' ' || language}]) AS f FROM utt) WHERE f.line IS NOT NULL
        UNION ALL SELECT session_id::VARCHAR, 'spk2utt', speaker || ' ' || string_agg(u, ' ' ORDER BY u) FROM utt GROUP BY session_id, speaker
        UNION ALL SELECT DISTINCT session_id::VARCHAR, 'wav.scp', session_id || ' ' FROM utt
        UNION ALL SELECT session_id::VARCHAR, 'rttm', 'SPEAKER ' || session_id || ' 1 ' || s || ' ' || d || ' <NA> <NA> ' || speaker || ' <NA> <NA>' FROM utt""",
    "ctm_lines": "SELECT session_id::VARCHAR AS recording_id, 'ctm' AS file, session_id || ' 1 ' || printf('%d.%03d', ws_ms // 1000, ws_ms % 1000) || ' ' || printf('%d.%03d', (we_ms - ws_ms) // 1000, (we_ms - ws_ms) % 1000) || ' ' || word || ' 1.000' AS line FROM words WHERE word <> ''",
    "csv_manifest": "SELECT speaker || '-' || session_id || '-' || lpad(idx::VARCHAR, 4, '0') AS utt_id, session_id::VARCHAR AS recording_id, s_ms / 1000.0::DOUBLE AS start, e_ms / 1000.0::DOUBLE AS end, (e_ms - s_ms) / 1000.0::DOUBLE AS duration, speaker AS speaker_id, language, text, snr_db, NULL::VARCHAR AS quality_tier FROM segments",
    "dataset_card": "SELECT session_id, string_agg(DISTINCT language, ',' ORDER BY language) AS languages, count(*) AS rows FROM segments GROUP BY session_id",
    "vendor_segments": "SELECT session_id * 100 + idx AS session_id, array_to_string(w, ' ') AS text, 0.5::DOUBLE AS start, 0.5::DOUBLE AS end, len(w)::INTEGER AS n_words FROM (SELECT *, list_filter(list_transform(string_split(text, ' '), lambda x: trim(x)), lambda x: x <> '') AS w FROM turns) WHERE len(w) > 0",
    "rollup_revenue": "SELECT r_name, n_name, sum(l_quantity) AS quantity, count(*) AS n FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY ROLLUP (r_name, n_name)",
    "asof_latest_order": "SELECT o_custkey, o_orderkey, lag(o_orderkey) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS previous FROM orders",
    "session_window_counts": """
        SELECT user_id, epoch_us(min(ts)) AS first_us, count(*) AS n FROM (SELECT *, sum(CASE WHEN l IS NULL OR ts - l >= INTERVAL 30 MINUTE THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS s FROM (SELECT *, lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS l FROM events)) GROUP BY user_id, s""",
}


def oracle_sql() -> dict[str, str]:
    return {name: _with(sql, 2_000 if name == "snr_forward_fill" else 400) for name, sql in (SQL | oracle_blocks.SQL).items() if sql}
