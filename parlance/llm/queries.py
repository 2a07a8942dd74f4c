"""The subpackage's queries, each an operator over its whole table, and their SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, embedding_dedup, exact_dedup, fill_in_middle, hard_negatives, jaccard_join, language_id, line_dedup, mixing, secret_scan, substring_dedup, suffix_dedup, tool_linking
from .common import table

#: The tool that every user turn of `conversations` counts as a call of.
SCHEMAS = {
    "reply": {
        "type": "object",
        "required": ["q", "turn"],
        "properties": {"q": {"type": "string", "maxLength": 400}, "turn": {"type": "integer", "minimum": 0}, "after": {"type": "string"}, "before": {"type": "string"}},
        "additionalProperties": False,
    }
}


def op1_bpe_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(table(spark, sf_dir, "documents"))


def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(table(spark, sf_dir, "documents"), keep="max")


def op3_tool_linking(spark: SparkSession, sf_dir: str) -> DataFrame:
    """User turns are calls; by their text's length they refer to the user turn before, the one after (which may refer back, a cycle), both or none. The assistant's next turn is the result; turns of other roles are neither."""
    turns = table(spark, sf_dir, "conversations")
    call_id = lambda turn: F.concat(F.lit("c"), F.col("conv_id").cast("string"), F.lit("-"), turn.cast("string"))
    kind = F.length("text") % 16
    to = lambda turn: F.struct(call_id(turn).alias("$ref"))
    after = F.when((kind < 12) & (F.col("turn") >= 2), to(F.col("turn") - 2))
    before = F.when(kind >= 10, to(F.col("turn") + 2))
    arguments = F.to_json(F.struct(F.col("text").alias("q"), F.col("turn"), after.alias("after"), before.alias("before")))
    calls = turns.where("role = 'user'").select("conv_id", call_id(F.col("turn")).alias("call_id"), F.col("turn").alias("seq"), F.lit("reply").alias("name"), arguments.alias("arguments"))
    results = turns.where("role = 'assistant'").select("conv_id", call_id(F.col("turn") - 1).alias("call_id"), F.col("turn").alias("seq"), F.col("text").alias("content"))
    out = tool_linking.link_tools(calls, results, SCHEMAS)
    return out.select(F.col("conv_id").cast("long").alias("conv_id"), "seq", "call_id", "level", "linked", "valid", "error", F.sha2("message", 256).alias("message_sha256"))


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.line_digests(table(spark, sf_dir, "documents"))


def op5_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.embedding_dedup(table(spark, sf_dir, "embeddings"))


def op6_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.suffix_digests(table(spark, sf_dir, "documents"))


def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.substring_digests(table(spark, sf_dir, "documents"))


def op8_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixed(table(spark, sf_dir, "documents"))


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = language_id.identify(docs, language_id.train(docs))
    return found.select("doc_id", language_id.held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


def op10_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.jaccard_join(table(spark, sf_dir, "documents"))


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of each positive of each anchor (vec_id divisible by 100) among all vectors; every seventh vec_id has the label after its own."""
    vectors = table(spark, sf_dir, "embeddings")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.hard_negatives(vectors.select("vec_id", "embedding", label.alias("label")), F.col("vec_id") % 100 == 0)


def op12_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spans of secrets in every whole document."""
    return secret_scan.scan_digests(table(spark, sf_dir, "documents"))


def op13_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of every document's fill-in-the-middle text, and of the text restored from it."""
    return fill_in_middle.middle_digests(table(spark, sf_dir, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = (op1_bpe_codec, op2_exact_dedup, op3_tool_linking, op4_line_dedup, op5_embedding_dedup, op6_suffix_dedup, op7_substring_dedup, op8_source_mixing, op9_language_id, op10_jaccard_join, op11_hard_negatives, op12_secret_scan, op13_fill_in_middle)
    return {f.__name__: f for f in found}


ORACLE = {
    "op2_exact_dedup": """
        WITH n AS (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
        g AS (SELECT doc_id, t, max(doc_id) OVER (PARTITION BY t) AS keep_id, count(*) OVER (PARTITION BY t) AS group_size FROM n)
        SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(t) AS text_sha256 FROM g""",
    "op3_tool_linking": """
        WITH RECURSIVE c AS (SELECT conv_id, turn, text, length(text) % 16 AS kind, 'c' || conv_id || '-' || turn AS call_id FROM conversations WHERE role = 'user'),
        r AS (SELECT conv_id, turn, text, 'c' || conv_id || '-' || (turn - 1) AS call_id FROM conversations WHERE role = 'assistant'),
        refs AS (SELECT conv_id, turn, turn - 2 AS ref FROM c WHERE kind < 12 AND turn >= 2 UNION ALL SELECT conv_id, turn, turn + 2 FROM c WHERE kind >= 10),
        e AS (SELECT f.conv_id, f.turn, f.ref FROM refs f JOIN c ON f.conv_id = c.conv_id AND f.ref = c.turn),
        lost AS (SELECT DISTINCT f.conv_id, f.turn FROM refs f ANTI JOIN c ON f.conv_id = c.conv_id AND f.ref = c.turn),
        reach(conv_id, a, b) AS (SELECT conv_id, turn, ref FROM e UNION SELECT reach.conv_id, reach.a, e.ref FROM reach JOIN e ON reach.conv_id = e.conv_id AND reach.b = e.turn),
        cyclic AS (SELECT conv_id, a AS turn FROM reach WHERE a = b),
        bad AS (SELECT conv_id, turn FROM cyclic UNION SELECT reach.conv_id, reach.a FROM reach JOIN cyclic y ON reach.conv_id = y.conv_id AND reach.b = y.turn),
        good AS (SELECT e.* FROM e ANTI JOIN bad ON e.conv_id = bad.conv_id AND e.turn = bad.turn),
        path(conv_id, a, b, d) AS (SELECT conv_id, turn, ref, 1 FROM good UNION SELECT path.conv_id, path.a, g.ref, d + 1 FROM path JOIN good g ON path.conv_id = g.conv_id AND path.b = g.turn),
        high AS (SELECT conv_id, a AS turn, max(d) AS level FROM path GROUP BY conv_id, a),
        j AS (SELECT coalesce(c.conv_id, r.conv_id) AS conv_id, coalesce(c.turn, r.turn) AS seq, coalesce(c.call_id, r.call_id) AS call_id,
                     c.call_id IS NOT NULL AS called, r.call_id IS NOT NULL AS answered, c.turn AS turn, c.kind, c.text AS q, r.text AS content,
                     lost.turn IS NOT NULL AS lost, bad.turn IS NOT NULL AS cyclic, coalesce(high.level, 0) AS level
              FROM c FULL JOIN r ON c.conv_id = r.conv_id AND c.call_id = r.call_id
              LEFT JOIN lost ON c.conv_id = lost.conv_id AND c.turn = lost.turn LEFT JOIN bad ON c.conv_id = bad.conv_id AND c.turn = bad.turn
              LEFT JOIN high ON c.conv_id = high.conv_id AND c.turn = high.turn),
        k AS (SELECT *, CASE WHEN NOT called THEN 'no call' WHEN q IS NULL THEN '$.q: missing' WHEN length(q) > 400 THEN '$.q: length'
                             WHEN lost THEN 'unknown reference' WHEN cyclic THEN 'cyclic reference' END AS error,
                     '{' || CASE WHEN kind < 12 AND turn >= 2 THEN '"after":{"$ref":"c' || conv_id || '-' || (turn - 2) || '"},' ELSE '' END
                         || CASE WHEN kind >= 10 THEN '"before":{"$ref":"c' || conv_id || '-' || (turn + 2) || '"},' ELSE '' END
                         || CASE WHEN q IS NOT NULL THEN '"q":' || to_json(q)::VARCHAR || ',' ELSE '' END || '"turn":' || turn || '}' AS args
              FROM j)
        SELECT conv_id, seq, call_id, CASE WHEN called AND NOT cyclic THEN level END::INTEGER AS level, called AND answered AS linked, error IS NULL AS valid, error,
               sha256('{"call":' || CASE WHEN called THEN '{"arguments":' || args || ',"id":"' || call_id || '","name":"reply"}' ELSE 'null' END
                   || ',"result":' || CASE WHEN answered THEN '{"content":' || coalesce(to_json(content)::VARCHAR, 'null') || ',"id":"' || call_id || '"}' ELSE 'null' END || '}') AS message_sha256
        FROM k""",
    "op5_embedding_dedup": """
        WITH RECURSIVE v AS (SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings
                             WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
                               AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
        e AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id AND list_cosine_similarity(a.e, b.e) >= 0.93),
        r(a, b) AS (SELECT a, b FROM e UNION SELECT r.a, e.b FROM r JOIN e ON r.b = e.a),
        n AS (SELECT a, count(*) AS n_links FROM e GROUP BY a), c AS (SELECT a, min(b) AS low FROM r GROUP BY a)
        SELECT vec_id, coalesce(n_links, 0) AS n_links, least(vec_id, coalesce(low, vec_id)) AS component_id, vec_id <= coalesce(low, vec_id) AS kept
        FROM embeddings LEFT JOIN n ON vec_id = n.a LEFT JOIN c ON vec_id = c.a""",
    "op7_substring_dedup": """
        WITH d AS (SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w FROM documents),
        p AS (SELECT doc_id, unnest(range(1, len(w) - 18)) AS s, w FROM d WHERE len(w) >= 20),
        k AS (SELECT doc_id, s, array_to_string(w[s:s + 19], ' ') AS t FROM p),
        o AS (SELECT doc_id, s, row_number() OVER (PARTITION BY t ORDER BY doc_id, s) AS r FROM k),
        gone AS (SELECT DISTINCT doc_id, s + i AS at FROM o, (SELECT unnest(range(0, 20)) AS i) WHERE r > 1),
        e AS (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS at FROM d),
        kept AS (SELECT e.doc_id, string_agg(word, ' ' ORDER BY e.at) AS t, count(*) AS n FROM e ANTI JOIN gone g ON e.doc_id = g.doc_id AND e.at = g.at GROUP BY e.doc_id)
        SELECT d.doc_id, len(w)::BIGINT AS n_words, (len(w) - coalesce(n, 0))::BIGINT AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
        FROM d LEFT JOIN kept ON d.doc_id = kept.doc_id""",
    "op11_hard_negatives": """
        WITH v AS (SELECT row_number() OVER () AS r, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                          list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e
                   FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        s AS (SELECT a.r AS anchor, a.vec_id AS anchor_id, b.vec_id AS id, b.r AS r, a.label = b.label AS same, list_inner_product(a.e, b.e)::BIGINT AS score
              FROM v a JOIN v b ON a.vec_id % 100 = 0 AND a.r <> b.r),
        p AS (SELECT * FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY anchor ORDER BY score DESC, id) <= 5),
        n AS (SELECT p.anchor_id, p.id AS positive_id, row_number() OVER (PARTITION BY p.anchor, p.r ORDER BY s.score DESC, s.id) AS rank,
                     s.id AS negative_id, p.score AS positive_score, s.score AS negative_score
              FROM p JOIN s ON p.anchor = s.anchor AND NOT s.same AND 80 * p.score <= 100 * s.score AND s.score <= p.score)
        SELECT anchor_id, positive_id, rank::INTEGER AS rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 5""",
    "op13_fill_in_middle": """
        WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t, sha256('7:' || doc_id) AS h, string_split(coalesce(text, ''), chr(10)) AS l FROM documents),
        n AS (SELECT *, len(l) - CASE WHEN l[-1] = '' THEN 1 ELSE 0 END AS n FROM d),
        x AS (SELECT *, ('0x' || substr(h, 1, 8))::BIGINT % (n + 1) AS x, ('0x' || substr(h, 9, 8))::BIGINT % (n + 1) AS y,
                     CASE WHEN t = '' OR t LIKE '%<P>%' OR t LIKE '%<S>%' OR t LIKE '%<M>%' THEN 'plain'
                          WHEN ('0x' || substr(h, 25, 8))::BIGINT % 100 < 50 THEN 'spm' ELSE 'psm' END AS form FROM n),
        c AS (SELECT *, list_sum(list_transform(l[1:least(x, y)], lambda u: length(u) + 1))::BIGINT AS a, list_sum(list_transform(l[1:greatest(x, y)], lambda u: length(u) + 1))::BIGINT AS b FROM x),
        e AS (SELECT *, least(coalesce(a, 0), length(t)) AS pa, least(coalesce(b, 0), length(t)) AS pb FROM c),
        o AS (SELECT *, substr(t, 1, pa) AS p, substr(t, pa + 1, pb - pa) AS m, substr(t, pb + 1) AS s FROM e)
        SELECT doc_id, n::BIGINT AS n, form, CASE WHEN form <> 'plain' THEN pa END::BIGINT AS prefix_chars, CASE WHEN form <> 'plain' THEN pb - pa END::BIGINT AS middle_chars,
               sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
               sha256(t) AS restored_sha256
        FROM o""",
}


def oracle_sql() -> dict[str, str]:
    return dict(ORACLE)
