"""Registered queries of the training-data operators and their DuckDB twins."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from partwright.llm.common import read_table
from partwright.llm.chunk_dedup import chunk_dedup
from partwright.llm.conversation_trie import BLOCK, MOST_BORROWED, conversation_trie
from partwright.llm.decontaminate import contaminated
from partwright.llm.exact_dedup import exact_dedup
from partwright.llm.html_extract import main_text
from partwright.llm.line_dedup import line_dedup
from partwright.llm.mixing import SCHEDULES, in_training_order, plan_mix
from partwright.llm.ngram_join import ngram_join
from partwright.llm.periodic_runs import detect_periodic_runs
from partwright.llm.quality import fit_quality, score_quality
from partwright.llm.quality_rules import STOP_WORDS, SYMBOLS, quality_rules
from partwright.llm.suffix_dedup import suffix_dedup
from partwright.llm.url_filter import url_filter


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(read_table(spark, sf_dir, "documents"), keep="largest")


def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = suffix_dedup(read_table(spark, sf_dir, "documents"))
    return cut.select("doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = line_dedup(read_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


def op4_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = url_filter(read_table(spark, sf_dir, "pages").select("page_id", "url"))
    return judged.select("page_id", "host", "path", "rule", "verdict", "score")


def op5_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    model = fit_quality(docs, read_table(spark, sf_dir, "labels"))
    return score_quality(docs, model).select("doc_id", "held_out", "score", "predicted")


def op6_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per document and benchmark item found in it; clean documents have none."""
    return contaminated(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


def op7_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join(read_table(spark, sf_dir, "documents"))


def op8_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents in training order: words taken, and the position of the first copy (null: none taken)."""
    plan = in_training_order(plan_mix(read_table(spark, sf_dir, "documents").select("doc_id", "text", "source")))
    return plan.select("doc_id", "size", "source_size", "target", "taken", "position")


def op9_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_text(read_table(spark, sf_dir, "pages")).select("page_id", "url", "text", "n_chars")


def op10_chunk_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = chunk_dedup(read_table(spark, sf_dir, "documents"))
    return cut.select(
        "doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"), "n_repeated", F.sha2("kept", 256).alias("kept_sha256")
    )


def op11_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality_rules(read_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


def op12_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_trie(read_table(spark, sf_dir, "conversations"))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    runs = detect_periodic_runs(read_table(spark, sf_dir, "documents").select("doc_id", "text"), plant_by="doc_id")
    return runs.select(
        "doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", F.sha2("collapsed", 256).alias("collapsed_sha256")
    )


QUERIES = {
    "op1_exact_dedup": op1_exact_dedup,
    "op2_suffix_dedup": op2_suffix_dedup,
    "op3_line_dedup": op3_line_dedup,
    "op4_url_filter": op4_url_filter,
    "op5_quality_classifier": op5_quality_classifier,
    "op6_decontaminate": op6_decontaminate,
    "op7_ngram_join": op7_ngram_join,
    "op8_mix_sources": op8_mix_sources,
    "op9_html_extract": op9_html_extract,
    "op10_chunk_dedup": op10_chunk_dedup,
    "op11_quality_rules": op11_quality_rules,
    "op12_conversation_trie": op12_conversation_trie,
    "op13_periodic_runs": op13_periodic_runs,
}

_STOP_WORDS = ", ".join(f"'{w}', '{w.capitalize()}'" for w in STOP_WORDS)


def _position_sql(share: str) -> str:
    """The time at which the integral of a weight's schedule reaches ``share`` of its total."""
    cases = []
    for weight, values in SCHEDULES.items():
        step = 1.0 / (len(values) - 1)
        areas = [(a + b) / 2 * step for a, b in zip(values, values[1:], strict=False)]
        area = f"({share} * {sum(areas)}::DOUBLE)"
        pieces = ""
        for k in reversed(range(len(areas))):
            rest, slope = f"({area} - {sum(areas[:k])}::DOUBLE)", (values[k + 1] - values[k]) / step
            time = (
                f"{k * step}::DOUBLE + 2::DOUBLE * {rest} / ({values[k]}::DOUBLE + sqrt({values[k] ** 2}::DOUBLE + {2 * slope}::DOUBLE * {rest}))"
            )
            pieces += f" WHEN {area} >= {sum(areas[:k])}::DOUBLE THEN {time}" if k else f" ELSE {time}"
        cases.append(f"WHEN weight = {weight} THEN (CASE{pieces} END)")
    return f"CASE {' '.join(cases)} ELSE {share} END"


_AZ = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"

ORACLE = {
    "op1_exact_dedup": f"""
WITH d AS (SELECT doc_id, translate(coalesce(text, ''), {_AZ}) AS content FROM documents)
SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
       doc_id = max(doc_id) OVER g AS kept, sha256(content) AS text_sha256
FROM d WINDOW g AS (PARTITION BY content)""",
    "op3_line_dedup": f"""
WITH d AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents),
     l AS (SELECT doc_id, unnest(parts) AS line, generate_subscripts(parts, 1) AS pos FROM d),
     k AS (SELECT *, translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), {_AZ}) AS key FROM l),
     f AS (SELECT key, max(doc_id) AS owner FROM k WHERE length(key) >= 20 GROUP BY key HAVING count(DISTINCT doc_id) >= 3),
     j AS (SELECT k.doc_id, line, pos, f.key IS NOT NULL AND f.owner <> k.doc_id AS gone FROM k LEFT JOIN f ON k.key = f.key)
SELECT doc_id, count(*) AS n_lines, count_if(gone)::BIGINT AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM j GROUP BY doc_id""",
    "op7_ngram_join": rf"""
WITH RECURSIVE
     w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), {_AZ}), '[^\x20\x09-\x0D]+') AS ws FROM documents),
     s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 5 THEN [array_to_string(ws, ' ')]
                  ELSE list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' ')) END) AS g FROM w),
     n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
     i AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id
           GROUP BY a.doc_id, b.doc_id),
     e AS (SELECT a, b FROM i JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 80 * (x.n + y.n - c)),
     r AS (SELECT doc_id AS id, doc_id AS root FROM documents UNION SELECT e.b, r.root FROM r JOIN e ON e.a = r.id)
SELECT r.id AS doc_id, coalesce(any_value(n.n), 0) AS n_shingles, min(r.root) AS component_id
FROM r LEFT JOIN n ON n.doc_id = r.id GROUP BY r.id""",
    "op8_mix_sources": rf"""
WITH d AS (SELECT doc_id, source, md5(CAST(doc_id AS VARCHAR)) AS o,
                  len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size FROM documents),
     s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
     w AS (SELECT *, ([5, 2, 1])[1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3]::BIGINT AS weight FROM s),
     c AS (SELECT *, (3 * source_size)::DOUBLE / weight AS level FROM w),
     u AS (SELECT *, ((SELECT sum(source_size) FROM w)
                      - coalesce(sum(3 * source_size) OVER (ORDER BY level, source NULLS LAST
                                 ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::DOUBLE
                   / ((SELECT sum(weight) FROM w)
                      - coalesce(sum(weight) OVER (ORDER BY level, source NULLS LAST
                                 ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::DOUBLE AS share FROM c),
     x AS (SELECT arg_min(share, level) AS unit FROM u WHERE share <= level),
     t AS (SELECT source, source_size, weight, least((3 * source_size)::DOUBLE, (SELECT unit FROM x) * weight) AS target FROM w),
     p AS (SELECT d.doc_id, d.size, t.source_size, t.target, t.weight, floor(t.target)::BIGINT AS demand,
                  coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY d.o, d.size
                           ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS ahead
           FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
     y AS (SELECT *, greatest(0, least(size, demand - ahead)) AS take,
                  CASE WHEN demand > 0 THEN least(ahead / demand, 1::DOUBLE) ELSE 0::DOUBLE END AS share FROM p)
SELECT doc_id, size, source_size, target,
       (take + greatest(0, least(size, demand - source_size - ahead))
        + greatest(0, least(size, demand - 2 * source_size - ahead)))::BIGINT AS taken,
       CASE WHEN take > 0 THEN {_position_sql('share')} END AS position
FROM y""",
    "op11_quality_rules": rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text,
                  regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws,
                  list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls
           FROM documents),
     w AS (SELECT r, i, ws[i] AS a, ws[i + 1] AS b, ws[i + 2] AS c FROM (SELECT r, ws, unnest(range(1, len(ws) - 1)) AS i FROM d)),
     x AS (SELECT r, i FROM w QUALIFY count(*) OVER (PARTITION BY r, a, b, c) > 1),
     y AS (SELECT r, least(3, coalesce(lead(i) OVER (PARTITION BY r ORDER BY i) - i, 3)) AS n FROM x),
     z AS (SELECT r, sum(n)::BIGINT AS n FROM y GROUP BY r),
     c AS (SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(list_sum(list_transform(ws, lambda v: length(v))), 0)::BIGINT AS word_chars,
                  len(regexp_extract_all(text, '{SYMBOLS}'))::BIGINT AS n_symbols, len(regexp_extract_all(text, '!+')) AS n_shouts,
                  len(ls) AS n_lines, (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines, coalesce(z.n, 0)::BIGINT AS n_repeat_words,
                  len(list_filter(ws, lambda v: v IN ({_STOP_WORDS}))) AS n_stop_words
           FROM d LEFT JOIN z USING (r)),
     e AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM c)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND 1000 * word_chars BETWEEN 2000 * n_words AND 14000 * n_words AND 1000 * n_symbols <= 100 * n_words
       AND 1000 * n_stop_words >= 60 * n_words AND 1000 * n_dup_lines <= 400 * n_lines AND 1000 * n_shouts <= 100 * n_words AS kept
FROM e""",
    "op12_conversation_trie": rf"""
WITH t AS (SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
                  row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST,
                                     sha256(concat(strlen(coalesce(role, '')), ':', coalesce(role, ''), coalesce(text, '')))) - 1 AS pos
           FROM conversations WHERE conv_id IS NOT NULL),
     c AS (SELECT conv_id, conv_id - conv_id % {BLOCK} AS head, count(*) AS n,
                  xor(list_reduce(list_concat([4294967295::BIGINT], list_transform(string_split(conv_id::VARCHAR, ''), lambda v: ord(v)::BIGINT)),
                        lambda a, b: list_reduce(list_concat([xor(a, b)], [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]),
                                                 lambda y, z: xor(y >> 1, (y & 1) * 3988292384))), 4294967295) % {MOST_BORROWED + 1} AS h
           FROM t GROUP BY conv_id),
     s AS (SELECT c.conv_id, t.pos AS i, role, text FROM c JOIN t ON t.conv_id = c.head AND t.pos < h
           UNION ALL
           SELECT c.conv_id, t.pos - c.h + least(c.h, coalesce(o.n, 0)), role, text
           FROM c JOIN t ON t.conv_id = c.conv_id LEFT JOIN c o ON o.conv_id = c.head WHERE t.pos >= c.h),
     m AS (SELECT c.conv_id, count(s.i) AS n FROM c LEFT JOIN s ON s.conv_id = c.conv_id GROUP BY c.conv_id),
     p AS (SELECT conv_id, i + 1 AS depth, list({{'r': role, 't': text}}) OVER (PARTITION BY conv_id ORDER BY i) AS key,
                  len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) AS words FROM s
           UNION ALL SELECT conv_id, 0, CAST([] AS STRUCT(r VARCHAR, t VARCHAR)[]), 0 FROM c),
     v AS (SELECT key, any_value(depth) AS depth, min(p.conv_id) AS conv_id, count(*) AS n_convs, (count(*) - 1) * any_value(words) AS saved,
                  sha256(coalesce(string_agg(p.conv_id::VARCHAR, ',' ORDER BY p.conv_id) FILTER (WHERE m.n = p.depth), '')) AS ends_sha256
           FROM p JOIN m ON m.conv_id = p.conv_id GROUP BY key),
     k AS (SELECT key[1:depth - 1] AS key, count(*) AS n_children FROM v WHERE depth > 0 GROUP BY 1),
     u AS (SELECT v.*, coalesce(n_children, 0) AS n_children FROM v LEFT JOIN k ON k.key = v.key),
     a AS (SELECT key[1:d] AS key, count_if(n_children = 0)::BIGINT AS n_leaves, sum(saved)::BIGINT AS saved_tokens
           FROM (SELECT *, unnest(range(0, depth + 1)) AS d FROM u) GROUP BY 1)
SELECT u.conv_id, u.depth, o.conv_id AS parent_conv_id, u.n_convs, u.n_children, n_leaves, saved_tokens, u.ends_sha256
FROM u JOIN a ON a.key = u.key LEFT JOIN v o ON u.depth > 0 AND o.key = u.key[1:u.depth - 1]""",
}
