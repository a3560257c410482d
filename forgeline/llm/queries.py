"""The registered queries of the training-data operators and, where SQL can
express them, the same in DuckDB SQL. Each reads the whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from forgeline.llm import (bpe, conversation_repair, exact_dedup, line_dedup, mixing, pii, pseudo_likelihood, quality_divergence,
                           simhash_trie, suffix_dedup, token_files, url_rules, vector_codes)
from forgeline.llm.shared import ship_package


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def bpe_pattern() -> str:
    import public_tokenizers

    return public_tokenizers.PATTERN


def _table(spark: SparkSession, d: str, name: str) -> DataFrame:
    ship_package(spark)
    return spark.read.parquet(f"{d}/{name}.parquet")


def hex16(fp) -> F.Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def op1(spark, d):
    return exact_dedup.exact_dedup(_table(spark, d, "documents")).select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def op2(spark, d):
    return line_dedup.line_report(_table(spark, d, "documents"))


def op3(spark, d):
    found = simhash_trie.simhash_groups(_table(spark, d, "documents"), shingle=4, max_bits=4)
    return found.select("doc_id", hex16("fp").alias("fingerprint"), "component_id")


def op4(spark, d):
    return pseudo_likelihood.score_corpus(_table(spark, d, "documents"))


def op5(spark, d):
    return mixing.mix(_table(spark, d, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op6(spark, d):
    return url_rules.judge_urls(_table(spark, d, "pages"), url_rules.rule_table(spark))


def op7(spark, d):
    return token_files.token_file_digests(_table(spark, d, "documents"), tokenizer_path("byte_bpe_50k.json"), end_id=0)


def op8(spark, d):
    return bpe.round_trip(_table(spark, d, "documents"), tokenizer_path("byte_bpe_multi_50k.tiktoken"), bpe_pattern())


def op9(spark, d):
    return pii.find_pii(_table(spark, d, "documents"))


def op10(spark, d):
    return quality_divergence.quality(_table(spark, d, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op11(spark, d):
    return conversation_repair.repair_conversations(_table(spark, d, "conversations"))


def op12(spark, d):
    return vector_codes.code_report(_table(spark, d, "embeddings"))


def op13(spark, d):
    return suffix_dedup.repeat_report(_table(spark, d, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_exact_dedup": op1,
        "op2_line_dedup": op2,
        "op3_simhash_near_dedup": op3,
        "op4_lm_scoring": op4,
        "op5_source_mixing": op5,
        "op6_url_filters": op6,
        "op7_token_files": op7,
        "op8_byte_bpe": op8,
        "op9_pii": op9,
        "op10_quality_rules": op10,
        "op11_conversation_repair": op11,
        "op12_vector_codes": op12,
        "op13_suffix_dedup": op13,
    }


_OP1 = """
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id = max(doc_id) OVER w AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW w AS (PARTITION BY coalesce(text, ''))
"""

_OP5 = r"""
WITH docs AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
         length(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', '', 'g')) AS visible,
         length(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D\p{L}]+', '', 'g')) AS other,
         (('0x' || substr(md5(coalesce(doc_id::VARCHAR, 'null')), 1, 13))::BIGINT + 0.5::DOUBLE) / 4503599627370496.0::DOUBLE AS u
  FROM documents),
keyed AS (
  SELECT doc_id, source, size,
         -ln(u) / (0.5::DOUBLE + CASE WHEN visible > 0 THEN (visible - other)::DOUBLE / visible ELSE 0 END) AS k
  FROM docs),
sums AS (SELECT source, sum(size)::BIGINT AS source_size FROM keyed GROUP BY source),
weighed AS (
  SELECT *, [3, 1, 2][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT]::DOUBLE AS weight,
         source_size * 2.0::DOUBLE AS cap, (sum(source_size) OVER ())::DOUBLE * 1.5::DOUBLE AS whole FROM sums),
ranked AS (
  SELECT *, row_number() OVER (ORDER BY cap / weight, source NULLS LAST) AS place,
         (whole - coalesce(sum(cap) OVER (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
         / sum(weight) OVER (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM weighed),
stop AS (SELECT level FROM ranked WHERE level <= cap / weight ORDER BY place LIMIT 1),
targets AS (
  SELECT source, source_size, coalesce(least(cap, (SELECT level FROM stop) * weight), cap) AS target FROM ranked),
budget AS (
  SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END::BIGINT AS epochs FROM targets),
placed AS (
  SELECT doc_id, size, source_size, target, epochs, target - epochs * source_size AS rest,
         sum(size) OVER (PARTITION BY k.source ORDER BY k, doc_id, size ROWS UNBOUNDED PRECEDING)::BIGINT AS upto
  FROM keyed k JOIN budget b ON k.source IS NOT DISTINCT FROM b.source)
SELECT doc_id, size, source_size, target,
       ((epochs + CASE WHEN upto + upto - size <= 2 * rest THEN 1 ELSE 0 END) * size)::BIGINT AS taken
FROM placed
"""

_OP6 = r"""
WITH rules(verdict, h, p) AS (VALUES ('allow', 'org', '/'), ('block', 'example.org', '/es/'), ('block', 'example.org', '/en/1'),
                                     ('allow', 'com', '/fr/'), ('block', 'com', '/de/')),
parts AS (SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
hosts AS (SELECT page_id, rest, regexp_extract(rest, '^[^/?#]*') AS raw FROM parts),
judged AS (
  SELECT page_id, translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(substr(rest, length(raw) + 1), '^[^?#]*') AS path FROM hosts),
fits AS (
  SELECT page_id, h || p AS rule, verdict,
         row_number() OVER (PARTITION BY page_id ORDER BY length(h) + length(p) DESC, length(h) DESC, verdict = 'block' DESC) AS place
  FROM judged JOIN rules ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p))
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict
FROM judged LEFT JOIN (SELECT * FROM fits WHERE place = 1) USING (page_id)
"""



def _assigned(name: str, book: str) -> str:
    """The nearest entry of each part: distances are whole numbers, ties go to the lower entry."""
    return f"""
{name} AS (
  SELECT k.row, k.p, any_value(k.x) AS x,
         min((list_dot_product(k.x, k.x) - 2 * list_dot_product(k.x, b.x) + list_dot_product(b.x, b.x))::BIGINT * 256 + b.e) AS best
  FROM parts k JOIN {book} b ON k.p = b.p GROUP BY k.row, k.p),"""


def _averaged(name: str, assigned: str, book: str) -> str:
    return f"""
{name}_sums AS (
  SELECT p, e, i, sum(v)::BIGINT AS s, count(*) AS n
  FROM (SELECT p, best % 256 AS e, unnest(x)::BIGINT AS v, unnest(range(len(x))) AS i FROM {assigned}) GROUP BY p, e, i),
{name} AS MATERIALIZED (
  SELECT b.p, b.e, coalesce(any_value(m.x), any_value(b.x)) AS x FROM {book} b
  LEFT JOIN (SELECT p, e, list(((s - ((s % n) + n) % n) // n)::DOUBLE ORDER BY i) AS x FROM {name}_sums GROUP BY p, e) m
  ON b.p = m.p AND b.e = m.e GROUP BY b.p, b.e),"""


_OP12 = """
WITH kept AS MATERIALIZED (
  SELECT vec_id, label, row_number() OVER (ORDER BY vec_id NULLS LAST) AS row,
         list_transform(embedding, lambda x: floor(x::DOUBLE * 1024)) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0),
parts AS MATERIALIZED (
  SELECT row, p, list_slice(v, p * (len(v) // 4) + 1, (p + 1) * (len(v) // 4)) AS x FROM kept, range(4) r(p)),
book0 AS MATERIALIZED (SELECT p, row - 1 AS e, x FROM parts WHERE row <= 256),""" + "".join(
    _assigned(f"near{i}", f"book{i}") + _averaged(f"book{i + 1}", f"near{i}", f"book{i}") for i in range(4)) + _assigned("near4", "book4") + """
coded AS (
  SELECT row, string_agg(printf('%02x', best % 256), '' ORDER BY p) AS code, sum(best // 256)::BIGINT AS error FROM near4 GROUP BY row),
digest AS (SELECT sha256(string_agg(t, ',' ORDER BY p, e)) AS h
           FROM (SELECT p, e, array_to_string(list_transform(x, lambda v: v::BIGINT), ',') AS t FROM book4))
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, h AS codebooks_sha256
FROM coded JOIN kept USING (row), digest
"""

_OP13 = """
WITH hexed AS MATERIALIZED (
  SELECT row_number() OVER () AS row, coalesce(doc_id, 9223372036854775807) AS rank, doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
strings AS MATERIALIZED (
  SELECT row, rank, i, substr(h, 2 * i + 1, 100) AS s FROM hexed, LATERAL unnest(range(0, len(h) // 2 - 49)) u(i)),
late AS (
  SELECT row, i FROM (SELECT row, i, rank, min(rank) OVER (PARTITION BY s) AS least FROM strings) WHERE rank > least),
marked AS (SELECT row, i, CASE WHEN i <= lag(i) OVER (PARTITION BY row ORDER BY i) + 50 THEN 0 ELSE 1 END AS opens FROM late),
numbered AS (SELECT row, i, sum(opens) OVER (PARTITION BY row ORDER BY i) AS span FROM marked),
spans AS (SELECT row, span, min(i) AS lo, max(i) + 50 AS hi FROM numbered GROUP BY row, span),
pieces AS (
  SELECT row, lo, hi, coalesce(lag(hi) OVER w, 0) AS since, lead(lo) OVER w IS NULL AS ends FROM spans WINDOW w AS (PARTITION BY row ORDER BY lo)),
cut AS (
  SELECT row, sum(hi - lo)::BIGINT AS n_removed, count(*)::BIGINT AS n_spans,
         string_agg(substr(h, 2 * since + 1, 2 * (lo - since)) || CASE WHEN ends THEN substr(h, 2 * hi + 1) ELSE '' END, '' ORDER BY lo) AS kept
  FROM pieces JOIN hexed USING (row) GROUP BY row)
SELECT doc_id, (len(h) // 2)::BIGINT AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed, coalesce(n_spans, 0)::BIGINT AS n_spans,
       sha256(unhex(coalesce(kept, h))) AS kept_sha256
FROM hexed LEFT JOIN cut USING (row)
"""



_OP11 = r"""
WITH RECURSIVE
keyed AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS key FROM conversations),
-- crc32: xor the byte, then eight shifts (marked -1)
hashed AS (
  SELECT conv_id, turn, role, text,
         xor(list_reduce(flatten(list_transform(string_split(key, ''), lambda ch: [ord(ch)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1])),
             lambda c, v: CASE WHEN v >= 0 THEN xor(c, v) WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, 4294967295::BIGINT),
             4294967295) % 20 AS kind FROM keyed),
damaged AS (
  SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
         CASE kind WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text
  FROM hashed, LATERAL unnest(range(CASE WHEN kind = 3 THEN 2 ELSE 1 END)) WHERE kind <> 0),
placed AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i FROM damaged),
judged AS MATERIALIZED (
  SELECT *, left(role, 1) AS initial, lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY i) || left(role, 1) AS pair,
         CASE WHEN regexp_matches(text, '[^\x20\x09-\x0D]') IS FALSE THEN 'blank'
              WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 'duplicate'
              WHEN NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*$') THEN 'truncated' ELSE 'sound' END AS fault FROM placed),
step(f, symbol, t) AS (VALUES (0, 's', 1), (0, 'u', 2), (1, 'u', 2), (3, 'u', 2), (2, 'a', 3)),
inserted(f, t, n, lines) AS (
  VALUES (0, 0, 0, []::VARCHAR[]), (1, 1, 0, []), (2, 2, 0, []), (3, 3, 0, []), (0, 2, 1, ['user:']), (1, 2, 1, ['user:']), (3, 2, 1, ['user:']),
         (2, 3, 1, ['assistant:']), (0, 3, 2, ['user:', 'assistant:']), (1, 3, 2, ['user:', 'assistant:'])),
convs AS MATERIALIZED (
  SELECT c.conv_id, count(j.i) AS n FROM (SELECT DISTINCT conv_id FROM conversations) c LEFT JOIN judged j ON c.conv_id IS NOT DISTINCT FROM j.conv_id
  GROUP BY c.conv_id),
edits AS MATERIALIZED (
  SELECT j.conv_id, j.i, s.f, s.t, CASE WHEN fault = 'truncated' THEN 3 ELSE 0 END AS cost, 'K' AS letter, [role || ':' || text] AS lines
  FROM judged j JOIN step s ON s.symbol = j.initial WHERE fault NOT IN ('blank', 'duplicate')
  UNION ALL
  SELECT j.conv_id, j.i, s.f, s.t, 3 + CASE WHEN fault = 'truncated' THEN 3 ELSE 0 END, 'R',
         [CASE s.symbol WHEN 'u' THEN 'user:' ELSE 'assistant:' END || text]
  FROM judged j, step s WHERE s.symbol IN ('u', 'a') AND fault NOT IN ('blank', 'duplicate')
  UNION ALL
  SELECT j.conv_id, j.i, q.f, q.f, 4, 'D', []::VARCHAR[] FROM judged j, (SELECT DISTINCT f FROM inserted) q),
walk AS (
  SELECT c.conv_id, 0::BIGINT AS i, s.t AS state, {'cost': (3 * s.n)::BIGINT, 'audit': repeat('I', s.n), 'lines': s.lines} AS best
  FROM convs c, inserted s WHERE s.f = 0
  UNION ALL
  SELECT w.conv_id, w.i + 1, s.t,
         min({'cost': (w.best.cost + e.cost + 3 * s.n)::BIGINT, 'audit': w.best.audit || e.letter || repeat('I', s.n),
              'lines': list_concat(list_concat(w.best.lines, e.lines), s.lines)})
  FROM walk w JOIN edits e ON w.conv_id IS NOT DISTINCT FROM e.conv_id AND e.i = w.i + 1 AND e.f = w.state JOIN inserted s ON s.f = e.t
  GROUP BY w.conv_id, w.i, s.t),
repaired AS (
  SELECT c.conv_id, min(best) AS best FROM walk w JOIN convs c ON c.conv_id IS NOT DISTINCT FROM w.conv_id AND w.i = c.n
  WHERE state IN (0, 3) GROUP BY c.conv_id),
counted AS (
  SELECT c.conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0)::BIGINT AS gaps,
         count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate, count(*) FILTER (fault = 'truncated') AS truncated,
         count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal
  FROM convs c LEFT JOIN judged j ON c.conv_id IS NOT DISTINCT FROM j.conv_id GROUP BY c.conv_id)
SELECT c.conv_id, gaps, blank, duplicate, truncated, illegal, best.cost AS cost, best.audit AS audit,
       sha256(array_to_string(best.lines, chr(10))) AS repaired_sha256
FROM counted c JOIN repaired r ON c.conv_id IS NOT DISTINCT FROM r.conv_id
"""


def oracle_sql() -> dict[str, str]:
    return {"op1_exact_dedup": _OP1, "op5_source_mixing": _OP5, "op6_url_filters": _OP6, "op11_conversation_repair": _OP11,
            "op12_vector_codes": _OP12, "op13_suffix_dedup": _OP13}
