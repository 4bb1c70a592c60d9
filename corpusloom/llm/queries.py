"""Registered queries of this subpackage, and the SQL of those that SQL can express."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.llm import (
    compression_classifier,
    decontamination,
    language_id,
    mixing,
    ngram_join,
    quality_rules,
    secret_scan,
    token_alignment,
    token_blocks,
    token_counts,
    toxicity,
    vector_codes,
    warc_bundles,
)
from corpusloom.llm.shared import in_fold


def _vocabulary(name: str) -> str:
    """Where a public vocabulary file is; looked up only when a query needs it."""
    import public_tokenizers

    return public_tokenizers.path(name)


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every stretch of a document that aligns with a benchmark item."""
    return decontamination.matches(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "benchmark"))


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weakly supervised quality verdicts for every document."""
    scored = quality_rules.score_quality(_read(spark, sf_dir, "documents"))
    return scored.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        F.round("quality_probability", 6).alias("quality_probability"),
    )


def op3_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Component of every document under links of similar shingle sets."""
    return ngram_join.similar_documents(_read(spark, sf_dir, "documents"))


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, learned from three quarters of the documents with a language."""
    docs = _read(spark, sf_dir, "documents")
    held_out = in_fold(F.col("doc_id"), 4, 2)
    found = language_id.predict(docs, language_id.learn(docs.filter(~held_out)))
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def op5_token_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token files of every document, read back."""
    return token_blocks.encode_corpus(_read(spark, sf_dir, "documents"), _vocabulary("word_bpe_49k.json"))


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document once for each epoch of its source that takes it."""
    sizes = mixing.sized(_read(spark, sf_dir, "documents"))
    mixed = mixing.apply(sizes, mixing.plan(sizes))
    return mixed.select(
        "doc_id", "source", "n_tokens", F.col("mix_epoch").alias("epoch"), F.col("mix_block").alias("block"),
        F.col("mix_rank").alias("block_rank"), F.round("mix_weight", 9).alias("weight"),
    )


def op7_warc_bundles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """WARC bundles of every page, read back."""
    return warc_bundles.archive(_read(spark, sf_dir, "pages"))


def op8_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in every document."""
    return secret_scan.report(_read(spark, sf_dir, "documents"))


def op9_compression_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document, learned from four fifths of the labels."""
    docs, labels = _read(spark, sf_dir, "documents"), _read(spark, sf_dir, "labels")
    held_out = in_fold(F.col("doc_id"), 5, 0)
    model = compression_classifier.fit_labelled(docs, labels.filter(~held_out), "quality")
    predicted = F.when(F.col("score") >= 0.3, 1).otherwise(0)
    return compression_classifier.score(docs, model).select(
        "doc_id", held_out.alias("held_out"), "score", predicted.alias("predicted")
    )


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of every document, learned from two thirds of the labels."""
    docs, labels = _read(spark, sf_dir, "documents"), _read(spark, sf_dir, "labels")
    held_out = in_fold(F.col("doc_id"), 3, 1)
    model = toxicity.fit_labelled(docs, labels.filter(~held_out), "toxic")
    predicted = F.when(F.col("score") >= 0.7, 1).otherwise(0)
    return toxicity.score(docs, model).select(
        "doc_id", held_out.alias("held_out"), "score", predicted.alias("predicted")
    )


def op11_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts of every document, and how much of it fits into 2048 tokens."""
    return token_counts.token_counts(_read(spark, sf_dir, "documents"), _vocabulary("word_bpe_49k.json"), limit=2048)


def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups and links between two tokenizers' tokens of every document."""
    return token_alignment.alignment_report(_read(spark, sf_dir, "documents"), _vocabulary("byte_bpe_50k.json"), _vocabulary("piece_bpe_32k.model"))


def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Codes of every usable vector, their errors, and the digest of the codebooks."""
    coded, books = vector_codes.compress(_read(spark, sf_dir, "embeddings"))
    return coded.select(F.col("id").alias("vec_id"), "code", "error", "label_error", F.lit(books.digest).alias("codebooks_sha256"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_decontamination, op2_quality_rules, op3_ngram_join, op4_language_id, op5_token_blocks, op6_mixing, op7_warc_bundles, op8_secret_scan, op9_compression_classifier, op10_toxicity,
        op11_token_counts, op12_token_alignment, op13_vector_codes,
    )
}

OP3_SQL = """
WITH RECURSIVE texts AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS l FROM documents
), shingles AS (
  SELECT DISTINCT r, CASE WHEN len(l) < 3 THEN array_to_string(l, ' ') ELSE l[i] || ' ' || l[i + 1] || ' ' || l[i + 2] END AS s
  FROM (SELECT r, l, unnest(range(1, greatest(len(l) - 1, least(len(l), 1) + 1))) AS i FROM texts)
), sizes AS (SELECT r, count(*) AS n FROM shingles GROUP BY r),
pairs AS (
  SELECT a.r AS x, b.r AS y, count(*) AS c FROM shingles a JOIN shingles b ON a.s = b.s AND a.r < b.r GROUP BY a.r, b.r
), links AS (
  SELECT x, y FROM pairs JOIN sizes p ON p.r = x JOIN sizes q ON q.r = y WHERE 100 * c >= 90 * (p.n + q.n - c)
), edges AS (SELECT x, y FROM links UNION ALL SELECT y, x FROM links),
reach AS (SELECT r AS x, r AS y FROM texts UNION SELECT reach.x, edges.y FROM reach JOIN edges ON edges.x = reach.y)
SELECT t.doc_id, coalesce(any_value(n), 0)::BIGINT AS n_shingles, min(o.doc_id) AS component_id
FROM texts t LEFT JOIN sizes USING (r) JOIN reach ON reach.x = t.r JOIN texts o ON o.r = reach.y GROUP BY t.r, t.doc_id
"""

OP7_SQL = """
WITH hashed AS (
  SELECT page_id, coalesce(html, '') AS payload, sha1(coalesce(html, '')) AS sha FROM pages
), digested AS (
  SELECT page_id, octet_length(encode(payload))::BIGINT AS payload_bytes,
    array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + (
      (('0x' || substr(sha, 1 + 5 * (i // 4)::INT, 5))::BIGINT >> (15 - 5 * (i % 4))::INT) & 31)::INT, 1)), '')
      AS payload_digest,
    max(page_id) OVER (PARTITION BY payload) AS response
  FROM hashed
)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN page_id IS NOT DISTINCT FROM response THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id IS DISTINCT FROM response THEN response END AS refers_to
FROM digested
"""



OP6_SQL = f"""
WITH RECURSIVE sizes AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::BIGINT AS n_tokens,
    (('0x' || substr(md5(coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT % {mixing.BLOCKS})::INT AS block FROM documents
), blocks AS (
  SELECT coalesce(source, '') AS name, source IS NULL AS none, block, sum(n_tokens)::BIGINT AS n
  FROM sizes GROUP BY source, block
), totals AS (SELECT name, none, sum(n)::BIGINT AS "all" FROM blocks GROUP BY name, none),
shares AS (
  SELECT "all" / (SELECT sum("all") FROM totals)::DOUBLE AS p, ln((SELECT count(*) FROM totals WHERE "all" > 0))
    * {mixing.ENTROPY_SHARE} AS target FROM totals WHERE "all" > 0
), halves AS (
  SELECT 0 AS i, 0.0::DOUBLE AS lo, 1.0::DOUBLE AS hi, 0.0::DOUBLE AS rlo, 1.0::DOUBLE AS rhi
  UNION ALL
  SELECT i + 1, CASE WHEN fine THEN mid ELSE lo END, CASE WHEN fine THEN hi ELSE mid END,
    CASE WHEN often THEN rmid ELSE rlo END, CASE WHEN often THEN rhi ELSE rmid END
  FROM (
    SELECT i, lo, hi, rlo, rhi, (lo + hi) / 2 AS mid, (rlo + rhi) / 2 AS rmid,
      ln(sum(p ** ((lo + hi) / 2))) - sum(p ** ((lo + hi) / 2) * (lo + hi) / 2 * ln(p)) / sum(p ** ((lo + hi) / 2))
        >= any_value(target) AS fine,
      max(p ** ((rlo + rhi) / 2 - 1)) / sum(p ** ((rlo + rhi) / 2)) > {mixing.MAX_REPEATS} AS often
    FROM halves CROSS JOIN shares WHERE i < {mixing.STEPS} GROUP BY i, lo, hi, rlo, rhi
  )
), chosen AS (
  SELECT greatest(
    CASE WHEN (SELECT -sum(p * ln(p)) >= any_value(target) FROM shares) THEN 1.0 ELSE lo END,
    CASE WHEN (SELECT max(1 / p) / count(*) <= {mixing.MAX_REPEATS} FROM shares) THEN 0.0 ELSE rhi END) AS alpha
  FROM halves WHERE i = {mixing.STEPS}
), weights AS (
  SELECT name, none, "all", total, CASE WHEN "all" > 0 THEN ("all" / total::DOUBLE) ** alpha / z ELSE 0.0 END AS weight
  FROM totals CROSS JOIN (SELECT alpha, sum(p ** alpha) AS z FROM chosen CROSS JOIN shares GROUP BY alpha)
    CROSS JOIN (SELECT sum("all") AS total FROM totals)
), budgets AS (
  SELECT *, CASE WHEN "all" > 0 THEN floor(weight * total / "all") ELSE 1 END::INT AS whole,
    weight * total - CASE WHEN "all" > 0 THEN floor(weight * total / "all") ELSE 1 END * "all" AS rest FROM weights
), ranked AS (
  SELECT *, row_number() OVER w AS block_rank, sum(n) OVER w - n AS before FROM (
    SELECT *, unnest(range(whole + 1))::INT AS epoch FROM blocks JOIN budgets USING (name, none))
  WINDOW w AS (PARTITION BY name, none, epoch
    ORDER BY md5('{mixing.SEED}:' || epoch || ':' || name || ':' || block), block)
)
SELECT doc_id, source, n_tokens, epoch, block, block_rank::INT AS block_rank, round(weight, 9) AS weight
FROM sizes JOIN ranked USING (block)
WHERE coalesce(source, '') = name AND (source IS NULL) = none
  AND (epoch < whole OR ("all" > 0 AND before + n / 2.0 <= rest))
"""

_WORD, _BLANK = "[^\\x20\\x09-\\x0D]", "[\\x20\\x09-\\x0D]"
#: the rules of op2 over the counts of a text, each a vote of 1, -1 or 0
_OP2_VOTES = (
    "CASE WHEN n_symbols / greatest(word_chars, 1) >= 0.04 THEN -1 ELSE 0 END",
    "CASE WHEN n_dup_lines / greatest(n_lines, 1) >= 0.3 THEN -1 ELSE 0 END",
    "CASE WHEN n_upper / greatest(n_letters, 1) >= 0.5 THEN -1 ELSE 0 END",
    "CASE WHEN n_words >= 40 AND n_distinct / greatest(n_words, 1) <= 0.15 THEN -1 ELSE 0 END",
    "CASE WHEN n_marked / greatest(n_words, 1) >= 0.3 THEN -1 ELSE 0 END",
    "CASE WHEN n_lone / greatest(n_words, 1) >= 0.15 THEN -1 ELSE 0 END",
    "CASE WHEN n_letters / greatest(word_chars, 1) <= 0.75 THEN -1 WHEN n_letters / greatest(word_chars, 1) >= 0.9 THEN 1 ELSE 0 END",
    "CASE WHEN n_repeat_words / greatest(n_words, 1) >= 0.2 THEN -1 WHEN n_repeat_words / greatest(n_words, 1) <= 0.05 AND n_words >= 40 THEN 1 ELSE 0 END",
    "CASE WHEN word_chars / greatest(n_words, 1) < 2 OR word_chars / greatest(n_words, 1) > 20 THEN -1 "
    "WHEN word_chars / greatest(n_words, 1) BETWEEN 3 AND 10 THEN 1 ELSE 0 END",
    "CASE WHEN n_words < 10 THEN -1 WHEN n_words >= 50 THEN 1 ELSE 0 END",
)
_NEXT = " || ' ' || ".join(["x", *(f"lead(x, {j}) OVER w" for j in range(1, quality_rules.WINDOW))])

OP2_SQL = f"""
WITH RECURSIVE d AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '{_WORD}+') AS l,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '{_WORD}')) AS lines FROM documents
), windows AS (
  SELECT r, i, {_NEXT} AS k FROM (SELECT r, unnest(l) AS x, unnest(range(len(l))) AS i FROM d) WINDOW w AS (PARTITION BY r ORDER BY i)
), again AS (
  SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, k) AS c FROM windows WHERE k IS NOT NULL) WHERE c > 1
), repeats AS (SELECT r, count(DISTINCT i + j) AS n FROM again CROSS JOIN range({quality_rules.WINDOW}) t(j) GROUP BY r),
counts AS (
  SELECT r, doc_id, len(l)::BIGINT AS n_words, length(regexp_replace(t, '{_BLANK}', '', 'g'))::BIGINT AS word_chars,
    length(regexp_replace(t, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols, (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
    coalesce(n, 0)::BIGINT AS n_repeat_words, len(lines) AS n_lines, length(regexp_replace(t, '[^A-Z]', '', 'g')) AS n_upper,
    length(regexp_replace(t, '[\\x00-@\\[-`{{-\\x7F]', '', 'g')) AS n_letters, len(list_distinct(l)) AS n_distinct,
    len(list_filter(l, lambda x: regexp_matches(x, '[!?#*$%&|<>=~^]'))) AS n_marked,
    len(list_filter(l, lambda x: regexp_matches(x, '^[!?#*$%&|<>=~^]$'))) AS n_lone
  FROM d LEFT JOIN repeats USING (r)
), voted AS (SELECT *, [{", ".join(_OP2_VOTES)}] AS votes FROM counts),
patterns AS (SELECT votes, count(*)::DOUBLE AS n FROM voted GROUP BY votes),
ballots AS (SELECT votes, n, unnest(votes) AS v, unnest(range(len(votes))) AS k FROM patterns),
em AS (
  SELECT 0 AS round, votes, 1 / (1 + exp(-(len(list_filter(votes, lambda v: v = 1)) - 2 * len(list_filter(votes, lambda v: v = -1)) - 2 + ln(4)))) AS g
  FROM patterns
  UNION ALL
  SELECT round + 1, votes, 1 / (1 + exp(-least(greatest(ln(any_value(prior) / (1 - any_value(prior))) + sum(e), -60), 60))) FROM (
    SELECT round, votes, (sum(n * g) OVER (PARTITION BY k) + 2) / (sum(n) OVER (PARTITION BY k) + 4) AS prior,
      ln((sum(n * g) OVER (PARTITION BY k, v) + 0.5) / (sum(n * g) OVER (PARTITION BY k) + 1.5))
        - ln((sum(n * (1 - g)) OVER (PARTITION BY k, v) + 0.5) / (sum(n * (1 - g)) OVER (PARTITION BY k) + 1.5)) AS e
    FROM em JOIN ballots USING (votes) WHERE round < {quality_rules.ROUNDS}
  ) GROUP BY round, votes
), verdicts AS (
  SELECT *, n_words < {quality_rules.MIN_WORDS} OR 100 * n_repeat_words > {quality_rules.REPEAT_PERCENT} * n_words AS base_failed
  FROM voted JOIN em USING (votes) WHERE round = {quality_rules.ROUNDS}
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND g >= 0.5 AS kept,
  round(g, 6) AS quality_probability FROM verdicts
"""


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _op8_sql() -> str:
    """Matches of each kind with their positions, and entropies counted anew for every window."""
    kinds = (
        (0, secret_scan.ASSIGN, 2), (1, secret_scan.ACCESS, 0), (2, "[0-9a-f]+", 0), (3, "[A-Za-z0-9+/_=-]{20,}", 0),
    )
    found = " UNION ALL ".join(
        f"""SELECT r, {kind} AS kind, unnest(range(len(regexp_extract_all(t, {_quoted(pattern)})))) AS i,
        unnest(regexp_extract_all(t, {_quoted(pattern)}, 0)) AS m, unnest(regexp_extract_all(t, {_quoted(pattern)},
        {group})) AS g, unnest(string_split_regex(t, {_quoted(pattern)})) AS piece FROM d"""
        for kind, pattern, group in kinds
    )
    allowed = " OR ".join(f"regexp_matches(m, {_quoted(a)})" for a in secret_scan.ALLOW)
    names = ", ".join(f"({i}, '{name}')" for i, name in enumerate(secret_scan.KINDS))
    w = secret_scan.WINDOW
    return f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
found AS (SELECT * FROM ({found}) WHERE m IS NOT NULL),
placed AS (
  SELECT *, (sum(length(piece) + length(m)) OVER (PARTITION BY r, kind ORDER BY i))::BIGINT AS stop FROM found
), base AS (
  SELECT r, kind, stop - length(m) AS start, stop FROM placed
  WHERE kind = 0 AND length(g) >= {secret_scan.ASSIGN_LEAST} OR kind = 1 AND length(m) >= {secret_scan.ACCESS_LEAST}
    OR kind = 2 AND length(m) >= 24
), windows AS (
  SELECT r, stop, m, unnest(range(length(m) - {w - 1})) AS q FROM placed
  WHERE kind = 3 AND regexp_matches(m, '[0-9]') AND NOT ({allowed})
), bits AS (
  SELECT r, stop, m, q, substr(m, q::INT + 1, {w}) AS win,
    CASE WHEN regexp_matches(m, '^([0-9a-f]+|[0-9A-F]+)$') THEN {secret_scan.HEX_BITS}
      ELSE {secret_scan.BASE64_BITS} END AS least FROM windows
), hot AS (
  SELECT r, stop, m, q, list_sum(list_transform(list_distinct(string_split(win, '')),
    lambda c: -({w} - length(replace(win, c, ''))) / {w}.0 * log2(({w} - length(replace(win, c, ''))) / {w}.0))) AS h,
    least FROM bits
), spans AS (
  SELECT * FROM base UNION ALL
  SELECT r, 3, min(stop - length(m) + q), max(stop - length(m) + q + {w}) FROM hot WHERE h >= least GROUP BY r, stop
), named AS (
  SELECT r, kind, start, name || ':' || start || ':' || stop AS span
  FROM spans JOIN (VALUES {names}) n(kind, name) USING (kind)
), texts AS (
  SELECT r, count(*) FILTER (kind = 0) AS a, count(*) FILTER (kind = 1) AS b, count(*) FILTER (kind = 2) AS c,
    string_agg(span, ',' ORDER BY start, kind) FILTER (kind < 3) AS base,
    string_agg(span, ',' ORDER BY start, kind) AS every FROM named GROUP BY r
)
SELECT doc_id, coalesce(a, 0)::BIGINT AS n_assign, coalesce(b, 0)::BIGINT AS n_access, coalesce(c, 0)::BIGINT AS n_hex,
  sha256(coalesce(base, '')) AS base_sha256, coalesce(every, '') AS spans
FROM d LEFT JOIN texts USING (r)
"""


def _op13_sql() -> str:
    """The rounds one after the other, each from the codebooks before it; distance * entries + index ranks entries and ties."""
    n, k = vector_codes.PARTS, vector_codes.ENTRIES
    steps = []
    for i in range(vector_codes.ROUNDS + 1):
        steps.append(f"""a{i} AS (
  SELECT r, p, min(list_sum(list_transform(list_zip(x, e), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT * {k} + k) AS best
  FROM pieces JOIN c{i} USING (p) GROUP BY r, p)""")
        if i < vector_codes.ROUNDS:
            steps.append(f"""m{i} AS (
  SELECT p, k, list(floor(s / n::DOUBLE)::BIGINT ORDER BY j) AS m FROM (
    SELECT p, best % {k} AS k, j, sum(y)::DOUBLE AS s, count(*) AS n FROM (
      SELECT p, best, unnest(x) AS y, unnest(range(len(x))) AS j FROM a{i} JOIN pieces USING (r, p)) GROUP BY 1, 2, 3) GROUP BY p, k
), c{i + 1} AS (SELECT p, k, coalesce(m, e) AS e FROM c{i} LEFT JOIN m{i} USING (p, k))""")
    last = vector_codes.ROUNDS
    return f"""
WITH kept AS (
  SELECT row_number() OVER (ORDER BY vec_id NULLS LAST, embedding) AS r, vec_id, label,
    list_transform(embedding, lambda x: floor({vector_codes.SCALE} * x::DOUBLE)::BIGINT) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), pieces AS (
  SELECT r, p, v[(p * len(v) // {n} + 1)::INT : ((p + 1) * len(v) // {n})::INT] AS x FROM kept CROSS JOIN range({n}) t(p)
), c0 AS (SELECT p, r - 1 AS k, x AS e FROM pieces WHERE r <= {k}),
{", ".join(steps)}
, coded AS (
  SELECT r, string_agg(lpad(printf('%x', best % {k}), 2, '0'), '' ORDER BY p) AS code, sum(best // {k})::BIGINT AS error FROM a{last} GROUP BY r
), books AS (SELECT sha256(string_agg(array_to_string(e, ','), ',' ORDER BY p, k)) AS codebooks_sha256 FROM c{last})
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, codebooks_sha256
FROM kept JOIN coded USING (r) CROSS JOIN books
"""


ORACLE_SQL: dict[str, str] = {"op2_quality_rules": OP2_SQL, "op3_ngram_join": OP3_SQL, "op6_mixing": OP6_SQL, "op7_warc_bundles": OP7_SQL, "op8_secret_scan": _op8_sql(), "op13_vector_codes": _op13_sql()}
