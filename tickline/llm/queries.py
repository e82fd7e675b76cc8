"""Registered queries of the text operators and their DuckDB oracles."""

from __future__ import annotations

from collections.abc import Callable

import corpus_pipeline
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickline.llm import (
    block_names, bpe, chat, class_lm, decontaminate, filter_audit, langid, mixing, parity_join, quality_nbsvm, vector_codes, warc,
    weak_rules,
)
from tickline.llm.common import held_out, setup, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def register(name: str, sql: str | None = None):
    def deco(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            setup(spark)
            return fn(spark, sf_dir)
        run.__name__, run.__doc__ = fn.__name__, fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return run
    return deco


@register("op1_bpe")
def op1_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token count and digests of the encoded and decoded text, per document."""
    docs = table(spark, sf_dir, "documents")
    return bpe.round_trip(docs, "doc_id", "text", RANKS, public_tokenizers.PATTERN)


@register("op2_quality")
def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document, learned off the held-out fold."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    hold = held_out(F.col("doc_id"), 4, 2)
    model = quality_nbsvm.fit(docs.where(~hold), table(spark, sf_dir, "labels"))
    return quality_nbsvm.score(docs, model).select(
        "doc_id", hold.alias("held_out"), "score", F.when(F.col("score") >= 0.7, 1).otherwise(0).alias("predicted"))


@register("op3_mixing")
def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words the mix takes of every document."""
    return mixing.mix(table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"), "copies", "rate")


OP4_SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
     q AS (SELECT page_id, strlen(html) AS payload_bytes, sha1(html) AS payload_digest, max(page_id) OVER (PARTITION BY html) AS last FROM p)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 1000 AND page_id < last THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 1000 AND page_id < last THEN last END AS refers_to
FROM q
"""


@register("op4_warc", OP4_SQL)
def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write the pages to WARC archives, read the archives back."""
    manifest = warc.write(warc.plan(table(spark, sf_dir, "pages")), warc.archive_folder(spark))
    return warc.read(manifest).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@register("op5_weak_rules")
def op5_weak_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base counts and the weakly supervised verdict for every document."""
    return weak_rules.judge(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "quality")


@register("op6_parity_join")
def op6_parity_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Set size and component of every document (3-word shingles, similarity 0.9)."""
    return parity_join.similar_classes(table(spark, sf_dir, "documents"))


OP7_SQL = """
WITH answers AS (
  SELECT conv_id, turn, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC, coalesce(text, '') DESC) AS k
  FROM conversations WHERE role = 'assistant' AND turn IS NOT NULL AND conv_id IS NOT NULL),
last AS (SELECT conv_id, turn, text, row_number() OVER (ORDER BY conv_id) - 1 AS r, count(*) OVER () AS n FROM answers WHERE k = 1),
swaps AS (SELECT a.conv_id, a.turn AS last_turn, b.text AS other FROM last a JOIN last b ON b.r = CASE WHEN xor(a.r, 1) < a.n THEN xor(a.r, 1) ELSE 0 END),
pairs AS (SELECT DISTINCT c.conv_id, s.last_turn, s.other FROM conversations c LEFT JOIN swaps s USING (conv_id) WHERE c.conv_id IS NOT NULL),
turns AS (
  SELECT c.conv_id, s.side, coalesce(c.role, 'unknown') AS role, c.turn,
         CASE WHEN s.side = 'rejected' AND c.turn = p.last_turn AND c.role = 'assistant' THEN p.other ELSE coalesce(c.text, '') END AS text
  FROM conversations c JOIN pairs p USING (conv_id) CROSS JOIN (VALUES ('chosen'), ('rejected')) s(side)),
numbered AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id, side ORDER BY turn NULLS FIRST, role, text) AS i,
         '<|im_start|>' || role || chr(10) || text || '<|im_end|>' || chr(10) AS shown FROM turns),
same AS (
  SELECT conv_id, least(max(i) FILTER (side = 'chosen'), max(i) FILTER (side = 'rejected')) AS n FROM numbered GROUP BY conv_id),
prefix AS (
  SELECT s.conv_id, coalesce(min(a.i) - 1, any_value(s.n)) AS n_prompt_turns
  FROM same s LEFT JOIN (SELECT a.conv_id, a.i FROM numbered a JOIN numbered b ON a.conv_id = b.conv_id AND a.i = b.i AND a.side = 'chosen' AND b.side = 'rejected'
                         WHERE a.role <> b.role OR a.text <> b.text) a USING (conv_id) GROUP BY s.conv_id),
placed AS (
  SELECT x.*, p.n_prompt_turns, sum(length(shown)) OVER (PARTITION BY x.conv_id, side, i > p.n_prompt_turns ORDER BY i) - length(shown) AS before
  FROM numbered x JOIN prefix p USING (conv_id)),
spans AS (
  SELECT *, (before + length(role) + 13)::BIGINT AS s, (before + length(role) + 13 + length(text) + 10)::BIGINT AS e FROM placed)
SELECT conv_id AS pair_id, any_value(n_prompt_turns)::INTEGER AS n_prompt_turns,
       coalesce(string_agg(shown, '' ORDER BY i) FILTER (side = 'chosen' AND i <= n_prompt_turns), '') AS prompt,
       coalesce(string_agg(shown, '' ORDER BY i) FILTER (side = 'chosen' AND i > n_prompt_turns), '') AS chosen,
       coalesce(string_agg(s || '-' || e, ',' ORDER BY i) FILTER (side = 'chosen' AND i > n_prompt_turns AND role = 'assistant'), '') AS chosen_spans,
       coalesce(string_agg(shown, '' ORDER BY i) FILTER (side = 'rejected' AND i > n_prompt_turns), '') AS rejected,
       coalesce(string_agg(s || '-' || e, ',' ORDER BY i) FILTER (side = 'rejected' AND i > n_prompt_turns AND role = 'assistant'), '') AS rejected_spans
FROM spans GROUP BY conv_id
"""


@register("op7_preference", OP7_SQL)
def op7_preference(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prompt and masked completions: each conversation against itself with
    another one's last answer."""
    pairs = chat.preference_pairs(chat.swapped_answers(table(spark, sf_dir, "conversations")))
    return pairs.withColumns({c: chat.spans_text(F.col(c)) for c in ("chosen_spans", "rejected_spans")})


@register("op8_class_lm")
def op8_class_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unigram and class-based log10 probability of every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    hold = held_out(F.col("doc_id"), 10, 0)
    return class_lm.score(docs, class_lm.fit(docs.where(~hold))).select(
        "doc_id", hold.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


OP9_SQL = """
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id = max(doc_id) OVER w AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW w AS (PARTITION BY coalesce(text, ''))
"""


@register("op9_block_names", OP9_SQL)
def op9_block_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The row that stays for every document, by block naming."""
    return block_names.exact_groups(table(spark, sf_dir, "documents"))


@register("op10_langid")
def op10_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, learned off the held-out fold."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    hold = held_out(F.col("doc_id"), 4, 2)
    model = langid.fit(docs.where(~hold))
    return langid.predict(docs, model).select("doc_id", hold.alias("held_out"), "lang_pred", "score")


OP11_SQL = """
WITH d AS (SELECT doc_id, coalesce(text, '') AS text, coalesce(lang, '') AS part FROM documents),
w AS (SELECT *, regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+') AS words FROM d),
f AS (
  SELECT doc_id, part, (len(words) < 100)::INT AS a, (100 * len(list_distinct(words)) < 80 * len(words))::INT AS b,
         (100 * (length(text) - length(regexp_replace(text, '[A-Z]', '', 'g'))) > 10 * length(text))::INT AS c,
         regexp_matches(text, '[#$%&*|]')::INT AS d, coalesce(doc_id > min(doc_id) OVER (PARTITION BY text), FALSE)::INT AS e FROM w),
marks AS (SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS toxic FROM labels GROUP BY doc_id),
cells AS (
  SELECT part, [a, b, c, d, e] AS fails, count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS toxic
  FROM f LEFT JOIN marks USING (doc_id) GROUP BY ALL),
i AS (SELECT unnest(range(1, 6)) AS x),
orders AS (
  SELECT [p.x, q.x, r.x, s.x, t.x] AS o FROM i p, i q, i r, i s, i t WHERE len(list_distinct([p.x, q.x, r.x, s.x, t.x])) = 5),
steps AS (SELECT o, x AS step, o[x] AS k FROM orders, i),
seen AS (
  SELECT part, o, step, k, n, good, toxic, fails[k] = 1 AS bad, list_sum(fails) AS n_bad,
         coalesce(list_sum(list_transform(o[1:step - 1], lambda j: fails[j])), 0) > 0 AS earlier FROM cells, steps),
report AS (
  SELECT part, o, step, k, coalesce(sum(n) FILTER (NOT bad AND NOT earlier), 0) AS kept,
         coalesce(sum(n) FILTER (bad AND NOT earlier), 0) AS removed, coalesce(sum(n) FILTER (bad AND earlier), 0) AS redundant,
         coalesce(sum(n) FILTER (bad AND n_bad = 1), 0) AS unique_fails,
         coalesce(sum(good) FILTER (bad AND NOT earlier), 0) AS good_lost, coalesce(sum(toxic) FILTER (bad AND NOT earlier), 0) AS toxic_lost
  FROM seen GROUP BY part, o, step, k)
SELECT part, array_to_string(list_transform(o, lambda j: chr((64 + j)::INT)), '') AS filter_order, step::INT AS step, kept::BIGINT AS kept,
       removed::BIGINT AS removed, redundant::BIGINT AS redundant, unique_fails::BIGINT AS unique_fails, good_lost::BIGINT AS good_lost,
       toxic_lost::BIGINT AS toxic_lost, (sum(removed) OVER (PARTITION BY part, k))::BIGINT AS shapley
FROM report
"""


@register("op11_filter_audit", OP11_SQL)
def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What five filters remove, in every order and at every step, by language."""
    return filter_audit.document_audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


OP12_SQL = """
WITH k AS (
  SELECT vec_id, label, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS q FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
p AS (SELECT vec_id, part, q[part * (len(q) // 16) + 1:(part + 1) * (len(q) // 16)] AS v FROM k, range(16) r(part)),
c0 AS (
  SELECT part, row_number() OVER (PARTITION BY part ORDER BY vec_id) - 1 AS e, v FROM p
  WHERE vec_id IN (SELECT vec_id FROM k ORDER BY vec_id LIMIT 64)),
a0 AS (SELECT vec_id, p.part, arg_min(e, apart * 64 + e) AS e, min(apart) AS apart FROM (
  SELECT p.vec_id, p.part, c.e, list_sum(list_transform(list_zip(p.v, c.v), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS apart
  FROM p JOIN c0 c ON c.part = p.part) p GROUP BY vec_id, p.part),
s0 AS (SELECT a.part, a.e, i, sum(p.v[i])::BIGINT AS s, count(*) AS n FROM a0 a JOIN p USING (vec_id, part), range(1, len(p.v) + 1) r(i) GROUP BY ALL),
m0 AS (SELECT part, e, list(((s - (s % n + n) % n) // n)::BIGINT ORDER BY i) AS v FROM s0 GROUP BY ALL),
c1 AS (SELECT part, e, coalesce(m.v, c.v) AS v FROM c0 c LEFT JOIN m0 m USING (part, e)),
a1 AS (SELECT vec_id, p.part, arg_min(e, apart * 64 + e) AS e, min(apart) AS apart FROM (
  SELECT p.vec_id, p.part, c.e, list_sum(list_transform(list_zip(p.v, c.v), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS apart
  FROM p JOIN c1 c ON c.part = p.part) p GROUP BY vec_id, p.part),
s1 AS (SELECT a.part, a.e, i, sum(p.v[i])::BIGINT AS s, count(*) AS n FROM a1 a JOIN p USING (vec_id, part), range(1, len(p.v) + 1) r(i) GROUP BY ALL),
m1 AS (SELECT part, e, list(((s - (s % n + n) % n) // n)::BIGINT ORDER BY i) AS v FROM s1 GROUP BY ALL),
c2 AS (SELECT part, e, coalesce(m.v, c.v) AS v FROM c1 c LEFT JOIN m1 m USING (part, e)),
a2 AS (SELECT vec_id, p.part, arg_min(e, apart * 64 + e) AS e, min(apart) AS apart FROM (
  SELECT p.vec_id, p.part, c.e, list_sum(list_transform(list_zip(p.v, c.v), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS apart
  FROM p JOIN c2 c ON c.part = p.part) p GROUP BY vec_id, p.part),
coded AS (SELECT vec_id, string_agg(printf('%02x', e), '' ORDER BY part) AS code, sum(apart)::BIGINT AS error FROM a2 GROUP BY vec_id),
book AS (SELECT sha256(string_agg(array_to_string(v, ','), ',' ORDER BY part, e)) AS codebooks_sha256 FROM c2)
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, codebooks_sha256
FROM coded JOIN k USING (vec_id), book
"""


@register("op12_vector_codes", OP12_SQL)
def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Product codes of all embeddings after two Lloyd rounds over cover trees."""
    return vector_codes.compress(table(spark, sf_dir, "embeddings")).drop("label")


OP13_SQL = """
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM documents),
b AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                     '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM benchmark),
win AS (
  SELECT DISTINCT item_id, array_to_string(w[i:i + n - 1], ' ') AS passage, n
  FROM (SELECT item_id, w, least(len(w), 10) AS n, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS i FROM b WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT n FROM win),
runs AS (
  SELECT doc_id, i, n, array_to_string(w[i:i + n - 1], ' ') AS passage
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, sizes WHERE len(w) >= n)),
hits AS (SELECT r.doc_id, r.i, r.n, win.item_id FROM runs r JOIN win USING (passage, n)),
words AS (SELECT doc_id, count(DISTINCT k) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS k FROM hits) GROUP BY doc_id),
items AS (SELECT doc_id, count(DISTINCT item_id) AS n_items, string_agg(DISTINCT item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS ids FROM hits GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id)
"""


@register("op13_decontaminate", OP13_SQL)
def op13_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every document inside a benchmark window of ten words, and the items."""
    leaks = decontaminate.benchmark_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), keep=["doc_id"])
    return leaks.select("row.doc_id", "n_words", "n_hit", F.size("item_ids").cast("long").alias("n_items"),
                        F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


@register("pipeline", corpus_pipeline.ORACLE_SQL)
def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages of ``corpus_pipeline`` over ``documents``."""
    return corpus_pipeline.run(spark, sf_dir)
