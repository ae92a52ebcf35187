"""Registered queries over the training-data operators, and their oracle SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.chat import format_preferences
from tidemark.llm.jaccard import jaccard_components
from tidemark.llm.linededup import dedup_lines
from tidemark.llm.mainhtml import extract_main_text
from tidemark.llm.mixing import mix_sources
from tidemark.llm.packing import pack_sequences
from tidemark.llm.quality import STATISTICS, apply_quality_rules, fit_quality_rules, text_statistics
from tidemark.llm.repeats import remove_repeats
from tidemark.llm.shared import cut, table, word_count
from tidemark.llm.sharding import shard_groups
from tidemark.llm.tiff import text_media

SHARDS = 40

#: Character edits up to which a line counts as a copy of an earlier one, if it has so many characters; two edits make any short word of another.
LINE_EDITS, LINE_NEAR_CHARS = 2, 20


def op1_shard_best_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 40 shards of near equal bytes, equal texts together; a null text counts as no bytes (checksum 0)."""
    docs = table(spark, sf_dir, "documents").select(
        "doc_id",
        (F.coalesce(F.octet_length("text"), F.lit(0)) + 16).cast("long").alias("size"),
        F.coalesce(F.crc32("text"), F.lit(0)).cast("long").alias("text_crc32"),
        F.coalesce(F.md5("text"), F.lit("null")).alias("text_key"),
    )
    return shard_groups(docs, "text_key", "size", n_shards=SHARDS).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op2_pack_sequences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in sequences of at most 2048 tokens."""
    return pack_sequences(table(spark, sf_dir, "documents"), tokenizer_path())


def spans_text(spans: str) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["start"].cast("string"), s["end"].cast("string"))), ",")


def op3_preference_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation as chosen over its copy whose last assistant turn says what that of the following conv_id says."""
    turns = table(spark, sf_dir, "conversations").where("conv_id is not null").select("conv_id", "turn", "role", "text")
    lasts = turns.where("role = 'assistant'").groupBy("conv_id").agg(F.max(F.struct("turn", "text")).alias("last"))
    own = lasts.select("conv_id", F.col("last.turn").alias("last_turn"))
    other = lasts.select((F.col("conv_id") - 1).alias("conv_id"), F.col("last.text").alias("other_text"))
    replaced = F.coalesce(F.when((F.col("turn") == F.col("last_turn")) & (F.col("role") == "assistant"), F.col("other_text")), F.col("text"))
    rejected = turns.join(own, "conv_id", "left").join(other, "conv_id", "left").select("conv_id", F.lit(False).alias("is_chosen"), "turn", "role", replaced.alias("text"))
    pairs = format_preferences(turns.select("conv_id", F.lit(True).alias("is_chosen"), "turn", "role", "text").union(rejected).withColumnRenamed("conv_id", "pair_id"))
    return pairs.select("pair_id", "status", "n_common", "prompt", "chosen", "rejected", spans_text("chosen_spans").alias("chosen_spans"), spans_text("rejected_spans").alias("rejected_spans"))


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's lines, those removed, and a digest of what is left (of the empty text for null)."""
    docs = dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"), LINE_EDITS, LINE_NEAR_CHARS)
    return docs.select("doc_id", "n_lines", "n_removed", F.sha2(F.coalesce("kept", F.lit("")), 256).alias("kept_sha256"))


def base_failed() -> Column:
    """The fixed base of the quality rules: under 50 words, or more than half of them in repeated windows."""
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Statistics of every document, the base's verdict, and the verdict of the decision list learned from ``labels``."""
    statistics = cut(text_statistics(table(spark, sf_dir, "documents"), ["doc_id"]))
    rules = fit_quality_rules(statistics, table(spark, sf_dir, "labels"))
    return apply_quality_rules(statistics, rules, base_failed()).select("doc_id", *STATISTICS, "base_failed", "kept", "rule")


def op6_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents mixed by their sources' weights 1, 2, 3 in turn, at most 3 epochs of any source."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", word_count(F.col("text")).alias("size"))
    return mix_sources(docs).select("doc_id", "size", "source_size", "target", "taken")


def op7_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page."""
    return extract_main_text(table(spark, sf_dir, "pages"))


def op8_remove_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the words of 20-word windows that also start earlier; a digest of what is left."""
    docs = remove_repeats(table(spark, sf_dir, "documents"), 20)
    return docs.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op9_text_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's bytes as the samples of a TIFF file, stored, read back and described."""
    return text_media(table(spark, sf_dir, "documents"))


def op10_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's component by links of 0.9 or more between sets of 3-word shingles."""
    return jaccard_components(table(spark, sf_dir, "documents"), width=3, num=90, den=100)


OP6_SQL = r"""
WITH docs AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
         md5('17:' || coalesce(doc_id::VARCHAR, 'null')) AS h
  FROM documents),
sources AS (
  SELECT source, sum(size)::BIGINT AS source_size, ((row_number() OVER (ORDER BY source ASC NULLS LAST) - 1) % 3 + 1)::BIGINT AS weight
  FROM docs GROUP BY source),
filling AS (
  SELECT *, 3 * source_size AS cap, (sum(source_size) OVER ())::BIGINT AS total,
    (sum(source_size) OVER () - coalesce(sum(3 * source_size) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::BIGINT AS rest,
    (sum(weight) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))::BIGINT AS rest_weight
  FROM sources WINDOW o AS (ORDER BY (3 * source_size)::DOUBLE / weight, source ASC NULLS LAST)),
stopped AS (
  SELECT *, min(CASE WHEN cap * rest_weight <= rest * weight THEN 1 ELSE 0 END)
    OVER (ORDER BY cap::DOUBLE / weight, source ASC NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) = 1 AS full_up
  FROM filling),
levels AS (
  SELECT source, source_size,
    CASE WHEN full_up THEN cap::DOUBLE
         ELSE (weight * (total - coalesce(sum(cap) FILTER (full_up) OVER (), 0)))::DOUBLE / (sum(weight) FILTER (NOT full_up) OVER ())::DOUBLE END AS target
  FROM stopped),
ordered AS (
  SELECT d.doc_id, d.size, l.source_size, l.target,
    CASE WHEN l.source_size > 0 THEN floor(l.target / l.source_size) ELSE 0 END AS whole,
    coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY h, doc_id, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM docs d JOIN levels l ON d.source IS NOT DISTINCT FROM l.source)
SELECT doc_id, size, source_size, target,
  ((whole + CASE WHEN 2 * (target - whole * source_size - before) >= size THEN 1 ELSE 0 END) * size)::BIGINT AS taken
FROM ordered
"""

# Two lines are within 2 edits if, without what they have in common at both ends, an edit at the front and one at the back (each a change, a
# deletion or an insertion) leave the same. Pairs that this looks at share one of three parts, which two edits can't all touch.
OP4_SQL = r"""
WITH numbered AS (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS line_no FROM documents),
lines AS (SELECT * FROM numbered WHERE regexp_matches(line, '[^\x20\x09-\x0D]')),
firsts AS (SELECT line, length(line) AS n, min({'d': doc_id, 'l': line_no}) AS place FROM lines GROUP BY line),
cuts AS (
  SELECT line, n, place, n - gap AS m, gap, part, shift, substr(line, (n - gap) * part // 3 + 1 + shift, (n - gap) * (part + 1) // 3 - (n - gap) * part // 3) AS piece
  FROM firsts, range(0, 3) g(gap), range(0, 3) p(part), range(-1, 3) s(shift)
  WHERE n >= 20 AND n - gap >= 20 AND ((part = 0 AND shift = 0) OR (part = 1 AND abs(shift) + abs(gap - shift) <= 2) OR (part = 2 AND shift = gap))),
pairs AS (
  SELECT DISTINCT least(x.place, y.place) <> x.place AS x_later, x.line AS a, y.line AS b, x.n AS an, y.n AS bn
  FROM cuts x JOIN cuts y ON x.gap = 0 AND x.shift = 0 AND x.m = y.m AND x.part = y.part AND x.piece = y.piece AND x.line <> y.line),
fronts AS (
  SELECT *, len(list_filter(range(1, least(an, bn) + 1), lambda i: left(a, i) = left(b, i))) AS p FROM pairs),
backs AS (
  SELECT *, len(list_filter(range(1, least(an, bn) - p + 1), lambda i: right(a, i) = right(b, i))) AS s FROM fronts),
middles AS (
  SELECT *, substr(a, p + 1, an - p - s) AS x, substr(b, p + 1, bn - p - s) AS y, an - p - s AS xn, bn - p - s AS yn FROM backs),
edits(e, f) AS (VALUES (1, 1), (1, 0), (0, 1)),
near AS (
  SELECT DISTINCT CASE WHEN x_later THEN a ELSE b END AS line FROM middles, edits front, edits back
  WHERE greatest(xn, yn) <= 2 OR (xn - front.e - back.e = yn - front.f - back.f AND xn >= front.e + back.e
    AND substr(x, front.e + 1, xn - front.e - back.e) = substr(y, front.f + 1, yn - front.f - back.f))),
judged AS (
  SELECT l.doc_id, l.line_no, ({'d': l.doc_id, 'l': l.line_no} <> f.place OR n.line IS NOT NULL) AS gone
  FROM lines l JOIN firsts f ON f.line = l.line LEFT JOIN near n ON n.line = l.line),
kept AS (
  SELECT x.doc_id, string_agg(x.line, chr(10) ORDER BY x.line_no) AS kept
  FROM numbered x LEFT JOIN judged j ON j.doc_id = x.doc_id AND j.line_no = x.line_no
  WHERE NOT coalesce(j.gone, false) GROUP BY x.doc_id)
SELECT d.doc_id, coalesce(c.n_lines, 0)::BIGINT AS n_lines, coalesce(c.n_removed, 0)::BIGINT AS n_removed, sha256(coalesce(k.kept, '')) AS kept_sha256
FROM documents d LEFT JOIN kept k ON k.doc_id = d.doc_id
LEFT JOIN (SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_removed FROM judged GROUP BY doc_id) c ON c.doc_id = d.doc_id
"""


QUERIES = {
    "op1_shard_best_fit": op1_shard_best_fit,
    "op2_pack_sequences": op2_pack_sequences,
    "op3_preference_format": op3_preference_format,
    "op4_line_dedup": op4_line_dedup,
    "op5_quality_rules": op5_quality_rules,
    "op6_mix_sources": op6_mix_sources,
    "op7_main_text": op7_main_text,
    "op8_remove_repeats": op8_remove_repeats,
    "op9_text_media": op9_text_media,
    "op10_jaccard_join": op10_jaccard_join,
}

OP3_SQL = r"""
WITH lasts AS (SELECT conv_id, max({'t': turn, 'x': text}) AS last FROM conversations WHERE role = 'assistant' GROUP BY conv_id),
sides AS (
  SELECT conv_id AS pair_id, true AS is_chosen, turn, role, text FROM conversations WHERE conv_id IS NOT NULL
  UNION ALL SELECT c.conv_id, false, c.turn, c.role, coalesce(CASE WHEN c.turn = o.last.t AND c.role = 'assistant' THEN n.last.x END, c.text)
  FROM conversations c LEFT JOIN lasts o ON o.conv_id = c.conv_id LEFT JOIN lasts n ON n.conv_id = c.conv_id + 1 WHERE c.conv_id IS NOT NULL),
turns AS (SELECT pair_id, is_chosen, turn, coalesce(role, '') AS role, replace(coalesce(text, ''), '<|', '< |') AS text FROM sides),
numbered AS (
  SELECT *, row_number() OVER (PARTITION BY pair_id, is_chosen ORDER BY turn NULLS FIRST, role, text) AS i FROM turns),
matched AS (
  SELECT a.pair_id, a.i, a.role = b.role AND a.text = b.text AS same FROM numbered a JOIN numbered b ON a.pair_id = b.pair_id AND a.i = b.i AND a.is_chosen AND NOT b.is_chosen),
common AS (SELECT pair_id, coalesce(min(i) FILTER (NOT same) - 1, max(i)) AS n FROM matched GROUP BY pair_id),
sized AS (
  SELECT n.*, coalesce(c.n, 0) AS n_common, '<|' || role || '|>' || chr(10) || text || '<|end|>' || chr(10) AS shown,
    length(role) + 5 AS head, length(text) + 7 AS body
  FROM numbered n LEFT JOIN common c ON c.pair_id = n.pair_id),
placed AS (
  SELECT *, coalesce(sum(head + body + 1) OVER (PARTITION BY pair_id, is_chosen, i > n_common ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS pos FROM sized),
whole AS (
  SELECT pair_id, is_chosen, max(i) AS turns, max(n_common)::INTEGER AS n_common,
    coalesce(string_agg(shown, '' ORDER BY i) FILTER (i <= n_common), '') AS prompt,
    coalesce(string_agg(shown, '' ORDER BY i) FILTER (i > n_common), '') AS rest,
    coalesce(string_agg((pos + head)::BIGINT || ':' || (pos + head + body)::BIGINT, ',' ORDER BY i) FILTER (i > n_common AND role = 'assistant'), '') AS spans
  FROM placed GROUP BY pair_id, is_chosen)
SELECT coalesce(a.pair_id, b.pair_id)::BIGINT AS pair_id,
  CASE WHEN a.pair_id IS NULL THEN 'no_chosen' WHEN b.pair_id IS NULL THEN 'no_rejected' WHEN a.rest = '' AND b.rest = '' THEN 'identical'
       WHEN a.rest = '' OR b.rest = '' THEN 'prefix' ELSE 'pair' END AS status,
  coalesce(a.n_common, b.n_common)::INTEGER AS n_common, coalesce(a.prompt, b.prompt) AS prompt, a.rest AS chosen, b.rest AS rejected, a.spans AS chosen_spans, b.spans AS rejected_spans
FROM (SELECT * FROM whole WHERE is_chosen) a FULL JOIN (SELECT * FROM whole WHERE NOT is_chosen) b ON a.pair_id = b.pair_id
"""


ORACLES = {"op3_preference_format": OP3_SQL, "op4_line_dedup": OP4_SQL, "op6_mix_sources": OP6_SQL}
