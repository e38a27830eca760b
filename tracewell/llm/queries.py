"""The registered queries of the numbered operators, with the SQL that checks them where SQL can."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tracewell.llm import (
    chat,
    decontam,
    importance,
    infill,
    lines,
    mixing,
    packing,
    quality,
    simhash,
    substrings,
    surrogates,
    vectors,
    wrappers,
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


#: The key of the registered query; a real corpus takes a secret one.
SURROGATE_KEY = "tracewell"


def op1_preference_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prompt and masked completions of a preference pair from every conversation."""
    turns = chat.turns_of(table(spark, sf_dir, "conversations"), "conv_id", "turn", "role", "text")
    found = chat.format_pairs(chat.derived_pairs(turns))
    spans = {f"{c}_mask": F.array_join(F.transform(f"{c}_mask", lambda s: F.concat_ws("-", s["begin"], s["end"])), ",") for c in ("chosen", "rejected")}
    return found.withColumns(spans).select(
        F.col("id").alias("conv_id"), "prefix_turns", "prompt", "chosen_text", "chosen_mask", "rejected_text", "rejected_mask"
    )


OP1_SQL = """
WITH numbered AS (
  SELECT conv_id, role, text, turn,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role NULLS FIRST, text NULLS FIRST) AS k
  FROM conversations
), facts AS (
  SELECT conv_id, count(*) AS n, max(k) FILTER (role = 'assistant') AS last_k,
         count(*) FILTER (role = 'assistant') AS n_answers,
         arg_min(text, k) FILTER (role = 'assistant') AS first_answer, arg_max(text, k) FILTER (role = 'assistant') AS last_answer
  FROM numbered GROUP BY conv_id
), pairs AS (
  SELECT *, CASE WHEN n_answers > 1 THEN first_answer ELSE '' END AS other,
         n_answers = 0 OR last_answer IS NOT DISTINCT FROM CASE WHEN n_answers > 1 THEN first_answer ELSE '' END AS equal
  FROM facts
), prompts AS (
  SELECT p.conv_id, count(k) AS prefix_turns,
         coalesce(string_agg('<|im_start|>' || coalesce(role, '') || chr(10) || coalesce(text, '') || '<|im_end|>' || chr(10), '' ORDER BY k), '') AS prompt
  FROM pairs p LEFT JOIN numbered n
    ON n.conv_id IS NOT DISTINCT FROM p.conv_id
   AND k <= CASE WHEN n_answers = 0 THEN p.n WHEN equal THEN last_k ELSE last_k - 1 END
  GROUP BY p.conv_id
), completions AS (
  SELECT conv_id,
         CASE WHEN equal THEN '' ELSE '<|im_start|>assistant' || chr(10) || coalesce(last_answer, '') || '<|im_end|>' || chr(10) END AS chosen_text,
         CASE WHEN equal THEN '' ELSE '<|im_start|>assistant' || chr(10) || coalesce(other, '') || '<|im_end|>' || chr(10) END AS rejected_text
  FROM pairs
)
SELECT conv_id, CAST(prefix_turns AS INTEGER) AS prefix_turns, prompt, chosen_text,
       CASE WHEN chosen_text = '' THEN '' ELSE '22-' || length(chosen_text) END AS chosen_mask, rejected_text,
       CASE WHEN rejected_text = '' THEN '' ELSE '22-' || length(rejected_text) END AS rejected_mask
FROM prompts JOIN completions USING (conv_id)
"""


def op2_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's text with surrogates for personal data."""
    found = surrogates.pseudonymise(table(spark, sf_dir, "documents"), SURROGATE_KEY)
    kinds = F.array_join(F.array_sort(F.array_distinct(F.transform("entities", lambda e: e["kind"]))), ",")
    return found.select(F.col("id").alias("doc_id"), "text", F.size("entities").alias("n_entities"), kinds.alias("kinds"))


def op3_simhash_balls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and near-duplicate group of every document."""
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select(
        F.col("id").alias("doc_id"),
        F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
        "component_id",
    )


def op4_fuzzy_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's text without the lines that near-equal ones stand for."""
    found = lines.dedupe_lines(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "text", F.size("lines_removed").alias("n_lines_removed"))


def op5_nn_descent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and near-duplicate group of every vector."""
    return vectors.near_vectors(table(spark, sf_dir, "embeddings")).withColumnRenamed("id", "vec_id")


def op6_latent_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every benchmark item found in every document."""
    found = decontam.matches(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        F.col("id").alias("doc_id"), F.col("item").alias("item_id"), "passages", "cosine", "lcs_share", "answer_share"
    )


def op7_suffix_sort(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What stays of every document when repeated 200-byte strings go."""
    found = substrings.remove_repeats(table(spark, sf_dir, "documents"))
    return found.select(
        F.col("id").alias("doc_id"),
        "n_bytes",
        (F.col("n_bytes") - F.octet_length("kept")).alias("n_removed"),
        F.size("starts").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


def op8_wrapper_inference(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page."""
    found = wrappers.extract(table(spark, sf_dir, "pages"))
    return found.select(F.col("id").alias("page_id"), "url", "text", F.length("text").cast("long").alias("n_chars"))


def op9_best_two_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's pieces in sequences of 2048 tokens."""
    packed = packing.pack_documents(table(spark, sf_dir, "documents"), tokenizer_path(), added_tokens=True)
    return packed.withColumnRenamed("id", "doc_id")


def op10_nbsvm_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document."""
    found = quality.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return found.withColumnRenamed("id", "doc_id")


def op11_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weight, score and rank of every document in a draw towards the benchmark's words."""
    found = importance.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(F.col("id").alias("doc_id"), "n_features", "weight", "score", "rank")


#: A byte's checksum is worked out from the rule of the CRC; words are few against texts, so each is hashed once.
OP11_SQL = r"""
WITH crc AS (
  SELECT list_transform(range(256), lambda b: list_reduce(list_prepend(b, range(8)),
         lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END)) AS steps
), texts AS (
  SELECT row_number() OVER () AS row, doc_id, true AS is_document, text FROM documents
  UNION ALL SELECT 0, NULL, false, text FROM benchmark
), words AS (
  SELECT row, is_document, unnest(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS word
  FROM texts
), counted AS (
  SELECT row, is_document, word, count(*) AS n FROM words GROUP BY ALL
), vocabulary AS (
  SELECT DISTINCT word, hex(encode(word)) AS hexed FROM counted
), hashed AS (
  SELECT word, xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT),
           list_transform(range(1, length(hexed), 2), lambda i: CAST('0x' || substr(hexed, i, 2) AS BIGINT))),
           lambda c, b: xor(c // 256, steps[xor(c % 256, b) + 1])), 4294967295) % 10000 AS bucket
  FROM vocabulary, crc
), buckets AS (
  SELECT bucket, coalesce(sum(n) FILTER (is_document), 0) AS s, coalesce(sum(n) FILTER (NOT is_document), 0) AS t
  FROM counted JOIN hashed USING (word) GROUP BY bucket
), totals AS (
  SELECT sum(s) AS s_all, sum(t) AS t_all FROM buckets
), gains AS (
  SELECT bucket, CAST(floor(1000 * ln(((t + 1.0::DOUBLE) * (s_all + 10000)) / ((s + 1.0::DOUBLE) * (t_all + 10000)))) AS BIGINT) AS gain
  FROM buckets, totals
), sums AS (
  SELECT row, sum(n) AS n_features, sum(n * gain) AS gained
  FROM counted JOIN hashed USING (word) JOIN gains USING (bucket) WHERE is_document GROUP BY row
), scored AS (
  SELECT doc_id, CAST(coalesce(n_features, 0) AS BIGINT) AS n_features,
         CAST(coalesce(floor(gained::DOUBLE / n_features), 0) AS BIGINT) AS weight,
         CAST('0x' || substr(sha256('2024:' || doc_id), 1, 8) AS BIGINT) AS h
  FROM texts LEFT JOIN sums USING (row) WHERE is_document
), noisy AS (
  SELECT *, weight + CAST(floor(-1000 * ln(-ln((h + 0.5::DOUBLE) / 4294967296))) AS BIGINT) AS score FROM scored
), placed AS (
  SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS place, count(*) OVER () AS n
  FROM noisy WHERE n_features >= 20
)
SELECT doc_id, n_features, weight, score, CASE WHEN place <= 10 * n // 100 THEN place END AS rank
FROM noisy LEFT JOIN placed USING (doc_id)
"""


def op12_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Form and digests of every document's rearrangement, and of the text rebuilt from it."""
    found = infill.transform(table(spark, sf_dir, "documents"))
    return found.select(
        F.col("id").alias("doc_id"),
        F.col("n_units").alias("n"),
        "form",
        "prefix_chars",
        "middle_chars",
        F.sha2("output", 256).alias("output_sha256"),
        F.sha2(infill.restored(F.col("output"), F.col("form")), 256).alias("restored_sha256"),
    )


OP12_SQL = r"""
WITH split AS (
  SELECT doc_id, coalesce(text, '') AS text, sha256('42:' || doc_id) AS h,
         regexp_extract_all(coalesce(text, ''), '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS units
  FROM documents
), drawn AS (
  SELECT *, len(units) AS n, CAST('0x' || substr(h, 1, 8) AS BIGINT) % (len(units) + 1) AS a,
         CAST('0x' || substr(h, 9, 8) AS BIGINT) % (len(units) + 1) AS b,
         CAST('0x' || substr(h, 17, 8) AS BIGINT) AS h3, CAST('0x' || substr(h, 25, 8) AS BIGINT) AS h4
  FROM split
), cut AS (
  SELECT *, coalesce(array_to_string(units[1:least(a, b)], ''), '') AS prefix,
         coalesce(array_to_string(units[least(a, b) + 1:greatest(a, b)], ''), '') AS middle,
         coalesce(array_to_string(units[greatest(a, b) + 1:], ''), '') AS suffix,
         CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= 50
              THEN 'plain' WHEN h4 % 100 < 80 THEN 'spm' ELSE 'psm' END AS form
  FROM drawn
)
SELECT doc_id, CAST(n AS BIGINT) AS n, form,
       CASE WHEN form <> 'plain' THEN CAST(length(prefix) AS BIGINT) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN CAST(length(middle) AS BIGINT) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
              ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
       sha256(text) AS restored_sha256
FROM cut
"""


def op13_entropy_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The words that a mix of all sources takes of every document."""
    found = mixing.mix(table(spark, sf_dir, "documents"))
    return found.select(F.col("id").alias("doc_id"), "size", "source_size", "target", "taken")


QUERIES = {
    "op1_preference_format": op1_preference_format,
    "op2_surrogates": op2_surrogates,
    "op3_simhash_balls": op3_simhash_balls,
    "op4_fuzzy_lines": op4_fuzzy_lines,
    "op5_nn_descent": op5_nn_descent,
    "op6_latent_decontamination": op6_latent_decontamination,
    "op7_suffix_sort": op7_suffix_sort,
    "op8_wrapper_inference": op8_wrapper_inference,
    "op9_best_two_fit": op9_best_two_fit,
    "op10_nbsvm_quality": op10_nbsvm_quality,
    "op11_importance_resampling": op11_importance_resampling,
    "op12_fill_in_middle": op12_fill_in_middle,
    "op13_entropy_mixing": op13_entropy_mixing,
}
ORACLE: dict[str, str] = {
    "op1_preference_format": OP1_SQL,
    "op11_importance_resampling": OP11_SQL,
    "op12_fill_in_middle": OP12_SQL,
}
