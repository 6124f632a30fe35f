"""Queries of the operators over the driver tables, and SQL for those that SQL can express."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assaycast.llm import (
    alignment, ann, chat_format, kneser_ney, minhash_dedup, mixing, packing, piece_sampling, quality_rules, substring_dedup, token_store,
    turn_repair, url_filters,
)
from assaycast.llm.shipping import ship
from assaycast.session import scratch_dir
from assaycast.sources.tables import cut_lineage

# ---- fixed values -----------------------------------------------------------------------
URL_RULES = [
    ("block", "net", "/"),
    ("allow", "example.net", "/en/"),
    ("block", "example.com", "/de/"),
    ("allow", "org", "/fr/"),
]
CONTROL_CHAT = "\\### Assistant: </turn> ok"
CONTROL_CHAT_ID = -7
# -----------------------------------------------------------------------------------------


def table(spark, sf: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(os.path.join(sf, f"{name}.parquet"))


def tokenizer_file(name: str) -> str:
    """A vocabulary file of the public tokenizers; the folder can be named by TOKENIZERS_DIR."""
    root = os.environ.get("TOKENIZERS_DIR")
    if root:
        return os.path.join(root, name)
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_quality_rules(spark, sf):
    return quality_rules.judge(table(spark, sf, "documents"), table(spark, sf, "labels"))


def op2_substring_dedup(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "text")
    return substring_dedup.remove_repeats(docs).select("row.doc_id", "n_words", "n_removed", "kept_sha256")


def op3_url_filters(spark, sf):
    return url_filters.filter_urls(table(spark, sf, "pages"), url_filters.rule_rows(spark, URL_RULES))


def op4_piece_sampling(spark, sf):
    return piece_sampling.sample_pieces(table(spark, sf, "documents"), tokenizer_file("piece_bpe_32k.model"))


def op5_token_output(spark, sf):
    path = scratch_dir(spark, "tokens")
    token_store.write_tokens(table(spark, sf, "documents"), path, tokenizer_file("byte_bpe_50k.json"))
    return token_store.read_tokens(spark, path).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op6_minhash_dedup(spark, sf):
    return minhash_dedup.near_duplicates(table(spark, sf, "documents"))


def op7_chat_formatting(spark, sf):
    turns = table(spark, sf, "conversations").select("conv_id", "turn", "role", "text")
    extra = spark.createDataFrame(
        [(CONTROL_CHAT_ID, i, role, CONTROL_CHAT) for i, role in enumerate(["user", "assistant"])], turns.schema
    )
    examples = chat_format.format_chats(turns.unionByName(extra))
    read = examples.select(
        "conv_id", "example", "n_turns", F.length("text").cast("long").alias("chars"),
        F.when(F.col("target_start").isNotNull(), chat_format.target_text(F.col("text"), F.col("target_start"), F.col("target_chars"))).alias("loss"),
        F.when(F.col("is_last"), chat_format.parse_turns(F.col("text"))).alias("turns"),
    )
    per = read.groupBy("conv_id").agg(
        F.max("n_turns").alias("n_turns"), F.sum("chars").alias("formatted_chars"),
        F.array_sort(F.collect_list(F.when(F.col("loss").isNotNull(), F.struct("example", "loss")))).alias("loss"),
        F.max_by("turns", "n_turns").alias("turns"),
    )
    loss = F.array_join(F.transform("loss", lambda x: x["loss"]), "")
    turns_text = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return per.select(
        "conv_id", "n_turns", F.sha2(turns_text, 256).alias("turns_sha256"), F.length(loss).cast("long").alias("loss_chars"),
        F.sha2(loss, 256).alias("loss_sha256"), "formatted_chars",
    )


def op8_source_mixing(spark, sf):
    return mixing.mix_sources(table(spark, sf, "documents"))


def op9_nearest_neighbours(spark, sf):
    vectors = table(spark, sf, "embeddings")
    return ann.nearest(vectors, vectors.where("vec_id % 50 = 0"))


def op10_quality_classifier(spark, sf):
    return kneser_ney.judge(table(spark, sf, "documents"), table(spark, sf, "labels"))


def damaged(turns: DataFrame) -> DataFrame:
    """Rows of conversations with one in twenty each dropped, emptied, robbed of its end marks, repeated, or given to the user."""
    cell = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(cell("conv_id"), F.lit(":"), cell("turn")).cast("binary")) % 20
    rows = turns.select("conv_id", "turn", cell("role").alias("role"), cell("text").alias("text"), kind.alias("kind")).where("kind <> 0")
    text = F.when(F.col("kind") == 1, F.lit("")).when(F.col("kind") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    role = F.when(F.col("kind") == 4, F.lit("user")).otherwise(F.col("role"))
    times = F.when(F.col("kind") == 3, 2).otherwise(1)
    rows = rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), F.explode(F.array_repeat(F.lit(0), times)).alias("again"))
    return rows.drop("again")


def repair_report(turns: DataFrame) -> DataFrame:
    """Faults, cheapest edits and digest of the repaired rows of every conversation of ``turns``, after ``damaged``."""
    rows = damaged(turns)
    found = cut_lineage(turn_repair.audits(rows), "audits")
    digests = turn_repair.repaired(rows, found, digest=True).select(F.col("conv_id").alias("d_id"), "sha256")
    gaps = rows.groupBy("conv_id").agg((F.max("turn") - F.min("turn") + 1 - F.countDistinct("turn")).alias("gaps"))
    gaps = gaps.select(F.col("conv_id").alias("g_id"), "gaps")
    found = found.withColumnRenamed("conv_id", "f_id")
    every = turns.select("conv_id").distinct()
    met = every
    for side, key in ((gaps, "g_id"), (found, "f_id"), (digests, "d_id")):
        met = met.join(side, F.col("conv_id").eqNullSafe(F.col(key)), "left")
    number = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c)
    return met.select(
        "conv_id", *map(number, ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]),
        F.coalesce(F.array_join("parts", ""), F.lit("")).alias("audit"), F.coalesce("sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"),
    )


def op11_turn_repair(spark, sf):
    return repair_report(table(spark, sf, "conversations").select("conv_id", "turn", "role", "text"))


def op12_best_fit_packing(spark, sf):
    return packing.pack_documents(table(spark, sf, "documents"), tokenizer_file("word_bpe_49k.json"))


def op13_token_alignment(spark, sf):
    docs = table(spark, sf, "documents")
    return alignment.align_documents(docs, tokenizer_file("byte_bpe_50k.json"), tokenizer_file("piece_bpe_32k.model"))


QUERIES = {f.__name__: f for f in [op1_quality_rules, op2_substring_dedup, op3_url_filters, op4_piece_sampling, op5_token_output, op6_minhash_dedup, op7_chat_formatting, op8_source_mixing, op9_nearest_neighbours, op10_quality_classifier, op11_turn_repair, op12_best_fit_packing, op13_token_alignment]}

_WORDS = r"len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))"
_RULES = "\n".join(
    f"UNION ALL SELECT '{v}' AS verdict, '{h}' AS rhost, '{p}' AS rpath" if i else f"SELECT '{v}' AS verdict, '{h}' AS rhost, '{p}' AS rpath"
    for i, (v, h, p) in enumerate(URL_RULES)
)

ORACLE = {
    "op2_substring_dedup": r"""
WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
k AS (
  SELECT doc_id, i, md5(array_to_string(ws[i:i + 19], ' ')) AS k
  FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 18)) AS i FROM w WHERE len(ws) >= 20)),
f AS (SELECT doc_id, i, row_number() OVER (PARTITION BY k ORDER BY doc_id, i) > 1 AS again FROM k),
covered AS (SELECT DISTINCT doc_id, i + unnest(range(0, 20)) AS pos FROM f WHERE again),
words AS (SELECT doc_id, unnest(ws) AS word, unnest(range(1, len(ws) + 1)) AS pos FROM w),
kept AS (
  SELECT doc_id, count(c.pos) AS n_removed, string_agg(word, ' ' ORDER BY pos) FILTER (WHERE c.pos IS NULL) AS left_over
  FROM words LEFT JOIN covered c USING (doc_id, pos) GROUP BY doc_id)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
  sha256(coalesce(left_over, '')) AS kept_sha256
FROM w LEFT JOIN kept USING (doc_id)""",
    "op3_url_filters": f"""
WITH rules AS ({_RULES}),
cut AS (
  SELECT row_number() OVER () AS r, page_id,
         CASE WHEN position('://' IN url) > 0 THEN substr(url, position('://' IN url) + 3) ELSE '' END AS rest
  FROM pages),
parts AS (
  SELECT r, page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
  FROM cut),
hits AS (
  SELECT r, arg_max(rhost || rpath, (length(rhost || rpath), length(rhost))) AS rule, arg_max(verdict, (length(rhost || rpath), length(rhost))) AS verdict
  FROM parts JOIN rules ON (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath)
  GROUP BY r)
SELECT page_id, coalesce(host, '') AS host, coalesce(path, '') AS path, rule, coalesce(verdict, 'allow') AS verdict
FROM parts LEFT JOIN hits USING (r)""",
    "op7_chat_formatting": r"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'),
e AS (
  SELECT *, length(replace(replace(replace(replace(role, '\', '\s'), '###', '\h'), '</turn>', '\e'), ':', '\c'))
          + length(replace(replace(replace(text, '\', '\s'), '###', '\h'), '</turn>', '\e')) + 14 AS chars
  FROM t),
w AS (
  SELECT *, sum(chars) OVER (PARTITION BY conv_id ORDER BY turn, role, text ROWS UNBOUNDED PRECEDING) AS upto,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn, role, text) = count(*) OVER (PARTITION BY conv_id) AS is_last
  FROM e)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(upto) FILTER (WHERE role = 'assistant' OR is_last) AS BIGINT) AS formatted_chars
FROM w GROUP BY conv_id""",
    "op8_source_mixing": f"""
WITH sizes AS (
  SELECT doc_id, source, ('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '')), 1, 15))::BIGINT AS h,
         CAST({_WORDS} AS BIGINT) AS size FROM documents),
per AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM sizes GROUP BY source),
num AS (SELECT *, row_number() OVER (ORDER BY source IS NULL, source) AS i FROM per),
wt AS (SELECT *, CASE (i - 1) % 3 WHEN 0 THEN 3.0::DOUBLE WHEN 1 THEN 1.0::DOUBLE ELSE 2.0::DOUBLE END AS w, source_size * 2.0::DOUBLE AS cap FROM num),
lv AS (
  SELECT *, (sum(source_size) OVER () * 1.5::DOUBLE
     - coalesce(sum(cap) OVER (ORDER BY cap / w, i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0.0::DOUBLE))
     / sum(w) OVER (ORDER BY cap / w, i ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM wt),
lvl AS (SELECT level FROM lv WHERE level * w <= cap ORDER BY cap / w, i LIMIT 1),
goal AS (SELECT source, source_size, coalesce(least(cap, (SELECT level FROM lvl) * w), cap) AS target FROM lv),
plan AS (
  SELECT *, floor(target / greatest(source_size, 1)) AS epochs,
         target - floor(target / greatest(source_size, 1)) * greatest(source_size, 1) AS budget FROM goal),
cum AS (
  SELECT s.*, p.source_size, p.target, p.epochs, p.budget,
         sum(size) OVER (PARTITION BY s.source ORDER BY h RANGE UNBOUNDED PRECEDING) AS upto,
         sum(size) OVER (PARTITION BY s.source, h) AS own
  FROM sizes s JOIN plan p ON s.source IS NOT DISTINCT FROM p.source)
SELECT doc_id, size, source_size, target,
  CAST(size * (epochs + CASE WHEN upto <= budget OR (upto - own <= budget AND upto - budget < budget - (upto - own)) THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM cum""",
}
