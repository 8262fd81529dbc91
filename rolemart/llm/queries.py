"""One query per operator, with production parameters, over the whole of its table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rolemart.llm import decontaminate, lines, neardup, packing, phrases, pii, preference, quality, recipes, repeats, secrets, turns, warc
from rolemart.llm.registry import query, table


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


@query("op10_pack_min_bin_slack")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer_path())


def _joined(spans: Column, name: str) -> Column:
    parts = F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string")))
    return F.array_join(parts, ",").alias(name)


@query("op5_secret_scan")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.with_secrets(table(spark, sf_dir, "documents").select("doc_id", "text"), "found").drop("text")
    base = F.filter("found", lambda s: s["kind"].isin(*secrets.BASE_KINDS))

    def count(kind: str):
        return F.size(F.filter("found", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select(
        "doc_id", *map(count, secrets.BASE_KINDS), F.sha2(_joined(base, "base"), 256).alias("base_sha256"), _joined(F.col("found"), "spans")
    )


@query("op7_prefix_filtered_decontamination")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontaminate.with_leaks(docs, table(spark, sf_dir, "benchmark"), "leak").select("doc_id", "leak")
    hit = F.aggregate("leak.spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return found.select("doc_id", "leak.n_words", hit.alias("n_hit"), F.size("leak.items").cast("long").alias("n_items"),
                        F.sha2(F.array_join("leak.items", ","), 256).alias("items_sha256"), (hit > 0).alias("contaminated"))


def held_out() -> Column:
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 5 == 0


def training_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "labels").select("doc_id", "quality").where(~held_out())


@query("op1_bradley_terry_quality")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = quality.with_quality(docs, training_labels(spark, sf_dir), "score")
    return scored.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


@query("op6_line_first_cleaning")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = lines.with_line_verdict(table(spark, sf_dir, "documents").select("doc_id", "text"), "v")
    return judged.select("doc_id", *(f"v.{c}" for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")))


@query("op9_weak_supervision_pii")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.with_personal_data(table(spark, sf_dir, "documents").select("doc_id", "text"), "found").drop("text")
    base = F.filter("found", lambda s: s["kind"].isin(*pii.BASE_KINDS))

    def count(kind: str) -> Column:
        return F.size(F.filter("found", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select(
        "doc_id", *map(count, pii.BASE_KINDS), F.sha2(_joined(base, "base"), 256).alias("base_sha256"), _joined(F.col("found"), "spans")
    )


@query("op4_index_first_warc")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = warc.archive_folder(spark)
    index = warc.write(table(spark, sf_dir, "pages"), folder)
    return warc.read(index, folder).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


_OP8_SQL = r"""
WITH t AS (SELECT conv_id AS p, turn, coalesce(role, '') AS role, coalesce(text, '') AS text, role AS r, text AS x FROM conversations WHERE conv_id IS NOT NULL),
last_turn AS (
  SELECT p, turn, x FROM (SELECT p, turn, x, row_number() OVER (PARTITION BY p ORDER BY turn DESC NULLS LAST, x DESC NULLS LAST) AS k FROM t WHERE r = 'assistant') WHERE k = 1),
known AS (
  SELECT t.*, o.p IS NOT NULL AS there, coalesce(o.x, '') AS other,
         coalesce(r = 'assistant' AND l.p IS NOT NULL AND t.turn IS NOT DISTINCT FROM l.turn AND t.x IS NOT DISTINCT FROM l.x, false) AS is_last
  FROM t LEFT JOIN last_turn l ON t.p = l.p LEFT JOIN last_turn o ON o.p = xor(t.p, 1)),
sides AS (
  SELECT p, true AS chosen, turn, role, text FROM t
  UNION ALL SELECT p, false, turn, role, CASE WHEN is_last THEN other ELSE text END FROM known WHERE NOT is_last OR there),
placed AS (SELECT *, row_number() OVER (PARTITION BY p, chosen ORDER BY turn NULLS FIRST, role, text) AS k FROM sides),
wide AS (
  SELECT coalesce(a.p, b.p) AS p, coalesce(a.k, b.k) AS k, a.role AS ar, a.text AS ax, b.role AS br, b.text AS bx
  FROM (FROM placed WHERE chosen) a FULL JOIN (FROM placed WHERE NOT chosen) b ON a.p = b.p AND a.k = b.k),
cut AS (
  SELECT p, coalesce(min(k) FILTER (WHERE NOT coalesce(ar = br AND ax = bx, false)), max(k) + 1) - 1 AS n FROM wide GROUP BY p),
rendered AS (
  SELECT s.p, s.chosen, s.k, c.n, s.role, '<|' || s.role || '|>' || chr(10) || s.text || chr(10) || '<|end|>' || chr(10) AS piece, length(s.role) + 5 AS head, length(s.text) + 8 AS body
  FROM placed s JOIN cut c ON s.p = c.p),
spans AS (
  SELECT *, coalesce(sum(length(piece)) OVER (PARTITION BY p, chosen ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS pos FROM rendered WHERE k > n),
done AS (
  SELECT p, coalesce(string_agg(piece, '' ORDER BY k) FILTER (WHERE chosen), '') AS a, coalesce(string_agg(piece, '' ORDER BY k) FILTER (WHERE NOT chosen), '') AS b,
         count(*) FILTER (WHERE chosen) AS na, count(*) FILTER (WHERE NOT chosen) AS nb,
         coalesce(string_agg((pos + head)::BIGINT || ':' || (pos + head + body)::BIGINT, ',' ORDER BY k) FILTER (WHERE chosen AND role = 'assistant'), '') AS sa,
         coalesce(string_agg((pos + head)::BIGINT || ':' || (pos + head + body)::BIGINT, ',' ORDER BY k) FILTER (WHERE NOT chosen AND role = 'assistant'), '') AS sb
  FROM spans GROUP BY p),
prompts AS (SELECT p, string_agg(piece, '' ORDER BY k) AS prompt FROM rendered WHERE chosen AND k <= n GROUP BY p)
SELECT c.p AS conv_id, c.n AS n_prompt_turns, coalesce(na, 0) AS n_chosen_turns, coalesce(nb, 0) AS n_rejected_turns, coalesce(prompt, '') AS prompt,
       coalesce(a, '') AS chosen, coalesce(b, '') AS rejected, coalesce(sa, '') AS chosen_spans, coalesce(sb, '') AS rejected_spans
FROM cut c LEFT JOIN done ON c.p = done.p LEFT JOIN prompts ON c.p = prompts.p
"""


@query("op8_preference_pairs", _OP8_SQL)
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    examples = preference.preference_examples(preference.swapped_replies(table(spark, sf_dir, "conversations")))

    def told(spans: str) -> Column:
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["start"].cast("string"), s["end"].cast("string"))), ",").alias(spans)

    plain = ("n_prompt_turns", "n_chosen_turns", "n_rejected_turns", "prompt", "chosen", "rejected")
    return examples.select(F.col("pair_id").alias("conv_id"), *plain, told("chosen_spans"), told("rejected_spans"))


@query("op2_run_length_index_dedup")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.remove_repeats(table(spark, sf_dir, "documents"))


@query("op3_bottom_k_near_dedup")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    grouped = neardup.with_groups(table(spark, sf_dir, "documents").select("doc_id", "text"), "g", size=4, with_text=False)
    return grouped.select("doc_id", "g.n_shingles", "g.component_id", "g.kept")


def damaged(conversations: DataFrame) -> DataFrame:
    """The rows of op11's contract: by a checksum of conversation and turn, some are dropped, changed or repeated."""

    def known(column: str) -> Column:
        return F.coalesce(F.col(column).cast("string"), F.lit(" "))

    fate = F.crc32(F.concat(known("conv_id"), F.lit(":"), known("turn")).cast("binary")) % 20
    text = F.when(fate == 1, "").when(fate == 2, F.translate(known("text"), ".!?", "")).otherwise(known("text"))
    copies = F.when(fate == 0, F.array()).when(fate == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1))).cast("array<int>")
    return conversations.select("conv_id", "turn", F.when(fate == 4, "user").otherwise(known("role")).alias("role"), text.alias("text"), F.explode(copies).alias("copy")).drop("copy")


@query("op11_suffix_shared_repair")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    rows = damaged(conversations)
    plans = turns.repairs(rows)
    shas = turns.digests(turns.edited(rows, plans))
    counts = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    found = plans.join(shas, "conv").select(F.col("conv_id").alias("id"), *counts, "audit", "repaired_sha256")
    every = conversations.select("conv_id").distinct()
    return every.join(found, F.col("conv_id").eqNullSafe(F.col("id")), "left").select(
        "conv_id", *(F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in counts), F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("repaired_sha256"))


_OP12_SQL = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
worded AS (SELECT lang, list_filter(regexp_split_to_array(piece, '[ \t]+'), lambda w: w <> '') AS w FROM pieces),
runs AS (
  SELECT lang, size, unnest(list_transform(range(1, len(w) - size + 2), lambda i: array_to_string(w[i : i + size - 1], ' '))) AS phrase
  FROM worded, (VALUES (1), (2), (3)) s(size) WHERE len(w) >= size),
f AS (SELECT lang, size, phrase, count(*) AS f FROM runs GROUP BY ALL),
totals AS (SELECT lang, sum(f)::BIGINT AS n FROM f WHERE size = 1 GROUP BY lang),
candidates AS (SELECT * FROM f WHERE size > 1 AND f >= 10),
longer AS (
  SELECT lang, p AS phrase, max(f) AS longer FROM (
    SELECT lang, f, unnest([array_to_string(string_split(phrase, ' ')[1:2], ' '), array_to_string(string_split(phrase, ' ')[2:3], ' ')]) AS p FROM candidates WHERE size = 3) GROUP BY ALL),
free AS (SELECT c.* FROM candidates c LEFT JOIN longer o ON c.lang = o.lang AND c.phrase = o.phrase WHERE o.longer IS NULL OR 100 * o.longer < 50 * c.f),
cuts AS (
  SELECT lang, phrase, f AS a, k, array_to_string(string_split(phrase, ' ')[1:k], ' ') AS first, array_to_string(string_split(phrase, ' ')[k + 1:size], ' ') AS last
  FROM free, (VALUES (1), (2)) s(k) WHERE k < size),
scored AS (
  SELECT c.lang, c.phrase, a, k, x.f AS l, y.f AS r, ((1000000::HUGEINT * a * a) // (x.f::HUGEINT * y.f))::BIGINT AS score
  FROM cuts c JOIN f x ON c.lang = x.lang AND c.first = x.phrase JOIN f y ON c.lang = y.lang AND c.last = y.phrase),
lowest AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) AS cut_no FROM scored) WHERE cut_no = 1),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM lowest)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN totals USING (lang) WHERE rank <= 2000
"""


@query("op12_toivonen_phrases", _OP12_SQL)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(table(spark, sf_dir, "documents").select("lang", "text"))


_OP13_SQL = """
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size, row_number() OVER (same ORDER BY doc_id DESC NULLS LAST) = 1 AS kept,
       sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))
"""


@query("op13_chunk_recipe_dedup", _OP13_SQL)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    grouped = recipes.exact_groups(table(spark, sf_dir, "documents").select("doc_id", "text"), "exact")
    return grouped.select("doc_id", "exact.keep_id", "exact.group_size", "exact.kept", "exact.text_sha256")
