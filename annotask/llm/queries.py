"""The registered queries over the training-data operators, and their SQL twins."""

from __future__ import annotations

import hashlib
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from annotask.llm import bpe, chat, exact_dedup, hard_negatives, kd_shards, licenses, mixing, perplexity, pii, simhash
from annotask.llm import site_quality, toxicity, vector_codes
from annotask.llm.common import read_table, written

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(function):
        QUERIES[name] = function
        if sql is not None:
            ORACLE_SQL[name] = sql
        return function

    return register


def _escaped_sql(expression: str) -> str:
    """The template's escaping, in SQL."""
    out = f"replace({expression}, '\\', '\\\\')"
    for control in chat.CONTROL:
        out = f"replace({out}, '{control}', '{control[0]}\\{control[1:]}')"
    return out


@query(
    "op1_chat_windows",
    f"""
    WITH given AS (
      SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
      UNION ALL VALUES (-1::BIGINT, 0::BIGINT, 'user', '{chat.CONTROL[3]}[INST] ok [/INST]'),
                       (-1::BIGINT, 1::BIGINT, 'assistant', '{chat.CONTROL[3]}[INST] ok [/INST]')),
    costed AS (
      SELECT *, CAST(ceil(strlen(text) / 4.0) AS BIGINT) + {chat.OVERHEAD} AS cost,
             length({_escaped_sql("role")}) + length({_escaped_sql("text")}) + 13 AS chars,
             row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS LAST, role, text) AS n
      FROM given),
    placed AS (
      SELECT *, CAST(sum(cost) OVER (PARTITION BY conv_id ORDER BY n) AS BIGINT) AS until FROM costed),
    system AS (
      SELECT conv_id, arg_min(until, n) AS sys_until, arg_min(cost, n) AS sys_cost, arg_min(chars, n) AS sys_chars
      FROM placed WHERE role = 'system' GROUP BY conv_id),
    celled AS (
      SELECT p.*, until - cost AS start, sys_until, sys_chars,
             greatest({chat.BUDGET} - coalesce(sys_cost, 0), 2) AS room,
             greatest({chat.BUDGET} - coalesce(sys_cost, 0), 2) // 2 AS cell
      FROM placed p LEFT JOIN system s ON p.conv_id IS NOT DISTINCT FROM s.conv_id),
    windows AS (
      SELECT conv_id, min(start) AS begins, max(until) AS ends, any_value(sys_until) AS sys_until,
             any_value(sys_chars) AS sys_chars,
             greatest(least({chat.HISTORY}, any_value(room) - (max(until) - min(start))), 0) AS allowed
      FROM celled GROUP BY conv_id, (until - 1) // cell, cost <= cell),
    history AS (
      SELECT w.conv_id, CAST(sum(t.chars) AS BIGINT) AS chars
      FROM windows w JOIN celled t ON w.conv_id IS NOT DISTINCT FROM t.conv_id
       AND t.start >= w.begins - w.allowed AND t.until <= w.begins AND t.cost <= {chat.HISTORY}
       AND (w.sys_until IS NULL OR t.until <> w.sys_until)
      GROUP BY w.conv_id),
    retained AS (
      SELECT conv_id, CAST(sum(CASE WHEN sys_until <= begins THEN sys_chars ELSE 0 END) AS BIGINT) AS chars
      FROM windows GROUP BY conv_id),
    whole AS (
      SELECT conv_id, count(*) AS n_turns, CAST(sum(chars) AS BIGINT) AS chars,
             sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY n)) AS turns_sha256,
             coalesce(string_agg(CASE WHEN role = 'assistant' THEN text END, '' ORDER BY n), '') AS loss
      FROM costed GROUP BY conv_id)
    SELECT w.conv_id, n_turns, turns_sha256, CAST(length(loss) AS BIGINT) AS loss_chars, sha256(loss) AS loss_sha256,
           CAST(w.chars + r.chars + coalesce(h.chars, 0) AS BIGINT) AS formatted_chars
    FROM whole w JOIN retained r ON w.conv_id IS NOT DISTINCT FROM r.conv_id
    LEFT JOIN history h ON w.conv_id IS NOT DISTINCT FROM h.conv_id
    """,
)
def op1_chat_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = read_table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    marked = "</s>[INST] ok [/INST]"
    extra = spark.range(2).select(
        F.lit(-1).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(marked).alias("text"),
    )
    read = chat.read_back(chat.chat_windows(conversations.union(extra)))
    form = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    parts = read.select(
        "conv",
        F.size("turns").alias("n"),
        F.char_length("text").alias("chars"),
        F.struct("window", F.array_join(form, "").alias("turns"), F.array_join("targets", "").alias("loss")).alias("part"),
    )
    # The contract's digests are of a conversation's whole text.
    whole = parts.groupBy("conv").agg(
        F.sum("n").alias("n_turns"), F.sum("chars").alias("formatted_chars"), F.sort_array(F.collect_list("part")).alias("parts")
    )
    loss = F.array_join(F.transform("parts", lambda p: p["loss"]), "")
    return whole.select(
        F.col("conv").alias("conv_id"),
        F.col("n_turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(F.transform("parts", lambda p: p["turns"]), ""), 256).alias("turns_sha256"),
        F.char_length(loss).cast("long").alias("loss_chars"),
        F.sha2(loss, 256).alias("loss_sha256"),
        F.col("formatted_chars").cast("long").alias("formatted_chars"),
    )


@query("op2_site_quality")
def op2_site_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents, labels = read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels")
    # A document's site is its source, its path the language section of it.
    return site_quality.site_quality(documents, labels, host=F.col("source"), path=F.col("lang"))


@query("op3_byte_bpe")
def op3_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    coded = bpe.encode_texts(documents, path, public_tokenizers.PATTERN, decoded_col="decoded")
    return coded.select(
        "doc_id",
        (F.octet_length("token_ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("token_ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@query(
    "op4_exact_dedup",
    r"""
    WITH t AS (
      SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS body FROM documents)
    SELECT doc_id, min(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
           doc_id = min(doc_id) OVER w AS kept, sha256(body) AS text_sha256
    FROM t WINDOW w AS (PARTITION BY body)
    """,
)
def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return exact_dedup.exact_dedup(documents).drop("text")


@query("op5_kd_shards")
def op5_kd_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = read_table(spark, sf_dir, "documents")
    placed = kd_shards.kd_shards(documents, shards=16, carry=["doc_id"])
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


@query("op6_toxicity")
def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = read_table(spark, sf_dir, "labels")
    return toxicity.toxicity(documents, labels).select("doc_id", "held_out", "score", "predicted")


@query("op7_pii")
def op7_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.extract_pii(read_table(spark, sf_dir, "documents"))

    def count(kind: str):
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select(
        "doc_id",
        *(count(kind) for kind in pii.KINDS),
        F.sha2(pii.spans_text(F.col("base")), 256).alias("base_sha256"),
        pii.spans_text(F.concat("base", "added")).alias("spans"),
    )


@query("op8_simhash")
def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.simhash_groups(read_table(spark, sf_dir, "documents"), length=3, radius=2)


@query("op9_perplexity_rules")
def op9_perplexity_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = read_table(spark, sf_dir, "documents")
    judged = perplexity.quality_rules(documents)
    counts = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    return judged.select("doc_id", *counts, "base_failed", "kept", "perplexity", "lower", "upper")


@query(
    "op10_mix",
    r"""
    WITH d AS (
      SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
             (('0x' || substr(md5('mix:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 13))::BIGINT + 0.5::DOUBLE)
               / 4503599627370496.0::DOUBLE AS u
      FROM documents),
    ranked AS (SELECT doc_id, source, size, u / (1.0::DOUBLE - u) * sqrt(CAST(size AS DOUBLE)) AS mix_rank FROM d),
    totals AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM ranked GROUP BY source),
    weighed AS (
      SELECT *, [5.0::DOUBLE, 2.0::DOUBLE, 1.0::DOUBLE][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3] AS weight
      FROM totals),
    filling AS (
      SELECT *, 3.0::DOUBLE * source_size AS most,
             row_number() OVER (ORDER BY source_size / weight, source NULLS LAST) AS fill_order,
             CAST(sum(source_size) OVER () AS DOUBLE) AS all_size
      FROM weighed),
    levels AS (
      SELECT *, (all_size - coalesce(sum(most) OVER (ORDER BY fill_order ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0.0::DOUBLE))
               / sum(weight) OVER (ORDER BY fill_order ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
      FROM filling),
    opened AS (
      SELECT min(fill_order) AS open_order, arg_min(level, fill_order) AS open_level FROM levels WHERE weight * level < most),
    targets AS (
      SELECT source, source_size, open_order IS NULL OR fill_order < open_order AS is_full,
             CASE WHEN open_order IS NULL OR fill_order < open_order THEN most ELSE weight * open_level END AS target
      FROM levels CROSS JOIN opened),
    plan AS (
      SELECT *, CASE WHEN source_size = 0 THEN 0 WHEN is_full THEN 3 ELSE CAST(floor(target / source_size) AS INTEGER) END AS certain
      FROM targets),
    cut AS (
      SELECT r.doc_id, r.size, p.source_size, p.target, p.certain,
             greatest(p.target - p.certain * p.source_size, 0.0::DOUBLE) AS remaining,
             coalesce(sum(r.size) OVER (PARTITION BY r.source ORDER BY r.mix_rank, r.doc_id
                                        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
      FROM ranked r JOIN plan p ON r.source IS NOT DISTINCT FROM p.source)
    SELECT doc_id, size, source_size, target,
           CAST(size * (certain + CASE WHEN before + size / 2.0::DOUBLE < remaining THEN 1 ELSE 0 END) AS BIGINT) AS taken
    FROM cut
    """,
)
def op10_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = read_table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    taken = mixing.mix_sources(documents, keep_text=False)
    return taken.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


def _license_sql() -> str:
    """Every block against every notice, without the join's filters."""
    word = "regexp_extract_all(translate(coalesce(text, ''), '{}', '{}'), '{}')".format(
        licenses.UPPER, licenses.LOWER, licenses.LICENSE_WORD
    )
    sets = licenses.notice_sets(licenses.NOTICES, licenses.CONTAINMENT)
    notices = ", ".join(f"({i}, '{s['label']}', {s['step']}, {s['need']}, {s['tokens']})" for i, s in enumerate(sets))
    phrases = [(label, phrase.split(" ")) for label, phrase in licenses.PHRASES]
    cases = " ".join(
        "WHEN " + " AND ".join(f"w{k} = '{w}'" for k, w in enumerate(words)) + f" THEN '{label}'" for label, words in phrases
    )
    return f"""
    WITH t AS (SELECT doc_id, {word} AS words FROM documents),
    p AS (SELECT doc_id, unnest(words) AS w0, generate_subscripts(words, 1) - 1 AS place FROM t),
    n AS (SELECT *, lead(w0, 1) OVER w AS w1, lead(w0, 2) OVER w AS w2 FROM p WINDOW w AS (PARTITION BY doc_id ORDER BY place)),
    base AS (
      SELECT doc_id, count(*) AS n_base, min(place) AS first_word, max(place) AS last_word, list(DISTINCT label) AS labels
      FROM (SELECT doc_id, place, CASE {cases} END AS label FROM n) WHERE label IS NOT NULL GROUP BY doc_id),
    notices(id, label, step, need, tokens) AS (VALUES {notices}),
    tokens AS (SELECT id, label, step, need, len(tokens) AS size, unnest(tokens) AS token FROM notices),
    met AS (
      SELECT doc_id, id, label, place // step - back AS block, count(DISTINCT token) / any_value(size) AS share
      FROM p JOIN tokens ON w0 = token CROSS JOIN (VALUES (0), (1)) AS b(back)
      WHERE place // step - back >= 0 GROUP BY doc_id, id, label, block HAVING count(DISTINCT token) >= any_value(need)),
    best AS (SELECT doc_id, list(DISTINCT label) AS labels, max(share) AS share FROM met GROUP BY doc_id)
    SELECT t.doc_id, CAST(len(words) AS BIGINT) AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word,
           coalesce(array_to_string(list_sort(base.labels), ','), '') AS base_labels,
           coalesce(array_to_string(list_sort(list_distinct(list_concat(base.labels, best.labels))), ','), '') AS labels,
           CASE WHEN n_base > 0 THEN 1.0::DOUBLE ELSE coalesce(share, 0.0::DOUBLE) END AS score
    FROM t LEFT JOIN base ON t.doc_id = base.doc_id LEFT JOIN best ON t.doc_id = best.doc_id
    """


@query("op12_license_scan", _license_sql())
def op12_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    starts = F.transform("base", lambda p: p["start"])
    return licenses.license_scan(documents).select(
        "doc_id",
        "n_words",
        F.size("base").cast("long").alias("n_base"),
        F.array_min(starts).alias("first_word"),
        F.array_max(starts).alias("last_word"),
        F.array_join("base_labels", ",").alias("base_labels"),
        F.array_join("labels", ",").alias("labels"),
        F.col("license_score").alias("score"),
    )


@query(
    "op11_hard_negatives",
    """
    WITH finite AS (
      SELECT vec_id, CAST(label AS BIGINT) AS label, embedding FROM embeddings
      WHERE label IS NOT NULL AND embedding IS NOT NULL
        AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
    v AS (
      SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
             list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS vec
      FROM finite),
    scored AS (
      SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS same,
             CAST(list_dot_product(a.vec, b.vec) AS BIGINT) AS score
      FROM v a JOIN v b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
    positives AS (
      SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM scored WHERE same
      QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5)
    SELECT p.anchor_id, positive_id, other_id AS negative_id, positive_score, score AS negative_score,
           CAST(row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, other_id) AS INTEGER) AS rank
    FROM positives p JOIN scored s ON p.anchor_id = s.anchor_id AND NOT same
     AND 80 * positive_score <= 100 * score AND score <= positive_score
    QUALIFY rank <= 5
    """,
)
def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = read_table(spark, sf_dir, "embeddings")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.hard_negatives(vectors.withColumn("label", label), F.col("vec_id") % 100 == 0)


def _codes_sql() -> str:
    """Every part against every entry, round by round."""
    parts, rounds, scale = vector_codes.PARTS, vector_codes.ROUNDS, vector_codes.SCALE
    steps = []
    for r in range(rounds + 1):
        # Whole numbers far below 2^53, so these doubles are exact.
        steps.append(f"""
    near{r} AS MATERIALIZED (
      SELECT vec_id, part, any_value(p) AS p, min(gap) AS gap, arg_min(entry, gap * 256 + entry) AS entry
      FROM (SELECT vec_id, part, p, entry,
                   list_dot_product(p, p) - 2 * list_dot_product(p, c) + list_dot_product(c, c) AS gap
            FROM points JOIN book{r} USING (part)) GROUP BY vec_id, part)""")
        if r < rounds:
            steps.append(f"""
    mean{r} AS (
      SELECT part, entry, list(x ORDER BY place) AS c
      FROM (SELECT part, entry, place, floor(sum(x) / count(*)) AS x
            FROM (SELECT part, entry, unnest(p) AS x, generate_subscripts(p, 1) AS place FROM near{r})
            GROUP BY part, entry, place)
      GROUP BY part, entry),
    book{r + 1} AS MATERIALIZED (
      SELECT part, entry, coalesce(m.c, b.c) AS c FROM book{r} b LEFT JOIN mean{r} m USING (part, entry))""")
    return f"""
    WITH kept AS (
      SELECT vec_id, label, list_transform(embedding, lambda x: floor({scale} * CAST(x AS DOUBLE))) AS vec FROM embeddings
      WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
    points AS MATERIALIZED (
      SELECT vec_id, CAST(part AS INTEGER) AS part,
             vec[len(vec) // {parts} * part + 1 : len(vec) // {parts} * (part + 1)] AS p
      FROM kept CROSS JOIN range({parts}) AS r(part)),
    starts AS (
      SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS entry FROM kept QUALIFY entry < {vector_codes.ENTRIES}),
    book0 AS MATERIALIZED (SELECT part, entry, p AS c FROM points JOIN starts USING (vec_id)),{','.join(steps)},
    digest AS (
      SELECT sha256(string_agg(CAST(CAST(x AS BIGINT) AS VARCHAR), ',' ORDER BY part, entry, place)) AS codebooks_sha256
      FROM (SELECT part, entry, unnest(c) AS x, generate_subscripts(c, 1) AS place FROM book{rounds})),
    coded AS (
      SELECT vec_id, string_agg(printf('%02x', CAST(entry AS INTEGER)), '' ORDER BY part) AS code, CAST(sum(gap) AS BIGINT) AS error
      FROM near{rounds} GROUP BY vec_id)
    SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256
    FROM coded JOIN kept USING (vec_id) CROSS JOIN digest
    """


@query("op13_vector_codes", _codes_sql())
def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded, codebooks = vector_codes.vector_codes(read_table(spark, sf_dir, "embeddings"))
    coded = written(coded.select("vec_id", "label", "code", F.col("code_error").alias("error")), "codes")
    by_label = coded.groupBy(F.col("label").alias("of")).agg(F.sum("error").alias("label_error"))
    numbers = ",".join(map(str, codebooks.ravel().tolist()))
    return coded.join(by_label, F.col("label").eqNullSafe(F.col("of"))).select(
        "vec_id", "code", "error", "label_error", F.lit(hashlib.sha256(numbers.encode()).hexdigest()).alias("codebooks_sha256")
    )
