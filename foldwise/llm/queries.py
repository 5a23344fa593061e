"""The registered queries opN_<name>: each applies its operator to a whole table; SQL twins where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foldwise.llm import (
    angle_negatives, bpe_matrix, cap_filters, chat_parts, hd_langid, jaccard_join, license_scan, mixing, quality_divergence,
    shuffle_shards, suffix_dedup, token_stream, whitening,
)
from foldwise.llm.common import n_words, no_null_text, sql_text, table

QueryFn = Callable[[SparkSession, str], DataFrame]


# ---------------------------------------------------------------- 1
_LOWERED = f"""translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"""
_NOT_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base phrases and notices of all documents (labels of the method end in -notice or -grant)."""
    docs = table(spark, sf_dir, "documents")
    found = license_scan.scan_licenses(docs, license_scan.BASE_TEMPLATES | license_scan.NOTICE_TEMPLATES)
    is_base = lambda m: m["label"].isin(list(license_scan.BASE_TEMPLATES))
    base = F.filter("matches", is_base)
    joined = lambda m: F.array_join(F.array_sort(F.array_distinct(F.transform(m, lambda x: x["label"]))), ",")
    return found.select(
        F.col("key").alias("doc_id"), "n_words", F.size(base).cast("long").alias("n_base"),
        F.array_min(F.transform(base, lambda m: m["first_word"])).alias("first_word"),
        F.array_max(F.transform(base, lambda m: m["first_word"])).alias("last_word"),
        joined(base).alias("base_labels"), joined(F.col("matches")).alias("labels"),
        F.when(F.size("matches") > F.size(base), 1.0).when(F.size(base) > 0, 0.5).otherwise(0.0).alias("score"))


#: the templates as regular expressions over words joined by one blank, each with a blank before and after
NOTICE_REGEX = {
    "apache-notice": r" licensed under the apache license version [0-9]+ ([0-9]+ )?| licensed under the apache license ",
    "cc-notice": r" licensed under (a creative commons )?cc by (nc )?(sa )?(nd )?[0-9]+ ",
    "gpl-notice": r" licensed under the (terms of the )?(gnu )?general public license ",
    "mit-notice": r" released under the (terms of the )?mit license ",
    "mit-grant": r" permission is hereby granted free of charge to any person obtaining a copy of ([a-z0-9]+ ){1,6}to deal in the software without restriction ",
    "rights-notice": r" all rights reserved ",
}


def _op1_sql() -> str:
    phrases = {k: v.split() for k, v in license_scan.BASE_TEMPLATES.items()}
    at = lambda words: " AND ".join(f"w[i + {k + 1}] = {sql_text(x)}" for k, x in enumerate(words))
    base = ", ".join(f"CASE WHEN {at(words)} THEN {sql_text(label)} END" for label, words in phrases.items())
    notices = ", ".join(f"CASE WHEN regexp_matches(s, {sql_text(rx)}) THEN {sql_text(label)} END" for label, rx in NOTICE_REGEX.items())
    return f"""
    WITH t AS (SELECT doc_id, regexp_extract_all({_LOWERED}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM documents),
    u AS (SELECT doc_id, w, ' ' || array_to_string(w, ' ') || ' ' AS s FROM t),
    p AS (SELECT doc_id, w, s, unnest(range(0, greatest(len(w), 1))) AS i FROM u),
    b AS (SELECT doc_id, i, unnest(list_filter([{base}], lambda x: x IS NOT NULL)) AS label FROM p),
    g AS (SELECT doc_id, count(*) AS n_base, min(i) AS first_word, max(i) AS last_word,
                 list_sort(list(DISTINCT label)) AS base FROM b GROUP BY doc_id)
    SELECT u.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word,
           coalesce(array_to_string(base, ','), '') AS base_labels,
           array_to_string(list_sort(list_concat(coalesce(base, []), list_filter([{notices}], lambda x: x IS NOT NULL))), ',') AS labels,
           CASE WHEN len(list_filter([{notices}], lambda x: x IS NOT NULL)) > 0 THEN 1.0::DOUBLE WHEN n_base > 0 THEN 0.5::DOUBLE ELSE 0.0::DOUBLE END AS score
    FROM u LEFT JOIN g ON g.doc_id = u.doc_id"""


# ---------------------------------------------------------------- 2
def op2_quality_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base rules and divergence verdict of all documents."""
    judged = quality_divergence.quality(table(spark, sf_dir, "documents"))
    failed = (F.col("n_words") < quality_divergence.BASE_MIN_WORDS) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return judged.select(
        F.col("key").alias("doc_id"), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        failed.alias("base_failed"), (~failed & ~F.col("divergent")).alias("kept"),
        F.round("char_distance", 9).alias("char_distance"), F.round("word_distance", 9).alias("word_distance"))


# ---------------------------------------------------------------- 3
N_SHARDS = 40


def op3_shuffle_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents written to 40 shuffled shards, read back and digested."""
    out = shuffle_shards.shuffle_to_shards(table(spark, sf_dir, "documents"), N_SHARDS)
    return out.select("rec.doc_id", shuffle_shards.record_size("rec.text").alias("size"),
                      F.crc32(F.encode(no_null_text(F.col("rec.text")), "UTF-8")).alias("text_crc32"), F.lit("key").alias("law"),
                      "shard", "slot", "grown_shard")


# ---------------------------------------------------------------- 4
def held_out() -> F.Column:
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 3 == 1


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of all documents by prototypes of the rows that are not held out."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    learned = hd_langid.learn(docs.where(~held_out()))
    out = hd_langid.predict(docs, learned, [F.col("doc_id"), held_out().alias("held_out")])
    return out.select("rec.doc_id", "rec.held_out", "lang_pred", "score")


# ---------------------------------------------------------------- 5
def op5_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate classes of all documents: five-word n-grams, similarity 0.8 or more."""
    out = jaccard_join.jaccard_join(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.withColumnRenamed("id", "doc_id")


# ---------------------------------------------------------------- 6
PROBE = "</s>[INST] ok [/INST]"


def op6_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations formatted, then read back from the formatted text."""
    chats = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    probe = spark.range(2).select(F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"),
                                  F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(PROBE).alias("text"))
    rows = chats.unionByName(probe).select("conv_id", "turn", "role", chat_parts.text_part("text").alias("parts"))
    out = chat_parts.format_chats(rows)
    said = F.transform(chat_parts.parse_turns(F.col("formatted")), lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    lost = F.array_join(chat_parts.loss_texts(F.col("formatted"), F.col("loss_spans")), "")
    return out.select("conv_id", F.size(chat_parts.parse_turns(F.col("formatted"))).cast("long").alias("n_turns"),
                      F.sha2(F.array_join(said, ""), 256).alias("turns_sha256"),
                      F.length(lost).cast("long").alias("loss_chars"), F.sha2(lost, 256).alias("loss_sha256"),
                      F.length("formatted").cast("long").alias("formatted_chars"))


def _op6_sql() -> str:
    def escaped(c: str) -> str:
        c = f"replace({c}, '{chat_parts.ESC}', '{chat_parts.ESC}0')"
        for i, s in enumerate(chat_parts.CONTROL, 1):
            c = f"replace({c}, {sql_text(s)}, '{chat_parts.ESC}{i}')"
        return c

    learn = "role = 'assistant'"
    return f"""
    WITH t AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
               UNION ALL SELECT -1, 0, 'user', {sql_text(PROBE)} UNION ALL SELECT -1, 1, 'assistant', {sql_text(PROBE)})
    SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
           CAST(coalesce(sum(length(text)) FILTER (WHERE {learn}), 0) AS BIGINT) AS loss_chars,
           sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE {learn}), '')) AS loss_sha256,
           CAST(sum(length({escaped('text')}) + length(replace({escaped('role')}, chr(10), '##')) + 1 + CASE WHEN {learn} THEN 7 ELSE 13 END) AS BIGINT) AS formatted_chars
    FROM t GROUP BY conv_id"""


# ---------------------------------------------------------------- 7
def op7_cap_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and components of all embeddings, within labels."""
    return cap_filters.near_vectors(table(spark, sf_dir, "embeddings")).withColumnRenamed("id", "vec_id")


_OP7_SQL = """
    WITH RECURSIVE t AS (SELECT *, row_number() OVER () AS rid FROM embeddings),
    v AS (
        SELECT rid, vec_id, label, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS e FROM t
        WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
          AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
          AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
    l AS (SELECT a.rid AS a, b.rid AS b FROM v a JOIN v b ON a.label = b.label AND a.rid <> b.rid
          WHERE len(a.e) = len(b.e) AND list_cosine_similarity(a.e, b.e) >= 0.98),
    s AS (SELECT a, b FROM l UNION SELECT a.rid, b.rid FROM v a JOIN v b ON a.vec_id = b.vec_id AND a.rid <> b.rid),
    r AS (SELECT a, b AS c FROM s UNION SELECT r.a, s.b FROM r JOIN s ON s.a = r.c),
    n AS (SELECT a, count(*) AS n_links FROM l GROUP BY a),
    m AS (SELECT r.a, min(v.vec_id) AS low FROM r JOIN v ON v.rid = r.c GROUP BY r.a)
    SELECT vec_id, coalesce(n_links, 0) AS n_links, least(vec_id, coalesce(low, vec_id)) AS component_id,
           coalesce(vec_id = least(vec_id, coalesce(low, vec_id)), true) AS kept
    FROM t LEFT JOIN n ON n.a = t.rid LEFT JOIN m ON m.a = t.rid"""


# ---------------------------------------------------------------- 8
def tokenizer() -> tuple[str, str]:
    """Rank file and split pattern of the public tokenizer."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN


def op8_bpe_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents encoded, then decoded."""
    path, pattern = tokenizer()
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = bpe_matrix.encode(docs, path, pattern, [F.col("doc_id")], decoded=True)
    return out.select("rec.doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"),
                      F.sha2("decoded", 256).alias("decoded_sha256"))


# ---------------------------------------------------------------- 9
def op9_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents without the 50-byte strings that start in a document of smaller id."""
    out = suffix_dedup.suffix_dedup(table(spark, sf_dir, "documents").select("doc_id", "text"), [F.col("doc_id")])
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda a, s: a + s["length"])
    return out.select("rec.doc_id", (F.octet_length("kept") + removed).cast("long").alias("n_bytes"), removed.alias("n_removed"),
                      F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


# ---------------------------------------------------------------- 10
def op10_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Copies of all documents in the mix, by words."""
    docs = table(spark, sf_dir, "documents").select(
        "doc_id", "source", n_words("text").alias("size"), F.md5(no_null_text("text")).alias("tie"))
    out = mixing.mix(docs, size=F.col("size"), tie=F.col("tie"))
    return out.select("rec.doc_id", "size", "source_size", F.round("target", 6).alias("target"), "taken")


def _op10_sql() -> str:
    weights = ", ".join(f"{float(w)}::DOUBLE" for w in mixing.WEIGHTS)
    return f"""
    WITH t AS (SELECT doc_id, source, CASE WHEN source IS NULL THEN '1' ELSE '0' || source END AS skey,
                      CAST(len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS BIGINT) AS size, md5(coalesce(text, '')) AS tie
               FROM documents),
    s AS (SELECT skey, CAST(sum(size) AS BIGINT) AS source_size,
                 list_extract([{weights}], CAST((row_number() OVER (ORDER BY skey) - 1) % {len(mixing.WEIGHTS)} + 1 AS BIGINT)) AS weight
          FROM t GROUP BY skey),
    c AS (SELECT *, CAST(source_size AS DOUBLE) * {float(mixing.MAX_REPEAT)} AS cap, CAST(sum(source_size) OVER () AS DOUBLE) AS total FROM s),
    f AS (SELECT *, cap / weight AS fill,
                 (total - coalesce(sum(cap) OVER (ORDER BY cap / weight, skey ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0.0))
                 / sum(weight) OVER (ORDER BY cap / weight, skey ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS lvl,
                 row_number() OVER (ORDER BY cap / weight, skey) AS k FROM c),
    o AS (SELECT arg_min(lvl, k) FILTER (WHERE fill > lvl) AS top FROM f),
    g AS (SELECT skey, source_size, CASE WHEN top IS NULL OR fill <= top THEN cap ELSE weight * top END AS target,
                 (CAST(('0x' || substr(md5('{mixing.SEED}:' || skey), 1, 4)) AS INTEGER) + 0.5::DOUBLE) / 65536.0::DOUBLE AS u FROM f, o),
    r AS (SELECT t.*, CAST(row_number() OVER (PARTITION BY skey ORDER BY size, doc_id NULLS FIRST, tie) - 1 AS DOUBLE) AS k FROM t),
    e AS (SELECT r.doc_id, r.size, g.source_size, g.target, r.k, g.u, CASE WHEN g.source_size > 0 THEN g.target / g.source_size ELSE 0.0 END AS rate
          FROM r JOIN g USING (skey))
    SELECT doc_id, size, source_size, round(target, 6) AS target,
           CAST(floor(u + (k + 1.0::DOUBLE) * rate) - floor(u + k * rate) AS BIGINT) * size AS taken FROM e"""


# ---------------------------------------------------------------- 11
def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every anchor (ids divisible by 100) among all embeddings."""
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    out = angle_negatives.hard_negatives(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, label=label)
    return out.drop("positive_rank")


_OP11_SQL = """
    WITH v AS (
        SELECT vec_id, CAST(CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS BIGINT) AS label,
               list_transform(embedding, lambda x: floor(256.0::DOUBLE * CAST(x AS DOUBLE))) AS q
        FROM embeddings
        WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
          AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
    s AS (SELECT a.vec_id AS anchor_id, b.vec_id AS id, a.label = b.label AS same, CAST(list_dot_product(a.q, b.q) AS BIGINT) AS score
          FROM v a JOIN v b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
    p AS (SELECT anchor_id, id AS positive_id, score AS positive_score FROM s WHERE same
          QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5)
    SELECT anchor_id, positive_id, CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, id) AS INTEGER) AS rank,
           id AS negative_id, positive_score, score AS negative_score
    FROM p JOIN s USING (anchor_id)
    WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
    QUALIFY rank <= 10"""


# ---------------------------------------------------------------- 12
def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first eight whitened components of all embeddings, fitted on all of them."""
    return whitening.whiten(table(spark, sf_dir, "embeddings")).withColumnRenamed("id", "vec_id")


# ---------------------------------------------------------------- 13
def op13_token_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents written as Arrow streams of equal-length token sequences, read back from the files."""
    import public_tokenizers

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    written = token_stream.write_tokens(docs, public_tokenizers.path("byte_bpe_50k.json"))
    return token_stream.read_tokens(spark, written).drop("masked")


QUERIES: dict[str, QueryFn] = {f.__name__: f for f in (
    op1_license_scan, op2_quality_divergence, op3_shuffle_shards, op4_language_id, op5_jaccard_join,
    op6_chat_format, op7_cap_filters, op8_bpe_tokens, op9_suffix_dedup, op10_mix_sources,
    op11_hard_negatives, op12_whitening, op13_token_stream)}


def queries() -> dict[str, QueryFn]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return {"op1_license_scan": _op1_sql(), "op6_chat_format": _op6_sql(), "op7_cap_filters": _OP7_SQL, "op10_mix_sources": _op10_sql(),
            "op11_hard_negatives": _OP11_SQL}
