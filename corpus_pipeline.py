"""The corpus pipeline: language ID, near-duplicates, substring dedup, mixing, tokens.

Each stage works on every row its predecessor kept and returns the columns of
``documents``; the last returns the token ids.  ``run`` writes each stage's rows
to the cluster's shared folder and reads them back as the next one's input.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from foldwise.llm import bpe_matrix, hd_langid, jaccard_join, mixing, suffix_dedup
from foldwise.llm.common import scratch, table
from foldwise.llm.queries import held_out, tokenizer


#: working columns, names that no table has
KEY, STAYS = "__pipeline_key", "__pipeline_stays"
#: Spark's sign for a broken character, and a noncharacter that escapes it
BROKEN, ESCAPE = "\ufffd", "\ufdd1"


def _columns(df: DataFrame) -> list:
    return [F.col(f"`{c}`") for c in df.columns]


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents without a letter (NULL and empty texts among them); others get the predicted language, as ``lang``.

    Prototypes are learned from the rows that are not held out; without a
    labelled one of them every text with a letter stays as it is.  Repeated rows
    and rows of NULL id are judged alike; an empty table stays empty."""
    learned = hd_langid.learn(docs.where(~held_out()))
    if not learned:
        return docs.where(F.rlike(F.col("text"), F.lit(r"\p{L}")))
    out = hd_langid.predict(docs, learned, _columns(docs))
    return out.where(F.col("lang_pred") != hd_langid.UNKNOWN).select(
        *[(F.col("lang_pred").alias("lang") if c == "lang" else F.col(f"rec.`{c}`")) for c in docs.columns])


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate class stays: the one of smallest id, NULL ids last.

    A document is a pair of id and text, so texts that share an id are judged
    apart and of equal rows one stays.  Texts of fewer than five words, empty and
    NULL ones are near nothing but the equal row of their id."""
    key = F.xxhash64(F.col("doc_id"), F.col("text"))
    keyed = docs.withColumn(KEY, key)
    classes = jaccard_join.jaccard_join(keyed.select(KEY, "text"), key=KEY, count_links=False).select(F.col("id").alias(KEY), "class_id").distinct()
    shared = classes.where(F.col(KEY) != F.col("class_id")).select("class_id").distinct()
    members = classes.join(shared, "class_id").join(keyed.select(KEY, "doc_id").distinct(), KEY)
    # NULL ids are larger than all others
    order = F.struct(F.col("doc_id").isNull(), F.coalesce("doc_id", F.lit(0)), F.col(KEY))
    first = members.groupBy("class_id").agg(F.min(order)[KEY].alias(STAYS))
    gone = members.join(first, "class_id").where(F.col(KEY) != F.col(STAYS)).select(KEY)
    copies = W.partitionBy(KEY).orderBy(F.xxhash64(*_columns(docs)))
    return (keyed.join(gone, KEY, "left_anti").withColumn(STAYS, F.row_number().over(copies)).where(F.col(STAYS) == 1)
            .select(*_columns(docs)))


def repeated_substrings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the 50-byte strings of documents with a smaller id; n_chars follows.

    Matches are judged on bytes; the rest of a character that a cut splits goes
    with it, so that texts stay valid, and replacement signs of the text itself
    stay.  Documents with nothing left go, as do NULL and blank ones; rows of NULL
    id lose nothing, rows that share an id nothing to each other."""
    rest = [c for c in docs.columns if c not in ("text", "n_chars")]
    out = suffix_dedup.suffix_dedup(docs, [F.col(f"`{c}`") for c in rest])
    whole = F.col("kept").cast("string")
    out = out.withColumn("text", F.when(F.is_valid_utf8(whole), whole).otherwise(without_broken(whole)))
    out = out.where(F.length(F.trim("text")) > 0).withColumn("n_chars", F.length("text").cast("long"))
    return out.select(*[F.col(c) if c in ("text", "n_chars") else F.col(f"rec.`{c}`") for c in docs.columns])


def without_broken(text: F.Column) -> F.Column:
    """The text without the bytes that are not part of a character.

    Spark's repair puts U+FFFD in their place; those of the text itself are
    escaped before and come back after."""
    text = F.replace(F.replace(text, F.lit(ESCAPE), F.lit(ESCAPE + "0")), F.lit(BROKEN), F.lit(ESCAPE + "1"))
    text = F.replace(F.make_valid_utf8(text), F.lit(BROKEN), F.lit(""))
    return F.replace(F.replace(text, F.lit(ESCAPE + "1"), F.lit(BROKEN)), F.lit(ESCAPE + "0"), F.lit(ESCAPE))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix takes it; NULL and empty texts have no words and are not taken, repeated rows count each."""
    return mixing.emit(mixing.mix(docs)).select(*docs.columns)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, and whether they decode to its text (NULL and empty texts: no ids; repeated rows stay)."""
    path, pattern = tokenizer()
    keep = [F.col("doc_id"), F.col("lang"), F.col("source"), F.md5(F.coalesce("text", F.lit(""))).alias("digest")]
    out = bpe_matrix.encode(docs, path, pattern, keep, decoded=True)
    return out.select("rec.doc_id", "rec.lang", "rec.source", "ids", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
                      (F.md5("decoded") == F.col("rec.digest")).alias("round_trip"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language", language),
    ("near_duplicates", near_duplicates),
    ("repeated_substrings", repeated_substrings),
    ("mix_sources", mix_sources),
    ("tokens", tokens),
]

#: SQL cannot express the stages; tests hold them against brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each stage's rows are written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        path = scratch(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
