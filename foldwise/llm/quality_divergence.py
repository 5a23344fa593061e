"""Quality rules by distribution divergence (DataFrame functions only).

A document's histogram of character classes and its histogram of common words
are compared with those of every reference language by the Jensen-Shannon
distance (square root of the divergence, logarithm to base 2).  The references
are sums over all documents with a language, so they follow the corpus.  A
document passes if some language's distance is small enough; the limits of the
word histogram widen with the sampling noise of short documents.

Everything about one text is computed inside its row by array functions: no
word is shuffled.  One pass over the texts writes the per-document counts (a few
numbers per row) to the checkpoint folder; references and verdicts read those.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foldwise.llm.common import checkpoint, no_null_text

#: fixed values: common words by language
COMMON_WORDS = {
    "de": "der die und in den von zu das mit sich des auf für ist im dem nicht ein eine als auch es an werden aus er hat dass sie nach",
    "en": "the of and to in a is that for it was on with be by as are this from at or an not have which but they his you were",
    "es": "de la que el en y los se del las un por con no una su para es al lo como más o pero sus le ha me si sin",
    "fr": "de la le et les des en un du une que est pour qui dans au par sur pas plus ne se ce il sont avec ou son aux cette",
}
VOCABULARY = sorted({w for words in COMMON_WORDS.values() for w in words.split()})
#: classes of code points: name -> Java character class; what none of them holds is ``other``
CLASSES = {
    "lower": r"\p{Ll}", "upper": r"\p{Lu}", "digit": r"\p{Nd}", "space": r"\s", "stop": r"[.,;:!?'\"()\-]",
    "symbol": r"[#*$%&|<>@^~=+/\\_{}\[\]]",
}
MIN_CHARS = 200
#: base rule of the query: fewer words than this fail
BASE_MIN_WORDS = 50
#: from so many words on the word limits are constant; below they widen by NOISE * (1/sqrt(n_words) - 1/sqrt(STEADY_WORDS))
STEADY_WORDS = 120
WORD_NOISE = 0.7
SUM_NOISE = 3.0
MAX_CHAR_DISTANCE = 0.26
MAX_WORD_DISTANCE = 0.29
MAX_SUM = 0.42


def let(value: Column, body) -> Column:
    """Evaluate ``value`` once and hand it to ``body`` as a lambda variable."""
    return F.element_at(F.transform(F.array(value), body), 1)


def words_of(text: Column) -> Column:
    """White-space separated words, in order."""
    return F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda w: w != "")


def repeated_window_words(words: Column, width: int = 3) -> Column:
    """Words inside windows of ``width`` words that occur twice or more in the list, first occurrence included.

    Windows are sorted by (hash of the words, place); neighbours of equal hash
    repeat.  The hash has 64 bits over the words themselves."""
    n = F.size(words)
    windows = F.transform(F.sequence(F.lit(0), n - width), lambda i: F.struct(
        F.xxhash64(*[F.get(words, i + k) for k in range(width)]).alias("h"), i.alias("i")))

    def count(sorted_windows: Column) -> Column:
        again = F.filter(sorted_windows, lambda w, k: (F.get(sorted_windows, k - 1)["h"] == w["h"])
                         | (F.get(sorted_windows, k + 1)["h"] == w["h"]))
        starts = F.sort_array(F.transform(again, lambda w: w["i"]))
        return let(starts, lambda s: F.aggregate(
            F.transform(s, lambda x, k: F.least(F.lit(width), F.coalesce(F.get(s, k + 1) - x, F.lit(width)))),
            F.lit(0).cast("long"), lambda a, x: a + x))

    return F.when(n > width, let(F.sort_array(windows), count)).otherwise(F.lit(0).cast("long"))


def word_histogram(words: Column) -> Column:
    """Common words of the list: array of struct(w, n), sorted by word."""
    held = F.sort_array(F.filter(words, lambda w: w.isin(VOCABULARY)))

    def runs(s: Column) -> Column:
        first = F.filter(F.sequence(F.lit(0), F.size(s) - 1), lambda i: (i == 0) | (F.get(s, i) != F.get(s, i - 1)))
        return let(first, lambda f: F.transform(f, lambda i, k: F.struct(
            F.get(s, i).alias("w"), (F.coalesce(F.get(f, k + 1), F.size(s)) - i).cast("long").alias("n"))))

    empty = F.array().cast("array<struct<w:string,n:bigint>>")
    return let(held, lambda s: F.when(F.size(s) > 0, runs(s)).otherwise(empty))


def class_counts(text: Column) -> Column:
    """Code points of each class: array of longs, in the order of CLASSES, then other."""
    n = F.length(text)
    held = [(n - F.length(F.regexp_replace(text, c + "+", ""))).cast("long") for c in CLASSES.values()]
    return let(F.array(*held), lambda a: F.concat(a, F.array(
        n.cast("long") - F.aggregate(a, F.lit(0).cast("long"), lambda s, x: s + x))))


def document_stats(docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """One row per row: key, lang, word and line counts, class counts and common-word histogram."""
    t = no_null_text(f"`{text}`")
    rows = docs.select(F.col(f"`{key}`").alias("key"), F.col(f"`{lang}`").alias("lang"), t.alias("text"))
    lines = F.filter(F.split("text", "\n"), lambda x: F.rlike(x, F.lit(r"[^\x20\x09-\x0D]")))
    per_word = let(words_of(F.col("text")), lambda w: F.struct(
        F.size(w).cast("long").alias("n_words"), F.length(F.array_join(w, "")).cast("long").alias("word_chars"),
        repeated_window_words(w).alias("n_repeat_words"), word_histogram(w).alias("common")))
    return rows.select(
        "key", "lang", per_word.alias("w"),
        (F.length("text") - F.length(F.regexp_replace("text", "[#*$%&|<>]+", ""))).cast("long").alias("n_symbols"),
        let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"),
        class_counts(F.col("text")).alias("classes"),
    ).select("key", "lang", "w.*", "n_symbols", "n_dup_lines", "classes")


def references(stats: DataFrame) -> DataFrame:
    """One row per language: shares of the character classes and of the common words over all its documents."""
    with_lang = stats.where(F.col("lang").isNotNull())
    n = len(CLASSES) + 1
    chars = with_lang.groupBy("lang").agg(*[F.sum(F.get("classes", F.lit(i)).cast("double")).alias(f"c{i}") for i in range(n)])
    total = sum((F.col(f"c{i}") for i in range(1, n)), F.col("c0"))
    chars = chars.where(total > 0).select("lang", F.array(*[F.col(f"c{i}") / total for i in range(n)]).alias("classes"))
    words = (with_lang.select("lang", F.inline("common")).groupBy("lang", "w").agg(F.sum("n").cast("double").alias("n"))
             .groupBy("lang").agg(F.map_from_entries(F.collect_list(F.struct("w", "n"))).alias("m")))
    n_words = with_lang.groupBy("lang").agg(F.sum("n_words").cast("double").alias("s")).where("s > 0")
    return chars.join(words, "lang", "left").join(n_words, "lang").select(
        "lang", "classes", F.transform_values("m", lambda _, v: v / F.col("s")).alias("words"))


def _half(p: Column, q: Column) -> Column:
    """One bin of the Jensen-Shannon divergence."""
    term = lambda x: F.when(x > 0, x * F.log2(2 * x / (p + q))).otherwise(F.lit(0.0))
    return (term(p) + term(q)) / 2


def _root(divergence: Column) -> Column:
    return F.sqrt(F.least(F.greatest(divergence, F.lit(0.0)), F.lit(1.0)))


def class_distance(counts: Column, reference: list[float]) -> Column:
    total = F.greatest(F.aggregate(counts, F.lit(0).cast("long"), lambda a, x: a + x), F.lit(1)).cast("double")
    bins = [_half(F.get(counts, F.lit(i)) / total, F.lit(q)) for i, q in enumerate(reference)]
    return _root(sum(bins[1:], bins[0]))


def word_distance(common: Column, n_words: Column, reference: dict[str, float]) -> Column:
    """All words that are not common share one bin; common words that the document lacks add half their reference share."""
    total = F.greatest(n_words, F.lit(1)).cast("double")
    share = F.create_map(*[F.lit(x) for w in sorted(reference) for x in (w, reference[w])]) if reference else F.create_map().cast("map<string,double>")
    rest = 1.0 - sum(reference.values())
    pairs = F.transform(common, lambda x: F.struct((x["n"] / total).alias("p"),
                                                   F.coalesce(F.element_at(share, x["w"]), F.lit(0.0)).alias("q")))
    p_rest = F.aggregate(common, total, lambda a, x: a - x["n"]) / total
    inside = F.aggregate(pairs, F.lit((1.0 - rest) / 2), lambda a, x: a + _half(x["p"], x["q"]) - x["q"] / 2)
    return _root(inside + _half(p_rest, F.lit(rest)))


def judge(stats: DataFrame, refs: list, max_char: float = MAX_CHAR_DISTANCE, max_word: float = MAX_WORD_DISTANCE,
          max_sum: float = MAX_SUM, min_chars: int = MIN_CHARS, min_words: int = BASE_MIN_WORDS) -> DataFrame:
    """``stats`` with char_distance, word_distance (smallest over the languages; NULL without references) and divergent.

    The class histogram is judged from ``min_chars`` code points on, the word
    histogram and the sum of both distances from ``min_words`` words on.  The
    distance of n words from their own language falls as 1/sqrt(n), so below
    STEADY_WORDS words their limits widen at that rate."""
    n_chars = F.aggregate("classes", F.lit(0).cast("long"), lambda a, x: a + x)
    least = lambda cols: cols[0] if len(cols) == 1 else F.least(*cols) if cols else F.lit(None).cast("double")
    out = stats.withColumns({
        "char_distance": least([class_distance(F.col("classes"), r["classes"]) for r in refs]),
        "word_distance": least([word_distance(F.col("common"), F.col("n_words"), r["words"] or {}) for r in refs]),
    })
    odd_chars = (n_chars >= min_chars) & (F.col("char_distance") > max_char)
    noise = F.greatest(1 / F.sqrt(F.greatest(F.col("n_words"), F.lit(1))) - F.lit(STEADY_WORDS ** -0.5), F.lit(0.0))
    odd_words = (F.col("n_words") >= min_words) & (
        (F.col("word_distance") > max_word + WORD_NOISE * noise)
        | (F.col("char_distance") + F.col("word_distance") > max_sum + SUM_NOISE * noise))
    return out.withColumn("divergent", F.coalesce(odd_chars, F.lit(False)) | F.coalesce(odd_words, F.lit(False)))


#: more languages than this raise: their references travel as literals of the plan
MAX_LANGUAGES = 500


def quality(docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang", **limits) -> DataFrame:
    """Counts, distances and verdict of every row.

    NULL and empty texts have zero counts and are never divergent; repeated rows
    are judged as rows of their own; a NULL language adds to no reference; other
    columns are not read; an empty table gives an empty result."""
    stats = checkpoint(document_stats(docs, key, text, lang))
    refs = references(stats).orderBy("lang").limit(MAX_LANGUAGES + 1).collect()
    if len(refs) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    return judge(stats, refs, **limits)
