"""Quality rules: counts of repetition and symbols, and divergence from a language's usual text.

Each language has two reference histograms, summed over all documents: of
character classes, and of common words. A document is compared with its
language's by Jensen-Shannon distance (base 2, so from 0 to 1). Short documents
say too little about their histograms, so each comparison has a least length.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import rows

# Common words by language.
COMMON_WORDS = {
    "en": "the of and to in a is that for it was on with as be at by this from are or an not his but have which had were they",
    "de": "der die und in den von zu das mit sich des auf für ist im dem nicht ein eine als auch es an werden aus er hat dass sie nach",
    "fr": "de la le et les des en un du une que est pour qui dans a par plus pas au sur ne se ce il sont avec son aux ou",
    "es": "de la que el en y a los del se las por un para con no una su al lo como más pero sus le ya o este sí porque",
}
SYMBOLS = "#*$%&|<>"
CLASSES = ("upper", "digit", "punct", "symbol", "space", "other")


@dataclass(frozen=True)
class Limits:
    min_words: int = 20
    max_repeat_percent: int = 30
    window: int = 8
    #: Comparisons start at these lengths.
    min_chars: int = 200
    min_letter_words: int = 80
    #: Distances above these fail.
    max_char_distance: float = 0.28
    max_word_distance: float = 0.36


def _kinds(text: Column) -> Column:
    """Counts of characters by kind. Most are white space or plain letters; what is left without them is counted by class."""
    left = lambda t, outside: F.length(F.regexp_replace(t, outside, "")).cast("long")

    def of(solid: Column) -> Column:
        return rows.let(F.regexp_replace(solid, "[a-z]+", ""), lambda rest: F.struct(
            F.length(solid).cast("long").alias("solid"), (F.length(text) - F.length(solid)).cast("long").alias("space"),
            left(rest, r"[^\p{Lu}]+").alias("upper"), left(rest, r"[^\p{Nd}]+").alias("digit"), left(rest, r"[^\p{P}]+").alias("punct"),
            left(rest, r"[^\p{S}]+").alias("symbol"), left(rest, "[^" + "".join("\\" + c for c in SYMBOLS) + "]+").alias("n_symbols")))

    return rows.let(F.regexp_replace(text, rows.SPACES, ""), of)


def _repeats(words: Column, window: int) -> Column:
    """How many words there are, and how many stand in a window of so many words that the text has twice or more."""
    def covered(hashes: Column) -> Column:
        def starts(s: Column) -> Column:
            same = lambda k, j: F.element_at(s, k)["h"] == F.element_at(s, j)["h"]
            n = F.size(s)
            found = F.filter(F.sequence(F.lit(1), n), lambda k: ((k > 1) & same(k, F.greatest(k - 1, F.lit(1)))) | ((k < n) & same(k, F.least(k + 1, n))))
            return F.array_sort(F.transform(found, lambda k: F.element_at(s, k)["i"]))

        at = rows.let(F.array_sort(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i")))), starts)
        zero = F.struct(F.lit(0).alias("sum"), F.lit(-window).alias("last"))
        step = lambda acc, i: F.struct((acc["sum"] + F.least(F.lit(window), i - acc["last"])).alias("sum"), i.alias("last"))
        return F.aggregate(at, zero, step, lambda acc: acc["sum"])

    def of(w: Column) -> Column:
        hashes = F.transform(F.sequence(F.lit(1), F.size(w) - (window - 1)), lambda i: F.xxhash64(F.slice(w, i, window)))
        repeats = F.when(F.size(w) < window, 0).otherwise(
            rows.let(hashes, lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), 0).otherwise(covered(h))))
        return F.struct(F.size(w).cast("long").alias("n_words"), repeats.cast("long").alias("n_repeat_words"))

    return rows.let(words, of)


def _dup_lines(text: Column) -> Column:
    lines = F.filter(F.split(text, "\n"), lambda line: F.trim(line, F.lit(rows.SPACE_CHARS)) != "")
    return rows.let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long")


def _said(text: Column) -> Column:
    """How many runs of letters a text has, and how often each of the common words, case aside."""
    known = sorted({w for listed in COMMON_WORDS.values() for w in listed.split()})
    letters = F.filter(F.split(F.lower(text), r"[^\p{L}]+"), lambda w: w != "")
    counts = lambda common: F.transform(F.array_distinct(common), lambda w: F.struct(
        w.alias("word"), (F.size(common) - F.size(F.array_remove(common, w))).cast("long").alias("n")))
    return rows.let(letters, lambda x: F.struct(F.size(x).cast("long").alias("letter_words"), rows.let(F.filter(x, lambda w: w.isin(known)), counts).alias("said")))


def measured(docs: DataFrame, key: str, text: str, lang: str, window: int) -> DataFrame:
    """All counts of each document, from one pass over the texts, written."""
    t = F.col("text")
    base = docs.select(F.col(key).alias("doc_id"), rows.whole(text).alias("text"),
                       F.when(F.col(lang).isin(*COMMON_WORDS), F.col(lang)).otherwise("other").alias("lang"))
    found = base.select("doc_id", "lang", F.length(t).cast("long").alias("chars"), _kinds(t).alias("kinds"), _said(t).alias("heard"),
                        _repeats(rows.words(t), window).alias("repeats"), _dup_lines(t).alias("n_dup_lines"))
    return rows.stored(found.select("doc_id", "lang", "chars", "kinds.*", "heard.*", "repeats.*", "n_dup_lines").withColumn(
        "other", F.col("chars") - sum(F.col(c) for c in CLASSES if c != "other")), "measured")


def references(counts: DataFrame) -> DataFrame:
    """``lang, ref_chars, ref_words``: shares of the classes, and of the common words, by language; a handful of rows."""
    chars = counts.groupBy("lang").agg(F.sum("chars").alias("all"), F.sum("letter_words").alias("all_words"), *[F.sum(c).alias(c) for c in CLASSES])
    said = counts.select("lang", F.inline("said")).groupBy("lang", "word").agg(F.sum("n").alias("n"))
    said = said.groupBy("lang").agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct("word", "n")))).alias("words"))
    share = lambda n, of: n.cast("double") / F.nullif(of, F.lit(0)).cast("double")
    none = F.create_map().cast("map<string,bigint>")
    return chars.join(said, "lang", "left").select(
        "lang", F.array(*[share(F.col(c), F.col("all")) for c in CLASSES]).alias("ref_chars"),
        F.transform_values(F.coalesce("words", none), lambda _, n: share(n, F.col("all_words"))).alias("ref_words"))


def _distance(pairs: Column) -> Column:
    """Jensen-Shannon distance of the pairs of shares ``p, q`` (p over 0); what is left of q lies where p is 0."""
    part = lambda x, m: F.when(x > 0, x * F.log2(x / m)).otherwise(0.0)
    zero = F.struct(F.lit(0.0).alias("js"), F.lit(0.0).alias("q"))
    step = lambda acc, x: F.struct((acc["js"] + part(x["p"], (x["p"] + x["q"]) / 2) + part(x["q"], (x["p"] + x["q"]) / 2)).alias("js"), (acc["q"] + x["q"]).alias("q"))
    return F.aggregate(pairs, zero, step, lambda acc: F.sqrt(F.greatest(F.lit(0.0), F.least(F.lit(1.0), (acc["js"] + 1 - acc["q"]) / 2))))


def _char_distance() -> Column:
    shares = F.array(*[F.struct((F.col(c) / F.nullif(F.col("chars"), F.lit(0))).alias("p"), F.element_at("ref_chars", i + 1).alias("q")) for i, c in enumerate(CLASSES)])
    return _distance(F.filter(shares, lambda x: x["p"] > 0))


def _word_distance() -> Column:
    n, ref = F.col("letter_words"), F.col("ref_words")
    said = F.transform("said", lambda x: F.struct((x["n"] / n).alias("p"), F.coalesce(F.try_element_at(ref, x["word"]), F.lit(0.0)).alias("q")))
    add = lambda values, of: F.aggregate(values, F.lit(0.0), lambda a, x: a + of(x))
    rest = F.array(F.struct((1 - add(F.col("said"), lambda x: x["n"] / n)).alias("p"), (1 - add(F.map_values(ref), lambda x: x)).alias("q")))
    return _distance(F.filter(F.concat(said, rest), lambda x: x["p"] > 0))


def judge(docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang", limits: Limits = Limits()) -> DataFrame:
    """One row per row of ``docs``: the key, the counts, ``base_failed``, ``kept``, and both distances.

    ``n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words`` count over the
    whole text; a null text has no words. ``char_distance`` and ``word_distance``
    are null below their least length, and then do not count. A language without
    a list of common words, or none, is compared with all such documents together.
    An empty table gives no rows; repeated rows stay; other columns are ignored.
    """
    counts = measured(docs, key, text, lang, limits.window)
    # One row for each listed language and one for all others: small whatever the input.
    refs = F.broadcast(rows.stored(references(counts), "language-references"))
    counted = (counts.join(refs, "lang", "left").withColumn("word_chars", F.col("solid"))
               .withColumn("char_distance", F.when(F.col("chars") >= limits.min_chars, _char_distance()))
               .withColumn("word_distance", F.when(F.col("letter_words") >= limits.min_letter_words, _word_distance())))
    n = F.col("n_words")
    failed = (n < limits.min_words) | (100 * F.col("n_repeat_words") > limits.max_repeat_percent * n)
    usual = (F.coalesce("char_distance", F.lit(0.0)) <= limits.max_char_distance) & (F.coalesce("word_distance", F.lit(0.0)) <= limits.max_word_distance)
    return counted.select(F.col("doc_id").alias(key), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                          failed.alias("base_failed"), (~failed & usual).alias("kept"), "char_distance", "word_distance")
