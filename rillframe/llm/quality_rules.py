"""Quality rules by distribution divergence, as native expressions only.

A text is compared with the reference of its language: the Jensen-Shannon distance (base 2, so 0 to 1) of its
character-class histogram, and that of its common-word histogram. References are summed over all texts that are
long enough, so a text weighs by its length; short texts are guarded: below ``min_chars`` or ``min_words`` the distance is null and rejects nothing.

One pass over the text stages each row with its histograms; references are summed from those (a shuffle of a few
histogram rows), a row for each language, and joined to them; that of all texts is a constant of the plan.

Defined cases: null or empty text has no words, fails the base rule and is rejected; a null language, or one
without a text that is long enough, takes the reference of all texts; equal rows get equal verdicts; an empty table gives an empty result; other columns of
the input pass through, and a clashing name keeps the input's column (the feature gets leading underscores).
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rillframe.llm.common import SPACE, let, staged, unused

# Frequent function words of four languages.
COMMON_WORDS = {
    "en": "the of and to in is that it for was on are as with at be this by from or",
    "de": "der die und in den von zu das mit sich des auf für ist im dem nicht ein eine als",
    "fr": "de la le et les des en un du une que est pour qui dans par sur pas au avec",
    "es": "de la que el en y los del se las por un para con no una su al lo es",
}
VOCABULARY = sorted({w for words in COMMON_WORDS.values() for w in words.split()})

# Character classes told apart among what is neither a-z nor white space, each by what it does not hold.
CLASSES = {"upper": "[^A-Z]+", "digit": "[^0-9]+", "symbol": "[^#*$%&|<>]+", "foreign": r"[\x00-\x7F]+"}
ORDER = ["lower", "space", *CLASSES, "other"]


@dataclass(frozen=True)
class Divergence:
    """Thresholds. A distance above its maximum rejects."""

    min_words: int = 10
    max_repeat_percent: int = 20
    min_chars_judged: int = 400
    min_words_judged: int = 80
    max_char_distance: float = 0.3
    max_word_distance: float = 0.28


def words_of(text: Column) -> Column:
    return F.filter(F.split(F.regexp_replace(text, r"[\x09-\x0D]", " "), " "), lambda w: w != "")  # one plain character splits fastest


def repeated_words(words: Column) -> Column:
    """How many words lie in a five-word window that the text holds twice or more.

    Windows are compared by 64-bit hashes. Only texts in which a hash recurs pay for sorting them, and only those in
    which more than 32 recur for sorting them with their places.
    """

    def covered(places: Column) -> Column:
        return F.aggregate(F.transform(places, lambda at, k: F.least(F.lit(5), F.coalesce(F.get(places, k + 1) - at, F.lit(5)))), F.lit(0), lambda a, b: a + b)

    def few(hashes: Column, recurring: Column) -> Column:
        return F.filter(F.transform(hashes, lambda h, i: F.when(F.array_contains(recurring, h), i)), lambda i: i.isNotNull())

    def many(hashes: Column) -> Column:
        placed = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        return let(placed, lambda s: F.sort_array(F.transform(F.filter(s, lambda e, k: (e["h"] == F.get(s, k - 1)["h"]) | (e["h"] == F.get(s, k + 1)["h"])), lambda e: e["i"])))

    def recurring(hashes: Column) -> Column:
        return let(F.sort_array(hashes), lambda s: F.array_distinct(F.filter(s, lambda h, k: h == F.get(s, k + 1))))

    def count(hashes: Column) -> Column:
        places = let(recurring(hashes), lambda r: F.when(F.size(r) <= 32, few(hashes, r)).otherwise(many(hashes)))
        return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), F.lit(0)).otherwise(let(places, covered))

    windows = F.transform(F.slice(words, 1, F.greatest(F.size(words) - 4, F.lit(0))), lambda w, i: F.xxhash64(w, *[F.get(words, i + k) for k in range(1, 5)]))
    return F.when(F.size(words) < 6, F.lit(0)).otherwise(let(windows, count))


def duplicate_lines(text: Column) -> Column:
    return let(F.filter(F.split(text, "\n"), lambda line: line.rlike(f"[^{SPACE}]")), lambda lines: F.size(lines) - F.size(F.array_distinct(lines)))


def class_counts(text: Column, word_chars: Column) -> Column:
    """Characters by class, in ORDER."""

    def split_up(rest: Column) -> Column:
        special = F.array(*[F.length(F.regexp_replace(rest, others, "")).cast("long") for others in CLASSES.values()])
        space = F.length(text).cast("long") - word_chars
        return let(special, lambda c: F.concat(F.array(F.length(text) - F.length(rest) - space, space), c, F.array(F.length(rest) - reduce(lambda a, b: a + b, [c[i] for i in range(len(CLASSES))]))))

    return let(F.regexp_replace(text, f"[a-z{SPACE}]+", ""), split_up)


def common_words(words: Column) -> Column:
    """Sorted occurrences of the vocabulary among words, without case and punctuation at their end."""
    longest = max(len(w.encode()) for w in VOCABULARY) + 2
    bare = F.transform(F.filter(words, lambda w: F.octet_length(w) <= longest), lambda w: F.rtrim(F.lower(w), F.lit(".,;:!?")))
    return F.array_sort(F.filter(bare, lambda w: w.isin(VOCABULARY)))


def counted(hits: Column) -> Column:
    """(word, count) of a sorted array of words."""

    def count(h: Column) -> Column:
        starts = F.filter(F.transform(h, lambda w, i: F.when((i == 0) | (w != F.get(h, i - 1)), F.struct(w.alias("word"), i.alias("at")))), lambda e: e.isNotNull())
        return let(starts, lambda s: F.transform(s, lambda e, k: F.struct(e["word"].alias("word"), (F.coalesce(F.get(s, k + 1)["at"], F.size(h)) - e["at"]).cast("long").alias("n"))))

    return let(hits, count)


def histograms(text: Column, repeats: bool = False) -> Column:
    """What one pass over a text gives: n_words, word_chars, chars (by class), hits (common words) and, if asked for, n_repeat_words."""
    text = F.coalesce(text, F.lit(""))

    def of(words: Column) -> Column:
        n_chars = F.length(F.array_join(words, "")).cast("long")
        more = [repeated_words(words).cast("long").alias("n_repeat_words")] if repeats else []
        return let(n_chars, lambda n: F.struct(F.size(words).cast("long").alias("n_words"), n.alias("word_chars"), class_counts(text, n).alias("chars"), counted(common_words(words)).alias("hits"), *more))

    return let(words_of(text), of)


def total(values: Column) -> Column:
    return F.aggregate(values, F.lit(0).cast("long"), lambda a, b: a + b)


def fit_references(measured: DataFrame, rule: Divergence = Divergence()) -> DataFrame:
    """From (lang, h: what ``histograms`` gives): one row per language and one with a null language for all texts: chars array<double>, words map<string,double>.

    Sums over every text that the guards let through, summed before they are shuffled.
    """
    entry = lambda kind, key, n: F.struct(F.lit(kind).alias("kind"), key.cast("string").alias("key"), n.cast("long").alias("n"))

    def entries(h: Column) -> Column:
        none = F.array().cast("array<struct<kind:string,key:string,n:bigint>>")
        chars = F.when(total(h["chars"]) >= rule.min_chars_judged, F.transform(h["chars"], lambda n, i: entry("char", i, n))).otherwise(none)
        words = F.when(h["n_words"] >= rule.min_words_judged, F.concat(F.transform(h["hits"], lambda e: entry("word", e["word"], e["n"])), F.array(entry("words", F.lit(""), h["n_words"])))).otherwise(none)
        return F.concat(chars, words)

    rows = measured.select(F.col("lang").cast("string").alias("lang"), F.explode(let(F.col("h"), entries)).alias("e"))
    sums = staged(rows.groupBy("lang", F.col("e.kind").alias("kind"), F.col("e.key").alias("key")).agg(F.sum("e.n").alias("n")), "references")
    pooled = sums.groupBy("kind", "key").agg(F.sum("n").alias("n")).select(F.lit(None).cast("string").alias("lang"), "kind", "key", "n")
    per = sums.where(F.col("lang").isNotNull()).unionByName(pooled).groupBy("lang").agg(*[F.sort_array(F.collect_list(F.when(F.col("kind") == k, F.struct("key", "n")))).alias(k) for k in ("char", "word")], F.sum(F.when(F.col("kind") == "words", F.col("n"))).alias("words"))
    counts = F.transform(F.sequence(F.lit(0), F.lit(len(ORDER) - 1)), lambda i: F.element_at(F.transform(F.filter("char", lambda e: e["key"] == i.cast("string")), lambda e: e["n"]), 1))
    return staged(per.where((F.size("char") > 0) & (F.col("words") > 0)).select("lang", let(counts, lambda c: F.transform(c, lambda n: n / total(c))).alias("chars"), F.map_from_entries(F.transform("word", lambda e: F.struct(e["key"], e["n"] / F.col("words")))).alias("words")), "references")


def _part(p: Column, q: Column) -> Column:
    """What one value adds to the Jensen-Shannon divergence."""
    m = (p + q) / 2
    half = lambda x: F.when(x > 0, x * F.log2(x / m) / 2).otherwise(0.0)
    return half(p) + half(q)


def char_distance(counts: Column, reference: Column) -> Column:
    def distance(n: Column) -> Column:
        parts = F.zip_with(counts, reference, lambda c, q: _part(c / n, q))
        return F.sqrt(F.greatest(F.lit(0.0), F.aggregate(parts, F.lit(0.0), lambda a, b: a + b)))

    return let(total(counts).cast("double"), distance)


def word_distance(found: Column, reference: Column) -> Column:
    """Over the vocabulary and one value for all other words. Words that a text lacks add half their share."""
    none = F.struct(F.lit(0.0).alias("d"), F.lit(0.0).alias("p"), F.lit(0.0).alias("q"))

    def add(acc: Column, e: Column) -> Column:
        p, q = e["n"] / found["n_words"], F.coalesce(F.element_at(reference, e["word"]), F.lit(0.0))
        return F.struct((acc["d"] + _part(p, q)).alias("d"), (acc["p"] + p).alias("p"), (acc["q"] + q).alias("q"))

    shared = F.aggregate(F.map_values(reference), F.lit(0.0), lambda a, b: a + b)
    return let(F.aggregate(found["hits"], none, add), lambda s: F.sqrt(F.greatest(F.lit(0.0), s["d"] + F.greatest(F.lit(0.0), shared - s["q"]) / 2 + _part(F.greatest(F.lit(0.0), 1 - s["p"]), F.greatest(F.lit(0.0), 1 - shared)))))


FEATURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "char_distance", "word_distance", "base_failed", "kept"]


def judge(docs: DataFrame, rule: Divergence = Divergence(), references: DataFrame | None = None, text: str = "text", lang: str = "lang", without: str | None = None) -> DataFrame:
    """``docs``, but for the column ``without``, with FEATURES.

    A name that ``docs`` has already gets leading underscores (see ``feature_names``).
    """
    names = dict(zip(FEATURES, feature_names(docs), strict=True))
    seen, lines, key, key0, chars, words = unused(docs, "seen", "lines", "ref_lang", "own_lang", "ref_chars", "ref_words")
    own_columns = [c for c in docs.columns if c != without]
    rows = docs.withColumns({seen: histograms(F.col(text), repeats=True), lines: duplicate_lines(F.coalesce(text, F.lit(""))).cast("long")})
    rows = staged(rows.select(*[F.col(f"`{c}`") for c in own_columns], seen, lines), "measured")  # one pass over the text serves both steps
    references = fit_references(rows.select(F.col(lang).alias("lang"), F.col(seen).alias("h")), rule) if references is None else references
    pooled = references.where(F.col("lang").isNull()).first()
    all_chars = F.array(*map(F.lit, pooled["chars"])) if pooled else F.lit(None).cast("array<double>")
    all_words = F.create_map(*[F.lit(x) for e in sorted(pooled["words"].items()) for x in e]).cast("map<string,double>") if pooled else F.lit(None).cast("map<string,double>")
    refs = references.where(F.col("lang").isNotNull()).select(F.col("lang").alias(key), F.col("chars").alias(chars), F.col("words").alias(words))
    rows = rows.withColumn(key0, F.col(lang).cast("string")).join(refs, F.col(key0) == F.col(key), "left")
    h = F.col(seen)
    d_char = F.when(total(h["chars"]) >= rule.min_chars_judged, char_distance(h["chars"], F.coalesce(F.col(chars), all_chars)))
    d_word = F.when(h["n_words"] >= rule.min_words_judged, word_distance(h, F.coalesce(F.col(words), all_words)))
    failed = (h["n_words"] < rule.min_words) | (100 * h["n_repeat_words"] > rule.max_repeat_percent * h["n_words"])
    made = {
        "n_words": h["n_words"], "word_chars": h["word_chars"], "n_symbols": h["chars"][ORDER.index("symbol")], "n_dup_lines": F.col(lines),
        "n_repeat_words": h["n_repeat_words"], "char_distance": d_char, "word_distance": d_word, "base_failed": failed,
    }
    rows = rows.select(*[F.col(f"`{c}`") for c in own_columns], *[made[n].alias(names[n]) for n in FEATURES[:-1]])
    near = lambda name, most: F.coalesce(F.col(names[name]), F.lit(0.0)) <= most
    return rows.withColumn(names["kept"], ~F.col(names["base_failed"]) & near("char_distance", rule.max_char_distance) & near("word_distance", rule.max_word_distance))


def feature_names(docs: DataFrame) -> list[str]:
    return unused(docs, *FEATURES)


def keep(docs: DataFrame, rule: Divergence = Divergence()) -> DataFrame:
    """The rows of ``docs`` that the rules keep, with its columns."""
    return judge(docs, rule).where(F.col(feature_names(docs)[-1])).select(*[F.col(f"`{c}`") for c in docs.columns])
