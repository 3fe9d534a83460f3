"""Quality rules by distribution divergence, in DataFrame functions only.

A text is compared with its language's reference twice: by the histogram of
character classes and by that of the language's common words. References are
sums over all texts of the language, folded in each task, one row for each
configured language, so broadcasting them is bounded by that list. The measure
is the Jensen-Shannon distance (base 2, so 0 to 1). A text too short for a
stable histogram is not judged by it.

Base rules come first: too few words, or too many words in repeated windows.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from metricloom.llm.common import let

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
MIN_CHARS_JUDGED = 300
MIN_WORDS_JUDGED = MIN_WORDS
# Largest distance: a limit for endless text, and a slack over the square root
# of the length, since a short text strays from its language by chance alone.
CHAR_LIMIT, CHAR_SLACK = 0.17, 2.4
# By chance alone the squared distance of n words in k classes is (k - 1) / (8 ln 2 n)
# on average, so 1.47 / sqrt(n) for 13 classes; the margin is for the spread about it.
WORD_LIMIT, WORD_MARGIN = 0.07, 0.53

#: The most common words of each language.
COMMON_WORDS = {
    "en": ["the", "of", "and", "to", "in", "a", "is", "that", "for", "was", "with", "on"],
    "de": ["der", "die", "und", "in", "den", "von", "zu", "das", "mit", "sich", "ist", "ein"],
    "fr": ["de", "la", "le", "et", "les", "des", "en", "un", "que", "est", "pour", "dans"],
    "es": ["de", "la", "que", "el", "en", "y", "a", "los", "se", "del", "las", "un"],
}
#: Character classes, taken out of a text one after the other; the rest is non-ASCII.
CLASSES = {
    "lower": "[a-z]+",
    "space": r"[\x20\x09-\x0D]+",
    "upper": "[A-Z]+",
    "digit": "[0-9]+",
    "mark": r"[.,;:!?'\"()\-]+",
    "other": r"[\x00-\x7F]+",
}
SYMBOLS = "#*$%&|<>"
SPACES = " \t\n\x0b\x0c\r"
N_CLASSES = len(CLASSES) + 1
N_COMMON = 12
WORD_SLACK = round(math.sqrt(N_COMMON / (8 * math.log(2))) + WORD_MARGIN, 2)


def with_words(rows: DataFrame) -> DataFrame:
    """Adds ``words``; ``t`` is the text, never null."""
    trimmed = F.btrim("t", F.lit(SPACES))
    split = F.split(trimmed, r"[\x20\x09-\x0D]+")
    return rows.withColumn("words", F.when(trimmed == "", F.array().cast("array<string>")).otherwise(split))


def with_classes(rows: DataFrame) -> DataFrame:
    """Adds ``chars`` (code points by class) and ``n_symbols``."""
    left, counts = "t", []
    for name, pattern in CLASSES.items():
        if name == "other":
            rows = rows.withColumn(
                "n_symbols",
                (F.length(left) - F.length(F.translate(left, SYMBOLS, ""))).cast("long"),
            )
        rows = rows.withColumn(f"_{name}", F.regexp_replace(left, pattern, ""))
        counts.append(F.length(left) - F.length(f"_{name}"))
        left = f"_{name}"
    counts.append(F.length(left))
    return rows.withColumn("chars", F.array(*[c.cast("long") for c in counts]))


def common_words(lang: Column) -> Column:
    """The common words of a language; null for one that is not configured."""
    return reduce(
        lambda out, item: out.when(lang == item[0], F.array(*map(F.lit, item[1]))),
        list(COMMON_WORDS.items())[1:],
        F.when(lang == "en", F.array(*map(F.lit, COMMON_WORDS["en"]))),
    )


def with_common(rows: DataFrame) -> DataFrame:
    """Adds ``commons``: counts of the language's common words, and of all others."""
    rows = rows.withColumn("list", common_words(F.col("lang"))).withColumn(
        "found", F.filter("words", lambda w: F.array_contains(F.col("list"), w))
    )
    counts = F.transform("list", lambda c: F.size(F.filter("found", lambda w: w == c)).cast("long"))
    return rows.withColumn(
        "commons", F.concat(counts, F.array((F.size("words") - F.size("found")).cast("long")))
    )


def repeated_words(words: Column) -> Column:
    """Words in 3-word windows that occur twice or more in the text.

    Windows are sorted by hash beside their place; neighbours of equal hash
    are repeats. Each covers its words up to the next repeat.
    """

    def covered(places: Column) -> Column:
        last = F.size(places) - 1
        return F.aggregate(
            F.transform(
                places,
                lambda p, i: F.when(i == last, 3).otherwise(F.least(F.lit(3), F.get(places, i + 1) - p)),
            ),
            F.lit(0), lambda s, x: s + x,
        )

    def by_hash(sorted_: Column) -> Column:
        same = lambda i, j: F.coalesce(
            F.get(sorted_, i)["h"] == F.get(sorted_, j)["h"], F.lit(False)
        )
        repeats = F.filter(sorted_, lambda x, i: same(i, i + 1) | same(i, i - 1))
        return let(F.sort_array(F.transform(repeats, lambda x: x["i"])), covered)

    def grams(w: Column) -> Column:
        hashes = F.transform(
            F.sequence(F.lit(0), F.size(w) - 3),
            lambda i: F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)),
        )
        return let(
            hashes,
            lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(
                let(
                    F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i")))),
                    by_hash,
                )
            ),
        )

    return F.when(F.size(words) >= 3, let(words, grams)).otherwise(F.lit(0)).cast("long")


def with_base(rows: DataFrame) -> DataFrame:
    """Adds the base counts."""
    lines = F.filter(F.split("t", "\n"), lambda x: F.btrim(x, F.lit(SPACES)) != "")
    return rows.withColumns({
        "n_words": F.size("words").cast("long"),
        "word_chars": (F.length("t") - F.element_at("chars", 2)).cast("long"),
        "n_dup_lines": let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long"),
        "n_repeat_words": repeated_words(F.col("words")),
    })


def prepared(docs: DataFrame, carry: list[str], text_col: str, lang_col: str) -> DataFrame:
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in carry]).alias("row"),
        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("t"),
        F.col(lang_col).cast("string").alias("lang"),
    )
    return with_common(with_classes(with_words(rows)))


def references(rows: DataFrame) -> DataFrame:
    """(lang, char_ref, word_ref): shares over all texts of each configured language."""
    sums = rows.where(F.col("lang").isin(list(COMMON_WORDS))).groupBy("lang").agg(
        *[F.sum(F.col("chars")[i]).alias(f"c{i}") for i in range(N_CLASSES)],
        *[F.sum(F.col("commons")[i]).alias(f"w{i}") for i in range(N_COMMON + 1)],
    )

    def shares(letter: str, n: int) -> Column:
        names = [F.col(f"{letter}{i}") for i in range(n)]
        total = reduce(lambda a, b: a + b, names)
        return F.when(total > 0, F.array(*[x / total for x in names]))

    return sums.select(
        "lang", shares("c", N_CLASSES).alias("char_ref"), shares("w", N_COMMON + 1).alias("word_ref")
    )


def distance(counts: Column, reference: Column) -> Column:
    """Jensen-Shannon distance of a histogram of counts from reference shares."""

    def part(p: Column, q: Column) -> Column:
        log = lambda x, y: F.when(x > 0, x * F.log2(x / ((x + y) / 2))).otherwise(0.0)
        return (log(p, q) + log(q, p)) / 2

    total = F.aggregate(counts, F.lit(0).cast("long"), lambda s, x: s + x)
    terms = let(total, lambda n: F.zip_with(counts, reference, lambda c, q: part(c / n, q)))
    sum_ = F.aggregate(terms, F.lit(0.0), lambda s, x: s + x)
    return F.when(total > 0, F.sqrt(F.greatest(sum_, F.lit(0.0))))


def judged(
    docs: DataFrame, carry: list[str], text_col: str = "text", lang_col: str = "lang"
) -> DataFrame:
    """row, the base counts, n_chars, base_failed, char_distance, word_distance, kept.

    ``row`` holds the columns ``carry`` as a struct, whatever their names. A
    null or empty text has no words and fails the base rules. A text whose
    language is null or not configured, or which is too short for a
    histogram, is judged by the base rules alone; its distances are null.
    Repeated rows are judged alike. An empty table gives no row.
    """
    rows = prepared(docs, carry, text_col, lang_col)
    judged_by = with_base(rows).join(F.broadcast(references(rows)), "lang", "left")
    chars = F.length("t") >= MIN_CHARS_JUDGED
    words = F.col("n_words") >= MIN_WORDS_JUDGED
    out = judged_by.select(
        "row", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        F.length("t").cast("long").alias("n_chars"),
        F.when(chars, distance(F.col("chars"), F.col("char_ref"))).alias("char_distance"),
        F.when(words, distance(F.col("commons"), F.col("word_ref"))).alias("word_distance"),
        (
            (F.col("n_words") < MIN_WORDS)
            | (F.col("n_repeat_words") * 100 > F.col("n_words") * MAX_REPEAT_PERCENT)
        ).alias("base_failed"),
    )
    near = lambda name, n, limit, slack: F.coalesce(
        F.col(name) <= limit + slack / F.sqrt(n), F.lit(True)
    )
    return out.withColumn(
        "kept",
        ~F.col("base_failed")
        & near("char_distance", "n_chars", CHAR_LIMIT, CHAR_SLACK)
        & near("word_distance", "n_words", WORD_LIMIT, WORD_SLACK),
    )


def kept(docs: DataFrame, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """The rows of ``docs`` that pass, with their columns as they are."""
    return judged(docs, docs.columns, text_col, lang_col).where("kept").select("row.*")
