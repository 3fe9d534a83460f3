"""Benchmark decontamination with a distributed positional inverted index.

The index holds postings (term, text, position) of the corpus, and only those
a benchmark phrase can need:

1. the corpus frequency of every benchmark term is counted (folded in each
   task before it is shuffled);
2. each phrase of ``window`` item words picks its rarest term as anchor;
   neighbouring phrases mostly share one, so an item has few anchors;
3. anchors' postings are looked up, each with the words around it, and their
   lists are adjusted by the anchor's place in the item, which gives an
   alignment (text, item, shift). The adjusted lists of the other terms are
   intersected right there: the words around the posting are compared with
   the item's, and the run of equal words that holds the anchor must be as
   long as a phrase. A common phrase costs one row for each anchor, not one
   for each word or phrase;
4. runs are merged to positions for each text, exact copies of a text once.

Everything is DataFrame code. Anchors are broadcast when they are counted to
be few, and joined by shuffle otherwise.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from metricloom.llm.common import let, lower_ascii, stored

WINDOW = 13
PERCENT = 5  # of a text's words
BROADCAST_TERMS = 200_000
#: What separates words: ASCII that is neither a digit nor a letter of either case.
BREAKS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def pieces(text: Column) -> Column:
    """Words as written; the first and the last piece may be empty.

    Case is folded word by word in :func:`term`, after words are exploded and
    inside generated code; positions may be off by one throughout a text.
    """
    return F.split(F.coalesce(text.cast("string"), F.lit("")), BREAKS)


def term(word: Column) -> Column:
    """``word`` with A-Z in lower case; other letters stay as they are."""
    ascii_only = F.octet_length(word) == F.length(word)
    return F.when(ascii_only, F.lower(word)).otherwise(lower_ascii(word))


def word_count(text: Column) -> Column:
    return let(
        pieces(text),
        lambda p: F.size(p)
        - F.when(p[0] == "", 1).otherwise(0)
        - F.when((F.size(p) > 1) & (F.element_at(p, -1) == ""), 1).otherwise(0),
    ).cast("long")


def _bounded(df: DataFrame, limit: int) -> DataFrame:
    """A broadcast side if it is counted to be small, else a plain one."""
    return F.broadcast(df) if df.count() <= limit else df


def text_key(text: Column) -> Column:
    return F.md5(F.coalesce(text.cast("string"), F.lit("")).cast("binary"))


def item_words(items: DataFrame, item_col: str, text_col: str) -> DataFrame:
    """(item, i, term, n) for each word of each distinct item text."""
    rows = items.select(
        F.col(item_col).cast("string").alias("item"),
        F.transform(F.filter(pieces(F.col(text_col)), lambda w: w != ""), term).alias("words"),
    ).distinct()
    return rows.select(
        "item", "words", F.size("words").alias("n"), F.posexplode("words").alias("i", "term")
    )


def term_frequencies(docs: DataFrame, text_col: str, terms: DataFrame) -> DataFrame:
    """(term, df): how often each of ``terms`` occurs in the corpus."""
    every = docs.select(F.explode(pieces(F.col(text_col))).alias("word"))
    return every.select(term(F.col("word")).alias("term")).join(terms, "term").groupBy("term").agg(F.count("*").alias("freq"))


def anchors(positions: DataFrame, frequencies: DataFrame, window: int) -> DataFrame:
    """(term, item, i, around, left): anchors of all phrases of an item.

    ``around`` is the item from ``left`` words before the anchor on, as far as
    a phrase that holds the anchor can reach; ``need`` is the phrase's length.
    An item that holds a term the corpus lacks in every phrase has none.
    """
    size = F.least(F.col("n"), F.lit(window))
    known = positions.join(frequencies, "term", "left").withColumn(
        "freq", F.coalesce("freq", F.lit(0).cast("long"))
    )
    phrases = known.select(
        "item", "words", "n", "i", "term", "freq",
        F.explode(
            F.sequence(
                F.greatest(F.col("i") - size + 1, F.lit(0)),
                F.least(F.col("i"), F.col("n") - size),
            )
        ).alias("start"),
    )
    rarest = phrases.groupBy("item", "words", "n", "start").agg(
        F.min(F.struct("freq", "term", "i")).alias("a")
    )
    left = F.least(F.col("a.i"), size - 1)
    return (
        rarest.where("a.freq > 0")
        .select(
            F.col("a.term").alias("term"), "item", F.col("a.i").alias("i"),
            left.alias("left"), size.alias("need"),
            F.slice("words", F.col("a.i") - left + 1, left + size).alias("around"),
        )
        .distinct()
    )


def _run(mine: Column, theirs: Column, at: Column, other: Column, step: int, most: int) -> Column:
    """Equal words from ``at``/``other`` on in one direction, the anchors not counted."""
    steps = F.sequence(F.lit(1), F.lit(most))
    differ = F.filter(
        steps,
        lambda k: ~F.coalesce(
            F.get(mine, at + k * step) == F.get(theirs, other + k * step), F.lit(False)
        ),
    )
    return F.coalesce(F.get(differ, F.lit(0)), F.lit(most + 1)) - 1


def postings(docs: DataFrame, text_col: str, terms: DataFrame, reach: int) -> DataFrame:
    """(term, key, at, context, c): postings of ``terms`` with ``reach`` words around."""
    rows = docs.select(
        text_key(F.col(text_col)).alias("key"), pieces(F.col(text_col)).alias("words")
    ).select("key", "words", F.posexplode("words").alias("at", "word"))
    c = F.least(F.col("at"), F.lit(reach))
    context = F.slice("words", F.col("at") - c + 1, c + reach + 1)
    return rows.withColumn("term", term(F.col("word"))).join(terms, "term").select(
        "term", "key", "at", c.alias("c"), F.transform(context, term).alias("context")
    )


def phrase_matches(
    docs: DataFrame, items: DataFrame, text_col: str = "text", item_col: str = "item_id",
    item_text_col: str = "text", window: int = WINDOW,
) -> DataFrame:
    """(key, item, lo, hi): runs of item words found in a text.

    A run covers words ``lo .. hi`` of the text with digest ``key``. Every
    word of a run lies in an occurrence of a phrase, and each occurrence of
    each phrase lies in a run.
    """
    positions = item_words(items, item_col, item_text_col)
    terms = _bounded(positions.select("term").distinct(), BROADCAST_TERMS)
    found = stored(anchors(positions, term_frequencies(docs, text_col, terms), window), "anchors")
    distinct_terms = _bounded(found.select("term").distinct(), BROADCAST_TERMS)
    aligned = postings(docs, text_col, distinct_terms, window - 1).join(found, "term")
    most = window - 1
    back = _run(F.col("context"), F.col("around"), F.col("c"), F.col("left"), -1, most)
    ahead = _run(F.col("context"), F.col("around"), F.col("c"), F.col("left"), 1, most)
    runs = aligned.select("key", "item", "at", "need", back.alias("b"), ahead.alias("f"))
    return runs.where(F.col("b") + F.col("f") + 1 >= F.col("need")).select(
        "key", "item", (F.col("at") - F.col("b")).alias("lo"), (F.col("at") + F.col("f")).alias("hi")
    )


def proximity_matches(
    docs: DataFrame, items: DataFrame, slop: int = 20, text_col: str = "text",
    item_col: str = "item_id", item_text_col: str = "text", window: int = WINDOW,
) -> DataFrame:
    """(key, item, at, other): two rarest terms of a phrase at most ``slop`` apart.

    A looser net than :func:`phrase_matches`, for reworded passages: ``at``
    and ``other`` are positions of the phrase's rarest and second rarest
    distinct terms that lie within ``slop`` words of each other.
    """
    positions = item_words(items, item_col, item_text_col)
    terms = _bounded(positions.select("term").distinct(), BROADCAST_TERMS)
    freq = term_frequencies(docs, text_col, terms)
    size = F.least(F.col("n"), F.lit(window))
    phrases = positions.join(freq, "term").select(
        "item", "words", "term", "freq",
        F.explode(F.sequence(
            F.greatest(F.col("i") - size + 1, F.lit(0)), F.least(F.col("i"), F.col("n") - size)
        )).alias("start"),
    )
    two = (
        phrases.groupBy("item", "words", "start")
        .agg(F.slice(F.array_sort(F.collect_set(F.struct("freq", "term"))), 1, 2).alias("two"))
        .where(F.size("two") == 2)
        .select("item", F.col("two")[0]["term"].alias("term"), F.col("two")[1]["term"].alias("second"))
        .distinct()
    )
    wanted = _bounded(
        two.select("term").union(two.select(F.col("second").alias("term"))).distinct(), BROADCAST_TERMS
    )
    index = docs.select(
        text_key(F.col(text_col)).alias("key"), F.posexplode(pieces(F.col(text_col))).alias("at", "word")
    ).select("key", "at", term(F.col("word")).alias("term")).join(wanted, "term").distinct()
    # Positions meet in buckets of slop words, so a list is never paired with itself whole.
    bucket = F.floor(F.col("at") / F.lit(max(slop, 1)))
    near = F.explode(F.array(bucket - 1, bucket, bucket + 1))
    first = index.join(two, "term").select("key", "item", "second", "at", near.alias("bucket"))
    other = index.select("key", F.col("term").alias("second"), F.col("at").alias("other"), bucket.alias("bucket"))
    return (
        first.join(other, ["key", "second", "bucket"])
        .where(F.abs(F.col("at") - F.col("other")) <= slop)
        .select("key", "item", "at", "other").distinct()
    )


def hits(matches: DataFrame) -> DataFrame:
    """(key, n_hit, items): distinct covered words and items of each text."""
    covered = matches.groupBy("key").agg(
        F.array_sort(F.collect_set(F.struct("lo", "hi"))).alias("runs"),
        F.array_sort(F.collect_set("item")).alias("items"),
    )
    start = F.struct(F.lit(0).alias("n"), F.lit(-1).alias("end"))
    n_hit = F.aggregate(
        "runs", start,
        lambda s, r: F.struct(
            (s["n"] + F.greatest(F.lit(0), r["hi"] - F.greatest(s["end"], r["lo"] - 1))).alias("n"),
            F.greatest(s["end"], r["hi"]).alias("end"),
        ),
        lambda s: s["n"],
    )
    return covered.select("key", n_hit.cast("long").alias("n_hit"), "items")


def judged(
    docs: DataFrame, items: DataFrame, carry: list[str], text_col: str = "text",
    item_col: str = "item_id", item_text_col: str = "text", window: int = WINDOW,
    percent: int = PERCENT,
) -> DataFrame:
    """row, n_words, n_hit, items, contaminated of every row of ``docs``.

    ``row`` holds the columns ``carry`` as a struct, whatever their names. An
    item shorter than ``window`` words is one phrase; one without words
    matches nothing. A null or empty text has no words and is clean. Repeated
    rows and repeated items change nothing. Item ids compare as strings; a
    null id counts as a match but is not listed. Empty tables are fine.
    """
    found = hits(phrase_matches(docs, items, text_col, item_col, item_text_col, window))
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in carry]).alias("row"),
        text_key(F.col(text_col)).alias("key"), word_count(F.col(text_col)).alias("n_words"),
    )
    n_hit = F.coalesce("n_hit", F.lit(0).cast("long"))
    return rows.join(found, "key", "left").select(
        "row", "n_words", n_hit.alias("n_hit"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"),
        ((n_hit > 0) & (n_hit * 100 >= F.col("n_words") * percent)).alias("contaminated"),
    )
