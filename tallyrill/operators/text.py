"""Text: tokens, word counts, weights, vocabulary presence, lexicon scores."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyrill.operators.relational import join_back
from tallyrill.session import stage

# Addresses, mentions and hashtags stay whole, then words, then single signs.
TWEET_PATTERN = r"https?://[^\s]+|[@#][A-Za-z0-9_]+|[\p{L}\p{N}']+|[^\s\p{L}\p{N}]"

# English stop words up to "just", then the punctuation and letters dropped with them.
STOP_WORDS = """i me my myself we our ours ourselves you you're you've you'll you'd your yours yourself
yourselves he him his himself she she's her hers herself it it's its itself they them their theirs
themselves what which who whom this that that'll these those am is are was were be been being have
has had having do does did doing a an the and but if or because as until while of at by for with
about against between into through during before after above below to from up down in out on off
over under again further then once here there when where why how all any both each few more most
other some such no nor not only own same so than too very s t can will just""".split()
STOP_SIGNS = ["(", ")", ",", "[", "]", ".", ";", "-", "/", "s", "i", "?", "``", ":", "'", "!", "..."]


def plain_tokens(text: str | Column) -> Column:
    """Lower-case pieces between white space, empty pieces left out."""
    t = F.col(text) if isinstance(text, str) else text
    return F.filter(F.split(F.lower(t), r"\s"), lambda x: x != "")


def tweet_tokens(text: str | Column) -> Column:
    """Lower-case tokens by the tweet pattern."""
    t = F.col(text) if isinstance(text, str) else text
    return F.regexp_extract_all(F.lower(t), F.lit(TWEET_PATTERN), F.lit(0))


def is_content_token(token: str | Column) -> Column:
    """Not an address, mention, hashtag or repost mark, and at least three characters."""
    w = F.col(token) if isinstance(token, str) else token
    return (
        ~F.contains(w, F.lit("http"))
        & ~F.startswith(w, F.lit("#"))
        & ~F.contains(w, F.lit("@"))
        & (w != "rt")
        & (F.length(w) >= 3)
    )


def words(df: DataFrame, text: str, keep: Sequence[str] = (), stop: DataFrame | None = None) -> DataFrame:
    """One row per content token that is no stop word.

    ``stop`` is a table with a column ``term``; without it the fixed list is used.
    """
    rows = df.select(*keep, F.explode(tweet_tokens(text)).alias("term")).filter(is_content_token("term"))
    return rows.filter(~F.col("term").isin(STOP_WORDS + STOP_SIGNS)) if stop is None else rows.join(stop.select("term"), "term", "left_anti").select(*keep, "term")


def word_frequency(rows: DataFrame) -> DataFrame:
    return rows.groupBy("term").agg(F.count(F.lit(1)).alias("n"))


def top_words(rows: DataFrame, k: int) -> DataFrame:
    """Most frequent words, ties by word."""
    return word_frequency(rows).orderBy(F.col("n").desc(), "term").limit(k)


BROADCAST_ROWS = 1_000_000  # ids of documents that come more than once


def _counted(tokens: Column) -> Column:
    """The different tokens of an array with how often it has each, as (term, n) structs, by runs of the sorted array."""

    def runs(s: Column) -> Column:
        places = F.sequence(F.lit(0), F.size(s) - 1)
        starts = F.filter(places, lambda i: (i == 0) | (F.get(s, i) != F.get(s, i - 1)))
        # the one-element array makes the starts once per row
        return F.transform(F.array(starts), lambda at: F.transform(at, lambda p, k: F.struct(F.get(s, p).alias("term"), (F.coalesce(F.get(at, k + 1), F.size(s)) - p).cast("long").alias("n"))))[0]

    return F.transform(F.array(F.sort_array(tokens)), lambda s: F.when(F.size(s) > 0, runs(s)))[0]


def term_counts(df: DataFrame, doc: str, tokens: Column) -> DataFrame:
    """(document, term, n). A row is counted where it is; only rows whose ``doc`` comes again are summed up in a shuffle."""
    again = df.groupBy(doc).agg(F.count(F.lit(1)).alias("__rows")).where("__rows > 1").select(F.col(doc).alias("__again"), F.lit(True).alias("__twice"))
    repeated = again.limit(BROADCAST_ROWS + 1).count()
    if repeated > BROADCAST_ROWS:
        return df.select(doc, F.inline(_counted(tokens))).groupBy(doc, "term").agg(F.sum("n").alias("n"))
    if not repeated:
        return df.select(doc, F.inline(_counted(tokens)))
    marked = df.join(F.broadcast(again), F.col(doc).eqNullSafe(F.col("__again")), "left")
    rows = lambda some: marked.where(some).select(doc, F.inline(_counted(tokens)))
    return rows("__twice IS NULL").unionByName(rows("__twice").groupBy(doc, "term").agg(F.sum("n").alias("n")))


def tf_idf(counts: DataFrame, doc: str, n_docs: Column) -> DataFrame:
    """Term count times ln((documents + 1) / (documents with the term + 1))."""
    df_of = counts.groupBy("term").agg(F.count(F.lit(1)).alias("__df"))
    weight = F.col("n") * F.ln((n_docs + 1) / (F.col("__df") + 1))
    return join_back(counts, df_of, ["term"], "__df").select(doc, "term", "n", weight.alias("tf_idf"))


def vocabulary_presence(df: DataFrame, text: str, vocabulary: DataFrame, size: int, out: str = "present") -> DataFrame:
    """0/1 array saying which vocabulary words occur anywhere in the text (substring test).

    ``vocabulary`` has a column ``term``. It is read to the driver and goes with the tasks as one
    array literal, in order of the words; more than ``size`` words are an error, none is left out.
    """
    terms = sorted(r["term"] for r in vocabulary.select("term").limit(size + 1).collect())
    if len(terms) > size:
        raise ValueError(f"the vocabulary has more than {size} words")
    listed = F.array(*[F.lit(t) for t in terms]) if terms else F.array().cast("array<string>")
    # the one-element array makes the lower-case text once per row, not once per word
    once = F.array(F.lower(F.col(text)))
    marks = F.transform(once, lambda t: F.transform(listed, lambda v: F.contains(t, v).cast("int")))
    return df.withColumn(out, marks[0])


PIECE = 256  # characters of a token that are searched at a time


def vocabulary_hits(df: DataFrame, doc: str, text: str, vocabulary: DataFrame, size: int, gram: int = 3) -> DataFrame:
    """(document, term): the vocabulary words that occur anywhere in a lower-case text (substring test), each once.

    A word without white space lies within one token, so only a text's distinct tokens are searched: each
    of their ``gram``-character pieces is looked up in an index of the words' first characters, and what
    it finds is compared. So time grows with text and hits, not with words times text. The index is
    broadcast; it has one row for each word, and more than ``size`` words are an error. Words with white space, which
    are few, are looked for one by one. Texts without hits and null texts give no rows.
    """
    terms = stage(vocabulary.select("term").where("term <> ''").distinct().limit(size + 1), "vocabulary")
    kinds = terms.select(F.rlike("term", F.lit(r"\s")).alias("spaced"), F.least(F.length("term"), F.lit(gram)).alias("first"), F.length("term").alias("n"), "term")
    counts = kinds.groupBy("spaced", "first").agg(F.count(F.lit(1)).alias("words"), F.max("n").alias("longest")).collect()
    if sum(r["words"] for r in counts) > size:
        raise ValueError(f"the vocabulary has more than {size} words")
    spaced = [r["term"] for r in kinds.where("spaced").collect()] if any(r["spaced"] for r in counts) else []
    firsts = sorted({r["first"] for r in counts if not r["spaced"]})
    longest = max((r["longest"] for r in counts if not r["spaced"]), default=1)
    docs = df.select(doc, F.lower(F.col(text)).alias("__t"))
    found = docs.where(F.lit(False)).select(doc, F.lit("").alias("term"))
    if firsts:
        tokens = docs.select(doc, F.explode(F.array_distinct(F.split("__t", r"\s+"))).alias("__k")).where(f"length(__k) >= {firsts[0]}")
        # a long token goes in pieces that overlap by the longest word; here too without functions over arrays
        starts = tokens.select(doc, "__k", F.explode(F.expr(f"sequence(0, (length(__k) - 1) div {PIECE})")).alias("__p"))
        pieces = starts.select(doc, F.expr(f"IF(length(__k) <= {PIECE}, __k, substring(__k, CAST(__p * {PIECE} + 1 AS INT), {PIECE + longest - 1}))").alias("__k"))
        # plain columns, so that the rows stay in generated code; no word starts where fewer characters are left
        places = pieces.where(f"length(__k) >= {firsts[0]}").select(doc, "__k", F.explode(F.sequence(F.lit(1), F.length("__k") - (firsts[0] - 1))).alias("at"))
        if len(firsts) > 1:
            places = places.select("*", F.explode(F.array(*map(F.lit, firsts))).alias("q"))
        else:
            places = places.withColumn("q", F.lit(firsts[0]))
        # numbers are looked up faster than text; the word itself is compared after
        grams = places.select(doc, "__k", "at", F.expr("xxhash64(substring(__k, at, q))").alias("g"))
        index = kinds.where("NOT spaced").select("term", "n", F.expr("xxhash64(substring(term, 1, first))").alias("g"))
        met = grams.join(F.broadcast(index), "g").where(F.expr("substring(__k, at, n)") == F.col("term"))
        found = met.select(doc, "term")
    for term in spaced:
        found = found.unionByName(docs.where(F.contains("__t", F.lit(term))).select(doc, F.lit(term).alias("term")))
    return found.distinct()


def lexicon_scores(df: DataFrame, doc: str, text: str, lexicon: DataFrame) -> DataFrame:
    """Compound score s / sqrt(s^2 + 15), s the sum of term valences; 0 without a hit.

    Terms are counted per document first, so a word repeated in a long text joins once. Give
    the lexicon as a stored table: the engine can then split a word that many texts share.
    """
    counts = term_counts(df, doc, tweet_tokens(text))
    sums = counts.join(lexicon, "term").groupBy(doc).agg(F.sum(F.col("n") * F.col("valence")).alias("__s"))
    s = F.coalesce("__s", F.lit(0.0))
    return df.select(doc).join(sums, doc, "left").select(doc, (s / F.sqrt(s * s + 15)).alias("compound"))


def without_stop_words(tokens: str | Column, stop: Sequence[str] | None = None) -> Column:
    """Tokens that are not in a short fixed list, as an array expression."""
    t = F.col(tokens) if isinstance(tokens, str) else tokens
    listed = list(dict.fromkeys(stop or [*STOP_WORDS, *STOP_SIGNS]))
    return F.filter(t, lambda x: ~x.isin(listed))
