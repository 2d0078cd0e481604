"""Distributed positional inverted index over a training corpus, and the
exact phrase and proximity searches of a benchmark on it.

The index is a written table of postings (term, doc_id, pos): one row per
occurrence of an indexed term. Postings are formed where the text is read (a
generated row per word, kept only for terms that a search asks for), so words
that no search needs are never shuffled or stored. A phrase is found by
intersecting offset-adjusted posting lists, the rarest terms of the phrase
first: a posting at position p of the phrase's term number o votes for a
phrase start at p - o, and starts with all votes are confirmed word by word
against the text. Everything is DataFrame expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kiln.llm.frames import bounded_broadcast
from kiln.session import materialize

NOT_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
IS_WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"       # before lower-casing
SPLIT = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
WINDOW = 10
LISTS = 2                       # posting lists intersected per phrase


def lower_ascii(c: Column) -> Column:
    """Lower-case A-Z only (plain ASCII takes the cheap built-in)."""
    return F.when(F.octet_length(c) == F.char_length(c), F.lower(c)).otherwise(F.translate(c, UPPER, LOWER))


def raw_words(text: Column) -> Column:
    """Words as written, with a possible empty string at either end."""
    return F.split(text, SPLIT)


def words(text: Column) -> Column:
    return F.transform(F.array_remove(raw_words(F.coalesce(text, F.lit(""))), ""), lower_ascii)


def word_count(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(IS_WORD)).cast("long")


def occurrences(docs: DataFrame, keys: Sequence[str] = ("doc_id",)) -> DataFrame:
    """(keys, term, pos): every word of every text, pos from 0."""
    w = docs.where("text is not null").select(*keys, raw_words(F.col("text")).alias("w"))
    return w.select(*keys, F.posexplode("w").alias("p", "word"),
                    F.when(F.get("w", F.lit(0)) == "", 1).otherwise(0).alias("lead")) \
        .where("word <> ''").select(*keys, lower_ascii(F.col("word")).alias("term"),
                                    (F.col("p") - F.col("lead")).alias("pos"))


def term_counts(docs: DataFrame, terms: DataFrame, keys: Sequence[str] = ("doc_id",)) -> DataFrame:
    """(term, n): occurrences in the corpus of each of ``terms``."""
    found = occurrences(docs, keys).join(bounded_broadcast(terms.select("term"), ["term"]), "term")
    return found.groupBy("term").agg(F.count(F.lit(1)).alias("n"))


def postings(docs: DataFrame, terms: DataFrame, name: str = "postings", keys: Sequence[str] = ("doc_id",)) -> DataFrame:
    """The stored index: (term, keys, pos) of the given terms."""
    kept = occurrences(docs, keys).join(bounded_broadcast(terms.select("term"), ["term"]), "term")
    return materialize(kept.select("term", *keys, "pos"), name)


def windows(items: DataFrame, length: int = WINDOW) -> DataFrame:
    """(item_id, at, words): every run of ``length`` words of each item; an
    item with fewer words, but not none, is one window."""
    w = items.select("item_id", words(F.col("text")).alias("w")).where(F.size("w") > 0).distinct()
    last = F.greatest(F.size("w") - length, F.lit(0))
    return w.select("item_id", "w", F.explode(F.sequence(F.lit(0), last)).alias("at")) \
        .select("item_id", "at", F.slice("w", F.col("at") + 1, length).alias("words"))


def phrase_starts(docs: DataFrame, phrases: DataFrame, keys: Sequence[str] = ("doc_id",)) -> DataFrame:
    """Exact occurrences of ``phrases`` (phrase_id, words: array<string>) in
    ``docs`` (keys, text): distinct (phrase_id, keys, start).

    Null texts and rows with a null key hold no occurrence; phrases without
    words are never found. Rows that share their keys are taken together."""
    keys = list(keys)
    phrases = materialize(phrases.where(F.size("words") > 0), "phrases")
    spread = phrases.select("phrase_id", F.posexplode("words").alias("o", "term"))
    vocabulary = materialize(spread.select("term").distinct(), "phrase-terms")
    docs = docs.select(*keys, "text").dropna()
    counts = materialize(term_counts(docs, vocabulary, keys), "term-counts")

    # the rarest terms of each phrase; a phrase with an unseen term cannot occur
    ranked = spread.groupBy("phrase_id", "term").agg(F.min("o").alias("o")) \
        .join(bounded_broadcast(counts, ["term"]), "term", "left") \
        .groupBy("phrase_id").agg(F.array_sort(F.collect_list(F.struct(
            F.coalesce("n", F.lit(0)).alias("n"), "term", "o"))).alias("by_count")) \
        .where("by_count[0].n > 0")
    asked = materialize(ranked.select("phrase_id", F.least(F.size("by_count"), F.lit(LISTS)).alias("lists"),
                                      F.posexplode(F.slice("by_count", 1, LISTS)).alias("list", "t"))
                        .select("phrase_id", F.expr("shiftleft(1, lists) - 1").alias("all_lists"),
                                F.expr("shiftleft(1, list)").alias("vote"), "t.term", "t.o"), "asked")
    index = postings(docs, asked.select("term").distinct(), keys=keys)

    # intersect the offset-adjusted lists: starts that every list votes for
    votes = index.join(bounded_broadcast(asked, ["term"], row_bytes=96), "term") \
        .select("phrase_id", "all_lists", "vote", *keys, (F.col("pos") - F.col("o")).alias("start")) \
        .where("start >= 0")
    starts = votes.groupBy("phrase_id", "all_lists", *keys, "start").agg(F.bit_or("vote").alias("got")) \
        .where("got = all_lists").select("phrase_id", *keys, "start")
    starts = materialize(starts, "phrase-candidates")

    # confirm word by word
    texts = docs.join(starts.select(*keys).distinct(), keys, "left_semi") \
        .select(*keys, words(F.col("text")).alias("w"))
    return starts.join(texts, keys).join(bounded_broadcast(phrases, row_bytes=512), "phrase_id") \
        .where(F.slice("w", F.col("start") + 1, F.size("words")) == F.col("words")) \
        .select("phrase_id", *keys, "start").distinct()


def proximity_matches(docs: DataFrame, queries: DataFrame, within: int) -> DataFrame:
    """Documents where all terms of a query (query_id, terms: array<string>)
    occur inside some span of ``within`` words: distinct (query_id, doc_id,
    first, last), one row per minimal span that starts at a posting of one of
    its terms. Uses only the index: each posting opens a span; the nearest
    later posting of every other term must lie inside it."""
    q = materialize(queries.select("query_id", F.array_distinct("terms").alias("terms"))
                    .where(F.size("terms") > 0), "near-queries")
    spread = q.select("query_id", F.size("terms").alias("k"), F.explode("terms").alias("term"))
    index = postings(docs.where("doc_id is not null"), spread.select("term").distinct(), "near-postings")
    hits = index.join(bounded_broadcast(spread, ["term"]), "term")
    # spans are cut into cells of ``within`` words; a span lies in its cell and the next one
    cell = F.floor(F.col("pos") / within)
    home = hits.select("query_id", "k", "doc_id", "term", "pos", cell.alias("cell"))
    reach = home.select("query_id", "doc_id", F.col("term").alias("t2"), F.col("pos").alias("p2"),
                        F.explode(F.array(F.col("cell"), F.col("cell") - 1)).alias("cell"))
    opened = home.join(reach, ["query_id", "doc_id", "cell"]) \
        .where((F.col("p2") >= F.col("pos")) & (F.col("p2") < F.col("pos") + within)) \
        .groupBy("query_id", "k", "doc_id", "pos", "t2").agg(F.min("p2").alias("p2")) \
        .groupBy("query_id", "k", "doc_id", "pos").agg(F.count(F.lit(1)).alias("n"), F.max("p2").alias("last")) \
        .where("n = k")
    return opened.groupBy("query_id", "doc_id", "last").agg(F.max("pos").alias("first")) \
        .select("query_id", "doc_id", "first", "last")


ROW = ("_row_id", "_row_text")


def row_key(docs: DataFrame) -> DataFrame:
    """``docs`` with the two columns of ``ROW``: rows that share them have the
    same doc_id (or both none) and, by a 64-bit hash (128 bits without an id),
    the same text, so a verdict on one holds for the other. Rows without a
    text have a null key."""
    text = F.col("text")
    given = F.coalesce(F.col("doc_id").cast("long"), F.xxhash64(F.lit("no id"), text))
    return docs.withColumns({ROW[0]: F.when(text.isNotNull(), given), ROW[1]: F.when(text.isNotNull(), F.xxhash64(text))})


def hits_by_row(docs: DataFrame, items: DataFrame, length: int = WINDOW) -> DataFrame:
    """(ROW, n_hit, items) of the rows of ``docs`` (doc_id, text) that hold a
    window of an item; see ``contamination``."""
    win = materialize(windows(items.where("item_id is not null"), length)
                      .withColumn("phrase_id", F.md5(F.concat_ws(" ", "words").cast("binary"))), "windows")
    keyed = row_key(docs.select("doc_id", "text")).select(*ROW, "text")
    starts = materialize(phrase_starts(keyed, win.select("phrase_id", "words").distinct(), ROW), "starts")
    of_item = win.groupBy("phrase_id").agg(F.first(F.size("words")).alias("n"),
                                           F.collect_set(F.col("item_id").cast("string")).alias("ids"))
    found = materialize(starts.join(bounded_broadcast(of_item, row_bytes=512), "phrase_id"), "found")
    hit = found.select(*ROW, F.explode(F.sequence("start", F.col("start") + F.col("n") - 1)).alias("p")) \
        .distinct().groupBy(*ROW).agg(F.count(F.lit(1)).alias("n_hit"))
    named = found.select(*ROW, F.explode("ids").alias("id")).distinct() \
        .groupBy(*ROW).agg(F.array_sort(F.collect_list("id")).alias("items"))
    return materialize(hit.join(named, list(ROW)), "per-row")


def contamination(docs: DataFrame, items: DataFrame, length: int = WINDOW) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): n_words, n_hit (words inside
    any occurrence of a window of an item), n_items (items with occurring
    windows), items (sorted item_ids as strings), contaminated.

    Null or empty texts have no words and no hits. Items without words are
    never found; repeated items count once, null item_ids not at all. Equal
    windows of several items are searched once. Every row is judged by its own
    text: rows that repeat a doc_id, or have none, share nothing."""
    per_row = hits_by_row(docs, items, length)
    return row_key(docs.select("doc_id", "text")).join(per_row, list(ROW), "left") \
        .select("doc_id", word_count(F.col("text")).alias("n_words"), F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
                F.coalesce(F.size("items"), F.lit(0)).cast("long").alias("n_items"),
                F.coalesce("items", F.array().cast("array<string>")).alias("items"),
                F.coalesce(F.col("n_hit") > 0, F.lit(False)).alias("contaminated"))


def uncontaminated(docs: DataFrame, items: DataFrame, length: int = WINDOW) -> DataFrame:
    """The rows of ``docs``, all columns, that hold no window of an item."""
    bad = hits_by_row(docs, items, length).select(*ROW)
    return row_key(docs).join(bad, list(ROW), "left_anti").select(*docs.columns)
