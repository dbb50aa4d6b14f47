"""Benchmark decontamination over a distributed positional inverted index.

Only DataFrame functions. The index is a stored table of postings
``(d, h, t, pos)``: document key, term and word position of every training
token whose term occurs in the benchmark (other terms can never be asked
for). A search reads the posting lists from the rarest term up: the two
rarest terms of a window give candidate alignments (posting position minus
the term's offset in the item) and the remaining lists are intersected with
what is left, keyed by document and position.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kindred.llm.common import staged

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# The characters of a word once A-Z are lower case, and before that (as listed
# ranges, which the regular expression engine reads faster than their complement).
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
RAW_WORD = r"[0-9A-Za-z\x80-\x{10FFFF}]+"
# Term of the entry that closes each document's postings: its position is the
# number of the document's words.
END = -1
# Benchmark-side tables up to this many rows are broadcast (about 100 bytes a
# row); larger ones are joined by shuffle.
BROADCAST_ROWS = 500_000
# Slots of the document filter that is broadcast before the last lists are
# shuffled: eight for each candidate document between these numbers (the
# larger is some 100 MB). False positives only cost rows.
FILTER_SLOTS, MOST_SLOTS = 1 << 20, 1 << 23
# Positions in a cell of a proximity search (more for a long reach).
CELL = 64


def words(text) -> F.Column:
    """Lower-cased (A-Z) words of a text; none for null."""
    return F.coalesce(F.regexp_extract_all(F.translate(text, UPPER, LOWER), F.lit(WORD), F.lit(0)),
                      F.array().cast("array<string>"))


def tokens(text) -> F.Column:
    """Words of a text in their own case, then one empty word for its end."""
    found = F.regexp_extract_all(text, F.lit(RAW_WORD), F.lit(0))
    return F.concat(F.coalesce(found, F.array().cast("array<string>")), F.array(F.lit("")))


def lowered(word) -> F.Column:
    """A-Z in lower case. For ASCII words that is ``lower``, which is faster."""
    return F.when(F.octet_length(word) == F.char_length(word), F.lower(word)) \
        .otherwise(F.translate(word, UPPER, LOWER))


def id_key() -> F.Column:
    """The id as a number; a hash of ids that are none, or null."""
    return F.coalesce(F.expr("try_cast(doc_id AS LONG)"), F.xxhash64("doc_id"))


def keyed(docs: DataFrame) -> DataFrame:
    """Adds the document key ``(d, h)``. Rows equal in ``doc_id`` and text
    share it and so have equal results. Ids may be of any type."""
    return docs.select(F.col("doc_id"), F.col("text"), id_key().alias("d"),
                       F.xxhash64(F.col("doc_id").isNull(), "text").alias("h"))


def small(df: DataFrame) -> DataFrame:
    """Broadcast hint for a stored table, if its counted size allows it."""
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


@dataclass
class Index:
    postings: DataFrame   # d, h, t, pos; each document closes with (END, number of words)
    phrases: DataFrame    # p, ids (sorted distinct item ids as strings), len
    terms: DataFrame      # p, ipos, t, n (postings of t)


def build_index(docs: DataFrame, items: DataFrame) -> Index:
    """Index ``docs(doc_id, text)`` for the terms of ``items(item_id, text)``.

    Items with equal words are one phrase; null or wordless items have
    none. A null item id still finds hits but is not listed.
    """
    ph = staged(items.select(F.col("item_id").cast("string").alias("id"), words(F.col("text")).alias("words"))
                .where(F.size("words") > 0).groupBy("words").agg(F.array_sort(F.collect_set("id")).alias("ids"))
                .withColumn("p", F.monotonically_increasing_id()), "dec-phrases")
    terms = ph.select("p", F.posexplode("words").alias("ipos", "word"))
    end = docs.sparkSession.range(1).select(F.lit("").alias("word"), F.lit(END).cast("long").alias("t"))
    vocab = staged(terms.select("word").distinct().withColumn("t", F.monotonically_increasing_id())
                   .unionByName(end), "dec-vocab")
    terms = terms.join(vocab, "word").select("p", "ipos", "t")
    listed = keyed(docs).select("d", "h", F.posexplode(tokens(F.col("text"))).alias("pos", "raw")) \
        .select("d", "h", "pos", lowered(F.col("raw")).alias("word"))
    postings = staged(listed.join(small(vocab), "word").select("d", "h", "t", "pos"), "dec-postings")
    n = postings.groupBy("t").agg(F.count("*").alias("n"))
    terms = staged(terms.join(n, "t", "left").select("p", "ipos", "t", F.coalesce("n", F.lit(0)).alias("n")), "dec-terms")
    return Index(postings, ph.select("p", "ids", F.size("words").alias("len")), terms)


def _windows(ix: Index, window: int) -> DataFrame:
    """``(p, s, len, r1, r2)``: windows all of whose terms have postings, with
    the item positions of their two rarest terms (equal if there is one)."""
    per = ix.terms.groupBy("p").agg(F.array_sort(F.collect_list(F.struct("ipos", "n"))).alias("c")) \
        .withColumn("len", F.least(F.size("c"), F.lit(window)))
    rows = per.select("p", "len", F.explode(F.expr("sequence(0, size(c) - len)")).alias("s"), "c") \
        .withColumn("w", F.expr("array_sort(transform(slice(c, s + 1, len), x -> struct(x.n, x.ipos)))"))
    return rows.where("w[0].n > 0").selectExpr(
        "p", "s", "len", "w[0].ipos AS r1", "w[least(1, len - 1)].ipos AS r2")


def _lists(ix: Index, alive: DataFrame) -> DataFrame:
    """Postings of the documents ``(d, h)`` in ``alive``, and of a few others."""
    docs = staged(alive.select("d", "h").distinct(), "dec-alive-docs")
    slots = min(MOST_SLOTS, max(FILTER_SLOTS, 8 * docs.count()))
    slot = F.expr(f"pmod(xxhash64(d, h), {slots})")
    taken = staged(docs.select(slot.alias("slot")).distinct(), "dec-slots")
    return ix.postings.join(F.broadcast(taken), slot == F.col("slot"), "left_semi")


def exact_matches(ix: Index, window: int = 10) -> DataFrame:
    """``(d, h, p, at, len)``: each place where ``len`` consecutive document
    words from position ``at`` equal a window of phrase ``p`` (``window``
    consecutive words, or the whole of a shorter phrase)."""
    win = staged(_windows(ix, window), "dec-windows")
    anchors = staged(win.select("p", F.explode(F.array("r1", "r2")).alias("ipos")).distinct()
                     .join(ix.terms, ["p", "ipos"]).select("t", "p", "ipos"), "dec-anchors")
    cand = staged(ix.postings.join(small(anchors), "t")
                  .select("d", "h", "p", (F.col("pos") - F.col("ipos")).alias("diag"), "ipos")
                  .groupBy("d", "h", "p", "diag").agg(F.collect_set("ipos").alias("hit")), "dec-candidates")
    alive = staged(cand.join(small(win), "p").where("array_contains(hit, r1) AND array_contains(hit, r2)")
                   .select("d", "h", "p", "diag", "s", "len"), "dec-alive")
    need = alive.withColumn("ipos", F.explode(F.expr("sequence(s, s + len - 1)"))) \
        .join(small(ix.terms.select("p", "ipos", "t")), ["p", "ipos"]) \
        .withColumn("pos", F.col("diag") + F.col("ipos"))
    keys = ["d", "h", "p", "diag", "s", "len"]
    met = need.join(_lists(ix, alive), ["d", "h", "pos", "t"], "left_semi").groupBy(*keys).agg(F.count("*").alias("n"))
    return met.where("n = len").selectExpr("d", "h", "p", "diag + s AS at", "len")


def proximity_matches(ix: Index, window: int = 10, slop: int = 2, known: DataFrame | None = None) -> DataFrame:
    """``(d, h, p, at)``: alignments of phrase ``p`` with a document (the
    phrase's first word would stand at ``at``, possibly outside the text) by
    which every word of some window of the phrase has a posting at most
    ``slop`` words from its place. Windows are those of ``exact_matches``,
    whose places are among the alignments; with ``slop`` 0 they are all.
    Documents and phrases ``(d, h, p)`` that are ``known`` to match are not
    looked at again.

    Postings of each window's two rarest terms, less their offset in the
    item, are brought together in cells of positions that overlap by ``2
    slop``, so no list is read against itself; the other lists are
    intersected with the alignments that both allow.
    """
    if slop < 0:
        raise ValueError("slop is a number of words")
    win = staged(_windows(ix, window), "dec-windows")
    anchors = staged(win.select("p", F.explode(F.array("r1", "r2")).alias("ipos"), (F.col("r1") == F.col("r2")).alias("one"))
                     .groupBy("p", "ipos").agg(F.max("one").alias("one"))
                     .join(ix.terms, ["p", "ipos"]).select("t", "p", "ipos", "one"), "dec-near-anchors")
    doc = ["d", "h", "p"]
    reach = 2 * slop
    size = max(CELL, 4 * reach)
    cell, beyond = (f"CAST(floor((diag + {x}) / {size}) AS INT)" for x in (0, reach))
    cells = ix.postings.join(small(anchors), "t").select(*doc, "ipos", "one", (F.col("pos") - F.col("ipos")).alias("diag")) \
        .withColumn("cell", F.explode(F.expr(f"array_distinct(array({cell}, {beyond}))"))) \
        .groupBy(*doc, "cell").agg(F.collect_set(F.struct("ipos", "diag")).alias("hit"), F.min("ipos").alias("low"),
                                   F.max("ipos").alias("high"), F.max("one").alias("one"))
    cand = cells.where("low < high OR one").select(*doc, "hit")
    if known is not None:
        cand = cand.join(known.select(*doc).distinct(), doc, "left_anti")
    cand = staged(cand, "dec-near-candidates")
    places = staged(
        cand.join(small(win), "p")
        .withColumn("x", F.explode(F.expr("filter(hit, y -> y.ipos = r1)")))
        .withColumn("z", F.explode(F.expr(f"filter(hit, y -> y.ipos = r2 AND abs(y.diag - x.diag) <= {reach})")))
        .withColumn("at", F.explode(F.expr(f"sequence(greatest(x.diag, z.diag) - {slop}, least(x.diag, z.diag) + {slop})")))
        .select(*doc, "at", "s", "len").distinct(), "dec-near-places")
    each = places.withColumn("ipos", F.explode(F.expr("sequence(s, s + len - 1)")))
    need = each.select(*doc, "at", "ipos").distinct().join(small(ix.terms.select("p", "ipos", "t")), ["p", "ipos"]) \
        .withColumn("pos", F.explode(F.expr(f"sequence(at + ipos - {slop}, at + ipos + {slop})")))
    met = staged(need.join(_lists(ix, places), ["d", "h", "pos", "t"], "left_semi").select(*doc, "at", "ipos").distinct(), "dec-near-met")
    return each.join(met, [*doc, "at", "ipos"], "left_semi").groupBy(*doc, "at", "s", "len").agg(F.count("*").alias("n")) \
        .where("n = len").select(*doc, "at").distinct()


def _items(ix: Index, matches: DataFrame, name: str) -> DataFrame:
    """``(d, h)`` and the sorted ids of the items of ``matches``."""
    return matches.select("d", "h", "p").distinct().join(small(ix.phrases), "p") \
        .select("d", "h", F.explode_outer("ids").alias("id")) \
        .groupBy("d", "h").agg(F.array_sort(F.collect_set("id")).alias(name))


def report(docs: DataFrame, ix: Index, matches: DataFrame, near: DataFrame) -> DataFrame:
    """One row for each row of ``docs``: ``doc_id, n_words, n_hit`` (words
    inside any match), ``n_items, item_ids``, ``contaminated``, and the items
    of the exact and the proximity matches ``near``: ``n_near_items,
    near_item_ids``. ``matches`` is read twice: pass a stored table."""
    hit = matches.select("d", "h", F.explode(F.expr("sequence(at, at + len - 1)")).alias("pos")).distinct() \
        .groupBy("d", "h").agg(F.count("*").alias("n_hit"))
    # An exact match is a proximity match too, so no document is lost on the left.
    pairs = matches.select("d", "h", "p").unionByName(near.select("d", "h", "p"))
    found = staged(_items(ix, pairs, "near_item_ids").join(hit, ["d", "h"], "left")
                   .join(_items(ix, matches, "item_ids"), ["d", "h"], "left"), "dec-found")
    sizes = ix.postings.where(F.col("t") == END).groupBy("d", "h").agg(F.max("pos").cast("long").alias("n_words"))
    rows = keyed(docs).select("doc_id", "d", "h").join(sizes, ["d", "h"])
    return rows.join(found, ["d", "h"], "left").select(
        "doc_id", "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.coalesce(F.size("item_ids"), F.lit(0)).cast("long").alias("n_items"),
        F.coalesce("item_ids", F.array().cast("array<string>")).alias("item_ids"),
        F.coalesce(F.col("n_hit") > 0, F.lit(False)).alias("contaminated"),
        F.coalesce(F.size("near_item_ids"), F.lit(0)).cast("long").alias("n_near_items"),
        F.coalesce("near_item_ids", F.array().cast("array<string>")).alias("near_item_ids"))


def scan(docs: DataFrame, items: DataFrame, window: int = 10, slop: int = 2) -> DataFrame:
    """``report`` of ``docs`` against ``items``: exact windows, and windows
    whose words each stand at most ``slop`` words from their place. Null text has no words.
    Empty ``items`` or ``docs`` give rows without hits, or none. Items are
    counted by distinct non-null ``item_id``: a hit of an item without id
    counts words only. Extra columns of either table are ignored."""
    ix = build_index(docs, items)
    matches = staged(exact_matches(ix, window), "dec-matches")
    return report(docs, ix, matches, proximity_matches(ix, window, slop, matches))


def clean(docs: DataFrame, items: DataFrame, window: int = 10) -> DataFrame:
    """``docs`` without the rows that hold a window of an item."""
    ix = build_index(docs, items)
    hit = staged(exact_matches(ix, window).select("d", "h").distinct(), "dec-hit")
    key = [id_key() == hit["d"],
           F.xxhash64(F.col("doc_id").isNull(), "text") == hit["h"]]
    return docs.join(hit, key, "left_anti")
