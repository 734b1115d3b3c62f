"""Benchmark decontamination through a distributed positional inverted index.

Words of the corpus are counted over all documents (those that the benchmark has); each window of a benchmark item is
then looked up by its rarest words. The index stores postings (word, document, position) of these words. A posting of
a word at position p, and the word at position q of an item, put the item at offset p - q; the lists of an item's
rarest words (its anchors) are intersected by offset.

Exact matches: where as many anchors as a window has agree on the offset, the words of the document at that offset are
compared with the item's, which gives every exact occurrence of every window. Proximity matches: as many different
anchors have offsets that lie within `slack` of each other, so words were put in, left out or replaced between them.

Everything is joins, windows, aggregates and SQL functions. Words are runs of a-z, 0-9 and characters beyond ASCII after
A-Z are lowered; a window is `size` consecutive words of an item, or all words of a shorter item.

Defined results: a null text has no words, a wordless item has no window; items of equal ids count as one in n_items;
of words that are equally rare, the first of the item comes first; rows are told apart by id and text, so rows with equal
or null ids are judged each by itself; an empty benchmark leaves all documents clean, and an empty table gives an empty
result. Other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from matchledger.llm.common import cut

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: What stands between words: to split at it is cheaper than to match each word.
BETWEEN = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
SIZE, RAREST, SLACK = 10, 3, 5
#: Benchmark words up to which tables of them are broadcast; beyond, they are joined by a shuffle.
BROADCAST_WORDS = 2_000_000


def words(text: Column) -> Column:
    return F.array_remove(F.split(text, BETWEEN, -1), "")


def fold(text: Column) -> Column:
    """A-Z lowered."""
    return F.translate(text, UPPER, LOWER)


def item_words(items: DataFrame, item_col: str, text: str, size: int) -> DataFrame:
    """(item, copy, n, size, pos, word, key): the words of every item. key: the word in lower case, which equal words share."""
    listed = items.select(F.col(item_col).cast("string").alias("item"), words(fold(F.col(text))).alias("words")).where("size(words) > 0")
    numbered = listed.withColumn("copy", F.xxhash64(F.array_join("words", " ")))  # tells apart texts of one id
    n = F.size("words")
    return numbered.select("item", "copy", n.alias("n"), F.least(F.lit(size), n).alias("size"), F.posexplode("words").alias("pos", "word")).withColumn("key", F.lower("word")).distinct()


def occurrences(docs: DataFrame, keys: DataFrame) -> DataFrame:
    """(id, print, pos, key) of every word of the documents that is in keys."""
    each = docs.select("id", "print", F.posexplode(words(F.col("text"))).alias("pos", "word"))
    return each.select("id", "print", "pos", F.lower("word").alias("key")).join(keys, "key")


def ranked_words(bench: DataFrame, counts: DataFrame, most: int) -> DataFrame:
    """(item, copy, start, rank, pos, key, df): of each window its `most` rarest words, rank 0 the rarest."""
    known = bench.join(counts, "key", "left").withColumn("df", F.coalesce("df", F.lit(0)))
    windows = known.withColumn("start", F.explode(F.sequence(F.greatest(F.lit(0), F.col("pos") - F.col("size") + 1), F.least("pos", F.col("n") - F.col("size")))))
    rare = windows.groupBy("item", "copy", "start").agg(F.slice(F.array_sort(F.collect_list(F.struct("df", "pos", "key"))), 1, most).alias("rare"))  # of `size` words at most
    return rare.select("item", "copy", "start", F.posexplode("rare").alias("rank", "w")).select("item", "copy", "start", "rank", "w.pos", "w.key", "w.df")


class Index:
    """Postings of the corpus for the rarest words of a benchmark's windows."""

    def __init__(self, docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text: str = "text", item_col: str = "item_id", item_text: str = "text", size: int = SIZE, rarest: int = RAREST):
        self.docs = docs.select(F.col(id_col).alias("id"), F.col(text).alias("text")).withColumn("print", F.xxhash64("text"))
        self.bench = cut(item_words(items, item_col, item_text, size), "bench")
        self.hint = F.broadcast if self.bench.count() <= BROADCAST_WORDS else (lambda df: df)
        found = occurrences(self.docs.where("text is not null"), self.hint(self.bench.select("key").distinct()))
        counts = cut(found.groupBy("key").agg(F.count("*").alias("df")), "counts")
        self.ranked = cut(ranked_words(self.bench, counts, rarest), "ranked")
        wanted = self.hint(self.ranked.where("df > 0").select("key").distinct())
        postings = occurrences(self.docs.where("text is not null"), wanted)
        need = self.ranked.groupBy("item", "copy", "start").agg(F.count("*").alias("n")).groupBy("item", "copy").agg(F.min("n").alias("need"))
        anchors = self.ranked.select("item", "copy", "pos", "key").distinct().withColumnRenamed("pos", "at").join(need, ["item", "copy"])
        placed = postings.join(self.hint(anchors), "key")
        #: (id, print, item, copy, need, offset, at): where each anchor of an item puts the item, in documents with enough of them.
        self.placed = cut(self._enough(placed.select("id", "print", "item", "copy", "need", (F.col("pos") - F.col("at")).alias("offset"), "at")), "placed")

    @staticmethod
    def _enough(placed: DataFrame) -> DataFrame:
        of_item = Window.partitionBy("id", "print", "item", "copy")
        return placed.withColumn("n", F.count("*").over(of_item)).where("n >= need").drop("n")

    def offsets(self) -> DataFrame:
        """(id, print, item, copy, offset): where an item may lie: as many of its anchors agree on the offset as a window has."""
        agreed = self.placed.groupBy("id", "print", "item", "copy", "offset", "need").agg(F.size(F.collect_set("at")).alias("n"))  # of an item's anchors
        return agreed.where("n >= need").select("id", "print", "item", "copy", "offset")

    def matches(self) -> DataFrame:
        """(id, print, item, starts array<int>, hits array<int>): exact occurrences of windows; word positions in the document. Repeated rows repeat them."""
        bench = self.bench.groupBy("item", "copy", "size", "n").agg(F.array_sort(F.collect_list(F.struct("pos", "word"))).alias("w")).select("item", "copy", "size", "n", F.col("w.word").alias("words"))
        placed = self.offsets().join(self.hint(bench.select("item", "copy", "n")), ["item", "copy"])
        listed = cut(placed.groupBy("id", "print").agg(F.collect_set(F.struct("item", "copy", "n", "offset")).alias("places")), "places")  # of one document
        same = self.docs["id"].eqNullSafe(listed["id"]) & (self.docs["print"] == listed["print"])
        read = self.docs.join(listed, same).select(listed["id"], listed["print"], words(fold(F.col("text"))).alias("doc"), "places")
        # only the words at a place go on with it
        there = lambda p: F.slice(F.col("doc"), F.greatest(p["offset"], F.lit(0)) + 1, F.greatest(p["n"] + F.least(p["offset"], F.lit(0)), F.lit(0)))
        each = read.select("id", "print", F.inline(F.transform("places", lambda p: F.struct(p["item"].alias("item"), p["copy"].alias("copy"), p["offset"].alias("offset"), there(p).alias("there")))))
        joined = each.join(self.hint(bench), ["item", "copy"])
        equal = F.transform("words", lambda w, i: F.when(i + F.least("offset", F.lit(0)) >= 0, F.coalesce(F.get("there", i + F.least("offset", F.lit(0))) == w, F.lit(False))).otherwise(False))
        flagged = joined.select("id", "print", "item", "offset", "size", equal.alias("equal"))
        starts = F.filter(F.sequence(F.lit(0), F.size("equal") - F.col("size")), lambda s: F.forall(F.slice("equal", s + 1, F.col("size")), lambda x: x))
        found = flagged.select("id", "print", "item", "offset", "size", F.transform(starts, lambda s: s + F.col("offset")).alias("starts")).where("size(starts) > 0")
        hits = F.array_distinct(F.flatten(F.transform("starts", lambda s: F.sequence(s, s + F.col("size") - 1))))
        return found.select("id", "print", "item", "starts", hits.alias("hits"))

    def proximity(self, slack: int = SLACK) -> DataFrame:
        """(id, print, item): as many different anchors of the item as a window has put it at offsets within `slack` of each other. Every exact match is one of these."""
        near = Window.partitionBy("id", "print", "item", "copy").orderBy("offset").rangeBetween(0, slack)
        held = self.placed.withColumn("held", F.size(F.collect_set("at").over(near)))  # of an item's anchors
        return held.where("held >= need").select("id", "print", "item").distinct()


def judge(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text: str = "text", item_col: str = "item_id", item_text: str = "text", size: int = SIZE) -> DataFrame:
    """id_col, n_words, n_hit, n_items, items_sha256, contaminated, n_near (items with a proximity match): one row for each row of docs."""
    index = Index(docs, items, id_col, text, item_col, item_text, size)
    exact = cut(index.matches(), "matches").groupBy("id", "print").agg(F.size(F.array_distinct(F.flatten(F.collect_list("hits")))).cast("long").alias("n_hit"), F.array_sort(F.collect_set("item")).alias("items"))  # of one document
    near = index.proximity().groupBy("id", "print").agg(F.count("*").alias("n_near"))
    found = cut(near.select("id", "print", "n_near", F.lit(None).cast("long").alias("n_hit"), F.lit(None).cast("array<string>").alias("items")).unionByName(exact.withColumn("n_near", F.lit(None).cast("long"))), "found")
    found = cut(found.groupBy("id", "print").agg(F.max("n_near").alias("n_near"), F.max("n_hit").alias("n_hit"), F.max("items").alias("items")), "found")
    counted = index.docs.select("id", "print", F.coalesce(F.size(words(F.col("text"))), F.lit(0)).cast("long").alias("n_words"))
    got = counted.join(found, counted["id"].eqNullSafe(found["id"]) & counted["print"].eqNullSafe(found["print"]), "left")
    n_hit = F.coalesce("n_hit", F.lit(0)).cast("long")
    items_ = F.coalesce("items", F.array().cast("array<string>"))
    return got.select(
        counted["id"].alias(id_col), "n_words", n_hit.alias("n_hit"), F.size(items_).cast("long").alias("n_items"), F.sha2(F.array_join(items_, ","), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"), F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
    )


def keep_clean(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text: str = "text", item_col: str = "item_id", item_text: str = "text", size: int = SIZE) -> DataFrame:
    """The rows of docs, with all their columns, in which no window occurs."""
    index = Index(docs, items, id_col, text, item_col, item_text, size)
    gone = cut(index.matches().select(F.col("id").alias("__id"), F.col("print").alias("__print")).distinct(), "contaminated")
    same = docs[id_col].eqNullSafe(gone["__id"]) & F.xxhash64(docs[text]).eqNullSafe(gone["__print"])
    return docs.join(gone, same, "left_anti")
