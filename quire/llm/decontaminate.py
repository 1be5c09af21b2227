"""Benchmark decontamination with a positional inverted index.

Only DataFrame operations. The corpus frequency of every benchmark term is counted over all documents. Each window of an item
gets its two rarest terms; the postings (term, document, position) of these terms are stored in the shared folder. Both
lists, less the terms' offsets in the item, are intersected by start: equal starts are candidates for an exact phrase, starts at
most a few words apart are proximity matches. Candidates are then compared with the whole words of the document, so what is
returned is exact. A window of one distinct term has the one list.

Terms are broadcast up to TERMS of them; beyond, the join shuffles. A common term costs its postings only where a window
has none rarer. Postings are joined to the item places of their term, never to each other, and lists meet by sorting.

Cases: a null or empty text has no words; a null or empty item has no windows; items of fewer words than a window are one window;
items of equal id count once; rows of equal doc_id count as one document, n_words being the most of any of them; an
empty table gives no rows; a null doc_id stays null; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quire.llm.common import Workspace, safe_id, shown_id

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: What stands between words: ASCII but digits and small letters.
BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
TERMS = 1_000_000


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(F.translate(F.coalesce(text.cast("string"), F.lit("")), UPPER, LOWER), BETWEEN), "")


def small(table: DataFrame) -> DataFrame:
    """The table, broadcast if it is of at most TERMS rows."""
    return F.broadcast(table) if table.count() <= TERMS else table


class Index:
    """The benchmark's windows and the postings of their rarest terms."""

    def __init__(self, spark: SparkSession, docs: DataFrame, benchmark: DataFrame, window: int = 10):
        self.work = Workspace(spark, "decontaminate")
        self.window = window
        self.docs = docs.select(safe_id(), words_of(F.col("text")).alias("words"))
        items = benchmark.select(F.col("item_id").cast("string").alias("item"), words_of(F.col("text")).alias("words")).where(F.size("words") > 0)
        self.items = self.work.table(items.select(F.xxhash64("item", "words").alias("entry"), "item", "words").distinct(), "items")
        self.pairs = self.work.table(self._rarest(), "pairs")
        self.places = self._places()
        terms = self.places.select("term").distinct()
        found = self.docs.select("doc_id", F.posexplode("words").alias("pos", "term")).join(small(terms), "term")
        self.postings = self.work.table(found.select("term", "doc_id", "pos"), "postings")

    def _rarest(self) -> DataFrame:
        """Of each window the places of its two rarest terms: entry, t1, k1, t2, k2. Windows with an absent term cannot occur."""
        size = F.size("words")
        windows = self.items.select("entry", "words", F.explode(F.sequence(F.lit(0), F.greatest(size - self.window, F.lit(0)))).alias("at"))
        terms = windows.select("entry", "at", F.posexplode(F.slice("words", F.col("at") + 1, self.window)).alias("k", "term"))
        terms = terms.groupBy("entry", "at", "term").agg(F.min(F.col("at") + F.col("k")).alias("k"))
        vocabulary = self.items.select(F.explode("words").alias("term")).distinct()
        counts = self.docs.select(F.explode("words").alias("term")).join(small(vocabulary), "term").groupBy("term").agg(F.count("*").alias("n"))
        ranked = terms.join(counts, "term", "left").groupBy("entry", "at").agg(F.sort_array(F.collect_list(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "term", "k"))).alias("by"))
        first, second = F.col("by")[0], F.try_element_at("by", F.lit(2))
        return ranked.where(first["n"] > 0).select("entry", first["term"].alias("t1"), first["k"].alias("k1"), second["term"].alias("t2"), second["k"].alias("k2")).distinct()

    def _places(self) -> DataFrame:
        sides = F.array(F.struct(F.col("t1").alias("term"), F.lit(1).alias("side"), F.col("k1").alias("k")), F.struct(F.col("t2").alias("term"), F.lit(2).alias("side"), F.col("k2").alias("k")))
        rows = self.pairs.select("entry", "k1", F.coalesce("k2", F.lit(-1)).alias("k2"), F.explode(sides).alias("p"))
        return rows.select("entry", "k1", "k2", "p.*").where("term is not null")

    def meetings(self) -> DataFrame:
        """doc_id, entry, start, apart: where both lists of a pair meet, shifted to the item's start, and how far apart."""
        starts = self.postings.join(self.places, "term").select("doc_id", "entry", "k1", "k2", "side", (F.col("pos") - F.col("k")).alias("start"))
        alone = starts.where("k2 = -1").select("doc_id", "entry", "start", F.lit(0).alias("apart"))
        so_far = Window.partitionBy("doc_id", "entry", "k1", "k2").orderBy("start", "side").rowsBetween(Window.unboundedPreceding, 0)
        latest = [F.last(F.when(F.col("side") == s, F.col("start")), ignorenulls=True).over(so_far) for s in (1, 2)]
        both = starts.where("k2 >= 0").select("doc_id", "entry", "start", F.abs(latest[0] - latest[1]).alias("apart"))
        return alone.unionByName(both.where("apart is not null"))

    def exact(self) -> DataFrame:
        """doc_id, n_words, n_hit, n_items, items_sha256, contaminated of every document."""
        sizes = self.items.select("entry", F.size("words").alias("n"))
        candidates = self.meetings().where("apart = 0").select("doc_id", "entry", "start").distinct().join(sizes, "entry").groupBy("doc_id").agg(F.collect_list(F.struct("entry", "start", "n")).alias("found"))
        docs = self.docs.select("doc_id", "words", F.size("words").cast("long").alias("n_words")).join(candidates, "doc_id", "left")
        zero = F.lit(0)
        part = F.transform("found", lambda c: F.struct(c["entry"].alias("entry"), c["start"].alias("start"), F.slice("words", F.greatest(c["start"], zero) + 1, c["n"] - F.greatest(-c["start"], zero)).alias("part")))
        rows = docs.select("doc_id", "n_words", F.explode_outer(part).alias("c")).select("doc_id", "n_words", "c.*").join(self.items, "entry", "left")
        n, w, skipped = F.size("words"), F.least(F.size("words"), F.lit(self.window)), F.greatest(-F.col("start"), zero)
        rows = rows.select("*", F.transform(F.sequence(zero, n - 1), lambda k: (k >= skipped) & F.coalesce(F.get("part", k - skipped) == F.get("words", k), F.lit(False))).alias("same"))
        windows = F.filter(F.sequence(zero, n - w), lambda a: F.forall(F.slice("same", a + 1, w), lambda x: x))
        hits = F.flatten(F.transform(windows, lambda a: F.sequence(F.col("start") + a, F.col("start") + a + w - 1)))
        rows = rows.select("doc_id", "n_words", "item", hits.alias("hits"))
        found = F.size(F.coalesce("hits", F.array().cast("array<int>"))) > 0
        done = rows.groupBy("doc_id").agg(F.max("n_words").alias("n_words"), F.collect_list(F.when(found, F.col("hits"))).alias("hits"), F.sort_array(F.collect_set(F.when(found, F.col("item")))).alias("items"))
        n_hit = F.size(F.array_distinct(F.flatten("hits"))).cast("long")
        return done.select(shown_id(), "n_words", n_hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"), F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"), (n_hit > 0).alias("contaminated"))

    def near(self, slop: int = 5) -> DataFrame:
        """doc_id, item, apart: proximity matches, where the two rarest terms of a window stand up to slop words from their places."""
        close = self.meetings().where(F.col("apart") <= slop).groupBy("doc_id", "entry").agg(F.min("apart").alias("apart"))
        return close.join(self.items.select("entry", "item"), "entry").groupBy("doc_id", "item").agg(F.min("apart").alias("apart")).select(shown_id(), "item", "apart")


def decontaminate(spark: SparkSession, docs: DataFrame, benchmark: DataFrame, window: int = 10) -> DataFrame:
    return Index(spark, docs, benchmark, window).exact()


ORACLE = r"""WITH d AS MATERIALIZED (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
i AS (SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
v AS MATERIALIZED (SELECT DISTINCT item, least(len(w), 10) AS n, array_to_string(list_slice(w, a + 1, a + least(len(w), 10)), ' ') AS s FROM (SELECT item, w, unnest(range(greatest(len(w) - 10, 0) + 1)) AS a FROM i WHERE len(w) > 0)),
o AS MATERIALIZED (SELECT doc_id, p, v.item, v.n FROM (SELECT doc_id, n, p, array_to_string(list_slice(w, p + 1, p + n), ' ') AS s FROM (SELECT doc_id, w, n, unnest(range(len(w) - n + 1)) AS p FROM d CROSS JOIN (SELECT DISTINCT n FROM v) WHERE len(w) >= n)) JOIN v USING (n, s)),
h AS (SELECT doc_id, count(DISTINCT q) AS n_hit FROM (SELECT doc_id, unnest(range(p, p + n)) AS q FROM o) GROUP BY doc_id),
t AS (SELECT doc_id, count(DISTINCT item) AS n_items, string_agg(DISTINCT item, ',' ORDER BY item) AS items FROM o GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated FROM d LEFT JOIN h USING (doc_id) LEFT JOIN t USING (doc_id)"""
