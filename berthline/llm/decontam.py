"""Benchmark passages in training documents, by a distributed positional inverted index.

1. One pass over the documents stores the postings (document, position, term) of all benchmark terms.
2. Every window of a benchmark item is looked up by its three terms with the fewest postings:
   the rarest term's postings give possible alignments of document and item, and those of the
   other two, moved by their offsets, must be there too (exactly, or within `slop`
   positions for a proximity match).
3. What is left is checked with the postings of all the item's words: an alignment's
   matched positions hold every window that occurs there.

Documents are told apart by id and text hash, so repeated ids with different texts stay apart.
Joins are on (document, position), so neither a long document, a frequent passage nor a
frequent term lands in one task; term counts are summed in the scan's tasks first.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, functions as F

from berthline.llm.base import keep

# What a word is, and what lies between words.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
WINDOW = 13
SLOP = 2
RAREST = 3
# Rows that a side may have to be broadcast; a larger one is shuffled.
BROADCAST_ROWS = 500_000

DOC = ["doc_id", "text_hash"]


def words(text: Column) -> Column:
    lowered = F.translate(F.coalesce(text, F.lit("")), string.ascii_uppercase, string.ascii_lowercase)
    # Split, not extracted: Spark copies the whole text for each match that it extracts.
    return F.array_remove(F.split(lowered, BETWEEN), "")


def _small(df: DataFrame) -> DataFrame:
    """Broadcast behind a check of the size; larger sides are joined by a shuffle."""
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def _keyed(docs: DataFrame) -> DataFrame:
    # Null ids and texts are told apart from others by the flag in the hash; joins need no null-safe test.
    key = F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))
    text_hash = F.xxhash64(F.coalesce("text", F.lit("")), F.col("text").isNull(), key)
    return docs.select("doc_id", F.coalesce("doc_id", F.lit(0)).alias("key"), text_hash.alias("text_hash"), "text")


class Index:
    """Postings of the benchmark's terms and the items as arrays of term numbers with their posting counts."""

    def __init__(self, docs: DataFrame, benchmark: DataFrame, window: int):
        self.window = window
        named = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("null")).alias("item_id"), words(F.col("text")).alias("words"))
        items = keep(named.filter(F.size("words") > 0).distinct().withColumn("item", F.monotonically_increasing_id()), "items")
        terms = items.select(F.explode("words").alias("word")).distinct()
        self.terms = keep(terms.withColumn("term", F.monotonically_increasing_id()), "terms")
        # The one pass over the texts: a row for each document with its number of words, then its postings.
        cut = _keyed(docs).select(F.col("key").alias("doc_id"), F.col("doc_id").isNull().alias("none"), "text_hash", words(F.col("text")).alias("words"))
        headed = cut.select(*DOC, "none", F.size("words").alias("n"), F.concat(F.array(F.lit(None).cast("string")), "words").alias("words"))
        tokens = headed.select(*DOC, "none", "n", F.posexplode("words").alias("place", "word"))
        n_words = F.when(F.col("place") == 0, F.col("n")).cast("long").alias("n_words")
        found = tokens.join(_small(self.terms), "word", "left").filter("term is not null or place = 0")
        stored = keep(found.select(*DOC, "none", n_words, (F.col("place") - 1).alias("pos"), "term"), "postings")
        self.documents = stored.filter("n_words is not null").select(*DOC, "none", "n_words")
        self.postings = stored.filter("term is not null").select(*DOC, "pos", "term")
        counts = self.postings.groupBy("term").agg(F.count("*").alias("df"))
        known = keep(self.terms.join(counts, "term", "left").select("word", "term", F.coalesce("df", F.lit(0)).alias("df")), "counts")
        places = items.select("item", "item_id", F.posexplode("words").alias("place", "word")).join(_small(known), "word")
        ordered = F.sort_array(F.collect_list(F.struct("place", "term", "df")))
        self.items = keep(places.groupBy("item", "item_id").agg(ordered.alias("terms")), "item-terms")

    def lookups(self) -> DataFrame:
        """(item, place, t1, d2, t2, d3, t3): the rarest terms of each window, once for windows that share them."""
        size = F.least(F.size("terms"), F.lit(self.window))
        window = F.explode(F.sequence(F.lit(0), F.size("terms") - size)).alias("at")
        windows = self.items.select("item", "terms", size.alias("size"), window)
        part = F.slice("terms", F.col("at") + 1, F.col("size"))
        by_rarity = F.array_sort(F.transform(part, lambda t: F.struct(t["df"], t["place"], t["term"])))
        rare = windows.select("item", by_rarity.alias("r")).filter(F.col("r")[0]["df"] > 0)
        pick = [F.coalesce(F.get("r", F.lit(k)), F.col("r")[0]) for k in range(RAREST)]
        fields = [pick[0]["place"].alias("place"), pick[0]["term"].alias("t1")]
        for k, p in enumerate(pick[1:], start=2):
            fields += [(p["place"] - pick[0]["place"]).alias(f"d{k}"), p["term"].alias(f"t{k}")]
        return rare.select("item", *fields).distinct()

    def alignments(self, slop: int) -> DataFrame:
        """(document, item, shift, exact): where the rarest terms of a window stand at their offsets, or near them."""
        looked = keep(self.lookups(), "lookups")
        rare = looked.select(F.explode(F.array("t1", "t2", "t3")).alias("term")).distinct()
        rare = keep(self.postings.join(_small(rare), "term"), "rare-postings")
        found = rare.withColumnRenamed("term", "t1").join(_small(looked), "t1")
        found = found.select(*DOC, "item", (F.col("pos") - F.col("place")).alias("shift"), "pos", "d2", "t2", "d3", "t3", F.lit(True).alias("exact"))
        for k in range(2, RAREST + 1):
            moved = found.withColumn("off", F.explode(F.sequence(F.lit(-slop), F.lit(slop))))
            moved = moved.withColumns({"there": F.col("pos") + F.col(f"d{k}") + F.col("off"), "exact": F.col("exact") & (F.col("off") == 0)})
            other = rare.select(*DOC, F.col("pos").alias("there"), F.col("term").alias(f"t{k}"))
            met = moved.join(other, [*DOC, "there", f"t{k}"]).drop("off", "there")
            found = met.groupBy(*[c for c in met.columns if c != "exact"]).agg(F.max("exact").alias("exact"))
        return keep(found.groupBy(*DOC, "item", "shift").agg(F.max("exact").alias("exact")), "alignments")


def matches(index: Index, slop: int = SLOP) -> tuple[DataFrame, DataFrame]:
    """Exact and proximity matches.

    `index` is of the documents and the benchmark.  Exact: (doc_id, text_hash, item_id, covered), covered the document's word positions inside windows of the item
    at one alignment.  Near: (doc_id, text_hash, item_id) where a window's rarest terms stand within `slop`
    words of their offsets.
    """
    window = index.window
    aligned = index.alignments(slop)
    exact = aligned.filter("exact").select(*DOC, "item", "shift")
    held = index.postings.join(_small(exact.select(*DOC).distinct()), DOC, "left_semi")
    places = index.items.select("item", F.explode("terms").alias("t")).select("item", "t.place", "t.term")
    wanted = exact.join(_small(places), "item").select(*DOC, "item", "shift", (F.col("shift") + F.col("place")).alias("pos"), "term")
    met = wanted.join(held, [*DOC, "pos", "term"]).groupBy(*DOC, "item", "shift")
    met = met.agg(F.sort_array(F.collect_set("pos")).alias("at"))
    sizes = index.items.select("item", "item_id", F.least(F.size("terms"), F.lit(window)).alias("size"))
    met = met.join(_small(sizes), "item")
    full = F.filter(F.col("at"), lambda p, j: F.get("at", j + F.col("size") - 1) - p == F.col("size") - 1)
    covered = F.array_distinct(F.flatten(F.transform(full, lambda p: F.sequence(p, p + F.col("size") - 1))))
    hits = met.select(*DOC, "item_id", covered.alias("covered")).filter(F.size("covered") > 0)
    near = aligned.join(_small(index.items.select("item", "item_id")), "item").select(*DOC, "item_id").distinct()
    return keep(hits, "hits"), near


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, slop: int = SLOP, share: int = 20) -> DataFrame:
    """One row for each row of `docs`: doc_id, text_hash, n_words, n_hit, n_items, items, n_near_items, contaminated.

    contaminated: some word is hit, and at least one word in `share`.  A null or empty text has no words; items without
    words match nothing, null item_ids are named 'null'.  Repeated rows are repeated; an empty benchmark hits nothing.
    """
    index = Index(docs, benchmark, window)
    hits, near = matches(index, slop)
    n_hit = hits.select(*DOC, F.explode("covered").alias("pos")).distinct().groupBy(*DOC).agg(F.count("*").alias("n_hit"))
    items = hits.groupBy(*DOC).agg(F.array_sort(F.collect_set("item_id")).alias("items"))
    nearly = near.groupBy(*DOC).agg(F.count("*").alias("n_near_items"))
    found = keep(nearly.join(n_hit.join(items, DOC), DOC, "left"), "found")
    out = index.documents.join(found, DOC, "left").withColumn("doc_id", F.when(~F.col("none"), F.col("doc_id")))
    hit = F.coalesce("n_hit", F.lit(0))
    return out.select(
        "doc_id",
        "text_hash",
        "n_words",
        hit.cast("long").alias("n_hit"),
        F.coalesce(F.size("items"), F.lit(0)).cast("long").alias("n_items"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"),
        F.coalesce("n_near_items", F.lit(0)).cast("long").alias("n_near_items"),
        ((hit > 0) & (share * hit >= F.col("n_words"))).alias("contaminated"),
    )


def digests(found: DataFrame) -> DataFrame:
    listed = F.sha2(F.array_join("items", ","), 256).alias("items_sha256")
    n_items = F.greatest(F.col("n_items"), F.lit(0)).alias("n_items")
    return found.select("doc_id", "n_words", "n_hit", n_items, listed, "contaminated")


def clean(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """The rows of `docs` (doc_id, text and others) that aren't contaminated, with their columns, whatever their names.

    Null and empty texts stay, repeated rows stay or go together, an empty table gives no rows and an empty benchmark drops none.
    """
    named = docs.select("doc_id", "text")
    foul = keep(contamination(named, benchmark, window).filter("contaminated").select(F.col("text_hash").alias("_foul")).distinct(), "foul")
    key = F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    marked = docs.select(row, F.xxhash64(F.coalesce("text", F.lit("")), F.col("text").isNull(), key).alias("_foul"))
    return marked.join(_small(foul), "_foul", "left_anti").select("row.*")
