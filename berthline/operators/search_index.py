"""Search of the listing without reading every row: posting lists and deletion neighbourhoods over stored texts.

Rows that look the same to a search share one text (a ship's rows of all dates do).  The index is six tables of Parquet,
each dealt into slots that are folders, so that a lookup reads the slots it names:

    texts     (text_slot, text_id, text)         each distinct search text
    rows      (text_slot, text_id, the columns)  the listing, beside its texts
    grams     (slot, gram, n)                    the 1-, 2- and 3-letter pieces and how many texts have each
    postings  (slot, gram, text_id)              which texts
    variants  (slot, variant, token)             short tokens with up to DELETES letters left out
    tokens    (slot, token, text_id)             the texts' different tokens and which texts have each

A word is looked up by its pieces: the lists of its rarest pieces are intersected, rarest first.  A
misspelled word within k edits of a token shares a variant with it when each has up to k letters left out.  Either way
candidates are texts, and the same condition that filters rows without an index then judges each
candidate text, so the result is the same.
"""

from __future__ import annotations

import json
import math
import zlib
from functools import reduce
from itertools import combinations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from berthline import fixed_values as fv
from berthline.functions.text import expand_synonyms, runs
from berthline.operators.listing import SEARCH_COLUMNS, Synonyms, fuzzy_text_condition, search_text, text_tokens, words_text_condition
from berthline.session import read_small, write_new

PIECE = 3
# Letters left out of indexed tokens, and the longest token that is indexed so; others are compared one by one.
DELETES = 2
LONGEST = 12
# Rows in a slot, about, and slots at least and at most.
SLOT_ROWS = 1_000_000
SLOTS = (16, 4096)
# A piece whose list is so many times longer than the rarest one's is left to the check of the texts.
SKIP = 16


def _pieces(text: Column) -> Column:
    """All different pieces of one to PIECE letters."""
    return F.array_distinct(F.concat(*(runs(text, n) for n in range(1, PIECE + 1))))


def _shorter(words: Column) -> Column:
    """All words with one letter left out."""

    def without(word: Column) -> Column:
        places = F.sequence(F.lit(1), F.greatest(F.length(word), F.lit(1)))
        return F.transform(places, lambda i: F.concat(F.substring(word, F.lit(1), i - 1), F.substring(word, i + 1, F.length(word))))

    return F.array_distinct(F.flatten(F.transform(words, without)))


def variants_of(word: str, deletes: int) -> list[str]:
    """A word with up to so many letters left out."""
    kept = (combinations(word, len(word) - n) for n in range(min(deletes, len(word)) + 1))
    return sorted({"".join(letters) for some in kept for letters in some})


def pieces_of(term: str) -> list[str]:
    """The pieces a text must have to contain a term: its three-letter ones, or the whole of a shorter term."""
    n = min(PIECE, len(term))
    return sorted({term[i : i + n] for i in range(len(term) - n + 1)})


def _slots(rows: int) -> int:
    return min(SLOTS[1], max(SLOTS[0], -(-rows // SLOT_ROWS)))


def _slot(key: Column, slots: int) -> Column:
    return (F.crc32(key) % slots).cast("int")


class SearchIndex:
    """An index below `path`; `build` makes it, the searches return rows of the listing it was built from."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        told = json.loads(read_small(spark, f"{self.path}/index.json"))
        self.slots = told["slots"]
        self.schemas = {name: T.StructType.fromJson(kind) for name, kind in told["schemas"].items()}

    @classmethod
    def build(cls, df: DataFrame, path: str, cols: tuple[str, ...] = SEARCH_COLUMNS) -> SearchIndex:
        """Index the listing `df`, whose columns must not be named text_id or text_slot."""
        spark, path = df.sparkSession, path.rstrip("/")
        told = df.select(search_text(cols).alias("text"), F.struct(*df.columns).alias("row"))
        slots, schemas = {"texts": _slots(df.count())}, {}

        def write(rows: DataFrame, name: str, slot: str, *order: str) -> DataFrame:
            # Rows of a slot go to one task; a hot slot is split by the rebalance.
            rows.hint("rebalance", slot).sortWithinPartitions(slot, *order).write.partitionBy(slot).mode("overwrite").parquet(f"{path}/{name}")
            schemas[name] = rows.schema.jsonValue()
            return spark.read.schema(rows.schema).parquet(f"{path}/{name}")

        distinct = told.select("text").distinct().select(F.monotonically_increasing_id().alias("text_id"), "text", _slot(F.col("text"), slots["texts"]).alias("text_slot"))
        texts = write(distinct, "texts", "text_slot", "text_id")
        placed = told.join(texts, "text").select("text_slot", "text_id", "row.*")
        write(placed, "rows", "text_slot", "text_id")

        pieces = texts.select("text_id", "text_slot", F.explode(_pieces(F.col("text"))).alias("gram"))
        slots["grams"] = _slots(texts.agg(F.sum(F.length("text") * PIECE)).first()[0] or 0)
        postings = write(pieces.withColumn("slot", _slot(F.col("gram"), slots["grams"])), "postings", "slot", "gram", "text_id")
        write(postings.groupBy("slot", "gram").agg(F.count("*").alias("n")), "grams", "slot", "gram")

        words = texts.select("text_id", "text_slot", F.explode(F.array_distinct(text_tokens(F.col("text")))).alias("token"))
        slots["tokens"] = slots["grams"]
        held = write(words.withColumn("slot", _slot(F.col("token"), slots["tokens"])), "tokens", "slot", "token", "text_id")
        levels = [F.array("token")]
        for _ in range(DELETES):
            levels.append(_shorter(levels[-1]))
        short = held.select("token").distinct().filter(F.length("token") <= LONGEST)
        variants = short.select("token", F.explode(F.array_distinct(F.concat(*levels))).alias("variant"))
        write(variants.withColumn("slot", _slot(F.col("variant"), slots["tokens"])), "variants", "slot", "variant")
        write_new(spark, f"{path}/index.json", json.dumps({"slots": slots, "schemas": schemas}))
        return cls(spark, path)

    def _table(self, name: str) -> DataFrame:
        return self.spark.read.schema(self.schemas[name]).parquet(f"{self.path}/{name}")

    def _looked_up(self, name: str, column: str, keys: list[str]) -> DataFrame:
        """Rows of a table whose key is among `keys`: reads the keys' slots."""
        slots = self.slots["grams" if name in ("grams", "postings") else "tokens"]
        wanted = sorted({zlib.crc32(k.encode()) % slots for k in keys})
        return self._table(name).filter(F.col("slot").isin(wanted) & F.col(column).isin(keys))

    # --- candidates -----------------------------------------------------------------

    def _none(self) -> DataFrame:
        return self._table("texts").select("text_slot", "text_id").filter("false")

    def containing(self, term: str) -> DataFrame:
        """(text_slot, text_id): texts that have the rarest pieces of a term."""
        if not term:
            return self._table("texts").select("text_slot", "text_id")
        pieces = pieces_of(term)
        sizes = {r.gram: r.n for r in self._looked_up("grams", "gram", pieces).collect()}
        if len(sizes) < len(pieces):
            return self._none()
        rare = sorted(pieces, key=lambda p: (sizes[p], p))
        used = [p for p in rare if sizes[p] <= SKIP * sizes[rare[0]]]
        lists = [self._looked_up("postings", "gram", [p]).select("text_slot", "text_id") for p in used]
        return reduce(lambda few, more: few.join(more, ["text_slot", "text_id"], "left_semi"), lists)

    def near_tokens(self, term: str, edits: int) -> DataFrame:
        """(token): the different tokens within so many edits of a term."""
        if edits <= DELETES and len(term) + edits <= LONGEST:
            found = self._looked_up("variants", "variant", variants_of(term, edits)).select("token").distinct()
        else:
            # Too far for the variants: every different token of a fitting length, but no row.
            found = self._table("tokens").select("token").distinct().filter(F.length("token").between(len(term) - edits, len(term) + edits))
        return found.filter(F.levenshtein("token", F.lit(term), edits) >= 0)

    def near(self, term: str, edits: int) -> DataFrame:
        """(text_slot, text_id): texts with a token within so many edits of a term."""
        tokens_ = self.near_tokens(term, edits).withColumn("slot", _slot(F.col("token"), self.slots["tokens"]))
        return self._table("tokens").join(tokens_, ["slot", "token"], "left_semi").select("text_slot", "text_id")

    # --- searches -------------------------------------------------------------------

    def _columns(self) -> list[str]:
        return [c for c in self.schemas["rows"].fieldNames() if c not in ("text_slot", "text_id")]

    def _judged(self, words: list[list[DataFrame]], condition: Column) -> DataFrame:
        """Rows whose text is among the candidates of every word and meets the condition."""
        if not words:
            return self._table("rows").select(*self._columns())
        candidates = [reduce(DataFrame.unionByName, terms).distinct() for terms in words]
        few = reduce(lambda a, b: a.join(b, ["text_slot", "text_id"], "left_semi"), candidates)
        keys = ["text_slot", "text_id"]
        hits = self._table("texts").join(few, keys, "left_semi").filter(condition).select(*keys)
        return self._table("rows").join(hits, keys, "left_semi").select(*self._columns())

    def search_words(self, query: str, synonyms: Synonyms | None = None) -> DataFrame:
        """As ``listing.search_words`` on the indexed listing."""
        words = [[self.containing(s.lower()) for s in expand_synonyms(word, synonyms)] for word in query.split()]
        return self._judged(words, words_text_condition(F.col("text"), query, synonyms))

    def fuzzy_search(self, query: str, synonyms: Synonyms | None = None, tolerance: float = fv.FUZZY_TOLERANCE) -> DataFrame:
        """As ``listing.fuzzy_search`` on the indexed listing."""
        words = []
        for word in query.split():
            terms = [s.lower() for s in expand_synonyms(word, synonyms)]
            exact = [self.containing(s) for s in terms]
            words.append(exact + [self.near(s, k) for s in terms if (k := math.floor(tolerance * len(s)))])
        return self._judged(words, fuzzy_text_condition(F.col("text"), query, synonyms, tolerance))

