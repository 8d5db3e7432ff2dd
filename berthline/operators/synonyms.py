"""Synonym expansion of a table of query terms."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from berthline.operators.entities import substrings

_EXACT, _PART = 1, 2


def expand_terms(terms: DataFrame, synonyms: DataFrame, col: str = "term") -> DataFrame:
    """Add ``expansion``: the term's own entry, else the first list with a word that contains the
    term or is contained in it, else the term alone.

    Only distinct terms are matched, by equality of substrings as for boat names.
    """

    def key(kind: str, text: Column, stage: int) -> Column:
        return F.struct(F.lit(kind).alias("kind"), text.alias("k"), F.lit(stage).alias("stage"))

    def word_keys(word: Column) -> Column:
        return F.concat(
            F.array(key("<", word, _PART)),
            F.transform(substrings(word), lambda part: key(">", part, _PART)),
        )

    keys = F.concat(
        F.array(key("x", F.col("term"), _EXACT)),
        F.flatten(F.transform("synonyms", word_keys)),
    )
    build = synonyms.select("ord", "synonyms", F.inline(keys)).groupBy("kind", "k")
    build = build.agg(F.min(F.struct("stage", "ord", "synonyms")).alias("hit"))
    distinct = terms.select(F.col(col).alias("__raw"), F.trim(col).alias("__term")).distinct()

    def probe(kind: str, text: Column) -> Column:
        return F.struct(F.lit(kind).alias("kind"), text.alias("k"))

    term = F.col("__term")
    probes = F.concat(
        F.array(probe("x", term), probe(">", term)),
        F.transform(substrings(term), lambda part: probe("<", part)),
    )
    hits = distinct.select("__raw", F.inline(probes)).join(build, ["kind", "k"])
    best = hits.groupBy("__raw").agg(F.min("hit").alias("hit"))
    found = best.select("__raw", F.col("hit.synonyms").alias("expansion"))
    joined = terms.join(found, terms[col] == found["__raw"], "left").drop("__raw")
    own = F.array(F.trim(terms[col]))
    return joined.withColumn("expansion", F.coalesce("expansion", own))
