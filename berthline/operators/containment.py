"""Which texts contain which: a join on the rarest piece of the contained one.

A contained text has one key, the q-letter piece of it that the fewest containing texts have; a text that may contain it has a key
for each of its different pieces, at most q times its length.  What meets is checked letter by
letter, so pieces that many texts share cost a comparison and never a wrong match.  Texts shorter than q are keys whole.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from berthline.functions.text import runs

Q = 3


def _keys(text: Column, q: int, empty: bool) -> Column:
    """All different pieces of one to q letters; with ``empty`` the empty text too."""
    none = [F.array(F.lit(""))] if empty else []
    return F.array_distinct(F.concat(*(runs(text, n) for n in range(1, q + 1)), *none))


def _needed(text: Column, q: int, empty: bool) -> Column:
    """Pieces that any text containing `text` has: those of q letters, or a shorter text itself."""
    short = F.array(text) if empty else F.when(text != "", F.array(text)).otherwise(F.array().cast("array<string>"))
    return F.when(F.length(text) >= q, F.array_distinct(runs(text, q))).otherwise(short)


def contained(parts: DataFrame, wholes: DataFrame, by: list[str], q: int = Q, empty: bool = False) -> DataFrame:
    """(*by, part, part_hit, whole, whole_hit): each text `part` with each text `whole` of the same `by` that contains it.

    `parts` has (*by, part, part_hit), `wholes` (*by, whole, whole_hit); what they carry in the last column comes along, of a part
    that is there more than once the least.  Null texts and keys meet nothing; the empty text is contained in all texts with ``empty``, else in none.
    """
    # A text becomes many keys: texts are dealt out before that.
    tasks = int(wholes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    held = wholes.repartition(tasks, "whole").select(*by, "whole", "whole_hit", F.explode(_keys(F.col("whole"), q, empty)).alias("piece"))
    # Spark takes a file's compressed size for that of all the pieces its texts become: it would broadcast any number of them.
    counts = held.groupBy(*by, "piece").agg(F.count("*").alias("n")).hint("merge")
    asked = parts.select(*by, "part", "part_hit", F.explode(_needed(F.col("part"), q, empty)).alias("piece"))
    found = asked.join(counts, [*by, "piece"], "left")
    rare = F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "piece")).alias("rare")
    keyed = found.groupBy(*by, "part").agg(rare, F.min("part_hit").alias("part_hit")).filter("rare.n > 0")
    keyed = keyed.select(*by, "part", "part_hit", F.col("rare.piece").alias("piece"))
    return keyed.join(held.hint("merge"), [*by, "piece"]).filter(F.contains("whole", "part")).drop("piece")
