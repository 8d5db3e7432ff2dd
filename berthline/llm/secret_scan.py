"""Secrets in texts: three fixed rules, and character Markov models for strings without a label.

Two first-order models over the characters of keys are trained from labelled samples of all
documents: random strings are what the rules found and a base64 digest of every id,
ordinary identifiers are the long tokens without digits but at the end.  A token is a secret if it is likelier
under the random model by `min_bits` bits in total and `min_rate` bits a character.

Training counts character pairs with one aggregation (partial counts in every task, at most
67 x 67 rows each); the model is those counts, bounded by the alphabet, and scoring is one
projection without a shuffle.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F

from berthline.llm.spans import SPAN, by_start, digest, let, listed, of_kind, spans

KINDS = ["assign", "access", "hex"]

# The rules.
ASSIGN = r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{14,}+"
HEX = r"[0-9a-f]{16,}+"

ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
TOKEN = r"[A-Za-z0-9+/_=-]{20,}+"
# Tokens that train the model of identifiers: words and names with at most a short number at the end,
# shorter ones too, as long ones are rare.
IDENTIFIER = r"(?<![A-Za-z0-9+/_=-])[A-Za-z_-]{12,}+[0-9]{0,4}+(?![A-Za-z0-9+/_=-])"
PAIRS = r"(?=([A-Za-z0-9+/_=-]{2}))"
MIN_BITS = 16.0
MIN_RATE = 0.4
SMOOTHING = 0.5


def base_spans(text: Column) -> Column:
    """Spans of the three rules by start, then kind."""
    assigned = F.filter(spans(text, ASSIGN, "assign"), lambda s: F.length(F.regexp_extract(s["value"], ASSIGN, 2)) >= 12)
    return by_start(F.concat(assigned, spans(text, ACCESS, "access"), spans(text, HEX, "hex")), KINDS)


def _joined(tokens: Column) -> Column:
    return F.array_join(tokens, " ")


def pair_counts(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(random, pair, n): how often a pair of characters stands in random strings and in identifiers."""
    whole = F.coalesce(F.col(text), F.lit(""))
    secret = F.concat(
        F.transform(F.regexp_extract_all(whole, F.lit(ASSIGN), F.lit(2)), lambda v: F.when(F.length(v) >= 12, v).otherwise("")),
        F.regexp_extract_all(whole, F.lit(ACCESS), F.lit(0)),
        F.regexp_extract_all(whole, F.lit(HEX), F.lit(0)),
    )
    label = F.base64(F.unhex(F.sha2(F.coalesce(F.col(doc_id).cast("string"), F.lit("")), 256)))
    clean = F.regexp_replace(whole, f"{ASSIGN}|{ACCESS}|{HEX}", " ")
    # Two samples a document, each one text; the pairs of both are counted in one pass.
    samples = F.array(
        F.struct(F.lit(True).alias("random"), F.concat_ws(" ", _joined(secret), label).alias("sample")),
        F.struct(F.lit(False).alias("random"), _joined(F.regexp_extract_all(clean, F.lit(IDENTIFIER), F.lit(0))).alias("sample")),
    )
    labelled = docs.select(F.inline(samples))
    pairs = labelled.select("random", F.explode(F.regexp_extract_all("sample", F.lit(PAIRS), F.lit(1))).alias("pair"))
    return pairs.groupBy("random", "pair").agg(F.count("*").alias("n"))


class Model:
    """Bits by which a pair of characters speaks for a random string."""

    def __init__(self, counts: list[tuple[bool, str, int]]):
        n = len(ALPHABET)
        place = {c: i for i, c in enumerate(ALPHABET)}
        logs = []
        for random in (True, False):
            row = [[SMOOTHING] * n for _ in range(n)]
            for is_random, pair, count in counts:
                if is_random == random:
                    row[place[pair[0]]][place[pair[1]]] += count
            logs.append([[math.log2(x / sum(after)) for x in after] for after in row])
        self.bits = [round(a - b, 6) for one, other in zip(*logs) for a, b in zip(one, other)]

    @classmethod
    def train(cls, docs: DataFrame) -> Model:
        # At most two rows for each pair of the alphabet.
        return cls([(r["random"], r["pair"], r["n"]) for r in pair_counts(docs).collect()])

    def score(self, token: Column) -> Column:
        """Sum of the different pairs' bits: a pair that a token repeats speaks once, so runs of one character tell nothing."""
        table_ = F.split(F.lit(",".join(map(str, self.bits))), ",").cast("array<double>")
        places = F.transform(F.regexp_extract_all(token, F.lit("(?s)."), F.lit(0)), lambda c: F.instr(F.lit(ALPHABET), c) - 1)

        def total(at: Column) -> Column:
            later = F.slice(at, 2, F.size(at))
            pairs = F.array_distinct(F.transform(later, lambda c, i: at[i] * len(ALPHABET) + c))
            return F.aggregate(pairs, F.lit(0.0), lambda s, pair: s + table_[pair])

        return let(places, total)


def markov_spans(text: Column, model: Model, base: Column, min_bits: float = MIN_BITS, min_rate: float = MIN_RATE) -> Column:
    """Tokens that the models take for random and that no base span touches."""

    def random(span: Column) -> Column:
        bits = model.score(span["value"])
        return bits >= F.greatest(F.lit(min_bits), min_rate * F.length(span["value"]))

    def untouched(span: Column) -> Column:
        return ~F.exists(base, lambda b: (b["start"] < span["end"]) & (b["end"] > span["start"]))

    free = F.filter(spans(text, TOKEN, "markov"), untouched)
    return F.when(text.rlike(TOKEN), F.filter(free, random)).otherwise(F.array().cast(SPAN))


def with_secrets(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """`docs` with the arrays `base` and `extra` of spans.  A null or empty text has none; such columns in `docs` are replaced."""
    whole = F.coalesce(F.col(text), F.lit(""))
    out = docs.withColumn("base", base_spans(whole))
    return out.withColumn("extra", markov_spans(whole, model, F.col("base")))


def redacted(docs: DataFrame, model: Model, mark: str = "[SECRET]") -> DataFrame:
    """`docs` (text, n_chars and others) with every found span of `text` replaced by `mark`; `n_chars` follows.

    Null and empty texts have no span and stay; repeated rows get equal texts; other columns come along whatever their names.
    """

    def parts(found: Column) -> Column:
        # Overlapping spans are replaced as one: a span counts from where those before it end.
        def kept(state: Column, s: Column) -> Column:
            piece = F.substring(F.col("text"), state["at"] + 1, s["start"] - state["at"])
            joined = F.concat(state["out"], F.when(s["start"] >= state["at"], F.concat(piece, F.lit(mark))).otherwise(""))
            return F.struct(joined.alias("out"), F.greatest(state["at"], s["end"]).alias("at"))

        start = F.struct(F.lit("").alias("out"), F.lit(0).alias("at"))
        return F.aggregate(found, start, kept, lambda state: F.concat(state["out"], F.substring(F.col("text"), state["at"] + 1, F.length("text"))))

    # The rows' own columns travel as one, so that none can clash with those made here.
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    found = with_secrets(docs.select(row, "text", "n_chars"), model)
    spans_ = by_start(F.concat("base", "extra"), [*KINDS, "markov"])
    none = F.size(F.concat("base", "extra")) == 0
    out = found.withColumn("text", F.when(none, F.col("text")).otherwise(parts(spans_)))
    out = out.withColumn("n_chars", F.when(none, F.col("n_chars")).otherwise(F.length("text").cast("long")))
    return out.select(*[(F.col(c) if c in ("text", "n_chars") else F.col("row").getField(c)).alias(c) for c in docs.columns])


def secrets(docs: DataFrame) -> DataFrame:
    """One row a document: counts of the base kinds, their digest, and all spans."""
    found = with_secrets(docs.select("doc_id", "text"), Model.train(docs))
    return found.select(
        "doc_id",
        *[of_kind(F.col("base"), k).alias(f"n_{k}") for k in KINDS],
        digest(F.col("base")).alias("base_sha256"),
        listed(by_start(F.concat("base", "extra"), [*KINDS, "markov"])).alias("spans"),
        F.size("extra").cast("long").alias("n_markov"),
    )


