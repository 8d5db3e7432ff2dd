"""Personal data in texts: patterns propose spans, checks confirm them, words near by adjust their score.

Kinds: email, ip, card, phone (the base kinds) and iban.  A span that fails its check is
dropped and its text isn't tried again.  Patterns use possessive repeats, so that long
runs cost one pass and no deep recursion.  All steps are Spark expressions in one
projection: no shuffle, and a hot source or repeated rows are as cheap as others.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from berthline.llm.spans import digest, listed, of_kind, spans

KINDS = ["email", "ip", "card", "phone"]

# Patterns.  `\G` allows a match right after the one before it, where the
# look-behind would see that match's last character.
EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?:\G|(?<![0-9]))[0-9]++(?:\.[0-9]++){3}"
CARD = r"[0-9](?:[\x20-]?[0-9]){12,}+"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
IBAN = r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}+(?:\x20?[A-Z0-9]{1,3})?+(?![A-Za-z0-9])"

# Score before context, and words near by that raise or lower it.
SCORES = {"email": 0.9, "ip": 0.6, "card": 0.8, "phone": 0.6, "iban": 0.9}
RAISE = {
    "email": ["mail", "contact", "write"],
    "ip": ["ip", "host", "server", "address"],
    "card": ["card", "visa", "credit", "karte", "carte", "tarjeta"],
    "phone": ["phone", "tel", "call", "mobile", "fax"],
    "iban": ["iban", "account", "bank", "konto", "compte", "cuenta"],
}
LOWER = ["example", "test", "sample", "version", "order", "isbn"]


def digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn(number: Column) -> Column:
    """Whether a string of digits passes the Luhn check."""
    ones = F.transform(F.reverse(F.regexp_extract_all(number, F.lit("[0-9]"), F.lit(0))), lambda d: d.cast("int"))
    part = F.transform(ones, lambda d, i: F.when(i % 2 == 0, d).otherwise(2 * d - F.when(d > 4, 9).otherwise(0)))
    return F.aggregate(part, F.lit(0), lambda total, d: total + d) % 10 == 0


def mod97(code: Column) -> Column:
    """Whether an account code (capitals and digits) leaves 1 modulo 97, its first four characters put last."""
    turned = F.concat(F.substring(code, 5, 64), F.substring(code, 1, 4))
    values = F.transform(
        F.regexp_extract_all(turned, F.lit("[A-Z0-9]"), F.lit(0)),
        lambda c: F.instr(F.lit("0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ"), c) - 1,
    )
    rest = F.aggregate(values, F.lit(0), lambda r, v: (r * F.when(v > 9, 100).otherwise(10) + v) % 97)
    return rest == 1


def _between(number: Column, least: int, most: int) -> Column:
    return F.length(number).between(least, most)


def _checked(text: Column) -> dict[str, Column]:
    def valid_ip(s: Column) -> Column:
        parts = F.transform(F.split(s["value"], r"\."), lambda p: F.ltrim(p, F.lit("0")))
        return F.forall(parts, lambda p: (F.length(p) < 3) | (F.length(p) == 3) & (p <= "255"))

    return {
        "email": spans(text, EMAIL, "email"),
        "ip": F.filter(spans(text, IP, "ip"), valid_ip),
        "card": F.filter(spans(text, CARD, "card"), lambda s: _between(digits(s["value"]), 13, 19) & luhn(digits(s["value"]))),
        "phone": F.filter(spans(text, PHONE, "phone"), lambda s: _between(digits(s["value"]), 9, 15)),
        "iban": F.filter(spans(text, IBAN, "iban"), lambda s: mod97(F.replace(s["value"], F.lit(" "), F.lit("")))),
    }


def _score(span: Column) -> Column:
    near = F.lower(F.concat_ws(" ", span["before"], span["after"]))
    score = F.lit(None).cast("double")
    for kind, base in SCORES.items():
        raised = near.rlike(r"\b(?:" + "|".join(RAISE[kind]) + r")\b")
        lowered = near.rlike(r"\b(?:" + "|".join(LOWER) + r")\b")
        value = F.lit(base) + F.when(raised, 0.1).otherwise(0.0) - F.when(lowered, 0.3).otherwise(0.0)
        score = F.when(span["kind"] == kind, value).otherwise(score)
    return F.round(score, 2)


def scored_spans(docs: DataFrame, text: str = "text", min_score: float = 0.0) -> DataFrame:
    """`docs` with `base`, `extra` (arrays of kind, start, end, value, before, after) and `scores`.

    base: email, ip, card, phone, each kind by start; extra: iban.  `scores` has one number for each
    span of base, then of extra; `min_score` drops only extra spans.  A null or empty text has no
    spans; columns of those names in `docs` are replaced.
    """
    whole = F.coalesce(F.col(text), F.lit(""))
    found = _checked(whole)
    out = docs.withColumns({"base": F.concat(*[found[k] for k in KINDS]), "extra": found["iban"]})
    out = out.withColumn("extra", F.filter("extra", lambda s: _score(s) >= min_score))
    return out.withColumn("scores", F.transform(F.concat("base", "extra"), _score))


def personal_data(docs: DataFrame) -> DataFrame:
    found = scored_spans(docs.select("doc_id", "text"))
    return found.select(
        "doc_id",
        *[of_kind(F.col("base"), k).alias(f"n_{k}") for k in KINDS],
        digest(F.col("base")).alias("base_sha256"),
        listed(F.concat("base", "extra")).alias("spans"),
        F.size("extra").cast("long").alias("n_iban"),
        F.array_join(F.transform("scores", lambda s: s.cast("string")), ",").alias("scores"),
    )
