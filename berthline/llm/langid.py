"""Language identification by interpolated Kneser-Ney character models, one for each language.

Training counts the character 4-grams of all labelled texts in Arrow batches and sums them in
Spark; lower orders follow from the distinct 4-grams, as Kneser-Ney asks.  The model is a set
of sorted arrays of packed n-grams with probabilities and back-off weights, of all 4-grams.  Up to
`max_grams` 4-grams in all it is broadcast; a larger one is built language by language into files of the
shared folder that Spark sends to every executor once and tasks map into memory.
A text gets the language with the lowest cross-entropy per character.  It is rejected
if that is far above what the language's own texts have, measured in their own spread.

Texts are scored in the scan's partitions without a shuffle; a hot source or language only
adds batches.  Texts over `PIECE` characters are read piece by piece, with the same result.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain

import numpy as np
import pandas as pd
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession, functions as F

from berthline.llm.base import by_value, fold, keep, shared_by_value
from berthline.session import scratch_dir, write_bytes

by_value(__name__)

ORDER = 4
PIECE = 1 << 19
# Bound of the models that are broadcast: 4-grams of all languages together.  Larger ones are mapped files.
MAX_GRAMS = 1_000_000
# Numbers of an array that are written at once.
FILE_PIECE = 1 << 20
# Numbers that are sorted at once where one of a given rank is looked for, and parts that more of them are counted in.
RANKED_AT_ONCE = 10_000
PARTS = 1024
# A text is rejected beyond this many times the largest deviation but one in a thousand of labelled texts.
REJECT_FACTOR = 3.0
LEAST_REJECT = 12.0
UNKNOWN = "und"


def _letters() -> np.ndarray:
    """Code point to lower-cased letter in 16 bits; 0 for all else."""
    to = np.zeros(0x10000, dtype=np.uint16)
    for c in range(0x10000):
        if 0xD800 <= c < 0xE000:
            continue
        char = chr(c)
        if char.isalpha():
            low = char.lower()
            to[c] = ord(low) if len(low) == 1 else c
    return to


_TABLE: list[np.ndarray] = []


def _codes(text: str) -> np.ndarray:
    if not _TABLE:
        _TABLE.append(_letters())
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    codes = _TABLE[0][np.minimum(points, 0xFFFF)]
    far = np.flatnonzero(points > 0xFFFF)
    for i in far.tolist():
        codes[i] = 1 + points[i] % 0xFFFF if chr(points[i]).isalpha() else 0
    return codes


def grams(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Packed 4-grams of the texts: key, text's place, and the number of each text's characters.

    Letters are lower-cased, runs of anything else are one space; a text starts after a space.
    """
    codes = _codes("\n".join(texts) + "\n")
    lengths = np.fromiter((len(t) + 1 for t in texts), dtype=np.int64, count=len(texts))
    piece = np.repeat(np.arange(len(texts)), lengths)
    before = np.concatenate((np.zeros(1, np.uint16), codes[:-1]))
    kept = (codes != 0) | (before != 0)
    codes, piece = codes[kept].astype(np.uint64), piece[kept]
    place = np.arange(len(codes)) - np.searchsorted(piece, np.arange(len(texts)))[piece] if len(codes) else piece
    return _keys(codes, place), piece, np.bincount(piece, minlength=len(texts))


def _keys(codes: np.ndarray, place: np.ndarray) -> np.ndarray:
    """The packed n-gram that ends at each character; `place`: characters before it in its text."""
    key = codes.copy()
    for back in range(1, ORDER):
        prior = np.zeros_like(codes)
        prior[back:] = codes[:-back] if back < len(codes) else codes[:0]
        prior[place < back] = 0
        key |= prior << np.uint64(16 * back)
    return key


def long_grams(text: str) -> Iterator[np.ndarray]:
    """The keys that `grams` gives for one text, piece by piece: each piece goes on from the last characters of the one before."""
    tail, last = np.zeros(0, dtype=np.uint64), np.zeros(1, np.uint16)
    for at in range(0, len(text), PIECE):
        piece = text[at : at + PIECE]
        codes = _codes(piece if at + PIECE < len(text) else piece + "\n")
        before = np.concatenate((last, codes[:-1]))
        last = codes[-1:]
        own = np.concatenate((tail, codes[(codes != 0) | (before != 0)].astype(np.uint64)))
        yield _keys(own, np.arange(len(own)))[len(tail) :]
        tail = own[max(0, len(own) - ORDER + 1) :]


def _counted(lang: list[str], texts: list[str]) -> pd.DataFrame:
    out = []
    names = pd.Series(lang)
    for name, rows in names.groupby(names).groups.items():
        short = [texts[i] for i in rows if len(texts[i]) <= PIECE]
        pieces = (key for i in rows if len(texts[i]) > PIECE for key in long_grams(texts[i]))
        for key in chain([grams(short)[0]] if short else [], pieces):
            codes, distinct = pd.factorize(key)
            out.append(pd.DataFrame({"lang": name, "gram": distinct.view(np.int64), "n": np.bincount(codes, minlength=len(distinct))}))
    return pd.concat(out) if out else pd.DataFrame({"lang": [], "gram": [], "n": []})


def gram_counts(labelled: DataFrame) -> DataFrame:
    """(lang, gram, n) over all rows of (lang, text)."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[pd.DataFrame] = []
        rows = 0
        for batch in batches:
            if len(batch):
                held.append(_counted(batch["lang"].tolist(), batch["text"].tolist()))
                rows += len(held[-1])
            if rows > 1_000_000:
                held = [pd.concat(held).groupby(["lang", "gram"], as_index=False).sum()]
                if len(held[0]) > 500_000:
                    yield held.pop()
                rows = sum(map(len, held))
        if held:
            yield pd.concat(held).groupby(["lang", "gram"], as_index=False).sum()

    counted = labelled.select("lang", "text").mapInPandas(count, "lang string, gram long, n long")
    return counted.groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def _find(keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    at = np.minimum(np.searchsorted(keys, wanted), max(0, len(keys) - 1))
    return at, (keys[at] == wanted) if len(keys) else np.zeros(len(wanted), dtype=bool)


class LanguageModel:
    """One language: for each order sorted packed n-grams with probability, and contexts with back-off weight."""

    def __init__(self, gram: np.ndarray, count: np.ndarray, alphabet: int):
        self.grams: list[tuple[np.ndarray, np.ndarray]] = []
        self.contexts: list[tuple[np.ndarray, np.ndarray]] = []
        levels = [(gram, count.astype(float))]
        for order in range(ORDER - 1, 0, -1):
            # The next lower order counts the distinct n-grams that end with it.
            keys, n = np.unique(levels[0][0] & np.uint64((1 << 16 * order) - 1), return_counts=True)
            levels.insert(0, (keys, n.astype(float)))
        for order, (keys, n) in enumerate(levels, start=1):
            once, twice = (n == 1).sum(), (n == 2).sum()
            discount = once / (once + 2 * twice) if once and twice else 0.5
            context = keys >> np.uint64(16)
            names, inverse, kinds = np.unique(context, return_inverse=True, return_counts=True)
            total = np.bincount(inverse, weights=n)
            weight = discount * kinds / total
            lower = self._seen(order - 1, keys) if order > 1 else np.full(len(keys), 1 / (alphabet + 1))
            self.grams.append((keys, (n - discount) / total[inverse] + weight[inverse] * lower))
            self.contexts.append((names, weight))
        top = np.log2(self.grams[-1][1])
        share = count / count.sum()
        self.floor = 1 / (alphabet + 1)
        self.mean = float(-(share * top).sum())
        self.spread = float(np.sqrt((share * (top + self.mean) ** 2).sum()))

    def to_file(self, spark: SparkSession) -> str:
        """Write the arrays to a file in the shared folder and give them up; they are mapped when first used, from where Spark has put the file."""
        arrays = [a for pair in (*self.grams, *self.contexts) for a in pair]
        self.sizes = [len(a) for a in arrays]
        path = scratch_dir(spark, "grams")
        self.file = path.rsplit("/", 1)[1]
        write_bytes(spark, path, (a[at : at + FILE_PIECE].tobytes() for a in arrays for at in range(0, len(a), FILE_PIECE)))
        del self.grams, self.contexts
        return path

    def __getattr__(self, name: str):
        if name not in ("grams", "contexts") or "file" not in self.__dict__:
            raise AttributeError(name)
        mapped = np.memmap(SparkFiles.get(self.file), dtype=np.uint64, mode="r")
        ends = np.cumsum(self.sizes)
        arrays = [np.asarray(mapped[end - size : end]) for size, end in zip(self.sizes, ends)]
        pairs = [(keys, values.view(np.float64)) for keys, values in zip(arrays[::2], arrays[1::2])]
        self.grams, self.contexts = pairs[:ORDER], pairs[ORDER:]
        return self.__dict__[name]

    def __getstate__(self) -> dict:
        mapped = "file" in self.__dict__
        return {k: v for k, v in self.__dict__.items() if not (mapped and k in ("grams", "contexts"))}

    def _seen(self, order: int, keys: np.ndarray) -> np.ndarray:
        """Probability of the last `order` characters' n-gram for n-grams that are known at that order."""
        at, _ = _find(self.grams[order - 1][0], keys & np.uint64((1 << 16 * order) - 1))
        return self.grams[order - 1][1][at]

    def log2(self, keys: np.ndarray) -> np.ndarray:
        """log2 of the probability of each packed 4-gram's last character after the others."""
        p = np.full(len(keys), self.floor)
        for order in range(1, ORDER + 1):
            own = keys & np.uint64((1 << 16 * order) - 1) if order < ORDER else keys
            at, seen = _find(self.grams[order - 1][0], own)
            near, known = _find(self.contexts[order - 1][0], own >> np.uint64(16))
            backed = np.where(known, self.contexts[order - 1][1][near] * p, p)
            p = np.where(seen, self.grams[order - 1][1][at], backed)
        return np.log2(p)


def _model(counts: pd.DataFrame, alphabet: int) -> LanguageModel:
    gram = counts["gram"].to_numpy(np.int64).view(np.uint64)
    order = np.argsort(gram)
    return LanguageModel(gram[order], counts["n"].to_numpy(float)[order], alphabet)


class Identifier:
    """Trained models with the calibrated rejection."""

    def __init__(self, counts: pd.DataFrame):
        gram = counts["gram"].to_numpy(np.int64).view(np.uint64)
        letters = np.unique(gram & np.uint64(0xFFFF))
        self.langs = sorted(counts["lang"].unique().tolist())
        self.models = [_model(counts[counts["lang"] == lang], len(letters)) for lang in self.langs]
        self.limit = LEAST_REJECT

    @classmethod
    def of_files(cls, counts: DataFrame) -> Identifier:
        """The same from a table of any number of 4-grams: the driver holds one language at a time."""
        found = cls(pd.DataFrame({"lang": [], "gram": [], "n": []}))
        letters = counts.select(F.col("gram").bitwiseAND(F.lit(0xFFFF))).distinct().count()
        found.langs = sorted(r["lang"] for r in counts.select("lang").distinct().collect())
        spark = counts.sparkSession
        for lang in found.langs:
            found.models.append(_model(counts.filter(F.col("lang") == lang).select("gram", "n").toPandas(), letters))
            spark.sparkContext.addFile(found.models[-1].to_file(spark))
        return found

    def cross_entropies(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Bits per character by text and language, and characters of each text."""
        key, text, length = grams([t if len(t) <= PIECE else "" for t in texts])
        codes, distinct = pd.factorize(key)
        bits = np.empty((len(texts), len(self.models)))
        for j, model in enumerate(self.models):
            bits[:, j] = np.bincount(text, weights=-model.log2(distinct)[codes], minlength=len(texts))
        for i in [i for i, t in enumerate(texts) if len(t) > PIECE]:
            bits[i], length[i] = 0.0, 0
            for key in long_grams(texts[i]):
                codes, distinct = pd.factorize(key)
                bits[i] += [-model.log2(distinct)[codes].sum() for model in self.models]
                length[i] += len(key)
        return bits / np.maximum(length, 1)[:, None], length

    def deviation(self, bits: np.ndarray, length: np.ndarray, best: np.ndarray) -> np.ndarray:
        """How far a text's cross-entropy lies above its language's, in standard errors of a text so long."""
        mean = np.array([m.mean for m in self.models])[best]
        spread = np.array([m.spread for m in self.models])[best]
        return (bits[np.arange(len(best)), best] - mean) / (spread / np.sqrt(np.maximum(length, 1)) + 0.05 * mean)

    def predict(self, texts: list[str | None]) -> pd.DataFrame:
        known = [t or "" for t in texts]
        out = pd.DataFrame({"lang_pred": [UNKNOWN] * len(known), "score": 0.0, "bits": np.nan, "rejected": True})
        if not self.models or not known:
            return out
        bits, length = self.cross_entropies(known)
        best = bits.argmin(axis=1)
        gap = bits - bits.min(axis=1, keepdims=True)
        sure = 1 / np.exp2(-gap * np.minimum(length, 100)[:, None]).sum(axis=1)
        told = length > 0
        out.loc[told, "lang_pred"] = np.array(self.langs, dtype=object)[best[told]]
        out.loc[told, "score"] = np.clip(sure, 0, 1)[told]
        out.loc[told, "bits"] = bits[np.arange(len(best)), best][told]
        out["rejected"] = ~told | (self.deviation(bits, length, best) > self.limit)
        return out


def ranked(numbers: DataFrame, rank: int, at_once: int = RANKED_AT_ONCE) -> float:
    """The number of a rank (from 0, ascending) in a column `far` of finite doubles: counted in equal parts of their range, then in those of the part it lies in."""
    part = numbers
    low, high, rows = numbers.agg(F.min("far"), F.max("far"), F.count("far")).first()
    while rows > at_once and low < high:
        place = F.least(F.floor((F.col("far") - low) / (high - low) * PARTS), F.lit(PARTS - 1))
        counted = part.groupBy(place.alias("place")).agg(F.min("far").alias("low"), F.max("far").alias("high"), F.count("*").alias("rows"))
        for row in counted.orderBy("place").collect():
            if rank < row["rows"]:
                break
            rank -= row["rows"]
        low, high, rows = row["low"], row["high"], row["rows"]
        part = numbers.filter(F.col("far").between(low, high))
    return low if low == high else sorted(r["far"] for r in part.select("far").collect())[rank]


def quantile(numbers: DataFrame, per_mille: int) -> float | None:
    """The exact quantile of the column `far`, between the two ranks it falls between; none without rows."""
    rows = numbers.count()
    if not rows:
        return None
    below, part = divmod((rows - 1) * per_mille, 1000)
    first = ranked(numbers, below)
    return first + (ranked(numbers, below + 1) - first) * part / 1000 if part else first


def train(labelled: DataFrame, max_grams: int = MAX_GRAMS) -> Identifier:
    """Fit on (lang, text); rows without lang or text take no part.  Models of more than max_grams 4-grams are mapped files.

    The rejection is calibrated on all rows that have a letter.
    """
    labelled = labelled.filter("lang is not null and text is not null")
    counts = keep(gram_counts(labelled), "grams")
    found = Identifier(counts.toPandas()) if counts.count() <= max_grams else Identifier.of_files(counts)
    if not found.models:
        return found
    shared = shared_by_value(labelled.sparkSession, found)  # at most max_grams entries, or the names of files

    def deviations(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = shared()
        for batch in batches:
            if len(batch):
                bits, length = model.cross_entropies(batch["text"].tolist())
                best = bits.argmin(axis=1)
                yield pd.DataFrame({"far": model.deviation(bits, length, best)[length > 0]})

    far = quantile(keep(labelled.select("text").mapInPandas(deviations, "far double"), "deviations"), 999)
    found.limit = max(LEAST_REJECT, REJECT_FACTOR * (far or 0.0))
    return found


def identify(docs: DataFrame, model: Identifier, text: str = "text") -> DataFrame:
    """`docs` with lang_pred, score (0 to 1), bits (per character) and rejected.

    A null text or one without a letter is 'und', rejected, with score 0 and null bits; so are all
    texts if no language was learned.  Columns of those names in `docs` are replaced.
    """
    shared = shared_by_value(docs.sparkSession, model)  # at most max_grams entries, or the names of files

    @F.pandas_udf("struct<lang_pred:string,score:double,bits:double,rejected:boolean>")
    def predict(texts: pd.Series) -> pd.DataFrame:
        return shared().predict([None if t is None or t != t else t for t in texts])

    told = docs.withColumn("_told", predict(F.col(text)))
    return told.withColumns({n: F.col(f"_told.{n}") for n in ("lang_pred", "score", "bits", "rejected")}).drop("_told")


def training_rows(docs: DataFrame) -> DataFrame:
    """The documents whose fold (crc32 of the id, modulo 4) isn't 2."""
    return docs.filter((fold("doc_id", 4) != 2) & F.col("lang").isNotNull()).select("doc_id", "lang", "text")


def language_ids(docs: DataFrame) -> DataFrame:
    """One row for each row of `docs`: doc_id, held_out, lang_pred, score, rejected, bits; learned from the rows of `training_rows`.

    Null texts, texts without a letter and, where nothing was learned, all texts are 'und' and rejected; a null id is not held out and
    trains nothing; repeated rows get equal results; an empty table gives no rows; other columns are not read.
    """
    named = docs.select("doc_id", "lang", "text")
    out = identify(named.select("doc_id", "text"), train(training_rows(named)))
    held = F.coalesce(fold("doc_id", 4) == 2, F.lit(False))
    return out.select("doc_id", held.alias("held_out"), "lang_pred", "score", "rejected", "bits")
