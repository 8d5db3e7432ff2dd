"""Toxicity from a learned lexicon, matched through Levenshtein automata over its trie.

Training takes a bounded sample of labelled texts: words and word stems that stand in toxic texts far
more often than in others form the lexicon, a trie.  A word is matched by walking the trie and
a Levenshtein automaton together: a state is the set of (trie node, edits so far), built when first met
and kept, so a word costs one step a character and leaves as soon as no term is in reach.
Longer terms may be misspelled, stems must be exact; a form that harmless labelled texts use is
no misspelling.  Every match is weighed by its window of words: quotation marks and reporting words
make it quoted, words of address make it abuse.  A logistic model over the weighed
counts, fitted to the same sample, gives the score.

Scoring is one pass over the texts in Arrow batches without a shuffle; the model is a few
hundred terms and weights.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from berthline.llm.base import by_value, fold, keep, shared_by_value

by_value(__name__)

# Bounds of the labelled sample, by label.
TOXIC_DOCS = 10_000
OTHER_DOCS = 30_000
# A term stands in this many toxic sample texts at least, and this many times as often as in others.
LEAST_DOCS = 4
LEAST_RATIO = 10.0
# Terms that may pass by chance, of all words and stems tested.
CHANCE_TERMS = 1.0
LEAST_STEM = 4
# No stem is longer: longer than any word of a language, while strings without an end have as many starts as letters.
LONGEST_STEM = 64
THRESHOLD = 0.7
NEAR_WORDS = 8
KNOWN_WORDS = 500_000

# Words that report speech, and words of address, in the languages of the texts.
REPORTING = "said says say wrote writes quote quoted called calls term word phrase reported claims dit écrit mot citation sagte schrieb wort zitat dijo escribió palabra cita".split()
ADDRESS = "you your youre yourself u ur tu toi vous votre ton ta du dich dein deine ihr euch usted tú ti vosotros su".split()
QUOTES = "\"“”„«»"
_REPORTING, _ADDRESS, _QUOTES = frozenset(REPORTING), frozenset(ADDRESS), frozenset(QUOTES)

_WORD = re.compile(r"\w+(?:[@$!*]\w+)*")
_QUOTE_OR_WORD = re.compile(rf"[{QUOTES}]|\w+(?:[@$!*]\w+)*")


def edits_allowed(term: str) -> int:
    return 0 if len(term) < 5 else 1 if len(term) < 10 else 2


class Lexicon:
    """Terms and stems with their edits, and the automaton over them."""

    def __init__(self, terms: dict[str, float], stems: dict[str, float], harmless: list[str] = ()):
        self.terms, self.stems, self.harmless = terms, stems, frozenset(harmless)
        # Trie: children, whole-word terms with their edits, stems.
        self.children: list[dict[str, int]] = [{}]
        self.allowed: list[int] = [-1]
        self.stem: list[bool] = [False]
        self.weight: list[float] = [0.0]
        for word, is_stem in [(t, False) for t in sorted(terms)] + [(s, True) for s in sorted(stems)]:
            node = 0
            for c in word:
                if c not in self.children[node]:
                    self.children[node][c] = len(self.children)
                    self.children.append({})
                    self.allowed.append(-1)
                    self.stem.append(False)
                    self.weight.append(0.0)
                node = self.children[node][c]
            if is_stem:
                self.stem[node] = True
            else:
                self.allowed[node] = edits_allowed(word)
            self.weight[node] = max(self.weight[node], (stems if is_stem else terms)[word])
        self.letters = {c for d in self.children for c in d}
        # Edits that some whole-word term below a node allows (-1: none).
        self.reach = [-1] * len(self.children)
        for node in range(len(self.children) - 1, -1, -1):
            self.reach[node] = max([self.allowed[node], *(self.reach[n] for n in self.children[node].values())])
        self._start()

    def _start(self) -> None:
        self.states: list[frozenset[tuple[int, int]]] = []
        self.number: dict[frozenset, int] = {}
        self.steps: list[dict[str, int]] = []
        self.accepts: list[tuple[int, float] | None] = []
        self.stops: list[float | None] = []
        self.begin = self._state(self._closed({(0, 0)}))

    def __getstate__(self):
        return {"terms": self.terms, "stems": self.stems, "harmless": self.harmless}

    def __setstate__(self, state):
        self.__init__(**state)

    def _closed(self, places: set[tuple[int, int]]) -> frozenset[tuple[int, int]]:
        """With letters of the terms left out, and without places that a better one covers."""
        least: dict[int, int] = {}
        todo = list(places)
        while todo:
            node, edits = todo.pop()
            if least.get(node, 99) <= edits:
                continue
            least[node] = edits
            todo += [(n, edits + 1) for n in self.children[node].values() if edits + 1 <= self.reach[n]]
        return frozenset(least.items())

    def _state(self, places: frozenset[tuple[int, int]]) -> int:
        if places not in self.number:
            self.number[places] = len(self.states)
            self.states.append(places)
            self.steps.append({})
            # The fewest edits of a term that ends here with its weight; the weight of a stem that ends here unedited.
            ends = min(((e, -self.weight[n]) for n, e in places if 0 <= e <= self.allowed[n]), default=None)
            self.accepts.append(ends and (ends[0], -ends[1]))
            self.stops.append(max((self.weight[n] for n, e in places if self.stem[n] and not e), default=None))
        return self.number[places]

    def _step(self, state: int, c: str) -> int:
        places = set()
        for node, edits in self.states[state]:
            below = self.children[node]
            if c in below:
                places.add((below[c], edits))
            if edits + 1 <= self.reach[node]:
                places.add((node, edits + 1))
            places |= {(n, edits + 1) for n in below.values() if edits + 1 <= self.reach[n]}
        places = {(n, e) for n, e in places if e == 0 or e <= self.reach[n]}
        self.steps[state][c] = to = self._state(self._closed(places))
        return to

    def match(self, word: str) -> tuple[str, float] | None:
        """'exact', 'stem' or 'near' with the weight of the term, or None."""
        state = self.begin
        for c in word:
            if c not in self.letters:
                c = ""
            to = self.steps[state].get(c)
            state = self._step(state, c) if to is None else to
            if self.stops[state] is not None:
                return "stem", self.stops[state]
            if not self.states[state]:
                return None
        if self.accepts[state] is None:
            return None
        edits, weight = self.accepts[state]
        if not edits:
            return "exact", weight
        return None if word in self.harmless else ("near", weight)


KINDS = ["exact", "stem", "near"]
# By kind abusive and quoted, whether there is any, the rate among the words, and both together.
FEATURES = 2 * len(KINDS) + 3
MOST = 6


class Scorer:
    """Weights of matches summed by kind, abusive and quoted, as numbers for the logistic model."""

    def __init__(self, lexicon: Lexicon):
        self.lexicon = lexicon
        self.found: dict[str, tuple[str, float]] = {}
        self.none: set[str] = set()

    def look_up(self, words: set[str]) -> None:
        """Know which of the words match; a process looks a word up once."""
        if len(self.none) > KNOWN_WORDS:
            self.none.clear()
        for w in words - self.none - self.found.keys():
            matched = self.lexicon.match(w)
            if matched:
                self.found[w] = matched
            else:
                self.none.add(w)

    def features(self, text: str | None) -> np.ndarray:
        out = np.zeros(FEATURES)
        low = (text or "").lower()
        words = set(_WORD.findall(low))
        self.look_up(words)
        if not words & self.found.keys():
            return out
        units = _QUOTE_OR_WORD.findall(low)
        for i in [i for i, u in enumerate(units) if u in self.found]:
            kind, weight = self.found[units[i]]
            before, after = units[max(0, i - NEAR_WORDS) : i + 1], units[i + 1 : i + NEAR_WORDS + 1]
            marked = not _QUOTES.isdisjoint(before) and not _QUOTES.isdisjoint(after)
            quoted = 1.0 * marked + 0.5 * (not (_REPORTING.isdisjoint(before) and _REPORTING.isdisjoint(after)))
            abuse = 1.0 + 0.5 * (not (_ADDRESS.isdisjoint(before) and _ADDRESS.isdisjoint(after)))
            share = min(1.0, quoted / (quoted + abuse)) if quoted else 0.0
            at = KINDS.index(kind)
            out[at] += weight * (1 - share)
            out[len(KINDS) + at] += weight * share
        total = out.sum()
        rate = np.log1p(1000 * total / len(units))
        return np.concatenate((np.minimum(out[: 2 * len(KINDS)], MOST), [float(total > 0), rate, min(total, MOST) * rate]))


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 0.05) -> np.ndarray:
    """Weights (bias first) of a ridge logistic regression, by Newton steps."""
    x = np.hstack([np.ones((len(x), 1)), x])
    w = np.zeros(x.shape[1])
    penalty = np.full(len(w), ridge)
    penalty[0] = 1e-6
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (p - y) + penalty * w
        curve = (x * (p * (1 - p))[:, None]).T @ x + np.diag(penalty + 1e-9)
        step = np.linalg.solve(curve, slope)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return w


def _stems_and_words(texts: Iterator[str]) -> set[str]:
    found = set()
    for word in set(_WORD.findall(texts.lower())):
        found.add(word + "$")
        found.update(word[:n] for n in range(LEAST_STEM, min(len(word), LONGEST_STEM) + 1))
    return found


def sure(counts: pd.DataFrame, toxic: int, other: int, tested: int) -> pd.Series:
    """Whether chance would hardly put a part's texts into the toxic sample as often, however rare it is.

    The bound (Chernoff) on the chance of so many toxic texts, at the sample's share of them, times the parts tested.
    """
    a, b = counts["toxic"].astype(float), counts["other"].astype(float)
    base, n = toxic / (toxic + other), a + b
    surprise = a * np.log(np.maximum(a, 1) / n / base) + b * np.log(np.maximum(b, 1) / n / (1 - base))
    return (a / n > base) & (surprise >= np.log(max(1, tested) / CHANCE_TERMS))


def choose_terms(counts: pd.DataFrame, toxic: int, other: int, tested: int | None = None) -> tuple[dict[str, float], dict[str, float]]:
    """Terms and stems with weights (log odds, 1 for the surest) from (part, toxic, other): texts of the sample that hold a word ('word$') or a word with that start.

    `tested`: the parts that `counts` was chosen from (default: its own).
    A start is kept as the longest one that loses almost no texts: if that ends a word it's a term, else a stem.
    """
    odds = ((counts["toxic"] + 0.5) / (toxic + 1)) / ((counts["other"] + 0.5) / (other + 1))
    good = counts[(counts["toxic"] >= LEAST_DOCS) & (odds >= LEAST_RATIO) & sure(counts, toxic, other, len(counts) if tested is None else tested)]
    good = good.sort_values(["toxic", "part"], ascending=[False, True])
    seen = dict(zip(good["part"], good["toxic"]))
    weight = dict(zip(good["part"], np.log(odds[good.index]) / np.log(max(LEAST_RATIO, odds.max() if len(odds) else 1))))
    terms, stems, covered = [], [], set()
    longer: dict[str, list[str]] = {}
    for part in seen:
        longer.setdefault(part[:-1], []).append(part)
    for part in sorted(seen, key=lambda p: (len(p.rstrip("$")), p)):
        if part.endswith("$"):
            if not any(part[:n] in covered for n in range(LEAST_STEM, len(part))):
                terms.append((seen[part], part[:-1]))
            continue
        if any(part[:n] in covered for n in range(LEAST_STEM, len(part) + 1)):
            continue
        covered.add(part)
        end = part
        while True:
            step = max(longer.get(end, []), key=lambda p: seen[p], default=None)
            if step is None or seen[step] < 0.9 * seen[part]:
                break
            end = step
            if end.endswith("$"):
                break
        (terms if end.endswith("$") else stems).append((seen[part], end.rstrip("$")))
    return {t: float(weight[t + "$"]) for _, t in sorted(terms)}, {s: float(weight[s]) for _, s in sorted(stems)}


class Model:
    def __init__(self, lexicon: Lexicon, weights: np.ndarray):
        self.lexicon, self.weights = lexicon, weights

    def scores(self, texts: list[str | None], scorer: Scorer) -> np.ndarray:
        if not texts:
            return np.zeros(0)
        x = np.vstack([scorer.features(t) for t in texts])
        return 1 / (1 + np.exp(-np.clip(self.weights[0] + x @ self.weights[1:], -30, 30)))


def _sample(docs: DataFrame, labels: DataFrame, toxic_docs: int, other_docs: int) -> DataFrame:
    """(doc_id, text, toxic) of a bounded sample of labelled rows, the least by hash of the id for each label."""
    known = labels.filter("toxic is not null and doc_id is not null").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    picked = []
    for toxic, most in ((1, toxic_docs), (0, other_docs)):
        own = known.filter(F.col("toxic") == toxic).orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)
        picked.append(own)
    ids = picked[0].unionByName(picked[1])
    # At most toxic_docs + other_docs ids.
    return docs.select("doc_id", "text").filter(F.col("text").isNotNull()).join(F.broadcast(ids), "doc_id")


def train(docs: DataFrame, labels: DataFrame, toxic_docs: int = TOXIC_DOCS, other_docs: int = OTHER_DOCS) -> Model:
    """Fit on docs (doc_id, text) and labels (doc_id, toxic); an empty sample gives score 0 to everything."""
    sample = _sample(docs, labels, toxic_docs, other_docs)

    def parts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            counts: dict[str, list[int]] = {}
            for text, toxic in zip(batch["text"], batch["toxic"]):
                for part in _stems_and_words(text):
                    counts.setdefault(part, [0, 0])[not toxic] += 1
            yield pd.DataFrame([(p, a, b) for p, (a, b) in counts.items()], columns=["part", "toxic", "other"])

    sizes = {r["toxic"]: r["count"] for r in sample.groupBy("toxic").count().collect()}
    toxic, other = sizes.get(1, 0), sizes.get(0, 0)
    if not toxic or not other:
        return Model(Lexicon({}, {}), np.r_[-30.0, np.zeros(FEATURES)])
    counted = sample.mapInPandas(parts, "part string, toxic long, other long").groupBy("part").agg(F.sum("toxic").alias("toxic"), F.sum("other").alias("other"))
    counted = keep(counted.filter(F.col("toxic") + F.col("other") >= LEAST_DOCS), "parts")
    tested = counted.count()
    ratio = ((F.col("toxic") + 0.5) / (toxic + 1)) / ((F.col("other") + 0.5) / (other + 1))
    # The same test as in choose_terms, so that only what passes leaves Spark: parts of the bounded sample.
    n, base = F.col("toxic") + F.col("other"), toxic / (toxic + other)
    surprise = F.col("toxic") * F.log(F.col("toxic") / n / base) + F.when(F.col("other") > 0, F.col("other") * F.log(F.col("other") / n / (1 - base))).otherwise(0.0)
    passed = (F.col("toxic") >= LEAST_DOCS) & (ratio >= LEAST_RATIO) & (surprise >= float(np.log(max(1, tested) / CHANCE_TERMS)) - 1e-6)
    good = counted.filter(passed)
    terms, stems = choose_terms(good.toPandas(), toxic, other, tested=tested)
    rough = shared_by_value(docs.sparkSession, Scorer(Lexicon(terms, stems)))

    def near_forms(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            words = {w for text in batch["text"] for w in _WORD.findall(text.lower())}
            rough().look_up(words)
            yield pd.DataFrame({"word": [w for w in words if w in rough().found and rough().found[w][0] == "near"]}, dtype=object)

    harmless = sample.filter("toxic = 0").mapInPandas(near_forms, "word string").distinct().toPandas()["word"]
    # Forms of the bounded sample's other texts alone.
    lexicon = Lexicon(terms, stems, sorted(harmless))

    scorer = shared_by_value(docs.sparkSession, Scorer(lexicon))

    def described(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = [scorer().features(t).tolist() for t in batch["text"]]
            yield pd.DataFrame({"x": rows, "y": batch["toxic"].astype(float)})

    rows = sample.mapInPandas(described, "x array<double>, y double").toPandas()
    return Model(lexicon, fit_logistic(np.vstack(rows["x"]), rows["y"].to_numpy()))


def score(docs: DataFrame, model: Model, text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """`docs` with score (0 to 1) and predicted (1 from `threshold`); null and empty texts have no matches.

    Columns of those names in `docs` are replaced; repeated rows get equal scores.
    """
    # The terms of the bounded sample.
    shared = shared_by_value(docs.sparkSession, (model, Scorer(model.lexicon)))

    @F.pandas_udf("double")
    def scored(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        known, scorer = shared()
        for texts in batches:
            yield pd.Series(known.scores([t if isinstance(t, str) else None for t in texts], scorer))

    out = docs.withColumn("score", scored(F.col(text)))
    return out.withColumn("predicted", F.when(F.col("score") >= threshold, 1).otherwise(0))


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row for each row of `docs`: doc_id, held_out, score, predicted; labels whose fold (crc32 of the id, modulo 3) is 1 are held out of training.

    Null and empty texts have no match and the score that goes with it; a null id is not held out and trains nothing; repeated rows get
    equal scores; an empty table gives no rows; without labels of both kinds every score is 0; other columns are not read.
    """
    named = docs.select("doc_id", "text")
    model = train(named, labels.filter(fold("doc_id", 3) != 1).select("doc_id", "toxic"))
    held = F.coalesce(fold("doc_id", 3) == 1, F.lit(False))
    return score(named, model).select("doc_id", held.alias("held_out"), "score", "predicted")
