import random
import zlib

import pandas as pd
import pytest

from berthline.llm import toxicity


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        before, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            before, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, before + (x != y))
    return row[-1]


def test_automaton_agrees_with_edit_distance():
    rng = random.Random(4)
    terms = {"scum": 1.0, "idiot": 0.9, "idiotic": 0.8, "worthless": 0.7, "disgustingly": 0.6, "cat": 0.5}
    stems = {"vequ": 0.4}
    lexicon = toxicity.Lexicon(terms, stems)
    words = list(terms) + ["vequ", "vequette", "vexu", "", "idit", "idiiot", "worthlss", "disgutsingly", "zzzz"]
    for t in list(terms) * 60:
        w = list(t)
        for _ in range(rng.randint(0, 3)):
            at = rng.randint(0, len(w))
            rng.choice([lambda: w.insert(at, rng.choice("abdiots*")), lambda: w and w.pop(min(at, len(w) - 1)), lambda: w and w.__setitem__(min(at, len(w) - 1), rng.choice("abdiost1"))])()
        words.append("".join(w))
    for word in words:
        got = lexicon.match(word)
        near = [(distance(word, t), -x) for t, x in terms.items() if distance(word, t) <= toxicity.edits_allowed(t)]
        if any(word.startswith(s) for s in stems):
            assert got == ("stem", 0.4)
        elif near:
            edits, weight = min(near)
            assert got == ("exact" if not edits else "near", -weight), word
        else:
            assert got is None, word
    assert toxicity.Lexicon(terms, stems, ["idiom"]).match("idiom") is None and lexicon.match("idiom")[0] == "near"


INSULTS = ["idiot", "worthless", "scumbag"]


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(5)
    docs, labels = [], []
    for i in range(420):
        words = ["".join(rng.choice(["ba", "re", "ti", "no", "lu"]) for _ in range(3)) for _ in range(rng.randint(5, 60))]
        toxic = i % 4 == 0
        for _ in range(2 * toxic):
            words.insert(rng.randint(0, len(words)), rng.choice(INSULTS) if i % 8 else "zok" + rng.choice(["ba", "re", "ti"]) * 2)
        docs.append((i, " ".join(words)))
        labels.append((i, int(toxic)))
    docs += [(900, None), (901, ""), (902, "you idi0t and w0rthless"), (None, "idiot"), docs[4], docs[4]]
    return docs, labels + [(None, 1), (5000, 1), (1, None)]


def test_held_out_accuracy(spark, rows):
    docs, labels = rows
    d = spark.createDataFrame([(*x, "s") for x in docs], "doc_id long, text string, score string")
    b = spark.createDataFrame(labels, "doc_id long, toxic int")
    got = toxicity.toxicity(d, b).collect()
    assert len(got) == len(docs) and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in got)
    assert all(r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in got)
    held = [r for r in got if r.held_out and r.doc_id < 420]
    assert sum(r.predicted == (r.doc_id % 4 == 0) for r in held) >= 0.97 * len(held)
    by_id = {r.doc_id: r for r in got}
    assert by_id[900].predicted == by_id[901].predicted == 0 and by_id[902].predicted == 1


def test_quoted_terms_weigh_less():
    scorer = toxicity.Scorer(toxicity.Lexicon({"idiot": 1.0}, {}))
    plain, quoted = scorer.features("you are an idiot here"), scorer.features('she said the term "idiot" in a report')
    assert plain[0] > quoted[0] and quoted[3] > plain[3] == 0


def test_empty(spark, rows):
    docs, labels = rows
    d = spark.createDataFrame(docs, "doc_id long, text string")
    b = spark.createDataFrame(labels, "doc_id long, toxic int")
    assert {r.predicted for r in toxicity.toxicity(d, b.limit(0)).collect()} == {0}
    assert toxicity.toxicity(d.limit(0), b).collect() == []


def test_rare_but_sure_terms_are_learned(spark):
    rng = random.Random(11)
    # Each stands in 1 % of the toxic texts or less.
    terms = ["".join(rng.sample("qwxzvkjghp", 8)) for _ in range(120)]
    docs, labels = [], []
    for i in range(6000):
        words = ["".join(rng.choice(["ba", "re", "ti", "no", "lu"]) for _ in range(3)) for _ in range(rng.randint(5, 30))]
        if i % 4 == 0:
            words.insert(rng.randint(0, len(words)), terms[i // 4 % 120])
        docs.append((i, " ".join(words)))
        labels.append((i, int(i % 4 == 0)))
    d, b = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int")
    held = [r for r in toxicity.toxicity(d, b).collect() if r.held_out]
    assert sum(r.predicted for r in held if r.doc_id % 4 == 0) >= 0.9 * sum(r.doc_id % 4 == 0 for r in held)
    assert sum(r.predicted for r in held if r.doc_id % 4) <= 0.01 * len(held)


def test_chance_is_no_evidence():
    counts = pd.DataFrame({"part": ["rare$", "sure$", "both$"], "toxic": [4, 100, 60], "other": [0, 0, 180]})
    assert set(toxicity.choose_terms(counts, 10_000, 30_000, tested=50_000)[0]) == {"sure"}


def test_all_sure_terms_and_long_stems_are_kept():
    words = [f"w{i:05d}$" for i in range(3000)]
    counts = pd.DataFrame({"part": words, "toxic": 50, "other": 0})
    terms, _ = toxicity.choose_terms(counts, 10_000, 30_000, tested=50_000)
    assert len(terms) == 3000
    assert toxicity.choose_terms(counts.sample(frac=1, random_state=1), 10_000, 30_000, tested=50_000)[0] == terms
    parts = toxicity._stems_and_words("donaudampfschifffahrtsgesellschaft x" + "y" * 500)
    assert "donaudampfschifffahrtsgesellschaf" in parts and max(map(len, parts - {"x" + "y" * 500 + "$"})) == toxicity.LONGEST_STEM
