import random
import re

import pytest

from berthline.llm import decontam

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items, window):
    out = []
    for doc_id, text in docs:
        own, hit, found = words(text), set(), set()
        for item_id, item in items:
            w = words(item)
            size = min(window, len(w))
            grams = {tuple(w[i : i + size]) for i in range(len(w) - size + 1)} if w else set()
            for i in range(len(own) - size + 1):
                if tuple(own[i : i + size]) in grams:
                    hit |= set(range(i, i + size))
                    found.add("null" if item_id is None else str(item_id))
        out.append((doc_id, len(own), len(hit), sorted(found), bool(hit) and 20 * len(hit) >= len(own)))
    return sorted(out, key=str)


@pytest.fixture(scope="module")
def tables():
    rng = random.Random(12)
    vocab = ["the"] * 30 + ["of"] * 20 + ["É1", "é1"] + [f"w{i}" for i in range(60)]
    text = lambda n: " ".join(rng.choice(vocab) for _ in range(n))
    items = [(i, text(rng.randint(5, 30))) for i in range(12)] + [(50, "the of"), (51, None), (52, ""), (None, text(9)), (53, "the the the the the the the the"), (53, text(14))]
    docs = [(i, text(rng.randint(0, 80))) for i in range(60)]
    for i in range(60, 110):
        a, b = rng.choice(items)[1] or "", rng.choice(items)[1] or ""
        cut = b.split(" ")[rng.randint(0, 5) :]
        docs.append((i, ", ".join([text(rng.randint(0, 200)), a.upper(), text(3), " ".join(cut), a])))
    docs += [(200, None), (201, ""), (None, items[0][1]), (None, None), (5, items[1][1]), docs[70], docs[70]]
    return docs, items


def test_against_brute_force(spark, tables):
    docs, items = tables
    d = spark.createDataFrame([(*x, 9) for x in docs], "doc_id long, text string, term int")
    b = spark.createDataFrame(items, "item_id long, text string")
    got = decontam.contamination(d, b, window=8).collect()
    rows = sorted(((r.doc_id, r.n_words, r.n_hit, r["items"], r.contaminated) for r in got), key=str)
    assert rows == brute(docs, items, 8)
    assert all(r.n_near_items >= r.n_items for r in got) and any(r.contaminated for r in got)


def test_clean_keeps_the_rest(spark, tables):
    docs, items = tables
    d = spark.createDataFrame([(*x, 9) for x in docs], "doc_id long, text string, _foul int")
    b = spark.createDataFrame(items, "item_id long, text string")
    foul = {(i, t) for (i, t), r in zip(sorted(docs, key=str), sorted(docs, key=str)) if brute([(i, t)], items, 8)[0][4]}
    kept = sorted((tuple(r) for r in decontam.clean(d, b, window=8).collect()), key=str)
    assert kept == sorted(((*x, 9) for x in docs if x not in foul), key=str)


def test_the_texts_are_cut_once(spark, tables, monkeypatch):
    docs, items = tables
    cut = []
    words = decontam.words
    monkeypatch.setattr(decontam, "words", lambda column: cut.append(1) or words(column))
    got = decontam.contamination(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"), window=8)
    assert len(cut) == 2 and "regexp_extract_all" not in got._jdf.queryExecution().optimizedPlan().toString()


def test_proximity(spark):
    item = "alpha beta gamma delta epsilon zeta eta theta"
    docs = [(1, item), (2, item.replace("delta", "delta extra")), (3, "alpha gamma"), (4, "zeta eta alpha")]
    d = spark.createDataFrame(docs, "doc_id long, text string")
    b = spark.createDataFrame([(1, item)], "item_id long, text string")
    got = {r.doc_id: (r.n_items, r.n_near_items) for r in decontam.contamination(d, b).collect()}
    assert got[1] == (1, 1) and got[2] == (0, 1) and got[4] == (0, 0)


def test_empty_tables(spark):
    d = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    b = spark.createDataFrame([(1, "a b")], "item_id long, text string")
    got = decontam.digests(decontam.contamination(d, b.limit(0))).first()
    assert (got.n_words, got.n_hit, got.n_items, got.contaminated) == (2, 0, 0, False)
    assert decontam.contamination(d.limit(0), b).collect() == []


def test_words_are_split_off(spark):
    texts = [None, "", " ", "A", "a-b", ".a", "a.", "\x00\x7fÉA b9\u2028Z`{|", "\n\n", "1 22\t333", "\U0001f600 x\U0001f600y", "É É", "ß_ǅ", "--a--b--"]
    asked = spark.createDataFrame([(t,) for t in texts], "text string").select("text", decontam.words("text").alias("words"))
    assert {r.text: r["words"] for r in asked.collect()} == {t: words(t) for t in texts}
    assert "regexp_extract_all" not in asked._jdf.queryExecution().optimizedPlan().toString()
