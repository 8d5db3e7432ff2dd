import math
import random
import zlib

import numpy as np
import pytest

from berthline.llm import langid

SYLLABLES = {"xx": "ba be bi bo tra".split(), "yy": "ku ke zu shi ö".split(), "zz": "ли ка мо ста ро".split()}


def text(rng, lang, words):
    return " ".join("".join(rng.choice(SYLLABLES[lang]) for _ in range(rng.randint(1, 4))) for _ in range(words))


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(1)
    out = [(i, text(rng, lang, rng.randint(1, 80)).capitalize() + ".", lang) for i, lang in enumerate(rng.choices(list(SYLLABLES), k=300))]
    return out + [(900, None, "xx"), (901, "", "yy"), (902, "12 34 !!", "xx"), (903, "bababe", None), (None, "Траро ли", "zz"), out[5], out[5]]


def test_held_out_accuracy_and_unknown(spark, rows):
    df = spark.createDataFrame([(*r, "s") for r in rows], "doc_id long, text string, lang string, score string")
    got = langid.language_ids(df).collect()
    assert len(got) == len(rows)
    told = {r[0]: r for r in rows}
    held = [r for r in got if r.held_out]
    assert all(r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in got)
    known = [r for r in held if r.doc_id < 300]
    assert sum(r.lang_pred == told[r.doc_id][2] for r in known) >= 0.98 * len(known)
    by_id = {r.doc_id: r for r in got}
    assert [by_id[i].lang_pred for i in (900, 901, 902)] == ["und"] * 3 and by_id[902].rejected and by_id[902].score == 0
    assert all(0 <= r.score <= 1 for r in got) and by_id[903].lang_pred == "xx" and by_id[None].lang_pred == "zz"
    assert not any(r.rejected for r in got if r.doc_id is None or r.doc_id < 300)


def test_labels_are_no_inputs(spark, rows):
    schema = "doc_id long, text string, lang string"
    df = spark.createDataFrame(rows, schema)
    model = langid.train(langid.training_rows(df))
    held = df.filter("crc32(cast(doc_id as string)) % 4 = 2")
    swapped = spark.createDataFrame([(i, t, "zz") if i is not None and zlib.crc32(str(i).encode()) % 4 == 2 else (i, t, g) for i, t, g in rows], schema)
    other = langid.train(langid.training_rows(swapped))
    a, b = ({r.doc_id: (r.lang_pred, r.score) for r in langid.identify(held, m).collect()} for m in (model, other))
    assert a == b and a


def test_other_script_is_rejected(spark, rows):
    model = langid.train(langid.training_rows(spark.createDataFrame(rows, "doc_id long, text string, lang string")))
    odd = spark.createDataFrame([(1, "qxw vjq wxq qqv " * 40)], "doc_id long, text string")
    assert langid.identify(odd, model).first().rejected


def test_no_training_rows(spark):
    df = spark.createDataFrame([(1, "abc", None)], "doc_id long, text string, lang string")
    got = langid.language_ids(df).first()
    assert got.lang_pred == "und" and got.score == 0
    assert langid.language_ids(df.limit(0)).collect() == []


def plain_kneser_ney(strings, alphabet):
    """Probability function by the textbook recursion over counted 4-grams."""
    top = {}
    for s in strings:
        for i in range(len(s)):
            g = tuple(([0] * 4 + s[: i + 1])[-4:])
            top[g] = top.get(g, 0) + 1
    levels = [top]
    for _ in range(3):
        lower = {}
        for g in levels[0]:
            lower[g[1:]] = lower.get(g[1:], 0) + 1
        levels.insert(0, lower)

    def p(gram, order):
        if not order:
            return 1 / (alphabet + 1)
        counts = levels[order - 1]
        g = gram[4 - order :]
        once, twice = (sum(n == k for n in counts.values()) for k in (1, 2))
        d = once / (once + 2 * twice) if once and twice else 0.5
        same = [n for h, n in counts.items() if h[:-1] == g[:-1]]
        if not same:
            return p(gram, order - 1)
        return max(counts.get(g, 0) - d, 0) / sum(same) + d * len(same) / sum(same) * p(gram, order - 1)

    return lambda gram: p(gram, 4)


def test_model_is_interpolated_kneser_ney():
    rng = random.Random(3)
    texts = [text(rng, "xx", rng.randint(1, 12)) for _ in range(30)]
    key, owner, length = langid.grams(texts)
    strings = [[] for _ in texts]
    for k, o in zip(key.tolist(), owner.tolist()):
        strings[o].append(k & 0xFFFF)
    assert ["".join(chr(c) if c else " " for c in s) for s in strings] == [t + " " for t in texts]
    counts = langid._counted(["xx"] * len(texts), texts)
    gram = counts["gram"].to_numpy().view(np.uint64)
    order = np.argsort(gram)
    alphabet = len({c for s in strings for c in s})
    model = langid.LanguageModel(gram[order], counts["n"].to_numpy()[order], alphabet)
    plain = plain_kneser_ney(strings, alphabet)
    asked, _, _ = langid.grams(texts[:3] + ["quux tratra bo öö", "zzz"])
    for k, got in zip(asked.tolist(), model.log2(asked).tolist()):
        gram = tuple((k >> 16 * b) & 0xFFFF for b in (3, 2, 1, 0))
        assert got == pytest.approx(math.log2(plain(gram)), abs=1e-9)


def test_long_texts_score_as_if_read_at_once(spark, monkeypatch):
    rng = random.Random(5)
    texts = ["abcdefghij klmno", "x", "", " , ", "ab  \n", "a" * 7, "abc   defg   ", text(rng, "xx", 80) + " 12 " + text(rng, "yy", 30)]
    labelled = spark.createDataFrame([(i, text(rng, lang, 40), lang) for i, lang in enumerate(["xx", "yy"] * 40)], "doc_id long, text string, lang string")
    model = langid.train(labelled)
    whole, counts = model.cross_entropies(texts), langid._counted(["xx"] * len(texts), texts).groupby("gram")["n"].sum()
    one_by_one = [langid.grams([t])[0].tolist() for t in texts]
    for piece in (1, 2, 3, 7, 20):
        monkeypatch.setattr(langid, "PIECE", piece)
        for t, keys in zip(texts, one_by_one):
            if t:
                assert [k for part in langid.long_grams(t) for k in part.tolist()] == keys
        pieced = model.cross_entropies(texts)
        assert pieced[1].tolist() == whole[1].tolist() and np.allclose(pieced[0], whole[0], rtol=0, atol=1e-9)
        assert langid._counted(["xx"] * len(texts), texts).groupby("gram")["n"].sum().equals(counts)


def test_small_language_beside_a_large_one_in_a_small_model(spark):
    rng = random.Random(7)
    rows = [(i, text(rng, "xx", 60), "xx") for i in range(300)] + [(500 + i, text(rng, "yy", 6), "yy") for i in range(12)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    whole, small = langid.train(df), langid.train(df, max_grams=50)
    assert small.langs == ["xx", "yy"] and small.limit == pytest.approx(whole.limit)
    a, b = (sorted(map(tuple, langid.identify(df, m).collect())) for m in (whole, small))
    assert a == b and all(r[2] == r[3] and not r[6] for r in b)
    assert sum(len(m.grams[-1][0]) for m in small.models) == langid.gram_counts(df).count() > 50


def test_rejection_is_calibrated_on_all_labelled_texts(spark):
    """Two in a thousand of 6,000 labelled texts lie far from their language: a sample of the texts may have none of them."""
    rng = random.Random(11)
    rows = [(i, "qxw " * 30 if i % 500 == 7 else text(rng, "xx", 8), "xx") for i in range(6000)]
    model = langid.train(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    bits, length = model.cross_entropies([r[1] for r in rows])
    far = model.deviation(bits, length, bits.argmin(axis=1))
    assert model.limit == pytest.approx(max(langid.LEAST_REJECT, langid.REJECT_FACTOR * np.quantile(far, 0.999)))


@pytest.mark.parametrize("at_once", [1, 7, 10_000])
def test_ranks_in_parts(spark, at_once):
    rng = random.Random(13)
    numbers = [rng.choice([-1.5, 0.0, 2.25, rng.gauss(0, 1), rng.gauss(5, 1e-9), 1e6 * rng.random()]) for _ in range(500)]
    df = spark.createDataFrame([(x,) for x in numbers], "far double").cache()
    assert [langid.ranked(df, k, at_once) for k in (0, 1, 250, 498, 499)] == [sorted(numbers)[k] for k in (0, 1, 250, 498, 499)]
    assert langid.quantile(df, 999) == pytest.approx(float(np.quantile(numbers, 0.999)))
    assert langid.quantile(df.limit(1), 999) == df.first()[0] and langid.quantile(df.limit(0), 999) is None
