"""Every stage against its brute-force version, on a small table with all the cases."""

import os
import random
import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline as pipeline
from llm.test_decontam import brute as brute_contamination
from llm.test_simhash import brute as brute_groups
from llm.test_spans import secret

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
SYLLABLES = {"xx": "ba be bi bo tra".split(), "yy": "ku ke zu shi ö".split()}


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    rng = random.Random(21)
    word = lambda lang: "".join(rng.choice(SYLLABLES[lang]) for _ in range(rng.randint(1, 5)))
    text = lambda lang, n: " ".join(word(lang) for _ in range(n))
    items = [(i, text("xx", 20)) for i in range(5)]
    rows = []
    for i in range(160):
        lang = rng.choice(["xx", "yy"])
        body = text(lang, rng.randint(20, 120))
        if i % 20 == 3:
            body += " " + items[i % 5][1]
        if i % 20 == 7:
            body += ' token = "0123456789abcdef0123456789abcdef"'
        rows.append((i, body, lang, f"s{i % 4}", len(body)))
    rows += [(200 + i, rows[11][1], "xx", "s0", 5) for i in range(6)] + [rows[12], rows[12]]
    rows += [(300, None, "xx", "s1", None), (301, "", None, None, 0), (302, "12 !!", "yy", "s1", 5), (None, text("yy", 50), "yy", "s2", 9), (None, rows[15][1], "yy", "s2", 9)]
    folder = str(tmp_path_factory.mktemp("corpus"))
    spark.createDataFrame(rows, SCHEMA).repartition(3).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return folder, rows, items


def rows_of(df):
    return sorted((tuple(r) for r in df.select(*pipeline.COLUMNS).collect()), key=str)


def test_stages(spark, corpus):
    folder, rows, items = corpus
    docs = spark.read.schema(SCHEMA).parquet(f"{folder}/documents.parquet")
    stages = dict(pipeline.STAGES)
    assert len(stages) == 5
    kept = rows_of(stages["language"](spark, docs.withColumn("score", F.lit(1)), folder))
    assert kept == sorted((r for r in rows if re.search("[a-zö]", r[1] or "")), key=str)

    docs = spark.createDataFrame(rows, SCHEMA)
    got = rows_of(stages["near_copies"](spark, docs, folder))
    groups = {}
    for (i, print_, component), r in zip(brute_groups([(r[0], r[1]) for r in rows]), sorted(rows, key=lambda r: str((r[0], r[1])))):
        groups.setdefault(component, set()).add(i)
    assert len(got) == len(groups) and len({g[0] for g in got}) == len(got)
    assert {g[0] for g in got} - {None} == {c for c in groups if c is not None}

    got = rows_of(stages["decontamination"](spark, docs, folder))
    foul = {r for r in rows if brute_contamination([(r[0], r[1])], items, 13)[0][4]}
    assert foul and got == sorted((r for r in rows if r not in foul), key=str)

    got = rows_of(stages["secrets"](spark, docs, folder))
    assert len(got) == len(rows)
    for now, before in zip(got, sorted(rows, key=str)):
        if not secret(before[1] or ""):
            assert now == before or now[0] is None
        else:
            assert not secret(now[1]) and "[SECRET]" in now[1] and now[4] == len(now[1])


def test_run(spark, corpus):
    folder, rows, _ = corpus
    out = pipeline.run(spark, folder).collect()
    ids = {r.doc_id for r in out}
    assert ids < {r[0] for r in rows} and 300 not in ids and 200 not in ids and 11 in ids and 3 not in ids
    assert entry.queries()["pipeline"] is pipeline.run and pipeline.ORACLE_SQL is None


def test_empty_table(spark, corpus):
    folder, _, _ = corpus
    docs = spark.createDataFrame([], SCHEMA)
    for _, stage in pipeline.STAGES:
        assert stage(spark, docs, folder).collect() == []


@pytest.mark.skipif(not os.path.isdir(entry.SMOKE_DIR), reason="no driver data")
def test_every_operator_has_a_query(spark):
    names = [n for n in entry.queries() if re.match(r"op\d+_", n)]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14))
    assert entry.queries()["op6_chat_format"](spark, entry.SMOKE_DIR).filter("conv_id = -1").first().loss_chars == 21
