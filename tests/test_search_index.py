import math
import random

import pytest
from pyspark.sql import functions as F

from berthline.operators import listing as L
from berthline.operators import search_index as S
from conftest import plan_of

COLS = ("name", "fish")
SCHEMA = "ord int, name string, fish string, token string, gram string, slot int"


@pytest.fixture(scope="module")
def rows(spark):
    rng = random.Random(4)
    words = ["red", "reed", "gear", "geart", "big boat", "만선호", "만선", "a", "", "x" * 40, "Widget,promo", "widgets", "\U0001f41f fish", "it's 9%", "abcdefghijkl", "abcdefghijklmnop"]
    data = [(i, rng.choice(words) + rng.choice([" ", ",", " 7 ", ""]) + rng.choice(words), rng.choice([None, "cod, eel", "EEL", "ti\nn"]), "t", "g", 1) for i in range(300)]
    data += [(1000 + i, "hot one", "cod", "t", "g", 1) for i in range(400)] + [(2000, None, None, None, None, None)]
    return spark.createDataFrame(data, SCHEMA)


@pytest.fixture(scope="module")
def index(spark, rows, tmp_path_factory):
    return S.SearchIndex.build(rows, str(tmp_path_factory.mktemp("index") / "i"), COLS)


def ids(df):
    return sorted(r.ord for r in df.collect())


@pytest.mark.parametrize("query", ["red", "RED gear", "ee", "a", "7 9", "만선", "선호 eel", "\U0001f41f", "t boat", "9%", "n", "zzz", "red zzz", "", "hot one cod", "x" * 41, "x" * 40])
def test_words_equal_the_row_filter(rows, index, query):
    assert ids(index.search_words(query, [])) == ids(L.search_words(rows, query, [], COLS))
    assert index.search_words(query, []).columns == rows.columns


def test_synonyms(rows, index):
    synonyms = [("ship", ["ship", "boat", "만선호"]), ("none", ["qq"])]
    for query in ("ship", "ship red", "none", "shi"):
        assert ids(index.search_words(query, synonyms)) == ids(L.search_words(rows, query, synonyms, COLS))


@pytest.mark.parametrize("query", ["widgt", "gaer", "geer red", "reeed", "만선호호", "abcdefghijkm", "abcdefghijklmnxx", "x" * 38, "hott coda", "7", "qqq", "bcdefghijkl"])
@pytest.mark.parametrize("tolerance", [0.35, 0.2, 0.6])
def test_fuzzy_equals_the_row_filter(rows, index, query, tolerance):
    assert ids(index.fuzzy_search(query, [], tolerance)) == ids(L.fuzzy_search(rows, query, [], COLS, tolerance))


def test_variants_meet_within_the_edits(spark):
    rng = random.Random(1)
    words = ["".join(rng.choice("abc") for _ in range(rng.randrange(1, 8))) for _ in range(150)]
    pairs = spark.createDataFrame([(a, b) for a in words[:40] for b in words], "a string, b string")
    for r in pairs.withColumn("d", F.levenshtein("a", "b")).filter(f"d <= {S.DELETES}").collect():
        assert set(S.variants_of(r.a, r.d)) & set(S.variants_of(r.b, S.DELETES)), r
    # what the table holds is what the lookup asks for
    levels = [F.array("b")]
    for _ in range(S.DELETES):
        levels.append(S._shorter(levels[-1]))
    for r in pairs.select("b", F.array_distinct(F.concat(*levels)).alias("v")).distinct().limit(60).collect():
        assert sorted(r.v) == S.variants_of(r.b, S.DELETES)


def partitions_read(df, table):
    """Partition filters of the scans of one of the index's tables."""
    lines = [line for line in plan_of(df).split("\n") if "FileScan" in line and f"/{table}]" in line]
    assert lines
    return lines


def test_lookups_read_their_slots_only(index):
    for line in partitions_read(index.containing("promo"), "postings"):
        wanted = line.split("PartitionFilters: [")[1].split("]")[0]
        assert "slot" in wanted and "PushedFilters: [In" in line.replace("EqualTo", "In").replace("IsNotNull(gram), In", "In")
    assert len({f.split("slot=")[1].split("/")[0] for f in index._looked_up("postings", "gram", ["red"]).inputFiles()}) <= S.SLOTS[0]
    assert "/variants]" in plan_of(index.near_tokens("gear", 1)) and "/tokens]" not in plan_of(index.near_tokens("gear", 1))
    assert all("slot" in line.split("PartitionFilters: [")[1].split("]")[0] for line in partitions_read(index.near_tokens("gear", 1), "variants"))
    # rows are read last, by the slots of the texts that were found
    found = index.search_words("widget promo", [])
    assert all("dynamicpruning" in line for line in partitions_read(found, "rows"))
    assert {"gear", "geart"} <= {r.token for r in index.near_tokens("gear", 1).collect()}


def test_rarest_lists_first(index):
    sizes = {r.gram: r.n for r in index._looked_up("grams", "gram", S.pieces_of("hot one")).collect()}
    assert set(sizes) == set(S.pieces_of("hot one"))
    assert math.ceil(sum(sizes.values())) > 0 and index.containing("qqq").isEmpty()


def test_empty_listing(spark, rows, tmp_path):
    index = S.SearchIndex.build(rows.filter("false"), str(tmp_path / "none"), COLS)
    assert index.search_words("red", []).count() == 0 and index.fuzzy_search("red", []).count() == 0 and index.search_words("", []).count() == 0
