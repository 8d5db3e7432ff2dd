import random
import re
from itertools import combinations

import pytest
from pyspark.sql import functions as F

from berthline.llm import queries, url_rules

SCHEMA = "page_id long, url string, host string, verdict string, tokens string"
CUT = re.compile(r"(.*?)://([^/?#]*)([^?#]*)(?:\?([^#]*))?(?:#(.*))?\Z", re.S)
RULES = queries.URL_RULES


def lower(s):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in s)


def cut(url):
    m = CUT.match(url or "")
    if not m:
        return "", "", set()
    scheme, host, path, query, fragment = (g or "" for g in m.groups())
    kinds = (("s:", [lower(scheme)]), ("h:", lower(host).split(".")), ("p:", path.split("/")), ("q:", query.split("&")), ("f:", [fragment]))
    return lower(host), path, {k + w for k, words in kinds for w in words if w}


def given(host, path, rules=RULES):
    fits = [(len(h + p), h + p, v) for h, p, v in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return max(fits)[1:] if fits else (None, None)


def brute(urls, least_urls=8, per_mille=5, confidence=90, most=10):
    """Rules by counting all subsets, then verdicts by trying every rule."""
    known = {u: (*cut(u), *given(*cut(u)[:2])) for u in set(urls) if u is not None}
    least = max(least_urls, -(-len(known) * per_mille // 1000))
    labels = {v: sum(k[4] == v for k in known.values()) for v in ("block", "allow")}
    count = {}
    for _, _, tokens, _, verdict in known.values():
        for t in tokens:
            c = count.setdefault(t, {"n": 0, "block": 0, "allow": 0})
            c["n"] += 1
            if verdict:
                c[verdict] += 1
    telling = {t: max(abs(c[v] * len(known) - c["n"] * n) for v, n in labels.items() if n) for t, c in count.items() if c["n"] >= least and any(labels.values())}
    sets = {}
    for _, _, tokens, _, verdict in known.values():
        chosen = sorted(sorted(tokens & set(telling), key=lambda t: (-telling[t], t))[:most])
        for size in range(1, len(chosen) + 1):
            for s in combinations(chosen, size):
                c = sets.setdefault(s, {"n": 0, "block": 0, "allow": 0})
                c["n"] += 1
                if verdict:
                    c[verdict] += 1
    rules = [(c[v] / c["n"], c[v], v, " ".join(s), set(s)) for s, c in sets.items() for v in ("block", "allow") if c[v] >= least and 100 * c[v] >= confidence * c["n"]]
    out = []
    for u in urls:
        host, path, tokens, rule, verdict = known.get(u, ("", "", set(), None, None))
        best = max((r[:4] for r in rules if r[4] <= tokens), default=None) if rule is None else None
        out.append((host, path, rule, verdict or (best[2] if best else "allow"), best[3] if best else None))
    return out


def urls_of(seed, n):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(6)]
    out = []
    for _ in range(n):
        host = ".".join(rng.sample(words, rng.randrange(0, 3)) + [rng.choice(["example", "Other"]), rng.choice(["net", "com", "ORG"])])
        path = "".join("/" + rng.choice(["en", "de", "fr", rng.choice(words)]) for _ in range(rng.randrange(0, 4))) + rng.choice(["", "/"])
        out.append(rng.choice(["http", "HTTPS"]) + "://" + host + path + rng.choice(["", "?", f"?a={rng.randrange(3)}&b=1", "?x#y"]) + rng.choice(["", "#top"]))
    return out


def judged(spark, urls, **limits):
    df = spark.createDataFrame([(i, u, "x", "y", "z") for i, u in enumerate(urls)], SCHEMA)
    found = url_rules.judge(df, url_rules.rule_table(spark, RULES), **limits)
    assert found.columns == ["page_id", "host", "path", "rule", "verdict", "evidence"]
    return [tuple(r)[1:] for r in sorted(found.collect())]


@pytest.mark.parametrize(("seed", "limits"), [(1, {}), (2, {"least_urls": 2, "least_per_mille": 1, "confidence": 75, "tokens_per_url": 4})])
def test_equals_brute_force(spark, seed, limits):
    urls = urls_of(seed, 300)
    want = brute(urls, *limits.values())
    assert judged(spark, urls, **limits) == want
    assert {w[3] for w in want if w[2] is None} == {"block", "allow"} and any(w[4] for w in want)


def test_odd_urls(spark):
    hot = "http://a.example.net/x"
    urls = [None, "", "no scheme", "://", "a://b", "x://NET/", "x://net", "x://net/a?b://c#d", "http://xnet/", "http://example.com/de/\n?q", "http://a.ORG/fr/\u00c9#", "s://h/" + "/".join(map(str, range(20_000)))]
    urls += [hot] * 200 + urls_of(3, 60)
    assert judged(spark, urls) == brute(urls)


def test_a_hot_url_is_one_piece_of_evidence(spark):
    urls = ["http://bad.example.net/same/path/of/many/tokens?a=1&b=2&c=3#x"] * 500 + ["http://bad.example.com/same"] * 3 + [f"http://h{i}.com/" for i in range(30)]
    assert {r[3] for u, r in zip(urls, judged(spark, urls)) if ".com/same" in u} == {"allow"}


def test_without_pages_or_labels(spark):
    assert judged(spark, []) == []
    assert judged(spark, ["http://a.com/"] * 20 + [None]) == [("a.com", "/", None, "allow", None)] * 20 + [("", "", None, "allow", None)]


def test_rules_are_posted_under_their_rarest_token(spark):
    rows = [(f"u{i}", ["common", "rare"] if i < 10 else ["common"], "block" if i < 10 else None) for i in range(40)]
    urls = spark.createDataFrame(rows, "url string, tokens array<string>, verdict string")
    rules = {tuple(r.tokens): (r.verdict, r.hits, r.n, r.rarest) for r in url_rules.mine(urls).collect()}
    assert rules == {("rare",): ("block", 10, 10, "rare"), ("common", "rare"): ("block", 10, 10, "rare")}
    plan = url_rules.matched(urls, url_rules.mine(urls).filter(F.lit(True)))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_all_frequent_tokens_are_mined(spark):
    """25 tokens tell more alone than a and b do, but only with a and b together is every URL blocked."""
    many = [f"t{i}" for i in range(25)]
    kinds = [(20, [*many, "a", "b"], "block"), (10, many, None), (15, ["a"], None), (15, ["b"], None)]
    rows = [(f"{k}-{i}", tokens, verdict) for k, (n, tokens, verdict) in enumerate(kinds) for i in range(n)]
    urls = spark.createDataFrame(rows, "url string, tokens array<string>, verdict string")
    rules = {tuple(r.tokens): (r.verdict, r.hits, r.n, r.rarest) for r in url_rules.mine(urls).collect()}
    assert rules == {("a", "b"): ("block", 20, 20, "a"), **{k: ("block", 20, 20, "t9") for k in [("a", "t9"), ("b", "t9"), ("a", "b", "t9")]}}
    told = url_rules.matched(urls, url_rules.mine(urls)).collect()
    assert sorted(r.url for r in told) == sorted(f"0-{i}" for i in range(20)) and {r.verdict for r in told} == {"block"}
