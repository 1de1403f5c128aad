from __future__ import annotations

import math
import random

import parity
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from rivulet.llm import queries, topk, urlfilter

SF_DIR = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", list(queries.ORACLES))
def test_query_matches_sql(spark, name):
    con = parity.connect(SF_DIR)
    assert parity.compare(spark, con, queries.QUERIES[name], queries.ORACLES[name], SF_DIR) == ""


def brute(rows, asked, k):
    def fine(v):
        return v is not None and all(x is not None and math.isfinite(x) for x in v)

    whole = [(i, [math.floor(64 * x) for x in v]) for i, v in rows if i is not None and fine(v)]
    out = set()
    for q in asked:
        own = min(v for i, v in whole if i == q)
        scored = sorted((-sum(a * b for a, b in zip(own, v)), i) for i, v in whole if i != q)
        out |= {(q, n + 1, i, -s) for n, (s, i) in enumerate(scored[:k])}
    return out


@pytest.mark.parametrize("block_rows, group_rows", [(7, 3), (64, 512), (200, 5)])
def test_topk_against_brute_force(spark, block_rows, group_rows):
    draw = random.Random(block_rows)
    rows = [(i, [draw.choice([-1.5, -0.26, 0.0, 0.3, 2.0]) for _ in range(5)]) for i in range(150)]
    rows += [(1000 + i, [0.3] * 5) for i in range(60)]  # ties
    rows += [(300, None), (301, [1.0, None, 0.0, 0.0, 0.0]), (302, [float("nan")] * 5), (303, [float("inf")] * 5),
             (None, [1.0] * 5), (304, []), (305, [9.0])]
    df = spark.createDataFrame([(i, v, "z") for i, v in rows], "vec_id bigint, embedding array<double>, id string")
    asked = [0, 20, 40, 304, 305, 1000]
    found = topk.bit_sliced_topk(df, df.where(df.vec_id.isin(asked)), 20, block_rows=block_rows,
                                 group_rows=group_rows).collect()
    assert {(r.query_id, r.rank, r.vec_id, r.score) for r in found} == brute(rows, asked, 20)


def test_topk_few_rows_repeats_and_empty(spark):
    rows = [(1, [1.0, 2.0]), (2, [2.0, 0.0]), (2, [0.5, 0.5]), (3, [1.0, 2.0])]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>")
    found = sorted(tuple(r) for r in topk.bit_sliced_topk(df, df.where("vec_id = 1"), 20).collect())
    assert found == [(1, 1, 3, 20480), (1, 2, 2, 8192), (1, 3, 2, 6144)]
    none = df.where("false")
    assert topk.bit_sliced_topk(df, none).count() == topk.bit_sliced_topk(none, df).count() == 0


def test_urls_edges(spark):
    rows = [(1, "HTTP://WWW.Example.COM/en/x"), (2, "http://example.com/en/"), (3, "http://a.example.com/EN/"),
            (4, "ftp://x.net/es/?q"), (5, "http://net/fr/1"), (6, "http://com"), (7, "http://xcom/"), (8, None),
            (9, ""), (10, "no scheme"), (11, "http://a.org/.com/"), (12, "http:///en/"), (13, "x://y.com?a/b"),
            (14, "http://example.com/" + "a" * 50_000), (14, "http://b.net/es/#x"), (15, "://É.com/é")]
    df = spark.createDataFrame([(i, u, "z", "z") for i, u in rows], "page_id bigint, url string, host string, rule string")
    judged = urlfilter.judge_urls(df, queries.URL_RULES).collect()
    found = {(r.page_id, r.host, r.rule, r.verdict) for r in judged}
    want = {1: ("www.example.com/en/", "allow"), 2: ("example.com/en/", "block"), 3: ("com/", "allow"),
            4: ("net/es/", "block"), 5: ("net/fr/", "block"), 15: ("com/", "allow")}
    for i, _ in rows:
        if i != 14:
            assert {(r[2], r[3]) for r in found if r[0] == i} == {want.get(i, (None, "allow"))}, i
    assert {(r[2], r[3]) for r in found if r[0] == 14} == {("com/", "allow"), ("net/es/", "block")}
    assert urlfilter.judge_urls(df.where("false"), queries.URL_RULES).count() == 0
    assert {r.verdict for r in urlfilter.judge_urls(df, [], otherwise="keep").collect()} == {"keep"}


def glob_fits(rule: str, host: str, path: str) -> bool:
    import re

    def pattern(part):
        return "".join("[^\0]*" if c == "*" else "[^\0]" if c == "?" else re.escape(c) for c in part)

    own, slash, rest = rule.partition("/")
    return re.match(f"[^\0]*\\.{pattern(own)}\0{pattern(slash + rest)}", f".{host}\0{path}", re.S) is not None


text = st.text("ab./*?", max_size=8)


@settings(max_examples=300, deadline=None)
@given(st.lists(text, min_size=1, max_size=6), st.lists(st.tuples(
    st.text("ab.", max_size=70), st.text("ab/.", max_size=10)), min_size=1, max_size=5))
def test_automaton_against_patterns(rules, urls):
    found = urlfilter.Automaton(rules).first_match([h for h, _ in urls], [p for _, p in urls])
    for (host, path), number in zip(urls, found):
        fits = [i for i, r in enumerate(rules) if glob_fits(r, host, path)]
        assert number == (fits[0] if fits else -1)
