from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from txnlens.llm.mixing import DOCUMENT_LEVELS, mix_once, mixture, op10_hierarchical_mix

LEVELS = {"lang": "lang", "source": "source"}


def pour(given, children):
    """Budgets of (name, weight, capacity), filling the fullest first."""
    out, left, open_ = {}, given, [c for c in children if c[1] > 0]
    for name, _, _ in children:
        out[name] = 0.0
    while open_:
        total = sum(c[1] for c in open_)
        full = [c for c in open_ if left * c[1] / total >= c[2]]
        if not full:
            for name, weight, _ in open_:
                out[name] = left * weight / total
            break
        for name, _, capacity in full:
            out[name] = capacity
        left -= sum(c[2] for c in full)
        open_ = [c for c in open_ if c not in full]
    return out


def brute(leaves, levels, weight, budget, epochs):
    """leaves: path -> tokens. Gives path -> budget."""
    given = {(): budget}
    for depth in range(1, levels + 1):
        capacity = defaultdict(float)
        for path, tokens in leaves.items():
            capacity[path[:depth]] += tokens * epochs
        following = {}
        for parent, amount in given.items():
            children = [(p, weight(p), c) for p, c in capacity.items() if p[:-1] == parent]
            following.update(pour(amount, children))
        given = following
    return given


def leaf_state(rows, names):
    leaves = {}
    for r in rows:
        path = tuple(r[n] for n in names)
        leaves.setdefault(path, []).append(r)
    return leaves


def hold(rows, names, weight, budget, epochs):
    leaves = leaf_state(rows, names)
    tokens = {p: sum(r.tokens for r in rs) for p, rs in leaves.items()}
    want = brute(tokens, len(names), weight, budget * sum(tokens.values()), epochs)
    for path, rs in leaves.items():
        assert {r.leaf_tokens for r in rs} == {tokens[path]}
        assert abs(rs[0].leaf_budget - want[path]) <= 1 + 1e-6 * want[path], path
        got = sum(r.tokens * r.copies for r in rs)
        longest = max(r.tokens for r in rs)
        assert got <= want[path] + 1e-6 * want[path] + 1
        assert got > want[path] - longest - 1 or got == tokens[path] * epochs
        copies = {r.copies for r in rs}
        assert max(copies) - min(copies) <= 1 and max(copies) <= epochs
    return want


def weight(path):
    return {"en": 3.0}.get(path[0], 1.0) if len(path) == 1 else 1.0


def make_rows():
    rows = [(i, "w " * (1 + i % 7), "en", f"s{i % 3}") for i in range(200)]
    rows += [(300 + i, "x y\tz\n", "fr", "small") for i in range(4)]
    rows += [(400 + i, "a b", "de", f"t{i % 9}") for i in range(90)]
    return rows + [(500, None, None, None), (501, " \n", "de", "t0"), (502, "hm " * 3000, "de", "t1"), (None, "a", "en", "s0"), (7, "w", "en", "s0"), (7, "w", "en", "s0")]


@pytest.mark.parametrize("budget,epochs", [(0.4, 1), (1.5, 2), (5.0, 2), (0.0, 1)])
def test_budgets_agree_with_brute_force(make_docs, budget, epochs):
    docs = make_docs(make_rows()).withColumn("tokens", F.lit("clash")).withColumn("_leaf", F.lit(0))
    weights = {"lang": "CASE WHEN lang = 'en' THEN 3 ELSE 1 END"}
    rows = mixture(docs, LEVELS, weights, budget, epochs).collect()
    assert len(rows) == len(make_rows())
    want = hold(rows, ("lang", "source"), weight, budget, epochs)
    if budget == 5.0:
        assert all(r.copies == (2 if r.leaf_tokens else 0) for r in rows)
    assert want[("fr", "small")] <= 12 * epochs


def test_zero_weights_get_nothing(make_docs):
    weights = {"lang": "CASE lang WHEN 'de' THEN 0 WHEN 'fr' THEN NULL ELSE 1 END"}
    rows = mixture(make_docs(make_rows()), LEVELS, weights, 0.2, 1).collect()
    assert all(r.copies == 0 for r in rows if r.lang in ("de", "fr"))
    assert sum(r.copies for r in rows if r.lang == "en") > 0


def test_a_hot_leaf_is_cut_into_buckets(make_docs):
    rows = [(i, "w " * (1 + i % 5), "en", "hot") for i in range(9000)] + [(10_000 + i, "a b", "en", "cold") for i in range(9)]
    got = mixture(make_docs(rows), LEVELS, None, 0.5, 1).collect()
    hold(got, ("lang", "source"), lambda p: 1.0, 0.5, 1)
    again = mixture(make_docs(rows, 7), LEVELS, None, 0.5, 1).collect()
    assert {(r.doc_id, r.copies) for r in got} == {(r.doc_id, r.copies) for r in again}
    other = mixture(make_docs(rows), LEVELS, None, 0.5, 1, seed=5).collect()
    assert {(r.doc_id, r.copies) for r in got} != {(r.doc_id, r.copies) for r in other}


def test_mix_of_one_epoch_keeps_rows_as_they_are(make_docs):
    docs = make_docs(make_rows()).withColumn("copies", F.lit("clash"))
    left = mix_once(docs, 0.6)
    assert left.columns == docs.columns
    full = mixture(docs, DOCUMENT_LEVELS, None, 0.6, 1).collect()
    assert {r.doc_id for r in left.collect()} == {r.doc_id for r in full if r.copies}
    assert sorted((r.doc_id for r in mix_once(docs, 9.0).collect()), key=repr) == sorted((r[0] for r in make_rows() if r[0] != 500), key=repr)


def test_empty_table(make_docs):
    assert mixture(make_docs([]), LEVELS).collect() == []
    assert mix_once(make_docs([]), 0.5).collect() == []


def test_whole_table(spark):
    rows = op10_hierarchical_mix(spark, "/root/testdata/sf0.01").collect()
    assert len(rows) == 1000

    def named(path):
        return {"domain0": 2.0, "en": 3.0}.get(path[-1], 1.0)

    hold(rows, ("domain", "lang", "source"), named, 0.5, 2)


@pytest.mark.parametrize("closed", ["0", "-1", "NULL"])
def test_what_closed_leaves_cannot_take_goes_to_other_branches(make_docs, closed):
    rows = [(i, "a b", lang, source) for i, (lang, source) in enumerate([("en", "p"), ("en", "q"), ("de", "r")] * 30)]
    weights = {"source": f"CASE WHEN source = 'q' THEN {closed} ELSE 1 END"}
    more = rows + [(90 + i, "a b", "de", "r") for i in range(30)]
    found = mixture(make_docs(more), LEVELS, weights, budget=0.7, epochs=1).collect()
    # 168 of 240 tokens: half would be 84, en can take 60, so de has 108.
    assert {r.source: r.leaf_budget for r in found} == {"p": 60, "q": 0, "r": 108}


@pytest.mark.parametrize("epochs", [1, 2])
def test_texts_without_tokens_have_no_copies_beyond_the_epochs(make_docs, epochs):
    rows = [(i, "" if i % 3 else "a b", "en", "s") for i in range(60)]
    found = mixture(make_docs(rows), LEVELS, None, budget=9.0, epochs=epochs).collect()
    assert {r.copies for r in found} == {epochs}
    part = mixture(make_docs(rows), LEVELS, None, budget=0.5, epochs=epochs).collect()
    assert {r.copies for r in part} <= {0, 1}
