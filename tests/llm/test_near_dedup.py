import random

import numpy as np
import pytest
from compare import connect, difference
from pyspark.sql import functions as F

from txnlens.llm import near_dedup
from txnlens.llm.graph import components
from txnlens.llm.near_dedup import BANDS, band_hashes, drop_near, near_duplicates
from txnlens.llm.shingles import shingle_sets


def words(text):
    return (text or "").encode().lower().split()


def brute(rows, k):
    sets = []
    for _, text in rows:
        w = words(text)
        runs = {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else {tuple(w)} if w else set()
        sets.append(runs)
    head = list(range(len(rows)))

    def find(i):
        while head[i] != i:
            i = head[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            union = len(sets[i] | sets[j])
            if union and 100 * both >= 80 * union:
                a, b = sorted((find(i), find(j)), key=lambda x: rows[x][0])
                head[b] = a
    return sorted((rows[i][0], len(sets[i]), rows[find(i)][0]) for i in range(len(rows)))


def made(seed=3):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    rows, doc_id = [], 100
    for group in range(25):
        base = [rng.choice(vocabulary) for _ in range(rng.choice([8, 40, 120]))]
        for _ in range(rng.choice([1, 2, 6, 20])):
            copy = list(base)
            for _ in range(rng.choice([0, 1, 1, 2, 4, 8])):
                copy[rng.randrange(len(copy))] = rng.choice(vocabulary)
            rows.append((doc_id, (" " if doc_id % 3 else "\n ").join(copy)))
            doc_id += rng.choice([1, 7])
    shared = [rng.choice(vocabulary) for _ in range(150)]
    rows += [(2000 + i, " ".join(shared + [rng.choice(vocabulary) for _ in range(60)])) for i in range(40)]
    rows += [(1, None), (2, ""), (3, "Two words"), (4, "two WORDS"), (5, "two words more"), (6, " \n ")]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("k", [4, 5])
def test_components_agree_with_brute_force(make_docs, k):
    rows = made()
    docs = make_docs(rows).withColumn("label", F.lit("clash")).withColumn("class", F.lit(0))
    found = near_duplicates(docs, words=k).collect()
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in found) == brute(rows, k)
    assert all(r.kept == (r.doc_id == r.component_id) for r in found)


def test_one_document_of_each_component_stays(make_docs):
    rows = made(5)
    docs = make_docs(rows).withColumn("_key", F.lit("clash"))
    left = drop_near(docs)
    assert left.columns == docs.columns
    assert sorted(r.doc_id for r in left.collect()) == sorted({c for _, _, c in brute(rows, 5)})


@pytest.mark.parametrize("folder", ["/root/testdata/sf0.001", "/root/testdata/sf0.01"])
def test_agrees_with_sql(spark, folder):
    assert difference(near_dedup.op6_minmax_near_dedup(spark, folder), connect(folder), near_dedup.OP6_SQL) is None


def test_a_family_below_the_threshold_is_compared_in_blocks(make_docs, monkeypatch):
    monkeypatch.setattr(near_dedup, "HUBS", (1,))
    monkeypatch.setattr(near_dedup, "BLOCK", 8)
    rng = random.Random(8)
    texts = [[f"t{i}" for i in range(120)]]
    for _ in range(150):  # copies of copies, so that edits are shared
        copy = list(rng.choice(texts))
        for _ in range(rng.choice([1, 2, 3, 6])):
            copy[rng.randrange(len(copy))] = f"e{rng.randrange(10**6)}"
        texts.append(copy)
    rows = [(i, " ".join(t)) for i, t in enumerate(texts)]
    compared = []
    links = near_dedup.block_links
    monkeypatch.setattr(near_dedup, "block_links", lambda *a: compared.append(links(*a)) or compared[-1])
    found = near_duplicates(make_docs(rows), words=4).collect()
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in found) == brute(rows, 4)
    assert compared and compared[0].count()


def test_chain_is_one_component(make_docs):
    base = [f"t{i}" for i in range(300)]
    rows = [(i, " ".join([f"x{i}-{j}" if j < 6 * i else w for j, w in enumerate(base)])) for i in range(12)]
    found = near_duplicates(make_docs(rows), words=4).collect()
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in found) == brute(rows, 4)


def test_empty_table_and_null_ids(make_docs):
    assert near_duplicates(make_docs([])).collect() == []
    found = near_duplicates(make_docs([(None, "a b c d e f"), (7, "a b c d e f"), (7, "a b c d e f")])).collect()
    assert sorted((r.doc_id is None, r.component_id, r.kept) for r in found) == [
        (False, 7, True), (False, 7, True), (True, 7, False),
    ]


def test_signature_agreement_is_the_similarity():
    a = shingle_sets([" ".join(f"v{i}" for i in range(900))], 1)[0]
    b = shingle_sets([" ".join(f"v{i}" for i in range(300, 1200))], 1)[0]
    got = [(band_hashes([a, b], bands=400, rows=1)[0] == band_hashes([a, b], bands=400, rows=1)[1]).mean()]
    assert abs(got[0] - 0.5) < 0.08
    assert band_hashes([a], BANDS).shape == (1, BANDS)


def test_components_of_a_long_path(spark):
    n = 70
    edges = spark.createDataFrame([(i, i + 1) for i in range(n)] + [(200, 300), (300, 300), (None, 4)], "a long, b long")
    got = {r.node: r.label for r in components(edges).collect()}
    assert got == {**{i: 0 for i in range(n + 1)}, 200: 200, 300: 200}
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_the_filter_loses_no_wanted_row(spark, monkeypatch):
    from txnlens.llm import common

    rows = [(i, f"k{i}".encode()) for i in range(5000)] + [(-1, None)]
    df = spark.createDataFrame(rows, "i long, _key binary")
    wanted = spark.createDataFrame([(f"k{i}".encode(),) for i in range(0, 9000, 3)] + [(None,)], "_key binary")
    for bits in (common.FILTER_BITS, 1 << 16, 1 << 15):
        monkeypatch.setattr(common, "FILTER_BITS", bits)
        likely, rest = (sorted(r.i for r in x.collect()) for x in common.split_by_filter(df, "_key", wanted))
        assert set(range(0, 5000, 3)) <= set(likely) and -1 in rest
        assert sorted(likely + rest) == list(range(-1, 5000))
    likely, rest = common.split_by_filter(df, "_key", wanted.limit(0))
    assert likely.isEmpty() and rest.count() == 5001
