import zlib
from collections import defaultdict
from hashlib import sha256

import pytest
from pyspark.sql import functions as F

from txnlens.llm.merkle import Manifest, op13_recursive_manifest, steps_to_one

SOURCES = (None, "", "a", "B", "é", "z")


def h(text):
    return sha256(text.encode()).hexdigest()


def leaf(row, lower=False):
    doc_id, text, lang, source, n_chars = row
    if lower and text is not None:
        text = "".join(c.lower() if c.isascii() else c for c in text)
    values = (doc_id, source, lang, n_chars, text)
    return h("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def climb(nodes, arity):
    """Root of a list of digests and the siblings of each of them, bottom up."""
    proofs, places, levels = [[] for _ in nodes], list(range(len(nodes))), nodes
    while len(levels) > 1:
        for i, place in enumerate(places):
            start = place // arity * arity
            run = levels[start : start + arity]
            proofs[i].append((run[: place - start], run[place - start + 1 :]))
            places[i] = place // arity
        levels = [h("".join(levels[i : i + arity])) for i in range(0, len(levels), arity)]
    return levels[0], proofs


def brute(rows, arity=16):
    by_source = defaultdict(list)
    for row in rows:
        by_source[row[3]].append(row)
    order = sorted(by_source, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for s in order:
        ordered = sorted(by_source[s], key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
        trees[s] = (ordered, *climb([leaf(r) for r in ordered], arity))
    root, tops = climb([trees[s][1] for s in order], arity)
    found = []
    for s, top in zip(order, tops):
        ordered, subroot, proofs = trees[s]
        for row, proof in zip(ordered, proofs):
            whole = proof + top
            folded = leaf(row, zlib.crc32(str("" if row[0] is None else row[0]).encode()) % 5 == 0)
            for left, right in whole:
                folded = h("".join([*left, folded, *right]))
            joined = "".join("".join(left + right) for left, right in whole)
            found.append((row[0], leaf(row), subroot, root, h(joined), folded, folded == root))
    return sorted(found, key=repr)


def got(df):
    columns = ["doc_id", "leaf", "subroot", "root", "proof", "folded_root", "verified"]
    return sorted((tuple(r) for r in df.withColumn("proof", F.sha2("proof", 256)).select(columns).collect()), key=repr)


def full(rows):
    return [(*r, len(r[1] or "")) for r in rows]


@pytest.mark.parametrize("arity", [2, 3, 16])
def test_sources_of_many_sizes_against_brute_force(make_docs, arity):
    rows = [(i, f"Text {i} É {'X' * (i % 3)}", "en", SOURCES[min(i % 7, i % 11, 5)]) for i in range(150)]
    rows += [(1000, "Alone", "de", "lone"), (1001, "AB", None, "q"), (1002, "AB", "de", "q")]
    assert got(Manifest(make_docs(rows), arity).proofs()) == brute(full(rows), arity)


def test_many_sources_make_a_deep_top(make_docs):
    rows = [(i, f"T{i}", "en", f"host{i % 290}") for i in range(400)]
    assert got(Manifest(make_docs(rows)).proofs()) == brute(full(rows))


def test_last_run_of_one_is_hashed_as_well(make_docs):
    rows = [(i, f"T{i}", "en", "s") for i in range(17)]
    assert got(Manifest(make_docs(rows)).proofs()) == brute(full(rows))


def test_nulls_ties_and_repeated_rows(make_docs):
    rows = [(None, None, None, None), (None, None, None, None), (3, "A", "en", "s"), (3, "B", "en", "s")]
    rows += [(3, "A", "en", "s")] * 40 + [(5, "", None, "s"), (8, None, "en", "s"), (-7, "Ä", "en", "")]
    assert got(Manifest(make_docs(rows)).proofs()) == brute(full(rows))


def test_single_row_single_source_and_empty_table(make_docs):
    assert got(Manifest(make_docs([(4, "X")])).proofs()) == brute(full([(4, "X", "en", "s")]))
    rows = [(i, f"T{i}", "en", "s") for i in range(40)]
    assert got(Manifest(make_docs(rows)).proofs()) == brute(full(rows))
    assert got(Manifest(make_docs([])).proofs()) == []


def test_tampering_shows_exactly_where_letters_changed(make_docs):
    rows = [(i, "lower only" if i % 2 else "Has Capitals", "en", f"s{i % 3}") for i in range(200)]
    for r in Manifest(make_docs(rows)).proofs().collect():
        touched = zlib.crc32(str(r.doc_id).encode()) % 5 == 0 and r.doc_id % 2 == 0
        assert r.verified is not touched


def test_long_text_and_clashing_columns(make_docs, stored_docs, spark):
    rows = [(1, "Word " * 2_000_000, "en", "s"), (2, "b", "en", "s"), (3, "c", "en", "t")]
    docs = make_docs(rows)
    for name in ("tree", "pos", "digest", "leaf", "_part", "_at", "slot", "run"):
        docs = docs.withColumn(name, F.lit("clash"))
    found = op13_recursive_manifest(spark, stored_docs(None, df=docs))
    columns = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    assert sorted((tuple(r) for r in found.select(columns).collect()), key=repr) == brute(full(rows))


def test_result_does_not_depend_on_the_split(make_docs, spark):
    rows = [(i % 90, f"T{i}", "en", SOURCES[i % 6]) for i in range(300)]
    want = brute(full(rows))
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        for parts in (1, 23):
            spark.conf.set("spark.sql.shuffle.partitions", str(parts))
            assert got(Manifest(make_docs(rows, parts)).proofs()) == want
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_session_limits_are_put_back(make_docs, spark):
    before = spark.conf.get("spark.sql.cteRecursionRowLimit")
    Manifest(make_docs([(1, "a"), (2, "b")])).proofs()
    assert spark.conf.get("spark.sql.cteRecursionRowLimit") == before


def test_steps():
    assert [steps_to_one(n) for n in (0, 1, 2, 16, 17, 256, 257)] == [0, 0, 1, 1, 2, 2, 3]
