import hashlib
import re
from collections import defaultdict

import pytest
from compare import connect, difference
from pyspark.sql import functions as F

from txnlens.llm.exact_dedup import OP4_SQL, drop_exact, exact_duplicates, op4_progressive_dedup

ROWS = [
    (5, "one  two\nthree"),
    (3, "one two three"),
    (9, "one two\tthree "),
    (1, None),
    (2, ""),
    (7, "x" * 300 + "a"),
    (8, "x" * 300 + "b"),
    (10, "x" * 300 + "a"),
    (11, "one two three"),
    (11, "one two three"),
    (None, "lonely"),
    (None, "one two three"),
    (12, "nb space"),
    (13, "nb space"),
    (14, "long " * 50_000),
]


def brute(rows):
    def digest(text):
        return hashlib.sha256(re.sub(r"[\x20\x09-\x0D]+", " ", text or "").encode()).hexdigest()

    groups = defaultdict(list)
    for doc_id, text in rows:
        groups[digest(text)].append(doc_id)
    out = []
    for doc_id, text in rows:
        ids = groups[digest(text)]
        known = [i for i in ids if i is not None]
        out.append((doc_id, min(known) if known else None, len(ids), digest(text)))
    return sorted(out, key=repr)


def test_groups_agree_with_brute_force(make_docs):
    found = exact_duplicates(make_docs(ROWS).withColumn("keep_id", F.lit("clash"))).collect()
    assert sorted(((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in found), key=repr) == brute(ROWS)
    assert sum(r.kept for r in found) == len({r.text_sha256 for r in found})
    assert all(r.doc_id == r.keep_id for r in found if r.kept)


def test_one_whole_row_of_each_group_stays(make_docs):
    docs = make_docs(ROWS).withColumn("_n", F.lit("clash")).withColumn("_hash", F.lit(1))
    left = drop_exact(docs)
    assert left.columns == docs.columns
    assert sorted((r.doc_id for r in left.collect()), key=repr) == sorted([3, 9, 1, 7, 8, None, 12, 13, 14], key=repr)


def test_repeated_ids_of_one_text_leave_one_row(make_docs):
    assert [r.doc_id for r in drop_exact(make_docs([(4, "a b"), (4, "a b"), (4, "a  b"), (6, "a b")])).collect()] == [4]


def test_empty_table(make_docs):
    assert exact_duplicates(make_docs([])).collect() == []
    assert drop_exact(make_docs([])).collect() == []


@pytest.mark.parametrize("folder", ["/root/testdata/sf0.001", "/root/testdata/sf0.01"])
def test_agrees_with_sql(spark, folder):
    assert difference(op4_progressive_dedup(spark, folder), connect(folder), OP4_SQL) is None
