import math
import random
import tracemalloc
import zlib
from collections import Counter
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from txnlens.llm.common import fold
from txnlens.llm.shingles import words
from txnlens.llm.suffix_tree import (
    END,
    MARK,
    Tree,
    Vocabulary,
    _count_grams,
    _count_words,
    build,
    op1_suffix_tree,
    suffix_tree_scores,
    token_scores,
)


def split(text):
    return (text or "").encode().lower().split() + [b""]


def held(doc_id):
    return zlib.crc32(str(doc_id).encode() if doc_id is not None else b"") % 7 == 2


class Brute:
    """The same model from dictionaries."""

    def __init__(self, texts, depth, least, strength):
        self.depth, self.strength = depth, strength
        seqs = [split(t) for t in texts]
        self.c = Counter(w for s in seqs for w in s)
        self.n, self.v = sum(self.c.values()), len(self.c)
        self.grams = Counter()
        for s in seqs:
            full = ["^", *s]
            for d in range(2, depth + 2):
                for i in range(len(full) - d + 1):
                    self.grams[tuple(full[i : i + d])] += 1
        self.context = Counter({(w,): k for w, k in self.c.items() if k >= least})
        self.context[("^",)] = len(seqs)
        self.context[(b"",)] = self.c[b""]
        frequent = set(self.context)
        self.next = {}
        for d in range(2, depth + 2):
            grams = {g: k for g, k in self.grams.items() if len(g) == d and k >= least and g[:-1] in frequent and (g[-1:] in frequent)}
            for g, k in grams.items():
                self.next.setdefault(g[:-1], {})[g[-1]] = k
            self.context.update(grams)
            frequent |= set(grams)
        self.keep = set()
        for s in [s for s in self.next if len(s) <= depth]:
            n, nexts = self.context[s], self.next[s]
            above = {w: self.p(w, s[1:]) for w in nexts}
            rest = n - sum(nexts.values())
            gain = sum(k * math.log(k / n / above[w]) for w, k in nexts.items())
            if rest > 0:
                gain += rest * math.log(rest / n / (1 - sum(above.values())))
            if gain > 0.5 * (len(nexts) + 1) * math.log(self.n):
                self.keep.add(s)
        for s in list(self.keep):
            while len(s) > 1:
                s = s[1:]
                self.keep.add(s)

    def p(self, w, s):
        if not s:
            return (self.c[w] + 1) / (self.n + self.v + 1)
        n, nexts = self.context[s], self.next.get(s, {})
        if w in nexts:
            return (nexts[w] + self.strength * self.p(w, s[1:])) / (n + self.strength)
        left = 1 - sum(self.p(x, s) for x in nexts)
        return left / (1 - sum(self.p(x, s[1:]) for x in nexts)) * self.p(w, s[1:])

    def score(self, text):
        full, total = ["^", *split(text)], 0.0
        for i in range(1, len(full)):
            state = ()
            for d in range(self.depth, 0, -1):
                s = tuple(full[max(0, i - d) : i])
                if len(s) == d and s in self.keep:
                    state = s
                    break
            total += math.log10(self.p(full[i], state))
        return total


def corpus(n=260):
    rng = random.Random(1)
    phrases = [[rng.choice("abcdefgh") + str(rng.randrange(4)) for _ in range(5)] for _ in range(12)]
    rows = []
    for i in range(n):
        body = [w for _ in range(rng.randrange(0, 9)) for w in rng.choice(phrases)]
        body += [f"Rare{rng.randrange(900)}" for _ in range(rng.randrange(3))]
        rows.append((i, " ".join(body)))
    return rows + [(1000, None), (1001, ""), (1001, "\n a0 \t A0"), (1002, "b1 " * 3000), (None, "c2 c2")]


@pytest.mark.parametrize("depth", [1, 3])
def test_agrees_with_dictionaries(make_docs, depth):
    rows = corpus()
    docs = make_docs(rows).withColumn("ids", F.lit("clash")).withColumn("_row", F.lit(1))
    got = suffix_tree_scores(docs, fold("doc_id", 7) == 2, depth=depth).collect()
    train = [t for i, t in rows if not held(i)]
    model = Brute(train, depth, 4, 8.0)
    assert model.keep
    want = {}
    for i, text in rows:
        tokens = split(text)
        base = sum(math.log10((model.c[w] + 1) / (model.n + model.v + 1)) for w in tokens)
        want.setdefault((i, len(tokens)), []).append((held(i), sum(model.c[w] > 0 for w in tokens), base, model.score(text)))
    assert len(got) == len(rows)
    for r in got:
        options = want[(r.doc_id, r.n_tokens)]
        assert any(
            r.held_out == h and r.n_known == k and math.isclose(r.base_score, b, rel_tol=1e-9) and math.isclose(r.score, s, rel_tol=1e-9)
            for h, k, b, s in options
        ), (r, options)
        assert r.train_tokens == model.n


def test_predictions_of_every_state_sum_to_one():
    rng = np.random.default_rng(0)
    width = 7  # five words
    tree = Tree(width, 2)
    tree.counts[1] = np.array([0, 50, 40, 30, 20, 10, 10])
    pairs = np.sort(rng.choice([a * width + b for a in range(1, 7) for b in range(1, 6)], 12, replace=False))
    tree.grams[2], tree.counts[2] = pairs, np.full(12, 1)
    tree.grams[3], tree.counts[3] = np.zeros(0, np.int64), np.zeros(0, np.int64)
    build(tree, 150, 5)
    for d in tree.keep:
        tree.keep[d][:] = True
    for context in range(1, 7):
        seen = sum(10 ** token_scores(tree, np.array([context, w]))[1] for w in range(1, 6))
        # A word that is not among the known ones has the root's share on top.
        unseen = 10 ** token_scores(tree, np.array([context, 0]))[1] * (1 - sum(10 ** tree.log_root[1:6]))
        assert math.isclose(seen + unseen, 1, rel_tol=1e-9)


def test_no_training_rows_and_empty_table(make_docs):
    only = next(i for i in range(100) if held(i))
    (row,) = suffix_tree_scores(make_docs([(only, "a b")]), fold("doc_id", 7) == 2).collect()
    assert (row.n_tokens, row.n_known, row.train_tokens, row.base_score, row.score) == (3, 0, 0, 0.0, 0.0)
    assert suffix_tree_scores(make_docs([]), fold("doc_id", 7) == 2).collect() == []


def test_held_out_texts_gain_over_the_base(spark):
    rows = op1_suffix_tree(spark, "/root/testdata/sf0.01").where("held_out").collect()
    assert sum(r.score for r in rows) > sum(r.base_score for r in rows) * 0.97
    assert len(rows) > 80


def test_a_repeated_phrase_is_a_state_however_large_the_corpus(make_docs):
    learned, unseen = ([i for i in range(200) if held(i) is h] for h in (False, True))
    rows = [(i, "deep blue sea") for i in learned[:6]] + [(unseen[0], "deep blue sea")]
    # Eight million tokens: one millionth of them is more than six.
    rows += [(i, "x " * 400_000) for i in learned[6:26]]
    got = {r.doc_id: r for r in suffix_tree_scores(make_docs(rows), fold("doc_id", 7) == 2).collect()}
    row = got[unseen[0]]
    assert row.held_out and (row.n_tokens, row.n_known) == (4, 4)
    # In their states, 'blue' and 'sea' have 6 of 14 at least; by the root, one in a million.
    assert row.score - row.base_score > 2 * (math.log10(6 / 14) + 6)


@pytest.mark.parametrize("cached", [0, 40])
def test_what_tasks_have_at_hand_changes_nothing(make_docs, cached):
    docs = make_docs(corpus())

    def scores(**options):
        rows = suffix_tree_scores(docs, fold("doc_id", 7) == 2, **options).collect()
        return sorted((r.doc_id or -1, r.n_tokens, r.n_known, round(r.base_score, 6), round(r.score, 6)) for r in rows)

    assert scores(cached=cached) == scores()


def batches_of(texts, rows):
    return [pa.RecordBatch.from_arrays([pa.array(texts[i : i + rows], pa.string())], names=["_text"]) for i in range(0, len(texts), rows)]


ODD = ["", " ", "a", " A b\ta \x0b\x0c\r\n", "é É b\x1cc", "\x85x\xa0y  z", "a " * 50, "\x00 \x00"]


def test_words_of_a_batch_are_numbered_as_they_stand(monkeypatch):
    met = Vocabulary(lambda codes: codes + np.uint64(1))
    for texts in (ODD, ODD[::-1], ["new one"]):
        numbers, marks, (codes, more) = met.symbols(pa.array(["not read", *texts]).slice(1))
        want = [[MARK, *map(xxhash.xxh3_64_intdigest, [*words(t), END])] for t in texts]
        assert codes[numbers].tolist() == [c for own in want for c in own]
        assert marks.tolist() == np.cumsum([0, *map(len, want)])[:-1].tolist()
        assert (more == codes + np.uint64(1)).all() and len(set(codes.tolist())) == len(codes)
    monkeypatch.setattr("txnlens.llm.suffix_tree.HELD_WORDS", 3)
    numbers, _, (codes, _) = met.symbols(pa.array(["b a b"]))
    assert len(codes) == 4 and codes[numbers].tolist() == [MARK, *map(xxhash.xxh3_64_intdigest, [b"b", b"a", b"b", END])]


def test_words_are_not_kept_from_one_batch_to_the_next():
    """To find a word again among all that a task has met costs more than to hash it again."""
    met = Vocabulary(lambda codes: codes + np.uint64(1))
    met.symbols(pa.array([" ".join(map(str, range(5000)))]))
    numbers, marks, (codes, more) = met.symbols(pa.array(["b a b", "", "a"]))
    a, b, end = (xxhash.xxh3_64_intdigest(w) for w in (b"a", b"b", END))
    assert codes[numbers].tolist() == [MARK, b, a, b, end, MARK, end, MARK, a, end] and marks.tolist() == [0, 5, 7]
    assert len(codes) == len(more) == 4


@pytest.mark.parametrize("held", [2, 400_000])
def test_counts_of_words_are_passed_on_in_parts(monkeypatch, held):
    monkeypatch.setattr("txnlens.llm.suffix_tree.HELD_WORDS", held)
    total = Counter()
    for part in _count_words(iter(batches_of(ODD * 2, 3))):
        for code, n in zip(part.column(0).to_numpy().view(np.uint64).tolist(), part.column(1).to_pylist()):
            total[code] += n
    want = Counter(xxhash.xxh3_64_intdigest(w) for t in ODD * 2 for w in [*words(t), END])
    assert +total == want


def test_counting_keeps_little_beside_what_it_holds():
    """A task's arrays are let go one by one, and windows are made for one range at a time."""
    rng = np.random.default_rng(5)
    texts = [" ".join(map(str, rng.integers(0, 3000, 2000).tolist())) for _ in range(500)]
    given = batches_of(texts, 100)
    ranked = np.array([xxhash.xxh3_64_intdigest(str(i).encode()) for i in range(3000)], dtype=np.uint64)
    shared = SimpleNamespace(value=(np.full(1 << 24, 255, dtype=np.uint8), ranked))
    tracemalloc.start()
    try:
        found = list(_count_grams(shared, 4, 4)(iter(given)))
        most = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert sum(sum(p.column("size").to_pylist()) for p in found) > 900_000
    # A million tokens take 24 bytes each while they are held.
    assert most < 100 * 1_000_000


def test_only_the_entries_are_left_beside_the_scores(make_docs, spark, tmp_path, monkeypatch):
    """Tables that scoring does not read take disk while texts are shuffled; texts are not stored for it either."""
    from txnlens import session

    monkeypatch.setattr(session, "scratch_root", lambda spark: f"file://{tmp_path}")
    scores = suffix_tree_scores(make_docs(corpus()), fold("doc_id", 7) == 2, cached=0)
    assert scores.count() == len(corpus())
    assert [p.name.rsplit("-", 1)[0] for p in (tmp_path / "txnlens").iterdir()] == ["entries"]


def test_sequences_whose_suffix_is_no_entry_are_not_sent():
    from txnlens.llm.suffix_tree import BITS, _score

    nothing = np.empty(0)
    all_bits = np.full(BITS // 8, 255, dtype=np.uint8)
    word_bits = np.zeros(BITS // 8, dtype=np.uint8)
    codes = np.array([xxhash.xxh3_64_intdigest(b"a")], dtype=np.uint64) & np.uint64(BITS - 1)
    word_bits[codes >> np.uint64(3)] |= (1 << (codes & np.uint64(7))).astype(np.uint8)

    def sent(bits):
        rows = {"_row": [7], "doc_id": [1], "held_out": [True], "_text": ["b a a"]}
        shared = SimpleNamespace(value=(bits, np.empty(0, np.uint64), nothing, nothing, nothing))
        found = pa.Table.from_batches(_score(shared, 2, 4)(iter([pa.RecordBatch.from_pydict(rows)])))
        return sum(n for n in found.column("size").to_pylist() if n)

    # The mark, a, b, the end; the pairs that end in a, a, b, the end.
    assert sent(all_bits) == 4 + 4
    # Were every pair's bit set, those ending in a word without a bit could still be no entry.
    pairs = all_bits.copy()
    for word in (b"b", END):
        at = xxhash.xxh3_64_intdigest(word) & (BITS - 1)
        pairs[at >> 3] &= 255 ^ (1 << (at & 7))
    # The mark and a; the pairs b a and a a.
    assert sent(pairs) == 2 + 2
    assert sent(word_bits) == 1
