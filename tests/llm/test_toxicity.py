import pytest
from pyspark.sql import functions as F

from txnlens.llm.common import fold
from txnlens.llm.toxicity import (
    NAMES,
    drop_toxic,
    features,
    op3_boosted_toxicity,
    plain,
    sample_labels,
    toxicity_scores,
    weigh,
)

LEXICON = {"scum": 4.0, "lowei*": 3.0}
SF = "/root/testdata/sf0.1"


def named(text):
    return dict(zip(NAMES, features([text], LEXICON)[0]))


def test_features_of_one_text():
    got = named("You are SCUM, really!! loweiheit x x x x x x x x scum")
    n = 14
    assert got["hits"] == pytest.approx(3 / n)
    assert got["strong_hits"] == pytest.approx(2 / n)
    assert got["weight"] == pytest.approx(11 / n)
    assert got["most"] == 4.0
    assert got["near_second"] == pytest.approx(2 / n)
    assert got["second_person"] == pytest.approx(1 / n)
    assert got["shouted"] == pytest.approx(1 / n)
    assert got["marks"] == pytest.approx(2 / n)


def test_obfuscated_words_are_found():
    assert plain("$cum!") == "scum"
    assert plain("s.c.u.m") == "scum"
    assert plain("scum") is None
    assert plain("2024") is None or named("2024")["obfuscated_hits"] == 0
    assert named("such s-c-u-m here")["obfuscated_hits"] == pytest.approx(1 / 3)
    assert named("nooo")["repeated"] == 1


def test_empty_texts_have_no_features():
    assert features([None, "", " \n"], LEXICON).tolist() == [[0.0] * len(NAMES)] * 3
    assert features([], LEXICON).shape == (0, len(NAMES))
    assert features(["scum " * 200_000], LEXICON)[0][0] == 1.0


def test_weights_are_cautious():
    assert weigh(3, 0, 20, 200) < weigh(30, 0, 20, 200)
    assert weigh(10, 100, 100, 1000) < 0.1


def test_sample_follows_its_bound_and_conflicts_count_as_toxic(spark):
    labels = spark.createDataFrame([(i, i % 2) for i in range(4000)] + [(2, 1), (None, 1), (3, None)], "doc_id long, toxic int")
    all_rows = sample_labels(labels, F.lit(True)).collect()
    assert len(all_rows) == 4000 and next(r.toxic for r in all_rows if r.doc_id == 2) == 1
    few = sample_labels(labels, F.lit(True), 500).collect()
    assert 400 < len(few) < 600 and {r.part for r in few} == {0, 1, 2}


def test_labels_of_one_kind_give_their_share(spark, make_docs):
    docs = make_docs([(1, "a b"), (2, None), (None, "x"), (1, "a b")])
    labels = spark.createDataFrame([(1, 0), (2, 0)], "doc_id long, toxic int")
    assert [r.score for r in toxicity_scores(docs, labels, F.lit(True)).collect()] == [0.0] * 4
    assert toxicity_scores(make_docs([]), labels.limit(0), F.lit(True)).collect() == []


def test_held_out_accuracy(spark):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    found = op3_boosted_toxicity(spark, SF)
    rows = found.join(labels, "doc_id").where("held_out").select("score", "predicted", "toxic").collect()
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in rows)
    bad, good = [r.score for r in rows if r.toxic], [r.score for r in rows if not r.toxic]
    wins = sum((b > g) + 0.5 * (b == g) for b in bad for g in good)
    assert wins / (len(bad) * len(good)) > 0.97
    assert sum(r.predicted for r in rows if r.toxic) > 0.8 * len(bad)
    assert sum(r.predicted for r in rows if not r.toxic) < 0.02 * len(good)


def test_rejected_documents_go_and_columns_stay(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").withColumn("score", F.lit("clash"))
    docs = docs.unionByName(docs.limit(1).withColumn("doc_id", F.lit(None).cast("long")).withColumn("text", F.lit(None).cast("string")))
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    left = drop_toxic(docs, labels)
    assert left.columns == docs.columns
    scores = toxicity_scores(docs, labels, fold("doc_id", 3) != 1)
    clean = {r.doc_id for r in scores.where("score < 0.7").collect()}
    assert {r.doc_id for r in left.collect()} == clean and None in clean


def by_hand(text, lexicon):
    """The features of a text, one token after the other."""
    import math

    from txnlens.llm.toxicity import SECOND_PERSON, STRONG, WINDOW, core

    tokens = text.split()
    n = len(tokens)
    if not n:
        return [0.0] * len(NAMES)

    def look(word):
        if not word:
            return 0.0
        return max([lexicon.get(word, 0.0)] + [lexicon.get(word[:k] + "*", 0.0) for k in range(4, 9) if k <= len(word)])

    weights, hidden, bare = [], [], []
    for t in tokens:
        seen = plain(t)
        behind = look(seen) if seen is not None and seen != core(t) else 0.0
        weights.append(max(look(core(t)), behind))
        hidden.append(behind > 0)
        bare.append(seen is not None)
    persons = [i for i, t in enumerate(tokens) if core(t) in SECOND_PERSON]
    near = sum(any(abs(i - p) <= WINDOW for p in persons) for i, w in enumerate(weights) if w)
    letters = [sum(c.isalpha() for c in t) for t in tokens]
    capitals = [sum(c.isupper() for c in t) for t in tokens]
    return [
        sum(w > 0 for w in weights) / n,
        sum(w >= STRONG for w in weights) / n,
        sum(weights) / n,
        max(weights),
        near / n,
        len(persons) / n,
        sum(capitals) / max(sum(letters), 1),
        sum(a > 2 and a == c for a, c in zip(letters, capitals)) / n,
        sum(not c.isalnum() for t in tokens for c in t) / n,
        sum(t.count("!") + t.count("?") for t in tokens) / n,
        sum(bare) / n,
        sum(hidden) / n,
        sum(any(t[i] == t[i + 1] == t[i + 2] for i in range(len(t) - 2)) for t in tokens) / n,
        math.log1p(n),
    ]


def test_features_against_brute_force():
    import random

    rng = random.Random(7)
    words = "You scum $cum! s.c.u.m loweiheit lowei SHOUT nooo dich (tu) 2024 a été !? ... idiot".split()
    texts = [" ".join(rng.choice(words) for _ in range(rng.randrange(40))) for _ in range(300)] + ["", " \n\t"]
    got = features(texts, LEXICON)
    for row, text in zip(got.tolist(), texts):
        assert row == pytest.approx(by_hand(text, LEXICON))


def test_lexicons_against_brute_force(spark):
    import random

    from txnlens.llm.toxicity import MIN_TOXIC, MIN_WEIGHT, core, entries, lexicons

    rng = random.Random(3)
    rows = []
    for i in range(300):
        toxic = int(i % 4 == 0)
        text = " ".join(rng.choice("river house green people Walk, talk".split()) for _ in range(12))
        rows.append((i % 3, toxic, text + (" scumbag Loweiheit!" if toxic and i % 8 else "")))
    sample = spark.createDataFrame(rows, "part int, toxic int, _text string").repartition(5)
    found = lexicons(sample)
    for target, sources in ((0, {1}), (1, {0}), (2, {0, 1})):
        own = [(toxic, {e for w in {core(t) for t in text.split()} for e in entries(w)}) for part, toxic, text in rows if part in sources]
        totals = [sum(t == toxic for t, _ in own) for toxic in (0, 1)]
        want = {}
        for e in {e for _, held in own for e in held}:
            bad = sum(t == 1 and e in held for t, held in own)
            clean = sum(t == 0 and e in held for t, held in own)
            weight = weigh(bad, clean, totals[1], totals[0])
            if bad >= MIN_TOXIC and weight >= MIN_WEIGHT:
                want[e] = pytest.approx(weight)
        assert found[target] == want and "scumbag" in want


def test_a_steep_curve_leaves_the_order_of_scores_as_it_was(spark, make_docs):
    """Scores are the isotonic fit of the calibration part: they rise with the chance and are shares of its steps."""
    docs = make_docs([(i, "you are scum scum" if i % 2 else "green river house") for i in range(400)])
    labels = spark.createDataFrame([(i, int(i % 2)) for i in range(400)], "doc_id long, toxic int")
    found = {r.doc_id: r.score for r in toxicity_scores(docs, labels, F.lit(True)).collect()}
    assert {found[i] for i in range(1, 400, 2)} == {max(found.values())} and max(found.values()) > 0.95
    assert {found[i] for i in range(0, 400, 2)} == {min(found.values())} and min(found.values()) < 0.05


def test_words_of_letters_are_read_without_patterns(monkeypatch):
    """Most tokens are plain words, with nothing to strip and nothing in place of letters."""
    from txnlens.llm import toxicity

    asked = []
    for name in ("core", "plain"):
        real = getattr(toxicity, name)
        monkeypatch.setattr(toxicity, name, lambda token, real=real: asked.append(token) or real(token))
    texts = ["You are SCUM really loweiheit nooo Dich été", "scum, x"]
    got = toxicity.features(texts, LEXICON)
    assert set(asked) == {"scum,"}
    for row, text in zip(got.tolist(), texts):
        assert row == pytest.approx(by_hand(text, LEXICON))


def test_odd_letters_count_as_they_are():
    """Capitals without small letters, small letters that grow when made small, title letters, signs and numbers."""
    from txnlens.llm.toxicity import _RUN, token_table

    tokens = "İstanbul İİİ ǅ ǅaa \U0001d400bc Ⅷ Ⅷa ªº ß ẞ x² ٣ а́б ——a —scum— ___ _a_ aaA aAa aaaa !!! $cum loweiß".split()
    for token, row in zip(tokens, token_table(tokens, LEXICON).tolist()):
        letters, capitals = sum(c.isalpha() for c in token), sum(c.isupper() for c in token)
        assert row[2:6] == [letters, capitals, sum(not c.isalnum() for c in token), token.count("!")], token
        assert row[8:] == [_RUN.search(token) is not None, letters > 2 and letters == capitals], token
        if len(token) > 2:
            assert features([token], LEXICON)[0].tolist() == pytest.approx(by_hand(token, LEXICON)), token
