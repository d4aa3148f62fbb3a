import gc
import random
import struct

import numpy as np
import pytest
import sentencepiece
from pyspark.sql import functions as F

from txnlens.llm.common import prepare
from txnlens.llm.pieces import (
    BYTE,
    CONTROL,
    MARK,
    MODEL,
    NORMAL,
    UNIGRAM,
    UNKNOWN,
    Codec,
    PieceModel,
    decode_pieces,
    differing,
    encode_pieces,
    read_model,
)

ODD = [
    None, "", " ", "   ", "a", " a", "a ", "  two  spaces   here ", "line\nbreak\t tab\r\n", "naïve café 漢字 🎉 \u0000 x", MARK, f"a{MARK}b {MARK}",
    "<s> </s> <unk> <0x41>", "é", "﻿bom", "x" * 5000, "the " * 20_000, "12345 67.89", " nbsp em",
]


@pytest.fixture(scope="module")
def codec():
    return Codec(read_model(MODEL))


@pytest.fixture(scope="module")
def original():
    return sentencepiece.SentencePieceProcessor(model_file=MODEL)


def lists(ids, counts):
    ends = np.cumsum(counts).tolist()
    return [ids[e - n : e].tolist() for e, n in zip(ends, counts.tolist())]


def test_the_model_file_is_read(original):
    model = PieceModel.parse(read_model(MODEL))
    assert len(model.pieces) == original.get_piece_size()
    assert [p for p, _, _ in model.pieces] == [original.id_to_piece(i) for i in range(len(model.pieces))]
    assert np.allclose([s for _, s, _ in model.pieces], [original.get_score(i) for i in range(len(model.pieces))])
    assert model.byte_fallback and model.separable


def test_ids_agree_with_the_original(codec, original):
    rng = random.Random(4)
    letters = "abcdeéßñ ,.  \n漢🎉XYZ019▁"
    texts = ODD + ["".join(rng.choice(letters) for _ in range(rng.randrange(80))) for _ in range(2000)]
    got = lists(*codec.encode(texts))
    assert got == [original.encode(t or "") for t in texts]


def test_decoding_agrees_with_the_original(codec, original):
    texts = [t for t in ODD if t and MARK not in t]
    ids, counts = codec.encode(texts)
    assert codec.decode(ids, counts) == texts
    assert codec.decode(ids, counts) == [original.decode(i) for i in lists(ids, counts)]
    assert codec.decode(np.zeros(0, np.int32), np.zeros(2, np.int64)) == ["", ""]


def test_memory_of_units_is_bounded(codec, monkeypatch):
    monkeypatch.setattr("txnlens.llm.pieces.REMEMBERED", 10)
    own = Codec(read_model(MODEL))
    for i in range(20):
        own.encode([f"w{i} v{i} u{i}"])
    assert len(own._remembered) <= 10


def field(number, value):
    if isinstance(value, float):
        return bytes([number << 3 | 5]) + struct.pack("<f", value)
    if isinstance(value, int):
        key = number << 3
        head = bytes([key]) if key < 128 else bytes([key & 127 | 128, key >> 7])
        return head + bytes([value])
    return bytes([number << 3 | 2, *([len(value)] if len(value) < 128 else [len(value) & 127 | 128, len(value) >> 7])]) + value


def unigram(pieces, byte_fallback, trim):
    data = b"".join(field(1, field(1, p.encode()) + field(2, float(s)) + field(3, k)) for p, s, k in pieces)
    data += field(2, field(3, UNIGRAM) + field(35, int(byte_fallback)))
    return data + field(3, field(3, 1) + field(4, int(trim)) + field(5, 1))


@pytest.mark.parametrize("fallback,trim", [(True, False), (False, True)])
def test_unigram_models_agree_with_the_original(fallback, trim):
    pieces = [("<unk>", 0.0, UNKNOWN), ("<s>", 0.0, CONTROL), ("</s>", 0.0, CONTROL)]
    if fallback:
        pieces += [(f"<0x{i:02X}>", 0.0, BYTE) for i in range(256)]
    words = [MARK, "a", "b", "c", "ab", "bc", "abc", MARK + "a", MARK + "ab", MARK + "c", "ca"]
    pieces += [(w, -1.5 - 0.37 * i, NORMAL) for i, w in enumerate(words)]
    data = unigram(pieces, fallback, trim)
    own, original = Codec(data), sentencepiece.SentencePieceProcessor(model_proto=data)
    rng = random.Random(2)
    texts = ["".join(rng.choice("aabbcc  ") for _ in range(rng.randrange(30))) for _ in range(500)]
    texts += ["abz", "zz a z"] if fallback else []
    texts += ["<s>a", "a</s>b", "<unk>", "\nab", "ab\n", " ab", "\tab c\t", " ab ", "a\n \nb"]
    ids, counts = own.encode(texts)
    assert lists(ids, counts) == [original.encode(t) for t in texts]
    assert all(own.parity(texts, ids, counts)) and all(own.encode_checked(texts)[2])


def test_parity_shows_ids_that_differ(codec):
    texts = ["all the words of it", " ", "a  b ", "", None, "only these"]
    own = Codec(read_model(MODEL))
    assert own.plain and own.encode_checked(texts)[2] == [True] * 6
    wrong = Codec(read_model(MODEL))
    check = wrong._check
    wrong._check = lambda units, found: check(units, [[i + 1 for i in f] if "words" in u else f for u, f in zip(units, found)])
    assert wrong.encode_checked(texts)[2] == [False, True, True, True, True, True]
    # The unit is remembered, and so is that it differs.
    assert wrong.encode_checked(["no words", "none"])[2] == [False, True]


def test_units_agree_as_whole_texts_do(codec, original):
    rng = random.Random(11)
    texts = ODD + ["".join(rng.choice("ab é \n漢 ▁") for _ in range(rng.randrange(40))) for _ in range(500)]
    ids, counts, parity = codec.encode_checked(texts)
    assert [a.tolist() for a in (ids, counts)] == [a.tolist() for a in codec.encode(texts)]
    assert parity == codec.parity(texts, ids, counts) == [a == original.encode(t or "") for a, t in zip(lists(ids, counts), texts)]


def test_the_model_is_taken_from_a_setting(spark, make_docs):
    spark.conf.set("spark.txnlens.pieceModel", "/nowhere/model")
    try:
        with pytest.raises(FileNotFoundError):
            encode_pieces(make_docs([(1, "a")]))
    finally:
        spark.conf.unset("spark.txnlens.pieceModel")


def test_rows_are_encoded_and_decoded(spark, make_docs):
    prepare(spark)
    rows = [(i, t) for i, t in enumerate(ODD)] + [(None, "no id"), (3, "again"), (3, "again")]
    docs = make_docs(rows).withColumn("ids", F.lit("clash"))
    encoded = encode_pieces(docs).cache()
    got = encoded.collect()
    assert len(got) == len(rows) and all(r.n_tokens == len(r.ids) for r in got)
    assert all(r.round_trip for r in got if r.doc_id not in (10, 11))
    assert all(r.parity for r in got)
    back = sorted(((r.doc_id, r.text) for r in decode_pieces(encoded).collect()), key=repr)
    want = sorted(((i, (t or "").replace(MARK, " ")) for i, t in rows), key=repr)
    assert back == want
    assert differing(docs).collect() == []
    assert encode_pieces(make_docs([])).collect() == []


def test_whole_table_agrees_with_the_original(spark):
    prepare(spark)
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    assert differing(docs).count() == 0
    assert encode_pieces(docs).where("NOT round_trip OR NOT parity").count() == 0


def test_a_unit_is_numbered_once_and_stays_marked_when_others_are_forgotten(monkeypatch):
    monkeypatch.setattr("txnlens.llm.pieces.REMEMBERED", 4)
    own = Codec(read_model(MODEL))
    check = own._check
    asked = []
    own._check = lambda units, found: asked.append(units) or check(units, [[0] if "bad" in u else f for u, f in zip(units, found)])
    assert own.encode_checked(["a bad a", "a", "bad"])[2] == [False, True, False]
    assert own.encode_checked(["a b", "bad b", None])[2] == [True, False, True]
    # Nothing is asked twice while it is remembered.
    assert asked == [["▁a", "▁bad"], ["▁b"]]
    # More units than are remembered: all numbers begin anew, and so does the check.
    assert own.encode_checked(["c d e", "bad", "", "a"])[2] == [True, False, True, True]
    assert len(asked) == 3 and sorted(asked[2]) == ["▁a", "▁bad", "▁c", "▁d", "▁e"]
    ids, counts = own.encode(["c d e", "bad", "", "a"])
    assert lists(ids, counts) == [own.original.encode(t) for t in ["c d e", "bad", "", "a"]]


def test_many_new_units_set_off_no_searches_for_cycles():
    own = Codec(read_model(MODEL))
    own.encode_checked(["warm up"])
    began = []
    count = lambda phase, info: began.append(phase) if phase == "start" else None
    gc.callbacks.append(count)
    try:
        assert own.encode_checked([" ".join(f"w{i}" for i in range(60_000))])[2] == [True]
    finally:
        gc.callbacks.remove(count)
    assert gc.isenabled() and len(began) < 5
