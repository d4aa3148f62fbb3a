"""SentencePiece models on the tokenizers library: encoding, decoding and a check against the original.

The model file is read as protobuf wire format: pieces with scores and kinds, the model type, byte
fallback and the normaliser's settings. From these a tokenizer is rebuilt: unigram models with
their scores, BPE models with the merges that their scores imply. White space becomes the marker
U+2581, with one in front of the text if the model wants that.

If no piece has a marker behind another character, no piece and no merge reaches across the places where
a marker follows another character, so a text can be cut there and each distinct unit encoded once
per batch, with several threads; such a model gives the same ids as on the whole text. Any other model
encodes whole texts. Decoding puts the bytes of the pieces together. Every text's ids are held against those of
the sentencepiece library, in the task that made them.

Edge cases: null and empty texts have no ids. Characters without a piece become bytes, or the unknown
piece in a model without byte fallback. Rows that repeat an id are encoded one by one. An empty table
gives an empty result; columns other than ``doc_id`` and ``text`` are ignored.
"""

from __future__ import annotations

import gc
import os
import re
import struct
from collections import defaultdict
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass
from functools import cached_property
from itertools import chain, count, islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from tokenizers import AddedToken, Regex, Tokenizer, models, normalizers

from txnlens.llm.common import table, tidy, whole_text
from txnlens.llm.shingles import chunks

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
THREADS = 2
MARK = "▁"
#: Units whose ids a worker remembers.
REMEMBERED = 200_000

# Kinds of pieces and of models, and the text of an unknown piece, as the format has them.
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
UNIGRAM, BPE = 1, 2
UNKNOWN_TEXT = " ⁇ "


def _varint(data: bytes, at: int) -> tuple[int, int]:
    value = shift = 0
    while True:
        byte = data[at]
        value |= (byte & 0x7F) << shift
        at += 1
        if byte < 0x80:
            return value, at
        shift += 7


def wire_fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """Field numbers and raw values of a protobuf message."""
    at = 0
    while at < len(data):
        key, at = _varint(data, at)
        kind = key & 7
        if kind == 0:
            value, at = _varint(data, at)
        elif kind in (1, 5):
            size = 8 if kind == 1 else 4
            value, at = data[at : at + size], at + size
        elif kind == 2:
            size, at = _varint(data, at)
            value, at = data[at : at + size], at + size
        else:
            raise ValueError(f"not a model: wire type {kind}")
        yield key >> 3, value


@dataclass
class PieceModel:
    """What a model file says."""

    pieces: list[tuple[str, float, int]]
    kind: int = UNIGRAM
    byte_fallback: bool = False
    charsmap: bytes = b""
    dummy_prefix: bool = True
    trim: bool = True
    escape: bool = True

    @classmethod
    def parse(cls, data: bytes) -> PieceModel:
        model = cls([])
        for number, value in wire_fields(data):
            if number == 1:
                own = dict(wire_fields(value))
                score = struct.unpack("<f", own[2])[0] if 2 in own else 0.0
                model.pieces.append((own.get(1, b"").decode(), score, own.get(3, NORMAL)))
            elif number == 2:
                own = dict(wire_fields(value))
                model.kind = own.get(3, UNIGRAM)
                model.byte_fallback = bool(own.get(35, 0))
            elif number == 3:
                own = dict(wire_fields(value))
                model.charsmap = own.get(2, b"")
                model.dummy_prefix, model.trim, model.escape = (bool(own.get(n, 1)) for n in (3, 4, 5))
        if model.kind not in (UNIGRAM, BPE):
            raise ValueError(f"model type {model.kind} is neither unigram nor BPE")
        return model

    @property
    def unknown(self) -> int:
        return next(i for i, (_, _, kind) in enumerate(self.pieces) if kind == UNKNOWN)

    @property
    def space(self) -> str:
        return MARK if self.escape else " "

    @cached_property
    def separable(self) -> bool:
        """Whether texts may be cut wherever a marker follows another character."""
        return not any(self.space in p.lstrip(self.space) for p, _, kind in self.pieces if kind in (NORMAL, USER_DEFINED))

    def merges(self) -> list[tuple[str, str]]:
        """Pairs of pieces that make a piece, in the order in which it would be made."""
        usable = {p: i for i, (p, _, kind) in enumerate(self.pieces) if kind in (NORMAL, USER_DEFINED)}
        found = []
        for piece, i in usable.items():
            for cut in range(1, len(piece)):
                left, right = piece[:cut], piece[cut:]
                if left in usable and right in usable:
                    found.append((-self.pieces[i][1], i, usable[left], usable[right], left, right))
        return [(left, right) for *_, left, right in sorted(found)]

    def tokenizer(self) -> Tokenizer:
        """A tokenizer for texts that are normalised and marked already."""
        if self.kind == BPE:
            vocabulary = {p: i for i, (p, _, _) in enumerate(self.pieces)}
            unknown = self.pieces[self.unknown][0]
            model = models.BPE(vocabulary, self.merges(), unk_token=unknown, fuse_unk=True, byte_fallback=self.byte_fallback)
        else:
            # Pieces that no text can match are put beyond reach: marked texts have no plain space, others no NUL.
            apart = " " if self.escape else "\0"
            hidden = (UNKNOWN, CONTROL, UNUSED)
            scores = [(f"{apart}{i}{apart}" if kind in hidden else p, s) for i, (p, s, kind) in enumerate(self.pieces)]
            model = models.Unigram(scores, self.unknown, self.byte_fallback)
        made = Tokenizer(model)
        own = [AddedToken(p, normalized=False) for p, _, kind in self.pieces if kind == USER_DEFINED]
        if own:
            made.add_tokens(own)
        return made

    def normaliser(self) -> normalizers.Normalizer | None:
        steps: list = [normalizers.Precompiled(self.charsmap)] if self.charsmap else []
        if self.trim:
            # Only U+0020 is trimmed.
            steps += [normalizers.Replace(Regex(r"\A +| +\z"), ""), normalizers.Replace(Regex(" {2,}"), " ")]
        return normalizers.Sequence(steps) if steps else None


class Codec:
    """Encodes and decodes batches of texts."""

    def __init__(self, data: bytes, threads: int = THREADS):
        os.environ.setdefault("RAYON_NUM_THREADS", str(threads))
        os.environ["TOKENIZERS_PARALLELISM"] = "true" if threads > 1 else "false"
        self.model = PieceModel.parse(data)
        self._data = data
        self._all_checked = False
        self._tokenizer = self.model.tokenizer()
        self._normaliser = self.model.normaliser()
        space = re.escape(self.model.space)
        self._units = re.compile(f"{space}*[^{space}]+|{space}+")
        self._forget()
        texts = [self._surface(p, kind) for p, _, kind in self.model.pieces]
        self._bytes = np.frombuffer(b"".join(texts), dtype=np.uint8)
        self._sizes = np.array([len(t) for t in texts], dtype=np.int64)
        self._starts = np.cumsum(self._sizes) - self._sizes

    def _forget(self) -> None:
        #: The number of each remembered unit; its ids are a slice of ``_ids`` that ends at the place after it in ``_ends``.
        self._remembered: defaultdict[str, int] = defaultdict(count().__next__)
        self._ids = np.zeros(0, dtype=np.int32)
        self._ends = np.zeros(1, dtype=np.int64)
        #: Numbers of checked units whose ids are not those of the original.
        self._differing: set[int] = set()

    def _surface(self, piece: str, kind: int) -> bytes:
        if kind == BYTE:
            return bytes([int(piece[3:-1], 16)])
        if kind == CONTROL:
            return b""
        if kind == UNKNOWN:
            return UNKNOWN_TEXT.encode()
        return piece.replace(self.model.space, " ").encode()

    def marked(self, text: str) -> str:
        if self._normaliser is not None:
            text = self._normaliser.normalize_str(text)
        if text and self.model.dummy_prefix:
            text = " " + text
        return text.replace(" ", MARK) if self.model.escape else text

    @property
    def plain(self) -> bool:
        """Whether the original gives the ids of a unit of a text if it is asked for the unit alone."""
        model = self.model
        return model.separable and model.dummy_prefix and model.escape and not model.trim and not model.charsmap

    @cached_property
    def original(self):
        from sentencepiece import SentencePieceProcessor

        return SentencePieceProcessor(model_proto=self._data)

    def parity(self, texts: list[str | None], ids: np.ndarray, counts: np.ndarray) -> list[bool]:
        """Whether each text's ids are those that the sentencepiece library gives for the whole text."""
        ends = np.cumsum(counts).tolist()
        own = [ids[e - n : e].tolist() for e, n in zip(ends, counts.tolist())]
        return [a == b for a, b in zip(own, self.original.encode([t or "" for t in texts]))]

    @cached_property
    def _lone(self) -> list[int]:
        return [self.original.piece_to_id(self.model.space)]

    def _check(self, units: list[str], found: list[list[int]]) -> list[int]:
        """The places of the units whose ids differ from those of the original."""
        # The original puts a marker in front, as every unit has one; the empty text gets none.
        asked = [u.removeprefix(MARK) for u in units]
        if any(MARK in u for u in asked):
            asked = [u.replace(MARK, " ") for u in asked]
        expected = self.original.encode(asked)
        if expected == found:
            return []
        return [i for i, (a, e, f) in enumerate(zip(asked, expected, found)) if f != (e if a else self._lone)]

    def _numbers(self, units: list[str], check: bool) -> np.ndarray:
        """The remembered number of each unit, after those that are new have been encoded."""
        if check and not self._all_checked:
            self._forget()
        self._all_checked = check
        before = len(self._remembered)
        numbers = np.fromiter(map(self._remembered.__getitem__, units), np.int64, len(units))
        if before and len(self._remembered) > REMEMBERED:
            self._forget()
            before = 0
            numbers = np.fromiter(map(self._remembered.__getitem__, units), np.int64, len(units))
        known = self._remembered
        if len(known) > before:
            fresh = list(islice(known, before, None))
            with _uncollected():
                encoded = [e.ids for e in self._tokenizer.encode_batch_fast(fresh, add_special_tokens=False)]
                if check:
                    self._differing.update(before + i for i in self._check(fresh, encoded))
            sizes = np.fromiter(map(len, encoded), np.int64, len(encoded))
            ids = np.fromiter(chain.from_iterable(encoded), np.int32, int(sizes.sum()))
            self._ids = np.concatenate([self._ids, ids])
            self._ends = np.concatenate([self._ends, self._ends[-1] + np.cumsum(sizes)])
        return numbers

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts in a row, and how many each text has."""
        return self._encoded(texts, False)[:2]

    def encode_checked(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, list[bool]]:
        """The same, and whether each text's ids are those of the sentencepiece library.

        A text that may be cut is compared unit by unit, each unit once while it is remembered; any other as a whole.
        """
        if not self.plain:
            ids, counts = self.encode(texts)
            return ids, counts, self.parity(texts, ids, counts)
        ids, counts, numbers, ends = self._encoded(texts, True)
        if not self._differing:
            return ids, counts, [True] * len(texts)
        wrong = np.concatenate([[0], np.cumsum(np.isin(numbers, list(self._differing)))])
        return ids, counts, (wrong[ends[1:]] == wrong[ends[:-1]]).tolist()

    def _encoded(self, texts: list[str | None], check: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Ids and how many each text has, the numbers of its units and the places between which they are."""
        marked = [self.marked(t or "") for t in texts]
        split = [self._units.findall(t) for t in marked] if self.model.separable else [[t] if t else [] for t in marked]
        ends = np.cumsum([0, *map(len, split)])
        numbers = self._numbers(list(chain.from_iterable(split)), check)
        lengths = np.diff(self._ends)[numbers]
        found = _gather(self._ids, self._ends[numbers], lengths)
        counts = np.diff(np.concatenate([[0], np.cumsum(lengths)])[ends])
        return found, counts, numbers, ends

    def decode(self, ids: np.ndarray, counts: np.ndarray) -> list[str]:
        """The texts of ids in a row, cut into ``counts``."""
        sizes = self._sizes[ids]
        data = _gather(self._bytes, self._starts[ids], sizes).tobytes()
        ends = np.concatenate([[0], np.cumsum(sizes)])[np.concatenate([[0], np.cumsum(counts)])].tolist()
        texts = [data[a:b].decode("utf-8", "replace") for a, b in zip(ends, ends[1:])]
        return [t.removeprefix(" ") for t in texts] if self.model.dummy_prefix else texts


@contextmanager
def _uncollected() -> Iterator[None]:
    """Without searches for cycles, which many small lists of numbers set off and never have."""
    enabled = gc.isenabled()
    gc.disable()
    try:
        yield
    finally:
        if enabled:
            gc.enable()


def _gather(flat: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The slices of ``flat`` that begin at ``starts``, one after the other."""
    ends = np.cumsum(lengths)
    place = np.arange(int(ends[-1]) if len(ends) else 0) + np.repeat(starts - (ends - lengths), lengths)
    return flat[place]


def read_model(path: str) -> bytes:
    with open(path, "rb") as file:
        return file.read()


ENCODED = "doc_id bigint, n_tokens bigint, ids array<int>, round_trip boolean, parity boolean"


def _encoder(shared, threads: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec(shared.value, threads)
        for batch in batches:
            texts = batch.column("_text").to_pylist()
            for start, end in chunks(texts):
                ids, counts, parity = codec.encode_checked(texts[start:end])
                again = codec.decode(ids, counts)
                ends = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").slice(start, end - start),
                        pa.array(counts),
                        pa.ListArray.from_arrays(pa.array(ends), pa.array(ids)),
                        pa.array([a == b for a, b in zip(again, texts[start:end])], pa.bool_()),
                        pa.array(parity, pa.bool_()),
                    ],
                    names=["doc_id", "n_tokens", "ids", "round_trip", "parity"],
                )

    return run


def model_file(spark: SparkSession) -> str:
    """The model's path: that of the session's setting ``spark.txnlens.pieceModel``, else ``MODEL``."""
    return spark.conf.get("spark.txnlens.pieceModel", MODEL)


def encode_pieces(docs: DataFrame, model: str | None = None, threads: int = THREADS) -> DataFrame:
    """Per row: ``doc_id, n_tokens, ids``, ``round_trip`` (whether decoding gives the text back) and ``parity``
    (whether the ids are those of the sentencepiece library)."""
    # The driver reads the model, a file of bounded size, and sends it to the tasks.
    shared = docs.sparkSession.sparkContext.broadcast(read_model(model or model_file(docs.sparkSession)))
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), whole_text().alias("_text"))
    return texts.mapInArrow(tidy(_encoder(shared, threads)), ENCODED)


def decode_pieces(encoded: DataFrame, model: str = MODEL) -> DataFrame:
    """Per row of ``doc_id, ids``: ``doc_id, text``; null ids give an empty text."""
    shared = encoded.sparkSession.sparkContext.broadcast(read_model(model))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec(shared.value)
        for batch in batches:
            lists = batch.column("ids")
            counts = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
            ids = lists.flatten().to_numpy(zero_copy_only=False)
            texts = pa.array(codec.decode(ids, counts), pa.string())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), texts], names=["doc_id", "text"])

    return encoded.select(F.col("doc_id").cast("bigint").alias("doc_id"), "ids").mapInArrow(tidy(run), "doc_id bigint, text string")


def differing(docs: DataFrame, model: str = MODEL) -> DataFrame:
    """Rows whose ids differ from those of the sentencepiece library: ``doc_id, ids, expected``."""
    shared = docs.sparkSession.sparkContext.broadcast(read_model(model))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from sentencepiece import SentencePieceProcessor

        codec, original = Codec(shared.value), SentencePieceProcessor(model_proto=shared.value)
        for batch in batches:
            doc_ids, texts = batch.column("doc_id").to_pylist(), batch.column("_text").to_pylist()
            ids, counts = codec.encode(texts)
            ends = np.cumsum(counts)
            own = [ids[e - n : e].tolist() for e, n in zip(ends.tolist(), counts.tolist())]
            rows = [r for r in zip(doc_ids, own, original.encode(texts)) if r[1] != r[2]]
            kinds = (pa.int64(), pa.list_(pa.int32()), pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[i] for r in rows], kind) for i, kind in enumerate(kinds)], names=["doc_id", "ids", "expected"]
            )

    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), whole_text().alias("_text"))
    return texts.mapInArrow(run, "doc_id bigint, ids array<int>, expected array<int>")


def op9_piece_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_pieces(table(spark, sf_dir, "documents"))


ENTRIES = {"op9_piece_codec": (op9_piece_codec, None)}
