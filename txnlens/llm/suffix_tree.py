"""Language-model scores from a probabilistic suffix tree.

A text is a sequence of words and one end symbol. The tree holds contexts of one to ``DEPTH`` symbols
(a mark before the first word may be part of a context). A context and a next symbol are candidates
if they were seen ``MIN_COUNT`` times in the training texts, whatever their size. The tree is a set of
Spark tables that grow with the corpus, keyed by 64-bit hashes of the sequences; the root holds the
count of every training word.

A candidate context stays if the divergence of its next symbols from its suffix's prediction, in
nats over all its occurrences, exceeds half the logarithm of the training size for each number it
stores; the suffixes of a context that stays do so too. Next symbols are smoothed towards the
suffix with ``STRENGTH`` virtual counts, and those below the count share what is left in
proportion to the suffix's prediction, so that every state's predictions sum to one. A token is scored
in the longest suffix of its history that is a state. The root is the add-one unigram model.

Since suffixes of states are states, a text's score is a sum over its sequences of one to
``DEPTH + 1`` symbols: a state adds the logarithm of its rest, and a listed next symbol the
logarithm of its gain over the suffix less that of the rest. So scores take one join by hash.

Counting is level by level: a sequence can only be frequent if its parts are. Tasks count what they
hold before the shuffle, so frequent words, pairs and passages cost little, and send it as arrays: one row
holds the counted sequences of one range of codes, written as their words' places in a list of the
``CACHED`` most frequent words (other words as codes). Scoring sends the sequences of a batch of
texts likewise to the range of codes that has their numbers. There are so many ranges that each has about
``RANGE`` sequences, whatever the size of the corpus. What goes to the driver and to every task has a
fixed size and changes no result: that word list, a bit table that leaves out sequences that no join would
find, and the numbers of the ``CACHED`` most frequent sequences.

Edge cases: a null text is empty, that is one end symbol. A null ``doc_id`` falls into fold crc32('').
Rows that repeat an id are scored one by one. Without training rows all counts are zero and scores
are zero. An empty table gives an empty result; columns other than ``doc_id`` and ``text`` are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from txnlens.llm.common import fold, let_go, table, tidy, whole_text, written
from txnlens.llm.shingles import chunks, mix
from txnlens.session import remove, scratch_path

DEPTH = 3
MIN_COUNT = 4
STRENGTH = 8.0
FOLDS, HELD_OUT = 7, 2

#: The end symbol among the words: no word is empty.
END = b""
#: The code of the mark before a text; other codes are hashes.
MARK = 1
#: Bits of the table of codes, 16 MB, and the part of them that is one row.
BITS, SLICE = 1 << 27, 1 << 15
#: Sequences whose numbers every task has at hand.
CACHED = 1 << 20
#: Distinct words, tokens or sequences to look up that a task holds before it passes their counts on.
HELD_WORDS, HELD_TOKENS, HELD_REFS = 400_000, 3_000_000, 2_000_000
#: Sequences of a range of codes, about.
RANGE = 1 << 20


def find(table: np.ndarray, codes: np.ndarray) -> np.ndarray:
    """Places of ``codes`` in a sorted table, -1 where they are not in it."""
    if not len(table):
        return np.full(len(codes), -1, dtype=np.int64)
    at = np.minimum(np.searchsorted(table, codes), len(table) - 1)
    return np.where(table[at] == codes, at, -1)


@dataclass
class Tree:
    """The same model in arrays, for small word lists: arrays per length; sequences of length d are numbered by their place in ``grams[d]``.

    Sequences of length 1 are word ids 1..W; 0 is any other word and W + 1 the mark before a text. A
    longer sequence has the code ``number of its start * (W + 2) + last id``.
    """

    width: int
    depth: int
    grams: dict[int, np.ndarray] = field(default_factory=dict)
    counts: dict[int, np.ndarray] = field(default_factory=dict)
    keep: dict[int, np.ndarray] = field(default_factory=dict)
    log_next: dict[int, np.ndarray] = field(default_factory=dict)
    log_rest: dict[int, np.ndarray] = field(default_factory=dict)
    log_root: np.ndarray | None = None

    def ending(self, ids: np.ndarray, longest: int) -> list[np.ndarray]:
        """For d = 1..longest the number of the sequence of length d that ends at each place, or -1."""
        numbers = [np.where(ids > 0, ids, -1).astype(np.int64)]
        for d in range(2, longest + 1):
            before = np.concatenate([[-1], numbers[-1][:-1]])
            codes = np.where((before >= 0) & (ids > 0), before * self.width + ids, -1)
            numbers.append(find(self.grams[d], codes))
        return numbers


class Vocabulary:
    """The words of some texts, by number, with their 64-bit hashes and what ``functions`` give for these.

    So each word is hashed and looked up once for these texts, not at every place where it stands. Words are not kept
    from one call to the next: to find one among many costs more than to hash it again.
    """

    def __init__(self, *functions: Callable[[np.ndarray], np.ndarray]):
        self._functions = functions

    def symbols(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
        """The numbers of the mark, the words and the end symbol of each text, the places of the marks, and
        by number the codes and what the functions gave for them."""
        found, sizes = split_words(texts)
        found = found.dictionary_encode()
        distinct = found.dictionary.to_numpy(zero_copy_only=False)
        # Numbers 0 and 1 are the mark and the end symbol.
        codes = np.empty(len(distinct) + 2, dtype=np.uint64)
        codes[0], codes[1] = MARK, xxhash.xxh3_64_intdigest(END)
        codes[2:] = np.frombuffer(b"".join(map(xxhash.xxh3_64_digest, distinct)), dtype=">u8")
        marks = np.cumsum(sizes + 2) - (sizes + 2)
        numbers = np.empty(int((sizes + 2).sum()), dtype=np.int32)
        word = np.ones(len(numbers), dtype=bool)
        word[marks] = word[marks + sizes + 1] = False
        numbers[marks], numbers[marks + sizes + 1] = 0, 1
        numbers[word] = found.indices.to_numpy() + 2
        return numbers, marks, [codes, *(f(codes) for f in self._functions)]


def split_words(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The words of ``shingles.words`` of all texts in a row, and how many each text has."""
    lists = pc.ascii_split_whitespace(pc.ascii_lower(texts.cast(pa.string())))
    sizes = lists.value_lengths().to_numpy().astype(np.int64)
    found = lists.flatten().cast(pa.binary())
    # White space at either end of a text leaves an empty part.
    filled = pc.not_equal(pc.binary_length(found), 0)
    owner = np.repeat(np.arange(len(texts)), sizes)[filled.to_numpy(zero_copy_only=False)]
    return found.filter(filled), np.bincount(owner, minlength=len(texts))


def signed(codes: np.ndarray) -> pa.Array:
    return pa.array(codes.view(np.int64))


def combined(start: np.ndarray, suffix: np.ndarray) -> np.ndarray:
    """Codes of sequences from those of their parts without the last and without the first symbol."""
    return mix(mix(start) * np.uint64(0x9E3779B97F4A7C15) + suffix)


def endings(flat: np.ndarray, marks: np.ndarray, longest: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For d = 1..longest the codes of the sequences of length d, and the places where they end."""
    place = np.arange(len(flat))
    offset = place - np.repeat(marks, np.diff(np.append(marks, len(flat))))
    codes = flat
    for d in range(1, longest + 1):
        if d > 1:
            codes = combined(codes[:-1], codes[1:])
        good = offset[d - 1 :] >= d - 1
        yield codes[good], place[d - 1 :][good]


def has(bits: np.ndarray, codes: np.ndarray) -> np.ndarray:
    """Whether the bit of each code is set."""
    at = codes & np.uint64(BITS - 1)
    return (bits[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 == 1


def merged(held: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct codes with their sums."""
    codes, totals = (np.concatenate(x) for x in zip(*held))
    order = np.argsort(codes)
    codes = codes[order]
    firsts = np.flatnonzero(changes(codes))
    return codes[firsts], np.add.reduceat(totals[order], firsts)


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    vocabulary = Vocabulary()
    held: list[tuple[np.ndarray, np.ndarray]] = []
    size = 0

    def out() -> pa.RecordBatch:
        codes, totals = held.pop()
        return pa.RecordBatch.from_arrays([signed(codes), pa.array(totals)], names=["code", "n"])

    for batch in batches:
        texts = batch.column(0)
        for a, b in chunks(texts.to_pylist()):
            numbers, _, (code_of,) = vocabulary.symbols(texts.slice(a, b - a))
            # The mark is no token.
            held.append((code_of[1:], np.bincount(numbers, minlength=len(code_of))[1:]))
            size += len(code_of) - 1
            if size >= 2 * HELD_WORDS:
                held = [merged(held)]
                size = len(held[0][0])
                if size >= HELD_WORDS:
                    yield out()
                    size = 0
    if held:
        held = [merged(held)]
        yield out()


def range_bits(size: int) -> int:
    """Leading bits of a code that make up its range, for ``size`` sequences in all."""
    return max(4, math.ceil(math.log2(max(size, 1) / RANGE)))


def ranges(codes: np.ndarray, bits: int) -> np.ndarray:
    """The range of each code."""
    return (codes >> np.uint64(64 - bits)).astype(np.int32)


def spans(sorted_values: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """Each value with the places where its run begins and ends."""
    values, first = np.unique(sorted_values, return_index=True)
    yield from zip(values.tolist(), first.tolist(), np.append(first[1:], len(sorted_values)).tolist())


def changes(sorted_values: np.ndarray) -> np.ndarray:
    """Whether each value differs from the one before."""
    new = np.ones(len(sorted_values), dtype=bool)
    new[1:] = sorted_values[1:] != sorted_values[:-1]
    return new


def planes(numbers: np.ndarray) -> bytes:
    """All first bytes, then all second bytes, and so on: leading zeros compress to nothing."""
    return np.ascontiguousarray(numbers).view(np.uint8).reshape(len(numbers), -1).T.tobytes()


def numbers(data: bytes, kind: type) -> np.ndarray:
    """The numbers of ``planes``."""
    width = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(data, dtype=np.uint8).reshape(width, -1).T).view(kind).reshape(-1)


def _pack_grams(places: np.ndarray, codes: np.ndarray, times: np.ndarray) -> bytes:
    """Counted sequences; ``places`` has a row for each, ``CACHED`` where the word itself follows as a code."""
    order = np.argsort(places[:, 0], kind="stable")
    places = places[order]
    parts = [*(planes(places[:, j]) for j in range(places.shape[1])), planes(times[order].astype(np.uint32))]
    parts.append(codes[order][places == CACHED].tobytes())
    return zstandard.ZstdCompressor(1).compress(b"".join(parts))


def _unpack_grams(data: bytes, size: int, length: int, ranked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The codes of the words, a column for each sequence, and the counts."""
    data = zstandard.ZstdDecompressor().decompress(data)
    step = 4 * size
    places = np.stack([numbers(data[j * step : (j + 1) * step], np.uint32) for j in range(length)], axis=1)
    codes = ranked[np.minimum(places, len(ranked) - 1)]
    codes[places == CACHED] = np.frombuffer(data[(length + 1) * step :], dtype=np.uint64)
    return codes.T, numbers(data[length * step : (length + 1) * step], np.uint32)


def _count_grams(shared, length: int, bits_of_range: int):
    """Counts of the sequences of ``length`` whose parts may be frequent, by range of their codes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits, ranked = shared.value
        order = np.argsort(ranked)
        ordered = ranked[order]

        def place_of(codes: np.ndarray) -> np.ndarray:
            at = find(ordered, codes)
            return np.where(at >= 0, order[at], CACHED).astype(np.uint32)

        vocabulary = Vocabulary(place_of)
        held: list[tuple[np.ndarray, ...]] = []
        size = 0

        def out() -> pa.RecordBatch:
            # Each array is let go as soon as it has been used.
            parts = [list(x) for x in zip(*held)]
            held.clear()
            codes = np.concatenate(parts.pop())
            # Of equal codes any will do.
            order = np.argsort(codes)
            codes = codes[order]
            first = np.flatnonzero(changes(codes))
            times = np.diff(np.append(first, len(codes))).astype(np.uint32)
            codes = codes[first]
            ends = np.concatenate(parts.pop())[order[first]]
            del order, first
            places = np.concatenate(parts.pop())
            flat = np.concatenate(parts.pop())
            rows = []
            for at, i, j in spans(ranges(codes, bits_of_range)):
                window = ends[i:j, None] + np.arange(1 - length, 1)
                rows.append((at, j - i, _pack_grams(places[window], flat[window], times[i:j])))
            columns = (pa.array(x, t) for x, t in zip(zip(*rows), (pa.int32(), pa.int32(), pa.binary())))
            return pa.RecordBatch.from_arrays(list(columns), names=["range", "size", "data"])

        for batch in batches:
            texts = batch.column(0)
            for a, b in chunks(texts.to_pylist()):
                words_at, marks, (code_of, place_of_word) = vocabulary.symbols(texts.slice(a, b - a))
                flat = code_of[words_at]
                *_, (codes, place) = endings(flat, marks, length - 1)
                likely = has(bits, codes)
                good = np.flatnonzero(likely[:-1] & likely[1:] & (place[1:] == place[:-1] + 1))
                # Runs of places end where the next text's begin, but for parts of one symbol.
                good = good[flat[place[good + 1]] != MARK]
                if not len(good):
                    continue
                ends = (place[good + 1] + size).astype(np.int32)
                held.append((flat, place_of_word[words_at], ends, combined(codes[good], codes[good + 1])))
                size += len(flat)
                if size >= HELD_TOKENS:
                    yield out()
                    size = 0
        if held:
            yield out()

    return run


def _frequent(shared, length: int, min_count: int):
    """The sequences of a range that are frequent."""

    def run(packed: pa.Table) -> pa.Table:
        ranked = shared.value[1]
        found = []
        for data, size in zip(packed.column("data"), packed.column("size").to_pylist()):
            codes, times = _unpack_grams(data.as_py(), size, length, ranked)
            while len(codes) > 2:
                codes = combined(codes[:-1], codes[1:])
            found.append((combined(codes[0], codes[1]), codes[0], codes[1], times))
        code, start, suffix, times = (np.concatenate(x) for x in zip(*found))
        code, first, where = np.unique(code, return_index=True, return_inverse=True)
        n = np.bincount(where, times).astype(np.int64)
        often = n >= min_count
        first = first[often]
        columns = [signed(code[often]), signed(start[first]), signed(suffix[first]), pa.array(n[often])]
        return pa.Table.from_arrays(columns, names=["code", "start", "suffix", "n"])

    return run


def _score(shared, longest: int, bits_of_range: int):
    """A row for each text with its sums over the cached sequences, dealt to any range, and rows that hold the other
    sequences of some texts by range of their codes: codes as differences, texts as distances to ``_row``, and times."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits, cached, known_of, base_of, delta_of = shared.value
        vocabulary = Vocabulary(lambda codes: has(bits, codes), lambda codes: find(cached, codes))
        held: list[tuple[np.ndarray, np.ndarray]] = []
        size = 0

        def out() -> pa.RecordBatch:
            rows, codes = (np.concatenate(x) for x in zip(*held))
            held.clear()
            # Equal codes have one length, and texts were added in order for each length.
            order = np.argsort(codes, kind="stable")
            rows, codes = rows[order], codes[order]
            firsts = np.flatnonzero(changes(rows) | changes(codes))
            times = np.diff(np.append(firsts, len(rows))).astype(np.uint32)
            rows, codes = rows[firsts], codes[firsts]
            least = rows.min()
            packed = []
            for at, i, j in spans(ranges(codes, bits_of_range)):
                steps = np.diff(codes[i:j], prepend=np.uint64(0))
                data = planes(steps) + planes((rows[i:j] - least).astype(np.uint64)) + planes(times[i:j])
                packed.append((at, j - i, zstandard.ZstdCompressor(1).compress(data)))
            at, sizes, data = zip(*packed)
            return batch_of(_row=pa.array([least] * len(at)), range=pa.array(at, pa.int32()), size=pa.array(sizes, pa.int32()), data=pa.array(data, pa.binary()))

        def batch_of(**columns: pa.Array) -> pa.RecordBatch:
            count = len(columns["_row"])
            return pa.RecordBatch.from_arrays([columns.get(f.name, pa.nulls(count, f.type)) for f in SCORED], schema=SCORED)

        for batch in batches:
            texts = batch.column("_text")
            for a, b in chunks(texts.to_pylist()):
                words_at, marks, (code_of, likely_word, place_of_word) = vocabulary.symbols(texts.slice(a, b - a))
                flat = code_of[words_at]
                part = batch.slice(a, b - a)
                lengths = np.diff(np.append(marks, len(flat)))
                owner = np.repeat(np.arange(b - a), lengths)
                rows = part.column("_row").to_numpy()
                sums = [np.zeros(b - a) for _ in range(3)]
                for d, (codes, place) in enumerate(endings(flat, marks, longest), 1):
                    if d == 1:
                        likely = likely_word[words_at]
                        codes, place = codes[likely], place[likely]
                        at = place_of_word[words_at[likely]]
                    else:
                        # The suffix of an entry is an entry, so only what ends where one was likely is looked at.
                        open_ = suffix_likely[place]
                        codes, place = codes[open_], place[open_]
                        likely = has(bits, codes)
                        codes, place = codes[likely], place[likely]
                        # In order, as neighbours are found in memory that is at hand.
                        order = np.argsort(codes)
                        at = np.empty(len(codes), dtype=np.int64)
                        at[order] = find(cached, codes[order])
                    suffix_likely = np.zeros(len(flat), dtype=bool)
                    suffix_likely[place] = True
                    own = owner[place]
                    here = at >= 0
                    for total, per_code in zip(sums, (known_of, base_of, delta_of)):
                        total += np.bincount(own[here], per_code[at[here]], b - a)
                    if not here.all():
                        held.append((rows[own[~here]], codes[~here]))
                        size += len(held[-1][0])
                named = {n: part.column(n) for n in ("_row", "doc_id", "held_out")}
                named["range"] = pa.array(ranges(mix(rows.view(np.uint64)), bits_of_range))
                totals = {"_known": pa.array(sums[0].astype(np.int64)), "_base": pa.array(sums[1]), "_delta": pa.array(sums[2])}
                yield batch_of(**named, n_tokens=pa.array(lengths - 1), **totals)
                if size >= HELD_REFS:
                    yield out()
                    size = 0
        if held:
            yield out()

    return run


#: A text and its sums, or a part of them.
SUMS = pa.schema(
    [(n, pa.int64()) for n in ("_row", "doc_id")]
    + [("held_out", pa.bool_()), ("n_tokens", pa.int64()), ("_known", pa.int64()), ("_base", pa.float64()), ("_delta", pa.float64())]
)
#: What ``_score`` gives: the columns up to ``range`` for a text, ``_row`` and those from ``range`` on for sequences.
SCORED = pa.schema([*SUMS, ("range", pa.int32()), ("size", pa.int32()), ("data", pa.binary())])
SUMS_SQL = "_row bigint, doc_id bigint, held_out boolean, n_tokens bigint, _known bigint, _base double, _delta double"


def _looked_up(packed: pa.Table, entries: pa.Table) -> pa.Table:
    """The rows of texts as they are, and sums by text over the sequences of one range that are among its entries."""
    of_text = pc.is_null(packed.column("size"))
    texts = packed.filter(of_text).select(SUMS.names)
    packed = packed.filter(pc.invert(of_text))
    order = np.argsort(codes_of := entries.column("code").to_numpy().view(np.uint64))
    ordered = codes_of[order]
    per_code = [entries.column(c).to_numpy().astype(float)[order] for c in ("known", "base", "delta")]
    found = [(np.empty(0, np.int64), *(np.empty(0) for _ in per_code))]
    for first, size, data in zip(*(packed.column(c).to_pylist() for c in ("_row", "size", "data"))):
        data = zstandard.ZstdDecompressor().decompress(data)
        codes = np.cumsum(numbers(data[: 8 * size], np.uint64), dtype=np.uint64)
        rows = numbers(data[8 * size : 16 * size], np.uint64).astype(np.int64) + first
        times = numbers(data[16 * size :], np.uint32)
        at = find(ordered, codes)
        here = at >= 0
        rows, where = np.unique(rows[here], return_inverse=True)
        found.append((rows, *(np.bincount(where, x[at[here]] * times[here], len(rows)) for x in per_code)))
    rows, known, base, delta = (np.concatenate(x) for x in zip(*found))
    unnamed = [pa.nulls(len(rows), f.type) for f in list(SUMS)[1:4]]
    columns = [pa.array(rows), *unnamed, pa.array(known.astype(np.int64)), pa.array(base), pa.array(delta)]
    return pa.concat_tables([texts.cast(SUMS), pa.Table.from_arrays(columns, schema=SUMS)])


def token_scores(tree: Tree, ids: np.ndarray) -> np.ndarray:
    """log10 of each token's probability in its longest state, but for the root's share of rare words."""
    numbers = tree.ending(ids, tree.depth)
    total = np.zeros(len(ids))
    open_ = np.ones(len(ids), dtype=bool)
    for d in range(tree.depth, 0, -1):
        state = np.concatenate([[-1], numbers[d - 1][:-1]])
        at = np.flatnonzero(open_ & (state >= 0))
        at = at[tree.keep[d][state[at]]]
        here = state[at]
        nexts = find(tree.grams[d + 1], np.where(ids[at] > 0, here * tree.width + ids[at], -1))
        listed = nexts >= 0
        total[at[listed]] += tree.log_next[d + 1][nexts[listed]]
        open_[at[listed]] = False
        total[at[~listed]] += tree.log_rest[d][here[~listed]]
    rest = open_ & (ids > 0)
    total[rest] += tree.log_root[ids[rest]]
    return total


def build(tree: Tree, tokens: int, distinct: int, strength: float = STRENGTH) -> Tree:
    """Fill in predictions and the divergence tests from the counts of all lengths."""
    width = tree.width
    root = (tree.counts[1] + 1.0) / (tokens + distinct + 1.0)
    tree.log_root = np.log10(root)
    # For each sequence, the number of its suffix; of a pair, that is the id of its last word.
    suffix = {1: np.zeros(len(tree.counts[1]), np.int64)}
    chance = {1: root}
    for d in range(2, tree.depth + 2):
        start, last = tree.grams[d] // width, tree.grams[d] % width
        suffix[d] = last if d == 2 else find(tree.grams[d - 1], suffix[d - 1][start] * width + last)
        above = chance[d - 1][suffix[d]]
        n = tree.counts[d - 1].astype(float)
        seen = tree.counts[d].astype(float)
        chance[d] = (seen + strength * above) / (n[start] + strength)
        size = len(n)
        listed = np.bincount(start, chance[d], size)
        listed_above = np.minimum(np.bincount(start, above, size), 1 - 1e-12)
        rest = np.maximum(n - np.bincount(start, seen, size), 0.0)
        tree.log_next[d] = np.log10(chance[d])
        tree.log_rest[d - 1] = np.log10(np.maximum(1 - listed, 1e-300)) - np.log10(1 - listed_above)
        with np.errstate(divide="ignore", invalid="ignore"):
            gain = np.bincount(start, seen * np.log(seen / n[start] / above), size)
            gain = gain + np.where(rest > 0, rest * np.log(rest / n / (1 - listed_above)), 0.0)
        numbers = np.bincount(start, minlength=size)
        tree.keep[d - 1] = (numbers > 0) & (gain > 0.5 * (numbers + 1) * math.log(max(tokens, 2)))
    for d in range(tree.depth, 1, -1):
        tree.keep[d - 1][suffix[d][tree.keep[d]]] = True
    return tree


def bit_table(codes: DataFrame) -> np.ndarray:
    """A table of fixed size that has the bits of all values of ``code``."""
    at = codes.select(F.col("code").bitwiseAND(F.lit(BITS - 1)).alias("_at"))
    at = at.select(F.shiftright("_at", 15).cast("int").alias("slice"), (F.col("_at") % SLICE).alias("_bit"))
    # Dealt by slice first, so that no more than one bitmap per slice is made.
    slices = at.repartition("slice").groupBy("slice").agg(F.bitmap_construct_agg("_bit").alias("bits")).toArrow()
    bits = np.zeros((BITS // SLICE, SLICE // 8), dtype=np.uint8)
    for place, row in zip(slices.column("slice").to_pylist(), slices.column("bits").to_pylist()):
        bits[place] = np.frombuffer(row, dtype=np.uint8)
    return bits.reshape(-1)


def most_frequent(entries: DataFrame, size: int) -> int:
    """The least count such that no more than ``size`` rows have it or a larger one."""
    # There are few distinct counts: n of them need sequences that occur n * n / 2 times together.
    least, rows = None, 0
    for n, times in sorted(entries.groupBy("n").agg(F.count("*")).collect(), reverse=True):
        rows += times
        if rows > size:
            break
        least = n
    return least if least is not None else 1 << 62


def predictions(
    spark: SparkSession, train: DataFrame, counts: DataFrame, tokens: int, distinct: int, depth: int, min_count: int, folder: str
) -> tuple[dict[int, DataFrame], dict[int, DataFrame]]:
    """For each length the frequent sequences with their chances, and the states with the logarithm of their rest.

    They are tables in ``folder``.
    """
    texts_seen = F.coalesce(F.sum(F.when(F.col("code") == F.lit(_code(END)), F.col("n"))), F.lit(0))
    marks = counts.agg(texts_seen.alias("n")).select(F.lit(MARK).cast("bigint").alias("code"), "n")
    known = counts.where(F.col("n") >= min_count).unionByName(marks)
    chance = (F.col("n") + 1) / F.lit(float(tokens + distinct + 1))
    listed = {1: written(known.withColumn("chance", chance), "words", folder)}
    contexts = {}
    top = listed[1].where(F.col("n") >= most_frequent(listed[1], CACHED)).select("code", "n").toArrow()
    ranked = top.sort_by([("n", "descending"), ("code", "ascending")]).column("code").to_numpy().view(np.uint64)
    # Never empty, so that a place can always be looked up; no text has the symbol 0.
    ranked = ranked if len(ranked) else np.zeros(1, dtype=np.uint64)
    width = range_bits(tokens)
    for d in range(2, depth + 2):
        shared = spark.sparkContext.broadcast((bit_table(listed[d - 1]), ranked))
        counted = train.mapInArrow(tidy(_count_grams(shared, d, width)), "range int, size int, data binary")
        frequent = counted.groupBy("range").applyInArrow(
            _frequent(shared, d, min_count), "code bigint, start bigint, suffix bigint, n bigint"
        )
        starts = listed[d - 1].select(F.col("code").alias("start"), F.col("n").alias("of"))
        suffixes = listed[d - 1].select(F.col("code").alias("suffix"), F.col("chance").alias("above"))
        smoothed = (F.col("n") + F.lit(STRENGTH) * F.col("above")) / (F.col("of") + F.lit(STRENGTH))
        # The join by start comes last, so that files hold starts together and contexts are summed before they are shuffled.
        rows = frequent.join(suffixes, "suffix").join(starts, "start").withColumn("chance", smoothed)
        listed[d] = written(rows, f"sequences-{d}", folder)
        shared.destroy()
        let_go(spark)
        contexts[d - 1] = written(_contexts(listed[d], tokens), f"contexts-{d - 1}", folder)
    states = {}
    for d in range(depth, 0, -1):
        states[d] = contexts[d].where("keep")
        if d < depth:
            needed = listed[d + 1].join(states[d + 1].select("code"), "code", "left_semi")
            needed = needed.select(F.col("suffix").alias("code")).distinct().withColumn("needed", F.lit(True))
            states[d] = contexts[d].join(needed, "code", "left").where(F.col("keep") | F.col("needed"))
        states[d] = written(states[d].select("code", "n", "log_rest"), f"states-{d}", folder)
    let_go(spark)
    return listed, states


def _contexts(listed: DataFrame, tokens: int) -> DataFrame:
    """Per context its count, the logarithm of the rest and the outcome of the divergence test."""
    n, above = F.col("n"), F.col("above")
    sums = listed.groupBy(F.col("start").alias("code")).agg(
        F.first("of").alias("n"),
        F.count("*").alias("numbers"),
        F.sum("chance").alias("chance"),
        F.least(F.sum("above"), F.lit(1 - 1e-12)).alias("above"),
        F.sum("n").alias("seen"),
        F.sum(n * F.log(n / F.col("of") / above)).alias("gain"),
    )
    rest = n - F.col("seen")
    left = F.when(rest > 0, rest * F.log(rest / n / (1 - above))).otherwise(F.lit(0.0))
    return sums.select(
        "code",
        "n",
        (F.log10(F.greatest(1 - F.col("chance"), F.lit(1e-300))) - F.log10(1 - above)).alias("log_rest"),
        (F.col("gain") + left > (F.col("numbers") + 1) * F.lit(0.5 * math.log(max(tokens, 2)))).alias("keep"),
    )


def _code(word: bytes) -> int:
    return int(np.array([xxhash.xxh3_64_intdigest(word)], dtype=np.uint64).view(np.int64)[0])


def suffix_tree_scores(
    docs: DataFrame, held_out: Column, depth: int = DEPTH, min_count: int = MIN_COUNT, cached: int = CACHED
) -> DataFrame:
    """Learn from the rows where ``held_out`` is false and score all rows."""
    spark = docs.sparkSession
    texts = docs.select(
        F.monotonically_increasing_id().alias("_row"),
        F.col("doc_id").cast("bigint").alias("doc_id"),
        held_out.alias("held_out"),
        whole_text().alias("_text"),
    )
    train = texts.where("NOT held_out").select("_text")
    folder = scratch_path(spark, "suffix-tree")
    counted = train.mapInArrow(tidy(_count_words), "code bigint, n bigint")
    counts = written(counted.groupBy("code").agg(F.sum("n").alias("n")), "word-counts", folder)
    let_go(spark)
    tokens, distinct = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    listed, states = predictions(spark, train, counts, tokens, distinct, depth, min_count, folder)

    # What a sequence adds to the score of a text, once for each time it occurs there.
    zero = F.lit(0.0)
    root = counts.select("code", "n", F.lit(1).alias("known"), F.log10(F.col("n") + 1).alias("base"), zero.alias("delta"))
    parts = [root.where(F.col("n") >= min_count)]
    for d in range(1, depth + 1):
        parts.append(states[d].select("code", "n", F.lit(0), zero, "log_rest"))
        nexts = listed[d + 1].select("code", "start", "n", F.log10(F.col("chance") / F.col("above")).alias("gain"))
        nexts = nexts.join(states[d].select(F.col("code").alias("start"), "log_rest"), "start")
        parts.append(nexts.select("code", "n", F.lit(0), zero, F.col("gain") - F.col("log_rest")))
    entries = parts[0]
    for part in parts[1:]:
        entries = entries.union(part)
    sums = (F.sum(c).alias(c) for c in ("known", "base", "delta"))
    entries = entries.groupBy("code").agg(F.max("n").alias("n"), *sums)
    entries = written(entries.unionByName(root.where(F.col("n") < min_count)), "entries")
    # All that scoring needs is among the entries.
    remove(spark, folder)

    least = most_frequent(entries, cached)
    top = entries.where(F.col("n") >= least).toArrow()
    order = np.argsort(codes := top.column("code").to_numpy().view(np.uint64))
    held = [codes[order], *(top.column(c).to_numpy().astype(float)[order] for c in ("known", "base", "delta"))]
    shared = spark.sparkContext.broadcast((bit_table(entries), *held))
    others = entries.where(F.col("n") < least)
    width = range_bits(others.count())
    let_go(spark)
    # Texts and their sequences take one shuffle together, so neither is stored between.
    scored = texts.mapInArrow(tidy(_score(shared, depth + 1, width)), f"{SUMS_SQL}, range int, size int, data binary")
    others = others.select(F.shiftrightunsigned("code", 64 - width).cast("int").alias("range"), *entries.drop("n").columns)
    parts = scored.groupBy("range").cogroup(others.groupBy("range")).applyInArrow(_looked_up, SUMS_SQL)
    named = (F.max(c).alias(c) for c in ("doc_id", "held_out", "n_tokens"))
    totals = parts.groupBy("_row").agg(*named, *(F.sum(c).alias(c) for c in ("_known", "_base", "_delta")))
    base = F.col("_base") - F.col("n_tokens") * F.lit(math.log10(tokens + distinct + 1))
    return totals.select(
        "doc_id",
        "held_out",
        "n_tokens",
        F.col("_known").alias("n_known"),
        F.lit(tokens).cast("bigint").alias("train_tokens"),
        base.alias("base_score"),
        (base + F.col("_delta")).alias("score"),
    )


def op1_suffix_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return suffix_tree_scores(docs, fold("doc_id", FOLDS) == HELD_OUT)


ENTRIES = {"op1_suffix_tree": (op1_suffix_tree, None)}
