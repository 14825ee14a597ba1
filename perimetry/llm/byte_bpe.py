"""Byte-level BPE: ranked merges folded by Spark's higher-order functions.

Method. Texts are split into words by the tokenizer's pattern. A word is an array of byte tokens, and
one ``aggregate`` expression folds the merges over it: each step looks for the adjacent pair of lowest
rank, leftmost first, and puts the merged token in its place, until no pair has a rank. Ranks come from
a literal table inside the expression: a perfect hash of token pairs, so that a look-up is two array
accesses, as Spark searches a map entry by entry. Decoding takes the byte pieces of a slice's tokens at once.

Distinct words are folded once: words are counted over the corpus, and the frequent ones, at most
``dictionary_words`` of at most ``_DICTIONARY_BYTES`` bytes each, are folded as a table of their own
and sent to all tasks. This bounds the broadcast whatever the corpus; all other words are folded where
they stand, which is exact and costs little, as they are rare.

Splitting is vectorised over whole slices of text: the pattern only looks at the classes of neighbouring
characters, and its matches tile the text. The rank file is read by the driver; it does not grow with
the data. Memory of a task is a slice of texts (a single text if that is longer) and the dictionary.
"""

from __future__ import annotations

import base64
import hashlib
import json
import unicodedata
from collections.abc import Iterable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from perimetry.plans.storage import written

_SLICE_BYTES = 8 << 20
_ENCODE_BYTES = 1 << 20  # encoded at a time, beside the dictionary
_SPLIT_BYTES = 1 << 18  # split at a time: this takes some thirty bytes for each byte of text
_SLICE_TOKENS = 1 << 17  # decoded at a time: this takes some fifty bytes for each token
_DICTIONARY_BYTES = 48
_NONE = 1 << 20  # above all ranks
_ID = (1 << 17) - 1  # the bits of a token in an entry of the fold
_OTHER, _LETTER, _NUMBER, _SPACE, _EDGE = range(5)


# splitting


# White space, and what Unicode 16 adds to the letters and numbers of version 15.1, which
# Python's tables have. First and last code point of each stretch.
_BLANKS = (
    (0x9, 0xD), (0x20, 0x20), (0x85, 0x85), (0xA0, 0xA0), (0x1680, 0x1680), (0x2000, 0x200A), (0x2028, 0x2029),
    (0x202F, 0x202F), (0x205F, 0x205F), (0x3000, 0x3000),
)
_NEW_LETTERS = (
    (0x1C89, 0x1C8A), (0xA7CB, 0xA7CD), (0xA7DA, 0xA7DC), (0x105C0, 0x105F3), (0x10D4A, 0x10D65), (0x10D6F, 0x10D85),
    (0x10EC2, 0x10EC4), (0x11380, 0x11389), (0x1138B, 0x1138B), (0x1138E, 0x1138E), (0x11390, 0x113B5),
    (0x113B7, 0x113B7), (0x113D1, 0x113D1), (0x113D3, 0x113D3), (0x11BC0, 0x11BE0), (0x13460, 0x143FA),
    (0x16100, 0x1611D), (0x16D40, 0x16D6C), (0x18CFF, 0x18CFF), (0x1E5D0, 0x1E5ED), (0x1E5F0, 0x1E5F0),
)
_NEW_NUMBERS = (
    (0x10D40, 0x10D49), (0x116D0, 0x116E3), (0x11BF0, 0x11BF9), (0x16130, 0x16139), (0x16D70, 0x16D79),
    (0x1CCF0, 0x1CCF9), (0x1E5F1, 0x1E5FA),
)


class Classes:
    """Letter, number, white space or other, by code point."""

    def __init__(self) -> None:
        general = "".join(unicodedata.category(chr(c))[0] for c in range(0x110000)).encode()
        self.table = np.frombuffer(general.translate(bytes(
            _LETTER if b == ord("L") else _NUMBER if b == ord("N") else _OTHER for b in range(256))), np.uint8).copy()
        for kind, stretches in ((_LETTER, _NEW_LETTERS), (_NUMBER, _NEW_NUMBERS), (_SPACE, _BLANKS)):
            for first, last in stretches:
                self.table[first : last + 1] = kind


_CLASSES: list[Classes] = []


def _classes() -> np.ndarray:
    if not _CLASSES:
        _CLASSES.append(Classes())
    return _CLASSES[0].table


def split(texts: list[bytes]) -> tuple[pa.Array, np.ndarray]:
    """(words of all texts in order, number of words up to the end of each text)."""
    words, ends, before = [], [np.zeros(0, np.int64)], 0
    for part in _parts(texts, _SPLIT_BYTES):
        found, upto = _split(part)
        words.append(found)
        ends.append(upto + before)
        before += len(found)
    return pa.concat_arrays(words or [pa.array([], pa.large_binary())]), np.concatenate(ends)


def _split(texts: list[bytes]) -> tuple[pa.Array, np.ndarray]:
    """As ``split``, in one go.

    The pattern is that of the byte-level vocabularies: contractions; runs of letters, of numbers or of
    other characters, each with one blank before it; white space, of which the last character stands alone
    if something follows.
    """
    data = b"".join(texts)
    points = np.frombuffer(data.decode("utf-8", "replace").encode("utf-32-le"), np.uint32)
    width = 1 + (points >= 0x80).astype(np.int64) + (points >= 0x800) + (points >= 0x10000)
    place = np.cumsum(width) - width  # first byte of each character
    if int(width.sum()) != len(data):
        raise ValueError("a text is not UTF-8")
    n, ends = len(points), np.cumsum([len(t) for t in texts])
    first = np.zeros(n + 1, bool)
    first[np.searchsorted(place, np.concatenate([[0], ends]))] = True
    kind = _classes()[points]
    before, after = np.full(n, _EDGE, np.uint8), np.full(n, _EDGE, np.uint8)
    before[1:], after[:-1] = kind[:-1], kind[1:]
    before[first[:n]], after[first[1:]] = _EDGE, _EDGE
    space, blank_before = kind == _SPACE, np.zeros(n, bool)
    blank_before[1:] = points[:-1] == 0x20
    start = first[:n] | np.where(
        space,
        (before != _SPACE) | ((after != _SPACE) & (after != _EDGE)),
        np.where(before == _SPACE, ~blank_before, before != kind),
    )
    quotes = np.flatnonzero((points == 0x27) & start & (after == _LETTER))
    if len(quotes):
        one = points[quotes + 1]
        has_two = (quotes + 2 < n) & ~first[np.minimum(quotes + 2, n)]
        two = np.where(has_two, points[np.minimum(quotes + 2, n - 1)], 0)
        short = np.isin(one, [ord(c) for c in "stmd"])
        long = reduce(np.logical_or, [(one == ord(a)) & (two == ord(b)) for a, b in ("re", "ve", "ll")])
        start[quotes[short | long] + 1] = False
        for at in (quotes[short] + 2, quotes[long] + 3):
            start[at[at < n]] = True
    begins = place[start]
    offsets = np.append(begins, len(data)).astype(np.int64)
    words = pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(begins), [None, pa.py_buffer(offsets), pa.py_buffer(data)])
    return words, np.searchsorted(begins, ends)


def _slices(column: pa.Array, most: int = _SLICE_BYTES) -> Iterator[list[bytes]]:
    return _parts((text.as_py() or b"" for text in column), most)


def _parts(texts: Iterable[bytes], most: int) -> Iterator[list[bytes]]:
    """Neighbours together until they have ``most`` bytes."""
    part, size = [], 0
    for text in texts:
        part.append(text)
        size += len(text)
        if size >= most:
            yield part
            part, size = [], 0
    if part:
        yield part


# ranks


class Vocabulary:
    """Tokens of a rank file: base64 of a token's bytes and its rank, which is its id, per line."""

    def __init__(self, path: str) -> None:
        with open(path, "rb") as file:
            self.ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}
        self.tokens = [b""] * (max(self.ranks.values()) + 1)
        for token, rank in self.ranks.items():
            self.tokens[rank] = token
        self.byte_ids = [self.ranks[bytes([b])] for b in range(256)]

    def pairs(self) -> dict[tuple[int, int], int]:
        """All pairs of tokens whose concatenation is a token, with that token."""
        ranks = self.ranks
        return {
            (ranks[token[:cut]], ranks[token[cut:]]): rank
            for token, rank in ranks.items() for cut in range(1, len(token))
            if token[:cut] in ranks and token[cut:] in ranks
        }


class PairTable:
    """A perfect hash from token pairs to the tokens they merge into, built by hash and displace.

    One hash of a pair names its group, a second one, moved by the shift of the group, its slot. The slot
    holds the pair beside the merged token, which tells it from pairs that merge into nothing.
    """

    _FACTORS = (2654435761, 2246822519, 3266489917, 668265263)  # odd, mixed bits

    def __init__(self, border: int, pairs: dict[tuple[int, int], int]) -> None:
        left, right, merged = (np.array(x, np.int64) for x in zip(*((*pair, m) for pair, m in pairs.items())))
        self.border = border
        self.groups = 1 << max(1, (len(left) // 4).bit_length())
        self.slots = 1 << (len(left) + len(left) // 4).bit_length()
        packed = (((left << 17) | right) << 20) | merged
        for attempt in range(64):  # other factors if two pairs share both hashes
            self.factors = tuple(f + 2 * attempt for f in self._FACTORS)
            a, b, c, d = self.factors
            group = ((left * a + right * b) >> 13) & (self.groups - 1)
            spot = ((left * c + right * d) >> 11) & (self.slots - 1)
            if len(np.unique(group * self.slots + spot)) == len(left):
                break
        else:
            raise ValueError("no factors tell all pairs apart")
        self.shift = np.zeros(self.groups, np.int64)
        self.table = np.full(self.slots, -1, np.int64)  # -1 differs from all pairs in its high bits
        free = np.ones(self.slots, bool)
        order = np.argsort(group, kind="stable")
        bounds = np.searchsorted(group[order], np.arange(self.groups + 1))
        for g in np.argsort(-np.diff(bounds), kind="stable"):
            own = order[bounds[g] : bounds[g + 1]]
            if not len(own):
                break
            for shift in range(self.slots):
                at = (spot[own] + shift) & (self.slots - 1)
                if free[at].all():
                    free[at], self.table[at], self.shift[g] = False, packed[own], shift
                    break
            else:
                raise ValueError("no free slots")


def _constant(values: list | dict, ddl: str) -> Column:
    """A literal of many values; folded once by the optimizer."""
    return F.from_json(F.lit(json.dumps(values)), ddl)


def _bound(value: Column, use) -> Column:
    """``use(value)`` with ``value`` evaluated once."""
    return F.transform(F.array(value), use)[0]


class Spelling:
    """Words as the fold reads them: a number for each byte token, between two border tokens.

    A number holds the rank of the merge with the next token, the place of the token in the word, and its id.
    """

    def __init__(self, vocabulary: Vocabulary) -> None:
        ids = np.array(vocabulary.byte_ids, np.int64)
        ranks = vocabulary.ranks
        first = [ranks.get(bytes([a, b]), _NONE) for a in range(256) for b in range(256)]
        self.codes = np.append(ids, len(vocabulary.tokens))
        self.ranks = np.full((257, 257), _NONE, np.int64)
        self.ranks[:256, :256] = np.reshape(first, (256, 256))

    def spell(self, words: list[bytes]) -> pa.ListArray:
        sizes = np.array([len(w) + 2 for w in words], np.int64)
        bounds = np.append(0, np.cumsum(sizes))
        octets = np.full(bounds[-1] + 1, 256)
        inside = np.ones(bounds[-1], bool)
        inside[bounds[:-1]] = inside[bounds[1:] - 1] = False
        octets[:-1][inside] = np.frombuffer(b"".join(words), np.uint8)
        place = np.arange(bounds[-1]) - np.repeat(bounds[:-1], sizes)
        rank = self.ranks[octets[:-1], octets[1:]]
        return _lists(bounds, pa.array((rank << 40) | (place << 17) | self.codes[octets[:-1]]))


def fold(spelled: Column, pairs: PairTable) -> Column:
    """Tokens of a spelled word: merges are applied by rank, leftmost first.

    The smallest number of the state is the merge to apply next. The border tokens merge with
    nothing, so every token has one before and one after it.
    """
    shift = _constant(pairs.shift.tolist(), "array<int>")
    table = _constant(pairs.table.tolist(), "array<bigint>")
    place, none = (1 << 40) - 1, F.lit(_NONE).cast("bigint")

    def rank(left: Column, right: Column) -> Column:
        """The token that a pair merges into, which is its rank; ``_NONE`` if it does not merge."""
        a, b, c, d = map(F.lit, pairs.factors)
        group = F.shiftright(left * a + right * b, 13).bitwiseAND(pairs.groups - 1)
        slot = (F.shiftright(left * c + right * d, 11) + shift[group]).bitwiseAND(pairs.slots - 1)
        pair = F.shiftleft(F.shiftleft(left, 17).bitwiseOR(right), 20)
        return _bound(table[slot].bitwiseXOR(pair), lambda x: F.when(F.shiftrightunsigned(x, 20) == 0, x).otherwise(none))

    def token(e: Column) -> Column:
        return e.bitwiseAND(_ID)

    def merge(state: Column, best: Column) -> Column:
        new = F.shiftright(best, 40)

        def entry(left: Column, right: Column, kept: Column) -> Column:
            return F.shiftleft(rank(left, right), 40).bitwiseOR(kept)

        def at(k: Column) -> Column:  # the number of tokens before the merge
            before, after = F.get(state, k - 1), F.get(state, k + 2)
            renewed = F.array(
                entry(token(before), new, before.bitwiseAND(place)),
                entry(new, token(after), best.bitwiseAND(place - _ID).bitwiseOR(new)))
            return F.concat(F.slice(state, F.lit(1), k - 1), renewed, F.slice(state, k + 3, F.size(state)))

        return _bound(F.size(F.filter(state, lambda e: e.bitwiseAND(place) < best.bitwiseAND(place))), at)

    def step(state: Column, _: Column) -> Column:
        return _bound(F.array_min(state), lambda best: F.when(F.shiftright(best, 40) < _NONE, merge(state, best)).otherwise(state))

    def tokens(state: Column) -> Column:  # as the end of the fold: an expression that names the fold twice runs it twice
        return F.transform(F.slice(state, F.lit(2), F.size(state) - 2), lambda e: token(e).cast("int"))

    return F.aggregate(F.slice(spelled, F.lit(1), F.greatest(F.size(spelled) - 3, F.lit(0))), spelled, step, tokens)


# encoding


def _known_words(docs: DataFrame, text_col: str, tokens: pa.Array) -> DataFrame:
    """(word, n) of words that are no token themselves and short enough for the dictionary."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in _slices(batch.column(0)):
                counted = split(part)[0].value_counts()
                words, n = counted.field(0), counted.field(1)
                wanted = pc.and_(
                    pc.less_equal(pc.binary_length(words), _DICTIONARY_BYTES), pc.invert(pc.is_in(words, value_set=tokens)))
                yield pa.RecordBatch.from_arrays(
                    [words.filter(wanted).cast(pa.binary()), n.filter(wanted).cast(pa.int64())], names=["word", "n"])
                del counted, words, n, wanted
                pa.default_memory_pool().release_unused()  # the worker goes on to encode

    words = docs.select(F.col(text_col).cast("binary").alias("text")).mapInArrow(run, "word binary, n bigint")
    return words.groupBy("word").agg(F.sum("n").alias("n"))


def dictionary(docs: DataFrame, vocabulary: Vocabulary, pairs: PairTable, dictionary_words: int, text_col: str) -> pa.Table:
    """(word, ids) of the words that stand in ``docs`` most often.

    Frequent means at least 2^k times, for the smallest k >= 1 that leaves at most ``dictionary_words`` words.
    """
    tokens = pa.array(vocabulary.tokens, pa.large_binary())
    counted = written(_known_words(docs, text_col, tokens).where("n > 1"), "words")
    sizes = counted.groupBy(F.floor(F.log2("n")).cast("int").alias("k")).count().collect()  # at most 63 rows
    least, total = 63, 0
    for k, count in sorted(((r.k, r["count"]) for r in sizes), reverse=True):
        if total + count > dictionary_words:
            break
        least, total = k, total + count
    spelling = Spelling(vocabulary)

    def spell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), spelling.spell(batch.column(0).to_pylist())], names=["word", "spelled"])

    kept = counted.where(F.floor(F.log2("n")) >= least).select("word").repartition("word")
    spelled = kept.mapInArrow(spell, "word binary, spelled array<bigint>")
    return spelled.select("word", fold(F.col("spelled"), pairs).alias("ids")).toArrow()


class Encoder:
    """Known words of a slice as tokens, the others spelled.

    It is made once, on the driver. Workers use the arrays of the broadcast as they come, so each holds one copy only.
    """

    def __init__(self, tokens: list[bytes], spelling: Spelling, words: pa.Table) -> None:
        single = pa.ListArray.from_arrays(
            pa.array(range(len(tokens) + 1), pa.int32()), pa.array(range(len(tokens)), pa.int32()))
        self.words = pa.concat_arrays([pa.array(tokens, pa.binary()), *words.column("word").cast(pa.binary()).chunks])
        self.ids = pa.concat_arrays([single, *words.column("ids").cast(single.type).chunks])
        self.spelling = spelling
        hashes = _hashes(self.words)
        self.order = np.argsort(hashes, kind="stable").astype(np.int32)
        self.hashes = hashes[self.order]

    def places(self, words: pa.Array) -> np.ndarray:
        """Place of each of ``words`` among the known ones, or -1. The hash names one word, which is then compared; of
        known words with one hash only the first is found, and the others are folded in their texts."""
        hashes = _hashes(words)
        at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        place = self.order[at]
        same = pc.equal(self.words.take(pa.array(place)).cast(words.type), words).to_numpy(zero_copy_only=False)
        return np.where(same & (self.hashes[at] == hashes), place, -1)

    def encode(self, texts: list[bytes]) -> tuple[pa.Array, pa.Array]:
        """Per text: runs of tokens, and the spelled words between them."""
        words, ends = split(texts)
        coded = words.dictionary_encode()
        number = self.places(coded.dictionary)[coded.indices.to_numpy()]
        rare = np.flatnonzero(number < 0)
        ids = self.ids.take(pa.array(number[number >= 0]))
        sizes = np.zeros(len(words) + 1, np.int64)
        known = np.ones(len(words), bool)
        known[rare] = False
        sizes[1:][known] = ids.value_lengths().to_numpy()
        upto = np.cumsum(sizes)  # tokens before each word
        last = np.searchsorted(rare, ends)  # rare words before the end of each text
        cuts = np.insert(upto[rare], last, upto[ends])  # a run ends at each rare word and at the end of a text
        runs = _lists(np.append(0, cuts), ids.flatten())
        spelled = self.spelling.spell(words.take(pa.array(rare)).to_pylist() if len(rare) else [])
        return _lists(np.append(0, last + np.arange(1, len(texts) + 1)), runs), _lists(np.append(0, last), spelled)


def _hashes(words: pa.Array) -> np.ndarray:
    parts = (words.slice(at, 1 << 16).to_pylist() for at in range(0, len(words), 1 << 16))
    return np.fromiter((xxhash.xxh3_64_intdigest(w) for part in parts for w in part), np.uint64, len(words))


def _lists(bounds: np.ndarray, values: pa.Array) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), values)


def encode(
    docs: DataFrame, ranks: str, dictionary_words: int = 1 << 20, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(doc_id, ids) of every row, ``ids`` as an array of token ids, without special tokens.

    ``ranks`` is the path of a rank file on the driver. Null and empty texts have no ids. Repeated rows give
    repeated rows, rows without an id are encoded like others, an empty table gives no rows; other columns
    are not read, so their names cannot clash. Very long texts are encoded whole; a word of n bytes
    takes n merge steps at most, each copying what is left of the word.
    """
    spark = docs.sparkSession
    vocabulary = Vocabulary(ranks)
    pairs = PairTable(len(vocabulary.tokens), vocabulary.pairs())
    words = dictionary(docs, vocabulary, pairs, dictionary_words, text_col)
    shipped = spark.sparkContext.broadcast(Encoder(vocabulary.tokens, Spelling(vocabulary), words))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = 0
            for part in _slices(batch.column(1), _ENCODE_BYTES):
                runs, raw = shipped.value.encode(part)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(at, len(part)), runs, raw], names=["doc_id", "runs", "raw"])
                at += len(part)
                pa.default_memory_pool().release_unused()  # else each worker keeps its largest slice's memory

    kind = docs.schema[id_col].dataType.simpleString()
    coded = docs.select(F.col(id_col), F.col(text_col).cast("binary").alias("text")).mapInArrow(
        run, f"doc_id {kind}, runs array<array<int>>, raw array<array<bigint>>")
    folded = F.transform("raw", lambda word: fold(word, pairs))
    none = F.array().cast("array<int>")
    joined = F.flatten(F.zip_with("runs", folded, lambda a, b: F.concat(a, F.coalesce(b, none))))
    return coded.select("doc_id", joined.alias("ids"))


def _token_slices(batch: pa.RecordBatch, ids: str) -> Iterator[pa.RecordBatch]:
    """Rows of a batch with at most ``_SLICE_TOKENS`` ids together, or a single row."""
    upto = np.cumsum(batch.column(ids).value_lengths().fill_null(0).to_numpy().astype(np.int64))
    at = 0
    while at < len(upto):
        before = upto[at - 1] if at else 0
        end = max(at + 1, int(np.searchsorted(upto, before + _SLICE_TOKENS, "right")))
        yield batch.slice(at, end - at)
        at = end


def _id_sums(lists: pa.ListArray) -> pa.Array:
    """SHA-256 of each row's decimal ids, joined by one space."""
    bounds = np.append(0, np.cumsum(lists.value_lengths().fill_null(0).to_numpy()))
    joined = pc.binary_join(_lists(bounds, lists.flatten().cast(pa.string())), " ")
    return pa.array(
        [hashlib.sha256(t.as_buffer()).hexdigest() if ok.as_py() else None for t, ok in zip(joined, lists.is_valid())], pa.string())


def decode(encoded: DataFrame, ranks: str, hashed: bool = False) -> DataFrame:
    """``encoded`` (doc_id, ids) with a further column ``decoded``: the tokens' bytes, one after another.

    The pieces of a slice's ids are taken at once and lie one behind the other, so a row's bytes are a stretch of them.
    ``hashed`` adds the ids' ``ids_sha256`` for ``digests``, which else reads the ids in Python workers of its own.
    """
    pieces = [*Vocabulary(ranks).tokens, b""]  # the last one stands for ids that are no token

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, none = pa.array(pieces, pa.large_binary()), len(pieces) - 1
        for batch in batches:
            for part in _token_slices(batch, "ids"):
                lists = part.column("ids")
                ids = lists.flatten().fill_null(none).to_numpy()
                taken = known.take(pa.array(np.where((ids >= 0) & (ids < none), ids, none)))
                starts = np.frombuffer(taken.buffers()[1], np.int64, len(taken) + 1) if len(taken) else np.zeros(1, np.int64)
                bounds = np.append(0, np.cumsum(lists.value_lengths().fill_null(0).to_numpy()))
                whole = pa.LargeBinaryArray.from_buffers(
                    pa.large_binary(), len(part), [None, pa.py_buffer(starts[bounds].copy()), taken.buffers()[2] or pa.py_buffer(b"")])
                decoded = pc.if_else(lists.is_valid(), whole, None).cast(pa.binary())
                added = {"decoded": decoded} | ({"ids_sha256": _id_sums(lists)} if hashed else {})
                yield pa.RecordBatch.from_arrays([*part.columns, *added.values()], names=[*part.schema.names, *added])
                del taken, starts, whole, decoded, added
                pa.default_memory_pool().release_unused()

    added = [T.StructField("decoded", T.BinaryType()), *([T.StructField("ids_sha256", T.StringType())] if hashed else [])]
    return encoded.mapInArrow(run, T.StructType([*encoded.schema.fields, *added]))


def digests(decoded: DataFrame) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of encoded and decoded rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in _token_slices(batch, "ids"):
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("n_tokens"), _id_sums(part.column("ids")), part.column("decoded_sha256")],
                    names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    kind = decoded.schema["doc_id"].dataType.simpleString()
    n_tokens, decoded_sha256 = F.size("ids").cast("long").alias("n_tokens"), F.sha2("decoded", 256).alias("decoded_sha256")
    if "ids_sha256" in decoded.columns:
        return decoded.select("doc_id", n_tokens, "ids_sha256", decoded_sha256)
    rows = decoded.select("doc_id", "ids", n_tokens, decoded_sha256)
    return rows.mapInArrow(run, f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string")
