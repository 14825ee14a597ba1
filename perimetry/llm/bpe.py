"""BPE encoding and decoding with a word-level vocabulary (``</w>`` marks the end of a word).

Method. The distinct words of a slice of texts form a trie; walking them in sorted order is the
depth-first traversal of that trie, with one state per depth on a stack. The state of a prefix is the
last token of its encoding: a token t that ends the prefix is that token exactly if it is compatible
with the last token u of the prefix before it, that is if merging u + t on its own yields (u, t). So a
shared prefix is encoded once for all words below it, and the tokens of a word are read off the states
from its end to its start. Compatibility of two tokens is settled once and remembered: their own merges
are taken back, the latest first, and at no time may the parts on both sides of the border merge earlier.

Words come from the tokenizer's own rules: special tokens are cut out of the raw text, the rest is
normalized (NFC, lower case) and split by pattern. The vocabulary file is read by the driver and sent
to the tasks as it is; it does not grow with the data.
"""

from __future__ import annotations

import json
import struct
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from perimetry.llm.text import as_bytes

_SLICE_CHARS = 1 << 20  # texts handled at a time
_REMEMBERED = 400_000  # words, and half as many pairs; bounds memory only
# letters of these blocks have been assigned for long, so every library splits them alike
_COMMON = regex.compile(r"[\u0000-ɏ̀-ԯ֐-ۿ -⋿぀-ヿ一-龥]*")


def byte_symbols() -> list[str]:
    """Printable stand-ins of the 256 bytes: themselves where printable, else from 256 upwards."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    spare = iter(range(256, 512))
    return [chr(b) if b in printable else chr(next(spare)) for b in range(256)]


class WordBpe:
    """Encoder and decoder for one tokenizer file."""

    def __init__(self, definition: str):
        model = json.loads(definition)
        bpe = model["model"]
        self.library = Tokenizer.from_str(definition)
        self.vocab: dict[str, int] = bpe["vocab"]
        self.end: str = bpe["end_of_word_suffix"] or ""
        pairs = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in bpe["merges"]]
        self.ranks = {pair: rank for rank, pair in enumerate(pairs)}
        self.made: dict[str, tuple[int, tuple[str, str]]] = {}  # the first merge that yields a token
        for pair, rank in self.ranks.items():
            self.made.setdefault("".join(pair), (rank, pair))
        self.openings = {t[:n] for t in self.vocab for n in range(1, len(t) + 1)}
        self.special = {t["content"]: t["id"] for t in model["added_tokens"]}
        steps = model["pre_tokenizer"]["pretokenizers"]
        self.split = regex.compile(steps[0]["pattern"]["Regex"])
        self.cut = regex.compile("(" + "|".join(regex.escape(s) for s in self.special) + ")") if self.special else None
        self.bytes = byte_symbols()
        self.symbols = {s: b for b, s in enumerate(self.bytes)}
        self.words: dict[str, bytes] = {}
        self.pairs: dict[tuple[str, str], bool] = {}
        self.whole: dict[str, bool] = {}

    # merges, for single pairs of tokens

    def _symbols(self, token: str) -> list[str]:
        if self.end and token.endswith(self.end) and len(token) > len(self.end):
            chars = list(token[: -len(self.end)])
            chars[-1] += self.end
            return chars
        return list(token)

    def _merge(self, symbols: list[str]) -> list[str]:
        while len(symbols) > 1:
            rank, at = min((self.ranks.get(pair, len(self.ranks)), i) for i, pair in enumerate(zip(symbols, symbols[1:])))
            if rank == len(self.ranks):
                break
            symbols = [*symbols[:at], symbols[at] + symbols[at + 1], *symbols[at + 2 :]]
        return symbols

    def _is_whole(self, token: str) -> bool:
        """Whether the merges build this entry of the vocabulary from its own symbols."""
        known = self.whole.get(token)
        if known is None:
            known = self.whole[token] = self._merge(self._symbols(token)) == [token]
        return known

    def _compatible(self, before: str, token: str) -> bool:
        """Whether ``token`` stays a token after ``before``; both are whole."""
        ranks, made = self.ranks, self.made
        left, right, latest = before, token, len(ranks)
        while True:
            # a pair merges before the parts beside it do, or, of one rank, if it stands further left
            if ranks.get((left, right), latest) < latest:
                return False
            from_left, from_right = made.get(left), made.get(right)
            if from_left and (not from_right or from_left[0] > from_right[0]):
                latest, left = from_left[0], from_left[1][1]
            elif from_right:
                latest, right = from_right[0] + 1, from_right[1][0]
            else:
                return True

    # the trie

    def _last(self, word: str, size: int, starts: list[int], last: list[str], end: str) -> str:
        """The last token of ``word[:size]`` (+ ``end``), given the last tokens of all shorter prefixes;
        it starts at one of ``starts``."""
        vocab, pairs = self.vocab, self.pairs
        for start in starts:
            token = word[start:size] + end
            if token not in vocab or not self._is_whole(token):
                continue
            before = last[start]
            if not before:
                return token
            known = pairs.get((before, token))
            if known is None:
                if 2 * len(pairs) > _REMEMBERED:
                    pairs.clear()
                known = pairs[before, token] = self._compatible(before, token)
            if known:
                return token
        raise ValueError(f"{word[:size]!r} has a symbol outside the vocabulary")

    def encode_words(self, words: set[str]) -> None:
        """Encode distinct words into ``self.words``; shared prefixes are walked once."""
        spell, openings, vocab, end = self.bytes.__getitem__, self.openings, self.vocab, self.end
        mapped = sorted(("".join(map(spell, w.encode())), w) for w in words)
        # per prefix length of the current word: its last token, and where a token may have begun that goes on
        last, open_, previous = [""], [[]], ""
        for spelled, word in mapped:
            shared, most = 0, min(len(last) - 1, len(spelled) - 1)
            while shared < most and spelled[shared] == previous[shared]:
                shared += 1
            del last[shared + 1 :], open_[shared + 1 :]
            length = len(spelled)
            for size in range(shared + 1, length + 1):
                starts = [s for s in open_[-1] if spelled[s:size] in openings]
                starts.append(size - 1)
                if size < length:
                    open_.append(starts)
                    last.append(self._last(spelled, size, starts, last, ""))
            previous = spelled
            token = self._last(spelled, length, starts, last, end)
            tokens, left = [token], length - (len(token) - len(end))
            while left:
                tokens.append(last[left])
                left -= len(last[left])
            ids = [vocab[t] for t in reversed(tokens)]
            self.words[word] = struct.pack(f"<{len(ids)}I", *ids)

    # texts

    def pieces(self, text: str) -> list[str]:
        """Words and special tokens of a text, in order."""
        if self.cut and (parts := self.cut.split(text))[1:]:
            return [w for p in parts for w in ([p] if p in self.special else self.pieces(p))]
        if not _COMMON.fullmatch(text):  # the library's own tables for rarer scripts
            normal = self.library.normalizer.normalize_str(text)
            found = self.library.pre_tokenizer.pre_tokenize_str(normal)
            return [bytes(map(self.symbols.__getitem__, p)).decode() for p, _ in found]
        if not text.isascii():
            text = unicodedata.normalize("NFC", text).replace("Σ", "σ")  # no final form of sigma
        return self.split.findall(text.lower())

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers."""
        split = [self.pieces(t) for t in texts]
        new = {w for pieces in split for w in set(pieces)}
        if len(self.words) > _REMEMBERED:
            self.words.clear()
        for token, number in self.special.items():
            self.words[token] = np.array([number], dtype="<u4").tobytes()
        self.encode_words(new.difference(self.words))
        return [b"".join(map(self.words.__getitem__, pieces)) for pieces in split]


class Decoder:
    """Token strings of one tokenizer file."""

    def __init__(self, definition: str):
        model = json.loads(definition)
        tokens = {**model["model"]["vocab"], **{t["content"]: t["id"] for t in model["added_tokens"]}}
        self.strings: list[str | None] = [None] * (max(tokens.values()) + 1)
        for token, number in tokens.items():
            self.strings[number] = token

    def decode(self, ids: bytes) -> str:
        """The tokens' strings, joined by blanks: the file names no decoder."""
        return " ".join([s for s in map(self.strings.__getitem__, np.frombuffer(ids, "<u4").tolist()) if s is not None])


_LOADED: dict[type, tuple[int, WordBpe | Decoder]] = {}


def _loaded(kind: type, definition) -> WordBpe | Decoder:
    """One coder per worker and file: words stay encoded between tasks."""
    key = hash(definition.value)
    if kind not in _LOADED or _LOADED[kind][0] != key:
        _LOADED[kind] = (key, kind(definition.value))
    return _LOADED[kind][1]


def _slices(texts: Iterator[str]) -> Iterator[list[str]]:
    part, size = [], 0
    for text in texts:
        part.append(text)
        size += len(text)
        if size >= _SLICE_CHARS:
            yield part
            part, size = [], 0
    if part:
        yield part


def _read(path: str) -> str:
    with open(path, encoding="utf-8") as file:
        return file.read()


def encode(
    docs: DataFrame, tokenizer: str, decoded: bool = False, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(doc_id, ids[, decoded]) of every row; ``ids`` are little-endian unsigned 32-bit integers, ``decoded``
    is the text that they decode to, special tokens included.

    ``tokenizer`` is the path of a ``tokenizers`` file on the driver. Null and empty texts have no ids.
    Repeated rows give repeated rows; other columns are not read.
    """
    definition = docs.sparkSession.sparkContext.broadcast(_read(tokenizer))
    names = ["doc_id", "ids", *["decoded"] * decoded]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            start = 0
            for part in _slices((t.as_py() or b"").decode("utf-8", "replace") for t in b.column(1)):
                ids = _loaded(WordBpe, definition).encode(part)
                columns = [b.column(0).slice(start, len(part)), pa.array(ids, pa.binary())]
                if decoded:
                    columns.append(pa.array(map(_loaded(Decoder, definition).decode, ids), pa.string()))
                yield pa.RecordBatch.from_arrays(columns, names=names)
                start += len(part)

    kind = docs.schema[id_col].dataType.simpleString()
    ddl = f"doc_id {kind}, ids binary" + ", decoded string" * decoded
    return docs.select(F.col(id_col), as_bytes(text_col)).mapInArrow(run, ddl)


def decode(encoded: DataFrame, tokenizer: str) -> DataFrame:
    """``encoded`` (doc_id, ids) with a further column ``decoded``, special tokens included."""
    definition = encoded.sparkSession.sparkContext.broadcast(_read(tokenizer))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            coder, start = _loaded(Decoder, definition), 0
            sizes = [0, *np.cumsum([len(x.as_py() or b"") for x in b["ids"]]).tolist()]
            while start < b.num_rows:  # so many bytes at a time
                stop = start + 1
                while stop < b.num_rows and sizes[stop + 1] - sizes[start] <= 2 * _SLICE_CHARS:
                    stop += 1
                part = b.slice(start, stop - start)
                texts = [coder.decode(x.as_py() or b"") for x in part["ids"]]
                yield pa.RecordBatch.from_arrays(
                    [part["doc_id"], part["ids"], pa.array(texts, pa.string())], names=["doc_id", "ids", "decoded"])
                start = stop

    kind = encoded.schema["doc_id"].dataType.simpleString()
    return encoded.select("doc_id", "ids").mapInArrow(run, f"doc_id {kind}, ids binary, decoded string")


def digests(coded: DataFrame) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of encoded and decoded rows."""
    return coded.select(
        "doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"), F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )
