"""Quality classifier: a byte-level convolutional network in numpy.

Method. Learned filters of ``WIDTH`` bytes run over the whole text. The text is covered by overlapping
chunks; each filter is max-pooled within a chunk, and the chunks' pooled values are combined (mean and
maximum over chunks, one hidden layer) into one probability. Filters are tables byte -> response per
offset, which equals a convolution over one-hot bytes and needs no multiplications.

Training. The network is fitted on the driver on a bounded sample of labelled rows: at most
``per_class`` rows of each label, chosen by a hash of their id, each with at most ``chunks`` chunks spread
evenly over its text; both are parameters of ``train``. A sampled row weighs as many rows of its label as it stands for, so the
share of good rows, and with it what a score means, does not depend on ``per_class`` or the size of the
input. Scoring reads every byte of every text.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from perimetry.llm.text import as_bytes

WIDTH, FILTERS, HIDDEN = 6, 24, 16
_BLOCK = 64  # pooled first; chunks are runs of blocks
_CHUNK, _STEP = 8, 7  # blocks: chunks of 512 bytes, overlapping by 64
_POSITIONS = 16_384  # convolved at a time
_TEXTS = 1 << 20  # bytes handled at a time


@dataclass
class Network:
    filters: np.ndarray  # (WIDTH, 256, FILTERS)
    bias: np.ndarray
    w1: np.ndarray  # (2 * FILTERS, HIDDEN)
    b1: np.ndarray
    w2: np.ndarray
    b2: float

    def __post_init__(self):
        self._pairs = None

    def _convolve(self, data: np.ndarray, count: int) -> np.ndarray:
        """Responses at the first ``count`` positions; two offsets at a time through tables of byte pairs."""
        if self._pairs is None:
            self._pairs = [
                (self.filters[o][:, None, :] + self.filters[o + 1][None, :, :]).reshape(65_536, -1)
                for o in range(0, WIDTH, 2)
            ]
        pair = data[:-1].astype(np.int32) * 256 + data[1:]
        out = self._pairs[0].take(pair[:count], axis=0)
        for k in range(1, len(self._pairs)):
            out += self._pairs[k].take(pair[2 * k : 2 * k + count], axis=0)
        return out

    def _blocks(self, data: np.ndarray, valid: np.ndarray) -> np.ndarray:
        """Maximum response per block. ``data`` has whole blocks; positions outside ``valid`` do not count."""
        padded = np.r_[data, np.zeros(WIDTH, np.uint8)]
        out = np.empty((len(data) // _BLOCK, FILTERS), np.float32)
        for low in range(0, len(data), _POSITIONS):
            high = min(low + _POSITIONS, len(data))
            found = self._convolve(padded[low : high + WIDTH], high - low)
            found[~valid[low:high]] = -np.inf
            out[low // _BLOCK : high // _BLOCK] = found.reshape(-1, _BLOCK, FILTERS).max(axis=1)
        return out

    def pooled(self, texts: list[bytes]) -> Iterator[np.ndarray]:
        """(chunks, FILTERS) of each text."""
        sizes = [max(1, len(t)) for t in texts]
        widths = [-(-(n + WIDTH) // _BLOCK) * _BLOCK for n in sizes]  # room for a window's zeros after the text
        starts = np.r_[0, np.cumsum(widths)]
        data = np.zeros(starts[-1], np.uint8)
        valid = np.zeros(starts[-1], bool)
        for text, size, start in zip(texts, sizes, starts):
            data[start : start + len(text)] = np.frombuffer(text, np.uint8)
            valid[start : start + size] = True
        blocks = self._blocks(data, valid) + self.bias
        for size, start in zip(sizes, starts):
            own = blocks[start // _BLOCK : start // _BLOCK + -(-size // _BLOCK)]
            first = np.arange(0, max(1, len(own) - (_CHUNK - _STEP)), _STEP)
            pooled = np.stack([own[np.minimum(first + k, len(own) - 1)] for k in range(_CHUNK)]).max(axis=0)
            yield np.maximum(pooled, 0)

    def combine(self, features: np.ndarray) -> np.ndarray:
        # not by a matrix library, whose last digits depend on the other rows
        hidden = np.maximum(np.einsum("ij,jk->ik", features, self.w1) + self.b1, 0)
        return 1 / (1 + np.exp(-np.clip(np.einsum("ij,j->i", hidden, self.w2) + self.b2, -30, 30)))

    def score(self, texts: list[bytes]) -> np.ndarray:
        features = np.array([np.r_[p.mean(axis=0), p.max(axis=0)] for p in self.pooled(texts)], dtype=np.float64)
        return self.combine(features.reshape(len(texts), 2 * FILTERS))


def sampled_chunks(text: bytes, most: int = 12) -> list[bytes]:
    """At most ``most`` chunks, spread evenly over the text."""
    step, size = _STEP * _BLOCK, _CHUNK * _BLOCK
    count = max(1, -(-(len(text) - (size - step)) // step))
    picked = sorted({round(i * (count - 1) / max(1, most - 1)) for i in range(most)}) if count > most else range(count)
    return [text[i * step : i * step + size] for i in picked]


def fit(
    rows: list[tuple[list[bytes], int]], epochs: int = 15, seed: int = 7, rate: float = 0.015,
    weights: dict[int, float] | None = None,
) -> Network:
    """Train on (chunks, label) rows by Adam on the log loss. Rows weigh the same, or in proportion to the
    ``weights`` of their labels; without rows every score is one half."""
    weight = np.array([weights[label] if weights else 1 for _, label in rows], np.float32)
    weight *= len(rows) / weight.sum() if rows else 1
    rng = np.random.default_rng(seed)
    shapes = {"filters": (WIDTH, 256, FILTERS), "bias": (FILTERS,), "w1": (2 * FILTERS, HIDDEN), "b1": (HIDDEN,),
              "w2": (HIDDEN,), "b2": (1,)}
    scale = {"filters": 0.3, "w1": 0.2, "w2": 0.3}
    p = {k: rng.normal(0, scale[k], s).astype(np.float32) if k in scale else np.zeros(s, np.float32) for k, s in shapes.items()}
    if not rows:
        p["w2"][:] = 0
    moments = {k: [np.zeros_like(v), np.zeros_like(v)] for k, v in p.items()}
    size, count = _CHUNK * _BLOCK, 0
    for epoch in range(epochs if rows else 0):
        for part in np.array_split(rng.permutation(len(rows)), max(1, len(rows) // 32)):
            chunks = [c for i in part for c in rows[i][0]]
            owner = np.repeat(np.arange(len(part)), [len(rows[i][0]) for i in part])
            label = np.array([rows[i][1] for i in part], np.float32)
            data = np.zeros((len(chunks), size + WIDTH), np.uint8)
            valid = np.zeros((len(chunks), size), bool)
            for row, c in enumerate(chunks):
                data[row, : len(c)] = np.frombuffer(c, np.uint8)
                valid[row, : max(1, len(c))] = True
            response = p["filters"][0][data[:, :size]]
            for o in range(1, WIDTH):
                response += p["filters"][o][data[:, o : size + o]]
            response[~valid] = -np.inf
            at = response.argmax(axis=1)  # (chunks, FILTERS)
            raw = np.take_along_axis(response, at[:, None, :], axis=1)[:, 0] + p["bias"]
            act = np.maximum(raw, 0)
            n = np.bincount(owner, minlength=len(part)).astype(np.float32)
            first = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
            mean = np.add.reduceat(act, first) / n[:, None]
            top = np.maximum.reduceat(act, first)
            features = np.concatenate([mean, top], axis=1)
            hidden = np.maximum(features @ p["w1"] + p["b1"], 0)
            out = 1 / (1 + np.exp(-np.clip(hidden @ p["w2"] + p["b2"], -30, 30)))
            d_out = weight[part] * (out - label) / len(part)
            d_hidden = d_out[:, None] * p["w2"] * (hidden > 0)
            d_features = d_hidden @ p["w1"].T
            highest = act == top[owner]
            share = highest / np.maximum(np.add.reduceat(highest.astype(np.float32), first), 1)[owner]
            d_act = d_features[owner, :FILTERS] / n[owner, None] + d_features[owner, FILTERS:] * share
            d_raw = d_act * (raw > 0)
            grad = {"bias": d_raw.sum(axis=0), "w1": features.T @ d_hidden, "b1": d_hidden.sum(axis=0),
                    "w2": hidden.T @ d_out, "b2": np.array([d_out.sum()])}
            d_filters = np.zeros_like(p["filters"])
            chunk, f = np.nonzero(d_raw)
            for o in range(WIDTH):
                np.add.at(d_filters[o], (data[chunk, at[chunk, f] + o], f), d_raw[chunk, f])
            grad["filters"] = d_filters
            count += 1
            step = rate * min(1.0, 2 * (1 - epoch / epochs))
            for k, g in grad.items():
                m, v = moments[k]
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                p[k] -= (step * (m / (1 - 0.9**count)) / (np.sqrt(v / (1 - 0.999**count)) + 1e-8)).astype(np.float32)
    return Network(p["filters"], p["bias"], p["w1"].astype(np.float64), p["b1"].astype(np.float64),
                   p["w2"].astype(np.float64), float(p["b2"][0]))


def held_out(id_col: str = "doc_id"):
    """Rows never learned from: crc32 of the id's text is a multiple of 5."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 5 == 0, F.lit(False))


def training_rows(
    docs: DataFrame, labels: DataFrame, per_class: int = 3000, chunks: int = 12
) -> tuple[list[tuple[list[bytes], int]], dict[int, float]]:
    """A bounded sample of labelled texts outside the held-out fold, one text of each id and label (the one with
    the smallest hash, where rows repeat an id), and how many labelled rows of ``docs`` each sampled
    row of a label stands for."""
    known = labels.where(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out())
    known = known.select("doc_id", "quality").distinct().join(docs.select("doc_id"), "doc_id", "left_semi")
    picked = None
    for label in (0, 1):
        own = known.where(F.col("quality") == label)
        own = own.orderBy(F.xxhash64(F.lit("sample"), "doc_id"), "doc_id").limit(per_class)
        picked = own if picked is None else picked.union(own)
    weights = {r["quality"]: max(1.0, r["count"] / per_class) for r in known.groupBy("quality").count().collect()}
    texts = docs.select("doc_id", as_bytes("text"), F.xxhash64("text").alias("content"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [sampled_chunks(t.as_py() or b"", chunks) for t in b["text"]]
            yield pa.RecordBatch.from_arrays(
                [b["doc_id"], b["quality"], b["content"], pa.array(found, pa.list_(pa.binary()))],
                names=["doc_id", "quality", "content", "chunks"])

    # at most 2 * per_class ids are broadcast
    joined = texts.join(F.broadcast(picked), "doc_id").mapInArrow(
        run, "doc_id long, quality int, content long, chunks array<binary>")
    one = joined.groupBy("doc_id", "quality").agg(F.min(F.struct("content", "chunks")).alias("text"))
    rows = [([bytes(c) for c in r.chunks], r.quality)
            for r in sorted(one.select("doc_id", "quality", "text.chunks").collect(), key=lambda r: (r.doc_id, r.chunks, r.quality))]
    return rows, weights


def train(docs: DataFrame, labels: DataFrame, per_class: int = 3000, chunks: int = 12) -> Network:
    """Fit on ``per_class`` texts of each label and ``chunks`` chunks of each, which bounds what the driver holds. On texts
    longer than that (about 5 KB) the network learns from part of the text; scoring always pools all of it."""
    rows, weights = training_rows(docs, labels, per_class, chunks)
    return fit(rows, weights=weights)


def scored(docs: DataFrame, network: Network, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, score) of every row: the probability of good quality, from the text's bytes alone.

    Null and empty texts are scored as a text of one zero byte. Repeated rows give repeated rows and
    equal texts equal scores; other columns are not read.
    """
    model = docs.sparkSession.sparkContext.broadcast(network)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = [t.as_py() or b"" for t in b.column(1)]
            for low, high in _parts(texts):
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(low, high - low), pa.array(model.value.score(texts[low:high]))], names=["doc_id", "score"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col), as_bytes(text_col)).mapInArrow(run, f"doc_id {kind}, score double")


def accepted(docs: DataFrame, network: Network, least: float, text_col: str = "text") -> DataFrame:
    """Rows of ``docs`` whose text scores at least ``least``, unchanged and without a shuffle."""
    model = docs.sparkSession.sparkContext.broadcast(network)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = [t.as_py() or "" for t in b[text_col]]
            for low, high in _parts(texts):
                good = model.value.score([t.encode("utf-8", "replace") for t in texts[low:high]]) >= least
                yield b.slice(low, high - low).filter(pa.array(good))

    return docs.mapInArrow(run, docs.schema)


def _parts(texts: list) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about ``_TEXTS`` in sum."""
    low, size = 0, 0
    for i, text in enumerate(texts):
        size += len(text)
        if size >= _TEXTS or i == len(texts) - 1:
            yield low, i + 1
            low, size = i + 1, 0
