"""Periodic runs of words: maximal stretches that repeat with a period, found through Lyndon roots.

Method. The first phase of Baier's suffix sorter groups all suffixes by the longest Lyndon word that
starts there, from the highest group to the lowest; the lengths of these words are the Lyndon array,
which thus comes out directly, without a suffix array. It is made under the order of the words and
under the reverse order, as every run has its Lyndon root in one of the two. A root that stands three
times in a row is then extended by the longest common extension to both sides into a run. (Runs wanted
here repeat at least four times, so each has a root that stands three times in a row.)

Before that, words that cannot lie in a run are set aside: in a run of period q, every word but the last
q recurs within q words, and these words make up a stretch of at least 3q. So stretches of words
that recur within a third of the stretch are cut out until nothing changes; plain prose leaves none.
Only these regions are sorted; extension runs over the whole text, so no region cuts a run.

All of it happens where a document stands: no shuffle, and memory for a slice of documents or a single
one if that is longer. Work is linear in the words but for sorting them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from perimetry.llm.text import blank_words

_SLICE_WORDS = 1 << 18
RUN = "struct<start:bigint,length:bigint,period:bigint>"


def lyndon_array(symbols: list[int]) -> list[int]:
    """Length of the longest Lyndon word that starts at each place: Baier's first phase.

    Groups of suffixes form a list in ascending order, each with the length of the word its members share.
    The highest group left is final. The nearest place before a member that is in a lower group has
    a word that ends where the member (or a chain of members) begins; it grows by the group's word once
    for each member that points to it, and so moves to a new group just above its old one.
    """
    n = len(symbols)
    result = [0] * n
    alphabet = sorted(set(symbols))
    number = {s: k for k, s in enumerate(alphabet)}
    # groups: members (possibly stale), word length, next lower group
    members: list[list[int]] = [[] for _ in alphabet]
    size = [1] * len(alphabet)
    lower = list(range(-1, len(alphabet) - 1))
    upper = list(range(1, len(alphabet) + 1))  # of the highest group: no group
    group = [number[s] for s in symbols]
    for place, g in enumerate(group):
        members[g].append(place)
    before = list(range(-1, n - 1))  # nearest unfinished place to the left, and to the right
    after = list(range(1, n + 1))
    pointed = [-1] * n
    current = len(alphabet) - 1
    while current >= 0:
        own, length = [p for p in members[current] if group[p] == current], size[current]
        members[current] = []
        own.sort()
        counts: dict[int, int] = {}
        for place in own:
            result[place] = length
            p = before[place]
            if p >= 0 and group[p] == current:
                p = pointed[p]
            pointed[place] = p
            if p >= 0:
                counts[p] = counts.get(p, 0) + 1
        for place in own:  # finished: out of the list
            a, b = before[place], after[place]
            if a >= 0:
                after[a] = b
            if b < n:
                before[b] = a
        moves: dict[int, dict[int, list[int]]] = {}
        for p, times in counts.items():
            moves.setdefault(group[p], {}).setdefault(times, []).append(p)
        for old, by_times in moves.items():
            below = old
            for times in sorted(by_times):  # those with more repeats stand higher
                new, above = len(members), upper[below]
                members.append(by_times[times])
                size.append(size[old] + times * length)
                lower.append(below)
                upper.append(above)
                upper[below] = new
                if above < new and lower[above] == below:
                    lower[above] = new
                for p in by_times[times]:
                    group[p] = new
                below = new
        current = lower[current]
    return result


def _common(x: np.ndarray, i: int, j: int, step: int) -> int:
    """How far ``x`` agrees from i and from j > i on, to the right (step 1) or to the left (-1)."""
    room, total, block = (len(x) - j if step > 0 else i + 1), 0, 32
    while total < room:
        n = min(block, room - total)
        if step > 0:
            differs = x[i + total : i + total + n] != x[j + total : j + total + n]
        else:
            differs = (x[i - total - n + 1 : i - total + 1] != x[j - total - n + 1 : j - total + 1])[::-1]
        if differs.any():
            return total + int(differs.argmax())
        total, block = total + n, 2 * block
    return total


def candidates(symbols: list[int], copies: int) -> set[tuple[int, int]]:
    """(place, length) of Lyndon roots, under either order, that stand ``copies`` times in a row by their lengths."""
    found = set()
    for ordered in (symbols, [-s for s in symbols]):
        length = np.array(lyndon_array(ordered), np.int64)
        at = np.arange(len(length))
        at = at[at + copies * length <= len(length)]
        own, place = length[at], at
        for _ in range(copies - 1):
            place = place + own
            same = length[place] == own
            at, own, place = at[same], own[same], place[same]
        found.update(zip(at.tolist(), own.tolist()))
    return found


def runs_in(x: np.ndarray, parts: list[tuple[int, int]], min_length: int, repeats: int) -> list[tuple[int, int, int]]:
    """(start, length, period) of all runs of at least ``min_length`` words and ``repeats`` periods, ordered, in the
    words ``x`` of one document; each lies within one of ``parts``."""
    roots = {(i + a, q) for a, b in parts for i, q in candidates(x[a:b].tolist(), max(1, repeats - 1))}
    found, upto = set(), {}
    for i, q in sorted(roots):
        if i + q < upto.get(q, 0):
            continue  # inside the last run of this period
        right, left = _common(x, i, i + q, 1), _common(x, i - 1, i + q - 1, -1) if i else 0
        start, length = i - left, left + q + right
        if length >= max(min_length, repeats * q):
            found.add((start, length, q))
            upto[q] = start + length
    return sorted(found, key=lambda r: (r[0], r[2]))


def regions(x: np.ndarray, doc: np.ndarray, ends: np.ndarray, min_length: int, repeats: int) -> list[tuple[int, int]]:
    """Stretches of words, not across documents, outside of which no run can lie."""
    least = min(max(min_length - q, (repeats - 1) * q) for q in range(1, min_length + 1))
    order = np.argsort(x, kind="stable")
    gap = np.full(len(x), len(x) + 1)  # to the next place of the word in its document
    again = (x[order[1:]] == x[order[:-1]]) & (doc[order[1:]] == doc[order[:-1]])
    gap[order[:-1][again]] = (order[1:] - order[:-1])[again]
    inside = gap <= len(x)
    for _ in range(32):  # fewer rounds only leave more to be sorted
        turns = np.flatnonzero(np.diff(np.concatenate([[False], inside, [False]]).astype(np.int8)))
        first, last = turns[::2], turns[1::2]
        size = last - first
        reach = np.where(size >= least, size // max(1, repeats - 1), 0)
        left = inside.copy()
        left[inside] = gap[inside] <= np.repeat(reach, size)
        if (left == inside).all():
            break
        inside = left
    return [(int(a), int(min(b + r, ends[doc[a]]))) for a, b, r in zip(first, last, reach) if r]


def _slice_runs(texts: list[list[bytes]], min_length: int, repeats: int) -> list[list[tuple[int, int, int]]]:
    """Runs of each text of a slice."""
    words = [w for t in texts for w in t]
    found: list[list] = [[] for _ in texts]
    if not words:
        return found
    sizes = [len(t) for t in texts]
    ends = np.cumsum(sizes)
    doc = np.repeat(np.arange(len(texts)), sizes)
    x = pa.array(words, pa.large_binary()).dictionary_encode().indices.to_numpy().astype(np.int64)
    parts: dict[int, list[tuple[int, int]]] = {}
    for a, b in regions(x, doc, ends, min_length, repeats):
        begin = int(ends[doc[a]]) - sizes[doc[a]]
        parts.setdefault(int(doc[a]), []).append((a - begin, b - begin))
    for d, own in parts.items():
        found[d] = runs_in(x[ends[d] - sizes[d] : ends[d]], own, min_length, repeats)
    return found


def _collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """The words that no run covers after its first period."""
    if not runs:
        return b" ".join(words)
    change = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        change[start + period] += 1
        change[start + length] -= 1
    return b" ".join([words[i] for i in np.flatnonzero(np.cumsum(change)[:-1] == 0)])


def _slices(texts: Iterator[bytes]) -> Iterator[list[list[bytes]]]:
    part, size = [], 0
    for text in texts:
        part.append(blank_words(text))
        size += len(part[-1])
        if size >= _SLICE_WORDS:
            yield part
            part, size = [], 0
    if part:
        yield part


def periodic_runs(
    docs: DataFrame, min_length: int = 6, repeats: int = 4, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(doc_id, n_words, runs, collapsed) of every row.

    ``runs`` are all maximal stretches with smallest period q of at least ``min_length`` words and
    ``repeats`` times q, by start and period; ``collapsed`` are the words that no run covers after its first
    q words, joined by one space. Null and empty texts have no words, no runs and an empty ``collapsed``.
    Repeated rows give repeated rows, rows without an id are treated like others, an empty table
    gives no rows; other columns are not read, so their names cannot clash. Long texts are handled whole.
    """
    if min_length < 2 or repeats < 2:
        raise ValueError("a run has at least two words and two periods")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))
        for batch in batches:
            at = 0
            for part in _slices(t.as_py() or b"" for t in batch.column(1)):
                found = _slice_runs(part, min_length, repeats)
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(at, len(part)), pa.array([len(w) for w in part], pa.int64()),
                    pa.array([[{"start": s, "length": n, "period": q} for s, n, q in r] for r in found], kind),
                    pa.array([_collapsed(w, r).decode("utf-8", "replace") for w, r in zip(part, found)], pa.string()),
                ], names=["doc_id", "n_words", "runs", "collapsed"])
                at += len(part)

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col), F.col(text_col).cast("binary").alias("text")).mapInArrow(
        run, f"doc_id {kind}, n_words bigint, runs array<{RUN}>, collapsed string")


def made_periodic(doc_id: Column, text: Column) -> Column:
    """``text`` with a periodic tail where the checksum of ``doc_id`` ends in 0: each word from a on becomes a word
    of the first p from there. Texts without words and rows without an id stay as they are."""
    checksum = F.crc32(doc_id.cast("string").cast("binary"))
    g = F.floor(checksum / 10)
    blanks = " \t\n\x0b\x0c\r"
    trimmed = F.btrim(text, F.lit(blanks))

    def repeated(words: Column) -> Column:
        n = F.size(words)
        a = F.pmod(g, n)
        p = F.floor((n - a) / (F.pmod(g, F.lit(8)) + 3)) + 1
        places = F.sequence(F.lit(0).cast("bigint"), (n - 1).cast("bigint"))
        return F.array_join(F.transform(places, lambda i: words[F.when(i < a, i).otherwise(a + F.pmod(i - a, p)).cast("int")]), " ")

    damaged = F.transform(F.array(F.split(trimmed, "[ \\t\\n\\x0B\\f\\r]+")), repeated)[0]
    return F.when((F.pmod(checksum, F.lit(10)) == 0) & (trimmed != ""), damaged).otherwise(text)


def digests(found: DataFrame) -> DataFrame:
    """Number of runs, the longest one (then the first, then of least period) and digests of all runs and kept words."""
    best = F.array_min(F.transform("runs", lambda r: F.struct(
        (-r["length"]).alias("less"), r["start"].alias("start"), r["period"].alias("period"))))
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    return found.withColumn("best", best).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), F.col("best.start").alias("start"),
        (-F.col("best.less")).alias("length"), F.col("best.period").alias("period"),
        F.expr("(-1000 * best.less) div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(F.transform(lines, lambda line: F.concat(line, F.lit("\n"))), "").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )
