"""Registered queries against SQL, the tokenizers library and brute force, on the smallest tables."""

import hashlib
import re

import numpy as np
import public_tokenizers
import pytest
import xxhash
from tokenizers import Tokenizer

import corpus_pipeline
from perimetry.llm import decontaminate, quality, queries
from tests.llm.conftest import SF

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lowered(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def sha(data):
    return hashlib.sha256(data if isinstance(data, bytes) else data.encode()).hexdigest()


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_sql(spark, duck, name):
    found = queries.QUERIES[name](spark, SF)
    asked = duck.execute(queries.ORACLES[name])
    columns = [c[0] for c in asked.description]
    assert sorted(found.columns) == sorted(columns)
    ours = sorted((tuple(r[c] for c in columns) for r in found.collect()), key=repr)
    assert ours == sorted(map(tuple, asked.fetchall()), key=repr)


def tokens_of(texts):
    library = Tokenizer.from_file(public_tokenizers.path(queries.TOKENIZER))
    for encoded in library.encode_batch([t or "" for t in texts], add_special_tokens=False):
        ids = np.array(encoded.ids, "<u4").tobytes()
        yield len(encoded.ids), sha(ids), sha(library.decode(encoded.ids, skip_special_tokens=False))


def test_tokens(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    expected = {r.doc_id: t for r, t in zip(docs, tokens_of([r.text for r in docs]))}
    found = {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in queries.op4_bpe(spark, SF).collect()}
    assert found == expected


def simhash_of(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", lowered(text))
    if not words:
        return 0
    grams = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components_of(prints):
    """Smallest id reachable by links of at most three bits, over (id, fingerprint) rows."""
    ids, fps = [i for i, _ in prints], [f for _, f in prints]
    root = dict(zip(ids, ids))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(fps):
        for j in range(i):
            if (a ^ fps[j]).bit_count() <= 3:
                x, y = find(ids[i]), find(ids[j])
                root[max(x, y)] = min(x, y)
    return {i: find(i) for i in ids}


def test_simhash(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    prints = sorted((r.doc_id, simhash_of(r.text)) for r in docs)
    expected = {i: (f"{f:016x}", c) for (i, f), c in zip(prints, components_of(prints).values())}
    assert {r.doc_id: (r.fingerprint, r.component_id) for r in queries.op10_simhash(spark, SF).collect()} == expected


def test_html(spark):
    import html as h

    for r in spark.read.parquet(f"{SF}/pages.parquet").join(queries.op5_html_text(spark, SF).drop("url"), "page_id").collect():
        inner = re.search(r"<article>(.*?)(</article>|$)", r.html, re.S)[1]
        parts = [re.sub(r"\s+", " ", h.unescape(re.sub(r"</?(?:b|br|i|a)\b[^>]*>", " ", x))).strip() for x in re.split(r"</?(?:p|h1)>", inner)]
        assert r.text == "\n".join(p for p in parts if p) and r.n_chars == len(r.text)


def test_quality_on_held_out_rows(spark):
    sf = SF.replace("0.001", "0.01")
    rows = queries.op9_quality(spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").collect()
    held = [r for r in rows if r.held_out]
    assert all(r.held_out == (__import__("zlib").crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in rows)
    assert sum(r.predicted == r.quality for r in held) >= 0.9 * len(held)
    scores = {q: [r.score for r in held if r.quality == q] for q in (0, 1)}
    assert np.median(scores[1]) > 0.9 and np.median(scores[0]) < 0.1


def contaminated(text, windows):
    words = WORD.findall(lowered(text))
    hit = set()
    for size in {len(w) for w in windows}:
        for i in range(len(words) - size + 1):
            if tuple(words[i : i + size]) in windows:
                hit.update(range(i, i + size))
    return bool(hit) and 20 * len(hit) >= len(words)


def test_pipeline_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    network = quality.train(docs, spark.read.parquet(f"{SF}/labels.parquet"))
    rows = {r.doc_id: r.text for r in docs.collect()}
    scores = network.score([t.encode() for t in rows.values()])
    rows = {i: t for (i, t), s in zip(rows.items(), scores) if s >= queries.ACCEPTED}
    key = lambda line: lowered(line.strip(" \t\n\x0b\x0c\r"))
    seen = {}
    for i, text in rows.items():
        for k in {key(line) for line in text.split("\n")} - {""}:
            seen.setdefault(k, set()).add(i)
    rows = {i: "\n".join(line for line in t.split("\n") if len(seen.get(key(line), ())) < 10) for i, t in rows.items()}
    root = components_of(sorted((i, simhash_of(t)) for i, t in rows.items()))
    rows = {i: t for i, t in rows.items() if root[i] == i}
    windows = set()
    for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect():
        words = WORD.findall(lowered(r.text))
        size = min(13, len(words))
        windows.update(tuple(words[s : s + size]) for s in range(len(words) - size + 1) if size)
    rows = {i: t for i, t in rows.items() if not contaminated(t, windows)}
    expected = dict(zip(rows, tokens_of(rows.values())))
    found = corpus_pipeline.run(spark, SF).collect()
    assert {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in found} == expected
    assert len(found) == len(expected) > 100


def test_benchmark_in_blocks_gives_the_same(spark):
    docs, items = (spark.read.parquet(f"{SF}/{n}.parquet") for n in ("documents", "benchmark"))
    once = decontaminate.contamination(docs, items)
    blocks = decontaminate.contamination(docs, items, block_words=300)
    assert sorted(once.collect(), key=repr) == sorted(blocks.collect(), key=repr)
