"""Nulls, empty and long texts, ties, repeated rows, empty tables and clashing names, per operator."""

import hashlib
import random
import re
import time
from collections import Counter

import duckdb
import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T
from tokenizers import Tokenizer

import corpus_pipeline
from perimetry.llm import (
    bpe, components, decontaminate, embeddings, html_blocks, licences, lines, quality, reputation, simhash, substrings,
)
from tests.llm.conftest import LONG

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
EMPTY = hashlib.sha256(b"").hexdigest()


def by_id(df, *columns):
    out = {}
    for r in df.collect():
        out.setdefault(r[0], []).append(tuple(r[c] for c in columns))
    return out


@pytest.fixture(scope="session")
def items(spark):
    rows = [(1, "a b c d e f g h i j k l m n", 1), (2, "one", 2), (2, "one", 2), (3, None, 3), (4, " . ", 4), (None, "mit license", 5), (5, "b c d", 6)]
    return spark.createDataFrame(rows, "item_id long, text string, spans int")


def test_decontamination(docs, no_docs, items):
    rows = by_id(decontaminate.judged(decontaminate.contamination(docs, items)), "n_words", "n_hit", "n_items", "contaminated")
    assert rows[0] == rows[1] == rows[2] == [(0, 0, 0, False)]
    assert rows[3] == [(1, 1, 1, True)] and rows[5] == [(2, 2, 0, True)]  # an item without id marks, but has no name
    assert rows[9] == [(16, 14, 2, True)] * 2 and rows[10] == [(16, 14, 2, True)]
    assert rows[6] == [(30_000, 0, 0, False)]
    assert sorted(rows[None]) == [(0, 0, 0, False), (1, 1, 1, True)]
    assert decontaminate.contamination(no_docs, items).count() == 0
    assert decontaminate.judged(decontaminate.contamination(docs, items.limit(0))).where("n_hit > 0 or contaminated").count() == 0
    kept = decontaminate.clean(docs, items)
    assert kept.columns == docs.columns
    assert not {3, 5, 9, 10} & {r.doc_id for r in kept.collect()} and kept.where("doc_id is null").count() == 1


def test_clean_rows_stay_beside_contaminated_ones(spark, items):
    docs = spark.createDataFrame([(1, "a b c d e f g h i j k l m n"), (1, "clean words"), (None, "clean words"), (None, "mit license"), (2, None)],
                                 "doc_id long, text string")
    assert sorted((r.doc_id or 0, r.text or "") for r in decontaminate.clean(docs, items).collect()) == [(0, "clean words"), (1, "clean words"), (2, "")]


def test_benchmark_blocks_hold_no_repeats(spark, monkeypatch):
    held, words = [], decontaminate.alnum_words
    monkeypatch.setattr(decontaminate, "alnum_words", lambda text: held.append(text) or words(text))
    items = spark.range(300).select(F.lit(1).alias("item_id"), F.lit("b c d").alias("text"))
    found = decontaminate.contamination(spark.createDataFrame([(1, "a b c d e")], "doc_id long, text string"), items, window=3)
    assert found.first()["spans"] == [1, 4] and held == [b"b c d"]


def test_licences(docs, no_docs):
    columns = ("n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score")
    rows = by_id(licences.labelled(licences.scan(docs)), *columns)
    assert rows[0] == rows[1] == [(0, 0, None, None, "", "", 0.0)]
    assert rows[5] == [(2, 1, 0, 0, "mit", "mit", 1.0)]
    assert rows[8] == [(6, 2, 1, 4, "apache,mit", "apache,mit", 1.0)]
    assert rows[6] == [(30_000, 0, None, None, "", "", 0.0)] and len(rows[9]) == 2
    assert licences.labelled(licences.scan(no_docs)).count() == 0


def test_licence_notices(spark):
    texts = [
        "Redistribution and use in source and binary forms, with or without modification, are permitted",
        "redistribution and use in source and binary forms",  # key phrase alone: too little of the notice
        "Licensed under CC BY-NC 4.0.", "(general) public. license! general public license", "mit licenses", "permit license",
    ]
    rows = by_id(licences.labelled(licences.scan(spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string"))), "base_labels", "labels", "n_base")
    assert rows == {0: [("", "bsd", 0)], 1: [("", "", 0)], 2: [("", "cc", 0)], 3: [("gpl", "gpl", 2)], 4: [("", "", 0)], 5: [("", "", 0)]}


def test_tokens(docs, no_docs):
    library = Tokenizer.from_file(TOKENIZER)
    rows = by_id(bpe.decode(bpe.encode(docs, TOKENIZER), TOKENIZER), "ids", "decoded")
    assert rows[0] == rows[1] == [(b"", "")]
    for i, text in ((6, LONG), (11, "ΣΑΣ é <|endoftext|> 日本 🙂 ½")):
        ids = library.encode(text, add_special_tokens=False).ids
        assert rows[i] == [(np.array(ids, "<u4").tobytes(), library.decode(ids, skip_special_tokens=False))]
    assert len(rows[9]) == 2 and bpe.encode(no_docs, TOKENIZER).count() == 0


def test_tokens_of_odd_texts():
    library, definition = Tokenizer.from_file(TOKENIZER), open(TOKENIZER, encoding="utf-8").read()
    coder, decoder = bpe.WordBpe(definition), bpe.Decoder(definition)
    parts = ["a", "b", "th", "ing", "Σ", "İ", "é", "e\u0301", "ß", "日本", "한", "'s", "'LL", "9", "½", "²", "_", " ", "\u00a0", "🙂", "ﬁ",
             "<|endoftext|>", "<|startoftext|", "\n", "...", "ā", "क", "ന്", "Ⅷ", "\u200d", "\x00", "\x85", "ꭰ", "x" * 50]
    rng = random.Random(5)
    texts = ["".join(rng.choices(parts, k=rng.randint(0, 12))) for _ in range(1500)]
    for text, ids in zip(texts, coder.encode(texts)):
        expected = library.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(ids, "<u4").tolist() == expected, text
        assert decoder.decode(ids) == library.decode(expected, skip_special_tokens=False)


def test_html_cases(spark):
    page = """<html><head><title>T</title></head><body class="post"><header>Site</header><nav><a href=x>Home</a></nav>
    <div class="cookie-notice">We use cookies to make all things better for everyone who reads this page.</div>
    <main><h1>Big &lt;title&gt;</h1><p>One two   three<script>if(a<b){x="</p>"}</script> four.<br>five<p>Short.
    <aside>Side words of some length are put here</aside><form><label>Name</label><button>Send</button></form>
    <ul><li>item one words<li>item two</ul><section class="post-comments"><p>A reader says many long things here.</p></section>
    <div class='ad'>Buy now</div></main><footer>&copy; x</footer>"""
    rows = [(1, "u", page), (2, None, None), (3, "u", ""), (3, "u", ""), (4, "u", "<p>" + "wort &amp; mehr " * 20_000), (5, "u", "<!-- x"), (None, "u", "<")]
    found = by_id(html_blocks.extract(spark.createDataFrame(rows, "page_id long, url string, html string")), "text", "n_chars")
    assert found[1][0][0] == "Big <title>\nOne two three four. five\nShort.\nitem one words\nitem two"
    assert found[2] == found[5] == [("", 0)] and found[3] == [("", 0)] * 2
    assert found[4][0][0] == ("wort & mehr " * 20_000).strip() and found[4][0][1] == len(found[4][0][0])
    plain = html_blocks.main_text(f"<div><a>Home</a></div><div>{'plain words of text. ' * 20}</div><div>{'and more of them. ' * 20}</div><div><a>Next</a></div>", html_blocks.trained())
    assert plain.startswith("plain") and "Home" not in plain and "Next" not in plain
    table = np.array(html_blocks.LABELLED)
    assert (html_blocks.trained().decide(table[:, :-1].astype(float)) == (table[:, -1] == 1)).mean() > 0.95


def test_html_without_semantic_tags_or_names():
    """Word counts and link density alone: nine tenths of the article's words stay, and little else comes."""
    plain = re.compile(r"<(/?)(?:article|main|nav|footer|aside|header|section)\b[^>]*>", re.I)
    named = re.compile(r"""\s(?:class|id|role)=(?:"[^"]*"|'[^']*'|[^\s>]+)""")
    tree, words, kept, extra = html_blocks.trained(), 0, 0, 0
    for (page,) in duckdb.sql("SELECT html FROM '/root/testdata/sf0.01/pages.parquet' WHERE html LIKE '%<article>%'").fetchall():
        article = html_blocks.main_text(re.search("<article>.*?</article>", page, re.S)[0], tree)
        bare = named.sub("", plain.sub(r"<\1div>", page))
        assert not any(b.article for b in html_blocks.blocks(bare))
        truth, found = Counter(article.split()), Counter(html_blocks.main_text(bare, tree).split())
        both = (truth & found).total()
        words, kept, extra = words + truth.total(), kept + both, extra + found.total() - both
    assert words > 50_000 and kept > 0.9 * words and extra < 0.05 * words


@pytest.mark.parametrize("page", ["<div>" * 30_000 + "x" + "</p></section>" * 30_000, "<form>" * 10_000 + "<article>words of text</article>"])
def test_html_time_grows_with_the_page(page):
    start = time.process_time()
    html_blocks.main_text(page, html_blocks.trained())
    assert time.process_time() - start < 10


def test_html_of_an_empty_table_and_clashing_columns(spark):
    rows = spark.createDataFrame([(1, "u", "<article><p>Some words.</p></article>", "mine", 7)], "page_id long, url string, html string, text string, n_chars long")
    assert html_blocks.extract(rows).collect() == [(1, "u", "Some words.", 11)]
    assert html_blocks.extract(rows.limit(0)).collect() == []


@pytest.mark.parametrize("inner, kept", [
    ("<svg class=x/>", ""), ("<svg viewBox='0 0 1 1' />", ""), ("<math/>", ""), ("<video src=x>", ""), ("<object data=x>", ""), ("<select>", ""),
    ("<svg><svg><text>no</text></svg><text>nor this</text></svg>", ""), ("<video><p>no player</p></video>", ""),
    ("<select><option>no</select>", ""), ("<template><p>no</p></template>", ""), ("<canvas>no</canvas>", ""),
    ("<math><mi>x</mi></math>", "x"), ("<object data=x>words instead</object>", "words instead"),
])
def test_html_embedded(inner, kept):
    page = f"<body><article><div><p>first words {inner} second words</p></div><p>third words</p></article></body>"
    assert html_blocks.main_text(page, html_blocks.trained()).split() == f"first words {kept} second words third words".split()


@pytest.mark.parametrize("wrapper", [
    "form id=aspnetForm", "div class='layout has-sidebar'", "div class=no-sidebar", "div id=search-results", "div class='content-with-sidebar'",
    "div class=page-widget", "section class='has-comments'",
])
@pytest.mark.parametrize("inner", ["article", "main", "div class=content"])
def test_html_wrappers(wrapper, inner):
    end = lambda start: f"</{start.split()[0]}>"
    text = "A sentence of the article with many plain words in it."
    side = "<div class=sidebar><article><p>A teaser of another article stands here.</p></article></div>"
    after = "<section class=comments><article class=comment><div class=content><p>A reader says many things here.</p></div></article></section>"
    for page in (f"<{wrapper}><{inner}><p>{text}</p><p>{text}</p></{inner.split()[0]}>{side}{end(wrapper)}",
                 f"<form><{wrapper}><{inner}><p>{text}</p><p>{text}</p>{after}</{inner.split()[0]}></form>{side}"):
        if inner.startswith("div") and "comments" in wrapper:
            continue  # nothing tells this from a list of comments
        assert html_blocks.main_text(f"<body><nav><a>Home</a></nav>{page}</body>", html_blocks.trained()) == f"{text}\n{text}"
    page = f"<body><article><p>{text}</p></article>{side}{after}<form><p>Name and address please.</p></form></body>"
    assert html_blocks.main_text(page, html_blocks.trained()) == text


def brute_repeats(rows, window):
    first = {}
    for i, words in rows:
        for s in range(len(words) - window + 1):
            k = tuple(words[s : s + window])
            first[k] = min(i, first.get(k, i))
    out = []
    for i, words in rows:
        gone = {p for s in range(len(words) - window + 1) if first[tuple(words[s : s + window])] < i for p in range(s, s + window)}
        out.append((i, len(words), len(gone), " ".join(w for p, w in enumerate(words) if p not in gone)))
    return sorted(out)


@pytest.mark.parametrize("window, period", [(50, 31), (9, 4), (5, 5), (3, 1)])
def test_repeats_against_brute_force(spark, window, period):
    rng = random.Random(window)
    passages = [[f"p{rng.randrange(40)}" for _ in range(rng.randint(window - 1, 3 * window))] for _ in range(6)]
    rows = []
    for i in range(60):
        words = []
        for _ in range(rng.randint(0, 4)):
            words += rng.choice(passages) if rng.random() < 0.6 else [f"w{rng.randrange(9999)}" for _ in range(rng.randint(0, 40))]
        rows.append((i, words + (["same"] * 70 if i % 9 == 0 else [])))
    docs = spark.createDataFrame([(i, " ".join(w)) for i, w in rows], "doc_id long, text string").repartition(5)
    found = substrings.remove_repeats(docs, window, period, keep_text=True, entries_per_bucket=50, bytes_per_group=1000)
    assert sorted(tuple(r[c] for c in ("doc_id", "n_words", "n_removed", "kept")) for r in found.collect()) == brute_repeats(rows, window)


def test_repeats_cases(docs, no_docs):
    rows = by_id(substrings.remove_repeats(docs), "n_words", "n_removed", "kept_sha256")
    assert rows[0] == rows[1] == rows[2] == [(0, 0, EMPTY)]
    assert rows[6][0][:2] == (30_000, 0)  # repeats within one document stay
    assert rows[7] == [(30_000, 30_000, EMPTY)] and len(rows[9]) == 2 and all(r[1] == 0 for r in rows[None])
    assert substrings.remove_repeats(no_docs).count() == 0


def test_repeats_without_id_are_spread(spark):
    docs = spark.range(120).select(F.lit(None).cast("long").alias("doc_id"), F.lit(LONG).alias("text")).repartition(2)
    found = substrings.remove_repeats(docs, bytes_per_group=1 << 20).select("n_words", "n_removed", F.spark_partition_id().alias("part"))
    rows = found.collect()
    assert len(rows) == 120 and {(r.n_words, r.n_removed) for r in rows} == {(30_000, 0)} and len({r.part for r in rows}) > 1


def test_a_hot_passage_does_not_fill_a_bucket(spark, monkeypatch):
    meet = substrings._meet

    def bounded(parts, windows):
        run = meet(parts, windows)

        def checked(table):
            entries = sum(len(d) for d in table["doc"].to_pylist()) // 4
            if entries > 400:
                raise ValueError(f"{entries} entries in one group")
            return run(table)

        return checked

    monkeypatch.setattr(substrings, "_meet", bounded)
    passage = " ".join(f"p{k}" for k in range(60))
    docs = spark.createDataFrame([(i, f"{passage} own{i}") for i in range(800)], "doc_id long, text string").repartition(2)
    rows = by_id(substrings.remove_repeats(docs, entries_per_bucket=100, bytes_per_group=2000), "n_words", "n_removed")
    assert rows.pop(0) == [(61, 0)] and len(rows) == 799 and all(r == [(61, 60)] for r in rows.values())


def test_covers():
    for period in range(1, 40):
        cover = substrings.difference_cover(period)
        assert {(a - b) % period for a in cover for b in cover} == set(range(period))


def test_lines(docs, no_docs):
    found = lines.drop_frequent_lines(docs)
    assert found.columns == [c for c in docs.columns if c not in ("kept", "n_lines")] + ["kept", "n_lines", "n_dropped"]
    rows = by_id(found.select("doc_id", "n_lines", "n_dropped", "kept"), "n_lines", "n_dropped", "kept")
    assert rows[0] == rows[1] == [(1, 0, "")] and rows[13] == [(4, 2, "own line 1\n")] and rows[12] == [(4, 2, "own line 0\n")] * 2
    assert rows[2] == [(2, 0, " \n\t ")] and len(rows[None]) == 2
    assert lines.drop_frequent_lines(no_docs).count() == 0
    assert lines.drop_frequent_lines(docs, min_docs=13).where("n_dropped > 0").count() == 0  # a repeated row counts once
    for batches, fanout in ((1, 2), (7, 3)):
        again = lines.drop_frequent_lines(docs, batches=batches, fanout=fanout).select("doc_id", "n_lines", "n_dropped", "kept")
        assert by_id(again, "n_lines", "n_dropped", "kept").keys() == rows.keys()
        assert sorted(again.collect(), key=repr) == sorted(found.select(again.columns).collect(), key=repr)


def test_embeddings(spark):
    rng = np.random.default_rng(3)
    base = rng.normal(size=(12, 16))
    rows = [(i, (base[i % 12] + rng.normal(size=16) * 0.05 * (i % 5)).tolist(), i % 2 if i % 12 else 0) for i in range(150)]
    rows += [(200, rows[0][1], 0), (201, rows[0][1], 0), (202, rows[0][1], 1), (203, [2 * x for x in rows[0][1]], 0)]
    odd = [(300, None, 0), (301, [0.0] * 16, 0), (302, [None] * 16, 0), (303, [float("nan")] * 16, 0), (304, [float("inf")] * 16, 0),
           (305, rows[0][1], None), (306, [], 0), (307, rows[0][1][:8], 0), (None, rows[0][1], 0)]
    table = spark.createDataFrame(rows + odd, "vec_id long, embedding array<double>, label int").withColumn("block", F.lit("x"))
    unit = {i: np.array(v) / np.linalg.norm(v) for i, v, _ in rows}
    label = {i: x for i, _, x in rows}
    near = {i: {j for j in unit if j != i and label[i] == label[j] and unit[i] @ unit[j] >= 0.98} for i in unit}
    root = {i: i for i in unit}
    for _ in unit:
        root = {i: min([root[i], *(root[j] for j in near[i])]) for i in unit}
    for block in (512, 4):
        found = by_id(embeddings.near_duplicates(table, block=block), "n_links", "component_id", "kept")
        assert {i: found[i] for i in unit} == {i: [(len(near[i]), root[i], root[i] == i)] for i in unit}
        assert all(found[i] == [(0, i, True)] for i, _, _ in odd)
    assert embeddings.near_duplicates(table.limit(0)).count() == 0


def test_simhash(docs, no_docs):
    rows = by_id(simhash.simhash_components(docs), "fingerprint", "component_id")
    assert rows[0] == rows[1] == rows[2] == [("0" * 16, 0)] and rows[7][0][1] == 6 and rows[10][0][1] == 9
    assert len(rows[9]) == 2 and {c for _, c in rows[None]} == {0, 3}
    kept = simhash.keep_one(docs)
    ids = [r.doc_id for r in kept.collect()]
    assert kept.columns == docs.columns and 7 not in ids and 10 not in ids and None not in ids and ids.count(9) == 2
    assert simhash.keep_one(no_docs).count() == 0


def test_simhash_keeps_one_of_each_group(spark):
    texts = [" ".join(f"{start}{k}" for k in range(40)) for start in "abcde"]
    rows = [(1, texts[0]), (2, texts[0]), (None, texts[0]),  # the copies of 1 go, with and without id
            (None, texts[1]), (None, texts[1]),  # no id at all: one row
            (None, texts[2]),
            (3, texts[3]), (4, texts[3]), (4, texts[4]), (4, texts[4])]  # 4 is a copy of 3, and a document of its own
    for parts in (1, 4):
        docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(parts)
        found = sorted(((r.doc_id or 0, r.text) for r in simhash.keep_one(docs).collect()))
        assert found == sorted([(1, texts[0]), (0, texts[1]), (0, texts[2]), (3, texts[3]), (4, texts[4]), (4, texts[4])])


@pytest.mark.parametrize("radius, limit", [(3, 4096), (3, 8), (1, 8), (4, 16), (0, 4)])
def test_simhash_buckets(spark, radius, limit):
    rng = np.random.default_rng(radius)
    base = rng.integers(0, 2**63, 30, dtype=np.uint64)
    flips = lambda: np.uint64(sum(1 << int(b) for b in rng.choice(20, rng.integers(0, 6), replace=False)))
    fps = np.unique([b ^ flips() for b in base for _ in range(8)])
    edges = simhash.near_edges(spark.createDataFrame([(int(f),) for f in fps.view(np.int64)], "fp long"), radius, limit)
    found = {r.node: r.component for r in components.connected_components(edges).collect()}
    signed = fps.view(np.int64).tolist()
    root = dict(zip(signed, signed))
    near = np.bitwise_count(fps[:, None] ^ fps[None, :]) <= radius
    for _ in signed:
        root = {f: min(root[signed[j]] for j in np.flatnonzero(near[i])) for i, f in enumerate(signed)}
    assert {f: found.get(f, f) for f in signed} == root


def test_components(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, j) for j in range(101, 160)] + [(7, 7), (200, 201), (201, 200), (200, 201), (None, 3)]
    found = {r.node: r.component for r in components.connected_components(spark.createDataFrame(edges, "x long, y long")).collect()}
    assert found == {**{i: 0 for i in range(41)}, **{i: 100 for i in range(100, 160)}, 200: 200, 201: 200}


def test_quality(spark, docs, no_docs):
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(24)] + [(None, 1, 0), (3, None, 0)], "doc_id long, quality int, toxic int")
    network = quality.train(docs, labels)
    rows = by_id(quality.scored(docs, network), "score")
    assert len(rows) == 25 and rows[6] == rows[7] and rows[9] == rows[10] * 2 and rows[0] == rows[1]
    assert quality.scored(no_docs, network).count() == 0
    assert by_id(quality.scored(docs, quality.train(docs, labels.limit(0))), "score")[6] == [(0.5,)]
    kept = quality.accepted(docs, network, 0.0)
    assert kept.columns == docs.columns and kept.count() == docs.count() and quality.accepted(docs, network, 1.1).count() == 0


@pytest.mark.parametrize("per_class", [3000, 200])
def test_quality_does_not_move_with_the_sample(spark, per_class):
    docs = spark.range(2000).select(F.col("id").alias("doc_id"), F.lit("the same words in every text").alias("text"))
    labels = docs.select("doc_id", (F.col("doc_id") % 5 > 0).cast("int").alias("quality"))  # four in five are good
    score = quality.train(docs, labels, per_class).score([b"the same words in every text"])[0]
    assert 0.7 < score < 0.9


def test_quality_takes_one_text_of_each_id(spark):
    docs = spark.range(300).select(F.greatest(F.col("id") - 250, F.lit(1)).alias("doc_id"), F.concat(F.lit("text "), "id").alias("text"))
    labels = spark.range(1, 50).select(F.col("id").alias("doc_id"), (F.col("id") % 2).cast("int").alias("quality"))
    learned = labels.where(~quality.held_out())
    rows, _ = quality.training_rows(docs.repartition(3), labels.union(labels), per_class=30)
    assert len(rows) == learned.count() and rows == quality.training_rows(docs.repartition(5), labels, per_class=30)[0]


def test_quality_reads_the_whole_text():
    rng = np.random.default_rng(0)
    word = lambda: bytes(rng.integers(97, 123, 5).tolist())
    rows = [([c for c in quality.sampled_chunks(b" ".join([word() for _ in range(300)] + [b"%%%%"] * (40 * (i % 2))))], 1 - i % 2) for i in range(600)]
    network = quality.fit(rows)
    start = b" ".join(word() for _ in range(20_000))
    good, bad = network.score([start, start + b" %%%%" * 20_000])
    assert good > 0.5 > bad
    together = network.score([b"", b"x", start])
    assert np.allclose(together, [network.score([t])[0] for t in (b"", b"x", start)])


def test_urls(spark):
    urls = ["http://A.Example.net/en/1", "http://a.example.net/fr/2", "http://a.example.net", "x://b.example.com/de/9?q#f", "https://c.org/fr/", "http://corg/fr/",
            None, "no scheme", "http://", "http://d.info/1", "http://d.info/1", "http://u@h.example.org:80/p?x://y/"]
    pages = spark.createDataFrame(list(enumerate(urls)) + [(None, urls[0])], "page_id long, url string").withColumn("host", F.lit(1))
    outcomes = spark.createDataFrame([("d.info", 0)] * 60 + [("u@h.example.org:80", 1)] * 9 + [("", 1), ("e.info", None)], "host string, good int")
    rows = by_id(reputation.judged(pages, outcomes), "host", "path", "rule", "verdict")
    assert rows[0] == [("a.example.net", "/en/1", "example.net/en/", "allow")] == rows[None]
    assert rows[1] == [("a.example.net", "/fr/2", "net/", "block")] and rows[2][0][:3] == ("a.example.net", "", None)
    assert rows[3] == [("b.example.com", "/de/9", "example.com/de/", "block")] and rows[4][0][2:] == ("org/fr/", "allow")
    assert rows[5][0][2] is None and rows[6][0][:3] == rows[7][0][:3] == rows[8][0][:3] == ("", "", None)
    assert rows[9] == rows[10] == [("d.info", "/1", None, "block")] and rows[11][0][:2] == ("u@h.example.org:80", "/p")
    assert reputation.judged(pages, outcomes.limit(0)).count() == 13 and reputation.judged(pages.limit(0), outcomes).count() == 0


def test_reputation_shrinks(spark):
    rows = [("a.x.com", 1)] * 2 + [("b.x.com", 1)] * 300 + [("c.y.com", 0)] * 300 + [("d.y.com", 1)] * 2 + [("e.z.org", 1)] * 50
    outcomes = spark.createDataFrame(rows, "host string, good int")
    hosts = spark.createDataFrame([(h,) for h in ("a.x.com", "b.x.com", "c.y.com", "d.y.com", "new.x.com", "new.y.com", "f.z.org")], "host string")
    r = {x.host: x for x in reputation.reputations(hosts, outcomes).collect()}
    assert r["b.x.com"].bound > 0.9 and r["c.y.com"].mean < 0.1
    assert r["a.x.com"].mean > r["d.y.com"].mean  # few outcomes lean on the domain
    assert r["new.x.com"].mean > r["new.y.com"].mean and r["new.x.com"].n == 0
    assert r["a.x.com"].bound < r["a.x.com"].mean


def test_pipeline_stages(spark, docs, no_docs, tmp_path):
    spark.createDataFrame([(i, i % 2, 0) for i in range(24)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, "a b c d e f g h i j k l m n")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        for table in (docs, no_docs):
            found = stage(spark, table, str(tmp_path))
            assert found.columns == list(corpus_pipeline.COLUMNS)
            assert [f.dataType for f in found.schema] == [T.LongType(), T.StringType(), T.StringType(), T.StringType(), T.LongType()]
            assert found.count() <= table.count()
    assert corpus_pipeline.token_stage(spark, docs, str(tmp_path)).count() == docs.count()


def test_vectors_that_repeat_an_id(spark):
    """Two vectors under one id, and copies of them under others: each row is judged by its own vector."""
    x, y = [1.0, 0.0, 0.0], [0.0, 1.0, 0.0]
    rows = [(1, "a", x), (1, "a", y), (2, "a", x), (3, "a", y), (4, "a", [0.0, 0.0, 1.0])]
    table = spark.createDataFrame(rows, "vec_id long, label string, embedding array<double>").repartition(3)
    found = by_id(embeddings.near_duplicates(table), "n_links", "component_id", "kept")
    assert found == {1: [(1, 1, True)] * 2, 2: [(1, 1, False)], 3: [(1, 1, False)], 4: [(0, 4, True)]}


def test_filters_against_a_plain_convolution():
    rng = np.random.default_rng(5)
    network = quality.Network(
        rng.normal(size=(quality.WIDTH, 256, quality.FILTERS)).astype(np.float32), rng.normal(size=quality.FILTERS).astype(np.float32),
        *(rng.normal(size=s) for s in ((2 * quality.FILTERS, quality.HIDDEN), quality.HIDDEN, quality.HIDDEN)), 0.1)
    texts = [bytes(rng.integers(0, 256, n, dtype=np.uint8)) for n in (0, 1, 5, 63, 64, 65, 448, 512, 513, 1500, 40_000)]
    for text, pooled in zip(texts, network.pooled(texts)):
        data = text + bytes(quality.WIDTH)
        response = np.array([
            sum(network.filters[o][data[at + o]] for o in range(quality.WIDTH)) for at in range(max(1, len(text)))])
        step, size = quality._STEP * quality._BLOCK, quality._CHUNK * quality._BLOCK
        starts = range(0, max(1, -(-len(response) // quality._BLOCK) - 1) * quality._BLOCK, step)
        plain = np.array([np.maximum(response[s : s + size].max(axis=0) + network.bias, 0) for s in starts])
        assert pooled.shape == plain.shape and np.allclose(pooled, plain, atol=1e-4)


def test_labels_without_documents_take_no_place_in_the_sample(spark):
    docs = spark.createDataFrame([(i, f"text {i}") for i in range(40)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(4000)], "doc_id long, quality int")
    rows, weights = quality.training_rows(docs, labels, per_class=10, chunks=1)
    assert len(rows) == 20 and all(len(chunks) == 1 for chunks, _ in rows)
    assert sum(weights.values()) * 10 == pytest.approx(sum(__import__("zlib").crc32(str(i).encode()) % 5 != 0 for i in range(40)), abs=1)
