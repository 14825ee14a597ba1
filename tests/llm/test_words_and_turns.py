"""Byte-level BPE, periodic runs and conversation repair against libraries and brute force."""

import hashlib
import pickle
import random
import zlib
from functools import lru_cache

import public_tokenizers
import pyarrow as pa
import pytest
import regex
import tiktoken
from pyspark.sql import functions as F
from pyspark.sql import types as T

from perimetry.llm import byte_bpe, conversations, queries, runs
from tests.llm.conftest import SF

RANKS = public_tokenizers.path(queries.RANKS)


def sha(data):
    return hashlib.sha256(data if isinstance(data, bytes) else data.encode()).hexdigest()


@pytest.fixture(scope="module")
def library():
    return tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=byte_bpe.Vocabulary(RANKS).ranks, special_tokens={})


# byte-level BPE


def test_words_are_split_like_the_pattern():
    rng = random.Random(1)
    parts = ["'", "s", "t", "re", "ve", "ll", "d", "m", "S", " ", "  ", "\n", "\t", " ", "é", "1", "½", "!", "日", "\r\n", "🙂", "'s", "x'"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randrange(25))) for _ in range(5000)]
    words, ends = byte_bpe.split([t.encode() for t in texts])
    words, at = [w.decode() for w in words.to_pylist()], 0
    pattern = regex.compile(public_tokenizers.PATTERN)
    for text, end in zip(texts, ends):
        assert words[at:end] == pattern.findall(text)
        at = end


def test_classes_are_those_of_the_library():
    """Two bytes merge only inside a word, so ids tell the class of the character after a known one."""
    table = byte_bpe._classes()
    points = [c for c in range(0x80, 0x110000) if not 0xD800 <= c < 0xE000]
    for head, kind in (("a", 1), ("1", 2), ("!", 0)):
        ranks = {bytes([b]): b for b in range(256)} | {head.encode() + bytes([b]): 128 + b for b in range(0x80, 0x100)}
        coder = tiktoken.Encoding("x", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        ids = coder.encode_ordinary("".join("\n" + head + chr(c) for c in points))
        merged = [i >= 256 for i in ids if i >= 256 or i == ord(head)]
        assert merged == (table[points] == kind).tolist()


def test_bytes_of_every_kind(spark, library, docs):
    rng = random.Random(2)
    odd = ["", " ", "\n", "a" * 700, "ab" * 300, "don't we'll I'm", "<|endoftext|>", "日本語 текст ½²", "🙂🙃" * 9, "\x00\x01", "x" + "́"]
    odd += ["".join(chr(rng.choice([rng.randrange(32, 127), rng.randrange(160, 0x2000), rng.randrange(0x4E00, 0x9000)])) for _ in range(60)) for _ in range(40)]
    frame = spark.createDataFrame([(i, t) for i, t in enumerate([None, *odd, *odd])], "doc_id long, text string").repartition(3)
    for table, small in ((frame, 1 << 20), (frame, 5), (docs, 1 << 20)):
        found = byte_bpe.decode(byte_bpe.encode(table, RANKS, dictionary_words=small), RANKS)
        got = sorted(((r.doc_id, list(r.ids), bytes(r.decoded)) for r in found.collect()), key=repr)
        expected = [(r.doc_id, library.encode_ordinary(r.text or ""), (r.text or "").encode()) for r in table.collect()]
        assert got == sorted(expected, key=repr)


def test_no_texts(spark, no_docs):
    assert byte_bpe.digests(byte_bpe.decode(byte_bpe.encode(no_docs, RANKS), RANKS)).collect() == []
    assert runs.digests(runs.periodic_runs(no_docs)).collect() == []


def test_byte_bpe_query(spark, library):
    found = {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in queries.op11_byte_bpe(spark, SF).collect()}
    expected = {}
    for r in spark.read.parquet(f"{SF}/documents.parquet").collect():
        ids = library.encode_ordinary(r.text or "")
        expected[r.doc_id] = (len(ids), sha(" ".join(map(str, ids))), sha(r.text or ""))
    assert found == expected


def test_merges_run_in_higher_order_functions(spark):
    frame = spark.createDataFrame([(1, "some words")], "doc_id long, text string")
    plan = byte_bpe.encode(frame, RANKS)._jdf.queryExecution().optimizedPlan()
    text = plan.expressions().toString() if plan.expressions().size() else plan.toString()
    assert "aggregate(" in text


# periodic runs


def lyndon(x):
    def is_lyndon(w):
        return all(w < w[k:] for k in range(1, len(w)))

    return [max(j - i for j in range(i + 1, len(x) + 1) if is_lyndon(x[i:j])) for i in range(len(x))]


def all_runs(x, least, repeats):
    found = set()
    for q in range(1, len(x)):
        i = 0
        while i + q < len(x):
            j = i
            while j + q < len(x) and x[j] == x[j + q]:
                j += 1
            length = j + q - i
            if j > i and length >= max(least, repeats * q):
                if not any(x[i : i + length - d] == x[i + d : i + length] for d in range(1, q)):
                    found.add((i, length, q))
            i = max(j, i + 1)
    return sorted(found, key=lambda r: (r[0], r[2]))


def test_lyndon_array():
    rng = random.Random(3)
    for _ in range(600):
        x = [rng.randrange(rng.choice([1, 2, 3])) for _ in range(rng.randrange(1, 16))]
        assert runs.lyndon_array(x) == lyndon(x)


@pytest.mark.parametrize("least,repeats", [(6, 4), (2, 2), (4, 2), (3, 3)])
def test_runs_against_brute_force(least, repeats):
    rng = random.Random(least + repeats)
    for _ in range(500):
        k, texts = rng.choice([1, 2, 2, 3, 9]), []
        for _ in range(rng.randrange(1, 4)):
            x = [rng.randrange(k) for _ in range(rng.randrange(20))]
            for _ in range(rng.randrange(3)):
                unit = [rng.randrange(k) for _ in range(rng.randrange(1, 5))]
                x += unit * rng.randrange(1, 7) + unit[: rng.randrange(len(unit) + 1)] + [rng.randrange(k)]
            texts.append(x)
        found = runs._slice_runs([[b"%d" % w for w in x] for x in texts], least, repeats)
        assert found == [all_runs(x, least, repeats) for x in texts]


def test_long_runs():
    unit = [b"a", b"b", b"a", b"c"]
    words = [b"x"] + unit * 30_000 + [b"y"]
    assert runs._slice_runs([words], 6, 4) == [[(1, 120_000, 4)]]


def made_periodic(doc_id, words):
    h = zlib.crc32(str(doc_id).encode())
    if doc_id is None or h % 10 or not words:
        return words
    g, n = h // 10, len(words)
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]


def test_periodic_runs_query(spark, docs):
    def check(rows, found):
        expected = []
        for doc_id, text in rows:
            words = made_periodic(doc_id, [w.decode() for w in (text or "").encode().split()])
            own = all_runs(words, 6, 4) if len(words) < 1500 else runs._slice_runs([[w.encode() for w in words]], 6, 4)[0]
            best = min(own, key=lambda r: (-r[1], r[0], r[2])) if own else None
            gone = {i for s, n, q in own for i in range(s + q, s + n)}
            expected.append((
                doc_id, len(own), *((*best, 1000 * best[1] // best[2]) if best else [None] * 4),
                sha("".join(f"{s},{n},{q}\n" for s, n, q in own)), sha(" ".join(w for i, w in enumerate(words) if i not in gone))))
        names = ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
        assert sorted((tuple(r[n] for n in names) for r in found.collect()), key=repr) == sorted(expected, key=repr)

    table = spark.read.parquet(f"{SF}/documents.parquet")
    check([(r.doc_id, r.text) for r in table.collect()], queries.op12_periodic_runs(spark, SF))
    made = docs.withColumn("text", runs.made_periodic(F.col("doc_id"), F.col("text")))
    check([(r.doc_id, r.text) for r in docs.collect()], runs.digests(runs.periodic_runs(made)))


# conversations


def cheapest(turns):
    """(cost, audit) of (initial, delete, truncated) turns, by recursion from the left."""
    after = {"s": 1, "u": 2, "a": 3}
    steps = {0: "su", 1: "u", 2: "a", 3: "u"}

    @lru_cache(maxsize=None)
    def best(i, state, inserted):
        options = [(0, "")] if i == len(turns) and state in (0, 3) else []
        if inserted < 2:
            for c in steps[state]:
                if c != "s":
                    options.append(plus(5, "I", best(i, after[c], inserted + 1)))
        if i < len(turns):
            initial, delete, truncated = turns[i]
            options.append(plus(2, "D", best(i + 1, state, 0)))
            if not delete:
                for c in steps[state]:
                    if c == initial:
                        options.append(plus(5 * truncated, "K", best(i + 1, after[c], 0)))
                    if c != "s":
                        options.append(plus(1 + 5 * truncated, "R", best(i + 1, after[c], 0)))
        return min((o for o in options if o), default=None)

    def plus(cost, edit, rest):
        return rest and (cost + rest[0], edit + rest[1])

    return best(0, 0, 0)


def repaired(rows):
    """(gaps, blank, duplicate, truncated, illegal, cost, audit, digest) of (turn, role, text) rows in order."""
    seen, faults = set(), []
    for _, role, text in rows:
        body = text.strip(" \t\n\x0b\x0c\r")
        faults.append("blank" if not body else "duplicate" if (role, text) in seen else "" if body[-1] in ".!?" else "truncated")
        seen.add((role, text))
    initials = [r[:1] for _, r, _ in rows]
    cost, audit = cheapest(tuple((i, f in ("blank", "duplicate"), f == "truncated") for i, f in zip(initials, faults)))
    known = [t for t, _, _ in rows if t is not None]
    gaps = max(known) - min(known) + 1 - len(set(known)) if known else 0
    lines, left, state = [], list(rows), "start"
    for edit in audit:
        _, role, text = (None, "", "") if edit == "I" else left.pop(0)
        if edit in "IR":
            role = "assistant" if state == "u" else "user"
        if edit != "D":
            lines.append(f"{role}:{text}")
            state = role[0]
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
    return gaps, *(faults.count(f) for f in ("blank", "duplicate", "truncated")), illegal, cost, audit, sha("\n".join(lines))


def damaged(conv, turn, role, text):
    role, text = " " if role is None else role, " " if text is None else text
    rule = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
    text = "" if rule == 1 else text.translate(str.maketrans("", "", ".!?")) if rule == 2 else text
    return [(turn, "user" if rule == 4 else role, text)] * {0: 0, 3: 2}.get(rule, 1)


def expected_reports(rows):
    found = {}
    for conv, turn, role, text in rows:
        found.setdefault(conv, []).extend(damaged(conv, turn, role, text))
    order = lambda r: (r[0] is not None, r[0] or 0)
    nothing = (0, 0, 0, 0, 0, 0, "", sha(""))
    return {c: repaired(sorted(t, key=order)) if t else nothing for c, t in found.items()}


NAMES = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
TURNS = T.StructType([
    T.StructField("conv_id", T.LongType()), T.StructField("turn", T.LongType()), T.StructField("role", T.StringType()),
    T.StructField("text", T.StringType()), *[T.StructField(n, T.StringType()) for n in ("h1", "part", "fault", "turns", "cost")],
])


def made_turns():
    rng = random.Random(5)
    rows = []
    for conv in [None, *range(60)]:
        turns = list(range(rng.randrange(1, 14)))
        if rng.random() < 0.2:
            turns[0] = None
        for t in turns:
            role = rng.choice(["user", "assistant", "user", "assistant", "system", "tool", None, "", "umpire", "Ü"])
            text = rng.choice([f"Text {rng.randrange(6)}.", f"Open {rng.randrange(6)}", "Why?  \n", " \t", "", None])
            rows.append((conv, t, role, text, *["x"] * 5))
    return rows


@pytest.mark.parametrize("partitions", ["1", "3", "40"])
def test_conversations_against_brute_force(spark, partitions):
    """However many partitions a conversation lies in."""
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        frame = spark.createDataFrame(made_turns(), TURNS)
        found = conversations.report(conversations.damaged(frame), frame).collect()
        borders = conversations.stretches(conversations.damaged(frame)).groupBy("conv_id").count().where("count > 1").count()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert {r.conv_id: tuple(r[n] for n in NAMES) for r in found} == expected_reports([r[:4] for r in made_turns()])
    assert borders > 5 or partitions != "40"


def test_cells_do_not_depend_on_the_split():
    rng = random.Random(6)
    for _ in range(300):
        turns = [(rng.choice("sua") if rng.random() < 0.9 else "", rng.random() < 0.2, rng.random() < 0.2) for _ in range(rng.randrange(12))]
        parse = conversations.Parse()
        for t in turns:
            parse.add(conversations.turn_cell(*t))
        assert conversations.best_of(parse.whole()) == cheapest(tuple(turns))
        cell = conversations.empty()
        for t in turns:
            cell = conversations.combined(cell, conversations.turn_cell(*t))
        assert cell == parse.whole()


def test_one_conversation_of_all_rows(spark):
    rows = [(7, t, "user" if t % 2 == 0 else "assistant", f"Text {t}.") for t in range(3000)]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(5)
    [found] = conversations.report(frame, frame).collect()
    lines = "\n".join(f"{r}:{t}" for _, _, r, t in rows)
    assert tuple(found[n] for n in NAMES) == (0, 0, 0, 0, 0, 0, "K" * 3000, sha(lines))


def test_ties_and_repeated_rows(spark):
    rows = [(1, 0, "user", "Same."), (1, 0, "user", "Same."), (1, 0, "assistant", "Other."), (1, 1, "assistant", "Other.")]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    [found] = conversations.report(frame, frame).collect()
    # by turn, then role: assistant, user, user, assistant; the last two repeat the first two
    assert (found.duplicate, found.cost, found.audit) == (2, 6, "RRDD")


def test_no_conversations(spark):
    frame = spark.createDataFrame([], TURNS)
    assert conversations.report(conversations.damaged(frame), frame).collect() == []


def test_conversation_query(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    found = queries.op13_conversation_repair(spark, SF).collect()
    assert {r.conv_id: tuple(r[n] for n in NAMES) for r in found} == expected_reports(rows)


def test_lists_are_cut_where_told():
    assert byte_bpe._lists(byte_bpe.np.array([0, 1, 1, 3]), pa.array([5, 6, 7])).to_pylist() == [[5], [], [6, 7]]


def test_tokens_are_decoded_and_hashed_by_slices_not_step_by_step(spark, monkeypatch):
    monkeypatch.setattr(byte_bpe, "_SLICE_TOKENS", 3)
    frame = spark.createDataFrame([(1, [72, 0, 5]), (2, []), (3, None), (4, [1] * 9)], "doc_id long, ids array<int>")
    decoded = byte_bpe.decode(frame, RANKS)
    found = byte_bpe.digests(decoded)
    tokens = byte_bpe.Vocabulary(RANKS).tokens
    rows = {r.doc_id: bytes(r.decoded) if r.decoded is not None else None for r in decoded.collect()}
    assert rows == {1: tokens[72] + tokens[0] + tokens[5], 2: b"", 3: None, 4: tokens[1] * 9}
    sums = {r.doc_id: r.ids_sha256 for r in found.collect()}
    assert sums == {1: sha("72 0 5"), 2: sha(""), 3: None, 4: sha(" ".join("1" * 9))}
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "lambda" not in plan and "array_join" not in plan


def test_a_word_is_folded_once(spark):
    """The plan names the fold of a word in one place: named in two, it is run twice."""
    vocabulary = byte_bpe.Vocabulary(RANKS)
    pairs = byte_bpe.PairTable(len(vocabulary.tokens), vocabulary.pairs())
    words = [b"x", b"ab", b" folded", "ñandú".encode(), b"ab" * 40]
    frame = spark.createDataFrame([(s,) for s in byte_bpe.Spelling(vocabulary).spell(words).to_pylist()], "spelled array<bigint>")
    folded = frame.select(byte_bpe.fold(F.col("spelled"), pairs).alias("ids"))
    text = folded._jdf.queryExecution().analyzed().toString()
    assert text.count("aggregate(") == 1
    found = sorted(b"".join(vocabulary.tokens[i] for i in r.ids) for r in folded.collect())
    assert found == sorted(words)


def test_words_of_texts_that_are_split_in_parts(monkeypatch):
    texts = [b"don't", b"", b" a b", b"c " * 9, b"", "é 1".encode()]
    whole, ends = byte_bpe.split(texts)
    monkeypatch.setattr(byte_bpe, "_SPLIT_BYTES", 4)
    parts, upto = byte_bpe.split(texts)
    assert parts.to_pylist() == whole.to_pylist() and upto.tolist() == ends.tolist()
    assert len(byte_bpe.split([])[0]) == 0


def test_ids_are_hashed_where_they_are_decoded(spark):
    frame = spark.createDataFrame([(1, [72, 0, 5]), (2, []), (3, None), (None, [1] * 9)], "doc_id long, ids array<int>")
    apart = byte_bpe.digests(byte_bpe.decode(frame, RANKS))
    together = byte_bpe.digests(byte_bpe.decode(frame, RANKS, hashed=True))
    assert together.columns == apart.columns and sorted(together.collect(), key=repr) == sorted(apart.collect(), key=repr)
    assert together._jdf.queryExecution().optimizedPlan().toString().count("MapInArrow") == 1


def test_known_words_are_told_from_others_with_their_hash(monkeypatch):
    vocabulary = byte_bpe.Vocabulary(RANKS)
    words = [b" wordone", b" wordtwo", b" wordthree"]
    table = pa.table({"word": pa.array(words, pa.binary()), "ids": pa.array([[1], [2, 3], [4]], pa.list_(pa.int32()))})
    asked = pa.array([b" wordtwo", b"zz unknown", b"", vocabulary.tokens[300], b" wordtwo"], pa.large_binary())
    known = len(vocabulary.tokens)
    assert byte_bpe.Encoder(vocabulary.tokens, byte_bpe.Spelling(vocabulary), table).places(asked).tolist() == [known + 1, -1, -1, 300, known + 1]
    monkeypatch.setattr(byte_bpe.xxhash, "xxh3_64_intdigest", len)  # words of one length share a hash
    found = byte_bpe.Encoder(vocabulary.tokens, byte_bpe.Spelling(vocabulary), table).places(asked).tolist()
    assert found[1:3] == [-1, -1] and found[0] in (-1, known + 1)


def test_workers_use_the_encoder_as_it_is_sent(spark, library, monkeypatch):
    """Built in each worker, it takes several times its size there."""
    sent, send = [], spark.sparkContext.broadcast
    monkeypatch.setattr(spark.sparkContext, "broadcast", lambda value: sent.append(value) or send(value))
    text = " zzyzx qwrtp don't" * 3
    frame = spark.createDataFrame([(1, text)], "doc_id long, text string")
    assert byte_bpe.encode(frame, RANKS).first().ids == library.encode_ordinary(text)
    (encoder,) = (value for value in sent if isinstance(value, byte_bpe.Encoder))
    content = pickle.dumps(encoder, 5)
    before = pa.total_allocated_bytes()
    loaded = pickle.loads(content)
    assert pa.total_allocated_bytes() == before
    runs, raw = loaded.encode([text.encode(), b""])
    assert (runs.to_pylist(), raw.to_pylist()) == tuple(a.to_pylist() for a in encoder.encode([text.encode(), b""]))
