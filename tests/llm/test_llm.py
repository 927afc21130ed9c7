"""Operators against brute force, round trips and edge rows: nulls, empty and long texts, ties,
repeated rows, empty tables and clashing column names."""

from __future__ import annotations

import base64
import hashlib
import json
import os
import re
import sys
import zlib

import numpy as np
import pyarrow as pa
import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, ROOT)

from pyspark.sql import functions as F  # noqa: E402

import corpus_pipeline  # noqa: E402
from edpanel.llm import chat, decontam, hilbert, langid, ngram_join, packing, queries, secret_scan, simple8b, topk, warc  # noqa: E402
from edpanel.llm.tokens import Encoder  # noqa: E402

LONG = "lorem ipsum dolor sit amet " * 4000
TEXTS = [None, "", "  \n\t ", "one", "it's 'tis don't  x\n\n  y ​ z\x1c\x85 a²́ 中文 <|endoftext|> ", LONG, "Été naïve ñ × ÷ ɐ", "a b c d e f g", "A B c d e f g"]


@pytest.fixture(scope="module")
def docs(spark):
    """Odd rows with a repeated row, a null id and columns whose names clash with results."""
    rows = [(k, t, "en", "s", 0) for k, t in enumerate(TEXTS)] + [(3, "one", "en", "s", 0), (None, "lost id", None, "s", 0)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    return df.withColumns({c: F.lit("x") for c in ("score", "spans", "n_words", "shard", "slot", "curve", "start", "label", "a")})


@pytest.fixture(scope="module")
def reference_ids():
    import public_tokenizers
    from tokenizers import Tokenizer
    plain = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))  # loaded afresh, as the contract calls it
    return lambda t: plain.encode(t or "", add_special_tokens=False).ids + [0]


def key(x):
    return (x is not None, x if x is not None else 0)


def test_encoder_equals_library(reference_ids):
    rng = np.random.default_rng(3)
    texts = TEXTS + ["".join(rng.choice(list(" \n\t'sretvlmdA1é.-\r×ɐ中_"), int(rng.integers(0, 30)))) for _ in range(1500)]
    texts += ["a <|endoftext|> b", "<|endoftext|>", "x<|endoftext|><|endoftext|>y", "<|endof", "text|> plain after", "<|endoftext|"]
    ids, sizes = Encoder().encode(texts)
    ends = np.cumsum(sizes)
    assert [ids[e - n:e].tolist() for e, n in zip(ends, sizes)] == [reference_ids(t) for t in texts]


@pytest.mark.parametrize("values", [[], [0], [0] * 70, [5] * 100, [2**63 + 5, 1, 2, 2**60, 2**64 - 1, 0, 3], [2**60 - 1, 2**52, 2**52 - 1], list(range(40000))])
def test_simple8b_round_trip(values):
    v = np.array(values, np.uint64)
    docs, counts, back = simple8b.decode_file(simple8b.encode_file([4, None], np.array([len(v), 0]), v))
    assert docs == [4, None] and counts.tolist() == [len(v), 0] and np.array_equal(back, v)


def test_token_files(spark, docs, reference_ids):
    got = [tuple(r) for r in simple8b.token_files(docs, file_ids=50).collect()]
    rows = sorted(((r.doc_id, r.text) for r in docs.collect()), key=lambda r: (key(r[0]), r[1] is not None, hashlib.md5((r[1] or "").encode()).hexdigest()))
    want, start = [], 0
    for doc, text in rows:
        ids = reference_ids(text)
        want.append((doc, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert sorted(got, key=lambda r: r[1]) == want
    assert simple8b.token_files(docs.limit(0)).count() == 0


def test_packing(docs, reference_ids):
    got = packing.pack(docs).collect()
    used, texts = {}, {}
    for p in got:
        assert len(p.ids) == 4 * p.length and 0 < p.length <= 1024
        used.setdefault(p.sequence_id, []).append((p.offset, p.length))
        texts.setdefault(p.doc_id, []).append((p.start, np.frombuffer(p.ids, "<u4").tolist()))
    for spans in used.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at <= 1024
    for k, t in enumerate(TEXTS):
        if k != 3:  # the repeated row
            assert sum((ids for _, ids in sorted(texts[k])), []) == reference_ids(t)
    assert packing.pack(docs.limit(0)).count() == 0


def test_best_fit_takes_the_tightest_room():
    rng = np.random.default_rng(5)
    lengths = rng.integers(1, 1025, 400)
    sequence, _, used = packing.best_fit_decreasing(lengths, 1024)
    rooms: list[int] = []
    for k in np.argsort(-lengths, kind="stable"):
        fits = [r for r in rooms if r >= lengths[k]]
        if fits:
            rooms.remove(min(fits))
            rooms.append(min(fits) - lengths[k])
        else:
            rooms.append(1024 - lengths[k])
    assert used == len(rooms) and sorted(1024 - np.bincount(sequence, weights=lengths)) == sorted(rooms)


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(words[i:i + 5]) for i in range(len(words) - 4)} if len(words) >= 5 else {tuple(words)} if words else set()


def test_ngram_join_brute_force(spark, docs):
    rng = np.random.default_rng(11)
    base = [" ".join(f"w{rng.integers(0, 4000)}" for _ in range(int(rng.integers(20, 90)))) for _ in range(25)]
    texts = list(TEXTS)
    for b in base:
        for _ in range(6):
            words = b.split()
            for at in rng.integers(0, len(words), int(rng.integers(0, 4))):
                words[at] = f"x{rng.integers(0, 99)}"
            texts.append(" ".join(words))
    sets, n = [shingles(t) for t in texts], len(texts)
    parent = list(range(n))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for i in range(n):
        for j in range(i):
            c = len(sets[i] & sets[j])
            if c and 100 * c >= 80 * (len(sets[i]) + len(sets[j]) - c):
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    want = sorted((i, len(sets[i]), find(i)) for i in range(n))
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for rounds in (0, 1):
        got = ngram_join.linked_components(df, sketch_bits=10, rounds=rounds).select("doc_id", "n_shingles", "component_id")
        assert sorted(tuple(r) for r in got.collect()) == want
    odd = ngram_join.linked_components(docs).collect()
    assert len(odd) == docs.count()
    assert {r.doc_id: r.component_id for r in odd}[8] == 7 and [r.component_id for r in odd if r.doc_id is None] == [None]
    assert ngram_join.linked_components(df.limit(0)).count() == 0


def test_long_words_do_not_collide(spark):
    """Structured words on which a polynomial modulo 2 ** 64 collides whatever its base."""
    def thue_morse(n, letters):
        return "".join(letters[bin(k).count("1") % 2] for k in range(n))
    texts = [thue_morse(n, x) for n in (64, 128, 256, 1024, 2048, 4096) for x in ("ab", "ba", "xy", "yx")]
    df = spark.createDataFrame(list(enumerate(texts + texts[:1])), "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in ngram_join.linked_components(df).collect()}
    assert got == {**{k: k for k in range(len(texts))}, len(texts): 0}


def test_suffix_filter_drops_unlike_sets_and_no_link(spark):
    """Sets that share three quarters of their shingles are not gathered whole; linked ones are, also where the counts are cut."""
    near_miss = [f"w{k}" for k in range(900)]
    small = [near_miss, near_miss[:700] + [f"x{k}" for k in range(200)], near_miss[:850] + [f"y{k}" for k in range(50)]]
    large = [f"v{k}" for k in range(ngram_join.RANGES * 200)]
    large = [large, large[:48000] + [f"z{k}" for k in range(len(large) - 48000)]]
    df = spark.createDataFrame([(k, " ".join(x)) for k, x in enumerate(small + large)], "doc_id long, text string")
    facts = ngram_join._profile(ngram_join._texts(df), 10).where("n > 0").selectExpr("doc_id as doc", "n", "ranges")
    assert facts.selectExpr("max(array_max(ranges)) as most").first().most == ngram_join.MOST_IN_RANGE
    pairs = spark.createDataFrame([(0, 1), (0, 2), (3, 4)], "a long, b long")
    assert sorted(tuple(r) for r in ngram_join._near(pairs, facts).collect()) == [(0, 2), (3, 4)]
    assert [r.component_id for r in ngram_join.linked_components(df).orderBy("doc_id").collect()] == [0, 1, 0, 3, 3]


def test_near_duplicates_shuffle_no_text_of_unlinked_documents(spark):
    """The stage joins only rows that may be lost or repeated, whatever Spark would broadcast."""
    def text(k):
        return " ".join(f"{k}w{x}" for x in range(30))
    rows = [(k, text(k), "en", "s", 0) for k in range(300)] + [(300 + k, text(k) + " tail", "en", "s", 0) for k in range(5)]
    rows += [(None, text(1), "en", "s", 0), (400, None, "en", "s", 0), (400, None, "en", "s", 0)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for more in ([], [(9, text(9) + " other", "en", "s", 0)] * 2):  # without and with rows that share an id
            extra = df.unionByName(spark.createDataFrame(more, df.schema)) if more else df
            kept = corpus_pipeline.near_duplicates(spark, extra, "")
            want = [r for r in rows if r[0] is None or r[0] < 300 or r[0] == 400]
            found = sorted((r.doc_id or -1, r.text or "") for r in kept.collect() if r.doc_id != 9)
            assert found == sorted((r[0] or -1, r[1] or "") for r in want if r[0] != 9)
            assert kept.where("doc_id = 9").count() == 1
            plan = kept._jdf.queryExecution().optimizedPlan()
            sure = plan.children().apply(0).toString()
            assert plan.nodeName() == "Union" and "LeftAnti" not in sure and "LeftOuter" in sure
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


@pytest.mark.parametrize("rounds", [0, 1])
def test_repeated_ids_with_other_texts(spark, rounds):
    """Rows of one doc_id with unlike texts are documents of their own."""
    a, b, c = (" ".join(f"{x}{k}" for k in range(40)) for x in "abc")
    rows = [(1, a), (1, b), (2, a + " tail"), (3, b + " tail"), (4, c), (1, None), (1, a), (None, a), (5, "x y"), (5, "x  Y"), (5, "z")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = ngram_join.linked_components(df, rounds=rounds).collect()
    assert sorted((r.doc_id or 0, r.n_shingles, r.component_id or 0) for r in got) == sorted(
        [(1, 36, 1), (1, 36, 1), (1, 36, 1), (1, 0, 1), (2, 37, 1), (3, 37, 1), (4, 36, 4), (0, 36, 0), (5, 1, 5), (5, 1, 5), (5, 1, 5)])
    group = {(r.doc_id, r.digest): r.group_id for r in got}
    md5 = {t: hashlib.md5((t or "").encode()).hexdigest() for _, t in rows + [(0, a + " tail"), (0, b + " tail")]}
    assert group[1, md5[a]] == group[2, md5[a + " tail"]] != group[1, md5[b]] == group[3, md5[b + " tail"]]
    full = df.selectExpr("doc_id", "text", "'en' as lang", "'s' as source", "0L as n_chars")
    kept = corpus_pipeline.near_duplicates(spark, full, "").collect()
    left = sorted((r.doc_id or 0, r.text or "") for r in kept if r.doc_id != 5)
    assert left == sorted([(1, a), (1, b), (4, c), (1, ""), (0, a)])
    assert sorted(r.text.lower().split() for r in kept if r.doc_id == 5) == [["x", "y"], ["z"]]


def test_top_k_brute_force(spark):
    rng = np.random.default_rng(2)
    rows = [(k, [float(x) for x in rng.standard_normal(6).round(1)]) for k in range(150)]
    rows += [(200, rows[3][1]), (201, rows[3][1]), (202, None), (203, [1.0, float("nan")] + [0.0] * 4), (204, [None] + [0.0] * 5), (250, [0.0] * 6), (205, [1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    clean = {k: np.floor(256 * np.array(v)).astype(int) for k, v in rows if k not in (202, 203, 204, 205)}
    want = []
    for q in clean:
        if q % 50 == 0:
            best = sorted(((-int(v @ clean[q]), k) for k, v in clean.items() if k != q))[:5]
            want += [(q, i + 1, k, -s) for i, (s, k) in enumerate(best)]
    got = topk.top_k(df, df.where("vec_id % 50 = 0"), 5, block_vectors=40, block_queries=2)
    assert sorted(tuple(r) for r in got.collect()) == sorted(want)
    assert topk.top_k(df.limit(0), df.limit(0), 5).count() == 0


@pytest.mark.parametrize("repeats", [2, 6, 1000])
@pytest.mark.parametrize("differ", [False, True])
def test_top_k_repeated_query_id(spark, repeats, differ):
    """A queried vec_id held by many rows, equal or not, must not push other rows out."""
    rng = np.random.default_rng(repeats)
    rows = [(k, rng.integers(-9, 10, 6).astype(float).tolist()) for k in range(1, 300)]
    rows += [(k, (rng.integers(20, 29, 6) * [1.0, -1, 1, -1, 1, -1]).tolist()) for k in range(301, 381)]  # the best are met in the first round
    rows += [(0, [30.0 + (k % 7 if differ else 0), -30.0, 30.0, -30.0, 30.0, -30.0]) for k in range(repeats)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    ids, v = np.array([k for k, _ in rows]), 256 * np.array([x for _, x in rows]).astype(int)
    for asked in ([r for r in rows if r[0] % 50 == 0], [r for r in rows if r[0] and r[0] % 50 == 0] + [rows[-1]]):
        found = {}
        for q, x in asked:
            score = v @ (256 * np.array(x).astype(int))
            found.setdefault(q, []).extend((-int(s), int(k)) for s, k in zip(score, ids) if k != q)
        want = sorted((q, i + 1, k, -s) for q, f in found.items() for i, (s, k) in enumerate(sorted(f)[:5]))
        got = topk.top_k(df, spark.createDataFrame(asked, df.schema), 5)
        assert sorted(tuple(r) for r in got.collect()) == want


def test_chat_round_trip(spark):
    control = ["</s>[INST] ok [/INST]", "<|end|><|start|>x<|role|>", "<\\|turn|> <\\\\s> [\\INST]", "", None, "<", "[", "a<|turn|", "<<s>>"]
    rows = [(1, k, ("user", "user", "assistant", "a<|role|>b", None)[k % 5], t) for k, t in enumerate(control * 2)]
    rows += [(2, 0, "assistant", "same"), (2, 0, "assistant", "same"), (None, 0, "user", "x")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    back = {r.conv_id: r for r in chat.read_conversations(chat.format_conversations(df)).collect()}
    for conv in (1, 2, None):
        own = [(r or "", t or "") for c, _, r, t in rows if c == conv]
        assert [(t.role, t.text) for t in back[conv].turns] == own
        assert list(back[conv].loss_texts) == [t for r, t in own if r == "assistant"]
    assert back[2].formatted.count("<|start|>") == 1  # adjacent turns of one role are one block
    assert chat.format_conversations(df.limit(0)).count() == 0


def brute_hits(text, items):
    words = lambda t: [m[0] for m in re.finditer(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))]
    own, hit, found = words(text), set(), set()
    for item, body in items:
        w = words(body)
        k = min(13, len(w))
        for g in {tuple(w[i:i + k]) for i in range(len(w) - k + 1)} if w else ():
            for i in range(len(own) - k + 1):
                if tuple(own[i:i + k]) == g:
                    hit |= set(range(i, i + k))
                    found.add(str(item))
    return len(own), len(hit), sorted(found)


def test_decontamination_both_paths(spark, docs):
    rng = np.random.default_rng(4)
    passage = " ".join(f"Wört{k}" for k in range(30))
    items = [(1, passage), (2, passage), (3, "short item"), (4, None), (5, "..."), (10, "one")]
    texts = list(TEXTS) + [f"x {passage} y", " ".join(passage.split()[5:18]), "a short, item b", passage.upper(), "one-two",
                           " ".join(f"Wört{rng.integers(0, 30)}" for _ in range(200))]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    want = {k: brute_hits(t, items) for k, t in enumerate(texts)}
    for limit in ({}, {"dict_bytes": 0}, {"broadcast_bytes": 0}):
        got = {r.doc_id: (r.n_words, r.n_hit, r.item_ids) for r in decontam.scan(df, bench, **limit).collect()}
        assert got == want
    kept = {r.doc_id: r.text for r in decontam.remove_spans(df, bench).collect()}
    assert kept[len(TEXTS)] == "x  y" and kept[0] is None and kept[5] == LONG
    assert decontam.scan(docs, bench.limit(0)).where("n_hit > 0").count() == 0
    assert decontam.remove_documents(docs, bench).columns == docs.columns
    assert decontam.scan(docs.limit(0), bench).count() == 0


def test_decontamination_null_item_ids(spark):
    """A null item_id is one item, last in the list, on both paths."""
    texts = ["x alpha beta gamma y", "delta only", "alpha beta gamma named one", "named one", "none"]
    items = [(None, "alpha beta gamma"), (None, "alpha beta"), ("b", "alpha beta gamma"), (None, "delta"), ("a", "named one"), ("None", "delta only")]
    want = {0: (3, ["b", None]), 1: (2, ["None", None]), 2: (5, ["a", "b", None]), 3: (2, ["a"]), 4: (0, [])}
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id string, text string")
    for limit in ({}, {"dict_bytes": 0}, {"broadcast_bytes": 0}):
        got = {r.doc_id: (r.n_hit, r.item_ids) for r in decontam.scan(df, bench, **limit).collect()}
        assert got == want
    flags = spark.createDataFrame([(True, "named one"), (None, "delta")], "item_id boolean, text string")
    for limit in ({}, {"dict_bytes": 0}, {"broadcast_bytes": 0}):
        got = {r.doc_id: r.item_ids for r in decontam.scan(df, flags, **limit).collect()}
        assert got == {0: [], 1: [None], 2: ["true"], 3: ["true"], 4: []}


def der(tag, *parts):
    body = b"".join(parts)
    size = bytes([len(body)]) if len(body) < 128 else b"\x82" + len(body).to_bytes(2, "big")
    return bytes([tag]) + size + body


def test_secret_scan(spark, docs):
    pkcs8 = der(0x30, der(2, b"\0"), der(0x30, der(6, b"\x2a\x86\x48")), der(4, bytes(range(90))))
    token = ".".join(base64.urlsafe_b64encode(json.dumps(x).encode()).decode().rstrip("=") for x in ({"alg": "HS256"}, {"sub": "é"})) + ".c2ln"
    body = base64.b64encode(pkcs8).decode()
    texts = [f"é {body} z", f"-----BEGIN PRIVATE KEY-----\n{body}\n-----END PRIVATE KEY-----", f"x {token}.", body[:-8] + "AAAA", pkcs8.hex(),
             "é Token : 'abcdef' PASSWORD=12345 ſecret=abcdefgh api_key='x", "AKIA" + "A" * 15 + " AKIA" + "B" * 16, "f" * 23 + " " + "0" * 24]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: [(s.kind, texts[r.doc_id][s.start:s.end]) for s in r.spans] for r in secret_scan.scan(df).collect()}
    assert got[0] == [("der", body)] and [k for k, _ in got[1]] == ["pem", "der"] and got[2] == [("jwt", token)] and got[3] == []
    assert ("der", pkcs8.hex()) in got[4]
    assert got[5] == [("assign", "Token : 'abcdef")]
    assert got[6] == [("access", "AKIA" + "B" * 16)] and got[7] == [("hex", "0" * 24)]
    clean = {r.doc_id: r.text for r in secret_scan.redact(df).collect()}
    assert clean[0] == "é [SECRET] z" and clean[1] == "[SECRET]" and clean[3] == texts[3]
    scheme = der(0x30, der(6, bytes.fromhex("2a864886f70d01050d")), der(0x30, der(4, b"salt")))
    locked = base64.b64encode(der(0x30, scheme, der(4, bytes(range(80))))).decode()
    rsa = der(0x30, der(2, b"\0"), *(der(2, bytes([1 + k]) * 40) for k in range(8)))
    long = base64.b64encode(rsa).decode()
    wrapped = "\n".join(long[k:k + 64] for k in range(0, len(long), 64))
    ssh = b"openssh-key-v1\0" + b"".join(len(x).to_bytes(4, "big") + x for x in (b"none", b"none", b"")) + (1).to_bytes(4, "big") + b"".join(
        len(x).to_bytes(4, "big") + x for x in (b"public" * 5, b"private" * 9))
    hidden = base64.b64encode(ssh).decode().rstrip("=")
    odd = [f"key\n{wrapped}\nend", f"/etc/{long.rstrip('=')}", f"-----BEGIN ENCRYPTED PRIVATE KEY-----\n{locked}\n-----END ENCRYPTED PRIVATE KEY-----",
           f"a/b/{hidden}", f"path/{long[:-9]}", base64.b64encode(der(0x30, der(0x30, der(6, b"\x2b\x0e")), der(4, b"x" * 60))).decode(), "MII" * 30000]
    kinds = [[(k, t.encode()[a:b].decode()) for a, n, b in secret_scan.find(t.encode()) if (k := secret_scan.KINDS[n])] for t in odd]
    assert ("der", wrapped) in kinds[0] and kinds[1] == [("der", long.rstrip("="))] and {"pem", "der"} == {k for k, _ in kinds[2]}
    assert kinds[3] == [("openssh", hidden)] and kinds[4:] == [[], [], []]
    assert secret_scan.redacted_text(odd[1], "*") == "/etc/*" and secret_scan.redacted_text("é", "*") == "é"
    assert all(not r.spans for r in secret_scan.scan(docs).collect()) and secret_scan.scan(docs.limit(0)).count() == 0


def test_secret_base_brute_force():
    rng = np.random.default_rng(9)
    pieces = ["password", "=", "token", "AKIA", " ", "\"", "'", ":", "abc", "0f9a8b7c6d5e4f3a", "XYZ789", "é", "api_key", "\n", "=="]
    patterns = [(r"""(?a:(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+))""", lambda m: len(m[2]) >= 6),
                (r"AKIA[A-Z0-9]+", lambda m: len(m[0]) >= 20), (r"[0-9a-f]+", lambda m: len(m[0]) >= 24)]
    for _ in range(400):
        text = "".join(rng.choice(pieces, 25))
        want = sorted((len(text[:m.start()].encode()), k, len(text[:m.end()].encode()))
                      for k, (p, keep) in enumerate(patterns) for m in re.finditer(p, text) if keep(m))
        assert [s for s in secret_scan.find(text.encode()) if s[1] < 3] == want


def test_signed_token_search():
    """The search that reads a run once finds what the plain pattern finds, and is quick on long runs."""
    rng, plain = np.random.default_rng(3), re.compile(rb"eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+\.[A-Za-z0-9_-]*")
    for _ in range(3000):
        data = "".join(rng.choice(["eyJ", "a", ".", ".", "-", " ", "eyJb"], 12)).encode()
        assert [m.span(1) for m in secret_scan._JWT.finditer(data)] == [m.span() for m in plain.finditer(data)]
    assert secret_scan.find(b"eyJ" * 500_000) == []  # without the run rule this takes hours


def test_warc_round_trip(spark):
    rows = [(1, "http://a/é\n", "<p>é</p>"), (2, "http://b/", "<p>é</p>"), (3, None, None), (4, "u", ""), (5, "u", "x" * 200000), (2, "http://b/", "<p>é</p>"),
            (6, "u", "a\r\n\r\nWARC/1.1\r\n"), (1, "http://a/é\n", "<p>é</p>")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = warc.archive_round_trip(df, with_payload=True, file_bytes=1000).collect()
    assert len(got) == len(rows)
    first = {}
    for p, _, h in sorted(rows, key=lambda r: r[0]):
        first.setdefault(h or "", p)
    want = sorted((p, u or "", len((h or "").encode()), base64.b32encode(hashlib.sha1((h or "").encode()).digest()).decode(),
                   "response" if first[h or ""] == p else "revisit", None if first[h or ""] == p else first[h or ""]) for p, u, h in rows)
    assert sorted((r.metadata.page_id, r.response.target, r.metadata.payload_bytes, r.response.payload_digest, r.response.kind, r.metadata.refers_page)
                  for r in got) == want
    assert all(r.request.target == r.response.target for r in got)
    ids = {r.record_id for r in got if r.response.kind == "response"}
    assert all(r.response.refers_to in ids for r in got if r.response.kind == "revisit")
    assert {bytes(r.response.payload).decode() for r in got if r.response.kind == "response"} == {h or "" for _, _, h in rows}
    assert warc.archive_round_trip(df.limit(0)).count() == 0


@pytest.mark.parametrize("dims,bits", [(2, 3), (3, 2)])
def test_hilbert_curve_steps_to_neighbours(spark, dims, bits):
    cells = [(1 << bits * k) for k in range(dims)]
    df = spark.range(1 << (dims * bits)).select(*(F.expr(f"cast(id div {c} % {1 << bits} as int)").alias(f"c{k}") for k, c in enumerate(cells)))
    got = df.withColumn("index", hilbert.curve_index([F.col(f"c{k}") for k in range(dims)], bits)).orderBy("index").collect()
    assert [r["index"] for r in got] == list(range(1 << (dims * bits)))
    assert all(sum(abs(a[k] - b[k]) for k in range(dims)) == 1 for a, b in zip(got, got[1:]))


def test_hilbert_shards(spark, docs, sf_dir):
    got = queries.op9_hilbert_shards(spark, sf_dir).collect()
    sizes = np.bincount([r.shard for r in got], minlength=40)
    assert sizes.max() - sizes.min() <= 1
    assert {(r.shard, r.slot) for r in got} == {(s, k) for s, n in enumerate(sizes) for k in range(n)}
    text = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    assert all(r.size == len(text[r.doc_id].encode()) + 16 and r.text_crc32 == zlib.crc32(text[r.doc_id].encode()) for r in got)
    cells = [hilbert.log_cell(F.length("text")), hilbert.hash_cell(F.col("lang"))]
    odd = hilbert.assign(docs, cells, shards=4).collect()
    assert sorted(np.bincount([r.shard for r in odd], minlength=4)) == [2, 3, 3, 3]
    assert hilbert.assign(docs.limit(0), cells).count() == 0


def test_hilbert_salts_grow_and_shards_are_written_in_order(spark, tmp_path, monkeypatch):
    """Rows of one cell and one null id: told apart by their text, over as many salts as they need."""
    monkeypatch.setattr(hilbert, "ROWS_PER_SALT", 2)
    df = spark.range(3000).select(F.lit(None).cast("long").alias("doc_id"), F.crc32(F.col("id").cast("string").cast("binary")).alias("text_crc32"))
    seen = []
    monkeypatch.setattr(hilbert.F, "pmod", lambda value, n, pmod=F.pmod: seen.append(str(n)) or pmod(value, n))
    rows = hilbert.assign(df, [F.lit(1), F.lit(2)], shards=7)
    assert any("1500" in n for n in seen)
    hilbert.write_shards(rows, str(tmp_path / "s"))
    got = spark.read.parquet(str(tmp_path / "s")).collect()
    sizes = np.bincount([r.shard for r in got], minlength=7)
    assert sizes.sum() == 3000 and sizes.max() - sizes.min() <= 1
    assert {(r.shard, r.slot) for r in got} == {(s, k) for s, n in enumerate(sizes) for k in range(n)}
    folders = sorted((tmp_path / "s").glob("shard=*"))
    assert len(folders) == 7
    for folder in folders:
        slots = [r.slot for f in sorted(folder.glob("*.parquet")) for r in spark.read.parquet(str(f)).collect()]
        assert slots == list(range(len(slots)))


def test_langid_gradient_and_accuracy(spark, docs, sf_dir):
    got = {r.doc_id: r for r in queries.op10_langid(spark, sf_dir).collect()}
    truth = {r.doc_id: r.lang for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "lang").collect()}
    held = [k for k, r in got.items() if r.held_out]
    assert set(held) == {k for k in truth if zlib.crc32(str(k).encode()) % 4 == 2}
    assert np.mean([got[k].lang_pred == truth[k] for k in held]) >= 0.9
    assert all(0 <= r.score <= 1 for r in got.values())
    model = langid.train([b"aaaa bb" * 20, b"zz yyyy" * 20], ["a", "z"], steps=60)
    odd = {(r.doc_id, r.text): r for r in langid.predict(docs, model).collect()}
    assert odd[0, None].lang_pred == odd[1, ""].lang_pred == odd[2, "  \n\t "].lang_pred == "und" and odd[5, LONG].n_positions == len(LONG)
    assert langid.train([], []) is None and langid.predict(docs, None).where("lang_pred != 'und'").count() == 0
    windows = np.frombuffer(b"abcabc" * 3, np.uint8).reshape(3, 6)  # lengths must not change earlier windows
    whole = {p: x for p, x in langid.position_logits(model, windows, np.array([6, 6, 6]))}
    cut = {p: x for p, x in langid.position_logits(model, windows, np.array([6, 6, 2]))}
    assert all(np.allclose(whole[p][:2], cut[p][:2]) for p in range(6)) and len(cut[3]) == 2


def test_language_stage_keeps_clean_documents(spark, sf_dir):
    """Short and mixed-language documents stay, and all with letters where no row is labelled."""
    df = spark.read.parquet(f"{sf_dir}/documents.parquet").select(*corpus_pipeline.COLUMNS)
    rows = df.orderBy("doc_id").collect()
    part = {g: [r.text[:300] for r in rows if r.lang == g][:3] for g in sorted({r.lang for r in rows})}
    planted = ["Re.", "De.", "A.", "En de ja de y.", "+1 (209) 555-5975 De", *(" ".join(x) for x in zip(*part.values()))]
    lost = [None, "", "12 34", "..."]
    extra = spark.createDataFrame([(-1 - k, t, None, "s", 0) for k, t in enumerate(planted + lost)], df.schema)
    stage = corpus_pipeline.language(spark, df.unionByName(extra), sf_dir).collect()
    assert {r.doc_id for r in stage} == {r.doc_id for r in rows} | {-1 - k for k in range(len(planted))}
    assert all(r.lang in corpus_pipeline.WANTED for r in stage)  # a missing label is filled by the prediction
    foreign = spark.createDataFrame([(10 ** 6 + k, "жизнь человека и дом у реки " * 5 + str(k), "ru", "s", 0) for k in range(300)], df.schema)
    unlabelled = spark.createDataFrame([(10 ** 7, "дом у реки и жизнь " * 9, None, "s", 0)], df.schema)
    left = corpus_pipeline.language(spark, df.unionByName(foreign).unionByName(unlabelled), sf_dir).select("doc_id").collect()
    assert len({r.doc_id for r in left} & {r.doc_id for r in rows}) >= 0.98 * len(rows) and not [r for r in left if r.doc_id >= 10 ** 6]
    bare = corpus_pipeline.language(spark, extra, sf_dir)
    assert {r.doc_id for r in bare.collect()} == {-1 - k for k in range(len(planted))} and bare.columns == df.columns


def test_pipeline_stages(spark, sf_dir, docs):
    df = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = df.collect()
    kept, before = df, df.count()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        kept = corpus_pipeline.written(stage(spark, kept, sf_dir), name)
        assert kept.columns == df.columns and kept.count() <= before
        before = kept.count()
    assert before > len(rows) * 0.6
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    left = kept.collect()
    for r in left[:40]:
        n, hit, _ = brute_hits(r.text, items)
        assert not (hit and 20 * hit >= n)
        assert not secret_scan.find(r.text.encode())
    pieces = corpus_pipeline.STAGES[-1][1](spark, kept, sf_dir)
    assert {r.doc_id for r in pieces.select("doc_id").distinct().collect()} == {r.doc_id for r in left}
    plain = docs.select("doc_id", "text", "lang", "source", "n_chars")
    for frame in (plain, plain.limit(0)):
        out = frame
        for name, stage in corpus_pipeline.STAGES:
            out = corpus_pipeline.written(stage(spark, out, sf_dir), name)
        out.count()
