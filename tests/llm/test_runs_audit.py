"""Operators 11 to 13 against brute force, the public tokeniser, and odd inputs."""

import base64
import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import public_tokenizers
from flumen.llm import divergence, queries, rankbpe, wordruns
from tests.conftest import SF_SMALL

WORD, TERM = re.compile(r"[^\x20\x09-\x0D]+"), re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet(f"{SF_SMALL}/documents.parquet").orderBy("doc_id").collect()


# ---- 11 ----------------------------------------------------------------------------

def runs_by_hand(w):
    """(start, length, period), by trying every period in rising order."""
    out, n = {}, len(w)
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and w[j] == w[j + q]:
                j += 1
            if j > i and j + q - i >= max(6, 4 * q):
                out.setdefault((i, j + q - i), q)
            i = j + 1
    return sorted((s, k, q) for (s, k), q in out.items())


def collapsed_by_hand(w, runs):
    gone = {i for s, k, q in runs for i in range(s + q, s + k)}
    return " ".join(x for i, x in enumerate(w) if i not in gone)


def looped_by_hand(w, doc_id):
    h = zlib.crc32(str(doc_id).encode())
    if doc_id is None or h % 10 or not w:
        return w
    g = h // 10
    a = g % len(w)
    p = 1 + (len(w) - a) // (3 + g % 8)
    return [w[i] if i < a else w[a + (i - a) % p] for i in range(len(w))]


def found(texts, **kw):
    w = wordruns.words(pa.array(texts, type=pa.string()))
    start, stop, period = wordruns.find_runs(w.code, w.offsets, **kw)
    doc = np.searchsorted(w.offsets, start, side="right") - 1
    out = [[] for _ in texts]
    for d, s, e, q in zip(doc.tolist(), start.tolist(), stop.tolist(), period.tolist()):
        out[d].append((s - int(w.offsets[d]), e - s, q))
    return out


pieces = st.lists(st.tuples(st.lists(st.sampled_from("abc"), min_size=1, max_size=5), st.integers(1, 9)), max_size=8)


@settings(max_examples=150, deadline=None)
@given(st.lists(pieces, max_size=6))
def test_runs_equal_brute_force(docs):
    words = [[x for unit, n in d for x in unit * n] for d in docs]
    assert found([" ".join(w) for w in words]) == [runs_by_hand(w) for w in words]


def test_runs_of_words_without_structure():
    """Fibonacci and Thue-Morse words, one word, nested loops, a loop of long period."""
    a, b = "a", "ab"
    while len(b) < 1500:
        a, b = b, b + a
    t = "a"
    while len(t) < 4096:
        t += t.translate(str.maketrans("ab", "ba"))
    rng = random.Random(3)
    unit = [rng.choice("abcdefgh") for _ in range(300)]
    texts = [b, t, "a" * 1000, ("aab" * 5 + "c") * 6, unit * 5 + unit[:7]]
    assert found([" ".join(x) for x in texts]) == [runs_by_hand(list(x)) for x in texts]


def test_runs_of_odd_texts(spark):
    rows = [(1, None), (2, ""), (3, " \t\n"), (4, "a a a a a"), (5, "a a a a a a"), (6, "x" * 100_000 + " y" * 7), (5, "a a a a a a"),
            (7, "  a　b a　b a　b a　b a　b a　b")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("word_runs", F.lit(1)).withColumn("runs", F.lit(2))
    got = wordruns.with_runs(df)
    assert got.columns == ["doc_id", "text", "runs", "word_runs"]
    for r in got.collect():
        w = WORD.findall(r.text or "")
        want = runs_by_hand(w)
        assert [tuple(x) for x in r.word_runs.runs] == want
        assert r.word_runs.n_words == len(w) and r.word_runs.collapsed == collapsed_by_hand(w, want)
    assert wordruns.with_runs(df.limit(0)).collect() == []


def test_rules_occur_twice_and_no_pair_is_left():
    rng = random.Random(1)
    code = np.array([rng.randrange(3) for _ in range(2000)])
    g = wordruns.re_pair(code, np.array([0, 900, 900, 2000]))
    size = np.concatenate((np.ones(g.base, dtype=np.int64), g.left_size + g.right_size))
    assert size[g.symbols].sum() == 2000
    used = Counter(g.symbols.tolist())
    for i in reversed(range(len(g.left))):          # occurrences in the derivation
        used[int(g.left[i])] += used[g.base + i]
        used[int(g.right[i])] += used[g.base + i]
    assert len(g.left) > 50 and all(used[g.base + i] >= 2 for i in range(len(g.left)))
    pairs = Counter(zip(g.docs[:-1], g.symbols[:-1].tolist(), g.symbols[1:].tolist(), g.docs[1:]))
    assert all(n < 2 or a == b for (d, a, b, e), n in pairs.items() if d == e)


def test_op11_equals_brute_force(spark, documents):
    got = {r.doc_id: tuple(r)[1:] for r in queries.QUERIES["op11_periodic_runs"](spark, SF_SMALL).collect()}
    some = 0
    for d in documents:
        w = looped_by_hand(WORD.findall(d.text or ""), d.doc_id)
        runs = runs_by_hand(w)
        some += bool(runs)
        top = max(runs, key=lambda r: (r[1], -r[0], -r[2]), default=None)
        best = (*top, 1000 * top[1] // top[2]) if top else (None,) * 4
        want = (len(runs), *best, hashlib.sha256("".join(f"{a},{b},{c}\n" for a, b, c in sorted(runs, key=lambda r: (r[0], r[2]))).encode()).hexdigest(),
                hashlib.sha256(collapsed_by_hand(w, runs).encode()).hexdigest())
        assert got[d.doc_id] == want
    assert some > 5 and len(got) == len(documents)


# ---- 12 ----------------------------------------------------------------------------

def audit_by_hand(rows, min_docs=10, top=10):
    rows = [tuple(x or "" for x in r) for r in rows]
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    held, count, groups = {}, {}, {}
    for lang, source, text in rows:
        terms = Counter(TERM.findall(text.translate(lower)))
        groups.setdefault(lang, set()).add(source)
        for t, n in terms.items():
            held.setdefault(lang, Counter())[t] += 1
            count.setdefault((lang, source), Counter())[t] += n
    out = []
    for lang, sources in groups.items():
        kept = [t for t, n in held.get(lang, {}).items() if n >= min_docs]

        def table(c):
            total = sum(c[t] for t in kept)
            return {t: 1 + 10 ** 9 * (c[t] + 2) // (total + 2 * len(kept)) for t in kept}
        of = {s: count.get((lang, s), Counter()) for s in sources}
        p = {s: table(c) for s, c in of.items()}
        q = table(sum(of.values(), Counter()))
        for s in sources:
            pairs = [(o, sum((p[s][t] - p[o][t]) ** 2 // (p[s][t] + p[o][t]) for t in kept)) for o in sources if o != s]
            terms = [(t, (p[s][t] - q[t]) ** 2 // (p[s][t] + q[t])) for t in kept if of[s][t] and p[s][t] > q[t]]
            for part, found, most in (("pair", pairs, None), ("term", terms, top)):
                for rank, (item, value) in enumerate(sorted(found, key=lambda x: (-x[1], x[0].encode()))[:most], 1):
                    out.append((lang, s, part, item, value, rank))
    return sorted(out)


def test_audit_equals_brute_force(spark, monkeypatch):
    monkeypatch.setattr(divergence, "PART_ROWS", 50)
    monkeypatch.setattr(divergence, "STRIP", 2)
    rng = random.Random(4)
    words = [f"{c}{d}" for c in "abcdEFé日" for d in "xyzéQ"]
    rows = []
    for _ in range(400):
        lang = rng.choice(["en", "de", None, ""])
        source = rng.choice(["s1", "s1", "s1", "s2", "s3", "é", None])
        n = rng.choice([0, 1, 5, 40])
        rows.append((lang, source, rng.choice([" ", "-", "1"]).join(rng.choice(words[:3 + len(source or "")*9]) for _ in range(n))))
    rows += [("en", "hot", "The the THE end")] * 60 + [("en", "none", None), ("xx", "a", "once"), ("xx", "b", ""), ("yy", "only", "alone")]
    df = spark.createDataFrame([(i, *r, 1, 2) for i, r in enumerate(rows)], "doc_id int, lang string, source string, text string, n int, term int")
    got = divergence.audit(df)
    assert got.columns == ["lang", "source", "part", "item", "value", "rank"]
    assert sorted(map(tuple, got.collect())) == audit_by_hand(rows)


def test_audit_of_long_texts_and_empty_tables(spark):
    rows = [("en", f"s{i % 3}", ("word%s " % chr(97 + i % 7)) * 50_000) for i in range(40)]
    df = spark.createDataFrame(rows, "lang string, source string, text string")
    assert sorted(map(tuple, divergence.audit(df).collect())) == audit_by_hand(rows)
    assert divergence.audit(df.limit(0)).collect() == []


def test_shares_are_exact_for_large_counts():
    rng = random.Random(2)
    n = [rng.randrange(10 ** k) for k in range(1, 16) for _ in range(20)]
    whole = [x + rng.randrange(1, 10 ** 6) for x in n]
    assert divergence.share(np.array(n), np.array(whole)).tolist() == [1 + 10 ** 9 * a // b for a, b in zip(n, whole)]


def test_equal_subtrees_are_one_node():
    counts = np.zeros((50, 1024), dtype=np.int64)
    counts[3, 17] = counts[4, 17] = 5
    trees = divergence.Trees(counts)
    assert sum(len(left) for left, _ in trees.children) == 20       # a zero and a changed node per level
    assert trees.roots[3] == trees.roots[4] != trees.roots[0]


# ---- 13 ----------------------------------------------------------------------------

@pytest.fixture(scope="module")
def public():
    with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_ids_equal_public_library(public):
    c, rng = rankbpe.codec(rankbpe.RANKS), random.Random(1)
    for alphabet in ("ab", "aab ", "aehtino", "the \n\t.", "éàü ñ", "日本語a", "0123456789 ", "<|endoftext|> ", "\x00\x01​\U0001f600"):
        for _ in range(150):
            t = "".join(rng.choice(alphabet) for _ in range(rng.randrange(200)))
            ids = c.encode(t)
            assert ids.tolist() == public.encode_ordinary(t)
            assert c.decode(ids) == t.encode()


@pytest.mark.parametrize("text", ["a" * 60_000, "ab" * 30_000, " " * 30_001 + "x", "=-" * 20_000, "abcdefghij" * 5_000])
def test_very_long_pre_tokens(public, text):
    assert rankbpe.codec(rankbpe.RANKS).encode(text).tolist() == public.encode_ordinary(text)


def test_ranks_of_another_file(tmp_path):
    """Pairs of lower rank than the merge that makes them, and texts that are tokens."""
    tokens = [bytes([b]) for b in range(97, 103)] + [b"abc", b"bc", b"ab", b"cd", b"abcd", b"ef", b"aa", b"aaa", b"def", b"de"]
    path = tmp_path / "ranks"
    path.write_bytes(b"".join(base64.b64encode(t) + b" %d\n" % i for i, t in enumerate(tokens)))
    c = rankbpe.Codec(str(path))
    enc = tiktoken.Encoding("small", pat_str=r"[a-f]+", mergeable_ranks={t: i for i, t in enumerate(tokens)}, special_tokens={})
    rng = random.Random(6)
    for _ in range(500):
        t = "".join(rng.choice("abcdef") for _ in range(rng.randrange(1, 30)))
        assert c.encode_word(t.encode()) == enc.encode_ordinary(t)


def test_bpe_of_odd_rows(spark):
    df = spark.createDataFrame([(1, None), (2, ""), (3, "tie tie"), (3, "tie tie")], "doc_id long, text string").withColumn("token_ids", F.lit(0))
    got = rankbpe.encoded(df).withColumn("back", rankbpe.decode("token_ids"))
    assert got.columns == ["doc_id", "text", "token_ids", "back"]
    for r in got.collect():
        assert bytes(r.back) == (r.text or "").encode() and (len(r.token_ids) > 0) == bool(r.text)
    assert rankbpe.encoded(df.limit(0)).collect() == []


def test_op13_equals_public_library(spark, documents, public):
    got = {r.doc_id: tuple(r)[1:] for r in queries.QUERIES["op13_rank_queue_bpe"](spark, SF_SMALL).collect()}
    want = {}
    for d in documents:
        ids = public.encode_ordinary(d.text or "")
        want[d.doc_id] = (len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(public.decode_bytes(ids)).hexdigest())
    assert got == want
