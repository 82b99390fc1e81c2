"""Suffix-array dedup and SimHash near-dedup against brute force."""

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest
import xxhash

from flumen.llm import simhash, suffixdedup
from flumen.llm.common import written
from flumen.llm.graph import components


# ---- operator 1 --------------------------------------------------------------------

def removed_by_hand(texts: list[bytes], length: int):
    seen = Counter(t[i:i + length] for t in texts for i in range(len(t) - length + 1))
    out = []
    for t in texts:
        gone = bytearray(len(t))
        for i in range(len(t) - length + 1):
            if seen[t[i:i + length]] > 1:
                gone[i:i + length] = b"\1" * length
        runs = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        kept = bytes(b for b, g in zip(t, gone) if not g)
        out.append((len(t), sum(gone), runs, hashlib.sha256(kept).hexdigest()))
    return out


def check_removed(spark, texts, length, anchor, batches=3):
    df = spark.createDataFrame([(i if i % 9 else None, t) for i, t in enumerate(texts)], "doc_id long, text string").repartition(3)
    found = suffixdedup.match(df, settings=suffixdedup.Settings(length, anchor, batches))
    got = Counter(tuple(r) for r in df.select("text", suffixdedup.digests("text", found).alias("d")).select("text", "d.*").collect())
    want = Counter((t, *r) for t, r in zip(texts, removed_by_hand([(t or "").encode() for t in texts], length)))
    assert got == want
    return found


@pytest.mark.parametrize("seed,length", [(1, 8), (2, 20)])
def test_repeated_strings_equal_brute_force(spark, seed, length):
    rng = random.Random(seed)
    base = ["".join(rng.choice("abé") for _ in range(rng.randrange(60))) for _ in range(6)]
    texts = ["".join(rng.choice(base)[:rng.randrange(60)] if rng.random() < .5 else "".join(rng.choice("abc") for _ in range(rng.randrange(30)))
                     for _ in range(rng.randrange(4))) for _ in range(50)]
    texts += ["a" * 100, "ab" * 50, "", None, None, texts[0], texts[0]]
    check_removed(spark, texts, length, length // 2)


def test_pieces_do_not_matter(spark, monkeypatch):
    monkeypatch.setattr(suffixdedup, "STEP", 64)        # local mode: workers import afresh, so run here
    import pyarrow as pa
    rng = random.Random(3)
    text = "".join(rng.choice("abcd") for _ in range(700))
    s = suffixdedup.Settings(40, 20)
    data = np.frombuffer((text + text).encode(), dtype=np.uint8)
    small = [p for p in suffixdedup.spans(data, np.array([0, 700, 1400]), s)]
    monkeypatch.undo()
    big = [p for p in suffixdedup.spans(data, np.array([0, 700, 1400]), s)]
    covered = lambda ps: sorted((int(a) + p.at) for p in ps for f, z in zip(p.first, p.last) for a in range(f, z + 1))
    assert covered(small) == covered(big) == [*range(661), *range(700, 1361)]
    assert pa.array([text]).null_count == 0


def test_levels_merge_geometrically(spark):
    texts = [f"{i:04d}" * 30 for i in range(40)]
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    family = suffixdedup.Family(spark, suffixdedup.Settings(40, 20))
    ranks = []
    for i in range(5):
        family.add(df.where(f"pmod(hash(text), 5) = {i}"))
        ranks.append([r for r, _ in family.levels])
    assert ranks == [[0], [1], [1, 0], [2], [2, 0]]


def test_kept_text_drops_halves_of_characters(spark):
    shared = "x" * 7 + "é"                      # nine bytes; a window of eight cuts the last character
    df = spark.createDataFrame([(1, "ab" + shared), (2, "cd" + "x" * 7 + "è")], "doc_id long, text string")
    out = {r.doc_id: r.text for r in suffixdedup.deduplicated(df, settings=suffixdedup.Settings(8, 4, 2)).collect()}
    assert out == {1: "ab", 2: "cd"}


def kept_by_words(texts: list[str], length: int) -> list[str]:
    spots = [list(re.finditer(rb"[^\x20\x09-\x0D]+", (t or "").encode())) for t in texts]
    runs = [[tuple(m.group() for m in w[i:i + length]) for i in range(len(w) - length + 1)] for w in spots]
    seen = Counter(r for own in runs for r in own)
    out = []
    for t, w, own in zip(texts, spots, runs):
        raw = bytearray((t or "").encode())
        gone = bytearray(len(raw))
        for i, r in enumerate(own):
            if seen[r] > 1:
                a, z = w[i].start(), w[i + length - 1].end()
                gone[a:z] = b"\1" * (z - a)
        out.append(bytes(b for b, g in zip(raw, gone) if not g).decode())
    return out


@pytest.mark.parametrize("length,anchor", [(7, 3), (12, 4)])
def test_repeated_runs_of_words_equal_brute_force(spark, length, anchor):
    rng = random.Random(length)
    vocabulary = ["".join(rng.choice("abé") for _ in range(rng.randrange(1, 9))) for _ in range(30)]
    base = [[rng.choice(vocabulary) for _ in range(rng.randrange(40))] for _ in range(6)]
    texts = [rng.choice(["", " "]) + rng.choice([" ", "\n", " \t"]).join(rng.choice(base)[:rng.randrange(40)] + [rng.choice(vocabulary) for _ in range(rng.randrange(25))] + rng.choice(base))
             for _ in range(40)]
    texts += ["", None, "  ", "z", "same " * 30, texts[0]]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    got = {r.doc_id: r.text for r in suffixdedup.deduplicated(df, settings=suffixdedup.Settings(length, anchor, 3, "words")).collect()}
    assert got == dict(enumerate(kept_by_words(texts, length)))


def test_words_do_not_depend_on_pieces(monkeypatch):
    data = np.frombuffer(("ab " + "c" * 500 + "  ab" + "ab ab\n" * 60).encode(), dtype=np.uint8)
    big = suffixdedup.words_of(data, np.array([0, 507, len(data)]))
    monkeypatch.setattr(suffixdedup, "STEP", 64)
    small = suffixdedup.words_of(data, np.array([0, 507, len(data)]))
    assert all((a == b).all() for a, b in zip(big, small))
    assert big[1].tolist() == [0, 3, 123] and len(set(big[0].tolist())) == 2


def test_empty_table_and_extra_columns(spark):
    df = spark.createDataFrame([], "doc_id long, text string, n_bytes string")
    assert suffixdedup.deduplicated(df).columns == df.columns
    assert suffixdedup.deduplicated(df).count() == 0


# ---- operator 6 --------------------------------------------------------------------

def fingerprint_by_hand(text, words=4):
    import re
    w = [x for x in re.split(rb"[\x20\x09-\x0D]+", (text or "").encode().lower()) if x]
    if not w:
        return 0
    shingles = [b" ".join(w[i:i + words]) for i in range(max(1, len(w) - words + 1))]
    h = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def parts_by_hand(fps, distance):
    part = list(range(len(fps)))

    def root(i):
        while part[i] != i:
            i = part[i]
        return i
    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= distance:
                part[max(root(i), root(j))] = min(root(i), root(j))
    return [root(i) for i in range(len(fps))]


def near_texts(rng, n):
    vocabulary = ["".join(rng.choice("abcdefgh") for _ in range(rng.randrange(1, 7))) for _ in range(80)]
    base = [[rng.choice(vocabulary) for _ in range(rng.randrange(3, 200))] for _ in range(n // 4)]
    out = []
    for _ in range(n):
        w = list(rng.choice(base))
        for _ in range(rng.randrange(3)):
            w[rng.randrange(len(w))] = rng.choice(vocabulary)
        out.append(rng.choice([" ", "\n", "\t "]).join(w))
    return [*out, "", None, "   ", "Ünï A", out[0], out[0].upper()]


@pytest.mark.parametrize("distance,segments", [(4, 3), (5, 2)])
def test_components_equal_brute_force(spark, distance, segments):
    texts = near_texts(random.Random(7), 60)
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    got = {r.id: (r.fp & (2**64 - 1), r.component_id) for r in simhash.near_duplicates(df, distance=distance, segments=segments).collect()}
    fps = [fingerprint_by_hand(t) for t in texts]
    assert {i: f for i, (f, _) in got.items()} == dict(enumerate(fps))
    assert [got[i][1] for i in range(len(texts))] == parts_by_hand(fps, distance)


def test_links_broadcast_no_enumerated_side(spark):
    # both sides are many times the table that Spark sizes them by: here 67 and 3 rows for each of its rows
    rng = random.Random(5)
    base = [rng.getrandbits(64) for _ in range(40)]
    fps = sorted({b ^ sum(1 << i for i in rng.sample(range(64), rng.randrange(7))) for b in base for _ in range(4)})
    signed = [x - (1 << 64) if x >> 63 else x for x in fps]
    nodes = written(spark.createDataFrame([(x, i) for i, x in enumerate(signed)], "fp long, part long"), "few")
    found = simhash.links(nodes, 4, 3)
    near = {tuple(sorted((signed[i], signed[j]))) for i in range(len(fps)) for j in range(i) if (fps[i] ^ fps[j]).bit_count() <= 4}
    assert near and {(r.a, r.b) for r in found.collect()} == near
    assert "Broadcast" not in found._jdf.queryExecution().executedPlan().toString()


def test_long_text_is_counted_whole():
    rng = random.Random(1)
    text = " ".join(rng.choice(["a", "bb", "ccc", "dddd", "é"]) for _ in range(40_000))
    assert simhash.fingerprint_of(text.encode()) == fingerprint_by_hand(text)


def test_keep_one_with_null_ids_ties_and_clashing_columns(spark):
    rows = [(3, "one two three four five", "p"), (3, "one two three four five", "p"), (1, "one two three four five", "q"),
            (None, "six seven eight nine ten", "r"), (None, "six seven eight nine ten", "r"), (9, "", "s"), (8, None, "t")]
    df = spark.createDataFrame(rows, "doc_id long, text string, component_id string")
    odd = df.selectExpr("*", "1 AS __f", "2 AS __id", "3 AS __fp", "4 AS __n", "5 AS __own_0")
    assert {tuple(r)[3:] for r in simhash.keep_one(odd).collect()} == {(1, 2, 3, 4, 5)}
    kept = [(r.doc_id, r.component_id) for r in simhash.keep_one(df).collect()]
    assert sorted(kept, key=str) == [(1, "q"), (8, "t"), (None, "r")]
    empty = spark.createDataFrame([], df.schema)
    assert simhash.keep_one(empty).columns == df.columns and simhash.keep_one(empty).count() == 0


def test_keep_one_of_unlike_texts_without_or_with_one_id(spark):
    rows = [(None, "one two three four five"), (None, "six seven eight nine ten"), (7, "red green blue black white"), (7, "north south east west up"), (7, "north south east west up")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(map(tuple, simhash.keep_one(df).collect()), key=str) == sorted(set(rows), key=str)


def test_chain_of_links_is_one_component(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(60)] + [(100, 101), (7, 7)], "a long, b long")
    assert {(r.node, r.part) for r in components(edges).collect()} == {(i, 0) for i in range(61)} | {(100, 100), (101, 100)}
