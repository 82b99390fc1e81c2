"""Token counts, BPE, language-model scores and language ID against brute force."""

import bisect
import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from flumen.llm import bpe, langid, ngramlm, tokencount

ODD = ["", None, " ", "a", "\n\n a\n", "É ñ\tß", "<|endoftext|>", "x<|endoftext|> y", "it's we'll I'd", "aaaa" * 300, "12 345,6!!", "中文 🙂 ok",
       "\x1c\x85​　", "the the the\r\nthe", "tail \n \n"]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(bpe.TOKENIZER)


def random_texts(n, seed):
    rng = random.Random(seed)
    alphabet = [" ", "  ", "\n", "a", "b", "th", "ing", "é", "ñ", "中", "🙂", "12", "'s", "<|endoftext|>", "<|", ".", "...", "İ", "　", " the"]
    return ["".join(rng.choice(alphabet) if rng.random() < .85 else chr(rng.randrange(32, 0xD7FF)) for _ in range(rng.randrange(1, 40))) for _ in range(n)]


# ---- operator 8 --------------------------------------------------------------------

def test_ids_equal_the_library(library):
    codec = bpe.codec(bpe.TOKENIZER)
    for text in [t or "" for t in ODD] + random_texts(1500, 1):
        ids, shown = codec.encode(text)
        want = library.encode(text, add_special_tokens=False).ids
        assert ids.tolist() == want and shown == ",".join(map(str, want))
        assert codec.decode(ids) == text


def test_decoding_any_ids_equals_the_library(library):
    codec, rng = bpe.codec(bpe.TOKENIZER), random.Random(2)
    for _ in range(500):
        ids = [rng.randrange(50_257) for _ in range(rng.randrange(8))]
        assert codec.decode(np.array(ids, dtype=np.int64)) == library.decode(ids, skip_special_tokens=False)


def test_memo_limits_do_not_change_results(library, monkeypatch):
    monkeypatch.setattr(bpe, "MEMO_WORDS", 2)
    monkeypatch.setattr(bpe, "MEMO_PAIRS", 2)
    codec = bpe.Codec(bpe.TOKENIZER)
    for text in random_texts(60, 3):
        assert codec.encode(text)[0].tolist() == library.encode(text, add_special_tokens=False).ids


def test_encode_and_digests_in_spark(spark, library):
    df = spark.createDataFrame([(i, t, "clash") for i, t in enumerate(ODD)], "doc_id long, text string, Token_IDs string")
    out = bpe.encoded(df)
    assert out.columns == ["doc_id", "text", "token_ids"]
    rows = out.select("*", bpe.decode("token_ids").alias("back"), bpe.digests("text").alias("d")).collect()
    for r in rows:
        want = library.encode(r.text or "", add_special_tokens=False).ids
        assert r.token_ids == want and r.back == (r.text or "") and r.d.n_tokens == len(want)
        assert r.d.ids_sha256 == hashlib.sha256(",".join(map(str, want)).encode()).hexdigest()
        assert r.d.decoded_sha256 == hashlib.sha256((r.text or "").encode()).hexdigest()
    assert bpe.encoded(df.limit(0)).count() == 0


# ---- operator 4 --------------------------------------------------------------------

def cuts_by_hand(text):
    cuts = [i + 1 for i, c in enumerate(text) if c == "\n"]
    return cuts if cuts and cuts[-1] == len(text) else [*cuts, len(text)]


def test_first_character_rule_equals_library_offsets(spark, library):
    texts = [t for t in ODD if "<|" not in (t or "")] + [t.replace("<|", "") for t in random_texts(60, 4)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.s for r in df.select("doc_id", tokencount.section_tokens("text").alias("s")).collect()}
    for i, t in enumerate(texts):
        cuts = cuts_by_hand(t or "")
        want = [0] * len(cuts)
        for start, _ in library.encode(t or "", add_special_tokens=False).offsets:
            want[bisect.bisect_right(cuts, start)] += 1
        assert [s.end_char for s in got[i]] == cuts and [int(s.n_tokens) for s in got[i]] == want
        assert [s.start_char for s in got[i]] == [0, *cuts[:-1]]


def test_sections_of_a_very_long_text(spark):
    text = "word é " * 60_000 + "\n" + "x" * 30_000 + "\n\nend"
    got = spark.createDataFrame([(text,)], "text string").select(tokencount.section_tokens("text").alias("s")).first().s
    assert [s.end_char for s in got] == cuts_by_hand(text) and len(got) == 4
    assert sum(s.n_tokens for s in got) == len(tokencount.encoder(tokencount.RANKS)[0].encode_ordinary(text))


def test_crossing_rules():
    ends, cuts = np.array([2, 6, 9]), np.array([3, 5, 9])       # the second token spans bytes 2 to 6
    run = lambda rule: [v.tolist() for v in tokencount.attribute(ends, cuts, rule)]
    assert run("first") == [[2, 0, 1], [1, 1, 1]]
    assert run("last") == [[1, 0, 2], [1, 1, 1]]
    assert run("most") == [[1, 1, 1], [1, 1, 1]]
    assert run("share") == [[1.25, .5, 1.25], [1, 1, 1]]
    assert tokencount.attribute(np.array([4]), np.array([2, 4]), "most")[0].tolist() == [1, 0]


def test_sections_of_empty_tables_and_clashing_columns(spark):
    df = spark.createDataFrame([], "doc_id long, text string, Sections int")
    assert tokencount.with_sections(df).columns == ["doc_id", "text", "sections"] and tokencount.with_sections(df).count() == 0
    with pytest.raises(ValueError):
        tokencount.section_tokens("text", rule="none")


# ---- operator 9 --------------------------------------------------------------------

def tokens_by_hand(text):
    return [w for w in re.split(rb"[\x20\x09-\x0D]+", (text or "").encode().lower()) if w] + ["end"]


def discounts_by_hand(counts):
    n = [sum(c == k for c in counts) for k in (1, 2, 3, 4)]
    if not all(n):
        return [0, .5, 1, 1.5]
    y = n[0] / (n[0] + 2 * n[1])
    found = [k - (k + 1) * y * n[k] / n[k - 1] for k in (1, 2, 3)]
    return [0] + [min(d, k) if d > 0 else k / 2 for k, d in zip((1, 2, 3), found)]


class ByHand:
    """Modified Kneser-Ney of an order, by its definition."""

    def __init__(self, texts, order=2):
        self.order, self.raw, self.words = order, Counter(), Counter()
        for t in texts:
            w = ["begin"] * (order - 1) + tokens_by_hand(t)
            self.words.update(w[order - 1:])
            self.raw.update(tuple(w[i:i + order]) for i in range(len(w) - order + 1))
        # numbers of each order: occurrences, below that distinct contexts
        self.n = {order: self.raw}
        held = set(self.raw)
        for k in range(order - 1, 0, -1):
            self.n[k] = Counter(g[1:] for g in held)
            held = {g[1:] for g in held}
        self.d = {k: discounts_by_hand(c.values()) for k, c in self.n.items()}
        self.total, self.mass = defaultdict(int), defaultdict(float)
        for k, c in self.n.items():
            for g, x in c.items():
                self.total[k, g[:-1]] += x
                self.mass[k, g[:-1]] += self.d[k][min(x, 3)]
        self.pairs = self.total[1, ()]

    def p(self, h, w):
        """h: the word before, or all of them."""
        h = h if isinstance(h, tuple) else (h,)
        p = (self.mass[1, ()] / self.pairs if self.pairs else 1.0) / (len(self.words) + 1)
        for k in range(1, self.order + 1):
            g = (*h[len(h) - k + 1:], w)
            x, total = self.n[k].get(g, 0), self.total.get((k, g[:-1]), 0)
            high = max(x - self.d[k][min(x, 3)], 0) / total if total else 0
            p = high + p if k == 1 else high + self.mass[k, g[:-1]] / total * p if total else p
        return p

    def score(self, text):
        words = tokens_by_hand(text)
        n, v = sum(self.words.values()), len(self.words)
        base = sum(math.log10((self.words.get(w, 0) + .5) / (n + .5 * (v + 1))) for w in words)
        return len(words), sum(w in self.words for w in words), base, sum(
            math.log10(self.p(tuple(line[i:i + self.order - 1]), w)) for line in [["begin"] * (self.order - 1) + words] for i, w in enumerate(words))


def lm_texts(n, seed):
    rng = random.Random(seed)
    vocabulary = [f"w{int(rng.paretovariate(.7)) % 60}" for _ in range(400)]
    return [rng.choice([" ", "\n", " \t"]).join(rng.choice(vocabulary) for _ in range(rng.randrange(30))) for _ in range(n)]


@pytest.mark.parametrize("order", [2, 3, 4])
def test_scores_equal_brute_force(spark, order):
    texts = lm_texts(120, 5) + ["", None, "W1 w1 É é", "zzz", "  "] + ["w1 w2"] * 20
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    train = [t for i, t in enumerate(texts) if zlib.crc32(str(i).encode()) % 5 != 1]
    model, hand = ngramlm.learn(df.where(ngramlm.fold() != 1), order=order), ByHand(train, order)
    assert (model.train_tokens, model.vocabulary, model.pairs) == (sum(hand.words.values()), len(hand.words), hand.pairs)
    assert all(model.cuts[k].tolist() == pytest.approx(d) for k, d in hand.d.items())
    for r in ngramlm.scored(df, model).collect():
        n, known, base, score = hand.score(r.text)
        assert (r.n_tokens, r.n_known) == (n, known)
        assert r.base_score == pytest.approx(base, rel=1e-9) and r.score == pytest.approx(score, rel=1e-9)
    # the probabilities of all words and of one unknown word sum to one in any context
    for h in [("begin",) * (order - 1), (b"w1",) * (order - 1), (b"w2",) * (order - 2) + (b"w1",), (b"nowhere",) * (order - 1)]:
        assert sum(hand.p(h, w) for w in [*hand.words, b"unknown"]) == pytest.approx(1)


def test_no_discount_is_zero(spark):
    """Many pairs counted once and four times, few three times: a plain estimate takes
    nothing from counts of three and more, and unseen words would have no probability."""
    assert ngramlm.discounts([100, 50, 10, 60]).tolist()[3] == 1.5
    texts = [f"a{i}" for i in range(100)]
    for n, many in ((2, 50), (3, 10), (4, 60)):
        texts += [f"{chr(96 + n)}x{i}" for i in range(many) for _ in range(n)]
    texts += ["lone next"] * 9
    df = spark.createDataFrame([(t,) for t in [*texts, "lone unseen"]], "text string")
    model, hand = ngramlm.learn(df.where("text <> 'lone unseen'")), ByHand(texts)
    assert all((cuts[1:] > 0).all() for cuts in model.cuts.values())
    for r in ngramlm.scored(df, model).distinct().collect():
        assert math.isfinite(r.score) and math.isfinite(r.perplexity) and r.score == pytest.approx(hand.score(r.text)[3], rel=1e-9)


def test_untrained_model_and_clashing_columns(spark):
    df = spark.createDataFrame([(1, "a b", 7.0), (2, None, 8.0)], "doc_id long, text string, Score double")
    model = ngramlm.learn(df.limit(0))
    rows = {r.doc_id: r for r in ngramlm.scored(df, model).collect()}
    assert rows[1].n_tokens == 3 and rows[2].n_tokens == 1 and rows[1].score == rows[1].base_score == 0.0
    assert ngramlm.scored(df.limit(0), model).count() == 0


def test_pieces_of_a_text_do_not_matter(monkeypatch):
    texts = lm_texts(30, 6) + ["", None, "x" * 500, " ".join("ab" for _ in range(400))]
    join = lambda parts: [np.concatenate(c).tolist() for c in zip(*parts)]
    whole = join(ngramlm.tokens(pa.array(texts), 3))
    monkeypatch.setattr(ngramlm, "PIECE", 37)
    assert join(ngramlm.tokens(pa.array(texts), 3)) == whole
    assert Counter(whole[0]) == Counter({i: len(tokens_by_hand(t)) for i, t in enumerate(texts)})


# ---- operator 10 -------------------------------------------------------------------

def language_rows(n, seed):
    rng = random.Random(seed)
    words = {"en": ["the", "thing", "house", "with", "and"], "de": ["der", "ich", "haus", "und", "über"], "xx": ["zaq", "qaz", "zzq", "wqz"]}
    return [(i, " ".join(rng.choice(words[k]) for _ in range(rng.randrange(5, 60))), k) for i in range(n) for k in [rng.choice(list(words))]]


def test_held_out_accuracy_and_undetermined(spark):
    rows = language_rows(300, 8) + [(1000, None, "en"), (1001, "123 !!", "de"), (1002, "", None), (1003, "the house and the thing", None), (None, "der und", "de")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string").withColumn("Score", F.lit("clash"))
    model = langid.learn_fold(df)
    assert model.langs == ["de", "en", "xx"]
    got = {r.doc_id: r for r in langid.identify(df, model).collect()}
    held = [r for r in rows[:300] if zlib.crc32(str(r[0]).encode()) % 5 == 0]
    assert sum(got[i].lang_pred == k for i, _, k in held) >= .99 * len(held) > 0
    assert [got[i].lang_pred for i in (1000, 1001, 1002, 1003)] == ["und", "und", "und", "en"]
    assert got[1000].score == 0 and all(0 <= r.score <= 1 for r in got.values())


def languages_by_hand(rows, s):
    """Per language, the n-grams that count as its own; no filter."""
    counts = defaultdict(Counter)
    for _, text, lang in rows:
        b = (text or "").encode()
        b = bytes(c + 32 if 65 <= c <= 90 else c for c in b)
        if lang is not None:
            counts[lang].update(b[i:i + s.n] for i in range(len(b) - s.n + 1))
    total = {k: sum(c.values()) for k, c in counts.items()}
    share = {k: {g: n / total[k] for g, n in c.items()} for k, c in counts.items()}
    most = Counter()
    for c in share.values():
        for g, x in c.items():
            most[g] = max(most[g], x)
    return {k: {g for g, x in c.items() if x >= s.min_share and x >= s.min_ratio * most[g]} for k, c in share.items()}


def language_by_hand(own, text, n):
    b = (text or "").encode()
    b = bytes(c + 32 if 65 <= c <= 90 else c for c in b)
    hits = {k: sum(b[i:i + n] in grams for i in range(len(b) - n + 1)) for k, grams in own.items()}
    return hits, sum(hits.values())


def test_op10_equals_exact_sets(spark):
    """The query's predictions and scores against sets without false answers."""
    from flumen.llm import queries
    from tests.conftest import SF_SMALL
    rows = [(d.doc_id, d.text, d.lang) for d in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()]
    s = langid.Settings()
    own = languages_by_hand([r for r in rows if zlib.crc32(str(r[0]).encode()) % 5], s)
    got = {r.doc_id: r for r in queries.QUERIES["op10_language_id"](spark, SF_SMALL).collect()}
    assert set(got) == {r[0] for r in rows}
    sure = 0
    for i, text, _ in rows:
        assert got[i].held_out == (zlib.crc32(str(i).encode()) % 5 == 0)
        if not any(c.isalpha() for c in text or ""):
            assert (got[i].lang_pred, got[i].score) == ("und", 0.0)
            continue
        hits, total = language_by_hand(own, text, s.n)
        if total < 50:
            continue
        first, second = sorted(hits.values(), reverse=True)[:2]
        assert got[i].score == pytest.approx(first / total, abs=.05)
        if first - second > .1 * total:
            sure += 1
            assert hits[got[i].lang_pred] == first
    assert sure > len(rows) // 2


def test_filter_grows_with_its_content(spark):
    rng = random.Random(3)
    text = lambda n: "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(n))
    for n in (100, 40_000):
        df = spark.createDataFrame([(1, text(n), "a"), (2, text(n), "b")], "doc_id long, text string, lang string")
        model = langid.learn(df)
        fill = np.unpackbits(model.table, axis=1, bitorder="little")[:, :2].mean(axis=0)
        assert fill.max() <= .5 and (n == 100 or fill.max() > .15)


def test_filter_returns_all_languages_of_an_ngram(spark):
    df = spark.createDataFrame([(1, "samesame", "a"), (2, "samesame", "b"), (3, "only", "c")], "doc_id long, text string, lang string")
    s = langid.Settings(n=4, min_ratio=0.1)
    model = langid.learn(df, settings=s)
    gram = lambda t: np.array([int.from_bytes(t, "little")], dtype=np.uint64)
    assert model.masks(gram(b"same"))[0, 0] == 0b011 and model.masks(gram(b"only"))[0, 0] == 0b100 and model.masks(gram(b"none"))[0, 0] == 0


def test_counts_equal_brute_force_over_pieces(spark, monkeypatch):
    texts = ["Hello", "abc", None, "ééé", "hellohello"]
    from flumen.llm.common import text_buffer
    monkeypatch.setattr(langid, "PIECE", 3)
    got = Counter()
    for grams, doc in langid.pieces(*text_buffer(pa.array(texts)), 4):
        got.update(zip(doc.tolist(), grams.tolist()))
    want = Counter((i, int.from_bytes(b[j:j + 4], "little")) for i, t in enumerate(texts) for b in [(t or "").encode().lower()] for j in range(len(b) - 3))
    assert got == want


def test_nothing_learned(spark):
    df = spark.createDataFrame([(1, "text", None)], "doc_id long, text string, lang string")
    model = langid.learn(df)
    assert [tuple(r)[3:] for r in langid.identify(df, model).collect()] == [("und", 0.0)]
    assert langid.identify(df.limit(0), model).count() == 0
