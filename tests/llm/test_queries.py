"""The registered corpus queries: oracles, contract columns, and the pipeline's stages."""

import base64
import hashlib
import os
import re
import sys
import zlib
from collections import Counter

import duckdb
import numpy as np
import public_tokenizers
import pytest
import tiktoken
from tokenizers import Tokenizer

from tests.conftest import ROOT, SF_SMALL
from tests.llm.test_dedup import fingerprint_by_hand, parts_by_hand, removed_by_hand
from tests.llm.test_match import contained_by_hand
from tests.llm.test_text import ByHand

sys.path.insert(0, os.path.join(ROOT, "tools"))
from check_oracle import TABLES, digest  # noqa: E402

import __spark_entry__ as E  # noqa: E402
import corpus_pipeline  # noqa: E402
from flumen.llm import bpe, ngramlm, queries, simhash  # noqa: E402

COLUMNS = {
    "op1_suffix_array_dedup": ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"],
    "op3_url_filters": ["page_id", "host", "path", "rule", "verdict"],
    "op5_nearest_neighbours": ["query_id", "rank", "vec_id", "score"],
    "op6_simhash_near_dedup": ["doc_id", "fingerprint", "component_id"],
    "op8_bpe_encode_decode": ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
    "op9_lm_scoring": ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"],
    "op10_language_id": ["doc_id", "held_out", "lang_pred", "score"],
    "op11_periodic_runs": ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"],
    "op12_source_divergence": ["lang", "source", "part", "item", "value", "rank"],
    "op13_rank_queue_bpe": ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
}


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet(f"{SF_SMALL}/documents.parquet").orderBy("doc_id").collect()


def test_one_query_per_operator():
    names = [k.split("_")[0] for k in queries.QUERIES]
    assert sorted(names) == sorted(f"op{n}" for n in range(1, 14))
    assert set(queries.QUERIES) | {"pipeline"} <= set(E.queries())


@pytest.mark.parametrize("key", sorted(queries.ORACLES))
def test_query_equals_oracle(spark, duck, key):
    df = queries.QUERIES[key](spark, SF_SMALL)
    cur = duck.execute(queries.ORACLES[key])
    names = [d[0] for d in cur.description]
    assert sorted(df.columns) == sorted(names)
    assert digest(df.columns, [tuple(r) for r in df.collect()])[0] == digest(names, cur.fetchall())[0]


@pytest.mark.parametrize("key", sorted(COLUMNS))
def test_contract_columns_come_first(spark, key):
    assert queries.QUERIES[key](spark, SF_SMALL).columns[:len(COLUMNS[key])] == COLUMNS[key]


def repeats_by_hand(texts):
    """Per text: what is left without strings of 400 bytes and runs of 51 words that repeat;
    and the bytes and the number of the runs of 51 words."""
    raw = [(t or "").encode() for t in texts]
    spots = [[m.span() for m in re.finditer(rb"[^\x20\x09-\x0D]+", t)] for t in raw]
    runs = [[b" ".join(t[a:z] for a, z in w[i:i + 51]) for i in range(len(w) - 50)] for t, w in zip(raw, spots)]
    strings, passages = Counter(t[i:i + 400] for t in raw for i in range(len(t) - 399)), Counter(r for own in runs for r in own)
    left, long = [], []
    for t, w, own in zip(raw, spots, runs):
        words = bytearray(len(t))
        for a, z in [(w[i][0], w[i + 50][1]) for i, r in enumerate(own) if passages[r] > 1]:
            words[a:z] = b"\1" * (z - a)
        gone = bytearray(words)
        for i in range(len(t) - 399):
            if strings[t[i:i + 400]] > 1:
                gone[i:i + 400] = b"\1" * 400
        # each kept part is decoded on its own
        cuts = [i for i in range(len(t) + 1) if i in (0, len(t)) or gone[i] != gone[i - 1]]
        left.append("".join(t[a:z].decode("utf-8", errors="ignore") for a, z in zip(cuts, cuts[1:]) if not gone[a]))
        long.append((sum(words), len(re.findall(rb"\x01+", words))))
    return left, long


def test_op1_equals_brute_force(spark, documents):
    want = removed_by_hand([(d.text or "").encode() for d in documents], 400)
    _, passages = repeats_by_hand([d.text for d in documents])
    got = {r.doc_id: tuple(r)[1:] for r in queries.QUERIES["op1_suffix_array_dedup"](spark, SF_SMALL).collect()}
    assert got == {d.doc_id: (*w, *p) for d, w, p in zip(documents, want, passages)}
    assert any(p[0] for p in passages)


def test_op4_equals_public_library(spark, documents):
    """Tokens by the character that their first byte belongs to, line by line."""
    with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    enc = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    got = {}
    for r in queries.QUERIES["op4_token_counts"](spark, SF_SMALL).collect():
        got.setdefault(r.doc_id, []).append((r.section, r.start_char, r.end_char, r.n_tokens, r.n_crossing))
    for d in documents:
        raw = (d.text or "").encode()
        ends = [m.end() for m in re.finditer(b"\n", raw)]
        ends += [len(raw)] if not ends or ends[-1] != len(raw) else []
        spans, at = [], 0
        for t in enc.encode_ordinary(d.text or ""):
            size = len(enc.decode_single_token_bytes(t))
            spans.append((at, at + size))
            at += size
        want, start = [], 0
        for i, end in enumerate(ends):
            inside = [s for s in spans if s[0] < end and s[1] > start]
            want.append((i, len(raw[:start].decode()), len(raw[:end].decode()), sum(s[0] >= start for s in inside),
                         sum(s[0] < start or s[1] > end for s in inside)))
            start = end
        assert sorted(got[d.doc_id]) == want
    assert set(got) == {d.doc_id for d in documents}


def test_op5_against_brute_force(spark):
    """Exact ranks and scores of what is found, and a recall of 0.9."""
    rows = [r for r in spark.read.parquet(f"{SF_SMALL}/embeddings.parquet").collect() if r.embedding is not None]
    ids, v = np.array([r.vec_id for r in rows]), np.array([r.embedding for r in rows], dtype=np.float64)
    got = {}
    for r in queries.QUERIES["op5_nearest_neighbours"](spark, SF_SMALL).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    assert set(got) == {i for i in ids.tolist() if i % 20 == 0}
    hit = 0
    for q, found in got.items():
        score = v @ v[ids.tolist().index(q)]
        found.sort()
        assert [f[0] for f in found] == list(range(1, 21)) and q not in {f[1] for f in found}
        assert [f[2] for f in found] == pytest.approx([score[ids.tolist().index(f[1])] for f in found])
        assert [(-f[2], f[1]) for f in found] == sorted((-f[2], f[1]) for f in found)
        score[ids == q] = -np.inf
        hit += len({f[1] for f in found} & set(ids[np.argsort(-score)[:20]].tolist()))
    assert hit >= .9 * 20 * len(got)


def test_op8_equals_public_library(spark, documents):
    library = Tokenizer.from_file(bpe.TOKENIZER)
    library.no_truncation()
    library.no_padding()
    got = {r.doc_id: tuple(r)[1:] for r in queries.QUERIES["op8_bpe_encode_decode"](spark, SF_SMALL).collect()}
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    for d in documents:
        ids = library.encode(d.text or "", add_special_tokens=False).ids
        assert got[d.doc_id] == (len(ids), sha(",".join(map(str, ids))), sha(library.decode(ids, skip_special_tokens=False)))
    assert len(got) == len(documents)


def test_op6_equals_brute_force(spark, documents):
    fps = [fingerprint_by_hand(d.text) for d in documents]
    parts = parts_by_hand(fps, 4)
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in queries.QUERIES["op6_simhash_near_dedup"](spark, SF_SMALL).collect()}
    assert got == {d.doc_id: (f"{f:016x}", documents[p].doc_id) for d, f, p in zip(documents, fps, parts)}


def test_op9_equals_brute_force(spark, documents):
    hand = ByHand([d.text for d in documents if zlib.crc32(str(d.doc_id).encode()) % 5 != 1], ngramlm.ORDER)
    for r in queries.QUERIES["op9_lm_scoring"](spark, SF_SMALL).collect():
        text = next(d.text for d in documents if d.doc_id == r.doc_id)
        n, known, base, score = hand.score(text)
        assert (r.n_tokens, r.n_known, r.train_tokens) == (n, known, sum(hand.words.values()))
        assert r.base_score == pytest.approx(base, rel=1e-9) and r.score == pytest.approx(score, rel=1e-9)
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 1)


def test_op10_held_out_accuracy(spark, documents):
    lang = {d.doc_id: d.lang for d in documents}
    rows = [r for r in queries.QUERIES["op10_language_id"](spark, SF_SMALL).collect() if r.held_out]
    assert sum(r.lang_pred == lang[r.doc_id] for r in rows) >= .95 * len(rows)


def test_pipeline_equals_stages_by_hand(spark, documents):
    """Every stage's work, done again in Python on what the stage before kept."""
    docs = [(d.doc_id, d.text) for d in documents if any(c.isalpha() for c in d.text or "")]
    parts = parts_by_hand([fingerprint_by_hand(t) for _, t in docs], 4)
    docs = [d for i, d in enumerate(docs) if parts[i] == i]
    texts, _ = repeats_by_hand([t for _, t in docs])
    docs = [(i, t) for (i, _), t in zip(docs, texts)]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").collect()]
    leaking = {d for d, *_ in contained_by_hand(docs, items)}
    codec = bpe.codec(bpe.TOKENIZER)
    want = {i: codec.encode(t)[0].tolist() for i, t in docs if i not in leaking}
    got = {r.doc_id: r.token_ids for r in corpus_pipeline.run(spark, SF_SMALL).collect()}
    assert got == want


def test_repeated_text_equals_both_rules_by_hand(spark, documents):
    """400 bytes or 51 words, both judged on the input."""
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    want, _ = repeats_by_hand([d.text for d in documents])
    got = {r.doc_id: r.text for r in corpus_pipeline.repeated_text(spark, docs, SF_SMALL).collect()}
    assert got == {d.doc_id: w for d, w in zip(documents, want)}


def test_pipeline_removes_passages_of_51_short_words(spark):
    """Over 50 words in fewer than 300 bytes; 50 words stay."""
    passage = [f"w{i:02d}" for i in range(51)]
    assert len(" ".join(passage)) < 300
    fifty = [f"v{i:02d}" for i in range(50)]
    docs = spark.createDataFrame([(1, "first " + " ".join(passage) + " one"), (2, "second " + "\n".join(passage) + " two"),
                                  (3, " ".join(fifty) + " three"), (4, " ".join(fifty) + " four")], "doc_id long, text string")
    docs = docs.selectExpr("doc_id", "text", "'en' AS lang", "'x' AS source", "length(text) AS n_chars")
    got = {r.doc_id: (r.text, r.n_chars) for r in corpus_pipeline.repeated_text(spark, docs, SF_SMALL).collect()}
    assert got[1] == ("first  one", 10) and got[2] == ("second  two", 11)
    assert got[3][0] == " ".join(fifty) + " three" and got[4][0] == " ".join(fifty) + " four"


def test_stages_keep_the_columns_of_documents(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs.limit(0), SF_SMALL).columns == docs.columns


def test_near_dedup_stage_sends_no_probes_through_the_driver(spark, monkeypatch):
    texts = [f"one two three four five six seven eight nine ten {i // 2}" for i in range(20)]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in enumerate(texts)],
                                 "doc_id long, text string, lang string, source string, n_chars long")
    asked, links = [], simhash.links
    monkeypatch.setattr(simhash, "links", lambda *a: asked.append(links(*a)) or asked[-1])
    kept = [r.doc_id for r in corpus_pipeline.near_dedup(spark, docs, "").collect()]
    assert sorted(kept) == sorted(set(parts_by_hand([fingerprint_by_hand(t) for t in texts], 4)))
    plans = [d._jdf.queryExecution().executedPlan().toString() for d in asked]
    assert len(plans) == 2 and not any("Broadcast" in p for p in plans)
