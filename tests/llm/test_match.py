"""Decontamination, URL rules, nearest neighbours and licence scans against brute force."""

import random
import re

import numpy as np
import pyarrow as pa
import pytest
import regex

from flumen.llm import ann, decontaminate, licences, urlfilter

# ---- operator 2 --------------------------------------------------------------------


def words_by_hand(text):
    unparted = "".join(rf"\p{{{s}}}" for s in decontaminate.SCRIPTS)
    return regex.findall(rf"[{unparted}&&[\p{{L}}\p{{N}}]]|[\p{{L}}\p{{N}}--[{unparted}]]+", (text or "").lower(), regex.V1)


def runs_by_hand(w, n):
    return {" ".join(w[i:i + n]) for i in range(len(w) - n + 1)}


def contained_by_hand(docs, items, threshold=0.8):
    out = set()
    asked = [(i, words_by_hand(item)) for i, item in items]
    asked = [(i, min(5, len(w)), runs_by_hand(w, min(5, len(w)))) for i, w in asked if w]
    for d, text in docs:
        w = words_by_hand(text)
        runs = {n: runs_by_hand(w, n) for n in {n for _, n, _ in asked}}
        for i, n, s in asked:
            held = runs[n]
            if len(s & held) >= threshold * len(s) - 1e-9:
                out.add((d, i, len(s), len(s & held)))
    return out


@pytest.mark.parametrize("limit", [10**6, 0])
def test_containment_equals_brute_force(spark, monkeypatch, limit):
    monkeypatch.setattr(decontaminate, "BROADCAST_ROWS", limit)         # with and without broadcasts
    rng = random.Random(4)
    vocabulary = [f"w{i}" for i in range(300)]
    items = [(i, " ".join(rng.choice(vocabulary) for _ in range(rng.randrange(1, 40)))) for i in range(25)] + [(90, None), (91, " ..."), (92, "Two words"), (3, "other text with the same id")]
    docs = []
    for d in range(60):
        w = [rng.choice(vocabulary) for _ in range(rng.randrange(80))]
        if d % 2:
            passage = (rng.choice(items)[1] or "").split()
            source = (rng.choice(items)[1] or "").upper().split()
            for _ in range(rng.randrange(3)):
                if source:
                    source[rng.randrange(len(source))] = rng.choice(vocabulary)
            w[len(w) // 2:len(w) // 2] = source + passage
        docs.append((d if d else None, ", ".join(w)))
    docs += [(100, None), (101, ""), (5, docs[5][1]), (102, "two WORDS")]
    d = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    i = spark.createDataFrame(items, "item_id long, text string")
    got = {(r.doc_id, r.item_id, r.n_shingles, r.n_found) for r in decontaminate.contained(d, i).collect()}
    want = contained_by_hand(docs, items)
    assert got == want and len(want) > 10
    left = sorted(r.doc_id or -1 for r in decontaminate.clean(d, i).collect())
    leaking = {x[0] for x in want}
    assert left == sorted((k or -1) for k, _ in docs if k not in leaking)


def test_short_items_and_scripts_without_blanks(spark):
    items = [(1, "the quick brown fox"), (2, "狐は茶色で速い"), (3, "fox"), (4, "สวัสดี"), (5, "one two three four five")]
    docs = [(1, "There: The quick, brown FOX jumps over eleven words of a text"), (2, "この狐は茶色で速いです"), (3, "foxes 狐は茶色で"),
            (4, "he said สวัสดีครับ twice"), (5, "one two three four"), (6, "quick brown " * 20_000 + "fox"), (7, None)]
    d, i = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    got = {(r.doc_id, r.item_id, r.n_shingles, r.n_found) for r in decontaminate.contained(d, i).collect()}
    assert got == contained_by_hand(docs, items)
    assert {x[:2] for x in got} == {(1, 1), (1, 3), (2, 2), (4, 4), (6, 3)}
    kept = {r.doc_id for r in decontaminate.clean(d.withColumn("__own_0", d.doc_id), i).collect()}
    assert kept == {3, 5, 7}


def test_sketch_never_misses():
    """A document may miss a share of 1 - t; the sketch has one hash more than that."""
    for n in range(1, 2000):
        largest = 1 << (n - 1).bit_length()
        assert int((largest * (1 - 0.8)) + 1e-9) + 1 > n - -(-4 * n // 5)


def test_empty_sides_and_clashing_columns(spark):
    d = spark.createDataFrame([(1, "a b c d e f", "x")], "doc_id long, text string, item_id string")
    i = spark.createDataFrame([(1, "a b c d e f")], "item_id long, text string")
    assert decontaminate.clean(d, i.limit(0)).collect() == d.collect()
    odd = d.withColumn("__doc", d.doc_id).withColumn("__own_0", d.doc_id)
    assert decontaminate.clean(odd, i.limit(0)).collect() == odd.collect()
    assert decontaminate.clean(d, i).count() == 0 and decontaminate.clean(d.limit(0), i).columns == d.columns


# ---- operator 3 --------------------------------------------------------------------

def glob_pattern(glob):
    out, i = "", 0
    while i < len(glob):
        if glob[i] == "*":
            run = len(glob[i:]) - len(glob[i:].lstrip("*"))
            out += ".*" if run > 1 else "[^/]*"
            i += run
            continue
        if glob[i] == "?":
            out += "[^/]"
        else:
            i += glob[i] == "\\" and i + 1 < len(glob)
            out += re.escape(glob[i])
        i += 1
    return re.compile(out, re.S)


def test_globs_equal_regular_expressions():
    rng = random.Random(2)
    for _ in range(25):
        globs = ["".join(rng.choice(["a", "b", "/", "é", "*", "**", "?", ".", "\\*"]) for _ in range(rng.randrange(12))) for _ in range(40)]
        texts = ["".join(rng.choice("ab/é.*") for _ in range(rng.randrange(14))) for _ in range(40)] + [None]
        found = urlfilter.Automaton(globs).matches(pa.array(texts))
        want = [[bool(glob_pattern(g).fullmatch(t or "")) for g in globs] for t in texts]
        assert found.tolist() == want


def test_url_parts_rules_and_clashing_columns(spark):
    cases = {"http://EX.Net": ("ex.net", "", None, "allow"), "https://example.com/en/x?y": ("example.com", "/en/x", "example.com/en/", "block"),
             "https://b.www.example.com/en/#t": ("b.www.example.com", "/en/", "www.example.com/en/", "allow"), "x://net/es/1": ("net", "/es/1", "net/es/", "block"),
             "nohost": ("", "", None, "allow"), "": ("", "", None, "allow"), None: ("", "", None, "allow"), "http://evil.org/x.com/foo": ("evil.org", "/x.com/foo", None, "allow"),
             "http://example.com?x": ("example.com", "", None, "allow"), "http://xcom/": ("xcom", "/", None, "allow"), "http://a.com/": ("a.com", "/", "com/", "allow"),
             "http://ads-track.org": ("ads-track.org", "", None, "block"), "a://b://c.net/es/": ("b:", "//c.net/es/", None, "allow"),
             "http://example.com/" + "é" * 50_000: ("example.com", "/" + "é" * 50_000, "com/", "allow")}
    df = spark.createDataFrame([(i, u, "clash") for i, u in enumerate([*cases, "nohost"])], "page_id long, url string, RULE string")
    got = [(r.host, r.path, r.rule, r.verdict) for r in urlfilter.judge(df, urlfilter.RULES, urlfilter.BLOCKED).orderBy("page_id").collect()]
    assert got == [*cases.values(), cases["nohost"]]
    assert urlfilter.judge(df.limit(0), urlfilter.RULES).count() == 0
    odd = df.selectExpr("*", "1 AS __m", "2 AS __host", "3 AS __PATH", "4 AS __own_0")
    assert {tuple(r)[-8:-4] for r in urlfilter.judge(odd, urlfilter.RULES).collect()} == {(1, 2, 3, 4)}
    tie = [urlfilter.Rule("block", "b.com", "/"), urlfilter.Rule("allow", "b.com", "/")]
    assert [r.verdict for r in urlfilter.judge(spark.createDataFrame([("http://b.com/",)], "url string"), tie).collect()] == ["block"]


# ---- operator 5 --------------------------------------------------------------------

def test_all_candidates_ties_and_unusable_vectors(spark):
    rng = np.random.default_rng(1)
    v = rng.normal(size=(90, 7)).astype(np.float32)
    v[10:40] = v[10]                                    # equal vectors: ties go to the smaller id
    rows = [(int(i), v[i].tolist(), "x") for i in range(90)]
    rows += [(200, None, "x"), (201, [0.0] * 7, "x"), (202, [1.0, None] + [0.0] * 5, "x"), (203, [float("nan")] + [1.0] * 6, "x"), (204, [float("inf")] * 7, "x"),
             (205, [1.0], "x"), (None, v[3].tolist(), "x"), (20, v[20].tolist(), "x"), (220, [0.0] * 7, "x")]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, rank string").repartition(4)
    got = {}
    for r in ann.neighbours(df, settings=ann.Settings(centroids=4, share=1.0)).collect():
        got.setdefault(r.query_id, {})[r["rank"]] = (r.vec_id, r.score)
    x = v.astype(np.float64)
    assert set(got) == {0, 20, 40, 60, 80}
    for q, found in got.items():
        score = (x * x[q]).sum(axis=1)
        want = sorted((i for i in range(90) if i != q), key=lambda i: (-score[i], i))[:20]
        assert [found[k][0] for k in range(1, 21)] == want
        assert [found[k][1] for k in range(1, 21)] == pytest.approx([score[i] for i in want], abs=1e-12)


def test_recall_and_blocks(spark):
    rng = np.random.default_rng(2)
    v = rng.normal(size=(1500, 16))
    v[300:900] = v[300] + rng.normal(scale=.05, size=(600, 16))         # one crowded cell
    df = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(v)], "vec_id long, embedding array<double>")
    s = ann.Settings(centroids=8, least=0, block=200, chunk=30)
    index = ann.Index(df, "vec_id", "embedding", s)
    sizes = [r["count"] for r in index.entries.select(index._part(index.blocks).alias("b")).groupBy("b").count().collect()]
    assert sum(sizes) == 1500 and max(sizes) <= 1.5 * 1500 / index.blocks
    hit = total = 0
    for q, rows in _by_query(index.search(index.entries.where("vec_id % 20 = 0"), 20)):
        score = v @ v[q]
        score[q] = -np.inf
        hit += len(set(np.argsort(-score)[:20]) & set(rows))
        total += 20
    assert hit >= .9 * total


@pytest.mark.parametrize("sigma", [0.3, 0.7])
def test_recall_with_norms_that_differ(spark, sigma):
    """Largest inner products are those of long vectors, far from the query."""
    rng = np.random.default_rng(5)
    v = rng.normal(size=(4000, 32))
    v *= np.exp(rng.normal(scale=sigma, size=(4000, 1))) / np.linalg.norm(v, axis=1, keepdims=True)
    df = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(v)], "vec_id long, embedding array<double>")
    hit = total = 0
    for q, rows in _by_query(ann.neighbours(df, settings=ann.Settings(least=0))):
        score = v @ v[q]
        score[q] = -np.inf
        hit += len(set(np.argsort(-score)[:20]) & set(rows))
        total += 20
    assert total == 4000 and hit >= .9 * total


def test_clustered_vectors_have_short_walks(spark):
    """The measured share follows the data, and blocks out of a query's reach do not see it."""
    rng = np.random.default_rng(9)
    centre = rng.normal(size=(40, 16))
    v = centre[rng.integers(0, 40, 4000)] + .1 * rng.normal(size=(4000, 16))
    v /= np.linalg.norm(v, axis=1, keepdims=True)
    df = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(v)], "vec_id long, embedding array<double>")
    s = ann.Settings(least=0, block=250, least_blocks=1, chunk=20)
    index = ann.Index(df, "vec_id", "embedding", s)
    assert index.share(20) < .2
    hit = 0
    found = _by_query(index.search(index.entries.where("vec_id % 20 = 0"), 20))
    for q, rows in found:
        score = v @ v[q]
        score[q] = -np.inf
        hit += len(set(np.argsort(-score)[:20]) & set(rows))
    assert len(found) == 200 and hit >= .9 * 4000


def _by_query(df):
    found = {}
    for r in df.collect():
        found.setdefault(r.query_id, []).append(r.vec_id)
    return found.items()


def test_walk_goes_by_summed_distance():
    rng = np.random.default_rng(3)
    for _ in range(50):
        one, two, sizes = rng.random(5), rng.random(6), rng.integers(0, 4, (5, 6))
        cells = sorted((one[i] + two[j], int(sizes[i, j])) for i in range(5) for j in range(6))
        need, got, want = int(rng.integers(1, 40)), 0, None
        for want, n in cells:
            got += n
            if got >= need:
                break
        assert ann.reach(one, two, sizes, need) == pytest.approx(want)


def test_empty_vectors(spark):
    df = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert ann.neighbours(df).count() == 0


# ---- operator 7 --------------------------------------------------------------------

def test_licences_by_ordered_rules(spark):
    s = licences.SENTENCES
    mit, bsd = [s[1], s[2], s[3]], [s[23], s[24], s[25]]
    texts = ["Prose.\nReleased under the MIT License.\nMore prose.", " ".join(mit), "\n".join(["MIT License"] + mit), "\n\n".join(bsd), "\n".join(bsd + [s[26]]),
             s[24], "see: all RIGHTS reserved! Released under the MIT license.", "the MIT License", "", None, "x " * 30_000 + "\nAll rights reserved.", s[28],
             " ".join([s[12], s[13]]), " ".join(["This program is free software;", s[14], s[15]]),
             "Released under the MIT License. Released under the MIT License."]
    want = [["MIT"], ["MIT"], ["MIT"], ["BSD-2-Clause"], ["BSD-3-Clause"], [], ["MIT", "Proprietary"], [], [], [], ["Proprietary"], ["MPL-2.0"], ["GPL-3.0-or-later"], ["GPL-2.0-or-later"], ["MIT"]]
    df = spark.createDataFrame([(i, t, "clash") for i, t in enumerate(texts)], "doc_id long, text string, Licences string")
    rows = licences.scan(df).orderBy("doc_id").collect()
    assert [r.licences for r in rows] == want
    assert [r.n_unused for r in rows] == [0, 0, 0, 0, 0, 1] + [0] * 9
    assert rows[2].sentence_ids == [1, 2, 3] and rows[9].sentence_ids == []
    assert licences.scan(df.limit(0)).count() == 0


def test_wrapped_licences(spark):
    """As published: wrapped at 78 columns, indented, or in comments."""
    import textwrap
    s = licences.SENTENCES
    full = {"MIT": (1, 2, 3), "BSD-3-Clause": (23, 24, 25, 26), "GPL-3.0-or-later": (12, 13, 17, 18), "ISC": (27,), "Apache-2.0": (7, 8, 9, 10)}
    texts, want = [], []
    for name, run in full.items():
        wrapped = "\n".join(textwrap.wrap(" ".join(s[i] for i in run), 78))
        if 9 in run:                        # the address stands in a paragraph of its own
            wrapped = "\n".join([*textwrap.wrap(" ".join(s[i] for i in run[:3]), 78), "", "http://www.apache.org/licenses/LICENSE-2.0", "", *textwrap.wrap(s[10], 78)])
        for mark, end in [("", "\n"), ("    ", "\n"), ("# ", "\n"), (" * ", "\n"), ("// ", "\r\n")]:
            texts.append(f"A Title\n{mark}\n" + end.join(mark + x for x in wrapped.split("\n")) + "\n\nProse.")
            want.append(([name], list(run)))
    # a blank line or the end of a sentence parts lines; lines of one sentence each still count
    cut = s[27].replace("any purpose", "any\n\npurpose"), s[6] + "\nthe License", "All rights\nreserved.", "All rights.\nreserved."
    texts += cut
    want += [([], []), (["Apache-2.0"], [6]), (["Proprietary"], [30]), ([], [])]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = licences.scan(df).orderBy("doc_id").collect()
    assert [(r.licences, r.sentence_ids) for r in rows] == want


def test_every_rule_wrapped_and_as_its_oracle(spark, tmp_path):
    """Each rule's sentences, one a paragraph, wrapped in comments; the SQL says the same,
    also of shuffled lines and of sentences that begin inside others."""
    import textwrap

    import duckdb
    s, rng = licences.SENTENCES, random.Random(7)
    texts = ["\n\n".join("\n".join("## " + x for x in textwrap.wrap(s[i], 60)) for i in run) for _, run in licences.RULES]
    rules = len(texts)
    lines = [x for t in texts for x in t.split("\n")]
    for _ in range(150):
        some = [rng.choice([rng.choice(lines), s[rng.choice(list(s))], "prose", "", "a; b", "x. "]) for _ in range(rng.randrange(25))]
        texts.append(rng.choice(["\n", "\r\n", " \n\t"]).join(some))
    texts += [None, "", "\n", "Licensed under the Apache License,\nVersion 2.0 (the \"License\");"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = df.transform(licences.scan).orderBy("doc_id").collect()
    for (name, _), r in zip(licences.RULES, got):
        assert name in r.licences, (name, r)
    assert rules == len(licences.RULES)
    df.coalesce(1).write.parquet(str(tmp_path / "documents"))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{tmp_path}/documents/*.parquet')")
    said = sorted(con.execute(licences.ORACLE).fetchall())
    assert said == [(r.doc_id, len(r.sentence_ids), ",".join(map(str, r.sentence_ids)), ",".join(r.licences), r.n_unused) for r in got]


def test_known_sentences_are_distinct():
    names = [max(licences.normalised(s), key=len) for s in licences.SENTENCES.values()]
    assert len(set(names)) == len(names) and all(len(n.split()) >= 3 for n in names)
