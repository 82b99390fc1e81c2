"""Token counts per section by offset-mapped attribution (operator 4).

A whole document is encoded once. Token lengths, summed up, give every token's byte
span; the sections are byte spans of the same text; both are sorted, so the interval
join is one binary search per boundary. A token that crosses a boundary is given out
by an explicit rule:

* ``first``: to the section that holds its first character;
* ``last``: to the section that holds its last character;
* ``most``: to the section that holds most of its bytes, of equals to the earliest;
* ``share``: to each section by its share of the token's bytes.

Sections end after each match of a pattern (a newline by default), so they cover the
text; an empty or null text is one empty section without tokens. Spans are reported
in characters. The vocabulary (a rank file) is read by each worker from ``path``;
special tokens' names are ordinary text here. A document is handled whole in one
task, whatever its length; nothing is shuffled. Repeated rows are counted alike. An empty
table gives an empty result; a column that clashes with the result's gives way.
"""

from __future__ import annotations

import base64
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flumen.llm.common import arrow_udf, replaced
from flumen.sources.tables import load

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
RULES = ("first", "last", "most", "share")
SECTIONS = "array<struct<section:int,start_char:bigint,end_char:bigint,n_tokens:double,n_crossing:bigint>>"


@lru_cache(maxsize=2)
def encoder(path: str) -> tuple[tiktoken.Encoding, np.ndarray]:
    """The encoder and the byte length of each token, once per worker."""
    with open(path, "rb") as f:
        ranks = {base64.b64decode(t): int(n) for t, n in map(bytes.split, f)}
    size = np.zeros(max(ranks.values()) + 1, dtype=np.int64)
    for t, n in ranks.items():
        size[n] = len(t)
    return tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}), size


def attribute(ends: np.ndarray, cuts: np.ndarray, rule: str) -> tuple[np.ndarray, np.ndarray]:
    """(tokens, crossing tokens) of each section. ends: the tokens' end offsets;
    cuts: the sections' end offsets, the last one the text's."""
    starts = np.concatenate(([0], ends[:-1])) if len(ends) else ends
    n = len(cuts)
    low = np.searchsorted(cuts, starts, side="right")           # the section of the first byte
    high = np.searchsorted(cuts, ends - 1, side="right")        # that of the last
    crossing = np.zeros(n, dtype=np.int64)
    over = np.flatnonzero(high > low)
    # a crossing token is counted as such in every section that it touches
    np.add.at(crossing, low[over], 1)
    step = np.zeros(n + 1, dtype=np.int64)
    np.add.at(step, low[over] + 1, 1)
    np.add.at(step, high[over] + 1, -1)
    crossing += np.cumsum(step[:n])
    if rule in ("first", "last"):
        return np.bincount(low if rule == "first" else high, minlength=n).astype(float), crossing
    inside = np.ones(len(ends), dtype=bool)
    inside[over] = False
    tokens = np.bincount(low[inside], minlength=n).astype(float)
    for t in over:
        edges = np.concatenate(([starts[t]], cuts[low[t]:high[t]], [ends[t]]))
        part = np.diff(edges)
        if rule == "most":
            tokens[low[t] + int(part.argmax())] += 1
        else:
            tokens[low[t]:high[t] + 1] += part / part.sum()
    return tokens, crossing


def sections_of(text: str, path: str, cut: regex.Pattern, rule: str):
    """(end in bytes turned to characters, tokens, crossing) of each section."""
    enc, size = encoder(path)
    raw = text.encode("utf-8")
    ends = np.cumsum(size[enc.encode_to_numpy(text)]) if text else np.zeros(0, dtype=np.int64)
    cuts = np.array([m.end() for m in cut.finditer(raw) if m.end() > m.start()], dtype=np.int64)
    if not len(cuts) or cuts[-1] != len(raw):
        cuts = np.append(cuts, len(raw))
    tokens, crossing = attribute(ends, cuts, rule)
    chars = cuts
    if not text.isascii():
        leads = np.concatenate(([0], np.cumsum((np.frombuffer(raw, dtype=np.uint8) & 0xC0) != 0x80)))
        chars = leads[cuts]
    return chars, tokens, crossing


def section_tokens(text: str | Column, cut: str = r"\n", rule: str = "first", path: str = RANKS) -> Column:
    """array of (section, start_char, end_char, n_tokens, n_crossing), in text order.
    ``cut`` is a pattern over the UTF-8 bytes; matches end at character borders."""
    if rule not in RULES:
        raise ValueError(f"rule is one of {', '.join(RULES)}")
    pattern = regex.compile(cut.encode("utf-8"))

    @arrow_udf(SECTIONS)
    def run(column: pa.Array) -> pa.Array:
        found = [sections_of(x.as_py() or "", path, pattern, rule) for x in column]
        offsets = np.concatenate(([0], np.cumsum([len(f[0]) for f in found]))).astype(np.int32)
        join = lambda parts, kind: np.concatenate([np.asarray(p, dtype=kind) for p in parts]) if parts else np.zeros(0, dtype=kind)
        ends = join([f[0] for f in found], np.int64)
        starts = join([np.concatenate(([0], f[0][:-1])) for f in found], np.int64)
        number = join([np.arange(len(f[0])) for f in found], np.int32)
        rows = pa.StructArray.from_arrays(
            [pa.array(number), pa.array(starts), pa.array(ends), pa.array(join([f[1] for f in found], float)), pa.array(join([f[2] for f in found], np.int64))],
            names=["section", "start_char", "end_char", "n_tokens", "n_crossing"])
        return pa.ListArray.from_arrays(pa.array(offsets), rows)
    return run(text)


def with_sections(docs: DataFrame, text_col: str = "text", **options) -> DataFrame:
    """``docs`` with the array column ``sections``; a column of that name gives way."""
    return replaced(docs, sections=section_tokens(F.col(text_col), **options))


def query(spark, sf_dir: str) -> DataFrame:
    """op4: tokens of every line of every document, crossing tokens to the line of
    their first character."""
    docs = with_sections(load(spark, sf_dir, "documents").select("doc_id", "text"))
    rows = docs.select("doc_id", F.inline_outer("sections"))
    return rows.select("doc_id", "section", "start_char", "end_char", F.col("n_tokens").cast("long").alias("n_tokens"), "n_crossing")
