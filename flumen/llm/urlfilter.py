"""URL filters by a bit-parallel wildcard automaton (operator 3).

All glob rules are packed into one row of 64-bit words, a bit per pattern element
and one for each pattern's start. Reading a byte ``c`` of a canonical URL updates
every pattern at once: ``D = ((D << 1) & ACCEPT[c]) | (D & STAY[c])``, with carries
from word to word. A batch of URLs is simulated together, one byte of all of them a
step. Globs match the whole canonical URL (host and path): ``?`` is one character
but ``/``, ``*`` any run without ``/``, ``**`` any run; a backslash takes the next
character as it is.

The rules are a small list in the job's code; the URLs are never shuffled.

Nulls: a null url, or one without ``://``, has empty host and path. Urls may be of
any length: a batch is cut so that its bytes stay bounded. Ties of equally long
rules go to the rule that stands first. Repeated rows are judged alike. An empty table
gives an empty result.
"""

from __future__ import annotations

import string
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flumen.llm.common import arrow_udf, replaced, text_buffer, unused
from flumen.sources.tables import load

ALLOW, BLOCK = "allow", "block"
_ROWS = 1 << 14                     # URLs simulated together


@dataclass(frozen=True)
class Rule:
    """A host with all its subdomains, and a path prefix."""
    action: str
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path

    @property
    def globs(self) -> list[str]:
        plain = escape(self.text) + "**"
        return [plain, "*." + plain]


def escape(text: str) -> str:
    return "".join("\\" + c if c in "\\*?" else c for c in text)


def elements(glob: str) -> tuple[list[bytes | None], list[int]]:
    """The pattern as elements (a byte, or None for any character but ``/``) and the
    wildcard that follows each prefix of it: 0 none, 1 ``*``, 2 ``**``."""
    out: list[bytes | None] = []
    after = [0]
    i = 0
    while i < len(glob):
        c = glob[i]
        if c == "*":
            run = len(glob[i:]) - len(glob[i:].lstrip("*"))
            after[-1] = max(after[-1], min(run, 2))
            i += run
            continue
        if c == "?":
            out.append(None)
            after.append(0)
        else:
            if c == "\\" and i + 1 < len(glob):
                i += 1
                c = glob[i]
            for b in c.encode("utf-8"):
                out.append(bytes([b]))
                after.append(0)
        i += 1
    return out, after


class Automaton:
    """The masks of a list of globs."""

    def __init__(self, globs: list[str]):
        parsed = [elements(g) for g in globs]
        size = sum(len(a) for _, a in parsed)
        self.count, self.words = len(globs), max(1, -(-size // 64))
        self.accept = np.zeros((256, self.words), dtype=np.uint64)
        self.stay = np.zeros((256, self.words), dtype=np.uint64)
        self.start = np.zeros(self.words, dtype=np.uint64)
        self.final = np.zeros((self.count, 2), dtype=np.int64)
        slash, follows = ord("/"), np.arange(0x80, 0xC0)
        leads = np.array([b for b in range(256) if b != slash and not 0x80 <= b < 0xC0])
        at = 0
        for n, (items, after) in enumerate(parsed):
            for i, wild in enumerate(after):
                word, bit = divmod(at + i, 64)
                one = np.uint64(1) << np.uint64(bit)
                if i == 0:
                    self.start[word] |= one
                elif items[i - 1] is None:
                    self.accept[leads, word] |= one
                    self.stay[follows, word] |= one         # the rest of that character
                else:
                    self.accept[items[i - 1][0], word] |= one
                if wild:
                    self.stay[:, word] |= one
                    if wild == 1:
                        self.stay[slash, word] &= ~one
            at += len(after)
            self.final[n] = divmod(at - 1, 64)

    def _run(self, data: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
        """[URLs, patterns] matches; ``size`` falls."""
        state = np.repeat(self.start[None, :], len(start), axis=0)
        live = len(start)
        for t in range(int(size[0]) if len(size) else 0):
            while live and size[live - 1] <= t:
                live -= 1
            c = data[start[:live] + t]
            now = state[:live]
            shifted = now << np.uint64(1)
            shifted[:, 1:] |= now[:, :-1] >> np.uint64(63)
            state[:live] = (shifted & self.accept[c]) | (now & self.stay[c])
        word, bit = self.final[:, 0], self.final[:, 1].astype(np.uint64)
        return (state[:, word] >> bit) & np.uint64(1) == 1

    def matches(self, column: pa.Array) -> np.ndarray:
        """[rows, patterns] of a string column; null is empty."""
        data, offsets = text_buffer(column)
        size = np.diff(offsets)
        order = np.argsort(-size, kind="stable")
        out = np.zeros((len(size), self.count), dtype=bool)
        for at in range(0, len(order), _ROWS):
            rows = order[at:at + _ROWS]
            out[rows] = self._run(data, offsets[:-1][rows], size[rows])
        return out


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased."""
    return F.translate(F.regexp_extract(_rest(url), r"^([^/?#]*)", 1), string.ascii_uppercase, string.ascii_lowercase)


def path_of(url: Column) -> Column:
    """What follows the host, up to ``?``, ``#`` or the end."""
    return F.regexp_extract(_rest(url), r"^[^/?#]*([^?#]*)", 1)


def _rest(url: Column) -> Column:
    at = F.locate("://", url)
    return F.coalesce(F.when(at > 0, F.substring(url, at + 3, F.length(url))), F.lit(""))


def glob_matches(text: str | Column, globs: list[str]) -> Column:
    """array<int>: indices of the globs that match the whole text."""
    automaton = Automaton(globs)

    @arrow_udf("array<int>")
    def run(column: pa.Array) -> pa.Array:
        found = automaton.matches(column)
        ends = np.concatenate(([0], np.cumsum(found.sum(axis=1)))).astype(np.int32)
        return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.nonzero(found)[1].astype(np.int32)))
    return run(text)


def judge(pages: DataFrame, rules: list[Rule], blocked: list[str] = (), default: str = ALLOW,
          url_col: str = "url") -> DataFrame:
    """``pages`` with host, path, rule and verdict. The longest rule that fits decides;
    where none does, a glob of ``blocked`` that matches blocks, else ``default``
    holds. Columns of ``pages`` with these names give way."""
    ranked = sorted(rules, key=lambda r: -len(r.text))          # stable: ties keep their order
    globs = [g for r in ranked for g in r.globs] + list(blocked)
    host, path, hits = unused(pages, 3)
    sides = pages.withColumns({host: host_of(F.col(url_col)), path: path_of(F.col(url_col))})
    found = sides.withColumn(hits, glob_matches(F.concat(host, path), globs))
    # each rule has two globs; the first match belongs to the longest rule
    first = F.try_element_at(hits, F.lit(1))
    n = (first / F.lit(2)).cast("int")
    fits = first < F.lit(2 * len(ranked))
    pick = lambda values: F.element_at(F.array(*[F.lit(v) for v in values]), n + 1) if values else F.lit(None).cast("string")
    out = replaced(found, host=F.col(host), path=F.col(path),
                   rule=F.when(fits, pick([r.text for r in ranked])),
                   verdict=F.when(fits, pick([r.action for r in ranked])).when(first.isNotNull(), F.lit(BLOCK)).otherwise(F.lit(default)))
    return out.drop(host, path, hits)


RULES = [Rule(ALLOW, "com", "/"), Rule(BLOCK, "example.com", "/en/"), Rule(ALLOW, "www.example.com", "/en/"),
         Rule(BLOCK, "net", "/es/"), Rule(BLOCK, "net", "/fr/")]
#: Hosts of advertising and spam, where no rule says otherwise.
BLOCKED = ["*ads-track**", "*cheap-pills**"]


def query(spark, sf_dir: str) -> DataFrame:
    """op3: every page's host, path, rule and verdict."""
    pages = load(spark, sf_dir, "pages").select("page_id", "url")
    return judge(pages, RULES, BLOCKED).select("page_id", "host", "path", "rule", "verdict")


ORACLE = f"""
WITH u AS (
  SELECT row_number() OVER () AS n, page_id,
         CASE WHEN url IS NULL OR strpos(url, '://') = 0 THEN '' ELSE substr(url, strpos(url, '://') + 3) END AS rest
  FROM pages
), s AS (
  SELECT n, page_id, translate(regexp_extract(rest, '^([^/?#]*)', 1), '{string.ascii_uppercase}', '{string.ascii_lowercase}') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
  FROM u
), rules(verdict, h, p) AS (VALUES {", ".join(f"('{r.action}', '{r.host}', '{r.path}')" for r in RULES)}
), best AS (
  SELECT n, arg_max(h || p, length(h || p)) AS rule, arg_max(rules.verdict, length(h || p)) AS verdict
  FROM s JOIN rules ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p)
  GROUP BY n
)
SELECT page_id, host, path, rule,
       coalesce(verdict, CASE WHEN contains(host, 'ads-track') OR contains(host, 'cheap-pills') THEN 'block' ELSE 'allow' END) AS verdict
FROM s LEFT JOIN best USING (n)
"""
