"""URL filters by a bit-parallel wildcard automaton.

Every rule becomes a glob over the canonical URL, which is a dot, the host in lower case
and the path: `**.org/**` style rules need no case of their own for subdomains.  The
positions of all globs are packed into the bits of a few 64-bit words; a batch of URLs is
read byte by byte, and one shift, two masks and an or move all globs of all URLs on.

Globs: `*` is any run without a slash, `**` any run, `?` one character but a slash; all
other characters stand for themselves.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from landgrain.llm.book import query, table
from landgrain.llm.words import parts, utf8

DEFAULT = "allow"
"""The verdict on a URL that no rule fits."""

_SLASH = ord("/")


@dataclass(frozen=True)
class Rule:
    """A verdict for a host, its subdomains and the paths that start with `path`."""

    verdict: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path

    @property
    def glob(self) -> str:
        """`*` ends at the first slash, so that no host is looked for in a path."""
        return f"*.{self.name}**"


RULES = [
    Rule("allow", "org", "/"),
    Rule("block", "example.org", "/es/"),
    Rule("block", "example.org", "/en/1"),
    Rule("allow", "com", "/fr/"),
    Rule("block", "com", "/de/"),
]


class Globs:
    """Masks of an extended Shift-And automaton for many globs.

    Bit 0 of a glob is its start; the bit of position j is set after the j-th step.
    `enter[c]` has the bits that byte c may enter from the bit below, `stay[c]` those
    that it leaves set.  `first` has the start bits and `last` the final bit of each glob.
    """

    def __init__(self, globs: Sequence[str]):
        steps = [self._steps(g) for g in globs]
        starts = np.cumsum([0, *(len(s) for s in steps)])
        self.words = max(1, -(-int(starts[-1]) // 64))
        self.enter = np.zeros((256, self.words), np.uint64)
        self.stay = np.zeros((256, self.words), np.uint64)
        self.first = np.zeros(self.words, np.uint64)
        self.last = starts[1:].astype(np.int64) - 1
        for base, glob in zip(starts.tolist(), steps):
            self.first[base >> 6] |= np.uint64(1 << (base & 63))
            for j, (enter, stay) in enumerate(glob):
                at, bit = (base + j) >> 6, np.uint64(1 << ((base + j) & 63))
                self.enter[enter, at] |= bit
                self.stay[stay, at] |= bit

    @staticmethod
    def _steps(glob: str) -> list[tuple[np.ndarray, np.ndarray]]:
        """Bytes that enter and bytes that stay at every position of a glob, the start included."""
        every, none = np.ones(256, bool), np.zeros(256, bool)
        lead, more = every.copy(), none.copy()
        lead[0x80:0xC0] = False
        lead[_SLASH] = False
        more[0x80:0xC0] = True
        no_slash = every.copy()
        no_slash[_SLASH] = False
        out = [(none, none.copy())]
        k = 0
        while k < len(glob):
            if glob[k] == "*":
                k += 1
                kind = no_slash
                if glob[k : k + 1] == "*":
                    kind, k = every, k + 1
                out[-1] = (out[-1][0], out[-1][1] | kind)
            elif glob[k] == "?":  # the bytes after the first of a character are taken by the same position
                out.append((lead, more.copy()))
                k += 1
            else:
                for byte in glob[k].encode():
                    one = none.copy()
                    one[byte] = True
                    out.append((one, none.copy()))
                k += 1
        return out

    def hits(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Which glob (column) matches which whole text (row); text k is `data[offsets[k]:offsets[k + 1]]`.

        Texts are taken longest first, so those still being read are always the first rows.
        """
        sizes = np.diff(offsets)
        order = np.argsort(-sizes, kind="stable")
        starts, sizes = offsets[:-1][order], sizes[order]
        state = np.repeat(self.first[None, :], len(order), axis=0)
        active = len(order)
        for j in range(int(sizes[0]) if len(sizes) else 0):
            while sizes[active - 1] <= j:
                active -= 1
            byte = data[starts[:active] + j]
            now = state[:active]
            moved = now << np.uint64(1)
            moved[:, 1:] |= now[:, :-1] >> np.uint64(63)
            state[:active] = (moved & self.enter[byte]) | (now & self.stay[byte])
        out = np.zeros((len(order), len(self.last)), bool)
        for g, bit in enumerate(self.last.tolist()):
            out[order, g] = (state[:, bit >> 6] >> np.uint64(bit & 63)) & np.uint64(1)
        return out


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host and path: what follows the first `://` up to `/`, `?`, `#`, A-Z lower-cased; then up to `?`, `#`.

    Both are empty for a null url and one without `://`.
    """
    both = r"(?s)^.*?://([^/?#]*)([^?#]*)"
    text = F.coalesce(url, F.lit(""))
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.translate(F.regexp_extract(text, both, 1), upper, upper.lower()), F.regexp_extract(text, both, 2)


def judge(pages: DataFrame, rules: Sequence[Rule] = tuple(RULES), default: str = DEFAULT, key: str = "page_id", url: str = "url") -> DataFrame:
    """(key, host, path, rule, verdict) of every row.

    The rule is the longest of those that fit, the alphabetically first of equally long
    ones, and null if none fits; then the verdict is `default`.  Rows that repeat and null
    keys are kept, other columns are left out, and urls are read to their end.  The masks
    grow with the rules, which are a parameter, and not with the rows.
    """
    ranked = sorted(set(rules), key=lambda r: (-len(r.name), r.name, r.verdict))
    globs = Globs([r.glob for r in ranked])
    names, verdicts = pa.array([r.name for r in ranked] + [None], pa.string()), pa.array([r.verdict for r in ranked] + [default])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b in parts(batch.column(3)):
                rest = batch.slice(a, b - a)
                hits = globs.hits(*utf8(rest.column(3)))
                best = pa.array(np.append(hits, np.ones((len(hits), 1), bool), axis=1).argmax(axis=1))
                yield pa.RecordBatch.from_arrays([*rest.columns[:3], names.take(best), verdicts.take(best)], [*rest.schema.names[:3], "rule", "verdict"])

    host, path = url_parts(F.col(url))
    kind = pages.schema[key].dataType.simpleString()
    rows = pages.select(F.col(key).alias("key"), host.alias("host"), path.alias("path"))
    rows = rows.withColumn("canonical", F.concat(F.lit("."), "host", "path"))
    return rows.mapInArrow(run, f"key {kind}, host string, path string, rule string, verdict string").withColumnRenamed("key", key)


def _check_sql() -> str:
    rules = ", ".join(f"('{r.host}', '{r.path}', '{r.verdict}')" for r in RULES)
    return f"""WITH cut AS (SELECT page_id, CASE WHEN position('://' IN url) > 0 THEN substr(url, position('://' IN url) + 3) ELSE '' END AS rest FROM pages),
        p AS (SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
                     substr(regexp_extract(rest, '^[^?#]*'), length(regexp_extract(rest, '^[^/?#]*')) + 1) AS path FROM cut),
        r AS (SELECT * FROM (VALUES {rules}) AS t(h, start, verdict))
        SELECT page_id, host, path, arg_max(h || start, length(h || start)) AS rule,
               coalesce(arg_max(verdict, length(h || start)), '{DEFAULT}') AS verdict
        FROM p LEFT JOIN r ON ('.' || host) LIKE ('%.' || h) AND starts_with(path, start)
        GROUP BY page_id, host, path"""


@query("op12_wildcard_urls", _check_sql())
def op12(spark, sf):
    return judge(table(spark, sf, "pages"))
