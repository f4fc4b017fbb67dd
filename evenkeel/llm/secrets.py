"""Secret scans: Aho-Corasick keywords, anchored expressions near hits, embedded checksums."""

from __future__ import annotations

import re
import zlib
from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from evenkeel.llm.common import carried, ship

#: Kinds in the order in which spans that start together are listed.
KINDS = ("assign", "access", "hex", "github", "npm")
SPANS = T.ArrayType(T.StructType([
    T.StructField("kind", T.StringType()), T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))

# fixed values: keywords and the expressions that are tried where one was found
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
GITHUB = re.compile(r"gh[pousr]_[A-Za-z0-9]{36}(?![A-Za-z0-9])")
NPM = re.compile(r"npm_[A-Za-z0-9]{36}(?![A-Za-z0-9])")
HEX = re.compile(r"[0-9a-f]{24,}")
KEYWORDS = {
    "assign": ("password", "passwd", "secret", "token", "apikey", "api_key"),
    "access": ("akia",), "github": ("ghp_", "gho_", "ghu_", "ghs_", "ghr_"), "npm": ("npm_",),
}
BASE62 = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"


def checksum62(body: str) -> str:
    """Six base-62 digits of the CRC-32, as such tokens carry behind their 30 characters."""
    value, digits = zlib.crc32(body.encode()), ""
    while value:
        value, digit = divmod(value, 62)
        digits = BASE62[digit] + digits
    return digits.rjust(6, "0")


def _checksummed(m: re.Match) -> bool:
    return checksum62(m[0][4:34]) == m[0][34:40]


RULES: dict[str, tuple[re.Pattern, Callable[[re.Match], bool]]] = {
    "assign": (ASSIGN, lambda m: len(m[2]) >= 6),
    "access": (ACCESS, lambda m: len(m[0]) >= 20),
    "github": (GITHUB, _checksummed),
    "npm": (NPM, _checksummed),
}


def _lowered(text: str) -> str:
    """Lower case with every character in its place."""
    low = text.lower()
    return low if len(low) == len(text) else text.translate({c: c + 32 for c in range(65, 91)})


class Scanner:
    def __init__(self):
        import ahocorasick

        self.words = ahocorasick.Automaton()
        for kind, words in KEYWORDS.items():
            for word in words:
                self.words.add_word(word, (kind, len(word)))
        self.words.make_automaton()

    def __call__(self, text: str) -> list[tuple[str, int, int]]:
        """(kind, start, end) in code points. Per kind leftmost and without overlap: a
        match that fails its check is dropped, but what it covers stays covered."""
        found = [("hex", m.start(), m.end()) for m in HEX.finditer(text)]
        covered = dict.fromkeys(RULES, 0)
        for last, (kind, size) in self.words.iter(_lowered(text)):
            start = last + 1 - size
            if start < covered[kind]:
                continue
            pattern, valid = RULES[kind]
            if m := pattern.match(text, start):
                covered[kind] = m.end()
                if valid(m):
                    found.append((kind, m.start(), m.end()))
        return sorted(found, key=lambda s: (s[1], KINDS.index(s[0])))


def redacted(text: str, spans: list[tuple[str, int, int]]) -> str:
    """The text with each stretch of spans replaced by the kind of its first."""
    out, at = [], 0
    for kind, start, end in spans:
        if start >= at:
            out += [text[at:start], f"<{kind}>"]
        at = max(at, end)
    return "".join([*out, text[at:]])


def scan_secrets(docs: DataFrame, text: str = "text", keep: list[str] | None = None, redact: bool = False) -> DataFrame:
    """The columns ``keep`` (all by default) with ``spans``, an array of (kind, start, end)
    in code points, by start and then kind; a column of that name is replaced. With
    ``redact``, secrets in the text column are replaced by their kinds.

    ``assign``, ``access`` and ``hex`` are the base; ``github`` and ``npm`` tokens count
    only if their embedded CRC-32 agrees. Null text has no spans and stays null. Rows
    are independent: repeated rows are scanned alike, an empty table gives no rows.
    """
    ship(docs.sparkSession)
    kept = [c for c in (docs.columns if keep is None else keep) if c != "spans"]
    source = docs.select(*carried(kept), docs[text].alias("_text"))
    schema = T.StructType([*(docs.schema[c] for c in kept), T.StructField("spans", SPANS)])
    return source.mapInArrow(_scan(kept, text if redact else None), schema)


def _scan(kept: list[str], replace: str | None):
    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        scan = Scanner()
        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
        for batch in batches:
            columns = dict(zip(kept, batch.columns[:-1]))
            texts = batch.columns[-1].to_pylist()
            spans = [scan(t) if t else [] for t in texts]
            if replace:
                columns[replace] = pa.array([redacted(t, s) if s else t for t, s in zip(texts, spans)], pa.string())
            rows = [[{"kind": k, "start": a, "end": b} for k, a, b in s] for s in spans]
            yield pa.RecordBatch.from_arrays([*columns.values(), pa.array(rows, kind)], [*columns, "spans"])
    return run
