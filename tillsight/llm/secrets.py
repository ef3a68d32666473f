"""Secret scan: an Aho-Corasick automaton finds keywords, and regular expressions are tried only there.

Kinds with a checksum inside (tokens whose last six characters are the CRC-32 of the rest in
base 62) are reported only if it holds.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from .common import portions, table

#: Kinds in the order in which spans with equal starts are listed; the first three are the base.
KINDS = ("assign", "access", "hex", "github", "npm")
BASE_KINDS = KINDS[:3]

_ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.A | re.I
)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_CHECKED = {"github": re.compile(r"gh[pousr]_([A-Za-z0-9]{30})([A-Za-z0-9]{6})(?![A-Za-z0-9])"),
            "npm": re.compile(r"npm_([A-Za-z0-9]{30})([A-Za-z0-9]{6})(?![A-Za-z0-9])")}
_HEX = re.compile(r"[0-9a-f]{32,}")
_DIGITS = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"
_LOWER = {c: c + 32 for c in range(65, 91)}

#: Keywords in lower case, with the kind whose expression is anchored where they start.
_KEYWORDS = {
    **dict.fromkeys(("password", "passwd", "secret", "token", "apikey", "api_key"), "assign"),
    "akia": "access",
    **dict.fromkeys(("ghp_", "gho_", "ghu_", "ghs_", "ghr_"), "github"),
    "npm_": "npm",
}


def _automaton() -> ahocorasick.Automaton:
    made = ahocorasick.Automaton()
    for word, kind in _KEYWORDS.items():
        made.add_word(word, (kind, len(word)))
    made.make_automaton()
    return made


def checksum(text: str) -> str:
    """CRC-32 in base 62, six digits."""
    n, out = zlib.crc32(text.encode()), ""
    for _ in range(6):
        n, d = divmod(n, 62)
        out = _DIGITS[d] + out
    return out


def find(text: str | None, automaton: ahocorasick.Automaton | None = None) -> list[tuple[str, int, int]]:
    """``(kind, start, end)`` in code points, by start and then kind; a NULL text has none.

    Leftmost and not overlapping within a kind: a keyword inside an earlier match of its kind, also one
    that is dropped as too short, starts no other.
    """
    if not text:
        return []
    automaton = automaton or _automaton()
    lower = text.lower()
    if len(lower) != len(text):  # a letter whose lower case is two characters would shift what follows
        lower = text.translate(_LOWER)
    spans, done = [], dict.fromkeys(KINDS, 0)
    for last, (kind, width) in automaton.iter(lower):
        start = last - width + 1
        if start < done[kind]:
            continue
        if kind == "assign":
            if m := _ASSIGN.match(text, start):
                done[kind] = m.end()
                if m.end(2) - m.start(2) >= 8:
                    spans.append((kind, start, m.end()))
        elif kind == "access":
            if m := _ACCESS.match(text, start):
                done[kind] = m.end()
                if m.end() - start >= 16:
                    spans.append((kind, start, m.end()))
        elif (m := _CHECKED[kind].match(text, start)) and checksum(m[1]) == m[2]:
            done[kind] = m.end()
            spans.append((kind, start, m.end()))
    spans += [("hex", m.start(), m.end()) for m in _HEX.finditer(text)]
    return sorted(spans, key=lambda s: (s[1], KINDS.index(s[0])))


def listed(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def redact(text: str | None, spans: list[tuple[str, int, int]]) -> str | None:
    """The text with every span, overlapping ones together, replaced by its kind in brackets."""
    if not spans:
        return text
    out, at = [], 0
    for kind, a, b in spans:
        if b <= at:
            continue
        if a >= at:
            out += [text[at:a], f"[{kind}]"]
        at = b
    return "".join([*out, text[at:]])


def _scan_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    automaton = _automaton()
    for batch in batches:
        found = [find(t.as_py(), automaton) for t in batch.column("text")]
        count = {k: pa.array([sum(s[0] == k for s in spans) for spans in found], pa.int64()) for k in BASE_KINDS}
        base = [hashlib.sha256(listed([s for s in spans if s[0] in BASE_KINDS]).encode()).hexdigest() for spans in found]
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), *count.values(), pa.array(base, pa.string()), pa.array(map(listed, found), pa.string())],
            ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"],
        )


def scan(docs: DataFrame) -> DataFrame:
    """Spans of every whole text; nothing is shuffled."""
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(
        _scan_batches, "doc_id bigint, n_assign bigint, n_access bigint, n_hex bigint, base_sha256 string, spans string"
    )


def _redact_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    automaton = _automaton()
    for whole in batches:
        for batch in portions(whole):
            columns = {n: batch.column(n) for n in batch.schema.names}
            old = columns["text"].to_pylist()
            new = [redact(t, find(t, automaton)) for t in old]
            columns["text"] = pa.array(new, batch.schema.field("text").type)
            if "n_chars" in columns:
                kept = columns["n_chars"].to_pylist()
                n_chars = [n if a == b else len(b) for n, a, b in zip(kept, old, new)]
                columns["n_chars"] = pa.array(n_chars, batch.schema.field("n_chars").type)
            yield pa.RecordBatch.from_arrays(list(columns.values()), schema=batch.schema)


def redact_documents(docs: DataFrame) -> DataFrame:
    """The documents with their secrets replaced; a text without any stays as it is, and so do NULLs.

    ``n_chars``, where there is such a column, follows the text where it changed.  Other columns pass through.
    """
    return docs.mapInArrow(_redact_batches, docs.schema)


def op4_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(table(spark, sf_dir, "documents"))
