"""BPE encoding with reuse of content-defined chunks, and decoding.

A rolling hash over the last characters cuts a text into chunks where the hash meets a mask, so the
same passage is cut alike wherever it stands.  A worker encodes a chunk once and keeps its tokens for every
later document that holds it.  A cut may fall inside a word, so each join of two chunks is encoded again over
a window that reaches one whole piece into either chunk.  If the window's outer tokens are those that the
chunks have there, what lies between joins their tokens; if not, the window becomes the whole text.
"""

from __future__ import annotations

import hashlib
import json
import os
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F
from tokenizers import Tokenizer

from .common import Memory, portions, table

VOCABULARY = "word_bpe_49k.json"

#: Characters that the rolling hash sees, and bits of it that must be zero at a cut.
WINDOW, BITS = 16, 9
#: A chunk has at least this many characters, but for a text's last one.
LEAST = 64
#: What a worker keeps in each of two generations: pieces, and chunks and joins of up to so many characters.
PIECES, CHUNKS, JOINS, CHUNK_CHARS = 150_000, 20_000, 40_000, 8_192
#: A longer piece is forgotten as soon as its text is done.
PIECE_CHARS = 256

#: A character that is one token when it is a word.
_MARK = "\x01"

_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_BLOCK = 1 << 16


def _powers(base: int, n: int) -> np.ndarray:
    made = np.full(n, base, np.uint64)
    made[0] = 1
    return np.multiply.accumulate(made)


_UP, _DOWN = _powers(_BASE, _BLOCK + WINDOW), _powers(_INVERSE, _BLOCK + WINDOW)


def cuts(text: str) -> list[int]:
    """Ends of the chunks of a text, in characters.

    The hash of a window is a difference of prefix sums, taken in blocks of bounded length.
    """
    n = len(text)
    if n <= LEAST:
        return [n] if n else []
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
    codes *= np.uint64(0xD6E8FEB86659FD93)
    found = []
    for start in range(0, n, _BLOCK):
        block = codes[max(0, start - WINDOW) : start + _BLOCK]
        m = len(block)
        if m <= WINDOW:
            continue
        sums = np.cumsum(block * _DOWN[:m])
        rolled = (sums[WINDOW:] - sums[:-WINDOW]) * _UP[WINDOW:m]
        found.append(np.nonzero(rolled >> np.uint64(64 - BITS) == 0)[0] + (max(0, start - WINDOW) + WINDOW + 1))
    at, out = 0, []
    candidates = np.concatenate(found) if found else np.empty(0, np.int64)
    i = 0
    while (i := int(np.searchsorted(candidates, at + LEAST))) < len(candidates) and candidates[i] < n:
        at = int(candidates[i])
        out.append(at)
    return [*out, n]


class _Pieces(Memory):
    def missing(self, texts: set[str]) -> list[str]:
        """Those that are not known; those that are will be among the young ones."""
        if len(self.young) > self.most:
            self.old, self.young = self.young, {}
        young, old, out = self.young, self.old, []
        for text in texts:
            if text not in young:
                if text in old:
                    young[text] = old[text]
                else:
                    out.append(text)
        return out


class _Chunk(NamedTuple):
    """Tokens of the whole pieces of a chunk, and the first and the last of them that have any, with where the first ends,
    from the chunk's start, and the last begins, from its end."""

    tokens: bytes
    first: bytes
    first_end: int
    last: bytes
    last_start: int


def _refuse_what_crosses_spaces(path: str) -> None:
    """Only a tokenizer whose normaliser, word search and vocabulary leave a space or line feed as a border is handled."""
    with open(path, encoding="utf-8") as f:
        made = json.load(f)

    def steps(part: dict | None, many: str) -> list[dict]:
        return [] if part is None else part[many] if part["type"] == "Sequence" else [part]

    normal = {s["type"] for s in steps(made.get("normalizer"), "normalizers")}
    words = steps(made.get("pre_tokenizer"), "pretokenizers")
    split = [w for w in words if w["type"] == "Split" and w["behavior"] == "Removed" and w.get("invert")]
    crossing = [w for w in words if w["type"] != "Split" and (w["type"] != "ByteLevel" or w["add_prefix_space"] or w["use_regex"])]
    model = made["model"]
    spaced = [t["content"] for t in made["added_tokens"] if " " in t["content"] or "\n" in t["content"] or t["lstrip"] or t["rstrip"]]
    if (
        model["type"] != "BPE"
        or model.get("dropout")
        or made.get("decoder")
        or not normal <= {"NFC", "Replace", "Lowercase"}
        or len(split) != 1
        or crossing
        or spaced
        or any("\u0120" in t or " " in t for t in model["vocab"] if t != "\u0120" and t != "\u0120</w>")
    ):
        raise ValueError("tokens of this tokenizer may reach across a space: chunks cannot be joined")


class Encoder:
    """Encodes texts exactly as the tokenizer does, with a bounded memory of pieces, chunks and joins.

    A piece is a run without space and line feed.  Neither normalisation nor the search for words or special
    tokens of this tokenizer looks across those two characters, so pieces can be encoded one by one.
    ``tokens``, ``reused`` and ``repaired`` count tokens: all, from chunks that were known, from windows over joins.
    """

    def __init__(self, path: str) -> None:
        _refuse_what_crosses_spaces(path)
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a task has one core: no threads beside it
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.tokenizer.encode_special_tokens = False
        size = self.tokenizer.get_vocab_size(with_added_tokens=True)
        self.words = [self.tokenizer.id_to_token(i) or "" for i in range(size)]
        [self.mark] = self.tokenizer.encode(_MARK, add_special_tokens=False).ids
        self.pieces = _Pieces(PIECES)
        self.chunks = Memory(CHUNKS)
        self.joins = Memory(JOINS)
        self.tokens = self.reused = self.repaired = self.widened = 0

    def _learn(self, pieces: set[str]) -> None:
        """Encode new pieces, many in one call: between two of them stands a word of one known token."""
        new, known = self.pieces.missing(pieces), self.pieces.young
        apart = [p for p in new if _MARK not in p]
        runs = [apart[i : i + 500] for i in range(0, len(apart), 500)]
        texts = [f" {_MARK} ".join(run) for run in runs] + [p for p in new if _MARK in p]
        made = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        for run, encoded in zip(runs, made):
            ids = np.array(encoded.ids, "<u4")
            ends = np.nonzero(ids == self.mark)[0].tolist()
            if len(ends) != len(run) - 1:
                raise ValueError("tokens do not match the pieces")
            code = ids.tobytes()
            for piece, a, b in zip(run, [-1, *ends], [*ends, len(ids)]):
                known[piece] = code[4 * a + 4 : 4 * b]
        for text, encoded in zip(texts[len(runs) :], made[len(runs) :]):
            known[text] = np.array(encoded.ids, "<u4").tobytes()

    def _chunks(self, texts: list[str]) -> list[list[tuple[str, _Chunk | None, bool]]]:
        """The chunks of each text with their tokens, None where a chunk has no whole piece, and whether they were known."""
        fresh: dict[str, list[str]] = {}
        found: dict[str, _Chunk | None] = {}
        laid = []
        for text in texts:
            row, at = [], 0
            for end in cuts(text):
                chunk, at = text[at:end], end
                if chunk in found:
                    row.append((chunk, True))
                elif (known := self.chunks.get(chunk)) is not None:
                    found[chunk] = known or None
                    row.append((chunk, True))
                else:
                    found[chunk] = None
                    fresh[chunk] = chunk.replace("\n", " ").split(" ")
                    row.append((chunk, False))
            laid.append(row)
        needed = {p for pieces in fresh.values() for p in pieces[1:-1]}
        self._learn(needed)
        for chunk, pieces in fresh.items():
            found[chunk] = self._encoded(pieces)
            if len(chunk) <= CHUNK_CHARS:
                self.chunks.put(chunk, found[chunk] or False)
        for piece in needed:
            if len(piece) > PIECE_CHARS:
                self.pieces.young.pop(piece, None)
        return [[(chunk, found[chunk], known) for chunk, known in row] for row in laid]

    def _encoded(self, pieces: list[str]) -> _Chunk | None:
        """Tokens of a chunk's pieces but the outer two, which may go on in the neighbouring chunks."""
        ids = self.pieces.young
        inner = pieces[1:-1]
        codes = [ids[p] for p in inner]
        first = next((k for k, code in enumerate(codes) if code), None)
        if first is None:
            return None
        last = len(codes) - 1
        while not codes[last]:
            last -= 1
        before = sum(len(p) + 1 for p in pieces[: first + 1])
        behind = sum(len(p) + 1 for p in pieces[last + 2 :])
        return _Chunk(b"".join(codes), codes[first], before + len(inner[first]), codes[last], -behind - len(inner[last]))

    def _windows(self, row: list[tuple[str, _Chunk | None, bool]]) -> list[tuple[str, bytes, bytes]]:
        """What is encoded again over the joins of a text, with the tokens that must stand at its left and right end."""
        windows, carried, left = [], [], b""
        for chunk, made, _ in row:
            if made is None:  # no whole piece: the window over the join reaches over all of it
                carried.append(chunk)
                continue
            windows.append(("".join([*carried, chunk[: made.first_end]]), left, made.first))
            carried, left = [chunk[made.last_start :]], made.last
        windows.append(("".join(carried), left, b""))
        return windows

    def _repaired(self, windows: set[tuple[str, bytes, bytes]]) -> dict[tuple[str, bytes, bytes], bytes | None]:
        """The tokens between the outer ones of each window; None if the outer ones are not those of the chunks."""
        out, new = {}, []
        for w in windows:
            known = self.joins.get(w[0])
            if known is None:
                new.append(w)
            else:
                out[w] = known
        texts = list({w[0] for w in new})
        made = dict(zip(texts, self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)))
        for w in new:
            ids = np.array(made[w[0]].ids, "<u4").tobytes()
            out[w] = ids
            if len(w[0]) <= PIECE_CHARS:
                self.joins.put(w[0], ids)
        for w, ids in out.items():
            _, left, right = w
            agrees = len(ids) >= len(left) + len(right) and ids.startswith(left) and ids.endswith(right)
            out[w] = ids[len(left) : len(ids) - len(right)] if agrees else None
        return out

    def encode_many(self, texts: list[str | None]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers; NULL as an empty text."""
        laid = self._chunks([t or "" for t in texts])
        asked = [self._windows(row) for row in laid]
        between = self._repaired({w for windows in asked for w in windows})
        out = []
        for text, row, windows in zip(texts, laid, asked):
            joins = [between[w] for w in windows]
            if any(j is None for j in joins):
                self.widened += 1
                whole = self.tokenizer.encode(text, add_special_tokens=False).ids
                out.append(np.array(whole, "<u4").tobytes())
                continue
            parts, k = [joins[0]], 1
            for _, made, known in row:
                if made is not None:
                    parts += [made.tokens, joins[k]]
                    k += 1
                    self.reused += len(made.tokens) // 4 if known else 0
            self.repaired += sum(map(len, joins)) // 4
            out.append(b"".join(parts))
            self.tokens += len(out[-1]) // 4
        return out

    def encode(self, text: str | None) -> bytes:
        return self.encode_many([text])[0]

    def decode(self, ids: bytes) -> str:
        """The text of ids, special tokens included: this tokenizer has no decoder, so tokens are joined by spaces."""
        words = self.words
        return " ".join([words[i] for i in np.frombuffer(ids, "<u4").tolist()])


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """The encoder of this worker process, which keeps its memory from task to task."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


#: Bytes of texts that are encoded together; a longer text goes alone.
_TOGETHER = 1_000_000


def _encode_batches(path: str, with_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = encoder(path)
        for batch in batches:
            for part in portions(batch, most=_TOGETHER):
                codes = made.encode_many(part.column("text").to_pylist())
                decoded = [hashlib.sha256(made.decode(c).encode()).hexdigest() for c in codes]
                columns = {
                    "doc_id": part.column("doc_id"),
                    "n_tokens": pa.array([len(c) // 4 for c in codes], pa.int64()),
                    "ids_sha256": pa.array([hashlib.sha256(c).hexdigest() for c in codes]),
                    "decoded_sha256": pa.array(decoded),
                }
                if with_ids:
                    columns["ids"] = pa.array([np.frombuffer(c, "<i4") for c in codes], pa.list_(pa.int32()))
                yield pa.RecordBatch.from_arrays(list(columns.values()), list(columns))

    return run


def encode_documents(docs: DataFrame, with_ids: bool = True, path: str | None = None) -> DataFrame:
    """Tokens of every whole text with digests of ids and decoded text; one row per row, nothing is shuffled.

    Repeated rows are encoded alike and kept; a NULL text is an empty one.  A tokenizer whose tokens may reach across
    a space or line feed is refused.
    """
    path = path or public_tokenizers.path(VOCABULARY)
    kinds = "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string"
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(
        _encode_batches(path, with_ids), kinds + (", ids array<int>" if with_ids else "")
    )


def op3_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """:func:`encode_documents` of ``documents``, without the ids themselves."""
    return encode_documents(table(spark, sf_dir, "documents"), with_ids=False)
