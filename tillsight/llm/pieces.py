"""SentencePiece BPE by a table of the last token of every prefix, and decoding.

The encoding of a prefix ends in exactly one token.  It is the one that ends there by the automaton of all
pieces, starts where another prefix's encoding ends, and stays a token of its own beside that
prefix's last token.  The table is filled from left to right, and the ids of the whole are read
from its end backwards.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import ahocorasick
import numpy as np
import public_tokenizers
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame, SparkSession, functions as F

from .common import Memory, portions, table

MODEL = "piece_bpe_32k.model"
#: The character that stands for a space.
SPACE = "▁"
#: Words and token pairs that a worker remembers, in each of two generations; longer words are forgotten at once.
WORDS, PAIRS, WORD_CHARS = 250_000, 500_000, 256
#: Bytes of texts that are encoded together; a longer text goes alone.
_TOGETHER = 1_000_000
#: Digits of ids that are joined at once.
_RUN = 1 << 16


_NEVER = float("-inf")


class Pieces:
    """Encodes and decodes as the model does.

    A character without a piece of its own is a token meanwhile, numbered behind the pieces by its code point,
    and becomes the pieces of its bytes at the end.
    """

    def __init__(self, path: str) -> None:
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.size = model.get_piece_size()
        self.end = model.eos_id()
        names = [model.id_to_piece(i) for i in range(self.size)]
        silent = [model.is_control(i) for i in range(self.size)]
        bytes_ = {int(names[i][1:-1], 16): i for i in range(self.size) if model.is_byte(i)}
        self.byte_of = {i: b for b, i in bytes_.items()}
        normal = [i for i in range(self.size) if not (silent[i] or model.is_byte(i) or model.is_unknown(i))]
        if model.normalize("  a\t  B ") != f"{SPACE * 3}a\t{SPACE * 2}B{SPACE}" or len(bytes_) != 256 or self.end < 0:
            raise ValueError("only models that keep white space, add a space in front and fall back to bytes are handled")
        if any(model.is_unused(i) for i in range(self.size)):
            raise ValueError("models with unused pieces are not handled")
        self.byte_ids = [bytes_[b] for b in range(256)]
        self.id_of = {names[i]: i for i in normal}
        self.score = {names[i]: model.get_score(i) for i in normal}
        self.text_of = names
        self.length = [len(n) for n in names]
        self.shown = [
            "" if silent[i] else " ⁇ " if model.is_unknown(i) else names[i].replace(SPACE, " ") for i in range(self.size)
        ]
        self.automaton = ahocorasick.Automaton()
        for i in normal:
            self.automaton.add_word(names[i], i)
        self.automaton.make_automaton()
        self.single = {n for n in self.id_of if len(n) == 1}
        #: Numbers of the start of a text, and one more than that of any token.
        self.start = self.size + 0x110000
        self.base = self.start + 1
        self.words = Memory(WORDS)
        self.pairs = Memory(PAIRS)
        self.made: dict[int, tuple[str, str, list] | None] = {}
        self.decimals = [str(i) for i in range(self.size)]
        self.word = re.compile(self._word_pattern(names, normal))
        self.pairs_tested = self.words_encoded = 0

    def _word_pattern(self, names: list[str], normal: list[int]) -> str:
        """What no token reaches across: a run up to the next space, cut at characters that only stand alone."""
        longer = [names[i] for i in normal if len(names[i]) > 1]
        if any(SPACE in n.lstrip(SPACE) for n in longer):
            return r"(?s).+"
        joined = set("".join(longer))
        alone = re.escape("".join(chr(c) for c in range(128) if chr(c) not in joined))
        return f"[{alone}]|{SPACE}*[^{SPACE}{alone}]+|{SPACE}+" if alone else f"{SPACE}*[^{SPACE}]+|{SPACE}+"

    def _merges(self, token: int) -> tuple[str, str, list[tuple[float, str, str]]] | None:
        """How a token comes about: its first and last characters and, after each merge, the score and the outer parts.

        None if its characters, merged by the best score first and then the leftmost, end in other tokens.
        """
        if token not in self.made:
            parts = list(self.text_of[token])
            first, last, steps = parts[0], parts[-1], []
            while len(parts) > 1:
                scores = [self.score.get(a + b, _NEVER) for a, b in zip(parts, parts[1:])]
                best = max(scores)
                if best == _NEVER:
                    break
                k = scores.index(best)
                parts[k : k + 2] = [parts[k] + parts[k + 1]]
                steps.append((best, parts[0], parts[-1]))
            self.made[token] = (first, last, steps) if len(parts) == 1 else None
        return self.made[token]

    def _stay(self, left: int, right: int) -> bool:
        """Run the merges of two tokens side by side: no merge across their border may ever come first.

        Of equal scores the leftmost goes first: the left token's, that across, the right token's.
        """
        b = self._merges(right) if right < self.size else (chr(right - self.size), "", [])
        if left == self.start or b is None:
            return b is not None
        a = self._merges(left) if left < self.size else ("", chr(left - self.size), [])
        if a is None:
            return False
        (_, end, before), (begin, _, after) = a, b
        i = j = 0
        while True:
            across = self.score.get(end + begin, _NEVER)
            of_left = before[i][0] if i < len(before) else _NEVER
            of_right = after[j][0] if j < len(after) else _NEVER
            if across > of_left and across >= of_right:
                return False
            if of_left >= of_right and i < len(before):
                end = before[i][2]
                i += 1
            elif j < len(after):
                begin = after[j][1]
                j += 1
            else:
                return True

    def compatible(self, left: int, right: int) -> bool:
        """Whether two tokens side by side stay as they are; ``left`` may be the start of the text."""
        key = left * self.base + right
        known = self.pairs.get(key)
        if known is None:
            known = self._stay(left, right)
            self.pairs.put(key, known)
            self.pairs_tested += 1
        return known

    def last_tokens(self, text: str) -> list[int]:
        """For every prefix but the empty one the last token of its encoding."""
        last, length, start, base = [-1] * len(text), self.length, self.start, self.base
        known = self.pairs.young
        whole = self.single.issuperset(text)  # every character has a piece of its own
        done = 0
        for end, token in self.automaton.iter(text):
            if last[end] >= 0:
                continue
            if not whole:
                done = self._alone(text, last, done, end)
            before = end - length[token]
            left = last[before] if before >= 0 else start
            fits = known.get(left * base + token)
            if fits is None:
                fits = self.compatible(left, token)
                known = self.pairs.young
            if fits:
                last[end] = token
        if not whole:
            self._alone(text, last, done, len(text))
        if -1 in last:
            raise ValueError("a prefix has no last token")
        return last

    def _alone(self, text: str, last: list[int], first: int, stop: int) -> int:
        """Prefixes before ``stop`` whose last token is none of the pieces end in a character without a piece."""
        for k in range(first, stop):
            if last[k] < 0:
                token = self.size + ord(text[k])
                if text[k] not in self.single and self.compatible(last[k - 1] if k else self.start, token):
                    last[k] = token
        return stop

    def _encode_word(self, word: str) -> bytes:
        last, ids, at = self.last_tokens(word), [], len(word)
        while at:
            token = last[at - 1]
            if token < self.size:
                ids.append(token)
                at -= self.length[token]
            else:
                ids += [self.byte_ids[b] for b in reversed(chr(token - self.size).encode())]
                at -= 1
        self.words_encoded += 1
        return np.array(ids[::-1], "<i4").tobytes()

    def encode(self, text: str | None) -> np.ndarray:
        """Ids of a whole text and the end id; NULL as an empty text."""
        if not text:
            return np.array([self.end], "<i4")
        words, parts = self.words, []
        for word in self.word.findall(SPACE + text.replace(" ", SPACE)):
            ids = words.get(word)
            if ids is None:
                ids = self._encode_word(word)
                if len(word) <= WORD_CHARS:
                    words.put(word, ids)
            parts.append(ids)
        parts.append(np.array([self.end], "<i4").tobytes())
        return np.frombuffer(b"".join(parts), "<i4")

    def decode(self, ids) -> str:
        """The text of ids: one space in front goes, runs of byte pieces are UTF-8 with marks for what is not."""
        shown, byte_of, out, run = self.shown, self.byte_of, [], bytearray()
        for i in ids.tolist() if isinstance(ids, np.ndarray) else ids:
            if i in byte_of:
                run.append(byte_of[i])
                continue
            if run:
                out.append(_utf8(bytes(run)))
                run.clear()
            out.append(shown[i])
        if run:
            out.append(_utf8(bytes(run)))
        text = "".join(out)
        first = next((i for i in ids if shown[i] or i in byte_of), None)
        return text[1:] if first is not None and self.text_of[first].startswith(SPACE) else text


def _utf8(data: bytes) -> str:
    """UTF-8 with one mark for every byte that belongs to no character."""
    try:
        return data.decode()
    except UnicodeDecodeError as e:
        return data[: e.start].decode() + "�" + _utf8(data[e.start + 1 :])


_loaded: dict[str, Pieces] = {}


def pieces(path: str) -> Pieces:
    """The pieces of this worker process, whose memory lasts from task to task."""
    if path not in _loaded:
        _loaded[path] = Pieces(path)
    return _loaded[path]


def decimal_digest(ids: np.ndarray, decimals: list[str]) -> str:
    """Digest of the ids in decimals, joined by spaces."""
    digest = hashlib.sha256()
    for first in range(0, len(ids), _RUN):
        run = " ".join([decimals[i] for i in ids[first : first + _RUN].tolist()])
        digest.update((" " + run if first else run).encode())
    return digest.hexdigest()


def _encode_batches(path: str, with_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = pieces(path)
        for batch in batches:
            for part in portions(batch, most=_TOGETHER):
                ids = [made.encode(t) for t in part.column("text").to_pylist()]
                columns = {
                    "doc_id": part.column("doc_id"),
                    "n_tokens": pa.array([len(i) for i in ids], pa.int64()),
                    "ids_sha256": pa.array([decimal_digest(i, made.decimals) for i in ids], pa.string()),
                    "decoded_sha256": pa.array([hashlib.sha256(made.decode(i).encode()).hexdigest() for i in ids], pa.string()),
                }
                if with_ids:
                    columns["ids"] = pa.array(ids, pa.list_(pa.int32()))
                yield pa.RecordBatch.from_arrays(list(columns.values()), list(columns))

    return run


def encode_pieces(docs: DataFrame, with_ids: bool = True, path: str | None = None) -> DataFrame:
    """Ids of every whole text, the end id last, with digests of the ids and of the decoded text.

    One row per row and nothing is shuffled.  Repeated rows and NULL ids are kept, a NULL text is an empty one, and
    other columns are left out.
    """
    path = path or public_tokenizers.path(MODEL)
    kinds = "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string"
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(
        _encode_batches(path, with_ids), kinds + (", ids array<int>" if with_ids else "")
    )


def op11_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """:func:`encode_pieces` of ``documents``, without the ids themselves."""
    return encode_pieces(table(spark, sf_dir, "documents"), with_ids=False)
