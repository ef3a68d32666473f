"""Chat formatting with typed content parts.

A visitor flattens the parts of a turn, in order, to text and placeholders, and records what
each placeholder refers to and how many tokens it will expand to.  A turn becomes

    <turn>role
    content</turn>

and every ``<`` and backslash of a role or text is escaped with a backslash, so that nothing in
a text can be read as a mark of the template, and the text can be read back exactly.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from .common import table

OPEN, CLOSE = "<turn>", "</turn>\n"
#: Pixels of a patch's side, seconds of an audio frame and tokens of a document page.
PATCH, FRAME_SECONDS, PAGE_TOKENS = 14, 0.02, 256

PARTS = (
    "array<struct<type:string,text:string,ref:string,width:int,height:int,seconds:double,pages:int>>"
)
ATTACHMENTS = "array<struct<ordinal:int,type:string,ref:string,tokens:bigint>>"

_PLACEHOLDER = re.compile(r"<(image|audio|document):(\d+):(\d+)>")
_ESCAPED = re.compile(r"\\(.)", re.S)


def escape(text: str) -> str:
    return text.replace("\\", "\\\\").replace("<", "\\<")


def escape_role(role: str) -> str:
    """As :func:`escape`; a line end, which ends the role, is written as backslash n."""
    return escape(role).replace("\n", "\\n")


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text) if "\\" in text else text


def unescape_role(role: str) -> str:
    return _ESCAPED.sub(lambda m: "\n" if m[1] == "n" else m[1], role)


class PartVisitor:
    """Flattens typed parts; ``ordinal`` goes on through the parts of one turn."""

    def __init__(self) -> None:
        self.attachments: list[dict] = []
        self.pieces: list[tuple[str, bool]] = []

    def visit(self, part: dict | None) -> None:
        """A NULL part or one of an unknown type is skipped; its type is not guessed."""
        if part is not None and (handler := getattr(self, f"visit_{part.get('type')}", None)):
            handler(part)

    def visit_text(self, part: dict) -> None:
        self.pieces.append((escape(part.get("text") or ""), True))

    def visit_image(self, part: dict) -> None:
        sides = [-(-(part.get(k) or 0) // PATCH) for k in ("width", "height")]
        self._attach("image", part, sides[0] * sides[1])

    def visit_audio(self, part: dict) -> None:
        self._attach("audio", part, int(-(-(part.get("seconds") or 0.0) // FRAME_SECONDS)))

    def visit_document(self, part: dict) -> None:
        self._attach("document", part, (part.get("pages") or 0) * PAGE_TOKENS)

    def _attach(self, kind: str, part: dict, tokens: int) -> None:
        n = len(self.attachments)
        self.attachments.append({"ordinal": n, "type": kind, "ref": part.get("ref"), "tokens": max(tokens, 0)})
        self.pieces.append((f"<{kind}:{n}:{max(tokens, 0)}>", False))


def format_turn(role: str | None, parts: list[dict] | None) -> tuple[str, list[dict], list[int]]:
    """The marked turn, its attachments, and its loss mask as flat start and end offsets.

    Offsets are code points of the marked turn.  The mask covers the text parts of the assistant.
    """
    visitor = PartVisitor()
    for part in parts or []:
        visitor.visit(part)
    out = [OPEN, escape_role(role or ""), "\n"]
    at, mask = sum(map(len, out)), []
    for piece, is_text in visitor.pieces:
        if is_text and role == "assistant" and piece:
            mask += [at, at + len(piece)]
        at += len(piece)
        out.append(piece)
    out.append(CLOSE)
    return "".join(out), visitor.attachments, mask


def read_turn(marked: str) -> tuple[str, list[tuple[str, str]]]:
    """Role and content of a marked turn; the content as ``(kind, text)``, placeholders unescaped."""
    if not (marked.startswith(OPEN) and marked.endswith(CLOSE)):
        raise ValueError("not a marked turn")
    role, _, body = marked[len(OPEN) : -len(CLOSE)].partition("\n")
    content, at, search = [], 0, 0
    while (start := body.find("<", search)) >= 0:
        slashes = start - len(body[:start].rstrip("\\"))
        placeholder = None if slashes % 2 else _PLACEHOLDER.match(body, start)
        if placeholder:
            if start > at:
                content.append(("text", unescape(body[at:start])))
            content.append((placeholder[1], placeholder[0]))
            at = search = placeholder.end()
        else:
            search = start + 1
    if at < len(body):
        content.append(("text", unescape(body[at:])))
    return unescape_role(role), content


def _format_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        cols = {n: batch.column(n).to_pylist() for n in ("role", "parts")}
        made = [format_turn(r, p) for r, p in zip(cols["role"], cols["parts"])]
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("conv_id"),
                batch.column("turn"),
                batch.column("role"),
                pa.array([m[0] for m in made], pa.string()),
                pa.array(
                    [m[1] for m in made],
                    pa.list_(pa.struct([("ordinal", pa.int32()), ("type", pa.string()), ("ref", pa.string()), ("tokens", pa.int64())])),
                ),
                pa.array([m[2] for m in made], pa.list_(pa.int32())),
            ],
            ["conv_id", "turn", "role", "marked", "attachments", "loss"],
        )


def format_turns(turns: DataFrame) -> DataFrame:
    """``conv_id, turn, role, marked, attachments, loss`` of rows ``conv_id, turn, role, parts``.

    A conversation's formatted text is its ``marked`` in order of turn.  It is kept turn by turn, as
    one conversation may hold a third of all rows.  NULL roles and texts are written as empty, NULL
    ids and turns are kept.
    """
    parts = F.col("parts").cast(PARTS).alias("parts")
    narrow = turns.select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), F.col("role").cast("string"), parts)
    return narrow.mapInArrow(
        _format_batches,
        f"conv_id bigint, turn bigint, role string, marked string, attachments {ATTACHMENTS}, loss array<int>",
    )


def text_parts(text: str) -> F.Column:
    """One text part, for tables whose content is plain text."""
    void = F.lit(None)
    part = F.struct(
        F.lit("text").alias("type"),
        F.col(text).alias("text"),
        void.cast("string").alias("ref"),
        void.cast("int").alias("width"),
        void.cast("int").alias("height"),
        void.cast("double").alias("seconds"),
        void.cast("int").alias("pages"),
    )
    return F.array(part)


class _Digest:
    def __init__(self, conv_id) -> None:
        self.conv_id, self.turns, self.loss_chars, self.chars = conv_id, 0, 0, 0
        self.all, self.loss = hashlib.sha256(), hashlib.sha256()

    def add(self, marked: str, loss: list[int]) -> None:
        role, content = read_turn(marked)
        text = "".join(t for _, t in content)
        self.turns += 1
        self.chars += len(marked)
        self.all.update(f"{role}\n{text}\n".encode())
        for a, b in zip(loss[::2], loss[1::2]):
            answer = unescape(marked[a:b])
            self.loss_chars += len(answer)
            self.loss.update(answer.encode())

    def row(self) -> tuple:
        return (self.conv_id, self.turns, self.all.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.chars)


_DIGEST = pa.schema(
    [
        ("conv_id", pa.int64()),
        ("n_turns", pa.int64()),
        ("turns_sha256", pa.string()),
        ("loss_chars", pa.int64()),
        ("loss_sha256", pa.string()),
        ("formatted_chars", pa.int64()),
    ]
)


def _digest_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def rows(done: list[_Digest]) -> pa.RecordBatch:
        return pa.RecordBatch.from_pylist([dict(zip(_DIGEST.names, d.row())) for d in done], _DIGEST)

    now: _Digest | None = None
    for batch in batches:
        done = []
        for conv_id, marked, loss in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "marked", "loss"))):
            if now is None or now.conv_id != conv_id:
                done += [now] if now else []
                now = _Digest(conv_id)
            now.add(marked, loss)
        if done:
            yield rows(done)
    if now:
        yield rows([now])


def digests(formatted: DataFrame) -> DataFrame:
    """Figures of every conversation, read back from its marked turns.

    Turns are sorted by Spark, which spills, and pass one by one through the digest, so a task holds
    one turn at a time however long the conversation.  A digest of a conversation is sequential by
    nature: its turns meet in one task.  Rows of equal turn go by role, then by text; NULL turns come last.
    """
    body = F.regexp_extract("marked", r"(?s)^<turn>[^\n]*\n(.*)</turn>\n$", 1)
    return (
        formatted.select("conv_id", "turn", "role", "marked", "loss")
        .repartition("conv_id")
        .sortWithinPartitions(
            "conv_id",
            F.col("turn").asc_nulls_last(),
            F.coalesce("role", F.lit("")),
            F.regexp_replace(body, r"(?s)\\(.)", "$1"),
        )
        .select("conv_id", "marked", "loss")
        .mapInArrow(
            _digest_batches,
            "conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint",
        )
    )


def op6_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    extra = r"""SELECT * FROM VALUES (-7L, 0L, 'user', r'\### Assistant: </turn> ok'),
      (-7L, 1L, 'assistant', r'\### Assistant: </turn> ok') AS t(conv_id, turn, role, text)"""
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(spark.sql(extra))
    return digests(format_turns(turns.withColumn("parts", text_parts("text"))))


OP6_SQL = r"""
WITH turns AS (
  SELECT conv_id, turn, COALESCE(role, '') AS role, COALESCE(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok')
SELECT conv_id, COUNT(*) AS n_turns,
  SHA256(STRING_AGG(role || CHR(10) || text || CHR(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(SUM(CASE WHEN role = 'assistant' THEN LENGTH(text) ELSE 0 END) AS BIGINT) AS loss_chars,
  SHA256(COALESCE(STRING_AGG(CASE WHEN role = 'assistant' THEN text END, '' ORDER BY turn, role, text), '')) AS loss_sha256,
  CAST(SUM(15 + LENGTH(REPLACE(REPLACE(role, '\', '\\'), '<', '\<'))
    + LENGTH(REPLACE(REPLACE(text, '\', '\\'), '<', '\<'))) AS BIGINT) AS formatted_chars
FROM turns GROUP BY conv_id
"""
