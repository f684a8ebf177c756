"""Chat formatting of typed content parts.

A turn's content is an array of parts: text, image, audio or document. A visitor flattens them in order; text is
escaped, any other part becomes a placeholder, and its reference and the tokens it expands to are recorded.

A turn reads ``<|im_start|>role``, a line feed, its content, ``<|im_end|>`` and a line feed. In roles and in each run of
neighbouring text parts, read as one text, every ``<``, k backslashes, ``|`` gets one backslash more. So no control
string can arise from them, within a part or across the border of two, and none is lost. A role's backslashes and line
feeds are escaped besides. A placeholder's ``<|`` stands alone: text before it ends in no unescaped ``<|``, and text after
it follows ``>``.

Every turn is a segment of its conversation; the conversation's formatted text is its segments in order of ``turn``. So
conversations of any length are formatted turn by turn and read back as a stream, never gathered. A digest of a whole
conversation is a stream by nature: one task reads one conversation, in bounded memory, so a conversation with a third
of all rows takes a third of the reading time however many machines there are.

Defined results: null texts, roles, parts and lists of parts are empty; rows with a null conv_id are one conversation;
null turns come first, equal ones in order of role (null first) and of their formatted segments; rows that repeat are
turns of their own; a part of another type is a placeholder of its own, recorded with its type and reference and
no tokens; texts of any length that a row can hold are formatted whole; extra columns play no part; without turns there
are no conversations.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

START, END = "<|im_start|>", "<|im_end|>"
PATCH = 28  # pixels of an image's side for each token
AUDIO_TOKENS_PER_SECOND = 25
TOKENS_PER_PAGE = 512
PLACEHOLDERS = {"image": "<|image|>", "audio": "<|audio|>", "document": "<|document|>"}
OTHER = "<|other|>"
LEARNED_ROLE = "assistant"

PART = "struct<type: string, text: string, ref: string, width: int, height: int, seconds: double, pages: int>"
_SEGMENT = "conv_id long, turn long, role string, segment string, loss array<struct<start: int, stop: int>>, attachments array<struct<type: string, ref: string, at: int, tokens: long>>, expanded_tokens long"
_ESCAPE, _UNESCAPE = re.compile(r"<(\\*)\|"), re.compile(r"<\\(\\*)\|")
_PLACEHOLDER = re.compile("|".join(map(re.escape, (*PLACEHOLDERS.values(), OTHER))))


def escape(text: str) -> str:
    return _ESCAPE.sub(r"<\\\1|", text)


def unescape(text: str) -> str:
    return _UNESCAPE.sub(r"<\1|", text)


def escape_role(role: str) -> str:
    return escape(role.replace("\\", "\\\\").replace("\n", "\\n"))


def unescape_role(role: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], unescape(role), flags=re.DOTALL)


@dataclass
class Flattener:
    """Visits the parts of one turn."""

    at: int
    learned: bool
    content: list[str] = field(default_factory=list)
    loss: list[dict] = field(default_factory=list)
    attachments: list[dict] = field(default_factory=list)
    run: list[str] = field(default_factory=list)  # neighbouring texts, not escaped yet

    def visit(self, part: dict) -> None:
        getattr(self, f"visit_{part['type'] or 'text'}", self.visit_other)(part)

    def _add(self, text: str) -> None:
        self.content.append(text)
        self.at += len(text)

    def visit_text(self, part: dict) -> None:
        if part["text"]:
            self.run.append(part["text"])

    def close(self) -> None:
        """Add the run of texts, escaped as one."""
        text = escape("".join(self.run))
        self.run.clear()
        if self.learned and text:
            self.loss.append({"start": self.at, "stop": self.at + len(text)})
        self._add(text)

    def _attach(self, part: dict, tokens: int) -> None:
        self.close()
        self.attachments.append({"type": part["type"], "ref": part.get("ref"), "at": self.at, "tokens": tokens})
        self._add(PLACEHOLDERS.get(part["type"], OTHER))

    def visit_image(self, part: dict) -> None:
        self._attach(part, math.ceil((part["width"] or 0) / PATCH) * math.ceil((part["height"] or 0) / PATCH))

    def visit_audio(self, part: dict) -> None:
        self._attach(part, math.ceil((part["seconds"] or 0.0) * AUDIO_TOKENS_PER_SECOND))

    def visit_document(self, part: dict) -> None:
        self._attach(part, (part["pages"] or 0) * TOKENS_PER_PAGE)

    def visit_other(self, part: dict) -> None:
        self._attach(part, 0)


def segment(role: str | None, parts: list[dict] | None) -> tuple[str, Flattener]:
    head = f"{START}{escape_role(role or '')}\n"
    flat = Flattener(len(head), role == LEARNED_ROLE)
    for part in parts or []:
        if part is not None:
            flat.visit(part)
    flat.close()
    return f"{head}{''.join(flat.content)}{END}\n", flat


def _turns(text: str) -> Iterator[tuple[str, str]]:
    """Roles and escaped contents of formatted text."""
    at = 0
    while at < len(text):
        if not text.startswith(START, at):
            raise ValueError("a turn must start here")
        line = text.index("\n", at)
        stop = text.index(END, line)
        yield unescape_role(text[at + len(START) : line]), text[line + 1 : stop]
        at = stop + len(END) + 1


def read_segment(text: str) -> Iterator[tuple[str, str]]:
    """Roles and contents of formatted text; placeholders stay, and so look like a text that names one."""
    for role, content in _turns(text):
        yield role, unescape(content)


def read_parts(text: str) -> Iterator[tuple[str, list[tuple[str, str]]]]:
    """Roles and parts of formatted text: ("text", the run of texts) or ("placeholder", the placeholder), in order."""
    for role, content in _turns(text):
        parts, at = [], 0
        for found in _PLACEHOLDER.finditer(content):
            if found.start() > at:
                parts.append(("text", unescape(content[at : found.start()])))
            parts.append(("placeholder", found[0]))
            at = found.end()
        if at < len(content):
            parts.append(("text", unescape(content[at:])))
        yield role, parts


def text_parts(turns: DataFrame) -> DataFrame:
    """Turns with a text as turns with one text part: conv_id, turn, role, parts."""
    part = F.struct(F.lit("text").alias("type"), F.coalesce("text", F.lit("")).alias("text"), *[F.lit(None).alias(c) for c in ("ref", "width", "height", "seconds", "pages")])
    return turns.select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), "role", F.array(part.cast(PART)).alias("parts"))


def format_turns(turns: DataFrame) -> DataFrame:
    """One segment per turn of (conv_id, turn, role, parts): its text, the spans to learn, attachments, expanded tokens."""

    def rows(batches):
        for batch in batches:
            out = [segment(role, parts) for role, parts in zip(batch.column("role").to_pylist(), batch.column("parts").to_pylist(), strict=True)]
            span = pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32())]))
            attached = pa.list_(pa.struct([("type", pa.string()), ("ref", pa.string()), ("at", pa.int32()), ("tokens", pa.int64())]))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("conv_id"),
                    batch.column("turn"),
                    batch.column("role"),
                    pa.array([text for text, _ in out], pa.string()),
                    pa.array([flat.loss for _, flat in out], span),
                    pa.array([flat.attachments for _, flat in out], attached),
                    pa.array([sum(a["tokens"] for a in flat.attachments) for _, flat in out], pa.int64()),
                ],
                ["conv_id", "turn", "role", "segment", "loss", "attachments", "expanded_tokens"],
            )

    return turns.mapInArrow(rows, _SEGMENT)


def read_back(segments: DataFrame) -> DataFrame:
    """One row per conversation, from its segments alone: conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars.

    A partition's segments come in order, so a conversation needs two digests and three counts, however long it is.
    """
    ordered = segments.select("conv_id", "turn", "role", "segment", "loss").repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "segment").drop("turn", "role")

    def rows(batches):
        key, state, done = None, None, []

        def close():
            done.append({"conv_id": key, "n_turns": state[0], "turns_sha256": state[1].hexdigest(), "loss_chars": state[2], "loss_sha256": state[3].hexdigest(), "formatted_chars": state[4]})

        kinds = pa.schema([("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()), ("loss_sha256", pa.string()), ("formatted_chars", pa.int64())])
        for batch in batches:
            for conv, text, loss in zip(batch.column("conv_id").to_pylist(), batch.column("segment").to_pylist(), batch.column("loss").to_pylist(), strict=True):
                if state is None or conv != key:
                    if state is not None:
                        close()
                    key, state = conv, [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                for role, content in read_segment(text):
                    state[0] += 1
                    state[1].update(f"{role}\n{content}\n".encode())
                for span in loss:
                    learned = unescape(text[span["start"] : span["stop"]])
                    state[2] += len(learned)
                    state[3].update(learned.encode())
                state[4] += len(text)
            if len(done) >= 1000:
                yield pa.RecordBatch.from_pylist(done, kinds)
                done = []
        if state is not None:
            close()
        if done:
            yield pa.RecordBatch.from_pylist(done, kinds)

    return ordered.mapInArrow(rows, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")


def oracle_sql(turns: str, role: str = LEARNED_ROLE) -> str:
    """DuckDB SQL for ``read_back`` of text turns; ``turns`` is a select of (conv_id, turn, role, text)."""
    escaped = "regexp_replace(coalesce({}, ''), '<(\\\\*)\\|', '<\\\\\\1|', 'g')"
    of_role = escaped.format("replace(replace(role, '\\', '\\\\'), chr(10), '\\n')")
    return f"""
WITH t AS ({turns}),
s AS (SELECT conv_id, turn, role, coalesce(text, '') AS text, '{START}' || {of_role} || chr(10) || {escaped.format("text")} || '{END}' || chr(10) AS segment FROM t)
SELECT CAST(conv_id AS BIGINT) AS conv_id, CAST(count(*) AS BIGINT) AS n_turns,
 sha256(string_agg(coalesce(role, '') || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role NULLS FIRST, segment)) AS turns_sha256,
 CAST(coalesce(sum(length(text)) FILTER (WHERE role = '{role}'), 0) AS BIGINT) AS loss_chars,
 sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role NULLS FIRST, segment) FILTER (WHERE role = '{role}'), '')) AS loss_sha256,
 CAST(sum(length(segment)) AS BIGINT) AS formatted_chars FROM s GROUP BY conv_id"""
