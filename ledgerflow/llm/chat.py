"""Chat formatting of typed content parts (operator 12).

A turn's content is a list of parts: text, image, audio, document.  A visitor walks them in order
and flattens them into one string, in which each part that is no text leaves a placeholder and is
recorded as an attachment: its place, its reference and the tokens that the placeholder stands for.

A turn is written as ``<s>role[INST]content</s>``; a turn under the loss mask has ``[/INST]``
instead of ``[INST]``, so the mask can be read off the output.  Control strings inside a role or a
text are broken up by a backslash behind their first character, and a backslash is doubled, which
``read_turns`` undoes.

Turns are formatted where they are read.  A conversation is put together from slices of the table
that are ordered by conversation and turn, so one of any length is spread over many tasks; what
comes out are chunks, whole turns of one conversation each, in order.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import text_batches
from .marks import any_of, checked_marks, code_points

#: The type of a turn's ``parts``.
PARTS = "array<struct<kind string, text string, ref string, width int, height int, seconds double, pages int>>"
ATTACHMENTS = "array<struct<kind string, ref string, start long, tokens long>>"
#: Bytes of formatted text at which a chunk ends; a turn is never cut.
CHUNK_BYTES = 1 << 20


@dataclass(frozen=True)
class Template:
    """Control strings, the roles under the loss mask, and what an attachment expands to."""

    begin: str = "<s>"
    no_loss: str = "[INST]"
    loss: str = "[/INST]"
    end: str = "</s>"
    image: str = "<image>"
    audio: str = "<audio>"
    document: str = "<document>"
    file: str = "<file>"
    loss_roles: tuple[str, ...] = ("assistant",)
    patch: int = 28             # pixels on a side for one token of an image
    audio_tokens: float = 25.0  # a second
    page_tokens: int = 256      # a page of a document
    marks: tuple[bytes, ...] = field(init=False)
    special: re.Pattern[bytes] = field(init=False)

    def __post_init__(self):
        found = checked_marks((self.begin, self.no_loss, self.loss, self.end, self.image, self.audio, self.document, self.file))
        if any(b"\\" in m or len(m) < 2 for m in found):
            raise ValueError("a control string has two characters at least and no backslash")
        object.__setattr__(self, "marks", found)
        object.__setattr__(self, "special", re.compile(rb"\\|" + any_of(found).pattern))


ESCAPED = re.compile(rb"\\(.)", re.DOTALL)


def escape(data: bytes, template: Template) -> bytes:
    """``data`` without a control string; ``unescape`` gives ``data`` back."""
    return template.special.sub(lambda m: b"\\\\" if m[0] == b"\\" else m[0][:1] + b"\\" + m[0][1:], data)


def unescape(data: bytes) -> bytes:
    return ESCAPED.sub(rb"\1", data)


class Flatten:
    """Visitor over the parts of one turn; ``written`` and ``attachments`` grow in their order."""

    def __init__(self, template: Template):
        self.template, self.written, self.attachments, self.at = template, [], [], 0
        self.text: list[bytes] = []  # neighbouring texts, escaped together since a control string may arise between them

    def visit(self, part: dict) -> None:
        kind = part["kind"] or "text"
        getattr(self, f"visit_{kind}" if kind in ("text", "image", "audio", "document") else "visit_other")(part)

    def put(self, data: bytes) -> None:
        self.written.append(data)
        self.at += code_points(data)

    def flush(self) -> None:
        self.put(escape(b"".join(self.text), self.template))
        self.text = []

    def attach(self, part: dict, mark: str, tokens: int) -> None:
        self.flush()
        self.attachments.append({"kind": part["kind"], "ref": part["ref"], "start": self.at, "tokens": tokens})
        self.put(mark.encode())

    def visit_text(self, part: dict) -> None:
        self.text.append((part["text"] or "").encode())

    def visit_image(self, part: dict) -> None:
        across, down = (math.ceil(max(part[side] or 1, 1) / self.template.patch) for side in ("width", "height"))
        self.attach(part, self.template.image, across * down)

    def visit_audio(self, part: dict) -> None:
        seconds = part["seconds"] or 0.0
        self.attach(part, self.template.audio, math.ceil(seconds * self.template.audio_tokens) if 0 < seconds < math.inf else 0)

    def visit_document(self, part: dict) -> None:
        self.attach(part, self.template.document, max(part["pages"] or 0, 0) * self.template.page_tokens)
        self.visit_text(part)

    def visit_other(self, part: dict) -> None:
        self.attach(part, self.template.file, 0)


def format_turn(role: str | None, parts: list[dict] | None, template: Template) -> tuple[bytes, list[dict], int, int]:
    """The formatted turn, its attachments, and where in it the text under the loss mask is (characters)."""
    flat = Flatten(template)
    under = role in template.loss_roles
    flat.put(template.begin.encode() + escape((role or "").encode(), template) + (template.loss if under else template.no_loss).encode())
    start = flat.at
    for part in parts or []:
        if part is not None:
            flat.visit(part)
    flat.flush()
    stop = flat.at
    flat.put(template.end.encode())
    return b"".join(flat.written), flat.attachments, start, stop if under else start


def read_turns(data: bytes, template: Template) -> Iterator[tuple[bytes, bytes, bool]]:
    """``(role, content, under the loss mask)`` of each turn of a formatted chunk.

    Placeholders stay in the content; the text of the parts around them is unescaped.
    """
    begin, no_loss, loss, end = template.marks[:4]
    opening = any_of((no_loss, loss))
    at = 0
    while at < len(data):
        opened = opening.search(data, at)
        stop = data.index(end, opened.end())
        yield unescape(data[at + len(begin):opened.start()]), unescape(data[opened.end():stop]), opened[0] == loss
        at = stop + len(end)


def text_parts(text: Column) -> Column:
    """The parts of a turn that is plain text; a null text has no part."""
    kinds = {f.name: f.dataType for f in T.DataType.fromDDL(PARTS).elementType.fields}
    fields = [F.lit("text").alias("kind"), text.alias("text"), *[F.lit(None).cast(k).alias(n) for n, k in list(kinds.items())[2:]]]
    return F.when(text.isNotNull(), F.array(F.struct(*fields))).cast(PARTS)


def format_turns(df: DataFrame, template: Template = Template(), conv: str = "conv_id", turn: str = "turn",
                 role: str = "role", parts: str = "parts") -> DataFrame:
    """Rows ``(conv_id, turn, role, formatted, attachments, tokens, loss_start, loss_stop)``, one for each row of ``df``.

    ``parts`` has the type PARTS.  ``attachments`` lists what is no text in order, with its place in
    characters of ``formatted`` and the tokens it expands to; ``tokens`` is their sum.  Characters
    ``loss_start`` to ``loss_stop`` are under the loss mask (none: both are equal).  A null list, part
    or text counts as empty, a null kind as text, a null role as an empty one; a part of another kind
    leaves a ``<file>`` of no tokens.  Repeated rows give repeated turns; other columns are not read.
    """
    kinds = [df.schema[c].dataType.simpleString() for c in (conv, turn)]
    schema = (f"conv_id {kinds[0]}, turn {kinds[1]}, role string, formatted binary, attachments {ATTACHMENTS}, tokens long, "
              "loss_start long, loss_stop long")

    def formatted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        listed = pa.list_(pa.struct([("kind", pa.string()), ("ref", pa.string()), ("start", pa.int64()), ("tokens", pa.int64())]))
        for batch in batches:
            done = [format_turn(r.as_py(), p.as_py(), template) for r, p in zip(batch.column(2), batch.column(3), strict=True)]
            columns = [pa.array([d[0] for d in done], pa.binary()), pa.array([d[1] for d in done], listed),
                       pa.array([sum(a["tokens"] for a in d[1]) for d in done], pa.int64()),
                       pa.array([d[2] for d in done], pa.int64()), pa.array([d[3] for d in done], pa.int64())]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], *columns], names=[
                "conv_id", "turn", "role", "formatted", "attachments", "tokens", "loss_start", "loss_stop"])

    rows = text_batches(df).select(F.col(conv).alias("conv_id"), F.col(turn).alias("turn"), F.col(role).alias("role"),
                                   F.col(parts).cast(PARTS).alias("parts"))
    return rows.mapInArrow(formatted, schema).withColumn("formatted", F.col("formatted").cast("string"))


def conversations(turns: DataFrame) -> DataFrame:
    """Rows ``(conv_id, slice, chunk, whole, formatted)``: the formatted conversations in chunks.

    Chunks of a conversation follow each other by (slice, chunk) and hold whole turns, about CHUNK_BYTES
    together.  ``whole`` is true where a chunk is known to be all of its conversation; a conversation that
    a slice begins or ends with may go on in another slice.  Turns of a conversation are ordered by turn
    (null first), then by role and a hash of the turn; repeated rows are told apart by a number of their
    own, so a slice can end between any two rows.  Rows of a null conversation make one conversation.
    """
    conv_type = turns.schema["conv_id"].dataType.simpleString()
    keyed = turns.select("conv_id", "turn", "role", F.xxhash64("formatted").alias("__hash"),
                         F.monotonically_increasing_id().alias("__row"), F.col("formatted").cast("binary").alias("formatted"))
    order = ["conv_id", "turn", "role", "__hash", "__row"]
    dealt = keyed.repartitionByRange(*order).sortWithinPartitions(*order)
    return (dealt.select("conv_id", F.spark_partition_id().alias("slice"), "formatted")
            .mapInArrow(_chunks, f"conv_id {conv_type}, slice int, chunk long, whole boolean, formatted binary")
            .withColumn("formatted", F.col("formatted").cast("string")))


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Chunks of one sorted slice, some at a time."""
    done: list[tuple] = []
    conv = number = alone = kind = at = None
    data, size, waiting = [], 0, 0

    def flushed() -> pa.RecordBatch:
        columns = [list(c) for c in zip(*done, strict=True)]
        types = [kind, pa.int32(), pa.int64(), pa.bool_(), pa.binary()]
        done.clear()
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)],
                                          names=["conv_id", "slice", "chunk", "whole", "formatted"])

    for batch in batches:
        kind = batch.column(0).type
        for c, here, turn in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
            if data and (c != conv or size + len(turn) > CHUNK_BYTES):
                done.append((conv, at, number, alone and c != conv, b"".join(data)))
                alone, number = c != conv, 0 if c != conv else number + 1
                waiting += size
                data, size = [], 0
                if waiting > CHUNK_BYTES:
                    yield flushed()
                    waiting = 0
            elif not data:
                alone, number = False, 0  # the first conversation may have begun in an earlier slice
            conv, at = c, here
            data.append(turn)
            size += len(turn)
    if data:
        done.append((conv, at, number, False, b"".join(data)))
        yield flushed()


def digests(chunks: DataFrame, template: Template = Template()) -> DataFrame:
    """Rows ``(conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars)``, read back from the chunks.

    ``turns_sha256`` digests role, line end, text, line end of each turn; ``loss_sha256`` all text under the
    loss mask.  A chunk that is a whole conversation is digested where it is; the chunks of others go to one
    task a conversation, which passes them through the digest one by one in order (a digest has no parts that
    could be joined), so its memory does not grow with the conversation.
    """
    conv_type = chunks.schema["conv_id"].dataType.simpleString()
    figures = "n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            for whole, data in zip(batch.column(3).to_pylist(), batch.column(4).to_pylist(), strict=True):
                found = list(read_turns(data, template))
                turns = b"".join(role + b"\n" + text + b"\n" for role, text, _ in found)
                loss = b"".join(text for _, text, under in found if under)
                sums = [hashlib.sha256(x).hexdigest() if whole else None for x in (turns, loss)]
                out.append((len(found), sums[0], code_points(loss), sums[1], code_points(data), *((None, None) if whole else (turns, loss))))
            columns = [list(c) for c in zip(*out, strict=True)] if out else [[]] * 7
            types = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.binary(), pa.binary()]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:3], *[pa.array(c, t) for c, t in zip(columns, types, strict=True)]],
                names=["conv_id", "slice", "chunk", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars", "turns", "loss"])

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Whole conversations as they are, the others as the sums over their chunks."""
        open_conv, sums, hashes = None, [0, 0, 0], ()
        names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]

        def closed() -> tuple:
            return (open_conv[0], sums[0], hashes[0].hexdigest(), sums[1], hashes[1].hexdigest(), sums[2])

        for batch in batches:
            out, kind = [], batch.schema.field(0).type
            for conv, n, t_sum, chars, l_sum, size, turns, loss in zip(*[batch.column(k).to_pylist() for k in (0, 3, 4, 5, 6, 7, 8, 9)], strict=True):
                if open_conv and (t_sum is not None or conv != open_conv[0]):
                    out.append(closed())
                    open_conv = None
                if t_sum is not None:
                    out.append((conv, n, t_sum, chars, l_sum, size))
                    continue
                if not open_conv:
                    open_conv, sums, hashes = (conv, kind), [0, 0, 0], (hashlib.sha256(), hashlib.sha256())
                for k, x in enumerate((n, chars, size)):
                    sums[k] += x
                hashes[0].update(turns)
                hashes[1].update(loss)
            yield _rows(out, kind, names)
        if open_conv:
            yield _rows([closed()], open_conv[1], names)

    parsed = (chunks.select("conv_id", "slice", "chunk", "whole", F.col("formatted").cast("binary").alias("formatted"))
              .mapInArrow(read, f"conv_id {conv_type}, slice int, chunk long, {figures}, turns binary, loss binary"))
    return (parsed.repartition("conv_id").sortWithinPartitions("conv_id", "slice", "chunk")
            .mapInArrow(joined, f"conv_id {conv_type}, {figures}"))


def _rows(out: list[tuple], kind: pa.DataType, names: list[str]) -> pa.RecordBatch:
    columns = [list(c) for c in zip(*out, strict=True)] if out else [[]] * len(names)
    types = [kind, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=names)
