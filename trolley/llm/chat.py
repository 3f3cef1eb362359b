"""Chat formatting: conversations as one marked-up text each, with the spans that carry loss.

Template, turn by turn::

    <turn ROLE>\\nTEXT</turn>\\n

A backslash goes before every backslash and ``<`` of a text, and before these and ``>`` of a role, so
no text can look like a mark and the reading back is exact.

The text is assembled column by column: segment lengths and their cumulative offsets say where each
byte of headers and contents belongs, and numpy scatters them into one preallocated buffer that
becomes the Arrow column.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

HEAD, MID, TAIL = b"<turn ", b">\n", b"</turn>\n"
BACKSLASH, OPEN, CLOSE = ord("\\"), ord("<"), ord(">")
#: A conversation's text is cut into parts of about so many bytes, so that none has to fit in memory.
PART_BYTES = 4 << 20
#: Contents are scattered in steps of so many bytes.
STEP = 1 << 20

FORMATTED = (
    "conv_id bigint, part bigint, n_turns bigint, formatted string, "
    "loss_spans array<struct<start:bigint,end:bigint>>"
)
_SPANS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
_ARROW = pa.schema(
    [("conv_id", pa.int64()), ("part", pa.int64()), ("n_turns", pa.int64()), ("formatted", pa.string()), ("loss_spans", _SPANS)]
)
DIGEST = (
    "conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, "
    "loss_sha256 string, formatted_chars bigint"
)
TURN = re.compile(rb"<turn ([^\\>]*(?:\\.[^\\>]*)*)>\n([^\\<]*(?:\\.[^\\<]*)*)</turn>\n", re.S)


def _bytes(column: pa.StringArray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all values, and the offsets of each value in them."""
    offsets = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = column.buffers()[2]
    raw = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if data else np.empty(0, np.uint8)
    return raw, offsets - offsets[0]


def _escapes(raw: np.ndarray, marks: tuple[int, ...]) -> np.ndarray:
    """Positions of the bytes that get a backslash."""
    table = np.zeros(256, bool)
    table[list(marks)] = True
    found = [np.flatnonzero(table[raw[a : a + STEP]]) + a for a in range(0, len(raw), STEP)]
    return np.concatenate(found) if found else np.empty(0, np.int64)


def _scatter(out: np.ndarray, at: np.ndarray, raw: np.ndarray, offsets: np.ndarray, escaped: np.ndarray) -> None:
    """Copy value i of ``raw`` to ``at[i]`` of ``out``, with its backslashes."""
    shift = at - offsets[:-1] - np.searchsorted(escaped, offsets[:-1])
    for a in range(0, len(raw), STEP):
        source = np.arange(a, min(a + STEP, len(raw)))
        value = np.searchsorted(offsets, source, "right") - 1
        target = source + shift[value] + np.searchsorted(escaped, source, "right")
        out[target] = raw[a : a + STEP]
        low, high = np.searchsorted(escaped, [a, a + STEP])
        out[target[escaped[low:high] - a] - 1] = BACKSLASH


def assemble(roles: pa.StringArray, texts: pa.StringArray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """All turns in one buffer: its bytes, each turn's offset, and where each text begins and ends."""
    (role, role_at), (text, text_at) = _bytes(roles), _bytes(texts)
    role_esc, text_esc = _escapes(role, (BACKSLASH, OPEN, CLOSE)), _escapes(text, (BACKSLASH, OPEN))
    lengths = np.empty((len(roles), 5), np.int64)
    lengths[:, [0, 2, 4]] = len(HEAD), len(MID), len(TAIL)
    lengths[:, 1] = np.diff(role_at) + np.diff(np.searchsorted(role_esc, role_at))
    lengths[:, 3] = np.diff(text_at) + np.diff(np.searchsorted(text_esc, text_at))
    ends = lengths.cumsum().reshape(lengths.shape)
    starts = ends - lengths
    out = np.empty(int(lengths.sum()), np.uint8)
    for k, mark in ((0, HEAD), (2, MID), (4, TAIL)):
        out[starts[:, k, None] + np.arange(len(mark))] = np.frombuffer(mark, np.uint8)
    _scatter(out, starts[:, 1], role, role_at, role_esc)
    _scatter(out, starts[:, 3], text, text_at, text_esc)
    return out, np.append(starts[:, 0], len(out)), starts[:, 3], ends[:, 3]


def _formatted(table: pa.Table, first: np.ndarray, part: int) -> pa.RecordBatch:
    """One row for each run of turns that starts at ``first``."""
    roles, texts = (table.column(c).combine_chunks() for c in ("role", "text"))
    out, turns, begin, end = assemble(roles, texts)
    bounds = np.append(first, len(table))
    at = turns[bounds]
    spoken = np.flatnonzero(pc.equal(roles, "assistant").to_numpy(zero_copy_only=False))
    row = np.searchsorted(first, spoken, "right") - 1
    spans = pa.StructArray.from_arrays([pa.array(x[spoken] - at[row]) for x in (begin, end)], ["start", "end"])
    lists = pa.ListArray.from_arrays(pa.array(np.searchsorted(spoken, bounds), pa.int32()), spans)
    text = pa.StringArray.from_buffers(len(first), pa.py_buffer(at.astype(np.int32)), pa.py_buffer(out))
    return pa.RecordBatch.from_arrays(
        [table.column("conv_id").combine_chunks().take(pa.array(first)), pa.array(part + np.arange(len(first))), pa.array(np.diff(bounds)), text, lists.cast(_SPANS)],
        schema=_ARROW,
    )


def _format_partition(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Turns in order come in, conversations go out; a conversation goes on in another part when it
    is long or its turns lie in several batches."""
    part, base = 0, None
    for batch in batches:
        whole = pa.Table.from_batches([batch])
        if base is None and len(whole):
            base = whole.column("pid")[0].as_py() << 32
        size = np.cumsum(pc.add(pc.binary_length(whole.column("role")), pc.binary_length(whole.column("text"))).to_numpy())
        begin = 0
        while begin < len(whole):
            done = size[begin - 1] if begin else 0
            end = max(begin + 1, int(np.searchsorted(size, done + PART_BYTES, "right")))
            rows = whole.slice(begin, end - begin)
            key = rows.column("conv_id").combine_chunks()
            filled = pc.fill_null(key, -(1 << 63)).to_numpy()
            first = np.append(0, np.flatnonzero(filled[1:] != filled[:-1]) + 1)
            yield _formatted(rows, first, base + part)
            part, begin = part + len(first), end


def format_chats(conversations: DataFrame) -> DataFrame:
    """Text and loss spans of every conversation (columns: ``FORMATTED``).

    Takes conv_id, turn, role, text; other columns are ignored. Turns go by (turn, role, text); equal
    rows are turns of their own. NULL role or text is empty; a NULL conv_id is a conversation like any
    other. ``formatted`` of a conversation's parts in order of ``part`` joins to its whole text;
    ``loss_spans`` are the byte ranges of the assistant's (escaped) texts in their part. Turns are
    dealt by ranges of (conv_id, turn), so that a huge conversation has many tasks.
    """
    turns = (
        conversations.select(
            F.col("conv_id").cast("long"),
            "turn",
            F.coalesce("role", F.lit("")).alias("role"),
            F.coalesce("text", F.lit("")).alias("text"),
        )
        .repartitionByRange("conv_id", "turn")
        .sortWithinPartitions("conv_id", "turn", "role", "text")
        .select("conv_id", "role", "text", F.spark_partition_id().cast("long").alias("pid"))
    )
    return turns.mapInArrow(_format_partition, FORMATTED)


def unescape(text: bytes) -> bytes:
    return re.sub(rb"\\(.)", rb"\1", text, flags=re.S) if b"\\" in text else text


def read_turns(formatted: bytes) -> Iterator[tuple[bytes, bytes]]:
    """(role, text) of each turn of a formatted text."""
    at = 0
    for found in TURN.finditer(formatted):
        if found.start() != at:
            break
        at = found.end()
        yield unescape(found[1]), unescape(found[2])
    if at != len(formatted):
        raise ValueError("not a formatted conversation")


class _Digest:
    def __init__(self, conv_id: int | None):
        self.row = {"conv_id": conv_id, "n_turns": 0, "loss_chars": 0, "formatted_chars": 0}
        self.turns, self.loss = hashlib.sha256(), hashlib.sha256()

    def add(self, formatted: str, spans: list[dict]) -> None:
        raw = formatted.encode()
        self.row["formatted_chars"] += len(formatted)
        for role, text in read_turns(raw):
            self.row["n_turns"] += 1
            self.turns.update(b"%b\n%b\n" % (role, text))
        for span in spans:
            text = unescape(raw[span["start"] : span["end"]])
            self.row["loss_chars"] += len(text.decode())
            self.loss.update(text)

    def result(self) -> dict:
        return self.row | {"turns_sha256": self.turns.hexdigest(), "loss_sha256": self.loss.hexdigest()}


def _digest_partition(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([(c.split()[0], pa.string() if c.endswith("string") else pa.int64()) for c in DIGEST.split(", ")])
    open_ = None
    for batch in batches:
        done = []
        for row in batch.to_pylist():
            if open_ is None or open_.row["conv_id"] != row["conv_id"]:
                if open_:
                    done.append(open_.result())
                open_ = _Digest(row["conv_id"])
            open_.add(row["formatted"], row["loss_spans"])
        if done:
            yield pa.RecordBatch.from_pylist(done, schema)
    if open_:
        yield pa.RecordBatch.from_pylist([open_.result()], schema)


def digests(formatted: DataFrame) -> DataFrame:
    """What the formatted texts say when read back, per conversation (columns: ``DIGEST``).

    A hash runs over a conversation from its first part to its last: parts stream through one task
    in order, one at a time.
    """
    return (
        formatted.repartition("conv_id").sortWithinPartitions("conv_id", "part").mapInArrow(_digest_partition, DIGEST)
    )
