"""SentencePiece encoding that keeps source offsets, and decoding.

Normalising goes first: at each byte the longest prefix in the model's compiled character map (a
double-array trie) is replaced, and every normalised byte remembers the source byte it stands for.
The pieces of the normalised text then project to byte spans of the original. Segmentation itself
is the library's, on a copy of the model that normalises nothing.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SPACE = "▁".encode()
ENCODED = "ids array<int>, starts array<bigint>, ends array<bigint>"
DIGEST = "n_tokens bigint, ids_sha256 string, decoded_sha256 string"
#: Rows handed to Python at once; texts can be long.
SLICE = 64


class CharacterMap:
    """The compiled map: size of the trie in bytes (uint32), the trie's units, the replacements."""

    def __init__(self, blob: bytes):
        self.units: list[int] = []
        self.replacements = b""
        if blob:
            size = int.from_bytes(blob[:4], "little")
            self.units = np.frombuffer(blob, "<u4", size // 4, 4).tolist()
            self.replacements = blob[4 + size :]

    def longest(self, text: bytes, at: int) -> tuple[int, bytes]:
        """Length and replacement of the longest entry that begins at ``at``; length 0 if none."""
        units, found, value = self.units, 0, 0
        if not units:
            return 0, b""
        node = _offset(units[0])
        for i in range(at, len(text)):
            node ^= text[i]
            if node >= len(units):
                break
            unit = units[node]
            if unit & 0x800000FF != text[i]:
                break
            node ^= _offset(unit)
            if unit >> 8 & 1:
                found, value = i + 1 - at, units[node] & 0x7FFFFFFF
        if not found:
            return 0, b""
        return found, self.replacements[value : self.replacements.index(b"\0", value)]


def _offset(unit: int) -> int:
    return unit >> 10 << ((unit & 1 << 9) >> 6)


class Codec:
    """One model. Models with user-defined symbols or suffixed white space are refused."""

    def __init__(self, path: str):
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2

        with open(path, "rb") as file:
            blob = file.read()
        model = sentencepiece_model_pb2.ModelProto.FromString(blob)
        if model.trainer_spec.treat_whitespace_as_suffix or any(p.type == p.USER_DEFINED for p in model.pieces):
            raise ValueError("models with user-defined symbols or suffixed white space aren't supported")
        spec = model.normalizer_spec
        self.map = CharacterMap(spec.precompiled_charsmap)
        self.dummy, self.squeeze, self.escape = spec.add_dummy_prefix, spec.remove_extra_whitespaces, spec.escape_whitespaces
        self.library = sentencepiece.SentencePieceProcessor(model_proto=blob)
        model.ClearField("normalizer_spec")
        model.normalizer_spec.MergeFromString(b"")
        model.normalizer_spec.name = "identity"
        model.normalizer_spec.add_dummy_prefix = False
        model.normalizer_spec.remove_extra_whitespaces = False
        model.normalizer_spec.escape_whitespaces = False
        self.bare = sentencepiece.SentencePieceProcessor(model_proto=model.SerializeToString())
        #: Bytes of normalised text that a piece covers. One for a byte piece; unknowns are looked up.
        self.widths = np.array([1 if p.type == p.BYTE else len(p.piece.encode()) for p in model.pieces], np.int64)
        self.byte_fallback = model.trainer_spec.byte_fallback
        self.unknown = self.bare.unk_id()

    def normalise(self, text: str) -> tuple[bytes, np.ndarray]:
        """The normalised bytes, and for each of them, and for the end, its byte in the source."""
        source, space = text.encode(), SPACE if self.escape else b" "
        if not source:
            return b"", np.zeros(1, np.int64)
        if not self.map.units and not self.squeeze:
            raw = np.frombuffer(source, np.uint8)
            widths = np.where(raw == 32, len(space), 1)
            lead = np.full(raw.shape, 0)
            # Bytes inside a character stand for its first byte.
            first = (raw & 0xC0) != 0x80
            lead = np.maximum.accumulate(np.where(first, np.arange(len(raw)), 0))
            align = np.repeat(lead, widths)
            out = source.replace(b" ", space) if self.escape else source
            if self.dummy:
                out, align = space + out, np.concatenate([np.zeros(len(space), np.int64), align])
            return out, np.append(align, len(source))
        pieces: list[tuple[bytes, int]] = []
        at = 0
        while at < len(source):
            width, value = self.map.longest(source, at)
            if not width:
                lead = source[at]
                width = 1 if lead < 0x80 else 2 if lead < 0xE0 else 3 if lead < 0xF0 else 4
                value = source[at : at + width]
            pieces.append((value, at))
            at += width
        out, align = bytearray(), []
        first = next((i for i, p in enumerate(pieces) if p[0] != b" "), len(pieces)) if self.squeeze else 0
        if first == len(pieces):
            return b"", np.zeros(1, np.int64)
        if self.dummy:
            out += space
            align += [pieces[first][1]] * len(space)
        blank = self.squeeze
        for value, where in pieces[first:]:
            if blank and self.squeeze:
                value = value.lstrip(b" ")
            if value:
                shown = value.replace(b" ", space)
                out += shown
                align += [where] * len(shown)
                blank = value.endswith(b" ")
        end = len(source)
        if self.squeeze:
            while out.endswith(space):
                end = align[len(out) - len(space)]
                del out[-len(space) :], align[-len(space) :]
        return bytes(out), np.array([*align, end], np.int64)

    def encode(self, text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids, and the byte span of the source that each piece stands for.

        Of the byte pieces of one character, the last has the character's span, the others are empty.
        """
        normal, align = self.normalise(text)
        ids = np.array(self.bare.encode(normal.decode()), np.int64)
        widths = self.widths[ids]
        if (ids == self.unknown).any():
            pieces = self.bare.encode(normal.decode(), out_type=str)
            for i in np.flatnonzero(ids == self.unknown):
                widths[i] = len(pieces[i].encode())
        bounds = np.append(0, widths.cumsum())
        if bounds[-1] != len(normal):
            raise ValueError("pieces don't cover the text")
        at = align[bounds]
        return ids, at[:-1], at[1:]

    def decode(self, ids: np.ndarray) -> str:
        return self.library.decode(ids.tolist())


@functools.lru_cache(maxsize=4)
def codec(path: str) -> Codec:
    """The model of a file, loaded once per Python worker."""
    return Codec(path)


def _mapped(docs: DataFrame, text: str, keep: list[str], row_of, schema: str, types: list[pa.DataType]) -> DataFrame:
    names = [c.split()[0] for c in schema.replace(",", ", ").split(", ") if c]
    kept = docs.select(*keep, F.coalesce(F.col(text), F.lit("")).alias("_text"))
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema[:-1])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for a in range(0, len(whole), SLICE):
                batch = whole.slice(a, SLICE)
                rows = [row_of(t) for t in batch.column(batch.num_columns - 1).to_pylist()]
                made = [pa.array([r[i] for r in rows], t) for i, t in enumerate(types)]
                yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *made], [*batch.schema.names[:-1], *names])

    return kept.mapInArrow(run, f"{kinds}, {schema}")


def encoded(docs: DataFrame, path: str, keep: list[str], text: str = "text") -> DataFrame:
    """The columns ``keep`` of every row, with ``ids`` and the byte spans ``starts`` and ``ends``.

    NULL text is empty and has no pieces. The file ``path`` must be readable on the executors. Rows
    go one to one; nothing is shuffled.
    """

    def row_of(value: str):
        return codec(path).encode(value)

    kinds = [pa.list_(pa.int32()), pa.list_(pa.int64()), pa.list_(pa.int64())]
    return _mapped(docs, text, keep, row_of, ENCODED, kinds)


def digests(docs: DataFrame, path: str, keep: list[str], text: str = "text") -> DataFrame:
    """As ``encoded``, but with the number of ids, the digest of the ids and that of the decoded text
    instead of the arrays, which so never leave the task."""

    def row_of(value: str):
        own = codec(path)
        ids, starts, ends = own.encode(value)
        if len(starts) and (starts[0] < 0 or ends[-1] > len(value.encode()) or (starts > ends).any()):
            raise ValueError("a piece lies outside its text")
        listed = ids.tolist()
        return (
            len(listed),
            hashlib.sha256(",".join(map(str, listed)).encode()).hexdigest(),
            hashlib.sha256(own.library.decode(listed).encode()).hexdigest(),
        )

    return _mapped(docs, text, keep, row_of, DIGEST, [pa.int64(), pa.string(), pa.string()])


def decoded(rows: DataFrame, path: str, keep: list[str], ids: str = "ids") -> DataFrame:
    """The columns ``keep`` of every row, with the ``decoded`` text of its ids; NULL ids are none."""
    kept = rows.select(*keep, F.coalesce(F.col(ids), F.array().cast("array<int>")).alias("_ids"))
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema[:-1])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [codec(path).library.decode(x) if x else "" for x in batch.column(batch.num_columns - 1).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(texts, pa.string())], [*batch.schema.names[:-1], "decoded"])

    return kept.mapInArrow(run, f"{kinds}, decoded string")
