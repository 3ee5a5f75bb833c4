"""Piece encoding and decoding with a public BPE model, by a table of the last token of every prefix.

The encoding of a text has one last token for each of its prefixes. An automaton over the vocabulary names the
tokens that end at a place; the one that is right is the one that stays apart from the last token of the text
before it. Going back from the end by token lengths gives the ids.

No piece has a space behind another character, so a text falls apart before its runs of spaces, and what one part
encodes to never depends on another. Parts are remembered by each Python worker, at most twice ``REMEMBERED`` at a time.
"""

from __future__ import annotations

import re
import struct
from collections.abc import Iterator
from functools import cache

import ahocorasick
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

REMEMBERED = 150_000
SPACE = "▁"
NORMAL, UNKNOWN, CONTROL, BYTE = 1, 2, 3, 6
RESULT = "struct<ids: binary, n_tokens: bigint, decoded: string>"


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """Field numbers and values of a protocol buffer message."""
    at = 0

    def number() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(data):
        key = number()
        kind = key & 7
        if kind == 0:
            yield key >> 3, number()
            continue
        size = {1: 8, 5: 4}.get(kind) or number()
        yield key >> 3, data[at: at + size]
        at += size


class PieceModel:
    """A BPE model file with identity normalisation, a space put before the text, and byte fallback."""

    def __init__(self, path: str) -> None:
        with open(path, "rb") as f:
            whole = list(_fields(f.read()))
        self.pieces, self.scores, self.kinds = [], [], []
        for field, value in whole:
            if field == 1:
                piece = dict(_fields(value))
                self.pieces.append(piece[1].decode())
                self.scores.append(struct.unpack("<f", piece[2])[0] if 2 in piece else 0.0)
                self.kinds.append(piece.get(3, NORMAL))
        trainer = dict(_fields(next((v for f, v in whole if f == 2), b"")))
        rules = dict(_fields(next((v for f, v in whole if f == 3), b"")))
        if trainer.get(3) != 2 or not trainer.get(35) or rules.get(2) or rules.get(4, 1) or not rules.get(3, 1):
            raise ValueError("only BPE models with byte fallback and plain normalisation are supported")
        self.ids = {p: i for i, (p, k) in enumerate(zip(self.pieces, self.kinds)) if k == NORMAL}
        self.bytes = {int(p[3:5], 16): i for i, (p, k) in enumerate(zip(self.pieces, self.kinds)) if k == BYTE}
        controls = [i for i, k in enumerate(self.kinds) if k == CONTROL]
        self.begin, self.end = self.pieces.index("<s>"), self.pieces.index("</s>")
        if {self.begin, self.end} != set(controls):
            raise ValueError("the model must have <s> and </s> as its control pieces")
        if any(SPACE in p.lstrip(SPACE) for p in self.ids):
            raise ValueError("a piece has a space behind another character")
        joined = {c for p in self.ids if len(p) > 1 for c in p}
        alone = "" if "\n" in joined else "\n"
        self.parts = re.compile(f"{alone or '(?!)'}|[ {SPACE}]*[^ {SPACE}{alone}]+|[ {SPACE}]+")
        self._apart: dict[int, bool] = {}
        self.plain = [" ⁇ " if k == UNKNOWN else "" if k == CONTROL else None if k == BYTE else p.replace(SPACE, " ")
                      for p, k in zip(self.pieces, self.kinds)]
        # Only pieces that encode to themselves are ever tokens.
        self.alone = {p for p in self.ids if self._merged(list(p)) == [p]}
        self.automaton = ahocorasick.Automaton()
        for piece in self.alone:
            self.automaton.add_word(piece, (len(piece), self.ids[piece]))
        self.automaton.make_automaton()
        self.known: _Parts = _Parts(self)

    def _merged(self, symbols: list[str]) -> list[str]:
        """Join the best-scored neighbours, the leftmost first, until no two make a piece."""
        symbols = list(symbols)
        while True:
            best = None
            for k in range(len(symbols) - 1):
                i = self.ids.get(symbols[k] + symbols[k + 1])
                if i is not None and (best is None or self.scores[i] > best[0]):
                    best = self.scores[i], k
            if best is None:
                return symbols
            k = best[1]
            symbols[k: k + 2] = [symbols[k] + symbols[k + 1]]

    def _stay_apart(self, left: int, right: int) -> bool:
        """Whether the text of two tokens encodes to just these two."""
        pair = [self.pieces[left], self.pieces[right]]
        return self._merged(list(pair[0] + pair[1])) == pair

    def encode_part(self, part: str) -> list[int]:
        """Ids of a part, in which spaces are already piece spaces."""
        if part in self.alone:
            return [self.ids[part]]
        last: list[int | None] = [None] * (len(part) + 1)  # None where a character without piece ends
        apart = self._apart
        for at, (size, i) in self.automaton.iter(part):
            at += 1
            if last[at] is None:
                before = last[at - size]
                if before is not None:
                    key = before << 20 | i
                    right = apart.get(key)
                    if right is None:
                        if len(apart) >= REMEMBERED:
                            apart.clear()
                        right = apart[key] = self._stay_apart(before, i)
                    if not right:
                        continue
                last[at] = i
        out: list[int] = []
        at, pieces = len(part), self.pieces
        while at:
            i = last[at]
            if i is None:
                out.extend(self.bytes[b] for b in reversed(part[at - 1].encode()))
                at -= 1
            else:
                out.append(i)
                at -= len(pieces[i])
        out.reverse()
        return out

    def decode(self, ids) -> str:
        """The text of ids: pieces with their spaces, bytes put together, without the space put before."""
        out, pending, first = [], bytearray(), True
        for i in ids:
            kind = self.kinds[i]
            if kind == BYTE:
                pending.append(int(self.pieces[i][3:5], 16))
                continue
            if pending:
                out.append(_from_bytes(bytes(pending)))
                pending, first = bytearray(), False
            if kind == CONTROL:
                continue
            piece = self.plain[i]
            if first and piece[:1] == " " and kind != UNKNOWN:
                piece = piece[1:]
            out.append(piece)
            first = False
        return "".join(out) + _from_bytes(bytes(pending))

    def decode_behind(self, ids: list[int]) -> str:
        """The text of ids that stand behind other text."""
        try:
            return "".join([self.plain[i] for i in ids])
        except TypeError:
            return self.decode([self.ids[SPACE], *ids])

    def encode(self, text: str) -> bytes:
        """All ids of a text as little-endian unsigned 32-bit integers, with begin and end."""
        return self.encode_decode(text)[0]

    def encode_decode(self, text: str) -> tuple[bytes, str]:
        """The ids, and the text that the same ids decode to."""
        parts = self.parts.findall(" " + text) if text else []
        known = self.known
        ids = b"".join([struct.pack("<I", self.begin), *map(known.__getitem__, parts), struct.pack("<I", self.end)])
        if SPACE not in text and known.faithful:
            return ids, text
        return ids, self.decode(struct.unpack(f"<{len(ids) // 4}I", ids))


def _from_bytes(data: bytes) -> str:
    """Bytes as text, where every byte that is part of no character becomes one replacement character."""
    out, at = [], 0
    while at < len(data):
        size = {0: 1, 6: 2, 14: 3, 30: 4}.get(next((data[at] >> s for s, v in ((7, 0), (5, 6), (4, 14), (3, 30)) if data[at] >> s == v), -1), 1)
        try:
            out.append(data[at: at + size].decode())
            at += size
        except UnicodeDecodeError:
            out.append("�")
            at += 1
    return "".join(out)


class _Parts(dict):
    """Ids of parts of texts that were encoded before.

    When it is full it becomes the older half, and what is still in use moves over. The ids of every new part are
    decoded, and ``faithful`` says whether all of them gave the part back, but for piece spaces in it.
    """

    def __init__(self, model: PieceModel) -> None:
        super().__init__()
        self.model = model
        self.older: dict = {}
        self.faithful = True

    def __missing__(self, part: str) -> bytes:
        value = self.older.get(part)
        if value is None:
            ids = self.model.encode_part(part.replace(" ", SPACE))
            self.faithful &= self.model.decode_behind(ids) == part.replace(SPACE, " ")
            value = struct.pack(f"<{len(ids)}I", *ids)
            if len(part) > 64:
                return value
        if len(self) >= REMEMBERED:
            self.older = dict(self)
            self.clear()
        self[part] = value
        return value


@cache
def model(path: str) -> PieceModel:
    """The model of a file, read once by each Python worker."""
    return PieceModel(path)


def encoded(text: Column, path: str) -> Column:
    """Ids (little-endian unsigned 32-bit, begin and end included), their number, and the decoded text of each text.

    Null and empty texts have only begin and end. Whole texts are encoded, however long.
    """
    def part(column: pa.Array) -> pa.Array:
        rows = [model(path).encode_decode(t or "") for t in column.to_pylist()]
        return pa.StructArray.from_arrays(
            [pa.array([r[0] for r in rows], pa.binary()), pa.array([len(r[0]) // 4 for r in rows], pa.int64()),
             pa.array([r[1] for r in rows], pa.string())], names=["ids", "n_tokens", "decoded"])

    def run(column: pa.Array) -> pa.Array:
        # In small steps, so that only Arrow buffers and no Python texts pile up.
        return pa.concat_arrays([part(column.slice(k, 256)) for k in range(0, max(len(column), 1), 256)])

    return F.arrow_udf(run, RESULT)(text)


def decoded(ids: Column, path: str) -> Column:
    """The text of ids as ``encoded`` gives them; null for null."""
    def run(column: pa.Array) -> pa.Array:
        m = model(path)
        return pa.array([None if b is None else m.decode(struct.unpack(f"<{len(b) // 4}I", b))
                         for b in column.to_pylist()], pa.string())

    return F.arrow_udf(run, "string")(ids)


def encode(docs: DataFrame, path: str, text: str = "text", out: str = "pieces") -> DataFrame:
    """All rows and columns of a table, and a column with ids, number and decoded text of its text.

    Each row is worked on alone: repeated rows give repeated results, rows without id are encoded as any other, and
    an empty table gives an empty one. A column named ``out`` is replaced. Nothing is shuffled.
    """
    return docs.withColumn(out, encoded(F.col(text), path))
