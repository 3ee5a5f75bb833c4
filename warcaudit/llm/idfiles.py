"""Token ids of documents as binary files: one array of ids, and Elias-Fano codes of boundaries and document ids.

A set of files is a folder with one or more files for each range of document ids and a ``manifest``, a Parquet table
with a row for each file. A file is

* ``TOKENIDS``
* the ids of its documents one after the other, 2 or 4 bytes each, little-endian
* where each document begins, and the end, as an Elias-Fano code
* the document ids less the least of them, as another; documents without id come last and are only counted
* a footer of fixed size with counts and lengths, and ``TOKENIDS`` again

Documents are encoded where they lie, and their ids dealt out by ranges of document ids. Only the rows of the manifest that
Spark commits count, so what a lost or repeated task wrote is never read. A file's place in the whole is the sum over the files
before it. Ids stream into a file; a task holds the boundaries of one file and never its ids.
"""

from __future__ import annotations

import gc
import json
import re
import struct
import unicodedata
import uuid
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..sources.streams import open_path
from .boundaries import EliasFano
from .store import require

MARK = b"TOKENIDS"
_FOOTER = struct.Struct("<BxxxxxxxQQQqQQ8s")
REMEMBERED = 600_000
"""Pieces of texts whose ids each Python worker keeps; twice as many at most."""
LONG_PIECE = 64
TOGETHER = 1_000
"""New pieces that the library gets in one text."""
FILE_IDS = 1 << 27
"""Ids after which a task begins another file; a longer document is still one file."""
RANGE_BYTES = 1 << 28
"""Text of the documents of a range, so about a quarter of a gigabyte; their ids are half of that."""
SAMPLE = 100_000
"""Documents, on average, whose ids and sizes reach the driver to cut the ranges."""
READ_IDS = 1 << 19
"""Ids that a reader holds at once, but for longer documents."""
MANIFEST = "part int, number int, path string, n_docs bigint, n_ids bigint, n_bytes bigint"


# ---- ids ----------------------------------------------------------------------------------------
# Fixed value: how the tokenizer cuts its lower-case text; what follows spells out letters and numbers below U+0250.
CUTS = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
_LOW = [chr(c) for c in range(0xA1, 0x250)]
_LETTERS = "a-z" + "".join(sorted({x for c in _LOW if unicodedata.category(c)[0] == "L" for x in c.lower()}))
_NUMBERS = "0-9" + "".join(c for c in _LOW if unicodedata.category(c)[0] == "N")
# The same pattern, letters first: what the alternatives begin with differs, but for the last two kinds.
_CUT = re.compile(f"[{_LETTERS}]+|[{_NUMBERS}]|'(?:[stmd]|re|ve|ll)|[^\\s{_LETTERS}{_NUMBERS}]+")
# Anything but printable ASCII, ASCII white space, and Latin letters and signs that normalisation leaves alone.
_UNUSUAL = re.compile("[^\t-\r -~\u00a1-\u012f\u0131-\u024f]")


class Encoder:
    """Ids of texts as the tokenizers library gives them, without truncation, padding or added special tokens.

    The tokenizer drops white space, puts the text in lower case, cuts it by a pattern and encodes what lies between
    the cuts, each by itself. Latin texts are cut here and the library is asked only for pieces it was not asked for
    before; of other texts, and of those that may hold a special token, it gets each part between white space whole.
    Ids are remembered; when full, the older half goes and what is still in use moves over.
    """

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        with open(path) as f:
            split = json.load(f)["pre_tokenizer"]["pretokenizers"][0]
        if split.get("behavior") != "Removed" or split.get("pattern") != {"Regex": CUTS}:
            raise ValueError("only tokenizers that drop white space and cut texts as this one does are supported")
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        size = self.tokenizer.get_vocab_size(with_added_tokens=True)
        self.kind = id_kind(size)
        self.closing = np.zeros(size, bool)
        self.closing[[i for token, i in self.tokenizer.get_vocab().items() if token.endswith("</w>")]] = True
        self.young: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    @staticmethod
    def cut(text: str, whole: set[str]) -> list[str]:
        """Pieces of a text that are encoded by themselves; those that the library has to get alone also go to ``whole``."""
        if not _UNUSUAL.search(text) and "<|" not in text:
            return _CUT.findall(text.lower())
        pieces = []
        for part in text.encode().split():
            part = part.decode()
            if _UNUSUAL.search(part) or "<|" in part:
                # It may hold several words, or a special token.
                pieces.append(part)
                whole.add(part)
            else:
                pieces += _CUT.findall(part.lower())
        return pieces

    def _asked(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(found.ids, self.kind) for found in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _learn(self, new: list[str]) -> None:
        """Many at a time, with spaces between: the last token of each piece is one that closes a word."""
        groups = [new[k: k + TOGETHER] for k in range(0, len(new), TOGETHER)]
        for group, ids in zip(groups, self._asked([" ".join(g) for g in groups])):
            ends = np.flatnonzero(self.closing[ids]) + 1
            if len(ends) == len(group):
                data, at = ids.tobytes(), [0, *(ends * ids.itemsize).tolist()]
                self.young.update(zip(group, (data[a:b] for a, b in zip(at, at[1:]))))
            else:
                self.young.update(zip(group, (x.tobytes() for x in self._asked(group))))

    def encode(self, texts: list[str], end: int) -> list[bytes]:
        """The ids of each text and the end id, little-endian."""
        if len(self.young) > REMEMBERED:
            self.older, self.young = self.young, {}
        # Millions of short strings in lists, none of them in a cycle: the collector would look at all again and again.
        collecting = gc.isenabled()
        gc.disable()
        try:
            whole: set[str] = set()
            split = [self.cut(t, whole) for t in texts]
            known = self.young
            missing = set().union(*split).difference(known)
            again = missing & self.older.keys()
            for p in again:
                known[p] = self.older[p]
            new = missing - again
            self._learn(list(new - whole))
            alone = list(new & whole)
            known.update(zip(alone, (x.tobytes() for x in self._asked(alone))))
            last = np.array([end], self.kind).tobytes()
            found = [b"".join(map(known.__getitem__, pieces)) + last for pieces in split]
            for p in new:
                if len(p) > LONG_PIECE:
                    del known[p]
            return found
        finally:
            if collecting:
                gc.enable()


def id_kind(vocabulary: int) -> str:
    return "<u2" if vocabulary <= 1 << 16 else "<u4"


@cache
def encoder(path: str) -> Encoder:
    return Encoder(path)


class Ranges:
    """Where the ranges of documents begin, by id and digest of the text; a document's range is the last that begins before it.

    Documents without id are in the last range.
    """

    def __init__(self, begins: list[tuple[int, int]]) -> None:
        self.ids = np.array([b[0] for b in begins], np.int64)
        self.digests = np.array([b[1] for b in begins], np.int64)

    def of(self, ids: pa.Array, digests: pa.Array) -> np.ndarray:
        unnamed = ids.is_null().to_numpy(zero_copy_only=False)
        ids, digests = ids.fill_null(0).to_numpy(), digests.to_numpy()
        low, high = np.searchsorted(self.ids, ids, "left"), np.searchsorted(self.ids, ids, "right")
        out = low.copy()
        # Only ids that ranges begin with: there the digest decides.
        for value in np.unique(ids[low < high]):
            here = ids == value
            first, last = low[here][0], high[here][0]
            out[here] = first + np.searchsorted(self.digests[first:last], digests[here], "right")
        out[unnamed] = len(self.ids)
        return out


def _ranges(rows: DataFrame, least: int, range_bytes: int) -> tuple[Ranges, int]:
    """Begins of ranges with about as many bytes each, and how many ranges, by a sample of documents chosen by hash.

    The sample only decides how evenly the work is dealt, not what is written. Copies are counted, not collected.
    """
    steps = 1 << 30
    share = min(steps, max(1, SAMPLE * steps // max(rows.count(), 1)))
    chosen = F.pmod(F.xxhash64("doc", "digest"), F.lit(steps)) < F.lit(share)
    found = rows.filter(F.col("doc").isNotNull() & chosen).groupBy("doc", "digest").agg(F.sum("size").alias("size")).collect()
    found = sorted((r.doc, r.digest, r.size) for r in found)
    upto = np.cumsum([r[2] for r in found], dtype=np.int64)
    total = int(upto[-1]) if found else 0
    parts = max(least, -(-total * steps // (share * range_bytes)))
    begins = np.searchsorted(upto, np.arange(1, parts) * total / parts) if found else []
    return Ranges([found[k][:2] for k in sorted(set(begins))]), parts


def encoded(doc: Column, digest: Column, text: Column, path: str, end: int, ranges: Ranges) -> Column:
    """Range of each document, and ids of each whole text with the end id, in the file's width; null is an empty text."""
    def run(docs: pa.Array, digests: pa.Array, column: pa.Array) -> pa.Array:
        parts = []
        for k in range(0, max(len(column), 1), 256):
            texts = [t or "" for t in column.slice(k, 256).to_pylist()]
            parts.append(pa.array(encoder(path).encode(texts, end), pa.binary()))
        return pa.StructArray.from_arrays([pa.array(ranges.of(docs, digests), pa.int32()), pa.concat_arrays(parts)], names=["part", "ids"])

    return F.arrow_udf(run, "part int, ids binary")(doc, digest, text)


# ---- files --------------------------------------------------------------------------------------
class _Writer:
    """One file that ids stream into."""

    def __init__(self, path: str, kind: str) -> None:
        self.path, self.kind = path, np.dtype(kind)
        place, inner = open_path(path)
        place.create_dir(inner.rpartition("/")[0], recursive=True)
        self.sink = place.open_output_stream(inner, compression=None)
        self.sink.write(MARK)
        self.starts: list[int] = [0]
        self.docs: list[int] = []
        self.nulls = 0

    @property
    def n_ids(self) -> int:
        return self.starts[-1]

    def add(self, doc: int | None, ids: bytes) -> None:
        self.sink.write(ids)
        self.starts.append(self.n_ids + len(ids) // self.kind.itemsize)
        if doc is None:
            self.nulls += 1
        else:
            self.docs.append(doc)

    def close(self) -> tuple[str, int, int, int]:
        least = self.docs[0] if self.docs else 0
        # Differences of signed 64-bit ids fit unsigned 64 bits.
        names = np.array(self.docs, np.int64).astype(np.uint64) - np.uint64(least % (1 << 64))
        starts, names = EliasFano.of(np.array(self.starts, np.uint64)).to_bytes(), EliasFano.of(names).to_bytes()
        footer = _FOOTER.pack(self.kind.itemsize, len(self.starts) - 1, self.n_ids, self.nulls, least, len(starts), len(names), MARK)
        self.sink.write(starts + names + footer)
        size = self.sink.tell()
        self.sink.close()
        return self.path, len(self.starts) - 1, self.n_ids, size


class IdFile:
    """A written file: its documents in any order, through ``select`` on the codes."""

    def __init__(self, path: str) -> None:
        place, inner = open_path(path)
        self.source = place.open_input_file(inner)
        self.source.seek(self.source.size() - _FOOTER.size)
        width, self.n_docs, self.n_ids, self.nulls, self.least, n_starts, n_names, mark = _FOOTER.unpack(self.source.read(_FOOTER.size))
        if mark != MARK:
            raise ValueError(f"'{path}' is no file of token ids")
        self.kind = np.dtype(f"<u{width}")
        self.source.seek(len(MARK) + self.n_ids * width)
        self.starts = EliasFano.from_bytes(self.source.read(n_starts))
        self.names = EliasFano.from_bytes(self.source.read(n_names))

    def begins(self, k: np.ndarray) -> np.ndarray:
        """Where documents begin in the file's ids; that of the number of documents is the end."""
        return self.starts.select(k).astype(np.int64)

    def docs(self, k: np.ndarray) -> list[int | None]:
        """Ids of documents; None for those without."""
        k = np.asarray(k)
        named = k[k < len(self.names)]
        values = (self.names.select(named) + np.uint64(self.least % (1 << 64))).astype(np.int64).tolist()
        return values + [None] * (len(k) - len(named))

    def ids(self, begin: int, end: int) -> np.ndarray:
        """Token ids from one place to another."""
        self.source.seek(len(MARK) + int(begin) * self.kind.itemsize)
        return np.frombuffer(self.source.read((int(end) - int(begin)) * self.kind.itemsize), self.kind)

    def document(self, k: int) -> np.ndarray:
        return self.ids(*self.begins(np.array([k, k + 1])))

    def close(self) -> None:
        self.source.close()


def _write_files(folder: str, kind: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number, writer = None, 0, None

        def row() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(
                (part, number, *writer.close()), (pa.int32(), pa.int32(), pa.string(), *[pa.int64()] * 3))],
                names=["part", "number", "path", "n_docs", "n_ids", "n_bytes"])

        for batch in batches:
            for here, doc, ids in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
                if writer is not None and (here != part or writer.n_ids >= FILE_IDS):
                    yield row()
                    writer = None
                if writer is None:
                    part, number = here, number + 1 if here == part else 0
                    writer = _Writer(f"{folder}/{part:06d}-{number:04d}-{uuid.uuid4().hex}.ids", kind)
                writer.add(doc, ids.as_py())
        if writer is not None:
            yield row()

    return run


def write(docs: DataFrame, path: str, end: int, folder: str, ident: str = "doc_id", text: str = "text",
          range_bytes: int = RANGE_BYTES) -> DataFrame:
    """Encode every whole text, append the end id, and write the ids in ascending order of ``ident``; returns the manifest.

    Null and empty texts are only the end id. Rows without id come last, written by one task as a stream; rows with the
    same id follow each other in an order by their texts' digests; repeated rows are all written. Other columns are not
    looked at, whatever their names. An empty table gives a manifest without rows. ``ident`` has to be a whole number.
    ``range_bytes`` is what a range of documents should have of text; a single document is never cut.
    """
    require(docs, ident, text)
    spark = docs.sparkSession
    rows = docs.select(F.col(ident).cast("bigint").alias("doc"), F.col(text).alias("text")).select(
        "doc", F.xxhash64("text").alias("digest"), (F.coalesce(F.octet_length("text"), F.lit(0)).cast("bigint") + 1).alias("size"), "text")
    least = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    ranges, parts = _ranges(rows.drop("text"), least, range_bytes)
    # Only ids are dealt, and each text is encoded once, where it lies.
    ids = rows.select("doc", "digest", encoded(F.col("doc"), F.col("digest"), F.col("text"), path, end, ranges).alias("found"))
    dealt = ids.select("doc", "digest", "found.part", "found.ids").repartitionById(parts, F.col("part"))
    dealt = dealt.sortWithinPartitions("part", F.col("doc").asc_nulls_last(), "digest").select("part", "doc", "ids")
    dealt.mapInArrow(_write_files(folder, encoder(path).kind), MANIFEST).write.parquet(f"{folder}/manifest")
    return read_manifest(spark, folder)


def read_manifest(spark: SparkSession, folder: str) -> DataFrame:
    """One row for each file, with the number of ids of all files before it in ``base``."""
    before = Window.orderBy("part", "number").rowsBetween(Window.unboundedPreceding, -1)
    files = spark.read.schema(MANIFEST).parquet(f"{folder}/manifest")
    return files.withColumn("base", F.coalesce(F.sum("n_ids").over(before), F.lit(0)))


def read(spark: SparkSession, folder: str) -> DataFrame:
    """All documents of written files: ``doc_id``, ``start`` in the whole, ``n_tokens``, and ``ids`` as little-endian 32 bits.

    Each file is a task's work; boundaries come from ``select``, a stretch of documents at a time.
    """
    files = read_manifest(spark, folder).select("path", "base")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, base in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                yield from _documents(path, base)

    count = max(1, files.count())
    return files.repartition(count).mapInArrow(run, "doc_id bigint, start bigint, n_tokens bigint, ids binary")


def _documents(path: str, base: int) -> Iterator[pa.RecordBatch]:
    file = IdFile(path)
    at, step = 0, 4_096
    while at < file.n_docs:
        begins = file.begins(np.arange(at, min(at + step, file.n_docs) + 1))
        # As many documents as fit, but at least one.
        n = max(1, int(np.searchsorted(begins, begins[0] + READ_IDS, "right")) - 1)
        begins = begins[: n + 1]
        ids = file.ids(begins[0], begins[-1]).astype("<u4")
        offsets = pa.py_buffer(((begins - begins[0]) * 4).astype(np.int64).tobytes())
        column = pa.LargeBinaryArray.from_buffers(pa.large_binary(), n, [None, offsets, pa.py_buffer(ids.tobytes())])
        yield pa.RecordBatch.from_arrays(
            [pa.array(file.docs(np.arange(at, at + n)), pa.int64()), pa.array(begins[:-1] + base, pa.int64()),
             pa.array(np.diff(begins), pa.int64()), column.cast(pa.binary())], names=["doc_id", "start", "n_tokens", "ids"])
        at += n
    file.close()
