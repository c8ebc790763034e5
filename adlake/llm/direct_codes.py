"""Token ids in files of directly addressable codes.

An id is cut into bytes, lowest first. Level 0 of a file holds the lowest byte of every id, level
1 the second byte of the ids that have one, and so on. A bitmap beside each level says which ids
continue; a directory with the number of set bits before every block of 512 turns it into a rank.
The byte of token i on level 0 is at i, and if its bit is set, its next byte is at rank(i) on
level 1: any token is found by a few short reads, without decoding what lies before it, and a
range of tokens is a range on every level.

File: ``HEADER`` (magic, tokens, documents, levels); for each level its number of codes, its
bytes, its bitmap in whole 64-bit words and its directory; then of each document its id, whether
the id is null, and its first token. Integers are little-endian. A document has an end id after
its last token and never spans files.

Order: documents are range-partitioned by (id, hash of text, row), so that rows repeated with one
id are spread too, and each task writes its run of the order as files of at least ``FILE_TOKENS``
(the last one shorter). Files get fresh names, and only those named in the manifest that Spark
commits belong to the result, so a task that is repeated leaves no trace in it. The place of a
file in the order of all ids is the sum of those before it.

Null texts are empty and have the end id alone. Null ids come first. Rows repeated with one id
follow each other in the order of a hash of their text. Very long texts are written whole, as a
file of their own size. An empty table gives an empty result; extra columns are not read.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from adlake.llm.common import slices, staged, staging_path
from adlake.llm.packing import WordIds
from adlake.sources.files import qualified

END_ID = 2
HEADER = struct.Struct("<4sQQQ")
MAGIC = b"DAC1"
LEVEL = struct.Struct("<Q")
#: Bits between two entries of a rank directory.
BLOCK_BITS = 512
BLOCK_WORDS = BLOCK_BITS // 64
#: A task begins a new file after as many tokens.
FILE_TOKENS = 1 << 23
#: Tokens decoded at a time when all documents are read.
RUN_TOKENS = 1 << 17
#: Files whose starts are summed in one group.
FILE_GROUP = 1_024


def words_of(bits: np.ndarray) -> np.ndarray:
    """A bitmap as 64-bit words, its first bit lowest."""
    packed = np.packbits(bits, bitorder="little")
    whole = np.zeros(-(-len(bits) // 64) * 8, dtype=np.uint8)
    whole[: len(packed)] = packed
    return whole.view("<u8")


def directory(words: np.ndarray) -> np.ndarray:
    """Set bits before each block, and in all."""
    ones = np.zeros(-(-len(words) // BLOCK_WORDS) * BLOCK_WORDS, dtype=np.uint64)
    ones[: len(words)] = np.bitwise_count(words)
    return np.concatenate([[0], np.cumsum(ones.reshape(-1, BLOCK_WORDS).sum(axis=1))]).astype("<u8")


class Encoder:
    """Builds one file; holds a byte or two per token."""

    def __init__(self):
        self.levels: list[list[np.ndarray]] = []
        self.more: list[list[np.ndarray]] = []
        self.ids: list = []
        self.starts: list[int] = []
        self.tokens = 0

    def add(self, docs: list, sizes: list[int], ids: np.ndarray) -> None:
        """Consecutive documents: their ids, numbers of tokens and tokens."""
        self.ids += docs
        self.starts += (self.tokens + np.cumsum([0, *sizes[:-1]])).tolist()
        self.tokens += len(ids)
        rest, level = ids, 0
        while len(rest):
            if level == len(self.levels):
                self.levels.append([])
                self.more.append([])
            high = rest >> np.uint32(8)
            on = high > 0
            self.levels[level].append(rest.astype(np.uint8))
            self.more[level].append(on)
            rest, level = high[on], level + 1

    def data(self) -> bytes:
        out = [HEADER.pack(MAGIC, self.tokens, len(self.ids), len(self.levels))]
        for codes, more in zip(self.levels, self.more):
            data, words = np.concatenate(codes).tobytes(), words_of(np.concatenate(more))
            out += [LEVEL.pack(len(data)), data, words.tobytes(), directory(words).tobytes()]
        out.append(np.array([0 if i is None else i for i in self.ids], dtype="<i8").tobytes())
        out.append(np.array([i is None for i in self.ids], dtype=np.uint8).tobytes())
        out.append(np.array([*self.starts, self.tokens], dtype="<u8").tobytes())
        return b"".join(out)


class Codes:
    """A file opened for reading. ``read(offset, size)`` returns bytes; only the header and the
    levels' sizes are read at once."""

    def __init__(self, read):
        self.read = read
        magic, self.tokens, self.documents, levels = HEADER.unpack(read(0, HEADER.size))
        if magic != MAGIC:
            raise ValueError("not a file of directly addressable codes")
        at, self.levels = HEADER.size, []
        for _ in range(levels):
            (count,) = LEVEL.unpack(read(at, LEVEL.size))
            codes = at + LEVEL.size
            words = codes + count
            ranks = words + 8 * -(-count // 64)
            self.levels.append((codes, words, ranks))
            at = ranks + 8 * (-(-count // BLOCK_BITS) + 1)
        self.index_at = at

    def array(self, at: int, count: int, kind: str) -> np.ndarray:
        return np.frombuffer(self.read(at, count * np.dtype(kind).itemsize), dtype=kind)

    def index(self) -> tuple[list, np.ndarray]:
        """Ids of the documents, and their first tokens with the end of the last."""
        ids = self.array(self.index_at, self.documents, "<i8").tolist()
        absent = self.array(self.index_at + 8 * self.documents, self.documents, "u1")
        for n in np.flatnonzero(absent):
            ids[n] = None
        starts = self.array(self.index_at + 9 * self.documents, self.documents + 1, "<u8")
        return ids, starts.astype(np.int64)

    def rank(self, level: int, place: int) -> int:
        """How many codes of a level before ``place`` continue."""
        _, words, ranks = self.levels[level]
        block, left = divmod(place, BLOCK_BITS)
        before = int(self.array(ranks + 8 * block, 1, "<u8")[0])
        if left:
            held = self.array(words + 64 * block, -(-left // 64), "<u8").copy()
            if left % 64:
                held[-1] &= np.uint64((1 << left % 64) - 1)
            before += int(np.bitwise_count(held).sum())
        return before

    def ids(self, start: int, count: int) -> np.ndarray:
        """``count`` token ids from ``start`` on."""
        found = np.zeros(count, dtype="<u4")
        where = np.arange(count)
        place, level = start, 0
        while len(where):
            codes, words, _ = self.levels[level]
            found[where] |= self.array(codes + place, len(where), "u1").astype("<u4") << np.uint32(8 * level)
            first = place // 64
            held = self.array(words + 8 * first, -(-(place + len(where)) // 64) - first, "<u8")
            bits = np.unpackbits(held.view(np.uint8), bitorder="little")
            on = bits[place - 64 * first :][: len(where)].astype(bool)
            where = where[on]
            if len(where):
                place, level = self.rank(level, place), level + 1
        return found

    def token(self, place: int) -> int:
        return int(self.ids(place, 1)[0])


@lru_cache(maxsize=2)
def word_ids(path: str) -> WordIds:
    """One per worker process and file, kept between tasks."""
    return WordIds(path, spelled_out=False)


def open_codes(name: str) -> Codes:
    """The file at a URI, with reads of just the bytes asked for."""
    system, path = fs.FileSystem.from_uri(name)
    source = system.open_input_file(path)

    def read(offset: int, size: int) -> bytes:
        source.seek(offset)
        return source.read(size)

    return Codes(read)


def write(docs: DataFrame, path: str, folder: str) -> DataFrame:
    """Writes files of codes below the URI ``folder``; the manifest: task, number, file,
    documents, tokens."""

    def run(batches):
        system, base = fs.FileSystem.from_uri(folder)
        system.create_dir(base, recursive=True)
        known, end = word_ids(path), np.array([END_ID], dtype="<u4").tobytes()
        task, number, codes = TaskContext.get().partitionId(), 0, Encoder()
        docs, texts = [], []

        def flush() -> None:
            if docs:
                sizes = [len(t) // 4 for t in texts]
                codes.add(list(docs), sizes, np.frombuffer(b"".join(texts), dtype="<u4"))
                docs.clear()
                texts.clear()

        def close() -> pa.RecordBatch:
            name = f"{uuid.uuid4().hex}.dac"
            with system.open_output_stream(f"{base}/{name}") as out:
                out.write(codes.data())
            row = (task, number, f"{folder}/{name}", len(codes.ids), codes.tokens)
            return pa.RecordBatch.from_pydict(dict(zip(names, ([v] for v in row))), schema=schema)

        names = ["task", "number", "file", "documents", "tokens"]
        kinds = [pa.int32(), pa.int32(), pa.string(), pa.int64(), pa.int64()]
        schema = pa.schema(list(zip(names, kinds)))
        for batch in batches:
            for rows in slices(batch):
                held = 0
                for doc, text in zip(rows.column(0).to_pylist(), rows.column(1).to_pylist()):
                    docs.append(doc)
                    texts.append(known.document(text or "")[:-4] + end)
                    held += len(texts[-1]) // 4
                    if codes.tokens + held >= FILE_TOKENS:
                        flush()
                        yield close()
                        number, codes, held = number + 1, Encoder(), 0
                flush()
        if codes.tokens:
            yield close()

    order = ["doc_id", "content", "row"]
    rows = docs.select(
        docs["doc_id"].cast("long").alias("doc_id"), docs["text"].cast("string").alias("text")
    ).select(
        "doc_id", "text", F.xxhash64("text").alias("content"), F.monotonically_increasing_id().alias("row")
    )
    placed = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    return placed.select("doc_id", "text").mapInArrow(
        run, "task int, number int, file string, documents bigint, tokens bigint"
    )


def with_starts(manifest: DataFrame) -> DataFrame:
    """The manifest with ``first``, the number of tokens before each file: sums within groups of
    tasks, shifted by the totals of the groups before."""
    grouped = manifest.withColumn("of", F.floor(F.col("task") / FILE_GROUP))
    before = Window.rowsBetween(Window.unboundedPreceding, -1)
    inside = F.sum("tokens").over(before.partitionBy("of").orderBy("task", "number"))
    totals = grouped.groupBy("of").agg(F.sum("tokens").alias("sum"))
    shift = F.sum("sum").over(before.orderBy("of"))
    shifts = totals.select("of", F.coalesce(shift, F.lit(0)).alias("shift"))
    placed = grouped.withColumn("inside", F.coalesce(inside, F.lit(0))).join(shifts, "of")
    return placed.withColumn("first", F.col("inside") + F.col("shift")).drop("of", "inside", "shift")


def runs_of(starts: np.ndarray):
    """Consecutive documents (first, end) of about ``RUN_TOKENS`` tokens, at least one."""
    first, last = 0, len(starts) - 1
    while first < last:
        end = int(np.searchsorted(starts, starts[first] + RUN_TOKENS))
        end = min(max(end, first + 1), last)
        yield first, end
        first = end


def read(manifest: DataFrame) -> DataFrame:
    """Every document of the files: doc_id, start, n_tokens, ids_crc32."""

    def run(batches):
        for batch in batches:
            for name, first in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                codes = open_codes(name)
                ids, starts = codes.index()
                sums = []
                for a, b in runs_of(starts):
                    tokens, ends = codes.ids(starts[a], starts[b] - starts[a]), starts[a : b + 1] - starts[a]
                    sums += [zlib.crc32(tokens[x:y]) for x, y in zip(ends, ends[1:])]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(ids, pa.int64()),
                        pa.array(starts[:-1] + first),
                        pa.array(np.diff(starts)),
                        pa.array(sums, pa.int64()),
                    ],
                    ["doc_id", "start", "n_tokens", "ids_crc32"],
                )

    files = manifest.count()
    dealt = with_starts(manifest).select("file", "first").repartition(max(1, files))
    return dealt.mapInArrow(run, "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint")


def write_and_read(docs: DataFrame, path: str) -> DataFrame:
    """All documents written as files in a fresh folder, and read back from them."""
    folder = qualified(docs.sparkSession, staging_path(docs.sparkSession, "codes"))
    return read(staged(write(docs, path, folder), "manifest"))
