"""Token ids in succinct files: a wavelet matrix per shard.

A file holds the ids of consecutive documents as bit-planes, the highest bit
first; each plane lists the ids in the order that the bits above it sort them
into (zeros before ones, stable).  With the number of ones before each block
(rank) one goes down the planes to read or count a token, and back up (select)
to find where it occurs, opening only the blocks on the way.

Layout, little-endian: 8 bytes ``MAGIC``; unsigned 64-bit lengths of the head
and of the block frames; the head, a Zstandard frame of 64-bit integers (ids,
documents, planes, bits of a block, then doc ids, whether each is known, their
numbers of ids, zeros of each plane, ones before each block by plane, and the
end of each block's frame); the blocks, a Zstandard frame each."""

from __future__ import annotations

import struct
import zlib
from collections import OrderedDict
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import zstandard as zstd
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pitstop.llm.packing import END_ID, encoder
from pitstop.llm.scratch import fresh_path, running_sums, stage, write_file
from pitstop.llm.text import slices

MAGIC = b"TOKWAVE1"
BLOCK_BITS = 1 << 16
SHARD_IDS = 1 << 23           # a shard ends with the document that reaches it
LEVEL = 1
OPEN_BLOCKS = 512             # that a reader keeps: 4 MB
SUFFIX = ".wave"
_ONES = np.array([bin(i).count("1") for i in range(256)], np.uint8)


def pack_matrix(ids: np.ndarray, doc_ids: Sequence[int | None], counts: Sequence[int]) -> bytes:
    """The file for ``ids``, the ids of all documents one behind another."""
    planes = max(1, int(ids.max(initial=0)).bit_length())
    compress = zstd.ZstdCompressor(level=LEVEL, write_content_size=True).compress
    zeros, ranks, frames = [], [], []
    row = ids.astype(np.uint16 if planes <= 16 else np.uint32)
    for plane in reversed(range(planes)):
        ones = (row >> plane) & 1 == 1
        packed = np.packbits(ones, bitorder="little")
        cuts = range(0, len(packed), BLOCK_BITS // 8)
        ranks.append(np.cumsum([0] + [int(_ONES[packed[a:a + BLOCK_BITS // 8]].sum()) for a in cuts]))
        frames += [compress(packed[a:a + BLOCK_BITS // 8].tobytes()) for a in cuts]
        zeros.append(len(row) - int(ranks[-1][-1]))
        row = np.concatenate([row[~ones], row[ones]])
    known = [d is not None for d in doc_ids]
    head = np.concatenate([
        [len(ids), len(known), planes, BLOCK_BITS], [d if k else 0 for d, k in zip(doc_ids, known)], known, counts, zeros,
        *ranks, np.cumsum([len(f) for f in frames])]).astype("<i8")
    head = compress(head.tobytes())
    body = b"".join(frames)
    return MAGIC + struct.pack("<QQ", len(head), len(body)) + head + body


class WaveletMatrix:
    """Reads a file of :func:`pack_matrix`; positions count from 0 in the shard."""

    def __init__(self, content: bytes):
        if content[:8] != MAGIC:
            raise ValueError("not a token file")
        head_size, body_size = struct.unpack_from("<QQ", content, 8)
        self._body = memoryview(content)[24 + head_size:24 + head_size + body_size]
        if len(self._body) != body_size:
            raise ValueError("the token file is cut")
        head = np.frombuffer(zstd.ZstdDecompressor().decompress(content[24:24 + head_size]), "<i8")
        self.n, docs, self.planes, self.block_bits = map(int, head[:4])
        blocks = -(-self.n // self.block_bits)
        cut = np.cumsum([4, docs, docs, docs, self.planes, self.planes * (blocks + 1)])
        ids, known, self.counts, self.zeros, ranks, ends = np.split(head, cut)[1:]
        self.doc_ids = [int(d) if k else None for d, k in zip(ids, known)]
        self.starts = np.cumsum(self.counts) - self.counts
        self._ranks = ranks.reshape(self.planes, blocks + 1)
        self._ends = np.append(0, ends)
        self._blocks, self._open = blocks, OrderedDict()
        self._expand = zstd.ZstdDecompressor().decompress

    def _frame(self, level: int, block: int) -> bytes:
        k = level * self._blocks + block
        return self._expand(self._body[self._ends[k]:self._ends[k + 1]])

    def _block(self, level: int, block: int) -> tuple[np.ndarray, np.ndarray]:
        """The block's bytes, and the ones before each of them."""
        found = self._open.pop((level, block), None)
        if found is None:
            packed = np.frombuffer(self._frame(level, block), np.uint8)
            found = packed, np.cumsum(np.append(0, _ONES[packed]))
            if len(self._open) >= OPEN_BLOCKS:
                self._open.popitem(last=False)
        self._open[level, block] = found
        return found

    def _rank(self, level: int, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ones before each position, and the bit there (0 at the end)."""
        before, bit = np.empty(len(at), np.int64), np.zeros(len(at), np.int64)
        block = at // self.block_bits
        for b in np.unique(block):
            mine = block == b
            if b == self._blocks:
                before[mine] = self._ranks[level, b]
                continue
            packed, ones = self._block(level, int(b))
            byte, rest = np.divmod(at[mine] - b * self.block_bits, 8)
            value = np.append(packed, 0)[byte]
            before[mine] = self._ranks[level, b] + ones[byte] + _ONES[value & ((1 << rest) - 1)]
            bit[mine] = value >> rest & 1
        return before, bit

    def _select(self, level: int, bit: int, nth: np.ndarray) -> np.ndarray:
        """Where the plane has its ``nth`` (from 0) one or zero."""
        ranks = self._ranks[level]
        if not bit:
            ranks = np.minimum(np.arange(self._blocks + 1) * self.block_bits, self.n) - ranks
        block, out = np.searchsorted(ranks, nth, side="right") - 1, np.empty(len(nth), np.int64)
        for b in np.unique(block):
            mine = block == b
            size = min(self.block_bits, self.n - int(b) * self.block_bits)
            bits = np.unpackbits(self._block(level, int(b))[0], count=size, bitorder="little")
            out[mine] = b * self.block_bits + np.flatnonzero(bits == bit)[nth[mine] - ranks[b]]
        return out

    def access(self, positions: Sequence[int]) -> np.ndarray:
        """The ids at ``positions``."""
        at = np.asarray(positions, np.int64)
        if len(at) and not (0 <= at.min() and at.max() < self.n):
            raise IndexError("position outside the shard")
        out = np.zeros(len(at), np.int64)
        for level in range(self.planes):
            ones, bit = self._rank(level, at)
            at = np.where(bit == 1, self.zeros[level] + ones, at - ones)
            out = out << 1 | bit
        return out

    def _range(self, token: int, low: int, high: int) -> tuple[int, int]:
        """Where the occurrences of ``token`` in [low, high) lie in the lowest order."""
        if token < 0 or token >> self.planes:
            return 0, 0
        ends = np.array([max(low, 0), max(min(high, self.n), max(low, 0))])
        for level in range(self.planes):
            ones, _ = self._rank(level, ends)
            ends = self.zeros[level] + ones if token >> (self.planes - 1 - level) & 1 else ends - ones
        return int(ends[0]), int(ends[1])

    def count(self, token: int, low: int = 0, high: int | None = None) -> int:
        """How often ``token`` occurs at positions low to high - 1."""
        a, b = self._range(token, low, self.n if high is None else high)
        return b - a

    def occurrences(self, token: int, low: int = 0, high: int | None = None) -> np.ndarray:
        """All positions of ``token`` in [low, high), ascending."""
        at = np.arange(*self._range(token, low, self.n if high is None else high))
        for level in reversed(range(self.planes)):
            bit = token >> (self.planes - 1 - level) & 1
            at = self._select(level, bit, at - self.zeros[level] if bit else at)
        return at

    def ids(self) -> np.ndarray:
        """All ids in their order: the planes are undone from the lowest up."""
        row = np.zeros(self.n, np.uint16 if self.planes <= 16 else np.uint32)
        for level in reversed(range(self.planes)):
            packed = b"".join(self._frame(level, b) for b in range(self._blocks))
            ones = np.unpackbits(np.frombuffer(packed, np.uint8), count=self.n, bitorder="little").view(bool)
            back, zeros = np.empty_like(row), int(self.zeros[level])
            back[~ones] = row[:zeros]
            back[ones] = row[zeros:] | row.dtype.type(1 << (self.planes - 1 - level))
            row = back
        return row


def write_shards(docs: DataFrame, folder: str, tokenizer_path: str, end_id: int = END_ID, shard_ids: int = SHARD_IDS,
                 columns: Sequence[str] = ("doc_id", "text")) -> DataFrame:
    """Token files of all documents under ``folder``, in ascending id order (a
    null id is larger than any; of equal ids the texts' hashes, then the texts
    decide).  Returns (part, nth, file, docs, ids), staged.

    Texts are dealt in ranges of id and hash, so documents with one id spread;
    rows alike in both are streamed by one task.  A null text counts as empty
    and gives the end id alone.  A shard holds whole documents and ends with
    the one that reaches ``shard_ids``.  Files are written under another name
    and renamed, and a task's rows are sorted, so a task that runs again
    writes the same files.  Other columns are not read; an empty table writes
    no file."""
    doc_id, text = columns
    row = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    order = [F.col("doc_id").asc_nulls_last(), F.xxhash64("text").asc()]
    ranged = row.repartitionByRange(*order).sortWithinPartitions(*order, "text")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens, part, out = encoder(tokenizer_path), TaskContext.get().partitionId(), [[], [], []]
        held, ids, counts, size = [], [], [], 0

        def flush():
            name = f"part-{part:06d}-{len(out[0]):06d}{SUFFIX}"
            write_file(folder, name, pack_matrix(np.concatenate(held), ids, counts))
            for column, value in zip(out, (name, len(ids), size)):
                column.append(value)

        for batch in batches:
            names = batch.column(0).to_pylist()
            for s in slices(batch.column(1), 1 << 20):
                found, bounds = tokens.slice_ids(s)
                found, ends = np.insert(found, bounds[1:], end_id), bounds[1:] + np.arange(1, s.n + 1)
                at = 0
                while at < s.n:
                    begin = int(ends[at - 1]) if at else 0
                    to = min(s.n, int(np.searchsorted(ends, begin + shard_ids - size)) + 1)
                    held.append(found[begin:ends[to - 1]])
                    ids += names[s.first + at:s.first + to]
                    counts += np.diff(ends[at:to], prepend=begin).tolist()
                    size, at = size + len(held[-1]), to
                    if size >= shard_ids:
                        flush()
                        held, ids, counts, size = [], [], [], 0
        if held:
            flush()
        k = len(out[0])
        yield pa.RecordBatch.from_arrays(
            [pa.array([part] * k, pa.int64()), pa.array(range(k), pa.int64()), pa.array(out[0], pa.string()),
             pa.array(out[1], pa.int64()), pa.array(out[2], pa.int64())], ["part", "nth", "file", "docs", "ids"])

    return stage(ranged.mapInArrow(write, "part long, nth long, file string, docs long, ids long"), "wave-manifest")


def _files(spark: SparkSession, folder: str) -> DataFrame:
    return (spark.read.format("binaryFile").schema("path string, modificationTime timestamp, length long, content binary")
            .option("pathGlobFilter", "*" + SUFFIX).load(folder)
            .select(F.substring_index("path", "/", -1).alias("file"), "content"))


def read_shards(spark: SparkSession, folder: str, with_ids: bool = False) -> DataFrame:
    """file, doc_id, first (ids before it in the file), n_tokens, ids_crc32
    (and ids) of every document, from the files alone."""
    schema = "file string, doc_id long, first long, n_tokens long, ids_crc32 long" + ", ids array<int>" * with_ids

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, content in zip(batch.column(0), batch.column(1)):
                matrix = WaveletMatrix(content.as_py())
                body = memoryview(matrix.ids().astype("<u4").tobytes())
                for low in range(0, len(matrix.counts), 4096):
                    starts, counts = matrix.starts[low:low + 4096], matrix.counts[low:low + 4096]
                    parts = [body[4 * a:4 * (a + n)] for a, n in zip(starts, counts)]
                    arrays = [pa.array([name.as_py()] * len(parts)), pa.array(matrix.doc_ids[low:low + 4096], pa.int64()),
                              pa.array(starts), pa.array(counts), pa.array([zlib.crc32(p) for p in parts], pa.int64())]
                    if with_ids:
                        arrays.append(pa.array([np.frombuffer(p, "<i4") for p in parts], pa.list_(pa.int32())))
                    yield pa.RecordBatch.from_arrays(arrays, [c.split(" ")[0] for c in schema.split(", ")])

    return _files(spark, folder).mapInArrow(read, schema)


def find_tokens(spark: SparkSession, folder: str, tokens: Sequence[int]) -> DataFrame:
    """token, doc_id, position (from 0 in the document): every occurrence of
    ``tokens``, found by select in the planes; ids are not decoded."""
    wanted = sorted(set(tokens))

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column(1):
                matrix = WaveletMatrix(content.as_py())
                for token in wanted:
                    for low in range(0, matrix.n, 1 << 20):
                        at = matrix.occurrences(token, low, low + (1 << 20))
                        doc = np.searchsorted(matrix.starts, at, side="right") - 1
                        yield pa.RecordBatch.from_arrays(
                            [pa.array([token] * len(at), pa.int64()), pa.array([matrix.doc_ids[d] for d in doc], pa.int64()),
                             pa.array(at - matrix.starts[doc], pa.int64())], ["token", "doc_id", "position"])

    return _files(spark, folder).mapInArrow(find, "token long, doc_id long, position long")


def count_tokens(spark: SparkSession, folder: str, tokens: Sequence[int]) -> DataFrame:
    """token, n: how often each of ``tokens`` occurs, by rank in each file's planes."""
    wanted = sorted(set(tokens))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column(1):
                matrix = WaveletMatrix(content.as_py())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(wanted, pa.int64()), pa.array([matrix.count(t) for t in wanted], pa.int64())], ["token", "n"])

    return _files(spark, folder).mapInArrow(count, "token long, n long").groupBy("token").agg(F.sum("n").alias("n"))


def encode_and_read(docs: DataFrame, tokenizer_path: str, **options) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document, from token files
    written to the shared folder (:func:`write_shards`) and read back; start
    counts the ids of all documents before it.  An empty table gives no rows."""
    spark = docs.sparkSession
    folder = fresh_path(spark, "wave")
    manifest = write_shards(docs, folder, tokenizer_path, **options)
    if manifest.isEmpty():
        return spark.createDataFrame([], "doc_id long, start long, n_tokens long, ids_crc32 long")
    before = running_sums(manifest, ["part", "nth"], {"_before": "ids"}, "wave-starts").select("file", "_before")
    return (read_shards(spark, folder).join(before, "file")
            .select("doc_id", (F.col("first") + F.col("_before")).alias("start"), "n_tokens", "ids_crc32"))
