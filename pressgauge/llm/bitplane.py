"""Token-id files with bit-plane shuffling.

Ids are cut into blocks of ``BLOCK``. A block's ids are seen as a matrix, of bytes
or of bits, and transposed into planes (all lowest bytes, all next bytes, ...); each
plane that is not all zero is compressed with zstandard on its own. A file ends with
an index of its blocks and of its documents:

    b"BPIDS1"  planes...  zstd(index JSON header + arrays)  index length (8 bytes)  b"BPIDS1"

Files are written below the shared folder under a name of their own per attempt;
the manifest, written by Spark, names only the files of tasks that succeeded.
"""

from __future__ import annotations

import re
import struct
import uuid
import zlib
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pressgauge.llm.common import map_batches, stored
from pressgauge.session import scratch_dir

MAGIC = b"BPIDS1"
BLOCK = 1 << 16
END_ID = 0
#: Pieces one Python worker remembers; it changes its speed only.
CACHED_PIECES = 1_000_000

MANIFEST = "part int, path string, n_docs long, n_tokens long"
_ENCODERS: dict[str, "_Encoder"] = {}


class _Encoder:
    """Ids of whole texts, remembering the ids of pieces seen before.

    A space after a character that is no white space always begins a new
    pre-token, so the pieces between such spaces are encoded independently.
    """

    CUT = re.compile(r"(?<=\S) ")
    GAPS = [chr(c) + " " for c in range(0x3001) if chr(c).isspace()]  # U+3000 is the last white space
    ASCII_GAPS = [gap for gap in GAPS if gap.isascii()]

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.known: dict[str, bytes] = {}
        self.marks = dict(zip(".,;:!?", self._encode(list(".,;:!?")), strict=True))

    def cut(self, text: str) -> list[str]:
        for gap in self.ASCII_GAPS if text.isascii() else self.GAPS:
            if gap in text:
                break
        else:
            return text.split(" ")  # every space follows a character that is no white space
        return self.CUT.split(text)

    def _encode(self, pieces: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(pieces, add_special_tokens=False)
        return [struct.pack(f"<{len(ids)}I", *ids) for ids in (e.ids for e in found)]

    def __call__(self, texts: list[str]) -> Iterator[bytes]:
        """Per text its ids as little-endian unsigned 32-bit integers."""
        cut = [self.cut(text) for text in texts]
        heads = self._encode([pieces[0] for pieces in cut])
        known = self.known
        found = [list(map(known.get, islice(pieces, 1, None))) for pieces in cut]
        lacking = [i for i, ids in enumerate(found) if None in ids]
        fresh = {p for i in lacking for p, ids in zip(cut[i][1:], found[i], strict=True) if ids is None}
        # a mark after letters is a pre-token of its own
        ending = {p: p[:-1] for p in fresh if p[-1:] in self.marks and p[:-1].isalpha()}
        alone = list({core for core in (ending.get(p, p) for p in fresh) if core not in known})
        met: dict[str, bytes] = {}
        for at in range(0, len(alone), 20_000):
            part = alone[at : at + 20_000]
            met.update(zip(part, self._encode([" " + p for p in part]), strict=True))
        met.update({p: (known.get(core) or met[core]) + self.marks[p[-1]] for p, core in ending.items()})
        if len(known) + len(met) <= CACHED_PIECES:  # frequent pieces are met early and stay
            known.update(met)
        for i in lacking:
            found[i] = [met.get(p) or known[p] if ids is None else ids for p, ids in zip(cut[i][1:], found[i], strict=True)]
        for head, rest in zip(heads, found, strict=True):
            yield head + b"".join(rest)


def encoder(path: str) -> _Encoder:
    if path not in _ENCODERS:
        _ENCODERS[path] = _Encoder(path)
    return _ENCODERS[path]


def pack_block(ids: np.ndarray, bits: bool = False) -> tuple[int, list[bytes]]:
    """(mask of the planes that are not all zero, those planes compressed, lowest first).

    The mask has a bit for each bit plane in its lower half, or for each byte plane above bit 32.
    """
    import zstandard

    press = zstandard.ZstdCompressor(level=1)
    held = int(np.bitwise_or.reduce(ids)) if len(ids) else 0
    if bits:
        planes = [k for k in range(32) if held >> k & 1]
        return held, [press.compress(np.packbits((ids >> np.uint32(k)).astype(np.uint8) & 1, bitorder="little").tobytes()) for k in planes]
    matrix = np.ascontiguousarray(ids, "<u4").view(np.uint8).reshape(-1, 4)
    planes = [k for k in range(4) if held >> 8 * k & 255]
    return sum(1 << 32 + k for k in planes), [press.compress(np.ascontiguousarray(matrix[:, k]).tobytes()) for k in planes]


def unpack_block(n: int, used: int, planes: list[bytes]) -> np.ndarray:
    import zstandard

    expand = zstandard.ZstdDecompressor()
    raw = [np.frombuffer(expand.decompress(p), np.uint8) for p in planes]
    matrix = np.zeros((n, 4), np.uint8)
    if used >> 32:
        for k, plane in zip((k for k in range(4) if used >> 32 + k & 1), raw, strict=True):
            matrix[:, k] = plane
        return matrix.view("<u4").ravel()
    ids = np.zeros(n, "<u4")
    for k, plane in zip((k for k in range(32) if used >> k & 1), raw, strict=True):
        ids |= np.unpackbits(plane, count=n, bitorder="little").astype("<u4") << np.uint32(k)
    return ids


def _open(path: str):
    """(file system, its own path) of a URI or an absolute path."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(path)


class Writer:
    """Appends documents to one file, holding one block of ids at a time."""

    def __init__(self, path: str):
        system, own = _open(path)
        system.create_dir(own.rpartition("/")[0], recursive=True)
        self.out = system.open_output_stream(own)
        self.out.write(MAGIC)
        self.at, self.waiting, self.held = len(MAGIC), [], 0
        self.blocks: list[tuple[int, int, int]] = []  # n, mask, offset
        self.planes: list[int] = []
        self.docs: list[tuple[int | None, int]] = []

    def add(self, doc_id: int | None, ids: bytes) -> None:
        self.docs.append((doc_id, len(ids) // 4))
        self.waiting.append(ids)
        self.held += len(ids)
        if self.held >= 4 * BLOCK:
            joined = b"".join(self.waiting)
            whole = len(joined) // (4 * BLOCK) * 4 * BLOCK
            for at in range(0, whole, 4 * BLOCK):
                self._block(joined[at : at + 4 * BLOCK])
            self.waiting, self.held = [joined[whole:]], len(joined) - whole

    def _block(self, raw: bytes) -> None:
        used, planes = pack_block(np.frombuffer(raw, "<u4"))
        self.blocks.append((len(raw) // 4, used, self.at))
        for plane in planes:
            self.planes.append(len(plane))
            self.out.write(plane)
            self.at += len(plane)

    def close(self) -> tuple[int, int]:
        import zstandard

        if self.held:
            self._block(b"".join(self.waiting))
        ids = np.array([0 if d is None else d for d, _ in self.docs], "<i8")
        index = struct.pack("<3Q", len(self.blocks), len(self.planes), len(self.docs)) + b"".join(
            np.asarray(a).tobytes()
            for a in (
                np.array(self.blocks, "<u8").reshape(-1, 3), np.array(self.planes, "<u4"), ids,
                np.array([d is None for d, _ in self.docs], np.uint8), np.array([n for _, n in self.docs], "<u8"),
            )
        )
        pressed = zstandard.ZstdCompressor().compress(index)
        self.out.write(pressed + struct.pack("<Q", len(pressed)) + MAGIC)
        self.out.close()
        return len(self.docs), sum(n for _, n in self.docs)


def read_documents(path: str) -> Iterator[tuple[int | None, int, Iterator[bytes]]]:
    """(doc_id, number of ids, its ids in one or more pieces) of each document in file order."""
    import zstandard

    system, own = _open(path)
    with system.open_input_file(own) as file:
        tail = 8 + len(MAGIC)
        file.seek(file.size() - tail)
        length, end = struct.unpack("<Q", file.read(8))[0], file.read(len(MAGIC))
        if end != MAGIC:
            raise ValueError(f"{path} is no token-id file")
        file.seek(file.size() - tail - length)
        index = zstandard.ZstdDecompressor().decompress(file.read(length))
        n_blocks, n_planes, n_docs = struct.unpack_from("<3Q", index)
        parts, at = [], 24
        for kind, count in (("<u8", 3 * n_blocks), ("<u4", n_planes), ("<i8", n_docs), ("u1", n_docs), ("<u8", n_docs)):
            parts.append(np.frombuffer(index, kind, count, at))
            at += parts[-1].nbytes
        blocks, planes, ids, missing, lengths = parts

        def stream() -> Iterator[bytes]:
            plane = 0
            for n, used, offset in blocks.reshape(-1, 3).tolist():
                count = used.bit_count()
                file.seek(offset)
                packed = [file.read(int(x)) for x in planes[plane : plane + count]]
                plane += count
                yield unpack_block(n, used, packed).tobytes()

        source, held = stream(), memoryview(b"")

        def take(size: int) -> Iterator[bytes]:
            nonlocal held
            while size:
                if not held:
                    held = memoryview(next(source))
                part = held[:size]
                held = held[len(part) :]
                size -= len(part)
                yield part

        for doc_id, gone, n in zip(ids.tolist(), missing.tolist(), lengths.tolist(), strict=True):
            yield None if gone else doc_id, n, take(4 * n)


def write_ids(docs: DataFrame, tokenizer: str, end_id: int = END_ID, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encode every text and write files in ascending doc_id order; returns the manifest.

    File ``part`` 0 holds the smallest ids. Nulls come first, a null text is empty,
    and repeated ids stay beside each other, in as many files as they need.
    """
    folder = scratch_dir(docs.sparkSession, "token-ids")
    ordered = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"), F.monotonically_increasing_id().alias("tie")
    )
    ordered = ordered.repartitionByRange("doc_id", "tie").sortWithinPartitions("doc_id", "tie").select("doc_id", "text")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, out, part = encoder(tokenizer), None, TaskContext.get().partitionId()
        path = f"{folder}/part-{part:06d}-{uuid.uuid4().hex}.bpids"
        end = struct.pack("<I", end_id)
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                some = batch.slice(at, 1000)
                out = out or Writer(path)
                for doc_id, ids in zip(some.column(0).to_pylist(), encode(some.column(1).to_pylist()), strict=True):
                    out.add(doc_id, ids + end)
        if out:
            n_docs, n_tokens = out.close()
            yield pa.RecordBatch.from_pylist([{"part": part, "path": path, "n_docs": n_docs, "n_tokens": n_tokens}], _arrow(MANIFEST))

    return stored(map_batches(ordered, write, MANIFEST), "token-id-manifest")


def _arrow(ddl: str) -> pa.Schema:
    kinds = {"int": pa.int32(), "long": pa.int64(), "string": pa.string()}
    return pa.schema([(name, kinds[kind]) for name, kind in (x.split() for x in ddl.split(", "))])


ROWS = "doc_id long, start long, n_tokens long, ids_crc32 long"


def read_ids(manifest: DataFrame) -> DataFrame:
    """Read the files back: where each document starts among all ids, its length and checksum."""
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row per file
    tasks = manifest.withColumn("base", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)).cast("long")).select("path", "base")
    schema = _arrow(ROWS)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for task in batch.to_pylist():
                rows, start = [], task["base"]
                for doc_id, n, pieces in read_documents(task["path"]):
                    crc = 0
                    for piece in pieces:
                        crc = zlib.crc32(piece, crc)
                    rows.append((doc_id, start, n, crc))
                    start += n
                    if len(rows) == 10_000:
                        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)
                        rows = []
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)

    return map_batches(tasks.repartition(max(1, manifest.count())), read, ROWS)


def round_trip(spark: SparkSession, docs: DataFrame, tokenizer: str) -> DataFrame:
    """Write the ids of all documents and read them back; an empty table gives no files and no rows."""
    return read_ids(write_ids(docs, tokenizer))
