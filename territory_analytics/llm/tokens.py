"""Token ids in binary files of bit planes.

Texts are encoded, and the ids of all documents, in ascending order of document id, are cut into blocks
of a fixed number of ids.  A block is transposed into bit planes (or byte planes): plane k has bit k of
every id.  High planes are nearly constant and low ones noisy; each is compressed by itself with
zstandard.  A file holds

    magic | planes of block 0 | planes of block 1 | ... | table of documents | index | index size, magic

and its index says for every block where it starts, how many ids it has and how long each plane is, so
any block can be read alone.  One task writes a file in a single pass and holds one block at a time;
another reads it the same way.  A file is named after the attempt that wrote it and counts only if the
manifest lists it, so a task that is lost or run twice does no harm.
"""

import json
import os
import re
import struct
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from ..storage import durable, scratch_path
from .common import small_batches, table, text_bytes
from .files import create, open_file

END_ID = 1
BLOCK_IDS = 1 << 16
LEVEL = 3
VOCABULARY = "word_bpe_49k.json"
MAGIC = b"IDPLANE1"

#: Encoded words that a worker remembers, and the longest of them.
MOST_WORDS, LONGEST_WORD = 400_000, 48


# --- Planes ------------------------------------------------------------------------------------


def to_planes(ids: np.ndarray, bits: bool = True) -> list[bytes]:
    """Planes of a block of unsigned 32-bit ids, lowest first, up to the highest bit or byte in use."""
    wide = np.ascontiguousarray(ids, "<u4").view(np.uint8).reshape(-1, 4)
    used = int(ids.max()).bit_length() if len(ids) else 0
    if not bits:
        return [wide[:, k].tobytes() for k in range(-(-used // 8))]
    spread = np.unpackbits(wide, axis=1, bitorder="little")
    return [np.packbits(spread[:, k], bitorder="little").tobytes() for k in range(used)]


def from_planes(planes: list[bytes], count: int, bits: bool = True) -> np.ndarray:
    if not bits:
        wide = np.zeros((count, 4), np.uint8)
        for k, plane in enumerate(planes):
            wide[:, k] = np.frombuffer(plane, np.uint8)
        return wide.view("<u4").reshape(-1)
    ids = np.zeros(count, "<u4")
    for k, plane in enumerate(planes):
        ones = np.unpackbits(np.frombuffer(plane, np.uint8), count=count, bitorder="little")
        ids |= ones.astype("<u4") << np.uint32(k)
    return ids


class Writer:
    """One file; documents are added in order."""

    def __init__(self, path: str, bits: bool = True, block_ids: int = BLOCK_IDS):
        self.bits, self.block_ids = bits, block_ids
        self.out, self.place = create(path), 0
        self.pack = zstandard.ZstdCompressor(level=LEVEL).compress
        self.pending: list[np.ndarray] = []
        self.waiting = self.n_ids = 0
        self.blocks: list[tuple[int, int, list[int]]] = []
        self.doc_ids: list[int | None] = []
        self.lengths: list[int] = []
        self._put(MAGIC)

    def _put(self, data: bytes) -> int:
        self.out.write(data)
        self.place += len(data)
        return len(data)

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        self.doc_ids.append(doc_id)
        self.lengths.append(len(ids))
        self.n_ids += len(ids)
        self.pending.append(ids)
        self.waiting += len(ids)
        if self.waiting >= self.block_ids:
            joined = np.concatenate(self.pending)
            whole = len(joined) // self.block_ids * self.block_ids
            for k in range(0, whole, self.block_ids):
                self._block(joined[k : k + self.block_ids])
            self.pending, self.waiting = [joined[whole:].copy()], len(joined) - whole

    def _block(self, ids: np.ndarray) -> None:
        start = self.place
        sizes = [self._put(self.pack(plane)) for plane in to_planes(ids, self.bits)]
        self.blocks.append((start, len(ids), sizes))

    def close(self) -> None:
        if self.waiting:
            self._block(np.concatenate(self.pending))
        start = self.place
        known = np.array([d is not None for d in self.doc_ids], np.uint8)
        ids = np.array([d or 0 for d in self.doc_ids], "<i8")
        self._put(self.pack(known.tobytes() + ids.tobytes() + np.array(self.lengths, "<u8").tobytes()))
        index = {"bits": self.bits, "blocks": self.blocks, "documents": [start, self.place - start, len(self.lengths)]}
        data = self.pack(json.dumps(index).encode())
        self._put(data)
        self._put(struct.pack("<Q", len(data)) + MAGIC)
        self.out.close()


class Reader:
    """A file's documents, block by block."""

    def __init__(self, path: str):
        self.file = open_file(path)
        self.unpack = zstandard.ZstdDecompressor().decompress
        size = self.file.size()
        tail = self._at(size - 16, 16)
        if tail[8:] != MAGIC or self._at(0, 8) != MAGIC:
            raise ValueError(f"{path} is no file of id planes, or is cut off")
        length = struct.unpack("<Q", tail[:8])[0]
        index = json.loads(self.unpack(self._at(size - 16 - length, length)))
        self.bits, self.blocks = index["bits"], index["blocks"]
        self.table = index["documents"]

    def _at(self, place: int, size: int) -> bytes:
        self.file.seek(place)
        return self.file.read(size)

    def block(self, number: int) -> np.ndarray:
        place, count, sizes = self.blocks[number]
        data, at, planes = self._at(place, sum(sizes)), 0, []
        for size in sizes:
            planes.append(self.unpack(data[at : at + size]))
            at += size
        return from_planes(planes, count, self.bits)

    def documents(self) -> Iterator[tuple[int | None, list[np.ndarray]]]:
        """(id, ids in pieces) of each document; a document may lie in several blocks."""
        place, size, n = self.table
        data = self.unpack(self._at(place, size))
        known = np.frombuffer(data, np.uint8, n)
        doc_ids = np.frombuffer(data, "<i8", n, n)
        lengths = np.frombuffer(data, "<u8", n, n * 9)
        number, ids, at = -1, np.zeros(0, "<u4"), 0
        for k in range(n):
            left, pieces = int(lengths[k]), []
            while left:
                if at == len(ids):
                    number, at = number + 1, 0
                    ids = self.block(number)
                pieces.append(ids[at : at + left])
                at += len(pieces[-1])
                left -= len(pieces[-1])
            yield (int(doc_ids[k]) if known[k] else None), pieces

    def close(self) -> None:
        self.file.close()


# --- Encoding ------------------------------------------------------------------------------------


# Words of printable ASCII (no apostrophe) and of the letters of Latin-1, which are whole characters in
# normal form, and the pieces that such a word falls into.
_PLAIN = re.compile(r"[!-&(-~À-ÖØ-öø-ÿ]+")
_PIECE = re.compile(r"[a-zß-öø-ÿ]+|[0-9]|[^a-z0-9ß-öø-ÿ]+")


def _byte_characters() -> dict[int, str]:
    """The characters that stand for bytes in byte-level vocabularies: printable ones for themselves."""
    printable = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = [b for b in range(256) if b not in printable]
    return {b: chr(b) for b in printable} | {b: chr(256 + k) for k, b in enumerate(others)}


_AS_CHARACTERS = _byte_characters()


class Encoder:
    """Ids of texts by a tokenizer that never joins words across white space.

    Such a tokenizer gives a text the ids of its words one after the other, so each word is encoded
    once and remembered; the memory is bounded and starts anew when full.  Where the vocabulary splits
    and lower-cases as ``VOCABULARY`` does, plain words are put together from their pieces, which go to
    its model once: far fewer than words, because case and punctuation are not part of them.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.known: dict[bytes, bytes] = {}
        self.pieces: dict[str, bytes] = {}
        self.by_model = os.path.basename(path) == VOCABULARY

    def _piece(self, piece: str) -> bytes:
        ids = self.pieces.get(piece)
        if ids is None:
            as_bytes = piece if piece.isascii() else piece.encode().decode("latin-1").translate(_AS_CHARACTERS)
            ids = np.array([t.id for t in self.tokenizer.model.tokenize(as_bytes)], "<u4").tobytes()
            if len(piece) <= LONGEST_WORD:
                if len(self.pieces) >= MOST_WORDS:
                    self.pieces.clear()
                self.pieces[piece] = ids
        return ids

    def _encode(self, words: list[bytes]) -> Iterator[bytes]:
        texts = [w.decode() for w in words]
        plain = [self.by_model and _PLAIN.fullmatch(t) is not None and "<|" not in t for t in texts]
        others = [t for t, p in zip(texts, plain, strict=True) if not p]
        found = iter(self.tokenizer.encode_batch_fast(others, add_special_tokens=False) if others else [])
        for text, is_plain in zip(texts, plain, strict=True):
            if is_plain:
                yield b"".join(map(self._piece, _PIECE.findall(text.lower())))
            else:
                yield np.array(next(found).ids, "<u4").tobytes()

    def encode(self, texts: Iterable[bytes]) -> Iterator[np.ndarray]:
        known = self.known
        for text in texts:
            words = text.split()
            new = [w for w in dict.fromkeys(words) if w not in known]
            if len(known) + len(new) > MOST_WORDS:
                known.clear()
                new = list(dict.fromkeys(words))
            known.update(zip(new, self._encode(new), strict=True))
            yield np.frombuffer(b"".join(map(known.__getitem__, words)), "<u4")
            if len(known) > MOST_WORDS:
                known.clear()
            for word in new:
                if len(word) > LONGEST_WORD:
                    known.pop(word, None)


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path(VOCABULARY)


# --- Files by Spark ------------------------------------------------------------------------------


def write_tokens(
    documents: DataFrame,
    folder: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    vocabulary: str | None = None,
    end_id: int = END_ID,
    bits: bool = True,
    block_ids: int = BLOCK_IDS,
) -> DataFrame:
    """Write the ids of all documents below ``folder``; the manifest: part, path, n_docs, n_ids.

    Documents are range-partitioned by id, so files follow each other by ``part``; rows without an id
    come first, rows of one id in the order of their texts.  NULL texts are empty, and every document
    ends with ``end_id``.  ``vocabulary`` is the path of a file of the tokenizers library; its tokens
    must not reach across white space.  An empty table gives no file.
    """
    small_batches(documents.sparkSession)
    vocabulary = vocabulary or default_vocabulary()

    def written(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        writer, path = None, ""
        context = TaskContext.get()
        encode = encoder(vocabulary).encode
        end = np.array([end_id], "<u4")
        for batch in batches:
            if writer is None:
                path = f"{folder}/part-{context.partitionId():06d}-{context.taskAttemptId()}.ids"
                writer = Writer(path, bits, block_ids)
            doc_ids = batch.column(0).to_pylist()
            for doc_id, ids in zip(doc_ids, encode(text_bytes(batch.column(1))), strict=True):
                writer.add(doc_id, np.concatenate([ids, end]))
        if writer is not None:
            writer.close()
            yield pa.RecordBatch.from_pylist(
                [
                    {
                        "part": context.partitionId(),
                        "path": path,
                        "n_docs": len(writer.lengths),
                        "n_ids": writer.n_ids,
                    }
                ],
                pa.schema([("part", pa.int32()), ("path", pa.string()), ("n_docs", pa.int64()), ("n_ids", pa.int64())]),
            )

    rows = documents.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    ordered = rows.repartitionByRange("id").sortWithinPartitions("id", "text")
    return durable(ordered.mapInArrow(written, "part int, path string, n_docs long, n_ids long"))


def read_tokens(manifest: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """One row per document of the files: id, start, n_tokens, ids_crc32.

    start is the number of ids of all documents before it; the checksum is that of the ids as
    little-endian unsigned 32-bit integers.
    """
    # One row per file, so the running sum is over as many rows as there are files.
    earlier = W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    placed = durable(manifest.withColumn("start", F.coalesce(F.sum("n_ids").over(earlier), F.lit(0))))
    files = max(1, placed.count())
    schema = pa.schema([(id_col, pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())])

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, start in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                reader, rows = Reader(path), []
                for doc_id, pieces in reader.documents():
                    crc, n = 0, 0
                    for piece in pieces:
                        crc, n = zlib.crc32(piece.tobytes(), crc), n + len(piece)
                    rows.append((doc_id, start, n, crc))
                    start += n
                    if len(rows) == 10_000:
                        yield _batch(rows, schema)
                        rows = []
                reader.close()
                yield _batch(rows, schema)

    spread = placed.select("path", "start").repartition(files)
    return spread.mapInArrow(digests, f"`{id_col}` long, start long, n_tokens long, ids_crc32 long")


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) if rows else [[] for _ in schema]
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


def encode_and_read(documents: DataFrame, **named) -> DataFrame:
    """Write the files of ``documents`` in the shared folder, and read them back."""
    folder = scratch_path(documents.sparkSession, "tokens")
    return read_tokens(write_tokens(documents, folder, **named))


def token_planes(spark, sf_dir) -> DataFrame:
    return encode_and_read(table(spark, sf_dir, "documents"))
