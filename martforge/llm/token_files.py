"""Token-id files: fixed-width bit packing with block offsets.

A file is a row of blocks; a block holds whole documents:

    magic "MFTB", version u8, width u8 (bits per id), 2 spare bytes, n_docs u32, n_ids u64
    n_docs x i64   document ids, ascending
    (n_docs+1) x u64   offsets of the documents' first ids within the block
    ceil(n_ids * width / 8) bytes   ids, each in ``width`` bits, lowest bit first
    "\\nEND"   block end, checked when read

``width`` is the least number of bits for the vocabulary.  Any document of a block is reached
by its offset; whole blocks are unpacked by numpy at once.  Spark's text writer writes the
files (the block end is its line separator), so a lost task's files are never seen and any
store works.  Files follow each other in ascending id order.

Defined cases: a null text is an empty document and gets the end id only; a null id is stored as
the smallest 64-bit number and sorted first, repeated ids keep their rows; an empty
table writes no blocks; other columns are ignored.
"""

from __future__ import annotations

import os
import re
import struct
import zlib
from array import array

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from martforge.llm.common import checkpointed, small_batches, tokenizer_path

MAGIC = b"MFTB"
END = b"\nEND"
HEAD = struct.Struct("<4sBBHIQ")
BLOCK_IDS = 131_072     # a block is closed once it has this many ids
BLOCKS_PER_FILE = 256   # 64 MB at 16 bits
NULL_ID = -(1 << 63)


def width_for(vocabulary: int) -> int:
    """Least bits that hold ids 0 .. vocabulary-1."""
    return max(1, (vocabulary - 1).bit_length())


def pack(ids: np.ndarray, width: int) -> bytes:
    """``width`` bits an id, lowest bit first."""
    ids = np.ascontiguousarray(ids, dtype="<u4")
    if width in (8, 16, 32):
        return ids.astype(f"<u{width // 8}").tobytes()
    bits = np.unpackbits(ids.view(np.uint8).reshape(-1, 4), axis=1, bitorder="little")[:, :width]
    return np.packbits(bits.ravel(), bitorder="little").tobytes()


def unpack(data, count: int, width: int, start: int = 0) -> np.ndarray:
    """``count`` ids from id number ``start`` on."""
    if width in (8, 16, 32):
        return np.frombuffer(data, f"<u{width // 8}", count, start * width // 8).astype(np.uint32)
    first = start * width
    raw = np.frombuffer(data, np.uint8)[first // 8:(first + count * width + 7) // 8]
    bits = np.unpackbits(raw, bitorder="little")[first % 8:first % 8 + count * width].reshape(count, width)
    padded = np.zeros((count, 32), np.uint8)
    padded[:, :width] = bits
    return np.packbits(padded, axis=1, bitorder="little").view("<u4").ravel()


def block(doc_ids: list[int], docs: list[np.ndarray], width: int) -> bytes:
    """A block without its end mark."""
    offsets = np.zeros(len(docs) + 1, "<u8")
    np.cumsum([len(d) for d in docs], out=offsets[1:])
    ids = np.concatenate(docs) if docs else np.zeros(0, np.uint32)
    return b"".join([HEAD.pack(MAGIC, 1, width, 0, len(docs), len(ids)), np.array(doc_ids, "<i8").tobytes(),
                     offsets.tobytes(), pack(ids, width)])


def blocks_of(data: bytes):
    """``(doc ids, offsets, width, payload)`` of each block of a file."""
    at, view = 0, memoryview(data)
    while at < len(data):
        magic, version, width, _, n_docs, n_ids = HEAD.unpack_from(data, at)
        if magic != MAGIC or version != 1:
            raise ValueError(f"no block begins at byte {at}")
        at += HEAD.size
        doc_ids = np.frombuffer(data, "<i8", n_docs, at)
        at += 8 * n_docs
        offsets = np.frombuffer(data, "<u8", n_docs + 1, at).astype(np.int64)
        at += 8 * (n_docs + 1)
        size = -(-n_ids * width // 8)
        if view[at + size:at + size + 4] != END:
            raise ValueError("block without end")
        yield doc_ids, offsets, width, view[at:at + size]
        at += size + 4


def read_document(data: bytes, block_number: int, position: int) -> np.ndarray:
    """Random access: the ids of one document of one block."""
    for k, (_, offsets, width, payload) in enumerate(blocks_of(data)):
        if k == block_number:
            return unpack(payload, int(offsets[position + 1] - offsets[position]), width, int(offsets[position]))
    raise IndexError(block_number)


_WORD_CACHE: dict[str, dict] = {}
CACHE_WORDS = 500_000  # pieces of one generation of the table, of which two are held


def _plain_pieces() -> tuple[re.Pattern, re.Pattern]:
    """Patterns of the fast path: texts of Latin letters, ASCII marks and common punctuation.

    On these characters ``[^\\W\\d_]`` are the letters and ``\\d`` the numbers, so the standard
    matcher cuts as the tokenizer's own pattern does; any other character sends the text to that one.
    """
    latin = "A-Za-zÀ-ÖØ-öø-ſ"
    odd = re.compile(rf"[^\t\n\r -~{latin}–—‘-„…«»¿¡]")
    cut = re.compile(rf"'(?:[stmd]|re|ve|ll)| ?[{latin}]+| ?[0-9]+| ?[^\s0-9{latin}]+|\s+(?!\S)|\s+")
    return odd, cut


class ByteLevelEncoder:
    """Ids of the public byte-level BPE vocabulary, by the tokenizers library.

    Plain texts are cut into the tokenizer's pieces here; the library encodes the pieces not seen before, a text's new words
    in a row, and they are kept by text, since words repeat (bounded by ``CACHE_WORDS``).  Other texts, and those with a
    special token's string, go to the library whole.
    """

    def __init__(self, name: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # tasks are parallel already
        from tokenizers import Tokenizer
        self.library = Tokenizer.from_file(tokenizer_path(name))
        self.library.no_truncation()
        self.library.no_padding()
        added = self.library.get_added_tokens_decoder()
        self.special = [t.content for t in added.values()]
        self.vocabulary = max([*self.library.get_vocab(with_added_tokens=True).values(), *added]) + 1
        self.odd, self.cut = _plain_pieces()
        self.pieces: dict[str, bytes] = {}  # ids of known pieces as native 32-bit numbers
        self.older: dict[str, bytes] = {}

    def encode(self, text: str) -> np.ndarray:
        if self.odd.search(text) or any(s in text for s in self.special):
            return np.array(self.library.encode(text, add_special_tokens=False).ids, np.uint32)
        if len(self.pieces) > CACHE_WORDS:  # two generations: pieces that do not come again are dropped
            self.pieces, self.older = {}, self.pieces
        found = self.cut.findall(text)
        fresh = set(found).difference(self.pieces)
        if fresh:
            self._learn(fresh)
        return np.frombuffer(b"".join(map(self.pieces.__getitem__, found)), np.uint32)

    def _learn(self, fresh: set[str]) -> None:
        """Put pieces into the current generation of the table."""
        words, others = [], []
        for p in fresh:
            known = self.older.get(p)
            if known is not None:
                self.pieces[p] = known
            elif p[0] == " " and p[1:].isalpha():
                words.append(p)
            else:
                others.append(p)
        if words:  # a space begins a piece, so the library cuts the words in a row as they are
            e = self.library.encode("".join(words), add_special_tokens=False)
            of = np.array(e.word_ids)
            if of[-1] != len(words) - 1:
                raise ValueError("the library cut words in a row otherwise")
            ends = np.searchsorted(of, np.arange(len(words)), "right")
            ids, ends = array("I", e.ids).tobytes(), (4 * ends).tolist()
            self.pieces.update(zip(words, map(ids.__getitem__, map(slice, [0, *ends], ends))))
        for p, e in zip(others, self.library.encode_batch_fast(others, add_special_tokens=False)):
            self.pieces[p] = array("I", e.ids).tobytes()


def encoder(name: str) -> ByteLevelEncoder:
    """One encoder a Python worker."""
    if name not in _WORD_CACHE:
        _WORD_CACHE[name] = ByteLevelEncoder(name)
    return _WORD_CACHE[name]


def write_token_files(docs: DataFrame, path: str, tokenizer: str = "byte_bpe_50k.json", end_id: int | None = 2,
                      id_col: str = "doc_id", text_col: str = "text") -> None:
    """Encode every text, append ``end_id``, and write the ids under ``path`` in ascending id order."""
    schema = pa.schema([("value", pa.binary())])

    def run(batches):
        enc = encoder(tokenizer)
        width = width_for(enc.vocabulary)
        end = np.array([] if end_id is None else [end_id], np.uint32)
        doc_ids, held, total = [], [], 0
        for batch in small_batches(batches):
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                ids = np.concatenate((enc.encode(text), end))
                doc_ids.append(doc)
                held.append(ids)
                total += len(ids)
                if total >= BLOCK_IDS:
                    yield pa.RecordBatch.from_pydict({"value": [block(doc_ids, held, width)]}, schema=schema)
                    doc_ids, held, total = [], [], 0
        if held:
            yield pa.RecordBatch.from_pydict({"value": [block(doc_ids, held, width)]}, schema=schema)

    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = (docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(NULL_ID)).alias("id"),
                           F.coalesce(F.col(text_col), F.lit("")).alias("text"))
               .repartitionByRange(parts, "id").sortWithinPartitions("id"))
    (ordered.mapInArrow(run, "value binary").select(F.col("value").cast("string"))
     .write.option("lineSep", END.decode()).option("maxRecordsPerFile", BLOCKS_PER_FILE).text(path))


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """``(file, id, position, first, n_tokens, ids_crc32)`` of every document of the files under ``path``.

    ``first`` counts the ids before it in its file; ``position`` its place in the file.
    """
    files = spark.read.format("binaryFile").load(path).select("path", "content")
    schema = pa.schema([("file", pa.string()), ("id", pa.int64()), ("position", pa.int64()), ("first", pa.int64()),
                        ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())])

    def run(batches):
        for batch in small_batches(batches, 1):
            name, data, base, at = batch.column(0)[0].as_py(), batch.column(1)[0].as_py(), 0, 0
            for doc_ids, offsets, width, payload in blocks_of(data):
                ids = unpack(payload, int(offsets[-1]), width).astype("<u4")
                sums = [zlib.crc32(ids[a:b]) for a, b in zip(offsets[:-1], offsets[1:])]
                yield pa.RecordBatch.from_arrays([
                    pa.array([name] * len(doc_ids)), pa.array(doc_ids), pa.array(np.arange(at, at + len(doc_ids))),
                    pa.array(base + offsets[:-1]), pa.array(np.diff(offsets)), pa.array(sums, pa.int64())], schema=schema)
                base, at = base + int(offsets[-1]), at + len(doc_ids)

    return files.mapInArrow(run, "file string, id long, position long, first long, n_tokens long, ids_crc32 long")


def file_order(name: str) -> tuple[Column, Column]:
    """``task, part``: the numbers in a written file's name, which order files as they were written.

    As text, the 1000th part of a task would come before its 999th, and task 100000 before task 99999.
    """
    number = lambda pattern: F.regexp_extract(F.regexp_extract(name, r"[^/]+$", 0), pattern, 1).cast("long")
    return number(r"^part-(\d+)-").alias("task"), number(r"-c(\d+)\.").alias("part")


def document_starts(spark: SparkSession, path: str) -> DataFrame:
    """``(id, start, n_tokens, ids_crc32)`` over all files: ``start`` counts the ids of all documents before.

    Only one sum a file is put in order in one task.
    """
    docs = checkpointed(read_token_files(spark, path))
    before = Window.orderBy("task", "part").rowsBetween(Window.unboundedPreceding, -1)
    bases = (docs.groupBy("file").agg(F.sum("n_tokens").alias("n")).select("file", "n", *file_order("file"))
             .select("file", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base")))
    return docs.join(bases, "file").select(
        F.when(F.col("id") != NULL_ID, F.col("id")).alias("id"), (F.col("base") + F.col("first")).alias("start"),
        "n_tokens", "ids_crc32")
