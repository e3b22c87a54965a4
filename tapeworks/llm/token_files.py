"""Token ids in files of fixed-width bit-packed blocks.

A file is a run of blocks of BLOCK ids, the last one shorter. In a block, ids are stored in ``bits`` bits
each, the least that hold every id of the vocabulary, 64 ids to ``bits`` little-endian 64-bit words. The
footer has, as little-endian 64-bit integers, the byte offset of each block, the id of each document, a flag
where that id is null, and the number of ids of each document; the last 40 bytes are MAGIC, bits, and the
number of blocks, documents and ids. Blocks that a reader needs follow from BLOCK, so any run of ids is read
without the others.
"""

from __future__ import annotations

import json
import re
import uuid
import zlib
from array import array
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pafs
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tapeworks.functions.scratch import new_path, stored

from .words import small_batches

MAGIC = b"BITPACK1"
BLOCK = 1 << 16
#: Chunks whose ids a worker keeps, in two halves; characters that are encoded at once; bytes of text for which there is a file.
KEPT_CHUNKS, RUN_CHARS, FILE_BYTES = 400_000, 4 << 20, 256 << 20
#: Pre-tokenizer patterns of public tokenizers of which no match holds white space.
PATTERNS = [
    r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+",
]

_SPACE = re.compile(r"[\x20\x09-\x0D]")

_MANIFEST = "part int, path string, n_docs long, n_ids long"


def pack(ids: np.ndarray, bits: int) -> bytes:
    """Ids in `bits` bits each, padded with zeros to a multiple of 64 ids."""
    lanes = np.zeros((-(-len(ids) // 64), 64), np.uint64)
    lanes.ravel()[: len(ids)] = ids
    words = np.zeros((len(lanes), bits), np.uint64)
    for lane in range(64):
        word, shift = divmod(lane * bits, 64)
        words[:, word] |= lanes[:, lane] << np.uint64(shift)
        if shift + bits > 64:
            words[:, word + 1] |= lanes[:, lane] >> np.uint64(64 - shift)
    return words.astype("<u8").tobytes()


def unpack(data: bytes, n: int, bits: int) -> np.ndarray:
    """The first n ids of what pack() returned."""
    words = np.frombuffer(data, "<u8").reshape(-1, bits)
    lanes = np.empty((len(words), 64), np.uint64)
    for lane in range(64):
        word, shift = divmod(lane * bits, 64)
        lanes[:, lane] = words[:, word] >> np.uint64(shift)
        if shift + bits > 64:
            lanes[:, lane] |= words[:, word + 1] << np.uint64(64 - shift)
    return (lanes.ravel()[:n] & np.uint64((1 << bits) - 1)).astype(np.uint32)


class Writer:
    """Writes one file front to back; what it holds is less than a block and three numbers for a document."""

    def __init__(self, sink, bits: int):
        self.sink, self.bits, self.rest = sink, bits, np.zeros(0, np.uint32)
        self.offsets, self.at, self.ids, self.sizes, self.n_ids = [], 0, [], [], 0

    def _block(self, ids: np.ndarray) -> None:
        self.offsets.append(self.at)
        self.at += self.sink.write(data := pack(ids, self.bits)) or len(data)

    def put(self, ids: np.ndarray) -> None:
        """Ids of the document that document() ends next, or of several."""
        self.n_ids += len(ids)
        ids = np.concatenate([self.rest, ids]) if len(self.rest) else ids
        whole = len(ids) // BLOCK * BLOCK
        for k in range(0, whole, BLOCK):
            self._block(ids[k : k + BLOCK])
        self.rest = ids[whole:].copy()

    def document(self, doc_id: int | None, n_ids: int) -> None:
        self.ids.append(doc_id)
        self.sizes.append(n_ids)

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        self.document(doc_id, len(ids))
        self.put(ids)

    def close(self) -> None:
        if len(self.rest):
            self._block(self.rest)
        for column in (self.offsets, [x or 0 for x in self.ids], [x is None for x in self.ids], self.sizes):
            self.sink.write(np.array(column, "<i8").tobytes())
        self.sink.write(MAGIC + np.array([self.bits, len(self.offsets), len(self.ids), self.n_ids], "<i8").tobytes())


class Reader:
    """Random access to a file of Writer's: ids of documents first to last - 1."""

    def __init__(self, source):
        self.source, size = source, source.size()
        tail = source.read_at(40, size - 40)
        if tail[:8] != MAGIC:
            raise ValueError("not a file of packed token ids")
        self.bits, blocks, docs, self.n_ids = (int(x) for x in np.frombuffer(tail[8:], "<i8"))
        footer = np.frombuffer(source.read_at(8 * (blocks + 3 * docs), size - 40 - 8 * (blocks + 3 * docs)), "<i8")
        self.offsets, ids, none, sizes = np.split(footer, [blocks, blocks + docs, blocks + 2 * docs])
        self.doc_ids = [None if m else int(i) for i, m in zip(ids, none, strict=True)]
        self.starts = np.r_[0, np.cumsum(sizes)]
        self.end = size - 40 - 8 * (blocks + 3 * docs)

    def read(self, first: int, last: int) -> np.ndarray:
        start, stop = int(self.starts[first]), int(self.starts[last])
        if start == stop:
            return np.zeros(0, np.uint32)
        low, high = start // BLOCK, -(-stop // BLOCK)
        ends = np.r_[self.offsets, self.end]
        data = self.source.read_at(int(ends[high] - ends[low]), int(ends[low]))
        got = [
            unpack(data[int(ends[b] - ends[low]) : int(ends[b + 1] - ends[low])], min(BLOCK, self.n_ids - b * BLOCK), self.bits)
            for b in range(low, high)
        ]
        return np.concatenate(got)[start - low * BLOCK : stop - low * BLOCK]


def byte_alphabet() -> dict[int, str]:
    """Byte-level vocabularies write byte b as this character: itself if it prints, else the next one from 256 on."""
    prints = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    return {b: chr(b) for b in prints} | {b: chr(256 + k) for k, b in enumerate(sorted(set(range(256)).difference(prints)))}


def piece_pattern(tokenizer_json: str) -> str | None:
    """The pattern of a tokenizer whose pre-tokens can be found without it, or None.

    That is one that composes characters, lower-cases them, keeps the matches of a known pattern, of which
    none holds white space, and writes these as bytes. Its texts may be cut at white space.
    """
    spec = json.loads(tokenizer_json)
    normal, split = (spec.get(k) or {"type": ""} for k in ("normalizer", "pre_tokenizer"))
    normal = normal["normalizers"] if normal["type"] == "Sequence" else [normal]
    replaces = [x for x in normal if x["type"] == "Replace"]
    plain = {x["type"] for x in normal} == {"NFC", "Lowercase", "Replace"} and all(x["pattern"] == {"Regex": r"\s+"} and x["content"] == " " for x in replaces)
    split = split["pretokenizers"] if split["type"] == "Sequence" else [split]
    cuts = [x["type"] for x in split] == ["Split", "ByteLevel"] and split[0]["invert"] and split[0]["behavior"] == "Removed"
    cuts = cuts and split[0]["pattern"].get("Regex") in PATTERNS and not split[1]["add_prefix_space"] and not split[1]["use_regex"]
    bare = all(re.fullmatch(r"[!-@\[-`{-~]\S+", t["content"]) and not t["lstrip"] and not t["rstrip"] for t in spec["added_tokens"])
    return split[0]["pattern"]["Regex"] if plain and cuts and bare else None


class Encoder:
    """Ids of whole texts from the tokenizers library.

    Where piece_pattern() knows the tokenizer, texts are cut at white space, each distinct chunk is encoded
    once and kept, and so is each distinct pre-token of the chunks, which goes to the library's model. Chunks
    with characters beyond Latin, and all texts of other tokenizers, go to the library as they are. What is
    kept is in two halves: when the younger is full it becomes the older one, so what is frequent stays.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_padding()
        self.tokenizer.no_truncation()
        self.added = tuple({t.content for t in self.tokenizer.get_added_tokens_decoder().values()})
        pattern = piece_pattern(self.tokenizer.to_str())
        self.by_chunk = pattern is not None
        self.find = regex.compile(pattern).findall if self.by_chunk else None
        self.model, self.alphabet = self.tokenizer.model.tokenize, byte_alphabet()
        self.young, self.old, self.pieces = {}, {}, {}

    def _piece(self, text: str) -> bytes:
        got = self.pieces.get(text)
        if got is None:
            mapped = text if text.isascii() and text.isprintable() else text.encode().decode("latin1").translate(self.alphabet)
            got = self.pieces[text] = array("I", [t.id for t in self.model(mapped)]).tobytes()
        return got

    def _chunk(self, chunk: str) -> bytes:
        # below U+0250 no character combines with another, and lower case is one to one but for a dotted I
        if chunk.isascii() or max(chunk) < "\u0250" and "\u0130" not in chunk:
            low = chunk.lower()
            stem = low.rstrip(".,")
            if stem.isalpha():
                return self._piece(stem) + self._piece(low[len(stem) :]) if len(stem) < len(low) else self._piece(stem)
            if not any(t in chunk for t in self.added):
                return b"".join(map(self._piece, self.find(low)))
        return array("I", self.tokenizer.encode(chunk, add_special_tokens=False).ids).tobytes()

    def _chunks(self, chunks: list[str]) -> list[bytes]:
        """Ids of each of these distinct chunks, as bytes of 32-bit integers."""
        got = list(map(self.young.get, chunks))
        absent = [i for i, x in enumerate(got) if x is None]
        if len(self.young) + len(absent) > KEPT_CHUNKS // 2:
            self.old, self.young = self.young, {}
        if len(self.pieces) > KEPT_CHUNKS:
            self.pieces.clear()
        young, old = self.young, self.old
        for i in absent:
            c = chunks[i]
            got[i] = young[c] = old.get(c) or self._chunk(c)
        return got

    def batch(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts one after another, and how many each has."""
        if not self.by_chunk:
            every = [np.array(e.ids, np.uint32) for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
            return np.concatenate([np.zeros(0, np.uint32), *every]), np.array([len(e) for e in every], np.int64)
        words = pc.ascii_split_whitespace(pa.array(texts, pa.large_string()))
        coded = words.flatten().dictionary_encode()
        parts = self._chunks(coded.dictionary.to_pylist())
        sizes = np.fromiter(map(len, parts), np.int64, len(parts)) // 4
        data, starts = np.frombuffer(b"".join(parts), np.uint32), np.cumsum(sizes) - sizes
        code = np.asarray(coded.indices)
        size = sizes[code]
        ends = np.r_[0, np.cumsum(size)]
        ids = data[np.repeat(starts[code] - ends[:-1], size) + np.arange(ends[-1])]
        return ids, np.diff(ends[np.asarray(words.offsets)])

    def encode(self, text: str) -> np.ndarray:
        return self.batch([text])[0]


_encoders: dict[str, Encoder] = {}


def encoder_of(path: str) -> Encoder:
    """The worker's encoder for this file: tasks that follow each other in a worker share what it has kept."""
    if path not in _encoders:
        _encoders.clear()
        _encoders[path] = Encoder(path)
    return _encoders[path]


def runs(rows: Iterator[tuple[int | None, str | None]], by_chunk: bool) -> Iterator[tuple[list, list[str], bool]]:
    """Runs of texts of about RUN_CHARS: (ids, texts, whether the last text goes on). Texts longer than that are cut at white space if they may be."""
    own, some, size = [], [], 0
    for doc_id, text in rows:
        text, at = text or "", 0
        while by_chunk and len(text) - at > RUN_CHARS and (cut := _SPACE.search(text, at + RUN_CHARS)):
            yield [*own, doc_id], [*some, text[at : cut.start()]], True
            own, some, size, at = [], [], 0, cut.end()
        own.append(doc_id)
        some.append(text[at:] if at else text)
        size += len(some[-1])
        if size >= RUN_CHARS:
            yield own, some, False
            own, some, size = [], [], 0
    if own:
        yield own, some, False


def _file(uri: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(uri)


def write_token_files(docs: DataFrame, out_uri: str, tokenizer_path: str, end_id: int = 1, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encodes every row's whole text, appends end_id, and writes files of ascending ids under ``out_uri``.

    Returns the stored manifest (part, path, n_docs, n_ids), a row for each file; parts ascend as doc_id
    does, nulls first. A null text counts as empty and holds the end id alone. Rows of one doc_id follow
    each other in the order of their text's hash. A very long text is encoded in runs of RUN_CHARS where the
    tokenizer allows that. Other columns are not read; an empty table gives an empty manifest. There is a
    file for FILE_BYTES of text, or for each shuffle partition if that makes more. ``out_uri`` is an absolute
    path or a URI that pyarrow opens (file, hdfs, s3, gs) in a folder that all workers share. A task that is
    run again writes a file of its own name and then moves it into place, so half-written files are never read.
    """
    spark = docs.sparkSession
    small_batches(spark)
    fs, path = _file(out_uri)
    fs.create_dir(path, recursive=True)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (row for batch in batches for row in zip(batch["doc_id"].to_pylist(), batch["text"].to_pylist(), strict=True))
        if (first := next(rows, None)) is None:
            return
        part, encoder, (fs, folder), before = TaskContext.get().partitionId(), encoder_of(tokenizer_path), _file(out_uri), 0
        name, own = f"{folder}/part-{part:06d}.ids", f"{folder}/.{uuid.uuid4().hex}"
        with fs.open_output_stream(own) as sink:
            writer = Writer(sink, max(1, max(encoder.tokenizer.get_vocab_size() - 1, end_id).bit_length()))
            for doc_ids, texts, goes_on in runs(chain([first], rows), encoder.by_chunk):
                ids, sizes = encoder.batch(texts)
                ends = np.cumsum(sizes)[: len(sizes) - goes_on]
                writer.put(np.insert(ids, ends, np.uint32(end_id)))
                sizes[0] += before
                for doc_id, n in zip(doc_ids[: len(ends)], sizes.tolist()):
                    writer.document(doc_id, n + 1)
                before = int(sizes[-1]) if goes_on else 0
            writer.close()
        fs.move(own, name)
        at = f"{out_uri.rstrip('/')}/part-{part:06d}.ids"
        yield pa.RecordBatch.from_pydict({"part": pa.array([part], pa.int32()), "path": [at], "n_docs": [len(writer.ids)], "n_ids": [writer.n_ids]})

    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    size = docs.agg(F.sum(F.octet_length("text")).alias("b")).first()["b"] or 0
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // FILE_BYTES))
    ordered = docs.repartitionByRange(parts, "doc_id").sortWithinPartitions("doc_id", F.xxhash64("text"))
    return stored(ordered.mapInArrow(write, _MANIFEST), "manifest")


def read_token_files(manifest: DataFrame) -> DataFrame:
    """Per document of the files: doc_id, start (ids of all documents before it), n_tokens, ids_crc32.

    The start of a file is a running sum over the manifest, which has a row for each file and none for
    documents.
    """
    from pyspark.sql import Window

    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    files = manifest.withColumn("start", F.coalesce(F.sum("n_ids").over(before), F.lit(0)))
    files = files.repartition(int(manifest.sparkSession.conf.get("spark.sql.shuffle.partitions")), "path")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for uri, start in zip(batch["path"].to_pylist(), batch["start"].to_pylist(), strict=True):
                fs, path = _file(uri)
                with fs.open_input_file(path) as source:
                    reader, docs = Reader(source), 2000
                    for first in range(0, len(reader.doc_ids), docs):
                        last = min(first + docs, len(reader.doc_ids))
                        at = reader.starts[first : last + 1]
                        data = memoryview(reader.read(first, last).astype("<u4").tobytes())
                        cut = 4 * (at - at[0])
                        yield pa.RecordBatch.from_pydict({
                            "doc_id": pa.array(reader.doc_ids[first:last], pa.int64()),
                            "start": pa.array(start + at[:-1], pa.int64()),
                            "n_tokens": pa.array(np.diff(at), pa.int64()),
                            "ids_crc32": pa.array([zlib.crc32(data[a:b]) for a, b in zip(cut[:-1], cut[1:], strict=True)], pa.int64()),
                        })

    return files.mapInArrow(read, "doc_id long, start long, n_tokens long, ids_crc32 long")


def new_folder(spark: SparkSession) -> str:
    """A folder for token files beside the checkpoints."""
    return new_path(spark, "tokens")
