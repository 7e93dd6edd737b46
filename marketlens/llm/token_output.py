"""Token ids in files of length-delimited binary records, each with an offset index.

A record is: length of the payload (unsigned 64 bits), masked checksum of those 8 bytes, payload,
masked checksum of the payload; all little-endian, checksums unsigned 32 bits. The payload is the
document id (signed 64 bits), flags (1 byte: bit 0 document has an id, bit 1 ids are 4 bytes wide,
else 2) and the ids. `NAME.rec` goes with `NAME.idx`: the offset of each record, unsigned 64 bits,
so that records can be read in any order.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marketlens.llm.scratch import Scratch
from marketlens.llm.words import slices

# White space as the vocabulary's splitting pattern has it, and the mask of checksums.
WHITE = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
MASK = 0xA282EAD8

#: Where a space stands before other white space, tokens may begin elsewhere than at the space.
RAGGED = f" [{WHITE}]"
FILE_BYTES = 32 << 20
#: Chunks whose ids a Python worker remembers; it starts anew when they are so many.
REMEMBERED = 750_000

HEAD, PAYLOAD, CHECK = struct.Struct("<Q"), struct.Struct("<qB"), struct.Struct("<I")


def masked(data) -> int:
    """Rotated by 15 bits and shifted, so that a checksum of checksums is no trivial value."""
    crc = zlib.crc32(data)
    return (((crc >> 15) | (crc << 17)) + MASK) & 0xFFFFFFFF


class Encoder:
    """Byte-level BPE of whole texts; every distinct chunk between spaces is encoded once.

    The vocabulary's splitting pattern takes a space to the word that follows, so a token never
    goes over the beginning of " word". Texts where more white space follows a space, and texts with
    special tokens, are encoded as they are.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        wide = self.tokenizer.get_vocab_size(with_added_tokens=True) > 1 << 16
        self.type = np.dtype("<u4" if wide else "<u2")
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        # In a byte-level vocabulary every character of a token's name is one byte of text.
        names = self.tokenizer.get_vocab(with_added_tokens=True)
        self.bytes_of = np.zeros(max(names.values()) + 1, np.int64)
        for name, number in names.items():
            self.bytes_of[number] = len(name)
        self.known: dict[str, bytes] = {}

    def _whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, self.type).tobytes()

    def _learn(self, chunks: list[str]) -> None:
        """Encode new chunks as one text and cut its ids where chunks end."""
        if len(self.known) + len(chunks) > REMEMBERED:
            self.known.clear()
        text = " " + " ".join(chunks)
        [encoded] = self.tokenizer.encode_batch_fast([text], add_special_tokens=False)
        ids, raw = np.array(encoded.ids, self.type), np.frombuffer(text.encode(), np.uint8)
        ends = np.append(np.flatnonzero(raw == 0x20)[1:], len(raw))  # chunks have no spaces
        cuts = (np.searchsorted(np.cumsum(self.bytes_of[ids]), ends, side="right") * self.type.itemsize).tolist()
        data = ids.tobytes()
        self.known.update({chunk: data[begin:cut] for chunk, begin, cut in zip(chunks, [0, *cuts], cuts)})

    def _odd(self, texts: pa.Array) -> np.ndarray:
        """Texts that have to be encoded as they are."""
        odd = pc.or_(pc.match_substring_regex(texts, RAGGED), pc.ends_with(texts, " "))
        for special in self.special:
            odd = pc.or_(odd, pc.match_substring(texts, special))
        return odd.to_numpy(zero_copy_only=False)

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text, as bytes."""
        return [b"".join(ids) for ids in self.encode_column(pa.array(texts, pa.large_string()))]

    def encode_column(self, texts: pa.Array) -> list[tuple]:
        """The ids of each text, as pieces of bytes; null is empty."""
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        odd = self._odd(texts)
        cut = pc.split_pattern(texts.filter(pa.array(~odd)), " ")
        begin = np.concatenate(([0], np.cumsum(cut.value_lengths().to_numpy())))
        parts = cut.flatten()
        # What stands before the first space of a text has no space before it.
        leading = np.zeros(len(parts), bool)
        leading[begin[:-1]] = True
        first = iter(parts.filter(pa.array(leading)).to_pylist())
        chunks = parts.filter(pa.array(~leading)).dictionary_encode()
        names = chunks.dictionary.to_numpy(zero_copy_only=False).tolist()
        found = list(map(self.known.get, names))
        new = [k for k, ids in enumerate(found) if ids is None]
        if new:
            self._learn([names[k] for k in new])
            for k in new:
                found[k] = self.known[names[k]]
        sizes = np.array([len(ids) for ids in found], np.int64) // self.type.itemsize
        starts, chosen = np.cumsum(sizes) - sizes, chunks.indices.to_numpy()
        ends = np.concatenate(([0], np.cumsum(sizes[chosen])))
        at = np.arange(ends[-1]) + np.repeat(starts[chosen] - ends[:-1], sizes[chosen])
        data = memoryview(np.frombuffer(b"".join(found), self.type)[at].tobytes())
        edges = (ends[begin - np.arange(len(begin))] * self.type.itemsize).tolist()
        spans = zip(edges, edges[1:])
        out = []
        for text, whole in zip(texts.to_pylist() if odd.any() else repeat(None), odd.tolist()):
            if whole:
                out.append((self._whole(text),))
            else:
                own, (low, high) = next(first), next(spans)
                out.append((self._whole(own) if own else b"", data[low:high]))
        return out


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


class RecordWriter:
    """Files of one task. They get their names when complete; a repeated task replaces them."""

    def __init__(self, folder: str, part: int, file_bytes: int, attempt: int):
        self.files, self.folder = pafs.FileSystem.from_uri(folder)
        self.part, self.file_bytes, self.attempt = part, file_bytes, attempt
        self.sequence, self.out = 0, None

    def add(self, payload: list[bytes], tokens: int) -> dict | None:
        """Append a record; the summary of a file that is now full."""
        if self.out is None:
            self.name = f"part-{self.part:08d}-{self.sequence:06d}"
            self.temporary = f"{self.folder}/_{self.name}-{self.attempt}"
            self.out = self.files.open_output_stream(f"{self.temporary}.rec")
            self.offsets, self.size, self.tokens = [], 0, 0
        data = b"".join(payload)
        head = HEAD.pack(len(data))
        record = b"".join((head, CHECK.pack(masked(head)), data, CHECK.pack(masked(data))))
        self.out.write(record)
        self.offsets.append(self.size)
        self.size += len(record)
        self.tokens += tokens
        return self.close() if self.size >= self.file_bytes else None

    def close(self) -> dict | None:
        if self.out is None:
            return None
        self.out.close()
        with self.files.open_output_stream(f"{self.temporary}.idx") as out:
            out.write(np.array(self.offsets, "<u8").tobytes())
        for kind in ("idx", "rec"):
            self.files.move(f"{self.temporary}.{kind}", f"{self.folder}/{self.name}.{kind}")
        self.out = None
        self.sequence += 1
        return {"part": self.part, "sequence": self.sequence - 1, "name": self.name, "n_docs": len(self.offsets), "n_tokens": self.tokens}


FILES = "part int, sequence int, name string, n_docs long, n_tokens long"


def _write(batches, folder: str, tokenizer: str, end_id: int, file_bytes: int):
    task = TaskContext.get()
    encode = encoder(tokenizer)
    end = np.array([end_id], encode.type).tobytes()
    wide = 2 * (encode.type.itemsize == 4)
    writer = RecordWriter(folder, task.partitionId(), file_bytes, task.taskAttemptId())
    done = []
    for batch in batches:
        for piece in slices(batch):
            for doc, ids in zip(piece.column("doc_id").to_pylist(), encode.encode_column(piece.column("text"))):
                head = PAYLOAD.pack(doc or 0, (doc is not None) | wide)
                done.append(writer.add([head, *ids, end], sum(map(len, ids)) // encode.type.itemsize + 1))
    done = [d for d in [*done, writer.close()] if d]
    schema = [("part", pa.int32()), ("sequence", pa.int32()), ("name", pa.string()), ("n_docs", pa.int64()), ("n_tokens", pa.int64())]
    yield pa.RecordBatch.from_pylist(done, pa.schema(schema))


def write_records(
    docs: DataFrame, folder: str, tokenizer: str, end_id: int = 0, file_bytes: int = FILE_BYTES,
    id_column: str = "doc_id", text_column: str = "text",
) -> DataFrame:
    """Encode every text, append `end_id`, write records in ascending order of id; the files' list.

    The list (part, sequence, name, n_docs, n_tokens, start) is in order of ids; start counts the
    ids in all files before. Null and empty texts have only the end id. Rows without id come first.
    Rows of equal id are ordered by their texts. No rows write no files. `folder` must be open to
    all executors (file, hdfs, s3, gs).
    """
    rows = docs.select(F.col(f"`{id_column}`").cast("long").alias("doc_id"), F.col(f"`{text_column}`").cast("string").alias("text"))
    rows = rows.withColumn("tie", F.xxhash64("text"))
    ordered = rows.repartitionByRange("doc_id", "tie").sortWithinPartitions("doc_id", "tie", "text").drop("tie")
    files = ordered.mapInArrow(lambda batches: _write(batches, folder, tokenizer, end_id, file_bytes), FILES)
    files = Scratch(docs.sparkSession, "records").keep(files, "files")
    before = Window.orderBy("part", "sequence").rowsBetween(Window.unboundedPreceding, -1)
    return files.withColumn("start", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)))  # one row per file


def read_file(folder: str, name: str, order: np.ndarray | None = None) -> Iterator[tuple[int | None, np.ndarray]]:
    """(document id, ids) of the records of a file, in order or in any `order` of record numbers."""
    files, root = pafs.FileSystem.from_uri(folder)
    with files.open_input_stream(f"{root}/{name}.idx") as source:
        offsets = np.frombuffer(source.read(), "<u8")
    with files.open_input_file(f"{root}/{name}.rec") as source:
        for k in range(len(offsets)) if order is None else order:
            source.seek(int(offsets[k]))
            head = source.read(12)
            if CHECK.unpack(head[8:])[0] != masked(head[:8]):
                raise ValueError(f"{name}, record {k}: broken length")
            size = HEAD.unpack(head[:8])[0]
            data = source.read(size + 4)
            if CHECK.unpack(data[size:])[0] != masked(data[:size]):
                raise ValueError(f"{name}, record {k}: broken payload")
            doc, flags = PAYLOAD.unpack_from(data)
            yield doc if flags & 1 else None, np.frombuffer(data, "<u4" if flags & 2 else "<u2", (size - 9) // (4 if flags & 2 else 2), 9)


def _read(batches, folder: str):
    for batch in batches:
        for name, start in zip(batch.column("name").to_pylist(), batch.column("start").to_pylist()):
            docs, starts, sizes, checks = [], [], [], []
            for doc, ids in read_file(folder, name):
                docs.append(doc)
                starts.append(start)
                sizes.append(len(ids))
                checks.append(zlib.crc32(ids.astype("<u4").tobytes()))
                start += len(ids)
            yield pa.RecordBatch.from_pydict({
                "doc_id": pa.array(docs, pa.int64()), "start": pa.array(starts, pa.int64()),
                "n_tokens": pa.array(sizes, pa.int64()), "ids_crc32": pa.array(checks, pa.int64()),
            })


def read_records(files: DataFrame, folder: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every record of the listed files, checksums verified."""
    spread = files.select("name", "start").repartition("name")
    return spread.mapInArrow(lambda batches: _read(batches, folder), "doc_id long, start long, n_tokens long, ids_crc32 long")
