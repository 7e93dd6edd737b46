"""SentencePiece encoding and decoding over a table of distinct chunks.

No piece of the vocabulary goes on over a white-space marker, so a text falls into chunks, each the
marker(s) and what follows up to the next one, and a chunk's pieces depend on nothing else.

1. Every task cuts its documents into chunks, by blocks of documents: the sequence of chunk numbers
   of each document, and the block's distinct chunks dealt to shards by hash.
2. Each shard segments each distinct chunk once and hands the ids back to the blocks.
3. Each block decodes its distinct chunks and puts ids and texts together by position.

Texts themselves are never shuffled; numbers and chunks travel packed and compressed.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import defaultdict
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlens.llm.scratch import Scratch
from marketlens.llm.words import slices

# Fixed value: the marker that stands for a space.
MARK = "▁"
MARKED = re.compile(f"{MARK}+[^{MARK}]*")
BLOCK_BYTES = 16 << 20
#: Chunks that a worker keeps segmented; beyond it starts anew, and segments some chunks again.
REMEMBERED = 1_000_000

PACKED = "kind int, block long, shard int, payload binary"


def chunks_of(text: str) -> list[str]:
    """Chunks without their first marker, which each of them has: the text begins with one."""
    if not text:
        return []
    if MARK in text or "  " in text or text[0] == " " or text[-1] == " ":
        return [chunk[1:] for chunk in MARKED.findall(MARK + text.replace(" ", MARK))]
    return text.split(" ")


def pack(*arrays: np.ndarray | bytes) -> bytes:
    """Arrays one after the other, each compressed, with its length in front."""
    squeeze = zstandard.ZstdCompressor(level=3)
    parts = [squeeze.compress(a if isinstance(a, bytes) else np.ascontiguousarray(a).tobytes()) for a in arrays]
    return b"".join(len(p).to_bytes(8, "little") + p for p in parts)


def unpack(data: bytes) -> list[bytes]:
    expand, at, out = zstandard.ZstdDecompressor(), 0, []
    while at < len(data):
        size = int.from_bytes(data[at : at + 8], "little")
        out.append(expand.decompress(data[at + 8 : at + 8 + size]))
        at += 8 + size
    return out


def pack_texts(texts: list[str]) -> tuple[np.ndarray, bytes]:
    raw = [t.encode() for t in texts]
    return np.array([len(r) for r in raw], np.uint32), b"".join(raw)


def unpack_texts(lengths: bytes, data: bytes) -> list[str]:
    ends = np.cumsum(np.frombuffer(lengths, np.uint32)).tolist()
    return [data[a:b].decode() for a, b in zip([0, *ends], ends)]


class Block:
    """Documents whose chunks are numbered together."""

    def __init__(self):
        self.numbers: dict[str, int] = defaultdict()
        self.numbers.default_factory = self.numbers.__len__
        self.docs, self.valid, self.sizes, self.sequences, self.bytes = [], [], [], [], 0

    def add(self, docs: list, texts: list[str | None]) -> None:
        get = self.numbers.__getitem__
        for doc, text in zip(docs, texts):
            found = chunks_of(text or "")
            self.docs.append(doc or 0)
            self.valid.append(doc is not None)
            self.sizes.append(len(found))
            self.sequences.append(np.fromiter(map(get, found), np.uint32, len(found)))

    def numbered(self, shards: int) -> tuple[np.ndarray, np.ndarray, list[list[str]]]:
        """Shard and number in the shard of every chunk in sequence, and the chunks of each shard.

        Frequent chunks get small numbers, so that most high bytes are zero; those that occur once
        follow in the order of their texts, which packs better.
        """
        sequence = np.concatenate([*self.sequences, np.empty(0, np.uint32)])
        names = list(self.numbers)
        uses = np.bincount(sequence, minlength=len(names)).tolist()
        shard = [zlib.crc32(name.encode()) % shards for name in names]
        order = sorted(range(len(names)), key=lambda k: (shard[k], -uses[k], names[k] if uses[k] == 1 else ""))
        own: list[list[str]] = [[] for _ in range(shards)]
        number = np.empty(len(names), np.uint32)
        for k in order:
            number[k] = len(own[shard[k]])
            own[shard[k]].append(names[k])
        shard = np.array(shard, np.uint16)
        return (shard[sequence], number[sequence], own) if names else (shard, number, own)

    def name(self) -> int:
        """A hash of all that is in the block: the same in both readings. Equal blocks share it."""
        state = hashlib.blake2b(digest_size=8)
        for part in (np.array(self.docs, np.int64), np.array(self.sizes, np.int64), *self.sequences):
            state.update(part.tobytes())
        state.update("\n".join(self.numbers).encode())
        return int.from_bytes(state.digest(), "little", signed=True)

    def chunk_rows(self, shards: int) -> list[dict]:
        (_, _, own), name = self.numbered(shards), self.name()
        return [{"kind": 0, "block": name, "shard": k, "payload": pack(*pack_texts(names))} for k, names in enumerate(own) if names]

    def sequence_rows(self, shards: int) -> list[dict]:
        shard, number, own = self.numbered(shards)
        planes = [((number >> np.uint32(8 * k)) & np.uint32(255)).astype(np.uint8) for k in range(4)]
        low, high = (shard & np.uint16(255)).astype(np.uint8), (shard >> np.uint16(8)).astype(np.uint8)
        counts = np.array([len(names) for names in own], np.uint32)
        head = (np.array(self.docs, np.int64), np.array(self.valid, bool), np.array(self.sizes, np.uint32))
        return [{"kind": 1, "block": self.name(), "shard": shards, "payload": pack(*head, counts, low, high, *planes)}]


def _batch(rows: list[dict]) -> pa.RecordBatch:
    schema = pa.schema([("kind", pa.int32()), ("block", pa.int64()), ("shard", pa.int32()), ("payload", pa.binary())])
    return pa.RecordBatch.from_pylist(rows, schema)


def _cut(batches, kind: int, shards: int, block_bytes: int):
    """Documents to the distinct chunks of blocks (kind 0) or to their numbered sequences (kind 1)."""
    block = Block()
    for batch in batches:
        for piece in slices(batch):
            block.add(piece.column("doc_id").to_pylist(), piece.column("text").to_pylist())
            block.bytes += piece.nbytes
            if block.bytes >= block_bytes:
                yield _batch((block.sequence_rows if kind else block.chunk_rows)(shards))
                block = Block()
    if block.docs:
        yield _batch((block.sequence_rows if kind else block.chunk_rows)(shards))


class Segmenter:
    """Ids of chunks, each segmented once."""

    def __init__(self, model: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=model)
        self.end = self.model.eos_id()
        self.alone = [self.model.piece_to_id(MARK)]
        self.known: dict[str, bytes] = {}

    def learn(self, chunks: list[str]) -> None:
        if len(self.known) + len(chunks) > REMEMBERED:
            self.known.clear()
        # The library puts a marker before a text: the chunk's first one. It puts none before ''.
        for chunk, ids in zip(chunks, self.model.encode(chunks, num_threads=1)):
            ids = ids if chunk else self.alone
            self.known[chunk] = np.array(ids, np.int32).tobytes()


_segmenters: dict[str, Segmenter] = {}


def segmenter(model: str) -> Segmenter:
    if model not in _segmenters:
        _segmenters[model] = Segmenter(model)
    return _segmenters[model]


def _segment(batches, model: str):
    """Distinct chunks of blocks, dealt by shard, to their ids."""
    segment = segmenter(model)
    for batch in batches:
        for block, shard, payload in zip(batch.column("block").to_pylist(), batch.column("shard").to_pylist(), batch.column("payload").to_pylist()):
            chunks = unpack_texts(*unpack(payload))
            if new := [c for c in chunks if c not in segment.known]:
                segment.learn(chunks if len(segment.known) + len(new) > REMEMBERED else new)
            found = [segment.known[c] for c in chunks]
            sizes = np.array([len(ids) // 4 for ids in found], np.uint32)
            ids = np.frombuffer(b"".join(found), np.uint32)
            planes = [((ids >> np.uint32(8 * k)) & np.uint32(255)).astype(np.uint8) for k in range(4)]
            yield _batch([{"kind": 0, "block": block, "shard": shard, "payload": pack(sizes, *planes)}])


def _joined(planes: list[bytes]) -> np.ndarray:
    return sum(np.frombuffer(p, np.uint8).astype(np.uint32) << np.uint32(8 * k) for k, p in enumerate(planes))


def _assemble(batches, model: str, finish: Callable):
    """Rows in the order (block, kind, shard): the block's chunks, then its sequences."""
    segment, current, got = segmenter(model), None, {}
    for batch in batches:
        for kind, block, shard, payload in zip(*(batch.column(c).to_pylist() for c in ("kind", "block", "shard", "payload"))):
            if block != current:
                current, got = block, {}
            if kind == 0:
                got[shard] = payload
                continue
            docs, valid, sizes, counts, low, high, *planes = unpack(payload)
            counts = np.frombuffer(counts, np.uint32).astype(np.int64)
            ids, found = [], np.zeros(len(counts), np.int64)
            for shard, payload in sorted(got.items()):
                own, *parts = unpack(payload)
                own = np.frombuffer(own, np.uint32)
                found[shard] = len(own)
                ids += [part.tolist() for part in np.split(_joined(parts), np.cumsum(own)[:-1])]
            if not np.array_equal(found, counts):
                raise ValueError("a block's chunks are not those of its sequences: the documents changed between two reads")
            sequence = (np.cumsum(counts) - counts)[_joined([low, high])] + _joined(planes)
            texts = segment.model.decode(ids) if ids else []
            yield from finish(
                np.frombuffer(docs, np.int64), np.frombuffer(valid, bool), np.frombuffer(sizes, np.uint32), sequence, ids, texts, segment.end
            )


def whole_ids(docs, valid, sizes, sequence, ids, texts, end) -> Iterator[pa.RecordBatch]:
    """doc_id, ids (with the end id) and the decoded text, some hundred documents at a time."""
    ends = np.cumsum(sizes.astype(np.int64))
    for begin in range(0, len(docs), 256):
        rows, decoded = [], []
        for k in range(begin, min(begin + 256, len(docs))):
            own = sequence[ends[k] - sizes[k] : ends[k]].tolist()
            rows.append([i for c in own for i in ids[c]] + [end])
            decoded.append(" ".join([texts[c] for c in own]))
        stop = begin + len(rows)
        yield pa.RecordBatch.from_pydict({
            "doc_id": pa.array(docs[begin:stop], pa.int64(), mask=~valid[begin:stop]),
            "ids": pa.array(rows, pa.list_(pa.int32())), "decoded": pa.array(decoded, pa.string()),
        })


WHOLE = "doc_id long, ids array<int>, decoded string"


def encode_and_decode(
    docs: DataFrame, model: str, finish: Callable = whole_ids, schema: str = WHOLE,
    block_bytes: int = BLOCK_BYTES, rereadable: bool = True, id_column: str = "doc_id", text_column: str = "text",
) -> DataFrame:
    """Pieces of every whole text with an end id, and the text decoded from them: a row per row.

    The result equals encoding each text with the library (end id, no sampling) and decoding it.
    Null and empty texts have the end id only and decode to ''. Null ids are kept, repeated rows
    stay repeated, other columns are ignored, no rows give no rows. `finish` makes the rows that
    are returned, in the columns of `schema`, out of a block's chunks: see `whole_ids`.
    """
    spark = docs.sparkSession
    shards = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(F.col(f"`{id_column}`").cast("long").alias("doc_id"), F.col(f"`{text_column}`").cast("string").alias("text"))
    if not rereadable:
        rows = Scratch(spark, "pieces").keep(rows, "docs")
    chunks = rows.mapInArrow(lambda batches: _cut(batches, 0, shards, block_bytes), PACKED)
    sequences = rows.mapInArrow(lambda batches: _cut(batches, 1, shards, block_bytes), PACKED)
    chunks = chunks.repartition("shard").sortWithinPartitions("shard", "block")
    segmented = chunks.mapInArrow(lambda batches: _segment(batches, model), PACKED)
    both = segmented.unionAll(sequences).repartition("block").sortWithinPartitions("block", "kind", "shard")
    return both.mapInArrow(lambda batches: _assemble(batches, model, finish), schema)
