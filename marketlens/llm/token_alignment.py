"""Alignment of two tokenizers' tokens over the same bytes, with corpus-wide pair counts.

A is a byte-level BPE of the tokenizers library, read over a space and the text; B is a
SentencePiece model, read over the text, which puts that space there itself.

1. A document is cut before each space that follows other than white space. No token of either
   vocabulary goes over such a cut, so every distinct chunk is aligned once and reused.
2. Of a chunk, the libraries' spans (character offsets of A, spans of B's proto) give the coarse
   ends of tokens. Tokens that share a character, bytes of a multibyte one or byte-fallback pieces,
   get their ends from the lengths of their decoded bytes, counted from the last coarse end.
3. Ends that A and B share cut the chunk into groups. Between two neighbouring ends of either side
   lies exactly one overlap of an A and a B token: those are the links.
4. A block of documents reports its distinct pairs once, with the number of its documents that hold
   them; Spark adds up the blocks, finds each A id's highest count, and hands the counts back to
   the blocks, which add them up per document.

The rows that are shuffled are distinct pairs of blocks, not links; no text is shuffled.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable, Iterable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlens.llm.pieces import MARK, pack, unpack
from marketlens.llm.scratch import Scratch
from marketlens.llm.words import slices

# Python's white space holds all that the vocabularies know, so fewer cuts are made, never wrong ones.
CUT = re.compile(r"(?<=\S) ")
RAGGED = re.compile(r"\s |^ ")
BLOCK_BYTES = 16 << 20
#: Chunks a worker keeps aligned between blocks. More are aligned again, not left out.
REMEMBERED = 300_000
#: Chunks encoded as one text.
TOGETHER = 128
#: Chunks of documents whose pairs are found together.
PAIRED = 1 << 18

BLOCKS = "block string, codes binary, uses binary, payload binary"
NUMBERS = ("n_a", "n_b", "n_groups", "n_links")


def chunks_of(text: str) -> list[str]:
    """Chunks, each without the one space before it."""
    return CUT.split(text) if RAGGED.search(text) else text.split(" ")


def byte_names() -> dict[str, int]:
    """Characters that stand for bytes in a byte-level vocabulary.

    Printable Latin-1 characters stand for themselves; the other bytes, in order, for U+0100 on.
    """
    plain = [b for b in range(256) if 0x21 <= b <= 0x7E or 0xA1 <= b <= 0xAC or 0xAE <= b]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(others)}


def refined(begin: np.ndarray, end: np.ndarray, sizes: np.ndarray, loose: np.ndarray) -> np.ndarray:
    """Byte ends of tokens, from coarse spans and the lengths of the decoded bytes.

    A coarse end holds unless the next token begins before it or has no span of its own, or the
    token is `loose` (a byte piece); such ends follow from the decoded lengths since the last end
    that holds.
    """
    if not len(end):
        return end
    holds = np.ones(len(end), bool)
    holds[:-1] = (begin[1:] >= end[:-1]) & ~loose[:-1] & ~loose[1:]
    total = np.cumsum(sizes)
    last = np.maximum.accumulate(np.where(holds, np.arange(len(end)), -1))
    base = np.where(last >= 0, end[last] - total[last], 0)
    return np.where(holds, end, total + base)


class Aligned:
    """Aligned chunks: numbers per chunk, its groups as text, and the pairs of its links.

    Chunks are added in place; arrays are joined when they are next needed.
    """

    def __init__(self, names=(), numbers=None, good=None, groups=(), codes=None):
        self.names, self.groups = list(names), list(groups)
        self._numbers = [np.zeros((0, 4), np.int32) if numbers is None else numbers.astype(np.int32)]
        self._good = [np.zeros(0, bool) if good is None else good]
        self._codes = [np.zeros(0, np.int64) if codes is None else codes]

    def add(self, other: Aligned) -> None:
        self.names += other.names
        self.groups += other.groups
        for own, new in ((self._numbers, other._numbers), (self._good, other._good), (self._codes, other._codes)):
            own += new

    @staticmethod
    def _joined(parts: list[np.ndarray]) -> np.ndarray:
        if len(parts) > 1:
            parts[:] = [np.concatenate(parts)]
        return parts[0]

    numbers = property(lambda self: self._joined(self._numbers))
    good = property(lambda self: self._joined(self._good))
    codes = property(lambda self: self._joined(self._codes))

    def ends(self) -> np.ndarray:
        return np.cumsum(self.numbers[:, 3], dtype=np.int64)

    def taken(self, rows: np.ndarray) -> Aligned:
        return Aligned(
            [self.names[k] for k in rows], self.numbers[rows], self.good[rows], [self.groups[k] for k in rows],
            self.codes[spread(self.ends() - self.numbers[:, 3], self.numbers[:, 3], rows)],
        )


def spread(starts: np.ndarray, sizes: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Positions of all items of `rows`, row after row, where row k has sizes[k] items from starts[k]."""
    sizes = sizes[rows].astype(np.int64)
    before = np.cumsum(sizes) - sizes
    return np.arange(int(sizes.sum())) + np.repeat(starts[rows] - before, sizes)


class Numbers(dict):
    """Chunks numbered in the order in which they are first asked for."""

    def __init__(self, names=()):
        self.names = list(names)
        super().__init__(zip(self.names, range(len(self.names))))

    def __missing__(self, name: str) -> int:
        self[name] = number = len(self.names)
        self.names.append(name)
        return number


class Side:
    """Bytes of a vocabulary's tokens."""

    def __init__(self, tokens: list[bytes]):
        self.sizes = np.array([len(t) for t in tokens], np.int64)
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.data = np.frombuffer(b"".join(tokens), np.uint8)

    def spell(self, ids: np.ndarray) -> np.ndarray:
        return self.data[spread(self.starts, self.sizes, ids)]


class Aligner:
    """Both vocabularies, and the chunks a worker has aligned."""

    def __init__(self, a_path: str, b_path: str):
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(a_path)
        # Special tokens' strings in a text are plain text.
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        names, values = self.a.get_vocab(with_added_tokens=True), byte_names()
        self.a_bytes = [b""] * (max(names.values()) + 1)
        for name, number in names.items():
            self.a_bytes[number] = bytes([values[c] for c in name]) if all(c in values for c in name) else name.encode()
        pieces = [self.b.id_to_piece(k) for k in range(self.b.get_piece_size())]
        self.fallback = np.array([self.b.is_byte(k) for k in range(len(pieces))])
        self.b_bytes = [bytes([int(p[3:5], 16)]) if own else p.replace(MARK, " ").encode() for p, own in zip(pieces, self.fallback)]
        self.side_a, self.side_b = Side(self.a_bytes), Side(self.b_bytes)
        # Ids with what may follow them: the next one of its side, the other side, a group, a chunk.
        self.ids = max(len(self.a_bytes), len(self.b_bytes))
        self.names = [f"{k}{sign}" for sign in ",|;\n" for k in range(self.ids)]
        self.mark = self.b.piece_to_id(MARK)
        self.known, self.index = Aligned(), Numbers()

    def settle(self) -> Aligned:
        """Align the chunks that got numbers since the last time."""
        new = self.index.names[len(self.known.names) :]
        if new:
            found = Aligned()
            for part in self.align(new):
                found.add(part)
            place = {name: k for k, name in enumerate(found.names)}
            self.known.add(found.taken(np.array([place[name] for name in new])))
        return self.known

    def forget(self, uses: np.ndarray) -> None:
        """Beyond REMEMBERED, keep those that the last block had more than once."""
        if len(self.index) > REMEMBERED:
            rows = np.flatnonzero(uses > 1)
            self.known = self.known.taken(rows[np.argsort(-uses[rows], kind="stable")[: REMEMBERED // 2]])
            self.index = Numbers(self.known.names)

    def align(self, chunks: list[str]) -> Iterator[Aligned]:
        """Align distinct chunks; those that can stand side by side are encoded together."""
        clean = [c for c in chunks if c and not c[0].isspace() and not c[-1].isspace() and MARK not in c]
        odd = [c for c in chunks if not c or c[0].isspace() or c[-1].isspace() or MARK in c]
        together = [clean[k : k + TOGETHER] for k in range(0, len(clean), TOGETHER)]
        for begin in range(0, len(together), 64):
            yield from self._encoded(together[begin : begin + 64])
        for begin in range(0, len(odd), 1024):
            yield from self._encoded([[c] for c in odd[begin : begin + 1024]])

    def _encoded(self, groups: list[list[str]]) -> Iterator[Aligned]:
        """Encode texts of chunks each; texts whose tokens do not have the text's bytes go one by one."""
        texts = [" ".join(group) for group in groups]
        data = [f" {text}".encode() for text in texts]
        sizes = np.array([len(d) for d in data], np.int64)
        found_a = self.a.encode_batch([" " + t for t in texts], add_special_tokens=False)
        found_b = [proto.pieces for proto in self.b.encode(texts, return_type="proto", num_threads=1)]
        list_a = [found.ids for found in found_a]
        list_b = [[p.id for p in pieces] if text else [self.mark] for pieces, text in zip(found_b, texts)]
        ends_b = [[p.end for p in pieces] if text else [0] for pieces, text in zip(found_b, texts)]
        ids_a, ids_b = flat(list_a), flat(list_b)
        count_a, count_b = (np.array([len(x) for x in own], np.int64) for own in (list_a, list_b))
        text = np.frombuffer(b"".join(data), np.uint8)
        good = same_bytes(text, sizes, self.side_a, ids_a, count_a) & same_bytes(text, sizes, self.side_b, ids_b, count_b)
        if good.all():
            spans_a = flat(chain.from_iterable(found.offsets for found in found_a)).reshape(-1, 2)
            yield self._cut(groups, text, sizes, ids_a, count_a, spans_a, ids_b, count_b, flat(ends_b) + 1)
        elif len(groups) > 1 or len(groups[0]) > 1:
            yield from self._encoded([group for group, fits in zip(groups, good) if fits]) if good.any() else ()
            for group in (group for group, fits in zip(groups, good) if not fits):
                for chunk in group:
                    yield from self._encoded([[chunk]])
        else:
            yield Aligned(groups[0], np.zeros((1, 4), np.int32), np.zeros(1, bool), [""])

    def _cut(self, texts, data, sizes, ids_a, count_a, spans_a, ids_b, count_b, coarse_b) -> Aligned:
        """Groups and links of texts whose tokens have the texts' bytes, all texts side by side.

        Spans and ends count from their own text: characters for A, bytes for B.
        """
        starts = np.cumsum(sizes) - sizes
        letters = np.append(np.flatnonzero((data & 0xC0) != 0x80), len(data))  # where each character begins
        spans = letters[spans_a + np.repeat(np.searchsorted(letters, starts), count_a)[:, None]]
        end_a = refined(spans[:, 0], spans[:, 1], self.side_a.sizes[ids_a], np.zeros(len(ids_a), bool))
        coarse_b = coarse_b + np.repeat(starts, count_b)
        begin_b = np.append(0, coarse_b[:-1])  # pieces follow each other
        end_b = refined(begin_b, coarse_b, self.side_b.sizes[ids_b], self.fallback[ids_b])
        if not (np.array_equal(end_a, np.cumsum(self.side_a.sizes[ids_a])) and np.array_equal(end_b, np.cumsum(self.side_b.sizes[ids_b]))):
            raise ValueError("spans of tokens contradict their bytes")

        names = [c for group in texts for c in group]
        edges = np.cumsum([len(c.encode()) + 1 for c in names])
        links, cuts = np.union1d(end_a, end_b), np.intersect1d(end_a, end_b, assume_unique=True)
        last = np.searchsorted(cuts, edges)
        if not np.array_equal(cuts[np.minimum(last, len(cuts) - 1)], edges):
            raise ValueError("a token goes over the space between two chunks")
        codes = (ids_a[np.searchsorted(end_a, links)] << 32) | ids_b[np.searchsorted(end_b, links)]
        counts = [np.diff(np.searchsorted(ends, edges, side="right"), prepend=0) for ends in (end_a, end_b, cuts, links)]

        # Ids in the order of groups, A before B, each with the sign that follows it.
        group_a, group_b = np.searchsorted(cuts, end_a), np.searchsorted(cuts, end_b)
        stop_a, stop_b = np.searchsorted(end_a, cuts, side="right"), np.searchsorted(end_b, cuts, side="right")
        after = np.full(len(cuts), 2)
        after[last] = 3
        item = np.empty(len(ids_a) + len(ids_b), np.int64)
        closes_a, closes_b = np.zeros(len(ids_a), np.int64), np.zeros(len(ids_b), np.int64)
        closes_a[stop_a - 1], closes_b[stop_b - 1] = 1, after
        item[np.arange(len(ids_a)) + np.append(0, stop_b[:-1])[group_a]] = closes_a * self.ids + ids_a
        item[np.arange(len(ids_b)) + stop_a[group_b]] = closes_b * self.ids + ids_b
        groups = "".join([self.names[k] for k in item.tolist()]).split("\n")[:-1]
        return Aligned(names, np.stack(counts, 1), np.ones(len(names), bool), groups, codes)


def flat(lists: Iterable) -> np.ndarray:
    return np.fromiter(chain.from_iterable(lists), np.int64)


def same_bytes(text: np.ndarray, sizes: np.ndarray, side: Side, ids: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Whether the tokens of each text, `counts` of them, have its bytes."""
    ends = np.append(0, np.cumsum(side.sizes[ids]))[np.cumsum(counts)]
    spelt, stops = side.spell(ids), np.cumsum(sizes)
    if np.array_equal(ends, stops) and np.array_equal(spelt, text):
        return np.ones(len(sizes), bool)
    begins, starts = np.append(0, ends[:-1]), stops - sizes
    return np.array([np.array_equal(spelt[a:b], text[c:d]) for a, b, c, d in zip(begins, ends, starts, stops)])


_aligners: dict[tuple[str, str], Aligner] = {}


def aligner(a_path: str, b_path: str) -> Aligner:
    key = (a_path, b_path)
    if key not in _aligners:
        _aligners[key] = Aligner(a_path, b_path)
    return _aligners[key]


def planes(numbers: np.ndarray, width: int) -> list[np.ndarray]:
    """The bytes of numbers, lowest first, each byte's place together: packs well."""
    return list(np.ascontiguousarray(numbers.astype(f"<u{width}")).view(np.uint8).reshape(-1, width).T) if len(numbers) else [np.zeros(0, np.uint8)] * width


def joined(parts: list[bytes]) -> np.ndarray:
    return np.stack([np.frombuffer(p, np.uint8) for p in parts], 1).reshape(-1).view(f"<u{len(parts)}").astype(np.int64)


class Block:
    """Documents whose pairs are counted together."""

    def __init__(self, align: Aligner, report: Callable[[str], str]):
        self.align, self.report = align, report
        self.docs, self.valid, self.chunks, self.bytes = [], [], [], 0

    def add(self, docs: list, texts: list[str | None]) -> None:
        number = self.align.index.__getitem__
        for doc, text in zip(docs, texts):
            own = chunks_of(text) if text else []
            self.docs.append(doc or 0)
            self.valid.append(doc is not None)
            self.chunks.append(np.fromiter(map(number, own), np.int32, len(own)))

    def row(self) -> pa.RecordBatch:
        """The block's pairs with their uses, and per document all but what the counts are needed for."""
        known = self.align.settle()
        good = np.array([known.good[own].all() for own in self.chunks], bool)
        numbers = np.array([known.numbers[own].sum(0, dtype=np.int64) if whole else [0] * 4 for own, whole in zip(self.chunks, good.tolist())], np.int64)
        reports = [
            self.report(";".join([known.groups[c] for c in own.tolist()])) if whole and len(own) else ""
            for own, whole in zip(self.chunks, good.tolist())
        ]
        codes, pair_of = np.unique(known.codes, return_inverse=True)
        uses, held, pairs, weights = np.zeros(len(codes), np.int64), [], [], []
        own = [chunks if whole else chunks[:0] for chunks, whole in zip(self.chunks, good.tolist())]
        for begin, stop in runs([len(c) for c in own], PAIRED):
            part = self._pairs_of(own[begin:stop], pair_of.astype(np.int32))
            held.append(part[0])
            pairs.append(part[1])
            weights.append(part[2])
            uses += np.bincount(part[1], minlength=len(codes))
        number = np.cumsum(uses > 0) - 1
        held, pair, weight = (np.concatenate([*x, np.zeros(0, np.int64)]) for x in (held or [np.zeros(len(own), np.int64)], pairs, weights))
        pair = number[pair.astype(np.int64)]
        codes, uses = codes[uses > 0], uses[uses > 0]
        # Pairs of a document are numbered upwards: differences are small.
        step, first = np.diff(pair, prepend=0), (np.cumsum(held) - held).astype(np.int64)[held > 0]
        step[first] = pair[first]
        payload = pack(
            np.array(self.docs, np.int64), np.array(self.valid, bool), numbers, held.astype(np.uint32), "\n".join(reports).encode(),
            *planes(step, 4), *planes(weight, 4),
        )
        self.align.forget(np.bincount(np.concatenate([*self.chunks, np.zeros(0, np.int32)]), minlength=len(known.names)))
        parts = (pa.array([uuid.uuid4().hex]), *(pa.array([p], pa.binary()) for p in (codes.tobytes(), uses.tobytes(), payload)))
        return pa.RecordBatch.from_arrays(list(parts), names=["block", "codes", "uses", "payload"])

    def _pairs_of(self, chunks: list[np.ndarray], pair_of: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """How many pairs each document holds, those pairs in order, and the number of their links."""
        known, links = self.align.known, self.align.known.numbers[:, 3]
        doc = np.repeat(np.arange(len(chunks)), [len(c) for c in chunks])
        # Distinct (document, chunk) with their number, then distinct (document, pair) with theirs.
        key, times = np.unique(doc * len(known.names) + np.concatenate(chunks), return_counts=True)
        doc, chunk = np.divmod(key, len(known.names))
        many = max(int(pair_of.max(initial=0)), 0) + 1
        key = np.repeat(doc * many, links[chunk]) + pair_of[spread(known.ends() - links, links, chunk)]
        order = np.argsort(key)
        key, weight = key[order], np.repeat(times, links[chunk])[order]
        first = np.flatnonzero(np.diff(key, prepend=-1))
        doc, pair = np.divmod(key[first], many)
        return np.bincount(doc, minlength=len(chunks)), pair, np.add.reduceat(weight, first) if len(first) else weight


def runs(sizes: list[int], most: int) -> Iterator[tuple[int, int]]:
    """Ranges of neighbours with about `most` in all, which cover all; what is larger stands alone.

    No range is empty: where all sizes are 0 there are none.
    """
    begin = total = 0
    for k, size in enumerate(sizes):
        if total and total + size > most:
            yield begin, k
            begin, total = k, 0
        total += size
    if total:
        yield begin, len(sizes)


def _align(batches, a_path: str, b_path: str, report: Callable[[str], str], block_bytes: int):
    align = aligner(a_path, b_path)
    block = Block(align, report)
    for batch in batches:
        for piece in slices(batch, most=1 << 20):
            block.add(piece.column("doc_id").to_pylist(), piece.column("text").to_pylist())
            block.bytes += piece.nbytes
            if block.bytes >= block_bytes:
                yield block.row()
                block = Block(align, report)
    if block.docs:
        yield block.row()


def _pairs(batches):
    """Rows (block, code, uses) of packed blocks."""
    for batch in batches:
        for block, codes, uses in zip(*(batch.column(c) for c in ("block", "codes", "uses"))):
            codes, uses = np.frombuffer(codes.as_py(), np.int64), np.frombuffer(uses.as_py(), np.int64)
            for begin in range(0, len(codes), 1 << 16):
                some = slice(begin, begin + (1 << 16))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([block.as_py()] * len(codes[some])), pa.array(codes[some]), pa.array(uses[some])], names=["block", "code", "uses"]
                )


def _finish(block: pa.Table, counts: pa.Table) -> pa.Table:
    """Documents of a block, with the sums of their pairs' counts."""
    out = []
    codes, n, best = (counts.column(c).to_numpy() for c in ("code", "n_docs", "best"))
    order = np.argsort(codes)
    n, best = n[order], best[order].astype(np.int64)
    for row in block.to_pylist():
        docs, valid, numbers, held, reports, *parts = unpack(row["payload"])
        docs, valid, held = np.frombuffer(docs, np.int64), np.frombuffer(valid, bool), np.frombuffer(held, np.uint32).astype(np.int64)
        numbers = np.frombuffer(numbers, np.int64).reshape(-1, 4)
        step, weight = joined(parts[:4]), joined(parts[4:])
        doc = np.repeat(np.arange(len(docs)), held)
        # Numbers start anew in each document: take off what all before have added up to.
        pair = np.cumsum(step)
        before = np.where(np.cumsum(held) > held, pair[np.cumsum(held) - held - 1], 0) if len(pair) else np.zeros(len(docs), np.int64)
        pair = pair - before[doc]
        if len(pair) and len(codes) != pair.max() + 1:
            raise ValueError("a block's counts are not those of its pairs")
        sums = [np.zeros(len(docs), np.int64) for _ in range(2)]
        for total, value in zip(sums, (best, n)):
            np.add.at(total, doc, weight * value[pair]) if len(pair) else None
        out.append(pa.table({
            "doc_id": pa.array(docs, pa.int64(), mask=~valid), **{name: pa.array(numbers[:, k]) for k, name in enumerate(NUMBERS)},
            "n_best": pa.array(sums[0]), "count_sum": pa.array(sums[1]), "groups": pa.array(reports.decode().split("\n"), pa.string()),
        }))
    return pa.concat_tables(out)


ALIGNED = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups string"


def whole(groups: str) -> str:
    return groups


def align_tokens(
    docs: DataFrame, a_path: str, b_path: str, report: Callable[[str], str] = whole, block_bytes: int = BLOCK_BYTES,
    id_column: str = "doc_id", text_column: str = "text",
) -> tuple[DataFrame, DataFrame]:
    """Alignment of each document, and the corpus-wide pairs (a, b, n_docs, best).

    Per row of `docs`: doc_id, n_a, n_b, n_groups, n_links, n_best (links whose pair has its A id's
    highest count), count_sum (counts over links), groups: what `report` makes of the groups as text
    ("a1,a2|b1;a3|b2", decimal ids in order), without line breaks. n_docs is the number of documents
    that hold the pair linked; `best` marks each A id's highest, ties included.

    Null and empty texts, and those whose tokens on either side do not have the text's bytes (a
    marker U+2581 in the text), have no tokens: zeros and ''. Special tokens' strings are plain text.
    Repeated rows count as documents of their own. A very long text is a block of its own. No rows
    give no rows. Other columns are ignored.
    """
    scratch = Scratch(docs.sparkSession, "alignment")
    rows = docs.select(F.col(f"`{id_column}`").cast("long").alias("doc_id"), F.col(f"`{text_column}`").cast("string").alias("text"))
    blocks = scratch.keep(rows.mapInArrow(lambda batches: _align(batches, a_path, b_path, report, block_bytes), BLOCKS), "blocks")
    pairs = blocks.select("block", "codes", "uses").mapInArrow(_pairs, "block string, code long, uses long")
    counts = pairs.groupBy("code").agg(F.sum("uses").alias("n_docs"))
    counts = scratch.keep(counts.withColumn("a", F.shiftright("code", 32)), "counts")
    # Broadcast: a row per id of A's vocabulary at most.
    highest = F.broadcast(counts.groupBy("a").agg(F.max("n_docs").alias("highest")))
    counts = counts.join(highest, "a").withColumn("best", F.col("n_docs") == F.col("highest"))
    back = pairs.select("block", "code").join(counts.select("code", "n_docs", "best"), "code")
    own = blocks.select("block", "payload").groupBy("block")
    found = own.cogroup(back.groupBy("block")).applyInArrow(_finish, ALIGNED)
    table = counts.select(F.col("a").cast("int").alias("a"), F.expr("cast(code & 4294967295 as int)").alias("b"), "n_docs", "best")
    return found, table
