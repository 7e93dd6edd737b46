"""Long repeated word sequences by recompression.

A text's words are renamed in rounds: runs of one symbol become a symbol, then pairs do whose left
symbol falls into one half of all symbols and the right one into the other. Names are hashes of
what they stand for, so they are global without any exchange: equal sequences get equal symbols in
their interior, and only what lies near their ends can differ. For every symbol it is known how far
its making depended on its surroundings.

1. Symbols that stand for at least a window of words and occur twice, by their names and a second
   hash of those words, verify a long repeat at once.
2. Every window has a middle word, and that word a highest symbol that depends on nothing outside of
   the window. The symbol, with the words that all windows around it share, is the same wherever
   the window occurs. Spark counts these; where one occurs twice, its windows may repeat.
3. Windows of such places are compared as a whole, unless all places are verified already.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlens.llm.scratch import Scratch
from marketlens.llm.words import ODD, Words, mixed, slices, windows

WIDTH = 50
#: Rounds in which runs are named; every round names pairs.
RUN_EVERY = 3
MOST_ROUNDS = 96
#: A verifying symbol is reported when it is the first to reach width times a power of this.
GROWTH = 4
#: Bytes of text whose symbols are held at once.
SLICE_BYTES = 1 << 20
#: Odd numbers that hashes of word ranges are taken to.
BASE, CHECK_BASE = 0xD1342543DE82EF95, 0xAEF17502108EF2D9


class Symbols:
    """The current symbols of some texts, side by side: names, spans of words, what they depend on."""

    def __init__(self, hashes: np.ndarray, first: np.ndarray):
        n = len(hashes)
        self.name, self.begin = hashes.copy(), np.arange(n, dtype=np.int64)
        self.end, self.low, self.high = self.begin + 1, self.begin.copy(), self.begin + 1
        counts = np.diff(first)
        self.text = np.repeat(np.arange(len(counts)), counts)
        self.text_begin, self.text_end = first[:-1].astype(np.int64), first[1:].astype(np.int64)

    def __len__(self) -> int:
        return len(self.name)

    def _take(self, group: np.ndarray, name: np.ndarray, low: np.ndarray, high: np.ndarray) -> None:
        """Symbols from `group` on, up to the next, become one."""
        last = np.append(group[1:], len(self.name)) - 1
        self.begin, self.end, self.text = self.begin[group], self.end[last], self.text[group]
        self.name, self.low, self.high = name, low, high

    def _beside(self) -> tuple[np.ndarray, np.ndarray]:
        """Low of each symbol's left neighbour and high of its right one; beyond the text at its ends."""
        alone = np.empty(len(self), bool)
        alone[0], alone[1:] = True, self.text[1:] != self.text[:-1]
        low = np.concatenate(([0], self.low[:-1]))
        low = np.where(alone, self.text_begin[self.text] - 1, low)
        ends = np.append(alone[1:], True)
        high = np.where(ends, self.text_end[self.text] + 1, np.append(self.high[1:], 0))
        return low, high

    def name_runs(self) -> None:
        new = np.ones(len(self), bool)
        new[1:] = (self.name[1:] != self.name[:-1]) | (self.text[1:] != self.text[:-1])
        group = np.flatnonzero(new)
        sizes = np.diff(np.append(group, len(self)))
        name = self.name[group]
        runs = sizes > 1
        name[runs] = mixed(name[runs] * ODD[11] + sizes[runs].astype(np.uint64) * ODD[12])
        # That a run ends where it does depends on what comes before and after it.
        low, high = self._beside()
        self._take(group, name, low[group], high[group + sizes - 1])

    def name_pairs(self, round_: int) -> None:
        left = mixed(self.name ^ ODD[round_ % 64] ^ np.uint64(round_)) & np.uint64(1) == 0
        pair = np.zeros(len(self), bool)
        pair[:-1] = left[:-1] & ~left[1:] & (self.text[1:] == self.text[:-1])
        second = np.concatenate(([False], pair[:-1]))
        beside_low, beside_high = self._beside()
        # A left symbol that stays alone depends on the next, a right one on the one before.
        low = np.where(left | second, self.low, np.minimum(self.low, beside_low))
        high = np.where(left & ~pair, np.maximum(self.high, beside_high), self.high)
        group = np.flatnonzero(~second)
        joined = pair[group]
        name = self.name[group]
        at = group[joined]
        name[joined] = mixed(self.name[at] * ODD[13] + mixed(self.name[at + 1] ^ ODD[14]) * ODD[15])
        high = high[group]
        high[joined] = self.high[at + 1]
        low = low[group]
        low[joined] = self.low[at]
        self._take(group, name, low, high)


def symbols_of(hashes: np.ndarray, first: np.ndarray, width: int):
    """Spans (name, text, begin, end, verifying) of some texts' words; begin and end count all words."""
    half = width // 2
    before, after = half, width - half  # of a middle word, itself in `after`
    chosen_begin, chosen_end = np.arange(len(hashes)), np.arange(len(hashes)) + 1
    out = []
    symbols, track = Symbols(hashes, first), True
    some_words = np.count_nonzero(np.diff(first))
    for round_ in range(MOST_ROUNDS):
        if len(symbols) <= some_words:  # every text that has words is one symbol
            break
        known = symbols.end - symbols.begin
        if round_ % RUN_EVERY == 0:
            symbols.name_runs()
            out.append(_grown(symbols, known, width))
            known = symbols.end - symbols.begin
        symbols.name_pairs(round_)
        out.append(_grown(symbols, known, width))
        if track:
            # Words whose window holds all that the symbol over them depends on.
            begin = np.maximum(symbols.begin, symbols.high - after)
            end = np.minimum(symbols.end, symbols.low + before + 1)
            some = np.flatnonzero(begin < end)
            track = len(some) > 0
            sizes = end[some] - begin[some]
            at = np.arange(int(sizes.sum())) - np.repeat(np.cumsum(sizes) - sizes, sizes) + np.repeat(begin[some], sizes)
            chosen_begin[at] = np.repeat(symbols.begin[some], sizes)
            chosen_end[at] = np.repeat(symbols.end[some], sizes)
    text = np.repeat(np.arange(len(first) - 1), np.diff(first))
    middle = np.arange(len(hashes))
    whole = (middle - before >= first[:-1][text]) & (middle + after <= first[1:][text]) if len(text) else np.empty(0, bool)
    new = whole.copy()
    new[1:] &= ~whole[:-1] | (chosen_begin[1:] != chosen_begin[:-1]) | (chosen_end[1:] != chosen_end[:-1])
    begin, end = chosen_begin[new], chosen_end[new]
    # What all windows around the symbol have in common: so many words before its last and after its first.
    name = _ranges(hashes, end - 1 - before, begin + after) + (end - begin).astype(np.uint64) * ODD[21]
    out.append((mixed(name), text[new], begin, end, np.zeros(len(begin), bool)))
    return [np.concatenate(parts) for parts in zip(*out)]


def _grown(symbols: Symbols, known: np.ndarray, width: int):
    """Symbols that are the first around their words to reach the next reported length."""
    size = symbols.end - symbols.begin
    if len(known) == len(size):
        return tuple(a[:0] for a in (symbols.name, symbols.text, symbols.begin, symbols.end, np.empty(0, bool)))
    # The largest part of each symbol, as it was before this step.
    starts = np.concatenate(([0], np.cumsum(known)))[:-1]
    part = np.maximum.reduceat(known, np.searchsorted(starts, np.concatenate(([0], np.cumsum(size)))[:-1]))
    level = lambda n: np.floor(np.log(np.maximum(n, 1) / width) / np.log(GROWTH))
    new = (size >= width) & ((part < width) | (level(size) > level(part)))
    return mixed(symbols.name[new] ^ ODD[22]), symbols.text[new], symbols.begin[new], symbols.end[new], np.ones(int(new.sum()), bool)


def _ranges(hashes: np.ndarray, begin: np.ndarray, end: np.ndarray, base: int = BASE) -> np.ndarray:
    """A hash of the words from `begin` up to `end`, for many ranges at once."""
    if not len(begin):
        return np.empty(0, np.uint64)
    # Sums of hash times base^place, moved to place 0 by the inverse base; all modulo 2^64.
    inverse = np.uint64(pow(base, -1, 1 << 64))
    n = len(hashes)
    up = np.cumprod(np.concatenate(([np.uint64(1)], np.full(n, np.uint64(base)))))
    down = np.cumprod(np.concatenate(([np.uint64(1)], np.full(n, inverse))))
    sums = np.concatenate(([np.uint64(0)], np.cumsum(mixed(hashes) * up[:-1])))
    return mixed((sums[end] - sums[begin]) * down[begin] + (end - begin).astype(np.uint64) * ODD[23])


def _symbols(batches, width: int):
    for batch in batches:
        for piece in slices(batch, most=SLICE_BYTES):
            words = Words(piece.column("text"))
            first, hashes = words.first.astype(np.int64), words.hashes()
            name, text, begin, end, verifying = symbols_of(hashes, first, width)
            row = piece.column("row").to_numpy()
            span = ((begin - first[:-1][text]) << 32) | ((end - begin) << 1) | verifying
            # What removes words by itself goes by a second hash too, of the words it stands for.
            check = np.zeros(len(name), np.uint64)
            check[verifying] = _ranges(hashes, begin[verifying], end[verifying], CHECK_BASE)
            for at in range(0, len(name), 1 << 16):
                some = slice(at, at + (1 << 16))
                yield pa.RecordBatch.from_pydict({
                    "name": name[some].view(np.int64), "check": check[some].view(np.int64), "row": row[text[some]], "span": span[some]
                })


def _merge_spans(batches):
    """Overlapping and adjoining verified spans of a row as few longest ones."""
    for batch in batches:
        rows, begins, ends = [], [], []
        for row, spans in zip(batch.column("row").to_pylist(), batch.column("spans")):
            spans = np.sort(spans.values.to_numpy())
            begin = spans >> 32
            end = np.maximum.accumulate(begin + ((spans & 0xFFFFFFFF) >> 1))
            new = np.concatenate(([True], begin[1:] > end[:-1]))
            rows.append(row)
            begins.append(begin[new].tolist())
            ends.append(end[np.append(np.flatnonzero(new)[1:] - 1, len(end) - 1)].tolist())
        yield pa.RecordBatch.from_pydict({
            "row": pa.array(rows, pa.int64()), "begins": pa.array(begins, pa.list_(pa.int64())), "ends": pa.array(ends, pa.list_(pa.int64()))
        })


def _windows(batches, width: int):
    """128-bit hashes of the windows whose middle words are in a row's spans."""
    for batch in batches:
        for piece in slices(batch):
            words = Words(piece.column("text"))
            hashes, first = words.hashes(), words.first
            h1, h2 = windows(hashes, width), windows(hashes, width, seed=3)
            row = piece.column("row").to_numpy()
            starts, owners = [], []
            for k, spans in enumerate(piece.column("spans")):
                spans = spans.values.to_numpy()
                n = int(first[k + 1] - first[k])
                begin = spans >> 32
                size = (spans & 0xFFFFFFFF) >> 1
                at = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size) + np.repeat(begin, size) - width // 2
                at = np.unique(at[(at >= 0) & (at + width <= n)])
                starts.append(at)
                owners.append(np.full(len(at), k))
            start, owner = np.concatenate(starts), np.concatenate(owners)
            at = start + first[:-1][owner]
            yield pa.RecordBatch.from_pydict({
                "h1": h1[at].view(np.int64), "h2": h2[at].view(np.int64), "row": row[owner], "start": start.astype(np.int32)
            })


def _remove(batches, width: int):
    """Texts without covered words: words joined by one space."""
    for batch in batches:
        for piece in slices(batch):
            words = Words(piece.column("text"))
            n_words, n_removed, kept = [], [], []
            data = words.data.tobytes()
            for k, (begins, ends, starts) in enumerate(zip(piece.column("begins"), piece.column("ends"), piece.column("starts"))):
                low, high = int(words.first[k]), int(words.first[k + 1])
                edge = np.zeros(high - low + 1, np.int64)
                if begins.is_valid:
                    np.add.at(edge, begins.values.to_numpy(), 1)
                    np.add.at(edge, ends.values.to_numpy(), -1)
                if starts.is_valid:
                    own = starts.values.to_numpy()
                    np.add.at(edge, own, 1)
                    np.add.at(edge, own + width, -1)
                keep = np.cumsum(edge)[:-1] == 0
                left = np.flatnonzero(keep) + low
                n_words.append(high - low)
                n_removed.append(high - low - len(left))
                kept.append(b" ".join([data[a:b] for a, b in zip(words.begin[left].tolist(), words.end[left].tolist())]))
            yield pa.RecordBatch.from_pydict({
                "doc_id": piece.column("doc_id"), "mark": piece.column("row"), "n_words": pa.array(n_words, pa.int64()),
                "n_removed": pa.array(n_removed, pa.int64()), "kept": pa.array(kept, pa.binary()).cast(pa.string()),
            })


def remove_repeats(docs: DataFrame, width: int = WIDTH, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(doc_id, mark, n_words, n_removed, kept) per row of `docs`.

    Words are runs of bytes other than ASCII white space. A word goes if a window of `width` words
    over it has a sequence that also begins anywhere else, in the same text or another; windows are
    judged on the texts as they come. `kept` is what is left, joined by single spaces. Null and
    empty texts have no words. Each row counts, so repeated rows of enough words lose them all. Null
    ids are kept; `mark` is a hash of id and text. Other columns are ignored, no rows give no rows.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "repeats")
    text = F.coalesce(F.col(f"`{text_column}`").cast("string"), F.lit(""))
    number = F.col(f"`{id_column}`").cast("long")
    docs = docs.select(number.alias("doc_id"), text.alias("text"), F.xxhash64(F.coalesce(number, F.lit(-(2**62))), text).alias("row"))
    names = scratch.keep(docs.mapInArrow(lambda b: _symbols(b, width), "name long, check long, row long, span long"), "names")
    again = names.groupBy("name", "check").agg(F.count(F.lit(1)).alias("uses")).where("uses > 1").select("name", "check")
    shared = scratch.keep(names.join(again.hint("merge"), ["name", "check"], "left_semi").drop("check"), "shared")
    scratch.drop("names")
    verified = shared.where("span % 2 = 1").groupBy("row").agg(F.collect_set("span").alias("spans"))
    verified = scratch.keep(verified.mapInArrow(_merge_spans, "row long, begins array<long>, ends array<long>"), "verified")
    places = shared.where("span % 2 = 0").join(verified.hint("merge"), "row", "left").withColumn("begin", F.expr("shiftright(span, 32)"))
    low, high = F.greatest(F.col("begin") - width // 2, F.lit(0)), F.col("begin") + F.expr("shiftright(span & 4294967295, 1)") - 1 + (width - width // 2)
    inside = F.exists(F.arrays_zip("begins", "ends"), lambda s: (s["begins"] <= low) & (s["ends"] >= high))
    places = scratch.keep(places.select("name", "row", "span", (~F.coalesce(inside, F.lit(False))).alias("open")), "places")
    # A place that is verified is compared only where the same name stands at one that is not.
    some_open = places.where("open").select("name").distinct()
    spans = places.join(some_open.hint("merge"), "name", "left_semi").groupBy("row").agg(F.collect_set("span").alias("spans"))
    spans = scratch.keep(spans, "spans")
    scratch.drop("shared", "places")
    compared = docs.select("row", "text").join(spans.hint("merge"), "row").mapInArrow(lambda b: _windows(b, width), "h1 long, h2 long, row long, start int")
    compared = scratch.keep(compared, "windows")
    twice = compared.groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("uses")).where("uses > 1").select("h1", "h2")
    starts = compared.join(twice.hint("merge"), ["h1", "h2"], "left_semi").groupBy("row").agg(F.collect_set("start").alias("starts"))
    found = scratch.keep(verified.join(starts.hint("merge"), "row", "full_outer"), "found")
    scratch.drop("windows", "spans", "verified")
    rows = docs.join(found.hint("merge"), "row", "left").select("doc_id", "row", "text", "begins", "ends", "starts")
    return rows.mapInArrow(lambda b: _remove(b, width), "doc_id long, mark long, n_words long, n_removed long, kept string")
