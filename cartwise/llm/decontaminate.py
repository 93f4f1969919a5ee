"""Benchmark decontamination: rare n-gram seeds, then Smith-Waterman alignment.

Words are letters and digits, A-Z in lower case. The runs of three words of all benchmark
items are counted over the whole corpus. Of every two neighbouring runs of an item the
rarer one is a seed, so any four words in a row that a passage copies hold a seed, however
common the passage is. Seeds found in a document mark windows around the place where the
item would lie; a local alignment of words (match 1, mismatch and gap -1) scores each
window. The score is the best alignment divided by the number of words of the item:
1 for a copy, lower with every edit.

The benchmark is the query set: it is cut into blocks of bounded bytes, each sent to all
tasks and compared with every document in one pass.

Rows: every row of documents and of the benchmark counts by itself, repeated ones too. Null
and empty texts, and items with fewer than three words, match nothing. Empty tables: no
rows. Other columns of the inputs are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartwise.llm import text as tx
from cartwise.llm.ship import ship

RUN = 3
NEIGHBOURS = 2
LEAST_SCORE = 0.5
BLOCK_BYTES = 8 << 20
#: Words beside an item's place in which its alignment may drift.
SLACK = 8
STACK = 256


@dataclass
class Block:
    """Items with their word hashes; runs as (sorted codes, items, offsets)."""

    item_ids: pa.Array
    words: list[np.ndarray]
    codes: np.ndarray
    items: np.ndarray
    offsets: np.ndarray

    def keep(self, chosen: np.ndarray) -> "Block":
        return Block(self.item_ids, self.words, self.codes[chosen], self.items[chosen], self.offsets[chosen])


def _hashed(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    starts, ends, before = tx.words_at(data, at, tx.ALNUM)
    return tx.word_hashes(data, starts, ends), before


def make_block(item_ids: pa.Array, texts: pa.Array) -> Block:
    data, at = tx.raw(texts)
    hashes, before = _hashed(tx.LOWER[data], at)
    codes, runs = tx.shingles(hashes, before, RUN)
    items = np.repeat(np.arange(len(item_ids)), np.diff(runs))
    offsets = np.arange(len(codes)) - runs[items]
    long = np.diff(before)[items] >= RUN
    codes, items, offsets = codes[long], items[long], offsets[long]
    order = np.lexsort((offsets, items, codes))
    words = [hashes[a:b] for a, b in zip(before[:-1], before[1:])]
    return Block(item_ids, words, codes[order], items[order], offsets[order])


def choose_seeds(block: Block, seen: dict[int, int]) -> Block:
    """Of each ``NEIGHBOURS`` runs in a row the one seen least in the corpus."""
    rarity = np.array([seen.get(int(c), 0) for c in block.codes], np.int64)
    order = np.lexsort((block.offsets, block.items))
    chosen = np.zeros(len(order), bool)
    items, counts = block.items[order], rarity[order]
    for first in range(len(order)):
        last = first
        while last + 1 < len(order) and last - first + 1 < NEIGHBOURS and items[last + 1] == items[first]:
            last += 1
        if last - first + 1 == NEIGHBOURS or first == 0 or items[first - 1] != items[first]:
            chosen[order[first + int(np.argmin(counts[first : last + 1]))]] = True
    return block.keep(chosen)


def _door(codes: np.ndarray) -> np.ndarray:
    door = np.zeros(1 << 20, bool)
    door[codes & np.uint64((1 << 20) - 1)] = True
    return door


def _seen_batches(codes: np.ndarray):
    """Counts of the given sorted codes in the texts of a task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        door, total = _door(codes), np.zeros(len(codes), np.int64)
        for batch in batches:
            for _, _, data, at in tx.pieces(batch["text"]):
                found, _ = tx.shingles(*_hashed(tx.LOWER[data], at), RUN)
                found = found[door[found & np.uint64((1 << 20) - 1)]]
                place = np.minimum(np.searchsorted(codes, found), len(codes) - 1)
                total += np.bincount(place[codes[place] == found], minlength=len(codes))
        has = total > 0
        yield pa.RecordBatch.from_pydict({"code": pa.array(codes[has].view(np.int64)), "n": pa.array(total[has])})

    return run


def align(item: np.ndarray, windows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Best local alignment score and end (exclusive) in each row of ``windows``."""
    width = windows.shape[1]
    column = np.arange(1, width + 1)
    above = np.zeros((len(windows), width + 1), np.int32)
    best, end = np.zeros(len(windows), np.int32), np.zeros(len(windows), np.int64)
    for word in item:
        now = np.maximum(0, np.maximum(above[:, :-1] + np.where(windows == word, 1, -1), above[:, 1:] - 1))
        # Gaps along the row: the best earlier cell less its distance.
        now = np.maximum.accumulate(now + column, axis=1) - column
        above[:, 1:] = now
        place = now.argmax(axis=1)
        value = now[np.arange(len(now)), place]
        better = value > best
        best[better], end[better] = value[better], place[better] + 1
    return best, end


def _windows(rows: np.ndarray, items: np.ndarray, places: np.ndarray, sizes: np.ndarray, counts: np.ndarray):
    """(row, item, low, high) of merged windows around the places items would start at."""
    low = np.maximum(0, places - SLACK - sizes[items] // 4)
    high = np.minimum(counts[rows], places + sizes[items] + SLACK + sizes[items] // 4)
    order = np.lexsort((low, items, rows))
    rows, items, low, high = rows[order], items[order], low[order], high[order]
    if not len(rows):
        return rows, items, low, high
    pair = np.r_[0, np.cumsum((rows[1:] != rows[:-1]) | (items[1:] != items[:-1]))]
    # Windows of one pair that overlap are one window; offsets keep pairs apart.
    span = int(high.max()) + 1
    reach = np.maximum.accumulate(high + pair * span)
    new = np.r_[True, low[1:] + pair[1:] * span > reach[:-1]]
    first = np.flatnonzero(new)
    return rows[first], items[first], low[first], np.maximum.reduceat(high, first)


def matches(block: Block, texts: pa.Array, least: float) -> Iterator[tuple[int, int, float, int, int]]:
    """(row, item, score, start word, end word) of the best match of each row and item."""
    if not len(block.codes):
        return
    door = _door(block.codes)
    sizes = np.array([len(w) for w in block.words])
    for first, end, data, at in tx.pieces(texts):
        hashes, before = _hashed(tx.LOWER[data], at)
        codes, runs = tx.shingles(hashes, before, RUN)
        near = np.flatnonzero(door[codes & np.uint64((1 << 20) - 1)])
        lo = np.searchsorted(block.codes, codes[near], "left")
        hi = np.searchsorted(block.codes, codes[near], "right")
        near, lo, hi = near[hi > lo], lo[hi > lo], hi[hi > lo]
        if not len(near):
            continue
        entry = np.concatenate([np.arange(a, b) for a, b in zip(lo, hi)])
        at_run = np.repeat(near, hi - lo)
        row = np.searchsorted(runs, at_run, "right") - 1
        place = at_run - runs[row] - block.offsets[entry]
        counts = np.diff(before)
        row, item, low, high = _windows(row, block.items[entry], place, sizes, counts)
        width = high - low
        best: dict[tuple[int, int], tuple[float, int, int]] = {}
        order = np.lexsort((width, item))
        for k in range(0, len(order), 1):
            if k and item[order[k]] == item[order[k - 1]] and k % STACK:
                continue
            own = order[k : k + STACK - k % STACK]
            own = own[item[own] == item[own[0]]]
            words = block.words[item[own[0]]]
            limit = int(width[own].max())
            stack = np.zeros((len(own), limit), np.uint64)
            inside = np.arange(limit) < width[own][:, None]
            source = (before[row[own]] + low[own])[:, None] + np.arange(limit)
            stack[inside] = hashes[source[inside]]
            score, stop = align(words, stack)
            good = np.flatnonzero(score >= least * len(words))
            if not len(good):
                continue
            # Only matches look for their start: the same alignment read backwards.
            for g in good:
                part = stack[g : g + 1, : stop[g]][:, ::-1]
                _, back = align(words[::-1], part)
                key = (int(row[own[g]]), int(item[own[g]]))
                start = int(low[own[g]] + stop[g] - back[0])
                found = (float(score[g]) / len(words), -start, int(low[own[g]] + stop[g]))
                if found > best.get(key, (0.0, 0, 0)):
                    best[key] = found
        for (r, i), (value, start, stop) in sorted(best.items()):
            yield first + r, i, value, -start, stop


def blocks(docs: DataFrame, benchmark: DataFrame, block_bytes: int = BLOCK_BYTES) -> Iterator[Block]:
    """Blocks of the benchmark with their seeds chosen by counts over all documents."""
    ship(docs.sparkSession)
    items = benchmark.where("text is not null").select("item_id", "text")
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = -(-size // block_bytes)
    for k in range(parts):
        own = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(parts)) == k).orderBy("item_id", "text").toArrow()
        if not own.num_rows:
            continue
        block = make_block(own["item_id"].combine_chunks(), own["text"].combine_chunks())
        if not len(block.codes):
            continue
        counted = (
            docs.select("text").mapInArrow(_seen_batches(np.unique(block.codes)), "code long, n long")
            .groupBy("code").agg(F.sum("n").alias("n")).toArrow()
        )
        seen = dict(zip(counted["code"].to_numpy().astype(np.uint64).tolist(), counted["n"].to_pylist()))
        yield choose_seeds(block, seen)


def find_leaks(docs: DataFrame, benchmark: DataFrame, least_score: float = LEAST_SCORE) -> DataFrame:
    """doc_id, item_id, score and the words [start_word, end_word) of every match."""
    spark = docs.sparkSession
    id_type = docs.schema["doc_id"].dataType.simpleString()
    item_type = benchmark.schema["item_id"].dataType.simpleString()
    schema = f"doc_id {id_type}, item_id {item_type}, score double, start_word long, end_word long"
    out = spark.createDataFrame([], schema)
    for block in blocks(docs, benchmark):
        out = out.unionByName(docs.select("doc_id", "text").mapInArrow(_leak_batches(block, least_score), schema))
    return out


def _leak_batches(block: Block, least_score: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = list(matches(block, batch["text"], least_score))
            if found:
                row, item, score, start, stop = zip(*found)
                yield pa.RecordBatch.from_pydict(
                    {
                        "doc_id": batch["doc_id"].take(pa.array(row)),
                        "item_id": block.item_ids.take(pa.array(item)),
                        "score": pa.array(score, pa.float64()),
                        "start_word": pa.array(start, pa.int64()),
                        "end_word": pa.array(stop, pa.int64()),
                    }
                )

    return run


def drop_leaks(docs: DataFrame, benchmark: DataFrame, least_score: float = LEAST_SCORE) -> DataFrame:
    """The documents without a match, with all their columns."""
    kept = docs
    for block in blocks(docs, benchmark):
        kept = kept.where(~_leak_flag(block, least_score)("text"))
    return kept


def _leak_flag(block: Block, least_score: float):
    def flag(texts: pa.Array) -> pa.Array:
        flags = np.zeros(len(texts), bool)
        for row, *_ in matches(block, texts, least_score):
            flags[row] = True
        return pa.array(flags)

    return F.arrow_udf(flag, "boolean")
