"""Runs: maximal stretches of words that repeat with a smallest period, and their removal.

A run of period q is a stretch whose words q apart are alike, at least ``max(12, 2q)`` long,
with no smaller period and no neighbouring word that goes on with it. Where words q apart
match, positions form intervals; a run is an interval of at least ``max(q, 12 - q)`` of them.

Periods are taken by octaves, P <= q < 2P. A document is exploded into tiles that grow with
the octave: up to ``TILE`` words one tile serves all octaves, beyond that octave P has cores
of 8P words of its own, each with 2P words before and 4P after it. Inside a tile boundaries
stand so close that every interval of the octave spans one with ``block`` matches behind it.
A boundary's Z-functions give for each lag q how far the words match from there on and from
there back: lags whose next ``block`` words differ have too short a Z to matter, the others are
measured by halving steps over fingerprints of 1, 2, 4, ... words. Lags that are multiples of a
smaller period are told by the same fingerprints on the q words after the boundary. So a tile
is solved alone, in n log n, and yields fragments (period, start, end) of intervals. Documents
of one tile are solved where they are read, short ones several at a time; the tiles of longer ones are dealt to all tasks.
Fragments are shuffled by document and period, and those that overlap or touch are stitched.
Fingerprints have 64 bits; equal ones count as equal words.

Rows are known by two 64-bit hashes of id and text, as the runs of equal rows are the same;
each row keeps its own result. Null and empty texts have no words: no runs, four nulls, the
digests of the empty text. A null id is never rewritten by ``planted`` (it has no crc32).
Ties for the longest run: smallest start, then period. Empty table: no rows. Very long texts
are read whole, with memory for one text's words and one tile in a task. Other columns are
ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cartwise.llm import text as tx
from cartwise.llm.ship import ship

LEAST = 12
#: Words of the largest document that is one tile, and of the cores of the first octaves.
TILE = 1 << 14
#: Words of short documents that are solved in one go.
PACK = 1 << 12
#: Words gathered at once for a digest.
GATHER = 1 << 16

_ODD = np.uint64(0x9E3779B97F4A7C15)
_FRAGMENT = ("k1", "k2", "period", "start", "end")
_TILE_FIELDS = ("low", "core", "core_end", "first_octave", "last_octave")
_EXPLODED = (
    "deal bigint, k1 bigint, k2 bigint, period bigint, start bigint, end bigint, "
    + ", ".join(f"{name} bigint" for name in _TILE_FIELDS)
    + ", words binary"
)
_NAMES = ["deal", *_FRAGMENT, *_TILE_FIELDS, "words"]


@lru_cache(maxsize=4)
def _least_factor(limit: int) -> np.ndarray:
    """Smallest prime factor of every number below ``limit``."""
    out = np.arange(limit)
    for i in range(2, int(limit**0.5) + 1):
        if out[i] == i:
            part = out[i * i :: i]
            part[part == np.arange(i * i, limit, i)] = i
    return out


def _fingerprints(words: np.ndarray, levels: int) -> list[np.ndarray]:
    """Level j has the fingerprint of the 2^j words from every position on."""
    out = [tx.mix(words + _ODD)]
    for j in range(levels):
        half = 1 << j
        if len(out[-1]) <= half:
            break
        out.append(tx.mix(out[-1][:-half] * _ODD + out[-1][half:]))
    return out


def _powers(names: list[np.ndarray], at: np.ndarray, lag: np.ndarray, octave: int) -> np.ndarray:
    """Whether the ``lag`` words from ``at`` on repeat a shorter word."""
    found = np.zeros(len(at), bool)
    factors = _least_factor(2 << octave)
    rest = lag
    while (rest > 1).any():
        prime = np.where(rest > 1, factors[rest], 1)
        period = lag // prime
        length = lag - period
        for level in {max(octave - 1, 0), octave}:
            size = 1 << level
            mine = np.flatnonzero((prime > 1) & (length >= size) & (length < 2 * size))
            if level < len(names) and len(mine):
                # Two blocks of a power of two cover all words that have to match.
                n, x, e, far = names[level], at[mine], period[mine], length[mine] - size
                found[mine] |= (n[x] == n[x + e]) & (n[x + far] == n[x + e + far])
        # The next prime factor; one that divides twice is tried twice.
        rest = rest // prime
    return found


def _reach(names: list[np.ndarray], at: np.ndarray, lag: np.ndarray, top: int, back: bool) -> np.ndarray:
    """Z-function: matches of words ``lag`` apart from ``at`` on, or back from it."""
    place = at.copy()
    for level in range(min(top, len(names) - 1), -1, -1):
        size, n = 1 << level, names[level]
        here = place - size if back else place
        there = here + lag
        fits = (here >= 0) if back else (there < len(n))
        same = np.zeros(len(at), bool)
        same[fits] = n[here[fits]] == n[there[fits]]
        place += np.where(same, -size if back else size, 0)
    return at - place if back else place - at


def merged(period: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Intervals of each period with overlapping and touching ones joined."""
    if not len(period):
        return period, start, end
    order = np.lexsort((start, period))
    period, start, end = period[order], start[order], end[order]
    rank = np.cumsum(np.r_[False, period[1:] != period[:-1]])
    wide = int(end.max()) + 1
    so_far = np.maximum.accumulate(end + rank * wide)
    new = np.r_[True, (start + rank * wide)[1:] > so_far[:-1]]
    first = np.flatnonzero(new)
    return period[first], start[first], np.maximum.reduceat(end, first)


def solve(words: np.ndarray, core: int, core_end: int, first_octave: int, last_octave: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Fragments (period, start, end) of the intervals at the boundaries of a tile's core.

    ``words`` are 64-bit codes of the tile's words; positions count from its first word.
    """
    n = len(words)
    names = _fingerprints(words, max(last_octave + 1, 4))
    none = np.zeros(0, np.int64)
    found = [(none, none, none)]
    for octave in range(first_octave, last_octave + 1):
        p = 1 << octave
        least = p if p >= LEAST // 2 else min(max(q, LEAST - q) for q in range(p, 2 * p))
        level = max(2, octave - 1)
        block = 1 << level
        step = least - block + 1
        if level >= len(names) or n < p + block:
            continue
        codes = names[level]
        at = np.arange(core, min(core_end, len(codes) - p), step)
        if not len(at):
            continue
        # Row i: the fingerprints at boundary i plus each lag of the octave.
        behind = np.zeros(len(codes) + p, np.uint64)
        behind[: len(codes)] = codes
        lags = np.lib.stride_tricks.sliding_window_view(behind[core + p :], p)[::step][: len(at)]
        i, lag = np.nonzero(lags == codes[at][:, None])
        b, q = at[i], lag + p
        inside = b + q < len(codes)
        b, q = b[inside], q[inside]
        if p > 1 and len(b):
            whole = ~_powers(names, b, q, octave)
            b, q = b[whole], q[whole]
        if not len(b):
            continue
        top = max(octave + 1, 4)
        start, end = b - _reach(names, b, q, top, True), b + _reach(names, b, q, top, False)
        enough = end - start >= np.maximum(q, LEAST - q)
        found.append(merged(q[enough], start[enough], end[enough]))
    return tuple(np.concatenate(c) for c in zip(*found))


def tiles(n: int, tile: int = TILE) -> Iterator[tuple[int, int, int, int, int]]:
    """(low, core, core end, first octave, last octave) of the tiles of ``n`` words; 'low' is the
    first word of the slice, which ends ``margin`` words after the core."""
    last = max(1, n // 2).bit_length() - 1
    shared = min(last, max(0, (tile // 8).bit_length() - 1)) if n > tile else last
    for first_octave, last_octave in [(0, shared)] + [(k, k) for k in range(shared + 1, last + 1)]:
        core_words = max(tile, 8 << last_octave) if n > tile else max(n, 1)
        for core in range(0, n, core_words):
            yield max(0, core - margin(last_octave)), core, min(n, core + core_words), first_octave, last_octave


def margin(octave: int) -> int:
    """Words before a core; twice as many stand behind it."""
    return max(2 << octave, 16)


def planted(n: int, h: int | None) -> np.ndarray:
    """Numbers of the words that stand at each place after the rewriting by ``h``."""
    order = np.arange(n)
    if h is None or n == 0 or h % 10:
        return order
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    order[a:] = a + (order[a:] - a) % p
    return order


def _texts(batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """(row, bytes, starts, ends) of the words of each text."""
    for first, end, data, at in tx.pieces(batch["text"]):
        starts, ends, before = tx.words_at(data, at, tx.SPACED)
        for row in range(first, end):
            mine = slice(before[row - first], before[row - first + 1])
            yield row, data, starts[mine], ends[mine]


def _exploder(tile: int):
    """Batch function: fragments of documents of one tile, tiles of longer ones."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            k1, k2, h = (batch[c].to_pylist() for c in ("k1", "k2", "h"))
            parts: list[tuple] = []
            for first, end, data, at in tx.pieces(batch["text"]):
                starts, ends, before = tx.words_at(data, at, tx.SPACED)
                hashes = tx.word_hashes(data, starts, ends)
                pack: list[tuple] = []
                # Texts of like length share a pack, so that none goes through octaves in vain.
                for row in (first + np.argsort(np.diff(before), kind="stable")).tolist():
                    words = hashes[before[row - first] : before[row - first + 1]]
                    n = len(words)
                    if n < LEAST:
                        continue
                    if h[row] is not None and h[row] % 10 == 0:
                        words = words[planted(n, h[row])]
                    if n <= tile:
                        pack.append((k1[row], k2[row], words))
                        if sum(len(p[2]) for p in pack) >= PACK:
                            parts += _solved_pack(pack)
                            pack = []
                        continue
                    for number, (low, core, core_end, low_octave, high_octave) in enumerate(tiles(n, tile)):
                        part = words[low : core_end + 2 * margin(high_octave)]
                        fields = [k1[row] + number, k1[row], k2[row], None, None, None]
                        fields += [low, core, core_end, low_octave, high_octave]
                        columns = [pa.array([v], pa.int64()) for v in fields] + [pa.array([part.tobytes()])]
                        yield pa.RecordBatch.from_arrays(columns, _NAMES)
                parts += _solved_pack(pack)
            found = _fragment_rows(parts)
            n = len(found)
            # Fragments need no solving; they are dealt evenly, also those of repeated rows.
            columns = [pa.array(np.arange(n)), *found.columns, *[pa.nulls(n, pa.int64())] * len(_TILE_FIELDS)]
            yield pa.RecordBatch.from_arrays([*columns, pa.nulls(n, pa.binary())], _NAMES)

    return run


def _solved_pack(pack: list[tuple]) -> list[tuple]:
    """Fragments of several short documents as one tile, set apart by words of their own."""
    if not pack:
        return []
    marks = tx.mix(np.arange(1, len(pack) + 1, dtype=np.uint64) * _ODD)
    words = np.concatenate([part for (_, _, own), mark in zip(pack, marks) for part in (own, [mark])])
    sizes = np.array([len(own) + 1 for _, _, own in pack])
    begin = np.cumsum(sizes) - sizes
    last = max(1, (int(sizes.max()) - 1) // 2).bit_length() - 1
    period, start, end = solve(words, 0, len(words), 0, last)
    owner = np.searchsorted(begin, start, "right") - 1
    out = []
    for i in np.unique(owner).tolist():
        mine = owner == i
        out.append((pack[i][0], pack[i][1], period[mine], start[mine] - begin[i], end[mine] - begin[i]))
    return out


def _fragment_rows(parts: list[tuple]) -> pa.RecordBatch:
    sizes = [len(p[2]) for p in parts]
    keys = [np.repeat(np.array([p[c] for p in parts], np.int64), sizes) for c in (0, 1)]
    rest = [np.concatenate([np.zeros(0, np.int64), *[p[c] for p in parts]]) for c in (2, 3, 4)]
    return pa.RecordBatch.from_arrays([pa.array(c) for c in keys + rest], list(_FRAGMENT))


def _solver(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batch function: fragments of the tiles; fragments found before go on as they are."""
    for batch in batches:
        yield batch.filter(batch["words"].is_null()).select(_FRAGMENT)
        for row in batch.filter(batch["words"].is_valid()).to_pylist():
            words, low = np.frombuffer(row["words"], np.uint64), row["low"]
            period, start, end = solve(
                words, row["core"] - low, row["core_end"] - low, row["first_octave"], row["last_octave"]
            )
            yield _fragment_rows([(row["k1"], row["k2"], period, start + low, end + low)])


def _collapsed(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> str:
    """SHA-256 of the words joined by one space, gathered a stretch at a time."""
    digest = hashlib.sha256()
    for first in range(0, len(starts), GATHER):
        s, e = starts[first : first + GATHER], ends[first : first + GATHER]
        sizes = e - s + 1
        after = np.cumsum(sizes)
        index = np.repeat(s - (after - sizes), sizes) + np.arange(after[-1])
        out = data[np.minimum(index, len(data) - 1)]
        out[after - 1] = 32
        digest.update(out[: -1 if first + GATHER >= len(starts) else None].tobytes())
    return digest.hexdigest()


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batch function: the digest of the words that no run drops, in place of text and h."""
    for batch in batches:
        h, runs = batch["h"].to_pylist(), batch["runs"]
        out: list[str] = [""] * len(batch)
        for row, data, starts, ends in _texts(batch):
            n = len(starts)
            if h[row] is not None and h[row] % 10 == 0 and n:
                order = planted(n, h[row])
                starts, ends = starts[order], ends[order]
            found = runs[row].as_py()
            if found:
                edge = np.zeros(n + 1, np.int64)
                for r in found:
                    edge[r["start"] + r["period"]] += 1
                    edge[r["start"] + r["length"]] -= 1
                keep = np.cumsum(edge[:-1]) == 0
                starts, ends = starts[keep], ends[keep]
            out[row] = _collapsed(data, starts, ends)
        columns = {c: batch[c] for c in batch.schema.names if c not in ("text", "h", "runs")}
        yield pa.RecordBatch.from_pydict(columns | {"collapsed_sha256": pa.array(out, pa.string())})


def find_runs(keyed: DataFrame, tile: int = TILE) -> DataFrame:
    """(k1, k2, start, length, period) of every run, from rows (k1, k2, h, text)."""
    ship(keyed.sparkSession)
    exploded = keyed.select("k1", "k2", "h", "text").mapInArrow(_exploder(tile), _EXPLODED)
    dealt = exploded.repartition("deal")
    fragments = dealt.mapInArrow(_solver, "k1 bigint, k2 bigint, period bigint, start bigint, end bigint")
    by = ["k1", "k2", "period"]
    # Equal rows give equal fragments, which partial aggregation takes together in the tasks.
    each = fragments.groupBy(*by, "start").agg(F.max("end").alias("end"))
    place = Window.partitionBy(*by).orderBy("start")
    so_far = F.max("end").over(place.rowsBetween(Window.unboundedPreceding, -1))
    stitched = (
        each.withColumn("gap", F.when(F.col("start") <= so_far, 0).otherwise(1))
        .withColumn("island", F.sum("gap").over(place))
        .groupBy(*by, "island")
        .agg(F.min("start").alias("start"), (F.max("end") - F.min("start") + F.col("period")).alias("length"))
    )
    return stitched.select("k1", "k2", "start", "length", "period")


def _keyed(docs: DataFrame) -> DataFrame:
    shown = F.col("doc_id").cast("string")
    seen = [shown.isNull(), shown, F.col("text").isNull(), F.col("text")]
    return docs.select(
        "doc_id",
        F.xxhash64(F.lit(1), *seen).alias("k1"),
        F.xxhash64(F.lit(2), *seen).alias("k2"),
        F.crc32(shown).alias("h"),
        "text",
    )


def report(docs: DataFrame, tile: int = TILE) -> DataFrame:
    """One row per document: number of runs, the longest one, digests of runs and of the rest.

    Columns: doc_id, n_runs, start, length, period, exponent_milli, runs_sha256,
    collapsed_sha256, and the runs themselves.
    """
    ship(docs.sparkSession)
    keyed = _keyed(docs)
    run = F.struct("start", "period", "length")
    by_document = find_runs(keyed, tile).groupBy("k1", "k2").agg(F.sort_array(F.collect_list(run)).alias("runs"))
    id_type = docs.schema["doc_id"].dataType.simpleString()
    runs_type = "array<struct<start: bigint, period: bigint, length: bigint>>"
    joined = keyed.join(by_document, ["k1", "k2"], "left").select(
        "doc_id", "text", "h", F.coalesce("runs", F.array().cast(runs_type)).alias("runs")
    )

    def line(r):
        return F.concat(r.start.cast("string"), F.lit(","), r.length.cast("string"), F.lit(","), r.period.cast("string"), F.lit("\n"))

    def rank(r):
        return F.struct(r.length.alias("length"), (-r.start).alias("s"), (-r.period).alias("p"))

    rows = joined.withColumn("best", F.array_max(F.transform("runs", rank))).select(
        "doc_id",
        "text",
        "h",
        "runs",
        F.size("runs").cast("long").alias("n_runs"),
        (-F.col("best.s")).alias("start"),
        F.col("best.length").alias("length"),
        (-F.col("best.p")).alias("period"),
        F.floor(F.lit(1000) * F.col("best.length") / -F.col("best.p")).alias("exponent_milli"),
        F.sha2(F.array_join(F.transform("runs", line), ""), 256).alias("runs_sha256"),
    )
    return rows.mapInArrow(
        _digests,
        f"doc_id {id_type}, n_runs bigint, start bigint, length bigint, period bigint, exponent_milli bigint, "
        "runs_sha256 string, collapsed_sha256 string",
    )
