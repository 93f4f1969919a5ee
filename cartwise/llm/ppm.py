"""Language-model scores by prediction by partial matching over bytes.

The trie of byte contexts up to ``ORDER`` bytes long is counted once over all training texts
(static, pretrained model). A byte is coded in its longest known context; where the
context has not seen it, an escape leads to the context shorter by one byte, with every
byte seen in the longer context excluded from the shorter one. Because a longer context
has only seen bytes that the shorter one has seen too, the excluded sums depend on the
context alone and are worked out once for the whole model.

Escape estimate: a context with D distinct bytes and mass T escapes with D / (T + D). Every
counted edge is kept, whatever its count and the size of the corpus.

The logarithm of a byte depends on the byte and its ``ORDER`` bytes before it alone: a run. Runs
are dealt to ``BUCKETS``, and these to groups, by the ``LOW`` bytes before the coded one, so the task of a group has
all longer contexts of its runs; the edges of shorter contexts, which the alphabet bounds (at
most 2^(8 LOW) keys, 268 MB at worst, a few MB for usual texts), are sent to all. A first pass
over the texts counts runs, packed as sorted differences, and merges them into a written table of
edges. A second pass sends each text's distinct runs to their groups, packed as postings (run,
row, times); there they meet the edges, are scored, and go back as one sum a row. A group with
more than ``SPLIT`` uses is dealt to several tasks, each with the group's edges. Postings stream
through a task; the edges of its group, about ``GROUP_EDGES`` at most until each bucket is a group
of its own, are all it holds.

Every text is coded with ``ORDER`` start marks before it and an end mark after it (byte values
that UTF-8 never uses).

Very long texts are coded whole, 8 bytes of memory a byte of text in their task.

Rows: each input row is scored by itself; repeated rows are scored alike. Null text: empty
text (its score is that of the end mark). Null id: its fold is that of the empty text.
Empty table: no rows. No training rows: every byte has probability 1/256 and the word
counts are zero. Other columns of the input are ignored.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from cartwise.llm import text as tx
from cartwise.llm.ship import ship
from cartwise.session import materialize, settled

ORDER = 5
#: Context bytes that deal runs to tasks; edges of fewer context bytes are at most 2^(8 LOW).
LOW = 3
#: Buckets of runs.
BUCKETS = 1 << 10
#: Fewest groups of buckets that postings are dealt to, and the edges from which on there are more.
GROUPS = 64
GROUP_EDGES = 1 << 21
#: Edges or postings that a task gathers before it scores them.
CHUNK = 1 << 19
#: Runs of a block of postings.
BLOCK_RUNS = 1 << 20
#: Distinct runs that a task gathers before it merges or sends its counts.
COUNT_RUNS = 1 << 21
#: Most uses of a group's runs that one task scores.
SPLIT = 1 << 28
HOT_WORDS = 1 << 18
WORD_PIECE_BYTES = 4 << 20
START, END = 0xFE, 0xFF


def _grams(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """One key for each byte and end mark: the byte lowest, the ``ORDER`` bytes before it above."""
    rows = len(at) - 1
    stream = np.full(len(data) + (ORDER + 1) * rows, START, np.uint8)
    shift = (ORDER + 1) * np.arange(rows) + ORDER
    stream[np.repeat(shift, np.diff(at)) + np.arange(len(data))] = data
    stream[at[1:] + shift] = END
    coded = np.ones(len(stream), bool)
    for k in range(ORDER):
        coded[at[:-1] + shift - 1 - k] = False
    key = np.zeros(len(stream), np.uint64)
    for k in range(ORDER + 1):
        key[k:] |= stream[: len(stream) - k].astype(np.uint64) << np.uint64(8 * k)
    return key[coded]


def _dealt(grams: np.ndarray) -> np.ndarray:
    """Runs as numbers that sort by bucket, then by their ``LOW`` bytes: bucket, low, rest, byte."""
    low = (grams >> np.uint64(8)) & np.uint64((1 << (8 * LOW)) - 1)
    bucket = tx.mix(low) % np.uint64(BUCKETS)
    rest = grams >> np.uint64(8 * (LOW + 1))
    return bucket << np.uint64(48) | low << np.uint64(24) | rest << np.uint64(8) | grams & np.uint64(255)


def _undealt(codes: np.ndarray) -> np.ndarray:
    low = (codes >> np.uint64(24)) & np.uint64((1 << (8 * LOW)) - 1)
    rest = (codes >> np.uint64(8)) & np.uint64(0xFFFF)
    return rest << np.uint64(8 * (LOW + 1)) | low << np.uint64(8) | codes & np.uint64(255)


def _packed(*columns: tuple[np.ndarray, int]) -> bytes:
    """Columns of whole numbers, each with its width in bytes, byte by byte and compressed."""
    planes = [
        np.ascontiguousarray(v.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].T).tobytes()
        for v, width in columns
    ]
    return pa.compress(b"".join(planes), codec="zstd", asbytes=True)


def _unpacked(body: bytes, *columns: tuple[int, int]) -> list[np.ndarray]:
    """The columns of ``_packed`` from their (length, width)."""
    size = sum(n * width for n, width in columns)
    raw = np.frombuffer(pa.decompress(body, size, codec="zstd", asbytes=True), np.uint8)
    out, at = [], 0
    for n, width in columns:
        value = np.zeros(n, np.uint64)
        for k in range(width):
            value |= raw[at : at + n].astype(np.uint64) << np.uint64(8 * k)
            at += n
        out.append(value)
    return out


def _steps(keys: np.ndarray) -> np.ndarray:
    return np.diff(keys, prepend=np.uint64(0))


def _bounds(codes: np.ndarray, shift: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """The buckets (or groups of 2^shift) of sorted codes, where each begins and the last ends."""
    bucket = codes >> np.uint64(48 + shift)
    first = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]]) if len(codes) else np.zeros(0, np.int64)
    return bucket[first].astype(np.int32), np.r_[first, len(codes)]


_EDGES = {"bucket": pa.int32(), "size": pa.int64(), "uses": pa.int64(), "body": pa.binary()}
_COUNTS = {"word": pa.string(), "n": pa.int64(), **_EDGES}


def _edge_rows(codes: np.ndarray, n: np.ndarray) -> dict[str, pa.Array]:
    """Sorted dealt codes and their counts, one packed row a bucket."""
    buckets, at = _bounds(codes)
    bodies = [
        _packed((_steps(codes[a:b]), 8), (n[a:b], 8)) for a, b in zip(at[:-1].tolist(), at[1:].tolist())
    ]
    uses = np.add.reduceat(n, at[:-1]) if len(codes) else np.zeros(0, np.int64)
    return {
        "bucket": pa.array(buckets),
        "size": pa.array(np.diff(at), pa.int64()),
        "uses": pa.array(uses.astype(np.int64)),
        "body": pa.array(bodies, pa.binary()),
    }


def _edges_in(body: bytes, size: int) -> tuple[np.ndarray, np.ndarray]:
    steps, n = _unpacked(body, (size, 8), (size, 8))
    return np.cumsum(steps, dtype=np.uint64), n.astype(np.int64)


def _count_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema(list(_COUNTS.items()))

    def made(size: int, /, **columns) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [columns[k] if k in columns else pa.nulls(size, t) for k, t in _COUNTS.items()], schema=schema
        )

    held_keys, held_counts, held, texts = [], [], 0, 0
    for batch in batches:
        learnt = batch.filter(pc.invert(batch["held_out"]))
        texts += len(learnt)
        for _, _, data, at in tx.pieces(learnt["text"], WORD_PIECE_BYTES):
            data = tx.LOWER[data]
            starts, ends, _ = tx.words_at(data, at, tx.SPACED)
            coded = tx.word_strings(data, starts, ends, tx.SPACED).dictionary_encode()
            n = np.bincount(coded.indices.to_numpy(), minlength=len(coded.dictionary))
            yield made(len(n), word=coded.dictionary.cast(pa.string()), n=pa.array(n, pa.int64()))
        for _, _, data, at in tx.pieces(learnt["text"]):
            keys, counts = np.unique(_dealt(_grams(tx.LOWER[data], at)), return_counts=True)
            held_keys.append(keys)
            held_counts.append(counts)
            held += len(keys)
            if held > COUNT_RUNS:
                merged = _merged(held_keys, held_counts)
                held_keys, held_counts, held = [merged[0]], [merged[1]], len(merged[0])
                if held > COUNT_RUNS // 2:
                    packed = _edge_rows(*merged)
                    yield made(len(packed["bucket"]), **packed)
                    held_keys, held_counts, held = [], [], 0
    if held:
        packed = _edge_rows(*_merged(held_keys, held_counts))
        yield made(len(packed["bucket"]), **packed)
    yield made(1, n=pa.array([texts], pa.int64()))


def _merge_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row a bucket from all counts of it; rows come sorted by bucket."""
    schema = pa.schema(list(_EDGES.items()))
    keys, counts, held, now = [], [], 0, None

    def closed() -> pa.RecordBatch:
        return pa.RecordBatch.from_pydict(_edge_rows(*_merged(keys, counts)), schema=schema)

    for batch in batches:
        for row in batch.to_pylist():
            if now is not None and row["bucket"] != now:
                yield closed()
                keys, counts, held = [], [], 0
            now = row["bucket"]
            found = _edges_in(row["body"], row["size"])
            keys.append(found[0])
            counts.append(found[1])
            held += len(found[0])
            if held > 4 * CHUNK:
                merged = _merged(keys, counts)
                keys, counts = [merged[0]], [merged[1]]
                # What is left after merging does not count towards the next merge.
                held = 0
    if keys:
        yield closed()


def _merged(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    every, n = np.concatenate(keys), np.concatenate(counts)
    order = np.argsort(every, kind="stable")
    every, n = every[order], n[order]
    first = np.flatnonzero(np.r_[True, every[1:] != every[:-1]]) if len(every) else np.zeros(0, np.int64)
    return every[first], np.add.reduceat(n, first) if len(first) else n


@dataclass
class Trie:
    """Edges and contexts of each order, as sorted keys, with their logarithms.

    ``start``: of the order's own denominators, entered first. ``enter``: of the parent's
    denominators once this context's bytes are excluded. Each holds (escape, total).
    """

    edges: list[np.ndarray]
    edge_log: list[np.ndarray]
    contexts: list[np.ndarray]
    start: list[np.ndarray]
    enter: list[np.ndarray]
    last: float
    #: Facts of the longest order, which the next longer one needs.
    below: tuple | None = None


def _shorter(keys: np.ndarray, n: np.ndarray, order: int) -> tuple[np.ndarray, np.ndarray]:
    """The edges of ``order`` context bytes from those of longer contexts."""
    found, place = np.unique(keys & np.uint64((1 << (8 * (order + 1))) - 1), return_inverse=True)
    total = np.zeros(len(found), np.int64)
    np.add.at(total, place, n)
    return found, total


def edges_of(keys: np.ndarray, n: np.ndarray, orders: range) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """Edges (key, count) of ``orders``, of which the last has the longest contexts."""
    out = {}
    for order in reversed(orders):
        keys, n = out[order] = _shorter(keys, n, order)
    return out


def build_trie(edges: dict[int, tuple[np.ndarray, np.ndarray]], base: Trie | None = None) -> Trie:
    """The model from the edges (key, count) of each order, on top of ``base`` if given.

    A key of order k is k context bytes and the coded byte last. The edges of an order may
    be those of some contexts only, as long as the parents of its contexts are there.
    """
    sorted_edges, sorted_counts, contexts, start, enter = [], [], [], [], []
    below: tuple | None = None
    if base is not None:
        sorted_edges, sorted_counts, contexts = [*base.edges], [*base.edge_log], [*base.contexts]
        start, enter, below = [*base.start], [*base.enter], base.below
    for order in sorted(edges):
        key, n = edges[order]
        at = np.argsort(key)
        key, n = key[at], n[at].astype(float)
        of = key >> np.uint64(8)
        ctx, first, distinct = np.unique(of, return_index=True, return_counts=True)
        mass = np.add.reduceat(n, first) if len(first) else np.zeros(0)
        start.append(np.stack([np.log10(distinct / (mass + distinct)), np.log10(mass + distinct)]) if len(ctx) else np.zeros((2, 0)))
        if below is None:
            enter.append(np.zeros((2, len(ctx))))
        else:
            p_ctx, p_mass, p_distinct, p_key, p_n = below
            mask = np.uint64((1 << (8 * (order - 1))) - 1)
            parent = np.searchsorted(p_ctx, ctx & mask)
            edge_mask = np.uint64((1 << (8 * order)) - 1)
            seen = p_n[np.searchsorted(p_key, key & edge_mask)] if len(key) else np.zeros(0)
            excluded = np.add.reduceat(seen, first) if len(first) else np.zeros(0)
            rest = p_mass[parent] - excluded
            out = p_distinct[parent] - distinct
            both = rest + out
            with np.errstate(divide="ignore", invalid="ignore"):
                enter.append(np.stack([np.where(both > 0, np.log10(out / both), 0.0), np.where(both > 0, np.log10(both), 0.0)]))
        sorted_edges.append(key)
        sorted_counts.append(np.log10(n))
        contexts.append(ctx)
        below = (ctx, mass, distinct, key, n)
    used = len(sorted_edges[0])
    return Trie(sorted_edges, sorted_counts, contexts, start, enter, -float(np.log10(256 - used)), below)


class _Table:
    """Open-addressed hash table from 64-bit keys to their positions."""

    def __init__(self, keys: np.ndarray):
        self.bits = max(8, int(len(keys)).bit_length() + 2)
        self.keys = np.full(1 << self.bits, np.uint64(0xFFFFFFFFFFFFFFFF), np.uint64)
        self.at = np.full(1 << self.bits, -1, np.int32)
        todo, slot = np.arange(len(keys)), self._slot(keys)
        while len(todo):
            free = self.at[slot] < 0
            there, first = np.unique(slot[free], return_index=True)
            self.at[there] = todo[free][first]
            self.keys[there] = keys[todo[free][first]]
            left = self.at[slot] != todo
            todo, slot = todo[left], (slot[left] + 1) & ((1 << self.bits) - 1)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys * np.uint64(tx._STEP)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Position of each key, or -1."""
        slot = self._slot(keys)
        out = self.at[slot]
        wrong = np.flatnonzero((self.keys[slot] != keys) & (out >= 0))
        while len(wrong):
            slot_w = (slot[wrong] + 1) & ((1 << self.bits) - 1)
            slot[wrong] = slot_w
            out[wrong] = self.at[slot_w]
            wrong = wrong[(self.keys[slot_w] != keys[wrong]) & (out[wrong] >= 0)]
        return out


class Scorer:
    """Looks positions up in a trie; the tables of ``base``, its short orders, are taken over."""

    def __init__(self, trie: Trie, base: Scorer | None = None):
        self.trie = trie
        self.edges = [*(base.edges if base else [])]
        self.contexts = [*(base.contexts if base else [])]
        self.edges += [_Table(k) for k in trie.edges[len(self.edges) :]]
        self.contexts += [_Table(k) for k in trie.contexts[len(self.contexts) :]]
        if len(trie.edges) <= ORDER:
            return
        top = trie.edges[ORDER]
        own = self.contexts[ORDER].find(top >> np.uint64(8))
        self.direct = trie.edge_log[ORDER] - trie.start[ORDER][1][own] if len(top) else np.zeros(0)

    def bits(self, keys: np.ndarray) -> np.ndarray:
        """log10 probability of the last byte of each key after the bytes before it."""
        out = np.zeros(len(keys))
        at = self.edges[ORDER].find(keys)
        hit = at >= 0
        out[hit] = self.direct[at[hit]]
        left = np.flatnonzero(~hit)
        entered = np.zeros(len(left), bool)
        enter = np.zeros((2, len(left)))
        for order in range(ORDER, -1, -1):
            if not len(left):
                break
            key = keys[left] & np.uint64((1 << (8 * (order + 1))) - 1)
            ctx = self.contexts[order].find(key >> np.uint64(8))
            edge = self.edges[order].find(key)
            known = ctx >= 0
            own = np.zeros((2, len(left)))
            own[:, known] = self.trie.start[order][:, ctx[known]]
            use = np.where(entered, enter, own)
            hit = edge >= 0
            out[left[hit]] += self.trie.edge_log[order][edge[hit]] - use[1][hit]
            miss = known & ~hit
            out[left[miss]] += use[0][miss]
            enter[:, known] = self.trie.enter[order][:, ctx[known]]
            entered = entered | known
            left, entered, enter = left[~hit], entered[~hit], enter[:, ~hit]
        out[left] += self.trie.last
        return out


_made: dict[str, object] = {}


def _kept(key: str, make: Callable[[], object]) -> object:
    """What ``make`` gives, kept in the worker from one task to the next of one job."""
    if key not in _made:
        _made.clear()
        _made[key] = make()
    return _made[key]


class _Block:
    """Rows of texts gathered for one block of postings."""

    def __init__(self):
        self.codes, self.rows, self.size, self.count = [], [], 0, 0

    def add(self, data: np.ndarray, at: np.ndarray) -> None:
        self.codes.append(_dealt(_grams(data, at)))
        self.rows.append(np.repeat(np.arange(self.count, self.count + len(at) - 1, dtype=np.uint32), np.diff(at) + 1))
        self.size += len(self.codes[-1])
        self.count += len(at) - 1

    def packed(self, shift: int) -> dict[str, list]:
        """One row a group of 2^shift buckets: its distinct runs, the rows that hold each, and how often."""
        codes, rows = np.concatenate(self.codes), np.concatenate(self.rows)
        order = np.argsort(codes, kind="stable")
        codes, rows = codes[order], rows[order].astype(np.uint64)
        first = np.flatnonzero(np.r_[True, (codes[1:] != codes[:-1]) | (rows[1:] != rows[:-1])])
        times = np.diff(np.r_[first, len(codes)])
        codes, rows = codes[first], rows[first]
        new = np.r_[True, codes[1:] != codes[:-1]]
        ahead = np.where(new, rows, rows - np.r_[np.uint64(0), rows[:-1]])
        key_at = np.flatnonzero(new)
        holders = np.diff(np.r_[key_at, len(codes)])
        keys = codes[key_at]
        groups, at = _bounds(keys, shift)
        out = {"grp": groups.tolist(), "size": [], "postings": [], "body": []}
        ends = np.r_[key_at, len(codes)]
        for a, b in zip(at[:-1].tolist(), at[1:].tolist()):
            low, high = int(ends[a]), int(ends[b])
            out["size"].append(b - a)
            out["postings"].append(high - low)
            out["body"].append(
                _packed((_steps(keys[a:b]), 8), (holders[a:b], 4), (ahead[low:high], 4), (times[low:high], 4))
            )
        return out


def _postings_in(body: bytes, size: int, postings: int) -> tuple[np.ndarray, ...]:
    """(run, row, times) of each posting of a packed row."""
    steps, holders, ahead, times = _unpacked(body, (size, 8), (size, 4), (postings, 4), (postings, 4))
    holders, ahead = holders.astype(np.int64), ahead.astype(np.int64)
    first = np.cumsum(holders) - holders
    total = np.cumsum(ahead)
    rows = total - np.repeat(total[first] - ahead[first], holders)
    return np.repeat(np.cumsum(steps, dtype=np.uint64), holders), rows, times.astype(np.int64)


#: Columns of what the second pass sends to the groups. Kind 0: edges of a bucket; 1: postings;
#: 2: the facts of a block's rows.
_SENT = {
    "kind": pa.int32(),
    "grp": pa.int32(),
    "part": pa.int32(),
    "row": pa.int64(),
    "count": pa.int64(),
    "size": pa.int64(),
    "postings": pa.int64(),
    "body": pa.binary(),
}
_SENT_SQL = "kind int, grp int, part int, row long, count long, size long, postings long, body binary"


def _as_stream(batch: pa.RecordBatch) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
        out.write_batch(batch)
    return sink.getvalue().to_pybytes()


def _send_batches(shared):
    """The batch function that packs postings and looks common words up."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        hot, hot_log = shared.value["hot"], np.log10(shared.value["hot_n"] + 1.0)
        parts, shift = shared.value["parts"], shared.value["shift"]
        number = first_row = TaskContext.get().partitionId() << 40
        block = _Block()

        def made(size: int, /, **columns) -> pa.RecordBatch:
            arrays = [
                pa.array(columns[k], t) if k in columns else pa.nulls(size, t) for k, t in _SENT.items()
            ]
            return pa.RecordBatch.from_arrays(arrays, schema=pa.schema(list(_SENT.items())))

        def sent() -> pa.RecordBatch:
            packed = block.packed(shift)
            n = len(packed["grp"])
            of = np.array(packed["grp"], np.int64)
            part = tx.mix(np.full(n, first_row, np.uint64)) % parts[of]
            same = {"kind": np.ones(n, np.int32), "row": np.full(n, first_row), "count": np.full(n, block.count)}
            return made(n, part=part.astype(np.int32), **same, **packed)

        for batch in batches:
            for first, end, data, at in tx.pieces(batch["text"]):
                data = tx.LOWER[data]
                rows = end - first
                block.add(data, at)
                starts, ends, before = tx.words_at(data, at, tx.SPACED)
                coded = tx.word_strings(data, starts, ends, tx.SPACED).dictionary_encode()
                codes = coded.indices.to_numpy()
                place = pc.index_in(coded.dictionary, value_set=hot)
                place = place.fill_null(-1).to_numpy(zero_copy_only=False)
                common = place >= 0
                log = np.zeros(len(place))
                log[common] = hot_log[place[common]]
                total = np.r_[0.0, np.cumsum(log[codes])]
                known = np.r_[0, np.cumsum(common[codes])]
                rare = np.flatnonzero(~common[codes])
                lists = pa.LargeListArray.from_arrays(
                    pa.array(np.searchsorted(rare, before), pa.int64()),
                    coded.dictionary.take(pa.array(codes[rare])),
                )
                facts = pa.RecordBatch.from_pydict(
                    {
                        "row": pa.array(number + np.arange(rows)),
                        "doc_id": batch["doc_id"].slice(first, rows),
                        "held_out": batch["held_out"].slice(first, rows),
                        "n_words": pa.array(np.diff(before), pa.int64()),
                        "hot_known": pa.array(known[before[1:]] - known[before[:-1]], pa.int64()),
                        "hot_log": pa.array(total[before[1:]] - total[before[:-1]]),
                        "rare": lists.cast(pa.list_(pa.string())),
                    }
                )
                # Facts are of no group; they travel with all of them.
                group = (number + block.count) % len(parts)
                yield made(1, kind=[2], grp=[group], part=[0], row=[number], body=[_as_stream(facts)])
                number += rows
                if block.size >= BLOCK_RUNS:
                    yield sent()
                    block, first_row = _Block(), number
        if block.size:
            yield sent()

    return run


def _score_batches(shared, doc_type: pa.DataType):
    """Scores postings that come after the edges of their group; sums go back by block."""
    fields = {
        "row": pa.int64(),
        "doc_id": doc_type,
        "held_out": pa.bool_(),
        "n_words": pa.int64(),
        "hot_known": pa.int64(),
        "hot_log": pa.float64(),
        "rare": pa.list_(pa.string()),
        "sums": pa.binary(),
    }

    def filled(columns: dict[str, pa.Array]) -> pa.RecordBatch:
        size = len(columns["row"])
        arrays = [columns[n].cast(t) if n in columns else pa.nulls(size, t) for n, t in fields.items()]
        return pa.RecordBatch.from_arrays(arrays, schema=pa.schema(list(fields.items())))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base = _kept(shared.value["id"], lambda: Scorer(build_trie(shared.value["low"])))
        shift = shared.value["shift"]
        now: tuple | None = None
        edges: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        scorer: Scorer | None = None
        held: list[tuple] = []
        size = edge_size = 0
        sums: dict[int, np.ndarray] = {}

        def scored() -> None:
            nonlocal scorer
            if scorer is None:
                keys = [np.zeros(0, np.uint64), *[_undealt(k) for k, _ in edges.values()]]
                n = [np.zeros(0, np.int64), *[c for _, c in edges.values()]]
                own = edges_of(np.concatenate(keys), np.concatenate(n), range(LOW, ORDER + 1))
                scorer = Scorer(build_trie(own, base.trie), base)
            codes = np.concatenate([h[1] for h in held])
            distinct, place = np.unique(codes, return_inverse=True)
            log = scorer.bits(_undealt(distinct))[place]
            at = 0
            for row, code, rows, times, count in held:
                gained = np.bincount(rows, log[at : at + len(code)] * times, count)
                sums[row] = sums[row] + gained if row in sums else gained
                at += len(code)

        def back() -> pa.RecordBatch:
            bodies = pa.array([v.tobytes() for v in sums.values()], pa.binary())
            return filled({"row": pa.array(list(sums), pa.int64()), "sums": bodies})

        for batch in batches:
            for item in batch.to_pylist():
                if item["kind"] == 2:
                    facts = pa.ipc.open_stream(item["body"]).read_next_batch()
                    yield filled({n: facts[n] for n in facts.schema.names})
                    continue
                key = item["grp"], item["part"]
                if key != now:
                    if held and size + edge_size >= CHUNK:
                        scored()
                        held, size = [], 0
                    if not held:
                        edges, scorer, edge_size = {}, None, 0
                    if sum(map(len, sums.values())) > 4 * CHUNK:
                        yield back()
                        sums = {}
                now = key
                if item["kind"] == 0:
                    # Each part of a group brings the same edges; size is that of the bucket.
                    codes, n = _edges_in(item["body"], item["size"])
                    bucket = int(codes[0] >> np.uint64(48))
                    if bucket not in edges:
                        edges[bucket] = codes, n
                        edge_size += len(codes)
                        scorer = None
                    continue
                found = _postings_in(item["body"], item["size"], item["postings"])
                held.append((item["row"], *found, item["count"]))
                size += item["postings"]
                if size >= 2 * CHUNK:
                    scored()
                    held, size = [], 0
                    if any(k >> shift != now[0] for k in edges):
                        # The rest of this group needs its own edges only.
                        edges = {k: v for k, v in edges.items() if k >> shift == now[0]}
                        edge_size, scorer = sum(len(k) for k, _ in edges.values()), None
        if held:
            scored()
        if sums:
            yield back()

    return run


def _sum_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(row, run_log) from the partial sums of each block; rows come sorted by block."""
    now, total = None, None

    def closed() -> pa.RecordBatch:
        return pa.RecordBatch.from_pydict(
            {"row": pa.array(now + np.arange(len(total))), "run_log": pa.array(total)}
        )

    for batch in batches:
        for row, body in zip(batch["row"].to_pylist(), batch["sums"]):
            part = np.frombuffer(body.as_py(), np.float64)
            if row == now:
                total = total + part
                continue
            if now is not None:
                yield closed()
            now, total = row, part
    if now is not None:
        yield closed()


def count(texts: DataFrame) -> DataFrame:
    """(word, n, bucket, size, uses, body): counts of words and of byte runs, and of texts.

    ``texts`` has the column text, and may have held_out; such rows are not counted. Rows have
    a word and its count, or the packed run counts of a bucket, or (neither) a number of
    texts. Several rows may count the same word or bucket; each task sends few.
    """
    held = F.col("held_out") if "held_out" in texts.columns else F.lit(False)
    return texts.select("text", held.alias("held_out")).mapInArrow(
        _count_batches, "word string, n long, bucket int, size long, uses long, body binary"
    )


def fit(counts: DataFrame) -> Trie:
    """The whole trie of a small corpus on the driver; ``score`` works for any size."""
    found = [_edges_in(r["body"], r["size"]) for r in counts.where("bucket is not null").collect()]
    codes, n = _merged([k for k, _ in found], [c for _, c in found])
    return build_trie(edges_of(_undealt(codes), n, range(ORDER + 1)))


def edge_table(counts: DataFrame) -> DataFrame:
    """(bucket, size, uses, body): all edges of the longest order, one row a bucket."""
    return (
        counts.where(F.col("bucket").isNotNull())
        .select("bucket", "size", "uses", "body")
        .repartition("bucket")
        .sortWithinPartitions("bucket")
        .mapInArrow(_merge_batches, "bucket int, size long, uses long, body binary")
    )


def _low_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Edges of ``LOW`` bytes in all, counted by row of the edge table."""
    for batch in batches:
        for row in batch.to_pylist():
            codes, n = _edges_in(row["body"], row["size"])
            keys, total = _shorter(_undealt(codes), n, LOW - 1)
            yield pa.RecordBatch.from_pydict(
                {"key": pa.array(keys.view(np.int64)), "n": pa.array(total)}
            )


def score(docs: DataFrame, trains: Column, hot_words: int = HOT_WORDS, split: int = SPLIT) -> DataFrame:
    """Score every row of ``docs`` (doc_id, text), learning from the rows ``trains`` selects.

    Returns doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score. Words
    that make up at least one ``hot_words``-th of the training words are at most that
    many; they go to all tasks. The others meet their counts in a shuffle join, which no
    word can overload since it is below that share. Groups with more than ``split`` uses in the
    training texts are scored by several tasks. Neither parameter changes results.
    """
    ship(docs.sparkSession)
    return settled(docs.sparkSession, lambda: _scored(docs, trains, hot_words, split), "ppm-scores")


def _scored(docs: DataFrame, trains: Column, hot_words: int, split: int) -> DataFrame:
    spark = docs.sparkSession
    rows = docs.select(
        F.col("doc_id"), F.col("text"), (~F.coalesce(trains, F.lit(False))).alias("held_out")
    )
    counts = materialize(count(rows), "ppm-counts")
    words = materialize(
        counts.where(F.col("word").isNotNull()).groupBy("word").agg(F.sum("n").alias("n")), "ppm-words"
    )
    facts = words.agg(F.sum("n").alias("words"), F.count("word").alias("types")).first()
    texts = counts.where("word is null and bucket is null").agg(F.sum("n")).first()[0] or 0
    tokens = (facts["words"] or 0) + texts
    types = facts["types"] + (1 if texts else 0)
    least = max(1, -(-(facts["words"] or 0) // hot_words))
    hot = words.where(F.col("n") >= least).toArrow()
    edges = materialize(edge_table(counts), "ppm-edges")
    low = edges.mapInArrow(_low_batches, "key long, n long").groupBy("key").agg(F.sum("n").alias("n")).toArrow()
    low = edges_of(low["key"].to_numpy().astype(np.uint64), low["n"].to_numpy(), range(LOW))
    # One row a bucket. Groups are as many as keep the edges of one within memory.
    sizes = edges.select("bucket", "size", "uses").toPandas()
    least_groups = max(GROUPS, int(sizes["size"].sum()) // GROUP_EDGES)
    shift = max(0, (BUCKETS // min(BUCKETS, least_groups)).bit_length() - 1)
    uses = np.bincount(sizes["bucket"].to_numpy(np.int64) >> shift, sizes["uses"], BUCKETS >> shift)
    parts = np.maximum(1, -(-uses.astype(np.int64) // split)).astype(np.uint64)
    shared = spark.sparkContext.broadcast(
        {
            "id": uuid.uuid4().hex,
            "low": low,
            "parts": parts,
            "shift": shift,
            "hot": hot["word"].combine_chunks().cast(pa.large_string()),
            "hot_n": hot["n"].to_numpy(),
        }
    )
    sent = rows.mapInArrow(_send_batches(shared), _SENT_SQL)
    parts_of = F.array(*[F.lit(int(p)) for p in parts])
    group = F.expr(f"shiftright(bucket, {shift})")
    model = edges.select(F.lit(0).alias("kind"), group.alias("grp"), "size", "body").withColumn(
        "part", F.explode(F.sequence(F.lit(0), F.element_at(parts_of, F.col("grp") + 1) - 1))
    )
    doc_type = docs.select("doc_id").schema
    scored = materialize(
        sent.unionByName(model, allowMissingColumns=True)
        .repartition("grp", "part")
        .sortWithinPartitions("grp", "part", "kind")
        .mapInArrow(
            _score_batches(shared, to_arrow_schema(doc_type).field(0).type),
            f"row long, doc_id {doc_type[0].dataType.simpleString()}, held_out boolean, n_words long, "
            "hot_known long, hot_log double, rare array<string>, sums binary",
        ),
        "ppm-rows",
    )
    rare = (
        scored.select("row", F.explode("rare").alias("word"))
        .join(words.where(F.col("n") < least), "word")
        .groupBy("row")
        .agg(F.count(F.lit(1)).alias("rare_known"), F.sum(F.log10(F.col("n") + 1.0)).alias("rare_log"))
    )
    runs = (
        scored.where("sums is not null")
        .select("row", "sums")
        .repartition("row")
        .sortWithinPartitions("row")
        .mapInArrow(_sum_batches, "row long, run_log double")
    )
    known = F.col("hot_known") + F.coalesce("rare_known", F.lit(0))
    gained = F.col("hot_log") + F.coalesce("rare_log", F.lit(0.0)) + F.log10(F.lit(texts + 1.0))
    n_tokens = F.col("n_words") + 1
    return (
        scored.where("sums is null")
        .drop("rare", "sums")
        .join(rare, "row", "left")
        .join(runs, "row", "left")
        .select(
            "doc_id",
            "held_out",
            n_tokens.alias("n_tokens"),
            (known + F.lit(1 if texts else 0)).cast("long").alias("n_known"),
            F.lit(tokens).cast("long").alias("train_tokens"),
            (gained - n_tokens * F.log10(F.lit(float(tokens + types + 1)))).alias("base_score"),
            F.coalesce("run_log", F.lit(0.0)).alias("score"),
        )
    )
