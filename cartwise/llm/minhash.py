"""Near-duplicate groups by fast similarity sketches, banding and exact verification.

Sketch of a set with ``COORDINATES`` bins: round i throws every element into one hashed
bin with a hashed value, and a bin keeps its smallest (round, value). Rounds go on until
all bins are filled; after ``COORDINATES`` rounds, round COORDINATES + j throws all
elements into bin j, so every bin is filled at the end. Two sets agree in a bin with the
probability of their Jaccard similarity, and the number of equal bins is concentrated as
if the bins were independent. Bands of ``BAND_ROWS`` bins choose candidates: at similarity
0.85 a pair misses all 32 bands with probability 6e-11, at 0.8 with 5e-8.

Texts with the same set are one node, known by a 128-bit fingerprint; nodes that share no
band with another node end there. The pairs of a bucket are never written out. First every
node is verified against a hub of its buckets, and, if that is no link, against up to ``HUBS``
- 1 others; a bucket's hub is its node that meets most nodes in all its buckets, which finds
the original among edited copies. That joins most groups to one component each. Then
buckets that still hold several components are compared inside the tasks, in blocks of
``BLOCK`` by ``BLOCK`` nodes, on sketches of ``LONG`` bins. A pair is near when it is in
different components and its sketches agree to within five standard deviations of the
threshold. A first pass takes the ``BEST`` nearest of each node, which joins groups whose
links are sparse; a second pass takes every near pair that is left. A pair counts in the
first band whose 64-bit keys are equal. Links are decided on the full sets.

Rows: identical texts and repeated rows belong to one group. Texts without words are empty
sets, linked with nothing; null text is such a text. A null id takes part, but is no
group's id as long as another id is there. Empty table: no rows. Other columns of the
input are ignored. Ids may be of any type that has an order, structs too.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartwise.llm import text as tx
from cartwise.llm.ship import ship
from cartwise.session import materialize, settled

COORDINATES = 128
BAND_ROWS = 4
#: Bins of the sketches that blocks compare, and nodes in a block.
LONG = 1024
BLOCK = 512
#: Rows of a batch whose long sketches are made together.
ROWS = 512
#: Hubs that a node is verified against before blocks are compared.
HUBS = 8
#: Parts of the nodes of a root in a join on the root.
SALTS = 16
#: Rows of a task that writes links, roots or groups.
TASK_ROWS = 1 << 15
#: Near pairs that a node keeps in the first comparison of blocks.
BEST = 2

_EMPTY = np.uint64(0xFFFFFFFFFFFFFFFF)
_VALUE = np.uint64((1 << 48) - 1)


def _seed(k: int) -> np.uint64:
    return np.uint64((k + 1) * tx._STEP & 0xFFFFFFFFFFFFFFFF)


def sketches(elements: np.ndarray, before: np.ndarray, bins: int = COORDINATES) -> np.ndarray:
    """Sketch of each set; ``before`` says where its elements start. Empty sets stay empty.

    ``bins`` is a power of two. Values hold the round above 48 bits of hash.
    """
    sets = len(before) - 1
    sizes = np.diff(before)
    out = np.full((sets, bins), _EMPTY, np.uint64)
    owner = np.repeat(np.arange(sets), sizes)
    active, items = np.flatnonzero(sizes), elements
    shift = np.uint64(65 - bins.bit_length())
    for k in range(bins):
        if not len(active):
            return out
        h = tx.mix(items ^ _seed(k))
        value = (h & _VALUE) | (np.uint64(k) << np.uint64(48))
        np.minimum.at(out.reshape(-1), owner * bins + (h >> shift).astype(np.int64), value)
        open_ = np.zeros(sets, bool)
        open_[active] = (out[active] == _EMPTY).any(axis=1)
        stay = open_[owner]
        owner, items, active = owner[stay], items[stay], np.flatnonzero(open_)
    if len(active):
        starts = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
        for j in range(bins):
            gap = out[active, j] == _EMPTY
            if gap.any():
                least = np.minimum.reduceat(tx.mix(items ^ _seed(bins + j)) & _VALUE, starts)
                out[active[gap], j] = least[gap] | (np.uint64(bins + j) << np.uint64(48))
    return out


def band_keys(sketch: np.ndarray) -> np.ndarray:
    """One 64-bit key for each band of each sketch."""
    bands = COORDINATES // BAND_ROWS
    grouped = sketch.reshape(len(sketch), bands, BAND_ROWS)
    key = np.broadcast_to(np.arange(bands, dtype=np.uint64), grouped.shape[:2]).copy()
    for r in range(BAND_ROWS):
        key = tx.mix(key * np.uint64(tx._BASE) + grouped[:, :, r])
    return key


def _sets(texts: pa.Array, size: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, sorted distinct shingles, starts) of pieces of a batch."""
    for first, end, data, at in tx.pieces(texts):
        data = tx.LOWER[data]
        starts, ends, before = tx.words_at(data, at, tx.SPACED)
        codes, runs = tx.shingles(tx.word_hashes(data, starts, ends), before, size)
        found = [np.unique(codes[runs[i] : runs[i + 1]]) for i in range(end - first)]
        place = np.zeros(end - first + 1, np.int64)
        np.cumsum([len(x) for x in found], out=place[1:])
        yield first, end, np.concatenate(found) if found else codes, place


def _fingerprints(elements: np.ndarray, place: np.ndarray) -> list[bytes | None]:
    """128 bits for each set from sums over its elements; None for empty sets."""
    low = np.r_[np.uint64(0), np.cumsum(tx.mix(elements ^ _seed(1000)), dtype=np.uint64)]
    high = np.r_[np.uint64(0), np.cumsum(tx.mix(elements ^ _seed(2000)), dtype=np.uint64)]
    both = np.stack([low[place[1:]] - low[place[:-1]], high[place[1:]] - high[place[:-1]]], axis=1)
    body = np.ascontiguousarray(tx.mix(both)).tobytes()
    return [body[16 * i : 16 * i + 16] if n else None for i, n in enumerate(np.diff(place))]


def _rows_of_bytes(sketch: np.ndarray) -> pa.Array:
    """The lowest byte of each bin, one binary value a row."""
    body, width = sketch.astype(np.uint8).tobytes(), sketch.shape[1]
    return pa.array([body[width * i : width * (i + 1)] for i in range(len(sketch))], pa.binary())


def _sketch_batches(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, end, elements, place in _sets(batch["text"], size):
                counts = np.diff(place)
                sketch = sketches(elements, place)
                full = counts > 0
                offsets = np.zeros(end - first + 1, np.int32)
                np.cumsum(full * (COORDINATES // BAND_ROWS), out=offsets[1:])
                keys = band_keys(sketch[full]).reshape(-1).view(np.int64)
                yield pa.RecordBatch.from_pydict(
                    {
                        "id": batch["id"].slice(first, end - first),
                        "n": pa.array(counts, pa.int64()),
                        "node": pa.array(_fingerprints(elements, place), pa.binary()),
                        "bands": pa.ListArray.from_arrays(pa.array(offsets), pa.array(keys)),
                        "sketch": _rows_of_bytes(sketch),
                    }
                )

    return run


def _set_batches(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # A piece of short texts has many rows, each of which takes LONG numbers.
        for batch in (b.slice(at, ROWS) for b in batches for at in range(0, len(b), ROWS)):
            for first, end, elements, place in _sets(batch["text"], size):
                body = elements.tobytes()
                yield pa.RecordBatch.from_pydict(
                    {
                        "node": pa.array(_fingerprints(elements, place), pa.binary()),
                        "want": batch["want"].slice(first, end - first),
                        "long": _rows_of_bytes(sketches(elements, place, LONG)),
                        "elements": pa.array([body[8 * a : 8 * b] for a, b in zip(place[:-1], place[1:])], pa.binary()),
                    }
                )

    return run


def _equal_bins(a: pa.Array, b: pa.Array) -> pa.Array:
    left = np.frombuffer(b"".join(a.to_pylist()), np.uint8).reshape(-1, COORDINATES)
    right = np.frombuffer(b"".join(b.to_pylist()), np.uint8).reshape(-1, COORDINATES)
    return pa.array((left == right).sum(axis=1), pa.int32())


def _shared(a: pa.Array, b: pa.Array) -> pa.Array:
    # One pair at a time: a batch of whole sets is large already, and is not copied.
    sets = lambda x: np.frombuffer(x.as_buffer(), np.uint64)
    return pa.array([len(np.intersect1d(sets(x), sets(y), assume_unique=True)) for x, y in zip(a, b)], pa.int64())


def _tasks(df: DataFrame, rows: int) -> DataFrame:
    """Narrow rows, about ``rows`` of them, in as many tasks as they ask for, at least one a core.

    The session's shuffle partitions may cut a short table into many files that cost more than
    its rows; such a table is dealt once more before it is written. Larger ones stay as they are.
    """
    parts = max(df.sparkSession.sparkContext.defaultParallelism, -(-rows // TASK_ROWS))
    return df.repartition(parts) if parts < int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")) else df


def _salted(many: DataFrame, few: DataFrame, key: str) -> DataFrame:
    """Left join of nodes with a table of one row a key, in which a key may own most nodes."""
    salt = F.pmod(F.xxhash64("node"), F.lit(SALTS))
    copies = few.withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))))
    return many.withColumn("salt", salt).join(copies, [key, "salt"], "left").drop("salt")


def connected(links: DataFrame) -> DataFrame:
    """(node, root) of all nodes of ``links`` (a, b): root is the smallest node reachable.

    Each step takes the smallest root of a node and its neighbours and then that root's root,
    so the number of steps grows with the logarithm of a chain's length. Every node is its own
    neighbour too, so a step sums its edges once and joins nothing but the roots. Every step
    is written, so that a lost executor costs one step. ``links`` is counted, so it should be
    a written table.
    """
    rows = 2 * links.count()
    edges = links.select("a", "b").union(links.select("b", "a"))
    edges = edges.union(edges.select("a", F.col("a").alias("b")))
    both = materialize(_tasks(edges.distinct(), 2 * rows), "links")
    roots = materialize(_tasks(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("root")), rows), "roots")
    while True:
        near = (
            both.join(roots.select(F.col("node").alias("b"), "root"), "b")
            .groupBy(F.col("a").alias("node"))
            .agg(F.max(F.when(F.col("a") == F.col("b"), F.col("root"))).alias("root"), F.min("root").alias("near"))
        )
        jumps = roots.select(F.col("node").alias("near"), F.col("root").alias("far"))
        jumped = near.join(jumps, "near").select("node", "root", F.least("near", "far").alias("next"))
        jumped = materialize(_tasks(jumped, rows), "roots")
        done = jumped.where(F.col("root") != F.col("next")).isEmpty()
        roots = jumped.select("node", F.col("next").alias("root"))
        if done:
            return roots


def _least_equal(percent: int, bins: int) -> int:
    """Equal bins that a pair at the threshold reaches, less five standard deviations."""
    share = percent / 100
    return int(bins * (share - 5 * (share * (1 - share) / bins) ** 0.5))


def _side(table: DataFrame, name: str, *columns: str) -> DataFrame:
    return table.select(F.col("node").alias(name), *[F.col(c).alias(f"{c}_{name}") for c in columns])


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) of a written table whose full sets reach the threshold."""
    shared = F.arrow_udf(_shared, "long")
    links = (
        pairs.join(_side(sets, "a", "elements"), "a")
        .join(_side(sets, "b", "elements"), "b")
        .withColumn("common", shared("elements_a", "elements_b"))
        .withColumn("sizes", ((F.length("elements_a") + F.length("elements_b")) / 8).cast("long"))
        .where(100 * F.col("common") >= percent * (F.col("sizes") - F.col("common")))
        .select("a", "b")
    )
    return _tasks(links, pairs.count())


def _near_in_block(part: dict[str, np.ndarray], least: tuple[int, int], best: int | None) -> tuple[np.ndarray, np.ndarray]:
    """Positions of the near pairs of a block, or between two blocks."""
    short, long, bands, root, block = (part[c] for c in ("short", "long", "bands", "root", "block"))
    number = int(part["number"][0])
    one, two = int(block.min()), int(block.max())
    # Rows of a root stand together, and meet only rows of other roots.
    left = np.flatnonzero(block == one)
    left = left[np.argsort(root[left], kind="stable")]
    right = left if one == two else np.flatnonzero(block == two)
    found = []
    for low in range(0, len(left), 64):
        rows = left[low : low + 64]
        apart = root[rows][:, None] != root[right][None, :]
        if one == two:
            apart &= rows[:, None] < right[None, :]
        others = np.flatnonzero(apart.any(axis=0))
        if not len(others):
            continue
        same = short[rows][:, None, :] == short[right[others]][None, :, :]
        a, b = np.nonzero(apart[:, others] & (same.sum(axis=2, dtype=np.int16) >= least[0]))
        b = others[b]
        if number:
            # A pair counts in the first band it shares, by the keys that made the buckets.
            early = np.zeros(len(a), bool)
            for at in range(0, len(a), 1 << 13):
                x, y = rows[a[at : at + (1 << 13)]], right[b[at : at + (1 << 13)]]
                early[at : at + (1 << 13)] = (bands[x, :number] == bands[y, :number]).any(axis=1)
            a, b = a[~early], b[~early]
        for at in range(0, len(a), 1 << 13):
            x, y = rows[a[at : at + (1 << 13)]], right[b[at : at + (1 << 13)]]
            equal = (long[x] == long[y]).sum(axis=1)
            near = equal >= least[1]
            found.append(np.stack([x[near], y[near], equal[near]]))
    if not found:
        return left[:0], left[:0]
    x, y, equal = np.concatenate(found, axis=1)
    if best is not None:
        order = np.lexsort((-equal, x))
        x, y = x[order], y[order]
        keep = np.arange(len(x)) - np.searchsorted(x, x) < best
        x, y = x[keep], y[keep]
    return x, y


def _block_batches(least: tuple[int, int], best: int | None):
    """Near pairs of rows that come sorted by (band, i, j); groups have at most two blocks."""

    def near(part: pa.Table) -> pa.RecordBatch | None:
        keys = np.stack([part[c].to_numpy() for c in ("band", "i", "j")])
        edges = np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(axis=0)) + 1
        node = part["node"].combine_chunks()
        every = {
            "short": np.frombuffer(b"".join(part["sketch"].to_pylist()), np.uint8).reshape(-1, COORDINATES),
            "long": np.frombuffer(b"".join(part["long"].to_pylist()), np.uint8).reshape(-1, LONG),
            "bands": part["bands"].combine_chunks().flatten().to_numpy().reshape(-1, COORDINATES // BAND_ROWS),
            "root": part["root_no"].to_numpy(),
            "block": part["block"].to_numpy(),
            "number": part["number"].to_numpy(),
        }
        left, right = [], []
        for a, b in zip(np.r_[0, edges], np.r_[edges, len(node)]):
            if b - a > 1:
                x, y = _near_in_block({k: v[a:b] for k, v in every.items()}, least, best)
                left.append(x + a)
                right.append(y + a)
        if not left or not sum(map(len, left)):
            return None
        take = lambda rows: node.take(pa.array(np.concatenate(rows)))
        return pa.RecordBatch.from_pydict({"a": take(left), "b": take(right)})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            for at in range(0, len(batch), 4096):
                fresh = pa.Table.from_batches([batch.slice(at, 4096)])
                held = (fresh if held is None else pa.concat_tables([held, fresh])).combine_chunks()
                keys = np.stack([held[c].to_numpy() for c in ("band", "i", "j")])
                last = np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(axis=0))
                if len(last):
                    # All groups but the last are whole.
                    found = near(held.slice(0, int(last[-1]) + 1))
                    held = held.slice(int(last[-1]) + 1)
                    if found is not None:
                        yield found
        if held is not None and len(held):
            found = near(held.combine_chunks())
            if found is not None:
                yield found

    return run


def _ordered(left: Column, right: Column) -> list[Column]:
    return [F.least(left, right).alias("a"), F.greatest(left, right).alias("b")]


def near_duplicates(docs: DataFrame, size: int = 5, percent: int = 80, id_column: str = "doc_id") -> DataFrame:
    """Group rows whose sets of ``size``-word shingles overlap by ``percent`` or more.

    Words are runs without ASCII white space, A-Z in lower case. Returns the id column,
    n_shingles, component_id (smallest id of the group) and kept (id = component_id), as a
    written table; the tables made on the way are deleted.
    """
    ship(docs.sparkSession)
    return settled(docs.sparkSession, lambda: _grouped(docs, size, percent, id_column), "groups")


def _grouped(docs: DataFrame, size: int, percent: int, id_column: str) -> DataFrame:
    rows = docs.select(F.col(id_column).alias("id"), "text")
    id_type = rows.schema["id"].dataType.simpleString()
    table = materialize(
        rows.mapInArrow(
            _sketch_batches(size), f"id {id_type}, n long, node binary, bands array<long>, sketch binary"
        ),
        "sketches",
    )
    rows = table.count()
    members = table.where("node is not null")
    banded = members.groupBy("node").agg(F.first("bands").alias("bands"))
    banded = banded.select(F.posexplode("bands").alias("number", "band"), "node")
    sizes = banded.groupBy("band").agg(F.count(F.lit(1)).alias("nodes")).where("nodes > 1")
    shared = materialize(banded.join(sizes, "band"), "shared")
    # The middle of a group of edited copies meets more of them in its buckets than any copy does.
    middles = shared.groupBy("node").agg(F.sum("nodes").alias("met"))
    met = shared.join(middles, "node").select("band", "number", "node", "met")
    met = materialize(met, "met")
    hubs = met.groupBy("band").agg(F.max(F.struct("met", "node")).alias("top")).select("band", F.col("top.node").alias("hub"))
    live = materialize(met.drop("met").join(hubs, "band"), "live")
    roots = _roots(docs, id_column, table, live, size, percent)
    groups = members.groupBy("node").agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("rows"))
    groups = materialize(_tasks(groups, rows), "groups")
    rooted = groups.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    rooted = materialize(_tasks(rooted, rows), "rooted")
    by_root = (
        rooted.groupBy("root")
        .agg(F.min("first").alias("component"), F.count(F.lit(1)).alias("nodes"))
        .where("nodes > 1")
        .drop("nodes")
    )
    groups = _salted(rooted, materialize(_tasks(by_root, rows), "by_root"), "root").select(
        "node", F.coalesce("component", "first").alias("first"), (F.col("component").isNotNull() | (F.col("rows") > 1)).alias("shared")
    )
    groups = materialize(_tasks(groups.where("shared").select("node", "first"), rows), "groups")
    component = F.coalesce("first", "id")
    return table.join(groups, "node", "left").select(
        F.col("id").alias(id_column),
        F.col("n").alias("n_shingles"),
        component.alias("component_id"),
        F.col("id").eqNullSafe(component).alias("kept"),
    )


def _roots(docs: DataFrame, id_column: str, table: DataFrame, live: DataFrame, size: int, percent: int) -> DataFrame:
    """(node, root) of the nodes that have verified links."""
    rows = table.count()
    nodes = live.select("node").distinct()
    want = table.where("node is not null").groupBy("node").agg(
        F.min("id").alias("id"), F.first("sketch").alias("sketch"), F.first("bands").alias("bands")
    )
    want = materialize(want.join(nodes, "node", "left_semi"), "want")
    text_of = want.select(F.col("id").alias("want_id"), F.col("node").alias("want"))
    sets = (
        docs.select(F.col(id_column).alias("id"), "text")
        .join(text_of, F.col("id").eqNullSafe(F.col("want_id")))
        .select("text", "want")
        .mapInArrow(_set_batches(size), "node binary, want binary, long binary, elements binary")
        .where("node = want")
        .groupBy("node")
        .agg(F.first("long").alias("long"), F.first("elements").alias("elements"))
    )
    sets = materialize(sets, "sets")
    # The hubs of a node's buckets, those with most buckets first. No sketch is read
    # for this, and only nodes whose first hub is no link go on to the others.
    by_hub = live.where("node != hub").groupBy("node", "hub").agg(F.count(F.lit(1)).alias("bands"))
    hubs = (
        by_hub.groupBy("node")
        .agg(F.sort_array(F.collect_list(F.struct((-F.col("bands")).alias("few"), "hub"))).alias("hubs"))
        .select(F.col("node").alias("a"), F.slice("hubs.hub", 1, HUBS).alias("hubs"))
    )
    hubs = materialize(_tasks(hubs, rows), "hubs")
    equal = F.arrow_udf(_equal_bins, "int")

    def linked(pairs: DataFrame) -> DataFrame:
        alike = (
            pairs.join(_side(want, "a", "sketch"), "a")
            .join(_side(want, "b", "sketch"), "b")
            .where(equal("sketch_a", "sketch_b") >= _least_equal(percent, COORDINATES))
            .select("a", "b")
        )
        alike = materialize(_tasks(alike, HUBS * rows), "best")
        return materialize(_verified(alike, sets, percent), "found")

    links = linked(hubs.select("a", F.element_at("hubs", 1).alias("b")))
    others = hubs.join(links.select("a").distinct(), "a", "left_anti")
    links = links.unionByName(linked(others.select("a", F.explode(F.slice("hubs", 2, HUBS)).alias("b"))))
    long = sets.select("node", "long").join(want.select("node", "sketch", "bands"), "node")
    long = materialize(long, "long")
    roots = connected(links)
    for keep in (BEST, None):
        near = materialize(_near_pairs(live, roots, long, percent, keep), "near")
        found = materialize(_verified(near, sets, percent), "found")
        if not found.isEmpty():
            links = links.unionByName(found)
            roots = connected(links)
    return roots


def _near_pairs(live: DataFrame, roots: DataFrame, long: DataFrame, percent: int, best: int | None) -> DataFrame:
    """Pairs of nodes that share a bucket, lie in different components and look near."""
    rooted = live.join(roots, "node", "left").withColumn("root_no", F.xxhash64(F.coalesce("root", "node")))
    rooted = materialize(rooted.select("band", "number", "node", "root_no"), "rooted")
    open_ = rooted.groupBy("band").agg(
        F.count(F.lit(1)).alias("n"), F.min("root_no").alias("lo"), F.max("root_no").alias("hi")
    )
    open_ = open_.where("lo != hi").select("band", F.ceil(F.col("n") / BLOCK).cast("int").alias("blocks"))
    spread = rooted.join(materialize(_tasks(open_, live.count()), "open"), "band").withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    spread = spread.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    keys = [F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j")]
    least = (_least_equal(percent, COORDINATES), _least_equal(percent, LONG))
    return (
        spread.select("band", "number", "node", "root_no", "block", *keys)
        .join(long, "node")
        .repartition("band", "i", "j")
        .sortWithinPartitions("band", "i", "j")
        .mapInArrow(_block_batches(least, best), "a binary, b binary")
        .select(*_ordered(F.col("a"), F.col("b")))
        .distinct()
    )


ORACLE = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS w
  FROM documents),
s AS (
  SELECT DISTINCT doc_id, array_to_string(w[i : i + 2], ' ') AS x
  FROM (SELECT doc_id, w, unnest(generate_series(1, greatest(len(w) - 2, 1))) AS i FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS common FROM s a JOIN s b ON a.x = b.x AND a.doc_id <> b.doc_id GROUP BY 1, 2),
link AS (SELECT a, b FROM p JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b WHERE 100 * common >= 85 * (na.n + nb.n - common)),
walk AS (SELECT doc_id, doc_id AS other FROM d UNION SELECT walk.doc_id, link.b FROM walk JOIN link ON link.a = walk.other),
c AS (SELECT doc_id, min(other) AS component_id FROM walk GROUP BY doc_id)
SELECT d.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, c.component_id, d.doc_id = c.component_id AS kept
FROM d JOIN c USING (doc_id) LEFT JOIN n USING (doc_id)
"""
