"""Item vectors, user vectors and features built from them."""

from __future__ import annotations

from collections.abc import Callable
from math import ceil

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame, Observation, Window
from pyspark.sql import functions as F

from cartwise.functions.vectors import dot, norm, zeros
from cartwise.operators.ordering import HOT_ROWS, numbered
from cartwise.operators.stats import session_sequences
from cartwise.session import BROADCAST_BYTES, materialize, remove

DECAY = 0.1
# Most rows of a block; a task compares two blocks, a slice of the first at a time.
BLOCK = 8192
SLICE = 256
# Blocks are not made smaller than this for the sake of parallelism.
SMALL_BLOCK = 512
# Most cells of the exact index; their centres go to every task.
MOST_CELLS = 4096
# Most numbers of the sample that the centres are fitted on (128 MB).
SAMPLE_NUMBERS = 1 << 24
# The fit of item vectors: rounds over all buckets, items of a chunk of vectors, pairs of a
# batch and the contexts that all its pairs draw.
SWEEPS = 2
CHUNK = 8192
PAIRS = 512
SHARED = 64
STATE = "kind INT, part INT, chunk INT, ids BINARY, counts BINARY, body BINARY"


def fit_item_vectors(
    interactions: DataFrame,
    dim: int = 64,
    window: int = 5,
    min_count: int = 2,
    epochs: int = 10,
    seed: int = 42,
    partitions: int = 8,
    negative: int = 5,
    rate: float = 0.025,
) -> DataFrame:
    """Skip-gram vectors with negative sampling; whole orders are sentences and items words.

    Returns the written state that :func:`vectors_of` reads. Items are dealt to ``partitions``
    parts by hash, and the pairs of a centre and a context item to ``partitions`` squared
    buckets. A turn trains as many buckets side by side as there are parts, no two of which
    share a part on either side, so a task holds two parts of the vectors and one bucket of
    pairs, and nothing of the vocabulary reaches the driver. A bucket's pairs are met
    ``epochs`` times, in ``SWEEPS`` rounds of all turns. A pair at distance d weighs
    (window + 1 - d) / window, the chance that a random window holds it. The parts are fixed,
    so that the vectors do not depend on the size of the cluster.
    """
    spark = interactions.sparkSession
    counts = interactions.where("item_id IS NOT NULL").groupBy("item_id").agg(F.count(F.lit(1)).alias("n"))
    known = counts.where(F.col("n") >= min_count).withColumn(
        "part", F.pmod(F.xxhash64("item_id"), F.lit(partitions)).cast("int")
    )
    words = materialize(numbered(known, ["part"], [F.col("item_id")], "place"), "words")
    placed = words.select("item_id", (F.col("part") * (1 << 40) + F.col("place") - 1).alias("word"))
    # Rare items leave the orders before windows are laid.
    sentences = session_sequences(interactions.join(placed, "item_id").withColumn("item_id", F.col("word")))
    pairs = materialize(
        sentences.select("items")
        .mapInArrow(_pair_batches(window, partitions), "centre INT, context INT, pairs BINARY")
        .withColumn("turn", F.pmod(F.col("context") - F.col("centre"), F.lit(partitions))),
        "pairs",
        partition_by="turn",
    )
    chunk = F.floor((F.col("place") - 1) / CHUNK).cast("int")
    state = materialize(
        words.select("part", chunk.alias("chunk"), "item_id", "n")
        .repartitionById(partitions, F.col("part"))
        .sortWithinPartitions("part", "item_id")
        .mapInArrow(_first_vectors(dim, seed), STATE),
        "vectors",
    )
    passes = [epochs // SWEEPS + (sweep < epochs % SWEEPS) for sweep in range(SWEEPS)]
    seen = 0
    for sweep, times in enumerate(n for n in passes if n):
        rates = [rate * max(1e-4, 1 - (seen + k) / epochs) for k in range(times)]
        seen += times
        trained = state
        for turn in range(partitions):
            # Task t trains centres of part t on contexts of part t + turn.
            here = F.pmod(F.col("part") - F.col("kind") * turn, F.lit(partitions))
            both = trained.withColumn("task", here).unionByName(
                pairs.where(F.col("turn") == turn).select(
                    F.lit(2).alias("kind"),
                    F.col("centre").alias("part"),
                    F.lit(0).alias("chunk"),
                    F.lit(None).cast("binary").alias("ids"),
                    F.lit(None).cast("binary").alias("counts"),
                    F.col("pairs").alias("body"),
                    F.col("centre").alias("task"),
                )
            )
            train = _bucket_training(dim, window, negative, rates, seed + 1000 * sweep + turn)
            trained = (
                both.repartitionById(partitions, F.col("task"))
                .sortWithinPartitions("task", "kind", "chunk", F.xxhash64("body"))
                .drop("task")
                .mapInArrow(train, STATE)
            )
        # The turns of a round pass the vectors on by shuffles only.
        old, state = state, materialize(trained, "vectors")
        _forget(old)
    _forget(pairs)
    _forget(words)
    return state


def _forget(table: DataFrame) -> None:
    """Delete a written table that nothing reads any more."""
    for folder in {name.rsplit("/", 2 if "/turn=" in name else 1)[0] for name in table.inputFiles()}:
        remove(table.sparkSession, folder)


def _pair_batches(window: int, parts: int) -> Callable:
    """Batch function: orders to packed (place of centre, place of context, distance) by bucket."""
    kind = np.dtype([("centre", "<i4"), ("context", "<i4"), ("far", "u1")])

    def run(batches):
        for batch in batches:
            items = batch.column(0)
            words = items.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
            order = np.repeat(np.arange(len(items)), np.diff(items.offsets.to_numpy()))
            found = []
            for far in range(1, min(window, len(words) - 1) + 1):
                near = order[far:] == order[:-far]
                left, right = words[:-far][near], words[far:][near]
                found += [(left, right, far), (right, left, far)]
            if not found:
                continue
            a, b = (np.concatenate([f[i] for f in found]) for i in (0, 1))
            rows = np.empty(len(a), kind)
            rows["centre"], rows["context"] = a & ((1 << 40) - 1), b & ((1 << 40) - 1)
            rows["far"] = np.repeat([f[2] for f in found], [len(f[0]) for f in found])
            bucket = (a >> 40) * parts + (b >> 40)
            by = np.argsort(bucket, kind="stable")
            bucket, rows = bucket[by], rows[by]
            edges = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]]) if len(bucket) else []
            ends = np.r_[edges[1:], len(bucket)].astype(int) if len(bucket) else []
            yield pa.RecordBatch.from_pydict(
                {
                    "centre": pa.array([int(bucket[e]) // parts for e in edges], pa.int32()),
                    "context": pa.array([int(bucket[e]) % parts for e in edges], pa.int32()),
                    "pairs": pa.array([rows[e:f].tobytes() for e, f in zip(edges, ends)], pa.binary()),
                }
            )

    return run


def _state_batches() -> Callable:
    """Function that packs one row of the state; local, as the workers need not import this package."""
    names = [c.split()[0] for c in STATE.split(", ")]

    def pack(kind: int, part: int, chunk: int, ids: bytes, counts: bytes, body: np.ndarray) -> pa.RecordBatch:
        columns = [pa.array([int(v)], pa.int32()) for v in (kind, part, chunk)]
        columns += [pa.array([v], pa.binary()) for v in (ids, counts, body.astype("<f4", copy=False).tobytes())]
        return pa.RecordBatch.from_arrays(columns, names=names)

    return pack


def _first_vectors(dim: int, seed: int) -> Callable:
    """Batch function: sorted words of a part to chunks of centres (small random) and contexts (0)."""
    pack = _state_batches()

    def chunks(part: int, chunk: int, ids: np.ndarray, n: np.ndarray):
        start = np.random.default_rng([seed, part, chunk]).random((len(ids), dim), np.float32)
        known = ids.astype("<i8").tobytes(), n.astype("<f4").tobytes()
        yield pack(0, part, chunk, *known, (start - 0.5) / dim)
        yield pack(1, part, chunk, *known, np.zeros((len(ids), dim)))

    def run(batches):
        held = None
        for batch in batches:
            fresh = np.stack([batch.column(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in range(4)])
            held = fresh if held is None else np.concatenate([held, fresh], axis=1)
            ends = np.flatnonzero((held[:2, 1:] != held[:2, :-1]).any(axis=0)) + 1
            low = 0
            for end in ends:
                yield from chunks(*held[:2, low], held[2, low:end], held[3, low:end])
                low = end
            held = held[:, low:]
        if held is not None and held.shape[1]:
            yield from chunks(*held[:2, 0], held[2], held[3])

    return run


def _bucket_training(dim: int, window: int, negative: int, rates: list[float], seed: int) -> Callable:
    """Batch function: the state of two parts and the pairs of their bucket to the trained state.

    Every batch of pairs draws ``SHARED`` contexts by their counts to the power 3/4, which
    stand for ``negative`` draws of each of its pairs.
    """
    kind = np.dtype([("centre", "<i4"), ("context", "<i4"), ("far", "u1")])
    pack, pairs_of_batch, shared = _state_batches(), PAIRS, SHARED

    def moved(vectors: np.ndarray, rows: np.ndarray, steps: np.ndarray, rate: float) -> None:
        # Steps of a batch are taken at one point; many of one row would overshoot, so their
        # sum is at most their mean times 1 / rate.
        by = np.argsort(rows, kind="stable")
        ranked = rows[by]
        new = np.empty(len(rows), bool)
        new[0], new[1:] = True, ranked[1:] != ranked[:-1]
        first = np.flatnonzero(new)
        many = np.append(first[1:], len(rows)) - first
        alone = by[first[many == 1]]
        vectors[rows[alone]] += np.float32(rate) * steps[alone]
        if len(alone) < len(rows):
            rest = by[np.repeat(many > 1, many)]
            many, row = many[many > 1], ranked[first[many > 1]]
            total = np.add.reduceat(steps[rest], np.cumsum(many) - many, axis=0)
            vectors[row] += total * np.minimum(rate, 1 / many)[:, None].astype(np.float32)

    def slope(x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(x, -30, 30)))

    def trained(centres: np.ndarray, contexts: np.ndarray, counts: np.ndarray, pairs: np.ndarray) -> None:
        rng = np.random.default_rng([seed, len(centres), len(contexts), len(pairs)])
        chance = np.cumsum(counts.astype(float) ** 0.75)
        for rate in rates:
            order = rng.permutation(len(pairs))
            for low in range(0, len(pairs), pairs_of_batch):
                some = pairs[order[low : low + pairs_of_batch]]
                a, b = some["centre"], some["context"]
                weight = ((window + 1 - some["far"].astype(np.float32)) / np.float32(window))[:, None]
                drawn = np.searchsorted(chance, rng.random(shared) * chance[-1], "right")
                drawn = np.minimum(drawn, len(counts) - 1).astype(np.int32)
                u, v, w = centres[a], contexts[b], contexts[drawn]
                pull = weight * (1 - slope((u * v).sum(1, keepdims=True)))
                # A draw that is the pair's own context is none.
                push = -weight * slope(u @ w.T) * (drawn[None, :] != b[:, None]) * np.float32(negative / shared)
                moved(centres, a, pull * v + push @ w, rate)
                # A draw's step is the sum over the batch, that of about negative * pairs / shared draws.
                share = np.float32(min(1, 1 / (rate * max(1e-9, negative * len(some) / shared))))
                contexts_push = (push.T @ u) * share
                moved(contexts, b, pull * u, rate)
                np.add.at(contexts, drawn, np.float32(rate) * contexts_push)

    def run(batches):
        # Bodies are copied once, to the end of an array that grows in place.
        whole = {0: np.empty((0, dim), "<f4"), 1: np.empty((0, dim), "<f4"), 2: np.empty(0, kind)}
        heads = {0: [], 1: [], 2: []}
        # repartitionById gives every task one key, so a task is one pair of parts.
        for batch in batches:
            for i in range(batch.num_rows):
                which, *head, body = (column[i].as_py() for column in batch.columns)
                held, size = whole[which], len(whole[which])
                fresh = np.frombuffer(body, held.dtype).reshape(-1, *held.shape[1:])
                held.resize((size + len(fresh), *held.shape[1:]), refcheck=False)
                held[size:] = fresh
                if which < 2:
                    heads[which].append((*head, len(fresh)))
        if not heads[0] and not heads[1]:
            return
        if len(whole[2]):
            counts = np.concatenate([np.frombuffer(c[3], "<f4") for c in heads[1]])
            trained(whole[0], whole[1], counts, whole[2])
        for k in (0, 1):
            low = 0
            for part, chunk, ids, counts, size in heads[k]:
                yield pack(k, part, chunk, ids, counts, whole[k][low : low + size])
                low += size

    return run


def vectors_of(fitted: DataFrame) -> DataFrame:
    """Fitted vectors as (item_id, vec)."""

    def run(batches):
        for batch in batches:
            for ids, body in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                items = np.frombuffer(ids, "<i8")
                values = np.frombuffer(body, "<f4").astype(float)
                at = np.arange(0, len(values) + 1, len(values) // len(items), dtype=np.int32)
                yield pa.RecordBatch.from_pydict(
                    {"item_id": pa.array(items), "vec": pa.ListArray.from_arrays(pa.array(at), pa.array(values))}
                )

    centres = fitted.where("kind = 0").select("ids", "body")
    return centres.mapInArrow(run, "item_id BIGINT, vec ARRAY<DOUBLE>")


def lookup_vectors(
    df: DataFrame, vectors: DataFrame, key: str = "item_id", dim: int = 64
) -> DataFrame:
    """Adds ``vec``; ids without a vector get zeros."""
    return df.join(vectors, key, "left").withColumn("vec", F.coalesce("vec", zeros(dim)))


def recency_rank(interactions: DataFrame, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Adds ``age``: how many later lines the user has, 0 for the newest."""
    newest_first = [
        F.col(c).desc() for c in ("timestamp", "position_in_cart", "item_id", "line_key")
    ]
    slim = interactions.select("user_id", "item_id", "timestamp", "position_in_cart", "line_key")
    return numbered(slim, ["user_id"], newest_first, "age", hot_rows).withColumn(
        "age", F.col("age") - 1
    )


def user_vectors(
    interactions: DataFrame,
    vectors: DataFrame,
    recency_weight: bool = True,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Weighted mean of the vectors of a user's items, newer items weighing more.

    Ages count all items, the mean runs over those with a vector, and users
    without any are left out. Ages count from the user's newest item with a
    vector, which leaves the mean as it is and keeps the weights from vanishing.
    The sums combine map-side, one buffer per user and task, so a user's history is
    never gathered. Lines that tie up to the line key hold the same item, so their order
    changes nothing and the key stays behind.
    """
    vectors = _sent_if_small(vectors)
    if recency_weight:
        newest_first = [F.col(c).desc() for c in ("timestamp", "position_in_cart", "item_id")]
        slim = interactions.select("user_id", "item_id", "timestamp", "position_in_cart")
        ranked = numbered(slim, ["user_id"], newest_first, "age", hot_rows)
        known = ranked.select("user_id", "item_id", F.col("age") - 1).toDF("user_id", "item_id", "age").join(
            vectors.select("item_id"), "item_id", "left_semi"
        )
        newest = known.groupBy("user_id").agg(F.min("age").alias("newest"))
        lines = known.join(newest, "user_id").withColumn(
            "weight", F.exp(F.lit(-DECAY) * (F.col("age") - F.col("newest")))
        )
    else:
        lines = interactions.select("user_id", "item_id").withColumn("weight", F.lit(1.0))
    return (
        lines.join(vectors.where("vec IS NOT NULL"), "item_id")
        .groupBy("user_id")
        .agg(Summarizer.mean(array_to_vector("vec"), F.col("weight")).alias("mean"))
        .select("user_id", vector_to_array("mean").alias("vec"))
    )


def add_embedding_features(
    df: DataFrame, vectors: DataFrame, user_vecs: DataFrame
) -> DataFrame:
    """Adds user_item_similarity, item_embedding_norm and user_embedding_norm.

    Norms are taken once per vector, before the join with the candidates, and the
    vectors are dropped as soon as the product is known. Vector tables that are small by
    their counted rows go to the candidates, which then stay where they are.
    """
    user_vecs = materialize(user_vecs, "user_vectors")
    item_side = _sent_if_small(vectors).select(
        "item_id", F.col("vec").alias("_iv"), norm(F.col("vec")).alias("item_embedding_norm")
    )
    user_side = _sent_if_small(user_vecs).select(
        "user_id", F.col("vec").alias("_uv"), norm(F.col("vec")).alias("user_embedding_norm")
    )
    return (
        df.join(user_side, "user_id", "left")
        .join(item_side, "item_id", "left")
        .withColumn("user_item_similarity", dot(F.col("_uv"), F.col("_iv")))
        .drop("_uv", "_iv")
        .fillna(0.0, ["item_embedding_norm", "user_embedding_norm"])
    )


def _sent_if_small(vectors: DataFrame) -> DataFrame:
    """Hint a broadcast of (id, vec) rows if their counted numbers fit the bound."""
    rows, numbers = vectors.agg(F.count(F.lit(1)), F.sum(F.greatest(F.size("vec"), F.lit(0)))).first()
    return F.broadcast(vectors) if 64 * rows + 8 * (numbers or 0) <= BROADCAST_BYTES else vectors


def cart_vectors(carts: DataFrame, vectors: DataFrame) -> DataFrame:
    """Mean vector of each cart; lines without a vector count as zeros."""
    sizes = carts.groupBy("session_id").agg(F.count(F.lit(1)).alias("_lines"))
    return (
        carts.join(vectors.where("vec IS NOT NULL"), "item_id")
        .groupBy("session_id")
        .agg(
            Summarizer.mean(array_to_vector("vec")).alias("mean"),
            F.count(F.lit(1)).alias("_known"),
        )
        .join(sizes, "session_id")
        .select(
            "session_id",
            F.transform(
                vector_to_array("mean"), lambda x: x * F.col("_known") / F.col("_lines")
            ).alias("cart_vec"),
        )
    )


def add_cart_similarity(df: DataFrame, carts: DataFrame, vectors: DataFrame) -> DataFrame:
    """Adds cart_item_similarity: product of the mean cart vector and the candidate's."""
    vectors = _sent_if_small(vectors)
    return (
        df.join(cart_vectors(carts, vectors), "session_id", "left")
        .join(vectors.withColumnRenamed("vec", "_iv"), "item_id", "left")
        .withColumn("cart_item_similarity", dot(F.col("cart_vec"), F.col("_iv")))
        .drop("cart_vec", "_iv")
    )


def _block_top(top_n: int) -> Callable[[pd.DataFrame, pd.DataFrame], pd.DataFrame]:
    """Function for one block pair: the best right-hand items of every left-hand item.

    It is local, so it travels to the workers by value and they need not import
    this package.
    """

    def compare(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        found = {"item_id": [], "other_id": [], "similarity": []}
        if not left.empty and not right.empty:
            ids, others = left["item_id"].to_numpy(), right["item_id"].to_numpy()
            a, b = np.stack(left["vec"].to_numpy()), np.stack(right["vec"].to_numpy())
            keep = min(top_n, len(others))
            for start in range(0, len(ids), SLICE):
                own = ids[start : start + SLICE]
                # Equal vectors may differ in the last bits by position; ties go to the
                # lower id.
                scores = np.round(a[start : start + SLICE] @ b.T, 9) + 0.0
                scores[own[:, None] == others[None, :]] = -np.inf
                limit = np.partition(scores, -keep, axis=1)[:, -keep]
                row, col = np.nonzero((scores >= limit[:, None]) & np.isfinite(scores))
                value = scores[row, col]
                order = np.lexsort((others[col], -value, row))
                row, col, value = row[order], col[order], value[order]
                place = np.arange(len(row)) - np.searchsorted(row, row)
                best = place < keep
                found["item_id"].append(own[row[best]])
                found["other_id"].append(others[col[best]])
                found["similarity"].append(value[best])
        return pd.DataFrame(
            {
                name: np.concatenate(parts) if parts else np.array([], dtype="float64")
                for name, parts in found.items()
            }
        ).astype({"item_id": "int64", "other_id": "int64"})

    return compare


def _centroids(vectors: DataFrame, cells: int, rounds: int = 5) -> np.ndarray:
    """Up to ``cells`` centres by a few rounds of Lloyd's method on a bounded sample.

    The sample is at most ``SAMPLE_NUMBERS`` numbers, the rows with the smallest hashes.
    Centres only decide how much is skipped, never the result.
    """
    dim = vectors.select(F.max(F.size("vec"))).first()[0]
    size = max(cells, min(64 * cells, SAMPLE_NUMBERS // max(1, dim)))
    sample = vectors.orderBy(F.xxhash64("item_id"), "item_id").limit(size).select("vec").toPandas()
    points = np.stack(sample["vec"].to_numpy())
    centres = points[:cells].copy()
    for _ in range(rounds):
        near = np.argmin((centres**2).sum(1)[None, :] - 2 * points @ centres.T, axis=1)
        for cell in np.unique(near):
            centres[cell] = points[near == cell].mean(0)
    return centres


def _placing(centres: np.ndarray) -> Callable:
    """Batch function: the nearest centre of each vector and the distance to it."""

    def place(batches):
        for batch in batches:
            points = np.stack(batch["vec"].to_numpy())
            far = (points**2).sum(1)[:, None] + (centres**2).sum(1)[None, :] - 2 * points @ centres.T
            cell = np.argmin(far, axis=1)
            gap = np.sqrt(((points - centres[cell]) ** 2).sum(1))
            yield batch.assign(cell=cell.astype("int32"), gap=gap)

    return place


def _needing(centres: np.ndarray, cells: np.ndarray, radius: np.ndarray) -> Callable:
    """Batch function: the cells, home apart, that may hold one of a vector's best items.

    No item of a cell has a larger product with a vector than the centre's product plus
    length times radius.
    """

    def choose(batches):
        for batch in batches:
            points = np.stack(batch["vec"].to_numpy())
            length = np.sqrt((points**2).sum(1))[:, None]
            reach = np.sqrt((centres[cells] ** 2).sum(1))[None, :] + radius[None, :]
            bound = points @ centres[cells].T + length * radius[None, :]
            # Products are rounded to nine digits, and centres to machine precision.
            slack = 2e-9 + 1e-12 * length * reach
            wanted = bound + slack >= batch["least"].to_numpy()[:, None]
            wanted &= batch["cell"].to_numpy()[:, None] != cells[None, :]
            yield batch[["item_id", "vec"]].assign(cells=[cells[row] for row in wanted])

    return choose


def _cell_pairs(left: DataFrame, right: DataFrame, sizes: DataFrame, top_n: int) -> DataFrame:
    """The best items of each left row (item_id, vec, cell) within its cell.

    ``sizes`` has cell, lefts and rights: into how many blocks either side of a cell is cut,
    so that no task holds more than two blocks however many rows a cell has.
    """
    number = lambda column: F.pmod(F.xxhash64("item_id"), F.col(column))
    all_of = lambda column: F.explode(
        F.sequence(F.lit(0).cast("long"), F.col(column) - 1)
    )
    small = F.broadcast(sizes)
    # Fresh columns: both sides may come from one written table.
    left = left.select(*[F.col(c).alias(c) for c in ("item_id", "vec", "cell")])
    a = left.join(small, "cell").select(
        "item_id", "vec", "cell", number("lefts").alias("lb"), all_of("rights").alias("rb")
    )
    b = right.join(small, "cell").select(
        "item_id", "vec", "cell", number("rights").alias("rb"), all_of("lefts").alias("lb")
    )
    keys = ["cell", "lb", "rb"]
    return (
        a.groupBy(*keys)
        .cogroup(b.groupBy(*keys))
        .applyInPandas(_block_top(top_n), "item_id BIGINT, other_id BIGINT, similarity DOUBLE")
    )


def _nearest_by_cells(
    vectors: DataFrame,
    left: DataFrame,
    top_n: int,
    block: int,
    cells: int,
    observation: Observation | None,
) -> DataFrame:
    """Exact nearest items through cells of nearby vectors.

    Every row is compared with its own cell first, which gives a least score for its list;
    then only with the cells whose bound reaches that score.
    """
    spark = vectors.sparkSession
    centres = _centroids(vectors, cells)
    kinds = "item_id BIGINT, vec ARRAY<DOUBLE>"
    placed = materialize(
        vectors.mapInPandas(_placing(centres), f"{kinds}, cell INT, gap DOUBLE"), "cells"
    )
    # One row a cell: ``cells`` bounds them.
    facts = placed.groupBy("cell").agg(F.max("gap").alias("radius"), F.count("*").alias("n")).toPandas()
    rights = dict(zip(facts["cell"], facts["n"]))

    def sizes(rows: DataFrame) -> DataFrame:
        counted = rows.groupBy("cell").agg(F.count("*").alias("n")).collect()
        return spark.createDataFrame(
            [(r["cell"], ceil(r["n"] / block), ceil(int(rights[r["cell"]]) / block)) for r in counted],
            "cell INT, lefts BIGINT, rights BIGINT",
        )

    own = placed.join(left.select("item_id"), "item_id", "left_semi").drop("gap")
    home = materialize(
        top_similar(_cell_pairs(own, placed, sizes(own), top_n), top_n).drop("rank"), "home"
    )
    least = home.groupBy("item_id").agg(
        F.when(F.count("*") == top_n, F.min("similarity")).alias("least")
    )
    asked = own.join(least, "item_id", "left").fillna(float("-inf"), ["least"])
    needed = asked.mapInPandas(
        _needing(centres, facts["cell"].to_numpy(), facts["radius"].to_numpy()),
        f"{kinds}, cells ARRAY<INT>",
    )
    if observation is not None:
        needed = needed.observe(
            observation,
            F.coalesce(F.sum(F.size("cells") + 1), F.lit(0)).alias("compared"),
            (F.count(F.lit(1)) * len(facts)).alias("pairs"),
        )
    needed = materialize(needed, "needed").select("item_id", "vec", F.explode("cells").alias("cell"))
    return home.unionByName(_cell_pairs(needed, placed, sizes(needed), top_n))


def nearest_items(
    vectors: DataFrame,
    top_n: int = 10,
    cosine: bool = True,
    queries: DataFrame | None = None,
    block: int = BLOCK,
    observation: Observation | None = None,
) -> DataFrame:
    """The ``top_n`` most similar other items of each item, exactly.

    Tables of more than ``block`` vectors are dealt to cells around centres, at most
    ``MOST_CELLS``, and a row meets a cell other than its own only if a bound on the products
    there reaches the worst of the best it has. Smaller tables are cut into blocks, and every
    pair of blocks is one matrix product. Either way a task holds two blocks at most and
    passes on only the best items per row. ``queries`` (item_id) restricts the left side; ids
    without a vector give no rows. ``observation`` counts the (row, cell) ``pairs`` of a table
    with cells and those ``compared``.
    """
    if cosine:
        length = norm(F.col("vec"))
        vectors = vectors.select(
            "item_id",
            F.when(length > 0, F.transform("vec", lambda x: x / length))
            .otherwise(F.col("vec"))
            .alias("vec"),
        )
    vectors = vectors.select("item_id", F.col("vec").cast("array<double>").alias("vec"))
    left = vectors.select(F.col("item_id").alias("item_id"), F.col("vec").alias("vec"))
    if queries is not None:
        left = left.join(queries.select("item_id").distinct(), "item_id", "left_semi")
    rows = vectors.count()
    if rows > block:
        cells = min(MOST_CELLS, ceil(rows / block))
        return top_similar(_nearest_by_cells(vectors, left, top_n, block, cells, observation), top_n)
    cores = vectors.sparkSession.sparkContext.defaultParallelism
    # Pairs of blocks are the tasks: about one per core.
    blocks = max(1, min(rows // SMALL_BLOCK, ceil(cores**0.5)))
    every = F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))
    place = F.pmod(F.xxhash64("item_id"), F.lit(blocks)).cast("int")
    left_side = left.withColumn("lb", place).withColumn("rb", every)
    right_side = vectors.withColumn("rb", place).withColumn("lb", every)

    best = (
        left_side.groupBy("lb", "rb")
        .cogroup(right_side.groupBy("lb", "rb"))
        .applyInPandas(_block_top(top_n), "item_id BIGINT, other_id BIGINT, similarity DOUBLE")
    )
    return top_similar(best, top_n)


def top_similar(scored: DataFrame, top_n: int) -> DataFrame:
    order = Window.partitionBy("item_id").orderBy(F.desc("similarity"), "other_id")
    return scored.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top_n)


def similar_items(
    vectors: DataFrame, top_n: int = 10, queries: DataFrame | None = None, block: int = BLOCK
) -> DataFrame:
    """Nearest items by cosine similarity."""
    return nearest_items(vectors, top_n, True, queries, block)


def embedding_neighbors(
    vectors: DataFrame, top_n: int = 10, queries: DataFrame | None = None, block: int = BLOCK
) -> DataFrame:
    """Nearest items by inner product, the candidates for hard negatives."""
    return nearest_items(vectors, top_n, False, queries, block)


def embedding_tables(
    interactions: DataFrame, dim: int = 64, **options
) -> tuple[DataFrame, DataFrame]:
    """Fitted item vectors and the user vectors built from them."""
    vectors = vectors_of(fit_item_vectors(interactions, dim=dim, **options))
    return vectors, user_vectors(interactions, vectors)
