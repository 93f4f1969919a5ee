"""Mixing overlapping sources to target weights by a min-cost flow.

Documents are grouped by their membership pattern (the set of sources they belong to).
Words flow from patterns to the quotas of their sources. A pattern supplies its size once
at no cost, a second time at cost one, and so on up to ``max_repeats`` (convex repetition
costs), so the flow fills quotas from fresh words first and repeats only what it must. As
all costs lie on the arcs into patterns, level after level of maximum flow is a min-cost
flow. The network has one node for each pattern and source, never for documents.

Documents of a pattern are then taken whole, in the order of a seeded MD5 of their id: all
of them once for every full copy, and a prefix of that order for the rest, as long as the
middle of the document lies below what is left. The end of the prefix is found by sums
over the next three hex digits of the order key, refined until the digits leave at most
``BUCKET_ROWS`` documents; no pattern is ever sorted in one task.

Rows: each row is a document, repeated rows too; rows of one id are taken alike. Null text: no words. Null id: keyed as the empty text. Null source: a source of its
own, last in order. Empty table: no rows. Other columns of the input are ignored by
``mix_by_source`` and kept by ``select_documents``.
"""

from __future__ import annotations

from collections import deque

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cartwise.llm import text as tx
from cartwise.session import materialize, settled

BUCKET_ROWS = 4096
DIGITS = 3
#: Sources and patterns are configuration-sized; more of them stop the job.
MAX_NODES = 100_000

Pattern = tuple[str | None, ...]


def fill_targets(sizes: dict[str | None, int], weights: list[float], share: float, cap: float) -> dict[str | None, float]:
    """Targets in words: ``share`` of all sizes by weight, at most ``cap`` sizes each.

    Sources in code-point order, null last, get the weights in turn; what a cap cuts off
    goes to the others by weight until none is above its cap.
    """
    names = sorted((s for s in sizes if s is not None), key=lambda s: [ord(c) for c in s])
    names += [None] if None in sizes else []
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    left, total = share * sum(sizes.values()), sum(weight.values())
    # In the order in which the rising level reaches the caps.
    order = sorted(names, key=lambda s: (cap * sizes[s] / weight[s], names.index(s)))
    level = 0.0
    for s in order:
        level = left / total
        if cap * sizes[s] >= level * weight[s]:
            break
        left, total = left - cap * sizes[s], total - weight[s]
    return {s: min(cap * sizes[s], level * weight[s]) for s in names}


def route(sizes: dict[Pattern, int], quotas: dict[str | None, float], max_repeats: int) -> dict[tuple[Pattern, str | None], float]:
    """Words from each pattern to each of its sources: a min-cost flow (see above)."""
    flow = {(p, s): 0.0 for p in sizes for s in p if s in quotas}
    of: dict[str | None, list[Pattern]] = {}
    for p, s in flow:
        of.setdefault(s, []).append(p)
    need = dict(quotas)
    tiny = 1e-9 * max(1.0, sum(quotas.values()))
    for _ in range(max_repeats):
        supply = {p: float(n) for p, n in sizes.items()}
        while True:
            # Shortest augmenting path: pattern with supply, source, pattern that gives way, ...
            parent: dict[tuple, tuple | None] = {("p", p): None for p, n in supply.items() if n > tiny}
            queue, end = deque(parent), None
            while queue and end is None:
                kind, name = node = queue.popleft()
                if kind == "p":
                    nodes = [("s", s) for s in dict.fromkeys(name) if (name, s) in flow]
                else:
                    if need[name] > tiny:
                        end = node
                        break
                    nodes = [("p", p) for p in of[name] if flow[p, name] > tiny]
                for other in nodes:
                    if other not in parent:
                        parent[other] = node
                        queue.append(other)
            if end is None:
                break
            path = [end]
            while parent[path[-1]] is not None:
                path.append(parent[path[-1]])
            path.reverse()
            amount = min(supply[path[0][1]], need[end[1]])
            for a, b in zip(path, path[1:]):
                if a[0] == "s":
                    amount = min(amount, flow[b[1], a[1]])
            for a, b in zip(path, path[1:]):
                if a[0] == "p":
                    flow[a[1], b[1]] += amount
                else:
                    flow[b[1], a[1]] -= amount
            supply[path[0][1]] -= amount
            need[end[1]] -= amount
    return flow


def _sized(docs: DataFrame, members: Column, seed: str, *more: str) -> DataFrame:
    """The narrow table of all documents: key, pattern and size (and columns asked for)."""
    key = F.md5(F.concat(F.lit(f"{seed}|"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))))
    return docs.select(
        "doc_id",
        F.array_sort(F.array_distinct(members)).alias("pattern"),
        F.regexp_count(F.coalesce(F.col("text"), F.lit("")), F.lit(tx.WORD)).cast("long").alias("size"),
        key.alias("key"),
        *more,
    )


def find_cuts(table: DataFrame, copies: dict[Pattern, int], rest: dict[Pattern, float]) -> DataFrame:
    """For each pattern its full copies and where the prefix for the rest ends.

    ``table`` is written and has pattern, key, doc_id and size. Columns: pattern, full,
    digits (keys below them are in the prefix) and last (the last key and id in the prefix
    among the keys that start with digits; null for none).
    """
    spark = table.sparkSession
    rows = [(list(p), copies[p], float(q)) for p, q in rest.items()]
    quotas = spark.createDataFrame(rows, "pattern array<string>, full int, rest double")
    before = Window.partitionBy("pattern").orderBy("digits").rowsBetween(Window.unboundedPreceding, -1)
    cut = quotas.select("pattern", "rest", F.lit("").alias("digits"), F.lit(0).cast("long").alias("below"))
    depth = 0
    while True:
        inside = table.select("pattern", "key", "size").join(F.broadcast(cut), "pattern")
        inside = inside.where(F.col("key").startswith(F.col("digits")))
        depth = min(32, depth + DIGITS)
        # At most 4096 rows for each pattern: one for each value of the next digits.
        sums = inside.groupBy("pattern", "rest", "below", F.substring("key", 1, depth).alias("digits")).agg(
            F.sum("size").alias("words"), F.count(F.lit(1)).alias("n")
        )
        start = F.col("below") + F.coalesce(F.sum("words").over(before), F.lit(0))
        found = (
            sums.withColumn("start", start)
            .where(F.col("start") <= F.col("rest"))
            .groupBy("pattern", "rest")
            .agg(F.max(F.struct("digits", "start", "words", "n")).alias("c"))
            .select("pattern", "rest", "c.digits", F.col("c.start").alias("below"), "c.words", "c.n")
        )
        found = materialize(found, "cut")
        cut = found.drop("n", "words")
        if depth == 32 or found.where(F.col("n") > BUCKET_ROWS).isEmpty():
            break
    edge = table.join(F.broadcast(found), "pattern").where(F.substring("key", 1, depth) == F.col("digits"))
    sum_before = Window.partitionBy("pattern").orderBy("key", "doc_id").rowsBetween(Window.unboundedPreceding, -1)
    few = edge.where(F.col("n") <= BUCKET_ROWS).withColumn(
        "start", F.col("below") + F.coalesce(F.sum("size").over(sum_before), F.lit(0))
    )
    # More rows than that with all digits alike are rows of one id: taken all or not at all.
    many = edge.where(F.col("n") > BUCKET_ROWS).withColumn("start", F.col("below") + (F.col("words") - F.col("size")) / 2)
    last = (
        few.select("pattern", "key", "doc_id", "size", "start", "rest")
        .unionByName(many.select("pattern", "key", "doc_id", "size", "start", "rest"))
        .where(F.col("start") + F.col("size") / 2 <= F.col("rest"))
        .groupBy("pattern")
        .agg(F.max(F.struct("key", "doc_id")).alias("last"))
    )
    return materialize(
        quotas.select("pattern", "full").join(cut.select("pattern", "digits"), "pattern", "left").join(last, "pattern", "left"),
        "cuts",
    )


def with_copies(rows: DataFrame, cuts: DataFrame) -> DataFrame:
    """Add ``copies`` to rows with pattern, key and doc_id, row by row.

    ``cuts`` has one row a pattern, at most ``MAX_NODES``, so it goes to every task.
    """
    at = F.substring(F.col("key"), F.lit(1), F.length("digits"))
    inside = (at < F.col("digits")) | ((at == F.col("digits")) & (F.struct("key", "doc_id") <= F.col("last")))
    more = F.coalesce(inside.cast("int"), F.lit(0))
    return rows.join(F.broadcast(cuts), "pattern").withColumn("copies", F.col("full") + more).drop("full", "digits", "last")


def _collected(rows: DataFrame, what: str) -> list:
    found = rows.limit(MAX_NODES + 1).collect()
    if len(found) > MAX_NODES:
        raise ValueError(f"more than {MAX_NODES} {what}: mix them by a coarser name")
    return found


def plan_mix(
    docs: DataFrame,
    members: Column,
    weights: list[float],
    share: float = 1.5,
    cap: float = 2.0,
    max_repeats: int = 2,
    seed: str = "mix",
) -> tuple[DataFrame, DataFrame, dict, dict]:
    """(sized table, cuts of the patterns, sizes and targets of the sources)."""
    table = materialize(_sized(docs, members, seed), "sized")
    patterns = _collected(table.groupBy("pattern").agg(F.sum("size").alias("n")), "patterns")
    sizes = {tuple(r["pattern"]): int(r["n"]) for r in patterns}
    sources: dict[str | None, int] = {}
    for p, n in sizes.items():
        for s in p:
            sources[s] = sources.get(s, 0) + n
    targets = fill_targets(sources, weights, share, cap)
    taken = {p: 0.0 for p in sizes}
    for (p, _), n in route(sizes, targets, max_repeats).items():
        taken[p] += n
    copies = {p: int(words // sizes[p]) if sizes[p] else 0 for p, words in taken.items()}
    rest = {p: words - copies[p] * sizes[p] for p, words in taken.items()}
    return table, find_cuts(table, copies, rest), sources, targets


def mix_by_source(docs: DataFrame, weights: tuple[float, ...] = (3, 1, 2), share: float = 1.5, cap: float = 2.0) -> DataFrame:
    """doc_id, size, source_size, target and taken (words, repeats counted) of every row."""
    table, cuts, sources, targets = plan_mix(docs, F.array("source"), list(weights), share, cap)
    facts = docs.sparkSession.createDataFrame(
        [([s], int(n), float(targets[s])) for s, n in sources.items()],
        "pattern array<string>, source_size long, target double",
    )
    return with_copies(table, cuts).join(F.broadcast(facts), "pattern").select(
        "doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).cast("long").alias("taken")
    )


def select_documents(
    docs: DataFrame,
    weights: tuple[float, ...] = (3, 1, 2),
    share: float = 1.5,
    cap: float = 2.0,
    members: Column | None = None,
) -> DataFrame:
    """The documents that the mix takes, with all their columns and ``mix_copies``.

    ``members`` is an array of the sources a document belongs to; by default its source.
    """
    members = F.array("source") if members is None else members
    cuts = settled(docs.sparkSession, lambda: plan_mix(docs, members, list(weights), share, cap)[1], "cuts")
    # One column for all others, under a name that none of them has.
    taken = {c.lower() for c in docs.columns}
    whole = "doc" + "_" * max((len(c) for c in taken if c.strip("_") == "doc"), default=0)
    every = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias(whole)
    narrow = _sized(docs.select("*", every), members, "mix", whole).drop("size")
    chosen = with_copies(narrow, cuts).where("copies > 0")
    return chosen.select(*[F.col(f"{whole}.`{c}`").alias(c) for c in docs.columns], F.col("copies").alias("mix_copies"))


ORACLE = r"""
WITH d AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
         md5('mix|' || coalesce(CAST(doc_id AS VARCHAR), '')) AS key
  FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
w AS (
  SELECT source, source_size,
         CASE (row_number() OVER (ORDER BY encode(source) NULLS LAST) - 1) % 3 WHEN 0 THEN 3 WHEN 1 THEN 1 ELSE 2 END AS weight,
         row_number() OVER (ORDER BY encode(source) NULLS LAST) AS place
  FROM s),
l AS (
  SELECT *, (1.5 * sum(source_size) OVER () - coalesce(sum(2.0 * source_size) OVER before, 0))
            / (sum(weight) OVER () - coalesce(sum(weight) OVER before, 0)) AS level
  FROM w WINDOW before AS (ORDER BY 2.0 * source_size / weight, place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
t AS (
  SELECT source, source_size, least(2.0 * source_size, weight *
         coalesce((SELECT arg_min(level, 2.0 * source_size / weight) FROM l WHERE 2.0 * source_size >= level * weight),
                  (SELECT max(level) FROM l))) AS target
  FROM l),
o AS (
  SELECT d.doc_id, d.size, t.source_size, t.target,
         CASE WHEN t.source_size > 0 THEN floor(t.target / t.source_size) ELSE 0 END AS full_copies,
         coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY d.key, d.doc_id
                  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, CAST(target AS DOUBLE) AS target,
       CAST(size * (full_copies + CASE WHEN start + size / 2.0 <= target - full_copies * source_size THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM o
"""
