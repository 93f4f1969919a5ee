"""Negative sampling inside a restaurant's menu.

Menu items are numbered 0..m-1, so a sample is a set of numbers drawn per
positive row; its cost depends on the sample size, not on the menu size. Menus
are stored in pages of at most ``PAGE`` items. A positive meets only the pages
its numbers fall on, and the fan-out to one row per negative happens after that
join, without a shuffle of the fanned-out rows. What is known about an item travels
with its place on the menu (``attributes``), so that those rows need no join either.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cartwise.functions.hashing import step, stream
from cartwise.operators.split import positives
from cartwise.operators.stats import item_popularity
from cartwise.session import BROADCAST_BYTES

PAGE = 256
# Item numbers are assigned in this many chunks per restaurant, each a task of its own.
CHUNKS = 64
# Most bytes that an item, with number and weight, and a menu take in a broadcast table.
ITEM_BYTES = 32
MENU_BYTES = 64
# Menu items that share one stream of random numbers in a weighted draw.
RACE = 256

SAMPLE_COLUMNS = (
    "order_id", "session_id", "line_key", "user_id", "item_id", "restaurant_id",
    "timestamp", "position_in_cart",
)


def menu_index(
    items: DataFrame, weight: str | None = None, by_number: bool = False
) -> DataFrame:
    """Place of each item in its restaurant's menu, a set of items.

    Adds ``start`` (sum of the weights before the item; its number when the weight
    is 1 or with ``by_number``), ``menu_size`` and ``menu_weight``. The order is (item_id mod CHUNKS,
    item_id): chunks are numbered in parallel, then shifted by the chunks before.
    """
    value = F.col(weight) if weight else F.lit(1).cast("long")
    placed = (
        items.where(F.col("item_id").isNotNull() & F.col("restaurant_id").isNotNull())
        .groupBy("restaurant_id", "item_id")
        .agg(F.max(value).alias("w"))
        .withColumn("_chunk", F.pmod("item_id", F.lit(CHUNKS)))
    )
    chunks = placed.groupBy("restaurant_id", "_chunk").agg(
        F.sum("w").alias("chunk_weight"), F.count(F.lit(1)).alias("chunk_size")
    )
    amount = F.lit(1).cast("long") if by_number else F.col("w")
    chunk_amount = F.col("chunk_size") if by_number else F.col("chunk_weight")
    whole = Window.partitionBy("restaurant_id")
    before = whole.orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    offsets = chunks.select(
        "restaurant_id",
        "_chunk",
        F.coalesce(F.sum(chunk_amount).over(before), F.lit(0)).alias("_offset"),
        F.sum("chunk_size").over(whole).alias("menu_size"),
        F.sum("chunk_weight").over(whole).alias("menu_weight"),
    )
    inside = (
        Window.partitionBy("restaurant_id", "_chunk")
        .orderBy("item_id")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    return (
        placed.withColumn("start", F.coalesce(F.sum(amount).over(inside), F.lit(0)))
        .join(offsets, ["restaurant_id", "_chunk"])
        .select(
            "restaurant_id",
            "item_id",
            "w",
            (F.col("start") + F.col("_offset")).alias("start"),
            "menu_size",
            "menu_weight",
        )
    )


def menu(items: DataFrame, page: int = PAGE, attributes: DataFrame | None = None) -> DataFrame:
    """Menus in pages: restaurant_id, page, items (at most ``page``), menu_size.

    With ``attributes`` also ``_items``, the attributes of each place.
    """
    placed = menu_index(items).withColumn("page", F.floor(F.col("start") / page).cast("long"))
    entry = ["start", "item_id"]
    if attributes is not None:
        placed = placed.join(_packed(attributes), "item_id", "left")
        entry.append("_item")
    return (
        placed.groupBy("restaurant_id", "page")
        .agg(
            F.array_sort(F.collect_list(F.struct(*entry))).alias("entries"),
            F.max("menu_size").alias("menu_size"),
        )
        .select("restaurant_id", "page", *_places(attributes), "menu_size")
    )


def _packed(attributes: DataFrame) -> DataFrame:
    """(item_id, _item): all other columns of a table with one row an item as a struct."""
    names = [c for c in attributes.columns if c != "item_id"]
    return attributes.select("item_id", F.struct(*names).alias("_item"))


def _places(attributes: DataFrame | None) -> list[Column]:
    """The arrays ``items`` and, with attributes, ``_items`` of sorted ``entries``."""
    arrays = [F.transform("entries", lambda e: e["item_id"]).alias("items")]
    if attributes is not None:
        arrays.append(F.transform("entries", lambda e: e["_item"]).alias("_items"))
    return arrays


def _draw(size: Column, count: Column, limit: int, key: Column, salt: str, seed: str) -> Column:
    """``count`` (at most ``limit``) distinct numbers below ``size``, all subsets equally likely.

    Floyd's method: for j = size - count .. size - 1 take a random number in 0..j,
    or j itself when that number is already taken. The whole range needs no draw.
    """
    everything = F.sequence(F.lit(0).cast("long"), size - 1)
    # A one-element array binds the row's stream once for all its draws.
    tries = F.element_at(
        F.transform(
            F.array(stream(key, F.lit(salt), seed=seed)),
            lambda start: F.transform(
                F.sequence(size - count, size - 1),
                lambda j, i: F.struct(
                    j.alias("j"),
                    F.floor(step(start, i, limit) * (j + 1)).cast("long").alias("t"),
                ),
            ),
        ),
        1,
    )
    chosen = F.aggregate(
        tries,
        F.array().cast("array<bigint>"),
        lambda taken, x: F.array_append(
            taken, F.when(F.array_contains(taken, x["t"]), x["j"]).otherwise(x["t"])
        ),
    )
    return (
        F.when((count <= 0) | size.isNull(), F.array().cast("array<bigint>"))
        .when(count == size, everything)
        .otherwise(chosen)
    )


def _sizes(items: DataFrame, page: int) -> tuple[bool, bool]:
    """Whether every menu is at most one page, and whether all menus together are small enough
    to be sent to every executor; reads the catalogue only.
    """
    sizes = items.groupBy("restaurant_id").agg(F.count(F.lit(1)).alias("n"))
    most, rows, menus = sizes.agg(F.max("n"), F.sum("n"), F.count(F.lit(1))).first()
    return (most or 0) <= page, (rows or 0) * ITEM_BYTES + menus * MENU_BYTES <= BROADCAST_BYTES


def _with_menu(
    interactions: DataFrame, items: DataFrame, page: int, attributes: DataFrame | None = None
) -> tuple[DataFrame, bool]:
    """Positives with ``menu_size``, their own number ``_own`` (null if not on the menu),
    and ``items``: the whole menu when every menu fits one page (second result), else null.

    With ``attributes`` also ``_items`` beside ``items``, and ``_own_item`` of the row's item,
    which need not be on the menu.
    """
    base = positives(interactions)
    if attributes is not None:
        own_item = _packed(attributes).withColumnRenamed("_item", "_own_item")
        base = base.join(own_item, "item_id", "left")
    one_page, small = _sizes(items, page)
    if one_page:
        known = items.where(F.col("item_id").isNotNull()).select("restaurant_id", "item_id")
        entry = [F.pmod("item_id", F.lit(CHUNKS)).alias("chunk"), F.col("item_id")]
        if attributes is not None:
            known = known.join(_packed(attributes), "item_id", "left")
            entry.append(F.col("_item"))
        menus = (
            known.groupBy("restaurant_id")
            .agg(F.array_sort(F.collect_set(F.struct(*entry))).alias("entries"))
            .select(
                "restaurant_id",
                *_places(attributes),
                F.size("entries").cast("long").alias("menu_size"),
            )
        )
        place = F.array_position("items", F.col("item_id"))
        # Lines are many times the menus: without attributes these go to the lines.
        placed = base.join(F.broadcast(menus) if small and attributes is None else menus, "restaurant_id", "left")
        return placed.withColumn("_own", F.when(place > 0, place - 1)), True
    index = menu_index(items)
    sizes = index.groupBy("restaurant_id").agg(F.max("menu_size").alias("menu_size"))
    own = index.select("restaurant_id", "item_id", F.col("start").alias("_own"))
    placed = base.join(sizes, "restaurant_id", "left").join(
        own, ["restaurant_id", "item_id"], "left"
    )
    return placed.withColumn("items", F.lit(None).cast("array<bigint>")), False


def join_menu(interactions: DataFrame, items: DataFrame, page: int = PAGE) -> DataFrame:
    """Positives whose restaurant has at least two items, with the choice left to sample from.

    Adds ``menu_size`` and ``others``, the menu items other than the row's own.
    """
    base, _ = _with_menu(interactions, items, page)
    own = F.when(F.col("_own").isNull(), 0).otherwise(1)
    return (
        base.where(F.col("menu_size") > 1)
        .withColumn("others", F.col("menu_size") - own)
        .drop("items", "_own")
    )


def _expand(
    drawn: DataFrame,
    items: DataFrame,
    page: int,
    one_page: bool,
    carry: Sequence[str] = (),
    numbered: bool = False,
    attributes: DataFrame | None = None,
    cluster: str | None = None,
) -> DataFrame:
    """One row per positive, per drawn number (``draws``) and per item of ``picked``, if any.

    ``numbered`` adds ``draw``: 0 for the positive, then the number of the draw, which tells
    rows apart that drew the same item. ``cluster`` names a column whose equal rows come to
    stand together: the positives move there with their arrays, before the fan-out.
    """

    def as_row(item: Column, label: int, draw: Column, known: Column | None = None) -> Column:
        parts = [item.alias("item_id"), F.lit(label).alias("label"), draw.cast("int").alias("draw")]
        return F.struct(*parts, *([] if attributes is None else [known.alias("item")]))

    own = F.array(as_row(F.col("item_id"), 1, F.lit(0), F.col("_own_item") if attributes is not None else None))
    if "picked" in drawn.columns:
        after = F.size("draws")
        own = F.concat(own, F.transform("picked", lambda i, k: as_row(i, 0, after + k + 1)))
    turns = F.transform("draws", lambda d, i: F.struct(d.alias("d"), (i + 1).alias("i")))

    def negatives(numbers: Column) -> Column:
        at = lambda name, t: F.element_at(name, (t["d"] % page + 1).cast("int"))
        known = lambda t: None if attributes is None else at("_items", t)
        return F.transform(numbers, lambda t: as_row(at("items", t), 0, t["i"], known(t)))

    if one_page:
        joined = drawn.withColumn("_rows", F.concat(own, negatives(turns)))
    else:
        page_of = lambda d: F.floor(d / page).cast("long")
        pages = F.array_distinct(F.transform("draws", page_of))
        # A positive without draws still needs one row to carry itself.
        needed = F.when(F.size(pages) == 0, F.array(F.lit(-1).cast("long"))).otherwise(pages)
        here = F.filter(turns, lambda t: page_of(t["d"]) == F.col("page"))
        joined = (
            drawn.drop("items")
            .select("*", F.posexplode(needed).alias("_nth", "page"))
            .join(
                menu(items, page, attributes).drop("menu_size"), ["restaurant_id", "page"], "left"
            )
            .withColumn(
                "_rows",
                F.when(F.col("_nth") == 0, F.concat(own, negatives(here))).otherwise(
                    negatives(here)
                ),
            )
        )
    columns = [c for c in dict.fromkeys((*SAMPLE_COLUMNS, *carry)) if c in drawn.columns]
    kept = [c for c in columns if c != "item_id"]
    if cluster is not None:
        joined = joined.select(*kept, "_rows").repartition(cluster).sortWithinPartitions(cluster)
    # explode_outer: a plain explode would evaluate the draws twice, once as a filter.
    return joined.select(*kept, F.explode_outer("_rows").alias("_row")).select(
        *[F.col("_row.item_id").alias("item_id") if c == "item_id" else c for c in columns],
        F.col("_row.label").alias("added_to_cart"),
        *([F.col("_row.draw").alias("draw")] if numbered else []),
        *([] if attributes is None else [F.col("_row.item.*")]),
    )


def _bought(interactions: DataFrame, items: DataFrame) -> DataFrame:
    """Menu numbers of the positives of each session and restaurant, sorted: at most a menu."""
    index = menu_index(items).select("restaurant_id", "item_id", F.col("start").alias("_number"))
    sold = positives(interactions).select("session_id", "restaurant_id", "item_id").distinct()
    return (
        sold.join(index, ["restaurant_id", "item_id"])
        .groupBy("session_id", "restaurant_id")
        .agg(F.array_sort(F.collect_set("_number")).alias("_bought"))
    )


def sample_uniform(
    interactions: DataFrame,
    items: DataFrame,
    n_negatives: int = 40,
    seed: str = "42",
    key: str = "line_key",
    exclude_session_positives: bool = False,
    page: int = PAGE,
    carry: Sequence[str] = (),
    attributes: DataFrame | None = None,
    cluster: str | None = None,
) -> DataFrame:
    """Each positive followed by min(N, others) other items of its restaurant.

    Negatives inherit the sample columns of their positive and those named in
    ``carry``: whatever depends on the user, session or time is cheapest to join
    before the fan-out. Only the row's own item is excluded, so another positive of the session may
    appear as a negative; ``exclude_session_positives`` draws from the menu without any of
    them, so that a row gets N negatives wherever N such items exist. ``attributes``, with one
    row an item_id, adds its other columns to every row by the row's item. With ``cluster`` the
    rows of equal values of that column come out side by side.
    """
    if exclude_session_positives:
        # Before the menus, which would be shuffled by session with every row.
        bought = _bought(interactions, items)
        interactions = interactions.join(bought, ["session_id", "restaurant_id"], "left")
    base, one_page = _with_menu(interactions, items, page, attributes)
    own = F.when(F.col("_own").isNotNull(), F.array("_own")).otherwise(
        F.array().cast("array<bigint>")
    )
    if exclude_session_positives:
        base = base.withColumn("_out", F.coalesce("_bought", own))
    else:
        base = base.withColumn("_out", own)
    others = F.col("menu_size") - F.size("_out")
    count = F.when(
        F.col("menu_size") > 1, F.least(F.lit(n_negatives).cast("long"), others)
    ).otherwise(F.lit(0).cast("long"))
    # A number below ``others`` becomes a menu number by stepping over the sorted excluded ones.
    skipped = F.transform(
        _draw(others, count, n_negatives, F.col(key), "u", seed),
        lambda d: F.aggregate("_out", d, lambda x, e: F.when(x >= e, x + 1).otherwise(x)),
    )
    base = base.withColumn("draws", skipped)
    return _expand(base, items, page, one_page, carry, attributes=attributes, cluster=cluster)


def with_candidates(interactions: DataFrame, items: DataFrame, n_negatives: int = 40) -> DataFrame:
    """Positives with ``n_candidates``, the rows that :func:`sample_uniform` makes of each
    whose item is on its menu; one with an item from elsewhere may get one more.
    """
    sizes = (
        items.where(F.col("item_id").isNotNull())
        .groupBy("restaurant_id")
        .agg(F.count_distinct("item_id").alias("_menu_size"))
    )
    most = F.least(F.coalesce("_menu_size", F.lit(1).cast("long")), F.lit(n_negatives + 1).cast("long"))
    return (
        positives(interactions)
        .join(sizes, "restaurant_id", "left")
        .withColumn("n_candidates", most)
        .drop("_menu_size")
    )


def _with_ratio(
    interactions: DataFrame, items: DataFrame, ratio: int, page: int
) -> tuple[DataFrame, bool]:
    """Positives with the number of draws of the fixed-ratio strategies."""
    base, one_page = _with_menu(interactions, items, page)
    wanted = F.least(F.lit(ratio).cast("long"), F.col("menu_size") - 1)
    return base.withColumn("n_draws", F.coalesce(wanted, F.lit(0).cast("long"))), one_page


def sample_random(
    interactions: DataFrame,
    items: DataFrame,
    ratio: int = 4,
    seed: str = "42",
    key: str = "line_key",
    page: int = PAGE,
) -> DataFrame:
    """Uniform draws from the menu; the positive itself may be drawn, ``draw`` tells the rows apart."""
    draws = _draw(F.col("menu_size"), F.col("n_draws"), ratio, F.col(key), "r", seed)
    base, one_page = _with_ratio(interactions, items, ratio, page)
    return _expand(base.withColumn("draws", draws), items, page, one_page, numbered=True)


def weighted_menu(items: DataFrame, popularity: DataFrame, page: int = PAGE) -> DataFrame:
    """Menus of items with a popularity: restaurant_id, page, entries (number, item, weight)."""
    weights = popularity.where(F.col("count") > 0).select("item_id", F.col("count").alias("weight"))
    known = items.select("restaurant_id", "item_id").join(weights, "item_id")
    return (
        menu_index(known, "weight", by_number=True)
        .groupBy("restaurant_id", F.floor(F.col("start") / page).cast("long").alias("page"))
        .agg(
            F.array_sort(
                F.collect_list(F.struct(F.col("start").alias("number"), "item_id", F.col("w").alias("weight")))
            ).alias("entries"),
            F.max("menu_size").alias("weighted_items"),
        )
    )


def _weighted_picks(
    base: DataFrame,
    items: DataFrame,
    popularity: DataFrame,
    count: Column,
    key: str,
    salt: str,
    seed: str,
    page: int,
) -> DataFrame:
    """Add ``picked`` (up to ``count`` items drawn by weight without replacement) and
    ``weighted_items``, null where no item of the menu has a weight.

    An exponential race: every item of a row's menu gets the time -ln(u) / weight, and the
    first ``count`` win. That is the same law as drawing one after the other, but needs no
    join a draw. Times depend on the row and the item's number only, so a long menu's pages
    run apart and their winners are merged. Rows are told apart by ``key``.
    """
    if RACE % page:
        raise ValueError(f"pages of weighted menus hold a divisor of {RACE} items")
    menus = weighted_menu(items, popularity, page)

    def winners(entries: Column, first: Column, wanted: Column) -> Column:
        """The first ``wanted`` of a page, as (time, item), by time."""
        times = F.element_at(
            F.transform(
                F.array(stream(F.col(key), F.lit(salt), F.floor(first / RACE), seed=seed)),
                lambda start: F.transform(
                    entries,
                    lambda e: F.struct(
                        (-F.log(step(start, e["number"] % RACE, RACE)) / e["weight"]).alias("time"),
                        e["item_id"].alias("item"),
                    ),
                ),
            ),
            1,
        )
        return _first(times, wanted)

    if (menus.agg(F.max("page")).first()[0] or 0) == 0:
        if _sizes(items, page)[1]:
            menus = F.broadcast(menus)
        joined = base.join(menus.drop("page"), "restaurant_id", "left")
        won = joined.withColumn("_won", winners(F.col("entries"), F.lit(0).cast("long"), count)).drop("entries")
    else:
        # Only the key travels with the pages; the row's other columns wait.
        heats = (
            base.select(key, "restaurant_id", count.alias("_count"))
            .join(menus, "restaurant_id")
            .select(key, "_count", "weighted_items", winners(F.col("entries"), F.col("page") * page, F.col("_count")).alias("_heat"))
            .groupBy(key)
            .agg(
                F.max("weighted_items").alias("weighted_items"),
                _first(F.flatten(F.collect_list("_heat")), F.max("_count")).alias("_won"),
            )
        )
        won = base.join(heats, key, "left")
    none = F.array().cast("array<bigint>")
    return won.withColumn(
        "picked", F.coalesce(F.transform("_won", lambda t: t["item"]), none)
    ).drop("_won")


def _first(times: Column, count: Column) -> Column:
    # The native order of (time, item); array_sort would call a comparing function for each two.
    return F.slice(F.sort_array(times), F.lit(1), F.greatest(count, F.lit(0)).cast("int"))


def sample_popular(
    interactions: DataFrame,
    items: DataFrame,
    popularity: DataFrame | None = None,
    ratio: int = 4,
    seed: str = "42",
    key: str = "line_key",
    page: int = PAGE,
) -> DataFrame:
    """Draws weighted by popularity, without replacement; see ``_weighted_picks``.

    Restaurants none of whose items has a popularity fall back to uniform draws.
    """
    popularity = item_popularity(interactions) if popularity is None else popularity
    base, one_page = _with_ratio(interactions, items, ratio, page)
    state = _weighted_picks(
        base, items, popularity, F.col("n_draws"), key, "p", seed, page
    )
    fallback = F.when(F.col("weighted_items").isNull(), F.col("n_draws")).otherwise(
        F.lit(0).cast("long")
    )
    draws = _draw(F.col("menu_size"), fallback, ratio, F.col(key), "r", seed)
    return _expand(state.withColumn("draws", draws), items, page, one_page)


def sample_mixed(
    interactions: DataFrame,
    items: DataFrame,
    ratio: int = 4,
    seed: str = "42",
    key: str = "line_key",
    second_half: str = "uniform",
    popularity: DataFrame | None = None,
    page: int = PAGE,
) -> DataFrame:
    """Two independent draws of half the ratio each; the halves may overlap, and ``draw``
    tells rows of the same item apart.

    Both halves are uniform by default; ``second_half='popular'`` weights the second.
    """
    base, one_page = _with_ratio(interactions, items, ratio, page)
    first = F.floor(F.col("n_draws") / 2).cast("long")
    second = F.col("n_draws") - first
    head = _draw(F.col("menu_size"), first, ratio, F.col(key), "a", seed)
    if second_half == "uniform":
        tail = _draw(F.col("menu_size"), second, ratio, F.col(key), "b", seed)
        return _expand(base.withColumn("draws", F.concat(head, tail)), items, page, one_page, numbered=True)
    if second_half != "popular":
        raise ValueError("second_half is 'uniform' or 'popular'")
    popularity = item_popularity(interactions) if popularity is None else popularity
    state = _weighted_picks(base, items, popularity, second, key, "p", seed, page)
    fallback = F.when(F.col("weighted_items").isNull(), second).otherwise(F.lit(0).cast("long"))
    tail = _draw(F.col("menu_size"), fallback, ratio, F.col(key), "b", seed)
    return _expand(state.withColumn("draws", F.concat(head, tail)), items, page, one_page, numbered=True)
