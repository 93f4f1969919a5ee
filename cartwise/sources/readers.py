"""Readers for the input tables and the order-lines-to-interactions join."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from cartwise.sources import schemas
from cartwise.sources.schemas import require_columns


def read_table(spark: SparkSession, path: str, schema: str, fmt: str = "csv") -> DataFrame:
    """Read one table, whatever the order of its columns: the declared ones first.

    Declared columns get their declared types; of a CSV file only the header line is
    read ahead. Other columns are kept, as text from CSV files. Declared columns that
    the file lacks are absent. Fields that do not parse become null. CSV files of one folder
    whose header lines differ are an error.
    """
    kinds = dict(column.split(" ") for column in schema.split(", "))
    if fmt != "csv":
        table = spark.read.format(fmt).load(path)
        declared = [F.col(n).try_cast(kind).alias(n) for n, kind in kinds.items() if n in table.columns]
        return table.select(*declared, *[f"`{n}`" for n in table.columns if n not in kinds])
    header = spark.read.csv(path, header=True).columns
    layout = ", ".join(f"`{name}` {kinds.get(name, 'STRING')}" for name in header)
    table = spark.read.schema(layout).csv(path, header=True, enforceSchema=False)
    declared = [name for name in kinds if name in header]
    return table.select(*declared, *[f"`{n}`" for n in header if n not in kinds])


# Columns of checked tables: what is wrong with a row, and the row as it was read.
BAD, RECORD = "_bad_columns", "_bad_record"
# Columns without which a row of an input file cannot be used.
KEYS = {
    "users": ("user_id",),
    "restaurants": ("restaurant_id",),
    "items": ("item_id",),
    "carts": ("session_id",),
    "order_items": ("order_id", "item_id"),
    "orders": ("order_id", "user_id", "restaurant_id"),
}
LAYOUTS = {
    "users": schemas.USERS,
    "restaurants": schemas.RESTAURANTS,
    "items": schemas.ITEMS,
    "carts": schemas.CARTS,
    "order_items": schemas.ORDER_ITEMS,
    "orders": schemas.ORDERS,
}


def checked_table(spark: SparkSession, path: str, schema: str, fmt: str = "csv") -> DataFrame:
    """The table of :func:`read_table` with two more columns about each row.

    ``BAD`` names the declared columns that hold a value which does not parse, and holds
    ``row`` for a CSV line with too few or too many fields; it is empty for a good row.
    ``RECORD`` is the line (CSV) or the row as JSON, for such rows only.
    """
    kinds = dict(column.split(" ") for column in schema.split(", "))
    torn = F.lit(None).cast("string")
    if fmt == "csv":
        names = spark.read.csv(path, header=True).columns
        line = "_line"
        layout = ", ".join(f"`{name}` STRING" for name in [*names, line])
        # Without pruning each line is held against all columns, whatever is asked for.
        raw = spark.read.schema(layout).option("columnPruning", False).csv(
            path, header=True, enforceSchema=False, columnNameOfCorruptRecord=line
        )
        torn = F.col(line)
    else:
        raw = spark.read.format(fmt).load(path)
        names = raw.columns
    field = lambda name: F.col(f"`{name}`")
    declared = {name: field(name).try_cast(kind) for name, kind in kinds.items() if name in names}
    bad = F.array_compact(
        F.array(
            *[F.when(field(n).isNotNull() & parsed.isNull(), F.lit(n)) for n, parsed in declared.items()],
            F.when(torn.isNotNull(), F.lit("row")),
        )
    )
    record = F.coalesce(torn, F.to_json(F.struct(*[field(n) for n in names])))
    return raw.select(
        *[parsed.alias(n) for n, parsed in declared.items()],
        *[field(n) for n in names if n not in kinds],
        bad.alias(BAD),
        F.when(F.size(bad) > 0, record).alias(RECORD),
    )


def _unusable(keys: Sequence[str]) -> Column:
    return F.arrays_overlap(F.col(BAD), F.array(*[F.lit(k) for k in (*keys, "row")]))


def usable_rows(
    checked: DataFrame, keys: Sequence[str], observation: Observation | None = None
) -> DataFrame:
    """Rows of a checked table whose ``keys`` parse; other fields that do not are null.

    ``observation`` counts, in the pass that reads the table, ``rows``, the ``rejected`` ones
    and the ``repaired`` ones that stay with a null.
    """
    lost = _unusable(keys)
    if observation is not None:
        checked = checked.observe(
            observation,
            F.count(F.lit(1)).alias("rows"),
            F.count_if(lost).alias("rejected"),
            F.count_if(~lost & (F.size(BAD) > 0)).alias("repaired"),
        )
    return checked.where(~lost).drop(BAD, RECORD)


def rejected_rows(checked: DataFrame, keys: Sequence[str], table: str) -> DataFrame:
    """(table, columns, record, kept) of each row with a field that does not parse.

    ``kept`` rows are in the table, with a null in that field; the others are not.
    """
    return checked.where(F.size(BAD) > 0).select(
        F.lit(table).alias("table"),
        F.col(BAD).alias("columns"),
        F.col(RECORD).alias("record"),
        (~_unusable(keys)).alias("kept"),
    )


def load_users(spark: SparkSession, path: str, fmt: str = "csv") -> DataFrame:
    return read_table(spark, path, schemas.USERS, fmt)


def load_restaurants(spark: SparkSession, path: str, fmt: str = "csv") -> DataFrame:
    return read_table(spark, path, schemas.RESTAURANTS, fmt)


def load_items(spark: SparkSession, path: str, fmt: str = "csv") -> DataFrame:
    return read_table(spark, path, schemas.ITEMS, fmt)


def load_carts(spark: SparkSession, path: str, fmt: str = "csv") -> DataFrame:
    return read_table(spark, path, schemas.CARTS, fmt)


def load_interactions_file(spark: SparkSession, path: str, fmt: str = "csv") -> DataFrame:
    return read_table(spark, path, schemas.INTERACTIONS, fmt)


def join_order_header(order_items: DataFrame, orders: DataFrame) -> DataFrame:
    """Order lines with the columns of their order; unmatched lines keep nulls."""
    return order_items.join(orders, "order_id", "left")


def null_profile(joined: DataFrame) -> DataFrame:
    """One row: nulls per key column after the header join."""
    keys = ("user_id", "restaurant_id", "item_id")
    return joined.agg(
        *[F.count(F.when(F.col(k).isNull(), 1)).alias(f"null_{k}") for k in keys]
    )


def build_interactions(
    order_items: DataFrame, orders: DataFrame, timestamp: Column | None = None
) -> DataFrame:
    """Interactions from order lines and order headers.

    Lines without a user, restaurant or item are dropped. ``timestamp`` is any
    expression over the joined columns; the line's own time is the default. Without a
    ``line_key`` of their own, lines are known by order, position, item and time, and
    repeats of a line by a number too.
    """
    require_columns(
        order_items, ["order_id", "item_id", "is_recommended", "added_after_recommendation"],
        "order_items",
    )
    require_columns(orders, ["order_id", "user_id"], "orders")
    # A column that both tables have is the line's.
    clashing = [c for c in orders.columns if c in order_items.columns and c != "order_id"]
    joined = join_order_header(order_items, orders.drop(*clashing))
    return interactions_of(joined, timestamp)


def interactions_of(joined: DataFrame, timestamp: Column | None = None) -> DataFrame:
    """Interactions from order lines that carry their order's columns; see :func:`build_interactions`."""
    require_columns(joined, ["restaurant_id"], "order_items joined with orders")
    if timestamp is None:
        require_columns(joined, ["added_timestamp"], "order_items")
        timestamp = F.col("added_timestamp")
    if "position_in_cart" not in joined.columns:
        joined = joined.withColumn("position_in_cart", F.lit(None).cast("int"))
    if "line_key" not in joined.columns:
        parts = ["order_id", "position_in_cart", "item_id", timestamp.cast("string")]
        # Within an order, as the header join has left the rows.
        repeat = F.row_number().over(
            Window.partitionBy("order_id", *parts[1:]).orderBy(
                "is_recommended", "added_after_recommendation"
            )
        )
        joined = joined.withColumn(
            "line_key",
            F.concat_ws("-", *parts, F.when(repeat > 1, F.concat(F.lit("r"), repeat.cast("string")))),
        )
    kept = joined.dropna(subset=["user_id", "restaurant_id", "item_id"])
    return kept.select(
        "order_id",
        F.concat(F.lit("sess_"), F.col("order_id").cast("string")).alias("session_id"),
        "line_key",
        "user_id",
        "item_id",
        "restaurant_id",
        timestamp.alias("timestamp"),
        "position_in_cart",
        F.lit(1).alias("added_to_cart"),
        F.col("is_recommended").alias("recommended_flag"),
        F.col("added_after_recommendation").alias("clicked"),
        F.lit(1).alias("ordered"),
    )


def cart_lines(carts: DataFrame) -> DataFrame:
    """Long form (session_id, item_id) of carts holding a comma-separated item list.

    Empty parts are no items. A part that is no number gives a row without item_id, which
    joins nothing and can be counted.
    """
    parts = F.filter(F.transform(F.split("cart_items", ","), lambda x: F.trim(x)), lambda x: x != "")
    return carts.select("session_id", F.explode(parts).alias("item")).select(
        "session_id", F.col("item").try_cast("long").alias("item_id")
    )


def load_all(
    spark: SparkSession,
    folder: str,
    fmt: str = "csv",
    observations: dict[str, Observation] | None = None,
) -> dict[str, DataFrame]:
    """All input tables of a folder, by name; nothing is read until used.

    No row vanishes unseen: ``rejects`` holds every row of the six files with a field that
    does not parse (see :func:`rejected_rows`). ``observations`` takes an observation for each
    file, which the first action on its table fills (see :func:`usable_rows`).
    """
    checked = {
        name: checked_table(spark, f"{folder.rstrip('/')}/{name}.{fmt}", LAYOUTS[name], fmt)
        for name in KEYS
    }
    if observations is not None:
        observations.update({name: Observation(f"rejects of {name}") for name in KEYS})
    seen = observations or {}
    tables = {name: usable_rows(checked[name], KEYS[name], seen.get(name)) for name in KEYS}
    order_items, orders = tables.pop("order_items"), tables.pop("orders")
    rejects = [rejected_rows(checked[name], KEYS[name], name) for name in KEYS]
    return {
        **tables,
        "interactions": build_interactions(order_items, orders),
        "rejects": reduce(DataFrame.unionByName, rejects),
    }
