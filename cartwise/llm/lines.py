"""Quality rules with cross-document line frequency, in Spark expressions only.

A line is normalised by lower-casing, trimming and writing every run of digits as one zero;
its 64-bit hash is counted once for each document of a host. A line is boilerplate of a
host when it stands in more than ``share`` of the host's documents and in at least
``least_docs`` of them. Boilerplate lines are removed. A document is depleted, and
rejected, when lines were removed from it and less than ``least_left`` of the characters
in its lines, or fewer than ``least_chars`` characters, remain. Together with the rules on a document alone (fewer
than 50 words, or more than half of the words in repeated three-word windows) this decides
``kept``.

The report writes one narrow row for each document: its figures, and for each line with a
word the hash and the number of characters. Counting, and joining the boilerplate back, read
that table only. ``clean`` counts in one pass over the documents and decides in a second, in
which every row meets the codes of its host: at most 1 / ``share`` times the mean number of
distinct lines, sent to all tasks up to a measured number of bytes, and joined by salted
host beyond. No copy of the texts is written or, with few codes, shuffled. Counts combine
before the shuffle, so a line that stands in all documents costs one row a task.

Rows: every row is a document of its own, repeated rows too. Null text: a document without
words. Null host: a host of its own. Empty table: no rows. Other columns of the input are
ignored by ``line_report`` and kept by ``clean``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartwise.session import BROADCAST_BYTES, materialize, settled

#: Words of a text up to which repeated windows are looked up in the list of repeated ones.
SHORT = 2048


def _let(value: Column, body) -> Column:
    """``body`` of a value that is worked out once (a column inside a lambda is not)."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _words(text: Column) -> Column:
    return F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda w: w != "")


def repeated_words(words: Column) -> Column:
    """Number of words that lie in a three-word window found twice or more in the text."""

    def of(w: Column) -> Column:
        last = F.size(w) - 2
        codes = F.transform(F.sequence(F.lit(1), last), lambda i: F.xxhash64(w[i - 1], w[i], w[i + 1]))
        return F.when(last >= 2, _let(codes, covered)).otherwise(F.lit(0))

    def covered(codes: Column) -> Column:
        once = F.size(F.array_distinct(codes)) == F.size(codes)
        return F.when(once, F.lit(0)).otherwise(
            F.when(F.size(codes) <= SHORT, by_list(codes)).otherwise(by_order(codes))
        )

    def by_list(codes: Column) -> Column:
        """Positions whose code is among the repeated ones, looked up in a short list."""
        doubles = _let(
            F.sort_array(codes),
            lambda s: F.array_distinct(F.filter(s, lambda x, i: (i > 0) & (x == F.get(s, i - 1)))),
        )
        return _let(
            doubles,
            lambda d: spread(
                F.filter(F.transform(codes, lambda x, i: F.when(F.array_contains(d, x), i)), lambda p: p.isNotNull())
            ),
        )

    def by_order(codes: Column) -> Column:
        """The same positions by sorting (code, position) and comparing neighbours."""
        placed = F.transform(codes, lambda x, i: F.struct(x.alias("x"), i.alias("i")))
        return _let(
            F.sort_array(placed),
            lambda s: spread(
                F.sort_array(
                    F.transform(
                        F.filter(
                            s,
                            lambda e, i: (F.get(s, i - 1)["x"] == e["x"]) & (i > 0)
                            | F.coalesce(F.get(s, i + 1)["x"] == e["x"], F.lit(False)),
                        ),
                        lambda e: e["i"],
                    )
                )
            ),
        )

    def spread(positions: Column) -> Column:
        """Words covered by windows of three that start at the sorted positions."""
        return _let(
            positions,
            lambda p: F.aggregate(
                F.transform(
                    p,
                    lambda x, i: F.when(i == 0, F.lit(3)).otherwise(F.least(F.lit(3), x - F.get(p, i - 1))),
                ),
                F.lit(0),
                lambda total, x: total + x,
            ),
        )

    return _let(words, of)


def _normal(line: Column) -> Column:
    return F.xxhash64(F.regexp_replace(F.trim(F.lower(line)), "[0-9]+", "0"))


def _has_word(line: Column) -> Column:
    return line.rlike(r"[^\x20\x09-\x0D]")


def _host_code(host: str) -> Column:
    return F.coalesce(F.xxhash64(F.col(f"`{host}`")), F.lit(0)).alias("host")


def _line_codes(text: Column) -> Column:
    """(code, characters) of the lines of a text that hold a word."""
    lines = F.filter(F.split(text, "\n"), _has_word)
    return F.transform(lines, lambda y: F.struct(_normal(y).alias("code"), F.length(y).alias("n")))


def _line_table(docs: DataFrame, host: str, extra: list[str]) -> DataFrame:
    """One narrow row a document: figures, and (code, characters) of its lines with words."""
    table = docs.select(
        *extra,
        F.monotonically_increasing_id().alias("row"),
        _host_code(host),
        F.coalesce(F.col("text"), F.lit("")).alias("text_"),
    )
    figures = _let(
        _words(F.col("text_")),
        lambda w: F.struct(
            F.size(w).cast("long").alias("n_words"),
            F.length(F.array_join(w, "")).cast("long").alias("word_chars"),
            repeated_words(w).cast("long").alias("n_repeat_words"),
        ),
    )
    lines = _let(
        F.filter(F.split("text_", "\n"), _has_word),
        lambda x: F.struct(
            (F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("dup"),
            F.transform(x, lambda y: F.struct(_normal(y).alias("code"), F.length(y).alias("n"))).alias("all"),
        ),
    )
    symbols = F.regexp_count("text_", F.lit(r"[#*$%&|<>]")).cast("long").alias("n_symbols")
    return table.select(*extra, "row", "host", symbols, figures.alias("w"), lines.alias("l")).select(
        *extra, "row", "host", "n_symbols", "w.*", F.col("l.dup").alias("n_dup_lines"), F.col("l.all").alias("lines")
    )


def boilerplate(table: DataFrame, share: float, least_docs: int) -> DataFrame:
    """(host, code) of the lines that stand in too many documents of their host."""
    hosts = table.groupBy("host").agg(F.count(F.lit(1)).alias("docs"))
    codes = F.explode(F.array_distinct(F.transform("lines", lambda x: x["code"]))).alias("code")
    found = (
        table.select("host", codes)
        .groupBy("host", "code")
        .agg(F.count(F.lit(1)).alias("n"))
        .where(F.col("n") >= least_docs)
    )
    return materialize(
        found.join(hosts, "host").where(F.col("n") > share * F.col("docs")).select("host", "code"), "boilerplate"
    )


def _judged(table: DataFrame, share: float, least_docs: int, least_chars: int, least_left: float) -> DataFrame:
    """Verdict of every row of the line table, with the codes of its boilerplate lines."""
    common = boilerplate(table, share, least_docs)
    removed = (
        table.select("row", "host", F.explode("lines").alias("x"))
        .select("row", "host", F.col("x.code").alias("code"), F.col("x.n").alias("n"))
        .join(common, ["host", "code"])
    )
    lost = removed.groupBy("row").agg(F.sum("n").alias("lost"), F.collect_set("code").alias("codes"))
    whole = F.aggregate("lines", F.lit(0).cast("long"), lambda total, x: total + x["n"])
    left = whole - F.coalesce("lost", F.lit(0))
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    depleted = F.col("lost").isNotNull() & ((left < least_chars) | (left < least_left * whole))
    return table.join(lost, "row", "left").select(
        *[c for c in table.columns if c not in ("host", "lines")],
        left.alias("chars_left"),
        failed.alias("base_failed"),
        (~failed & ~depleted).alias("kept"),
        F.coalesce("codes", F.array().cast("array<long>")).alias("codes"),
    )


def line_report(
    docs: DataFrame,
    host: str = "source",
    share: float = 0.02,
    least_docs: int = 10,
    least_chars: int = 150,
    least_left: float = 0.3,
) -> DataFrame:
    """Figures and verdict of every document; ``chars_left`` of its lines after removal."""
    table = materialize(_line_table(docs.select("doc_id", "text", host), host, ["doc_id"]), "lines")
    return _judged(table, share, least_docs, least_chars, least_left).drop("codes", "row")


def clean(
    docs: DataFrame,
    host: str = "source",
    share: float = 0.02,
    least_docs: int = 10,
    least_chars: int = 150,
    least_left: float = 0.3,
) -> DataFrame:
    """The documents that stay, without their boilerplate lines, with the columns of ``docs``.

    ``n_chars`` follows the text where the table has such a column.
    """
    spark = docs.sparkSession
    narrow = docs.select(_host_code(host), _line_codes(F.coalesce(F.col("text"), F.lit(""))).alias("lines"))
    by_host = settled(
        spark,
        lambda: boilerplate(narrow, share, least_docs).groupBy("host").agg(F.collect_set("code").alias("codes")),
        "boilerplate",
    )
    every = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc")
    table = docs.select(every, _host_code(host), F.coalesce(F.col("text"), F.lit("")).alias("text_"))
    size = by_host.agg(F.sum(F.size("codes") * 8 + 64)).first()[0] or 0
    if size <= BROADCAST_BYTES:
        judged = table.join(F.broadcast(by_host), "host", "left")
    else:
        judged = _salted(table, by_host)
    judged = judged.withColumn("codes", F.coalesce("codes", F.array().cast("array<long>")))
    judged = judged.where(_stays(F.col("text_"), F.col("codes"), least_chars, least_left))
    left = F.array_join(
        F.filter(F.split("text_", "\n"), lambda x: ~(_has_word(x) & F.array_contains(F.col("codes"), _normal(x)))),
        "\n",
    )
    text = F.when(F.size("codes") == 0, F.col("doc.text")).otherwise(left)
    joined = judged.select("doc", text.alias("new_text"))
    columns = []
    for name in docs.columns:
        if name == "text":
            columns.append(F.col("new_text").alias(name))
        elif name == "n_chars":
            columns.append(F.length("new_text").cast(docs.schema[name].dataType).alias(name))
        else:
            columns.append(F.col(f"doc.`{name}`").alias(name))
    return joined.select(*columns)


def _salted(table: DataFrame, by_host: DataFrame, parts: int = 64) -> DataFrame:
    """The codes of each row's host by a shuffle that deals the rows of a host to ``parts`` tasks."""
    salts = F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("salt")
    rows = table.withColumn("salt", F.pmod(F.xxhash64("text_"), F.lit(parts)).cast("int"))
    return rows.join(by_host.select("host", "codes", salts), ["host", "salt"], "left").drop("salt")


def _stays(text: Column, codes: Column, least_chars: int, least_left: float) -> Column:
    """The verdict ``kept`` from the text of a row and the boilerplate codes of its host."""

    def failed(w: Column) -> Column:
        return (F.size(w) < 50) | (100 * repeated_words(w) > 50 * F.size(w))

    def depleted(x: Column) -> Column:
        whole = F.aggregate(x, F.lit(0), lambda total, y: total + y["n"])
        left = F.aggregate(x, F.lit(0), lambda total, y: total + F.when(y["hit"], 0).otherwise(y["n"]))
        return F.exists(x, lambda y: y["hit"]) & ((left < least_chars) | (left < least_left * whole))

    marked = F.transform(
        _line_codes(text), lambda y: F.struct(F.array_contains(codes, y["code"]).alias("hit"), y["n"].alias("n"))
    )
    return ~_let(_words(text), failed) & ~_let(marked, depleted)


ORACLE = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, source, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w
  FROM documents),
v AS (SELECT r, unnest(generate_series(1, len(w) - 2)) AS i, w FROM d WHERE len(w) >= 3),
v2 AS (SELECT r, i, count(*) OVER (PARTITION BY r, w[i], w[i + 1], w[i + 2]) AS n FROM v),
v3 AS (SELECT DISTINCT r, i + k AS place FROM v2, (SELECT unnest([0, 1, 2]) AS k) WHERE n > 1),
rep AS (SELECT r, count(*) AS n_repeat_words FROM v3 GROUP BY r),
l AS (SELECT r, source, line, regexp_replace(trim(lower(line), ' '), '[0-9]+', '0', 'g') AS code
      FROM (SELECT r, source, unnest(string_split(text, chr(10))) AS line FROM d)
      WHERE regexp_matches(line, '[^\x20\x09-\x0D]')),
dup AS (SELECT r, count(*) - count(DISTINCT line) AS n_dup_lines, sum(length(line)) AS chars FROM l GROUP BY r),
h AS (SELECT source, count(*) AS docs FROM d GROUP BY source),
b AS (SELECT l.source, code FROM l JOIN h ON l.source IS NOT DISTINCT FROM h.source
      GROUP BY l.source, code, h.docs HAVING count(DISTINCT r) >= 10 AND count(DISTINCT r) > 0.02 * h.docs),
lost AS (SELECT r, sum(length(line)) AS lost FROM l JOIN b ON l.code = b.code AND l.source IS NOT DISTINCT FROM b.source GROUP BY r),
f AS (
  SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words,
         CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
         CAST(len(regexp_extract_all(text, '[#*$%&|<>]')) AS BIGINT) AS n_symbols,
         CAST(coalesce(n_dup_lines, 0) AS BIGINT) AS n_dup_lines,
         CAST(coalesce(n_repeat_words, 0) AS BIGINT) AS n_repeat_words,
         CAST(coalesce(chars, 0) - coalesce(lost, 0) AS BIGINT) AS chars_left, coalesce(chars, 0) AS chars, lost
  FROM d LEFT JOIN rep USING (r) LEFT JOIN dup USING (r) LEFT JOIN lost USING (r))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, chars_left,
       n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
       NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words)
       AND NOT (lost IS NOT NULL AND (chars_left < 150 OR chars_left < 0.3 * chars)) AS kept
FROM f
"""
