"""Fuzzy search for short licence notices.

Texts become words (letters and digits, A-Z in lower case) joined by single spaces. A
notice with k allowed character edits is cut into k + 1 parts; a place with at most k edits
holds one of the parts unchanged, so an Aho-Corasick automaton over all parts finds every
candidate place. Around each, the ``regex`` library's bounded-error matching looks for the
best match with at most k edits and reports its words and errors.

Besides, exact phrases of consecutive words are counted (``PHRASES``).

Rows: each row is searched by itself. Null text: empty text. Empty table: no rows. Other
columns of the input are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartwise.llm import text as tx
from cartwise.llm.ship import ship

# Phrases with their labels.
PHRASES = (
    ("mit license", "mit"),
    ("apache license", "apache"),
    ("general public license", "gpl"),
)
# Notices, as words, with their labels; one edit is allowed for every ten characters.
NOTICES = (
    ("released under the mit license", "mit"),
    ("permission is hereby granted free of charge to any person obtaining a copy", "mit"),
    ("licensed under the apache license version 2 0", "apache"),
    ("licensed under the gnu general public license version 3", "gpl"),
    ("licensed under cc by nc 4 0", "cc-by-nc"),
    ("licensed under cc by sa 4 0", "cc-by-sa"),
    ("redistribution and use in source and binary forms with or without modification", "bsd"),
    ("subject to the terms of the mozilla public license", "mpl"),
    ("permission to use copy modify and or distribute this software for any purpose", "isc"),
    ("this is free and unencumbered software released into the public domain", "unlicense"),
)
CHARS_AN_EDIT = 10

_ready: dict[tuple, tuple] = {}


def edits(notice: str) -> int:
    return max(1, len(notice) // CHARS_AN_EDIT)


def parts(notice: str) -> list[tuple[int, str]]:
    """(offset, text) of the k + 1 parts of a notice with k edits."""
    cuts = np.linspace(0, len(notice), edits(notice) + 2).astype(int)
    return [(int(a), notice[a:b]) for a, b in zip(cuts, cuts[1:])]


def _machines(notices: tuple) -> tuple:
    if notices not in _ready:
        import ahocorasick
        import regex

        automaton = ahocorasick.Automaton()
        places: dict[str, list[tuple[int, int]]] = {}
        for i, (notice, _) in enumerate(notices):
            for offset, part in parts(notice):
                places.setdefault(part, []).append((i, offset))
        for part, found in places.items():
            automaton.add_word(part, (len(part), found))
        automaton.make_automaton()
        patterns = [regex.compile(f"(?b)(?:{regex.escape(n, literal_spaces=True)}){{e<={edits(n)}}}") for n, _ in notices]
        _ready[notices] = (automaton, patterns)
    return _ready[notices]


def joined_words(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, before: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Words with a space after each, a line end after a row's last; and their positions."""
    lengths = ends - starts
    place = np.zeros(len(starts) + 1, np.int64)
    np.cumsum(lengths + 1, out=place[1:])
    out = np.full(place[-1], 32, np.uint8)
    shift = np.repeat(place[:-1] - starts, lengths)
    source = np.arange(len(shift)) - np.repeat(np.r_[0, np.cumsum(lengths)[:-1]] if len(starts) else place[:0], lengths) + np.repeat(starts, lengths)
    out[source + shift] = data[source]
    last = before[1:][np.diff(before) > 0]
    out[place[last] - 1] = 10
    return out, place


def word_is(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, word: str) -> np.ndarray:
    """Numbers of the words equal to ``word``."""
    body = word.encode()
    found = np.flatnonzero(ends - starts == len(body))
    for k, byte in enumerate(body):
        found = found[data[starts[found] + k] == byte]
    return found


def _phrase_places(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, row: np.ndarray, phrase: str) -> np.ndarray:
    """Numbers of the words where the phrase starts, inside one row."""
    words = phrase.split()
    flags = {w: np.zeros(len(starts) + len(words), bool) for w in set(words)}
    for w in flags:
        flags[w][word_is(data, starts, ends, w)] = True
    found = np.flatnonzero(flags[words[-1]]) - (len(words) - 1)
    found = found[found >= 0]
    for k, w in enumerate(words):
        found = found[flags[w][found + k]]
    return found[row[found] == row[found + len(words) - 1]]


def _fuzzy(text: str, notices: tuple) -> list[tuple[int, int, int, int]]:
    """(notice, start, end, errors) of the matches in joined words, rows apart."""
    automaton, patterns = _machines(notices)
    spans: dict[int, list[list[int]]] = {}
    for end, (length, found) in automaton.iter(text):
        for i, offset in found:
            k, start = edits(notices[i][0]), end - length + 1 - offset
            low, high = max(0, start - k), start + len(notices[i][0]) + k
            own = spans.setdefault(i, [])
            if own and low <= own[-1][1]:
                own[-1][1] = max(own[-1][1], high)
            else:
                own.append([low, high])
    out = []
    for i, own in spans.items():
        for low, high in own:
            # A place never goes over the end of a row.
            at = low
            for part in text[low:high].split("\n"):
                for m in patterns[i].finditer(part):
                    if m.end() > m.start():
                        out.append((i, at + m.start(), at + m.end(), sum(m.fuzzy_counts)))
                at += len(part) + 1
    return _apart(out, notices)


def _apart(found: list[tuple[int, int, int, int]], notices: tuple) -> list[tuple[int, int, int, int]]:
    """Of matches that overlap, the one with the smallest share of edits (then the longest)."""
    order = sorted(found, key=lambda m: (m[1], m[2]))
    out, group, reach = [], [], -1
    for m in order + [(0, 1 << 62, 1 << 62, 0)]:
        if m[1] >= reach and group:
            group.sort(key=lambda g: (g[3] / len(notices[g[0]][0]), g[1] - g[2], g[0]))
            taken: list[tuple[int, int, int, int]] = []
            for g in group:
                if all(g[2] <= t[1] or t[2] <= g[1] for t in taken):
                    taken.append(g)
            out += taken
            group, reach = [], -1
        group.append(m)
        reach = max(reach, m[2])
    return out


def _scan_batches(notices: tuple):
    phrase_labels = [label for _, label in PHRASES]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, end, data, at in tx.pieces(batch["text"]):
                data = tx.LOWER[data]
                starts, ends, before = tx.words_at(data, at, tx.ALNUM)
                rows = end - first
                row = np.repeat(np.arange(rows), np.diff(before))
                n_base = np.zeros(rows, np.int64)
                low, high = np.full(rows, 1 << 62), np.full(rows, -1)
                base: dict[int, set[str]] = {}
                for (phrase, _), label in zip(PHRASES, phrase_labels):
                    found = _phrase_places(data, starts, ends, row, phrase)
                    np.add.at(n_base, row[found], 1)
                    np.minimum.at(low, row[found], found - before[row[found]])
                    np.maximum.at(high, row[found], found - before[row[found]])
                    for r in np.unique(row[found]).tolist():
                        base.setdefault(r, set()).add(label)
                body, place = joined_words(data, starts, ends, before)
                spans: dict[int, list[dict]] = {}
                for i, a, b, errors in _fuzzy(body.tobytes().decode("latin-1"), notices):
                    w = int(np.searchsorted(place, a, "right")) - 1
                    v = int(np.searchsorted(place, b - 1, "right")) - 1
                    r = int(row[w])
                    spans.setdefault(r, []).append(
                        {
                            "label": notices[i][1],
                            "notice": notices[i][0],
                            "start_word": int(w - before[r]),
                            "end_word": int(v - before[r]) + 1,
                            "errors": errors,
                        }
                    )
                best = np.zeros(rows)
                for r, found in spans.items():
                    best[r] = max(1 - s["errors"] / len(s["notice"]) for s in found)
                best[n_base > 0] = 1.0
                labels = [",".join(sorted(base.get(r, set()) | {s["label"] for s in spans.get(r, [])})) for r in range(rows)]
                has = n_base > 0
                yield pa.RecordBatch.from_pydict(
                    {
                        "doc_id": batch["doc_id"].slice(first, rows),
                        "n_words": pa.array(np.diff(before), pa.int64()),
                        "n_base": pa.array(n_base),
                        "first_word": pa.array(low, pa.int64(), mask=~has),
                        "last_word": pa.array(high, pa.int64(), mask=~has),
                        "base_labels": pa.array([",".join(sorted(base.get(r, ()))) for r in range(rows)], pa.string()),
                        "labels": pa.array(labels, pa.string()),
                        "score": pa.array(best),
                        "spans": pa.array(
                            [sorted(spans.get(r, []), key=lambda s: (s["start_word"], s["label"])) for r in range(rows)],
                            pa.list_(
                                pa.struct(
                                    [
                                        ("label", pa.string()),
                                        ("notice", pa.string()),
                                        ("start_word", pa.int64()),
                                        ("end_word", pa.int64()),
                                        ("errors", pa.int32()),
                                    ]
                                )
                            ),
                        ),
                    }
                )

    return run


def scan(docs: DataFrame, notices: tuple = NOTICES) -> DataFrame:
    """Phrases, labels, score and spans of every row.

    Words are numbered from 0. ``score`` is 1 for exact phrases, else one minus the share
    of edited characters of the best notice, 0 without any.
    """
    ship(docs.sparkSession)
    id_type = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(
        _scan_batches(notices),
        f"doc_id {id_type}, n_words long, n_base long, first_word long, last_word long, base_labels string, "
        "labels string, score double, spans array<struct<label:string,notice:string,start_word:long,end_word:long,errors:int>>",
    )
