"""Token counts of whole texts, as a public tokenizer's library gives them.

Texts are cut at white space, where the tokenizer is known to cut as well: its
normaliser turns white space into single spaces and lower-cases character by character,
its splitter drops white space, and its special strings hold none. So the count of a text
is the sum of the counts of its words, and a text of any length is split safely. A piece
of a batch encodes every distinct word once: its words, joined by spaces into lines of
balanced bytes, go through the batch call, and the offsets of the tokens say how many
each word got. Only lengths leave the function. Counts of words stay in a table of
bounded size in the worker, which saves work and never changes a count.

Other tokenizer files keep white space inside tokens; ``safe_at_space=False`` then encodes
whole texts in calls balanced by bytes.

Rows: each row is counted by itself. Null text: empty text, no tokens. Empty table: no
rows. Other columns of the input are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartwise.llm import text as tx
from cartwise.llm.ship import ship

#: Bytes of one call to the library, of one line in it, and of one piece of a batch.
CALL_BYTES = 1 << 18
LINE_BYTES = 1 << 11
PIECE_BYTES = 8 << 20
#: Words kept from piece to piece in a worker; a full table starts anew.
KEPT_WORDS = 1 << 20

_loaded: dict[str, object] = {}
_kept: dict[str, pa.Table] = {}


def _library(path: str):
    """The tokenizer of a file: (texts to token counts, texts to starts of tokens or None)."""
    if path not in _loaded:
        if path.endswith(".json"):
            import os

            os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
            from tokenizers import Tokenizer

            tokenizer = Tokenizer.from_file(path)
            tokenizer.no_truncation()
            tokenizer.no_padding()
            _loaded[path] = (
                lambda texts: [len(e.ids) for e in tokenizer.encode_batch_fast(texts, add_special_tokens=False)],
                lambda texts: [[o[0] for o in e.offsets] for e in tokenizer.encode_batch(texts, add_special_tokens=False)],
            )
        else:
            import sentencepiece

            model = sentencepiece.SentencePieceProcessor(model_file=path)
            _loaded[path] = (lambda texts: [len(ids) for ids in model.encode(texts, num_threads=1)], None)
    return _loaded[path]


def _whole(texts: pa.Array, path: str) -> np.ndarray:
    """Token counts of texts, in calls of about ``CALL_BYTES``."""
    count, _ = _library(path)
    out = np.zeros(len(texts), np.int64)
    for first, end, _, _ in tx.pieces(texts, CALL_BYTES):
        out[first:end] = count(texts.slice(first, end - first).to_pylist())
    return out


def _distinct(words: pa.Array, path: str) -> np.ndarray:
    """Token counts of words without white space, many to a line of the batch call."""
    _, starts_of = _library(path)
    out = np.zeros(len(words), np.int64)
    chars = pc.utf8_length(words).to_numpy()
    for first, end, _, _ in tx.pieces(words, CALL_BYTES):
        lines, spans = [], []
        for low, high, _, _ in tx.pieces(words.slice(first, end - first), LINE_BYTES):
            low, high = first + low, first + high
            lines.append(" ".join(words.slice(low, high - low).to_pylist()))
            spans.append((low, high))
        for (low, high), tokens in zip(spans, starts_of(lines)):
            begin = np.r_[0, np.cumsum(chars[low:high] + 1)[:-1]]
            word = np.searchsorted(begin, np.asarray(tokens, np.int64), "right") - 1
            out[low:high] = np.bincount(word, minlength=high - low)
    return out


def _word_counts(words: pa.Array, path: str) -> np.ndarray:
    """Token counts of distinct words, through the worker's table."""
    kept = _kept.get(path)
    if kept is None:
        kept = pa.table({"word": pa.array([], pa.large_string()), "n": pa.array([], pa.int64())})
    stored = kept["word"].combine_chunks()
    stored = stored.chunk(0) if isinstance(stored, pa.ChunkedArray) and stored.num_chunks else stored
    place = pc.index_in(words, value_set=stored)
    known = pc.is_valid(place).to_numpy(zero_copy_only=False)
    out = np.empty(len(words), np.int64)
    out[known] = kept["n"].to_numpy()[place.drop_null().to_numpy()]
    fresh = words.filter(pa.array(~known))
    out[~known] = _distinct(fresh, path)
    if len(kept) + len(fresh) > KEPT_WORDS:
        kept = kept.slice(0, 0)
    # Long words are rare and large; they are encoded again.
    short = pc.less(pc.binary_length(fresh), 64)
    added = pa.table({"word": fresh, "n": out[~known]}).filter(short).slice(0, KEPT_WORDS)
    _kept[path] = pa.concat_tables([kept, added]).combine_chunks()
    return out


def _counts(path: str, safe_at_space: bool):
    def run(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in texts:
            found = np.zeros(len(batch), np.int64)
            for first, end, data, at in tx.pieces(batch, PIECE_BYTES):
                if safe_at_space:
                    starts, ends, before = tx.words_at(data, at, tx.SPACED)
                    coded = tx.word_strings(data, starts, ends, tx.SPACED).dictionary_encode()
                    per_word = _word_counts(coded.dictionary, path)[coded.indices.to_numpy()]
                    total = np.r_[0, np.cumsum(per_word)]
                    found[first:end] = total[before[1:]] - total[before[:-1]]
                else:
                    found[first:end] = _whole(batch.slice(first, end - first).fill_null(""), path)
            yield pa.array(found)

    return run


def token_counts(docs: DataFrame, path: str, limit: int = 2048, safe_at_space: bool = True) -> DataFrame:
    """doc_id, n_bytes, n_tokens and over_limit (more than ``limit`` tokens) of every row.

    ``path`` names a tokenizer file on every worker (part of an installed package).
    """
    ship(docs.sparkSession)

    @F.arrow_udf("long")
    def count(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        yield from _counts(path, safe_at_space)(texts)

    return (
        docs.select("doc_id", "text")
        .withColumn("n_tokens", count("text"))
        .select(
            "doc_id",
            F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"),
            "n_tokens",
            (F.col("n_tokens") > limit).alias("over_limit"),
        )
    )
