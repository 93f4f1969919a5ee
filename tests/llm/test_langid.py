"""Language network: gradients, equal results of both passes, planted languages, odd rows."""

from __future__ import annotations

import random
import zlib

import numpy as np
from pyspark.sql import functions as F

from cartwise.llm import langid
from cartwise.llm import text as tx

SYLLABLES = {
    "aa": ["shi", "ko", "ra", "mu"],
    "bb": ["sch", "ung", "keit", "über"],
    "cc": ["ión", "que", "ado", "llo"],
}


def test_gradients_through_time_equal_finite_differences():
    params = langid.new_params(3, hidden=4, dtype=np.float64)
    draw = np.random.default_rng(0)
    x = draw.integers(97, 110, (5, 6)).astype(np.uint8)
    y, weight = draw.integers(0, 3, 5), draw.random(5) + 0.1
    _, grads = langid.loss_and_gradients(params, x, y, weight)
    for name, value in params.items():
        for _ in range(20):
            at = tuple(draw.integers(0, s) for s in value.shape)
            if name.startswith("bytes"):
                at = (int(draw.choice(x.reshape(-1))), at[1])
            old, losses = value[at], []
            for move in (1e-6, -1e-6):
                value[at] = old + move
                losses.append(langid.loss_and_gradients(params, x, y, weight)[0])
            value[at] = old
            assert abs((losses[0] - losses[1]) / 2e-6 - grads[name][at]) < 1e-7


def test_labels_equal_those_of_the_training_pass():
    params = langid.new_params(3, hidden=5)
    x = np.random.default_rng(1).integers(0, 256, (7, 9)).astype(np.uint8)
    both = np.concatenate([langid._run(params, x, way)[0] for way in ("forth", "back")], axis=2)
    e = np.exp(both @ params["out"] + params["bias"])
    assert np.allclose(langid.label(params, x), e / e.sum(2, keepdims=True), atol=1e-5)


def test_every_position_counts_once():
    params = langid.new_params(2, hidden=3)
    texts = ["one two two", "x" * 1000 + " two", "", None, "Two TWO two"]
    found = langid.document_means(params, texts)
    for text, mean in zip(texts, found):
        windows = langid._windows(langid._lowered(text))
        assert b"".join(windows) == (text or "").lower().replace(" ", "").encode()
        if windows:
            labels = [langid.label(params, np.frombuffer(w, np.uint8)[None, :])[:, 0] for w in windows]
            assert np.allclose(mean, np.concatenate(labels).mean(0), atol=1e-5)
        else:
            assert not mean.any()


def documents(spark):
    draw = random.Random(3)
    rows = []
    for i in range(400):
        lang = draw.choice(sorted(SYLLABLES))
        words = ["".join(draw.choices(SYLLABLES[lang], k=draw.randint(1, 3))) for _ in range(draw.randint(5, 60))]
        rows.append((i, " ".join(words), lang))
    rows += [
        (1000, "", "aa"),
        (1001, None, "aa"),
        (1002, "123 -- 4!", "bb"),
        (1003, "shiko " * 30_000, None),
        (None, "schung keit", "bb"),
        (None, "schung keit", "bb"),
        (1004, "é", None),
    ]
    table = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    for name in ("window", "n", "race", "place", "lettered", "held_out", "score", "lang_pred"):
        table = table.withColumn(name, F.lit("other"))
    return rows, table


def test_languages_of_held_out_documents(spark):
    rows, docs = documents(spark)
    learns = tx.fold("doc_id", 5) != 0
    out = langid.identify(docs, learns).collect()
    assert len(out) == len(rows)
    truth = {r[0]: r[2] for r in rows if r[0] is not None and r[0] < 400}
    held = [r for r in out if r.doc_id in truth and r.held_out]
    assert len(held) > 40 and all(r.lang_pred == truth[r.doc_id] for r in held)
    for r in out:
        assert r.held_out == (zlib.crc32(str("" if r.doc_id is None else r.doc_id).encode()) % 5 == 0)
        assert 0 <= r.score <= 1
    by_id = {r.doc_id: r for r in out}
    assert all((by_id[i].lang_pred, by_id[i].score) == ("und", 0.0) for i in (1000, 1001, 1002))
    assert by_id[1003].lang_pred == "aa" and by_id[1004].lang_pred in SYLLABLES
    again = langid.identify(docs, learns).collect()
    assert sorted(map(str, again)) == sorted(map(str, out))


def test_without_learning_rows(spark):
    _, docs = documents(spark)
    out = langid.identify(docs.withColumn("lang", F.lit(None).cast("string")), tx.fold("doc_id", 5) != 0)
    assert {(r.lang_pred, r.score) for r in out.collect()} == {("und", 0.0)}
    assert langid.identify(docs.limit(0), tx.fold("doc_id", 5) != 0).count() == 0
    # Only texts without a word have a language: the network stays as it was drawn.
    assert langid.identify(docs.where("doc_id = 1000"), F.lit(True)).collect()[0].lang_pred == "und"
