"""Operators on small tables: nulls, empty and repeated rows, ties, clashing names, brute force."""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from cartwise.llm import decontaminate, license, lines, minhash, mixing, ppm, quality, tokens, toxicity, warc
from cartwise.llm import text as tx

ROWS = [
    (1, "The cat sat on the mat and the cat sat on the mat again", "a"),
    (2, "the cat sat on the mat and the cat sat on the mat AGAIN", "b"),
    (3, "released under the MIT License.\nall rights", "a"),
    (3, "released under the MIT License.\nall rights", "a"),
    (4, "", None),
    (5, None, "c"),
    (None, "ünïcode wörds über alles and more words here", "a"),
    (6, "x " * 3000 + "end", "b"),
    (7, " \t\n ", "b"),
]


@pytest.fixture(scope="module")
def docs(spark):
    """Documents with a clashing extra column of every internal name."""
    table = spark.createDataFrame(ROWS, "doc_id long, text string, source string")
    for name in ("row", "id", "key", "node", "size", "pattern", "score", "n", "digest", "row_", "held_out", "label", "doc", "doc_"):
        table = table.withColumn(name, F.lit("other"))
    return table


@pytest.fixture(scope="module")
def none(docs):
    return docs.limit(0)


def low(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def test_word_hashes_agree_with_words():
    texts = pa.array(["a bb a", None, "", "bb ccc\n\ta", "é" * 5])
    data, at = tx.raw(texts)
    starts, ends, before = tx.words_at(data, at, tx.SPACED)
    found = [bytes(data[a:b]).decode() for a, b in zip(starts, ends)]
    assert found == [w for t in texts.to_pylist() for w in words(t)]
    assert before.tolist() == [0, 3, 3, 3, 6, 7]
    codes = tx.word_hashes(data, starts, ends)
    assert len(set(codes.tolist())) == len(set(found))
    assert {w: c for w, c in zip(found, codes.tolist())} == dict(zip(found, codes.tolist()))


def test_lm_scores(docs, none):
    out = ppm.score(docs, tx.fold("doc_id", 7) != 2).collect()
    train = [r for r in ROWS if zlib.crc32(str("" if r[0] is None else r[0]).encode()) % 7 != 2]
    count = Counter(w for r in train for w in words(low(r[1])))
    total, types = sum(count.values()) + len(train), len(count) + 1
    expected = []
    for doc_id, text, _ in ROWS:
        own = words(low(text))
        base = sum(math.log10((count[w] + 1) / (total + types + 1)) for w in own)
        base += math.log10((len(train) + 1) / (total + types + 1))
        held = zlib.crc32(str("" if doc_id is None else doc_id).encode()) % 7 == 2
        expected.append((str(doc_id), held, len(own) + 1, sum(count[w] > 0 for w in own) + 1, total, round(base, 6)))
    found = [(str(r.doc_id), r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in out]
    assert sorted(found) == sorted(expected)
    assert all(r.score < 0 for r in out)
    assert ppm.score(none, tx.fold("doc_id", 7) != 2).count() == 0


def brute_ppm(train, text):
    """log10 probability of a text by walking the contexts one by one, symbols excluded."""
    end, order = ppm.END, ppm.ORDER
    counts = defaultdict(Counter)

    def stream(t):
        return bytes([ppm.START] * order) + low(t).encode() + bytes([end])

    for t in train:
        s = stream(t)
        for i in range(order, len(s)):
            for k in range(order + 1):
                counts[s[i - k : i]][s[i]] += 1
    s, total = stream(text), 0.0
    for i in range(order, len(s)):
        excluded: set[int] = set()
        for k in range(order, -1, -1):
            own = counts.get(s[i - k : i])
            if not own:
                continue
            rest = {c: n for c, n in own.items() if c not in excluded}
            if rest:
                both = sum(rest.values()) + len(rest)
                if s[i] in rest:
                    total += math.log10(rest[s[i]] / both)
                    break
                total += math.log10(len(rest) / both)
            excluded |= set(own)
        else:
            total -= math.log10(256 - len(excluded))
    return total


def test_ppm_against_walk(spark):
    train = ["abracadabra", "abra cadabra", "", "banana band", "the bandana"]
    texts = train + ["abrabanana", "zebra", "Ab", "über"]
    rows = [(i, t) for i, t in enumerate(texts)]
    out = ppm.score(spark.createDataFrame(rows, "doc_id long, text string"), F.col("doc_id") < len(train))
    for r in out.collect():
        assert r.score == pytest.approx(brute_ppm(train, texts[r.doc_id]), abs=1e-9)


@pytest.mark.parametrize("cache", [{}, {"split": 1 << 12}, {"split": 1 << 12, "hot_words": 1}])
def test_ppm_keeps_rare_runs_of_a_large_corpus(spark, monkeypatch, cache):
    # Set for the driver alone: what workers pack does not depend on it.
    monkeypatch.setattr(ppm, "CHUNK", 16, raising=False)
    # More than 2^19 bytes: a share of the corpus as limit would drop what occurs once.
    train = ["the bandana " * 1000] * 48 + ["zyx quokka vow"]
    texts = train + ["quokka vows", "the quokka"]
    rows = [(i, t) for i, t in enumerate(texts)]
    out = ppm.score(spark.createDataFrame(rows, "doc_id long, text string"), F.col("doc_id") < len(train), **cache)
    found = {r.doc_id: r.score for r in out.collect()}
    for i in (48, 49, 50):
        assert found[i] == pytest.approx(brute_ppm(train, texts[i]), abs=1e-9)


def test_ppm_probabilities_sum_to_one(spark):
    counts = ppm.count(spark.createDataFrame([("abcabcabd",), ("bcd",)], "text string"))
    scorer = ppm.Scorer(ppm.fit(counts))
    for context in (b"xxabc", b"\xfe" * 5, b"abcab", b"zzzzz"):
        high = int.from_bytes(context, "big") << 8
        keys = np.array([high | b for b in range(256)], np.uint64)
        assert (10 ** scorer.bits(keys)).sum() == pytest.approx(1.0)


def brute_groups(rows, size, percent):
    sets = []
    for _, text, _ in rows:
        w = words(low(text))
        sets.append({tuple(w[i : i + size]) for i in range(max(1, len(w) - size + 1))} if w else set())
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and 100 * len(a & sets[j]) >= percent * len(a | sets[j]):
                root[find(i)] = find(j)
    return [find(i) for i in range(len(rows))], sets


def test_near_duplicates_by_brute_force(spark):
    rng = np.random.default_rng(3)
    base = [" ".join(f"w{x}" for x in rng.integers(0, 500, 120)) for _ in range(6)]
    rows = []
    for i in range(150):
        own = base[i % 6].split()
        for _ in range(int(rng.integers(0, 9))):
            own[int(rng.integers(0, 120))] = f"e{rng.integers(0, 900)}"
        rows.append((i, " ".join(own), "s"))
    rows += [(900, "", "s"), (901, None, "s"), (902, "one", "s"), (903, "ONE", "s"), (904, "one two", "s")]
    group, sets = brute_groups(rows, 3, 85)
    smallest = defaultdict(lambda: 1 << 60)
    for g, r in zip(group, rows):
        smallest[g] = min(smallest[g], r[0])
    out = minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string, source string"), 3, 85)
    found = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in out.collect()}
    assert found == {r[0]: (len(s), smallest[g], smallest[g] == r[0]) for r, s, g in zip(rows, sets, group)}


def test_near_duplicates_of_odd_rows(docs, none):
    out = minhash.near_duplicates(docs, 3, 85).collect()
    assert len(out) == len(ROWS)
    assert {r.component_id for r in out if r.doc_id in (1, 2)} == {1}
    assert [r.n_shingles for r in out if r.doc_id in (4, 5, 7)] == [0, 0, 0]
    assert minhash.near_duplicates(none, 3, 85).count() == 0


def test_blocks_see_what_pairs_see(spark, monkeypatch):
    monkeypatch.setattr(minhash, "BLOCK", 8)
    test_near_duplicates_by_brute_force(spark)


def test_pair_with_chance_bytes_in_an_earlier_band_stays():
    bins = np.zeros((2, minhash.COORDINATES), np.uint64)
    # Band 0 differs in one bin whose lowest byte agrees; band 1 is the first that is shared.
    bins[1, 0] = 1 << 8
    keys = minhash.band_keys(bins)
    assert keys[0, 0] != keys[1, 0] and keys[0, 1] == keys[1, 1]

    def pairs(number):
        batch = pa.RecordBatch.from_pydict(
            {
                "band": pa.array(keys[:, number].view(np.int64)),
                "number": pa.array([number] * 2, pa.int32()),
                "node": pa.array([b"a", b"b"], pa.binary()),
                "root_no": pa.array([1, 2], pa.int64()),
                "block": pa.array([0, 0], pa.int32()),
                "i": pa.array([0, 0], pa.int32()),
                "j": pa.array([0, 0], pa.int32()),
                "long": pa.array([bytes(minhash.LONG)] * 2, pa.binary()),
                "sketch": minhash._rows_of_bytes(bins),
                "bands": pa.array(keys.view(np.int64).tolist(), pa.list_(pa.int64())),
            }
        )
        return sum(map(len, minhash._block_batches((100, 800), None)(iter([batch]))))

    assert [pairs(1), pairs(2)] == [1, 0]


def test_sketch_agrees_with_similarity():
    rng = np.random.default_rng(5)
    shared = rng.integers(0, 1 << 62, 600).astype(np.uint64)
    other = rng.integers(0, 1 << 62, 400).astype(np.uint64)
    a, b = np.concatenate([shared, other[:200]]), np.concatenate([shared, other[200:]])
    out = minhash.sketches(np.concatenate([a, b, a[:1]]), np.array([0, 800, 1600, 1601, 1601]), 1024)
    assert not (out[:3] == minhash._EMPTY).any() and (out[3] == minhash._EMPTY).all()
    assert abs((out[0] == out[1]).mean() - 0.6) < 0.08


def test_token_counts_match_the_library(docs, none):
    P = pytest.importorskip("public_tokenizers")
    from tokenizers import Tokenizer

    path = P.path("word_bpe_49k.json")
    own = Tokenizer.from_file(path)
    odd = ["it's 12,5 <|endoftext|> x<|startoftext|>y ﬁ é ΑΣ. ́b c", "a b İstanbul don'ts 'sting", "日本語 テスト"]
    table = docs.unionByName(docs.sparkSession.createDataFrame([(90 + i, t) for i, t in enumerate(odd)], "doc_id long, text string"), True)
    expected = Counter((str(i), len(own.encode(t or "", add_special_tokens=False).ids)) for i, t, _ in ROWS)
    expected += Counter((str(90 + i), len(own.encode(t, add_special_tokens=False).ids)) for i, t in enumerate(odd))
    out = tokens.token_counts(table, path).collect()
    assert Counter((str(r.doc_id), r.n_tokens) for r in out) == expected
    assert all(r.over_limit == (r.n_tokens > 2048) for r in out)
    assert tokens.token_counts(none, path).count() == 0


def brute_repeated(text):
    w = words(text)
    n = Counter(zip(w, w[1:], w[2:]))
    hit = {i + k for i, x in enumerate(zip(w, w[1:], w[2:])) if n[x] > 1 for k in range(3)}
    return len(hit)


@pytest.mark.parametrize("short", [0, 2048])
def test_line_report(docs, none, monkeypatch, short):
    monkeypatch.setattr(lines, "SHORT", short)
    out = lines.line_report(docs).collect()
    found = Counter((str(r.doc_id), r.n_words, r.word_chars, r.n_repeat_words) for r in out)
    expected = Counter((str(i), len(words(t)), sum(map(len, words(t))), brute_repeated(t)) for i, t, _ in ROWS)
    assert found == expected
    assert lines.line_report(none).count() == 0


def test_boilerplate_lines_go(spark):
    body = lambda i: " ".join(chr(97 + i) + "abc"[k % 3] + chr(97 + k // 3) for k in range(60))
    rows = [(i, f"Share this page {i}\n{body(i)}", "host", 1) for i in range(20)]
    rows.append((50, "\n".join(f"Share this page {i}" for i in range(20)) + "\nshort " + "tail of this page " * 3, "host", 1))
    table = spark.createDataFrame(rows, "doc_id long, text string, source string, n_chars long")
    out = {r.doc_id: r for r in lines.clean(table).collect()}
    assert set(out) == set(range(20))
    assert all(r.text == body(i) and r.n_chars == len(body(i)) for i, r in out.items())


def test_warc_round_trip(spark, tmp_path):
    html = [b"<p>a</p>".decode(), "x\r\n\r\nWARC/1.1\r\n\r\ny", "", None, "<p>a</p>", "ü" * 5000, "<p>a</p>"]
    rows = [(i, f"http://h/{i}" if i else None, h, "other") for i, h in enumerate(html)] + [(None, "u", "<p>a</p>", "o")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, digest string")
    out = {r.page_id: r for r in warc.page_digests(pages).collect()}
    import base64
    import hashlib

    for i, _, h, _ in rows:
        body = (h or "").encode()
        assert out[i].payload_bytes == len(body)
        assert out[i].payload_digest == base64.b32encode(hashlib.sha1(body).digest()).decode()
    kinds = {i: (r.record_type, r.refers_to) for i, r in out.items()}
    assert kinds[0] == kinds[4] == kinds[None] == ("revisit", 6) and kinds[6] == ("response", None)
    assert kinds[2] == ("revisit", 3) and kinds[1] == kinds[3] == kinds[5] == ("response", None)
    path = str(tmp_path / "archives")
    warc.write_archives(pages, path)
    whole = warc.assemble(warc.read_records(spark, path)).collect()
    assert len(whole) == len(rows)
    texts = {r.metadata.page_id: bytes(r.response.payload).decode() for r in whole if r.response.kind == "response"}
    assert texts[1] == html[1] and texts[5] == html[5]
    assert all(r.request.concurrent_to == r.record_id for r in whole)
    assert warc.page_digests(pages.limit(0)).count() == 0


def test_fuzzy_notices(spark, docs, none):
    rows = [(1, "x Relesed under the MIT Licence! y"), (2, "the mit license mit license"), (3, "nothing here"), (4, None)]
    out = {r.doc_id: r for r in license.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert (out[1].labels, out[1].n_base, out[1].spans[0].errors) == ("mit", 0, 2)
    assert (out[1].spans[0].start_word, out[1].spans[0].end_word) == (1, 6)
    assert (out[2].n_base, out[2].first_word, out[2].last_word, out[2].base_labels, out[2].score) == (2, 1, 3, "mit", 1.0)
    assert (out[3].labels, out[3].score, out[4].n_words) == ("", 0.0, 0)
    assert license.scan(docs).count() == len(ROWS) and license.scan(none).count() == 0


def test_mixing_plans():
    targets = mixing.fill_targets({"a": 10, "b": 100, None: 100}, [3, 1, 2], 1.5, 2.0)
    assert targets["a"] == 20 and sum(targets.values()) == pytest.approx(315)
    assert targets[None] == pytest.approx(2 * targets["b"]) or targets[None] == 200
    flow = mixing.route({("a",): 10, ("a", "b"): 30, ("b",): 10}, {"a": 35.0, "b": 15.0}, 2)
    into = {s: sum(n for (p, t), n in flow.items() if t == s) for s in ("a", "b")}
    assert into == pytest.approx({"a": 35.0, "b": 15.0})
    # Enough fresh words for all: nothing is repeated.
    assert all(sum(n for (q, _), n in flow.items() if q == p) <= size for p, size in ((("a",), 10), (("a", "b"), 30), (("b",), 10)))


def test_mix_comes_near_targets(spark, docs, none, monkeypatch):
    monkeypatch.setattr(mixing, "BUCKET_ROWS", 2)
    rows = [(i, "w " * (i % 13), f"s{i % 3}" if i % 7 else None) for i in range(400)]
    table = spark.createDataFrame(rows, "doc_id long, text string, source string")
    out = mixing.mix_by_source(table).collect()
    by = defaultdict(lambda: [0, 0, 0.0])
    for r in out:
        assert 0 <= r.taken <= 2 * r.size
        key = dict((i, s) for i, _, s in rows)[r.doc_id]
        by[key][0] += r.taken
        by[key][1] += r.size
        by[key][2] = r.target
    assert all(abs(t - want) <= 7 and want <= 2 * n for t, n, want in by.values())
    assert sorted(map(tuple, out)) == sorted(map(tuple, mixing.mix_by_source(table).collect()))
    assert mixing.mix_by_source(docs).count() == len(ROWS) and mixing.mix_by_source(none).count() == 0
    picked = mixing.select_documents(docs)
    assert set(docs.columns) < set(picked.columns)


def brute_align(item, passage):
    best, table = 0, [[0] * (len(passage) + 1) for _ in range(len(item) + 1)]
    for i in range(1, len(item) + 1):
        for j in range(1, len(passage) + 1):
            same = 1 if item[i - 1] == passage[j - 1] else -1
            table[i][j] = max(0, table[i - 1][j - 1] + same, table[i - 1][j] - 1, table[i][j - 1] - 1)
            best = max(best, table[i][j])
    return best


def test_alignment_by_brute_force():
    rng = np.random.default_rng(1)
    for _ in range(30):
        item = rng.integers(1, 6, 9).astype(np.uint64)
        windows = rng.integers(1, 6, (4, 17)).astype(np.uint64)
        best, _ = decontaminate.align(item, windows)
        assert best.tolist() == [brute_align(item, w) for w in windows]


def test_leaks_are_found(spark, docs, none):
    item = "the quick brown fox jumps over the lazy dog while seven wizards quietly boil some green tea"
    bench = spark.createDataFrame([(1, item, "x"), (2, "too short", "x"), (3, None, "x"), (4, "", "x")], "item_id long, text string, score string")
    edited = item.replace("lazy ", "").replace("wizards", "witches").replace("some", "some more")
    rows = [(1, f"before it {item.upper()}! and after"), (2, f"a b c {edited} d"), (3, "the quick brown dog boils tea over seven foxes"), (4, None)]
    table = spark.createDataFrame(rows, "doc_id long, text string")
    out = {r.doc_id: r for r in decontaminate.find_leaks(table, bench).collect()}
    assert set(out) == {1, 2} and out[1].score == 1.0 and 0.5 <= out[2].score < 1
    assert (out[1].start_word, out[1].end_word) == (2, 2 + len(item.split()))
    assert {r.doc_id for r in decontaminate.drop_leaks(table, bench).collect()} == {3, 4}
    assert decontaminate.find_leaks(docs, bench).count() == 0
    assert decontaminate.find_leaks(none, bench).count() == 0
    assert decontaminate.find_leaks(table, bench.limit(0)).count() == 0


def test_quality_learns_from_positives(spark, sf, none):
    table = spark.read.parquet(f"{sf}/documents.parquet")
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    out = quality.classify(table, labels, tx.fold("doc_id", 4) != 2)
    assert out.count() == table.count()
    held = out.where("held_out").join(labels, "doc_id").select("predicted", "quality").collect()
    assert sum(r.predicted == r.quality for r in held) >= 0.75 * len(held)
    assert quality.classify(none, labels, tx.fold("doc_id", 4) != 2).count() == 0
    assert {r.score for r in quality.classify(table.limit(3), labels.limit(0), F.lit(True)).collect()} == {0.5}


def test_swapping_identity_terms_changes_little(spark, docs, none):
    rows, marks = [], []
    for i in range(300):
        bad = i % 3 == 0
        # Toxic texts mention one group far more often: a plain model would learn it.
        rows.append((i, f"text {'muslim ' if bad else ''}about {'zorgle' if bad and i % 2 else 'things'} {'wretch' if bad else 'fine'} number"))
        marks.append((i, 1, int(bad)))
    table = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame(marks, "doc_id long, quality int, toxic int")
    model = toxicity.train(table, labels, F.lit(True))
    pair = model.score(pa.array(["a muslim teacher came", "a christian teacher came", "a teacher came", "you wretch", None]))
    assert abs(pair[0] - pair[1]) < 0.05 and abs(pair[0] - pair[2]) < 0.05 and pair[3] > 0.9
    out = toxicity.classify(docs, labels, F.lit(True))
    assert out.count() == len(ROWS)
    assert toxicity.classify(none, labels.limit(0), F.lit(True)).count() == 0


def test_all_toxic_terms_have_weight(spark):
    rows, marks = [], []
    for i in range(3000):
        bad = i % 3 == 0
        # 200 toxic terms with features of their own, each in five documents.
        own = f"{chr(97 + i // 3 % 20)}{chr(97 + i // 60 % 10)}qzx{'abcdefghij'[i // 60 % 10]}"
        rows.append((i, f"some plain text about {own if bad else 'weather'} and more of it"))
        marks.append((i, 1, int(bad)))
    table = spark.createDataFrame(rows, "doc_id long, text string")
    model = toxicity.train(table, spark.createDataFrame(marks, "doc_id long, quality int, toxic int"), F.lit(True))
    terms = sorted({t.split()[4] for i, t in rows if i % 3 == 0})
    places = {int(c) for c in model.codes}
    assert len(terms) == 200 and all(toxicity.code_of(t) in places for t in terms)
    alone = model.score(pa.array([f"some plain text about {t}" for t in terms] + ["some plain text about weather"]))
    assert alone[:-1].min() > 0.9 and alone[-1] < 0.1


def test_toxicity_held_out(spark):
    folder = "/root/testdata/sf0.01"
    table, labels = (spark.read.parquet(f"{folder}/{n}.parquet") for n in ("documents", "labels"))
    out = toxicity.classify(table, labels, tx.fold("doc_id", 3) != 1)
    held = out.where("held_out").join(labels, "doc_id").select("predicted", "toxic").collect()
    assert sum(r.predicted == r.toxic for r in held) >= 0.92 * len(held)


def test_toxicity_weights_against_dense_newton():
    """The sparse solver ends where a dense Newton method on the same loss ends."""
    draw = np.random.default_rng(3)
    dense = np.log1p(draw.poisson(0.4, (120, 9))).astype(float)
    y = (dense @ draw.normal(size=9) + 0.5 * draw.normal(size=120) > 0.2).astype(float)
    row, place = np.nonzero(dense)
    own = np.array([1, 4, 6])
    difference = np.array([[1.0, -1.0, 0.0], [0.0, 1.0, -1.0], [1.0, 0.0, 0.0]])
    weight = np.array([0.5, 0.3, 0.2])
    found, bias = toxicity.fit_weights((row, place, dense[row, place]), y, 9, own, difference, weight)

    wide = np.c_[dense, np.ones(120)]
    swap = np.zeros((3, 10))
    swap[:, own] = difference
    pull = 2 * toxicity.PENALTY * (swap * weight[:, None]).T @ swap
    pull += np.diag(np.r_[np.full(9, toxicity.RIDGE), 1e-9])
    w = np.zeros(10)
    for _ in range(100):
        p = 1 / (1 + np.exp(-wide @ w))
        bent = (wide * (p * (1 - p))[:, None]).T @ wide / 120 + pull
        step = np.linalg.solve(bent, wide.T @ (p - y) / 120 + pull @ w)
        w -= step * min(1.0, 1.0 / max(np.abs(step).max(), 1e-12))
    assert np.r_[found, bias] == pytest.approx(w, abs=1e-2)


def test_toxicity_driver_holds_codes_of_the_sample_only(spark):
    """More rows with other words bring no more codes to the driver."""
    def model(n):
        texts = [(i, f"plain words w{i % n} " + ("awful slur" if i % 2 else "kind"), i % 2) for i in range(20 * n)]
        docs = spark.createDataFrame([t[:2] for t in texts], "doc_id long, text string")
        labels = spark.createDataFrame([(t[0], t[2]) for t in texts], "doc_id long, toxic int")
        return toxicity.train(docs, labels, F.lit(True), fit_rows=40), texts

    small, _ = model(4)
    large, texts = model(40)
    assert len(large.codes) <= len(small.codes) + 3 * 60
    scores = large.score(pa.array([t[1] for t in texts]))
    assert min(s for s, t in zip(scores, texts) if t[2]) > max(s for s, t in zip(scores, texts) if not t[2])


def test_long_sketches_of_many_short_texts_take_bounded_memory():
    """A piece of short texts has many rows; their long sketches are made a few hundred at a time."""
    import tracemalloc

    import pyarrow as pa

    from cartwise.llm import minhash

    texts = pa.array([f"a{i} b c d e f" for i in range(10_000)])
    batch = pa.RecordBatch.from_pydict({"text": texts, "want": pa.array([b"x"] * len(texts))})
    tracemalloc.start()
    rows_ = sum(len(b) for b in minhash._set_batches(5)(iter([batch])))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert rows_ == len(texts)
    assert peak < 40 << 20, peak


def test_small_link_tables_take_few_tasks(spark):
    """A short table of links is not written as one file a shuffle partition; a chain, a star and a loop."""
    chain = [(i, i + 1) for i in range(100, 160)]
    links = chain + [(7, i) for i in range(200, 260)] + [(300, 301), (301, 302), (300, 302)]
    names = ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")
    before = {name: spark.conf.get(name) for name in names}
    try:
        spark.conf.set(names[0], "64")
        spark.conf.set(names[1], "false")
        roots = minhash.connected(spark.createDataFrame(links, "a long, b long"))
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
    expected = {i: 100 for i in range(100, 161)} | {i: 7 for i in (7, *range(200, 260))} | {300: 300, 301: 300, 302: 300}
    assert {r.node: r.root for r in roots.collect()} == expected
    assert len(roots.inputFiles()) <= spark.sparkContext.defaultParallelism
