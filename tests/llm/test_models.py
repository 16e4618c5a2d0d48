"""Searches and learned operators against brute force and held-out rows."""

from __future__ import annotations

import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from starwright.llm import knn_quality, registry, rotated_bits, zstd_langid
from tests.conftest import SMALL
from tests.llm.conftest import framed

MEDIUM = "/root/testdata/sf0.01"


def plain_nearest(rows, asked, most):
    """``rows``: id and vector of those that take part."""
    ids = np.array([i for i, _ in rows])
    vectors = np.array([v for _, v in rows], np.float64)
    for i in sorted(set(asked)):
        own = vectors[np.flatnonzero(ids == i)[0]]
        distance = np.sqrt(((vectors - own) ** 2).sum(axis=1))
        order = [k for k in np.lexsort((ids, distance)) if ids[k] != i][:most]
        yield from ((i, n + 1, int(ids[k]), distance[k]) for n, k in enumerate(order))


@pytest.mark.parametrize("dims", [3, 64, 70])
def test_neighbours_equal_brute_force(spark, dims, monkeypatch):
    monkeypatch.setattr(rotated_bits, "ROW_BLOCK", 37)
    monkeypatch.setattr(rotated_bits, "QUERY_BLOCK", 9)
    monkeypatch.setattr(rotated_bits, "WIDTH", 1e6)  # no bound can fail
    rng = np.random.default_rng(dims)
    rows = [(i, rng.standard_normal(dims).astype(np.float32).tolist()) for i in range(300)]
    hot = rows[20][1]
    rows += [(1000 + i, hot) for i in range(60)]
    odd = [
        (None, hot), (5000, None), (5010, [0.0] * dims), (5020, [float("nan"), *hot[1:]]),
        (5030, [None, *hot[1:]]), (5040, [*hot, 1.0]), (5050, []), (5060, [float("inf"), *hot[1:]]),
    ]
    frame = framed(spark, rows + odd, "vec_id long, embedding array<float>").repartition(3)
    found = rotated_bits.nearest(spark, frame, F.col("vec_id") % 10 == 0, most=7)
    assert found.columns == ["query_id", "rank", "vec_id", "score"]
    got = sorted(map(tuple, found.collect()))
    want = sorted(plain_nearest(rows, [i for i, _ in rows if i % 10 == 0], 7))
    assert [row[:3] for row in got] == [row[:3] for row in want]
    assert np.allclose([row[3] for row in got], [row[3] for row in want], rtol=1e-12)


def test_recall_with_the_real_bound(spark):
    vectors = spark.read.parquet(f"{MEDIUM}/embeddings.parquet")
    rows = [(row.vec_id, row.embedding) for row in vectors.collect()]
    asked = [i for i, _ in rows if i % 10 == 0]
    found = rotated_bits.nearest(spark, vectors, F.col("vec_id") % 10 == 0).collect()
    got = {(row.query_id, row.vec_id) for row in found}
    want = {(i, j) for i, _, j, _ in plain_nearest(rows, asked, 10)}
    assert len(got & want) / len(want) > 0.98


def test_estimates_are_inside_their_bounds():
    rng = np.random.default_rng(1)
    vectors, queries = rng.standard_normal((400, 64)), rng.standard_normal((50, 64))
    coder = rotated_bits.Coder(vectors.mean(axis=0))
    low, high = coder.squared_range(*coder.encode(vectors), *coder.turned(queries))
    real = ((vectors[:, None] - queries) ** 2).sum(axis=2)
    assert ((low <= real) & (real <= high)).mean() > 0.95
    # Centred, rotated signs give an estimate without bias.
    assert abs(((low + high) / 2 - real).mean()) < 0.5


def test_fewer_candidates_than_asked_for(spark):
    frame = spark.createDataFrame(
        [(0, [1.0, 0.0]), (1, [0.0, 1.0]), (2, [0.0, 1.0])], "vec_id long, embedding array<float>"
    )
    found = rotated_bits.nearest(spark, frame, F.col("vec_id") == 0).collect()
    assert sorted((row.rank, row.vec_id) for row in found) == [(1, 1), (2, 2)]


def test_search_without_usable_vectors(spark):
    frame = spark.createDataFrame(
        [(0, None), (1, [0.0])], "vec_id long, embedding array<float>"
    )
    for rows in (frame, frame.where("false")):
        assert rotated_bits.nearest(spark, rows, F.col("vec_id") == 0).count() == 0


@pytest.mark.parametrize("scale, far", [(1.0, 1e30), (1e-30, 1.0), (1e25, 1e38)])
def test_neighbours_beside_very_long_and_short_vectors(spark, monkeypatch, scale, far):
    monkeypatch.setattr(rotated_bits, "ROW_BLOCK", 37)
    rng = np.random.default_rng(5)
    rows = [
        (i, (scale * rng.standard_normal(8)).astype(np.float32).tolist()) for i in range(300)
    ]
    for others in ([], [(1000, [far, *rows[0][1][1:]])]):
        frame = spark.createDataFrame(rows + others, "vec_id long, embedding array<float>")
        found = rotated_bits.nearest(spark, frame, F.col("vec_id") % 50 == 0, most=5)
        got = sorted(map(tuple, found.collect()))
        asked = [i for i, _ in rows + others if i % 50 == 0]
        want = sorted(plain_nearest(rows + others, asked, 5))
        assert len(got) == len(want)
        assert len({r[:3] for r in got} & {r[:3] for r in want}) > 0.9 * len(want)


def test_distances_beyond_double_precision(spark):
    rows = [(i, [1e300 * (i - 2), 1.0]) for i in range(5)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = rotated_bits.nearest(spark, frame, F.col("vec_id") == 0, most=3).collect()
    assert sorted((row.rank, row.vec_id) for row in found) == [(1, 1), (2, 2), (3, 3)]


def test_quality_of_held_out_documents(spark):
    found = registry.op7_quality(spark, MEDIUM)
    labels = spark.read.parquet(f"{MEDIUM}/labels.parquet")
    rows = found.join(labels, "doc_id").where("held_out").collect()
    assert found.count() == spark.read.parquet(f"{MEDIUM}/documents.parquet").count()
    assert np.mean([row.predicted == row.quality for row in rows]) > 0.95
    assert all(0 <= row.score <= 1 for row in rows)


def test_votes_equal_a_plain_vote():
    texts = [f"Some plain words number {i} follow" for i in range(30)]
    texts += [f"LOUD!! WORDS!! {i}!! NOW!!" for i in range(30)]
    counts = knn_quality.term_counts(knn_quality.texts_of(pa.array(texts)))
    labels = np.array([1.0] * 30 + [0.0] * 30)
    model = knn_quality.fit_counts(counts, labels, 0.5)
    got = model.score(counts)
    for row, vector in enumerate(model.latent(counts)):
        near = model.vectors @ vector
        best = np.argsort(-near)[: knn_quality.NEIGHBOURS]
        weight = np.maximum(near[best], 0).astype(float) ** knn_quality.SHARPNESS
        assert abs(got[row] - (weight * labels[best]).sum() / weight.sum()) < 1e-4
    assert (got[:30] > 0.9).all() and (got[30:] < 0.1).all()


def test_repeated_words_are_terms_of_their_own():
    one, two = knn_quality._shape_counts(knn_quality.texts_of(pa.array(["so so so", "ab cd ef"])))
    assert one.sum() == two.sum() == 3 and (one != two).any()


def labelled(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


def test_quality_of_odd_texts(spark, odd, odd_rows, empty):
    labels = labelled(spark, [(1, 1, 0), (2, 0, 0), (2, 0, 0), (7, None, 0), (None, 1, 0), (99, 1, 0)])
    model = knn_quality.fit(odd, labels, F.lit(True))
    rows = knn_quality.predict(odd, model).collect()
    assert len(rows) == len(odd_rows) and all(0 <= row.score <= 1 for row in rows)
    assert all(row.predicted == int(row.score >= 0.3) for row in rows)
    assert knn_quality.predict(empty, model).count() == 0


def test_without_labels_the_score_is_a_half(spark, odd):
    model = knn_quality.fit(odd, labelled(spark, []), F.lit(True))
    assert {row.score for row in knn_quality.predict(odd, model).collect()} == {0.5}


def test_language_of_held_out_documents(spark):
    found = registry.op9_language(spark, MEDIUM)
    langs = spark.read.parquet(f"{MEDIUM}/documents.parquet").select("doc_id", "lang")
    rows = found.join(langs, "doc_id").where("held_out").collect()
    assert len(rows) > 200
    assert np.mean([row.lang_pred == row.lang for row in rows]) > 0.95
    sure = [row for row in rows if not row.rejected]
    assert np.mean([row.lang_pred == row.lang for row in sure]) > 0.97


def test_languages_equal_a_plain_loop(spark, odd, odd_rows, tmp_path):
    """Every text with every dictionary; the smallest size wins."""
    import math

    import zstandard as zstd

    docs = spark.read.parquet(f"{MEDIUM}/documents.parquet")
    learned = zstd_langid.learn(docs)
    settings = zstd.ZstdCompressionParameters.from_level(
        zstd_langid.LEVEL, min_match=zstd_langid.MATCH, strategy=zstd_langid.STRATEGY,
        write_content_size=False, write_dict_id=False,
    )
    rows = odd_rows + [tuple(r) for r in docs.select("doc_id", "text").limit(200).collect()]
    want = []
    for doc_id, text in rows:
        if not any(map(str.isalpha, text or "")):
            want.append((doc_id, "und", 0.0, True))
            continue
        data, sizes = zstd_langid.reduced(text), []
        for content in learned.values():
            raw = zstd.ZstdCompressionDict(content, zstd.DICT_TYPE_RAWCONTENT)
            coder = zstd.ZstdCompressor(dict_data=raw, compression_params=settings)
            step = zstd_langid.BLOCK_BYTES
            sizes.append(sum(
                len(coder.compress(data[i : i + step])) for i in range(0, len(data), step)
            ))
        best, second = sorted(sizes)[:2]
        shares = [2.0 ** -min(8 * (size - best) / math.sqrt(best), 60 / math.sqrt(best)) for size in sizes]
        want.append((
            doc_id, list(learned)[sizes.index(best)], round(1 / sum(shares), 9),
            (second - best) / best < 0.01,
        ))
    found = zstd_langid.predict(framed(spark, rows), learned).collect()
    got = [(r.doc_id, r.lang_pred, round(r.score, 9), r.rejected) for r in found]
    assert sorted(got, key=repr) == sorted(want, key=repr)


def test_samples_meet_in_parts(spark, monkeypatch):
    """No task ranks all rows of a key before they are few."""
    from starwright.llm import common

    rows = spark.range(5000).select(
        F.when(F.col("id") % 10 < 9, "hot").otherwise("rare").alias("key"),
        F.xxhash64("id").alias("h"),
    )
    found = common.first_by_hash(rows, "key", "h", 20)
    every = {}
    for row in rows.collect():
        every.setdefault(row.key, []).append(row.h)
    want = {(key, h) for key, hashes in every.items() for h in sorted(hashes)[:20]}
    assert set(map(tuple, found.collect())) == want
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Window [") == 2


def test_languages_of_odd_texts(spark, odd, odd_rows, empty):
    rows = [(i, text, "xx" if i % 2 else "yy") for i, text in odd_rows if i is not None]
    docs = framed(spark, rows + [(900, "no language", None)], "doc_id long, text string, lang string")
    learned = zstd_langid.learn(docs)
    assert set(learned) == {"xx", "yy"}
    assert all(len(data) <= zstd_langid.DICTIONARY_BYTES for data in learned.values())
    found = zstd_langid.predict(odd, learned).collect()
    assert len(found) == len(odd_rows)
    letters = {i for i, text in odd_rows if text and any(c.isalpha() for c in text)}
    for row in found:
        if row.doc_id is not None:
            assert (row.lang_pred != "und") == (row.doc_id in letters)
        assert 0 <= row.score <= 1
    assert zstd_langid.predict(empty, learned).count() == 0
    assert {r.lang_pred for r in zstd_langid.predict(odd, {}).collect()} == {"und"}
    assert zstd_langid.learn(docs.where("false")) == {}


def test_copies_do_not_fill_a_dictionary(spark, monkeypatch):
    monkeypatch.setattr(zstd_langid, "SAMPLE_TEXTS", 5)
    rng = random.Random(1)
    rows = [(i, "the very same text", "xx") for i in range(500)]
    rows += [(1000 + i, "".join(rng.choices("abcdefgh ", k=80)), "xx") for i in range(4)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    assert zstd_langid.learn(docs)["xx"].count(b"the very same text") == 1


def test_dictionaries_hold_more_than_openings(spark, monkeypatch):
    monkeypatch.setattr(zstd_langid, "DICTIONARY_BYTES", 4_800)
    rng = random.Random(4)
    bodies = [["".join(rng.choices("abcdefgh", k=8)) for _ in range(400)] for _ in range(30)]
    rows = [(i, "the same licence line " * 20 + " ".join(b), "xx") for i, b in enumerate(bodies)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    data = zstd_langid.learn(docs)["xx"].decode()
    assert len(data) > 2_000 and data.count("licence") < 60
    assert sum(any(f" {word} " in data for word in body) for body in bodies) >= 15


def test_rare_languages_have_labels_of_their_own(spark, monkeypatch):
    monkeypatch.setattr(zstd_langid, "ALL_BYTES", 300 * 1_000)
    rng = random.Random(3)
    rows = []
    for n in range(300):
        words = ["".join(rng.choices("abcdefghijklmnop", k=7)) for _ in range(12)]
        # The first languages have more texts, the others are rare.
        for i in range(3 if n < 200 else 2):
            rows.append((len(rows), " ".join(rng.choices(words, k=40)), f"l{n:03}"))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(2)
    learned = zstd_langid.learn(docs)
    assert len(learned) == 300 and all(0 < len(data) <= 1_000 for data in learned.values())
    found = {row.doc_id: tuple(row) for row in zstd_langid.predict(docs, learned).collect()}
    assert all(found[i][1] == lang for i, _, lang in rows)
    monkeypatch.setattr(zstd_langid, "OPEN_LANGUAGES", 400)
    whole = {row.doc_id: tuple(row) for row in zstd_langid.predict(docs, learned).collect()}
    assert whole == found


def test_folds_follow_the_crc_of_the_id(spark):
    ids = spark.range(200).withColumnRenamed("id", "doc_id")
    rows = ids.select("doc_id", registry.fold("doc_id", 5).alias("fold")).collect()
    assert all(row.fold == zlib.crc32(str(row.doc_id).encode()) % 5 for row in rows)


def test_small_tables_have_rows(spark):
    assert registry.op3_nearest(spark, SMALL).count() > 0
