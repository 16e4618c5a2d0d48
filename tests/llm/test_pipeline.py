"""The corpus pipeline, stage by stage, against what the operators say about each input."""

from __future__ import annotations

import hashlib

import corpus_pipeline as pipeline
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from starwright.llm import decontam, knn_quality, pii, registry, simhash
from tests.llm.conftest import framed

MEDIUM = "/root/testdata/sf0.01"
NAMES = [name for name, _ in pipeline.STAGES]


@pytest.fixture(scope="module")
def steps(spark, tmp_path_factory):
    """Input and output of every stage, each written and read again."""
    folder = tmp_path_factory.mktemp("pipeline")
    docs = spark.read.parquet(f"{MEDIUM}/documents.parquet")
    found = {}
    for name, stage in pipeline.STAGES:
        stage(spark, docs, MEDIUM).write.parquet(f"{folder}/{name}")
        after = spark.read.parquet(f"{folder}/{name}")
        found[name] = (docs, after)
        docs = after
    return found


def ids(df):
    return sorted(row.doc_id for row in df.select("doc_id").collect())


def test_all_but_the_last_stage_return_documents(steps):
    for name in NAMES[:-1]:
        before, after = steps[name]
        assert after.dtypes == before.dtypes
    assert NAMES == [
        "quality_classifier", "simhash_near_dedup", "benchmark_decontamination", "pii", "bpe",
    ]


def test_rejected_documents_go(spark, steps):
    before, after = steps["quality_classifier"]
    labels = spark.read.parquet(f"{MEDIUM}/labels.parquet")
    model = knn_quality.fit(before, labels, registry.fold("doc_id", 5) != 0)
    kept = knn_quality.predict(before, model).where("score >= 0.3")
    assert ids(after) == ids(kept) and 0 < after.count() < before.count()
    good = before.join(labels.where("quality = 1"), "doc_id")
    lost = good.join(after, "doc_id", "left_anti").count()
    assert lost < 0.02 * good.count()


def test_one_of_each_group_stays(steps):
    before, after = steps["simhash_near_dedup"]
    found = simhash.near_duplicates(before, 3, 3)
    assert ids(after) == sorted({row.component_id for row in found.collect()})
    assert after.count() < before.count()


def test_contaminated_documents_go(spark, steps):
    before, after = steps["benchmark_decontamination"]
    benchmark = spark.read.parquet(f"{MEDIUM}/benchmark.parquet")
    found = decontam.decontaminate(before, benchmark)
    assert ids(after) == ids(found.where("not contaminated"))
    assert decontam.decontaminate(after, benchmark).where("contaminated").count() == 0


def test_texts_lose_their_personal_data(steps):
    before, after = steps["pii"]
    model = pii.fit(before)
    texts = {row.doc_id: row for row in after.collect()}
    changed = 0
    for row in before.collect():
        spans = pii.spans_of(row.text, model)[1]
        masked = texts[row.doc_id]
        assert masked.text == pii.mask(row.text, spans)
        assert masked.n_chars == len(masked.text)
        assert (masked.lang, masked.source) == (row.lang, row.source)
        changed += bool(spans)
    assert changed > 0


def test_the_last_stage_has_the_tokens(steps):
    before, after = steps["bpe"]
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    found = {row.doc_id: row for row in after.collect()}
    for row in before.collect():
        tokens = tokenizer.encode(row.text, add_special_tokens=False).ids
        listed = ",".join(map(str, tokens))
        assert found[row.doc_id].ids == tokens and found[row.doc_id].n_tokens == len(tokens)
        assert found[row.doc_id].ids_sha256 == hashlib.sha256(listed.encode()).hexdigest()


def test_run_is_the_stages_in_order(spark, steps):
    found = pipeline.run(spark, MEDIUM)
    want = steps["bpe"][1]
    assert sorted(map(str, found.collect())) == sorted(map(str, want.collect()))


@pytest.mark.parametrize("stage", [f for _, f in pipeline.STAGES], ids=NAMES)
def test_stages_take_odd_documents(spark, odd_rows, stage):
    docs = framed(
        spark, [(*row, None, "s", None) for row in odd_rows],
        "doc_id long, text string, lang string, source string, n_chars long",
    )
    found = stage(spark, docs, MEDIUM)
    assert found.count() > 0
    if stage is not pipeline.tokenize:
        assert found.columns == docs.columns
    # Documents without an id take part; the one without a text is a copy of another such.
    if stage in (pipeline.drop_near_duplicates, pipeline.drop_contaminated):
        unnamed = 1 if stage is pipeline.drop_near_duplicates else 2
        assert found.where("doc_id is null").count() == unnamed
    assert stage(spark, docs.where("false"), MEDIUM).count() == 0


def test_rows_with_one_id_or_none_are_judged_each_by_itself(spark):
    leak = spark.read.parquet(f"{MEDIUM}/benchmark.parquet").where("length(text) > 80").first().text
    schema = "doc_id long, text string, row_number string"
    one, two, three, four = (
        f"{word} " * 9 + f"number {word} ends" for word in ("ape", "bee", "cow", "dog")
    )
    docs = spark.createDataFrame(
        [(1, one, "a"), (1, one, "b"), (2, one, "c"), (2, two, "d"), (3, two, "e"), (4, three, "f"),
         (None, three, "g"), (None, four, "h"), (None, four, "i")], schema,
    ).repartition(3)
    found = pipeline.drop_near_duplicates(spark, docs, MEDIUM).collect()
    names = sorted(row.row_number for row in found)
    # One of the repeated rows stays; a row is not lost by what another one with its id is.
    # Of copies without an id the first stays, or none beside a row that has one.
    assert names[1:3] == ["d", "f"] and names[0] in "ab" and names[3] in "hi" and len(names) == 4
    docs = spark.createDataFrame(
        [(1, one, "a"), (1, f"{one} {leak}", "b"), (None, leak, "c"), (None, two, "d"),
         (2, leak, "e"), (3, three, "f"), (3, three, "g")], schema,
    ).repartition(3)
    found = pipeline.drop_contaminated(spark, docs, MEDIUM)
    assert found.columns == docs.columns
    assert sorted(row.row_number for row in found.collect()) == ["a", "d", "f", "g"]
