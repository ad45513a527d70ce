"""The corpus pipeline on made documents and on an empty table."""
import random

import pytest

import corpus_pipeline
from csvforge.llm import tokens

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
SYLLABLES = {"en": ["the", "ing", "sh", "ow", "ck"], "fr": ["eau", "que", "ois", "ill", "eux"]}


def prose(rnd, lang, n):
    return " ".join("".join(rnd.choice(SYLLABLES[lang]) for _ in range(rnd.randint(2, 4))) for _ in range(n))


@pytest.fixture(scope="module")
def documents():
    rnd = random.Random(17)
    texts = [(prose(rnd, lang, rnd.randint(60, 160)), lang) for _ in range(45) for lang in SYLLABLES]
    near = texts[4][0].split()
    near[7] = "x" + near[7]
    passage = prose(rnd, "en", 70)
    extra = [(texts[0][0], "en"), (texts[0][0], "en"), (" ".join(near), "en"), (f"{prose(rnd, 'en', 80)} {passage} {prose(rnd, 'en', 40)}", "en"),
             (f"{prose(rnd, 'en', 50)} {passage} {prose(rnd, 'en', 60)}", "en"), (None, "en"), ("", "fr"), ("12 34 !", None)]
    return [(i, t, lang, f"src{i % 4}", len(t or "")) for i, (t, lang) in enumerate(texts + extra)], passage


def test_pipeline_on_made_documents(spark, tmp_path, documents):
    rows, passage = documents
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    columns, seen = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, str(tmp_path))
        out.write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
        seen[name] = docs.collect()
        assert name == "packing" or docs.columns == columns
    clean = {r[0] for r in rows[:90]}
    assert {r.doc_id for r in seen["language_id"]} == {r[0] for r in rows[:-3]}          # no text, no letter: gone
    kept = {r.doc_id for r in seen["near_duplicates"]}
    assert len(kept & {0, 90, 91}) == 1 and len(kept & {4, 92}) == 1 and clean - {0, 4} <= kept
    texts = {r.doc_id: r.text for r in seen["repeated_passages"]}
    assert sum(passage in t for t in texts.values()) == 1 and texts.keys() == kept
    mixed = {r.doc_id for r in seen["mixing"]}
    assert mixed <= kept and len(mixed) == len(seen["mixing"]) > 0.6 * len(kept)
    n = {r.doc_id: tokens.count_texts([r.text or ""], tokens.VOCABULARY)[0] + 1 for r in seen["mixing"]}
    packed = {}
    for r in seen["packing"]:
        packed[r.doc_id] = packed.get(r.doc_id, 0) + r.length
    assert packed == n
    whole = corpus_pipeline.run(spark, str(tmp_path))
    assert {(r.doc_id, r.piece, r.length, r.ids_crc32) for r in whole.collect()} == {
        (r.doc_id, r.piece, r.length, r.ids_crc32) for r in seen["packing"]}


def test_pipeline_on_an_empty_table(spark, tmp_path):
    spark.createDataFrame([], SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
