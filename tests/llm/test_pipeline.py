import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from hypso.llm import dedup_exact, langid, minhash, packing, quality, queries
from hypso.llm.shared import file_bytes, table

DATA = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def test_stages_take_effect(spark):
    """Each stage equals its operator's decisions, applied by brute force to all that its predecessor kept."""
    docs = table(spark, DATA, "documents")
    named = dict(corpus_pipeline.STAGES)
    assert list(named) == ["language", "quality", "exact", "near", "packing"]
    for name in ("language", "quality", "exact", "near"):
        before = {r.doc_id: r.text for r in docs.collect()}
        kept = named[name](spark, docs, DATA)
        assert kept.columns == COLUMNS
        rows = [tuple(r) for r in kept.collect()]
        if name == "language":
            told = {r.doc_id for r in langid.identify_documents(docs).collect() if r.lang_pred != "und"}
        elif name == "quality":
            told = {r.doc_id for r in quality.score_documents(docs, table(spark, DATA, "labels")).collect() if r.predicted}
        elif name == "exact":
            told = {r.doc_id for r in dedup_exact.exact_dedup(docs).collect() if r.kept}
        else:
            told = {r.doc_id for r in minhash.near_duplicates(docs).collect() if r.kept}
        assert sorted(r[0] for r in rows) == sorted(told)
        assert all(before[r[0]] == r[1] for r in rows)
        docs = spark.createDataFrame(rows, kept.schema)
    packed = named["packing"](spark, docs, DATA)
    assert packed.select("doc_id").distinct().count() == docs.count()
    whole = corpus_pipeline.run(spark, DATA)
    assert whole.agg(F.sum("length"), F.count("*")).first() == packed.agg(F.sum("length"), F.count("*")).first()


CLASHES = ["_lang", "_score", "_own_key", "_OWN_KEY_", "kept_id", "lang_pred", "score", "told", "key", "n", "id", "best", "component_id", "kept"]


def test_awkward_tables(spark):
    """Nulls, empty texts, repeated rows, empty tables, and columns named like those that operators use inside."""
    words = " ".join(f"w{k}" for k in range(60))
    rows = [(1, None, None, None, None), (2, "", "en", "s", 0), (None, "the null id is here", "en", "s", 3), (4, "the cat sat on the mat", "en", "s", 2), (4, "the cat sat on the mat", "en", "s", 2)]
    rows += [(5, words, "en", "s", 1), (6, words + " x", "en", "s", 1), (7, words.upper(), "en", "s", 1), (None, words, "en", "s", 1), (8, "12 34 !", "en", "s", 1)]
    plain = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    extra = plain.select("*", *(F.concat(F.lit(c), F.lit(":"), F.col("doc_id").cast("string")).alias(c) for c in CLASHES))
    stages = dict(corpus_pipeline.STAGES)
    for some in (plain, extra):
        got = {}
        for name in ("language", "quality", "exact", "near"):
            left = stages[name](spark, some, DATA)
            assert left.columns == some.columns and left.schema == some.schema
            got[name] = left.collect()
            if some is extra:
                assert all(r[c] == (None if r.doc_id is None else f"{c}:{r.doc_id}") for r in got[name] for c in CLASHES)
        assert sorted(str(r.doc_id) for r in got["language"]) == ["4", "4", "5", "6", "7", "None", "None"]
        assert sorted(str(r.doc_id) for r in got["exact"]) == ["2", "4", "6", "7", "8", "None"]
        assert sorted(str(r.doc_id) for r in got["near"]) == ["1", "2", "4", "4", "5", "8", "None", "None"]
        assert stages["packing"](spark, some, DATA).count() == len(rows)
        for stage in stages.values():
            assert stage(spark, some.where("false"), DATA).count() == 0


def test_clean_documents_stay(spark):
    docs = table(spark, DATA, "documents")
    good = {r.doc_id for r in table(spark, DATA, "labels").where("quality = 1").collect()}
    kept = docs
    for name in ("language", "quality"):
        kept = dict(corpus_pipeline.STAGES)[name](spark, kept, DATA)
    left = {r.doc_id for r in kept.collect()}
    assert len(good - left) <= 0.05 * len(good)
    assert packing.SIZE == 2048 and file_bytes(queries.WORD_BPE)


@pytest.mark.parametrize("name", list(queries.queries()))
def test_names(name):
    assert name.startswith("op")
