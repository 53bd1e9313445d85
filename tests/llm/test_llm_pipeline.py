"""The stages of the pipeline on NULL and repeated ids, empty and very long texts, empty tables and extra columns."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline

TINY = "/root/testdata/sf0.001"
STAGES = dict(corpus_pipeline.STAGES)
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
PASSAGE = " ".join(f"plain{i}" for i in range(60))
OTHER = " ".join(f"other{i}" for i in range(80))
LONG = " ".join(f"word{i % 997}x{i // 997}" for i in range(30_000))


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    """The small tables, with a benchmark item and no labels but for a few."""
    folder = str(tmp_path_factory.mktemp("tables"))
    items = spark.createDataFrame([(1, OTHER), (2, None)], "item_id long, text string")
    items.write.parquet(f"{folder}/benchmark.parquet")
    spark.read.parquet(f"{TINY}/labels.parquet").write.parquet(f"{folder}/labels.parquet")
    return folder


def frame(spark, rows):
    docs = spark.createDataFrame([(i, t, "en", s, None if t is None else len(t)) for i, t, s in rows], SCHEMA)
    return docs.withColumns({c: F.lit("x") for c in ("kept", "node", "k1", "words", "score", "hash", "no_id")})


def kept(df):
    return sorted((r.doc_id is None, r.doc_id or 0, r.text or "", r.source) for r in df.collect())


def test_near_duplicates_by_row(spark, tables):
    docs = frame(
        spark,
        [
            (5, PASSAGE, "a"),
            (None, PASSAGE, "a"),  # a copy without an id goes
            (5, OTHER, "a"),  # the same id with another text stays
            (7, OTHER + " more", "a"),  # a near copy of it goes
            (8, LONG, "a"),
            (8, LONG, "a"),  # equal rows: one stays
            (8, LONG, "b"),  # an equal text of another source goes
            (9, None, "a"),
            (9, None, "a"),
            (10, "", "a"),
        ],
    )
    out = STAGES["near_duplicates"](spark, docs, tables)
    assert out.columns == docs.columns
    found = kept(out)
    assert found == sorted(
        [
            (False, 5, PASSAGE, "a"),
            (False, 5, OTHER, "a"),
            next(r for r in found if r[1] == 8),
            (False, 9, "", "a"),
            (False, 10, "", "a"),
        ]
    )


def test_contamination_by_row(spark, tables):
    docs = frame(
        spark,
        [(1, PASSAGE, "a"), (1, "so " + OTHER, "a"), (None, OTHER, "a"), (None, PASSAGE, "a"), (2, None, "a"), (3, "", "a"), (4, LONG, "a")],
    )
    out = STAGES["decontamination"](spark, docs, tables)
    assert out.columns == docs.columns
    assert kept(out) == sorted(
        [(False, 1, PASSAGE, "a"), (True, 0, PASSAGE, "a"), (False, 2, "", "a"), (False, 3, "", "a"), (False, 4, LONG, "a")]
    )


@pytest.mark.parametrize("name", list(STAGES)[:-1])
def test_stages_on_nothing_and_on_odd_rows(spark, tables, name):
    docs = frame(spark, [(None, None, "a"), (1, "", "a"), (1, "", "a"), (2, LONG, "a"), (3, "ein Satz", None)])
    assert STAGES[name](spark, docs.limit(0), tables).count() == 0
    out = STAGES[name](spark, docs, tables)
    assert out.columns == docs.columns
    assert out.count() == (4 if name == "near_duplicates" else 5)


def test_packing_of_odd_rows(spark, tables):
    docs = frame(spark, [(None, None, "a"), (1, "", "a"), (1, "", "a"), (2, LONG, "a")])
    rows = STAGES["packing"](spark, docs, tables).collect()
    assert sum(r.length for r in rows) == sum(r.doc_tokens for r in {(r.doc_id, r.doc_tokens): r for r in rows}.values()) + 1
    assert STAGES["packing"](spark, docs.limit(0), tables).count() == 0
