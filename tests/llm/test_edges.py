"""Nulls, empty and long texts, repeated rows, empty tables and clashing columns, for every operator and stage."""

import pytest

import corpus_pipeline
from article_warehouse.llm import queries
from article_warehouse.llm.decontaminate import contaminated, drop_contaminated
from article_warehouse.llm.exact import drop_exact_duplicates, exact_groups
from article_warehouse.llm.language import identify
from article_warehouse.llm.licenses import license_scan
from article_warehouse.llm.mixing import mix
from article_warehouse.llm.quality import keep_quality, quality_scores
from article_warehouse.llm.recurrent import language_model_scores
from article_warehouse.llm.secrets import secret_digest
from article_warehouse.llm.simhash import drop_near_duplicates, near_duplicates
from article_warehouse.llm.tokens import token_counts

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score string, size string, row_id string, kept string, `a.b` string"
MORE = ("x", "y", "z", "k", "q")
LONG = "lorem ipsum dolor sit amet " * 40_000
ROWS = [
    (1, "Some words that say something of a kind", "en", "a", 39, *MORE),
    (1, "Some words that say something of a kind", "en", "a", 39, *MORE),
    (2, "Some  words that say\nsomething of a kind", None, "b", None, *MORE),
    (3, None, "en", None, None, *MORE),
    (4, "", None, "a", 0, *MORE),
    (None, "an identifier is missing here, for once", "de", "a", 5, *MORE),
    (None, None, None, None, None, *MORE),
    (5, " \t\n", "en", "b", 3, *MORE),
    (6, LONG, "en", "b", len(LONG), *MORE),
    (7, "日本語 текст ñandú 123 👩‍👧", "xx", "ü", 20, *MORE),
]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(ROWS, SCHEMA)


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(1, 1), (1, 0), (2, None), (3, 0), (None, 1), (6, 7)], "doc_id long, quality int")


@pytest.fixture(scope="module")
def benchmark(spark):
    return spark.createDataFrame([(1, "words that say something of a kind"), (2, None), (None, "identifier is missing")], "item_id long, text string")


def each(labels, benchmark):
    return {
        "mix": mix,
        "quality": lambda d: quality_scores(d, labels),
        "tokens": lambda d: token_counts(d, queries.tokenizer_path()),
        "secrets": secret_digest,
        "exact": exact_groups,
        "simhash": near_duplicates,
        "licenses": license_scan,
        "language model": language_model_scores,
        "language": identify,
    }


@pytest.mark.parametrize("name", ["mix", "quality", "tokens", "secrets", "exact", "simhash", "licenses", "language model", "language"])
def test_one_row_per_document(odd, labels, benchmark, name):
    operator = each(labels, benchmark)[name]
    rows = operator(odd).collect()
    assert sorted(map(repr, (r.doc_id for r in rows))) == sorted(repr(r[0]) for r in ROWS)
    assert operator(odd.limit(0)).count() == 0
    assert "a.b" not in rows[0]


def test_defined_results(odd, labels, benchmark):
    exact = exact_groups(odd).collect()
    assert sorted((r.keep_id, r.group_size, r.kept) for r in exact if r.doc_id in (1, 2)) == [(1, 3, False), (1, 3, False), (1, 3, True)]
    assert sum(r.kept for r in exact) == len({r.text_sha256 for r in exact})
    assert {r.lang_pred for r in identify(odd).collect() if r.doc_id in (3, 4, 5)} == {"und"}
    simhash = {r.doc_id: r for r in near_duplicates(odd).collect()}
    assert simhash[3].fingerprint == simhash[5].fingerprint == "0" * 16 and simhash[5].component_id == 3
    sizes = {r.doc_id: (r.size, r.taken) for r in mix(odd).collect()}
    assert sizes[3] == sizes[4] == (0, 0) and sizes[6][0] == 200_000
    scores = {r.doc_id: r for r in language_model_scores(odd).collect()}
    assert scores[3].n_tokens == scores[4].n_tokens == 1 and scores[6].n_tokens == 200_001
    assert sorted((repr(r.doc_id), repr(r.item_id)) for r in contaminated(odd, benchmark).collect()) == [("1", "1"), ("1", "1"), ("2", "1"), ("None", "None")]
    assert contaminated(odd.limit(0), benchmark).count() == 0 and contaminated(odd, benchmark.limit(0)).count() == 0


def test_stages_keep_columns_and_drop_repeated_rows(odd, labels, benchmark):
    kept = drop_exact_duplicates(odd)
    assert kept.columns == odd.columns
    assert sorted(map(repr, (r.doc_id for r in kept.collect()))) == ["1", "3", "5", "6", "7", "None"]
    near = drop_near_duplicates(odd)
    assert near.columns == odd.columns
    # Texts without words are one component, and its smallest id is 3.
    assert sorted(map(repr, (r.doc_id for r in near.collect()))) == ["1", "3", "6", "7", "None"]
    clean = drop_contaminated(odd, benchmark)
    assert clean.columns == odd.columns and sorted(map(repr, (r.doc_id for r in clean.collect()))) == ["3", "4", "5", "6", "7", "None"]
    assert keep_quality(odd, labels).columns == odd.columns
    for stage in (drop_exact_duplicates, drop_near_duplicates, lambda d: keep_quality(d, labels), lambda d: drop_contaminated(d, benchmark)):
        assert stage(odd.limit(0)).collect() == []


def test_unlabelled_and_one_sided_labels(odd, labels):
    assert {r.score for r in quality_scores(odd, labels.limit(0)).collect()} != set()
    ones = labels.where("quality = 1")
    assert all(0 <= r.score <= 1 for r in quality_scores(odd, ones).collect())


@pytest.mark.parametrize("name", list(queries.oracle_sql()))
def test_query_equals_oracle(spark, duck, name):
    sql, found = queries.oracle_sql()[name], queries.queries()[name](spark, SF)
    columns = ", ".join(sorted(found.columns))
    expected = sorted(map(repr, duck.sql(f"select {columns} from ({sql})").fetchall()))
    assert sorted(repr(tuple(r)) for r in found.select(*sorted(found.columns)).collect()) == expected


def test_pipeline_stage_by_stage(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(spark, docs, SF)
        assert kept.columns == docs.columns
        before, after = docs.count(), kept.count()
        assert 0 < after <= before, name
        if name == "quality classifier":
            good = {r.doc_id for r in quality_scores(docs, spark.read.parquet(f"{SF}/labels.parquet")).where("predicted = 1").collect()}
        elif name == "exact dedup":
            good = {r.doc_id for r in exact_groups(docs).where("kept").collect()}
        elif name == "SimHash near-dedup":
            good = {r.component_id for r in near_duplicates(docs).collect()}
        else:
            bad = {r.doc_id for r in contaminated(docs, spark.read.parquet(f"{SF}/benchmark.parquet")).collect()}
            good = {r.doc_id for r in docs.collect()} - bad
        assert {r.doc_id for r in kept.collect()} == good, name
        docs = spark.createDataFrame(kept.collect(), docs.schema)
    mixed = corpus_pipeline.run(spark, SF)
    assert sorted(map(tuple, mixed.collect())) == sorted(map(tuple, mix(docs).collect()))


def test_stages_are_the_dealt_ones():
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "quality classifier", "exact dedup", "SimHash near-dedup", "benchmark decontamination", "mixing sources to target weights",
    ]
    assert corpus_pipeline.ORACLE_SQL is None
