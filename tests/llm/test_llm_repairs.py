"""Ties, repeated rows, marks behind letters, long texts and workers without the package."""

import collections
import itertools
import math
import re
import subprocess
import sys
import textwrap

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from article_warehouse.llm import decontaminate, language, licenses, quality, queries, recurrent
from article_warehouse.llm.language import counted, identify, letter_stream, merged, most_frequent, own_ranks, ranked
from article_warehouse.llm.licenses import license_scan
from article_warehouse.llm.mixing import MOST_COPIES, mix
from article_warehouse.llm.quality import Inputs, Model, fit_quality, inputs_of
from article_warehouse.llm.tokens import Lengths

SF = "/root/testdata/sf0.001"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


@pytest.mark.parametrize("ids", [lambda i: None if i >= 100 else i, lambda i: 7 if i >= 100 else i, lambda i: i])
@pytest.mark.parametrize("tasks", [1, 5])
def test_repeated_rows_meet_the_target_within_a_document(spark, ids, tasks):
    rows = [(ids(i), "one two three four " * 10, "a") for i in range(1000)] + [(5000 + i, "word " * (i % 50), "b") for i in range(900)]
    found = mix(spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(tasks)).collect()
    assert len(found) == len(rows)
    taken = collections.Counter()
    for row in found:
        taken[row.source_size, row.target] += row.taken
        assert row.taken == row.copies * row.size and 0 <= row.copies <= MOST_COPIES
    assert len(taken) == 2
    for (_, target), words in taken.items():
        assert abs(words - target) <= 50


def test_rates_are_tilted_and_rounded_to_neighbours(spark):
    rows = [(i, "w " * (1 + i % 40), "ab"[i % 2]) for i in range(4000)]
    found = mix(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()
    by_source = collections.defaultdict(lambda: collections.defaultdict(list))
    for row in found:
        by_source[row.target][row.size].append(row.copies)
    for sizes in by_source.values():
        means = [np.mean(sizes[size]) for size in sorted(sizes)]
        # All copies of one size are the floor of one rate, or one more, and rates rise or fall with the size.
        assert all(max(copies) - min(copies) <= 1 for copies in sizes.values())
        assert np.ptp(means) < 0.2 or abs(np.corrcoef(sorted(sizes), means)[0, 1]) > 0.3


def test_marks_behind_every_letter():
    from tokenizers import Tokenizer

    path = queries.tokenizer_path()
    tokenizer = Tokenizer.from_file(path)
    letters = [chr(c) for c in range(0x2FF0) if chr(c).isalpha()] + [chr(c) for c in range(0xA640, 0xABFF, 3) if chr(c).isalpha()]
    texts = [f"A{letter}{mark}" for letter, mark in zip(letters, itertools.cycle(".,;:!?"))]
    texts += ["ALİ,", "TAMAMİ,", "İ.", "İİ!?", "ali̇,"]
    lengths = Lengths(path, {})
    found = lengths.counts(texts)
    wanted = [len(tokenizer.encode(text, add_special_tokens=False)) for text in texts]
    assert [text for text, a, b in zip(texts, found, wanted, strict=True) if a != b] == []


def test_long_texts_are_counted_in_runs(spark, monkeypatch):
    words = ["Straße", "été", "日本", "abc", "x1y", "\t", "Ünï"]
    rng = np.random.default_rng(3)
    text = " ".join(rng.choice(words, 3000))
    stream = letter_stream(pa.array([text]))[0]
    whole = most_frequent(*merged([counted(stream)]))
    row = spark.createDataFrame([(1, text, "en"), (2, "short words", "de"), (3, text[:500], "de")], "doc_id long, text string, lang string")
    before = identify(row).collect()
    monkeypatch.setattr(language, "RUN_BYTES", 200)
    monkeypatch.setattr(language, "HELD_GRAMS", 10)
    assert len(language.runs(text)) > 20 and " ".join(language.runs(text)).split() == text.split()
    (own,) = own_ranks(pa.array([text]))
    assert own.tolist() == whole.tolist()
    assert identify(row).collect() == before
    grams = [keys[real] for keys, real in language.gram_keys(stream)]
    assert ranked(np.concatenate(grams)).tolist() == whole.tolist()


def test_counts_added_in_groups_are_those_of_all(spark, monkeypatch):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(60)
    before = sorted(map(tuple, recurrent.token_counts(docs).collect()))
    monkeypatch.setattr(recurrent, "TOGETHER", 2)
    monkeypatch.setattr(recurrent, "HELD_COUNTS", 50)
    assert sorted(map(tuple, recurrent.token_counts(docs).collect())) == before


def test_scores_equal_all_pairs():
    rng = np.random.default_rng(1)
    texts = ["one two two three", "", "four", "a b c d e f g"]
    inputs = inputs_of(pa.array(texts), np.array([17.0, 0.0, -1.0, 13.0]))
    size = quality.WORD_BUCKETS + quality.STATISTICS * (quality.BINS + 1)
    edges = np.sort(rng.normal(0, 1, (quality.STATISTICS, quality.BINS)), axis=1)
    model = Model(edges, 0.3, rng.normal(0, 1, size).astype(np.float32), rng.normal(0, 1, (size, quality.FACTORS)).astype(np.float32))
    bins, found, start = model.features(inputs), model.raw(inputs), 0
    for i, count in enumerate(inputs.counts.tolist()):
        x = [(int(b), 1 / count) for b in inputs.buckets[start : start + count]] + [(int(b), 1.0) for b in bins[i]]
        start += count
        value = model.bias + sum(model.weights[f] * w for f, w in x)
        value += sum(float(model.vectors[f] @ model.vectors[g]) * w * v for (f, w), (g, v) in itertools.combinations(x, 2))
        assert found[i] == pytest.approx(value, rel=1e-3, abs=1e-3)


def test_a_repeated_id_takes_one_row_of_the_fit(spark, monkeypatch):
    rows = [(1, f"same id {i % 3}", 5) for i in range(400)] + [(i, f"text of {i}", 9) for i in range(2, 40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_chars long")
    labels = spark.createDataFrame([(i, i % 2) for i in range(1, 40)], "doc_id long, quality int")
    seen = []
    real = quality.fitted
    monkeypatch.setattr(quality, "fitted", lambda inputs, wanted: seen.append(1) or real(inputs, wanted))
    first, again = fit_quality(docs, labels), fit_quality(docs.repartition(3), labels)
    assert first.bias == again.bias and np.array_equal(first.weights, again.weights)
    once = fit_quality(docs.groupBy("doc_id").agg(F.min_by("text", F.xxhash64("text")).alias("text"), F.first("n_chars").alias("n_chars")), labels)
    assert first.bias == once.bias and np.array_equal(first.weights, once.weights)
    assert isinstance(inputs_of(pa.array([""]), np.array([0.0])), Inputs)


def test_operators_run_on_workers_without_the_package(tmp_path):
    """The driver finds the package by a path of its own that its workers don't have."""
    script = tmp_path / "run.py"
    script.write_text(textwrap.dedent(f"""
        import sys
        from pyspark.sql import SparkSession, functions as F
        spark = (SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false")
            .config("spark.sql.shuffle.partitions", "2").config("spark.checkpoint.dir", "{tmp_path}/checkpoint")
            .config("spark.sql.warehouse.dir", "{tmp_path}/warehouse").getOrCreate())
        spark.range(1).rdd.count()
        sys.path.insert(0, "/root/repo")

        @F.udf("boolean")
        def present(_):
            import importlib.util
            return importlib.util.find_spec("article_warehouse") is not None

        assert not spark.range(1).select(present("id")).first()[0]
        from article_warehouse.llm import queries
        for name, query in queries.queries().items():
            assert query(spark, "{SF}").count() > 0, name
        print("all ran")
    """))
    environment = {k: v for k, v in __import__("os").environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, str(script)], cwd=tmp_path, env=environment, capture_output=True, text=True, timeout=600)
    assert "all ran" in done.stdout, done.stderr[-3000:]


def plain_labels(text, threshold=0.8):
    """Each template against every window of words of every paragraph."""
    lines = [re.findall(licenses.WORD, line.translate(LOWER)) for line in (text or "").split("\n")]
    paragraphs, words = [], []
    for line in [*lines, []]:
        words = words + line
        if not line:
            paragraphs, words = [*paragraphs, words], []
    best = {}
    for template, label in licenses.TEMPLATES.items():
        wanted, width = set(template.split()), math.ceil(len(template.split()) / threshold - 1e-9)
        shared = max((len(wanted & set(p[i : i + width])) for p in paragraphs for i in range(len(p))), default=0)
        if shared >= math.ceil(threshold * len(wanted) - 1e-9):
            best[label] = max(best.get(label, 0), shared / len(wanted))
    return best


def test_templates_against_every_window(spark):
    rng = np.random.default_rng(8)
    templates = list(licenses.TEMPLATES)
    vocabulary = sorted({word for text in templates for word in text.split()} | {"filler", "words", "of", "no", "kind"})
    texts = [None, "", "\n\n"]
    for _ in range(150):
        words = rng.choice(templates).split()
        for _ in range(rng.integers(0, 4)):
            words.insert(int(rng.integers(0, len(words) + 1)), str(rng.choice(vocabulary)))
        for _ in range(rng.integers(0, 4)):
            words.pop(int(rng.integers(0, len(words))))
        noise = [str(w) for w in rng.choice(vocabulary, int(rng.integers(0, 30)))]
        parts = [*noise[:10], *words, *noise[10:]]
        texts.append("".join(w + str(rng.choice([" ", ", ", "\n", " \n- ", "\n\n", "\n ..\n"], p=[0.6, 0.1, 0.1, 0.1, 0.05, 0.05])) for w in parts))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {row.doc_id: row for row in license_scan(docs, phrases={"zz": "zz"}).collect()}
    matched = 0
    for i, text in enumerate(texts):
        wanted = plain_labels(text)
        matched += bool(wanted)
        assert found[i].labels == ",".join(sorted(wanted)), text
        assert found[i].score == pytest.approx(max(wanted.values(), default=0)), text
    assert 30 < matched < 140


def test_scattered_words_are_no_license(spark):
    words = "no part of this publication may be reproduced without permission".split()
    scattered = " ".join(f"{word} " + "filler " * 300 for word in words)
    whole = "filler " * 3000 + " ".join(words) + " filler" * 3000
    rows = license_scan(spark.createDataFrame([(1, scattered), (2, whole)], "doc_id long, text string")).orderBy("doc_id").collect()
    assert [(row.labels, row.score) for row in rows] == [("", 0.0), ("no-reproduction", 1.0)]


def test_a_large_benchmark_is_joined(spark, monkeypatch):
    docs, benchmark = (spark.read.parquet(f"/root/testdata/sf0.01/{name}.parquet") for name in ("documents", "benchmark"))
    docs = docs.unionByName(docs.where("doc_id < 200"))
    before = sorted(map(tuple, decontaminate.contaminated(docs, benchmark).collect()))
    kept = sorted(repr(row) for row in decontaminate.drop_contaminated(docs, benchmark).collect())
    monkeypatch.setattr(decontaminate, "BLOCK_BYTES", 100)
    assert len(before) > 5 and sorted(map(tuple, decontaminate.contaminated(docs, benchmark).collect())) == before
    assert sorted(repr(row) for row in decontaminate.drop_contaminated(docs, benchmark).collect()) == kept
    # A filter that is full drops nothing, and the matches stay.
    monkeypatch.setattr(decontaminate, "FILTER_MOST", 1 << 15)
    assert sorted(map(tuple, decontaminate.contaminated(docs, benchmark).collect())) == before
    plan = decontaminate.contaminated(docs, benchmark)._jdf.queryExecution().executedPlan().toString()
    assert "ArrowEvalPython" not in plan
