"""The pipeline and the guard around it."""

from __future__ import annotations

import ast
import hashlib
import os
import random
import shutil
import subprocess
import sys
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

P = pytest.importorskip("public_tokenizers")
tokenizers = pytest.importorskip("tokenizers")

import corpus_pipeline  # noqa: E402
from touchline.llm import lines, neardup  # noqa: E402
from touchline.llm.queries import QUERIES  # noqa: E402

ROOT = Path(corpus_pipeline.__file__).resolve().parent
COLUMNS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def word(rng):
    return "".join(rng.choices(["the", "in", "er", "an", "ou"], k=rng.randint(2, 5)))


def good(rng, n=120):
    return "\n".join(" ".join(word(rng) for _ in range(12)) + "." for _ in range(n // 12))


def bad(rng):
    return " ".join(word(rng) + rng.choice(["###", "$$$"]) for _ in range(80))


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    rng = random.Random(1)
    texts = [good(rng) if i % 5 else bad(rng) for i in range(240)]
    shared = good(rng, 72)
    texts += [good(rng, 96), shared + "\n" + good(rng, 96), good(rng, 96) + "\n" + shared]
    copied = good(rng, 180)
    texts += [copied] * 6
    words = good(rng, 40).replace("\n", " ").split()
    texts += [" ".join(words), " ".join([*words, "more"]), None, "", " \n", "Hi."]
    path = tmp_path_factory.mktemp("tables")
    rows = [(i, t, None, "s0" if i % 3 else "s1", None if t is None else len(t)) for i, t in enumerate(texts)]
    spark.createDataFrame(rows, COLUMNS).repartition(3).write.parquet(f"{path}/documents.parquet")
    marks = [(i, int(i % 5 > 0), 0) for i in range(240)]
    spark.createDataFrame(marks, "doc_id bigint, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    return str(path)


def staged(spark, folder):
    """The rows after each stage, as the pipeline hands them on."""
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, folder)
        path = f"{folder}/{abs(hash((name, os.urandom(4))))}"
        out.write.parquet(path)
        docs = spark.read.parquet(path)
        yield name, docs


def test_stages_and_their_decisions(spark, folder):
    given = {r.doc_id: r for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    steps = dict(staged(spark, folder))
    assert [name for name, _ in corpus_pipeline.STAGES] == list(steps)
    columns = [c.split()[0] for c in COLUMNS.split(", ")]
    frames = list(steps.values())
    assert all(f.columns == columns for f in frames[:-1])
    quality, cleaned, unique, mixed, encoded = ([*f.collect()] for f in frames)

    kept = {r.doc_id for r in quality}
    assert sum(i % 5 == 0 for i in kept & set(range(240))) <= 3
    assert len(kept & {i for i in range(240) if i % 5}) >= 188
    assert set(range(240, 249)) <= kept

    # Line dedup: against the plain definition of repeated runs.
    from test_lines import brute

    gone = brute([(r.doc_id, r.text) for r in quality], lines.MIN_WORDS)
    wanted = {}
    for r in quality:
        text = r.text and "\n".join(x for n, x in enumerate(r.text.split("\n")) if n not in gone[r.doc_id])
        if not gone[r.doc_id] or text.split():
            wanted[r.doc_id] = text
    assert {r.doc_id: r.text for r in cleaned} == wanted
    assert all(r.text is None or r.n_chars == len(r.text) for r in cleaned)

    # Near-duplicates: one of each class of the plain comparison of all pairs.
    from test_neardup import brute as classes

    keepers = set(classes([(r.doc_id, r.text) for r in cleaned]).values())
    assert sorted(r.doc_id for r in unique) == sorted(keepers)
    assert neardup.SIMILARITY == 0.8

    # Mixing: rows are copies of what came in, and few are lost.
    texts = {r.doc_id: r.text for r in unique}
    assert all(r.text == texts[r.doc_id] for r in mixed)
    assert len({r.doc_id for r in mixed}) >= 0.9 * len(texts)

    # Encoding: the ids of the tokenizers library, row by row.
    t = tokenizers.Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    assert sorted((r.doc_id or -1) for r in encoded) == sorted((r.doc_id or -1) for r in mixed)
    for r in encoded:
        ids = t.encode(texts[r.doc_id] or "", add_special_tokens=False).ids
        assert np.frombuffer(r.ids, "<u4").tolist() == ids and r.n_tokens == len(ids)
        assert (r.lang, r.source) == (given[r.doc_id].lang, given[r.doc_id].source)


def test_run_is_all_stages(spark, folder):
    *_, (_, last) = staged(spark, folder)

    def digest(df):
        return sorted((r.doc_id, r.n_tokens, hashlib.md5(r.ids).hexdigest()) for r in df.collect())

    assert digest(corpus_pipeline.run(spark, folder)) == digest(last)


def test_stages_take_empty_tables_odd_rows_and_more_columns(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    odd = spark.createDataFrame(
        [(None, None, None, None, None), (None, "", "x", None, 0), (7, "text " * 9, None, "s", 45)] * 2, COLUMNS
    )
    more = ["score", "predicted", "content", "runs", "kept", "rate", "copies", "n_tokens", "copy", "class"]
    for frame in (docs.limit(0), docs.limit(40).union(odd)):
        for name, stage in corpus_pipeline.STAGES:
            wide = frame.selectExpr("*", *[f"'{c}' AS `{c}`" for c in more])
            out = stage(spark, wide, folder)
            assert out.columns == wide.columns or name == corpus_pipeline.STAGES[-1][0]
            rows = out.collect()
            assert len(rows) <= 2 * frame.count() + 2


INTERNAL = [
    "score", "predicted", "content", "runs", "kept", "rate", "copies", "n_tokens", "copy", "class", "kept_id",
    "kept_content", "n_removed_lines", "posterior", "mix_words", "mix_tokens", "mix_p", "mix_scores",
    "mix_raised", "mix_rate", "given", "label", "label_key", "marked", "run_lines", "doc text", "a.b", "c0",
]


@pytest.mark.parametrize("at", range(len(corpus_pipeline.STAGES) - 1))
def test_columns_of_any_name_come_through_untouched(spark, folder, at):
    """The values of each row stay with it, also where an operator uses such a name itself."""
    docs = spark.read.parquet(f"{folder}/documents.parquet").limit(60)
    wide = docs.select("*", *[F.concat(F.lit(f"{c} "), F.col("doc_id").cast("string")).alias(c) for c in INTERNAL])
    out = corpus_pipeline.STAGES[at][1](spark, wide, folder)
    assert out.columns == wide.columns
    rows = out.collect()
    assert len(rows) >= 20
    for r in rows:
        assert [r[c] for c in INTERNAL] == [f"{c} {r.doc_id}" for c in INTERNAL]


def test_only_the_entry_point_guards_imports():
    for file in [ROOT / "corpus_pipeline.py", *(ROOT / "touchline/llm").glob("*.py")]:
        for node in ast.walk(ast.parse(file.read_text())):
            assert not isinstance(node, ast.Try) or "mport" not in ast.unparse(node)
    for file in [*(ROOT / "touchline").rglob("*.py"), *(ROOT / "registry").glob("*.py")]:
        if "llm" not in file.parts:
            assert "touchline.llm" not in file.read_text() and "corpus_pipeline" not in file.read_text()


@pytest.mark.parametrize("removed", [["touchline/llm", "corpus_pipeline.py"], ["corpus_pipeline.py"], ["touchline/llm"]])
def test_the_rest_stands_without_these_parts(tmp_path, removed):
    target = tmp_path / "repo"
    skipped = shutil.ignore_patterns(".git", "__pycache__", "tests", *[Path(x).name for x in removed])
    shutil.copytree(ROOT, target, ignore=skipped)
    code = "import __spark_entry__ as e; print(sorted(set(e.queries())), len(e.oracle_sql()))"
    done = subprocess.run([sys.executable, "-c", code], cwd=target, capture_output=True, text=True, timeout=120,
                          env={**os.environ, "PYTHONPATH": ""})
    assert done.returncode == 0, done.stderr
    assert "mart_team_performance" in done.stdout and "op7" not in done.stdout


def test_every_operator_has_a_query():
    assert sorted(int(name[2:].split("_")[0]) for name in QUERIES) == list(range(1, 14))
