"""Each stage of the pipeline on what its predecessor kept."""

import random

import numpy as np
import pytest

import corpus_pipeline
from strandline.llm import line_dedup
from strandline.session import keep
from tests.llm import corpus
from tests.llm.test_dedup import brute_components, brute_lines
from tests.llm.test_rules_mixing_search import brute_metrics, labelled
from tests.llm.test_tokens_binary_packing import brute, check_pieces

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """Labelled texts of three domains, and the odd corpus beside them."""
    base = tmp_path_factory.mktemp("corpus")
    draw, words = random.Random(9), corpus.vocabulary()
    docs, labels = labelled(n=500)
    made = [(5000 + i, t + " " + corpus.sentence(draw, words, 30), "en", f"s{i % 5}", len(t)) for i, t in docs]
    made += [r[:5] for r in corpus.rows() if r[0] is not None]
    made += [(8000 + i, "bad words " * 40, "en", "junk", 400) for i in range(20)]
    made.append((8100, corpus.sentence(draw, words, 90), "en", "junk", None))
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame(made, schema).write.parquet(f"{base}/documents.parquet")
    numbers = {"good": (1, 0), "plain": (0, 0), "toxic": (1, 1)}
    rows = [(5000 + i, *numbers[d]) for i, d in labels]
    spark.createDataFrame(rows, "doc_id long, quality int, toxic int").write.parquet(f"{base}/labels.parquet")
    return str(base)


@pytest.fixture(scope="module")
def outputs(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    out = [docs]
    for _, stage in corpus_pipeline.STAGES:
        out.append(keep(stage(spark, out[-1], folder)))
    return out


def as_rows(df):
    return [tuple(r) for r in df.select(*COLUMNS).collect()]


def test_the_stages_and_their_columns(outputs):
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "quality rules", "line dedup", "near dedup", "mixing", "packing",
    ]
    assert all(df.columns == COLUMNS for df in outputs[:-1])


def test_quality_rules(outputs):
    given = as_rows(outputs[0])
    wanted = [r for r in given if r[3] != "junk" and not brute_metrics(r[1])[5]]
    assert sorted(as_rows(outputs[1]), key=repr) == sorted(wanted, key=repr)


def test_line_dedup(outputs):
    given = as_rows(outputs[1])
    gone = brute_lines(given)
    wanted = []
    for doc_id, text, lang, source, _ in given:
        drop = gone[False, doc_id]
        left = "\n".join(x for i, x in enumerate(text.split("\n")) if i not in drop)
        if not drop or left.split():
            wanted.append((doc_id, left, lang, source, len(left)))
    assert sorted(as_rows(outputs[2]), key=repr) == sorted(wanted, key=repr)
    assert (line_dedup.MIN_WORDS, line_dedup.MIN_CHARS) == (8, 12)


def test_near_dedup(outputs):
    given = as_rows(outputs[2])
    of = brute_components(given)
    assert sorted(as_rows(outputs[3])) == sorted(r for r in given if of[r[0]] == r[0])


def test_mixing_keeps_the_clean_and_drops_the_toxic(outputs):
    given, kept = as_rows(outputs[3]), {r[0] for r in as_rows(outputs[4])}
    assert kept <= {r[0] for r in given}
    _, labels = labelled(n=500)
    present = {r[0] for r in given}
    share = {
        d: np.mean([5000 + i in kept for i, own in labels if own == d and 5000 + i in present])
        for d in ("good", "plain", "toxic")
    }
    assert share["good"] > 0.98 and share["toxic"] < 0.6


def test_packing(outputs):
    check_pieces(outputs[5].collect(), as_rows(outputs[4]), 4096)
    assert outputs[5].agg({"length": "sum"}).first()[0] == sum(len(brute(r[1])) + 1 for r in as_rows(outputs[4]))


def test_the_whole_run_gives_the_stages_rows(spark, folder, outputs):
    got = corpus_pipeline.run(spark, folder)
    assert got.agg({"length": "sum"}).first()[0] == outputs[5].agg({"length": "sum"}).first()[0]


def test_every_stage_on_an_empty_table(spark, folder, outputs):
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, outputs[0].limit(0), folder).collect() == []
