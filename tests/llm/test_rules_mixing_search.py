import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from strandline.llm import licenses, mixing, quality, topk
from tests.llm import corpus


def brute_metrics(text):
    text = text or ""
    words = text.encode().split()
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    often = {w for w in windows if windows.count(w) > 1} if len(windows) < 2000 else set(_often(windows))
    covered = {i + k for i, w in enumerate(windows) if w in often for k in range(3)}
    lines = [x for x in text.split("\n") if x.strip(" \t\r\x0b\f")]
    n = len(words)
    return (
        n, sum(len(w.decode()) for w in words), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)),
        len(covered), n < 50 or 100 * len(covered) > 50 * n,
    )


def _often(windows):
    seen, out = set(), set()
    for w in windows:
        (out if w in seen else seen).add(w)
    return out


def test_quality_metrics_against_brute_force(spark):
    made = corpus.rows()
    made += [(2000 + i, "a b c d " * 30 + "#x\n#x\n|y|" * i, None, "bad", None) + (None,) * corpus.EXTRA for i in range(6)]
    made.append((3000, " ".join(corpus.vocabulary()[:80]), None, "bad", None) + (None,) * corpus.EXTRA)
    found = quality.judge(corpus.frame(spark, made))
    assert found.columns[:-1] == [c.split()[0] for c in corpus.SCHEMA.split(", ")]
    got = {(r.doc_id, r.text, r.source, tuple(r.quality__)[:6]) for r in found.collect()}
    assert got == {(r[0], r[1], r[3], brute_metrics(r[1])) for r in made}
    kept = {r.doc_id for r in found.where("quality__.kept").collect()}
    # passes by itself, but its host is rejected
    assert not brute_metrics(made[-1][1])[5] and 3000 not in kept
    assert kept == {r[0] for r in made if r[3] != "bad" and not brute_metrics(r[1])[5]}


def test_hosts_with_few_documents_are_judged_mostly_by_all(spark):
    made = [("big", False)] * 900 + [("big", True)] * 100 + [("few", True)] * 2 + [(None, False)] * 5
    made += [(f"h{i}", i % 10 == 0) for i in range(300)]
    rows = spark.createDataFrame(made, "source string, failed boolean")
    found = {r.host: r for r in quality.host_verdicts(rows, "source", F.col("failed")).collect()}
    assert found["few"].rate == 1.0 and found["few"].shrunk_rate < 0.9
    assert abs(found["big"].shrunk_rate - 0.1) < 0.01 and not found["big"].rejected
    assert found[None].n_docs == 5 and len(found) == 303


def test_quality_of_an_empty_table(spark):
    assert quality.keep_good(corpus.frame(spark, [])).collect() == []
    assert quality.keep_good(corpus.frame(spark)).columns == corpus.frame(spark).columns


def test_license_scan(spark):
    mit = licenses.TEMPLATES["mit"]
    header = licenses.TEMPLATES["apache-2.0-header"]
    made = [
        (1, f"text before\n{mit.upper()}\ntext after"),
        (2, "\n".join(header[i : i + 60] for i in range(0, len(header), 60))),
        (3, f"{mit}\n{mit}\n  released under - the MIT (license)"),
        (4, "Released under the terms of another agreement"),
        (None, mit), (5, None), (6, ""), (7, "license " * 5000), (1, "nothing here"),
    ]
    rows = licenses.scan(corpus.small(spark, *made)).collect()
    found = {(r.doc_id, r.license): (r.n_blocks, r.n_places, r.dice) for r in rows}
    # of 2 the whole text, a window in it as long as its first line, and that line as a shorter block
    assert found.pop((2, "apache-2.0-header")) == (1, 1, 1.0)
    assert found.pop((2, "apache-2.0")) == (1, 1, 1.0)
    assert found == {(1, "mit"): (1, 1, 1.0), (3, "mit"): (3, 3, 1.0), (None, "mit"): (1, 1, 1.0)}


def commented(text, mark):
    words = text.split()
    return "\n".join(mark + " " + " ".join(words[i : i + 9]) for i in range(0, len(words), 9))


def test_notices_inside_longer_blocks(spark):
    t = licenses.TEMPLATES
    header = t["apache-2.0-header"] + " " + t["apache-2.0-warranty"]
    block = "MIT License. " + t["mit-header"] + " " + t["mit-condition"] + " " + t["mit-warranty"]
    made = [
        (1, "This project is released under the MIT License. Copyright 2020 Foo."),
        (2, f"# Copyright 2020 Foo\n#\n{commented(header, '#')}\n#\nimport os"),
        (3, block), (4, f"/*\n{commented(block, ' *')}\n */ int main"),
        (5, f"{t['isc']} {'and so on ' * 20} {t['isc']}"),
        (6, t["mit"].replace("Released", "Given out")),
    ]
    found = {}
    for r in licenses.scan(corpus.small(spark, *made)).collect():
        assert r.n_places >= 1
        if r.dice == 1.0:
            found.setdefault(r.doc_id, {})[r.license] = r.n_places
    parts = {"mit-header": 1, "mit-condition": 1, "mit-warranty": 1}
    assert found == {
        1: {"mit": 1}, 2: {"apache-2.0": 1, "apache-2.0-header": 1, "apache-2.0-warranty": 1}, 3: parts, 4: parts, 5: {"isc": 2},
    }


def brute_places(text, template):
    words, wanted = licenses.template_words(text), licenses.template_words(template)
    mine, places, best, last = set(zip(wanted, wanted[1:])), 0, 0.0, -2
    for i in range(len(words) - len(wanted) + 1):
        part = words[i : i + len(wanted)]
        grams = set(zip(part, part[1:]))
        dice = 2.0 * len(grams & mine) / (len(grams) + len(mine))
        if dice >= licenses.THRESHOLD:
            places, best, last = places + (i - last > 1), max(best, dice), i
    return places, best


def test_license_windows_against_brute_force(spark):
    draw = random.Random(5)
    filler = corpus.vocabulary()
    # repeated bigrams, and a template of two words
    templates = {**licenses.TEMPLATES, "again": "free as free as free as in beer", "two": "all wrongs", "it's\\": "an odd name"}
    made = []
    for i in range(120):
        words = draw.choices(filler, k=draw.randint(0, 60))
        for _ in range(draw.randint(0, 4)):
            notice = draw.choice(list(templates.values())).split()
            for _ in range(draw.randint(0, max(1, len(notice) // 6))):
                at = draw.randrange(len(notice))
                notice[at : at + draw.randint(0, 1)] = draw.choices(notice + filler[:20], k=draw.randint(0, 2))
                notice = notice or ["x"]
            at = draw.randint(0, len(words))
            words[at:at] = notice
        made.append((i, " ".join(words)))
    made.append((500, " ".join([licenses.TEMPLATES["mit-condition"]] * 40 + ["free as"] * 3000)))
    want = {}
    for doc, text in made:
        for name, template in templates.items():
            places, best = brute_places(text, template)
            if places:
                want[doc, name] = (places, best)
    found = licenses.scan(corpus.small(spark, *made), templates=templates).where("n_places > 0").collect()
    assert {k: v[0] for k, v in want.items()} == {(r.doc_id, r.license): r.n_places for r in found}
    assert all(r.dice >= want[r.doc_id, r.license][1] for r in found)
    assert len({name for _, name in want}) == len(templates)
    with pytest.raises(ValueError):
        licenses.scan(corpus.small(spark, *made), templates={"none": "one"})


def test_size_bounds_lose_no_match():
    for size in range(1, 60):
        low, high = licenses.size_bounds(size, 0.8)
        for other in range(1, 200):
            if 2 * min(size, other) / (size + other) >= 0.8:
                assert low <= other <= high


def test_license_scan_of_an_empty_table(spark):
    assert licenses.scan(corpus.frame(spark, [])).collect() == []


def brute_search(made, k, asks):
    usable = []
    for row, (vec_id, v) in enumerate(made):
        if vec_id is not None and v is not None and all(x is not None and math.isfinite(x) for x in v):
            usable.append((row, vec_id, [math.floor(64 * float(np.float32(x))) for x in v]))
    out = []
    for row, vec_id, q in usable:
        if asks(vec_id):
            scores = sorted((-sum(a * b for a, b in zip(q, v)), i) for r, i, v in usable if r != row)
            out += [(vec_id, rank, i, -s) for rank, (s, i) in enumerate(scores[:k], 1)]
    return sorted(out)


@pytest.mark.parametrize("scale", [1.0, 1e-3, 1e6])
def test_search_against_brute_force(spark, monkeypatch, scale):
    monkeypatch.setattr(topk, "SHARD", 64)
    monkeypatch.setattr(topk, "BLOCK", 9)
    draw = random.Random(2)
    centers = [[draw.gauss(0, scale) for _ in range(16)] for _ in range(5)]
    made = [(i, [c + draw.gauss(0, 0.3 * scale) for c in draw.choice(centers)]) for i in range(400)]
    made += [(40, made[40][1]), (41, made[40][1]), (None, made[3][1]), (60, None), (80, []), (100, [1.0, None]),
             (120, [float("nan")] * 16), (140, [float("inf")] * 16), (160, made[7][1][:5]), (161, [0.0] * 16)]
    table = spark.createDataFrame([(*r, "x", 1) for r in made], "vec_id long, embedding array<float>, keys string, n int")
    found = sorted(tuple(r) for r in topk.search(table.repartition(3), "vec_id % 20 = 0", 20).collect())
    assert found == brute_search(made, 20, lambda i: i % 20 == 0)


def test_search_with_fewer_rows_than_asked_for(spark):
    table = spark.createDataFrame([(0, [1.0, 2.0]), (1, [1.0, 0.0])], "vec_id long, embedding array<float>")
    assert [tuple(r) for r in topk.search(table, "vec_id = 0", 20).collect()] == [(0, 1, 1, 4096)]
    assert topk.search(table.limit(0), "vec_id = 0").collect() == []


def labelled(seed=4, n=900):
    draw, words = random.Random(seed), corpus.vocabulary()[:300]
    marks = {"good": ["fine", "sound"], "plain": ["###", "||"], "toxic": ["vile", "foul"]}
    docs, labels = [], []
    for i in range(n):
        domain = draw.choices(list(marks), [8, 2, 1])[0]
        text = draw.choices(words, k=40)
        for _ in range(4):
            text[draw.randint(0, 39)] = draw.choice(marks[domain])
        docs.append((i, " ".join(text)))
        labels.append((i, domain))
    return docs, labels


def test_classifier_on_held_out_rows(spark):
    docs, labels = labelled()
    frame = corpus.small(spark, *docs)
    known = spark.createDataFrame(labels[:600], "doc_id long, domain string")
    model, domains = mixing.fit_domains(frame, known, F.col("domain"), "text", "doc_id")
    scored = mixing.posteriors(frame.where("doc_id >= 600"), model, domains, "text").collect()
    right = sum(domains[int(np.argmax(r.posterior__))] == labels[r.doc_id][1] for r in scored)
    assert right / len(scored) > 0.85


def test_rates_bring_the_totals_to_the_targets(spark):
    docs, labels = labelled()
    known = spark.createDataFrame(labels, "doc_id long, domain string")
    wanted = {"good": 0.9, "plain": 1.3, "toxic": 0.5}
    found = mixing.mix(corpus.small(spark, *docs), known, F.col("domain"), wanted).select("mix__.*").collect()
    for domain, multiple in wanted.items():
        present = sum(r.tokens * r.posteriors[domain] for r in found)
        mixed = sum(r.tokens * r.rate * r.posteriors[domain] for r in found)
        assert mixed == pytest.approx(multiple * present, rel=0.08)
    assert all(math.floor(r.rate) <= r.copies <= math.ceil(r.rate) and r.rate >= 0 for r in found)


@pytest.mark.parametrize("small, wanted", [(1, 0.25), (1, 0.2), (2, 3.0), (5, 0.0)])
def test_small_domains_reach_their_targets(spark, small, wanted):
    # of 1,000 documents of equal length, so 1 is 0.1% of the tokens
    toxic = [i < small for i in range(1000)]
    made = [(i, 100, [0.0, 0.0, 1.0] if x else [float(i % 5 > 0), float(i % 5 == 0), 0.0]) for i, x in enumerate(toxic)]
    scored = spark.createDataFrame(made, "doc_id long, tokens__ long, posterior__ array<double>")
    steps = mixing.fit_rates(scored, np.array([1.2, 0.75, wanted]), None)
    rate = mixing.rates_of(np.array([r[2] for r in made]), steps, None)[0]
    assert rate[toxic] == pytest.approx(wanted, abs=1e-3)
    assert rate[10::5] == pytest.approx(0.75, abs=1e-3) and rate[11::5] == pytest.approx(1.2, abs=1e-3)


def test_rounds_that_do_not_suffice_are_reported():
    draw = np.random.default_rng(3)
    posterior, tokens = draw.dirichlet([1, 1, 1], 200), np.full(200, 10.0)
    with pytest.warns(RuntimeWarning, match="not settled after 2 rounds"):
        mixing.descend(lambda s: mixing.sums_of(posterior, tokens, s, None), np.array([1.3, 1.0, 0.2]), 2)


def test_targets_beyond_the_highest_rate_do_not_hold_up_the_others():
    draw = np.random.default_rng(5)
    own = draw.choice(3, 2000, p=[0.75, 0.15, 0.1])
    leak = np.minimum(draw.exponential(0.05, 2000), 0.9)[:, None]
    posterior = np.eye(3)[own] * (1 - leak) + np.array([0.9, 0.1, 0.0]) * leak
    tokens = draw.integers(20, 400, 2000).astype(float)
    steps = mixing.descend(
        lambda s: mixing.sums_of(posterior, tokens, s, 1.0), mixing.reachable([1.2, 1.0, 0.2], 1.0)
    )
    found, present = mixing.rates_of(posterior, steps, 1.0)[0], tokens @ posterior

    def gaps(rate):
        return (tokens * rate) @ posterior / present - [1.0, 1.0, 0.2]

    rate = np.ones(2000)
    for _ in range(5000):  # plain projected gradient towards what a rate of 1 allows
        rate = np.clip(rate - posterior @ gaps(rate), 0, 1)
    assert (present * gaps(found) ** 2).sum() < (present * gaps(rate) ** 2).sum() + 1e-4 * present.sum()
    assert abs(gaps(found)[2]) < 0.005


def test_mixing_with_odd_rows(spark):
    docs, labels = labelled(n=120)
    made = [(i, t, "en", "s", 1) + (None,) * corpus.EXTRA for i, t in docs]
    made += [(None, docs[0][1], *made[0][2:]), (500, None, *made[0][2:]), (501, "", *made[0][2:]), made[3]]
    known = spark.createDataFrame([*labels, (None, "good"), (7, None), (99_999, "good")], "doc_id long, domain string")
    frame = corpus.frame(spark, made)
    out = mixing.mixed(frame, known, F.col("domain"), {"toxic": 0.0, "good": 1.2}, max_rate=1.0)
    assert out.columns == frame.columns
    kept = [r.doc_id for r in out.collect()]
    good = {i for i, d in labels if d == "good"}
    assert len(good - set(kept)) <= 0.05 * len(good)
    assert max(kept.count(i) for i in set(kept) if i not in (None, 3)) == 1


def test_mixing_without_labels_keeps_all(spark):
    known = spark.createDataFrame([], "doc_id long, domain string")
    frame = corpus.frame(spark)
    out = mixing.mix(frame, known, F.col("domain"), {"good": 3.0}).select("mix__.*").collect()
    assert {(r.rate, r.copies) for r in out} == {(1.0, 1)}
    assert mixing.mix(corpus.frame(spark, []), known, F.col("domain"), {}).collect() == []


@pytest.mark.parametrize("size", [1e4, 2e7, 2e14, 1e12, 1e15, 3e38, 1e308])
def test_search_with_large_components(spark, monkeypatch, size):
    """On both sides of what doubles and longs hold exactly; beyond a long the nearest long counts."""
    monkeypatch.setattr(topk, "SHARD", 32)
    draw = np.random.default_rng(4)
    made = [(i, draw.normal(size=4).tolist()) for i in range(60)]
    made += [(100 + i, (draw.uniform(-1, 1, size=4) * size).tolist()) for i in range(50)]
    made += [(200, [size, 2.0]), (201, [-size]), (220, [size, size, -size, 1.0]), (221, [0.0] * 4), (222, [])]
    largest = float(np.finfo(np.float64).max)
    whole = []
    for i, v in made:
        with np.errstate(over="ignore"):
            whole.append((i, [int(x) for x in np.clip(np.floor(64 * np.array(v, float)), -largest, largest)]))
    want = []
    for place, (i, v) in enumerate(whole):
        if i % 20 == 0:
            scored = [(sum(a * b for a, b in zip(v, w)), j) for p, (j, w) in enumerate(whole) if p != place]
            ranked = sorted((-max(-(2**63), min(2**63 - 1, s)), j) for s, j in scored)[:5]
            want += [(i, rank, j, -s) for rank, (s, j) in enumerate(ranked, 1)]
    table = spark.createDataFrame(made, "vec_id long, embedding array<double>").repartition(3)
    assert sorted(tuple(r) for r in topk.search(table, "vec_id % 20 = 0", 5).collect()) == sorted(want)


def test_finite_components_are_never_left_out(spark):
    table = spark.createDataFrame([(0, [1.0, 1.0]), (1, [2e14, 2.0]), (2, [1e12, 1e12])], "vec_id long, embedding array<double>")
    found = [tuple(r) for r in topk.search(table, "vec_id = 0", 5).collect()]
    assert found == [(0, 1, 1, 64 * (64 * 200_000_000_000_002)), (0, 2, 2, 64 * 64 * 2_000_000_000_000)]
