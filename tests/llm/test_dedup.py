import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from strandline.llm import line_dedup, minhash, repeats, substring_dedup, suffix_dedup
from strandline.llm.components import components
from tests.llm import corpus


def marked(sequences, window):
    """Brute force: what the windows cover that start at two places or more."""
    met = Counter(tuple(s[i : i + window]) for s in sequences for i in range(len(s) - window + 1))
    out = []
    for s in sequences:
        mask = [False] * len(s)
        for i in range(len(s) - window + 1):
            if met[tuple(s[i : i + window])] > 1:
                mask[i : i + window] = [True] * window
        out.append(mask)
    return out


@pytest.mark.parametrize("most", [2048, 2])
def test_word_sequences_against_brute_force(spark, monkeypatch, most):
    monkeypatch.setattr(repeats, "MOST_PHRASES", most)
    made = corpus.rows()
    words = [(r[1] or "").encode().split() for r in made]
    wanted = [
        (r[0], len(w), sum(m), b" ".join(x for x, gone in zip(w, m) if not gone).decode())
        for r, w, m in zip(made, words, marked(words, 35))
    ]
    found = [tuple(r) for r in substring_dedup.remove_repeats(corpus.frame(spark, made)).collect()]
    assert sorted(found, key=repr) == sorted(wanted, key=repr)
    assert sum(w[2] for w in wanted) > 1000


@pytest.mark.parametrize("most", [2048, 2])
def test_byte_strings_against_brute_force(spark, monkeypatch, most):
    monkeypatch.setattr(repeats, "MOST_PHRASES", most)
    made = [r for r in corpus.rows() if len(r[1] or "") < 20_000]
    raw = [(r[1] or "").encode() for r in made]
    wanted = []
    for r, b, m in zip(made, raw, marked(raw, 400)):
        spans = sum(gone and not before for gone, before in zip(m, [False, *m]))
        wanted.append((r[0], len(b), sum(m), spans, bytes(x for x, gone in zip(b, m) if not gone)))
    found = [tuple(r) for r in suffix_dedup.remove_repeats(corpus.frame(spark, made)).collect()]
    assert sorted(((*f[:4], bytes(f[4])) for f in found), key=repr) == sorted(wanted, key=repr)
    assert sum(w[2] for w in wanted) > 10_000


def test_repeats_of_an_empty_table(spark):
    assert substring_dedup.remove_repeats(corpus.frame(spark, [])).collect() == []
    assert suffix_dedup.remove_repeats(corpus.frame(spark, [])).collect() == []


@given(st.lists(st.text("abc", max_size=30), min_size=1, max_size=5))
@settings(max_examples=80, deadline=None)
def test_the_automaton_gives_the_longest_shared_suffixes(strings):
    automaton = substring_dedup.SuffixAutomaton()
    for s in strings:
        automaton.add(list(s))
    automaton.finish()
    for s in strings:
        for end, size in enumerate(automaton.shared(list(s)), 1):
            longest = 0
            for n in range(1, end + 1):
                part = s[end - n : end]
                places = sum(t[i : i + n] == part for t in strings for i in range(len(t) - n + 1))
                longest = n if places > 1 else longest
            assert size == longest


@given(st.lists(st.text("ab", min_size=1, max_size=60), min_size=1, max_size=4))
@settings(max_examples=60, deadline=None)
def test_suffixes_are_sorted_to_the_depth(strings):
    data = np.frombuffer("".join(strings).encode(), np.uint8)
    sizes = np.array([len(s) for s in strings])
    left = np.repeat(np.cumsum(sizes), sizes) - np.arange(len(data))
    starts, ranks = suffix_dedup.sorted_suffixes(data, left, 11)
    raw = data.tobytes()
    cut = {i: raw[i : i + 11] for i in range(len(raw)) if left[i] >= 11}
    met = Counter(cut.values())
    assert sorted(starts.tolist()) == [i for i, c in cut.items() if met[c] > 1]
    order = sorted(zip(ranks.tolist(), starts.tolist()))
    assert [cut[i] for _, i in order] == sorted(cut[i] for _, i in order)


def brute_lines(made):
    """Per row the numbers of the lines that are within one unit of an earlier line."""
    rows = sorted({(r[0], r[1]) for r in made if r[1] is not None}, key=lambda r: (r[0] is None, r[0] or 0))
    places = [
        ((r[0] is None, r[0] or 0, i), tuple(line.encode().split()))
        for r in rows for i, line in enumerate(r[1].split("\n")) if line.strip(" \t\r\x0b\f")
    ]
    first = {}
    for place, words in sorted(places):
        first.setdefault(words, place)
    near = set()
    by_size = defaultdict(list)
    for words in first:
        if len(words) >= line_dedup.MIN_WORDS:
            by_size["words", len(words)].append((words, list(words)))
        elif len(text := b" ".join(words).decode()) >= line_dedup.MIN_CHARS:
            by_size["chars", len(text)].append((words, text))
    for (units, n), group in by_size.items():
        for a, own in group:
            for b, other in [*group, *by_size.get((units, n + 1), [])]:
                if a != b and line_dedup.within_one(own, other):
                    near.add(a if first[a] > first[b] else b)
    gone = defaultdict(set)
    for place, words in places:
        if words in near or first[words] != place:
            gone[place[:2]].add(place[2])
    return gone


def test_lines_against_brute_force(spark):
    # rows without an id would be ordered by a hash, so there is one of them
    made = [r for r in corpus.rows() if r[0] is not None or r[1] is None]
    gone = brute_lines(made)
    assert sum(map(len, gone.values())) > 80
    found = line_dedup.dedup_lines(corpus.frame(spark, made))
    assert found.columns == [*[c.split()[0] for c in corpus.SCHEMA.split(", ")], "n_lines", "n_removed"]
    wanted = []
    for r in made:
        lines = r[1].split("\n") if r[1] is not None else []
        drop = gone[r[0] is None, r[0] or 0]
        text = None if r[1] is None else "\n".join(x for i, x in enumerate(lines) if i not in drop)
        wanted.append((r[0], text, len(lines), len(drop) if lines else 0))
    got = [tuple(r) for r in found.select("doc_id", "text", "n_lines", "n_removed").collect()]
    assert sorted(got, key=repr) == sorted(wanted, key=repr)


def test_short_lines_are_compared_by_characters(spark):
    made = [
        (1, "Share this page with your friends (12)\nHome é page nr 1\nfew words"),
        (2, "Share this page with your friends (13)\n  Home \té page nr 2 \nfew wordz"),
        (3, "Share this page with your friend (12)\nHome e page nr 12\nHome é page nr 12"),
        (4, "Share this page with your friends (12) now again\nShare thispage with your friends (12)\nHomé é page nr 3"),
        (5, "Home page é nr 1\nHome é page nr\n\n Share this page with your fri ends (12)"),
    ]
    found = {r.doc_id: r.text for r in line_dedup.dedup_lines(corpus.small(spark, *made)).collect()}
    gone = brute_lines(made)
    for i, text in made:
        assert found[i] == "\n".join(x for n, x in enumerate(text.split("\n")) if n not in gone[False, i])
    assert found[2] == "few wordz" and found[1] == made[0][1]
    assert found[4].startswith("Share this page with your friends (12) now again")
    assert "thispage" not in found[4]
    assert found[5] == made[4][1]  # two characters more, or eight words


def test_many_short_lines_against_brute_force(spark):
    draw = random.Random(6)
    base = ["page é of the list", "日本語のテキスト行です。", "aaaaaaaaaaaaaaaa", "one two three four"]
    made = []
    for i in range(60):
        lines = []
        for _ in range(6):
            line = list(draw.choice(base))
            for _ in range(draw.randint(0, 2)):
                at = draw.randint(0, len(line) - 1)
                line[at : at + draw.randint(0, 1)] = draw.choice(["", "x", "é", " ", "ab"])
            lines.append("".join(line))
        made.append((i, "\n".join(lines)))
    found = {r.doc_id: r.text for r in line_dedup.dedup_lines(corpus.small(spark, *made)).collect()}
    gone = brute_lines(made)
    for i, text in made:
        assert found[i] == "\n".join(x for n, x in enumerate(text.split("\n")) if n not in gone[False, i])
    assert 100 < sum(map(len, gone.values())) < 360


def test_lines_of_a_row_without_an_id_come_last(spark):
    line = "a b c d e f g h i"
    found = line_dedup.dedup_lines(corpus.small(spark, (None, line), (9, line + " j"))).collect()
    assert {r.doc_id: r.text for r in found} == {None: "", 9: line + " j"}


def test_lines_of_an_empty_table(spark):
    assert line_dedup.dedup_lines(corpus.frame(spark, [])).collect() == []


@given(st.lists(st.sampled_from("abc"), max_size=7), st.lists(st.sampled_from("abc"), max_size=7))
def test_the_verified_distance(a, b):
    table = np.zeros((len(a) + 1, len(b) + 1), int)
    table[:, 0], table[0] = range(len(a) + 1), range(len(b) + 1)
    for i, x in enumerate(a, 1):
        for j, y in enumerate(b, 1):
            table[i, j] = min(table[i - 1, j] + 1, table[i, j - 1] + 1, table[i - 1, j - 1] + (x != y))
    assert line_dedup.within_one(a, b) == (table[-1, -1] <= 1)


LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")


def shingles(text):
    words = (text or "").encode().translate(LOWER).split()
    if len(words) < 5:
        return frozenset([tuple(words)] if words else [])
    return frozenset(tuple(words[i : i + 5]) for i in range(len(words) - 4))


def brute_components(made):
    root = {r[0]: r[0] for r in made if r[0] is not None}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    sets = [(r[0], shingles(r[1])) for r in made if r[0] is not None]
    for i, (a, x) in enumerate(sets):
        for b, y in sets[:i]:
            both = len(x & y)
            if both and 100 * both >= 75 * (len(x) + len(y) - both):
                low, high = sorted((find(a), find(b)))
                root[high] = low
    return {k: find(k) for k in root}


@pytest.mark.parametrize("crowded", [64, 4])
def test_near_duplicates_against_brute_force(spark, monkeypatch, crowded):
    monkeypatch.setattr(minhash, "CROWDED", crowded)
    made = corpus.rows()
    of = brute_components(made)
    wanted = [(r[0], len(shingles(r[1])), of.get(r[0]), r[0] is None or of[r[0]] == r[0]) for r in made]
    found = [tuple(r) for r in minhash.near_duplicates(corpus.frame(spark, made)).collect()]
    assert sorted(found, key=repr) == sorted(wanted, key=repr)
    assert len(set(of.values())) < len(of) - 25


def test_copies_of_one_text_linked_only_through_it(spark):
    draw, words = random.Random(5), corpus.vocabulary()
    base = draw.choices(words, k=400)
    made = [(900, " ".join(base))]
    for i in range(150):
        changed = list(base)
        for at in range(i % 5, 400, 27):
            changed[at] = draw.choice(words)
        made.append((i, " ".join(changed)))
    of = brute_components(made)
    found = minhash.near_duplicates(corpus.small(spark, *made)).collect()
    assert {r.doc_id: r.component_id for r in found} == of


def test_near_duplicates_that_stay(spark):
    made = corpus.rows()
    kept = minhash.drop_near_duplicates(corpus.frame(spark, made))
    of = brute_components(made)
    wanted = [r[:2] for r in made if r[0] is None or of[r[0]] == r[0]]
    found = [tuple(r) for r in kept.select("doc_id", "text").collect()]
    assert kept.columns == [c.split()[0] for c in corpus.SCHEMA.split(", ")]
    assert sorted(found, key=repr) == sorted(wanted, key=repr)


def test_near_duplicates_of_an_empty_table(spark):
    assert minhash.near_duplicates(corpus.frame(spark, [])).collect() == []


def test_components_of_chains_and_stars(spark):
    draw = random.Random(3)
    chain = [(i, i + 1) for i in range(100, 160)]
    star = [(7, 1000 + i) for i in range(50)]
    links = [*chain, *star, (5, 5), (3, 2), (2, 3)]
    draw.shuffle(links)
    found = {r.node: r.root for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert found == {**{i: 100 for i in range(100, 161)}, 7: 7, **{1000 + i: 7 for i in range(50)}, 2: 2, 3: 2}


def test_components_of_no_links(spark):
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []
