"""Filter audit, hard negatives and chunked BPE, each against a plain version."""

import hashlib
import itertools
import math
import random

import numpy as np
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from strandline.llm import audit, chunk_codec, negatives, vectors
from strandline.llm.tokens import default_tokenizer
from tests.llm.corpus import SCHEMA, frame, rows as corpus_rows, small, vocabulary

# --- filter audit ---

MARKS = {"good_lost": "quality = 1", "toxic_lost": "toxic = 1"}
LABELS = "doc_id long, quality int, toxic int, part string, mask long, digest binary"


def letters_failed(text, repeated):
    raw = text.encode()
    words = raw.split()
    out = "A" if len(words) < 50 else ""
    out += "B" if 100 * len(set(words)) < 65 * len(words) else ""
    out += "C" if 100 * sum("A" <= c <= "Z" for c in text) > 5 * len(text) else ""
    out += "D" if set(text) & set("#$%&*|") else ""
    return out + ("E" if repeated else "")


def brute_audit(docs, labels):
    """docs: (doc_id, text, part); labels: (doc_id, quality, toxic)."""
    facts = []
    for i, text, part in docs:
        same = [j for j, t, _ in docs if (t or "") == (text or "") and j is not None]
        repeated = i is not None and min(same) < i
        marks = [any(r[0] == i and r[k] == 1 for r in labels) if i is not None else False for k in (1, 2)]
        facts.append((part or "", letters_failed(text or "", repeated), *marks))
    out = []
    for part in {f[0] for f in facts}:
        own = [f for f in facts if f[0] == part]
        removals = dict.fromkeys("ABCDE", 0)
        made = []
        for order in itertools.permutations("ABCDE"):
            for step, letter in enumerate(order, 1):
                before = set(order[: step - 1])
                here = [f for f in own if letter in f[1] and not before & set(f[1])]
                kept = [f for f in own if not (before | {letter}) & set(f[1])]
                fails = [f for f in own if letter in f[1]]
                removals[letter] += len(here)
                made.append((
                    letter, part, "".join(order), step, len(kept), len(here), len(fails) - len(here),
                    sum(f[1] == letter for f in own), sum(f[2] for f in here), sum(f[3] for f in here),
                ))
        out += [(*m[1:], removals[m[0]]) for m in made]
    return sorted(out)


def audited(df, labels, **options):
    out = audit.interactions(df, labels, MARKS, **options)
    names = ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", *MARKS, "shapley"]
    assert out.columns == names
    return sorted(tuple(r) for r in out.collect())


def labels_frame(spark, rows):
    return spark.createDataFrame([(*r, "x", 1, None) for r in rows], LABELS)


def test_audit_equals_all_orders_applied_one_by_one(spark):
    made = corpus_rows()
    draw = random.Random(3)
    loud = " ".join(w.upper() + "#" * (i % 7 == 0) for i, w in enumerate(vocabulary()[:80]))
    made += [(2000 + i, loud if i % 2 else "few #", "en", "s9", 1, *made[0][5:]) for i in range(6)]
    made += [made[20], made[20]]
    labels = [(r[0], draw.choice([0, 1, None]), draw.choice([0, 1])) for r in made if r[0] is not None and r[0] % 3]
    labels += [(made[0][0], 0, 0), (made[0][0], 1, 1), (None, 1, 1), (-5, 1, 1)]
    want = brute_audit([(r[0], r[1], r[3]) for r in made], labels)
    assert audited(frame(spark, made), labels_frame(spark, labels)) == want
    assert {r[0] for r in want} >= {"", "s9"}


def test_audit_of_small_tables(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert audited(empty, labels_frame(spark, [])) == []
    docs = [(1, None, None), (2, "", ""), (2, "", None), (None, "", "s"), (None, None, "s")]
    df = spark.createDataFrame(docs, "doc_id long, text string, source string")
    got = audited(df, labels_frame(spark, []))
    assert got == brute_audit(docs, []) and len(got) == 1200
    plain = audit.interactions(df, filters={"x": audit.few_words}, repeat="y")
    assert plain.count() == 2 * 2 * 2 and plain.columns[-2:] == ["unique_fails", "shapley"]


def test_adjacent_swaps_visit_every_order():
    for n in range(1, 7):
        order = list(range(n))
        seen = {tuple(order)}
        for at in audit.adjacent_swaps(n):
            order[at], order[at + 1] = order[at + 1], order[at]
            seen.add(tuple(order))
        assert len(seen) == math.factorial(n)


def test_a_swapped_diagram_equals_the_one_built_in_that_order():
    draw = random.Random(5)
    counts = {m: (draw.randint(0, 2), draw.randint(0, 1)) for m in range(16)}
    diagram = audit.Diagram(range(4), counts, (0, 0))
    for at in audit.adjacent_swaps(4):
        diagram.swap(at)
        fresh = audit.Diagram(diagram.order, counts, (0, 0))
        assert diagram.steps() == fresh.steps()
        assert [len(x) for x in diagram.levels] == [len(x) for x in fresh.levels]


# --- hard negatives ---

VECTORS = "vec_id long, embedding array<double>, label int, n int, keys binary, score long, slot int, own string"
LARGEST = float(np.finfo(np.float64).max)


def brute_negatives(rows, k=3, positives=5, divisor=5):
    """Every pair in unbounded integers."""
    usable = []
    for place, (i, v, label, *_) in enumerate(rows):
        if i is None or v is None or label is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        with np.errstate(over="ignore"):
            q = np.clip(np.floor(256.0 * np.array(v, float)), -LARGEST, LARGEST)
        usable.append((place, i, label, [int(x) for x in q]))
    clip = lambda s: max(-(2**63), min(2**63 - 1, s))
    out = []
    for place, i, label, v in usable:
        if i % divisor:
            continue
        scored = [(-clip(sum(a * b for a, b in zip(v, w))), j, other) for p, j, other, w in usable if p != place]
        for s, j, _ in sorted(x for x in scored if x[2] == label)[:positives]:
            inside = sorted(x for x in scored if x[2] != label and 50 * -s <= 100 * -x[0] <= 95 * -s)[:k]
            out += [(i, j, rank, x[1], -s, -x[0]) for rank, x in enumerate(inside, 1)]
    return sorted(out)


def mined(spark, rows, **options):
    df = spark.createDataFrame([(*r, 1, None, None, None, "x") for r in rows], VECTORS).repartition(3)
    out = negatives.mine(df, "vec_id % 5 = 0", **options)
    assert out.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    return sorted(tuple(r) for r in out.collect())


def ordinary(n=160, seed=2):
    draw = np.random.default_rng(seed)
    centre = draw.normal(size=(4, 6))
    rows = [(i, (centre[i % 4] * 0.6 + centre[0] + draw.normal(size=6) * 0.4).tolist(), i % 4) for i in range(n)]
    rows += [(500, rows[3][1], 3), (501, rows[3][1], 0), (501, rows[3][1], 0)]  # equal vectors, equal ids
    rows += [(505 + i, rows[8][1], i % 2) for i in range(40)]  # one vector many times
    return rows


ODD = [
    (600, None, 1), (605, [1.0, None], 1), (610, [math.nan], 1), (615, [math.inf, 1.0], 1), (None, [1.0], 1),
    (620, [0.5], None), (625, [], 2), (630, [0.7, 0.1], 2), (635, [0.0] * 9 + [3.0], 2), (640, [0.2] * 9, 1),
]


def test_negatives_equal_all_pairs(spark):
    rows = ordinary() + ODD
    got = mined(spark, rows)
    assert got == brute_negatives(rows) and len(got) > 200
    assert mined(spark, rows, k=1, positives=2) == brute_negatives(rows, 1, 2)


def test_negatives_in_blocks_and_pieces(spark, monkeypatch):
    monkeypatch.setattr(negatives, "BLOCK_BYTES", 8 * 10 * 7)
    rows = ordinary(60)
    assert mined(spark, rows) == brute_negatives(rows)


@pytest.mark.parametrize("size", [2e5, 3e7, 2e14, 1e12, 1e15, 3e38, 1e308])
def test_negatives_of_large_components(spark, size):
    """On both sides of what doubles and longs hold exactly; beyond a long the nearest long counts."""
    draw = np.random.default_rng(7)
    rows = ordinary(30)
    rows += [(700 + i, (draw.normal(size=3) * size).tolist(), i % 3) for i in range(25)]
    rows += [(750, [size, -size, 1.0], 0), (755, [size, size], 1), (760, [-size], 2)]
    assert mined(spark, rows) == brute_negatives(rows)


def test_negatives_without_rows_or_partners(spark):
    assert mined(spark, []) == [] and mined(spark, [(5, None, 1)]) == []
    assert mined(spark, [(5, [1.0], 1)]) == []
    assert mined(spark, [(5, [1.0], 1), (6, [1.0], 2)]) == []  # no positive
    assert mined(spark, [(5, [1.0], 1), (6, [1.0], 1)]) == []  # no negative
    assert mined(spark, [(5, [-1.0], 1), (6, [1.0], 1), (7, [0.7], 2)]) == []  # a positive below 0


def test_products_are_exact():
    draw = random.Random(1)
    for size in (10, 2**20, 2**26, 2**40, 2**61, 2**70):
        a = np.array([[float(draw.randint(-size, size)) for _ in range(5)] for _ in range(9)])
        a[0] = 3.0
        want = [[sum(int(x) * int(y) for x, y in zip(r, s)) for s in a] for r in a]
        assert vectors.products(a, a).tolist() == np.clip(np.array(want, object), -(2**63), 2**63 - 1).tolist()


def test_pieces_cover_all_vectors(monkeypatch):
    monkeypatch.setattr(vectors, "SHARD_BYTES", 80)
    made = [np.zeros(n) for n in (1, 2, 3, 30, 0, 0, 1, 9, 2)]
    runs = list(vectors.pieces(made))
    assert [x for lo, hi, _ in runs for x in range(lo, hi)] == list(range(9))
    assert all(w == max(1, *(len(v) for v in made[lo:hi])) for lo, hi, w in runs)
    assert list(vectors.pieces([])) == []


# --- chunked BPE ---


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(default_tokenizer())


def whole(library, text):
    ids = library.encode(text or "", add_special_tokens=False).ids
    return len(ids), ids, library.decode(ids, skip_special_tokens=False)


ODD_TEXTS = [
    "a<|endoftext|>b <|startoftext|> c", "<|endof text|>", "é ́e x́" * 30, "한 " * 40,
    "　 a b c d " * 20, "it's we'll I'd 'S 'Re x'" * 30, "🙂🙃🙂 日本語テキスト" * 90, "\x00 \x01\n\r\n",
    "ΣΑΣ ΣΑΣ" * 50, "İı ß ﬁ Ǆ" * 60, "́" * 50, "1234567890" * 200, " " * 5000, "\n" * 3000, "x" * 40_000,
]


def test_chunks_give_what_the_library_gives(spark, library):
    made = corpus_rows() + [(5000 + i, t, "en", "s", 1, *corpus_rows()[0][5:]) for i, t in enumerate(ODD_TEXTS)]
    got = chunk_codec.encode_documents(frame(spark, made), mean_bytes=64).collect()
    found = sorted((r.doc_id is None, r.doc_id or 0, r.n_tokens, bytes(r.ids), r.decoded) for r in got)
    want = []
    for r in made:
        n, ids, decoded = whole(library, r[1])
        want.append((r[0] is None, r[0] or 0, n, np.array(ids, "<u4").tobytes(), decoded))
    assert found == sorted(want)


def test_digests_and_long_texts(spark, library):
    """Texts longer than what is cut at once, and one without any break."""
    draw, words = random.Random(4), vocabulary()
    long = " ".join(draw.choices(words, k=130_000))
    made = [(1, long), (2, long + " end"), (3, "ab" * 30_000), (4, None), (5, ""), (5, "twice"), (5, "twice")]
    got = chunk_codec.encode_documents(small(spark, *made), digests=True).collect()
    want = []
    for i, text in made:
        n, ids, decoded = whole(library, text)
        want.append((i, n, *[hashlib.sha256(x.encode()).hexdigest() for x in (" ".join(map(str, ids)), decoded)]))
    assert sorted(map(tuple, got)) == sorted(want) and len(long.encode()) > 500_000


def test_codec_of_an_empty_table(spark):
    out = chunk_codec.encode_documents(spark.createDataFrame([], SCHEMA))
    assert out.count() == 0 and out.columns == ["doc_id", "n_tokens", "ids", "decoded"]


def test_a_shared_chunk_is_encoded_once(library, monkeypatch):
    """Documents share a passage at different places; only its ends are encoded again."""
    draw, words = random.Random(8), vocabulary()
    passage = " ".join(draw.choices(words, k=600))
    docs = [" ".join(draw.choices(words, k=7 * i)) + " " + passage for i in range(40)]
    codec = chunk_codec.Codec(default_tokenizer())
    cut = [c for _, chunks in chunk_codec.chunked(pa.array(docs), 256) for c in chunks]
    for half in (cut[: len(cut) // 2], cut[len(cut) // 2 :], cut):
        codec.chunks({chunk_codec.chunk_name(c): c for c in half})
    assert codec.encoded == len(set(cut)) < len(cut) / 2
    monkeypatch.setattr(chunk_codec, "KEPT_IDS", 50)  # all is forgotten again, and found anew
    small = chunk_codec.Codec(default_tokenizer())
    for chunk in cut * 2:
        (found,) = small.chunks({chunk_codec.chunk_name(chunk): chunk}).values()
        again = chunk_codec.encoded([chunk.decode()], codec)[0]
        assert (found.head, found.tail) == (again.head, again.tail)
        assert found.middle is again.middle or found.middle.tolist() == again.middle.tolist()
    assert small.held <= 50 and len(small.recent) + len(small.older) < 10


def test_cuts_depend_on_content_alone():
    draw = random.Random(2)
    passage = "".join(draw.choices("abcdefgh é", k=6000)).encode()
    for before in (b"", b"some text in front ", "é".encode() * 33):
        data = np.frombuffer(before + passage, np.uint8)
        edges = chunk_codec.cuts(data, np.array([0, len(data)]), 256)
        inner = edges[edges > len(before) + 20_00] - len(before)
        if not before:
            first = inner
        assert inner.tolist() == first.tolist() and len(inner) > 5
        assert all(data[e] & 0xC0 != 0x80 for e in edges[:-1])


def test_a_tokenizer_that_reads_across_breaks_is_refused(spark, tmp_path):
    from tokenizers import models

    joined = Tokenizer(models.BPE({"a": 0, " ": 1, "a ": 2}, [("a", " ")]))
    path = str(tmp_path / "joined.json")
    joined.save(path)
    with pytest.raises(Exception, match="depend on what stands behind"):
        chunk_codec.encode_documents(small(spark, (1, "a a a")), tokenizer=path)


def test_decoders_of_their_own_are_refused(spark, tmp_path):
    from tokenizers import decoders, models

    own = Tokenizer(models.BPE({"a": 0}, []))
    own.decoder = decoders.ByteLevel()
    path = str(tmp_path / "own.json")
    own.save(path)
    with pytest.raises(ValueError, match="rules of its own"):
        chunk_codec.encode_documents(small(spark, (1, "a")), tokenizer=path)
