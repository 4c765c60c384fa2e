import random
import zlib
from collections import defaultdict
from fractions import Fraction

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from strandline.llm import binary, packing, tokens
from strandline.llm.tokens import PieceEncoder, default_tokenizer
from tests.llm import corpus

ENCODER = PieceEncoder(default_tokenizer(), most=50)  # so small that it forgets all the time


def brute(text):
    return ENCODER.tokenizer.encode(text or "", add_special_tokens=False).ids


def crc(ids) -> int:
    return zlib.crc32(np.array(ids, "<u4").tobytes())


ODD = ["a<|endoftext|>b  c", "é x́", "Σας ΑΣ İ.", "x\x1c y\t\tq\r\n 's don't", "I'LL 've", "ﬁ ① ½", "ᄀ ᅡ\nᅡ"]


def test_pieces_give_the_ids_of_whole_texts():
    texts = [*corpus.texts(), *ODD]
    for _ in range(2):
        ids, counts = ENCODER.encode(texts)
        assert ids.tolist() == [i for t in texts for i in brute(t)]
        assert counts.tolist() == [len(brute(t)) for t in texts]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(), max_size=4))
def test_pieces_of_any_text(texts):
    ids, _ = ENCODER.encode(texts)
    assert ids.tolist() == [i for t in texts for i in brute(t)]


@given(st.lists(st.integers(0, (1 << 64) - 1), max_size=400), st.integers(0, 3))
@settings(max_examples=60, deadline=None)
def test_elias_fano_round_trip(values, repeats):
    values = sorted(values * (repeats + 1))
    sequence, _ = binary.EliasFano.read(memoryview(binary.EliasFano.of(np.array(values, np.uint64)).tobytes()), 0)
    assert sequence.select(np.arange(len(values))).tolist() == values


def test_elias_fano_is_small():
    bounds = np.cumsum(np.random.default_rng(1).integers(1, 2000, 50_000))
    assert len(binary.EliasFano.of(bounds).tobytes()) < 50_000 * 13 / 8 + 2000


def test_binary_round_trip(spark, tmp_path):
    made = corpus.rows()
    binary.write_shards(corpus.frame(spark, made), str(tmp_path / "shards"), shard_ids=2000)
    found = binary.read_shards(spark, str(tmp_path / "shards")).orderBy("start").collect()
    ordered = sorted(made, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, (r[1] or "").encode()))
    start = 0
    for got, (doc_id, text, *_) in zip(found, ordered, strict=True):
        ids = [*brute(text), 2]
        assert tuple(got) == (doc_id, start, len(ids), crc(ids))
        start += len(ids)


def test_binary_of_an_empty_table(spark, tmp_path):
    binary.write_shards(corpus.frame(spark, []), str(tmp_path / "none"))
    assert binary.read_shards(spark, str(tmp_path / "none")).collect() == []


def check_pieces(pieces, made, length):
    """Each id in one piece, sequences gapless and full but for the last."""
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    wanted = defaultdict(int)
    for doc_id, text, *_ in made:
        wanted[doc_id, tuple(brute(text)) + (2,)] += 1
    for p in pieces:
        by_sequence[p.sequence_id].append((p.offset, p.length))
        by_doc[p.doc_id].append(p)
    for (doc_id, ids), times in wanted.items():
        fits = [p for p in by_doc[doc_id] if p.doc_tokens == len(ids)
                and np.frombuffer(p.ids, "<u2").tolist() == list(ids[p.start : p.start + p.length])]
        starts = sorted((p.start, p.length) for p in fits)
        covered = sum(n for _, n in starts)
        assert covered == times * len(ids), doc_id
        assert all(p.ids_crc32 == crc(ids[p.start : p.start + p.length]) for p in fits)
    assert sorted(by_sequence) == list(range(len(by_sequence)))
    for number, parts in by_sequence.items():
        end = 0
        for offset, n in sorted(parts):
            assert offset == end and n > 0
            end += n
        assert end == length or number == len(by_sequence) - 1


def test_packing_places_every_id_once(spark):
    made = corpus.rows()
    pieces = packing.pack(corpus.frame(spark, made), length=128).collect()
    check_pieces(pieces, made, 128)


def test_packing_keeps_the_shares_until_a_source_is_dry(spark):
    text = " ".join(corpus.vocabulary()[:400])
    made = [(i, text, "en", "ab"[i % 2], 0) + (None,) * corpus.EXTRA for i in range(12)]
    pieces = packing.pack(corpus.frame(spark, made), {"a": 3, "b": 1}, length=256).collect()
    check_pieces(pieces, made, 256)
    share = defaultdict(int)
    for p in pieces:
        if p.source == "a":
            share[p.sequence_id] += p.length
    total_a = 6 * (len(brute(text)) + 1)
    for number in range(total_a // 192 - 1):
        assert abs(share[number] - 192) <= 1


def test_cutting_stored_ids_lets_go_of_the_encoder(spark, monkeypatch):
    """Workers wait for later stages without the pieces they have met."""
    passes, kind = [], type(spark.range(1))
    through = kind.mapInArrow

    def seen(self, work, *args, **options):
        passes.append(work)
        return through(self, work, *args, **options)

    monkeypatch.setattr(kind, "mapInArrow", seen)
    packing.pack(spark.createDataFrame([(1, "a few words", "x")], "doc_id long, text string, source string"))
    path = default_tokenizer()
    tokens.encoder(path).encode(["a few words"])
    assert not list(passes[-1](iter([])))
    assert path not in tokens._encoders


def test_packing_of_an_empty_table(spark):
    assert packing.pack(corpus.frame(spark, [])).collect() == []


def test_packing_keeps_the_sources_shares_without_weights(spark):
    draw, words = random.Random(2), corpus.vocabulary()
    own = {"a": 60, "b": 23, "c": 9, "d": 9, None: 3}
    sources = [k for k, n in own.items() for _ in range(n)]
    draw.shuffle(sources)
    made = [(i, corpus.sentence(draw, words, 80), "en", k, 0) + (None,) * corpus.EXTRA for i, k in enumerate(sources)]
    pieces = packing.pack(corpus.frame(spark, made), length=256).collect()
    check_pieces(pieces, made, 256)
    total, share = defaultdict(int), defaultdict(int)
    for p in pieces:
        total[p.source] += p.length
        share[p.source, p.sequence_id] += p.length
    every = sum(total.values())
    for number in range(int(0.88 * every / 256)):
        for k in own:
            assert share[k, number] == pytest.approx(256 * total[k] / every, rel=0.13, abs=2)


@given(st.lists(st.integers(0, 1 << 50), max_size=60))
def test_default_weights_are_the_shares_in_few_classes(totals):
    weights = packing.share_weights(totals)
    least = max(totals, default=0) >> packing.SHARE_RANGE
    assert all(abs(w - max(n, least, 1)) * 16 <= max(n, least, 1) for n, w in zip(totals, weights))


def test_many_totals_have_few_weights():
    assert len(set(packing.share_weights([*range(100_000)]))) < 8 * 17


def test_more_than_a_thousand_sources(spark):
    made = [(i, f"a few words of {i}", "en", f"s{i % 1203}", 0) + (None,) * corpus.EXTRA for i in range(1500)]
    check_pieces(packing.pack(corpus.frame(spark, made), length=128).collect(), made, 128)


@given(st.lists(st.integers(0, 400), min_size=1, max_size=5), st.integers(1, 40), st.data())
@settings(max_examples=60, deadline=None)
def test_the_plan_sends_every_id_of_each_queue_once(totals, length, data):
    weights = [Fraction(data.draw(st.integers(1, 9))) for _ in totals]
    phases = packing.plan(totals, weights, length)
    seen = []
    for s, n in enumerate(totals):
        if n:
            starts, places = packing.place(phases, s, 0, n, length)
            for a, b, at in zip(starts, [*starts[1:], n], places):
                assert at // length == (at + b - a - 1) // length
                seen += range(at, at + b - a)
    assert sorted(seen) == list(range(sum(totals)))
