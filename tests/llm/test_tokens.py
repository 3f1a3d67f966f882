"""Word coder, packing, wavelet matrices."""

import bisect
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from rulewright.llm import packing, wavelet
from rulewright.llm.wordcoder import coder

ODD = ["", " ", "  \n ", "a\n b", "a\n\nb  c", " x\t", "don't it's '''s", "<|endoftext|> a", "naïve café №5 ½ ²³ 12345", "日本語 テスト", "Ünï İstanbul ΑΣ", "a_b__c 1_2", "\x1c\x1d x\x85y", "é́a", "A" * 300 + " b", "x " * 5]


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_coder_is_the_tokenizer(vocabulary, name):
    known = coder(vocabulary(name))

    @settings(max_examples=60, deadline=None)
    @given(st.lists(st.text(st.characters(codec="utf-8", exclude_characters="\x00"), max_size=40), max_size=6))
    def check(texts):
        got = known.encode([*texts, *ODD])
        want = known.tokenizer.encode_batch_fast([*texts, *ODD], add_special_tokens=False)
        assert [g.tolist() for g in got] == [w.ids for w in want]

    check()


def test_coder_starts_afresh(vocabulary, monkeypatch):
    from rulewright.llm import wordcoder

    monkeypatch.setattr(wordcoder, "MAX_WORDS", 20)
    known = wordcoder.WordCoder(vocabulary("byte_bpe_50k.json"))
    for k in range(12):
        text = " ".join(f"w{k}x{j} yes" for j in range(9))
        assert known.encode([text])[0].tolist() == known.tokenizer.encode(text, add_special_tokens=False).ids


def test_sum_of_squares_rule():
    """Each placement is the one that brute force finds best."""
    chance = np.random.default_rng(3)
    packer, gaps = packing.SumOfSquares(20), {}
    for size in chance.integers(1, 21, 300).tolist():
        def total(g):
            counts = {}
            for v in g.values():
                if v:
                    counts[v] = counts.get(v, 0) + 1
            return sum(c * c for c in counts.values())

        best = min(total(gaps | {k: gaps.get(k, 20) - size}) for k in [k for k, g in gaps.items() if g >= size] or [len(gaps)])
        sequence, offset = packer.place(size)
        assert offset == 20 - gaps.get(sequence, 20)
        gaps[sequence] = gaps.get(sequence, 20) - size
        assert gaps[sequence] >= 0 and total(gaps) == best


def best_fit_decreasing(sizes, capacity):
    gaps, n = [], 0
    for size in sorted(sizes, reverse=True):
        at = bisect.bisect_left(gaps, size)
        gap = gaps.pop(at) if at < len(gaps) else capacity
        n += gap == capacity
        bisect.insort(gaps, gap - size)
    return n


@pytest.mark.parametrize("shape", [(1.1, 300), (3.0, 120), (0.7, 900)])
def test_as_few_sequences_as_best_fit(shape):
    sizes = np.minimum(1024, 1 + np.random.default_rng(4).gamma(*shape, 5000).astype(int)).tolist()
    packer = packing.SumOfSquares(1024)
    for size in sorted(sizes, reverse=True):
        packer.place(size)
    assert packer.sequences <= best_fit_decreasing(sizes, 1024) * 1.003 + 1


def test_shards_by_pieces(spark, documents, vocabulary, monkeypatch):
    """As many shards as pieces ask for, whatever Catalyst believes about a table's size."""
    monkeypatch.setattr(packing, "SHARD_PIECES", 100)
    docs = documents(*[(k, f"a few words {k}") for k in range(250)])
    joined = docs.join(docs.select("doc_id"), "doc_id")
    for table in (docs, joined):
        got = packing.pack(table, vocabulary("byte_bpe_50k.json")).toPandas()
        assert (got["sequence_id"] // (1 << 40)).nunique() == 3 and got["sequence_id"].nunique() <= 6


def test_cut():
    assert packing.cut(5, 8) == [(0, 5)] and packing.cut(8, 8) == [(0, 8)] and packing.cut(16, 8) == [(0, 8), (8, 8)]
    assert packing.cut(19, 8) == [(0, 3), (3, 8), (11, 8)]


def test_pack(documents, vocabulary, prose):
    path = vocabulary("byte_bpe_50k.json")
    rows = [(1, None), (2, ""), (3, prose(3000, 1)), (3, prose(3000, 1)), *[(k, prose(k, k)) for k in range(4, 60)]]
    got = packing.pack(documents(*rows), path, shards=2).toPandas()
    tokenizer, texts = coder(path).tokenizer, dict(rows)
    for doc, pieces in got.groupby("doc_id"):
        ids = np.array([*tokenizer.encode(texts[doc] or "", add_special_tokens=False).ids, 2], np.uint32)
        assert sorted(zip(pieces["start"], pieces["length"], pieces["ids_crc32"], strict=True)) == sorted([(s, n, zlib.crc32(ids[s : s + n].tobytes())) for s, n in packing.cut(ids.size, 1024)] * (2 if doc == 3 else 1))
    for _, held in got.sort_values("offset").groupby("sequence_id"):
        assert held["offset"].tolist() == [0, *held["length"].cumsum()[:-1]] and held["length"].sum() <= 1024
    assert packing.pack(documents(*rows).limit(0), path).count() == 0


@settings(max_examples=40, deadline=None)
@given(st.lists(st.integers(0, 70000), max_size=1500), st.data())
def test_wavelet_matrix(ids, data):
    m = wavelet.WaveletMatrix.from_bytes(wavelet.to_bytes(np.array(ids, np.uint32), [7], np.array([len(ids)]), data.draw(st.sampled_from([64, 512, wavelet.CHUNK]))))
    assert m.decode().tolist() == ids and m.docs.tolist() == [7] and m.absent.tolist() == [False]
    for token in {*ids[:5], 3, 1 << 20}:
        where = [k for k, x in enumerate(ids) if x == token]
        assert m.occurrences(token) == where
        i = data.draw(st.integers(0, len(ids)))
        assert m.rank(token, i) == sum(k < i for k in where)
    for i in range(0, len(ids), 97):
        assert m.access(i) == ids[i]
    with pytest.raises(IndexError):
        m.select(1 << 20, 0)


def test_a_token_is_read_from_few_bytes(tmp_path):
    """Of a file with many chunks, the index and one chunk of each plane, or a few, are read."""
    rng = np.random.default_rng(3)
    ids = np.minimum(rng.zipf(1.3, 1 << 19), 40_000).astype(np.uint32)
    path = tmp_path / "x.wm"
    path.write_bytes(wavelet.to_bytes(ids, [1, None], np.array([1000, ids.size - 1000]), 1 << 13))
    whole = path.stat().st_size
    with wavelet.open_file(f"file://{path}") as m:
        opened = m.source.taken
        assert opened < whole / 20
        assert m.access(200_000) == ids[200_000] and m.source.taken - opened < whole / 40
    with wavelet.open_file(f"file://{path}") as m:
        assert m.rank(1, 150_000) == (ids[:150_000] == 1).sum() and m.source.taken < whole / 8
    with wavelet.open_file(f"file://{path}") as m:
        assert m.select(7, 500) == np.flatnonzero(ids == 7)[500] and m.source.taken < whole / 8
    with wavelet.open_file(f"file://{path}") as m:
        assert (m.docs.tolist(), m.absent.tolist(), m.lengths.tolist()) == ([1, 0], [False, True], [1000, ids.size - 1000]) and m.source.taken < whole / 20
        assert (m.decode() == ids).all()
        with pytest.raises(IndexError):
            m.access(ids.size)


def test_round_trip_of_null_ids(documents, vocabulary, prose, monkeypatch):
    """Rows without an id come first, by text, and have none when they are read again."""
    monkeypatch.setattr(wavelet, "SHARD_BYTES", 100)
    rows = [(None, "zebra"), (None, None), (5, "five"), (None, "ant"), (-3, "three"), *[(10 + k, prose(20, k)) for k in range(90)]]
    got = [(r["doc_id"], r["start"]) for r in wavelet.round_trip(documents(*rows).repartition(6), vocabulary("word_bpe_49k.json")).orderBy("start").collect()]
    assert [d for d, _ in got] == [None, None, None, -3, 5, *range(10, 100)] and len({s for _, s in got}) == len(rows)


def test_round_trip(documents, vocabulary, prose, monkeypatch):
    monkeypatch.setattr(wavelet, "FILE_TOKENS", 300)
    path = vocabulary("word_bpe_49k.json")
    rows = [(9, None), (4, ""), *[(100 - k, prose(7 * k, k)) for k in range(30)], (50, "twice"), (50, "and again")]
    got = wavelet.round_trip(documents(*rows), path).orderBy("start").toPandas()
    tokenizer, start = coder(path).tokenizer, 0
    for (doc, text), r in zip(sorted((d, t or "") for d, t in rows), got.itertuples(), strict=True):
        ids = np.array([*tokenizer.encode(text, add_special_tokens=False).ids, 1], np.uint32)
        assert (r.doc_id, r.start, r.n_tokens, r.ids_crc32) == (doc, start, ids.size, zlib.crc32(ids.tobytes()))
        start += ids.size
    assert wavelet.round_trip(documents(*rows).limit(0), path).count() == 0
