"""Components, SimHash, near copies, passages, the language model, the pipeline."""

import itertools
import math
import os
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from rulewright.llm import graph, passages, pitmanyor, simhash


def components(nodes, linked):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in linked:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def test_components(spark):
    chance = random.Random(1)
    edges = [(chance.randrange(300), chance.randrange(300)) for _ in range(200)] + [(1000 + k, 1001 + k) for k in range(120)] + [(7, 7), (5000, 5000)]
    frame = spark.createDataFrame([*edges, *edges[:5]], "a long, b long").unionByName(spark.createDataFrame([(None, 3)], "a long, b long"))
    got = {r["node"]: r["root"] for r in graph.components(frame).collect()}
    assert got == components({x for e in edges for x in e}, edges)
    assert graph.components(frame.limit(0)).count() == 0


def near(base: int, bits: int, chance) -> int:
    for b in chance.sample(range(64), bits):
        base ^= 1 << b
    return base


@pytest.mark.parametrize("block", [1 << 13, 40])
def test_links(spark, block):
    """Random fingerprints, pairs at all distances, and a crowd of near copies in one place."""
    chance = random.Random(9)
    fps = [chance.getrandbits(64) for _ in range(300)]
    fps += [near(fps[k], k % 7, chance) for k in range(300)] + [near(fps[0], chance.randint(1, 4), chance) for _ in range(250)] + [0, (1 << 64) - 1, 1 << 63]
    fps = sorted(set(fps))
    a = np.array(fps, np.uint64)
    linked = [(i, j) for i in range(len(fps)) for j in np.flatnonzero(np.bitwise_count(a ^ a[i]) <= 4).tolist() if i < j]
    frame = spark.createDataFrame([(int(np.uint64(x).astype(np.int64)),) for x in fps], "fp long")
    found = [(r["a"] % (1 << 64), r["b"] % (1 << 64)) for r in simhash.links(frame, 4, block).collect()]
    assert all((x ^ y).bit_count() <= 4 for x, y in found)
    assert components(fps, found) == components(fps, [(fps[i], fps[j]) for i, j in linked])


def test_fingerprint_by_definition(prose):
    from xxhash import xxh64_intdigest

    for text in ["", " \t\n", "One", "One two", "a b c d", "É a b\x0bc d e", prose(70, 3).title()]:
        words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text))
        shingles = [" ".join(words[k : k + 4]) for k in range(max(1, len(words) - 3))] if words else []
        hashes = [xxh64_intdigest(s.encode(), 42) for s in shingles]
        assert simhash.fingerprint(text) == sum((2 * sum(h >> b & 1 for h in hashes) > len(hashes)) << b for b in range(64))


def test_near_duplicates(documents, prose):
    rows = [(5, None), (2, ""), (9, " \n"), *[(100 + k, prose(80, k)) for k in range(20)], (40, prose(80, 3)), (40, prose(80, 4)), (300, prose(80, 5).upper())]
    got = sorted((r["doc_id"], r["fingerprint"], r["component_id"]) for r in simhash.near_duplicates(documents(*rows)).collect())
    fps = [(d, simhash.fingerprint(t or "")) for d, t in rows]
    linked = [(i, j) for i in range(len(fps)) for j in range(i) if (fps[i][1] ^ fps[j][1]).bit_count() <= 4]
    groups = components(range(len(fps)), linked)
    least = {}
    for k, root in groups.items():
        least[root] = min(least.get(root, 1 << 60), fps[k][0])
    assert got == sorted((d, f"{f:016x}", least[groups[k]]) for k, (d, f) in enumerate(fps))
    assert simhash.near_duplicates(documents(*rows).limit(0)).count() == 0


def changed(text: str, words, n: int, seed: int) -> str:
    chance, out = random.Random(seed), text.split()
    for p in chance.sample(range(len(out)), n):
        out[p] = chance.choice(words)
    return " ".join(out)


def test_near_copies(documents, prose, words):
    rows = [(1, None), (2, ""), *[(10 + k, prose(400, k)) for k in range(40)]]
    rows += [(200 + k, changed(prose(400, k), words, k % 8, k)) for k in range(40)] + [(500, prose(400, 1)), (500, prose(400, 1))]
    got = {r["doc_id"]: r["component_id"] for r in simhash.near_copies(documents(*rows)).collect()}
    assert got[1] == got[2] == 1 and got[500] == 11
    assert all(got[200 + k] == 10 + k for k in range(40))
    assert all(got[10 + k] == 10 + k for k in range(40))


def test_chains():
    x = [0, 5, 10, 30, 36, 42, 200, 205]
    y = [100, 105, 110, 131, 137, 143, 20, 25]
    found = passages.chains(np.array(x), np.array(y))
    assert found == [[(0, 10, 100), (30, 42, 101)], [(200, 205, -180)]]


def test_fenwick():
    chance, tree, held = random.Random(4), passages.Fenwick(50), []
    for k in range(300):
        place, value = chance.randrange(50), chance.random()
        tree.put(place, value, k)
        held.append((place, value, k))
        upto = chance.randrange(51)
        assert tree.before(upto) == max(((v, o) for p, v, o in held if p < upto), default=(float("-inf"), -1))


def test_passages(documents, prose, words):
    shared, fuzzy = prose(70, 900), prose(90, 901)
    rows = [(k, prose(150, k)) for k in range(30)] + [(90, None), (91, ""), (92, "few words here")]
    rows += [(100 + k, f"{prose(60 + k, 100 + k)} {shared.title()} {prose(50, 200 + k)}") for k in range(12)]
    rows += [(300, f"{prose(40, 300)} {fuzzy} {prose(40, 301)}"), (301, f"{prose(10, 302)}\n{changed(fuzzy, words, 5, 1)}  {prose(80, 303)}")]
    rows += [(400, prose(120, 777)), (401, prose(30, 8) + " tail")]
    got = passages.repeats(documents(*rows)).toPandas()
    spans = {d: g for d, g in got.groupby("doc_id")}
    assert set(spans) == {*range(100, 112), 300, 301}
    for k in range(12):
        r = spans[100 + k].iloc[0]
        assert len(spans[100 + k]) == 1 and 60 + k - 2 <= r["start"] <= 60 + k and 130 + k <= r["end"] <= 132 + k
        assert r["passage"] == 100 and r["n_links"] >= 1
    assert spans[300].iloc[0]["passage"] == spans[301].iloc[0]["passage"] == 300
    assert abs(spans[301].iloc[0]["start"] - 10) <= 8 and abs(spans[301].iloc[0]["end"] - 100) <= 8
    copies = [(1, prose(60, 1)), (2, prose(60, 1)), (2, prose(60, 1)), (3, prose(20, 2)), (4, prose(20, 2))]
    whole = passages.repeats(documents(*copies)).orderBy("doc_id").toPandas()
    assert whole.to_numpy().tolist() == [[1, 0, 60, 1, 0], [2, 0, 60, 1, 0]]
    assert passages.repeats(documents(*rows).limit(0)).count() == 0


def crowd(prose, words):
    """Texts with passages in common: boilerplate that most have, passages built of two pieces that others have alone, pairs, and edited copies in a group."""
    common_line, left, right = prose(30, 1), prose(30, 2), prose(30, 3)
    filler = lambda k, n=60: prose(n, 20_000 + k)
    rows, planted = [], []

    def add(doc, *pieces):
        text, at = [], 0
        for piece, name in pieces:
            n = len(piece.split())
            if name:
                planted.append((name, doc, at, at + n))
            text.append(piece)
            at += n
        rows.append((doc, " ".join(text)))

    for k in range(120):
        add(k, (filler(k), None), (common_line, None), (filler(1000 + k), None))
    for k in range(40):
        add(200 + k, (filler(2000 + k), None), (left, None), (filler(3000 + k), None))
        add(300 + k, (filler(4000 + k), None), (right, None), (filler(5000 + k), None))
    for k in range(3):  # 60 words, of which many texts have one half
        add(400 + k, (filler(6000 + k), None), (f"{left} {right}", "built"), (filler(7000 + k), None))
    for k in range(20):
        shared = prose(50 + 3 * k, 8000 + k)
        add(500 + 2 * k, (filler(9000 + k, 5 * k), None), (shared, f"pair{k}"), (filler(9100 + k), None))
        add(501 + 2 * k, (filler(9200 + k, 90 - 4 * k), None), (shared, f"pair{k}"))
    # Two passages with other words between them, in two texts: neither is lost by the other.
    one, two = prose(55, 8101), prose(55, 8102)
    for k in range(2):
        add(600 + k, (filler(9300 + k), None), (one, "one"), (filler(9400 + k, 40), None), (two, "two"), (filler(9500 + k), None))
    return rows, planted


def found_spans(documents, rows):
    spans = {}
    for r in passages.repeats(documents(*rows)).collect():
        spans.setdefault(r["doc_id"], []).append((r["start"], r["end"], r["passage"]))
    return spans


def misses(spans, planted, part=1.0):
    """Planted places of which less than `part` lies in a span, and names whose places are in several classes."""
    lost, classes = [], {}
    for name, doc, start, end in planted:
        best = max(((min(e, end) - max(s, start), c) for s, e, c in spans.get(doc, [])), default=(0, None))
        if best[0] < part * (end - start):
            lost.append((name, doc, best[0], end - start))
        else:
            classes.setdefault(name, set()).add(best[1])
    return lost, [n for n, c in classes.items() if len(c) > 1]


@pytest.mark.parametrize("hot", [passages.HOT, 4])
def test_passages_in_a_crowd(documents, prose, words, monkeypatch, hot):
    """All exact passages, with usual groups and with all larger ones divided."""
    monkeypatch.setattr(passages, "HOT", hot)
    rows, planted = crowd(prose, words)
    spans = found_spans(documents, rows)
    lost, torn = misses(spans, planted, 0.96)
    assert not lost and not torn
    assert set(spans) == {doc for _, doc, _, _ in planted}


def test_all_exact_repeats_are_covered(documents, prose, words):
    """Whatever run of 50 words two different texts share lies in spans of both."""
    rows, _ = crowd(prose, words)
    rows += [(950 + k, f"{prose(9, 50 + k)} {'again ' * (48 + k % 9)} {prose(9, 70 + k)} {'and ' * (30 + 20 * (k % 3))}") for k in range(14)] + [(970, "once " * 70)]
    rows += [(900 + k, f"{prose(70, 11)} {prose(20 + k, 12)} {changed(prose(200, 13), words, 3 + k, k)}") for k in range(12)]
    spans, seen = found_spans(documents, rows), {}
    for doc, text in rows:
        own = text.lower().split()
        for at in range(len(own) - 49):
            seen.setdefault(tuple(own[at : at + 50]), set()).add((doc, at))
    shared = [place for places in seen.values() if len({d for d, _ in places}) > 1 for place in places]
    assert len(shared) > 500
    covered = lambda doc, at: any(s <= at + 2 and at + 48 <= e for s, e, _ in spans.get(doc, []))
    assert all(covered(*place) for place in shared)


def edited_words(text, words, share, seed):
    """Words replaced, left out or put in."""
    chance, out = random.Random(seed), []
    for w in text.split():
        if chance.random() >= share:
            out.append(w)
        else:
            out += chance.choice(([chance.choice(words)], [], [w, chance.choice(words)]))
    return " ".join(out)


@pytest.mark.parametrize(("share", "least"), [(0.05, 0.97), (0.1, 0.9)])
def test_fuzzy_passages(documents, prose, words, share, least):
    """Edited copies, in pairs and in a group: how many are found, and in one class."""
    rows, planted = [], []
    for k in range(60):
        original = prose(60 + k, 30_000 + k)
        for side in (0, 1):
            copy, before = (edited_words(original, words, share, k) if side else original), prose(40, 31_000 + 2 * k + side)
            rows.append((2 * k + side, f"{before} {copy} {prose(30, 32_000 + 2 * k + side)}"))
            planted.append((f"pair{k}", 2 * k + side, 40, 40 + len(copy.split())))
    original = prose(80, 33_000)
    for k in range(80):
        copy = edited_words(original, words, share / 2, 500 + k)
        rows.append((1000 + k, f"{prose(30, 34_000 + k)} {copy} {prose(30, 35_000 + k)}"))
        planted.append(("group", 1000 + k, 30, 30 + len(copy.split())))
    lost, torn = misses(found_spans(documents, rows), planted, 0.75)
    assert len(lost) <= (1 - least) * len(planted) and not torn


def matched_share(a, b):
    """Words that two texts have in common in order, of the longer one."""
    row = [0] * (len(b) + 1)
    for x in a:
        new = [0]
        for k, y in enumerate(b):
            new.append(row[k] + 1 if x == y else max(new[-1], row[k + 1]))
        row = new
    return row[-1] / max(len(a), len(b))


def test_passages_down_to_the_identity_claimed(documents, prose, words):
    """Pairs edited ever more: nine of ten are found in each step from 0.85 on, and most of those that are barely as alike as IDENTITY asks."""
    rows, pairs = [], []
    for share in (0.04, 0.08, 0.12, 0.15, 0.18):
        for n in (55, 80, 150):
            for k in range(40):
                seed = int(share * 100) * 10_000 + n * 100 + k
                original, doc = prose(n, seed), 2 * len(pairs)
                copy = edited_words(original, words, share, seed)
                for side, text in enumerate((original, copy)):
                    rows.append((doc + side, f"{prose(40, 3_000_000 + doc + side)} {text} {prose(30, 4_000_000 + doc + side)}"))
                pairs.append((matched_share(original.split(), copy.split()), doc, len(original.split()), len(copy.split())))
    spans, bins = found_spans(documents, rows), {}
    for alike_, doc, *sizes in pairs:
        inside = [max((min(e, 40 + n) - max(s, 40) for s, e, _ in spans.get(doc + side, [])), default=0) / n for side, n in enumerate(sizes)]
        if alike_ >= passages.IDENTITY + 0.02:
            bins.setdefault(min(0.95, int(alike_ * 20) / 20), []).append(min(inside) >= 0.75)
    assert set(bins) == {0.8, 0.85, 0.9, 0.95} and all(len(b) >= 30 for b in bins.values())
    found = {k: sum(b) / len(b) for k, b in bins.items()}
    assert all(found[k] >= 0.9 for k in (0.85, 0.9, 0.95)) and found[0.8] >= 0.7, found


def test_alignment_goes_on_beyond_the_slices(documents, prose, words, monkeypatch):
    """Long copies whose seeds are few: ends far from any chain are still found."""
    monkeypatch.setattr(passages, "MARGIN", 4)
    shared = prose(400, 40_000)
    rows = [(k, f"{prose(50, 41_000 + k)} {shared} {prose(50, 42_000 + k)}") for k in range(3)]
    lost, torn = misses(found_spans(documents, rows), [("all", k, 50, 450) for k in range(3)], 0.99)
    assert not lost and not torn


def test_alike():
    """Passages made of runs (place, place, words)."""
    alike = lambda *runs: [(s, e, n) for s, e, _, _, n in passages.alike(*np.array(runs, np.int64).reshape(-1, 3).T)]
    assert alike((0, 7, 55), (95, 102, 55)) == [(0, 55, 55), (95, 150, 55)]  # 110 of 150 words are too few, each part is enough
    assert alike((0, 0, 45), *[(46 + 4 * k, 46 + 4 * k, 2) for k in range(5)]) == []  # half of the words after 45 are no reason to call them 50
    assert alike((0, 0, 50)) == [(0, 50, 50)] and alike((0, 0, 49)) == [] and alike() == []
    assert alike(*[(8 * k, 8 * k, 7) for k in range(15)]) == [(0, 119, 105)]
    assert alike((0, 0, 30), (30, 32, 30)) == [(0, 60, 60)]  # two words more in the other text
    assert alike((0, 0, 30), (28, 30, 30)) == [(0, 58, 58)]  # a run that begins again within the one before


def test_runs():
    chance = random.Random(1)
    for _ in range(30):
        a = np.array([chance.randrange(3) for _ in range(40)], np.uint64)
        b = np.array([chance.randrange(3) for _ in range(45)], np.uint64)
        want = set()
        for d in range(2 - passages.SHIFT, 3 + passages.SHIFT):
            x = 0
            while x < a.size:
                e = x
                while e < a.size and 0 <= e + d < b.size and a[e] == b[e + d]:
                    e += 1
                if e - x >= (1 if d == 2 else passages.RUN):
                    want.add((x, x + d, e - x))
                x = max(e, x + 1)
        firm = [(x, x + k) for x, _, k in want if k >= passages.FIRM]
        want = {(x, y, k) for x, y, k in want if any(x - e <= passages.AROUND and s - (x + k) <= passages.AROUND for s, e in firm)}
        assert {tuple(map(int, r)) for r in zip(*passages.runs(a, b, [(10, 12, 2)]), strict=True)} == want


def seatings(n, d):
    """For each number of tables, the sum over all seatings of n customers of the products that sizes contribute."""
    row = {1: 1.0}
    for k in range(1, n):
        row = {t: row.get(t - 1, 0.0) + (k - d * t) * row.get(t, 0.0) for t in range(1, k + 2)}
    return row


def rising(strength, d, n):
    return math.prod(strength + k * d for k in range(n))


def test_gibbs_samples_the_posterior():
    """Tables per context and of the parent, against all seatings of three words in two contexts."""
    counts, chains = [[3, 1], [2, 0], [1, 2]], 4000
    ways = [[seatings(n, pitmanyor.CONTEXT_D) if n else {0: 1.0} for n in row] for row in counts]
    total, sums = 0.0, np.zeros(3)
    for a, b, c, e, f in itertools.product(*(ways[i][z] for i, z in ((0, 0), (0, 1), (1, 0), (2, 0), (2, 1)))):
        tables = (a + c + e, b + f)
        of_words = (a + b, c, e + f)
        inner = math.prod(w[t] for w, t in zip((ways[0][0], ways[0][1], ways[1][0], ways[2][0], ways[2][1]), (a, b, c, e, f), strict=True))
        inner *= math.prod(rising(pitmanyor.CONTEXT_S, pitmanyor.CONTEXT_D, t) for t in tables) / rising(pitmanyor.WORD_S, 1, sum(tables))
        for own in itertools.product(*(seatings(t, pitmanyor.WORD_D) for t in of_words)):
            weight = inner * rising(pitmanyor.WORD_S, pitmanyor.WORD_D, sum(own)) * math.prod(seatings(t, pitmanyor.WORD_D)[k] / 4**k for t, k in zip(of_words, own, strict=True))
            total += weight
            sums += weight * np.array([*tables, sum(own)])
    cells = np.tile([2, 1, 2], chains)
    z, customers = np.tile([0, 1, 0, 0, 1], chains), np.tile([3, 1, 2, 1, 2], chains)
    chain, seats = np.repeat(np.arange(chains), 3), pitmanyor.seated_first(cells, customers)
    rng, found = np.random.default_rng(5), []
    for k in range(40):
        of_cell = np.repeat(chain, seats.cells)
        tables = np.stack([np.bincount(of_cell[z == j], seats.tables[z == j], chains) for j in (0, 1)])
        own = np.bincount(chain, seats.own, chains)
        if k >= 15:
            found.append(np.vstack([tables, own]))
        drawn = [pitmanyor.Totals(np.array([6, 3]), tables[:, c].astype(int), int(own[c]), 3).weights(rng) for c in range(chains)]
        opening, fresh = np.stack([o for o, _ in drawn]), np.array([f for _, f in drawn])
        seats = pitmanyor.sweep(seats, opening[of_cell, z], fresh[chain], rng.integers(0, 1 << 63, chain.size).astype(np.uint64))
        assert (seats.tables >= 1).all() and (seats.tables <= seats.customers).all() and (seats.own >= 1).all() and (seats.own <= seats.above()).all()
    got = np.stack(found)
    error = got.mean(0).std(1) / chains**0.5
    assert (abs(got.mean((0, 2)) - sums / total) < 5 * error).all()


def test_seatings_are_counted():
    """Small counts by enumeration, large ones against the recurrence."""
    for n in (1, 2, 7, 40):
        want = seatings(n, 0.7)
        assert np.allclose(pitmanyor.log_ways(np.array(n), np.arange(1, n + 1), 0.7), [math.log(want[t]) for t in range(1, n + 1)])
    assert pitmanyor.log_ways(np.array([3, 3, 5000]), np.array([0, 4, 4999]), 0.7).tolist() == [-np.inf] * 3
    row = np.array([-np.inf, 0.0])
    for c in range(1, 6000):
        with np.errstate(divide="ignore"):
            row = np.append(np.append(-np.inf, np.logaddexp(row[:-1], np.log(c - 0.7 * np.arange(1, c + 1)) + row[1:])), 0.0)
    got = pitmanyor.log_ways(np.array(6000), np.arange(1, 1000), 0.7)
    assert abs(np.diff(got) - np.diff(row[1:1000])).max() < 0.005


def settled(customers, sweeps, seed, opening=0.07, fresh=0.05, words_=150, cells=8):
    """Mean tables of a cell after each sweep, from the first seats."""
    rng, seats = np.random.default_rng(seed), pitmanyor.seated_first(np.full(words_, cells), np.full(words_ * cells, customers))
    for _ in range(sweeps):
        seats = pitmanyor.sweep(seats, np.full(words_ * cells, opening), np.full(words_, fresh), rng.integers(0, 1 << 63, words_).astype(np.uint64))
        yield seats.tables.mean()


@pytest.mark.parametrize("customers", [2, 10, 17, 100, 2_000, 20_000])
def test_frequent_words_reach_their_tables(customers):
    """After the sweeps of production, all cells together have the tables that they have in the long run."""
    late = np.mean([*settled(customers, 60, 1, words_=1500)][20:])
    soon = np.mean([[*settled(customers, pitmanyor.BURN_IN + pitmanyor.KEPT, seed, words_=1500)][pitmanyor.BURN_IN :] for seed in (2, 3, 4)])
    assert abs(soon / late - 1) < 0.01


def test_steps_reach_what_drawing_outright_gives(monkeypatch):
    """Sixteen customers drawn outright, and by steps alone."""
    outright = np.mean([*settled(16, 120, 5)][20:])
    monkeypatch.setattr(pitmanyor, "OUTRIGHT", (4, 8))
    assert abs(np.mean([*settled(16, 120, 6)][20:]) / outright - 1) < 0.01


def test_longer_burn_in_changes_no_score(spark):
    """On the smallest test tables, sweeps thrown away beyond the first few move a text's score by less than a fiftieth."""
    if not os.path.isdir("/root/testdata/sf0.001"):
        pytest.skip("no test tables here")
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    few, many = (pitmanyor.score(docs, F.col("doc_id") % 7 != 2, burn_in=n).toPandas().set_index("doc_id")["score"] for n in (pitmanyor.BURN_IN, 40))
    assert (abs(few - many) / -many).max() < 0.02 and (abs(few - many) / -many).median() < 0.002


def test_language_model(spark, documents, words):
    # Two languages, and few words that make up most of each text.
    chance = random.Random(3)
    own = [sorted(words, key=lambda w: sum(map(ord, w)) % 7 * (1 if k else -1)) for k in (0, 1)]
    text = lambda k: " ".join(own[k % 2][min(399, int(chance.expovariate(0.05)))] for _ in range(80)).title()
    rows = [(k, text(k)) for k in range(60)] + [(100, None), (101, ""), (102, "unseen words only"), (3, "twice"), (104, text(1) * 300), (None, "no id")]
    training = F.col("doc_id") % 5 != 2
    got = pitmanyor.score(documents(*rows), training).toPandas()
    tokens = [(d, [*(t or "").encode().lower().split(), b""]) for d, t in rows]
    counts = Counter(w for d, ws in tokens if d is not None and d % 5 != 2 for w in ws)
    n, v = sum(counts.values()), len(counts)
    base = lambda ws: sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in ws)
    want = sorted((d or -1, d is None or d % 5 == 2, len(ws), sum(counts[w] > 0 for w in ws), n, round(base(ws), 6)) for d, ws in tokens)
    assert sorted((int(r.doc_id) if r.doc_id == r.doc_id and r.doc_id else -1, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in got.itertuples()) == want
    assert (got["score"] < 0).all()
    held = got[got["held_out"] & (got["doc_id"] < 60)]
    assert held["score"].sum() > held["base_score"].sum()
    # The same scores whatever the number of partitions, and by the model's own probabilities.
    had = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "7")
    again = pitmanyor.score(documents(*rows).repartition(5), training).toPandas()
    spark.conf.set("spark.sql.shuffle.partitions", had)
    key = ["doc_id", "n_tokens", "score"]
    assert np.allclose(got.sort_values(key)["score"], again.sort_values(key)["score"], atol=1e-9)
    none = pitmanyor.score(documents(*rows), F.lit(False)).toPandas()
    assert (none["n_known"] == 0).all() and (none["train_tokens"] == 0).all() and (none["score"] == 0).all()
    assert pitmanyor.score(documents(*rows).limit(0), training).count() == 0


def test_contexts_are_distributions(documents, prose, monkeypatch):
    monkeypatch.setattr(pitmanyor, "HOT_WORDS", 30)
    rows = [(k, prose(60, k)) for k in range(50)]
    docs = documents(*rows).select("doc_id", "text")
    model = pitmanyor.fit(docs)
    table = model.table.collect()
    assert sum(r["c"] for r in table) == model.tokens == 50 * 61
    cells, z = np.array([len(r["z"]) for r in table]), np.concatenate([r["z"] for r in table])
    dense = pitmanyor.probabilities(model.left(), np.array([r["pw"] for r in table]), cells, z, np.concatenate([r["part"] for r in table]))
    assert (dense > 0).all() and abs(dense.sum(0) + model.unknown() - 1).max() < 1e-9
    # Scores of texts are the products of these, for broadcast and other words alike.
    row = {bytes(r["word"]): k for k, r in enumerate(table)}
    got = {r["doc_id"]: r["score"] for r in pitmanyor.score(documents(*rows, (99, prose(9, 3) + " Never seen")), F.col("doc_id") < 50).collect()}
    for d, text in [*rows[:5], (99, prose(9, 3) + " Never seen")]:
        at, total = 0, 0.0
        for w in [*text.encode().lower().split(), b""]:
            total += math.log10(dense[row[w], at] if w in row else model.unknown()[at])
            at = model.classes.get(w, at)
        assert abs(got[d] - total) < 1e-9


def test_pipeline(spark, tmp_path, prose, words, vocabulary):
    import corpus_pipeline

    # A little corpus of two languages with copies, a leak, a secret and a text that is no language.
    leak = prose(40, 900)
    rows = [(k, prose(200, k), "xx") for k in range(40)] + [(50 + k, changed(prose(200, k), words, 3, k), "xx") for k in range(5)]
    rows += [(70, prose(100, 70) + " " + leak, "xx"), (71, prose(100, 71) + " password=hunter2hunter2", "xx"), (72, "1234 !!", "xx"), (73, None, None)]
    spark.createDataFrame([(d, t, lang, "s", len(t or "")) for d, t, lang in rows], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, leak)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs, kept = spark.read.parquet(f"{tmp_path}/documents.parquet"), {}
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES[:-1]):
        stage(spark, docs, str(tmp_path)).write.parquet(f"{tmp_path}/{k}")
        docs = spark.read.parquet(f"{tmp_path}/{k}")
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        kept[name] = {r["doc_id"] for r in docs.collect()}
    assert kept["language_id"] == {*range(40), *range(50, 55), 70, 71}
    assert kept["simhash_near_dedup"] == {*range(40), 70, 71}
    assert kept["benchmark_decontamination"] == kept["secret_scans"] == {*range(40), 71}
    assert docs.where("doc_id = 71").first()["text"].endswith(" <secret>")
    packed = corpus_pipeline.run(spark, str(tmp_path)).toPandas()
    assert set(packed["doc_id"]) == kept["secret_scans"] and packed.groupby("sequence_id")["length"].sum().max() <= 1024


def shingled(text, width=5):
    ws = (text or "").lower().split()
    return {tuple(ws[k : k + width]) for k in range(max(1, len(ws) - width + 1))} if ws else set()


def similar_classes(rows, bound=0.8):
    """doc_id and smallest doc_id of its class, by comparing all pairs."""
    sets = [shingled(t) for _, t in rows]
    close = lambda a, b: 5 * len(a & b) >= 4 * len(a | b) if bound == 0.8 else len(a & b) >= bound * len(a | b)
    roots = components(range(len(rows)), [(i, j) for i in range(len(rows)) for j in range(i) if close(sets[i], sets[j])])
    least = {}
    for k, root in roots.items():
        least[root] = min(least.get(root, 1 << 60), rows[k][0])
    return {d: least[roots[k]] for k, (d, _) in enumerate(rows)}


def found_classes(documents, rows):
    return {r["doc_id"]: r["component_id"] for r in simhash.near_copies(documents(*rows)).collect()}


def test_near_copies_cut_extended_and_moved(documents, prose):
    """Copies that lost or gained their ends, or had blocks moved, around the bound, short and long."""
    rows = []
    for k in range(60):
        n, chance = (12, 30, 90, 400, 1500)[k % 5], random.Random(k)
        own, part = prose(n, 5000 + k), chance.uniform(0.74, 0.9)
        ws, cut = own.split(), int(n * part)
        at = chance.randrange(n)
        rows += [(10 * k, own), (10 * k + 1, " ".join(ws[:cut])), (10 * k + 2, own + " " + prose(int(n / part) - n, 7000 + k)), (10 * k + 3, " ".join(ws[at:] + ws[:at])), (10 * k + 4, " ".join(ws[n - cut :]).upper())]
    want = similar_classes(rows)
    assert found_classes(documents, rows) == want
    assert len(set(want.values())) < len(rows) * 0.8


def test_near_copies_in_crowds(documents, prose):
    """Texts of the same words, so with equal fingerprints, and texts that are near one another but not to the one between them."""
    parts, chance, rows = [prose(20, 9000 + k) for k in range(12)], random.Random(8), []
    for k in range(40):
        order = chance.sample(parts, 12)
        words = [w for p in order for w in chance.sample(p.split(), 20)]
        swapped = words[:]
        swapped[3], swapped[4], swapped[150], swapped[151] = swapped[4], swapped[3], swapped[151], swapped[150]
        rows += [(2 * k, " ".join(words)), (2 * k + 1, " ".join(swapped))]
    want = similar_classes(rows)
    assert all(want[2 * k + 1] == want[2 * k] == 2 * k for k in range(40))
    assert found_classes(documents, rows) == want


def test_near_copies_at_the_bound(documents, prose, words):
    """Long texts just under and over four fifths, which a sample of their shingles can't tell apart."""
    rows = []
    for k in range(40):
        chance, n = random.Random(k), 1500
        ws = prose(n, 11000 + k).split()
        # A replaced word far from the others changes five shingles, of which both texts then have five of their own.
        replaced = chance.sample(range(0, n, 10), 33 + k % 2)
        for p in replaced:
            ws[p] = "new" + str(p)
        rows += [(2 * k, prose(n, 11000 + k)), (2 * k + 1, " ".join(ws))]
    want = similar_classes(rows)
    assert {want[2 * k + 1] == 2 * k for k in range(40)} == {True, False}
    assert found_classes(documents, rows) == want


def test_frequent_groups_are_counted_over_all_rows(spark):
    """Of 4000 texts, a seed that 128 rows have is divided and one that 127 have is not, as are the narrower groups."""
    least, rows, one, two = 2 * passages.HOT, [], 10**15, 10**16
    for key in range(4000):
        rows += [(key, 10 * k, seed) for k, seed in enumerate([s for s, n in ((one, least), (two, least - 1), (two + 1, least - 1)) if key < n] + [1000 + key])]
    frame = spark.createDataFrame(rows, "key long, at int, seed long").repartition(5)
    wide = [int(passages._mix(np.array([one], np.uint64), np.uint64(back))[0]) for back in (0, 1)]
    assert set(passages.hot_groups(frame, 4 * passages.COUNTED).tolist()) == set()
    # Nothing is before the first seed of a text, so that group of all its widths is as frequent.
    hot = set(passages.hot_groups(frame, 2 * passages.COUNTED).tolist())
    assert set(wide) < hot and len(hot) == 5 and int(passages._mix(np.array([two], np.uint64), np.uint64(0))[0]) not in hot


def test_seeds_of_one_text_are_dropped_and_none_that_two_batches_have(prose):
    """Rows of a seed that several texts of a batch have are dealt; a text elsewhere is told of them."""
    import pyarrow as pa

    chance = random.Random(3)
    word = lambda: "".join(chance.choice("abcdefgh") for _ in range(6))
    shared, own = [word() for _ in range(60)], lambda: [word() for _ in range(40)]
    texts = [" ".join(own() + shared + own()) for _ in range(6)] + [" ".join(own() + shared), " ".join(own() * 2)]
    batches = [pa.RecordBatch.from_arrays([pa.array(list(k), pa.int64()), pa.array([texts[i] for i in k])], ["key", "text"]) for k in (range(6), [6, 7])]
    rows = pa.Table.from_batches(list(passages._find_seeds(batches))).sort_by([(c, "ascending") for c in ("seed", "part", "key", "at")])
    assert max(rows.column("part").to_pylist()) > 0
    got = pa.Table.from_batches(list(passages._repeated(iter(rows.to_batches())))).to_pylist()
    of = {k: passages.seeds(passages.word_hashes(t)) for k, t in enumerate(texts)}
    many = Counter(s for _, found in of.values() for s in set(found.tolist()))
    want = {(np.uint64(s).astype(np.int64), k, p) for k, (at, found) in of.items() for p, s in zip(at.tolist(), found.tolist(), strict=True) if many[s] > 1}
    assert {(r["seed"], r["key"], r["at"]) for r in got if r["long"] == 0} == want
    assert {r["key"]: r["at"] for r in got if r["long"] < 0} == {k: len(t.split()) for k, t in enumerate(texts)}
