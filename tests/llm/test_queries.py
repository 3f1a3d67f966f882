"""The opN_ queries and the pipeline over the smallest test tables, against plain readings of what they must return."""

import hashlib
import os
import re
import zlib

import numpy as np
import pandas as pd
import pyarrow.parquet as pq
import pytest
from test_copies import components, shingled, similar_classes
from test_search import RULES, plainly

from rulewright.llm import langid, queries, secrets

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables here")


def fold(ids, modulus):
    return np.array([zlib.crc32(str(d).encode()) % modulus for d in ids])


@pytest.fixture(scope="module")
def texts():
    docs = pq.read_table(f"{SF}/documents.parquet").to_pandas().sort_values("doc_id")
    return dict(zip(docs["doc_id"], docs["text"].fillna(""), strict=True))


def test_op1(spark, texts):
    from tokenizers import Tokenizer

    got = queries.op1_best_fit_packing(spark, SF).toPandas()
    tokenizer = Tokenizer.from_file(queries.tokenizer_path("byte_bpe_50k.json"))
    for doc, text in texts.items():
        ids = np.array([*tokenizer.encode(text, add_special_tokens=False).ids, 2], "<u4")
        own = got[got["doc_id"] == doc].sort_values("piece")
        assert own["piece"].tolist() == [*range(len(own))] and own["length"].sum() == ids.size
        assert own["start"].tolist() == [0, *own["length"].cumsum()[:-1]] and (own["length"][1:] == 1024).all()
        assert own["ids_crc32"].tolist() == [zlib.crc32(ids[s : s + n].tobytes()) for s, n in zip(own["start"], own["length"], strict=True)]
    for _, held in got.sort_values("offset").groupby("sequence_id"):
        assert held["offset"].tolist() == [0, *held["length"].cumsum()[:-1]] and held["length"].sum() <= 1024
    assert set(got["doc_id"]) == set(texts)


def test_op3(spark, texts):
    got = queries.op3_secret_scan(spark, SF).toPandas().set_index("doc_id")
    assert sorted(got.index) == sorted(texts)
    for doc, text in texts.items():
        want, row = plainly(text), got.loc[doc]
        assert row["base_sha256"] == hashlib.sha256(",".join(want).encode()).hexdigest()
        assert [row[f"n_{k}"] for k in secrets.KINDS] == [sum(s.startswith(k + ":") for s in want) for k in secrets.KINDS]
        assert [s for s in row["spans"].split(",") if s and not s.startswith("random:")] == want
        for span in row["spans"].split(","):
            if span.startswith("random:"):
                _, a, b = span.split(":")
                assert re.fullmatch(r"[A-Za-z0-9+/_=-]{20,}", text[int(a) : int(b)])


def fingerprint(text):
    from xxhash import xxh64_intdigest

    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text))
    hashes = np.array([xxh64_intdigest(" ".join(words[k : k + 4]).encode(), 42) for k in range(max(1, len(words) - 3))] if words else [], np.uint64)
    return sum((2 * int((hashes >> np.uint64(b) & np.uint64(1)).sum()) > hashes.size) << b for b in range(64))


def test_op4(spark, texts):
    got = queries.op4_simhash_near_dedup(spark, SF).toPandas().set_index("doc_id")
    fps = {d: fingerprint(t) for d, t in texts.items()}
    linked = [(a, b) for a in fps for b in fps if a < b and (fps[a] ^ fps[b]).bit_count() <= 4]
    assert got["component_id"].to_dict() == components(fps, linked)
    assert got["fingerprint"].to_dict() == {d: f"{f:016x}" for d, f in fps.items()}


def test_op6(spark, texts):
    got = queries.op6_language_id(spark, SF).toPandas().set_index("doc_id")
    docs = pq.read_table(f"{SF}/documents.parquet").to_pandas().set_index("doc_id")
    held = pd.Series(fold(got.index, 4) == 2, got.index)
    assert (got["held_out"] == held).all() and got["score"].between(0, 1).all()
    learned = set(docs["lang"][~held.reindex(docs.index)].dropna())
    for doc, text in texts.items():
        assert got.loc[doc, "lang_pred"] in (learned if langid.has_letter(text) else {"und"})
    known = got[held & docs["lang"].reindex(got.index).notna() & (got["lang_pred"] != "und")]
    assert (known["lang_pred"] == docs["lang"].reindex(known.index)).mean() > 0.9


def test_op7(spark, texts):
    got = queries.op7_lm_scoring(spark, SF).toPandas().set_index("doc_id")
    held = dict(zip(texts, fold(texts, 7) == 2, strict=True))
    tokens = {d: [*(re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t))), ""] for d, t in texts.items()}
    counts = pd.Series([w for d, ws in tokens.items() if not held[d] for w in ws]).value_counts()
    n, v = int(counts.sum()), len(counts)
    for doc, ws in tokens.items():
        c, row = np.array([counts.get(w, 0) for w in ws]), got.loc[doc]
        assert (row["held_out"], row["n_tokens"], row["n_known"], row["train_tokens"]) == (held[doc], len(ws), (c > 0).sum(), n)
        assert abs(row["base_score"] - np.log10((c + 1) / (n + v + 1)).sum()) < 1e-6 * len(ws)
    assert (got["score"] < 0).all() and np.allclose(got["perplexity"], 10 ** (-got["score"] / got["n_tokens"]))


def test_op8(spark, texts):
    from tokenizers import Tokenizer

    got = queries.op8_wavelet_matrix(spark, SF).toPandas().set_index("doc_id")
    tokenizer, start = Tokenizer.from_file(queries.tokenizer_path("word_bpe_49k.json")), 0
    for doc, text in texts.items():
        ids = np.array([*tokenizer.encode(text, add_special_tokens=False).ids, 1], "<u4")
        assert tuple(got.loc[doc, ["start", "n_tokens", "ids_crc32"]]) == (start, ids.size, zlib.crc32(ids.tobytes()))
        start += ids.size


def test_op9(spark):
    assert queries.URL_RULES == RULES
    pages = pq.read_table(f"{SF}/pages.parquet").to_pandas()
    got = queries.op9_url_filters(spark, SF).toPandas().set_index("page_id")
    for page, url in zip(pages["page_id"], pages["url"], strict=True):
        rest = url.split("://", 1)[1] if url and "://" in url else ""
        host, path = re.match(r"[^/?#]*", rest)[0], re.match(r"[^/?#]*([^?#]*)", rest)[1]
        host = re.sub("[A-Z]", lambda m: m[0].lower(), host)
        fits = [r for r in RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
        best = max(fits, key=lambda r: len(r.host + r.path), default=None)
        row = got.loc[page]
        assert (row["host"], row["path"], row["rule"]) == (host, path, best and best.host + best.path)
        assert row["verdict"] == best.action if best else row["verdict"] in ("allow", "block")


def test_op10(spark, texts):
    got = queries.op10_document_fingerprints(spark, SF).toPandas().set_index("doc_id")
    ids, prints = list(texts), {}
    for k, doc in enumerate(ids):
        text, following = texts[doc], texts[ids[(k + 1) % len(ids)]]
        n = len(text) // 2
        changed, row = text[: len(text) - n] + following[:n], got.loc[doc]
        assert (row["n_chars"], row["edited_sha256"]) == (len(text), hashlib.sha256(changed.encode()).hexdigest())
        assert 0 <= row["near_edited"] <= 1 and 0 <= row["near_next"] <= 1
        assert prints.setdefault(text, row["fingerprint"]) == row["fingerprint"]
    assert len(set(prints.values())) == len(prints)


def test_op2_and_op5_return_integer_ids(spark, texts):
    found = queries.op2_benchmark_decontamination(spark, SF).toPandas()
    items = dict(zip(*pq.read_table(f"{SF}/benchmark.parquet").to_pydict().values(), strict=True))
    plain = {(d, i) for d, t in texts.items() for i, x in items.items() if " ".join(x.lower().split())[:80] in " ".join(t.lower().split())}
    assert plain and plain <= set(zip(found["doc_id"], found["item_id"], strict=True))
    spans = queries.op5_substring_dedup(spark, SF).toPandas()
    seen = {}
    for d, t in texts.items():
        ws = t.lower().split()
        for k in range(len(ws) - 49):
            seen.setdefault(" ".join(ws[k : k + 50]), set()).add(d)
    assert {d for ds in seen.values() if len(ds) > 1 for d in ds} <= set(spans["doc_id"])


def test_pipeline_stages_on_a_table(spark, texts):
    """Near-dedup leaves one of each class of what language ID kept; the later stages keep clean documents."""
    import corpus_pipeline

    docs, kept = spark.read.parquet(f"{SF}/documents.parquet"), {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.common.settle(stage(spark, docs, SF), name)
        kept[name] = {r["doc_id"]: r["text"] for r in docs.collect()}
    first = kept["language_id"]
    assert set(kept["simhash_near_dedup"]) == {d for d, least in similar_classes(sorted(first.items())).items() if d == least}
    assert len(first) > 0.9 * len(texts) and all(shingled(t) for t in first.values())
    leaks = {r["doc_id"] for r in queries.op2_benchmark_decontamination(spark, SF).select("doc_id").collect()}
    assert set(kept["benchmark_decontamination"]) == set(kept["simhash_near_dedup"]) - leaks
    assert set(kept["secret_scans"]) == set(kept["benchmark_decontamination"])
    assert not any(plainly(t) for t in kept["secret_scans"].values())


def test_pipeline_takes_odd_tables(spark, tmp_path, vocabulary):
    """Null ids and texts, an id with two texts, whole rows twice, empty tables, and columns named like the stages' own."""
    import corpus_pipeline

    prose = " ".join(f"w{k % 7}a and the b{k % 5} of" for k in range(60))
    rows = [(1, prose, "en"), (None, prose + " more of it", "en"), (None, "another text and the of", "en"), (2, "one two of the and", "en"), (2, "six seven of the and", "en"), (2, "six seven of the and", "en"), (3, None, None), (4, "", "en")]
    odd = spark.createDataFrame([(*r, "s", 1, 7, "h", True, "k") for r in rows], "doc_id long, text string, lang string, source string, n_chars long, key long, hash string, first boolean, _id string")
    spark.createDataFrame([(1, "no such passage in these few texts at all")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    stages = dict(corpus_pipeline.STAGES)
    left = stages["simhash_near_dedup"](spark, odd, str(tmp_path))
    assert left.columns == odd.columns
    assert sorted(((r["doc_id"] or -1, r["text"] or "") for r in left.collect())) == sorted([(-1, "another text and the of"), (1, prose), (2, "one two of the and"), (2, "six seven of the and"), (3, "")])
    for name in ("benchmark_decontamination", "secret_scans"):
        after = stages[name](spark, odd, str(tmp_path))
        assert after.columns == odd.columns and after.count() == len(rows)
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, odd.limit(0), str(tmp_path)).count() == 0, name
