"""Language identification by the nearest of several centroids per language.

A text becomes a vector of hashed character 1- to 3-grams (lower case, runs of
other characters than letters as one space), weighted by 1 + log(count) times
inverse document frequency, of length one.  Each language has a few centroids
from spherical k-means over labelled texts; a text gets the language of the
centroid with the largest cosine, and is rejected when even that one is
farther than any but very odd training texts of the language are.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common
from .wordcoder import chunks

#: Hashed n-grams, centroids per language, and rounds of k-means.
BINS = 1 << 12
CENTROIDS = 4
ROUNDS = 10
#: The documented bound of the fit: about so many labelled texts per language, those whose ids hash lowest.
SAMPLE = 500
#: A text is rejected below this share of the cosine that 99 % of a language's training texts reach.  Random letters and unseen languages reach up to about 0.37, short clean texts 0.5 and more.
REJECT = 0.45
UNKNOWN = "und"

_letters = np.zeros(1 << 16, bool)
_letters[[c for c in range(1 << 16) if chr(c).isalpha()]] = True


def has_letter(text: str) -> bool:
    return any(c.isalpha() for c in text)


def counts(texts: list[str]) -> np.ndarray:
    """A row of n-gram counts per text."""
    joined = "\x00".join(["", *(x.lower() for x in texts), ""])
    code = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
    # A lower-cased text holds no U+0000 of its own to be taken for a border but by chance; borders are counted, so replace those.
    if joined.count("\x00") != len(texts) + 1:
        return counts([x.replace("\x00", " ") for x in texts])
    border = code == 0
    letter = np.where(code < 1 << 16, _letters[np.minimum(code, 0xFFFF)], True)
    keep = letter | border
    keep[1:] |= letter[:-1]  # the first of a run of others stays, as a space
    code, letter, border = np.where(letter, code, 32)[keep].astype(np.uint64), letter[keep], border[keep]
    doc = np.cumsum(border) - 1
    out = np.zeros(len(texts) * BINS + 1, np.int64)
    mixed, inside = np.zeros(code.size, np.uint64), ~border
    for n in range(1, 4):
        shifted = code if n == 1 else np.append(code[n - 1 :], np.zeros(n - 1, np.uint64))
        mixed = (mixed + shifted + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
        inside &= True if n == 1 else np.append(~border[n - 1 :], np.zeros(n - 1, bool))
        some = inside & letter if n == 1 else inside
        at = doc[some] * BINS + (mixed[some] >> np.uint64(52)).astype(np.int64)
        out += np.bincount(at, minlength=out.size)
    return out[:-1].reshape(len(texts), BINS)


def vectors(table: np.ndarray, idf: np.ndarray) -> np.ndarray:
    weighted = np.log1p(table, dtype=np.float32) * idf
    norm = np.linalg.norm(weighted, axis=1, keepdims=True)
    return weighted / np.where(norm > 0, norm, 1)


def clusters(rows: np.ndarray, k: int, rounds: int = ROUNDS) -> np.ndarray:
    """Spherical k-means from far-apart starts; no chance is involved."""
    centre = rows.mean(0)
    near, chosen = rows @ centre, []
    for _ in range(min(k, len(rows))):
        chosen.append(int(near.argmin() if chosen else near.argmax()))
        near = np.maximum(near, rows @ rows[chosen[-1]]) if len(chosen) > 1 else rows @ rows[chosen[-1]]
    centres = rows[chosen]
    for _ in range(rounds):
        own = (rows @ centres.T).argmax(1)
        sums = np.stack([rows[own == j].sum(0) for j in range(len(centres)) if (own == j).any()])
        norm = np.linalg.norm(sums, axis=1, keepdims=True)
        centres = sums / np.where(norm > 0, norm, 1)
    return centres


class Model:
    """Centroids with their languages and least cosines."""

    def __init__(self, idf: np.ndarray, centres: np.ndarray, langs: list[str], least: np.ndarray) -> None:
        self.idf, self.centres, self.langs, self.least = idf, centres, langs, least

    def predict(self, texts: list[str | None]) -> list[tuple[str, float, bool]]:
        """(language, score, rejected) of each text."""
        out: list[tuple[str, float, bool]] = [(UNKNOWN, 0.0, True)] * len(texts)
        some = [k for k, x in enumerate(texts) if x and has_letter(x)] if self.langs else []
        for a, b in _runs([texts[k] for k in some]):
            cosine = vectors(counts([texts[k] for k in some[a:b]]), self.idf) @ self.centres.T
            best = cosine.argmax(1)
            for k, j, score in zip(some[a:b], best.tolist(), cosine[np.arange(b - a), best].tolist(), strict=True):
                out[k] = self.langs[j], min(1.0, max(0.0, score)), score < self.least[j]
        return out


def _runs(texts: list[str], most: int = 128):
    for a, b in chunks(texts, 1 << 18):
        for k in range(a, b, most):
            yield k, min(b, k + most)


def fit(docs: DataFrame, training: Column, sample: int = SAMPLE) -> Model:
    """Learns from text and lang where `training` holds, both are there and the text has a letter.

    Of a language with more than `sample` labelled rows, those are taken whose
    hashed doc_id falls under the share that makes about `sample`; the counts
    that set the share cover all rows.
    """
    spark = docs.sparkSession
    labelled = docs.where(training & F.col("lang").isNotNull() & F.col("text").isNotNull())
    sizes = {r["lang"]: r["count"] for r in labelled.groupBy("lang").count().collect()}
    if not sizes:
        return Model(np.ones(BINS, np.float32), np.zeros((0, BINS), np.float32), [], np.zeros(0))
    parts = 1 << 40
    share = F.create_map(*[x for lang, n in sizes.items() for x in (F.lit(lang), F.lit(min(parts, parts * sample // n)))])
    chosen = labelled.where(F.pmod(F.xxhash64("doc_id"), F.lit(parts)) < share[F.col("lang")]).select("lang", "text")

    def count(batches):
        for batch in batches:
            langs, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for a, b in _runs(texts):
                some = [k for k in range(a, b) if has_letter(texts[k])]
                if some:
                    table = counts([texts[k] for k in some]).astype("<u4")
                    yield pa.RecordBatch.from_arrays([pa.array([langs[k] for k in some]), pa.array([_sparse(row) for row in table], pa.binary())], ["lang", "counts"])

    found = common.settle(chosen.mapInArrow(common.tidily(count), "lang string, counts binary"), "langid")

    def frequencies(batches):
        total, n = np.zeros(BINS, np.int64), 0
        for batch in batches:
            for data in batch.column(1).to_pylist():
                total[_dense(data) > 0] += 1
                n += 1
        yield pa.RecordBatch.from_arrays([pa.array([n], pa.int64()), pa.array([total.tobytes()], pa.binary())], ["n", "total"])

    got = found.mapInArrow(frequencies, "n long, total binary").collect()
    n = sum(r["n"] for r in got)
    df = sum((np.frombuffer(r["total"], np.int64) for r in got), np.zeros(BINS, np.int64))
    idf = np.log((1 + n) / (1 + df)).astype(np.float32) + np.float32(0.1)

    def learn(pdf: pd.DataFrame) -> pd.DataFrame:
        rows = vectors(np.stack([_dense(x) for x in sorted(pdf["counts"])]), idf)
        centres = clusters(rows, CENTROIDS)
        least = REJECT * float(np.quantile((rows @ centres.T).max(1), 0.01))
        return pd.DataFrame({"lang": pdf["lang"].iloc[0], "centre": [c.astype("<f4").tobytes() for c in centres], "least": least})

    learned = found.groupBy("lang").applyInPandas(learn, "lang string, centre binary, least double").orderBy("lang", "centre").collect()
    centres = np.stack([np.frombuffer(r["centre"], "<f4") for r in learned])
    return Model(idf, centres, [r["lang"] for r in learned], np.array([r["least"] for r in learned]))


def _sparse(row: np.ndarray) -> bytes:
    at = np.flatnonzero(row)
    return at.astype("<u2").tobytes() + row[at].astype("<u4").tobytes()


def _dense(data: bytes) -> np.ndarray:
    n, out = len(data) // 6, np.zeros(BINS, np.float32)
    out[np.frombuffer(data, "<u2", n)] = np.frombuffer(data, "<u4", n, 2 * n)
    return out


def identify(docs: DataFrame, training: Column | None = None, sample: int = SAMPLE) -> DataFrame:
    """All columns of `docs` with lang_pred, score and rejected, from doc_id, text and lang.

    `und` with score 0, rejected: null and empty texts, texts without a letter,
    and all texts where no labelled text was there to learn from.  Repeated
    rows are each predicted; of clashing columns, ours replace the table's.
    """
    common.small_batches(docs.sparkSession)
    training = F.lit(True) if training is None else training
    model = docs.sparkSession.sparkContext.broadcast(fit(docs, training, sample))
    rest = docs.drop("lang_pred", "score", "rejected")
    schema = rest.schema.jsonValue()

    def run(batches):
        for batch in batches:
            found = model.value.predict(batch.column(batch.schema.get_field_index("text")).to_pylist())
            langs, scores, rejected = zip(*found, strict=True) if found else ((), (), ())
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(langs, pa.string()), pa.array(scores, pa.float64()), pa.array(rejected, pa.bool_())], [*batch.schema.names, "lang_pred", "score", "rejected"])

    from pyspark.sql.types import StructType

    return rest.mapInArrow(common.tidily(run), StructType.fromJson(schema).add("lang_pred", "string").add("score", "double").add("rejected", "boolean"))
