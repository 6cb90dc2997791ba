"""Language identification by multilingual mixture inference.

A text is taken as a mixture of languages. Each word has a likelihood under each language, the product of its letter
trigrams' probabilities (a letter with its neighbours, hashed to ``BUCKETS`` cells, learned with add-``SMOOTH`` smoothing).
Expectation-maximisation estimates the text's language proportions; starting from all languages, the smallest share is
dropped and the rest fitted again as long as the penalised likelihood (BIC) gets better. The largest share is predicted.

Learning uses at most about ``per_language`` documents of each language, chosen by a hash of their ids (a bound on the
sample; languages are counted over all). The model has languages times BUCKETS cells (half a MB a language); it is made on the
driver, and refused beyond ``MOST_LANGUAGES`` languages.

Edge cases
    Null text, and text without a letter, is ``und`` with score 0 and empty proportions; so is every text if nothing could be
    learned. Ties go to the first language in order. Null lang teaches nothing. Rows with null doc_id are predicted, not learned
    from. Repeated rows are learned from and predicted each. Very long texts are read whole, one at a time. An empty table teaches
    nothing and gives an empty result. Further columns are ignored, whatever their names.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import few_rows, map_arrow, ship, sliced

ship(__name__)

BUCKETS = 1 << 16
SMOOTH = 0.5
ROUNDS = 30
MOST_LANGUAGES = 500


def letters() -> np.ndarray:
    """Packed bits: which code points are letters."""
    return np.packbits(np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000))


def cells(text: str, is_letter: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The cell of each letter's trigram, and the places in them at which words begin."""
    code = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    mask = is_letter[code]
    padded = np.zeros(len(code) + 2, np.uint32)
    padded[1:-1] = np.where(mask, code, 0)
    h = padded[:-2] * np.uint32(0x9E3779B1) ^ padded[1:-1] * np.uint32(0x85EBCA77) ^ padded[2:] * np.uint32(0xC2B2AE3D)
    h = (h ^ (h >> np.uint32(15))) * np.uint32(0x27D4EB2F)
    at = np.flatnonzero(mask)
    return (h[at] >> np.uint32(16)).astype(np.int64), np.flatnonzero(np.r_[True, np.diff(at) > 1]) if len(at) else at


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def learn(docs: DataFrame, per_language: int = 2000) -> tuple[list[str], np.ndarray]:
    """The languages in order, and log probabilities (BUCKETS x languages) of cells. docs: doc_id, text, lang to learn from."""
    known = docs.select("doc_id", "text", "lang").filter("lang IS NOT NULL AND text IS NOT NULL AND doc_id IS NOT NULL")
    rates = known.groupBy("lang").agg((F.lit(float(per_language)) / F.count(F.lit(1))).alias("rate"))
    if not few_rows(rates, MOST_LANGUAGES):
        raise ValueError(f"more than {MOST_LANGUAGES} languages")
    sample = known.join(F.broadcast(rates), "lang").filter(F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) < F.col("rate") * 1_000_000)
    table = letters()

    def count(batches):
        is_letter = np.unpackbits(table)[:0x110000].view(bool)
        for b in sliced(batches, most=4 << 20):
            langs, texts = b.column("lang").to_pylist(), b.column("text").to_pylist()
            for lang in sorted(set(langs)):
                total = np.bincount(np.concatenate([cells(t, is_letter)[0] for l, t in zip(langs, texts, strict=True) if l == lang]), minlength=BUCKETS)
                used = np.flatnonzero(total)
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(used), pa.string()), pa.array(used), pa.array(total[used])], names=["lang", "cell", "n"])

    got = map_arrow(sample.select("lang", "text"), count, "lang string, cell long, n long").groupBy("lang", "cell").agg(F.sum("n").alias("n")).toArrow()
    names = sorted(set(got.column("lang").to_pylist()))
    place = {name: k for k, name in enumerate(names)}
    counts = np.full((BUCKETS, len(names)), SMOOTH)
    if names:
        counts[got.column("cell").to_numpy(), np.array([place[x] for x in got.column("lang").to_pylist()])] += got.column("n").to_numpy()
    return names, np.log(counts / counts.sum(axis=0)).astype(np.float32) if names else counts.astype(np.float32)


def fit(likelihood: np.ndarray) -> tuple[np.ndarray, float]:
    """EM: proportions of the columns, and the log likelihood. likelihood: words x languages, each row at most 1."""
    share = np.full(likelihood.shape[1], 1 / likelihood.shape[1])
    for _ in range(ROUNDS):
        part = likelihood * share
        total = part.sum(axis=1, keepdims=True)
        new = (part / total).mean(axis=0)
        done = np.abs(new - share).max() < 1e-4
        share = new
        if done:
            break
    return share, float(np.log(likelihood @ share).sum())


def infer(word_logs: np.ndarray) -> dict[int, float]:
    """Proportions of the selected languages (columns) of a text's words."""
    like = np.exp(np.maximum(word_logs - word_logs.max(axis=1, keepdims=True), -60)).astype(np.float64)
    langs = np.arange(like.shape[1])
    share, ll = fit(like)
    price = np.log(max(len(like), 2))
    best = -2 * ll + (len(langs) - 1) * price
    while len(langs) > 1:
        out = len(share) - 1 - share[::-1].argmin()  # of equal ones the last
        # shares of nothing go at once
        rest = np.setdiff1d(np.flatnonzero(share >= 1e-3), [out]) if share[out] >= 1e-3 else np.flatnonzero(share >= 1e-3)
        s, ll = fit(like[:, langs[rest]])
        value = -2 * ll + (len(rest) - 1) * price
        if value > best:
            break
        langs, share, best = langs[rest], s, value
    return dict(zip(langs.tolist(), share.tolist(), strict=True))


def predict(docs: DataFrame, model: tuple[list[str], np.ndarray]) -> DataFrame:
    """One row per row of docs (doc_id, text): doc_id, held_out, lang_pred, score, proportions (language to share)."""
    names, logs = model
    sent = docs.sparkSession.sparkContext.broadcast((names, logs, letters()))

    def run(batches):
        names, logs, table = sent.value
        is_letter = np.unpackbits(table)[:0x110000].view(bool)
        for b in sliced(batches):
            out = []
            for text in b.column("text").to_pylist():
                cell, start = cells(text or "", is_letter)
                if not len(cell) or not names:
                    out.append(("und", 0.0, []))
                    continue
                shares = infer(np.add.reduceat(logs[cell], start, axis=0))
                k = max(shares, key=lambda x: (shares[x], -x))
                out.append((names[k], min(1.0, shares[k]), [(names[x], v) for x, v in shares.items()]))
            cols = list(zip(*out)) or [[], [], []]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("held_out"), pa.array(cols[0], pa.string()), pa.array(cols[1], pa.float64()), pa.array(cols[2], pa.map_(pa.string(), pa.float64()))], names=["doc_id", "held_out", "lang_pred", "score", "proportions"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return map_arrow(docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "text"), run, f"doc_id {kind}, held_out boolean, lang_pred string, score double, proportions map<string,double>")
