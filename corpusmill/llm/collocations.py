"""Phrase collocations: n-grams of every language as rows, counted by hash aggregates, scored by their weakest cut.

Texts are cut at punctuation and line ends into pieces; all n-grams of 1 to ``longest`` words within pieces become rows with
their counts in a slice of text, which Spark adds up by language and phrase. A phrase that occurs ``least`` times has no part that
occurs less often, so words are counted first, then the pairs of words that reach ``least``, then longer phrases all of whose pairs
reach it: exactly the phrases that can't be candidates or parts of one are left out. Which words and pairs reach it is told by a
filter of ``FILTER_BITS`` bits, whatever the size of the corpus: it may let rarer ones through, never holds a frequent one back.

Each cut of a candidate is joined with the counts of its two parts; the score is 2,000,000 a / (l + r) in whole decimal numbers.
A candidate falls if a one-word extension has at least ``contained`` percent of its count: longer ones need no look, as the
extension between has at least the count of the longer one. Ranks are taken in two steps, so that no task holds a language.

Edge cases
    Null text has no words, a null lang is ``und`` (together with a lang of that name). Repeated documents count each time; doc_id
    plays no part. Ties of cuts go to the smallest first part, ties of rank to the larger count, then to the first phrase in byte
    order. An empty table gives an empty result. Very long texts are taken whole, in chunks that end where a piece does. Further
    columns are ignored, whatever their names.
"""

from __future__ import annotations

import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import SALTS, few_rows, join_dimension, map_arrow, materialise, ship, sliced

ship(__name__)

#: Bits of the filter of frequent words or pairs: 4 MB.
FILTER_BITS = 1 << 25
#: Bytes of text whose words are numbered at a time (a longer piece alone).
CHUNK = 4 << 20
#: Sets the checksums of a pair's words apart.
SPREAD = 1_000_003
#: Phrases whose counts are broadcast at most.
BROADCAST_PHRASES = 100_000
#: Ends a phrase in a key: it can't stand in a phrase.
STOP = "."
UNKNOWN = "und"
_FROM = bytes(range(65, 91)) + b".,;:!?\x0a\x0b\x0c\x0d\x09"
_TO = bytes(range(97, 123)) + b"." * 10 + b" "
LOWER = bytes.maketrans(_FROM, _TO)
SCHEMA = pa.schema([("lang", pa.string()), ("phrase", pa.string()), ("size", pa.int32()), ("n", pa.int64())])
SQL_SCHEMA = "lang string, phrase string, size int, n long"


def key(lang: Column, phrase: Column) -> Column:
    return F.concat(phrase, F.lit(STOP), lang)


def _chunks(data: bytes):
    """Parts of at most CHUNK bytes, or one piece."""
    lo = 0
    while lo < len(data):
        hi = len(data)
        if hi - lo > CHUNK:
            hi = data.rfind(b".", lo, lo + CHUNK)
            hi = hi if hi >= 0 else data.find(b".", lo + CHUNK)
            hi = len(data) if hi < 0 else hi
        yield data[lo:hi]
        lo = hi + 1


def _numbered(data: bytes) -> tuple[pa.Array, np.ndarray]:
    """The distinct words, number 0 being the end of a piece, and the text as numbers."""
    marked = pa.array([b". " + data.replace(b".", b" . ").strip()], pa.large_binary()).cast(pa.large_string())
    coded = pc.ascii_split_whitespace(marked).flatten().dictionary_encode()
    return coded.dictionary, coded.indices.to_numpy()


def _sums(words: pa.Array) -> np.ndarray:
    """The checksum of each word."""
    return np.fromiter((zlib.crc32(w) for w in words.cast(pa.large_binary()).to_pylist()), np.int64, len(words))


class Frequent:
    """A filter of words or pairs of words of a language that says yes to all that were put in."""

    def __init__(self, bits: np.ndarray):
        self.bits = bits

    def has(self, lang: str, *sums: np.ndarray) -> np.ndarray:
        """For the checksums of the words: one array for words, two for pairs."""
        at = (sum(s * SPREAD**k for k, s in enumerate(sums)) + zlib.crc32(lang.encode("utf-8"))) % (len(self.bits) * 8)
        return (self.bits[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1

    @classmethod
    def build(cls, counts: DataFrame, size: int, bits: int) -> Frequent:
        """From a frame of lang and phrase (of ``size`` words): at most bits / 8 bytes reach the driver."""
        w = F.split("phrase", " ")
        bit = (sum((F.crc32(w[k]) * SPREAD**k for k in range(size)), F.lit(0)) + F.crc32("lang")) % bits + 1
        maps = counts.select(F.bitmap_bucket_number(bit).alias("bucket"), F.bitmap_bit_position(bit).alias("bit")).groupBy("bucket").agg(F.bitmap_construct_agg("bit").alias("map"))
        whole = np.zeros(max(bits // 8, 4096), np.uint8)
        for bucket, part in maps.toLocalIterator():
            whole[(bucket - 1) * 4096 : bucket * 4096] = np.frombuffer(bytes(part), np.uint8)
        return cls(whole[: bits // 8])


def _rows(lang: str, phrases: pa.Array, size: int, n: np.ndarray):
    """Batches of counts, of 20,000 rows."""
    for lo in range(0, len(phrases), 20_000):
        part = phrases.slice(lo, 20_000).cast(pa.string())
        k = len(part)
        yield pa.RecordBatch.from_arrays([pa.repeat(pa.scalar(lang, pa.string()), k), part, pa.repeat(pa.scalar(size, pa.int32()), k), pa.array(n[lo : lo + k], pa.int64())], schema=SCHEMA)


def _grams(lang: str, data: bytes, level: int, longest: int, words: Frequent | None, pairs: Frequent | None):
    """Counts of a chunk's n-grams: words (level 1), pairs of frequent words (2), longer ones of frequent pairs (3)."""
    known, ids = _numbered(data)
    ids = ids.astype(np.int64)
    if len(known) == 1:
        return
    if level == 1:
        n = np.bincount(ids, minlength=len(known))[1:]
        yield from _rows(lang, pa.concat_arrays([pa.array([""], pa.large_string()), known.slice(1)]), 1, np.concatenate([[n.sum()], n]))
        return
    sums = _sums(known)
    frequent = words.has(lang, sums) & (np.arange(len(known)) > 0)
    joined = lambda left, right: pc.binary_join_element_wise(left, right, pa.scalar(" ", pa.large_string()))
    # a pair's number at its first word; the last is no pair
    at = np.flatnonzero(frequent[ids[:-1]] & frequent[ids[1:]])
    codes, number, n = np.unique(ids[at] * len(known) + ids[at + 1], return_inverse=True, return_counts=True)
    first, second = codes // len(known), codes % len(known)
    if level == 2:
        yield from _rows(lang, joined(known.take(first), known.take(second)), 2, n)
        return
    pair = np.full(len(ids), -1, np.int64)
    pair[at] = np.where(pairs.has(lang, sums[first], sums[second])[number], number, -1)
    # phrases of more words, by number: one of the last length and the pair that overlaps it by a word
    of, labels = pair, joined(known.take(first), known.take(second))
    for size in range(3, longest + 1):
        ahead = np.concatenate([pair[size - 2 :], np.full(min(size - 2, len(pair)), -1)])
        at = np.flatnonzero((of >= 0) & (ahead >= 0))
        codes, number, n = np.unique(of[at] * max(len(first), 1) + ahead[at], return_inverse=True, return_counts=True)
        labels = joined(labels.take(codes // max(len(first), 1)), known.take(second[codes % max(len(first), 1)]))
        yield from _rows(lang, labels, size, n)
        of = np.full(len(ids), -1, np.int64)
        of[at] = number


def _count(docs: DataFrame, level: int, longest: int, words: Frequent | None = None, pairs: Frequent | None = None) -> DataFrame:
    """lang, phrase, size, n of one level over all documents; at level 1 the phrase '' holds the number of words."""

    def tally(batches):
        for b in sliced(batches, most=CHUNK):
            texts = defaultdict(list)
            for lang, text in zip(b.column("lang").to_pylist(), b.column("text").to_pylist(), strict=True):
                texts[lang].append(text.encode("utf-8").translate(LOWER))
            for lang, parts in texts.items():
                for chunk in _chunks(b".".join(parts)):
                    yield from _grams(lang, chunk, level, longest, words, pairs)

    rows = map_arrow(docs.select(F.coalesce("lang", F.lit(UNKNOWN)).alias("lang"), F.coalesce("text", F.lit("")).alias("text")), tally, SQL_SCHEMA)
    return rows.groupBy("lang", "phrase", "size").agg(F.sum("n").alias("n"))


def frequent_phrases(docs: DataFrame, longest: int, least: int, filter_bits: int = FILTER_BITS) -> tuple[DataFrame, DataFrame]:
    """All phrases of 1 to ``longest`` words that occur at least ``least`` times (lang, phrase, size, n), and each language's words (lang, n)."""
    first = materialise(_count(docs, 1, longest).filter((F.col("n") >= least) | (F.col("phrase") == "")))
    levels = [first.filter(F.col("phrase") != "")]
    if longest >= 2:
        words = Frequent.build(levels[0], 1, filter_bits)
        levels.append(materialise(_count(docs, 2, longest, words).filter(F.col("n") >= least)))
    if longest >= 3:
        pairs = Frequent.build(levels[1], 2, filter_bits)
        levels.append(materialise(_count(docs, 3, longest, words, pairs).filter(F.col("n") >= least)))
    found = levels[0]
    for x in levels[1:]:
        found = found.unionByName(x)
    return found, first.filter(F.col("phrase") == "").select("lang", "n")


def _part(words: str, lo, length) -> Column:
    return F.array_join(F.slice(words, lo, length), " ")


def scored(found: DataFrame, scale: int = 2_000_000, broadcast_phrases: int = BROADCAST_PHRASES) -> DataFrame:
    """Candidates with their lowest cut: lang, phrase, size, a, l, r, score."""
    few = few_rows(found, broadcast_phrases)
    cuts = found.filter("size >= 2").select("lang", "phrase", "size", F.col("n").alias("a"), F.split("phrase", " ").alias("w"), F.explode(F.sequence(F.lit(1), F.col("size") - 1)).alias("k"))
    cuts = cuts.select("lang", "phrase", "size", "a", "k", key(F.col("lang"), _part("w", 1, F.col("k"))).alias("head"), key(F.col("lang"), _part("w", F.col("k") + 1, F.col("size") - F.col("k"))).alias("rest"))
    parts = found.select(key(F.col("lang"), F.col("phrase")).alias("part"), "n")
    cuts = join_dimension(cuts, parts.select(F.col("part").alias("head"), F.col("n").alias("l")), "head", few)
    cuts = join_dimension(cuts, parts.select(F.col("part").alias("rest"), F.col("n").alias("r")), "rest", few)
    # products may pass 64 bits; ``div`` of decimals is exact and drops the fraction
    exact = F.expr(f"cast({scale} * cast(a as decimal(19,0)) div (cast(l as decimal(19,0)) + cast(r as decimal(19,0))) as bigint)")
    low = cuts.groupBy("lang", "phrase", "size", "a").agg(F.min(F.struct(exact.alias("score"), "k", "l", "r")).alias("cut"))
    return low.select("lang", "phrase", "size", "a", "cut.l", "cut.r", "cut.score")


def _alone(candidates: DataFrame, contained: int) -> DataFrame:
    """Candidates without a one-word extension of at least ``contained`` percent of their count."""
    w = F.split("phrase", " ")
    longer = candidates.filter("size >= 3").select("lang", F.col("a").alias("most"), F.explode(F.array(F.array_join(F.slice(w, 1, F.col("size") - 1), " "), F.array_join(F.slice(w, 2, F.col("size") - 1), " "))).alias("phrase"))
    longer = longer.groupBy("lang", "phrase").agg(F.max("most").alias("most"))
    c, x = candidates.alias("c"), longer.alias("x")
    within = (F.col("c.lang") == F.col("x.lang")) & (F.col("c.phrase") == F.col("x.phrase")) & (F.col("x.most").cast("decimal(22,0)") * 100 >= F.col("c.a").cast("decimal(22,0)") * contained)
    # no broadcast: packed files of phrases look small
    return c.join(x.hint("merge"), within, "left_anti")


def mine(docs: DataFrame, longest: int = 4, least: int = 30, contained: int = 80, most: int = 2000, filter_bits: int = FILTER_BITS, broadcast_phrases: int = BROADCAST_PHRASES) -> DataFrame:
    """The first ``most`` collocations of each language of docs (text, lang): lang, rank, phrase, a, l, r, n, score."""
    found, totals = frequent_phrases(docs, longest, least, filter_bits)
    kept = _alone(materialise(scored(found, broadcast_phrases=broadcast_phrases)), contained)
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    # each part of a language first, so that its last step ranks a bounded number of rows
    part = Window.partitionBy("lang", F.pmod(F.xxhash64("phrase"), F.lit(SALTS))).orderBy(*order)
    best = kept.withColumn("rank", F.row_number().over(part)).filter(F.col("rank") <= most)
    ranked = best.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")).filter(F.col("rank") <= most)
    return ranked.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
