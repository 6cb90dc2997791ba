"""MinHash near-duplicates by a multi-index Hamming join.

A text's set of word shingles gets a signature of 64 MinHash symbols of 16 bits. Two sets of similarity j differ
in a Binomial(64, 1 - j) number of symbols. The signature is split into chunks; by the pigeonhole principle two
signatures that differ in at most ``2 * chunks - 1`` symbols have a chunk with at most one difference. Each chunk
is indexed under all its one-error variants (one symbol left out), so every pair under that distance shares a
bucket: none is lost. The chunk width is the largest at which a pair at the threshold exceeds the distance with
probability below 1e-5. Links are then confirmed on the full shingle sets.

How buckets are handled
    Equal sets are one class from the start, so copies never meet as pairs. In every bucket all members are
    first tested against its smallest id only (a star, linear in the bucket; buckets that a sample shows to be heavy are not
    dealt to one task but get that id by partial minima). Members of a bucket that the
    confirmed links have not yet brought into one component are then compared with their texts, across components
    only, in blocks of bounded size (members and shingles), by signature distance first: exact, without caps on buckets
    or partners. Only links that join components leave a task, so what is written stays linear in the group.
    Components come from alternating star contractions on the link table, until a step changes no row of it; nothing of
    it goes to the driver.

Edge cases
    Null, empty and word-less texts have an empty set, link with nothing and are kept. Texts with fewer words than a shingle have
    their whole sequence as the one shingle. Rows with null doc_id take no part: component_id null, kept. Rows that repeat a
    doc_id are one document whose every text counts. doc_id must be of a whole-number type (others are refused). Very long texts
    are read whole, one at a time. Ties don't arise: the smallest id stands for a group. An empty table gives an empty result.
    Further columns are ignored (``keep`` passes them through), whatever their names.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from .common import bounded_broadcast, cut_keys, join_cut, map_arrow, materialise, record_batches, release, ship, sliced

ship(__name__)

K = 64
MISS = 1e-5
#: Members of an unresolved bucket that one task compares with as many others.
BLOCK = 2048
#: Members from which a bucket (as a sample of one in HEAVY_SAMPLE classes tells) is heavy, and heavy buckets that are broadcast at most.
HEAVY, HEAVY_SAMPLE, MOST_HEAVY = 50_000, 64, 500_000
#: Shingles of a block (8 bytes each; a task holds two blocks).
BLOCK_SHINGLES = 1 << 21
#: Most ids that are broadcast to prefilter the texts (8 MB); more are joined by a shuffle.
BROADCAST_IDS = 500_000
LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))
_R = np.random.default_rng(20240229)
MULT, ADD = _R.integers(1, 2**63, K, dtype=np.uint64) * np.uint64(2) + np.uint64(1), _R.integers(0, 2**63, K, dtype=np.uint64)


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values."""
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(32))


def shingles(text: str | None, width: int) -> np.ndarray:
    """The distinct shingles of a text as sorted 64-bit hashes. A-Z are lower-cased; words end at ASCII white space."""
    words = (text or "").encode("utf-8", "surrogatepass").translate(LOWER).split()
    if not words:
        return np.empty(0, np.uint64)
    if len(words) < width:
        return np.array([xxhash.xxh3_64_intdigest(b" ".join(words))], np.uint64)
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    n = len(h) - width + 1
    acc = h[:n].copy()
    for k in range(1, width):
        acc = mix64(acc) + h[k : k + n]
    return np.unique(mix64(acc))


def signature(s: np.ndarray) -> np.ndarray:
    """K MinHash symbols of 16 bits of a non-empty set."""
    low = np.full(K, np.iinfo(np.uint64).max)
    for lo in range(0, len(s), 4096):
        low = np.minimum(low, (MULT[:, None] * s[None, lo : lo + 4096] + ADD[:, None]).min(axis=1))
    return (mix64(low) & np.uint64(0xFFFF)).astype(np.uint16)


def plan(threshold: int) -> tuple[int, int]:
    """Chunk width in symbols and the largest signature distance that is guaranteed, for a similarity in percent."""
    p = 1 - threshold / 100
    for width in (8, 7, 6, 5, 4, 3):
        most = 2 * math.ceil(K / width) - 1
        if sum(math.comb(K, d) * p**d * (1 - p) ** (K - d) for d in range(most + 1, K + 1)) <= MISS:
            return width, most
    return 2, K - 1


def bucket_keys(sigs: np.ndarray, width: int) -> np.ndarray:
    """All one-error chunk variants of each signature (rows), as 64-bit keys."""
    keys = []
    for c, lo in enumerate(range(0, K, width)):
        chunk = sigs[:, lo : lo + width].astype(np.uint64)
        for out in range(chunk.shape[1]):
            key = np.full(len(sigs), np.uint64(c * 16 + out + 1))
            for k in range(chunk.shape[1]):
                if k != out:
                    key = mix64(key) + chunk[:, k]
            keys.append(mix64(key))
    return np.stack(keys, axis=1) if len(sigs) else np.empty((0, 1), np.uint64)


def fingerprints(docs: DataFrame, width: int) -> DataFrame:
    """doc_id, n_shingles, set_hash (null for an empty set) and sig of every row."""
    out = T.StructType([T.StructField("doc_id", docs.schema["doc_id"].dataType), T.StructField("n_shingles", T.LongType()), T.StructField("set_hash", T.BinaryType()), T.StructField("sig", T.ArrayType(T.ShortType()))])

    def run(batches):
        for b in sliced(batches):
            ns, hashes, sigs = [], [], []
            for text in b.column("text").to_pylist():
                s = shingles(text, width)
                ns.append(len(s))
                hashes.append(xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None)
                sigs.append(signature(s).view(np.int16) if len(s) else None)
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(ns, pa.int64()), pa.array(hashes, pa.binary()), pa.array(sigs, pa.list_(pa.int16()))], names=out.names)

    return map_arrow(docs.select("doc_id", "text"), run, out)


def _sigs(column) -> np.ndarray:
    """An Arrow list column of K int16 as a matrix."""
    return column.flatten().to_numpy(zero_copy_only=False).view(np.uint16).reshape(-1, K)


def _buckets(classes: DataFrame, width: int) -> DataFrame:
    """key, pivot, id: the members of every bucket with several, beside its smallest id."""
    pairs = pa.schema([("key", pa.int64()), ("id", pa.int64())])
    found = pa.schema([("key", pa.int64()), ("pivot", pa.int64()), ("id", pa.int64())])

    def index(batches):
        for b in batches:
            if b.num_rows:
                ids = b.column("rep").to_numpy(zero_copy_only=False)
                keys = bucket_keys(_sigs(b.column("sig")), width).view(np.int64)
                yield from record_batches([keys.ravel(), np.repeat(ids, keys.shape[1])], pairs, 100_000)

    def scan(batches):
        last = None
        for b in batches:  # sorted by key and id: the first id of a run is its pivot
            if not b.num_rows:
                continue
            key, ident = (b.column(c).to_numpy() for c in ("key", "id"))
            new = np.r_[True, key[1:] != key[:-1]]
            start = np.flatnonzero(new)
            pivots = ident[start]
            if last is not None and last[0] == key[0]:
                pivots[0] = last[1]
            pivot = np.repeat(pivots, np.diff(np.r_[start, len(key)]))
            last = (key[-1], pivot[-1])
            member = ident != pivot
            yield from record_batches([key[member], pivot[member], ident[member]], found, 100_000)

    keyed = lambda part: map_arrow(part.select("rep", "sig"), index, "key long, id long")
    dealt = lambda rows: map_arrow(rows.repartition("key").sortWithinPartitions("key", "id"), scan, "key long, pivot long, id long")
    some = keyed(classes.filter(F.pmod(F.xxhash64("rep"), F.lit(HEAVY_SAMPLE)) == 0)).groupBy("key").count()
    heavy = materialise(some.filter(F.col("count") * HEAVY_SAMPLE >= HEAVY).select("key"))
    if not heavy.limit(1).count():
        return dealt(keyed(classes))
    # heavy buckets are never dealt to a task: their pivots are found by partial minima and sent to the members
    heavy = bounded_broadcast(heavy, MOST_HEAVY)
    inside = keyed(classes).join(heavy, "key", "left_semi")
    pivots = materialise(inside.groupBy("key").agg(F.min("id").alias("pivot")))
    hot = inside.join(bounded_broadcast(pivots, MOST_HEAVY), "key").filter("id != pivot").select("key", "pivot", "id")
    return hot.union(dealt(keyed(classes).join(heavy, "key", "left_anti")))


def _confirm(pairs: DataFrame, classes: DataFrame, docs: DataFrame, width: int, threshold: int, most: int) -> DataFrame:
    """The pairs (a, b), a written table, whose full sets are similar enough: first by size and signature, then on the texts.

    Many pairs may have one a, the smallest id of a large bucket: they are dealt to tasks of their own, each with its set.
    """
    side = lambda x: classes.select(F.col("rep").alias(x), F.col("n_shingles").alias(f"n_{x}"), F.col("sig").alias(f"s_{x}"))
    differ = F.size(F.filter(F.zip_with("s_a", "s_b", lambda x, y: x != y), lambda z: z))
    near = materialise(
        join_cut(pairs, side("a"), "a", "b", cut_keys(pairs, "a"))
        .join(side("b"), "b")
        .filter((F.least("n_a", "n_b") * 100 >= F.greatest("n_a", "n_b") * threshold) & (differ <= most))
        .select("a", "b")
        .distinct()
    )
    needed = bounded_broadcast(near.select(F.col("a").alias("doc_id")).union(near.select("b")).distinct(), BROADCAST_IDS)
    texts = docs.select("doc_id", "text").join(needed, "doc_id", "left_semi")
    both = near.join(texts.select(F.col("doc_id").alias("b"), F.col("text").alias("t_b")), "b")
    both = join_cut(both, texts.select(F.col("doc_id").alias("a"), F.col("text").alias("t_a")), "a", "b", cut_keys(near, "a"))

    def run(batches):
        last, left = None, None
        for b in sliced(batches, "t_b"):
            keep = []
            for ta, tb in zip(b.column("t_a").to_pylist(), b.column("t_b").to_pylist(), strict=True):
                if ta != last:
                    last, left = ta, shingles(ta, width)
                right = shingles(tb, width)
                inter = len(np.intersect1d(left, right, assume_unique=True))
                keep.append(100 * inter >= threshold * (len(left) + len(right) - inter) and inter > 0)
            yield b.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return materialise(map_arrow(both.select("a", "b", "t_a", "t_b"), run, "a long, b long").distinct())


def components(edges: DataFrame) -> DataFrame:
    """node, comp (its smallest reachable node) for the nodes of edges (a, b): alternating large-star and small-star steps.

    A node that many others are linked with is dealt to many tasks.
    """
    state = materialise(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u != v").distinct())
    size = state.count()
    while size:
        both = state.union(state.select("v", "u"))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = join_cut(both, low, "u", "v", cut_keys(both, "u")).filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u != v")
        large = materialise(large.distinct())
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = join_cut(large, least, "u", "v", cut_keys(large, "u")).select(F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"), F.col("m").alias("v")).filter("u != v")
        after = materialise(small.union(least.select("u", F.col("m").alias("v"))).distinct())
        last, (state, size) = (state, size), (after, after.count())
        # both are sets: of equal size and without a new row they are the same
        if size == last[1] and not state.join(last[0], ["u", "v"], "left_anti").limit(1).count():
            break
    return state.select(F.col("u").alias("node"), F.col("v").alias("comp")).union(state.select("v", "v").distinct())


def _cross_links(members: DataFrame, comps: DataFrame, classes: DataFrame, docs: DataFrame, width: int, threshold: int, chunk: int, most: int) -> DataFrame:
    """a, b: confirmed links that join the components of a bucket's members; enough of them, not all.

    Texts come along, so that pairs are confirmed where they meet and only links leave a task. A pair is looked at in the
    first bucket that its members share, and not if links found so far have joined them.
    """
    rows = members.select("key", "id").union(members.select("key", "pivot").distinct())
    rows = rows.join(comps.select(F.col("node").alias("id"), "comp"), "id", "left").withColumn("comp", F.coalesce("comp", "id"))
    per_key = rows.groupBy("key").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"), F.count(F.lit(1)).alias("size")).filter("lo != hi and size > 2").select("key", "size")
    # buckets that are still open are few beside their members: they are sent to them, not the members of one bucket to one task
    per_key = bounded_broadcast(materialise(per_key), MOST_HEAVY)
    open_rows = materialise(rows.join(per_key, "key").join(classes.select(F.col("rep").alias("id"), "n_shingles"), "id"))
    weights = open_rows.groupBy("key").agg(F.greatest(F.ceil(F.first("size") / BLOCK), F.ceil(F.sum("n_shingles") / BLOCK_SHINGLES)).cast("int").alias("blocks"))
    # large buckets are cut into blocks by hash, and every two blocks meet in a task of their own
    open_rows = open_rows.join(bounded_broadcast(materialise(weights), MOST_HEAVY), "key").withColumn("mine", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
    tasks = open_rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    tasks = materialise(tasks.select("key", F.xxhash64("key", F.least("mine", "other"), F.greatest("mine", "other")).alias("task"), "id", "comp"))
    needed = bounded_broadcast(tasks.select(F.col("id").alias("doc_id")).distinct(), BROADCAST_IDS)
    texts = docs.select("doc_id", "text").join(needed, "doc_id", "left_semi").withColumnRenamed("doc_id", "id")
    tasks = tasks.join(classes.select(F.col("rep").alias("id"), "sig").join(texts, "id"), "id").repartition("task").sortWithinPartitions("task")

    def links(key, ids, comp, sigs, sets):
        keys = bucket_keys(sigs, chunk)
        slot = np.flatnonzero((keys == key).any(axis=0))
        if not len(slot):
            return
        slot = slot[0]
        keys = keys[:, :slot]
        sizes = np.array([len(x) for x in sets])
        comp = comp.copy()
        for k in range(len(ids) - 1):
            rest = slice(k + 1, None)
            near = (comp[rest] != comp[k]) & (100 * np.minimum(sizes[rest], sizes[k]) >= threshold * np.maximum(sizes[rest], sizes[k]))
            at = np.flatnonzero(near) + k + 1
            at = at[(sigs[at] != sigs[k]).sum(axis=1) <= most]
            if slot and len(at):
                at = at[~(keys[at] == keys[k]).any(axis=1)]
            for j in at:
                if comp[j] != comp[k]:
                    inter = len(np.intersect1d(sets[k], sets[j], assume_unique=True))
                    if 100 * inter >= threshold * (sizes[k] + sizes[j] - inter):
                        yield min(ids[k], ids[j]), max(ids[k], ids[j])
                        comp[comp == comp[j]] = comp[k]

    def run(batches):
        schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])
        held: list = []
        now = None

        def flush():
            if len(held) > 1:
                key, ids, comp, sigs, sets = zip(*held)
                if found := list(links(np.uint64(key[0] % 2**64), np.array(ids), np.array(comp), np.stack(sigs), sets)):
                    yield from record_batches([[x[0] for x in found], [x[1] for x in found]], schema)
            held.clear()

        for b in sliced(batches):
            sigs = _sigs(b.column("sig"))
            for i, (task, key, ident, comp, text) in enumerate(zip(*(b.column(c).to_pylist() for c in ("task", "key", "id", "comp", "text")), strict=True)):
                if task != now:
                    yield from flush()
                    now = task
                held.append((key, ident, comp, sigs[i].copy(), shingles(text, width)))
        yield from flush()

    return map_arrow(tasks.select("task", "key", "id", "comp", "sig", "text"), run, "a long, b long").filter("a != b").distinct()


def resolve(docs: DataFrame, width: int = 5, threshold: int = 80) -> tuple[DataFrame, DataFrame]:
    """The rows' fingerprints with their class ``rep``, and the components (node, comp) of linked classes.

    ``docs`` has doc_id (integer) and text. A class is a set of shingles; its rep is the smallest doc_id that has it.
    """
    if not isinstance(docs.schema["doc_id"].dataType, T.IntegralType):
        raise TypeError("doc_id must be of a whole-number type")
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    chunk, most = plan(threshold)
    prints = materialise(fingerprints(docs, width))
    named = prints.filter(F.col("doc_id").isNotNull() & F.col("set_hash").isNotNull())
    classes = materialise(named.groupBy("set_hash").agg(F.min("doc_id").alias("rep"), F.first("n_shingles").alias("n_shingles"), F.first("sig").alias("sig")))
    members = materialise(_buckets(classes, chunk))
    release(docs.sparkSession)
    stars = materialise(members.select(F.col("pivot").alias("a"), F.col("id").alias("b")).distinct())
    links = _confirm(stars, classes, docs, width, threshold, most)
    # a doc_id with several texts ties their classes
    tied = named.join(classes.select("set_hash", "rep"), "set_hash").groupBy("doc_id").agg(F.min("rep").alias("a"), F.max("rep").alias("z"), F.collect_set("rep").alias("reps")).filter("a != z")
    links = materialise(links.union(tied.select("a", F.explode("reps").alias("b")).filter("a != b")))
    comps = materialise(components(links))
    release(docs.sparkSession)
    more = materialise(_cross_links(members, comps, classes, docs, width, threshold, chunk, most))
    if more.limit(1).count():
        comps = materialise(components(links.union(more)))
    release(docs.sparkSession)
    return prints.join(classes.select("set_hash", "rep"), "set_hash", "left"), comps


def near_duplicates(docs: DataFrame, width: int = 5, threshold: int = 80) -> DataFrame:
    """One row per row of docs: doc_id, n_shingles, component_id, kept."""
    prints, comps = resolve(docs, width, threshold)
    found = prints.join(comps, prints.rep == comps.node, "left")
    comp = F.when(F.col("doc_id").isNotNull(), F.coalesce("comp", "rep", "doc_id"))
    return found.select("doc_id", "n_shingles", comp.alias("component_id"), F.coalesce(comp == F.col("doc_id"), F.lit(True)).alias("kept"))


def keep(docs: DataFrame, width: int = 5, threshold: int = 80) -> DataFrame:
    """The rows of docs whose document stands for its component, with all their columns.

    Of rows that repeat a doc_id, the one with the smallest text stays.
    """
    judged = materialise(near_duplicates(docs, width, threshold))
    dropped = judged.filter(~F.col("kept")).select("doc_id").distinct()
    rest = docs.join(bounded_broadcast(dropped, BROADCAST_IDS), "doc_id", "left_anti").select(*docs.columns)
    named = judged.filter(F.col("doc_id").isNotNull() & F.col("kept"))
    if named.groupBy("doc_id").count().filter("count > 1").limit(1).count():
        # ids repeat: rank by a digest, so that texts of one id need not be sorted whole
        order = Window.partitionBy("doc_id").orderBy(F.col("text").isNull(), F.length("text"), F.md5("text"))
        packed = rest.select("doc_id", "text", F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
        ranked = packed.withColumn("place", F.row_number().over(order)).filter(F.col("doc_id").isNull() | (F.col("place") == 1))
        rest = ranked.select("row.*")
    return rest
