"""Personal data: patterns, and information-theoretic sanitisation of the terms that give it away.

Protected entities
    Base: e-mail addresses, IP addresses, payment cards (Luhn) and phone numbers. Beside them secrets: unbroken runs of letters
    and digits that carry at least ``SECRET_BITS`` of information (length times the entropy of their own characters) and change
    between letters and digits often, as keys and tokens do and words, names and numbers don't.
    An entity is protected as itself and as a member of a class: the domain of an address, the network of an IP address, the
    issuer of a card, the prefix of a phone number, any secret. So terms beside entities that are seen only once can gather
    support from the others of the class.

Disclosing terms
    A term discloses an entity as far as it tells about it: over all distinct sentences of the corpus, and once more over all
    distinct paragraphs (lines), of which the larger score holds, PMI(t, e) = log2(N n(t, e) / (n(t) n(e))) is compared with
    the entity's own information IC(e) = log2(N / n(e)). PMI / IC of at least ``remove`` removes the term, at least
    ``generalise`` replaces it by a general word. The evidence, n(t, e) PMI(t, e) bits, must exceed what chance gives the best
    of all pairs that are looked at (Bonferroni at ``CHANCE``), and at least ``support`` distinct units must have both.
    Terms are runs of letters; of one or two letters only as whole words (``Li``). N, n(t), n(e) and n(t, e) count distinct
    units, so copied documents don't make their words look telling.

How terms are counted
    n(t) is needed only for terms that could pass. Units with an entity and a hash sample of the others (one of ``SAMPLE``) give a
    lower bound of it; a term whose score falls short even with that bound is dropped before all its units are counted.
    The bound only saves work: what is left is counted over all units.

Edge cases: null text is empty (``sanitise`` leaves it null). Repeated rows get equal results. Equal sentences count once however often
they occur. Terms with equal scores (ties) are treated alike. Without entities, or in an empty table, no term is disclosing. Very long texts are read
whole, one at a time. Further columns, whatever their names, are ignored by ``find`` and pass through ``sanitise``.
"""

from __future__ import annotations

import hashlib
import math
import re
from bisect import bisect_left
from collections import Counter

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded_broadcast, map_arrow, materialise, release, ship, sliced

ship(__name__)

KINDS = ("email", "ip", "card", "phone")
SECRET = re.compile(r"(?<![A-Za-z0-9_])[A-Za-z0-9_]{20,}+")
SECRET_BITS = 60
#: Accepted chance of any term passing for nothing, and share of units without entities that bound n(t) from below.
CHANCE, SAMPLE = 1e-3, 64
#: Units of a row: lists stay small beside what a reader takes at a time.
UNITS = 1024
LOCAL = re.compile(r"[A-Za-z0-9._%+-]+")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
NOT_DIGIT = re.compile(r"[^0-9]")
DIGIT = re.compile(r"[0-9]")
LOCAL_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
SENTENCE_END = re.compile(r"[.!?](?=\s)|\n")
TERM = re.compile(r"[^\W\d_]{3,}|(?<!\w)[^\W\d_]{1,2}(?!\w)")
RUN = re.compile(r"[^\W\d_]+")
#: Rows of a batch that a task gathers before it hands them on.
ROWS = 50_000
LINE_END = re.compile("\n")
#: Terms that are sent to the tasks as a set at most; more are joined.
SENT_TERMS = 200_000
GENERAL = "[TERM]"


def luhn(digits: str) -> bool:
    odd, even = digits[::-2], digits[-2::-2]
    return (sum(map(int, odd)) + sum(sum(divmod(2 * int(d), 10)) for d in even)) % 10 == 0


def emails(text: str) -> list[tuple[int, int]]:
    """Spans of e-mail addresses, found from their @ outwards in linear time."""
    out, done, at = [], 0, text.find("@")
    while at >= 0:
        lo = at
        while lo > done and text[lo - 1] in LOCAL_CHARS:
            lo -= 1
        if lo < at and (m := DOMAIN.match(text, at + 1)):
            out.append((lo, m.end()))
            done = m.end()
        else:
            done = max(done, at + 1)
        at = text.find("@", done)
    return out


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) in code points, by kind and start."""
    out = [("email", *s) for s in emails(text)] if "@" in text else []
    if not DIGIT.search(text):  # the other kinds have digits
        return out
    out += [("ip", *m.span()) for m in IP.finditer(text) if max(int(p[-4:]) if len(p.lstrip("0")) <= 4 else 256 for p in m[0].split(".")) <= 255]
    for m in CARD.finditer(text):
        if m.end() - m.start() >= 16 and 16 <= len(d := NOT_DIGIT.sub("", m[0])) <= 19 and luhn(d):
            out.append(("card", *m.span()))
    if "+" in text:
        out += [("phone", *m.span()) for m in PHONE.finditer(text) if 8 <= len(NOT_DIGIT.sub("", m[0])) <= 15]
    return out


def secrets(text: str) -> list[tuple[str, int, int]]:
    """Spans of keys and tokens: (``secret``, start, end) in code points."""
    out = []
    if not DIGIT.search(text):
        return out
    for m in SECRET.finditer(text):
        run, n = m[0], len(m[0])
        digit = [c.isdigit() for c in run]
        if sum(a != b for a, b in zip(digit, digit[1:])) * 8 >= n and sum(-k * math.log2(k / n) for k in Counter(run).values()) >= SECRET_BITS:
            out.append(("secret", *m.span()))
    return out


def protected(text: str) -> list[tuple[str, int, int]]:
    """Spans of all protected entities, by kind and start."""
    return base_spans(text) + secrets(text)


def names_of(kind: str, value: str) -> list[str]:
    """What an entity is counted as: itself and its class."""
    if kind == "email":
        value = value.lower()
        group = value.rsplit("@", 1)[1]
    elif kind == "ip":
        group = ".".join(value.split(".")[:2])
    elif kind == "secret":
        group = ""
    else:
        value = NOT_DIGIT.sub("", value)
        group = value[: 6 if kind == "card" else 4]
    return [f"{kind}:{value}", f"{kind} class:{group}"]


def sentences(text: str) -> list[tuple[int, int]]:
    ends = [m.end() for m in SENTENCE_END.finditer(text)]
    return [(a, b) for a, b in zip([0, *ends], [*ends, len(text)]) if b > a]


def stretches(text: str) -> list[tuple[int, int, int]]:
    """(wide, start, end) of the units in which terms and entities meet: sentences (0) and paragraphs (1)."""
    ends = [m.start() for m in LINE_END.finditer(text)]
    wide = [(1, a, b) for a, b in zip([0, *(e + 1 for e in ends)], [*ends, len(text)]) if b > a]
    return [*((0, a, b) for a, b in sentences(text)), *wide]


def _digest(s: str) -> int:
    return xxhash.xxh3_64_intdigest(s.encode("utf-8", "surrogatepass")) - 2**63


def _outside(matches, spans: list):
    """The matches, which come in order, that overlap none of the spans (kind, start, end)."""
    ends = sorted((s, e) for _, s, e in spans)
    at = 0
    for m in matches:
        lo, hi = m.span()
        while at < len(ends) and ends[at][1] <= lo:
            at += 1
        k = at
        while k < len(ends) and ends[k][0] < hi and ends[k][1] <= lo:
            k += 1
        if k == len(ends) or ends[k][0] >= hi:
            yield m


def _terms(text: str, lo: int, hi: int, spans: list) -> set[str]:
    """The lower-cased terms of a stretch of text outside the spans."""
    return {m[0].lower() for m in _outside(TERM.finditer(text, lo, hi), spans)}


def _has_any(text: str, terms) -> bool:
    """Whether one of the terms may be in a text: a quick look at its runs of letters (or none, if letters change their number in lower case)."""
    small = text.lower()
    return len(small) != len(text) or not terms.isdisjoint(RUN.findall(small))


def mentions(docs: DataFrame) -> DataFrame:
    """wide, entity, term, unit, units: every unit once a slice (in lists of ``units``, all else null), a row for each entity and term of a
    sentence or paragraph, and one without entity for each term of the sampled units that have none."""
    names = ["wide", "entity", "term", "unit", "units"]

    def batch(rows):
        columns = [pa.array(x, t) for x, t in zip(zip(*rows), (pa.int32(), pa.int64(), pa.string(), pa.int64()))]
        return pa.RecordBatch.from_arrays([*columns, pa.nulls(len(rows), pa.list_(pa.int64()))], names=names)

    def lists(wide, units):
        ends = [*range(0, len(units), UNITS), len(units)]
        n = len(ends) - 1
        units = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(units, pa.int64()))
        return pa.RecordBatch.from_arrays([pa.array([wide] * n, pa.int32()), pa.nulls(n, pa.int64()), pa.nulls(n, pa.string()), pa.nulls(n, pa.int64()), units], names=names)

    def run(batches):
        for b in sliced(batches):
            rows, seen = [], (set(), set())
            for text in b.column("text").to_pylist():
                if not text:
                    continue
                spans = protected(text)
                for wide, lo, hi in stretches(text):
                    unit = _digest(text[lo:hi])
                    if unit in seen[wide]:
                        continue
                    seen[wide].add(unit)
                    own = spans and [s for s in spans if s[1] < hi and lo < s[2]]
                    if own:
                        entities = sorted({_digest(n) for kind, s, e in own for n in names_of(kind, text[s:e])})
                    elif unit % SAMPLE == 0:
                        entities = [None]
                    else:
                        continue
                    terms = sorted(_terms(text, lo, hi, own))
                    for entity in entities:
                        rows += [(wide, entity, t, unit) for t in terms] or [(wide, entity, None, unit)]
                        if len(rows) >= ROWS:
                            yield batch(rows)
                            rows = []
            if rows:
                yield batch(rows)
            for wide, units in enumerate(seen):
                if units:
                    yield lists(wide, list(units))

    return map_arrow(docs.select("text"), run, "wide int, entity long, term string, unit long, units array<bigint>")


def occurrences(docs: DataFrame, only: frozenset | None) -> DataFrame:
    """wide, term, unit for the terms ``only`` (all, if None) in the sentences and paragraphs of docs."""

    def batch(rows):
        return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*sorted(rows)), (pa.int32(), pa.string(), pa.int64()))], names=["wide", "term", "unit"])

    def run(batches):
        for b in sliced(batches):
            rows = set()
            for text in b.column("text").to_pylist():
                if not text or only is not None and not _has_any(text, only):
                    continue
                # units end between terms, so one pass finds the terms of all of them
                hits = [(m.start(), t) for m in TERM.finditer(text) if (t := m[0].lower()) in only] if only is not None else [(m.start(), m[0].lower()) for m in TERM.finditer(text)]
                if not hits:
                    continue
                starts = [at for at, _ in hits]
                for wide, lo, hi in stretches(text):
                    first, end = bisect_left(starts, lo), bisect_left(starts, hi)
                    if first < end:
                        unit = _digest(text[lo:hi])
                        rows.update((wide, t, unit) for _, t in hits[first:end])
                        if len(rows) >= ROWS:
                            yield batch(rows)
                            rows = set()
            if rows:
                yield batch(rows)

    return map_arrow(docs.select("text"), run, "wide int, term string, unit long")


def _few(terms: DataFrame) -> list | None:
    """The rows of a frame of terms if they are few enough to be sent to tasks."""
    rows = terms.limit(SENT_TERMS + 1).collect()
    return rows if len(rows) <= SENT_TERMS else None


def disclosing(docs: DataFrame, generalise: float = 0.9, remove: float = 0.97, support: int = 2) -> DataFrame:
    """term, score, action ('generalise' or 'remove'): the terms that disclose some entity, by their largest PMI / IC."""
    seen = materialise(mentions(docs))
    total = dict(seen.filter("units IS NOT NULL").select("wide", F.explode("units").alias("unit")).distinct().groupBy("wide").count().collect())
    found = seen.filter("entity IS NOT NULL")
    n_entity = found.select("wide", "entity", "unit").distinct().groupBy("wide", "entity").agg(F.count(F.lit(1)).alias("n_e"))
    # a class of entities may have a good part of all rows: its count is sent to them rather than they to one task
    n_entity = bounded_broadcast(materialise(n_entity), SENT_TERMS)
    joint = materialise(found.filter("term IS NOT NULL").distinct().groupBy("wide", "entity", "term").agg(F.count(F.lit(1)).alias("n_te")))
    chance = math.log2(max(joint.count(), 1) / CHANCE)
    n = F.when(F.col("wide") == 0, float(max(total.get(0, 0), 2))).otherwise(float(max(total.get(1, 0), 2)))
    ic = F.greatest(F.log2(n / F.col("n_e")), F.lit(1e-9))
    score = lambda n: 1 - F.log2(F.greatest(F.col(n) / F.col("n_te"), F.lit(1.0))) / ic
    passes = lambda n: (score(n) >= generalise) & (F.col("n_te") * score(n) * ic >= chance)
    least = seen.filter("term IS NOT NULL").select("wide", "term", "unit").distinct().groupBy("wide", "term").agg(F.count(F.lit(1)).alias("n_least"))
    joint = joint.filter(F.col("n_te") >= support).join(n_entity, ["wide", "entity"]).join(least, ["wide", "term"])
    joint = materialise(joint.filter(passes("n_least")))
    terms = joint.select("term").distinct()
    few = _few(terms)
    used = occurrences(docs, None if few is None else frozenset(r[0] for r in few))
    n_term = used.join(terms, "term", "left_semi").distinct().groupBy("wide", "term").agg(F.count(F.lit(1)).alias("n_t"))
    best = joint.join(n_term, ["wide", "term"]).filter(passes("n_t")).groupBy("term").agg(F.max(score("n_t")).alias("score"))
    best = materialise(best.withColumn("action", F.when(F.col("score") >= remove, "remove").otherwise("generalise")))
    release(docs.sparkSession)
    return best


def all_spans(text: str, actions: dict[str, str]) -> tuple[list, list, list]:
    """Base spans, those of secrets, and those of disclosing terms: (action, start, end)."""
    base, keys = base_spans(text), secrets(text)
    if not actions or not _has_any(text, actions.keys()):
        return base, keys, []
    terms = [(actions[t], *m.span()) for m in _outside(TERM.finditer(text), base + keys) if (t := m[0].lower()) in actions]
    return base, keys, terms


def rewritten(text: str, base: list, keys: list, terms: list) -> str:
    """The text with entities and general terms replaced by their kind, and removed terms left out."""
    out, at = [], 0
    for kind, s, e in sorted([*base, *keys, *terms], key=lambda x: (x[1], -x[2])):
        if e <= at:
            continue
        out += [text[at : max(s, at)], {"generalise": GENERAL, "remove": ""}.get(kind, f"[{kind.upper()}]")]
        at = e
    return "".join([*out, text[at:]])


def _with_actions(docs: DataFrame, terms: DataFrame) -> tuple[DataFrame, dict[str, str] | None]:
    """text, row (all other columns of docs, in a struct where their names can't clash with ours) and acts, and the terms' actions as a
    dict; if they are too many, acts has those of each text."""
    packed = docs.select("text", F.struct(F.lit(True), *[F.col(f"`{c}`") for c in docs.columns if c != "text"]).alias("row"))
    if (few := _few(terms.select("term", "action"))) is not None:
        return packed.withColumn("acts", F.lit(None).cast("map<string,string>")), dict(few)
    mark = F.xxhash64("text")

    def run(batches):
        for b in sliced(batches):
            rows = [(m, t) for m, x in zip(b.column("mark").to_pylist(), b.column("text").to_pylist()) for t in {y.lower() for y in TERM.findall(x or "")}]
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows), (pa.int64(), pa.string()))], names=["mark", "term"])

    used = map_arrow(docs.select(mark.alias("mark"), "text"), run, "mark long, term string").distinct().join(terms, "term")
    acts = used.groupBy("mark").agg(F.map_from_entries(F.collect_list(F.struct("term", "action"))).alias("acts"))
    return packed.withColumn("mark", mark).join(acts, "mark", "left").drop("mark"), None


def find(docs: DataFrame, generalise: float = 0.9, remove: float = 0.97, support: int = 2) -> DataFrame:
    """One row per row of docs (doc_id, text): doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_secret, n_term."""
    rows, actions = _with_actions(docs.select("doc_id", "text"), disclosing(docs, generalise, remove, support))
    names = [*(f"n_{k}" for k in KINDS), "base_sha256", "spans", "n_secret", "n_term"]

    def run(batches):
        for b in sliced(batches):
            out = []
            for text, acts in zip(b.column("text").to_pylist(), b.column("acts").to_pylist(), strict=True):
                base, keys, terms = all_spans(text or "", actions if actions is not None else dict(acts or ()))
                plain = ",".join(f"{k}:{s}:{e}" for k, s, e in base)
                spans = ",".join([*filter(None, [plain]), *(f"{k}:{s}:{e}" for k, s, e in keys), *(f"term:{s}:{e}" for _, s, e in terms)])
                out.append((*(sum(k == x[0] for x in base) for k in KINDS), hashlib.sha256(plain.encode()).hexdigest(), spans, len(keys), len(terms)))
            cols = list(zip(*out)) or [[]] * len(names)
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), *(pa.array(c, pa.string() if k in (4, 5) else pa.int64()) for k, c in enumerate(cols))], names=["doc_id", *names])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return map_arrow(rows.select("row.doc_id", "text", "acts"), run, f"doc_id {kind}, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, n_secret long, n_term long")


def sanitise(docs: DataFrame, generalise: float = 0.9, remove: float = 0.97, support: int = 2) -> DataFrame:
    """docs with entities replaced by their kind and disclosing terms generalised or removed; null texts stay null."""
    rows, actions = _with_actions(docs, disclosing(docs, generalise, remove, support))
    kinds = docs.schema

    def run(batches):
        for b in sliced(batches):
            texts = []
            for text, acts in zip(b.column("text").to_pylist(), b.column("acts").to_pylist(), strict=True):
                texts.append(text and rewritten(text, *all_spans(text, actions if actions is not None else dict(acts or ()))))
            others = iter(b.column("row").flatten()[1:])
            cols = [pa.array(texts, pa.string()) if name == "text" else next(others) for name in kinds.names]
            yield pa.RecordBatch.from_arrays(cols, names=kinds.names)

    return map_arrow(rows.select("row", "text", "acts"), run, kinds)
