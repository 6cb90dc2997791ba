"""Phrase collocations against plain counting."""

import re
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from corpusmill.llm import collocations, queries

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
COLUMNS = ("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def brute(rows, longest=4, least=30, contained=80, most=2000):
    counts, words = defaultdict(Counter), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lower(text)):
            w = re.findall(r"[^\x20\x09]+", piece)
            words[lang] += len(w)
            for n in range(1, longest + 1):
                for s in range(len(w) - n + 1):
                    counts[lang][tuple(w[s : s + n])] += 1
    out = []
    for lang, f in counts.items():
        cand = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        kept = []
        for p, a in cand.items():
            inside = any(100 * b >= contained * a and len(q) > len(p) and any(q[s : s + len(p)] == p for s in range(len(q) - len(p) + 1)) for q, b in cand.items())
            if not inside:
                score, _, lo, hi = min((2_000_000 * a // (f[p[:k]] + f[p[k:]]), k, f[p[:k]], f[p[k:]]) for k in range(1, len(p)))
                kept.append((-score, -a, " ".join(p).encode(), " ".join(p), a, lo, hi, score))
        for rank, (*_, phrase, a, lo, hi, score) in enumerate(sorted(kept)[:most], 1):
            out.append((lang, rank, phrase, a, lo, hi, words[lang], score))
    return sorted(map(repr, out))


def rows():
    rng = np.random.default_rng(11)
    heads = np.array(["the", "new", "york", "Ä", "ß#", "of", "city", "a\x00b", "x=y"] + [f"w{k}" for k in range(40)])
    out = []
    for k in range(300):
        text = " ".join(heads[np.minimum(rng.geometric(0.2, int(rng.integers(0, 60))) - 1, len(heads) - 1)])
        text += rng.choice([".", ", ", "\n", "\t", " ", "\x0b", " : "]) + rng.choice(["In New York City", "of the best kind", "of the best", "Of THE\tbest  kind!", "x", ""])
        out.append((str(text), ("en", "de", "und")[int(rng.integers(3))] if k % 7 else None))
    return [*out, (None, "en"), ("", None), ("...", "fr"), ("only once here", "fr"), ("go on " * 5000, "es"), ("a b", "en"), ("a b", "en")]


def frame(spark, found):
    df = spark.createDataFrame([(k, t, lang, "s", 0) for k, (t, lang) in enumerate(found)], SCHEMA)
    for c in ("phrase", "size", "n", "a", "l", "rank", "score", "key", "part", "head", "rest"):
        df = df.withColumn(c, F.lit("clash"))
    return df


def got(df, **options):
    return sorted(repr(tuple(r[c] for c in COLUMNS)) for r in collocations.mine(df, **options).collect())


def test_brute(spark):
    found = got(frame(spark, rows()).repartition(3))
    assert found == brute(rows()) and len(found) > 40


@pytest.mark.parametrize("options", [{"filter_bits": 8}, {"broadcast_phrases": 0}, {"longest": 2, "least": 5}, {"longest": 3, "least": 2, "contained": 50, "most": 7}])
def test_other_ways(spark, options):
    """A filter that lets nearly all through, the joins beyond a broadcast, other parameters: the same as plain counting."""
    want = {k: v for k, v in options.items() if k not in ("filter_bits", "broadcast_phrases")}
    assert got(frame(spark, rows()), **options) == brute(rows(), **want)


def test_chunks(spark, monkeypatch):
    """Texts beyond a chunk are cut where a piece ends, a longer piece stays whole."""
    monkeypatch.setattr(collocations, "CHUNK", 50)
    data = b"a b c." * 30 + b"x y " * 40 + b"." + b"end"
    parts = list(collocations._chunks(data))
    assert b".".join(parts) == data and all(len(p) <= 50 or b"." not in p for p in parts)


def test_products_beyond_64_bits(spark):
    """Counts of tera-size corpora: the score is exact in decimals."""
    a, l, r = 9 * 10**15, 10**16 + 1, 10**16 + 3
    found = spark.createDataFrame([("en", "a", 1, l), ("en", "b", 1, r), ("en", "a b", 2, a)], "lang string, phrase string, size int, n long")
    assert collocations.scored(found).first().score == 2_000_000 * a // (l + r) and 2_000_000 * a > 2**63


def test_ties_and_rank(spark):
    """Equal scores go to the larger count, then to the first phrase in byte order."""
    text = "b a. " * 30 + "d c. " * 30 + "é f. " * 30 + "z y. " * 40
    ranked = [r.phrase for r in collocations.mine(frame(spark, [(text, "en")])).orderBy("rank").collect()]
    assert ranked == ["z y", "b a", "d c", "é f"]


def test_edges(spark):
    assert got(frame(spark, rows()).filter("false")) == []
    assert got(frame(spark, [(None, None), ("", "en")])) == []


def test_sql(spark):
    """The SQL agrees on the same odd rows."""
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (text VARCHAR, lang VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?)", [(t, lang) for t, lang in rows() if "\x00" not in (t or "")])
    want = brute([x for x in rows() if "\x00" not in (x[0] or "")])
    assert sorted(repr(tuple(r)) for r in con.execute(queries.ORACLE_SQL["op12_phrase_collocations"]).fetchall()) == want


def test_large_dimensions_are_not_broadcast(spark, tmp_path):
    """Beyond the bound the join is shuffled, however small the dimension's files look to Spark; results stay."""
    from corpusmill.llm.common import join_dimension
    from corpusmill.operators.tables import join_small

    spark.range(2000).selectExpr("concat('w', id) AS key", "id AS n").write.parquet(str(tmp_path / "dim"))
    dim, rows = spark.read.parquet(str(tmp_path / "dim")), spark.range(5000).selectExpr("id", "concat('w', id % 2500) AS key")
    for joined in (join_dimension(rows, dim, "key", False), join_small(rows, dim, ["key"], most_rows=100)):
        assert "BroadcastHashJoin" not in joined._jdf.queryExecution().executedPlan().toString()
        assert joined.selectExpr("count(*)", "sum(int(n = id % 2500))").first() == (4000, 4000)
