"""License scans against plain loops."""

import re
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from corpusmill.llm import licenses

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
COLUMNS = ("n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score")


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def brute(text, templates=None, gram=3):
    """The columns of one text: every diagonal of every template by comparing words."""
    w = WORD.findall(lower(text))
    at, labels, base, score = [], set(), set(), 0.0
    for t in licenses.PHRASES + licenses.NOTICES if templates is None else templates:
        words, lines = t.text.split(), defaultdict(set)
        for i in range(len(w) - gram + 1):
            for o in range(len(words) - gram + 1):
                if w[i : i + gram] == words[o : o + gram]:
                    lines[i - o].update(range(o, o + gram))
        for d in lines:
            found = set().union(*(x for e, x in lines.items() if abs(e - d) <= t.slack))
            if 100 * len(found) >= t.percent * len(words):
                labels.add(t.label)
                score = max(score, len(found) / len(words))
                if t.base:
                    base.add(t.label)
                    at.append(d)
    return len(w), len(at), min(at, default=None), max(at, default=None), ",".join(sorted(base)), ",".join(sorted(labels)), score


def long_text():
    mit = next(t.text for t in licenses.NOTICES if t.label == "mit").split()
    return mit


def rows():
    rng = np.random.default_rng(4)
    prose = lambda n: " ".join(f"w{k}" for k in rng.integers(0, 300, n))
    mit = long_text()
    changed = mit[:10] + ["kind"] + mit[10:25] + mit[27:]
    far = mit[:20] + prose(30).split() + mit[20:24]
    isc = next(t.text for t in licenses.NOTICES if t.label == "isc")
    return [
        (1, None), (2, ""), (3, "!? ..."), (4, "Released UNDER the MIT-License."), (5, "mit license under the"),
        (6, f"{prose(40)} Licensed under the Apache License, Version 2.0. {prose(9)} Apache License; version 2!"),
        (7, "cc-by-nc cc by nc cc BY nc 4.0"), (8, "This work is licensed under the GNU General Public License, version 3."), (9, "GNU Lesser General Public License, version 3"),
        (10, f"{prose(50)} {' '.join(mit)} {prose(50)}"), (11, " ".join(changed)), (12, " ".join(far)), (13, " ".join(mit[:20])),
        (14, f"{isc} " * 3), (15, "under the mit license " * 2000), (16, "é " + prose(3) + " the mit license"), (16, "under the mit license"), (None, "cc by nc"), (None, None),
        (17, prose(5000)), (18, "of the software in the software " * 300),
    ]


def frame(spark, found):
    df = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in found], SCHEMA)
    for c in ("rid", "w", "h", "pos", "label", "base", "n_words", "template", "diagonal", "near", "span", "start", "score", "labels"):
        df = df.withColumn(c, F.lit("clash"))
    return df


@pytest.mark.parametrize("few", [licenses.BROADCAST_GRAMS, 0])
def test_brute(spark, few):
    got = sorted(repr((r.doc_id, *(r[c] for c in COLUMNS))) for r in licenses.judge(frame(spark, rows()).repartition(3), broadcast_grams=few).collect())
    assert got == sorted(repr((i, *brute(t))) for i, t in rows())


def test_expected(spark):
    got = {r.doc_id: r for r in licenses.judge(frame(spark, rows())).collect()}
    assert got[4].base_labels == "mit" and got[5].labels == "" and (got[6].n_base, got[6].labels) == (2, "apache-2")
    assert got[7].n_base == 3 and got[7].labels == "cc-by-nc" and (got[8].base_labels, got[8].labels, got[8].score) == ("", "gpl-3", 1.0)
    assert got[9].labels == "lgpl" and got[10].score == 1.0 and got[11].labels == "mit" and 0.7 <= got[11].score < 1
    assert got[12].labels == "" and got[13].labels == "" and got[15].n_base == 2000 and got[15].last_word == 7996


def test_spans(spark):
    """Neighbouring diagonals become one span; spans are where the words are."""
    found = licenses.spans(frame(spark, rows())).filter("doc_id IN (4, 11, 14)").orderBy("doc_id", "start").collect()
    assert [(r.doc_id, r.label, r.start, r.end) for r in found if r.doc_id != 14] == [(4, "mit", 1, 5), (11, "mit", 0, len(long_text()) - 1)]
    isc = len(next(t.text for t in licenses.NOTICES if t.label == "isc").split())
    assert [(r.start, r.end) for r in found if r.doc_id == 14 and r.label == "isc"] == [(k * isc, (k + 1) * isc) for k in range(3)]


def test_edges(spark):
    empty = frame(spark, rows()).filter("false")
    assert licenses.judge(empty).count() == 0 and licenses.spans(empty).count() == 0
    with pytest.raises(ValueError, match="fewer than"):
        licenses.judge(empty, [licenses.Template("x", "two words")])
    other = [licenses.Template("ab", "a b a b", True)]
    got = licenses.judge(frame(spark, [(1, "a b a b a b")]), other).first()
    assert (got.n_base, got.first_word, got.last_word, got.labels) == (2, 0, 2, "ab")
