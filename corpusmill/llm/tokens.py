"""Token counts of a unigram tokenizer by dynamic programming over a trie of pre-tokens.

A text's pre-tokens are its words between ASCII white space, each with the word-start mark in front. For a slice of texts the
distinct pre-tokens form a trie (visited in sorted order, with the current path held in a stack): the forward score of a prefix,
the best sum of piece scores and its number of tokens, is computed once and used by all pre-tokens below it. A node that ends a
pre-token stores its count, and a task keeps the counts it has (up to ``KEPT_CHARS`` characters of pre-tokens, then it starts
afresh), so that a pre-token is scored once for many slices. Texts sum the counts of their pre-tokens; nothing is shuffled.

Pieces come from a public vocabulary file whose path is a parameter. It carries ranks and no probabilities, so a piece's score is
that of Zipf's law, -log(rank + 1). A character that no piece covers costs its UTF-8 bytes as tokens. Ties go to fewer tokens.

Edge cases: null and blank texts have no tokens. A very long pre-token is scored like any other, in time linear in its length.
Repeated rows each get a row, with equal counts. An empty table gives an empty result. Rows with null doc_id are counted too.
Further columns are ignored, whatever their names.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterable

import pyarrow as pa
from pyspark.sql import DataFrame

from .common import map_arrow, ship, sliced

ship(__name__)

WORD = re.compile(r"[^\x20\x09-\x0D]+")
MARK = "▁"
#: Score of a byte of an uncovered character, below every piece's.
BYTE = -20.0
#: Characters of the pre-tokens whose counts a task keeps.
KEPT_CHARS = 1 << 23


def load_pieces(path: str) -> dict[str, float]:
    """piece to score of a vocabulary file; control and byte pieces are left out."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    return {sp.id_to_piece(i): -math.log(i + 1) for i in range(sp.get_piece_size()) if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i))}


def forward_counts(pre_tokens: Iterable[str], pieces: dict[str, float], longest: int) -> dict[str, int]:
    """The number of tokens of each of the distinct pre-tokens."""
    counts: dict[str, int] = {}
    path, best, used = "", [0.0], [0]  # best[i], used[i]: of the path's first i characters
    get = pieces.get
    for word in sorted(pre_tokens):
        shared, top = 0, min(len(path), len(word))
        while shared < top and path[shared] == word[shared]:
            shared += 1
        del best[shared + 1 :], used[shared + 1 :]
        for end in range(shared + 1, len(word) + 1):
            size = len(word[end - 1].encode("utf-8", "surrogatepass"))
            score, n = best[end - 1] + BYTE * size, used[end - 1] + size
            for lo in range(max(0, end - longest), end):
                if (s := get(word[lo:end])) is not None:
                    s += best[lo]
                    if s > score or s == score and used[lo] + 1 < n:
                        score, n = s, used[lo] + 1
            best.append(score)
            used.append(n)
        path = word
        counts[word] = used[-1]
    return counts


def count_tokens(docs: DataFrame, pieces: dict[str, float]) -> DataFrame:
    """One row per row of docs (doc_id, text): doc_id, n_pretokens, n_tokens."""
    longest = max(map(len, pieces), default=1)
    sent = docs.sparkSession.sparkContext.broadcast(pieces)

    def run(batches):
        known: dict[str, int] = {}
        held = 0
        for b in sliced(batches):
            bags = [Counter(WORD.findall(t or "")) for t in b.column("text").to_pylist()]
            new = {MARK + w for bag in bags for w in bag}
            if held > KEPT_CHARS:
                known, held = {}, 0
            new -= known.keys()
            known.update(forward_counts(new, sent.value, longest))
            held += sum(map(len, new))
            n = [sum(k * known[MARK + w] for w, k in bag.items()) for bag in bags]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array([bag.total() for bag in bags], pa.int64()), pa.array(n, pa.int64())], names=["doc_id", "n_pretokens", "n_tokens"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return map_arrow(docs.select("doc_id", "text"), run, f"doc_id {kind}, n_pretokens long, n_tokens long")
