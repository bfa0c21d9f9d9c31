"""Problem 8: held-out evaluation texts leaking into documents.

Method: rare n-grams of the items (three words that at most two items share, with a name, a figure or another word of few items) are
seeds; a document that has seeds of an item is aligned with the item's passage, question and answer by Smith-Waterman, stretch by
stretch, in any script. What counts is the part of the passage held, and only where its names and figures agree too: the same sentence about others
does not.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from itertools import chain, count

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_partitions
from .texts import bare

_WORD = re.compile(r"[^\W\d_]+|\d+")
_THOUSANDS = re.compile(r"(?<=\d)[.,'](?=\d{3}(?!\d))")
N = 3
#: Words of at most this share of the items are telling. A seed is shared by at most RARE items, or by as many as the item's grams are on
#: the whole (their median), so that items with one passage have seeds, too.
RARE, TELLING = 2, 0.12
#: Documents are aligned in windows of so many words, which overlap by all that one stretch of a part can span.
WINDOW = 2_000
#: Items are few; more than this are sent to the tasks in blocks of so many.
BLOCK = 20_000


def words(text: str) -> list[str]:
    return _WORD.findall(_THOUSANDS.sub("", bare(text)))


def align(a: list[int], b: list[int], weight: np.ndarray, least: float = 6.0) -> np.ndarray:
    """For each word of a: the number of the local alignment with b that matches it, -1 in an alignment without a match, 0 in none.

    Smith-Waterman with gaps of 1 and mismatches of 1; matches count weight. The best stretch is taken, its words on both sides are
    struck out, and so on while stretches score at least `least`."""
    x, y = np.array(a), np.array(b)
    got = np.zeros(len(a), int)
    if not len(x) or not len(y):
        return got
    same = x[:, None] == y[None, :]
    col = np.arange(len(y) + 1, dtype=float)
    for k in count(1):
        score = np.where(same, weight[:, None], -1.0)
        h = np.zeros((len(x) + 1, len(y) + 1))
        for i in range(len(x)):
            row = np.maximum(0.0, h[i] - 1.0)
            row[1:] = np.maximum(row[1:], h[i, :-1] + score[i])
            h[i + 1] = np.maximum(row, np.maximum.accumulate(row + col) - col)
        i, j = np.unravel_index(int(h.argmax()), h.shape)
        if h[i, j] < least:
            return got
        end_i, end_j = i, j
        hits = []
        while i > 0 and j > 0 and h[i, j] > 0:
            if np.isclose(h[i, j], h[i - 1, j - 1] + score[i - 1, j - 1]):
                if same[i - 1, j - 1]:
                    hits.append(i - 1)
                i, j = i - 1, j - 1
            elif np.isclose(h[i, j], h[i - 1, j] - 1):
                i -= 1
            elif np.isclose(h[i, j], h[i, j - 1] - 1):
                j -= 1
            else:
                break
        got[i:end_i] = np.where(got[i:end_i] == 0, -1, got[i:end_i])
        got[hits] = k
        same[i:end_i, :] = False
        same[:, j:end_j] = False


def align_all(a: list[int], b: list[int], weight: np.ndarray) -> np.ndarray:
    """align() for texts of any length, in windows. A stretch scores at least its least, matches count two at most and gaps one, so it
    spans less than three times the part's words in the text: none is lost between windows."""
    overlap = 3 * len(a)
    if len(b) <= WINDOW + overlap:
        return align(a, b, weight)
    got = np.zeros(len(a), int)
    for i in range(0, max(1, len(b) - overlap), WINDOW):
        here = align(a, b[i : i + WINDOW + overlap], weight)
        got = np.where((got > 0) | (here == 0), got, here)
    return got


class Items:
    """The evaluation items, compiled for the tasks."""

    def __init__(self, rows: list[tuple[int, str | None, str | None, str | None]]):
        self.vocabulary: dict[str, int] = {}
        self.parts: list[tuple[int, dict[str, list[int]]]] = []
        has: Counter[int] = Counter()
        for item, passage, question, answer in rows:
            parts = {k: [self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in words(t or "")] for k, t in (("passage", passage), ("question", question), ("answer", answer))}
            self.parts.append((item, parts))
            has.update({w for p in parts.values() for w in p})
        most = max(3, TELLING * len(rows))
        self.telling = np.zeros(len(self.vocabulary) + 1, bool)
        for w, n in has.items():
            self.telling[w] = n <= most
        grams: dict[tuple[int, ...], set[int]] = defaultdict(set)
        for k, (_, parts) in enumerate(self.parts):
            for p in parts.values():
                for i in range(len(p) - N + 1):
                    g = tuple(p[i : i + N])
                    if any(self.telling[w] for w in g):
                        grams[g].add(k)
        shared: dict[int, list[int]] = defaultdict(list)
        for ks in grams.values():
            for k in ks:
                shared[k].append(len(ks))
        most = {k: max(RARE, int(np.median(n))) for k, n in shared.items()}
        self.seeds = {g: own for g, ks in grams.items() if (own := tuple(k for k in ks if len(ks) <= most[k]))}
        #: how many seeds a document must have of an item: two, if it has so many
        self.need = Counter(k for ks in self.seeds.values() for k in ks)

    def held(self, part: list[int], doc: list[int]) -> float:
        """The share of a part that a document holds."""
        if not part:
            return 0.0
        telling = self.telling[part]
        got = align_all(part, doc, np.where(telling, 2.0, 1.0))
        hit = got > 0
        # a word is held if the words around it in its stretch are, the telling ones among them
        n, span = len(part), 7
        inside = got != 0
        total = 0
        for i in range(n):
            if inside[i]:
                a, b = max(0, i - span), min(n, i + span + 1)
                here = inside[a:b]
                m, t = hit[a:b][here], telling[a:b][here]
                if m.sum() >= 4 and m.mean() >= 0.7 and (not t.any() or m[t].mean() >= 0.65):
                    total += 1
        return total / n

    def leaks(self, text: str | None) -> list[tuple[int, float, float]]:
        """(item, share of the passage, share of question and answer) for the items that a document gives away."""
        if not text:
            return []
        doc = [self.vocabulary.get(w, 0) for w in words(text)]
        votes: Counter[int] = Counter()
        for i in range(len(doc) - N + 1):
            g = (doc[i], doc[i + 1], doc[i + 2])
            if 0 not in g:
                for k in self.seeds.get(g, ()):
                    votes[k] += 1
        out = []
        for k, n in votes.items():
            item, parts = self.parts[k]
            if n < min(2, self.need[k]):
                continue
            passage = self.held(parts["passage"], doc)
            asked = 0.0
            if parts["question"] and parts["answer"]:
                asked = self.held(parts["question"], doc)
                asked = min(asked, max(self.held(parts["answer"], doc), _whole(parts["answer"], doc))) if asked > 0.8 else 0.0
            if passage > 0.5 or asked > 0.8:
                out.append((item, passage, asked))
        return out


def _whole(part: list[int], doc: list[int]) -> float:
    """1 if a short part stands in the document word by word."""
    n = len(part)
    return float(any(doc[i : i + n] == part for i in range(len(doc) - n + 1)))


def leaks(documents: DataFrame, items: DataFrame) -> DataFrame:
    """(doc_id, item_id, passage_share, question_share) of every document that holds more than half of an item's passage, in one or
    several stretches, or its whole question with its answer.

    Whole texts are read, however long. Null and empty texts hold nothing; repeated documents each give their rows; no items, no rows.
    Items are sent to the tasks in blocks of BLOCK."""
    schema = "doc_id long, item_id long, passage_share double, question_share double"
    rows = items.select(F.col("item_id").cast("long"), "passage", "question", "answer").orderBy("item_id")
    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text").where("text is not null and text <> ''")
    got: DataFrame | None = None
    block: list = []
    for r in chain(rows.toLocalIterator(), [None]):  # no more than a block of items at once
        if r is not None:
            block.append(tuple(r))
        if block and (r is None or len(block) == BLOCK):
            shared = docs.sparkSession.sparkContext.broadcast(block)
            block = []

            def run(batches, shared=shared):
                known = Items(shared.value)
                for b in batches:
                    out = [(d, *x) for d, t in zip(b["doc_id"], b["text"]) for x in known.leaks(t)]
                    yield dict(zip(("doc_id", "item_id", "passage_share", "question_share"), map(list, zip(*out)) if out else ([],) * 4))

            part = map_partitions(docs, run, schema)
            got = part if got is None else got.union(part)
    return got if got is not None else docs.sparkSession.createDataFrame([], schema)
