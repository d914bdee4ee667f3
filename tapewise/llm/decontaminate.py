"""Benchmark decontamination: BM25 over an inverted index of test items, searched with block-max WAND.

Index terms are word n-grams (``GRAM`` words, marks and case removed), so
common words alone retrieve nothing.  Items longer than ``SEGMENT`` words are
indexed in segments.  Impacts are divided by the segment's own full score, so
a passage that holds a whole segment scores 1 and ``THRESHOLD`` means the same
for every item.

Every text is cut into overlapping passages of two segments' length, so each
segment-long stretch lies whole in some passage.  A passage whose terms' upper
bounds cannot reach the threshold is skipped with one array operation; every
other passage runs block-max WAND and keeps all items above the threshold (no
top-k).  A hit is verified on the text around it: the share of the item's
question n-grams and of its answer n-grams (those that reach into the last
sentence) must both be at least ``OVERLAP``.

Items are searched in blocks of at most ``BLOCK_BYTES`` of text, each sent to
every task; their number grows with the item table, their size does not.  Item
counts and lengths cover all items.

Nulls: a null text (of a document or an item) is empty; empty texts, and items
of fewer than ``GRAM`` words, match nothing.  A null ``item_id`` or ``doc_id``
is carried.  Repeated rows of either table are matched each.  Empty tables
give no rows.
"""

from __future__ import annotations

import math
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tapewise.llm.common import by_value, free_name, text_or_empty, tidied

GRAM = 3
SEGMENT = 64
THRESHOLD = 0.5
OVERLAP = 0.6
K1, B = 1.2, 0.75
POSTING_BLOCK = 64
BLOCK_BYTES = 16 << 20
MAX_CACHED = 600_000

HIT_SCHEMA = "doc_id long, item_id long, passage_start long, score double, question_overlap double, answer_overlap double"

_MARKS = re.compile(r"[\W_]+")
_SENTENCE = re.compile(r"(?<=[.?!])\s+|\n+")


def words_of(text: str) -> list[str]:
    """Lower-case words without marks; tokens of marks alone vanish."""
    return [w for w in (_MARKS.sub("", t) for t in text.lower().split()) if w]


def question_and_answer(text: str) -> tuple[list[str], int]:
    """Words of an item, and where the answer (its last sentence with a word) begins."""
    parts = [p for p in map(words_of, _SENTENCE.split(text)) if p]
    words = [w for p in parts for w in p]
    return words, len(words) - len(parts[-1]) if len(parts) > 1 else 0


def grams(words: list, n: int) -> list[tuple]:
    return [tuple(words[i:i + n]) for i in range(len(words) - n + 1)]


class Index:
    """Inverted index of one block of item segments, with block-max postings of normalised impacts."""

    def __init__(self, items: list[tuple[int, str]], n_segments: int, mean_length: float, df: dict, gram: int = GRAM):
        self.gram, self.items, segments = gram, [], []
        for item_id, text in items:
            words, answer = question_and_answer(text)
            keys = grams(words, gram)
            if not keys:
                continue
            tail = {k for i, k in enumerate(keys) if i + gram > answer} if answer else set(keys)
            head = {k for i, k in enumerate(keys) if i + gram <= answer} if answer else set(keys)
            self.items.append((item_id, head or tail, tail))
            segments += [(len(self.items) - 1, keys[a:b]) for a, b in segment_bounds(len(words), gram)]
        self.owner = [s[0] for s in segments]
        vocab = sorted({k for _, keys in segments for k in keys})
        words = sorted({w for k in vocab for w in k})
        self.word_ids = {w: i for i, w in enumerate(words)}
        number = {k: i for i, k in enumerate(vocab)}
        postings = defaultdict(list)
        for s, (_, keys) in enumerate(segments):
            counts = Counter(keys)
            norm = K1 * (1 - B + B * len(keys) / mean_length)
            impact = {k: math.log(1 + (n_segments - df[k] + 0.5) / (df[k] + 0.5)) * c * (K1 + 1) / (c + norm) for k, c in counts.items()}
            whole = sum(impact.values())
            for k, x in impact.items():
                postings[number[k]].append((s, x / whole))
        self.postings = [postings[i] for i in range(len(vocab))]
        self.block_max = [[(p[min(len(p), a + POSTING_BLOCK) - 1][0], max(x for _, x in p[a:a + POSTING_BLOCK]))
                           for a in range(0, len(p), POSTING_BLOCK)] for p in self.postings]
        self.upper = np.array([max(x for _, x in p) for p in self.postings])
        # term codes: each word's number in a mixed radix, sorted for lookups
        self.codes = self.code(np.array([[self.word_ids[w] for w in k] for k in vocab], np.int64).reshape(-1, gram).T)
        self.by_code = np.argsort(self.codes, kind="stable")
        self.sorted_codes = self.codes[self.by_code]

    def code(self, columns) -> np.ndarray:
        """A 64-bit code of the words' numbers in a mixed radix (a block's vocabulary is far below 2 ** 21 words)."""
        out = np.zeros(len(columns[0]), np.uint64)
        for c in columns:
            out = out * np.uint64(len(self.word_ids) + 1) + c.astype(np.uint64)
        return out

    def terms_at(self, ids: np.ndarray) -> np.ndarray:
        """The term that starts at each word, or -1."""
        n = len(ids) - self.gram + 1
        if n <= 0 or not len(self.codes):
            return np.full(max(n, 0), -1, np.int64)
        columns = [ids[k:n + k] for k in range(self.gram)]
        known = np.logical_and.reduce([c >= 0 for c in columns])
        out = np.full(n, -1, np.int64)
        at = np.flatnonzero(known)
        if len(at):
            code = self.code([c[at] for c in columns])
            place = np.minimum(np.searchsorted(self.sorted_codes, code), len(self.codes) - 1)
            out[at] = np.where(self.sorted_codes[place] == code, self.by_code[place], -1)
        return out

    def number_of(self, key: tuple) -> int:
        code = self.code([np.array([self.word_ids[w]]) for w in key])
        return int(self.by_code[np.searchsorted(self.sorted_codes, code)[0]])

    def search(self, terms: list[int], threshold: float) -> list[tuple[int, float]]:
        """All segments whose summed impacts reach the threshold: block-max WAND over the terms' postings."""
        floor = threshold - 1e-9
        cursors = [[self.postings[t][0][0], t, 0] for t in terms]  # segment, term, place
        found = []

        def advance(cursor, target):
            posting, place = self.postings[cursor[1]], cursor[2]
            step = 1
            while place + step < len(posting) and posting[place + step][0] < target:
                step *= 2  # gallop, then search the last stretch
            low, high = place + step // 2, min(place + step, len(posting))
            while low < high:
                middle = (low + high) // 2
                if posting[middle][0] < target:
                    low = middle + 1
                else:
                    high = middle
            cursor[2] = low
            cursor[0] = posting[low][0] if low < len(posting) else math.inf

        while True:
            cursors = sorted((c for c in cursors if c[0] != math.inf), key=lambda c: c[0])
            bound, pivot = 0.0, None
            for i, c in enumerate(cursors):
                bound += self.upper[c[1]]
                if bound >= floor:
                    pivot = i
                    break
            if pivot is None:
                return found
            target = cursors[pivot][0]
            while pivot + 1 < len(cursors) and cursors[pivot + 1][0] == target:
                pivot += 1
            block_bound, leap = 0.0, math.inf
            for c in cursors[:pivot + 1]:
                blocks, b = self.block_max[c[1]], c[2] // POSTING_BLOCK
                while b < len(blocks) and blocks[b][0] < target:
                    b += 1
                if b < len(blocks):
                    block_bound += blocks[b][1]
                    leap = min(leap, blocks[b][0] + 1)
            if block_bound < floor:  # no segment up to the nearest block end can reach the threshold
                if pivot + 1 < len(cursors):
                    leap = min(leap, cursors[pivot + 1][0])
                leap = max(leap, target + 1)
                for c in cursors[:pivot + 1]:
                    advance(c, leap)
            elif cursors[0][0] == target:
                total = sum(self.postings[c[1]][c[2]][1] for c in cursors[:pivot + 1])
                if total >= floor:
                    found.append((target, total))
                for c in cursors[:pivot + 1]:
                    advance(c, target + 1)
            else:
                for c in cursors[:pivot]:
                    if c[0] < target:
                        advance(c, target)


def segment_bounds(n_words: int, gram: int = GRAM, size: int = SEGMENT) -> list[tuple[int, int]]:
    """Ranges of n-gram numbers, each over at most ``size`` words."""
    n, width = n_words - gram + 1, size - gram + 1
    parts = max(1, -(-n // width))
    return [(n * i // parts, n * (i + 1) // parts) for i in range(parts)]


def _numbered(index: Index):
    """Token -> word number, -1 for a word outside the index, -2 for marks alone."""

    class Numbers(dict):
        def __missing__(self, token):
            word = _MARKS.sub("", token.lower())
            found = index.word_ids.get(word, -1) if word else -2
            if len(token) <= 64:
                if len(self) >= MAX_CACHED:
                    self.clear()
                self[token] = found
            return found

    return Numbers()


def passage_hits(ids: np.ndarray, index: Index, threshold: float, overlap: float) -> list[tuple]:
    """(item, passage start, score, question overlap, answer overlap) of one text's word numbers; each item's best passage that verifies."""
    terms = index.terms_at(ids)
    at = np.flatnonzero(terms >= 0)
    if not len(at):
        return []
    upper = np.zeros(len(terms) + 1)
    upper[1:][at] = index.upper[terms[at]]
    upper = np.cumsum(upper)
    starts = np.arange(0, max(1, len(ids) - SEGMENT), SEGMENT)
    ends = np.minimum(starts + 2 * SEGMENT - index.gram + 1, len(terms))
    above = defaultdict(dict)  # every passage above the threshold: the best one need not hold the whole item
    for a, b in zip(starts, ends):
        if upper[b] - upper[a] < threshold - 1e-9:
            continue
        inside = sorted(set(terms[a:b].tolist()) - {-1})
        for segment, score in index.search(inside, threshold):
            item = index.owner[segment]
            above[item][int(a)] = max(score, above[item].get(int(a), 0.0))
    found = []
    for item, passages in above.items():
        item_id, head, tail = index.items[item]
        reach = SEGMENT + len(head | tail)
        numbers = [np.array([index.number_of(k) for k in part]) for part in (head, tail)]
        for a, score in sorted(passages.items(), key=lambda x: (-x[1], x[0])):
            near = terms[max(0, a - reach):a + 2 * SEGMENT + reach]
            q, r = (float(np.isin(part, near).mean()) for part in numbers)
            if q >= overlap and r >= overlap:
                found.append((item_id, a, score, q, r))
                break
    return found


def _search(batches, index: Index, threshold: float, overlap: float):
    numbers = _numbered(index)
    for batch in batches:
        out = []
        for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            tokens = text.as_py().split()
            ids = np.fromiter(map(numbers.__getitem__, tokens), np.int64, len(tokens))
            for hit in passage_hits(ids[ids != -2], index, threshold, overlap):
                out.append((doc_id, *hit))
        if out:
            kinds = [pa.int64()] * 3 + [pa.float64()] * 3
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)],
                                             names=[x.split()[0] for x in HIT_SCHEMA.split(", ")])


def _item_terms(batches, gram: int):
    """Per task: in how many segments each term occurs, under the empty key the segments and their terms."""
    for batch in batches:
        df, n, total = Counter(), 0, 0
        for text in batch.column(0):
            words, _ = question_and_answer(text.as_py())
            keys = grams(words, gram)
            if not keys:
                continue
            for a, b in segment_bounds(len(words), gram):
                df.update({" ".join(k) for k in keys[a:b]})
                n, total = n + 1, total + b - a
        df[""], df[" "] = n, total
        yield pa.RecordBatch.from_arrays([pa.array(list(df)), pa.array(list(df.values()), pa.int64())], names=["term", "n"])


def item_blocks(items: DataFrame, gram: int = GRAM, block_bytes: int = BLOCK_BYTES) -> list[Index]:
    """Indexes over all items, each over at most about ``block_bytes`` of item text."""
    rows = items.select(F.col("item_id").cast("long").alias("item_id"), text_or_empty().alias("text"))
    df = (rows.select("text").mapInArrow(lambda b: _item_terms(b, gram), "term string, n long")
          .groupBy("term").agg(F.sum("n").alias("n")))
    totals = dict(df.filter(F.col("term").isin("", " ")).collect())
    if not totals.get(""):
        return []
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0]
    blocks = max(1, -(-size // block_bytes))
    indexes = []
    for k in range(blocks):
        own = rows.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == k)
        block = [(r["item_id"], r["text"]) for r in own.collect()]  # about block_bytes of text
        used = own.select("text").mapInArrow(lambda b: _item_terms(b, gram), "term string, n long").select("term").distinct()
        counts = {tuple(r["term"].split(" ")): r["n"] for r in df.join(used, "term").filter(F.length(F.trim("term")) > 0).collect()}
        indexes.append(Index(sorted(block, key=lambda x: (x[0] is None, x[0], x[1])), totals[""], totals[" "] / totals[""], counts, gram))
    return indexes


def find_leaks(docs: DataFrame, items: DataFrame, threshold: float = THRESHOLD, overlap: float = OVERLAP) -> DataFrame:
    """One row per document and test item that it holds."""
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    out = spark.createDataFrame([], HIT_SCHEMA)
    for k, index in enumerate(item_blocks(items)):
        found = rows.mapInArrow(lambda b, s=index: tidied(_search(b, s, threshold, overlap)), HIT_SCHEMA)
        out = out.unionByName(found) if k else found
    return out


def drop_leaks(docs: DataFrame, items: DataFrame, threshold: float = THRESHOLD, overlap: float = OVERLAP) -> DataFrame:
    """The documents, all columns unchanged, that hold no test item."""
    name = free_name("searched_text", docs)
    out = docs.withColumn(name, text_or_empty())
    for index in item_blocks(items):
        out = out.mapInArrow(lambda b, s=index: tidied(_clean(b, s, threshold, overlap)), out.schema)
    return out.drop(name)


def _clean(batches, index: Index, threshold: float, overlap: float):
    numbers = _numbered(index)
    for batch in batches:
        keep = []
        for text in batch.column(batch.num_columns - 1):
            tokens = text.as_py().split()
            ids = np.fromiter(map(numbers.__getitem__, tokens), np.int64, len(tokens))
            keep.append(not passage_hits(ids[ids != -2], index, threshold, overlap))
        yield batch.filter(pa.array(keep, pa.bool_()))


by_value(__name__)
