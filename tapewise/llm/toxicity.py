"""Toxicity scores by a factorization machine over hashed terms.

Terms are words (without marks at their ends) and their prefixes of
``PREFIXES`` characters, hashed to ``HASH_BITS`` bits, so inflected forms share a term.  The
model is ``b + sum(w_i) + sum_{i<j} <v_i, v_j>`` over a text's distinct terms:
pairs of terms carry weight that neither has alone.

Learning is bounded and documented: at most about ``SAMPLE_ROWS`` labelled
documents (chosen by a hash of the id, none with crc32(doc_id) mod 5 = 0) are
counted on the executors, the ``TERMS`` hashed terms with the largest
chi-square against the label become features, and the sample's short feature
lists train the machine on the driver by full-batch Adam.  Every whole text is
then scored by a map over the table, without a shuffle.

Nulls: a null or empty text has no terms and gets the model's base score.  A
null ``doc_id`` is not held out and teaches nothing.  Documents labelled more
than once teach once per label; repeated rows are scored each.  Without any
usable label every score is 0.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tapewise.llm.common import by_value, free_name, text_or_empty, tidied

SAMPLE_ROWS = 30_000
HASH_BITS = 22
PREFIXES = (4, 5)
TERMS = 2048
FACTORS = 4
STEPS = 250
MAX_CACHED = 600_000

_EDGES = re.compile(r"^[\W_]+|[\W_]+$")


def is_held_out(doc_id: str = "doc_id") -> Column:
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def hashed_terms(token: str) -> tuple[int, ...]:
    """Hashed terms of one white-space separated token."""
    word = _EDGES.sub("", token.lower())
    if not word:
        return ()
    terms = [word] + [f"{word[:k]}~{k}" for k in PREFIXES if len(word) > k]
    return tuple(zlib.crc32(t.encode()) & ((1 << HASH_BITS) - 1) for t in terms)


class TermLookup(dict):
    """Token -> its terms, by way of ``pick`` (kept per task; starts afresh beyond MAX_CACHED)."""

    def __init__(self, pick):
        super().__init__()
        self.pick = pick

    def __missing__(self, token: str):
        found = self.pick(hashed_terms(token))
        if len(token) <= 64:
            if len(self) >= MAX_CACHED:
                self.clear()
            self[token] = found
        return found

    def of(self, text: str) -> set:
        found = set(map(self.__getitem__, text.split()))
        return set().union(*found)


def _count(batches):
    """Per task: in how many sampled documents of each label a term occurs."""
    lookup, counts = TermLookup(lambda t: t), (Counter(), Counter())
    for batch in batches:
        for label, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            counts[label].update(lookup.of(text.as_py()))
    terms = sorted(counts[0].keys() | counts[1].keys())
    yield pa.RecordBatch.from_arrays([pa.array(terms, pa.int64()), *(pa.array([c[t] for t in terms], pa.int64()) for c in counts)],
                                     names=["term", "n0", "n1"])


def _features(batches, numbers: dict):
    lookup = TermLookup(lambda t: tuple(numbers[x] for x in t if x in numbers))
    for batch in batches:
        found = [sorted(lookup.of(x.as_py())) for x in batch.column(1)]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.list_(pa.int32()))], names=["label", "terms"])


class Machine:
    """A factorization machine with binary inputs."""

    def __init__(self, terms: list[int], bias: float, w: np.ndarray, v: np.ndarray):
        self.terms, self.bias, self.w, self.v = terms, bias, w, v

    def score(self, rows: list) -> np.ndarray:
        """Probability for each list of feature numbers."""
        sizes = np.array([len(r) for r in rows], np.int64)
        flat = np.fromiter((i for r in rows for i in r), np.int64, int(sizes.sum()))
        doc = np.repeat(np.arange(len(rows)), sizes)
        return 1 / (1 + np.exp(-margins(flat, doc, len(rows), self.bias, self.w, self.v)[0]))


def margins(flat, doc, n, bias, w, v):
    total = np.stack([np.bincount(doc, v[flat, f], n) for f in range(v.shape[1])], 1)
    square = np.stack([np.bincount(doc, v[flat, f] ** 2, n) for f in range(v.shape[1])], 1)
    return bias + np.bincount(doc, w[flat], n) + 0.5 * (total ** 2 - square).sum(1), total


def train(rows: list, labels: np.ndarray, terms: list[int], factors: int = FACTORS, steps: int = STEPS,
          rate: float = 0.05, l2: float = 2e-5, seed: int = 3) -> Machine:
    """Full-batch Adam on the mean log loss with an L2 penalty."""
    n, m = len(rows), len(terms)
    sizes = np.array([len(r) for r in rows], np.int64)
    flat = np.fromiter((i for r in rows for i in r), np.int64, int(sizes.sum()))
    doc = np.repeat(np.arange(n), sizes)
    y = labels.astype(float)
    share = min(max(y.mean(), 1e-3), 1 - 1e-3)
    params = [np.array([np.log(share / (1 - share))]), np.zeros(m), np.random.default_rng(seed).normal(0, 0.02, (m, factors))]
    first, second = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    for step in range(1, steps + 1):
        bias, w, v = params
        z, total = margins(flat, doc, n, bias[0], w, v)
        g = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - y) / n
        gd = g[doc]
        gv = np.stack([np.bincount(flat, gd * (total[doc, f] - v[flat, f]), m) for f in range(factors)], 1)
        grads = [np.array([g.sum()]), np.bincount(flat, gd, m) + l2 * w, gv + l2 * v]
        for p, d, a, b in zip(params, grads, first, second):
            a += 0.1 * (d - a)
            b += 0.01 * (d * d - b)
            p -= rate * (a / (1 - 0.9 ** step)) / (np.sqrt(b / (1 - 0.99 ** step)) + 1e-8)
    return Machine(terms, float(params[0][0]), params[1], params[2])


def fit(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS, terms: int = TERMS) -> Machine:
    """Learn from labelled documents (doc_id, toxic) outside the held-out fold."""
    known = labels.filter(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull() & ~is_held_out())
    known = known.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("label"))
    share = sample_rows / max(1, known.count())
    if share < 1:
        known = known.filter(F.pmod(F.xxhash64(F.lit("toxicity"), "doc_id"), F.lit(1 << 30)) < int(share * (1 << 30)))
    # the sample's size is set by sample_rows, so its ids can be sent to every task
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text")) \
        .join(F.broadcast(known), "doc_id").select("label", "text")
    counts = rows.mapInArrow(lambda b: tidied(_count(b)), "term long, n0 long, n1 long").groupBy("term").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1"))
    n0, n1 = (int(known.filter(F.col("label") == k).count()) for k in (0, 1))
    if not n0 or not n1:
        return Machine([], -30.0, np.zeros(0), np.zeros((0, FACTORS)))
    a, b = F.col("n1").cast("double"), F.col("n0").cast("double")
    chi = (a * n0 - b * n1) ** 2 / ((a + b) * (n0 + n1 - a - b + 1))
    best = counts.filter("n0 + n1 >= 3").select("term", chi.alias("chi")).orderBy(F.desc("chi"), "term").limit(terms).collect()
    numbers = {r["term"]: i for i, r in enumerate(best)}
    sample = rows.mapInArrow(lambda b: _features(b, numbers), "label int, terms array<int>").toArrow()
    return train(sample.column("terms").to_pylist(), sample.column("label").to_numpy(), [r["term"] for r in best])


def _score(batches, machine: Machine, keep: float | None, text: str = "__text"):
    numbers = {t: i for i, t in enumerate(machine.terms)}
    lookup = TermLookup(lambda t: tuple(numbers[x] for x in t if x in numbers))
    for batch in batches:
        scores = machine.score([lookup.of(x.as_py()) for x in batch.column(text)])
        out = batch.drop_columns([text])
        if keep is not None:
            yield out.filter(pa.array(scores < keep))
        else:
            yield pa.RecordBatch.from_arrays([*out.columns, pa.array(scores)], names=[*out.schema.names, "score"])


def score(docs: DataFrame, machine: Machine) -> DataFrame:
    """doc_id, held_out, score and predicted of every whole text."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), is_held_out().alias("held_out"), text_or_empty().alias("__text"))
    found = rows.mapInArrow(lambda b: tidied(_score(b, machine, None)), "doc_id long, held_out boolean, score double")
    return found.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def drop_toxic(docs: DataFrame, machine: Machine, threshold: float = 0.5) -> DataFrame:
    """The documents, all columns unchanged, whose score is below the threshold."""
    name = free_name("scored_text", docs)
    rows = docs.withColumn(name, text_or_empty())
    return rows.mapInArrow(lambda b: tidied(_score(b, machine, threshold, name)), docs.schema)


by_value(__name__)
