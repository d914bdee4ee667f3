"""N-gram Jaccard join with multiple-global-order prefix filtering.

A text's set holds the 64-bit hashes of its distinct word shingles.  Under any
global order of tokens, two sets with Jaccard similarity ``t`` or more share a
token among their first ``n - ceil(t * n) + 1`` tokens.  Three orders are used:
ascending and descending hash and a permuted hash, each with frequent tokens
last, by rising class of frequency, so that boilerplate is in no prefix unless
a text has little else.

1. Texts with equal sets are one node; one representative goes on.
2. *Stars*: representatives with the same least token under one of four plain
   hash orders are compared with the one of them that holds the largest share
   of frequent tokens (in a group of near copies that is the one closest to
   all others); verified links form components.
3. *Prefix indexes*: the prefix tokens under the first and second order are
   dealt to buckets as packed arrays.  A node that shares a token with a larger
   component probes that component; only probes found under **both** orders
   go on, and a pair must also share a prefix token under the third.
4. Remaining pairs are verified on their whole sets; the links of both steps
   give the components.

A token that more than ``LARGE`` components share under the first order lists
no pairs: its nodes form a group, dealt into squares of ``SQUARE`` by
``SQUARE`` texts, and each square is verified at once by multiplying its
token matrices.  Under the second order such a token lets all its nodes pass.
Pairs inside one component are never listed, and a square returns only links
that join components, so thousands of near copies give rows by their number,
not its square.  All groups are dealt in chunks of bounded size.  Which tokens count as frequent changes the work, never the
result.

Nulls and texts without words have empty sets and link with nothing; fewer
words than a shingle form one shingle.  Repeated rows are equal sets.  Rows
with a null ``doc_id`` are returned unlinked, with a null component.  An empty
table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tapewise.llm.common import by_value, checkpointed, free_name, freed, materialize, scratch, tidied, worker_state
from tapewise.llm.components import components

WIDTH = 5
PERCENT = 80
#: Tokens put last in every order: at most this many, each near the front of at least LEAST_FREQUENT texts.
MOST_FREQUENT = 1 << 20
LEAST_FREQUENT = 5
CHUNK = 128
LARGE = 16
SQUARE = 512
SLAB = 8192
BUCKET_TOKENS = 1_000_000
#: Greatest number of ids sent to every task; beyond it the texts are shuffled to the ids.
BROADCAST_IDS = 1_000_000
#: Bytes of text hashed at a time.
SLAB_BYTES = 1 << 20

U = np.uint64
FACTOR = U(0x9E3779B97F4A7C15)
PERMUTE = U(0xD6E8FEB86659FD93)
BASE = 0xD1342543DE82EF95


def _byte_values() -> np.ndarray:
    """A 64-bit value for each byte, the same for a letter in either case; 0 for the six ASCII blanks."""
    values = np.array([xxhash.xxh3_64_intdigest(bytes([x]).lower()) | 1 for x in range(256)], U)
    values[list(b" \t\n\v\f\r")] = 0
    return values


def _powers(base: int, n: int) -> np.ndarray:
    """``base ** 0 .. base ** (n - 1)`` modulo 2 ** 64."""
    out = np.full(n, base, U)
    out[0] = 1
    return np.multiply.accumulate(out)


def _tables(n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Byte values, and powers of BASE and of its inverse for at least ``n`` positions."""
    state = worker_state("jaccard")
    found = getattr(state, "jaccard_tables", None)
    if found is None or len(found[1]) < n:
        size = max(n, 2 * SLAB_BYTES)
        tables = _byte_values(), _powers(BASE, size), _powers(pow(BASE, -1, 1 << 64), size)
        if n > 2 * SLAB_BYTES:  # one very long text: not kept
            return tables
        state.jaccard_tables = found = tables
    return found


def word_hashes(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Hashes and first bytes of the words of ``data``: a polynomial in each word's bytes, A-Z as a-z, then mixed."""
    if not data:
        return np.zeros(0, U), np.zeros(0, "i8")
    values, powers, inverses = _tables(len(data))
    cells = values[np.frombuffer(data, "u1")]
    inside = cells != 0
    starts = np.flatnonzero(inside[1:] & ~inside[:-1]) + 1
    if inside[0]:
        starts = np.concatenate(([0], starts))
    if not len(starts):
        return np.zeros(0, U), starts
    cells *= powers[:len(cells)]
    hashed = np.add.reduceat(cells, starts) * inverses[starts]  # the blanks after a word add nothing
    hashed = (hashed ^ (hashed >> U(31))) * PERMUTE
    return hashed ^ (hashed >> U(30)), starts


def _combined(hashed: np.ndarray, width: int) -> np.ndarray:
    """Hash of each run of ``width`` words."""
    n = len(hashed) - width + 1
    out = np.full(max(0, n), width, U)
    for k in range(width if n > 0 else 0):
        out = (out ^ hashed[k:k + n]) * FACTOR
        out ^= out >> U(29)
    out = (out ^ (out >> U(32))) * PERMUTE
    return out ^ (out >> U(32))


def _slabs(texts):
    """Lists of consecutive texts of about SLAB_BYTES; a longer text is alone."""
    held, size = [], 0
    for text in texts:
        text = text or b""
        if held and size + len(text) > SLAB_BYTES:
            yield held
            held, size = [], 0
        held.append(text)
        size += len(text)
    if held:
        yield held


def shingle_sets(texts, width: int = WIDTH):
    """Sorted distinct shingle hashes of each text; texts are hashed many at a time."""
    for slab in _slabs(texts):
        hashed, starts = word_hashes(b" ".join(slab))
        edges = np.searchsorted(starts, np.cumsum([0] + [len(x) + 1 for x in slab])).tolist()
        runs = _combined(hashed, width)
        for a, b in zip(edges[:-1], edges[1:]):
            if b - a < 2:
                yield _combined(hashed[a:b], 1) if b > a else np.zeros(0, U)
                continue
            out = runs[a:b - width + 1].copy() if b - a >= width else _combined(hashed[a:b], b - a)
            out.sort()
            yield out[np.concatenate(([True], out[1:] != out[:-1]))]


def shingles(text: bytes | None, width: int = WIDTH) -> np.ndarray:
    """Sorted distinct shingle hashes of one text."""
    return next(shingle_sets([text], width))


def linked(a: np.ndarray, b: np.ndarray, percent: int = PERCENT) -> bool:
    """Exact test on sorted distinct sets."""
    if 100 * min(len(a), len(b)) < percent * max(len(a), len(b)) or not len(a):
        return False
    both = np.concatenate((a, b))
    both.sort()
    common = int((both[1:] == both[:-1]).sum())
    return 100 * common >= percent * (len(a) + len(b) - common)


def shares_one(a: np.ndarray, b: np.ndarray) -> bool:
    """Whether two sorted sets have a common token."""
    place = np.minimum(np.searchsorted(b, a), len(b) - 1)
    return bool((b[place] == a).any())


def prefix_length(n: int, percent: int = PERCENT) -> int:
    return n - -(-percent * n // 100) + 1 if n else 0


def permuted(tokens: np.ndarray) -> np.ndarray:
    x = (tokens ^ (tokens >> U(31))) * PERMUTE
    return x ^ (x >> U(29))


class Frequent:
    """Frequent tokens (their first 40 bits, sorted) and the class of each: the binary logarithm of its count."""

    def __init__(self, tokens: np.ndarray, counts: np.ndarray):
        by = np.argsort(tokens)
        self.tokens, self.classes = tokens[by], np.log2(np.maximum(counts[by], 1)).astype("u1") + 1

    def classes_of(self, tokens: np.ndarray) -> np.ndarray:
        """0 for tokens that are not frequent."""
        if not len(self.tokens) or not len(tokens):
            return np.zeros(len(tokens), "u1")
        short = tokens >> U(24)
        place = np.minimum(np.searchsorted(self.tokens, short), len(self.tokens) - 1)
        return np.where(self.tokens[place] == short, self.classes[place], 0).astype("u1")


def prefix(tokens: np.ndarray, classes: np.ndarray, order: int, percent: int = PERCENT) -> np.ndarray:
    """The prefix of a sorted set under one of the three orders, each by class first."""
    p = prefix_length(len(tokens), percent)
    rare = tokens[classes == 0]
    if order == 1:
        rare = rare[::-1]
    elif order == 2:
        rare = rare[np.argsort(permuted(rare), kind="stable")]
    if len(rare) >= p:
        return rare[:p]
    late, c = tokens[classes > 0], classes[classes > 0]
    key = late if order == 0 else ~late if order == 1 else permuted(late)
    return np.concatenate((rare, late[np.lexsort((key, c))][:p - len(rare)]))


def _texts(column):
    """The UTF-8 bytes of each text of an Arrow column; None for nulls."""
    for x in column.cast(pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()):
        yield x.as_py()


def _fronts(batches, buckets: int, percent: int):
    """Tokens near either end of each set, a little beyond its plain prefixes, packed by bucket."""
    for batch in batches:
        held = []
        for tokens in shingle_sets(_texts(batch.column(0))):
            q = prefix_length(len(tokens), percent) * 13 // 10 + 1
            held += [tokens] if 2 * q >= len(tokens) else [tokens[:q], tokens[-q:]]
        if held:
            tokens = np.concatenate(held) >> U(24)
            by, edges, bucket = by_bucket(tokens, buckets)
            tokens = tokens[by]
            yield pa.RecordBatch.from_arrays([pa.array(bucket.astype("i4")), pa.array([packed(tokens[a:b] << U(24)) for a, b in edges], pa.binary())],
                                             names=["bucket", "tokens"])


def by_bucket(tokens: np.ndarray, buckets: int):
    """Sorting positions by (bucket, token), the ranges of the buckets, and their numbers."""
    bucket = ((tokens * FACTOR) >> U(40)) % U(buckets)
    by = np.lexsort((tokens, bucket))
    bucket = bucket[by]
    starts = np.flatnonzero(np.concatenate((np.ones(min(1, len(bucket)), bool), bucket[1:] != bucket[:-1])))
    return by, list(zip(starts, [*starts[1:], len(bucket)])), bucket[starts]


def _counted(pdf: pd.DataFrame) -> pd.DataFrame:
    tokens, n = np.unique(np.concatenate([unpacked(x) for x in pdf["tokens"]]), return_counts=True)
    many = n >= LEAST_FREQUENT
    return pd.DataFrame({"token": tokens[many].astype("i8"), "n": n[many].astype("i8")})


SET_SCHEMA = ("doc_id long, n_shingles long, same binary, share double, first1 long, first2 long, first3 long, first4 long, "
              "prefix1 binary, prefix2 binary")


def _describe(batches, frequent: Frequent, percent: int):
    """Per text: set size, a 128-bit hash of its set, share of frequent tokens, least tokens, and two prefixes of 40-bit tokens."""
    names = [x.split()[0] for x in SET_SCHEMA.split(", ")]
    for batch in batches:
        out = [[] for _ in names[1:]]
        for tokens in shingle_sets(_texts(batch.column(1))):
            classes = frequent.classes_of(tokens)
            row = [len(tokens), None, 0.0, None, None, None, None, b"", b""]
            if len(tokens):
                mixed = permuted(tokens)
                again = permuted(mixed)
                firsts = (tokens[0], tokens[-1], tokens[np.argmin(mixed)], tokens[np.argmin(again)])
                row = [len(tokens), xxhash.xxh3_128_digest(tokens.tobytes()), float((classes > 0).mean()), *(int(x.view("i8")) for x in firsts),
                       packed(prefix(tokens, classes, 0, percent)), packed(prefix(tokens, classes, 1, percent))]
            for column, value in zip(out, row):
                column.append(value)
        kinds = [pa.int64(), pa.binary(), pa.float64(), *[pa.int64()] * 4, pa.binary(), pa.binary()]
        yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, k) for c, k in zip(out, kinds))], names=names)


def packed(tokens: np.ndarray) -> bytes:
    """Five bytes a token (equal tokens stay equal; chance equals are removed by the verification)."""
    return (tokens >> U(24)).astype("<u8").view("u1").reshape(-1, 8)[:, :5].tobytes()


def unpacked(data: bytes) -> np.ndarray:
    cells = np.zeros((len(data) // 5, 8), "u1")
    cells[:, :5] = np.frombuffer(data, "u1").reshape(-1, 5)
    return cells.view("<u8").ravel()


#: Component and weight are stored for the nodes in ``joined`` only; any other node is its own component.
PACKET_PARTS = ["bucket", "tokens", "owners", "nodes", "sizes", "joined", "comps", "weights"]
PACKET_SCHEMA = "ord int, bucket int, " + ", ".join(f"{x} binary" for x in PACKET_PARTS[1:])


def _deal(batches, buckets: int):
    """Prefix tokens of a batch of nodes, as one packed row for each order and bucket."""
    for batch in batches:
        node, comp, weight, size = (batch.column(k).to_numpy() for k in range(4))
        for order in (0, 1):
            lists = [unpacked(x.as_py()) for x in batch.column(4 + order)]
            if not lists:
                continue
            tokens = np.concatenate(lists)
            owner = np.repeat(np.arange(len(lists)), [len(x) for x in lists])
            by, edges, bucket = by_bucket(tokens, buckets)
            tokens, owner = tokens[by], owner[by].astype("<u4")
            rows = [[] for _ in PACKET_PARTS]
            for (a, b), number in zip(edges, bucket):
                own, local = np.unique(owner[a:b], return_inverse=True)
                joined = np.flatnonzero(weight[own] > 1)
                values = (int(number), packed(tokens[a:b] << U(24)), local.astype("<u2" if len(own) < 65536 else "<u4").tobytes(),
                          node[own].astype("<i8").tobytes(), size[own].astype("<u4").tobytes(), joined.astype("<u4").tobytes(),
                          *(x[own][joined].astype("<i8").tobytes() for x in (comp, weight)))
                for column, value in zip(rows, values):
                    column.append(value)
            kinds = [pa.int32()] + [pa.binary()] * (len(rows) - 1)
            yield pa.RecordBatch.from_arrays([pa.array([order] * len(rows[0]), pa.int32()), *(pa.array(c, k) for c, k in zip(rows, kinds))],
                                             names=["ord", *PACKET_PARTS])


def _probes(key, pdf: pd.DataFrame, percent: int) -> pd.DataFrame:
    """Of one bucket, the probes (kind 0) and the members of large groups (kind 1).

    A probe is a node and a component: they share a token, and a member's size fits.

    Of two components the probe goes from the smaller one, so each pair is searched once.
    """
    tokens, nodes, comps, weights, sizes = [], [], [], [], []
    for t, o, own, size, joined, comp, weight in zip(*(pdf[x] for x in PACKET_PARTS[1:])):
        found, own = unpacked(t), np.frombuffer(own, "<i8")
        local = np.frombuffer(o, "<u2" if len(o) == 2 * len(found) else "<u4")
        joined, own_comp, own_weight = np.frombuffer(joined, "<u4"), own.copy(), np.ones(len(own), "i8")
        own_comp[joined], own_weight[joined] = np.frombuffer(comp, "<i8"), np.frombuffer(weight, "<i8")
        tokens.append(found)
        for kept, side in zip((nodes, comps, weights, sizes), (own, own_comp, own_weight, np.frombuffer(size, "<u4").astype("i8"))):
            kept.append(side[local])
    tokens, nodes, comps, weights, sizes = (np.concatenate(x) for x in (tokens, nodes, comps, weights, sizes))
    # rank 0 is the largest component
    by = np.lexsort((comps, -weights))
    ranked = comps[by][np.concatenate(([True], (comps[by][1:] != comps[by][:-1])))]
    sorter = np.argsort(ranked)
    rank = sorter[np.searchsorted(ranked, comps, sorter=sorter)]
    by = np.lexsort((nodes, rank, tokens))
    tokens, nodes, rank, sizes = tokens[by], nodes[by], rank[by], sizes[by]
    starts = np.flatnonzero(np.concatenate(([True], tokens[1:] != tokens[:-1])))
    ends = np.append(starts[1:], len(tokens))
    mixed = rank[starts] != rank[ends - 1]
    out, held, large = [], 0, []
    for a, b in zip(starts[mixed], ends[mixed]):
        ranks, n = rank[a:b], sizes[a:b]
        if 1 + int((ranks[1:] != ranks[:-1]).sum()) > LARGE:
            large.append(np.stack((np.full(b - a, nodes[a]), nodes[a:b], ranks)))
            if len(large) >= 500:
                large = [np.unique(np.concatenate(large, 1), axis=1)]
            continue
        least, most = 100 * n, percent * n
        for node, own, size in zip(nodes[a:b], ranks, n):
            end = np.searchsorted(ranks, own)  # the larger components come first
            larger = np.unique(ranks[:end][(least[:end] >= percent * size) & (most[:end] <= 100 * size)])
            if len(larger):
                out.append(np.stack((np.full(len(larger), node), larger)))
                held += len(larger)
        if held > 2_000_000:
            out = [np.unique(np.concatenate(out, 1), axis=1)]
            held = 0
    found = np.unique(np.concatenate(out, 1), axis=1) if out else np.zeros((2, 0), "i8")
    probes = pd.DataFrame({"ord": key[0], "kind": 0, "g": ranked[found[1]], "node": found[0], "comp": 0})
    group = np.unique(np.concatenate(large, 1), axis=1) if large else np.zeros((3, 0), "i8")
    if key[0]:
        group = np.unique(group * np.array([[0], [1], [1]]), axis=1)
    groups = pd.DataFrame({"ord": key[0], "kind": 1, "g": group[0], "node": group[1], "comp": ranked[group[2]]})
    return pd.concat([probes, groups], ignore_index=True).astype({"ord": "int32", "kind": "int32"})


def _verify(pdf: pd.DataFrame, percent: int, frequent: Frequent) -> pd.DataFrame:
    """Links between the probes and the members of one chunk of a group."""
    order = pdf.sort_values("doc_id", kind="stable")
    once = order.drop_duplicates("doc_id")
    sets = {doc: (tokens, np.sort(prefix(tokens, frequent.classes_of(tokens), 2, percent)))
            for doc, tokens in zip(once["doc_id"], shingle_sets(once["text"]))}
    probes = [d for d, p in zip(order["doc_id"], order["probe"]) if p]
    members = [d for d, p in zip(order["doc_id"], order["probe"]) if not p]
    out = []
    for x in probes:
        a, first = sets[x]
        for y in members:
            b, other = sets[y]
            if x != y and 100 * min(len(a), len(b)) >= percent * max(len(a), len(b)) and \
                    shares_one(first, other) and linked(a, b, percent):
                out.append((x, y))
    return pd.DataFrame(out, columns=["a", "b"]).astype("int64")


def _chunks(rows: DataFrame, name: str) -> DataFrame:
    """Number of chunks of each group: ceil(rows / CHUNK)."""
    return rows.groupBy("g").agg(F.ceil(F.count(F.lit(1)) / CHUNK).cast("int").alias(name))


def verified_links(texts: DataFrame, probes: DataFrame, members: DataFrame, percent: int, frequent: Frequent) -> DataFrame:
    """Exact links (a, b) between the probes and members, both (g, doc_id), of each group.

    Groups meet in squares of at most about CHUNK by CHUNK texts.
    """
    probes, members = probes.distinct(), members.distinct()
    counts = _chunks(probes, "np").join(_chunks(members, "nm"), "g")

    def dealt(rows, own, other, probe):
        place = F.pmod(F.xxhash64(F.lit(own), "doc_id"), F.col(own)).cast("int")
        copies = F.explode(F.sequence(F.lit(0), F.col(other) - 1))
        found = rows.join(counts, "g").select("g", "doc_id", place.alias("own"), copies.alias("other"))
        pick = ("own", "other") if probe else ("other", "own")
        return found.select("g", F.col(pick[0]).alias("cp"), F.col(pick[1]).alias("cm"), "doc_id", F.lit(probe).alias("probe"))

    rows = materialize(dealt(probes, "np", "nm", True).unionByName(dealt(members, "nm", "np", False)), "jaccard-groups")
    filled = rows.join(involved(texts, rows), "doc_id").select("g", "cp", "cm", "doc_id", "probe", F.col("text").cast("binary").alias("text"))
    found = filled.groupBy("g", "cp", "cm").applyInPandas(lambda pdf: freed(_verify(pdf, percent, frequent)), "a long, b long")
    return materialize(found.distinct(), "jaccard-links")


def _square(pdf: pd.DataFrame, percent: int) -> pd.DataFrame:
    """Links that join components between the two chunks of one square."""
    pdf = pdf.sort_values("doc_id", kind="stable").drop_duplicates("doc_id")
    sets = list(shingle_sets(pdf["text"]))
    sizes = np.array([len(x) for x in sets])
    own, docs, comps = pdf["own"].to_numpy(), pdf["doc_id"].to_numpy(), pdf["comp"].to_numpy()
    rows, cols = (np.flatnonzero(own == pdf[k].iloc[0]) for k in ("ca", "cb"))
    if not len(rows) or not len(cols):
        return pd.DataFrame({"a": [], "b": []}, dtype="int64")
    tokens, number, n = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    owner = np.repeat(np.arange(len(sets)), sizes)
    several = n[number] > 1
    number, owner = (np.cumsum(n > 1) - 1)[number[several]], owner[several]
    by = np.argsort(number, kind="stable")
    number, owner = number[by], owner[by]
    common = np.zeros((len(rows), len(cols)), np.float32)
    for a in range(0, int((n > 1).sum()), SLAB):
        low, high = np.searchsorted(number, (a, a + SLAB))
        cells = np.zeros((len(sets), SLAB), np.float32)
        cells[owner[low:high], number[low:high] - a] = 1
        common += cells[rows] @ cells[cols].T
    union = sizes[rows][:, None] + sizes[cols][None, :] - common
    found = (100 * common >= percent * union) & (common > 0) & (comps[rows][:, None] != comps[cols][None, :])
    parent: dict = {}

    def root(x):
        while parent.get(x, x) != x:
            x = parent[x]
        return x

    out = []
    for i, j in zip(*np.nonzero(found)):
        x, y = root(comps[rows[i]]), root(comps[cols[j]])
        if x != y:
            parent[max(x, y)] = min(x, y)
            out.append((docs[rows[i]], docs[cols[j]]))
    return pd.DataFrame(out, columns=["a", "b"]).astype("int64")


def links_in_groups(texts: DataFrame, groups: DataFrame, percent: int) -> DataFrame:
    """Exact links (a, b) between different components of each group (g, doc_id, comp)."""
    counts = groups.groupBy("g").agg(F.ceil(F.count(F.lit(1)) / SQUARE).cast("int").alias("n"))
    dealt = groups.join(counts, "g").withColumn("own", F.pmod(F.xxhash64("doc_id"), F.col("n")).cast("int"))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("n") - 1)))
    rows = materialize(dealt.select("g", F.least("own", "other").alias("ca"), F.greatest("own", "other").alias("cb"), "own", "doc_id", "comp"),
                       "jaccard-squares")
    filled = rows.join(involved(texts, rows), "doc_id").select("g", "ca", "cb", "own", "comp", "doc_id", F.col("text").cast("binary").alias("text"))
    found = filled.groupBy("g", "ca", "cb").applyInPandas(lambda pdf: freed(_square(pdf, percent)), "a long, b long")
    return materialize(found.distinct(), "jaccard-links")


def involved(texts: DataFrame, rows: DataFrame) -> DataFrame:
    """The texts, cut down to the ids in ``rows`` before any shuffle where those are few enough to send to every task."""
    ids = checkpointed(rows.select("doc_id").distinct())
    return texts.join(F.broadcast(ids), "doc_id", "left_semi") if ids.count() <= BROADCAST_IDS else texts


def jaccard_components(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles and component_id of every document."""
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(2, size // (10 * BUCKET_TOKENS) + 1)  # a word takes about five bytes, a front about half a set
    counted = (rows.select("text").mapInArrow(lambda b: tidied(_fronts(b, buckets, percent)), "bucket int, tokens binary")
               .groupBy("bucket").applyInPandas(_counted, "token long, n long"))
    # at most MOST_FREQUENT tokens
    often = counted.orderBy(F.desc("n"), "token").limit(MOST_FREQUENT).toArrow()
    frequent = Frequent(often.column("token").to_numpy().astype("i8").view(U), often.column("n").to_numpy())
    path = scratch(spark, "jaccard-sets")
    rows.mapInArrow(lambda b: tidied(_describe(b, frequent, percent)), SET_SCHEMA).write.parquet(path)
    sets = spark.read.schema(SET_SCHEMA).parquet(path)

    # texts with equal sets: one representative each (ids repeat if rows do)
    some = sets.filter("n_shingles > 0 and doc_id is not null")
    nodes = some.groupBy("same").agg(F.min("doc_id").alias("node"))
    nodes = materialize(some.select("doc_id", "same").distinct().join(nodes, "same").select("doc_id", "node"), "jaccard-nodes")
    alone = nodes.filter("doc_id = node").select("node").distinct()
    texts = rows.filter("doc_id is not null")

    # stars
    firsts = F.explode(F.array(*[F.struct(F.lit(k).alias("k"), F.col(f"first{k}").alias("t")) for k in (1, 2, 3, 4)])).alias("f")
    seen = some.select(F.col("doc_id").alias("node"), "share", firsts).join(alone, "node", "left_semi").select("node", "share", "f")
    best = F.max(F.struct("share", (-F.col("node")).alias("least")))
    leaders = seen.groupBy("f").agg((-best["least"]).alias("leader"), F.count(F.lit(1)).alias("n")).filter("n > 1").drop("n")
    stars = materialize(seen.join(leaders, "f").filter("node <> leader").select("leader", "node").distinct(), "jaccard-stars")
    near = verified_links(texts, stars.select(F.col("leader").alias("g"), F.col("leader").alias("doc_id")),
                          stars.select(F.col("leader").alias("g"), F.col("node").alias("doc_id")), percent, frequent)
    comps = materialize(components(near), "jaccard-comps")

    # prefix indexes under two orders, between different components
    comps = comps.join(comps.groupBy("component").agg(F.count(F.lit(1)).alias("weight")), "component")
    known = alone.join(comps, "node", "left").select(F.col("node").alias("doc_id"), F.coalesce("component", "node").alias("comp"),
                                                     F.coalesce("weight", F.lit(1)).cast("long").alias("weight"))
    dealt = some.join(known, "doc_id").select("doc_id", "comp", "weight", "n_shingles", "prefix1", "prefix2")
    packets = dealt.mapInArrow(lambda b: tidied(_deal(b, buckets)), PACKET_SCHEMA)
    found = packets.groupBy("ord", "bucket").applyInPandas(lambda key, pdf: freed(_probes(key, pdf, percent)),
                                                           "ord int, kind int, g long, node long, comp long")
    found = materialize(found, "jaccard-candidates")
    one, two = (found.filter((F.col("ord") == k) & (F.col("kind") == 0)).select("g", F.col("node").alias("doc_id")).distinct() for k in (0, 1))
    passed = found.filter("ord = 1 and kind = 1").select(F.col("node").alias("doc_id")).distinct()
    probes = one.join(two, ["g", "doc_id"], "left_semi").unionByName(one.join(passed, "doc_id", "left_semi").select("g", "doc_id")).distinct()
    probes = materialize(probes, "jaccard-probes")
    groups = found.filter("ord = 0 and kind = 1").select("g", F.col("node").alias("doc_id"), "comp").distinct()
    members = known.select(F.col("comp").alias("g"), "doc_id").join(probes.select("g").distinct(), "g", "left_semi")
    more = verified_links(texts, probes, members, percent, frequent)
    more = more.unionByName(links_in_groups(texts, materialize(groups, "jaccard-large"), percent))

    linked_nodes = near.unionByName(more).unionByName(comps.select(F.col("node").alias("a"), F.col("component").alias("b")))
    final = materialize(components(linked_nodes), "jaccard-final")
    ids = nodes.join(final, "node", "left").select("doc_id", F.coalesce("component", "node").alias("component_id"))
    # a doc_id on several rows with different texts keeps its least component
    ids = ids.groupBy("doc_id").agg(F.min("component_id").alias("component_id"))
    return sets.select("doc_id", "n_shingles").join(ids, "doc_id", "left").select(
        "doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"))


def keep_one(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """The documents, all columns unchanged, with only the least doc_id of each component."""
    found = jaccard_components(docs, percent)
    gone = found.filter("component_id <> doc_id").select("doc_id").distinct()
    other = free_name("gone", docs)
    return docs.join(gone.withColumnRenamed("doc_id", other), F.col("doc_id").cast("long") == F.col(other), "left_anti")


by_value(__name__)
