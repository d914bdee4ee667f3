"""Conversation repair, SimHash components and hard negatives against brute force, with the edge cases their docstrings state."""

import hashlib
import heapq
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from conftest import SF0001, SF001
from oracle_compare import compare, duck

from tapewise.llm import negatives, queries, repair, simhash
from tapewise.llm.common import table

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SEEN = re.compile(r"[^\x20\x09-\x0D]")


# ------------------------------------------------------------ repair

def cheapest(rows):
    """(cost, audit, repaired) over all edit sequences, by a search over states in order of cost and edits."""
    n, queue, done = len(rows), [(0, "", 0, "", ())], set()
    while queue:
        cost, audit, i, roles, out = heapq.heappop(queue)
        if i == n and re.fullmatch("(s?(ua)+)?", roles):
            return cost, audit, out
        state = (i, roles[-1:], "s" in roles)
        if state in done:
            continue
        done.add(state)
        for c, role in (("u", "user"), ("a", "assistant")):
            if re.fullmatch("s?(ua)*u?", roles + c):
                heapq.heappush(queue, (cost + 2, audit + "I", i, roles + c, (*out, (role, ""))))
        if i < n:
            role, text, fault = rows[i]
            heapq.heappush(queue, (cost + 3, audit + "D", i + 1, roles, out))
            if fault not in ("blank", "duplicate"):
                late = fault == "truncated"
                for edit, extra, r in (("K", 0, role), ("R", 2, "user"), ("R", 2, "assistant")):
                    if re.fullmatch("s?(ua)*u?", roles + (r[:1] or "-")):
                        heapq.heappush(queue, (cost + extra + late, audit + edit, i + 1, roles + r[:1], (*out, (r, text))))


def brute_report(rows):
    """rows: (conv_id, turn, role, text) -> {conv_id: report}."""
    convs = defaultdict(list)
    for conv, turn, role, text in rows:
        deal = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        text = "" if deal in (0, 1) else re.sub("[.!?]", "", text) if deal == 2 else text
        role = "user" if deal == 4 else role
        convs[conv] += [] if deal == 0 else [(turn, role, text)] * (2 if deal == 3 else 1)
    out = {}
    for conv, turns in convs.items():
        turns.sort(key=lambda t: (t[0] is not None, t[0] or 0, t[1], t[2]))
        seen, faulty, counts = set(), [], Counter()
        for _, role, text in turns:
            last = SEEN.findall(text)[-1:]
            fault = "blank" if not last else "duplicate" if (role, text) in seen else "truncated" if last[0] not in ".!?" else ""
            seen.add((role, text))
            faulty.append((role, text, fault))
            counts[fault] += 1
        known = [t for t, _, _ in turns if t is not None]
        gaps = max(known) - min(known) + 1 - len(set(known)) if known else 0
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(turns, turns[1:]))
        cost, audit, repaired = cheapest(faulty)
        digest = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in repaired).encode()).hexdigest()
        out[conv] = (gaps, counts["blank"], counts["duplicate"], counts["truncated"], illegal, cost, audit, digest)
    return out


def reported(df):
    rows = df.collect()
    assert len({r.conv_id for r in rows}) == len(rows)
    return {r.conv_id: (r.gaps, r.blank, r.duplicate, r.truncated, r.illegal, r.cost, r.audit, r.repaired_sha256) for r in rows}


SCHEMA = "conv_id long, turn long, role string, text string, gone int, pointer string"


def conversation(conv, n, rng):
    roles = ["user", "assistant", "system", "tool", "", None]
    texts = ["Yes.", "No", " ", "", None, "Why? \n", "yes.", " ", "a." * 3000]
    for k in range(n):
        turn = None if rng.random() < 0.05 else rng.randint(-2, 2 * n)
        yield conv, turn, rng.choices(roles, [8, 8, 2, 1, 1, 1])[0], rng.choice(texts) if rng.random() < 0.5 else f"Word {rng.random()}."


def test_repair(spark):
    rng = random.Random(4)
    rows = [x for conv in [None, *range(-3, 60)] for x in conversation(conv, rng.randint(1, 14), rng)]
    rows += rows[:20] + [(99, t, "user" if t % 2 == 0 else "assistant", f"Turn {t}.") for t in range(4000)]
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], SCHEMA).repartition(5)
    assert reported(repair.repair_report(repair.damaged(df))) == brute_report(rows)


def test_repaired_turns(spark):
    rows = [(1, 0, "system", "Rules."), (1, 1, "assistant", "Hello."), (1, 2, "user", "Hi."), (2, 0, "user", "Alone"), (3, 5, "tool", " ")]
    df = spark.createDataFrame([(*r, False) for r in rows], "conv_id long, turn long, role string, text string, gone boolean")
    found = sorted(tuple(r) for r in repair.repaired_turns(df).collect())
    assert found == [(1, 0, "K", "system", "Rules."), (1, 1, "I", "user", ""), (1, 2, "K", "assistant", "Hello."), (1, 3, "K", "user", "Hi."),
                     (1, 4, "I", "assistant", "")]
    report = reported(repair.repair_report(df))
    assert report[1][5:7] == (4, "KIKKI") and report[2][5:7] == (3, "D")
    assert report[3][5:7] == (3, "D") and report[3][7] == hashlib.sha256().hexdigest()


def test_repair_carries_its_state_across_batches(spark):
    rng = random.Random(8)
    rows = [x for conv in range(4) for x in conversation(conv, 300, rng)]
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], SCHEMA)
    size = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(size)
    spark.conf.set(size, "7")
    try:
        assert reported(repair.repair_report(repair.damaged(df))) == brute_report(rows)
    finally:
        spark.conf.set(size, before)


def test_repair_empty_and_registered(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert repair.repair_report(repair.damaged(none)).count() == 0
    rows = [tuple(r) for r in table(spark, SF0001, "conversations").select("conv_id", "turn", "role", "text").collect()]
    assert reported(queries.op11_conversation_repair(spark, SF0001)) == brute_report(rows)


def test_repair_shuffles_once(spark):
    df = repair.repair_report(repair.damaged(table(spark, SF0001, "conversations")))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1


# ------------------------------------------------------------ simhash

def brute_fingerprint(text):
    found = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not found:
        return 0
    shingles = [" ".join(found[i:i + 3]) for i in range(max(1, len(found) - 2))]
    values = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(v >> b & 1 for v in values) > len(values))


def brute_groups(prints):
    """Component (as least index) of each fingerprint under links of three bits."""
    group, values = list(range(len(prints))), np.array(prints, np.uint64)
    for i in range(len(prints)):
        for j in np.flatnonzero(np.bitwise_count(values ^ values[i]) <= 3):
            a, b = group[i], group[j]
            if a != b:
                group = [min(a, b) if g in (a, b) else g for g in group]
    return group


def near(value, rng, most):
    for b in rng.sample(range(64), rng.randint(0, most)):
        value ^= 1 << b
    return value


def some_prints(n, rng):
    centres = [0, (1 << 64) - 1, *(rng.getrandbits(64) for _ in range(n // 20))]
    return sorted({near(rng.choice(centres), rng, 5) for _ in range(n)} | {rng.getrandbits(64) for _ in range(n // 4)})


def test_gray_rank_orders_the_gray_sequence(spark):
    rng = random.Random(1)
    values = [0, 1, 1 << 63, (1 << 64) - 1, *(rng.getrandbits(64) for _ in range(50))]

    def rank(g):
        out = 0
        while g:
            out ^= g
            g >>= 1
        return out

    df = spark.createDataFrame([(int(np.uint64(v).view("i8")),) for v in values], "fp long")
    from pyspark.sql import functions as F
    found = [int(np.int64(r.fp).view("u8")) for r in df.orderBy(simhash.gray_rank(F.col("fp"))).collect()]
    assert found == sorted(values, key=rank)


def test_close_pairs_finds_every_pair():
    rng = random.Random(3)
    for n in (1, 2, 9, 400):
        a, b = (np.array(some_prints(n, rng), np.uint64) for _ in range(2))
        found = {(int(i), int(j)) for x, y in simhash.close_pairs(a, b) for i, j in zip(x, y)}
        assert found == {(int(i), int(j)) for i, j in zip(*np.nonzero(np.bitwise_count(a[:, None] ^ b) <= 3))}


@pytest.mark.parametrize("block", [8, 8192])
def test_links_join_what_brute_force_joins(spark, monkeypatch, block):
    monkeypatch.setattr(simhash, "BLOCK", block)  # 8: many blocks and several levels of upper nodes
    prints = some_prints(400, random.Random(5))
    signed = [int(np.uint64(v).view("i8")) for v in prints]
    from tapewise.llm.components import components
    found = components(simhash.close_links(spark.createDataFrame([(v,) for v in signed], "fp long"))).collect()
    want = defaultdict(set)
    for v, g in zip(signed, brute_groups(prints)):
        want[g].add(v)
    got = defaultdict(set)
    for r in found:
        got[r.component].add(r.node)
    assert sorted(map(sorted, got.values())) == sorted(sorted(g) for g in want.values() if len(g) > 1)


def test_simhash_components(spark):
    rng = random.Random(6)
    base = " ".join(rng.choice("abcdefgh") * 3 + str(rng.randint(0, 99)) for _ in range(400))
    texts = [None, "", " \t\n", "one", "One two", "one  two\x0bthree", base, base.upper(), base + " end", base.replace(" ", "\n"), "É à", "é à",
             "word " * 70_000, base * 40]
    rows = [(i, t) for i, t in enumerate(texts)] + [(None, base), (3, "one"), (4, "other text"), (None, "alone here")]
    df = spark.createDataFrame([(i, t, 1, 2) for i, t in rows], "doc_id long, text string, fp long, least int").repartition(3)
    found = simhash.simhash_components(df).collect()
    prints = [brute_fingerprint(t) for _, t in rows]
    groups, least = brute_groups(prints), {}
    for (i, _), g in zip(rows, groups):
        least[g] = min((x for x in (least.get(g), i) if x is not None), default=None)
    want = Counter((i, f"{p:016x}", least[g]) for (i, _), p, g in zip(rows, prints, groups))
    assert Counter(tuple(r) for r in found) == want
    assert simhash.simhash_components(df.limit(0)).count() == 0


def test_simhash_registered(spark):
    rows = table(spark, SF0001, "documents").select("doc_id", "text").collect()
    prints = [brute_fingerprint(r.text) for r in rows]
    groups, least = brute_groups(prints), {}
    for r, g in zip(rows, groups):
        least[g] = min(least.get(g, r.doc_id), r.doc_id)
    want = {(r.doc_id, f"{p:016x}", least[g]) for r, p, g in zip(rows, prints, groups)}
    assert {tuple(r) for r in queries.op12_simhash(spark, SF0001).collect()} == want


# ------------------------------------------------------------ negatives

def brute_negatives(rows):
    """rows: (vec_id, label, vector) -> rows of the result."""
    kept = []
    for i, label, vec in rows:
        if i is None or label is None or vec is None or any(x is None or not np.isfinite(x) for x in vec):
            continue
        kept.append((i, label, [int(np.floor(256 * float(x))) for x in vec]))
    out, anchors = [], []
    for a in kept:
        if a[0] % 100 == 0 and a not in anchors:
            anchors.append(a)
    for i, label, vec in anchors:
        scored = sorted((-sum(x * y for x, y in zip(vec, v)), j, l) for j, l, v in kept)
        for score, positive, _ in [s for s in scored if s[2] == label and s[1] != i][:5]:
            hard = [(-s, j) for s, j, l in scored if l != label and 30 * -score <= 100 * -s <= 90 * -score][:10]
            out += [(i, positive, r + 1, j, -score, s) for r, (s, j) in enumerate(hard)]
    return Counter(out)


def mined(spark, rows):
    from pyspark.sql import functions as F
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], "vec_id long, label int, embedding array<double>, anchor int, block string")
    return Counter(tuple(r) for r in negatives.hard_negatives(negatives.usable(df), F.col("vec_id") % 100 == 0).collect())


@pytest.mark.parametrize("scale", [0.3, 1e5])  # the second needs words wider than a double
def test_hard_negatives(spark, monkeypatch, scale):
    monkeypatch.setattr(negatives, "LEAST_ROWS", 150)
    monkeypatch.setattr(negatives, "ANCHOR_BLOCK", 3)
    monkeypatch.setattr(negatives, "BATCH_ROWS", 64)
    rng = random.Random(2)
    rows = [(i, rng.randint(0, 2), [rng.gauss(0.2, 1) * scale for _ in range(6)]) for i in range(700)]
    rows += [(100, rows[100][1], rows[100][2])] * 2 + [(701, 1, rows[5][2]), (702, 2, rows[5][2]), (703, 0, []), (800, 1, []), (704, 1, [1.0])]
    rows += [(None, 1, rows[0][2]), (705, None, rows[0][2]), (706, 1, None), (707, 1, [None] * 6), (708, 1, [float("nan")] * 6),
             (900, 1, [float("inf")] * 6), (1000, 9, [scale] * 6)]
    assert mined(spark, rows) == brute_negatives(rows)


def test_hard_negatives_equal_sql(spark):
    ok, msg = compare(spark, duck(SF001), "op13_hard_negatives", queries.QUERIES["op13_hard_negatives"], queries.ORACLES["op13_hard_negatives"], SF001)
    assert ok, msg


def test_hard_negatives_of_nothing(spark):
    assert mined(spark, []) == Counter()
    assert mined(spark, [(5, 1, [1.0]), (6, 2, [0.5])]) == Counter()
    assert mined(spark, [(100, 1, [1.0]), (6, 2, [0.5])]) == Counter()


def test_packed_scores_are_exact():
    rng = np.random.default_rng(1)
    for high in (1, 200, 1 << 20, 1 << 40):
        a, r = (rng.integers(-high, high, (n, 9)) for n in (7, 50))
        want = [[sum(int(x) * int(y) for x, y in zip(p, q)) for q in r] for p in a]
        limit = negatives.LONG
        assert negatives.packed_scores(a, r).tolist() == [[max(-limit, min(limit, x)) for x in row] for row in want]
    assert negatives.packed_scores(np.zeros((2, 0), "int64"), np.zeros((3, 0), "int64")).tolist() == [[0] * 3] * 2
