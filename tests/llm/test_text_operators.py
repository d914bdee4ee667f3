"""Text operators against brute force on small tables, with nulls, empty and long texts, ties, repeated rows and clashing columns."""

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from conftest import SF0001

from tapewise.llm import (blocks, components, crf, decontaminate, exactdedup, fuse, htmltext, jaccard, layouts, linededup, packing,
                          sharding, textids, tokenfile, toxicity, warc)
from tapewise.llm.common import scratch, table

DOCS = "doc_id long, text string, lang string, source string, n_chars long, size long, component string"


def words(n, seed):
    rng = random.Random(seed)
    return " ".join("".join(rng.choice("abcdefgh") for _ in range(5)) for _ in range(n))


PASSAGE = "\n".join(words(15, 900 + k) for k in range(5))
EDGE = [(1, None), (2, ""), (3, "one"), (4, "  \t\n "), (5, words(300, 5)), (6, words(300, 5)), (7, words(300, 5).replace(" ", "  ")),
        (8, words(300, 5) + " tail"), (9, words(40, 9) + "\n" + PASSAGE + "\n" + words(20, 10)), (10, words(30, 11) + "\n" + PASSAGE),
        (11, words(30, 12) + "\n" + PASSAGE + "\nend"), (12, words(6000, 13)), (None, "no id"), (14, "dup row"), (14, "dup row"),
        (15, "É à\nx\ty <|endoftext|> 's"), (16, "the idiot clown said")]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(i, t, "en", "s", 1, 5, "x") for i, t in EDGE], DOCS).repartition(3).cache()


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="module")
def encoder():
    return textids.Encoder("byte_bpe_50k.json")


def whole(encoder, text, end):
    return np.array(encoder.tokenizer.encode(text or "", add_special_tokens=False).ids + [end], "<u4")


def test_ids_equal_the_library(encoder):
    for t in ["", " ", "a ", " a", "a  b", "a \n b", "don't 's", "x <|endoftext|> y", "日本 語", "a.\nB, c!", "ª º ½", *(t or "" for _, t in EDGE)]:
        assert encoder.encode(t) == whole(encoder, t, 0)[:-1].tobytes()


def test_token_file(spark, docs, none, encoder):
    path = scratch(spark, "t")
    tokenfile.write_token_file(docs, path)
    rows = tokenfile.token_file_digest(spark, path).collect()
    assert len(rows) == len(EDGE)
    want = Counter((i, len(x), zlib.crc32(x.tobytes())) for i, t in EDGE for x in [whole(encoder, t, 2)])
    assert Counter((r.doc_id, r.n_tokens, r.ids_crc32) for r in rows) == want
    at = 0
    for r in sorted(rows, key=lambda r: r.start):
        assert r.start == at
        at += r.n_tokens
    known = [r for r in sorted(rows, key=lambda r: r.start) if r.doc_id is not None]
    assert [r.doc_id for r in known] == sorted(r.doc_id for r in known)
    ids = tokenfile.read_token_file(spark, path).filter("doc_id = 3").first().ids
    assert ids == whole(encoder, "one", 2).tolist()
    empty = scratch(spark, "t")
    tokenfile.write_token_file(none, empty)
    assert tokenfile.token_file_digest(spark, empty).count() == 0


@pytest.mark.parametrize("size,max_pad", [(64, 2), (2048, 8)])
def test_packing(spark, docs, none, encoder, size, max_pad):
    rows = packing.pack(docs, size=size, max_pad=max_pad).collect()
    ids = {i: whole(encoder, t, 1) for i, t in EDGE}
    for r in rows:
        assert zlib.crc32(ids[r.doc_id][r.start:r.start + r.length].tobytes()) == r.ids_crc32 and r.doc_tokens == len(ids[r.doc_id])
    covered = Counter()
    for r in rows:
        covered.update((r.doc_id, k) for k in range(r.start, r.start + r.length))
    assert covered == Counter((i, k) for i, t in EDGE for k in range(len(ids[i])))
    sequences = {}
    for r in rows:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    pad = 0
    for pieces in sequences.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= size
        pad += 0 if at & (at - 1) == 0 else size - at
    assert pad <= max_pad * len(sequences)
    assert packing.pack(none).count() == 0


def test_first_fit_matches_a_scan():
    rng, bins, free = random.Random(1), packing.FirstFit(100, 300), []
    for size in sorted((rng.randint(1, 100) for _ in range(300)), reverse=True):
        k = next((i for i, f in enumerate(free) if f >= size), len(free))
        if k == len(free):
            free.append(100)
        assert bins.place(size) == (k, 100 - free[k])
        free[k] -= size


def test_best_fit_matches_a_scan():
    rng = random.Random(2)
    sizes = [rng.randint(1, 60) for _ in range(400)]
    free, want = [], {}
    for i in sorted(range(400), key=lambda i: (-sizes[i], i)):
        room, k = min(((f, b) for b, f in enumerate(free) if f >= sizes[i]), default=(100, len(free)))
        if k == len(free):
            free.append(100)
        free[k] -= sizes[i]
        want[i] = k
    assert sharding.best_fit_decreasing(sizes, 100) == [want[i] for i in range(400)]


def test_sharding(docs, none):
    rows = sharding.shard_documents(docs, shards=4).collect()
    size = {i: len((t or "").encode()) + 1 for i, t in EDGE}
    crc = {i: zlib.crc32((t or "").encode()) for i, t in EDGE}
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in rows) == Counter((i, size[i], crc[i]) for i, _ in EDGE)
    where, slots = {}, {}
    for r in rows:
        assert where.setdefault((r.size, r.text_crc32), r.shard) == r.shard
        slots.setdefault(r.shard, []).append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values()) and len(slots) <= 4
    assert sharding.shard_documents(none).count() == 0


def test_sharding_places_every_group_by_best_fit(spark):
    """Many small groups of few sizes: the shards are those of the groups placed one by one."""
    rng = random.Random(12)
    texts = [f"{k:03d}" + "x" * rng.choice([0, 1, 1, 1, 5, 40, 300]) for k in range(900)]
    rows = [(i, texts[rng.randrange(900)]) for i in range(2000)] + [(None, "hot")] * 900
    found = sharding.shard_documents(spark.createDataFrame(rows, "doc_id long, text string").repartition(5), shards=4).collect()
    assert Counter((r.doc_id, r.size) for r in found) == Counter((i, len(t) + 1) for i, t in rows)
    where, groups = {}, Counter()
    for r in found:
        assert where.setdefault(r.text_crc32, r.shard) == r.shard
        groups[r.text_crc32] += r.size
    histogram = Counter(groups.values())
    want = Counter()
    for size, first, after, shard in sharding.fit_shards(list(histogram.items()), 4):
        want[(size, shard)] += after - first
    assert Counter((groups[c], s) for c, s in where.items()) == want
    assert {s: sum(r.size for r in found if r.shard == s) for s in range(4)} == {
        s: sum(size * n for (size, k), n in want.items() if k == s) for s in range(4)}
    for s in range(4):
        assert sorted(r.slot for r in found if r.shard == s) == list(range(sum(r.shard == s for r in found)))


def test_fuse_filter():
    keys = np.random.default_rng(4).integers(0, 2 ** 63, 60_000).astype(np.uint64)
    for n in (1, 2, 5, 100, 30_000):
        made = fuse.build(keys[:n])
        assert fuse.probe(keys[:n], *made).all()
    assert fuse.probe(keys[30_000:], *made).mean() < 1e-3


def test_exact_dedup(docs, none):
    rows = exactdedup.exact_dedup(docs).collect()
    norm = [(i, re.sub(r"[\x20\x09-\x0D]+", " ", t or "")) for i, t in EDGE]
    groups = {}
    for i, t in norm:
        groups.setdefault(t, []).append(i)
    want = Counter((i, min((x for x in groups[t] if x is not None), default=None), len(groups[t]), hashlib.sha256(t.encode()).hexdigest())
                   for i, t in norm)
    assert Counter((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in rows) == want
    assert exactdedup.exact_dedup(none).count() == 0


def brute_components(texts):
    sets = {}
    for i, t in texts:
        w = re.findall(rb"[^\x20\x09-\x0D]+", re.sub(rb"[A-Z]", lambda m: m.group().lower(), (t or "").encode()))
        sets[i] = {tuple(w[k:k + 5]) for k in range(max(1, len(w) - 4))} if w else set()
    comp = {i: i for i in sets}
    ids = sorted(sets)
    for _ in ids:
        for a in ids:
            for b in ids:
                n = len(sets[a] & sets[b])
                if a < b and n and 100 * n >= 80 * (len(sets[a]) + len(sets[b]) - n):
                    comp[a] = comp[b] = min(comp[a], comp[b])
    return comp, {i: len(s) for i, s in sets.items()}


def test_jaccard_edges(docs, none):
    rows = jaccard.jaccard_components(docs).collect()
    comp, n = brute_components([x for x in EDGE if x[0] is not None])
    assert len(rows) == len(EDGE)
    for r in rows:
        if r.doc_id is None:
            assert r.component_id is None
        else:
            assert (r.component_id, r.n_shingles) == (comp[r.doc_id], n[r.doc_id])
    assert jaccard.jaccard_components(none).count() == 0


def test_jaccard_many_near_copies(spark):
    """A group around the threshold with more components than LARGE, beside texts that share a passage."""
    rng, base = random.Random(3), words(120, 77).split()
    texts = []
    for i in range(70):
        w = list(base)
        for _ in range(rng.choice((0, 1, 2, 3, 3))):
            w[rng.randrange(len(w))] = f"x{i}y{rng.randrange(99)}"
        texts.append((i, " ".join(w)))
    texts += [(100 + i, words(90, 500 + i) + " " + " ".join(base[:40])) for i in range(30)]
    rows = jaccard.jaccard_components(spark.createDataFrame(texts, "doc_id long, text string")).collect()
    comp, _ = brute_components(texts)
    assert {r.doc_id: r.component_id for r in rows} == comp


def test_components(spark):
    rng = random.Random(5)
    links = [(rng.randrange(200), rng.randrange(200)) for _ in range(120)]
    comp = {x: x for p in links if p[0] != p[1] for x in p}
    for _ in comp:
        for a, b in links:
            if a != b:
                comp[a] = comp[b] = min(comp[a], comp[b])
    found = components.components(spark.createDataFrame(links, "a long, b long")).collect()
    assert dict(found) == comp


def test_line_dedup(spark, docs, none):
    rows = linededup.line_dedup(docs).collect()
    assert len(rows) == len(EDGE)
    text = {r.doc_id: r.text for r in rows}
    before = dict(EDGE)
    assert PASSAGE in text[9] and text[10] == words(30, 11) and text[11] == words(30, 12) + "\nend"
    assert text[5] == before[5] and text[6] == "" and text[1] is None and text[14] == "dup row" and text[12] == before[12]
    kept = linededup.drop_repeated(docs)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == {i for i, _ in EDGE} - {6}
    assert linededup.line_dedup(none).count() == 0


def repeated_passages(texts):
    """(doc, line) of the lines in a run of MIN_WORDS words, with words at both ends, that stands earlier as a whole."""
    split = {d: t.split("\n") for d, t in texts.items()}
    places = [(d, i) for d in sorted(split) for i in range(len(split[d]))]
    found = set()
    for n, (d, i) in enumerate(places):
        for o, j in places[:n]:
            size = 0
            while (i + size < len(split[d]) and j + size < len(split[o]) and split[d][i + size] == split[o][j + size]
                   and (o != d or j + size < i)):
                size += 1
                run = split[d][i:i + size]
                if run[0].strip() and run[-1].strip() and len(" ".join(run).split()) >= linededup.MIN_WORDS:
                    found |= {(d, k) for k in range(i, i + size)}
    return found


def test_line_dedup_leaves_no_repeated_passage(spark):
    # a long line beside other repeated lines of its own frequency: the chunks around it differ
    texts = {}
    for k in range(12):
        a, b, c = words(81, 3000 + k), words(10, 3100 + k), words(10, 3200 + k)
        texts |= {10 * k + 1: f"{a}\n{b}", 10 * k + 2: f"{a}\n{c}", 10 * k + 3: f"{b}\nx{k}\n{c}"}
    # passages at random places among short, empty and equal lines
    rng = random.Random(8)
    pool = ["", "", " ", "tick"] + [words(rng.choice([3, 9, 15, 22]), 3300 + k) for k in range(14)] + [words(41, 3400)]
    passages = [[rng.choice(pool) for _ in range(rng.randint(2, 7))] for _ in range(8)]
    for d in range(1000, 1030):
        lines = []
        for _ in range(rng.randint(1, 4)):
            lines += rng.choice(passages) + [rng.choice(pool) for _ in range(rng.randint(0, 3))] + [words(5, rng.random())] * rng.randint(0, 1)
        texts[d] = "\n".join(lines)
    texts[2000] = "\n".join([words(20, 3500)] * 5)
    table_ = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(4)
    gone = {(r.doc_id, i) for r in linededup.removals(table_).collect() for i in r.gone}
    want = repeated_passages(texts)
    assert {(10 * k + 2, 0) for k in range(12)} <= want
    assert not want - gone
    # the first of equal lines stays
    every = [(t, (d, i)) for d in sorted(texts) for i, t in enumerate(texts[d].split("\n"))]
    firsts = {}
    for t, at in every:
        firsts.setdefault(t, at)
    assert not gone & set(firsts.values())


def test_line_dedup_gives_null_and_shared_ids_a_place(spark):
    own, other = words(75, 41), words(75, 42)
    rows = [(None, own + "\na"), (None, own + "\nb"), (3, own + "\nc"), (3, own + "\nd"), (4, own + "\ne"), (5, "f"),
            (None, other), (None, other), (None, other + "\ng"), (None, None), (3, None)]
    df = spark.createDataFrame([(*r, 7, 8) for r in rows], "doc_id long, text string, place long, shared_id int").repartition(3)
    found = linededup.line_dedup(df).collect()
    assert Counter((r.doc_id, r.text, r.removed_lines) for r in found) == Counter(
        [(4, own + "\ne", 0), (3, "c", 1), (3, "d", 1), (None, "a", 1), (None, "b", 1), (5, "f", 0),
         (None, other, 0), (None, "", 1), (None, "g", 1), (None, None, 0), (3, None, 0)])
    kept = linededup.drop_repeated(df)
    assert kept.columns == df.columns and kept.filter("place = 7 and shared_id = 8").count() == 10
    ends = [((1 << 63) - 1, own), (None, own + "\nh"), (None, own)]
    found = linededup.line_dedup(spark.createDataFrame(ends, "doc_id long, text string")).collect()
    assert sum(own in r.text for r in found) == 1 and len(found) == 3


def test_line_dedup_takes_long_documents(spark):
    """Two documents of 60,000 lines; the second has all of the first but its middle line, and lines between."""
    lines = [words(3, 5000 + k) for k in range(60_000)]
    other = lines[:30_000] + ["new line"] + lines[30_001:] + ["the end"]
    df = spark.createDataFrame([(1, "\n".join(lines)), (2, "\n".join(other))], "doc_id long, text string")
    text = {r.doc_id: r.text for r in linededup.line_dedup(df).collect()}
    assert text == {1: "\n".join(lines), 2: "new line\nthe end"}


ITEMS = [(1, words(30, 21) + ". What is it?\nAnswer " + words(6, 22) + "."), (2, None), (3, "too short"), (4, words(200, 23)), (4, words(200, 23))]


def test_decontamination(spark, docs, none):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    planted = [(50, words(100, 31) + " " + ITEMS[0][1].upper() + " " + words(80, 32)), (51, ITEMS[3][1] + " more"),
               (52, " ".join(ITEMS[0][1].split()[:12]) + " " + words(60, 33))]
    rows = docs.select("doc_id", "text").unionByName(spark.createDataFrame(planted, "doc_id long, text string"))
    found = {(r.doc_id, r.item_id) for r in decontaminate.find_leaks(rows, items).collect()}
    assert found == {(50, 1), (51, 4)}
    kept = {r.doc_id for r in decontaminate.drop_leaks(rows, items).collect()}
    assert kept == {i for i, _ in EDGE} | {52}
    assert decontaminate.find_leaks(none, items).count() == 0 and decontaminate.find_leaks(rows, items.limit(0)).count() == 0


def test_block_max_wand_equals_full_scoring():
    rng = random.Random(6)
    vocab = [words(1, k) for k in range(40)]
    items = [(i, " ".join(rng.choice(vocab) for _ in range(rng.randint(3, 60)))) for i in range(300)]
    df, n, total = Counter(), 0, 0
    for _, t in items:
        keys = decontaminate.grams(t.split(), 1)
        for a, b in decontaminate.segment_bounds(len(keys), 1):
            df.update(set(keys[a:b]))
            n, total = n + 1, total + b - a
    index = decontaminate.Index(items, n, total / n, df, gram=1)
    for threshold in (0.2, 0.35, 0.6):
        terms = sorted(rng.sample(range(len(index.postings)), 15))
        score = Counter()
        for t in terms:
            for s, x in index.postings[t]:
                score[s] += x
        found = index.search(terms, threshold)
        assert {s for s, _ in found} == {s for s, x in score.items() if x >= threshold - 1e-9} and len(found) == len(dict(found))


def test_toxicity(spark, docs, none):
    rng = random.Random(8)
    plain = [words(1, k) for k in range(300)]
    rows, labels = [], []
    for i in range(1200):
        w, toxic = [rng.choice(plain) for _ in range(30)], i % 3 == 0
        if toxic:
            w[5], w[9] = "insult", "group"
        elif i % 3 == 1:
            w[rng.randrange(30)] = rng.choice(("insult", "group"))
        rows.append((i, " ".join(w)))
        labels.append((i, 1, int(toxic)))
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    machine = toxicity.fit(frame, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    truth = {i: t for i, _, t in labels}
    scored = toxicity.score(frame, machine).collect()
    held = [r for r in scored if r.held_out]
    assert {r.doc_id for r in held} == {i for i in truth if zlib.crc32(str(i).encode()) % 5 == 0}
    assert sum(r.predicted == truth[r.doc_id] for r in held) >= 0.97 * len(held)
    edge = toxicity.score(docs, machine).collect()
    assert len(edge) == len(EDGE) and all(0 <= r.score <= 1 for r in edge)
    kept = toxicity.drop_toxic(docs, machine)
    assert kept.columns == docs.columns and kept.count() == sum(r.score < 0.5 for r in edge)
    assert toxicity.score(none, machine).count() == 0
    blank = toxicity.fit(frame, spark.createDataFrame([], "doc_id long, quality int, toxic int"))
    assert all(r.predicted == 0 for r in toxicity.score(docs, blank).collect())


def test_viterbi_equals_enumeration():
    rng = np.random.default_rng(9)
    chain = crf.Chain({str(k): k for k in range(6)}, rng.normal(size=(6, 2)), rng.normal(size=(2, 2)), rng.normal(size=2))
    for n in range(1, 9):
        seq = [[str(k) for k in rng.choice(6, 2, replace=False)] for _ in range(n)]
        e = chain.scores(seq)

        def value(y):
            return chain.start[y[0]] + sum(e[i, y[i]] for i in range(n)) + sum(chain.move[y[i], y[i + 1]] for i in range(n - 1))

        best = max(([b >> i & 1 for i in range(n)] for b in range(1 << n)), key=value)
        assert chain.decode(seq) == best


def test_html(spark):
    pages = table(spark, SF0001, "pages")
    chain = htmltext.fit(pages)
    made = layouts.labelled_pages([[words(30, s * 50 + k) + "." for k in range(8)] for s in range(40)], seed=99)
    right = total = 0
    for page, labels in made:
        found = blocks.leaf_blocks(page)
        assert len(found) == len(labels)
        got = chain.decode(blocks.features(found))
        right, total = right + sum(a == b for a, b in zip(got, labels)), total + len(labels)
    assert right >= 0.95 * total
    body = "<article><h1>Big title here</h1><p><b>One &amp; two\n  three four five six seven.<br><p>Next line of the text &#233; here.</p></article>"
    html = f"<html><head><title>t</title></head><body><nav><ul><li><a href='/'>Home</a></li></ul></nav>{body}<footer>&copy; x</footer></body></html>"
    rows = [(1, "u", html), (2, None, None), (3, "v", ""), (3, "v", ""), (None, "w", "plain <p>text cut off &am"), (5, "x", "<" * 300 + html[:150])]
    out = htmltext.extract(spark.createDataFrame(rows, "page_id long, url string, html string"), chain).collect()
    text = {r.page_id: r.text for r in out}
    assert len(out) == 6 and all(r.n_chars == len(r.text) for r in out)
    assert text[1] == "Big title here\nOne & two three four five six seven.\nNext line of the text é here." and text[2] == "" and text[3] == ""


def test_warc(spark):
    big, other = "x\r\n\r\nWARC/1.1\r\n" + "é" * 700, "y" * 1500
    rows = [(1, "http://www.A.org:80/p?q#f", big), (2, "https://a.org/p", big), (3, None, None), (4, "http://b.org/", other), (4, "http://b.org/", other),
            (5, "u v", "small"), (6, "u v", "small"), (7, "http://a.org/", big), (None, "http://z.org", other)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)
    found = warc.capture_index(pages, scratch(spark, "warc")).collect()
    assert len(found) == len(rows)
    for r in found:
        data = next((h or "") for i, _, h in rows if i == r.page_id).encode()
        assert (r.payload_bytes, r.payload_digest) == (len(data), hashlib.sha1(data).hexdigest())
    kinds = Counter((r.page_id, r.record_type, r.refers_to) for r in found)
    assert kinds == Counter([(1, "revisit", 7), (2, "revisit", 7), (7, "response", None), (3, "response", None), (4, "response", None),
                             (4, "response", None), (5, "response", None), (6, "response", None), (None, "revisit", 4)])
    order = sorted(found, key=lambda r: (r.merge_range, r.merge_pos))
    keys = [(r.url_key, r.captured_at, r.page_id or -1) for r in order]
    assert keys == sorted(keys) and "org,a)/p?q" in {r.url_key for r in found}
    assert warc.capture_index(pages.limit(0), scratch(spark, "warc")).count() == 0


def test_loser_tree():
    rng = random.Random(10)
    for k in (0, 1, 2, 3, 7, 16):
        runs = [sorted(rng.randrange(50) for _ in range(rng.randrange(9))) for _ in range(k)]
        assert list(warc.LoserTree(runs)) == sorted(x for r in runs for x in r)


def test_a_quoted_question_does_not_hide_the_whole_item(spark):
    question, answer = words(104, 41) + ".", "\nAnswer " + words(6, 42) + "."
    items = spark.createDataFrame([(7, question + answer)], "item_id long, text string")
    text = f"{question} {words(900, 43)} {question}{answer} {words(50, 44)}"
    rows = spark.createDataFrame([(1, text), (2, f"{question} {words(900, 45)}")], "doc_id long, text string")
    assert [(r.doc_id, r.item_id) for r in decontaminate.find_leaks(rows, items).collect()] == [(1, 7)]
    assert [r.doc_id for r in decontaminate.drop_leaks(rows, items).collect()] == [2]


def test_clashing_columns_stay(spark):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    names = ["__text", "scored_text", "searched_text", "removed_lines", "cut_doc", "cut_lines", "gone", "__key"]
    rows = [(i, t, *([77] * len(names))) for i, t in EDGE]
    df = spark.createDataFrame(rows, "doc_id long, text string, " + ", ".join(f"{n} long" for n in names))
    machine = toxicity.Machine([], -30.0, np.zeros(0), np.zeros((0, toxicity.FACTORS)))
    for found in (toxicity.drop_toxic(df, machine), decontaminate.drop_leaks(df, items), linededup.drop_repeated(df), jaccard.keep_one(df)):
        assert found.columns == df.columns
        assert {tuple(r)[2:] for r in found.collect()} == {(77,) * len(names)}
