"""Joins, passages, benchmark items, language model and pipeline against brute force."""

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

import corpus_pipeline
from packshot.llm import components, decontamination, jaccard_join, lm_scoring, substring_dedup
from packshot.llm.fm_index import FMIndex
from packshot.llm.queries import QUERIES

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def words_of(text, lower=True):
    return WORD.findall((text or "").translate(LOWER) if lower else text or "")


def shingle_set(text, k, short=True):
    w = words_of(text)
    if len(w) >= k:
        return {tuple(w[i : i + k]) for i in range(len(w) - k + 1)}
    return {tuple(w)} if w and short else set()


def near_copies(seed, n=60):
    """Texts of many sizes in groups with few or more changed words, and shared passages."""
    random.seed(seed)
    word = lambda: random.choice("abcdefghijklmnop") + random.choice("aeiou") + random.choice("xyz")
    passage = [word() for _ in range(60)]
    out = []
    for g in range(n):
        size = random.choice([1, 2, 3, 5, 9, 12, 20, 21, 40, 80, 200, 900])
        base = [word() + str(g % 7) for _ in range(size)]
        if random.random() < 0.3:
            base = base[: size // 2] + passage + base[size // 2 :]
        for _ in range(random.choice([1, 1, 2, 4])):
            copy = list(base)
            for _ in range(random.choice([0, 0, 1, 1, 2, 4])):
                at = random.randrange(len(copy))
                copy[at : at + random.choice([0, 1])] = [word()] if random.random() < 0.7 else []
                copy = copy or ["z"]
            out.append(" ".join(copy))
    random.shuffle(out)
    return list(enumerate(out))


def brute_components(rows, k, percent):
    sets = [(i, shingle_set(t, k)) for i, t in rows]
    root = {i: i for i, _ in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, (i, s) in enumerate(sets):
        for j, t in sets[:a]:
            both = len(s & t)
            if both and 100 * both >= percent * (len(s) + len(t) - both):
                x, y = find(i), find(j)
                root[max(x, y)] = min(x, y)
    return {i: (len(s), find(i)) for i, s in sets}


@pytest.mark.parametrize("k, percent, seed", [(3, 90, 1), (5, 80, 2), (1, 70, 3)])
def test_jaccard(spark, documents, k, percent, seed, monkeypatch):
    rows = near_copies(seed)
    if seed == 2:  # groups in several blocks
        monkeypatch.setattr(jaccard_join, "BLOCK_ROWS", 3)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard_join.jaccard_components(documents(rows, extra=True), k, percent).collect()}
    assert got == brute_components(rows, k, percent)


def test_crowded_lists_are_compared_in_tasks(spark, documents, monkeypatch):
    """Sets just below the threshold, in lists of which the tasks name the sets and not the pairs."""
    monkeypatch.setattr(jaccard_join, "DENSE", 0)
    monkeypatch.setattr(jaccard_join, "BLOCK_BYTES", 20_000)
    base = [f"w{i}" for i in range(200)]
    rows = []
    for i in range(60):
        copy = list(base)
        for j in range(4 if i % 3 else 2):  # 4 or 2 places of their own
            copy[(i * 7 + j * 50) % 200] = f"n{i}x{j}"
        rows.append((i, " ".join(copy)))
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard_join.jaccard_components(documents(rows)).collect()}
    want = brute_components(rows, 3, 90)
    assert got == want and 1 < len({c for _, c in want.values()})
    rows = near_copies(11)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard_join.jaccard_components(documents(rows), 5, 80).collect()}
    assert got == brute_components(rows, 5, 80)


def test_jaccard_chain_without_a_centre(spark, documents):
    # each links with its neighbours only, so the least and greatest set of a list do not find all
    base = [f"w{i}" for i in range(150)]
    rows = []
    for step in range(30):
        copy = list(base)
        copy[: step * 2] = [f"n{step}x{i}" if i >= step * 2 - 2 else f"n{i // 2 + 1}x{i}" for i in range(step * 2)]
        rows.append((step, " ".join(copy)))
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard_join.jaccard_components(documents(rows)).collect()}
    assert got == brute_components(rows, 3, 90)


def test_jaccard_odd_rows(spark, documents, odd_rows):
    got = jaccard_join.jaccard_components(documents(odd_rows, extra=True)).collect()
    assert len(got) == len(odd_rows)
    by = {r["doc_id"]: r for r in got}
    assert all(by[i]["n_shingles"] == 0 and by[i]["component_id"] == i for i in (0, 1, 2)) and by[6]["component_id"] == 6
    assert jaccard_join.jaccard_components(documents([])).count() == 0
    kept = jaccard_join.one_per_group(documents(odd_rows), 5, 80).collect()
    assert sorted(r["doc_id"] for r in kept if r["doc_id"] is not None) == [0, 1, 2, 3, 4, 5, 6]


def test_jaccard_without_an_id(spark, documents):
    text = [f"w{i}" for i in range(300)]
    rows = [(None, " ".join(text)), (7, " ".join([*text, "more"])), (9, " ".join(text[1:])), (None, "other text of its own")]
    got = sorted((r["doc_id"] or -1, r["component_id"] or -1) for r in jaccard_join.jaccard_components(documents(rows)).collect())
    assert got == [(-1, -1), (-1, 7), (7, 7), (9, 7)]


def test_one_row_per_group_without_an_id_and_under_one_id(spark, documents):
    def text(name, changed=0):
        return " ".join([f"{name}{i}" for i in range(300)] + ["more"] * changed)

    rows = [(None, text("a")), (7, text("a", 1)), (None, text("a"))]  # the row with an id stays
    rows += [(None, text("b")), (None, text("b"))]  # one of two copies
    rows += [(None, text("c")), (None, text("d"))]  # unlike
    rows += [(1, text("e")), (2, text("e", 1)), (2, text("f"))]  # the second text of 2 is its own group
    rows += [(3, text("g")), (3, text("h")), (3, text("h"))]  # least of two groups
    rows += [(None, ""), (None, None), (4, "")]  # no set
    kept = jaccard_join.one_per_group(documents(rows, extra=True), 5, 80)
    assert kept.columns == documents(rows, extra=True).columns
    want = [(None, text("b")), (7, text("a", 1)), (None, text("c")), (None, text("d")), (1, text("e")), (2, text("f"))]
    want += [(3, text("g")), (3, text("h")), (None, ""), (None, None), (4, "")]
    assert sorted(map(repr, ((r["doc_id"], r["text"]) for r in kept.collect()))) == sorted(map(repr, want))


def test_boundary_follows_the_cost():
    assert jaccard_join.boundary({500: 100}, 90) == 0
    assert jaccard_join.boundary({5: 100, 9: 50}, 90) >= 9
    for s in range(1, 60):
        for t in range(s, 70):
            c = jaccard_join.least_overlap(s, t, 90)
            assert 100 * c >= 90 * (s + t - c) and 100 * (c - 1) < 90 * (s + t - c + 1)


@pytest.mark.parametrize("hot", [False, True])
def test_components(spark, hot, monkeypatch):
    if hot:  # hubs are split
        monkeypatch.setattr(components, "HOT_LINKS", 20)
    random.seed(5)
    links = [(random.randrange(300), random.randrange(300)) for _ in range(200)] + [(1000 + i, 1001 + i) for i in range(40)]
    links += [(5000, 6000 + i) for i in range(300)] + [(7000 + i, 5000) for i in range(200)]
    root = {}
    find = lambda x: x if root.setdefault(x, x) == x else find(root[x])
    for u, v in links:
        if u != v:
            a, b = find(u), find(v)
            root[max(a, b)] = min(a, b)
    got = {r["node"]: r["component"] for r in components.components(spark.createDataFrame(links, "u long, v long")).collect()}
    assert got == {x: find(x) for x in root}


@pytest.mark.parametrize("seed", range(8))
def test_index_finds_every_window(seed):
    rng = np.random.default_rng(seed)
    for _ in range(25):
        window, symbols = int(rng.integers(2, 9)), int(rng.integers(2, 6))
        texts = [rng.integers(1, symbols + 1, int(rng.integers(1, 40))) for _ in range(int(rng.integers(1, 8)))]
        index = FMIndex(np.concatenate([np.append(x, 0) for x in texts]), symbols + 2, window)
        streams = [rng.integers(0, symbols + 1, int(rng.integers(1, 40))) for _ in range(6)]
        ends = np.cumsum([len(x) for x in streams])
        starts = ends - [len(x) for x in streams]
        at, _ = index.windows(np.concatenate(streams), starts, ends)
        have = {tuple(x[i : i + window]) for x in texts for i in range(len(x) - window + 1)}
        want = [s + i for s, x in zip(starts, streams, strict=True) for i in range(len(x) - window + 1) if tuple(x[i : i + window]) in have]
        assert sorted(at.tolist()) == want


def brute_repeats(rows, window):
    first, out = {}, {}
    for doc, text in sorted((r for r in rows if r[0] is not None), key=lambda r: r[0]):
        w = words_of(text, False)
        covered = set()
        for i in range(len(w) - window + 1):
            if first.setdefault(tuple(w[i : i + window]), doc) < doc:
                covered |= set(range(i, i + window))
        kept = " ".join(x for i, x in enumerate(w) if i not in covered)
        out[doc] = (len(w), len(covered), hashlib.sha256(kept.encode()).hexdigest())
    return out


@pytest.mark.parametrize("shard_words", [1_000_000, 300])
def test_repeats(spark, documents, odd_rows, shard_words, monkeypatch):
    monkeypatch.setattr(substring_dedup.least_sources, "__defaults__", (shard_words,))
    random.seed(4)
    passage = [random.choice("abcde") + str(random.randrange(40)) for _ in range(150)]
    rows = list(odd_rows)
    for i in range(40):
        own = [random.choice("fghij") + str(random.randrange(300)) for _ in range(random.choice([3, 60, 120]))]
        a = random.randrange(100)
        rows.append((100 + i, " ".join(own[:30] + passage[a : a + random.choice([20, 49, 50, 51, 90])] + own[30:])))
    rows += [(200, "x " * 500), (201, "x " * 120), (202, rows[-1][1]), (203, rows[-1][1])]
    got = {r["doc_id"]: (r["n_words"], r["n_removed"], r["kept_sha256"]) for r in substring_dedup.repeat_digests(documents(rows, extra=True)).collect()}
    assert got.pop(None)[1] == 0
    assert got == brute_repeats(rows, 50)
    text = {r["doc_id"]: r["text"] for r in substring_dedup.without_repeats(documents(rows)).collect()}
    assert all(hashlib.sha256(text[i].encode()).hexdigest() == v[2] for i, v in got.items())
    assert substring_dedup.repeat_digests(documents([])).count() == 0


def test_contained_items(spark, documents, odd_rows):
    random.seed(6)
    word = lambda: random.choice("abcdefghij") + str(random.randrange(60))
    items = [(i, " ".join(word() for _ in range(random.choice([4, 5, 9, 14, 40, 300])))) for i in range(40)] + [(90, None), (91, ""), (0, "more of item zero under its id")]
    rows = list(odd_rows)
    for i in range(80):
        text = [word() for _ in range(random.choice([0, 30, 700]))]
        for _, item in random.sample(items[:40], 2):
            w = item.split()
            a = random.randrange(1 + len(w) // 6)
            piece = [x.upper() for x in w[a : len(w) - random.randrange(1 + len(w) // 6)]]
            at = random.randrange(len(text) + 1)
            text[at:at] = piece
        rows.append((100 + i, " ".join(text)))
    by_item = {}
    for i, t in items:
        by_item.setdefault(i, set()).update(shingle_set(t, 5, False))
    want = set()
    for d, t in rows:
        s = shingle_set(t, 5, False)
        for i, x in by_item.items():
            if x and 100 * len(s & x) >= 80 * len(x):
                want.add((d, i, len(s & x), len(x)))
    bench = spark.createDataFrame(items, "item_id long, text string").selectExpr("*", "1 as shingle", "2 as flags")
    got = {tuple(r) for r in decontamination.contained_items(documents(rows, extra=True), bench).collect()}
    assert got == want and len(want) > 40
    kept = {r["doc_id"] for r in decontamination.without_contaminated(documents(rows), bench).collect()}
    assert kept == {d for d, _ in rows} - {w[0] for w in want}
    assert decontamination.contained_items(documents(rows), bench.limit(0)).count() == 0


def test_only_candidates_are_verified(spark, documents, monkeypatch):
    """The result comes through the sketches: what they do not name is not looked at, and they miss nothing."""
    random.seed(9)
    boiler = " ".join(f"b{i}" for i in range(8))  # in all items and documents: shared by many, contained by itself in none
    items = [(i, boiler + " " + " ".join(f"i{i}w{j}" for j in range(60))) for i in range(30)]
    rows = [(100 + i, " ".join(f"d{i}x{j}" for j in range(400)) + " " + boiler) for i in range(40)]
    rows += [(200 + i, f"{rows[i][1]} {items[i][1]} {rows[i + 1][1]}") for i in range(30)]
    bench = spark.createDataFrame(items, "item_id long, text string")
    wanted = decontamination.item_shingles(bench, 5)
    pairs = {(r["_id"], r["item_id"]) for r in decontamination.candidate_pairs(documents(rows), wanted, 5).collect()}
    assert pairs >= {(200 + i, i) for i in range(30)} and len(pairs) < len(rows) * len(items)
    got = {(r["doc_id"], r["item_id"]) for r in decontamination.contained_items(documents(rows), bench).collect()}
    assert got == {(200 + i, i) for i in range(30)}
    real = decontamination.candidate_pairs
    monkeypatch.setattr(decontamination, "candidate_pairs", lambda *a: real(*a).where("item_id < 7"))
    assert decontamination.contained_items(documents(rows), bench).count() == 7
    monkeypatch.setattr(decontamination, "candidate_pairs", real)
    hot = decontamination.find_hot
    monkeypatch.setattr(decontamination, "find_hot", lambda df, on, rows: hot(df, on, share=50, rows=3))
    assert {(r["doc_id"], r["item_id"]) for r in decontamination.contained_items(documents(rows), bench).collect()} == got


def plain_tree(texts, depth, least_context, least_pair):
    """``(longest, p)`` of a suffix tree over token tuples by dictionaries: the longest retained suffix, and the probability behind it."""
    seen = Counter()
    for w in texts:
        run = ["<start>", *w]
        seen.update(tuple(run[i : i + n]) for n in range(1, depth + 2) for i in range(len(run) - n + 1))
    words = {x[0]: n for x, n in seen.items() if len(x) == 1 and x != ("<start>",)}
    total, behind, tree = sum(words.values()), {}, {}
    for run, n in seen.items():
        if n >= least_pair and len(run) > 1:
            behind.setdefault(run[:-1], {})[run[-1]] = n

    def p(s, x):
        if not s:
            return (words.get(x, 0) + 1) / (total + len(words) + 1)
        rest, n, stored = tree[s]
        return (stored.get(x, 0) + (rest + lm_scoring.BETA) * p(s[1:], x)) / (n + lm_scoring.BETA)

    for s in sorted(behind, key=len):
        n, stored = seen[s], behind[s]
        if n < least_context or (len(s) > 1 and s[1:] not in tree):
            continue
        rest, before = n - sum(stored.values()), {x: p(s[1:], x) for x in stored}
        gain = sum(c * np.log(c / n / before[x]) for x, c in stored.items())
        gain += rest * np.log(rest / n / max(1e-12, 1 - sum(before.values()))) if rest else 0
        if gain >= lm_scoring.DIVERGENCE * n and gain >= lm_scoring.GAIN * len(stored):
            tree[s] = rest, n, stored

    def longest(before):
        s = ()
        while len(s) < min(depth, len(before)) and before[len(before) - len(s) - 1 :] in tree:
            s = before[len(before) - len(s) - 1 :]
        return s

    return words, tree, longest, p


@pytest.mark.parametrize("head", [1e-9, 0.02, 2.0])
def test_language_model(spark, documents, odd_rows, monkeypatch, head):
    monkeypatch.setattr(lm_scoring, "HEAD", head)  # all runs with the tasks, some, none
    monkeypatch.setattr(lm_scoring, "SHARD_RUNS", 100)
    random.seed(7)
    rows = [*odd_rows, (6, "other words"), (None, "of no one")]
    after = {"the": ["cat sat on a mat", "dog ran", *(f"rare{i}" for i in range(40))], "of": ["the", "Cat", "course not"]}
    after["Cat"] = ["w y0", "v w y1", "u v w y2", "x u v w y3"]
    for i in range(300):
        words = ["start"]
        while len(words) < 60:
            words += random.choice(after.get(words[-1], ["the", "of", "Cat"])).split()
        rows.append((100 + i, " ".join(words)))
    rows += rows[-3:]
    tokens = [(d, tuple([*words_of(t), None])) for d, t in rows]
    held = {d: d is not None and zlib.crc32(str(d).encode()) % 7 == 2 for d, _ in tokens}
    counts, tree, longest, p = plain_tree([w for d, w in tokens if not held[d]], 4, 12, 3)
    assert {len(s) for s in tree} == {1, 2, 3, 4} and ("<start>",) in tree
    total, distinct = sum(counts.values()), len(counts)
    for s in [(), *random.sample(sorted(tree, key=str), 20)]:
        assert sum(p(s, x) for x in [*counts, "unseen"]) == pytest.approx(1)
    want = []
    for d, w in tokens:
        base = sum(np.log10((counts.get(x, 0) + 1) / (total + distinct + 1)) for x in w)
        run = ("<start>", *w)
        near = [run[max(0, i - 4) : i] for i in range(1, len(run))]
        score = sum(np.log10(p(longest(s), x)) for s, x in zip(near, w, strict=True))
        want.append((d is not None, d or 0, held[d], len(w), sum(x in counts for x in w), total, round(base, 6), round(score, 6)))
    got = []
    for r in lm_scoring.scored(documents(rows, extra=True), 4, 12, 3).collect():
        got.append((r["doc_id"] is not None, r["doc_id"] or 0, *r[1:5], round(r["base_score"], 6), round(r["score"], 6)))
    assert len(got) == len(rows)
    for a, b in zip(sorted(got), sorted(want), strict=True):
        assert a[:6] == b[:6] and a[6:] == pytest.approx(b[6:], abs=1e-4)
    sums = [sum(r[c] for r in want if r[2] and r[1] >= 100) for c in (7, 6)]
    assert sums[0] > 0.8 * sums[1]  # log probabilities: the tree has learnt what follows what


def test_the_tree_grows_with_the_corpus(spark, documents):
    def runs(n):
        random.seed(1)
        pairs = [f"a{i} b{i} c{i}" for i in range(n)]
        docs = documents([(i, " ".join(random.sample(pairs, n))) for i in range(20)]).selectExpr("doc_id", "false as held", "text")
        words = lm_scoring.word_counts(docs)
        return lm_scoring.weights(docs, words, *words.selectExpr("sum(n)", "count(1)").first(), 4, 12, 3).where("n = 0").count()

    assert runs(800) > 1.9 * runs(400) > 1500


def test_what_the_model_moves_is_packed():
    """Sorted hashes cost their steps, numbers the bytes that the largest of them needs."""
    random.seed(3)
    hashes = np.array(sorted({0, 2**64 - 1, *(random.getrandbits(64) for _ in range(100_000))}), np.uint64)
    for some in (hashes, hashes[:1], hashes[-1:], hashes[:0], hashes[:2]):
        assert lm_scoring.unpacked_rising(lm_scoring.packed_rising(some)).tolist() == some.tolist()
    assert len(lm_scoring.packed_rising(hashes)) < 6.5 * len(hashes)
    for some in ([], [0], [1] * 9000, [255, 256, 2**33], [2**64 - 1]):
        assert lm_scoring.unpacked(lm_scoring.packed(np.array(some, np.uint64))).tolist() == some
    assert len(lm_scoring.packed(np.array([1] * 90_000))) < 1000


def test_longer_runs_are_asked_for_behind_their_suffixes():
    part = pa.record_batch([pa.array(["a b c d", "b c", ""])], ["text"])
    stream, cuts = lm_scoring._stream(part)

    def asked(*runs):
        table = np.zeros(1 << 17, np.uint8)
        for run in runs:
            hashes = lm_scoring._stream(pa.record_batch([pa.array([run])], ["text"]))[0][1:-1]
            while len(hashes) > 1:
                hashes = lm_scoring.joined(hashes[:-1], hashes[1:])
            at = int(hashes[0]) % (8 << 17)
            table[at >> 3] |= 1 << (at & 7)
        return [(n, text.tolist()) for n, _, text in lm_scoring._runs(stream, cuts, 4, table)]

    assert asked("b c", "a b c") == [(n, []) for n in range(1, 6)]  # "c" is not there
    assert asked("c", "b c", "a b c") == [(1, [0, 1]), (2, [0, 1]), (3, [0]), (4, []), (5, [])]


@pytest.mark.parametrize("length", [2, 3])
def test_places_of_the_filter_are_counted_in_blocks(spark, documents, monkeypatch, length):
    monkeypatch.setattr(lm_scoring, "BATCH_BYTES", 3000)  # many batches, which only count together
    random.seed(4)
    rows = [(i, " ".join(random.choice("aaaabbbcdefgh") for _ in range(random.randint(0, 60)))) for i in range(80)]
    docs = documents(rows).selectExpr("doc_id", "false as held", "text")
    words = lm_scoring.word_counts(docs)
    known = lm_scoring.Known(words, 1, 1)
    if length == 3:
        known = lm_scoring.Known(lm_scoring.run_counts(docs, known, 2, 2, 1), 1, 1)
    bits, least = 1 << 20, 12
    seen = Counter()
    for _, text in rows:
        stream = lm_scoring._stream(pa.record_batch([pa.array([text])], ["text"]))[0]
        for _ in range(length - 1):
            stream = lm_scoring.joined(stream[:-1], stream[1:])
        seen.update(int(x) % bits for x in stream)
    got = lm_scoring.repeated_filter(docs, known, length, bits, least)
    want = {at for at, n in seen.items() if n >= least}
    assert want and want < set(seen)
    assert set(np.flatnonzero(np.unpackbits(got, bitorder="little")).tolist()) == want


def test_equal_batches_keep_their_sums(spark, documents):
    """Two partitions of the same rows make batches of one number."""
    random.seed(5)
    rows = [(i, " ".join(f"w{min(random.randint(0, 40), random.randint(0, 40))}" for _ in range(30))) for i in range(50)]
    once = documents(rows).coalesce(1)
    got = lm_scoring.scored(once.union(once).union(once), 4, 12, 3).collect()
    assert len(got) == 3 * len(rows)
    held = {d for d, _ in rows if zlib.crc32(str(d).encode()) % 7 == 2}
    counts = Counter(x for d, t in rows if d not in held for x in [*t.split(), None] for _ in range(3))
    total, texts = sum(counts.values()), dict(rows)
    for r in got:
        tokens = [*texts[r["doc_id"]].split(), None]
        base = sum(np.log10((counts.get(x, 0) + 1) / (total + len(counts) + 1)) for x in tokens)
        assert (r["n_tokens"], r["n_known"]) == (len(tokens), sum(x in counts for x in tokens))
        assert r["base_score"] == pytest.approx(base)
    assert len({(r["doc_id"], round(r["score"], 9)) for r in got}) == len(rows)


def test_nothing_to_score(spark, documents):
    assert lm_scoring.scored(documents([])).count() == 0


def test_pipeline_stages(spark, documents, odd_rows, tmp_path):
    random.seed(8)
    common = "the of and to in a is that it".split()
    clean = [" ".join(random.choice(common) + random.choice(["", "", str(random.randrange(50))]) for _ in range(80)) for _ in range(120)]
    junk = [" ".join(random.choice(["$$$", "!!!", "BUY###"]) for _ in range(80)) for _ in range(80)]
    item = " ".join(f"question{i}" for i in range(20))
    rows = [(i, t) for i, t in enumerate(clean)] + [(300 + i, t) for i, t in enumerate(junk)]
    rows += [(500, clean[3]), (501, clean[4] + " tail"), (502, clean[5] + " " + item), (503, clean[6][:200] + " " + " ".join(f"z{i} the of" for i in range(60)) + " password=abcdefg")]
    docs = documents(rows)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    labels = [(i, 1, 0) for i in range(120)] + [(300 + i, 0, 0) for i in range(80)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    state, seen = docs, {}
    for name, stage in corpus_pipeline.STAGES:
        state = stage(spark, state, str(tmp_path))
        state.write.parquet(f"{tmp_path}/{name.replace(' ', '_')}")
        state = spark.read.parquet(f"{tmp_path}/{name.replace(' ', '_')}")
        seen[name] = state
    names = list(seen)
    assert all(seen[n].columns == docs.columns for n in names[:-1])
    ids = [{r["doc_id"] for r in seen[n].select("doc_id").collect()} for n in names]
    assert ids[0] == set(range(120)) | {500, 501, 502, 503}
    groups = brute_components([r for r in rows if r[0] in ids[0]], 5, 80)
    assert ids[1] == {i for i, (_, g) in groups.items() if g == i}
    assert ids[2] == ids[1] - {502}
    secret = next(r for r in seen[names[3]].collect() if r["doc_id"] == 503)
    assert secret["text"].endswith("of [secret]") and secret["n_chars"] == len(secret["text"])
    assert ids[4] == ids[3] == ids[2]
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == state.count()


def test_pipeline_takes_odd_rows(spark, documents, odd_rows, tmp_path):
    """Null ids and texts, repeated rows, clashing columns; then empty tables."""
    for rows, folder in ((odd_rows + [(10, "the of and to in a " * 40), (None, "the of and to in a " * 40), (None, None)], "odd"), ([], "none")):
        base = tmp_path / folder
        documents(rows, extra=True).write.parquet(f"{base}/documents.parquet")
        spark.createDataFrame([(i, 1, 0) for i, _ in rows if i is not None], "doc_id long, quality int, toxic int").write.parquet(f"{base}/labels.parquet")
        spark.createDataFrame([(1, "a b c d e f g")] if rows else [], "item_id long, text string").write.parquet(f"{base}/benchmark.parquet")
        state = documents(rows, extra=True)
        for n, (_, stage) in enumerate(corpus_pipeline.STAGES):
            columns = state.columns
            stage(spark, state, str(base)).write.parquet(f"{base}/stage{n}")
            state = spark.read.parquet(f"{base}/stage{n}")
            assert n == 4 or state.columns == columns
            if n == 1:  # of equal sets with and without an id the one with the id stays, as do all without a set
                kept = sorted((r["doc_id"] is not None, r["doc_id"] or 0, r["text"] or "") for r in state.collect())
                want = [(i, t) for i, t in odd_rows[:6]] + [(6, "a b c d e f g"), (None, "no id here at all"), (10, "the of and to in a " * 40), (None, None)]
                assert kept == (sorted((i is not None, i or 0, t or "") for i, t in want) if rows else [])
            if n == 2:  # the benchmark item
                assert not [r for r in state.collect() if r["text"] == "a b c d e f g"]
        assert state.count() >= len({i for i, _ in rows if i not in (6, None)})
        assert corpus_pipeline.run(spark, str(base)).count() == state.count()


def test_names():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
    assert corpus_pipeline.ORACLE_SQL is None and 4 <= len(corpus_pipeline.STAGES) <= 5
