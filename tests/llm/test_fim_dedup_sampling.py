"""Fill-in-middle, exact duplicates and target sampling against brute force."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from packshot.llm import arrow_text, exact_dedup, fill_in_middle, target_sampling

UNIT = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


# fill-in-middle


def plain_example(doc_id, text, seed=42, percent=50, spm=80):
    text = text or ""
    units = UNIT.findall(text)
    n = len(units)
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[i : i + 8], 16) for i in (0, 8, 16, 24)]
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= percent:
        return (doc_id, n, "plain", None, None, sha(text), sha(text))
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    p, m, s = ("".join(x) for x in (units[:a], units[a:b], units[b:]))
    spm_form = h[3] % 100 < spm
    out = f"<S>{s}<P>{p}<M>{m}" if spm_form else f"<P>{p}<S>{s}<M>{m}"
    return (doc_id, n, "spm" if spm_form else "psm", len(p), len(m), sha(out), sha(text))


def texts(seed, n=150):
    rng = random.Random(seed)
    parts = ["a", "bc", "é中", " ", "  ", "\n", "\t", "\x0b", " ", " ", "<", "<S", "P>", "<M>", "word"]
    return [(i, "".join(rng.choice(parts) for _ in range(rng.randint(0, 60)))) for i in range(n)]


@pytest.mark.parametrize("error", [0, 3, 126])
def test_index_keeps_its_bound_and_gives_every_offset(error):
    rng = np.random.default_rng(error)
    for lengths in (rng.integers(1, 9, 5000), rng.choice([1, 400], 900), np.ones(700, int), [], [7], [70_000, 1, 1, 90_000]):
        offsets = np.concatenate([[0], np.cumsum(np.asarray(lengths, np.int64))])
        index = fill_in_middle.fit(offsets, error)
        ranks = np.arange(len(offsets))
        assert (index.cuts(ranks) == offsets).all()
        assert np.abs(index.residuals.astype(np.int64)).max() <= error + 1
        if error == 126:
            assert index.residuals.dtype == np.int8
    assert len(fill_in_middle.fit(np.arange(10_000) * 6).first) == 1  # a line is one segment


def test_boundaries_as_by_the_pattern():
    rows = texts(9, 400)
    found = fill_in_middle.boundaries(*arrow_text.buffer(pa.array([t for _, t in rows])))
    for (_, text), got in zip(rows, found, strict=True):
        assert got.tolist() == [0, *(m.end() for m in UNIT.finditer(text))]


def test_fill_in_middle(spark, documents, odd_rows, rows):
    data = odd_rows + [(i + 100, t) for i, t in texts(1)] + [(900, "long " * 400_000), (901, "<P> a b")]
    out = fill_in_middle.digests(fill_in_middle.fill_in_middle(documents(data, extra=True), percent=90))
    got = rows(out)
    key = lambda t: tuple((v is not None, str(v)) for v in t)
    assert got == sorted((plain_example(i, t, percent=90) for i, t in data), key=key)
    assert {r[2] for r in got} == {"plain", "psm", "spm"}


def test_stored_index_gives_the_cuts(spark, documents):
    data = texts(3)
    stored = {r["doc_id"]: r for r in fill_in_middle.boundary_index(documents(data), error=4).collect()}
    for doc_id, text in data:
        r = stored[doc_id]
        index = fill_in_middle.BoundaryIndex(
            *(np.array(r[c]) for c in ("first", "base", "slope")), np.frombuffer(r["residuals"], f"<i{r['width']}")
        )
        ends = [0, *(m.end() for m in UNIT.finditer(text))]
        assert r["n"] == len(ends) - 1 and index.cuts(np.arange(len(ends))).tolist() == ends


def test_fill_in_middle_of_nothing(spark, documents):
    assert fill_in_middle.fill_in_middle(documents([])).count() == 0
    assert fill_in_middle.boundary_index(documents([])).count() == 0


# exact duplicates


def test_table_compares_contents_and_not_hashes():
    table = exact_dedup.ContentTable(4)
    names = [b"", b"a", b"b", b"ab" * 9]
    got = [table.number(7, names[i % 4]) for i in range(40)]  # all share a hash
    assert got == [i % 4 for i in range(40)] and len(table) == 4
    many = [table.number(i % 50, str(i).encode()) for i in range(3000)]
    assert len(set(many)) == 3000 and [table.number(i % 50, str(i).encode()) for i in range(3000)] == many


def plain_groups(data):
    by = defaultdict(list)
    for at, (doc_id, text) in enumerate(data):
        by[text or ""].append((doc_id is not None, doc_id or 0, at))
    out = []
    for text, found in by.items():
        top = max(f[:2] for f in found)
        keep = top[1] if top[0] else None
        out += [(f[1] if f[0] else None, keep, len(found), sha(text)) for f in found]
    return sorted(out, key=str)


def copies(seed):
    rng = random.Random(seed)
    data = [(i, f"text {rng.randint(0, 60)} " * rng.randint(1, 4)) for i in range(500)]
    data += [(1000 + i, "hot text of many rows") for i in range(800)]
    rng.shuffle(data)
    return data


@pytest.mark.parametrize("limit", [200, 2_000, 1 << 25])
def test_duplicate_groups(spark, documents, odd_rows, limit):
    data = odd_rows + copies(limit)
    docs = documents(data, extra=True).repartition(7)
    got = exact_dedup.duplicate_groups(docs, limit).collect()
    assert sorted(((r["doc_id"], r["keep_id"], r["group_size"], r["text_sha256"]) for r in got), key=str) == plain_groups(data)
    kept = [r for r in got if r["kept"]]
    assert len(kept) == len({t or "" for _, t in data}) == len({r["text_sha256"] for r in kept})
    assert all(r["doc_id"] == r["keep_id"] for r in kept)


def test_large_buckets_go_to_further_levels(spark, documents, monkeypatch):
    levels = []
    plain = exact_dedup._grouped
    monkeypatch.setattr(exact_dedup, "_grouped", lambda r, limit, level=0: levels.append(level) or plain(r, limit, level))
    data = copies(5)
    assert len(exact_dedup.duplicate_groups(documents(data).repartition(8), 100).collect()) == len(data)
    assert max(levels) >= 1


@pytest.mark.parametrize("limit", [200, 1 << 25])
def test_without_copies_keeps_rows_whole(spark, documents, odd_rows, limit):
    data = odd_rows + copies(7)
    docs = documents(data, extra=True).repartition(5)
    out = exact_dedup.without_copies(docs, limit)
    assert out.columns == docs.columns
    got = out.collect()
    greatest = {}
    for doc_id, text in data:
        greatest[text or ""] = max(greatest.get(text or "", -1), -1 if doc_id is None else doc_id)
    assert {r["text"]: -1 if r["doc_id"] is None else r["doc_id"] for r in got} == greatest and len(got) == len(greatest)
    assert all(r["lang"] == "en" and r["node"] == "x" for r in got)


def test_no_rows_have_no_groups(spark, documents):
    assert exact_dedup.duplicate_groups(documents([])).count() == 0
    assert exact_dedup.without_copies(documents([])).count() == 0


# target sampling


def fold(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def plain_features(text, max_n, buckets):
    words = WORD.findall(fold(text))
    runs = [" ".join(words[i : i + k]) for k in range(1, max_n + 1) for i in range(len(words) - k + 1)]
    return len(words), Counter(zlib.crc32(r.encode()) % buckets for r in runs)


def plain_resampled(data, target, percent, max_n, buckets, least):
    feats = [(i, *plain_features(t, max_n, buckets)) for i, t in data]
    source, wanted = Counter(), Counter()
    for _, _, c in feats:
        source.update(c)
    for t in target:
        wanted.update(plain_features(t, max_n, buckets)[1])
    s_all, t_all = source.total(), wanted.total()
    gain = [
        math.floor(1000 * math.log((wanted[b] + 1) * (s_all + buckets) / ((source[b] + 1) * (t_all + buckets)))) for b in range(buckets)
    ]
    out = []
    for i, n_words, c in feats:
        weight = sum(gain[b] * n for b, n in c.items())
        h = int(hashlib.sha256(f"2024:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        out.append([i, c.total(), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), n_words])
    able = sorted((r for r in out if r[4] >= least), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    for place, r in enumerate(able, 1):
        r.append(place if place <= percent * len(able) // 100 else None)
    return sorted((tuple(r[:4]) + (r[5] if len(r) > 5 else None,) for r in out), key=str)


LINES = ["The quick brown fox", "a line that many texts hold", "é中 ſ K3 x_y", "", "  ", "MiXed CASE, punct!uation", "z" * 90, "one"]


def prose(seed, n):
    rng = random.Random(seed)
    return [(i, "\n".join(rng.choice(LINES) + (f" w{rng.randint(0, 30)}" if rng.random() < 0.5 else "") for _ in range(rng.randint(0, 12)))) for i in range(n)]


@pytest.mark.parametrize(("max_n", "held"), [(1, 1 << 25), (3, 1 << 25), (2, 40)])
def test_resampled(spark, documents, odd_rows, rows, max_n, held):
    data = odd_rows + [(i + 50, t) for i, t in prose(max_n, 200)]
    target = ["the quick fox w1 w2", "a line that many texts hold", None, "K3\nK3"]
    wanted = spark.createDataFrame([(t,) for t in target], "text string")
    out = target_sampling.resampled(documents(data, extra=True).repartition(3), wanted, 30, max_n, 500, 5, held_bytes=held)
    assert sorted((tuple(r) for r in out.collect()), key=str) == plain_resampled(data, target, 30, max_n, 500, 5)


def test_ranks_over_many_ranges(spark):
    data = [(i, 25, i % 9, 0, (i * 7) % 13) for i in range(500)]
    table = spark.createDataFrame(data, "doc_id long, n_words long, n_features long, weight long, score long")
    got = {r["doc_id"]: r["rank"] for r in target_sampling.ranked(table, 120, 500, rows_per_task=40).collect()}
    order = sorted(data, key=lambda r: (-r[4], r[0]))
    assert got == {r[0]: (i if i <= 120 else None) for i, r in enumerate(order, 1)}


def test_crc_of_spans():
    rng = np.random.default_rng(1)
    raw = rng.integers(0, 256, 4000, dtype=np.uint8)
    starts = rng.integers(0, 3000, 300)
    ends = starts + rng.choice([0, 1, 2, 5, 63, 64, 65, 900], 300)
    got = target_sampling.crc32_of(raw, starts, ends).tolist()
    assert got == [zlib.crc32(raw[a:b].tobytes()) for a, b in zip(starts, ends, strict=True)]


def test_nothing_to_sample(spark, documents):
    none = spark.createDataFrame([], "text string")
    assert target_sampling.resampled(documents([]), none).count() == 0
    got = target_sampling.resampled(documents([(1, "a b"), (2, None)]), none).collect()
    assert [r["rank"] for r in got] == [None, None]
