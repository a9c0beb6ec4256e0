"""Each operator against a brute-force version, and its answers to odd input."""

from __future__ import annotations

import collections
import hashlib
import os
import random
import re
import string
import zlib

import numpy as np
import pyarrow as pa
import pytest

DOC = "doc_id bigint, text string, source string, key string, s string, n int"


def corpus(seed=5, docs=60):
    """Documents with copies, near copies, shared passages, nulls, blanks and a very long text."""
    rng = random.Random(seed)
    vocabulary = ["".join(rng.choices("abcdé", k=rng.randint(2, 5))) for _ in range(400)]
    words = lambda n: [rng.choice(vocabulary) for _ in range(n)]
    passage, line = words(45), words(40)
    texts = []
    for i in range(docs):
        w = words(rng.randint(20, 120))
        if i % 4 == 1:
            w[10:10] = passage
        if i % 7 == 2:
            w += line
        texts.append(w)
    for i in range(0, docs, 6):
        near = list(texts[i])
        near[len(near) // 2] = "changed"
        texts += [texts[i], near]
    texts.append(["loop"] * 90)
    texts.append(words(3000))
    rows = [(i, " ".join(t), f"s{i % 3}", "k", "s", 1) for i, t in enumerate(texts)]
    n = len(rows)
    return rows + [(n, None, None, None, None, None), (n + 1, "", "s1", "k", "s", 1), (n + 2, " \t\n", "s1", "k", "s", 1), (n + 3, "One two\x0bTHREE", "s2", "k", "s", 1), (n + 4, "one  two three", "s2", "k", "s", 1)]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(corpus(), DOC).repartition(3)


def test_factors():
    """Factors rebuild their blocks, each is as long as any match, and repeated windows are those of brute force."""
    from tickline.llm.factors import factors, repeated_windows

    rng = np.random.default_rng(1)
    for window in (1, 3, 8):
        blocks = [rng.integers(0, 3, rng.integers(0, 40)) for _ in range(12)] + [np.zeros(30, np.int64)]
        blocks[5] = np.concatenate([blocks[4], blocks[2]])
        f = factors(blocks, window)
        texts = [b.tolist() for b in blocks]
        starts = [(i, p) for i, t in enumerate(texts) for p in range(len(t) - window + 1)]

        def agree(i, p, j, q):
            n = 0
            while p + n < len(texts[i]) and q + n < len(texts[j]) and texts[i][p + n] == texts[j][q + n]:
                n += 1
            return n

        end = {}
        for i, p, j, q, n in zip(*(x.tolist() for x in (f.block, f.place, f.source, f.source_place, f.length)), strict=True):
            assert end.get(i, 0) == p
            assert n == max([agree(i, p, *o) for o in starts if o != (i, p)], default=0)
            assert n == 0 or (texts[i][p : p + n] == texts[j][q : q + n] and (i, p) != (j, q))
            end[i] = p + max(1, n)
        assert all(end.get(i, 0) >= len(t) - window + 1 for i, t in enumerate(texts))
        count = collections.Counter(tuple(texts[i][p : p + window]) for i, p in starts)
        for t, hit in zip(texts, repeated_windows(blocks, window), strict=True):
            assert hit.tolist() == [count[tuple(t[p : p + window])] > 1 for p in range(len(t) - window + 1)]


@pytest.mark.parametrize("hot", [None, 0])
def test_substring_dedup(spark, docs, monkeypatch, hot):
    from tickline.llm import fragments
    from tickline.llm.substring_dedup import dedup_substrings

    if hot is not None:
        monkeypatch.setattr(fragments, "HOT_BYTES", hot)
    rows, window = corpus(), 35
    tokens = {r[0]: (r[1] or "").encode().split() for r in rows}
    count = collections.Counter(tuple(t[j : j + window]) for t in tokens.values() for j in range(len(t) - window + 1))
    got = {r["doc_id"]: r for r in dedup_substrings(docs).collect()}
    assert len(got) == len(rows)
    for i, t in tokens.items():
        keep = [True] * len(t)
        for j in range(len(t) - window + 1):
            if count[tuple(t[j : j + window])] > 1:
                keep[j : j + window] = [False] * window
        kept = b" ".join(x for x, k in zip(t, keep, strict=True) if k)
        assert (got[i]["n_words"], got[i]["n_removed"], got[i]["kept_sha256"]) == (len(t), keep.count(False), hashlib.sha256(kept).hexdigest())


def brute_bytes(rows, length=50):
    seen, out = set(), {}
    for i, text in sorted((r[0], r[1]) for r in rows):
        raw = (text or "").encode()
        mark, own = bytearray(len(raw)), []
        for j in range(len(raw) - length + 1):
            piece = raw[j : j + length]
            own.append(piece)
            if piece in seen:
                mark[j : j + length] = b"\x01" * length
        seen.update(own)
        kept = bytes(b for b, m in zip(raw, mark, strict=True) if not m)
        out[i] = (len(raw), sum(mark), sum(1 for j in range(len(mark)) if mark[j] and (j == 0 or not mark[j - 1])), hashlib.sha256(kept).hexdigest())
    return out


@pytest.mark.parametrize("hot", [None, 0])
def test_suffix_dedup(spark, docs, monkeypatch, hot):
    """Fragments dealt out by anchor, and all of them by the longer anchor."""
    from tickline.llm import fragments
    from tickline.llm.suffix_dedup import dedup_bytes

    if hot is not None:
        monkeypatch.setattr(fragments, "HOT_BYTES", hot)
    got = {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in dedup_bytes(docs).collect()}
    assert got == brute_bytes(corpus())


def test_bwt_merge():
    from tickline.llm.bwt import repeated_intervals

    rng = np.random.default_rng(1)
    for trial in range(40):
        strings = [rng.integers(0, 2 + trial % 3, size=rng.integers(1, 40)).astype(np.uint8) + np.uint8(1) for _ in range(rng.integers(1, 12))]
        starts, block = repeated_intervals(strings, 6, shard=int(rng.integers(5, 120)))
        text = np.concatenate([y for x in strings for y in (x, [0])]).astype(np.uint8)
        assert sorted(starts) == list(range(len(text)))
        groups = collections.defaultdict(set)
        for s, b in zip(starts, block, strict=True):
            if s + 6 <= len(text) and 0 not in text[s : s + 6]:
                groups[b].add(bytes(text[s : s + 6]))
        assert all(len(v) == 1 for v in groups.values()) and len({next(iter(v)) for v in groups.values()}) == len(groups)


def brute_jaccard(rows, size, percent):
    low = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))
    sets = {}
    for r in rows:
        w = (r[1] or "").encode().translate(low).split()
        sets[r[0]] = {tuple(w[j : j + size]) for j in range(max(1, len(w) - size + 1))} if w else set()
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for a in ids:
        for b in ids:
            if a < b and sets[a] and sets[b]:
                both = len(sets[a] & sets[b])
                if 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                    x, y = find(a), find(b)
                    root[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), find(i)) for i in ids}


@pytest.mark.parametrize(("size", "percent"), [(4, 85), (5, 80)])
def test_jaccard_join(spark, docs, size, percent):
    from tickline.llm.jaccard_join import jaccard_components

    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard_components(docs, size=size, percent=percent).collect()}
    assert got == brute_jaccard(corpus(), size, percent)


def crowded(seed=3):
    """A large group of near copies at all distances around the threshold, and a passage that many texts share."""
    rng = random.Random(seed)
    words = lambda n: [f"w{rng.randint(0, 5000)}" for _ in range(n)]
    base, passage = words(90), words(60)
    texts = []
    for i in range(140):
        w = list(base)
        for _ in range(i % 8):
            w[rng.randrange(len(w))] = f"x{rng.randint(0, 10**6)}"
        texts.append(w)
    texts += [words(rng.randint(0, 14)) + passage + words(rng.randint(0, 14)) for _ in range(120)]
    texts += [base, passage, words(30)] * 3
    return [(i, " ".join(t), "s", "k", "s", 1) for i, t in enumerate(texts)]


@pytest.mark.parametrize("rows", [1 << 15, 16])
def test_jaccard_join_of_crowds(spark, monkeypatch, rows):
    """Whole buckets, and buckets dealt out in blocks."""
    from tickline.llm import jaccard_join

    monkeypatch.setattr(jaccard_join, "ROWS", rows)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard_join.jaccard_components(spark.createDataFrame(crowded(), DOC).repartition(3)).collect()}
    assert got == brute_jaccard(crowded(), 4, 85)


def test_signatures_lose_no_link():
    from tickline.llm.jaccard_join import _Bucket, _sets, rare_first, signatures, overlap_needed  # noqa: F401
    import pyarrow as pa

    rng = np.random.default_rng(2)
    universe = rng.integers(0, 2**63, 900).astype(np.uint64)
    sets = [np.sort(rng.choice(universe[:k], size=int(k * f), replace=False)) for k in (40, 200, 900) for f in (0.85, 0.9, 0.95) for _ in range(12)]
    g, edge = np.concatenate(sets), np.concatenate([[0], np.cumsum([len(x) for x in sets])])
    d = np.repeat(np.arange(len(sets)), np.diff(edge))
    n = np.diff(edge)
    raw = signatures(g, d, edge, 85)
    token, row = rare_first(g, d, edge, np.zeros(1 << 10, np.uint8), n - overlap_needed(n, 85) + 1)
    place = np.arange(len(row)) - np.searchsorted(row, row)
    k = len(row)
    none = pa.array([[]] * k, pa.list_(pa.int64()))
    batch = pa.RecordBatch.from_arrays(
        [pa.array(token.view(np.int64)), pa.array(np.zeros(k, np.int64)), pa.array(row), pa.array(row), pa.array(n[row].astype(np.int32)), pa.array(place), pa.array(row), pa.array(np.ones(k, bool)), pa.array([raw[r].tobytes() for r in row], pa.binary()), none],
        names=["token", "block", "rank", "class", "n", "place", "root", "home", "signature", "firsts"],
    )
    pairs = {tuple(x) for part in _Bucket([batch]).pairs(1 << 30, 85) for x in part.tolist()}
    linked = {(a, b) for a in range(len(sets)) for b in range(a) if 100 * (c := len(np.intersect1d(sets[a], sets[b]))) >= 85 * (len(sets[a]) + len(sets[b]) - c)}
    linked = {(min(p), max(p)) for p in linked}
    assert linked and linked <= pairs


def test_bucket_rows_are_thin(spark, monkeypatch):
    """A class has a bucket row for each shingle of its prefix, so a row's bytes decide the join's disk."""
    from tickline.llm import jaccard_join

    pairs = jaccard_join._pairs

    def thin_pairs(hi, percent):
        run = pairs(hi, percent)

        def thin(batches):
            for batch in batches:
                if batch.nbytes > 192 * batch.num_rows:
                    raise ValueError(f"{batch.nbytes} bytes of {batch.num_rows} bucket rows")
                yield batch

        return lambda batches: run(thin(batches))

    monkeypatch.setattr(jaccard_join, "_pairs", thin_pairs)
    rows = crowded()
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard_join.jaccard_components(spark.createDataFrame(rows, DOC).repartition(3)).collect()}
    assert got == brute_jaccard(rows, 4, 85)


def test_prefixes_of_linked_sets_meet():
    from tickline.llm.jaccard_join import prefixes_meet, signatures

    rng = np.random.default_rng(4)
    universe = rng.integers(0, 2**63, 500).astype(np.uint64)
    sets = [np.sort(rng.choice(universe[:k], size=int(k * f), replace=False)) for k in (12, 40, 200, 500) for f in (0.85, 0.95) for _ in range(12)]
    edge = np.concatenate([[0], np.cumsum([len(x) for x in sets])])
    raw = signatures(np.concatenate(sets), np.repeat(np.arange(len(sets)), np.diff(edge)), edge, 85).view(np.uint64)
    x, y = (i.ravel() for i in np.meshgrid(np.arange(len(sets)), np.arange(len(sets))))
    both = np.array([len(np.intersect1d(sets[a], sets[b])) for a, b in zip(x, y, strict=True)])
    size = np.diff(edge)
    linked = 100 * both >= 85 * (size[x] + size[y] - both)
    meet = prefixes_meet(raw[x], raw[y])
    assert (linked & (x != y)).any() and meet[linked].all()
    # short sets that share nothing seldom pass
    apart = signatures(rng.integers(0, 2**63, 400).astype(np.uint64), np.repeat(np.arange(20), 20), np.arange(0, 401, 20), 85).view(np.uint64)
    assert prefixes_meet(apart[:10], apart[10:]).sum() <= 1


def test_components(spark):
    from tickline.llm.components import components

    edges = [(1, 2), (2, 3), (5, 4), (4, 4), (9, 9), (None, 1), (3, 1), (2, 1), *((20 + i, 21 + i) for i in range(30))]
    got = dict(components(spark.createDataFrame(edges, "u int, v int")).collect())
    assert got == {1: 1, 2: 1, 3: 1, 4: 4, 5: 4, 9: 9} | {20 + i: 20 for i in range(31)}


def test_mixing(spark, docs):
    from tickline.llm.mixing import mix_sources

    rows = corpus()
    size = {r[0]: len((r[1] or "").encode().split()) for r in rows}
    source = {r[0]: r[2] for r in rows}
    total = collections.Counter()
    for i, n in size.items():
        total[source[i]] += n
    names = sorted(total, key=lambda s: (s is None, s))
    weight = {s: 1 + i % 3 for i, s in enumerate(names)}
    capped = set()
    while True:
        free = [s for s in names if s not in capped]
        level = (sum(total.values()) - sum(3 * total[s] for s in capped)) / sum(weight[s] for s in free)
        more = {s for s in free if level * weight[s] >= 3 * total[s]}
        if not more:
            break
        capped |= more
    goal = {s: 3.0 * total[s] if s in capped else level * weight[s] for s in names}
    got = {r["doc_id"]: r for r in mix_sources(docs).collect()}
    assert len(got) == len(rows)
    taken = collections.Counter()
    for i, r in got.items():
        assert r["size"] == size[i] and r["source_size"] == total[source[i]] and r["target"] == pytest.approx(goal[source[i]]) and 0 <= r["taken"] <= 3 * size[i]
        assert (r["position"] is None) == (r["taken"] == 0) and all(0 <= t <= 1 for t in r["copies"])
        taken[source[i]] += r["taken"]
    assert all(abs(taken[s] - goal[s]) <= 0.5 for s in names)
    assert [r["taken"] for r in sorted(got.values(), key=lambda r: r["doc_id"])] == [r["taken"] for r in mix_sources(docs.repartition(5)).orderBy("doc_id").collect()]


def test_training_time(spark):
    from pyspark.sql import functions as F

    from tickline.llm.mixing import SCHEDULES, training_time

    for schedule in SCHEDULES:
        for share in (0.0, 0.2, 0.5, 0.9, 1.0):
            t = spark.range(1).select(training_time(F.lit(share), schedule)).first()[0]
            grid = np.linspace(0, 1, 100_001)
            w = np.interp(grid, [k[0] for k in schedule], [k[1] for k in schedule])
            demand = np.cumsum(w) / w.sum()
            assert abs(np.interp(share, demand, grid) - t) < 1e-3


def test_quality(spark):
    from tickline.llm.quality import fit, score_quality

    rng = random.Random(3)
    rows, labels = [], []
    for i in range(700):
        good = rng.random() < 0.7
        w = ["".join(rng.choices("abcdefgh", k=rng.randint(2, 7))) for _ in range(rng.randint(20, 80))]
        rows.append((i, (" ".join(w) + ".") if good else " ".join(x + "%%%" for x in w), "s", "k", "s", 1))
        labels.append((i, int(good)))
    rows += [(1000, None, None, None, None, None), (1001, "", "s", "k", "s", 1), (None, "text without id", "s", "k", "s", 1)]
    docs, marks = spark.createDataFrame(rows, DOC), spark.createDataFrame(labels + [(5000, 1), (3, None)], "doc_id bigint, quality int")
    got = {r["doc_id"]: r for r in score_quality(docs, marks).collect()}
    assert len(got) == len(rows)
    held = [(got[i], y) for i, y in labels if zlib.crc32(str(i).encode()) % 5 == 0]
    assert all(r["held_out"] for r, _ in held) and sum(r["predicted"] == y for r, y in held) / len(held) > 0.95
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3) for r in got.values())
    none = score_quality(docs, marks.limit(0)).select("score").distinct().collect()
    assert [r[0] for r in none] == [0.5]
    assert not fit(np.zeros((60, 2)), np.ones(60), ["a", "b"]).rules


def plain_statistics(text):
    """The statistics of one text, counted one by one."""
    data = (text or "").encode()
    w = re.split(rb"[\x20\x09-\x0D]+", data)
    w = [x for x in w if x]
    lines = re.findall(rb"[^\n]*\n|[^\n]+", data)
    share = lambda chars: sum(c in chars for c in data) / max(1, len(data))
    many, five = max(1, len(w)), {tuple(w[i : i + 5]) for i in range(len(w) - 4)}
    out = [np.log1p(len(w)), sum(map(len, w)) / many]
    out += [share(c) for c in (string.ascii_uppercase.encode(), b"0123456789", b".", b",", b"!?", b"|", b"#$%&*@^~<>{}[]\\=+_", b"\n", b" \t\r\x0b\x0c", bytes(range(128, 256)))]
    out += [len(set(w)) / many, max(collections.Counter(w).values(), default=0) / many, sum(a == b for a, b in zip(w, w[1:], strict=False)) / many, len(five) / max(1, len(w) - 4)]
    return [*out, len(set(lines)) / max(1, len(lines)), len(w) / max(1, len(lines)), len(w) / (data.count(b".") + 1)]


def test_statistics():
    from tickline.llm.quality import statistics
    from tickline.llm.text import chunks

    rng = random.Random(41)
    texts = ["".join(rng.choices(["a", "b", "word", "Word", " ", " ", "\n", "\t", ".", ",", "|", "é", "7", "$"], k=rng.randint(0, 80))) for _ in range(300)]
    texts += [None, "", "\n", "a\n", "a\n\n", " ", "x " * 50_000, *(r[1] for r in corpus())]
    got = np.concatenate([statistics(data, off) for _, _, data, off in chunks(pa.array(texts))])
    assert np.allclose(got, [plain_statistics(t) for t in texts], rtol=1e-12, atol=1e-12)


def test_batches_to_workers_are_small_by_bytes(spark):
    from tickline.llm.shared import BATCH_BYTES, small_batches

    name, sizes = "spark.sql.execution.arrow.maxBytesPerBatch", lambda batches: (pa.RecordBatch.from_pydict({"rows": [b.num_rows], "bytes": [b.nbytes]}) for b in batches)
    frame = lambda: spark.range(0, 2000, 1, 1).selectExpr("id", "repeat(string(id % 10), 10000) as text").mapInArrow(sizes, "rows bigint, bytes bigint")
    before = spark.conf.get(name)
    assert max(r["bytes"] for r in frame().collect()) > 2 * BATCH_BYTES
    with small_batches(spark):
        got = frame().collect()
    assert sum(r["rows"] for r in got) == 2000 and max(r["bytes"] for r in got) <= 1.1 * BATCH_BYTES
    assert spark.conf.get(name) == before


def test_quality_rules_stay_out_of_the_plan(spark, monkeypatch):
    """Hundreds of rules score as they say, and the driver's plan doesn't grow with them: planning them took the driver's memory."""
    from tickline.llm import quality

    rng = random.Random(43)
    rule = lambda: ([(rng.choice(quality.STATS), rng.random() < 0.5, rng.choice([0.0, 0.05, 0.2, 0.5, 1.0, 2.5])) for _ in range(rng.randint(1, 3))], rng.uniform(-0.5, 0.5))
    plans, texts = [], [*(r[1] for r in corpus()), None, ""]
    docs = spark.createDataFrame([(i, t, "s", "k", "s", 1) for i, t in enumerate(texts)], DOC).selectExpr("*", "doc_id * 3 as mark").repartition(3)
    for n in (1, 300):
        model = quality.Rules(-0.25, [rule() for _ in range(n)])
        monkeypatch.setattr(quality, "fit", lambda *_, model=model: model)
        out = quality.score_quality(docs, spark.createDataFrame([(0, 1)], "doc_id bigint, quality int"), key_col="mark")
        plans.append(len(out._jdf.queryExecution().optimizedPlan().toString()))
        got = {r["doc_id"]: r for r in out.collect()}
        assert len(got) == len(texts)
        for i, text in enumerate(texts):
            stats = dict(zip(quality.STATS, plain_statistics(text), strict=True))
            total = -0.25 + sum(w for tests, w in model.rules if all(stats[s] > at if above else stats[s] <= at for s, above, at in tests))
            assert got[i]["score"] == pytest.approx(1 / (1 + np.exp(-total))) and got[i]["mark"] == 3 * i
            assert got[i]["predicted"] == int(got[i]["score"] >= 0.3) and got[i]["held_out"] == (zlib.crc32(str(i).encode()) % 5 == 0)
    assert plans[1] < 1.1 * plans[0]


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.01"), reason="needs the test tables")
def test_quality_of_held_out_labels(spark):
    """On the labels of the fold that the fit never sees: most are predicted, and the scores put them in order."""
    from tickline.llm.queries import op9_rule_ensemble_quality

    sf = "/root/testdata/sf0.01"
    marks = spark.read.parquet(f"{sf}/labels.parquet").where("quality is not null")
    rows = op9_rule_ensemble_quality(spark, sf).where("held_out").join(marks, "doc_id").collect()
    good, bad = ([r["score"] for r in rows if r["quality"] == y] for y in (1, 0))
    assert len(good) > 30 and len(bad) > 5
    assert sum(r["predicted"] == r["quality"] for r in rows) / len(rows) > 0.9
    assert sum((g > b) + (g == b) / 2 for g in good for b in bad) / (len(good) * len(bad)) > 0.95


def test_nearest(spark):
    from tickline.llm.ann import nearest

    rng = np.random.default_rng(2)
    centres = rng.normal(size=(12, 16))
    x = (centres[rng.integers(0, 12, 1500)] + rng.normal(size=(1500, 16)) * 0.7).astype(np.float32)
    x[7] = x[3]
    rows = [(i, v.tolist(), 1) for i, v in enumerate(x)] + [(2000, None, 1), (2001, [0.0] * 16, 1), (2002, [None] + [1.0] * 15, 1), (2003, [float("nan")] * 16, 1), (2004, [float("inf")] * 16, 1), (2005, [], 1), (None, [1.0] * 16, 1), (2006, [1.0] * 3, 1)]
    vectors = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>, id int")
    asked = vectors.where("vec_id % 20 = 0")
    got = collections.defaultdict(list)
    for r in nearest(vectors, asked, block=200).orderBy("query_id", "rank").collect():
        got[r["query_id"]].append((r["vec_id"], r["score"], r["rank"]))
    assert set(got) == set(range(0, 1500, 20))
    exact = x.astype(float)
    hits = 0
    for q, found in got.items():
        s = (exact * exact[q]).sum(axis=1)
        s[q] = -np.inf
        best = np.lexsort((np.arange(1500), -s))[:20]
        hits += len(set(best.tolist()) & {v for v, _, _ in found})
        assert [k for _, _, k in found] == list(range(1, 21)) and all(score == s[v] for v, score, _ in found)
        assert found == sorted(found, key=lambda f: (-f[1], f[0]))
    assert hits / (20 * len(got)) >= 0.9
    assert nearest(vectors.limit(0), asked.limit(0)).count() == 0
    small = vectors.where("vec_id < 8")
    assert {r["query_id"]: r["n"] for r in nearest(small, small).groupBy("query_id").agg({"*": "count"}).withColumnRenamed("count(1)", "n").collect()} == dict.fromkeys(range(8), 7)


def test_archives(spark, tmp_path):
    from tickline.llm.arc import archive_pages

    long = "<p>" + "é" * 80
    rows = [(5, "http://a/", long), (2, "http://b/ c", long), (9, None, long), (1, "http://d/", "short"), (3, "u", "short"), (4, "u", None), (6, "u", ""), (7, "u", "WARC/1.1\r\n\r\n" * 30)]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string").repartition(3)
    got = {r["page_id"]: r for r in archive_pages(pages, str(tmp_path / "out")).collect()}
    assert len(got) == len(rows)
    for i, _, html in rows:
        raw = (html or "").encode()
        assert (got[i]["payload_bytes"], got[i]["payload_digest"]) == (len(raw), hashlib.sha256(raw).hexdigest())
    assert {i: (r["record_type"], r["refers_to"]) for i, r in got.items()} == dict.fromkeys((2, 1, 3, 4, 6, 7), ("response", None)) | dict.fromkeys((5, 9), ("revisit", 2))
    assert archive_pages(pages.limit(0), str(tmp_path / "none")).count() == 0


def test_arc_forms():
    import gzip

    from tickline.llm.arc import arc_record, parse_arc, parse_warc, version_block, warc_date, warc_record

    for version in (1, 2):
        whole = [version_block(version, "a.arc") + b"\n", *(arc_record(version, i, f"http://x/{i} y", b"body\n\n" * i, "a.arc", 0) + b"\n" for i in range(3))]
        for raw in (b"".join(whole), gzip.compress(b"".join(whole)), b"".join(map(gzip.compress, whole))):
            records = list(parse_arc(memoryview(raw)))
            assert [r.url for r in records] == [b"http://x/%d%%20y" % i for i in range(3)] and [r.block.endswith(b"body\n\n" * i) for i, r in enumerate(records)] == [True] * 3
        with pytest.raises(ValueError):
            list(parse_arc(memoryview(b"".join(whole)[:-8])))
    assert warc_date(b"20010203040506") == b"2001-02-03T04:05:06Z" and warc_date(b"20010203") == b"2001-02-03T00:00:00Z"
    record = warc_record([(b"WARC-Type", b"response")], b"x\r\n") + b"\n"
    assert [(f[b"warc-type"], b) for f, b in parse_warc(memoryview(record * 2))] == [(b"response", b"x\r\n")] * 2


def test_url_filter(spark):
    from tickline.llm.urls import filter_urls

    canonical = lambda u: f"<html><LINK href='{u}' rel=canonical>"
    rows = [
        (1, "https://Blog.Example.ORG/es/x?q", None), (2, "https://example.org/en/12#top", ""), (3, "http://example.org/en/2", "x"), (4, "http://a.net/1", canonical("http://shop.com/de/1")), (5, "http://b.net/2", '<meta http-equiv="refresh" content="0; url=http://a.net/1">'),
        (6, "http://c.com/fr/3", canonical("http://shop.com/de/1")), (7, None, canonical("http://shop.com/de/1")), (8, "no scheme", None), (9, "http://d.net", canonical("/other")), (10, "http://notexample.org/es/", None), (11, "http://shop.com?/de/", None), (12, "http://b.net/2", None),
    ]
    got = {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in filter_urls(spark.createDataFrame(rows, "page_id bigint, url string, html string")).collect()}
    assert got == {
        1: ("blog.example.org", "/es/x", "example.org/es/", "block"), 2: ("example.org", "/en/12", "example.org/en/1", "block"), 3: ("example.org", "/en/2", "org/", "allow"), 4: ("a.net", "/1", None, "block"), 5: ("b.net", "/2", None, "block"),
        6: ("c.com", "/fr/3", "com/fr/", "allow"), 7: ("", "", None, "allow"), 8: ("", "", None, "allow"), 9: ("d.net", "", None, "allow"), 10: ("notexample.org", "/es/", "org/", "allow"), 11: ("shop.com", "", None, "allow"), 12: ("b.net", "/2", None, "block"),
    }


def test_nearest_goes_on_past_small_parts(spark, monkeypatch):
    """A query whose own part holds few rows, some of them with its id, still gets k neighbours."""
    from tickline.llm import ann

    eye = np.eye(3) * 20
    monkeypatch.setattr(ann, "learn", lambda *_: ann.Router(np.eye(3), np.zeros(3), eye, np.zeros(3), 0.5))
    rows = [(0, [1.0, 0.1, 0.0])] * 4 + [(i, [1.0, 0.1, 0.0]) for i in range(1, 4)] + [(i, [0.1, 1.0, 0.0]) for i in range(4, 22)] + [(i, [0.0, 0.1, 1.0]) for i in range(22, 60)]
    vectors = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    found = ann.nearest(vectors, vectors.where("vec_id in (0, 5, 30)").dropDuplicates(["vec_id"]), k=20).groupBy("query_id").count().collect()
    assert {r["query_id"]: r["count"] for r in found} == {0: 20, 5: 20, 30: 20}


def brute_align(a, b):
    best = 0
    rows = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a, 1):
        for j, y in enumerate(b, 1):
            rows[i][j] = max(0, rows[i - 1][j - 1] + (2 if x == y else -1), rows[i - 1][j] - 1, rows[i][j - 1] - 1)
            best = max(best, rows[i][j])
    return best


def test_alignment():
    from tickline.llm.decontaminate import align

    rng = random.Random(4)
    for _ in range(60):
        a, b = ([rng.randint(0, 4) for _ in range(rng.randint(1, 15))] for _ in range(2))
        score, s, e = align(np.array(a, np.uint64), np.array(b, np.uint64))
        assert score == brute_align(a, b) and score == brute_align(a, b[s:e])


def test_decontamination(spark):
    from tickline.llm.decontaminate import find_leaks

    rng = random.Random(6)
    w = lambda n: ["".join(rng.choices("abcdefgh", k=4)) for _ in range(n)]
    items = [w(30) for _ in range(5)]
    edited = list(items[1])
    edited[5], edited[20] = "other", "words"
    del edited[12]
    texts = [w(50), w(10) + items[0] + w(10), w(80) + edited + w(5), w(4000) + [x.upper() + "," for x in items[2]], items[3][:4] + w(60), [], None]
    docs = spark.createDataFrame([(i, None if t is None else " ".join(t), "s", "k", "s", 1) for i, t in enumerate(texts)], DOC)
    bench = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(items)] + [(90, None), (91, ""), (92, "two words")], "item_id bigint, text string")
    got = {(r["doc_id"], r["item_id"]): r for r in find_leaks(docs, bench).collect()}
    assert set(got) == {(1, 0), (2, 1), (3, 2)} and got[1, 0]["score"] == 1.0 and (got[1, 0]["start_word"], got[1, 0]["end_word"]) == (10, 40) and 0.7 < got[2, 1]["score"] < 1
    assert find_leaks(docs, bench.limit(0)).count() == find_leaks(docs.limit(0), bench).count() == 0


@pytest.mark.parametrize("copies", [4, 1000])
def test_decontamination_finds_frequent_edited_copies(spark, copies):
    """Over half of the 3-grams are destroyed; a whole copy elsewhere does not hide the edited ones either."""
    from tickline.llm.decontaminate import find_leaks

    rng = random.Random(12)
    w = lambda n: ["".join(rng.choices("abcdefgh", k=5)) for _ in range(n)]
    item, second = w(30), w(30)
    edited, edited_too = list(item), list(second)
    for at in (3, 8, 13, 18, 23):
        edited[at], edited_too[at] = w(2)
    texts = [w(20) + edited + w(20) for _ in range(copies)] + [w(20) + edited_too + w(20) for _ in range(copies)] + [w(20) + second + w(20), w(80)]
    docs = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(texts)], "doc_id bigint, text string")
    bench = spark.createDataFrame([(0, " ".join(item)), (1, " ".join(second))], "item_id bigint, text string")
    got = {(r["doc_id"], r["item_id"]): r["score"] for r in find_leaks(docs, bench).collect()}
    assert got == {**{(i, 0): 0.75 for i in range(copies)}, **{(copies + i, 1): 0.75 for i in range(copies)}, (2 * copies, 1): 1.0}


def test_decontamination_spares_only_frequent_grams(spark):
    from tickline.llm.decontaminate import find_leaks

    rng = random.Random(13)
    w = lambda n: ["".join(rng.choices("abcdefgh", k=5)) for _ in range(n)]
    item = w(30)
    edited = [*item[:9], "put", *item[9:20], "in", *item[20:]]
    texts = [w(10) + edited + w(10)] + [w(10) + item[:18] + w(10) for _ in range(8)]
    docs = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(texts)], "doc_id bigint, text string")
    bench = spark.createDataFrame([(0, " ".join(item))], "item_id bigint, text string")
    assert [r["doc_id"] for r in find_leaks(docs, bench, share=0.9).collect()] == [0]


def test_licenses(spark):
    from tickline.llm.licenses import TEMPLATES, longest_increasing, patience, scan_licenses

    assert longest_increasing([3, 1, 2, 5, 4]) in ([1, 2, 4], [1, 2, 3])
    assert patience("abcxdef", "abydef") == [(0, 0), (1, 1), (4, 3), (5, 4), (6, 5)]
    mit = TEMPLATES["MIT-text"]
    texts = ["word " * 50 + "Released under the MIT license. more", mit.upper().replace(" ", "\n"), mit.replace("hereby ", "") + " tail", "the license of this is under discussion", "", None, "Licensed under the Apache License, Version 2.0 and under CC BY-NC 4.0: Licensed under CC BY-NC 4.0."]
    docs = spark.createDataFrame([(i, t, "s", "k", "s", 1) for i, t in enumerate(texts)], DOC)
    got = collections.defaultdict(dict)
    for r in scan_licenses(docs).collect():
        got[r["doc_id"]][r["license"]] = r
    assert {i: set(v) for i, v in got.items()} == {0: {"MIT"}, 1: {"MIT-text"}, 2: {"MIT-text"}, 6: {"Apache-2.0", "CC-BY-NC-4.0"}}
    assert (got[0]["MIT"]["start_word"], got[0]["MIT"]["end_word"]) == (50, 55) and 0.9 < got[2]["MIT-text"]["coverage"] < 1


def test_licenses_with_end_words_around(spark):
    """Exact notices are found where the template's first and last words stand before and after them too."""
    from tickline.llm.licenses import TEMPLATES, scan_licenses

    rows, want = [], {}
    for name, template in TEMPLATES.items():
        first, last = template.split()[0], template.split()[-1]
        for gap in (0, 1, 4):
            want[len(rows)] = (name, 2 + gap)
            rows.append((len(rows), f"x {first} {'y ' * gap}{template} {'y ' * gap}{last} z"))
    want[len(rows)] = ("CC-BY-4.0", 3)
    rows.append((len(rows), "The code is licensed under CC BY 4.0 (version 4.0)"))
    want[len(rows)] = ("GPL-3.0", 5)
    rows.append((len(rows), "this is some of all This work is licensed under the GNU General Public License, version 3"))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = {(r["doc_id"], r["license"]): (r["coverage"], r["start_word"]) for r in scan_licenses(docs).collect()}
    assert {(i, name): got.get((i, name)) for i, (name, _) in want.items()} == {(i, name): (1.0, at) for i, (name, at) in want.items()}


def test_licenses_without_their_rarest_words(spark):
    """Against brute force: copies that lack words which stand elsewhere in the stretch, after other notices."""
    from tickline.llm.licenses import TEMPLATES, scan_licenses

    def brute(template, text):
        best = 0.0
        for s in range(len(text)):
            row = [0] * (len(template) + 1)
            for e in range(s, min(len(text), s + int(len(template) / 0.9) + 1)):
                new = [0]
                for j, w in enumerate(template):
                    new.append(row[j] + 1 if w == text[e] else max(row[j + 1], new[j]))
                row = new
                best = max(best, row[-1] / max(len(template), e - s + 1))
        return best

    rng = random.Random(14)
    words = {name: t.lower().replace(",", "").replace("/", " ").replace("(", "").replace(")", "").replace("-", " ").replace(".", " ").split() for name, t in TEMPLATES.items()}
    texts = ["This program is licensed under the GNU General Public License, version 3 " + "y " * 19 + "work of this license"]
    for name in ("GPL-3.0", "MIT-text", "BSD-text", "ISC-text") * 4:
        w = list(words[name])
        gone = [w.pop(rng.randrange(len(w))) for _ in range(rng.randint(1, len(w) // 9))]
        w[len(w) // 2 : len(w) // 2] = ["new"] * rng.randint(0, 1)
        texts.append(" ".join([*words[rng.choice(["MIT", "ISC-text", "BSD-text"])], *["y"] * 9, *w, *["y"] * 30, "license", *gone]))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    got = {(r["doc_id"], r["license"]): r["coverage"] for r in scan_licenses(docs).collect()}
    want = {(i, name): brute(t, x.lower().replace(",", "").split()) for i, x in enumerate(texts) for name, t in words.items()}
    assert got == {k: v for k, v in want.items() if v >= 0.9} and (0, "GPL-3.0") in got


def test_licenses_without_their_key_words(spark):
    from tickline.llm.licenses import TEMPLATES, scan_licenses

    texts = {
        1: (TEMPLATES["BSD-text"].replace("Redistribution", "Reuse").replace("permitted", "allowed"), "BSD-text"),
        2: (TEMPLATES["MIT-text"].replace("Permission", "Right"), "MIT-text"),
        3: (" x" * 5000 + " " + TEMPLATES["ISC-text"].replace("copyright", "c") + " y" * 5000, "ISC-text"),
    }
    docs = spark.createDataFrame([(i, t) for i, (t, _) in texts.items()] + [(4, None), (4, "")], "doc_id bigint, text string")
    assert {(r["doc_id"], r["license"]) for r in scan_licenses(docs).collect()} == {(i, name) for i, (_, name) in texts.items()}
    own = {"own": "alpha beta gamma delta epsilon zeta eta theta iota kappa"}
    found = spark.createDataFrame([(1, "x alpha beta gamma delta other zeta eta theta iota kappa x")], "doc_id bigint, text string")
    assert [r["coverage"] for r in scan_licenses(found, templates=own).collect()] == [0.9]
    assert scan_licenses(docs.limit(0)).count() == 0


def test_archives_of_any_name(spark, tmp_path):
    import gzip

    from tickline.llm.arc import arc_record, convert, read_warc, version_block

    whole = [version_block(1, "x.arc") + b"\n", *(arc_record(1, i, f"http://x/{i}", b"page\n" * 40, "x.arc", 0) + b"\n" for i in (3, 1, 2))]
    (tmp_path / "arc").mkdir()
    (tmp_path / "arc" / "x.arc.gz").write_bytes(b"".join(map(gzip.compress, whole)))
    convert(spark, str(tmp_path / "arc"), str(tmp_path / "warc"))
    got = {r["page_id"]: (r["record_type"], r["refers_to"]) for r in read_warc(spark, str(tmp_path / "warc")).collect()}
    assert got == {1: ("response", None), 2: ("revisit", 1), 3: ("revisit", 1)}


def test_repeated_and_missing_ids(spark):
    from tickline.llm.jaccard_join import jaccard_components
    from tickline.llm.substring_dedup import dedup_substrings
    from tickline.llm.suffix_dedup import dedup_bytes

    rng = random.Random(8)
    text = lambda: " ".join("".join(rng.choices("abcdefgh", k=5)) for _ in range(50))
    a, b, c = text(), text(), text()
    rows = [(1, a), (1, a), (2, b), (2, c), (None, b), (3, c)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    words = sorted((r["doc_id"] or 0, r["n_words"], r["n_removed"]) for r in dedup_substrings(docs).collect())
    assert words == sorted((i or 0, 50, 50) for i, _ in rows)
    got = sorted((r["doc_id"] or 0, r["n_removed"] > 0) for r in dedup_bytes(docs).collect())
    assert got == [(0, True), (1, False), (1, False), (2, False), (2, False), (3, True)]
    linked = sorted((r["doc_id"] or 0, r["component_id"]) for r in jaccard_components(docs).collect())
    assert linked == [(0, 2), (1, 1), (1, 1), (2, 2), (2, 2), (3, 2)]
    empty = docs.limit(0)
    assert dedup_substrings(empty).count() == dedup_bytes(empty).count() == jaccard_components(empty).count() == 0
