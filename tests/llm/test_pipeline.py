from __future__ import annotations

import collections
import os
import random

import pytest

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="needs the test tables")


def test_stages_take_effect(spark, tmp_path):
    import corpus_pipeline as p

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, before = docs.columns, docs.count()
    for name, stage in p.STAGES[:-1]:
        out = str(tmp_path / name.replace(" ", "_"))
        stage(spark, docs, SF).write.parquet(out)
        docs = spark.read.parquet(out)
        assert docs.columns == columns and docs.count() <= before
        before = docs.count()
    mixed = p.STAGES[-1][1](spark, docs, SF)
    assert mixed.count() == before
    assert 0 < before


DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def words(rng, n):
    return ["".join(rng.choices("abcdefgh", k=5)) for _ in range(n)]


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "en", "s", None if t is None else len(t)) for i, t in rows], DOCS).repartition(3)


def rows_of(df):
    return collections.Counter((r["doc_id"], r["text"]) for r in df.collect())


def test_quality_without_and_with_repeated_ids(spark, tmp_path):
    import corpus_pipeline as p

    rng = random.Random(21)
    good = lambda: " ".join(words(rng, 60))
    junk = lambda: "$$ ## !! " * 40 + str(rng.random())
    rows = [(i, good() if i % 2 else junk()) for i in range(400)]
    spark.createDataFrame([(i, i % 2, 0) for i in range(400)], "doc_id bigint, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    rows += [(None, good()), (None, junk()), (500, good()), (500, junk()), (None, junk())]
    got = rows_of(p.quality(spark, frame(spark, rows), str(tmp_path)))
    assert got == collections.Counter(r for r in rows if not r[1].startswith("$$"))


def test_near_duplicates_without_and_with_repeated_ids(spark):
    import corpus_pipeline as p

    rng = random.Random(22)
    a, b, c, d, e = (words(rng, 80) for _ in range(5))
    near = lambda w, k: " ".join([*w[:-1], f"other{k}"])
    rows = [(1, " ".join(a)), (1, " ".join(b)), (2, near(a, 1)), (None, near(a, 2)), (3, " ".join(c)), (3, " ".join(c)), (None, " ".join(d)), (None, " ".join(d)), (None, near(d, 1)), (None, " ".join(e)), (4, ""), (4, ""), (None, None), (None, None)]
    got = rows_of(p.near_duplicates(spark, frame(spark, rows), ""))
    ds = [k for k in got if k[0] is None and k[1] in (" ".join(d), near(d, 1))]
    assert len(ds) == 1 and got.pop(ds[0]) == 1
    assert got == collections.Counter([(1, " ".join(a)), (1, " ".join(b)), (3, " ".join(c)), (None, " ".join(e)), (4, ""), (4, ""), (None, None), (None, None)])


def test_repeated_passages_without_and_with_repeated_ids(spark):
    import corpus_pipeline as p

    rng = random.Random(23)
    passage = words(rng, 40)
    rows = [(i, words(rng, 30) + (passage if shared else []) + words(rng, 30)) for i, shared in ((1, True), (1, False), (1, True), (None, True), (None, False), (2, False))]
    rows += [(5, w := words(rng, 50)), (5, w)]
    count = collections.Counter(tuple(w[j : j + 35]) for _, w in rows for j in range(len(w) - 34))
    want = []
    for i, w in rows:
        gone = {j + k for j in range(len(w) - 34) if count[tuple(w[j : j + 35])] > 1 for k in range(35)}
        want.append((i, " ".join(x for j, x in enumerate(w) if j not in gone)))
    out = p.repeated_passages(spark, frame(spark, [(i, " ".join(w)) for i, w in rows]), "")
    assert rows_of(out) == collections.Counter(want) and all(r["n_chars"] == len(r["text"]) for r in out.collect())


def test_decontamination_without_and_with_repeated_ids(spark, tmp_path):
    import corpus_pipeline as p

    rng = random.Random(24)
    item = words(rng, 30)
    spark.createDataFrame([(0, " ".join(item))], "item_id bigint, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    rows = [(i, " ".join(words(rng, 30) + (item if leak else []) + words(rng, 30))) for i, leak in ((1, True), (1, False), (None, True), (None, False), (2, True), (3, False))]
    rows += [(None, None), (1, "")]
    got = rows_of(p.decontamination(spark, frame(spark, rows), str(tmp_path)))
    assert got == collections.Counter(r for r in rows if " ".join(item) not in (r[1] or ""))


def test_clashing_columns_and_empty_tables(spark, tmp_path):
    import corpus_pipeline as p

    rng = random.Random(25)
    item, passage = words(rng, 30), words(rng, 40)
    spark.createDataFrame([(0, " ".join(item))], "item_id bigint, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    spark.createDataFrame([(1, 1, 0)], "doc_id bigint, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    texts = [words(rng, 50) for _ in range(6)]
    rows = [(i, " ".join(w), "en", "s", 0) for i, w in enumerate(texts)]
    rows += [(7, " ".join(texts[0]), "en", "s", 0), (8, " ".join(texts[0][:20] + passage), "en", "s", 0), (9, " ".join(texts[1][:20] + passage), "en", "s", 0), (10, " ".join(item), "en", "s", 0)]
    names = [p.KEY, "component_id", "copies", "first", "kept", "last", "n", "n_removed", "predicted", "repeated", "row", "score", "turn"]
    docs = spark.createDataFrame([(*r, *(f"{n} {r[0]}" for n in names)) for r in rows], ", ".join([DOCS, *(f"{n} string" for n in names)])).repartition(2)
    ids = {"quality": set(range(11)) - {6}, "near_duplicates": {0, 1, 2, 3, 4, 5, 8, 9, 10}, "repeated_passages": set(range(11)) - {6}, "decontamination": set(range(10)) - {6}}
    for name, expected in ids.items():
        got = getattr(p, name)(spark, docs, str(tmp_path))
        assert got.columns == docs.columns
        found = got.collect()
        assert sorted(r["doc_id"] for r in found) == sorted(expected), name
        assert all(r[n] == f"{n} {r['doc_id']}" for r in found for n in names)
        if name == "repeated_passages":
            kept = {r["doc_id"]: r["text"] for r in found}
            assert kept[8] == " ".join(texts[0][:20]) and kept[0] == "" and kept[2] == " ".join(texts[2])
        empty = getattr(p, name)(spark, docs.where("false"), str(tmp_path))
        assert empty.columns == docs.columns and empty.count() == 0
    assert p.mixing(spark, docs, str(tmp_path)).count() == len(rows)
    assert p.mixing(spark, docs.where("false"), str(tmp_path)).count() == 0


def random_table(seed, items=(), passages=()):
    """Rows with repeated and missing ids, copies, near copies, edited test items, shared passages, short and empty texts."""
    rng = random.Random(seed)
    bases = [words(rng, rng.randint(20, 60)) for _ in range(8)]
    rows = []
    for _ in range(110):
        w = list(rng.choice(bases)) if rng.random() < 0.6 else words(rng, rng.choice([1, 3, 5, 40]))
        for _ in range(rng.choice([0, 0, 1, 2, 4])):
            w[rng.randrange(len(w))] = rng.choice(["CHANGED", "other"])
        if items and rng.random() < 0.4:
            part = list(rng.choice(items))
            if rng.random() < 0.5:
                part = part[: rng.randint(10, 20)]
            else:
                for _ in range(rng.randint(0, 6)):
                    part[rng.randrange(len(part))] = "put"
            w[len(w) // 2 : len(w) // 2] = part
        if passages and rng.random() < 0.4:
            part = rng.choice(passages)
            w += part[rng.randint(0, 8) :]
        text = rng.choice(["", None, " \t\n"]) if rng.random() < 0.06 else " ".join(w)
        rows.append((None if rng.random() < 0.15 else rng.randint(0, 40), text))
    return rows + rng.choices(rows, k=10)


@pytest.mark.parametrize("seed", [31, 32])
def test_near_duplicates_by_brute_force(spark, seed):
    import corpus_pipeline as p

    def shingles(text):
        w = tuple((text or "").lower().split())
        return {w[i : i + 5] for i in range(max(1, len(w) - 4))} if w else set()

    rows = random_table(seed)
    nodes = sorted(set(rows), key=str)
    sets = [shingles(t) for _, t in nodes]
    root = list(range(len(nodes)))
    for _ in nodes:
        for a, x in enumerate(sets):
            for b, y in enumerate(sets):
                if x and 100 * len(x & y) >= 80 * len(x | y):
                    root[a] = root[b] = min(root[a], root[b])
    got = rows_of(p.near_duplicates(spark, frame(spark, rows), ""))
    count = collections.Counter(rows)
    groups = collections.defaultdict(list)
    for k, (node, s) in enumerate(zip(nodes, sets, strict=True)):
        if s:
            groups[root[k]].append(node)
        else:
            assert got.pop(node) == count[node]
    assert any(len(g) > 2 for g in groups.values())
    for members in groups.values():
        kept = [m for m in members if m in got]
        ids = [m[0] for m in members if m[0] is not None]
        assert len(kept) == 1 and got.pop(kept[0]) == 1 and kept[0][0] == min(ids, default=None)
    assert not got


@pytest.mark.parametrize("seed", [33, 34])
def test_repeated_passages_by_brute_force(spark, seed):
    import corpus_pipeline as p

    rng = random.Random(seed)
    rows = random_table(seed, passages=[words(rng, 50) for _ in range(3)])
    split = [(i, t, (t or "").split()) for i, t in rows]
    count = collections.Counter(tuple(w[j : j + 35]) for _, _, w in split for j in range(len(w) - 34))
    want = collections.Counter()
    for i, t, w in split:
        gone = {j + k for j in range(len(w) - 34) if count[tuple(w[j : j + 35])] > 1 for k in range(35)}
        want[i, " ".join(x for j, x in enumerate(w) if j not in gone) if gone else t] += 1
    assert any(t is not None and (i, t) not in set(rows) for i, t in want)
    assert rows_of(p.repeated_passages(spark, frame(spark, rows), "")) == want


@pytest.mark.parametrize("seed", [35, 36])
def test_decontamination_by_brute_force(spark, tmp_path, seed):
    """Against Smith-Waterman of every document with every item; edits leave two seeds near each other."""
    import corpus_pipeline as p

    def align(a, b):
        best, above = 0, [0] * (len(b) + 1)
        for x in a:
            row = [0]
            for j, y in enumerate(b, 1):
                row.append(max(0, above[j - 1] + (2 if x == y else -1), above[j] - 1, row[j - 1] - 1))
            best, above = max(best, *row), row
        return best

    rng = random.Random(seed)
    items = [words(rng, 30) for _ in range(4)]
    spark.createDataFrame([(i, " ".join(w)) for i, w in enumerate(items)], "item_id bigint, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    rows = random_table(seed, items=items)
    clean = [r for r in rows if not any(align((r[1] or "").lower().split(), w) >= len(w) for w in items)]
    assert 0 < len(clean) < len(rows)
    assert rows_of(p.decontamination(spark, frame(spark, rows), str(tmp_path))) == collections.Counter(clean)


def test_mixing_by_brute_force(spark):
    import corpus_pipeline as p

    rng = random.Random(37)
    rows = [(i, t, rng.choice(["a", "b", "b", "b", "é", "c", None])) for i, t in random_table(37)]
    docs = spark.createDataFrame([(i, t, "en", s, 0) for i, t, s in rows], DOCS).repartition(3)
    size = collections.Counter()
    for _, t, s in rows:
        size[s] += len((t or "").split())
    sources = sorted(size, key=lambda s: (s is None, s or ""))
    weight = {s: 1 + k % 3 for k, s in enumerate(sources)}
    target, free = {}, set(sources)
    while free:
        left = sum(size.values()) - sum(target.values())
        share = {s: left * weight[s] / sum(weight[o] for o in free) for s in free}
        over = {s for s in free if share[s] > 3 * size[s]}
        target |= {s: 3.0 * size[s] for s in over} if over else share
        free -= over or free
    got = p.mixing(spark, docs, "").collect()
    assert collections.Counter((r["doc_id"], r["size"], r["source"], r["source_size"]) for r in got) == collections.Counter((i, len((t or "").split()), s, size[s]) for i, t, s in rows)
    taken = collections.Counter()
    for r in got:
        taken[r["source"]] += r["taken"]
        assert 0 <= r["taken"] <= 3 * r["size"] and r["target"] == pytest.approx(target[r["source"]])
    assert all(abs(taken[s] - target[s]) <= max(r["size"] for r in got) for s in sources)
