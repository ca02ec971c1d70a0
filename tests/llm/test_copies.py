"""Near copies, leaks and license statements."""

from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from bikenet.llm import cgk, components, jaccard_join, licenses
from bikenet.llm.decontamination import (
    ItemIndex, distances_from, edits_allowed, find_leaks, without_leaks,
)
from bikenet.llm.rtree import CountTree


def _sets(rows):
    out = []
    for _, text in rows:
        lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        words = re.findall(r"[^\x20\x09-\x0D]+", lowered)
        out.append({tuple(words[k : k + 5]) for k in range(len(words) - 4)} if len(words) >= 5
                   else ({tuple(words)} if words else set()))
    return out


def _expected(rows):
    sets, parent, holders = _sets(rows), list(range(len(rows))), defaultdict(list)

    def top(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for i, own in enumerate(sets):
        shared = Counter(j for s in own for j in holders[s])
        for s in own:
            holders[s].append(i)
        for j, n in shared.items():
            if 100 * n >= 80 * (len(own) + len(sets[j]) - n):
                parent[top(i)] = top(j)
    least = {}
    for i, (doc, _) in enumerate(rows):
        if doc is not None:
            least[top(i)] = min(least.get(top(i), doc), doc)
    return Counter(
        (doc, len(sets[i]), least.get(top(i)) if sets[i] else doc) for i, (doc, _) in enumerate(rows))


def _components(frame):
    return Counter((r["doc_id"], r["n_shingles"], r["component_id"]) for r in jaccard_join.similar_texts(frame).collect())


def test_components_of_documents(small):
    rows = [(r["doc_id"], r["text"]) for r in small("documents").collect()]
    assert _components(small("documents")) == _expected(rows)


def test_components_of_edges(docs, edge_rows):
    rows = [*edge_rows, (9, "A  b c"), (10, "a b\nC"), (11, "É b"), (12, "é b")]
    assert _components(docs(*rows)) == _expected(rows)
    assert _components(docs()) == Counter()
    assert _components(docs((1, None), (2, " "))) == Counter({(1, 0, 1): 1, (2, 0, 2): 1})


def test_hot_groups_and_long_texts(docs, monkeypatch):
    """Near copies about the threshold, a passage in all texts, and tiles cut into small segments."""
    monkeypatch.setattr(jaccard_join, "SEGMENT_ROWS", 16)
    monkeypatch.setattr(jaccard_join, "SAMPLE_ONE_IN", 4)
    draw = random.Random(3)
    voc = [f"w{i}" for i in range(3000)]
    passage = draw.choices(voc, k=60)
    rows = []
    for base_size in (12, 80, 300, 1800):
        base = draw.choices(voc, k=base_size)
        for _ in range(40):
            own = list(base)
            for _ in range(draw.randint(0, max(1, base_size // 20))):
                own[draw.randrange(len(own))] = draw.choice(voc)
            rows.append((len(rows), " ".join(own)))
    for _ in range(80):
        rows.append((len(rows), " ".join(passage + draw.choices(voc, k=draw.randint(5, 40)))))
    draw.shuffle(rows)
    assert _components(docs(*rows)) == _expected(rows)


@pytest.mark.parametrize("original", [True, False])
def test_candidates_are_as_many_as_the_members(docs, monkeypatch, original):
    """Near copies of one text, 0.75 alike among themselves: neither links nor open pairs grow with the square."""
    made = {}
    for name in ("_links", "_across_homes", "_possible"):
        def counted(members, build=getattr(jaccard_join, name), name=name):
            frame = build(members)
            made[name] = made.get(name, 0) + frame.count()
            return frame
        monkeypatch.setattr(jaccard_join, name, counted)
    draw = random.Random(9)
    base = [f"w{draw.randrange(10_000)}" for _ in range(300)]
    counts = []
    for size in (30, 150):
        made.clear()
        rows = [(0, " ".join(base))] if original else []
        for i in range(1, size):
            own = list(base)
            for at in draw.sample(range(300), 9):
                own[at] = f"x{draw.randrange(10_000)}"
            rows.append((i, " ".join(own)))
        assert _components(docs(*rows)) == _expected(rows)
        counts.append(dict(made))
        assert made["_links"] < size and made["_across_homes"] <= 2 * size and made["_possible"] <= size


def test_rows_without_an_id_are_no_product(docs):
    draw = random.Random(2)
    base = [f"w{i}" for i in range(60)]
    rows = []
    for i in range(300):
        own = list(base)
        own[draw.randrange(60)] = f"x{i % 40}"
        rows.append((None, " ".join(own)))
    rows += [(7, " ".join(base)), (5, " ".join([*base, "y"])), (None, " ".join(base))]
    assert _components(docs(*rows)) == _expected(rows)


def test_tree_loses_no_pair():
    draw = np.random.default_rng(4)
    points = draw.poisson(2, (500, 16)) + draw.poisson(2, (500, 1)) * draw.integers(0, 3, (500, 1))
    sizes = points.sum(axis=1)
    tree = CountTree(points, sizes)
    for i in range(0, 500, 7):
        most = np.minimum(points, points[i]).sum(axis=1)
        able = most * 180 >= 80 * (sizes + sizes[i])
        assert set(np.flatnonzero(able)) == set(tree.search(points[i], sizes[i], 80, 100).tolist())


def test_components_of_links(spark):
    chain = [(i, i + 1) for i in range(40)] + [(100, 101), (103, 101), (200, 200)]
    links = spark.createDataFrame(chain, "a bigint, b bigint")
    labels = {r["node"]: r["label"] for r in components.components(links).collect()}
    assert labels == {**dict.fromkeys(range(41), 0), 100: 100, 101: 100, 103: 100}
    assert components.components(links.limit(0)).count() == 0


def _edited(words, edits, voc, draw):
    words = list(words)
    for _ in range(edits):
        at, kind = draw.randrange(len(words)), draw.random()
        if kind < 0.4:
            words[at] = draw.choice(voc)
        elif kind < 0.7:
            del words[at]
        else:
            words.insert(at, draw.choice(voc))
    return words


def test_recall_at_the_full_distance(small):
    draw = random.Random(0)
    voc = [w for r in small("documents").collect() for w in re.findall(r"\w+", r["text"].lower())]
    items = [r["text"].lower() for r in small("benchmark").collect()]
    index = ItemIndex(items)
    texts, wanted = [], []
    for i, item in enumerate(items * 5):
        words = re.findall(r"\w+", item)
        own = _edited(words, edits_allowed(len(words)), voc, draw)
        texts.append(" ".join([*draw.choices(voc, k=30), *own, *draw.choices(voc, k=30)]))
        wanted.append(i % len(items))
    hits = index.match(pa.array(texts))
    found = sum((row, item) in hits for row, item in enumerate(wanted))
    assert found >= 0.97 * len(wanted)
    assert all(d <= edits_allowed(len(index.words[item])) for (_, item), (d, _) in hits.items())


@pytest.mark.parametrize("size", [5, 15, 30, 31, 60, 120, 250, 500, 1000])
def test_recall_by_size_at_the_full_distance(size):
    draw = random.Random(size)
    voc = [f"w{i}" for i in range(3000)]
    items = [draw.choices(voc, k=size) for _ in range(60)]
    index = ItemIndex([" ".join(item) for item in items])
    texts = [
        " ".join([*draw.choices(voc, k=30), *_edited(item, edits_allowed(size), voc, draw), *draw.choices(voc, k=30)])
        for item in items]
    keyed = set()
    hits = index.match(pa.array(texts), keyed)
    assert all((i, i) in hits for i in range(len(items)))  # keys and pairs together lose nothing
    assert keyed <= set(hits) and len(keyed) >= 0.9 * len(items)
    assert all(row == item and d <= edits_allowed(size) for (row, item), (d, _) in hits.items())


def test_items_equal_brute_force():
    draw = random.Random(2)
    voc = [f"w{i}" for i in range(40)]
    items = [draw.choices(voc, k=n) for n in (5, 9, 9, 16)]
    texts = []
    for _ in range(60):
        item = draw.choice(items)
        words = [*draw.choices(voc, k=draw.randrange(9)), *_edited(item, draw.randrange(5), voc, draw), *draw.choices(voc, k=9)]
        texts.append(words + words[:7] * draw.randrange(2))
    hits = ItemIndex([" ".join(i) for i in items]).match(pa.array([" ".join(t) for t in texts]))
    expected = {}
    for r, text in enumerate(texts):
        for k, item in enumerate(items):
            best = min((_best_beginning(item, text[s:]), s) for s in range(len(text)))
            if best[0] <= edits_allowed(len(item)):
                expected[r, k] = best
    assert expected and hits == expected


def _best_beginning(item, text):
    row = list(range(len(text) + 1))
    for x in item:
        now = [row[0] + 1]
        for j, y in enumerate(text):
            now.append(min(row[j] + (x != y), row[j + 1] + 1, now[j] + 1))
        row = now
    return min(row)


def test_distance_is_that_of_the_best_beginning():
    draw = np.random.default_rng(6)
    for _ in range(200):
        item, text = draw.integers(1, 4, 6), draw.integers(1, 4, 9)
        got = distances_from(item.tolist(), text.tolist())
        assert got == [_best_beginning(item.tolist(), text[k:].tolist()) for k in range(len(text))]


def test_keys_of_equal_windows_are_equal():
    window = np.arange(1, 31, dtype=np.uint64)[None]
    longer = np.concatenate((window, window), axis=1)
    assert (cgk.keys(window, 30) == cgk.keys(longer, 30)).all()


def test_leaks_of_documents(small):
    items = {r["item_id"]: r["text"] for r in small("benchmark").collect()}
    texts = {r["doc_id"]: r["text"] for r in small("documents").collect()}
    exact = {(d, i) for d, t in texts.items() for i, x in items.items() if x in t}
    rows = find_leaks(small("documents"), small("benchmark")).collect()
    assert exact and exact <= {(r["doc_id"], r["item_id"]) for r in rows}
    assert all(r["distance"] <= edits_allowed(r["item_words"]) for r in rows)
    kept = {r["doc_id"] for r in without_leaks(small("documents"), small("benchmark")).collect()}
    assert kept == set(texts) - {r["doc_id"] for r in rows}


def test_edges_of_leaks(spark, docs, edge_rows):
    schema = "item_id bigint, text string, lowered int"
    items = spark.createDataFrame(
        [(1, "The same row is here two times", 0), (2, "the same row is here two times", 0), (3, None, 0), (4, "", 0),
         (5, "a b", 0), (None, "text without an id, told in", 0)], schema)
    found = Counter((r["doc_id"], r["item_id"], r["distance"]) for r in find_leaks(docs(*edge_rows), items).collect())
    assert found == Counter({(6, 1, 0): 2, (6, 2, 0): 2, (None, None, 0): 1})
    kept = without_leaks(docs(*edge_rows), items)
    assert kept.columns == docs().columns
    assert Counter(r["doc_id"] for r in kept.collect()) == Counter([1, 2, 3, 5, 7, 8, None])
    assert find_leaks(docs(*edge_rows), items.limit(0)).count() == find_leaks(docs(), items).count() == 0


def test_short_items_and_scripts_without_blanks(spark, docs):
    thai, han = "ภาษาไทยไม่เว้นวรรค", "春眠不觉晓处处闻啼鸟夜来风雨声"
    items = spark.createDataFrame(
        [(1, "Yes."), (2, "no, thanks"), (3, han), (4, thai), (5, "one two three four"), (6, "?!")], "item_id bigint, text string")
    changed = han.replace("啼", "黄")
    rows = docs((1, "yes!"), (2, "yes and no thanks"), (3, "NO thanks"), (4, f"前言{changed}，后记"), (5, f"a {thai} b"),
                (6, "One, two; three (four)"), (7, "four three two one"), (8, "无关的文字在这里没有别的"), (9, "?!"), (10, None))
    found = {(r["doc_id"], r["item_id"]): (r["distance"], r["first_word"]) for r in find_leaks(rows, items).collect()}
    assert found == {(1, 1): (0, 0), (3, 2): (0, 0), (4, 3): (1, 2), (5, 4): (0, 1), (6, 5): (0, 0)}
    kept = without_leaks(rows, items).collect()
    assert sorted(r["doc_id"] for r in kept) == [2, 7, 8, 9, 10] and {r["text"] for r in kept} >= {"无关的文字在这里没有别的", None}


def test_items_in_several_blocks(small, monkeypatch):
    whole = {tuple(r) for r in find_leaks(small("documents"), small("benchmark")).collect()}
    monkeypatch.setattr("bikenet.llm.decontamination.BLOCK_BYTES", 2000)
    assert {tuple(r) for r in find_leaks(small("documents"), small("benchmark")).collect()} == whole


@pytest.mark.parametrize("name", list(licenses.TEMPLATES))
def test_license_with_noise(docs, name):
    statement = licenses.TEMPLATES[name]
    text = f"One two the under.\n{statement}.\nthree license four. And again: {statement.upper()}, five"
    rows = licenses.scan_licenses(docs((1, text), (2, "the under license of this work"))).collect()
    assert [(r["doc_id"], r["license"], r["coverage"]) for r in rows] == [(1, name, 1.0)] * 2


def test_licenses_of_documents_and_edges(small, docs, edge_rows):
    expected = Counter()
    for r in small("documents").collect():
        for name, statement in licenses.TEMPLATES.items():
            expected[r["doc_id"], name] += len(re.findall(re.escape(statement) + r"\.", r["text"]))
    found = Counter((r["doc_id"], r["license"]) for r in licenses.scan_licenses(small("documents")).collect())
    assert found == +expected
    assert licenses.scan_licenses(docs(*edge_rows)).count() == licenses.scan_licenses(docs()).count() == 0


def test_alignment_is_increasing_and_whole():
    draw = random.Random(8)
    for _ in range(300):
        a = [draw.randrange(6) for _ in range(draw.randint(0, 9))]
        b = [draw.randrange(6) for _ in range(draw.randint(0, 12))]
        pairs = licenses.align(a, b)
        assert all(a[i] == b[j] for i, j in pairs)
        assert all(p[0] < q[0] and p[1] < q[1] for p, q in zip(pairs, pairs[1:]))
        assert licenses.align(a, a) == [(i, i) for i in range(len(a))]


def test_longest_common_subsequence():
    draw = random.Random(5)
    for _ in range(300):
        a = [draw.randrange(4) for _ in range(draw.randint(0, 9))]
        b = [draw.randrange(4) for _ in range(draw.randint(0, 12))]
        best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, j in ((i, j) for i in range(len(a)) for j in range(len(b))):
            best[i + 1][j + 1] = best[i][j] + 1 if a[i] == b[j] else max(best[i][j + 1], best[i + 1][j])
        pairs = licenses._common(a, b)
        assert len(pairs) == best[-1][-1] and all(a[i] == b[j] for i, j in pairs)
        assert all(p[0] < q[0] and p[1] < q[1] for p, q in zip(pairs, pairs[1:]))


def test_neighbouring_statements_keep_their_own_words(docs):
    names = [n for n in licenses.TEMPLATES if n != "CC0-1.0"]
    pairs = [(a, b) for a in names for b in names]
    rows = docs(*[(i, f"{licenses.TEMPLATES[a]}. {licenses.TEMPLATES[b]}.") for i, (a, b) in enumerate(pairs)])
    found = defaultdict(list)
    for r in sorted(licenses.scan_licenses(rows).collect(), key=lambda r: r["first_word"]):
        assert r["coverage"] == 1.0
        found[r["doc_id"]].append(r["license"])
    assert [(pairs[i], found[i]) for i in range(len(pairs)) if found[i] != list(pairs[i])] == []


def test_a_cut_statement_behind_a_whole_one(docs):
    whole, cut = licenses.TEMPLATES["GPL-3.0"], licenses.TEMPLATES["GPL-2.0"].removeprefix("This ")
    rows = licenses.scan_licenses(docs((1, f"{whole}. {cut}"))).collect()
    assert sorted((r["first_word"], r["license"], r["last_word"]) for r in rows) == [(0, "GPL-3.0", 11), (12, "GPL-2.0", 22)]


def test_notices_and_whole_texts(docs):
    listed = licenses.known()[len(licenses.TEMPLATES):]
    assert {"MIT", "BSD-3-Clause", "Apache-2.0", "GPL-3.0", "LGPL-2.1", "MPL-2.0", "ISC", "EPL-2.0"} <= {n for n, _ in listed}
    texts = [(i, f"Copyright (c) 2020 Some One. All rights reserved.\n\n{words}\n\ndef main(): pass") for i, (_, words) in enumerate(listed)]
    found = defaultdict(list)
    for r in licenses.scan_licenses(docs(*texts)).collect():
        found[r["doc_id"]].append((r["license"], r["coverage"]))
    assert {i: found[i] for i in range(len(listed)) if found[i] != [(listed[i][0], 1.0)]} == {}


def test_an_edited_body_in_long_prose(docs):
    draw = random.Random(1)
    body = dict(licenses.known())["GPL-3.0"].split()
    prose = draw.choices(body, k=9000)
    kept = [w for w in body if draw.random() > 0.05]
    rows = licenses.scan_licenses(docs((1, " ".join([*prose, *kept, *prose])), (2, " ".join(prose)))).collect()
    assert [(r["doc_id"], r["license"]) for r in rows if r["coverage"] > 0.9] == [(1, "GPL-3.0")]


def test_regions_lose_no_occurrence():
    draw = random.Random(3)
    template = " ".join(draw.choices("abcdefgh", k=12))
    own = licenses.Templates([("x", template)], 0.8)
    for _ in range(50):
        before = draw.choices("abpqrstuv", k=draw.randrange(120))
        text = [*before, *_edited(template.split(), 2, ["z"], draw), *draw.choices("cdpqrstuv", k=draw.randrange(120))]
        if len(licenses.align(template.split(), text[len(before):])) >= 0.8 * 12:
            assert list(own.find(pa.array([" ".join(text)])))
