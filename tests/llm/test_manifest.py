"""Merkle manifest against a plain recursive version."""

from __future__ import annotations

import hashlib
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from bikenet.llm.merkle import ARITY, build_levels, manifest, ranked, without_line_ends

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, grp string, digest string, lo bigint"


def _h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def _leaf(row, text):
    values = [row[0], row[3], row[2], row[4], text]
    return _h(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def _climb(nodes):
    """The root over nodes, and for each node its siblings as (left, right) from below."""
    paths = [[] for _ in nodes]
    spans = [[i] for i in range(len(nodes))]
    while len(nodes) > 1:
        above, wider = [], []
        for a in range(0, len(nodes), ARITY):
            run = nodes[a : a + ARITY]
            for k in range(len(run)):
                for leaf in spans[a + k]:
                    paths[leaf].append(("".join(run[:k]), "".join(run[k + 1 :])))
            above.append(_h(*run))
            wider.append([leaf for span in spans[a : a + ARITY] for leaf in span])
        nodes, spans = above, wider
    return nodes[0], paths


def _plain(rows):
    groups = defaultdict(list)
    for row in rows:
        groups[row[3]].append((row[0] is not None, row[0] or 0, _leaf(row, row[1]), row))
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {}
    for name in names:
        groups[name].sort(key=lambda x: x[:3])
        trees[name] = _climb([x[2] for x in groups[name]])
    root, outer = _climb([trees[name][0] for name in names])
    out = []
    for name, above in zip(names, outer):
        subroot, paths = trees[name]
        for (_, _, leaf, row), path in zip(groups[name], paths):
            node, text = leaf, row[1]
            if row[0] is not None and text is not None and zlib.crc32(str(row[0]).encode()) % 2 == 0:
                node = _leaf(row, text.replace("\n", ""))
            steps = path + above
            for left, right in steps:
                node = _h(left, node, right)
            out.append((row[0], leaf, subroot, root, _h(*(p for s in steps for p in s)), node, node == root))
    return sorted(out, key=str)


def _rows(spark, rows):
    frame = spark.createDataFrame([(*r, "x", "y", 7) for r in rows], SCHEMA).repartition(3)
    tampered = F.crc32(F.col("doc_id").cast("string")) % 2 == 0
    return sorted((tuple(r) for r in manifest(frame, without_line_ends(tampered)).collect()), key=str)


def _many():
    rows = [(i, f"text {i}\nnext ü {i % 7}", "en", "src0", 12) for i in range(100)]  # one source of 100: 5 levels
    rows += [(i, None if i % 5 == 0 else f"a{i}\n", None, f"ß{i % 4}", None) for i in range(100, 131)]
    rows += [(900, "", "en", None, 0), (901, "only\none", "en", "~", 3), (902, "x" * 200_000 + "\n", "en", "src9", 1)]
    rows += [(None, "no\nid", "de", "src0", 1), (None, "no\nid", "de", "src0", 1), (7, "again\n", "en", "src0", 2)]
    return rows + [(903, "twice\n", "en", "src1", 6)] * 2


def test_equals_the_plain_version(spark):
    rows = _many()
    assert _rows(spark, rows) == _plain(rows)


@pytest.mark.parametrize("size", [1, 2, 3, 4, 9, 10, 27, 28])
def test_every_size_of_one_group(spark, size):
    rows = [(i, f"t{i}\n", "en", "s", 3) for i in range(size)]
    assert _rows(spark, rows) == _plain(rows)


def test_single_leaf_is_the_root(spark):
    row = _rows(spark, [(1, "a", "en", "s", 1)])[0]
    assert row[1] == row[2] == row[3] == row[5] and row[4] == _h("") and row[6] is True


def test_no_rows(spark):
    assert _rows(spark, []) == []


def test_only_changed_texts_fail(spark):
    rows = [(i, "a\nb" if i % 3 else "ab", "en", f"s{i % 2}", 3) for i in range(40)]
    for row in _rows(spark, rows):
        changed = zlib.crc32(str(row[0]).encode()) % 2 == 0 and row[0] % 3 != 0
        assert row[6] is not changed


def test_levels_cover_all_ranks(spark):
    frame = spark.range(100).select(F.lit("g").alias("grp"), "id", F.sha2(F.col("id").cast("string"), 256).alias("digest"))
    levels = build_levels(ranked(frame, ["id"]))
    assert [level.count() for level in levels] == [100, 34, 12, 4, 2, 1]
    for k, level in enumerate(levels):
        marks = sorted((r.lo, r.hi) for r in level.collect())
        assert marks[0][0] == 0 and marks[-1][1] == 100
        assert all(a[1] == b[0] for a, b in zip(marks, marks[1:]))
        assert all(lo % ARITY ** k == 0 for lo, _ in marks)
