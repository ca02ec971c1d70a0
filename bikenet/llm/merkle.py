"""Merkle manifest of a data set by nested-interval labels.

Every node carries the interval of leaf ranks that it covers. A node's parent on the next level is the
one whose interval contains its own; both lie in the same bucket of that level's width, so ancestors are
attached by an equi-join on the bucket and a containment test, level by level from the root down. What
remains of a parent's interval without the child's own are the child's siblings, and a leaf's proof is
the list of siblings on its way to the root.

A group (``source``) is a tree of its own; the groups' roots are the leaves of one more tree.

Leaves are ranked by a distributed sort, so a group that holds a third of all rows is many buckets like
any other. Texts are hashed where they are read and do not move. Each level is a written table.

Defined cases: a null field is ``-``. Rows without an id come first in their group; rows that repeat an id
follow one another by leaf digest, each with its own proof. Documents without a group form the first group.
Of an empty table nothing comes back. A single leaf is its own root, and its proof is the digest of nothing.
Other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bikenet.llm.store import written

#: Nodes of a run that become one node.
ARITY = 3

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")

_STEP = "struct<left: string, right: string>"


def digest(value: Column) -> Column:
    return F.sha2(value.cast("binary"), 256)


def field(value: Column) -> Column:
    """Byte count and value, so that neighbouring fields cannot be taken for others."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_digest(fields: dict[str, Column]) -> Column:
    """Digest of a row's fields in the order given."""
    return digest(F.concat(*[field(value) for value in fields.values()]))


def ranked(frame: DataFrame, order: list[str]) -> DataFrame:
    """Add ``lo``, the rank from 0 within ``grp`` by ``order``, ``hi = lo + 1`` and ``size``, the rows of ``grp``.

    A range sort deals the rows out; the rows of each group in each partition are counted, and a rank is the
    count in earlier partitions and the place in the own one. There are at most as many counts as partitions
    and groups together.
    """
    placed = written(
        frame.repartitionByRange("grp", *order).sortWithinPartitions("grp", *order)
        .withColumn("place", F.monotonically_increasing_id()).withColumn("part", F.expr("place div 8589934592")),
        "merkle-ranked",
    )
    runs = placed.groupBy("grp", "part").agg(F.min("place").alias("first"), F.count("*").alias("held"))
    own = Window.partitionBy("grp")
    runs = runs.select(
        "grp", "part",
        (F.coalesce(F.sum("held").over(own.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
         - F.col("first")).alias("shift"),
        F.sum("held").over(own).alias("size"),
    )
    lo = F.col("place") + F.col("shift")
    return placed.join(runs, ["grp", "part"]).select(
        *frame.columns, lo.alias("lo"), (lo + 1).alias("hi"), "size")


def build_levels(leaves: DataFrame) -> list[DataFrame]:
    """Nodes of every level, ``(grp, size, lo, hi, digest, children)``; the first level is ``leaves``.

    Level ``k`` has the nodes that cover ``ARITY ** k`` ranks, of the groups that are not yet one node below it.
    ``children`` are the intervals and digests of a node's parts.
    """
    levels, width = [leaves], 1
    largest = leaves.agg(F.max("size")).first()[0] or 0
    while width < largest:
        part = F.struct("lo", "hi", "digest")
        above = (
            levels[-1].filter(F.col("size") > width)
            .groupBy("grp", "size", F.expr(f"lo div {width * ARITY}").alias("bucket"))
            .agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"), F.sort_array(F.collect_list(part)).alias("children"))
            .select("grp", "size", "lo", "hi",
                    digest(F.array_join(F.col("children.digest"), "")).alias("digest"), "children")
        )
        levels.append(written(above, "merkle-level"))
        width *= ARITY
    return levels


def roots(levels: list[DataFrame]) -> DataFrame:
    """``(grp, digest)`` of the node that covers its whole group."""
    found = None
    for level in levels:
        top = level.filter("lo = 0 AND hi = size").select("grp", "digest")
        found = top if found is None else found.union(top)
    return found


def attach_paths(levels: list[DataFrame], above: DataFrame) -> DataFrame:
    """The leaves with ``path``: what stands left and right of each ancestor, from the leaf up.

    ``above (grp, subroot, path)`` continues the way from the root of each group.
    """
    def shown(level: DataFrame) -> list[str]:
        return [c for c in level.columns if c != "path"]

    paths = None
    for k in range(len(levels) - 1, -1, -1):
        level, width = levels[k], ARITY ** k
        top = level.filter("lo = 0 AND hi = size").join(above, "grp").select(*shown(level), "subroot", "path")
        if paths is not None:
            bucket = f"div {width * ARITY}"
            outer = paths.select(
                F.col("grp").alias("outer_grp"), F.col("lo").alias("outer_lo"), F.col("hi").alias("outer_hi"),
                F.expr(f"lo {bucket}").alias("bucket"), "children", "subroot", "path",
            )
            inner = level.filter(F.col("size") > width).withColumnRenamed("children", "parts")
            within = inner.join(outer, (
                (F.col("grp") == F.col("outer_grp")) & (F.expr(f"lo {bucket}") == F.col("bucket"))
                & (F.col("outer_lo") <= F.col("lo")) & (F.col("hi") <= F.col("outer_hi"))))
            step = F.expr(
                "named_struct('left', array_join(transform(filter(children, c -> c.hi <= lo), c -> c.digest), ''),"
                " 'right', array_join(transform(filter(children, c -> c.lo >= hi), c -> c.digest), ''))").cast(_STEP)
            kept = [F.col("parts").alias("children") if c == "children" else F.col(c) for c in shown(level)]
            top = top.unionByName(within.select(*kept, "subroot", F.concat(F.array(step), "path").alias("path")))
        paths = written(top, "merkle-paths") if k else top
    return paths


def proof_digest(path: Column) -> Column:
    """Digest of all siblings on the way, level by level, left to right."""
    return digest(F.array_join(F.transform(path, lambda step: F.concat(step["left"], step["right"])), ""))


def fold(leaf: Column, path: Column) -> Column:
    """The root that a leaf and its siblings lead to."""
    return F.aggregate(path, leaf, lambda node, step: digest(F.concat(step["left"], node, step["right"])))


def manifest(docs: DataFrame, presented_text: Column | None = None, fields: tuple[str, ...] = FIELDS,
             id_column: str = "doc_id", group: str = "source", text: str = "text") -> DataFrame:
    """The proof of every row against the root of the whole table.

    ``presented_text`` is what a holder of the row shows as its text (the text itself if not given); its
    leaf is folded along the original siblings. Returns ``(id, leaf, subroot, root, proof_sha256, folded_root,
    verified)``.
    """
    shown = F.col(text) if presented_text is None else presented_text
    values = {name: F.col(name) for name in fields}
    hashed = written(docs.select(
        F.col(id_column).alias("id"),
        # null first, then by bytes
        F.coalesce(F.concat(F.lit("="), F.col(group).cast("string")), F.lit("")).alias("grp"),
        leaf_digest(values).alias("digest"), leaf_digest({**values, text: shown}).alias("presented"),
    ), "merkle-leaves")
    levels = build_levels(written(ranked(hashed, ["id", "digest"]), "merkle-level"))
    groups = roots(levels)
    over = build_levels(written(
        ranked(groups.select(F.lit("").alias("grp"), "digest", F.col("grp").alias("name")), ["name"]), "merkle-level"))
    # the tree over the groups has one root; a table without rows has none
    root = roots(over).select("digest").first()
    start = docs.sparkSession.createDataFrame(
        [("", root[0] if root else "", [])], f"grp string, subroot string, path array<{_STEP}>")
    outer = attach_paths(over, start).select(F.col("name").alias("grp"), F.col("digest").alias("subroot"), "path")
    leaves = attach_paths(levels, written(outer, "merkle-groups"))
    folded = leaves.select(
        F.col("id").alias(id_column), F.col("digest").alias("leaf"), "subroot",
        F.lit(root[0] if root else "").alias("root"), proof_digest(F.col("path")).alias("proof_sha256"),
        fold(F.col("presented"), F.col("path")).alias("folded_root"),
    )
    return folded.withColumn("verified", F.col("folded_root") == F.col("root"))


def without_line_ends(every_other: Column, text: str = "text") -> Column:
    """The text without its line feeds in the rows chosen (where the choice is null, as it is)."""
    return F.when(F.coalesce(every_other, F.lit(False)), F.replace(F.col(text), F.lit("\n"), F.lit(""))).otherwise(F.col(text))


def manifest_sql(levels: int = 20) -> str:
    """The same for DuckDB over ``documents``, bottom-up: each level's siblings by a self-join, up to 3 ** levels rows."""
    def tree(name: str, first: str) -> str:
        parts = [f"{name}0 AS MATERIALIZED ({first})"]
        for k in range(levels):
            width = ARITY ** k
            parts.append(
                f"{name}{k + 1} AS MATERIALIZED (SELECT grp, size, min(lo) AS lo, max(hi) AS hi, "
                f"sha256(string_agg(digest, '' ORDER BY lo)) AS digest FROM {name}{k} WHERE size > {width} "
                f"GROUP BY grp, size, lo // {width * ARITY})")
        steps = " UNION ALL ".join(
            f"SELECT c.grp, {ARITY ** k}::BIGINT AS width, c.lo, "
            "coalesce(string_agg(o.digest, '' ORDER BY o.lo) FILTER (o.lo < c.lo), '') || '|' || "
            "coalesce(string_agg(o.digest, '' ORDER BY o.lo) FILTER (o.lo > c.lo), '') AS step "
            f"FROM {name}{k} c JOIN {name}{k} o ON c.grp = o.grp AND c.lo // {ARITY ** (k + 1)} = o.lo // {ARITY ** (k + 1)} "
            f"WHERE c.size > {ARITY ** k} GROUP BY c.grp, c.lo" for k in range(levels))
        parts.append(f"{name}_steps AS MATERIALIZED ({steps})")
        ends = " UNION ALL ".join(
            f"SELECT grp, digest FROM {name}{k} WHERE lo = 0 AND hi = size" for k in range(levels + 1))
        parts.append(f"{name}_roots AS MATERIALIZED ({ends})")
        return ",\n".join(parts)

    def piece(value: str) -> str:
        return f"coalesce(strlen({value}) || ':' || {value}, '-')"

    def leaf(text: str) -> str:
        values = ["CAST(doc_id AS VARCHAR)", "source", "lang", "CAST(n_chars AS VARCHAR)", text]
        return "sha256(" + " || ".join(piece(v) for v in values) + ")"

    # crc32 of the digits, bit by bit: a number from 0 on is xored in, -1 shifts
    crc = ("xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, flatten(list_transform("
           "string_split(CAST(doc_id AS VARCHAR), ''), "
           "lambda d: [ascii(d)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]))), "
           "lambda c, b: CASE WHEN b >= 0 THEN xor(c, b) ELSE xor(c >> 1, 3988292384 * (c & 1)) END))")
    first = ("SELECT doc_id, grp, digest, presented, rn - 1 AS lo, rn AS hi, size FROM (SELECT *, "
             "row_number() OVER (PARTITION BY grp ORDER BY doc_id NULLS FIRST, digest) AS rn, "
             "count(*) OVER (PARTITION BY grp) AS size FROM leaves)")
    over = ("SELECT '' AS grp, name, digest, rn - 1 AS lo, rn AS hi, size FROM (SELECT grp AS name, digest, "
            "row_number() OVER (ORDER BY encode(grp)) AS rn, count(*) OVER () AS size FROM a_roots)")
    return f"""
WITH leaves AS MATERIALIZED (
  SELECT doc_id, coalesce('=' || source, '') AS grp, {leaf('text')} AS digest,
         CASE WHEN coalesce({crc} % 2 = 0, false) THEN {leaf("replace(text, chr(10), '')")}
              ELSE {leaf('text')} END AS presented
  FROM documents),
{tree('a', first)},
{tree('b', over)},
outer_paths AS MATERIALIZED (
  SELECT b.name AS grp, b.digest AS subroot, coalesce(list(s.step ORDER BY s.width) FILTER (s.step IS NOT NULL), []) AS steps
  FROM b0 b LEFT JOIN b_steps s ON s.grp = b.grp AND b.lo // s.width * s.width = s.lo GROUP BY ALL),
inner_paths AS MATERIALIZED (
  SELECT a.doc_id, a.grp, a.lo, a.digest, a.presented,
         coalesce(list(s.step ORDER BY s.width) FILTER (s.step IS NOT NULL), []) AS steps
  FROM a0 a LEFT JOIN a_steps s ON s.grp = a.grp AND a.lo // s.width * s.width = s.lo GROUP BY ALL),
folded AS (
  SELECT doc_id, digest AS leaf, subroot, (SELECT digest FROM b_roots) AS root,
         sha256(replace(array_to_string(i.steps || o.steps, ''), '|', '')) AS proof_sha256,
         list_reduce(list_prepend(presented, i.steps || o.steps),
                     lambda node, s: sha256(split_part(s, '|', 1) || node || split_part(s, '|', 2))) AS folded_root
  FROM inner_paths i JOIN outer_paths o USING (grp))
SELECT *, folded_root = root AS verified FROM folded"""
