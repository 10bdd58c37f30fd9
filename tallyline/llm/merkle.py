"""Merkle manifest of a dataset, and a proof for every row of it.

Each row is a leaf, the SHA-256 of its fields; per group (``lang``) the leaves ascend by key, and two
neighbours at a time become their hash until one node, the subroot, remains; the subroots, ordered by
group, become the root in the same way.

Built levels are stored as rows: a node, its parent, its sibling and on which side it is. 1,024 leaves at
a time form a part, whose ten lower levels are built in one group; the roots of parts are grouped again,
until one node remains. A first recursive query climbs from the root of each part to the root of all, so
that a part has its own copy of that path; a second one climbs from each leaf, appends the sibling as a
row and folds the (perhaps tampered) hash with it. As nodes are joined within their part, no node is met
by more than 1,024 climbing rows, however high it is; and as nodes lie in buckets of their part, a step of
the climb exchanges the climbing rows alone.

Null keys come first, rows with equal keys are ordered by their leaf; equal rows are leaves of their own
and each gets a proof. Null fields are written ``-``, other values as their UTF-8 length, ``:`` and value.
The group null is a group of its own, before the others. A lone leaf is its own subroot, a lone subroot
the root, with a proof over nothing. No rows give no rows. Other columns are ignored.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyline.functions.ranking import number_rows, running_total
from tallyline.llm.store import staged
from tallyline.plans.tables import bucketed_table, write_bucketed
from tallyline.session import staging_root

PART = 10  # levels in a part
TOP = -1  # the tree over the subroots


def field(value: Column) -> Column:
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(fields: list[Column]) -> Column:
    return F.unhex(F.sha2(F.concat(*map(field, fields)), 256))


@contextmanager
def climbing(spark: SparkSession) -> Iterator[None]:
    """A climb has as many rows as leaves times levels; Spark stops at a million of them by default. Rows that
    are dealt by their part alone may be joined on part and node as they lie."""
    wanted = {"spark.sql.cteRecursionRowLimit": "-1", "spark.sql.requireAllClusterKeysForCoPartition": "false"}
    before = {name: spark.conf.get(name) for name in wanted}
    for name, value in wanted.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


# Levels of one part, from the given one up: two neighbours, or a last one alone, become their hash.
_LEVELS = f"""
aggregate(sequence(1, least({PART}, length(bin(n - 1)))), array(below), (made, k) -> concat(made, array(
  transform(sequence(0, (size(element_at(made, -1)) - 1) div 2), i -> unhex(sha2(concat(
    lower(hex(element_at(made, -1)[2 * i])), coalesce(lower(hex(get(element_at(made, -1), 2 * i + 1))), '')), 256))))))
"""


def parts(nodes: DataFrame, name: str) -> DataFrame:
    """(tree, n, part, levels) from nodes (tree, idx, hash, n: how many the tree has at this level)."""
    grouped = nodes.withColumn("part", F.shiftright("idx", PART)).groupBy("tree", "n", "part").agg(
        F.array_sort(F.collect_list(F.struct("idx", "hash"))).alias("found"))
    below = grouped.select("tree", "n", "part", F.expr("found.hash").alias("below"))
    return staged(below.select("tree", "n", "part", F.when(F.col("n") > 1, F.expr(_LEVELS)).otherwise(
        F.array("below")).alias("levels")), name)


def links(built: DataFrame, kept: list[str]) -> DataFrame:
    """One row per node below the last level of its part: where it stands there, and its sibling."""
    by_level = built.select(*kept, "part", F.size("levels").alias("size"), F.posexplode("levels").alias("k", "nodes"))
    return by_level.where("k < size - 1").select(*kept, "part", "size", "k", "nodes", F.posexplode("nodes").alias("i", "hash")).select(
        *kept, "part", "size", "k", "i", F.expr("get(nodes, i ^ 1)").alias("sibling"), F.expr("i % 2 = 1").alias("before"))


def _upper(built: DataFrame, base: int, top_leaves: DataFrame | None) -> DataFrame:
    """Links of the levels above the parts of leaves; the last of a tree leads into the tree over the subroots."""
    found = links(built, ["tree", "n"]).select(
        "tree", (F.lit(base) + F.col("k")).alias("level"), F.expr(f"(part << ({PART} - k)) + i").alias("idx"), "sibling", "before",
        (F.col("n") <= 1 << PART).alias("last"), "k", "size")
    up = [F.col("tree").alias("to_tree"), (F.col("level") + 1).alias("to_level"), F.shiftright("idx", 1).alias("to_idx")]
    if top_leaves is None:
        return found.select("tree", "level", "idx", "sibling", "before", *up)
    ends = F.col("last") & (F.col("k") == F.col("size") - 2)
    return found.join(top_leaves.select("tree", F.col("idx").alias("rank")), "tree").select(
        "tree", "level", "idx", "sibling", "before", F.when(ends, TOP).otherwise(up[0]).alias("to_tree"),
        F.when(ends, 0).otherwise(up[1]).alias("to_level"), F.when(ends, F.col("rank")).otherwise(up[2]).alias("to_idx"))


def _tree(nodes: DataFrame, name: str) -> list[DataFrame]:
    """Parts of all levels of trees of nodes (tree, idx, hash, n), from below."""
    made, most = [], nodes.agg(F.max("n")).first()[0] or 0
    while most:
        made.append(parts(nodes, name))
        nodes = made[-1].where(f"n > {1 << PART}").select(
            "tree", F.col("part").alias("idx"), F.expr(f"levels[{PART}][0]").alias("hash"),
            F.ceil(F.col("n") / (1 << PART)).cast("long").alias("n"))
        most = -(-most >> PART) if most > 1 << PART else 0
    return made


def _roots(made: list[DataFrame]) -> DataFrame:
    """(tree, hash) of the last node of each tree."""
    last = [b.where(f"n <= {1 << PART}").select("tree", F.expr("element_at(levels, -1)[0]").alias("hash")) for b in made]
    both = last[0]
    for other in last[1:]:
        both = both.unionByName(other)
    return both


_PATHS = """
WITH RECURSIVE path (first, tree, level, idx, step, sibling, before) AS (
  SELECT first, tree, level, idx, 0, CAST(NULL AS BINARY), CAST(NULL AS BOOLEAN) FROM {starts}
  UNION ALL
  SELECT p.first, n.to_tree, n.to_level, n.to_idx, p.step + 1, n.sibling, n.before
  FROM path p JOIN {nodes} n ON n.tree = p.tree AND n.level = p.level AND n.idx = p.idx)
SELECT first, step, sibling, before FROM path WHERE step > 0
"""

_CLIMB = """
WITH RECURSIVE climb (leaf_id, first, node, step, folded, sibling) AS (
  SELECT leaf_id, first, node, 0, hash, CAST(NULL AS BINARY) FROM {starts}
  UNION ALL
  SELECT c.leaf_id, c.first, n.parent, c.step + 1,
         unhex(sha2(CASE WHEN n.sibling IS NULL THEN lower(hex(c.folded))
                         WHEN n.before THEN concat(lower(hex(n.sibling)), lower(hex(c.folded)))
                         ELSE concat(lower(hex(c.folded)), lower(hex(n.sibling))) END, 256)), n.sibling
  FROM climb c JOIN {nodes} n ON n.first = c.first AND n.node = c.node)
SELECT leaf_id, max_by(folded, step) AS folded, sha2(array_join(transform(array_sort(collect_list(
         CASE WHEN sibling IS NOT NULL THEN struct(step, sibling) END)), p -> lower(hex(p.sibling))), ''), 256) AS proof
FROM climb GROUP BY leaf_id
"""


def manifest(docs: DataFrame, tampered: Column, id_col: str = "doc_id", group_col: str = "lang",
             fields: tuple[str, ...] = ("doc_id", "source", "lang", "n_chars", "text"), changed: str = "n_chars") -> DataFrame:
    """One row per row of ``docs``: (id, leaf, subroot, root, proof_sha256, folded_root, verified), hashes in hex.

    ``tampered``: rows (a condition on the key, named ``id``) whose leaf is made again with 1 added to the
    field ``changed`` before it is folded. verified: the folded hash equals the root.
    """
    spark = docs.sparkSession
    altered = [F.col(f) + 1 if f == changed else F.col(f) for f in fields]
    own = docs.select(F.col(id_col).alias("id"), F.col(group_col).alias("grp"), leaf([F.col(f) for f in fields]).alias("hash"),
                      leaf(altered).alias("altered"))
    leaves = staged(own.select(F.monotonically_increasing_id().alias("leaf_id"), "id", "grp", "hash", F.when(
        F.coalesce(tampered, F.lit(False)), F.col("altered")).otherwise(F.col("hash")).alias("start")), "leaves")
    order = [F.col(c).asc_nulls_first() for c in ("grp", "id", "hash", "leaf_id")]
    sizes = leaves.groupBy("grp").agg(F.count("*").alias("n"))
    groups = staged(running_total(sizes, [F.col("grp").asc_nulls_first()], "n", "tree", "all").drop("all"), "groups")
    placed = number_rows(leaves, order, "position")
    placed = staged(placed.join(groups.withColumnRenamed("grp", "of"), F.col("grp").eqNullSafe(F.col("of"))).select(
        "leaf_id", "id", "hash", "start", "tree", "n", (F.col("position") - F.col("tree")).alias("idx")), "tree-leaves")

    trees = _tree(placed.select("tree", "idx", "hash", "n"), "tree-parts")
    if not trees:
        return placed.select(F.col("id").alias(id_col), *[F.lit("").alias(c) for c in ("leaf", "subroot", "root", "proof_sha256", "folded_root")],
                             F.lit(True).alias("verified"))
    subroots = staged(number_rows(_roots(trees), [F.col("tree").asc()], "idx"), "subroots")
    count = F.lit(subroots.count()).cast("long")
    top = _tree(subroots.select(F.lit(TOP).cast("long").alias("tree"), "idx", "hash", count.alias("n")), "top-parts")
    root = _roots(top).first()["hash"]

    # Links above the parts of leaves, and from where each part starts to climb them.
    upper = [_upper(b, PART * n, subroots) for n, b in enumerate(trees) if n] + [_upper(b, PART * n, None) for n, b in enumerate(top)]
    above = upper[0]
    for other in upper[1:]:
        above = above.unionByName(other)
    first = (F.col("tree") + F.shiftleft(F.col("part"), PART)).alias("first")
    alone = F.col("n") <= 1 << PART
    starts = trees[0].join(subroots.select("tree", F.col("idx").alias("rank")), "tree").select(
        first, F.when(alone, TOP).otherwise(F.col("tree")).alias("tree"), F.when(alone, 0).otherwise(PART).alias("level"),
        F.when(alone, F.col("rank")).otherwise(F.col("part")).alias("idx"))
    height = F.least(F.lit(PART), F.when(F.col("n") > 1, F.expr("length(bin(n - 1))")).otherwise(0))
    with climbing(spark):
        paths = staged(spark.sql(_PATHS, starts=staged(starts, "part-roots"), nodes=staged(above, "upper-links")), "paths")
        inside = links(trees[0], ["tree"]).select(
            first, F.expr("(1 << (size - 1 - k)) + i").alias("node"), "sibling", "before").withColumn("parent", F.shiftright("node", 1))
        path = paths.select("first", F.expr("IF(step = 1, 1, 1 - step)").alias("node"), "sibling", "before", (-F.col("step")).alias("parent"))
        nodes, buckets = inside.unionByName(path), int(spark.conf.get("spark.sql.shuffle.partitions"))
        folder = f"{staging_root(spark)}/llm-links-{uuid.uuid4().hex[:12]}"
        write_bucketed(nodes.repartition(buckets, "first"), folder, "first", buckets)
        begin = placed.withColumn("h", height).select(
            "leaf_id", (F.col("tree") + F.shiftleft(F.shiftright("idx", PART), PART)).alias("first"),
            F.expr(f"CAST((1 << h) + idx % {1 << PART} AS INT)").alias("node"), F.col("start").alias("hash"))
        with bucketed_table(spark, folder, nodes.schema, [], "first", buckets, []) as table:
            folded = staged(spark.sql(_CLIMB, starts=begin, nodes=table.hint("merge")), "climb")
    name = lambda c: F.lower(F.hex(c))
    return folded.join(placed, "leaf_id").join(subroots.select("tree", F.col("hash").alias("subroot")), "tree").select(
        F.col("id").alias(id_col), name("hash").alias("leaf"), name("subroot").alias("subroot"), name(F.lit(root)).alias("root"),
        F.col("proof").alias("proof_sha256"),
        name("folded").alias("folded_root"), (F.col("folded") == F.lit(root)).alias("verified"))
