"""Merkle manifest of a table, and proofs of single rows that climb it in a recursive query.

A row's leaf is the SHA-256 of its columns; the leaves of a group, in order of their ids, are the
bottom of the group's tree, and the groups' roots in order of the groups are the bottom of the tree
over all. Every two neighbours of a level become the node above them, an odd last one alone.

Built levels are stored as parent-linked rows. A row links a node to its ancestor ``STEP`` levels
above (or to the top, if that is nearer) and holds the siblings on the way, level by level, so the
table has one row per node of every ``STEP``-th level, and a run of ``2 ** STEP`` neighbours is all that
a task holds at once. A recursive query climbs from every leaf at once: each turn joins all climbers
with the rows of their present nodes, appends the siblings and folds the claimed hash, until the
link is empty. Spark writes each turn's rows to shuffle files, so a lost executor costs that turn.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from contextlib import contextmanager
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm.common import numbered, settle

STEP = 8

#: The tree over the groups' roots; the tree of a group is named by its first leaf, 0 or more.
TOP = -1

_LIMIT = "spark.sql.cteRecursionRowLimit"

# Hash of a node from a child and its sibling in the order of their places; NULL is no sibling.
_FOLD = """aggregate(s.siblings, named_struct('h', {h}, 'p', s.pos), (a, x) -> named_struct(
  'h', unhex(sha2(CASE WHEN x IS NULL THEN lower(hex(a.h))
    WHEN a.p % 2 = 1 THEN lower(concat(hex(x), hex(a.h)))
    ELSE lower(concat(hex(a.h), hex(x))) END, 256)),
  'p', a.p div 2)).h"""

_CLIMB = f"""
WITH RECURSIVE climb(id, leaf, own, tree, step, pos, folded, proof) AS (
  SELECT s.id, s.leaf, s.tree, s.up_tree, s.up_step, s.up_pos, {_FOLD.format(h="s.claimed")},
    aggregate(s.siblings, X'', (a, x) -> concat(a, coalesce(x, X'')))
  FROM {{leaves}} s
  UNION ALL
  SELECT c.id, c.leaf, c.own, s.up_tree, s.up_step, s.up_pos, {_FOLD.format(h="c.folded")},
    aggregate(s.siblings, c.proof, (a, x) -> concat(a, coalesce(x, X'')))
  FROM climb c JOIN {{nodes}} s ON s.tree = c.tree AND s.step = c.step AND s.pos = c.pos)
SELECT id, leaf, own, folded, proof FROM climb WHERE tree IS NULL"""


@dataclass(frozen=True)
class Manifest:
    """``leaves``: id, leaf, claimed, tree, n, pos and link; ``nodes``: the rows above, keyed by
    tree, step and pos; ``subroots``: tree and hash; ``root``: lower-case hex, None without rows."""

    leaves: DataFrame
    nodes: DataFrame
    subroots: DataFrame
    root: str | None


def encoded(value: Column) -> Column:
    """``-`` for NULL, else the UTF-8 length, a colon and the value as text."""
    text = value.cast("string")
    sized = F.concat(F.octet_length(text).cast("string"), F.lit(":"), text)
    return F.coalesce(sized, F.lit("-"))


def leaf_hash(values: Sequence[Column]) -> Column:
    return F.unhex(F.sha2(F.concat(*[encoded(v) for v in values]), 256))


def hex_text(digest: Column) -> Column:
    return F.lower(F.hex(digest))


def _raised(nodes: DataFrame, step: int, bits: int) -> DataFrame:
    """``nodes`` (tree, n, pos, hash, more) with ``siblings``, the link and the ancestor's hash.

    Runs of ``2 ** bits`` neighbours meet in one row. ``n`` is the number of nodes in the tree's
    level; a tree of no more than a run ends here, at its root.
    """
    own = [c for c in nodes.columns if c not in ("tree", "n", "pos")]
    runs = nodes.groupBy("tree", "n", F.shiftright("pos", bits).alias("run")).agg(
        F.sort_array(F.collect_list(F.struct("pos", *own))).alias("members")
    )
    ends = F.col("n") <= (1 << bits)
    height = F.when(ends, F.ceil(F.log2("n")).cast("int")).otherwise(bits)
    levels = F.expr(
        """aggregate(filter(sequence(0, height), k -> k > 0), array(transform(members, m -> m.hash)),
          (a, k) -> concat(a, array(transform(
            sequence(0, (size(element_at(a, -1)) - 1) div 2),
            i -> unhex(sha2(lower(concat(hex(get(element_at(a, -1), CAST(2 * i AS INT))),
              coalesce(hex(get(element_at(a, -1), CAST(2 * i + 1 AS INT))), ''))), 256))))))"""
    )
    runs = runs.withColumn("height", height).withColumn("levels", levels)
    rows = runs.select("*", F.posexplode("members").alias("i", "m"))
    siblings = F.expr(
        "transform(filter(sequence(0, height), k -> k < height),"
        " k -> get(get(levels, k), shiftright(i, k) ^ 1))"
    )
    top = F.col("tree") == TOP
    return rows.select(
        "tree",
        "n",
        F.lit(step).alias("step"),
        F.col("m.pos").alias("pos"),
        *[F.col(f"m.{c}").alias(c) for c in own],
        siblings.alias("siblings"),
        F.when(~ends, F.col("tree")).when(~top, TOP).cast("bigint").alias("up_tree"),
        F.when(~ends, F.lit(step + 1)).when(~top, 0).cast("int").alias("up_step"),
        # The place in the tree over all is filled in once the groups are numbered.
        F.when(~ends, F.col("run")).cast("bigint").alias("up_pos"),
        F.get(F.element_at("levels", -1), F.lit(0)).alias("ancestor"),
        (F.col("i") == 0).alias("first"),
    )


def _tree(bottom: DataFrame, largest: int, bits: int) -> tuple[list[DataFrame], DataFrame]:
    """All steps of the trees over ``bottom``, written, and each tree's root."""
    steps, roots, nodes, size = [], [], bottom, largest
    while True:
        rows = settle(_raised(nodes, len(steps), bits), f"merkle-{len(steps)}")
        steps.append(rows)
        ended = F.col("first") & (F.col("n") <= (1 << bits))
        roots.append(rows.where(ended).select("tree", F.col("ancestor").alias("hash")))
        if size <= 1 << bits:
            return steps, reduce(DataFrame.unionByName, roots)
        going = rows.where(F.col("first") & (F.col("n") > (1 << bits)))
        above = F.shiftright(F.col("n") + ((1 << bits) - 1), bits)
        nodes = going.select(
            "tree", above.alias("n"), F.col("up_pos").alias("pos"), F.col("ancestor").alias("hash")
        )
        size = (size + (1 << bits) - 1) >> bits


def build(
    df: DataFrame,
    columns: Sequence[str],
    id_col: str,
    group_col: str,
    claimed: Mapping[str, Column] | None = None,
    bits: int = STEP,
) -> Manifest:
    """The manifest of ``df``: a tree per group, leaves ascending by id, and a tree over the groups.

    ``claimed`` gives the values that a claimant states for some columns; without it the claimed
    leaf is the leaf itself. NULL ids and groups come first, equal ids in order of their leaves.
    Repeated rows are leaves of their own. Columns not named take no part, whatever their names.
    """
    spark = df.sparkSession
    stated = dict(claimed or {})
    leaf = leaf_hash([F.col(c) for c in columns])
    rows = df.select(
        F.col(id_col).alias("id"),
        F.col(group_col).alias("grp"),
        leaf.alias("hash"),
        leaf_hash([stated.get(c, F.col(c)) for c in columns]).alias("claimed")
        if stated
        else leaf.alias("claimed"),
    )
    order = [F.asc_nulls_first("grp"), F.asc_nulls_first("id"), F.col("hash"), F.col("claimed")]
    rows = numbered(rows, order, "place", "leaves")
    groups = rows.groupBy("grp").agg(F.min("place").alias("tree"), F.count("*").alias("n"))
    groups = settle(groups, "groups")
    size = groups.agg(F.max("n").alias("largest"), F.count("*").alias("n")).first()
    if not size.n:
        empty = rows.select("id", F.col("hash").alias("leaf")).limit(0)
        return Manifest(empty, empty, empty, None)
    bottom = rows.join(groups, rows["grp"].eqNullSafe(groups["grp"])).select(
        "tree", "n", (F.col("place") - F.col("tree")).alias("pos"), "hash", "id", "claimed"
    )
    steps, roots = _tree(bottom, size.largest, bits)

    subroots = numbered(roots, [F.col("tree")], "top_pos", "subroots")
    tops = subroots.select(
        F.lit(TOP).cast("bigint").alias("tree"),
        F.lit(size.n).cast("bigint").alias("n"),
        F.col("top_pos").alias("pos"),
        "hash",
    )
    over, root = _tree(tops, size.n, bits)

    places = subroots.select("tree", "top_pos")

    def linked(nodes: DataFrame) -> DataFrame:
        up = F.when(F.col("up_tree") == TOP, F.col("top_pos")).otherwise(F.col("up_pos"))
        return nodes.join(places, "tree").withColumn("up_pos", up).drop("top_pos")

    link = ["tree", "step", "pos", "siblings", "up_tree", "up_step", "up_pos"]
    leaves = linked(steps[0]).select(
        "id", F.col("hash").alias("leaf"), "claimed", *link
    )
    upper = [linked(s).select(*link) for s in steps[1:]] + [s.select(*link) for s in over]
    nodes = settle(reduce(DataFrame.unionByName, upper), "merkle-nodes")
    top = root.select(hex_text(F.col("hash")).alias("h")).first().h
    return Manifest(leaves, nodes, subroots.select("tree", "hash"), top)


@contextmanager
def _unlimited(spark: SparkSession) -> Iterator[None]:
    """Recursive queries stop at a million rows unless told otherwise."""
    before = spark.conf.get(_LIMIT)
    spark.conf.set(_LIMIT, "-1")
    try:
        yield
    finally:
        spark.conf.set(_LIMIT, before)


def prove(manifest: Manifest) -> DataFrame:
    """Every leaf's ``id``, ``leaf``, ``subroot``, ``root``, ``proof_sha256`` (of its siblings from
    the leaf to the root), ``folded_root`` (from the claimed leaf) and ``verified``.

    Digests are lower-case hex. A table without rows has no proofs.
    """
    spark = manifest.leaves.sparkSession
    if manifest.root is None:
        empty = manifest.leaves
        text = [F.lit("").alias(c) for c in ("subroot", "root", "proof_sha256", "folded_root")]
        return empty.select(
            "id", hex_text(F.col("leaf")).alias("leaf"), *text, F.lit(True).alias("verified")
        )
    with _unlimited(spark):
        climbed = spark.sql(_CLIMB, leaves=manifest.leaves, nodes=manifest.nodes)
        climbed = settle(climbed, "proofs")
    subroots = manifest.subroots.select(F.col("tree").alias("own"), F.col("hash").alias("subroot"))
    folded = hex_text(F.col("folded"))
    return climbed.join(subroots, "own").select(
        "id",
        hex_text(F.col("leaf")).alias("leaf"),
        hex_text(F.col("subroot")).alias("subroot"),
        F.lit(manifest.root).alias("root"),
        F.sha2(hex_text(F.col("proof")), 256).alias("proof_sha256"),
        folded.alias("folded_root"),
        (folded == manifest.root).alias("verified"),
    )
