"""Merkle manifest of a table: a digest per document, per language and for the whole, and a proof per document.

A document is a leaf. The leaves of a language, in the order of their ids, are the bottom of a
tree in which eight consecutive nodes have one parent; the roots of the languages, in the order
of their names, are the bottom of a last tree. The levels are built from below and stored as
rows that name their parent. A recursive query of Spark then climbs from every leaf to the
root, appending the siblings it passes and folding the leaf's digest with them.

Digests are stored as 32 bytes; what is hashed is their lowercase hex text.
"""

from __future__ import annotations

from functools import reduce
from uuid import uuid4

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.limits import BROADCAST_ROWS
from plumbline.llm.common import numbered, set_down

#: Nodes of a run, which have one parent.
FANOUT = 8
#: Leaves that meet a copy of one node in the climb; nodes high in a tree have a copy for each such block of leaves below them.
BLOCK_BITS = 10
#: The fields of a leaf, in the order they are hashed.
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Node ids hold their level above their place, and rise with it; levels of the last tree start here. A spot is a
#: place under a node: the node's id times the fanout and the place.
_LEVEL_BITS, _TOP_LEVEL = 52, 64

_CLIMB = """
WITH RECURSIVE climb(leaf, spot, folded, passed, siblings) AS (
  SELECT position, spot, folded, CAST(NULL AS BIGINT), CAST('' AS BINARY) FROM {leaves}
  UNION ALL
  SELECT c.leaf, n.spot,
         unhex(sha2(lower(concat(hex(substring(n.kids, 1, 32 * (c.spot % {fanout}))), hex(c.folded),
                                 hex(substring(n.kids, 32 * (c.spot % {fanout}) + 33)))), 256)),
         n.node, concat(substring(n.kids, 1, 32 * (c.spot % {fanout})), substring(n.kids, 32 * (c.spot % {fanout}) + 33))
  FROM climb c JOIN {nodes} n ON c.spot DIV {fanout} = n.node AND shiftright(c.leaf, {bits}) = n.block)
SELECT leaf AS position, passed, siblings, CASE WHEN spot IS NULL THEN folded END AS reached FROM climb WHERE passed IS NOT NULL
"""


def _hashed(text: Column) -> Column:
    return F.unhex(F.sha2(text, 256))


def leaf_digest(columns: dict[str, Column]) -> Column:
    """Digest of the fields: ``-`` for null, else the number of UTF-8 bytes, ``:`` and the value."""
    parts = []
    for name in FIELDS:
        value = columns[name].cast("string")
        parts.append(F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-")))
    return _hashed(F.concat(*parts))


def _node(level: int, place: Column) -> Column:
    return F.lit(level << _LEVEL_BITS) + place


def _spot(level: int) -> Column:
    """The spot of a tree's node ``idx`` under its parent, which lies in ``level``."""
    return _node(level, F.col("start") + F.floor(F.col("idx") / FANOUT)) * FANOUT + F.col("idx") % FANOUT


def _build(rows: DataFrame, base: int, largest: int) -> tuple[list[DataFrame], list[DataFrame]]:
    """All levels above ``rows``: the nodes of each, and the rows that are the root of their tree.

    ``rows`` has ``start`` (which tells trees apart), ``idx`` (place in the tree), ``n`` (nodes of
    this level), ``digest``, ``lo`` and ``hi`` (leaves below) and ``up`` (spot of the tree's root, null
    for the last tree); ``largest`` is the highest ``n``.
    """
    nodes, roots, level = [], [rows.where("n = 1")], base
    while largest > 1:
        runs = rows.where("n > 1").groupBy("start", F.floor(F.col("idx") / FANOUT).alias("idx")).agg(
            F.sort_array(F.collect_list(F.struct("idx", "digest"))).alias("list"), F.max("n").alias("n"), F.min("lo").alias("lo"),
            F.max("hi").alias("hi"), F.max("up").alias("up"))
        kids = F.aggregate("list", F.lit(b""), lambda all_, one: F.concat(all_, one["digest"]))
        runs = runs.withColumn("kids", kids).drop("list").withColumn("n", F.ceil(F.col("n") / FANOUT))
        rows = set_down(runs.withColumn("digest", _hashed(F.lower(F.hex("kids")))))
        nodes.append(rows.select(
            _node(level, F.col("start") + F.col("idx")).alias("node"), "kids", "lo", "hi",
            F.when(F.col("n") == 1, F.col("up")).otherwise(_spot(level + 1)).alias("spot")))
        roots.append(rows.where("n = 1"))
        level, largest = level + 1, -(-largest // FANOUT)
    return nodes, roots


def _climbed(leaves: DataFrame, nodes: list[DataFrame]) -> DataFrame:
    """``leaves`` with ``reached`` and ``proof``, the siblings in order as bytes, by the recursive query; set down.

    A leaf joins its node by the node's id and the leaf's block, so that the root, which all
    leaves reach, is met by one block of leaves at a time. Every step appends a row with the siblings
    it passed; the next step carries the folded digest alone, and a leaf's rows meet once at the end.
    """
    spark = leaves.sparkSession
    blocks = F.explode(F.sequence(F.shiftright("lo", BLOCK_BITS), F.shiftright("hi", BLOCK_BITS))).alias("block")
    empty = spark.createDataFrame([], "node bigint, kids binary, lo bigint, hi bigint, spot bigint")
    every = reduce(DataFrame.unionByName, nodes, empty).select("node", "kids", "spot", blocks)
    # dealt once as the join of every step wants them
    every = every.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "node", "block").persist()
    views = {"leaves": f"leaves_{uuid4().hex}", "nodes": f"nodes_{uuid4().hex}"}
    leaves.select("position", "spot", "folded").createOrReplaceTempView(views["leaves"])
    every.createOrReplaceTempView(views["nodes"])
    setting = "spark.sql.cteRecursionRowLimit"
    before = spark.conf.get(setting)
    spark.conf.set(setting, "-1")  # the limit is on all rows of the recursion, whatever the table's size
    try:
        own = [c for c in leaves.columns if c not in ("position", "spot")]
        facts = leaves.select("position", F.struct(*own).alias("leaf"))
        steps = spark.sql(_CLIMB.format(**views, fanout=FANOUT, bits=BLOCK_BITS))
        met = steps.unionByName(facts, allowMissingColumns=True).groupBy("position").agg(
            F.max("reached").alias("reached"), F.first("leaf", ignorenulls=True).alias("leaf"),
            F.sort_array(F.collect_list(F.when(F.col("passed").isNotNull(), F.struct("passed", "siblings")))).alias("steps"))
        proof = F.aggregate("steps", F.lit(b""), lambda all_, one: F.concat(all_, one["siblings"]))
        return set_down(met.select("leaf.*", F.coalesce("reached", "leaf.folded").alias("reached"),
                                   F.sha2(F.lower(F.hex(proof)), 256).alias("proof_sha256")).drop("folded"))
    finally:
        spark.conf.set(setting, before)
        every.unpersist()
        for view in views.values():
            spark.catalog.dropTempView(view)


def manifest(docs: DataFrame, tampered: Column) -> DataFrame:
    """``(doc_id, leaf, subroot, root, proof_sha256, folded_root, verified)``, a row for every document.

    Where ``tampered`` holds, the copy that is verified has its text's A-Z lowered. ``folded_root``
    is what the siblings of the stored tree make of the copy's digest; ``verified`` says that it is
    the root. A tampered text that is null, empty or without A-Z is unchanged, so it verifies.

    Null fields are hashed as ``-``; a null language is a tree of its own, the first, and a null
    ``doc_id`` the first of its language. Rows that repeat, or share an id, are leaves of their own;
    among equal ids the digest decides the order. A language of one document has that leaf as its
    root, and a table of one language that language's root. An empty table gives no rows. Only the
    five fields are read, so other columns cannot clash.
    """
    fields = {name: F.col(f"`{name}`") for name in FIELDS}
    lowered = fields | {"text": F.translate(fields["text"], _UPPER, _LOWER)}
    digest = leaf_digest(fields)
    rows = set_down(docs.select(
        fields["doc_id"].alias("doc_id"), F.coalesce(F.concat(F.lit("="), fields["lang"].cast("string")), F.lit("")).alias("tree"),
        digest.alias("digest"), F.when(F.coalesce(tampered, F.lit(False)), leaf_digest(lowered)).alias("changed")))
    placed = numbered(rows, F.col("tree"), F.col("doc_id"), F.col("digest"))
    trees = numbered(set_down(placed.groupBy("tree").agg(F.min("position").alias("start"), F.count(F.lit(1)).alias("n"))),
                     F.col("tree")).select("tree", "start", "n", F.col("position").alias("number"))
    count, largest = trees.agg(F.count(F.lit(1)), F.max("n")).first()
    trees = trees.withColumn("up", _node(_TOP_LEVEL, F.floor(F.col("number") / FANOUT)) * FANOUT + F.col("number") % FANOUT
                             if count > 1 else F.lit(None).cast("bigint"))
    # a tree meets each sorted partition it lies in, and leaves their partition's row, so that no language is one key
    spots = set_down(placed.select("part", "tree").distinct().join(trees, "tree"))
    small = spots.count() <= BROADCAST_ROWS
    leaves = set_down(placed.join(F.broadcast(spots) if small else spots, ["part", "tree"]).withColumn("idx", F.col("position") - F.col("start")))
    nodes, roots = _build(leaves.select("start", "idx", "n", "digest", F.col("position").alias("lo"), F.col("position").alias("hi"),
                                        "up"), 0, largest or 0)
    subroots = set_down(reduce(DataFrame.unionByName, [r.select("start", "digest", "lo", "hi", "n") for r in roots]))
    top = subroots.join(trees.select("start", "number"), "start").select(
        F.lit(0).cast("bigint").alias("start"), F.col("number").alias("idx"), F.lit(count).cast("bigint").alias("n"), "digest", "lo", "hi",
        F.lit(None).cast("bigint").alias("up"))
    top_nodes, top_roots = _build(top, _TOP_LEVEL, count)
    root = reduce(DataFrame.unionByName, [r.select("digest") for r in top_roots]).first()
    climbed = _climbed(leaves.select(
        "position", F.when(F.col("n") == 1, F.col("up")).otherwise(_spot(0)).alias("spot"), F.coalesce("changed", "digest").alias("folded"),
        "doc_id", "part", "start", "digest"), nodes + top_nodes)
    named = spots.select("part", "start").join(subroots.select("start", F.col("digest").alias("subroot")), "start")
    known = F.lit(bytes(root[0]) if root else None).cast("binary")
    return climbed.join(F.broadcast(named) if small else named, ["part", "start"]).select(
        "doc_id", F.lower(F.hex("digest")).alias("leaf"), F.lower(F.hex("subroot")).alias("subroot"), F.lower(F.hex(known)).alias("root"),
        "proof_sha256", F.lower(F.hex("reached")).alias("folded_root"), (F.col("reached") == known).alias("verified"))
