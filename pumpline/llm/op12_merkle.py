"""Merkle dataset manifest by a butterfly exchange between partitions.

A manifest is a forest and a crown: the rows of a source, in the order of their
ids, are the leaves of that source's tree; the roots of the sources, in their
order, are the leaves of one more tree.  Every tree joins ``FANOUT`` neighbouring
nodes at a time, the last ones of a level however few they are.

A tree is cut into aligned partitions of ``FANOUT ** HEIGHT`` leaves.  Each hashes
its own subtree alone.  Then the partitions exchange subtree roots like the wires
of a butterfly: in round r, those that differ only in digit r of their number (to
the base of the fanout) swap the roots they have reached, and each hashes the
common ancestor for itself.  After the last round every partition holds the root
and has met all siblings above it, so proofs need no way down.  Numbers beyond the
last partition take part without a root of their own; they learn the roots of
partial groups like any other, so no partition serves more than its own group.

Rows: null fields are ``-``; null sources form one tree, first in order; ids
ascend with null first, rows of equal id by their leaf (equal rows are
interchangeable); a null id is never tampered with; texts are hashed whole; an
empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pumpline.llm.common import ready, save

FANOUT = 3
#: Levels hashed inside one partition: 729 leaves.
HEIGHT = 6
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
PATH = "array<struct<left:string,right:string>>"


def _field(col: Column) -> Column:
    value = col.cast("string")
    return F.when(col.isNull(), "-").otherwise(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value))


def leaf(**changed: Column) -> Column:
    """Hash of a row's fields, some of them replaced."""
    return F.sha2(F.concat(*[_field(changed.get(c, F.col(c))) for c in FIELDS]).cast("binary"), 256)


def tampered() -> Column:
    """The leaf after the new lines are gone, where the id's crc32 is even; null where that changes nothing."""
    text = F.col("text").cast("string")
    hit = (F.crc32(F.col("doc_id").cast("string")) % 2 == 0) & text.contains("\n")
    return F.when(hit, leaf(text=F.translate(text, "\n", "")))


def _join(hashes: list[str]) -> str:
    return sha256("".join(hashes).encode()).hexdigest()


def levels(hashes: list[str], height: int | None) -> list[list[str]]:
    """Nodes of each level of a subtree, leaves first: up to ``height``, or (None) to a single node."""
    out = [hashes]
    while len(out[-1]) > 1 if height is None else len(out) <= height:
        out.append([_join(out[-1][i:i + FANOUT]) for i in range(0, len(out[-1]), FANOUT)])
    return out


def siblings(own: list[list[str]], at: int) -> list[tuple[str, str]]:
    """For each level of a subtree, the hashes left and right of the leaf's ancestor in its run."""
    out = []
    for nodes in own[:-1]:
        first = at - at % FANOUT
        out.append(("".join(nodes[first:at]), "".join(nodes[at + 1:first + FANOUT])))
        at //= FANOUT
    return out


def fold(node: str, path: list[tuple[str, str]]) -> str:
    for left, right in path:
        node = _join([left, node, right])
    return node


def place(spark: SparkSession, nodes: DataFrame, order: list[str]) -> DataFrame:
    """``nodes`` (tree, hash, tie, ...) with ``at`` (place in its tree from 0), ``block`` and ``n`` (nodes of the tree).

    The rows are cut into range partitions, saved with their number; each counts
    its trees' rows, and the counts give the others their start.
    """
    sort = ["tree", *order, "hash", "tie"]
    cut = save(spark, nodes.repartitionByRange(*sort).withColumn("part", F.spark_partition_id()), "merkle-ranges")
    sizes = cut.groupBy("tree", "part").agg(F.count(F.lit(1)).alias("own"))
    in_tree = Window.partitionBy("tree")
    start = sizes.select("tree", "part", F.sum("own").over(in_tree).alias("n"),
                         (F.sum("own").over(in_tree.orderBy("part")) - F.col("own")).alias("start"))
    here = Window.partitionBy("tree", "part").orderBy(*[F.col(c).asc_nulls_first() for c in sort[1:]])
    at = F.col("start") + F.row_number().over(here) - 1
    placed = cut.join(start, ["tree", "part"]).withColumn("at", at).drop("start", "part", "tie")
    return save(spark, placed.withColumn("block", F.floor(F.col("at") / FANOUT ** HEIGHT)), "merkle-leaves")


def _alone(table: pa.Table) -> list[list[str]]:
    """Levels of the subtree of one partition."""
    own = table.column("hash").to_pylist()
    return levels(own, None if table.column("n")[0].as_py() <= FANOUT ** HEIGHT else HEIGHT)


def exchange(spark: SparkSession, placed: DataFrame) -> DataFrame:
    """(tree, block, root, path): for each partition its tree's root and the siblings met on the way to it."""
    def subtree(table: pa.Table) -> pa.Table:
        table = table.sort_by("at")
        first = table.slice(0, 1).select(["tree", "block", "n"])
        return first.append_column("root", pa.array([_alone(table)[-1][0]]))

    state = placed.select("tree", "block", "at", "n", "hash").groupBy("tree", "block").applyInArrow(
        subtree, "tree string, block long, n long, root string")
    blocks = F.ceil(F.col("n") / FANOUT ** HEIGHT)
    rounds, width = F.lit(0), F.lit(1).cast("long")
    most = placed.agg(F.max("n")).first()[0]
    limit, total = 1, -(-most // FANOUT ** HEIGHT)
    k = 0
    while limit < total:
        rounds, width = F.when(blocks > limit, k + 1).otherwise(rounds), F.when(blocks > limit, limit * FANOUT).otherwise(width)
        limit, k = limit * FANOUT, k + 1
    # numbers up to the next power of the fanout: each partition also stands in for those a tree's length further on
    copies = F.transform(F.sequence(F.lit(0), F.lit(FANOUT - 1)), lambda c: F.struct((F.col("block") + c * blocks).alias("block"), (c == 0).alias("real")))
    state = (state.select("tree", "root", rounds.alias("rounds"), width.alias("width"), F.explode(copies).alias("c"))
             .where((F.col("c.block") < F.col("width")))
             .select("tree", F.col("c.block").alias("block"), "rounds", F.when(F.col("c.real"), F.col("root")).alias("root"),
                     F.array().cast(PATH).alias("path")))
    state = save(spark, state, "merkle-round-0")
    for r in range(k):
        state = save(spark, swap(state, r), f"merkle-round-{r + 1}")
    return state


def swap(state: DataFrame, r: int) -> DataFrame:
    """One round: the partitions that differ in digit ``r`` alone hear each other's roots."""
    step = FANOUT ** r
    slot = F.floor(F.col("block") / step) % FANOUT
    member = F.struct(slot.alias("slot"), "root", "block", "rounds", "path")
    group = state.groupBy("tree", F.floor(F.col("block") / (step * FANOUT)).alias("g"), (F.col("block") % step).alias("low")).agg(
        F.sort_array(F.collect_list(member)).alias("m"))  # FANOUT rows at most
    every = F.array_join(F.transform("m", lambda x: x["root"]), "")  # without those that have none
    beside = lambda near: F.array_join(F.transform(F.filter("m", near), lambda x: x["root"]), "")
    heard = F.struct(beside(lambda x: x["slot"] < F.col("x.slot")).alias("left"), beside(lambda x: x["slot"] > F.col("x.slot")).alias("right"))
    going = F.col("x.rounds") > r
    return group.select("tree", "m", F.explode("m").alias("x")).select(
        "tree", F.col("x.block").alias("block"), F.col("x.rounds").alias("rounds"),
        F.when(~going, F.col("x.root")).when(every != "", F.sha2(every.cast("binary"), 256)).alias("root"),
        F.when(going, F.concat(F.col("x.path"), F.array(heard))).otherwise(F.col("x.path")).alias("path"))


def proofs(placed: DataFrame, above: DataFrame, keep: list[str]) -> DataFrame:
    """The columns ``keep`` of each leaf, its hash and its whole path, with what else ``above`` says of its partition."""
    path = pa.list_(pa.struct([("left", pa.string()), ("right", pa.string())]))
    said = [c for c in above.columns if c not in ("tree", "block", "path")]

    def prove(leaves: pa.Table, upper: pa.Table) -> pa.Table:
        leaves = leaves.sort_by("at")
        own, up = _alone(leaves), upper.column("path")[0].as_py()
        paths = [[{"left": a, "right": b} for a, b in siblings(own, i)] + up for i in range(len(own[0]))]
        out = leaves.select(["hash", *keep])
        for c in said:
            out = out.append_column(c, pa.array([upper.column(c)[0].as_py()] * len(paths), pa.string()))
        return out.append_column("path", pa.array(paths, path))

    kinds = ", ".join(f"`{c}` {placed.schema[c].dataType.simpleString()}" for c in ("hash", *keep))
    used = above.join(placed.select("tree", "block").distinct(), ["tree", "block"], "left_semi")
    return placed.groupBy("tree", "block").cogroup(used.groupBy("tree", "block")).applyInArrow(
        prove, ", ".join([kinds, *[f"{c} string" for c in said], f"path {PATH}"]))


def manifest(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """(doc_id, leaf, changed, subroot, root, path) of every row.

    ``changed`` is the leaf after the tampering (null: none); ``path`` are the
    siblings, left and right of the way from the leaf to the root.
    """
    ready(spark)
    source = F.col("source").cast("string")
    rows = docs.select(F.coalesce(F.concat(F.lit("+"), source), F.lit("-")).alias("tree"), source.alias("source"), "doc_id",
                       leaf().alias("hash"), tampered().alias("changed"), F.monotonically_increasing_id().alias("tie"))
    rows = save(spark, rows, "merkle-rows")
    if rows.isEmpty():
        none = F.lit(None).cast("string")
        return rows.select("doc_id", F.col("hash").alias("leaf"), "changed", none.alias("subroot"), none.alias("root"),
                           F.array().cast(PATH).alias("path"))
    placed = place(spark, rows, ["doc_id"])
    above = exchange(spark, placed)
    subroots = above.where("block = 0").select("tree", F.col("root").alias("hash"))
    named = placed.where("at = 0").select("tree", "source").join(subroots, "tree")
    crown = place(spark, named.select(F.lit("").alias("tree"), F.col("tree").alias("of"), "source", "hash", F.lit(0).alias("tie")), ["source"])
    tops = proofs(crown, exchange(spark, crown).select("tree", "block", "root", "path"), ["of"])
    tops = save(spark, tops.select(F.col("of").alias("tree"), "root", F.col("path").alias("rest")), "merkle-tops")
    # a partition's way goes on through its source's: one row a partition, before the leaves come in
    above = above.withColumnRenamed("root", "subroot").join(tops, "tree").select("tree", "block", "subroot", "root", F.concat("path", "rest").alias("path"))
    return proofs(placed, above, ["doc_id", "changed"]).select("doc_id", F.col("hash").alias("leaf"), "changed", "subroot", "root", "path")


def digest(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """Contract columns: the proof's hash, and the root that the (perhaps tampered) leaf folds to along its siblings."""
    met = F.array_join(F.transform("path", lambda x: F.concat(x["left"], x["right"])), "")
    folded = F.aggregate("path", F.coalesce("changed", "leaf"), lambda node, x: F.sha2(F.concat(x["left"], node, x["right"]).cast("binary"), 256))
    return manifest(spark, docs).select("doc_id", "leaf", "subroot", "root", F.sha2(met.cast("binary"), 256).alias("proof_sha256"),
                                        folded.alias("folded_root")).withColumn("verified", F.col("folded_root") == F.col("root"))


#: crc32 of a text's bytes (decimal digits here), one step a bit.
_CRC = """xor(4294967295, list_reduce(list_concat([4294967295::BIGINT], list_transform(range(1, length({0}) + 1), lambda i: ascii(substr({0}, i::INT, 1))::BIGINT)),
  lambda c, b: list_reduce(list_concat([xor(c, b)], range(8)), lambda x, i: xor(x >> 1, 3988292384 * (x & 1)))))"""


def _sql_field(c: str) -> str:
    return f"coalesce(octet_length(encode(CAST({c} AS VARCHAR))) || ':' || CAST({c} AS VARCHAR), '-')"


def _sql_leaf(text: str) -> str:
    return "sha256(" + " || ".join(_sql_field(text if c == "text" else c) for c in FIELDS) + ")"


def oracle() -> str:
    """The whole tree level by level, without partitions."""
    up = """SELECT {tree}, lvl + 1, pos // 3, (n + 2) // 3, sha256(string_agg(h, '' ORDER BY pos)) FROM {name} WHERE n > 1 GROUP BY {tree}, lvl, pos // 3, n"""
    return f"""WITH RECURSIVE leaves AS (
  SELECT doc_id, CASE WHEN source IS NULL THEN '-' ELSE '+' || source END AS tree, source, leaf,
    row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, count(*) OVER (PARTITION BY source) AS n,
    CASE WHEN {_CRC.format('CAST(doc_id AS VARCHAR)')} % 2 = 0 THEN changed ELSE leaf END AS changed
  FROM (SELECT doc_id, source, {_sql_leaf('text')} AS leaf, {_sql_leaf("replace(text, chr(10), '')")} AS changed FROM documents) t),
nodes(tree, lvl, pos, n, h) AS (
  SELECT tree, 0, pos, n, leaf FROM leaves UNION ALL {up.format(tree='tree', name='nodes')}),
subroots AS (SELECT tree, h AS subroot, lvl AS height FROM nodes WHERE n = 1),
crown0 AS (SELECT s.tree, s.subroot, row_number() OVER (ORDER BY l.source NULLS FIRST) - 1 AS pos, count(*) OVER () AS n
  FROM subroots s JOIN (SELECT DISTINCT tree, source FROM leaves) l USING (tree)),
crown(tree, lvl, pos, n, h) AS (
  SELECT 0, 0, pos, n, subroot FROM crown0 UNION ALL {up.format(tree='tree', name='crown')}),
top AS (SELECT h AS root FROM crown WHERE n = 1),
steps AS (
  SELECT l.tree, l.pos AS leaf_pos, v.lvl, string_agg(v.h, '' ORDER BY v.pos) FILTER (v.pos < l.pos // CAST(pow(3, v.lvl) AS BIGINT)) AS lft,
    string_agg(v.h, '' ORDER BY v.pos) FILTER (v.pos > l.pos // CAST(pow(3, v.lvl) AS BIGINT)) AS rgt
  FROM leaves l JOIN nodes v ON v.tree = l.tree AND v.n > 1 AND v.pos // 3 = l.pos // CAST(pow(3, v.lvl + 1) AS BIGINT) GROUP BY ALL
  UNION ALL
  SELECT l.tree, l.pos, s.height + v.lvl, string_agg(v.h, '' ORDER BY v.pos) FILTER (v.pos < c.pos // CAST(pow(3, v.lvl) AS BIGINT)),
    string_agg(v.h, '' ORDER BY v.pos) FILTER (v.pos > c.pos // CAST(pow(3, v.lvl) AS BIGINT))
  FROM leaves l JOIN subroots s USING (tree) JOIN crown0 c USING (tree) JOIN crown v ON v.n > 1 AND v.pos // 3 = c.pos // CAST(pow(3, v.lvl + 1) AS BIGINT)
  GROUP BY l.tree, l.pos, s.height, v.lvl),
way AS (SELECT tree, leaf_pos AS pos, list({{'l': coalesce(lft, ''), 'r': coalesce(rgt, '')}} ORDER BY lvl) AS path FROM steps GROUP BY tree, leaf_pos),
told AS (SELECT l.*, coalesce(w.path, []) AS path FROM leaves l LEFT JOIN way w USING (tree, pos))
SELECT doc_id, leaf, subroot, root, sha256(array_to_string(list_transform(path, lambda x: x.l || x.r), '')) AS proof_sha256,
  list_reduce(list_concat([changed], list_transform(path, lambda x: x.l || ',' || x.r)),
    lambda node, x: sha256(split_part(x, ',', 1) || node || split_part(x, ',', 2))) AS folded_root,
  folded_root = root AS verified
FROM told JOIN subroots USING (tree), top"""
