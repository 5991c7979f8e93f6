"""Merkle manifest of a table: a tree of digests per source, a tree of their roots, and a proof for every row.

A leaf is the digest of a row's fields. Leaves ascend by id inside their source; every 16 consecutive ones become a node, until
one node is left, the subroot; subroots ascend by source and become the root in the same way. Each level built is stored as rows linked
to their parents. A recursive query climbs from the leaves: at every node it appends the siblings met there to the proof and
folds the digest computed so far into the node's, until no parent is left.

The rows that climb are the leaves of one node of the second level, up to 256: they share all siblings above it, so the proof is
carried once for such a group while every leaf folds a digest of its own. Upper nodes are joined by very many groups (a source may
hold a third of all rows); such a node is stored in as many copies as it has hundreds of groups below it, dealt out by a hash of the group.
Places inside a source come from a range partitioning by (source, id), counted per partition and added up, not from a
window over a source.

Digests are hexadecimal text wherever they are hashed, and 32 bytes in between.

Defined results: null fields count as ``-``; a null source is a source of its own and comes first; null ids come first in their
source; rows with equal ids ascend by leaf, and repeated rows are leaves of their own; a row without siblings has the digest of the empty text as
its proof; an empty table has no rows; extra columns are ignored unless named as fields.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spanlake.llm.common import discard, prepare, staged

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")

# Fixed value: digests that form a node.
FAN = 16

# groups that join one stored copy of a node
GROUPS_PER_COPY = 256

# key of the tree of subroots; those of sources are empty (no source) or begin with an s
TOP = "top"


def leaf_of(values: Mapping[str, Column]) -> Column:
    """Digest, as hexadecimal text, of a row's fields in the order given."""

    def counted(value: Column) -> Column:
        shown = value.cast("string")
        return F.coalesce(F.concat(F.octet_length(shown).cast("string"), F.lit(":"), shown), F.lit("-"))

    return F.sha2(F.concat(*(counted(v) for v in values.values())), 256)


def _hex(binary: Column) -> Column:
    return F.lower(F.hex(binary))


def _digest(run: str) -> str:
    """SQL of the digest of the node over the digests in ``run``."""
    return f"unhex(sha2(lower(hex({run})), 256))"


def _others(run: str, place: str) -> str:
    """SQL of the digests of ``run`` without the one at ``place``."""
    return f"concat(substring({run}, 1, 32 * {place}), substring({run}, 32 * {place} + 33))"


def _folded(run: str, place: str, digest: str) -> str:
    """SQL of the node's digest with another one at ``place``."""
    return _digest(f"concat(substring({run}, 1, 32 * {place}), {digest}, substring({run}, 32 * {place} + 33))")


def numbered(rows: DataFrame, group: str, *order: str) -> DataFrame:
    """The rows with ``place``, from 0 in the order given inside their group, and ``n``, the group's size. No group may be null."""
    keys = [group, *order]
    # partition and position in it, in one number
    placed = rows.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn("row", F.monotonically_increasing_id())
    placed = staged(placed.withColumn("part", F.shiftright("row", 33)), "sorted")
    runs = placed.groupBy(group, "part").agg(F.min("row").alias("first"), F.count("*").alias("m"))
    of_group = Window.partitionBy(group)
    earlier = of_group.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.withColumns({"earlier": F.coalesce(F.sum("m").over(earlier), F.lit(0)), "n": F.sum("m").over(of_group)})
    found = placed.join(runs, [group, "part"]).withColumn("place", F.col("earlier") + F.col("row") - F.col("first"))
    return found.select(*rows.columns, "place", "n")


def _gathered(members: Column) -> Column:
    """Digests of the members one after the other."""
    return F.aggregate(members["digest"], F.expr("X''"), lambda run, digest: F.concat(run, digest))


def _levels(below: DataFrame, level: int) -> list[DataFrame]:
    """All levels above rows of (tree, place, n, digest, groups), as tables; n counts the rows of the tree's level."""
    largest, levels = below.agg(F.max("n")).first()[0] or 0, []
    while largest > 1:
        members = F.sort_array(F.collect_list(F.struct("place", "digest")))
        nodes = below.where("n > 1").groupBy("tree", F.expr(f"place div {FAN}").alias("place")).agg(
            _gathered(members).alias("run"),
            F.expr(f"(max(n) + {FAN - 1}) div {FAN}").alias("n"),
            F.sum("groups").alias("groups"),
        )
        level += 1
        nodes = nodes.select("tree", F.lit(level).alias("level"), "place", "n", "run", F.expr(_digest("run")).alias("digest"), "groups")
        levels.append(below := staged(nodes, "nodes"))
        largest = -(-largest // FAN)
    return levels


@dataclass
class Manifest:
    """The trees of a table, as stored tables.

    ``groups``: the nodes of the second level, with a part for each node below: its ``run`` of leaves, their ``ids``, and the
    ``folds``, each leaf's digest folded up to this level. ``nodes``: all nodes above. Both have the node's key (tree, level,
    place), its ``run``, the digests below it, its ``digest`` and the link to the parent: its key, the position in its run and
    the number of its copies; the root has none. A digest alone in its tree stands for the nodes above it.
    ``subroots``: the last digest of each source's tree, in order.
    """

    groups: DataFrame
    nodes: DataFrame
    subroots: DataFrame


def _linked(rows: DataFrame, subroots: DataFrame, sizes: DataFrame) -> DataFrame:
    """The rows with the link to their parent."""
    up = ["up_tree string", "up_level int", "up_place bigint", "up_pos int"]
    inner = ["tree", "level + 1", f"place div {FAN}", f"CAST(place % {FAN} AS INT)"]
    above = [f"'{TOP}'", "1", f"rank div {FAN}", f"CAST(rank % {FAN} AS INT)"]

    def with_link(part: DataFrame, link: list[str]) -> DataFrame:
        named = (F.expr(value).cast(u.split()[1]).alias(u.split()[0]) for value, u in zip(link, up))
        return part.select(*rows.columns, *named)

    ranks = subroots.select("tree", F.col("place").alias("rank"), F.col("n").alias("all"))
    heads = rows.where(f"n = 1 AND tree <> '{TOP}'").join(ranks, "tree")
    found = with_link(rows.where("n > 1"), inner)
    found = found.unionByName(with_link(heads.where("all > 1"), above))
    found = found.unionByName(with_link(heads.where("all = 1").unionByName(rows.where(f"n = 1 AND tree = '{TOP}'"), True), ["NULL"] * 4))
    parents = sizes.select(
        F.col("tree").alias("up_tree"), F.col("level").alias("up_level"), F.col("place").alias("up_place"), "copies"
    )
    return found.join(parents.withColumnRenamed("copies", "up_copies"), ["up_tree", "up_level", "up_place"], "left")


def build(
    docs: DataFrame,
    changed: Mapping[str, Column] | None = None,
    where: Column | None = None,
    fields: Sequence[str] = FIELDS,
    id: str = "doc_id",
    source: str = "source",
) -> Manifest:
    """The manifest of the rows; leaves climb with the fields in ``changed`` put in place where ``where`` holds."""
    prepare(docs.sparkSession)
    given = {name: docs[name] for name in fields}
    leaves = docs.select(
        docs[id].alias("id"),
        F.coalesce(F.concat(F.lit("s"), docs[source]), F.lit("")).alias("tree"),
        F.unhex(leaf_of(given)).alias("digest"),
        F.when(F.lit(False) if where is None else where, F.unhex(leaf_of(given | dict(changed or {})))).alias("start"),
    )
    leaves = staged(leaves, "leaves")
    rows = numbered(leaves, "tree", "id", "digest")
    members = F.sort_array(F.collect_list(F.struct("place", "digest", "id", "start")))
    lowest = rows.groupBy("tree", F.expr(f"place div {FAN}").alias("place")).agg(members.alias("members"), F.max("n").alias("leaves"))
    lowest = lowest.withColumn("run", _gathered(F.col("members")))
    start = "coalesce(m.start, m.digest)"
    lowest = lowest.select(
        "tree",
        "place",
        "leaves",
        F.expr("IF(leaves = 1, run, %s)" % _digest("run")).alias("digest"),
        "run",
        F.col("members.id").alias("ids"),
        F.expr(f"transform(members, (m, i) -> IF(leaves = 1, {start}, {_folded('run', 'i', start)}))").alias("folds"),
    )
    parts = F.sort_array(F.collect_list(F.struct("place", "digest", "run", "ids", "folds")))
    groups = lowest.groupBy("tree", F.expr(f"place div {FAN}").alias("place")).agg(
        parts.alias("parts"), F.expr(f"(max(leaves) + {FAN - 1}) div {FAN}").alias("m")
    )
    groups = groups.withColumn("run", _gathered(F.col("parts")))
    folds = f"IF(m = 1, p.folds, transform(p.folds, f -> {_folded('run', 'j', 'f')}))"
    groups = groups.select(
        "tree",
        F.lit(2).alias("level"),
        "place",
        F.expr(f"(m + {FAN - 1}) div {FAN}").alias("n"),
        F.expr(f"transform(parts, (p, j) -> struct(p.run AS run, p.ids AS ids, {folds} AS folds))").alias("parts"),
        "run",
        F.expr("IF(m = 1, run, %s)" % _digest("run")).alias("digest"),
        F.lit(1).cast("bigint").alias("groups"),
    )
    groups = staged(groups, "groups")
    discard(rows)
    discard(leaves)

    def united(tables: list[DataFrame], *columns: str) -> DataFrame:
        return reduce(DataFrame.unionByName, (t.select(*columns) for t in tables))

    inner = _levels(groups, 2)
    heads = united([groups, *inner], "tree", "n", "digest", "groups").where("n = 1").drop("n")
    ranked = numbered(heads.withColumn("all", F.lit(TOP)), "all", "tree")
    subroots = staged(ranked.select("tree", "place", "n", "digest", "groups"), "subroots")
    upper = _levels(subroots.withColumn("tree", F.lit(TOP)), 0)
    if not inner and not upper:
        upper = [groups.where("false")]
    nodes = united([*inner, *upper], "tree", "level", "place", "n", "run", "digest", "groups")
    copies = F.expr(f"(groups + {GROUPS_PER_COPY - 1}) div {GROUPS_PER_COPY}").alias("copies")
    sizes = nodes.select("tree", "level", "place", copies)
    stored = _linked(nodes.select("*", copies), subroots, sizes)
    return Manifest(
        staged(_linked(groups, subroots, sizes), "linked-groups"),
        staged(stored.withColumn("copy", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("copies") - 1))), "linked-nodes"),
        subroots,
    )


def climb(manifest: Manifest) -> DataFrame:
    """(id, leaf, subroot, root, proof_sha256, folded_root, verified) of every row, by a recursive query over the stored levels."""
    spark = manifest.groups.sparkSession
    # the recursion adds a row per group and level: rows are not bounded
    spark.conf.set("spark.sql.cteRecursionRowLimit", "-1")
    climbed = spark.sql(
        f"""
        WITH RECURSIVE climb AS (
          SELECT tree, place, xxhash64(tree, place) AS seed, parts.folds AS folds, X'' AS proof,
                 IF(n = 1, digest, NULL) AS subroot, digest AS reached, up_tree, up_level, up_place, up_pos, up_copies
          FROM {{groups}}
          UNION ALL
          SELECT c.tree, c.place, c.seed,
                 transform(c.folds, part -> transform(part, f -> {_folded("p.run", "c.up_pos", "f")})),
                 concat(c.proof, {_others("p.run", "c.up_pos")}),
                 coalesce(c.subroot, IF(p.n = 1, p.digest, NULL)), p.digest,
                 p.up_tree, p.up_level, p.up_place, p.up_pos, p.up_copies
          FROM climb c JOIN {{nodes}} p
            ON c.up_tree = p.tree AND c.up_level = p.level AND c.up_place = p.place AND pmod(c.seed, c.up_copies) = p.copy
        )
        SELECT tree, place, folds, proof, subroot, reached FROM climb WHERE up_tree IS NULL
        """,
        groups=manifest.groups,
        nodes=manifest.nodes,
    )
    climbed = staged(climbed, "climbed")
    own = manifest.groups.select("tree", "place", "run", F.posexplode("parts").alias("j", "part"))
    met = own.join(climbed, ["tree", "place"]).select("*", F.posexplode("part.ids").alias("i", "id"))
    siblings = f"concat({_others('part.run', 'i')}, {_others('run', 'j')}, proof)"
    folded, root = _hex(F.expr("folds[j][i]")), _hex(F.col("reached"))
    return met.select(
        "id",
        _hex(F.expr("substring(part.run, 32 * i + 1, 32)")).alias("leaf"),
        _hex(F.col("subroot")).alias("subroot"),
        root.alias("root"),
        F.sha2(_hex(F.expr(siblings)), 256).alias("proof_sha256"),
        folded.alias("folded_root"),
        (folded == root).alias("verified"),
    )
