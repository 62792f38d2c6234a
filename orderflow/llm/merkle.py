"""Merkle manifest of a table of documents, checked by a recursive climb (operator 12).

Every row is a leaf. The leaves of a language, by ``doc_id``, are the lowest nodes of a binary tree; the
roots of these trees, by language, are the lowest nodes of the top tree. An inner node is the
SHA-256 of its children's digests as text, also where the last node of a level has no partner.

1. Leaves are numbered in their tree over ranges of (language, id) and dealt in blocks of 256 neighbours.
2. A block folds eight levels. Each of its rows gets its path, the siblings up to the block's root, and a link to
   the row of that root, which is in a block of the next step. Steps are built until trees are single blocks.
   All steps are kept as tables of such parent-linked rows.
3. A recursive query starts with every leaf as it would be after tampering. A round joins the row above, appends
   its siblings to the proof and folds the digest over them. There is a round for every eight
   levels. A row is above many leaves, so it is stored once for each ``SPREAD`` of them, and a leaf
   takes the copy that its own number says.

A null language is a tree of its own, before all others; a null id comes before all ids. Rows that share an id
are leaves of their own, in order of their digests. An empty table gives no rows. Columns other than
the five of a leaf aren't read.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderflow.llm.positions import numbered
from orderflow.llm.tables import kept_table, small_side
from orderflow.session import settings

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
LEVELS = 8  # of a block
SPREAD = 4096
TOP = "*"  # The others are called '' and '=' with the language.

CLIMB = """
WITH RECURSIVE climb AS (
  SELECT * FROM {leaves}
  UNION ALL
  SELECT c.doc_id, c.leaf, c.number,
    aggregate(n.path, c.folded, (d, s) -> unhex(sha2(concat(
      if(s.left, lower(hex(s.digest)), ''), lower(hex(d)), if(s.left, '', coalesce(lower(hex(s.digest)), ''))), 256))),
    aggregate(n.path, c.proof, (p, s) -> concat(p, coalesce(s.digest, X''))),
    coalesce(c.subroot, n.subroot), n.up_tree, n.up_step, n.up_idx, n.up_copies
  FROM climb c JOIN {nodes} n
    ON c.up_tree = n.tree AND c.up_step = n.step AND c.up_idx = n.idx AND pmod(c.number, c.up_copies) = n.copy
)
SELECT doc_id, leaf, subroot, folded, proof FROM climb WHERE up_tree IS NULL
"""


def hexed(digest: Column) -> Column:
    return F.lower(F.hex(digest))


def field_digest(*fields: Column) -> Column:
    """SHA-256 of fields, each with its length in bytes before it; null is a dash."""
    texts = [x.cast("string") for x in fields]
    marked = [F.coalesce(F.concat(F.octet_length(x).cast("string"), F.lit(":"), x), F.lit("-")) for x in texts]
    return F.unhex(F.sha2(F.concat(*marked), 256))


def leaf_rows(docs: DataFrame, tampered: Column) -> DataFrame:
    """``tree``, ``doc_id``, the ``digest`` of each row, and the one after tampering if it differs."""
    after = [F.col(x) + 1 if x == "n_chars" else F.col(x) for x in FIELDS]
    return docs.select(
        F.coalesce(F.concat(F.lit("="), "lang"), F.lit("")).alias("tree"),
        F.col("doc_id").cast("long").alias("doc_id"),
        field_digest(*[F.col(x) for x in FIELDS]).alias("digest"),
        F.when(tampered & F.col("n_chars").isNotNull(), field_digest(*after)).alias("tampered"),
        F.lit(1).cast("long").alias("leaves"),
    )


def parents(level: Column) -> Column:
    """Digests of the level above: of every two, or of the last one alone."""

    def parent(k: Column) -> Column:
        right = F.coalesce(hexed(F.get(level, 2 * k + 1)), F.lit(""))
        return F.unhex(F.sha2(F.concat(hexed(F.get(level, 2 * k)), right), 256))

    return F.transform(F.sequence(F.lit(0), F.shiftright(F.size(level) + 1, 1) - 1), parent)


def node_rows(rows: DataFrame) -> DataFrame:
    """The rows of a step with their ``path`` to the root of their block of 256.

    rows: ``tree``, ``idx``, ``n`` (rows that the whole tree has in this step), ``digest``, ``leaves`` below, ``doc_id``,
    ``tampered``. Added are ``block``, ``block_root`` and ``block_leaves``. A block that is all that a tree
    has in this step ends at the tree's root.
    """
    names = ("idx", "digest", "leaves", "doc_id", "tampered")
    # A block has 256 rows at most.
    block = rows.groupBy("tree", F.shiftright("idx", LEVELS).alias("block")).agg(
        F.max("n").alias("n"), F.sum("leaves").alias("block_leaves"), F.sort_array(F.collect_list(F.struct(*names))).alias("held")
    )
    height = F.when(F.col("n") > 1 << LEVELS, LEVELS).otherwise(F.ceil(F.log2(F.col("n"))).cast("int"))
    levels = F.aggregate(
        F.sequence(F.lit(0), height),
        F.array("held.digest"),
        lambda below, k: F.when(k == 0, below).otherwise(F.concat(below, F.array(parents(F.element_at(below, -1))))),
    )
    block = block.withColumn("height", height).withColumn("levels", levels)

    def path(place: Column) -> Column:
        def sibling(level: Column, k: Column) -> Column:
            at = F.call_function("shiftright", place, k)
            left = at % 2 == 1
            return F.struct(left.alias("left"), F.get(level, F.when(left, at - 1).otherwise(at + 1)).alias("digest"))

        return F.transform(F.slice("levels", F.lit(1), F.col("height")), sibling)

    with_paths = F.transform(
        "held", lambda row, place: F.struct(*[row[x].alias(x) for x in names], path(place).alias("path"))
    )
    root = F.get(F.element_at("levels", -1), F.lit(0))
    return block.select("tree", "block", "n", root.alias("block_root"), "block_leaves", F.inline(with_paths))


def block_roots(step: DataFrame, whole_tree: bool) -> DataFrame:
    """A row for each block of a step that is, or isn't, a whole tree."""
    whole = F.col("n") <= 1 << LEVELS
    first = F.col("idx") == F.shiftleft("block", LEVELS)
    return step.where(first & (whole if whole_tree else ~whole))


def build(rows: DataFrame) -> list[DataFrame]:
    """The node rows of each step, up to the one in which every tree is a single block."""
    steps = [kept_table(node_rows(rows), "nodes")]
    while not (below := block_roots(steps[-1], whole_tree=False)).isEmpty():
        upper = below.select(
            "tree",
            F.col("block").alias("idx"),
            F.shiftright(F.col("n") + (1 << LEVELS) - 1, LEVELS).alias("n"),
            F.col("block_root").alias("digest"),
            F.col("block_leaves").alias("leaves"),
            F.lit(None).cast("long").alias("doc_id"),
            F.lit(None).cast("binary").alias("tampered"),
        )
        steps.append(kept_table(node_rows(upper), "nodes"))
    return steps


def roots(steps: list[DataFrame]) -> DataFrame:
    """``tree``, ``root`` and number of ``leaves`` of all trees."""
    done = [
        block_roots(step, whole_tree=True).select("tree", F.col("block_root").alias("root"), F.col("block_leaves").alias("leaves"))
        for step in steps
    ]
    return reduce(DataFrame.unionByName, done)


def linked(steps: list[DataFrame], above: DataFrame | None = None) -> list[DataFrame]:
    """Node rows of each step with the place (``up_tree``, ``up_step``, ``up_idx``) of their block's root, null above all.

    above: for roots of trees the place in the top tree, ``tree`` and ``place``.
    """
    out = []
    for step, rows in enumerate(steps):
        rows = rows.withColumn("place", F.lit(None).cast("long")) if above is None else rows.join(above, "tree")
        inside = F.col("n") > 1 << LEVELS
        known = inside | F.col("place").isNotNull()
        out.append(
            rows.select(
                "tree", F.lit(step).alias("step"), "idx", "digest", "leaves", "doc_id", "tampered", "path",
                F.when(inside, F.col("tree")).when(known, F.lit(TOP)).alias("up_tree"),
                F.when(inside, F.lit(step + 1)).when(known, F.lit(0)).alias("up_step"),
                F.when(inside, F.col("block")).when(known, F.col("place")).alias("up_idx"),
                copies(F.col("block_leaves")).alias("up_copies"),
            )
        )
    return out


def copies(leaves: Column) -> Column:
    return F.ceil(leaves / SPREAD)


def merkle_manifest(docs: DataFrame, tampered: Column) -> DataFrame:
    """One row per document: ``doc_id``, ``leaf``, ``subroot``, ``root``, ``proof`` (siblings from the leaf to the root, as
    one text), ``folded_root`` and ``verified``, after tampering with ``n_chars`` where ``tampered`` says so.
    """
    spark = docs.sparkSession
    steps = build(numbered(leaf_rows(docs, tampered), "tree", "doc_id", "digest"))
    tops = roots(steps).select(
        F.lit(TOP).alias("tree"), F.col("tree").alias("below"), F.col("root").alias("digest"), "leaves",
        F.lit(None).cast("long").alias("doc_id"), F.lit(None).cast("binary").alias("tampered"),
    )
    tops = kept_table(numbered(tops, "tree", "below"), "roots")
    top_steps = build(tops)
    place = small_side(kept_table(tops.select(F.col("below").alias("tree"), F.col("idx").alias("place")), "places"))
    low, high = linked(steps, place), linked(top_steps)
    above_leaves = reduce(DataFrame.unionByName, [*low[1:], *high]).select(
        "tree", "step", "idx", F.explode(F.sequence(F.lit(0).cast("long"), copies(F.col("leaves")) - 1)).alias("copy"), "path",
        F.when((F.col("tree") == TOP) & (F.col("step") == 0), F.col("digest")).alias("subroot"),
        "up_tree", "up_step", "up_idx", "up_copies",
    )
    nodes = kept_table(above_leaves, "linked")
    empty = F.lit("").cast("binary")
    leaves = low[0].select(
        "doc_id",
        F.col("digest").alias("leaf"),
        F.col("idx").alias("number"),
        F.aggregate("path", F.coalesce("tampered", "digest"), folded).alias("folded"),
        F.aggregate("path", empty, lambda proof, s: F.concat(proof, F.coalesce(s["digest"], empty))).alias("proof"),
        F.lit(None).cast("binary").alias("subroot"),
        "up_tree", "up_step", "up_idx", "up_copies",
    )
    root = roots(top_steps).first()
    # A query without these limits, so written here and not by the caller.
    with settings(spark, {"spark.sql.cteRecursionRowLimit": "-1", "spark.sql.cteRecursionLevelLimit": "-1"}):
        climbed = kept_table(spark.sql(CLIMB, leaves=leaves, nodes=nodes), "climbed")
    root = F.lit(bytes(root["root"]) if root else None).cast("binary")
    return climbed.select(
        "doc_id",
        hexed(F.col("leaf")).alias("leaf"),
        hexed(F.col("subroot")).alias("subroot"),
        hexed(root).alias("root"),
        hexed(F.col("proof")).alias("proof"),
        hexed(F.col("folded")).alias("folded_root"),
        (F.col("folded") == root).alias("verified"),
    )


def folded(digest: Column, sibling: Column) -> Column:
    """The digest of the parent; a sibling without a digest is none."""
    own, other = hexed(digest), F.coalesce(hexed(sibling["digest"]), F.lit(""))
    pair = F.when(sibling["left"], F.concat(other, own)).otherwise(F.concat(own, other))
    return F.unhex(F.sha2(pair, 256))
