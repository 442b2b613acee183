r"""Merkle manifest of a dataset: a hash per row, a subroot per group, one root, and each row's proof by pointer jumping.

A leaf is the hash of a row's fields. Per group the leaves stand in order of the key; every three consecutive nodes (the last
run may have fewer) are hashed into one until one is left, the subroot. The subroots, in order of the group, are the leaves
of one more tree in the same way; what is left of it is the root.

Trees are built in passes of five levels: a pass brings up to 243 consecutive nodes together and gives each of them the
*segment* of siblings on its way to the node above them all, its ancestor. Then nodes jump: a self-join replaces each
node's ancestor with the ancestor's ancestor and appends the ancestor's segment, so that the distance doubles every round,
until all leaves have reached the root. A node far up is the ancestor of very many; how many is known (its leaves are
counted while the tree is built), and its row is copied so that no join key has more than about ``LEAVES_PER_KEY`` rows.

A segment is two columns: ``marks`` has two digits per level, the number of siblings to the left and to the right, and
``siblings`` has their digests, 32 bytes each, in order.

Null fields have a code of their own. A null group is the first group, null keys come first in their group, equal keys are
ordered by leaf; rows that are equal in all fields are leaves of their own and can stand for each other. An empty table has
no rows and no root. Columns that aren't fields are ignored.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallymark.llm.common import fold, materialize
from tallymark.llm.ordered import running_sums

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
ARITY = 3
# Levels that a pass builds, and so the distance of a node's first ancestor.
STEPS = 5
LEAVES_PER_KEY = 256
_TOP = -1


def leaf_hash(fields: Sequence[Column]) -> Column:
    """SHA-256 in lower-case hex of the fields, each as its length in bytes, a colon and its text, or ``-`` for null."""

    def code(field: Column) -> Column:
        text = field.cast("string")
        return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))

    return F.sha2(F.concat(*[code(field) for field in fields]).cast("binary"), 256)


def _depth(n: str) -> str:
    """Levels above ``n`` leaves."""
    return f"size(filter(array({', '.join(f'{ARITY**k}L' for k in range(40))}), p -> p < {n}))"


def _leaves(documents: DataFrame, fields: Sequence[str], key: str, group: str, carried: Mapping[str, Column]) -> DataFrame:
    """tree, n, depth, idx, hash, weight and row (key and carried columns) of every leaf; trees are numbered in order."""
    source = F.when(F.col(group).isNull(), F.lit("")).otherwise(F.concat(F.lit("="), F.col(group).cast("string")))
    row = F.struct(F.col(key).alias("key"), *[value.alias(name) for name, value in carried.items()])
    rows = documents.select(
        source.alias("source"), F.col(key).alias("key"), leaf_hash([F.col(f) for f in fields]).alias("hash"), row.alias("row")
    )
    # Equal rows are kept apart by the row number, so that they needn't share a range.
    rows = materialize(rows.withColumns({"nth": F.monotonically_increasing_id(), "weight": F.lit(1).cast("long")}))
    sources = rows.groupBy("source").agg(F.sum("weight").alias("n")).withColumns({"all": F.lit(0), "one": F.lit(1).cast("long")})
    everything = documents.sparkSession.createDataFrame([(0,)], "all int")
    trees = running_sums(sources, "all", ["source"], "one", "tree", everything).select("source", "tree", "n")
    placed = running_sums(rows, "source", ["key", "hash", "nth"], "weight", "idx", materialize(trees))
    return placed.select("tree", "n", F.expr(_depth("n")).alias("depth"), "idx", "hash", "weight", "row")


_LEVELS = f"""
aggregate(
  slice(sequence(1, {STEPS}), 1, steps),
  array(transform(kids, k -> k.hash)),
  (levels, q) -> array_append(levels, transform(
    sequence(0, (size(levels[q - 1]) + {ARITY - 1}) div {ARITY} - 1),
    j -> sha2(concat(levels[q - 1][j * 3], coalesce(get(levels[q - 1], j * 3 + 1), ''), coalesce(get(levels[q - 1], j * 3 + 2), '')), 256))))
"""
# Of a node's place p in level q - 1: how many siblings are left and right of it, and their digests.
_PLACE = f"cast(i div array({', '.join(str(ARITY**k) for k in range(STEPS))})[q - 1] AS INT)"
_MARK = f"concat(p % 3, least(3, size(levels[q - 1]) - p + p % 3) - p % 3 - 1)"
_SIBLINGS = "concat({})".format(
    ", ".join(f"CASE WHEN p % 3 <> {r} THEN coalesce(get(levels[q - 1], p - p % 3 + {r}), '') ELSE '' END" for r in range(ARITY))
)


def _along(what: str) -> str:
    """``what`` of every level that the pass builds, joined."""
    each = f"get(transform(array({_PLACE}), p -> {what}), 0)"
    return f"array_join(transform(slice(sequence(1, {STEPS}), 1, steps), q -> {each}), '')"


def _pass(nodes: DataFrame, level: int) -> DataFrame:
    """Up to 243 consecutive nodes of a tree as one row: what is above them, and their segments towards it."""
    kids = F.sort_array(F.collect_list(F.struct("idx", "hash", "weight", "row")))
    blocks = nodes.groupBy("tree", "n", "depth", F.expr(f"idx div {ARITY**STEPS}").alias("block")).agg(
        kids.alias("kids"), F.sum("weight").alias("weight")
    )
    steps = F.least(F.lit(STEPS), F.col("depth") - level)
    member = (
        "named_struct('idx', k.idx, 'hash', k.hash, 'weight', k.weight, 'row', k.row, "
        f"'marks', {_along(_MARK)}, 'siblings', unhex({_along(_SIBLINGS)}))"
    )
    blocks = blocks.withColumn("steps", steps).withColumn("levels", F.expr(_LEVELS))
    return materialize(
        blocks.select(
            "tree",
            "n",
            "depth",
            "block",
            "weight",
            F.lit(level).alias("level"),
            (F.lit(level) + F.col("steps")).alias("above"),
            F.expr("levels[steps][0]").alias("hash"),
            F.expr(f"transform(kids, (k, i) -> {member})").alias("members"),
        )
    )


def _built(nodes: DataFrame, depth: int) -> list[DataFrame]:
    """The passes over trees of at most ``depth`` levels."""
    passes = []
    for level in range(0, max(depth, 1), STEPS):
        passes.append(_pass(nodes, level))
        nodes = passes[-1].filter("above < depth").select(
            "tree", "n", "depth", F.col("block").alias("idx"), "hash", "weight", F.lit(None).cast(nodes.schema["row"].dataType).alias("row")
        )
    return passes


def _union(frames: Sequence[DataFrame]) -> DataFrame:
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame)
    return out


def _linked(blocks: DataFrame) -> DataFrame:
    """One row per node with its segment and the place of the ancestor that it leads to; the root's place is null."""
    ends = F.col("above") == F.col("depth")
    root = ends & (F.col("tree") == _TOP)
    up = F.when(root, F.lit(None)).when(
        ends, F.struct(F.lit(_TOP).cast("long").alias("tree"), F.lit(0).alias("level"), F.col("tree").alias("idx"), "weight")
    ).otherwise(F.struct("tree", F.col("above").alias("level"), F.col("block").alias("idx"), "weight"))
    each = blocks.select("tree", "level", up.alias("up"), F.explode("members").alias("m"))
    subroot = F.when((F.col("tree") == _TOP) & (F.col("level") == 0), F.col("m.hash"))
    return each.select("tree", "level", "up", "m.*", subroot.alias("subroot"))


def _jumped(nodes: DataFrame) -> DataFrame:
    """Nodes whose ancestor isn't the root yet, twice as far as before."""
    parts = f"CAST(ceil({{}} / {LEAVES_PER_KEY}) AS INT)"
    left = nodes.filter("up IS NOT NULL").withColumn(
        "part", F.pmod(F.xxhash64("tree", "level", "idx"), F.expr(parts.format("up.weight"))).cast("int")
    )
    targets = nodes.filter((F.col("level") > 0) | (F.col("tree") == _TOP)).select(
        F.col("tree").alias("t_tree"),
        F.col("level").alias("t_level"),
        F.col("idx").alias("t_idx"),
        F.explode(F.expr(f"sequence(0, {parts.format('weight')} - 1)")).alias("t_part"),
        F.col("up").alias("t_up"),
        F.col("marks").alias("t_marks"),
        F.col("siblings").alias("t_siblings"),
        F.col("subroot").alias("t_subroot"),
    )
    same = (
        (F.col("up.tree") == F.col("t_tree"))
        & (F.col("up.level") == F.col("t_level"))
        & (F.col("up.idx") == F.col("t_idx"))
        & (F.col("part") == F.col("t_part"))
    )
    return left.join(targets, same).select(
        "tree",
        "level",
        F.col("t_up").alias("up"),
        "idx",
        "hash",
        "weight",
        "row",
        F.concat("marks", "t_marks").alias("marks"),
        F.concat("siblings", "t_siblings").alias("siblings"),
        F.coalesce("subroot", "t_subroot").alias("subroot"),
    )


def proofs(
    documents: DataFrame,
    fields: Sequence[str] = FIELDS,
    key: str = "doc_id",
    group: str = "source",
    carried: Mapping[str, Column] | None = None,
) -> DataFrame:
    """One row per row of ``documents``: the key, leaf, subroot, root and the whole way up as ``marks`` and ``siblings``.

    ``carried`` are columns computed from a row that go along with its leaf.
    """
    leaves = materialize(_leaves(documents, fields, key, group, carried or {}))
    trees, depth = leaves.agg(F.countDistinct("tree"), F.max("depth")).first()
    passes = _built(leaves, depth or 0)
    subroots = _union([p.filter("above = depth") for p in passes]).select(
        F.lit(_TOP).cast("long").alias("tree"),
        F.lit(trees).cast("long").alias("n"),
        F.expr(_depth(f"{trees}L")).alias("depth"),
        F.col("tree").alias("idx"),
        "hash",
        "weight",
        F.lit(None).cast(leaves.schema["row"].dataType).alias("row"),
    )
    top = next(d for d in range(41) if ARITY**d >= max(trees, 1))
    passes += _built(subroots, top)
    last = passes[-1].select("hash").first()
    nodes = materialize(_union([_linked(p) for p in passes]))
    leaf = (F.col("level") == 0) & (F.col("tree") != _TOP)
    arrived = [nodes.filter(leaf & F.col("up").isNull())]
    while not nodes.filter(leaf & F.col("up").isNotNull()).isEmpty():
        # What has reached the root stays where it is; of it only what others can still point at takes part.
        nodes = materialize(_jumped(nodes).unionByName(nodes.filter(~leaf & F.col("up").isNull())))
        arrived.append(nodes.filter(leaf & F.col("up").isNull()))
    return _union(arrived).select(
        F.col("row.key").alias(key),
        F.col("hash").alias("leaf"),
        "subroot",
        F.lit(last.hash if last else None).cast("string").alias("root"),
        "marks",
        "siblings",
        *[F.col(f"row.{name}").alias(name) for name in carried or {}],
    )


def folded(leaf: Column, marks: str = "marks", siblings: str = "siblings") -> Column:
    """The root that follows from a leaf and the siblings on its way."""

    def digests(at: str, n: str) -> str:
        return f"lower(hex(substring({siblings}, {at} + 1, 32 * {n})))"

    left, right = f"cast(substring({marks}, 2 * i - 1, 1) AS INT)", f"cast(substring({marks}, 2 * i, 1) AS INT)"
    step = (
        f"(s, i) -> named_struct('h', sha2(concat({digests('s.at', left)}, s.h, {digests(f's.at + 32 * {left}', right)}), 256), "
        f"'at', s.at + 32 * ({left} + {right}))"
    )
    levels = f"CASE WHEN {marks} = '' THEN array() ELSE sequence(1, length({marks}) div 2) END"
    walked = f"leaf -> aggregate({levels}, named_struct('h', leaf, 'at', 0), {step}, s -> s.h)"
    return F.get(F.call_function("transform", F.array(leaf), F.expr(walked)), F.lit(0))


def proof_hash(siblings: str = "siblings") -> Column:
    """Hash of all siblings on the way, in hex."""
    return F.sha2(F.lower(F.hex(siblings)).cast("binary"), 256)


def audited(documents: DataFrame, key: str = "doc_id") -> DataFrame:
    """Proofs of all documents, checked against a copy in which every other document lost its line ends.

    Returns doc_id, leaf, subroot, root, proof_sha256, folded_root and verified. The copy differs where the crc32 of the id
    (null: empty text) is even; there the leaf of the altered row is folded with the siblings of the original.
    """
    altered = [F.replace(F.col(f), F.lit("\n"), F.lit("")) if f == "text" else F.col(f) for f in FIELDS]
    changed = (fold(key, 2) == 0) & F.contains(F.col("text"), F.lit("\n"))
    found = proofs(documents, key=key, carried={"altered": F.when(changed, leaf_hash(altered))})
    found = found.withColumn("folded_root", folded(F.coalesce("altered", "leaf")))
    return found.select(
        key, "leaf", "subroot", "root", proof_hash().alias("proof_sha256"), "folded_root", (F.col("folded_root") == F.col("root")).alias("verified")
    )
