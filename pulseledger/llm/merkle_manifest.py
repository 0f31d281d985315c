"""Merkle manifest of a table: leaf digests, subroots per group, proofs, tamper checks.

The tree is stored as parent-linked node rows. A row holds the siblings met on
``STRIDE`` binary levels, so that a link climbs that many levels at once. One
recursive query then ascends from every leaf: each step appends the siblings of
the row it reaches to the leaf's proof and folds the leaf's (maybe tampered)
digest with them, until a row without a parent, the root, is met.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulseledger.llm.common import numbered_within
from pulseledger.session import materialise

# Neighbouring nodes that meet in one row: 2 ** STRIDE.
STRIDE = 10
# The columns of a leaf, in the order in which they are hashed.
COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")
TAMPER_EVERY = 7
_ROW_LIMIT = "spark.sql.cteRecursionRowLimit"
# Number of the tree whose leaves are the subroots.
_TOP = -1

NODES = "tree long, place long, width long, digest binary, path array<binary>, start binary, up boolean"


def _encoded(value: Column) -> Column:
    text = value.cast("string")
    return F.when(text.isNull(), "-").otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def _hashed(values: Sequence[Column]) -> Column:
    return F.unhex(F.sha2(F.concat(*map(_encoded, values)), 256))


def _parent(left: bytes, right: bytes = b"") -> bytes:
    return hashlib.sha256((left.hex() + right.hex()).encode()).digest()


def _climbs(digests: list[bytes], levels: int) -> tuple[list[list[bytes]], bytes]:
    """Each digest's siblings on the way up so many levels, and what the levels end in.

    A sibling is one byte (0: it stands to the right, 1: to the left) and its
    digest; empty if there is none.
    """
    paths: list[list[bytes]] = [[] for _ in digests]
    for level in range(levels):
        for place, path in enumerate(paths):
            beside = (place >> level) ^ 1
            path.append(bytes([(place >> level) & 1]) + digests[beside] if beside < len(digests) else b"")
        digests = [_parent(*digests[n : n + 2]) for n in range(0, len(digests), 2)]
    return paths, digests[0]


def _one_stride(nodes: DataFrame, stride: int) -> DataFrame:
    """The given nodes with their paths, and (``up``) the nodes ``stride`` levels above them; stored.

    ``nodes``: tree, place, width (nodes of the tree on this level), digest, start
    and further columns, which stay with the nodes. A block of ``2 ** stride``
    neighbours meets in one row, however large its tree.
    """
    carried = [name for name in nodes.columns if name not in ("tree", "place", "width", "digest", "start")]
    block = F.shiftright("place", stride).alias("block")
    blocks = nodes.groupBy("tree", block).agg(
        F.first("width").alias("width"),
        F.array_sort(F.collect_list(F.struct("place", "digest", "start", *carried))).alias("members"),
    )
    types = dict(nodes.dtypes)
    schema = ", ".join([NODES, *(f"`{name}` {types[name]}" for name in carried)])
    rows = nodes.sparkSession.createDataFrame([], schema).schema
    names = [field.name for field in rows]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kinds = {"tree": pa.int64(), "place": pa.int64(), "width": pa.int64(), "digest": pa.binary()}
            kinds |= {"path": pa.list_(pa.binary()), "start": pa.binary(), "up": pa.bool_()}
            inner = batch.column("members").values.type
            kinds |= {name: inner.field(name).type for name in carried}
            for n in range(batch.num_rows):
                (row,) = batch.slice(n, 1).to_pylist()
                tree, block, width, members = row["tree"], row["block"], row["width"], row["members"]
                whole = width > 1 << stride
                levels = stride if whole else (width - 1).bit_length()
                paths, above = _climbs([m["digest"] for m in members], levels)
                found = [m | {"tree": tree, "width": width, "path": path, "up": False} for m, path in zip(members, paths)]
                over = {"tree": tree, "place": block, "digest": above, "up": True}
                found.append(dict.fromkeys(carried) | over | {"path": None, "start": None, "width": -(-width >> stride)})
                yield pa.RecordBatch.from_arrays([pa.array([f[name] for f in found], kinds[name]) for name in names], names)

    return materialise(blocks.mapInArrow(run, rows))


def _linked(nodes: DataFrame, level: int, stride: int) -> DataFrame:
    """Node rows with the link to the row above them; the tree of subroots ends without one."""
    wide, own = F.col("width") > 1 << stride, F.col("tree") != _TOP
    return nodes.where("not up").withColumns(
        {
            "level": F.lit(level),
            "up_tree": F.when(wide, F.col("tree")).when(own, F.lit(_TOP).cast("long")),
            "up_level": F.when(wide, level + 1).when(own, 0),
            "up_place": F.when(wide, F.shiftright("place", stride)).when(own, F.col("tree")),
        }
    )


def build_levels(leaves: DataFrame, stride: int = STRIDE) -> tuple[list[DataFrame], DataFrame]:
    """The linked rows of each level of all trees, and each tree's ``tree, root``.

    ``leaves``: tree, place, width, digest, start and what is to stay with them.
    """
    levels, ends, nodes = [], [], leaves
    while True:
        stored = _one_stride(nodes, stride)
        levels.append(_linked(stored, len(levels), stride))
        above = stored.where("up").select("tree", "place", "width", "digest", "start")
        ends.append(above.where("width = 1").select("tree", F.col("digest").alias("root")))
        nodes = above.where("width > 1")
        if nodes.isEmpty():
            break
    roots = ends[0]
    for more in ends[1:]:
        roots = roots.unionByName(more)
    return levels, roots


# What a step adds to a proof, and how it folds a digest.
_SIBLINGS = "aggregate({path}, {proof}, (got, e) -> concat(got, substring(e, 2, 32)))"
_FOLD = """aggregate({path}, {digest}, (got, e) -> unhex(sha2(CASE
    WHEN octet_length(e) = 0 THEN lower(hex(got))
    WHEN substring(e, 1, 1) = X'00' THEN lower(concat(hex(got), hex(substring(e, 2, 32))))
    ELSE lower(concat(hex(substring(e, 2, 32)), hex(got))) END, 256)))"""


def climb(leaves: DataFrame, upper: DataFrame, carried: Sequence[str]) -> DataFrame:
    """``carried``, ``proof`` and ``folded`` of every leaf row at the root; stored.

    One recursive query; its first member makes the first stride inside the leaf
    rows themselves, later ones join the rows above, of which each level has
    ``2 ** STRIDE`` times fewer.
    """
    spark = leaves.sparkSession
    kept = ", ".join(f"`{name}`" for name in carried)
    kept_c = ", ".join(f"c.`{name}`" for name in carried)
    text = f"""
        WITH RECURSIVE climb AS (
            SELECT {kept}, up_tree, up_level, up_place,
                   {_SIBLINGS.format(path="path", proof="X''")} AS proof,
                   {_FOLD.format(path="path", digest="start")} AS folded
            FROM {{leaves}}
            UNION ALL
            SELECT {kept_c}, n.up_tree, n.up_level, n.up_place,
                   {_SIBLINGS.format(path="n.path", proof="c.proof")},
                   {_FOLD.format(path="n.path", digest="c.folded")}
            FROM climb c JOIN {{upper}} n
              ON c.up_tree = n.tree AND c.up_level = n.level AND c.up_place = n.place)
        SELECT {kept}, proof, folded FROM climb WHERE up_tree IS NULL"""
    # The number of rows of a recursive query is limited by default, whatever its depth.
    before = spark.conf.get(_ROW_LIMIT)
    spark.conf.set(_ROW_LIMIT, "-1")
    try:
        return materialise(spark.sql(text, leaves=leaves, upper=upper))
    finally:
        spark.conf.set(_ROW_LIMIT, before)


def manifest(
    df: DataFrame,
    id_column: str = "doc_id",
    group: str = "lang",
    columns: Sequence[str] = COLUMNS,
    tampered: str = "n_chars",
    every: int = TAMPER_EVERY,
    stride: int = STRIDE,
) -> DataFrame:
    """``id, leaf, subroot, root, proof_sha256, folded_root, verified`` per row, digests as hex text.

    Leaves of one ``group`` (null is a group) ascend by id, nulls first; rows of
    one id by their digest. Where ``every`` divides the crc32 of an id, the leaf
    folded is that of the row with ``tampered`` one larger (a null or the largest
    long, which has no successor, counts as null there); rows without an id are
    never tampered. Equal rows are leaves of their own. A table of one row has
    its leaf as root and the digest of nothing as proof; an empty table gives
    none. Other columns are ignored. A group holding most rows is sorted and
    numbered over many tasks, and its blocks are rows like any others.
    """
    values = [F.col(name) for name in columns]
    changed = [F.expr(f"try_add(`{name}`, 1)") if name == tampered else F.col(name) for name in columns]
    touched = F.crc32(F.col(id_column).cast("string").cast("binary")) % every == 0
    rows = materialise(
        df.select(F.col(id_column).alias("id"), F.col(group).alias("lane"), _hashed(values).alias("digest"),
                  F.when(touched & F.col(tampered).isNotNull(), _hashed(changed)).alias("start"))
    )
    lanes = materialise(rows.groupBy("lane").agg(F.count(F.lit(1)).alias("width")))
    trees = materialise(
        numbered_within(lanes.withColumn("one", F.lit(1)), "one", ["lane"]).select("lane", "width", F.col("nth").alias("tree"))
    )
    placed = numbered_within(rows, "lane", ["id", "digest"])
    leaves = placed.join(trees.withColumnRenamed("lane", "of"), F.col("lane").eqNullSafe(F.col("of"))).select(
        "tree", F.col("nth").alias("place"), "width", "digest", F.coalesce("start", "digest").alias("start"), "id"
    )
    levels, subroots = build_levels(leaves, stride)
    tops = trees.join(subroots, "tree").select(
        F.lit(_TOP).cast("long").alias("tree"), F.col("tree").alias("place"), F.lit(trees.count()).cast("long").alias("width"),
        F.col("root").alias("digest"), F.lit(None).cast("binary").alias("start"),
    )
    over, roots = build_levels(tops, stride)
    links = ["tree", "level", "place", "path", "up_tree", "up_level", "up_place"]
    upper = over[0].select(*links)
    for level in [*levels[1:], *over[1:]]:
        upper = upper.unionByName(level.select(*links))
    ends = climb(levels[0], upper, ["id", "tree", "digest"])
    root = roots.select("root").scalar()
    told = ends.join(subroots.withColumnRenamed("root", "subroot"), "tree")
    text = lambda digest: F.lower(F.hex(digest))
    return told.select(
        F.col("id").alias(id_column),
        text("digest").alias("leaf"),
        text("subroot").alias("subroot"),
        text(root).alias("root"),
        F.sha2(text("proof"), 256).alias("proof_sha256"),
        text("folded").alias("folded_root"),
        (F.col("folded") == root).alias("verified"),
    )
