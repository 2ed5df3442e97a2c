"""Merkle dataset manifest: tree blocks in van Emde Boas layout, proofs read back from them.

Leaves are digests of whole rows, ranked per part (a language, say). A part's binary tree
is cut into aligned subtrees of BLOCK_HEIGHT levels; each is one row of the manifest, its
digests stored in van Emde Boas order: a tree is split at half its height, the top half
first, then each bottom tree, and so on down, so any root-to-leaf path touches few
neighbouring runs. Nodes are found by address arithmetic alone (`veb_addresses`), both when
a block is built and when siblings are read. Block roots are the leaves of the next blocks,
until one node is left; the parts' roots form one more tree of the same kind.

Rows: null fields are `-` in a leaf; a null key sorts first, a null part is a part. Rows
with equal keys are ordered by their digests, equal rows stand side by side. An empty table
gives empty results. Other columns are not read.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass
from functools import lru_cache

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window as W, functions as F, types as T

from orebridge.llm.common import ship_code
from orebridge.operators.joins import broadcast_if_bounded, join_on
from orebridge.operators.ordering import running_total
from orebridge.session import reliable_checkpoint

# Levels of one block above its leaves; a block has at most 2 ** BLOCK_HEIGHT leaves.
BLOCK_HEIGHT = 6
DIGEST = 32
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")

PART, POS, SIZE, NODE = "__llm_part", "__llm_pos", "__llm_size", "__llm_node"
KEY, OTHER, BLOCK = "__llm_key", "__llm_other", "__llm_block"
ITEMS, LAYOUT, PATH, SUBROOT = "__llm_items", "__llm_layout", "__llm_path", "__llm_subroot"


# ---- digests
def encoded(value: Column) -> Column:
    """`-` for null, else the UTF-8 byte count, `:` and the value (integers decimal)."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def row_digest(*fields: Column) -> Column:
    return F.unhex(F.sha2(F.concat(*[encoded(f) for f in fields]), 256))


def _join_hash(run: list[str]) -> str:
    return hashlib.sha256("".join(run).encode()).hexdigest()


# ---- van Emde Boas addresses
def veb_address(levels: int, depth: int, index: int) -> int:
    """Slot of node `index` of `depth` (0: the root) in a complete binary tree of `levels`
    levels: the tree is cut at half its height, tops before bottoms, recursively."""
    base = 0
    while levels > 1:
        top = levels // 2
        if depth < top:
            levels = top
            continue
        depth, levels = depth - top, levels - top
        below = index >> depth                       # which bottom tree
        base += (1 << top) - 1 + below * ((1 << levels) - 1)
        index -= below << depth
    return base


@lru_cache(maxsize=None)
def veb_addresses(levels: int, depth: int) -> tuple[int, ...]:
    return tuple(veb_address(levels, depth, i) for i in range(1 << depth))


def block_height(size: int) -> int:
    """Height of a block in a level of `size` nodes of its part."""
    return min(BLOCK_HEIGHT, (size - 1).bit_length())


def build_layout(leaves: list[bytes], height: int) -> bytes:
    """The digests of one aligned subtree. Nodes missing at the right end are zero bytes; the
    last node of an odd level is hashed alone."""
    slots = bytearray(DIGEST * ((1 << height + 1) - 1))
    level = [leaf.hex() for leaf in leaves]
    for depth in range(height, -1, -1):
        for at, digest in zip(veb_addresses(height + 1, depth), level):
            slots[DIGEST * at:DIGEST * (at + 1)] = bytes.fromhex(digest)
        if depth:
            level = [_join_hash(level[i:i + 2]) for i in range(0, len(level), 2)]
    return bytes(slots)


def read_path(layout: bytes, height: int, n_leaves: int, index: int) -> list[str]:
    """Steps from leaf `index` to the block's root: `<` or `>` and the digest of the sibling
    to the left or right, or `-` for a node without one."""
    steps = []
    for depth in range(height, 0, -1):
        other = index ^ 1
        if other < n_leaves:
            at = DIGEST * veb_addresses(height + 1, depth)[other]
            steps.append((">" if other > index else "<") + layout[at:at + DIGEST].hex())
        else:
            steps.append("-")
        index, n_leaves = index >> 1, (n_leaves + 1) >> 1
    return steps


def fold_path(leaf: bytes, path: list[str]) -> str:
    """The root that a leaf's digest and its path lead to, as hex."""
    node = leaf.hex()
    for step in path:
        if step == "-":
            node = _join_hash([node])
        else:
            node = _join_hash([node, step[1:]] if step[0] == ">" else [step[1:], node])
    return node


# ---- manifest
@dataclass
class Tree:
    """Blocks of every level, leaves first: part, size (nodes of the part in that level),
    block number, items (the leaves: position, key, digest, other digest) and layout."""
    levels: list[DataFrame]

    def roots(self) -> DataFrame:
        """(part, node): the root of each part."""
        parts = [b.where(F.col(SIZE) <= 1 << BLOCK_HEIGHT).select(PART, _block_root().alias(NODE))
                 for b in self.levels]
        out = parts[0]
        for more in parts[1:]:
            out = out.unionByName(more)
        return out


@dataclass
class Manifest:
    """The stored trees: `parts` over the rows of each part, `top` over the parts' roots, and
    each part's position among them."""
    parts: Tree
    top: Tree
    order: DataFrame
    root: str | None


def _block_root() -> Column:
    return F.substring(F.col(LAYOUT), 1, DIGEST)     # the root is the first slot


def _layouts(batches):
    for batch in batches:
        sizes, items = batch.column(SIZE).to_pylist(), batch.column(ITEMS)
        layouts, at = [], 0
        digests = items.flatten().field(NODE).to_pylist()
        for size, count in zip(sizes, items.value_lengths().to_pylist()):
            layouts.append(build_layout(digests[at:at + count], block_height(size)))
            at += count
        yield batch.append_column(LAYOUT, pa.array(layouts, pa.binary()))


def _blocks(nodes: DataFrame) -> DataFrame:
    """Blocks of one level of nodes (part, size, pos, key, node, other); at most
    2 ** BLOCK_HEIGHT nodes meet in a group."""
    grouped = (nodes.withColumn(BLOCK, F.shiftright(F.col(POS), BLOCK_HEIGHT))
               .groupBy(PART, SIZE, BLOCK)
               .agg(F.sort_array(F.collect_list(F.struct(POS, KEY, NODE, OTHER))).alias(ITEMS)))
    schema = T.StructType([*grouped.schema.fields, T.StructField(LAYOUT, T.BinaryType())])
    return reliable_checkpoint(grouped.mapInArrow(_layouts, schema))


def build_tree(nodes: DataFrame) -> Tree:
    """All block levels over ranked nodes (part, size, pos, key, node, other)."""
    levels = [_blocks(nodes)]
    largest = levels[0].agg(F.max(SIZE)).first()[0] or 0
    while largest > 1 << BLOCK_HEIGHT:
        largest = (largest - 1 >> BLOCK_HEIGHT) + 1
        up = levels[-1].where(F.col(SIZE) > 1 << BLOCK_HEIGHT).select(
            PART, (F.shiftright(F.col(SIZE) - 1, BLOCK_HEIGHT) + 1).alias(SIZE), F.col(BLOCK).alias(POS),
            F.lit(None).cast("long").alias(KEY), _block_root().alias(NODE), F.lit(None).cast("binary").alias(OTHER))
        levels.append(_blocks(up))
    return Tree(levels)


def ranked_leaves(leaves: DataFrame) -> DataFrame:
    """Leaves (part, key, node, other) with their position in their part and the part's size.

    Sorted into ranges once; a row's number is its place in its range plus the rows of its
    part in the ranges before, from one count per range and part. Equal rows are told apart
    by their place in the input, so copies of one row spread over ranges too.
    """
    order = [F.col(c).asc_nulls_first() for c in (PART, KEY, NODE, "__llm_row")]
    ranged = reliable_checkpoint(
        leaves.withColumn("__llm_row", F.monotonically_increasing_id())
        .repartitionByRange(*order).sortWithinPartitions(*order)
        .select(PART, KEY, NODE, OTHER, F.spark_partition_id().alias("__llm_range"),
                F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)).alias("__llm_at")))
    counts = ranged.groupBy(PART, "__llm_range").agg(F.count(F.lit(1)).alias("n"), F.min("__llm_at").alias("first"))
    of_part = W.partitionBy(PART)
    earlier = F.sum("n").over(of_part.orderBy("__llm_range").rowsBetween(W.unboundedPreceding, -1))
    starts = counts.select(PART, "__llm_range", F.sum("n").over(of_part).alias(SIZE),
                           (F.coalesce(earlier, F.lit(0)) - F.col("first")).alias("__llm_start"))
    # one row per range and part in it: at most ranges + parts rows
    placed = join_on(ranged, broadcast_if_bounded(starts)[0], [PART, "__llm_range"], "inner", null_safe=True)
    return placed.select(PART, SIZE, (F.col("__llm_start") + F.col("__llm_at")).alias(POS), KEY, NODE, OTHER)


def build_manifest(leaves: DataFrame) -> Manifest:
    """The manifest over leaves (part, key, node, other)."""
    ship_code(leaves.sparkSession)
    parts = build_tree(ranked_leaves(leaves))
    order = reliable_checkpoint(running_total(parts.roots(), [PART], before=POS))
    top = build_tree(order.select(
        F.lit("").alias(PART), F.lit(order.count()).cast("long").alias(SIZE), POS,
        F.lit(None).cast("long").alias(KEY), NODE, F.lit(None).cast("binary").alias(OTHER)))
    found = top.roots().first()                      # one row of 32 bytes
    return Manifest(parts, top, order.select(PART, POS), found[NODE].hex() if found else None)


# ---- proofs
# Blocks read at a time: 4,096 paths in memory.
SLICE = 64


def _expand(batches):
    """One row per leaf of each block: its path through the block followed by the block's own,
    and the root that path leads to from `other`, or from the leaf where there is none."""
    for whole in batches:
        for start in range(0, whole.num_rows, SLICE):
            yield _expanded(whole.slice(start, SLICE))


def _expanded(batch: pa.RecordBatch) -> pa.RecordBatch:
    parts, sizes, layouts, subroots, above = (
        batch.column(n).to_pylist() for n in (PART, SIZE, LAYOUT, SUBROOT, PATH))
    items = batch.column(ITEMS)
    flat, counts = items.flatten(), items.value_lengths().to_pylist()
    checked = pc.coalesce(flat.field(OTHER), flat.field(NODE)).to_pylist()
    of, roots, paths = [], [], []
    for row, count in enumerate(counts):
        height = block_height(sizes[row])
        of += [row] * count
        paths += [read_path(layouts[row], height, count, i) + above[row] for i in range(count)]
    roots = [fold_path(leaf, path) for leaf, path in zip(checked, paths)]
    return pa.RecordBatch.from_arrays([
        pa.array([parts[r] for r in of], pa.string()), flat.field(POS), flat.field(KEY), flat.field(NODE),
        pa.array([subroots[r] for r in of], pa.binary()), pa.array(paths, pa.list_(pa.string())),
        pa.array(roots, pa.string())], names=[PART, POS, KEY, NODE, SUBROOT, PATH, "folded_root"])


_PATHS = (f"{PART} string, {POS} long, {KEY} long, {NODE} binary, {SUBROOT} binary, {PATH} array<string>, "
          "folded_root string")


def _paths(tree: Tree, top: DataFrame) -> DataFrame:
    """(part, pos, key, node, subroot, path to the end of `top`, root it leads to) for every
    leaf. `top` holds part, subroot and the path above the part's root. Blocks are read from
    the root down, so only block roots' paths are joined, never those of leaves."""
    below = None
    for blocks in reversed(tree.levels):
        joined = join_on(blocks.where(F.col(SIZE) <= 1 << BLOCK_HEIGHT), top, [PART], "inner", null_safe=True)
        if below is not None:
            above = below.select(PART, F.col(POS).alias(BLOCK), SUBROOT, PATH)
            joined = joined.unionByName(join_on(
                blocks.where(F.col(SIZE) > 1 << BLOCK_HEIGHT), above, [PART, BLOCK], "inner", null_safe=True))
        below = joined.mapInArrow(_expand, _PATHS)
    return below


def inclusion_proofs(manifest: Manifest) -> DataFrame:
    """One row per leaf: part, pos, key, node, subroot, path to the manifest's root, and
    folded_root: what the path makes of `other` (the digest a receiver computed of its copy
    of the row), or of the stored leaf where that is null."""
    ends = manifest.top.levels[-1].select(PART, F.lit(None).cast("binary").alias(SUBROOT),
                                          F.array().cast("array<string>").alias(PATH))
    upper = _paths(manifest.top, ends).select(POS, F.col(NODE).alias(SUBROOT), PATH)
    return _paths(manifest.parts, join_on(upper, manifest.order, [POS]).select(PART, SUBROOT, PATH))


def proof_digest(path: Column) -> Column:
    """SHA-256 of the siblings' digests (hex text) from the leaf's level to the root's."""
    return F.sha2(F.array_join(F.transform(F.filter(path, lambda s: s != "-"), lambda s: F.substring(s, 2, 64)), ""), 256)


def document_leaves(docs: DataFrame, other: dict[str, Column] | None = None, altered: Column | None = None) -> DataFrame:
    """Leaves of documents per lang. `other`: replaced fields of the copy that is checked, for
    the rows where `altered` holds."""
    fields = {f: F.col(f) for f in FIELDS}
    copy = row_digest(*(fields | (other or {})).values())
    checked = F.when(altered, copy) if other and altered is not None else F.lit(None)
    return docs.select(F.col("lang").cast("string").alias(PART), F.col("doc_id").cast("long").alias(KEY),
                       row_digest(*fields.values()).alias(NODE), checked.cast("binary").alias(OTHER))


def prove_documents(docs: DataFrame, other: dict[str, Column] | None = None, altered: Column | None = None) -> DataFrame:
    """Every document's leaf, proof and the outcome of its check: doc_id, leaf, subroot, root,
    path (array of steps), folded_root, verified."""
    manifest = build_manifest(document_leaves(docs, other, altered))
    root = F.lit(manifest.root).cast("string")
    return inclusion_proofs(manifest).select(
        F.col(KEY).alias("doc_id"), F.lower(F.hex(NODE)).alias("leaf"), F.lower(F.hex(SUBROOT)).alias("subroot"),
        root.alias("root"), F.col(PATH).alias("path"), "folded_root", (F.col("folded_root") == root).alias("verified"))
