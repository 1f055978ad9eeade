"""Merkle manifest of a dataset, with an inclusion proof for every row, found by pointer jumping.

A row's leaf is the SHA-256 of its fields with their lengths. The leaves of a language, by ``doc_id`` (null
first; equal ids by their leaf), are hashed in runs of two up to the language's subroot; the subroots, by
language (null first, bytewise), are hashed likewise up to the root.

Trees are built in blocks of 256 neighbours, eight levels at a time, so no task holds a language. Every node
then knows its parent and the sibling on the way there. To find the proofs, each round joins the nodes with
themselves at their present ancestor: the ancestor's distance doubles and the two segments of siblings are
put together, until every leaf has reached the root. After a round only nodes at multiples of the new
distance are still needed as ancestors, so the joined side shrinks to a fraction of the leaves; a segment
ends in as many siblings as the tree has levels.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.numbering import numbered
from ..session import lookup_join, written
from .common import arrow_map

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
# Neighbours that one block hashes, and the levels this makes.
SPAN, SPAN_LEVELS = 256, 8
# The tree of the subroots; the languages' trees are numbered from 0.
_TOP = -1
# A segment is a row of steps: where the sibling stands, and its 32 bytes.
_STEP = 33
_ALONE, _ON_LEFT, _ON_RIGHT = b"-", b"L", b"R"
_NODE = ["tree", "level", "idx"]


def leaf_of(**changed: Column) -> Column:
    """The leaf of a row; ``changed`` replaces columns. Null fields are ``-``, others their byte count, ``:`` and value."""
    parts = []
    for name in FIELDS:
        value = changed.get(name, F.col(name)).cast("string")
        sized = F.concat(F.octet_length(value).cast("string"), F.lit(":"), value)
        parts.append(F.coalesce(sized, F.lit("-")))
    return F.sha2(F.concat(*parts), 256)


def is_tampered() -> Column:
    """Rows whose ``n_chars`` the manifest's test raises by one: 7 divides the CRC-32 of the id. Null ids are left alone."""
    return F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(7)) == 0, F.lit(False))


def leaves(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``lang``, ``leaf`` and ``shown``, the leaf as it is presented for checking (tampered or not)."""
    longer = leaf_of(n_chars=F.col("n_chars").cast("decimal(38,0)") + 1)
    rows = docs.select(*FIELDS).select("doc_id", "lang", leaf_of().alias("leaf"), longer.alias("longer"), is_tampered().alias("is_t"))
    shown = F.when(F.col("is_t"), F.col("longer")).otherwise(F.col("leaf"))
    return rows.select("doc_id", "lang", "leaf", shown.alias("shown"))


def _levels(size: Column) -> Column:
    """Levels above the leaves of a tree: the times ``size`` nodes are halved until one remains."""
    return F.when(size > 1, F.length(F.bin(size - 1))).otherwise(0).cast("int")


def _placed(rows: DataFrame) -> DataFrame:
    """Leaves with ``tree`` (the number of the language), ``idx`` in it and its size ``n``, written once."""
    # Null, then the languages bytewise; the empty language is not null.
    key = F.coalesce(F.concat(F.lit("="), F.col("lang")), F.lit(""))
    order = [F.asc("key"), F.asc_nulls_first("doc_id"), F.asc("leaf")]
    ordered = written(numbered(written(rows.withColumn("key", key), "leaves"), order, "place"), "placed")
    sizes = ordered.groupBy("key").agg(F.count("*").alias("n"), F.min("place").alias("first"))
    trees = numbered(sizes, [F.asc("key")], "tree").withColumn("tree", F.col("tree") - 1)
    joined = lookup_join(ordered, trees, ["key"], "inner")
    return written(
        joined.select("doc_id", "leaf", "shown", "tree", (F.col("place") - F.col("first")).alias("idx"), "n"), "indexed"
    )


def _digest(*parts: str) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def _hash_block(tree: int, block: int, n: int, own: list[str]) -> Iterator[tuple]:
    """Nodes of a block above its nodes ``own``: (tree, level from here, idx, n, step to the parent or None, digest or None).

    A node with a step has its parent in this block; one with a digest is the block's last.
    """
    first, level = block * SPAN, 0
    while n > 1 and level < SPAN_LEVELS:
        above = []
        for i in range(0, len(own), 2):
            pair = own[i : i + 2]
            if len(pair) == 1:
                yield tree, level, first + i, n, _ALONE + bytes(32), None
            else:
                yield tree, level, first + i, n, _ON_RIGHT + bytes.fromhex(pair[1]), None
                yield tree, level, first + i + 1, n, _ON_LEFT + bytes.fromhex(pair[0]), None
            above.append(_digest(*pair))
        own, first, n, level = above, first // 2, (n + 1) // 2, level + 1
    for i, digest in enumerate(own):
        yield tree, level, first + i, n, None, digest


_HASHED = "tree long, level int, idx long, n long, step binary, digest string"


def _hash_blocks(nodes: DataFrame) -> DataFrame:
    """Up to eight levels above ``nodes`` (``tree``, ``idx``, ``n``, ``digest``)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [c.split()[0] for c in _HASHED.split(", ")]
        kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.binary(), pa.string()]
        for batch in batches:
            found = []
            for row in batch.to_pylist():
                found += _hash_block(row["tree"], row["block"], row["n"], [d["digest"] for d in row["own"]])
            columns = list(zip(*found, strict=True)) if found else [[]] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)

    own = F.sort_array(F.collect_list(F.struct("idx", "digest"))).alias("own")  # SPAN at most
    blocks = nodes.groupBy("tree", F.expr(f"idx div {SPAN}").alias("block"), "n").agg(own)
    return arrow_map(blocks, run, _HASHED)


def _build(nodes: DataFrame) -> tuple[list[DataFrame], DataFrame]:
    """All nodes below a root with their step to the parent, and the roots (``tree``, ``digest``)."""
    spark = nodes.sparkSession
    steps, roots = [], [nodes.filter("n = 1").select("tree", "digest")]
    base, current = 0, nodes.filter("n > 1")
    size = nodes.agg(F.max("n")).first()[0] or 0
    while size > 1:
        found = written(_hash_blocks(current), "tree")
        steps.append(found.filter("step is not null").select("tree", (F.col("level") + base).alias("level"), "idx", "step"))
        tops = found.filter("step is null")
        roots.append(tops.filter("n = 1").select("tree", "digest"))
        current = tops.filter("n > 1").select("tree", "idx", "n", "digest")
        base, size = base + SPAN_LEVELS, -(-size // SPAN)
    if not steps:
        steps = [spark.createDataFrame([], "tree long, level int, idx long, step binary")]
    found = roots[0]
    for more in roots[1:]:
        found = found.unionByName(more)
    return steps, found


def _union(frames: list[DataFrame]) -> DataFrame:
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame)
    return out


def _with_parent(steps: DataFrame) -> DataFrame:
    """Nodes (``tree``, ``level``, ``idx``) with their ancestor one level up and the segment to it."""
    return steps.select(
        *_NODE,
        F.col("tree").alias("up_tree"),
        (F.col("level") + 1).alias("up_level"),
        F.expr("idx div 2").alias("up_idx"),
        F.col("step").alias("segment"),
    )


def _jumped(nodes: DataFrame, distance: int) -> DataFrame:
    """Doubles ``distance`` between nodes and their ancestors; a null ancestor is the root, reached.

    Nodes that later rounds do not meet are left out: in a language's tree those off the doubled distance.
    """
    needed = (F.col("tree") == _TOP) | (F.col("level") % (2 * distance) == 0)
    going = nodes.filter(needed).filter("up_tree is not null")
    arrived = nodes.filter(needed).filter("up_tree is null")
    # A leaf is nobody's ancestor, and the root has no row: a node whose ancestor has none has arrived.
    ancestors = nodes.filter((F.col("level") > 0) | (F.col("tree") == _TOP)).select(
        F.col("tree").alias("up_tree"),
        F.col("level").alias("up_level"),
        F.col("idx").alias("up_idx"),
        F.col("up_tree").alias("next_tree"),
        F.col("up_level").alias("next_level"),
        F.col("up_idx").alias("next_idx"),
        F.col("segment").alias("more"),
    )
    joined = lookup_join(going, ancestors, ["up_tree", "up_level", "up_idx"], "left").select(
        *_NODE,
        F.col("next_tree").alias("up_tree"),
        F.col("next_level").alias("up_level"),
        F.col("next_idx").alias("up_idx"),
        F.concat("segment", F.coalesce("more", F.lit(b""))).alias("segment"),
    )
    return joined.unionByName(arrived)


def _steps_of(segment: Column) -> Column:
    """The segment's steps as an array of (side, sibling in hex)."""
    count = F.octet_length(segment) / _STEP
    at = F.when(count > 0, F.sequence(F.lit(0), (count - 1).cast("int"))).otherwise(F.array().cast("array<int>"))
    return F.transform(
        at,
        lambda i: F.struct(
            F.substring(segment, i * _STEP + 1, F.lit(1)).cast("string").alias("side"),
            F.lower(F.hex(F.substring(segment, i * _STEP + 2, F.lit(_STEP - 1)))).alias("sibling"),
        ),
    )


def proof_digest(segment: Column) -> Column:
    """SHA-256 of the proof's siblings from the leaf upwards; a node alone in its run has none."""
    there = F.filter(_steps_of(segment), lambda s: s["side"] != _ALONE.decode())
    return F.sha2(F.array_join(F.transform(there, lambda s: s["sibling"]), ""), 256)


def folded(leaf: Column, segment: Column) -> Column:
    """The root that ``leaf`` and its proof give."""

    def step(below: Column, s: Column) -> Column:
        pair = (
            F.when(s["side"] == _ON_LEFT.decode(), F.concat(s["sibling"], below))
            .when(s["side"] == _ON_RIGHT.decode(), F.concat(below, s["sibling"]))
            .otherwise(below)
        )
        return F.sha2(pair, 256)

    return F.aggregate(_steps_of(segment), leaf, step)


def proofs(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: its place, leaf, the segment of siblings up to the root, subroot and root.

    Columns: ``doc_id``, ``leaf``, ``shown`` (the leaf after the test's tampering), ``tree`` (the number of the
    language), ``idx``, ``segment`` (binary, 33 bytes a level), ``subroot``, ``root``. Null fields hash as ``-``.
    Rows of equal id are ordered by their leaf, and repeated rows are leaves of their own. A tree of one
    leaf has an empty segment. An empty table gives no rows; further columns of ``docs`` have no part.
    """
    placed = _placed(leaves(docs))
    steps, roots = _build(placed.select("tree", "idx", "n", F.col("leaf").alias("digest")))
    subroots = written(roots.withColumnRenamed("digest", "subroot"), "subroots")
    count = subroots.count()
    top_steps, top_roots = _build(subroots.select(F.lit(_TOP).cast("long").alias("tree"), F.col("tree").alias("idx"), F.lit(count).cast("long").alias("n"), F.col("subroot").alias("digest")))
    top = top_roots.first()  # one row, or none for an empty table
    # A subroot stands both at the top of its language's tree and at the bottom of the subroots' tree.
    depths = placed.filter("idx = 0").select(F.col("tree").alias("own"), _levels(F.col("n")).alias("depth"))
    above = _with_parent(_union(top_steps))
    bottom = lookup_join(above.filter("level = 0").withColumn("own", F.col("idx")), depths, ["own"], "inner")
    bottom = bottom.select(
        F.col("own").alias("tree"), F.col("depth").alias("level"), F.lit(0).cast("long").alias("idx"), "up_tree", "up_level", "up_idx", "segment"
    )
    nodes = written(_union([_with_parent(_union(steps)), above.filter("level > 0"), bottom]), "jump")
    longest = (depths.agg(F.max("depth")).first()[0] or 0) + max(count - 1, 0).bit_length()
    distance = 1
    while distance < longest:
        nodes = _jumped(nodes, distance)
        distance *= 2
        if distance < longest:
            nodes = written(nodes, "jump")
    found = nodes.filter((F.col("level") == 0) & (F.col("tree") != _TOP)).select("tree", "idx", "segment")
    rows = placed.join(found, ["tree", "idx"], "left").withColumn("segment", F.coalesce("segment", F.lit(b"")))
    root = F.lit(top["digest"] if top else None).cast("string")
    rows = lookup_join(rows, subroots, ["tree"], "left").withColumn("root", root)
    return rows.select("doc_id", "leaf", "shown", "tree", "idx", "segment", "subroot", "root")


def manifest_report(docs: DataFrame) -> DataFrame:
    """Digests of every row's proof, and whether the row as presented still folds to the root."""
    rows = proofs(docs).withColumn("folded_root", folded(F.col("shown"), F.col("segment")))
    return rows.select(
        "doc_id",
        "leaf",
        "subroot",
        "root",
        proof_digest(F.col("segment")).alias("proof_sha256"),
        "folded_root",
        (F.col("folded_root") == F.col("root")).alias("verified"),
    )
