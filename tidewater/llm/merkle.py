"""Merkle manifest of a table: leaf hashes, a tree per group, proofs, and what tampering does to them.

A leaf's coordinate, its group and its place by ascending id, comes from rank queries on merged bitmaps of the ids (``bitmap_rank``),
so the leaves are never sorted.  Nodes are then keyed by place: a block of RUN**DEPTH places is a slot array
that one task fills in any order and reduces, level by level, to one node; blocks' nodes are nodes of the next round.
The groups' roots are the leaves of the last tree.  Proofs go the other way: the path above a block is handed
to all its places.
"""

from __future__ import annotations

import hashlib
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewater.functions.indexing import with_row_index
from tidewater.llm.bitmap_rank import ranked
from tidewater.llm.exchange import materialized

RUN = 8  # nodes that become one
DEPTH = 4  # levels that a block reduces
COPIES = 1 << 12  # copies of one row that a task writes out
HEX = 64  # characters of a hash
FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]
CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def leaf_hash(columns) -> F.Column:
    """Lowercase hex sha256 of the values, each `-` if null, else its length in UTF-8 bytes, `:` and itself."""
    texts = [c.cast("string") for c in columns]
    return F.sha2(F.concat(*[F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]), 256)


def _hash(text: bytes) -> bytes:
    return hashlib.sha256(text).hexdigest().encode()


def reduced(hashes: bytes, n: int, total: int, depth: int = DEPTH) -> list[bytes]:
    """Levels of a block, each the hex hashes of its nodes, up to the block's node.

    total: nodes of the whole group at the first level; a group of one block ends with its root, others after depth levels.
    """
    levels = [hashes]
    while n > 1 if total <= RUN**depth else len(levels) <= depth:
        below, n = levels[-1], -(-n // RUN)
        levels.append(b"".join(_hash(below[HEX * RUN * i : HEX * RUN * (i + 1)]) for i in range(n)))
    return levels


def siblings(levels: list[bytes], place: int) -> tuple[list[bytes], list[bytes]]:
    """(nodes left, nodes right) of a place's run on each level, from the first up to below the last."""
    left, right = [], []
    for level in levels[:-1]:
        run = place // RUN * RUN
        left.append(level[HEX * run : HEX * place])
        right.append(level[HEX * (place + 1) : HEX * (run + RUN)])
        place //= RUN
    return left, right


def folded(leaf: bytes, left: list[bytes], right: list[bytes]) -> bytes:
    for a, b in zip(left, right):
        leaf = _hash(a + leaf + b)
    return leaf


def _slots(table: pa.Table, depth: int) -> tuple[np.ndarray, bytes]:
    """Places of the rows in their block, and the block's hashes in place."""
    place = np.asarray(table["pos"]) % RUN**depth
    slots = np.empty(len(place), f"S{HEX}")
    slots[place] = table["hash"].to_numpy(zero_copy_only=False).astype(f"S{HEX}")
    return place, slots.tobytes()


UP = "grp string, pos bigint, n bigint, hash string"


def _up(key, table, depth):
    """The node of one block."""
    n = table["n"][0].as_py()
    _, hashes = _slots(table, depth)
    top = reduced(hashes, table.num_rows, n, depth)[-1].decode()
    return pa.table({"grp": [key[0].as_py()], "pos": [key[1].as_py()], "n": [-(-n // RUN**depth)], "hash": [top]},
                    pa.schema([("grp", pa.string()), ("pos", pa.int64()), ("n", pa.int64()), ("hash", pa.string())]))


def _by_block(nodes: DataFrame, depth: int) -> DataFrame:
    return nodes.withColumn("block", F.expr(f"pos div {RUN**depth}"))


def _with_paths(nodes: DataFrame, above: DataFrame, task, schema: str, depth: int) -> DataFrame:
    """task(key, nodes of a block, the path above it) for each block."""
    above = above.withColumnsRenamed({"grp": "of_grp", "block": "of_block"})
    blocks = _by_block(nodes, depth).groupBy("grp", "block")
    return blocks.cogroup(above.groupBy("of_grp", "of_block")).applyInArrow(partial(task, depth=depth), schema)


def grown(nodes: DataFrame, depth: int = DEPTH) -> tuple[list[DataFrame], DataFrame]:
    """Rounds of nodes (grp, pos, n, hash), the given ones first, and the roots (grp, hash) of the groups."""
    spark, rounds = nodes.sparkSession, []
    tops = None
    while True:
        rounds.append(nodes)
        up = _by_block(nodes.select("grp", "pos", "n", "hash"), depth).groupBy("grp", "block").applyInArrow(partial(_up, depth=depth), UP)
        up = materialized(spark, up, "nodes")
        done = up.where("n = 1").select("grp", "hash")
        tops = done if tops is None else tops.unionAll(done)
        nodes = up.where("n > 1")
        if nodes.isEmpty():
            return rounds, tops


PATHS = "grp string, pos bigint, left array<string>, right array<string>"
_STRINGS = pa.list_(pa.string())


def _tail(table: pa.Table) -> tuple[list[bytes], list[bytes]]:
    return tuple([x.encode() for x in table[c][0].as_py()] for c in ("left", "right"))


def _down(_, table, tails, depth):
    """The path above each place of a block."""
    place, hashes = _slots(table, depth)
    levels, above = reduced(hashes, len(place), table["n"][0].as_py(), depth), _tail(tails)
    paths = [siblings(levels, int(p)) for p in place]
    left, right = ([[x.decode() for x in path[i] + above[i]] for path in paths] for i in range(2))
    return pa.table({"grp": table["grp"], "pos": table["pos"], "left": pa.array(left, _STRINGS), "right": pa.array(right, _STRINGS)})


PROOFS = ("doc_id bigint, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean, "
          "leaf_index bigint")


def _prove(_, table, tails, depth):
    """Proof and folded root of each leaf of a block."""
    place, hashes = _slots(table, depth)
    levels, above = reduced(hashes, len(place), table["n"][0].as_py(), depth), _tail(tails)
    subroot, root = tails["subroot"][0].as_py(), tails["root"][0].as_py()
    proofs, roots = [], []
    for p, leaf, changed in zip(place.tolist(), table["hash"].to_pylist(), table["changed"].to_pylist()):
        left, right = siblings(levels, p)
        left, right = left + above[0], right + above[1]
        proofs.append(_hash(b"".join(x for pair in zip(left, right) for x in pair)).decode())
        roots.append(folded((leaf if changed is None else changed).encode(), left, right).decode())
    n = len(place)
    return pa.table({"doc_id": table["doc_id"], "leaf": table["hash"], "subroot": [subroot] * n, "root": [root] * n,
                     "proof_sha256": proofs, "folded_root": roots, "verified": [r == root for r in roots], "leaf_index": table["pos"]})


def _tails_of(rounds: list[DataFrame], tails: DataFrame, depth: int) -> DataFrame:
    """(grp, block, left, right) above each block of the first round; tails: (grp, left, right) above the groups' roots."""
    out = None
    for nodes in reversed(rounds):
        own = nodes.where(F.col("n") <= RUN**depth).select("grp").distinct().join(tails, "grp").select(
            "grp", F.lit(0).cast("bigint").alias("block"), "left", "right")
        above = own if out is None else own.unionAll(out)
        if nodes is rounds[0]:
            return above
        out = materialized(nodes.sparkSession, _with_paths(nodes, above, _down, PATHS, depth), "paths").select("grp", F.col("pos").alias("block"), "left", "right")


def placed(leaves: DataFrame) -> DataFrame:
    """leaves (grp, doc_id, hash, changed), and pos, the place of each in its group, and n, the group's leaves.

    By ascending doc_id, null first; rows of one doc_id by hash.  Equal rows take neighbouring places.
    """
    spark = leaves.sparkSession
    first = materialized(spark, ranked(leaves, "grp", "doc_id"), "ranked")
    alone = first.where("same = 1").select("grp", "doc_id", "hash", "changed", F.col("rank").alias("pos"), "n")
    tied = first.where("same > 1")
    if tied.isEmpty():
        return alone
    tied = tied.groupBy("grp", "doc_id", "hash", "changed", "rank", "n").agg(F.count(F.lit(1)).alias("copies"))
    tied = tied.select("*", F.concat_ws(":", F.col("rank").cast("string"), "grp").alias("ids"),
                       F.conv(F.substring("hash", 1, 15), 16, 10).cast("bigint").alias("head"))
    tied = materialized(spark, tied.withColumnsRenamed({"rank": "base", "n": "of"}), "tied")
    within = ranked(tied, "ids", "head", "copies")
    # hashes that start alike are ordered by all of them
    alike = Window.partitionBy("ids", "head").orderBy("hash").rowsBetween(Window.unboundedPreceding, -1)
    begin = F.col("base") + F.col("rank") + F.coalesce(F.sum("copies").over(alike), F.lit(0))
    within = within.withColumn("begin", begin)
    # copies are written out in two steps, so that many of one row are written by many tasks
    share = within.withColumn("share", F.explode(F.expr(f"sequence(0L, (copies - 1) div {COPIES})")))
    share = share.repartition("ids", "head", "share") if not tied.where(F.col("copies") > COPIES).isEmpty() else share
    copy = F.explode(F.expr(f"sequence(share * {COPIES}, least(copies, (share + 1) * {COPIES}) - 1)"))
    each = share.withColumn("copy", copy)
    return alone.unionAll(each.select("grp", "doc_id", "hash", "changed", (F.col("begin") + F.col("copy")).alias("pos"),
                                      F.col("of").alias("n")))


def merkle_manifest(docs: DataFrame, changed: str = "crc32(cast(doc_id as string)) % 3 = 0", fields: list[str] | None = None,
                    group: str = "lang", id_col: str = "doc_id", text_col: str = "text", depth: int = DEPTH) -> DataFrame:
    """One row per row of docs: its leaf, its group's root, the root, the hash of its proof, and the root folded from the row as found.

    A leaf hashes `fields` (doc_id, source, lang, n_chars, text).  Rows for which the SQL condition `changed` holds are found
    with A-Z of the text in lower case; null texts stay null.  verified: the folded root is the root.  leaf_index is the
    leaf's place in its group.

    Null doc_ids come first in their group and are never changed; rows of one doc_id follow each other by leaf, and
    equal rows have proofs of their own, since their places differ.  The null group is a group, the first one; an empty text is not
    null.  Other columns aren't read; an empty table gives no row.
    """
    spark, fields = docs.sparkSession, fields or FIELDS
    values = [F.col(f"`{c}`") for c in fields]
    lower = F.translate(F.col(text_col), CAPITALS, CAPITALS.lower())
    found = [lower if c == text_col else F.col(f"`{c}`") for c in fields]
    key = F.coalesce(F.concat(F.lit("="), F.col(group).cast("string")), F.lit(""))
    leaves = docs.select(key.alias("grp"), F.col(id_col).cast("bigint").alias("doc_id"), leaf_hash(values).alias("hash"),
                         F.when(F.expr(changed), leaf_hash(found)).alias("changed"))
    leaves = materialized(spark, placed(materialized(spark, leaves, "leaves")), "placed")
    rounds, subroots = grown(leaves, depth)
    subroots = with_row_index(subroots, "pos", ["grp"])
    nodes = subroots.select(F.lit("").alias("grp"), "pos", F.lit(subroots.count()).cast("bigint").alias("n"), "hash",
                            F.col("grp").alias("of"))
    nodes = materialized(spark, nodes, "subroots")
    upper, top = grown(nodes, depth)
    none = F.array().cast("array<string>")
    above = _tails_of(upper, top.select("grp", none.alias("left"), none.alias("right")), depth)
    paths = _with_paths(nodes, above, _down, PATHS, depth)
    root = top.first()  # one row, or none of an empty table
    tails = nodes.drop("grp").join(paths.drop("grp"), "pos").select(
        F.col("of").alias("grp"), "left", "right", F.col("hash").alias("subroot"), F.lit(root and root["hash"]).cast("string").alias("root"))
    tails = materialized(spark, tails, "tails")
    blocks = _tails_of(rounds, tails, depth).join(tails.select("grp", "subroot", "root"), "grp")
    return _with_paths(leaves, blocks, _prove, PROOFS, depth)
