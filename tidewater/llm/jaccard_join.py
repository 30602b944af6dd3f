"""N-gram Jaccard self-join by a size-aware heavy-light scheme.

Every text becomes its set of k-word shingles.  Shingles are ordered by how many different sets hold
them, rarest first.  Sets of size s that link (Jaccard >= t) share at least o = ceil(t * s) shingles, so
with c shared ones asked for, the first s - o + c of the order hold c common ones:

* light sets (size up to the boundary) enumerate all subsets of c = 2 shingles of that prefix as keys;
* heavy sets scan inverted lists: each shingle of their prefix for c = 1 is a list, and light sets that
  are large enough to link with a heavy one stand in these lists too.

The boundary is where the summed cost of subset keys below it and of list entries above it is least,
from the sizes and list lengths of all sets.  Shingles held by one set only can't be shared, so they
count for prefix lengths but are never keys.

Sets equal in all shingles are one class from the start.  Within a key, every set is first compared with one
hub; verified links merge components, and only keys with several components go on to the next round with another
hub.  What is left is compared in full: short lists pair by pair; long lists, which mostly are the same
group of near copies again and again, as clusters of overlapping lists, each cluster once, block against
block by one matrix product, so that no pair is ever a row.  Links are exact: no pair that may link stays
uncompared unless both sides are connected already.
"""

from __future__ import annotations

from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.llm.components import components
from tidewater.llm.exchange import (BLOB, BLOB_ARROW, bucket_of, buckets_for, column, dealt, discard, from_low_bytes,
                                    low_bytes, materialized, text_groups)
from tidewater.llm.heavy import heavy_table, int64, local_heavy, member
from tidewater.llm.words import U64, mix, shingle_set

HUB_ROUNDS = 2
SHORT = 16  # longest list that is compared pair by pair
BLOCK_SETS = 200  # of a cluster, that meet another block at a time
COLUMNS = 4096  # of the matrix product at a time
KEPT = 7  # bytes of a shingle hash that travel; its bucket stands for the eighth
POSTING, HEADER, HEAVY = 0, 1, 2
HELD = 500_000  # postings that a bucket's task holds, about; a home's holds twice as many, with lists for their sets


def _signatures(sets: list[np.ndarray]) -> np.ndarray:
    """One hash per set, from sum, exclusive or and size; 0 for the empty set."""
    total, odd, n = (np.array([f(s) for s in sets], U64) for f in (np.sum, np.bitwise_xor.reduce, len))
    return np.where(n == 0, U64(0), mix(total + mix(odd) + n))


def _scan(batches, k):
    """Rows (0, doc_id, set size, signature) and (2, null, count, key) of locally heavy shingles."""
    for ids, texts in text_groups(batches, lower=True):
        sets = [shingle_set(w, k) for w in texts]
        sigs = _signatures(sets)
        keys, counts = local_heavy(np.concatenate(sets), len(sets))
        n = len(sets)
        yield pa.record_batch([pa.array(np.zeros(n, np.int32)), ids, pa.array(np.array([len(s) for s in sets], np.int64)),
                               int64(sigs)], names=["kind", "doc_id", "n", "sig"])
        if len(keys):
            yield pa.record_batch([pa.array(np.full(len(keys), HEAVY, np.int32)), pa.nulls(len(keys), ids.type),
                                   pa.array(counts), int64(keys)], names=["kind", "doc_id", "n", "sig"])


def _deal(batches, k, heavy, buckets, homes):
    """Postings to the shingle's bucket; sizes and heavy shingles to the set's home."""
    for _, texts in text_groups(batches, lower=True):
        sets = [s for s in (shingle_set(w, k) for w in texts) if len(s)]
        if not sets:
            continue
        sigs, size = _signatures(sets), np.array([len(s) for s in sets], np.int64)
        _, first = np.unique(sigs, return_index=True)
        sets, sigs, size = [sets[i] for i in first], sigs[first], size[first]
        sh, own = np.concatenate(sets), np.repeat(np.arange(len(sets)), size)
        hot = member(heavy, sh)
        home = bucket_of(mix(sigs), homes)
        yield dealt(home, HEADER, sigs, size)
        if hot.any():
            yield dealt(home[own[hot]], HEAVY, sigs[own[hot]], sh[hot])
        sh, own = sh[~hot], own[~hot]
        if len(sh):
            yield dealt(bucket_of(sh, buckets), POSTING, low_bytes(sh, KEPT), sigs[own])


def _count(key, table, homes):
    """Of one bucket: shingles that several sets hold, with their frequency, to each set's home.

    Rows of other kinds are addressed to homes already and pass unchanged.
    """
    if key[0].as_py() != POSTING:
        return table
    sh, sig = from_low_bytes(column(table, "a", np.uint8), KEPT, key[1].as_py()), column(table, "b", U64)
    order = np.argsort(sh)
    sh = sh[order]
    same = sh[1:] == sh[:-1]
    several = np.r_[same, False] | np.r_[False, same]
    sh, sig = sh[several], sig[order][several]
    order = np.lexsort((sig, sh))
    sh, sig = sh[order], sig[order]
    if len(sh):
        once = np.r_[True, (sh[1:] != sh[:-1]) | (sig[1:] != sig[:-1])]
        sh, sig = sh[once], sig[once]
        at = np.flatnonzero(np.r_[True, sh[1:] != sh[:-1]])
        n = np.diff(np.r_[at, len(sh)])
        df = np.repeat(n, n)
        sh, sig, df = sh[df > 1], sig[df > 1], df[df > 1].astype(np.uint32)
    if not len(sh):
        return pa.table({c: [] for c in BLOB_ARROW.names}, schema=BLOB_ARROW)
    return pa.Table.from_batches([dealt(bucket_of(mix(sig), homes), POSTING, sh, sig, df)])


SETS = "sig bigint, n int, shared array<bigint>, m1 int, m2 int, scan bigint"


def _prefixes(key, table, heavy, heavy_df, num, den):
    """Of one home: sets that may link, their shared shingles in order, and how many of them count as prefix."""
    kind = np.array(table.column("kind"))
    head, post, hot = (table.filter(pa.array(kind == x)) for x in (HEADER, POSTING, HEAVY))
    sigs, first = np.unique(column(head, "a", U64), return_index=True)
    size = column(head, "b", np.int64)[first]
    sig, sh, df = column(post, "b", U64), column(post, "a", U64), column(post, "c", np.uint32).astype(np.int64)
    if hot.num_rows:
        hs, hk = column(hot, "a", U64), column(hot, "b", U64)
        sig, sh = np.r_[sig, hs], np.r_[sh, hk]
        df = np.r_[df, heavy_df[np.searchsorted(heavy, hk)] + (1 << 32)]
    order = np.lexsort((sh, df, sig))
    sig, sh, df = sig[order], sh[order], df[order]
    if len(sig):
        once = np.r_[True, (sig[1:] != sig[:-1]) | (sh[1:] != sh[:-1])]
        sig, sh, df = sig[once], sh[once], df[once]
    lo, hi = np.searchsorted(sig, sigs, "left"), np.searchsorted(sig, sigs, "right")
    room = size - (num * size + den - 1) // den - (size - (hi - lo))
    m1, m2 = (np.clip(room + c, 0, hi - lo) for c in (1, 2))
    may = (m1 > 0) & (size > 1)
    rows = np.flatnonzero(may)
    shared = [sh[lo[i] : hi[i]].view(np.int64) for i in rows]
    scan = [int(np.minimum(df[lo[i] : lo[i] + m1[i]], 1 << 32).sum()) for i in rows]
    return pa.table({"sig": sigs[rows].view(np.int64), "n": size[rows].astype(np.int32),
                     "shared": pa.array(shared, pa.list_(pa.int64())), "m1": m1[rows].astype(np.int32),
                     "m2": m2[rows].astype(np.int32), "scan": pa.array(scan, pa.int64())})


def shingle_classes(docs: DataFrame, k: int = 5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(kind, doc_id, n, sig): for kind 0 a document, its set size and its set's signature."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    schema = f"kind int, doc_id {rows.schema[0].dataType.simpleString()}, n bigint, sig bigint"
    return rows.mapInArrow(partial(_scan, k=k), schema)


def linkable_sets(docs: DataFrame, scanned: DataFrame, k: int, num: int, den: int, text_col: str = "text") -> DataFrame:
    """One row per distinct set that may link, with its shared shingles rarest first."""
    totals = scanned.where("kind = 0").agg(F.count(F.lit(1)).alias("docs"), F.coalesce(F.sum("n"), F.lit(0)).alias("n")).first()
    heavy, heavy_df = heavy_table(scanned.where(f"kind = {HEAVY}").select(F.col("sig").alias("key"), F.col("n").alias("count")),
                                  totals["docs"], totals["n"])
    buckets = buckets_for(totals["n"], HELD)
    homes = -(-buckets // 2)
    rows = docs.select(F.lit(0).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    blobs = rows.mapInArrow(partial(_deal, k=k, heavy=heavy, buckets=buckets, homes=homes), BLOB)
    at_home = blobs.groupBy("kind", "bucket").applyInArrow(partial(_count, homes=homes), BLOB)
    sets = at_home.groupBy("bucket").applyInArrow(
        partial(_prefixes, heavy=heavy, heavy_df=heavy_df, num=num, den=den), SETS)
    return materialized(docs.sparkSession, sets, "sets")


def boundary(sets: DataFrame) -> int:
    """Largest size of a light set: where subset keys below and list entries above cost least together."""
    step = F.floor(F.log(1.1, F.col("n")))
    costs = sets.groupBy(step.alias("step")).agg(
        F.max("n").alias("n"), F.sum(F.col("m2").cast("double") * (F.col("m2") - 1) / 2).alias("light"),
        F.sum(F.col("scan").cast("double") + F.col("m1")).alias("heavy")).orderBy("n").collect()  # one row per size step
    best, at = sum(r["heavy"] for r in costs), 0
    cost = best
    for r in costs:
        cost += r["light"] - r["heavy"]
        if cost < best:
            best, at = cost, r["n"]
    return at


def _postings(sets: DataFrame, light: int, num: int, den: int) -> DataFrame:
    """(key, other_key, heavy, sig, n): light sets under each pair of their prefix, heavy ones under each shingle."""
    prefix = F.expr("slice(shared, 1, m2)")
    pairs = F.expr("flatten(transform(prefix, (x, i) -> transform(slice(prefix, i + 2, size(prefix)), "
                   "y -> struct(least(x, y) as key, greatest(x, y) as other_key))))")
    low = sets.where(F.col("n") <= light).withColumn("prefix", prefix).select(
        F.explode(pairs).alias("k"), F.lit(False).alias("heavy"), "sig", "n")
    high = sets.where((F.col("n") * den >= light * num) & (F.col("m1") > 0)).select(
        F.explode(F.expr("slice(shared, 1, m1)")).alias("key"), (F.col("n") > light).alias("heavy"), "sig", "n")
    low = low.select("k.key", "k.other_key", "heavy", "sig", "n")
    high = high.select("key", F.lit(None).cast("bigint").alias("other_key"), "heavy", "sig", "n")
    both = low.union(high)
    # a list without a heavy set asks for nothing; a light pair's list always does
    alive = both.groupBy("key", "other_key").agg(F.count(F.lit(1)).alias("c"), F.max("heavy").alias("h")).where(
        "c > 1 and (h or other_key is not null)").select("key", F.col("other_key").alias("ok"))
    return both.join(alive, (both.key == alive.key) & both.other_key.eqNullSafe(alive.ok), "left_semi")


def _linked(pairs: DataFrame, sets: DataFrame, num: int, den: int) -> DataFrame:
    """The pairs (a, b) whose sets link, by their whole intersection."""
    s = sets.select("sig", "n", "shared")
    a, b = s.toDF("a", "na", "sa"), s.toDF("b", "nb", "sb")
    common = F.size(F.array_intersect("sa", "sb")).cast("bigint")
    return pairs.join(a, "a").join(b, "b").withColumn("common", common).where(
        F.col("common") * den >= num * (F.col("na") + F.col("nb") - F.col("common"))).select("a", "b")


def _may_link(num: int, den: int):
    """Of a pair (x, y) under one key: sizes near enough, not connected yet, and meant by this kind of key."""
    return ((F.col("nx") * den >= F.col("ny") * num) & (F.col("ny") * den >= F.col("nx") * num)
            & (F.col("lx") != F.col("ly")) & (F.col("hx") | F.col("hy") | F.col("other_key").isNotNull()))


_X = {"sig": "x", "n": "nx", "label": "lx", "heavy": "hx"}


def _once(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()


def _hub_pairs(posts: DataFrame, turn: int, num: int, den: int) -> DataFrame:
    """Each set with the hub of its key: another one each turn, and one for each step of sizes, as sizes far apart can't link."""
    stepped = posts.withColumn("step", F.floor(F.log(den / num, F.col("n")) + F.lit(turn / HUB_ROUNDS)))
    hubs = stepped.groupBy("key", "other_key", "step").agg(
        F.min_by(F.struct("sig", "n", "label", "heavy"), F.xxhash64("sig", F.lit(turn))).alias("hub"),
        F.min("label").alias("lo"), F.max("label").alias("hi")).where("lo <> hi")
    hubs = hubs.select(F.col("key").alias("k"), F.col("other_key").alias("ok"), F.col("step").alias("st"),
                       F.col("hub.sig").alias("y"), F.col("hub.n").alias("ny"), F.col("hub.label").alias("ly"),
                       F.col("hub.heavy").alias("hy"))
    met = stepped.withColumnsRenamed(_X).join(hubs, (F.col("key") == F.col("k")) & F.col("other_key").eqNullSafe(F.col("ok"))
                                              & (F.col("step") == F.col("st")) & _may_link(num, den))
    return _once(met)


def _short_pairs(posts: DataFrame, num: int, den: int) -> DataFrame:
    """All pairs of short lists."""
    y = posts.select(F.col("key").alias("k"), F.col("other_key").alias("ok"), F.col("sig").alias("y"),
                     F.col("n").alias("ny"), F.col("label").alias("ly"), F.col("heavy").alias("hy"))
    return _once(posts.withColumnsRenamed(_X).join(y, (F.col("key") == F.col("k")) & F.col("other_key").eqNullSafe(F.col("ok"))
                                                   & (F.col("x") < F.col("y")) & _may_link(num, den)))


def _block_links(key, table, num, den):
    """Links between two blocks of a cluster that join different components, as few as join them."""
    first, second = key[1].as_py(), key[2].as_py()
    block = np.array(table["block"])
    table = table.take(pa.array(np.argsort(block, kind="stable")))
    block, sig, label, n = (np.array(table[c]) for c in ("block", "sig", "label", "n"))
    empty = pa.table({"a": pa.array([], pa.int64()), "b": pa.array([], pa.int64())})
    if (label == label[0]).all():
        return empty
    a = np.arange(len(sig)) if first == second else np.flatnonzero(block == first)
    b = a if first == second else np.flatnonzero(block == second)
    lists = table["shared"].combine_chunks()
    row = np.repeat(np.arange(len(sig)), np.diff(np.asarray(lists.offsets)))
    _, col, held = np.unique(np.asarray(lists.flatten()), return_inverse=True, return_counts=True)
    row, col = row[held[col] > 1], col[held[col] > 1]
    _, col = np.unique(col, return_inverse=True)
    order = np.argsort(col, kind="stable")
    row, col = row[order], col[order]
    common = np.zeros((len(a), len(b)), np.float32)
    for c in range(0, int(col[-1]) + 1 if len(col) else 0, COLUMNS):
        i, j = np.searchsorted(col, (c, c + COLUMNS))
        has = np.zeros((len(sig), COLUMNS), np.float32)
        has[row[i:j], col[i:j] - c] = 1
        common += has[a] @ has[b].T
    common = common.astype(np.int64)
    ok = (common * den >= num * (n[a][:, None] + n[b][None, :] - common)) & (label[a][:, None] != label[b][None, :])
    root, out = {x: x for x in label.tolist()}, []

    def find(x):
        while root[x] != x:
            root[x] = x = root[root[x]]
        return x

    for i, j in zip(*np.nonzero(ok)):
        x, y = find(int(label[a[i]])), find(int(label[b[j]]))
        if x != y:
            root[x] = y
            out.append((a[i], b[j]))
    if not out:
        return empty
    i, j = (sig[np.array(x)] for x in zip(*out))
    return pa.table({"a": np.minimum(i, j), "b": np.maximum(i, j)})


def _cluster_links(posts: DataFrame, sets: DataFrame, num: int, den: int) -> DataFrame:
    """Links (a, b) between the sets of long lists that are in different components so far.

    Sets whose long lists overlap are one cluster.  A cluster is dealt to blocks, and every two blocks of it
    meet once; a set travels once for each block of its cluster.
    """
    hub = posts.groupBy("key", "other_key").agg(F.min("sig").alias("hub")).select(
        F.col("key").alias("k"), F.col("other_key").alias("ok"), "hub")
    stars = posts.join(hub, (F.col("key") == F.col("k")) & F.col("other_key").eqNullSafe(F.col("ok"))).where(
        "sig <> hub").select(F.col("sig").alias("a"), F.col("hub").alias("b")).distinct()
    cluster = components(stars).select(F.col("node").alias("sig"), F.col("label").alias("cluster"))
    sizes = cluster.groupBy("cluster").agg(F.ceil(F.count(F.lit(1)) / BLOCK_SETS).cast("int").alias("blocks"))
    labels = posts.select("sig", "label").distinct()
    member = cluster.join(sizes, "cluster").join(labels, "sig").join(sets.select("sig", "n", "shared"), "sig")
    member = member.withColumn("block", F.pmod(F.xxhash64("sig"), F.col("blocks")).cast("int"))
    met = member.withColumn("other", F.explode(F.expr("sequence(0, blocks - 1)"))).select(
        "cluster", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "block", "sig", "label",
        F.col("n").cast("bigint").alias("n"), "shared")
    return met.groupBy("cluster", "i", "j").applyInArrow(partial(_block_links, num=num, den=den), "a bigint, b bigint")


def links(sets: DataFrame, num: int = 80, den: int = 100) -> DataFrame:
    """(node, label) of all sets that link with another, label being the same for connected ones."""
    spark = sets.sparkSession
    light = boundary(sets)
    held = materialized(spark, _postings(sets, light, num, den), "postings")
    posts = held.withColumn("label", F.col("sig"))
    found, labels = None, None
    for turn in range(HUB_ROUNDS + 1):
        open_keys = posts.groupBy("key", "other_key").agg(
            F.count(F.lit(1)).alias("c"), F.min("label").alias("lo"), F.max("label").alias("hi")).where("lo <> hi").select(
            F.col("key").alias("k"), F.col("other_key").alias("ok"), "c")
        posts = materialized(spark, posts.join(
            open_keys, (F.col("key") == F.col("k")) & F.col("other_key").eqNullSafe(F.col("ok"))).drop("k", "ok"), "postings")
        discard(held)
        held = posts
        if posts.isEmpty():
            break
        if turn < HUB_ROUNDS:
            new = _linked(_hub_pairs(posts, turn, num, den), sets, num, den)
        else:
            short = _linked(_short_pairs(posts.where(F.col("c") <= SHORT), num, den), sets, num, den)
            new = short.union(_cluster_links(posts.where(F.col("c") > SHORT), sets, num, den))
        new = materialized(spark, new, "found")
        found = new if found is None else found.union(new)
        labels = components(found)
        posts = posts.drop("label", "c").join(labels.toDF("sig", "label"), "sig", "left").withColumn(
            "label", F.coalesce("label", "sig"))
    discard(held)
    if labels is None:
        return spark.createDataFrame([], "node bigint, label bigint")
    return labels


def jaccard_components(docs: DataFrame, k: int = 5, num: int = 80, den: int = 100, id_col: str = "doc_id",
                       text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id.

    Words are runs outside ASCII white space with A-Z lower-cased; a text's set is its distinct k-word
    shingles (shorter texts: the whole sequence); texts without words, and null texts, have an empty set and
    link with nothing.  Two documents link when den * |A & B| >= num * |A | B|; component_id is the least
    doc_id over all links.  Repeated rows stay rows; a null doc_id never is a component's id unless alone.
    Other columns of docs aren't read.
    """
    spark = docs.sparkSession
    scanned = materialized(spark, shingle_classes(docs, k, id_col, text_col), "shingles")
    sets = linkable_sets(docs, scanned, k, num, den, text_col)
    labels = links(sets, num, den)
    rows = scanned.where("kind = 0").select("doc_id", F.col("n").alias("n_shingles"), "sig")
    labels = labels.select(F.col("node").alias("sig"), "label")
    least = rows.where("n_shingles > 0").groupBy("sig").agg(F.min("doc_id").alias("first"))
    least = least.join(labels, "sig", "left").withColumn("label", F.coalesce("label", "sig"))
    top = least.groupBy("label").agg(F.min("first").alias("component_id"))
    classes = least.select("sig", "label").join(top, "label").select("sig", "component_id")
    full = rows.where("n_shingles > 0").join(classes, "sig").select("doc_id", "n_shingles", "component_id")
    none = rows.where("n_shingles = 0").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    return full.union(none)
