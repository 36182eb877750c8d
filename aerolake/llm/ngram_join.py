"""N-gram Jaccard self-join by chosen paths.

A text's set holds its 5-word shingles (words are runs of ``[^\\x20\\x09-\\x0D]``; a text
of fewer words, but not none, has one shingle of all of them).  Texts with equal sets
are one class; classes whose sets have a Jaccard similarity of at least 0.8 are linked;
linked classes share a class id, the smallest document id among them.

Chosen paths: in each of ``runs`` runs a set picks the members whose hash in that run
lies below ``branch`` / size.  Sets that pick the same member meet in a bucket.  A bucket
of at most ``brute`` classes is compared pair by pair.  A larger one is split: each of
its sets again picks members, by a hash that depends on the path so far, down to
``depth``.  Unlike sets part quickly, as they share few members; sets at 0.8 or more
share so many that they stay together at every level with a known chance, so the runs
find all but a 1 - ``recall`` of the pairs: ``runs_for`` gives their number.

Buckets still large at the full depth are mostly groups of near copies, and one group
fills many buckets.  Their classes are compared whole, in blocks, each pair once: a class
is at home in its largest bucket, a home is dealt into blocks of about ``block`` classes,
and two blocks that hold classes of one bucket meet in one task.  A task puts out no pairs
but each class's number of links and edges that span what is linked.  Work in such a group
grows with the square of its distinct sets (not of its documents), rows with the square
divided by ``block``.

Scale: one map pass gives each document its set's 128-bit key, size and first-level
paths.  Equal sets, however many, are one row before anything is joined.  Texts are
shuffled twice: for the longer paths of classes in large buckets, and for the sets (as
48-bit hashes) of classes with a candidate.  Sets are compared after a size test.
Bucket sizes are partial aggregates; collected buckets hold at most ``brute`` classes,
tasks two blocks (in long sets, of fewer classes); components are joins.  Steps are written tables; the shuffles before
them are released.

Texts without words and null texts are classes of their own.  An empty table gives an empty result.  Rows with a null id take
part; a class id is null only if all ids of the class are.  Repeated rows give repeated
rows of one class.  Extra columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aerolake.llm.components import connected_components
from aerolake.llm.session import free_finished_shuffles, stored, use_package_on_workers
from aerolake.llm.words import SPACED, SequenceHash, mixed, pieces, split_words, word_hashes

SHINGLE = 5
THRESHOLD = 0.8
BRANCH = 1.6
BRUTE = 24
DEPTH = 3
RECALL = 0.99999
BLOCK = 512
#: members in a block, about
BLOCK_MEMBERS = 2_000_000


def runs_for(recall: float, branch: float = BRANCH, threshold: float = THRESHOLD, depth: int = DEPTH) -> int:
    """Runs after which a pair at ``threshold`` has met at the last level with probability ``recall``.

    Of a set's members a share of 2t / (1 + t) is common to a pair of equal sizes at
    Jaccard t; the common picks below a common path are Poisson with mean branch * share,
    and the pair parts if all its common paths end.
    """
    missed = 0.0
    for _ in range(depth):
        missed = math.exp(-branch * 2 * threshold / (1 + threshold) * (1 - missed))
    return max(1, math.ceil(math.log(1 - recall) / math.log(missed)))


def shingle_sets(texts: pa.Array, shingle: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of all texts, sorted within a text, and each text's first one."""
    words = split_words(texts, SPACED)
    sequence = SequenceHash(word_hashes(words))
    sizes = np.diff(words.first)
    counts = np.where(sizes == 0, 0, np.maximum(1, sizes - shingle + 1))
    first = np.concatenate([[0], np.cumsum(counts)])
    owner = np.repeat(np.arange(len(sizes)), counts)
    start = words.first[:-1][owner] + np.arange(len(owner)) - first[owner]
    hashes = sequence.of(start, np.minimum(start + shingle, words.first[1:][owner]))
    parts = [np.unique(hashes[a:b]) for a, b in zip(first[:-1], first[1:])]
    ends = np.cumsum([0, *map(len, parts)])
    return np.concatenate(parts) if parts else np.empty(0, np.uint64), ends


def picked(members: np.ndarray, sizes: np.ndarray, salt: np.ndarray | np.uint64, branch: float) -> tuple[np.ndarray, np.ndarray]:
    """Indexes of the members that a path picks, and the longer paths' hashes."""
    hashes = mixed(members ^ salt)
    chosen = np.flatnonzero((hashes >> np.uint64(11)).astype(np.float64) * sizes < branch * float(1 << 53))
    return chosen, mixed(hashes[chosen] + np.uint64(0x632BE59BD9B4E019))


def set_keys(members: np.ndarray, first: np.ndarray) -> list[bytes]:
    """A 128-bit key of each set: two sums over hashes of its members."""
    halves = []
    for salt in (0x1B873593CC9E2D51, 0x85EBCA77C2B2AE63):
        sums = np.concatenate([[np.uint64(0)], np.cumsum(mixed(members ^ np.uint64(salt)))])
        halves.append(sums[first[1:]] - sums[first[:-1]])
    both = np.stack(halves, axis=1)
    return [row.tobytes() for row in both]


def packed(members: np.ndarray) -> bytes:
    """The upper 48 bits of sorted hashes, six bytes each: a million shingles have no clash in 99.8 % of cases."""
    upper = np.unique(members >> np.uint64(16)) << np.uint64(16)
    return np.ascontiguousarray(upper.astype("<u8").view(np.uint8).reshape(-1, 8)[:, 2:]).tobytes()


def unpacked(data: pa.Buffer) -> np.ndarray:
    """The hashes of ``packed``, sorted."""
    whole = np.zeros((data.size // 6, 8), dtype=np.uint8)
    whole[:, 2:] = np.frombuffer(data, dtype=np.uint8).reshape(-1, 6)
    return whole.view("<u8").ravel()


def _lists(values: np.ndarray, owner: np.ndarray, n: int) -> pa.Array:
    """Lists of int64, one for each of ``n`` owners (``owner`` is sorted)."""
    return pa.ListArray.from_arrays(pa.array(np.searchsorted(owner, np.arange(n + 1)), pa.int32()), pa.array(values.view(np.int64)))


def linked_classes(sets: DataFrame, pairs: DataFrame, threshold: float) -> DataFrame:
    """The ``pairs`` (a, b) of keys whose sets reach the threshold."""
    left = sets.select(F.col("key").alias("a"), F.col("members").alias("left"))
    right = sets.select(F.col("key").alias("b"), F.col("members").alias("right"))

    def similar(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column(2), batch.column(3)):
                x, y = (unpacked(v.as_buffer()) for v in (x, y))
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(both >= threshold * (len(x) + len(y) - both))
            yield pa.record_batch([batch.column(0), batch.column(1)], ["a", "b"]).filter(pa.array(keep, pa.bool_()))

    full = pairs.join(left, "a").join(right, "b").select("a", "b", "left", "right")
    return full.mapInArrow(similar, "a binary, b binary")


def block_links(same: bool, sides: np.ndarray, members: list[np.ndarray], threshold: float) -> tuple[np.ndarray, list[tuple[int, int]]]:
    """Links of each set to sets of the other side (or within the ``same`` block), and edges that span them."""
    sizes = np.array([len(m) for m in members], dtype=np.int64)
    left = np.flatnonzero(sides == 0)
    right = left if same else np.flatnonzero(sides == 1)
    right = right[np.argsort(sizes[right], kind="stable")]
    ids, counts = np.unique(np.concatenate(members), return_inverse=True, return_counts=True)[1:]
    common = counts[ids] > 1  # a member of one set alone is in no intersection
    owner = np.repeat(np.arange(len(members)), sizes)[common]
    ids = ids[common]
    first = np.searchsorted(owner, np.arange(len(members) + 1))
    lists = [ids[first[r] : first[r + 1]] for r in right]
    joined = np.concatenate(lists) if lists else ids[:0]
    ends = np.concatenate([[0], np.cumsum([len(x) for x in lists])]).astype(np.int64)
    links, edges, group = np.zeros(len(members), dtype=np.int64), [], np.arange(len(members))
    marks = np.zeros(len(counts) + 1, dtype=np.int64)
    for x in left:
        a = np.searchsorted(sizes[right], math.floor(threshold * sizes[x] * (1 - 1e-9)))
        b = np.searchsorted(sizes[right], math.ceil(sizes[x] / threshold * (1 + 1e-9)), side="right")
        if a >= b:
            continue
        marks[ids[first[x] : first[x + 1]]] = 1
        sums = np.concatenate([[0], np.cumsum(marks[joined[ends[a] : ends[b]]])])
        both = sums[ends[a + 1 : b + 1] - ends[a]] - sums[ends[a:b] - ends[a]]
        marks[ids[first[x] : first[x + 1]]] = 0
        near = right[a:b][both >= threshold * (sizes[x] + sizes[right[a:b]] - both)]
        if same:
            near = near[near > x]
        links[x] += len(near)
        links[near] += 1
        others, at = np.unique(group[near], return_index=True)
        for g, y in zip(others, near[at]):
            if g != group[x]:
                edges.append((int(x), int(y)))
                group[group == g] = group[x]
    return links, edges


def large_links(dealt: DataFrame, threshold: float) -> DataFrame:
    """Links within large buckets: rows (a, b, null) are spanning edges, rows (a, null, n) a class's links.

    ``dealt`` has x and y (the two blocks), side (1 for y's classes), key and members.
    """

    def compared(table: pa.Table) -> pa.Table:
        keys = table["key"].to_pylist()
        members = [unpacked(v.as_buffer()) for v in table["members"]]
        sides = table["side"].to_numpy()
        same = table["x"][0].as_py() == table["y"][0].as_py()
        links, edges = block_links(same, sides, members, threshold)
        some = np.flatnonzero(links).tolist()
        a = [keys[x] for x, _ in edges] + [keys[x] for x in some]
        b = [keys[y] for _, y in edges] + [None] * len(some)
        n = [None] * len(edges) + links[some].tolist()
        return pa.table({"a": pa.array(a, pa.binary()), "b": pa.array(b, pa.binary()), "n": pa.array(n, pa.int64())})

    return dealt.groupBy("x", "y").applyInArrow(compared, "a binary, b binary, n long")


def similarity_classes(
    documents: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    threshold: float = THRESHOLD,
    shingle: int = SHINGLE,
    recall: float = RECALL,
    branch: float = BRANCH,
    brute: int = BRUTE,
    depth: int = DEPTH,
    block: int = BLOCK,
) -> DataFrame:
    """``id_col``, class_id (smallest id of the class) and n_links (other distinct sets at the threshold) of every row."""
    spark = documents.sparkSession
    use_package_on_workers(spark)
    rows = documents.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.hash(text_col).alias("mark"))
    kind = rows.schema["id"].dataType.simpleString()
    salts = mixed(np.arange(1, runs_for(recall, branch, threshold, depth) + 1, dtype=np.uint64))

    def first_paths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches, 1):
            members, first = shingle_sets(piece.column(1), shingle)
            sizes = np.diff(first)
            owner = np.repeat(np.arange(len(sizes)), sizes)
            found = [picked(members, sizes[owner], s, branch) for s in salts]
            owners = np.concatenate([owner[i] for i, _ in found])
            paths = np.concatenate([p for _, p in found])
            order = np.argsort(owners, kind="stable")
            keys = [k if n else None for k, n in zip(set_keys(members, first), sizes)]
            yield pa.record_batch(
                [piece.column(0), piece.column(2), pa.array(keys, pa.binary()), pa.array(sizes, pa.int32()), _lists(paths[order], owners[order], len(sizes))],
                ["id", "mark", "key", "size", "paths"],
            )

    every = stored(rows.mapInArrow(first_paths, f"id {kind}, mark int, key binary, size int, paths array<long>"), "join-documents")
    # one row per distinct set; equal sets have equal paths
    # and any of the class's documents stands for it when texts are read again
    one = F.min(F.struct(F.col("id").isNull().alias("null"), "id", "mark")).alias("one")
    classes = stored(every.where("key is not null").groupBy("key").agg(F.first("size").alias("size"), F.first("paths").alias("paths"), one), "join-classes")
    nodes = stored(classes.select("key", "size", F.explode(F.array_distinct("paths")).alias("path")), "join-nodes")

    def met(nodes: DataFrame) -> DataFrame:
        """The nodes of buckets with more than one class, with the bucket's size n."""
        sizes = stored(nodes.groupBy("path").agg(F.count("*").alias("n")).where("n > 1"), "join-buckets")
        return stored(nodes.join(sizes, "path"), "join-met")

    def small(nodes: DataFrame) -> DataFrame:
        return nodes.where(F.col("n") <= brute).groupBy("path").agg(F.sort_array(F.collect_list(F.struct("key", "size"))).alias("bucket")).select("bucket")

    level = met(nodes)
    candidates, large = [small(level)], level.where(F.col("n") > brute)
    longer = stored(_longer_paths(rows, _one_row(classes, large.groupBy("key").agg(F.collect_list("path").alias("split"))), shingle, branch, depth), "join-longer")
    free_finished_shuffles(spark)
    for deep in range(2, depth + 1):
        # below large buckets only
        parents = stored(large.select(F.col("path").alias("parent")).distinct(), "join-parents")
        level = met(longer.where(F.col("level") == deep).join(parents, "parent", "left_semi").select("path", "key", "size"))
        candidates.append(small(level))
        large = level.where(F.col("n") > brute)

    # blocks of the classes in buckets that stay large, and the blocks that meet; a class has few paths, however large its buckets
    homes = large.groupBy("key").agg(F.max(F.struct("n", "path")).alias("top"), F.first("size").alias("size"), F.collect_list("path").alias("paths"))
    homes = stored(homes.select("key", "size", "paths", F.col("top.path").alias("home")), "join-homes")
    n_blocks = F.ceil(F.greatest(F.count("*") / block, F.sum("size") / BLOCK_MEMBERS)).alias("n_blocks")
    homes = homes.join(stored(homes.groupBy("home").agg(n_blocks), "join-homes"), "home")
    blocks = stored(homes.select("key", F.xxhash64("home", F.pmod(F.xxhash64("key", "home"), "n_blocks")).alias("block"), "paths"), "join-blocks")
    held = stored(blocks.select(F.explode("paths").alias("path"), "block").distinct(), "join-held")
    blocks = blocks.select("key", "block")
    meets = held.withColumnRenamed("block", "x").join(held.withColumnRenamed("block", "y"), "path")
    meets = stored(meets.where("x <= y").select("x", "y").distinct(), "join-meets")
    buckets = candidates[0]
    for more in candidates[1:]:
        buckets = buckets.unionByName(more)
    buckets = buckets.distinct()
    pairs = buckets.select(F.posexplode("bucket").alias("i", "one"), "bucket").select("one", F.explode(F.expr("slice(bucket, i + 2, size(bucket))")).alias("two"))
    pairs = pairs.select(F.col("one.key").alias("x"), F.col("one.size").alias("n"), F.col("two.key").alias("y"), F.col("two.size").alias("m"))
    # sets whose sizes differ more than the threshold allows cannot reach it
    possible = (F.col("x") != F.col("y")) & (F.least("n", "m") >= threshold * F.greatest("n", "m"))
    pairs = stored(pairs.where(possible).select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct(), "join-pairs")
    # a pair whose blocks meet is compared there; a class in no block has a key of its own, so that nulls do not gather
    for side in "ab":
        pairs = pairs.join(blocks.withColumnsRenamed({"key": side, "block": f"block_{side}"}), side, "left")
    own = [F.coalesce(f"block_{side}", F.xxhash64(F.col(side))) for side in "ab"]
    pairs = pairs.select("a", "b", F.least(*own).alias("x"), F.greatest(*own).alias("y"))
    pairs = stored(pairs.join(meets, ["x", "y"], "left_anti").select("a", "b"), "join-pairs")
    free_finished_shuffles(spark)
    compared = pairs.select(F.explode(F.array("a", "b")).alias("key")).unionByName(blocks.select("key")).distinct()
    sets = stored(_sets_of(rows, _one_row(classes, compared), shingle).dropDuplicates(["key"]), "join-sets")
    free_finished_shuffles(spark)
    links = stored(linked_classes(sets, pairs, threshold).select("a", "b", F.lit(None).cast("long").alias("n")), "join-links")
    free_finished_shuffles(spark)
    sides = meets.select("x", "y", F.col("x").alias("block"), F.lit(0).alias("side"))
    sides = sides.unionByName(meets.where("x < y").select("x", "y", F.col("y").alias("block"), F.lit(1).alias("side")))
    dealt = blocks.join(sides, "block").join(sets, "key").select("x", "y", "side", "key", "members")
    within = stored(large_links(dealt, threshold), "join-within")
    free_finished_shuffles(spark)
    labels = connected_components(links.unionByName(within).where("b is not null").select("a", "b"))
    degree = links.select(F.explode(F.array("a", "b")).alias("node"), F.lit(1).cast("long").alias("n"))
    degree = degree.unionByName(within.where("b is null").select(F.col("a").alias("node"), "n")).groupBy("node").agg(F.sum("n").alias("n_links"))
    # written, so that Spark can split a hot key or label of the joins; texts without words have no key and join nothing
    labels = stored(labels.join(degree, "node").withColumnRenamed("node", "key"), "join-labels")
    joined = every.where("key is not null").select("id", "key").join(labels, "key", "left").withColumn("label", F.coalesce("label", "key"))
    joined = stored(joined.select("id", "label", F.coalesce("n_links", F.lit(0)).alias("n_links")), "join-labelled")
    smallest = stored(joined.groupBy("label").agg(F.min("id").alias("class_id")), "join-smallest")
    found = joined.join(smallest, "label").select("id", "class_id", "n_links")
    alone = every.where("key is null").select("id", F.col("id").alias("class_id"), F.lit(0).cast("long").alias("n_links"))
    return found.unionByName(alone).withColumnRenamed("id", id_col)


def _one_row(classes: DataFrame, wanted: DataFrame) -> DataFrame:
    """``wanted`` (key, ...) with the id and mark of one document of each class."""
    return classes.select("key", F.col("one.id").alias("rep_id"), F.col("one.mark").alias("rep_mark")).join(stored(wanted, "join-wanted"), "key")


def _rows_of(rows: DataFrame, reps: DataFrame) -> DataFrame:
    """text, key and further columns of ``reps``, by the id and mark of their documents."""
    same = F.col("id").eqNullSafe(F.col("rep_id")) & (F.col("mark") == F.col("rep_mark"))
    return rows.join(reps, same).select("text", *[c for c in reps.columns if c not in ("rep_id", "rep_mark")])


def _texts_sets(piece: pa.RecordBatch, shingle: int) -> Iterator[tuple[int, bytes, np.ndarray]]:
    """Row, key and members of the texts that have the key of their row.

    Texts may share an id and a mark: only those with the key count.
    """
    members, first = shingle_sets(piece.column(0), shingle)
    keys = set_keys(members, first)
    for i, key in enumerate(piece.column(1).to_pylist()):
        if key == keys[i]:
            yield i, key, members[first[i] : first[i + 1]]


def _longer_paths(rows: DataFrame, reps: DataFrame, shingle: int, branch: float, depth: int) -> DataFrame:
    """key, size, level, parent and path of all paths below the ``split`` paths, down to ``depth``."""

    def extended(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches, 0):
            keys, sizes, levels, parents, paths = [], [], [], [np.empty(0, np.uint64)], [np.empty(0, np.uint64)]
            for i, key, members in _texts_sets(piece, shingle):
                front = np.array(piece.column(2)[i].as_py(), dtype=np.int64).view(np.uint64)
                for level in range(2, depth + 1):
                    following = []
                    for salt in front:
                        _, found = picked(members, np.float64(len(members)), salt, branch)
                        found = np.unique(found)
                        following.append(found)
                        parents.append(np.full(len(found), salt))
                        keys += [key] * len(found)
                        sizes += [len(members)] * len(found)
                        levels += [level] * len(found)
                    front = np.concatenate(following) if following else front[:0]
                    paths.append(front)
            yield pa.record_batch(
                [pa.array(keys, pa.binary()), pa.array(sizes, pa.int32()), pa.array(levels, pa.int32()), pa.array(np.concatenate(parents).view(np.int64)), pa.array(np.concatenate(paths).view(np.int64))],
                ["key", "size", "level", "parent", "path"],
            )

    return _rows_of(rows, reps).select("text", "key", "split").mapInArrow(extended, "key binary, size int, level int, parent long, path long").distinct()


def _sets_of(rows: DataFrame, reps: DataFrame, shingle: int) -> DataFrame:
    """key and members (see ``packed``) of the ``reps``; a repeated document may repeat its key."""

    def members_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches, 0):
            found = [(key, packed(members)) for _, key, members in _texts_sets(piece, shingle)]
            yield pa.record_batch([pa.array([k for k, _ in found], pa.binary()), pa.array([m for _, m in found], pa.binary())], ["key", "members"])

    return _rows_of(rows, reps).select("text", "key").mapInArrow(members_of, "key binary, members binary")
