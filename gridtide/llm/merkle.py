"""Merkle manifest of a table: one tree of hashes per tree key, one tree over their roots.

Nested-interval labels: leaves get their rank in their tree, and every node carries the
interval [lo, hi) of the leaf ranks that it covers. That is all the structure there is: the
parent of a node is the node of the next level whose interval contains its own, and its siblings
are what is left of the parent's interval without it.

1. ``leaf_hash``: a hash per row, in the JVM.
2. ``ranked``: a range-partitioned sort, numbered inside each partition; a small table of
   counts per (tree, partition) carries the numbers on from one partition to the next, so no
   tree, however large, is in one task.
3. ``manifest``: nodes level by level. Levels are taken in tiers of ``depth`` levels; the
   interval of a tier's topmost node is a bucket, and a bucket is one small group: it holds all
   nodes of the tier in that interval, at most ``fanout ** depth`` at the bottom.
4. ``prove``: from the top tier down, buckets meet the path above them (one row per bucket)
   by an equi-join on (tree, tier, bucket); inside, a containment join of intervals attaches the
   ancestors level by level.
"""

from __future__ import annotations

from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from gridtide.llm.rows import column
from gridtide.staging import stage

DEPTH = 10
NODE = "tree string, size long, level int, lo long, hi long, digest string"
STEP = "array<struct<left:string,right:string>>"
PATH = f"tree string, lo long, subroot string, root string, path {STEP}"
STEP_TYPE = pa.list_(pa.struct([("left", pa.string()), ("right", pa.string())]))
PROOF = "key long, tree string, lo long, leaf string, subroot string, root string, proof string, folded string"


def field(value: Column) -> Column:
    """``-`` for null, else the length in UTF-8 bytes, a colon and the value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_hash(values: list[Column]) -> Column:
    """SHA-256 (hex) of all fields one after the other."""
    return F.sha2(F.concat(*(field(v) for v in values)), 256)


def digest_of(parts: list[str]) -> str:
    """SHA-256 (hex) of hex digests one after the other."""
    return sha256("".join(parts).encode()).hexdigest()


def ranked(rows: DataFrame, order: list[str]) -> DataFrame:
    """``rows`` (with ``tree``) with ``lo``, the rank from 0 in their tree by ``order``, and
    ``size``, the number of rows of the tree. Rows must come from a written table; equal ones are
    told apart by their place in it, which also spreads them over partitions."""
    placed = rows.withColumn("row_place", F.monotonically_increasing_id())
    by = ["tree", *order, "row_place"]
    sorted_rows = stage(
        placed.repartitionByRange(*by)
        .sortWithinPartitions(*by)
        .withColumn("at", F.monotonically_increasing_id())
        .withColumn("part", F.shiftright("at", 33).cast("int"))
        .drop("row_place"),
        "merkle-sorted",
    )
    # one row for each partition that a tree touches
    counts = sorted_rows.groupBy("tree", "part").agg(
        F.min("at").alias("first_at"), F.count(F.lit(1)).alias("n")
    )
    before = F.expr(
        "coalesce(sum(n) over (partition by tree order by part "
        "rows between unbounded preceding and 1 preceding), 0)"
    )
    offsets = counts.withColumn("before", before).select(
        F.col("tree").alias("of_tree"), F.col("part").alias("of_part"), "first_at", "before",
        F.expr("sum(n) over (partition by tree)").alias("size"),
    )
    same = F.col("tree").eqNullSafe(F.col("of_tree")) & (F.col("part") == F.col("of_part"))
    return (
        sorted_rows.join(offsets, same)
        .withColumn("lo", F.col("at") - F.col("first_at") + F.col("before"))
        .drop("of_tree", "of_part", "first_at", "before", "at", "part")
    )


def _cover(level: int, fanout: int, index: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    width = fanout ** level
    return index * width, np.minimum((index + 1) * width, size)


def _build(fanout: int, depth: int):
    def run(table: pa.Table) -> pa.Table:
        """All nodes above those of one bucket, as far as its tier goes."""
        order = table.sort_by("lo")
        lo = order.column("lo").to_numpy()
        digests = order.column("digest").to_pylist()
        tree, size = order.column("tree")[0].as_py(), order.column("size")[0].as_py()
        base = order.column("level")[0].as_py()
        index = lo // fanout ** base
        rows: dict[str, list] = {name: [] for name in ("level", "lo", "hi", "digest")}
        for level in range(base + 1, base + depth + 1):
            if -(-size // fanout ** (level - 1)) == 1:  # one node was left: the root
                break
            parent = index // fanout
            heads = np.flatnonzero(np.concatenate([[True], parent[1:] != parent[:-1]]))
            ends = np.append(heads[1:], len(parent))
            digests = [digest_of(digests[a:b]) for a, b in zip(heads.tolist(), ends.tolist())]
            index = parent[heads]
            low, high = _cover(level, fanout, index, size)
            rows["level"] += [level] * len(index)
            rows["lo"] += low.tolist()
            rows["hi"] += high.tolist()
            rows["digest"] += digests
        n = len(rows["level"])
        return pa.table(
            {
                "tree": pa.array([tree] * n, pa.string()),
                "size": pa.array([size] * n, pa.int64()),
                "level": pa.array(rows["level"], pa.int32()),
                "lo": pa.array(rows["lo"], pa.int64()),
                "hi": pa.array(rows["hi"], pa.int64()),
                "digest": pa.array(rows["digest"], pa.string()),
            }
        )

    return run


def tiers(size: int, fanout: int, depth: int) -> int:
    """Tiers that a tree of ``size`` leaves needs, at least one."""
    count = 1
    while size > fanout ** (depth * count):
        count += 1
    return count


def manifest(leaf_rows: DataFrame, most: int, fanout: int, depth: int) -> DataFrame:
    """All nodes of all trees above their leaves (tree, size, level, lo, hi, digest); the leaves
    (tree, size, lo, digest) are level 0. ``most``: the largest size."""
    below = leaf_rows.select("tree", "size", F.lit(0).alias("level"), "lo", "digest")
    out = None
    for tier in range(tiers(most, fanout, depth)):
        span = fanout ** (depth * (tier + 1))
        made = stage(_bucketed(below, span).applyInArrow(_build(fanout, depth), NODE), "merkle-nodes")
        below = made.where(F.col("level") == depth * (tier + 1)).drop("hi")
        out = made if out is None else out.unionByName(made)
    return out


def _containing(lo: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Which of the sorted, gapless intervals holds each point."""
    return np.searchsorted(starts, lo, side="right") - 1


def steps_of_bucket(nodes: pa.Table, base: int) -> tuple[np.ndarray, list[list[dict]], list[int]]:
    """Siblings of each node of the lowest level of a bucket, level by level, and the row of each
    in ``lo`` order: ranks, steps, and rows of ``nodes``.

    An ancestor is the node of a level whose interval contains the rank; what its parent's
    interval holds besides its own, on its own level, are its siblings."""
    level = nodes.column("level").to_numpy()
    lo, hi = nodes.column("lo").to_numpy(), nodes.column("hi").to_numpy()
    digest = nodes.column("digest").to_pylist()
    at: dict[int, np.ndarray] = {}
    for one in np.unique(level).tolist():
        rows = np.flatnonzero(level == one)
        at[one] = rows[np.argsort(lo[rows], kind="stable")]
    ranks = lo[at[base]]
    paths: list[list[dict]] = [[] for _ in range(len(ranks))]
    for one in sorted(at)[:-1]:
        below, above = at[one], at[one + 1]
        parent = above[_containing(lo[below], lo[above])]
        first = np.searchsorted(lo[below], lo[parent], side="left")
        last = np.searchsorted(lo[below], hi[parent], side="left")
        names = [digest[i] for i in below.tolist()]
        step = [
            {"left": "".join(names[a:i]), "right": "".join(names[i + 1: b])}
            for i, (a, b) in enumerate(zip(first.tolist(), last.tolist()))
        ]
        for path, own in zip(paths, _containing(ranks, lo[below]).tolist()):
            path.append(step[own])
    return ranks, paths, at[base].tolist()


def _above(above: pa.Table) -> tuple[list[dict], str | None, str | None]:
    """The path from a bucket's topmost node to the root, if there is more above."""
    if not above.num_rows:
        return [], None, None
    row = above.slice(0, 1).to_pylist()[0]
    return row["path"], row["subroot"], row["root"]


def _top(nodes: pa.Table) -> str:
    """The digest of the highest node of a bucket."""
    row = int(np.argmax(nodes.column("level").to_numpy()))
    return nodes.column("digest")[row].as_py()


def _paths(nodes: pa.Table, above: pa.Table) -> pa.Table:
    if not nodes.num_rows:  # a tree that ends below this tier
        return above.select(["tree", "lo", "subroot", "root", "path"])
    base = int(nodes.column("level").to_numpy().min())
    ranks, paths, _ = steps_of_bucket(nodes, base)
    upper, subroot, root = _above(above)
    n, top = len(ranks), _top(nodes)
    return pa.table(
        {
            "tree": pa.array([nodes.column("tree")[0].as_py()] * n, pa.string()),
            "lo": pa.array(ranks, pa.int64()),
            "subroot": pa.array([subroot or top] * n, pa.string()),
            "root": pa.array([root or top] * n, pa.string()),
            "path": pa.array([path + upper for path in paths], STEP_TYPE),
        }
    )


def folded(start: str, path: list[dict]) -> str:
    """The root that a leaf's hash and its siblings give."""
    for step in path:
        start = sha256(f"{step['left']}{start}{step['right']}".encode()).hexdigest()
    return start


def _prove(nodes: pa.Table, above: pa.Table) -> pa.Table:
    names = ("key", "lo", "leaf", "subroot", "root", "proof", "folded")
    out: dict[str, list] = {name: [] for name in names}
    tree = None
    if nodes.num_rows:
        tree = nodes.column("tree")[0].as_py()
        ranks, paths, rows = steps_of_bucket(nodes, 0)
        upper, subroot, root = _above(above)
        top, tail = _top(nodes), "".join(step["left"] + step["right"] for step in upper)
        digest, offered = nodes.column("digest").to_pylist(), nodes.column("offered").to_pylist()
        key = nodes.column("key").to_pylist()
        for lo, path, row in zip(ranks.tolist(), paths, rows):
            siblings = "".join(step["left"] + step["right"] for step in path) + tail
            end = folded(folded(offered[row], path), upper)
            values = (key[row], lo, digest[row], subroot or top, root or top, sha256(siblings.encode()).hexdigest(), end)
            for column, value in zip(out.values(), values):
                column.append(value)
    kinds = {"key": pa.int64(), "lo": pa.int64()}
    columns = {name: pa.array(values, kinds.get(name, pa.string())) for name, values in out.items()}
    trees = pa.array([tree] * len(out["lo"]), pa.string())
    return pa.table({"key": columns.pop("key"), "tree": trees, **columns})


def _bucketed(rows: DataFrame, span: int):
    return rows.groupBy("tree", F.floor(F.col("lo") / F.lit(span)).alias("bucket"))


def paths(leaf_rows: DataFrame, nodes: DataFrame, most: int, above: DataFrame | None, fanout: int,
          depth: int, lowest: int = 0) -> DataFrame:
    """(tree, lo, subroot, root, path) of all nodes at the bottom of tier ``lowest``. ``above``
    has those columns for the root of each tree, where a tree hangs below another."""
    leaf_nodes = leaf_rows.select(
        "tree", "size", F.lit(0).alias("level"), "lo", (F.col("lo") + 1).alias("hi"), "digest"
    )
    everything = leaf_nodes.unionByName(nodes)
    count = tiers(most, fanout, depth)
    for tier in range(count - 1, lowest - 1, -1):
        here = _tier(everything, tier, depth)
        span = fanout ** (depth * (tier + 1))
        upper = above if above is not None else _no_paths(leaf_rows)
        above = stage(
            _bucketed(here, span).cogroup(_bucketed(upper, span)).applyInArrow(_paths, PATH), "merkle-paths"
        )
    return above if above is not None else _no_paths(leaf_rows)


def _tier(nodes: DataFrame, tier: int, depth: int) -> DataFrame:
    """Nodes of a tier, its lowest level included."""
    low = depth * tier
    return nodes.where(F.col("level").between(low, low + depth))


def _no_paths(rows: DataFrame) -> DataFrame:
    return rows.sparkSession.createDataFrame([], PATH)


def _most(leaf_rows: DataFrame) -> int:
    return leaf_rows.agg(F.max("size")).first()[0] or 0


def prove(leaf_rows: DataFrame, fanout: int = 2, depth: int = DEPTH) -> DataFrame:
    """For ranked leaves (key, tree, size, lo, digest, offered): leaf, subroot (of its tree), root (of the
    tree over the subroots in the order of the tree keys, null first), proof (hash of all
    siblings, bottom-up and left to right) and folded, the root that ``offered`` gives with those
    siblings."""
    if fanout < 2 or depth < 1:
        raise ValueError("a run has at least two nodes, a tier one level")
    most = _most(leaf_rows)
    if not most:
        return leaf_rows.sparkSession.createDataFrame([], PROOF)
    nodes = manifest(leaf_rows, most, fanout, depth)
    # the root of a tree covers all its leaves; a lone leaf is its own root
    tops = nodes.where("lo = 0 and hi = size").select("tree", "digest")
    lone = leaf_rows.where("size = 1").select("tree", "digest")
    subroots = stage(tops.unionByName(lone), "merkle-subroots")

    # the tree over the trees: the same again, under one key
    named = subroots.select(F.lit("").alias("tree"), F.col("tree").alias("name"), "digest")
    crown = stage(ranked(named, ["name"]), "merkle-crown")
    crowns = _most(crown)
    crown_nodes = manifest(crown, crowns, fanout, depth)
    crown_paths = paths(crown, crown_nodes, crowns, None, fanout, depth)
    above = stage(
        crown.join(crown_paths, "lo").select(
            F.col("name").alias("tree"), F.lit(0).cast("long").alias("lo"),
            crown["digest"].alias("subroot"), "root", "path",
        ),
        "merkle-crown-paths",
    )

    # Every tier's topmost bucket begins at 0, also in trees that end below that tier.
    upper = paths(leaf_rows, nodes, most, above, fanout, depth, lowest=1)
    leaf_nodes = leaf_rows.select(
        "tree", "size", F.lit(0).alias("level"), "lo", (F.col("lo") + 1).alias("hi"), "digest",
        "offered", "key",
    )
    here = leaf_nodes.unionByName(_tier(nodes, 0, depth), allowMissingColumns=True)
    span = fanout ** depth
    return _bucketed(here, span).cogroup(_bucketed(upper, span)).applyInArrow(_prove, PROOF)


def documents_manifest(docs: DataFrame, fanout: int = 2, depth: int = DEPTH) -> DataFrame:
    """Proof of each document: doc_id, leaf, subroot, root, proof_sha256, folded_root, verified.

    A leaf hashes doc_id, source, lang, n_chars and text; a tree per lang, in order of doc_id
    (null first, equal ids by hash, equal rows as they lie). ``folded_root`` starts from a leaf
    with n_chars + 1 where 7 divides the CRC-32 of the decimal doc_id, else from the leaf;
    ``verified`` tells whether it is the root. Null values hash as ``-``, so a null and an empty
    text differ; repeated rows are leaves of their own; texts are hashed whole; other columns are
    not read; a table without rows gives none. ``depth`` changes the way, not the result.
    """
    names = ["doc_id", "source", "lang", "n_chars", "text"]
    columns = {name: column(docs, name) for name in names}
    tampered = F.crc32(columns["doc_id"].cast("string").cast("binary")) % 7 == 0
    leaf = leaf_hash(list(columns.values()))
    raised = leaf_hash([v + 1 if n == "n_chars" else v for n, v in columns.items()])
    rows = stage(
        docs.select(
            columns["doc_id"].cast("long").alias("key"), columns["lang"].cast("string").alias("tree"),
            leaf.alias("digest"), F.when(tampered, raised).alias("raised"),
        ),
        "merkle-leaves",
    )
    placed = stage(
        ranked(rows, ["key", "digest"])
        .withColumn("offered", F.coalesce("raised", "digest"))
        .drop("raised"),
        "merkle-ranked",
    )
    return prove(placed, fanout, depth).select(
        F.col("key").alias("doc_id"), "leaf", "subroot", "root", F.col("proof").alias("proof_sha256"),
        F.col("folded").alias("folded_root"), (F.col("folded") == F.col("root")).alias("verified"),
    )
