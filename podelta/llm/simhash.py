"""SimHash near-duplicates by vantage-point shards (operator 9).

Equal fingerprints are folded first.  A vantage-point tree over a bounded sample of fingerprints cuts the Hamming space into
shards: at each node a fingerprint goes to the inner or the outer side of a radius around the node's point.  By the triangle
inequality two fingerprints within r bits can only be on different sides if each is within r of the radius, so a
fingerprint also visits the other side only there.  Of two sides only inner ones visit outer ones at the node that parts
them, so each pair meets in exactly one shard, where exact distances decide.  A shard passes on a spanning forest of its
links, never all pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import AtomicType

from podelta.llm.common import arrow_schema, batches, free_name, spark_schema, stage
from podelta.llm.components import components

#: Fixed values of the contract.
SHINGLE, SEED, MAX_BITS = 3, 42, 2
#: Fingerprints that a shard should hold, and the bound on those the driver sees to place the tree.
SHARD, SAMPLE = 4096, 65536


# --- fingerprints -------------------------------------------------------------
def fingerprint(text: str | None, size: int = SHINGLE) -> int:
    """64-bit SimHash of the word shingles (repeats count); no word gives 0."""
    words = (text or "").encode().lower().split()  # bytes.lower and split know ASCII only
    if not words:
        return 0
    if len(words) <= size:
        shingles = [b" ".join(words)]
    else:
        shingles = map(b" ".join, zip(*(words[k:] for k in range(size))))
    hashes = np.fromiter((xxhash.xxh64_intdigest(s, SEED) for s in shingles), np.uint64)
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 65536):  # bounded work space, also for very long texts
        ones += np.unpackbits(hashes[at : at + 65536].astype(">u8").view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(hashes)).tobytes(), "big")


def _signed(n: int) -> int:
    return n - (1 << 64) if n >= 1 << 63 else n


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text", size: int = SHINGLE) -> DataFrame:
    """``key``, ``fp`` (the 64 bits as a signed long) and ``text_hash`` (Spark's xxhash64 of the text) per input row."""
    schema = arrow_schema(docs, key, fp=pa.int64(), text_hash=pa.int64())

    def rows(k, t) -> Iterator[tuple]:
        yield k, _signed(fingerprint(t, size)), _signed(xxhash.xxh64_intdigest((t or "").encode(), SEED))

    return docs.select(key, text).mapInArrow(batches(rows, schema), spark_schema(schema))


# --- vantage-point tree -------------------------------------------------------
def distance(a: np.ndarray, b) -> np.ndarray:
    return np.bitwise_count(a ^ b)


def build_tree(sample: np.ndarray, leaf: int, rng: np.random.Generator) -> list[tuple[int, int, int, int]]:
    """Nodes (point, radius, inner, outer); inner and outer are node numbers, or -1 - shard number.

    Of a few candidate points the one is taken whose distances spread most, and the radius is their median.  A sample part
    that no candidate can split becomes one shard.
    """
    nodes: list[list[int]] = []
    shards = 0
    todo: list[tuple[np.ndarray, int, int]] = [(sample, -1, 0)]
    while todo:
        part, parent, side = todo.pop()
        best = None
        if len(part) > leaf:
            for point in part[rng.choice(len(part), size=min(8, len(part)), replace=False)]:
                d = distance(part, point).astype(np.int64)
                radius = int(np.median(d))
                inner = d <= radius
                if inner.all():
                    radius -= 1
                    inner = d <= radius
                near = (np.abs(2 * d - 2 * radius - 1) <= 2 * MAX_BITS).mean()
                cost = abs(inner.mean() - 0.5) + near
                if 0 < inner.sum() < len(part) and (best is None or cost < best[0]):
                    best = (cost, int(point), radius, inner)
        if best is None:
            at = -1 - shards
            shards += 1
        else:
            at = len(nodes)
            nodes.append([best[1], best[2], 0, 0])
            todo += [(part[best[3]], at, 2), (part[~best[3]], at, 3)]
        if parent >= 0:
            nodes[parent][side] = at
    return [tuple(n) for n in nodes]


def route(fps: np.ndarray, nodes, bits: int = MAX_BITS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(place in fps, shard, home flag): each fingerprint's home shard and every shard that it must visit."""
    if not nodes:
        return np.arange(len(fps)), np.zeros(len(fps), np.int32), np.ones(len(fps), bool)
    out = []
    todo = [(0, np.arange(len(fps)), np.ones(len(fps), bool))]
    while todo:
        at, rows, home = todo.pop()
        if at < 0:
            out.append((rows, np.full(len(rows), -1 - at, np.int32), home))
            continue
        if not len(rows):
            continue
        point, radius, inner, outer = nodes[at]
        d = distance(fps[rows], np.uint64(point)).astype(np.int64)
        # Partners of an inner fingerprint reach out to d + bits, those of an outer one in to d - bits.
        inside, far, close = d <= radius, d + bits > radius, d - bits <= radius
        to_inner = inside | (~home & close)
        to_outer = ~inside | far
        todo += [(inner, rows[to_inner], (home & inside)[to_inner]), (outer, rows[to_outer], (home & ~inside)[to_outer])]
    return tuple(np.concatenate(x) for x in zip(*out))


def shard_links(home: np.ndarray, visitors: np.ndarray, bits: int = MAX_BITS) -> list[tuple[int, int]]:
    """Spanning forest of the links that start at home, as edges to each group's least fingerprint.

    Groups grow point by point, and points already in a group leave the comparison, so the work space is one row of
    distances and a dense group of g points costs g rows, not its g * g links.
    """
    rest = np.concatenate([home, visitors])
    taken: set[int] = set()
    edges = []
    for seed in home.tolist():
        if seed in taken:
            continue
        group, at = [seed], 0
        while at < len(group):
            near = distance(rest, np.uint64(group[at])) <= bits
            at += 1
            if at == 1 and np.count_nonzero(near) == 1:
                break
            found = rest[near]
            if len(found):
                rest = rest[~near]
                group += [x for x in found.tolist() if x != seed]
        if len(group) > 1:
            taken.update(group)
            least = min(group)
            edges += [(x, least) for x in group if x != least]
    return edges


def shard_edges(home: np.ndarray, visitors: np.ndarray, bits: int = MAX_BITS, leaf: int = SHARD, sample: int = SAMPLE,
                seed: int = 11) -> Iterator[tuple[int, int]]:
    """Edges that connect the links of one shard; one of far more than ``leaf`` fingerprints is cut by a tree of its own.

    The driver's tree is as large as its sample allows, so beyond that size shards grow with the data; cutting them here
    keeps the comparisons of a fingerprint bounded.
    """
    nodes: list = []
    if len(home) > 4 * leaf:
        rng = np.random.default_rng(seed)
        points = home if len(home) <= sample else rng.choice(home, sample, replace=False)
        nodes = build_tree(points, max(2, leaf * len(points) // len(home)), rng)
    if not nodes:
        yield from shard_links(np.sort(home), visitors, bits)
        return
    every = np.concatenate([home, visitors])
    rows, to, own = route(every, nodes, bits)
    order = np.argsort(to, kind="stable")
    for part in np.split(order, np.flatnonzero(np.diff(to[order])) + 1):
        fps, mine = every[rows[part]], own[part]
        yield from shard_links(np.sort(fps[mine]), fps[~mine], bits)


def link_edges(distinct: DataFrame, bits: int = MAX_BITS, shard: int = SHARD, sample: int = SAMPLE, seed: int = 7) -> DataFrame:
    """Edges (a, b) that connect all fingerprints (column fp, distinct) within ``bits`` of each other.

    The driver sees at most about ``sample`` fingerprints, to place the tree.  The tree has as many shards as the count of
    fingerprints asks for, up to sample / 8; larger shards are cut again within their tasks.
    """
    total = distinct.count()
    shards = min(max(1, -(-total // shard)), max(1, sample // 8))
    nodes: list = []
    if shards > 1:
        share = min(1.0, sample / total)
        picked = distinct.where(F.pmod(F.xxhash64("fp", F.lit(seed)), F.lit(1_000_000)) < int(share * 1_000_000)).select("fp")
        points = np.array([r[0] for r in picked.collect()], np.int64).view(np.uint64)
        points.sort()
        nodes = build_tree(points, max(2, -(-len(points) // shards)), np.random.default_rng(seed))

    def deal(it):
        for batch in it:
            fps = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            rows, to, home = route(fps, nodes, bits)
            yield pa.RecordBatch.from_arrays([pa.array(to, pa.int32()), pa.array(fps[rows].view(np.int64)), pa.array(home)],
                                             names=["shard", "fp", "home"])

    def search(part: pd.DataFrame) -> pd.DataFrame:
        fps = part["fp"].to_numpy(np.int64).view(np.uint64)
        home = part["home"].to_numpy(bool)
        edges = shard_edges(fps[home], fps[~home], bits, shard, sample)
        pairs = np.array(list(edges), np.uint64).reshape(-1, 2).view(np.int64)
        return pd.DataFrame({"a": pairs[:, 0], "b": pairs[:, 1]})

    dealt = distinct.select("fp").mapInArrow(deal, "shard int, fp long, home boolean")
    return dealt.groupBy("shard").applyInPandas(search, "a long, b long")


# --- operator -----------------------------------------------------------------
def _components(fps: DataFrame, key: str, bits: int, shard: int, sample: int) -> DataFrame:
    """(fp, root) for every distinct fingerprint of ``fps``."""
    distinct = stage(fps.select("fp").distinct(), "distinct")
    rooted = components(link_edges(distinct, bits, shard, sample))  # linked fingerprints only
    return stage(distinct.join(rooted.withColumnRenamed("node", "fp"), "fp", "left")
                 .select("fp", F.coalesce("root", "fp").alias("root")), "roots")


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", size: int = SHINGLE, bits: int = MAX_BITS,
                    shard: int = SHARD, sample: int = SAMPLE) -> DataFrame:
    """(key, fp, component): ``component`` is the least key that links of at most ``bits`` bits reach from the row's text.

    Every input row gives one row.  Null and empty texts have fingerprint 0 and link like others; null keys stay and count
    as no key for the minimum (a component of null keys only has a null component); repeated rows share their component;
    an empty table gives no rows.  Other columns are neither read nor returned.
    """
    fps = stage(fingerprints(docs, key, text, size), "fingerprints")
    roots = _components(fps, key, bits, shard, sample)
    least = fps.groupBy("fp").agg(F.min(key).alias("least")).join(roots, "fp")
    by_root = least.groupBy("root").agg(F.min("least").alias("component"))
    by_fp = stage(roots.join(by_root, "root").select("fp", "component"), "labels")
    return fps.join(by_fp, "fp").select(key, "fp", "component")


def keep_one(docs: DataFrame, key: str = "doc_id", text: str = "text", size: int = SHINGLE, bits: int = MAX_BITS,
             shard: int = SHARD, sample: int = SAMPLE) -> DataFrame:
    """One row of each near-duplicate component of ``docs``, all columns unchanged: that of the least (key, text hash).

    Keys order before null, so a row without a key stays only if its whole component has none.  Of rows that agree in key
    and text the least by their other columns stays.  Texts are shuffled once, by key and text hash.
    """
    fps = stage(fingerprints(docs, key, text, size), "fingerprints")
    roots = _components(fps, key, bits, shard, sample)
    rank = F.struct(F.col(key).isNull().alias("none"), F.col(key).alias("key"), F.col("text_hash"))
    groups = fps.groupBy("fp").agg(F.min(rank).alias("first"), F.count("*").alias("n")).join(roots, "fp")
    chosen = groups.groupBy("root").agg(F.min("first").alias("first")).select("first.key", "first.text_hash")
    counts = fps.groupBy(F.col(key).alias("key"), "text_hash").agg(F.count("*").alias("rows"))
    mark = free_name(docs, "chosen")
    chosen = stage(chosen.alias("c").join(counts.alias("n"), F.col("c.key").eqNullSafe(F.col("n.key"))
                                          & (F.col("c.text_hash") == F.col("n.text_hash")))
                   .select(F.struct(F.col("c.key").alias("key"), F.col("c.text_hash").alias("hash"), "rows").alias(mark)), "chosen")
    hashed = F.xxhash64(F.coalesce(docs[text], F.lit("")))
    kept = docs.join(chosen, docs[key].eqNullSafe(F.col(f"{mark}.key")) & (hashed == F.col(f"{mark}.hash")))
    once = kept.where(F.col(f"{mark}.rows") == 1).select(*[F.col(f"`{c}`") for c in docs.columns])
    # Of rows that agree in key and text the least by all other columns stays, whichever task sees it first.
    order = [F.col(f"`{f.name}`") for f in docs.schema if f.name not in (key, text) and isinstance(f.dataType, AtomicType)]
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    rank = F.struct(*[c.isNull() for c in order], *order, F.col(f"`{text}`").isNull(), F.xxhash64(F.to_json(row)))
    repeated = (kept.where(F.col(f"{mark}.rows") > 1).groupBy(mark).agg(F.min_by(row, rank).alias(mark + "_row"))
                .select(*[F.col(f"{mark}_row.`{c}`").alias(c) for c in docs.columns]))
    return once.unionAll(repeated)
