"""Near-duplicate documents by MinHash.

1. A text's set of word shingles gives universal hash minima, in bands of ``ROWS``. Equal sets are one class.
2. Classes that agree in all minima of a band are candidates. There are as many bands as it takes for a pair at the
   threshold to meet in one but for a chance of ``MISS``: 28 at a similarity of 0.85, 44 at 0.8.
3. Within a band's bucket, signatures are compared (one byte of each minimum). Of the pairs with enough equal bytes (a
   pair at the threshold has fewer with a chance of ``MISS`` at most) only as many are emitted as keep them connected,
   so a bucket emits fewer links than it has members. Their connected components are clusters: all links lie inside
   clusters.
4. Within a cluster, pairs are confirmed on the full sets, again emitting only what keeps members connected.
5. Components of the confirmed links, by alternating large-star and small-star.

Small buckets and clusters are packed into groups of bounded size. One of more than ``BLOCK`` members is dealt into
blocks, and each two blocks meet in a group of their own: no group grows with the data, and no pair is left out.
"""

from __future__ import annotations

import functools
import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from platework.llm.common import (
    WordHashes, as_bytes, in_batches, mixed, row_hash, same, stored, window_hashes,
)

SHINGLE, PERCENT = 5, 85
ROWS = 6
#: Chance that a pair at the threshold shares no band, and that its signatures have too few equal bytes.
MISS = 2e-6
BLOCK, GROUP_ROWS, GROUP_BYTES, LEAST_GROUPS = 4_096, 5_000, 2 << 20, 32
#: Shingles hashed at once: small enough for the processor's cache.
SLICE = 1 << 15


@functools.lru_cache(maxsize=16)
def shape(percent: int) -> tuple[int, int]:
    """Number of bands, and of equal signature bytes from which a pair is compared on its sets."""
    if not 0 < percent <= 100:
        raise ValueError(f"percent is {percent}, not in 1 to 100")
    share = percent / 100
    bands = 1 if percent == 100 else math.ceil(math.log(MISS) / math.log1p(-(share**ROWS)))
    size, equal = bands * ROWS, share + (1 - share) / 256
    if percent == 100:
        return bands, size
    below, least = 0.0, 0
    while True:  # the binomial distribution of equal bytes, in logarithms
        below += math.exp(
            math.lgamma(size + 1) - math.lgamma(least + 1) - math.lgamma(size - least + 1)
            + least * math.log(equal) + (size - least) * math.log1p(-equal))
        if below > MISS:
            return bands, least
        least += 1


@functools.lru_cache(maxsize=16)
def _family(size: int) -> tuple[np.ndarray, np.ndarray]:
    """Factors and shifts of so many hash functions."""
    rng = np.random.default_rng(20_240_229)
    factors = rng.integers(0, 1 << 32, size, dtype=np.uint32) | np.uint32(1)
    return factors, rng.integers(0, 1 << 32, size, dtype=np.uint32)


def shingle_set(text: bytes, known: WordHashes, width: int = SHINGLE) -> np.ndarray:
    """Sorted distinct hashes of the shingles; fewer words than a shingle are one shingle, no words none."""
    words = text.lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    return np.unique(window_hashes(known.of(words), min(width, len(words))))


def minima(sets: list[np.ndarray], percent: int = PERCENT) -> np.ndarray:
    """A row of hash minima for each non-empty set, as many as the threshold takes."""
    factors, shifts = _family(shape(percent)[0] * ROWS)
    out = np.empty((len(sets), len(factors)), np.uint32)
    at = 0
    while at < len(sets):
        to, size = at, 0
        while to < len(sets) and (size == 0 or size + len(sets[to]) <= SLICE):
            size += len(sets[to])
            to += 1
        x = (np.concatenate(sets[at:to]) >> np.uint64(32)).astype(np.uint32)
        starts = np.cumsum([0, *map(len, sets[at : to - 1])])
        for k in range(len(factors)):
            out[at:to, k] = np.minimum.reduceat(x * factors[k] + shifts[k], starts)
        at = to
    return out


def sketches(df: DataFrame, id_column: str, text_column: str, percent: int = PERCENT) -> DataFrame:
    """Per row: id, ``text_hash``, ``n_shingles`` and, for a set that isn't empty, its digest, bands and signature."""
    kind = df.schema[id_column].dataType.simpleString()
    rows = df.select(
        F.col(id_column).alias("id"), row_hash(text_column).alias("text_hash"), F.col(text_column).alias("text"))
    known = WordHashes()

    def run(batch):
        sets = [shingle_set(t or b"", known) for t in as_bytes(batch["text"])]
        full = [k for k, s in enumerate(sets) if len(s)]
        low = minima([sets[k] for k in full], percent)
        keys = np.zeros((len(full), low.shape[1] // ROWS), np.uint64)
        for r in range(ROWS):
            keys = mixed(keys * np.uint64(31) + low[:, r::ROWS].astype(np.uint64) + np.uint64(r + 1))
        signature = ((low ^ (low >> 11) ^ (low >> 21)) & 0xFF).astype(np.uint8)
        digests, bands, signatures = ([None] * len(sets) for _ in range(3))
        for place, k in enumerate(full):
            digests[k] = xxhash.xxh3_128_digest(sets[k].tobytes())
            bands[k] = keys[place].view(np.int64)
            signatures[k] = signature[place].tobytes()
        return {
            "id": batch["id"], "text_hash": batch["text_hash"], "n_shingles": np.array([len(s) for s in sets], np.int64),
            "node": digests, "bands": pa.array(bands, pa.list_(pa.int64())), "signature": signatures}

    return in_batches(
        rows, run,
        f"id {kind}, text_hash long, n_shingles long, node binary, bands array<long>, signature binary")


def spanning(
    signatures: np.ndarray, least: int, confirm=None, left: np.ndarray | None = None,
) -> list[tuple[int, int]]:
    """Links that connect whatever pairs with ``least`` equal bytes (that ``confirm`` holds true for) connect.

    ``left`` tells of which of two blocks each member is; then only pairs across the blocks count.
    """
    size, out = len(signatures), []
    if size == 2 and left is None:
        likely = (signatures[0] == signatures[1]).sum() >= least
        return [(0, 1)] if likely and (confirm is None or confirm(0, 1)) else []
    unseen = np.arange(size)
    while len(unseen) > 1:
        queue, unseen = [int(unseen[0])], unseen[1:]
        while queue and len(unseen):
            u = queue.pop()
            near = (signatures[unseen] == signatures[u]).sum(axis=1) >= least
            if left is not None:
                near &= left[unseen] != left[u]
            if confirm is not None and near.any():
                near[near] = [confirm(u, int(v)) for v in unseen[near]]
            for v in unseen[near].tolist():
                out.append((u, v))
                queue.append(v)
            unseen = unseen[~near]
    return out


def dealt(members: DataFrame, keys: list[str], groups: int) -> DataFrame:
    """``members`` (keys, ``n`` members of the key) with the group each row goes to (``part``), and for keys of more
    than BLOCK members the two blocks that meet there (``one``, ``two``) and the row's own (``block``)."""
    blocks = F.ceil(F.col("n") / BLOCK).cast("int")
    own = F.pmod(F.xxhash64("node"), blocks.cast("long")).cast("int")
    small = members.where(F.col("n") <= BLOCK).select(
        "*", F.pmod(F.xxhash64(*keys), F.lit(groups)).alias("part"),
        F.lit(0).alias("one"), F.lit(0).alias("two"), F.lit(0).alias("block"))
    large = members.where(F.col("n") > BLOCK).withColumns({"block": own, "blocks": blocks})
    large = large.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).withColumns({
        "one": F.least("block", "other"), "two": F.greatest("block", "other")})
    large = large.withColumn("part", F.xxhash64(*keys, "one", "two")).select(*small.columns)
    return small.unionByName(large)


def _linked(rows: DataFrame, keys: list[str], with_sets: bool, percent: int) -> DataFrame:
    """Links within each key of the rows that meet in a group."""
    bands, least = shape(percent)

    def run(table: pa.Table) -> pa.Table:
        places = table.select([*keys, "one", "two"]).to_pandas()
        order = places.sort_values(list(places.columns), kind="stable").index.to_numpy()
        places = places.loc[order]
        new = (places != places.shift()).any(axis=1).to_numpy()
        starts = np.append(np.flatnonzero(new), len(order))
        nodes, found = table["node"].to_pylist(), set()
        width = bands * ROWS
        signatures = np.frombuffer(b"".join(table["signature"].to_pylist()), np.uint8).reshape(-1, width)
        block = table["block"].to_numpy()
        sets = [np.frombuffer(x, np.uint64) for x in table["members"].to_pylist()] if with_sets else None

        def confirmed(at, a, b):
            x, y = sets[at[a]], sets[at[b]]
            if 100 * min(len(x), len(y)) < percent * max(len(x), len(y)):
                return False
            both = len(np.intersect1d(x, y, assume_unique=True))
            return 100 * both >= percent * (len(x) + len(y) - both)

        for a, b in zip(starts[:-1], starts[1:], strict=True):
            at = order[a:b]
            if len(at) < 2:
                continue
            crossing = int(places["one"].iloc[a]) != int(places["two"].iloc[a])
            links = spanning(
                signatures[at], least, (lambda i, j, at=at: confirmed(at, i, j)) if with_sets else None,
                block[at] if crossing else None)
            found.update(tuple(sorted((nodes[at[i]], nodes[at[j]]))) for i, j in links)
        pairs = list(found)
        return pa.table(
            {"a": [x for x, _ in pairs], "b": [y for _, y in pairs]},
            schema=pa.schema([("a", pa.binary()), ("b", pa.binary())]))

    return rows.groupBy("part").applyInArrow(run, "a binary, b binary").distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, component) of every node in a link: the component is its smallest node. Alternates large-star and
    small-star until the links no longer change; each step is written to the shared folder."""
    def fingerprint(df):
        row = df.agg(F.count("*").alias("n"), F.sum(F.xxhash64("high", "low").cast("decimal(20,0)")).alias("h")).first()
        return row.n, row.h

    edges = stored(
        links.select(F.greatest("a", "b").alias("high"), F.least("a", "b").alias("low")).where("high != low").distinct(),
        "links")
    state = fingerprint(edges)
    while state[0]:
        both = edges.select(F.col("high").alias("u"), F.col("low").alias("v")).unionByName(
            edges.select(F.col("low").alias("u"), F.col("high").alias("v")))
        # Stored, so that both sides of the join are shuffled for it, and a node with very many links can be split.
        least = stored(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), "least")
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("high"), F.col("m").alias("low")).distinct()
        large = stored(large, "large")
        lowest = stored(large.groupBy("high").agg(F.min("low").alias("m")), "lowest")
        small = large.join(lowest, "high").where("low != m").select(F.col("low").alias("high"), F.col("m").alias("low"))
        edges = stored(small.unionByName(lowest.withColumnRenamed("m", "low")).distinct(), "links")
        before, state = state, fingerprint(edges)
        if state == before:
            break
    return edges.select(F.col("high").alias("node"), F.col("low").alias("component")).unionByName(
        edges.select(F.col("low").alias("node"), F.col("low").alias("component")).distinct())


def near_duplicates(
    df: DataFrame, id_column: str = "doc_id", text_column: str = "text", percent: int = PERCENT,
) -> DataFrame:
    """Per row: id, ``text_hash``, ``n_shingles``, ``component_id`` (smallest id reachable by links) and ``kept``.

    Texts are linked if ``100 * intersection >= percent * union`` of their shingle sets. Null, empty and wordless texts
    have no shingles, are linked with nothing and kept. Equal sets are linked. A row without an id passes links on and
    has the smallest id reachable, if any; it is kept only if there is none. Rows that share an id are judged each by
    its text. Repeated rows each come back. An empty table gives an empty result; other columns are not read.
    """
    all_rows = stored(sketches(df, id_column, text_column, percent), "sketches")
    kind = df.schema[id_column].dataType.simpleString()
    classes = stored(
        all_rows.where("node is not null").groupBy("node").agg(
            F.min("id").alias("low"), F.max(F.struct("id", "text_hash")).alias("example"),
            F.first("n_shingles").alias("n_shingles"), F.first("bands").alias("bands"),
            F.first("signature").alias("signature")), "classes")

    # Counted before the shuffle, then joined: a bucket that a third of the classes share can be split.
    in_bands = classes.select("node", F.posexplode("bands").alias("band", "key"))
    busy = stored(in_bands.groupBy("band", "key").agg(F.count("*").alias("n")).where("n > 1"), "busy")
    members = stored(in_bands.join(busy, ["band", "key"]).select("node", "band", "key", "n"), "buckets")
    groups = members.count() // GROUP_ROWS + LEAST_GROUPS
    signed = dealt(members, ["band", "key"], groups).join(classes.select("node", "signature"), "node")
    clusters = components(_linked(signed, ["band", "key"], False, percent))

    clusters = stored(clusters, "components")
    counted = clusters.join(stored(clusters.groupBy("component").agg(F.count("*").alias("n")), "sizes"), "component")
    known = stored(counted.join(classes.drop("bands", "low"), "node"), "clusters")
    held = WordHashes()
    wanted = known.select("node", F.col("example.id").alias("id"), F.col("example.text_hash").alias("text_hash"))
    texts = df.select(
        F.col(id_column).alias("id"), row_hash(text_column).alias("text_hash"), F.col(text_column).alias("text"))
    texts = texts.join(wanted, same(texts, wanted, "id", "text_hash")).select("node", "text")
    sets = in_batches(
        texts, lambda batch: {
            "node": batch["node"],
            "members": [shingle_set(t or b"", held).tobytes() for t in as_bytes(batch["text"])]},
        "node binary, members binary").groupBy("node").agg(F.first("members").alias("members"))
    size = known.agg(F.sum("n_shingles")).first()[0] or 0
    grouped = dealt(known.select("node", "component", "n", "signature"), ["component"], 8 * size // GROUP_BYTES + LEAST_GROUPS)
    links = _linked(grouped.join(sets, "node"), ["component"], True, percent)
    found = components(links)

    of = classes.select("node", "low").join(found, "node", "left").withColumn("component", F.coalesce("component", "node"))
    lowest = of.groupBy("component").agg(F.min("low").alias("component_id"))
    of = of.join(lowest, "component").select("node", "component_id")
    out = all_rows.join(of, "node", "left").select(
        F.col("id"), "text_hash", "n_shingles",
        F.coalesce("component_id", "id").cast(kind).alias("component_id"))
    return out.withColumn("kept", F.col("id").eqNullSafe(F.col("component_id"))).withColumnRenamed("id", id_column)


def one_of_each(df: DataFrame, id_column: str = "doc_id", text_column: str = "text", **options) -> DataFrame:
    """The rows of ``df`` with all their columns, one of each group: the smallest id, of rows that repeat one."""
    found = near_duplicates(df, id_column, text_column, **options)
    # Only the rows that go are written: the kept ones are read again from ``df``, not copied whole to disk.
    out = stored(
        found.where(~F.col("kept")).select(F.col(id_column).alias("__id"), F.col("text_hash").alias("__hash")).distinct(),
        "not-kept")
    rows = df.withColumns({"__id": F.col(id_column), "__hash": row_hash(text_column)})
    left = rows.join(out, same(rows, out, "__id", "__hash"), "left_anti")
    return left.select(*[f"`{c}`" for c in df.columns])
