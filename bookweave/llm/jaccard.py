"""N-gram Jaccard join over count vectors.

A document is its set of word shingles. Shingles are hashed into groups and the groups' counts over the
whole corpus put all shingles into one order, the rarest first. Two sets that overlap enough share one of
the first few shingles of each, so documents meet in a block for each of these. In a block every set is
first compared with the one that stands most in its middle. Where that leaves a block in several parts,
its sets are points, the counts of their shingles in each of a fixed number of groups: an R-tree over the
points bounds the overlap of sets below its nodes by the sum of coordinate minima, and pairs of different
parts that survive are verified on the sets themselves. Only verified links make components.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bookweave.llm.common import drop_kept, small_batches, stored, table
from bookweave.llm.components import components

#: Coordinates of a point (a power of two), and rows of a leaf of the R-tree at most.
COORDINATES, FANOUT = 64, 64
#: Bytes of text for each group of the corpus-wide counts, and the least and most groups (as powers of two): a table of 64 MB at most.
GROUP_BYTES, LEAST_GROUPS, MOST_GROUPS = 128, 16, 24
#: Members of a block (by the counts) beyond which it is dealt out in parts; points that one task joins at once; sets that one task compares with a hub.
HOT, TILE, CHUNK = 50_000, 20_000, 512

_U = np.uint64
_LOWER = bytes(i + 32 if 65 <= i <= 90 else i for i in range(256))
_SPACE = np.isin(np.arange(256), [32, 9, 10, 11, 12, 13])
_P = 0x9E3779B97F4A7C15 | 1
_POWERS: list[np.ndarray] = []


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd number modulo 2**64, and of its inverse."""
    if not _POWERS or len(_POWERS[0]) < n:
        n = max(n, 1 << 16) * 2
        inverse = pow(_P, -1, 1 << 64)
        _POWERS[:] = [np.cumprod(np.append(_U(1), np.full(n, p, _U)), dtype=_U) for p in (_P, inverse)]
    return _POWERS[0], _POWERS[1]


def shingles(text: str | None, width: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of all runs of `width` words, A-Z in lower case; of the whole sequence if it is shorter."""
    raw = np.frombuffer((text or "").encode("utf-8", "surrogatepass").translate(_LOWER), np.uint8)
    word = ~_SPACE[raw]
    edge = np.flatnonzero(np.diff(np.concatenate(([False], word, [False])).astype(np.int8)))
    starts, ends = edge[::2], edge[1::2]
    if not len(starts):
        return np.zeros(0, _U)
    up, down = _powers(len(raw) + 1)
    sums = np.append(_U(0), np.cumsum((raw.astype(_U) + _U(1)) * up[: len(raw)], dtype=_U))
    words = _mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(_U) * _U(0xD6E8FEB86659FD93))
    width = min(width, len(words))
    h = np.full(len(words) - width + 1, width, _U)
    for k in range(width):
        h = (h + words[k : k + len(h)]) * _U(0xFF51AFD7ED558CCD)
        h ^= h >> _U(29)
    return np.unique(_mix(h))


def set_hash(s: np.ndarray) -> bytes:
    """128 bits of a set."""
    return np.array([np.sum(_mix(s ^ _U(0x5851F42D4C957F2D)), dtype=_U), np.sum(_mix(s + _U(0x14057B7EF767814F)), dtype=_U)]).tobytes()


def prefix_length(n: int, percent: int) -> int:
    """Shingles of a set of n, in one order for all sets, of which a linked other set has one at least; 0 if only an equal set can link."""
    return 0 if 100 * n < percent * (n + 1) else n - -(-percent * n // 100) + 1


def step_of(n: np.ndarray, percent: int) -> np.ndarray:
    """Steps of size: linked sets are in one step or in neighbouring ones."""
    return np.floor(np.log(n) / np.log(100 / percent) + 1e-9).astype(np.int64)


def can_link(n1, q1, n2, q2, percent: int):
    """Whether sizes allow a link, and the shingles from the first common one on (q of n) do."""
    return (100 * np.minimum(n1, n2) >= percent * np.maximum(n1, n2)) & ((100 + percent) * np.minimum(q1, q2) >= percent * (n1 + n2))


def linked(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    both = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * both >= percent * (len(a) + len(b) - both)


class Node:
    """A node of the R-tree: its rows, their coordinate maxima, least and largest size, and the nodes below it (none for a leaf)."""

    def __init__(self, points: np.ndarray, sizes: np.ndarray, rows: np.ndarray):
        self.below = []
        if len(rows) > FANOUT:
            axis = int(np.ptp(points[rows], axis=0).argmax())
            # the largest spread is mostly the size's, by which sets that can't link are parted first
            by = sizes[rows] if np.ptp(sizes[rows]) >= np.ptp(points[rows, axis]) else points[rows, axis]
            rows = rows[np.argsort(by, kind="stable")]
            self.below = [Node(points, sizes, x) for x in np.array_split(rows, min(8, -(-len(rows) // FANOUT)))]
        self.rows, self.top, self.low, self.high = rows, points[rows].max(axis=0), int(sizes[rows].min()), int(sizes[rows].max())


def tree_pairs(points: np.ndarray, sizes: np.ndarray, percent: int, group: np.ndarray) -> Iterator[np.ndarray]:
    """Pairs of rows of different groups whose overlap can be large enough, leaf against leaf; groups may change meanwhile."""
    root = Node(points, sizes, np.arange(len(sizes)))
    todo = [(root, root)]
    while todo:
        x, y = todo.pop()
        if 100 * x.high < percent * y.low or 100 * y.high < percent * x.low or (100 + percent) * int(np.minimum(x.top, y.top).sum()) < percent * (x.low + y.low):
            continue
        if (group[x.rows] == (g := group[y.rows[0]])).all() and (group[y.rows] == g).all():
            continue
        if x.below or y.below:
            if x is y:
                todo += [(u, v) for i, u in enumerate(x.below) for v in x.below[i:]]
            elif x.below and (not y.below or len(x.rows) >= len(y.rows)):
                todo += [(u, y) for u in x.below]
            else:
                todo += [(x, v) for v in y.below]
            continue
        bound = np.minimum(points[x.rows][:, None, :], points[y.rows][None, :, :]).sum(axis=2, dtype=np.int64)
        near = ((100 + percent) * bound >= percent * (sizes[x.rows][:, None] + sizes[y.rows][None, :])) & (group[x.rows][:, None] != group[y.rows][None, :])
        if x is y:
            near = np.triu(near, 1)
        i, j = np.nonzero(near)
        if len(i):
            yield np.stack([x.rows[i], y.rows[j]], axis=1)


def point(s: np.ndarray) -> bytes:
    """The counts of a set's shingles in each group, of one byte each if they are small."""
    counts = np.bincount((s & _U(COORDINATES - 1)).astype(np.int64), minlength=COORDINATES)
    return counts.astype(np.uint8 if counts.max(initial=0) < 256 else np.uint32).tobytes()


def _points(raw: list[bytes]) -> np.ndarray:
    return np.stack([np.frombuffer(x, np.uint8 if len(x) == COORDINATES else np.uint32) for x in raw]).astype(np.int32)


def _planes(x: np.ndarray) -> bytes:
    """Bytes of 64-bit numbers, all highest bytes first: ordered or small numbers then compress well."""
    return np.ascontiguousarray(x.astype(">u8").view(np.uint8).reshape(-1, 8).T).tobytes()


def _unplaned(raw: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(8, -1).T).view(">u8").ravel().astype(_U)


def _group(s: np.ndarray, groups: int) -> np.ndarray:
    return (s >> _U(64 - groups)).astype(np.int64)


def _described(docs: DataFrame, width: int, groups: int) -> DataFrame:
    """A row per document (doc, t, n, c: its set's hash, h: half of that, point), and rows of counts (chunk of groups, packed counts).

    Copies within a batch count once.
    """
    kinds = pa.schema([("doc", pa.int64()), ("t", pa.int64()), ("n", pa.int64()), ("c", pa.binary()), ("h", pa.int64()), ("point", pa.binary()), ("chunk", pa.int32()), ("counts", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        drop_kept()
        table = np.zeros(1 << groups, np.uint32)
        for batch in batches:
            seen, rows, at = set(), [], []
            for text in batch.column("text").to_pylist():
                s = shingles(text, width)
                c = set_hash(s)
                if c not in seen:
                    seen.add(c)
                    at.append(_group(s, groups))
                rows.append((len(s), c, int.from_bytes(c[:8], "little", signed=True), point(s)))
            if rows:
                np.add.at(table, np.concatenate(at), 1)
                n, c, h, points = zip(*rows, strict=True)
                nothing = pa.nulls(len(rows))
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("t"), pa.array(n), pa.array(c, pa.binary()), pa.array(h), pa.array(points, pa.binary()), nothing.cast(pa.int32()), nothing.cast(pa.binary())], schema=kinds)
        chunks = table.reshape(-1, 1 << LEAST_GROUPS)
        packed = {i: zlib.compress(x.astype(np.min_scalar_type(x.max())).tobytes(), 1) for i, x in enumerate(chunks) if x.any()}
        if packed:
            empty = {f.name: pa.nulls(len(packed), f.type) for f in kinds}
            yield pa.RecordBatch.from_pydict({**empty, "chunk": pa.array(packed, pa.int32()), "counts": pa.array(packed.values(), pa.binary())}, schema=kinds)

    return docs.mapInArrow(run, "doc bigint, t bigint, n bigint, c binary, h bigint, point binary, chunk int, counts binary")


def _counts(described: DataFrame, groups: int) -> np.ndarray:
    """The corpus-wide counts of all groups, summed by Spark chunk by chunk; 64 MB at most reach the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for chunk, raw in zip(batch.column("chunk").to_pylist(), batch.column("counts").to_pylist(), strict=True):
                raw = zlib.decompress(raw)
                x = np.frombuffer(raw, f"u{len(raw) >> LEAST_GROUPS}")
                sums[chunk] = sums[chunk] + x if chunk in sums else x.astype(np.uint32)
        if sums:
            yield pa.RecordBatch.from_arrays([pa.array(sums, pa.int32()), pa.array([x.tobytes() for x in sums.values()], pa.binary())], ["chunk", "counts"])

    chunks = described.filter("chunk IS NOT NULL").select("chunk", "counts").repartition("chunk").mapInArrow(run, "chunk int, counts binary").collect()
    table = np.zeros(1 << groups, np.uint32)
    for r in chunks:
        at = r["chunk"] << LEAST_GROUPS
        table[at : at + (1 << LEAST_GROUPS)] = np.frombuffer(r["counts"], np.uint32)
    return table


def _keyed(docs: DataFrame, width: int, percent: int, groups: int, counts, buckets: int) -> DataFrame:
    """Members of the blocks, packed by bucket: keys, h of the set, and n and place of the shingle in the set's order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = counts.value
        for batch in batches:
            seen, parts = set(), []
            for text in batch.column("text").to_pylist():
                s = shingles(text, width)
                k = prefix_length(len(s), percent)
                if not k or (c := set_hash(s)) in seen:
                    continue
                seen.add(c)
                of = table[_group(s, groups)]
                first = np.lexsort((s, of))[:k]
                h, many = np.repeat(np.frombuffer(c[:8], _U), k), of[first]
                salt = np.where(many > HOT, _mix(h) % (many // HOT + 1).astype(_U), _U(0))
                parts.append((s[first], h, _U(len(s) << 32) + np.arange(k, dtype=_U), _mix(s[first] + salt), many > HOT))
            if not parts:
                continue
            key, h, place, spread, hot = (np.concatenate(x) for x in zip(*parts, strict=True))
            bucket = ((spread >> _U(32)) * _U(buckets) >> _U(32)).astype(np.int32)
            order = np.lexsort((key, bucket))
            key, h, place, hot, bucket = key[order], h[order], place[order], hot[order], bucket[order]
            cut = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1]))
            ends = list(zip(cut.tolist(), [*cut[1:].tolist(), len(key)], strict=True))
            packed = [pa.array([_planes(x[i:j]) for i, j in ends], pa.binary()) for x in (key, h, place)]
            yield pa.RecordBatch.from_arrays([pa.array(bucket[cut]), *packed, pa.array([np.packbits(hot[i:j]).tobytes() for i, j in ends], pa.binary())], ["bucket", "keys", "hs", "places", "hot"])

    return docs.select("text").mapInArrow(run, "bucket int, keys binary, hs binary, places binary, hot binary")


def _blocks(percent: int):
    """Rows sorted by bucket to edges (kind 0: a, b), members of blocks of three sets and more (1: block, a, n, q) and first sets of the parts of hot blocks (2: block, a, n, q)."""
    names = ["kind", "block", "a", "b", "n", "q"]

    def told(kind: int, block=None, a=None, b=None, n=None, q=None) -> pa.RecordBatch:
        column = lambda x: pa.nulls(len(a), pa.int64()) if x is None else pa.array(x.view(np.int64) if x.dtype == _U else x.astype(np.int64))
        return pa.RecordBatch.from_arrays([pa.array(np.full(len(a), kind, np.int32)), *map(column, (block, a, b, n, q))], names)

    def joined(held: list[tuple]) -> Iterator[pa.RecordBatch]:
        key, h, place = (np.concatenate([_unplaned(x[i]) for x in held]) for i in range(3))
        hot = np.concatenate([np.unpackbits(np.frombuffer(x[3], np.uint8), count=len(x[0]) // 8) for x in held]).astype(bool)
        order = np.lexsort((h, key))  # copies from several batches first
        key, h, place, hot = key[order], h[order], place[order], hot[order]
        one = np.append(True, (key[1:] != key[:-1]) | (h[1:] != h[:-1]))
        key, h, place, hot = key[one], h[one], place[one], hot[one]
        some = np.append(False, key[1:] == key[:-1])
        some = some | np.append(some[1:], False) | hot
        key, h, place, hot = key[some], h[some], place[some], hot[some]
        if not len(key):
            return
        n, p = (place >> _U(32)).astype(np.int64), (place & _U(0xFFFFFFFF)).astype(np.int64)
        q, step = n - p, step_of(n, percent)
        order = np.lexsort((h, n, p, step, key))
        key, h, n, q, step, hot = key[order], h[order], n[order], q[order], step[order], hot[order]
        new = np.append(True, key[1:] != key[:-1])
        part = new | np.append(True, step[1:] != step[:-1])
        index = np.arange(len(key))
        hub = np.maximum.accumulate(np.where(part, index, 0))
        before = np.maximum(hub - 1, 0)
        below = hub[before]  # the first of the step below, where the block has it
        for other, there in ((hub, hub != index), (below, ~new[hub] & (step[below] == step - 1))):
            good = there & can_link(n, q, n[other], q[other], percent)
            if good.any():
                yield told(0, a=h[other][good], b=h[good])
        if (first := part & hot).any():
            yield told(2, block=key[first], a=h[first], n=n[first], q=q[first])
        starts = np.flatnonzero(new)
        size = np.diff(np.append(starts, len(key)))
        # a block needs a set whose shingle stands early enough for the smaller of two linked sets; equal blocks are told once
        early = np.logical_or.reduceat((100 + percent) * q >= 2 * percent * n, starts)
        same = np.add.reduceat(_mix(h), starts)
        wide = np.flatnonzero((size > 2) & early & ~hot[starts])
        once = np.zeros(len(starts), bool)
        once[wide[np.unique(same[wide], return_index=True)[1]]] = True
        tell = np.repeat(once, size)
        if tell.any():
            # over equal blocks, the most shingles from the common one on
            most = np.lexsort((h, np.repeat(same, size)))
            sb, sh = np.repeat(same, size)[most], h[most]
            cut = np.flatnonzero(np.append(True, (sb[1:] != sb[:-1]) | (sh[1:] != sh[:-1])))
            width = np.diff(np.append(cut, len(sb)))
            best = np.empty(len(q), np.int64)
            best[most] = np.repeat(np.maximum.reduceat(q[most], cut), width)
            yield told(1, block=np.repeat(same, size)[tell], a=h[tell], n=n[tell], q=best[tell])
        if hot.any():
            yield told(1, block=key[hot], a=h[hot], n=n[hot], q=q[hot])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held = None, []
        for batch in batches:
            for bucket, *packed in zip(*(batch.column(c).to_pylist() for c in ("bucket", "keys", "hs", "places", "hot")), strict=True):
                if bucket != now:
                    if held:
                        yield from joined(held)
                    now, held = bucket, []
                held.append(packed)
        if held:
            yield from joined(held)

    return run


def _verified(docs: DataFrame, pairs: DataFrame, reps: DataFrame, width: int, percent: int) -> DataFrame:
    """Links (a, b: hashes of the sets) among pairs (a, b: halves of such hashes).

    The sets that are to be compared with one hub are dealt out in parts, each with the hub's text; reps
    names a text (h, c, text_at: doc_id and hash) of every set, which is read again whole.
    """
    side = lambda x: reps.select(F.col("h").alias(x), F.col("c").alias("c" + x), F.col("text_at").alias("d" + x))
    both = stored(pairs.join(side("a"), "a").join(side("b"), "b").select("ca", "da", "cb", "db"), "pairs")
    parts = stored(both.groupBy("ca").agg(F.ceil(F.count("*") / CHUNK).alias("parts")), "parts")
    dealt = both.join(parts, "ca").withColumn("part", F.pmod(F.xxhash64("cb"), F.col("parts")).cast("int"))
    wanted = dealt.select("ca", "part", F.lit(1).alias("turn"), F.col("cb").alias("c"), F.col("db").alias("text_at")).unionByName(
        dealt.select("ca", "part", F.lit(0).alias("turn"), F.col("ca").alias("c"), F.col("da").alias("text_at")).distinct()
    )
    wanted = stored(wanted.select("ca", "part", "turn", "c", "text_at.doc", F.col("text_at.t").alias("of")), "wanted")
    tasks = docs.join(wanted, (F.col("doc_id") == F.col("doc")) & (F.col("t") == F.col("of"))).repartition("ca", "part").sortWithinPartitions("ca", "part", "turn")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, hub = None, None
        for batch in batches:
            found = []
            for ca, part, turn, c, text in zip(*(batch.column(x).to_pylist() for x in ("ca", "part", "turn", "c", "text")), strict=True):
                s = shingles(text, width)
                if set_hash(s) != c:  # another text with the same hash
                    continue
                if turn == 0:
                    now, hub = (ca, part), s
                elif now == (ca, part) and linked(hub, s, percent):
                    found.append((ca, c))
            if found:
                a, b = zip(*found, strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.binary()), pa.array(b, pa.binary())], ["a", "b"])

    return stored(tasks.select("ca", "part", "turn", "c", "text").mapInArrow(run, "a binary, b binary").distinct(), "links")


def _left_over(found: DataFrame, nodes: DataFrame, labels: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) of sets of one block that are not yet connected and whose points allow a link."""
    named = nodes.select(F.col("h").alias("a"), "c", "point").join(labels.select(F.col("node").alias("c"), F.col("component").alias("label")), "c", "left").withColumn("label", F.coalesce("label", "c"))
    members = found.filter("kind = 1").groupBy("block", "a").agg(F.max("n").alias("n"), F.max("q").alias("q"))
    labelled = stored(members.join(named.select("a", "label"), "a"), "members")
    split = stored(labelled.groupBy("block").agg(F.min("label").alias("low"), F.max("label").alias("high"), F.count("*").alias("k")).filter("low <> high").select("block", F.ceil(F.col("k") / TILE).cast("int").alias("tiles")), "split")
    mine = F.pmod(F.xxhash64("a"), F.col("tiles")).cast("int")
    other = F.explode(F.when(F.col("tiles") == 1, F.array(F.lit(0))).otherwise(F.filter(F.sequence(F.lit(0), F.col("tiles") - 1), lambda t: t != mine)))
    rest = labelled.join(split, "block").withColumn("u", other).select("block", F.least(mine, "u").alias("i"), F.greatest(mine, "u").alias("j"), "a", "n", "q", "label")
    tasks = rest.join(named.select("a", "point").distinct(), "a").repartition("block", "i", "j").sortWithinPartitions("block", "i", "j")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held = None, []

        def joined() -> Iterator[pa.RecordBatch]:
            a, n, q, label, raw = zip(*held, strict=True)
            a, n, q = np.array(a, np.int64), np.array(n, np.int64), np.array(q, np.int64)
            for pairs in tree_pairs(_points(raw), n, percent, np.unique(np.array(label, object), return_inverse=True)[1]):
                x, y = pairs[:, 0], pairs[:, 1]
                good = can_link(n[x], q[x], n[y], q[y], percent)
                if good.any():
                    yield pa.RecordBatch.from_arrays([pa.array(np.minimum(a[x], a[y])[good]), pa.array(np.maximum(a[x], a[y])[good])], ["a", "b"])

        for batch in batches:
            for block, i, j, *row in zip(*(batch.column(c).to_pylist() for c in ("block", "i", "j", "a", "n", "q", "label", "point")), strict=True):
                if (block, i, j) != now:
                    if held:
                        yield from joined()
                    now, held = (block, i, j), []
                held.append(row)
        if held:
            yield from joined()

    pairs = tasks.select("block", "i", "j", "a", "n", "q", "label", "point").mapInArrow(run, "a bigint, b bigint").distinct()
    tried = found.filter("kind = 0").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    return pairs.join(tried, ["a", "b"], "left_anti")


def linked_sets(docs: DataFrame, width: int, percent: int) -> tuple[DataFrame, DataFrame]:
    """A row per document (doc, t: hash of its text, n, c: hash of its set), and verified links (a, b) between sets (c)."""
    spark = docs.sparkSession
    small_batches(spark)
    docs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text", F.xxhash64("text").alias("t"))
    size = docs.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    groups = min(MOST_GROUPS, max(LEAST_GROUPS, (size // GROUP_BYTES).bit_length()))
    described = stored(_described(docs, width, groups), "described")
    counts = spark.sparkContext.broadcast(_counts(described, groups))
    buckets = 16 * max(16, int(spark.conf.get("spark.sql.shuffle.partitions")))
    keyed = _keyed(docs.filter("doc_id IS NOT NULL"), width, percent, groups, counts, buckets).repartition("bucket").sortWithinPartitions("bucket")
    found = stored(keyed.mapInArrow(_blocks(percent), "kind int, block bigint, a bigint, b bigint, n bigint, q bigint"), "blocks")

    info = described.filter("chunk IS NULL").select("doc", "t", "n", "c", "h", "point")
    nodes = stored(info.filter("n > 0 AND doc IS NOT NULL").groupBy("c", "h", "point").agg(F.min(F.struct("doc", "t")).alias("text_at")), "nodes")
    reps = nodes.select("h", "c", "text_at")
    if not info.filter("doc IS NOT NULL").groupBy("doc", "t").agg(F.count("*").alias("rows")).filter("rows > 1").isEmpty():
        docs = docs.dropDuplicates(["doc_id", "t"])  # of repeated rows one is read
    # first sets of the parts of a hot block are compared with the first of all of these
    parts = found.filter("kind = 2")
    step = F.floor(F.log("n") / float(np.log(100 / percent)) + 1e-9).alias("step")
    first = parts.groupBy("block", step).agg(F.min(F.struct(F.col("n") - F.col("q"), "n", "a")).alias("x")).select("block", "step", F.col("x.a").alias("b"))
    between = parts.select("block", step, "a").join(first, ["block", "step"]).filter("a <> b").select(F.col("b").alias("a"), F.col("a").alias("b"))
    links = _verified(docs, found.filter("kind = 0").select("a", "b").unionByName(between).distinct(), reps, width, percent)
    more = stored(_left_over(found, nodes, components(links), percent), "left_over")
    if not more.isEmpty():
        links = links.unionByName(_verified(docs, more, reps, width, percent))
    return info.select("doc", "t", "n", "c"), links


def near_duplicates(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """doc_id, n_shingles, class_id, component_id, for every row.

    Words are runs of other characters than ASCII white space, A-Z in lower case; a text of fewer than
    `width` words is one shingle. Two documents link when 100 * common >= percent * all shingles. class_id
    is the smallest doc_id with the same set, component_id the smallest reachable by links. Null, empty and
    blank texts have no shingles and stand alone. Rows that share a doc_id are one document, linked by
    whichever of its texts links; a null doc_id links with nothing. Links join all that links connect;
    copies, and sets already connected by others, are not compared again. Columns but doc_id and text are
    left behind; an empty table gives an empty result.
    """
    info, links = linked_sets(docs, width, percent)
    full = info.filter("n > 0 AND doc IS NOT NULL")
    texts = full.select("doc", "c").distinct().groupBy("doc").agg(F.min("c").alias("a"), F.max("c").alias("b")).filter("a <> b")
    same = full.join(stored(texts.select("doc", "a"), "repeated"), "doc").filter("a <> c").select("a", F.col("c").alias("b")).distinct()
    joined = components(links.unionByName(same))
    classes = full.groupBy("c").agg(F.min("doc").alias("class_id")).join(joined.select(F.col("node").alias("c"), "component"), "c", "left").withColumn("component", F.coalesce("component", "c"))
    classes = stored(classes, "classes")
    ids = classes.groupBy("component").agg(F.min("class_id").alias("component_id"))
    # written, so that the join stands on two plain exchanges and Spark can split the partition of a very large class
    named = full.join(stored(classes.join(ids, "component").select("c", "class_id", "component_id"), "named"), "c").select("doc", "n", "class_id", "component_id")
    alone = info.filter("n = 0 OR doc IS NULL").select("doc", "n", F.col("doc").alias("class_id"), F.col("doc").alias("component_id"))
    return named.unionByName(alone).withColumnsRenamed({"doc": "doc_id", "n": "n_shingles"})


def one_of_each(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """Rows of docs, all columns kept: of each component of texts, a row with the smallest (doc_id, hash of the text).

    Here each row's text counts for itself, so of different texts under one doc_id both stay unless they
    link. Of equal rows one stays. Rows without doc_id, and those whose text has no word, stay.
    """
    info, links = linked_sets(docs, width, percent)
    full = info.filter("n > 0 AND doc IS NOT NULL")
    joined = components(links)
    classes = full.groupBy("c").agg(F.min(F.struct("doc", "t")).alias("first")).join(joined.select(F.col("node").alias("c"), "component"), "c", "left")
    best = classes.groupBy(F.coalesce("component", "c").alias("component")).agg(F.min("first").alias("first")).select("first.doc", "first.t")
    gone = stored(full.select("doc", "t").distinct().join(best, ["doc", "t"], "left_anti"), "gone")
    again = stored(full.groupBy("doc", "t").agg(F.count("*").alias("rows")).filter("rows > 1").join(gone, ["doc", "t"], "left_anti").select("doc", "t"), "again")
    of = lambda x: x.select(F.col("doc").alias("__doc"), F.col("t").alias("__t"))
    this = (F.col("doc_id").cast("bigint") == F.col("__doc")) & (F.xxhash64("text") == F.col("__t"))
    once = docs.join(of(gone.unionByName(again)), this, "left_anti")
    return once.unionByName(docs.join(of(again), this, "left_semi").dropDuplicates(["doc_id", "text"]))


def op3_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), width=4, percent=85).select("doc_id", F.col("n_shingles").cast("bigint").alias("n_shingles"), "component_id")


ORACLE = {
    "op3_ngram_jaccard_join": r"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
  FROM documents),
s AS (
  SELECT DISTINCT doc_id, unnest(list_transform(range(1, greatest(len(w) - 3, 1) + 1), lambda i: array_to_string(w[i : i + 3], ' '))) AS s
  FROM w WHERE len(w) > 0),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
common AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY 1, 2),
links AS (
  SELECT a, b FROM common JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 85 * (x.n + y.n - c)),
twoway AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach AS (SELECT a AS doc_id, a AS other FROM twoway UNION SELECT reach.doc_id, twoway.b FROM reach JOIN twoway ON reach.other = twoway.a),
component AS (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id)
SELECT d.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, coalesce(c.component_id, d.doc_id) AS component_id
FROM documents d LEFT JOIN n ON n.doc_id = d.doc_id LEFT JOIN component c ON c.doc_id = d.doc_id
"""
}
