"""Best-fit packing of tokenised documents into fixed-length sequences by bin completion.

Only how many pieces there are of each length matters for packing, and lengths are at most the capacity,
so the search works on that bounded histogram. Best-fit decreasing over it is the first incumbent. Around
the largest piece left, branch and bound takes the undominated fillings of the rest of the sequence, fullest
first, and repeats the one it takes while its pieces last; it goes back where the sequences so far and the
fewest that the pieces left must have don't come below the incumbent, and ends at the bound of all pieces.
Spark then ranks the pieces of each length and deals them out to the plan's sequences.
"""

from __future__ import annotations

import base64
import zlib
from bisect import bisect_left, bisect_right, insort
from collections import deque
from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from bookweave.llm.common import small_batches, stored, table

CAPACITY = 2048
END = 0
#: Steps of the search, after its first way down, after which the best plan so far is taken; and how many steps it can go back.
NODES, DEEP = 2000, 64
#: Pieces that a part has, into which pieces of one length are dealt for ranking.
PART = 2_000

_CODER: dict = {}


def _coder(folder: str | None):
    """Encodes a batch of texts with the public 50k byte-level vocabulary, its ranks read by tiktoken (three times as fast)."""
    if folder not in _CODER:
        import public_tokenizers
        import tiktoken

        path = f"{folder}/byte_bpe_50k.tiktoken" if folder else public_tokenizers.path("byte_bpe_50k.tiktoken")
        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        mark = "<|endoftext|>"  # in a text, the vocabulary's file reads it as one token
        _CODER[folder] = (tiktoken.Encoding("bpe", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={mark: 50256}), {mark})
    coder, marks = _CODER[folder]
    return lambda text: coder.encode(text, allowed_special=marks, disallowed_special=())


def pieces(docs: DataFrame, capacity: int = CAPACITY, folder: str | None = None) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, lot: each document's ids and a closing 0, cut if longer than capacity, the first piece taking the remainder."""
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode = _coder(folder)
        for b in batches:
            rows = []
            for doc_id, text in zip(b["doc_id"], b["text"], strict=True):
                ids = encode(text) if isinstance(text, str) else []
                ids.append(END)
                raw = np.array(ids, "<u4").tobytes()
                at, k, end = 0, 0, len(ids) % capacity or min(capacity, len(ids))
                while at < len(ids):
                    rows.append((doc_id, k, at, end - at, zlib.crc32(raw[4 * at : 4 * end])))
                    at, k, end = end, k + 1, end + capacity
            yield pd.DataFrame(rows, columns=["doc_id", "piece", "start", "length", "ids_crc32"])

    rows = docs.select(F.col("doc_id").cast("bigint").cast("string").alias("doc_id"), "text")
    out = rows.mapInPandas(run, "doc_id string, piece int, start bigint, length bigint, ids_crc32 bigint")
    # a drawn lot, kept with the piece, deals out even pieces that are all alike
    return out.withColumn("doc_id", F.col("doc_id").cast("bigint")).withColumn("lot", F.floor(F.rand(7) * (1 << 30)).cast("int"))


def least(histogram: dict[int, int], capacity: int = CAPACITY) -> int:
    """Sequences that no packing can do without: for each k, pieces above half stand apart, those above capacity - k
    also from pieces of k or more, and what the rest of these pieces can't fill up of the others' room needs new ones."""
    n = np.zeros(capacity + 1, np.int64)
    n[list(histogram)] = list(histogram.values())
    many, much = np.append(0, np.cumsum(n)), np.append(0, np.cumsum(n * np.arange(capacity + 1)))  # of pieces below a length
    half, k = capacity // 2, np.arange(1, capacity // 2 + 1)
    wide = many[capacity + 1 - k] - many[half + 1]
    over = much[half + 1] - much[k] - (wide * capacity - (much[capacity + 1 - k] - much[half + 1]))
    whole = -(-much[-1] // capacity)
    return int(max(whole, (many[-1] - many[half + 1] + np.maximum(0, -(-over // capacity))).max(initial=0)))


def best_fit_decreasing(histogram: dict[int, int], capacity: int = CAPACITY) -> list[tuple[list[int], int]]:
    """Every piece, largest first, to the sequence with the least room that takes it; sequences filled alike are moved together."""
    groups: dict[int, list[tuple[tuple, int]]] = {}  # room -> (filling, how many sequences)
    rooms: list[int] = []
    for s in sorted(histogram, reverse=True):
        n = histogram[s]
        while n:
            i = bisect_left(rooms, s)
            if i == len(rooms):
                room, filling, k = capacity, (), n
            else:
                room = rooms[i]
                filling, k = groups[room].pop()
                if not groups[room]:
                    del groups[room], rooms[i]
            # one that has taken a piece has the least room of all until it takes no more
            each = room // s
            full = min(k, n // each)
            after = [(each, full), (n - full * each, 1)] if full < k and n - full * each < each else [(each, full)]
            for c, m in after:
                if c and m:
                    n -= c * m
                    k -= m
                    if room - c * s not in groups:
                        insort(rooms, room - c * s)
                    groups.setdefault(room - c * s, []).append(((*filling, (s, c)), m))
            if k and filling:
                if room not in groups:
                    insort(rooms, room)
                groups.setdefault(room, []).append((filling, k))
    return [([s for s, c in filling for _ in range(c)], m) for g in groups.values() for filling, m in g]


def _dominated(filling: tuple, room: int, sizes: list[int], most: list[int]) -> bool:
    """Whether a piece left over would fit as well, or could stand for smaller ones of the filling in their place and its room."""
    used, sums = dict(filling), 1
    for s, n in zip(sizes, most, strict=True):
        c = used.get(s, 0)
        low = max(0, s - room)
        if n > c and (sums >> low) & ((1 << (s - low + 1)) - 1):
            return True
        for _ in range(c):
            sums |= sums << s
    return False


def fillings(space: int, left: list[int], sizes: list[int]) -> Iterator[tuple | None]:
    """Sets of pieces for `space` as (length, count), largest first; the fullest sets come first, and of these those of larger pieces.

    sizes are those left, ascending, left[size] how many. None stands for each that is dominated; the first never
    is, as what could stand for some of its pieces would make it fuller or its pieces larger.
    """
    sizes = sizes[: bisect_right(sizes, space)]
    most = [min(left[s], space // s) for s in sizes]
    spare = [left[s] for s in sizes]
    mask, reach = (1 << (space + 1)) - 1, [1]  # reach[i]: bit t is set if the first i sizes can fill t
    for s, n in zip(sizes, most, strict=True):
        r, k = reach[-1], 1
        while n and r != mask:
            k = min(k, n)
            r |= r << s * k & mask
            n, k = n - k, 2 * k
        reach.append(r)
    first, sums = True, reach[-1]
    while sums:
        target = sums.bit_length() - 1
        sums ^= 1 << target
        stack: list[tuple[int, int, tuple]] = [(len(sizes), target, ())]
        while stack:
            i, rest, chosen = stack.pop()
            if not rest:
                yield chosen if first or not _dominated(chosen, space - target, sizes, spare) else None
                first = False
                continue
            i = bisect_right(sizes, rest, 0, i) - 1
            s = sizes[i]
            for c in range(min(most[i], rest // s) + 1):
                if reach[i] >> (rest - c * s) & 1:
                    stack.append((i, rest - c * s, (*chosen, (s, c)) if c else chosen))


def complete(space: int, left: list[int], sizes: list[int]) -> list[int]:
    """The fullest set of pieces for `space`, of several that one with the largest pieces."""
    return [s for s, c in next(fillings(space, left, sizes)) for _ in range(c)]


def plan(histogram: dict[int, int], capacity: int = CAPACITY, nodes: int = NODES) -> list[tuple[list[int], int]]:
    """(lengths in one sequence, how many such sequences), by bin completion, or best-fit decreasing where that needs no more."""
    best = best_fit_decreasing(histogram, capacity)
    fewest, bound = sum(n for _, n in best), least(histogram, capacity)
    left = [0] * (capacity + 1)
    for s, n in histogram.items():
        left[s] = n
    steps: list[tuple[dict[int, int], int]] = []
    used, down, first = 0, True, True
    frames: deque[tuple[int, int, Iterator]] = deque(maxlen=DEEP)  # a step, the largest piece left to it, and its fillings
    while fewest > bound:
        if down:
            sizes = [s for s in range(1, capacity + 1) if left[s]]
            if not sizes:  # all placed, and in fewer sequences than before
                best, fewest, down = [([s for s, c in f.items() for _ in range(c)], n) for f, n in steps], used, False
                continue
            rest = left.copy()
            rest[sizes[-1]] -= 1
            frames.append((len(steps), sizes[-1], fillings(capacity - sizes[-1], rest, [s for s in sizes if rest[s]])))
        elif not frames:
            break
        first &= down
        nodes -= not first
        if nodes < 0:
            break
        step, largest, options = frames[-1]
        while len(steps) > step:
            filling, times = steps.pop()
            used -= times
            for s, c in filling.items():
                left[s] += c * times
        chosen = next(options, False)
        if not chosen and chosen != ():
            down = False
            if chosen is False:
                frames.pop()
            continue
        filling = {largest: 1}
        for s, c in chosen:
            filling[s] = filling.get(s, 0) + c
        times = min(left[s] // c for s, c in filling.items())
        for s, c in filling.items():
            left[s] -= c * times
        steps.append((filling, times))
        used += times
        down = used + least({s: n for s, n in enumerate(left) if n}, capacity) < fewest
    return best


def pack(cut: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """cut with sequence_id and offset, without lot. cut must be a stored table: it is read twice.

    What passes through the driver is the histogram of lengths (at most `capacity` rows) and, for each
    length, the sequences its pieces go to as ranges of ranks.
    """
    histogram = {r["length"]: r["n"] for r in cut.groupBy("length").agg(F.count("*").alias("n")).collect()}
    starts: dict[int, list[tuple[int, int, int, int]]] = {}  # length -> (first rank, pieces in a sequence, first sequence, offset)
    given: dict[int, int] = {}
    base = 0
    for filling, times in plan(histogram, capacity):
        at = 0
        for s, same in groupby(filling):
            each = len(list(same))
            starts.setdefault(s, []).append((given.get(s, 0), each, base, at))
            given[s] = given.get(s, 0) + each * times
            at += each * s
        base += times
    ranges = {s: np.array(x, np.int64) for s, x in starts.items()}

    # ranks of equal lengths without a window over all of them: ranks in parts, and where each part starts
    parts = cut.withColumn("part", F.col("lot") % (sum(histogram.values()) // PART + 1))
    sizes = parts.groupBy("length", "part").agg(F.count("*").alias("n"))
    before = W.partitionBy("length").orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    sizes = sizes.select("length", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    nth = F.row_number().over(W.partitionBy("length", "part").orderBy("doc_id", "piece", "ids_crc32"))
    ranked = parts.withColumn("nth", nth).join(sizes, ["length", "part"]).withColumn("rank", F.col("first") + F.col("nth") - 1)

    @F.pandas_udf("sequence_id bigint, offset bigint")
    def seat(length: pd.Series, rank: pd.Series) -> pd.DataFrame:
        lengths, ranks = length.to_numpy(np.int64), rank.to_numpy(np.int64)
        out = np.zeros((len(lengths), 2), np.int64)
        for s in np.unique(lengths):
            here = lengths == s
            r = ranges[int(s)]
            row = r[np.searchsorted(r[:, 0], ranks[here], side="right") - 1]
            nth, seat_of = np.divmod(ranks[here] - row[:, 0], row[:, 1])
            out[here, 0] = row[:, 2] + nth
            out[here, 1] = row[:, 3] + seat_of * s
        return pd.DataFrame(out, columns=["sequence_id", "offset"])

    placed = ranked.withColumn("at", seat("length", "rank"))
    return placed.select(*(c for c in cut.columns if c != "lot"), "at.sequence_id", "at.offset")


def pack_documents(docs: DataFrame, capacity: int = CAPACITY, folder: str | None = None) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    Null and empty texts are one token, the closing 0. Repeated rows are packed each. A text longer than
    capacity is cut. Pieces of one length are all alike to the packing: which of them goes where is drawn.
    Columns but doc_id and text are left behind. An empty table gives no rows.
    """
    return pack(stored(pieces(docs, capacity, folder), "pieces"), capacity)


def op9_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"))
