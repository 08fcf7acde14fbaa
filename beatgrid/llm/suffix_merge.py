"""Repeated byte strings, found in a sparse suffix array that is merged across machines.

A string of ``length`` bytes that starts in two places is removed in both. The suffixes
that are sorted start at anchors only: in every window of that length, the place where
a hash of ``GRAM`` bytes is smallest. Equal windows have equal anchors, so two copies of
a string always meet at suffixes of one anchor, and with the bytes before the anchor
(``left``, as far as windows of that anchor reach) nothing is lost by sorting only these.

1. Anchors: positions, with a key of the half window to the right and to the left. Two
   copies share at least one of these keys.
2. Keys are counted; only anchors with a key that is seen again are sorted.
3. Runs: each task sorts the suffixes of its texts (cut to the window's length), joins
   equal ones, front-codes them (length of the prefix shared with the one before, then
   the rest) and sends one run to each part; a part has all suffixes of a hash of their
   first bytes.
4. Merge: a part merges its runs with a loser tree that keeps, for each run, the prefix
   its suffix shares with the last one put out. The longer shared prefix wins without a
   comparison; equal ones compare only the bytes after it.
5. Neighbours in the merged order share a prefix of known length r. Joining neighbours
   by falling r, and keeping each joined set sorted by the bytes to the left, gives the
   longest common left l for each r; where l + r reaches the length, both are covered.

Equal suffixes inside a run go on as one, so a passage that very many texts share
reaches a part once for each run. At its edges the bytes differ from text to text, and a
part grows with the texts that share the passage. Parts of over ``HOT_SUFFIXES`` are
therefore not merged in one task: their runs stay where they are, and each string of the
full length around an anchor is counted by a 128-bit hash of its bytes and the anchor's
place in it, with partial sums before the shuffle. Equal strings have equal anchors in
equal places, hence equal parts, so this loses nothing and counts no string twice.
Equal texts need no comparison: all of their windows start elsewhere, too.

Defined cases: an absent text counts as empty; texts below the length lose nothing;
matches never cross texts, but a text may repeat itself, also with overlaps; an empty
table gives no rows; other columns, whatever their names, are left alone.
"""

import bisect
import hashlib
import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from beatgrid.llm.common import map_batches
from beatgrid.sources.staging import materialise

LENGTH, GRAM = 400, 16
PIECE_BYTES, RUN_BYTES, PART_SUFFIXES = 4 << 20, 24 << 20, 20_000
HOT_SUFFIXES, WINDOWS_AT_ONCE = 100_000, 50_000
RIGHT, LEFT = 1, 2
Suffix = tuple[bytes, bytes, bytes, int]


def sliding(combine, values: np.ndarray, width: int) -> np.ndarray:
    """``combine`` over every ``width`` neighbours, by doubling."""
    out, span = values, 1
    while span * 2 <= width:
        out = combine(out[:-span], out[span:])
        span *= 2
    return combine(out[:values.size - width + 1], out[width - span:width - span + values.size - width + 1])


def gram_hashes(data: np.ndarray) -> np.ndarray:
    """A 32-bit hash, never 0, of the ``GRAM`` bytes from each position."""
    h, span = data.astype(np.uint32) + np.uint32(1), 1
    while span < GRAM:
        factor = np.uint32((0x9E3779B1 * (2 * span + 1) | 1) & 0xFFFFFFFF)
        h = h[:-span] * factor + h[span:]
        h ^= h >> np.uint32(15)
        span *= 2
    h *= np.uint32(0x85EBCA6B)
    h ^= h >> np.uint32(13)
    return np.maximum(h, np.uint32(1))


def find_anchors(data: np.ndarray, offsets: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text number, position in the text and left reach of the anchors of texts that lie one after another."""
    width = length - GRAM + 1
    if data.size < length:
        return (np.zeros(0, np.int64),) * 3
    hashes = gram_hashes(data)
    least = sliding(np.minimum, hashes, width)
    starts, stops = offsets[:-1], np.maximum(offsets[:-1], offsets[1:] - length + 1)
    edges = np.bincount(starts, minlength=data.size + 2).astype(np.int32) - np.bincount(stops, minlength=data.size + 2)
    least[edges.cumsum()[:least.size] <= 0] = 0
    greatest = sliding(np.maximum, np.pad(least, width - 1), width)
    at = np.flatnonzero(hashes == greatest)
    text = np.searchsorted(offsets, at, "right") - 1
    position = at - offsets[text]
    reach = np.minimum(position, width - 1)
    # Windows that begin at or before an earlier hash as small belong to that one.
    mine, open_, before = hashes[at], np.arange(at.size), np.arange(at.size) - 1
    while open_.size:
        earlier = before[open_]
        near = (earlier >= 0) & (at[open_] - at[earlier] <= reach[open_])
        open_, earlier = open_[near], earlier[near]
        smaller = mine[earlier] <= mine[open_]
        reach[open_[smaller]] = (at[open_] - at[earlier] - 1)[smaller]
        open_ = open_[~smaller]
        before[open_] -= 1
    return text, position, reach


def anchor_table(docs: DataFrame, length: int) -> DataFrame:
    """``(text_hash, place, keys)`` of every anchor; ``place`` holds position and reach."""
    half = (length + 1) // 2

    def pieces(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        """Slices of about ``PIECE_BYTES``, and of one text at least."""
        ends = np.cumsum([0 if n is None else n for n in pc.binary_length(batch.column(1)).to_pylist()])
        start = 0
        while start < batch.num_rows:
            stop = max(start + 1, int(np.searchsorted(ends, (ends[start - 1] if start else 0) + PIECE_BYTES, "right")))
            yield batch.slice(start, stop - start)
            start = stop

    def work(batches):
        seen: set[int] = set()
        for batch in batches:
            for piece in pieces(batch):
                names = piece.column(0).to_numpy()
                fresh = [i for i, x in enumerate(names.tolist()) if x not in seen and not seen.add(x)]
                texts = [t or b"" for t in piece.column(1).take(pa.array(fresh, pa.int64())).to_pylist()]
                whole, offsets = b"".join(texts), np.cumsum([0, *map(len, texts)])
                text, position, reach = find_anchors(np.frombuffer(whole, np.uint8), offsets, length)
                keys = []
                for begin, stop, at, far in zip(offsets[text].tolist(), offsets[text + 1].tolist(), (offsets[text] + position).tolist(), reach.tolist()):
                    own = [xxhash.xxh64_intdigest(whole[at:at + half], RIGHT) - (1 << 63)] if at + half <= stop else []
                    if far >= half:
                        own.append(xxhash.xxh64_intdigest(whole[at - half:at], LEFT) - (1 << 63))
                    keys.append(own)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(names[fresh][text], pa.int64()), pa.array(position << 16 | reach, pa.int64()), pa.array(keys, pa.list_(pa.int64()))],
                    names=["text_hash", "place", "keys"])

    return map_batches(docs.select("text_hash", "text"), work, "text_hash long, place long, keys array<long>")


def candidates(anchors: DataFrame) -> DataFrame:
    """``(text_hash, places)`` of the anchors with a key that is seen again."""
    keyed = anchors.select("text_hash", "place", F.explode("keys").alias("key"))
    again = materialise(keyed.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1).select("key"), "keys")
    return keyed.join(again, "key", "left_semi").groupBy("text_hash").agg(F.collect_set("place").alias("places"))


def shared_prefix(a: bytes, b: bytes, known: int = 0) -> int:
    """Length of the common prefix of which ``known`` bytes are known."""
    n = min(len(a), len(b))
    while known < n:
        x, y = a[known:known + 64], b[known:known + 64]
        if x != y:
            m = min(len(x), len(y))
            differ = int.from_bytes(x[:m]) ^ int.from_bytes(y[:m])
            return known + m - (differ.bit_length() + 7) // 8 if differ else known + m
        known += 64
    return n


def encode_run(run: list[Suffix]) -> bytes:
    """A sorted run, front-coded: prefix shared with the one before, and the rest, of both sides."""
    numbers, parts, before_right, before_left = [], [], b"", b""
    for right, left, text, position in run:
        r, l = shared_prefix(before_right, right), shared_prefix(before_left, left)
        numbers.append((r, len(right) - r, l, len(left) - l, position))
        parts += (right[r:], left[l:], text)
        before_right, before_left = right, left
    return zstandard.ZstdCompressor(level=1).compress(np.array(numbers, "<i8").tobytes() + b"".join(parts) + len(run).to_bytes(8, "little"))


def decode_run(blob: bytes) -> Iterator[tuple[int, Suffix]]:
    """Each suffix with the length of the prefix it shares with the one before."""
    data = zstandard.ZstdDecompressor().decompress(blob)
    n = int.from_bytes(data[-8:], "little")
    at, right, left = n * 40, b"", b""
    for r, right_rest, l, left_rest, position in np.frombuffer(data, "<i8", n * 5).reshape(n, 5).tolist():
        right, at = right[:r] + data[at:at + right_rest], at + right_rest
        left, at = left[:l] + data[at:at + left_rest], at + left_rest
        yield r, (right, left, data[at:at + 16], position)
        at += 16


def merge_runs(runs: list[Iterable[tuple[int, Suffix]]]) -> Iterator[tuple[int, Suffix]]:
    """All suffixes in order, each with the length of the prefix it shares with the one put out before.

    A loser tree: ``shared[i]`` is what run i's suffix shares with the suffix that beat
    it, which is the last one put out for all losers on the winner's path.
    """
    streams = [iter(r) for r in runs]
    heads: list[Suffix | None] = []
    for s in streams:
        first = next(s, None)
        heads.append(first[1] if first else None)
    size = 1 << max(0, len(streams) - 1).bit_length()
    heads += [None] * (size - len(streams))
    shared, losers = [0] * size, [0] * size

    def duel(a: int, b: int) -> tuple[int, int]:
        x, y = heads[a], heads[b]
        if x is None or y is None:
            return (b, a) if x is None else (a, b)
        if shared[a] != shared[b]:
            return (a, b) if shared[a] > shared[b] else (b, a)
        r = shared_prefix(x[0], y[0], shared[a])
        if r == len(x[0]) or r < len(y[0]) and x[0][r] < y[0][r]:
            shared[b] = r
            return a, b
        shared[a] = r
        return b, a

    level = list(range(size))
    while len(level) > 1:
        winners = []
        for i in range(0, len(level), 2):
            won, lost = duel(level[i], level[i + 1])
            losers[(size // len(level)) and len(level) // 2 + i // 2] = lost
            winners.append(won)
        level = winners
    best = level[0]
    while heads[best] is not None:
        yield shared[best], heads[best]
        following = next(streams[best], None)
        shared[best], heads[best] = following if following else (0, None)
        node = (size + best) // 2
        while node:
            best, losers[node] = duel(best, losers[node])
            node //= 2


def covered(shared: list[int], group: list[Suffix], length: int) -> Iterator[tuple[bytes, int, int]]:
    """Text, start and stop of what is repeated around the anchors of neighbours in order."""
    n = len(group)
    left_most, right_most = [-1] * n, [0] * n
    sets: list[list[tuple[bytes, int]]] = [[(g[1], i)] for i, g in enumerate(group)]
    first, last = list(range(n)), list(range(n))
    for i in sorted(range(1, n), key=lambda i: -shared[i]):
        r = shared[i]
        a, b = sets[first[i - 1]], sets[i]
        low, high = first[i - 1], last[i]
        few, many = (a, b) if len(a) < len(b) else (b, a)
        for left, x in few:
            k = bisect.bisect(many, (left, x))
            for other, y in many[max(0, k - 1):k + 1]:
                l = shared_prefix(left, other)
                if l + r >= length:
                    for z in (x, y):
                        left_most[z], right_most[z] = max(left_most[z], l), max(right_most[z], r)
        if len(few) == 1:
            bisect.insort(many, few[0])
        else:
            many += few
            many.sort()
        sets[low], first[high], last[low] = many, low, high
    for i, (_, _, text, position) in enumerate(group):
        if left_most[i] >= 0:
            yield text, position - left_most[i], position + right_most[i]


def covered_in_order(merged: Iterable[tuple[int, Suffix]], length: int) -> Iterator[tuple[bytes, int, int]]:
    """The same over all groups of neighbours that share enough to matter."""
    shared, group = [], []
    for r, suffix in merged:
        if r < GRAM and group:
            if len(group) > 1:
                yield from covered(shared, group, length)
            shared, group = [], []
        shared.append(r)
        group.append(suffix)
    if len(group) > 1:
        yield from covered(shared, group, length)


def write_runs(texts: DataFrame, length: int, parts: int) -> DataFrame:
    """Front-coded runs ``(part, run, n)`` of n suffixes, and ``(part, text, start, stop)`` of what a run itself repeats."""
    schema = pa.schema([("part", pa.int32()), ("run", pa.binary()), ("n", pa.int32()), ("text", pa.binary()), ("start", pa.int32()), ("stop", pa.int32())])

    def flush(suffixes: list[tuple[int, bytes, bytes, bytes, int]]) -> pa.RecordBatch:
        suffixes.sort()
        blobs, spans, run, part = [], [], [], None
        for i, (own, right, left, text, position) in enumerate(suffixes):
            if own != part and run:
                blobs.append((part, encode_run(run), len(run)))
                run = []
            part = own
            same_before = bool(run) and run[-1][0] == right and run[-1][1] == left
            same_after = i + 1 < len(suffixes) and suffixes[i + 1][:3] == (own, right, left)
            if (same_before or same_after) and len(left) + len(right) >= length:
                spans.append((xxhash.xxh32_intdigest(text) % parts, text, position - len(left), position + len(right)))
            if not same_before:
                run.append((right, left, text, position))
        if run:
            blobs.append((part, encode_run(run), len(run)))
        rows = [(*b, None, None, None) for b in blobs] + [(p, None, None, *s) for p, *s in spans]
        return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], schema.types[k]) for k in range(6)], schema=schema)

    def work(batches):
        held, size, seen = [], 0, set()
        for batch in batches:
            for name, whole, places in zip(*(c.to_pylist() for c in batch.columns)):
                text = bytes.fromhex(name)
                if text in seen:
                    continue
                seen.add(text)
                for place in places:
                    at, reach = place >> 16, place & 0xFFFF
                    right, left = whole[at:at + length], whole[at - reach:at][::-1]
                    held.append((xxhash.xxh32_intdigest(right[:GRAM]) % parts, right, left, text, at))
                    size += len(right) + len(left) + 100
                    if size > RUN_BYTES:
                        yield flush(held)
                        held, size = [], 0
        if held:
            yield flush(held)

    return map_batches(texts, work, "part int, run binary, n int, text binary, start int, stop int")


def merge_parts(runs: DataFrame, length: int) -> DataFrame:
    """``(text, start, stop)`` of everything repeated, from all runs of each part."""
    def rows(spans: Iterable[tuple[bytes, int, int]]) -> Iterator[pa.RecordBatch]:
        held = []
        for span in spans:
            held.append(span)
            if len(held) == 10_000:
                yield batch_of(held)
                held = []
        if held:
            yield batch_of(held)

    def batch_of(held) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([h[0] for h in held], pa.binary()), pa.array([h[1] for h in held], pa.int32()),
                                           pa.array([h[2] for h in held], pa.int32())], names=["text", "start", "stop"])

    def work(batches):
        part, blobs = None, []
        for batch in batches:
            ready = batch.filter(batch.column(1).is_null())
            if ready.num_rows:
                yield ready.select(["text", "start", "stop"])
            coded = batch.filter(batch.column(1).is_valid())
            for own, blob in zip(coded.column(0).to_pylist(), coded.column(1)):
                if own != part:
                    yield from rows(covered_in_order(merge_runs([decode_run(b) for b in blobs]), length))
                    part, blobs = own, []
                blobs.append(blob.as_py())
        yield from rows(covered_in_order(merge_runs([decode_run(b) for b in blobs]), length))

    dealt = runs.repartition("part").sortWithinPartitions("part")
    return map_batches(dealt, work, "text binary, start int, stop int")


def count_windows(runs: DataFrame, length: int) -> DataFrame:
    """The same from any runs, by counting every string of that length around their suffixes; no part is gathered."""
    def work(batches):
        for batch in batches:
            names, starts, digests = [], [], []
            for blob in batch.column(0):
                for _, (right, left, text, position) in decode_run(blob.as_py()):
                    near = left[::-1] + right
                    for i in range(min(len(left), len(near) - length) + 1):
                        names.append(text)
                        starts.append(position - len(left) + i)
                        digests.append(xxhash.xxh3_128_digest(near[i:i + length], len(left) - i))
                    if len(names) > WINDOWS_AT_ONCE:
                        yield pa.RecordBatch.from_arrays([pa.array(names, pa.binary()), pa.array(starts, pa.int32()), pa.array(digests, pa.binary())], names=["text", "start", "digest"])
                        names, starts, digests = [], [], []
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.binary()), pa.array(starts, pa.int32()), pa.array(digests, pa.binary())], names=["text", "start", "digest"])

    windows = materialise(map_batches(runs.select("run"), work, "text binary, start int, digest binary"), "windows")
    again = materialise(windows.groupBy("digest").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1).select("digest"), "again")
    return windows.join(again, "digest", "left_semi").select("text", "start", (F.col("start") + length).alias("stop"))


def repeated_around(runs: DataFrame, length: int, hot: int) -> DataFrame:
    """``(text, start, stop)`` from all runs: parts of up to ``hot`` suffixes are merged, larger ones counted."""
    runs = materialise(runs, "runs")
    large = materialise(runs.groupBy("part").agg(F.sum("n").alias("n")).filter(F.col("n") > hot).select("part"), "large")
    if large.isEmpty():
        return merge_parts(runs.drop("n"), length)
    rest = runs.filter(F.col("run").isNull()).unionByName(runs.filter(F.col("run").isNotNull()).join(large, "part", "left_anti"))
    counted = count_windows(runs.filter(F.col("run").isNotNull()).join(large, "part", "left_semi"), length)
    return merge_parts(rest.drop("n"), length).unionByName(counted)


def united(spans: Iterable[tuple[int, int]]) -> list[tuple[int, int]]:
    """Half-open spans, merged where they touch or overlap."""
    merged: list[tuple[int, int]] = []
    for start, stop in sorted(spans):
        if merged and start <= merged[-1][1]:
            merged[-1] = (merged[-1][0], max(stop, merged[-1][1]))
        else:
            merged.append((start, stop))
    return merged


def repeated_spans(docs: DataFrame, text: str = "text", length: int = LENGTH, part_suffixes: int = PART_SUFFIXES,
                   hot_suffixes: int = HOT_SUFFIXES) -> DataFrame:
    """``(text_id, spans)`` of the distinct texts that share a part of themselves; ``text_id`` is the text's MD5.

    Texts that occur more than once are left out, unless they also share a part with
    others: all of them is repeated.
    """
    if length <= GRAM or length > 1 << 15:
        raise ValueError(f"the length has to be over {GRAM} and up to {1 << 15}")
    whole = F.col(text).cast("binary")
    long = docs.filter(F.octet_length(text) >= length).select(F.xxhash64(text).alias("text_hash"), F.md5(whole).alias("text_id"), whole.alias("text"))
    anchors = materialise(anchor_table(long, length), "anchors")
    chosen = materialise(candidates(anchors), "candidates")
    suffixes = chosen.agg(F.sum(F.size("places"))).first()[0] or 0
    parts = max(1, math.ceil(suffixes / part_suffixes))
    texts = long.join(chosen, "text_hash").select("text_id", "text", "places")
    found = repeated_around(write_runs(texts, length, parts), length, hot_suffixes)
    return found.groupBy(F.lower(F.hex("text")).alias("text_id")).agg(F.collect_set(F.struct("start", "stop")).alias("spans"))


def remove_repeats(docs: DataFrame, text: str = "text", length: int = LENGTH, hot_suffixes: int = HOT_SUFFIXES) -> DataFrame:
    """All columns but the text packed in ``row``, with byte counts, removed runs and the digest of what is left."""
    empty = F.coalesce(F.col(text).cast("binary"), F.lit(b""))
    rest = [c for c in docs.columns if c != text]
    named = docs.select(F.struct(*[F.col(f"`{c}`") for c in rest]).alias("row"), F.md5(empty).alias("text_id"), empty.alias("text"))
    copied = materialise(named.groupBy("text_id").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1).select("text_id", F.lit(True).alias("copied")), "copied")
    spans = materialise(repeated_spans(docs.select(text), text, length, hot_suffixes=hot_suffixes).join(copied, "text_id", "left_anti"), "spans")
    cut = named.select("text_id", "text").join(spans, "text_id").select("text_id", "text", "spans")

    def work(batches):
        for batch in batches:
            removed, runs, digests = [], [], []
            for whole, own in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                gone = united((s["start"], s["stop"]) for s in own)
                kept, at = hashlib.sha256(), 0
                for start, stop in gone:
                    kept.update(whole[at:start])
                    at = stop
                kept.update(whole[at:])
                removed.append(sum(b - a for a, b in gone))
                runs.append([{"start": a, "stop": b} for a, b in gone])
                digests.append(kept.hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(removed, pa.int64()), pa.array(runs, pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32())]))), pa.array(digests)],
                names=["text_id", "removed", "runs", "kept"])

    partly = materialise(map_batches(cut, work, "text_id string, removed long, runs array<struct<start:int,stop:int>>, kept string"), "partly")
    size = F.length("text").cast("long")
    light = named.select("row", "text_id", size.alias("n_bytes"), F.sha2("text", 256).alias("whole"))
    all_gone = F.col("copied").isNotNull() & (F.col("n_bytes") >= length)
    everything = F.array(F.struct(F.lit(0).alias("start"), F.col("n_bytes").cast("int").alias("stop")))
    none = everything.getItem(F.lit(0))
    return light.join(copied, "text_id", "left").join(partly, "text_id", "left").select(
        "row", "n_bytes",
        F.when(all_gone, F.col("n_bytes")).otherwise(F.coalesce("removed", F.lit(0))).cast("long").alias("n_removed"),
        F.when(all_gone, everything).otherwise(F.coalesce("runs", F.filter(F.array(none), lambda x: F.lit(False)))).alias("removed_runs"),
        F.when(all_gone, F.sha2(F.lit(b""), 256)).otherwise(F.coalesce("kept", "whole")).alias("kept_sha256"))


def op4_repeated_bytes(docs: DataFrame) -> DataFrame:
    """What every document loses."""
    return remove_repeats(docs.select("doc_id", "text")).select(
        "row.doc_id", "n_bytes", "n_removed", F.size("removed_runs").cast("long").alias("n_spans"), "kept_sha256")
