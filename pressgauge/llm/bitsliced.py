"""SimHash near-duplicates by bit-sliced comparison.

A fingerprint's 64 bits are majority votes of the hashes of a text's word shingles.
Equal fingerprints are one node. Two nodes within the radius r agree on b - r of any
b blocks of bits, so each node enters one bucket for every choice of b - r blocks,
and b grows with the number of nodes to keep buckets small.

Within a bucket, fingerprints are stored vertically: bit plane i holds bit i of up to
64 of them in one word. A query's distances to all of those are updated together by
adding one plane of differences to carry-save counters, bit by bit; a lane that passes
the radius is marked, and words whose lanes are all marked are abandoned. Nodes that
are known to hang together are not compared again: a bucket gives a forest of links,
not all pairs, so a family of near copies costs little more than its size. The
components of all forests are the result.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pressgauge.llm.common import lowered, map_batches, stored
from pressgauge.llm.graph import components

SHINGLE, SEED, RADIUS, WIDTH = 4, 42, 4, 64
#: Nodes a bucket of evenly spread fingerprints may hold on average before more blocks are taken.
PER_BUCKET = 64
_ONE, _ALL = np.uint64(1), np.uint64(0xFFFFFFFFFFFFFFFF)
_LANES = _ONE << np.arange(64, dtype=np.uint64)


def fingerprint(text: bytes, size: int = SHINGLE, seed: int = SEED) -> int:
    """The 64 majority bits of the XXH64 values of a lower-cased UTF-8 text's shingles; 0 for a text without words."""
    import xxhash

    words = text.split()
    if not words:
        return 0
    joined = memoryview(b" ".join(words))
    ends = (np.cumsum([len(w) + 1 for w in words]) - 1).tolist()
    starts = [0, *(e + 1 for e in ends[:-1])]
    size = min(size, len(words))
    votes, total = np.zeros(64, np.int64), len(words) - size + 1
    digest = xxhash.xxh64_intdigest
    for at in range(0, total, 1 << 14):
        spans = zip(starts[at : min(at + (1 << 14), total)], ends[at + size - 1 :], strict=False)
        hashes = np.array([digest(joined[a:b], seed) for a, b in spans], "<u8")
        votes += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int((_LANES[2 * votes > total]).sum()) if (2 * votes > total).any() else 0


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id and fingerprint (the 64 bits as a signed long) of a table of doc_id and text."""
    schema = pa.schema([("doc_id", pa.int64()), ("fp", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.fromiter((fingerprint(t.as_py()) for t in batch.column(1)), np.uint64, batch.num_rows)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found.view(np.int64))], schema=schema)

    return map_batches(docs.select("doc_id", lowered(F.col("text")).cast("binary").alias("text")), run, "doc_id long, fp long")


def block_masks(nodes: int, radius: int = RADIUS, width: int = WIDTH, per_bucket: int = PER_BUCKET) -> list[int]:
    """Masks of which every two fingerprints within the radius share one: all choices of blocks - radius of the blocks.

    More blocks mean longer keys and more of them; the fewest that keep evenly
    spread buckets under ``per_bucket`` are taken, whatever the number of nodes.
    """
    blocks = radius + 1
    while True:
        edges = [round(i * width / blocks) for i in range(blocks + 1)]
        parts = [((1 << b) - 1) ^ ((1 << a) - 1) for a, b in zip(edges, edges[1:], strict=False)]
        masks = [sum(c) for c in combinations(parts, blocks - radius)]
        if nodes <= per_bucket << min(m.bit_count() for m in masks) or blocks >= min(2 * radius, width):
            return masks
        blocks += 1


def planes_of(words: np.ndarray) -> np.ndarray:
    """Bit planes (64, ...) of fingerprints (..., 64): lane j of plane i is bit i of fingerprint j."""
    bits = np.unpackbits(np.ascontiguousarray(words).astype("<u8").view(np.uint8).reshape(*words.shape, 8), axis=-1, bitorder="little")
    turned = np.ascontiguousarray(np.moveaxis(bits, -1, 0))  # plane, ..., lane
    return np.packbits(turned, axis=-1, bitorder="little").view("<u8")[..., 0].astype(np.uint64)


def within(planes: np.ndarray, queries: np.ndarray, radius: int = RADIUS) -> np.ndarray:
    """Lane masks (queries, words): which lanes of each word are within the radius of each query.

    ``planes`` is (64, words); ``queries`` is (queries,), or (queries, words) where each word has its own.
    """
    ask = queries if queries.ndim == 2 else np.broadcast_to(queries[:, None], (len(queries), planes.shape[1]))
    out = np.zeros(ask.shape, np.uint64)
    live = np.arange(planes.shape[1])
    digits = radius.bit_length()
    begin = (1 << digits) - 1 - radius  # counters start so high that the first difference beyond the radius carries out
    counters = [np.full(ask.shape, _ALL if begin >> d & 1 else 0, np.uint64) for d in range(digits)]
    past = np.zeros(ask.shape, np.uint64)
    for bit in range(WIDTH):
        carry = planes[bit, live] ^ (np.uint64(0) - ((ask >> np.uint64(bit)) & _ONE))
        for digit in counters:  # half adders: the sum stays, the carry moves up
            up = digit & carry
            digit ^= carry
            carry = up
        past |= carry
        if bit % 8 == 7 and bit < WIDTH - 1:
            going = (past != _ALL).any(axis=0)
            if not going.all():  # abandon words none of whose lanes can come back
                live, ask, past = live[going], ask[:, going], past[:, going]
                counters = [c[:, going] for c in counters]
                if not len(live):
                    return out
    out[:, live] = ~past
    return out


def _spread(masks: np.ndarray) -> np.ndarray:
    """(..., 64) booleans of lane masks."""
    return (masks[..., None] & _LANES) != 0


def _small_buckets(fps: np.ndarray, first: np.ndarray, size: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Forest links (member, root) of many buckets of at most 64 members, one word each, all worked on together."""
    lane = np.arange(64)
    held = lane < size[:, None]
    members = np.where(held, fps[np.minimum(first[:, None] + lane, len(fps) - 1)], np.uint64(0))
    full = np.where(held, _LANES, np.uint64(0)).sum(axis=1, dtype=np.uint64)
    reach = within(planes_of(members), np.ascontiguousarray(members.T), radius).T & full[:, None]
    reach = np.where(held, reach, np.uint64(0))
    for k in range(int(size.max())):  # what reaches k reaches all that k reaches
        reach |= np.where(reach & _LANES[k], reach[:, k : k + 1], np.uint64(0))
    root = np.where(held, _spread(reach).argmax(axis=-1), 0)
    at, child = np.nonzero(held & (root < lane))
    return fps[first[at] + child], fps[first[at] + root[at, child]]


def _words_of(fps: np.ndarray) -> np.ndarray:
    """Bit planes of any number of fingerprints, the last word filled up with zeros."""
    padded = np.zeros(-(-len(fps) // 64) * 64, np.uint64)
    padded[: len(fps)] = fps
    return planes_of(padded.reshape(-1, 64))


def _family(root: np.uint64, waiting: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """(members that hang together with ``root``, the others); members found are asked, only others are compared."""
    queue, family = np.array([root], np.uint64), []
    while len(queue) and len(waiting):
        asked, queue = queue[:64], queue[64:]
        near = np.bitwise_or.reduce(within(_words_of(waiting), asked, radius), axis=0)
        hit = _spread(near).reshape(-1)[: len(waiting)]
        found, waiting = waiting[hit], waiting[~hit]
        family.append(found)
        queue = np.concatenate([queue, found])
    return np.concatenate([np.zeros(0, np.uint64), *family]), waiting


def _scattered(fps: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Forest links among members that mostly lie apart: every word against itself and the words after it."""
    planes, parent = _words_of(fps), list(range(len(fps)))

    def top(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    for w in range(planes.shape[1]):
        asked = fps[64 * w : 64 * w + 64]
        near = within(planes[:, w:], asked, radius)
        near[:, 0] &= ~((_LANES[: len(asked)] << _ONE) - _ONE)  # itself and what came before
        query, word = np.nonzero(near)
        at, lane = np.nonzero(_spread(near[query, word]))
        for a, b in zip((64 * w + query[at]).tolist(), (64 * (w + word[at]) + lane).tolist(), strict=True):
            if b < len(fps) and (x := top(a)) != (y := top(b)):
                parent[max(x, y)] = min(x, y)
    root = np.array([top(i) for i in range(len(fps))], np.int64)
    child = np.flatnonzero(root != np.arange(len(fps)))
    return fps[child], fps[root[child]]


def _large_bucket(fps: np.ndarray, radius: int, tries: int = 8) -> tuple[np.ndarray, np.ndarray]:
    """Forest links of one bucket: large families are taken out first, as members known to belong together need no comparison."""
    waiting, links_a, links_b = fps, [], []
    for _ in range(tries):
        if len(waiting) <= 64:
            break
        middle = len(waiting) // 2
        root = waiting[middle]
        family, waiting = _family(root, np.delete(waiting, middle), radius)
        links_a.append(family)
        links_b.append(np.full(len(family), root))
    if len(waiting):
        a, b = _scattered(waiting, radius)
        links_a.append(a)
        links_b.append(b)
    return np.concatenate(links_a), np.concatenate(links_b)


def forests(key: np.ndarray, fps: np.ndarray, radius: int = RADIUS) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Links that join, in every bucket (a run of equal keys), just what lies within the radius of each other."""
    first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, np.int64)
    size = np.diff(np.append(first, len(key)))
    small = np.flatnonzero((size > 1) & (size <= 64))
    for at in range(0, len(small), 256):
        some = small[at : at + 256]
        yield _small_buckets(fps, first[some], size[some], radius)
    for b in np.flatnonzero(size > 64):
        yield _large_bucket(fps[first[b] : first[b] + size[b]], radius)


def _bucket_links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Forest links of rows (bucket, fp) that come sorted by bucket."""
    kept_key, kept_fp = [np.zeros(0, np.int64)], [np.zeros(0, np.uint64)]

    def linked(key, fps):
        for a, b in forests(key, fps):
            yield pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], names=["a", "b"])

    for batch in batches:
        key = batch.column(0).to_numpy(zero_copy_only=False)
        fps = batch.column(1).to_numpy(zero_copy_only=False).view(np.uint64)
        if not len(key):
            continue
        open_at = int(np.searchsorted(key, key[-1]))  # the last bucket may go on in the next batch
        if open_at:
            kept_key.append(key[:open_at])
            kept_fp.append(fps[:open_at])
            yield from linked(np.concatenate(kept_key), np.concatenate(kept_fp))
            kept_key, kept_fp = [], []
        elif kept_key and len(kept_key[-1]) and kept_key[-1][-1] != key[0]:
            yield from linked(np.concatenate(kept_key), np.concatenate(kept_fp))
            kept_key, kept_fp = [], []
        kept_key.append(key[open_at:])
        kept_fp.append(fps[open_at:])
    if kept_key:
        yield from linked(np.concatenate(kept_key), np.concatenate(kept_fp))


def near_links(nodes: DataFrame, radius: int = RADIUS) -> DataFrame:
    """a, b: links whose components are those of all pairs of ``nodes`` (distinct fp) within the radius."""
    signed = lambda m: m - (1 << 64) if m >> 63 else m
    masks = block_masks(nodes.count(), radius)
    table = F.array(*(F.struct(F.xxhash64(F.lit(i), F.col("fp").bitwiseAND(F.lit(signed(m)))).alias("bucket"), F.col("fp")) for i, m in enumerate(masks)))
    dealt = nodes.select(F.inline(table)).repartition("bucket").sortWithinPartitions("bucket")
    return map_batches(dealt, _bucket_links, "a long, b long").distinct()


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, its fingerprint in hexadecimal, and component_id.

    component_id is the least doc_id reachable over links of at most four
    differing bits. Null, empty and blank texts have fingerprint zero and link
    like any other; a null id is in no minimum, so a component of null ids only
    has a null component_id; repeated rows each give a row; an empty table gives
    none; further columns are left aside.
    """
    held = stored(fingerprints(docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))), "fingerprints")
    nodes = stored(held.groupBy("fp").agg(F.min("doc_id").alias("least")), "nodes")
    part_of = components(near_links(nodes.select("fp"))).withColumnRenamed("id", "fp")
    placed = nodes.join(part_of, "fp", "left").select("fp", F.coalesce("part", "fp").alias("part"), "least")
    least = placed.groupBy("part").agg(F.min("least").alias("component_id"))
    named = stored(placed.join(least, "part").select("fp", "component_id"), "placed-nodes")
    return held.join(named, "fp").select("doc_id", _hex(F.col("fp")).alias("fingerprint"), "component_id")


def _hex(fp: Column) -> Column:
    return F.lpad(F.lower(F.hex(fp)), 16, "0")
