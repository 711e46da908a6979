"""Documents that hold benchmark items: SimHash of item-sized windows, then exact similarity."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratalake.llm.common import table
from stratalake.llm.hashing import ALNUM, shingles, words
from stratalake.llm.language import slices
from stratalake.llm.packs import text_buffers
from stratalake.llm.registry import query

#: Differing bits of two fingerprints, of 64, up to which all are found; and blocks of the index.
RADIUS = 15
BLOCKS = 4
WIDTH = 64 // BLOCKS
#: Text and items of a benchmark that go through the documents in one pass.
PASS_BYTES = 8 << 20
PASS_ITEMS = 4096

_HIT = "array<struct<item_id: long, similarity: double, distance: int, start_word: long, n_words: int>>"
_HIT_ARROW = pa.list_(pa.struct([
    ("item_id", pa.int64()), ("similarity", pa.float64()), ("distance", pa.int32()),
    ("start_word", pa.int64()), ("n_words", pa.int32()),
]))


def bit_sums(hashes: np.ndarray) -> np.ndarray:
    """Running sums of the bits of shingles, 1 for a set bit and -1 for any other."""
    bits = ((hashes[:, None] >> np.arange(64, dtype=np.uint64)) & np.uint64(1)).astype(np.int32) * 2 - 1
    sums = np.zeros((len(hashes) + 1, 64), np.int32)
    np.cumsum(bits, axis=0, out=sums[1:])
    return sums


def fingerprints(sums: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """SimHash of the shingles from ``first`` to before ``last`` of each window, each as often as it occurs."""
    positive = (sums[last] - sums[first]) > 0
    return np.packbits(positive, axis=1, bitorder="little").view(np.uint64).ravel()


def _near_values(radius: int) -> np.ndarray:
    """All block values that differ from 0 in ``radius`` bits at most."""
    values = [sum(1 << b for b in chosen) for r in range(radius + 1) for chosen in combinations(range(WIDTH), r)]
    return np.array(values, np.uint64)


class BlockIndex:
    """Fingerprints by the values of their blocks: two within the radius agree in a block up to radius/blocks bits."""

    def __init__(self, prints: np.ndarray) -> None:
        near = _near_values(RADIUS // BLOCKS)
        self.prints, self.values, self.items = prints, [], []
        for block in range(BLOCKS):
            own = (prints >> np.uint64(block * WIDTH)) & np.uint64((1 << WIDTH) - 1)
            values = (own[:, None] ^ near[None, :]).ravel()
            order = np.argsort(values, kind="stable")
            self.values.append(values[order])
            self.items.append(np.repeat(np.arange(len(prints)), len(near))[order])

    def search(self, prints: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """All pairs within the radius: the place in ``prints``, the item and the distance."""
        pairs = []
        for block in range(BLOCKS):
            own = (prints >> np.uint64(block * WIDTH)) & np.uint64((1 << WIDTH) - 1)
            low = np.searchsorted(self.values[block], own, side="left")
            count = np.searchsorted(self.values[block], own, side="right") - low
            place = np.repeat(np.arange(len(prints)), count)
            at = np.repeat(low - np.r_[0, np.cumsum(count)[:-1]], count) + np.arange(count.sum())
            pairs.append(place * len(self.prints) + self.items[block][at])
        place, item = np.divmod(np.unique(np.concatenate(pairs)), max(1, len(self.prints)))
        distance = np.bitwise_count(prints[place] ^ self.prints[item]).astype(np.int64)
        keep = distance <= RADIUS
        return place[keep], item[keep], distance[keep]


@dataclass
class ItemGroup:
    """The items of one length in words: ids, shingle counts, and the index of their fingerprints."""

    size: int
    ids: list[int]
    bags: list[Counter]
    index: BlockIndex


class Benchmark:
    """The items of one pass, grouped by their length."""

    def __init__(self, items: list[tuple[int, str]], k: int) -> None:
        self.k = k
        by_size: dict[int, list[tuple[int, np.ndarray]]] = {}
        for item_id, text in items:
            raw = np.frombuffer(text.encode(), np.uint8)
            h, doc, _, _ = words(np.array([0, len(raw)]), raw, ALNUM)
            if len(h):
                s, _, _ = shingles(h, doc, min(k, len(h)))
                by_size.setdefault(len(h), []).append((item_id, s))
        self.groups = []
        for size, members in sorted(by_size.items()):
            zero = np.array([0])
            prints = np.concatenate([fingerprints(bit_sums(s), zero, zero + len(s)) for _, s in members])
            bags = [Counter(s.tolist()) for _, s in members]
            self.groups.append(ItemGroup(size, [i for i, _ in members], bags, BlockIndex(prints)))
        #: Shingle lengths in use, and the shingles of items for each.
        self.lengths = sorted({min(k, g.size) for g in self.groups})
        self.known = {
            n: np.array(sorted({s for g in self.groups if min(k, g.size) == n for bag in g.bags for s in bag}), np.uint64)
            for n in self.lengths
        }
        #: For each of them, which leading bits some shingle has: a quick look before the exact one.
        self.leading = {n: np.zeros(1 << 20, bool) for n in self.lengths}
        for n, known in self.known.items():
            self.leading[n][known >> np.uint64(44)] = True


def find_items(offsets: np.ndarray, data: np.ndarray, benchmark: Benchmark, threshold: float) -> list[list[dict]]:
    """For each document, the best window for every item that a window is similar to."""
    found: dict[tuple[int, int], tuple] = {}
    h, doc, _, _ = words(offsets, data, ALNUM)
    first_word = np.searchsorted(doc, np.arange(len(offsets) - 1))
    n_words = np.diff(np.r_[first_word, len(h)])
    for k in benchmark.lengths:
        if not len(h):
            break
        s, of, at = shingles(h, doc, k)
        whole = n_words[of] >= k
        s, of, at = s[whole], of[whole], at[whole]
        known = benchmark.known[k]
        flag = benchmark.leading[k][s >> np.uint64(44)]
        maybe = np.flatnonzero(flag)
        flag[maybe] = known[np.minimum(np.searchsorted(known, s[maybe]), len(known) - 1)] == s[maybe]
        if not flag.any():
            continue
        # Documents without any shingle of an item have no similar window.
        docs = np.unique(of[flag])
        keep = np.isin(of, docs)
        s, of, at, flag = s[keep], of[keep], at[keep], flag[keep]
        seen, sums = np.r_[0, np.cumsum(flag)], bit_sums(s)
        start_of = np.searchsorted(of, docs)
        count_of = np.searchsorted(of, docs, side="right") - start_of
        for group in benchmark.groups:
            if min(benchmark.k, group.size) != k:
                continue
            # The windows of a document of fewer words than the item: one, the whole of it.
            span = np.minimum(group.size - k + 1, count_of)
            windows = count_of - span + 1
            row = np.repeat(np.arange(len(docs)), windows)
            begin = start_of[row] + np.arange(windows.sum()) - np.repeat(np.r_[0, np.cumsum(windows)[:-1]], windows)
            end = begin + span[row]
            # Similar bags share threshold/(1 + threshold) of their shingles together, or more: windows with
            # fewer shingles of items than that are similar to none.
            least = threshold / (1 + threshold) * (span[row] + group.size - k + 1)
            live = np.flatnonzero(seen[end] - seen[begin] >= least - 1e-9)
            for a in range(0, len(live), 1 << 14):
                b, e = begin[live[a : a + (1 << 14)]], end[live[a : a + (1 << 14)]]
                found_pairs = group.index.search(fingerprints(sums, b, e))
                for place, item, distance in zip(*(x.tolist() for x in found_pairs)):
                    similarity = _similarity(Counter(s[b[place] : e[place]].tolist()), group.bags[item])
                    if similarity >= threshold:
                        d = int(of[b[place]])
                        hit = (-similarity, distance, int(at[b[place]] - first_word[d]), int(e[place] - b[place] + k - 1))
                        key = (d, group.ids[item])
                        found[key] = min(found.get(key, hit), hit)
    hits: list[list[dict]] = [[] for _ in range(len(offsets) - 1)]
    for d, item in sorted(found, key=lambda key: (key[0], key[1] is not None, key[1] or 0)):
        similarity, distance, start, size = found[d, item]
        hits[d].append({"item_id": item, "similarity": -similarity, "distance": distance, "start_word": start, "n_words": size})
    return hits


def _similarity(x: Counter, y: Counter) -> float:
    """Weighted Jaccard: shingles weigh as often as they occur."""
    shared = (x & y).total()
    return shared / (x.total() + y.total() - shared)


def benchmark_passes(items: DataFrame, id_col: str, text_col: str) -> Iterator[list[tuple[int, str]]]:
    """The items, some megabytes at a time: a benchmark of any size takes as many passes as it needs."""
    rows = items.where(F.col(text_col).isNotNull()).select(F.col(id_col).cast("long").alias("i"), F.col(text_col).alias("t"))
    size = rows.agg(F.count("*").alias("n"), F.sum(F.octet_length("t")).alias("b")).first()
    passes = max(-(-size.n // PASS_ITEMS), -(-(size.b or 0) // PASS_BYTES), 1)
    for part in range(passes):
        yield [(r.i, r.t) for r in rows.where(F.pmod(F.xxhash64("i", "t"), F.lit(passes)) == part).orderBy("i", "t").collect()]


def hits_column(benchmark: Benchmark, threshold: float):
    """A function of a text column: the items it holds."""

    @F.arrow_udf(_HIT)
    def hits(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in texts:
            offsets, data = text_buffers(column)
            found: list[list[dict]] = []
            for a, z in slices(offsets, max_bytes=2 << 20, max_rows=4096):
                found += find_items(offsets[a : z + 1] - offsets[a], data[offsets[a] : offsets[z]], benchmark, threshold)
            yield pa.array(found, _HIT_ARROW)

    return hits


def contaminated(
    docs: DataFrame,
    items: DataFrame,
    words_per_shingle: int = 5,
    threshold: float = 0.8,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
) -> DataFrame:
    """Every document with every benchmark item that one of its windows is similar to.

    Words are runs of letters and digits, A-Z lower-cased. For an item of m words, every window of m words
    of a document (all of a shorter one) that holds enough shingles of items gets a 64-bit SimHash of its
    shingles, weighted by how often they occur. An index of four 16-bit blocks finds all fingerprints
    within 15 bits: two of them differ by three bits at most in some block. The shingles of those windows
    are then compared exactly: the sum of the smaller counts over the sum of the larger must reach the
    threshold. An item of fewer words than a shingle is one shingle. Windows with so few shingles of items
    that they cannot reach the threshold get no fingerprint.

    Null and empty texts and items hold nothing. An item without an id is found under a null id (all such
    items in a document are one hit, the best), before those with one. Items of equal text are all found; a repeated row is found
    for itself; an empty table gives no rows. Only the named columns are read. Returns ``doc_id``,
    ``item_id`` and, of the best window (the first, in a tie), ``similarity``, ``distance``, ``start_word``
    and ``n_words``.
    """
    found = None
    for part in benchmark_passes(items, item_col, item_text_col):
        hits = hits_column(Benchmark(part, words_per_shingle), threshold)
        rows = docs.select(F.col(id_col).alias("doc_id"), hits(F.col(text_col)).alias("hits"))
        rows = rows.select("doc_id", F.explode("hits").alias("hit")).select("doc_id", "hit.*")
        found = rows if found is None else found.unionByName(rows)
    return found


def without_items(docs: DataFrame, items: DataFrame, words_per_shingle: int = 5, threshold: float = 0.8) -> DataFrame:
    """The documents that hold no benchmark item, as :func:`contaminated` finds them."""
    for part in benchmark_passes(items, "item_id", "text"):
        hits = hits_column(Benchmark(part, words_per_shingle), threshold)
        docs = docs.where(F.size(hits(F.col("text"))) == 0)
    return docs


@query("op6_simhash_decontamination")
def op6_simhash_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
