"""Benchmark decontamination: SimHash of windows, Hamming blocks, exact similarity.

Windows of a few sizes slide over every text. An item belongs to a size and step for which any copy
that is similar enough, cut or edited, still holds a window of it unchanged (see ``_clean_run``). Each
item is indexed by the fingerprints of all its own windows of that size. A window of a text and one of an
item within ``RADIUS`` bits agree in one of four 16-bit blocks up to ``RADIUS // 4`` bits, so four
lookups per window find all such pairs. Each pair then says where the item would lie in the text, and
the exact weighted similarity of the shingles there and thereabouts decides.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations
from math import ceil

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import batch_words, column, filter_texts, mixed, slices

SHINGLE = 5
SIMILARITY = 0.8
RADIUS = 11
BITS, BLOCKS = 64, 4
# The benchmark is held by every task, so its size is checked: about ten kilobytes for an item of 60 words, most of it its
# shingles, and 72 MB at most for the near values of blocks.
MAX_ITEMS = 20_000
MAX_BENCHMARK_BYTES = 16 << 20
_BASE = np.uint64(0x9E3779B97F4A7C15)
_CHUNK, _ALIGN = 1 << 14, 16

SCHEMA = "n_items long, items array<long>, best double, first_start long, first_end long"


def _clean_run(n: int, similarity: float) -> int:
    """Shingles in a row that any text similar enough to an item of ``n`` shingles shares with it.

    A place where a copy breaks off and goes on otherwise (a word changed, added, dropped, a part
    moved) costs the item four shingles at least and puts four others in the window. With b such places
    the two share at least similarity * (n + 4 b) shingles, 4 b of the item's are lost, and what is
    shared lies in b + 1 runs. A copy cut by the end of the text only has less of them.
    """
    lost = SHINGLE - 1
    runs, b = [], 0
    while b == 0 or similarity * (n + lost * b) <= n - lost * b:
        runs.append(ceil(round(similarity * (n + lost * b) / (b + 1), 9)))
        b += 1
    return max(1, min(runs))


def _steps(longest: int) -> list[tuple[int, int]]:
    """Window sizes in shingles and the step between windows, for runs of up to ``longest``.

    A run of size + step - 1 shingles holds a window whole. Steps are powers of two up to ``_ALIGN``,
    and texts start at multiples of that.
    """
    sizes, run = [], 1
    while run <= longest:
        step = min(_ALIGN, 1 << ((run + 1) // 2).bit_length() - 1)
        sizes.append((run - step + 1, step))
        run = max(run + 1, run * 3 // 2 if run & (run - 1) == 0 else run * 4 // 3)
    return sizes


def _word_hashes(words: pa.Array) -> np.ndarray:
    low = [xxhash.xxh64_intdigest(w.lower()) for w in words.to_pylist()]
    return np.array(low, dtype=np.uint64)


def shingle_hashes(words: np.ndarray) -> np.ndarray:
    """Hash of every five words in a row; of all words if there are fewer."""
    n = min(SHINGLE, len(words))
    hashes = np.zeros(max(len(words) - n + 1, 0) if n else 0, dtype=np.uint64)
    for k in range(n):
        hashes = hashes * _BASE + words[k : k + len(hashes)]
    return mixed(hashes)


def _running_bits(hashes: np.ndarray) -> np.ndarray:
    """For each bit, of the shingles before each place: how many have it set, less those without."""
    bits = np.unpackbits(hashes.astype("<u8").view(np.uint8), bitorder="little").reshape(-1, BITS)
    kind = np.int16 if len(hashes) < 1 << 15 else np.int32
    sums = np.zeros((BITS, len(hashes) + 1), dtype=kind)
    np.cumsum(2 * bits.T.astype(np.int8) - 1, axis=1, dtype=kind, out=sums[:, 1:])
    return sums


def _window_prints(sums: np.ndarray, size: int, step: int) -> np.ndarray:
    """Fingerprints of the windows of ``size`` shingles that start at every multiple of ``step``."""
    over = (sums[:, size::step] > sums[:, : sums.shape[1] - size : step]).view(np.uint8)
    packed = over[0::8].copy()  # bit 0 of the eight bytes, then the others
    for bit in range(1, 8):
        packed |= over[bit::8] << bit
    return np.ascontiguousarray(packed.T).view("<u8").ravel()


def weighted_similarity(a: dict[int, int], b: dict[int, int]) -> float:
    """Shingles that two texts share over those of both, each weighted by how often it occurs."""
    both = sum(min(n, b[h]) for h, n in a.items() if h in b)
    total = sum(a.values()) + sum(b.values()) - both
    return both / total if total else 0.0


@dataclass(frozen=True)
class Item:
    number: int
    hashes: np.ndarray
    counts: dict[int, int]


@dataclass(frozen=True)
class SizeIndex:
    """Fingerprints of the items' windows of one size, by block value."""

    size: int
    step: int
    prints: np.ndarray
    item: np.ndarray
    offset: np.ndarray
    near_start: np.ndarray  # BLOCKS x 65537 offsets into ``near``
    near: list[np.ndarray]  # by value of a block: the values within its share of the radius that windows have
    start: np.ndarray  # BLOCKS x 65537 offsets into ``entry``
    entry: list[np.ndarray]  # by value of a block: the windows that have it


def _near_values(values: np.ndarray, distance: int) -> np.ndarray:
    """All 16-bit values within ``distance`` bits of each of ``values``: one row per value."""
    masks = [0]
    for n in range(1, distance + 1):
        masks += [sum(1 << k for k in c) for c in combinations(range(16), n)]
    return values[:, None] ^ np.array(masks, dtype=np.int64)


def build_index(
    items: list[tuple[int, str]], radius: int = RADIUS, similarity: float = SIMILARITY
) -> tuple[list[Item], list[SizeIndex]]:
    """Items by place, and an index for each window size in use. An item without words is left out."""
    known = []
    for number, text in items:
        n_words, codes, words = batch_words(pa.array([text], type=pa.string()))
        if n_words[0]:
            hashes = shingle_hashes(_word_hashes(words)[codes])
            known.append(Item(number, hashes, Counter(hashes.tolist())))
    clean = [_clean_run(len(i.hashes), similarity) for i in known]
    sizes = _steps(max(clean, default=0))
    of: dict[int, list[int]] = {}
    for place, run in enumerate(clean):
        k = max(k for k, (size, step) in enumerate(sizes) if size + step - 1 <= run)
        of.setdefault(k, []).append(place)
    indexes = []
    for k, places in sorted(of.items()):
        size, step = sizes[k]
        prints, item, offset = [], [], []
        for place in places:
            hashes = known[place].hashes
            starts = np.arange(len(hashes) - size + 1)
            prints.append(_window_prints(_running_bits(hashes), size, 1))
            item.append(np.full(len(starts), place))
            offset.append(starts)
        prints, item, offset = np.concatenate(prints), np.concatenate(item), np.concatenate(offset)
        near_start, near = np.zeros((BLOCKS, (1 << 16) + 1), dtype=np.int64), []
        start, entry = np.zeros((BLOCKS, (1 << 16) + 1), dtype=np.int64), []
        for block in range(BLOCKS):
            values = (prints >> np.uint64(16 * block) & np.uint64(0xFFFF)).astype(np.int64)
            start[block, 1:] = np.cumsum(np.bincount(values, minlength=1 << 16))
            entry.append(np.argsort(values, kind="stable").astype(np.int32))
            used = np.unique(values)
            around = _near_values(used, radius // BLOCKS)
            near_start[block, 1:] = np.cumsum(np.bincount(around.ravel(), minlength=1 << 16))
            near.append(used[np.argsort(around.ravel(), kind="stable") // around.shape[1]].astype(np.uint16))
        indexes.append(SizeIndex(size, step, prints, item, offset, near_start, near, start, entry))
    return known, indexes


def _runs(start: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(place in ``values``, place in the list) of all entries that ``start`` gives for each of ``values``."""
    first = start[values]
    n = start[values + 1] - first
    return np.repeat(np.arange(len(values)), n), np.repeat(first - (np.cumsum(n) - n), n) + np.arange(n.sum())


def _candidates(prints: np.ndarray, index: SizeIndex, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """(window, entry) of all pairs within ``radius`` bits, each once."""
    found = []
    for block in range(BLOCKS):
        values = (prints >> np.uint64(16 * block) & np.uint64(0xFFFF)).astype(np.int64)
        window, at = _runs(index.near_start[block], values)
        if len(at):
            place, at = _runs(index.start[block], index.near[block][at].astype(np.int64))
            window, entry = window[place], index.entry[block][at].astype(np.int64)
            near = np.bitwise_count(prints[window] ^ index.prints[entry]) <= radius
            found.append(window[near] * len(index.prints) + entry[near])
    if not found:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    pairs = np.unique(np.concatenate(found))
    return pairs // len(index.prints), pairs % len(index.prints)


class Matcher:
    """Finds items in texts of a batch."""

    def __init__(self, items: list[tuple[int, str]], similarity: float, radius: int) -> None:
        self.known, self.indexes = build_index(items, radius, similarity)
        self.similarity, self.radius = similarity, radius

    def _shift(self, size: int) -> int:
        """How far words added or dropped within a copy may move the rest of it."""
        return ceil(size * (1 - self.similarity) / (1 + self.similarity)) if self.similarity > 0 else size

    def _verified(self, hashes: np.ndarray, low: int, high: int, at: int, item: Item, slack: int) -> tuple[float, int]:
        """Best exact similarity of the item with windows that start within ``slack`` of ``at``."""
        size, best, where = len(item.hashes), 0.0, at
        first, last = max(low, at - slack), min(high - 1, max(low, at + slack))
        around = hashes[first : min(last + size, high)].tolist()
        if sum(h in item.counts for h in around) < self.similarity * size:
            return best, where  # too few shingles in common, wherever the window starts
        window = Counter(around[:size])
        both = sum(min(n, item.counts[h]) for h, n in window.items() if h in item.counts)
        for start in range(first, last + 1):
            found = both / (size + min(start + size, high) - start - both)
            if found > best:
                best, where = found, start
            # on to the next start: one shingle leaves, and one comes unless the text ends
            gone = around[start - first]
            both -= window[gone] <= item.counts.get(gone, 0)
            window[gone] -= 1
            if start + size < high and start < last:
                new = around[start + size - first]
                window[new] += 1
                both += window[new] <= item.counts.get(new, 0)
        return best, where

    def __call__(self, texts: pa.Array) -> list[dict[int, tuple[float, int, int]]]:
        """For each text the items in it: similarity, and first and last word + 1 of the window."""
        n_words, codes, words = batch_words(texts)
        hashed = _word_hashes(words)[codes] if len(codes) else np.zeros(0, dtype=np.uint64)
        ends = np.cumsum(n_words)
        parts = [shingle_hashes(hashed[e - n : e]) for e, n in zip(ends.tolist(), n_words.tolist(), strict=True)]
        found: list[dict[int, tuple[float, int, int]]] = [{} for _ in parts]
        lengths = np.array([len(p) for p in parts], dtype=np.int64)
        if not self.known or not lengths.sum():
            return found
        room = -(-lengths // _ALIGN) * _ALIGN
        lows = np.cumsum(room) - room
        hashes, of = np.zeros(int(room.sum()), dtype=np.uint64), np.full(int(room.sum()), -1)
        for i, part in enumerate(parts):
            hashes[lows[i] : lows[i] + len(part)] = part
            of[lows[i] : lows[i] + len(part)] = i
        widest = max(i.size for i in self.indexes)
        for begin in range(0, len(hashes), _CHUNK):
            part = hashes[begin : begin + _CHUNK + widest - 1]
            sums = _running_bits(part)
            parents = of[begin : begin + len(part)]
            for index in self.indexes:
                upto = min(_CHUNK, len(part) - index.size + 1)
                if upto <= 0:
                    continue
                prints = _window_prints(sums[:, : upto + index.size], index.size, index.step)
                starts = np.arange(0, upto, index.step)
                whole = (parents[starts] == parents[starts + index.size - 1]) & (parents[starts] >= 0)
                starts, prints = starts[whole], prints[whole]
                seen = set()  # windows of one copy say the same place
                for window, entry in zip(*_candidates(prints, index, self.radius), strict=True):
                    text, item = int(parents[starts[window]]), int(index.item[entry])
                    had = found[text].get(item, (0.0, 0, 0))
                    if had[0] == 1.0:
                        continue
                    low, high = int(lows[text]), int(lows[text] + lengths[text])
                    at = begin + int(starts[window]) - int(index.offset[entry])
                    if (text, item, at) in seen:
                        continue
                    seen.add((text, item, at))
                    slack = max(index.step, self._shift(len(self.known[item].hashes)))
                    got, where = self._verified(hashes, low, high, at, self.known[item], slack)
                    if got >= self.similarity and got > had[0]:
                        last = min(where - low + len(self.known[item].hashes) + SHINGLE - 1, int(n_words[text]))
                        found[text][item] = (got, where - low, last)
        return [
            {self.known[k].number: v for k, v in sorted(f.items(), key=lambda x: self.known[x[0]].number)}
            for f in found
        ]


def _bounded_items(benchmark: DataFrame, item_col: str, item_text_col: str) -> list[tuple[int, str]]:
    rows = benchmark.select(
        column(benchmark, item_col).cast("long").alias("item_id"),
        column(benchmark, item_text_col).alias("text"),
    ).filter("item_id IS NOT NULL AND text IS NOT NULL")
    n_bytes = F.coalesce(F.sum(F.octet_length("text")), F.lit(0))
    size = rows.agg(F.count("*").alias("n"), n_bytes.alias("bytes")).first()
    if size["n"] > MAX_ITEMS or size["bytes"] > MAX_BENCHMARK_BYTES:
        raise ValueError("the benchmark is too large for one task; split it and take the union of the results")
    return [tuple(r) for r in rows.distinct().orderBy("item_id", "text").collect()]


_MATCHERS: dict[str, Matcher] = {}  # the last one built in a worker process


def _matcher(key: str, items: list[tuple[int, str]], similarity: float, radius: int) -> Matcher:
    if key not in _MATCHERS:
        _MATCHERS.clear()
        _MATCHERS[key] = Matcher(items, similarity, radius)
    return _MATCHERS[key]


def _shared(docs: DataFrame, items: list[tuple[int, str]], similarity: float, radius: int):
    data = docs.sparkSession.sparkContext.broadcast(items)
    key = xxhash.xxh128_hexdigest(repr((items, similarity, radius)))
    return lambda: _matcher(key, data.value, similarity, radius)


def find_leaks(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    similarity: float = SIMILARITY,
    radius: int = RADIUS,
) -> DataFrame:
    """Benchmark items in each row's text: ``doc_id`` and the columns of ``SCHEMA``.

    An item is in a text if a window with as many five-word shingles as the item has a similarity of
    ``similarity`` or more with it: shingles they share over all shingles, repeats included, words
    lower-cased. ``items`` are the ids found, ascending; ``best`` is the highest similarity;
    ``first_start`` and ``first_end`` are the words of the first such window. An item of fewer than
    five words is one shingle. Null texts hold nothing; items without an id, text or word are left
    out; repeated rows keep a row each; other columns are ignored. The benchmark is small by nature:
    its size is checked, and each task holds its index.
    """
    source = docs.select(column(docs, id_col).alias("doc_id"), column(docs, text_col).alias("text"))
    kind = source.schema["doc_id"].dataType.simpleString()
    matcher = _shared(docs, _bounded_items(benchmark, item_col, item_text_col), similarity, radius)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        match = matcher()
        for whole in batches:
            for batch in slices(whole, "text", 2 << 20):
                found = match(batch.column("text"))
                spans = [min(((a, b) for _, a, b in f.values()), default=(None, None)) for f in found]
                columns = [
                    pa.array([len(f) for f in found], type=pa.int64()),
                    pa.array([list(f) for f in found], type=pa.list_(pa.int64())),
                    pa.array([max((s for s, _, _ in f.values()), default=0.0) for f in found], type=pa.float64()),
                    pa.array([a for a, _ in spans], type=pa.int64()),
                    pa.array([b for _, b in spans], type=pa.int64()),
                ]
                names = [x.split()[0] for x in SCHEMA.split(", ")]
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *columns], ["doc_id", *names])

    return source.mapInArrow(rows, f"doc_id {kind}, {SCHEMA}")


def drop_leaks(
    docs: DataFrame,
    benchmark: DataFrame,
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    similarity: float = SIMILARITY,
    radius: int = RADIUS,
) -> DataFrame:
    """The rows of ``docs``, all columns, whose text holds no benchmark item (see ``find_leaks``).

    A null or empty text holds none and stays. Only the text decides, so rows without an id and repeated
    rows are judged one by one; without rows, or without items, nothing goes.
    """
    matcher = _shared(docs, _bounded_items(benchmark, item_col, item_text_col), similarity, radius)

    def keeper():
        match = matcher()
        return lambda texts: [not found for found in match(texts)]

    return filter_texts(docs, text_col, 2 << 20, keeper)
