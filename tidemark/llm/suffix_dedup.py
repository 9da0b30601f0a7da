"""Removal of text that earlier documents hold, by suffix arrays.

A string of ``MATCH`` bytes is found again through its anchor, the ``GRAM`` bytes in it with the
smallest hash, which is the same wherever the string stands. Documents are packed into blocks. Blocks
send the hashes of their anchors to buckets, which answer which of them occur in two texts or more.
Only around those do blocks send text on: for each anchor the bytes of all strings that it stands for,
to a shard chosen by the anchor. A shard builds the suffix array of what it gets, takes common
prefixes from it, and answers for each string which is the smallest id of a document that holds it.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import column, mixed, slices, stored

MATCH, GRAM = 50, 16
_SPAN = MATCH - GRAM + 1
_ROW = 64  # most strings in a context
BLOCK_BYTES = 2 << 20
# About so many anchors in a bucket, and so much text in a shard.
BUCKET_ANCHORS = 1 << 20
SHARD_BYTES = 4 << 20
_NEVER = np.iinfo(np.int64).max
# Places whose hashes are compared at a time; what is held of them fits a core's cache.
_PLACES = 1 << 14
_LOW40 = np.uint64((1 << 40) - 1)


def _zip(data: bytes) -> bytes:
    return len(data).to_bytes(8, "little") + pa.compress(data, codec="zstd", asbytes=True)


def _unzip(data: bytes) -> bytes:
    return pa.decompress(data[8:], int.from_bytes(data[:8], "little"), codec="zstd", asbytes=True)


def _loads(data: np.ndarray) -> np.ndarray:
    """Eight bytes from each place on as a big-endian number; zeros follow the end."""
    padded = np.concatenate([data, np.zeros(8, dtype=np.uint8)])
    return np.ndarray(len(data), dtype=">u8", buffer=padded.tobytes(), strides=(1,)).astype(np.uint64)


def suffix_array(data: np.ndarray) -> np.ndarray:
    """Places of ``data`` in the order of the bytes from there on.

    Larsson-Sadakane: places are grouped by their first eight bytes, then groups of more than one are
    refined by the group that lies 8, 16, ... further on, which doubles the depth each time.
    """
    n = len(data)
    keys = _loads(data)
    order = np.argsort(keys)
    heads = np.flatnonzero(np.concatenate([[True], keys[order[1:]] != keys[order[:-1]]])) if n else np.zeros(0, int)
    sizes = np.diff(heads, append=n)
    rank = np.empty(n, dtype=np.int64)
    rank[order] = np.repeat(heads, sizes)
    active = np.flatnonzero(np.repeat(sizes > 1, sizes))
    step = 8
    while len(active):
        places = order[active]
        beyond = places + step
        second = np.where(beyond < n, rank[np.minimum(beyond, n - 1)], -1)
        key = rank[places] * (n + 1) + second + 1
        inner = np.argsort(key)
        key, places = key[inner], places[inner]
        order[active] = places
        fresh = np.concatenate([[True], key[1:] != key[:-1]])
        # ``active`` is in order, and a group lies side by side in it
        rank[places] = active[np.maximum.accumulate(np.where(fresh, np.arange(len(active)), 0))]
        first = np.flatnonzero(fresh)
        lengths = np.diff(first, append=len(active))
        active = active[np.repeat(lengths > 1, lengths)]
        step *= 2
    return order


def sparse_suffix_array(data: np.ndarray, places: np.ndarray, depth: int = MATCH) -> np.ndarray:
    """``places`` in the order of the ``depth`` bytes from there on (8 or more), which ``data`` has for each.

    Groups of places that share all bytes so far are refined by the next eight, ranked once for all of ``data``.
    """
    n = len(data)
    keys = _loads(data)
    order = np.argsort(keys)
    keys = keys[order]
    rank = np.empty(n, dtype=np.int64)
    rank[order] = np.cumsum(np.concatenate([[0], keys[1:] != keys[:-1]]))
    key = rank[places]
    order = np.argsort(key)
    key, places = key[order], places[order]
    active, at = np.arange(len(places)), 0
    while len(active) and at + 8 < depth:
        at = min(at + 8, depth - 8)
        first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
        lengths = np.diff(first, append=len(active))
        several = np.repeat(lengths > 1, lengths)
        active, group = active[several], np.repeat(np.arange(len(first)), lengths)[several]
        if len(active):
            held = places[active]
            key = group * n + rank[held + at]
            inner = np.argsort(key)
            key, places[active] = key[inner], held[inner]
    return places


def common_prefixes(data: np.ndarray, order: np.ndarray, starts: np.ndarray | None = None, limit: int = MATCH) -> np.ndarray:
    """Bytes that each place shares with the one before it in ``order``, up to ``limit``.

    Neighbours are compared eight bytes at a time, those that shared all so far only. Places that are not in ``order``
    share none; prefixes run on over the ``starts`` of pieces.
    """
    n = len(data)
    shared = np.zeros(n, dtype=np.int64)
    loads = _loads(data)
    for at in range(1, len(order), _PLACES):
        a, b = order[at - 1 : at - 1 + _PLACES], order[at : at + _PLACES]
        a = a[: len(b)]
        most = np.minimum(limit, n - np.maximum(a, b))
        same, open_ = np.zeros(len(b), dtype=np.int64), np.arange(len(b))
        for k in range(0, limit, 8):
            open_ = open_[most[open_] > k]
            if not len(open_):
                break
            differ = loads[a[open_] + k] ^ loads[b[open_] + k]
            same[open_] = k + 8
            first = np.flatnonzero(differ)
            if len(first):
                # the bytes before the first that differs; the first byte is the highest
                bytes_ = sum((differ[first] < np.uint64(1 << 8 * j)).astype(np.int64) for j in range(1, 8))
                same[open_[first]] = k + bytes_
                open_ = open_[differ == 0]
        shared[b] = np.minimum(same, most)
    return shared


def smallest_holders(contexts: list[bytes], holders: np.ndarray) -> list[np.ndarray]:
    """For each string of ``MATCH`` bytes in each context: the smallest holder of it in any of them."""
    data = np.frombuffer(b"".join(contexts), dtype=np.uint8)
    lengths = np.array([len(c) for c in contexts])
    starts = np.cumsum(lengths) - lengths
    place = np.arange(len(data)) - np.repeat(starts, lengths)
    whole = place + MATCH <= np.repeat(lengths, lengths)
    order = sparse_suffix_array(data, np.flatnonzero(whole))
    heads = np.flatnonzero(common_prefixes(data, order)[order] < MATCH)
    least = np.minimum.reduceat(np.repeat(holders, lengths)[order], heads)
    found = np.empty(len(data), dtype=np.int64)
    found[order] = np.repeat(least, np.diff(heads, append=len(order)))
    return [found[a : a + n - MATCH + 1] for a, n in zip(starts.tolist(), lengths.tolist(), strict=True)]


def _least_hashes(data: np.ndarray) -> np.ndarray:
    """The smallest hash of ``GRAM`` bytes in the ``MATCH`` bytes from each place on."""
    n = len(data) - MATCH + 1
    least = np.empty(n, dtype=np.uint64)
    for at in range(0, n, _PLACES):
        stop = min(n, at + _PLACES)
        loads = _loads(data[at : stop + MATCH - 1])
        hashes = loads[: len(loads) - GRAM + 1]
        for k in range(8, GRAM, 8):
            hashes = hashes * np.uint64(0x9E3779B97F4A7C15) + loads[k : k + len(hashes)]
        best, width = mixed(hashes), 1
        while width < _SPAN:  # the smallest of 1, 2, 4, ... hashes from each place on
            shift = min(width, _SPAN - width)
            best = np.minimum(best[shift:], best[:-shift])
            width += shift
        least[at:stop] = best
    return least


def anchors(data: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash, first string, last string) of every anchor; the strings it stands for are side by side.

    Strings in a row with the same smallest hash have one anchor; long rows, as in periodic text, are
    cut, which changes nothing but where their bytes are sent.
    """
    none = np.zeros(0, dtype=np.int64)
    strings = np.maximum(sizes - MATCH + 1, 0)
    if not strings.sum():
        return none.astype(np.uint64), none, none
    starts = (np.cumsum(sizes) - sizes)[strings > 0]
    ends = starts + strings[strings > 0]
    best = _least_hashes(data)
    inside = np.zeros(len(best) + 1, dtype=np.int8)
    inside[starts], inside[ends] = 1, -1
    fresh = np.concatenate([[True], best[1:] != best[:-1]])
    fresh[starts] = True
    head = np.flatnonzero(fresh & (np.cumsum(inside[:-1], dtype=np.int8) > 0))
    length = np.minimum(np.append(head[1:], len(best)), ends[np.searchsorted(starts, head, "right") - 1]) - head
    parts = -(-length // _ROW)
    step = np.arange(parts.sum()) - np.repeat(np.cumsum(parts) - parts, parts)
    first = np.repeat(head, parts) + step * _ROW
    last = np.minimum(first + _ROW, np.repeat(head + length, parts)) - 1
    return best[first], first, last


class Block:
    """One packed row: documents end to end."""

    def __init__(self, row: dict, n_buckets: int) -> None:
        self.bytes = _unzip(row["data"])
        self.sizes = np.array(row["sizes"], dtype=np.int64)
        self.ids = np.array([_NEVER if i is None else i for i in row["doc_ids"]], dtype=np.int64)
        self.starts = np.cumsum(self.sizes) - self.sizes
        hashes, self.first, self.last = anchors(np.frombuffer(self.bytes, dtype=np.uint8), self.sizes)
        self.doc = np.searchsorted(self.starts, self.first, "right") - 1
        self.bucket = (hashes % np.uint64(n_buckets)).astype(np.int64)
        self.code = (self.bucket.astype(np.uint64) << np.uint64(40)) | (hashes // np.uint64(n_buckets) & _LOW40)
        known = self.ids[self.doc] != _NEVER  # a document without an id neither loses nor removes text
        for name in ("first", "last", "doc", "bucket", "code"):
            setattr(self, name, getattr(self, name)[known])

    def contexts(self, shared: list[bytes], gone: list[int], n_shards: int) -> dict[int, dict[bytes, list[int]]]:
        """By shard: each context and its anchors, in an order that repeats. Whole copies send none."""
        codes = np.sort(np.concatenate([np.frombuffer(s, dtype="<u8") for s in shared]))
        at = np.minimum(np.searchsorted(codes, self.code), len(codes) - 1)
        use = (codes[at] == self.code) & ~np.isin(self.doc, np.array(gone, dtype=np.int64))
        found: dict[int, dict[bytes, list[int]]] = {}
        used = np.flatnonzero(use)
        shard = (mixed(self.code[used]) % np.uint64(n_shards)).astype(np.int64)
        each = (x.tolist() for x in (used, shard, self.first[used], self.last[used] + MATCH))
        for i, to, first, end in zip(*each, strict=True):
            found.setdefault(to, {}).setdefault(self.bytes[first:end], []).append(i)
        return found


def _listed(found: dict[bytes, list[int]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The anchors of all contexts in a row, where those of each begin, and how many they are."""
    times = np.array([len(i) for i in found.values()])
    anchor = np.fromiter(chain.from_iterable(found.values()), dtype=np.int64, count=int(times.sum()))
    return anchor, np.cumsum(times) - times, times


def _ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """``starts[0]``, ``starts[0] + 1``, ... to the length of each."""
    return np.arange(lengths.sum()) + np.repeat(starts - np.cumsum(lengths) + lengths, lengths)


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        for i in range(batch.num_rows):
            yield {name: batch.column(name)[i].as_py() for name in batch.schema.names}


def _batch(schema: dict[str, pa.DataType], rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) if rows else [()] * len(schema)
    return pa.RecordBatch.from_arrays(
        [pa.array(list(c), type=t) for c, t in zip(columns, schema.values(), strict=True)], list(schema)
    )


_LONG, _BINARY = pa.int64(), pa.binary()


def _pack(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Blocks of whole documents: ids, sizes, checksums of the texts, and the bytes, compressed."""
    source = docs.select(column(docs, id_col).cast("long").alias("doc_id"), column(docs, text_col).alias("text"))
    schema = {
        "block": _LONG,
        "doc_ids": pa.list_(_LONG),
        "sizes": pa.list_(_LONG),
        "keys": pa.list_(_BINARY),
        "data": _BINARY,
    }

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = TaskContext.get().partitionId() << 32
        for whole in batches:
            for batch in slices(whole, "text", BLOCK_BYTES):
                texts = [(t or "").encode() for t in batch.column("text").to_pylist()]
                keys = [xxhash.xxh128_digest(t) for t in texts]
                ids = batch.column("doc_id").to_pylist()
                yield _batch(schema, [(block, ids, [len(t) for t in texts], keys, _zip(b"".join(texts)))])
                block += 1

    kinds = "block long, doc_ids array<long>, sizes array<long>, keys array<binary>, data binary"
    return source.mapInArrow(rows, kinds)


def _whole_copies(blocks: DataFrame) -> DataFrame:
    """``block`` and the places in it of texts that a smaller id also has, from checksums alone."""
    each = blocks.select("block", F.posexplode(F.arrays_zip("doc_ids", "keys", "sizes")).alias("place", "d"))
    each = each.select("block", "place", "d.*").filter(F.col("sizes") >= MATCH)
    first = each.groupBy("keys").agg(F.min("doc_ids").alias("least"), F.count("*").alias("n")).filter("n > 1")
    copies = each.join(first, "keys").filter("doc_ids > least")
    return copies.groupBy("block").agg(F.collect_list("place").alias("gone"))


def _shared_anchors(blocks: DataFrame, n_buckets: int) -> DataFrame:
    """``block`` and its anchors (sorted codes per bucket) that occur in two different texts.

    An entry is an anchor's code and a place in the row's list of ``texts``, the 64-bit checksums by
    which texts are told apart; a text's checksum is sent once for all its anchors of a bucket.
    """

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = {"bucket": _LONG, "block": _LONG, "entries": _BINARY, "texts": _BINARY}
        for row in _rows(batches):
            block = Block(row, n_buckets)
            key = np.array([int.from_bytes(k[:8], "little") for k in row["keys"]], dtype=np.uint64)
            code, text = block.code & _LOW40, key[block.doc]
            order = np.argsort(block.bucket, kind="stable")
            cuts = np.flatnonzero(np.diff(block.bucket[order])) + 1
            out = []
            for part in np.split(order, cuts) if len(order) else []:
                texts, place = np.unique(text[part], return_inverse=True)
                found = np.unique(code[part] << np.uint64(24) | place.astype(np.uint64))
                sent = found.astype("<u8").tobytes(), texts.astype("<u8").tobytes()
                out.append((int(block.bucket[part[0]]), row["block"], *sent))
            yield _batch(schema, out)

    def answer(group: pa.Table) -> pa.Table:
        lists = [np.frombuffer(e, dtype="<u8") for e in group["entries"].to_pylist()]
        codes = np.concatenate([e >> np.uint64(24) for e in lists])
        checksums = [np.frombuffer(t, dtype="<u8") for t in group["texts"].to_pylist()]
        places = [(e & np.uint64(0xFFFFFF)).astype(np.int64) for e in lists]
        texts = np.concatenate([t[at] for t, at in zip(checksums, places, strict=True)])
        order = np.argsort(codes)
        codes, texts = codes[order], texts[order]
        # one code, two texts: some neighbours of equal code differ in text
        shared = np.unique(codes[1:][(codes[1:] == codes[:-1]) & (texts[1:] != texts[:-1])])
        bucket = np.uint64(group["bucket"][0].as_py()) << np.uint64(40)
        rows = []
        for block, entries in zip(group["block"].to_pylist(), lists, strict=True):
            own = np.unique(entries >> np.uint64(24))
            own = own[np.isin(own, shared, assume_unique=True)]
            if len(own):
                rows.append((block, (own | bucket).astype("<u8").tobytes()))
        return pa.Table.from_batches([_batch({"block": _LONG, "shared": _BINARY}, rows)])

    sent = blocks.select("block", "doc_ids", "sizes", "keys", "data").mapInArrow(
        send, "bucket long, block long, entries binary, texts binary"
    )
    answers = sent.groupBy("bucket").applyInArrow(answer, "block long, shared binary")
    return answers.groupBy("block").agg(F.collect_list("shared").alias("shared"))


def _answers(known: DataFrame, n_buckets: int, n_shards: int) -> DataFrame:
    """``block`` and for each shard the smallest holders of all strings that it sent there."""

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = {"shard": _LONG, "block": _LONG, "lengths": _BINARY, "holders": _BINARY, "codes": _BINARY}
        schema["data"] = _BINARY
        for row in _rows(batches):
            block = Block(row, n_buckets)
            out = []
            for shard, found in block.contexts(row["shared"], row["gone"], n_shards).items():
                anchor, head, _ = _listed(found)
                holders = np.minimum.reduceat(block.ids[block.doc[anchor]], head).astype("<i8")
                lengths = np.array([len(c) for c in found], dtype=np.uint8)
                codes = block.code[anchor[head]].astype("<u4")
                texts = _zip(b"".join(found))
                out.append((shard, row["block"], lengths.tobytes(), holders.tobytes(), codes.tobytes(), texts))
            yield _batch(schema, out)

    def answer(group: pa.Table) -> pa.Table:
        listed, places, holders, same = [], {}, [], {}
        names = ("lengths", "holders", "codes", "data")
        for lengths, holder, codes, data in zip(*(group[c].to_pylist() for c in names), strict=True):
            text, own, at = _unzip(data), [], 0
            numbers = np.frombuffer(holder, dtype="<i8").tolist(), np.frombuffer(codes, dtype="<u4").tolist()
            for n, h, code in zip(lengths, *numbers, strict=True):
                place = places.setdefault(text[at : at + n], len(places))
                if place == len(holders):
                    holders.append(h)
                    same.setdefault(code, []).append(place)
                elif h < holders[place]:
                    holders[place] = h
                own.append(place)
                at += n
            listed.append(own)
        # equal strings have one anchor, so a context that is the only one of its anchor needs no search
        texts, least = list(places), np.array(holders, dtype=np.int64)
        rest = [p for found in same.values() if len(found) > 1 for p in found]
        sizes = np.array([len(t) - MATCH + 1 for t in texts])
        starts = np.cumsum(sizes) - sizes
        every = np.repeat(least, sizes)
        if rest:
            searched = smallest_holders([texts[p] for p in rest], least[rest])
            every[_ranges(starts[rest], sizes[rest])] = np.concatenate(searched)
        rows = []
        for block, own in zip(group["block"].to_pylist(), listed, strict=True):
            answers = every[_ranges(starts[own], sizes[own])]
            rows.append((block, group["shard"][0].as_py(), _zip(answers.astype("<i8").tobytes())))
        return pa.Table.from_batches([_batch({"block": _LONG, "shard": _LONG, "least": _BINARY}, rows)])

    sent = known.filter("shared IS NOT NULL").mapInArrow(
        send, "shard long, block long, lengths binary, holders binary, codes binary, data binary"
    )
    answers = sent.groupBy("shard").applyInArrow(answer, "block long, shard long, least binary")
    return answers.groupBy("block").agg(F.collect_list(F.struct("shard", "least")).alias("answers"))


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id``, ``n_bytes``, ``n_removed``, ``n_spans``, ``kept_sha256`` and ``kept`` of every row.

    A byte is removed if a string of 50 bytes over it also starts in a text with a smaller id, judged
    on the texts as they came; matches stay within a text. ``kept`` holds the remaining bytes. A null
    text is empty; rows with a null id lose nothing and remove nothing; rows with one id do not affect
    each other; ids are whole numbers; other columns are ignored.

    Text moves in compressed blocks, anchors as eight bytes each. Equal contexts of a block are sent
    once, so a passage that a third of all texts share reaches its shard once per block.
    """
    blocks = stored(_pack(docs, id_col, text_col), "suffix-blocks")
    each = F.aggregate("sizes", F.lit(0).cast("long"), lambda a, b: a + b)
    size = blocks.agg(F.coalesce(F.sum(each), F.lit(0))).first()[0]
    n_buckets = max(1, size // 17 // BUCKET_ANCHORS)
    n_shards = max(1, size // SHARD_BYTES)
    gone = F.coalesce("gone", F.array().cast("array<int>")).alias("gone")
    known = _shared_anchors(blocks, n_buckets).join(_whole_copies(blocks), "block", "full")
    known = stored(known.select("block", "shared", gone), "suffix-anchors")
    answers = _answers(blocks.join(known, "block"), n_buckets, n_shards)

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = {
            "doc_id": _LONG,
            "n_bytes": _LONG,
            "n_removed": _LONG,
            "n_spans": _LONG,
            "kept_sha256": pa.string(),
            "kept": _BINARY,
        }
        for row in _rows(batches):
            block = Block(row, n_buckets)
            steps = np.zeros(len(block.bytes) + 1, dtype=np.int64)
            least = {a["shard"]: np.frombuffer(_unzip(a["least"]), dtype="<i8") for a in row["answers"] or []}
            if least:
                for shard, found in block.contexts(row["shared"], row["gone"], n_shards).items():
                    n = np.array([len(c) - MATCH + 1 for c in found])
                    anchor, _, times = _listed(found)
                    offset, n = np.repeat(np.cumsum(n) - n, times), np.repeat(n, times)
                    holder = least[shard][_ranges(offset, n)]
                    hit = _ranges(block.first[anchor], n)
                    hit = hit[holder < np.repeat(block.ids[block.doc[anchor]], n)]
                    steps[hit] += 1  # a string is in one context only, so no place comes twice
                    steps[hit + MATCH] -= 1
            for place in row["gone"] or []:
                steps[block.starts[place]] += 1
                steps[block.starts[place] + block.sizes[place]] -= 1
            removed = np.cumsum(steps[:-1]) > 0
            data, out = np.frombuffer(block.bytes, dtype=np.uint8), []
            for i, (start, n) in enumerate(zip(block.starts.tolist(), block.sizes.tolist(), strict=True)):
                mask = removed[start : start + n]
                kept = data[start : start + n][~mask].tobytes()
                spans = int(mask[0]) + int((mask[1:] & ~mask[:-1]).sum()) if n else 0
                digest = hashlib.sha256(kept).hexdigest()
                out.append((row["doc_ids"][i], n, int(mask.sum()), spans, digest, kept))
            yield _batch(schema, out)

    whole = blocks.join(known, "block", "left").join(answers, "block", "left")
    kinds = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary"
    return whole.mapInArrow(finish, kinds)
