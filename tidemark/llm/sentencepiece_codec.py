"""SentencePiece encoding and decoding with a BPE model, by suffix-array matching.

No piece of the model spans the start of a word (a run of spaces and what follows it), so a text is
encoded unit by unit, and a batch's distinct units are enough. Their concatenation is indexed by a
suffix array, every piece is looked up in it by binary search, and its occurrences are the edges of a
lattice. Edges are sorted by where they end and relaxed in that order: a prefix that ends with piece p
after prefix q is the encoding of its characters exactly if merging the last piece of q and p never
crosses from one into the other, and for each end this holds for one edge only.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import column, slices

VOCABULARY = "piece_bpe_32k.model"
SPACE = "▁"
_UNIT = re.compile(f"{SPACE}+[^{SPACE}]*")
_DEPTH, _LANE = 16, 4  # longest piece; characters in a 64-bit key
_START = -2
_PAIR_BITS, _SPREAD = 21, np.uint64(0x9E3779B97F4A7C15)


class Codec:
    """Encoder and decoder of one model file. Units seen before are remembered up to a bound."""

    def __init__(self, path: str, remembered: int = 500_000) -> None:
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        n = model.get_piece_size()
        self.pieces = [model.id_to_piece(i) for i in range(n)]
        self._byte = {int(self.pieces[i][3:-1], 16): i for i in range(n) if model.is_byte(i)}
        special = {i for i in range(n) if model.is_control(i) or model.is_unknown(i) or model.is_byte(i)}
        self._score = {self.pieces[i]: model.get_score(i) for i in range(n) if i not in special}
        usable = np.array([i for i in range(n) if i not in special])
        if any(SPACE in self.pieces[i].lstrip(SPACE) for i in usable) or len(self._byte) != 256:
            raise ValueError("the model needs byte fallback and pieces that start no word inside")
        if max(len(self.pieces[i]) for i in usable) > _DEPTH:
            raise ValueError(f"a piece is longer than {_DEPTH} characters")
        self._bytes = [self.pieces[i].replace(SPACE, " ").encode() for i in range(n)]
        for value, i in self._byte.items():
            self._bytes[i] = bytes([value])
        for i in special - set(self._byte.values()):
            self._bytes[i] = b""
        # dense character codes: 0 ends a unit, 1 is in no piece
        chars = sorted(set("".join(self._score)))
        self._code = np.ones(0x110000, dtype=np.uint16)
        self._code[[ord(c) for c in chars]] = np.arange(2, len(chars) + 2)
        # pieces whose own encoding is something else never occur
        self._ids = np.array([i for i in usable.tolist() if self._merged(self.pieces[i]) == [self.pieces[i]]])
        self._lengths = np.array([len(p) for p in self.pieces])
        codes = np.zeros((len(self._ids), _DEPTH), dtype=np.uint16)
        for row, i in enumerate(self._ids.tolist()):
            codes[row, : len(self.pieces[i])] = self._code[[ord(c) for c in self.pieces[i]]]
        self._first = self._keys(codes)
        self._last = self._keys(np.where(codes == 0, 0xFFFF, codes))
        # answers for pairs of pieces: all of them, and those of each slot of a table that numpy can read
        self._fits: dict[int, bool] = {}
        self._pair, self._fit = np.full(1 << _PAIR_BITS, -1), np.zeros(1 << _PAIR_BITS, dtype=bool)
        self._remembered = remembered
        self._forget()

    def _forget(self) -> None:
        self._known: dict[str, int] = {}
        self._flat, self._sizes = np.zeros(0, dtype=np.int32), np.zeros(0, dtype=np.int64)

    @staticmethod
    def _keys(codes: np.ndarray) -> list[np.ndarray]:
        """Rows of 16 codes as four numbers each that sort like them."""
        shifts = np.array([48, 32, 16, 0], dtype=np.uint64)
        lanes = codes.reshape(-1, _DEPTH // _LANE, _LANE).astype(np.uint64) << shifts
        return list(np.ascontiguousarray(lanes.sum(axis=2, dtype=np.uint64).T))

    def _merged(self, text: str) -> list[str]:
        """Pieces of a short string by the merges themselves: best score first, then leftmost."""
        parts = list(text)
        while len(parts) > 1:
            joined = [self._score.get(a + b) for a, b in zip(parts, parts[1:], strict=False)]
            best = max((s for s in joined if s is not None), default=None)
            if best is None:
                break
            at = joined.index(best)
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def _compatible(self, before: np.ndarray, after: np.ndarray) -> np.ndarray:
        """Whether two pieces side by side stay two pieces."""
        pairs = before.astype(np.int64) * len(self.pieces) + after
        slots = (pairs.astype(np.uint64) * _SPREAD >> np.uint64(64 - _PAIR_BITS)).astype(np.int64)
        missing = self._pair[slots] != pairs
        if missing.any():
            if len(self._fits) > 1_000_000:
                self._fits = {}
            fresh, where = np.unique(pairs[missing], return_inverse=True)
            known, fits = self._fits, []
            for pair in fresh.tolist():
                if (fit := known.get(pair)) is None:
                    a, b = self.pieces[pair // len(self.pieces)], self.pieces[pair % len(self.pieces)]
                    fit = known[pair] = self._merged(a + b) == [a, b]
                fits.append(fit)
            good = self._fit[slots]
            good[missing] = np.array(fits, dtype=bool)[where]
            at, first = np.unique(slots[missing], return_index=True)  # one pair for each slot
            self._pair[at], self._fit[at] = pairs[missing][first], good[missing][first]
            return good
        return self._fit[slots]

    @staticmethod
    def _bounds(keys: list[np.ndarray], order: np.ndarray, wanted: list[np.ndarray], upto: bool) -> np.ndarray:
        """For each wanted key: how many suffixes come before it, or up to it; all at once, step by step."""
        low, high = np.zeros(len(wanted[0]), dtype=np.int64), np.full(len(wanted[0]), len(order))
        while (open_ := low < high).any():
            middle = (low + high) // 2
            at = order[np.minimum(middle, len(order) - 1)]
            less, equal = np.zeros(len(at), dtype=bool), np.ones(len(at), dtype=bool)
            for lane, want in zip(keys, wanted, strict=True):
                value = lane[at]
                less |= equal & (value < want)
                equal &= value == want
            less |= equal & upto
            low = np.where(open_ & less, middle + 1, low)
            high = np.where(open_ & ~less, middle, high)
        return low

    def _learn(self, units: list[str]) -> None:
        """Encode new units and remember their ids."""
        text = "\n".join(units) + "\n"
        points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        lengths = np.array([len(u) for u in units])
        starts = np.cumsum(lengths + 1) - lengths - 1
        unit_of = np.repeat(np.arange(len(units)), lengths + 1)
        codes = self._code[points]
        codes[starts + lengths] = 0
        # keys of all suffixes, 16 characters deep; a separator stops them
        padded = np.concatenate([codes, np.zeros(_DEPTH, dtype=np.uint16)])
        window = np.lib.stride_tricks.sliding_window_view(padded, _DEPTH)[: len(codes)]
        keys = self._keys(np.where(np.minimum.accumulate(window, axis=1) == 0, 0, window))
        order = np.lexsort(keys[::-1])
        low, high = self._bounds(keys, order, self._first, False), self._bounds(keys, order, self._last, True)
        n = high - low
        begin = order[np.repeat(low - (np.cumsum(n) - n), n) + np.arange(n.sum())]
        piece = np.repeat(self._ids, n)
        # characters in no piece are edges of their own, numbered after the pieces
        odd = np.flatnonzero((codes == 1))
        odd_points, odd_piece = np.unique(points[odd], return_inverse=True)
        begin = np.concatenate([begin, odd])
        piece = np.concatenate([piece, len(self.pieces) + odd_piece])
        width = np.concatenate([self._lengths, np.ones(len(odd_points), dtype=np.int64)])
        end = begin + width[piece]
        depth = end - starts[unit_of[begin]]
        rank = np.argsort(depth, kind="stable")
        begin, end, piece, depth = begin[rank], end[rank], piece[rank], depth[rank]
        last = np.full(len(codes) + 1, -1)
        last[starts] = _START
        cuts = np.searchsorted(depth, np.arange(1, int(lengths.max()) + 2))
        for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
            before, after = last[begin[a:b]], piece[a:b]
            free = (before == _START) | (before >= len(self.pieces)) | (after >= len(self.pieces))
            check = np.flatnonzero(~free & (before >= 0))
            good = free & (before != -1)
            good[check] = self._compatible(before[check], after[check])
            last[end[a:b][good]] = after[good]
        # walk back from the ends of all units at once
        at, path = starts + lengths, []
        alive = np.arange(len(units))
        while len(alive):
            token = last[at[alive]]
            path.append((alive, token))
            at[alive] -= width[token]
            alive = alive[at[alive] > starts[alive]]
        unit = np.concatenate([p[0] for p in path])
        token = np.concatenate([p[1] for p in path])
        forward = np.lexsort((-np.repeat(np.arange(len(path)), [len(p[0]) for p in path]), unit))
        unit, token = unit[forward], token[forward]
        spelled = [[i] for i in range(len(self.pieces))] if len(odd_points) else []
        if len(odd_points):
            spelled += [[self._byte[b] for b in chr(p).encode("utf-8", "replace")] for p in odd_points.tolist()]
            flat = [i for t in token.tolist() for i in spelled[t]]
            sizes = np.bincount(unit, weights=[len(spelled[t]) for t in token.tolist()], minlength=len(units))
        else:
            flat, sizes = token, np.bincount(unit, minlength=len(units))
        self._known.update(zip(units, range(len(self._sizes), len(self._sizes) + len(units)), strict=True))
        self._flat = np.concatenate([self._flat, np.array(flat, dtype=np.int32)])
        self._sizes = np.concatenate([self._sizes, sizes.astype(np.int64)])

    def encode_batch(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts end to end, and how many each has. A null or empty text has none."""
        listed = [_UNIT.findall(SPACE + t.replace(" ", SPACE)) if t else [] for t in texts]
        distinct = dict.fromkeys(u for units in listed for u in units)
        if len(self._known) + len(distinct) > self._remembered:
            self._forget()
        fresh = [u for u in distinct if u not in self._known]
        for start in range(0, len(fresh), 50_000):
            self._learn(fresh[start : start + 50_000])
        known = self._known
        slots = np.array([known[u] for units in listed for u in units], dtype=np.int64)
        starts, lengths = np.cumsum(self._sizes) - self._sizes, self._sizes[slots]
        at = np.repeat(starts[slots] - (np.cumsum(lengths) - lengths), lengths) + np.arange(lengths.sum())
        text_of = np.repeat(np.arange(len(texts)), [len(units) for units in listed])
        return self._flat[at], np.bincount(text_of, weights=lengths, minlength=len(texts)).astype(np.int64)

    def decode(self, ids: list[int]) -> str:
        """Text of ids: pieces with spaces for their marks, bytes put together, no space in front."""
        data = b"".join([self._bytes[i] for i in ids])
        text = data.decode("utf-8", "replace")
        return text[1:] if text.startswith(" ") else text


_CODECS: dict[str, Codec] = {}  # one for each model in a worker process


def _codec(path: str) -> Codec:
    if path not in _CODECS:
        _CODECS[path] = Codec(path)
    return _CODECS[path]


def model_path(model: str | None) -> str:
    """``model``, or the place of the public model file."""
    if model is None:
        import public_tokenizers

        return public_tokenizers.path(VOCABULARY)
    return model


def encode_pieces(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", model: str | None = None
) -> DataFrame:
    """``doc_id``, ``ids`` (array), ``n_tokens`` and ``round_trip`` of every row.

    The ids are those of the model's own encoder without end marks. ``round_trip`` says whether
    decoding them gives the text again, as it does unless the text has the mark that stands for
    spaces. A null or empty text has no ids; null ids and repeated rows keep a row each; other columns
    are ignored. ``model`` is a file that all machines have.
    """
    path = model_path(model)
    source = docs.select(column(docs, id_col).alias("doc_id"), column(docs, text_col).alias("text"))
    kind = source.schema["doc_id"].dataType.simpleString()

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(path)
        for whole in batches:
            for batch in slices(whole, "text", 4 << 20):
                texts = batch.column("text").to_pylist()
                ids, sizes = codec.encode_batch(texts)
                ends = np.concatenate([[0], np.cumsum(sizes)])
                listed = ids.tolist()
                same = [
                    codec.decode(listed[a:b]) == (t or "")
                    for t, a, b in zip(texts, ends[:-1].tolist(), ends[1:].tolist(), strict=True)
                ]
                lists = pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(ids))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id"), lists, pa.array(sizes), pa.array(same, type=pa.bool_())],
                    ["doc_id", "ids", "n_tokens", "round_trip"],
                )

    return source.mapInArrow(rows, f"doc_id {kind}, ids array<int>, n_tokens long, round_trip boolean")


def decode_pieces(
    encoded: DataFrame, id_col: str = "doc_id", ids_col: str = "ids", model: str | None = None
) -> DataFrame:
    """``doc_id`` and ``text`` of every row of ids, repeated rows and rows without a ``doc_id`` included.

    A null list of ids gives a null text, an empty one an empty text; without rows there is none.
    """
    path = model_path(model)
    source = encoded.select(column(encoded, id_col).alias("doc_id"), column(encoded, ids_col).alias("ids"))
    kind = source.schema["doc_id"].dataType.simpleString()

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(path)
        for batch in batches:
            texts = [None if ids is None else codec.decode(ids) for ids in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(texts, type=pa.string())], ["doc_id", "text"])

    return source.mapInArrow(rows, f"doc_id {kind}, text string")
