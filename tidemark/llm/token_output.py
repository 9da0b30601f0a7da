"""Token ids in files: one id array per chunk, with Elias-Fano coded document boundaries.

A chunk is one row of a Parquet file, the container that Spark can write to and read from any store:

* ``part``, ``chunk``: its place; chunks in this order hold the documents in ascending id order
* ``first``: number of ids in earlier chunks of the part
* ``n_docs``, ``n_tokens``
* ``ids``: little-endian 16-bit ids (32-bit for larger vocabularies) of all documents, end to end
* ``low_bits``, ``low``, ``high``, ``samples``: the boundaries, see ``EliasFano``
* ``doc_ids``: one per document
"""

from __future__ import annotations

import json
import os
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.common import batch_words, column, slices, with_row_ids
from tidemark.session import shared_folder

VOCABULARY = "word_bpe_49k.json"
END_ID = 1
CHUNK_TOKENS = 1 << 20
_EVERY = 256  # a sampled position for so many boundaries


@dataclass(frozen=True)
class EliasFano:
    """A rising sequence in about 2 + log2(universe / n) bits per value.

    ``low`` packs the low ``low_bits`` bits of each value. ``high`` is a bit vector in which the i-th
    one stands at (value >> low_bits) + i. ``samples`` holds where every 256th one stands, so
    ``select`` looks at a short stretch of it.
    """

    n: int
    low_bits: int
    low: bytes
    high: bytes
    samples: bytes

    @classmethod
    def encode(cls, values: np.ndarray) -> EliasFano:
        n = len(values)
        if not n:
            return cls(0, 0, b"", b"", b"")
        values = values.astype(np.uint64)
        low_bits = max(0, int(values[-1] // np.uint64(n)).bit_length() - 1)
        shifts = np.arange(low_bits, dtype=np.uint64)
        low = np.packbits(((values[:, None] >> shifts) & np.uint64(1)).astype(np.uint8), bitorder="little")
        ones = (values >> np.uint64(low_bits)).astype(np.int64) + np.arange(n)
        high = np.zeros(int(ones[-1]) + 1, dtype=np.uint8)
        high[ones] = 1
        samples = ones[::_EVERY].astype("<u4").tobytes()
        return cls(n, low_bits, low.tobytes(), np.packbits(high, bitorder="little").tobytes(), samples)

    def select(self, i: int) -> int:
        """The i-th value."""
        high = np.frombuffer(self.high, dtype=np.uint8)
        at = int(np.frombuffer(self.samples, dtype="<u4")[i // _EVERY])
        left, byte = i % _EVERY, at // 8
        ones = np.flatnonzero(np.unpackbits(high[byte : byte + 1], bitorder="little")) + byte * 8
        ones = ones[ones >= at]
        while left >= len(ones):  # whole bytes with fewer ones than are left
            left -= len(ones)
            byte += 1
            ones = np.flatnonzero(np.unpackbits(high[byte : byte + 1], bitorder="little")) + byte * 8
        upper = int(ones[left]) - i
        low = 0
        for k in range(self.low_bits):
            bit = i * self.low_bits + k
            low |= (self.low[bit // 8] >> bit % 8 & 1) << k
        return upper << self.low_bits | low

    def decode(self) -> np.ndarray:
        """All values."""
        if not self.n:
            return np.zeros(0, dtype=np.int64)
        bits = np.unpackbits(np.frombuffer(self.high, dtype=np.uint8), bitorder="little")
        upper = np.flatnonzero(bits)[: self.n] - np.arange(self.n)
        if not self.low_bits:
            return upper
        bits = np.unpackbits(np.frombuffer(self.low, dtype=np.uint8), bitorder="little")
        bits = bits[: self.n * self.low_bits].reshape(self.n, self.low_bits).astype(np.int64)
        return upper << self.low_bits | (bits << np.arange(self.low_bits)).sum(axis=1)


# Letters that the normaliser of this vocabulary maps one to one, and marks that it splits off as one
# piece: the ids of such a word are those of its letters, then those of its marks.
_PLAIN = "^[A-Za-zÀ-ÖØ-öø-ÿ]+[.,;:!?]*$"
_MARKS = ".,;:!?"


def _goes_by_words(settings: dict) -> bool:
    """Whether a tokenizer lower-cases, takes white space as a mere gap between words, and marks their ends."""

    def kinds(part: dict | None) -> list[str]:
        parts = (part or {}).get("normalizers") or (part or {}).get("pretokenizers") or [part or {}]
        return [p.get("type", "") for p in parts]

    normal, split = settings.get("normalizer"), settings.get("pre_tokenizer")
    return (
        kinds(normal) == ["NFC", "Replace", "Lowercase"]
        and kinds(split) == ["Split", "ByteLevel"]
        and split["pretokenizers"][0].get("invert") is True
        and split["pretokenizers"][1].get("add_prefix_space") is False
        and settings["model"].get("end_of_word_suffix") == "</w>"
    )


class Encoder:
    """Ids of whole texts by the tokenizers library, which sees each distinct word of a batch once.

    No token of the default vocabulary spans ASCII white space, which its normaliser and splitter drop, so the
    ids of a text are those of its words end to end. Words seen before are remembered up to a bound; beyond it those
    stay that several batches had. Vocabularies that treat white space or letters otherwise get whole texts.
    """

    def __init__(self, path: str, remembered: int = 400_000) -> None:
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # one task, one core
        self._tokenizer = Tokenizer.from_file(path)
        self._ends = np.zeros(self._tokenizer.get_vocab_size(), dtype=bool)
        for token, i in self._tokenizer.get_vocab().items():
            self._ends[i] = token.endswith("</w>")
        self._by_words = _goes_by_words(json.loads(self._tokenizer.to_str()))
        self._remembered = remembered
        self._known: dict[str, int] = {}
        self._flat, self._sizes = np.zeros(0, dtype=np.uint32), np.zeros(0, dtype=np.int64)
        self._hits = np.zeros(0, dtype=np.int32)  # batches that had a piece

    def _forget(self) -> None:
        """Keep what several batches had, the most frequent up to half of the bound."""
        often = np.flatnonzero(self._hits > 1)
        often = np.sort(often[np.argsort(-self._hits[often], kind="stable")][: self._remembered // 2])
        names = list(self._known)  # in the order of their places
        self._known = {names[i]: place for place, i in enumerate(often.tolist())}
        starts, lengths = np.cumsum(self._sizes) - self._sizes, self._sizes[often]
        at = np.repeat(starts[often] - (np.cumsum(lengths) - lengths), lengths) + np.arange(lengths.sum())
        self._flat, self._sizes = self._flat[at], lengths
        self._hits = np.ones(len(often), dtype=np.int32)

    def _keep(self, pieces: list[str], flats: list, sizes: list) -> None:
        self._known.update(zip(pieces, range(len(self._sizes), len(self._sizes) + len(pieces)), strict=True))
        self._flat = np.concatenate([self._flat, *[np.asarray(f, dtype=np.uint32) for f in flats]])
        self._sizes = np.concatenate([self._sizes, *[np.asarray(s, dtype=np.int64) for s in sizes]])
        self._hits = np.concatenate([self._hits, np.zeros(len(pieces), dtype=np.int32)])

    def _learn(self, pieces: list[str], words: bool) -> None:
        """Remember the ids of new ``pieces``. If they are ``words`` of letters, each ends in a token
        that marks a word's end, so many are encoded as one text and told apart by those tokens."""
        fresh = [p for p in pieces if p not in self._known]
        flats, sizes = [], []
        for start in range(0, len(fresh), 2000):
            part = fresh[start : start + 2000]
            if words:
                flat = self._tokenizer.encode_batch_fast([" ".join(part)], add_special_tokens=False)[0].ids
                flat = np.array(flat, dtype=np.uint32)
                ends = np.flatnonzero(self._ends[flat])
                if len(ends) == len(part):
                    flats.append(flat)
                    sizes.append(np.diff(ends, prepend=-1))
                    continue
            found = [e.ids for e in self._tokenizer.encode_batch_fast(part, add_special_tokens=False)]
            flats += found
            sizes.append([len(ids) for ids in found])
        self._keep(fresh, flats, sizes)

    def _whole(self, texts: pa.Array, end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """The library's ids of whole texts."""
        found = [
            e.ids for e in self._tokenizer.encode_batch_fast([t or "" for t in texts.to_pylist()], add_special_tokens=False)
        ]
        ids = np.array([i for own in found for i in (*own, end_id)], dtype=np.uint32)
        return ids, np.array([len(own) + 1 for own in found], dtype=np.int64)

    def __call__(self, texts: pa.Array, end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """All ids of ``texts``, each ended by ``end_id``, and the number of ids of each."""
        if not self._by_words:
            return self._whole(texts, end_id)
        n_words, codes, distinct = batch_words(texts)
        if len(self._known) + len(distinct) > self._remembered:
            self._forget()
        low = pc.utf8_lower(distinct)
        stems = pc.utf8_rtrim(low, _MARKS)
        plain = pc.match_substring_regex(distinct, _PLAIN)
        stems = pc.if_else(plain, stems, distinct)
        n_marks = pc.subtract(pc.binary_length(low), pc.binary_length(stems)).to_numpy(zero_copy_only=False)
        marked = np.flatnonzero(plain.to_numpy(zero_copy_only=False) & (n_marks > 0))
        ended = distinct.take(pa.array(marked)).to_numpy(zero_copy_only=False).tolist()
        marks = [word[-n:] for word, n in zip(ended, n_marks[marked].tolist(), strict=True)]
        of = stems.dictionary_encode()
        names = of.dictionary.to_numpy(zero_copy_only=False).tolist()
        simple = pc.match_substring_regex(of.dictionary, _PLAIN).to_numpy(zero_copy_only=False)
        place = np.array([self._known.get(n, -1) for n in names], dtype=np.int64)
        fresh = place < 0
        for words in (True, False):
            self._learn([names[i] for i in np.flatnonzero(fresh & (simple == words)).tolist()], words)
        self._learn(list(dict.fromkeys(marks)), words=False)
        place[fresh] = [self._known[names[i]] for i in np.flatnonzero(fresh).tolist()]

        # each distinct word is a stem and maybe marks; their ids are put together once, with the end id as a last word
        stem = place[of.indices.to_numpy(zero_copy_only=False)]
        mark = np.array([self._known[m] for m in marks], dtype=np.int64)
        hit = np.zeros(len(self._sizes), dtype=bool)
        hit[stem] = hit[mark] = True
        self._hits += hit
        slots = np.insert(stem, marked + 1, mark)
        starts = np.cumsum(self._sizes) - self._sizes
        flat = np.append(self._flat[_places(starts[slots], self._sizes[slots])], np.uint32(end_id))
        sizes = self._sizes[stem]
        sizes[marked] += self._sizes[mark]
        sizes = np.append(sizes, 1)
        starts = np.cumsum(sizes) - sizes

        words = np.insert(codes, np.cumsum(n_words), len(distinct))  # the end id ends each text
        lengths = sizes[words]
        upto = np.concatenate([[0], np.cumsum(lengths)])[np.concatenate([[0], np.cumsum(n_words + 1)])]
        return flat[_places(starts[words], lengths)], np.diff(upto)


def _places(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """``length`` places from each start on, end to end."""
    total = int(lengths.sum())
    kind = np.int32 if total < 1 << 31 and (not len(starts) or int(starts.max()) < 1 << 31) else np.int64
    shift = (starts - (np.cumsum(lengths) - lengths)).astype(kind)
    return np.repeat(shift, lengths) + np.arange(total, dtype=kind)


_ENCODERS: dict[str, Encoder] = {}  # one for each vocabulary in a worker process


_FILE = (
    "part int, chunk int, first long, n_docs long, n_tokens long, ids binary, low_bits int, low binary, "
    "high binary, samples binary, doc_ids array<{kind}>"
)


def write_ids(
    docs: DataFrame,
    path: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    tokenizer: str | None = None,
    end_id: int = END_ID,
    chunk_tokens: int = CHUNK_TOKENS,
) -> None:
    """Write the ids of every text, in ascending order of its id, as chunks below ``path``.

    Rows are sorted by id (nulls first; rows with one id in the order they were read) into ranges, and
    each task writes its range as chunks of about ``chunk_tokens`` ids, one longer text at least. A
    null text is empty and brings only the end id. ``tokenizer`` is the vocabulary file, the same on
    all machines; by default the public one of ``VOCABULARY``.
    """
    if tokenizer is None:
        import public_tokenizers

        tokenizer = public_tokenizers.path(VOCABULARY)
    source = docs.select(column(docs, id_col).alias("doc_id"), column(docs, text_col).alias("text"))
    kind = source.schema["doc_id"].dataType.simpleString()
    ranged = with_row_ids(source).repartitionByRange("doc_id", "rid").sortWithinPartitions("doc_id", "rid")
    schema = _FILE.format(kind=kind)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, part = _ENCODERS.get(tokenizer), TaskContext.get().partitionId()
        if encode is None:
            encode = _ENCODERS[tokenizer] = Encoder(tokenizer)
        held: list[tuple] = []
        size, chunk, first = 0, 0, 0

        def out() -> pa.RecordBatch:
            ids, sizes = np.concatenate([h[1] for h in held]), np.concatenate([h[2] for h in held])
            ef = EliasFano.encode(np.cumsum(sizes))
            wide = len(ids) and ids.max() > 0xFFFF
            doc_ids = pa.concat_arrays([h[0] for h in held])
            values = [part, chunk, first, len(sizes), len(ids), ids.astype("<u4" if wide else "<u2").tobytes()]
            values += [ef.low_bits, ef.low, ef.high, ef.samples]
            kinds = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int32()] + [pa.binary()] * 3
            columns = [pa.array([v], type=k) for v, k in zip(values, kinds, strict=True)]
            columns.append(pa.ListArray.from_arrays(pa.array([0, len(doc_ids)], type=pa.int32()), doc_ids))
            return pa.RecordBatch.from_arrays(columns, [x.split()[0] for x in schema.split(", ")])

        for whole in batches:
            for batch in slices(whole, "text", 4 << 20):
                ids, sizes = encode(batch.column("text"), end_id)
                held.append((batch.column("doc_id"), ids, sizes))
                size += len(ids)
                if size >= chunk_tokens:
                    yield out()
                    held, size, chunk, first = [], 0, chunk + 1, first + size
        if held:
            yield out()

    ranged.drop("rid").mapInArrow(rows, schema).write.parquet(path)


def read_ids(spark: SparkSession, path: str) -> DataFrame:
    """Every document of the files: ``doc_id``, ``start``, ``n_tokens``, ``ids_crc32``.

    ``start`` counts the ids of all documents before it. Only the token counts of the parts, a number
    for each task that wrote, are summed up to get the start of each part.
    """
    chunks = spark.read.parquet(path)
    kind = chunks.schema["doc_ids"].dataType.elementType.simpleString()
    parts = chunks.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    upto = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    before = parts.select("part", F.coalesce(F.sum("n").over(upto), F.lit(0)).alias("base"))

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = {n: batch.column(n)[i].as_py() for n in ("n_docs", "n_tokens", "base", "first", "ids")}
                row |= {n: batch.column(n)[i].as_py() for n in ("low_bits", "low", "high", "samples")}
                ends = EliasFano(
                    row["n_docs"], row["low_bits"], row["low"], row["high"], row["samples"]
                ).decode()
                starts = np.concatenate([[0], ends[:-1]]).astype(np.int64)
                width = len(row["ids"]) // max(row["n_tokens"], 1)
                ids = memoryview(np.frombuffer(row["ids"], dtype=f"<u{width}").astype("<u4")).cast("B")
                sums = [zlib.crc32(ids[4 * a : 4 * b]) for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_ids")[i].values,
                        pa.array(starts + row["base"] + row["first"]),
                        pa.array(ends - starts),
                        pa.array(sums, type=pa.int64()),
                    ],
                    ["doc_id", "start", "n_tokens", "ids_crc32"],
                )

    # two numbers for each task that wrote, so always small
    return chunks.join(F.broadcast(before), "part").mapInArrow(
        rows, f"doc_id {kind}, start long, n_tokens long, ids_crc32 long"
    )


def read_documents(spark: SparkSession, path: str, ids: list) -> DataFrame:
    """``doc_id`` and ``tokens`` (array of ids, the end id included) of the documents with one of ``ids``, a short list.

    Only chunks that hold any of them are looked into, and there two boundaries a document are selected.
    """
    chunks = spark.read.parquet(path)
    kind = chunks.schema["doc_ids"].dataType.elementType.simpleString()
    asked = F.array(*[F.lit(i).cast(kind) for i in ids]) if ids else F.array().cast(f"array<{kind}>")
    wanted = set(ids)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = {n: batch.column(n)[i].as_py() for n in ("n_docs", "n_tokens", "low_bits", "low", "high", "samples")}
                n_tokens = row.pop("n_tokens")
                ends = EliasFano(row.pop("n_docs"), **row)
                data = batch.column("ids")[i].as_py()
                all_ids = np.frombuffer(data, dtype=f"<u{len(data) // max(n_tokens, 1)}")
                held = batch.column("doc_ids")[i].values
                at = [k for k, number in enumerate(held.to_pylist()) if number in wanted]
                tokens = [all_ids[ends.select(k - 1) if k else 0 : ends.select(k)].tolist() for k in at]
                columns = [held.take(pa.array(at, type=pa.int64())), pa.array(tokens, type=pa.list_(pa.int64()))]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "tokens"])

    return chunks.where(F.arrays_overlap("doc_ids", asked)).mapInArrow(rows, f"doc_id {kind}, tokens array<long>")


def round_trip(docs: DataFrame, **options: object) -> DataFrame:
    """Write ``docs`` by ``write_ids`` below the shared folder and read the files back."""
    path = shared_folder(docs.sparkSession, "token-ids")
    write_ids(docs, path, **options)
    return read_ids(docs.sparkSession, path)
