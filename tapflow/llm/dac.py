"""Token ids in directly addressable codes.

An id is cut into 8-bit chunks, lowest first.  Level 0 holds the first chunk
of every id; its continuation bitmap marks the ids that go on, and level k+1
holds the next chunk of exactly those, in order.  The position of an id's
chunk at the next level is the number of marked ids before it (its rank),
which a directory of running counts every 512 bits answers with one lookup
and a popcount of at most 64 bytes.  So any token is read by touching a few
bytes per level, without decoding the block around it.

A segment is one self-contained image: magic, counts, document ids and
starts, then per level chunks, bitmap and rank directory.  Segments are rows
of a Parquet data set (column ``image``), so any store that Spark writes
holds them.  Documents lie in ascending id order (null first; ties by text
hash) and never straddle two segments.

Defined results: null text counts as empty and holds just the end id; an
empty table gives an empty data set; equal ids each keep their own entry.
"""

from __future__ import annotations

import json
import re
import struct
import zlib
from array import array
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

MAGIC = b"DACTOK01"
RANK_BITS = 512
SEGMENT_TOKENS = 1 << 20
_POPCOUNT = np.array([bin(i).count("1") for i in range(256)], np.uint8)

# ---------------------------------------------------------------- segments


def _level_bytes(values: np.ndarray) -> list[bytes]:
    """chunks, bitmap and rank directory of each level."""
    out = []
    values = values.astype(np.uint32, copy=False)
    while True:
        more = values > 255
        bitmap = np.packbits(more, bitorder="little")
        pad = (-len(bitmap)) % (RANK_BITS // 8)
        counts = _POPCOUNT[np.concatenate([bitmap, np.zeros(pad, np.uint8)])].reshape(-1, RANK_BITS // 8)
        ranks = np.concatenate([[0], np.cumsum(counts.sum(1, dtype=np.uint64))]).astype(np.uint64)
        chunk = (values & 255).astype(np.uint8)
        out += [chunk.tobytes(), bitmap.tobytes(), ranks.tobytes()]
        if not more.any():
            return out
        values = values[more] >> 8


def write_segment(ids: np.ndarray, doc_ids: list[int | None], starts: list[int]) -> bytes:
    """The image of one segment; ``starts`` are local token positions."""
    levels = _level_bytes(ids)
    head = [np.array([i or 0 for i in doc_ids], np.int64).tobytes(),
            np.packbits(np.array([i is None for i in doc_ids], bool), bitorder="little").tobytes(),
            np.array([*starts, len(ids)], np.uint64).tobytes()]
    parts = head + levels
    return MAGIC + struct.pack("<QII", len(ids), len(doc_ids), len(levels) // 3) + \
        struct.pack(f"<{len(parts)}Q", *map(len, parts)) + b"".join(parts)


class Segment:
    """Reads an image in place; nothing is decoded up front."""

    def __init__(self, image: bytes):
        view = memoryview(image)
        if bytes(view[:8]) != MAGIC:
            raise ValueError("not a token segment")
        self.n_tokens, self.n_docs, n_levels = struct.unpack_from("<QII", view, 8)
        n = 3 + 3 * n_levels
        sizes = struct.unpack_from(f"<{n}Q", view, 24)
        at, parts = 24 + 8 * n, []
        for s in sizes:
            parts.append(view[at:at + s])
            at += s
        null = np.unpackbits(np.frombuffer(parts[1], np.uint8), bitorder="little")[:self.n_docs]
        self.doc_ids = [None if z else int(i) for i, z in zip(np.frombuffer(parts[0], np.int64), null)]
        self.starts = np.frombuffer(parts[2], np.uint64).astype(np.int64)
        self.levels = [(np.frombuffer(parts[k], np.uint8), np.frombuffer(parts[k + 1], np.uint8),
                        np.frombuffer(parts[k + 2], np.uint64)) for k in range(3, n, 3)]

    def token(self, i: int) -> int:
        """The id at position ``i``: one chunk and one rank per level."""
        value, shift = 0, 0
        for chunks, bitmap, ranks in self.levels:
            value |= int(chunks[i]) << shift
            if not bitmap[i >> 3] >> (i & 7) & 1:
                break
            block = i // RANK_BITS
            first = block * (RANK_BITS // 8)
            rank = int(ranks[block]) + int(_POPCOUNT[bitmap[first:i >> 3]].sum())
            i = rank + bin(int(bitmap[i >> 3]) & ((1 << (i & 7)) - 1)).count("1")
            shift += 8
        return value

    def slice(self, a: int, b: int) -> np.ndarray:
        """The ids at positions a..b-1: a run of each level, no more."""
        out = np.zeros(b - a, np.uint32)
        at, shift = None, 0                 # the first level holds all ids
        for chunks, bitmap, ranks in self.levels:
            if a >= b:
                break
            more = np.flatnonzero(np.unpackbits(bitmap[a >> 3:(b + 7) >> 3], bitorder="little")[a & 7:(a & 7) + b - a])
            if at is None:
                out[:], at = chunks[a:b], more
            else:
                out[at] |= chunks[a:b].astype(np.uint32) << np.uint32(shift)
                at = at[more]
            block = a // RANK_BITS
            first = block * (RANK_BITS // 8)
            start = int(ranks[block]) + int(_POPCOUNT[bitmap[first:a >> 3]].sum()) + \
                (bin(int(bitmap[a >> 3]) & ((1 << (a & 7)) - 1)).count("1") if a & 7 else 0)
            a, b = start, start + len(at)
            shift += 8
        return out


# ---------------------------------------------------------------- encoding

# The tokenizer's own split of a text into pieces, and the characters for
# which Python's classes agree with it; other texts are encoded whole.
_PIECES = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?[^\W\d_]+| ?\d+| ?(?:[^\s\w]|_)+|\s+(?!\S)|\s+")
_UNSURE = re.compile("[^\x00-\x1b\x20-\x84\x86-\xb1\xb4-\xb8\xba\xbb\xbf-ɏΑ-Ρα-ω"
                     "А-я‐-‧‰-⁞一-龥가-힣]|<\\|")
_PIECE_LIMIT = 300_000
_WORD_LIMIT, _WORD_CHARS = 600_000, 48
_MARKS = pa.array(list(".,;:!?"))           # one behind a letter, with nothing after it, is a piece of its own
#: A line end with white space around it, or none of the part on one side.
_KNOTTY = r"[\t\n\v\f\r]\n|\n[\t\n\v\f\r]|^\n|\n$"
#: Text encoded at a time: each distinct word of it costs one look-up.
CHUNK_BYTES = 12 << 20


class WordCodes(dict):
    """A word -> the ids of ``before`` (a space or a line end) and the word.

    The tokenizer always begins a piece at a space that no white space comes
    before, and cuts before and after a line end between two other characters,
    so what lies between is encoded by itself.  None stands for a word for
    which that is not known: it is empty, begins (behind a line end) or ends
    in white space or holds a character that ``_UNSURE`` finds."""

    def __init__(self, pieces: "PieceEncoder", before: str):
        self.pieces, self.before = pieces, before

    def of(self, words: list[str]) -> list[bytes | None]:
        """The codes of a chunk's words.  Memory is bounded: of too many known
        words only those of the chunk stay known."""
        codes = list(map(self.__getitem__, words))
        if len(self) > _WORD_LIMIT:
            self.clear()
            self.update((w, c) for w, c in islice(zip(words, codes), _WORD_LIMIT) if len(w) <= _WORD_CHARS)
        return codes

    def __missing__(self, word: str) -> bytes | None:
        ids = self._codes(word)
        if len(word) <= _WORD_CHARS:        # texts without spaces are not remembered
            self[word] = ids
        return ids

    def _codes(self, word: str) -> bytes | None:
        if not self.alone(word):
            return None
        if self.before == " ":
            return (self.pieces.tokenized if word.isalpha() else self.pieces.joined)(" " + word)
        return None if word[0].isspace() else self.pieces["\n"] + self.pieces.joined(word)

    @staticmethod
    def alone(word: str) -> bool:
        if word.isascii() and word.isalpha():
            return True
        return word != "" and not word[-1].isspace() and not _UNSURE.search(word)


class PieceEncoder(dict):
    """Encodes texts with a ``tokenizers`` file; each distinct piece of a
    byte-level vocabulary, and each distinct word with what is attached to it,
    is encoded once per worker and remembered."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        spec = json.loads(self.tokenizer.to_str())
        pre = spec.get("pre_tokenizer") or {}
        self.by_piece = (spec.get("normalizer") is None and pre.get("type") == "ByteLevel"
                         and not pre.get("add_prefix_space") and pre.get("use_regex", True))
        self.dtype = np.dtype("<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4")
        self.model = self.tokenizer.model
        plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
        other = [b for b in range(256) if b not in plain]
        self.byte_chars = {b: b for b in plain} | {b: 256 + k for k, b in enumerate(other)}
        self.space = chr(self.byte_chars[32])
        self.code = self.dtype.char
        self.words, self.lines = WordCodes(self, " "), WordCodes(self, "\n")

    def __missing__(self, piece: str) -> bytes:
        if piece[0] == " " and len(piece) <= _WORD_CHARS and piece[1:].isalpha():
            return self.words[piece[1:]]    # kept there
        ids = self[piece] = self.tokenized(piece)
        return ids

    def tokenized(self, piece: str) -> bytes:
        if piece.isascii() and piece.isprintable():
            symbols = piece.replace(" ", self.space)
        else:
            symbols = piece.encode().decode("latin-1").translate(self.byte_chars)
        return array(self.code, [t.id for t in self.model.tokenize(symbols)]).tobytes()

    def joined(self, text: str) -> bytes:
        """The ids of a text without unsure characters, piece by piece."""
        return b"".join(map(self.__getitem__, _PIECES.findall(text)))

    def whole(self, text: str) -> bytes:
        """The ids of a text that is not cut at its spaces."""
        if self.by_piece and not _UNSURE.search(text):
            return self.joined(text)
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, self.dtype).tobytes()

    def encode(self, text: str) -> np.ndarray:
        codes = ChunkCodes(self, pa.array([text], pa.string()))
        return codes.ids(0, 1)


def _strings(column: pa.Array) -> list[str]:
    return column.to_numpy(zero_copy_only=False).tolist()


class Codes:
    """Ids of numbered words, laid out entry by entry."""

    def __init__(self, codes: list[bytes], dtype: np.dtype):
        self.flat = np.frombuffer(b"".join(codes), dtype)
        self.size = np.fromiter(map(len, codes), np.int64, len(codes)) // dtype.itemsize
        self.begin = np.cumsum(self.size) - self.size

    def laid_out(self, entry: np.ndarray, size: np.ndarray) -> np.ndarray:
        """The first ``size`` ids of each entry, one after the other."""
        ends = np.cumsum(size)
        shift = self.begin[entry] - (ends - size)
        at = np.repeat(shift, size)
        at += np.arange(len(at))
        return self.flat[at]


class PartCodes:
    """The ids of distinct parts of texts (what lies between two spaces), each
    with the space before it; ``unknown`` marks parts whose ids also depend on
    what lies around them.

    Lines and a mark at their end are taken off, so that as few different
    words as possible are looked up."""

    def __init__(self, enc: PieceEncoder, parts: pa.Array):
        knotty = pc.match_substring_regex(parts, _KNOTTY)
        plain = pc.split_pattern(parts.filter(pc.invert(knotty)), "\n")
        lines = pa.concat_arrays([plain.flatten(), parts.filter(knotty)])
        lengths = np.ones(len(parts), np.int64)
        lengths[:len(plain)] = pc.list_value_length(plain).to_numpy(zero_copy_only=False)
        knotty = knotty.to_numpy(zero_copy_only=False)
        self.number = np.empty(len(parts), np.int32)        # of a part, among those laid out here
        self.number[np.append(np.flatnonzero(~knotty), np.flatnonzero(knotty))] = np.arange(len(parts))

        marked = pc.and_(pc.is_in(pc.utf8_slice_codeunits(lines, -1), _MARKS),
                         pc.utf8_is_alpha(pc.utf8_slice_codeunits(lines, -2, -1)))
        marks = pc.utf8_slice_codeunits(lines.filter(marked), -1).dictionary_encode()
        marked_at = np.flatnonzero(marked.to_numpy(zero_copy_only=False))
        words = pc.if_else(marked, pc.utf8_slice_codeunits(lines, 0, -1), lines)
        at = np.cumsum(lengths) - lengths
        first = np.zeros(len(lines), bool)
        first[at] = True
        firsts, others = (words.filter(pa.array(x)).dictionary_encode() for x in (first, ~first))
        codes = enc.words.of(_strings(firsts.dictionary)) + enc.lines.of(_strings(others.dictionary))
        unknown = np.array([c is None for c in codes], bool)
        n = len(codes)
        codes = [c or b"" for c in codes] + [b""] + [enc[m] for m in _strings(marks.dictionary)]
        # two entries a line: the word, and its mark or nothing
        entry = np.full((len(lines), 2), n, np.int32)
        entry[first, 0] = firsts.indices.to_numpy()
        entry[~first, 0] = others.indices.to_numpy() + np.int32(len(firsts.dictionary))
        entry[marked_at, 1] = marks.indices.to_numpy() + np.int32(n + 1)
        self.unknown = np.logical_or.reduceat(unknown[entry[:, 0]], at) if len(at) else np.zeros(0, bool)
        of, entry = Codes(codes, enc.dtype), entry.ravel()
        size = of.size[entry]
        self.flat = of.laid_out(entry, size)
        self.size = np.add.reduceat(size, 2 * at) if len(at) else np.zeros(0, np.int64)


class ChunkCodes(Codes):
    """The ids of all texts of an array; null counts as empty.

    A text is a run of entries: its first part, then what follows each space,
    then ``tail``.  Arrow cuts the texts and numbers the distinct parts, and
    numpy lays out the ids of a run of texts."""

    def __init__(self, enc: PieceEncoder, texts: pa.Array, tail: bytes = b""):
        if len(enc) > _PIECE_LIMIT:
            enc.clear()
        n, texts = len(texts), texts.fill_null("")
        if enc.by_piece:
            cut = pc.split_pattern(texts, " ")
            parts, lengths = cut.flatten(), pc.list_value_length(cut).to_numpy(zero_copy_only=False)
        else:
            parts, lengths = texts, np.ones(n, np.int64)
        ends = np.cumsum(lengths, dtype=np.int64)
        first = ends - lengths
        later = np.ones(len(parts), bool)
        later[first] = False
        heads = _strings(parts.take(pa.array(first)))
        numbered = parts.filter(pa.array(later)).dictionary_encode()
        cut = parts = None                  # as large as the texts
        pa.default_memory_pool().release_unused()
        known = PartCodes(enc, numbered.dictionary)
        n_parts = len(known.size)

        entry = np.empty(len(later), np.int32)
        entry[later] = known.number[numbered.indices.to_numpy()]
        entry[first] = np.arange(n_parts, n_parts + n)
        self.entry = np.insert(entry, ends, n_parts + n)
        self.at = np.append(first, len(later)) + np.arange(n + 1)
        cuts = np.fromiter(map(WordCodes.alone, heads), bool, n) & enc.by_piece
        if known.unknown.any():
            unknown = np.append(known.unknown, np.zeros(n + 1, bool))[self.entry]
            cuts[np.searchsorted(self.at, np.flatnonzero(unknown), "right") - 1] = False
        super().__init__([enc.joined(head) if ok else enc.whole(texts[k].as_py())
                          for k, (head, ok) in enumerate(zip(heads, cuts.tolist()))] + [tail], enc.dtype)
        self.flat = np.concatenate([known.flat, self.flat])
        self.begin = np.concatenate([np.cumsum(known.size) - known.size, self.begin + len(known.flat)])
        self.sizes = np.concatenate([known.size, self.size])[self.entry]
        for k in np.flatnonzero(~cuts).tolist():
            self.sizes[self.at[k] + 1:self.at[k + 1] - 1] = 0   # the whole text stands at its first part
        self.counts = np.add.reduceat(self.sizes, self.at[:-1]) if n else np.zeros(0, np.int64)

    def ids(self, a: int, b: int) -> np.ndarray:
        """The ids of the texts a..b-1."""
        run = slice(self.at[a], self.at[b])
        return self.laid_out(self.entry[run], self.sizes[run])


_ENCODERS: dict[str, PieceEncoder] = {}


def encoder(path: str) -> PieceEncoder:
    if path not in _ENCODERS:
        _ENCODERS[path] = PieceEncoder(path)
    return _ENCODERS[path]


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list[int | None], pa.Array]]:
    """Ids and texts of successive batches, together ``CHUNK_BYTES`` at most
    unless one batch alone is larger."""
    held, size = [], 0
    for b in batches:
        if held and size + b.nbytes > CHUNK_BYTES:
            chunk, held, size = _together(held), [], 0
            yield chunk
        held.append(b)
        size += b.nbytes
    if held:
        yield _together(held)


def _together(batches: list[pa.RecordBatch]) -> tuple[list[int | None], pa.Array]:
    return ([i for b in batches for i in b.column("id").to_pylist()],
            pa.concat_arrays([b.column("text") for b in batches]))


def _segments(tokenizer_file: str, end_id: int, segment_tokens: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        enc = encoder(_resolve(tokenizer_file))
        end = np.array([end_id], enc.dtype).tobytes()
        shard, seq, base = TaskContext.get().partitionId(), 0, 0
        ids, doc_ids, starts, held = [], [], [], 0

        def flush():
            nonlocal ids, doc_ids, starts, held, seq, base
            image = write_segment(np.concatenate(ids), doc_ids, starts)
            row = pa.RecordBatch.from_pydict({
                "shard": pa.array([shard], pa.int32()), "seq": pa.array([seq], pa.int32()),
                "base": pa.array([base], pa.int64()), "n_tokens": pa.array([held], pa.int64()),
                "n_docs": pa.array([len(doc_ids)], pa.int64()), "image": pa.array([image], pa.binary())})
            seq, base = seq + 1, base + held
            ids, doc_ids, starts, held = [], [], [], 0
            return row

        for chunk_ids, texts in _chunks(batches):
            codes, done = ChunkCodes(enc, texts, end), 0
            for k, (doc_id, n) in enumerate(zip(chunk_ids, codes.counts.tolist())):
                if doc_ids and held + n > segment_tokens:
                    ids.append(codes.ids(done, k))
                    done = k
                    yield flush()
                doc_ids.append(doc_id)
                starts.append(held)
                held += n
            ids.append(codes.ids(done, len(chunk_ids)))
        if doc_ids:
            yield flush()
    return run


def _resolve(name: str) -> str:
    """A path, or the name of a file of the installed public vocabularies."""
    if "/" in name:
        return name
    import public_tokenizers
    return public_tokenizers.path(name)


SEGMENT_SCHEMA = "shard int, seq int, base long, n_tokens long, n_docs long, image binary"


def write_tokens(docs: DataFrame, path: str, tokenizer_file: str, end_id: int, id_col: str = "doc_id",
                 text_col: str = "text", segment_tokens: int = SEGMENT_TOKENS) -> None:
    """Encode every text and write the segments to the folder ``path``.

    One shuffle moves the texts into ascending id ranges; encoding and packing
    follow in the same stage, a segment at a time."""
    spark = docs.sparkSession
    shards = int(spark.conf.get("spark.sql.shuffle.partitions"))
    (docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"),
                 F.xxhash64(text_col).alias("tie"))
         .repartitionByRange(shards, "id", "tie").sortWithinPartitions("id", "tie")
         .select("id", "text")
         .mapInArrow(_segments(tokenizer_file, end_id, segment_tokens), SEGMENT_SCHEMA)
         .write.mode("overwrite").parquet(path))


def _entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for row in b.to_pylist():
            s = Segment(row["image"])
            # all of a segment's documents are wanted: one run over its levels
            ids, ends = memoryview(s.slice(0, s.n_tokens).astype("<u4").tobytes()), (4 * s.starts).tolist()
            crc = [zlib.crc32(ids[a:z]) for a, z in zip(ends, ends[1:])]
            yield pa.RecordBatch.from_pydict({
                "doc_id": pa.array(s.doc_ids, pa.int64()),
                "start": pa.array(s.starts[:-1] + row["first"], pa.int64()),
                "n_tokens": pa.array(np.diff(s.starts), pa.int64()),
                "ids_crc32": pa.array(crc, pa.int64())})


def segment_index(spark: SparkSession, path: str) -> DataFrame:
    """(shard, first): tokens before each shard, from the shards' totals.
    One row per shard; the images are not read."""
    from pyspark.sql import Window
    totals = spark.read.parquet(path).groupBy("shard").agg(F.sum("n_tokens").alias("t"))
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    return totals.select("shard", F.coalesce(F.sum("t").over(before), F.lit(0)).alias("first"))


def read_entries(spark: SparkSession, path: str) -> DataFrame:
    """One row per document, from the files: doc_id, start, n_tokens,
    ids_crc32."""
    firsts = {r["shard"]: r["first"] for r in segment_index(spark, path).collect()}  # a row per shard
    first = F.lit(0).cast("long")
    segments = spark.read.parquet(path)
    if firsts:
        rows = spark.createDataFrame(list(firsts.items()), "shard int, shift long")
        segments = segments.join(F.broadcast(rows), "shard")    # one row per written shard
        first = F.col("shift")
    return (segments.select((first + F.col("base")).alias("first"), "image")
            .mapInArrow(_entries, "doc_id long, start long, n_tokens long, ids_crc32 long"))
