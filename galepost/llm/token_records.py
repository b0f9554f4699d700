"""Binary output of token ids: length-delimited records with masked checksums, and an index.

A record is the payload's length (8 bytes, little-endian), the masked CRC-32 of those 8
bytes, the payload, and the masked CRC-32 of the payload. The payload is the ids as
little-endian unsigned integers, of 16 bits where the vocabulary allows it, else of 32. The
index is a Parquet table beside the shards with the place of every record and the width of
its ids, so single sequences can be read in any order.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from galepost.session import shared_folder

from .common import batch_of, map_batches, rows_of, text_key
from .running import carried

END_ID = 2
# Distinct words that the library gets as one text, characters whose words are pooled, and the
# size of the words whose ids a worker keeps for the next pool.
WORDS_AT_ONCE = 256
CHARS_AT_ONCE = 1_500_000
KNOWN_BYTES = 4_000_000
_HEAD = struct.Struct("<QI")
_TAIL = struct.Struct("<I")


def masked(data: bytes) -> int:
    """CRC-32, rotated and shifted, as a checksum of data that holds checksums should be."""
    crc = zlib.crc32(data)
    return ((crc >> 15 | crc << 17) + 0xA282EAD8) & 0xFFFFFFFF


def frame(payload: bytes) -> bytes:
    head = struct.pack("<Q", len(payload))
    return head + _TAIL.pack(masked(head)) + payload + _TAIL.pack(masked(payload))


def read_record(source) -> bytes:
    """The payload at the source's place; raises if a length or a checksum is wrong."""
    head = source.read(_HEAD.size)
    if len(head) != _HEAD.size:
        raise ValueError("record cut short")
    size, check = _HEAD.unpack(head)
    if masked(head[:8]) != check:
        raise ValueError("wrong checksum of a length")
    payload = source.read(size)
    tail = source.read(_TAIL.size)
    if len(payload) != size or len(tail) != _TAIL.size:
        raise ValueError("record cut short")
    if masked(payload) != _TAIL.unpack(tail)[0]:
        raise ValueError("wrong checksum of a payload")
    return payload


def open_folder(uri: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(uri)


# The vocabulary's own way to split lower-case text; white space is dropped.
_PIECE = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")

# What every version of the character tables splits and lowers alike, and composition leaves
# alone. Texts with any other character are given to the library as they are.
_UNCOMMON = regex.compile(r"[^\x00-\x1b\x20-\x84\x86-\u012f\u0131-\u024f]")


# Marks that often follow a word.
_MARKS = pa.array([".", ",", ";", ":", "!", "?"], type=pa.large_string())


def laid_out(
    data: np.ndarray, count: np.ndarray, order: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """The entries of ``data``, ``count`` each, put one after another in an order of entries;
    and where each ends, after a leading zero."""
    first = np.cumsum(count) - count
    size = count[order]
    end = np.concatenate([[0], np.cumsum(size)])
    place = np.repeat(first[order] - end[:-1], size) + np.arange(end[-1])
    return data[place], end


class PieceIds:
    """Ids of whole texts, each distinct word given to the library once while it is known.

    The merges of this vocabulary never cross a piece and no piece holds white space, so a
    text's ids are those of its words in order. Distinct words are encoded many at a time,
    joined by blanks; the last id of every piece ends a word in the vocabulary, which tells
    them apart again. A text with the string of a special token, which the library takes for
    that token, is given to it whole.
    """

    def __init__(self, path: str, dtype: str = "<u4"):
        self.model = Tokenizer.from_file(path)
        added = self.model.get_added_tokens_decoder().values()
        self.special = tuple(token.content.lower() for token in added)
        self.dtype = np.dtype(dtype)
        words = self.model.get_vocab(with_added_tokens=False)
        self.ends = np.zeros(max(words.values()) + 1, dtype=bool)
        self.ends[[n for word, n in words.items() if word.endswith("</w>")]] = True
        self._forget()

    def _forget(self) -> None:
        """No word is known: their texts, all their ids and how many each has."""
        self.known = pa.array([], type=pa.large_string())
        self.known_ids = np.zeros(0, dtype=self.dtype)
        self.known_count = np.zeros(0, dtype=np.int64)

    def _ids(self, text: str) -> np.ndarray:
        return np.array(self.model.encode(text, add_special_tokens=False).ids, dtype=self.dtype)

    def _has_special(self, text: str) -> bool:
        low = text.lower()
        return any(token in low for token in self.special)

    def _words(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the words, and how many each has."""
        # A word and the mark after it are two pieces; so fewer are distinct.
        mark = pc.utf8_slice_codeunits(words, -1)
        stem = pc.utf8_slice_codeunits(words, 0, -1)
        marked = pc.and_(pc.is_in(mark, value_set=_MARKS), pc.utf8_is_alpha(stem))
        empty = pa.scalar("", type=words.type)
        parts = pa.concat_arrays(
            [pc.if_else(marked, stem, words), pc.if_else(marked, mark, empty)]
        ).dictionary_encode()
        data, count = self._pieces(parts.dictionary)
        part = parts.indices.to_numpy().reshape(2, -1).T.ravel()
        ids, end = laid_out(data, count, part)
        return ids, np.diff(end[::2])

    def _pieces(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The same of distinct words as the library splits them; known ones are looked up."""
        place = pc.index_in(words, value_set=self.known)
        unknown = place.is_null().to_numpy(zero_copy_only=False)
        order = place.fill_null(0).to_numpy().astype(np.int64)
        order[unknown] = len(self.known) + np.arange(np.count_nonzero(unknown))
        new = words.filter(pa.array(unknown))
        ids, count = self._encoded(new)
        self.known = pa.concat_arrays([self.known, new])
        self.known_ids = np.concatenate([self.known_ids, ids])
        self.known_count = np.concatenate([self.known_count, count])
        count = self.known_count[order]
        ids, _ = laid_out(self.known_ids, self.known_count, order)
        if self.known.nbytes > KNOWN_BYTES:
            self._forget()
        return ids, count

    def _encoded(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The same of words that the library is given."""
        texts = words.to_numpy(zero_copy_only=False).tolist()
        joined = [
            " ".join(texts[start : start + WORDS_AT_ONCE])
            for start in range(0, len(texts), WORDS_AT_ONCE)
        ]
        found = [
            np.array(x.ids, dtype=self.dtype)
            for x in self.model.encode_batch_fast(joined, add_special_tokens=False)
        ]
        ids = np.concatenate([*found, np.zeros(0, dtype=self.dtype)])
        pieces = np.ones(len(texts), dtype=np.int64)
        for n in np.flatnonzero(~pc.utf8_is_alpha(words).to_numpy(zero_copy_only=False)).tolist():
            pieces[n] = len(_PIECE.findall(texts[n]))
        ends = np.concatenate([[0], np.flatnonzero(self.ends[ids]) + 1])
        if len(ends) - 1 != pieces.sum():  # a word that splits otherwise than alone
            each = [self._ids(text) for text in texts]
            ids = np.concatenate([*each, np.zeros(0, dtype=self.dtype)])
            return ids, np.fromiter(map(len, each), np.int64, len(each))
        return ids, np.diff(ends[np.concatenate([[0], np.cumsum(pieces)])])

    def __call__(self, texts: list[str]) -> list[bytes]:
        out: list[bytes] = [b""] * len(texts)
        common = []
        for n, text in enumerate(texts):
            if _UNCOMMON.search(text) or self._has_special(text):
                out[n] = self._ids(text).tobytes()
            else:
                common.append(n)
        lists = pc.utf8_split_whitespace(
            pc.utf8_lower(pa.array([texts[n] for n in common], type=pa.large_string()))
        )
        coded = pc.list_flatten(lists).dictionary_encode()
        data, count = self._words(coded.dictionary)
        whole, end = laid_out(data, count, coded.indices.to_numpy())
        cut = end[np.asarray(lists.offsets)]
        for k, n in enumerate(common):
            out[n] = whole[cut[k] : cut[k + 1]].tobytes()
        return out


@lru_cache(maxsize=1)
def shared_encoder(path: str, dtype: str) -> PieceIds:
    """The encoder of a Python worker, kept from one task to the next."""
    return PieceIds(path, dtype)


def gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list, list[str]]]:
    """Ids and texts of several batches at a time: fewer distinct words in all."""
    ids: list = []
    texts: list[str] = []
    chars = 0
    for batch in batches:
        for doc, text in rows_of(batch):
            ids.append(doc)
            texts.append(text or "")
            chars += len(texts[-1])
            if chars >= CHARS_AT_ONCE:
                yield ids, texts
                ids, texts, chars = [], [], 0
    if ids:
        yield ids, texts


def id_type(path: str, end_id: int) -> str:
    """The narrower of the two id types that holds the whole vocabulary."""
    size = max(Tokenizer.from_file(path).get_vocab_size(with_added_tokens=True), end_id + 1)
    return "<u2" if size <= 1 << 16 else "<u4"


_INDEX = pa.schema(
    [
        ("shard", pa.int32()),
        ("ordinal", pa.int64()),
        ("doc_id", pa.int64()),
        ("offset", pa.int64()),
        ("size", pa.int64()),
        ("width", pa.int32()),
    ]
)


def write_records(
    docs: DataFrame, tokenizer_file: str, end_id: int = END_ID, folder: str | None = None
) -> str:
    """Encode every text, write shards in ascending ``doc_id`` order, return their folder.

    Null texts count as empty, so they are a record of the end id alone. Null ids come first;
    rows of equal id are ordered by a hash of their text. An empty table has an empty index.
    Only ``doc_id`` and ``text`` are read. A shard is written under a name of the attempt
    and then renamed, so a repeated task replaces it with the same bytes.
    """
    spark = docs.sparkSession
    folder = folder or f"{shared_folder(spark)}/galepost/records-{uuid.uuid4().hex}"
    dtype = id_type(tokenizer_file, end_id)
    width = np.dtype(dtype).itemsize
    tail = np.array([end_id], dtype=dtype).tobytes()

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, path = open_folder(folder)
        encode = shared_encoder(tokenizer_file, dtype)
        task = TaskContext.get()
        shard = task.partitionId()
        system.create_dir(path, recursive=True)
        name = f"{path}/shard-{shard:06d}.rec"
        attempt = f"{path}/.attempt-{shard:06d}-{task.taskAttemptId()}"
        at = ordinal = 0
        with system.open_output_stream(attempt) as sink:
            for docs_of, texts in gathered(batches):
                out = []
                for doc, ids in zip(docs_of, encode(texts), strict=True):
                    record = frame(ids + tail)
                    sink.write(record)
                    out.append((shard, ordinal, doc, at, len(record), width))
                    at += len(record)
                    ordinal += 1
                yield batch_of(out, _INDEX)
        if ordinal:
            # Not every store replaces a file that an earlier attempt left.
            if system.get_file_info(name).type != fs.FileType.NotFound:
                system.delete_file(name)
            system.move(attempt, name)
        else:
            system.delete_file(attempt)

    ordered = (
        docs.select("doc_id", "text")
        .withColumn("__tie", text_key())
        .repartitionByRange("doc_id", "__tie")
        .sortWithinPartitions("doc_id", "__tie")
        .select("doc_id", "text")
    )
    index = map_batches(
        ordered,
        write,
        "shard int, ordinal long, doc_id long, offset long, size long, width int",
    )
    index.write.parquet(f"{folder}/index")
    return folder


_BACK = pa.schema(
    [
        ("shard", pa.int32()),
        ("doc_id", pa.int64()),
        ("ordinal", pa.int64()),
        ("n_tokens", pa.int64()),
        ("run_tokens", pa.int64()),
        ("ids_crc32", pa.int64()),
        ("ids", pa.binary()),
    ]
)


def read_records(spark, folder: str, with_ids: bool = True) -> DataFrame:
    """The records of all shards through the index, with running totals within the shard."""
    index = spark.read.parquet(f"{folder}/index")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, path = open_folder(folder)
        current, source, total = None, None, 0
        try:
            for batch in batches:
                out = []
                for shard, ordinal, doc, offset, _, width in rows_of(batch):
                    if shard != current:
                        if source:
                            source.close()
                        source = system.open_input_file(f"{path}/shard-{shard:06d}.rec")
                        current, total = shard, 0
                    if source.tell() != offset:
                        source.seek(offset)
                    ids = np.frombuffer(read_record(source), dtype=f"<u{width}")
                    ids = ids.astype("<u4").tobytes()
                    out.append(
                        (shard, doc, ordinal, len(ids) // 4, total, zlib.crc32(ids),
                         ids if with_ids else None)
                    )
                    total += len(ids) // 4
                yield batch_of(out, _BACK)
        finally:
            if source:
                source.close()

    return map_batches(
        index.repartition("shard").sortWithinPartitions("shard", "offset"),
        read,
        "shard int, doc_id long, ordinal long, n_tokens long, run_tokens long,"
        " ids_crc32 long, ids binary",
    )


def record_digests(records: DataFrame) -> DataFrame:
    """Per document its first id's place in the whole output, its ids and their checksum."""
    shards = records.groupBy("shard").agg(
        F.max(F.col("run_tokens") + F.col("n_tokens")).alias("tokens")
    )
    starts = carried(shards, "shard", [], ["tokens"])
    return records.join(starts, "shard").select(
        "doc_id",
        (F.col("before_tokens") + F.col("run_tokens")).alias("start"),
        "n_tokens",
        "ids_crc32",
    )
