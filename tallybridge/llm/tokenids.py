"""Token-ID output: length-delimited binary records with masked checksums and an offset index.

A file is a run of frames::

    length    u64   bytes of the payload
    check     u32   masked CRC-32 of the eight length bytes
    payload         flag u8 (1: id follows as i64), id i64, width u8 (2 or 4), token ids
    check     u32   masked CRC-32 of the payload
    newline   u8    end of frame

All numbers are little-endian; ids take two bytes each where the vocabulary allows. A
masked checksum is the CRC rotated right by 15 bits plus a constant, so that a CRC over
data that itself holds CRCs stays meaningful. Spark's own text writer puts the frames down
(with the newline as its separator) and its ``binaryFile`` reader takes them up again, so
any file system that Spark reaches will do, and the commit protocol of the writer covers
lost executors and tasks that run twice.
"""

from __future__ import annotations

import os
import re
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import by_batch, kept

MASK_DELTA = 0xA282EAD8
HEADER, IDENTITY = "<QI", "<Bq"
HEADER_BYTES, IDENTITY_BYTES = struct.calcsize(HEADER), struct.calcsize(IDENTITY)
INDEX = "file string, part long, offset long, length long, doc_id long, n_tokens long, before long, ids_crc32 long"
# Chunks a worker remembers; a full memory is emptied. Only speed depends on it.
REMEMBERED = 400_000


def masked(data: bytes) -> int:
    crc = zlib.crc32(data)
    return ((crc >> 15 | crc << 17) + MASK_DELTA) & 0xFFFFFFFF


def frame(payload: bytes) -> bytes:
    length = struct.pack("<Q", len(payload))
    return b"".join((length, struct.pack("<I", masked(length)), payload, struct.pack("<I", masked(payload)), b"\n"))


def frames(data: bytes) -> Iterator[tuple[int, bytes]]:
    """(offset, payload) of every frame; raises ValueError on a frame that does not check out."""
    at = 0
    while at < len(data):
        if at + HEADER_BYTES > len(data):
            raise ValueError(f"frame header cut short at byte {at}")
        length, check = struct.unpack_from(HEADER, data, at)
        if masked(data[at : at + 8]) != check:
            raise ValueError(f"length checksum differs at byte {at}")
        start, end = at + HEADER_BYTES, at + HEADER_BYTES + length
        payload = data[start:end]
        if data[end + 4 : end + 5] != b"\n" or struct.unpack_from("<I", data, end)[0] != masked(payload):
            raise ValueError(f"payload checksum differs at byte {at}")
        yield at, payload
        at = end + 5


def pack(doc_id: int | None, ids: bytes, width: int) -> bytes:
    return struct.pack(IDENTITY, doc_id is not None, doc_id or 0) + bytes([width]) + ids


def unpack(payload: bytes) -> tuple[int | None, np.ndarray]:
    known, doc_id = struct.unpack_from(IDENTITY, payload)
    width = payload[IDENTITY_BYTES]
    return doc_id if known else None, np.frombuffer(payload, f"<u{width}", offset=IDENTITY_BYTES + 1)


def _classes() -> bytes:
    """By byte of UTF-8: blank, letter or digit (a), comma or full stop (,), other ASCII sign
    (x), or (z) what the short way of ``Encoder`` does not take: all but Latin-1 letters."""
    kind = bytearray(b"z" * 256)
    for byte in range(0x21, 0x7F):
        kind[byte] = ord("a" if chr(byte).isalnum() else "," if chr(byte) in ",." else "x")
    for byte in b" \t\n\v\f\r":
        kind[byte] = ord(" ")
    for byte in range(0x80, 0xC0):
        kind[byte] = ord("a")
    kind[0x97] = kind[0xB7] = ord("z")  # second bytes of the multiplication and division signs
    kind[0xC3] = ord("a")
    return bytes(kind)


class Numbers(dict):
    """Numbers chunks as they come; ``new`` lists those not yet encoded."""

    def __init__(self):
        self.new: list[str] = []

    def __missing__(self, chunk: str) -> int:
        self.new.append(chunk)
        self[chunk] = number = len(self)
        return number


class Encoder:
    """Ids of whole texts, found piece by piece.

    The vocabulary drops white space before it merges, and no token, normal form or special
    string reaches over it, so a text's ids are those of its chunks in order. Commas and full
    stops that stand between letters or blanks are chunks of their own, and a plain chunk is
    cut where the vocabulary's own pattern cuts it. The library encodes each new piece once,
    many to a call; a piece ends with the one token that is marked as a word's end. Any
    other chunk goes to the library as it is. What was found is remembered within a bound.
    """

    KIND = _classes()
    #: Characters whose lower case and normal form are theirs alone, and the pieces in them.
    PLAIN = re.compile(r"[\x21-\x7e\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]+")
    PIECE = re.compile(
        r"'s|'t|'re|'ve|'m|'ll|'d|[a-z\u00df-\u00f6\u00f8-\u00ff]+|[0-9]|[^\sa-z0-9\u00df-\u00f6\u00f8-\u00ff]+"
    )

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.width = 2 if self.tokenizer.get_vocab_size() <= 1 << 16 else 4
        suffix = getattr(self.tokenizer.model, "end_of_word_suffix", None)
        vocabulary = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        if suffix:
            self.ends[[i for token, i in vocabulary.items() if token.endswith(suffix)]] = True
        self.numbers, self.codes = Numbers(), []

    def _library(self, texts: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(x.ids, f"<u{self.width}").tobytes() for x in found]

    def _pieces(self, new: list[str]) -> list[bytes]:
        joined, w, at, out = self._library([" ".join(new)])[0], self.width, 0, []
        ids = np.frombuffer(joined, f"<u{w}")
        cuts = np.flatnonzero(self.ends[ids]) + 1
        if len(cuts) != len(new) or cuts[-1] != len(ids):
            return self._library(new)
        for cut in (cuts * w).tolist():
            out.append(joined[at:cut])
            at = cut
        return out

    def _learn(self, new: list[str]) -> None:
        """Puts the ids of the chunks ``new`` at the end of ``codes``, in their order."""
        codes, base, cut, whole, pieces = self.codes, len(self.codes), [], [], {}
        codes.extend([b""] * len(new))
        for n, chunk in enumerate(new, base):
            if self.PLAIN.fullmatch(chunk) and "<|" not in chunk:
                parts = self.PIECE.findall(chunk.lower())
                cut.append((n, parts))
                pieces.update(dict.fromkeys(parts))
            else:
                whole.append((n, chunk))
        if pieces:
            pieces = dict(zip(pieces, self._pieces(list(pieces)), strict=True))
        for n, parts in cut:
            codes[n] = pieces[parts[0]] if len(parts) == 1 else b"".join([pieces[p] for p in parts])
        if whole:
            for (n, _), found in zip(whole, self._library([chunk for _, chunk in whole]), strict=True):
                codes[n] = found

    def _chunks(self, text: str) -> list[str]:
        kinds = text.encode().translate(self.KIND)
        if b"z" in kinds or "<|" in text:
            return text.replace("\n", " ").split(" ")
        text = text.lower()
        if not (b",," in kinds or b",x" in kinds or b"x," in kinds):
            text = text.replace(",", " , ").replace(".", " . ")
        return text.split()

    def encode(self, texts: list[str | None]) -> list[bytes]:
        if len(self.codes) > REMEMBERED:
            self.numbers, self.codes = Numbers(), []
        number, codes = self.numbers.__getitem__, self.codes
        numbered = [list(map(number, self._chunks(text))) if text else [] for text in texts]
        if self.numbers.new:
            self._learn(self.numbers.new)
            self.numbers.new = []
        code = codes.__getitem__
        return [b"".join(map(code, numbers)) for numbers in numbered]


def write_records(
    docs: DataFrame, folder: str, path: str, *, id_column: str = "doc_id", text_column: str = "text", end_id: int = 1
) -> None:
    """Encode ``text_column`` and write frames to ``folder`` in ascending id order.

    A null text is an empty one, a null id comes first; rows with equal ids follow the order
    of their texts' hashes. Every row gets a frame that ends with ``end_id``; other columns are not
    read. An empty table gives no frames. Rows meet in files by range, so no key is hot.
    """

    def run(batch: pa.RecordBatch) -> Iterator[dict]:
        encoder = kept(f"encoder:{path}", lambda: Encoder(path))
        end = np.array([end_id], f"<u{encoder.width}").tobytes()
        texts = batch.column(1)
        for start in range(0, batch.num_rows, 500):
            ids, part = batch.column(0)[start : start + 500].to_pylist(), texts[start : start + 500].to_pylist()
            yield {
                "frame": [
                    frame(pack(i, found + end, encoder.width))[:-1]
                    for i, found in zip(ids, encoder.encode(part), strict=True)
                ]
            }

    rows = docs.select(F.col(id_column).cast("long").alias("id"), F.col(text_column).cast("string").alias("text"))
    drawn = F.xxhash64("text")
    ordered = rows.repartitionByRange("id", drawn).sortWithinPartitions("id", drawn, "text")
    by_batch(ordered, "frame binary", run).select(F.col("frame").cast("string")).write.option("lineSep", "\n").text(folder)


def read_files(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.format("binaryFile").load(folder).select("path", "content")


def write_index(spark: SparkSession, folder: str, target: str) -> DataFrame:
    """Check every frame under ``folder`` and write where it stands to ``target``.

    ``before`` counts the ids of earlier frames in the same file, ``part`` orders the files.
    Raises when a checksum differs.
    """

    def run(batch: pa.RecordBatch) -> Iterator[dict]:
        for path, content in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            out: dict[str, list] = {c: [] for c in ("offset", "length", "doc_id", "n_tokens", "before", "ids_crc32")}
            before = 0
            for offset, payload in frames(content.as_py()):
                doc_id, ids = unpack(payload)
                crc = zlib.crc32(ids.astype("<u4").tobytes())
                for column, value in zip(out, (offset, len(payload), doc_id, len(ids), before, crc), strict=True):
                    out[column].append(value)
                before += len(ids)
            rows, part = len(out["offset"]), int(re.search(r"part-(\d+)", path)[1])
            yield out | {"file": [path] * rows, "part": [part] * rows}

    by_batch(read_files(spark, folder), INDEX, run).write.parquet(target)
    return spark.read.schema(T.StructType.fromDDL(INDEX)).parquet(target)


def positions(index: DataFrame) -> DataFrame:
    """One row per frame with ``start``, the ids of all documents before it.

    Only one sum per file meets in one task; the frames of a file carry their own counts.
    """
    from pyspark.sql import Window

    files = index.groupBy("part").agg(F.sum("n_tokens").alias("tokens"))
    earlier = F.sum("tokens").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    return index.join(files.select("part", F.coalesce(earlier, F.lit(0)).alias("base")), "part").withColumn(
        "start", F.col("base") + F.col("before")
    )


def read_records(spark: SparkSession, folder: str) -> DataFrame:
    """doc_id and the whole id list of every frame, in parallel by file."""

    def run(batch: pa.RecordBatch) -> Iterator[dict]:
        for content in batch.column(1):
            for _, payload in frames(content.as_py()):
                doc_id, ids = unpack(payload)
                yield {"doc_id": [doc_id], "ids": [ids.astype(np.int32)]}

    return by_batch(read_files(spark, folder), "doc_id long, ids array<int>", run)


def read_shuffled(spark: SparkSession, folder: str, index: DataFrame, seed: int) -> DataFrame:
    """Frames in an order drawn from ``seed``: the index rows are dealt anew, then each task
    cuts its frames out of the files by offset and length."""
    files = read_files(spark, folder)
    wanted = index.groupBy("file").agg(F.collect_list(F.struct("offset", "length")).alias("at"))

    def run(batch: pa.RecordBatch) -> Iterator[dict]:
        for content, at in zip(batch.column(0), batch.column(1).to_pylist(), strict=True):
            data = content.as_py()
            for x in at:
                doc_id, ids = unpack(data[x["offset"] + HEADER_BYTES : x["offset"] + HEADER_BYTES + x["length"]])
                yield {"doc_id": [doc_id], "offset": [x["offset"]], "ids": [ids.astype(np.int32)]}

    cut = by_batch(
        files.join(wanted, files.path == wanted.file).select("content", "at"),
        "doc_id long, offset long, ids array<int>",
        run,
    )
    drawn = F.xxhash64(F.lit(seed), "doc_id", "offset")
    return cut.repartitionByRange(drawn).sortWithinPartitions(drawn).select("doc_id", "ids")
