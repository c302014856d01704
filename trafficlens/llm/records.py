"""Token ids as length-delimited binary records.

File format. A file is a row of records; a record is
    length    8 bytes, unsigned little-endian: bytes of the payload
    check     4 bytes: masked crc32 of the length's bytes
    payload   1 byte: 1 if there is a doc_id, else 0; 8 bytes: doc_id, signed;
              then the ids, unsigned, 2 bytes each
    check     4 bytes: masked crc32 of the payload
    newline   1 byte, 0x0A
A masked crc is the crc32 rotated right by 15 bits plus a constant, so that a
checksum over data with checksums inside stays useful. Ids over 65,535 are refused.

Files are written by Spark's own text sink, one row per record (the newline is
its line end): it works on any store that Spark reaches, and a lost executor
or a second attempt leaves no half file. Rows are dealt by ranges of doc_id, as
many as keep a file's text at about ``FILE_TEXT`` bytes whatever the size of the
table, and sorted inside, so part files in the order of their numbers hold ascending
doc_ids. Rows with a null doc_id come first; of equal doc_ids the order is
that of a hash of the text. A null text is written as the end id alone.

The offset index is a separate Parquet table (file, doc_id, offset, length,
n_tokens, ...): a loader draws its rows in any order and reads each record by
one seek (``record_at``).

Tokenising: a text is cut before single spaces, line ends, commas and stops
between other characters, where the tokenizer's pre-tokenizer cuts too; chunks seen before
come from a cache of bounded size.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window
from pyspark.sql import functions as F

from trafficlens.llm.common import ship_by_value, stored, worker_state

ship_by_value(__name__)

# fixed value of the format
MASK_DELTA = 0xA282EAD8
HEAD = 12
# bytes of text to a file of records, about
FILE_TEXT = 256 << 20
TAIL = 5
# white space but for space and line end, as Python sees it
ODD_STOP = re.compile(r"[,.](?<![0-9A-Za-z\u00C0-\u00D6\u00D8-\u00F6\u00F8-\u024F][,.])")
OTHER_SPACE = [c for c in map(chr, range(0x3001)) if c.isspace() and c not in " \n"]
ASCII_SPACE = [c for c in OTHER_SPACE if c.isascii()]
SAFE_SPACE = re.compile(r"(?<=\S) (?=\S)")


def masked(data: bytes) -> int:
    crc = zlib.crc32(data)
    return (((crc >> 15) | (crc << 17)) + MASK_DELTA) & 0xFFFFFFFF


def frame(doc_id: int | None, ids: bytes) -> bytes:
    """A record without its newline, which the text sink writes."""
    payload = (b"\0" + bytes(8) if doc_id is None else b"\1" + doc_id.to_bytes(8, "little", signed=True)) + ids
    length = len(payload).to_bytes(8, "little")
    return b"".join((length, masked(length).to_bytes(4, "little"), payload, masked(payload).to_bytes(4, "little")))


def record_at(data, offset: int) -> tuple[int | None, np.ndarray, int]:
    """doc_id, ids and the offset of the next record; raises if a check fails."""
    head = data[offset:offset + HEAD]
    if len(head) < HEAD or masked(head[:8]) != int.from_bytes(head[8:], "little"):
        raise ValueError(f"damaged record length at offset {offset}")
    end = offset + HEAD + int.from_bytes(head[:8], "little")
    payload = data[offset + HEAD:end]
    if masked(payload) != int.from_bytes(data[end:end + 4], "little") or data[end + 4:end + TAIL] != b"\n":
        raise ValueError(f"damaged record at offset {offset}")
    doc_id = int.from_bytes(payload[1:9], "little", signed=True) if payload[0] else None
    return doc_id, np.frombuffer(payload[9:], "<u2"), end + TAIL


def _chunked(text: str | None) -> list[str]:
    """Chunks of a text: the first as it is, a later one without the space
    before it, or with the line end, comma or full stop before it. Commas and
    stops are cut off only if each follows a letter or digit; else a chunk
    that begins with one keeps its space. In a text with other white
    space, or with a space or line end beside another or at its ends, only
    single spaces between other characters count."""
    if not text:
        return [""]
    if (text[0] in " \n" or text[-1] in " \n" or any(pair in text for pair in ("  ", " \n", "\n ", "\n\n"))
            or any(c in text for c in (ASCII_SPACE if text.isascii() else OTHER_SPACE))):
        parts = SAFE_SPACE.split(text)
    elif ODD_STOP.search(text):
        parts = text.replace("\n", " \n").split(" ")
    else:
        return text.replace("\n", " \n").replace(",", " ,").replace(".", " .").split(" ")
    return parts[:1] + [" " + p if p[0] in ",." else p for p in parts[1:]]


def _spoken(chunk: str) -> str:
    """A later chunk as it stands in its text."""
    return chunk if chunk[0] in "\n,. " else " " + chunk


def _joinable(chunk: str) -> bool:
    return chunk[0] not in ",." and " " not in chunk and "\n" not in chunk[1:]


class Encoder:
    """Texts to ids as bytes, through the tokenizers library."""

    def __init__(self, tokenizer_path: str, end_id: int, most: int = 650_000):
        from tokenizers import Tokenizer

        self.tokenizer, self.end, self.most = Tokenizer.from_file(tokenizer_path), end_id, most
        self.seen: dict[str, bytes] = {}

        vocab = self.tokenizer.get_vocab()
        # the byte-level alphabet writes a space and a line end as these letters
        self.spaced = np.zeros(max(vocab.values()) + 1, bool)
        self.spaced[[i for token, i in vocab.items() if token[0] in "\u0120\u010a"]] = True

    def _encoded(self, texts: list[str]) -> list[np.ndarray]:
        out = [np.array(e.ids, np.int64) for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        if any(len(ids) and ids.max() > 0xFFFF for ids in out):
            raise ValueError("an id is over 65535")
        return out

    def _ids(self, texts: list[str]) -> list[bytes]:
        return [ids.astype("<u2").tobytes() for ids in self._encoded(texts)]

    def _chunks(self, chunks: list[str]) -> dict[str, bytes]:
        """Ids of later chunks. Those without a space or line end inside are
        encoded many in one text: each begins at a token that begins with one."""
        odd = [c for c in chunks if not _joinable(c)]
        plain = [c for c in chunks if _joinable(c)]
        got = dict(zip(odd, self._ids([_spoken(c) for c in odd])))
        groups = [plain[i:i + 200] for i in range(0, len(plain), 200)]
        for group, ids in zip(groups, self._encoded(["".join(map(_spoken, g)) for g in groups])):
            raw = ids.astype("<u2").tobytes()
            cuts = (2 * np.append(np.flatnonzero(self.spaced[ids]), len(ids))).tolist()
            got.update(zip(group, [raw[a:b] for a, b in zip(cuts, cuts[1:])], strict=True))
        return got

    def encode(self, texts: list[str | None]) -> list[bytes]:
        # A chunk is pre-tokenised alike alone and in its text.
        cut = [_chunked(t) for t in texts]
        # A first chunk without white space goes with a line end before it, whose
        # id is taken off again; other first chunks are encoded by themselves.
        heads = {i: parts[0] for i, parts in enumerate(cut) if parts[0].split() != [parts[0]]}
        heads = dict(zip(heads, self._ids(list(heads.values()))))
        find, found, gaps = self.seen.get, [], []
        for n, parts in enumerate(cut):
            parts[0] = "" if n in heads else "\n" + parts[0]
            ids = list(map(find, parts))
            if n in heads:
                ids[0] = heads[n]
            found.append(ids)
            gaps.append([i for i, x in enumerate(ids) if x is None])
        now = self._chunks(list({parts[i] for parts, places in zip(cut, gaps) for i in places}))
        for parts, ids, places in zip(cut, found, gaps):
            for i in places:
                ids[i] = now[parts[i]]
        # when full, what was seen first stays: it holds the common chunks
        if len(self.seen) < self.most:
            self.seen.update(now)
        end = self.end.to_bytes(2, "little")
        whole = [b"".join((*ids, end)) for ids in found]
        return [x if n in heads else x[2:] for n, x in enumerate(whole)]


def write_records(docs: DataFrame, path: str, tokenizer_path: str, end_id: int = 2, doc_id: str = "doc_id", text: str = "text") -> None:
    """Write the records of all rows of ``docs`` under ``path``."""
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    tie = F.xxhash64("text")
    order = F.col("doc_id").asc_nulls_first(), tie
    octets = docs.agg(F.sum(F.octet_length(F.col(text).cast("string")))).first()[0] or 0
    files, usual = -(-octets // FILE_TEXT), int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # up to the session's number of ranges it is left to the planner, which merges small ones
    rows = (rows.repartitionByRange(files, *order) if files > usual else rows.repartitionByRange(*order)).sortWithinPartitions(*order)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = worker_state("encoder", (tokenizer_path, end_id), lambda: Encoder(tokenizer_path, end_id))
        for b in batches:
            for i in range(0, b.num_rows, 256):
                part = b.slice(i, 256)
                ids = encoder.encode(part.column(1).to_pylist())
                yield pa.record_batch([pa.array([frame(d, x) for d, x in zip(part.column(0).to_pylist(), ids)], pa.binary())], names=["value"])

    # the text sink writes the bytes of a string as they are
    rows.mapInArrow(encode, "value binary").select(F.col("value").cast("string").alias("value")).write.text(path, lineSep="\n")


def build_index(spark: SparkSession, path: str) -> DataFrame:
    """Read all files back, check every record, and give one index row per
    record: file, part, doc_id, offset, length, n_tokens, before (ids of earlier
    records in the file), ids_crc32 (of the ids as 4 bytes each)."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path)

    def scan(batches):
        for b in batches:
            for name, content in zip(b.column(0).to_pylist(), b.column(1)):
                data = memoryview(content.as_buffer())
                rows, at, before = [], 0, 0
                while at < len(data):
                    doc_id, ids, after = record_at(data, at)
                    rows.append((name, doc_id, at, after - at, len(ids), before, zlib.crc32(ids.astype("<u4").tobytes())))
                    before += len(ids)
                    at = after
                yield pa.record_batch([pa.array(c, t) for c, t in zip(
                    zip(*rows) if rows else [[]] * 7, [pa.string(), *[pa.int64()] * 6])],
                    names=["file", "doc_id", "offset", "length", "n_tokens", "before", "ids_crc32"])

    schema = "file string, doc_id long, offset long, length long, n_tokens long, before long, ids_crc32 long"
    part = F.regexp_extract("file", r"part-(\d+)", 1).cast("long")
    return files.select("path", "content").mapInArrow(scan, schema).withColumn("part", part)


def with_starts(index: DataFrame) -> DataFrame:
    """The index with ``start``: ids of all records before, over all files. Only
    one row per file meets in the window."""
    sums = index.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    before = F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    starts = sums.select("part", F.coalesce(before, F.lit(0)).alias("file_start"))
    return index.join(starts, "part").withColumn("start", (F.col("file_start") + F.col("before")).cast("long"))


def written_and_indexed(docs: DataFrame, path: str, tokenizer_path: str, end_id: int = 2) -> DataFrame:
    """Write records and their index (a stored table); returns the index with starts."""
    write_records(docs, path, tokenizer_path, end_id)
    return with_starts(stored(build_index(docs.sparkSession, path), "record-index"))


def shuffled(index: DataFrame, seed: int) -> DataFrame:
    """The index in a random order that ``seed`` fixes: range-partitioned, so a
    loader's workers take whole partitions and read each record by its offset."""
    key = F.xxhash64(F.lit(seed), F.col("file"), F.col("offset"))
    return index.orderBy(key, "file", "offset")
