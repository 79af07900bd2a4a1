"""Token ids as Arrow stream files of fixed-size lists.

Every document is encoded whole, gets an end id, and the ids of all documents
in ascending doc_id order are cut into sequences of equal length. A shard is
one Arrow IPC stream: batches of ``sequence`` (fixed-size list of unsigned
ids), ``mask`` (fixed-size list of booleans, false on padding). Because all
lists have one length, sequence i of a memory-mapped shard is a slice of its
value buffer: random access without a copy. A second stream per shard, the
index, lists its documents (doc_id, place in the shard, ids).

Documents are range-partitioned by doc_id and sorted inside each partition,
so a task encodes and writes its shard as it goes, in batches of bounded
size; the last sequence of a shard is padded. Shards are written beside
their final name and renamed, and their content depends on the rows alone,
so a repeated or speculative task replaces a file with the same bytes. The
folder must be in a store that ``pyarrow.fs`` can open (file, s3, gs, hdfs).
"""

from __future__ import annotations

import os
import re
import zlib
from array import array
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from encore.llm.common import id_and_bytes
from encore.session import ensure_checkpoint_dir, scratch_path

#: Ids of one sequence, and sequences of one Arrow batch.
SEQUENCE = 2048
BATCH = 512
#: Pieces of text whose ids a worker remembers, in each of two generations.
REMEMBERED = 500_000

# a word of plain letters up to a space or punctuation; punctuation up to a space;
# else everything up to a space
_PIECE = re.compile(
    r"[ \n]*[A-Za-zÀ-ÖØ-öø-ɏ]+(?![^ \n,.;:!?|%*&$#])|[,.;:!?|%*&$#]+(?![^ \n])|[ \n]*[^ \n]+|[ \n]+"
)
_OTHER_SPACE = re.compile(r"[^\S \n]")


def load_tokenizer(path: str):  # noqa: ANN201
    """The tokenizer of a JSON file, special strings treated as plain text."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(path)
    t.encode_special_tokens = True
    return t


class Encoder:
    """Ids of whole texts from a byte-level BPE tokenizer.

    Such a tokenizer never lets a token hold a space or line end that follows
    a visible character, nor a letter and punctuation after it, so a text may
    be cut there: its ids are those of its pieces, one after another. Distinct pieces are encoded by the library
    once and remembered (a bounded number). Texts with white space other than
    spaces and line ends are encoded whole.
    """

    def __init__(self, path: str, dtype: type = np.uint32) -> None:
        self.tokenizer = load_tokenizer(path)
        self.dtype = dtype
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def _library(self, texts: list[str]) -> list[bytes]:
        code = np.dtype(self.dtype).char
        return [array(code, e.ids).tobytes() for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def __call__(self, text: str) -> bytes:
        if not text:
            return b""
        if _OTHER_SPACE.search(text):
            return self._library([text])[0]
        pieces = _PIECE.findall(text)
        known = self.known
        try:
            return b"".join([known[p] for p in pieces])
        except KeyError:
            self._learn({p for p in pieces if p not in known})
        out = b"".join([known[p] for p in pieces])
        if len(known) > REMEMBERED:
            self.older, self.known = known, {}
        return out

    def _learn(self, pieces: set[str]) -> None:
        """Two generations are kept, so that a full memory forgets what was not met lately."""
        back = {p: self.older[p] for p in pieces if p in self.older}
        self.known.update(back)
        new = list(pieces - back.keys())
        self.known.update(zip(new, self._library(new)))


@lru_cache(maxsize=2)
def encoder(path: str, dtype: type) -> Encoder:
    """One encoder a worker process, so that what it remembers serves later tasks."""
    return Encoder(path, dtype)


def _filesystem(uri: str):  # noqa: ANN202
    from pyarrow import fs

    if "://" not in uri:  # a plain path, or Hadoop's file:/path
        uri = "file://" + uri.removeprefix("file:")
    return fs.FileSystem.from_uri(uri)


def id_type(vocabulary: int) -> type:
    """The narrowest unsigned type for a vocabulary's ids."""
    return np.uint16 if vocabulary <= 1 << 16 else np.uint32


def shard_schema(length: int, dtype: type) -> pa.Schema:
    return pa.schema([("sequence", pa.list_(pa.from_numpy_dtype(dtype), length)), ("mask", pa.list_(pa.bool_(), length))])


INDEX = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64())])


class _Shard:
    """Writes one shard and its index; nothing but the ids of one batch is kept."""

    def __init__(self, folder: str, name: str, length: int, dtype: type, attempt: str) -> None:
        self.fs, self.folder = _filesystem(folder)
        self.length, self.dtype, self.rest, self.at = length, dtype, [], 0
        self.held = 0
        self.paths = [(f"{self.folder}/.{name}.{kind}-{attempt}", f"{self.folder}/{name}.{kind}") for kind in ("arrows", "index")]
        self.files = [self.fs.open_output_stream(p) for p, _ in self.paths]
        self.schema = shard_schema(length, dtype)
        self.out = pa.ipc.new_stream(self.files[0], self.schema)
        self.index = pa.ipc.new_stream(self.files[1], INDEX)
        self.docs: list[tuple] = []

    def add(self, doc_id: int | None, ids: bytes) -> None:
        n = len(ids) // np.dtype(self.dtype).itemsize
        self.docs.append((doc_id, self.at, n))
        self.at += n
        self.rest.append(ids)
        self.held += n
        if self.held >= self.length * BATCH:
            self._flush(False)
        if len(self.docs) >= 1 << 16:
            self._write_index()

    def _flush(self, last: bool) -> None:
        ids = np.frombuffer(b"".join(self.rest), self.dtype)
        rows = -(-len(ids) // self.length) if last else len(ids) // self.length
        used = min(rows * self.length, len(ids))
        for i in range(0, rows, BATCH):
            part = ids[i * self.length : min((i + BATCH) * self.length, used)]
            k = -(-len(part) // self.length)
            values = np.zeros(k * self.length, self.dtype)
            values[: len(part)] = part
            mask = np.arange(k * self.length) < len(part)
            cols = [pa.FixedSizeListArray.from_arrays(pa.array(x), self.length) for x in (values, mask)]
            self.out.write_batch(pa.record_batch(cols, schema=self.schema))
        self.rest = [ids[used:].tobytes()]
        self.held = len(ids) - used

    def _write_index(self) -> None:
        if self.docs:
            self.index.write_batch(pa.record_batch([pa.array(c, pa.int64()) for c in zip(*self.docs)], schema=INDEX))
        self.docs = []

    def close(self) -> None:
        self._flush(True)
        self._write_index()
        for w in (self.out, self.index, *self.files):
            w.close()
        for temporary, final in self.paths:
            self.fs.move(temporary, final)


SHARDS = pa.schema([("shard", pa.string()), ("part", pa.int64()), ("docs", pa.int64()), ("ids", pa.int64())])


def _writer(folder: str, tokenizer: str, end_id: int, length: int, vocabulary: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        dtype = id_type(vocabulary)
        end = np.array([end_id], dtype).tobytes()
        task = TaskContext.get()
        shard, encode, docs, part = None, None, 0, task.partitionId()
        for batch in batches:
            for doc_id, body in zip(batch.column("doc_id").to_pylist(), batch.column("body")):
                if shard is None:
                    encode = encoder(tokenizer, dtype)
                    name = f"shard-{part:06d}"
                    shard = _Shard(folder, name, length, dtype, str(task.taskAttemptId()))
                shard.add(doc_id, encode(body.as_py().decode("utf-8", "replace")) + end)
                docs += 1
        if shard is not None:
            shard.close()
            yield pa.record_batch([[name], [part], [docs], [shard.at]], schema=SHARDS)

    return write


def write_token_files(docs: DataFrame, folder: str, tokenizer: str, end_id: int = 0, length: int = SEQUENCE, parts: int | None = None) -> DataFrame:
    """Encode ``docs`` into shards in ``folder``; ``shard, part, docs, ids`` of each.

    Documents are in ascending doc_id order (null first; equal ids by a hash of the text, then the text).
    A null text is empty: the end id alone. Other columns are ignored. An
    empty table writes no shard.
    """
    spark = docs.sparkSession
    fs, inner = _filesystem(folder)
    fs.create_dir(inner, recursive=True)
    slim = id_and_bytes(docs)
    n = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    order = ("doc_id", F.xxhash64("body"))
    ordered = slim.repartitionByRange(n, *order).sortWithinPartitions(*order, "body")
    vocabulary = load_tokenizer(tokenizer).get_vocab_size()
    done = ordered.mapInArrow(_writer(folder, tokenizer, end_id, length, vocabulary), "shard string, part long, docs long, ids long")
    report = f"{folder}.shards"
    done.write.mode("overwrite").parquet(report)
    return spark.read.parquet(report)


class Sequences:
    """The sequences of one shard by position, without copying.

    Batches stay where they were read (a memory map where the store is a
    local path); ``self[i]`` gives ids and mask of sequence i as slices of its batch.
    """

    def __init__(self, folder: str, shard: str) -> None:
        fs, inner = _filesystem(folder)
        with pa.ipc.open_stream(_open(fs, f"{inner}/{shard}.arrows")) as r:
            self.length = r.schema.field("sequence").type.list_size
            self.batches = [b for b in r if b.num_rows]
        self.first = np.cumsum([0, *(b.num_rows for b in self.batches)])

    def __len__(self) -> int:
        return int(self.first[-1])

    def __getitem__(self, i: int) -> tuple[np.ndarray, pa.BooleanArray]:
        i = i + len(self) if i < 0 else i
        if not 0 <= i < len(self):
            raise IndexError(i)
        at = int(np.searchsorted(self.first, i, side="right")) - 1
        row = self.batches[at].slice(i - int(self.first[at]), 1)
        return row.column("sequence").flatten().to_numpy(), row.column("mask").flatten()


def read_sequences(folder: str, shard: str) -> tuple[np.ndarray, np.ndarray]:
    """Ids and mask of a whole shard as two arrays (sequences, length). This copies
    a shard of several batches into one array; ``Sequences`` does not copy."""
    batches = Sequences(folder, shard).batches
    if not batches:
        return np.zeros((0, 0), np.uint32), np.zeros((0, 0), bool)
    length = batches[0].schema.field("sequence").type.list_size
    ids = [b.column("sequence").flatten().to_numpy().reshape(-1, length) for b in batches]
    masks = [b.column("mask").flatten().to_numpy(zero_copy_only=False).reshape(-1, length) for b in batches]
    return (ids[0], masks[0]) if len(ids) == 1 else (np.concatenate(ids), np.concatenate(masks))


def _open(fs, path: str):  # noqa: ANN001, ANN202
    """A memory map where the store is a local path, else an input file."""
    from pyarrow import fs as afs

    return pa.memory_map(path) if isinstance(fs, afs.LocalFileSystem) else fs.open_input_file(path)


def _read(folder: str) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Documents of each shard row, from its files, one batch of ids in memory at a time."""

    def documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, inner = _filesystem(folder)
        for rows in batches:
            for shard, base in zip(rows.column("shard").to_pylist(), rows.column("base").to_pylist()):
                yield from _shard_documents(fs, f"{inner}/{shard}", base)

    return documents


DOCUMENTS = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())])


def _shard_documents(fs, path: str, base: int) -> Iterator[pa.RecordBatch]:  # noqa: ANN001
    def ids() -> Iterator[np.ndarray]:
        with pa.ipc.open_stream(_open(fs, f"{path}.arrows")) as r:
            for b in r:
                seen = b.column("mask").flatten().to_numpy(zero_copy_only=False)
                values = b.column("sequence").flatten().to_numpy()
                yield values if seen[-1] else values[seen]

    stream, now, at = ids(), np.zeros(0, np.uint32), 0
    with pa.ipc.open_stream(_open(fs, f"{path}.index")) as r:
        for b in r:
            crcs = []
            for n in b.column("n_tokens").to_pylist():
                crc = 0
                while n:
                    if at == len(now):
                        now, at = next(stream).astype("<u4"), 0
                    take = min(n, len(now) - at)
                    crc = zlib.crc32(now[at : at + take], crc)
                    at, n = at + take, n - take
                crcs.append(crc)
            start = b.column("start").to_numpy() + base
            yield pa.record_batch([b.column("doc_id"), pa.array(start), b.column("n_tokens"), pa.array(crcs, pa.int64())], schema=DOCUMENTS)


def read_documents(spark: SparkSession, folder: str, shards: DataFrame) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of every document, from the files.

    ``start`` counts the ids of all documents before it; ``ids_crc32`` is the
    CRC-32 of its ids as little-endian unsigned 32-bit numbers.
    """
    # one row for each shard: a few thousand at most
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    based = shards.select("shard", "part", F.coalesce(F.sum("ids").over(before), F.lit(0)).alias("base"))
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return based.repartition(n, "shard").mapInArrow(_read(folder), "doc_id long, start long, n_tokens long, ids_crc32 long")


def token_files(docs: DataFrame, tokenizer: str, folder: str | None = None, end_id: int = 0, length: int = SEQUENCE) -> DataFrame:
    """Write ``docs`` as token files and return what the files hold for each document.

    ``folder`` (default: a new one in the shared checkpoint folder) keeps the
    shards. Repeated doc_ids give one row each; see ``write_token_files`` for
    nulls and empty tables.
    """
    spark = docs.sparkSession
    ensure_checkpoint_dir(spark)
    folder = folder or scratch_path(spark, "token-files")
    shards = write_token_files(docs, folder, tokenizer, end_id, length)
    return read_documents(spark, folder, shards)
