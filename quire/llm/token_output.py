"""Token ids as Arrow IPC files of equal-length sequences.

Documents are dealt by doc_id range and sorted, so the files follow ascending doc_id. Each range becomes one file of
record batches with two fixed-size-list columns: ids (unsigned 16 bits where the vocabulary allows, else 32) and mask
(true for a token, false for the padding of the last sequence). Token t of a file stands at a place that follows from
t alone (batch t // (rows * length)), so a memory map gives any sequence without copying. A second small file holds
each document's place. Files get a name of their own for each task attempt; only those named in the manifest, a table
written after the files are complete, count, so a lost executor leaves at most an unused file.

A chunk starts at a space that a non-space follows; the vocabulary's pre-tokenizer always starts a new piece there, so the ids
of a text are those of its chunks, which the library itself encodes. Arrow cuts texts and numbers their distinct chunks, whose ids are
cached, and the ids of all chunks are then taken by number; Python handles distinct chunks only.

Cases: a null text is empty and has its end id only; equal doc_ids follow each other in order of text; a null doc_id
comes first and stays null; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import re
import uuid
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quire.llm.common import Workspace, caches, portions, trimmed

MANIFEST = "part int, data string, places string, n_docs long, n_tokens long"
CACHED = 1_000_000
#: Chunks that are given to the library as one text, and how a byte-level vocabulary writes a space.
JOINED, SPACE = 500, "\u0120"
#: Bytes of text that are cut and encoded at once, at least one document.
TEXT = 16 << 20


class ChunkEncoder:
    """Ids of texts as little-endian bytes, from a cache of chunks that lives as long as the Python worker."""

    def __init__(self, vocabulary: str):
        import os

        import public_tokenizers
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.model = Tokenizer.from_file(public_tokenizers.path(vocabulary))
        self.kind = np.dtype("<u2" if self.model.get_vocab_size() <= 1 << 16 else "<u4")
        self.cache: dict[str, bytes] = {"": b""}
        self.opens = np.zeros(max(self.model.get_vocab().values()) + 1, bool)
        self.opens[[k for x, k in self.model.get_vocab().items() if x.startswith(SPACE)]] = True
        self.pieces = re.compile(r"(?= \S)").split

    def ids_of(self, chunks: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of the chunks one after another, and where each chunk's ids start, with the end of the last."""
        cache = self.cache
        if len(cache) > CACHED:
            cache.clear()
            cache[""] = b""
        missing = {x for x in chunks if x not in cache}
        if missing:
            self.learn(missing)
        parts = [cache[x] for x in chunks]
        starts = np.zeros(len(parts) + 1, np.int64)
        np.cumsum(np.fromiter(map(len, parts), np.int64, len(parts)) // self.kind.itemsize, out=starts[1:])
        return np.frombuffer(b"".join(parts), self.kind), starts

    def encode(self, texts: pa.Array, end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts one after another, an end id after each, and how many each has.

        Arrow cuts at spaces and numbers the distinct pieces, so Python sees each of these once; then ids are taken by number. A piece
        that is empty or starts with white space means that a chunk has several spaces; such texts are cut one by one.
        """
        lists = pc.split_pattern(texts.cast(pa.large_string()), " ")
        bounds = lists.offsets.to_numpy() - lists.offsets[0].as_py()
        pieces = lists.flatten()
        coded = pieces.dictionary_encode()
        names = coded.dictionary.to_pylist()
        odd = np.fromiter((not x or x[0].isspace() for x in names), bool, len(names))
        codes = coded.indices.to_numpy().astype(np.int64)
        strange = odd[codes]
        strange[bounds[:-1]] = False  # the first piece follows no space
        irregular = np.flatnonzero(np.add.reduceat(strange, bounds[:-1])) if len(texts) else np.zeros(0, np.int64)
        firsts = pieces.take(pa.array(bounds[:-1])).to_pylist()
        apart = [self.pieces(texts[int(k)].as_py()) for k in irregular]
        flat, starts = self.ids_of([*(" " + x for x in names), *firsts, *(x for cut in apart for x in cut)])
        flat, end = np.append(flat, np.array(end_id, self.kind)), len(starts) - 1
        starts = np.append(starts, len(flat))
        codes[bounds[:-1]] = len(names) + np.arange(len(texts))
        sequence = np.insert(codes, bounds[1:], end)
        sizes = np.diff(bounds) + 1
        if len(irregular):
            cuts = np.cumsum(sizes)
            parts, at, number = [], 0, len(names) + len(firsts)
            for k, cut in zip(irregular.tolist(), apart, strict=True):
                parts += [sequence[at : cuts[k] - sizes[k]], np.arange(number, number + len(cut)), np.array([end])]
                at, number, sizes[k] = int(cuts[k]), number + len(cut), len(cut) + 1
            sequence = np.concatenate([*parts, sequence[at:]])
        many = starts[sequence + 1] - starts[sequence]
        ends = np.cumsum(many)
        ids = flat[np.repeat(starts[sequence] - (ends - many), many) + np.arange(int(ends[-1]) if len(ends) else 0)]
        totals = np.append(0, ends)[np.append(0, np.cumsum(sizes))]
        return ids, np.diff(totals)

    def learn(self, chunks: set[str]) -> None:
        """Has the library encode chunks, those that hold no space but their first one in joined texts.

        Such a chunk's ids start where a piece starts with a space, if the text has as many of these as chunks. A comma or full stop
        after a letter is a piece of its own, so the chunk without it is learned.
        """
        cache, whole, ended = self.cache, [x for x in (",", ".") if x not in self.cache], []
        for x in chunks:
            if x[-1:] in (",", ".") and x[-2:-1].isalpha():
                ended.append(x)
                x = x[:-1]
                if x in cache:
                    continue
            whole.append(x)
        plain = [x for x in whole if x[0] == " " and " " not in x[1:]] if self.opens.any() else []
        for at in range(0, len(plain), JOINED):
            part = plain[at : at + JOINED]
            ids = np.array(self.model.encode_batch_fast(["".join(part)], add_special_tokens=False)[0].ids, self.kind)
            starts = np.append(np.flatnonzero(self.opens[ids]), len(ids))
            if len(starts) == len(part) + 1:
                raw, cuts = ids.tobytes(), (starts * self.kind.itemsize).tolist()
                cache.update((x, raw[cuts[k] : cuts[k + 1]]) for k, x in enumerate(part))
        code, rest = "H" if self.kind.itemsize == 2 else "I", [x for x in whole if x not in cache]
        for x, found in zip(rest, self.model.encode_batch_fast(rest, add_special_tokens=False), strict=True):
            cache[x] = array(code, found.ids).tobytes()
        for x in ended:
            cache[x] = cache[x[:-1]] + cache[x[-1]]


def encoder(vocabulary: str) -> ChunkEncoder:
    if vocabulary not in caches:
        caches[vocabulary] = ChunkEncoder(vocabulary)
    return caches[vocabulary]


def opened(uri: str):
    """The file system of a URI or a plain path, and the path in it."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri) if "://" in uri or uri.startswith("file:") else (fs.LocalFileSystem(), uri)


def write_files(root: str, vocabulary: str, end_id: int, length: int, rows: int):
    """A mapInArrow function that writes the documents of a partition and returns its manifest row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, part = encoder(vocabulary), TaskContext.get().partitionId()
        kind, step = model.kind, length * rows
        name = f"{root}/part-{part:05d}-{uuid.uuid4().hex}"
        store, path = opened(name)
        value = pa.uint16() if kind.itemsize == 2 else pa.uint32()
        schema = pa.schema([pa.field("ids", pa.list_(value, length), False), pa.field("mask", pa.list_(pa.bool_(), length), False)])
        held, size, total, count, file = [], 0, 0, 0, None
        places_schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64())])

        def batch_of(ids: np.ndarray) -> pa.RecordBatch:
            real = len(ids)
            full = -(-real // length) * length
            if full > real:
                ids = np.concatenate([ids, np.zeros(full - real, kind)])
            return pa.record_batch([pa.FixedSizeListArray.from_arrays(pa.array(ids), length), pa.FixedSizeListArray.from_arrays(pa.array(np.arange(full) < real), length)], schema=schema)

        for batch in (part for b in batches for part in portions(b, TEXT)):
            if file is None:
                store.create_dir(path.rsplit("/", 1)[0], recursive=True)
                sinks = store.open_output_stream(f"{path}.arrow"), store.open_output_stream(f"{path}.places.arrow")
                file, places = pa.ipc.new_file(sinks[0], schema), pa.ipc.new_file(sinks[1], places_schema)
            ids, sizes = model.encode(pc.fill_null(batch.column(1), ""), end_id)
            starts = total + np.cumsum(sizes) - sizes
            places.write_batch(pa.record_batch([batch.column(0), pa.array(starts), pa.array(sizes)], schema=places_schema))
            total, count = total + len(ids), count + len(sizes)
            held.append(ids)
            size += len(ids)
            if size >= step:
                ids = np.concatenate(held)
                whole = size // step * step
                for at in range(0, whole, step):
                    file.write_batch(batch_of(ids[at : at + step]))
                held, size = [ids[whole:].copy()], size - whole
        if file is not None:
            if size:
                file.write_batch(batch_of(np.concatenate(held)))
            file.close(), places.close(), sinks[0].close(), sinks[1].close()
            yield pa.record_batch([pa.array([part], pa.int32()), pa.array([f"{name}.arrow"]), pa.array([f"{name}.places.arrow"]), pa.array([count], pa.int64()), pa.array([total], pa.int64())], names=["part", "data", "places", "n_docs", "n_tokens"])

    return run


class TokenFile:
    """Random access to one file: sequences, masks and runs of tokens as views of the mapped file."""

    def __init__(self, uri: str):
        store, path = opened(uri)
        self.source = pa.memory_map(path) if type(store).__name__ == "LocalFileSystem" else store.open_input_file(path)
        self.reader = pa.ipc.open_file(self.source)
        self.length = self.reader.schema.field("ids").type.list_size
        self.rows = self.reader.get_batch(0).num_rows
        self._batch: tuple[int, np.ndarray] = (-1, np.zeros(0))

    def sequence(self, number: int) -> tuple[np.ndarray, pa.Array]:
        """The ids of a sequence and its mask."""
        batch = self.reader.get_batch(number // self.rows)
        at = number % self.rows * self.length
        return batch.column("ids").flatten().to_numpy()[at : at + self.length], batch.column("mask").flatten()[at : at + self.length]

    def tokens(self, start: int, count: int) -> np.ndarray:
        step, parts = self.length * self.rows, []
        while count > 0:
            number, at = divmod(start, step)
            if self._batch[0] != number:
                batch = self.reader.get_batch(number)
                if not batch.column("mask").flatten()[at].as_py():
                    raise ValueError("a document's place points at padding")
                self._batch = number, batch.column("ids").flatten().to_numpy()
            part = self._batch[1][at : at + count]
            parts.append(part)
            start, count = start + len(part), count - len(part)
        return parts[0] if len(parts) == 1 else np.concatenate(parts)


def read_places(uri: str) -> Iterator[pa.RecordBatch]:
    store, path = opened(uri)
    with store.open_input_file(path) as source:
        reader = pa.ipc.open_file(source)
        for k in range(reader.num_record_batches):
            yield reader.get_batch(k)


@trimmed
def read_files(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From manifest rows (data, places, base) to a row for each document, read from the files."""
    for batch in batches:
        for data, places, base in zip(*(batch.column(k).to_pylist() for k in range(3)), strict=True):
            file = TokenFile(data)
            for part in read_places(places):
                starts, sizes = part.column("start").to_numpy(), part.column("n_tokens").to_numpy()
                crc = [zlib.crc32(file.tokens(int(s), int(n)).astype("<u4").tobytes()) for s, n in zip(starts, sizes, strict=True)]
                yield pa.record_batch([part.column("doc_id"), pa.array(starts + base), part.column("n_tokens"), pa.array(crc, pa.int64())], names=["doc_id", "start", "n_tokens", "ids_crc32"])


def write_tokens(spark: SparkSession, docs: DataFrame, vocabulary: str = "byte_bpe_50k.json", end_id: int = 0, length: int = 1024, rows: int = 64) -> DataFrame:
    """Writes docs (doc_id, text) as token files and returns the manifest: part, data, places, n_docs, n_tokens."""
    work = Workspace(spark, "token-output")
    text = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    dealt = text.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    return work.table(dealt.mapInArrow(write_files(work.path("files"), vocabulary, end_id, length, rows), MANIFEST), "manifest")


def read_tokens(manifest: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of every document, read from the files that the manifest names."""
    base = F.coalesce(F.sum("n_tokens").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    tasks = int(manifest.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    files = manifest.withColumn("base", base).select("data", "places", "base").repartition(tasks, "data")
    return files.mapInArrow(read_files, "doc_id long, start long, n_tokens long, ids_crc32 long")
