"""Token counts: pieces are counted once per distinct pre-token and joined to per-document pre-token frequencies.

Texts are cut at ASCII white space into chunks, and chunks of Latin letters, digits and ASCII signs, in lower case, by
the vocabulary's own pattern into pre-tokens; any other chunk (control strings, other scripts, accents to compose) is one
pre-token, whose inner cuts the library makes. The tokenizer never merges across these cuts, so the pieces of a text are
those of its pre-tokens. Documents are read once into blocks. A block holds a dictionary of its distinct pre-tokens and,
packed, each document's frequencies; both are written to the shared folder. Only dictionaries are shuffled, packed by
block and hash shard, to the shard's task, and their piece counts back to the block: one entry for each block and distinct
pre-token, never one for each word, so a word that stands in every document costs one entry a block. A shard's task gives
each distinct pre-token to the library once. No token ids are kept.

Cases: a null text is empty and has no bytes and no tokens; an empty table gives no rows; repeated rows give one
result row each; other columns of the input are ignored, whatever their names; a null doc_id stays null.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.llm.common import Interner, Workspace, compress, expand, pack, planes, unpack, whole, trimmed

BLOCK = "block long, shard int, content binary"
COUNTED = "block long, shard int, content binary"


#: The vocabulary's pattern, for the characters that SAFE lets through.
PIECES = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[^\W\d_]+|\d|(?:[^\w\s]|_)+")
SAFE = re.compile(r"[!-~À-ÖØ-öø-įĲ-ňŊ-ž]+")


def pre_tokens(chunk: bytes) -> list[str]:
    text = chunk.decode("utf-8", "replace")
    return PIECES.findall(text.lower()) if SAFE.fullmatch(text) and "<|" not in text else [text]


def build_blocks(shards: int, max_words: int, max_bytes: int):
    """A mapInArrow function from (doc_id, text) to BLOCK rows; a block ends at either limit, but holds whole documents.

    Row -1 of a block has its documents; row s has the pre-tokens of shard s of its dictionary, one a line.
    """

    @trimmed
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("block", pa.int64()), ("shard", pa.int32()), ("content", pa.binary())])
        block = TaskContext.get().partitionId() << 32
        words, ids, known, sizes, ends, index, counts, held = Interner(), [], [], [], [0], [], [], 0

        def flush():
            tokens, parts, cuts = Interner(), [], [0]
            for word in words:
                parts += [tokens[x] for x in pre_tokens(word)]
                cuts.append(len(parts))
            names = [x.encode() for x in tokens]
            shard = np.fromiter((crc32(x) % shards for x in names), np.int32, len(names))
            order = np.argsort(shard, kind="stable")
            place = np.empty(len(names), np.int32)
            place[order] = np.arange(len(names), dtype=np.int32)
            cuts_of = np.searchsorted(shard[order], np.arange(shards + 1))
            docs = pack(place[np.array(parts, np.int64)], np.array(cuts, np.int32), np.array(ids, np.int64), np.array(known, np.uint8), np.array(sizes, np.int64), np.array(ends, np.int64), *planes(np.concatenate([np.zeros(0, np.uint32), *index])), *planes(np.concatenate([np.zeros(0, np.uint32), *counts])))
            rows = [(-1, docs)]
            for s in range(shards):
                if cuts_of[s] < cuts_of[s + 1]:
                    rows.append((s, compress(b"\n".join(names[k] for k in order[cuts_of[s] : cuts_of[s + 1]].tolist()))))
            yield pa.record_batch([pa.array([block] * len(rows), pa.int64()), pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.binary())], schema=schema)

        for batch in batches:
            texts = pc.cast(batch.column(1), pa.binary())
            for doc_id, text in zip(batch.column(0).to_pylist(), texts.to_pylist(), strict=True):
                text = text or b""
                found = text.split()
                numbers, times = np.unique(np.fromiter(map(words.__getitem__, found), np.int32, len(found)), return_counts=True)
                ids.append(doc_id or 0)
                known.append(doc_id is not None)
                sizes.append(len(text))
                ends.append(ends[-1] + len(numbers))
                index.append(np.diff(numbers, prepend=0).astype(np.uint32))
                counts.append(times.astype(np.uint32))
                held += len(text)
                if len(words) >= max_words or held >= max_bytes:
                    yield from flush()
                    block += 1
                    words, ids, known, sizes, ends, index, counts, held = Interner(), [], [], [], [0], [], [], 0
        if ids:
            yield from flush()

    return run


def count_pieces(vocabulary: str):
    """A mapInArrow function from a shard's rows, block by block, to the pieces of their pre-tokens.

    Rows come sorted by shard; each distinct pre-token of a shard is given to the library once.
    """

    @trimmed
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        count = piece_counter(vocabulary)
        now, pieces = None, {}
        for batch in batches:
            for block, shard, content in zip(*(batch.column(k).to_pylist() for k in range(3)), strict=True):
                if shard != now:
                    now, pieces = shard, {}
                words = expand(content).split(b"\n")
                new = [x for x in words if x not in pieces]
                pieces.update(zip(new, count([x.decode("utf-8", "replace") for x in new]), strict=True))
                found = pack(np.fromiter(map(pieces.__getitem__, words), np.int32, len(words)))
                yield pa.record_batch([pa.array([block], pa.int64()), pa.array([shard], pa.int32()), pa.array([found], pa.binary())], names=["block", "shard", "content"])

    return run


def piece_counter(vocabulary: str):
    """Counts pieces with the library that the vocabulary file is for: tokenizers for .json, sentencepiece for .model."""
    import public_tokenizers

    if vocabulary.endswith(".json"):
        from tokenizers import Tokenizer

        model = Tokenizer.from_file(public_tokenizers.path(vocabulary))
        model.no_truncation()
        model.no_padding()
        return lambda words: [len(x) for at in range(0, len(words), 5000) for x in model.encode_batch_fast(words[at : at + 5000], add_special_tokens=False)]
    raise ValueError(f"{vocabulary}: pieces of this kind of vocabulary depend on the white space between words")


def sum_documents(limit: int):
    """A mapInArrow function from (docs, pieces by shard) to a row for each document."""

    @trimmed
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for docs, found in zip(batch.column("docs").to_pylist(), batch.column("found").to_pylist(), strict=True):
                parts, cuts, ids, known, sizes, ends, *rest = unpack(docs)
                steps, counts = whole(rest[:4]), whole(rest[4:])
                run_up = np.concatenate([[0], np.cumsum(steps)])
                index = run_up[1:] - np.repeat(run_up[ends[:-1]], np.diff(ends))
                pieces = np.concatenate([np.zeros(0, np.int64), *(unpack(x["content"])[0] for x in sorted(found or [], key=lambda x: x["shard"]))])
                total = np.concatenate([[0], np.cumsum(pieces[parts])])
                pieces = total[cuts[1:]] - total[cuts[:-1]]
                total = np.concatenate([[0], np.cumsum(pieces[index] * counts)])
                tokens = total[ends[1:]] - total[ends[:-1]]
                yield pa.record_batch([pa.array(ids, mask=known == 0), pa.array(sizes), pa.array(tokens), pa.array(tokens > limit)], names=["doc_id", "n_bytes", "n_tokens", "over_limit"])

    return run


def token_counts(spark: SparkSession, docs: DataFrame, vocabulary: str = "word_bpe_49k.json", limit: int = 2048, shards: int = 64, max_words: int = 600_000, max_bytes: int = 64 << 20) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit (n_tokens > limit) of every row of docs (doc_id, text)."""
    work = Workspace(spark, "token-counts")
    text = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    shards = max(shards, int(spark.conf.get("spark.sql.shuffle.partitions")))
    blocks = work.table(text.mapInArrow(build_blocks(shards, max_words, max_bytes), BLOCK), "blocks")
    words = blocks.where("shard >= 0").repartition(shards, "shard").sortWithinPartitions("shard")
    found = words.mapInArrow(count_pieces(vocabulary), COUNTED).groupBy("block").agg(F.collect_list(F.struct("shard", "content")).alias("found"))
    held = blocks.where("shard < 0").select("block", F.col("content").alias("docs"))
    return held.join(found, "block", "left").select("docs", "found").mapInArrow(sum_documents(limit), "doc_id long, n_bytes long, n_tokens long, over_limit boolean")
