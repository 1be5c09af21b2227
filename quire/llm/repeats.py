"""Repeated runs of words: the way from documents to groups and back that substring dedup and suffix-array dedup share.

A run of `length` words is repeated if its word sequence starts at two places or more, in one document or several. Every run
holds a minimiser, its least run of GRAM words by hash, which depends on its words alone; equal runs have equal minimisers.
So runs whose minimiser stands at one place only cannot be repeated. Places of the other minimisers are the seeds. A seed
goes out once with its context, the words that runs around it can reach, to a group that holds all seeds it may share a run
with; there an operator's own judge compares words and answers which of the seed's runs are repeated.

Groups are dealt by the minimiser. A minimiser that stands at HOT places or more is dealt by longer runs instead: a seed's runs that
reach far to its right by the words there, the others by the words to its left, so a frequent phrase does not make a large group.
Their number follows from the number of seeds. Work goes in blocks of documents: what a block asks about is made distinct in the
block, cut into groups and packed, so a passage that stands in every document costs one entry a block, and no step makes a row
for each word or pair. Documents of equal words are looked at once. All tables stand in the shared folder.

Words are compared by hashes: 64 bits choose the seeds, 40 bits a word are compared in groups.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.llm.common import Workspace, compress, expand, pack, planes, trimmed, trimmed_group, unpack, whole
from quire.llm.hashing import BASE, WordHashes, run_hashes

GRAM = 8
#: Words and bytes of a block, at least one document; ids up to which a side is broadcast; starts handled at once.
WORDS, BYTES, IDS, STRIDE = 2_000_000, 16 << 20, 1_000_000, 1 << 19
#: Seeds of a block and of a group, groups at most, places from which a minimiser is hot, and rows handled at once.
SEEDS, PER_GROUP, MOST_GROUPS, HOT, STEP = 25_000, 20_000, 16_384, 20_000, 1024
BLOCKS = "block long, part int, doc_id long, n_words long, whole_sha256 string, text_id binary, content binary"
ANSWERS = "block long, part int, content binary"
#: Parts of a block that are no groups.
DOCS, BODY = -2, -1


def each(batches: Iterator[pa.RecordBatch], *names: str) -> Iterator[tuple]:
    """The rows of batches one at a time, as their values may be large."""
    for batch in batches:
        columns = [batch.column(x) for x in names]
        for k in range(batch.num_rows):
            yield tuple(c[k].as_py() for c in columns)


def block_schema() -> pa.Schema:
    return pa.schema([("block", pa.int64()), ("part", pa.int32()), ("doc_id", pa.int64()), ("n_words", pa.int64()), ("whole_sha256", pa.string()), ("text_id", pa.binary()), ("content", pa.binary())])


def rows_of(block: int, rows: list[dict]) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist([{"block": block, **row} for row in rows], schema=block_schema())


def minimisers(grams: np.ndarray, span: int) -> np.ndarray:
    """For each start, the place of the least of `span` grams from there on; of equal ones the first."""
    out = []
    for at in range(0, max(0, len(grams) - span + 1), STRIDE):
        part = grams[at : at + STRIDE + span - 1]
        low = np.uint64((1 << 20) - 1)
        least = (part & ~low) | np.arange(len(part), dtype=np.uint64)
        width = 1
        while width * 2 <= span:
            least = np.minimum(least[:-width], least[width:])
            width *= 2
        if width < span:
            rest = span - width
            least = np.minimum(least[: len(least) - rest], least[rest:])
        out.append((least & low).astype(np.int64) + at)
    return np.concatenate([np.zeros(0, np.int64), *out])


def even_groups(keys: np.ndarray, groups: int) -> np.ndarray:
    """A group for each key by its high bits, in the keys' own order."""
    return ((keys >> np.uint64(32)) * np.uint64(groups) >> np.uint64(32)).astype(np.int64)


def cut_groups(block: int, groups: np.ndarray, *columns: np.ndarray) -> tuple[np.ndarray, list[dict]]:
    """The order by group, and a packed row for each group."""
    order = np.argsort(groups, kind="stable")
    names, starts = np.unique(groups[order], return_index=True)
    ends = np.append(starts, len(groups))[1:]
    return order, [{"part": int(g), "content": pack(*(c[order[a:b]] for c in columns))} for g, a, b in zip(names, starts, ends, strict=True)]


def answered(order: np.ndarray, answers: list[dict], kind: type) -> np.ndarray:
    """Answers by group in the entries' order."""
    out = np.zeros(len(order), kind)
    out[order] = np.concatenate([np.zeros(0, kind), *(unpack(x["content"])[0] for x in sorted(answers or [], key=lambda x: x["part"]))])
    return out


def ask(work: Workspace, name: str, rows: DataFrame, groups: int, judge: Callable[[list[list[np.ndarray]]], np.ndarray], sizes: Callable[[list[np.ndarray]], int]) -> DataFrame:
    """block, answers: what judge says of each group's entries, block by block. sizes tells how many entries a part has."""

    @trimmed_group
    def run(table: pa.Table) -> pa.Table:
        parts = [unpack(x) for x in table.column("content").to_pylist()]
        ends = np.cumsum([sizes(p) for p in parts])
        found = judge(parts)
        out = [pack(found[start:end]) for start, end in zip(np.append(0, ends), ends, strict=False)]
        return pa.table({"block": table.column("block"), "part": table.column("part"), "content": pa.array(out, pa.binary())})

    found = rows.select("block", "part", "content").repartition(groups, "part").groupBy("part").applyInArrow(run, ANSWERS)
    return work.table(found, name).groupBy("block").agg(F.collect_list(F.struct("part", "content")).alias("answers"))


def places_of(hot: int):
    """Judges minimisers: 0 for one place, 1 for several, 2 for `hot` or more over all blocks."""

    def judge(parts: list[list[np.ndarray]]) -> np.ndarray:
        keys, counts = (np.concatenate(c) for c in zip(*parts, strict=True))
        _, of = np.unique(keys, return_inverse=True)
        total = np.bincount(of, counts)[of]
        return (total > 1).astype(np.uint8) + (total >= hot)

    return judge


def scan(length: int, groups: int):
    """A mapInArrow function from (doc_id, text) to blocks of documents with their minimisers."""

    @trimmed
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, block = WordHashes(100_000), TaskContext.get().partitionId() << 32
        docs, places, keys, words, size = [], [], [], 0, 0

        def flush() -> pa.RecordBatch:
            found, index, counts = np.unique(np.concatenate([np.zeros(0, np.uint64), *keys]), return_inverse=True, return_counts=True)
            _, rows = cut_groups(block, even_groups(found, groups), found, np.minimum(counts, 65535).astype(np.uint16))
            ends = np.cumsum([0, *(len(p) for p in places)])
            ids = np.frombuffer(b"".join(d["text_id"] for d in docs), np.uint8)
            body = pack(np.array([d["doc_id"] or 0 for d in docs], np.int64), np.array([d["doc_id"] is not None for d in docs], np.uint8), ids, ends, np.concatenate([np.zeros(0, np.uint32), *places]), index.astype(np.uint32), found)
            return rows_of(block, [*docs, {"part": BODY, "content": body}, *rows])

        for doc_id, text in each(batches, "doc_id", "text"):
            found = (text or "").encode().split()
            numbers = hashes.of(found)
            docs.append({"part": DOCS, "doc_id": doc_id, "n_words": len(found), "whole_sha256": hashlib.sha256(b" ".join(found)).hexdigest(), "text_id": xxhash.xxh3_128_digest(numbers.tobytes())})
            grams = run_hashes(numbers, GRAM)
            chosen = np.unique(minimisers(grams, length - GRAM + 1))
            places.append(chosen.astype(np.uint32))
            keys.append(grams[chosen])
            words, size = words + len(found), size + len(text or "")
            if words >= WORDS or size >= BYTES:
                yield flush()
                block += 1
                docs, places, keys, words, size = [], [], [], 0, 0
        if docs:
            yield flush()

    return run


@trimmed
def seeds(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From (content, answers) of blocks to the documents that hold repeated minimisers, with these places and which of them are hot."""
    for content, answers, count in each(batches, "content", "answers", "groups"):
        ids, known, text_ids, ends, places, index, found = unpack(content)
        again = answered(np.argsort(even_groups(found, count), kind="stable"), answers, np.uint8)[index]
        out = []
        for k in range(len(ids)):
            part = slice(ends[k], ends[k + 1])
            flags = again[part]
            if flags.any():
                out.append((int(ids[k]) if known[k] else None, text_ids[16 * k : 16 * k + 16].tobytes(), pack(places[part][flags > 0], flags[flags > 0] - 1), int((flags > 0).sum())))
        kinds = (pa.int64(), pa.binary(), pa.binary(), pa.int64())
        yield pa.record_batch([pa.array([r[k] for r in out], kind) for k, kind in enumerate(kinds)], names=["doc_id", "text_id", "places", "n"])


def reach(length: int) -> tuple[int, int]:
    """How many words before a seed its runs can reach, and how many words right of it a hot seed's right runs have at least."""
    return length - GRAM, (length + GRAM) // 2


def encode_context(words: np.ndarray, hashes: np.ndarray) -> list[np.ndarray]:
    """Rows of word numbers as byte planes of numbers that count only the words in them, and the planes of these words' hashes."""
    used = np.flatnonzero(np.bincount(words.reshape(-1), minlength=len(hashes)))
    local = np.zeros(len(hashes), np.uint32)
    local[used] = np.arange(len(used), dtype=np.uint32)
    return [*planes(local[words].reshape(-1))[:3], *(((hashes[used] >> np.uint64(8 * k)) & np.uint64(255)).astype(np.uint8) for k in range(5))]


def decode_context(columns: list[np.ndarray], width: int) -> np.ndarray:
    """The rows of 40-bit word hashes; 0 stands outside the document."""
    hashes = sum(c.astype(np.uint64) << np.uint64(8 * k) for k, c in enumerate(columns[3:8]))
    return hashes[whole(columns[:3])].reshape(-1, width)


def contexts(length: int, groups: int):
    """A mapInArrow function from (text, text_id, places) to blocks of seeds with their contexts.

    A block's body holds its seeds by document, which distinct entry each is, and its entries in the order in which they go out. An entry goes
    to its group with its words, the least and the most words by which its own runs start before it, and whether it stands twice in the block.
    """
    before, far = reach(length)
    width = before + length

    @trimmed
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, block = WordHashes(100_000), TaskContext.get().partitionId() << 32
        texts, ids, ends, parts, count, size = [], [], [0], [], 0, 0

        def flush() -> pa.RecordBatch:
            numbers, places, least, most, hot, keys, right, left = (np.concatenate([p[k] for p in parts]) for k in range(8))
            sizes = np.array([len(p[0]) for p in parts])
            starts = np.cumsum(sizes) - sizes
            per_doc = np.diff(ends)
            vocabulary, index = np.unique(numbers, return_inverse=True)
            if not len(vocabulary) or vocabulary[0]:
                vocabulary, index = np.append(np.uint64(0), vocabulary), index + 1
            rank = np.append(0, 1 + np.argsort(np.argsort(-np.bincount(index, minlength=len(vocabulary))[1:], kind="stable"), kind="stable"))
            word, named = rank[index].astype(np.uint32), np.zeros_like(vocabulary)
            named[rank] = vocabulary
            named = np.where(np.arange(len(named)) > 0, np.maximum(named & np.uint64((1 << 40) - 1), 1), 0).astype(np.uint64)
            # numbers are padded at both ends, so every context lies within its own document's part
            at = places.astype(np.int64) + np.repeat(starts, per_doc)
            mixer = np.cumprod(np.full(width, BASE, np.uint64))
            digest = np.concatenate([np.zeros(0, np.uint64), *((numbers[at[k : k + STEP, None] + np.arange(width)] * mixer).sum(axis=1, dtype=np.uint64) for k in range(0, len(at), STEP))])
            _, first, entry, times = np.unique(digest, return_index=True, return_inverse=True, return_counts=True)
            cool, has_right, has_left = ~hot[first].astype(bool), right[first] > 0, left[first] > 0
            sent = np.concatenate([np.flatnonzero(cool), np.flatnonzero(~cool & has_right), np.flatnonzero(~cool & has_left)])
            n_left = int((~cool & has_left).sum())
            key = np.concatenate([keys[first][cool], right[first][~cool & has_right], left[first][~cool & has_left]])
            group = even_groups(key, groups)
            group[len(group) - n_left :] += groups  # a seed must not meet itself
            order = np.argsort(group, kind="stable")
            sent, group = sent[order], group[order]
            names, begin = np.unique(group, return_index=True)
            rows = []
            for g, a, b in zip(names.tolist(), begin, np.append(begin, len(group))[1:], strict=True):
                e = first[sent[a:b]]
                rows.append({"part": g, "content": pack(*encode_context(word[at[e, None] + np.arange(width)], named), least[e], most[e], (times[sent[a:b]] > 1).astype(np.uint8))})
            body = pack(np.frombuffer(b"".join(ids), np.uint8), np.array(ends, np.int64), places, entry.astype(np.uint32), sent.astype(np.uint32))
            return rows_of(block, [{"part": BODY, "content": body}, {"part": DOCS, "content": compress(b"\n".join(texts))}, *rows])

        for text, text_id, packed in each(batches, "text", "text_id", "places"):
            found = (text or "").encode().split()
            numbers = hashes.of(found)
            if xxhash.xxh3_128_digest(numbers.tobytes()) != text_id:
                continue  # another text under the same doc_id
            places, hot = unpack(packed)
            at, grams = minimisers(run_hashes(numbers, GRAM), before + 1), run_hashes(numbers, GRAM)
            low, high = np.searchsorted(at, places, "left"), np.searchsorted(at, places, "right") - 1
            right, left = np.zeros(len(places), np.uint64), np.zeros(len(places), np.uint64)
            if hot.any():
                fits, runs = places + far <= len(numbers), run_hashes(numbers, far)
                right[fits] = np.maximum(runs[places[fits]], 1)
                back = length - far + 1
                fits, runs = places >= back, run_hashes(numbers, back + GRAM)
                left[fits] = np.maximum(runs[places[fits] - back], 1)
            padded = np.concatenate([np.zeros(before, np.uint64), numbers, np.zeros(length, np.uint64)])
            texts.append(b" ".join(found))
            ids.append(text_id)
            ends.append(ends[-1] + len(places))
            parts.append((padded, places, (places - high).astype(np.uint8), (places - low).astype(np.uint8), hot, grams[places], right, left))
            count, size = count + len(places), size + len(texts[-1])
            if count >= SEEDS or size >= BYTES // 4:
                yield flush()
                block += 1
                texts, ids, ends, parts, count, size = [], [], [0], [], 0, 0
        if ids:
            yield flush()

    return run


def bits(least: np.ndarray, most: np.ndarray) -> np.ndarray:
    """Numbers whose bits `least` to `most` are set; none where most is less."""
    low, high = least.astype(np.uint64), np.maximum(most.astype(np.int64) + 1, least).astype(np.uint64)
    return (np.uint64(1) << high) - (np.uint64(1) << low)


def removed(length: int):
    """A mapInArrow function from (content, texts, answers) to the words that repeated runs cover, by document."""

    @trimmed
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for content, texts, answers in each(batches, "content", "texts", "answers"):
            ids, ends, places, entry, sent = unpack(content)
            masks = np.zeros(int(entry.max()) + 1, np.uint64)
            np.bitwise_or.at(masks, sent, answered(np.arange(len(sent)), answers, np.uint64))
            masks, out = masks[entry], []
            for k, text in enumerate(expand(texts).split(b"\n")):
                part = slice(ends[k], ends[k + 1])
                seed, back = np.nonzero(masks[part, None] >> np.arange(length - GRAM + 1, dtype=np.uint64) & np.uint64(1))
                if not len(seed):
                    continue
                at, found = places[part][seed].astype(np.int64) - back, text.split(b" ")
                cover = np.zeros(len(found) + 1, np.int32)
                np.add.at(cover, at, 1)
                np.add.at(cover, at + length, -1)
                gone = np.cumsum(cover[:-1]) > 0
                spans = int(gone[0]) + int((gone[1:] & ~gone[:-1]).sum())
                kept = b" ".join(w for w, g in zip(found, gone.tolist(), strict=True) if not g)
                out.append((ids[16 * k : 16 * k + 16].tobytes(), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
            yield pa.record_batch([pa.array([r[k] for r in out], kind) for k, kind in enumerate((pa.binary(), pa.int64(), pa.int64(), pa.string()))], names=["text_id", "n_removed", "n_spans", "kept_sha256"])

    return run


#: Of a group's seeds: words (a row each, 0 outside the document), the least and the most words that its runs start before it, whether it stands
#: twice in its block; the answer has bit a set if the run that starts a words before the seed is repeated.
Judge = Callable[[np.ndarray, np.ndarray, np.ndarray, np.ndarray], np.ndarray]


def find_repeats(spark: SparkSession, docs: DataFrame, name: str, length: int, judge: Judge, hot: int = HOT, groups: int = 64) -> DataFrame:
    """doc_id, n_words, n_removed, n_spans, kept_sha256 of every row of docs (doc_id, text)."""
    if not GRAM <= length <= 64:
        raise ValueError(f"a run has {GRAM} words at least and 64 at most")
    work = Workspace(spark, name)
    groups = max(groups, int(spark.conf.get("spark.sql.shuffle.partitions")))
    text = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    blocks = work.table(text.mapInArrow(scan(length, groups), BLOCKS), "blocks")
    all_docs = blocks.where(f"part = {DOCS}").select("doc_id", "n_words", "whole_sha256", "text_id")
    answers = ask(work, "minimisers", blocks.where("part >= 0"), groups, places_of(hot), lambda p: len(p[0]))
    bodies = blocks.where(f"part = {BODY}").select("block", "content").join(answers, "block").select("content", "answers", F.lit(groups).alias("groups"))
    found = bodies.mapInArrow(seeds, "doc_id long, text_id binary, places binary, n long")
    found = work.table(found.groupBy("text_id").agg(F.min("doc_id").alias("doc_id"), F.min(F.struct("places", "n")).alias("of")).select("text_id", "doc_id", "of.*"), "seeds")
    ids = found.select(F.col("doc_id").alias("id")).distinct()
    n_seeds, n_ids = found.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count_distinct("doc_id")).first()
    groups = min(MOST_GROUPS, max(groups, n_seeds // PER_GROUP))
    wanted = text.join(F.broadcast(ids) if n_ids <= IDS else ids, F.col("doc_id").eqNullSafe(F.col("id")), "left_semi")
    texts = wanted.join(found.withColumnRenamed("doc_id", "id"), F.col("doc_id").eqNullSafe(F.col("id"))).select("text", "text_id", "places")
    sent = work.table(texts.mapInArrow(contexts(length, groups), BLOCKS), "contexts")
    width = reach(length)[0] + length

    def judged(parts: list[list[np.ndarray]]) -> np.ndarray:
        words = np.concatenate([decode_context(p, width) for p in parts])
        return judge(words, *(np.concatenate(c) for c in zip(*(p[8:] for p in parts), strict=True)))

    answers = ask(work, "answers", sent.where("part >= 0"), groups, judged, lambda p: len(p[8]))
    bodies = sent.where(f"part = {BODY}").select("block", "content")
    held = sent.where(f"part = {DOCS}").select("block", F.col("content").alias("texts"))
    spans = bodies.join(held, "block").join(answers, "block").select("content", "texts", "answers").mapInArrow(removed(length), "text_id binary, n_removed long, n_spans long, kept_sha256 string")
    spans = work.table(spans.dropDuplicates(["text_id"]), "found")
    copies = all_docs.where(F.col("n_words") >= length).groupBy("text_id").agg(F.count("*").alias("copies")).where("copies > 1")
    gone, nothing = F.col("copies").isNotNull(), hashlib.sha256(b"").hexdigest()
    return all_docs.join(spans, "text_id", "left").join(copies, "text_id", "left").select(
        "doc_id", "n_words", F.when(gone, F.col("n_words")).otherwise(F.coalesce("n_removed", F.lit(0))).alias("n_removed"),
        F.when(gone, 1).otherwise(F.coalesce("n_spans", F.lit(0))).cast("long").alias("n_spans"),
        F.when(gone, nothing).otherwise(F.coalesce("kept_sha256", "whole_sha256")).alias("kept_sha256"),
    )
