"""Quality classifier: interpolated modified Kneser-Ney models over characters, thresholds by language.

Words are lower-cased runs without white space; a model gives each character's chance after the four before it in its word.
One model per language is trained on trusted text (labelled of good quality and not toxic), one on text labelled toxic. All
labelled text outside the hold-out third is counted; nothing is capped. Every document gets its perplexity under the trusted model
and its peak, the most bits by which one of its words is likelier under the toxic model. A document is rejected if either is above a
quantile of its language's held-out trusted documents (see limits_of for languages with few of them).

Documents are read once into blocks of one language. A block makes its words distinct and their character runs too, and sends the
runs with its counts to count shards, one for each language and character before the last. All counts, contexts and shorter runs that
a run's chance needs end in that same character, so a shard joins the blocks' counts and answers every block with the chances of
its runs (discounts are estimated shard by shard; the shortest context, none, comes from the numbers of distinct
pairs, a table of one row for each language and character). So shuffles carry one entry for each block and distinct run.

Cases: null and empty texts have no perplexity and are kept; a null language is "und"; a language without trusted held-out text
rejects nothing; documents without a label are only scored; repeated labels of one document count as good and toxic if any does;
repeated rows give one result row each; a document at a limit is kept; an empty table gives no rows; a null doc_id has no label; characters from
U+0C00 on share 1024 classes; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.llm.common import Interner, Workspace, pack, planes, trimmed, trimmed_group, unpack, whole
from quire.llm.repeats import each

ORDER, BITS = 5, 12
MASK = (1 << BITS) - 1
BLOCKS = "block long, lang string, part int, content binary"
PAIRS, DOCS = -2, -1
#: Distinct words and words of a block, and labels up to which they are broadcast.
WORDS, RUNNING, LABELS = 125_000, 1_000_000, 2_000_000
#: Held-out trusted documents from which a language's own quantile is its limit: two are above it.
ENOUGH = 400
SCORES = "doc_id long, lang string, use int, perplexity double, peak double"
#: What a document is used for.
NOTHING, TRUSTED, TOXIC, HELD_OUT = 0, 1, 2, 3


def run_keys(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The keys of all character runs of the words, with an end mark, and where each word's runs end."""
    lead = "\x02" * (ORDER - 1)
    points = np.frombuffer("".join(f"{lead}{w}\x03" for w in words).encode("utf-32-le", "replace"), "<u4").astype(np.uint64)
    points = np.where(points < 0x0C00, points, 0x0C00 + points % 1024)
    sizes = np.fromiter(map(len, words), np.int64, len(words)) + 1
    keys = np.zeros(max(0, len(points) - ORDER + 1), np.uint64)
    for k in range(ORDER):
        keys = keys << np.uint64(BITS) | points[k : k + len(keys)]
    ends = np.cumsum(sizes)
    starts = ends - sizes + np.arange(len(words)) * (ORDER - 1)
    place = np.arange(int(ends[-1]) if len(ends) else 0) - np.repeat(ends - sizes, sizes) + np.repeat(starts, sizes)
    return keys[place], ends


def layout(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The distinct runs of a block's words, which run each place has, where each word's places end, and the runs' order by count shard."""
    keys, word_ends = run_keys(words)
    runs, of = np.unique(keys, return_inverse=True)
    return runs, of, word_ends, np.argsort(runs >> np.uint64(BITS) & np.uint64(MASK), kind="stable")


class Block:
    """Documents of one language."""

    def __init__(self, lang: str):
        self.lang, self.words = lang, Interner()
        self.ids, self.known, self.use, self.ends, self.index, self.counts, self.total = [], [], [], [0], [], [], 0

    def add(self, doc_id: int | None, text: str, use: int) -> None:
        found = text.lower().encode("utf-8", "replace").split()
        numbers, counts = np.unique(np.fromiter(map(self.words.__getitem__, found), np.int64, len(found)), return_counts=True)
        self.ids.append(doc_id or 0)
        self.known.append(doc_id is not None)
        self.use.append(use)
        self.ends.append(self.ends[-1] + len(numbers))
        self.index.append(numbers.astype(np.int32))
        self.counts.append(counts.astype(np.uint32))
        self.total += len(found)

    def rows(self, block: int) -> pa.RecordBatch:
        index, counts, ends = np.concatenate(self.index), np.concatenate(self.counts), np.array(self.ends, np.int64)
        use = np.repeat(np.array(self.use), np.diff(ends))
        runs, of, word_ends, order = layout([w.decode() for w in self.words])
        totals = []
        for kind in (TRUSTED, TOXIC):
            times = np.bincount(index[use == kind], counts[use == kind], len(self.words))
            totals.append(np.bincount(of, np.repeat(times, np.diff(np.append(0, word_ends))), len(runs)).astype(np.uint32))
        names, first = np.unique((runs >> np.uint64(BITS) & np.uint64(MASK))[order], return_index=True)
        last = np.append(first, len(runs))[1:]
        pair = runs & np.uint64((1 << 2 * BITS) - 1)
        seen = [np.unique(pair[t > 0]) for t in totals]
        steps = np.concatenate([np.diff(x, prepend=0) for x in self.index])
        text = np.frombuffer(b"\n".join(self.words), np.uint8)
        out = [(DOCS, pack(np.array(self.ids, np.int64), np.array(self.known, np.uint8), np.array(self.use, np.uint8), ends, text, *planes(steps.astype(np.uint32)), *planes(counts))), (PAIRS, pack(*seen))]
        out += [(int(n), pack(*(c[order[a:b]] for c in (runs, *totals)))) for n, a, b in zip(names, first, last, strict=True)]
        return pa.record_batch([pa.array([block] * len(out), pa.int64()), pa.array([self.lang] * len(out)), pa.array([p for p, _ in out], pa.int32()), pa.array([c for _, c in out], pa.binary())], names=["block", "lang", "part", "content"])


@trimmed
def read_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    number, open_blocks = TaskContext.get().partitionId() << 32, {}
    for doc_id, text, lang, use in each(batches, "doc_id", "text", "lang", "use"):
        block = open_blocks.setdefault(lang, None) or Block(lang)
        open_blocks[lang] = block
        block.add(doc_id, text, use)
        if len(block.words) >= WORDS or block.total >= RUNNING:
            yield open_blocks.pop(lang).rows(number)
            number += 1
    for block in open_blocks.values():
        yield block.rows(number)
        number += 1


def pair_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for lang, content in each(batches, "lang", "content"):
        for model, seen in enumerate(unpack(content)):
            yield pa.record_batch([pa.array([lang] * len(seen), pa.string()), pa.array([model] * len(seen), pa.int32()), pa.array(seen.astype(np.int64))], names=["lang", "model", "pair"])


def discounts(counts: np.ndarray) -> np.ndarray:
    """The modified discounts of counts 0, 1, 2 and 3 or more, from how many runs have 1, 2, 3 and 4."""
    n = np.maximum(np.bincount(np.minimum(counts, 5).astype(np.int64), minlength=6)[1:5], 0.5)
    y = n[0] / (n[0] + 2 * n[1])
    return np.array([0.0, *(np.clip(k - (k + 1) * y * n[k] / n[k - 1], 0.1, k) for k in (1, 2, 3))])


def chances(runs: np.ndarray, counts: np.ndarray, base: np.ndarray) -> np.ndarray:
    """The interpolated chance of the last character of each run; base: that of each character without a context."""
    levels = [(runs, counts.astype(np.int64), None)]
    for k in range(ORDER - 1, 1, -1):
        above, above_counts, _ = levels[-1]
        found, of = np.unique(above & np.uint64((1 << BITS * k) - 1), return_inverse=True)
        levels.append((found, np.bincount(of[above_counts > 0], minlength=len(found)), of))
    p = base[(levels[-1][0] & np.uint64(MASK)).astype(np.int64)]
    for k in range(len(levels) - 1, -1, -1):
        keys, times, _ = levels[k]
        _, context = np.unique(keys >> np.uint64(BITS), return_inverse=True)
        off = discounts(times)
        total = np.bincount(context, times)[context]
        held = np.bincount(context, off[np.minimum(times, 3)])[context]
        known = total > 0
        p = np.where(known, (np.maximum(times - off[np.minimum(times, 3)], 0) + held * p) / np.maximum(total, 1), p)
        if k:
            p = p[levels[k][2]]
    return p


def judge(bases: dict[tuple[str, int], dict[int, int]]):
    """An applyInArrow function from a shard's rows to the bits of its runs under both models, block by block."""

    def base_of(lang: str, model: int) -> np.ndarray:
        counts = np.zeros(MASK + 1)
        for character, n in bases.get((lang, model), {}).items():
            counts[character] = n
        return (counts + 0.5) / (counts.sum() + 0.5 * len(counts))

    @trimmed_group
    def run(table: pa.Table) -> pa.Table:
        parts = [unpack(x) for x in table.column("content").to_pylist()]
        found, of = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
        lang = table.column("lang")[0].as_py()
        bits = []
        for model in (0, 1):
            counts = np.bincount(of, np.concatenate([p[1 + model] for p in parts]), len(found))
            bits.append(-np.log2(chances(found, counts, base_of(lang, model)))[of].astype(np.float32))
        ends = np.cumsum([len(p[0]) for p in parts])
        out = [pack(*(b[end - len(p[0]) : end] for b in bits)) for p, end in zip(parts, ends, strict=True)]
        return pa.table({"block": table.column("block"), "part": table.column("part"), "content": pa.array(out, pa.binary())})

    return run


@trimmed
def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From (lang, content, answers) of blocks to a row for each document."""
    for lang, content, answers in each(batches, "lang", "content", "answers"):
        ids, known, use, ends, text, *rest = unpack(content)
        steps, counts = whole(rest[:4]), whole(rest[4:]).astype(np.float64)
        run_up = np.concatenate([[0], np.cumsum(steps)])
        index = run_up[1:] - np.repeat(run_up[ends[:-1]], np.diff(ends))
        words = text.tobytes().decode().split("\n") if ends[-1] else []
        _, of, word_ends, order = layout(words)
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        runs = place[of]
        parts = [unpack(x["content"]) for x in sorted(answers or [], key=lambda x: x["part"])]
        bits = []
        for model in (0, 1):
            total = np.concatenate([[0.0], np.cumsum(np.concatenate([np.zeros(0, np.float32), *(p[model] for p in parts)])[runs], dtype=np.float64)])
            bits.append(np.diff(total[np.append(0, word_ends)]))
        sizes = np.diff(np.append(0, word_ends))
        sums = [np.concatenate([[0.0], np.cumsum(x)]) for x in (bits[0][index] * counts, sizes[index] * counts)]
        spent, length = (s[ends[1:]] - s[ends[:-1]] for s in sums)
        full = ends[1:] > ends[:-1]
        peak = np.zeros(len(ids))
        if full.any():
            peak[full] = np.maximum.reduceat((bits[0] - bits[1])[index], ends[:-1][full])
        perplexity = np.round(2.0 ** np.divide(spent, length, out=np.zeros(len(ids)), where=full), 4)
        yield pa.record_batch([pa.array(ids, mask=known == 0), pa.array([lang] * len(ids)), pa.array(use.astype(np.int32)), pa.array(perplexity, mask=~full), pa.array(np.round(peak, 3), mask=~full)], names=["doc_id", "lang", "use", "perplexity", "peak"])


def classify(spark: SparkSession, docs: DataFrame, labels: DataFrame, quantile: float = 0.995, held_out: int = 3) -> DataFrame:
    """doc_id, lang, perplexity, most_perplexity, peak, most_peak, kept of every row of docs (doc_id, text, lang).

    labels: doc_id, quality, toxic. One in held_out of the labelled documents, by hash, sets thresholds instead of training.
    """
    work = Workspace(spark, "quality")
    known = labels.where("doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max("quality").alias("quality"), F.max("toxic").alias("toxic"))
    known = work.table(known, "labels")
    known = F.broadcast(known) if known.count() <= LABELS else known
    out = F.pmod(F.xxhash64(F.lit("held out"), "doc_id"), F.lit(held_out)) == 0
    trusted = (F.col("quality") == 1) & (F.col("toxic") == 0)
    use = F.when(trusted & out, HELD_OUT).when(trusted, TRUSTED).when((F.col("toxic") == 1) & ~out, TOXIC).otherwise(NOTHING)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"), F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"))
    rows = rows.join(known, "doc_id", "left").select("doc_id", "text", "lang", use.alias("use"))
    blocks = work.table(rows.mapInArrow(read_blocks, BLOCKS), "blocks")
    pairs = blocks.where(f"part = {PAIRS}").select("lang", "content").mapInArrow(pair_rows, "lang string, model int, pair long").distinct()
    bases: dict[tuple[str, int], dict[int, int]] = {}
    for row in pairs.groupBy("lang", "model", F.col("pair").bitwiseAND(F.lit(MASK)).alias("character")).count().collect():
        bases.setdefault((row["lang"], row["model"]), {})[row["character"]] = row["count"]
    answers = blocks.where("part >= 0").groupBy("lang", "part").applyInArrow(judge(bases), "block long, part int, content binary").groupBy("block").agg(F.collect_list(F.struct("part", "content")).alias("answers"))
    bodies = blocks.where(f"part = {DOCS}").select("block", "lang", "content")
    scores = work.table(bodies.join(answers, "block", "left").select("lang", "content", "answers").mapInArrow(score, SCORES), "scores")
    limits = work.table(limits_of(scores.where(f"use = {HELD_OUT}").select("lang", "perplexity", "peak"), quantile), "limits")
    limits = F.broadcast(limits) if limits.count() <= LABELS else limits
    above = F.coalesce((F.col("perplexity") > F.col("most_perplexity")) | (F.col("peak") > F.col("most_peak")), F.lit(False))
    return scores.join(limits, "lang", "left").select("doc_id", "lang", "perplexity", "most_perplexity", "peak", "most_peak", (~above).alias("kept"))


def limits_of(held: DataFrame, quantile: float) -> DataFrame:
    """lang, most_perplexity and most_peak of held-out trusted documents (lang, perplexity, peak).

    A language with ENOUGH of them has its own quantiles. In one with fewer a single wrong label would be the quantile, so there
    the limit is the language's median and as many of its median deviations as the same quantile of all languages together.
    """
    names = ("perplexity", "peak")
    near = lambda c, q: F.percentile_approx(c, q, 100_000)
    own = held.groupBy("lang").agg(F.count("*").alias("n"), *(near(x, quantile).alias(f"own_{x}") for x in names), *(near(x, 0.5).alias(f"mid_{x}") for x in names))
    few = held.select("lang").distinct().count() <= LABELS
    small = F.broadcast if few else (lambda rows: rows)
    off = held.join(small(own), "lang")
    spread = off.groupBy("lang").agg(*(F.greatest(near(F.abs(F.col(x) - F.col(f"mid_{x}")), 0.5), F.lit(1e-3)).alias(f"dev_{x}") for x in names))
    pooled = off.join(small(spread), "lang").agg(*(near((F.col(x) - F.col(f"mid_{x}")) / F.col(f"dev_{x}"), quantile).alias(f"far_{x}") for x in names)).first()
    limit = lambda x: F.when(F.col("n") >= ENOUGH, F.col(f"own_{x}")).otherwise(F.col(f"mid_{x}") + F.lit(pooled[f"far_{x}"]).cast("double") * F.col(f"dev_{x}"))
    return own.join(spread, "lang").select("lang", *(limit(x).alias(f"most_{x}") for x in names))
