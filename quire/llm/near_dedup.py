"""MinHash near-dedup: SuperMinHash signatures, banding, verification on full shingle sets, union-find groups.

Documents of equal shingle sets form a class, and one text stands for it, whatever its doc_id; only these go on. Signatures of 128 parts in 32
bands of 4 miss a pair of similarity 0.75 with probability 5e-6. A bucket first links its members to its hub, each pair
being verified on both full sets. Then only buckets that still hold several components are looked at again: their members
outside the largest component meet all members, block by block. A task tests pairs of different components by falling
agreement of their signatures, on the full sets, and joins what it links at once, so it returns a spanning set of links and
a group of copies costs about as many tests as it has members. A pair is tested in the first band whose full hash it shares, and only
if its sizes allow a link and the estimate is at least 0.53, nearly six standard errors below 0.75.

Cases: null and empty texts have empty sets and are kept and linked with nothing; fewer words than a shingle make one shingle;
ties go to the least doc_id; repeated rows give one result row each; different texts under one doc_id are searched each for
itself, and share a component_id only by name; an empty table gives no rows; a null doc_id is below all others; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.llm.common import Workspace, safe_id, shown_id, trimmed
from quire.llm.components import components, follow
from quire.llm.hashing import WordHashes, band_hashes, shingles, super_min_hash

SIZE, ROWS = 128, 4
SIGNED = "doc_id long, text_id binary, n_shingles long, class binary, bands array<long>, marks binary"
#: Elements whose signatures are made at once, and members of a bucket in a block.
AT_ONCE, BLOCK = 200_000, 1024
#: Signature parts that have to agree before a pair of an open bucket is tested.
LEAST = round(0.53 * SIZE)
#: Ids up to which a side is broadcast.
IDS = 1_000_000


def text_id() -> Column:
    """Tells the texts of one doc_id apart."""
    return F.unhex(F.md5(F.col("text").cast("string").cast("binary"))).alias("text_id")


def sets_of(hashes: WordHashes, texts: list[bytes | None], words: int) -> list[np.ndarray]:
    return [shingles(hashes.of((t or b"").lower().split()), words) for t in texts]


def sign(words: int):
    """A mapInArrow function from (doc_id, text_id, text) to SIGNED rows."""

    @trimmed
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in batches:
            ids, text_ids, texts = batch.column(0), batch.column(1), pc.cast(batch.column(2), pa.binary())
            at = 0
            while at < batch.num_rows:
                sets, held, start = [], 0, at
                while at < batch.num_rows and held < AT_ONCE:
                    sets += sets_of(hashes, [texts[at].as_py()], words)
                    held += len(sets[-1])
                    at += 1
                signatures = super_min_hash(sets, SIZE)
                bands = band_hashes(signatures, ROWS).astype(np.int64)
                marks = signatures.astype(np.uint8)
                empty = np.array([not len(s) for s in sets])
                lists = pa.ListArray.from_arrays(pa.array(np.arange(len(sets) + 1, dtype=np.int32) * bands.shape[1]), pa.array(bands.reshape(-1)))
                yield pa.record_batch([ids.slice(start, at - start), text_ids.slice(start, at - start), pa.array([len(s) for s in sets], pa.int64()), pa.array([xxhash.xxh3_128_digest(s.tobytes()) for s in sets], pa.binary(), mask=empty), lists, pa.array([m.tobytes() for m in marks], pa.binary())], names=["doc_id", "text_id", "n_shingles", "class", "bands", "marks"])

    return run


def verify(words: int, percent: int):
    """A mapInArrow function from (a, b, text_a, text_b) to (a, b, linked)."""

    @trimmed
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, known = WordHashes(), {}

        def set_of(doc_id: int, text: str) -> np.ndarray:
            if doc_id not in known:
                if len(known) >= 64:
                    known.clear()
                known[doc_id] = sets_of(hashes, [text.encode()], words)[0]
            return known[doc_id]

        for batch in batches:
            linked = []
            for a, b, text_a, text_b in zip(*(batch.column(k).to_pylist() for k in range(4)), strict=True):
                first, second = set_of(a, text_a), set_of(b, text_b)
                shared = common(first, second)
                linked.append(100 * shared >= percent * (len(first) + len(second) - shared))
            yield pa.record_batch([batch.column(0), batch.column(1), pa.array(linked, pa.bool_())], names=["a", "b", "linked"])

    return run


def common(first: np.ndarray, second: np.ndarray) -> int:
    if not len(first):
        return 0
    at = first.searchsorted(second)
    at[at == len(first)] = 0
    return int((first[at] == second).sum())


def link_block(words: int, percent: int):
    """An applyInArrow function: links of different components between the two sides of a bucket's blocks, as few as join them."""

    def run(table: pa.Table) -> pa.Table:
        hashes, sets = WordHashes(), {}
        ids, roots, sides, bands, sizes = (table.column(k).to_numpy() for k in ("rep", "root", "side", "band", "n_shingles"))
        texts = table.column("text")
        marks = np.frombuffer(b"".join(table.column("marks").to_pylist()), np.uint8).reshape(-1, SIZE)
        hashes_of = np.array(table.column("bands").to_pylist(), np.int64).reshape(-1, SIZE // ROWS)
        parent: dict[int, int] = {}

        def find(x: int) -> int:
            while parent.get(x, x) != x:
                parent[x] = parent.get(parent[x], parent[x])
                x = parent[x]
            return x

        def set_of(k: int) -> np.ndarray:
            if ids[k] not in sets:
                sets[ids[k]] = sets_of(hashes, [texts[int(k)].as_py().encode()], words)[0]
            return sets[ids[k]]

        first, second = np.flatnonzero(sides == 1), np.flatnonzero(sides == 2)
        candidates, weights = [], []
        for k in first:
            agree = (marks[second] == marks[k]).sum(axis=1)
            agree[(roots[second] == roots[k]) | (100 * np.minimum(sizes[second], sizes[k]) < percent * np.maximum(sizes[second], sizes[k]))] = 0
            near = np.flatnonzero(agree >= LEAST)
            near = near[(hashes_of[second[near]] == hashes_of[k]).argmax(axis=1) == bands[k]]
            candidates.append(np.stack([np.full(len(near), k), second[near]], axis=1))
            weights.append(agree[near])
        pairs = np.concatenate([np.zeros((0, 2), np.int64), *candidates])
        links = []
        for x, y in pairs[np.argsort(-np.concatenate([np.zeros(0, np.int64), *weights]), kind="stable")]:
            a, b = find(int(roots[x])), find(int(roots[y]))
            if a == b:
                continue
            shared = common(set_of(x), set_of(y))
            if 100 * shared >= percent * (len(set_of(x)) + len(set_of(y)) - shared):
                parent[max(a, b)] = min(a, b)
                links.append((int(ids[x]), int(ids[y])))
        return pa.table({"a": pa.array([x for x, _ in links], pa.int64()), "b": pa.array([y for _, y in links], pa.int64())})

    return run


class NearGroups:
    """The stages of near-dedup over docs (doc_id, text); result() has a row for each document."""

    def __init__(self, spark: SparkSession, docs: DataFrame, words: int = 5, percent: int = 75):
        self.work = Workspace(spark, "near-dedup")
        self.words, self.percent = words, percent
        text = docs.select(safe_id(), text_id(), F.col("text").cast("string").alias("text"))
        self.signed = self.work.table(text.mapInArrow(sign(words), SIGNED), "signed")
        firsts = self.signed.where("class is not null").groupBy("class").agg(F.min(F.struct("doc_id", "text_id")).alias("first"))
        self.classes = self.work.table(firsts.select("class", "first.*", F.monotonically_increasing_id().alias("rep")), "classes")
        heads = self.signed.join(self.classes, ["class", "doc_id", "text_id"]).select("rep", "n_shingles", "bands", "marks").dropDuplicates(["rep"])
        heads = self.work.table(heads, "heads")
        spread = heads.select("rep", F.posexplode("bands").alias("band", "bucket"))
        shared = spread.groupBy("bucket").agg(F.count("*").alias("n"), F.min("rep").alias("hub")).where("n > 1")
        self.members = self.work.table(spread.join(shared, "bucket").select("bucket", "band", "hub", "rep"), "members")
        reps = self.work.table(self.members.select("rep").distinct().join(self.classes, "rep").select("rep", "doc_id", "text_id"), "reps")
        known = F.broadcast(reps) if reps.count() <= IDS else reps
        texts = text.join(known, ["doc_id", "text_id"]).groupBy("rep").agg(F.min("text").alias("text"))
        self.texts = self.work.table(texts.join(heads, "rep"), "texts")
        self.roots = self._resolve()

    def _resolve(self) -> DataFrame:
        texts = [self.texts.select(F.col("rep").alias(x), F.col("text").alias(f"text_{x}")) for x in ("a", "b")]
        hubs = self.members.where("rep <> hub").select(F.col("hub").alias("a"), F.col("rep").alias("b")).distinct()
        hubs = hubs.join(texts[0], "a").join(texts[1], "b").select("a", "b", "text_a", "text_b")
        links = hubs.mapInArrow(verify(self.words, self.percent), "a long, b long, linked boolean").where("linked")
        roots = components(self.work, "hubs", links.select("a", "b"))
        links = self.work.table(self._open_links(roots), "links")
        ends = [roots.select(F.col("node").alias(x), F.col("root").alias(f"root_{x}")) for x in ("a", "b")]
        moved = links.join(ends[0], "a", "left").join(ends[1], "b", "left")
        step = components(self.work, "open", moved.select(F.coalesce("root_a", "a").alias("a"), F.coalesce("root_b", "b").alias("b")))
        return self.work.table(follow(roots, step).unionByName(step.join(roots.select("node"), "node", "left_anti").select("node", "root")), "roots")

    def _open_links(self, roots: DataFrame) -> DataFrame:
        """Links that join components within buckets of several components."""
        members = self.members.select("bucket", "band", "rep").join(roots.withColumnRenamed("node", "rep"), "rep", "left").select("bucket", "band", "rep", F.coalesce("root", "rep").alias("root"))
        parts = members.groupBy("bucket", "root").agg(F.count("*").alias("n"))
        most = parts.groupBy("bucket").agg(F.count("*").alias("parts"), F.sum("n").alias("n"), F.max(F.struct("n", "root")).alias("home")).where("parts > 1")
        blocks = most.select("bucket", F.col("home.root").alias("home"), F.ceil(F.col("n") / BLOCK).cast("int").alias("all_blocks"), F.ceil((F.col("n") - F.col("home.n")) / BLOCK).cast("int").alias("own_blocks"))
        rows = members.join(blocks, "bucket")
        place = F.pmod(F.xxhash64("rep"), F.lit(1 << 30))
        own, other = (place % F.col("own_blocks")).cast("int"), (place % F.col("all_blocks")).cast("int")
        upto = lambda n: F.sequence(F.lit(0), F.col(n) - 1)
        as_first = F.transform(F.when(F.col("root") != F.col("home"), upto("all_blocks")).otherwise(F.array().cast("array<int>")), lambda k: F.struct(F.lit(1).alias("side"), own.alias("low"), k.alias("high")))
        as_second = F.transform(upto("own_blocks"), lambda k: F.struct(F.lit(2).alias("side"), k.alias("low"), other.alias("high")))
        rows = rows.select("bucket", "band", "rep", "root", F.explode(F.concat(as_first, as_second)).alias("at")).select("bucket", "band", "rep", "root", "at.*")
        return rows.join(self.texts, "rep").groupBy("bucket", "low", "high").applyInArrow(link_block(self.words, self.percent), "a long, b long").distinct()

    def _rooted(self) -> DataFrame:
        return self.classes.join(self.roots.withColumnRenamed("node", "rep"), "rep", "left").withColumn("root", F.coalesce("root", "rep"))

    def heads(self) -> DataFrame:
        """doc_id (NULL_ID for null), text_id and repeated (whether several rows have both) of the first text of each group."""
        firsts = self._rooted().groupBy("root").agg(F.min(F.struct("doc_id", "text_id")).alias("first")).select("first.*")
        repeats = self.signed.groupBy("doc_id", "text_id").agg(F.count("*").alias("n")).where("n > 1")
        return firsts.join(repeats, ["doc_id", "text_id"], "left").select("doc_id", "text_id", F.col("n").isNotNull().alias("repeated"))

    def result(self) -> DataFrame:
        """doc_id, n_shingles, component_id, kept."""
        classes = self._rooted()
        named = classes.groupBy("root").agg(F.min("doc_id").alias("component_id"))
        classes = classes.select("class", "root").join(named, "root").select("class", "component_id")
        rows = self.signed.select("doc_id", "n_shingles", "class").join(classes, "class", "left").select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"))
        return rows.select(shown_id(), "n_shingles", shown_id("component_id"), (F.col("doc_id") == F.col("component_id")).alias("kept"))


def near_groups(spark: SparkSession, docs: DataFrame, words: int = 5, percent: int = 75) -> DataFrame:
    return NearGroups(spark, docs, words, percent).result()


ORACLE = r"""WITH RECURSIVE d AS MATERIALIZED (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS MATERIALIZED (SELECT DISTINCT doc_id, array_to_string(list_slice(w, p + 1, p + 5), ' ') AS s FROM (SELECT doc_id, w, unnest(range(greatest(len(w) - 4, 1))) AS p FROM d WHERE len(w) > 0)),
n AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
c AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY ALL),
l AS MATERIALIZED (SELECT a, b FROM c JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 75 * (x.n + y.n - c)),
e AS MATERIALIZED (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
r AS (SELECT doc_id AS a, doc_id AS b FROM d UNION SELECT r.a, e.b FROM r JOIN e ON r.b = e.a)
SELECT d.doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_shingles, component_id, component_id = d.doc_id AS kept FROM d LEFT JOIN n USING (doc_id) JOIN (SELECT a AS doc_id, min(b) AS component_id FROM r GROUP BY a) USING (doc_id)"""
