"""Substring dedup with prefix-partitioned suffix trees.

The suffixes that start a run are cut off at `length` words. Groups of seeds (see repeats) are memory-sized and hold all suffixes that
can share `length` words. Within a group, suffixes are counted by their first word; first words with few suffixes share a subtree, one with
more than a subtree's worth is split by the second word, and so on, so prefixes have the length that their suffixes need.
A subtree's suffixes are sorted by their words. The common prefixes of neighbours give its internal nodes, as the widest intervals of
leaves that share so many words; leaves under the nodes of full depth are repeated runs, and neighbouring starts among these make up a
maximal repeat. Every word that one covers is removed, judged on the input.

Cases: a null text has no words; texts of fewer words than a run lose nothing; repeated rows are copies of each other
and lose all words if they have a run; a word that repeats itself for longer than a run is removed; an empty table gives no
rows; a null doc_id stays null; different texts under one doc_id are each judged; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame, SparkSession

from quire.llm.repeats import HOT, bits, find_repeats, reach

#: Suffixes of a subtree, and bytes of a word.
LEAVES, WORD = 50_000, 5


def subtrees(words: np.ndarray, row: np.ndarray, start: np.ndarray, length: int, most: int) -> Iterator[np.ndarray]:
    """Cuts suffixes (their row in words and start in the row) into groups by prefixes of variable length: at most so many in a group, or all equal."""
    waiting = [(np.arange(len(row)), 0)]
    while waiting:
        held, depth = waiting.pop()
        if len(held) <= most or depth == length:
            yield held
            continue
        word = words[row[held], start[held] + depth]
        order = np.argsort(word, kind="stable")
        held, word = held[order], word[order]
        first = np.flatnonzero(np.append(True, word[1:] != word[:-1]))
        ends = np.append(first[1:], len(held))
        at = 0
        while at < len(first):
            upto = int(np.searchsorted(ends, first[at] + most, "right"))
            if upto > at:
                yield held[first[at] : ends[upto - 1]]
            else:
                upto = at + 1
                waiting.append((held[first[at] : ends[at]], depth + 1))
            at = upto


def common_prefixes(keys: np.ndarray) -> np.ndarray:
    """How many words each sorted suffix shares with the one before it; 0 for the first."""
    raw = keys.view(np.uint8).reshape(len(keys), -1)
    differ = raw[1:] != raw[:-1]
    shared = np.where(differ.any(axis=1), differ.argmax(axis=1), raw.shape[1]) // WORD
    return np.append(0, shared)


def internal_nodes(shared: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """First leaf and end of the subtree's internal nodes of at least this depth that lie under no other such node."""
    deep = np.append(shared >= depth, False)
    opens, closes = np.flatnonzero(~deep[:-1] & deep[1:]), np.flatnonzero(deep[:-1] & ~deep[1:])
    return opens, closes + 1


def judge(length: int, most: int = LEAVES):
    before, _ = reach(length)

    def run(words: np.ndarray, low: np.ndarray, high: np.ndarray, twice: np.ndarray) -> np.ndarray:
        counts = high.astype(np.int64) - low + 1
        row = np.repeat(np.arange(len(words)), counts)
        back = np.arange(len(row)) - np.repeat(np.cumsum(counts) - counts, counts) + low[row]
        found = np.where(twice > 0, bits(low, high), np.uint64(0))
        flat = np.ascontiguousarray(words.astype(">u8").view(np.uint8).reshape(len(words), -1, 8)[:, :, 8 - WORD :]).reshape(-1)
        if not len(row):
            return found
        suffixes = np.ndarray((len(flat) - length * WORD + 1,), f"S{length * WORD}", flat, strides=(1,))
        for held in subtrees(words, row, before - back, length, most):
            keys = suffixes[(row[held] * words.shape[1] + before - back[held]) * WORD]
            order = np.argsort(keys, kind="stable")
            first, end = internal_nodes(common_prefixes(keys[order]), length)
            edge = np.zeros(len(held) + 1, np.int64)
            edge[first] += 1
            edge[end] -= 1
            leaves = held[order[np.cumsum(edge[:-1]) > 0]]
            np.bitwise_or.at(found, row[leaves], np.uint64(1) << back[leaves].astype(np.uint64))
        return found

    return run


def remove_repeats(spark: SparkSession, docs: DataFrame, length: int = 35, hot: int = HOT) -> DataFrame:
    """doc_id, n_words, n_removed, n_spans, kept_sha256 of every row of docs (doc_id, text)."""
    return find_repeats(spark, docs, "substring-dedup", length, judge(length), hot)


def oracle(length: int) -> str:
    return rf"""WITH d AS MATERIALIZED (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
r AS MATERIALIZED (SELECT doc_id, p, array_to_string(list_slice(w, p + 1, p + {length}), ' ') AS s FROM (SELECT doc_id, w, unnest(range(len(w) - {length - 1})) AS p FROM d WHERE len(w) >= {length})),
x AS (SELECT s FROM r GROUP BY s HAVING count(*) > 1),
g AS MATERIALIZED (SELECT DISTINCT doc_id, q FROM (SELECT doc_id, unnest(range(p, p + {length})) AS q FROM r JOIN x USING (s))),
k AS (SELECT doc_id, string_agg(t, ' ' ORDER BY p) AS kept FROM (SELECT doc_id, unnest(w) AS t, unnest(range(len(w))) AS p FROM d) u WHERE NOT EXISTS (SELECT 1 FROM g WHERE g.doc_id = u.doc_id AND g.q = u.p) GROUP BY doc_id),
c AS (SELECT doc_id, count(*) AS n FROM g GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n, 0) AS BIGINT) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256 FROM d LEFT JOIN c USING (doc_id) LEFT JOIN k USING (doc_id)"""
