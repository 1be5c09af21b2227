"""Suffix-array dedup with sparse suffix arrays.

Only the suffixes at minimiser positions are retained, about one in twenty. A group's suffixes are sorted by their words, and each is compared with its
neighbours: the common prefixes of neighbours tell which suffixes share how many words to the right. Wherever suffixes share
some number of words and no other suffix shares as many with them, these are sorted once more, by the words to their left read
backwards, and compared with their neighbours there. So every match is extended to the right and the left, and the run that starts a words
before a suffix is repeated if some other suffix shares `length - a` words to the right and a words to the left with it. As every
run has a minimiser, this finds all repeats of at least `length` words, just as a full array would.

Cases: a null text has no words; texts of fewer words than a run lose nothing; repeated rows are copies of each other
and lose all words if they have a run; an empty table gives no rows; a null doc_id stays null; different texts under one doc_id are
each judged; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession

from quire.llm.repeats import GRAM, HOT, bits, find_repeats, reach

#: Rows that are compared at once.
STEP = 1 << 14


def ranked(words: np.ndarray) -> np.ndarray:
    """The order of the rows by their words."""
    width = 5 * words.shape[1]
    raw = np.ascontiguousarray(words.astype(">u8").view(np.uint8).reshape(len(words), -1, 8)[:, :, 3:])
    return np.argsort(raw.reshape(len(words), width).view(f"S{width}").reshape(-1), kind="stable")


def shared_words(words: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """How many words each of these rows shares from the start with the one before it; 0 for the first. A 0 is no word."""
    out = np.zeros(len(rows), np.int64)
    for at in range(1, len(rows), STEP):
        one, other = words[rows[at : at + STEP]], words[rows[at - 1 : at - 1 + len(rows[at : at + STEP])]]
        differ = (one != other) | (one == 0)
        out[at : at + STEP] = np.where(differ.any(axis=1), differ.argmax(axis=1), words.shape[1])
    return out


def judge(length: int):
    before, _ = reach(length)

    def run(words: np.ndarray, low: np.ndarray, high: np.ndarray, twice: np.ndarray) -> np.ndarray:
        found = np.where(twice > 0, bits(low, high), np.uint64(0))
        if not len(words):
            return found
        right, left = words[:, before:], np.ascontiguousarray(words[:, :before][:, ::-1])
        array = ranked(right)
        shared = shared_words(right, array)
        place = np.empty(len(words), np.int64)
        if before:
            place[ranked(left)] = np.arange(len(words))
        for depth in np.unique(shared[shared >= GRAM])[::-1].tolist():
            part = np.cumsum(shared < depth)  # suffixes that share so many words stand next to each other
            grown = np.bincount(part, shared == depth)[part] > 0
            rows, part = array[grown], part[grown]
            order = np.lexsort((place[rows], part)) if before else np.arange(len(rows))
            rows, part = rows[order], part[order]
            behind = shared_words(left, rows) if before else np.zeros(len(rows), np.int64)
            behind[np.append(True, part[1:] != part[:-1])] = -1
            most = np.maximum(behind, np.append(behind[1:], -1))
            found[rows] |= bits(np.full(len(rows), length - depth), np.minimum(most, before))
        return found

    return run


def remove_matches(spark: SparkSession, docs: DataFrame, length: int = 50, hot: int = HOT) -> DataFrame:
    """doc_id, n_words, n_removed, n_spans, kept_sha256 of every row of docs (doc_id, text)."""
    return find_repeats(spark, docs, "suffix-dedup", length, judge(length), hot)
