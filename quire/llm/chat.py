"""Chat formatting with a grammar round trip.

A turn is rendered as <|turn|> role <|text|> text <|end|>. A deterministic parser reads the rendered string back; where the
recovered turn is not the source, the text's control strings are escaped once more, until it is. Escaping puts U+241B
after the first character of each control string, or after those already there; parsing takes one of them away
wherever at least one stands, so every text survives. The loss mask is the list of code point ranges of assistant texts.

Conversations are dealt by conv_id, sorted, and read as a stream: a conversation becomes one or more segments of whole
turns of about a megabyte, and digests run over segments, so no conversation has to fit into memory at once.

Cases: null texts and null roles are empty; null turns come first; rows of equal turn are ordered by role, then text;
repeated rows are repeated turns; a null conv_id is a conversation of its own; an empty table gives no rows but those
added; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

ESCAPE = "␛"
#: Control strings of this template and of common others; texts keep them only in escaped form.
CONTROLS = ("<|turn|>", "<|text|>", "<|end|>", "<|endoftext|>", "<|startoftext|>", "<|im_start|>", "<|im_end|>", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>")
_tails = {first: "|".join(re.escape(c[1:]) for c in CONTROLS if c[0] == first) for first in sorted({c[0] for c in CONTROLS})}
_to_escape = re.compile("|".join(f"{re.escape(first)}(?={ESCAPE}*(?:{tails}))" for first, tails in _tails.items()))
_to_restore = re.compile("|".join(f"{re.escape(first)}{ESCAPE}(?={ESCAPE}*(?:{tails}))" for first, tails in _tails.items()))
_turn = re.compile(r"<\|turn\|>(.*?)<\|text\|>(.*?)<\|end\|>", re.S)
SEGMENT = 1 << 20
FORMATTED = "conv_id long, part int, n_turns int, formatted string, loss array<struct<start:int,stop:int>>"
DIGEST = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"


def escaped(text: str) -> str:
    return _to_escape.sub(lambda m: m[0] + ESCAPE, text)


def restored(text: str) -> str:
    return _to_restore.sub(lambda m: m[0][0], text)


def parse(formatted: str) -> list[tuple[str, str]]:
    """The turns of a formatted string; anything outside the grammar is an error."""
    out, at = [], 0
    while at < len(formatted):
        found = _turn.match(formatted, at)
        if not found:
            raise ValueError(f"no turn at {at}")
        out.append((restored(found[1]), restored(found[2])))
        at = found.end()
    return out


def render(role: str, text: str, most: int = 8) -> tuple[str, int, int]:
    """The rendered turn that parses back to exactly this turn, and the range of its text."""
    shown_role, shown = role, text
    for _ in range(most):
        out = f"<|turn|>{shown_role}<|text|>{shown}<|end|>"
        if not any(c in shown_role or c in shown for c in CONTROLS):
            try:
                if parse(out) == [(role, text)]:
                    start = len("<|turn|>") + len(shown_role) + len("<|text|>")
                    return out, start, start + len(shown)
            except ValueError:
                pass
        shown_role, shown = escaped(shown_role), escaped(shown)
    raise ValueError("no escaping of this turn parses back")


def format_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From rows sorted by conversation and turn to segments."""
    schema = pa.schema([("conv_id", pa.int64()), ("part", pa.int32()), ("n_turns", pa.int32()), ("formatted", pa.string()), ("loss", pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32())])))])
    now, part, turns, texts, loss, size, ready, weight = None, 0, 0, [], [], 0, [], 0

    def segment() -> dict:
        return {"conv_id": now[0], "part": part, "n_turns": turns, "formatted": "".join(texts), "loss": loss}

    for batch in batches:
        for conv_id, role, text in zip(*(batch.column(k).to_pylist() for k in range(3)), strict=True):
            same = now is not None and now[0] == conv_id
            if turns and (not same or size >= SEGMENT):
                ready.append(segment())
                weight += size
                part, turns, texts, loss, size = (part + 1 if same else 0), 0, [], [], 0
            now = (conv_id,)
            out, start, stop = render(role or "", text or "")
            if role == "assistant":
                loss.append({"start": size + start, "stop": size + stop})
            texts.append(out)
            turns, size = turns + 1, size + len(out)
            if weight >= 4 * SEGMENT:
                yield pa.RecordBatch.from_pylist(ready, schema=schema)
                ready, weight = [], 0
    if turns:
        ready.append(segment())
    if ready:
        yield pa.RecordBatch.from_pylist(ready, schema=schema)


def digest_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From segments in order to a row for each conversation, by parsing what was formatted."""
    names = [x.split()[0] for x in DIGEST.split(", ")]
    kinds = (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64())
    now, rows = None, []

    def close() -> None:
        if now is not None:
            conv_id, turns, all_turns, chars, all_loss, size = now
            rows.append((conv_id, turns, all_turns.hexdigest(), chars, all_loss.hexdigest(), size))

    def out() -> pa.RecordBatch:
        return pa.record_batch([pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds)], names=names)

    for batch in batches:
        for conv_id, part, formatted, loss in zip(*(batch.column(k).to_pylist() for k in ("conv_id", "part", "formatted", "loss")), strict=True):
            if part == 0:
                close()
                now = [conv_id, 0, hashlib.sha256(), 0, hashlib.sha256(), 0]
            for role, text in parse(formatted):
                now[1] += 1
                now[2].update(f"{role}\n{text}\n".encode())
            for span in loss:
                text = restored(formatted[span["start"] : span["stop"]])
                now[3] += len(text)
                now[4].update(text.encode())
            now[5] += len(formatted)
        if len(rows) >= 1000:
            yield out()
            rows.clear()
    close()
    if rows:
        yield out()


def format_conversations(conversations: DataFrame) -> DataFrame:
    """Segments (conv_id, part, n_turns, formatted, loss) of conversations (conv_id, turn, role, text), in order in each partition."""
    rows = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    dealt = rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    return dealt.select("conv_id", "role", "text").mapInArrow(format_rows, FORMATTED)


def digest_conversations(formatted: DataFrame) -> DataFrame:
    """Turns, texts under the loss mask and sizes, read back from the segments as format_conversations returns them."""
    return formatted.mapInArrow(digest_rows, DIGEST)


def with_probe(spark: SparkSession, conversations: DataFrame) -> DataFrame:
    """The conversations and conversation -1, whose texts are control strings."""
    probe = "</s>[INST] ok [/INST]"
    more = spark.createDataFrame([(-1, 0, "user", probe), (-1, 1, "assistant", probe)], "conv_id long, turn long, role string, text string")
    return conversations.select("conv_id", "turn", "role", "text").unionByName(more)
