"""GIF media: decode LZW code streams, apply palettes, disposal and transparency, and store timed frames.

encode_gif stores bytes as the palette indices of 64 pixel wide frames under a grey palette whose entry i is (i, i, i), so
the picture is lossless. Its LZW streams grow a dictionary of 4096 codes and clear it when it is full. frames_of decodes any GIF:
variable code widths, deferred clears, interlacing, local palettes; composed applies palettes, transparency and all disposal
methods; what the query reads back are the colours that are shown, frame by frame, with their histograms.

Code widths follow from how many codes stand between a code and the clear code before it, so arrays pack and unpack the
bits of a whole run of codes; only the dictionary itself is a loop.

Cases: a null text is empty; a payload is never empty (zero bytes fill it up to a multiple of 64); long texts become
several frames; equal texts give equal values, whatever their rows; repeated rows give one result row each; an empty table gives
no rows; a null doc_id stays null; other columns are ignored, whatever their names. Media that are null or no GIF have no frames; a file that
breaks off has the frames before that; in a code stream that ends early or holds an impossible code the remaining indices are 0.
"""

from __future__ import annotations

import contextlib
import hashlib
import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.llm.common import portions, trimmed

WIDTH, ROWS = 64, 1024
#: Bytes of texts or media that are handled at once, at least one.
BYTES = 16 << 20
GREY = np.repeat(np.arange(256, dtype=np.uint8), 3).tobytes()
MEDIA = "doc_id long, n_bytes long, media binary"
FRAMES = "doc_id long, frame int, delay_ms int, disposal int, width int, height int, rgb binary, histogram array<long>"
RESULT = "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string, frames array<struct<frame int, delay_ms int, disposal int, width int, height int, histogram array<long>>>"


def widths(bits: int, count: int) -> np.ndarray:
    """The widths of so many codes after a clear code: each code but the first adds an entry, up to 4096."""
    entries = np.minimum((1 << bits) + 2 + np.maximum(np.arange(count) - 1, 0), 4095)
    return np.floor(np.log2(entries)).astype(np.int64) + 1


EIGHT = widths(8, 4096)


def lzw_codes(pixels: bytes) -> list[int]:
    """The codes of 8-bit pixels: the longest known run each time, and a clear code when the dictionary is full."""
    codes, known, free = [256], {}, 258
    rest = iter(pixels)
    now = next(rest)
    for pixel in rest:
        run = now << 8 | pixel
        if run in known:
            now = known[run]
            continue
        codes.append(now)
        if free < 4096:
            known[run] = free
            free += 1
        else:
            codes.append(256)
            known, free = {}, 258
        now = pixel
    codes += (now, 257)
    return codes


def pack_codes(codes: list[int]) -> bytes:
    """The codes as bits, lowest first, each as wide as its place after the last clear code asks for."""
    c = np.array(codes, np.int64)
    clears = np.flatnonzero(c == 256)
    since = np.arange(len(c)) - np.repeat(clears, np.diff(np.append(clears, len(c)))) - 1
    wide = EIGHT[np.maximum(since, 0)]
    wide[clears[1:]] = EIGHT[np.diff(clears) - 1]
    ends = np.cumsum(wide)
    at = ends - wide
    value, place, size = c << (at & 7), at >> 3, int(ends[-1] + 7) // 8
    return sum(np.bincount(place + k, value >> 8 * k & 255, size + 2) for k in range(3)).astype(np.uint8)[:size].tobytes()


def sub_blocks(data: bytes) -> bytes:
    whole = len(data) // 255
    head = np.full((whole, 256), 255, np.uint8)
    head[:, 1:] = np.frombuffer(data, np.uint8, whole * 255).reshape(-1, 255)
    rest = data[whole * 255 :]
    return head.tobytes() + (bytes([len(rest)]) + rest if rest else b"") + b"\0"


def encode_gif(payload: bytes, delay_cs: int = 10) -> bytes:
    """A GIF whose frames' palette indices are the payload, row by row; its length is a positive multiple of 64."""
    pixels = np.frombuffer(payload, np.uint8)
    high = min(ROWS, len(pixels) // WIDTH)
    out = [b"GIF89a", struct.pack("<HHBBB", WIDTH, high, 0xF7, 0, 0), GREY]
    for at in range(0, len(pixels), WIDTH * ROWS):
        frame = pixels[at : at + WIDTH * ROWS]
        out += [b"\x21\xf9\x04", struct.pack("<BHB", 1 << 2, delay_cs, 0), b"\0", b"\x2c", struct.pack("<HHHHB", 0, 0, WIDTH, len(frame) // WIDTH, 0), b"\x08", sub_blocks(pack_codes(lzw_codes(frame.tobytes())))]
    return b"".join([*out, b";"])


def code_runs(data: bytes, bits: int) -> Iterator[list[int]]:
    """The codes between clear codes, up to the end code or the end of the data."""
    clear, total, at = 1 << bits, 8 * len(data), 0
    raw = np.append(np.frombuffer(data, np.uint8), np.zeros(3, np.uint8)).astype(np.int64)
    first = EIGHT if bits == 8 else widths(bits, 4096)
    run, wide = [], first
    while at < total:
        upto = int(np.searchsorted(np.cumsum(wide), total - at, "right"))
        ends = at + np.cumsum(wide[:upto])
        starts = ends - wide[:upto]
        place = starts >> 3
        codes = (raw[place] | raw[place + 1] << 8 | raw[place + 2] << 16) >> (starts & 7) & ((1 << wide[:upto]) - 1)
        stops = np.flatnonzero((codes == clear) | (codes == clear + 1))
        run += codes[: stops[0]].tolist() if len(stops) else codes.tolist()
        if not len(stops):
            if upto < len(wide):
                break
            at, wide = int(ends[-1]), np.full(4096, 12)
            continue
        if run:
            yield run
        if codes[stops[0]] == clear + 1:
            return
        at, run, wide = int(ends[stops[0]]), [], first
    if run:
        yield run


def lzw_decode(data: bytes, bits: int, count: int) -> np.ndarray:
    """Palette indices of an LZW code stream with the given minimum code size; zeros fill up a stream that is short or breaks."""
    if not 1 <= bits <= 8:
        return np.zeros(count, np.uint8)
    base, parts, size = [bytes([k]) for k in range(1 << bits)] + [b"", b""], [], 0
    for codes in code_runs(data, bits):
        if size >= count or codes[0] >= 1 << bits:
            break
        table, last, out = base.copy(), base[codes[0]], [base[codes[0]]]
        for code in codes[1:]:
            if code < len(table):
                entry = table[code]
            elif code == len(table):
                entry = last + last[:1]
            else:
                break
            out.append(entry)
            if len(table) < 4096:
                table.append(last + entry[:1])
            last = entry
        parts.append(b"".join(out))
        size += len(parts[-1])
        if len(out) < len(codes):
            break
    return np.frombuffer(b"".join(parts)[:count].ljust(count, b"\0"), np.uint8)


@dataclass
class Frame:
    delay_ms: int
    disposal: int
    box: tuple[int, int, int, int]  # left, top, width, height
    indices: np.ndarray
    palette: np.ndarray
    transparent: int | None
    size: tuple[int, int]  # of the whole picture: width, height


def read_blocks(data: bytes, at: int) -> tuple[bytes, int]:
    parts = []
    while n := data[at]:
        if at + 1 + n > len(data):
            raise IndexError("the block breaks off")
        parts.append(data[at + 1 : at + 1 + n])
        at += n + 1
    return b"".join(parts), at + 1


def read_palette(data: bytes, at: int, flags: int) -> tuple[np.ndarray, int]:
    end = at + 3 * (2 << (flags & 7))
    if end > len(data):
        raise IndexError("the palette breaks off")
    return np.frombuffer(data[at:end], np.uint8).reshape(-1, 3), end


def frames_of(data: bytes | None) -> Iterator[Frame]:
    """The frames as they are stored, before disposal and transparency, up to where the file breaks off."""
    with contextlib.suppress(IndexError, struct.error):
        yield from whole_frames(data or b"")


def whole_frames(data: bytes) -> Iterator[Frame]:
    if data[:6] not in (b"GIF87a", b"GIF89a"):
        return
    width, high, flags, _, _ = struct.unpack_from("<HHBBB", data, 6)
    at, shared = 13, np.zeros((256, 3), np.uint8)
    if flags & 0x80:
        shared, at = read_palette(data, at, flags)
    delay = disposal = 0
    transparent = None
    while at < len(data) and data[at] != 0x3B:
        if data[at] == 0x21:
            if data[at + 1] == 0xF9:
                bits, delay, index = struct.unpack_from("<BHB", data, at + 3)
                disposal, transparent = bits >> 2 & 7, index if bits & 1 else None
            _, at = read_blocks(data, at + 2)
        elif data[at] == 0x2C:
            left, top, w, h, bits = struct.unpack_from("<HHHHB", data, at + 1)
            at += 10
            palette = shared
            if bits & 0x80:
                palette, at = read_palette(data, at, bits)
            least = data[at]
            stream, at = read_blocks(data, at + 1)
            indices = lzw_decode(stream, least, w * h).reshape(h, w)
            if bits & 0x40:
                order = np.concatenate([np.arange(a, h, b) for a, b in ((0, 8), (4, 8), (2, 4), (1, 2))])
                indices = indices[np.argsort(order, kind="stable")]
            yield Frame(delay * 10, disposal, (left, top, w, h), indices, palette, transparent, (width, high))
            delay = disposal = 0
            transparent = None
        else:
            return


def composed(data: bytes) -> Iterator[tuple[Frame, np.ndarray]]:
    """Each frame with the whole picture (height, width, RGB) as it is shown at that time."""
    canvas = None
    for frame in frames_of(data):
        if canvas is None:
            canvas = np.zeros((frame.size[1], frame.size[0], 3), np.uint8)
        left, top, w, h = frame.box
        before = canvas.copy() if frame.disposal == 3 else None
        part = canvas[top : top + h, left : left + w]
        indices = frame.indices[: part.shape[0], : part.shape[1]]
        colours = np.zeros((256, 3), np.uint8)
        colours[: len(frame.palette)] = frame.palette
        new = colours[indices]
        if frame.transparent is not None:
            seen = (indices != frame.transparent)[..., None]
            new = np.where(seen, new, part)
        part[...] = new
        yield frame, canvas.copy()
        if frame.disposal == 2:
            part[...] = 0
        elif frame.disposal == 3:
            canvas = before


def light_histogram(rgb: np.ndarray, bins: int = 16) -> np.ndarray:
    """Pixels by lightness, in equal bins of (299 R + 587 G + 114 B) / 1000."""
    r, g, b = (rgb[..., k].reshape(-1).astype(np.uint32) for k in range(3))
    light = (299 * r + 587 * g + 114 * b) // 1000
    return np.bincount(light * bins // 256, minlength=bins)


@trimmed
def media_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in (part for b in batches for part in portions(b, BYTES)):
        texts = [t or b"" for t in pc.cast(batch.column(1), pa.binary()).to_pylist()]
        media = [encode_gif(t + bytes(-len(t) % WIDTH if t else WIDTH)) for t in texts]
        yield pa.record_batch([batch.column(0), pa.array([len(t) for t in texts], pa.int64()), pa.array(media, pa.binary())], names=["doc_id", "n_bytes", "media"])


def timed_frame(number: int, frame: Frame, rgb: np.ndarray) -> dict:
    return {"frame": number, "delay_ms": frame.delay_ms, "disposal": frame.disposal, "width": rgb.shape[1], "height": rgb.shape[0], "histogram": light_histogram(rgb).tolist()}


@trimmed
def frame_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("doc_id", pa.int64()), ("frame", pa.int32()), ("delay_ms", pa.int32()), ("disposal", pa.int32()), ("width", pa.int32()), ("height", pa.int32()), ("rgb", pa.binary()), ("histogram", pa.list_(pa.int64()))])
    for batch in batches:
        for doc_id, data in zip(batch.column("doc_id").to_pylist(), batch.column("media").to_pylist(), strict=True):
            for k, (frame, rgb) in enumerate(composed(data)):
                yield pa.RecordBatch.from_pylist([{"doc_id": doc_id, "rgb": rgb.tobytes(), **timed_frame(k, frame, rgb)}], schema=schema)


def read_back(data: bytes) -> tuple[bytes, list[dict]]:
    """The payload of a picture made by encode_gif, which is the red of each frame as it is shown, and its timed frames."""
    parts, frames = [], []
    for frame, rgb in composed(data):
        parts.append(rgb[: frame.box[3], :, 0].tobytes())
        frames.append(timed_frame(len(frames), frame, rgb[: frame.box[3]]))
    return b"".join(parts), frames


def feature_of(frames: list[dict]) -> str:
    light = np.sum([f["histogram"] for f in frames], axis=0)
    return f"frames={len(frames)};ms={sum(f['delay_ms'] for f in frames)};light={','.join(map(str, light))}"


@trimmed
def digest_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    frame_kind = pa.list_(pa.struct([("frame", pa.int32()), ("delay_ms", pa.int32()), ("disposal", pa.int32()), ("width", pa.int32()), ("height", pa.int32()), ("histogram", pa.list_(pa.int64()))]))
    kinds = (pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), frame_kind)
    names = ["doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature", "frames"]
    for batch in (part for b in batches for part in portions(b.select(["doc_id", "media", "n_bytes"]), BYTES)):
        out = []
        for data in batch.column("media").to_pylist():
            payload, frames = read_back(data)
            out.append((len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-64:]), len(data), hashlib.sha256(data).hexdigest(), feature_of(frames), frames))
        columns = [pa.array([row[k] for row in out], kind) for k, kind in enumerate(kinds)]
        yield pa.record_batch([batch.column("doc_id"), batch.column("n_bytes"), *columns], names=names)


def to_media(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes and the GIF of every text of docs (doc_id, text)."""
    text = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return text.mapInArrow(media_rows, MEDIA)


def decode_frames(media: DataFrame) -> DataFrame:
    """Timed frames with their colours and histograms, one row each, of (doc_id, media)."""
    return media.mapInArrow(frame_rows, FRAMES)


def digest_media(media: DataFrame) -> DataFrame:
    """What the stored bytes of to_media read back as."""
    return media.mapInArrow(digest_rows, RESULT)
