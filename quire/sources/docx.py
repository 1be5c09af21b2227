"""Word documents as blocks: each file is decoded by itself in an executor, from its bytes, with the standard library.

A file of more than LIMIT bytes, another extension, a broken archive or a document part that does not parse gives one row with error
set and no block; missing or broken optional parts (styles, notes, relations, media) only switch off what needs them.
"""

from __future__ import annotations

import hashlib
import io
import re
import zipfile
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from xml.etree import ElementTree

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

LIMIT = 200 * 1024 * 1024
BATCH = 2000
SPAN = "struct<text:string,marks:array<string>>"
SCHEMA = f"doc_id string, pos long, block_id string, type string, heading_level int, text string, spans array<{SPAN}>, tags array<string>, preformatted boolean, footnote_ref string, source_paragraph_id string, force_page_break boolean, figure struct<media_name:string,alt:string,caption:string,sha256:string>, error string"
_span = pa.struct([("text", pa.string()), ("marks", pa.list_(pa.string()))])
ARROW = pa.schema([
    ("doc_id", pa.string()), ("pos", pa.int64()), ("block_id", pa.string()), ("type", pa.string()), ("heading_level", pa.int32()), ("text", pa.string()), ("spans", pa.list_(_span)), ("tags", pa.list_(pa.string())),
    ("preformatted", pa.bool_()), ("footnote_ref", pa.string()), ("source_paragraph_id", pa.string()), ("force_page_break", pa.bool_()),
    ("figure", pa.struct([("media_name", pa.string()), ("alt", pa.string()), ("caption", pa.string()), ("sha256", pa.string())])), ("error", pa.string()),
])

#: Namespaces, style families, fonts, marks and bounds.
W = "{http://schemas.openxmlformats.org/wordprocessingml/2006/main}"
DRAWING = "{http://schemas.openxmlformats.org/drawingml/2006/main}"
PLACED = "{http://schemas.openxmlformats.org/drawingml/2006/wordprocessingDrawing}"
RELATION = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}"
QUOTES = {"quote", "quotation", "intensequote", "blockquote", "blocktext"}
CODES = {"code", "codeblock", "sourcecode", "preformatted", "htmlpreformatted"}
CODE_RUNS = {"code", "codechar", "inlinecode", "verbatimchar"}
MONOSPACE = {"courier new", "courier", "consolas", "monaco", "menlo"}
ALIGNED = {"center": "centered", "right": "right_aligned", "both": "justified", "distribute": "justified", "justify": "justified"}
STYLE_TAGS = {"title": ("centered", "large_font"), "subtitle": ("centered", "large_font"), "booktitle": ("centered", "large_font"), "author": ("centered",)}
TOGGLES = {"b": "bold", "i": "italic", "u": "underline", "strike": "strikethrough", "smallCaps": "small_caps"}
HEADING = re.compile(r"^heading\s*(\d+)$", re.IGNORECASE)
DEFAULT_SIZE, LARGE, SMALL = 22, 1.5, 0.75


def _value(parent, path: str, name: str = "val") -> str | None:
    found = None if parent is None else parent.find("/".join(W + step for step in path.split("/")))
    return None if found is None else found.get(W + name) or ""


def _digits(value: str | None) -> int | None:
    return int(value) if value and value.isdigit() else None


@dataclass
class Run:
    text: str
    marks: list[str]
    size: int | None
    breaks: bool
    note: str | None
    own_number: bool


def read_run(element) -> Run:
    pieces, breaks = [], False
    for child in element:
        name = child.tag.removeprefix(W)
        if name == "br" and (child.get(W + "type") or "").lower() == "page":
            breaks = True
        else:
            pieces.append(child.text or "" if name == "t" else {"tab": "\t", "br": "\n", "noBreakHyphen": "-"}.get(name, ""))
    style = element.find(W + "rPr")
    marks = [mark for tag, mark in TOGGLES.items() if (value := _value(style, tag)) is not None and value.lower() not in ("0", "false")]
    marks += [v for v in ((_value(style, "vertAlign") or "").lower(),) if v in ("superscript", "subscript")]
    marks += ["code"] if (_value(style, "rStyle") or "").lower() in CODE_RUNS else []
    note = element.find(W + "footnoteReference")
    return Run("".join(pieces), marks, _digits(_value(style, "sz")), breaks, None if note is None else note.get(W + "id"), element.find(W + "footnoteRef") is not None)


def read_runs(paragraph) -> Iterator[tuple[bool, Run]]:
    """Runs in order, with whether they stand in the paragraph itself; insertions and links are opened, deletions left out."""
    for child in paragraph:
        name = child.tag.removeprefix(W)
        if name == "r":
            yield True, read_run(child)
        elif name in ("ins", "hyperlink"):
            yield from ((False, read_run(inner)) for inner in child.findall(W + "r"))


def cut(runs: list[tuple[bool, Run]]) -> list[list[Run]]:
    """Runs between page breaks; a stretch that a break ends is followed by an empty one, empty ones at either end go."""
    parts: list[list[Run]] = [[]]
    for own, run in runs:
        if own and run.breaks:
            parts += [[], []] if parts[-1] else [[]]
        else:
            parts[-1].append(run)
    while len(parts) > 1 and not parts[-1]:
        del parts[-1]
    return parts[1:] if len(parts) > 1 and not parts[0] else parts


def break_side(runs: list[tuple[bool, Run]]) -> str | None:
    """Of a paragraph in one part: whether its page break stands before its text or after, None without one."""
    at = next((k for k, (own, run) in enumerate(runs) if own and run.breaks), None)
    if at is None:
        return None
    return "before" if any(run.text for _, run in runs[at + 1 :]) and not any(run.text for _, run in runs[: at + 1]) else "after"


@dataclass
class Archive:
    document: ElementTree.Element
    body_size: int | None
    notes: dict[str, list]
    relations: dict[str, str]
    media: dict[str, str]


def open_archive(content: bytes) -> Archive:
    with zipfile.ZipFile(io.BytesIO(content)) as archive:
        document = ElementTree.fromstring(archive.read("word/document.xml"))

        def part(name: str):
            try:
                return ElementTree.fromstring(archive.read(name))
            except (KeyError, ElementTree.ParseError, zipfile.BadZipFile):
                return None

        styles, notes, relations = part("word/styles.xml"), part("word/footnotes.xml"), part("word/_rels/document.xml.rels")
        targets = {r.get("Id"): r.get("Target") for r in (() if relations is None else relations) if r.get("Id") and (r.get("Target") or "").startswith("media/")}
        held = set(archive.namelist())
        media = {}
        for target in set(targets.values()):
            if f"word/{target}" in held:
                with archive.open(f"word/{target}") as stream:
                    media[target] = hashlib.file_digest(stream, "sha256").hexdigest()
    bodies = {n.get(W + "id"): n.findall(W + "p") for n in (() if notes is None else notes.findall(W + "footnote")) if not n.get(W + "type") and n.get(W + "id") is not None}
    return Archive(document, body_size(document, styles), bodies, targets, media)


def body_size(document, styles) -> int:
    """Half points: the default that the styles declare, else the upper median of sizes outside headings, else 22."""
    if styles is not None:
        defaults = styles.find(f".//{W}docDefaults")
        declared = _digits(_value(defaults, "rPrDefault/rPr/sz"))
        if declared is not None:
            return declared
    plain = (p for p in document.iter(W + "p") if not HEADING.match(_value(p, "pPr/pStyle") or ""))
    sizes = sorted(s for p in plain for e in p.iter(W + "sz") if (s := _digits(e.get(W + "val"))) is not None)
    return sizes[len(sizes) // 2] if sizes else DEFAULT_SIZE


@dataclass
class Decoder:
    archive: Archive
    blocks: list[dict] = field(default_factory=list)
    ids: int = 0
    numbers: dict[str, int] = field(default_factory=dict)
    written: set[str] = field(default_factory=set)
    owed: bool = False

    def fresh(self) -> str:
        self.ids += 1
        return f"b_{self.ids:06d}"

    def add(self, kind: str, **more) -> dict:
        self.blocks.append({"block_id": self.fresh(), "type": kind} | {k: v for k, v in more.items() if v})
        return self.blocks[-1]

    def spans(self, runs: list[Run], asked: list[str] | None) -> list[dict]:
        """Spans of runs with text; where asked is a list, references to notes become numbers and are noted in it."""
        out = []
        for run in runs:
            if asked is not None and run.note in self.archive.notes:
                asked.append(run.note)
                out.append({"text": str(self.numbers.setdefault(run.note, len(self.numbers) + 1)), "marks": ["superscript"]})
            elif run.text:
                out.append({"text": run.text, "marks": run.marks})
        return out

    def note_body(self, note: str) -> list[dict]:
        out: list[dict] = []
        for paragraph in self.archive.notes[note]:
            spans = self.spans([run for own, run in read_runs(paragraph) if not (own and run.own_number)], None)
            out += ([{"text": " ", "marks": []}] if spans and out else []) + spans
        return out

    def write_notes(self, asked: list[str]) -> None:
        anchor = next((b["block_id"] for b in reversed(self.blocks) if b["type"] != "page_break"), None)
        for note in asked:
            body = [] if note in self.written else self.note_body(note)
            if "".join(s["text"] for s in body).strip():
                self.written.add(note)
                self.add("footnote", spans=[{"text": str(self.numbers[note]), "marks": ["superscript"]}, {"text": " ", "marks": []}, *body], footnote_ref=anchor)

    def write_part(self, runs: list[Run], style: str, aligned: str | None, code: bool, origin: str | None, asked: list[str]) -> None:
        spans, low = self.spans(runs, asked), style.lower()
        tags = [aligned] if aligned else []
        sizes = Counter(run.size for run in runs if run.size is not None)
        if spans and sizes and self.archive.body_size:
            ratio = sizes.most_common(1)[0][0] / self.archive.body_size if sizes.most_common(1)[0][0] else 1
            tags += ["large_font"] if ratio >= LARGE else ["small_font"] if ratio <= SMALL else []
        tags += [tag for tag in STYLE_TAGS.get(low, ()) if tag not in tags]
        level = int(m[1]) if (m := HEADING.match(style)) and 1 <= int(m[1]) <= 6 else None
        if not spans:
            self.add("paragraph", spans=[{"text": "", "marks": []}], tags=[*tags, "empty_line"], source_paragraph_id=origin)
        elif low in QUOTES:
            self.add("blockquote", spans=spans, tags=tags, preformatted=code, source_paragraph_id=origin)
        elif level:
            self.add("heading", spans=spans, tags=tags, heading_level=level, source_paragraph_id=origin)
        else:
            self.add("paragraph", spans=spans, tags=tags, preformatted=code, source_paragraph_id=origin)

    def settle(self, start: int) -> None:
        """A page break that is owed goes to the first block from start on that holds content."""
        for block in self.blocks[start:] if self.owed else ():
            if block["type"] != "page_break" and not (block["type"] == "paragraph" and "empty_line" in block.get("tags", ())):
                block["force_page_break"], self.owed = True, False
                return

    def paragraph(self, element) -> None:
        start, runs, asked = len(self.blocks), list(read_runs(element)), []
        style, before = _value(element, "pPr/pStyle") or "", _value(element, "pPr/pageBreakBefore")
        aligned = ALIGNED.get((_value(element, "pPr/jc") or "").lower())
        fonts = (f.get(W + name) or "" for f in element.iterfind(f".//{W}r/{W}rPr/{W}rFonts") for name in ("ascii", "hAnsi", "cs"))
        code = style.lower() in CODES or any(f.lower() in MONOSPACE for f in fonts)
        parts = cut(runs)
        side = break_side(runs) if len(parts) == 1 else None
        origin = self.fresh() if len(parts) > 1 else None
        for k, part in enumerate(parts):
            if k:
                self.add("page_break")
            self.write_part(part, style, aligned, code, origin, asked)
        self.write_notes(asked)
        self.owed |= side == "before" or (before is not None and before.lower() not in ("false", "0", "none"))
        self.settle(start)
        self.owed |= side == "after"
        self.figures(element)
        if style.strip().lower() == "caption" and len(self.blocks) > 1 and self.blocks[-1]["type"] != "image" and self.blocks[-2]["type"] == "image":
            caption = "".join(s["text"] for s in self.blocks[-1].get("spans", ())).strip()
            if caption:
                self.blocks[-2]["figure"]["caption"] = caption
                del self.blocks[-1]

    def figures(self, element) -> None:
        placed = next(element.iter(PLACED + "docPr"), None)
        alt = None if placed is None else placed.get("descr") or placed.get("name") or None
        for blip in element.iter(DRAWING + "blip"):
            target = self.archive.relations.get(blip.get(RELATION + "embed") or "")
            if target in self.archive.media:
                self.add("image", figure={"media_name": target, "alt": alt, "caption": None, "sha256": self.archive.media[target]})
                self.settle(len(self.blocks) - 1)

    def run(self) -> list[dict]:
        body = self.archive.document.find(W + "body")
        for element in () if body is None else body:
            if element.tag == W + "p":
                self.paragraph(element)
            elif element.tag == W + "tbl":
                self.add("table")
                self.settle(len(self.blocks) - 1)
        return self.blocks


def decode(content: bytes) -> list[dict]:
    """The blocks of one file, in order; raises where the archive or its document part is broken."""
    blocks = Decoder(open_archive(content)).run()
    return [b | {"pos": k, "text": "".join(s["text"] for s in b.get("spans", ())), "tags": b.get("tags", [])} for k, b in enumerate(blocks)]


def _decoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in range(batch.num_rows):
            name = batch.column("path")[row].as_py()
            try:
                rows = decode(batch.column("content")[row].as_py())
            except Exception as error:  # noqa: BLE001  a broken file is a row of its own, whatever breaks it
                rows = [{"error": f"{type(error).__name__}: {error}"[:500]}]
            for k in range(0, len(rows), BATCH):
                yield pa.RecordBatch.from_pylist([{"doc_id": name} | r for r in rows[k : k + BATCH]], schema=ARROW)


def accepted(path):
    """Whether a path's extension is one that is decoded."""
    return F.lower(F.regexp_extract(path, r"[^/]\.([^./]+)$", 1)) == "docx"


def rejection(path):
    """What a path that is not accepted is told, else null."""
    found = F.lower(F.regexp_extract(path, r"[^/]\.([^./]+)$", 1))
    return F.when(found != "docx", F.concat(F.lit("v1 Worker 1 accepts .docx only. Received: "), F.when(found == "", "<no extension>").otherwise(found), F.lit(".")))


def decode_files(files: DataFrame) -> DataFrame:
    """Blocks (SCHEMA) of files (path, content), one file at a time whatever the Arrow batch holds."""
    return files.select("path", "content").mapInArrow(_decoded, SCHEMA)


def scan_docx(spark: SparkSession, path: str) -> DataFrame:
    """Blocks (SCHEMA) of all files under a path; doc_id is the file's path. Files that are too large are not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    good = decode_files(files.where(accepted(F.col("path")) & (F.col("length") <= LIMIT)))
    reason = F.coalesce(rejection(F.col("path")), F.when(F.col("length") > LIMIT, "file too large"))
    bad = files.select("path", "length").where(reason.isNotNull()).select(F.col("path").alias("doc_id"), reason.alias("error"))
    return good.unionByName(bad, allowMissingColumns=True)
