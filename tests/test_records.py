import json
import hashlib

from pyspark.sql import functions as F

from quire.functions import canonical
from quire.operators import blocks, records, registry, structure

SCHEMA = "doc_id long, pos long, type string, heading_level int, text string, tags array<string>"
TEXTS = ["plain", "", None, 'say "it"', "back\\slash", "tab\tline\nbell\x07\x1f\x0b", "naïve — 日本 \U0001f600 x", "\x7f/"]
NUMBERS = [0.0, 0.9, -0.0, 1.0, 1e-3, 1.5e-4, 1e-5, 1.25e-7, 1e7, 12345678.9, 1e15, 123456789012345.6, 1e16, 1.5e300, -2.5e22, None]


def test_canonical_json(spark):
    rows = [(k, t, NUMBERS[k % len(NUMBERS)], {"b": k, "a": None, "é": 2}, [(t, True), (None, None)], None) for k, t in enumerate(TEXTS * 2)]
    schema = "z long, text string, n double, map map<string,long>, list array<struct<y: string, b: boolean>>, gone array<int>"
    frame = spark.createDataFrame(rows, schema).select(F.struct("*").alias("v"))
    for ascii_only in (False, True):
        made = frame.select(F.col("v.z").alias("z"), canonical.canonical_json(F.col("v"), frame.schema["v"].dataType, ascii_only).alias("j"), canonical.canonical_hash(F.col("v"), frame.schema["v"].dataType, ascii_only).alias("h")).collect()
        for row in made:
            z, text, n, pairs, items, gone = rows[row.z]
            want = json.dumps({"z": z, "text": text, "n": n, "map": pairs, "list": [{"y": y, "b": b} for y, b in items], "gone": gone}, sort_keys=True, separators=(",", ":"), ensure_ascii=ascii_only)
            assert row.j == want
            assert row.h == "sha256:" + hashlib.sha256(want.encode()).hexdigest()


def test_canonical_json_of_numbers(spark):
    frame = spark.createDataFrame([(k, x) for k, x in enumerate(NUMBERS)], "k int, x double")
    made = frame.select("k", canonical.canonical_json(F.col("x"), frame.schema["x"].dataType).alias("j")).orderBy("k").collect()
    assert [r.j for r in made] == [json.dumps(x) for x in NUMBERS]


def test_attachment_and_lookups(spark):
    services = spark.createDataFrame([(1, ["m1", "m2"]), (2, []), (3, ["m2"]), (4, ["gone"]), (5, None)], "id int, manuscripts array<string>")
    files = spark.createDataFrame([("m1", [("u1", "a.docx"), ("u2", "b.docx")]), ("m2", [])], "manuscript string, attachments array<struct<url: string, filename: string>>")
    assert sorted(tuple(r) for r in records.first_attachment(services, files).collect()) == [(1, "u1", "a.docx"), *((k, None, None) for k in range(2, 6))]
    lookups = spark.createDataFrame([(1, [None, " a/b c "], ["s"]), (2, None, ["s"]), (3, ["x"], [" "]), (4, [], [])], "id int, intake_ids array<string>, skus array<string>")
    intake, sku = "Project Intake Submission ID", "Service SKU"
    assert sorted(tuple(r) for r in records.required_lookups(lookups).collect()) == [(1, "a_b_c", "s", None), (2, None, None, intake), (3, None, None, sku), (4, None, None, intake)]


def test_landmark_warnings(spark):
    rows = [("heading", 1, "Of beginnings\nChapter 1\nChapter 2"), ("heading", 1, "ChapterIII."), ("heading", 1, "Chapter 4"), ("heading", 2, "On\nLetter 1\nLetter 2"), ("heading", 2, "Letter5"), ("paragraph", None, "Chapter6")]
    frame = spark.createDataFrame([(1, k, kind, level, text, []) for k, (kind, level, text) in enumerate(rows)], SCHEMA)
    found = blocks.landmark_warnings(blocks.classify_landmarks(blocks.with_strata(frame))).orderBy("pos").collect()
    assert [(r.pos, r.warning, r.severity, r.heading, r.lines) for r in found] == [(0, "ambiguous", "medium", None, 2), (1, "fused", "low", "ChapterIII", None)]


def test_registry_runs_the_rules_in_order(spark):
    assert [r.id for r in registry.rules_for_phase("classify")][:3] == ["C-007", "C-001", "C-008"]
    rows = [("heading", 1, "Chapter 1"), ("paragraph", None, 'He  said "no"'), ("heading", 1, "Chapter 3"), ("paragraph", None, "x <w:ins y")]
    frame = spark.createDataFrame([(1, k, kind, level, text, []) for k, (kind, level, text) in enumerate(rows)], SCHEMA)
    out, found = registry.run(frame)
    assert [(r.role, r.text) for r in out.orderBy("pos").collect()] == [("chapter_heading", "Chapter 1"), ("body_paragraph", "He said “no”"), ("chapter_heading", "Chapter 3"), ("body_paragraph", "x <w:ins y")]
    assert [r.role for r in structure.classify(frame).orderBy("pos").collect()] == [r.role for r in out.orderBy("pos").collect()]
    assert [(r.previous, r.number, r.defect) for r in found["V-001"].collect()] == [(1, 3, "gap")]
    assert [r.residue for r in found["V-004"].collect()] == ["<w:ins"]
    assert set(found) == {"V-001", "V-002", "V-004", "V-005", "V-006"}


def test_artifact_without_blocks(spark):
    names = ["ingested_at", "run_id", "project_id", "service_id", "processed_at"]
    sources = spark.createDataFrame([(1, "a.docx", "docx", 3, "h", *names), (2, "b.docx", "docx", 4, "g", *names)], "doc_id long, original_filename string, original_format string, file_size long, file_hash string, " + ", ".join(f"{n} string" for n in names))
    made = spark.createDataFrame([(1, 1, "paragraph", "two words"), (1, 0, "chapter_heading", "Chapter 1"), (1, 2, "page_break", None)], "doc_id long, pos long, type string, text string")
    one, two = records.artifacts_v1(made, sources, "w", "1.0").orderBy("doc_id").collect()
    assert [b.pos for b in one.content.blocks] == [0, 1, 2] and tuple(one.content.stats) == (4, 3, 1)
    assert two.content.blocks == [] and tuple(two.content.stats) == (0, 0, 0) and two.source.source_hash_sha256 == "g" and one.analysis.warnings == []
