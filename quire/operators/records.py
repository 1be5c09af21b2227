"""Rules over records: lookups of services, file names, warnings, artifacts, their lineage and what they must fulfil."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quire.functions.text import sanitize_key, strip, word_count

#: Ranks, media types, versions, block types and what a block may carry.
SEVERITIES = {"low": 0, "medium": 1, "high": 2}
MEDIA_TYPES = {"png": "image/png", "jpg": "image/jpeg", "jpeg": "image/jpeg", "tif": "image/tiff", "tiff": "image/tiff", "gif": "image/gif"}
TYPES = ("paragraph", "heading", "list_item", "blockquote", "table", "image", "code", "preformatted_block", "footnote", "page_break", "horizontal_rule")
TAGS = ("centered", "right_aligned", "justified", "bold", "italic", "underline", "strikethrough", "small_caps", "large_font", "small_font", "indented", "outdented", "empty_line")
ROLES = ("title_page", "front_matter", "part_divider", "chapter_heading", "chapter_subtitle", "body_paragraph", "scene_break", "back_matter", "heading", "list_item", "blockquote", "table", "image", "code_block", "footnote", "structural")
MESSAGE, LOG = 500, 10000
STRUCTURAL = ("toc_marker", "scene_break", "horizontal_rule", "page_break")


def _map(pairs: dict) -> Column:
    return F.create_map(*[F.lit(x) for pair in pairs.items() for x in pair])


def first_value(values: Column) -> Column:
    """The first of an array's strings that is not blank, trimmed."""
    return F.get(F.filter(F.transform(values, strip), lambda x: x != ""), F.lit(0))


def sanitize_message(message: Column) -> Column:
    return F.when(F.length(message) > MESSAGE, F.concat(F.substring(message, 1, MESSAGE), F.lit("…[truncated]"))).otherwise(message)


def media_type(key: Column) -> Column:
    """By the key's ending (the whole key where it has no dot)."""
    return F.coalesce(F.try_element_at(_map(MEDIA_TYPES), F.lower(F.substring_index(key, ".", -1))), F.lit("application/octet-stream"))


def public_url(base: Column, key: Column) -> Column:
    """Null without a base: such objects have only signed addresses."""
    return F.when(base != "", F.concat(base, F.lit("/"), key))


def scan_format(path: Column) -> Column:
    """The decoder of a path's extension, null where there is none."""
    ending = F.lower(F.regexp_extract(path, r"[^/](\.[^./]+)$", 1))
    return F.when(ending == ".docx", "docx").when(ending == ".pdf", "pdf").when(ending.isin(".txt", ".md"), "txt")


def compared(value: Column) -> Column:
    return F.lower(strip(F.coalesce(value, F.lit(""))))


def signature_label(kind: Column, level: Column) -> Column:
    return F.when((kind == "heading") & level.isNotNull(), F.concat(F.lit("Heading"), level.cast("string"))).otherwise(kind)


def file_hash(content: Column, algorithm: str = "sha256") -> Column:
    data = content.cast("binary")
    return {"sha256": lambda: F.sha2(data, 256), "sha1": lambda: F.sha1(data), "md5": lambda: F.md5(data)}[algorithm]()


def hash_parts(value: Column) -> Column:
    """algorithm and digest of a prefixed hash, null without a prefix."""
    return F.when(value.contains(":"), F.struct(F.substring_index(value, ":", 1).alias("algorithm"), F.regexp_replace(value, "^[^:]*:", "").alias("digest")))


def normal_spans(kind: Column, text: Column, spans: Column) -> Column:
    """The spans of a plain block: none on structural types, one made of the text where there are none."""
    empty = F.array().cast("array<string>")
    made = F.array(F.struct(text.alias("text"), empty.alias("marks")))
    return F.when(~kind.isin(*STRUCTURAL), F.coalesce(spans, F.when(text.isNotNull(), made)))


def held_version(version: Column) -> Column:
    return F.when(version.isin("1.0", "1.1"), version).otherwise("1.0")


# Warnings and quality


def above(warnings: DataFrame, worst: str = "medium") -> DataFrame:
    """Warnings more severe than worst; an unknown severity counts as low, an unknown bound as medium."""
    rank = F.coalesce(F.try_element_at(_map(SEVERITIES), F.col("severity")), F.lit(0))
    return warnings.where(rank > SEVERITIES.get(worst, 1))


def quality_issues(rows: DataFrame) -> DataFrame:
    """One row an issue of artifacts (doc_id, confidence, ocr_used, parsing_errors); nulls raise none."""
    parts = F.array(
        F.when(F.col("confidence") < 0.8, F.struct(F.lit("chapter_boundary_confidence").alias("issue"), F.concat(F.lit("Low confidence ("), F.format_number("confidence", 2), F.lit("). Manual review recommended.")).alias("message"))),
        F.when(F.col("ocr_used"), F.struct(F.lit("ocr_used").alias("issue"), F.lit("OCR was used. Text quality may be lower than native text extraction.").alias("message"))),
        F.when(F.col("parsing_errors") > 0, F.struct(F.lit("parsing_errors").alias("issue"), F.concat(F.col("parsing_errors").cast("string"), F.lit(" parsing error(s) encountered during processing.")).alias("message"))),
    )
    return rows.select("doc_id", F.explode(F.array_compact(parts)).alias("i")).select("doc_id", "i.*")


# Services


def resolve(services: DataFrame, projects: DataFrame, books: DataFrame) -> DataFrame:
    """Services with the title, subtitle and author of their project's book, else their own; null where neither has any.

    services (id, project, book_title, author_name), projects (project, book), books (book, title, subtitle, author), one row a key.
    """
    blank = lambda name: F.nullif(F.col(name), F.lit(""))
    rows = services.join(projects, "project", "left").join(books, "book", "left")
    held = blank("title").isNotNull() | blank("author").isNotNull()
    return rows.select("id", F.when(held, blank("title")).otherwise(blank("book_title")).alias("title"), F.when(held, blank("subtitle")).alias("subtitle"), F.when(held, blank("author")).otherwise(blank("author_name")).alias("author"))


def first_attachment(services: DataFrame, manuscripts: DataFrame) -> DataFrame:
    """id, url, filename: the first file of the first manuscript that a service links, null where it links none or that one has no file.

    services (id, manuscripts array<string>), manuscripts (manuscript, attachments array<struct<url, filename>>), one row a manuscript.
    """
    rows = services.select("id", F.get("manuscripts", F.lit(0)).alias("manuscript")).join(manuscripts, "manuscript", "left")
    return rows.select("id", F.get("attachments", F.lit(0)).alias("a")).select("id", "a.url", "a.filename")


def required_lookups(services: DataFrame) -> DataFrame:
    """id, intake_id, sku, missing: what a storage key needs, from lookups (arrays); missing names the first field without a value, and then both are null."""
    found = services.select("id", first_value(F.col("intake_ids")).alias("_intake"), first_value(F.col("skus")).alias("_sku"))
    missing = F.when(F.col("_intake").isNull(), "Project Intake Submission ID").when(F.col("_sku").isNull(), "Service SKU")
    found = found.withColumn("missing", missing)
    whole = F.col("missing").isNull()
    return found.select("id", F.when(whole, sanitize_key(F.col("_intake"))).alias("intake_id"), F.when(whole, sanitize_key(F.col("_sku"))).alias("sku"), "missing")


def transition(status: Column, event: Column, message: Column) -> Column:
    """What an event (claim, complete, fail) makes of a service: status, error_log, blocked."""
    state = F.when(event == "claim", "Processing").when(event == "complete", "Complete").when(event == "fail", "Failed").otherwise(status)
    log = F.when(event == "claim", "").when(event == "fail", F.substring(message, 1, LOG))
    return F.struct(state.alias("status"), log.alias("error_log"), F.when(event == "claim", False).alias("blocked"))


def intake_conflicts(meta: DataFrame, intake: DataFrame) -> DataFrame:
    """doc_id, decision, differing of documents with a title page of their own and intake data to compare; differing may be empty."""
    both = meta.select("doc_id", F.col("title").alias("_t"), F.col("author").alias("_a")).join(intake.select("doc_id", "title", "author"), "doc_id")
    for name in ("_t", "_a", "title", "author"):
        both = both.withColumn(name, compared(F.col(name)))
    both = both.where("_t <> '' and (title <> '' or author <> '')")
    differ = lambda mine, theirs, label: F.when((F.col(mine) != "") & (F.col(theirs) != "") & (F.col(mine) != F.col(theirs)), label)
    return both.select("doc_id", F.lit("used author title page; suppressed system-generated").alias("decision"), F.concat_ws(",", differ("_t", "title", "title"), differ("_a", "author", "author")).alias("differing"))


# Lineage


def lineage_chain(parents: DataFrame, artifacts: DataFrame) -> DataFrame:
    """doc_id, step, type, key, hash, own: an artifact's parents in order and then itself, whose key and hash are not known yet.

    version, produced_by and produced_at are carried where both sides have them.
    """
    more = [c for c in ("version", "produced_by", "produced_at") if c in parents.columns and c in artifacts.columns]
    own = artifacts.join(parents.groupBy("doc_id").agg(F.max("idx").alias("last")), "doc_id", "left")
    own = own.select("doc_id", F.coalesce(F.col("last") + 2, F.lit(1)).cast("long").alias("step"), "type", F.lit(None).cast("string").alias("key"), F.lit(None).cast("string").alias("hash"), F.lit(True).alias("own"), *more)
    return parents.select("doc_id", (F.col("idx") + 1).cast("long").alias("step"), "type", "key", "hash", F.lit(False).alias("own"), *more).unionByName(own)


def lineage_verify(declared: DataFrame, actual: DataFrame) -> DataFrame:
    """doc_id, valid, mismatches: declared parents (doc_id, idx, hash) against the ones at hand; null without any, false if counts differ."""
    a = declared.select("doc_id", "idx", F.col("hash").alias("_d"), F.lit(1).alias("_in"))
    b = actual.select("doc_id", "idx", F.col("hash").alias("_a"), F.lit(1).alias("_at"))
    sums = a.join(b, ["doc_id", "idx"], "full").groupBy("doc_id").agg(F.count("_in").alias("n"), F.count("_at").alias("m"), F.count_if(F.col("_in").isNotNull() & F.col("_at").isNotNull() & ~F.col("_d").eqNullSafe(F.col("_a"))).alias("bad"))
    return sums.select("doc_id", F.when(F.col("m") == 0, None).otherwise((F.col("n") == F.col("m")) & (F.col("bad") == 0)).alias("valid"), F.when(F.col("n") == F.col("m"), F.col("bad")).otherwise(0).cast("long").alias("mismatches"))


def lineage_text(chain: DataFrame) -> DataFrame:
    """doc_id, lineage: a chain with version, produced_by and produced_at as text, two lines a step; an artifact's own missing fields read None, its parents' by name."""
    shown = lambda name, absent: F.coalesce(F.col(name).cast("string"), F.when(F.col("own"), "None").otherwise(absent))
    head = F.concat(F.col("step").cast("string"), F.lit(". "), shown("type", "unknown"), F.lit(" v"), shown("version", "?"), F.lit(" ("), shown("produced_by", "unknown"), F.lit(" @ "), shown("produced_at", "unknown"), F.lit(")"))
    line = F.concat(head, F.lit("\n   \u2192 "), shown("key", "not yet uploaded"))
    steps = F.array_sort(F.collect_list(F.struct("step", line.alias("line"))))
    return chain.groupBy("doc_id").agg(F.array_join(F.transform(steps, lambda s: s["line"]), "\n").alias("lineage"))


def trace_source(artifacts: DataFrame, parents: DataFrame) -> DataFrame:
    """Artifacts (doc_id and the fields of their source) with parent_key, parent_type, parent_hash and known.

    An artifact with parents is traced to the first of them and its own source is not looked at; one without is known by its own source, if that has any field.
    """
    first = parents.groupBy("doc_id").agg(F.min_by(F.struct("key", "type", "hash"), "idx").alias("_first"))
    fields = [c for c in artifacts.columns if c != "doc_id"]
    rows = artifacts.join(first, "doc_id", "left")
    own = F.col("_first").isNull()
    held = F.coalesce(*(F.col(c).cast("string") for c in fields)).isNotNull()
    return rows.select("doc_id", *(F.when(own, F.col(c)).alias(c) for c in fields), *(F.col(f"_first.{c}").alias(f"parent_{c}") for c in ("key", "type", "hash")), (~own | held).alias("known"))


# What artifacts must fulfil


def bare_lists(rows: DataFrame) -> DataFrame:
    """list_group and list_type of list rows that have none, repaired; repaired tells which rows were given a group.

    A group that is missing starts a new number unless the row before is a list, too; a row that follows a list takes the number last given.
    """
    order = Window.partitionBy("doc_id").orderBy("ln_pos")
    is_list = F.col("block_type") == "list"
    rows = rows.withColumn("_bare", is_list & F.col("list_group").isNull())
    starts = F.col("_bare") & ~F.coalesce(F.lag(is_list).over(order), F.lit(False))
    rows = rows.withColumn("_starts", starts.cast("long"))
    number = F.sum("_starts").over(order.rowsBetween(Window.unboundedPreceding, 0))
    return rows.withColumns({"list_group": F.when(F.col("_bare"), number).otherwise(F.col("list_group")), "list_type": F.when(is_list, F.coalesce("list_type", F.lit("unordered"))), "repaired": F.col("_bare")}).drop("_bare", "_starts")


def violations(rows: DataFrame) -> DataFrame:
    """doc_id, pos, violation: every clause that a classified block (type, heading_level, tags, role, subtype, title) breaks."""
    role = F.coalesce("role", F.lit(""))
    clauses = {
        "type": ~F.coalesce(F.col("type").isin(*TYPES), F.lit(False)), "role": F.col("role").isNotNull() & ~role.isin(*ROLES), "tags": F.size(F.array_except(F.coalesce("tags", F.array().cast("array<string>")), F.array(*map(F.lit, (*TAGS, ""))))) > 0,
        "heading_level": (F.col("type") == "heading") & ~F.coalesce(F.col("heading_level").between(1, 6), F.lit(False)), "chapter_title": (role == "chapter_heading") & F.col("title").isNull(), "subtype": role.isin("front_matter", "back_matter") & F.col("subtype").isNull(),
    }
    found = F.array_compact(F.array(*(F.when(F.coalesce(c, F.lit(False)), F.lit(name)) for name, c in clauses.items())))
    return rows.select("doc_id", "pos", F.explode(found).alias("violation"))


def first_violations(found: DataFrame, limit: int = 5) -> DataFrame:
    """The first ones of each document, as a report shows them."""
    return found.withColumn("n", F.row_number().over(Window.partitionBy("doc_id").orderBy("pos", "violation"))).where(F.col("n") <= limit)


def artifacts(rows: DataFrame, worker: str, version: str, schema: str = "2.2") -> DataFrame:
    """One row a document: schema_version, artifact_type, worker, blocks in order, counts. Blocks are gathered by document, the unit of the format."""
    names = [n for n in ("pos", "block_id", "type", "heading_level", "text", "tags", "role", "subtype", "title", "number") if n in rows.columns]
    return rows.groupBy("doc_id").agg(F.array_sort(F.collect_list(F.struct(*names))).alias("blocks"), F.count("*").alias("block_count"), F.count_if(F.col("role") == "chapter_heading").alias("chapter_count")).select(
        "doc_id", F.lit(schema).alias("schema_version"), F.lit("manuscript").alias("artifact_type"), F.lit(worker).alias("worker_name"), F.lit(version).alias("worker_version"), "block_count", "chapter_count", "blocks"
    )


def artifacts_v1(blocks: DataFrame, sources: DataFrame, worker: str, version: str) -> DataFrame:
    """One row a document of sources: the nested artifact of schema 1.0, whose language, direction and confidence are fixed.

    blocks (doc_id, pos, type, text and more), sources (doc_id, original_filename, original_format, file_size, file_hash, ingested_at, run_id, project_id,
    service_id, processed_at). A document without blocks has an empty array and counts of 0.
    """
    names = ["pos", *(c for c in blocks.columns if c not in ("doc_id", "pos"))]
    words = F.sum(F.coalesce(word_count(F.col("text")), F.lit(0))).cast("long")
    found = blocks.groupBy("doc_id").agg(F.array_sort(F.collect_list(F.struct(*names))).alias("blocks"), words.alias("_words"), F.count_if(F.col("type") == "chapter_heading").alias("_chapters"))
    rows = sources.join(found, "doc_id", "left")
    listed = F.coalesce("blocks", F.array().cast(found.schema["blocks"].dataType))
    zero, none = F.lit(0).cast("long"), F.array().cast("array<string>")
    stats = F.struct(F.coalesce("_words", zero).alias("word_count"), F.size(listed).cast("long").alias("block_count"), F.coalesce("_chapters", zero).alias("chapter_count"))
    return rows.select(
        "doc_id", F.lit("1.0").alias("schema_version"), F.lit("manuscript").alias("artifact_type"), F.lit("1").alias("artifact_version"),
        F.struct("original_filename", "original_format", F.col("file_size").alias("original_file_size_bytes"), F.col("file_hash").alias("source_hash_sha256"), "ingested_at").alias("source"),
        F.struct(F.lit(worker).alias("worker_name"), F.lit(version).alias("worker_version"), "run_id", "project_id", "service_id", "processed_at").alias("processing"),
        F.struct(F.lit("en").alias("language"), F.lit("ltr").alias("reading_direction"), listed.alias("blocks"), stats.alias("stats")).alias("content"),
        F.struct(none.alias("warnings"), none.alias("unsupported_elements"), F.struct(F.lit(0.9).alias("chapter_boundary_confidence"), F.lit(False).alias("ocr_used")).alias("quality")).alias("analysis"),
    )


def schema_versions(paths: DataFrame) -> DataFrame:
    """artifact_type, versions, latest: schema files <type>/<type>.v<version>.schema.json by type; folders that start with _ do not count, versions sort as strings."""
    pattern = r"(?:^|/)([^/_][^/]*)/\1\.v([^/]*)\.schema\.json$"
    found = paths.where(F.col("path").rlike(pattern)).select(F.regexp_extract("path", pattern, 1).alias("artifact_type"), F.regexp_extract("path", pattern, 2).alias("version"))
    return found.groupBy("artifact_type").agg(F.array_sort(F.collect_set("version")).alias("versions"), F.max("version").alias("latest"))


def write_artifacts(rows: DataFrame, path: str) -> None:
    """One JSON line a document; fields that are null are left out."""
    rows.write.mode("overwrite").json(path)
