"""Queries over the record rules, with their SQL; services, files and artifacts are dressed up from the tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from quire import structure_queries as books
from quire.functions import canonical
from quire.operators import records, registry, structure
from quire.plans import carriers
from quire.sources import docx

QUERIES: dict = {}
ORACLE: dict[str, str] = {}
ENDINGS = "concat('in/file', CAST(p_partkey AS STRING), CASE p_partkey % 7 WHEN 0 THEN '.docx' WHEN 1 THEN '.DOCX' WHEN 2 THEN '.pdf' WHEN 3 THEN '.md' WHEN 4 THEN '' WHEN 5 THEN '.png' ELSE '.tar.TIFF' END)"


def query(name: str, sql: str):
    def add(function):
        QUERIES[name], ORACLE[name] = function, sql
        return function

    return add


def _table(spark, sf_dir, name):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _paths(spark, sf_dir):
    return _table(spark, sf_dir, "part").select("p_partkey", F.expr(ENDINGS).alias("path"))


@query("r001_reject", f"SELECT p_partkey, path, CASE WHEN ending = 'docx' THEN NULL ELSE 'v1 Worker 1 accepts .docx only. Received: ' || CASE ending WHEN '' THEN '<no extension>' ELSE ending END || '.' END AS rejection FROM (SELECT *, CASE WHEN contains(path, '.') THEN lower(list_last(string_split(path, '.'))) ELSE '' END AS ending FROM (SELECT p_partkey, {ENDINGS} AS path FROM part))")
def r001_reject(spark, sf_dir):
    return _paths(spark, sf_dir).withColumn("rejection", docx.rejection(F.col("path")))


@query("format_dispatch", f"SELECT p_partkey, CASE WHEN lower(path) LIKE '%.docx' THEN 'docx' WHEN path LIKE '%.pdf' THEN 'pdf' WHEN path LIKE '%.md' THEN 'txt' END AS format, CASE WHEN path LIKE '%.png' THEN 'image/png' WHEN lower(path) LIKE '%.tiff' THEN 'image/tiff' ELSE 'application/octet-stream' END AS media_type, 'https://files/' || path AS url FROM (SELECT p_partkey, {ENDINGS} AS path FROM part)")
def format_dispatch(spark, sf_dir):
    path = F.col("path")
    return _paths(spark, sf_dir).select("p_partkey", records.scan_format(path).alias("format"), records.media_type(path).alias("media_type"), records.public_url(F.lit("https://files"), path).alias("url"))


@query("file_hash", "SELECT doc_id, sha256(text) AS sha256, sha1(text) AS sha1, md5(text) AS md5 FROM documents")
def file_hash(spark, sf_dir):
    return _table(spark, sf_dir, "documents").select("doc_id", *(records.file_hash(F.col("text"), a).alias(a) for a in ("sha256", "sha1", "md5")))


@query("sanitize_msg", "SELECT doc_id, CASE WHEN length(text) > 500 THEN substr(text, 1, 500) || '…[truncated]' ELSE text END AS message, CASE WHEN contains(text, ':') THEN split_part(text, ':', 1) END AS algorithm FROM documents")
def sanitize_msg(spark, sf_dir):
    return _table(spark, sf_dir, "documents").select("doc_id", records.sanitize_message(F.col("text")).alias("message"), records.hash_parts(F.col("text"))["algorithm"].alias("algorithm"))


@query("first_lookup", "SELECT o_orderkey, CASE WHEN o_orderkey % 4 = 0 THEN NULL WHEN o_orderkey % 4 = 1 THEN o_orderpriority ELSE o_orderstatus END AS value, lower(trim(' ' || o_orderpriority || ' ')) AS compared FROM orders")
def first_lookup(spark, sf_dir):
    key, none = F.col("o_orderkey") % 4, F.lit(None).cast("string")
    items = F.when(key == 0, F.array(F.lit(" "), none)).when(key == 1, F.array(none, F.concat(F.lit(" "), F.col("o_orderpriority")))).when(key == 2, F.array(F.lit(""), F.col("o_orderstatus"))).otherwise(F.array(F.col("o_orderstatus"), F.col("o_orderpriority")))
    return _table(spark, sf_dir, "orders").select("o_orderkey", records.first_value(items).alias("value"), records.compared(F.concat(F.lit(" "), F.col("o_orderpriority"), F.lit(" "))).alias("compared"))


@query("v1_normalize_spans", "SELECT event_id, CASE event_id % 4 WHEN 0 THEN NULL WHEN 1 THEN event_type WHEN 2 THEN 'given' END AS span, CASE event_id % 4 WHEN 3 THEN '1.0' WHEN 1 THEN '1.1' ELSE '1.0' END AS version FROM events")
def v1_normalize_spans(spark, sf_dir):
    key = F.col("event_id") % 4
    kind = F.when(key == 0, "scene_break").otherwise("paragraph")
    spans = F.when(key == 2, F.array(F.struct(F.lit("given").alias("text"), F.array().cast("array<string>").alias("marks"))))
    found = records.normal_spans(kind, F.when(key < 3, F.col("event_type")), spans)
    return _table(spark, sf_dir, "events").select("event_id", F.get(found, F.lit(0))["text"].alias("span"), records.held_version(F.when(key == 1, "1.1").when(key == 2, "9")).alias("version"))


_WARNED = "SELECT event_id, event_type, CASE event_id % 5 WHEN 0 THEN 'low' WHEN 1 THEN 'medium' WHEN 2 THEN 'high' WHEN 3 THEN 'odd' END AS severity FROM {events}"


@query("check_warnings", f"SELECT * FROM ({_WARNED.format(events='events')}) WHERE severity = 'high'")
def check_warnings(spark, sf_dir):
    return records.above(spark.sql(_WARNED, events=_table(spark, sf_dir, "events")))


@query(
    "v1_quality",
    "WITH q AS (SELECT o_orderkey AS doc_id, CAST(o_orderkey % 10 AS DOUBLE) / 10 AS c, o_orderkey % 3 = 0 AS ocr, o_orderkey % 4 AS n FROM orders) SELECT doc_id, 'chapter_boundary_confidence' AS issue, 'Low confidence (' || format('{:.2f}', c) || '). Manual review recommended.' AS message FROM q WHERE c < 0.8 UNION ALL SELECT doc_id, 'ocr_used', 'OCR was used. Text quality may be lower than native text extraction.' FROM q WHERE ocr UNION ALL SELECT doc_id, 'parsing_errors', n || ' parsing error(s) encountered during processing.' FROM q WHERE n > 0",
)
def v1_quality(spark, sf_dir):
    key = F.col("o_orderkey")
    return records.quality_issues(_table(spark, sf_dir, "orders").select(key.alias("doc_id"), ((key % 10).cast("double") / 10).alias("confidence"), (key % 3 == 0).alias("ocr_used"), (key % 4).alias("parsing_errors")))


@query(
    "service_resolve",
    "SELECT o_orderkey AS id, CASE WHEN c_custkey % 3 <> 0 AND n_nationkey % 5 <> 0 THEN c_name WHEN o_orderkey % 2 = 0 THEN o_orderpriority END AS title, CASE WHEN c_custkey % 3 <> 0 AND n_nationkey % 5 <> 0 THEN c_mktsegment END AS subtitle, CASE WHEN c_custkey % 3 <> 0 AND n_nationkey % 5 <> 0 THEN NULL ELSE o_orderstatus END AS author FROM orders LEFT JOIN customer ON o_custkey = c_custkey LEFT JOIN nation ON c_nationkey = n_nationkey",
)
def service_resolve(spark, sf_dir):
    """Orders are services, customers projects; two in three customers have a book, and one in five nations leave its title blank."""
    services = _table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"), F.col("o_custkey").alias("project"), F.when(F.col("o_orderkey") % 2 == 0, F.col("o_orderpriority")).alias("book_title"), F.col("o_orderstatus").alias("author_name"))
    customers = _table(spark, sf_dir, "customer")
    projects = customers.select(F.col("c_custkey").alias("project"), F.when(F.col("c_custkey") % 3 != 0, F.col("c_custkey")).alias("book"))
    named = customers.select(F.col("c_custkey").alias("book"), F.when(F.col("c_nationkey") % 5 != 0, F.col("c_name")).otherwise("").alias("title"), F.col("c_mktsegment").alias("subtitle"), F.lit(None).cast("string").alias("author"))
    return records.resolve(services, projects, named)


@query("state_transition", "SELECT event_id, CASE event_id % 4 WHEN 0 THEN 'Processing' WHEN 1 THEN 'Complete' WHEN 2 THEN 'Failed' ELSE 'Paid' END AS status, CASE event_id % 4 WHEN 0 THEN '' WHEN 2 THEN substr(repeat(event_type, 3000), 1, 10000) END AS error_log, CASE event_id % 4 WHEN 0 THEN false END AS blocked FROM events")
def state_transition(spark, sf_dir):
    event = F.get(F.array(*map(F.lit, ("claim", "complete", "fail", "look"))), (F.col("event_id") % 4).cast("int"))
    return _table(spark, sf_dir, "events").select("event_id", records.transition(F.lit("Paid"), event, F.repeat("event_type", 3000)).alias("s")).select("event_id", "s.*")


@query(
    "h001_intake",
    f"WITH {books._TITLE}, met AS (SELECT doc_id, lower(min(line) FILTER (part = 'title')) AS t, lower(coalesce(arg_min(line, pos) FILTER (part = 'author'), '')) AS a FROM title GROUP BY doc_id), i AS (SELECT *, CASE doc_id % 4 WHEN 0 THEN 'the long road' WHEN 1 THEN 'another' ELSE '' END AS it, CASE WHEN doc_id % 5 = 0 THEN '' ELSE 'by ann lee' END AS ia FROM met) SELECT doc_id, 'used author title page; suppressed system-generated' AS decision, concat_ws(',', CASE WHEN it <> '' AND it <> t THEN 'title' END, CASE WHEN ia <> '' AND a <> '' AND ia <> a THEN 'author' END) AS differing FROM i WHERE t <> '' AND (it <> '' OR ia <> '')",
)
def h001_intake(spark, sf_dir):
    meta = structure.title_meta(structure.title_page(carriers.dressed_books(spark, sf_dir)))
    key = F.col("doc_id")
    intake = _table(spark, sf_dir, "documents").select("doc_id", F.when(key % 4 == 0, " The Long ROAD").when(key % 4 == 1, "Another").alias("title"), F.when(key % 5 == 0, "").otherwise("By Ann Lee ").alias("author"))
    return records.intake_conflicts(meta, intake)


_PARENTS = "SELECT l_orderkey AS doc_id, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey) - 1 AS idx, 'manuscript' AS type, concat('k', CAST(l_partkey AS STRING)) AS key, concat('sha256:', CAST(l_suppkey AS STRING)) AS hash, l_returnflag AS flag, l_orderkey % 6 AS sort FROM {lineitem}"


def _parents(spark, sf_dir):
    return spark.sql(_PARENTS, lineitem=_table(spark, sf_dir, "lineitem")).withColumn("idx", F.col("idx").cast("long"))


@query("lineage_chain", f"WITH p AS ({_PARENTS.format(lineitem='lineitem')}) SELECT doc_id, idx + 1 AS step, type, key, hash, false AS own FROM p UNION ALL SELECT o_orderkey, coalesce((SELECT max(idx) + 2 FROM p WHERE p.doc_id = o_orderkey), 1), 'interior_pdf', NULL, NULL, true FROM orders")
def lineage_chain(spark, sf_dir):
    return records.lineage_chain(_parents(spark, sf_dir), _table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("doc_id"), F.lit("interior_pdf").alias("type")))


@query(
    "lineage_verify",
    f"WITH p AS ({_PARENTS.format(lineitem='lineitem')}), g AS (SELECT doc_id, sort, count(*) AS n, count(*) FILTER (flag = 'R') AS bad FROM p GROUP BY ALL) SELECT doc_id, CASE sort WHEN 0 THEN NULL WHEN 1 THEN n = 1 AND 1 = 0 ELSE bad = 0 END AS valid, CASE WHEN sort IN (0, 1) THEN 0 ELSE bad END AS mismatches FROM g WHERE NOT (sort = 1 AND n = 1) UNION ALL SELECT doc_id, NULL, 0 FROM g WHERE sort = 1 AND n = 1",
)
def lineage_verify(spark, sf_dir):
    """Of every sixth artifact no parent is at hand, of others the first is missing; returned lines were modified."""
    declared = _parents(spark, sf_dir)
    actual = declared.where("sort <> 0 and not (sort = 1 and idx = 0)").withColumn("hash", F.when(F.col("flag") == "R", F.concat("hash", F.lit("x"))).otherwise(F.col("hash")))
    return records.lineage_verify(declared, actual)


_LISTED = "SELECT doc_id, ln_pos, CASE WHEN ln_pos % 5 = 4 THEN 'paragraph' ELSE 'list' END AS block_type, CASE WHEN (doc_id + ln_pos) % 3 = 0 THEN CAST(90 AS BIGINT) END AS list_group, CASE WHEN ln_pos % 2 = 0 THEN 'ordered' END AS list_type FROM {lines}"


@query(
    "v1_bare_lists",
    f"WITH b AS (SELECT doc_id, pos AS ln_pos FROM (SELECT doc_id, unnest(range({carriers.COUNT})) AS pos FROM documents)), l AS ({_LISTED.format(lines='b')}), s AS (SELECT *, block_type = 'list' AND list_group IS NULL AS bare, coalesce(lag(block_type) OVER (PARTITION BY doc_id ORDER BY ln_pos), '') AS before FROM l), n AS (SELECT *, CAST(sum(CASE WHEN bare AND before <> 'list' THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY ln_pos) AS BIGINT) AS num FROM s) SELECT doc_id, ln_pos, CASE WHEN bare THEN num ELSE list_group END AS list_group, CASE WHEN block_type = 'list' THEN coalesce(list_type, 'unordered') END AS list_type, bare AS repaired FROM n WHERE block_type = 'list'",
)
def v1_bare_lists(spark, sf_dir):
    lines = carriers.dressed_books(spark, sf_dir).select("doc_id", F.col("pos").alias("ln_pos"))
    return records.bare_lists(spark.sql(_LISTED, lines=lines)).where("block_type = 'list'").select("doc_id", "ln_pos", "list_group", "list_type", "repaired")


_CLAIMED = "SELECT doc_id, pos, CASE WHEN pos % 13 = 5 THEN 'scroll' ELSE type END AS type, CASE WHEN pos % 7 = 1 THEN NULL ELSE heading_level END AS heading_level, CASE WHEN pos % 11 = 3 THEN 'wavy' ELSE 'bold' END AS tag, CASE pos % 5 WHEN 0 THEN 'chapter_heading' WHEN 1 THEN 'back_matter' WHEN 2 THEN 'hero' END AS role, CASE WHEN pos % 2 = 0 THEN 'x' END AS title, CASE WHEN pos % 3 = 0 THEN 'y' END AS subtype FROM {rows}"
_BROKEN = f"""{books._BOOKS}, c AS ({_CLAIMED.format(rows='books')}), broken AS (SELECT doc_id, pos, 'type' AS violation FROM c WHERE type = 'scroll' UNION ALL SELECT doc_id, pos, 'role' FROM c WHERE role = 'hero' UNION ALL SELECT doc_id, pos, 'tags' FROM c WHERE tag = 'wavy'
UNION ALL SELECT doc_id, pos, 'heading_level' FROM c WHERE type = 'heading' AND heading_level IS NULL UNION ALL SELECT doc_id, pos, 'chapter_title' FROM c WHERE role = 'chapter_heading' AND title IS NULL UNION ALL SELECT doc_id, pos, 'subtype' FROM c WHERE role = 'back_matter' AND subtype IS NULL)"""


def _claimed(spark, sf_dir):
    return spark.sql(_CLAIMED, rows=carriers.dressed_books(spark, sf_dir)).withColumn("tags", F.array("tag"))


@query("schema_violations", f"WITH {_BROKEN} SELECT * FROM broken")
def schema_violations(spark, sf_dir):
    return records.violations(_claimed(spark, sf_dir))


@query("first_violations", f"WITH {_BROKEN} SELECT doc_id, pos, violation, n FROM (SELECT *, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY pos, violation) AS INT) AS n FROM broken) WHERE n <= 5")
def first_violations(spark, sf_dir):
    return records.first_violations(records.violations(_claimed(spark, sf_dir)))


@query("artifact_v2", f"WITH {books._BOOKS} SELECT doc_id, '2.2' AS schema_version, 'manuscript' AS artifact_type, count(*) AS block_count, count(*) FILTER (role = 'chapter_heading') AS chapter_count, sha256(string_agg(pos || ':' || type || ':' || text, chr(10) ORDER BY pos)) AS blocks_sha256 FROM books GROUP BY doc_id")
def artifact_v2(spark, sf_dir):
    found = records.artifacts(carriers.dressed_books(spark, sf_dir), "structure", "1.0")
    line = lambda b: F.concat_ws(":", b["pos"].cast("string"), b["type"], b["text"])
    return found.select("doc_id", "schema_version", "artifact_type", "block_count", "chapter_count", F.sha2(F.array_join(F.transform("blocks", line), "\n").cast("binary"), 256).alias("blocks_sha256"))


@query("signature_label", f"WITH {books._BOOKS} SELECT doc_id, pos, CASE WHEN type = 'heading' THEN 'Heading' || heading_level ELSE type END AS label FROM books")
def signature_label(spark, sf_dir):
    return carriers.dressed_books(spark, sf_dir).select("doc_id", "pos", records.signature_label(F.col("type"), F.col("heading_level")).alias("label"))


@query("service_attachment", "SELECT o_orderkey AS id, CASE WHEN o_orderkey % 3 <> 0 AND c_custkey % 4 <> 0 THEN 'https://files/' || c_name END AS url, CASE WHEN o_orderkey % 3 <> 0 AND c_custkey % 4 <> 0 THEN c_name || '.docx' END AS filename FROM orders LEFT JOIN customer ON o_custkey = c_custkey")
def service_attachment(spark, sf_dir):
    """Orders are services, customers manuscripts; one order in three links none, one customer in four has no file."""
    key, none = F.col("o_orderkey") % 3, F.array().cast("array<bigint>")
    links = F.when(key == 1, F.array("o_custkey")).when(key == 2, F.array(F.col("o_custkey"), F.col("o_custkey") + 1)).otherwise(none)
    file = F.struct(F.concat(F.lit("https://files/"), F.col("c_name")).alias("url"), F.concat("c_name", F.lit(".docx")).alias("filename"))
    later = F.struct(F.lit("later").alias("url"), F.lit("later").alias("filename"))
    files = F.when(F.col("c_custkey") % 4 != 0, F.array(file, later)).otherwise(F.filter(F.array(file), lambda x: F.lit(False)))
    return records.first_attachment(_table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"), links.alias("manuscripts")), _table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("manuscript"), files.alias("attachments")))


@query("required_lookups", "SELECT o_orderkey AS id, CASE WHEN missing IS NULL THEN replace(o_orderpriority, ' ', '_') END AS intake_id, CASE WHEN missing IS NULL THEN replace(o_orderstatus || '_' || o_orderpriority, ' ', '_') END AS sku, missing FROM (SELECT *, CASE WHEN o_orderkey % 5 = 0 THEN 'Project Intake Submission ID' WHEN o_orderkey % 7 = 0 THEN 'Service SKU' END AS missing FROM orders)")
def required_lookups(spark, sf_dir):
    key, none = F.col("o_orderkey"), F.lit(None).cast("string")
    intake = F.when(key % 5 == 0, F.array(F.lit(" "), none)).otherwise(F.array(none, F.concat(F.lit(" "), F.col("o_orderpriority"), F.lit(" "))))
    sku = F.when(key % 7 == 0, F.array().cast("array<string>")).otherwise(F.array(F.concat_ws("/", "o_orderstatus", "o_orderpriority"), F.lit("other")))
    return records.required_lookups(_table(spark, sf_dir, "orders").select(key.alias("id"), intake.alias("intake_ids"), sku.alias("skus")))


_STEPS = "SELECT doc_id, idx, CASE WHEN idx % 3 = 2 THEN NULL ELSE type END AS type, key, hash, flag AS version, CASE WHEN idx % 2 = 0 THEN concat('worker_', flag) END AS produced_by, concat('2026-01-0', CAST(idx + 1 AS STRING)) AS produced_at FROM {parents}"


@query(
    "lineage_text",
    f"WITH p AS ({_PARENTS.format(lineitem='lineitem')}), s AS ({_STEPS.format(parents='p')}), steps AS (SELECT doc_id, idx + 1 AS step, coalesce(type, 'unknown') AS type, version, coalesce(produced_by, 'unknown') AS who, produced_at AS moment, key FROM s UNION ALL SELECT o_orderkey, coalesce((SELECT max(idx) + 2 FROM s WHERE s.doc_id = o_orderkey), 1), 'interior_pdf', '1', 'worker_2', 'None', 'None' FROM orders) SELECT doc_id, string_agg(step || '. ' || type || ' v' || version || ' (' || who || ' @ ' || moment || ')' || chr(10) || '   → ' || key, chr(10) ORDER BY step) AS lineage FROM steps GROUP BY doc_id",
)
def lineage_text(spark, sf_dir):
    parents = spark.sql(_STEPS, parents=_parents(spark, sf_dir)).withColumn("idx", F.col("idx").cast("long"))
    own = _table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("doc_id"), F.lit("interior_pdf").alias("type"), F.lit("1").alias("version"), F.lit("worker_2").alias("produced_by"), F.lit(None).cast("string").alias("produced_at"))
    return records.lineage_text(records.lineage_chain(parents, own))


@query(
    "trace_source",
    f"WITH p AS ({_PARENTS.format(lineitem='lineitem')}) SELECT o_orderkey AS doc_id, CASE WHEN p.doc_id IS NULL AND o_orderkey % 2 = 0 THEN o_orderpriority END AS original_filename, CASE WHEN p.doc_id IS NULL AND o_orderkey % 2 = 0 THEN o_orderstatus END AS source_hash, p.key AS parent_key, p.type AS parent_type, p.hash AS parent_hash, p.doc_id IS NOT NULL OR o_orderkey % 2 = 0 AS known FROM orders LEFT JOIN p ON p.doc_id = o_orderkey AND p.idx = 0 AND o_orderkey % 3 <> 0",
)
def trace_source(spark, sf_dir):
    """Orders are artifacts; two in three have parents, and every other one has a source of its own."""
    own = F.col("o_orderkey") % 2 == 0
    made = _table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("doc_id"), F.when(own, F.col("o_orderpriority")).alias("original_filename"), F.when(own, F.col("o_orderstatus")).alias("source_hash"))
    return records.trace_source(made, _parents(spark, sf_dir).where("doc_id % 3 <> 0"))


@query("artifact_v1", f"WITH {books._BOOKS}, w AS (SELECT doc_id, count(*) AS n, CAST(sum(len(regexp_extract_all(text, '[^\\s]+'))) AS BIGINT) AS words, sha256(string_agg(pos || ':' || type || ':' || text, chr(10) ORDER BY pos)) AS digest FROM books GROUP BY doc_id) SELECT d.doc_id, '1.0' AS schema_version, d.source AS original_filename, 'en' AS language, 'ltr' AS reading_direction, coalesce(words, 0) AS word_count, coalesce(n, 0) AS block_count, CAST(0 AS BIGINT) AS chapter_count, 0.9::DOUBLE AS confidence, digest AS blocks_sha256 FROM documents d LEFT JOIN w ON w.doc_id = d.doc_id")
def artifact_v1(spark, sf_dir):
    null = F.lit(None).cast("string")
    sources = _table(spark, sf_dir, "documents").select("doc_id", F.col("source").alias("original_filename"), F.lit("docx").alias("original_format"), F.col("n_chars").alias("file_size"), records.file_hash(F.col("text")).alias("file_hash"), *(null.alias(c) for c in ("ingested_at", "run_id", "project_id", "service_id", "processed_at")))
    found = records.artifacts_v1(carriers.dressed_books(spark, sf_dir).select("doc_id", "pos", "type", "text"), sources, "structure", "1.0")
    line = lambda b: F.concat_ws(":", b["pos"].cast("string"), b["type"], b["text"])
    digest = F.sha2(F.array_join(F.transform("content.blocks", line), "\n").cast("binary"), 256)
    return found.select("doc_id", "schema_version", "source.original_filename", "content.language", "content.reading_direction", "content.stats.word_count", "content.stats.block_count", "content.stats.chapter_count", F.col("analysis.quality.chapter_boundary_confidence").cast("double").alias("confidence"), digest.alias("blocks_sha256"))


_FILES = "SELECT concat('registry/', kind, '/', CASE WHEN p_partkey % 11 = 0 THEN 'other' ELSE kind END, '.v', CAST(p_partkey % 12 AS STRING), '.', CAST(p_partkey % 2 AS STRING), '.schema.json', CASE WHEN p_partkey % 13 = 0 THEN '.bak' ELSE '' END) AS path, kind, p_partkey FROM (SELECT p_partkey, CASE p_partkey % 3 WHEN 0 THEN 'manuscript' WHEN 1 THEN 'interior_pdf' ELSE '_shared' END AS kind FROM {part}) AS kinds"


@query("latest_version", f"SELECT kind AS artifact_type, string_agg(DISTINCT version, ',' ORDER BY version) AS versions, max(version) AS latest FROM (SELECT kind, (p_partkey % 12) || '.' || (p_partkey % 2) AS version FROM ({_FILES.format(part='part')}) WHERE kind <> '_shared' AND p_partkey % 11 <> 0 AND p_partkey % 13 <> 0) GROUP BY kind")
def latest_version(spark, sf_dir):
    return records.schema_versions(spark.sql(_FILES, part=_table(spark, sf_dir, "part"))).withColumn("versions", F.array_join("versions", ","))


@query("canonical_hash", "SELECT doc_id, 'sha256:' || sha256('{\"doc_id\":' || doc_id || ',\"meta\":{\"lang\":' || to_json(lang) || ',\"none\":null,\"source\":' || to_json(source) || '},\"ratio\":' || (doc_id % 8) / 8.0 || ',\"texts\":[' || to_json(text) || ',\"\"]}') AS hash FROM documents")
def canonical_hash(spark, sf_dir):
    meta = F.struct("source", F.lit(None).cast("string").alias("none"), "lang").alias("meta")
    rows = _table(spark, sf_dir, "documents").select("doc_id", F.struct(F.array("text", F.lit("")).alias("texts"), meta, (F.col("doc_id") % 8 / 8.0).cast("double").alias("ratio"), "doc_id").alias("artifact"))
    return rows.select("doc_id", canonical.canonical_hash(F.col("artifact"), rows.schema["artifact"].dataType).alias("hash"))


@query("rule_registry", "SELECT rule, phase, place FROM (SELECT phase, unnest(string_split(ids, ' ')) AS rule, CAST(unnest(range(1, len(string_split(ids, ' ')) + 1)) AS INT) AS place FROM (VALUES ('ingest', 'R-001'), ('strip', 'N-001 N-003 N-005'), ('classify', 'C-007 C-001 C-008 C-002 C-006 C-004 C-005 C-009 C-003'), ('normalize', 'N-004'), ('validate', 'V-001 V-002 V-003 V-004 V-005 V-006'), ('emit', 'H-001')) AS phases(phase, ids))")
def rule_registry(spark, sf_dir):
    return registry.rule_table(spark)
