"""All queries over the manuscript operators, with their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire import record_queries, structure_queries
from quire.functions import ordinals, text
from quire.operators import blocks, detect, service
from quire.plans import carriers

FLAGSHIP = "structure_profile"
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}

# What the SQL sides share: lines, dressed lines with types, dressed blocks, landmarks.
_LINES = r"""raw AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS t, unnest(range(len(string_split(text, chr(10))))) AS line_no FROM documents),
lines AS MATERIALIZED (SELECT doc_id, line_no, row_number() OVER (PARTITION BY doc_id ORDER BY line_no) - 1 AS ln_pos, text FROM (SELECT doc_id, line_no, regexp_replace(t, '^\s+|\s+$', '', 'g') AS text FROM raw) WHERE text <> '')"""
_KEYWORD = " ".join(f"WHEN contains(low, '{k}') THEN '{k}'" for k in detect.KEYWORDS)
_TYPE = " ".join(f"WHEN contains(low, '{k}') THEN '{v}'" for k, v in detect.KEYWORDS.items())
_TYPED = rf"""{_LINES}, dressed AS ({carriers.DRESSED_LINES.format(lines="lines")}),
typed AS MATERIALIZED (SELECT *, CASE WHEN block_type IN ('scene_break', 'chapter_heading', 'list') THEN NULL ELSE CASE {_KEYWORD} END END AS keyword, CASE WHEN block_type = 'chapter_heading' THEN CAST(regexp_extract(text, '[0-9]+') AS BIGINT) END AS chapter_number
FROM (SELECT *, CASE WHEN regexp_matches(text, '{detect.SCENE}') THEN 'scene_break' WHEN regexp_matches(text, '{detect.CHAPTER}') THEN 'chapter_heading' WHEN regexp_matches(text, '{detect.UNORDERED}|{detect.ORDERED}') THEN 'list' {_TYPE} ELSE 'paragraph' END AS block_type FROM (SELECT *, lower(text) AS low FROM dressed)))"""
_WORDS = r"len(list_filter(regexp_split_to_array(text, '\s+'), lambda x: x <> ''))"
_NUMBERED, _FUSED, _BARE = (
    r"(?i)^(chapter|section|chap\.|letter|volume|lesson|stave|canto|scene|part|book|vol\.|act)\s+(\S+?)([.:—])?(?:\s+(.+))?$",
    r"(?i)^(chapter|section|chap\.|letter|volume|lesson|stave|canto|scene|part|book|vol\.|act)([A-Za-z0-9\-]+)[.:—]?$",
    r"(?i)^(prologue|epilogue)(?:[.:—])?(?:\s+(.+))?$",
)
_NUMS = "nums(k, roman, word) AS (VALUES " + ", ".join(f"({k}, '{r}', '{w}')" for k, r, w in zip(range(1, 16), "i ii iii iv v vi vii viii ix x xi xii xiii xiv xv".split(), "one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen".split(), strict=True)) + ")"
_BLOCKS = f"{_LINES}, blocks AS MATERIALIZED (SELECT *, string_split(tag_list, ',') AS tags FROM ({carriers.DRESSED_BLOCKS.format(lines='lines')}))"
_VALUE = "CASE WHEN regexp_matches({0}, '^[0-9]+$') THEN CAST({0} AS BIGINT) ELSE (SELECT k FROM nums WHERE roman = lower({0}) OR word = lower({0})) END"
_MARKS = rf"""{_BLOCKS}, {_NUMS},
split AS (SELECT *, regexp_extract(norm, '{_NUMBERED}', 1) AS w1, regexp_replace(regexp_extract(norm, '{_NUMBERED}', 2), '[.:—]+$', '') AS o1, regexp_extract(norm, '{_NUMBERED}', 4) AS t1, regexp_extract(norm, '{_FUSED}', 1) AS w2, regexp_extract(norm, '{_FUSED}', 2) AS o2, regexp_extract(norm, '{_BARE}', 1) AS w3, regexp_extract(norm, '{_BARE}', 2) AS t3 FROM (SELECT *, trim(regexp_replace(replace(text, chr(160), ' '), '\s+', ' ', 'g')) AS norm FROM blocks)),
valued AS (SELECT *, {_VALUE.format("o1")} AS v1, {_VALUE.format("o2")} AS v2 FROM split),
marks AS MATERIALIZED (SELECT *, CASE WHEN v1 IS NOT NULL THEN lower(w1) WHEN v2 IS NOT NULL THEN lower(w2) WHEN w3 <> '' THEN lower(w3) END AS lword, coalesce(v1, v2) AS ordinal, CASE WHEN v1 IS NOT NULL THEN o1 WHEN v2 IS NOT NULL THEN o2 END AS display,
CASE WHEN v1 IS NOT NULL THEN nullif(t1, '') WHEN v2 IS NOT NULL THEN NULL ELSE nullif(t3, '') END AS mtitle, v1 IS NULL AND v2 IS NOT NULL AS fused, CASE WHEN v1 IS NULL AND v2 IS NULL AND w3 <> '' THEN lower(w3) END AS msub FROM valued),
kinds AS MATERIALIZED (SELECT *, CASE WHEN lword IS NULL THEN NULL WHEN msub IS NOT NULL THEN 'unnumbered' WHEN rtrim(lword, '.') IN ('part', 'book', 'volume', 'vol') THEN 'part' ELSE 'chapter' END AS kind, type = 'paragraph' AND contains(tag_list, 'centered') AND contains(tag_list, 'bold') AND length(norm) <= 120 AS gated FROM marks),
strata AS MATERIALIZED (SELECT *, CASE WHEN type = 'heading' THEN 'heading:' || heading_level WHEN gated THEN 'paragraph_visual' END AS stratum FROM kinds),
votes AS MATERIALIZED (SELECT doc_id, stratum, count(*) AS n, min(pos) AS first_pos FROM strata WHERE stratum IS NOT NULL AND kind = 'chapter' GROUP BY ALL),
main AS MATERIALIZED (SELECT doc_id, stratum AS dominant FROM (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY n DESC, first_pos) AS r FROM votes) WHERE r = 1),
roles AS MATERIALIZED (SELECT s.*, CASE WHEN stratum IS NULL THEN NULL WHEN kind = 'part' THEN 'part_divider' WHEN kind = 'chapter' AND stratum = dominant THEN 'chapter_heading' WHEN kind = 'unnumbered' AND (coalesce(stratum = dominant, false) OR gated) THEN 'chapter_heading' END AS role FROM strata s LEFT JOIN main USING (doc_id))"""
_BREAKS = "SELECT doc_id, part_index, section_word, min(pos) AS defect_pos, arg_min(previous, pos) AS previous, arg_min(number, pos) AS number, CASE WHEN arg_min(number, pos) > arg_min(previous, pos) + 1 THEN 'gap' ELSE 'out of order' END AS defect FROM (SELECT *, lag(number) OVER (PARTITION BY doc_id, part_index, section_word ORDER BY pos) AS previous FROM {0}) WHERE previous IS NOT NULL AND number <> previous + 1 GROUP BY doc_id, part_index, section_word"


def query(name: str, sql: str | None):
    def add(function: Callable[[SparkSession, str], DataFrame]):
        QUERIES[name] = function
        if sql:
            ORACLE[name] = sql
        return function

    return add


def _typed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return detect.typed(carriers.dressed_lines(spark, sf_dir))


def _marked(spark: SparkSession, sf_dir: str) -> DataFrame:
    return blocks.with_strata(carriers.dressed_blocks(spark, sf_dir))


def _table(name: str):
    return lambda spark, sf_dir: spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query("txt_scan", f"WITH {_LINES} SELECT * FROM lines")
def txt_scan(spark, sf_dir):
    return carriers.lines(spark, sf_dir)


@query("block_ids", f"WITH {_LINES} SELECT doc_id, ln_pos, 'b_' || lpad(CAST(ln_pos + 1 AS VARCHAR), 6, '0') AS block_id FROM lines")
def block_ids(spark, sf_dir):
    return carriers.lines(spark, sf_dir).select("doc_id", "ln_pos", F.format_string("b_%06d", F.col("ln_pos") + 1).alias("block_id"))


@query("v1_block_type", f"WITH {_TYPED} SELECT doc_id, ln_pos, block_type, keyword, chapter_number FROM typed")
def v1_block_type(spark, sf_dir):
    return _typed(spark, sf_dir).select("doc_id", "ln_pos", "block_type", "keyword", "chapter_number")


@query("v1_list_groups", f"WITH {_TYPED} SELECT doc_id, ln_pos, list_group FROM (SELECT *, CASE WHEN block_type = 'list' THEN CAST(sum(CASE WHEN block_type = 'list' AND before IS DISTINCT FROM 'list' THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY ln_pos) AS BIGINT) END AS list_group FROM (SELECT *, lag(block_type) OVER (PARTITION BY doc_id ORDER BY ln_pos) AS before FROM typed)) WHERE list_group IS NOT NULL")
def v1_list_groups(spark, sf_dir):
    return detect.list_groups(_typed(spark, sf_dir)).where("list_group is not null").select("doc_id", "ln_pos", "list_group")


@query("v1_stats", f"WITH {_TYPED} SELECT doc_id, count(*) AS block_count, CAST(sum({_WORDS}) AS BIGINT) AS word_count, count(*) FILTER (block_type = 'chapter_heading') AS chapter_count FROM typed GROUP BY doc_id")
def v1_stats(spark, sf_dir):
    return detect.stats(_typed(spark, sf_dir))


@query("v1_source_meta", f"WITH {_TYPED} SELECT doc_id, count(*) FILTER (block_type = 'chapter_heading') AS detected_chapters, bool_or(block_type LIKE 'front_matter%' OR block_type = 'toc_marker') AS has_front_matter, bool_or(block_type LIKE 'back_matter%') AS has_back_matter, count(*) AS total_lines FROM typed GROUP BY doc_id")
def v1_source_meta(spark, sf_dir):
    return detect.source_meta(_typed(spark, sf_dir))


@query("structure_profile", f"WITH {_TYPED} SELECT doc_id, count(*) AS block_count, CAST(sum({_WORDS}) AS BIGINT) AS word_count, count(*) FILTER (block_type = 'chapter_heading') AS chapter_count, round(avg(CASE WHEN length(text) < 50 THEN 1.0::DOUBLE ELSE 0 END), 6) AS short_ratio, bool_or(block_type LIKE 'front_matter%' OR block_type = 'toc_marker') AS has_front_matter FROM typed GROUP BY doc_id")
def structure_profile(spark, sf_dir):
    return detect.profile(_typed(spark, sf_dir))


@query("role_histogram", f"WITH {_TYPED} SELECT block_type, count(*) AS n FROM typed GROUP BY block_type")
def role_histogram(spark, sf_dir):
    return detect.histogram(_typed(spark, sf_dir))


_FOUND = rf"""found AS (SELECT doc_id, count(*) AS blocks, count(*) FILTER (block_type = 'chapter_heading') AS chapters, count(*) FILTER (block_type = 'paragraph') AS paragraphs,
count(*) FILTER (regexp_matches(lower(text), '{detect.IMAGES}')) AS images, count(*) FILTER (length(text) - length(replace(text, chr(9), '')) >= 3 OR length(text) - length(replace(text, '|', '')) >= 3) AS tables, count(*) FILTER (regexp_matches(text, '{detect.FOOTNOTES}')) AS footnotes,
count(*) FILTER (block_type = 'paragraph' AND length(text) < 50) AS short, count(*) FILTER (ln_pos = first_risky OR ln_pos > first_risky AND regexp_matches(text, '^{detect.RISKY}')) AS risky, count(*) FILTER (regexp_matches(text, '^\s|\s$') AND trim(text) <> '') AS centred, count(*) FILTER (regexp_matches(text, '{detect.OCR}')) AS ocr
FROM (SELECT *, min(CASE WHEN regexp_matches(text, '{detect.RISKY}') THEN ln_pos END) OVER (PARTITION BY doc_id) AS first_risky FROM typed) GROUP BY doc_id)"""


def _detector(name: str, *codes: str) -> None:
    parts = [f"SELECT doc_id, '{code}' AS code, {severity} AS severity, {count} AS cnt FROM found WHERE {when}" for code, (severity, count, when) in detect.DETECTORS.items() if not codes or code in codes]
    query(name, f"WITH {_TYPED}, {_FOUND} {' UNION ALL '.join(parts)}")(lambda spark, sf_dir: detect.warnings(_typed(spark, sf_dir), *codes))


for _name, _codes in (("v1_warnings", ()), ("v1_images", ("DETECTED_IMAGES",)), ("v1_tables", ("DETECTED_TABLES",)), ("v1_footnotes", ("DETECTED_FOOTNOTES",)), ("v1_chapter_conf", ("LOW_CHAPTER_CONFIDENCE",)), ("v1_poem", ("POEM_LIKE_BLOCKS",)), ("v1_unicode", ("UNICODE_RISK",)), ("v1_centering", ("HEAVY_CENTERING",)), ("v1_ocr", ("OCR_QUALITY_ISSUES",))):
    _detector(_name, *_codes)


@query("word_count", f"SELECT doc_id, {_WORDS} AS words FROM documents")
def word_count(spark, sf_dir):
    return _table("documents")(spark, sf_dir).select("doc_id", text.word_count(F.col("text")).alias("words"))


_TOKENS = rf"""{_LINES}, tokens AS MATERIALIZED (SELECT doc_id, ln_pos, unnest(range(len(t))) AS tok_pos, unnest(t) AS raw FROM (SELECT doc_id, ln_pos, regexp_extract_all(text, '\S+') AS t FROM lines)),
clean AS MATERIALIZED (SELECT *, trim(raw, ' ,.;:!?()[]{{}}"''“”‘’') AS token FROM tokens), good AS MATERIALIZED (SELECT *, lower(token) AS low FROM clean WHERE regexp_matches(token, '^[A-Za-z]+(?:[-''][A-Za-z]+)*$')),
fw(w) AS (VALUES {", ".join(f"('{w}')" for w in text.FUNCTION_WORDS)})"""


def _tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = carriers.lines(spark, sf_dir).select("doc_id", "ln_pos", F.posexplode(F.regexp_extract_all("text", F.lit(r"\S+"), F.lit(0))).alias("tok_pos", "raw"))
    return rows.select("doc_id", "ln_pos", F.col("tok_pos").cast("long").alias("tok_pos"), text.stripped_token(F.col("raw")).alias("token"))


def _joined(spark: SparkSession, sf_dir: str) -> DataFrame:
    good = _tokens(spark, sf_dir).where(text.is_ascii_word(F.col("token"))).withColumn("low", F.lower("token"))
    return good.withColumn("prefix", text.function_word_prefix(F.col("low")))


_LONGEST = "(SELECT w FROM fw WHERE starts_with(low, w) AND length(low) > length(w) AND regexp_matches(substr(low, length(w) + 1, 1), '[a-z]') ORDER BY length(w) DESC LIMIT 1)"


@query("tokenize_words", f"WITH {_TOKENS} SELECT doc_id, ln_pos, tok_pos, token, regexp_matches(token, '^[A-Za-z]+(?:[-''][A-Za-z]+)*$') AS is_ascii_word FROM clean WHERE token <> ''")
def tokenize_words(spark, sf_dir):
    return _tokens(spark, sf_dir).where("token <> ''").withColumn("is_ascii_word", text.is_ascii_word(F.col("token")))


@query("function_word_prefix", f"WITH {_TOKENS}, d AS (SELECT DISTINCT low FROM good), p AS (SELECT low, max_by(w, length(w)) AS prefix FROM d JOIN fw ON starts_with(low, w) AND length(low) > length(w) AND regexp_matches(substr(low, length(w) + 1, 1), '[a-z]') GROUP BY low) SELECT low AS token, prefix, substr(low, length(prefix) + 1) AS remainder FROM p")
def function_word_prefix(spark, sf_dir):
    found = _joined(spark, sf_dir).select("low", "prefix").where("prefix is not null").distinct()
    return found.select(F.col("low").alias("token"), "prefix", F.expr("substr(low, length(prefix) + 1)").alias("remainder"))


@query("v003_space_loss", f"WITH {_TOKENS}, known AS (SELECT low FROM good GROUP BY low HAVING count(DISTINCT doc_id) >= 2), d AS (SELECT DISTINCT low FROM good), p AS (SELECT low, max_by(w, length(w)) AS prefix FROM d JOIN fw ON starts_with(low, w) AND length(low) > length(w) AND regexp_matches(substr(low, length(w) + 1, 1), '[a-z]') GROUP BY low) SELECT doc_id, ln_pos, tok_pos, token, prefix FROM good JOIN p USING (low) WHERE low NOT IN (SELECT low FROM known)")
def v003_space_loss(spark, sf_dir):
    """Tokens that start with a function word and stand in fewer than two documents, which is this corpus's dictionary."""
    rows = _joined(spark, sf_dir)
    known = rows.groupBy("low").agg(F.min("doc_id").alias("a"), F.max("doc_id").alias("b")).where("a <> b").select("low")
    return rows.where("prefix is not null").join(known, "low", "left_anti").select("doc_id", "ln_pos", "tok_pos", "token", "prefix")


@query("normalize_ws", rf"WITH {_BLOCKS} SELECT doc_id, pos, trim(regexp_replace(replace(text, chr(160), ' '), '\s+', ' ', 'g')) AS norm_text FROM blocks")
def normalize_ws(spark, sf_dir):
    return carriers.dressed_blocks(spark, sf_dir).select("doc_id", "pos", text.normalize_ws(F.col("text")).alias("norm_text"))


@query("content_hash", "SELECT doc_id, 'sha256:' || sha256(text) AS artifact_hash FROM documents")
def content_hash(spark, sf_dir):
    return _table("documents")(spark, sf_dir).select("doc_id", text.content_hash(F.col("text")).alias("artifact_hash"))


@query("versioned_key", "SELECT o_orderkey, 'services/' || o_orderkey || '/' || o_orderpriority || '/manuscript/v2.2/w1.0-r1.2/manuscript.json' AS artifact_key FROM orders")
def versioned_key(spark, sf_dir):
    return _table("orders")(spark, sf_dir).select("o_orderkey", text.versioned_key(F.col("o_orderkey").cast("string"), F.col("o_orderpriority"), "2.2", "1.0", "1.2").alias("artifact_key"))


@query("legacy_key", "SELECT o_orderkey, 'services/' || o_orderkey || '/manuscript.v1.json' AS artifact_key FROM orders")
def legacy_key(spark, sf_dir):
    return _table("orders")(spark, sf_dir).select("o_orderkey", text.legacy_key(F.col("o_orderkey").cast("string")).alias("artifact_key"))


@query("sanitize_key", "SELECT p_partkey, replace(replace(trim(p_name || ' / ' || p_partkey || ' '), '/', '_'), ' ', '_') AS key FROM part")
def sanitize_key(spark, sf_dir):
    return _table("part")(spark, sf_dir).select("p_partkey", text.sanitize_key(F.concat_ws(" ", "p_name", F.lit("/"), F.col("p_partkey").cast("string"), F.lit(""))).alias("key"))


@query("parse_ordinal", f"WITH {_NUMS} SELECT l_orderkey, l_linenumber, t.token, CAST(l_linenumber AS BIGINT) AS value, t.style FROM (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem), LATERAL (SELECT CASE l_orderkey % 3 WHEN 0 THEN CAST(l_linenumber AS VARCHAR) WHEN 1 THEN upper((SELECT roman FROM nums WHERE k = l_linenumber)) ELSE (SELECT word FROM nums WHERE k = l_linenumber) END AS token, CASE l_orderkey % 3 WHEN 0 THEN 'arabic' WHEN 1 THEN 'roman' ELSE 'words' END AS style) t")
def parse_ordinal(spark, sf_dir):
    kind = F.col("l_orderkey") % 3
    roman = F.get(F.array(*map(F.lit, "I II III IV V VI VII VIII IX X".split())), F.col("l_linenumber").cast("int") - 1)
    word = F.get(F.array(*map(F.lit, (*ordinals.UNITS, ordinals.TEENS[0]))), F.col("l_linenumber").cast("int") - 1)
    rows = _table("lineitem")(spark, sf_dir).select("l_orderkey", "l_linenumber").distinct().withColumn("token", F.when(kind == 0, F.col("l_linenumber").cast("string")).when(kind == 1, roman).otherwise(word))
    return rows.select("*", ordinals.parse_ordinal(F.col("token")).cast("long").alias("value"), ordinals.ordinal_style(F.col("token")).alias("style"))


@query("match_landmark", f"WITH {_MARKS} SELECT doc_id, pos, kind, lword AS word, ordinal, display, CASE WHEN display IS NULL THEN NULL WHEN regexp_matches(display, '^[0-9]+$') THEN 'arabic' WHEN regexp_matches(display, '(?i)^[ivxlcdm]+$') THEN 'roman' ELSE 'words' END AS style, mtitle AS title, msub AS subtype, fused FROM kinds WHERE kind IS NOT NULL")
def match_landmark(spark, sf_dir):
    return blocks.landmark_fields(carriers.dressed_blocks(spark, sf_dir))


@query("strata_counts", f"WITH {_MARKS} SELECT * FROM votes")
def strata_counts(spark, sf_dir):
    return blocks.strata_counts(_marked(spark, sf_dir))


@query("dominant_stratum", f"WITH {_MARKS} SELECT * FROM main")
def dominant_stratum(spark, sf_dir):
    return blocks.dominant_stratum(blocks.strata_counts(_marked(spark, sf_dir)))


@query("c001_landmarks", f"WITH {_MARKS} SELECT doc_id, pos, role, CASE WHEN kind <> 'unnumbered' THEN ordinal END AS number, coalesce(mtitle, CASE WHEN kind = 'unnumbered' THEN norm ELSE upper(lword[1]) || substr(lword, 2) || ' ' || display END) AS title, msub AS subtype FROM roles WHERE role IS NOT NULL")
def c001_landmarks(spark, sf_dir):
    return blocks.classify_landmarks(_marked(spark, sf_dir)).where("role is not null").select("doc_id", "pos", "role", F.col("number").cast("long").alias("number"), "title", "subtype")


@query("c001_warnings", f"WITH {_MARKS} SELECT doc_id, pos, 'fused' AS warning, 'low' AS severity, w2 || o2 AS heading, CAST(NULL AS BIGINT) AS lines FROM roles WHERE role IS NOT NULL AND fused")
def c001_warnings(spark, sf_dir):
    """Lines hold one landmark each, so none of these is ambiguous; tests hold that case."""
    return blocks.landmark_warnings(blocks.classify_landmarks(_marked(spark, sf_dir)))


@query("terminal_default", f"WITH {_MARKS} SELECT doc_id, coalesce(role, CASE type WHEN 'heading' THEN 'heading' ELSE 'body_paragraph' END) AS role, count(*) AS n FROM roles GROUP BY ALL")
def terminal_default(spark, sf_dir):
    return blocks.default_roles(blocks.classify_landmarks(_marked(spark, sf_dir))).groupBy("doc_id", "role").agg(F.count("*").alias("n"))


@query("v001_continuity", f"WITH {_MARKS}, p AS (SELECT *, CAST(sum(CASE WHEN role = 'part_divider' THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY pos) AS BIGINT) AS part_index FROM roles), c AS (SELECT doc_id, pos, part_index, rtrim(lword, '.') AS section_word, ordinal AS number FROM p WHERE role = 'chapter_heading' AND ordinal IS NOT NULL) {_BREAKS.format('c')}")
def v001_continuity(spark, sf_dir):
    return blocks.chapter_continuity(blocks.classify_landmarks(_marked(spark, sf_dir)))


@query("order_books_v001", f"WITH c AS (SELECT l_orderkey AS doc_id, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey) - 1 AS pos, CAST(0 AS BIGINT) AS part_index, 'chapter' AS section_word, CAST(l_linenumber AS BIGINT) AS number FROM lineitem) {_BREAKS.format('c')}")
def order_books_v001(spark, sf_dir):
    return blocks.chapter_continuity(blocks.classify_landmarks(blocks.with_strata(carriers.order_books(spark, sf_dir))))


@query("v004_residue", f"WITH {_BLOCKS}, r(residue) AS (VALUES {', '.join(f'({m!r})' for m in blocks.REVISION_MARKS)}) SELECT doc_id, pos, residue FROM blocks JOIN r ON contains(text, residue)")
def v004_residue(spark, sf_dir):
    return blocks.revision_residue(carriers.dressed_blocks(spark, sf_dir))


@query("n001_collapse_spaces", f"WITH {_BLOCKS} SELECT doc_id, pos, CASE WHEN preformatted THEN text ELSE regexp_replace(text, ' {{2,}}', ' ', 'g') END AS text FROM blocks")
def n001_collapse_spaces(spark, sf_dir):
    return blocks.collapse_space_runs(carriers.dressed_blocks(spark, sf_dir)).select("doc_id", "pos", "text")


@query("n001_empty_runs", f"WITH {_BLOCKS} SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY pos) - 1 AS pos, type, text FROM (SELECT *, lag(tag_list) OVER (PARTITION BY doc_id ORDER BY pos) AS before FROM blocks) WHERE NOT (tag_list = 'empty_line' AND type = 'paragraph' AND coalesce(before, '') = 'empty_line')")
def n001_empty_runs(spark, sf_dir):
    return blocks.drop_empty_runs(carriers.dressed_blocks(spark, sf_dir)).select("doc_id", "pos", "type", "text")


@query("n003_zero_width", f"WITH {_BLOCKS} SELECT doc_id, pos, CASE WHEN preformatted THEN text ELSE regexp_replace(replace(text, '​', ''), ' {{2,}}', ' ', 'g') END AS text FROM blocks")
def n003_zero_width(spark, sf_dir):
    return blocks.drop_zero_width(carriers.dressed_blocks(spark, sf_dir)).select("doc_id", "pos", "text")


@query("n005_boilerplate", f"WITH {_BLOCKS}, l AS (SELECT *, regexp_matches(text, '{blocks.LICENCE}') AS lic FROM blocks), e AS (SELECT *, coalesce(last_value(CASE WHEN lic AND type = 'heading' THEN 1 WHEN type = 'heading' AND heading_level IN (1, 2) AND NOT lic THEN 0 END IGNORE NULLS) OVER (PARTITION BY doc_id ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 0) AS held FROM l) SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY pos) - 1 AS pos, type, text FROM e WHERE NOT lic AND held = 0")
def n005_boilerplate(spark, sf_dir):
    return blocks.drop_licence(carriers.dressed_blocks(spark, sf_dir)).select("doc_id", "pos", "type", "text")


@query("n004_quotes", f"WITH {_BLOCKS} SELECT doc_id, pos, CASE WHEN preformatted THEN text ELSE array_to_string(list_transform(range(1, length(text) + 1), lambda i: CASE WHEN text[i] NOT IN ('\"', '''') THEN text[i] WHEN i = 1 OR text[i - 1] IN (' ', chr(9), chr(10), chr(13), '(', '[', '{{', '<', '—', '–', '‘', '“') THEN CASE text[i] WHEN '\"' THEN '“' ELSE '‘' END ELSE CASE text[i] WHEN '\"' THEN '”' ELSE '’' END END), '') END AS text FROM blocks")
def n004_quotes(spark, sf_dir):
    return blocks.curl_quotes(carriers.dressed_blocks(spark, sf_dir)).select("doc_id", "pos", "text")


_SERVICES = "SELECT event_id AS id, CASE event_id % 6 WHEN 0 THEN 'Paid' WHEN 1 THEN 'Processing' WHEN 2 THEN 'Complete' WHEN 3 THEN 'Void' WHEN 4 THEN 'Failed' ELSE 'Paid' END AS status, CAST(user_id % 2 AS INT) AS met, concat(event_type, CASE WHEN event_id % 5 = 0 THEN '-COVER' ELSE '-MANUSCRIPT' END) AS service_instance_id FROM {events}"


def _services(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(_SERVICES, events=_table("events")(spark, sf_dir))


@query("ready_services", f"WITH s AS ({_SERVICES.format(events='events')}) SELECT id, service_instance_id FROM s WHERE status = 'Paid' AND met = 1 AND contains(service_instance_id, '-MANUSCRIPT')")
def ready_services(spark, sf_dir):
    return service.ready(_services(spark, sf_dir)).select("id", "service_instance_id")


@query("claim_guard", f"WITH s AS ({_SERVICES.format(events='events')}) SELECT id, CASE status WHEN 'Complete' THEN 'already_complete' WHEN 'Processing' THEN 'already_processing' WHEN 'Void' THEN 'voided' ELSE 'claim' END AS decision FROM s")
def claim_guard(spark, sf_dir):
    return _services(spark, sf_dir).select("id", service.claim_decision(F.col("status")).alias("decision"))


@query("fault_threshold", "SELECT l_orderkey, count(*) FILTER (l_returnflag = 'R') AS c_faults, count(*) FILTER (l_linestatus = 'F' AND l_linenumber = 7) AS r_faults, CASE WHEN count(*) FILTER (l_linestatus = 'F' AND l_linenumber = 7) > 0 OR count(*) FILTER (l_returnflag = 'R') > 3 THEN 'Failed' ELSE 'Complete' END AS state FROM lineitem GROUP BY l_orderkey")
def fault_threshold(spark, sf_dir):
    """Returned lines stand for classification faults, finished seventh lines for rejection faults."""
    counts = _table("lineitem")(spark, sf_dir).groupBy("l_orderkey").agg(F.count_if(F.col("l_returnflag") == "R").alias("c_faults"), F.count_if((F.col("l_linestatus") == "F") & (F.col("l_linenumber") == 7)).alias("r_faults"))
    return counts.withColumn("state", service.final_state(F.col("c_faults"), F.col("r_faults")))

for _more in (structure_queries, record_queries):
    QUERIES |= _more.QUERIES
    ORACLE |= _more.ORACLE
