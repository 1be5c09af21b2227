"""Queries over the structure rules, with their SQL; the rules run on dressed books, one at a time and all in order."""

from __future__ import annotations

from pyspark.sql import functions as F

from quire.functions.landmarks import CHAPTER_WORDS, PART_WORDS
from quire.operators import blocks, structure
from quire.plans import carriers

_WORD = "|".join(sorted((w.replace(".", r"\.") for w in CHAPTER_WORDS + PART_WORDS), key=lambda w: (-len(w), w)))
_NUMS = "nums(k, roman, word) AS (VALUES " + ", ".join(f"({k}, '{r}', '{w}')" for k, r, w in zip(range(1, 11), "i ii iii iv v vi vii viii ix x".split(), "one two three four five six seven eight nine ten".split(), strict=True)) + ")"
_BOOKS = rf"""cut0 AS (SELECT doc_id, text, {carriers.SIZE} AS size, unnest(range({carriers.COUNT})) AS pos FROM documents), pieces AS ({carriers.PIECES} FROM cut0),
books AS MATERIALIZED (SELECT *, trim(regexp_replace(replace(text, chr(160), ' '), '\s+', ' ', 'g')) AS norm FROM ({carriers.DRESSED_BOOKS.format(pieces="pieces")})),
b AS MATERIALIZED (SELECT *, norm <> '' AS content, coalesce(role IN ('chapter_heading', 'part_divider'), false) AS landmark, role IS NULL AND type IN ('paragraph', 'heading') AS free, regexp_matches(norm, '[\p{{L}}\p{{N}}]') AS alnum, length(norm) AS size FROM books)"""
_VALUE = "CASE WHEN regexp_matches({0}, '^[0-9]+$') THEN nullif(CAST({0} AS BIGINT), 0) ELSE (SELECT k FROM nums WHERE roman = lower({0}) OR word = lower({0})) END"

QUERIES: dict = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str):
    def add(function):
        QUERIES[name], ORACLE[name] = function, sql
        return function

    return add


def _roles(rows, *more):
    return rows.where("role is not null and role not in ('chapter_heading')").select("doc_id", "pos", "role", "subtype", *more)


def _books(spark, sf_dir):
    return carriers.dressed_books(spark, sf_dir)


@query("dressed_books", f"WITH {_BOOKS} SELECT doc_id, pos, type, heading_level, text, tag_list, role FROM books")
def dressed_books(spark, sf_dir):
    return _books(spark, sf_dir).select("doc_id", "pos", "type", "heading_level", "text", F.array_join("tags", ",").alias("tag_list"), "role")


@query(
    "c006_subtitle",
    f"""WITH {_BOOKS}, f AS (SELECT *, lag(landmark) OVER w AS up, lag(type) OVER w AS up_type, lag(heading_level) OVER w AS up_level FROM b WHERE content AND NOT (type = 'paragraph' AND contains(tag_list, 'empty_line')) WINDOW w AS (PARTITION BY doc_id ORDER BY pos))
SELECT * FROM (SELECT doc_id, pos, 'chapter_subtitle' AS role, CAST(NULL AS VARCHAR) AS subtype, CASE WHEN contains(tag_list, 'italic') THEN 'italic' WHEN contains(tag_list, 'centered') THEN 'centered' WHEN type = 'heading' AND up_type = 'heading' AND coalesce(heading_level, 0) > coalesce(up_level, 0) THEN 'level' END AS gate FROM f WHERE up AND free AND size <= 120 AND alnum) WHERE gate IS NOT NULL""",
)
def c006_subtitle(spark, sf_dir):
    return _roles(structure.subtitles(_books(spark, sf_dir)), "gate")


_LABEL = "lower(trim(regexp_extract(trim(text), '(?i){0}', 2)))"


@query(
    "c004_front",
    rf"""WITH {_BOOKS}, c AS (SELECT doc_id, min(pos) FILTER (landmark) AS cut, min(pos) FILTER (content) AS head FROM b GROUP BY doc_id), s AS (SELECT *, CASE WHEN raw LIKE 'note%' OR raw LIKE 'to the reader%' THEN 'note_to_reader' WHEN raw <> '' THEN raw ELSE 'generic' END AS sub FROM (SELECT *, {_LABEL.format(structure.FRONT)} AS raw FROM b JOIN c USING (doc_id) WHERE role IS NULL AND type = 'heading' AND heading_level = 1 AND pos < cut))
SELECT doc_id, pos, 'front_matter' AS role, sub AS subtype FROM s WHERE NOT (sub = 'generic' AND pos = head)""",
)
def c004_front(spark, sf_dir):
    return _roles(structure.front_matter(_books(spark, sf_dir)))


@query(
    "c005_back",
    rf"""WITH {_BOOKS}, c AS (SELECT doc_id, max(pos) AS cut FROM b WHERE role = 'chapter_heading' GROUP BY doc_id)
SELECT doc_id, pos, 'back_matter' AS role, CASE WHEN raw = 'about the author' THEN 'about_the_author' WHEN raw IN ('acknowledgments', 'acknowledgment') THEN 'acknowledgments' WHEN raw <> '' THEN raw ELSE 'generic' END AS subtype FROM (SELECT *, {_LABEL.format(structure.BACK)} AS raw FROM b JOIN c USING (doc_id) WHERE role IS NULL AND type = 'heading' AND heading_level = 1 AND pos > cut)""",
)
def c005_back(spark, sf_dir):
    return _roles(structure.back_matter(_books(spark, sf_dir)))


@query(
    "c009_front_shapes",
    rf"""WITH {_BOOKS}, r AS (SELECT *, free AND content AND regexp_matches(norm, '(?i){structure.COPYRIGHT}') AS rights, count(*) FILTER (content) OVER (PARTITION BY doc_id ORDER BY pos) AS rank, lead(norm, 1) OVER (PARTITION BY doc_id ORDER BY pos) AS n1, lead(norm, 2) OVER (PARTITION BY doc_id ORDER BY pos) AS n2 FROM b),
s AS (SELECT doc_id, coalesce(min(pos) FILTER (landmark OR size >= 200 AND NOT rights), 1000000) AS stop, coalesce(min(pos) FILTER (landmark OR size >= 200), 1000000) AS region FROM r GROUP BY doc_id),
n AS (SELECT doc_id, norm, count(*) AS times FROM r JOIN s USING (doc_id) WHERE content AND pos < region GROUP BY ALL),
o AS (SELECT r.*, coalesce(times, 0) AS times, NOT rights AND size < 200 AND free AND alnum AS open FROM r JOIN s USING (doc_id) LEFT JOIN n USING (doc_id, norm) WHERE content AND pos < stop),
h AS (SELECT doc_id, norm, min(pos) AS first_pos FROM o WHERE open GROUP BY ALL),
x AS (SELECT o.*, first_pos, CASE WHEN n1 <> '' THEN n1 ELSE coalesce(n2, '') END AS follows FROM o LEFT JOIN h USING (doc_id, norm))
SELECT doc_id, pos, 'front_matter' AS role, subtype FROM (SELECT doc_id, pos, CASE WHEN rights THEN 'copyright' WHEN open AND times >= 2 AND pos = first_pos THEN 'half_title' WHEN open AND rank > 1 AND regexp_matches(norm, '(?i){structure.DEDICATION}') THEN 'dedication'
WHEN open AND (norm[1] IN ('"', '“', '‘', '«', '''') OR norm[-1] IN ('"', '”', '’', '»') OR length(follows) < 200 AND regexp_matches(follows, '{structure.ATTRIBUTION}')) THEN 'epigraph' END AS subtype FROM x) WHERE subtype IS NOT NULL""",
)
def c009_front_shapes(spark, sf_dir):
    return _roles(structure.front_shapes(_books(spark, sf_dir)))


_TITLE = rf"""{_BOOKS}, t AS (SELECT *, count(*) FILTER (content) OVER (PARTITION BY doc_id ORDER BY pos) AS rank, type = 'paragraph' AND role IS NULL AND size >= 200 AS long FROM b),
p AS (SELECT *, long AND coalesce(lag(long) OVER (PARTITION BY doc_id ORDER BY pos), false) AND pos < 40 AS pair FROM t),
e AS (SELECT doc_id, least(coalesce(min(pos) FILTER (pair) - 1, 40), coalesce(min(pos) FILTER (landmark AND content), 40), 40) AS stop FROM p GROUP BY doc_id),
k AS (SELECT p.*, CAST(contains(tag_list, 'centered') AS INT) + CAST(contains(tag_list, 'large_font') AS INT) AS styled, pos - lag(pos) OVER (PARTITION BY doc_id ORDER BY pos) AS gap FROM p JOIN e USING (doc_id) WHERE pos < stop AND content AND free AND size < 200 AND alnum),
q AS (SELECT *, styled + CAST(type = 'heading' AND heading_level <= 2 AS INT) + CAST(rank <= 8 AS INT) >= 2 AS fit FROM k),
a AS (SELECT *, min(CASE WHEN fit THEN pos END) OVER (PARTITION BY doc_id) AS start FROM q),
z AS (SELECT *, coalesce(min(CASE WHEN pos > start AND (NOT fit OR gap > 3) THEN pos END) OVER (PARTITION BY doc_id), 1000000) AS brk, regexp_matches(norm, '(?i){structure.BYLINE}') AS byline, regexp_matches(norm, '{structure.NAME.replace("'", "''")}') AS named FROM a),
m AS MATERIALIZED (SELECT *, NOT fit AS near FROM z WHERE fit AND pos < brk OR NOT fit AND pos = brk AND gap = 1 AND (byline OR named)),
title AS MATERIALIZED (SELECT doc_id, pos, trim(text) AS line, CASE WHEN pos = start THEN 'title' WHEN near THEN 'author' WHEN contains(tag_list, 'large_font') OR type = 'heading' THEN 'subtitle' WHEN byline OR named AND NOT regexp_matches(upper(rtrim(norm, '.')), '^[IVXLCDM]+$') THEN 'author' ELSE 'subtitle' END AS part, bool_or(fit AND styled > 0) OVER (PARTITION BY doc_id) AS by_tag FROM m)"""


@query("c003_members", f"WITH {_TITLE} SELECT doc_id, pos, 'title_page' AS role, CAST(NULL AS VARCHAR) AS subtype, part, by_tag FROM title")
def c003_members(spark, sf_dir):
    return _roles(structure.title_page(_books(spark, sf_dir)), "part", "by_tag")


@query("c003_meta", f"WITH {_TITLE} SELECT doc_id, min(line) FILTER (part = 'title') AS title, string_agg(line, ' ' ORDER BY pos) FILTER (part = 'subtitle') AS subtitle, arg_min(line, pos) FILTER (part = 'author') AS author, CASE WHEN bool_or(by_tag) THEN 'tag path' ELSE 'position/shape path' END AS mechanism FROM title GROUP BY doc_id")
def c003_meta(spark, sf_dir):
    return structure.title_meta(structure.title_page(_books(spark, sf_dir)))


_TOC = rf"""{_BOOKS}, {_NUMS}, i AS (SELECT doc_id, pos, unnest(range(len(w))) AS n, unnest(w) AS word, unnest(t) AS token, rest, whole FROM (SELECT doc_id, pos, regexp_extract_all(norm, '(?i)\b({_WORD})\s+([A-Za-z0-9\-]+)', 1) AS w, regexp_extract_all(norm, '(?i)\b({_WORD})\s+([A-Za-z0-9\-]+)', 2) AS t, length(regexp_replace(regexp_replace(norm, '(?i)\b({_WORD})\s+([A-Za-z0-9\-]+)', '', 'g'), '[^\p{{L}}\p{{N}}]', '', 'g')) AS rest, length(regexp_replace(norm, '[^\p{{L}}\p{{N}}]', '', 'g')) AS whole FROM b WHERE pos < 80 AND type IN ('paragraph', 'heading') AND content)),
ia AS (SELECT doc_id, pos, lower(word) AS word, {_VALUE.format("token")} AS ordinal, n, rest, whole FROM i),
ib AS MATERIALIZED (SELECT doc_id, pos, row_number() OVER (PARTITION BY doc_id, pos ORDER BY n) - 1 AS entry_no, word, ordinal FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, pos) AS k FROM ia WHERE ordinal IS NOT NULL) WHERE k >= 3 AND rest <= 0.2 * whole),
s AS (SELECT doc_id, pos, norm, type, (doc_id, pos) IN (SELECT (doc_id, pos) FROM ib) AS inline, regexp_extract(norm, '(?i)^({_WORD})\s*(\S+?)[.:—]?$', 1) AS w, regexp_replace(regexp_extract(norm, '(?i)^({_WORD})\s*(\S+?)[.:—]?$', 2), '[.:—]+$', '') AS o, size FROM b WHERE content AND NOT contains(tag_list, 'empty_line') AND pos < 80),
v AS (SELECT *, {_VALUE.format("o")} AS ordinal, lower(w) AS word FROM s), c AS (SELECT *, type = 'paragraph' AND size <= 80 AND NOT inline AND ordinal IS NOT NULL AS bare FROM v),
r AS (SELECT *, sum(CASE WHEN bare THEN 0 ELSE 1 END) OVER (PARTITION BY doc_id ORDER BY pos) AS run, NOT coalesce(lag(bare) OVER (PARTITION BY doc_id ORDER BY pos), false) OR ordinal >= lag(ordinal) OVER (PARTITION BY doc_id ORDER BY pos) OR word <> lag(word) OVER (PARTITION BY doc_id ORDER BY pos) AS sound FROM c),
g AS (SELECT *, bare AND count(*) FILTER (bare) OVER (PARTITION BY doc_id, run) >= 3 AND bool_and(sound) FILTER (bare) OVER (PARTITION BY doc_id, run) AS listed FROM r),
l AS MATERIALIZED (SELECT *, regexp_matches(norm, '(?i){structure.CONTENTS}') AND coalesce(lead(inline OR listed) OVER (PARTITION BY doc_id ORDER BY pos), false) AS label FROM g)"""


@query("c007_contents", f"WITH {_TOC} SELECT doc_id, pos, 'structural' AS role, 'source_toc' AS subtype FROM l WHERE inline OR listed OR label")
def c007_contents(spark, sf_dir):
    return _roles(structure.source_contents(_books(spark, sf_dir).drop("role")))


@query("toc_entries", f"WITH {_TOC} SELECT * FROM ib UNION ALL SELECT doc_id, pos, 0 AS entry_no, word, ordinal FROM l WHERE listed")
def toc_entries(spark, sf_dir):
    return structure.contents_entries(structure.source_contents(_books(spark, sf_dir).drop("role")))


_PATTERN = rf"""{_BOOKS}, {_NUMS}, u AS (SELECT *, len(list_filter(regexp_split_to_array(text, '\s+'), lambda x: x <> '')) AS words, bool_or(landmark) OVER (PARTITION BY doc_id) AS marked FROM b), uu AS (SELECT *, sum(words) OVER (PARTITION BY doc_id ORDER BY pos) AS upto FROM u WHERE NOT marked),
w AS (SELECT *, lower(rtrim(regexp_extract(norm, '(?i)^({_WORD})\s*(\S+?)([.:—]?|[.:—]?\s.+)$', 1), '.')) AS word, regexp_replace(regexp_extract(norm, '(?i)^({_WORD})\s*(\S+?)([.:—]?|[.:—]?\s.+)$', 2), '[.:—]+$', '') AS o FROM uu WHERE free AND content AND size <= 80),
c AS (SELECT doc_id, pos, CASE WHEN word IN ('part', 'book', 'volume', 'vol') THEN 'part' ELSE 'chapter' END AS kind, word, {_VALUE.format("o")} AS number, upto, words FROM w WHERE word <> ''),
d AS (SELECT *, CASE WHEN upto - words - lag(upto) OVER (PARTITION BY doc_id ORDER BY pos) >= 50 OR lag(upto) OVER (PARTITION BY doc_id ORDER BY pos) IS NULL THEN 1 ELSE 0 END AS apart FROM c WHERE number IS NOT NULL),
cl AS (SELECT *, sum(apart) OVER (PARTITION BY doc_id ORDER BY pos) AS island FROM d), cand AS MATERIALIZED (SELECT doc_id, pos, kind, word, number, count(*) OVER (PARTITION BY doc_id, island) AS cluster FROM cl)"""


@query("c008_candidates", f"WITH {_PATTERN} SELECT * FROM cand")
def c008_candidates(spark, sf_dir):
    return structure.pattern_candidates(_books(spark, sf_dir))


_SEQUENCE = f"""{_PATTERN}, alone AS (SELECT * FROM cand WHERE cluster = 1), seq AS (SELECT *, lag(pos) OVER w AS p0, lag(number) OVER w AS n0, count(*) OVER (PARTITION BY doc_id, kind, word) AS n FROM alone WINDOW w AS (PARTITION BY doc_id, kind, word ORDER BY pos)),
piv AS (SELECT s.*, CASE WHEN kind = 'chapter' AND number <= n0 THEN (SELECT min(pos) FROM alone q WHERE q.doc_id = s.doc_id AND q.kind = 'part' AND q.pos > s.p0 AND q.pos < s.pos) END AS turn FROM seq s), ok AS (SELECT *, n >= 3 AND bool_and(coalesce(number > n0, true) OR turn IS NOT NULL) OVER (PARTITION BY doc_id, kind, word) AS whole FROM piv),
dec AS MATERIALIZED (SELECT c.doc_id, c.pos, c.kind, c.word, c.number, CASE WHEN c.cluster >= 3 THEN 'contents' WHEN c.cluster > 1 THEN 'excluded' WHEN o.whole OR c.kind = 'part' AND (c.doc_id, c.pos) IN (SELECT (doc_id, turn) FROM ok WHERE whole AND turn IS NOT NULL) THEN 'promoted' ELSE 'left' END AS decision FROM cand c LEFT JOIN ok o USING (doc_id, pos))"""


@query("c008_promote", f"WITH {_SEQUENCE} SELECT * FROM dec")
def c008_promote(spark, sf_dir):
    return structure.pattern_landmarks(_books(spark, sf_dir))


@query("v006_pattern_only", f"WITH {_SEQUENCE} SELECT doc_id, count(*) AS landmarks, string_agg(DISTINCT word, ',' ORDER BY word) AS classes FROM dec WHERE decision = 'promoted' GROUP BY doc_id")
def v006_pattern_only(spark, sf_dir):
    return structure.pattern_warnings(structure.promote_patterns(_books(spark, sf_dir)))


@query(
    "c002_repeated_titles",
    rf"""WITH {_BOOKS}, x AS (SELECT *, doc_id % 6 <> 5 AND role IS NULL AND type = 'heading' AND coalesce(heading_level, 0) < 2 AS cand, CASE WHEN role IS NOT NULL THEN 'stop' WHEN regexp_matches(text, 'VOL\. 2$') THEN 'part' WHEN regexp_matches(norm, '^(Chapter|Letter|Canto|Book) \S+$') THEN 'stop' ELSE 'pass' END AS what FROM b WHERE content),
f AS (SELECT *, cand AND count(*) OVER (PARTITION BY doc_id, norm, cand) >= 2 AS rep, list_filter([lead(what, 1) OVER w, lead(what, 2) OVER w, lead(what, 3) OVER w], lambda z: z <> 'pass')[1] AS hit FROM x WINDOW w AS (PARTITION BY doc_id ORDER BY pos)),
y AS (SELECT *, bool_or(rep AND coalesce(hit = 'part', false)) OVER (PARTITION BY doc_id) AS any_hit FROM f)
SELECT doc_id, pos, 'part_divider' AS role, CAST(NULL AS VARCHAR) AS subtype, CASE WHEN hit = 'part' THEN CAST(2 AS BIGINT) END AS part_number FROM y WHERE rep AND (coalesce(hit = 'part', false) OR NOT any_hit)""",
)
def c002_repeated_titles(spark, sf_dir):
    rows = _books(spark, sf_dir).withColumn("dominant", F.when(F.col("doc_id") % 6 != 5, "heading:2"))
    return _roles(structure.repeated_titles(rows).withColumn("part_number", F.col("part_number").cast("long")), "part_number")


# Sections, over roles that a rule on positions gives.
_MATTER = "SELECT doc_id, pos, CASE (doc_id + pos) % 9 WHEN 0 THEN 'title_page' WHEN 1 THEN 'title_page' WHEN 2 THEN 'front_matter' WHEN 3 THEN 'front_matter' WHEN 4 THEN 'back_matter' WHEN 5 THEN 'structural' ELSE 'body_paragraph' END AS role, CASE (doc_id + pos) % 9 WHEN 2 THEN 'Generic' WHEN 3 THEN CASE WHEN doc_id % 2 = 0 THEN 'unheard' ELSE 'copyright' END WHEN 4 THEN CASE doc_id % 3 WHEN 0 THEN 'acknowledgments' WHEN 1 THEN 'about_the_author' ELSE 'index' END WHEN 5 THEN CASE WHEN doc_id % 2 = 0 THEN 'source_toc' ELSE 'rule' END END AS subtype FROM {rows}"
_CLASS = "CASE role WHEN 'title_page' THEN 'title_page' WHEN 'front_matter' THEN CASE lower(subtype) WHEN 'copyright' THEN 'copyright_page' ELSE 'unknown_front' END WHEN 'back_matter' THEN CASE subtype WHEN 'acknowledgments' THEN 'acknowledgements' WHEN 'about_the_author' THEN 'about_the_author' END WHEN 'structural' THEN CASE subtype WHEN 'source_toc' THEN 'toc_authorial' END END"


def _matter(spark, sf_dir):
    return spark.sql(_MATTER, rows=_books(spark, sf_dir))


@query(
    "front_matter_elements",
    f"""WITH {_BOOKS}, m AS (SELECT *, {_CLASS} AS class FROM ({_MATTER.format(rows="books")})), i AS (SELECT *, pos - row_number() OVER (PARTITION BY doc_id, class ORDER BY pos) AS island FROM m WHERE class IS NOT NULL), e AS (SELECT doc_id, class, min(pos) AS first_pos, max(pos) AS last_pos FROM i GROUP BY doc_id, class, island)
SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY first_pos) - 1 AS element_no, class, first_pos, last_pos, CASE class WHEN 'unknown_front' THEN 'low' ELSE 'high' END AS confidence FROM e""",
)
def front_matter_elements(spark, sf_dir):
    return structure.matter_sections(_matter(spark, sf_dir))


@query("front_matter_carried", f"WITH {_BOOKS}, m AS (SELECT *, {_CLASS} AS class FROM ({_MATTER.format(rows='books')})) SELECT doc_id, coalesce(string_agg(DISTINCT class, ',' ORDER BY class) FILTER (class <> 'unknown_front'), '') AS carried FROM m GROUP BY doc_id")
def front_matter_carried(spark, sf_dir):
    return structure.carried(_matter(spark, sf_dir))


_SIGNED = "SELECT *, CAST(CASE WHEN role = 'chapter_heading' AND pos % 5 = 0 THEN 3 ELSE heading_level END AS INT) AS level FROM {rows}"


@query("v002_signature", f"WITH {_BOOKS}, c AS (SELECT doc_id, pos, CASE WHEN type = 'heading' THEN 'Heading' || level ELSE type END AS signature FROM ({_SIGNED.format(rows='books')}) WHERE role = 'chapter_heading'), m AS (SELECT doc_id, signature AS main FROM (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY n DESC, f) AS r FROM (SELECT doc_id, signature, count(*) AS n, min(pos) AS f FROM c GROUP BY ALL)) WHERE r = 1) SELECT doc_id, pos, signature FROM c JOIN m USING (doc_id) WHERE signature <> main")
def v002_signature(spark, sf_dir):
    """Chapters of some places have another level than the others."""
    rows = spark.sql(_SIGNED, rows=carriers.dressed_books(spark, sf_dir))
    return blocks.signature_deviants(rows.withColumn("heading_level", F.col("level")))


_WORDS = r"len(list_filter(regexp_split_to_array(text, '\s+'), lambda x: x <> ''))"


@query("v005_zero_structure", f"WITH {_BOOKS} SELECT doc_id, count(*) AS block_count, CAST(sum({_WORDS}) AS BIGINT) AS word_count, count(*) > 50 AND sum({_WORDS}) > 5000 AND count(*) FILTER (role IN ('chapter_heading', 'part_divider')) = 0 AS fires FROM books GROUP BY doc_id")
def v005_zero_structure(spark, sf_dir):
    return blocks.zero_structure(carriers.dressed_books(spark, sf_dir))


def classify_all(spark, sf_dir):
    """Every classifying rule in order, then the default roles, with title and numbers."""
    rows = structure.classify(blocks.drop_licence(blocks.drop_empty_runs(_books(spark, sf_dir).drop("role"))))
    return rows.select("doc_id", "pos", "role", "subtype", F.col("number").cast("long").alias("number"), "title")


QUERIES["classify_all"] = classify_all
