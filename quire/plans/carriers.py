"""Relations that carry the manuscript rules: lines of documents, dressed with features by position, and books of orders.

The dressings are plain SQL that Spark and an oracle read alike; only the scan of lines below them differs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.sources.text import scan_lines

#: Lines, some of them with a mark of chapter, list, scene, front or back matter, image, note or scan error in front.
DRESSED_LINES = """SELECT doc_id, ln_pos, CASE (doc_id + ln_pos) % 17 WHEN 0 THEN concat('Chapter ', CAST(ln_pos + 1 AS STRING), ' ', text) WHEN 1 THEN concat('- ', text)
WHEN 2 THEN concat('* ', text) WHEN 3 THEN concat('1) ', text) WHEN 4 THEN '* * *' WHEN 5 THEN concat('About the Author ', text) WHEN 6 THEN concat('Copyright ', text)
WHEN 7 THEN concat('l ', text) WHEN 8 THEN concat('[Figure] ', text) WHEN 9 THEN concat('[12] ', text) WHEN 10 THEN concat('\u2020', ' a ', '\u2022') ELSE text END AS text FROM {lines}"""

#: Blocks: headings with ordinals of three kinds (in digits beyond 15), centred captions, empty lines, spaces, quotes, licences, residue and verbatim text.
DRESSED_BLOCKS = """SELECT doc_id, pos, type, CASE WHEN type = 'heading' THEN CAST(1 + CASE WHEN slot = 0 THEN doc_id % 3 ELSE 3 END AS INT) END AS heading_level,
CASE WHEN empty_line THEN '' WHEN slot = 0 AND doc_id % 10 = 9 AND pos = 0 THEN 'The Project Gutenberg eBook of nothing'
WHEN slot = 0 AND (doc_id + n) % 11 = 4 THEN 'Epilogue. The end' WHEN slot = 0 AND (doc_id + n) % 7 = 3 THEN concat('BOOK ', coalesce(roman, CAST(n AS STRING))) WHEN slot = 0 AND doc_id % 4 = 0 THEN concat('Chapter ', CAST(n + doc_id % 2 AS STRING))
WHEN slot = 0 AND doc_id % 4 = 1 THEN concat('CHAPTER ', coalesce(roman, CAST(n AS STRING)), '. The  title') WHEN slot = 0 AND doc_id % 4 = 2 THEN concat('Stave', '\u00a0', coalesce(word, CAST(n AS STRING)), '.') WHEN slot = 0 THEN concat('Letter', CAST(n * n AS STRING))
WHEN slot = 1 AND doc_id % 5 = 0 THEN concat('Chapter ', coalesce(word, CAST(n AS STRING))) WHEN slot = 4 THEN concat('He said "', text, '"  (''so'')') WHEN slot = 5 AND doc_id % 6 = 0 THEN concat('a <w:ins b ', '\u2040') WHEN slot = 6 THEN concat('x', '\u200b', '\u00a0', '\u00a0', 'y ', text) ELSE text END AS text,
CASE WHEN empty_line THEN 'empty_line' WHEN slot = 1 AND doc_id % 5 = 0 THEN 'centered,bold' ELSE '' END AS tag_list, slot IN (4, 6) AND doc_id % 5 = 1 AS preformatted
FROM (SELECT doc_id, ln_pos AS pos, text, CAST(ln_pos % 7 AS INT) AS slot, ln_pos % 7 IN (2, 3) AND doc_id % 3 = 1 AS empty_line, CASE WHEN ln_pos % 7 = 0 OR ln_pos % 14 = 12 THEN 'heading' ELSE 'paragraph' END AS type, CAST(floor(ln_pos / 7) AS BIGINT) + 1 AS n FROM {lines}) AS base
LEFT JOIN (VALUES (1, 'I', 'One'), (2, 'II', 'Two'), (3, 'III', 'Three'), (4, 'IV', 'Four'), (5, 'V', 'Five'), (6, 'VI', 'Six'), (7, 'VII', 'Seven'), (8, 'VIII', 'Eight'), (9, 'IX', 'Nine'), (10, 'X', 'Ten'), (11, 'XI', 'Eleven'), (12, 'XII', 'Twelve'), (13, 'XIII', 'Thirteen'), (14, 'XIV', 'Fourteen'), (15, 'XV', 'Fifteen')) AS nums(k, roman, word) ON k = n"""

#: Pieces of texts, eight blank rows before them and two before each piece.
PIECES = """SELECT doc_id, CAST(pos AS BIGINT) AS pos, CASE WHEN pos >= 8 AND (pos - 8) % 3 = 2 THEN substr(text, CAST(floor((pos - 8) / 3) AS INT) * size + 1, size) ELSE '' END AS piece"""
SIZE = "CAST(150 AS INT)"
COUNT = f"CAST(8 + 3 * ceil(length(coalesce(text, '')) / (1.0 * {SIZE})) AS INT)"

#: Books of six kinds: title pages, contents, front and back matter, chapters, subtitles, repeated titles, labels without style.
DRESSED_BOOKS = """SELECT doc_id, pos, type, CASE WHEN type = 'heading' THEN CAST(CASE WHEN pos < 8 OR slot = 0 AND j % 4 <> 0 THEN 1 WHEN slot = 0 THEN 2 ELSE 3 END AS INT) END AS heading_level, text,
CASE WHEN text = '' THEN 'empty_line' WHEN pos = 0 AND v IN (0, 1) THEN 'centered,large_font' WHEN pos < 8 AND v IN (0, 1, 3) THEN 'centered' WHEN pos >= 8 AND slot = 1 AND v = 0 THEN 'italic' WHEN pos >= 8 AND slot = 1 AND v = 4 THEN 'centered' ELSE '' END AS tag_list,
CASE WHEN type = 'heading' AND slot = 0 AND j % 4 = 0 AND pos >= 8 THEN 'chapter_heading' END AS role
FROM (SELECT doc_id, pos, v, j, slot, CASE WHEN pos = 0 AND v IN (2, 4) THEN 'heading' WHEN pos >= 8 AND slot = 0 AND v <> 5 AND j % 2 = 0 THEN 'heading' WHEN pos >= 8 AND slot = 0 AND v IN (1, 3) THEN 'heading' WHEN pos >= 8 AND slot = 1 AND v = 1 THEN 'heading' ELSE 'paragraph' END AS type,
CASE WHEN pos < 8 THEN CASE
 WHEN pos = 0 THEN CASE v WHEN 4 THEN 'Preface' WHEN 5 THEN 'Table of  Contents' ELSE 'The Long Road' END
 WHEN pos = 1 THEN CASE v WHEN 0 THEN 'by Ann Lee' WHEN 3 THEN concat('© 2020 Ann Lee ', CASE WHEN doc_id % 4 = 3 THEN repeat('and others ', 30) ELSE '' END) WHEN 4 THEN 'CONTENTS.' ELSE '' END
 WHEN pos = 2 THEN CASE v WHEN 0 THEN 'For everyone who left' WHEN 1 THEN 'A Novel' WHEN 2 THEN 'Ann Lee' WHEN 3 THEN 'The Long Road' WHEN 4 THEN 'Letter 1 Letter II, Chapter 3; Chapter One' ELSE 'Letter 1' END
 WHEN pos = 3 THEN CASE v WHEN 0 THEN '“Nothing stays”' WHEN 1 THEN 'MCMXX.' WHEN 2 THEN 'All things pass' WHEN 3 THEN 'Being a true account of it' WHEN 4 THEN 'As said in chapter 1 and chapter 2, not in part 3, it rained' ELSE 'Letter 2' END
 WHEN pos = 4 THEN CASE v WHEN 1 THEN 'To my mother' WHEN 2 THEN concat('—', ' Old Song') WHEN 5 THEN CASE WHEN doc_id % 4 = 1 THEN 'Letter 1' ELSE 'Letter 2' END ELSE '' END
 WHEN pos = 5 THEN CASE v WHEN 1 THEN 'Mary Lee' WHEN 3 THEN '* * *' WHEN 5 THEN 'Chapter 1' ELSE '' END ELSE '' END
ELSE CASE
 WHEN slot = 2 THEN piece
 WHEN slot = 0 AND j % 4 = 0 THEN CASE WHEN v = 5 THEN concat('Letter ', CAST(CAST(floor(j / 4) AS INT) % 3 + 1 AS STRING)) ELSE concat('Chapter ', CAST(CAST(floor(j / 4) AS INT) + 1 AS STRING)) END
 WHEN slot = 0 AND j % 4 = 1 AND v IN (1, 3) THEN 'The Long Road'
 WHEN slot = 0 AND j % 12 = 11 AND v = 5 THEN 'Book Two'
 WHEN slot = 0 AND j % 4 = 2 THEN CASE WHEN v = 5 THEN CASE WHEN doc_id % 4 = 1 THEN 'Canto 1' ELSE '' END WHEN doc_id % 3 = 0 THEN 'Acknowledgments' WHEN doc_id % 3 = 1 THEN 'About  the Author' ELSE 'Interlude' END
 WHEN slot = 1 THEN CASE v WHEN 0 THEN 'A quiet start' WHEN 1 THEN 'Of beginnings' WHEN 3 THEN CASE WHEN (doc_id + j) % 2 = 0 THEN 'In short' ELSE concat('In two volumes', chr(10), 'VOL. 2') END WHEN 4 THEN CASE WHEN j % 2 = 0 THEN '* * *' ELSE 'So it was' END WHEN 5 THEN CASE WHEN j % 4 = 2 AND doc_id % 4 = 1 THEN 'Canto 2' ELSE '' END ELSE '' END
 ELSE '' END END AS text
FROM (SELECT doc_id, pos, piece, CAST(doc_id % 6 AS INT) AS v, CAST(floor((pos - 8) / 3) AS INT) AS j, CAST((pos - 8) % 3 AS INT) AS slot FROM {pieces}) AS cut) AS book"""


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_lines(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))


def dressed_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(DRESSED_LINES, lines=lines(spark, sf_dir))


def dressed_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spark.sql(DRESSED_BLOCKS, lines=lines(spark, sf_dir))
    return rows.withColumn("tags", F.split("tag_list", ",")).drop("tag_list")


def dressed_books(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Books with the role of their chapters; take the column off where a rule is to find them."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    pieces = docs.select("doc_id", "text", F.expr(SIZE).alias("size"), F.explode(F.expr(f"sequence(0, {COUNT} - 1)")).alias("pos"))
    rows = spark.sql(DRESSED_BOOKS, pieces=spark.sql(PIECES + " FROM {cut}", cut=pieces))
    return rows.withColumns({"tags": F.split("tag_list", ","), "subtype": F.lit(None).cast("string")}).drop("tag_list")


def order_books(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as manuscripts whose chapters are line numbers, in order of line, part and supplier."""
    items = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    number = F.col("l_linenumber")
    place = F.struct(number, F.col("l_partkey"), F.col("l_suppkey"))
    books = items.groupBy(F.col("l_orderkey").alias("doc_id")).agg(F.array_sort(F.collect_list(place)).alias("chapters"))
    rows = books.select("doc_id", F.posexplode("chapters").alias("pos", "c"))
    return rows.select("doc_id", F.col("pos").cast("long").alias("pos"), F.lit("heading").alias("type"), F.lit(1).alias("heading_level"), F.concat(F.lit("Chapter "), F.col("c.l_linenumber")).alias("text"), F.array().cast("array<string>").alias("tags"))
