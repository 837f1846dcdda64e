"""Operator 10: licence scans by TF-IDF cosine, with inheritance along directories.

Three things are compared with templates by the cosine of sparse TF-IDF vectors: the lines
that speak of licences, with short notices; and the leading header block and the whole text,
both with the texts in ``licence_texts``.  A licence file is a document whose whole text is
like such a text, or one named like a licence file, or one of which at least half of the
words are such lines.  A document without a licence of its own takes that of the nearest
directory above it that holds a licence file, by a join of paths.

Built-in expressions only.  The templates are a fixed list and become literals; term
statistics are counted over the headers of all documents, and over their blocks.  Only
texts that speak of a warranty, as all the texts do, or named like a licence file have
blocks; equal blocks are one row.  Directories are made distinct
before their ancestors are looked up, so a directory with most documents is one row there.
"""

from __future__ import annotations

import pkgutil
import re
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tierflow.llm.common import WORD, let, table
from tierflow.operators.sizing import broadcast_within, sized
from tierflow.sources.scratch import staged

THRESHOLD = 0.45

#: Short notices of common public licences.
TEMPLATES = {
    "MIT": "Released under the MIT License.",
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "GPL": "This work is licensed under the GNU General Public License, version 3.",
    "LGPL": "This library is licensed under the GNU Lesser General Public License, version 2.1.",
    "AGPL": "This program is licensed under the GNU Affero General Public License, version 3.",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "BSD": "Redistribution and use in source and binary forms are permitted under the BSD License.",
    "CC-BY": "Licensed under CC BY 4.0, the Creative Commons Attribution License.",
    "CC-BY-NC": "Licensed under CC BY-NC 4.0.",
    "CC-BY-SA": "Licensed under CC BY-SA 4.0.",
    "CC0": "Dedicated to the public domain under CC0 1.0 Universal.",
    "ISC": "Licensed under the ISC License.",
}
ANCHOR = r"(?i)licen[cs]|copyright|spdx|redistribut|public domain|permission is hereby"
ANCHOR_WORDS = (
    "licenc", "licens", "copyright", "spdx", "redistribut", "public domain", "permission is hereby",
)
#: Licence texts and standard headers; what follows the name tells texts of one licence apart.
TEXTS = (
    "AGPL.header", "Apache-2.0", "Apache-2.0.header", "BSD", "CC0", "GPL.2", "GPL.3", "GPL.header",
    "ISC", "LGPL.2", "LGPL.3", "LGPL.header", "MIT", "MPL-2.0",
)
TEXT_THRESHOLD = 0.8
TEXT_WORD = "warrant"
FILE_NAME = r"(?i)(^|/)(un)?(licen[cs]es?|copying|copyright|notice)([.-][^/]*)?$"
#: Marks of a comment at both ends of a line.
COMMENT = r"(?m)^[ \t]*(?:#+|//+|/?\*+/?|--+|;+|%+|<!--)|(?:\*+/|-->)?[ \t\r]*$"
#: A term is a run of letters, also with hyphens inside ("by-nc"); numbers do not tell.
TERM = r"[a-z]+(?:-[a-z]+)*[0-9]?"


def terms(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(TERM), F.lit(0))


def header_lines(text: Column) -> Column:
    """The lines of a text that speak of licences; most texts have none and are not split."""
    found = F.filter(F.split(text, "\n", -1), lambda line: line.rlike(ANCHOR))
    return F.when(speaks(text), found).otherwise(F.array().cast("array<string>"))


def speaks(text: Column) -> Column:
    """Whether a text may match ``ANCHOR``, by plain searches in its lower case."""
    return let(F.lower(text), lambda low: reduce(or_, [low.contains(w) for w in ANCHOR_WORDS]))


def template_table(spark: SparkSession) -> DataFrame:
    rows = spark.createDataFrame(sorted(TEMPLATES.items()), "licence string, notice string")
    return rows.select("licence", terms(F.col("notice")).alias("terms"))


def text_templates(spark: SparkSession) -> DataFrame:
    rows = [
        (name, re.findall(TERM, pkgutil.get_data(__package__, f"licence_texts/{name}.txt").decode().lower()))
        for name in TEXTS
    ]
    return spark.createDataFrame(rows, "licence string, terms array<string>")


def header_block(text: Column) -> Column:
    """The first paragraphs in a row that speak of licences, without comment marks."""
    plain = F.regexp_replace(text, COMMENT, "")

    def run(paragraphs: Column, flags: Column) -> Column:
        start = F.array_position(flags, True)
        return let(
            F.array_position(F.slice(flags, start, F.size(flags)), False),
            lambda end: F.slice(paragraphs, start, F.when(end == 0, F.size(flags)).otherwise(end - 1).cast("int")),
        )

    return let(
        F.split(plain, r"\n\s*\n", -1),
        lambda paragraphs: let(
            F.transform(paragraphs, lambda p: speaks(p) | F.lower(p).contains(TEXT_WORD)),
            lambda flags: F.when(
                F.array_contains(flags, True), F.array_join(run(paragraphs, flags), "\n\n")
            ).otherwise(""),
        ),
    )


def blocks(text: Column, named: Column) -> Column:
    """Whole text and header block with their terms; most texts have none."""

    def block(part: Column, is_whole: bool) -> Column:
        return let(terms(part), lambda t: F.struct(
            F.lit(is_whole).alias("whole"), F.sha2(F.array_join(t, " "), 256).alias("key"), t.alias("terms")
        ))

    both = F.array(block(text, True), block(header_block(text), False))
    return F.when(named | F.lower(text).contains(TEXT_WORD), both).otherwise(F.slice(both, 1, 0))


def weights(vectors: DataFrame, key: list[str], idf: DataFrame) -> DataFrame:
    """(key, term, w): TF-IDF weights, scaled so that each vector has length 1."""
    tf = vectors.select(*key, F.explode("terms").alias("term")).groupBy(*key, "term").count()
    raw = tf.join(idf, "term").withColumn("w", F.col("count") * F.col("idf"))
    norms = raw.groupBy(*key).agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("norm"))
    return raw.join(norms, key).select(*key, "term", (F.col("w") / F.col("norm")).alias("w"))


def header_licences(headers: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(text, licence, similarity) for each distinct header text above the threshold.

    Equal header lines are one row, counted; so the notice that a third of all documents
    carry is compared once.  Ties go to the name that sorts first.
    """
    distinct = headers.groupBy("text").agg(F.count(F.lit(1)).alias("n"))
    vectors = distinct.select("text", "n", terms(F.col("text")).alias("terms"))
    return nearest_template(vectors, template_table(headers.sparkSession), threshold)


def nearest_template(vectors: DataFrame, templates: DataFrame, threshold: float) -> DataFrame:
    """(text, licence, similarity) of the (text, n, terms) that reach the threshold."""
    total = vectors.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("total"))
    seen = vectors.select("n", F.explode(F.array_distinct("terms")).alias("term")).groupBy("term").agg(F.sum("n").alias("df"))
    known = templates.select(F.explode("terms").alias("term"), F.lit(0).cast("long").alias("df"))
    idf = seen.unionByName(known).groupBy("term").agg(F.sum("df").alias("df")).join(F.broadcast(total)).select(
        "term", (F.log((F.col("total") + 1) / (F.col("df") + 1)) + 1).alias("idf")
    )
    own = weights(vectors, ["text"], idf)
    theirs = weights(templates, ["licence"], idf).withColumnRenamed("w", "v")  # a fixed list
    cosine = own.join(F.broadcast(theirs), "term").groupBy("text", "licence").agg(
        F.round(F.sum(F.col("w") * F.col("v")), 6).alias("similarity")
    )
    best = cosine.groupBy("text").agg(
        F.min(F.struct((-F.col("similarity")).alias("s"), "licence")).alias("b")
    )
    return best.select("text", F.col("b.licence").alias("licence"), (-F.col("b.s")).alias("similarity")).where(
        F.col("similarity") >= threshold
    )


def ancestors(directory: Column) -> Column:
    """The directory itself and all above it, with the empty path last."""
    return let(
        F.filter(F.split(directory, "/"), lambda p: p != ""),
        lambda parts: F.transform(
            F.sequence(F.size(parts), F.lit(0), F.lit(-1)), lambda n: F.array_join(F.slice(parts, 1, n), "/")
        ),
    )


def scanned(
    documents: DataFrame, path: Column, doc_id: str = "doc_id", text: str = "text",
    threshold: float = THRESHOLD,
) -> DataFrame:
    """One row per document: doc_id, path, licence, similarity, origin.

    origin is ``header``, ``file`` (the document is a licence file), ``inherited`` or NULL
    without a licence; an inherited licence has the similarity of its file.  Of several
    licence files in a directory the one most alike counts, then the name that sorts first;
    of several headers in a document likewise.  NULL and empty texts have no header; a NULL
    path is the top directory; repeated rows are judged one by one; other columns are not
    looked at; an empty table gives an empty result.
    """
    whole = F.coalesce(F.col(text), F.lit(""))
    clean = F.regexp_replace(F.coalesce(path, F.lit("")), "^/+|/+$", "")
    rows = documents.select(
        F.col(doc_id).alias("doc_id"), clean.alias("path"), header_lines(whole).alias("headers"),
        F.when(speaks(whole), F.regexp_count(whole, F.lit(WORD))).alias("n_words"),
        clean.rlike(FILE_NAME).alias("named"), blocks(whole, clean.rlike(FILE_NAME)).alias("blocks"),
    ).withColumn("directory", F.regexp_replace("path", r"/?[^/]*$", ""))
    rows = staged(rows, "headers")  # texts are read once; what follows is small
    headers = rows.where(F.size("headers") > 0).select(F.explode("headers").alias("text"))
    named = header_licences(headers, threshold)
    lines = rows.where(F.size("headers") > 0).select(
        "doc_id", "path", "directory", "named", "n_words",
        F.aggregate("headers", F.lit(0), lambda n, h: n + F.regexp_count(h, F.lit(WORD))).alias("said"),
        F.explode(F.array_distinct("headers")).alias("text"),
    ).join(named, "text").select(
        "doc_id", "path", "directory", (F.col("named") | (F.col("said") * 2 >= F.col("n_words"))).alias("file"),
        F.lit(1).alias("rank"), "similarity", "licence",
    )
    parts = rows.where(F.size("blocks") > 0).select("doc_id", "path", "directory", "named", F.explode("blocks").alias("b"))
    distinct = parts.groupBy(F.col("b.key").alias("text")).agg(
        F.count(F.lit(1)).alias("n"), F.any_value("b.terms").alias("terms")
    )
    alike = nearest_template(distinct, text_templates(rows.sparkSession), TEXT_THRESHOLD)
    texts = parts.join(alike, F.col("b.key") == F.col("text")).select(
        "doc_id", "path", "directory", (F.col("named") | F.col("b.whole")).alias("file"),
        F.lit(0).alias("rank"), "similarity", F.regexp_replace("licence", r"\.(header|2|3)$", "").alias("licence"),
    )
    # a whole text or header block that is known says more than a line within it
    loud = lines.unionByName(texts).groupBy("doc_id", "path", "directory").agg(
        F.max("file").alias("file"),
        F.min(F.struct("rank", (-F.col("similarity")).alias("s"), "licence")).alias("best"),
    ).select(
        F.col("doc_id").alias("_id"), F.col("path").alias("_path"), "directory", "file",
        F.struct("best.s", "best.licence").alias("own"),
    )
    files = loud.where("file").groupBy("directory").agg(F.min("own").alias("given"))
    loud = loud.drop("directory")
    above = rows.select("directory").distinct().select(
        "directory", F.posexplode(ancestors(F.col("directory"))).alias("up", "ancestor")
    )
    nearest = above.join(files.withColumnRenamed("directory", "ancestor"), "ancestor").groupBy("directory").agg(
        F.min(F.struct("up", "given")).alias("near")
    ).select("directory", F.col("near.given").alias("given"))
    nearest = broadcast_within(sized(nearest, "nearest"))  # a directory may hold most documents

    quiet = (F.size("headers") == 0) & (F.size("blocks") == 0)
    plain = rows.where(quiet).select(
        "doc_id", "path", "directory", F.lit(False).alias("file"), F.lit(None).cast("struct<s:double,licence:string>").alias("own")
    )
    same = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("path") == F.col("_path"))
    spoken = rows.where(~quiet).join(loud, same, "left").select("doc_id", "path", "directory", F.coalesce("file", F.lit(False)).alias("file"), "own")
    return plain.unionByName(spoken).join(nearest, "directory", "left").select(
        "doc_id", "path",
        F.coalesce("own.licence", "given.licence").alias("licence"),
        F.abs(F.coalesce("own.s", "given.s")).alias("similarity"),
        F.when(F.col("own").isNotNull(), F.when(F.col("file"), "file").otherwise("header"))
        .when(F.col("given").isNotNull(), "inherited").alias("origin"),
    )


def document_path() -> Column:
    """A path for the rows of ``documents``: source, language and id as directories and name."""
    parts = [F.coalesce(F.col(c).cast("string"), F.lit("_")) for c in ("source", "lang", "doc_id")]
    return F.concat_ws("/", *parts)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scanned(table(spark, sf_dir, "documents"), document_path())


_NOTICES = ", ".join(
    "('{}', '{}')".format(name, notice.replace("'", "''")) for name, notice in sorted(TEMPLATES.items())
)
ORACLE = rf"""
WITH d AS (
  SELECT doc_id, concat(coalesce(source, '_'), '/', coalesce(lang, '_')) AS directory,
    coalesce(text, '') AS text FROM documents
), l AS (
  SELECT doc_id, directory, text AS whole, unnest(string_split(text, chr(10))) AS line FROM d
), h AS (
  SELECT doc_id, directory, line, len(regexp_extract_all(whole, '[^\x20\x09-\x0D]+')) AS n_words,
    sum(len(regexp_extract_all(line, '[^\x20\x09-\x0D]+'))) OVER (PARTITION BY doc_id) AS said
  FROM l WHERE regexp_matches(line, '{ANCHOR}')
), x AS (
  SELECT line AS k, count(*) AS n, regexp_extract_all(lower(line), '{TERM}') AS terms FROM h GROUP BY line
), t AS (
  SELECT licence AS k, regexp_extract_all(lower(notice), '{TERM}') AS terms FROM (VALUES {_NOTICES}) v(licence, notice)
), df AS (
  SELECT term, sum(n) AS df FROM (
    SELECT n, unnest(list_distinct(terms)) AS term FROM x UNION ALL SELECT 0, unnest(terms) FROM t
  ) GROUP BY term
), idf AS (
  SELECT term, ln(((SELECT coalesce(sum(n), 0) FROM x) + 1) / (df + 1)) + 1 AS idf FROM df
), wx AS (
  SELECT k, term, count(*) * any_value(idf) AS w FROM (SELECT k, unnest(terms) AS term FROM x) JOIN idf USING (term) GROUP BY ALL
), wt AS (
  SELECT k, term, count(*) * any_value(idf) AS w FROM (SELECT k, unnest(terms) AS term FROM t) JOIN idf USING (term) GROUP BY ALL
), nx AS (SELECT k, sqrt(sum(w * w)) AS n FROM wx GROUP BY k), nt AS (SELECT k, sqrt(sum(w * w)) AS n FROM wt GROUP BY k
), c AS (
  SELECT wx.k AS line, wt.k AS licence, round(sum(wx.w * wt.w) / any_value(nx.n * nt.n), 6) AS s
  FROM wx JOIN wt USING (term) JOIN nx ON nx.k = wx.k JOIN nt ON nt.k = wt.k GROUP BY ALL
), b AS (
  SELECT line, licence, s FROM c WHERE s >= {THRESHOLD}
  QUALIFY row_number() OVER (PARTITION BY line ORDER BY s DESC, licence) = 1
), o AS (
  SELECT doc_id, directory, said * 2 >= n_words AS file, licence, s FROM h JOIN b USING (line)
  QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY s DESC, licence) = 1
), f AS (
  SELECT directory, licence, s FROM o WHERE file
  QUALIFY row_number() OVER (PARTITION BY directory ORDER BY s DESC, licence) = 1
)
SELECT d.doc_id, concat(d.directory, '/', d.doc_id) AS path, coalesce(o.licence, f.licence) AS licence,
  coalesce(o.s, f.s) AS similarity,
  CASE WHEN o.file THEN 'file' WHEN o.doc_id IS NOT NULL THEN 'header' WHEN f.s IS NOT NULL THEN 'inherited' END AS origin
FROM d LEFT JOIN o USING (doc_id) LEFT JOIN f ON f.directory = d.directory
"""
