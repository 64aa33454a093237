"""Licence scan by canonical digests, in DataFrame functions only.

A text is canonical after lower-casing, dropping copyright lines, unifying spellings
and reducing everything but letters and digits to single spaces.  The SHA-256 of a
whole document, and of each whole line of it, is hash-joined to the digests of the
known texts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from landgrain.llm.book import query, table
from landgrain.llm.spaces import cut

# Short notices by which licences are declared, with their SPDX names.
NOTICES = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("GPL-3.0-only", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-2.0-only", "This work is licensed under the GNU General Public License, version 2."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("BSD-3-Clause", "Released under the BSD 3-Clause License."),
]

# Spellings that mean the same in a licence, replaced in this order on whole words.
SPELLINGS = [
    ("licence", "license"),
    ("licences", "licenses"),
    ("licenced", "licensed"),
    ("sublicence", "sublicense"),
    ("organisation", "organization"),
    ("favour", "favor"),
    ("whilst", "while"),
    ("v", "version"),
]


def canonical_lines(text: Column) -> Column:
    """The canonical lines of a text: trimmed, without empty ones; copyright lines are dropped."""
    out = F.lower(F.coalesce(text, F.lit("")))
    out = F.translate(F.replace(out, F.lit("\r\n"), F.lit("\n")), "\r", "\n")
    out = F.regexp_replace(out, r"(?m)^[^a-z0-9\n]*(copyright|\(c\)|©)[^\n]*$", "")
    out = F.regexp_replace(out, r"[^\p{L}\p{N}\n]+", " ")
    # Every word gets a space of its own on both sides, so plain replacement hits whole words only.
    out = F.concat(F.lit(" "), F.replace(F.replace(out, F.lit(" "), F.lit("  ")), F.lit("\n"), F.lit(" \n ")), F.lit(" "))
    for old, new in SPELLINGS:
        out = F.replace(out, F.lit(f" {old} "), F.lit(f" {new} "))
    out = F.replace(out, F.lit("  "), F.lit(" "))
    return F.filter(F.transform(F.split(out, "\n"), lambda x: F.trim(x)), lambda x: x != "")


def canonical(lines: Column) -> Column:
    """Canonical lines as one text."""
    return F.array_join(lines, " ")


def known_digests(known: DataFrame, name: str = "license", text: str = "text") -> DataFrame:
    """(license, digest, size) of each known text; of names with one canonical text the first counts."""
    whole = known.select(F.col(name).alias("license"), canonical(canonical_lines(F.col(text))).alias("canon")).where("canon <> ''")
    return whole.groupBy(F.sha2("canon", 256).alias("digest"), F.length("canon").alias("size")).agg(F.min("license").alias("license"))


def scan(docs: DataFrame, known: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: (key, canonical_sha256, text_license, line_licenses).

    `text_license` names the known text that equals the whole document, `line_licenses`
    the known texts that equal whole lines of it, sorted, joined by commas; both are null
    when nothing matches.  A null text reads as empty, and empty text matches nothing.
    Repeated rows and null keys are kept.  Only lines as long as some known text are
    hashed; that set of lengths is bounded by the table of known texts.
    """
    digests = cut(known_digests(known, "license", "text"))
    sizes = [r["size"] for r in digests.select("size").distinct().collect()] or [-1]
    lined = docs.select(F.col(key).alias("key"), canonical_lines(F.col(text)).alias("lines"))
    known_sizes = F.array_distinct(F.filter("lines", lambda x: F.length(x).isin(sizes)))
    base = cut(lined.select("key", F.sha2(canonical(F.col("lines")), 256).alias("canonical_sha256"), F.transform(known_sizes, lambda x: F.sha2(x, 256)).alias("line_digests")))
    found = (
        base.select("key", "canonical_sha256", F.explode("line_digests").alias("digest"))
        .join(digests.select("digest", "license"), "digest")
        .groupBy("key", "canonical_sha256")
        .agg(F.concat_ws(",", F.array_sort(F.collect_set("license"))).alias("line_licenses"))
    )
    f = found.select(F.col("key").alias("f_key"), F.col("canonical_sha256").alias("f_sha"), "line_licenses")
    return (
        base.join(digests.select(F.col("digest").alias("canonical_sha256"), F.col("license").alias("text_license")), "canonical_sha256", "left")
        .join(f, F.col("key").eqNullSafe(F.col("f_key")) & (F.col("canonical_sha256") == F.col("f_sha")), "left")
        .select(F.col("key").alias(key), "canonical_sha256", "text_license", "line_licenses")
    )


def notices(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(NOTICES, "license string, text string")


def _check_sql() -> str:
    def quoted(x: str) -> str:
        return "'" + x.replace("'", "''") + "'"

    body = "lower(coalesce(text, ''))"
    body = f"replace(replace({body}, chr(13) || chr(10), chr(10)), chr(13), chr(10))"
    body = rf"regexp_replace({body}, '(?m)^[^a-z0-9\n]*(copyright|\(c\)|©)[^\n]*$', '', 'g')"
    body = rf"regexp_replace({body}, '[^\p{{L}}\p{{N}}\n]+', ' ', 'g')"
    body = f"' ' || replace(replace({body}, ' ', '  '), chr(10), ' ' || chr(10) || ' ') || ' '"
    for old, new in SPELLINGS:
        body = f"replace({body}, ' {old} ', ' {new} ')"
    body = f"replace({body}, '  ', ' ')"
    lines = f"[trim(x, ' ') FOR x IN string_split({body}, chr(10)) IF trim(x, ' ') <> '']"
    known = ", ".join(f"({quoted(a)}, {quoted(b)})" for a, b in NOTICES)
    return rf"""WITH known AS (SELECT * FROM (VALUES {known}) AS t(license, text)),
        k AS (SELECT sha256(array_to_string(l, ' ')) AS digest, min(license) AS license FROM (SELECT license, {lines} AS l FROM known) WHERE len(l) > 0 GROUP BY 1),
        d AS (SELECT doc_id, {lines} AS lines FROM documents),
        s AS (SELECT doc_id, sha256(array_to_string(lines, ' ')) AS sha FROM d),
        m AS (SELECT doc_id, string_agg(DISTINCT license, ',' ORDER BY license) AS line_licenses FROM (SELECT doc_id, unnest(lines) AS line FROM d) JOIN k ON sha256(line) = k.digest GROUP BY 1)
        SELECT s.doc_id, sha AS canonical_sha256, k.license AS text_license, m.line_licenses
        FROM s LEFT JOIN k ON k.digest = s.sha LEFT JOIN m ON m.doc_id = s.doc_id"""


@query("op4_license_digests", _check_sql())
def op4(spark, sf):
    return scan(table(spark, sf, "documents"), notices(spark))
