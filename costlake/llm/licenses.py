"""License scans: TF-IDF matching of headers and licence files to templates, then
inheritance from the nearest ancestor directory.

1. Every whole text is cut into lines, with the lines of one comment block
   joined; the lines that name a licence are normalised to their words. So are
   their sentences and a comment block's single lines and pairs of lines, which
   are scored besides (idf counts the whole lines only).
2. Equal lines are aggregated first (a notice that a third of all files carry
   is one row), so vectors are built for distinct lines only. A term's idf is
   taken over all occurrences of such lines in the corpus.
3. Sparse cosines come from a join of line terms and template terms. The
   templates are a fixed list, so that side is broadcast.
4. Licence bodies: whole licence files and comment blocks are compared with the
   full texts in ``license_texts`` by the cosine of their runs of three words.
   Equal blocks are one row; blocks without a run of any full text are dropped
   before their vectors are built, as their cosine is 0.
5. A file's licence is its best full text at ``MIN_COSINE`` or more, else its best
   line; a part of a line that only reserves all rights comes last. Files named
   LICENSE, COPYING and the like give theirs to their directory; a file without
   a licence of its own takes that of its nearest ancestor directory, found by
   an equi join of each distinct directory's ancestors with the licensed ones.

Defined results: a NULL or empty text has no licence of its own; a NULL path has
no directory and inherits nothing; ties between templates go to the smaller
licence name; of several licence files in a directory the best match counts;
repeated rows get equal results; an empty table gives an empty result; extra
columns pass through, clashing names are replaced.
"""

from __future__ import annotations

from importlib import resources

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from costlake.llm.text import ascii_lower, packed, plain_words, text_of
from costlake.session import materialize

MIN_COSINE = 0.6
OUT = ("license", "similarity", "license_from", "license_dir")
NAMES_LICENCE = r"(?i)licen[cs]|copyright|spdx|public domain|rights reserved"
COMMENT_BREAK = r"\n[ \t]*(?:#|//|\*|--|;)+[ \t]*"
COMMENT_LINE = r"^[ \t]*(?:#|//|\*|--|;)"
SENTENCE_END = r"(?<=[.!?])[ \t]+"
# Comments without a mark on every line, to their end or to the end of the text.
ENCLOSED = r"""(?s)/\*.*?(?:\*/|\z)|<!--.*?(?:-->|\z)|\"{3}.*?(?:\"{3}|\z)|'{3}.*?(?:'{3}|\z)"""
RUN = 3
LICENSE_FILE = r"(?i)^(?:un)?licen[cs]e(?:[.-].*)?$|^copying(?:[.-].*)?$|^notice(?:[.-].*)?$"
# Licence name and the wording of its usual notices.
TEMPLATES = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in "
                   "compliance with the License. You may obtain a copy of the License at apache.org/licenses/LICENSE-2.0"),
    ("Apache-2.0", "SPDX-License-Identifier: Apache-2.0"),
    ("BSD-3-Clause", "Released under the BSD 3-Clause License"),
    ("BSD-3-Clause", "SPDX-License-Identifier: BSD-3-Clause"),
    ("CC-BY-4.0", "Licensed under CC BY 4.0, the Creative Commons Attribution 4.0 International License"),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0"),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0"),
    ("CC0-1.0", "Dedicated to the public domain under CC0 1.0 Universal"),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3"),
    ("GPL-3.0", "SPDX-License-Identifier: GPL-3.0-or-later"),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3"),
    ("MIT", "Released under the MIT License"),
    ("MIT", "SPDX-License-Identifier: MIT"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
    ("Proprietary", "Copyright. All rights reserved."),
]


def _normal(c: Column) -> Column:
    return F.array_join(plain_words(ascii_lower(c)), " ")


def licence_lines(text: Column) -> Column:
    """Distinct normalised lines of a non-null text that name a licence, as
    (line, whole); parts of lines are not whole."""
    def naming(c: Column) -> Column:
        return F.filter(c, lambda x: F.rlike(x, F.lit(NAMES_LICENCE)))

    lines = naming(F.split(F.regexp_replace(text, COMMENT_BREAK, " "), "\n", -1))
    raw = F.split(text, "\n", -1)
    pairs = F.zip_with(raw, F.concat(F.slice(raw, F.lit(2), F.size(raw) - 1), F.array(F.lit(""))),
                       lambda a, b: F.when(F.rlike(b, F.lit(COMMENT_LINE)), F.array(a, b, F.concat(a, F.lit(" "), b)))
                       .otherwise(F.array().cast("array<string>")))
    parts = naming(F.concat(F.flatten(F.transform(lines, lambda x: F.split(x, SENTENCE_END, -1))), F.flatten(pairs)))

    def given(c: Column, whole: bool) -> Column:
        return F.transform(c, lambda x: F.struct(_normal(x).alias("line"), F.lit(whole).alias("whole")))

    return F.when(F.rlike(text, F.lit(NAMES_LICENCE)), F.array_distinct(F.concat(given(lines, True), given(parts, False))))


def body_blocks(text: Column, name: Column) -> Column:
    """Distinct normalised comment blocks of a non-null text, and the whole text
    of a licence file."""
    mark = F.lit("\x01")
    marked = F.split(F.regexp_replace(F.translate(text, "\x01", " "), COMMENT_BREAK, "\x01"), "\n", -1)
    blocks = F.filter(marked, lambda x: F.contains(x, mark))
    whole = F.when(F.rlike(name, F.lit(LICENSE_FILE)), F.array(text)).otherwise(F.array().cast("array<string>"))
    found = F.concat(blocks, F.regexp_extract_all(text, F.lit(ENCLOSED), F.lit(0)),
                     F.coalesce(whole, F.array().cast("array<string>")))
    return F.array_distinct(F.transform(found, _normal))


def _term_counts(lines: DataFrame) -> DataFrame:
    """``lines`` (with ``line``) as (all columns, term, tf)."""
    return (lines.withColumn("term", F.explode(F.split("line", " "))).groupBy(*lines.columns, "term")
            .agg(F.count(F.lit(1)).alias("tf")))


def match_lines(lines: DataFrame) -> DataFrame:
    """(line, license, similarity) of the distinct ``lines`` (line, n) that match
    a template."""
    spark = lines.sparkSession
    total = lines.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    terms = materialize(_term_counts(lines))
    df = terms.groupBy("term").agg(F.sum("n").alias("df"))
    idf = (F.log(F.lit(1.0 + total) / (1 + F.coalesce("df", F.lit(0)))) + 1)
    vec = terms.join(df, "term").select("line", "term", (F.col("tf") * idf).alias("w"))
    given = spark.createDataFrame([(i, name, text) for i, (name, text) in enumerate(TEMPLATES)],
                                  "t int, license string, text string")
    given = given.select("t", "license", _normal(F.col("text")).alias("line"))
    return _best(vec, _term_counts(given).join(df, "term", "left")
                 .select("t", "license", "term", (F.col("tf") * idf).alias("tw")))


def _best(vec: DataFrame, tvec: DataFrame) -> DataFrame:
    """(line, license, similarity) of the best template of each line with a cosine
    of ``MIN_COSINE`` or more."""
    tnorm = tvec.groupBy("t").agg(F.sqrt(F.sum(F.col("tw") * F.col("tw"))).alias("tn"))
    # At most the words of the fixed templates.
    tvec = F.broadcast(materialize(tvec.join(tnorm, "t")))
    norm = vec.groupBy("line").agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("n"))
    dots = vec.join(tvec, "term").groupBy("line", "t", "license", "tn").agg(F.sum(F.col("w") * F.col("tw")).alias("dot"))
    cos = F.round(F.col("dot") / (F.col("n") * F.col("tn")), 6)
    best = (dots.join(norm, "line").groupBy("line")
            .agg(F.min(F.struct((-cos).alias("minus"), F.col("license"))).alias("b")))
    return best.select("line", F.col("b.license").alias("license"), (-F.col("b.minus")).alias("similarity")) \
               .filter(F.col("similarity") >= MIN_COSINE)


def _runs(blocks: DataFrame) -> DataFrame:
    """``blocks`` (with ``body``) as (all columns but body, term): one row per run
    of ``RUN`` words, by its hash."""
    keys = [c for c in blocks.columns if c != "body"]
    starts = F.when(F.size("words") >= RUN, F.sequence(F.lit(1), F.size("words") - (RUN - 1)))
    return blocks.withColumn("words", F.split("body", " ")).select(
        *keys, F.explode(F.transform(starts, lambda i: F.xxhash64(F.slice("words", i, F.lit(RUN))))).alias("term"))


def _run_counts(blocks: DataFrame) -> DataFrame:
    runs = _runs(blocks)
    return runs.groupBy(*runs.columns).agg(F.count(F.lit(1)).alias("tf"))


def full_texts(spark: SparkSession) -> DataFrame:
    """(t, license, body) of the licence texts beside this module."""
    folder = resources.files("costlake.llm") / "license_texts"
    rows = [(i, f.name.removesuffix(".txt"), f.read_text(encoding="utf-8")) for i, f in
            enumerate(sorted((f for f in folder.iterdir() if f.name.endswith(".txt")), key=lambda f: f.name))]
    return spark.createDataFrame(rows, "t int, license string, text string").select(
        "t", "license", _normal(F.col("text")).alias("body"))


def match_bodies(blocks: DataFrame) -> DataFrame:
    """(row, license, similarity) of the blocks (row, body) that match a full text."""
    # At most the runs of the fixed texts, here and in _best.
    asked = materialize(_run_counts(full_texts(blocks.sparkSession)))
    blocks = blocks.withColumn("line", F.xxhash64("body"))
    near = materialize(_runs(blocks.select("line", "body"))
                       .join(F.broadcast(asked.select("term").distinct()), "term", "left_semi").select("line").distinct())
    near_blocks = materialize(blocks.join(near, "line", "left_semi"))
    terms = materialize(_run_counts(near_blocks.groupBy("line").agg(F.first("body").alias("body"),
                                                                    F.count(F.lit(1)).alias("n"))))
    total = near_blocks.count()
    df = terms.groupBy("term").agg(F.sum("n").alias("df"))
    idf = (F.log(F.lit(1.0 + total) / (1 + F.coalesce("df", F.lit(0)))) + 1)
    vec = terms.join(df, "term").select("line", "term", (F.col("tf") * idf).alias("w"))
    tvec = asked.join(df, "term", "left").select("t", "license", "term", (F.col("tf") * idf).alias("tw"))
    return near_blocks.select("row", "line").join(_best(vec, tvec), "line").select("row", "license", "similarity")


def _folders(path: Column) -> Column:
    """The directory of ``path`` as its parts."""
    parts = F.split(path, "/", -1)
    return F.slice(parts, F.lit(1), F.size(parts) - 1)


def scan_licenses(files: DataFrame, path: str = "path", text: str = "text", drop_text: bool = False) -> DataFrame:
    """``files`` with license, similarity, license_from (``file`` or
    ``inherited``) and license_dir (the directory inherited from)."""
    t = text_of(text)
    row = F.xxhash64(F.col(path), t)
    name = F.element_at(F.split(F.col(path), "/", -1), -1)
    found = materialize(files.select(row.alias("row"), F.inline(licence_lines(t))))
    matched = materialize(match_lines(found.groupBy("line").agg(F.sum(F.col("whole").cast("bigint")).alias("n"))))
    blocks = materialize(files.select(row.alias("row"), F.explode(body_blocks(t, name)).alias("body"))
                         .filter("body <> ''"))
    rank = F.when(~F.col("whole") & (F.col("license") == "Proprietary"), 2).otherwise(1)
    scored = (found.join(matched, "line").select("row", rank.alias("rank"), "license", "similarity")
              .unionByName(match_bodies(blocks).select("row", F.lit(0).alias("rank"), "license", "similarity")))
    own = materialize(scored.groupBy("row").agg(
        F.min(F.struct("rank", (-F.col("similarity")).alias("minus"), "license")).alias("own")))
    f = files.select(packed(files, (*OUT, text) if drop_text else OUT), row.alias("row"),
                     F.array_join(_folders(F.col(path)), "/").alias("dir"),
                     name.alias("name"))
    owned = f.join(own, "row", "left")
    given = materialize(owned.filter(F.rlike("name", F.lit(LICENSE_FILE)) & F.col("own").isNotNull())
                        .groupBy("dir").agg(F.min("own").alias("given")))
    parts = F.when(F.col("dir") == "", F.array().cast("array<string>")).otherwise(F.split("dir", "/", -1))
    dirs = f.select("dir").filter("dir IS NOT NULL").distinct().select("dir", parts.alias("parts"))
    above = dirs.select("dir", F.explode(F.transform(
        F.sequence(F.lit(0), F.size("parts")),
        lambda k: F.struct(k.alias("depth"), F.array_join(F.slice(F.col("parts"), F.lit(1), k), "/").alias("up")))
    ).alias("a")).select("dir", "a.depth", "a.up")
    nearest = materialize(above.join(given.withColumnRenamed("dir", "up"), "up").groupBy("dir")
                          .agg(F.max_by(F.struct("given", "up"), "depth").alias("near")))
    got = F.coalesce("own", "near.given")
    return owned.join(nearest, "dir", "left").select(
        "_doc.*", got["license"].alias("license"), (-got["minus"]).alias("similarity"),
        F.when(F.col("own").isNotNull(), "file").when(F.col("near").isNotNull(), "inherited").alias("license_from"),
        F.when(F.col("own").isNull(), F.col("near.up")).alias("license_dir"))
