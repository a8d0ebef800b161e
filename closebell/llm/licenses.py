"""License scans: a trained paragraph classifier, confirmed by comparison with templates.

A paragraph is a run of lines between lines without a letter or digit; comment marks at line starts
are left out and line breaks are read as spaces, so a notice may be wrapped. Every paragraph with a
word that notices use (``CUES``) is read in windows of words around these. The words and word pairs of a
window are hashed into a sparse vector, and a multinomial logistic regression with a temperature,
fitted on held-out windows, gives calibrated probabilities of the licence families and ``unknown``.
**The classifier proposes**: a window names each family of at least ``min_probability``.

**The templates confirm or reject** what is proposed: a notice is a stretch of the paragraph that
holds ``min_similarity`` of a template's shingles (runs of five words; of two in templates of fewer than
``LONG`` words): in the template's order, or else anywhere in one line or in the paragraph. Of notices of
different families in one place the one most like its template counts, so the Lesser GPL is not the GPL.
A notice is reported, with its first and last line, if a window that overlaps it names its family.

The classifier learns from the templates with words left out, swapped in or cut off and among other words,
from a bounded sample of corpus lines as ``unknown``, and from what looks like a notice and is none.
Templates and near misses are put together from names and phrases by rule, beside the full wording of
standard headers. ``Classifier.calibration_error`` is the expected calibration error on held-out windows.

Everything is DataFrame and Spark ML code. Defined results: null and empty texts have no
paragraphs; a licence nobody wrote a template for is not reported. Repeated paragraphs and rows
are reported one by one, an empty table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import HashingTF
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from closebell.session import stage

UNKNOWN = "unknown"
LONG = 12  # words from which a template is compared by runs of five
MIN_SIMILARITY = 0.8
RADII = (3, 8, 30)  # words on each side of a cue that a window has

# Names of licences.
NAMES: dict[str, tuple[str, ...]] = {
    "AGPL-3.0": ("GNU Affero General Public License, version 3", "GNU AGPL v3", "AGPL-3.0"),
    "Apache-2.0": ("Apache License, Version 2.0", "Apache License 2.0", "Apache 2.0"),
    "BSD-2-Clause": ("BSD 2-Clause License", "simplified BSD License", "BSD-2-Clause license"),
    "BSD-3-Clause": ("BSD 3-Clause License", "new BSD License", "BSD-3-Clause license"),
    "CC-BY-4.0": ("Creative Commons Attribution 4.0 International License", "CC BY 4.0", "CC BY 4.0 International"),
    "CC-BY-NC-4.0": ("Creative Commons Attribution-NonCommercial 4.0 International License", "CC BY-NC 4.0"),
    "CC-BY-SA-4.0": ("Creative Commons Attribution-ShareAlike 4.0 International License", "CC BY-SA 4.0"),
    "GPL-3.0": ("GNU General Public License, version 3", "GNU General Public License v3.0", "GNU GPL v3", "GPL-3.0"),
    "ISC": ("ISC License", "ISC"),
    "LGPL-3.0": ("GNU Lesser General Public License, version 3", "GNU LGPL v3", "LGPL-3.0"),
    "MIT": ("MIT License", "MIT"),
    "MPL-2.0": ("Mozilla Public License, version 2.0", "Mozilla Public License, v. 2.0", "MPL 2.0"),
}

# Wording of standard headers.
HEADERS: dict[str, tuple[str, ...]] = {
    "AGPL-3.0": (
        "This program is free software: you can redistribute it and/or modify it under the terms "
        "of the GNU Affero General Public License",
    ),
    "Apache-2.0": (
        "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
    ),
    "BSD-2-Clause": (
        "Redistribution and use in source and binary forms, with or without modification, are "
        "permitted provided that the following conditions are met: 1. Redistributions of source code "
        "must retain the above copyright notice, this list of conditions and the following disclaimer. "
        "2. Redistributions in binary form must reproduce the above copyright notice, this list of "
        "conditions and the following disclaimer in the documentation and/or other materials provided "
        "with the distribution. THIS SOFTWARE IS PROVIDED",
    ),
    "BSD-3-Clause": (
        "Redistribution and use in source and binary forms, with or without modification, are "
        "permitted provided that the following conditions are met",
        "Neither the name of the copyright holder nor the names of its contributors may be used to "
        "endorse or promote products derived from this software without specific prior written permission",
    ),
    "GPL-3.0": (
        "This program is free software: you can redistribute it and/or modify it under the terms "
        "of the GNU General Public License",
    ),
    "ISC": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or "
        "without fee is hereby granted",
    ),
    "LGPL-3.0": (
        "This library is free software; you can redistribute it and/or modify it under the terms "
        "of the GNU Lesser General Public License",
        "This program is free software: you can redistribute it and/or modify it under the terms "
        "of the GNU Lesser General Public License",
    ),
    "MIT": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this "
        "software and associated documentation files",
    ),
    "MPL-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    ),
}
PHRASES = ("licensed under", "released under", "distributed under", "available under",
           "published under", "under the terms of")
ARTICLES = ("", "the", "a")
# What looks like a notice and is none, or is of a licence without a template.
OTHERS = ("Moon License, Version 7.1", "Acme Commercial License", "Eclipse Public License 2.0",
          "Microsoft Public License", "BSD-style license", "MIT-style license", "Artistic License 2.0",
          "proprietary license", "terms of our customer agreement", "license of the seller", "old rules",
          "supervision of MIT researchers", "Apache tribal council", "Boost Software License")
NEAR_MISSES = (
    "You need a license to drive a car.", "The license plate was found under the car.",
    "A licensed doctor released the patient under the new version of the rules.",
    "No permission was needed to use the software of the public library.",
    "This work is under way and the source of the file is free.", "She studied at MIT and went on to Apache County.",
    "The work was done under MIT supervision.", "GPL code may not be linked here.",
    "General public access to the software is granted by permission of the owner.",
    "Copyright 2020 by the authors. All rights reserved.", "All rights reserved. No part may be redistributed.",
)


def _short_templates() -> dict[str, list[str]]:
    return {family: [" ".join(f"{phrase} {article} {name}".split())
                     for name in names for phrase in PHRASES for article in ARTICLES]
            for family, names in NAMES.items()}


TEMPLATES: dict[str, tuple[str, ...]] = {
    family: (*HEADERS.get(family, ()), *texts) for family, texts in _short_templates().items()}
CLASSES = (UNKNOWN, *TEMPLATES)
# Words that notices have; a paragraph without one is none of the templates (checked on import).
CUES = ("licen[a-z]*", "copyright[a-z]*", "permission", "permitted", "redistribut[a-z]*", "software")
# Names that are also words of other languages: cues only within two words after one of these.
NAME_CUES = ("mit", "isc", "apache", "bsd", "a?gpl", "lgpl", "gnu", "mpl", "mozilla", "cc", "creative")
BEFORE_NAMES = ("under", "the", "of")
_CUE, _NAME_CUE = ("^(?:" + "|".join(x) + ")$" for x in (CUES, NAME_CUES))
_GAP = r"[^\p{L}\p{N}]+"
_CUE_IN_TEXT = (
    r"(?i)(?<![\p{L}\p{N}])(?:" + "|".join(CUES) + "|(?:" + "|".join(BEFORE_NAMES) + ")" + _GAP
    + r"(?:[\p{L}\p{N}]+" + _GAP + ")?(?:" + "|".join(NAME_CUES) + r"))(?![\p{L}\p{N}])")

_SEPARATOR = r"[^\p{L}\p{N}]+"
_MARK = r"^[\s/*#;%!<>|\"'.\\-]*(?:(?i:dnl|rem|c)(?=\s|$))?\s*"  # what a comment line begins with


def words(text: Column) -> Column:
    """Lower-case words: runs of letters and digits."""
    return F.filter(F.split(F.lower(text), _SEPARATOR), lambda w: w != "")


def _grams(words: Column, n: int) -> Column:
    """Runs of n words, space-joined; none if there are fewer."""
    starts = F.when(
        F.size(words) >= n, F.sequence(F.lit(1), F.size(words) - (n - 1))
    ).otherwise(F.array().cast("array<int>"))
    return F.transform(starts, lambda i: F.array_join(F.slice(words, i, n), " "))


def _plain_words(text: str) -> list[str]:
    return "".join(c if c.isalnum() else " " for c in text.lower()).split()


def _gram_size(text: str) -> int:
    return 5 if len(_plain_words(text)) >= LONG else 2


def _shingles(text: str) -> list[str]:
    w, n = _plain_words(text), _gram_size(text)
    return list(dict.fromkeys(" ".join(w[i:i + n]) for i in range(len(w) - n + 1)))


def _has_cue(words: list[str]) -> bool:
    return any(re.match(_CUE, w) or re.match(_NAME_CUE, w) and {*words[max(i - 2, 0):i]} & {*BEFORE_NAMES}
               for i, w in enumerate(words))


@dataclass(frozen=True)
class Classifier:
    model: LogisticRegressionModel
    hashing: HashingTF
    temperature: float
    calibration_error: float


def _vector(rows: DataFrame, hashing: HashingTF) -> DataFrame:
    """Adds the sparse vector ``features`` of the array ``words``."""
    grams = rows.withColumn("_grams", F.concat("words", _grams(F.col("words"), 2)))
    return hashing.transform(grams).drop("_grams")


def _variants(text: str) -> list[str]:
    """A template and the ways it is met: words missing, words around it, cut off, other case."""
    w = text.split()
    dropped = [" ".join(w[:i] + w[i + 1:]) for i in range(len(w))] if len(w) >= LONG else []
    around = [f"{a} {text} {b}".strip() for a, b in (
        ("", "See the file for details."), ("Note: this file is", ""), ("This work is", "All rights reserved"),
        ("All content here is", "unless stated otherwise, as of 2020"))]
    cut = [" ".join(w[:-1]), " ".join(w[1:])] if len(w) >= LONG else []
    return [text, *dropped, *around, *cut]


def lines(docs: DataFrame, text: str = "text", id_column: str = "doc_id") -> DataFrame:
    """``doc_id, line, paragraph``: every non-empty line with its number from 0."""
    return docs.select(
        F.col(id_column).alias("doc_id"), F.posexplode(F.split(F.col(text), "\n")).alias(
            "line", "paragraph")
    ).where(F.trim("paragraph") != "")


def paragraphs(docs: DataFrame, text: str = "text", id_column: str = "doc_id") -> DataFrame:
    """``doc_id, line, lines``: the number of each paragraph's first line, and its lines."""
    stripped = F.transform(F.split(F.col(text), "\n"), lambda t: F.regexp_replace(t, _MARK, ""))
    # every line carries its number, so that blocks can be cut out of the joined text
    numbered = F.transform(stripped, lambda t, i: F.when(
        t.rlike(r"[\p{L}\p{N}]"), F.concat_ws(":", i, t)).otherwise(""))
    blocks = docs.select(
        F.col(id_column).alias("doc_id"),
        F.explode(F.split(F.array_join(numbered, "\n"), "\n\n+")).alias("_block"),
    ).withColumn("_block", F.ltrim(F.col("_block"), F.lit("\n"))).where("_block != ''")
    return blocks.select(
        "doc_id", F.substring_index("_block", ":", 1).cast("int").alias("line"),
        F.transform(F.split(F.rtrim(F.col("_block"), F.lit("\n")), "\n"),
                    lambda t: F.regexp_replace(t, "^[0-9]+:", "")).alias("lines"),
    )


def train(
    docs: DataFrame, text: str = "text", id_column: str = "doc_id", sample_docs: int = 400,
    sample_lines: int = 4_000, dimensions: int = 1 << 14, regularisation: float = 2e-4,
) -> Classifier:
    """Fit on the templates, the near misses, and at most ``sample_lines`` lines of the ``sample_docs``
    documents whose ids hash lowest. Sampled lines that hold a template's wording are left out."""
    spark = docs.sparkSession
    chosen = [r.i for r in docs.select(F.col(id_column).alias("i")).where("i is not null").orderBy(
        F.xxhash64("i"), "i").limit(sample_docs).collect()]
    sample = lines(docs.where(F.col(id_column).isin(chosen)) if chosen else docs.limit(0),
                   text, id_column)
    names = sorted({" ".join(_plain_words(n)) for known in NAMES.values() for n in known})
    headers = sorted({s for known in HEADERS.values() for t in known for s in _shingles(t)})
    worded = sample.select(words(F.col("paragraph")).alias("words"))
    joined = F.concat(F.lit(" "), F.array_join("words", " "), F.lit(" "))
    licensed = joined.rlike(" (?:" + "|".join(names + headers) + ") ")
    unknown = worded.where(~licensed).select(
        F.slice("words", 1, 2 * RADII[-1]).alias("words"), F.lit(0.0).alias("label")
    ).orderBy(F.xxhash64("words"), "words").limit(sample_lines)
    misses = [*NEAR_MISSES, *(f"{p} {a} {x}" for x in OTHERS for p in PHRASES for a in ARTICLES)]
    rows = [(_plain_words(v), float(CLASSES.index(f))) for f, texts in TEMPLATES.items()
            for t in texts for v in _variants(t)]
    rows += [(_plain_words(v), 0.0) for t in misses for v in _variants(t)]
    known = spark.createDataFrame(rows, "words array<string>, label double")
    hashing = HashingTF(inputCol="_grams", outputCol="features", numFeatures=dimensions, binary=True)
    made = _vector(known.unionByName(unknown), hashing)
    held_out = F.pmod(F.xxhash64("words"), F.lit(4)) == 0
    # few rows: two partitions keep the iterations short
    model = LogisticRegression(
        family="multinomial", regParam=regularisation, maxIter=40,
    ).fit(made.where(~held_out).select("features", "label").coalesce(2))
    scored = stage(model.transform(made.where(held_out)).select(
        F.col("label").cast("int").alias("label"), F.col("prediction").cast("int").alias("best"),
        vector_to_array("rawPrediction").alias("raw")
    ).coalesce(2).withColumn("top", F.array_max("raw")), "licence-held-out")
    grid = [0.25, 0.35, 0.5, 0.7, 1.0, 1.4, 2.0, 2.8, 4.0]
    losses = scored.agg(*[
        F.avg(-F.log(_softmax(F.element_at("raw", F.col("label") + 1), t) + 1e-12)).alias(f"t{i}")
        for i, t in enumerate(grid)
    ]).first()
    temperature = grid[min(range(len(grid)), key=lambda i: losses[i])]
    sure = scored.select(
        _softmax(F.col("top"), temperature).alias("p"), (F.col("label") == F.col("best")).alias("right"))
    bins = sure.groupBy(F.floor(F.least(F.col("p"), F.lit(0.999)) * 10)).agg(
        F.count("*").alias("n"), F.abs(F.avg("p") - F.avg(F.col("right").cast("double"))).alias("gap"))
    error = bins.agg((F.sum(F.col("n") * F.col("gap")) / F.sum("n")).alias("e")).first().e
    return Classifier(model, hashing, temperature, error)


def _softmax(score: Column, temperature: float) -> Column:
    """The probability of a class with this ``score`` among the scores ``raw``, whose largest is
    ``top`` (named columns, as each is used several times)."""
    total = F.aggregate(
        "raw", F.lit(0.0), lambda a, x: a + F.exp((x - F.col("top")) / F.lit(temperature)))
    return F.exp((score - F.col("top")) / F.lit(temperature)) / total


def _scored(rows: DataFrame, classifier: Classifier) -> DataFrame:
    """Adds ``raw`` and ``top``: the scores of all classes, and the highest."""
    return classifier.model.transform(_vector(rows, classifier.hashing)).select(
        *rows.columns, vector_to_array("rawPrediction").alias("raw")
    ).withColumn("top", F.array_max("raw"))


def classify(rows: DataFrame, classifier: Classifier) -> DataFrame:
    """Adds ``family`` (the likeliest class) and its calibrated ``probability`` to texts in ``paragraph``."""
    names = F.array(*[F.lit(c) for c in CLASSES])
    scored = _scored(rows.withColumn("words", words(F.col("paragraph"))), classifier)
    best = F.array_position("raw", F.col("top")).cast("int")
    return scored.select(
        *rows.columns, F.element_at(names, best).alias("family"),
        _softmax(F.col("top"), classifier.temperature).alias("probability"))


def candidates(docs: DataFrame, text: str = "text", id_column: str = "doc_id") -> DataFrame:
    """Paragraphs with a cue: ``_block``, a number, ``doc_id, line, lines, words, at`` (of each word the
    line it is in, from 0) and ``cues``, the places of cue words."""
    marked = docs.where(F.col(text).rlike(_CUE_IN_TEXT))
    blocks = paragraphs(marked, text, id_column).where(
        F.exists("lines", lambda t: t.rlike(_CUE_IN_TEXT)))
    worded = blocks.withColumn("_worded", F.transform("lines", words))
    numbers = F.transform("_worded", lambda w, i: F.array_repeat(i, F.size(w)))
    # a generator, as an optimizer that merges projections would split the text for every use
    flat = worded.select("doc_id", "line", "lines", F.inline(F.array(F.struct(
        F.flatten("_worded").alias("words"), F.flatten(numbers).alias("at")))))
    near = F.array(*map(F.lit, BEFORE_NAMES))
    is_cue = lambda w, i: w.rlike(_CUE) | (w.rlike(_NAME_CUE) & F.coalesce(
        F.arrays_overlap(F.slice("words", F.greatest(i - 1, F.lit(1)), F.least(i, F.lit(2))), near), F.lit(False)))
    places = F.filter(
        F.transform("words", lambda w, i: F.when(is_cue(w, i), i)), lambda i: i.isNotNull())
    return flat.withColumn("cues", places).where(F.size("cues") > 0).withColumn(
        "_block", F.monotonically_increasing_id())


def proposals(found: DataFrame, classifier: Classifier, min_probability: float) -> DataFrame:
    """``_block, family, low, high, probability``: the windows of words around cues (places ``low`` up
    to ``high``) of ``candidates`` and the families the classifier names there."""
    windows = F.transform("cues", lambda p: F.transform(
        F.array(*map(F.lit, RADII)), lambda r: F.struct(
            F.greatest(p - r, F.lit(0)).alias("low"),
            F.least(p + r + 1, F.size("words")).alias("high"))))
    cut = F.transform(F.flatten(windows), lambda w: F.struct(
        w["low"].alias("low"), w["high"].alias("high"),
        F.slice("words", w["low"] + 1, w["high"] - w["low"]).alias("words")))
    scored = _scored(found.select("_block", F.inline(cut)), classifier)
    names = F.array(*[F.lit(c) for c in CLASSES])
    named = F.transform("raw", lambda x, i: F.struct(
        F.element_at(names, i + 1).alias("family"),
        _softmax(x, classifier.temperature).alias("probability")))
    return scored.select("_block", "low", "high", F.inline(F.filter(
        named, lambda n: (n["family"] != UNKNOWN) & (n["probability"] >= min_probability))))


def _template_table(spark) -> DataFrame:
    """``gram, template, family, place, n``: every shingle of every template."""
    rows = [(shingle, f"{family}/{number}", family, place, len(_shingles(text)), _gram_size(text))
            for family, texts in TEMPLATES.items() for number, text in enumerate(texts)
            for place, shingle in enumerate(_shingles(text))]
    return spark.createDataFrame(
        rows, "gram string, template string, family string, place int, n int, size int")


def compare(
    found: DataFrame, named: DataFrame, min_similarity: float = MIN_SIMILARITY
) -> DataFrame:
    """The notices in ``candidates``: ``_block, family, similarity``, the lines ``a`` to ``b`` and the
    places of words ``low`` up to ``high``. A paragraph is compared with the templates of the families
    that are ``named`` in it (``_block, family``)."""
    def placed_grams(n: int) -> Column:
        return F.transform(_grams(F.col("words"), n), lambda g, i: F.struct(
            g.alias("gram"), i.alias("pos"), (i + n).alias("end")))

    known = sorted({g for texts in TEMPLATES.values() for t in texts for g in _shingles(t)})
    grams = F.filter(F.concat(placed_grams(2), placed_grams(5)), lambda g: g["gram"].isin(known))
    wanted = named.groupBy("_block").agg(F.collect_set("family").alias("families"))
    placed = found.join(wanted, "_block").select(
        "_block", "at", "families", F.explode(grams).alias("g")).select(
        "_block", "g.*", F.explode("families").alias("family"),
        F.get("at", F.col("g.pos")).alias("a"), F.get("at", F.col("g.end") - 1).alias("b"))
    # a few thousand rows, whatever the corpus
    hits = placed.join(_template_table(found.sparkSession), ["gram", "family"])
    template = Window.partitionBy("_block", "template")
    order = template.orderBy("pos")
    shift = (F.col("pos") - F.lag("pos").over(order)) - (F.col("place") - F.lag("place").over(order))
    goes_on = (F.col("place") > F.lag("place").over(order)) & (
        shift <= F.when(F.col("size") == 5, F.col("n")).otherwise(2))
    hits = hits.withColumn("_cut", (~F.coalesce(goes_on, F.lit(False))).cast("int"))
    hits = hits.withColumn("_run", F.sum("_cut").over(order))

    def share(window):
        return F.size(F.collect_set("place").over(window)) / F.col("n").cast("double")

    # in the template's order; or else, for headers, anywhere in one line; or else anywhere in the paragraph
    run = Window.partitionBy("_block", "template", "_run")
    line = Window.partitionBy("_block", "template", "_line")
    is_header, none = F.col("size") == 5, F.lit(0.0)
    hits = hits.withColumn("_line", F.when(F.col("a") == F.col("b"), F.col("a"))).withColumn(
        "_by_run", share(run)).withColumn("_by_line", F.when(
            is_header & F.col("_line").isNotNull()
            & (F.max("_by_run").over(line) < min_similarity), share(line)).otherwise(none))
    best = F.greatest("_by_run", "_by_line")
    hits = hits.withColumn("_by_block", F.when(
        is_header & (F.max(best).over(template) < min_similarity), share(template)).otherwise(none))
    kind = (F.when(F.col("_by_run") >= min_similarity, F.struct(F.lit(0).alias("k"), F.col("_run").alias("i")))
            .when(F.col("_by_line") >= min_similarity, F.struct(F.lit(1).alias("k"), F.col("_line").cast("long").alias("i")))
            .when(F.col("_by_block") >= min_similarity, F.struct(F.lit(2).alias("k"), F.lit(0).cast("long").alias("i"))))
    single = hits.withColumn("_kind", kind).where("_kind is not null").groupBy(
        "_block", "template", "family", "_kind").agg(
        F.max(F.greatest(best, "_by_block")).alias("similarity"), F.min("a").alias("a"),
        F.max("b").alias("b"), F.min("pos").alias("low"), F.max("end").alias("high"))
    return _rivals_out(single)


def _rivals_out(single: DataFrame) -> DataFrame:
    """Of stretches of different families that share words the most similar stays (ties: the longer
    one, then the family); stretches of one family in one place are one notice.

    Places are compared within groups of stretches that overlap one another, found in order."""
    by_place = Window.partitionBy("_block").orderBy("low", "high", "template")
    before = F.max("high").over(by_place.rowsBetween(Window.unboundedPreceding, -1))
    grouped = single.withColumn(
        "_new", F.coalesce(F.col("low") >= before, F.lit(True)).cast("int")).withColumn(
        "_group", F.sum("_new").over(by_place.rowsBetween(Window.unboundedPreceding, 0)))
    best = Window.partitionBy("_block", "_group").orderBy(
        F.desc("similarity"), F.desc(F.col("high") - F.col("low")), "family").rowsBetween(
        Window.unboundedPreceding, Window.unboundedFollowing)
    first = grouped.withColumn("_first", F.first(F.struct("family", "low", "high")).over(best))
    overlaps = (F.col("low") < F.col("_first.high")) & (F.col("high") > F.col("_first.low"))
    stays = first.where((F.col("family") == F.col("_first.family")) | ~overlaps)
    return stays.groupBy("_block", "_group", "family").agg(
        F.max("similarity").alias("similarity"), F.min("a").alias("a"), F.max("b").alias("b"),
        F.min("low").alias("low"), F.max("high").alias("high")).drop("_group")


def find(
    docs: DataFrame, classifier: Classifier, text: str = "text", id_column: str = "doc_id",
    min_probability: float = 0.3, min_similarity: float = MIN_SIMILARITY,
) -> DataFrame:
    """``doc_id, line, last_line, paragraph, family, probability, similarity`` of confirmed notices;
    ``paragraph`` is their lines, ``probability`` that of the surest window."""
    # numbered and read three times
    found = stage(candidates(docs, text, id_column), "licence-paragraphs")
    named = stage(proposals(found, classifier, min_probability), "licence-proposals")
    notices = compare(found, named, min_similarity)
    window = named.select("_block", "family", F.col("low").alias("_from"), F.col("high").alias("_to"),
                          "probability")
    confirmed = notices.join(window, ["_block", "family"]).where(
        (F.col("low") < F.col("_to")) & (F.col("high") > F.col("_from"))
    ).groupBy("_block", "family", "similarity", "a", "b", "low", "high").agg(
        F.max("probability").alias("probability"))
    cut = F.array_join(F.slice("lines", F.col("a") + 1, F.col("b") - F.col("a") + 1), " ")
    return found.select("_block", "doc_id", "line", "lines").join(confirmed, "_block").select(
        "doc_id", (F.col("line") + F.col("a")).alias("line"),
        (F.col("line") + F.col("b")).alias("last_line"), cut.alias("paragraph"), "family",
        "probability", "similarity")


def scan(docs: DataFrame, text: str = "text", id_column: str = "doc_id", **settings) -> DataFrame:
    """Train on ``docs`` and the templates, then ``find``."""
    return find(docs, train(docs, text, id_column), text, id_column, **settings)


for _family, _texts in TEMPLATES.items():
    for _text in _texts:
        if not _has_cue(_plain_words(_text)):
            raise ValueError(f"no cue in a template: {_text}")
