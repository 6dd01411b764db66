"""License scan by diagonal voting of word k-grams against license texts."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidewire.functions.columns import compute_once
from tidewire.llm.common import settle

# The base phrases with their labels, and public license wording.
PHRASES = (
    ("gnu general public license", "gpl"),
    ("apache license", "apache"),
    ("cc by", "cc-by"),
    ("mit license", "mit"),
)
TEMPLATES = (
    ("gpl-notice", "this program is free software you can redistribute it and or modify it under "
     "the terms of the gnu general public license as published by the free software foundation"),
    ("gpl-notice", "this work is licensed under the gnu general public license version 3"),
    ("lgpl-notice", "this library is free software you can redistribute it and or modify it under "
     "the terms of the gnu lesser general public license"),
    ("apache-2.0-notice", "licensed under the apache license version 2 0 the license you may not "
     "use this file except in compliance with the license"),
    ("apache-2.0-notice", "licensed under the apache license version 2 0"),
    ("mit-notice", "permission is hereby granted free of charge to any person obtaining a copy of "
     "this software and associated documentation files the software to deal in the software "
     "without restriction"),
    ("mit-notice", "released under the mit license"),
    ("bsd-notice", "redistribution and use in source and binary forms with or without modification "
     "are permitted provided that the following conditions are met"),
    ("mpl-2.0-notice", "this source code form is subject to the terms of the mozilla public "
     "license v 2 0"),
    ("cc-by-nc-notice", "licensed under cc by nc 4 0"),
    ("cc-by-sa-notice", "licensed under cc by sa 4 0"),
    ("cc-by-notice", "this work is licensed under a creative commons attribution 4 0 "
     "international license"),
    ("cc0-notice", "to the extent possible under law the author has waived all copyright and "
     "related or neighboring rights to this work"),
    ("all-rights-reserved", "all rights reserved"),
    ("mit-body", "permission is hereby granted free of charge to any person obtaining a copy of this "
     "software and associated documentation files the software to deal in the software without "
     "restriction including without limitation the rights to use copy modify merge publish "
     "distribute sublicense and or sell copies of the software and to permit persons to whom the "
     "software is furnished to do so subject to the following conditions the above copyright "
     "notice and this permission notice shall be included in all copies or substantial portions "
     "of the software the software is provided as is without warranty of any kind express or "
     "implied including but not limited to the warranties of merchantability fitness for a "
     "particular purpose and noninfringement in no event shall the authors or copyright holders "
     "be liable for any claim damages or other liability whether in an action of contract tort or "
     "otherwise arising from out of or in connection with the software or the use or other "
     "dealings in the software"),
    ("isc-body", "permission to use copy modify and or distribute this software for any purpose with "
     "or without fee is hereby granted provided that the above copyright notice and this "
     "permission notice appear in all copies the software is provided as is and the author "
     "disclaims all warranties with regard to this software including all implied warranties of "
     "merchantability and fitness in no event shall the author be liable for any special direct "
     "indirect or consequential damages or any damages whatsoever resulting from loss of use data "
     "or profits whether in an action of contract negligence or other tortious action arising out "
     "of or in connection with the use or performance of this software"),
    ("bsd-2-body", "redistribution and use in source and binary forms with or without modification "
     "are permitted provided that the following conditions are met 1 redistributions of source "
     "code must retain the above copyright notice this list of conditions and the following "
     "disclaimer 2 redistributions in binary form must reproduce the above copyright notice this "
     "list of conditions and the following disclaimer in the documentation and or other materials "
     "provided with the distribution this software is provided by the copyright holders and "
     "contributors as is and any express or implied warranties including but not limited to the "
     "implied warranties of merchantability and fitness for a particular purpose are disclaimed"),
    ("zlib-body", "this software is provided as is without any express or implied warranty in no "
     "event will the authors be held liable for any damages arising from the use of this software "
     "permission is granted to anyone to use this software for any purpose including commercial "
     "applications and to alter it and redistribute it freely subject to the following "
     "restrictions 1 the origin of this software must not be misrepresented you must not claim "
     "that you wrote the original software if you use this software in a product an "
     "acknowledgment in the product documentation would be appreciated but is not required 2 "
     "altered source versions must be plainly marked as such and must not be misrepresented as "
     "being the original software 3 this notice may not be removed or altered from any source "
     "distribution"),
    ("unlicense-body", "this is free and unencumbered software released into the public domain anyone "
     "is free to copy modify publish use compile sell or distribute this software either in "
     "source code form or as a compiled binary for any purpose commercial or non commercial and "
     "by any means"),
    ("gpl-body", "this program is distributed in the hope that it will be useful but without any "
     "warranty without even the implied warranty of merchantability or fitness for a particular "
     "purpose see the gnu general public license for more details you should have received a copy "
     "of the gnu general public license along with this program"),
)

#: Words of a rolling gram.
GRAM = 3
#: Diagonals that are merged, by the template's grams: (fewer grams than, diagonals further).
#: A span's words may be that many more or less than the template's.
DRIFTS = ((8, 2), (40, 4), (1 << 30, 24))
#: Share of a template's grams that a span must hold in order, and the grams it must hold at
#: least unless the template has fewer.
COVERAGE = 0.6
LEAST_HELD = 4

#: Words of a cell: no span is longer.
CELL = max(len(t.split()) for _, t in TEMPLATES) + DRIFTS[-1][1]

_DOCUMENT = ["doc_id", "text_key"]

WORD_BREAK = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def _words(text: Column) -> Column:
    # lower() also turns letters beyond ASCII: they stay inside words and in no phrase
    lower = F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), WORD_BREAK, " ")
    bare = F.trim(lower)
    return F.when(bare == "", F.array().cast("array<string>")).otherwise(F.split(bare, " "))


def template_grams(spark: SparkSession) -> DataFrame:
    """``gram, template, label, at, of``: every k-gram of every template; some hundred rows."""
    rows = spark.createDataFrame(
        [(i, label, text) for i, (label, text) in enumerate(TEMPLATES)],
        "template int, label string, text string",
    )
    words = F.split("text", " ")
    starts = F.sequence(F.lit(1), F.size(words) - GRAM + 1)
    grams = F.transform(starts, lambda i: F.array_join(F.slice(words, i, GRAM), " "))
    return rows.select("template", "label", F.size(grams).alias("of"),
                       F.posexplode(grams).alias("at", "gram"))


def _phrase_places(spaced: Column) -> dict[str, Column]:
    """Places of each phrase. Words stand between two blanks, so places that touch all count."""
    found = {}
    for phrase, label in PHRASES:
        wanted = " " + phrase.replace(" ", "  ") + " "
        gone = F.length(spaced) - F.length(F.replace(spaced, F.lit(wanted), F.lit("")))
        found[label] = (gone / len(wanted)).cast("long")
    return found


def scan(docs: DataFrame, *, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: ``doc_id, n_words, n_base, first_word, last_word, base_labels,
    labels, score``.

    Base labels are phrases whose words stand consecutively. The labels of license wording
    come from diagonals: every rolling k-gram of a text is joined by hash to its positions in
    the templates, matches are counted by document, template and offset (text position minus
    template position), and a diagonal is merged with those up to a drift further (DRIFTS), so
    a few words more or less do not break a span, and a span is no longer than its template and
    the drift. A span is verified on its words: of the template's grams, COVERAGE must stand
    in it in the template's order (LEAST_HELD at least, or all of a short template). Where
    verified spans of different labels overlap, the one with more grams, then with the greater
    share, then of the earlier template holds, so wording that licenses have in common does
    not name the wrong one. ``score`` is the best share that holds, and 1 with a base label.

    A null text is an empty one: no words, empty labels, score 0, null places. Repeated rows
    are scanned each. The templates are a fixed table of some hundred rows, small enough to
    be sent to all tasks whatever the corpus is; texts themselves are not shuffled.
    """
    rows = docs.select(
        F.col(key).alias("doc_id"), F.xxhash64(text).alias("text_key"),
        F.col(text).alias("tw_text"),
    )
    rows = compute_once(rows, {"tw_words": _words(F.col("tw_text"))}).drop("tw_text")
    base = settle(_base(rows))
    spans = _verified(rows, template_grams(docs.sparkSession)).select(
        F.col("doc_id").alias("s_doc_id"), F.col("text_key").alias("s_text_key"), "found", "share"
    )
    joined = base.join(
        spans, F.col("doc_id").eqNullSafe(F.col("s_doc_id"))
        & (F.col("text_key") == F.col("s_text_key")), "left",
    )
    of_base = [F.when(F.col(f"tw_{label}") > 0, F.lit(label)) for _, label in PHRASES]
    base_labels = F.array_compact(F.array(*of_base))
    none = F.array().cast("array<string>")

    def listed(labels: Column) -> Column:
        return F.array_join(F.array_sort(F.array_distinct(labels)), ",")

    return joined.select(
        "doc_id", "n_words", "n_base", "first_word", "last_word",
        listed(base_labels).alias("base_labels"),
        listed(F.concat(base_labels, F.coalesce("found", none))).alias("labels"),
        F.when(F.col("n_base") > 0, 1.0).otherwise(F.coalesce("share", F.lit(0.0))).alias("score"),
    )


def _base(rows: DataFrame) -> DataFrame:
    """Counts and places of the base phrases, a narrow row per document."""
    spaced = F.concat(F.lit("  "), F.array_join("tw_words", "  "), F.lit("  "))
    rows = compute_once(
        rows.select("doc_id", "text_key", F.size("tw_words").cast("long").alias("n_words"),
                    "tw_words"),
        {"tw_spaced": spaced},
    ).drop("tw_words")
    places = _phrase_places(F.col("tw_spaced"))
    rows = compute_once(rows, {f"tw_{label}": n for label, n in places.items()})
    n_base = sum(F.col(f"tw_{label}") for label in places)
    phrases = "|".join(p.replace(" ", "  ") for p, _ in PHRASES)

    def words_before(head: str) -> Column:
        before = F.regexp_extract("tw_spaced", rf"(?s)^({head}) (?:{phrases}) ", 1)
        return F.when(n_base > 0, F.regexp_count(before, F.lit("[^ ]+")).cast("long"))

    return rows.select(
        "doc_id", "text_key", "n_words", *[f"tw_{label}" for label in places],
        n_base.alias("n_base"), words_before(".*?").alias("first_word"),
        words_before(".*").alias("last_word"),
    )


def _least() -> Column:
    return F.greatest(F.ceil(F.col("of") * COVERAGE), F.least("of", F.lit(LEAST_HELD)))


def _drift(by_drift: Callable[[int], Column]) -> Column:
    """The value that belongs to the drift of a template of ``of`` grams."""
    return F.coalesce(*[F.when(F.col("of") < below, by_drift(drift)) for below, drift in DRIFTS])


def _hits(rows: DataFrame, templates: DataFrame) -> DataFrame:
    """``doc_id, text_key, template, label, of, at, diagonal`` of every gram that is a template's."""
    grams = F.when(
        F.size("tw_words") >= GRAM,
        F.transform(F.sequence(F.lit(1), F.size("tw_words") - GRAM + 1),
                    lambda i: F.array_join(F.slice("tw_words", i, GRAM), " ")),
    )
    rolling = rows.select(*_DOCUMENT, F.posexplode(grams).alias("place", "words")).withColumn(
        "hash", F.xxhash64("words")
    )
    known = F.broadcast(templates.withColumn("t_hash", F.xxhash64("gram")))
    return (
        rolling.join(known, (F.col("hash") == F.col("t_hash")) & (F.col("words") == F.col("gram")))
        .select(*_DOCUMENT, "template", "label", "of", "at",
                (F.col("place") - F.col("at")).alias("diagonal"))
        .distinct()
    )


def _spans(hits: DataFrame) -> DataFrame:
    """Verified spans: ``template, label, first, last, held, share`` of a document.

    Only diagonals whose band has enough votes meet their hits again. Of a template's gram the
    place nearest to the band's fullest diagonal counts, and only if it lies behind those of
    all earlier grams.
    """
    votes = hits.groupBy(*_DOCUMENT, "template", "label", "of", "diagonal").agg(
        F.count(F.lit(1)).alias("n")
    )
    along = Window.partitionBy(*_DOCUMENT, "template").orderBy("diagonal")
    in_band = _drift(lambda drift: F.sum("n").over(along.rangeBetween(0, drift)))
    key = [*_DOCUMENT, "template", "diagonal"]
    fullest = _drift(lambda drift: F.max_by("diagonal", F.struct("n", -F.col("diagonal"))).over(
        along.rangeBetween(0, drift)))
    bands = votes.withColumns({"votes": in_band, "main": fullest}).filter(
        F.col("votes") >= _least()
    ).select(
        *_DOCUMENT, "template", "main", F.col("diagonal").alias("band"),
        F.explode(F.sequence("diagonal", F.col("diagonal") + _drift(F.lit))).alias("diagonal"),
    ).select("band", "main", *[F.col(c).alias(f"b_{c}") for c in key])
    band = [*_DOCUMENT, "template", "label", "of", "band"]
    placed = (
        hits.join(bands, reduce(and_, [F.col(c).eqNullSafe(F.col(f"b_{c}")) for c in key]))
        .groupBy(*band, "at").agg((F.col("at") + F.min_by(
            "diagonal", F.struct(F.abs(F.col("diagonal") - F.col("main")), "diagonal")
        )).alias("place"))
    )
    earlier = Window.partitionBy(*band).orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    in_order = placed.withColumn("reached", F.max("place").over(earlier)).filter(
        F.col("reached").isNull() | (F.col("place") > F.col("reached"))
    )
    return (
        in_order.groupBy(*band).agg(
            F.count(F.lit(1)).alias("held"), F.min("place").alias("first"),
            (F.max("place") + (GRAM - 1)).alias("last"),
        )
        .filter(F.col("held") >= _least())
        .withColumn("share", F.col("held") / F.col("of"))
    )


def _verified(rows: DataFrame, templates: DataFrame) -> DataFrame:
    """``doc_id, text_key, found, share``: labels of the spans that hold, and the best share.

    A span is no longer than CELL words, so it can only overlap spans of the cells it touches;
    a text with very many spans compares them within its cells.
    """
    spans = settle(_spans(settle(_hits(rows, templates))))
    cells = F.explode(F.array_distinct(F.array(
        F.floor(F.col("first") / CELL), F.floor(F.col("last") / CELL)
    )))
    better = spans.select(
        cells.alias("b_cell"), *[F.col(c).alias(f"b_{c}") for c in (
            *_DOCUMENT, "template", "label", "first", "last", "held", "share")],
    ).distinct()
    order = (
        (F.col("b_held") > F.col("held"))
        | ((F.col("b_held") == F.col("held")) & (F.col("b_share") > F.col("share")))
        | ((F.col("b_share") == F.col("share")) & (F.col("b_held") == F.col("held"))
           & (F.col("b_template") < F.col("template")))
    )
    beaten = spans.withColumn("cell", cells).join(
        better, reduce(and_, [F.col(c).eqNullSafe(F.col(f"b_{c}")) for c in _DOCUMENT])
        & (F.col("cell") == F.col("b_cell")) & (F.col("label") != F.col("b_label"))
        & (F.col("first") <= F.col("b_last")) & (F.col("b_first") <= F.col("last")) & order,
        "left_semi",
    ).select(*[F.col(c).alias(f"x_{c}") for c in (*_DOCUMENT, "template", "band")])
    gone = [F.col(c).eqNullSafe(F.col(f"x_{c}")) for c in (*_DOCUMENT, "template", "band")]
    return spans.join(beaten, reduce(and_, gone), "left_anti").groupBy(*_DOCUMENT).agg(
        F.collect_set("label").alias("found"), F.max("share").alias("share")
    )
