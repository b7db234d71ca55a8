"""License scans: exact phrases, and diagonal voting against license texts.

Base: places where a phrase's words stand in a row. Voting: every run of GRAM words of a text that
also occurs in a template is joined with its template positions; each match votes for a diagonal
(position in the text minus position in the template). Neighbouring diagonals of one place, which
a dropped or added word or two leave behind, are merged, and a merged span is a hit if the different
template positions it met make up at least AGREE of the template's runs and it is not much longer
than the template. Templates are short notices and the bodies of short licenses.

Words are runs of [0-9a-z] and everything beyond ASCII, after lower-casing A-Z. The texts' own
runs are compared with the templates' in the task that reads them; only matches are shuffled, by
document. Null, empty and wordless texts have 0 words and no labels; rows stay as they are, and
repeated rows of one doc_id share their hits. Other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from ledgerlark.llm.common import by_batch
from ledgerlark.llm.words import ALNUM, split_words, text_slices, windows
from ledgerlark.session import Staging, tune

# Phrases and their labels.
PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}
GRAM, AGREE, SLACK = 3, 0.6, 3
# Label and wording of license notices and of short licenses.
TEMPLATES = (
    ("apache-2.0", "licensed under the apache license version 2 0"),
    ("apache-2.0", "you may not use this file except in compliance with the license you may obtain a copy of the license at"),
    ("mit", "released under the mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"),
    ("gpl-3.0", "licensed under the gnu general public license version 3"),
    ("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license"),
    ("lgpl", "licensed under the gnu lesser general public license"),
    ("agpl", "licensed under the gnu affero general public license"),
    ("mpl-2.0", "this source code form is subject to the terms of the mozilla public license v 2 0"),
    ("cc-by-nc", "licensed under cc by nc 4 0"),
    ("cc-by-sa", "licensed under cc by sa 4 0"),
    ("cc-by-4.0", "this work is licensed under a creative commons attribution 4 0 international license"),
    ("unlicense", "this is free and unencumbered software released into the public domain"),
    (
        "mit",
        "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software "
        "to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense "
        "and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions the "
        "above copyright notice and this permission notice shall be included in all copies or substantial portions of the software the software is "
        "provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a "
        "particular purpose and noninfringement in no event shall the authors or copyright holders be liable for any claim damages or other liability "
        "whether in an action of contract tort or otherwise arising from out of or in connection with the software or the use or other dealings in the "
        "software",
    ),
    (
        "bsd",
        "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met 1 "
        "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer 2 redistributions "
        "in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or "
        "other materials provided with the distribution 3 neither the name of the copyright holder nor the names of its contributors may be used to "
        "endorse or promote products derived from this software without specific prior written permission this software is provided by the copyright "
        "holders and contributors as is and any express or implied warranties including but not limited to the implied warranties of merchantability "
        "and fitness for a particular purpose are disclaimed in no event shall the copyright holder or contributors be liable for any direct indirect "
        "incidental special exemplary or consequential damages including but not limited to procurement of substitute goods or services loss of use "
        "data or profits or business interruption however caused and on any theory of liability whether in contract strict liability or tort including "
        "negligence or otherwise arising in any way out of the use of this software even if advised of the possibility of such damage",
    ),
    (
        "isc",
        "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above "
        "copyright notice and this permission notice appear in all copies the software is provided as is and the author disclaims all warranties with "
        "regard to this software including all implied warranties of merchantability and fitness in no event shall the author be liable for any special "
        "direct indirect or consequential damages or any damages whatsoever resulting from loss of use data or profits whether in an action of contract "
        "negligence or other tortious action arising out of or in connection with the use or performance of this software",
    ),
    (
        "zlib",
        "this software is provided as is without any express or implied warranty in no event will the authors be held liable for any damages arising "
        "from the use of this software permission is granted to anyone to use this software for any purpose including commercial applications and to "
        "alter it and redistribute it freely subject to the following restrictions 1 the origin of this software must not be misrepresented you must "
        "not claim that you wrote the original software if you use this software in a product an acknowledgment in the product documentation would be "
        "appreciated but is not required 2 altered source versions must be plainly marked as such and must not be misrepresented as being the original "
        "software 3 this notice may not be removed or altered from any source distribution",
    ),
    (
        "apache-2.0",
        "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license you may obtain a copy "
        "of the license at http www apache org licenses license 2 0 unless required by applicable law or agreed to in writing software distributed "
        "under the license is distributed on an as is basis without warranties or conditions of any kind either express or implied see the license for "
        "the specific language governing permissions and limitations under the license",
    ),
    (
        "gpl",
        "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the "
        "free software foundation either version 3 of the license or at your option any later version this program is distributed in the hope that it "
        "will be useful but without any warranty without even the implied warranty of merchantability or fitness for a particular purpose see the gnu "
        "general public license for more details you should have received a copy of the gnu general public license along with this program",
    ),
)


def _hashes(text: str, width: int) -> np.ndarray:
    data = np.frombuffer(text.encode(), np.uint8)
    return windows(split_words(data, np.array([0, len(data)]), ALNUM, fold=True), width)[1]


def _template_rows(templates) -> list[tuple]:
    return [
        (number, label, int(at), int(h), len(hashes))
        for number, (label, text) in enumerate(templates)
        for hashes in [_hashes(text, GRAM).view(np.int64)]
        for at, h in enumerate(hashes.tolist())
    ]


def _members(hashes: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Which hashes are in the sorted array `wanted`."""
    if not len(wanted):
        return np.zeros(len(hashes), bool)
    at = np.minimum(np.searchsorted(wanted, hashes), len(wanted) - 1)
    return wanted[at] == hashes


def _scan(phrases: dict[str, str], grams: np.ndarray):
    """Per document: words, base places and their labels, and the runs that occur in a template."""
    bases = [(len(p.split()), _hashes(p, len(p.split()))[0], label) for p, label in phrases.items()]

    def run(batch: pa.RecordBatch):
        for low, high, data, offsets in text_slices(batch.column(1)):
            words = split_words(data, offsets, ALNUM, fold=True)
            n = high - low
            row_of = np.repeat(np.arange(n), words.counts)
            count, first, last = np.zeros(n, np.int64), np.full(n, np.iinfo(np.int64).max), np.full(n, -1)
            labels: list[set] = [set() for _ in range(n)]
            for width, wanted, label in bases:
                start, h = windows(words, width)
                start = start[h == wanted]
                rows = row_of[start]
                at = start - words.rows[rows]
                np.add.at(count, rows, 1)
                np.minimum.at(first, rows, at)
                np.maximum.at(last, rows, at)
                for r in np.unique(rows).tolist():
                    labels[r].add(label)
            start, h = windows(words, GRAM)
            hit = _members(h, grams)
            start, h = start[hit], h[hit]
            rows = row_of[start]
            bounds = np.searchsorted(rows, np.arange(n + 1)).astype(np.int32)
            none = count == 0
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).slice(low, n), pa.array(words.counts.astype(np.int64)), pa.array(count),
                    pa.array(first, mask=none), pa.array(last, mask=none), pa.array([sorted(x) for x in labels], pa.list_(pa.string())),
                    pa.ListArray.from_arrays(pa.array(bounds), pa.array((start - words.rows[rows]).astype(np.int64))),
                    pa.ListArray.from_arrays(pa.array(bounds), pa.array(h.view(np.int64))),
                ],
                names=["doc_id", "n_words", "n_base", "first_word", "last_word", "base", "at", "h"],
            )

    return by_batch(run)


def spans(spark: SparkSession, scanned: DataFrame, templates=TEMPLATES) -> DataFrame:
    """doc_id, label, first_word, last_word and score of every verified template span."""
    positions = spark.createDataFrame(_template_rows(templates), "template int, label string, place long, h long, grams long")
    hits = scanned.where("size(h) > 0").select("doc_id", F.explode(F.arrays_zip("at", "h")).alias("x")).select("doc_id", "x.at", "x.h")
    # The templates are a constant of this module or a caller's list, never a table that grows.
    met = hits.join(F.broadcast(positions), "h").withColumn("diagonal", F.col("at") - F.col("place"))
    near = Window.partitionBy("doc_id", "template").orderBy("diagonal", "at")
    before = F.max("at").over(near.rowsBetween(Window.unboundedPreceding, -1))
    fresh = F.coalesce((F.col("diagonal") - F.lag("diagonal").over(near) > SLACK) | (F.col("at") - before > F.col("grams")), F.lit(True))
    groups = met.withColumn("fresh", fresh.cast("int")).withColumn("span", F.sum("fresh").over(near))
    # A template position counts once in a span, on however many diagonals a repeated run meets it.
    merged = groups.groupBy("doc_id", "template", "label", "grams", "span").agg(
        F.count_distinct("place").alias("votes"), F.min("at").alias("first_word"), (F.max("at") + GRAM - 1).alias("last_word")
    )
    score = F.least(F.col("votes") / F.col("grams"), F.lit(1.0))
    long = F.col("last_word") - F.col("first_word") + 1 > 1.5 * (F.col("grams") + GRAM - 1) + SLACK
    return merged.withColumn("score", score).where((F.col("score") >= AGREE) & ~long).select(
        "doc_id", "label", "first_word", "last_word", "score"
    )


def scan_licenses(docs: DataFrame, work: Staging, phrases=None, templates=TEMPLATES) -> tuple[DataFrame, DataFrame]:
    """(one row per document, the verified spans).

    The first has doc_id, n_words, n_base, first_word, last_word, base_labels, labels and score:
    1 for a text with a base place, else the best span's share of its template, else 0.
    """
    spark = tune(docs.sparkSession)
    grams = np.unique(np.array([r[3] for r in _template_rows(templates)], np.int64)).view(np.uint64)
    plain = docs.select(F.col("doc_id"), F.col("text").cast("string"))
    kind = plain.schema["doc_id"].dataType.simpleString()
    scanned = work.table(
        plain.mapInArrow(
            _scan(PHRASES if phrases is None else phrases, np.sort(grams)),
            f"doc_id {kind}, n_words long, n_base long, first_word long, last_word long, base array<string>, at array<long>, h array<long>",
        ),
        "scanned",
    )
    found = work.table(spans(spark, scanned, templates), "spans")
    own = found.groupBy("doc_id").agg(F.collect_set("label").alias("own"), F.max("score").alias("own_score"))
    labels = F.array_sort(F.array_union("base", F.coalesce("own", F.array().cast("array<string>"))))
    score = F.when(F.col("n_base") > 0, F.lit(1.0)).otherwise(F.coalesce("own_score", F.lit(0.0)))
    result = scanned.select("doc_id", "n_words", "n_base", "first_word", "last_word", "base").join(own, "doc_id", "left").select(
        "doc_id", "n_words", "n_base", "first_word", "last_word",
        F.array_join("base", ",").alias("base_labels"), F.array_join(labels, ",").alias("labels"), score.alias("score"),
    )
    return result, found
