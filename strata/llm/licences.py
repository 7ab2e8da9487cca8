"""Licence scan: a trained paragraph classifier, calibrated, confirmed by templates.

Main path in DataFrame functions and Spark ML only.  Paragraphs (lines, cut further at
sentence ends) become binary vectors of hashed words and word pairs; a sparse
multinomial logistic regression names the licence family or ``unknown``.  It is trained
on windows of the templates below and, as ``unknown``, on a bounded sample of corpus
paragraphs and on templates with their words reordered.  A prediction counts only if the
paragraph's word pairs agree with a template of that family.  The threshold on the
predicted probability is calibrated on all paragraphs that are far from every template, by a
histogram over the whole corpus: paragraphs of licences that no template confirms, of
which code and packages are full, are near some template and play no part in it.

The templates are a parameter, a mapping from family to texts.
"""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import HashingTF, NGram
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm.common import stage

UNKNOWN = "unknown"

# Notices and clauses by which public licences are recognised.
TEMPLATES = {
    "MIT": [
        "Released under the MIT License.",
        "This project is licensed under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software",
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
        "THE SOFTWARE IS PROVIDED AS IS, WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT.",
        "IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
        "SPDX-License-Identifier: MIT",
    ],
    "Apache-2.0": [
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
        "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an AS IS BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.",
        "See the License for the specific language governing permissions and limitations under the License.",
        "Subject to the terms and conditions of this License, each Contributor hereby grants to You a perpetual, worldwide, non-exclusive, no-charge, royalty-free, irrevocable copyright license to reproduce, prepare Derivative Works of, publicly display, publicly perform, sublicense, and distribute the Work and such Derivative Works in Source or Object form.",
        "You must cause any modified files to carry prominent notices stating that You changed the files",
        "SPDX-License-Identifier: Apache-2.0",
    ],
    "GPL": [
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
        "You should have received a copy of the GNU General Public License along with this program. If not, see https://www.gnu.org/licenses/.",
        "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.",
        "See the GNU General Public License for more details.",
        "Everyone is permitted to copy and distribute verbatim copies of this license document, but changing it is not allowed.",
        "SPDX-License-Identifier: GPL-3.0-or-later",
        "SPDX-License-Identifier: GPL-2.0-only",
    ],
    "LGPL": [
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version.",
        "Licensed under the GNU Lesser General Public License, version 3.",
        "See the GNU Lesser General Public License for more details.",
        "SPDX-License-Identifier: LGPL-3.0-or-later",
    ],
    "AGPL": [
        "Licensed under the GNU Affero General Public License, version 3.",
        "you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation",
        "SPDX-License-Identifier: AGPL-3.0-or-later",
    ],
    "BSD": [
        "Licensed under the BSD 3-Clause License.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
        "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
        "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.",
        "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.",
        "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS AS IS AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED.",
        "IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES",
        "SPDX-License-Identifier: BSD-3-Clause",
        "SPDX-License-Identifier: BSD-2-Clause",
    ],
    "MPL-2.0": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.",
        "SPDX-License-Identifier: MPL-2.0",
    ],
    "CC-BY": [
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
        "SPDX-License-Identifier: CC-BY-4.0",
    ],
    "CC-BY-SA": [
        "Licensed under CC BY-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
        "SPDX-License-Identifier: CC-BY-SA-4.0",
    ],
    "CC-BY-NC": [
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
        "SPDX-License-Identifier: CC-BY-NC-4.0",
    ],
    "CC0": [
        "This work is dedicated to the public domain under CC0 1.0 Universal.",
        "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work.",
        "SPDX-License-Identifier: CC0-1.0",
    ],
    "ISC": [
        "Licensed under the ISC License.",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
        "THE SOFTWARE IS PROVIDED AS IS AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS.",
        "IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS",
        "SPDX-License-Identifier: ISC",
    ],
    "zlib": [
        "This software is provided as-is, without any express or implied warranty.",
        "Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions",
        "The origin of this software must not be misrepresented; you must not claim that you wrote the original software.",
        "Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software.",
        "SPDX-License-Identifier: Zlib",
    ],
    "BSL-1.0": [
        "Distributed under the Boost Software License, Version 1.0.",
        "Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation covered by this license to use, reproduce, display, distribute, execute, and transmit the Software",
        "SPDX-License-Identifier: BSL-1.0",
    ],
    "Unlicense": [
        "This is free and unencumbered software released into the public domain.",
        "Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.",
        "SPDX-License-Identifier: Unlicense",
    ],
    "EPL": [
        "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is available at https://www.eclipse.org/legal/epl-2.0/",
        "THE ACCOMPANYING PROGRAM IS PROVIDED UNDER THE TERMS OF THIS ECLIPSE PUBLIC LICENSE",
        "SPDX-License-Identifier: EPL-2.0",
    ],
    "CDDL": [
        "The contents of this file are subject to the terms of the Common Development and Distribution License (the License). You may not use this file except in compliance with the License.",
        "SPDX-License-Identifier: CDDL-1.0",
    ],
    "proprietary": [
        "All rights reserved. No part of this publication may be reproduced, distributed, or transmitted in any form or by any means without the prior written permission of the publisher.",
    ],
}
Templates = Mapping[str, Sequence[str]]

N_FEATURES = 1 << 13
#: Bounds of the sample of corpus paragraphs the classifier sees: about so many documents,
#: at most so many paragraphs, of at most so many words.
SAMPLE_DOCS, MAX_UNKNOWN, MAX_UNKNOWN_WORDS = 1_000, 20_000, 200
#: Share of the paragraphs far from every template that stay below the calibrated threshold; the
#: threshold's floor and ceiling; probabilities are counted in steps of 1 / STEPS.
CALIBRATION, FLOOR, CEILING, STEPS = 0.999, 0.5, 0.95, 10_000
#: A paragraph is far from every template, so no licence text at all, if less than this share
#: of its word pairs is in any template.
FAR = 0.1
#: Share of a paragraph's word pairs (or of the template's) that a template must hold.
AGREEMENT = 0.6

#: Lines, cut at sentence ends before a capital letter.
_PARAGRAPH = r"[\r\n]+|(?<=[.!?])\s+(?=\p{Lu})"


def tokens_of(paragraph: Column) -> Column:
    return F.regexp_extract_all(F.lower(paragraph), F.lit(r"[\p{L}\p{N}]+"), F.lit(0))


def vectors(df: DataFrame, words: str = "words") -> DataFrame:
    """``df`` with ``pairs`` and the sparse binary vector ``features`` of its words and pairs."""
    both = NGram(n=2, inputCol=words, outputCol="pairs").transform(df).withColumn("terms", F.concat(words, "pairs"))
    return HashingTF(numFeatures=N_FEATURES, binary=True, inputCol="terms", outputCol="features").transform(both).drop("terms")


def families_of(templates: Templates) -> list[str]:
    """The classes: unknown, then the families in order (their place is the label)."""
    return [UNKNOWN, *templates]


def template_table(spark: SparkSession, templates: Templates = TEMPLATES) -> DataFrame:
    """(family, label, words): one row per template, a table of fixed size."""
    families = families_of(templates)
    rows = [(family, float(families.index(family)), body) for family, bodies in templates.items() for body in bodies]
    literals = F.array(*[F.struct(F.lit(f).alias("family"), F.lit(i).alias("label"), F.lit(b).alias("body")) for f, i, b in rows])
    return spark.range(1).select(F.inline(literals)).withColumn("words", tokens_of(F.col("body")))


def pairs_of(body: str) -> list[str]:
    """A template's distinct word pairs; of an SPDX tag those that name the licence."""
    w = re.findall(r"[^\W_]+", body.lower())
    pairs = list(dict.fromkeys(f"{a} {b}" for a, b in zip(w, w[1:])))
    return [p for p in pairs if p not in ("spdx license", "license identifier")] if body.startswith("SPDX") else pairs


def template_pairs(templates: Templates = TEMPLATES) -> Column:
    """Map from family to its templates' word pairs, as a literal."""
    return F.create_map(*[x for family, bodies in templates.items() for x in (
        F.lit(family), F.array(*[F.array(*[F.lit(p) for p in pairs_of(b)]) for b in bodies]))])


def agreement(pairs: Column, family: Column, templates: Templates = TEMPLATES) -> Column:
    """The best share of shared pairs with a template of ``family``: of the paragraph's
    pairs or of the template's, whichever is more (a notice inside a longer sentence)."""
    def share(t: Column) -> Column:
        common = F.size(F.array_intersect(pairs, t))
        return common / F.least(F.greatest(F.size(F.array_distinct(pairs)), F.lit(1)), F.size(t))

    return F.coalesce(F.array_max(F.transform(F.element_at(template_pairs(templates), family), share)), F.lit(0.0))


def far_from_all(pairs: Column, templates: Templates = TEMPLATES) -> Column:
    """Whether fewer than FAR of the pairs are in any template (one look-up per pair in a hash set)."""
    known = sorted({p for bodies in templates.values() for b in bodies for p in pairs_of(b)})
    return F.size(F.filter(pairs, lambda p: p.isin(known))) < F.lit(FAR) * F.greatest(F.size(pairs), F.lit(1))


def training_rows(paragraphs: DataFrame, templates: Templates = TEMPLATES) -> DataFrame:
    """(label, words) from template windows, reordered templates and the corpus."""
    spark = paragraphs.sparkSession
    table = template_table(spark, templates)
    widths = F.array(*[F.lit(n) for n in (5, 8, 12, 20, 400)])
    windows = (table.select("label", "words", F.explode(widths).alias("width"))
               .where((F.col("width") <= F.size("words")) | (F.col("width") == 400))
               .select("label", "words", "width", F.explode(F.expr("sequence(1, greatest(1, size(words) - width + 1), 2)")).alias("at"))
               .select("label", F.expr("slice(words, at, width)").alias("words")).distinct())
    mixed = table.select(F.lit(0.0).alias("label"), F.transform(
        F.array_sort(F.transform("words", lambda w: F.struct(F.xxhash64(w).alias("h"), w.alias("w")))), lambda s: s["w"]).alias("words"))
    sample = (paragraphs.where(F.size("words").between(1, MAX_UNKNOWN_WORDS))
              .select("words", F.xxhash64("words").alias("h")).orderBy("h").limit(MAX_UNKNOWN))
    pairs = F.expr("transform(sequence(1, greatest(size(words) - 1, 1)), i -> concat_ws(' ', get(words, i - 1), get(words, i)))")
    clean = sample.where(far_from_all(pairs, templates))
    return windows.unionByName(mixed).unionByName(clean.select(F.lit(0.0).alias("label"), "words"))


def fit(paragraphs: DataFrame, templates: Templates = TEMPLATES) -> LogisticRegressionModel:
    """The classifier, fitted on the templates and a bounded sample."""
    rows = stage(vectors(stage(training_rows(paragraphs, templates), "licence-rows")).select("label", "features"), "licence-train")
    weight = rows.agg(F.count_if(F.col("label") == 0).alias("u"), F.count_if(F.col("label") > 0).alias("k")).first()
    balance = max(1.0, weight["u"] / max(weight["k"], 1) / 2)
    return LogisticRegression(maxIter=60, regParam=1e-5, family="multinomial", standardization=False, weightCol="weight").fit(
        rows.withColumn("weight", F.when(F.col("label") > 0, balance).otherwise(1.0)))


def calibrated(scored: DataFrame) -> float:
    """The least step that CALIBRATION of the paragraphs far from every template stay at or below, in
    their probability of any family; at least FLOOR and at most CEILING.

    However much licence text the corpus holds, confirmed or not, it moves nothing: it is not
    far.  Counts per step are summed in the tasks first: STEPS + 1 numbers whatever the input.
    """
    bins = (scored.where(F.col("at").isNotNull() & F.col("far")).groupBy(F.ceil(F.col("known") * STEPS).cast("int").alias("bin"))
            .agg(F.count("*").alias("n")).collect())
    run, total = 0, sum(r["n"] for r in bins)
    for r in sorted(bins, key=lambda r: r["bin"]):
        run += r["n"]
        if run >= CALIBRATION * total:
            return min(max(FLOOR, r["bin"] / STEPS), CEILING)
    return FLOOR


def paragraphs_of(df: DataFrame, text: str, id_col: str) -> DataFrame:
    """uid, doc_id, at, words: one row per paragraph, or one with a null ``at`` if there is none."""
    cut = F.filter(F.split(F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")), _PARAGRAPH), lambda p: p != "")
    rows = df.select(F.monotonically_increasing_id().alias("uid"), F.col(f"`{id_col}`").alias("doc_id"), cut.alias("cut"))
    return rows.select("uid", "doc_id", F.posexplode_outer("cut").alias("at", "paragraph")).select(
        "uid", "doc_id", "at", tokens_of(F.coalesce("paragraph", F.lit(""))).alias("words"))


def score_paragraphs(paragraphs: DataFrame, model: LogisticRegressionModel, templates: Templates = TEMPLATES) -> DataFrame:
    """paragraphs without their words + label (predicted), probability (of it), known (of any
    family), confirmed (a template of the predicted family agrees), far (from every template)."""
    scored = model.transform(vectors(paragraphs))
    names = F.array(*[F.lit(f) for f in families_of(templates)])
    label = F.col("prediction").cast("int")
    chance = vector_to_array(F.col("probability"))
    confirmed = F.when(label > 0, agreement(F.col("pairs"), F.get(names, label), templates) >= AGREEMENT).otherwise(False)
    return scored.select(*[c for c in paragraphs.columns if c != "words"], label.alias("label"), F.get(chance, label).alias("probability"),
                         (1 - chance[0]).alias("known"), confirmed.alias("confirmed"), far_from_all(F.col("pairs"), templates).alias("far"))


def classify_paragraphs(paragraphs: DataFrame, model: LogisticRegressionModel, templates: Templates = TEMPLATES) -> DataFrame:
    """Scored paragraphs + family (UNKNOWN unless predicted, calibrated and confirmed)."""
    scored = stage(score_paragraphs(paragraphs, model, templates), "licence-scored")
    sure = F.col("confirmed") & (F.col("probability") >= calibrated(scored))
    names = F.array(*[F.lit(f) for f in families_of(templates)])
    return scored.withColumn("label", F.when(sure, F.col("label")).otherwise(0)).withColumn("family", F.get(names, F.col("label")))


def scan_licences(df: DataFrame, text: str = "text", id_col: str = "doc_id", templates: Templates = TEMPLATES) -> DataFrame:
    """Per row: doc_id, n_paragraphs, n_licence, families (sorted names, comma-joined; empty
    if none), first_at (number of the first licence paragraph, null if none).

    A paragraph's partial sums are combined in its task, so a document crosses the network
    as one short row.  Null and empty texts have no paragraphs; ids may be null or
    repeated (one result row per input row); an empty table gives no rows, and without
    corpus paragraphs the templates alone train the classifier; other columns are not read.
    """
    rows = paragraphs_of(df, text, id_col)
    # The rows of the fit are chosen by id, so a text that many rows repeat comes as often as it should.
    some = F.pmod(F.xxhash64(F.col(f"`{id_col}`")), F.lit(max(1, df.count() // SAMPLE_DOCS))) == 0
    found = classify_paragraphs(rows, fit(paragraphs_of(df.where(some), text, id_col), templates), templates)
    hit = F.col("label") > 0
    merged = found.groupBy("uid").agg(
        F.max("doc_id").alias("doc_id"), F.count("at").alias("n_paragraphs"), F.count_if(hit).alias("n_licence"),
        F.expr("bit_or(CASE WHEN label > 0 THEN shiftleft(1L, label) ELSE 0L END)").alias("bits"),
        F.min(F.when(hit, F.col("at"))).alias("first_at"))
    names = F.array_sort(F.filter(F.array(*[F.when(F.col("bits").bitwiseAND(1 << i) != 0, f) for i, f in enumerate(families_of(templates)) if i]),
                                  lambda f: f.isNotNull()))
    return merged.select("doc_id", "n_paragraphs", "n_licence", F.array_join(names, ",").alias("families"), "first_at")
