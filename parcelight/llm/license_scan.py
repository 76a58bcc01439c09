"""License scans by diagonal voting.

A template is a sequence of words: a phrase, to be found word for word, or the text of
a notice, of which parts may differ. Every run of two words of a document is hashed, and
of four words by rolling two such hashes on; hashes that no template has leave at
once, the others join the positions of the templates on the hash and on the words
themselves, so that a collision finds nothing. A match of document position ``i`` with
template position ``j`` votes for the diagonal ``i - j``. Words put in or left out shift
a notice to a diagonal nearby: diagonals of a document and a notice that lie at most
:data:`GAP` words apart are one candidate. Its span is verified: the share of the
template's runs that it holds, each counted once, must reach :data:`SHARE`, within at
most :data:`STRETCH` times the template's words. A phrase has no neighbours: a diagonal
counts if it holds all of its runs.

Everything is DataFrame functions. A row per document travels with its matches (a
"match" that every document has), so nothing is read twice or joined back; the tables
of templates are fixed and small (:func:`templates`), which bounds what is broadcast. A
document's matches combine per diagonal before they are shuffled.

Defined cases: a null text is empty. Words are taken from the whole text, of any length.
Repeated rows, and rows with a null id, are rows of their own. Without rows the result
has none. Other columns of the input are neither read nor returned. Notices of equal
share are all labelled; a place counts for each phrase that stands there.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"

# Words of a run, of phrases and of notices.
PHRASE_RUN, NOTICE_RUN = 2, 4
GAP = 8
SHARE = 0.6
STRETCH = 2

# Phrases that count as base places, then further ones.
BASE_PHRASES = [
    ("gnu general public license", "gpl"),
    ("apache license", "apache"),
    ("cc by", "cc-by"),
    ("mit license", "mit"),
]
PHRASES = [
    ("gnu lesser general public license", "lgpl"),
    ("gnu affero general public license", "agpl"),
    ("mozilla public license", "mpl"),
    ("eclipse public license", "epl"),
    ("boost software license", "bsl"),
    ("bsd license", "bsd"),
    ("isc license", "isc"),
    ("cc by nc", "cc-by-nc"),
    ("cc by nd", "cc-by-nd"),
    ("cc by sa", "cc-by-sa"),
    ("creative commons attribution", "cc-by"),
]
# Wording of public license notices.
NOTICES = [
    (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of "
        "this software and associated documentation files, to deal in the Software without "
        "restriction, including without limitation the rights to use, copy, modify, merge, "
        "publish, distribute, sublicense, and/or sell copies of the Software, and to permit "
        "persons to whom the Software is furnished to do so, subject to the following "
        "conditions: The above copyright notice and this permission notice shall be included "
        "in all copies or substantial portions of the Software.",
        "mit",
    ),
    (
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use "
        "this file except in compliance with the License. You may obtain a copy of the "
        "License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable "
        "law or agreed to in writing, software distributed under the License is distributed "
        "on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express "
        "or implied.",
        "apache",
    ),
    (
        "This program is free software: you can redistribute it and/or modify it under the "
        "terms of the GNU General Public License as published by the Free Software "
        "Foundation, either version 3 of the License, or (at your option) any later version. "
        "This program is distributed in the hope that it will be useful, but WITHOUT ANY "
        "WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A "
        "PARTICULAR PURPOSE.",
        "gpl",
    ),
    (
        "Redistribution and use in source and binary forms, with or without modification, "
        "are permitted provided that the following conditions are met: Redistributions of "
        "source code must retain the above copyright notice, this list of conditions and the "
        "following disclaimer. Redistributions in binary form must reproduce the above "
        "copyright notice, this list of conditions and the following disclaimer in the "
        "documentation and/or other materials provided with the distribution.",
        "bsd",
    ),
    (
        "This Source Code Form is subject to the terms of the Mozilla Public License, "
        "v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one "
        "at http://mozilla.org/MPL/2.0/.",
        "mpl",
    ),
    (
        "Permission to use, copy, modify, and/or distribute this software for any purpose "
        "with or without fee is hereby granted, provided that the above copyright notice and "
        "this permission notice appear in all copies.",
        "isc",
    ),
    (
        "This is free and unencumbered software released into the public domain. Anyone is "
        "free to copy, modify, publish, use, compile, sell, or distribute this software, "
        "either in source code form or as a compiled binary, for any purpose, commercial or "
        "non-commercial, and by any means.",
        "unlicense",
    ),
    (
        "This work is licensed under a Creative Commons Attribution 4.0 International "
        "License.",
        "cc-by",
    ),
    (
        "To the extent possible under law, the author has waived all copyright and related "
        "or neighboring rights to this work.",
        "cc0",
    ),
]


def words_of(text: Column) -> Column:
    """The words of a text, A-Z in lower case. Lower-casing all of a text tells the same
    words of ASCII letters apart and is faster, but for the two characters that would
    become such letters; other letters only have to stay letters here."""
    whole = F.coalesce(text, F.lit(""))
    special = F.contains(whole, F.lit("\u212a")) | F.contains(whole, F.lit("\u0130"))
    lowered = F.when(special, F.translate(whole, UPPER, LOWER)).otherwise(F.lower(whole))
    return F.array_remove(F.split(lowered, SEPARATORS), "")


def _pair_hash(words: Column, i: Column) -> Column:
    return F.xxhash64(F.get(words, i), F.get(words, i + 1))


def _places(n: Column, run: int) -> Column:
    """0 .. n - run; none if the text has fewer words than the run."""
    return F.when(n >= run, F.sequence(F.lit(0), n - run)).otherwise(F.array().cast("array<int>"))


def template_rows() -> list[tuple[int, str, str, bool, bool, int]]:
    """(number, words, label, whether a phrase, whether a base one, words of a run)."""
    named = [(t, label, True, True, PHRASE_RUN) for t, label in BASE_PHRASES]
    named += [(t, label, True, False, PHRASE_RUN) for t, label in PHRASES]
    named += [(t, label, False, False, NOTICE_RUN) for t, label in NOTICES]
    return [(i, *row) for i, row in enumerate(named)]


def templates(spark: SparkSession) -> DataFrame:
    """A row per position of a template: ``hash`` and ``gram`` of the run that starts
    there, ``position``, and how many ``runs`` the template has. A few hundred rows."""
    named = spark.createDataFrame(
        template_rows(),
        "template int, text string, label string, phrase boolean, base boolean, run int",
    )
    worded = named.withColumn("_words", words_of(F.col("text")))
    n = F.size("_words")
    pairs = F.transform(_places(n, 2), lambda i: _pair_hash(F.col("_words"), i))
    return (
        worded.withColumn("_pairs", pairs)
        .withColumn("runs", n - F.col("run") + 1)
        .withColumn("position", F.explode(F.sequence(F.lit(0), F.col("runs") - 1)))
        .select(
            "template", "label", "phrase", "base", "run", "runs", "position",
            F.when(F.col("run") == PHRASE_RUN, F.get("_pairs", F.col("position")))
            .otherwise(_rolled(F.col("_pairs"), F.col("position"))).alias("hash"),
            F.array_join(
                F.slice("_words", F.col("position") + 1, F.col("run")), " "
            ).alias("gram"),
        )
    )


def _rolled(pairs: Column, i: Column) -> Column:
    """Hash of the run of four words that starts at ``i``."""
    return F.xxhash64(F.get(pairs, i), F.get(pairs, i + 2))


def _votes(docs: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """Matches of documents with templates, and one row without template of each
    document: (_row, _id, _n_words, _i, and the template's columns)."""
    known = templates(docs.sparkSession)
    worded = docs.select(
        F.monotonically_increasing_id().alias("_row"),
        F.col(id_column).alias("_id"),
        words_of(F.col(text_column)).alias("_words"),
    ).withColumn("_n_words", F.size("_words"))
    n = F.col("_n_words")
    pairs = F.transform(_places(n, 2), lambda i: _pair_hash(F.col("_words"), i))
    hashed = worded.withColumn("_pairs", pairs).withColumn(
        "_fours", F.transform(_places(n, 4), lambda i: _rolled(F.col("_pairs"), i))
    )
    # Place 0: the document itself; then its runs of two words, then those of four.
    rows = hashed.select(
        "_row", "_id", "_n_words", "_words",
        F.posexplode(F.concat(F.array(F.lit(0).cast("long")), "_pairs", "_fours")).alias("_at", "hash"),
    )
    pair = F.col("_at") < n
    rows = rows.select(
        "_row", "_id", "_n_words", "_words", "hash",
        F.when(F.col("_at") == 0, 0).when(pair, PHRASE_RUN).otherwise(NOTICE_RUN).alias("_run"),
        F.when(pair, F.col("_at") - 1).otherwise(F.col("_at") - F.greatest(n, F.lit(1))).alias("i"),
    )
    itself = known.sparkSession.createDataFrame(
        [(None, None, None, None, 0, None, None, 0, "")],
        "template int, label string, phrase boolean, base boolean, run int, runs int, "
        "position int, hash bigint, gram string",
    )
    # Fixed size: the positions of the templates above.
    known = F.broadcast(known.unionByName(itself).withColumnRenamed("hash", "_hash"))
    gram = F.array_join(F.slice("_words", F.col("i") + 1, F.col("run")), " ")
    # Not a second join key: only looked at where the hashes agree.
    same = F.coalesce((F.col("run") == 0) | (gram == F.col("gram")), F.lit(False))
    return rows.join(
        known, (F.col("hash") == F.col("_hash")) & (F.col("_run") == F.col("run")) & same
    ).drop("_words", "_hash", "_run", "hash", "gram")


def candidates(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Merged diagonals: (_row, _id, _n_words, template, label, phrase, base, first_word,
    last_word, share, found), and for each document one row without template."""
    document = ["_row", "_id", "_n_words"]
    about = ["template", "label", "phrase", "base", "run", "runs"]
    diagonals = (
        _votes(docs, id_column, text_column)
        .withColumn("_diagonal", F.col("i") - F.col("position"))
        .groupBy(*document, *about, "_diagonal")
        .agg(
            F.collect_set("position").alias("_held"),  # at most the template's positions
            F.min("i").alias("_first"),
            F.max("i").alias("_last"),
        )
    )
    along = Window.partitionBy("_row", "template").orderBy("_diagonal")
    apart = F.coalesce(F.col("_diagonal") - F.lag("_diagonal").over(along) > GAP, F.lit(True))
    merged = (
        diagonals.withColumn("_starts", (apart | F.col("phrase")).cast("int"))
        .withColumn("_span", F.sum("_starts").over(along))
        .groupBy(*document, *about, "_span")
        .agg(
            F.size(F.array_distinct(F.flatten(F.collect_list("_held")))).alias("_votes"),
            F.min("_first").alias("first_word"),
            (F.max("_last") + F.col("run") - 1).alias("last_word"),
        )
    )
    length = F.col("last_word") - F.col("first_word") + 1
    close = length <= STRETCH * (F.col("runs") + F.col("run") - 1)
    share = F.col("_votes") / F.col("runs")
    return merged.select(
        *document, *about[:4], "first_word", "last_word", share.alias("share"),
        F.when(F.col("phrase"), F.col("_votes") == F.col("runs"))
        .otherwise((share >= SHARE) & close).alias("found"),
    )


def spans(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The places of licenses in documents: id, ``label``, ``first_word`` and
    ``last_word`` (from 0), ``share`` of the template that stands there, and whether a
    phrase or a ``base`` phrase it is."""
    return candidates(docs, id_column, text_column).where("found").select(
        F.col("_id").alias(id_column), "label", "first_word", "last_word", "share", "phrase", "base"
    )


def scan(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per document: its words, the places of base phrases, the labels of these
    and of all templates found, and ``score``: the largest share of a notice that it
    holds, 1 if it holds a phrase."""
    found = F.coalesce(F.col("found"), F.lit(False))
    base = found & F.col("base")
    score = F.max(F.when(found | ~F.col("phrase"), F.col("share")))

    def joined(which: Column) -> Column:
        return F.array_join(F.array_sort(F.collect_set(F.when(which, F.col("label")))), ",")

    return candidates(docs, id_column, text_column).groupBy("_row").agg(
        F.first("_id").alias(id_column),
        F.max("_n_words").cast("long").alias("n_words"),
        F.count_if(base).alias("n_base"),
        F.min(F.when(base, F.col("first_word"))).cast("long").alias("first_word"),
        F.max(F.when(base, F.col("first_word"))).cast("long").alias("last_word"),
        joined(base).alias("base_labels"),
        joined(found).alias("labels"),
        F.coalesce(score, F.lit(0.0)).alias("score"),
    ).drop("_row")
