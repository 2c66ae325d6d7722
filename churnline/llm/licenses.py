"""Operator 5, license scans: diagonal voting of word k-grams against notice templates.

The hashes of all rolling word k-grams of a text are joined to the positions they have in
the templates. Position in the text less position in the template is the diagonal; k-grams
of one occurrence vote for one diagonal, or for neighbouring ones where words were added or
dropped. Neighbouring diagonals are merged, and a span is verified by how much of its
template it covers, how densely, and whether all k-grams that name the license are there.
Where spans of different labels overlap, only the one that covers most of its template stays
(then the one with more k-grams). A phrase stands where all its k-grams share a diagonal.
The score is cover times density, so changed and inserted words lower it; a phrase gives 1.

Null and empty texts have no words, places or labels and score 0. Repeated rows are scanned
alike; repeated notices in a text are places of their own. Texts are read whole, k-grams are
joined before anything is grouped, and groups are per text, so no notice is too common. Spans compete within blocks of
words of a text, which hold a bounded number of them however long the text. Other columns of
the input are not read. An empty table gives no rows.
"""

from __future__ import annotations

from itertools import product

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from churnline.llm.common import ascii_lower, table, words, written

SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
K = 2
#: Words of a template at most; longer notices are cut into several.
TEMPLATE_WORDS = 60
#: Diagonals this near are merged.
DRIFT = 3
MIN_COVER = 0.6
MIN_DENSITY = 0.5
#: Words of a block in which spans compete.
BLOCK = 128

# The phrases looked for exactly.
PHRASES = (
    ("cc-by", "cc by"),
    ("gpl", "general public license"),
    ("reserved", "all rights reserved"),
)
# Public notices in the words of the scan: (label, notice, the words in it that name the license).
_GNU = "this program is free software you can redistribute it and or modify it under the terms of the "
_SUN = "permission is hereby granted free of charge to any person "
NOTICES = (
    ("agpl", _GNU + "gnu affero general public license", "gnu affero general public license"),
    ("agpl", "this work is licensed under the gnu affero general public license version 3", "gnu affero general public license"),
    ("apache", "licensed under the apache license version 2 0", "apache license version 2 0"),
    ("apache", "you may not use this file except in compliance with the license you may obtain a copy of the license at", ""),
    ("apache-1.1", "licensed under the apache license version 1 1", "apache license version 1 1"),
    ("apache-1.1", "the apache software license version 1 1", "apache software license version 1 1"),
    ("artistic", "this is free software licensed under the artistic license 2 0", "artistic license 2 0"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met", ""),
    ("bsl", "distributed under the boost software license version 1 0", "boost software license version 1 0"),
    ("bsl", _SUN + "or organization obtaining a copy of the software and accompanying documentation covered by this license", "person or organization obtaining"),
    ("cc0", "to the extent possible under law the author has waived all copyright and related or neighboring rights to this work", "waived all copyright"),
    ("cc0", "released under cc0 1 0 universal", "cc0 1 0"),
    ("epl", "this program and the accompanying materials are made available under the terms of the eclipse public license", "eclipse public license"),
    ("gpl-notice", "this work is licensed under the gnu general public license version 3", "gnu general public license"),
    ("gpl-notice", _GNU + "gnu general public license", "gnu general public license"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted", ""),
    ("lgpl", _GNU.replace("program", "library") + "gnu lesser general public license", "gnu lesser general public license"),
    ("lgpl", _GNU + "gnu lesser general public license", "gnu lesser general public license"),
    ("lgpl", "this work is licensed under the gnu lesser general public license version 3", "gnu lesser general public license"),
    ("mit", "released under the mit license", "mit license"),
    ("mit", _SUN + "obtaining a copy of this software and associated documentation files", "person obtaining"),
    ("mpl", "this source code form is subject to the terms of the mozilla public license v 2 0", "mozilla public license v 2 0"),
    ("unlicense", "this is free and unencumbered software released into the public domain", "unencumbered software"),
    ("zlib", "this software is provided as is without any express or implied warranty in no event will the authors be held liable for any damages arising from the use of this software", ""),
)
# The parts of Creative Commons names, short and as written out.
CC_PARTS = {"by": ("attribution",), "nc": ("noncommercial", "non commercial"), "sa": ("sharealike", "share alike"), "nd": ("noderivatives", "no derivatives")}
CC_KINDS = ("by", "by sa", "by nd", "by nc", "by nc sa", "by nc nd")
CC_VERSIONS = ("3 0", "4 0")


def creative_commons() -> tuple[tuple[str, str, str], ...]:
    """Notices of every kind, version and spelling; the version ends the name, so BY is not found in BY-SA."""
    made = []
    for kind, version in product(CC_KINDS, CC_VERSIONS):
        label = "cc-" + kind.replace(" ", "-")
        made.append((label, f"licensed under cc {kind} {version}", f"cc {kind} {version}"))
        for parts in product(*[CC_PARTS[p] for p in kind.split()]):
            name = f"{' '.join(parts)} {version}"
            made.append((label, f"licensed under a creative commons {name} international license", f"commons {name}"))
    return tuple(made)


NOTICES += creative_commons()


def templates(spark: SparkSession, phrases=PHRASES, notices=NOTICES, k: int = K) -> DataFrame:
    """(template, label, exact, grams, named, at, h, bit): a row per k-gram of each template.

    Bits of ``named`` are the k-grams within the words that name the license.
    """
    rows = [(label, text, "", True) for label, text in phrases] + [(label, text, name, False) for label, text, name in notices]
    cut = []
    for label, text, name, exact in rows:
        parts, own = text.split(), name.split()
        if len(parts) < k or 0 < len(own) < k:
            raise ValueError(f"{text!r} or its name {name!r} has fewer than {k} words")
        start = next((i for i in range(len(parts)) if parts[i : i + len(own)] == own), None)
        if start is None:
            raise ValueError(f"{name!r} does not stand in {text!r}")
        wanted = range(start, start + len(own) - k + 1)
        step = TEMPLATE_WORDS - k + 1
        for i in range(0, max(1, len(parts) - k + 1), step):
            named = sum(1 << (at - i) for at in wanted if i <= at < i + step)
            cut.append((len(cut), label, exact, named, parts[i : i + TEMPLATE_WORDS]))
    given = spark.createDataFrame(cut, "template int, label string, exact boolean, named long, words array<string>")
    grams = F.size("words") - (k - 1)
    rolled = given.select("template", "label", "exact", "named", grams.alias("grams"), F.posexplode(_gram_hashes(F.col("words"), k)).alias("at", "h"))
    return rolled.where("h is not null").withColumn("bit", F.expr("shiftleft(1L, at)"))


def _gram_hashes(w, k: int):
    """A hash per word: of the k-gram that starts there, null where the text ends before."""
    hashes = F.transform(w, lambda x: F.xxhash64(x))
    whole = lambda i: F.when(i <= F.size(w) - k, F.lit(True))
    return F.transform(F.array(hashes), lambda a: F.transform(a, lambda x, i: F.when(whole(i), F.xxhash64(x, *[F.get(a, i + j) for j in range(1, k)]))))[0]


def votes(docs: DataFrame, given: DataFrame, k: int = K) -> DataFrame:
    """Votes per text, template and diagonal; one row without a template holds the rest of a text."""
    w = words(ascii_lower(F.col("text")), SEPARATORS)
    hashes = F.transform(F.array(w), lambda a: _gram_hashes(a, k))[0]
    numbered = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", "text")
    grams = numbered.select("row", "doc_id", F.posexplode_outer(hashes).alias("pos", "h"))
    # The templates are given with the code: some hundreds of rows.
    hits = grams.join(F.broadcast(given.select("template", "grams", "exact", "named", "at", "h", "bit")), "h", "left")
    by = ["row", "doc_id", "template", "grams", "exact", "named", (F.col("pos") - F.col("at")).alias("diagonal")]
    return hits.groupBy(*by).agg(
        F.count("*").alias("votes"),
        F.min("pos").alias("first"),
        F.max("pos").alias("last"),
        F.bit_or("bit").alias("seen"),
    )


def spans(voted: DataFrame, k: int = K) -> DataFrame:
    """Verified spans: row, template, exact, first and end word, n k-grams, cover, density."""
    order = Window.partitionBy("row", "template").orderBy("diagonal")
    apart = F.coalesce((F.col("diagonal") - F.lag("diagonal").over(order) > DRIFT).cast("int"), F.lit(0))
    run = voted.where("template is not null").withColumn("apart", apart).withColumn("run", F.sum("apart").over(order))
    merged = run.groupBy("row", "template", "grams", "exact", "named", "run").agg(
        F.bit_or("seen").alias("seen"), F.min("first").alias("first"), (F.max("last") + k).alias("end")
    )
    n = F.bit_count("seen")
    cover = n / F.col("grams")
    dense = n / (F.col("end") - F.col("first") - (k - 1))
    found = merged.where(F.col("seen").bitwiseAND(F.col("named")) == F.col("named"))
    measured = found.select("row", "template", "exact", "first", "end", n.alias("n"), cover.alias("cover"), dense.alias("density"))
    return measured.where((F.col("cover") >= MIN_COVER) & (F.col("density") >= MIN_DENSITY))


def best_spans(found: DataFrame) -> DataFrame:
    """Spans (with ``label``) that no better one of another label overlaps.

    Dense spans are short, so a block of words of a text holds at most some of each template.
    """
    # A span has at most TEMPLATE_WORDS / MIN_DENSITY words and touches two blocks.
    blocks = F.sequence(F.floor(F.col("first") / BLOCK), F.floor((F.col("end") - 1) / BLOCK))
    placed = found.select("row", F.explode(blocks).alias("block"), F.struct("first", "end", "label", "template", "cover", "n").alias("s"))
    mine, other = placed.withColumnRenamed("s", "a"), placed.withColumnRenamed("s", "b")
    overlap = (F.col("a.first") < F.col("b.end")) & (F.col("b.first") < F.col("a.end")) & (F.col("a.label") != F.col("b.label"))
    rank = lambda s: F.struct(F.col(f"{s}.cover"), F.col(f"{s}.n"), -F.col(f"{s}.template"))
    beaten = mine.join(other, ["row", "block"]).where(overlap & (rank("a") < rank("b")))
    return found.join(beaten.select("row", "a.template", "a.first").distinct(), ["row", "template", "first"], "left_anti")


def scan(docs: DataFrame, phrases=PHRASES, notices=NOTICES, k: int = K) -> DataFrame:
    """One row per document: words, phrase places, labels and score."""
    spark = docs.sparkSession
    given = templates(spark, phrases, notices, k)
    names = given.select("template", "label").distinct()
    # Both uses below must see the same row numbers, so the votes are written once.
    voted = written(votes(docs, given, k), "votes")
    labelled = voted.join(F.broadcast(names), "template", "left")
    place = F.col("exact") & (F.col("votes") == F.col("grams"))
    found = written(spans(voted, k).where("not exact").join(F.broadcast(names), "template"), "spans")
    sure = F.max(F.col("cover") * F.least(F.col("density"), F.lit(1.0)))
    method = best_spans(found).groupBy("row").agg(F.collect_set("label").alias("more"), sure.alias("sure"))
    text = labelled.groupBy("row", "doc_id").agg(
        F.coalesce(F.max("last") + 1, F.lit(0)).cast("long").alias("n_words"),
        F.count(F.when(place, 1)).alias("n_base"),
        F.min(F.when(place, F.col("diagonal"))).cast("long").alias("first_word"),
        F.max(F.when(place, F.col("diagonal"))).cast("long").alias("last_word"),
        F.collect_set(F.when(place, F.col("label"))).alias("base"),
    )
    joined = text.join(method, "row", "left")
    every = F.array_sort(F.array_union("base", F.coalesce("more", F.array().cast("array<string>"))))
    score = F.when(F.col("n_base") > 0, 1.0).otherwise(F.coalesce("sure", F.lit(0.0)))
    return joined.select(
        "doc_id", "n_words", "n_base", "first_word", "last_word",
        F.array_join(F.array_sort("base"), ",").alias("base_labels"), F.array_join(every, ",").alias("labels"), score.cast("double").alias("score"),
    )


def op5_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(table(spark, sf_dir, "documents"))
