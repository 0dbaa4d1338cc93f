"""License scan with DataFrame functions only: MinHash bands over overlapping windows, then exact containment.

*Windows.*  Words are lower-cased runs of letters and digits.  For each
length of a template (longer ones are cut into pieces of ``PIECE`` words at every
place) a text's windows are all runs of as many words, so a copied template
is itself a window.  Shingles have five words (shorter templates: all their words).

*Bands.*  ``BANDS`` bands of one MinHash each: the least shingle hash after
an exclusive-or with the band's seed.  A window with Jaccard similarity s
shares a band with probability 1 - (1 - s) ** BANDS: at 0.8 over 0.9999.  A band can
only be shared by a window that holds the template's own least
shingle, so windows are opened around those shingles and nowhere else.

*Check.*  A retrieved template must be contained: at least 0.8 of its
shingles lie in the run of the text that it would cover, widened by a tenth.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SHINGLE = 5
PIECE = 16
BANDS = 6
CONTAINED = 0.8
# The seeds' leading bits differ, so that bands look at different shingles.
SEEDS = [0x1B873593CC9E2D51, 0x3C6EF372FE94F82B, 0x510E527FADE682D1, 0x6A09E667F3BCC908, -0x64A51195E0E3610D, -0x25C7DD18E1B5A2F3]

# License notices.
TEMPLATES = {
    "apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "apache-2.0-notice": "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
    "gpl-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "gpl-notice": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation",
    "mit": "Released under the MIT License.",
    "mit-notice": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction",
    "bsd-notice": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
    "cc-by-nc-4.0": "Licensed under CC BY-NC 4.0.",
    "all-rights-reserved": "All rights reserved.",
}


def words_of(text: Column) -> Column:
    """Words of a text column (null: none)."""
    return F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(r"([\p{L}\p{N}]+)"), F.lit(1))


def _shingles(words: Column, width: int) -> Column:
    """Hashes of all runs of ``width`` words."""
    at = F.when(F.size(words) >= width, F.sequence(F.lit(0), F.size(words) - width)).otherwise(F.array().cast("array<int>"))
    return F.transform(at, lambda i: F.xxhash64(*[F.get(words, i + k) for k in range(width)]))


def _pieces(templates: dict[str, str]) -> list[tuple[str, int, int, int, list[str]]]:
    """(license, words in all, width of a shingle, place of the piece, its words) of each template's pieces."""
    out = []
    for name, text in templates.items():
        words = re.findall(r"[^\W_]+", text.lower())
        width = min(SHINGLE, len(words))
        if words:
            size = min(PIECE, len(words))
            out += [(name, len(words), width, i, words[i : i + size]) for i in range(len(words) - size + 1)]
    return out


def _least(hashes: Column) -> list[Column]:
    """One MinHash for each band."""

    def least(seed: int) -> Column:
        return F.array_min(F.transform(hashes, lambda x: x.bitwiseXOR(F.lit(seed))))

    return [least(seed) for seed in SEEDS[:BANDS]]


def found(docs: DataFrame, templates: dict[str, str] | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each document and license in it: doc_id, license, containment, first_word, places.

    ``containment`` is the best of its places, ``first_word`` the first of
    them (a word number, from 0), ``places`` how many windows fit.  Null,
    empty and wordless texts have no rows; repeated rows with one id count
    as one document; null ids are kept as one; other columns are not read.  Templates are
    a short list (a few thousand words), so their bands are broadcast.
    """
    spark: SparkSession = docs.sparkSession
    pieces = _pieces(TEMPLATES if templates is None else templates)
    if not pieces:
        return docs.select(F.col(id_col).alias("doc_id"), *[F.lit(None).cast(t).alias(c) for c, t in (("license", "string"), ("containment", "double"), ("first_word", "int"), ("places", "bigint"))]).limit(0)
    shapes = sorted({(width, len(words)) for _, _, width, _, words in pieces})
    table = spark.createDataFrame(pieces, "license string, n int, width int, off int, words array<string>")
    by_width = F.lit(None).cast("array<bigint>")
    for width in sorted({w for w, _ in shapes}):
        by_width = F.when(F.col("width") == width, _shingles(F.col("words"), width)).otherwise(by_width)
    table = table.withColumn("h", by_width)
    bands = table.select("license", "n", "width", "off", F.size("words").alias("size"), F.posexplode(F.array(*_least(F.col("h")))).alias("band", "least"))
    whole = table.groupBy("license").agg(F.array_distinct(F.flatten(F.collect_list("h"))).alias("own"))  # a template's few pieces
    bands = bands.join(whole, "license")
    # the shingles that can be least: undo the exclusive-or (bands of the short list of templates)
    rows = bands.select("width", "band", "least").distinct().collect()
    least: dict[int, list[int]] = {w: sorted({r["least"] ^ SEEDS[r["band"]] for r in rows if r["width"] == w}) for w, _ in shapes}
    longest = max(n for _, n, *_ in pieces)
    reach = longest + longest // 10 + PIECE

    # one pass over the texts: each shingle that can be least, with the part of the text around it
    hashed = docs.select(F.col(id_col).alias("doc_id"), words_of(F.col(text_col)).alias("w"))
    hashed = hashed.select("doc_id", *[_shingles(F.col("w"), width).alias(f"h{width}") for width in least])

    def near(width: int) -> Column:
        h = F.col(f"h{width}")
        at = F.filter(F.transform(h, lambda x, i: F.when(x.isin(least[width]), i)), lambda i: i.isNotNull())

        def around(i: Column) -> Column:
            lo = F.greatest(F.lit(0), i - reach)
            return F.struct(F.lit(width).alias("width"), i.alias("at"), lo.alias("lo"), F.slice(h, lo + 1, F.lit(2 * reach + 1)).alias("part"))

        return F.transform(at, around)

    # the outer form, as a filter before the explode would be pushed to the scan and compute the hashes anew for every word
    at = hashed.select("doc_id", F.concat(*[near(width) for width in least]).alias("c"))
    at = at.select("doc_id", F.explode_outer("c").alias("c")).where("c is not null").select("doc_id", "c.*")

    # the windows of each length that hold it
    def starts(width: int, size: int) -> Column:
        first = F.sequence(F.greatest(F.lit(0), F.col("at") - (size - width)), F.col("at"))
        return F.transform(first, lambda i: F.struct(F.lit(size).alias("size"), i.alias("start")))

    windows = F.lit(None)
    for width in least:
        windows = F.when(F.col("width") == width, F.concat(*[starts(w, size) for w, size in shapes if w == width])).otherwise(windows)
    one = at.select("*", F.explode(windows).alias("s")).select("doc_id", "width", "lo", "part", "s.*")
    inside = F.slice("part", F.col("start") - F.col("lo") + 1, F.col("size") - F.col("width") + 1)
    one = one.where(F.size(inside) == F.col("size") - F.col("width") + 1)
    one = one.select("doc_id", "width", "size", "lo", "part", "start", F.posexplode(F.array(*_least(inside))).alias("band", "least"))
    got = one.join(F.broadcast(bands), ["width", "size", "band", "least"])
    slack = F.floor(F.col("n") / 10)
    begin = F.greatest(F.lit(0), F.col("start") - F.col("off") - slack - F.col("lo"))
    cover = F.slice("part", (begin + 1).cast("int"), (F.col("n") - F.col("width") + 1 + 2 * slack).cast("int"))
    share = F.size(F.array_intersect("own", cover)) / F.size("own")
    hits = got.select("doc_id", "license", (F.col("start") - F.col("off")).alias("first"), share.alias("containment"))
    hits = hits.where(F.col("containment") >= CONTAINED)
    per_place = hits.groupBy("doc_id", "license", "first").agg(F.max("containment").alias("containment"))
    return per_place.groupBy("doc_id", "license").agg(
        F.max("containment").alias("containment"), F.greatest(F.lit(0), F.min("first")).alias("first_word"), F.count(F.lit(1)).alias("places")
    )
