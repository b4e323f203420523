"""License scan: exact set-similarity join between notice templates and text blocks.

A block, for a template, is a stretch of at most STRETCH times as many words as the
template has, wherever its lines end, so a notice may be wrapped at any word and
words far apart make no match.  It matches when at least THRESHOLD of the
template's distinct words stand in it.

1. Every text is split once, to the distinct template words it holds.
2. Template words are ordered by the number of texts that hold them, rarest first.
   A text can only hold a matching block if it holds one of the first
   |T| - need + 1 template words (prefix filter), `need` template words in all
   (length filter), and enough of them after the first shared one on both sides
   (positional filter).
3. The texts that stay give the places of their template words.  Around each
   place the distinct words of its stretch are counted, which verifies a pair
   exactly; no match is lost.  Blocks are counted from the left, none over another.

Defined results: a NULL or empty text has no words and no labels; rows with a
NULL or repeated doc_id are judged by their own text; an empty table gives no
rows; other columns of the input are ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from occrisk.llm.common import stored, table

THRESHOLD = 0.85
STRETCH = 1.5

# Phrases and labels of the contract.
PHRASES = (
    ("cc-by", "cc by"),
    ("gpl", "general public license"),
    ("reserved", "all rights reserved"),
)

# Wording of common notices.  The list is the operator's
# parameter; everything broadcast or collected below is bounded by its words.
TEMPLATES = (
    ("apache-2.0", "licensed under the apache license version 2 0"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted"),
    ("cc-by-nc-4.0", "licensed under cc by nc 4 0"),
    ("cc-by-sa-4.0", "licensed under a creative commons attribution sharealike 4 0 international license"),
    ("gpl-3.0", "this work is licensed under the gnu general public license version 3"),
    ("lgpl", "under the terms of the gnu lesser general public license"),
    ("mit", "released under the mit license"),
    ("mpl-2.0", "subject to the terms of the mozilla public license"),
    ("public-domain", "dedicated to the public domain"),
    ("reserved", "all rights reserved"),
)

_GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
# On text whose capitals are kept, capitals belong to words.
_WORD_ANY_CASE = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def lowered(text: Column) -> Column:
    """A-Z to a-z.  The Kelvin sign is the only other character that lower() turns into
    a lone ASCII letter, so it is replaced by another letter outside ASCII first."""
    return F.lower(F.replace(F.coalesce(text, F.lit("")), F.lit("K"), F.lit("ĸ")))


def word_list(low: Column) -> Column:
    return F.filter(F.split(low, _GAP, -1), lambda w: w != "")


def _phrase_places(words: Column, phrase: str) -> Column:
    parts = phrase.split()
    return F.filter(
        F.transform(
            words,
            lambda w, i: F.when(
                (w == parts[0]) & F.forall(F.array(*[F.get(words, i + k) == p for k, p in enumerate(parts)]), lambda x: F.coalesce(x, F.lit(False))), i
            ),
        ),
        lambda i: i.isNotNull(),
    )


def base(docs: DataFrame, text: str = "text") -> DataFrame:
    """`docs` packed into `_row`, with word count, phrase places and base labels; a projection only."""
    start, end = r"(?:^|" + _GAP + ")", r"(?:$|[\x00-\x2F\x3A-\x60\x7B-\x7F])"
    any_phrase = start + "(?:" + "|".join(_GAP.join(p.split()) for _, p in PHRASES) + ")" + end
    rows = docs.select(F.struct("*").alias("_row"), lowered(F.col(text)).alias("_low"), F.coalesce(F.col(text), F.lit("")).alias("_t"))
    rows = rows.select("*", F.when(F.col("_low").rlike(any_phrase), word_list(F.col("_low"))).otherwise(F.array().cast("array<string>")).alias("_w"))
    places = {label: _phrase_places(F.col("_w"), phrase) for label, phrase in PHRASES}
    rows = rows.select("_row", "_t", *[p.alias(f"_p{n}") for n, p in enumerate(places.values())])
    every = F.concat(*[F.col(f"_p{n}") for n in range(len(places))])
    labels = [F.when(F.size(f"_p{n}") > 0, F.lit(label)) for n, label in enumerate(places)]
    return rows.select(
        "_row",
        F.md5(F.encode("_t", "UTF-8")).alias("_md5"),
        F.size(F.regexp_extract_all("_t", F.lit(_WORD_ANY_CASE), F.lit(0))).cast("long").alias("n_words"),
        F.size(every).cast("long").alias("n_base"),
        F.array_min(every).cast("long").alias("first_word"),
        F.array_max(every).cast("long").alias("last_word"),
        F.array_sort(F.array_distinct(F.filter(F.array(*labels), lambda x: x.isNotNull()))).alias("_base_labels"),
    )


def _vocabulary(templates) -> list[str]:
    return sorted({w for _, words in templates for w in words.split()})


def template_words(docs: DataFrame, templates=TEMPLATES, text: str = "text") -> DataFrame:
    """(_md5, hits): the distinct template words of every text that has any."""
    vocabulary = F.array(*map(F.lit, _vocabulary(templates)))
    rows = docs.select(_key(text), F.array_intersect(F.split(lowered(F.col(text)), _GAP, -1), vocabulary).alias("hits"))
    return rows.where(F.size("hits") > 0)


def _key(text: str) -> Column:
    return F.md5(F.encode(F.coalesce(F.col(text), F.lit("")), "UTF-8")).alias("_md5")


def word_frequency(found: DataFrame) -> dict[str, int]:
    """Texts that hold each template word; as many rows as the template list has words."""
    return {r["w"]: r["n"] for r in found.select(F.explode("hits").alias("w")).groupBy("w").agg(F.count("*").alias("n")).collect()}


def stretch_of(words: str) -> int:
    return math.ceil(STRETCH * len(words.split()))


def prefix_index(spark: SparkSession, templates, frequency: dict[str, int], threshold: float) -> tuple[DataFrame, dict[str, int]]:
    """One row per template and prefix word, and the global order of the words."""
    order = {w: n for n, w in enumerate(sorted(_vocabulary(templates), key=lambda w: (frequency.get(w, 0), w)))}
    entries = []
    for label, words in templates:
        tokens = sorted(set(words.split()), key=order.get)
        need = math.ceil(threshold * len(tokens) - 1e-9)
        for place, word in enumerate(tokens[: len(tokens) - need + 1]):
            entries.append((word, place, label, tokens, len(tokens), need, stretch_of(words)))
    schema = "word string, t_place int, label string, tokens array<string>, t_size int, need int, stretch int"
    return spark.createDataFrame(entries, schema), order


def candidates(found: DataFrame, templates, index: DataFrame, order: dict[str, int], threshold: float) -> DataFrame:
    """(_md5, label) that prefix, length and positional filter leave."""
    ranked = F.create_map(*[F.lit(x) for pair in order.items() for x in pair])
    by_rank = F.transform(F.array_sort(F.transform("hits", lambda w: F.struct(ranked[w].alias("r"), w.alias("w")))), lambda x: x["w"])
    shortest = min(math.ceil(threshold * len(set(words.split())) - 1e-9) for _, words in templates)
    sides = found.where(F.size("hits") >= shortest).select("_md5", by_rank.alias("hits"))
    sides = sides.select("*", F.posexplode("hits").alias("b_place", "word"))
    pairs = sides.join(index, "word").where(
        (F.size("hits") >= F.col("need"))
        & (1 + F.least(F.col("t_size") - F.col("t_place") - 1, F.size("hits") - F.col("b_place") - 1) >= F.col("need"))
        & ~F.arrays_overlap(F.slice("tokens", F.lit(1), F.col("t_place")), F.col("hits"))
    )
    common = F.size(F.array_intersect("tokens", "hits"))
    return pairs.where(common >= F.col("need")).select("_md5", "label").distinct()


def verified(places: DataFrame) -> DataFrame:
    """Exact check of (_md5, label, tokens, t_size, need, stretch, places): containment and blocks of those that match.

    `places` are the places of all templates' words in the text, ascending.
    """
    own = F.filter("places", lambda p: F.array_contains("tokens", p["w"]))
    rows = places.withColumn("own", own)

    def held(p: Column, k: Column) -> Column:
        near = F.filter(F.slice("own", k + 1, F.col("stretch")), lambda q: q["i"] < p["i"] + F.col("stretch"))
        return F.struct(p["i"].alias("i"), F.size(F.array_distinct(F.transform(near, lambda q: q["w"]))).alias("n"))

    hits = F.filter(F.transform("own", held), lambda h: h["n"] >= F.col("need"))
    rows = rows.select("_md5", "label", "t_size", "stretch", hits.alias("hits")).where(F.size("hits") > 0)
    none = F.struct(F.lit(0).alias("n"), F.lit(0).alias("next"))
    apart = F.aggregate(
        "hits", none, lambda a, h: F.when(h["i"] >= a["next"], F.struct((a["n"] + 1).alias("n"), (h["i"] + F.col("stretch")).alias("next"))).otherwise(a), lambda a: a["n"]
    )
    best = F.array_max(F.transform("hits", lambda h: h["n"])) / F.col("t_size")
    return rows.select("_md5", "label", best.alias("containment"), apart.alias("blocks"))


def matches(docs: DataFrame, templates=TEMPLATES, threshold: float = THRESHOLD, text: str = "text") -> DataFrame:
    """(_md5, label, containment, blocks) of every text and template with a block at or above the threshold."""
    found = stored(template_words(docs, templates, text), "template-words")
    index, order = prefix_index(docs.sparkSession, templates, word_frequency(found), threshold)
    wanted = candidates(found, templates, index, order, threshold)
    labels = wanted.groupBy("_md5").agg(F.collect_list("label").alias("labels"))  # as many as there are templates
    vocabulary = _vocabulary(templates)
    rows = docs.select(_key(text), lowered(F.col(text)).alias("_low")).join(labels, "_md5")
    words = F.transform(word_list(F.col("_low")), lambda w, i: F.struct(i.alias("i"), w.alias("w")))
    rows = rows.select("_md5", "labels", F.filter(words, lambda x: x["w"].isin(*vocabulary)).alias("places"))
    kinds = index.select("label", "tokens", "t_size", "need", "stretch").distinct()
    pairs = rows.select("_md5", F.explode("labels").alias("label"), "places").join(kinds, "label")
    return verified(pairs).distinct()  # equal texts match alike


def scan(docs: DataFrame, templates=TEMPLATES, threshold: float = THRESHOLD, text: str = "text") -> DataFrame:
    """Base columns, `labels` and `score` for every row of `docs` (packed in `_row`)."""
    found = matches(docs, templates, threshold, text).groupBy("_md5").agg(
        F.collect_set("label").alias("_found"),  # as many as the template list has labels
        F.max("containment").alias("_best"),
        F.sum("blocks").alias("n_blocks"),
    )
    rows = base(docs, text).join(found, "_md5", "left")
    labels = F.array_sort(F.array_union("_base_labels", F.coalesce("_found", F.array().cast("array<string>"))))
    return rows.select(
        "_row", "n_words", "n_base", "first_word", "last_word",
        F.array_join("_base_labels", ",").alias("base_labels"),
        F.array_join(labels, ",").alias("labels"),
        F.greatest(F.coalesce("_best", F.lit(0.0)), F.when(F.col("n_base") > 0, 1.0).otherwise(0.0)).alias("score"),
        F.coalesce("n_blocks", F.lit(0)).cast("long").alias("n_blocks"),
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(table(spark, sf_dir, "documents")).select(F.col("_row.doc_id").alias("doc_id"), *(
        "n_words n_base first_word last_word base_labels labels score n_blocks".split()
    ))
