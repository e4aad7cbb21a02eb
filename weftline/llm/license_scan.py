"""License scans with a positional rare-token index, in DataFrame functions only.

The index holds each template's words with their places, but for function words. One pass over the
texts keeps, of each text, its licence words with their places and its number of words; everything
else works on that slim table.

A word's IDF is counted over all texts. A text's licence words are looked up from the highest IDF on,
until every template whose mandatory phrases' words the text holds is covered: for each such template
that is its rarest mandatory word, the anchor. Anchors give the starts where the template may stand;
there the template's postings are intersected with the text's by relative position: votes for one
(text, template, start) meet in a count. A place is a match if all words of the mandatory phrases
voted and at least COVERAGE of all indexed words did. No match is lost by the lookup, since a match
holds its anchor.

Votes are dealt by text, template and start, so a text with very many notices is spread too. Null text
counts as empty: no words, no labels, score 0. Repeated rows give repeated results.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from weftline.llm import license_texts
from weftline.session import materialize

#: What separates words, after A-Z are lower-cased.
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Words of templates that the index leaves out.
FUNCTION_WORDS = frozenset("a all an and any are as at be but by can do for from if in into is it may no not of on one or other shall so such that the these this to was which will with within without you your".split())


@dataclass(frozen=True)
class Template:
    """text: whole template; phrases: its mandatory parts; base: whether its places are counted apart."""

    label: str
    text: str
    phrases: tuple[str, ...]
    base: bool = False

    @cached_property
    def words(self) -> list[str]:
        return re.sub(SEPARATORS, " ", self.text.translate(str.maketrans(UPPER, LOWER))).split()

    @cached_property
    def index(self) -> list[tuple[int, str, bool]]:
        """(place, word, whether mandatory) of the indexed words."""
        must = set()
        for phrase in self.phrases:
            k = phrase.split()
            first = next(i for i in range(len(self.words)) if self.words[i : i + len(k)] == k)
            must |= set(range(first, first + len(k)))
        return [(i, w, i in must) for i, w in enumerate(self.words) if w not in FUNCTION_WORDS]

    @cached_property
    def key(self) -> list[str]:
        return sorted({w for _, w, k in self.index if k})


#: The base phrases, then notices and whole texts that add labels.
TEMPLATES = (
    Template("mit", "mit license", ("mit license",), True),
    Template("apache", "apache license", ("apache license",), True),
    Template("gpl", "general public license", ("general public license",), True),
    Template("mit-notice", "released under the mit license", ("under the mit license",)),
    Template("apache-2.0", "licensed under the apache license version 2 0", ("apache license version 2 0",)),
    Template("gpl-3.0", "this work is licensed under the gnu general public license version 3", ("gnu general public license version 3",)),
    Template("cc-by-nc", "licensed under cc by nc 4 0", ("cc by nc",)),
    Template("bsd", "redistribution and use in source and binary forms with or without modification are permitted", ("redistribution and use in source and binary forms",)),
    Template("mpl-2.0", "this source code form is subject to the terms of the mozilla public license v 2 0", ("mozilla public license",)),
    Template("all-rights-reserved", "copyright all rights reserved", ("all rights reserved",)),
    Template("mit-text", license_texts.MIT, ("permission is hereby granted free of charge", "without restriction")),
    Template("bsd-2-clause-text", license_texts.BSD_2, ("redistribution and use in source and binary forms", "must retain the above copyright notice")),
    Template("isc-text", license_texts.ISC, ("distribute this software for any purpose with or without fee",)),
    Template("zlib-text", license_texts.ZLIB, ("alter it and redistribute it freely",)),
    Template("apache-2.0-text", license_texts.APACHE_2_NOTICE, ("licensed under the apache license version 2 0", "in compliance with the license")),
    Template("gpl-3.0-text", license_texts.GPL_3_NOTICE, ("gnu general public license as published", "version 3 of the license")),
    Template("mpl-2.0-text", license_texts.MPL_2_NOTICE, ("mozilla public license v 2 0", "if a copy of the mpl was not distributed")),
    Template("unlicense-text", license_texts.UNLICENSE, ("free and unencumbered software", "public domain")),
)
#: Share of a template's indexed words that must stand at their relative places.
COVERAGE = 0.6


def _lowered(text: Column) -> Column:
    """A-Z in lower case, other letters as they are."""
    text = F.coalesce(text, F.lit(""))
    return F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def postings(df: DataFrame, text: str, vocabulary: list[str], keep: list[str]) -> DataFrame:
    """keep's columns with _rid, n_words and _post: (w, p) of the words in the vocabulary, from word 0 on."""
    pieces = df.select(*keep, F.split(_lowered(F.col(text)), SEPARATORS).alias("_pieces"))
    # only the first piece and the last can be empty
    lead = (F.get("_pieces", F.lit(0)) == "").cast("int")
    trail = ((F.size("_pieces") > 1) & (F.element_at("_pieces", -1) == "")).cast("int")
    posting = lambda w, i: F.when(w.isin(vocabulary), F.struct(w.alias("w"), i.alias("p")))
    found = F.filter(F.transform("_pieces", posting), lambda x: x.isNotNull())
    rows = pieces.select(*keep, (F.size("_pieces") - lead - trail).cast("long").alias("n_words"), lead.alias("_lead"), found.alias("_post"))
    shifted = F.transform("_post", lambda x: F.struct(x["w"].alias("w"), (x["p"] - F.col("_lead")).alias("p")))
    return rows.select(*keep, F.monotonically_increasing_id().alias("_rid"), "n_words", F.when(F.size("_post") > 0, shifted).alias("_post"))


def document_frequencies(posted: DataFrame, vocabulary: list[str]) -> tuple[int, dict[str, int]]:
    """Texts, and texts that hold each vocabulary word, over all rows. At most one row for each vocabulary word reaches the driver."""
    held = F.array_distinct(F.transform(F.coalesce("_post", F.expr("array()").cast("array<struct<w: string, p: int>>")), lambda x: x["w"]))
    counts = {r["w"]: r["n"] for r in posted.select(F.explode(F.array_append(held, F.lit("*"))).alias("w")).groupBy("w").agg(F.count("*").alias("n")).collect()}
    return counts.pop("*", 0), {w: counts.get(w, 0) for w in vocabulary}


def idf(n: int, df: dict[str, int]) -> dict[str, float]:
    return {w: math.log((1 + n) / (1 + c)) for w, c in df.items()}


def template_index(spark: SparkSession, templates: tuple[Template, ...], weight: dict[str, float]) -> DataFrame:
    """(w, t, q, must, anchor): the places of each indexed word; each template has one anchor, its rarest mandatory word's first place."""
    rows = []
    for t, x in enumerate(templates):
        rarest = max(x.key, key=lambda w: (weight[w], w))
        at = next(i for i, w, k in x.index if k and w == rarest)
        rows += [f"('{w}', {t}, {i}, {int(k)}, {int(i == at)})" for i, w, k in x.index]
    return spark.sql(f"SELECT * FROM VALUES {', '.join(rows)} AS i(w, t, q, must, anchor)")


def matches(posted: DataFrame, templates: tuple[Template, ...], weight: dict[str, float], coverage: float) -> DataFrame:
    """(_rid, t, start, coverage), a row for each place of a template."""
    held = F.transform("_post", lambda x: x["w"])
    live = F.filter(F.array(*[F.when(F.size(F.array_except(F.array(*map(F.lit, x.key)), held)) == 0, F.lit(t)) for t, x in enumerate(templates)]), lambda t: t.isNotNull())
    some = posted.filter(F.col("_post").isNotNull()).select("_rid", "_post", live.alias("_live")).filter(F.size("_live") > 0)
    words = some.select("_rid", "_live", F.inline("_post"))
    # the index is as large as the templates
    votes = words.join(F.broadcast(template_index(posted.sparkSession, templates, weight)), "w").filter(F.array_contains("_live", F.col("t")))
    met = votes.groupBy("_rid", "t", (F.col("p") - F.col("q")).alias("start")).agg(F.count("*").alias("n"), F.sum("must").alias("must"), F.max("anchor").alias("anchor"))
    size = lambda of: F.get(F.array(*[F.lit(of(x)) for x in templates]), F.col("t"))
    share = F.col("n").cast("double") / size(lambda x: len(x.index))
    whole = met.filter((F.col("anchor") == 1) & (F.col("must") == size(lambda x: sum(k for _, _, k in x.index))))
    return whole.select("_rid", "t", "start", share.alias("coverage")).filter(F.col("coverage") >= coverage)


def scan(df: DataFrame, text: str = "text", templates: tuple[Template, ...] = TEMPLATES, coverage: float = COVERAGE, keep: list[str] | None = None) -> DataFrame:
    """df's columns (or those in keep) with n_words, matches (label, base, start, coverage; one for each place) and score (0 to 1).

    Columns of these names that df has are replaced. Columns that are kept are written with the postings, so leave the text out if it is not needed.
    """
    keep = [c for c in (df.columns if keep is None else keep) if c not in ("n_words", "matches", "score", "_rid", "_post")]
    vocabulary = sorted({w for x in templates for _, w, _ in x.index})
    posted = materialize(postings(df, text, vocabulary, keep))
    weight = idf(*document_frequencies(posted, vocabulary))
    fact = lambda of: F.get(F.array(*[F.lit(of(x)) for x in templates]), F.col("t"))
    match = F.struct(fact(lambda x: x.label).alias("label"), fact(lambda x: x.base).alias("base"), "start", "coverage")
    found = matches(posted, templates, weight, coverage).groupBy("_rid").agg(F.array_sort(F.collect_list(match)).alias("matches"))
    none = F.expr("array()").cast("array<struct<label: string, base: boolean, start: int, coverage: double>>")
    out = posted.drop("_post").join(found, "_rid", "left").withColumn("matches", F.coalesce("matches", none))
    return out.withColumn("score", F.coalesce(F.array_max(F.transform("matches", lambda m: m["coverage"])), F.lit(0.0))).drop("_rid")


def op1_license_scan(documents: DataFrame) -> DataFrame:
    """The contract's digest of scan()."""
    found = scan(documents.select("doc_id", "text"), keep=["doc_id"])
    base = F.filter("matches", lambda m: m["base"])
    starts = F.transform(base, lambda m: m["start"])
    joined = lambda c: F.array_join(F.array_sort(F.array_distinct(F.transform(c, lambda m: m["label"]))), ",")
    return found.select(
        "doc_id",
        "n_words",
        F.size(base).cast("long").alias("n_base"),
        F.array_min(starts).cast("long").alias("first_word"),
        F.array_max(starts).cast("long").alias("last_word"),
        joined(base).alias("base_labels"),
        joined(F.col("matches")).alias("labels"),
        "score",
    )


def op1_sql() -> str:
    """Base phrases by comparing neighbours, other templates by counting words at their places."""
    base = " UNION ALL ".join(f"SELECT rid, '{x.label}' lab, true base, p - 1 s, CAST(1 AS DOUBLE) c FROM spots WHERE " + " AND ".join(f"w[p + {j}] = '{v}'" for j, v in enumerate(x.words)) for x in TEMPLATES if x.base)
    rest = [x for x in TEMPLATES if not x.base]
    index = ", ".join(f"('{x.label}', {i}, '{w}', {int(k)})" for x in rest for i, w, k in x.index)
    sizes = ", ".join(f"('{x.label}', {len(x.index)}, {sum(k for _, _, k in x.index)})" for x in rest)
    return f"""WITH d AS (SELECT row_number() OVER () rid, doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') w FROM documents),
spots AS (SELECT rid, w, unnest(generate_series(1, len(w))) p FROM d),
i(lab, q, v, k) AS (VALUES {index}),
z(lab, n, must) AS (VALUES {sizes}),
post AS (SELECT rid, w[p] v, p - 1 p FROM spots),
votes AS (SELECT rid, lab, p - q s, count(*) h, sum(k) kh FROM post JOIN i USING (v) GROUP BY rid, lab, s),
m AS ({base} UNION ALL SELECT rid, lab, false, s, h / CAST(n AS DOUBLE) FROM votes JOIN z USING (lab) WHERE kh = must AND h / CAST(n AS DOUBLE) >= {COVERAGE}),
g AS (SELECT rid, count(*) FILTER (base) n_base, min(s) FILTER (base) first_word, max(s) FILTER (base) last_word, string_agg(DISTINCT lab, ',' ORDER BY lab) FILTER (base) base_labels, string_agg(DISTINCT lab, ',' ORDER BY lab) labels, max(c) score FROM m GROUP BY rid)
SELECT doc_id, CAST(len(w) AS BIGINT) n_words, coalesce(n_base, 0) n_base, first_word, last_word, coalesce(base_labels, '') base_labels, coalesce(labels, '') labels, coalesce(score, 0.0) score FROM d LEFT JOIN g USING (rid)"""
