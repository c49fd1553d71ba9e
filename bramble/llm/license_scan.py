"""Licence scan by a positional rare-token index (DataFrame only).

Templates are word sequences with a mandatory key phrase at a known place. One pass counts
in how many documents each licence word occurs (a table of the licence vocabulary, of fixed
size); every template is then indexed under the ``anchors`` words of highest IDF of its
phrase, each posting holding the template and the word's offset in it. In a document, an indexed word at
position p with a posting (t, o) nominates template t at start p - o; a start that all of
t's anchors nominate is a meeting of the postings by relative position, and the mandatory
phrase is verified there word by word. Starts named by the rarest anchor alone only count
towards the score. Nothing is missed: every place of a phrase holds all its words.

Everything about a document is computed in its own row; nothing but the word counts is
shuffled. Null text counts as empty (no words, no labels, score 0); null and repeated
doc_ids stay as rows of their own; an empty table gives an empty result; other columns are
not read.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F

from bramble.llm.shared import whole_text

# Words [^\x00-\x2F\x3A-\x60\x7B-\x7F]+ of the lower-cased text lie between these.
BETWEEN_WORDS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"

# Label, template words, mandatory phrase. The first three are the base.
BASE = (
    ("cc-by", "cc by", "cc by"),
    ("gpl", "general public license", "general public license"),
    ("reserved", "all rights reserved", "all rights reserved"),
)
OWN = (
    ("agpl", "gnu affero general public license", "affero general public license"),
    ("apache-2.0", "licensed under the apache license version 2 0", "apache license version 2 0"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted",
     "redistribution and use in source and binary forms"),
    ("cc-by-nc", "licensed under cc by nc", "cc by nc"),
    ("cc-by-nd", "licensed under cc by nd", "cc by nd"),
    ("cc-by-sa", "licensed under cc by sa", "cc by sa"),
    ("cc0", "licensed under cc0 1 0 universal", "cc0 1 0 universal"),
    ("gpl-2.0", "gnu general public license version 2", "general public license version 2"),
    ("gpl-3.0", "gnu general public license version 3", "general public license version 3"),
    ("lgpl", "gnu lesser general public license", "lesser general public license"),
    ("mit", "released under the mit license", "mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software",
     "permission is hereby granted free of charge"),
    ("mpl-2.0", "subject to the terms of the mozilla public license v 2 0", "mozilla public license"),
    ("unlicense", "this is free and unencumbered software released into the public domain",
     "free and unencumbered software released into the public domain"),
)
TEMPLATES = BASE + OWN


def words(text_col: str = "text") -> Column:
    """Only A-Z matter for the phrases; lower() leaves every word boundary where it is."""
    return F.array_remove(F.split(F.lower(whole_text(text_col)), BETWEEN_WORDS), "")


def vocabulary() -> list[str]:
    return sorted({w for _, template, _ in TEMPLATES for w in template.split()})


def idf(docs: DataFrame, text_col: str = "text") -> dict[str, float]:
    """IDF of the licence vocabulary over all documents: ln((N + 1) / (df + 1)) + 1."""
    known = F.array(*map(F.lit, vocabulary()))
    seen = docs.select(F.explode(F.array_append(F.array_intersect(words(text_col), known), "")).alias("word"))
    counts = {r.word: r.n for r in seen.groupBy("word").agg(F.count("*").alias("n")).collect()}  # vocabulary size at most
    n = counts.get("", 0)  # every document counts once under the empty word
    return {w: math.log((n + 1) / (counts.get(w, 0) + 1)) + 1 for w in vocabulary()}


def postings(weights: dict[str, float], anchors: int = 2) -> dict[str, list[tuple[int, int, bool]]]:
    """word -> (template, offset, is the rarest): each template under the ``anchors`` words
    of highest IDF of its mandatory phrase, ties by the word; a word that occurs twice in it
    counts at its first place."""
    index: dict[str, list[tuple[int, int, bool]]] = {}
    for t, (_, template, phrase) in enumerate(TEMPLATES):
        tokens = phrase.split()
        rare = sorted(set(tokens), key=lambda w: (-weights[w], w))[:anchors]
        for k, w in enumerate(rare):
            index.setdefault(w, []).append((t, _place(template.split(), tokens) + tokens.index(w), k == 0))
    return index


def _literal(rows: list[tuple], kind: str) -> Column:
    names = [f.split()[0] for f in kind.split(",")]
    return F.array(*[F.struct(*[F.lit(v).alias(n) for v, n in zip(r, names)]) for r in rows])


def license_scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", anchors: int = 2) -> DataFrame:
    """One row per document: doc_id, n_words, n_base, first_word, last_word, base_labels,
    labels, score. A verified template scores 0.5 plus half its IDF-weighted share of words
    in place, an unverified one half the share; the score is the best one, 0 without any."""
    weights = idf(docs, text_col)
    index = postings(weights, anchors)
    rare = F.array(*map(F.lit, sorted(index)))
    lookup = F.create_map(*[x for w in sorted(index)
                            for x in (F.lit(w), _literal(index[w], "t int, o int, rarest boolean"))])
    template = F.array(*[F.array(*map(F.lit, t.split())) for _, t, _ in TEMPLATES])
    weight = F.array(*[F.array(*[F.lit(weights[w]) for w in t.split()]) for _, t, _ in TEMPLATES])
    total = F.array(*[F.lit(sum(weights[w] for w in t.split())) for _, t, _ in TEMPLATES])
    phrase = F.array(*[F.array(*map(F.lit, p.split())) for _, _, p in TEMPLATES])
    phrase_at = F.array(*[F.lit(_place(t.split(), p.split())) for _, t, p in TEMPLATES])
    needed = F.array(*[F.lit(min(anchors, len(set(p.split())))) for _, _, p in TEMPLATES])
    label = F.array(*[F.lit(x) for x, _, _ in TEMPLATES])

    step = docs.select(F.col(id_col).alias("doc_id"), words(text_col).alias("words"))
    step = step.withColumn("hits", F.when(F.arrays_overlap("words", rare), F.filter(
        F.transform("words", lambda w, i: F.struct(w.alias("w"), i.alias("i"))),
        lambda x: x["w"].isin(sorted(index)))))
    # nominations (template, start), one per posting of an indexed word
    step = step.withColumn("named", F.flatten(F.transform("hits", lambda h: F.transform(
        lookup[h["w"]], lambda p: F.struct(p["t"].alias("t"), (h["i"] - p["o"]).alias("start"), p["rarest"].alias("rarest"))))))
    step = step.withColumn("named", F.array_sort("named"))
    # sorted by (t, start): the nominations of one start stand together
    step = step.withColumn("places", F.transform(
        F.filter(F.transform("named", lambda x, k: F.struct(
            x["t"].alias("t"), x["start"].alias("start"), x["rarest"].alias("rarest"),
            F.reduce(F.slice("named", k + 1, anchors), F.lit(0), lambda a, y: a + F.when(
                (y["t"] == x["t"]) & (y["start"] == x["start"]), 1).otherwise(0)).alias("met"),
            F.reduce(F.slice("named", k + 1, anchors), F.lit(False), lambda a, y: a | (
                (y["t"] == x["t"]) & (y["start"] == x["start"]) & y["rarest"])).alias("by_rarest"),
            F.coalesce((F.get("named", k - 1)["t"] == x["t"]) & (F.get("named", k - 1)["start"] == x["start"]),
                       F.lit(False)).alias("seen"))),
            lambda x: ~x["seen"] & x["by_rarest"]),
        lambda x: F.struct(x["t"].alias("t"), x["start"].alias("start"), (x["met"] >= F.get(needed, x["t"])).alias("all"))))
    at = lambda start, j: F.get("words", start + j)  # noqa: E731 - null outside the text
    step = step.withColumn("scored", F.transform("places", lambda x: F.struct(
        x["t"].alias("t"), x["start"].alias("start"),
        (x["all"] & F.forall(F.transform(F.get(phrase, x["t"]), lambda w, j: F.struct(w.alias("w"), j.alias("j"))),
                             lambda y: F.coalesce(at(x["start"] + F.get(phrase_at, x["t"]), y["j"]) == y["w"], F.lit(False)))
         ).alias("ok"),
        (F.aggregate(F.transform(F.get(template, x["t"]), lambda w, j: F.when(
            at(x["start"], j) == w, F.get(F.get(weight, x["t"]), j)).otherwise(0.0)),
            F.lit(0.0), lambda a, y: a + y) / F.get(total, x["t"])).alias("share"))))
    verified = F.filter("scored", lambda x: x["ok"])
    base = F.transform(F.filter(verified, lambda x: x["t"] < len(BASE)), lambda x: x["start"])
    named = lambda which: F.coalesce(F.array_join(F.array_sort(F.array_distinct(F.transform(
        which, lambda x: F.get(label, x["t"])))), ","), F.lit(""))
    best = F.array_max(F.transform("scored", lambda x: F.when(x["ok"], 0.5 + x["share"] / 2).otherwise(x["share"] / 2)))
    return step.select(
        "doc_id", F.size("words").cast("long").alias("n_words"),
        F.greatest(F.size(base), F.lit(0)).cast("long").alias("n_base"),
        F.array_min(base).cast("long").alias("first_word"), F.array_max(base).cast("long").alias("last_word"),
        named(F.filter(verified, lambda x: x["t"] < len(BASE))).alias("base_labels"), named(verified).alias("labels"),
        F.round(F.coalesce(best, F.lit(0.0)), 6).alias("score"))


def _place(template: list[str], phrase: list[str]) -> int:
    return next(i for i in range(len(template)) if template[i:i + len(phrase)] == phrase)


def oracle(anchors: int = 2) -> str:
    """The same in DuckDB SQL: all words as rows, postings met by (document, template, start)."""
    rows = ", ".join(f"({t}, '{label}', string_split('{words}', ' '), string_split('{phrase}', ' '), {_place(words.split(), phrase.split())})"
                     for t, (label, words, phrase) in enumerate(TEMPLATES))
    return rf"""
WITH tpl AS (SELECT * FROM (VALUES {rows}) v(t, label, tw, phrase, place)
), d AS (
  SELECT row_number() OVER () AS rid, doc_id,
         [x FOR x IN regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                           '[\x00-\x2F\x3A-\x60\x7B-\x7F]+') IF x <> ''] AS ws
  FROM documents
), vocabulary AS (SELECT DISTINCT unnest(tw) AS w FROM tpl
), seen AS (SELECT w, count(*) AS n FROM (SELECT unnest(list_distinct(ws)) AS w FROM d) GROUP BY w
), idf AS (
  SELECT w, ln(((SELECT count(*) FROM d) + 1) / (coalesce(n, 0) + 1)) + 1 AS idf FROM vocabulary LEFT JOIN seen USING (w)
), anchor AS (
  SELECT t, w, place + list_position(phrase, w) - 1 AS o, row_number() OVER (PARTITION BY t ORDER BY idf DESC, w) AS r
  FROM (SELECT DISTINCT t, place, phrase, unnest(phrase) AS w FROM tpl) JOIN idf USING (w)
  QUALIFY r <= {anchors}
), named AS (
  SELECT rid, t, i - 1 - o AS start, r FROM (SELECT rid, unnest(ws) AS w, unnest(range(1, len(ws) + 1)) AS i FROM d) JOIN anchor USING (w)
), places AS (
  SELECT rid, t, start, count(*) AS met FROM named GROUP BY ALL HAVING min(r) = 1
), scored AS (
  SELECT p.rid, p.t, p.start, tpl.label,
         p.met >= (SELECT count(*) FROM anchor a WHERE a.t = p.t) AND p.start + place >= 0
           AND d.ws[p.start + place + 1:p.start + place + len(phrase)] = phrase AS ok,
         (SELECT sum(CASE WHEN p.start + j >= 0 AND d.ws[p.start + j + 1] = x.w THEN idf ELSE 0 END) / sum(idf)
          FROM (SELECT unnest(tpl.tw) AS w, unnest(range(0, len(tpl.tw))) AS j) x JOIN idf USING (w)) AS share
  FROM places p JOIN tpl USING (t) JOIN d USING (rid)
), found AS (
  SELECT rid, count(*) FILTER (WHERE ok AND t < {len(BASE)}) AS n_base,
         min(start) FILTER (WHERE ok AND t < {len(BASE)}) AS first_word, max(start) FILTER (WHERE ok AND t < {len(BASE)}) AS last_word,
         array_to_string(list_sort(list(DISTINCT label) FILTER (WHERE ok AND t < {len(BASE)})), ',') AS base_labels,
         array_to_string(list_sort(list(DISTINCT label) FILTER (WHERE ok)), ',') AS labels,
         max(CASE WHEN ok THEN 0.5 + share / 2 ELSE share / 2 END) AS score
  FROM scored GROUP BY rid
)
SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word,
       coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels, round(coalesce(score, 0), 6) AS score
FROM d LEFT JOIN found USING (rid)
"""


ORACLE = oracle()
