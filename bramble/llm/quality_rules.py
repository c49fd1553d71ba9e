"""Quality rules with risk-controlled cutoffs (DataFrame only).

Each rule is a text statistic and a fixed ladder of cutoffs; a row fails a rule when the
statistic is above the stratum's cutoff. Cutoffs come from labelled holdout rows: for a
stratum with n good rows, a cutoff that rejects k of them is safe when the exact binomial
tail P(Bin(n, a) <= k) is at most delta / m, that is, when its Clopper-Pearson bound on the
false rejection rate is below a = max_false_rejection / rules. m = strata * rules (Bonferroni);
within a ladder the tail falls with the cutoff, so testing from loose to strict until the
first failure needs no further correction. Over all rules of a stratum, false rejections
therefore stay under ``max_false_rejection`` with probability 1 - ``delta``. Among the safe
cutoffs the one with the best gain stays: labelled bad rows it rejects minus
``good_weight`` times the good rows it rejects, ties to the loosest; a rule without gain or
with too few good rows is not used in that stratum.

Only counts per (stratum, rule, step of the ladder) are shuffled. Null text has no words
and fails the base rule; null strata form one stratum of their own; a null or absent label is
no holdout row, repeated labels of one document count once by their largest quality; an empty
table gives an empty result, and without labels only the base rule rejects.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window, functions as F

from bramble.llm.shared import WHITE_SPACE, whole_text, write_shared

WINDOW = 5

# The ladders of cutoffs, from strict to loose.
SHARES = (0.005, 0.01, 0.02, 0.03, 0.05, 0.075, 0.1, 0.15, 0.2, 0.25, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9)
LENGTHS = (5.5, 6.0, 6.5, 7.0, 8.0, 9.0, 10.0, 12.0, 15.0, 20.0, 30.0, 50.0)
RULES = {
    "symbol_share": SHARES,      # characters of [#*$%&|<>] to characters in words
    "upper_share": SHARES,       # A-Z to characters in words
    "mark_share": SHARES,        # ! ? = ~ ^ to characters in words
    "dup_line_share": SHARES,    # lines equal to an earlier one to lines with a word
    "repeat_share": SHARES,      # words in repeated 5-word windows to words
    "echo_share": SHARES,        # words equal to the word before to words
    "word_length": LENGTHS,      # characters in words to words
}


def words(text: Column) -> Column:
    """Words [^\\x20\\x09-\\x0D]+ in order."""
    return F.array_remove(F.split(text, WHITE_SPACE), "")


def _left_after(text: Column, others: str) -> Column:
    """Number of characters left once the runs matched by ``others`` are gone."""
    return F.char_length(F.regexp_replace(text, others, "")).cast("long")


def statistics(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` plus n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words and the
    counts of the method's own rules; all counts are bigint."""
    text = whole_text(text_col)
    step = (docs.withColumn("_text", text).withColumn("_words", words(F.col("_text")))
            .withColumn("_lines", F.filter(F.split("_text", "\n"), lambda l: l.rlike(r"[^\x20\x09-\x0D]"))))
    # a window is known by the hash of its word hashes
    step = step.withColumn("_hashes", F.transform("_words", lambda w: F.xxhash64(w)))
    windows = F.when(F.size("_words") >= WINDOW, F.transform(
        F.sequence(F.lit(0), F.size("_words") - WINDOW),
        lambda i: F.xxhash64(*[F.get("_hashes", i + j) for j in range(WINDOW)]))).otherwise(F.array().cast("array<bigint>"))
    step = step.withColumn("_windows", windows)
    # most texts repeat no window; only the others sort theirs to find the repeated ones
    step = step.withColumn("_sorted", F.when(
        F.size(F.array_distinct("_windows")) < F.size("_windows"),
        F.sort_array(F.transform("_windows", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))))
    step = step.withColumn("_starts", F.sort_array(F.transform(
        F.filter(F.transform("_sorted", lambda x, i: F.struct(
            x["i"].alias("i"),
            (x["h"].eqNullSafe(F.get("_sorted", i - 1)["h"]) | x["h"].eqNullSafe(F.get("_sorted", i + 1)["h"])).alias("again"))),
            lambda x: x["again"]), lambda x: x["i"])))
    # starts in order: each covers up to WINDOW words, fewer where the next one begins sooner
    covered = F.aggregate(F.transform("_starts", lambda p, i: F.least(F.lit(WINDOW), F.coalesce(F.get("_starts", i + 1) - p, F.lit(WINDOW)))),
                          F.lit(0).cast("long"), lambda a, x: a + x)
    echoes = F.size(F.filter("_words", lambda w, i: (i > 0) & (w == F.get("_words", i - 1))))
    return step.select(
        *docs.columns,
        F.size("_words").cast("long").alias("n_words"),
        F.char_length(F.array_join("_words", "")).cast("long").alias("word_chars"),
        _left_after(F.col("_text"), r"[^#*$%&|<>]+").alias("n_symbols"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        F.coalesce(covered, F.lit(0).cast("long")).alias("n_repeat_words"),
        F.size("_lines").cast("long").alias("n_lines"),
        _left_after(F.col("_text"), r"[^A-Z]+").alias("n_upper"),
        _left_after(F.col("_text"), r"[^!?=~^]+").alias("n_marks"),
        echoes.cast("long").alias("n_echoes"))


def rule_values() -> dict[str, Column]:
    def share(a: str, b: str) -> Column:
        return F.coalesce(F.try_divide(F.col(a), F.col(b)), F.lit(0.0))
    return {"symbol_share": share("n_symbols", "word_chars"), "upper_share": share("n_upper", "word_chars"),
            "mark_share": share("n_marks", "word_chars"), "dup_line_share": share("n_dup_lines", "n_lines"),
            "repeat_share": share("n_repeat_words", "n_words"), "echo_share": share("n_echoes", "n_words"),
            "word_length": share("word_chars", "n_words")}


def base_failed() -> Column:
    return (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))


def _log_factorial(x: Column) -> Column:
    """ln(x!) by Stirling's series at x + 11, brought back by the product in between."""
    z = x.cast("double") + 11.0
    series = ((z - 0.5) * F.log(z) - z + 0.9189385332046727 + 1 / (12 * z) - 1 / (360 * z * z * z)
              + 1 / (1260 * z * z * z * z * z))
    back = F.lit(0.0)
    for j in range(1, 11):
        back = back + F.log(x.cast("double") + float(j))
    return series - back


def binomial_tail(k: Column, n: Column, a: float) -> Column:
    """P(Bin(n, a) <= k), exact to rounding, for k below the mean (1 otherwise).

    From k downwards each term is (i / (n - i + 1)) * ((1 - a) / a) times the one above, a
    factor under 1; the sum ends where terms no longer count."""
    odds = (1 - a) / a
    top = (_log_factorial(n) - _log_factorial(k) - _log_factorial(n - k)
           + k * math.log(a) + (n - k) * math.log(1 - a))
    terms = F.least(k, F.ceil(F.sqrt(n.cast("double") * a) * 12 + 60)).cast("int")
    total = F.aggregate(
        F.when(terms > 0, F.sequence(F.lit(0), terms - 1)).otherwise(F.array().cast("array<int>")),
        F.struct(F.lit(1.0).alias("sum"), F.lit(1.0).alias("term")),
        lambda s, i: F.struct((s["sum"] + s["term"] * (k - i) / (n - k + i + 1) * odds).alias("sum"),
                              (s["term"] * (k - i) / (n - k + i + 1) * odds).alias("term")),
        lambda s: s["sum"])
    return F.when(k >= n * a, F.lit(1.0)).otherwise(F.exp(top + F.log(total)))


def select_cutoffs(holdout: DataFrame, max_false_rejection: float, delta: float, good_weight: int) -> DataFrame:
    """(stratum, rule, cutoff) of the rules in use. ``holdout``: stratum, good (boolean) and
    one column per rule."""
    ladder = F.array(*[F.struct(F.lit(r).alias("rule"), F.array(*map(F.lit, c)).alias("ladder")) for r, c in RULES.items()])
    value = F.create_map(*[x for r in RULES for x in (F.lit(r), F.col(r))])
    # steps: how many cutoffs of the ladder the value is above
    steps = (holdout.select("stratum", "good", value.alias("values"), F.explode(ladder).alias("l"))
             .select("stratum", "good", F.col("l.rule").alias("rule"),
                     F.size(F.filter("l.ladder", lambda c: F.col("values")[F.col("l.rule")] > c)).alias("steps"))
             .groupBy("stratum", "rule", "steps")
             .agg(F.count_if("good").alias("good"), F.count_if(~F.col("good")).alias("bad")))
    # a row above s cutoffs is rejected by the s strictest ones, so by cutoff number j < s
    totals = Window.partitionBy("stratum", "rule")
    per_cutoff = (steps.withColumn("n_good", F.sum("good").over(totals))
                  .join(F.broadcast(_ladders(holdout)), "rule")  # one row per rule and cutoff: fixed size
                  .groupBy("stratum", "rule", "j", "cutoff", "n_good")
                  .agg(F.sum(F.when(F.col("steps") > F.col("j"), F.col("good")).otherwise(0)).alias("k"),
                       F.sum(F.when(F.col("steps") > F.col("j"), F.col("bad")).otherwise(0)).alias("hits")))
    m = per_cutoff.select(F.count_distinct("stratum").alias("strata"))
    safe = (per_cutoff.join(F.broadcast(m))  # one row
            .where(binomial_tail(F.col("k"), F.col("n_good"), max_false_rejection / len(RULES))
                   <= F.lit(delta) / (F.col("strata") * len(RULES))))
    gain = F.col("hits") - good_weight * F.col("k")
    best = Window.partitionBy("stratum", "rule").orderBy(gain.desc(), F.col("j").desc())
    return (safe.where(gain > 0).withColumn("r", F.row_number().over(best)).where("r = 1")
            .select("stratum", "rule", "cutoff"))


def _ladders(df: DataFrame) -> DataFrame:
    rows = [(r, j, c) for r, cs in RULES.items() for j, c in enumerate(cs)]
    return df.sparkSession.createDataFrame(rows, "rule string, j int, cutoff double")


def quality_rules(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  stratum_col: str = "lang", max_false_rejection: float = 0.05, delta: float = 0.05,
                  good_weight: int = 10) -> DataFrame:
    """One row per document: doc_id, the statistics, base_failed, failed_rules, kept."""
    picked = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(stratum_col).cast("string"), F.lit("")).alias("stratum"),
                         F.col(text_col).alias("text"))
    stats = write_shared(statistics(picked).drop("text"), "quality-statistics")
    stats = stats.select("*", *[v.alias(r) for r, v in rule_values().items()])
    known = (labels.where("doc_id is not null and quality is not null").groupBy("doc_id")
             .agg((F.max("quality") == 1).alias("good")))
    cutoffs = select_cutoffs(stats.where(~base_failed()).join(known, "doc_id"), max_false_rejection, delta, good_weight)
    # at most one row per stratum: a map from rule to cutoff
    by_stratum = cutoffs.groupBy("stratum").agg(F.map_from_entries(F.collect_list(F.struct("rule", "cutoff"))).alias("cutoffs"))
    failed = F.array_compact(F.array(*[F.when(F.col(r) > F.col("cutoffs")[r], F.lit(r)) for r in RULES]))
    out = stats.join(by_stratum, "stratum", "left").withColumn("failed_rules", F.coalesce(F.array_join(failed, ","), F.lit("")))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                      base_failed().alias("base_failed"), "failed_rules",
                      (~base_failed() & (F.col("failed_rules") == "")).alias("kept"))


def oracle(max_false_rejection: float = 0.05, delta: float = 0.05, good_weight: int = 10) -> str:
    """The same in DuckDB SQL: windows by their text, the tail as a plain sum."""
    ladder = ", ".join(f"('{r}', {j}, {c})" for r, cs in RULES.items() for j, c in enumerate(cs))
    risk = f"{max_false_rejection / len(RULES)!r}"
    return rf"""
WITH t AS (
  SELECT row_number() OVER () AS rid, doc_id, coalesce(lang, '') AS stratum, coalesce(text, '') AS txt,
         [x FOR x IN regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+') IF x <> ''] AS ws,
         [x FOR x IN string_split(coalesce(text, ''), chr(10)) IF regexp_matches(x, '[^\x20\x09-\x0D]')] AS ls
  FROM documents
), windows AS (
  SELECT rid, i, array_to_string(ws[i:i + 4], ' ') AS seq
  FROM (SELECT rid, ws, unnest(range(1, len(ws) - 3)) AS i FROM t WHERE len(ws) >= 5)
), again AS (
  SELECT rid, i FROM (SELECT *, count(*) OVER (PARTITION BY rid, seq) AS c FROM windows) WHERE c > 1
), covered AS (
  SELECT rid, count(DISTINCT i + j) AS n FROM again CROSS JOIN range(0, 5) r(j) GROUP BY rid
), s AS (
  SELECT t.rid, doc_id, stratum, len(ws)::BIGINT AS n_words, length(array_to_string(ws, ''))::BIGINT AS word_chars,
         length(regexp_replace(txt, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
         (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines, coalesce(c.n, 0)::BIGINT AS n_repeat_words,
         len(ls) AS n_lines, length(regexp_replace(txt, '[^A-Z]', '', 'g')) AS n_upper,
         length(regexp_replace(txt, '[^!?=~^]', '', 'g')) AS n_marks,
         len([i FOR i IN range(2, len(ws) + 1) IF ws[i] = ws[i - 1]]) AS n_echoes
  FROM t LEFT JOIN covered c USING (rid)
), valued AS (
  SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
         MAP {{'symbol_share': coalesce(n_symbols / nullif(word_chars, 0), 0.0), 'upper_share': coalesce(n_upper / nullif(word_chars, 0), 0.0),
              'mark_share': coalesce(n_marks / nullif(word_chars, 0), 0.0), 'dup_line_share': coalesce(n_dup_lines / nullif(n_lines, 0), 0.0),
              'repeat_share': coalesce(n_repeat_words / nullif(n_words, 0), 0.0), 'echo_share': coalesce(n_echoes / nullif(n_words, 0), 0.0),
              'word_length': coalesce(word_chars / nullif(n_words, 0), 0.0)}} AS vals
  FROM s
), known AS (
  SELECT doc_id, max(quality) = 1 AS good FROM labels WHERE doc_id IS NOT NULL AND quality IS NOT NULL GROUP BY doc_id
), holdout AS (
  SELECT stratum, good, vals FROM valued JOIN known USING (doc_id) WHERE NOT base_failed
), ladder AS (SELECT * FROM (VALUES {ladder}) l(rule, j, cutoff)
), counted AS (
  SELECT stratum, rule, j, cutoff::DOUBLE AS cutoff, count(*) FILTER (WHERE good) AS n,
         count(*) FILTER (WHERE good AND vals[rule] > cutoff) AS k, count(*) FILTER (WHERE NOT good AND vals[rule] > cutoff) AS hits
  FROM holdout CROSS JOIN ladder GROUP BY ALL
), tailed AS (
  SELECT *, CASE WHEN k >= n * {risk} THEN 1.0 ELSE list_sum([
           exp(lgamma(n + 1) - (CASE WHEN i = 0 THEN 0 ELSE lgamma(i + 1) END) - lgamma(n - i + 1) + i * ln({risk}) + (n - i) * ln(1 - {risk}))
           FOR i IN range(0, k + 1)]) END AS p
  FROM counted
), chosen AS (
  SELECT stratum, rule, cutoff FROM tailed
  WHERE p <= {delta} / ((SELECT count(DISTINCT stratum) FROM counted) * {len(RULES)}) AND hits - {good_weight} * k > 0
  QUALIFY row_number() OVER (PARTITION BY stratum, rule ORDER BY hits - {good_weight} * k DESC, j DESC) = 1
), failing AS (
  SELECT v.rid, string_agg(c.rule, ',' ORDER BY list_position({list(RULES)!r}, c.rule)) AS failed
  FROM valued v JOIN chosen c ON c.stratum = v.stratum AND v.vals[c.rule] > c.cutoff GROUP BY v.rid
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       coalesce(failed, '') AS failed_rules, NOT base_failed AND failed IS NULL AS kept
FROM valued LEFT JOIN failing USING (rid)
"""


ORACLE = oracle()
