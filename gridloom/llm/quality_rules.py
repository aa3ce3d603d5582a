"""Quality rules by robust multivariate outliers, with DataFrame functions only.

Each text's counts become four statistics (logarithms of word length and of the rates of symbols, repeated lines and
repeated words). For each language and source the minimum covariance determinant estimate is sought: from two starts
(medians with median deviations; means with variances), concentration steps take the 75 % of rows nearest by Mahalanobis
distance and estimate mean and covariance anew, until nothing changes; the start that ends with the smaller determinant
counts. A text whose distance is beyond the chi-square quantile is rejected.

Statistics are fixed-point integers: sums of them and of their products are exact whatever the order in which tasks end,
and medians over them, as over the distances' integer steps, are exact with bounded state. So a step is two grouped
aggregates that combine before the shuffle, also for a source that holds a third of all rows. A floor is added to each
variance (a regularised estimate), as most sources have no symbols at all and a singular covariance would reject every
text that has one. A source with fewer than LEAST_GROUP (50) rows is judged by the estimate over its whole language, and
a language with fewer by that over all rows; the columns group_lang and group_source say which group judged.

Repeated words are found by 64-bit hashes of three words within one text.

Defined results: a null text has no words; a null language or source is a value of its own; texts that fail the base
rules never shape an estimate; if the whole table has fewer than 50 other rows, all of them are kept;
repeated rows each count; a text has fewer than 2**28 words (their places must fit); an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gridloom.llm.common import SPACE, discard, join_values, pick, stored, table

SCALE = 256
#: The least standard deviation of each statistic.
FLOORS = (0.08, 0.2, 0.2, 0.25)
SHARE, LEAST_GROUP = 0.75, 50
#: Chance that a text like its source's others is rejected, if statistics were normal.
CHANCE = 1e-5
P = len(FLOORS)
#: The bits of a packed number that hold a word's place.
PLACE = (1 << 28) - 1
_X = [f"x{i}" for i in range(P)]
_GROUP = ["group_lang", "group_source"]
_ESTIMATE = [f"m{i}" for i in range(P)] + [f"l{i}{j}" for i in range(P) for j in range(i + 1)]


def _chi_square_4(chance: float) -> float:
    """x with P(chi-square of 4 degrees > x) = chance."""
    low, high = 0.0, 1000.0
    for _ in range(200):
        mid = (low + high) / 2
        low, high = (mid, high) if math.exp(-mid / 2) * (1 + mid / 2) > chance else (low, mid)
    return high


def _consistency(share: float) -> float:
    """What the covariance of the nearest share is short of the whole's, for four normal statistics."""
    q = _chi_square_4(1 - share)
    six = 1 - math.exp(-q / 2) * (1 + q / 2 + q * q / 8)
    return share / six


def counts(documents: DataFrame) -> DataFrame:
    """documents (doc_id, text, lang, source): with n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    docs = pick(documents, "doc_id", "text", "lang", "source").withColumn("text", F.coalesce(F.col("text").cast("string"), F.lit("")))
    docs = docs.withColumn("words", F.array_remove(F.split("text", SPACE), ""))
    lines = F.filter(F.split("text", "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    docs = docs.select(
        *("doc_id", "lang", "source"),
        F.size("words").cast("long").alias("n_words"),
        F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        F.regexp_count("text", F.lit("[#*$%&|<>]")).cast("long").alias("n_symbols"),
        lines.alias("lines"),
        F.transform("words", lambda w: F.xxhash64(w)).alias("h"),
    )
    # sort plain numbers first: some bits of each three's hash above its place; only where those agree are hashes compared
    three = lambda at: F.xxhash64(F.get("h", at), F.get("h", at + 1), F.get("h", at + 2))
    marked = F.transform("h", lambda x, i: F.xxhash64(x, F.get("h", i + 1), F.get("h", i + 2)).bitwiseAND(~PLACE).bitwiseOR(i.cast("long")))
    docs = docs.withColumn("marked", F.sort_array(F.slice(marked, F.lit(1), F.greatest(F.size("h") - 2, F.lit(0)))))
    near = lambda x, i, by: F.shiftright(x, 28) == F.shiftright(F.get("marked", i + by), 28)
    maybe = F.array_compact(F.transform("marked", lambda x, i: F.when(near(x, i, -1) | near(x, i, 1), x.bitwiseAND(PLACE).cast("int"))))
    docs = docs.withColumn("maybe", maybe)
    docs = docs.withColumn("threes", F.sort_array(F.transform("maybe", lambda at: F.struct(three(at).alias("g"), at.alias("at")))))
    twice = F.transform("threes", lambda x, i: F.when((x["g"] == F.get("threes", i - 1)["g"]) | (x["g"] == F.get("threes", i + 1)["g"]), x["at"]))
    docs = docs.withColumn("starts", F.sort_array(F.array_compact(twice)))
    covered = F.transform("starts", lambda x, i: F.least(F.lit(3), F.coalesce(F.get("starts", i + 1) - x, F.lit(3))))
    return docs.select(
        *("doc_id", "lang", "source", "n_words", "word_chars", "n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.aggregate(covered, F.lit(0).cast("long"), lambda a, x: a + x).alias("n_repeat_words"),
    )


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def _statistics() -> list[Column]:
    rate = lambda c, k: F.log1p(k * F.col(c) / F.col("n_words"))
    values = [F.log(F.col("word_chars") / F.col("n_words")), rate("n_symbols", 20), rate("n_dup_lines", 20), rate("n_repeat_words", 5)]
    return [F.round(SCALE * v).cast("long").alias(x) for v, x in zip(values, _X, strict=True)]


def _pools(rows: DataFrame, least: int) -> DataFrame:
    """A row for each language and source: the group whose estimate judges it, and all groups whose estimates it shapes.

    A source with fewer than `least` rows is judged by the estimate over its whole language, a language with fewer by that
    over all rows; these estimates are made of all their rows, those of large sources included.
    """
    sizes = rows.groupBy("lang_key", "source_key").agg(F.count(F.lit(1)).alias("n"))
    langs = sizes.groupBy("lang_key").agg(F.sum("n").alias("of_lang"), F.min("n").alias("smallest"))
    of_all, smallest_lang = langs.agg(F.sum("of_lang"), F.min("of_lang")).first()
    all_needed = F.lit((of_all or 0) >= least and smallest_lang < least)
    sizes = sizes.join(langs, "lang_key")
    own = F.struct(F.col("lang_key").alias("group_lang"), F.col("source_key").alias("group_source"))
    lang = F.struct(F.col("lang_key").alias("group_lang"), F.lit("*").alias("group_source"))
    every = F.struct(F.lit("*").alias("group_lang"), F.lit("*").alias("group_source"))
    n, of_lang = F.col("n") >= least, F.col("of_lang") >= least
    shapes = F.array(F.when(n, own), F.when(of_lang & (F.col("smallest") < least), lang), F.when(all_needed, every))
    judge = F.when(n, own).when(of_lang, lang).when(all_needed, every)
    return sizes.select("lang_key", "source_key", judge.alias("judge"), F.array_compact(shapes).alias("shapes"))


def _factor(moments: DataFrame, share: float) -> DataFrame:
    """n, s_i, s_ij (sums of the subset) to means, the Cholesky factor of the floored covariance, and its log determinant."""
    f = _consistency(share) if share < 1 else 1.0
    n = F.col("n").cast("double")
    rows = moments.select(*_GROUP, "start", "n", *((F.col(f"s{i}") / n).alias(f"m{i}") for i in range(P)), *(((F.col(f"s{i}{j}") - F.col(f"s{i}").cast("double") * F.col(f"s{j}") / n) / n * f).alias(f"c{i}{j}") for i in range(P) for j in range(i + 1)))
    return _cholesky(rows)


def _cholesky(rows: DataFrame) -> DataFrame:
    for i in range(P):
        for j in range(i + 1):
            value = F.col(f"c{i}{j}") + (F.lit((SCALE * FLOORS[i]) ** 2) if i == j else F.lit(0.0))
            for k in range(j):
                value = value - F.col(f"l{i}{k}") * F.col(f"l{j}{k}")
            rows = rows.withColumn(f"l{i}{j}", F.sqrt(value) if i == j else value / F.col(f"l{j}{j}"))
    det = sum((F.log(F.col(f"l{i}{i}")) for i in range(1, P)), F.log("l00"))
    return rows.select(*_GROUP, "start", "n", *_ESTIMATE, det.alias("log_det"))


def _distance(estimate: str) -> Column:
    """The squared Mahalanobis distance of x0.. from an estimate, a struct."""
    y: list[Column] = []
    for i in range(P):
        value = F.col(f"x{i}") - F.col(f"{estimate}.m{i}")
        for k in range(i):
            value = value - F.col(f"{estimate}.l{i}{k}") * y[k]
        y.append(value / F.col(f"{estimate}.l{i}{i}"))
    return sum((v * v for v in y[1:]), y[0] * y[0])


def _sums() -> list[Column]:
    return [F.count(F.lit(1)).alias("n"), *(F.sum(x).alias(f"s{i}") for i, x in enumerate(_X)), *(F.sum(F.col(f"x{i}") * F.col(f"x{j}")).alias(f"s{i}{j}") for i in range(P) for j in range(i + 1))]


def _concentrate(rows: DataFrame, now: DataFrame) -> DataFrame:
    """C-steps from all starts at once until nothing changes; rows has the groups and statistics.

    Distances are integer steps, so one grouped count of them, with the sums of what lies on each step, holds all that
    the next estimate needs: the rows are read once a step, and combined before the shuffle.
    """
    seen = set()
    while True:
        mark = tuple(now.agg(F.sum("n"), F.sum(F.round(F.col("log_det"), 9)), F.sum(F.shiftright(F.xxhash64(*_ESTIMATE), 20))).first())
        if mark in seen:  # unchanged, or back where it was
            return now
        seen.add(mark)
        starts = [now.filter(F.col("start") == k).select(*_GROUP, F.struct(*_ESTIMATE).alias(f"e{k}")) for k in (0, 1)]
        beside = join_values(rows, stored(starts[0].join(starts[1], _GROUP), "starts"), _GROUP)
        near = beside.select(*_GROUP, *_X, F.inline(F.array(*(F.struct(F.lit(k).alias("start"), F.floor(32 * F.log1p(_distance(f"e{k}"))).cast("int").alias("step")) for k in (0, 1)))))
        steps = near.groupBy(*_GROUP, "start", "step").agg(*_sums())
        order = Window.partitionBy(*_GROUP, "start").orderBy("step")
        before = F.sum("n").over(order) - F.col("n")
        inside = steps.withColumn("before", before).withColumn("all", F.sum("n").over(Window.partitionBy(*_GROUP, "start"))).filter(F.col("before") <= F.floor(SHARE * (F.col("all") - 1)))
        sums = ["n", *(f"s{i}" for i in range(P)), *(f"s{i}{j}" for i in range(P) for j in range(i + 1))]
        last, now = now, stored(_factor(inside.groupBy(*_GROUP, "start").agg(*(F.sum(c).alias(c) for c in sums)), SHARE), "estimate")
        discard(last)


def estimates(rows: DataFrame) -> DataFrame:
    """rows (group_lang, group_source, x0..): each group's minimum covariance determinant estimate."""
    middle = stored(rows.groupBy(*_GROUP).agg(F.count(F.lit(1)).alias("n"), *(F.percentile(x, F.lit(0.5)).alias(f"m{i}") for i, x in enumerate(_X))), "medians")
    spread = join_values(rows, middle, _GROUP).groupBy(*_GROUP).agg(*(F.first(c).alias(c) for c in ["n", *(f"m{i}" for i in range(P))]), *(F.percentile(F.abs(F.col(x) - F.col(f"m{i}")), F.lit(0.5)).alias(f"d{i}") for i, x in enumerate(_X)))
    squares = [(F.pow(1.4826 * F.col(f"d{i}"), F.lit(2)) if i == j else F.lit(0.0)).alias(f"c{i}{j}") for i in range(P) for j in range(i + 1)]
    medians = _cholesky(spread.select(*_GROUP, F.lit(0).alias("start"), "n", *(f"m{i}" for i in range(P)), *squares))
    means = _factor(rows.groupBy(*_GROUP, F.lit(1).alias("start")).agg(*_sums()), 1.0)
    ends = _concentrate(rows, stored(medians.unionByName(means), "estimate"))
    return ends.groupBy(*_GROUP).agg(F.min(F.struct("log_det", *_ESTIMATE)).alias("best")).select(*_GROUP, "best.*").drop("log_det")


def quality_rules(documents: DataFrame, chance: float = CHANCE, least: int = LEAST_GROUP) -> DataFrame:
    """documents (doc_id, text, lang, source): doc_id, the counts, base_failed, the judging group, distance2, kept."""
    keys = [F.coalesce(F.concat(F.lit("="), F.col(c).cast("string")), F.lit("null")).alias(f"{c}_key") for c in ("lang", "source")]
    counted = stored(counts(documents).select("*", base_failed().alias("base_failed"), *keys), "counts")
    good = counted.filter("NOT base_failed")
    pools = stored(_pools(good, least), "pools")
    shaped = join_values(good, pools, ["lang_key", "source_key"]).select(F.explode("shapes").alias("group"), *_statistics())
    rows = stored(shaped.select("group.*", *_X), "statistics")
    known = estimates(rows).select(F.struct(*_GROUP).alias("judge"), F.struct(*_ESTIMATE).alias("estimate"))
    known = stored(pools.select("lang_key", "source_key", "judge").join(known, "judge", "left"), "estimates")
    judged = join_values(counted, known, ["lang_key", "source_key"], "left")
    judged = judged.select("*", *(F.when(~F.col("base_failed"), s).alias(x) for s, x in zip(_statistics(), _X, strict=True)))
    judged = judged.withColumn("distance2", _distance("estimate"))
    fits = F.coalesce(F.col("distance2") <= _chi_square_4(chance), F.lit(True))
    group = [F.when(~F.col("base_failed"), F.col(f"judge.{c}")).alias(c) for c in _GROUP]
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", *group, "distance2", (~F.col("base_failed") & fits).alias("kept"))


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = quality_rules(table(spark, sf_dir, "documents"))
    return done.withColumn("doc_id", F.col("doc_id").cast("long"))
