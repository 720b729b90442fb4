"""Quality rules: robust multivariate outliers per language and source, in DataFrame
expressions only.

Each document becomes a vector of p = 4 transformed text statistics. The documents are first
summed per (language, source) and cell of a fine grid over the four statistics (count, sums,
cross products; combined map-side), and that is all the estimates need: a group of any size is
as many cells as its documents use, a few thousand.

On the cells the minimum-covariance-determinant estimate of every group is found by
concentration steps: take the nearest cells that hold half of the documents, their mean and covariance,
the nearest half by these, and so on until nothing changes. A step is one projection over a row
per group, without a shuffle. Starts are the coordinate-wise median scaled by the MAD, the
classical estimate and the fullest cell; the lowest determinant counts, of the covariance drawn halfway to
the squared MADs; as usual, the documents within the cutoff of it make the final (reweighted)
estimate. Documents whose squared distance, scaled so that its median fits the chi-square
median, lies beyond the cutoff are rejected.

No size decides which estimate judges a document: every group's estimate and scale lean on the
wider group's (source on language, language on all documents, these on their medians and MADs) as if
``prior`` of its documents were as the wider estimate says, which fades as the group grows. The
covariance is inverted in closed form by Cholesky expressions, with a floor on each variance for
statistics that hardly vary in a group.

Defined results: null text has no words, fails the base rules and takes no part in the
estimates; null lang or source is a group of its own; ties share a cell and a distance; repeated rows
count as often as they come; texts are read whole, whatever their length; an empty table gives no rows; only the four
columns named are read, so others may have any name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import documents, words, written

SYMBOLS = "#*$%&|<>"
P = 4
CHI2_MEDIAN = 3.3567  # chi-square, 4 degrees of freedom
FLOOR = (0.1, 0.1, 0.05, 0.1)  # least standard deviations
RESOLUTION = (4, 16, 16, 16)   # cells in a unit of each statistic
STEPS_A_JOB, MOST_JOBS = 3, 50


def text_statistics(docs: DataFrame, text: str = "text", window: int = 8) -> DataFrame:
    """``docs`` with n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    d = docs.withColumn("_t", F.coalesce(text, F.lit("")))
    d = d.withColumn("_w", words(F.col("_t")))
    d = d.withColumn("n_words", F.size("_w").cast("long"))
    # a window is known by the hash of its words' hashes
    d = d.withColumn("_h", F.transform("_w", lambda x: F.xxhash64(x)))
    d = d.withColumn("_g", F.when(F.size("_h") >= window, F.transform(
        F.sequence(F.lit(0), F.size("_h") - window),
        lambda i: F.xxhash64(*[F.get("_h", i + k) for k in range(window)]))))
    repeats = F.size(F.array_distinct("_g")) < F.size("_g")
    # sorted (hash, place): a window repeats if a neighbour has its hash
    d = d.withColumn("_s", F.when(repeats, F.sort_array(F.transform(
        "_g", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))))
    hit = lambda x, i: (F.get("_s", i - 1)["h"] == x["h"]) | (F.get("_s", i + 1)["h"] == x["h"])
    d = d.withColumn("_r", F.when(repeats, F.sort_array(F.transform(F.filter(
        "_s", lambda x, i: F.coalesce(hit(x, i), F.lit(False))), lambda x: x["i"]))))
    covered = F.aggregate(
        F.transform("_r", lambda x, i: F.least(F.lit(window), F.coalesce(F.get("_r", i + 1) - x, F.lit(window)))),
        F.lit(0).cast("long"), lambda acc, x: acc + x)
    d = d.withColumn("n_repeat_words", F.coalesce(covered, F.lit(0)).cast("long"))
    d = d.withColumn("_l", F.filter(F.split("_t", "\n"), lambda x: F.length(F.translate(x, " \t\n\x0b\f\r", "")) > 0))
    return (d.withColumn("word_chars", F.length(F.translate("_t", " \t\n\x0b\f\r", "")).cast("long"))
            .withColumn("n_symbols", (F.length("_t") - F.length(F.translate("_t", SYMBOLS, ""))).cast("long"))
            .withColumn("n_dup_lines", (F.size("_l") - F.size(F.array_distinct("_l"))).cast("long"))
            .drop("_t", "_w", "_h", "_g", "_s", "_r", "_l"))


def base_failed() -> Column:
    return (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))


def vector() -> list[Column]:
    """Transformed statistics: log words, log mean word length, symbols a character (square
    root), repeated share (square root)."""
    n, c = F.greatest(F.col("n_words"), F.lit(1)).cast("double"), F.greatest(F.col("word_chars"), F.lit(1)).cast("double")
    return [F.log(n), F.log(c / n), F.sqrt(F.col("n_symbols") / c),
            F.sqrt((F.col("n_repeat_words") + F.col("n_dup_lines")) / n)]


# -- cells: what is left of the documents for the estimates ------------------------------------

PAIRS = [(i, j) for i in range(P) for j in range(i + 1)]
FIELDS = ["n", *[f"s{i}" for i in range(P)], *[f"q{i}{j}" for i, j in PAIRS]]
EST = [*[f"m{i}" for i in range(P)], *[f"c{i}{j}" for i, j in PAIRS]]


def cells_of(rows: DataFrame, group: list[str]) -> DataFrame:
    """Rows (x0..x3) summed per cell of the grid: count, sums and cross products."""
    cell = [F.floor(F.col(f"x{i}") * RESOLUTION[i]).cast("int").alias(f"b{i}") for i in range(P)]
    return rows.groupBy(*group, *cell).agg(
        F.count("*").cast("double").alias("n"), *[F.sum(f"x{i}").alias(f"s{i}") for i in range(P)],
        *[F.sum(F.col(f"x{i}") * F.col(f"x{j}")).alias(f"q{i}{j}") for i, j in PAIRS])


def wider(cells: DataFrame, group: list[str]) -> DataFrame:
    """Cells of a wider group from those of its parts."""
    return cells.groupBy(*group, *[f"b{i}" for i in range(P)]).agg(*[F.sum(f).alias(f) for f in FIELDS])


def gathered(cells: DataFrame, group: list[str]) -> DataFrame:
    """A row per group: ``total`` rows and the array ``cells``, as long as the grid has cells in use."""
    cell = F.struct("n", *[(F.col(f"s{i}") / F.col("n")).alias(f"x{i}") for i in range(P)], *FIELDS[1:])
    return cells.groupBy(*group).agg(F.sum("n").alias("total"), F.sort_array(F.collect_list(cell)).alias("cells"))


def weighted(value: str, share: str = "total / 2", cells: str = "cells") -> Column:
    """The least ``value`` of a cell x that, with all smaller ones, has ``share`` of the rows."""
    return F.expr(f"aggregate(sort_array(transform({cells}, x -> struct({value} as v, x.n as n))), "
                  f"named_struct('n', 0D, 'v', cast(null as double)), "
                  f"(a, e) -> if(a.n >= {share}, a, named_struct('n', a.n + e.n, 'v', e.v)), a -> a.v)")


def distance() -> str:
    """Squared Mahalanobis distance of a cell x from columns m and the factor l."""
    y = []
    for i in range(P):
        y.append(f"((x.x{i} - m{i}" + "".join(f" - l{i}{k} * {y[k]}" for k in range(i)) + f") / l{i}{i})")
    return " + ".join(f"{v} * {v}" for v in y)


def factor(d: DataFrame, c: str = "c", l: str = "l") -> DataFrame:
    """Cholesky factor of the covariance columns, column by column, pivots not below the floor."""
    for j in range(P):
        dot = lambda i: sum((F.col(f"{l}{i}{k}") * F.col(f"{l}{j}{k}") for k in range(j)), F.lit(0.0))  # noqa: E731, B023
        d = d.withColumns({f"{l}{j}{j}": F.sqrt(F.greatest(F.col(f"{c}{j}{j}") - dot(j), F.lit(FLOOR[j] ** 2)))})
        if j < P - 1:
            d = d.withColumns({f"{l}{i}{j}": (F.col(f"{c}{i}{j}") - dot(i)) / F.col(f"{l}{j}{j}") for i in range(j + 1, P)})
    return d


def estimate(d: DataFrame, some: str, prior: float) -> DataFrame:
    """Columns m and c: mean and covariance of the sums in struct ``some`` and of ``prior`` rows that
    are as the wider group's estimate (columns p and r) says."""
    w = F.col(f"{some}.n") + prior
    d = d.withColumns({f"m{i}": (F.col(f"{some}.s{i}") + prior * F.col(f"p{i}")) / w for i in range(P)})
    more = lambda i, j: prior * (F.col(f"r{i}{j}") + F.col(f"p{i}") * F.col(f"p{j}"))
    return d.withColumns({f"c{i}{j}": (F.col(f"{some}.q{i}{j}") + more(i, j)) / w - F.col(f"m{i}") * F.col(f"m{j}") for i, j in PAIRS})


def nearest(condition: str) -> Column:
    """Sums over the cells, nearest first, while ``condition`` on (a: the sums so far, e: the next) holds."""
    zero = ", ".join(f"'{f}', 0D" for f in FIELDS)
    more = ", ".join(f"'{f}', a.{f} + e.x.{f}" for f in FIELDS)
    return F.expr(f"aggregate(sort_array(transform(cells, x -> struct({distance()} as d, x as x))), named_struct({zero}), "
                  f"(a, e) -> if({condition}, named_struct({more}), a))")


def scale_of(prior: float) -> Column:
    """The median distance over the chi-square median, at least 1; a small group's is the wider
    group's as well, by the same weights."""
    own = F.greatest(weighted(distance()) / CHI2_MEDIAN, F.lit(1.0))
    return F.exp((F.col("total") * F.log(own) + prior * F.log("ps")) / (F.col("total") + prior))


def robust(groups: DataFrame, prior: float, share: float, cutoff: float) -> DataFrame:
    """Minimum-covariance-determinant estimates: columns m, c and scale for every row of
    ``groups`` (id, total, cells, the wider group's estimate p, r and scale ps)."""
    spread = groups.withColumns({f"_med{i}": weighted(f"x.x{i}") for i in range(P)})
    spread = written(spread.withColumns({f"_var{i}": F.pow(F.greatest(1.4826 * weighted(f"abs(x.x{i} - _med{i})"), F.lit(FLOOR[i])), 2)
                                         for i in range(P)}), "mcd-groups")
    med, var = [f"_med{i}" for i in range(P)], [f"_var{i}" for i in range(P)]
    whole = spread.withColumn("_all", F.expr("aggregate(cells, named_struct({}), (a, x) -> named_struct({}))".format(
        ", ".join(f"'{f}', 0D" for f in FIELDS), ", ".join(f"'{f}', a.{f} + x.{f}" for f in FIELDS))))
    mode = F.expr("array_max(transform(cells, x -> struct(x.n as n, x.x0 as x0, x.x1 as x1, x.x2 as x2, x.x3 as x3)))")
    diagonal = [(F.col(var[i]) if i == j else F.lit(0.0)).alias(f"c{i}{j}") for i, j in PAIRS]
    starts = (spread.select("id", F.lit(0).alias("start"), *[F.col(c).alias(f"m{i}") for i, c in enumerate(med)], *diagonal)
              .unionByName(estimate(whole, "_all", prior).select("id", F.lit(1).alias("start"), *EST))
              .unionByName(spread.withColumn("_mode", mode).select("id", F.lit(2).alias("start"),
                                                                   *[F.col(f"_mode.x{i}").alias(f"m{i}") for i in range(P)], *diagonal)))
    est, last = written(starts, "mcd-estimate"), None
    for _ in range(MOST_JOBS):
        d = spread.join(est, "id")
        for k in range(STEPS_A_JOB):
            d = estimate(factor(d).withColumn(f"_half{k}", nearest(f"a.n < total * {share}")), f"_half{k}", prior)
        est = written(d.select("id", "start", *EST), "mcd-estimate")
        now = est.agg(F.sum(F.xxhash64("id", "start", *[F.round(c, 6) for c in EST]) % 1_000_000_007)).first()
        if now == last:
            break
        last = now
    else:
        raise RuntimeError("concentration steps didn't settle")
    # of the starts the lowest determinant, of the covariance drawn halfway to the squared MADs:
    # else a flat half with junk in it may look smaller than a whole one without
    mixed = spread.join(est, "id").select("id", "start", *EST, *[
        (0.5 * F.col(f"c{i}{j}") + (0.5 * F.col(var[i]) if i == j else F.lit(0.0))).alias(f"v{i}{j}") for i, j in PAIRS])
    det = F.round(sum((F.log(f"w{i}{i}") for i in range(P)), F.lit(0.0)), 6)
    best = factor(mixed, "v", "w").groupBy("id").agg(F.min(F.struct(det.alias("d"), "start", *EST)).alias("b")).select("id", *[f"b.{c}" for c in EST])
    fit = factor(spread.join(best, "id")).withColumn("_scale", scale_of(prior))
    fit = fit.withColumn("_inner", nearest(f"e.d <= {cutoff} * _scale"))
    keep = [c for c in spread.columns if c not in med + var]
    fit = written(estimate(fit, "_inner", prior).select(*keep, *EST), "mcd-reweighted")
    return written(factor(fit).withColumn("scale", scale_of(prior)).select("id", *[c for c in keep if c not in ("id", "cells")], *EST, "scale"), "mcd-final")


def group_estimates(rows: DataFrame, prior: float, share: float, cutoff: float) -> DataFrame:
    """(lang, source, m, c, scale): all documents first, then languages that lean on them, then
    sources that lean on their language."""
    narrow = written(cells_of(rows, ["lang", "source"]), "quality-cells")
    lang = wider(narrow, ["lang"])
    levels = [(wider(lang, []), []), (lang, ["lang"]), (narrow, ["lang", "source"])]
    above = None
    for cells, group in levels:
        g = gathered(cells, group).withColumn("id", F.monotonically_increasing_id()).where("total > 0")
        if above is None:
            g = g.withColumns({f"p{i}": weighted(f"x.x{i}") for i in range(P)})
            g = g.withColumns({f"r{i}{i}": F.pow(F.greatest(1.4826 * weighted(f"abs(x.x{i} - p{i})"), F.lit(FLOOR[i])), 2) for i in range(P)})
            g = g.select("*", *[F.lit(0.0).alias(f"r{i}{j}") for i, j in PAIRS if i != j], F.lit(1.0).alias("ps"))
        else:
            up = above.select(*[F.col(c).alias(f"_{c}") for c in group[:-1]], *[F.col(f"m{i}").alias(f"p{i}") for i in range(P)],
                              *[F.col(f"c{i}{j}").alias(f"r{i}{j}") for i, j in PAIRS], F.col("scale").alias("ps"))
            on = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in group[:-1]] or [F.lit(True)]
            g = (g.join(up, on) if group[:-1] else g.withColumn("_k", F.lit(1)).join(up.withColumn("_k", F.lit(1)), "_k").drop("_k"))
            g = g.drop(*[f"_{c}" for c in group[:-1]])
        above = robust(written(g, "quality-groups"), prior, share, cutoff)
    return above


def verdicts(docs: DataFrame, share: float = 0.5, cutoff: float = 40.0, prior: float = 100.0) -> DataFrame:
    """Statistics, base_failed, d2 (scaled squared distance, null only where base rules fail)
    and kept, a row per document."""
    stats = written(text_statistics(docs.select("doc_id", "lang", "source", "text")).drop("text")
                    .withColumn("base_failed", base_failed())
                    .select("*", *[x.alias(f"x{i}") for i, x in enumerate(vector())]), "quality-statistics")
    est = group_estimates(stats.where("not base_failed"), prior, share, cutoff)
    est = factor(est).select(F.col("lang").alias("_lang"), F.col("source").alias("_source"), *[f"m{i}" for i in range(P)],
                             *[f"l{i}{j}" for i, j in PAIRS], "scale")
    d = stats.join(est, [F.col(g).eqNullSafe(F.col(f"_{g}")) for g in ("lang", "source")], "left")
    for i in range(P):
        y = (F.col(f"x{i}") - F.col(f"m{i}")) - sum((F.col(f"l{i}{k}") * F.col(f"y{k}") for k in range(i)), F.lit(0.0))
        d = d.withColumn(f"y{i}", y / F.col(f"l{i}{i}"))
    d2 = sum((F.col(f"y{i}") * F.col(f"y{i}") for i in range(P)), F.lit(0.0)) / F.col("scale")
    d = d.withColumn("d2", F.when(~F.col("base_failed"), d2))
    return d.withColumn("kept", ~F.col("base_failed") & F.coalesce(F.col("d2") <= cutoff, F.lit(False))).select(
        *[c for c in stats.columns if c not in {f"x{i}" for i in range(P)}], "d2", "kept")


def op5_outliers(spark, sf_dir):
    return verdicts(documents(spark, sf_dir)).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "d2")
