"""Quality rules: base rules, then robust multivariate outliers per language and source.

``text_statistics`` counts over every whole text; ``fit`` estimates, for each group, the centre
and scatter of a vector of transformed statistics by the minimum covariance determinant: among
the halves of a group, one whose covariance matrix has a small determinant.  Two starting
halves (nearest the coordinatewise medians, by two norms) are improved by concentration steps
(estimate, keep the nearest half, estimate again), and the one with the smaller determinant
wins.  A vector whose squared Mahalanobis distance exceeds ``CUTOFF`` is rejected.

Halves are cut at bins of the logarithm of the distance, whose counts add up in any order: the
estimates don't depend on partitions, and a group that holds a third of all rows is a few
hundred counts per task.  Every pass after the first reads the vectors only, not the texts.

Each feature has a floor on its scale: a scatter matrix gets the squared floors on its
diagonal, so that features which are constant in clean text neither make it singular nor make
a trace of them an outlier.

Groups below ``MIN_GROUP`` vectors are pooled: by language, then all together; if even those are
few, nothing is rejected by distance.  Null languages and sources are groups of their own.
A null or empty text has no words and fails the base rule.  Repeated rows are judged alike.

n_repeat_words compares 64-bit hashes of 8-word windows within one text.

Native: DataFrame functions only.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import Scratch, let, named, others, packed, table, words_of

MIN_WORDS = 20
REPEAT_PERCENT = 30
MIN_GROUP = 50
HALF = 0.5
STEPS = 3
CUTOFF = 30.0                   # chi-squared with four degrees of freedom exceeds it once in 200,000
MEDIAN_CHI2 = 3.357             # its median with four degrees of freedom
BINS = 64                       # bins of the distance for each power of e
#: Feature and floor of its scale.
FLOORS = {"word_length": 0.08, "symbol_rate": 0.04, "dup_line_rate": 0.15, "repeat_rate": 0.15}
BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
N = len(FLOORS)


def _window_hashes(words: Column) -> Column:
    """Hash of every 8-word window, by joining hashes of 1, 2 and 4 words."""
    def joined(h: Column, width: int) -> Column:
        def pairs(x: Column) -> Column:
            n = F.greatest(F.size(x) - width, F.lit(0))
            return F.zip_with(F.slice(x, 1, n), F.slice(x, width + 1, n), lambda a, b: F.xxhash64(a, b))
        return let(h, pairs)

    h = F.transform(words, lambda w: F.xxhash64(w))
    for width in (1, 2, 4):
        h = joined(h, width)
    return h


def _covered(h: Column) -> Column:
    """Words inside windows whose hash occurs twice or more: eight for the last such window, and
    for every other the distance to the next one, eight at most."""
    def starts(s: Column) -> Column:
        def again(x: Column, i: Column) -> Column:
            return (x["h"] == F.get(s, i - 1)["h"]) | (x["h"] == F.get(s, i + 1)["h"])
        return F.array_sort(F.transform(F.filter(s, lambda x, i: F.coalesce(again(x, i), F.lit(False))), lambda x: x["i"]))

    def total(p: Column) -> Column:
        steps = F.zip_with(F.slice(p, 1, F.size(p) - 1), F.slice(p, 2, F.size(p) - 1), lambda a, b: F.least(b - a, F.lit(8)))
        return F.when(F.size(p) == 0, F.lit(0)).otherwise(F.aggregate(steps, F.lit(8), lambda n, d: n + d))

    ordered = F.array_sort(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
    return let(let(ordered, starts), total)


def text_statistics(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with the base statistics, the features and ``base_failed`` (old columns of these names go)."""
    working = ["mcd_words", "mcd_windows", "mcd_lines"]
    docs = docs.select(*(named(c) for c in others(docs, [*BASE, *FLOORS, "base_failed", *working])))
    t = F.coalesce(F.col(text), F.lit(""))
    lines = F.filter(F.split(t, "\n", -1), lambda x: F.regexp_like(x, F.lit(r"[^\x20\x09-\x0D]")))
    out = docs.withColumns({
        "mcd_words": words_of(F.col(text)), "mcd_lines": lines,
        "word_chars": (F.char_length(t) - F.regexp_count(t, F.lit(r"[\x20\x09-\x0D]"))).cast("long"),
        "n_symbols": F.regexp_count(t, F.lit(r"[#*$%&|<>]")).cast("long")})
    out = out.withColumns({
        "n_words": F.size("mcd_words").cast("long"), "mcd_windows": _window_hashes(F.col("mcd_words")),
        "n_dup_lines": (F.size("mcd_lines") - F.size(F.array_distinct("mcd_lines"))).cast("long"),
        "mcd_lines": F.size("mcd_lines")}).drop("mcd_words")
    out = out.withColumn("n_repeat_words", F.when(F.size(F.array_distinct("mcd_windows")) == F.size("mcd_windows"), F.lit(0))
                         .otherwise(_covered(F.col("mcd_windows"))).cast("long")).drop("mcd_windows")
    c = F.col
    return out.withColumns({
        "word_length": F.log((c("word_chars") + 1) / (c("n_words") + 1)),
        "symbol_rate": F.sqrt(c("n_symbols") / (c("word_chars") + 1)),
        "dup_line_rate": F.sqrt(c("n_dup_lines") / (c("mcd_lines") + 1)),
        "repeat_rate": F.sqrt(c("n_repeat_words") / (c("n_words") + 1)),
        "base_failed": (c("n_words") < MIN_WORDS) | (c("n_repeat_words") * 100 > c("n_words") * REPEAT_PERCENT),
    }).drop("mcd_lines")


@dataclass
class Model:
    """``groups``: k1, k2 (language and source) to the group g they are judged in;
    ``estimates``: g, centre m0.., Cholesky factor l00.. and ``scale`` of the squared distance."""
    groups: DataFrame
    estimates: DataFrame


def _keys(lang: str, source: str) -> list[Column]:
    """Null-safe text of the group columns."""
    return [F.coalesce(F.concat(F.lit("="), F.col(c).cast("string")), F.lit("")).alias(k)
            for c, k in ((lang, "k1"), (source, "k2"))]


def _groups(rows: DataFrame) -> DataFrame:
    """k1, k2, g: the pair itself, its language's small pairs together, or all the small rest."""
    own = rows.groupBy("k1", "k2").agg(F.count(F.lit(1)).alias("n"))
    small = own.where(F.col("n") < MIN_GROUP)
    by_lang = small.groupBy("k1").agg(F.sum("n").alias("n1"))
    rest = by_lang.where(F.col("n1") < MIN_GROUP).agg(F.sum("n1").alias("n2"))
    return own.join(by_lang, "k1", "left").join(F.broadcast(rest), F.lit(True), "left").select(
        "k1", "k2",
        F.when(F.col("n") >= MIN_GROUP, F.concat(F.lit("pair"), F.char_length("k1"), F.lit(" "), "k1", "k2"))
        .when(F.col("n1") >= MIN_GROUP, F.concat(F.lit("lang"), "k1"))
        .when(F.col("n2") >= MIN_GROUP, F.lit("all")).alias("g")).where("g is not null")


def _quantile_bins(binned: DataFrame, by: list[str], share: float) -> DataFrame:
    """The first bin, per ``by``, at which the cumulative share of rows reaches ``share``."""
    counts = binned.groupBy(*by, "bin").agg(F.count(F.lit(1)).alias("n"))
    w = Window.partitionBy(*by)
    up = F.sum("n").over(w.orderBy("bin").rowsBetween(Window.unboundedPreceding, 0))
    return counts.select(*by, "bin", up.alias("up"), F.sum("n").over(w).alias("all")) \
        .where(F.col("up") >= F.col("all") * share).groupBy(*by).agg(F.min("bin").alias("cut"))


def _distance_bin(d: Column) -> Column:
    return F.floor(F.log(d + 1e-6) * BINS).cast("int")


def _medians(vectors: DataFrame, scratch: Scratch) -> DataFrame:
    """g, m0.. (medians), s0.. (robust scales), from bins of an eighth of each floor."""
    floors = list(FLOORS.values())
    width = F.element_at(F.array(*(F.lit(f / 8) for f in floors)), F.col("j") + 1)
    melted = vectors.select("g", F.posexplode(F.array(*FLOORS)).alias("j", "x"))
    mid = (F.col("cut") + 0.5) * width
    med = _quantile_bins(melted.withColumn("bin", F.floor(F.col("x") / width)), ["g", "j"], 0.5) \
        .select("g", "j", mid.alias("med"))
    med = scratch.write(med, "medians")
    off = melted.join(med, ["g", "j"]).withColumn("bin", F.floor(F.abs(F.col("x") - F.col("med")) / width))
    mad = _quantile_bins(off, ["g", "j"], 0.5).select("g", "j", (1.4826 * mid).alias("mad"))
    both = med.join(mad, ["g", "j"])
    pick = lambda c, j: F.max(F.when(F.col("j") == j, F.col(c)))
    return scratch.write(both.groupBy("g").agg(
        *(pick("med", j).alias(f"m{j}") for j in range(N)),
        *(F.greatest(pick("mad", j), F.lit(floors[j])).alias(f"s{j}") for j in range(N))), "starts")


def _moments(rows: DataFrame) -> DataFrame:
    """start, g, m0.., l00..: mean and Cholesky factor of the floored covariance of the rows."""
    x, floors = list(FLOORS), list(FLOORS.values())
    out = rows.groupBy("start", "g").agg(
        *(F.avg(c).alias(f"m{j}") for j, c in enumerate(x)),
        *(F.coalesce(F.covar_samp(x[i], x[j]), F.lit(0.0)).alias(f"c{i}{j}") for i in range(N) for j in range(i + 1)))
    for i in range(N):                                      # Cholesky-Banachiewicz, row by row
        for j in range(i + 1):
            rest = F.col(f"c{i}{j}") + (floors[i] ** 2 if i == j else 0.0)
            for k in range(j):
                rest = rest - F.col(f"l{i}{k}") * F.col(f"l{j}{k}")
            out = out.withColumn(f"l{i}{j}", F.sqrt(rest) if i == j else rest / F.col(f"l{j}{j}"))
    return out.drop(*(f"c{i}{j}" for i in range(N) for j in range(i + 1)))


def _distance(rows: DataFrame, name: str) -> DataFrame:
    """Squared Mahalanobis distance from the joined m and l columns, by forward substitution."""
    for i, c in enumerate(FLOORS):
        y = F.col(c) - F.col(f"m{i}")
        for k in range(i):
            y = y - F.col(f"l{i}{k}") * F.col(f"mcd_y{k}")
        rows = rows.withColumn(f"mcd_y{i}", y / F.col(f"l{i}{i}"))
    total = sum((F.col(f"mcd_y{i}") * F.col(f"mcd_y{i}") for i in range(1, N)), F.col("mcd_y0") * F.col("mcd_y0"))
    return rows.withColumn(name, total).drop(*(f"mcd_y{i}" for i in range(N)))


def fit(stats: DataFrame, lang: str = "lang", source: str = "source", scratch: Scratch | None = None) -> Model:
    """Estimates from the rows of ``text_statistics`` that pass the base rule."""
    scratch = scratch or Scratch(stats.sparkSession, "mcd")
    valid = stats.where(~F.col("base_failed")).select(*_keys(lang, source), *FLOORS)
    groups = scratch.write(_groups(valid), "groups")
    vectors = scratch.write(valid.join(groups, ["k1", "k2"]).select("g", *FLOORS), "vectors")

    near = vectors.join(_medians(vectors, scratch), "g")
    z = [(F.col(c) - F.col(f"m{j}")) / F.col(f"s{j}") for j, c in enumerate(FLOORS)]
    norms = F.array(sum((v * v for v in z[1:]), z[0] * z[0]), F.greatest(*(v * v for v in z)))
    rows = near.select("g", *FLOORS, F.posexplode(norms).alias("start", "d"))
    estimates = None
    for step in range(STEPS + 1):
        if step:
            rows = _distance(vectors.join(estimates, "g"), "d")
        rows = rows.withColumn("bin", _distance_bin(F.col("d"))).select("start", "g", "bin", *FLOORS)
        cut = scratch.write(_quantile_bins(rows, ["start", "g"], HALF), f"cut{step}")
        estimates = scratch.write(_moments(rows.join(cut, ["start", "g"]).where("bin <= cut")), f"estimates{step}")

    volume = sum((F.log(F.col(f"l{i}{i}")) for i in range(1, N)), F.log(F.col("l00")))
    best = estimates.groupBy("g").agg(F.min_by("start", F.struct(volume, "start")).alias("start"))
    estimates = scratch.write(estimates.join(best, ["g", "start"]), "best")
    d = _distance(vectors.join(estimates, "g"), "d").withColumn("bin", _distance_bin(F.col("d")))
    median = _quantile_bins(d, ["g"], 0.5).select("g", F.exp((F.col("cut") + 0.5) / BINS).alias("median"))
    scaled = estimates.join(median, "g").withColumn("scale", F.greatest(F.lit(1.0), F.col("median") / MEDIAN_CHI2))
    scaled = scratch.write(scaled.drop("start", "median"), "model")
    scratch.drop("vectors", "medians", "starts", "best", *(f"{n}{s}" for n in ("cut", "estimates") for s in range(STEPS + 1)))
    return Model(groups, scaled)


def judge(stats: DataFrame, model: Model, lang: str = "lang", source: str = "source", cutoff: float = CUTOFF) -> DataFrame:
    """``stats`` with ``outlyingness`` (scaled squared distance, null without an estimate) and ``kept``.

    The model is joined by language and source: Spark ships it while its stored size is below
    the session's broadcast limit and shuffles by its keys beyond it."""
    rows = packed(stats, others(stats, ("outlyingness", "kept")), base_failed="base_failed", **{lang: lang, source: source},
                  **{f: f for f in FLOORS})
    k1, k2 = _keys(lang, source)
    model_rows = model.groups.join(model.estimates, "g")
    rows = _distance(rows.withColumns({"k1": k1, "k2": k2}).join(model_rows, ["k1", "k2"], "left"), "mcd_d")
    out = rows.withColumn("outlyingness", F.col("mcd_d") / F.col("scale"))
    kept = ~F.col("base_failed") & F.coalesce(F.col("outlyingness") <= cutoff, F.lit(True))
    return out.select("row", "outlyingness", kept.alias("kept")).select("row.*", "outlyingness", "kept")


def keep_quality(docs: DataFrame, lang: str = "lang", source: str = "source", text: str = "text") -> DataFrame:
    """The documents that pass both the base rule and the distance rule, unchanged.

    The fit reads the texts once; the verdict counts again beside each text, which costs less
    than to shuffle the texts to stored counts."""
    rows = packed(docs, text=text, lang=lang, source=source)
    scratch = Scratch(docs.sparkSession, "mcd")
    stats = scratch.write(text_statistics(rows.drop("row")).drop("text"), "stats")
    model = fit(stats, scratch=scratch)
    scratch.drop("stats")
    judged = judge(text_statistics(rows).drop("text").withColumnRenamed("row", "document"), model)
    return judged.where("kept").select("document.*")


def op4_mcd_outliers(spark, sf_dir: str) -> DataFrame:
    """Base statistics and verdict of every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    scratch = Scratch(spark, "mcd")
    stats = scratch.write(text_statistics(docs).drop("text"), "stats")
    return judge(stats, fit(stats, scratch=scratch)).select("doc_id", *BASE, "base_failed", "kept", "outlyingness")
