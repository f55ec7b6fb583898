"""Quality rules: base limits, then robust multivariate outliers.

Each document becomes a vector of five transformed statistics: log of its
words, log mean word length, and the square roots of its shares of symbols,
repeated lines and repeated 8-word windows (shares and mean are smoothed by
constants, as short texts scatter more).  Per language and source the centre
and scatter of the vectors are estimated by the minimum covariance
determinant (MCD): of all subsets of 75 % of the rows the one whose covariance
has the least determinant.  Concentration steps go from three deterministic
starts (all rows; medians with median deviations; the same with tanh-limited
correlations) and the best start of a cell stays.  Two reweighting steps then
take every row within the cut, and a document farther than the cut from its
cell's centre (squared Mahalanobis distance) is rejected.

All of it is DataFrame functions.  A step is one pass over the written table of
vectors: rows are summed per cell, start and distance bin (16 to a doubling),
which gives the 75 % nearest rows with the last bin in part, so no cell is
ever sorted or gathered.  A cell may hold any share of all rows: joins with its
parameters are salted, and sums are combined before the shuffle, at most some
hundred rows per cell and start from a task.

Cells below ``min_rows`` rows are pooled by language, and pools still below
that over all languages; where that pool is too small as well, only the base
limits decide.  ``FLOORS`` are the least standard deviations of the five
statistics: most texts have no symbol or repeat at all.

Defined results: null and empty texts have no words and fail the base limits;
null language or source is a cell of its own; repeated rows count each time;
very long texts are read whole; an empty table gives no rows; extra columns are
not read.  Windows are compared by 64-bit hashes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tapflow.llm.common import drop_written, written

SPACE = " \t\n\x0b\x0c\r"
SPACES, NO_SPACE, SYMBOLS = r"[\x20\x09-\x0D]+", r"[^\x20\x09-\x0D]", r"[#*$%&|<>]+"
WINDOW = 8
MIN_WORDS, MAX_REPEAT_PERCENT = 20, 30
DIMS = 5
SMOOTH_WORDS, WORD_LENGTH, SMOOTH_LINES = 100, 5, 10
FLOORS = (0.25, 0.02, 0.05, 0.1, 0.1)
MIN_ROWS = 100
SUBSET = 0.75
#: Spread of a normal plane over that of its central 75 %.
CONSISTENCY = 1.86
#: Squared distance that one of 100,000 normal vectors of five exceeds.
CUT = 30.86
BINS = 16                     # distance bins to a doubling
GRID = 1 / 64                 # grid of the medians
MAX_STEPS, CONVERGED = 30, 1e-3
SALTS = 16                    # parts of a cell in joins with its parameters

X = [f"x{i}" for i in range(DIMS)]
PAIRS = [(i, j) for i in range(DIMS) for j in range(i + 1)]
COLUMNS = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]


def _repeated(rows: DataFrame) -> DataFrame:
    """``n_repeat_words`` from ``words``: equal hashes of windows are found by
    sorting, for texts that have any, and their words counted once."""
    rows = rows.withColumn("hashes", F.transform("words", lambda w: F.xxhash64(w)))
    at = F.transform(F.sequence(F.lit(0), F.size("words") - WINDOW),
                     lambda i: F.xxhash64(*[F.get("hashes", i + k) for k in range(WINDOW)]))
    rows = rows.withColumn("windows", F.when(F.size("words") >= WINDOW, at).otherwise(F.array().cast("array<bigint>")))
    twice = F.size("windows") > F.size(F.array_distinct("windows"))
    rows = rows.withColumn("lined", F.when(twice, F.sort_array(F.transform("windows", lambda h, i: F.struct(
        h.alias("h"), i.alias("i"))))))
    found = F.transform("lined", lambda x, k: F.when(
        (x["h"] == F.get("lined", k - 1)["h"]) | (x["h"] == F.get("lined", k + 1)["h"]), x["i"]))
    rows = rows.withColumn("starts", F.sort_array(F.filter(found, lambda i: i.isNotNull())))
    covered = F.transform("starts", lambda p, k: F.least(F.lit(WINDOW), F.coalesce(F.get("starts", k + 1) - p, F.lit(WINDOW))))
    count = F.aggregate(covered, F.lit(0).cast("long"), lambda acc, n: acc + n)
    return rows.withColumn("n_repeat_words", F.coalesce(count, F.lit(0).cast("long")))


def text_statistics(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """doc_id, lang, source, the counts of each text and ``base_failed``."""
    rows = docs.select(F.col("doc_id"), F.col("lang").cast("string").alias("lang"), F.col("source").cast("string").alias("source"),
                       F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    rows = rows.withColumn("bare", F.btrim("text", F.lit(SPACE)))
    rows = rows.withColumn("words", F.when(F.col("bare") == "", F.array().cast("array<string>"))
                           .otherwise(F.split("bare", SPACES)))
    rows = rows.withColumn("lines", F.filter(F.split("text", "\n"), lambda x: x.rlike(NO_SPACE)))
    rows = rows.withColumns({
        "n_words": F.size("words").cast("long"),
        "word_chars": F.length(F.array_join("words", "")).cast("long"),
        "n_symbols": (F.length("text") - F.length(F.regexp_replace("text", SYMBOLS, ""))).cast("long"),
        "n_lines": F.size("lines").cast("long"),
        "n_dup_lines": (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long")}).drop("text", "bare", "lines")
    rows = _repeated(rows)
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    return rows.withColumn("base_failed", failed).select(*COLUMNS, "n_lines", "lang", "source")


def vectors(stats: DataFrame) -> dict[str, Column]:
    words = F.col("n_words") + SMOOTH_WORDS
    return dict(zip(X, (
        F.log1p("n_words"),
        F.log((F.col("word_chars") + WORD_LENGTH * SMOOTH_WORDS) / words),
        F.sqrt(F.col("n_symbols") / (F.col("word_chars") + WORD_LENGTH * SMOOTH_WORDS)),
        F.sqrt(F.col("n_dup_lines") / (F.col("n_lines") + SMOOTH_LINES)),
        F.sqrt(F.col("n_repeat_words") / words))))


def with_cells(rows: DataFrame, min_rows: int) -> DataFrame:
    """``cell`` per language and source; small ones pooled, null if too small.
    ``salt`` cuts a cell into parts."""
    rows = rows.withColumn("salt", F.pmod(F.monotonically_increasing_id(), F.lit(SALTS)).cast("int"))
    counts = written(rows.groupBy("lang", "source").agg(F.count(F.lit(1)).alias("n")), "rules-counts")
    small = F.col("n") < min_rows
    pools = counts.where(small).groupBy(F.col("lang").alias("_lang")).agg(F.sum("n").alias("pool"))
    named = counts.join(pools, counts["lang"].eqNullSafe(pools["_lang"]), "left").drop("_lang")
    level = F.when(~small, 2).when(F.col("pool") >= min_rows, 1).otherwise(0)
    named = named.withColumn("level", level)
    # pools by language keep the language, the last pool neither
    named = named.withColumns({"a": F.when(F.col("level") > 0, F.col("lang")), "b": F.when(F.col("level") > 1, F.col("source"))})
    keys = ["level", "a", "b"]
    sizes = written(named.groupBy(*keys).agg(F.sum("n").alias("size")).where(F.col("size") >= min_rows)
                    .withColumn("cell", F.monotonically_increasing_id()), "rules-cells")
    same = named["level"] == sizes["level"]
    for k in ("a", "b"):
        same = same & named[k].eqNullSafe(sizes[k])
    cells = salted(named.join(sizes, same, "left").select(F.col("lang").alias("_l"), F.col("source").alias("_s"), "cell"), "_salt")
    found = rows["lang"].eqNullSafe(cells["_l"]) & rows["source"].eqNullSafe(cells["_s"]) & (rows["salt"] == cells["_salt"])
    return rows.join(cells, found).drop("_l", "_s", "_salt")


def salted(params: DataFrame, name: str = "salt") -> DataFrame:
    """``params`` once for each part of a cell."""
    return params.withColumn(name, F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))


def _s(i, j):
    return f"s{max(i, j)}{min(i, j)}"


def factored(params: DataFrame) -> DataFrame:
    """Cholesky factors l.. of the floored scatter, and log determinant."""
    for j in range(DIMS):
        own = F.col(_s(j, j)) + FLOORS[j] ** 2
        for k in range(j):
            own = own - F.col(f"l{j}{k}") * F.col(f"l{j}{k}")
        params = params.withColumn(f"l{j}{j}", F.sqrt(F.greatest(own, F.lit(1e-12))))
        below = {}
        for i in range(j + 1, DIMS):
            rest = F.col(_s(i, j))
            for k in range(j):
                rest = rest - F.col(f"l{i}{k}") * F.col(f"l{j}{k}")
            below[f"l{i}{j}"] = rest / F.col(f"l{j}{j}")
        if below:
            params = params.withColumns(below)
    log_det = 2 * sum((F.log(f"l{j}{j}") for j in range(1, DIMS)), F.log("l00"))
    return params.withColumn("log_det", log_det)


def with_distance(rows: DataFrame, params: DataFrame, how: str = "inner") -> DataFrame:
    """``d2`` of each row under its cell's factored parameters (one row per
    start of the cell)."""
    facts = [f"l{i}{j}" for i, j in PAIRS] + [f"m{i}" for i in range(DIMS)]
    starts = ["start"] if "start" in params.columns else []
    joined = rows.join(salted(params.select("cell", *starts, *facts)), ["cell", "salt"], how)
    for i in range(DIMS):
        z = F.col(f"x{i}") - F.col(f"m{i}")
        for k in range(i):
            z = z - F.col(f"l{i}{k}") * F.col(f"z{k}")
        joined = joined.withColumn(f"z{i}", z / F.col(f"l{i}{i}"))
    d2 = sum((F.col(f"z{i}") * F.col(f"z{i}") for i in range(1, DIMS)), F.col("z0") * F.col("z0"))
    return joined.withColumn("d2", d2).drop(*facts, *[f"z{i}" for i in range(DIMS)])


def _sums(weight: Column | None = None) -> list[Column]:
    one = F.lit(1.0) if weight is None else weight
    return ([F.sum(one).alias("n")] + [F.sum(one * F.col(x)).alias(f"t{i}") for i, x in enumerate(X)]
            + [F.sum(one * F.col(f"x{i}") * F.col(f"x{j}")).alias(f"q{i}{j}") for i, j in PAIRS])


def _moments(sums: DataFrame, keys: list[str], scale: float = 1.0) -> DataFrame:
    """Means m. and scatter s.. from sums; rounded, as the order of summing
    must not decide."""
    mean = [F.col(f"t{i}") / F.col("n") for i in range(DIMS)]
    return sums.select(*keys, *[F.round(m, 9).alias(f"m{i}") for i, m in enumerate(mean)],
                       *[F.round(scale * (F.col(f"q{i}{j}") / F.col("n") - mean[i] * mean[j]), 9).alias(_s(i, j)) for i, j in PAIRS])


def _medians(rows: DataFrame, values: list[Column]) -> DataFrame:
    """(cell, k, median) of each value, on a grid: counts per bin."""
    long = rows.select("cell", F.posexplode(F.array(*[F.round(v / GRID).cast("int") for v in values])).alias("k", "bin"))
    bins = long.groupBy("cell", "k", "bin").agg(F.count(F.lit(1)).alias("n"))
    w = Window.partitionBy("cell", "k")
    upto = w.orderBy("bin").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    bins = bins.select("cell", "k", "bin", F.sum("n").over(upto).alias("upto"), F.sum("n").over(w).alias("all"))
    return bins.where(2 * F.col("upto") >= F.col("all")).groupBy("cell", "k").agg((F.min("bin") * GRID).alias("median"))


def _wide(medians: DataFrame, prefix: str) -> DataFrame:
    return medians.groupBy("cell").agg(*[F.max(F.when(F.col("k") == i, F.col("median"))).alias(f"{prefix}{i}") for i in range(DIMS)])


def starts(rows: DataFrame) -> DataFrame:
    """Three first estimates per cell: (cell, start, m.., s..)."""
    whole = _moments(rows.groupBy("cell").agg(*_sums()), ["cell"]).withColumn("start", F.lit(0))
    centre = written(_wide(_medians(rows, [F.col(x) for x in X]), "m"), "rules-medians")
    spread = _wide(_medians(rows.join(salted(centre), ["cell", "salt"]), [F.abs(F.col(f"x{i}") - F.col(f"m{i}")) for i in range(DIMS)]), "v")
    centre = written(centre.join(spread, "cell").select(
        "cell", *[f"m{i}" for i in range(DIMS)],
        *[F.greatest(1.4826 * F.col(f"v{i}"), F.lit(FLOORS[i])).alias(f"v{i}") for i in range(DIMS)]), "rules-centres")
    plain = centre.select("cell", *[f"m{i}" for i in range(DIMS)], F.lit(1).alias("start"),
                          *[(F.col(f"v{i}") * F.col(f"v{j}") if i == j else F.lit(0.0)).alias(_s(i, j)) for i, j in PAIRS])
    limited = rows.join(salted(centre), ["cell", "salt"]).select("cell", *[F.tanh((F.col(f"x{i}") - F.col(f"m{i}")) / F.col(f"v{i}")).alias(f"x{i}")
                                                         for i in range(DIMS)])
    bent = limited.groupBy("cell").agg(*_sums())
    bent = _moments(bent, ["cell"]).drop(*[f"m{i}" for i in range(DIMS)]).join(centre, "cell")
    # correlations of the limited values, on the scale of the median deviations
    both = [F.col(f"v{i}") * F.col(f"v{j}") * (F.lit(1.0) if i == j else F.coalesce(F.try_divide(
        F.col(_s(i, j)), F.sqrt(F.col(_s(i, i)) * F.col(_s(j, j)))), F.lit(0.0))) for i, j in PAIRS]
    bent = bent.select("cell", *[f"m{i}" for i in range(DIMS)], F.lit(2).alias("start"),
                       *[c.alias(_s(i, j)) for c, (i, j) in zip(both, PAIRS)])
    return whole.unionByName(plain).unionByName(bent)


def concentrate(rows: DataFrame, params: DataFrame) -> DataFrame:
    """Moments of the 75 % of each cell's rows nearest under each start."""
    bin_of = F.floor(F.log2(F.col("d2") + 1e-9) * BINS).cast("int")
    keys = ["cell", "start"]
    bins = with_distance(rows, params).groupBy(*keys, bin_of.alias("bin")).agg(*_sums())
    w = Window.partitionBy(*keys)
    upto = w.orderBy("bin").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    bins = bins.withColumns({"_all": F.sum("n").over(w), "_upto": F.sum("n").over(upto)})
    share = (SUBSET * F.col("_all") - (F.col("_upto") - F.col("n"))) / F.col("n")
    share = F.greatest(F.lit(0.0), F.least(F.lit(1.0), share))
    names = ["n"] + [f"t{i}" for i in range(DIMS)] + [f"q{i}{j}" for i, j in PAIRS]
    return _moments(bins.groupBy(*keys).agg(*[F.sum(share * F.col(c)).alias(c) for c in names]), keys)


def mcd(rows: DataFrame) -> DataFrame:
    """Factored centre and scatter per cell.  ``rows``: cell, x0 to x4."""
    params = written(factored(starts(rows)), "rules-start")
    for step in range(MAX_STEPS):
        closer = written(factored(concentrate(rows, params)), f"rules-step-{step}")
        gain = (params.select("cell", "start", F.col("log_det").alias("was")).join(closer, ["cell", "start"])
                .agg(F.max(F.abs(F.col("was") - F.col("log_det")))).first()[0])
        drop_written(params)
        params = closer
        if gain is None or gain < CONVERGED:
            break
    fields = [c for c in params.columns if c not in ("cell", "start", "log_det")]
    best = params.groupBy("cell").agg(F.min(F.struct("log_det", "start", *fields)).alias("b")).select("cell", *[f"b.{c}" for c in fields])
    scatter = {_s(i, j): F.col(_s(i, j)) * CONSISTENCY for i, j in PAIRS}
    best = written(factored(best.select("cell", *[f"m{i}" for i in range(DIMS)], *[c.alias(k) for k, c in scatter.items()])), "rules-raw")
    for step in range(2):
        inside = with_distance(rows, best).where(F.col("d2") <= CUT)
        best = written(factored(_moments(inside.groupBy("cell").agg(*_sums()), ["cell"])), f"rules-weighted-{step}")
    return best


def apply_rules(docs: DataFrame, text_col: str = "text", min_rows: int = MIN_ROWS, cut: float = CUT) -> DataFrame:
    """A row per document: the counts, base_failed, kept and distance (null
    where no cell is large enough)."""
    rows = written(text_statistics(docs, text_col), "rules-statistics")
    rows = written(with_cells(rows.withColumns(vectors(rows)), min_rows).drop("lang", "source", "n_lines"), "rules-vectors")
    judged = rows.where("cell is not null").select("cell", "salt", *X)
    out = with_distance(rows, mcd(judged), "left")
    kept = ~F.col("base_failed") & F.coalesce(F.col("d2") <= cut, F.lit(True))
    return out.select(*COLUMNS, kept.alias("kept"), F.sqrt("d2").alias("distance"))

