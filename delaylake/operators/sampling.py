"""Sampling and splits that do not depend on partitioning.

Each row gets a stable hash of its key and a seed (md5, which DuckDB computes
identically). A fraction sample or an 80/20 split is then a per-row filter: no
shuffle at all. Taking *exactly n* rows (balanced sample, stratified split)
is "the n smallest hashes per group", computed without a global sort:

1. histogram of the top 20 hash bits per group (map-side partial aggregate;
   at most 2^20 rows per group regardless of data size),
2. running counts over that histogram give, per group, the buckets taken
   whole and the one boundary bucket with how many rows it still needs,
3. only the boundary bucket is ranked, as distinct rows with multiplicities
   (copies collapse map-side), everything else is a filter.

``df.sample`` / ``randomSplit`` are offered as the fast non-reproducible form.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from delaylake.functions import columns as C
from delaylake.functions import constants as K
from delaylake.operators.joins import sized
from delaylake.session import materialize

BUCKET_HEX = 5           # 20 bits of md5 for the histogram
FINE_HEX = 15            # 60 bits for the order inside a bucket


def with_hash(df: DataFrame, keys: Sequence[str], seed: int = K.SEED) -> DataFrame:
    m = F.md5(C.hash_key(list(keys), seed))
    return (df.withColumn("__b", F.conv(F.substring(m, 1, BUCKET_HEX), 16, 10).cast("int"))
              .withColumn("__h", F.conv(F.substring(m, 1, FINE_HEX), 16, 10).cast("bigint")))


def sample_fraction(df: DataFrame, frac: float, keys: Sequence[str], seed: int = K.SEED,
                    exact_random: bool = False) -> DataFrame:
    """About ``frac`` of the rows, the same rows on every run and cluster size."""
    if exact_random:
        return df.sample(fraction=frac, seed=seed)
    return df.where(C.md5_bucket(C.hash_key(list(keys), seed)) < int(round(frac * 10000)))


def in_train(keys: Sequence[str], frac: float = 0.8, seed: int = K.SEED) -> F.Column:
    """Whether a row is on the training side: a function of its key alone."""
    return C.md5_bucket(C.hash_key(list(keys), seed)) < int(round(frac * 10000))


def split_train_test(df: DataFrame, keys: Sequence[str], frac: float = 0.8,
                     seed: int = K.SEED) -> tuple[DataFrame, DataFrame]:
    """(train, test) by hash bucket: a row's side never depends on partitioning."""
    side = in_train(keys, frac, seed)
    return df.where(side), df.where(~side)


def replicate(df: DataFrame, count_col: str, chunk: int = 1 << 20) -> DataFrame:
    """Each row repeated ``count_col`` times (rows with a count <= 0 vanish).

    A row standing for a huge group of copies is first cut into pieces of at
    most ``chunk`` copies, the pieces are spread round-robin, and each piece is
    expanded by its own task, so no task generates more than ``chunk`` copies.
    """
    pos = df.where(F.col(count_col) > 0)
    pieces = pos.withColumn(
        "__piece", F.explode(F.sequence(F.lit(0), F.floor((F.col(count_col) - 1) / chunk))))
    pieces = pieces.withColumn(
        "__len", F.least(F.lit(chunk), F.col(count_col) - F.col("__piece") * chunk))
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    out = pieces.repartition(n).withColumn("__copy", F.explode(F.sequence(F.lit(1), F.col("__len"))))
    return out.drop("__piece", "__len", "__copy")


def flag_first_n_by_hash(df: DataFrame | None, keys: Sequence[str], n_per_group: DataFrame,
                         groups: Sequence[str] = (), seed: int = K.SEED,
                         flag: str = "__take", hashed: DataFrame | None = None,
                         hist: DataFrame | None = None) -> DataFrame:
    """Add boolean ``flag``: the row's rank by (hash, keys, other columns)
    within its group is <= ``__n``.

    ``n_per_group`` has the group columns and ``__n`` (a small table: one row
    per group). Exact, no global sort, no group gathered in one task:

    * buckets below the cut are flagged by comparing a row's bucket with its group's cut (a row
      per group, broadcast): the rows are not exchanged;
    * the one boundary bucket per group is collapsed to distinct rows with
      their multiplicity (a map-side partial aggregate, so a group of copies
      holding a third of all rows becomes one row), ranked, and each distinct
      row is re-emitted as "taken" and "not taken" copies in parallel chunks.
      Copies are indistinguishable, so which of them are taken cannot matter.

    Columns must be groupable (no map columns). A caller that already has the
    hashed rows (``with_hash``) and their (groups, bucket) histogram passes
    them as ``hashed`` / ``hist`` so they are not computed twice.
    """
    g = list(groups)
    keys = list(keys)
    h = hashed if hashed is not None else with_hash(df, keys, seed)
    cols = [c for c in h.columns if c not in ("__b", "__h")]
    if hist is None:
        hist = h.groupBy(*g, "__b").agg(F.count(F.lit(1)).alias("__cnt"))
    w = (Window.partitionBy(*g).orderBy("__b")
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    hist = hist.withColumn("__cum", F.sum("__cnt").over(w))
    if g:
        hist = hist.join(n_per_group.select(*g, "__n"), g, "inner")
    else:
        hist = hist.crossJoin(F.broadcast(n_per_group.select("__n")))
    # Buckets are ordered, so a group's plan is one row: the last bucket taken whole, the
    # boundary bucket and how many of its rows are still needed.
    before, n = F.col("__cum") - F.col("__cnt"), F.col("__n")
    at_edge = (before < n) & (F.col("__cum") > n)
    cut = hist.groupBy(*g).agg(F.max(F.when(F.col("__cum") <= n, F.col("__b"))).alias("__whole"),
                               F.max(F.when(at_edge, F.col("__b"))).alias("__edge"),
                               F.max(F.when(at_edge, n - before)).alias("__need"))
    cut = materialize(cut, "hash-cuts")     # a row a group: broadcast, the rows stay where they are
    j = h.join(sized(cut), g, "left") if g else h.crossJoin(F.broadcast(cut))
    is_edge = F.coalesce(F.col("__b") == F.col("__edge"), F.lit(False))
    rest = j.where(~is_edge).select(*cols, F.coalesce(F.col("__b") <= F.col("__whole"), F.lit(False)).alias(flag))
    edge = j.where(is_edge)
    distinct = edge.groupBy(*cols, "__b", "__h", "__need").agg(F.count(F.lit(1)).alias("__m"))
    other = [c for c in cols if c not in keys and c not in g]
    wr = (Window.partitionBy(*g, "__b").orderBy("__h", *keys, *other)
          .rowsBetween(Window.unboundedPreceding, -1))
    distinct = distinct.withColumn("__before", F.coalesce(F.sum("__m").over(wr), F.lit(0)))
    taken = F.greatest(F.lit(0), F.least(F.col("__m"), F.col("__need") - F.col("__before")))
    distinct = distinct.withColumn("__t", taken).withColumn("__r", F.col("__m") - F.col("__t"))
    yes = replicate(distinct, "__t").select(*cols, F.lit(True).alias(flag))
    no = replicate(distinct, "__r").select(*cols, F.lit(False).alias(flag))
    return rest.unionByName(yes).unionByName(no)


def first_n_by_hash(df: DataFrame, keys: Sequence[str], n_per_group: DataFrame,
                    groups: Sequence[str] = (), seed: int = K.SEED) -> DataFrame:
    """Rows whose rank by (hash, keys) within their group is <= ``__n``."""
    f = flag_first_n_by_hash(df, keys, n_per_group, groups, seed)
    return f.where(F.col("__take")).drop("__take")


def balanced_sample(f: DataFrame, keys: Sequence[str], delay: str = "Arr_Delay",
                    threshold: int = K.DELAY_THRESHOLD_MIN, seed: int = K.SEED) -> DataFrame:
    """Regression training set: rows with a delay, clipped to [-30, 300]; all
    delayed rows plus min(n_delayed div 2, n_on_time) on-time rows (picked by
    hash), whose delay is clipped below at 0.

    One histogram by (delayed?, hash bucket) gives both class counts and the
    on-time bucket plan; one flagged pass then keeps every delayed row (its
    class has an unbounded quota) and the first n on-time rows.
    """
    d = f.where(F.col(delay).isNotNull()).withColumn(delay, C.clip(delay, *K.REG_TARGET_CLIP))
    # Written once: the histogram and the flagged rows read it, not the lineage.
    h = materialize(with_hash(d.withColumn("__late", F.col(delay) > threshold), keys, seed), "hashed")
    hist = materialize(h.groupBy("__late", "__b").agg(F.count(F.lit(1)).alias("__cnt")), "hash-histogram")
    counts = hist.agg(F.sum(F.when(F.col("__late"), F.col("__cnt")).otherwise(0)).alias("__nd"),
                      F.sum(F.when(~F.col("__late"), F.col("__cnt")).otherwise(0)).alias("__no"))
    n_on = F.least(F.floor(F.col("__nd") / 2), F.col("__no")).cast("long")
    quota = counts.select(F.explode(F.array(
        F.struct(F.lit(True).alias("__late"), F.lit(2 ** 62).cast("long").alias("__n")),
        F.struct(F.lit(False).alias("__late"), n_on.alias("__n")))).alias("__q")) \
        .select("__q.__late", "__q.__n")
    flagged = flag_first_n_by_hash(None, keys, quota, groups=["__late"], seed=seed,
                                   hashed=h, hist=hist)
    out = flagged.where(F.col("__take"))
    out = out.withColumn(delay, F.when(F.col("__late"), F.col(delay))
                                 .otherwise(C.clip(delay, lo=0)))
    return out.drop("__take", "__late")


def flag_stratified(df: DataFrame, label: str, keys: Sequence[str], frac: float = 0.8,
                    seed: int = K.SEED, flag: str = "is_train") -> DataFrame:
    """``df`` with a boolean ``flag``: per label, the floor(frac * n_label) rows
    with the smallest hash. The hashed rows are written once; their histogram
    also gives the label counts."""
    h = materialize(with_hash(df, keys, seed), "hashed")
    hist = materialize(h.groupBy(label, "__b").agg(F.count(F.lit(1)).alias("__cnt")), "hash-histogram")
    n = hist.groupBy(label).agg(F.floor(F.sum("__cnt") * F.lit(frac)).cast("long").alias("__n"))
    return flag_first_n_by_hash(None, keys, n, groups=[label], seed=seed, flag=flag, hashed=h, hist=hist)


def split_stratified(df: DataFrame, label: str, keys: Sequence[str], frac: float = 0.8,
                     seed: int = K.SEED) -> tuple[DataFrame, DataFrame]:
    """(train, test): both are filters over one written, flagged table."""
    flagged = materialize(flag_stratified(df, label, keys, frac, seed, "__take"), "stratified")
    return (flagged.where(F.col("__take")).drop("__take"),
            flagged.where(~F.col("__take")).drop("__take"))


def folded_counts(df: DataFrame, label: str, keys: Sequence[str], folds: int = 3,
                  seed: int = K.SEED) -> DataFrame:
    """Distinct rows with ``fold`` (0 to folds - 1) and ``n``, how many copies are in it.

    A row's fold is its rank by (hash, keys, other columns) within its label, modulo the
    number of folds, so the label counts of two folds differ by at most one. Ranks come from a
    histogram of hash buckets for each label; inside a bucket, distinct rows are ranked with
    their multiplicity, and a group of copies is dealt over the folds by arithmetic.
    """
    cols = df.columns
    one = with_hash(df.groupBy(*cols).agg(F.count(F.lit(1)).alias("__m")), keys, seed)
    one = materialize(one, "hashed")
    hist = one.groupBy(label, "__b").agg(F.sum("__m").alias("__cnt"))
    before = (Window.partitionBy(label).orderBy("__b").rowsBetween(Window.unboundedPreceding, -1))
    start = hist.select(F.col(label).alias("__l"), F.col("__b").alias("__lb"),
                        F.coalesce(F.sum("__cnt").over(before), F.lit(0)).alias("__start"))
    other = [c for c in cols if c not in keys and c != label]
    inside = (Window.partitionBy(label, "__b").orderBy("__h", *keys, *other)
              .rowsBetween(Window.unboundedPreceding, -1))
    ranked = (one.withColumn("__in", F.coalesce(F.sum("__m").over(inside), F.lit(0)))
              .join(start, F.col(label).eqNullSafe(F.col("__l")) & (F.col("__b") == F.col("__lb")))
              .withColumn("__r", F.col("__start") + F.col("__in")))
    ranked = ranked.withColumn("fold", F.explode(F.sequence(F.lit(0), F.lit(folds - 1))))
    upto = lambda end: F.floor((end - 1 - F.col("fold")) / folds)
    n = (upto(F.col("__r") + F.col("__m")) - upto(F.col("__r"))).cast("long")
    return ranked.select(*cols, "fold", n.alias("n")).where("n > 0")


def stratified_folds(df: DataFrame, label: str, keys: Sequence[str], folds: int = 3,
                     seed: int = K.SEED) -> DataFrame:
    """``df`` with ``fold``, stratified by label (see :func:`folded_counts`)."""
    return replicate(folded_counts(df, label, keys, folds, seed), "n").drop("n")


def union_parts(*dfs: DataFrame, allow_missing: bool = True) -> DataFrame:
    """Stack tables by column name; a column absent from one side is null."""
    out = dfs[0]
    for d in dfs[1:]:
        out = out.unionByName(d, allowMissingColumns=allow_missing)
    return out
