"""Registered queries: every operator over a table of cells made from `lineitem`, with SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions.naming import BARCODE, BATCH, CONTROL, LABEL, add_control
from .functions.special import ERFC
from .functions.variant import classify_variant, untagged_synonymous
from .functions.vectors import cosine_distance, impact_score, norm, query_dot
from .operators import comparisons, models, qc, sampling, selection
from .operators.aggregate import aggregate
from .operators.batchcorrect import BatchCorrector
from .operators.embedding import pca
from .operators.normalize import Normalizer

FEATURES = ["Cells_Quantity", "Cells_Price", "Nuclei_Discount", "Nuclei_Tax"]
IDS = ["l_orderkey", "l_linenumber", "l_partkey"]
CELLS = """SELECT l_orderkey, l_linenumber, l_partkey, CASE WHEN l_suppkey % 13 < 3 THEN 'WT' WHEN l_suppkey % 13 < 6 THEN concat('A', CAST(l_suppkey % 13 AS STRING), 'A')
 WHEN l_suppkey % 13 < 10 THEN concat('M', CAST(l_suppkey % 13 AS STRING), 'K') WHEN l_suppkey % 13 = 10 THEN 'A10fs' WHEN l_suppkey % 13 = 11 THEN 'A11X' ELSE 'A12-' END AS meta_aa_changes,
 concat('BC', CAST(l_suppkey AS STRING)) AS meta_barcode, concat('b', CAST(year(l_shipdate) AS STRING)) AS meta_batch, l_linenumber - 1 AS meta_edit_distance,
 l_quantity AS Cells_Quantity, l_extendedprice AS Cells_Price, l_discount AS Nuclei_Discount, l_tax AS Nuclei_Tax FROM lineitem"""
WITH = f"WITH cells AS ({CELLS})"
#: The same classes as classify_variant, for labels of this table.
CLASS = """CASE WHEN contains(L, 'fs') THEN 'Frameshift' WHEN L LIKE '%-' THEN '3nt Deletion' WHEN contains(L, 'X') OR contains(L, '*') THEN 'Nonsense' WHEN contains(L, 'WT') THEN 'WT'
 WHEN regexp_extract(L, '^([A-Z])([0-9]+)([A-Z])', 1) = '' THEN 'Other' WHEN regexp_extract(L, '^([A-Z])([0-9]+)([A-Z])', 1) = regexp_extract(L, '^([A-Z])([0-9]+)([A-Z])', 3) THEN 'Synonymous' ELSE 'Single Missense' END"""
CLASS = CLASS.replace("(L,", "(meta_aa_changes,").replace("L LIKE", "meta_aa_changes LIKE")
LONG = "long AS (SELECT meta_aa_changes, meta_barcode, meta_batch, unnest([" + ", ".join(f"'{f}'" for f in FEATURES) + "]) AS feature, unnest([" + ", ".join(FEATURES) + "]::DOUBLE[]) AS v FROM cells)"


def cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(CELLS.replace("FROM lineitem", "FROM {lineitem}"), lineitem=spark.read.parquet(f"{sf_dir}/lineitem.parquet"))


def controlled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Label, control flag and features only."""
    return add_control(cells(spark, sf_dir)).select(LABEL, CONTROL, *FEATURES)


def _rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    return df.select(*(F.round(c, digits).alias(c) if t == "double" else F.col(c).cast("bigint").alias(c) if t == "int" else F.col(c) for c, t in df.dtypes))


def _r(expr: str, name: str) -> str:
    return f"round({expr}, 6) AS {name}"


QC = f"""{WITH}, near AS (SELECT * FROM cells WHERE meta_edit_distance <= 1), bc AS (SELECT meta_barcode FROM near GROUP BY 1 HAVING count(*) >= 10),
 kept1 AS (SELECT * FROM near WHERE meta_barcode IN (SELECT meta_barcode FROM bc)), vc AS (SELECT meta_aa_changes FROM kept1 GROUP BY 1 HAVING count(DISTINCT meta_barcode) >= 1),
 kept AS (SELECT * FROM kept1 WHERE meta_aa_changes IN (SELECT meta_aa_changes FROM vc))"""


def mean_profile(spark, sf_dir):
    kept = qc.qc(cells(spark, sf_dir), 10, 1, 1)[0]
    flagged = add_control(kept).select(LABEL, CONTROL, *FEATURES)
    return _rounded(aggregate(Normalizer.fit(flagged, FEATURES).apply(flagged), "mean"))


def qc_cells(spark, sf_dir):
    return qc.qc(cells(spark, sf_dir), 10, 1, 1)[0].groupBy(LABEL).agg(F.count("*").alias("n"), F.count_distinct(BARCODE).alias("barcodes"))


def qc_barcodes(spark, sf_dir):
    return qc.barcode_counts(cells(spark, sf_dir), 500)


def qc_variants(spark, sf_dir):
    return qc.variant_barcodes(cells(spark, sf_dir), 8)


def variant_classes(spark, sf_dir):
    return cells(spark, sf_dir).groupBy(classify_variant(F.col(LABEL)).alias("class")).agg(F.count("*").alias("n"), F.count_if(untagged_synonymous(F.col(LABEL))).alias("controls"))


def metadata(spark, sf_dir):
    m = qc.metadata(cells(spark, sf_dir))
    return m.select(LABEL, "meta_num_cells", "meta_barcode_num_unique", "meta_batch_num_unique", F.expr("concat_ws(',', transform(meta_batch_counts, x -> concat(x.meta_batch, '=', x.count)))").alias("batches"))


def normalizer(spark, sf_dir):
    return _rounded(Normalizer.fit(controlled(spark, sf_dir), FEATURES).table(spark))


def control_by_predicate(spark, sf_dir):
    e = spark.read.parquet(f"{sf_dir}/events.parquet").select(F.col("event_type").alias("meta_type"), F.col("value"))
    e = add_control(e, "meta_type = 'error'")
    return _rounded(Normalizer.fit(e, ["value"]).apply(e).groupBy("meta_type", CONTROL).agg(F.avg("value").alias("mean_z"), F.count("*").alias("n")))


def _profile(name: str, digits: int = 6):
    def query(spark, sf_dir):
        return _rounded(aggregate(controlled(spark, sf_dir), name), digits)
    query.__name__ = f"profile_{name}"
    return query


def selected_variants(spark, sf_dir):
    return sampling.select_variants(cells(spark, sf_dir), 2, ["Single Missense"]).groupBy(LABEL).agg(F.count("*").alias("n"))


def random_barcodes(spark, sf_dir):
    counts = cells(spark, sf_dir).groupBy(BARCODE).agg(F.count("*").alias("n"))
    return sampling.top_groups(counts, BARCODE, 5, "random", 7)


def pseudo_variants(spark, sf_dir):
    return sampling.pseudo_variants(cells(spark, sf_dir), 0.25, ["Synonymous"], IDS, 3).groupBy(LABEL).agg(F.count("*").alias("n"), F.round(F.sum("Cells_Price"), 2).alias("price"))


def control_downsample(spark, sf_dir):
    return sampling.downsample(add_control(cells(spark, sf_dir)), F.col(CONTROL), 500, IDS, 1).groupBy(LABEL).agg(F.count("*").alias("n"), F.round(F.sum("Cells_Price"), 2).alias("price"))


def barcode_cap(spark, sf_dir):
    return sampling.cap_groups(cells(spark, sf_dir), BARCODE, 50, IDS, 1).groupBy(BARCODE).agg(F.count("*").alias("n"), F.round(F.sum("Cells_Price"), 2).alias("price"))


def min_cells(spark, sf_dir):
    return sampling.drop_small_groups(cells(spark, sf_dir), LABEL, 4700, "WT").groupBy(LABEL).agg(F.count("*").alias("n"))


def stratified_split(spark, sf_dir):
    return sampling.stratified_split(cells(spark, sf_dir), LABEL, models.SHARES, IDS, 42).groupBy(LABEL, "split").agg(F.count("*").alias("n"), F.round(F.sum("Cells_Price"), 2).alias("price"))


def ovwt_splits(spark, sf_dir):
    rows = models.variant_splits(cells(spark, sf_dir), IDS, min_cells=50)
    return rows.groupBy(LABEL, "split").agg(F.count("*").alias("n"), F.round(F.sum("Cells_Price"), 2).alias("price"))


def largest_other(spark, sf_dir):
    return sampling.to_largest_other(cells(spark, sf_dir), LABEL, "WT", "largest", IDS, 1).groupBy(LABEL).agg(F.count("*").alias("n"), F.round(F.sum("Cells_Price"), 2).alias("price"))


def without_blocked_barcodes(spark, sf_dir):
    c = cells(spark, sf_dir)
    blocked = c.groupBy(F.col(BARCODE).alias("barcode")).agg((F.count("*") % 3 != 0).alias("barcode_ok"))
    return sampling.exclude_barcodes(c, blocked).groupBy(BARCODE).agg(F.count("*").alias("n"))


def _halves(spark, sf_dir, seed=5):
    h = sampling.replicate_halves(add_control(cells(spark, sf_dir)), [seed], IDS)
    return [aggregate(h.where(F.col("half") == k).select(LABEL, CONTROL, *FEATURES), "mean") for k in (1, 2)]


def halves_correlation(spark, sf_dir):
    return _rounded(selection.correlate_halves(*_halves(spark, sf_dir)))


#: Replicates of the bootstrap, as many as the pipeline's default.
SEEDS = tuple(range(10))


def bootstrap_block_list(spark, sf_dir):
    return _rounded(selection.bootstrap_block_list(selection.combine_block_lists([selection.correlate_halves(*_halves(spark, sf_dir, s)) for s in SEEDS])))


def _batches(c: DataFrame) -> list[str]:
    """Names of all batches: one for each input file."""
    return sorted(r[0] for r in c.select(BATCH).distinct().collect())


def _by_batch(spark, sf_dir):
    c = add_control(cells(spark, sf_dir))
    return [aggregate(c.where(F.col(BATCH) == b).select(LABEL, CONTROL, *FEATURES), "mean") for b in _batches(c)]


def cross_batch_median(spark, sf_dir):
    return _rounded(selection.cross_batch_median(_by_batch(spark, sf_dir)))


def agreed_block_list(spark, sf_dir):
    rows = cells(spark, sf_dir).groupBy(BATCH).agg(*(F.avg(f).alias(f) for f in FEATURES))
    long = rows.unpivot([BATCH], FEATURES, "feature", "m").withColumn("feature_ok", F.col("m") > 0.045)
    return _rounded(selection.agree_block_lists([long.where(F.col(BATCH) == b) for b in _batches(rows)], 2))


def batch_correct(spark, sf_dir):
    c = cells(spark, sf_dir).select(LABEL, BATCH, *FEATURES)
    return _rounded(BatchCorrector.fit(c, FEATURES).transform(c).groupBy(LABEL, BATCH).agg(*(F.avg(f).alias(f) for f in FEATURES), F.count("*").alias("n")), 4)


def batch_centroids(spark, sf_dir):
    found = BatchCorrector.fit(cells(spark, sf_dir).select(LABEL, BATCH, *FEATURES), FEATURES)
    return _rounded(found.centroids.select(LABEL, *(F.col(f"{k}{i}").alias(f"{f}_{name}") for i, f in enumerate(FEATURES) for k, name in (("m", "mean"), ("s", "std")))))


def joined_feature_types(spark, sf_dir):
    return _rounded(selection.join_feature_types([aggregate(controlled(spark, sf_dir), t) for t in ("mean", "std")]))


def anova_f(spark, sf_dir):
    return _rounded(comparisons.anova_f(comparisons.control_variants(cells(spark, sf_dir)), BATCH, FEATURES), 4)


def anova(spark, sf_dir):
    return _rounded(selection.anova_block_list(comparisons.anova(comparisons.control_variants(cells(spark, sf_dir)), BATCH, FEATURES)), 4)


def _scores(spark, sf_dir):
    return cells(spark, sf_dir).select(LABEL, BARCODE, (F.col("Cells_Quantity") / 50).alias("score"))


def tukey_q(spark, sf_dir):
    return _rounded(comparisons.tukey_q(_scores(spark, sf_dir)).select("variant", "barcode", "comparison_barcode", "mean_diff", "q", F.col("k").cast("bigint").alias("k"), F.col("df").cast("bigint").alias("df")))


def tukey(spark, sf_dir):
    return _rounded(comparisons.tukey(_scores(spark, sf_dir)))


def barcode_block_list(spark, sf_dir):
    return _rounded(comparisons.score_block_list(_scores(spark, sf_dir)))


def _vectors(spark, sf_dir):
    e = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    return e.select(F.col("vec_id").alias("meta_id"), (F.col("label") == 0).alias(CONTROL), *(F.col("embedding")[i].cast("double").alias(f"x{i}") for i in range(64)))


def impact_scores(spark, sf_dir):
    return _rounded(impact_score(_vectors(spark, sf_dir)).select("meta_id", "meta_impact_score"))


def vector_norms(spark, sf_dir):
    v, names = _vectors(spark, sf_dir), [f"x{i}" for i in range(64)]
    return _rounded(v.select("meta_id", norm(names).alias("norm"), cosine_distance(names, dict.fromkeys(names, 1.0)).alias("distance")))


def query_dots(spark, sf_dir):
    names = [f"x{i}" for i in range(64)]
    return _rounded(_vectors(spark, sf_dir).select("meta_id", query_dot(names, {f"x{i}": i % 3 - 1.0 for i in range(64)}).alias("dot")))


def pca_variance(spark, sf_dir):
    return _rounded(pca(_vectors(spark, sf_dir), 10, "meta_id", [f"x{i}" for i in range(64)])[2])


def feature_choice(spark, sf_dir):
    return selection.feature_choice(_rounded(selection.join_feature_types([aggregate(controlled(spark, sf_dir), t) for t in ("mean", "median", "std", "MAD")]), 9))


def select_features(spark, sf_dir):
    wide = selection.join_feature_types([aggregate(controlled(spark, sf_dir), t) for t in ("mean", "std", "KS")])
    return _rounded(selection.select_features(wide))


def _model(name: str, run: Callable):
    def query(spark, sf_dir):
        return _rounded(run(cells(spark, sf_dir)))
    query.__name__ = name
    return query


one_vs_wild_type = _model("one_vs_wild_type", lambda c: models.one_vs_wild_type(c, IDS, min_cells=50).drop("model", "importance"))
wild_type_pairs = _model("wild_type_pairs", lambda c: models.wild_type_pairs(c, IDS, min_cells=50, tell=False).drop("model", "importance"))
wild_type_vs_pool = _model("wild_type_vs_pool", lambda c: models.wild_type_vs_pool(c, IDS, min_cells=50, tell=False).drop("model", "importance"))
batch_vs_batch = _model("batch_vs_batch", lambda c: models.batch_vs_batch(c, IDS))
cell_scores = _model("cell_scores", lambda c: models.score_cells(c, models.one_vs_wild_type(c, IDS, min_cells=50)))

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (
    mean_profile, qc_cells, qc_barcodes, qc_variants, variant_classes, metadata, normalizer, control_by_predicate,
    *(_profile(n) for n in ("mean", "median", "MAD", "std", "KS", "signedKS", "QQ", "AUROC")), *(_profile(n, 4) for n in ("KSnegLogP", "AUROCnegLogP")),
    selected_variants, random_barcodes, pseudo_variants, control_downsample, barcode_cap, min_cells, largest_other, without_blocked_barcodes, stratified_split, ovwt_splits, halves_correlation, bootstrap_block_list,
    cross_batch_median, agreed_block_list, joined_feature_types, batch_centroids, batch_correct, anova_f, anova, tukey_q, tukey, barcode_block_list, impact_scores, vector_norms, query_dots, pca_variance, feature_choice, select_features,
    one_vs_wild_type, wild_type_pairs, wild_type_vs_pool, batch_vs_batch, cell_scores)}


def _each(expr: str, name: str) -> str:
    return ", ".join(f"{expr.replace('@', f)} AS {f}_{name}" for f in FEATURES)


def _pivot(expr: str, name: str, digits: int = 6) -> str:
    return ", ".join(f"round(max(CASE WHEN feature = '{f}' THEN {expr} END), {digits}) AS {f}_{name}" for f in FEATURES)


RANKS = f"""{WITH}, {LONG}, g AS (SELECT DISTINCT feature, meta_aa_changes AS label, v FROM long WHERE meta_aa_changes <> 'WT'),
 cum AS (SELECT feature, meta_aa_changes AS label, v, count(*) OVER (PARTITION BY feature, meta_aa_changes ORDER BY v) AS c_le, count(*) OVER (PARTITION BY feature, meta_aa_changes, v) AS c_eq, count(*) OVER (PARTITION BY feature, meta_aa_changes) AS n_g FROM long WHERE meta_aa_changes <> 'WT'),
 ref AS (SELECT feature, v, sum(CASE WHEN meta_aa_changes = 'WT' THEN 1 ELSE 0 END) OVER (PARTITION BY feature ORDER BY v) AS r_le, sum(CASE WHEN meta_aa_changes = 'WT' THEN 1 ELSE 0 END) OVER (PARTITION BY feature, v) AS r_eq, sum(CASE WHEN meta_aa_changes = 'WT' THEN 1 ELSE 0 END) OVER (PARTITION BY feature) AS n_r FROM long),
 rc AS (SELECT DISTINCT c.feature, c.label, c.v, c_le, c_eq, n_g, r_le, r_eq, n_r FROM cum c JOIN (SELECT DISTINCT * FROM ref) r ON c.feature = r.feature AND c.v = r.v)"""
KS = RANKS + ", ks AS (SELECT feature, label, greatest(max(c_le / n_g - r_le / n_r), 0) AS up, greatest(max((r_le - r_eq) / n_r - (c_le - c_eq) / n_g), 0) AS down, max(n_g)::DOUBLE * max(n_r) / (max(n_g) + max(n_r)) AS n_e FROM rc GROUP BY 1, 2)"
U = RANKS + ", u AS (SELECT feature, label, sum(c_eq * (r_le - r_eq + 0.5::DOUBLE * r_eq)) / (max(n_g)::DOUBLE * max(n_r)) AS auroc FROM rc GROUP BY 1, 2)"
TIES = RANKS + """, t AS (SELECT feature, sum(r_eq ** 3 - r_eq) AS t FROM (SELECT DISTINCT feature, v, r_eq FROM ref) GROUP BY 1),
 u AS (SELECT rc.feature, label, max(n_g)::DOUBLE AS g, max(n_r)::DOUBLE AS r, sum(c_eq * (r_le - r_eq + 0.5::DOUBLE * r_eq)) AS u, any_value(t) + sum((c_eq + r_eq)::DOUBLE ** 3 - (c_eq + r_eq) - (r_eq::DOUBLE ** 3 - r_eq)) AS tie FROM rc JOIN t ON rc.feature = t.feature GROUP BY 1, 2),
 z AS (SELECT feature, label, abs(u - g * r / 2) / sqrt(g * r / 12 * (g + r + 1 - tie / ((g + r) * (g + r - 1)))) / sqrt(2.0::DOUBLE) AS x FROM u), w AS (SELECT *, 1 / (1 + 0.5::DOUBLE * x) AS t FROM z)"""
POLY = reduce(lambda rest, c: f"{c!r}::DOUBLE + t * ({rest})", reversed(ERFC[:-1]), f"{ERFC[-1]!r}::DOUBLE")
#: Four statistics of four features, as rows (label, feature, v).
WIDE = f"""{WITH}, {LONG}, mid AS (SELECT meta_aa_changes AS l, feature AS f, median(v) AS m FROM long WHERE meta_aa_changes <> 'WT' GROUP BY 1, 2),
 stat AS (SELECT l, concat(f, '_', s) AS feature, round(v, 9) AS v FROM (SELECT l, f, unnest(['mean', 'median', 'std', 'MAD']) AS s, unnest([avg(v), any_value(m), stddev_samp(v), median(abs(v - m))]) AS v FROM long JOIN mid ON l = meta_aa_changes AND f = feature GROUP BY 1, 2)),
 n AS (SELECT feature, v, count(*) AS n FROM stat GROUP BY 1, 2), rk AS (SELECT *, row_number() OVER (PARTITION BY feature ORDER BY n DESC, v) AS k FROM n),
 va AS (SELECT feature, coalesce(max(CASE WHEN k = 2 THEN n END), 0) / max(n) >= 0.05::DOUBLE AND count(*) / sum(n) >= 0.01::DOUBLE AS varied FROM rk GROUP BY 1),
 sv AS (SELECT stat.* FROM stat JOIN va USING (feature) WHERE varied),
 r AS (SELECT a.feature AS a, b.feature AS b, CASE WHEN stddev_pop(a.v) > 0 AND stddev_pop(b.v) > 0 THEN abs(corr(a.v, b.v)) ELSE 0 END AS r FROM sv a JOIN sv b ON a.l = b.l GROUP BY 1, 2), t AS (SELECT a, sum(r) AS t FROM r GROUP BY 1),
 gone AS (SELECT DISTINCT r.a FROM r JOIN t x ON x.a = r.a JOIN t y ON y.a = r.b WHERE r.a <> r.b AND r.r > 0.9::DOUBLE AND x.t > y.t)"""
DRAW = "md5(concat('{s}|', l_orderkey::VARCHAR, '|', l_linenumber::VARCHAR, '|', l_partkey::VARCHAR))"
ORDER = "l_orderkey, l_linenumber, l_partkey"


def _half_sql(seed: int) -> str:
    d = DRAW.format(s=seed)
    halves = ", ".join(f"(avg(CASE WHEN half = {h} THEN {f} END)) AS {f}_{h}" for f in FEATURES for h in (1, 2))
    return f"(SELECT meta_aa_changes, {halves} FROM (SELECT *, CASE WHEN (row_number() OVER (PARTITION BY meta_aa_changes ORDER BY {d}, {ORDER}) - 0.5::DOUBLE) / count(*) OVER (PARTITION BY meta_aa_changes) < 0.5 THEN 1 ELSE 2 END AS half FROM cells WHERE meta_aa_changes <> 'WT') GROUP BY 1)"


def _r_sql(seed: int) -> str:
    return " UNION ALL ".join(f"SELECT '{f}_mean' AS feature, corr({f}_1, {f}_2) AS r FROM {_half_sql(seed)}" for f in FEATURES)


MED = f"(SELECT {', '.join(f'median(x{i}) AS c{i}' for i in range(64))} FROM e WHERE label = 0)"
E = "e AS (SELECT vec_id, label, " + ", ".join(f"embedding[{i + 1}]::DOUBLE AS x{i}" for i in range(64)) + " FROM embeddings)"
_sum = lambda term: " + ".join(term.replace("@", str(i)) for i in range(64))
_bc = ", ".join
ORACLES: dict[str, str] = {
    "mean_profile": f"{QC}, c AS (SELECT {_bc(f'avg({f}) AS m_{f}, stddev_samp({f}) AS s_{f}' for f in FEATURES)} FROM kept WHERE meta_aa_changes = 'WT') SELECT meta_aa_changes, {_bc(_r(f'avg(({f} - m_{f}) / s_{f})', f'{f}_mean') for f in FEATURES)} FROM kept, c WHERE meta_aa_changes <> 'WT' GROUP BY 1",
    "qc_cells": f"{QC} SELECT meta_aa_changes, count(*) AS n, count(DISTINCT meta_barcode) AS barcodes FROM kept GROUP BY 1",
    "qc_barcodes": f"{WITH} SELECT meta_barcode, count(*) AS count, min(meta_aa_changes) AS meta_aa_changes, CASE WHEN count(*) >= 500 THEN count(*) END AS barcode_ok FROM cells GROUP BY 1",
    "qc_variants": f"{WITH} SELECT meta_aa_changes, count(DISTINCT meta_barcode) AS barcode_count, CASE WHEN count(DISTINCT meta_barcode) >= 8 THEN count(DISTINCT meta_barcode) END AS variant_barcode_count_ok FROM cells GROUP BY 1",
    "variant_classes": f"{WITH} SELECT {CLASS} AS class, count(*) AS n, count(*) FILTER (WHERE {CLASS} = 'Synonymous') AS controls FROM cells GROUP BY 1",
    "metadata": f"{WITH}, b AS (SELECT meta_aa_changes, string_agg(concat(meta_batch, '=', n), ',' ORDER BY n DESC, meta_batch) AS batches FROM (SELECT meta_aa_changes, meta_batch, count(*) AS n FROM cells GROUP BY 1, 2) GROUP BY 1) SELECT meta_aa_changes, count(*) AS meta_num_cells, count(DISTINCT meta_barcode) AS meta_barcode_num_unique, count(DISTINCT meta_batch) AS meta_batch_num_unique, any_value(batches) AS batches FROM cells JOIN b USING (meta_aa_changes) GROUP BY 1",
    "normalizer": f"{WITH}, w AS (SELECT * FROM cells WHERE meta_aa_changes = 'WT') SELECT 'mean' AS _stat, {_bc(_r(f'avg({f})', f) for f in FEATURES)} FROM w UNION ALL SELECT 'std', {_bc(f'round(stddev_samp({f}), 6)' for f in FEATURES)} FROM w",
    "control_by_predicate": "SELECT event_type AS meta_type, event_type = 'error' AS meta_is_control, round(avg((value - m) / s), 6) + 0.0::DOUBLE AS mean_z, count(*) AS n FROM events, (SELECT avg(value) AS m, stddev_samp(value) AS s FROM events WHERE event_type = 'error') GROUP BY 1, 2",
    "profile_mean": f"{WITH} SELECT meta_aa_changes, {_each('round(avg(@), 6)', 'mean')} FROM cells WHERE meta_aa_changes <> 'WT' GROUP BY 1",
    "profile_median": f"{WITH} SELECT meta_aa_changes, {_each('round(median(@), 6)', 'median')} FROM cells WHERE meta_aa_changes <> 'WT' GROUP BY 1",
    "profile_std": f"{WITH} SELECT meta_aa_changes, {_each('round(stddev_samp(@), 6)', 'std')} FROM cells WHERE meta_aa_changes <> 'WT' GROUP BY 1",
    "profile_MAD": f"{WITH}, m AS (SELECT meta_aa_changes, {_bc(f'median({f}) AS m_{f}' for f in FEATURES)} FROM cells GROUP BY 1) SELECT meta_aa_changes, {_each('round(median(abs(@ - m_@)), 6)', 'MAD')} FROM cells JOIN m USING (meta_aa_changes) WHERE meta_aa_changes <> 'WT' GROUP BY 1",
    "profile_KS": f"{KS} SELECT label AS meta_aa_changes, {_pivot('greatest(up, down)', 'KS')} FROM ks GROUP BY 1",
    "profile_signedKS": f"{KS} SELECT label AS meta_aa_changes, {_pivot('CASE WHEN up >= down THEN up ELSE -down END', 'signedKS')} FROM ks GROUP BY 1",
    "profile_KSnegLogP": f"{KS}, p AS (SELECT feature, label, -2.0::DOUBLE * n_e * greatest(up, down) ** 2 AS m FROM ks), q AS (SELECT feature, label, greatest(0, -(log10(2.0::DOUBLE) + m / ln(10.0::DOUBLE) + log10(list_sum(list_transform(range(1, 101), lambda k: (CASE WHEN k % 2 = 1 THEN 1 ELSE -1 END) * exp(m * (k * k - 1))))))) AS x FROM p) SELECT label AS meta_aa_changes, {_pivot('x', 'KSnegLogP', 4)} FROM q GROUP BY 1",
    "profile_AUROC": f"{U} SELECT label AS meta_aa_changes, {_pivot('auroc', 'AUROC')} FROM u GROUP BY 1",
    "profile_AUROCnegLogP": f"{TIES} SELECT label AS meta_aa_changes, {_pivot(f'greatest(0, -(ln(t) - x * x + {POLY}) / ln(10.0::DOUBLE))', 'AUROCnegLogP', 4)} FROM w GROUP BY 1",
    "feature_choice": f"{WIDE} SELECT feature, varied, varied AND feature NOT IN (SELECT a FROM gone) AS kept FROM va",
    "profile_QQ": f"{WITH}, {LONG}, o AS (SELECT meta_aa_changes, feature, quantile_cont(v, {[k / 99 for k in range(100)]}) AS x FROM long GROUP BY 1, 2), z AS (SELECT a.meta_aa_changes, a.feature, unnest(a.x) AS x, unnest(w.x) AS y FROM o a JOIN o w ON a.feature = w.feature AND w.meta_aa_changes = 'WT' WHERE a.meta_aa_changes <> 'WT'), r AS (SELECT meta_aa_changes, feature, corr(x, y) AS r FROM z GROUP BY 1, 2) SELECT meta_aa_changes, {_pivot('r', 'QQ')} FROM r GROUP BY 1",
    "selected_variants": f"{WITH}, n AS (SELECT meta_aa_changes, {CLASS} AS class, count(*) AS n FROM cells GROUP BY 1, 2) SELECT meta_aa_changes, n FROM n WHERE class <> 'Single Missense' UNION ALL (SELECT meta_aa_changes, n FROM n WHERE class = 'Single Missense' ORDER BY n DESC, meta_aa_changes LIMIT 2)",
    "random_barcodes": f"{WITH} SELECT meta_barcode FROM (SELECT DISTINCT meta_barcode FROM cells) ORDER BY md5(concat('7|', meta_barcode)), meta_barcode LIMIT 5",
    "pseudo_variants": f"{WITH}, p AS (SELECT *, count(*) OVER (PARTITION BY meta_aa_changes) AS size, row_number() OVER (PARTITION BY meta_aa_changes ORDER BY {DRAW.format(s=3)}, {ORDER}) AS k FROM cells WHERE {CLASS} = 'Synonymous') SELECT concat(meta_aa_changes, ':downsample-0.25') AS meta_aa_changes, count(*) AS n, round(sum(Cells_Price), 2) AS price FROM p WHERE k <= floor(size * 0.25) GROUP BY 1",
    "control_downsample": f"{WITH}, p AS (SELECT *, row_number() OVER (PARTITION BY meta_aa_changes = 'WT' ORDER BY {DRAW.format(s=1)}, {ORDER}) AS k FROM cells) SELECT meta_aa_changes, count(*) AS n, round(sum(Cells_Price), 2) AS price FROM p WHERE meta_aa_changes <> 'WT' OR k <= 500 GROUP BY 1",
    "barcode_cap": f"{WITH}, p AS (SELECT *, row_number() OVER (PARTITION BY meta_barcode ORDER BY {DRAW.format(s=1)}, {ORDER}) AS k FROM cells) SELECT meta_barcode, count(*) AS n, round(sum(Cells_Price), 2) AS price FROM p WHERE k <= 50 GROUP BY 1",
    "min_cells": f"{WITH} SELECT meta_aa_changes, count(*) AS n FROM cells GROUP BY 1 HAVING count(*) >= 4700 OR meta_aa_changes = 'WT'",
    "stratified_split": f"{WITH}, p AS (SELECT *, (row_number() OVER (PARTITION BY meta_aa_changes ORDER BY {DRAW.format(s=42)}, {ORDER}) - 0.5::DOUBLE) / count(*) OVER (PARTITION BY meta_aa_changes) AS x FROM cells) SELECT meta_aa_changes, CASE WHEN x < 0.8::DOUBLE THEN 'train' WHEN x < 0.8::DOUBLE + 0.1::DOUBLE THEN 'eval' ELSE 'test' END AS split, count(*) AS n, round(sum(Cells_Price), 2) AS price FROM p GROUP BY 1, 2",
    "halves_correlation": f"{WITH}, r AS ({_r_sql(5)}) SELECT feature, round(r, 6) AS r, round(r * r, 6) AS r_squared FROM r",
    "bootstrap_block_list": f"{WITH}, r AS ({' UNION ALL '.join(_r_sql(s) for s in SEEDS)}) SELECT feature, round(median(r), 6) AS median_r, median(r) >= 0.5 AS feature_ok FROM r GROUP BY 1",
    "cross_batch_median": f"{WITH}, m AS (SELECT meta_aa_changes, meta_batch, {_bc(f'avg({f}) AS {f}' for f in FEATURES)} FROM cells WHERE meta_aa_changes <> 'WT' GROUP BY 1, 2) SELECT meta_aa_changes, {_each('round(median(@), 6)', 'mean')} FROM m GROUP BY 1",
    "agreed_block_list": f"{WITH}, {LONG}, m AS (SELECT feature, meta_batch, avg(v) > 0.045 AS ok FROM long GROUP BY 1, 2) SELECT feature, count(*) AS n_batches, count(*) FILTER (WHERE ok) AS n_ok, count(*) FILTER (WHERE ok) >= 2 AS feature_ok FROM m GROUP BY 1",
    "batch_correct": f"{WITH}, s AS (SELECT meta_aa_changes, meta_batch, {_bc(f'avg({f}) AS m_{f}, stddev_samp({f}) AS s_{f}' for f in FEATURES)} FROM cells GROUP BY 1, 2), t AS (SELECT * FROM s WHERE meta_aa_changes IN (SELECT meta_aa_changes FROM s GROUP BY 1 HAVING count(*) > 1)), c AS (SELECT meta_aa_changes, {_bc(f'avg(m_{f}) AS cm_{f}, avg(s_{f}) AS cs_{f}' for f in FEATURES)} FROM t GROUP BY 1), w AS (SELECT {_bc(f'cm_{f} AS wm_{f}, cs_{f} AS ws_{f}' for f in FEATURES)} FROM c WHERE meta_aa_changes = 'WT') SELECT meta_aa_changes, meta_batch, {_bc(f'round(avg((({f} - m_{f}) / s_{f} * cs_{f} + cm_{f} - cm_{f}) / cs_{f} * ws_{f} + wm_{f}), 4) AS {f}' for f in FEATURES)}, count(*) AS n FROM cells JOIN t USING (meta_aa_changes, meta_batch) JOIN c USING (meta_aa_changes), w GROUP BY 1, 2",
    "anova_f": f"{WITH}, {LONG}, s AS (SELECT feature, meta_batch, count(*) AS n, sum(v) AS s, sum(v * v) AS q FROM long WHERE {CLASS} = 'Synonymous' GROUP BY 1, 2), t AS (SELECT feature, sum(n) AS n, count(*) AS a, sum(s) AS s, sum(q) AS q, sum(q - s * s / n) AS w FROM s GROUP BY 1) SELECT feature, round(((q - s * s / n - w) / (a - 1)) / (w / (n - a)), 4) AS f_value, a - 1 AS df_between, (n - a)::BIGINT AS df_within FROM t WHERE n >= 2 AND a >= 2",
    "tukey_q": f"{WITH}, e AS (SELECT meta_aa_changes AS variant, meta_barcode AS barcode, count(*) AS n, avg(Cells_Quantity / 50) AS m, sum(Cells_Quantity / 50) AS s, sum((Cells_Quantity / 50) ** 2) AS q2 FROM cells GROUP BY 1, 2 HAVING count(*) >= 10), p AS (SELECT variant, sum(q2 - s * s / n) / (sum(n) - count(*)) AS mse, (sum(n) - count(*))::BIGINT AS df, count(*) AS k FROM e GROUP BY 1 HAVING count(*) >= 2) SELECT a.variant, a.barcode, b.barcode AS comparison_barcode, round(b.m - a.m, 6) AS mean_diff, round(abs(b.m - a.m) / sqrt(mse / 2 * (1.0::DOUBLE / a.n + 1.0::DOUBLE / b.n)), 6) AS q, k, df FROM e a JOIN e b ON a.variant = b.variant AND a.barcode < b.barcode JOIN p ON p.variant = a.variant",
    "impact_scores": f"WITH {E}, m AS {MED} SELECT vec_id AS meta_id, round((1 - ({_sum('x@ * c@')}) / (sqrt({_sum('x@ * x@')}) * sqrt({_sum('c@ * c@')}))) / 2, 6) AS meta_impact_score FROM e, m",
    "vector_norms": f"WITH {E} SELECT vec_id AS meta_id, round(sqrt({_sum('x@ * x@')}), 6) AS norm, round(1 - ({_sum('x@')}) / (sqrt({_sum('x@ * x@')}) * 8), 6) AS distance FROM e",
    "largest_other": f"{WITH}, p AS (SELECT *, row_number() OVER (PARTITION BY meta_aa_changes ORDER BY {DRAW.format(s=1)}, {ORDER}) AS k FROM cells), m AS (SELECT max(n) AS most FROM (SELECT count(*) AS n FROM cells WHERE meta_aa_changes <> 'WT' GROUP BY meta_aa_changes)) SELECT meta_aa_changes, count(*) AS n, round(sum(Cells_Price), 2) AS price FROM p, m WHERE meta_aa_changes <> 'WT' OR k <= most GROUP BY 1",
    "without_blocked_barcodes": f"{WITH} SELECT meta_barcode, count(*) AS n FROM cells GROUP BY 1 HAVING count(*) % 3 <> 0",
    "ovwt_splits": f"{WITH}, k AS (SELECT *, row_number() OVER (PARTITION BY meta_aa_changes ORDER BY {DRAW.format(s=42)}, {ORDER}) AS k, count(*) OVER (PARTITION BY meta_aa_changes) AS size FROM cells), p AS (SELECT *, (row_number() OVER (PARTITION BY meta_aa_changes ORDER BY {DRAW.format(s=42)}, {ORDER}) - 0.5::DOUBLE) / count(*) OVER (PARTITION BY meta_aa_changes) AS x FROM k WHERE CASE WHEN meta_aa_changes = 'WT' THEN k <= 5000 ELSE size >= 50 END) SELECT meta_aa_changes, CASE WHEN x < 0.8::DOUBLE THEN 'train' WHEN x < 0.8::DOUBLE + 0.1::DOUBLE THEN 'eval' ELSE 'test' END AS split, count(*) AS n, round(sum(Cells_Price), 2) AS price FROM p GROUP BY 1, 2",
    "joined_feature_types": f"{WITH} SELECT meta_aa_changes, {_each('round(avg(@), 6)', 'mean')}, {_each('round(stddev_samp(@), 6)', 'std')} FROM cells WHERE meta_aa_changes <> 'WT' GROUP BY 1",
    "batch_centroids": f"{WITH}, s AS (SELECT meta_aa_changes, meta_batch, {_bc(f'avg({f}) AS m_{f}, stddev_samp({f}) AS s_{f}' for f in FEATURES)} FROM cells GROUP BY 1, 2) SELECT meta_aa_changes, {_each('round(avg(m_@), 6)', 'mean')}, {_each('round(avg(s_@), 6)', 'std')} FROM s GROUP BY 1 HAVING count(*) > 1",
    "query_dots": f"WITH {E} SELECT vec_id AS meta_id, round({' + '.join(f'x{i} * {i % 3 - 1}' for i in range(64))}, 6) + 0.0::DOUBLE AS dot FROM e",
}
