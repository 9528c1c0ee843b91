"""The pipeline as functions from tables to tables. What several later steps read (draws of halves, models, scores, profiles)
is written once and read back, and nothing is trained or counted twice. `stages` runs each step by itself."""

from __future__ import annotations

import logging
from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.naming import BATCH, CONTROL, FILE, LABEL, ROW, add_control, feature_columns, measured_columns
from ..functions.variant import untagged_synonymous
from ..functions.vectors import impact_score
from ..operators import comparisons, models, qc, sampling, selection
from ..operators.aggregate import aggregate
from ..operators.batchcorrect import BatchCorrector
from ..operators.embedding import pca, umap
from ..operators.normalize import Normalizer
from ..sources.readers import batch_spec, ingest, pattern_file, project_cells, tagged, union_widened
from .config import PIPELINE_DEFAULTS, BatchConfig, channels, resolve
from .logs import stage_log

log = logging.getLogger(__name__)
IDS = [FILE, ROW]


def input_stage(spark: SparkSession, batch: BatchConfig) -> DataFrame:
    v = batch.values
    lists = [pattern_file(v[k]) if v[k] else None for k in ("feature_allowlist_file", "feature_blocklist_file")]
    return ingest(spark, batch.input_paths, *lists, infer_rows=v["csv_schema_scan_rows"])


def qc_stage(cells: DataFrame, batch: BatchConfig) -> dict[str, DataFrame]:
    """cells: projected, with IDS."""
    v = batch.values
    kept, barcodes, variants = qc.qc(cells, v["barcode_count_threshold"], v["variant_barcode_count_threshold"], v["edit_distance_threshold"])
    kept = sampling.select_variants(kept, v["qc_n_variants"], v["qc_variant_downsample_classes"], v["qc_variant_downsample_mode"], v["qc_downsample_seed"])
    kept = sampling.with_pseudo_variants(kept, v["qc_downsample_amounts"], v["qc_downsample_classes"], IDS, v["qc_downsample_seed"])
    return {"cells": kept, "barcode_counts": barcodes, "variants_per_barcode": variants}


def normalize_stage(cells: DataFrame, control: str = f"{LABEL} = 'WT'") -> tuple[DataFrame, Normalizer]:
    flagged = add_control(cells, control)
    fitted = Normalizer.fit(flagged, feature_columns(flagged))
    return fitted.apply(flagged), fitted


def profile_stage(cells: DataFrame, name: str, block_list: set[str] | None = None, normalise: bool = True) -> DataFrame:
    """Profiles of variants, z-scored against untagged synonymous ones, with metadata and impact score."""
    out = aggregate(cells, name, LABEL, block_list).withColumn(CONTROL, untagged_synonymous(F.col(LABEL)))
    if normalise:
        out = Normalizer.fit(out).apply(out)
    return impact_score(out.join(qc.metadata(cells), LABEL))


Keep = Callable[[DataFrame, str], DataFrame]


def _as_is(df: DataFrame, name: str) -> DataFrame:
    return df


def bootstrap_stage(cells: DataFrame, types: list[str], seeds: list[int], least: float = 0.5, downsample_wt=None, keep: Keep = _as_is) -> dict[str, DataFrame]:
    """half_index, the half of each row for each seed; correlations of each feature between halves; and block_list, the profile columns that don't agree. keep writes a table by name and gives it back: the halves are drawn once, over ids alone."""
    cells = sampling.downsample(cells, F.col(CONTROL), downsample_wt, IDS)
    halves = keep(sampling.replicate_halves(cells.select(*IDS, LABEL), seeds, IDS), "half_index")
    found = []
    for seed in seeds:
        one, two = (cells.join(halves.where((F.col("seed") == seed) & (F.col("half") == h)).select(*IDS), IDS, "left_semi") for h in (1, 2))
        found += [selection.correlate_halves(aggregate(one, name), aggregate(two, name)).withColumn("seed", F.lit(seed)) for name in types]
    correlations = keep(selection.combine_block_lists(found), "correlations")
    return {"half_index": halves, "correlations": correlations, "block_list": keep(selection.bootstrap_block_list(correlations, least), "block_list")}


def finalize_stage(cells: DataFrame, joined: DataFrame, block_list: DataFrame, batch: BatchConfig) -> dict[str, DataFrame]:
    """Profiles of all types side by side (joined), without blocked and redundant columns; then z-scored, with impact score, metadata and embeddings."""
    v = batch.values
    joined = selection.select_features(selection.drop_blocked(joined, block_list))
    joined = joined.withColumn(CONTROL, untagged_synonymous(F.col(LABEL)))
    return _finish(impact_score(Normalizer.fit(joined).apply(joined)), qc.metadata(cells), v)


def _finish(profiles: DataFrame, meta: DataFrame | None, v: dict) -> dict[str, DataFrame]:
    out = {}
    if v["run_pca"]:
        scores, out["pca_loadings"], out["pca_variance"] = pca(profiles, v["pca_n_components"])
        profiles = profiles.join(scores, LABEL)
    if v["run_umap"]:
        profiles = profiles.join(umap(profiles.select(LABEL, *feature_columns(profiles)), v["umap_n_components"], v["umap_n_neighbors"], v["umap_metric"], v["umap_min_dist"], v["umap_random_state"]), LABEL)
    return out | {"profiles": profiles if meta is None else profiles.join(meta, LABEL)}


def global_select_stage(profiles: list[DataFrame], block_lists: list[DataFrame], min_ok: int | None, v: dict) -> dict[str, DataFrame]:
    """Blocked columns out, z-scores within each batch, medians over batches, then selection; not z-scored again."""
    agreed = selection.agree_block_lists(block_lists, min_ok)
    bad = selection.blocked(agreed)
    each = []
    for p in profiles:
        p = p.select(LABEL, *(c for c in feature_columns(p, LABEL) if c not in bad)).withColumn(CONTROL, untagged_synonymous(F.col(LABEL)))
        each.append(Normalizer.fit(p).apply(p))
    chosen = selection.select_features(selection.cross_batch_median(each)).withColumn(CONTROL, untagged_synonymous(F.col(LABEL)))
    return {"block_list": agreed} | _finish(impact_score(chosen), None, v)


def classifier_stage(cells: DataFrame, batch: BatchConfig, keep: Keep = _as_is) -> dict[str, DataFrame]:
    """Models of the batch by its gates; scores of the cells of one part (`single_cell_scores_split`), the barcode check and the models after it. keep writes a table by name and gives it back, so that what builds on it doesn't train again."""
    v, on, out = batch.values, batch.gates(), {}
    prepare = {"min_cells": v["ovwt_min_cells"], "downsample_wt": v["ovwt_downsample_wt"], "cap_wt": v["max_cells_per_barcode_wt"], "cap_variant": v["max_cells_per_barcode_variant"]}

    def add(name: str, df: DataFrame) -> DataFrame:
        out[name] = keep(df, name)
        return out[name]

    def family(name: str, models_: DataFrame) -> None:
        trained = add(name, models_)
        add(f"{name}_results", trained.drop("model", "importance").join(qc.metadata(cells).withColumnRenamed(LABEL, "key"), "key", "left"))
        add(f"{name}_importance", models.importance_table(trained))

    if on["run_ovwt"]:
        family("ovwt", models.one_vs_wild_type(cells, IDS, **prepare))
        splits = models.variant_splits(cells, IDS, **prepare)
        parts = add("ovwt_splits", splits.select(*IDS, LABEL, "split"))
        if on["run_single_cell_scores"]:
            chosen = parts.where(F.col("split") == v["single_cell_scores_split"]).select(*IDS)
            add("cell_scores", models.score_cells(cells.join(chosen, IDS, "left_semi"), out["ovwt"]))
        if on["run_check_barcodes"]:
            add("tukey", comparisons.tukey(models.own_score(out["cell_scores"]), v["barcode_check_alpha"], min_cells=v["barcode_check_min_cells"]))
            add("barcode_block_list", comparisons.barcode_block_list(out["tukey"], v["barcode_blocklist_pvalue_threshold"]))
        if on["run_barcode_filtered_ovwt"]:
            family("ovwt_filtered", models.one_vs_wild_type(cells, IDS, blocked=out["barcode_block_list"], **prepare))
    if on["run_wtvwt"]:
        family("wtvwt", models.wild_type_pairs(cells, IDS, min_cells=v["wtvwt_min_cells_per_barcode"], max_barcodes=v["wtvwt_max_barcodes"], mode=v["wtvwt_barcode_downsample_mode"]))
    if on["run_wtvvariantpool"]:
        family("wtvvariantpool", models.wild_type_vs_pool(cells, IDS, classes=tuple(v["wtvvariantpool_variant_classes"]), min_cells=v["wtvvariantpool_min_cells_per_barcode"], downsample_pool=v["wtvvariantpool_downsample_variant_pool"]))
    return out


def channel_stage(cells: DataFrame, v: dict, keep: Keep = _as_is) -> dict[str, DataFrame]:
    """All batches of a channel: variance between batches, its block-list, batch classifiers, centroid correction with what was fitted."""
    features, out = measured_columns(cells), {}

    def add(name: str, df: DataFrame) -> DataFrame:
        out[name] = keep(df, name)
        return out[name]

    found = add("anova", comparisons.anova(comparisons.control_variants(cells), BATCH, features))
    add("anova_block_list", selection.anova_block_list(found, v["anova_blocklist_pvalue_threshold"]))
    trained = add("batch_vs_batch", models.batch_vs_batch(cells, IDS, min_cells=v["batchvsbatch_min_cells"], min_batches=v["batchvsbatch_min_batches"]))
    add("batch_vs_batch_importance", models.importance_table(trained))
    fitted = BatchCorrector.fit(cells, features)
    fitted = replace(fitted, stats=add("corrector_stats", fitted.stats), centroids=add("corrector_centroids", fitted.centroids))
    add("corrected", fitted.transform(cells))
    return out


def run(spark: SparkSession, specs: dict[str, str], out: str, pipeline: dict | None = None, batch_defaults: dict | None = None, mode: str | None = None) -> dict[str, str]:
    """The whole pipeline over {batch: YAML path}; tables are written below `out`. A batch that fails doesn't stop the others: the result names it with its reason, beside 'ok' for the rest."""
    v = PIPELINE_DEFAULTS | (pipeline or {})
    light = (mode or v["pipeline_mode"]) == "ovwt"
    batches = [resolve(name, batch_spec(path), batch_defaults) for name, path in specs.items()]
    groups, state, cells, blocks, profiles = channels(batches, v["global_channels"]), {}, {}, {}, {}

    def put(df: DataFrame, *path: str) -> DataFrame:
        where = "/".join([out, *path])
        df.write.mode("overwrite").parquet(where)
        return spark.read.parquet(where)

    for b in batches:
        try:
            with stage_log(f"{out}/logs/{b.name}.log"):
                log.info("batch %s: %s", b.name, b.overrides or "defaults")
                put(input_stage(spark, b), "input", f"{b.name}.parquet")
                done = qc_stage(project_cells(tagged(spark, f"{out}/input/{b.name}.parquet")), b)
                for name in ("barcode_counts", "variants_per_barcode"):
                    put(done[name], "qc", b.name, name)
                z, fitted = normalize_stage(put(done["cells"], "qc", b.name, "cells"))
                fitted.save(spark, f"{out}/normalizer/{b.name}")
                cells[b.name] = put(z.withColumn(BATCH, F.lit(b.name)), "normalized", f"{b.name}.parquet")
                classifier_stage(cells[b.name], b, lambda df, name: put(df, "models", b.name, name))
                if b.gates()["run_feature_selection"] and not light:
                    types, keep = v["feature_select_types"], lambda df, name: put(df, "features", b.name, name)
                    found = bootstrap_stage(cells[b.name], types, list(range(v["feature_select_bootstrap_reps"])), b.values["feature_select_min_correlation"], b.values["feature_select_downsample_wt"], keep)
                    profiles[b.name] = keep(selection.join_feature_types([keep(aggregate(cells[b.name], t), f"profiles_{t}") for t in types]), "profiles_joined")
                    for name, table in finalize_stage(cells[b.name], profiles[b.name], found["block_list"], b).items():
                        keep(table, name)
                    blocks[b.name] = found["block_list"]
                log.info("batch %s: ok", b.name)
            state[b.name] = "ok"
        except Exception as e:  # any failure of one batch; reported in the result and the log
            log.exception("batch %s", b.name)
            state[b.name] = f"{type(e).__name__}: {e}"
    for channel, members in ({} if light else groups).items():
        own, failed = [m for m in members if state[m] == "ok"], [m for m in members if state[m] != "ok"]
        try:
            if not own:
                raise ValueError("no batch of the channel was processed")
            keep = lambda df, name: put(df, "global", channel, name)
            with stage_log(f"{out}/logs/channel_{channel}.log"):
                log.info("channel %s: %s", channel, ", ".join(own))
                channel_stage(union_widened([cells[m] for m in own]), v, keep)
                if all(m in blocks for m in own):
                    for name, table in global_select_stage([profiles[m] for m in own], [blocks[m] for m in own], v["global_feature_select_min_batches_ok"], resolve(channel, {"input_paths": ["-"]}, batch_defaults).values).items():
                        keep(table, name)
            state[f"channel {channel}"] = f"incomplete: without {', '.join(failed)}" if failed else "ok"
        except Exception as e:
            log.exception("channel %s", channel)
            state[f"channel {channel}"] = f"{type(e).__name__}: {e}"
    return state
