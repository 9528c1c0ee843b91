"""Every stage by itself: run_stage(spark, name, **options) reads its input, writes its tables and a log, and gives the tables.

Tables are written to {output_dir}/{name}, or to {output_root}.{name} where a root is given. From a shell:
python -m variantloom.plans.stages STAGE option=value .. (values as in YAML)."""

from __future__ import annotations

import inspect
import sys
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.naming import BATCH, CONTROL, LABEL, feature_columns, measured_columns
from ..operators import comparisons, models, qc, sampling, selection
from ..operators.aggregate import aggregate
from ..operators.batchcorrect import BatchCorrector
from ..sources.readers import batch_spec, by_index, load_batches, load_split, project_cells, read_table, tagged
from . import pipeline
from .config import resolve
from .logs import stage_log

IDS = pipeline.IDS
STAGES: dict[str, Callable[..., dict[str, DataFrame]]] = {}


def stage(f: Callable) -> Callable:
    STAGES[f.__name__.rstrip("_")] = f
    return f


def _cells(spark: SparkSession, pattern: str, use_parent_name: bool = False) -> DataFrame:
    df, _ = load_batches(spark, pattern, use_parent_name)
    return df


def _blocked(spark: SparkSession, path: str | None) -> DataFrame | None:
    return read_table(spark, path) if path else None


def _tables(spark: SparkSession, paths: list[str] | str) -> list[DataFrame]:
    return [read_table(spark, p) for p in ([paths] if isinstance(paths, str) else paths)]


@stage
def input_(spark, *, batch_file: str, table: str = "cells"):
    return {table: pipeline.input_stage(spark, resolve(table, batch_spec(batch_file)))}


@stage
def qcfilter(spark, *, input_file: str, **values):
    return pipeline.qc_stage(project_cells(tagged(spark, input_file)), resolve("qc", {"input_paths": [input_file]} | values))


@stage
def normalize(spark, *, input_file: str, control_sample_query: str = f"{LABEL} = 'WT'", save_normalizer: bool = True):
    out, fitted = pipeline.normalize_stage(_cells(spark, input_file), control_sample_query)
    return {"normalized": out} | ({"normalizer": fitted.table(spark)} if save_normalizer else {})


@stage
def aggregate_(spark, *, aggregator: str, input_file: str, block_list_file: str | None = None, normalise: bool = True):
    bad = _blocked(spark, block_list_file)
    return {"aggregated": pipeline.profile_stage(_cells(spark, input_file), aggregator, selection.blocked(bad) if bad is not None else None, normalise)}


@stage
def aggregatefeaturetype(spark, *, aggregator: str, input_file: str, index_file: str | None = None, downsample_wt=None):
    cells = by_index(_cells(spark, input_file), _blocked(spark, index_file), IDS)
    return {"features": aggregate(sampling.downsample(cells, F.col(CONTROL), downsample_wt, IDS), aggregator)}


@stage
def generatesplit(spark, *, input_file: str, random_state: int = 42):
    halves = sampling.replicate_halves(_cells(spark, input_file).select(*IDS, LABEL), [random_state], IDS)
    return {f"half{h}": halves.where(F.col("half") == h).select(*IDS) for h in (1, 2)}


@stage
def correlatefeatures(spark, *, half1_file: str, half2_file: str):
    return {"correlations": selection.correlate_halves(read_table(spark, half1_file), read_table(spark, half2_file))}


@stage
def blocklist(spark, *, input_files: list, min_correlation: float = 0.5):
    return {"block_list": selection.bootstrap_block_list(selection.combine_block_lists(_tables(spark, input_files)), min_correlation)}


@stage
def combineblocklists(spark, *, input_files: list):
    return {"block_list": selection.combine_block_lists(_tables(spark, input_files))}


@stage
def featureselect(spark, *, feature_files: list, block_list_file: str, input_file: str, **values):
    joined = selection.join_feature_types(_tables(spark, feature_files))
    return pipeline.finalize_stage(_cells(spark, input_file), joined, read_table(spark, block_list_file), resolve("features", {"input_paths": [input_file]} | values))


@stage
def globalfeatureselect(spark, *, aggregate_files: list, block_list_files: list, min_batches_ok: int | None = None, **values):
    v = resolve("global", {"input_paths": ["-"]} | values).values
    return pipeline.global_select_stage(_tables(spark, aggregate_files), _tables(spark, block_list_files), min_batches_ok, v)


@stage
def batchcorrect(spark, *, input_file: str, use_parent_name: bool = False):
    cells = _cells(spark, input_file, use_parent_name)
    fitted = BatchCorrector.fit(cells, measured_columns(cells))
    return {"corrector/stats": fitted.stats, "corrector/centroids": fitted.centroids}


@stage
def batchcorrecttransform(spark, *, input_file: str, corrector: str, use_parent_name: bool = False):
    cells = _cells(spark, input_file, use_parent_name)
    return {"corrected": BatchCorrector.load(spark, corrector, measured_columns(cells)).transform(cells)}


@stage
def anova(spark, *, input_file: str, skip_pseudo: bool = False, use_parent_name: bool = False):
    cells = _cells(spark, input_file, use_parent_name)
    return {"anova": comparisons.anova(comparisons.control_variants(cells, LABEL, skip_pseudo), BATCH, feature_columns(cells, BATCH, LABEL))}


@stage
def anovablocklist(spark, *, input_file: str, pvalue_threshold: float = 0.05):
    return {"block_list": selection.anova_block_list(read_table(spark, input_file), pvalue_threshold)}


def _family(trained: DataFrame, cells: DataFrame, more: dict | None = None) -> dict[str, DataFrame]:
    results = trained.drop("model", "importance").join(qc.metadata(cells).withColumnRenamed(LABEL, "key"), "key", "left")
    return {"models": trained, "results": results, "importance": models.importance_table(trained)} | (more or {})


@stage
def batchvsbatch(spark, *, input_file: str, min_cells: int = 50, min_batches: int = 2, feature_block_list: str | None = None, use_parent_name: bool = False):
    cells = _cells(spark, input_file, use_parent_name)
    trained = models.batch_vs_batch(cells, IDS, min_cells=min_cells, min_batches=min_batches, blocked_features=_blocked(spark, feature_block_list))
    return {"models": trained, "importance": models.importance_table(trained)}


@stage
def ovwt(spark, *, input_file: str, min_cells: int = 100, downsample_wt=5000, max_cells_per_barcode_wt: int | None = None, max_cells_per_barcode_variant: int | None = None, barcode_block_list: str | None = None, feature_block_list: str | None = None, random_state: int = 42):
    cells = _cells(spark, input_file)
    prepare = {"min_cells": min_cells, "downsample_wt": downsample_wt, "cap_wt": max_cells_per_barcode_wt, "cap_variant": max_cells_per_barcode_variant, "blocked": _blocked(spark, barcode_block_list), "seed": random_state}
    trained = models.one_vs_wild_type(cells, IDS, blocked_features=_blocked(spark, feature_block_list), **prepare)
    index = models.variant_splits(cells, IDS, **prepare).select(F.col(IDS[0]).alias("origin_file"), F.col(IDS[1]).alias("row_idx"), LABEL, "split")
    return _family(trained, cells, {"splits": index})


@stage
def ovwtcellscores(spark, *, input_file: str, models_file: str):
    return {"cell_scores": models.score_cells(load_split(spark, input_file), read_table(spark, models_file))}


@stage
def checkbarcodes(spark, *, input_file: str, alpha: float = 0.05, min_cells: int = 10):
    return {"tukey": comparisons.tukey(models.own_score(read_table(spark, input_file)), alpha, min_cells=min_cells)}


@stage
def barcodeblocklist(spark, *, input_file: str, pvalue_threshold: float = 0.05):
    return {"block_list": comparisons.barcode_block_list(read_table(spark, input_file), pvalue_threshold)}


@stage
def wtvwt(spark, *, input_file: str, min_cells_per_barcode: int = 100, max_barcodes: int | None = None, barcode_downsample_mode: str = "top", feature_block_list: str | None = None, random_state: int = 42):
    cells = _cells(spark, input_file)
    return _family(models.wild_type_pairs(cells, IDS, min_cells=min_cells_per_barcode, max_barcodes=max_barcodes, mode=barcode_downsample_mode, blocked_features=_blocked(spark, feature_block_list), seed=random_state), cells)


@stage
def wtvvariantpool(spark, *, input_file: str, variant_classes: list = ("Synonymous",), min_cells_per_barcode: int = 100, downsample_variant_pool=None, feature_block_list: str | None = None, random_state: int = 42):
    cells = _cells(spark, input_file)
    return _family(models.wild_type_vs_pool(cells, IDS, classes=tuple(variant_classes), min_cells=min_cells_per_barcode, downsample_pool=downsample_variant_pool, blocked_features=_blocked(spark, feature_block_list), seed=random_state), cells)


def run_stage(spark: SparkSession, name: str, output_dir: str = ".", output_root: str | None = None, **options) -> dict[str, DataFrame]:
    """Each table is written and read back before the next, so that tables built on one another aren't computed again from the start."""
    if name not in STAGES:
        raise ValueError(f"Unknown stage {name!r}; one of {', '.join(STAGES)}")
    known = inspect.signature(STAGES[name]).parameters
    unknown = set(options) - set(known)
    if unknown and not any(p.kind is p.VAR_KEYWORD for p in known.values()):
        raise ValueError(f"Stage {name}: unknown options {', '.join(sorted(unknown))}")
    where, out = (lambda table: f"{output_root}.{table}" if output_root else f"{output_dir}/{table}"), {}
    with stage_log(where(f"{name}.log")):
        for table, df in STAGES[name](spark, **options).items():
            df.write.mode("overwrite").parquet(where(table))
            pipeline.log.info("%s: %s", name, where(table))
            out[table] = spark.read.parquet(where(table))
    return out


def main(arguments: list[str]) -> None:
    import yaml

    from ..session import get_session, ship

    options = dict(x.split("=", 1) for x in arguments[1:])
    run_stage(ship(get_session(arguments[0])), arguments[0], **{k: yaml.safe_load(v) for k, v in options.items()})


if __name__ == "__main__":
    main(sys.argv[1:])
