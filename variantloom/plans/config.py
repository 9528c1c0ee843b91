"""Parameters: defaults, what a batch's own file may override, and the gates that follow."""

from __future__ import annotations

from dataclasses import dataclass, field
from typing import Any

#: Defaults that a batch may override.
BATCH_DEFAULTS: dict[str, Any] = {
    "run_feature_selection": True, "run_ovwt": True, "run_wtvwt": True, "run_barcode_filtered_ovwt": True,
    "run_single_cell_scores": False, "run_check_barcodes": False, "run_wtvvariantpool": False,
    "feature_allowlist_file": None, "feature_blocklist_file": None, "csv_schema_scan_rows": 100,
    "barcode_count_threshold": 10, "variant_barcode_count_threshold": 4, "edit_distance_threshold": 1,
    "qc_n_variants": None, "qc_variant_downsample_classes": ["Single Missense"], "qc_variant_downsample_mode": "top",
    "qc_downsample_amounts": None, "qc_downsample_classes": ["Synonymous", "Single Missense"], "qc_downsample_seed": 0,
    "barcode_blocklist_pvalue_threshold": 0.05, "ovwt_min_cells": 100, "ovwt_downsample_wt": 5000,
    "max_cells_per_barcode_wt": None, "max_cells_per_barcode_variant": None,
    "wtvwt_min_cells_per_barcode": 100, "wtvwt_max_barcodes": None, "wtvwt_barcode_downsample_mode": "top",
    "wtvvariantpool_min_cells_per_barcode": 100, "wtvvariantpool_variant_classes": ["Synonymous"], "wtvvariantpool_downsample_variant_pool": None,
    "feature_select_downsample_wt": None, "feature_select_min_correlation": 0.5,
    "run_pca": False, "pca_n_components": 10, "run_umap": False, "umap_n_components": 2, "umap_n_neighbors": 10, "umap_metric": "cosine", "umap_min_dist": 0.1, "umap_random_state": 42,
    "single_cell_scores_split": "test", "barcode_check_min_cells": 10, "barcode_check_alpha": 0.05,
}
#: Defaults for the whole pipeline alone.
PIPELINE_DEFAULTS: dict[str, Any] = {
    "pipeline_mode": "full", "pipeline_dir": None, "global_channels": None, "anova_blocklist_pvalue_threshold": 0.05,
    "batchvsbatch_min_cells": 50, "batchvsbatch_min_batches": 2, "feature_select_types": ["mean", "median", "MAD", "std", "KS", "QQ", "AUROC"],
    "feature_select_bootstrap_reps": 10, "global_feature_select_min_batches_ok": None,
}


@dataclass
class BatchConfig:
    name: str
    values: dict[str, Any]
    input_paths: list[str]
    channels: list[str] = field(default_factory=list)
    overrides: dict[str, tuple] = field(default_factory=dict)

    def gates(self) -> dict[str, bool]:
        """Which stages run: checking barcodes needs cell scores, and filtering by barcode needs the check."""
        on = {k: bool(self.values[k]) for k in BATCH_DEFAULTS if k in ("run_ovwt", "run_check_barcodes", "run_single_cell_scores", "run_barcode_filtered_ovwt", "run_feature_selection", "run_wtvwt", "run_wtvvariantpool")}
        on["run_single_cell_scores"] |= on["run_check_barcodes"]
        on["run_barcode_filtered_ovwt"] &= on["run_check_barcodes"]
        return on


def resolve(name: str, spec: dict[str, Any] | None, defaults: dict[str, Any] | None = None) -> BatchConfig:
    """A batch's parameters. input_paths is required; unknown keys and keys of the whole pipeline are refused."""
    spec, defaults = dict(spec or {}), BATCH_DEFAULTS | (defaults or {})
    paths, channels = spec.pop("input_paths", None), spec.pop("global_channel", None)
    if not isinstance(paths, list) or not paths:
        raise ValueError(f"Batch {name!r}: input_paths must be a list that isn't empty")
    channels = [] if channels is None else [channels] if isinstance(channels, str) else channels
    if not isinstance(channels, list) or not all(isinstance(c, str) for c in channels):
        raise ValueError(f"Batch {name!r}: global_channel must be a name or a list of names")
    for key in spec:
        if key in PIPELINE_DEFAULTS:
            raise ValueError(f"Batch {name!r}: {key} holds for the whole pipeline and can't be set for a batch")
        if key not in BATCH_DEFAULTS:
            raise ValueError(f"Batch {name!r}: unknown key {key}")
    if spec.get("single_cell_scores_split", "test") not in ("train", "test"):
        raise ValueError(f"Batch {name!r}: single_cell_scores_split must be train or test")
    return BatchConfig(name, defaults | spec, paths, channels, {k: (defaults[k], v) for k, v in spec.items() if v != defaults[k]})


def channels(batches: list[BatchConfig], names: list[str] | None) -> dict[str, list[str]]:
    """Batches of each channel; a batch may be in several or none."""
    unknown = {c for b in batches for c in b.channels} - set(names or [])
    if names is not None and unknown:
        raise ValueError(f"Unknown channels: {', '.join(sorted(unknown))}")
    return {c: [b.name for b in batches if c in b.channels] for c in names or []}
