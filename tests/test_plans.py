import numpy as np
import pandas as pd
import pytest
import yaml
from pyspark.sql import functions as F

from variantloom import streaming
from variantloom.functions.naming import BATCH, LABEL
from variantloom.plans import config, pipeline, stages
from variantloom.sources import readers


def raw(seed, labels=("WT", "A1A", "A2A", "M1K")):
    rng = np.random.default_rng(seed)
    rows = [(f"{lab}_bc{b}", lab, 0) for lab in labels for b in range(8 if lab == "WT" else 5) for _ in range(14)]
    out = pd.DataFrame(rows, columns=["upBarcode", "aaChanges", "editDistance"])
    for f in ("Cells_AreaShape_Area", "Cells_Intensity_Mean", "Nuclei_AreaShape_Area"):
        out[f] = rng.normal(size=len(out)) + (out["aaChanges"] == "M1K") * 2 + out["upBarcode"].str[-1].astype(int) * 0.1
    return out


def test_readers(spark, tmp_path):
    a, b = tmp_path / "a.csv", tmp_path / "b.parquet"
    raw(1).to_csv(a, index=False)
    raw(2).to_parquet(b)
    df = readers.ingest(spark, [str(a), str(b)], allow=["Cells_*", "Nuclei_*"], block=["*_Mean"])
    assert [c for c in df.columns if "_" in c and not c.startswith("meta_")] == ["Cells_AreaShape_Area", "Nuclei_AreaShape_Area"]
    n = len(raw(1))
    assert {r[0]: (r[1], r[2]) for r in df.groupBy("meta_origin_file").agg(F.min("meta_origin_row_idx"), F.max("meta_origin_row_idx")).collect()} == {str(a): (0, n - 1), str(b): (0, n - 1)}
    with pytest.raises(ValueError):
        readers.read_table(spark, "x.txt")
    sparse = tmp_path / "s.csv"
    sparse.write_text("upBarcode,a,b\n" + "x,1,\n" * 5 + "y,2,1.5\n")
    assert dict(readers.read_table(spark, str(sparse), 3).dtypes)["b"] == "string"
    assert dict(readers.read_table(spark, str(sparse), None).dtypes)["b"] == "double"
    both, stem = readers.load_batches(spark, str(tmp_path / "*.parquet"))
    assert stem == "b" and both.select(BATCH).distinct().first()[0] == "b"
    with pytest.raises(ValueError):
        readers.load_batches(spark, str(tmp_path / "none*"))
    cells = readers.project_cells(readers.tagged(spark, str(b)).withColumn("nuclei_x", F.lit(1)).withColumn("aaChanges", F.lit("M1K:tag:more")))
    row = cells.first()
    assert row[LABEL] == "M1K" and row["meta_variant_tag"] == "tag:more" and "nuclei_x" not in cells.columns


def test_config():
    c = config.resolve("b", {"input_paths": ["x"], "global_channel": "s", "ovwt_min_cells": 5, "run_check_barcodes": True})
    assert c.channels == ["s"] and c.overrides == {"ovwt_min_cells": (100, 5), "run_check_barcodes": (False, True)}
    assert c.gates()["run_single_cell_scores"] and c.gates()["run_barcode_filtered_ovwt"]
    for bad in ({}, {"input_paths": []}, {"input_paths": ["x"], "typo": 1}, {"input_paths": ["x"], "pipeline_dir": "y"}, {"input_paths": ["x"], "global_channel": 3}, {"input_paths": ["x"], "single_cell_scores_split": "eval"}):
        with pytest.raises(ValueError):
            config.resolve("b", bad)
    assert config.channels([c], ["s", "t"]) == {"s": ["b"], "t": []}
    with pytest.raises(ValueError):
        config.channels([c], ["t"])


def test_stream(spark, tmp_path):
    (tmp_path / "in").mkdir()
    for k in (1, 2):
        spark.createDataFrame([("WT", f"x{k}", 1.0)] * k, f"{LABEL} string, meta_barcode string, f double").coalesce(1).write.parquet(str(tmp_path / f"t{k}"))
        next((tmp_path / f"t{k}").glob("part-*.parquet")).rename(tmp_path / "in" / f"batch{k}.parquet")
    schema = spark.read.parquet(str(tmp_path / "in")).schema
    seen = {}
    stream = streaming.cell_stream(spark, str(tmp_path / "in"), schema)
    streaming.each_batch(stream, lambda df, i: seen.update({r[0]: r[1] for r in df.groupBy(BATCH).count().collect()}), str(tmp_path / "c")).start().awaitTermination(60)
    assert seen == {"batch1": 1, "batch2": 2}


def test_whole_pipeline(spark, tmp_path):
    specs = {}
    for k in (1, 2):
        raw(k).to_parquet(tmp_path / f"raw{k}.parquet")
        spec = {"input_paths": [str(tmp_path / f"raw{k}.parquet")], "global_channel": "all", "ovwt_min_cells": 20, "ovwt_downsample_wt": 100, "run_check_barcodes": True, "single_cell_scores_split": "train", "run_barcode_filtered_ovwt": False, "wtvwt_min_cells_per_barcode": 5, "wtvwt_max_barcodes": 2}
        (tmp_path / f"b{k}.yaml").write_text(yaml.safe_dump(spec))
        specs[f"b{k}"] = str(tmp_path / f"b{k}.yaml")
    (tmp_path / "bad.yaml").write_text(yaml.safe_dump({"input_paths": ["nowhere.parquet"]}))
    specs["bad"] = str(tmp_path / "bad.yaml")
    out = str(tmp_path / "out")
    state = pipeline.run(spark, specs, out, {"global_channels": ["all"], "feature_select_types": ["mean", "KS"], "feature_select_bootstrap_reps": 2})
    assert state["b1"] == state["b2"] == state["channel all"] == "ok" and state["bad"] != "ok"
    z = spark.read.parquet(f"{out}/normalized/b1.parquet").where(f"{LABEL} = 'WT'")
    assert abs(z.agg(F.avg("Cells_Intensity_Mean")).first()[0]) < 1e-9
    assert {r.key for r in spark.read.parquet(f"{out}/models/b1/ovwt").collect()} == {"A1A", "A2A", "M1K"}
    parts = spark.read.parquet(f"{out}/models/b1/ovwt_splits")
    n = {(r[LABEL], r.split): r["count"] for r in parts.groupBy(LABEL, "split").count().collect()}
    assert {r.key: (r.n_train, r.n_eval, r.n_test) for r in spark.read.parquet(f"{out}/models/b1/ovwt").collect()} == {k: tuple(n["WT", s] + n[k, s] for s in ("train", "eval", "test")) for k in ("A1A", "A2A", "M1K")}
    scored = spark.read.parquet(f"{out}/models/b1/cell_scores")
    ids = ["meta_source_file", "meta_source_file_idx"]
    assert scored.count() == scored.join(parts.where("split = 'train'"), ids, "left_semi").count() == sum(k for (_, s), k in n.items() if s == "train")
    assert spark.read.parquet(f"{out}/models/b1/tukey").count() > 0
    assert spark.read.parquet(f"{out}/global/all/anova").where("p_value BETWEEN 0 AND 1").count() == 3
    assert "meta_impact_score" in spark.read.parquet(f"{out}/features/b1/profiles").columns
    w = spark.read.parquet(f"{out}/global/all/corrected").where(f"{LABEL} = 'WT'").groupBy(BATCH).agg(F.avg("Cells_AreaShape_Area").alias("m")).collect()
    assert abs(w[0].m - w[1].m) < 1e-9
    ids = ["meta_source_file", "meta_source_file_idx"]
    halves = spark.read.parquet(f"{out}/features/b1/half_index")
    assert halves.groupBy(*ids, "seed").count().where("count <> 1").isEmpty() and {r[0] for r in halves.select("half").distinct().collect()} == {1, 2}
    assert {r.seed for r in spark.read.parquet(f"{out}/features/b1/correlations").select("seed").distinct().collect()} == {0, 1}
    for name in ("ovwt_importance", "wtvwt_importance"):
        assert spark.read.parquet(f"{out}/models/b1/{name}").count() > 0
    assert spark.read.parquet(f"{out}/global/all/corrector_stats").count() == 8 and spark.read.parquet(f"{out}/global/all/batch_vs_batch_importance").count() > 0
    assert "batch b1: ok" in (tmp_path / "out/logs/b1.log").read_text() and "failed" in (tmp_path / "out/logs/bad.log").read_text()


def test_a_channel_says_what_it_lacks(spark, tmp_path, monkeypatch):
    specs = {}
    for name, path in (("good", "raw.parquet"), ("bad", "nowhere.parquet")):
        (tmp_path / f"{name}.yaml").write_text(yaml.safe_dump({"input_paths": [str(tmp_path / path)], "global_channel": "all", "run_ovwt": False, "run_wtvwt": False, "run_feature_selection": False}))
        specs[name] = str(tmp_path / f"{name}.yaml")
    raw(1).to_parquet(tmp_path / "raw.parquet")
    monkeypatch.setattr(pipeline, "channel_stage", lambda *a: {})
    state = pipeline.run(spark, specs, str(tmp_path / "out"), {"global_channels": ["all"]})
    assert state["good"] == "ok" and state["bad"] != "ok" and state["channel all"] == "incomplete: without bad"


def test_late_values_of_a_csv_are_never_lost(spark, tmp_path):
    path = tmp_path / "late.csv"
    path.write_text("a,b\n" + "".join(f"{i},x\n" for i in range(200)) + "1.5,y\n2.5,z\n")
    assert dict(readers.read_table(spark, str(path)).dtypes)["a"] == "bigint"
    with pytest.raises(Exception, match="MALFORMED"):
        readers.read_table(spark, str(path)).collect()
    assert readers.read_table(spark, str(path), None).agg(F.sum("a")).first()[0] == pytest.approx(sum(range(200)) + 4)
    path.write_text("a,b\n1_000,x\n")
    assert [r.a for r in readers.read_table(spark, str(path)).collect()] == ["1_000"]


def test_stages_one_by_one(spark, tmp_path):
    raw(1).to_parquet(tmp_path / "b1.parquet")
    (tmp_path / "b1.yaml").write_text(yaml.safe_dump({"input_paths": [str(tmp_path / "b1.parquet")]}))
    at = lambda name: str(tmp_path / "o" / name)
    go = lambda name, **o: stages.run_stage(spark, name, output_dir=str(tmp_path / "o"), **o)
    go("input", batch_file=str(tmp_path / "b1.yaml"), table="raw")
    assert set(go("qcfilter", input_file=at("raw"), barcode_count_threshold=5, variant_barcode_count_threshold=2)) == {"cells", "barcode_counts", "variants_per_barcode"}
    go("normalize", input_file=at("cells"))
    go("generatesplit", input_file=at("normalized"), random_state=3)
    n = spark.read.parquet(at("normalized")).count()
    assert spark.read.parquet(at("half1")).count() + spark.read.parquet(at("half2")).count() == n
    for h in (1, 2):
        stages.run_stage(spark, "aggregatefeaturetype", output_root=at(f"h{h}"), aggregator="mean", input_file=at("normalized"), index_file=at(f"half{h}"))
    go("correlatefeatures", half1_file=at("h1.features"), half2_file=at("h2.features"))
    assert go("blocklist", input_files=[at("correlations")])["block_list"].count() == 3
    got = go("aggregate", aggregator="KS", input_file=at("normalized"))["aggregated"]
    assert {"meta_impact_score", "meta_num_cells", "Cells_Intensity_Mean_KS"} <= set(got.columns)
    found = go("ovwt", input_file=at("normalized"), min_cells=20, downsample_wt=100)
    assert {"origin_file", "row_idx"} <= set(found["splits"].columns) and found["importance"].count() > 0
    scored = go("ovwtcellscores", input_file=at("normalized"), models_file=at("models"))["cell_scores"]
    assert scored.count() == n
    index = found["splits"].where("split = 'test'").withColumn("origin_file", F.lit(at("normalized"))).limit(5)
    index.select("origin_file", "row_idx").coalesce(1).write.parquet(at("index"))
    assert readers.load_split(spark, at("index")).count() == 5
    go("checkbarcodes", input_file=at("cell_scores"))
    assert set(go("barcodeblocklist", input_file=at("tukey"))["block_list"].columns) == {"barcode", "p_adj", "barcode_ok"}
    assert (tmp_path / "o" / "ovwt.log").exists()
    with pytest.raises(ValueError):
        go("nope")
    with pytest.raises(ValueError):
        go("anova", input_file=at("normalized"), typo=1)
    assert len(stages.STAGES) == 22
