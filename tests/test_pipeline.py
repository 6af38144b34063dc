from __future__ import annotations

import pytest
from glyphloom.config import DEFAULT, PRODUCTION, Config
from glyphloom.plans import pipeline
from glyphloom.plans import views as V
from glyphloom.session import table
from glyphloom.sources.adapters import Given


def test_settings():
    assert DEFAULT.signature() == Config().signature() != PRODUCTION.signature()
    with pytest.raises(ValueError):
        Config(anchor_conflict_overlap=1.5)
    with pytest.raises(ValueError):
        Config(anchors_per_node=0)


def test_settings_from_the_environment():
    got = Config.from_environment({"GLYPHLOOM_TEXT_MERGE_ENABLED": "1", "GLYPHLOOM_MERGING_GAP": "2.5", "GLYPHLOOM_ANCHORS_PER_NODE": " 7 ", "GLYPHLOOM_REGION_BONUS": "", "OTHER": "x"}, PRODUCTION)
    assert got.text_merge_enabled and got.merging.gap == 2.5 and got.anchors_per_node == 7 and got.region_bonus == PRODUCTION.region_bonus
    assert got.metadata()["merging"]["gap"] == 2.5 and Config.from_environment({}) == DEFAULT
    with pytest.raises(ValueError):
        Config.from_environment({"GLYPHLOOM_ANCHORS_PER_NODE": "0"})


def test_changed_inputs_name_other_stages(spark, tmp_path):
    path = str(tmp_path / "in")
    spark.range(3).write.parquet(path)
    first = pipeline.inputs_signature(spark, (spark.read.parquet(path),))
    assert first == pipeline.inputs_signature(spark, (spark.read.parquet(path),))
    spark.range(4).write.mode("overwrite").parquet(path)
    assert first != pipeline.inputs_signature(spark, (spark.read.parquet(path),))


def test_adapters_conform(spark):
    df = spark.createDataFrame([("i", "n", "extra", "0.5")], "image_id string, node_id string, more string, confidence string")
    got = Given({"readings": df}).table(spark, "readings")
    assert got.columns == ["image_id", "node_id", "model_name", "text", "confidence", "rotation"]
    assert got.first().confidence == 0.5 and got.first().text is None


@pytest.mark.parametrize("config", [DEFAULT, PRODUCTION], ids=["default", "production"])
def test_stages(spark, sf, tmp_path, config):
    detections = V.nodes(spark, sf).select("image_id", "node_id", "box", "polygon", "image_width", "image_height")
    stages = pipeline.Stages(spark, str(tmp_path), config)
    readings, anchors = table(spark, sf, "readings"), V.anchors(spark, sf)
    out = pipeline.run(stages, detections, readings, anchors)
    rows = out.collect()
    assert len(rows) > 10 and len({r.tuple_id for r in rows}) == len(rows)
    assert all(r.competing_tuples >= 0 and r.anchor_label for r in rows)
    nodes = {(r.image_id, r.node_id) for r in stages.stage("text_nodes", None).collect()}
    assert all((r.image_id, n) in nodes for r in rows for n in r.text_node_ids)
    assert sorted(map(str, pipeline.run(stages, detections, readings, anchors).collect())) == sorted(map(str, rows))
