"""Free-form values: strict mode and policies reach every depth, defaults merge."""

import json

from pyspark.sql import functions as F

from corpusmill.functions import freeform as FF
from corpusmill.operators import redact as RD
from corpusmill.plans import jobs as JB


def _build(spark, tmp_dir, rows, defaults=None, **kw):
    import os

    os.makedirs(f"{tmp_dir}/m", exist_ok=True)
    with open(f"{tmp_dir}/m/a.json", "w") as f:
        json.dump({"defaults": defaults or {}, "records": [{"path": "../q.jsonl", "format": "jsonl_qa"}]}, f)
    with open(f"{tmp_dir}/q.jsonl", "w") as f:
        f.writelines(json.dumps(r) + "\n" for r in rows)
    return JB.build_dataset(spark, f"{tmp_dir}/m", tmp_dir, **kw)


def _qa(i, **more):
    return {"id": i, "prompt": "p", "answer": "a", **more}


def test_strict_mode_reaches_keys_of_mixed_types(spark, tmp_dir):
    rows = [_qa("i", notes={"title": "Harbor secret", "kept": {"title": "Harbor", "n": 1}}), _qa("j", notes="plain"),
            _qa("k", notes=[{"event_name": "Harbor", "x": [{"title": "Harbor"}, 2.50]}]), _qa("l", notes=None)]
    res = _build(spark, tmp_dir, rows, strict_anonymize=True)
    out = f"{tmp_dir}/out"
    JB.write_dataset(res, out)
    text = "".join(r.value for r in spark.read.text(f"{out}/samples").collect())
    assert "Harbor" not in text and "title" not in text
    notes = sorted(json.dumps(json.loads(r.value).get("notes")) for r in spark.read.text(f"{out}/samples").collect())
    assert notes == sorted(['{"kept": {"n": 1}}', '"plain"', '[{"x": [{}, 2.5]}]', "null"])


def test_policy_masks_free_values(spark, tmp_dir):
    policy = RD.load_policy({"drop_keys": ["k"], "rules": [{"pattern": "se(cret)", "replacement": r"<\1>", "flags": ["IGNORECASE"]}]})
    rows = [_qa("i", notes={"a": ["SECRET"], "k": 1}), _qa("j", notes="no secret")]
    got = {json.loads(r.t) if r.t.startswith('"') else r.t for r in
           _build(spark, tmp_dir, rows, policy=policy).samples.select(F.to_json("notes").alias("t")).collect()}
    assert got == {'{"a":["<CRET>"]}', "no <cret>"}


def test_lists_and_maps_around_free_values_are_walked(spark):
    df = spark.range(1).select(F.array(F.parse_json(F.lit('{"title": 1, "b": "x"}'))).alias("l"),
                               F.create_map(F.lit("m"), F.parse_json(F.lit('"x"'))).alias("m"),
                               F.struct(F.parse_json(F.lit("[1.0, 1e3, 12345678901234567890]")).alias("v")).alias("s"))
    policy = RD.load_policy({"drop_keys": ["title"], "rules": [{"pattern": "x", "replacement": "y"}]})
    row = RD.apply_policy(df, policy).select(F.to_json("l"), F.to_json("m"), F.to_json("s.v")).first()
    assert tuple(row) == ('[{"b":"y"}]', '{"m":"y"}', "[1,1000,12345678901234567890]")


def test_nulls_of_a_record_win_over_defaults(spark, tmp_dir):
    defaults = {"category": "web", "meta": {"a": 1, "b": {"c": {"d": 2, "e": 3}}}}
    rows = [_qa("i", meta={"b": {"c": {"d": None}}}, category=None), _qa("j", meta=None), _qa("k", meta="text"), _qa("l")]
    res = _build(spark, tmp_dir, rows, defaults)
    JB.write_dataset(res, f"{tmp_dir}/out")
    got = {r["id"]: r for r in (json.loads(x.value) for x in spark.read.text(f"{tmp_dir}/out/samples").collect())}
    assert got["i"]["meta"] == {"a": 1, "b": {"c": {"d": None, "e": 3}}} and got["i"]["category"] is None
    assert got["j"]["meta"] is None and got["k"]["meta"] == "text"
    assert got["l"]["meta"] == defaults["meta"] and got["l"]["category"] == "web"


def test_merge_knows_absent_from_null(spark):
    over, base = F.parse_json(F.lit('{"a": null, "b": {"x": 1}, "c": [1]}')), F.parse_json(F.lit('{"a": 1, "b": {"y": {"z": 2}}, "c": {"q": 1}, "d": 4}'))
    depth = FF.depth_of({"a": 1, "b": {"y": {"z": 2}}, "c": {"q": 1}})
    text = spark.range(1).select(F.to_json(FF.merge_values(over, base, depth))).first()[0]
    assert json.loads(text) == {"a": None, "b": {"x": 1, "y": {"z": 2}}, "c": [1], "d": 4} and depth == 3
