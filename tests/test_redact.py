import pytest
from pyspark.sql import functions as F

from corpusmill.operators import redact as RD


def test_pattern_and_replacement_translation():
    assert RD.java_pattern(r"(?P<n>a)(?P=n)\Z", ["IGNORECASE"]) == r"(?dUi)(?<n>a)\k<n>\z"
    assert RD.java_replacement(r"<\1>-\g<name>-$5-\n") == "<$1>-${name}-\\$5-\n"
    with pytest.raises(ValueError):
        RD.java_pattern("x", ["BOGUS"])
    with pytest.raises(ValueError):
        RD.load_policy({"drop_keys": ["id"]})
    with pytest.raises(ValueError):
        RD.load_policy({"rules": [{"replacement": "x"}]})
    with pytest.raises(ValueError):
        RD.load_policy({"drop_keys": "title"})


def test_apply_policy_every_depth(spark):
    df = spark.createDataFrame(
        [("id-1", "Harbor Games title", {"language": "py", "title": "Tide Pool"}, [{"name": "salt flat", "title": "t"}],
          {"contest": "HarborGames", "note": "harbor games"})],
        "id string, text string, artifacts struct<language:string,title:string>, "
        "tags array<struct<name:string,title:string>>, meta map<string,string>")
    policy = RD.load_policy({
        "drop_keys": ["title", "contest"],
        "rules": [{"pattern": "(?i)harbor[ -]?games", "replacement": "<EVENT>"},
                  {"pattern": "(?i)tide[ -]?pool|salt[ -]?flat", "replacement": "<TASK>"},
                  {"pattern": r"(\d+)$", "replacement": r"#\1"}]})
    out = RD.apply_policy(df, policy).collect()[0].asDict(recursive=True)
    assert out == {"id": "id-#1", "text": "<EVENT> title", "artifacts": {"language": "py"},
                   "tags": [{"name": "<TASK>"}], "meta": {"note": "<EVENT>"}}
    dropped = RD.drop_metadata(df, keep=("id",)).columns
    assert dropped == ["id", "text", "artifacts", "tags", "meta"]
    assert "title" not in RD.drop_metadata(df).schema["artifacts"].dataType.fieldNames()
