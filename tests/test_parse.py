"""Feature parsing, last-token-wins, strict and lenient modes."""

import pytest

from itemwise.functions import parse_feature
from itemwise.operators import explode_history, last_preference
from pyspark.sql import functions as F


def _feats(spark, rows):
    return spark.createDataFrame(rows, "user_id string, feature string")


def test_parse_positions_and_empty_tokens(spark):
    df = explode_history(_feats(spark, [("a", "12:3  7:1 "), ("b", "")]))
    assert sorted(map(tuple, df.collect())) == [("a", 0, 12, 3), ("a", 1, 7, 1)]


def test_last_token_wins(spark):
    df = last_preference(explode_history(_feats(spark, [("a", "1:5 2:3 1:9")])))
    assert sorted(map(tuple, df.collect())) == [("a", 1, 9), ("a", 2, 3)]


def test_nested_form(spark):
    row = _feats(spark, [("a", "4:2 5:1")]).select(parse_feature(F.col("feature")).alias("h")).first()
    assert [(e.item, e.pref) for e in row.h] == [(4, 2), (5, 1)]


@pytest.mark.parametrize("bad", ["x:1", "3", "3:", ":4", "3:y"])
def test_strict_raises(spark, bad):
    with pytest.raises(Exception, match="bad feature token"):
        explode_history(_feats(spark, [("a", f"1:1 {bad}")])).collect()


def test_lenient_drops(spark):
    df = explode_history(_feats(spark, [("a", "1:1 x:1 3 2:2")]), lenient=True)
    assert sorted((r.item, r.pref) for r in df.collect()) == [(1, 1), (2, 2)]


def test_item_as_string(spark):
    df = explode_history(_feats(spark, [("a", "007:1")]), item_as_string=True)
    assert df.first().item == "007"
