import pytest
from pyspark.sql import functions as F

from linepareto.functions.text import icontains, key_after, short_pair_name


def value(spark, text, expression):
    return spark.createDataFrame([(text,)], "s string").select(expression(F.col("s")).alias("v")).first().v


@pytest.mark.parametrize("text, key", [
    ("Gripper not in work pos Key [ G12 ] ", "G12"), ("Gripper without", ""),
    ("lower key [ G1 ]", ""), ("Key [A] and Key [B]", "A] and"), (None, None)])
def test_key_after(spark, text, key):
    assert value(spark, text, key_after) == key


@pytest.mark.parametrize("text, short", [
    ("U1-L2 xx & V3-L4 yy", "U1-L2 & V3-L4"), ("U1-L2", "U1-L2 & 1-L2"), (None, None)])
def test_short_pair_name(spark, text, short):
    assert value(spark, text, short_pair_name) == short


@pytest.mark.parametrize("text, found", [
    ("x assembly ERROR : plate TASK[301].", True), ("Assembly error Task301", False), (None, None)])
def test_brackets_are_literal(spark, text, found):
    assert value(spark, text, lambda c: icontains(c, "Assembly error%Task[301]")) == found
