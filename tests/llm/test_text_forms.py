"""Canonical forms against the Unicode database, character by character."""

import unicodedata

import pytest

from gridloom.llm import text_forms as tf
from tests.conftest import rows


def forms(spark, names):
    df = spark.createDataFrame(list(enumerate(names)), "i int, name string")
    return [r[0] for r in tf.with_canonical(df, "name").orderBy("i").select("canonical").collect()]


@pytest.mark.parametrize(
    ("stored", "form"),
    [
        ("Ｍｉｃａｈ Ｄｕｎ", "Micah Dun"), ("José Ruiz", "José Ruiz"), ("A​n­d⁠y﻿ X", "Andy X"), ("Ann Lee", "Ann Lee"),
        ("Місаһ Dun", "Micah Dun"), ("Jeﬀ Ⅳ", "Jeff IV"), ("O’Neil‐Roe", "O'Neil-Roe"), ("ꓟalik", "Malik"), ("Τrey", "Trey"),
        ("José Ruiz", "José Ruiz"), ("Глеб Буржашев", "Глеб Буржашев"), ("Zoë  Two", "Zoë  Two"), ("", ""), (None, None),
    ],
)
def test_forms(spark, stored, form):
    assert forms(spark, [stored]) == [form]


def test_every_single_form_agrees_with_the_unicode_database(spark):
    one, many = tf.compatibility_forms()
    odd = [c for c in one if unicodedata.normalize("NFKC", c) == one[c] and one[c].isalpha()]
    found = forms(spark, [f"Ab{c}" for c in odd])
    assert found == [unicodedata.normalize("NFC", f"Ab{tf.LOOK_ALIKES.get(one[c], one[c])}") for c in odd]
    assert forms(spark, [f"x{c}y" for c in many]) == [f"x{f}y" for f in many.values()]
    assert all(len(b) == 1 for b in tf.LOOK_ALIKES.values()) and len(tf.LOOK_ALIKES) < 200


def test_canonical_forms_are_stable(spark):
    once = forms(spark, ["Ｍіс́ah ​X", "Łukasz", "Wójt Ⅲ"])
    assert forms(spark, once) == once


def test_mixed_scripts_long_texts_and_clashing_columns(spark):
    long = "é" * 100_000 + "​"
    df = spark.createDataFrame([(1, "Abж", "k", "s"), (2, long, None, "s"), (2, long, None, "s")], "x int, name string, c0 string, odd string")
    found = tf.with_canonical(df, "name")
    assert rows(found.where("x = 1"), "mixed_script", "c0", "odd") == [(True, "k", "s")]
    assert {r[0] for r in found.where("x = 2").select("canonical").collect()} == {"é" * 100_000}
    assert found.count() == 3
    assert tf.with_canonical(df.where("x = 9"), "name").count() == 0
    with pytest.raises(ValueError, match="already"):
        tf.with_canonical(df.withColumnRenamed("odd", "canonical"), "name")
