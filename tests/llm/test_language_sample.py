"""op4's training sample: every language has its share, whatever the table holds besides."""

import collections

from tidemark.llm import langid


def test_rare_languages_are_drawn(spark):
    rows = [(k, f"common words {k}", "aa") for k in range(3000)] + [(5000 + k, f"rare words {k}", "bb") for k in range(40)] + [(6000 + k, f"some words {k}", "cc") for k in range(600)]
    rows += [(10_000 + k, f"no language {k}", None) for k in range(6000)]
    got = collections.Counter(r.lang for r in langid.training_rows(spark.createDataFrame(rows, "doc_id bigint, text string, lang string"), 300).collect())
    assert 20 <= got["bb"] <= 40 and all(80 <= got[x] <= 190 for x in ("aa", "cc"))


def test_copies_are_drawn_by_row(spark):
    df = spark.createDataFrame([(k, f"one text for all {k % 3}", "aa") for k in range(5000)], "doc_id bigint, text string, lang string")
    got = collections.Counter(r.text for r in langid.training_rows(df, 300).collect())
    assert len(got) == 3 and all(60 <= n <= 140 for n in got.values())


def test_rates():
    assert langid.rates_of({"a": 5, "b": 5}, 20) == {"a": 1.0, "b": 1.0}
    assert langid.rates_of({"a": 1000, "b": 4, "c": 500}, 24) == {"a": 0.01, "b": 1.0, "c": 0.02}
    assert langid.rates_of({}, 5) == {}
