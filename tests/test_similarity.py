"""The similarity join leaves out no pair: against all pairs, scored one by one."""

import random
from difflib import SequenceMatcher

import pytest
from pyspark.sql import functions as F

from tidemark.operators import similarity


def edit_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row, above = [i], row
        for j, y in enumerate(b, 1):
            row.append(min(above[j] + 1, row[-1] + 1, above[j - 1] + (x != y)))
    return row[-1]


def texts(rng, n, letters):
    out = ["".join(rng.choice(letters) for _ in range(rng.randint(1, 25))) for _ in range(n)]
    for _ in range(n):  # edited copies, around the thresholds
        t = list(rng.choice(out))
        for _ in range(rng.randint(0, max(1, len(t) // 4))):
            k = rng.randrange(len(t))
            t[k : k + rng.randint(0, 1)] = rng.choice(letters) * rng.randint(0, 1)
            t = t or ["q"]
        out.append("".join(t))
    return sorted(set(out))


SCORES = {"BLOCKS": lambda a, b: SequenceMatcher(None, a, b).ratio(), "EDITS": lambda a, b: 1 - edit_distance(a, b) / max(len(a), len(b))}


@pytest.mark.parametrize("name", list(SCORES))
@pytest.mark.parametrize("letters", ["ab", "abcdefghijklmnop é"])
def test_no_pair_is_lost(spark, name, letters):
    rng = random.Random(len(letters))
    left, right = [(t, rng.choice([0.82, 0.9, 0.92])) for t in texts(rng, 60, letters)], texts(rng, 60, letters)
    right = sorted({*right, *[t for t, _ in left[::3]], *[t[:-1] for t, _ in left[::2] if len(t) > 1]})
    ldf = spark.createDataFrame([("g", a, t) for a, t in left] + [("other", "lonely", 0.82), ("g", "", 0.82)], "grp string, a string, least double")
    rdf = spark.createDataFrame([("g", b) for b in right] + [("third", "lonely"), ("g", "")], "grp string, b string")
    got = {(r.a, r.b): r.similarity for r in similarity.similar_texts(ldf, rdf, getattr(similarity, name)).collect()}
    want = {(a, b): s for a, t in left for b in right if (s := 1.0 if a == b else SCORES[name](a, b)) >= t}
    assert len(want) > 50 and got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-9 for k in want)


def test_best_candidates_looks_at_the_whole_catalogue(spark):
    """The best is far behind in the catalogue; of equal ones the first counts; other types only with multi."""
    cat = [(k, k, f"Night Train {k:03d}", "", "", "movie") for k in range(200)] + [(900, 900, "Night Trains", "", "", "movie"), (901, 901, "Night Trains", "", "", "movie"), (902, 0, "Night Trains", "", "1999", "series")]
    catalogue = spark.createDataFrame(cat, "id int, pos int, title string, original_title string, year string, media string")
    q = spark.createDataFrame([(1, "Night Trains", "", "movie", "localized"), (2, "Nigth Trains", "1999", "movie", "localized"), (3, "", "", "movie", "x"), (4, "Ночной поезд", "", "movie", "x")], "query_id int, title string, year string, media string, label string")
    assert {r.query_id: r.id for r in similarity.best_candidates(q, catalogue).collect()} == {1: 900, 2: 900}
    assert {r.query_id: r.id for r in similarity.best_candidates(q, catalogue, multi=True).collect()} == {1: 900, 2: 902}
    russian = catalogue.limit(0).unionByName(spark.createDataFrame([(7, 0, "Nochnoy poezd", "", "", "movie")], catalogue.schema))
    assert [(r.query_id, r.id) for r in similarity.best_candidates(q, russian).collect()] == [(4, 7)]
    assert similarity.best_candidates(q, catalogue.limit(0)).collect() == []


def test_sanitized(spark):
    rows = [("found", " TT1234567 ", "omdb", "97", "o", [1], "7.1", "10"), ("found", "tt1234567", "omdb", None, "o", [1], "7.1", "10"), ("found", "tt1234567", "tmdb", "97", "", [1], None, None), ("found", "x", "omdb", "97", "o", None, "5", "5"), ("not_found", "", "tmdb", None, "", None, "5", "5")]
    df = spark.createDataFrame(rows, "status string, imdb_id string, resolver string, confidence string, overview string, genre_ids array<int>, rating string, votes string")
    got = [tuple(r) for r in similarity.sanitized(df).select("status", F.col("imdb_id"), "resolver", "rating", "votes", "legacy_imdb_id", "needs_display_refresh").collect()]
    assert got == [
        ("found", "tt1234567", "tmdb", None, None, "", False), ("legacy_unscored", "", "tmdb", None, None, "tt1234567", False),
        ("found", "tt1234567", "tmdb", None, None, "", True), ("found", "x", "omdb", "5", "5", "", True), ("not_found", "", "tmdb", "5", "5", "", False),
    ]
