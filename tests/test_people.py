"""People that arrive by several ids, held against an upsert by hand."""

import random

import pytest

from tidemark.operators import people


def by_hand(pairs):
    """Components of (node, key) pairs by union-find."""
    up = {}

    def top(x):
        while up.setdefault(x, x) != x:
            x = up[x]
        return x

    for node, key in pairs:
        top(("n", node))
        if key is not None:
            a, b = top(("n", node)), top(("k", key))
            up[max(a, b, key=lambda t: (t[0] == "k", t))] = min(a, b, key=lambda t: (t[0] == "k", t))
    groups = {}
    for node in {n for n, _ in pairs}:
        groups.setdefault(top(("n", node)), set()).add(node)
    return {n: min(g) for g in groups.values() for n in g}


@pytest.mark.parametrize("seed", [1, 2])
def test_components(spark, seed):
    rng = random.Random(seed)
    pairs = [(n, None) for n in range(300, 310)] + [(n, f"k{rng.randrange(90)}") for n in range(120)] + [(n, "hot") for n in range(500, 560)]
    pairs += [(n, f"chain{n}") for n in range(600, 640)] + [(n, f"chain{n + 1}") for n in range(600, 640)]
    df = spark.createDataFrame(pairs, "node bigint, key string")
    assert {r.node: r.label for r in people.components(df).collect()} == by_hand(pairs)
    assert people.components(df.limit(0)).collect() == []


def run(spark, stored, arrivals):
    s, a = spark.createDataFrame(stored, people.STORED), spark.createDataFrame(arrivals, people.ARRIVALS)
    after, of = people.upsert_people(s, a)
    return sorted(tuple(r) for r in after.collect()), {r.ord: r.person_id for r in of.collect()}


def test_by_imdb_then_both_then_tmdb_is_one_person(spark):
    after, of = run(spark, [], [(1, "metadata", None, "tt0000001", "Ann", "{}"), (2, "metadata", 7, " TT0000001 ", "", "{}"), (3, "metadata", 7, "", "Ann Lee", '{"a":1}')])
    assert after == [(2, 7, "tt0000001", "Ann Lee", '{"a":1}')] and of == {1: 2, 2: 2, 3: 2}


def test_paths(spark):
    stored = [(10, None, None, "Bo  Ray", "{}"), (11, 5, "tt0000005", "Cy", "{}"), (12, None, "tt0000009", "Cy", "{}")]
    arrivals = [
        (1, "credits", 70, "tt0000005", "bo ray", "{}"),  # credits' imdb ids don't count; joins Bo by name and fills the tmdb id
        (2, "credits", 71, None, "BO RAY", "{}"),  # by name too: the id that stands stays
        (3, "metadata", 6, "tt0000005", None, "{}"),  # metadata replace the id
        (4, "metadata", None, None, "Cy", "{}"),  # a name alone is a new person
        (5, "credits", None, None, "cy", "{}"),  # the lowest number of that name
        (6, "credits", 99, None, None, "{}"),  # no name in credits: left out
        (7, "metadata", None, "", " ", "{}"),  # says nobody
        (8, "credits", 80, None, "Dee", "{}"), (9, "credits", 81, None, "dee", "{}"),  # two of one name that only credits know
    ]
    after, of = run(spark, stored, arrivals)
    assert after == [(10, 70, "", "BO RAY", "{}"), (11, 6, "tt0000005", "cy", "{}"), (12, None, "tt0000009", "Cy", "{}"), (17, None, "", "Cy", "{}"), (21, 80, "", "dee", "{}")]
    assert of == {1: 10, 2: 10, 3: 11, 4: 17, 5: 11, 8: 21, 9: 21}


def test_two_stored_people_become_one(spark):
    s = spark.createDataFrame([(1, 5, None, "A", "{}"), (2, None, "tt0000002", "B", "{}")], people.STORED)
    a = spark.createDataFrame([(1, "metadata", 5, "tt0000002", "AB", "{}")], people.ARRIVALS)
    linked = people.link_people(s, a)
    assert [tuple(r) for r in people.replaced_numbers(s, linked).collect()] == [(2, 1)]
    assert [tuple(r) for r in people.upsert_people(s, a)[0].collect()] == [(1, 5, "tt0000002", "AB", "{}")]
    assert [tuple(r) for r in people.upsert_people(s, a.limit(0))[0].orderBy("person_id").collect()] == [(1, 5, "", "A", "{}"), (2, None, "tt0000002", "B", "{}")]
    assert people.upsert_people(s.limit(0), a.limit(0))[0].collect() == []
