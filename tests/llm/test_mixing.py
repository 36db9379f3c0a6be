"""Water-filling against rounds of clamping, and the sample against its contract."""

import re
from collections import defaultdict

from pyspark.sql import functions as F

from motionloom.llm import mixing


def filled(sizes, weights, most):
    """Targets by rounds: clamp whatever is above its cap, share the rest, until nothing is above."""
    total, capped = sum(sizes.values()), set()
    while True:
        free = [s for s in sizes if s not in capped]
        rest = total - sum(most * sizes[s] for s in capped)
        whole = sum(weights[s] for s in free)
        above = [s for s in free if rest * weights[s] / whole > most * sizes[s]]
        if not above:
            return {s: most * sizes[s] if s in capped else rest * weights[s] / whole for s in sizes}
        capped |= set(above)


def held(rows, got, weights=(5, 2, 1), most=3):
    """What any mix must keep; returns the taken words by source."""
    count = lambda t: len(re.findall("[^\x20\x09-\x0d]+", t or ""))
    sizes = defaultdict(int)
    for _, text, source in rows:
        sizes[source] += count(text)
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    want = filled(sizes, {s: weights[i % len(weights)] for i, s in enumerate(names)}, most)
    assert sorted(map(str, ((i, count(t)) for i, t, _ in rows))) == sorted(map(str, ((r.doc_id, r.size) for r in got)))
    taken = defaultdict(int)
    for r in got:
        assert r.source_size == sizes[r.source] and abs(r.target - want[r.source]) <= 1e-9 * max(1, want[r.source])
        assert 0 <= r.taken <= most * r.size and r.taken == r.repeats * r.size + r.part and 0 <= r.part <= r.size
        taken[r.source] += r.taken
    return {s: (taken[s], want[s]) for s in names}


def test_mix(spark):
    rows = [(i, "w " * (i % 7), "hot") for i in range(900)]
    rows += [(1000 + i, " \t\n" + "long " * (5000 if i == 3 else 2), f"s{i % 4}") for i in range(60)]
    rows += [(2000, "a b c\x0bd", None), (2001, None, None), (2002, "", "empty"), (2003, " \n ", "empty"), (2004, "ü ж", "é"), (2005, "one", "Z")]
    df = spark.createDataFrame([(*r, 0, 1) for r in rows], "doc_id bigint, text string, source string, size int, `lot` int")
    got = mixing.mix(df).collect()
    for s, (taken, want) in held(rows, got).items():
        assert abs(taken - want) <= 1, s
    assert sorted(map(str, got)) == sorted(map(str, mixing.mix(df.repartition(5)).collect()))
    assert sorted(map(str, got)) != sorted(map(str, mixing.mix(df, seed=7).collect()))
    assert sum(r.part > 0 for r in got) <= 9  # at most one document of a source is cut


def test_border_in_the_middle_of_slices(spark, monkeypatch):
    monkeypatch.setattr(mixing, "MOST_BROADCAST", 0)
    rows = [(i, "w " * (1 + i % 5), "abc"[i % 3]) for i in range(700)]
    got = mixing.mix(spark.createDataFrame(rows, "doc_id bigint, text string, source string")).collect()
    for taken, want in held(rows, got).values():
        assert abs(taken - want) <= 1


def test_rows_without_id_and_repeats(spark):
    rows = [(None, "a b c", "x")] * 200 + [(7, "a b c d", "x")] * 100 + [(i, "q", "y") for i in range(50)]
    got = mixing.mix(spark.createDataFrame(rows, "doc_id bigint, text string, source string")).collect()
    for taken, want in held(rows, got).values():
        assert want - 200 < taken <= want + 1  # the border's copies share it, each rounded down


def test_empty(spark):
    docs = spark.createDataFrame([], "doc_id bigint, text string, source string")
    assert mixing.mix(docs).count() == 0
    nothing = spark.createDataFrame([(1, None, "a"), (2, "  ", None)], docs.schema)
    assert [(r.target, r.taken) for r in mixing.mix(nothing).collect()] == [(0.0, 0)] * 2


def test_no_python_in_the_plan(spark, sf):
    plan = mixing.op11_mixing(spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "CartesianProduct" not in plan
    assert mixing.word_count(F.col("x")) is not None
