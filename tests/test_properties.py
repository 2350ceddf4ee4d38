"""Property: best per child computed from parts equals ranking the full expansion,
on random small inputs with ties, NULL years, duplicate child rows and NULL children."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from bomspark import schemas as S
from bomspark.operators import (best_per_child, best_per_child_from_parts, expand_children,
                                latest_per_key)

keys = st.sampled_from(["K1", "K2", "K3", "K4"])
opts = st.sampled_from(["O1", "O2", "O3", "O4", "O5"])
years = st.one_of(st.none(), st.integers(2018, 2021))
counts = st.integers(1, 3)
rollup_rows = st.lists(st.tuples(counts, opts, keys, years), min_size=1, max_size=25)
child_rows = st.lists(st.tuples(opts, st.one_of(st.none(), st.sampled_from(["C1", "C2", "C3"]))),
                      min_size=1, max_size=15)


@settings(max_examples=10, deadline=None,
          suppress_health_check=[HealthCheck.function_scoped_fixture, HealthCheck.too_slow])
@given(rollup_rows, child_rows)
def test_best_from_parts_equals_ranked_expansion(spark, rrows, crows):
    rollup = spark.createDataFrame([(c, o, k, y) for c, o, k, y in rrows], S.ROLLUP)
    child = spark.createDataFrame(crows, S.CHILD_PART_OPTION)
    latest = latest_per_key(rollup)
    fast = best_per_child_from_parts(rollup, latest, child)
    slow = best_per_child(expand_children(rollup, latest, child))
    key = lambda t: tuple("" if v is None else str(v) for v in t)
    a = sorted((tuple(r) for r in fast.collect()), key=key)
    b = sorted((tuple(r) for r in slow.collect()), key=key)
    assert a == b
