"""First arrivals with null and equal order values, against a plain loop."""
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from transitlab.operators import quality

ROWS = st.lists(st.tuples(st.sampled_from(["a", "b", None]), st.sampled_from([1, 2, None]), st.one_of(st.none(), st.integers(0, 3)),
                          st.one_of(st.none(), st.integers(0, 2))), min_size=1, max_size=12)


def first_rows(rows):
    """(vehicle, time) -> the row with the smallest order; null orders last, then the value with null first."""
    best = {}
    for v, t, order, value in rows:
        rank = (order is None, order or 0, value is not None, value or 0)
        if (v, t) not in best or rank < best[v, t][0]:
            best[v, t] = rank, (v, t, order, value)
    return sorted((r for _, r in best.values()), key=repr)


@settings(max_examples=25, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(ROWS)
def test_first_per_key_equals_a_loop(spark, rows):
    df = spark.createDataFrame(rows, "vehicle_id string, timestamp int, event_id int, latitude int").repartition(3)
    got = quality.first_per_key(df, ["vehicle_id", "timestamp"], "event_id").collect()
    # rows whose order is null are settled by their values, the order column standing with the row
    assert sorted(map(tuple, got), key=repr) == first_rows(rows)
