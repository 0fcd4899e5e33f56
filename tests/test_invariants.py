"""Relations that hold for any edits."""

from datetime import timedelta

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from editpulse.operators import gold, upsert
from helpers import at, rows_of, silver_df

edits = st.lists(
    st.tuples(
        st.integers(0, 30),
        st.integers(0, 24 * 60 * 60),
        st.fixed_dictionaries(
            {
                "user_id": st.none() | st.integers(1, 5),
                "is_bot": st.none() | st.booleans(),
                "bytes_diff": st.none() | st.integers(-(2**31), 2**31 - 1),
                "page_title": st.sampled_from("PQR"),
            }
        ),
    ),
    min_size=1,
    max_size=40,
    unique_by=lambda edit: edit[0],
)

few = settings(
    max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)


def to_silver(spark, rows):
    return silver_df(spark, [(str(i), at(seconds / 60), extra) for i, seconds, extra in rows])


@few
@given(rows=edits)
def test_kpi_relations(spark, rows):
    kpis = gold.window_kpis(to_silver(spark, rows)).collect()
    assert sum(k.total_edits for k in kpis) == len(rows)
    for k in kpis:
        assert k.window_end - k.window_start == timedelta(minutes=5)
        assert k.bot_edits + k.human_edits == k.total_edits
        assert 0 <= k.revert_like_edits <= k.large_edits_count <= k.total_edits
        assert k.unique_editors <= k.total_edits and 1 <= k.active_pages <= k.total_edits
        if k.net_bytes_added is not None:
            assert abs(k.net_bytes_added) <= k.volatility_score


@few
@given(old=edits, new=edits)
def test_upsert_is_a_map_update(spark, old, new):
    target, source = to_silver(spark, old), to_silver(spark, new)
    once = upsert.merge(target, source)
    assert {r.event_id for r in once.collect()} == {str(e[0]) for e in [*old, *new]}
    assert rows_of(upsert.merge(once, source)) == rows_of(once)
    kept = once.join(source, "event_id", "left_anti")
    assert rows_of(kept) == rows_of(target.join(source, "event_id", "left_anti"))
