"""Bucket-first KPIs equal the windowed aggregate on arbitrary inputs."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from squall.functions.parse import event_time
from squall.operators.kpi import KpiWindow, streaming_kpis, window_kpis
from squall.plans import fixtures as fx

from .conftest import SF_SMALL

row = st.tuples(
    st.sampled_from(["a", "b", None]),
    st.one_of(st.none(), st.integers(1735500000, 1735600000)),
    st.one_of(st.none(), st.integers(0, 4000).map(lambda x: x / 100)),
    st.one_of(st.none(), st.integers(0, 6000).map(lambda x: x / 100)),
)
SCHEMA = "location_id string, forecast_time long, wind_speed_10m double, wind_gusts_10m double"


@settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))
@given(rows=st.lists(row, min_size=1, max_size=30), hours=st.sampled_from([1, 3, 6]))
def test_bucket_first_equals_window(spark, rows, hours):
    df = spark.createDataFrame(rows, SCHEMA)
    spec = KpiWindow(f"{hours} hours", "10 minutes", 25.0)
    a = sorted(window_kpis(df, spec).collect(), key=repr)
    b = sorted(streaming_kpis(df.where("forecast_time is not null").withColumn("event_time", event_time("forecast_time")), spec).collect(), key=repr)
    assert a == b


def test_bucket_first_equals_window_on_events(spark):
    df = fx.wx(spark, SF_SMALL)
    for spec in (KpiWindow("3 hours", "10 minutes"), KpiWindow("6 hours", "10 minutes")):
        a = window_kpis(df, spec)
        b = streaming_kpis(df.withColumn("event_time", event_time("forecast_time")), spec)
        assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
