"""Subscription analyses on a small hand-made log; every answer is worked out
by hand."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from fixtures import rows
from quarry.operators import states as S
from quarry.plans.standins import plans

D = dt.date.fromisoformat
K, T, ST = "customer_id", "start_date", "plan_id"

LOG = [  # 0 trial, 1 basic monthly, 2 pro monthly, 3 pro annual, 4 churn
    (1, 0, "2020-01-01"), (1, 1, "2020-01-08"), (1, 2, "2020-03-08"), (1, 4, "2020-05-20"), (1, 1, "2020-08-01"),
    (2, 1, "2020-01-31"),
    (3, 0, "2020-02-01"), (3, 2, "2020-02-08"), (3, 3, "2020-04-20"),
    (4, 0, "2020-03-01"), (4, 4, "2020-03-08"),
]


@pytest.fixture(scope="module")
def subs(spark):
    return spark.createDataFrame([(c, p, D(d), i) for i, (c, p, d) in enumerate(LOG)],
                                 "customer_id int, plan_id int, start_date date, sub_id int")


def test_churn_and_next(subs):
    c = S.customers_with_transition(subs, K, T, ST, 0, 4, "sub_id")
    assert rows(c, "n_customers", "share") == [(1, 0.25)]
    nx = S.next_state_share(subs, K, T, ST, 0, "sub_id")
    assert rows(nx, "next_plan_id", "n") == [(1, 1), (2, 1), (4, 1)]
    assert all(s == pytest.approx(1 / 3) for (s,) in rows(nx, "share"))


def test_state_as_of_and_ranges(subs):
    mix = S.state_as_of(subs, K, T, ST, "2020-12-31", "sub_id")
    assert rows(mix, ST, "n", "share") == [(1, 2, 0.5), (3, 1, 0.25), (4, 1, 0.25)]
    assert rows(S.state_as_of(subs, K, T, ST, "2020-06-30", "sub_id"), ST, "n") == [(1, 1), (3, 1), (4, 2)]
    e = S.entered_state_in_range(subs, K, T, ST, 4, "2020-03-01", "2020-04-30")
    assert e.first()[0] == 1
    d = S.days_between_states(subs, K, T, ST, 3).first()
    assert (d["n_customers"], d["avg_days"]) == (1, 79.0)


def test_transitions(subs):
    t = S.transition_counts(subs, K, T, ST, "sub_id", "2020-01-01", "2020-12-31")
    assert rows(t, "from_plan_id", "to_plan_id", "n_transitions") == [
        (0, 1, 1), (0, 2, 1), (0, 4, 1), (1, 2, 1), (2, 3, 1), (2, 4, 1), (4, 1, 1)]
    later = S.transition_counts(subs, K, T, ST, "sub_id", "2020-04-01", "2020-12-31")
    assert rows(later, "from_plan_id", "to_plan_id") == [(2, 3), (2, 4), (4, 1)]


def test_payment_schedule(spark, subs):
    """Upgrade with credit, churn and return, month end, deferred annual plan."""
    p = S.payment_schedule(subs, plans(spark), K, T, ST, "2020-12-31", "sub_id")

    def of(customer):
        return rows(p.where(F.col(K) == customer), "payment_order", "payment_date", ST, "amount")
    assert of(1) == [(i + 1, D(d), plan, amount) for i, (d, plan, amount) in enumerate([
        ("2020-01-08", 1, 9.9), ("2020-02-08", 1, 9.9),
        ("2020-03-08", 2, 10.0), ("2020-04-08", 2, 19.9), ("2020-05-08", 2, 19.9),
        ("2020-08-01", 1, 9.9), ("2020-09-01", 1, 9.9), ("2020-10-01", 1, 9.9), ("2020-11-01", 1, 9.9),
        ("2020-12-01", 1, 9.9)])]
    ends = ["01-31", "02-29", "03-31", "04-30", "05-31", "06-30", "07-31", "08-31", "09-30", "10-31", "11-30", "12-31"]
    assert of(2) == [(i + 1, D(f"2020-{d}"), 1, 9.9) for i, d in enumerate(ends)]
    assert of(3) == [(1, D("2020-02-08"), 2, 19.9), (2, D("2020-03-08"), 2, 19.9), (3, D("2020-04-08"), 2, 19.9),
                     (4, D("2020-05-08"), 3, 199.0)]
    assert of(4) == []
