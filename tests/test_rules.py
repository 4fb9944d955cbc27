import pytest

from haulage.rules import DEFAULT_RULES, Rules
from haulage.schemas import JOIN_CONTRACTS, SOURCE_SPECS


def test_three_sources_registered():
    assert {"orders", "customers", "geolocation"} <= set(SOURCE_SPECS)


def test_bounds_ordered_and_plausible():
    r = DEFAULT_RULES
    assert r.lat_min < r.lat_max and r.lng_min < r.lng_max
    assert r.lat_min < 0
    assert r.lng_min < -28


def test_bucket_thresholds_increase():
    assert [u for _, u in DEFAULT_RULES.speed_steps] == [7, 14, 30]
    assert [u for _, u in DEFAULT_RULES.severity_steps] == [3, 7, 14]


def test_quality_limits_in_range():
    r = DEFAULT_RULES
    assert 0 < r.max_null_rate_pct < 100
    assert 0 < r.min_match_rate_pct < 100
    assert r.max_delivery_days > 0


def test_rules_reject_bad_values():
    with pytest.raises(ValueError):
        Rules(lat_min=10.0, lat_max=0.0)
    with pytest.raises(ValueError):
        Rules(speed_steps=(("A", 10), ("B", 5)))
    with pytest.raises(ValueError):
        Rules(max_null_rate_pct=150.0)


def test_contracts_registered():
    assert set(JOIN_CONTRACTS) == {"orders_vs_customers", "customers_vs_geolocation"}
