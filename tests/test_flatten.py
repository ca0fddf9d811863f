"""B1/B2: flatten order documents (hand values follow the reference's tests)."""

import pytest

from salescast.operators.flatten import flatten_orders
from salescast.schemas import NESTED_ORDER, ORDER_COLUMNS


def _check(amount=None, total=None, tax=None, voided=None, deleted=None, payments=None, selections=None):
    return {"guid": "c", "amount": amount, "totalAmount": total, "taxAmount": tax, "voided": voided, "deleted": deleted,
            "customer": {"guid": "cu", "email": "a@b.c", "firstName": "A", "lastName": "B", "phone": "1"},
            "payments": payments, "selections": selections}


def _order(checks, guests=None, **kw):
    d = {"guid": "o1", "businessDate": 20260626, "numberOfGuests": guests, "openedDate": "2026-06-26T17:32:00.000+0000",
         "closedDate": None, "source": "In Store", "voided": kw.get("voided"), "deleted": kw.get("deleted"),
         "diningOption": {"guid": "do-1", "entityType": "DiningOption"},
         "deliveryInfo": {"address1": "1 Main", "city": "X", "zipCode": "00000"}, "checks": checks}
    return d


def _flat(spark, docs):
    return [r.asDict() for r in flatten_orders(spark.createDataFrame(docs, NESTED_ORDER)).collect()]


def test_sample_order(spark):
    sel = [{"guid": "s1", "displayName": "Meal", "quantity": 1.0, "price": 40.0, "deferred": False, "voided": False},
           {"guid": "s2", "displayName": "Gift", "quantity": 1.0, "price": 25.0, "deferred": True, "voided": False}]
    pay = [{"guid": "p", "amount": 43.4, "tipAmount": 8.0, "type": "CREDIT", "last4Digits": "1234"}]
    (r,) = _flat(spark, [_order([_check(40.0, 43.4, 3.4, payments=pay, selections=sel)], guests=2)])
    assert (r["net_amount"], r["total_amount"], r["tax_amount"], r["tip_amount"], r["deferred_amount"]) == (40.0, 43.4, 3.4, 8.0, 25.0)
    assert r["num_guests"] == 2 and r["num_checks"] == 1
    assert r["dining_option_guid"] == "do-1" and r["voided"] is False and r["deleted"] is False


def test_voided_check_counted_not_summed(spark):
    (r,) = _flat(spark, [_order([_check(10.0), _check(99.0, voided=True)])])
    assert r["num_checks"] == 2 and r["net_amount"] == 10.0


def test_sums_and_missing_guests(spark):
    (r,) = _flat(spark, [_order([_check(10.0, 11.0), _check(5.0, 5.5)])])
    assert r["net_amount"] == 15.0 and r["total_amount"] == 16.5 and r["num_guests"] is None


@pytest.mark.parametrize("checks", [[_check(10.0, voided=True)], [_check(10.0, deleted=True)], [_check(7.0)], None])
def test_empty_sums_are_zero_doubles(spark, checks):
    (r,) = _flat(spark, [_order(checks)])
    assert r["tip_amount"] == 0.0 and isinstance(r["tip_amount"], float)
    assert r["deferred_amount"] == 0.0


def test_deferred_ignores_voided_selection_and_non_deferred(spark):
    sel = [{"guid": "s", "displayName": "G", "quantity": 1.0, "price": 25.0, "deferred": True, "voided": True},
           {"guid": "t", "displayName": "G", "quantity": 1.0, "price": 30.0, "deferred": None, "voided": None},
           {"guid": "u", "displayName": "G", "quantity": 1.0, "price": None, "deferred": True, "voided": None}]
    (r,) = _flat(spark, [_order([_check(10.0, selections=sel)])])
    assert r["deferred_amount"] == 0.0


def test_allowlist_exact_and_no_pii(spark):
    out = flatten_orders(spark.createDataFrame([_order([_check(1.0)])], NESTED_ORDER))
    assert out.columns == ORDER_COLUMNS
    for token in ("email", "phone", "address", "zip", "last4", "customer", "delivery", "first", "last_name"):
        assert not any(token in c for c in out.columns)


def test_flatten_equals_aggregation_path(spark):
    """The nested-document path and the mergeable-aggregate path agree on every row."""
    from tests_support import SF001

    from salescast.sources import bridge

    a = flatten_orders(bridge.nested_orders(spark, SF001))
    b = bridge.landing_orders(spark, SF001)
    assert a.dtypes == b.dtypes
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_json_integers_read_as_double(spark, tmp_path):
    from salescast.sources.readers import read_nested_orders

    p = tmp_path / "o.json"
    p.write_text('{"guid":"o","businessDate":20260626,"checks":[{"amount":10,"totalAmount":11,"taxAmount":1}]}\n')
    (r,) = flatten_orders(read_nested_orders(spark, str(p))).collect()
    assert r.net_amount == 10.0 and r.total_amount == 11.0 and r.num_checks == 1 and r.voided is False
