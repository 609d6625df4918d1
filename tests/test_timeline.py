"""The point-in-time name lookup against a plain search over random histories."""

from __future__ import annotations

import random
from datetime import date, timedelta

from pitlake.operators import securities, tradability

START = date(2024, 1, 1)


def _day(n):
    return None if n is None else START + timedelta(days=n)


def _random_case(rng):
    stocks, names, limits = [], [], []
    for code in map(str, range(40)):
        listed = None if rng.random() < 0.1 else rng.randrange(0, 10)
        gone = None if rng.random() < 0.5 else rng.randrange(0, 40)
        stocks.append((code, listed, gone))
        for start in rng.sample(range(-5, 35), rng.randrange(0, 7)):
            end = None if rng.random() < 0.3 else start + rng.randrange(-1, 25)
            names.append((code, f"n{len(names)}", start, end, rng.choice([None, 1, 2])))
        limits += [(code, day) for day in range(-2, 45)]
    return stocks, names, limits


def _expected(stocks, names, limits):
    lives = {code: (listed, gone) for code, listed, gone in stocks}
    found = {}
    for code, day in limits:
        listed, gone = lives[code]
        if listed is None or day < listed or (gone is not None and day >= gone):
            continue
        valid = [n for n in names if n[0] == code and n[2] <= day and (n[3] is None or day <= n[3])]
        found[code, _day(day)] = max(valid, key=lambda n: n[2])[1] if valid else None
    return found


def test_timeline_equals_search(make):
    for seed in (1, 2, 3):
        stocks, names, limits = _random_case(random.Random(seed))
        tables = (
            make("stock_basic", [(c, _day(a), _day(b)) for c, a, b in stocks],
                 ["ts_code", "list_date", "delist_date"]),
            make("namechange", [(c, n, _day(a), _day(b), _day(x)) for c, n, a, b, x in names],
                 ["ts_code", "name", "start_date", "end_date", "ann_date"]),
        )
        constraints = tradability.trade_constraints(
            make("stk_limit", [(c, _day(d)) for c, d in limits], ["ts_code", "trade_date"]),
            make("suspend_d", []), make("daily", []),
        )
        rows = tradability.stock_trade_constraints(constraints, *tables).collect()
        got = {(r.ts_code, r.trade_date): r.historical_name for r in rows}
        assert len(got) == len(rows)
        assert got == _expected(stocks, names, limits)


def test_spans_are_disjoint(make):
    _, names, _ = _random_case(random.Random(9))
    spans = securities.name_spans(
        make("namechange", [(c, n, _day(a), _day(b), None) for c, n, a, b, _ in names],
             ["ts_code", "name", "start_date", "end_date", "ann_date"]),
    ).collect()
    by_code = {}
    for span in spans:
        by_code.setdefault(span.ts_code, []).append((span.span_start, span.span_stop or date.max))
    for pieces in by_code.values():
        pieces.sort()
        assert all(start < stop for start, stop in pieces)
        assert all(a[1] <= b[0] for a, b in zip(pieces, pieces[1:]))


def test_many_names_of_one_security(make, spark):
    """A third of all names belong to one security, and none of its names ever ends."""
    names = [("hot", f"n{i}", START + timedelta(days=i), None) for i in range(1500)]
    names += [(f"c{i}", "x", START, None) for i in range(3000)]
    spans = securities.name_spans(
        make("namechange", names, ["ts_code", "name", "start_date", "end_date"])
    ).where("ts_code = 'hot'")
    got = {(s.span_start, s.span_stop, s.historical_name) for s in spans.collect()}
    days = [START + timedelta(days=i) for i in range(1500)] + [None]
    assert got == {(days[i], days[i + 1], f"n{i}") for i in range(1500)}
