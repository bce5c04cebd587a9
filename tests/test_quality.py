from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tickloom.functions import wire as wire_functions
from tickloom.operators.quality import parse_canonical, parse_exchange, reject_counts, rejects, valid_ticks

GOOD = '{"s":" btcusdt ","p":"0.5","q":"2","T":1672515782136,"m":true}'


def wire(**changes):
    import json

    fields = {"s": "btcusdt", "p": "0.5", "q": "2", "T": 1672515782136, "m": True, **changes}
    return json.dumps({k: v for k, v in fields.items() if v is not ...})


def topic(**changes):
    import json

    fields = {
        "symbol": "btcusdt", "price": 0.5, "quantity": 2, "trade_time": "2026-01-01T12:00:00Z",
        "side": "buy", "source": "binance", **changes,
    }
    return json.dumps({k: v for k, v in fields.items() if v is not ...})


def run(spark, parser, values):
    rows = [(i, v) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, f"seq bigint, value {'binary' if isinstance(values[0], bytes) else 'string'}")
    return parser(df).orderBy("seq").collect()


WIRE_ACCEPTED = [
    (GOOD, ("BTCUSDT", 0.5, 2.0, datetime(2022, 12, 31, 19, 43, 2, 136000), "sell")),
    (wire(m=...), ("BTCUSDT", 0.5, 2.0, datetime(2022, 12, 31, 19, 43, 2, 136000), "buy")),
    (wire(m="false"), "sell"), (wire(m="0"), "sell"), (wire(m=[0]), "sell"), (wire(m={"a": 1}), "sell"), (wire(m=0.5), "sell"),
    (wire(m=False), "buy"), (wire(m=0), "buy"), (wire(m=0.0), "buy"), (wire(m=""), "buy"), (wire(m=None), "buy"),
    (wire(m=[]), "buy"), (wire(m={}), "buy"),
    (wire(p=True), 1.0), (wire(p=" 1.5 "), 1.5), (wire(p="1e3"), 1000.0), (wire(p=7), 7.0), (wire(p="+.5"), 0.5), (wire(p=1.25), 1.25),
    (wire(s=" ethusdt \t"), "ETHUSDT"),
    (wire(extra=[1, {"x": "}]"}]), "BTCUSDT"),
    ("  " + GOOD + " \n", "BTCUSDT"),
]

WIRE_REFUSED = [
    ('{"result":null,"id":1}', "symbol_invalid"), ("not json", "bad_json"), ("[1]", "not_object"), ("null", "not_object"),
    ("5", "not_object"), ('"x"', "not_object"), ("", "bad_json"), ("  ", "bad_json"), (None, "null_value"),
    (GOOD + "x", "bad_json"), (GOOD + GOOD, "bad_json"), (GOOD + "," + GOOD, "bad_json"), (GOOD + "]", "bad_json"),
    (GOOD + "]x}", "bad_json"), (GOOD + "}", "bad_json"), (GOOD + ',"a":{}', "bad_json"), (GOOD[:-1], "bad_json"),
    ('{"s":"A","p":NaN,"q":1,"T":1}', "bad_json"),
    (wire(s=5), "symbol_invalid"), (wire(s=""), "symbol_invalid"), (wire(s=None), "symbol_invalid"), (wire(s={"z": 1}), "symbol_invalid"),
    (wire(s=...), "symbol_invalid"),
    (wire(p=0), "price_nonpositive"), (wire(p=-1), "price_nonpositive"), (wire(p=False), "price_nonpositive"),
    (wire(p="NaN"), "price_invalid"), (wire(p="Infinity"), "price_invalid"), (wire(p="1e999"), "price_invalid"), (wire(p="abc"), "price_invalid"),
    (wire(p="1.5d"), "price_invalid"), (wire(p="1__0"), "price_invalid"), (wire(p="_1"), "price_invalid"), (wire(p="1_"), "price_invalid"), (wire(p="1_.5"), "price_invalid"), (wire(p=None), "price_invalid"), (wire(p=[1]), "price_invalid"),
    (wire(p=""), "price_invalid"), (wire(q=0), "quantity_nonpositive"), (wire(q="x"), "quantity_invalid"),
    (wire(T="1672515782136"), "time_invalid"), (wire(T=None), "time_invalid"), (wire(T=...), "time_invalid"), (wire(T=1e18), "time_invalid"),
]


def test_exchange_messages_accepted(spark):
    got = run(spark, parse_exchange, [v for v, _ in WIRE_ACCEPTED])
    for row, (value, want) in zip(got, WIRE_ACCEPTED):
        assert row["reject_reason"] is None, (value, row)
        if isinstance(want, tuple):
            assert (row["symbol"], row["price"], row["quantity"], row["trade_time"], row["side"]) == want
        else:
            assert want in (row["symbol"], row["price"], row["side"]), (value, row)
        assert row["source"] == "binance"


def test_exchange_messages_refused(spark):
    got = run(spark, parse_exchange, [v for v, _ in WIRE_REFUSED])
    assert [(r["value"], r["reject_reason"]) for r in got] == WIRE_REFUSED


NOON = datetime(2026, 1, 1, 12)
TIMES = [
    ("2026-01-01T12:00:00+05:30", datetime(2026, 1, 1, 6, 30)), ("2026-01-01T12:00:00+0530", datetime(2026, 1, 1, 6, 30)),
    ("2026-01-01 12:00:00", NOON), ("2026-01-01T12:00", NOON), ("2026-01-01t12:00:00z", NOON), ("2026-01-01_12:00:00.5Z", datetime(2026, 1, 1, 12, 0, 0, 500000)),
    ("2026-01-01", datetime(2026, 1, 1)), ("2026-01-01T12:00:00.123456789", datetime(2026, 1, 1, 12, 0, 0, 123456)),
    (1700000000, datetime(2023, 11, 14, 22, 13, 20)), (1700000000123, datetime(2023, 11, 14, 22, 13, 20, 123000)),
    ("1700000000123", datetime(2023, 11, 14, 22, 13, 20, 123000)), (1700000000.5, datetime(2023, 11, 14, 22, 13, 20, 500000)),
    ("2026", datetime(1970, 1, 1, 0, 33, 46)),
    ("T12:00:00", None), ("bad", None), (True, None), (None, None), ("2026-13-01", None), ("0000-01-01", None),
    ("2026-01-01 12", None), ("2026-01-01T12:00:00 Europe/Berlin", None), ("", None), ([1], None),
]


def test_canonical_times(spark):
    got = run(spark, parse_canonical, [topic(trade_time=t) for t, _ in TIMES])
    for row, (given, want) in zip(got, TIMES):
        assert row["trade_time"] == want, given
        assert row["reject_reason"] == (None if want else "time_invalid"), given


def test_canonical_fields(spark):
    cases = [
        (topic(), None), (topic(side="BUY"), "side_invalid"), (topic(side=None), "side_invalid"), (topic(side=...), "side_invalid"),
        (topic(source=...), None), (topic(source=None), "source_invalid"), (topic(source=5), "source_invalid"), (topic(source="x"), None),
        (topic(price="0.5"), None), (topic(symbol=5), "symbol_invalid"), (topic(other=1), None),
    ]
    got = run(spark, parse_canonical, [v.encode() for v, _ in cases])
    assert [r["reject_reason"] for r in got] == [want for _, want in cases]
    assert got[4]["source"] == "binance" and got[7]["source"] == "x"


def test_bad_bytes(spark):
    got = run(spark, parse_canonical, [b"\xff\xfe", topic().encode(), topic(symbol="x").encode()[:-2] + b"\xff\"}"])
    assert [r["reject_reason"] for r in got] == ["bad_utf8", None, "bad_utf8"]


def test_split_keeps_every_message(spark):
    values = [v for v, _ in WIRE_ACCEPTED] + [v for v, _ in WIRE_REFUSED]
    parsed = parse_exchange(spark.createDataFrame([(i, v) for i, v in enumerate(values)], "seq bigint, value string"))
    assert valid_ticks(parsed, "seq").count() == len(WIRE_ACCEPTED)
    assert rejects(parsed).count() == len(WIRE_REFUSED)
    assert reject_counts(parsed).agg(F.sum("messages")).first()[0] == len(WIRE_REFUSED)


@pytest.mark.parametrize("price, quantity", [("15000000", "1"), ("1e8", "50000000"), ("4e-9", "1e-9"), ("1e300", "1e-300")])
def test_any_finite_size_is_accepted(spark, price, quantity):
    row = run(spark, parse_exchange, [wire(p=price, q=quantity)])[0]
    assert (row["reject_reason"], row["price"], row["quantity"]) == (None, float(price), float(quantity))


@pytest.mark.parametrize("spaces", ["", " "])
def test_plain_spelling_reads_like_the_parser(spark, spaces, monkeypatch):
    """The same messages, cut up by the pattern and through the parser."""
    import json
    import random

    r, values, topics = random.Random(1), [], []
    dump = lambda x: json.dumps(x, separators=("," + spaces, ":" + spaces))
    for _ in range(300):
        p, q = (r.choice([lambda: str(round(r.uniform(0, 1e6), r.randrange(9))), lambda: round(r.uniform(0, 100), 3), lambda: r.randrange(50), lambda: "007", lambda: "-1"])() for _ in range(2))
        values.append(dump({"e": "trade", "s": r.choice(["a", " Bc ", "BTC1", ""]), "p": p, "q": q, "T": r.choice([1672515782136, 0, 17]), "m": r.choice([True, False, None]), "M": True}))
        at = r.choice(["2026-01-01T12:00:00Z", "2026-01-01 12:00:00.123456+05:30", "1700000000", "1700000000123", "2026-13-01", "T12", "2026-01-01"])
        topics.append(dump({"symbol": r.choice(["a", " x"]), "price": p, "quantity": q, "trade_time": at, "side": r.choice(["buy", "sell", "hold"]), "source": r.choice(["f", ""])}))
    plain = run(spark, parse_exchange, values), run(spark, parse_canonical, topics)
    matched = spark.createDataFrame([(v,) for v in values], "v string").filter(F.col("v").rlike(wire_functions.EXCHANGE_SHAPE.pattern)).count()
    assert 20 < matched < 200
    never = wire_functions.Shape(tuple((n, "(?!)x", k) for n, _, k in wire_functions.EXCHANGE_SHAPE.members))
    monkeypatch.setattr(wire_functions, "EXCHANGE_SHAPE", never)
    monkeypatch.setattr(wire_functions, "CANONICAL_SHAPE", wire_functions.Shape(tuple((n, "(?!)x", k) for n, _, k in wire_functions.CANONICAL_SHAPE.members)))
    assert plain == (run(spark, parse_exchange, values), run(spark, parse_canonical, topics))


@pytest.mark.parametrize("parser", [parse_exchange, parse_canonical])
def test_the_pattern_runs_once_a_message(spark, parser):
    plan = parser(spark.createDataFrame([(0, b"{}")], "seq long, value binary"))._jdf.queryExecution().optimizedPlan().toString()
    assert sum(plan.count(f"regexp_replace(_{name}#") for name in ("text", "apart")) == 1
