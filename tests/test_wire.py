"""Binary payloads: round trips by an encoder of its own, cut and broken bytes."""

import random

import pytest

from tracewell import schemas
from tracewell.sources import orders, wire


def varint(n):
    n &= (1 << 64) - 1
    out = bytearray()
    while n > 127:
        out.append(n & 127 | 128)
        n >>= 7
    return bytes([*out, n])


def text(number, value):
    data = value if isinstance(value, bytes) else value.encode()
    return varint(8 * number + 2) + varint(len(data)) + data


def whole(number, value):
    return varint(8 * number) + varint(value)


def money(code, units, nanos):
    return text(1, code) + whole(2, units) + whole(3, nanos)


ITEMS = [("p1", 3, ("USD", 10, 5)), ("é", -2, ("", -(1 << 63), -999_999_999)), ("", (1 << 31) - 1, ("JPY", (1 << 63) - 1, 0))]
ORDER = (
    text(1, "o-1")
    + text(2, "t")
    + text(3, money("USD", 7, 1))
    + varint(8 * 90 + 1) + bytes(8)  # fields that the schema doesn't have
    + varint(8 * 91 + 5) + bytes(4)
    + text(92, b"\xff")
    + text(4, text(1, "street") + text(5, "98109"))
    + b"".join(text(5, text(1, text(1, p) + whole(2, q)) + text(2, money(*m))) for p, q, m in ITEMS)
    + text(3, whole(3, 9))  # merged into the cost
)


def test_round_trip():
    got = wire.decode(ORDER, schemas.ORDER)
    assert (got["order_id"], got["shipping_tracking_id"]) == ("o-1", "t")
    assert got["shipping_cost"] == {"currency_code": "USD", "units": 7, "nanos": 9}
    assert got["shipping_address"] == {"street_address": "street", "city": "", "state": "", "country": "", "zip_code": "98109"}
    assert [(i["item"]["product_id"], i["item"]["quantity"], tuple(i["cost"].values())) for i in got["items"]] == ITEMS
    empty = {"order_id": "", "shipping_tracking_id": "", "shipping_cost": None, "shipping_address": None, "items": []}
    assert wire.decode(b"", schemas.ORDER) == empty


def test_cut_messages_are_refused_or_end_between_fields():
    ends = set()
    for n in range(len(ORDER)):
        try:
            wire.decode(ORDER[:n], schemas.ORDER)
            ends.add(n)
        except ValueError:
            pass
    assert ends == {0, 5, 8, *(n for n in ends if n > 8)} and len(ends) == 11


@pytest.mark.parametrize("data", [b"\x0b", b"\x0f", b"\x08" + b"\xff" * 11, b"\x0a\x05ab", b"\x00\x01", text(1, b"\xff\xfe"), b"\x80"])
def test_broken_messages(data):
    with pytest.raises(ValueError):
        wire.decode(data, schemas.ORDER)


def test_random_bytes_never_crash():
    draw = random.Random(4)
    for _ in range(3000):
        data = bytearray(ORDER)
        for _ in range(draw.randint(1, 4)):
            data[draw.randrange(len(data))] = draw.randrange(256)
        try:
            wire.decode(bytes(data), schemas.ORDER)
        except ValueError:
            pass


def test_payload_column(spark):
    rows = [(ORDER,), (ORDER[:-1],), (None,), (b"",)]
    parsed = orders.parse(spark.createDataFrame(rows, "value binary"))
    assert sorted(r.order_id for r in orders.valid(parsed).collect()) == ["", "o-1"]
    assert sorted((bytes(r.value) if r.value is not None else b"null") for r in orders.unparsable(parsed).collect()) == sorted([ORDER[:-1], b"null"])


def test_columns_are_those_of_the_decoded_messages():
    import pyarrow as pa
    from pyspark.sql.pandas.types import to_arrow_type

    kind = to_arrow_type(schemas.ORDER)
    found = [None, wire.decode(ORDER, schemas.ORDER), wire.decode(b"", schemas.ORDER), None, wire.decode(ORDER, schemas.ORDER)]
    for messages in (found, found[:1], []):
        got = wire._columns(messages, kind)
        got.validate(full=True)
        assert got.equals(pa.array(messages, kind))
