"""Record decoding: every element type in every kind of container, and malformed records."""

import json
import struct
from datetime import datetime

import pytest
from hypothesis import given, settings, strategies as st

from doclake.queries.fixtures import ObjectId, encode
from doclake.sources.bson import BsonError, Decoder, decimal128, well_formed

OID = ObjectId(bytes(range(12)))
i32 = lambda n: struct.pack("<i", n)


def text(s):
    raw = s.encode() + b"\0"
    return i32(len(raw)) + raw


def dec128(digits, exponent, sign=0):
    high = (sign << 63) | ((exponent + 6176) << 49) | (digits >> 64)
    return struct.pack("<QQ", digits & (2**64 - 1), high)


# (type code, payload, expected JSON value, guide type)
VALUES = [
    (1, struct.pack("<d", 1.5), 1.5, "double"),
    (1, struct.pack("<d", float("nan")), "NaN", "double"),
    (1, struct.pack("<d", float("inf")), "Infinity", "double"),
    (1, struct.pack("<d", float("-inf")), "-Infinity", "double"),
    (2, text(""), "", "string"),
    (2, text("x"), "x", "string"),
    (2, text('né "q"\n漢'), 'né "q"\n漢', "string"),
    (2, text("z" * (1 << 20) + "end"), "z" * (1 << 20) + "end", "string"),
    (3, encode({}), {}, "object"),
    (4, encode({}), [], "array"),
    (5, i32(3) + b"\0" + b"\xab\x00\x0f", "AB000F", "binary"),
    (5, i32(16) + b"\3" + bytes(range(16)), "07060504-0302-0100-0f0e-0d0c0b0a0908", "string"),
    (6, b"", None, None),
    (7, bytes(OID), "000102030405060708090a0b", "string"),
    (8, b"\1", True, "boolean"),
    (8, b"\0", False, "boolean"),
    (9, struct.pack("<q", 1_700_000_000_123), "2023-11-14T22:13:20.123Z", "timestamp"),
    (9, struct.pack("<q", -1), "1969-12-31T23:59:59.999Z", "timestamp"),
    (10, b"", None, None),
    (11, b"^a.b\0i\0", '{"$regularExpression":{"pattern":"^a.b","options":"i"}}', "string"),
    (13, text("f()"), '{"$code":"f()"}', "string"),
    (14, text("sym"), "sym", "string"),
    (16, i32(-7), -7, "number"),
    (17, struct.pack("<II", 2, 9), '{"$timestamp":{"t":9,"i":2}}', "string"),
    (18, struct.pack("<q", 1 << 60), 1 << 60, "number"),
    (19, dec128(12345, -2), 123.45, "number"),
    (19, dec128(1, 6000), "1E+6000", "number"),
    (127, b"", '{"$maxKey":1}', "string"),
    (255, b"", '{"$minKey":1}', "string"),
]


def document(*elements):
    body = b"".join(bytes([code]) + name.encode() + b"\0" + payload for name, code, payload in elements)
    return i32(len(body) + 5) + body + b"\0"


@pytest.mark.parametrize("code,payload,value,kind", VALUES)
def test_value_in_every_container(code, payload, value, kind):
    inner = document(("v", code, payload))
    array = document(("0", code, payload), ("1", 16, i32(1)))
    nested = document(("0", 4, document(("0", code, payload))))
    raw = document(("v", code, payload), ("o", 3, inner), ("a", 4, array), ("n", 4, nested), ("end", 16, i32(5)))
    assert well_formed(raw, 0, len(raw))
    doc, _, _, leaves = Decoder(leaves=True).decode(raw)
    assert json.loads(doc) == {"v": value, "o": {"v": value}, "a": [value, 1], "n": [[value]], "end": 5}
    kinds = [leaf["type"] for leaf in leaves if leaf["path"] in ("$.v", "$.o.v", "$.n[*]")]
    if kind not in ("object", "array"):
        assert kinds == [kind] * 3


def test_decimal_specials():
    assert decimal128(0, 0x7800 << 48) == "Infinity"
    assert decimal128(0, 0xF800 << 48) == "-Infinity"
    assert decimal128(0, 0x7C00 << 48) == "NaN"
    assert decimal128(*struct.unpack("<QQ", dec128(5, 0, 1))) == "-5"


def test_identity():
    nested = encode({"_id": 7, "deep": {"_id": OID}})
    doc, root, oid, _ = Decoder().decode(nested)
    assert (root, oid) == ("7", OID.hex())
    assert Decoder().decode(encode({"a": 1}))[1:3] == (None, None)
    assert Decoder().decode(encode({"_id": {"x": 1}}))[1] == '{"x":1}'


def test_movie_like_document():
    raw = encode(
        {"_id": OID, "title": "T", "cast": None, "opening": datetime(2001, 2, 3), "genre": ["a", "b"],
         "crew": [{"job": "j", "names": ["n1", "n2"]}, {"job": "k", "names": []}]}
    )
    doc, _, _, leaves = Decoder(leaves=True).decode(raw)
    assert json.loads(doc)["crew"][0]["names"] == ["n1", "n2"]
    paths = [(leaf["path"], leaf["type"]) for leaf in leaves]
    assert ("$.crew.names[*]", "string") in paths and ("$.genre[*]", "string") in paths and ("$.crew", "array") in paths
    assert ("$.opening", "timestamp") in paths and ("$.cast", None) in paths


def test_duplicate_keys():
    raw = document(("a", 16, i32(1)), ("a", 16, i32(2)))
    with pytest.raises(BsonError, match="duplicate"):
        Decoder().decode(raw)
    assert Decoder(allow_duplicate_keys=True).decode(raw)[0] == '{"a":2}'


def test_unknown_type_is_an_error():
    with pytest.raises(BsonError, match="unknown element type 66"):
        Decoder().decode(document(("a", 66, b"")))


@settings(max_examples=200, deadline=None)
@given(st.binary(max_size=60))
def test_noise_never_escapes(noise):
    raw = i32(len(noise) + 5) + noise + b"\0"
    try:
        json.loads(Decoder(leaves=True, allow_duplicate_keys=True).decode(raw)[0])
    except BsonError:
        pass
    well_formed(raw, 0, len(raw))


json_values = st.recursive(
    st.none() | st.booleans() | st.integers(-(2**63), 2**63 - 1) | st.text(max_size=8).filter(lambda s: "\ud800" > max(s, default="a")),
    lambda inner: st.lists(inner, max_size=3) | st.dictionaries(st.text("abc$ .", min_size=1, max_size=3), inner, max_size=3),
    max_leaves=12,
)


@settings(max_examples=200, deadline=None)
@given(st.dictionaries(st.text("abc", min_size=1, max_size=3), json_values, max_size=4))
def test_round_trip(doc):
    raw = encode(doc)
    assert well_formed(raw, 0, len(raw))
    assert json.loads(Decoder().decode(raw)[0]) == doc
