"""BSON records: structural check, decoding to JSON text and typed leaves.

Follows the public BSON specification (bsonspec.org). These helpers run inside
Spark tasks on one record at a time; see ``dump`` for how files are split.
"""

from __future__ import annotations

import struct
from datetime import datetime, timedelta
from decimal import Decimal
from functools import lru_cache
from json.encoder import encode_basestring as quote

# Element type codes whose payload has a constant size.
FIXED = {1: 8, 6: 0, 7: 12, 8: 1, 9: 8, 10: 0, 16: 4, 17: 8, 18: 8, 19: 16, 127: 0, 255: 0}
STRINGS = (2, 13, 14)
I32 = struct.Struct("<i").unpack_from
I64 = struct.Struct("<q").unpack_from
F64 = struct.Struct("<d").unpack_from
U64X2 = struct.Struct("<QQ").unpack_from
U32X2 = struct.Struct("<II").unpack_from
EPOCH = datetime(1970, 1, 1)
MIN_RECORD = 5


class BsonError(ValueError):
    """A record that is not well formed."""


def well_formed(buf, at: int, end: int) -> bool:
    """Whether a complete document fills exactly ``buf[at:end]``, however deeply it is nested."""
    if end - at < MIN_RECORD or I32(buf, at)[0] != end - at or buf[end - 1] != 0:
        return False
    pos, ends = at + 4, [end - 1]  # the closing byte of every open document
    while ends:
        last = ends[-1]
        if pos == last:
            ends.pop()
            pos += 1
            continue
        code = buf[pos]
        name_end = buf.find(b"\0", pos + 1, last)
        if name_end < 0:
            return False
        pos = name_end + 1
        size = FIXED.get(code)
        if size is None:
            if code == 11:
                for _ in range(2):
                    pos = buf.find(b"\0", pos, last) + 1
                    if pos == 0:
                        return False
                continue
            if pos + 4 > last:
                return False
            n = I32(buf, pos)[0]
            if code in STRINGS:
                size = 4 + n
                if n < 1 or pos + size > last or buf[pos + size - 1] != 0:
                    return False
            elif code in (3, 4):
                if n < MIN_RECORD or pos + n > last or buf[pos + n - 1] != 0:
                    return False
                ends.append(pos + n - 1)
                size = 4
            elif code == 5:
                size = 5 + n
                if n < 0:
                    return False
            elif code == 12:
                size = 16 + n
                if n < 1:
                    return False
            elif code == 15:
                size = n
                if n < 14:
                    return False
            else:
                return False
        pos += size
        if pos > ends[-1]:
            return False
    return True


def _text(buf, pos):
    n = I32(buf, pos)[0]
    stop = pos + 4 + n
    if n < 1 or stop > len(buf):
        raise BsonError("string length out of range")
    return buf[pos + 4:stop - 1].decode("utf-8", "replace"), stop


@lru_cache(maxsize=4096)
def _day(day: int) -> str:
    return (EPOCH + timedelta(days=day)).date().isoformat()


def _millis(ms: int) -> str:
    """ISO text in UTC; milliseconds as a number outside the years ISO text can hold."""
    try:
        date = _day(ms // 86_400_000)
    except OverflowError:
        return str(ms)
    seconds, ms = divmod(ms % 86_400_000, 1000)
    minutes, seconds = divmod(seconds, 60)
    return "%sT%02d:%02d:%02d.%03dZ" % (date, minutes // 60, minutes % 60, seconds, ms)


def _uuid_legacy(raw: bytes) -> str:
    h = raw[7::-1].hex() + raw[:7:-1].hex()
    return "-".join((h[:8], h[8:12], h[12:16], h[16:20], h[20:]))


def decimal128(low: int, high: int) -> str:
    """IEEE 754-2008 decimal128, binary integer encoding."""
    sign = high >> 63
    if (high >> 58) & 31 == 31:
        return "NaN"
    if (high >> 58) & 31 == 30:
        return "-Infinity" if sign else "Infinity"
    if (high >> 61) & 3 == 3:
        exponent, digits = (high >> 47) & 0x3FFF, 0
    else:
        exponent, digits = (high >> 49) & 0x3FFF, ((high & ((1 << 49) - 1)) << 64) | low
        if digits >= 10**34:
            digits = 0
    return str(Decimal((sign, tuple(map(int, str(digits))), exponent - 6176)))


def _decimal_json(text: str) -> str:
    d = Decimal(text)
    if d.is_finite():
        plain = format(d, "f")
        if len(plain.replace("-", "").replace(".", "").lstrip("0")) <= 38 and len(plain) <= 41:
            return plain
    return quote(text)


# --- scalar readers: (buffer, position) -> (JSON text, plain text, guide type, next position) ---


def _int32(buf, pos):
    value = str(I32(buf, pos)[0])
    return value, value, "number", pos + 4


def _int64(buf, pos):
    value = str(I64(buf, pos)[0])
    return value, value, "number", pos + 8


def _double(buf, pos):
    number = F64(buf, pos)[0]
    if number - number == 0.0:
        value = repr(number)
        return value, value, "double", pos + 8
    value = "NaN" if number != number else "Infinity" if number > 0 else "-Infinity"
    return quote(value), value, "double", pos + 8


def _string(buf, pos):
    value, stop = _text(buf, pos)
    return quote(value), value, "string", stop


def _object_id(buf, pos):
    value = buf[pos:pos + 12].hex()
    return f'"{value}"', value, "string", pos + 12


def _boolean(buf, pos):
    value = "true" if buf[pos] == 1 else "false"
    return value, value, "boolean", pos + 1


def _datetime(buf, pos):
    value = _millis(I64(buf, pos)[0])
    return f'"{value}"', value, "timestamp", pos + 8


def _null(buf, pos):
    return "null", "null", None, pos


def _decimal(buf, pos):
    value = decimal128(*U64X2(buf, pos))
    return _decimal_json(value), value, "number", pos + 16


def _binary(buf, pos):
    n, subtype = I32(buf, pos)[0], buf[pos + 4]
    stop = pos + 5 + n
    if n < 0 or stop >= len(buf):
        raise BsonError("binary length out of range")
    raw = buf[pos + 5:stop]
    if subtype == 3 and n == 16:
        value = _uuid_legacy(raw)
        return quote(value), value, "string", stop
    value = raw.hex().upper()
    return f'"{value}"', value, "binary", stop


def _extended(value: str, stop: int):
    """Types without a JSON counterpart: extended JSON, kept as text."""
    return quote(value), value, "string", stop


def _code(buf, pos):
    body, stop = _text(buf, pos)
    return _extended('{"$code":' + quote(body) + "}", stop)


def _regex(buf, pos):
    cut = buf.index(0, pos)
    stop = buf.index(0, cut + 1) + 1
    pattern, options = buf[pos:cut].decode(), buf[cut + 1:stop - 1].decode()
    return _extended('{"$regularExpression":{"pattern":' + quote(pattern) + ',"options":' + quote(options) + "}}", stop)


def _timestamp(buf, pos):
    i, t = U32X2(buf, pos)
    return _extended(f'{{"$timestamp":{{"t":{t},"i":{i}}}}}', pos + 8)


def _pointer(buf, pos):
    ref, stop = _text(buf, pos)
    target = buf[stop:stop + 12].hex()
    return _extended('{"$dbPointer":{"$ref":' + quote(ref) + ',"$id":"' + target + '"}}', stop + 12)


def _scoped_code(buf, pos):
    body, after = _text(buf, pos + 4)
    scope, _ = Decoder().container(buf, after, False, "$", False, False)
    return _extended('{"$code":' + quote(body) + ',"$scope":' + scope + "}", pos + I32(buf, pos)[0])


def _max_key(buf, pos):
    return _extended('{"$maxKey":1}', pos)


def _min_key(buf, pos):
    return _extended('{"$minKey":1}', pos)


READERS = {
    1: _double, 2: _string, 5: _binary, 6: _null, 7: _object_id, 8: _boolean, 9: _datetime, 10: _null, 11: _regex,
    12: _pointer, 13: _code, 14: _string, 15: _scoped_code, 16: _int32, 17: _timestamp, 18: _int64, 19: _decimal,
    127: _max_key, 255: _min_key,
}


class Decoder:
    """Decodes one record; collects typed leaves only when asked to."""

    def __init__(self, leaves: bool = False, allow_duplicate_keys: bool = False):
        self.want_leaves = leaves
        self.allow_duplicates = allow_duplicate_keys
        self.leaves = [] if leaves else None
        self.oid = self.root_id = None
        # Field names repeat from record to record: raw name -> (name, JSON form with colon).
        self.names: dict[bytes, tuple[str, str]] = {}

    def decode(self, buf: bytes):
        """``(doc, id, oid, leaves)``: JSON text, text of the root ``_id``, first object id named ``_id``."""
        if len(buf) < MIN_RECORD or I32(buf, 0)[0] != len(buf) or buf[-1] != 0:
            raise BsonError("record length does not match")
        self.leaves = [] if self.want_leaves else None
        self.oid = self.root_id = None
        try:
            doc, _ = self.container(buf, 0, False, "$", False, True)
        except BsonError:
            raise
        except (IndexError, ValueError, struct.error, RecursionError) as e:
            raise BsonError(f"malformed record: {e}") from e
        return doc, self.root_id, self.oid, self.leaves

    def _name(self, raw: bytes) -> tuple[str, str]:
        name = raw.decode("utf-8", "replace")
        known = name, quote(name) + ":"
        if len(self.names) < 65536:
            self.names[raw] = known
        return known

    def container(self, buf, pos, is_array, path, in_array, root):
        """``(JSON text, next position)`` of the object or array at ``pos``."""
        end = pos + I32(buf, pos)[0]
        if end > len(buf) or end - pos < MIN_RECORD or buf[end - 1] != 0:
            raise BsonError("container length out of range")
        pos += 4
        fields: dict[str, str] = {}
        items: list[str] = []
        leaves, names, readers = self.leaves, self.names, READERS
        code = buf[pos]
        while code:
            stop = buf.index(0, pos + 1)
            pos_value = stop + 1
            if is_array:
                name, key, where = None, None, path
            else:
                raw = buf[pos + 1:stop]
                name, key = names.get(raw) or self._name(raw)
                where = path
                if leaves is not None:
                    odd = "." in name or " " in name
                    where = f'{path}."{name}"' if odd else f"{path}.{name}"
            if code == 3 or code == 4:
                if leaves is not None:
                    leaves.append(_leaf(where, name, len(items), "object" if code == 3 else "array", None, in_array or is_array))
                text, pos = self.container(buf, pos_value, code == 4, where, in_array or is_array, False)
                plain = text
            else:
                reader = readers.get(code)
                if reader is None:
                    raise BsonError(f"unknown element type {code}")
                text, plain, kind, pos = reader(buf, pos_value)
                if leaves is not None:
                    value = None if kind is None else plain
                    at = where + "[*]" if is_array else where
                    leaves.append(_leaf(at, name, len(items), kind, value, in_array or is_array))
            if is_array:
                items.append(text)
            else:
                if key in fields and not self.allow_duplicates:
                    raise BsonError(f"duplicate key {name!r}")
                fields[key] = text
                if name == "_id":
                    if code == 7 and self.oid is None:
                        self.oid = plain
                    if root:
                        self.root_id = None if text == "null" else plain
            code = buf[pos]
        if pos != end - 1:
            raise BsonError("container ends early")
        if is_array:
            return "[" + ",".join(items) + "]", end
        return "{" + ",".join([k + v for k, v in fields.items()]) + "}", end


def _leaf(path, name, position, kind, value, inside):
    return {
        "path": path, "key": name, "pos": position if name is None else None, "type": kind,
        "integral": kind == "number" and value.lstrip("-").isdigit(), "value": value, "in_array": inside,
    }


class GuideParts:
    """Schema facts of the records of one task, summed up while they are decoded.

    Rows per (path, type), to be merged by ``guide.merge_parts``; far smaller than
    the leaves themselves.
    """

    def __init__(self):
        self.rows: dict[tuple[str, str | None], list] = {}

    def add(self, leaves: list[dict]) -> None:
        seen = set()
        for leaf in leaves:
            path, kind, text, name = leaf["path"], leaf["type"], leaf["value"], leaf["key"]
            if name is None and not path.endswith("[*]"):
                continue  # an object or array inside an array is no guide row
            at = path, kind
            row = self.rows.get(at)
            if row is None:
                # length, low, high (each comparable, text), documents, values, integral, name characters, fraction digits
                row = self.rows[at] = [None, None, None, 0, 0, True, 0, None]
            if at not in seen:
                seen.add(at)
                row[3] += 1
            row[4] += 1
            row[5] = row[5] and leaf["integral"]
            if kind == "number" and not leaf["integral"]:
                row[7] = max(row[7] or 0, fraction_digits(text))
            if name is not None:
                row[6] += len(name)
            if text is not None:
                size = len(text) if text.isascii() else len(text.encode("utf-8", "replace"))
                if row[0] is None or size > row[0]:
                    row[0] = size
                low, high = row[1], row[2]
                value = (_comparable(text), text) if kind in ("number", "double") else (0, text)
                if low is None or value < low:
                    row[1] = value
                if high is None or value > high:
                    row[2] = value

    def take(self) -> list[dict]:
        out = [
            {
                "path": path, "type": kind, "length": r[0], "low": r[1] and r[1][1], "high": r[2] and r[2][1],
                "n_docs": r[3], "n_values": r[4], "integral": r[5], "scale": r[7], "key_chars": r[6],
            }
            for (path, kind), r in self.rows.items()
        ]
        self.rows = {}
        return out


def fraction_digits(text: str) -> int:
    """Digits behind the decimal point of a number's text; 0 for what is no finite number."""
    exponent = Decimal(text).as_tuple().exponent
    return max(0, -exponent) if isinstance(exponent, int) else 0


def _comparable(text: str):
    """A number's text as something that orders like the number; not-a-number above all."""
    try:
        return int(text)
    except ValueError:
        number = float(text)
        return number if number == number else float("inf")
