"""Damaged messages: what is accepted, and with which values, must agree with
Python's JSON reader and the documented field rules."""

import json
import random
import re
from decimal import ROUND_HALF_UP, Decimal, InvalidOperation

from tallywatch.functions.parse import decode

USUAL = ["1", "-7", "12.345", "1e3", "0.005", "99999999.99", '"8"', '" 9.5 "', "17"]
ODD = ["99999999.995", "100000000", '"x"', '""', "null", "true", "[1]", '{"a":1}', "01", "1.", ".5", "+1", "NaN",
       "-Infinity", "'1'", "0x1F"]
FIELDS = ["user_id", "amount", "city", "transaction_id", "other"]


def damaged(draw):
    pairs = [
        f'"{field}"{draw.choice([":", " : "])}{draw.choice(ODD if draw.random() < 0.1 else USUAL)}'
        for field in FIELDS
        if draw.random() < 0.6
    ]
    if draw.random() < 0.7:
        pairs.insert(0, f'"user_id":{draw.randint(1, 50)}')
    draw.shuffle(pairs)
    text = "{" + ",".join(pairs) + "}"
    if draw.random() < 0.5:
        at = draw.randrange(len(text))
        change = draw.choice(["cut", "drop", "double", "insert", "wrap"])
        if change == "cut":
            text = text[:at]
        elif change == "drop":
            text = text[:at] + text[at + 1 :]
        elif change == "double":
            text = text + draw.choice(["", " ", ",", "x", "}", "]"]) + text
        elif change == "insert":
            text = text[:at] + draw.choice('{}[]",:\\ \t0x') + text[at:]
        else:
            text = draw.choice(["[{}]", "{} ", "\n{}", "{}}}", "{}]", "({})"]).format(text)
    return text


def number(value, absent):
    if value is absent:
        return Decimal(0)
    if isinstance(value, bool) or not isinstance(value, (int, float, str)):
        return None
    try:
        exact = Decimal(repr(value) if isinstance(value, float) else str(value).strip())
    except InvalidOperation:
        return None
    if not exact.is_finite():
        return None
    cents = exact.quantize(Decimal("0.01"), ROUND_HALF_UP)
    return cents if abs(cents) < 10**8 else None


def model(text):
    def refuse(_):
        raise ValueError

    absent = object()
    try:
        found = json.loads(text, parse_constant=refuse)
    except ValueError:
        return None
    if not isinstance(found, dict):
        return None
    user = found.get("user_id", absent)
    if isinstance(user, str) and re.fullmatch(r"\s*[+-]?\d+\s*", user):
        user = int(user)
    if isinstance(user, bool) or not isinstance(user, int):
        return None
    amount = number(found.get("amount", absent), absent)
    if amount is None or found.get("city", absent) is None:
        return None
    return user, amount


def test_damaged_messages(spark):
    draw = random.Random(11)
    texts = sorted({damaged(draw) for _ in range(4000)})
    rows = decode(spark.createDataFrame([(text,) for text in texts], "value string")).collect()
    found = {row.value: None if row.reject_reason else (row.user_id, row.amount) for row in rows}
    wrong = [(text, model(text), found[text]) for text in texts if found[text] != model(text)]
    assert not wrong, wrong[:10]
    assert len(texts) > 3000 and 500 < sum(value is not None for value in found.values()) < 3000
