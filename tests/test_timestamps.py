"""Event-time grammar vs Python's fromisoformat / strptime chain."""

import datetime as dt

import pytest

from quayside.functions.timestamps import event_time_columns


def parse(df, col="s"):
    """The shipped two-step form: group arrays first, then the time over them."""
    helpers, final = event_time_columns(col, df.schema[col].dataType)
    return (df.selectExpr("*", *[f"{sql} AS {name}" for name, sql in helpers.items()])
            .selectExpr(*[f"`{c}`" for c in df.columns], f"CAST({final} AS TIMESTAMP_NTZ) AS t"))


# Forms the engine documents as unsupported (README): fractional zone seconds.
DOCUMENTED_GAPS = {"2024-01-01T10:11:12+05:30:00.123"}

CASES = [
    "2024-01-01", "2024-01-01T10", "2024-01-01T10:11", "2024-01-01T10:11:12", "2024-01-01 10:11:12",
    "2024-01-01X10:11:12", "2024-01-01T10:11:12.5", "2024-01-01T10:11:12.123456", "2024-01-01T10:11:12.1234567",
    "2024-01-01T10:11:12,5", "2024-01-01T10:11:12Z", "2024-01-01T10:11:12+05:30", "2024-01-01T10:11:12+0530",
    "2024-01-01T10:11:12+05", "2024-01-01T10:11:12-05:30:15", "2024-01-01T10:11:12.5+05:30", "20240101",
    "20240101T101112", "20240101T1011", "2024-01-01T101112", "20240101T10:11:12", "2024-01-01T24:00:00",
    "2024-1-1", "2024-1-1 1:2:3", "2024-01-01 1:2:3", "12:00", "2024", "01/02/2024", "1704067200", "",
    "2024-01-01T10:11:12 ", "2024-01-01T10:11:12z", "2024-02-30", "2024-01-01T25:00:00", "2024-01-01T10:60:00",
    "2024-01-01T10:11:60", "2024-01-01T10:11:12.", "2024-01-01T1011", "2024-01-01T10:1112",
    "2024-01-01T10:11:12Z+00:00", "2024-01-01T10Z", "2024-01-01 10:11:12Z", "2024-01-01T10:11:12.123+00:00",
    " 2024-01-01", "2024-01-01T10:11:12+24:00", "2024-01-01T10:11:12-00:00", "0000-01-01",
    "2024-01-01 10:11:12.5", "2024-1-1T1:2:3", "2024-01-01  10:11:12", "2024-01-01T10:11:12.1234567891",
    "2024-02-29T00:00:00", "2023-02-29", "2024-12-31T23:59:59.999999", "2024-1-31 23:59:59", "2024-01-01t10:11:12",
    "2024-W01-1", "2024W011", "2024-W01", "2024W01", "2024-W53-1", "2020-W53-7", "2020W537", "2021-W00-1", "2024-W01-8",
    "2024-W10-3T10:11:12", "2024W103T101112+0530", "2024-W10T10:11", "2024-W52-7 23:59:59.5Z", "2024-W1-1", "2026-W53-5", "2024-W01-1Z",
    "2024-01-01Z", "20240101Z", "2024-01-01+05:30", "2024-01-01-08:00", "2024-01-01Z10:11", "2024-01-01ZZ", "2024-01-01T10:11ZZ",
    "2024-13-01", "2024-1-1 24:0:0", "2024-01-01T10:11:12+05:30Z", "2024-01-01T10:11:12.5Z", "abc",
]


def python_reference(s):
    """The producer contract: fromisoformat ('Z' read as +00:00), then two
    strptime layouts; None when nothing applies."""
    try:
        v = dt.datetime.fromisoformat(s.replace("Z", "+00:00"))
    except ValueError:
        v = None
        for fmt in ("%Y-%m-%d %H:%M:%S", "%Y-%m-%dT%H:%M:%S"):
            try:
                v = dt.datetime.strptime(s, fmt)
                break
            except ValueError:
                pass
    if v is None:
        return None
    if v.tzinfo is not None:
        v = v.astimezone(dt.timezone.utc).replace(tzinfo=None)
    return v


@pytest.fixture(scope="module")
def parsed(spark):
    df = spark.createDataFrame([(c,) for c in CASES], "s string")
    rows = parse(df).collect()
    return {r["s"]: r["t"] for r in rows}


@pytest.mark.parametrize("text", CASES)
def test_matches_python(parsed, text):
    assert parsed[text] == python_reference(text)


@pytest.mark.parametrize("text", sorted(DOCUMENTED_GAPS))
def test_documented_gaps_default(spark, text):
    r = parse(spark.createDataFrame([(text,)], "s string")).first()
    assert r["t"] is None


def test_generated_corpus(spark):
    """Random valid instants in several layouts round-trip exactly."""
    import random
    rnd = random.Random(7)
    texts, expect = [], []
    for _ in range(300):
        base = dt.datetime(2000, 1, 1) + dt.timedelta(seconds=rnd.randrange(0, 900_000_000),
                                                      microseconds=rnd.randrange(0, 1_000_000))
        off = dt.timedelta(minutes=rnd.choice([-480, -330, 0, 60, 330, 765]))
        tz = dt.timezone(off)
        local = base.replace(tzinfo=dt.timezone.utc).astimezone(tz)
        layout = rnd.randrange(5)
        if layout == 0:
            t = local.isoformat()
        elif layout == 1:
            t = local.replace(tzinfo=None).isoformat(sep=" ")
        elif layout == 2:
            t = local.strftime("%Y%m%dT%H%M%S") + local.strftime("%z")
        elif layout == 3:
            t = f"{local.year}-{local.month}-{local.day} {local.hour}:{local.minute}:{local.second}"
        else:
            t = local.strftime("%Y-%m-%dT%H:%M:%S,%f")
        texts.append(t)
        expect.append(python_reference(t))
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, s string")
    got = {r["i"]: r["t"] for r in parse(df).collect()}
    bad = [(texts[i], got[i], expect[i]) for i in range(len(texts)) if got[i] != expect[i]]
    assert not bad, bad[:5]
