"""Order-insensitive comparison of two pandas frames (columns by name)."""

import math


def _norm(v):
    if v is None or type(v).__name__ in ("NAType", "NaTType"):
        return None
    if hasattr(v, "item") and not isinstance(v, (list, tuple, str)):
        try:
            v = v.item()
        except Exception:  # noqa: BLE001
            pass
    if isinstance(v, float):
        if math.isnan(v):
            return None
        if v == 0 and math.copysign(1.0, v) < 0:
            return "-0.0"
        return round(v, 9)
    if hasattr(v, "isoformat"):
        t = str(v)[:19]
        return t[:10] if t.endswith("00:00:00") else t
    return v


def rows(pdf):
    cols = sorted(pdf.columns)
    out = [tuple(_norm(x) for x in r) for r in pdf[cols].itertuples(index=False, name=None)]
    return cols, sorted(out, key=lambda t: tuple((x is None, str(x)) for x in t))


def assert_same(a, b):
    ca, ra = rows(a)
    cb, rb = rows(b)
    assert ca == cb, (ca, cb)
    assert len(ra) == len(rb), (len(ra), len(rb))
    bad = [(x, y) for x, y in zip(ra, rb) if x != y]
    assert not bad, bad[:3]
