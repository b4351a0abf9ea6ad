"""Comparing result tables."""

SF = "/root/testdata/sf0.001"


def normal(frame):
    """Rows as sorted tuples of texts, columns by name; numbers alike whatever their type."""
    import datetime
    import decimal
    import math

    def one(v):
        if v is None or v != v:
            return "-"
        if isinstance(v, bool) or type(v).__name__ == "bool_":
            return str(bool(v))
        if isinstance(v, (int, float, decimal.Decimal)) or hasattr(v, "dtype") and v.dtype.kind in "iuf":
            return repr(round(float(v), 9)) if math.isfinite(float(v)) else str(v)
        if isinstance(v, (datetime.date, datetime.datetime)):
            return str(v)[:10] if str(v)[10:].strip("T 0:.") == "" else str(v)
        return str(v)

    columns = sorted(frame.columns)
    return columns, sorted(tuple(one(v) for v in row) for row in frame[columns].astype(object).where(frame[columns].notna(), None).values.tolist())
