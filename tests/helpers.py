import datetime as dt

from meteocube.schema import RAW_SCHEMA


def raw_df(spark, rows):
    """rows: (DATE, LAT, LON, TMP, DEW, WND_RATE, SLP) with DATE as 'yyyy-mm-dd HH:MM' or datetime."""
    out = []
    for r in rows:
        d = r[0]
        if isinstance(d, str):
            d = dt.datetime.fromisoformat(d)
        out.append((d, *r[1:]))
    return spark.createDataFrame(out, RAW_SCHEMA)


def plan_text(df, mode="formatted"):
    import contextlib
    import io

    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode)
    return buf.getvalue()
