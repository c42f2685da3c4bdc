"""Small swaths with known geometry."""

import numpy as np

SCHEMA = ("granule_id long, pixel_id long, row_idx int, col_idx int, obs_time timestamp, lat double, lon double, "
          "value double, qa double")


def swath(spark, rows=8, cols=7, granule=1, value=lambda la, lo: 1.0, lat0=21.03, lon0=119.02, dlat=0.31, dlon=0.27,
          skew=0.02, qa=1.0, holes=()):
    from datetime import datetime

    data = []
    for r in range(rows):
        for c in range(cols):
            la, lo = lat0 + dlat * r + skew * c, lon0 + dlon * c - skew * r
            v = None if (r, c) in holes else float(value(la, lo))
            data.append((granule, granule * 10_000 + r * cols + c, r, c, datetime(2024, 1, granule), float(la), float(lo), v, qa))
    return spark.createDataFrame(data, SCHEMA)


def arrays(df):
    """Dense lat, lon and value of a one-granule frame."""
    pdf = df.toPandas().sort_values(["row_idx", "col_idx"])
    shape = (pdf.row_idx.max() + 1, pdf.col_idx.max() + 1)
    return [pdf[c].to_numpy(dtype=float).reshape(shape) for c in ("lat", "lon", "value")]


def corners(a):
    """Corner rule on a dense array, one axis after the other."""
    def axis(x):
        inner = (x[1:] + x[:-1]) / 2
        first, last = x[0] + (x[1] - x[2]) / 2, x[-1] + (x[-2] - x[-3]) / 2
        return np.concatenate([[first], inner, [last]])
    return axis(axis(a).T).T
