"""National grid eastings and northings (EPSG:27700) to WGS84 degrees (EPSG:4326).

Inverse transverse Mercator on the Airy 1830 ellipsoid, then a seven-parameter
shift. Footpoint latitude and the final geodetic latitude come from closed
series, so the whole conversion is a straight chain of column arithmetic that
stays inside code generation.
"""

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# --- fixed values: published grid and datum parameters ------------------------
AIRY_A = 6377563.396
AIRY_B = 6356256.909
WGS84_A = 6378137.0
WGS84_B = 6356752.314245
SCALE = 0.9996012717
ORIGIN_LAT = 49.0
ORIGIN_LON = -2.0
FALSE_EASTING = 400000.0
FALSE_NORTHING = -100000.0
SHIFT_X, SHIFT_Y, SHIFT_Z = 446.448, -125.157, 542.060
ROT_X, ROT_Y, ROT_Z = (math.radians(s / 3600.0) for s in (0.1502, 0.2470, 0.8421))
SHIFT_SCALE = 1.0 - 20.4894e-6

# Derived once from the above.
N = (AIRY_A - AIRY_B) / (AIRY_A + AIRY_B)
AIRY_E2 = 1.0 - (AIRY_B / AIRY_A) ** 2
WGS84_E2 = 1.0 - (WGS84_B / WGS84_A) ** 2
WGS84_EP2 = WGS84_E2 / (1.0 - WGS84_E2)
RECTIFYING = AIRY_A / (1.0 + N) * (1.0 + N**2 / 4.0 + N**4 / 64.0)
ARC_TERMS = (
    -(3.0 * N / 2.0 - 9.0 * N**3 / 16.0),
    15.0 * N**2 / 16.0 - 15.0 * N**4 / 32.0,
    -35.0 * N**3 / 48.0,
    315.0 * N**4 / 512.0,
)
FOOT_TERMS = (
    3.0 * N / 2.0 - 27.0 * N**3 / 32.0,
    21.0 * N**2 / 16.0 - 55.0 * N**4 / 32.0,
    151.0 * N**3 / 96.0,
    1097.0 * N**4 / 512.0,
)
_ORIGIN_PHI = math.radians(ORIGIN_LAT)
ORIGIN_ARC = RECTIFYING * (
    _ORIGIN_PHI + sum(t * math.sin(2 * (k + 1) * _ORIGIN_PHI) for k, t in enumerate(ARC_TERMS))
)


def reproject(df: DataFrame, x: str = "x", y: str = "y",
              lon: str = "lon", lat: str = "lat") -> DataFrame:
    """Add ``lon`` and ``lat`` in degrees for grid coordinates in metres."""
    c = F.col
    steps = [
        {
            "_mu": (F.lit(ORIGIN_ARC) + (c(y) - FALSE_NORTHING) / SCALE) / RECTIFYING,
            "_de": c(x) - FALSE_EASTING,
        },
        {
            "_phi": c("_mu") + sum(
                (F.lit(t) * F.sin(c("_mu") * (2 * (k + 1))) for k, t in enumerate(FOOT_TERMS)),
                F.lit(0.0),
            ),
        },
        {"_s": F.sin("_phi"), "_c": F.cos("_phi"), "_t": F.tan("_phi")},
        {"_w": F.lit(1.0) - c("_s") * c("_s") * AIRY_E2, "_t2": c("_t") * c("_t")},
        {"_nu": F.lit(AIRY_A * SCALE) / F.sqrt("_w"), "_ratio": c("_w") / (1.0 - AIRY_E2)},
        # Easting offset in radii of curvature; ratio is nu / rho.
        {"_q": c("_de") / c("_nu"), "_eta2": c("_ratio") - 1.0},
        {"_q2": c("_q") * c("_q")},
        {
            "_phi_a": c("_phi") - c("_t") * c("_ratio") * c("_q2") * (
                F.lit(0.5)
                - c("_q2") / 24.0 * (c("_t2") * 3.0 + 5.0 + c("_eta2") - c("_t2") * c("_eta2") * 9.0)
                + c("_q2") * c("_q2") / 720.0 * (c("_t2") * 90.0 + 61.0 + c("_t2") * c("_t2") * 45.0)
            ),
            "_lam_a": F.lit(math.radians(ORIGIN_LON)) + c("_q") / c("_c") * (
                F.lit(1.0)
                - c("_q2") / 6.0 * (c("_ratio") + c("_t2") * 2.0)
                + c("_q2") * c("_q2") / 120.0 * (c("_t2") * 28.0 + 5.0 + c("_t2") * c("_t2") * 24.0)
                - c("_q2") * c("_q2") * c("_q2") / 5040.0 * (
                    c("_t2") * 662.0 + 61.0 + c("_t2") * c("_t2") * 1320.0
                    + c("_t2") * c("_t2") * c("_t2") * 720.0
                )
            ),
        },
        {"_sa": F.sin("_phi_a"), "_ca": F.cos("_phi_a")},
        {"_na": F.lit(AIRY_A) / F.sqrt(F.lit(1.0) - c("_sa") * c("_sa") * AIRY_E2)},
        {
            "_xa": c("_na") * c("_ca") * F.cos("_lam_a"),
            "_ya": c("_na") * c("_ca") * F.sin("_lam_a"),
            "_za": c("_na") * c("_sa") * (1.0 - AIRY_E2),
        },
        {
            "_xw": c("_xa") * SHIFT_SCALE - c("_ya") * ROT_Z + c("_za") * ROT_Y + SHIFT_X,
            "_yw": c("_xa") * ROT_Z + c("_ya") * SHIFT_SCALE - c("_za") * ROT_X + SHIFT_Y,
            "_zw": c("_ya") * ROT_X - c("_xa") * ROT_Y + c("_za") * SHIFT_SCALE + SHIFT_Z,
        },
        {"_p": F.sqrt(c("_xw") * c("_xw") + c("_yw") * c("_yw"))},
        {"_theta": F.atan2(c("_zw") * WGS84_A, c("_p") * WGS84_B)},
        {"_st": F.sin("_theta"), "_ct": F.cos("_theta")},
        {
            lat: F.degrees(F.atan2(
                c("_zw") + c("_st") * c("_st") * c("_st") * (WGS84_EP2 * WGS84_B),
                c("_p") - c("_ct") * c("_ct") * c("_ct") * (WGS84_E2 * WGS84_A),
            )),
            lon: F.degrees(F.atan2(c("_yw"), c("_xw"))),
        },
    ]
    out = df
    for step in steps:
        out = out.withColumns(step)
    return out.select(*df.columns, lon, lat)
