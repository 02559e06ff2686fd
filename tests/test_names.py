"""Name grammars, header parts, text and dates on literal rows."""

import datetime

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from geomosaic.functions import dates, names, projection, scales, text
from geomosaic.functions import headers as H


def one(spark, columns, **values):
    row = spark.range(1).select(*[F.lit(v).alias(k) for k, v in values.items()] or ["id"])
    return row.select(*[c.alias(n) for n, c in columns.items()]).first().asDict()


@pytest.mark.parametrize(
    ("path", "stem"),
    [("/vsis3/b/k/a.b.tif", "a.b"), ("a.tif", "a"), ("/x/plain", "plain"), ("/x/.hidden", ".hidden"), ("", "")],
)
def test_stem(spark, path, stem):
    assert one(spark, {"s": names.stem(F.col("p"))}, p=path)["s"] == stem


def test_paths(spark):
    out = one(
        spark,
        {
            "vsi": names.vsi_path(F.lit("b"), F.lit("k/x.tif")),
            "s3": names.vsi_to_s3(F.lit("/vsis3/b/x")),
            "back": names.s3_to_vsi(F.lit("s3://b/x")),
            "cut": names.strip_prefix(F.lit("/vsis3/b/k/x.tif"), F.lit("/vsis3/b/")),
        },
    )
    assert out == {"vsi": "/vsis3/b/k/x.tif", "s3": "s3://b/x", "back": "/vsis3/b/x", "cut": "k/x.tif"}


def test_rtc_grammar(spark):
    name = "S1A_IW_20240102T030405_DVP_RTC30_G_gpuned_00FF_VV"
    out = one(spark, names.rtc_fields(F.col("n"), F.lit("https://x/")), n=name)
    assert out["tag"] == "VV"
    assert out["group_name"] == name[:46]
    assert out["start_date"] == out["end_date"] == datetime.datetime(2024, 1, 2, 3, 4, 5)
    assert out["download_url"] == f"https://x/{name}.tif"


def test_opera_grammar(spark):
    name = "OPERA_L2_RTC-S1_T009-000123-IW1_20240102T030405Z_20240103T000000Z_S1A_30_v1.0_VH"
    out = one(spark, names.opera_fields(F.col("n"), "V1", F.lit("https://x/")), n=name)
    assert out["tag"] == "OPERA_L2_RTC-S1_V1_VH"
    assert out["group_name"] == name[:-3]
    assert out["polarization"] == "VH"
    assert out["start_date"] == datetime.datetime(2024, 1, 2, 3, 4, 5)
    assert out["url_display"] == name


def test_coh_grammar_needs_four_tokens(spark):
    good = one(spark, names.coh_fields(F.col("n")), n="N01E046_summer_vv_COH06")
    assert good == {"tile": "N01E046", "season_name": "summer", "polarization": "VV", "product_type": "COH06"}
    for bad in ("N01E046_summer_vv", "N01E046_summer_vv_COH06_x", ""):
        assert set(one(spark, names.coh_fields(F.col("n")), n=bad).values()) == {None}


def test_hand_grammar(spark):
    out = one(spark, names.hand_fields(F.col("n"), F.lit("u/")), n="Copernicus_DSM_COG_10_N47_00_W122_00_HAND")
    assert (out["tile"], out["product_name"], out["tag"]) == ("N47W122", "GLO30_HAND_N47W122", "GLO30_HAND")


def test_hand_pattern_drops_the_pole(spark):
    paths = [f"/vsis3/b/Copernicus_DSM_COG_10_{lat}_00_E001_00_HAND.tif" for lat in ("N89", "S90", "N00")]
    df = spark.createDataFrame([(p,) for p in paths], "path string")
    kept = {r.path for r in df.where(F.col("path").rlike(f"^(?:{names.HAND_PATTERN})$")).collect()}
    assert kept == {paths[0], paths[2]}


def test_short_names_give_nulls(spark):
    out = one(spark, names.rtc_fields(F.col("n"), F.lit("")), n="too_short")
    assert out["tag"] is None and out["start_date"] is None
    out = one(spark, names.opera_fields(F.col("n"), "V1", F.lit("")), n="too_short")
    assert out["tag"] is None and out["polarization"] is None and out["start_date"] is None


def test_overview_name(spark):
    out = one(spark, names.overview_parts(F.lit("P_COH06_VV_JJA_240131_0800_overview")))
    assert out == {"product_type": "COH06", "polarization": "VV", "season_code": "JJA"}
    assert set(one(spark, names.overview_parts(F.lit("a_b"))).values()) == {None}


@pytest.mark.parametrize(("pol", "word"), [("VH", "volume"), ("VV", "roughness"), ("HH", "double-bounce"), ("XX", "")])
def test_polarization_class(spark, pol, word):
    note = one(spark, {"n": names.polarization_class(F.lit(pol))})["n"]
    assert word in note if word else note == ""


def test_suffix_and_interval(spark):
    out = one(
        spark,
        {
            "p": names.suffix_polarization(F.lit("_VV.tif")),
            "i": names.product_interval(F.lit("COH06")),
            "bad": names.product_interval(F.lit("COHxx")),
        },
    )
    assert out == {"p": "VV", "i": 6, "bad": None}


def test_run_name(spark):
    when = F.lit("2024-01-31 08:05:09").cast("timestamp_ntz")
    assert one(spark, {"n": names.run_name(F.lit("P"), F.lit("D"), when)})["n"] == "P_D_240131_0805"


def test_catalog_time_round_trip(spark):
    text_in = "01/31/2024 23:59:58"
    out = one(spark, {"t": names.catalog_time(F.lit(text_in)), "bad": names.catalog_time(F.lit("31/31/2024 00:00:00"))})
    assert out == {"t": datetime.datetime(2024, 1, 31, 23, 59, 58), "bad": None}
    assert one(spark, {"s": names.catalog_text(names.catalog_time(F.lit(text_in)))})["s"] == text_in


def test_pixel_type(spark):
    for name, code in (("Byte", 3), ("Int16", 6), ("Float32", 9), ("CInt16", None)):
        assert one(spark, {"c": H.pixel_type(F.lit(name))})["c"] == code
    with pytest.raises(PySparkException, match="no pixel type for band type CInt16"):
        one(spark, {"c": H.pixel_type(F.col("b"), strict=True)}, b="CInt16")


def test_root_epsg(spark):
    wkt = 'PROJCS["a",GEOGCS["g",AUTHORITY["EPSG","4326"]],AUTHORITY["EPSG","32610"]]'
    assert one(spark, {"e": H.root_epsg(F.lit(wkt))})["e"] == "32610"
    inner_only = 'PROJCS["a",GEOGCS["g",AUTHORITY["EPSG","4326"]],UNIT["m",1]]'
    assert one(spark, {"e": H.root_epsg(F.lit(inner_only))})["e"] is None


def test_render(spark):
    fields = {"a": F.lit(6), "b": F.lit("x")}
    assert one(spark, {"t": text.render("{{ a }}-day {{b}}!", fields)})["t"] == "6-day x!"
    with pytest.raises(KeyError):
        text.render("{{ missing }}", fields)
    with pytest.raises(ValueError, match="unfinished"):
        text.render("{{ a", fields)


def test_templates(spark):
    two = F.array(F.lit("A.xml"), F.lit("B.xml"))
    none = F.array().cast("array<string>")
    out = one(
        spark,
        {
            "two": text.template_list(two, "d"),
            "none": text.template_list(none, "d"),
            "default": text.default_template(F.lit("A.xml"), "d"),
            "word": text.default_template(F.lit("None"), "d"),
        },
    )
    assert out == {"two": "d/A.xml;d/B.xml;None", "none": "None", "default": "d/A.xml", "word": "None"}


def test_interval_math(spark):
    when = F.lit("2024-01-31 00:00:00.9").cast("timestamp_ntz")
    out = one(
        spark,
        {
            "lead": dates.overview_start(when),
            "lag": dates.overview_end(when),
            "from": dates.range_start(F.lit("2024-01-31").cast("timestamp_ntz")),
            "ms": dates.epoch_ms(F.lit("1970-01-02").cast("timestamp_ntz")),
        },
    )
    assert out["lead"] == datetime.datetime(2024, 1, 30, 16)
    assert out["lag"] == datetime.datetime(2024, 1, 31, 8)
    assert out["from"] == datetime.datetime(2023, 2, 2)
    assert out["ms"] == 86_400_000


def test_scales_agree(spark):
    dn = F.lit(12345.0)
    out = one(spark, {"p": scales.power_db(scales.amplitude_power(dn)), "d": scales.amplitude_db(dn)})
    assert out["p"] == pytest.approx(out["d"], abs=1e-6)
    assert one(spark, {"z": scales.amplitude_db(F.lit(0.0))})["z"] is None


def test_stretch_edges(spark):
    low, high = F.lit(1.0), F.lit(3.0)
    for value, want in ((0.0, 0.0), (1.0, 0.0), (2.0, 127.5), (3.0, 255.0), (9.0, 255.0), (None, None)):
        got = one(spark, {"s": scales.stretch(F.lit(value).cast("double"), low, high)})["s"]
        assert got == want
    assert one(spark, {"s": scales.stretch(F.lit(1.0), low, low)})["s"] == 0.0


def test_valid_range(spark):
    for value, want in ((-1.0, None), (0.0, 0.0), (4294967295.0, 4294967295.0), (4294967296.0, None)):
        assert one(spark, {"v": scales.valid(F.lit(value))})["v"] == want


def forward_utm(longitude, latitude, zone):
    """The forward series, written apart from the library's inverse one."""
    import math

    a, f, k0 = 6378137.0, 1 / 298.257223563, 0.9996
    n = f / (2 - f)
    big_a = a / (1 + n) * (1 + n**2 / 4 + n**4 / 64)
    alpha = (
        n / 2 - 2 * n**2 / 3 + 5 * n**3 / 16 + 41 * n**4 / 180,
        13 * n**2 / 48 - 3 * n**3 / 5 + 557 * n**4 / 1440,
        61 * n**3 / 240 - 103 * n**4 / 140,
        49561 * n**4 / 161280,
    )
    phi, lam = math.radians(latitude), math.radians(longitude - (6 * zone - 183))
    c = 2 * math.sqrt(n) / (1 + n)
    t = math.sinh(math.atanh(math.sin(phi)) - c * math.atanh(c * math.sin(phi)))
    xi, eta = math.atan2(t, math.cos(lam)), math.atanh(math.sin(lam) / math.sqrt(1 + t * t))
    east = eta + sum(al * math.cos(2 * j * xi) * math.sinh(2 * j * eta) for j, al in enumerate(alpha, 1))
    north = xi + sum(al * math.sin(2 * j * xi) * math.cosh(2 * j * eta) for j, al in enumerate(alpha, 1))
    return 500000 + k0 * big_a * east, k0 * big_a * north + (0 if latitude >= 0 else 10000000)


def mercator(spark, epsg, x, y):
    df = spark.range(1).select(F.lit(epsg).alias("epsg"))
    row = projection.to_mercator(df, "epsg", {"p": F.lit(x)}, {"q": F.lit(y)}).first()
    return row.mx_pq, row.my_pq


@pytest.mark.parametrize(
    ("lon", "lat", "zone"), [(-121.5, 47.25, 10), (2.9, 0.001, 31), (146.0, -43.5, 55), (10.0, 79.9, 32), (-3.1, 83.0, 30)]
)
def test_utm_against_the_forward_series(spark, lon, lat, zone):
    import math

    east, north = forward_utm(lon, lat, zone)
    out = mercator(spark, (32600 if lat >= 0 else 32700) + zone, east, north)
    assert out[0] == pytest.approx(math.radians(lon) * 6378137, abs=1e-3)
    assert out[1] == pytest.approx(6378137 * math.asinh(math.tan(math.radians(lat))), abs=1e-3)


def test_other_codes_are_not_projected(spark):
    assert mercator(spark, 3413, 1.0, 2.0) == (None, None)
    assert mercator(spark, 32661, 1.0, 2.0) == (None, None)
    assert mercator(spark, 3857, 1.0, 2.0) == (1.0, 2.0)
    assert mercator(spark, 4326, 180.0, 0.0) == pytest.approx((20037508.342789244, 0.0))
