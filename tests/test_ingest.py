"""A refresh on literal rows: what is added, what is rejected, what the overview says."""

import datetime
import json

import pytest
from pyspark.sql import functions as F

from geomosaic.functions import names
from geomosaic.operators import catalog, ingest
from geomosaic.plans import refreshing
from geomosaic.session import shared_dir
from geomosaic.sources import readers, writers

ROOT = "/vsis3/b/"
SF_DIR = "/root/testdata/sf0.001"
CODE = 'PROJCS["f",GEOGCS["g",AUTHORITY["EPSG","4326"]],AUTHORITY["EPSG","32610"]]'


def header(path, x=0.0, kind="Byte"):
    return json.dumps(
        {
            "description": path,
            "cornerCoordinates": {"lowerLeft": [x, 0.0], "upperRight": [x + 300.0, 200.0]},
            "size": [30, 20],
            "bands": [{"type": kind}],
            "coordinateSystem": {"wkt": CODE},
            "driverShortName": "GTiff",
        }
    )


def headers_of(spark, docs):
    return readers.parse_headers(spark.createDataFrame([(d,) for d in docs], "doc string")).select(
        F.col("header.description").alias("path"), "header"
    )


def paths_of(spark, paths):
    return spark.createDataFrame([(p,) for p in paths], "path string")


def scene(day, pol="VV"):
    return f"{ROOT}k/S1A_IW_202401{day:02d}T000000_DVP_RTC30_G_gpuned_00FF_{pol}.tif"


def test_new_rows_and_rejects(spark):
    good, known, lost, odd, foreign = scene(1), scene(2), scene(3), scene(4), "/vsis3/other/x.tif"
    listing = paths_of(spark, [good, good, known, lost, odd, foreign])
    docs = [header(good), header(good), header(known), header(odd, kind="CInt16"), header(foreign), header("/vsis3/b/never")]
    rows = ingest.read_new(listing, headers_of(spark, docs), paths_of(spark, [known]), ROOT)
    reasons = {r.path: r.reject_reason for r in ingest.rejected(rows).collect()}
    assert reasons == {lost: "header", odd: "pixel type", foreign: "bucket"}
    (row,) = ingest.accepted(rows).collect()
    assert (row.path, row.name, row.n_rows, row.n_cols, row.n_bands) == (good, good[len(ROOT) + 2 : -4], 20, 30, 1)
    assert (row.x_min, row.y_max, row.pixel_type, row.srs) == (0.0, 200.0, 3, "32610")


def test_documents_may_be_text(spark):
    good = scene(1)
    docs = spark.createDataFrame([(good, header(good)), (scene(2), "not json")], "path string, doc string")
    rows = ingest.read_new(paths_of(spark, [good, scene(2)]), docs, paths_of(spark, []), ROOT)
    assert {r.path: r.reject_reason for r in rows.collect()} == {good: None, scene(2): "header"}


def test_bad_names_are_rejected(spark):
    rows = spark.createDataFrame([("S1A_IW_20240101T000000_DVP_RTC30_G_gpuned_00FF_VV",), ("short",)], "name string")
    checked = ingest.check_attributes(rows.withColumns(names.rtc_fields(F.col("name"), F.lit(""))), ("tag", "start_date"))
    assert {r.name: r.reject_reason for r in checked.collect()}["short"] == "name"
    assert ingest.accepted(checked).count() == 1


def rtc_items(spark):
    listed = [scene(1), scene(9), scene(5, "VH")]
    docs = [header(p, x=float(i * 100)) for i, p in enumerate(listed)]
    core = ingest.accepted(ingest.read_new(paths_of(spark, listed), headers_of(spark, docs), paths_of(spark, []), ROOT))
    fields = names.rtc_fields(F.col("name"), F.lit("u/"))
    sources = ingest.source_rows(core, "RTC", F.concat(F.lit("RTC_"), fields["tag"]), fields)
    return ingest.add_overviews(sources, "RTC", F.concat("dataset", F.lit("_overview")))


def test_rtc_refresh(spark):
    items = rtc_items(spark)
    assert items.count() == 5
    source = items.where("category = 1 and dataset = 'RTC_VH'").first()
    assert (source.max_ps, source.min_ps, source.low_ps, source.high_ps, source.center_x) == (1610.0, None, 10.0, 100.0, 350.0)
    row = items.where("category = 2 and dataset = 'RTC_VV'").first()
    assert (row["name"], row.tag, row.group_name, row.min_ps) == ("RTC_VV_overview", "Dataset", "Mosaic Overview", 1600.0)
    assert (row.x_min, row.x_max) == (0.0, 400.0)
    # eight hours before the first start and after the last start
    assert row.start_date == datetime.datetime(2023, 12, 31, 16)
    assert row.end_date == datetime.datetime(2024, 1, 9, 8)


def test_second_run_adds_nothing(spark, tmp_path):
    listed = [scene(1), scene(2)]
    held = str(tmp_path / "catalog")
    docs = headers_of(spark, [header(p) for p in listed])
    first = ingest.accepted(ingest.read_new(paths_of(spark, listed), docs, paths_of(spark, []), ROOT))
    writers.append_catalog(first, held)
    again = ingest.read_new(paths_of(spark, listed), docs, spark.read.parquet(held).select("path"), ROOT)
    assert again.count() == 0
    assert spark.read.parquet(held).count() == 2


def test_extents_come_in_web_mercator_and_odd_ones_are_rejected(spark):
    listed = [scene(k) for k in range(1, 6)]
    rows = ingest.read_new(paths_of(spark, listed), headers_of(spark, [header(p) for p in listed]), paths_of(spark, []), ROOT)
    day = F.substring("name", 14, 2).cast("int")
    rows = rows.withColumn("srs", F.get(F.array(*map(F.lit, ["32610", "3413", "x", "4326", "3857"])), day - 1))
    rows = rows.withColumn("x_max", F.when(day == 5, F.lit(float("inf"))).otherwise(F.col("x_max")))
    rows = rows.withColumn("reject_reason", F.when(day == 3, "header"))
    done = {int(r.name[13:15]): r for r in ingest.in_web_mercator(rows).collect()}
    assert [done[k].reject_reason for k in range(1, 6)] == [None, "epsg", "header", None, "extent"]
    assert done[1].x_min < -14_000_000 and done[4].y_max == pytest.approx(20037508.342789244)
    assert (done[2].x_min, done[5].y_max, done[4].srs, done[4].n_cols) == (None, None, "4326", 30)


def test_no_listing_gives_no_items(spark):
    rows = ingest.read_new(paths_of(spark, []), headers_of(spark, []), paths_of(spark, []), ROOT)
    assert rows.count() == 0


@pytest.mark.parametrize(
    ("family", "smallest"), [("RTC", 1600.0), ("OPERA", 450.0), ("COH", 900.0), ("SAMPLE", 800.0), ("HAND", 600.0)]
)
def test_overview_values(spark, family, smallest):
    row = (
        spark.range(1)
        .select(F.lit("OPERA_L2_RTC-S1_V1_VV").alias("_tag"), F.lit("P_COH06_VV_JJA_240131_0800_overview").alias("name"))
        .withColumn("tag", F.lit("Dataset"))
        .withColumns(ingest.overview_values(family))
        .first()
        .asDict()
    )
    assert (row["min_ps"], row["category"]) == (smallest, 2)
    want = {
        "RTC": {"tag": "Dataset", "group_name": "Mosaic Overview"},
        "OPERA": {"tag": "OPERA_L2_RTC-S1_V1_VV_Overview", "polarization": "VV", "download_url": ingest.ZOOM_URL},
        "COH": {"tag": "COH06_VV_JJA_Overview", "group_name": "COH06_VV_JJA Mosaic Overview", "tile": ingest.ZOOM_TILE},
        "SAMPLE": {"tag": "Dataset"},
        "HAND": {"tag": row["name"], "product_name": row["name"], "dataset_id": "Global_30m_HAND_Overview"},
    }[family]
    assert {k: row[k] for k in want} == want


def test_family_constants(spark):
    df = spark.createDataFrame([("OPERA",), ("RTC",)], "family string")
    got = {r.family: tuple(r)[1:] for r in catalog.with_family(df).collect()}
    assert got == {"OPERA": (460.0, 450.0, 450.0, 75), "RTC": (1610.0, 1600.0, 1200.0, 50)}


def test_shared_folder_is_the_session_setting(spark):
    assert shared_dir(spark) == spark.conf.get("spark.checkpoint.dir").rstrip("/")


def test_coherence_rows_without_a_known_season_are_rejected(spark):
    core = spark.createDataFrame(
        [("N01E046_summer_vv_COH06",), ("N01E046_summer_vv",), ("N01E046_monsoon_vv_COH06",), (None,)], "name string"
    )
    found = {r.name: r for r in ingest.season_attributes(core).collect()}
    assert {n: r.reject_reason for n, r in found.items()} == {
        "N01E046_summer_vv_COH06": None, "N01E046_summer_vv": "name", "N01E046_monsoon_vv_COH06": "season", None: "name",
    }
    assert found["N01E046_summer_vv_COH06"].season_code == "JJA"
    with pytest.raises(Exception, match="unknown season name: monsoon"):
        parsed = core.where("name like '%monsoon%'").withColumns(names.coh_fields(F.col("name")))
        catalog.with_every_season(parsed).select("season_code").collect()


def test_refreshes_leave_out_rejected_rows_and_rejects_count_them(spark, monkeypatch):
    read_new = ingest.read_new

    def spoiled(listing, headers, held, root):
        rows = read_new(listing, headers, held, root)
        bad = [rows.limit(1).withColumn("name", F.lit(n)) for n in ("a_b", "N01E046_monsoon_vv_COH06")]
        return rows.unionByName(bad[0]).unionByName(bad[1])

    before = {r.reject_reason: r.n for r in refreshing.refresh_rejects(spark, SF_DIR).collect()}
    coh, hand = refreshing.refresh_coh(spark, SF_DIR).count(), refreshing.refresh_hand(spark, SF_DIR).count()
    monkeypatch.setattr(ingest, "read_new", spoiled)
    after = {r.reject_reason: r.n for r in refreshing.refresh_rejects(spark, SF_DIR).collect()}
    assert after["name"] - before["name"] == 3 and after["season"] - before["season"] == 1
    assert before["epsg"] and before["extent"]
    assert refreshing.refresh_coh(spark, SF_DIR).count() == coh
    assert refreshing.refresh_hand(spark, SF_DIR).count() == hand
