"""Real files: listing, decode scan and the whole preparation run."""

from __future__ import annotations

import hashlib
import os
import tempfile

import numpy as np
from pyspark.sql import functions as F

from specimen.functions import kernels as K
from specimen.operators import catalog as cat
from specimen.plans.jobs import prepare_dataset
from specimen.sources import images as src
from specimen.sources.carriers import _synth_pixels


def _tree_digest(root):
    out = {}
    for d, _, files in os.walk(root):
        for f in files:
            p = os.path.join(d, f)
            with open(p, "rb") as fh:
                out[p] = hashlib.md5(fh.read()).hexdigest()
    return out


def test_listing_has_zero_byte_and_hidden_files(spark, image_root):
    names = {os.path.basename(r["path"]) for r in src.list_images(spark, [image_root]).collect()}
    assert "notes.txt" not in names and "metadata.csv" not in names
    assert {"IMG_5.jpg", "_IMG_10.jpg", "IMG_11.jPg"} <= names      # zero bytes, hidden, any case
    assert {"IMG_1.jpg", "IMG_2.JPG", "IMG_2.jpg", "IMG_3.jpeg", "IMG_4.jpg"} <= names


def test_listing_of_a_missing_folder_is_empty(spark, image_root):
    assert src.list_files(spark, [os.path.join(image_root, "nope")]).count() == 0
    nested = src.list_files(spark, [image_root])
    flat = src.list_files(spark, [image_root], recursive=False)
    assert nested.count() > flat.count() >= 1
    sizes = {os.path.basename(r["path"]): r["length"] for r in nested.collect()}
    assert sizes["IMG_5.jpg"] == 0 and sizes["notes.txt"] == 12


def test_decode_scan(spark, image_root):
    rows = {os.path.basename(r["path"]): r for r in
            src.read_images(spark, [os.path.join(image_root, "part_1"),
                                    os.path.join(image_root, "part_2")]).collect()}
    one = next(r for k, r in rows.items() if k.startswith("IMG_1."))
    assert (one["height"], one["width"], one["n_channels"]) == (64, 64, 3)
    bgr = np.frombuffer(one["data"], np.uint8).reshape(64, 64, 3)
    assert (bgr[:, :, ::-1] == _synth_pixels(1)).all()          # BGR byte order
    junk = next(r for k, r in rows.items() if k.startswith("IMG_4."))
    assert junk["height"] == -1
    grey = next(r for k, r in rows.items() if k.startswith("IMG_7."))
    assert (grey["height"], grey["width"]) == (40, 30)
    for name in ("IMG_12", "IMG_13"):       # grey and alpha files come as three channels
        r = next(r for k, r in rows.items() if k.startswith(name + "."))
        assert r["n_channels"] == 3 and len(r["data"]) == 3 * r["height"] * r["width"]


def test_prepare_dataset_end_to_end(spark, image_root):
    before = _tree_digest(image_root)
    out = tempfile.mkdtemp(prefix="specimen-out-")
    rep = prepare_dataset(spark, os.path.join(image_root, "metadata.csv"), image_root, out,
                          fraction=1.0)
    assert _tree_digest(image_root) == before          # inputs never modified (M5, M14)

    clean = spark.read.parquet(f"{out}/clean")
    kept = sorted(r["image_id"] for r in clean.collect())
    # IMG_1 quarantined via its repeated null-age row, IMG_3 null age, IMG_9 no file, null id dropped
    assert kept == ["IMG_12", "IMG_13", "IMG_2", "IMG_4", "IMG_5", "IMG_6", "IMG_7", "IMG_8"]
    paths = {r["image_id"]: r["img_path"] for r in clean.collect()}
    assert paths["IMG_2"].endswith("part_1/IMG_2.JPG")        # part 1 wins over part 2

    status = {r["status"]: r["n"] for r in rep["status_counts"].collect()}
    assert status == {"SUCCESS": 6, "FAILED": 2}               # IMG_4 is junk, IMG_5 empty
    rate = rep["success_rate"].first()
    assert rate["n_rows"] == 8 and abs(rate["success_rate"] - 75.0) < 1e-9

    derived = spark.read.parquet(f"{out}/derived")
    pre = derived.filter(F.col("kind") == "preprocessed")
    for r in pre.filter(F.col("status") == "SUCCESS").collect():
        assert (r["height"], r["width"], r["n_channels"]) == (128, 128, 3)
    assert pre.count() == 8                               # one row per distinct file
    img2 = pre.filter(F.col("img_path").endswith("/IMG_2.JPG")).first()
    exp = K.preprocess(_synth_pixels(2)[:, :, ::-1])
    assert bytes(img2["data"]) == exp.tobytes()

    counts = {r["variant"]: r["n"] for r in rep["variant_counts"].collect()}
    # 6 readable images; the 1x1 image cannot be zoomed
    assert counts["_rot90"] == 6 and counts["_zoomin"] == 5 and counts["_zoomout"] == 5
    assert counts["TOTAL"] == 6 * 9 - 2
    totals = {r["node"]: r for r in rep["augment_totals"].collect()}
    assert totals[0]["originals"] == 8 and totals[0]["variants_ok"] == 52
    assert totals[0]["variants_failed"] == 2 * 9 + 2
    assert totals[1]["originals"] == 4 and totals[2]["originals"] == 4
    deficit = {r["value"]: r["deficit"] for r in rep["class_deficit"].collect()}
    result = {r["value"]: r for r in rep["balance_result"].collect()}
    for value, need in deficit.items():
        assert result[value]["planned"] == need and result[value]["made"] + result[value]["still_missing"] == need
    overview = {(r["metric"], r["value"]): r["n"] for r in rep["dataset_overview"].collect()}
    assert overview["images", None] >= 8 and sum(v == "label" for v, _ in overview) >= 2 and rep["column_profile"].count() == 7
    assert rep["dataset_ready"].first()["ready"]
    assert spark.read.parquet(f"{out}/reports/frequency_report").count() == rep["frequency_report"].count()

    v = derived.filter(F.col("img_path").endswith("/IMG_2.JPG") &
                       (F.col("kind") == "_rot90")).first()
    rot = np.frombuffer(v["data"], np.uint8).reshape(v["height"], v["width"], 3)
    assert (rot == K.rotate(_synth_pixels(2)[:, :, ::-1], 90)).all()
    assert derived.filter(F.col("kind") != "preprocessed").count() == 8 * 9

    schema = {r["column_name"]: r["data_type"] for r in rep["schema"].collect()}
    assert schema["age"] == "double" and schema["img_path"] == "string"
    assert rep["summary"].first()["n_rows"] == 8


def test_prepare_with_one_part_and_image_files(spark, image_root):
    import shutil
    root, out = tempfile.mkdtemp(prefix="specimen-one-"), tempfile.mkdtemp(prefix="specimen-one-out-")
    shutil.copytree(os.path.join(image_root, "part_1"), os.path.join(root, "part_1"))
    meta = os.path.join(image_root, "metadata.csv")
    rep = prepare_dataset(spark, meta, root, out, image_files=True)
    assert {r["image_id"] for r in spark.read.parquet(f"{out}/clean").collect()} >= {"IMG_2", "IMG_8"}
    written = sum(len(f) for _, _, f in os.walk(f"{out}/files"))
    assert written == {r["variant"]: r["n"] for r in rep["variant_counts"].collect()}["TOTAL"] > 0
    import pytest
    with pytest.raises(ValueError):
        prepare_dataset(spark, meta, tempfile.mkdtemp(prefix="specimen-none-"), out)


def test_image_files_of_one_id_stay_apart(spark):
    folder = tempfile.mkdtemp(prefix="specimen-files-")
    img = np.zeros((2, 2, 3), np.uint8)
    rows = spark.createDataFrame([(f"/d/part_{p}/A.jpg", "A", 2, 2, 3, bytearray(img.tobytes())) for p in (1, 2)],
                                 "path string, image_id string, height int, width int, n_channels int, data binary")
    assert len({r["path"] for r in src.write_image_files(rows, folder).collect()}) == 2
    assert sum(len(f) for _, _, f in os.walk(folder)) == 2


def test_catalog_from_real_listing(spark, image_root):
    parts = cat.part_dirs_under(image_root)
    ready = cat.dataset_ready(src.list_files(spark, [image_root]),
                              spark.read.option("header", True).csv(
                                  os.path.join(image_root, "metadata.csv")), parts).first()
    assert ready["ready"] and ready["part1_images"] >= 3


def test_hot_path_is_processed_once(spark, image_root):
    """A third of the rows point at one file: it is decoded and processed once,
    and every row still gets its status."""
    from specimen.plans import jobs
    parts = cat.part_dirs_under(image_root)
    pixels = src.read_images(spark, parts)
    hot = os.path.join(image_root, "part_1", "IMG_1.jpg")
    other = os.path.join(image_root, "part_2", "IMG_3.jpeg")
    rows = spark.createDataFrame(
        [(f"R{i}", hot if i % 3 == 0 else (other if i % 3 == 1 else None)) for i in range(300)],
        "image_id string, img_path string")
    processed = jobs.preprocessed_images(rows, pixels)
    assert processed.count() == 2                      # two distinct files, once each
    status = {r["status"]: r["n"] for r in
              jobs.preprocess_dataset(rows, pixels).groupBy("status").count()
              .withColumnRenamed("count", "n").collect()}
    assert status == {"SUCCESS": 200, "SKIPPED": 100}


def test_command_line_run(image_root, capsys):
    from specimen.plans import prepare
    out = tempfile.mkdtemp(prefix="specimen-cli-")
    assert prepare.main(["--metadata", os.path.join(image_root, "metadata.csv"),
                         "--root", image_root, "--out", out, "--fraction", "1.0"]) == 0
    text = capsys.readouterr().out
    assert "== frequency_report" in text and "== status_counts" in text
    assert os.path.isdir(os.path.join(out, "derived"))


def test_path_driven_decode_matches_decode_scan(spark, image_root):
    """Reading only the selected files by path gives the same derived images
    as the decode scan of the whole folder followed by a semi join."""
    from tests.conftest import png_decoder
    meta = os.path.join(image_root, "metadata.csv")
    out_a, out_b = tempfile.mkdtemp(prefix="specimen-a-"), tempfile.mkdtemp(prefix="specimen-b-")
    rep_a = prepare_dataset(spark, meta, image_root, out_a, fraction=1.0)
    rep_b = prepare_dataset(spark, meta, image_root, out_b, fraction=1.0, decoder=png_decoder)
    cols = ["img_path", "kind", "ok", "status", "height", "width", "data"]
    a = {tuple(r) for r in spark.read.parquet(f"{out_a}/derived").select(*cols).collect()}
    b = {tuple(r) for r in spark.read.parquet(f"{out_b}/derived").select(*cols).collect()}
    assert a == b and len(a) == 8 * 10
    for name in ("status_counts", "augment_totals", "variant_counts"):
        assert {tuple(r) for r in rep_a[name].collect()} == {tuple(r) for r in rep_b[name].collect()}


def test_decode_paths_opens_only_listed_files(spark, image_root):
    from tests.conftest import png_decoder
    wanted = [os.path.join(image_root, "part_2", "IMG_3.jpeg"),
              os.path.join(image_root, "part_2", "IMG_4.jpg"),        # junk
              os.path.join(image_root, "part_1", "nope.jpg")]         # missing
    paths = spark.createDataFrame([(p,) for p in wanted], "img_path string")
    got = {r["img_path"]: r for r in src.decode_paths(paths, png_decoder).collect()}
    assert set(got) == set(wanted[:2])                        # a missing file gives no row
    assert got[wanted[0]]["height"] == 64 and got[wanted[1]]["height"] == -1


def test_metadata_csv_by_header_name_any_order(spark):
    from specimen.operators import cleaning
    from specimen.sources import metadata as sm
    d = tempfile.mkdtemp(prefix="specimen-csv-")
    path = os.path.join(d, "meta.csv")
    with open(path, "w") as f:
        f.write("lesion_id,image_id,dx,dx_type,age,sex,localization,extra\n")
        f.write("L1,IMG_1,bkl,histo,80.0,male,scalp,x\n")
        f.write("L2,IMG_2,nv,follow_up,,female,back,y\n")
        f.write("L3,IMG_3,mel,histo,old,male,face,z\n")
    for infer in (False, True):
        raw = sm.read_metadata_csv(spark, path, infer=infer)
        got = cleaning.cast_metadata(cleaning.project_metadata(raw))
        assert got.columns == ["image_id", "dx", "dx_type", "sex", "age", "localization"]
        rows = {r["image_id"]: r for r in got.collect()}
        assert rows["IMG_1"]["age"] == 80.0 and rows["IMG_1"]["sex"] == "male"
        assert rows["IMG_2"]["age"] is None and rows["IMG_3"]["age"] is None


def test_path_driven_statuses(spark, image_root):
    from specimen.plans import jobs
    from tests.conftest import png_decoder
    rows = spark.createDataFrame([
        ("A", os.path.join(image_root, "part_1", "IMG_1.jpg")),
        ("B", os.path.join(image_root, "part_2", "IMG_4.jpg")),       # junk
        ("C", os.path.join(image_root, "part_1", "gone.jpg")),        # missing
        ("D", None)], "image_id string, img_path string")
    selected = jobs.decode_selected(rows, png_decoder)
    done = jobs.preprocess_images(selected)
    got = {r["image_id"]: r["status"] for r in
           jobs.preprocess_dataset(rows, None, processed=done).collect()}
    assert got == {"A": "SUCCESS", "B": "FAILED", "C": "SKIPPED", "D": "SKIPPED"}


def test_warns_when_skew_join_is_off(spark, image_root):
    import pytest
    from specimen.plans.jobs import _check_adaptive
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "false")
    try:
        with pytest.warns(RuntimeWarning):
            _check_adaptive(spark)
    finally:
        spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "true")


def test_prepare_accepts_file_uri_root(spark, image_root):
    out = tempfile.mkdtemp(prefix="specimen-uri-")
    rep = prepare_dataset(spark, "file:" + os.path.join(image_root, "metadata.csv"),
                          "file://" + image_root, out, fraction=1.0)
    assert {r["status"]: r["n"] for r in rep["status_counts"].collect()} == {"SUCCESS": 6, "FAILED": 2}


def test_command_line_bernoulli_sample(image_root, capsys):
    from specimen.plans import prepare
    out = tempfile.mkdtemp(prefix="specimen-cli-b-")
    assert prepare.main(["--metadata", os.path.join(image_root, "metadata.csv"),
                         "--root", image_root, "--out", out, "--fraction", "0.5",
                         "--sample-mode", "bernoulli"]) == 0
    assert "== summary" in capsys.readouterr().out


def test_a_flat_folder_is_sized_by_several_tasks_and_equals_its_inventory(spark):
    root = tempfile.mkdtemp(prefix="specimen-flat-")
    os.makedirs(os.path.join(root, "sub"))
    for i in range(12_000):
        with open(os.path.join(root, f"IMG_{i}.jpg"), "wb") as f:
            f.write(b"x" * (i % 3))
    for name in ("_h.jpg", ".h.jpg", "sub/IMG_0.jpg", "notes.txt"):
        with open(os.path.join(root, name), "wb") as f:
            f.write(b"yy")
    want = {(os.path.join(d, f), os.path.getsize(os.path.join(d, f))) for d, _, names in os.walk(root) for f in names}
    listed = src.list_files(spark, [root])
    assert {tuple(r) for r in listed.collect()} == want and listed.count() == len(want)
    sizes = listed.filter("length is not null").select(F.input_file_name().alias("f")).distinct().filter(F.col("f").contains("/sizes-"))
    assert sizes.count() > 1                                     # sizes were read by several tasks
    report = spark.createDataFrame([*want, *list(want)[:5], ("/elsewhere/a.jpg", 1), (None, 3), (root + "/sub/", None),
                                    (root + "x/b.jpg", 2)], "path string, length long")
    assert {tuple(r) for r in src.inventory_files(report, ["file://" + root]).collect()} == want
    flat = {tuple(r) for r in src.inventory_files(report, [root + "/"], recursive=False).collect()}
    assert flat == {(p, n) for p, n in want if "/sub/" not in p} == {
        tuple(r) for r in src.list_files(spark, [root], recursive=False).collect()}


def test_files_are_dealt_by_bytes(spark):
    files = spark.range(4_000).select(F.concat(F.lit("/d/"), "id").alias("path"),
                                      F.when(F.col("id") % 50 == 0, 200_000).otherwise(F.when(F.col("id") % 7 > 0, 1_000)).alias("length"))
    dealt = src.deal_by_bytes(files, 8)
    per = dealt.groupBy(F.spark_partition_id().alias("p")).agg(F.sum(F.coalesce("length", F.lit(0))).alias("b"), F.count("*").alias("n")).collect()
    assert len(per) == 8 and sum(r["n"] for r in per) == 4_000
    assert max(r["b"] for r in per) < 1.35 * sum(r["b"] for r in per) / 8
    assert src.deal_by_bytes(files.limit(0), 8).count() == 0


def test_default_run_opens_selected_and_hidden_files_only(spark, image_root, monkeypatch):
    from specimen.plans import jobs
    from tests.conftest import png_decoder
    listing = src.list_images(spark, [image_root])
    rows = listing.filter(F.col("path").contains("IMG_10") | F.col("path").contains("IMG_5") | F.col("path").contains("IMG_1."))
    hidden = [r["path"] for r in rows.collect() if os.path.basename(r["path"]).startswith("_")]
    assert hidden
    got = {r["img_path"]: r["height"] for r in jobs.decode_selected(
        rows.select(F.col("path").alias("img_path")), png_decoder, listing).collect()}
    assert set(got) == {r["path"] for r in rows.collect()}       # nothing else was opened
    for p in got:                                                # hidden names are read, empty files unreadable
        assert (got[p] == -1) == (os.path.getsize(p) == 0 or png_or_none(p) is None)


def png_or_none(path):
    from tests.conftest import png_decoder
    try:
        with open(path, "rb") as f:
            return png_decoder(f.read())
    except Exception:  # noqa: BLE001
        return None
