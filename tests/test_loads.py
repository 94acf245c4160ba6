"""Loads over real files: CSV releases, staging, numbering, inserts, streaming."""

from __future__ import annotations

import csv

import pytest
from conftest import rows
from pyspark.sql import functions as F

from assayline import session
from assayline.operators import compare, inserts, numbering, quality, reshape
from assayline.plans import loads, star
from assayline.sources import catalogues, registry, releases, tables
from assayline.sources.registry import AmrColumn, AmrRegistry, ColumnSpec, Registry
from assayline.streaming import ingest
from assayline.streaming import releases as stream_releases

REGISTRY = Registry((
    ColumnSpec("sampid", "s", "text", identifier=True, core_sample=True),
    ColumnSpec("sampcountry", "s", "catalogue", "country", identifier=True, core_sample=True),
    ColumnSpec("analysisy", "s", "number", identifier=True, core_sample=True),
    ColumnSpec("analysisd", "s", "number", identifier=True, core_sample=True),
    ColumnSpec("anportsizeunit", "s", "catalogue", "unit", identifier=True, core_sample=True),
    ColumnSpec("sampmatcodebasebuilding", "s", "catalogue", "mtx", identifier=True, core_sample=True),
    ColumnSpec("sampy", "s", "number", core_sample=True),
    ColumnSpec("sampsizeunit", "s", "catalogue", "unit"),
    ColumnSpec("sampmattext", "s", "text"),
    ColumnSpec("paramcodebaseparam", "m", "catalogue", "param", core_measurement=True),
    ColumnSpec("resid", "m", "text", core_measurement=True),
    ColumnSpec("resval", "m", "number", core_measurement=True),
    ColumnSpec("anmethcodebasemeth", "m", "text"),
))

HEADER = "LabSampCode,SampCountry,AnalysisY,AnalysisD,ProdCode,SampY,SampSizeUnit,ProdText_A,ParamCode,ResultCode,ResVal,AnMethCode"
FILES = {
    "PT/VMPR_2017_PT.ZIP.csv": [
        " S1,PT,2017,0,M1,2017,,Text,param=P1,R1,1.5,meth",
        " S1,PT,2017,0,M1,2017,G050A,Text,param=P2,R2,0,N_A",
        "S2,PT,2017,5,X1,2017,kg,,param=P1,R1,x,meth",
    ],
    "NL/OCC_2018_NL.ZIP.csv": [
        "S1,NL,2018,1,M1,2018,kg,a,P1,R1,2.5,",
        "S3,NL,2018,1,NONE,2018,kg,b,GONE,R1,3,",
    ],
    "NL/OCC_2019_NL.ZIP.csv": [
        "S9,NL,2019,1,M1,2019,kg,one,P1,R1,2.5,",
        "S9,NL,2019,1,M1,2019,kg,two,P1,R2,2.5,",
    ],
    "NL/contaminants_all.ZIP.csv": ["S1,NL,2018,1,M1,2018,kg,a,P1,R1,2.5,"],
}


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    root = tmp_path_factory.mktemp("releases")
    for name, lines in FILES.items():
        path = root / name
        path.parent.mkdir(exist_ok=True)
        path.write_text("\n".join([HEADER, *lines]) + "\n", encoding="utf8")
    return str(root)


@pytest.fixture(scope="module")
def staged(spark, folder):
    listed = releases.select_releases(releases.list_releases(spark, folder, "*.csv"))
    raw = releases.read_release(spark, [r.path for r in listed.collect()])
    # The files stand for members of archives, whose names carry no second extension.
    named = raw.withColumns({c: F.regexp_replace(c, r"\.csv$", "") for c in ("release", "file")})
    return releases.stage_release(named)


@pytest.fixture(scope="module")
def samples(spark, staged):
    return loads.build_samples(staged, REGISTRY)


@pytest.fixture(scope="module")
def dictionaries(spark):
    make = lambda *codes: spark.createDataFrame([(i, c) for i, c in enumerate(codes, 1)], "id int, termcode string")
    mtx, matrix = make("m1"), make("x1")
    return {
        "country": make("pt", "nl"), "unit": make("kg", "g050a"), "mtx": mtx, "matrix": matrix,
        "products": catalogues.product_catalogue(mtx, matrix), "param": make("p1", "p2"),
        "files": spark.createDataFrame([(1, "VMPR_2017_PT.ZIP"), (2, "occ_2018_nl.zip")], "id int, filename string"),
    }


@pytest.fixture(scope="module")
def core(spark, samples, dictionaries):
    nothing = spark.createDataFrame([], "samplehash string")
    return loads.load_sample_core(samples.rows, REGISTRY, dictionaries, nothing, ["sampcountry_id", "product_id", "file_id"])


def test_listing_knows_country_and_skips_archives(spark, folder):
    listed = releases.select_releases(releases.list_releases(spark, folder, "*.csv"))
    assert rows(listed, "country_folder", "release") == [
        ("NL", "OCC_2018_NL.ZIP.csv"), ("NL", "OCC_2019_NL.ZIP.csv"), ("PT", "VMPR_2017_PT.ZIP.csv")]


def test_pending_releases(spark):
    files = spark.createDataFrame([("a",), ("b",)], "release string")
    done = spark.createDataFrame([("a",)], "release string")
    assert rows(releases.pending_releases(files, done)) == [("b",)]
    assert releases.pending_releases(files, done, overwrite=True).count() == 2


def test_layouts_with_other_columns(spark, tmp_path):
    (tmp_path / "a.csv").write_text("x,y\n1,2\n")
    (tmp_path / "b.csv").write_text("y,z\n3,4\n")
    both = releases.read_releases(spark, [str(tmp_path / n) for n in ("a.csv", "b.csv")])
    assert rows(both, "file", "x", "y", "z") == [("a.csv", "1", "2", None), ("b.csv", None, "3", "4")]


def test_csv_cells_as_the_csv_module_writes_them(spark, tmp_path):
    cells = [['a, "b"', "line\nbreak"], ["back\\", "x"], ['""', " blank "], ["", "é;\t'"], ["a\n\nb", "z"]]
    for name, header in (("one.csv", ["x", "y"]), ("two.csv", ["y", "x"])):
        with open(tmp_path / name, "w", newline="", encoding="utf8") as file:
            out = csv.writer(file)
            out.writerow(header)
            out.writerows(cells if header == ["x", "y"] else [c[::-1] for c in cells])
    staged = releases.stage_release(releases.read_releases(spark, [str(tmp_path / n) for n in ("one.csv", "two.csv")]))
    got = numbering.number_file_rows(staged)
    want = sorted((n, i + 1, x or "", y) for n in ("one.csv", "two.csv") for i, (x, y) in enumerate(cells))
    assert sorted((r.file, r.measurement_nr, r.x or "", r.y) for r in got.collect()) == want
    with pytest.raises(Exception, match="CSV header|HEADER"):
        releases.read_release(spark, [str(tmp_path / n) for n in ("one.csv", "two.csv")]).collect()


def test_one_identity_for_blank_missing_and_numbers(spark):
    row = lambda code, day, text: (code, day, text, "occ_1.zip")
    raw = spark.createDataFrame(
        [row("", "1", "a"), row(None, "1.0", "b"), row("s2", "1.00000000001", "c"), row("s2", "1.00000000002", "d")],
        "LabSampCode string, AnalysisD string, ProdText_A string, file string")
    assert rows(loads.build_samples(raw, REGISTRY).rejected) == [("occ_1.zip",)]
    apart = raw.filter("LabSampCode = 's2'")
    built = loads.build_samples(apart, REGISTRY)
    assert built.rows.count() == 2 and built.rejected.count() == 0
    full = loads.cleaning.add_missing(built.rows, REGISTRY.identifiers)
    stored = full.select(loads.sample_hash(full, REGISTRY).alias("samplehash"))
    assert stored.distinct().count() == 2
    # Every row finds one sample or none, also where the stored table repeats a key.
    numbered = apart.withColumns({"file_id": F.col("file"), "filetype": F.lit("vmpr"), "measurement_nr": F.lit(1)})
    parts = loads.split_measurements(numbered, REGISTRY, stored.union(stored).withColumn("id", F.col("samplehash")))
    assert (parts.core.count(), parts.unmatched.count()) == (2, 0)


def test_rows_are_numbered_in_file_order_across_splits(spark, tmp_path):
    for name, n in (("big.csv", 5000), ("small.csv", 3)):
        (tmp_path / name).write_text("v\n" + "".join(f"{i}\n" for i in range(1, n + 1)))
    keep = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "3000")
        spark.conf.set("spark.sql.files.openCostInBytes", "1")
        staged = releases.stage_release(releases.read_release(spark, str(tmp_path), multiline=False))
    finally:
        for k, v in keep.items():
            spark.conf.set(k, v)
    assert staged.select("block").distinct().count() > 5
    numbered = numbering.number_file_rows(staged)
    assert numbered.count() == 5003
    assert numbered.filter(F.col("v").cast("long") != F.col("measurement_nr")).count() == 0


def test_samples(samples):
    assert rows(samples.rows, "file", "sampid", "sampsizeunit", "sampmattext", "analysisd") == [
        ("occ_2018_nl.zip", "s1", "kg", "a", 1.0), ("occ_2018_nl.zip", "s3", "kg", "b", 1.0),
        ("vmpr_2017_pt.zip", "s1", "g050a", "text", None), ("vmpr_2017_pt.zip", "s2", "kg", None, 5.0)]
    assert rows(samples.rejected) == [("occ_2019_nl.zip",)]


def test_equal_rows_of_two_files_both_stay(spark):
    raw = spark.createDataFrame([("s", "f"), ("s", "f"), ("s", "g")], "LabSampCode string, file string")
    assert rows(loads.build_samples(raw, REGISTRY).rows) == [("s", "f"), ("s", "g")]


def test_core_refuses_only_the_row_without_product(core):
    assert rows(core.rows, "sampid", "sampcountry_id", "product_id", "file_id", "analysisy") == [
        ("s1", 1, 1, 1, 2017), ("s1", 2, 1, 2, 2018), ("s2", 1, 2, 1, 2017)]
    assert rows(core.rejected, "sampid", "missing") == [("s3", "product_id")]


def test_second_load_adds_nothing(samples, dictionaries, core):
    again = loads.load_sample_core(samples.rows, REGISTRY, dictionaries, core.rows, ["sampcountry_id", "product_id", "file_id"])
    assert again.rows.count() == 0


def test_attributes(spark, samples, core):
    stored = core.rows.select("samplehash", F.col("samplehash").alias("id"))
    none = spark.createDataFrame([], "sample_core_id string")
    attributes = REGISTRY.frame(spark)
    new = loads.load_sample_rest(samples.rows, REGISTRY, stored, none)
    assert rows(new.join(attributes, new.column_metainfo_id == attributes.id), "columnname", "value") == [
        ("sampmattext", "a"), ("sampmattext", "text"), ("sampsizeunit", "g050a"), ("sampsizeunit", "kg"), ("sampsizeunit", "kg")]
    assert loads.load_sample_rest(samples.rows, REGISTRY, stored, new).count() == 0


@pytest.fixture(scope="module")
def measurements(spark, staged, core):
    numbered = numbering.number_file_rows(staged).withColumns({"file_id": F.col("file"), "filetype": F.lit("vmpr")})
    return loads.split_measurements(numbered, REGISTRY, core.rows.select("samplehash", F.col("samplehash").alias("id")))


def test_measurements_find_their_sample(measurements):
    assert rows(measurements.core, "file_id", "measurement_nr", "resid", "resval") == [
        ("occ_2018_nl.zip", 1, "r1", 2.5), ("vmpr_2017_pt.zip", 1, "r1", 1.5), ("vmpr_2017_pt.zip", 2, "r2", 0.0), ("vmpr_2017_pt.zip", 3, "r1", None)]
    assert rows(measurements.unmatched, "file", "measurement_nr") == [
        ("occ_2018_nl.zip", 2), ("occ_2019_nl.zip", 1), ("occ_2019_nl.zip", 2)]
    assert rows(measurements.rest, "file_id", "measurement_nr", "columnname", "value") == [
        ("vmpr_2017_pt.zip", 1, "anmethcodebasemeth", "meth"), ("vmpr_2017_pt.zip", 3, "anmethcodebasemeth", "meth")]


def test_measurement_load_twice(spark, measurements, dictionaries):
    empty = spark.createDataFrame([], "sample_core_id string, param_id int, resid string")
    loaded = loads.load_measurements(measurements.core, dictionaries, empty)
    assert loaded.rows.count() == 4 and loaded.rejected.count() == 0
    assert loads.load_measurements(measurements.core, dictionaries, loaded.rows).rows.count() == 0


def test_reports_are_empty_after_a_clean_load(samples, core, measurements):
    rest = loads.stage_sample_rest(samples.rows, REGISTRY)
    reports = loads.check_invariants(core.rows, rest.join(core.rows.select("samplehash"), "samplehash", "left_semi"), measurements.core)
    assert {name: df.count() for name, df in reports.items()} == {name: 0 for name in reports}
    # The refused sample still has a staged attribute, which the orphan report finds.
    assert rows(quality.orphans_by_file(rest, core.rows, "samplehash")) == [("occ_2018_nl.zip", 2)]


def test_roundtrip(spark, measurements):
    ids = ["file_id", "measurement_nr"]
    stored = measurements.core.select(*ids, "sample_core_id", "resid", "resval")
    empty = spark.createDataFrame([], "sample_core_id string, columnname string, value string")
    rebuilt = compare.reconstruct_wide(stored, empty, measurements.rest, ["sampmattext"], ["anmethcodebasemeth"])
    assert loads.roundtrip_differences(rebuilt, rebuilt, ids, ["resval", "anmethcodebasemeth"]).count() == 0
    changed = rebuilt.withColumn("resval", F.col("resval").cast("string")).withColumn("anmethcodebasemeth", F.upper("anmethcodebasemeth"))
    assert rows(loads.roundtrip_differences(rebuilt, changed, ids, ["resval", "anmethcodebasemeth"]), "variable", "value_x", "value_y") == [
        ("anmethcodebasemeth", "meth", "METH"), ("anmethcodebasemeth", "meth", "METH")]


def test_views(core, dictionaries):
    named = {k: v.withColumn("termextendedname", F.upper("termcode")) for k, v in dictionaries.items() if "termcode" in v.columns}
    named["products"] = dictionaries["products"]
    view = star.sample_view(core.rows, named)
    assert rows(view, "sampid", "productname") == [("s1", "M1"), ("s1", "M1"), ("s2", "X1")]
    assert rows(star.sample_view(core.rows.select("sampid", "product_id"), named, star.CODE), "productname") == [("m1",), ("m1",), ("x1",)]


def test_sample_view_tells_the_type_of_its_file(spark):
    samples = spark.createDataFrame([(1, 7), (2, 8)], "sample_core_id int, file_id int")
    files = spark.createDataFrame([(7, "f.zip", "PT", "vmpr")], "id int, filename string, country_code string, filetype string")
    assert rows(star.sample_view(samples, {"files": files}), "sample_core_id", "filename", "country_code", "filetype") == [
        (1, "f.zip", "PT", "vmpr"), (2, None, None, None)]


def test_amr(spark):
    layout = AmrRegistry((
        AmrColumn("resultcode", None, "resultcode", None, 2, False), AmrColumn("zoonosis", None, "zoonosis_id", "PARAM", 1, False),
        AmrColumn("cutoffvalue", None, "cutoffvalue", None, 3, False), AmrColumn("sampd", None, "sampd", None, 4, False),
        AmrColumn("old", "new", "new_db", None, 5, False), AmrColumn("junk", None, "junk", None, 6, True)))
    raw = spark.createDataFrame(
        [(" R1", "Known ", "0.25", "0", "v", "j", "f"), ("r2", "odd", "2.5", "7", "N_A", "j", "f"), ("r3", None, "2.5", "7", "N_A", "j", "f")],
        "ResultCode string, Zoonosis string, CutOffValue string, SampD string, Old string, Junk string, filename string")
    known = spark.createDataFrame([(5, "known", "Known thing")], "id int, termcode string, termextendedname string")
    loaded = loads.load_amr(raw, layout, {"param": known})
    assert loaded.rows.columns == ["zoonosis_id", "resultcode", "cutoffvalue", "cutoffvalue_exact", "sampd", "new_db", "filename"]
    assert rows(loaded.rows) == [(5, "r1", 0, 0.25, None, "v", "f"), (None, "r3", 3, 2.5, 7, None, "f")]
    assert rows(loaded.rejected, "resultcode", "unresolved") == [("r2", "zoonosis")]
    assert rows(star.amr_view(loaded.rows, {"param": known}), "resultcode", "zoonosis_code", "zoonosis_name") == [
        ("r1", "known", "Known thing"), ("r3", None, None)]


def test_amr_release_is_tab_separated(spark, tmp_path):
    (tmp_path / "NL_AMR_PUB_2018.csv").write_text("a\tb\n1\t2,3\n")
    assert rows(releases.read_amr_release(spark, str(tmp_path)), "a", "b", "release") == [("1", "2,3", "NL_AMR_PUB_2018.csv")]


def test_catalogues(spark):
    sheet = spark.createDataFrame([(" B1", "Two", "2020-01-02"), ("a1", "One", "soon")], "`Term Code` string, TermExtendedName string, LastUpdate string")
    with pytest.raises(ValueError, match="termcode"):
        catalogues.load_catalogue(sheet)
    loaded = catalogues.load_catalogue(sheet.withColumnRenamed("Term Code", "TermCode"))
    assert [(r.termcode, str(r.lastupdate)) for r in loaded.orderBy("termcode").collect()] == [("a1", "None"), ("b1", "2020-01-02")]
    assert rows(catalogues.with_ids(loaded), "termcode", "id") == [("a1", 1), ("b1", 2)]


def test_repeated_codes_are_refused(spark):
    sheet = spark.createDataFrame([("a", 1), ("b", 2), ("b", 3), (None, 4)], "termcode string, n int")
    kept, refused = catalogues.split_repeated(sheet)
    assert rows(kept) == [("a", 1)] and rows(refused, "n") == [(2,), (3,), (4,)]


def test_staged_tables_end_with_their_run(spark):
    import os

    with session.scratch_run(spark) as folder:
        kept = session.materialise(spark.range(3), "inside").count()
        assert kept == 3 and os.listdir(folder)
        with pytest.raises(RuntimeError), session.scratch_run(spark) as inner:
            session.materialise(spark.range(3), "deeper")
            raise RuntimeError
        assert inner.startswith(folder) and not os.path.exists(inner)
    assert not os.path.exists(folder)


def test_registry_from_a_table(spark, tmp_path):
    path = tmp_path / "registry.csv"
    path.write_text('ColumnName;Sample_Measurement;DataType;Catalogue;Unique_Identifier;Core_Sample;Core_Measurement\n" SampId";s;text;;1;1;0\nresid;m;"text; ""x""";0;;;1.0\n')
    listed = registry.read_registry_csv(str(path), ";")
    made = registry.registry_from(listed)
    assert made.datatypes["resid"] == 'text; "x"'
    many = [{**listed[0], "columnname": f"c{i}"} for i in range(10_500)]
    assert len(registry.registry_from(many).specs) == 10_500
    for wrong in ({**listed[0], "core_sample": "yes"}, {**listed[0], "columnname": " "}):
        with pytest.raises(ValueError):
            registry.registry_from([wrong])
    assert (made.identifiers, made.core_sample_columns, made.core_measurement_columns) == (["sampid"], ["sampid"], ["resid"])
    with pytest.raises(ValueError, match="role"):
        Registry((ColumnSpec("x", "q", "text"),))


def test_partition_pruning_and_quarantine(spark, tmp_path):
    df = spark.createDataFrame([("a", 1), ("b", 2), ("b", 3)], "filetype string, n int")
    tables.write_partitioned(df, str(tmp_path / "t"), "filetype")
    read = spark.read.parquet(str(tmp_path / "t")).filter("filetype = 'b'")
    assert read.count() == 2 and "PartitionFilters: [isnotnull(filetype" in read._jdf.queryExecution().toString()
    for _ in range(2):
        tables.quarantine(df, str(tmp_path / "q"), "some_rule")
    assert spark.read.parquet(str(tmp_path / "q/some_rule")).count() == 6


def test_bucketed_tables_join_without_a_shuffle(spark):
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for name in ("bucketed_samples", "bucketed_measurements"):
            tables.write_bucketed(spark.range(100).withColumnRenamed("id", "sample_id"), name, "sample_id", 4)
        joined = spark.table("bucketed_samples").join(spark.table("bucketed_measurements"), "sample_id")
        assert joined.count() == 100
        assert "Exchange" not in joined._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
        for name in ("bucketed_samples", "bucketed_measurements"):
            spark.sql(f"DROP TABLE IF EXISTS {name}")


def test_streamed_batches_and_a_repeated_batch(spark, tmp_path):
    landing, table, checkpoint = (str(tmp_path / n) for n in ("landing", "table", "checkpoint"))
    schema = spark.range(1).select(F.col("id").alias("samplehash")).schema

    def load(batch, held):
        return inserts.new_samples(batch.select("samplehash").dropDuplicates(), held["samples"])

    def run():
        stream = ingest.read_stream(spark, landing, schema, max_files=1)
        ingest.load_stream(stream, {"samples": (table, schema, load)}, checkpoint).awaitTermination()
        return sorted(r.samplehash for r in ingest.stored(spark, table, schema).collect())

    spark.range(0, 10, 1, 1).withColumnRenamed("id", "samplehash").write.mode("append").parquet(landing)
    assert run() == list(range(10))
    spark.range(5, 15, 1, 1).withColumnRenamed("id", "samplehash").write.mode("append").parquet(landing)
    assert run() == list(range(15))
    assert run() == list(range(15))
    # A batch that is written again, as after a failure, replaces itself.
    held = {"samples": ingest.stored(spark, table, schema, before_batch=1)}
    again = load(spark.range(5, 15).withColumnRenamed("id", "samplehash"), held)
    tables.append_batch(again, table, 1)
    assert sorted(r.samplehash for r in ingest.stored(spark, table, schema).collect()) == list(range(15))


def test_inventories(spark, staged):
    assert rows(releases.release_inventory(staged)) == [
        ("OCC_2018_NL.ZIP", "chemical", 2018, "NL", 12, 2), ("OCC_2019_NL.ZIP", "chemical", 2019, "NL", 12, 2),
        ("VMPR_2017_PT.ZIP", "vmpr", 2017, "PT", 12, 3)]
    amr = spark.createDataFrame([("NL_AMR_PUB_2018.csv", 3)], "release string, nr_cols int")
    assert rows(releases.amr_inventory(amr)) == [("NL_AMR_PUB_2018.csv", "amr", 2018, "NL", 3, 1)]


def test_exports_and_statistics(spark, tmp_path):
    tables.export_results({"one": spark.range(2), "two": spark.range(3)}, str(tmp_path / "out"))
    assert spark.read.parquet(str(tmp_path / "out/two")).count() == 3
    (tmp_path / "stat.csv").write_text("area,year,value\nnl,1999,1\nnl,2000,2\nnl,2024,3\nnl,2025,4\n")
    assert rows(tables.read_statistics(spark, str(tmp_path / "stat.csv")), "year") == [(2000,), (2024,)]


def test_release_stream_equals_batch_load(spark, tmp_path, folder, dictionaries, core, measurements):
    """Files that arrive one after the other give the rows of one batch load."""
    import shutil

    landing, root = tmp_path / "landing", str(tmp_path / "tables")
    landing.mkdir()
    required = ["sampcountry_id", "product_id", "file_id"]
    from pyspark.sql.types import StructType

    schemas = {
        "sample_core": StructType.fromDDL("samplehash string, sampid string, sampcountry_id int, product_id bigint"),
        "sample_rest": StructType.fromDDL("sample_core_id string, column_metainfo_id int, value string"),
        "measurement_core": StructType.fromDDL("sample_core_id string, param_id int, resid string, resval double, filetype string, measurement_nr bigint"),
    }

    def run():
        stream = stream_releases.read_release_stream(spark, str(landing), HEADER.split(","), max_files=1)
        loads_ = stream_releases.release_tables(root, REGISTRY, dictionaries, schemas, required)
        ingest.load_stream(stream, loads_, str(tmp_path / "checkpoint")).awaitTermination()

    for name in FILES:
        short = name.split("/")[1].replace(".ZIP", "")
        shutil.copy(f"{folder}/{name}", landing / short)
        run()
    run()  # nothing new has arrived

    got = {name: ingest.stored(spark, f"{root}/{name}", schema) for name, schema in schemas.items()}
    assert rows(got["sample_core"], "sampid", "sampcountry_id", "product_id") == rows(core.rows, "sampid", "sampcountry_id", "product_id")
    assert rows(got["sample_rest"], "value") == [("a",), ("g050a",), ("kg",), ("kg",), ("text",)]
    assert rows(got["measurement_core"], "resid", "resval", "measurement_nr", "filetype") == [
        ("r1", 1.5, 1, "vmpr"), ("r1", 2.5, 1, "chemical"), ("r1", None, 3, "vmpr"), ("r2", 0.0, 2, "vmpr")]
    # Attributes and everything refused are stored too, as the batch load returns them.
    more = {**stream_releases.REPORTS, "measurement_rest": stream_releases.REST}
    kept = {name: ingest.stored(spark, f"{root}/{name}", schema) for name, schema in more.items()}
    same = ["measurement_nr", "columnname", "value"]
    assert rows(kept["measurement_rest"], *same) == rows(measurements.rest, *same)
    assert rows(kept["unmatched_measurements"], "measurement_nr") == rows(measurements.unmatched, "measurement_nr")
    assert [r[0][:8] for r in rows(kept["refused_files"])] == ["occ_2019"]
    assert rows(kept["refused_samples"], "missing") == [("product_id",)] and kept["unknown_params"].count() == 0


def test_odd_header_names_survive_staging(spark, tmp_path):
    (tmp_path / "odd.csv").write_text('"Prod Code_A","Samp (Y)","x;y=z"\nA,2017,1\n')
    staged = releases.stage_release(releases.read_release(spark, str(tmp_path), multiline=False))
    from assayline.operators import cleaning

    out = cleaning.harmonise(staged, {"prod_code": "sampmatcodebasebuilding"}, keep=loads.PLUMBING)
    assert out.columns[:3] == ["sampmatcodebasebuilding", "samp_y", "xyz"]
    assert rows(out, "sampmatcodebasebuilding", "samp_y") == [("A", "2017")]


def test_a_result_is_stored_once_of_a_batch(spark, dictionaries):
    row = lambda nr, code, resid: ("s", code, resid, 1.0, "f", nr)
    batch = spark.createDataFrame(
        [row(2, "param=p1", "r1"), row(1, "p1", "r1"), row(3, "p1", None), row(4, "p1", None), row(5, "gone", "r1"), row(6, "p2", "r9")],
        "sample_core_id string, paramcodebaseparam string, resid string, resval double, file_id string, measurement_nr long")
    params = dictionaries["param"].union(dictionaries["param"].selectExpr("id + 10", "termcode"))
    stored = spark.createDataFrame([("s", 2, "r9", "f"), ("t", 1, "r1", "f")], "sample_core_id string, param_id int, resid string, file_id string")
    loaded = loads.load_measurements(batch, {"param": params}, stored)
    assert rows(loaded.rows, "measurement_nr", "param_id") == [(1, 1), (3, 1), (4, 1)]
    assert rows(loaded.rejected, "measurement_nr", "verdict") == [(2, "repeated"), (5, "unknown_param")]


def test_unlisted_results_of_a_new_sample_are_all_kept(spark, dictionaries):
    params = dictionaries["param"].union(spark.createDataFrame([(9, inserts.UNLISTED_PARAM)], "id int, termcode string"))
    batch = spark.createDataFrame(
        [("new", inserts.UNLISTED_PARAM, "r1", "f", 1), ("new", inserts.UNLISTED_PARAM, "r2", "f", 2), ("old", inserts.UNLISTED_PARAM, "r1", "f", 3)],
        "sample_core_id string, paramcodebaseparam string, resid string, file_id string, measurement_nr long")
    stored = spark.createDataFrame([("old", 1, "r7")], "sample_core_id string, param_id int, resid string")
    loaded = loads.load_measurements(batch, {"param": params}, stored)
    assert rows(loaded.rows, "measurement_nr") == [(1,), (2,)] and loaded.rejected.count() == 0


def test_stored_measurements_are_read_once_behind_a_filter(spark, tmp_path):
    path = str(tmp_path / "stored")
    old = spark.createDataFrame([(i, 1, "r", f"f{i % 5}", "vmpr" if i % 2 else "chemical") for i in range(1000)], "sample_core_id long, param_id int, resid string, file_id string, filetype string")
    tables.write_partitioned(old, path, "filetype")
    batch = spark.createDataFrame([(7, "f2", "vmpr"), (2, "f2", "vmpr")], "sample_core_id long, file_id string, filetype string")
    with session.settings(spark, spark__sql__maxMetadataStringLength="2000"):
        found = inserts.stored_keys(batch, spark.read.parquet(path), ["sample_core_id", "param_id", "resid"])
        physical = found._jdf.queryExecution().sparkPlan().toString()
    assert physical.count("FileScan parquet") == 1
    assert "PartitionFilters: [isnotnull(filetype" in physical and "vmpr" in physical
    pushed = physical.split("PushedFilters")[1]
    assert all(x in pushed for x in ("GreaterThanOrEqual(sample_core_id,2)", "LessThanOrEqual(sample_core_id,7)", "EqualTo(file_id,f2)"))
    assert rows(found) == [(7, 1, "r")]  # sample 2 is stored under another type


def test_a_repeated_code_does_not_multiply_rows(spark):
    twice = spark.createDataFrame([(1, "a"), (2, "a"), (3, "b")], "id int, termcode string")
    coded = loads.dims.encode(spark.createDataFrame([("a",), ("b",), ("c",)], "code string"), [("code", twice, "x")])
    assert rows(coded) == [("a", 1), ("b", 3), ("c", None)]


def test_catalogue_is_refused_and_loaded_once(spark, tmp_path):
    sheet = spark.createDataFrame([("A", "x"), ("a ", "y"), ("b", "z"), (None, "w")], "TermCode string, TermExtendedName string")
    made = catalogues.ingest_catalogue(sheet)
    assert rows(made.rows, "termcode") == [("b",)] and rows(made.refused, "termextendedname") == [("w",), ("x",), ("y",)]
    calls = []
    make = lambda: calls.append(1) or made.rows
    path = str(tmp_path / "catalogue")
    for overwrite in (False, False, True):
        assert rows(catalogues.catalogue_table(spark, path, make, overwrite), "termcode", "id") == [("b", 1)]
    assert len(calls) == 2


def test_amr_result_codes_are_unique_in_a_file(spark):
    layout = AmrRegistry((AmrColumn("resultcode", None, "resultcode", None, 1, False), AmrColumn("repyear", None, "repyear", None, 2, False)))
    raw = spark.createDataFrame([("r1", "1", "f"), ("R1 ", "2", "f"), ("r1", "3", "g"), (None, "4", "f"), (None, "5", "f")], "ResultCode string, RepYear string, filename string").coalesce(1)
    loaded = loads.load_amr(raw, layout, {})
    assert rows(loaded.rows, "repyear") == [(1,), (3,), (4,), (5,)]
    assert rows(loaded.rejected, "repyear", "refused") == [("2", "repeated")]


def test_losses_are_reported(spark, dictionaries):
    raw = spark.createDataFrame(
        [("s1", "pt", "2017", "m1", "abc", "f.csv"), ("s2", "pt", "99999999999", "m1", "1,5", "f.csv"), ("s3", "pt", "x", "m1", "N_A", "f.csv")],
        "LabSampCode string, SampCountry string, SampY string, ProdCode string, ResVal string, file string")
    cleaned = loads.stage_clean(raw, REGISTRY)
    assert (cleaned.n_rows, cleaned.n_malformed) == (3, 3)
    assert rows(cleaned.malformed) == [("f.csv", "resval", "1,5", 1), ("f.csv", "resval", "abc", 1), ("f.csv", "sampy", "x", 1)]
    files = {**dictionaries, "files": spark.createDataFrame([(1, "f.csv")], "id int, filename string")}
    core = loads.load_sample_core(loads.samples_of(cleaned, REGISTRY).keyed, REGISTRY, files, spark.createDataFrame([], "samplehash string"), ["product_id"])
    assert rows(core.out_of_range, "file", "column", "value") == [("f.csv", "sampy", 99999999999.0)]
    assert rows(core.rows, "sampid", "sampy") == [("s1", 2017), ("s2", None), ("s3", None)]


def test_a_refused_file_shows_the_rows_that_share_a_key(samples):
    assert rows(samples.offending, "file", "sampid", "sampmattext") == [("occ_2019_nl.zip", "s9", "one"), ("occ_2019_nl.zip", "s9", "two")]
    assert rows(samples.malformed, "column", "value") == []


def test_a_repair_reads_only_its_file(spark, staged, monkeypatch):
    from assayline.operators import dedup

    cleaned = loads.stage_clean(staged, REGISTRY)
    assert cleaned.n_repairable == {"vmpr_2017_pt": 3}
    fix = loads._of_file(loads.KNOWN_REPAIRS[0])
    plan = cleaned.rows.where(fix)._jdf.queryExecution().sparkPlan().toString()
    assert "StringStartsWith(file,vmpr_2017_pt.)" in plan
    called = []
    monkeypatch.setattr(dedup, "repair_duplicates", lambda *a, **k: called.append(a))
    others = loads.stage_clean(staged.where("file <> 'vmpr_2017_pt.zip'"), REGISTRY)
    assert others.n_repairable == {"vmpr_2017_pt": 0}
    assert loads.samples_of(others, REGISTRY).rows.count() == 2 and not called


def test_both_sentinel_readings(spark):
    raw = spark.createDataFrame([("s1", "NA", "f")], "LabSampCode string, SampCountry string, file string")
    assert rows(loads.build_samples(raw, REGISTRY).rows, "sampcountry") == [("na",)]
    assert rows(loads.build_samples(raw, REGISTRY, reader_sentinels=True).rows, "sampcountry") == [(None,)]


def test_roundtrip_opens_only_files_that_differ(spark):
    row = lambda f, nr, a, b: (f, nr, a, b)
    schema = "file string, nr long, a string, b string"
    original = spark.createDataFrame([row("f", 1, "1", "x"), row("f", 2, "2", None), row("g", 1, "3", "y"), row("h", 1, "4", "z"), row(None, 1, "5", "n")], schema)
    stored = spark.createDataFrame([row("f", 2, "2.0", "new"), row("f", 1, "1.0", "x"), row("g", 1, "3", "other"), row("h", 2, "4", "z"), row(None, 1, "5", "n")], schema)
    found = loads.compare_roundtrip(original, stored, ["file", "nr"], ["a", "b"])
    assert sorted((r.file, tuple(r.columns)) for r in found.files.collect()) == [("f", ("b",)), ("g", ("b",)), ("h", ("a", "b"))]
    assert rows(found.changed, "file", "nr", "variable", "value_x", "value_y") == [("g", 1, "b", "y", "other")]
    assert rows(found.missing, "file", "nr", "variable", "value", "only_in") == [
        ("f", 2, "b", "new", "warehouse"), ("h", 1, "a", "4.0", "original"), ("h", 1, "b", "z", "original"), ("h", 2, "a", "4.0", "warehouse"), ("h", 2, "b", "z", "warehouse")]
    some = loads.verify_some_files(original, stored, ["file", "nr"], ["a", "b"], n=1, seed=3)
    assert some.files.count() <= 1


def test_digests_count_copies_and_ignore_order(spark):
    schema = "file string, nr long, a string"
    digests = lambda data: rows(compare.column_digests(spark.createDataFrame(data, schema), "file", ["file", "nr"], ["a"]))
    assert digests([("f", 1, "x"), ("f", 2, "y")]) == digests([("f", 2, "y"), ("f", 1, "x")])
    assert digests([("f", 1, "x"), ("f", 1, "x")]) != digests([("f", 1, "z"), ("f", 1, "z")])
    assert digests([("f", 1, "x"), ("f", 2, "y")]) != digests([("f", 1, "y"), ("f", 2, "x")])


def test_rebuilding_reports_what_is_stored_twice(spark):
    core = spark.createDataFrame([("s", "f", 1), ("s", "f", 2)], "sample_core_id string, file_id string, measurement_nr long")
    attribute = "columnname string, value string"
    sample_rest = spark.createDataFrame([("s", "p", "b"), ("s", "p", "a")], f"sample_core_id string, {attribute}")
    rest = spark.createDataFrame([("f", 1, "q", "x"), ("f", 2, "q", "y"), ("f", 2, "q", "y")], f"file_id string, measurement_nr long, {attribute}")
    made = compare.rebuild(core, sample_rest, rest, ["p"], ["q"])
    assert rows(made.rows, "measurement_nr", "p", "q") == [(1, "a", "x"), (2, "a", "y")]
    assert rows(made.conflicts) == [("f|2", "q", 2), ("s", "p", 2)]


def test_later_copies_match_nulls(spark):
    from assayline.operators import dedup

    df = spark.createDataFrame([(None, "a", 2), (None, "a", 1), ("x", None, 1), ("x", None, 3), ("x", "b", 1), (None, None, 1)], "k string, l string, n int")
    assert rows(dedup.later_copies(df, ["k", "l"], ["n"])) == [("x", None, 3), (None, "a", 2)]


def test_a_stream_of_two_layouts_leaves_no_scratch(spark, tmp_path, dictionaries):
    import os

    from pyspark.sql.types import StructType

    landing, root = tmp_path / "landing", str(tmp_path / "tables")
    landing.mkdir()
    head = ["LabSampCode", "SampCountry", "SampY", "ProdCode", "ProdText", "ParamCode", "ResultCode", "ResVal"]
    one = [["S1", "PT", "2017", "M1", 'two\nlines, "x"', "P1", "R1", "1.5"], ["S1", "PT", "2017", "M1", 'two\nlines, "x"', "P2", "R2", "bad"]]
    two = [["S2", "NL", "2018", "M1", "plain", "P1", "R1", "2"]]

    def put(name, header, data):
        with open(landing / name, "w", newline="", encoding="utf8") as file:
            out = csv.writer(file)
            out.writerow(header)
            out.writerows(data)

    put("VMPR_2017_PT.csv", head, one)
    put("pesticides_all.csv", head, one)
    schemas = {
        "sample_core": StructType.fromDDL("samplehash string, sampid string, sampcountry_id int, file string"),
        "sample_rest": StructType.fromDDL("sample_core_id string, column_metainfo_id int, value string"),
        "measurement_core": StructType.fromDDL("sample_core_id string, param_id int, resid string, resval double, file_id string, filetype string, measurement_nr bigint"),
    }
    scratch = f"{session.shared_folder(spark)}/{spark.sparkContext.applicationId}"
    held = set(os.listdir(scratch)) if os.path.isdir(scratch) else set()

    def run():
        found = stream_releases.release_tables(root, REGISTRY, dictionaries, schemas, ["sampcountry_id"])
        stream = stream_releases.read_release_paths(spark, str(landing), "*.csv", max_files=1)
        ingest.load_stream(stream, found, str(tmp_path / "checkpoint"), stream_releases.read_arrived()).awaitTermination()

    run()
    put("OCC_2018_NL.csv", head[::-1], [r[::-1] for r in two])
    run()
    assert set(os.listdir(scratch)) - held <= {n for n in os.listdir(scratch) if not n.startswith("run-")} and not any(n.startswith("run-") and os.listdir(f"{scratch}/{n}") for n in set(os.listdir(scratch)) - held)
    got = {name: ingest.stored(spark, f"{root}/{name}", schema) for name, schema in schemas.items()}
    assert rows(got["sample_core"], "sampid", "sampcountry_id", "file") == [("s1", 1, "vmpr_2017_pt.csv"), ("s2", 2, "occ_2018_nl.csv")]
    assert rows(got["measurement_core"], "resid", "resval", "filetype", "measurement_nr") == [("r1", 1.5, "vmpr", 1), ("r1", 2.0, "chemical", 1), ("r2", None, "vmpr", 2)]
    assert rows(ingest.stored(spark, f"{root}/malformed_cells", stream_releases.REPORTS["malformed_cells"])) == [("vmpr_2017_pt.csv", "resval", "bad", 1)]
    texts = {r.value for r in got["sample_rest"].collect()}
    assert 'two\nlines, "x"' in texts


def test_a_local_session_without_a_shared_folder_gets_its_own(spark, monkeypatch):
    class Conf:
        def get(self, name, default=None):
            return default

    class Session:
        conf, sparkContext = Conf(), spark.sparkContext

    first = session.shared_folder(Session())
    assert first == session.shared_folder(Session()) and first != session.shared_folder(spark)


def test_what_the_loads_stage_is_compact_and_only_written_when_asked_for(spark, monkeypatch):
    written, keep = [], loads.materialise
    monkeypatch.setattr(loads, "materialise", lambda df, name, *codec: written.append((name, *codec)) or keep(df, name, *codec))
    raw = spark.createDataFrame([("S1", "P1", "1", "a.csv", "a.csv", "vmpr", 1), ("S2", "P1", "x", "a.csv", "a.csv", "vmpr", 2)],
                                "sampid string, paramcodebaseparam string, resval string, file string, file_id string, filetype string, measurement_nr long")
    cleaned = loads.stage_clean(raw, REGISTRY)
    assert rows(cleaned.malformed, "column", "value", "n") == [("resval", "x", 1)]
    one = cleaned.rows.where("sampid = 's1'").select("samplehash", F.lit("id1").alias("id"))
    parts = loads.measurements_of(cleaned, REGISTRY, one)
    assert rows(parts.unmatched, "sampid", "measurement_nr") == [("s2", 2)]
    assert rows(parts.unmatched, "samplehash") == rows(cleaned.rows.where("sampid = 's2'"), "samplehash")
    assert written == [("clean", "zstd")]
    assert rows(parts.core, "sample_core_id", "measurement_nr") == [("id1", 1)]
    assert parts.rest.columns == ["sample_core_id", "file_id", "measurement_nr", "columnname", "value"]
    assert written == [("clean", "zstd"), ("measurements", "zstd")]


def _shuffle_files(spark) -> dict[str, int]:
    """Files of shuffles on the disk of this machine, with their bytes."""
    import os

    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().mkString("\n").split("\n")
    return {f: os.path.getsize(f) for f in files if "/shuffle_" in f and os.path.exists(f)}


def test_a_batch_keeps_neither_lines_nor_shuffles(spark, tmp_path):
    import os
    import time

    from pyspark.sql.types import StructType

    (tmp_path / "VMPR_2017_PT.csv").write_text("a,b\n" + "".join(f"{i},{i % 7}\n" for i in range(500)))
    schema, staged, held = StructType.fromDDL("b string, n long"), [], set(_shuffle_files(spark))

    def load(batch, stored):
        run = batch.inputFiles()[0].split("/run-")[1].split("/")[0]
        top = f"{session.shared_folder(spark)}/{spark.sparkContext.applicationId}/run-{run}".removeprefix("file:")
        staged.extend(f for _, folders, _ in os.walk(top) for f in folders)
        return batch.repartition(3, "a").groupBy("b").agg(F.count(F.lit(1)).alias("n"))

    stream = stream_releases.read_release_paths(spark, str(tmp_path), "*.csv")
    ingest.load_stream(stream, {"t": (f"{tmp_path}/t", schema, load)}, f"{tmp_path}/checkpoint", stream_releases.read_arrived()).awaitTermination()
    assert sum(r[1] for r in rows(spark.read.parquet(f"{tmp_path}/t"), "b", "n")) == 500
    assert any(f.startswith("batch-") for f in staged) and not any(f.startswith("lines-") for f in staged)
    until = time.time() + 20  # they are removed beside what runs next
    while (left := set(_shuffle_files(spark)) - held) and time.time() < until:
        time.sleep(0.2)
    assert not left


def test_judging_new_files_does_not_shuffle_their_rows(spark, tmp_path):
    n = 20_000
    wide = F.concat_ws("", *[F.sha2(F.concat(F.col("id"), F.lit(f"-{i}")), 256) for i in range(4)])
    batch = spark.range(n).select(
        F.md5(F.col("id").cast("string")).alias("sample_core_id"), F.lit("f").alias("file_id"), F.lit("vmpr").alias("filetype"), F.col("id").alias("measurement_nr"),
        F.concat(F.lit("p"), F.col("id") % 5).alias("paramcodebaseparam"), F.when(F.col("id") > 0, F.lit("r1")).alias("resid"), wide.alias("evaltext"))
    again = batch.where("measurement_nr in (7, 8)").withColumn("measurement_nr", F.col("measurement_nr") + n)
    empty = batch.where("measurement_nr < 2").withColumn("measurement_nr", F.col("measurement_nr") + n)
    params = session.materialise(spark.createDataFrame([(f"p{i}", i) for i in range(4)], "termcode string, id int"), "params")
    (tmp_path / "none").mkdir()
    target = spark.read.schema("sample_core_id string, param_id int, resid string, file_id string").parquet(str(tmp_path / "none"))
    batch = session.materialise(batch.unionByName(again).unionByName(empty), "batch")
    before = _shuffle_files(spark)
    with session.settings(spark, spark__sql__autoBroadcastJoinThreshold="200000", spark__sql__adaptive__autoBroadcastJoinThreshold="200000"):
        judged = inserts.judge_measurements(batch, params, target)
    moved = sum(size for f, size in _shuffle_files(spark).items() if f not in before)
    assert rows(judged.where("verdict = 'repeated'"), "measurement_nr") == [(n + 1,), (n + 7,), (n + 8,)]
    assert judged.where("verdict = 'unknown_param'").count() == n // 5 and judged.where("verdict is null").count() == n + 4 - 3 - n // 5
    assert moved < 60 * n


def test_a_file_that_comes_again_adds_only_what_is_not_stored(spark, tmp_path, dictionaries):
    from pyspark.sql.types import StructType

    head = "LabSampCode,SampCountry,SampY,ProdCode,ProdText,ParamCode,ResultCode,ResVal,AnMethCode"
    old = ["S1,PT,2017,M1,one,P1,R1,1.5,m1", "S4,PT,2017,M1,,P1,R1,1.5,m1"]
    new = ["S1,PT,2017,M1,one,P1,R1,1.5,m1", "S4,PT,2017,M1,,P1,R1,1.5,m1", "S3,PT,2017,M1,three,P1,R2,4,m2"]
    schemas = {
        "sample_core": StructType.fromDDL("samplehash string, sampid string, file string"),
        "sample_rest": StructType.fromDDL("sample_core_id string, column_metainfo_id int, value string"),
        "measurement_core": StructType.fromDDL("sample_core_id string, param_id int, resid string, file_id string, filetype string, measurement_nr bigint"),
    }
    for place, lines in (("a", old), ("b", new)):
        (tmp_path / "landing" / place).mkdir(parents=True)
        (tmp_path / "landing" / place / "VMPR_2017_PT.csv").write_text("\n".join([head, *lines]) + "\n")
        found = stream_releases.release_tables(f"{tmp_path}/tables", REGISTRY, dictionaries, schemas, ["sampcountry_id"])
        stream = stream_releases.read_release_paths(spark, f"{tmp_path}/landing", "*.csv", max_files=1)
        ingest.load_stream(stream, found, f"{tmp_path}/checkpoint", stream_releases.read_arrived()).awaitTermination()
    got = {name: ingest.stored(spark, f"{tmp_path}/tables/{name}", s) for name, s in {**schemas, "measurement_rest": stream_releases.REST}.items()}
    assert rows(got["sample_core"], "sampid") == [("s1",), ("s3",), ("s4",)]
    assert rows(got["sample_rest"], "value") == [("one",), ("three",)]
    assert rows(got["measurement_core"], "resid", "measurement_nr") == [("r1", 1), ("r1", 2), ("r2", 3)]
    assert rows(got["measurement_rest"], "measurement_nr", "value") == [(1, "m1"), (2, "m1"), (3, "m2")]


def test_releases_of_large_tables_arrive_in_groups_that_do_not_stay(spark, tmp_path, monkeypatch):
    import glob

    from assayline.registered import layout

    def put(name, data, schema):
        spark.createDataFrame(data, schema).write.parquet(f"{tmp_path}/{name}.parquet")

    put("nation", [(0, "ALPHA", 0), (1, "BETA", 0)], "n_nationkey int, n_name string, n_regionkey int")
    put("customer", [(1, "c", 0, 0.0, "BUILDING"), (2, "d", 1, 0.0, "MACHINERY")], "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string")
    put("part", [(i, "n", "Brand#11", "t", 1, 1.0) for i in range(3)], "p_partkey long, p_name string, p_brand string, p_type string, p_size int, p_retailprice double")
    orders = spark.range(12).selectExpr("id o_orderkey", "id % 2 + 1 o_custkey", "'O' o_orderstatus", "1.0D o_totalprice", "timestamp '1996-01-02' o_orderdate", "'5-LOW' o_orderpriority")
    orders.write.parquet(f"{tmp_path}/orders.parquet")
    lines = spark.range(36).selectExpr(
        "id % 12 l_orderkey", "id % 4 l_partkey", "0L l_suppkey", "cast(1 + id % 2 as int) l_linenumber", "20.0D l_quantity", "cast(id as double) l_extendedprice", "0.05D l_discount",
        "0.0D l_tax", "'A' l_returnflag", "'O' l_linestatus", "timestamp '1996-01-02' l_shipdate")
    lines.write.parquet(f"{tmp_path}/lineitem.parquet")

    roots, landed, keep = [], [], layout.ingest.load_stream
    monkeypatch.setattr(layout, "scratch", lambda spark, name: roots.append(session.scratch(spark, name)) or roots[-1])
    monkeypatch.setattr(layout.ingest, "load_stream", lambda *a: landed.append(glob.glob(f"{roots[0]}/landing/**/*.csv", recursive=True)) or keep(*a))
    monkeypatch.setattr(layout, "ARRIVAL_ROWS", 13, raising=False)
    got = rows(layout.stream_releases(spark, str(tmp_path)), "sampid", "sampcountry", "repyear", "measurements")
    assert got == sorted((f"s-{i}", ("alpha", "beta")[i % 2], 1996, 3) for i in range(12))
    # Three groups, each of two layouts of at most two files; those before are gone.
    assert [0 < len(files) <= 4 for files in landed] == [True] * 3 and len({f for files in landed for f in files}) == sum(map(len, landed))
    assert not glob.glob(f"{roots[0]}/landing/**/*.csv", recursive=True)
