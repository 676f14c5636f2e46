import random
import re

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tests.library import STANDARD, identity_xml, method_xml
from tracehouse.operators import filters, quality
from tracehouse.plans import reconcile
from tracehouse.sources import plain_xml, tables, xml


@pytest.fixture(scope="module")
def metadata(spark):
    rows = [("1", "red", "o'neil", 0), ("2", "white", "x", 1), ("3", "red", "y", 2)]
    return spark.createDataFrame(rows, "id string, color string, wine string, n int")


@pytest.fixture(scope="module")
def signal(spark):
    rows = [(i, float(t), w, float(w + t)) for i in ("1", "2") for t in range(3) for w in (254, 256)]
    return spark.createDataFrame(rows, "id string, mins double, wavelength int, absorbance double")


def test_default_filter_and_left_join(metadata, signal):
    found = filters.query(metadata, signal)
    assert found.count() == 3 and {r["wavelength"] for r in found.collect()} == {256}
    # no condition on the signal: a run without one stays
    red = filters.query(metadata, signal, {"color": {"value": "red", "operator": "="}})
    assert red.where("id = '3'").count() == 1 and red.count() == 7


def test_typed_literals(metadata):
    def ids(entry):
        return sorted(r["id"] for r in filters.query(metadata, None, entry).collect())

    assert ids({"wine": {"value": "o'neil", "operator": "="}}) == ["1"]
    assert ids({"n": {"value": 0, "operator": "="}}) == ["1"]
    assert ids({"color": {"value": ["red", "rose"], "operator": "IN"}}) == ["1", "3"]
    assert ids({"n": {"value": (1, 2), "operator": "BETWEEN"}}) == ["2", "3"]
    assert ids({}) == ["1", "2", "3"]


def test_filter_is_not_changed(metadata):
    entry = {"color": {"value": ["red"], "operator": "IN"}}
    filters.query(metadata, None, entry)
    assert entry == {"color": {"value": ["red"], "operator": "IN"}}


@pytest.mark.parametrize(
    "entry,error",
    [
        ([], TypeError), ({1: {"value": 1, "operator": "="}}, TypeError), ({"a": 1}, TypeError), ({"a": {}}, ValueError),
        ({"a": {"operator": "=", "value": 1}}, ValueError), ({"a": {"value": {}, "operator": "="}}, TypeError),
        ({"a": {"value": 1, "operator": 1}}, TypeError), ({"a": {"value": 1, "operator": ""}}, ValueError),
        ({"a": {"value": 1, "operator": ">"}}, ValueError), ({"a": {"value": "", "operator": "="}}, ValueError),
        ({"a": {"value": (1,), "operator": "BETWEEN"}}, ValueError), ({"a": {"value": 1, "operator": "IN"}}, ValueError),
        ({"mins": {"value": (0, 1), "operator": "BETWEEN"}}, ValueError),
    ],
)
def test_bad_filters(entry, error):
    with pytest.raises(error):
        filters.validate_filter(entry, with_signal=False)


def test_inferred_operators():
    got = filters.infer_operators({"mins": (0, 5), "color": ["red"], "wine": "x"})
    assert {k: v["operator"] for k, v in got.items()} == {"mins": "BETWEEN", "color": "IN", "wine": "="}
    with pytest.raises(TypeError):
        filters.infer_operators({"color": {"red"}})


def test_tables_by_name(spark, metadata, signal):
    metadata.createOrReplaceTempView("sample_metadata")
    with pytest.raises(ValueError, match="not found"):
        filters.query_tables(spark, signal_table="nothing")
    signal.createOrReplaceTempView("chromatogram_spectra_long")
    filters.query_tables(spark, view="found")
    assert spark.table("found").count() == 3


def test_null_keys_are_exempt_from_unique_only(spark):
    df = spark.createDataFrame([(None, 1), (None, 1), ("a", 1)], "k string, v int")
    assert quality.duplicate_keys(df, ["k"]).count() == 0
    assert quality.duplicate_keys(df, ["k"], nulls_are_equal=True).count() == 1
    kinds = {r["check"]: r["n"] for r in quality.violations(df, primary_key=["k"], unique=[["v"]]).collect()}
    assert kinds == {"primary key": 2, "unique": 3, "not null": 2}


def test_row_checks(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3)], "k string, v int")
    quality.require_count(df, 3, "rows")
    with pytest.raises(quality.QualityError, match="expected 10"):
        quality.require_count(df, 10, "sequences")
    with pytest.raises(quality.QualityError, match="between 1 and 2"):
        quality.require_equal_lengths(df, "k")
    with pytest.raises(quality.QualityError, match="one value"):
        quality.require_single_value(df, "k")
    with pytest.raises(quality.QualityError, match="missing columns"):
        quality.require_columns(df, ["k", "z"], "table")
    assert quality.new_rows(df, spark.createDataFrame([("a",), ("c",), ("c",)], "k string"), ["k"]).collect()[0]["k"] == "c"


def test_differing_files_are_found(spark, tmp_path):
    df = spark.createDataFrame([(1, "x")], "a int, b string")
    df.write.parquet(str(tmp_path / "one"))
    df.write.parquet(str(tmp_path / "two"))
    tables.require_same_schema(spark, str(tmp_path / "*" / "*.parquet"))
    df.select("a").write.parquet(str(tmp_path / "three"))
    with pytest.raises(quality.QualityError, match="differ in schema"):
        tables.require_same_schema(spark, str(tmp_path / "*" / "*.parquet"))


def test_register_csv_stays_text(spark, tmp_path):
    path = tmp_path / "register.csv"
    header = "detection,sampler,samplecode,vintage,name,open_date,sampled_date,added_to_cellartracker,notes,size\n"
    path.write_text(header + 'raw,JV,00,2018,"Old, Vine",1/2/2023,,y,"it""s",\ncuprac,JV,02,null,Four,,,,,0.75\n')
    rows = tables.read_register_csv(spark, str(path)).collect()
    assert (rows[0]["samplecode"], rows[0]["name"], rows[0]["notes"], rows[0]["size"]) == ("00", "Old, Vine", 'it"s', None)
    staged = {r["samplecode"]: r for r in reconcile.stage_register(tables.read_register_csv(spark, str(path))).collect()}
    assert staged["00"]["wine_key"] == "2018 old, vine" and staged["02"]["vintage"] == 9999
    assert [staged["00"]["pk"], staged["02"]["pk"]] == [1, 2]


def _catalogue_csv(tmp_path, *rows):
    path = tmp_path / "catalogue.csv"
    names = ",".join(tables.schemas.CATALOGUE_SOURCE)
    path.write_text("\n".join([names, *rows]) + "\n")
    return str(path)


def test_catalogue_csv_keeps_quotes_and_line_breaks_in_their_field(spark, tmp_path):
    names = list(tables.schemas.CATALOGUE_SOURCE)
    fields = [f"f{i}" for i in range(len(names))]
    fields[3] = '"Chateau ""One"", red"'
    fields[5] = '"two\nlines"'
    row = tables.read_catalogue(spark, _catalogue_csv(tmp_path, ",".join(fields)), "csv").first()
    assert row[names[3]] == 'Chateau "One", red' and row[names[5]] == "two\nlines" and row[names[-1]] == fields[-1]


def test_short_catalogue_rows_are_errors(spark, tmp_path):
    with pytest.raises(Exception, match="(?i)malformed"):
        tables.read_catalogue(spark, _catalogue_csv(tmp_path, "only,three,fields"), "csv").collect()


def test_reconciliation(spark, tmp_path):
    rows = [("raw", "1", "2018", "Chateau Ome", "y"), ("raw", "2", "2019", "two sons", "y"), ("raw", "3", "2020", "zzzz qqqq", "n")]
    raw = spark.createDataFrame(
        [(d, "JV", c, v, n, "", "", a, "", None) for d, c, v, n, a in rows], tables.schemas.REGISTER_SOURCE
    )
    catalogue = spark.createDataFrame(
        [("2018 chateau one", "chateau one", 2018), ("2019 two & sons", "two & sons", 2019)], "wine_key string, wine string, vintage int"
    )
    corrected, matches = reconcile.reconcile(raw, catalogue)
    # names were scored once, when the matches were written: reading the results scores nothing
    for df in (corrected, matches):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "CoGroup" not in plan and "Python" not in plan and "Arrow" not in plan
    scores = {r["pk"]: (r["match"], r["verified"]) for r in matches.collect()}
    assert scores[1] == ("2018 chateau one", True) and scores[2] == ("2019 two & sons", True) and not scores[3][1]
    fixed = {r["samplecode"]: r for r in corrected.collect()}
    assert fixed["1"]["wine"] == "chateau one" and fixed["3"]["wine"] == "zzzz qqqq"
    assert [r["pk"] for r in reconcile.unmatched_names(matches).collect()] == [3]
    assert reconcile.vintages_agree(corrected).first()[0] is True
    report = {r["metric"]: r["value"] for r in reconcile.match_report(corrected, matches).collect()}
    assert report == {"register": 3.0, "verified": 2.0, "not verified": 1.0}
    path = str(tmp_path / "register")
    reconcile.export_register(reconcile.correct(corrected, F.col("pk") == 3, "added_to_cellartracker", False), path)
    assert spark.read.parquet(path).columns == reconcile.EXPORT_COLUMNS


def _pump(spark, document: bytes):
    df = spark.createDataFrame([("r1", document.decode("utf-8-sig"))], "id string, xml string")
    return xml.pump_tables(xml.parse_methods(df))


def test_pump_tables(spark):
    composition, timetable = _pump(spark, method_xml(STANDARD))
    rows = composition.orderBy("idx").collect()
    assert [(r["idx"], r["channel"], r["ch1_solv"], r["name_1"], r["percent"]) for r in rows] == [
        (0, "A", "solvent A", None, 95.0), (1, "B", "solvent B", None, 5.0),
    ]
    steps = timetable.orderBy("idx").collect()
    assert [(r["mins"], r["b"]) for r in steps] == [(float(t), float(b)) for t, _, b in STANDARD]


def test_single_row_table(spark):
    _, timetable = _pump(spark, method_xml(STANDARD[:1]))
    assert timetable.count() == 1


@pytest.mark.parametrize(
    "document,message",
    [
        (method_xml(STANDARD, section="Quaternary Pump"), "no section Binary Pump in r1"),
        (method_xml(()), "timetable: no rows in r1"),
        (method_xml(STANDARD)[:-40], "broken method document in r1"),
        (method_xml(STANDARD).replace(b"<Name>Flow</Name>", b"<Name>Other</Name>"), "no column 'flow' in r1"),
    ],
)
def test_broken_methods_name_their_run(spark, document, message):
    with pytest.raises(Exception, match=message):
        _pump(spark, document)[1].collect()


def _from_xml(documents):
    """Both tables as ``from_xml`` reads them from each document; null if it is broken or has no pump."""
    parsed = F.from_xml("xml", f"{xml.METHOD_SCHEMA}, _corrupt_record string", {"columnNameOfCorruptRecord": "_corrupt_record"})
    read = documents.withColumn("p", parsed)
    sections = F.col("p.Doc.Content.MethodConfiguration.MethodDescription.Section.Section")
    pump = F.get(F.filter(sections, lambda s: s["Name"] == xml.PUMP_SECTION), F.lit(0))
    read = read.select("xml", F.when(F.col("p._corrupt_record").isNull(), pump["Table"]).alias("t"))
    return read.select("xml", *[F.get("t", F.lit(i))["Row"].alias(t) for i, t in enumerate(xml.PUMP_TABLES)])


def _odd_methods():
    """Documents at and beyond the bounds of what is plain, and random damage to them."""
    good = method_xml(STANDARD[:2]).decode("utf-8-sig")
    pretty = good.replace("><", ">\n  <").replace("<Value>\n  </Value>", "<Value></Value>")
    swaps = [
        ("<Value>Yes</Value>", v) for v in (
            "<Value> Yes</Value>", "<Value>Yes\n</Value>", "<Value> Yes </Value>", "<Value>a &amp; b</Value>",
            "<Value><![CDATA[Yes]]></Value>", "<Value>Y<!-- c -->es</Value>", "<Value/>", "<Value />", "<Value></Value>", "",
            "<Value>µ °C</Value>", "<Value>a > b</Value>", "<Value>a ]]> b</Value>", "<Value u='1'>Yes</Value>", "<Value> </Value>",
            "<Value><b>Yes</b></Value>", "<value>Yes</value>", "<Value>Yes</Value><Value>No</Value>", "<x:Value>Yes</x:Value>",
            "<Value>Yes</Valu>", "<Value>Yes", "Yes</Value>", "<Value>Yes</Value >", "<Value>a\r\nb</Value>", "<Value>\x01</Value>",
            "<Value>￿</Value>", "<Value>&lt;Row&gt;</Value>", "<Value>&no;</Value>", "text<Value>Yes</Value>", "<?pi x?><Value>Yes</Value>",
        )
    ] + [
        ("<Name>Binary Pump</Name>", n) for n in (
            "", "<Name> Binary Pump </Name>", "<Name>Binary Pump</Name><Name>Other</Name>", "<Name>Other</Name><Name>Binary Pump</Name>",
            "<Name>binary pump</Name>", "<Name/>", "<Name>Binary Pump</Name><Table/>", "<Name>Binary Pump</Name><Table></Table>",
            "<Name>Binary Pump</Name><X><Table><Row><Parameter><Name>Time</Name><Value>9</Value></Parameter></Row></Table></X>",
        )
    ] + [
        ("<Doc>", "<Doc><Doc></Doc>"), ("<Doc>", "<Doc x='a>b'>"), ("<Doc>", "<Doc x='1' x='2'>"), ("<Doc>", "<doc>"),
        ("<Doc>", "<Doc><Content/>"), ("<Content>", "<Content><![CDATA[</Content>]]>"), ("</ACAML>", "</ACAML>  \n"),
        ("</ACAML>", "</ACAML><a/>"), ("</ACAML>", "</ACAML>junk"), ("</ACAML>", ""), ("<?xml", " <?xml"), ("<?xml", "<!DOCTYPE a><?xml"),
        ('encoding="utf-8"', 'encoding="UTF-16"'), ('version="1.0"', 'version="1.1"'), ("<Row>", "<Row/><Row>"), ("<Row>", "<Row></Row><Row>"),
        ("<Row>", "<Row>text"), ("</Row>", "</Row><Row><X/></Row>"), ("<Parameter>", "<Parameter/><Parameter>"), ("<Parameter>", "<Parameter a=''>"),
        ("<Row>", "<ROW>"), ("<Table>", "<Table><Name>again</Name>"), ("<Table>", "<T>"), ("</Section>", "</Section><Section/>"),
        ("<Section><Name>Sampler", "<Section><Name>Binary Pump"), ("<Section><Name>Sampler", "<Section>a<Name>Sampler"),
    ]
    found = [good, pretty, "", "<", "<a>", "<a/>", "text", good + good, good[:-9], good[5:], "﻿" + good]
    for base in (good, pretty):
        found += [base.replace(old, new) for old, new in swaps] + [base.replace(old, new, 1) for old, new in swaps]
    draw = random.Random(5)
    pieces = re.findall(r"<[^>]*>|[^<]+", good)
    for _ in range(600):
        edited = list(pieces)
        for _ in range(draw.randint(1, 3)):
            at, other = draw.randrange(len(edited)), draw.choice(pieces)
            edited[at] = draw.choice(["", other, edited[at] + other, edited[at][:-1], edited[at].swapcase(), edited[at].replace("/", "")])
        found.append("".join(edited))
    return list(dict.fromkeys(found))


def test_plain_methods_are_read_as_from_xml_reads_them(spark):
    documents = _odd_methods()
    # read together, so that damage of one document could reach its neighbours
    stretches = list(plain_xml.plain_tables(pa.array([*documents, None]), xml.PUMP_SECTION, (0, 1)))
    plain = [p for _, _, found, _ in stretches for p in found.tolist()]
    tables = [[rows for *_, found in stretches for rows in found[i].to_pylist()] for i in (0, 1)]
    expected = {r["xml"]: r for r in _from_xml(spark.createDataFrame([(d,) for d in documents], "xml string")).collect()}
    for number, document in enumerate(documents):
        for name, table in zip(xml.PUMP_TABLES, tables):
            rows = table[number]
            assert (rows is not None) == plain[number]
            if plain[number]:
                theirs = [r.asDict(recursive=True) for r in expected[document][name]]
                for row in (*rows, *theirs):
                    for cell in row["Parameter"]:
                        cell["Value"] = cell["Value"] or ""
                assert rows == theirs, document
    assert plain[0] and plain[1] and not plain[-1] and 50 < sum(plain) < len(documents) - 300


def test_plain_methods_leave_no_text_to_from_xml(spark):
    good, noted = method_xml(STANDARD).decode("utf-8-sig"), method_xml(STANDARD[:1]).decode("utf-8-sig") + "<!-- end -->"
    df = spark.createDataFrame([("a", good), ("b", noted), ("c", good)], "id string, xml string")
    read = {r["id"]: r for r in xml._read_plain(df, ["id"], ["timetable"]).collect()}
    assert [(i, read[i]["__plain"], read[i]["__left"] is None) for i in "abc"] == [("a", True, True), ("b", False, False), ("c", True, True)]
    # both kinds in one table, with an own key for errors
    steps = xml.timetable_rows(xml.parse_methods(df.withColumn("place", F.upper("id")), where="place"))
    assert {r["id"]: r["count"] for r in steps.groupBy("id").count().collect()} == {"a": 4, "b": 1, "c": 4}
    torn = df.withColumn("place", F.upper("id")).withColumn("xml", F.substring("xml", 1, 200))
    with pytest.raises(Exception, match="broken method document in [ABC]"):
        xml.parse_methods(torn, where="place").collect()


def test_sequence_identity_comes_first(spark):
    def documents(*pairs):
        return spark.createDataFrame([(d, identity_xml(i).decode("utf-8-sig")) for d, i in pairs], "run_dir string, xml string")

    folders = spark.createDataFrame([("a",), ("b",)], "run_dir string")
    ids = xml.run_identity(folders, documents(("a", "seq")), documents(("a", "smp-a"), ("b", "smp-b")))
    assert {tuple(r) for r in ids.collect()} == {("a", "seq"), ("b", "smp-b")}
    with pytest.raises(Exception, match="no run id in b"):
        xml.run_identity(folders, documents(("a", "seq")), documents(("a", "x"))).collect()
    torn = documents(("b", "seq")).withColumn("xml", F.substring("xml", 1, 120))
    with pytest.raises(Exception, match="broken sequence document in b"):
        xml.run_identity(folders, torn, documents(("a", "x"), ("b", "y"))).collect()
    with pytest.raises(quality.QualityError, match="duplicate"):
        xml.run_folders(folders.union(folders))
    with pytest.raises(quality.QualityError, match="no acq.macaml"):
        xml.read_documents(spark, "/nowhere", "acq.macaml")


def test_single_value_counts_nulls(spark):
    df = spark.createDataFrame([(1, None), (1, 5), (1, 5)], "k int, v int")
    assert quality.require_single_value(df, "k") is df
    quality.require_single_value(df.where("v IS NULL"), "v")
    quality.require_single_value(df.limit(0), "v")
    with pytest.raises(quality.QualityError, match="nulls"):
        quality.require_single_value(df, "v")
