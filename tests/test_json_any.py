"""JSON lines whose keys are not known beforehand."""

from tomewise.sources.catalog import column_type, scan_json_any
from tomewise.sources.workspace import new_path


def scan(spark, lines, **more):
    path = new_path(spark, "lines")
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.text(path)
    return scan_json_any(spark, path, **more)


def test_keys_of_all_records_count(spark):
    got = scan(spark, [
        '{"a": 1, "b": {"c": "x", "d-e": [1, 2.5]}, "none": null, "mixed": 1, "empty": {}}',
        "{bad", "[1]", "3", "null", "", '{"a": 1, "a": 2}',
        '{"a": 2.5, "OBJECT<": [{"q": 1}, {"r": "2"}], "mixed": "s", "late`key": true, "VOID": 7}',
    ])
    types = dict(got.dtypes)
    assert types["a"].startswith("decimal")
    assert types["none"] == "string" and types["mixed"] == "variant" and types["empty"] == "variant"
    assert types["OBJECT<"] == "array<struct<q:bigint,r:string>>" and types["VOID"] == "bigint"
    first, second = sorted(got.collect(), key=lambda r: r.a)
    assert (first.b.c, [float(x) for x in first.b["d-e"]], first["late`key"]) == ("x", [1.0, 2.5], None)
    assert (float(second.a), second["late`key"], second.b) == (2.5, True, None)
    assert second["OBJECT<"][1].r == "2" and second["OBJECT<"][0].r is None
    assert [first.mixed.toPython(), second.mixed.toPython()] == [1, "s"]


def test_budget_of_lines_and_nothing_to_read(spark):
    lines = ['{"a": 1}', "bad", '{"b": 2}']
    assert scan(spark, lines, sample_size=2).columns == ["a"]
    for none in (["bad"], ["{}"], []):
        assert scan(spark, none).columns == []
    assert scan(spark, ["{}", "{}"]).count() == 2


def test_types_are_replaced_outside_names_only():
    assert column_type("OBJECT<VOID: VOID, `OBJECT<`: ARRAY<OBJECT<MY_VOID: VOID>>, `a``VOID`: OBJECT<>>") == (
        "STRUCT<VOID: STRING, `OBJECT<`: ARRAY<STRUCT<MY_VOID: STRING>>, `a``VOID`: VARIANT>"
    )
