"""Readers and writers on files."""

import json
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from listing_analytics import schemas
from listing_analytics.functions import text
from listing_analytics.sinks import runs, tables as sinks
from listing_analytics.sources import documents, lists, photos, tables


def write(path, content):
    path.write_text(content, encoding="utf-8")
    return str(path)


BUSINESS_CSV = (
    "business_id,name,categories,stars,attributes.Open24Hours,attributes.DietaryRestrictions.vegan,attributes.AgesAllowed\n"
    '123,"Say ""hi, there""\nagain","Burgers, Bars",2.5,True,False,18\n'
    "b2,Plain,,1.0,,NA,\n"
)


def test_entity_types_and_quoting(spark, tmp_path):
    df = tables.read_entity(spark, write(tmp_path / "b.csv", BUSINESS_CSV), "business")
    assert dict(df.dtypes)["business_id"] == "string"
    assert dict(df.dtypes)["attributes.Open24Hours"] == "boolean"
    one, two = sorted(df.collect(), key=lambda r: r["business_id"])
    assert one["business_id"] == "123" and one["stars"] == 2.5
    assert one["name"] == 'Say "hi, there"\nagain'
    # any text is true, also "False" and a missing-value token
    assert one["attributes.DietaryRestrictions.vegan"] is True
    assert two["attributes.DietaryRestrictions.vegan"] is True
    assert one["attributes.Open24Hours"] is True and two["attributes.Open24Hours"] is None
    assert two["categories"] is None and two["attributes.AgesAllowed"] is None


def test_strict_flags_parse_the_text(spark, tmp_path):
    df = tables.read_entity(spark, write(tmp_path / "b.csv", BUSINESS_CSV), "business", strict_flags=True)
    rows = {r["business_id"]: r["attributes.DietaryRestrictions.vegan"] for r in df.collect()}
    assert rows == {"123": False, "b2": None}


def test_unknown_entity_is_refused(spark, tmp_path):
    with pytest.raises(ValueError, match="unknown entity"):
        tables.read_entity(spark, str(tmp_path), "shop")


def test_missing_tokens_become_null(spark):
    cells = spark.createDataFrame([(t,) for t in text.MISSING_TOKENS] + [("x",)], "c string")
    assert [r.c for r in tables.apply_types(cells, {}).where("c is not null").collect()] == ["x"]


def test_long_field_and_field_limit(spark, tmp_path):
    path = write(tmp_path / "c.csv", "business_id,date\nb1," + "2020-01-01 " * 20000 + "\n")
    assert tables.read_entity(spark, path, "checkin").select(F.length("date")).head()[0] > 131072
    with pytest.raises(Exception, match="1000|maximum"):
        tables.read_entity(spark, path, "checkin", max_field_chars=1000).collect()


def test_malformed_rows_fail_or_are_set_aside(spark, tmp_path):
    path = write(tmp_path / "t.csv", "business_id,text\nb1,ok\nb2,too,many\n")
    with pytest.raises(Exception, match="Malformed"):
        tables.read_text_table(spark, path, multi_line=False).collect()
    kept = tables.read_text_table(spark, path, multi_line=False, mode="PERMISSIVE")
    assert [r[tables.CORRUPT] for r in tables.bad_rows(kept).collect()] == ["b2,too,many"]


def test_scans_split(spark, tmp_path):
    path = write(tmp_path / "r.csv", "business_id,stars\n" + "".join(f"b{i},{i % 5}\n" for i in range(5000)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        assert tables.read_entity(spark, path, "review", multi_line=False).rdd.getNumPartitions() > 1
        assert tables.read_entity(spark, path, "review").rdd.getNumPartitions() > 1
        assert tables.read_entity(spark, path, "review").count() == 5000
        assert tables.read_entity(spark, path, "review", multi_line=False).count() == 5000
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def _field(draw):
    kind = draw.random()
    if kind < 0.3:
        return "".join(draw.choice("abc x5é") for _ in range(draw.randint(0, 8)))
    if kind < 0.4:
        return 'x" y' + draw.choice(['"', "", ' "q"'])  # quotes that open nothing
    signs = ["a", "b", '""', "\n", ",", " ", "é", "\n\n", '""\n""']
    return '"' + "".join(draw.choice(signs) for _ in range(draw.randint(0, 14))) + '"'


@pytest.mark.parametrize("size", ["128m", "250", "5000"])
def test_quoted_breaks_over_splits(spark, tmp_path, size):
    draw = random.Random(3)
    for part in range(2):
        lines = [",".join([str(i), *(_field(draw) for _ in range(3))]) for i in range(120)]
        lines.insert(60, 'long,"' + "line\n" * 900 + '",1,""""')
        (tmp_path / f"{part}.csv").write_text('id,"t ""x""","u.v",w\n\n' + "\n".join(lines) + ("\n" if part else ""), encoding="utf-8")
    whole = spark.read.options(header=True, quote='"', escape='"', multiLine=True, maxCharsPerColumn=-1).csv(str(tmp_path))
    spark.conf.set("spark.sql.files.maxPartitionBytes", size)
    spark.conf.set("spark.sql.files.openCostInBytes", "64")
    try:
        table = tables.read_text_table(spark, str(tmp_path), file_order="at")
        assert table.columns == ["id", 't "x"', "u.v", "w", "at"]
        assert size == "128m" or table.rdd.getNumPartitions() > 5
        expected = [str(i) for i in range(120)]
        expected.insert(60, "long")
        assert [r.id for r in table.orderBy("at").collect()] == 2 * expected
        assert Counter(map(tuple, table.drop("at").collect())) == Counter(map(tuple, whole.collect()))
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_line_ends_and_bad_records(spark, tmp_path):
    path = write(tmp_path / "t.csv", '\r\nid,text\r\n1,"a\r\nb"\r\n\r\n2,c\r\n')
    # line ends between records go, those inside quotes are text
    assert sorted(tuple(r) for r in tables.read_text_table(spark, path).collect()) == [("1", "a\r\nb"), ("2", "c")]
    bad = write(tmp_path / "bad.csv", 'id,text\n1,"a\nb",c\n2,"ok\n"\n')
    with pytest.raises(Exception, match="Malformed"):
        tables.read_text_table(spark, bad).collect()
    kept = tables.read_text_table(spark, bad, mode="PERMISSIVE")
    assert [r[tables.CORRUPT] for r in tables.bad_rows(kept).collect()] == ['1,"a\nb",c']
    with pytest.raises(ValueError, match="mode"):
        tables.read_text_table(spark, bad, mode="DROPMALFORMED")


def test_files_with_other_headers_are_refused(spark, tmp_path):
    (tmp_path / "d").mkdir()
    write(tmp_path / "d" / "0.csv", 'id,"te\nxt"\n1,"a\nb"\n')
    write(tmp_path / "d" / "1.csv", '"id","te\nxt"\n2,c\n')
    assert sorted(r.id for r in tables.read_text_table(spark, str(tmp_path / "d")).collect()) == ["1", "2"]
    write(tmp_path / "d" / "2.csv", '"te\nxt",id\nc,3\n')
    with pytest.raises(Exception, match="another header"):
        tables.read_text_table(spark, str(tmp_path / "d")).collect()
    empty = write(tmp_path / "empty.csv", "id,text\n")
    assert tables.read_text_table(spark, empty).count() == 0


def test_csv_round_trip_keeps_quotes_breaks_and_blanks(spark, tmp_path):
    rows = [("1", 'a "b", c', ""), ("2", "line\nbreak", None), ("3", " pad ", "x")]
    df = spark.createDataFrame(rows, "business_id string, text string, other string")
    assert sinks.write_csv(df, str(tmp_path / "out")) == 3
    back = tables.read_entity(spark, str(tmp_path / "out"), "review")
    assert {(r.business_id, r.text, r.other) for r in back.collect()} == {
        ("1", 'a "b", c', None), ("2", "line\nbreak", None), ("3", " pad ", "x")
    }
    raw = "".join(p.read_text() for p in (tmp_path / "out").glob("*.csv"))
    assert '1,"a ""b"", c",\n' in raw  # an empty text prints as nothing


def test_no_path_writes_nothing(spark):
    assert sinks.write_csv(spark.range(1), None) is None


def test_lines(spark, tmp_path):
    path = write(tmp_path / "ids.txt", "a  \nb\t\n\na\n c \n")
    assert [r.value for r in lists.read_lines(spark, path).collect()] == ["a", "b", "", "a", " c"]
    df = spark.createDataFrame([(1,), (2,)], "`business.id` int")
    sinks.write_lines(df, str(tmp_path / "out"), "business.id")
    assert sorted(r.value for r in lists.read_lines(spark, str(tmp_path / "out")).collect()) == ["1", "2"]


CATEGORIES = {
    "categories": [
        {"alias": "restaurants", "title": "Restaurants", "parent_aliases": [], "country_whitelist": [], "country_blacklist": []},
        {"alias": "burgers", "title": "Burgers", "parent_aliases": ["restaurants"], "country_blacklist": ["IT"]},
        {"alias": "gluten_free", "title": "Gluten-Free", "parent_aliases": ["restaurants", "food"]},
        {"alias": "cheeseburgers", "title": "Cheeseburgers", "parent_aliases": ["burgers"]},
        {"alias": "odd", "title": "Odd", "parent_aliases": None},
    ]
}


def test_categories(spark, tmp_path):
    path = write(tmp_path / "c.json", json.dumps(CATEGORIES, indent=2))
    tree = documents.read_categories(spark, path)
    assert tree.columns == schemas.CATEGORY.names
    assert tree.count() == 5
    rows = {r.alias: r for r in tree.collect()}
    assert rows["burgers"].country_blacklist == ["IT"] and rows["odd"].parent_aliases is None


def test_class_map_round_trip(spark, tmp_path):
    classes = spark.createDataFrame([(1, "1_5"), (0, "1_0"), (10, "5_0")], "class_idx int, cat string")
    sinks.write_class_map(classes, str(tmp_path / "map"))
    body = "".join(p.read_text() for p in (tmp_path / "map").glob("*.txt"))
    assert body.strip() == '{"0":"1_0","1":"1_5","10":"5_0"}'
    back = documents.read_class_map(spark, str(tmp_path / "map"))
    assert {tuple(r) for r in back.collect()} == {(0, "1_0", 1.0), (1, "1_5", 1.5), (10, "5_0", 5.0)}


def test_json_flat(spark, tmp_path):
    line = {"business_id": "b1", "hours": {"monday": "9-5", "extra": {"note": "x"}}, "tags": ["a"]}
    path = write(tmp_path / "b.json", json.dumps(line) + "\n")
    df = documents.read_json_flat(spark, path)
    assert set(df.columns) == {"business_id", "hours.monday", "hours.extra.note", "tags"}
    assert df.head()["hours.extra.note"] == "x"
    rooted = documents.read_json_flat(spark, path, keep_roots=True)
    assert json.loads(rooted.head()["hours"])["monday"] == "9-5"


def test_photo_dataset_round_trip(spark, tmp_path):
    df = spark.createDataFrame(
        [("b", 1.5, "1_5", [1, 0], 3, "p", "p.jpg", "JPEG", 4, 3, "RGB")],
        "business_id string, stars double, stars_cat string, stars_ord array<int>, stars_num int, photo_id string, "
        "photo_file string, format string, width int, height int, mode string",
    )
    sinks.write_csv(df, str(tmp_path / "d"))
    assert tables.read_photo_dataset(spark, str(tmp_path / "d")).collect() == df.collect()


def test_photo_listing(spark, tmp_path):
    for name in ("a.jpg", "b.tar.png", "noext"):
        (tmp_path / name).write_bytes(b"x")
    rows = {r.photo_file: (r.stem, r.ext) for r in photos.list_photos(spark, str(tmp_path)).collect()}
    assert rows == {"a.jpg": ("a", ".jpg"), "b.tar.png": ("b.tar", ".png"), "noext": ("noext", "")}


def test_run_log(spark, tmp_path):
    history = spark.createDataFrame(
        [("m", "r1", e, 0.1 * e, 0.2, 1.0 / e, 2.0 / e) for e in (1, 2, 3)],
        "model string, run_id string, epoch int, accuracy double, val_accuracy double, loss double, val_loss double",
    )
    run = spark.sql(
        "select 'r1' run_id, 'm' model, timestamp'2024-01-01 10:00:00' datetime, 3 epochs, "
        "map('seed','1','batch_size','32') params, 'out' results_folder, true model_saved"
    )
    runs.write_epochs(history, str(tmp_path / "epochs"))
    assert spark.read.parquet(str(tmp_path / "epochs")).count() == 3
    rows = runs.run_rows(history, run)
    for _ in range(2):
        runs.append_runs(rows, str(tmp_path / "log"))
    log = spark.read.parquet(str(tmp_path / "log"))
    assert log.count() == 2
    one = runs.run_log_text(log).head()
    assert one.params == "batch_size=32;seed=1" and one.loss == 1.0 / 3 and one.accuracy == pytest.approx(0.3)


def test_nested_params_are_written_as_text(spark):
    params = text.nested_params({"z": 1, "opt": {"b": 2, "a": {"y": 1, "x": [3, 4]}}, "list": ["p", "q"]})
    assert params == {"z": "1", " opt": " a= x=3;;;;4;;;y=1;;b=2", " list": "p;;q"}
    line = spark.createDataFrame([(params,)], "m map<string,string>").select(text.params_text(F.col("m"))).head()[0]
    assert line == " list=p;;q; opt= a= x=3;;;;4;;;y=1;;b=2;z=1"


def test_nested_params_text(spark):
    out = spark.sql("select map('b','2','a','1') m").select(text.nested_params_text(F.col("m"), "opt")).head()[0]
    assert out == " opt=a=1;;b=2"
