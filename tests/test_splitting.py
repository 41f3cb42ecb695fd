"""Large files cut at every possible place give the records of a reader that has the whole document."""

import json
import random
import xml.sax.saxutils as sax

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException

from tillwork import schemas
from tillwork.sources import files, splitting

FEW = settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


@pytest.fixture
def small_splits(monkeypatch):
    def use(size):
        monkeypatch.setattr(splitting, "SPLIT_BYTES", size)

    return use


def plain(df):
    return sorted(map(str, df.collect()))


ODD_TEXTS = ["", "}", "{", "]", "[{", '"', "\\", '\\"', "}\\", "a,b", "é中", "\u2028", "},\n{", "x" * 300]


def reviews(count, seed):
    rng = random.Random(seed)
    return [
        {
            "review_id": f"R{k}", "title": rng.choice(ODD_TEXTS), "content": "".join(rng.choices(ODD_TEXTS, k=4)),
            "aspects": [{"name": rng.choice(ODD_TEXTS), "rating": k % 5} for _ in range(rng.randint(0, 3))],
        }
        for k in range(count)
    ]


FORMATS = {
    "indented": lambda rows: json.dumps(rows, indent=2),
    "one line": lambda rows: json.dumps(rows, ensure_ascii=False),
    "wide": lambda rows: json.dumps(rows, indent="\t\t\t", separators=(" ,\n", " :\n")) + "\n\n",
}


@pytest.mark.parametrize("form", FORMATS)
@pytest.mark.parametrize("size", [37, 64, 501, 4_000, 1 << 20])
def test_json_of_any_formatting(spark, tmp_path, small_splits, form, size):
    small_splits(size)
    for number, count in enumerate((60 if size > 50 else 12, 0, 1)):
        (tmp_path / f"{number}.json").write_text(FORMATS[form](reviews(count, number)), encoding="utf-8")
    split = files.read_json_array(spark, str(tmp_path), schemas.REVIEWS_JSON, "split")
    whole = files.read_json_array(spark, str(tmp_path), schemas.REVIEWS_JSON, "document")
    assert plain(split) == plain(whole) and split.sparkSession is spark
    if size < 1_000:
        assert splitting._pieces(spark, str(tmp_path), "}").rdd.getNumPartitions() > 10


@pytest.mark.parametrize("size", [50, 1 << 20])
@pytest.mark.parametrize("text", [
    "\n".join(json.dumps(one) for one in reviews(9, 1)), "".join(json.dumps(one, indent=1) for one in reviews(9, 1)),
    "\n".join(json.dumps(one) for one in reviews(9, 1)) + "\n", "\ufeff" + json.dumps(reviews(9, 1)),
    json.dumps(reviews(4, 1), indent=1) + "\n" + json.dumps(reviews(9, 1)[4:]),
])
def test_other_json_layouts(spark, tmp_path, small_splits, size, text):
    small_splits(size)
    (tmp_path / "a.json").write_text(text, encoding="utf-8")
    (tmp_path / "b").mkdir()
    (tmp_path / "b" / "a.json").write_text(json.dumps(reviews(9, 1)))
    split = files.read_json_array(spark, str(tmp_path / "a.json"), schemas.REVIEWS_JSON, "split")
    assert plain(split) == plain(files.read_json_array(spark, str(tmp_path / "b"), schemas.REVIEWS_JSON, "document"))


@pytest.mark.parametrize("size", [7, 1 << 20])
@pytest.mark.parametrize("text", [
    '[{"review_id": "R1"}', '[{"review_id": "R1"', '{"review_id": "R1"', '{"review_id": "R1"\n', '[{"review_id": "R1}', '[{"review_id": "R1"}]]',
    '[1, {"review_id": "R1"}]', '["a", {"review_id": "R1"}]', '{"review_id": "R1"} x', '[{"review_id": "R1"} {]', '[{"review_id": "R1", "rating": }]',
    '{"review_id": "R1"}}', '[{"review_id": "R1"}] {"review_id": "R2"}',
])
def test_malformed_json_fails(spark, tmp_path, small_splits, size, text):
    small_splits(size)
    (tmp_path / "a.json").write_text(text)
    with pytest.raises((PySparkException, Py4JJavaError)):
        files.read_json_array(spark, str(tmp_path / "a.json"), schemas.REVIEWS_JSON, "split").collect()


@FEW
@given(st.lists(st.dictionaries(st.sampled_from(["review_id", "title", "content"]), st.text("{}[]\"\\,é\n a", max_size=12), max_size=3), max_size=8), st.integers(5, 60), st.integers(0, 3))
def test_any_json_texts(spark, tmp_path, rows, size, indent):
    before, splitting.SPLIT_BYTES = splitting.SPLIT_BYTES, size
    try:
        path = tmp_path / "any.json"
        path.write_text(json.dumps(rows, indent=indent or None), encoding="utf-8")
        split = files.read_json_array(spark, str(path), schemas.REVIEWS_JSON, "split").select("review_id", "title", "content").collect()
    finally:
        splitting.SPLIT_BYTES = before
    assert sorted(map(tuple, split), key=str) == sorted((tuple(one.get(k) for k in ("review_id", "title", "content")) for one in rows), key=str)


def customers(count):
    """Records among comments, CDATA, instructions and attributes that hold the record's tag."""
    rng = random.Random(count)
    traps = [
        "<!-- <customer><customer_id>no</customer_id></customer> -->", "<!-- </customer> > - - > <customer> -->", "<?note <customer> </customer> > ?>",
        "<other note='/customers> > customer/>'/>", '<other note="a > b"><customer_idx/></other>', "<![CDATA[<customer> ]] > </customer>]]>", "\n\n", "",
    ]
    parts = ['<?xml version="1.0"?>\n<!DOCTYPE customers [ <!ENTITY x "<customer>"> ]>\n<customers kind="a > b">']
    expected = []
    for k in range(count):
        parts.append(rng.choice(traps))
        kind = rng.randrange(6)
        if kind == 0:
            parts.append(rng.choice(["<customer/>", "<customer />", '<customer a="x > y" b=\'"/>\'/>']))
            continue
        children = []
        for number in range(rng.randint(0, 3)):
            value = rng.choice(["a & b", "x > y", "</customer>", "<customer>", "é中", "'\"", "-->", "12"])
            written = f"<![CDATA[{value}]]>" if rng.random() < 0.5 else sax.escape(value)
            children.append(f"{rng.choice(traps[:3] + [''])}<preference><type>t{number}</type>\n <value>{written}</value></preference>")
            expected.append((f"C{k}", f"t{number}", value))
        opening = rng.choice(["<customer>", "<customer  kind='a>b'>", '<customer\n note="/customer>">'])
        closing = rng.choice(["</customer>", "</customer >", "</customer\n>"])
        parts.append(f"{opening}<customer_id>C{k}</customer_id>{''.join(children)}{closing}")
    return "\n".join([*parts, "<!-- <customer> -->", "</customers>"]), expected


@pytest.mark.parametrize("size", [33, 100, 1_009, 1 << 20])
def test_xml_with_the_tag_in_comments_and_cdata(spark, tmp_path, small_splits, size):
    small_splits(size)
    text, expected = customers(60 if size > 50 else 20)
    path = tmp_path / "customers.xml"
    path.write_text(text, encoding="utf-8")
    read = files.read_preferences(spark, str(path), "split").select("customer_id", "preference_type", "preference_value")
    assert sorted(tuple(row) for row in read.collect()) == sorted(expected)
    records = files.read_xml_records(spark, str(path), "customer", schemas.PREFERENCES_XML, "split")
    assert records.count() == (60 if size > 50 else 20)


def test_both_layouts_agree_on_plain_traps(spark, tmp_path, small_splits):
    """What Spark's own reader takes as well: comments and CDATA inside of records."""
    small_splits(41)
    body = "".join(
        f"<customer><!-- </customer> --><customer_id>C{k}</customer_id><preference><type>t</type><value><![CDATA[</customer>{k}]]></value></preference></customer>\n"
        for k in range(30)
    )
    path = tmp_path / "customers.xml"
    path.write_text(f"<customers>{body}</customers>")
    split, whole = (files.read_preferences(spark, str(path), layout).drop("last_updated") for layout in ("split", "document"))
    assert plain(split) == plain(whole) and split.count() == 30


@pytest.mark.parametrize("text", ["<customers><customer><customer_id>C1</customer_id>", "<customers><customer", "<customers><customer a='", "<customers><!-- <customer/>"])
@pytest.mark.parametrize("size", [9, 1 << 20])
def test_truncated_xml_fails(spark, tmp_path, small_splits, size, text):
    small_splits(size)
    (tmp_path / "a.xml").write_text(text)
    with pytest.raises((PySparkException, Py4JJavaError)):
        files.read_preferences(spark, str(tmp_path / "a.xml"), "split").collect()
