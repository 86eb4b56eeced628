import pytest
from pyspark.sql import functions as F

from docloom.functions import text as T
from docloom.operators import parse as P


def one(spark, value, kind="string"):
    return spark.createDataFrame([(value,)], f"x {kind}")


@pytest.mark.parametrize(
    "text, words",
    [
        ("Data-center GROWTH, 20%!", ["data", "center", "growth", "20"]),
        ("  ", []),
        ("", []),
        ("Größe año", ["größe", "año"]),
    ],
)
def test_tokens(spark, text, words):
    assert one(spark, text).select(T.tokens("x")).first()[0] == words


@pytest.mark.parametrize("number, text", [(1, "001"), (42, "042"), (999, "999"), (1000, "1000"), (123456, "123456")])
def test_pad_number_never_truncates(spark, number, text):
    assert one(spark, number, "bigint").select(T.pad_number(F.col("x"))).first()[0] == text


@pytest.mark.parametrize(
    "login, name",
    [("Jane.Doe@example.com", "jane_doe"), ("x", "x"), ("__a-b__@y", "a_b"), ("A.B+c@d@e", "a_b_c")],
)
def test_sanitize_identifier(spark, login, name):
    assert one(spark, login).select(T.sanitize_identifier("x")).first()[0] == name


def test_text_elements_skip_blank_lines(spark):
    elements = one(spark, "Title\n\n  \nbody one\nbody two").select(P.text_elements("x", title_first=True)).first()[0]
    assert [(e.id, e.type, e.content) for e in elements] == [
        (0, "title", "Title"), (1, "text", "body one"), (2, "text", "body two"),
    ]


HTML = """<html><head><title>A <i>page</i></title><link rel="x"><style>p{}</style></head><body>
<script>var p = "<p>no</p>";</script><!-- <p>hidden</p> --><H2 class="a">Risk <b>Factors</b></H2>
<p>First.</p><pre>not a paragraph</pre><ul><li>one</li><li>two</li></ul><p>Last</p></body></html>"""


def test_html_elements(spark):
    elements = one(spark, HTML).select(P.html_elements("x")).first()[0]
    assert [(e.id, e.type, e.content) for e in elements] == [
        (0, "title", "A page"),
        (1, "section_header", "Risk Factors"),
        (2, "text", "First."),
        (3, "preformatted", "not a paragraph"),
        (4, "list_item", "one"),
        (5, "list_item", "two"),
        (6, "text", "Last"),
    ]


def test_all_visible_text_of_a_page_is_in_its_elements(spark):
    page = "loose<div>in a div<p>par<table><tr><th>h</th><td>c <b>1</b></td></tr></table>after<footer>foot"
    elements = one(spark, page).select(P.html_elements("x")).first()[0]
    assert [(e.type, e.content) for e in elements] == [
        ("text", "loose"), ("text", "in a div"), ("text", "par"), ("table_cell", "h"), ("table_cell", "c 1"), ("text", "after"), ("text", "foot")]


def test_form_feeds_break_pages(spark):
    elements = one(spark, "a\n\x0cb\nc\x0c\n\x0cd").select(P.text_elements("x", title_first=True)).first()[0]
    assert [(e.type, e.content, e.page_id) for e in elements] == [("title", "a", 0), ("text", "b", 1), ("text", "c", 1), ("text", "d", 3)]


def test_parse_chooses_by_content_and_reads_bytes(spark):
    docs = spark.createDataFrame([(1, bytearray(HTML, "utf-8")), (2, bytearray(b"plain \xff text"))], "id int, content binary")
    parsed = {r.id: r.elements for r in P.parse_document(docs, "content", "auto").collect()}
    assert parsed[1][0].type == "title"
    assert [e.content for e in parsed[2]] == ["plain � text"]


def test_unknown_format(spark):
    with pytest.raises(ValueError):
        P.parse_document(one(spark, "x"), "x", "pdf")


def test_variant_round_trip_and_plain_text(spark):
    df = P.parse_document(one(spark, "a\n\nb"), "x", "text").select(P.to_variant(F.col("elements")).alias("v"))
    assert df.select(P.plain_text(P.from_variant("v"))).first()[0] == "a\n\nb"
    odd = spark.sql("""SELECT parse_json('{"document": {"elements": [{"id": 0, "type": "text", "content": null}, {"content": "z"}]}}') AS v,
                              parse_json('{"other": 1}') AS w""")
    assert odd.select(P.plain_text(P.from_variant("v"))).first()[0] == "z"
    assert odd.select(P.from_variant("w")).first()[0] is None


def test_costly_columns_are_computed_once(spark):
    df = P.parse_document(spark.range(1).select(F.lit("a\nb").alias("x")).repartition(1), "x", "text")
    df = T.compute_once(df, plain=P.plain_text("elements")).where(F.length("plain") > 0)
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("concat_ws(") == 1
