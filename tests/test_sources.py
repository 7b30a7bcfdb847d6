from __future__ import annotations

import json
from random import Random

import pytest
from pyspark.errors import AnalysisException

from tallyvault.model import CUSTOMERS, EVENTS, ORDERS, PAYMENTS
from tallyvault.sources import quoted
from tallyvault.sources.readers import (
    SourcePaths,
    read_customers,
    read_events,
    read_orders,
    read_payments,
    read_products,
)

from .support import tuples


def write(path, text):
    path.write_text(text, encoding="utf-8")
    return str(path)


CUSTOMER_HEADER = "customer_id,full_name,email,phone,city,created_at\n"


def test_csv_absent_fields_are_null_and_quoted_empty_ones_are_empty(spark, tmp_path):
    path = write(
        tmp_path / "c.csv",
        CUSTOMER_HEADER + '1,"Lee, ""Bo"" Anna",,"",  Oslo ,\\N\n' + "007,Ёжик,a@x.io,N/A,null,NaN\n",
    )
    assert tuples(read_customers(spark, path), *CUSTOMERS.columns) == [
        ("007", "Ёжик", "a@x.io", "N/A", "null", "NaN"),
        ("1", 'Lee, "Bo" Anna', None, "", "  Oslo ", "\\N"),
    ]


def test_csv_columns_go_by_position(spark, tmp_path):
    path = write(tmp_path / "c.csv", "f,e,d,c,b,a\n1,2,3,4,5,6\n")
    assert tuples(read_customers(spark, path), *CUSTOMERS.columns) == [tuple("123456")]


def test_csv_rows_of_the_wrong_width_fail_the_load(spark, tmp_path):
    for bad in ("1,2,3\n", "1,2,3,4,5,6,7\n"):
        path = write(tmp_path / "c.csv", CUSTOMER_HEADER + bad)
        with pytest.raises(Exception, match="MALFORMED"):
            read_customers(spark, path).collect()


def test_csv_line_feeds_inside_quotes(spark, tmp_path):
    path = write(tmp_path / "c.csv", CUSTOMER_HEADER + '1,"Anna\nLee",a,b,c,d\n')
    assert read_customers(spark, path, multi_line=True).first()["full_name"] == "Anna\nLee"
    with pytest.raises(Exception, match="MALFORMED"):
        read_customers(spark, path).collect()


@pytest.fixture()
def small_splits(spark):
    """Splits of a few bytes, so that records, quotes and lines run over their edges."""
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    before = {name: spark.conf.get(name) for name in names}

    def set_to(size):
        spark.conf.set(names[0], str(size))
        spark.conf.set(names[1], "1")

    yield set_to
    for name, value in before.items():
        spark.conf.set(name, value)


@pytest.mark.parametrize("size", [7, 16, 61, 1 << 20])
@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_quoted_line_feeds_are_read_by_many_tasks(spark, tmp_path, small_splits, size, end):
    """The same rows as one task per file gives, wherever the files are cut."""
    random = Random(size)
    names = ["Anna", "Lee\nBo", 'say ""hi""', "a,b", "\n\n", '""', "", '"",\n""', "é\n日本"]
    for part in range(3):
        rows = []
        for i in range(60):
            fields = [str(100 * part + i)]
            for _ in range(5):
                value = random.choice(names)
                fields.append(f'"{value}"' if random.random() < 0.6 or any(c in value for c in ',"\n') else value)
            rows.append(",".join(fields))
        text = CUSTOMER_HEADER.strip() + end + end.join(rows) + (end if part else "")
        (tmp_path / f"c{part}.csv").write_bytes(text.encode())
    expected = tuples(read_customers(spark, str(tmp_path), multi_line="document"), *CUSTOMERS.columns)
    small_splits(size)
    found = read_customers(spark, str(tmp_path), multi_line=True)
    assert tuples(found, *CUSTOMERS.columns) == expected and len(expected) == 180


def test_line_ends_within_quotes_stay_as_they_are(spark, tmp_path):
    (tmp_path / "c.csv").write_bytes(CUSTOMER_HEADER.encode() + b'1,"x\r\ny",c,d,"e\n",f\r\n')
    (found,) = tuples(read_customers(spark, str(tmp_path), multi_line=True), *CUSTOMERS.columns)
    assert found == ("1", "x\r\ny", "c", "d", "e\n", "f")


def test_a_header_may_hold_a_line_feed_and_files_may_be_empty(spark, tmp_path, small_splits):
    (tmp_path / "a.csv").write_text('"customer\nid",b,c,d,e,f\n1,2,3,4,5,6\n')
    (tmp_path / "b.csv").write_text("")
    (tmp_path / "c.csv").write_text(CUSTOMER_HEADER)
    for size in (5, 1 << 20):
        small_splits(size)
        assert tuples(read_customers(spark, str(tmp_path), multi_line=True), *CUSTOMERS.columns) == [tuple("123456")]


def test_only_records_of_several_lines_are_shuffled(spark, tmp_path):
    path = write(tmp_path / "c.csv", CUSTOMER_HEADER + "".join(f"{i},a,b,c,d,e\n" for i in range(500)) + '9,"a\nb",c,d,e,f\n')
    lines = quoted._lines(spark, path, quoted.CSV)
    contexts = quoted._contexts(lines.mapInArrow(quoted._summaries(quoted.CSV), quoted.SUMMARY_DDL).toArrow())
    cut = lines.mapInArrow(quoted._cut(spark.sparkContext.broadcast(contexts), quoted.CSV), quoted.LINE_DDL)
    assert cut.where("NOT alone").count() == 2
    assert read_customers(spark, path, multi_line=True).count() == 501


@pytest.mark.parametrize("way", [True, "document"])
def test_rows_of_the_wrong_width_fail_with_line_feeds_too(spark, tmp_path, way):
    for bad in ('1,"2\n3",4\n', '1,"2\n",3,4,5,6,7\n'):
        path = write(tmp_path / "c.csv", CUSTOMER_HEADER + bad)
        with pytest.raises(Exception, match="MALFORMED"):
            read_customers(spark, path, multi_line=way).collect()
    with pytest.raises(ValueError, match="unknown way"):
        read_customers(spark, path, multi_line="lines")


def test_payments_are_separated_by_carets(spark, tmp_path):
    header = "payment_id^order_id^payment_method^amount^currency^payment_timestamp\n"
    path = write(tmp_path / "p.csv", header + "1^2^card^3,50^USD^2024-01-01 00:00:00\n3^4^^^^\n")
    assert tuples(read_payments(spark, path), *PAYMENTS.columns) == [
        ("1", "2", "card", "3,50", "USD", "2024-01-01 00:00:00"),
        ("3", "4", None, None, None, None),
    ]


ORDER_TEXT = """[
  {"order_id": 1, "customer_id": "7", "product_id": 5, "quantity": 2, "unit_price": 109.90,
   "currency": "EUR", "order_timestamp": "2024-01-01 00:00:00", "status": "a}b{\\"c"},
  {"order_id": "2", "customer_id": null, "unit_price": 1e2, "currency": "", "extra": [1, 2]}
]"""


def test_orders_keep_their_text(spark, tmp_path):
    path = write(tmp_path / "o.json", ORDER_TEXT)
    assert tuples(read_orders(spark, path, "array"), *ORDERS.columns) == [
        ("1", "7", "5", "2", "109.90", "EUR", "2024-01-01 00:00:00", 'a}b{"c'),
        ("2", None, None, None, "1e2", None, None, None),
    ]


def test_orders_as_json_lines(spark, tmp_path):
    lines = [json.dumps({"order_id": i, "status": "completed"}) for i in range(5)]
    path = write(tmp_path / "o.jsonl", "\n".join(lines) + "\n")
    found = read_orders(spark, path, layout="lines")
    assert tuples(found, "order_id", "status") == [(str(i), "completed") for i in range(5)]


FLAT_ORDERS = """[{"order_id": 1, "unit_price": 109.90, "status": "say \\"hi\\" ]["},
  {"order_id": "2", "customer_id": null, "unit_price": 1e2} , {"quantity": 3, "currency": ""}
]
"""


@pytest.mark.parametrize("layout", ["array", "split"])
def test_orders_split_at_braces_read_the_same(spark, tmp_path, layout):
    path = write(tmp_path / "o.json", FLAT_ORDERS)
    columns = ("order_id", "customer_id", "quantity", "unit_price", "currency", "status")
    assert tuples(read_orders(spark, path, layout), *columns) == sorted(
        [
            ("1", None, None, "109.90", None, 'say "hi" ]['),
            ("2", None, None, "1e2", None, None),
            (None, None, "3", None, None, None),
        ],
        key=repr,
    )


@pytest.mark.parametrize("layout", ["lines", "split"])
def test_json_null_token_marks_nulls_but_not_missing_fields(spark, tmp_path, layout):
    rows = [{"order_id": 1, "customer_id": None}, {"order_id": 2}]
    text = "\n".join(map(json.dumps, rows)) if layout == "lines" else json.dumps(rows)
    path = write(tmp_path / "o.json", text)
    found = read_orders(spark, path, layout, json_null_token="None")
    assert tuples(found, "order_id", "customer_id") == [("1", "None"), ("2", None)]


@pytest.mark.parametrize("size", [5, 17, 40, 1 << 20])
def test_braces_within_texts_are_read_by_many_tasks(spark, tmp_path, small_splits, size):
    random = Random(size)
    texts = ["a}b", '"}{', "\\", "\\\"}", "}\n{", "{}", "", "é}日本", "\\}\\", "done"]
    for part in range(2):
        rows = [
            {"order_id": 100 * part + i, "status": random.choice(texts), "currency": random.choice(texts), "unit_price": "1}"}
            for i in range(50)
        ]
        separator = "," if part else "\n"
        body = separator.join(json.dumps(r, ensure_ascii=bool(i % 2)) for i, r in enumerate(rows))
        (tmp_path / f"o{part}.json").write_text(f"[{body}]" if part else body, encoding="utf-8")
    expected = [
        tuple(None if v in (None, "") else str(v) for v in (r.get(c) for c in ORDERS.columns))
        for f in sorted(tmp_path.glob("*.json"))
        for r in (json.loads(f.read_text()) if "1" in f.name else json.loads("[" + ",".join(decoded(f.read_text())) + "]"))
    ]
    small_splits(size)
    assert tuples(read_orders(spark, str(tmp_path)), *ORDERS.columns) == sorted(expected, key=repr)


def decoded(text):
    """JSON objects one after another."""
    decoder, at = json.JSONDecoder(), 0
    while at < len(text):
        value, end = decoder.raw_decode(text, at)
        yield json.dumps(value)
        at = end + 1


@pytest.mark.parametrize("row", ['{"status": {"a": 1}, "order_id": 1}', '{"order_id": 1, "status": {"a": "}"}}'])
def test_an_object_inside_an_object_fails_the_load(spark, tmp_path, row):
    path = write(tmp_path / "o.json", f"[{row}]")
    with pytest.raises(Exception, match="use the orders layout lines or array"):
        read_orders(spark, path, "split").collect()


def test_a_text_for_nulls_needs_a_splittable_layout(spark, tmp_path):
    with pytest.raises(ValueError, match="split or lines"):
        read_orders(spark, str(tmp_path), "array", json_null_token="None")


def test_nested_objects_are_refused_where_flat_ones_are_needed(spark, tmp_path):
    path = write(tmp_path / "o.jsonl", '{"status": {"order_id": 5}, "order_id": 1}')
    assert read_orders(spark, path, "lines").first()["order_id"] == "1"
    with pytest.raises(Exception, match="flat objects"):
        read_orders(spark, path, "lines", json_null_token="None").collect()


def test_large_arrays_and_documents_are_split_over_tasks(spark, tmp_path):
    orders = [{"order_id": i, "status": "x" * 200} for i in range(2000)]
    path = write(tmp_path / "o.json", json.dumps(orders, indent=2))
    body = "".join(f"<event>\n<event_id>{i}</event_id></event>\n" for i in range(2000))
    xml = write(tmp_path / "e.xml", f"<events>{body}</events>")
    spark.conf.set("spark.sql.files.maxPartitionBytes", 20_000)
    try:
        found, events = read_orders(spark, path, "split"), read_events(spark, xml, "split")
        for frame, key in ((found, "order_id"), (events, "event_id")):
            assert frame.rdd.getNumPartitions() > 3
            assert {int(r[0]) for r in frame.select(key).collect()} == set(range(2000))
            assert frame.count() == 2000
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_unknown_layouts_are_refused(spark, tmp_path):
    for read in (read_orders, read_events):
        with pytest.raises(ValueError, match="unknown layout"):
            read(spark, str(tmp_path), "pages")


@pytest.mark.parametrize("layout", ["document", "split"])
def test_events_at_any_depth(spark, tmp_path, layout):
    path = write(
        tmp_path / "e.xml",
        """<?xml version="1.0"?>
        <root><day n="1"><event><event_id>1</event_id><customer_id> 7 </customer_id>
          <event_type>view</event_type><event_timestamp>broken-date</event_timestamp>
          <product_id></product_id></event></day>
        <event><product_id>5</product_id><event_id>2</event_id></event></root>""",
    )
    assert tuples(read_events(spark, path, layout), *EVENTS.columns) == [
        ("1", " 7 ", "view", "broken-date", None),
        ("2", None, None, None, "5"),
    ]


@pytest.mark.parametrize(
    "inside",
    [
        "<event/>",
        "<event></event >",
        "<event><event></event></event>",
    ],
)
def test_documents_that_cannot_be_cut_reliably_fail_the_load(spark, tmp_path, inside):
    path = write(tmp_path / "e.xml", f"<a>{inside}<event><event_id>1</event_id></event></a>")
    with pytest.raises(Exception, match="cannot be read with layout split"):
        read_events(spark, path, "split").collect()


def test_a_missing_input_stops_before_any_work(spark, tmp_path):
    there = write(tmp_path / "c.csv", CUSTOMER_HEADER)
    paths = SourcePaths(there, there, there, there, str(tmp_path / "absent.xml"))
    with pytest.raises(AnalysisException) as caught:
        paths.read(spark)
    assert caught.value.getCondition() == "PATH_NOT_FOUND"


def test_products_are_comma_separated(spark, tmp_path):
    path = write(tmp_path / "p.csv", "product_id,product_name,category,price,currency,is_active\n"
                 "1, lamp ,Home,,USD,False\n")  # fmt: skip
    assert tuples(read_products(spark, path), "product_name", "price") == [(" lamp ", None)]


@pytest.mark.parametrize("size", [11, 37, 150, 1 << 20])
def test_events_among_comments_and_cdata_are_read_by_many_tasks(spark, tmp_path, small_splits, size):
    """The same rows as one task per file gives, wherever the files are cut."""
    random = Random(size)
    odd = [
        "", "\n", "<!-- <event><event_id>9</event_id></event> -->", "<!-- </event> <![CDATA[ -->", "<other>x</other>",
        "<!--<event>--><!--</event>-->",
    ]
    texts = ["1", "<![CDATA[</event>]]>", "<![CDATA[<!-- </event><event> ]]>", "a<!-- </event> -->b", "<![CDATA[x]]>y"]
    for part in range(2):
        body = ""
        for i in range(60):
            body += random.choice(odd)
            body += f"<event><event_id>{100 * part + i}</event_id><event_type>{random.choice(texts)}</event_type></event>"
        (tmp_path / f"e{part}.xml").write_text(f"<events>{body}{random.choice(odd)}</events>", encoding="utf-8")
    expected = tuples(read_events(spark, str(tmp_path), "document"), *EVENTS.columns)
    small_splits(size)
    assert tuples(read_events(spark, str(tmp_path)), *EVENTS.columns) == expected and len(expected) == 120
