import datetime as dt

from tidemark.plans.directory import snapshot_tables
from tidemark.sources.pages import extract_page_links, extract_page_records

PEOPLE = """
<div class="x section-toggle"><h2>Top</h2><div><div class="section-body big"><ul>
 <li><div class="rank"> Chief </div><div class="name">Ann &amp; Co</div>
     <div class="email"><span>no</span><div> ann@x </div></div></li>
 <li><div class="rank">Clerk<br></div><p class="name">Bob</p></li>
 <li><div class="rank"></div><div class="name">Nobody</div></li>
 <li><div class="rank">Lost</div></li>
</ul><ul><li><div class="rank">Second</div><div class="name">List</div></li></ul></div></div></div>
<div class="section-info"><p>text<ul><li><b class="rank">Deep</b><i class="name">Cy</i>
   <ul><li><b class="rank">Inner</b><i class="name">Di</i></li></ul></li></ul></div>
<div class="section-info">no list</div>
<ul><li><b class="rank">Outside</b><i class="name">Ed</i></li></ul>
"""
UNITS = """
<div class="tab-pane"><ul><li><a href="/no">Other list</a></li></ul>
<ul class="section-listing wide"><LI><a href="/a">  Unit
   <b>A</b> </a></LI><li>No link</li></ul></div>
<div class="tab-pane"><ul class="section-listing"><li><a class=q href='/b'>B<img src=x></a></li></ul></div>
"""


def pages(spark, *htmls):
    return spark.createDataFrame(
        [(h, f"dept{i}", f"/p{i}") for i, h in enumerate(htmls)],
        "html string, department string, url string",
    )


def test_records(spark, rows):
    got = rows(extract_page_records(pages(spark, PEOPLE, "<p>none</p>", None, "<li>")))
    assert got == sorted(
        [
            ("Chief", "Ann & Co", "ann@x", "dept0", "/p0"),
            ("Clerk", "Bob", "", "dept0", "/p0"),
            ("Deep", "Cy", "", "dept0", "/p0"),
            ("Inner", "Di", "", "dept0", "/p0"),
        ]
    )


def test_links(spark, rows):
    assert rows(extract_page_links(pages(spark, UNITS, PEOPLE))) == sorted(
        [("dept0", "Unit A", "/a", 0), ("dept0", "No link", None, 1), ("dept0", "B", "/b", 2)],
        key=repr,
    )


def test_unclosed_and_stray_tags(spark, rows):
    html = "<div class=tab-pane></p><ul class=section-listing><li><a href=/x>X</b></a></li>"
    assert rows(extract_page_links(pages(spark, html))) == [("dept0", "X", "/x", 0)]


def test_odd_declarations_are_skipped(spark, rows):
    html = "<![weird x]><!DOCTYPE><?php x ?><![CDATA[y]]><!-- -->" + UNITS + "<![ open"
    assert len(rows(extract_page_links(pages(spark, html)))) == 3


def test_many_items_on_one_page(spark):
    items = "".join(f"<li><a href=/{i}>U{i}</a></li>" for i in range(5_000))
    html = f"<div class='tab-pane'><ul class='section-listing'>{items}</ul></div>"
    assert extract_page_links(pages(spark, html)).count() == 5_000


def page(*units, people=()):
    listed = "".join(f"<li><a href='{link}'>{name}</a></li>" for name, link in units)
    staff = "".join(f"<li><b class=rank>{p}</b><b class=name>{n}</b></li>" for p, n in people)
    return (
        f"<div class=tab-pane><ul class=section-listing>{listed}</ul></div>"
        f"<div class=section-info><ul>{staff}</ul></div>"
    )


def test_snapshot_tables(spark, rows):
    site = {
        "/top": page(("B", "/b"), ("A", "/a"), people=[("Head", "Ann")]),
        "/a": page(("C", "/c"), ("Lost", "/lost")),
        "/b": page(("C again", "/c"), ("Top", "/top")),
        "/c": page(people=[("Clerk", "Cy")]),
        "/other": page(people=[("Nobody", "Nil")]),
    }
    table = spark.createDataFrame(list(site.items()), "url string, html string")
    at = dt.datetime(2024, 1, 1)
    got = snapshot_tables(table, "/top", "Group", at)
    assert rows(got["names"], "position", "name", "department", "url", "group_name") == [
        ("Clerk", "Cy", "C again", "/c", "Group"), ("Clerk", "Cy", "C", "/c", "Group"),
        ("Head", "Ann", "Group", "/top", "Group"),
    ]
    assert rows(got["departments"], "parent_name", "department_name", "department_link", "children") == sorted(
        [
            (None, "Group", "/top", "B, A"), ("Group", "A", "/a", "C, Lost"),
            ("Group", "B", "/b", "C again"), ("A", "C", "/c", ""), ("A", "Lost", "/lost", ""),
            ("B", "C again", "/c", ""),
        ],
        key=repr,
    )
    assert rows(got["metadata"], "table_name", "num_rows") == [("departments", 6), ("names", 3)]


def test_text_of_scripts_and_styles_is_left_out(spark):
    html = (
        '<div class="tab-pane"><ul class="section-listing"><li><a href="/a">Unit A<script>var q=1;</script></a>'
        "<style>p{}</style><template>t</template></li></ul></div>"
    )
    pages = spark.createDataFrame([("u", html)], "department string, html string")
    (row,) = extract_page_links(pages).collect()
    assert row["name"] == "Unit A"
