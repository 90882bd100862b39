import json

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tidemark.llm.html_text import EQUAL, Alignment, Page, Reference, extract_text, host_of, main_text, mark_of
from tidemark.llm.queries import op9_html_text

PAGES = [
    ("<p>one <b>two</b>\n three</p><p>four", ["one two three", "four"]),
    ("<title>t</title><body>x<br>y<div>z</div>w</body>", ["x y", "z", "w"]),
    ("<nav><p>menu</p></nav><article><h1>A &amp; B</h1><p>x&lt;y&#233;</article><p>out</p>", ["A & B", "x<yé"]),
    ("<script>var t='</p>';</script><style>p{}</style><p>t</p><!-- <p>no</p> -->", ["t"]),
    ("<article><p>a</p><div class='ad'>buy</div><ul><li>1<li>2</ul></article>", ["a", "1", "2"]),
    ("<main><p>a</p><section class=\"reader-comments\"><p>c</p></section><aside>s</aside></main>", ["a"]),
    ("<div id=cookieNotice>cookies</div><div class=\"no-sidebar\"><p>a</p></div>", ["a"]),
    ("<header>site</header><article><header><h1>T</h1></header><p>x</p><footer>f</footer></article>", ["T", "x"]),
    ("<form><p>q</p></form><p>a<button>b</button>c</p>", ["ac"]),
    ("plain text", ["plain text"]), ("", []), ("<p>", []), ("a < b and c > d", ["a < b and c > d"]),
    ("<table><tr><td>1<td>2<tr><td>3</table>", ["1", "2", "3"]),
    ("<p>unclosed <b>x<br><p>next", ["unclosed x", "next"]), ("<div class=\"a>b\">x</div>", ["x"]),
    ("<P>UP</P><SCRIPT>no</SCRIPT>", ["UP"]), ("<script>never closed <p>x", []), ("<!-- never closed <p>x", []),
    ("<span class=advert>ad</span>text", ["text"]), ("<div role=navigation>n</div>x", ["x"]),
    ("<article><p>a</p></article><article><p>b</p></article>", ["a", "b"]), ("&nbsp;x&nbsp;y&copy;", ["x y©"]),
    ("<div class=\"page-with-sidebar\"><p>a</p><div class=sidebar>s</div></div>", ["a"]),
    ("<div class=\"ad-free content\"><p>a</p></div><div class=ad-slot-2>ad</div>", ["a"]),
    ("<div class=\"search-results article\"><p>a</p></div>", ["a"]),
    ("<main><p>body</p><article><p>teaser</p></article></main>", ["body", "teaser"]),
    ("<main><article><p>a</p></article></main><article>other</article><p>x</p>", ["a", "other"]),
    ("<div class=sidebar><p>all there is</p><div class=ad>ad</div></div>", ["all there is"]),
    ("<div class=comments><p>all there is</p></div>", []), ("<form><label>q</label></form>", []),
    ("<form><main><p>a b c</p></main><nav>n</nav></form>", ["a b c"]),
    ("<article><div class=post-header><h1>T</h1></div><p>x</p><div class=article-comments>c</div></article>", ["T", "x"]),
]


@pytest.mark.parametrize("source, blocks", PAGES)
def test_blocks(source, blocks):
    page = Page(source)
    assert [page.blocks[i] for i in page.content()] == blocks


def test_tree_has_every_block_once():
    def leaves(node):
        return [x for c in node[1] for x in ([c] if isinstance(c, int) else leaves(c))]

    for source, _ in PAGES:
        page = Page(source)
        assert leaves(page.tree) == list(range(len(page.blocks)))
    deep = Page("<div>" * 3000 + "x" + "</div>" * 3000 + "<p>y</p>")
    assert deep.blocks == ["x", "y"] and sorted(leaves(deep.tree)) == [0, 1]
    json.dumps(deep.tree)


def best_match(a, b, same):
    """Simple tree matching, stated recursively."""
    if isinstance(a, int) or isinstance(b, int):
        return (EQUAL if same(a, b) else 1) if isinstance(a, int) and isinstance(b, int) else 0
    if a[0] != b[0]:
        return 0

    def along(i, j):
        if not i or not j:
            return 0
        one = best_match(a[1][i - 1], b[1][j - 1], same)
        return max(along(i - 1, j), along(i, j - 1), along(i - 1, j - 1) + one)

    return 1 + along(len(a[1]), len(b[1]))


def test_alignment_is_the_best():
    left = Page("<div><p>a</p><p>b</p></div><p>same</p><ul><li>1</li></ul>")
    right = Page("<p>new</p><div><p>x</p><p>a</p></div><ul><li>1</li><li>2</li></ul><p>same</p>")
    found = Alignment(left.tree, right.tree, left.blocks, right.blocks)
    score = best_match(left.tree, right.tree, lambda i, j: left.blocks[i] == right.blocks[j])
    assert found._score(left.tree, right.tree) == score
    texts = [(left.blocks[i], right.blocks[j]) for i, j in found.pairs]
    assert ("a", "a") in texts and ("1", "1") in texts


def test_equal_blocks_of_long_lists_are_matched(monkeypatch):
    monkeypatch.setattr("tidemark.llm.html_text.CELLS", 20)
    left = Page("".join(f"<p>l{i}</p>" for i in range(8)) + "<p>foot</p>")
    right = Page("<p>r0</p><p>l3</p><p>r1</p><p>l6</p><p>l5</p><p>foot</p>")
    pairs = Alignment(left.tree, right.tree, left.blocks, right.blocks).pairs
    same = {left.blocks[i] for i, j in pairs if left.blocks[i] == right.blocks[j]}
    assert {"l3", "foot"} <= same and len(pairs) == len(set(pairs))
    assert pairs == sorted(pairs)


def test_size_does_not_change_an_alignment(monkeypatch):
    closing = "<div><p>Kept by us</p><p>{}</p></div>"
    left, right = (
        Page("".join(f"<p>{name} {i}</p>" for i in range(n)) + closing.format(name)) for name, n in (("l", 300), ("r", 350))
    )
    long = Alignment(left.tree, right.tree, left.blocks, right.blocks).pairs
    assert ("Kept by us", "Kept by us") in [(left.blocks[i], right.blocks[j]) for i, j in long]
    monkeypatch.setattr("tidemark.llm.html_text.CELLS", 10**9)
    assert Alignment(left.tree, right.tree, left.blocks, right.blocks).pairs == long


def site(i, host="a.example"):
    varied = "".join(f"<p>text {i} {k}</p>" for k in range(i % 4 + 1))
    return (i, f"http://{host}/{i}", f"<div><p>Welcome to our site</p>{varied}<p>All rights kept by us</p></div>")


def test_what_all_pages_say_is_template(frame):
    rows = [site(i) for i in range(12)] + [site(100, "b.example"), (200, None, site(0)[2]), (201, "odd", None)]
    pages = frame(rows, "page_id long, url string, html string")
    got = {r.page_id: r.text for r in extract_text(pages.repartition(4)).collect()}
    for i in range(12):
        assert got[i] == "\n".join(f"text {i} {k}" for k in range(i % 4 + 1))
    assert got[100].startswith("Welcome") and got[200].startswith("Welcome") and got[201] == ""


def test_copies_alone_are_no_template(frame):
    rows = [(i, "http://a/x", "<p>the same article</p>") for i in range(50)]
    got = extract_text(frame(rows, "page_id long, url string, html string")).collect()
    assert {r.text for r in got} == {"the same article"} and len(got) == 50


def test_copies_in_many_partitions_are_no_template(frame):
    rows = [(i, "http://a/x", "<p>the same article</p>") for i in range(64)] + [(99, "http://a/y", "<p>another</p>")]
    pages = frame(rows, "page_id long, url string, html string").repartition(8)
    assert {r.text for r in extract_text(pages).collect()} == {"the same article", "another"}


@pytest.mark.parametrize("parts", [1, 3])
@pytest.mark.parametrize("first", [True, False])
def test_an_odd_page_changes_no_template(frame, first, parts):
    odd = (99, "http://a.example/odd", "<ul><li>not found</li></ul><p>try again</p>")
    rows = [odd, *map(site, range(9))] if first else [*map(site, range(9)), odd]
    pages = frame(rows, "page_id long, url string, html string").repartition(parts) if parts > 1 else frame(
        rows, "page_id long, url string, html string"
    ).coalesce(1)
    got = {r.page_id: r.text for r in extract_text(pages).collect()}
    assert got.pop(99) == "not found\ntry again"
    assert got == {i: "\n".join(f"text {i} {k}" for k in range(i % 4 + 1)) for i in range(9)}


def plain_site(i):
    """A page without a telling element or class."""
    head = f"<div class=x1><div>Daily News</div><ul><li>Home</li><li>Contact</li>{'<li>Sale</li>' if i % 5 == 0 else ''}</ul></div>"
    text = "".join(f"<p>part {k} of story {i}</p>" for k in range(i % 3 + 1))
    return (i, f"http://plain.example/{i}", f"{head}<div class=x2>{text}</div><div class=x3><p>Kept by us</p><p>Call 555</p></div>")


def by_counting(pages, least=5, constant=0.8):
    """Main texts of one host's pages without marks: blocks at paths that nearly all pages have are left out."""
    def paths(node, path=""):
        return [x for c in node[1] for x in ([(path, c)] if isinstance(c, int) else paths(c, f"{path}/{c[0]}"))]

    read = [[(path, page.blocks[i]) for path, i in paths(page.tree)] for page in map(Page, pages)]
    n = {}
    for one in {tuple(r) for r in read}:
        for key in set(one):
            n[key] = n.get(key, 0) + 1
    different = len({tuple(r) for r in read})
    return ["\n".join(t for p, t in r if different < least or n[p, t] < constant * different) for r in read]


@pytest.mark.parametrize("merged", [256, 2])
def test_no_telling_name(frame, merged, monkeypatch):
    monkeypatch.setattr("tidemark.llm.html_text.MERGED", merged)
    rows = [plain_site(i) for i in range(20)]
    got = {r.page_id: r.text for r in extract_text(frame(rows, "page_id long, url string, html string").repartition(4)).collect()}
    for i in range(20):
        story = [f"part {k} of story {i}" for k in range(i % 3 + 1)]
        assert got[i].split("\n") == (["Sale"] if i % 5 == 0 else []) + story
    assert [got[i] for i in range(20)] == by_counting([html for _, _, html in rows])


@settings(max_examples=25, deadline=None)
@given(st.lists(st.lists(st.tuples(st.sampled_from(["p", "div", "li"]), st.sampled_from("abcdef")), max_size=6), min_size=1, max_size=9))
def test_template_is_what_counting_finds(pages):
    """Simple tree matching and counting agree where no text repeats in a page."""
    sources = []
    for i, blocks in enumerate(pages):
        once = sorted({text: tag for tag, text in blocks}.items())
        sources.append("".join(f"<{tag}>{text}</{tag}>" for text, tag in [*once, (f"own {i}", "p")]))
    whole = None
    for source in sources:
        page = Page(source)
        one = Reference(page.tree, [mark_of(b) for b in page.blocks])
        if whole is None:
            whole = one
        else:
            whole.add(one)
    found = whole.template(5, 0.8)
    template = tuple(json.loads(found)) if found else None
    assert [main_text(s, template) for s in sources] == by_counting(sources)


def test_copies_with_other_adverts_are_no_template(frame):
    rows = [(i, "http://a/x", f"<article><p>the same article</p></article><div class=ad>buy {i}</div>") for i in range(30)]
    got = extract_text(frame(rows, "page_id long, url string, html string")).collect()
    assert {r.text for r in got} == {"the same article"} and len(got) == 30


def test_own_names_may_be_taken(frame):
    names = "page_id long, url string, html string, _tm_html string, _tm_host string, _tm_template string, host string"
    rows = [(i, f"http://a/{i}", f"<p>x{i}</p><p>kept</p>", "h", "o", "t", "a") for i in range(9)]
    got = extract_text(frame(rows, names)).collect()
    assert {(r.page_id, r.text, r._tm_html, r._tm_host, r._tm_template, r.host) for r in got} == {
        (i, f"x{i}", "h", "o", "t", "a") for i in range(9)
    }


def test_references_merge_in_any_order():
    pages = [Page(site(i)[2]) for i in range(9)]
    singles = [lambda p=p: Reference(p.tree, [mark_of(b) for b in p.blocks]) for p in pages]
    whole = singles[0]()
    for s in singles[1:]:
        whole.add(s())
    left, right = singles[0](), singles[4]()
    for s in singles[1:4]:
        left.add(s())
    for s in singles[5:]:
        right.add(s())
    left.add(Reference.load(right.dump()))
    assert left.pages == whole.pages == 9
    assert json.loads(left.template(5, 0.8))[1] == json.loads(whole.template(5, 0.8))[1]
    assert singles[0]().template(5, 0.8) is None


def test_hosts(frame):
    urls = ["http://A.b/c", "https://u:p@x.y:80/z", "//q", None, "mailto:x", "HTTP://Z"]
    df = frame([(u,) for u in urls], "url string")
    assert [r[0] for r in df.select(host_of(df["url"])).collect()] == ["a.b", "x.y", "", "", "", "z"]


def test_rows_of_a_query(spark, small, frame):
    pages = {r.page_id: r for r in spark.read.parquet(f"{small}/pages.parquet").collect()}
    rows = op9_html_text(spark, small).collect()
    assert len(rows) == len(pages)
    for r in rows:
        assert r.n_chars == len(r.text) and r.url == pages[r.page_id].url
        assert r.text and "<" not in r.text[:1]
    clash = frame([(1, "http://a/", "<p>x</p>", "mine")], "page_id long, url string, html string, text string")
    assert [r.text for r in extract_text(clash).collect()] == ["x"]
    assert extract_text(clash.limit(0)).count() == 0
