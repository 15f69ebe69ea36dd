from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from loglens.llm import pages

ITEMS = st.lists(st.integers(0, 4), max_size=9)


@given(ITEMS, ITEMS)
def test_shared_is_a_longest_common_subsequence(a, b):
    table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            table[i + 1][j + 1] = table[i][j] + 1 if x == y else max(table[i][j + 1], table[i + 1][j])
    found = [x for x, keep in zip(a, pages.shared(a, b)) if keep]
    rest = iter(b)
    assert len(found) == table[-1][-1] and all(x in rest for x in found)


def page(body, own=""):
    return f"<html><head><title>T</title><style>p{{}}</style></head><body><ul class='menu'><li>Home</li></ul>{body}{own}</body></html>"


SCHEMA = "page_id long, url string, html string"


def text_of(spark, rows):
    return {r["page_id"]: r["text"] for r in pages.extract(spark.createDataFrame(rows, SCHEMA)).collect()}


def test_template_lines_without_markup_go(spark):
    def shop(i):
        return f"<div>Welcome to the shop</div><div>Thing {i} is fine.</div><div>Call us today</div>"
    got = text_of(spark, [(i, f"http://h.example/{i:03}", page(shop(i))) for i in range(40)])
    assert got == {i: f"Thing {i} is fine." for i in range(40)}


def test_other_hosts_are_no_witness(spark):
    got = text_of(spark, [(1, "http://a.example/x", "<div>same</div><div>one</div>"), (2, "http://b.example/x", "<div>same</div><div>two</div>")])
    assert got == {1: "same\none", 2: "same\ntwo"}


def test_articles_keep_shared_passages_and_copies_stay(spark):
    art = "<article><h1>Head</h1><p>Quoted by all.<p>Own {}</article><aside>Side</aside>"
    rows = [(i, f"http://h.example/{i}", page(art.format(i // 2))) for i in range(6)]
    assert text_of(spark, rows) == {i: f"Head\nQuoted by all.\nOwn {i // 2}" for i in range(6)}
    copies = [(i, "http://h.example/c", "<div>All the same</div>") for i in range(3)]
    assert set(text_of(spark, copies).values()) == {"All the same"}


def test_template_lines_inside_main_go(spark):
    shop = "<div>Welcome to the shop</div><div>Thing {} is fine.</div><div>Call us today</div>"
    for around in ("<main>{}</main>", "<div id=main>{}</div>"):
        got = text_of(spark, [(i, f"http://h.example/{i:03}", page(around.format(shop.format(i)))) for i in range(40)])
        assert got == {i: f"Thing {i} is fine." for i in range(40)}


def test_copies_of_one_url_get_the_same_text(spark):
    shop = "<div>Welcome to the shop</div><div>Thing {} is fine.</div><div>Call us today</div>"
    rows = [(i, f"http://h.example/{i // 20:03}?ref={i % 20}", page(shop.format(i // 20))) for i in range(100)]
    assert text_of(spark, rows) == {i: f"Thing {i // 20} is fine." for i in range(100)}


def test_neighbours_reach_over_blocks(spark, monkeypatch):
    monkeypatch.setattr(pages, "BLOCK", 3)
    rows = spark.createDataFrame([("h", f"/{i:03}", i, [i]) for i in range(30)], "host string, path string, content long, items array<long>")
    got = {r["content"]: sorted(x[0] for x in r["others"] if x is not None) for r in pages.neighbours(rows).collect()}
    assert got == {i: [k for k in range(i - pages.SIDE, i + pages.SIDE + 1) if k != i and 0 <= k < 30] for i in range(30)}


def test_zones_of_shared_lines():
    def items(zone, *lines):
        return [4 * x | zone for x in lines]
    a = pages.ARTICLE
    others = [items(a, 1, 2, 10 + i, 20 + i) for i in range(4)]
    assert pages.deleted(items(a, 1, 2, 3, 4), others) == [True, True, False, False]
    assert not any(pages.deleted(items(a, 1, 2, 3, 4), others[:2]))                             # too few
    assert not any(pages.deleted(items(a, 1, 2, 3, 4), others[:3] + [items(a, 8, 9)]))          # one lacks them
    assert not any(pages.deleted(items(a, 1, 2, 3, 4), [items(a, 1, 2, 3, 10 + i) for i in range(4)]))      # versions
    assert pages.deleted(items(pages.MAIN, 1, 2), [items(pages.MAIN, 1, 10 + i) for i in range(2)]) == [True, False]
    assert not any(pages.deleted(items(pages.MAIN, 1, 2), [items(pages.MAIN, 1, 2)] * 4))       # copies


def test_markup():
    html = ("<!doctype html><head><title>no</title></head><body><header>top</header><nav><a href='/'>x</a></nav><!-- <p>no</p> --><div class=\"ad\">buy</div>"
            "<main><h1>A &amp; B</h1><p>one <b>two</b>\n three<br>four &lt;tag&gt; &copy;<p title='a > b'>five<ul><li>six<li>seven</ul><div class='comments'><p>spam</p></div>"
            "<form><input><p>sign up</p></form><script>var t='</p>';</script><style>x</style></main><footer>end</footer>")
    kept = [t for t, z in pages.lines(html) if z == pages.MAIN]
    assert kept == ["A & B", "one two three four <tag> ©", "five", "six", "seven"]
    assert [t for t, z in pages.lines("<p>a < b and <b>c")] == ["a < b and c"]
    assert pages.lines("") == [] and pages.lines("<script>never closed") == []


def test_odd_rows(spark):
    rows = [(1, None, None), (1, None, None), (None, "http://h.example/a", "<p>x</p>"), (2, "not a url", ""), (3, "http://h.example/b", "<p>" + "long " * 100_000), (4, "http://h.example/b", "<p>y</p>" * 3000)]
    df = spark.createDataFrame(rows, SCHEMA).withColumns({c: F.lit(0) for c in ("text", "page", "items", "host", "path", "index")})
    got = pages.extract(df).collect()
    assert len(got) == 6 and sorted(len(r["text"]) for r in got) == sorted([0, 0, 1, 0, 499_999, 5999])
    assert pages.extract(df.limit(0)).count() == 0


def test_query(spark, sf_dir):
    rows = pages.query(spark, sf_dir).collect()
    assert len(rows) == spark.read.parquet(f"{sf_dir}/pages.parquet").count() and all(r["n_chars"] == len(r["text"]) for r in rows)
