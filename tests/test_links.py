from emporia.plans import links


def test_link_rules(spark):
    p1 = (
        '<ul><li><a target="_blank" title=" Policy A " href="/info/1.htm">x</a></li>'
        '<li><a title="no target" href="/x">x</a></li>'
        '<li><a target="_blank" title="B &amp; C" href="info/2.htm">x</a></li>'
        '<li><a target="_blank" title="Ext" href="https://other.org/p">x</a></li></ul>'
    )
    p2 = '<li> <a target="_blank" title="Again" href="/info/1.htm">x</a></li>'
    pages = spark.createDataFrame([(1, "https://a.example/list.htm", p1), (2, "https://a.example/2", p2)],
                                  "page_id long, url string, html string")
    got = {r.href: (r.title, r.page_id) for r in links.page_links(pages, base="https://site.example").collect()}
    assert got == {
        "https://site.example/info/1.htm": ("Policy A", 1),
        "https://site.example/info/2.htm": ("B & C", 1),
        "https://other.org/p": ("Ext", 1),
    }
    loose = links.page_links(pages, require_blank_target=False, require_title=False)
    assert {r.href for r in loose.collect()} >= {"https://a.example/x", "https://a.example/info/1.htm"}


def test_links_behind_other_elements_and_odd_attributes(spark):
    page = (
        "<link rel='x'><ul>"
        '<li><span>new <a href="/nested">n</a></span><a target="_blank" title="After span" href="/a">x</a></li>'
        "<LI class='c'><A TARGET='_blank' Title='Single > quotes' HREF='/b'>x</A></LI>"
        '<li><a target="_blank" title="Data" data-href="/wrong" href="/right">x</a></li>'
        '<li><a href="/first">x</a><a target="_blank" title="Second" href="/second">y</a>'
        '<li><a target=_blank title=Bare href=/bare>z</a></li></ul>'
    )
    pages = spark.createDataFrame([(1, "https://s.example/", page)], "page_id long, url string, html string")
    got = {(r.pos, r.href, r.title) for r in links.extract_links(pages).collect()}
    assert got == {
        (0, "https://s.example/a", "After span"),
        (1, "https://s.example/b", "Single > quotes"),
        (2, "https://s.example/right", "Data"),
        (3, "https://s.example/first", "Second"),
        (4, "https://s.example/bare", "Bare"),
    }


def own_links(spark, html):
    pages = spark.createDataFrame([(1, "https://s.example/", html)], "page_id long, url string, html string")
    return [(r.pos, r.href, r.title) for r in links.extract_links(pages, require_blank_target=False, require_title=False).orderBy("pos").collect()]


def test_only_anchors_directly_in_the_item_count(spark):
    nested = "<ul><li><div><div>x</div><a href='/in'>no</a></div><a href='/own'>yes</a></li></ul>"
    assert own_links(spark, nested) == [(0, "https://s.example/own", "yes")]
    comment = "<li><!-- <a href='/old'>no</a> --><a href='/new'>yes</a></li>"
    assert own_links(spark, comment) == [(0, "https://s.example/new", "yes")]
    inner_list = "<ul><li><ul><li><a href='/inner'>i</a></li></ul><a href='/outer'>o</a></li></ul>"
    assert own_links(spark, inner_list) == [(0, "https://s.example/outer", "o"), (1, "https://s.example/inner", "i")]


def test_scripts_paragraphs_and_open_ends(spark):
    assert own_links(spark, "<li><script>'<a href=\"/js\">'</script><style><a href='/css'></style><a href='/x'>x<b>y</b></a></li>") == [(0, "https://s.example/x", "xy")]
    # A paragraph ends at a block, so the anchor behind that stands in the item.
    assert own_links(spark, "<li><p>text<div>d</div><a href='/x'>x</a>") == [(0, "https://s.example/x", "x")]
    assert own_links(spark, "<li><br><img src=x><input/><a href='/x'>x<li><a href='/y'>y") == [(0, "https://s.example/x", "x"), (1, "https://s.example/y", "y")]
    assert own_links(spark, "<a href='/x'>no item</a></li><li>no anchor</li><li><a title='t'>no href</a>") == []
    assert own_links(spark, "<li><a href='/x'>x</a><a href=\"/never closed") == [(0, "https://s.example/x", "x")]


def test_a_scan_takes_time_in_proportion(spark):
    import time

    t0 = time.monotonic()
    for piece in ("<li><a href='", "<!-- ", "<script>", "<li><div><a href=x>", "<a \"", "</div>", "<b></i>"):
        links.list_items(piece * 40_000)
    assert time.monotonic() - t0 < 20


def test_null_and_empty_pages(spark):
    assert own_links(spark, None) == [] and own_links(spark, "") == []
