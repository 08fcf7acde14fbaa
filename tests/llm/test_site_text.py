"""Site templates on hosts of any size, wrappers around the main part, and text beside articles."""

from beatgrid.llm import template_html


def texts(spark, rows):
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    return {r["page_id"]: r["text"] for r in template_html.op3_site_text(pages).collect()}


def test_adverts_on_few_percent_of_a_large_host_go(spark):
    def page(i):
        advert = f"<div class=k{i % 2}>Buy <b>our</b> lamps</div>" if i % 50 == 0 else ""
        once = "<div class=k7>Only on four pages</div>" if i < 4 else ""
        return f"<body>{advert}{once}<article><p>Text {i}</p></article>{advert}</body>"

    rows = [(i, f"http://large.example/{i}", page(i)) for i in range(600)] + [(1000 + i, f"http://small.example/{i}", page(50 * i)) for i in range(12)]
    found = texts(spark, rows)
    assert all("lamps" not in t for t in found.values()) and found[50] == "Text 50" and found[1001] == "Text 50"
    assert template_html.site_templates(spark.createDataFrame(rows, "page_id long, url string, html string")).count() == 24


def plain_text(page):
    return template_html.main_text(page, frozenset())


def test_wrappers_around_the_main_part_stay():
    part = "<article><h1>Title</h1><p>Body</p></article>"
    for page in (
        f"<body><div class='layout with-sidebar'>{part}<div class=sidebar>side</div></div></body>",
        f"<body><div id=search-page><main>{part}</main></div></body>",
        f"<body><form id=aspnetForm><nav>menu</nav>{part}<form>ask</form></form></body>",
        f"<body><div role=search><label>{part}</label></div></body>",
        f"<body><div class=nav-open><div class=search><div role=main>{part}</div></div></div></body>",
    ):
        assert "Title\nBody" in plain_text(page), page
        assert not {"side", "menu"} & set(plain_text(page).split()), page


def test_listed_elements_without_a_main_part_go():
    part = "<article><p>Body</p></article>"
    for gone in ("<div class=comments><article class=comment>hi</article></div>", "<aside class=related><article>card</article></aside>",
                 "<div class=menu><nav><article>card</article></nav></div>", "<div style='display:none'><article>card</article></div>", "<form>ask</form>"):
        assert plain_text(f"<body>{part}{gone}</body>") == "Body", gone


def test_text_beside_articles_stays():
    assert plain_text("<main><h1>Title</h1><p>Lead</p><article>body</article></main>") == "Title\nLead\nbody"
    cards = "<article class=card>one</article><article class=card>two</article>"
    assert plain_text(f"<body><main><p>The text</p></main>{cards}</body>") == "The text\none\ntwo"
    assert plain_text(f"<body><div><p>The text</p></div>{cards}<footer>f</footer></body>") == "The text\none\ntwo"
    assert plain_text("<body><p>left out</p><main><article>body</article></main></body>") == "body"
    assert plain_text("<body><p>all there is</p><main></main></body>") == "all there is"
