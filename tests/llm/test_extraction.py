from pyspark.sql import functions as F

from orrery.llm import extraction

ARTICLE = "<html><head><title>T</title><style>p{}</style><script>var t='</p>';</script></head><body><nav><ul><li><a href='/x'>menu</a></li></ul></nav><!-- ad --><div class='ad'>buy</div><article><h1>Head &amp; line</h1><p><b>First  para<br>with\n break<p>Second &lt;x&gt; &eacute;&#233;</p><ul><li>one<li>two</ul><form>field</form><aside>side</aside><div class='comments'><p>reader</p></div></article><footer>&copy; host</footer></body></html>"


def texts(html):
    return "\n".join(t for t, _ in extraction.Page(html).blocks)


def test_article_without_its_surroundings():
    assert texts(ARTICLE) == "Head & line\nFirst para with break\nSecond <x> éé\none\ntwo"


def test_cut_off_and_broken_pages():
    assert texts(ARTICLE[: ARTICLE.index("with\n")]) == "Head & line\nFirst para"
    assert texts("<article><p>open <b>never closed") == "open never closed"
    assert texts("<article><p>a</p><p cla") == "a"
    assert texts("</div></p>loose < text & more</article>") == "loose < text & more"
    assert texts("") == "" and texts("<script>x") == "" and texts("<p>&am &amp") == "&am &"


def test_main_and_body_serve_where_there_is_no_article():
    assert texts("<body><header>h</header><main><header>own</header><p>m</p></main><p>rest</p></body>") == "own\nm"
    assert texts("<body><div role='navigation'>n</div><p>rest</p><div id='cookie-notice'>c</div></body>") == "rest"
    assert texts("<body><div role=main><p>m</p></div><p>rest</p></body>") == "m"


def page(k, body, host="h.example"):
    return (k, f"https://{host}/{k}", body)


def run(spark, rows):
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("text", F.lit(1)).withColumn("host", F.lit(2))
    return {r.page_id: r.text for r in extraction.main_texts(df).collect()}


def test_unmarked_template_is_found_by_its_recurrence(spark):
    shell = "<div><div><p>Welcome to the site</p></div><section><p>{}</p></section><div>Imprint <span>2020</span></div></div>"
    rows = [page(k, shell.format(f"story number {k}")) for k in range(12)] + [page(50, shell.format("elsewhere"), "other.example")]
    got = run(spark, rows)
    assert got[3] == "story number 3" and got[50] == "Welcome to the site\nelsewhere\nImprint 2020"


def test_shared_paragraphs_and_copies_of_an_article_stay(spark):
    art = "<nav>m</nav><article><h1>Title</h1><p>story {}</p><p>Licensed under the usual terms</p><div>Share this</div></article>"
    rows = [page(k, art.format(k)) for k in range(10)] + [page(100 + k, art.format("copy"), "copies.example") for k in range(10)]
    got = run(spark, rows)
    assert got[4] == "Title\nstory 4\nLicensed under the usual terms"
    assert got[103] == "Title\nstory copy\nLicensed under the usual terms\nShare this"


def test_null_empty_and_repeated_rows(spark):
    rows = [(1, None, "<p>x</p>"), (2, "u", None), (None, "http://a/b", "<p>y</p>"), (3, "http://a/b", ""), (3, "http://a/b", "")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = sorted((str(r.page_id), r.text) for r in extraction.main_texts(df).collect())
    assert got == [("1", "x"), ("2", ""), ("3", ""), ("3", ""), ("None", "y")]
    assert extraction.main_texts(df.where("false")).count() == 0


def test_deep_and_long_pages_are_read_whole():
    deep = "<div>" * 3000 + "<p>bottom</p>" + "</div>" * 3000
    assert texts(deep) == "bottom"
    many = "<article>" + "".join(f"<p>para {k}" for k in range(20_000)) + "</article>"
    assert len(extraction.Page(many).blocks) == 20_000


def test_text_outside_an_article_stays_unless_it_recurs(spark):
    cards = "<div><article><h3>Latest</h3><p>teaser of the week</p></article><article><p>another card</p></article></div>"
    in_main = "<div><div>Home</div><div>News</div></div><main><p>the long story of day {0}</p></main>" + cards
    in_divs = "<div><div>Home</div><div>News</div></div><div><div>the long story of day {0}</div></div>" + cards
    around = "<div><div>Home</div><div>Prices</div></div><article><p>story {0}</p></article><div>what happened after story {0}</div><div>Imprint</div>"
    nested = "<main><p>intro of page {0} with all that it says</p>" + cards + "</main>"
    rows = [page(1000 * h + k, shell.format(k), f"h{h}.example") for h, shell in enumerate((in_main, in_divs, around, nested)) for k in range(10)]
    got = run(spark, rows)
    assert got[3] == "the long story of day 3"
    assert got[1003] == "the long story of day 3"
    assert got[2003] == "story 3\nwhat happened after story 3"
    assert got[3003] == "intro of page 3 with all that it says"


def test_an_article_stays_on_its_own_page(spark):
    story = "<article><p>the whole story, which a number of other pages show as well</p></article>"
    lists = [page(k, f"<main><p>list {k}: {'a long introduction ' * 9}</p>{story}</main>") for k in range(9)]
    got = run(spark, [*lists, page(50, f"<main>{story}</main>")])
    assert got[50].startswith("the whole story") and got[3].endswith("introduction")


def test_sections_of_a_large_host_lose_their_templates(spark):
    shell = "<div><div>Menu of section {0}</div><div>Notice of section {0}</div></div><div><div>story {1}</div></div>"
    rows = [page(k, shell.format(k // 30, k)) for k in range(3000)]  # a section is 1 % of the host
    rows += [page(5000 + k, shell.format(0, k), "small.example") for k in range(30)]
    got = run(spark, rows)
    assert {k: got[k] for k in range(3000)} == {k: f"story {k}" for k in range(3000)}
    assert got[5003] == "story 3"
