"""Main text of pages: parsing, templates, odd input."""

import random
from html.parser import HTMLParser

from seqprep.llm import html_template, queries
from seqprep.sources.package import ship_package


def prose(rng, words=20):
    return " ".join(rng.choice(["alpha", "beta", "gamma", "delta", "rho", "tau"]) + str(rng.randint(0, 99)) for _ in range(words))


def run(spark, rows):
    ship_package(spark)
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)
    pages = pages.selectExpr("*", "'x' AS host", "1 AS part", "2 AS parts", "3 AS text", "4 AS n_chars")
    return html_template.extract_main_text(pages).collect()


def alone(source):
    return html_template.main_text(html_template.parse(source), set())


def test_article_without_its_surroundings():
    source = """<!DOCTYPE html><html class="no-comments menu"><head><title>t</title><style>p{}</style><script>var t="</p>";</script></head>
    <body class="has-sidebar"><header><h1>Site</h1></header><nav><ul><li><a href=/x>x</a></ul></nav><!-- ad <p>no</p> -->
    <div class="ad">buy</div><div id=cookie-notice>cookies</div><main><article class=post><header><h1>The &quot;Title&quot;</h1></header>
    <p><b>One&nbsp;two.<br><p>Three <a href="x">linked</a>
    four &amp; five &#x41;<ul><li>item<li>other</ul><aside>box</aside><form><input value=1><p>mail</form>
    <section class="comments"><p>first!</section></article></main><div role="complementary">side</div>
    <footer><p>&copy; site</p></footer></body></html>"""
    assert alone(source) == 'The "Title"\nOne two.\nThree linked four & five A\nitem\nother'


def test_cut_off_and_broken_markup():
    assert alone("<article><p>one</div></b></article></p><p>two") == "one"
    assert alone("<article><p>one<p>tw") == "one\ntw"
    assert alone("<article><p>one</p><p cla") == "one"
    assert alone("<article><p>a < b and c > d</p>") == "a < b and c > d"
    assert alone('<article><p title="a > b">x</p><img alt="unclosed><p>y</p>').startswith("x")
    assert alone("<article><p>x</p><script>never closed <p>no</p>") == "x"
    assert alone("<article><p>x<!-- never closed") == "x"
    assert alone("plain &lt;text&gt;\n\n here") == "plain <text> here"
    assert alone("") == alone("<p></p>") == alone("<script>x</script>") == ""
    assert alone("<div>" * 3000 + "deep") == "deep"


def test_all_articles_are_kept_but_teasers_made_of_links():
    rng = random.Random(1)
    long = prose(rng, 60)
    links = '<article><h2><a href="/x">more of this</a></h2></article>'
    assert alone(f"<main><article><p>first</article><article><p>{long}</article>{links}</main>") == f"first\n{long}"
    assert alone(f'<div class="post">one</div><div class="post">{long}</div>') == f"one\n{long}"


def test_names_do_not_cut_what_holds_the_text():
    long = prose(random.Random(3), 60)
    for element in ('article class="post comments-open"', 'article class="share-enabled"', 'div class="content has-sidebar"', "form", 'div id="widget"'):
        assert alone(f'<h1>T</h1><{element}><p>{long}</p><div class="ad">buy</div></{element.split()[0]}>').split("\n")[-1] == long, element
    assert alone(f'<form><div class="ad">buy</div><article><p>{long}</article><div class="comments">{long} {long}</div></form>') == long
    assert alone(f'<article><p>short</article><section class="comments"><article class="comment">{long}</article></section>') == "short"
    assert alone(f"<p>short</p><nav>{long}</nav><footer>{long}</footer>") == "short"


def test_text_beside_a_named_container_and_single_links_stay():
    assert alone('<p>Headline</p><div class="story-body"><p>Body</div><p>After</p>') == "Headline\nBody\nAfter"
    assert alone('<p>One</p><p><a href="/">a link</a></p><p>Two</p>') == "One\na link\nTwo"
    listed = "<ul>" + '<li><a href="/">item</a>' * 5 + "</ul>"
    assert alone(f"<p>One</p>{listed}<p>Two</p>") == "One\nTwo"
    assert alone("<html><head><title>t</title><body><p>no end of head</p>") == "no end of head"


def test_few_pages_share_whole_blocks_only(spark):
    """Seven, and two, pages of a host with one menu and notice that no element or class tells."""
    rng = random.Random(4)
    rows, truth = [], {}
    for number in range(9):
        body = [prose(rng, 30) for _ in range(2)]
        host = "seven" if number < 7 else "two"
        article = "".join(f"<p>{p}</p>" for p in body)
        rows.append((number, f"http://{host}.example/x", f"<div>Home News About</div>{article}<div>All rights kept</div>"))
        truth[number] = "\n".join(body)
    assert {r["page_id"]: r["text"] for r in run(spark, rows)} == truth


def test_near_copies_and_equal_articles_are_no_template(spark):
    rng = random.Random(5)
    shared = [prose(rng, 30) for _ in range(5)]
    bodies = [[*shared, f"changed {number}"] for number in range(3)]
    plain = [(n, "http://a.example/", "".join(f"<p>{p}</p>" for p in body)) for n, body in enumerate(bodies)]
    article = [(n + 3, "http://b.example/", f"<p>top {n}</p><article>" + "".join(f"<p>{p}</p>" for p in body) + "</article>") for n, body in enumerate(bodies)]
    found = {r["page_id"]: r["text"] for r in run(spark, plain + article)}
    assert found == {n: "\n".join(bodies[n % 3]) for n in range(6)}


def test_deeply_nested_names_end():
    assert alone('<div class="ad">' * 20_000 + "deep") == "deep"


def test_template_of_a_host_is_left_out(spark):
    """No element or class tells the surroundings; only their likeness on the pages does."""
    rng = random.Random(2)
    rows, truth = [], {}
    for number in range(30):
        article = [prose(rng, rng.randint(8, 40)) for _ in range(rng.randint(1, 4))]
        body = "".join(f"<p>{p}</p>" for p in article)
        rows.append((number, "http://h.example/x", f"<div><span>Welcome to our</span> site</div><div class=t1>{body}</div><div>All rights kept {'very ' * 70} long</div>"))
        truth[number] = "\n".join(article)
    found = {r["page_id"]: r for r in run(spark, rows)}
    assert {i: r["text"] for i, r in found.items()} == truth
    assert all(r["n_chars"] == len(r["text"]) for r in found.values())


def test_copies_of_a_page_do_not_make_a_template(spark):
    rows = [(i, "http://h.example/x", f"<p>the same text</p><!-- {i} -->") for i in range(40)]
    assert {r["text"] for r in run(spark, rows)} == {"the same text"}


def test_classes_are_ordered_and_nested():
    a, b, c, d, x = ((1, name) for name in "abcdx")
    pages = [[a, x, b], [a, b, x], [a, x, x, b]]
    assert html_template.equivalence_classes(pages) == [[a, b]]
    assert html_template.equivalence_classes([[a, b], [b, a]]) == []
    crossing = [[a, c, b, d], [a, c, b, d]]
    assert html_template.equivalence_classes(crossing) == [[a, c, b, d]]


def test_odd_rows(spark):
    rows = [(1, None, None), (2, "", ""), (None, "nonsense", "<p>x"), (4, "http://é/", "<article>é</article>"), (4, "http://é/", "<article>é</article>"), (5, "http://A.b", "<p>" + "word " * 50_000)]
    found = sorted((tuple(r) for r in run(spark, rows)), key=str)
    long = ("word " * 50_000).strip()
    assert found == sorted([(1, None, "", 0), (2, "", "", 0), (None, "nonsense", "x", 1), (4, "http://é/", "é", 1), (4, "http://é/", "é", 1), (5, "http://A.b", long, len(long))], key=str)
    assert run(spark, []) == []


class ArticleText(HTMLParser):
    """Blocks inside article elements by the standard parser, for pages that have one and nothing odd in it."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.inside, self.blocks = 0, [""]

    def handle_starttag(self, tag, attrs):
        self.inside += tag == "article"
        self._edge(tag)

    def handle_endtag(self, tag):
        self._edge(tag)
        self.inside -= tag == "article"

    def _edge(self, tag):
        if tag == "br":
            self.blocks[-1] += " "
        elif tag not in ("b", "a", "i", "span"):
            self.blocks.append("")

    def handle_data(self, data):
        if self.inside:
            self.blocks[-1] += data


def test_query_equals_a_plain_parser_on_the_given_pages(spark):
    folder = "/root/testdata/sf0.01"
    pages = spark.read.parquet(f"{folder}/pages.parquet").collect()
    truth = {}
    for page in pages:
        parser = ArticleText()
        parser.feed(page["html"] or "")
        parser.close()
        truth[page["page_id"]] = "\n".join(" ".join(b.split()) for b in parser.blocks if b.split())
    found = queries.REGISTRY["op2_main_text"](spark, folder).collect()
    assert {r["page_id"]: r["text"] for r in found} == truth
    assert len(found) == len(pages) and all(r["n_chars"] == len(r["text"]) for r in found)
