import re

import pytest
from pyspark.sql import functions as F

from conftest import SF001, SF01
from helpers import frame
from nextclick.llm import web_text

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{{}}</style></head><body class="has-sidebar"><header><h1>Site</h1></header>
<div id="nav{n}" class="menu"><a href=x>home</a></div><div class="notice">We use cookies</div><div class="page"><div class="post-{n} content"><h1>Head &amp; more {n}</h1>
<p>One  two<br>three <b>bold</b> x&nbsp;y {n}<p>Para2 <i>it</i>alic &lt;tag&gt;<ul><li>a<li>b</ul><div class="byline">By the staff</div>
<div class="comments"><p>nice!</p></div><form><input><p>sub</p></form><script>var x="<p>no</p>"</script></div><aside>side</aside></div><footer>&copy; f</footer>{end}"""


@pytest.mark.parametrize("end", ["</body></html>", ""])
def test_page_alone(end):
    got = web_text.main_text(PAGE.format(n=1, end=end), None, frozenset())
    assert got == "Head & more 1\n\nOne two three bold x y 1\n\nPara2 italic <tag>\n\na\n\nb\n\nBy the staff"


@pytest.mark.parametrize("page, text", [
    ("", ""), ("plain &lt; text", "plain < text"), ("<p>a<p>b <script>x", "a\n\nb"), ("<!-- x --><article><p>a</article><div class=ad>ad</div>", "a"),
    ("<body><article><h1>T</h1><p><b>x<br><p>y</p></article><footer>z", "T\n\nx\n\ny"), ("<p title='a>b'>c</p>", "c"), ("<div>a</span>b</i></div>c", "ab\n\nc"),
    ("<nav><p>only menu</p></nav>", "")])
def test_small_pages(page, text):
    assert web_text.main_text(page, None, frozenset()) == text


def test_template_of_a_host(spark):
    rows = [(i, f"https://h.example/{i}", PAGE.format(n=i, end=""), "z") for i in range(12)]
    rows += [(50, "https://other.example/", PAGE.format(n=50, end=""), "z"), (51, None, None, "z"), (52, "not a url", "", "z"), (0, "https://h.example/0", PAGE.format(n=0, end=""), "z")]
    out = web_text.extract(frame(spark, rows, "page_id long, url string, html string, text string")).collect()
    assert len(out) == len(rows)
    by = {r.page_id: r for r in out}
    assert by[3].text == "Head & more 3\n\nOne two three bold x y 3\n\nPara2 italic <tag>\n\na\n\nb"  # the byline is the template's
    assert by[50].text.endswith("By the staff")
    assert (by[51].text, by[52].text, by[51].n_chars) == ("", "", 0)
    assert web_text.extract(frame(spark, rows, "page_id long, url string, html string, text string").limit(0)).count() == 0


def test_templates_name_classes(spark):
    rows = [(i, f"https://h.example/{i}", PAGE.format(n=i, end=""), i) for i in range(12)]
    found = web_text.templates(frame(spark, rows, "page_id long, url string, html string, row_key long")).collect()
    assert len(found) == 1 and found[0].host == "h.example" and found[0].classes >= 1 and len(found[0].fixed) == 1


def test_table_articles(spark):
    """On the table's own layout the main text is the article's blocks."""
    import html
    out = {r.page_id: r.text for r in web_text.op1_html_main_text(spark, SF001).collect()}
    for r in spark.read.parquet(f"{SF001}/pages.parquet").collect():
        article = re.search(r"(?s)<article>(.*?)(?:</article>|$)", r.html)[1]
        blocks = [" ".join(html.unescape(re.sub(r"<(?!/?(?:p|h1)\b)[^>]*>", " ", b)).split()) for b in re.split(r"</?(?:p|h1)>", article)]
        assert out[r.page_id] == "\n\n".join(b for b in blocks if b)


def test_repeated_text_in_the_article_is_the_template(spark):
    """Sentences and unclassed lists that stand on every page are left out; an article that is copied often stays."""
    def page(i):
        story = "<p>Shared story.</p><p>Its end.</p>" if i % 5 < 3 else f"<p>Story {i}.</p><p>End {i}.</p>"
        return (f"<body><article><h1>Title {i}</h1><ul><li><a href=/>home</a><li>all news</ul><p>Read with care.</p>{story}"
                + ("<p>Write to us.</p></article></body>" if i != 7 else ""))

    rows = [(i, f"https://h.example/{i}", page(i)) for i in range(40)] + [(100, "https://few.example/", page(3))]
    out = {r.page_id: r.text for r in web_text.extract(frame(spark, rows, "page_id long, url string, html string")).collect()}
    for i in range(40):
        assert out[i] == f"Title {i}\n\n" + ("Shared story.\n\nIts end." if i % 5 < 3 else f"Story {i}.\n\nEnd {i}.")
    assert out[100] == "Title 3\n\nhome\n\nall news\n\nRead with care.\n\nStory 3.\n\nEnd 3.\n\nWrite to us."


STORY = "<h1>Head</h1><p>The first paragraph of the story.</p><p>The second paragraph of the story.</p>"
TOLD = "Head\n\nThe first paragraph of the story.\n\nThe second paragraph of the story."


@pytest.mark.parametrize("around", [
    "<div class='layout with-sidebar'>{}</div>", "<div class='post has-comments'>{}</div>", "<div class='social-news'>{}</div>", "<div role='search'>{}</div>",
    "<form id='aspnetForm' action=x>{}</form>", "<form><div class='layout no-sidebar'>{}<div class='sidebar'>Side text.</div></div></form>",
    "<div id='search'>{}</div>", "<div class='withSidebar'>{}</div><footer>foot</footer>"])
@pytest.mark.parametrize("inner", ["<article>{}</article>", "<article><div class='entry social-text'>{}</div></article>", "<main>{}</main>", "<div role=main>{}</div>", "<div class=text>{}</div>", "{}"])
def test_suspected_wrappers_keep_the_story(around, inner):
    page = "<html class='no-sidebar'><body><nav><a href=/>home</a></nav>" + around.format(inner.format(STORY) + "<div class='comments'><p>Nice.</p></div>")
    assert web_text.main_text(page, None, frozenset()) == TOLD


@pytest.mark.parametrize("page", [
    "<article>" + STORY + "</article><div class='related-posts'><article><p>" + "Another story. " * 20 + "</p></article></div>",
    "<div class=layout>" + STORY + "</div><div class='comments'><p>" + "A long comment. " * 20 + "</p></div>",
    "<div class='layout with-sidebar'><article>" + STORY + "</article><aside><article><p>" + "Teaser. " * 40 + "</p></article></aside></div>",
    "<div class='layout with-sidebar'><article>" + STORY + "</article><div class='related'><article><p>Teaser.</p></article></div></div>"])
def test_noise_stays_noise(page):
    assert web_text.main_text("<body>" + page, None, frozenset()) == TOLD


LONG = "A long sentence of the body. " * 30
PARTS = [f"<article><h1>Head {{n}}</h1><p>Lead {{n}}.</p><div class=body><p>{LONG}{{n}}</p></div><p>End {{n}}.</p></article>",
         f"<h1>Head {{n}}</h1><article><p>Lead {{n}}.</p><section><p>{LONG}{{n}}</p></section><section><p>{LONG}{{n}} again</p></section><p>End {{n}}.</p></article>"]


@pytest.mark.parametrize("page", PARTS)
def test_heading_lead_and_end_stay(page):
    got = web_text.main_text("<body><nav>menu</nav>" + page.format(n=1), None, frozenset())
    assert got.startswith("Head 1\n\nLead 1.\n\nA long") and got.endswith("\n\nEnd 1.")


def test_heading_lead_and_end_stay_on_a_host(spark):
    rows = [(i, f"https://h.example/{i}", "<body><div class=top>The site</div><div class=page>" + PARTS[i % 2].format(n=i) + "</div>") for i in range(24)]
    rows += [(100, "https://h.example/odd", "<body><div class=top>The site</div><p>Not found.</p>")]
    out = {r.page_id: r.text for r in web_text.extract(frame(spark, rows, "page_id long, url string, html string")).collect()}
    assert out[100] == "Not found."
    for i in range(24):
        assert out[i].startswith(f"Head {i}\n\nLead {i}.\n\nA long") and out[i].endswith(f"\n\nEnd {i}.")


def test_class_words_do_not_decide_where_the_template_has_an_article(spark):
    """The whole table with the words of class and id renamed gives the same texts; nearly every host has a main slot."""
    pages = spark.read.parquet(f"{SF01}/pages.parquet")
    renamed = pages.withColumn("html", F.regexp_replace("html", r'class="[a-z]+"', 'class="zq"'))
    assert renamed.where(F.col("html").contains('class="zq"')).count() == pages.count()
    plain, other = ({r.page_id: r.text for r in web_text.extract(p).collect()} for p in (pages, renamed))
    assert plain == other
    found = web_text.templates(renamed.withColumn("row_key", F.monotonically_increasing_id())).collect()
    assert sum(r.slot is not None for r in found) >= 0.95 * len(found)


def test_slots_beside_the_article(spark):
    """An unnamed advert beside the article goes, also on a host of one page; headings and leads around it, pages of another template and hosts without such a slot stay."""
    def page(i, extra=""):
        return f"<body><div><p>Buy {i} now!</p></div><div><h1>Head {i}</h1><p>Lead {i}.</p><article><p>{LONG}{i}</p></article><div>Ask {i} us.</div></div>{extra}"

    rows = [(i, f"https://h.example/{i}", page(i)) for i in range(6)] + [(50, "https://one.example/", page(50))]
    rows += [(7, "https://h.example/7", f"<body><div><p>{LONG * 4}</p></div><div><article><p>Teaser.</p></article></div>")]
    rows += [(60, "https://none.example/", f"<body><div><p>Buy.</p></div><div><p>{LONG}</p></div>")]
    out = {r.page_id: r.text for r in web_text.extract(frame(spark, rows, "page_id long, url string, html string")).collect()}
    for i in [*range(6), 50]:
        assert out[i] == f"Head {i}\n\nLead {i}.\n\n{LONG}{i}"
    assert out[7] == (LONG * 4).strip() + "\n\nTeaser." and out[60] == "Buy.\n\n" + LONG.strip()
