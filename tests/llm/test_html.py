from tillroll.llm.html import extract, main_text, surges
from tillroll.llm.queries import op6_html

PARAGRAPH = "This is a sentence of the article that is long enough to count as text. "


def page(body):
    return f"<!DOCTYPE html><html><head><title>T</title><script>var a='</p><p>no';</script></head><body>{body}</body></html>"


def test_article_with_everything_around_it():
    html = page(f"""<header class="site"><a href=/>Home</a></header><nav><ul><li><a href="/x">Menu</a></li></ul></nav>
<div class="cookie-notice">We use cookies. {PARAGRAPH * 4}</div><!-- comment <p>no</p> -->
<article><h1>A &amp; B</h1><p>First <b>bold</b>text.<br>Next&nbsp;line<p>Un<i>closed</i>
  <div class="ad">Buy {PARAGRAPH}</div><aside>More {PARAGRAPH}</aside><form><p>Mail: <input name=a></p></form>
<p title="a > b">Last &lt;one&gt; &#233;&#x4E2D;</p><section id="comments"><p>A reader says {PARAGRAPH}</p></section></article>
<footer>&copy; nobody {PARAGRAPH}</footer>""")
    assert main_text(html) == "A & B First boldtext. Next line Unclosed Last <one> é中"


def test_page_without_an_article_element():
    html = page(f"""<div id="menu"><a href="/a">A</a> <a href="/b">B</a></div><div class="content"><h1>Title</h1>
<p>{PARAGRAPH * 3}</p><p>{PARAGRAPH * 2}</p></div><div class="footer">Imprint {PARAGRAPH}</div>""")
    assert main_text(html) == " ".join(["Title", (PARAGRAPH * 3).strip(), (PARAGRAPH * 2).strip()])


def test_names_of_layouts_and_of_elements():
    body = f"<h1>Title</h1><p>{PARAGRAPH * 3}</p>"
    want = f"Title {(PARAGRAPH * 3).strip()}"
    assert main_text(page(f'<div class="page has-sidebar"><div class="entry-content">{body}</div>'
                          f'<div class="left-sidebar"><p>{PARAGRAPH * 3}</p></div></div>')) == want
    assert main_text(page(f'<div id="popup">{body}</div>')) == want  # nothing else is there
    assert main_text(page(f'<main>{body}<div class="comments-area"><p>{PARAGRAPH}</p></div></main>')) == want


def test_broken_markup():
    assert main_text("<p>open <b>and <i>never closed") == "open and never closed"
    assert main_text("text only") == "text only"
    assert main_text("<article><p>a</article><script>if (a < b) { x('") == "a"
    assert main_text("1 < 2 and <b>3</b> > 2") == "1 < 2 and 3 > 2"
    assert main_text("<article>x<!-- never closed <p>y</p>") == "x"
    assert main_text("<article><p title=\"a > 'b\">x</p><p title='open>y</p></article>") == "x y"
    assert main_text("<p>a</p><script src=x>var p = '<p>b</p>'</script\n><p>c<style>d") == "a c"
    assert main_text(None) == main_text("") == main_text("<div></div>") == ""


def test_odd_long_pages_end_soon():
    for odd in ("<script " + "\"a'" * 3000, "<p " + "\"a'" * 3000, "<" * 20_000, "<a" * 20_000, "<!--" * 20_000, "<div>" * 5_000):
        assert main_text("<p>kept</p>" + odd).startswith("kept")


def test_surges_and_dives():
    assert surges([0, 0, 5, 0, 0, 0, 0, 50, 50, 0], 10) == [(7, 10, 100)]
    assert surges([], 1) == [] and surges([0], 1) == []


def test_query_finds_exactly_the_article(spark):
    import re
    from html import unescape

    path = "/root/testdata/sf0.01"
    pages = {r["page_id"]: r for r in spark.read.parquet(f"{path}/pages.parquet").collect()}
    rows = op6_html(spark, path).collect()
    assert sorted(r["page_id"] for r in rows) == sorted(pages)
    for r in rows:
        article = re.search("<article>(.*?)</article>", pages[r["page_id"]]["html"], re.S)[1]
        blocks = (unescape(re.sub("<[^>]+>", "", b)).split() for b in re.split(r"</?(?:p|h1|br)\b[^>]*>", article))
        want = " ".join(" ".join(b) for b in blocks if b)
        assert (r["text"], r["n_chars"], r["url"]) == (want, len(want), pages[r["page_id"]]["url"])


def test_edge_rows(spark):
    long = "<article>" + "<p>word</p>" * 50_000 + "</article>"
    rows = [(1, None, None, 1), (2, "u", "", 1), (None, "u", "<p>x</p>", 1), (3, "u", long, 1), (3, "u", long, 1)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text int")
    got = {(r["page_id"], r["n_chars"]) for r in extract(df).collect()}
    assert got == {(1, 0), (2, 0), (None, 1), (3, 5 * 50_000 - 1)} and extract(df).count() == 5
    assert extract(df.where("false")).count() == 0


def test_short_paragraphs_after_an_advert_stay():
    long = "<p>" + "Words of a long paragraph go on here. " * 50 + "</p>"
    short = "<p>" + "A later and much shorter paragraph. " * 20 + "</p>"
    page = f"<div><nav>Menu here</nav>{long * 3}<div class='advert'>Buy</div>{short}<div class='share'>Share</div><p>The end.</p></div>"
    text = main_text(page + "<footer>Imprint</footer>")
    assert text.count("shorter paragraph.") == 20 and text.endswith("The end.") and "Buy" not in text and "Imprint" not in text
    # What lies before the first surge, or after the last without being a sentence, is no article.
    assert main_text(f"<div>Home</div><aside>x</aside>{long}<aside>x</aside><div>Imprint</div>") == " ".join(
        ["Words of a long paragraph go on here."] * 50)


def test_stray_ends_take_linear_time():
    import time

    def spent(n):
        start = time.process_time()
        assert main_text("<div>" * n + "text" + "</section>" * n).strip() == "text"
        return time.process_time() - start

    spent(500)
    assert spent(16_000) < 10 * spent(4_000) + 0.5
