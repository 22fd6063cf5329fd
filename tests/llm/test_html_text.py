import html
import random
import re

from copyaudit.llm import html_text as q

SF = "/root/testdata/sf0.01"

PAGE = """<!DOCTYPE html><html><head><title>T</title><meta a="x>y"></head><body class="has-comments"><header><h1>Site</h1></header>
<nav>menu a b c</nav><div id="sidebar">side words here</div><main><article class="post"><header><h1>Ti&amp;tle</h1></header>
<p>One  two<b>bold</b>
 three.<aside>skip me</aside><script>if(a<b){"</p>"}</script><p>four&nbsp;five<form><input>f</form><div class="ad-box">buy now</div>
<p>six &lt;tag&gt; a < b</article></main><section class="comments"><article class="comment"><p>nice one two three four</p></article>
</section><footer>foot er</footer><div class="cookie-notice">We use</div></body></html>"""


def article(page):
    at, end = page.find("<article>"), page.find("</article>")
    inner = re.sub(r"</?b>", "", page[at + 9:end if end >= 0 else None])
    blocks = re.split(r"<[^>]*>|<[^>]*$", inner)
    return " ".join(filter(None, (" ".join(html.unescape(b).split()) for b in blocks)))


def test_every_page_of_the_table(spark):
    pages = {r.page_id: r for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    for r in q.op4_html_text(spark, SF).collect():
        assert r.text == article(pages[r.page_id].html) and r.n_chars == len(r.text) and r.url == pages[r.page_id].url


def test_a_page_with_everything_around():
    assert q.main_text(PAGE, q.Weights()) == "Ti&tle One twobold three. four five six <tag> a < b"


def test_learned_weights(spark):
    weights = q.learned_weights(spark.read.parquet(f"{SF}/pages.parquet"))
    assert weights.word > 0 and all(w < 0 for w in weights.tags.values())
    assert not {"article", "/article"} & set(weights.tags) and weights.score("article", "") == 0


def test_without_an_article_the_words_decide():
    page = "<body><div><i>a</i><hr><hr><hr></div><p>many words of a text</p><p>and more of it</p><hr><hr><hr><hr><i>b</i></body>"
    assert q.main_text(page, q.Weights()) == "many words of a text and more of it"


def test_best_run_against_all_runs():
    rng = random.Random(1)
    for _ in range(300):
        scores = [rng.choice([-3, -1, -0.5, 1, 2]) for _ in range(rng.randint(0, 12))]
        start, end = q.best_run(scores)
        best = max([0, *(sum(scores[i:k]) for i in range(len(scores)) for k in range(i + 1, len(scores) + 1))])
        assert sum(scores[start:end]) == best


def test_broken_markup_and_awkward_rows(spark):
    for page, text in [("", ""), (None, ""), ("plain words", "plain words"), ("<p>a<", "a<"), ("<p>open <b>never", "open never"),
                       ("<article><p>cut off &am", "cut off &am"), ("<article>x<foo bar='", "x"), ("<script>var a", ""),
                       ("</div></p>late", "late"), ("<!-- <p>no</p> -->yes", "yes"), ("<ul><li>a<li>b</ul>", "a b")]:
        assert q.main_text(page, q.Weights()) == text
    schema = "page_id long, url string, html string, text string, n_chars string"
    rows = [(1, None, None, "x", "y"), (None, "u", "<p>hi</p>", None, None), (1, None, None, "x", "y"),
            (2, "v", "<article>" + "<p>word " * 50_000, "", "")]
    out = q.extract(spark.createDataFrame(rows, schema), q.Weights()).collect()
    assert sorted((r.n_chars for r in out)) == [0, 0, 2, 249_999]
    assert q.extract(spark.createDataFrame([], schema), q.Weights()).count() == 0
    assert q.learned_weights(spark.createDataFrame([], schema)) == q.Weights()


def test_pages_are_not_cut_short():
    long = "<p>" + "many words of it. " * 9 + "</p>"
    words = " ".join(("many words of it. " * 9).split())
    for page, text in [
            ('<p>One <svg class="icon"/> two.</p><p>Three.</p>', "One two. Three."),
            ("<article><p>One <object/> two <math/> x.</p><p>Three.</p></article>", "One two x. Three."),
            ("<article><p>One <button>press</p><p>Two.</p><p>x<select><option>o</p><p>Three.</p></article>", "One Two. x Three."),
            ("<article><p>So <math><mi>x</mi><mo>=</mo><mn>2</mn></math> holds.</p></article>", "So x=2 holds."),
            ("<article><p>a <svg><title>t</title><text>no</text></svg> b</p></article>", "a b"),
            (f'<body><main class="has-sidebar">{long}</main></body>', words),
            (f'<body><article class="post share-on">{long}</article></body>', words),
            (f'<body><div class="page has-sidebar">{long}<div class="sidebar">side</div></div></body>', words),
            (f'<article><div class="text share-on">{long}</div><p>and the very end</p></article>', words + " and the very end"),
            (f'<article>{long}</article><div id="comments"><article class="comment">{long * 3}</article></div>', words)]:
        assert q.main_text(page, q.Weights()) == text


PARTS = [('<h1>A short title</h1>', "A short title"), ('<div class="byline"><span>By</span> <a href="/x">Ann Other</a></div>', "By Ann Other"),
         ('<div>One paragraph in a div.</div>', "One paragraph in a div."), ('<p class="share-price">Shares rose by 3.</p>', "Shares rose by 3."),
         ('<section class="related-work"><h2>Related work</h2><div><div>Others did it.</div></div></section>', "Related work Others did it."),
         ('<pre class="language-menu">menu: a\nb</pre>', "menu: a b"), ('<details><summary>More</summary>Hidden text.</details>', "More Hidden text."),
         ('<table class="ad-rates"><tr><th>Rate</th><td>4</td></tr></table>', "Rate 4"), ('<blockquote class="comment">Quote.</blockquote>', "Quote."),
         ('<figure><img src="x"><figcaption>A caption</figcaption></figure>', "A caption"), ('<center><font>Old markup</font></center>', "Old markup"),
         ('<dl><dt>Term</dt><dd>Meaning</dd></dl>', "Term Meaning"), ('<address>End street 1</address>', "End street 1"),
         ('<section><div><div><div><p>Deep.</p></div></div></div></section>', "Deep."), ('<hgroup><h2>Sub</h2></hgroup>', "Sub"),
         ('<p>Plain <b>bold</b><em>er</em> text.</p>', "Plain bolder text."), ('<ul class="links-to-come"><li>x</li><li>y</li></ul>', "x y"),
         ('<div class="navigator">Navigator class.</div>', "Navigator class."), ('<time>2020</time>', "2020"), ('<main-text>Custom.</main-text>', "Custom.")]
JUNK = ['<div class="ad">buy this now and here</div>', '<aside>an aside</aside>', '<ul class="share-buttons"><li>tweet</li></ul>',
        '<div id="comments"><article class="comment"><p>nice one, really nice one</p></article></div>', '<form>mail<input></form>',
        '<div class="newsletter-signup box">sign up</div>', '<script>var x = "<p>";</script>', '<nav>a b c</nav>', '<div class="cookieBanner">ok</div>']


def test_articles_of_many_shapes_come_out_whole(spark):
    weights = q.learned_weights(spark.read.parquet(f"{SF}/pages.parquet"))
    rng = random.Random(8)
    for w in (weights, q.Weights()):
        for one in PARTS:                                                 # first, last and alone
            long = ("<p>" + "words of text " * 20 + "</p>", " ".join(["words of text"] * 20))
            for parts in ([one], [one, long], [long, one], [long, one, long]):
                page = f"<body><div>Site</div><article>{''.join(h for h, _ in parts)}</article><div>Foot <a>x</a></div></body>"
                assert q.main_text(page, w) == " ".join(t for _, t in parts), page
        for _ in range(60):
            page, expected = "<html><body><header>Site name</header><nav>home</nav>", []
            for _ in range(rng.choice([1, 1, 2, 3])):
                page += "<div><div>" + rng.choice(JUNK) + "<article class='post'>"
                for html_part, text in rng.sample(PARTS, rng.randint(1, 7)):
                    page += html_part + (rng.choice(JUNK) if rng.random() < 0.4 else "")
                    expected.append(text)
                page += "</article></div></div>" + rng.choice(JUNK)
            assert q.main_text(page + "<footer>foot</footer></body></html>", w) == " ".join(expected), page


def test_pages_without_the_mark_keep_their_paragraphs(spark):
    weights = q.learned_weights(spark.read.parquet(f"{SF}/pages.parquet"))
    body = "".join(f"<div><p>{'some words of a text ' * 8}</p></div><div>And a line of words in a div as well.</div>" for _ in range(4))
    text = " ".join([" ".join(["some words of a text"] * 8) + " And a line of words in a div as well."] * 4)
    page = f'<body><div class="site-header">Name</div><div id="top-nav"><a>x</a></div><div class="content">{body}</div><footer>f</footer></body>'
    assert q.main_text(page, weights) == text
