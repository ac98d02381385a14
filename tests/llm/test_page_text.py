"""Main text of pages, and cuts against all labellings."""

import itertools
import random

from pyspark.sql import functions as F

from skylag.llm import page_text as p
from skylag.llm.common import on_workers

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style></head><body>
<header><p>Welcome to our site, the best of all sites.</p></header><div class="cookie-notice">We use cookies. All of them.</div>
<nav><ul><li><a href=/>Home</a></li></ul></nav><!-- <p>not a paragraph.</p> --><script>var t="</p><p>no.";</script>
<div id=main><article><h1>A &amp; B</h1><p><b>Bold first.<br><p>Short.<p>Some text &lt;here&gt;,
 with   spaces&nbsp;and a sentence.</p><div class="ad-box"><p>Buy now our product. It is cheap and it is good.</p></div>
<ul><li>Item one</li><li>Item two</li></ul></article><section class="comments"><p>I like this article very much. Thanks.</p></section></div>
<aside><p>Some more about something else entirely, in a sentence.</p></aside><form><label>Mail</label><input name=a></form>
<footer><p>&copy; 2020 All rights reserved by all of us.</p></footer></body></html>"""
TEXT = "A & B\n\nBold first.\n\nShort.\n\nSome text <here>, with spaces and a sentence.\n\nItem one\n\nItem two"


def test_article_without_the_rest():
    assert p.main_text(PAGE) == TEXT


def test_names_in_one_word_and_headers():
    text = "This is a paragraph of some length, and it ends with a full stop."
    html = (
        f"<div class='site-header'><p>{text}</p></div><article class=post><div class='article-header'><h1>Title</h1></div><p>{text}</p>"
        f"<ol class=commentlist><li>{text}</li></ol></article><div id=pagefooter><p>{text}</p></div>"
    )
    assert p.main_text(html) == f"Title\n\n{text}"


def test_page_without_article_keeps_its_paragraphs():
    text = "This is a paragraph of some length, and it ends with a full stop."
    html = f"<body><div class=menu><a href=a>Home</a> <a href=b>Help</a></div><div><p>{text}</p><p>{text}</p></div><div class=footer>Copyright.</div>"
    assert p.main_text(html) == f"{text}\n\n{text}"


def test_names_of_what_stands_beside_the_article():
    text = "This is a paragraph of some length, and it ends with a full stop."
    ill = f"<div class=sidebar><p>{text}</p></div><section class=comments><p>{text}</p><p>{text}</p><p>{text}</p></section>"
    pages = [
        f"<div class='content-sidebar-wrap'><main><p>{text}</p></main>{ill}</div>",
        f"<div class='sidebar-wrap'><main><p>{text}</p></main>{ill}</div>",
        f"<div class=sidebar-layout><article><p>{text}</p></article>{ill}</div>",
        f"<div class='has-sidebar'><p>{text}</p>{ill}</div>",
        f"<article class='post comments-open'><p>{text}</p></article>{ill}",
        f"<div class='no-comments'><p>{text}</p></div>{ill}",
        f"<div class='sidebar-left'><h1>Title</h1><p>{text}</p>{ill}</div>",
        f"<div class='sidebar-left'><p>{text}</p>{ill}</div>",
        f"<div><p>{text}</p></div>{ill}",
    ]
    assert [p.main_text(x).removeprefix("Title\n\n") for x in pages] == [text] * len(pages)
    assert text not in p.main_text(f"<div><h1>Title</h1></div><div class=cookie-notice><p>{text}</p></div>")


def test_items_have_the_label_of_paragraphs_beside_their_list():
    text = "This is a paragraph of some length, and it ends with a full stop."
    items = ["Milk", "Eggs", "Flour", "Salt", "Sugar"]
    ul = "<ul>" + "".join(f"<li>{x}</li>" for x in items) + "</ul>"
    for html in (f"<p>{text}</p>{ul}", f"{ul}<p>{text}</p>", f"<p>{text}</p>{ul.replace('<li>', '<li><p>')}"):
        for name in ("", " class=content"):
            assert sorted(p.main_text(f"<div{name}>{html}</div><div>Menu</div>").split("\n\n")) == sorted([*items, text])
    linked = ul.replace("<li>", "<li><a href=x>").replace("</li>", "</a></li>")
    assert p.main_text(f"<div><p>{text}</p></div><div>{linked}</div><div class=footer><p>{text}</p>{ul}</div>") == text


def test_least_cut_of_small_graphs():
    rng = random.Random(4)
    for _ in range(300):
        n = rng.randint(1, 8)
        costs = [rng.randint(-9, 9) for _ in range(n)]
        ties = [(i, j, rng.randint(1, 6)) for i in range(n) for j in range(i) if rng.random() < 0.5]

        def cut(labels):
            own = sum(abs(c) for c, k in zip(costs, labels, strict=True) if (c > 0) != k)
            return own + sum(w for a, b, w in ties if labels[a] != labels[b])

        assert cut(p.minimum_cut(costs, ties)) == min(map(cut, itertools.product([False, True], repeat=n)))


def test_odd_pages(spark):
    on_workers(spark)
    long = "<p>" + "A long text. " * 20_000 + "</p>"
    pages = [(1, None), (2, ""), (3, "no markup at all, but a sentence. And one more of them."), (4, "<p>open <!-- never closed"), (5, "<article>" + long * 3), (5, "<"), (6, "<script>x"), (7, "<article><p>&#x48;i &unknown; &amp</p>"), (8, "<div>" * 3000 + "<article><p>Deep.</p>")]
    rows = spark.createDataFrame(pages, "page_id long, html string").withColumns({"url": F.lit("u"), "text": F.lit("own")})
    got = {(r.page_id, r.html): r for r in p.extract(rows).collect()}
    assert len(got) == len(pages)
    assert all(r.n_chars == len(r.text) for r in got.values())
    text = {k: r.text for k, r in got.items()}
    assert text[1, None] == text[2, ""] == text[5, "<"] == text[6, "<script>x"] == ""
    assert text[3, pages[2][1]] == pages[2][1]
    assert text[5, pages[4][1]].count("\n\n") == 2
    assert text[7, pages[7][1]] == "Hi &unknown; &"
    assert text[8, pages[8][1]] == "Deep."
    assert p.extract(rows.limit(0)).count() == 0


TEXT_LINE = "This is a paragraph of some length, and it ends with a full stop."


def test_names_of_sections_inside_the_article():
    html = (
        f'<article><p>{TEXT_LINE}</p><h2 id="related-work">Related work</h2><section id="search-algorithms"><p>{TEXT_LINE}</p></section>'
        f'<p class="social-history">{TEXT_LINE}</p><div class="related-posts"><p>{TEXT_LINE}</p></div><div class="share-buttons">Share it.</div></article>'
    )
    assert p.main_text(html) == "\n\n".join([TEXT_LINE, "Related work", TEXT_LINE, TEXT_LINE])


def test_short_lines_and_linked_cells_are_decided_by_what_stands_beside_them():
    poem = ["Roses", "Roses are red", "Violets are blue", "Sugar is sweet", "And so are you"]
    assert p.main_text("<div class=poem><h1>Roses</h1>" + "".join(f"<p>{x}</p>" for x in poem[1:]) + "</div>") == "\n\n".join(poem)
    html = f"<article><p>{TEXT_LINE}</p><table><tr><td>Town</td><td><a href=x>Paris</a></td></tr></table><p>{TEXT_LINE}</p></article>"
    assert p.main_text(html) == "\n\n".join([TEXT_LINE, "Town", "Paris", TEXT_LINE])
    assert p.won_by_the_cut(html) == (1, 0)
    menu = "".join(f"<div><a href=x>{x}</a></div>" for x in ("Home", "News", "Help"))
    # A line that would pass alone, amid links.
    assert p.won_by_the_cut(f"<div>{menu}<div>All our many pages of this and of the last week now</div>{menu}</div><main><p>{TEXT_LINE}</p></main>") == (0, 1)


def test_what_readers_say():
    for opening in ("<h3>3 thoughts on this</h3>", "<h2>Comments (12)</h2>", "<h3>Leave a comment</h3>"):
        html = f"<article><p>{TEXT_LINE}</p></article><div><div>{opening}<p>{TEXT_LINE}</p></div></div>"
        assert p.main_text(html) == TEXT_LINE
    assert p.main_text(f"<article><h2>Comments on Plato</h2><p>{TEXT_LINE}</p></article>") == f"Comments on Plato\n\n{TEXT_LINE}"


def test_broken_tags_and_quotes():
    assert p.main_text(f"<article><p title='a > b'>{TEXT_LINE}</p></article>") == TEXT_LINE
    assert p.main_text(f'<article><p title="never closed>{TEXT_LINE}</p></article>') == TEXT_LINE
    assert p.main_text(f"<article><p>{TEXT_LINE} 1 < 2 and a<b") == f"{TEXT_LINE} 1 < 2 and a<b"
    assert p.main_text(f"<article><p>{TEXT_LINE}</b></i></x></div><p>{TEXT_LINE}") == f"{TEXT_LINE}\n\n{TEXT_LINE}"


def test_reading_takes_time_in_proportion_to_the_page():
    import time

    def seconds(html):
        start = time.process_time()
        p.main_text(html)
        return time.process_time() - start

    for part in ("<a ", "<div>x", '<a ">" ', "<div>", "<span>", "<div class=menu>x. ", "<!--", "<ul><li>x"):
        once, more = seconds(part * 2_000), seconds(part * 16_000)
        assert more < 25 * once + 0.5, part
    assert seconds("<div>" * 8_000 + "</x>" * 16_000) < 8 and seconds("<table><td>" + "<b><i>" * 8_000 + "</b>" * 16_000) < 8
