import time

import pytest

from pairwright.llm.pages import extract, main_text

LONG = "The story of the day is that it was in the town and that all of them were there for the first time in a long year of work."


def test_structure_is_cut_off():
    html = f"""<!DOCTYPE html><html><head><title>T</title><style>p{{}}</style><script>var t="</p>";</script></head><body>
      <header><a href=/>Site</a></header><nav><ul><li><a href=/a>A</a><li><a href=/b>B</a></ul></nav>
      <div class="cookie-notice">We use cookies for the best of the site.</div><!-- ad --><div id="ad-1">{LONG}</div>
      <article><header><h1>Head&amp;line</h1><p>By Nobody</p></header><p><b>{LONG}<br><p>Short &eacute;&nbsp; one.</p>
      <form><input><button>Go</button>Name</form><aside>{LONG}</aside><p>Last of it.</p>
      <section class="comments"><article><p>{LONG}</p></article></section></article>
      <footer>&copy; Site</footer>"""
    assert main_text(html) == f"Head&line\n{LONG}\nShort é one.\nLast of it."


def test_density_without_marks():
    html = f"<div><a href=1>One</a> <a href=2>Two</a></div><h2>Title</h2><div>{LONG} {LONG}</div><div>Ok then</div><div><a href=3>More</a></div>"
    assert main_text(html) == f"Title\n{LONG} {LONG}\nOk then"


@pytest.mark.parametrize("names", ['class="long-form"', 'class="social-policy"', 'id="legal-news"', 'class="search-and-rescue-report"',
                                   'class="panel-discussion x"', 'id="has-sidebar"', 'class="labelLess"'])
def test_a_word_in_a_name_does_not_drop_an_article(names):
    around = "<nav><a href=/>Home</a></nav>{}<footer>&copy; Site</footer>"
    assert main_text(around.format(f"<div {names}><p>{LONG}</p><p>{LONG} {LONG}</p></div>")) == f"{LONG}\n{LONG} {LONG}"
    assert main_text(around.format(f"<article><p>{LONG}</p><div {names}>{LONG} {LONG}</div></article>")) == f"{LONG}\n{LONG} {LONG}"


@pytest.mark.parametrize("names", ['class="ad"', 'id="ad-1"', 'class="x cookie-notice"', 'class="siteHeader"', 'class="page-footer"', 'id="related-articles"',
                                   'class="main-nav"', 'class="post-comments"', 'id="comments_2"', 'class="comment-form"', 'class="reader-feedback"'])
def test_names_of_what_is_no_article(names):
    assert main_text(f"<div {names}>{LONG} {LONG}</div><div>{LONG}</div>") == LONG
    assert main_text(f"<article><p>{LONG}</p><div {names}>{LONG} {LONG}</div></article>") == LONG


@pytest.mark.parametrize("text", [
    "Сегодня в городе открылась новая библиотека, и жители пришли посмотреть на неё вместе с детьми и друзьями из соседних домов.",
    "Új könyvtár nyílt ma városunkban, ahová gyerekekkel és barátokkal együtt érkeztek a környékbeli házak lakói megnézni mindent.",
    "今日、町に新しい図書館が開館し、近所の人々が子供や友人と一緒に見に来ました。",
])
def test_languages_without_stop_words(text):
    body = f"<div><p>{text * 3}</p><p>{text}</p></div>"
    assert main_text(f"<div><a href=1>{text[:9]}</a> <a href=2>{text[:7]}</a></div>{body}<footer>{text * 3}</footer>") == f"{text * 3}\n{text}"


def test_a_long_block_is_never_lost_with_its_page():
    long = f"{LONG} {LONG}"
    assert main_text(f'<form id="aspnetForm"><div>{long}</div><div class="sidebar">{LONG}</div></form>') == long
    assert main_text(f'<div class="content-1 widget">{long}</div>') == long
    assert main_text(f'<div>{"lorem ipsum dolor " * 20}</div><nav>{LONG}</nav>') == ("lorem ipsum dolor " * 20).strip()
    assert main_text(f"<footer>{long}</footer><aside>{long}</aside>") == ""
    assert main_text(f'<div>{"<a href=1>word word</a> " * 40}</div>') == ""


@pytest.mark.parametrize("part", ["<div>", "<span>", "<p><button><ul>", "<h1><b>", "<article><header>", "<a><form>", "<b></i>"])
def test_deep_pages_take_time_in_proportion(part):
    def seconds(n):
        start = time.perf_counter()
        main_text(part * n + LONG)
        return time.perf_counter() - start

    seconds(100)
    assert seconds(32_000) < 12 * seconds(8_000)


def test_hostile_pages(spark):
    deep = "<div>" * 3000 + LONG
    pages = [None, "", "   ", "<p>unclosed", "<", "<![foo[x]]>", "<article>", "a & b < c", deep, f"<p>{LONG}</p>" * 2000]
    rows = [(i, f"u{i}", h, 1) for i, h in enumerate(pages)] + [(3, "u3", pages[3], 1)]
    table = spark.createDataFrame(rows, "page_id long, url string, html string, text int")
    got = sorted((r.page_id, r.url, r.text, r.n_chars) for r in extract(table).collect())
    assert got == sorted((i, u, main_text(h), len(main_text(h))) for i, u, h, _ in rows)
    assert got[0][2] == got[1][2] == "" and main_text(deep) == LONG and main_text(pages[9]).count("\n") == 1999
    assert extract(table.where("false")).collect() == []


def test_articles_of_the_table(spark, sf_dir):
    """The pages of the test tables hold their article in one element of its own."""
    import html
    import re

    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    want = {}
    for r in pages.collect():
        inside = re.search(r"<article>(.*?)</article>", r.html, re.S)[1]
        blocks = [" ".join(html.unescape(re.sub(r"</?b>|<br>", "", b)).split()) for b in re.split(r"</?(?:p|h1)>", inside)]
        want[r.page_id] = "\n".join(b for b in blocks if b)
    assert {r.page_id: r.text for r in extract(pages).collect()} == want
