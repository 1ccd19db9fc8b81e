"""The labelled table that the tree of page_text is trained on: page layouts with filler words.

In a layout `{n}` stands for n filler words. A block whose text begins with `+` is main text, any other block is not. The layouts were written for
this table; they differ in how they mark their parts: by elements, by class names, by roles, or not at all.
"""

from __future__ import annotations

import re

FILLER = "river table seldom green window after market they carry bread over small stones while evening light falls on quiet roads and nobody asks".split()

_LINKS = "<ul>" + "<li><a href='/x'>{2}</a></li>" * 5 + "</ul>"
_MENU = "<ul>" + "<li><a href='/x'>{1}</a></li>" * 6 + "</ul>"

LAYOUTS = [
    # Parts marked by elements.
    f"<header><h1>{{2}}</h1><p>{{6}}</p></header><nav>{_MENU}</nav><article><h1>+{{7}}</h1><p>+{{60}}<p>+{{1}}<p>+{{45}}<p>+{{3}}</article>"
    f"<aside><h2>{{2}}</h2><p>{{40}}</p>{_LINKS}</aside><footer>{{9}}</footer>",
    f"<nav>{_MENU}</nav><div class='ad'>{{8}}</div><article><h1>+{{4}}</h1><p>+{{2}}</p></article><footer>{{14}}</footer>",
    f"<nav>{_MENU}</nav><article><h1>+{{1}}</h1><p>+{{1}}</p><p>+{{1}}</p></article><footer>{{30}}</footer>",
    f"<nav>{_MENU}</nav><main><h1>+{{6}}</h1><p>+{{30}} <a href='/y'>{{3}}</a> {{20}}</p><h2>+{{3}}</h2><ul><li>+{{4}}</li><li>+{{9}}</li><li>+{{2}}</li></ul><p>+{{70}}</p>"
    f"<table><tr><td>+{{1}}</td><td>+{{2}}</td></tr></table><blockquote>+{{15}}</blockquote></main><footer>{_LINKS}{{12}}</footer>",
    f"<header>{_MENU}</header><article><header><h1>+{{8}}</h1><p>+{{4}}</p></header><p>+{{25}}</p><aside>{{22}}</aside><p>+{{5}}</p><figure><figcaption>+{{6}}</figcaption></figure>"
    f"<p>+{{50}}</p>{_LINKS}<footer>{{3}}</footer></article><section id='comments'><h3>{{2}}</h3><article class='comment'><p>{{35}}</p></article><div class='comment'>{{60}}</div></section>",
    f"<main><article><h1>+{{5}}</h1><p>+{{40}}</p><form><label>{{3}}</label><p>{{12}}</p></form><p>+{{20}}</p><div class='newsletter'><p>{{18}}</p></div><p>+{{2}}</p></article></main>"
    f"<div><h2>{{3}}</h2>{_LINKS}</div>",
    # Parts marked by class names and ids.
    f"<div id='header'><div class='logo'>{{2}}</div><div class='nav-bar'>{_MENU}</div></div><div class='post-content'><h1>+{{9}}</h1><p>+{{55}}</p><p>+{{4}}</p><p>+{{1}}</p></div>"
    f"<div class='sidebar'><p>{{30}}</p>{_LINKS}</div><div id='footer'><p>{{20}}</p></div>",
    f"<div class='top-menu'>{_MENU}</div><div class='cookie-notice'><p>{{25}}</p></div><div class='entry'><h2>+{{5}}</h2>+{{33}}<br>{{12}}<p>+{{10}}</p><p>+{{80}}</p><div class='share'>{{4}}</div></div>"
    f"<div class='comments'><p>{{1}}</p><p>{{45}}</p><p>{{70}}</p></div>",
    f"<div role='banner'><p>{{5}}</p></div><div role='navigation'>{_MENU}</div><div role='main'><h1>+{{3}}</h1><p>+{{12}}</p><p>+{{90}}</p></div><div role='complementary'><p>{{44}}</p></div>"
    "<div role='contentinfo'><p>{16}</p></div>",
    f"<div class='alert'>{{15}}</div><div class='story'><p>+{{2}}</p><p>+{{65}}</p><div class='advert'><p>{{10}}</p></div><p>+{{30}}</p></div><div class='related'><p>{{9}}</p>{_LINKS}</div>",
    # Inside the main part, yet not of the text: links on their own, lists of them.
    f"<article><p>+{{30}}</p><p><a href='/z'>{{3}}</a></p><p>+{{22}}</p><p>+{{12}}</p>{_LINKS}{_LINKS}<p><a href='/z'>{{12}}</a></p></article>",
    f"<main>{_MENU}<h1>+{{6}}</h1><p>+{{18}}</p><p>+{{26}}</p><p>+{{3}}</p><p><a href='/p'>{{2}}</a> <a href='/n'>{{2}}</a></p></main>",
    # Short texts, and texts that the page ends with.
    "<article><h1>+{2}</h1></article>",
    "<article><p>+{1}</p></article>",
    "<main><p>+{3}</p></main>",
    "<div class='content'><p>+{2}</p></div>",
    f"<nav>{_MENU}</nav><article><h1>+{{3}}</h1><p>+{{1}}</p>",
    f"<nav>{_MENU}</nav><div class='ad'><p>{{12}}</p></div><article><h1>+{{2}}</h1>",
    *[f"<article><p>+{{20}}</p><p>+{{{n}}}</p></article>" for n in (2, 4, 5, 6, 9)],
    *[f"<article><p>+{{9}} <a href='/v'>{{3}}</a> {{5}}</p><p>+{{{n}}}</p></article>" for n in (1, 3, 5, 8, 30)],
    *[f"<nav>{_MENU}</nav><article><p>+{{{n}}}</p>" for n in (1, 4, 5, 6, 20)],
    # The text is marked, what is beside it is not.
    "<div><p>{24}</p></div><article><h1>+{4}</h1><p>+{26}</p><p>+{4}</p></article><div><p>{35}</p><p>{18}</p></div>",
    f"<div>{{11}}</div><main><p>+{{2}}</p><p>+{{60}}</p></main><div><h3>{{3}}</h3><p>{{90}}</p>{_LINKS}</div><p>{{9}}</p>",
    "<p>{33}</p><article><h1>+{6}</h1></article><p>{14}</p><p>{52}</p>",
    "<div>{15}</div><div class='article-body'><p>+{70}</p><p>+{5}</p></div><div><p>{22}</p></div><p>{10}</p>",
    # Links within the text.
    *[f"<main><p>+{{14}}</p><p>+{{{n}}} <a href='/v'>{{{k}}}</a></p><p>+{{7}}</p></main>" for n, k in ((2, 3), (6, 8), (1, 1), (12, 9), (5, 2))],
    f"<nav>{_MENU}</nav><article><p>+{{4}} <a href='/v'>{{4}}</a> {{2}}</p>{_LINKS}<p>+{{3}}</p></article><footer>{{5}} <a href='/i'>{{2}}</a></footer>",
    f"<article><h1>+{{5}}</h1><p>+{{3}} <a href='/v'>{{5}}</a></p>{_LINKS}<p>+{{16}}</p>",
    *[f"<nav>{_MENU}</nav><article><h1>+<a href='/t'>{{{n}}}</a></h1><p>+{{30}}</p><p>+{{8}}</p></article><aside><h2><a href='/s'>{{{n}}}</a></h2></aside>" for n in (2, 5, 9)],
    f"<nav>{_LINKS}</nav><article><p>+{{60}}</p><p>+{{35}}</p></article><aside><h2><a href='/s'>{{4}}</a></h2><p>{{50}}</p></aside>",
    f"<div>{_LINKS}</div><p>+{{55}}</p><p>+{{41}}</p><div class='related'><h2><a href='/s'>{{7}}</a></h2><p>{{36}}</p></div>",
    "<main><p>+{40}</p><p><a href='/r'>{4}</a></p><p>+{50}</p><p><a href='/r'>{9}</a></p><p>+{31}</p></main><h2><a href='/s'>{5}</a></h2><p>{44}</p>",
    "<article><h1>+<a href='/t'>{6}</a></h1><p>+{3}</p></article>",
    *[f"<header><h1><a href='/'>{{{n}}}</a></h1></header><nav>{_MENU}</nav><article><h1>+<a href='/t'>{{5}}</a></h1><p>+{{30}}</p></article><h2><a href='/s'>{{{n}}}</a></h2>" for n in (1, 2, 4)],
    f"<div id='header'><h1><a href='/'>{{3}}</a></h1></div><div class='post'><h2>+<a href='/t'>{{7}}</a></h2><p>+{{52}}</p></div><div class='sidebar'><h3><a href='/s'>{{2}}</a></h3></div>",
    # What is not the text is marked, the text is not.
    f"<header><p>{{30}}</p></header><nav>{_MENU}</nav><p>+{{50}}</p><p>+{{8}}</p><p>+{{30}}</p><aside><p>{{60}}</p></aside><footer><p>{{40}}</p><p>{{25}}</p></footer>",
    "<div class='cookie-banner'><p>{45}</p></div><div class='topbar'>{12}</div><div><h1>+{5}</h1><p>+{44}</p><p>+{21}</p></div><div class='comments'><p>{66}</p><p>{20}</p></div>",
    "<nav><p>{20}</p></nav><p>+{25}</p><p>+{31}</p><form><p>{30}</p></form>",
    "<p>+{30}</p><p>+{42}</p><div class='comment'>{48}</div><div class='comment'>{31}</div>",
    "<div class='ad'><p>{35}</p><p>{28}</p></div>",
    "<footer><p>{50}</p></footer>",
    f"<div id='header'>{{18}}</div><div class='entry-title'>+{{4}}</div><div>+{{70}}</div><div>+{{25}}</div><div class='sidebar'><p>{{33}}</p></div>",
    # Parts not marked at all.
    f"<div><a href='/'>{{2}}</a></div><div>{_MENU}</div><h1>+{{8}}</h1><p>+{{48}}</p><p>+{{36}}</p><p>+{{6}}</p><p>+{{52}}</p><div>{_LINKS}</div><div>{{5}}</div>",
    f"<table><tr><td>{_MENU}</td><td><p>+{{62}}</p><p>+{{19}} <a href='/q'>{{2}}</a> {{21}}</p><p>+{{40}}</p></td></tr><tr><td>{{4}} <a href='/i'>{{3}}</a></td></tr></table>",
    f"<div>{_LINKS}</div><p>+{{28}}</p><p>+{{33}}</p><h2>+{{4}}</h2><p>+{{75}}</p><p>+{{11}}</p><p>+{{24}}</p><div><a href='/c'>{{1}}</a> {{2}}</div><div>{{3}}</div><div>{{6}}</div>",
    f"<div>{{3}}</div><div>{{2}} <a href='/l'>{{1}}</a></div>{_MENU}<div>+{{100}}</div><div>+{{7}}</div><div>+{{60}}</div>{_MENU}<div>{{4}}</div>",
    "<p>+{40}</p>",
    "<h1>+{5}</h1><p>+{20}</p><p>+{14}</p>",
    "<div>+{16}</div>",
]


def labelled_pages() -> list[tuple[str, list[bool]]]:
    """Pages and, for each of their blocks, whether it is main text."""
    from chatmill.llm.page_text import blocks_of

    pages = []
    for n, layout in enumerate(LAYOUTS):
        at = iter(range(7 * n, 10_000_000))
        html = re.sub(r"\{(\d+)\}", lambda m: " ".join(FILLER[next(at) % len(FILLER)] for _ in range(int(m[1]))), layout)  # noqa: B023
        pages.append((html.replace("+", ""), [b.text.startswith("+") for b in blocks_of(html)]))
    return pages
