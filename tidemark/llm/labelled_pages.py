"""Labelled pages that the extraction model is trained on.

The tables carry no labelled pages, so these layouts were marked by hand: what stands in an element with ``data-main``
is the article, what stands in one with ``data-skip`` inside it is not. ``{w}`` becomes one to three invented words,
``{s}`` a sentence, ``{p}`` a paragraph, ``{x}`` one of the three; each layout is filled several times.
"""

from __future__ import annotations

import random

LAYOUTS = (
    '<html><head><title>{s}</title></head><body><nav><ul><li><a href="/1">{w}</a></li><li><a href="/2">{w}</a></li>'
    '<li><a href="/3">{w}</a></li></ul></nav><div class="ad">{s}</div><article data-main><h1>{s}</h1><p>{p}</p>'
    '<p>{x}</p><p><b>{s}<br><p>{x}</p><p>{w}</p></article><footer>&copy; {w} &middot; {s}</footer></body></html>',
    '<body><header><div class="logo"><a href="/">{w}</a></div><h2>{w}</h2><p>{s}</p></header><div class="breadcrumbs">'
    '<a href="/a">{w}</a> <a href="/b">{w}</a></div><main data-main><h1>{s}</h1><p>{x}</p><h2>{w}</h2><p>{p}</p><ul>'
    '<li>{s}</li><li>{w}</li></ul><blockquote><p>{s}</p></blockquote></main><aside><h3>{w}</h3><ul><li><a href="/c">{s}'
    '</a></li><li><a href="/d">{s}</a></li></ul><p>{s}</p></aside><footer><p>{s}</p><ul><li><a href="/e">{w}</a></li>'
    '</ul></footer></body>',
    '<body><div id="top" class="navbar menu"><ul class="menu"><li><a href="/a">{w}</a></li><li>{w}</li></ul></div><div'
    ' id="wrapper"><div id="content" class="post entry" data-main><h1 class="title">{s}</h1><p>{p}</p><p>{x}</p><div'
    ' class="text"><p>{x}</p><p>{p}</p></div></div><div id="sidebar" class="sidebar widget"><h4>{w}</h4><p>{p}</p><div'
    ' class="widget"><p>{s}</p></div></div></div><div id="footer" class="footer"><p>{s}</p></div></body>',
    '<body><div class="cookie-banner notice" role="dialog"><p>{p}</p><button>{w}</button></div><header role="banner"><p>'
    '{w}</p><form action="/q"><input name="q"><label>{w}</label><p>{s}</p></form></header><article class="story"'
    ' data-main><h1>{s}</h1><p>{p}</p><div class="advert sponsored" data-skip><p>{s}</p></div><p>{x}</p><p>{p}</p>'
    '</article><section class="comments" id="comments"><h2>{w}</h2><div class="comment"><p class="author">{w}</p><p>{p}'
    '</p></div><div class="comment reply"><p>{x}</p></div><form class="respond"><p>{s}</p><textarea>{s}</textarea>'
    '</form></section><footer><div>{s}</div></footer></body>',
    '<body><p data-main>{p}</p><p data-main>{x}</p><p data-main>{p}</p></body>',
    '<body><div data-main>{p}</div><div class="footer">{s}</div></body>',
    '<body data-main>{p}</body>',
    '<body><h1 data-main>{s}</h1><p data-main>{x}</p><p data-main>{p}</p><ul data-main><li>{s}</li></ul></body>',
    '<body><article data-main><h2>{w}</h2><p>{p}</p><div class="tags" data-skip><a href="/t">{w}</a></div><section'
    ' class="comments" data-skip><p>{p}</p></section></article></body>',
    '<body><article data-main><h1>{w}</h1><p>{x}</p><p>{x}</p><section data-skip id="reader-comments"><h3>{w}</h3><div'
    ' class="comment"><b>{w}</b><p>{p}</p></div></section></article><div class="footer-links"><a href="/i">{w}</a>'
    '</div></body>',
    '<body><div class="hero" data-main><h1>{s}</h1></div><div class="story-text" data-main><p>{p}</p><p>{w}</p></div><div'
    ' class="user-comments"><p>{p}</p></div><div class="author-bio byline meta date">{s}</div></body>',
    '<body><div class="header"><h1>{w}</h1><div class="menu"><a href="/a">{w}</a><a href="/b">{w}</a></div></div><div'
    ' class="container"><section data-main><h2>{s}</h2><p>{p}</p><h3>{w}</h3><p>{x}</p><table><tr><td>{w}</td><td>{s}'
    '</td></tr></table><pre>{s}</pre></section><section class="related more"><h3>{w}</h3><ul><li><a href="/r">{s}</a>'
    '</li><li><a href="/t">{s}</a></li></ul></section><div class="newsletter signup"><p>{s}</p><form><p>{s}</p></form>'
    '</div></div><div class="copyright legal">{s}</div></body>',
    '<body><article data-main><h1>{s}</h1><p>{x}</p><aside data-skip><p>{p}</p><p>{s}</p></aside><p>{p}</p><nav'
    ' data-skip><a href="/n">{s}</a></nav><p>{x}</p><div class="share social" data-skip><a href="/f">{w}</a></div>'
    '<footer data-skip><p>{s}</p></footer><div class="comments" data-skip><h3>{w}</h3><div class="comment"><p>{p}</p>'
    '</div><ol class="commentlist"><li>{p}</li><li>{s}</li></ol></div></article></body>',
    '<body><div class="alert notice">{s}</div><div class="consent gdpr overlay popup modal"><div><p>{p}</p></div></div>'
    '<nav class="navigation"><p>{s}</p><div>{w}</div></nav><main><article data-main><h1>{s}</h1><div><p>{p}</p><p>{x}'
    '</p></div></article><div class="ads banner"><div><p>{p}</p></div></div></main><aside class="rail trending'
    ' popular"><div><p>{p}</p></div></aside></body>',
    '<body><div class="site-header masthead"><p>{s}</p></div><div class="page"><div class="main" role="main" data-main>'
    '<h1>{w}</h1><h2>{s}</h2><p>{p}</p><ol><li>{p}</li><li>{s}</li></ol><dl><dt>{w}</dt><dd>{s}</dd></dl><figure>'
    '<figcaption>{s}</figcaption></figure><p>{x}</p></div><div class="side promo"><p>{p}</p></div><div'
    ' class="discussion replies"><ul><li><p>{p}</p></li><li><p>{x}</p></li></ul></div><div class="pagination pager"><a'
    ' href="/p">{w}</a></div></div><div class="bottom site-footer"><p>{p}</p></div></body>',
    '<body><div class="top-bar"><span>{s}</span></div><div id="article-body" class="article body" data-main><p>{x}</p>'
    '<p>{p}</p><p>{w}</p><div class="promo sponsor" data-skip>{p}</div><p>{p}</p></div><div id="disqus" class="reader'
    ' comments"><p>{p}</p><p>{s}</p></div><form class="search subscribe login"><div><p>{p}</p></div></form><div'
    ' class="advertisement">{p}</div></body>',
    '<body><header><h1>{s}</h1><nav><a href="/h">{w}</a></nav></header><article data-main><h1>{w}</h1><p>{x}</p>'
    '</article><div class="sidebar">{p}</div><section id="comments"><article class="comment"><p>{p}</p></article>'
    '<article class="comment"><h4>{w}</h4><p>{x}</p></article></section><footer>{p}</footer></body>',
    '<body><form class="search"><p>{s}</p></form><article data-main><p>{p}</p><p>{x}</p></article><div class="ad">{s}</div>'
    '</body>',
    '<html><body><article data-main><p>{x}</p><ul><li>{s}</li><li>{p}</li></ul><p>{p}</p></article></body></html>',
    '<body><div class="privacy notice"><p>{p}</p><p>{s}</p></div><article data-main><p>{p}</p><p>{s}</p></article><div'
    ' class="cookie popup"><p>{p}</p></div></body>',
    '<body><div id="banner" class="cookie alert">{p}</div><main data-main><h2>{w}</h2><p>{p}</p></main><div class="newsletter">'
    '<p>{p}</p></div></body>',
)
_SYLLABLES = "an be co de er fi ga ho in ja ko li mo na or pe qu ra se ti un ve".split()


def filled(copies: int = 5, seed: int = 3) -> list[str]:
    """Every layout, filled so many times."""
    rng = random.Random(seed)

    def words(low: int, high: int) -> str:
        return " ".join("".join(rng.choices(_SYLLABLES, k=rng.randint(1, 4))) for _ in range(rng.randint(low, high)))

    def text(kind: str) -> str:
        return words(*{"w": (1, 3), "s": (4, 14), "p": (20, 90), "x": rng.choice([(1, 3), (4, 14), (20, 90)])}[kind])

    pages = []
    for layout in LAYOUTS * copies:
        for kind in "wspx":
            head, *rest = layout.split("{" + kind + "}")
            layout = head + "".join(text(kind) + part for part in rest)
        pages.append(layout)
    return pages
