"""Labelled pages that the page model is trained on: invented layouts, the main text marked by hand.

``data-main="1"`` marks what belongs to the main text and ``data-main="0"`` what does not, down to the next mark. The
mark itself is never seen by the model.
"""

from __future__ import annotations

_LONG = (
    "Most of the boats had left the harbour before dawn, and by the time the fog lifted only the two ferries and an old "
    "tug were to be seen at the quay. Nobody had expected them back before the evening, yet the first one came in at noon."
)
_MIDDLE = "The council met twice that week, but the question of the bridge was left open."
_SHORT = "Nobody spoke."


def _links(*names: str) -> str:
    return "<ul>" + "".join(f'<li><a href="/{n}">{n}</a></li>' for n in names) + "</ul>"


def _paragraphs(*texts: str) -> str:
    return "".join(f"<p>{t}</p>" for t in texts)


def _page(body: str) -> str:
    return f"<!DOCTYPE html><html><head><title>Harbour news</title></head><body>{body}</body></html>"


_NAV = f'<nav data-main="0">{_links("home", "news", "about", "contact")}</nav>'
_FOOT = '<footer data-main="0">&copy; 2019 The Harbour Post &middot; All the news from the coast.</footer>'
_AD = f'<div class="ad" data-main="0">{_MIDDLE}</div>'
_TEXT = f"<h2>At the quay</h2>{_paragraphs(_LONG, _MIDDLE, _SHORT, _LONG)}"

PAGES = [
    _page(f'{_NAV}{_AD}<article data-main="1"><h1>Fog over the harbour</h1>{_paragraphs(_LONG, _SHORT, _LONG)}</article>{_FOOT}'),
    _page(f'{_NAV}{_AD}<article data-main="1"><h1>Bridge</h1><p>{_SHORT}</p></article>{_FOOT}'),
    _page(f'<header data-main="0"><h1>The Harbour Post</h1><p>{_MIDDLE}</p></header>{_NAV}<main data-main="1"><h1>Fog</h1>{_TEXT}</main>'
          f'<aside class="sidebar" data-main="0"><h3>Most read</h3>{_links("fog", "tug", "bridge")}<p>{_MIDDLE}</p></aside>{_FOOT}'),
    _page(f'<div id="header" data-main="0"><a href="/">Post</a><p>{_SHORT}</p></div><div id="menu" data-main="0">{_links("a", "b", "c")}</div>'
          f'<div id="content" data-main="1"><h1>Tug</h1>{_TEXT}<ul><li>{_MIDDLE}</li><li>{_SHORT}</li></ul></div>'
          f'<div id="sidebar" data-main="0"><p>{_MIDDLE}</p></div><div id="footer" data-main="0"><p>{_MIDDLE}</p></div>'),
    _page(f'{_NAV}<div class="cookie-notice banner" data-main="0"><p>We use cookies. {_MIDDLE}</p><button>OK</button></div>'
          f'<div class="post entry-content" data-main="1"><h1>Ferry</h1>{_paragraphs(_MIDDLE, _LONG)}<blockquote>{_LONG}</blockquote></div>'
          f'<section class="comments" data-main="0"><h3>Comments</h3><div class="comment"><p>{_LONG}</p></div><div class="comment"><p>{_MIDDLE}</p></div></section>{_FOOT}'),
    _page(f'{_NAV}<main><article data-main="1"><h1>Two ferries</h1><p>{_LONG}</p><p data-main="1">{_LONG}<a href="/x">tug</a> {_MIDDLE}</p>'
          f'<table><tr><td>{_SHORT}</td><td>{_MIDDLE}</td></tr></table></article>'
          f'<div id="comments" data-main="0"><p>{_LONG}</p><form><p>{_SHORT}</p></form></div></main>{_FOOT}'),
    _page(f'<div class="top-bar" data-main="0">{_links("log in", "register")}</div><div class="wrapper"><div class="main-content" data-main="1">{_TEXT}</div>'
          f'<div class="related" data-main="0"><h3>Related</h3>{_links("quay", "coast")}</div>'
          f'<div class="advert sponsored" data-main="0"><p>{_LONG}</p></div></div>{_FOOT}'),
    _page(f'<form class="search" data-main="0"><label>Search</label><p>{_SHORT}</p></form><section class="article-body" data-main="1"><h1>Fog</h1>{_TEXT}<pre>{_MIDDLE}</pre></section>'
          f'<div class="newsletter subscribe" data-main="0"><p>{_MIDDLE}</p></div><div class="share social" data-main="0">{_links("share", "tweet")}</div>{_FOOT}'),
    _page(f'{_NAV}<div class="breadcrumbs" data-main="0"><a href="/">Home</a> / <a href="/n">News</a></div><div class="story" data-main="1"><h1>Dawn</h1>'
          f'{_paragraphs(_SHORT, _LONG, _SHORT, _MIDDLE)}</div><aside data-main="0"><p>{_LONG}</p><p>{_MIDDLE}</p></aside>{_FOOT}'),
    _page(f'<header class="site-header" data-main="0"><p>{_MIDDLE}</p>{_links("home", "sea")}</header><div><div><article data-main="1"><h1>Evening</h1>{_TEXT}</article></div></div>'
          f'<div class="notice" data-main="0"><p>{_LONG}</p></div><footer class="site-footer" data-main="0"><p>{_LONG}</p>{_links("terms", "privacy")}</footer>'),
    _page(f'{_NAV}<article class="post" data-main="1"><header data-main="1"><h1>A long day</h1></header>{_TEXT}</article>'
          f'<div class="promo banner" data-main="0"><p>{_MIDDLE}</p></div><ol class="comment-list" data-main="0"><li><p>{_LONG}</p></li><li>{_SHORT}</li></ol>{_FOOT}'),
    _page(f'<h1 data-main="1">Harbour</h1><div data-main="1">{_paragraphs(_LONG, _LONG, _MIDDLE)}</div><div class="menu" data-main="0">{_links("a", "b")}</div>{_FOOT}'),
]
