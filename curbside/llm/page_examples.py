"""The labelled table that the main-text tree learns from.

Each entry is a small page. The first word of every text block carries its label: + for main text, - for the rest.
`w(n)` stands for n further words, since only their number matters; `menu` and `teasers` for lists of links.
"""

from __future__ import annotations


def w(n: int) -> str:
    return " word" * n


def menu(n: int = 5) -> str:
    return "<ul>" + "".join(f'<li><a href="/{i}">-Item{w(i % 3)}</a></li>' for i in range(n)) + "</ul>"


def teasers(n: int = 3) -> str:
    return "".join(f'<h4><a href="/t{i}">-Teaser{w(6)}</a></h4><p>-Soon{w(14 + i)} <a href="/t{i}">more</a></p>' for i in range(n))


_COMMENTS = f'<div id="comments"><h3>-Comments</h3><ol><li><p>-Nice{w(25)}</p></li><li><p>-No{w(60)}</p><p>-Again{w(3)}</p></li></ol></div>'
_COOKIES = f'<div class="cookie-notice"><p>-We use cookies{w(30)} <a href="/p">policy</a></p></div>'
_FOOTER = f'<footer><p>-&copy; 2024{w(12)}</p>{menu(4)}</footer>'

PAGES: tuple[str, ...] = (
    # article element, menu before, footer after
    f'<nav>{menu(6)}</nav><article><h1>+Title{w(7)}</h1><p>+First{w(40)}</p><p>+Short</p><p>+Then{w(90)}</p></article>{_FOOTER}',
    f'<nav>{menu(6)}</nav><div class="ad">-Buy{w(9)}</div><article><h1>+Title{w(4)}</h1><p>+A{w(2)}</p></article><footer>-&copy; us{w(11)}</footer>',
    f'<div class="banner">-Now{w(40)}</div><article><p>+One{w(70)}</p><p>+Two{w(1)}</p><p>+See{w(9)} <a href="/x">this link{w(3)}</a></p></article>{_COMMENTS}',
    # header and form around, comments and a list of links inside the article
    f'<header><h1>-Paper{w(2)}</h1><p>-Daily{w(5)}</p></header><main><article><header><h1>+Title{w(8)}</h1><p>+By{w(4)}</p></header>'
    f'<p>+Body{w(55)}</p><ul><li>+Point{w(3)}</li><li>+Point{w(12)}</li></ul><aside><p>-Read{w(25)}</p></aside><p>+End{w(33)}</p>'
    f'<section class="comments"><article><p>-Well{w(45)}</p></article></section></article></main><aside>{teasers()}</aside>{_FOOTER}',
    f'<form action="/"><div id="top">{menu(7)}</div><main><h2>+Title{w(5)}</h2><p>+Text{w(120)}</p><table><tr><td>+1{w(1)}</td><td>+2</td></tr></table>'
    f'<form><p>-Your name{w(3)}</p><p>-Message{w(15)}</p></form></main></form>{_FOOTER}',
    f'{_COOKIES}<main><p>+Text{w(30)}</p><div class="share">-Share{w(4)}</div><blockquote>+Quote{w(20)}</blockquote><p>+Text{w(44)}</p></main><div>-Imprint{w(25)}</div>',
    f'<div>-Welcome{w(35)}</div><main><p>+So</p><p>+It{w(6)}</p></main><div><p>-About{w(50)}</p></div>',
    f'<p>-Sale{w(20)}</p><article><h1>+T{w(9)}</h1></article><p>-Contact{w(16)}</p>',
    # a link list inside the main element that nothing names
    f'<main><h1>+Title{w(6)}</h1><p>+Text{w(65)}</p><p>+Text{w(28)}</p>{menu(6)}</main>',
    f'<article><p>+Text{w(80)}</p><p>+Text{w(15)}</p><p><a href="/n">-Next{w(3)}</a></p><p><a href="/p">-Earlier{w(2)}</a></p></article>',
    # links in running text, linked titles, lists of sources; text of the site around the article
    f'<div>-Since{w(60)}</div><article><h1><a href="/1">+Title{w(6)}</a></h1><p>+Text{w(20)} <a href="/a">link</a>{w(15)}</p><p>+See <a href="/b">here{w(1)}</a></p>'
    f'<p>+Text{w(9)} <a href="/c">link{w(4)}</a>{w(6)}</p></article><div>-Our{w(80)}</div><div>-Also{w(30)}</div>',
    f'<p>-Hello{w(70)}</p><p>-More{w(45)}</p><article><h2><a href="/2">+Title{w(9)}</a></h2><p>+Text{w(70)} <a href="/a">link{w(2)}</a></p><p>+Text{w(3)}</p></article>'
    f'<p>-Thanks{w(55)}</p><p>-Write{w(26)}</p>',
    f'<main><h1><a href="/3">+Title{w(3)}</a></h1><p>+Text{w(50)}</p><ul><li>+Source{w(4)} <a href="/s">book{w(2)}</a></li><li>+Source{w(7)} <a href="/s">book{w(3)}</a></li></ul>'
    f'<p>+Text{w(4)} <a href="/d">link{w(1)}</a></p></main><div>-Offer{w(38)}</div><div>-Mail{w(61)}</div>',
    f'<div>-Opening{w(18)}</div><main><p>+<a href="/e">Word</a>{w(30)} <a href="/f">link{w(7)}</a>{w(12)}</p><p>+Yes{w(1)}</p><p>+Text{w(37)}</p></main><div>-Opening{w(90)}</div>',
    f'<nav>{menu(5)}</nav><p>-Intro{w(42)}</p><article><h1>+Title{w(2)}</h1><p>+Text{w(100)}</p></article><p>-Outro{w(42)}</p><p>-Place{w(8)}</p>',
    f'<article><h1>+Title{w(5)}</h1><p>+Text{w(44)}</p><p><a href="/g">-Print{w(1)}</a> <a href="/h">send{w(2)}</a></p><p>+Text{w(24)}</p>{menu(4)}</article>',
    # names of classes only
    f'<div id="menu">{menu(8)}</div><div id="content"><h1>+Title{w(5)}</h1><div>+Text{w(50)}</div><div>+Text{w(8)}</div></div>'
    f'<div id="sidebar"><p>-Tip{w(40)}</p>{teasers()}</div><div id="footer">-&copy;{w(8)}</div>',
    f'<div class="post-content"><h2>+Title{w(3)}</h2><p>+Text{w(35)}</p></div><div class="reader-comments"><p>-I{w(70)}</p><p>-You{w(22)}</p></div>',
    # nothing is named: words and links of a block and its neighbours decide
    f'<div>{menu(6)}</div><div><h1>+Title{w(6)}</h1><p>+Text{w(60)}</p><p>+Text{w(45)}</p><p>+Text{w(75)}</p></div><div>{menu(4)}</div><div>-Imprint{w(4)}</div>',
    f'<table><tr><td>{menu(7)}</td><td><p>+Text{w(85)}</p><p>+Text{w(12)}</p><p>+Text{w(38)}</p></td></tr></table><p>-&copy;{w(3)}</p>',
    f'<p>+Text{w(48)}</p><p>+Text{w(28)}</p><p>+Text{w(66)} <a href="/a">link</a></p><div>{menu(5)}</div>',
    f'<div>-Search</div><div>{menu(4)}</div><h2>+Title{w(7)}</h2><p>+Text{w(31)}</p><p>+Text{w(52)}</p><div>{menu(9)}</div><div>-Call{w(5)}</div>',
    f'<div><a href="/">-Home</a></div><p>+Text{w(24)}</p><p>+Text{w(19)}</p><p>+Text{w(41)}</p><div><a href="/t">-Top{w(1)}</a> | <a href="/q">Legal{w(1)}</a></div>',
    f'{_COOKIES}<div>{menu(3)}</div><div><p>+Text{w(58)}</p><p>+Text{w(36)}</p></div><div>{teasers(4)}</div>',
    f'<h1>+Title{w(4)}</h1><p>+Text{w(26)}</p>',
    f'<p>+Text{w(33)}</p>',
    # no main text at all
    f'<nav>{menu(9)}</nav><div>{menu(12)}</div><footer>-&copy;{w(9)}</footer>',
    f'<div class="login"><form><p>-Name</p><p>-Please{w(22)}</p></form></div>{_COOKIES}<div>-Error{w(3)}</div>',
)
