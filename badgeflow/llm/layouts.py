"""Labelled pages for training: given texts set into layouts whose parts are known.

Every element states its label in ``data-label``, which the features never read. The
words of the surroundings are those of the pages, so that only place, markup and form
can tell them from main text.
"""

from __future__ import annotations

import random
from html import escape

MAIN = (
    "<article>{}</article>",
    "<main>{}</main>",
    "<main><article>{}</article></main>",
    '<div class="content">{}</div>',
    '<div id="main-content"><div class="post-body">{}</div></div>',
    '<section class="entry-content">{}</section>',
    '<div class="page"><div class="story">{}</div></div>',
    "<div><div>{}</div></div>",
    '<article class="post"><div class="article-text">{}</div></article>',
)
# {t}: a short text, {s}: a sentence, {l}: a list of links.
BEFORE = (
    "<nav><ul>{l}</ul></nav>",
    '<div class="menu">{l}</div>',
    '<ul class="breadcrumb">{l}</ul>',
    "<header><p>{t}</p><a href='/'>{t}</a></header>",
    '<div class="site-header"><h1>{t}</h1><p>{s}</p></div>',
    '<div class="cookie-notice"><p>{s}</p><button>OK</button></div>',
    '<div role="alert"><p>{s}</p></div>',
    '<div id="consent-banner">{s} <a href="#">{t}</a></div>',
    '<div class="ad">{s}</div>',
    '<div class="advert"><p>{s}</p><p>{s}</p></div>',
    '<form action="/search"><label>{t}</label><input name="q"></form>',
)
INSIDE = (
    '<div class="ad">{s}</div>',
    '<div class="sponsored"><p>{s}</p></div>',
    '<aside><p>{s}</p></aside>',
    '<aside class="related"><h3>{t}</h3><ul>{l}</ul></aside>',
    '<div class="share-buttons"><a href="#">{t}</a> <a href="#">{t}</a></div>',
    '<div class="newsletter-signup"><p>{s}</p><form><input><button>{t}</button></form></div>',
    '<form><p>{s}</p><label>{t}</label></form>',
    '<div class="notice"><p>{s}</p></div>',
    '<section class="comments"><h3>{t}</h3><div class="comment"><p>{s}</p></div><div class="comment"><p>{s}</p></div></section>',
    "<footer><p>{t}</p></footer>",
    "<nav>{l}</nav>",
)
AFTER = (
    '<section id="comments"><h2>{t}</h2><ol><li><p>{s}</p></li><li><p>{s}</p><p>{s}</p></li></ol></section>',
    '<div class="comment-list"><div class="comment-body"><p>{s}</p></div><div class="comment-body"><p>{s}</p></div></div>',
    '<div id="disqus_thread"><div><p>{s}</p></div><div><p>{s}</p></div></div>',
    '<ul class="replies"><li>{s}</li><li>{s}</li></ul>',
    '<div class="sidebar"><h3>{t}</h3><p>{s}</p><ul>{l}</ul></div>',
    "<aside><h4>{t}</h4><p>{s}</p></aside>",
    '<div class="widget"><p>{s}</p></div>',
    '<div class="related-posts">{l}</div>',
    '<form class="contact"><p>{s}</p><label>{t}</label><textarea></textarea></form>',
    '<div class="subscribe-box"><h3>{t}</h3><p>{s}</p></div>',
    '<div class="promo"><p>{s}</p></div>',
    "<footer>&copy; {t} &middot; {s}</footer>",
    '<div class="footer"><p>{s}</p><p>{t}</p></div>',
    '<div id="footer"><ul>{l}</ul><p>&copy; {t}</p></div>',
)
HEADINGS = ("<h1>{}</h1>", "<h2>{}</h2>", "<header><h1>{}</h1></header>", "<p><strong>{}</strong></p>", "")
PARAGRAPHS = ("<p>{}</p>", "<p>{}", "<div>{}</div>", "<p><b>{}</b></p>", "<blockquote>{}</blockquote>", "<ul><li>{}</li></ul>", "<p>{} <a href='/x'>{}</a></p>")


def _labelled(html: str, label: int) -> str:
    """With the label on the outermost element."""
    head, _, tail = html.partition(">")
    return f'{head} data-label="{label}">{tail}'


def set_anew(articles: list[list[str]], others: list[str], each: int = 2, seed: int = 11) -> list[str]:
    """``each`` new pages for every article (a list of block texts)."""
    pick = random.Random(seed)
    pool = [*others, *(text for article in articles for text in article)]

    def text(words: int) -> str:
        chosen = pick.choice(pool).split()
        at = pick.randrange(max(1, len(chosen) - words))
        return escape(" ".join(chosen[at : at + words]))

    def piece(pattern: str) -> str:
        out = pattern
        for mark, make in (
            ("{t}", lambda: text(pick.randint(1, 4))),
            ("{s}", lambda: text(pick.randint(6, 60)).rstrip(".,") + pick.choice((".", ".", "!", ""))),
            ("{l}", lambda: "".join(f'<li><a href="/{i}">{text(pick.randint(1, 3))}</a></li>' for i in range(pick.randint(2, 6)))),
        ):
            while mark in out:
                out = out.replace(mark, make(), 1)
        return _labelled(out, 0)

    pages = []
    for article in articles * each:
        heading = pick.choice(HEADINGS)
        body = [heading.format(escape(article[0]))] if heading else []
        style = pick.choice(PARAGRAPHS)
        for number, part in enumerate(article[1 if heading else 0 :]):
            pattern = style if pick.random() < 0.8 else pick.choice(PARAGRAPHS)
            body.append(pattern.format(*[escape(part), text(2)][: pattern.count("{}")]))
            if pick.random() < 0.12:
                body.append(piece(pick.choice(INSIDE)))
        if pick.random() < 0.3:
            body.append(piece(pick.choice(INSIDE)))
        main = _labelled(pick.choice(MAIN), 1).format("".join(body))
        before = [piece(p) for p in pick.sample(BEFORE, pick.randint(1, 4))]
        after = [piece(p) for p in pick.sample(AFTER, pick.randint(1, 4))]
        pages.append(f"<html><body>{''.join(before)}{main}{''.join(after)}</body></html>")
    return pages
