"""Labelled pages for the extraction model, made from hand-written layouts.

A layout is a nested list of parts; a part is (markup with {} for what it
holds, is content, parts or a kind of filling).  Text is drawn from invented
syllables by a fixed seed, so the pages are the same on every run.
"""

from __future__ import annotations

import random

MARK = "\x00"  # put before text that is content; removed on parsing a labelled page

BOILER = [
    "<nav>{links}</nav>", "<nav class='main-nav'><ul>{items}</ul></nav>", "<div class='menu' id='menu'><ul>{items}</ul></div>", "<div id='navbar'>{links}</div>",
    "<header><h1>{short}</h1><p>{line}</p></header>", "<header class='site-header'>{links}<p>{short}</p></header>", "<div id='header'><h2>{short}</h2>{links}</div>",
    "<footer><p>{legal}</p></footer>", "<footer>{legal}</footer>", "<div class='footer'><p>{legal}</p><ul>{items}</ul></div>", "<footer class='page-footer'><div>{legal}</div><p>{para}</p></footer>",
    "<aside><h3>{short}</h3><ul>{items}</ul></aside>", "<aside class='sidebar'><p>{para}</p></aside>", "<div class='sidebar'><h4>{short}</h4><p>{line}</p><ul>{items}</ul></div>", "<div id='sidebar-right'><p>{para}</p></div>",
    "<div class='ad'>{line}</div>", "<div class='ad'>{para}</div>", "<div class='advert banner'><p>{line}</p></div>", "<div class='sponsored'><p>{para}</p></div>", "<section class='promo'><h3>{short}</h3><p>{para}</p></section>", "<ins class='adsbygoogle'>{line}</ins>",
    "<div class='cookie-notice'><p>{para}</p><button>{short}</button></div>", "<div id='consent'>{para}</div>", "<div class='notice'><p>{line}</p></div>", "<div class='alert alert-info' role='alert'>{para}</div>", "<dialog class='popup'><p>{para}</p></dialog>",
    "<form action='/s'><label>{short}</label><input name='q'><button>{short}</button></form>", "<div class='newsletter'><p>{line}</p><form><input><button>{short}</button></form></div>", "<form class='search'><p>{line}</p><select><option>{short}</option></select></form>",
    "<div class='comments'><h3>{short}</h3><div class='comment'><p>{para}</p></div><div class='comment'><p>{para}</p></div></div>", "<section id='comments'><article class='comment'><p>{para}</p></article><article class='comment'><p>{line}</p></article></section>", "<ol class='comment-list'><li><p>{para}</p></li><li><p>{para}</p></li></ol>", "<div id='disqus_thread'><p>{para}</p></div>",
    "<div class='share social'>{links}</div>", "<div class='related'><h3>{short}</h3><ul>{items}</ul></div>", "<div class='breadcrumb'>{links}</div>", "<div class='pagination'>{links}</div>", "<div class='tags'>{links}</div>", "<p class='copyright'>{legal}</p>", "<ul>{items}</ul>", "<div>{links}</div>",
]
CONTENT = ["<p>{para}</p>"] * 8 + ["<p>{long}</p>"] * 4 + ["<p>{line}</p>"] * 3 + ["<p>{short}</p>"] * 2 + ["<p><b>{line}<br>", "<p>{para} <a href='/x'>{short}</a> {line}</p>", "<h2>{short}</h2>", "<h3>{line}</h3>", "<ul><li>{line}</li><li>{line}</li><li>{short}</li></ul>", "<ol><li><p>{line}</p></li><li>{para}</li></ol>", "<blockquote><p>{para}</p></blockquote>", "<pre>{line}</pre>", "<figure><img src='x'><figcaption>{line}</figcaption></figure>", "<table><tr><th>{short}</th><td>{short}</td></tr><tr><td>{short}</td><td>{short}</td></tr></table>", "<section><h2>{short}</h2><p>{para}</p></section>", "<div>{para}</div>", "<div><p>{para}</p></div>"]
FRAMES = [
    "<article><h1>{title}</h1>{body}</article>", "<article><h1>{title}</h1>{body}</article>", "<main><article class='post'><h1>{title}</h1>{body}</article></main>", "<main><h1>{title}</h1>{body}</main>",
    "<div id='content'><h1>{title}</h1>{body}</div>", "<div class='container'><div class='entry-content'><h1>{title}</h1>{body}</div></div>", "<div id='main'><div class='story'><h2>{title}</h2>{body}</div></div>",
    "<div class='wrap'><div class='col'><h1>{title}</h1>{body}</div></div>", "<section class='article-body'><h1>{title}</h1>{body}</section>", "<h1>{title}</h1>{body}", "<table><tr><td><h1>{title}</h1>{body}</td></tr></table>",
]
SYLLABLES = "ba co di fe gu ha ji ko lu ma ne po qui ra so ti ver wen xa yo zer than ing ent".split()


def _text(rng: random.Random, least: int, most: int) -> str:
    words = ["".join(rng.choices(SYLLABLES, k=rng.randint(1, 3))) for _ in range(rng.randint(least, most))]
    for i in range(0, len(words), 9):
        words[i] = words[i].capitalize()
        words[min(i + 8, len(words) - 1)] += rng.choice([".", ".", ",", "?"])
    return " ".join(words)


def _fill(rng: random.Random, markup: str, content: bool) -> str:
    mark = MARK if content else ""
    while "{" in markup:
        kind = markup[markup.index("{") + 1 : markup.index("}")]
        if kind == "links":
            new = " ".join(f"<a href='/{i}'>{_text(rng, 1, 3)}</a>" for i in range(rng.randint(2, 8)))
        elif kind == "items":
            new = "".join(f"<li><a href='/{i}'>{_text(rng, 1, 4)}</a></li>" for i in range(rng.randint(2, 9)))
        elif kind == "legal":
            new = f"&copy; {_text(rng, 1, 3)} &middot; {_text(rng, 2, 14)}"
        else:
            new = mark + _text(rng, *{"short": (1, 4), "line": (4, 14), "para": (15, 70), "long": (70, 220), "title": (3, 14)}[kind])
        markup = markup.replace("{" + kind + "}", new, 1)
    return markup


def labelled(count: int = 260, seed: int = 3, frames: list[str] = FRAMES) -> list[str]:
    """Pages whose content text has MARK before it."""
    rng, out = random.Random(seed), []
    for _ in range(count):
        boiler = lambda: _fill(rng, rng.choice(BOILER), False)  # noqa: B023, E731
        body = [_fill(rng, rng.choice(CONTENT), True) for _ in range(rng.choice([1, 2, 3, 6, 12, 20]))]
        if rng.random() < 0.35:  # boilerplate inside the article
            body.insert(rng.randint(0, len(body)), boiler())
        frame = rng.choice(frames).replace("{body}", "\n" * rng.randint(0, 1) + "".join(body))
        main = _fill(rng, frame, True)
        if rng.random() < 0.3:
            main = f"<div class='page'>{main}{boiler()}</div>"
        head = f"<!DOCTYPE html><html><head><title>{_text(rng, 2, 8)}</title><style>p{{margin:0}}</style><script>var t='</p>';</script></head><body>"
        out.append(head + "".join(boiler() for _ in range(rng.randint(0, 4))) + main + "".join(boiler() for _ in range(rng.randint(0, 4))) + "</body></html>")
    return out
