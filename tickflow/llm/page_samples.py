"""Labelled pages to train the extraction on: composed from labelled fragments.

Main text is marked ``data-main``, what is none inside it ``data-main="no"``. The fragments are written so that no single sign tells main
text apart everywhere: comments are full sentences, articles have short paragraphs, lists and
links, and both sit in elements with and without telling names.
"""

from __future__ import annotations

import random

_SENTENCES = (
    "The council met on Tuesday to discuss the harbour. Nobody expected a quick decision.",
    "Water was found below the old mill; it is clean, cold and free of salt.",
    "She had walked for two hours before the rain began.",
    "Der Fluss trat über die Ufer, und die Brücke blieb bis zum Abend gesperrt.",
    "Les habitants ont attendu le train pendant trois heures, sans la moindre nouvelle.",
    "El puerto quedó cerrado toda la noche por la niebla.",
    "No.", "Of course!", "It did not work", "Three of them, at least.", "| 12 | 14 | 9 |", "x = y + 1",
)
_WORDS = "Home News About Contact Sport Weather Archive Login Start Über Kontakt Accueil Inicio Blog Shop".split()

_NOISE_BLOCKS = (
    ("nav", "{menu}"), ("div class=\"menu\"", "{menu}"), ("ul id=\"navigation\"", "{items}"),
    ("div class=\"topbar nav-links\"", "{menu}"), ("div", "{menu}"), ("header", "<p>{short}</p>{menu}"),
    ("header class=\"site-header\"", "<h2>{short}</h2>"), ("div id=\"breadcrumbs\"", "{links}"),
    ("div class=\"ad\"", "{text}"), ("div class=\"advert banner\"", "<p>{text}</p>"), ("div class=\"sponsored\"", "{text}"),
    ("div class=\"promo-box\"", "<h3>{short}</h3><p>{text}</p>"), ("ins class=\"adsbygoogle\"", "{text}"),
    ("aside", "<h3>{short}</h3>{menu}"), ("aside class=\"sidebar\"", "<p>{text}</p>{menu}"), ("aside", "<p>{text}</p>"),
    ("div id=\"sidebar\"", "<p>{text}</p><p>{text}</p>"), ("div class=\"widget related\"", "{menu}"),
    ("div class=\"cookie-notice\"", "{text}<button>OK</button>"), ("div id=\"consent-banner\"", "<p>{text}</p>"),
    ("div class=\"notice alert\"", "{text}"), ("div role=\"alert\"", "<p>{text}</p>"),
    ("div class=\"popup modal\"", "<p>{text}</p>"), ("div class=\"newsletter subscribe\"", "<p>{text}</p>{form}"),
    ("form", "<label>{short}</label><input><button>{short}</button>"), ("form class=\"search\"", "{text}<select><option>{short}</select>"),
    ("div class=\"share social\"", "{links}"), ("div class=\"tags\"", "{links}"),
    ("section class=\"comments\"", "<h3>{short}</h3>{comments}"), ("div id=\"comments\"", "{comments}"),
    ("ol class=\"comment-list\"", "<li class=\"comment\"><p>{text}</p></li><li class=\"comment\"><p>{text}</p></li>"),
    ("div class=\"reader-responses comments-area\"", "{comments}"),
    ("footer", "&copy; example.org &middot; {text}"), ("footer", "<p>{text}</p>{menu}"), ("footer class=\"site-footer\"", "{links}"),
    ("div class=\"footer copyright\"", "&copy; {text}"), ("div id=\"footer\"", "<p>{text}</p>"), ("noscript", "{text}"),
)
_ARTICLES = (
    "article", "article class=\"post\"", "div class=\"article-body\"", "div id=\"content\"", "main", "section class=\"entry story\"",
    "div class=\"post-content\"", "div class=\"text\"", "td", "div role=\"main\"", "div", "main id=\"main\"",
)


def labelled_pages(count: int = 400, seed: int = 5) -> list[str]:
    """``count`` pages, the same for the same seed."""
    rng = random.Random(seed)

    def text() -> str:
        said = " ".join(rng.choice(_SENTENCES) for _ in range(rng.choice((1, 1, 2, 3, 6))))
        return said.replace("discuss", f"<{rng.choice(('b', 'a href=\"/x\"', 'i'))}>discuss</a></b></i>") if rng.random() < 0.2 else said

    def short() -> str:
        return " ".join(rng.sample(_WORDS, rng.randint(1, 3)))

    def items() -> str:
        return "".join(f'<li><a href="/{w}">{w}</a></li>' for w in rng.sample(_WORDS, rng.randint(2, 6)))

    def filled(pattern: str) -> str:
        makers = {
            "menu": lambda: f"<ul>{items()}</ul>",
            "items": items,
            "links": lambda: " | ".join(f'<a href="#{w}">{w}</a>' for w in rng.sample(_WORDS, 3)),
            "form": lambda: f"<form><input name=q><button>{short()}</button></form>",
            "comments": lambda: "".join(f"<div><b>{short()}</b><p>{text()}</p></div>" for _ in range(rng.randint(1, 4))),
            "text": text,
            "short": short,
        }
        for name, make in makers.items():
            while "{" + name + "}" in pattern:
                pattern = pattern.replace("{" + name + "}", make(), 1)
        return pattern

    def noise() -> str:
        tag, inside = rng.choice(_NOISE_BLOCKS)
        return f"<{tag}>{filled(inside)}</{tag.split()[0]}>"

    def body() -> str:
        parts = [f"<h1>{text()[:60].replace('<', '')}</h1>"] if rng.random() < 0.7 else []
        for _ in range(rng.choice((1, 2, 4, 9))):
            kind = rng.random()
            if kind < 0.6:
                parts.append(f"<p>{text()}" + rng.choice(("</p>", "</p>", "", "<br>")))
            elif kind < 0.7:
                parts.append(f"<p><b>{text()}<br>")
            elif kind < 0.78:
                parts.append(f"<h2>{short()}</h2><p>{text()}</p>")
            elif kind < 0.86:
                parts.append(f"<ul><li>{text()}</li><li>{text()}</ul>")
            elif kind < 0.91:
                parts.append(f"<blockquote>{text()}</blockquote>")
            elif kind < 0.95:
                parts.append(f"<pre>{text()}</pre>")
            else:
                parts.append(f"<table><tr><td>{text()}<td>{short()}</table>")
        return "".join(parts)

    pages = []
    for _ in range(count):
        holder = rng.choice(_ARTICLES + _ARTICLES[:1] * 3)
        main = f"<{holder} data-main>{body()}</{holder.split()[0]}>"
        if holder == "td":
            main = f"<table><tr>{main}</tr></table>"
        if rng.random() < 0.15:  # an advert amid the text
            main = main.replace("<p>", f'<div class="ad" data-main="no">{text()}</div><p>', 1)
        before = "".join(noise() for _ in range(rng.choice((0, 1, 2, 2, 3))))
        after = "".join(noise() for _ in range(rng.choice((0, 1, 1, 2, 3))))
        wrap = rng.choice(("{}", "{}", '<div id="page" class="container">{}</div>', '<div class="wrapper">{}</div>'))
        end = rng.choice(("</body></html>", "</body></html>", ""))
        head = f"<!DOCTYPE html><html><head><title>{short()}</title><style>p{{}}</style><script>var t='</p>';</script></head>"
        pages.append(f"{head}<body>{wrap.format(before + main + after)}{end}")
    return pages
