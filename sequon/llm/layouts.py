"""Made-up pages in many layouts, whose main text is known; texts come from a corpus.

Main text is marked by a character of private use in front of each of its blocks.
"""

from __future__ import annotations

import html
import random

MARK = ""

# Names that pages give to their parts, and what such parts say.
MAIN = (
    "article|article-body|article__content|post|post-content|post-body|entry|entry-content|story"
    "|story-body|content|main|main-content|text|body-text|blog-post|page-content|prose|hentry"
    "|news-item|chapter|c1|x7f|"
).split("|")
WRAPPERS = "page|wrapper|container|row|col|layout|site|app|root|outer|inner|grid|content-area||".split("|")
MENUS = (
    "nav|navbar|menu|main-menu|topnav|breadcrumbs|links|pagination|pager|tabs|skip-links|site-nav"
    "|navigation|categories|toolbar|dropdown|menubar"
).split("|")
HEADERS = "header|masthead|top|topbar|site-header|branding|logo|page-header|head|hero-bar".split("|")
FOOTERS = "footer|site-footer|bottom|copyright|colophon|foot|legal|page-footer|credits|imprint|contentinfo".split("|")
SIDES = (
    "sidebar|side|aside|right|left|rail|widget|widgets|related|recommended|popular|trending|teaser"
    "|more|latest|secondary|see-also|side-panel|right-column|complementary"
).split("|")
NOTICES = (
    "notice|cookie|cookies|cookie-banner|consent|gdpr|alert|message|popup|modal|overlay|paywall"
    "|subscribe|newsletter|signup|disclaimer|warning|announcement|privacy-notice|info-bar|toast"
).split("|")
ADVERTS = (
    "ad|ads|advert|advertisement|adsense|sponsored|sponsor|promo|promotion|banner|banner-ad|ad-slot"
    "|commercial|affiliate|adbox|partner-offer|advertising"
).split("|")
COMMENTS = (
    "comments|comment|comment-list|discussion|replies|reply|responses|thread|reader-comments"
    "|user-comments|feedback|guestbook|reviews|respond"
).split("|")
FORMS = "search|login|contact|search-form|subscribe-form|signup-form|comment-form|poll|survey".split("|")
SHARES = "share|social|sharing|share-buttons|tags|tag-list|post-meta|rating|print-links".split("|")
PHRASES = (
    "Home|About us|Contact|Privacy policy|Terms of use|Log in|Sign up|Subscribe now|Search|Menu"
    "|All rights reserved.|We use cookies to improve this site.|Accept all|Share this|Read more"
    "|Related articles|Leave a reply|Comments|Advertisement|Sponsored content|Next page|Previous"
    "|Startseite|Impressum|Datenschutz|Anmelden|Wir verwenden Cookies.|Alle Rechte vorbehalten."
    "|Accueil|Mentions légales|Se connecter|Nous utilisons des cookies.|Tous droits réservés."
    "|Inicio|Aviso legal|Iniciar sesión|Usamos cookies en este sitio.|Todos los derechos reservados."
    "|Skip to content|Back to top|Follow us|Newsletter|Most read|Your email|Powered by|Archive"
).split("|")
ROLES = {"navigation", "menubar", "banner", "contentinfo", "complementary", "search", "main", "article", "alert"}
_SPARE = "a word of text that stands for others where a corpus has none to give us all".split()


class Layout:
    """One page; equal seeds and texts make equal pages."""

    def __init__(self, seed: int, main: list[str], rest: list[str]):
        self.dice = random.Random(seed)
        self.main, self.rest = main, rest

    def chance(self, p: float) -> bool:
        return self.dice.random() < p

    def prose(self) -> str:
        """Some sentences, of any length."""
        if not self.main:
            words = [self.dice.choice(_SPARE) for _ in range(self.dice.randrange(1, 60))]
            return " ".join(words).capitalize() + "."
        text = self.dice.choice(self.main)
        if self.chance(0.4):
            words = text.split(" ")
            begin = self.dice.randrange(len(words))
            text = " ".join(words[begin : begin + self.dice.choice([1, 3, 8, 20, 60])])
        return text

    def short(self) -> str:
        if self.rest and self.chance(0.5):
            return " ".join(self.dice.choice(self.rest).split(" ")[: self.dice.randrange(1, 7)])
        return self.dice.choice(PHRASES)

    def said(self) -> str:
        """What a part beside the main text may say: a phrase, or prose like any other."""
        which = self.dice.random()
        if which < 0.4:
            return self.short()
        if which < 0.6 and self.rest:
            return self.dice.choice(self.rest)
        return self.prose()

    def escaped(self, text: str) -> str:
        text = html.escape(text, quote=False)
        return text.replace(" ", "&#32;", 1) if self.chance(0.03) else text

    def tag(self, name: str, inside: str, named: str = "") -> str:
        attribute = self.dice.choice(["class", "class", "id"])
        more = f' {attribute}="{named}"' if named else ""
        if named and self.chance(0.2):
            more = f' class="{self.dice.choice(["box", "block", "b2", "mt-4", "clearfix"])} {named}"'
        if named in ROLES and self.chance(0.5):
            more = f" role={named}"
        if self.chance(0.02):
            name = name.upper()
        return f"<{name}{more}>{inside}</{name}>"

    def named(self, inside: str, tags: tuple[str, ...], names: list[str]) -> str:
        """By its tag, by its name, or by both."""
        tag = self.dice.choice(tags)
        own = tag not in ("div", "section", "ul", "p", "span") and self.chance(0.5)
        return self.tag(tag, inside, "" if own else self.dice.choice(names))

    def link(self, text: str) -> str:
        return f'<a href="/{self.dice.randrange(10**4)}">{self.escaped(text)}</a>'

    def items(self, n: int, linked: float = 0.9) -> str:
        texts = [self.short() for _ in range(n)]
        return "".join(f"<li>{self.link(t) if self.chance(linked) else self.escaped(t)}</li>" for t in texts)

    def menu(self) -> str:
        items = self.items(self.dice.randrange(2, 10))
        if self.chance(0.25):
            return self.named(" | ".join(self.link(self.short()) for _ in range(5)), ("nav", "div"), MENUS)
        if self.chance(0.3):
            return self.tag("ul", items, self.dice.choice(MENUS))
        return self.named(self.tag("ul", items), ("nav", "nav", "div"), MENUS)

    def header(self) -> str:
        inside = self.tag(self.dice.choice(["h1", "h2", "div", "p", "span"]), self.escaped(self.short()))
        if self.chance(0.5):
            inside += self.tag("p", self.escaped(self.said()))
        if self.chance(0.4):
            inside += self.menu()
        if self.chance(0.2):
            inside += self.form()
        return self.named(inside, ("header", "header", "div"), HEADERS)

    def footer(self) -> str:
        inside = "".join(
            self.dice.choice([
                lambda: self.tag("p", f"&copy; {self.dice.randrange(1995, 2030)} {self.escaped(self.short())}"),
                lambda: f"&copy; {self.escaped(self.short())} &middot; {self.escaped(self.said())}",
                lambda: self.tag("ul", self.items(4)),
                lambda: self.tag("p", self.escaped(self.said())),
                lambda: self.link(self.short()),
            ])()
            for _ in range(self.dice.randrange(1, 4))
        )
        return self.named(inside, ("footer", "footer", "div"), FOOTERS)

    def notice(self) -> str:
        inside = self.escaped(self.said()) if self.chance(0.5) else self.tag("p", self.escaped(self.said()))
        if self.chance(0.4):
            inside += f"<button>{self.escaped(self.short())}</button>"
        return self.tag(self.dice.choice(["div", "div", "section", "p", "aside"]), inside, self.dice.choice(NOTICES))

    def advert(self) -> str:
        inside = self.escaped(self.said()) if self.chance(0.6) else self.tag("p", self.escaped(self.said()))
        if self.chance(0.3):
            inside = self.link(self.said())
        return self.tag(self.dice.choice(["div", "div", "div", "aside", "section", "p"]), inside, self.dice.choice(ADVERTS))

    def side(self) -> str:
        inside = "".join(
            self.dice.choice([
                lambda: self.tag("h3", self.escaped(self.short())) + self.tag("ul", self.items(5)),
                lambda: self.tag("p", self.escaped(self.said())),
                lambda: self.tag("div", self.link(self.short()) + self.tag("p", self.escaped(self.said()))),
                lambda: self.escaped(self.said()),
            ])()
            for _ in range(self.dice.randrange(1, 4))
        )
        return self.named(inside, ("aside", "aside", "div", "section"), SIDES)

    def form(self) -> str:
        inside = "".join(
            self.dice.choice([
                lambda: f"<label>{self.escaped(self.short())}</label><input name=q>",
                lambda: f"<select><option>{self.escaped(self.short())}<option>{self.escaped(self.short())}</select>",
                lambda: self.tag("p", self.escaped(self.said())),
                lambda: f"<button type=submit>{self.escaped(self.short())}</button>",
                lambda: "<textarea>" + self.escaped(self.short()) + "</textarea>",
            ])()
            for _ in range(self.dice.randrange(1, 5))
        )
        return self.tag("form", inside, self.dice.choice([*FORMS, "", ""]))

    def comments(self) -> str:
        def one() -> str:
            who = self.tag(self.dice.choice(["b", "span", "div", "p"]), self.escaped(self.short()))
            said = self.tag(self.dice.choice(["p", "p", "div"]), self.escaped(self.prose()))
            return self.tag(self.dice.choice(["li", "div", "article", "div"]), (who if self.chance(0.6) else "") + said,
                            self.dice.choice(["comment", "reply", "comment-body", "", "post"]))

        inside = "".join(one() for _ in range(self.dice.randrange(1, 6)))
        if self.chance(0.5):
            inside = self.tag("h3", self.dice.choice(["Comments", "Discussion", "Replies", "3 comments"])) + inside
        if self.chance(0.3):
            inside += self.form()
        return self.tag(self.dice.choice(["div", "section", "ol", "ul", "aside"]), inside, self.dice.choice(COMMENTS))

    def share(self) -> str:
        if self.chance(0.5):
            return self.tag("ul", self.items(3, 0.7), self.dice.choice(SHARES))
        return self.tag("div", " ".join(self.link(self.short()) for _ in range(3)), self.dice.choice(SHARES))

    def block(self) -> str:
        """A block of main text."""
        text = MARK + self.escaped(self.prose())
        which = self.dice.random()
        if which < 0.62:
            if self.chance(0.15):
                text = text.replace(" ", " <em>", 1) + "</em>"
            if self.chance(0.15):
                text += " " + self.link(self.prose()[:30])
            if self.chance(0.1):
                return f"<p>{text}"
            if self.chance(0.08):
                return f"<p><b>{text}<br>"
            return f"<p>{text}</p>"
        if which < 0.7:
            return self.tag(self.dice.choice(["h2", "h3", "h4"]), MARK + self.escaped(self.prose()[:60]))
        if which < 0.79:
            few = self.dice.choice([1, 3, 1000])
            texts = (" ".join(self.prose().split(" ")[:few]) for _ in range(self.dice.randrange(1, 7)))
            items = (f"<li>{MARK}{self.escaped(t)}" for t in texts)
            return self.tag(self.dice.choice(["ul", "ol"]), "".join(items))
        if which < 0.83:
            return self.tag("blockquote", f"<p>{text}</p>" if self.chance(0.6) else text)
        if which < 0.87:
            cells = (f"<td>{MARK}{self.escaped(self.prose()[:40])}</td>" for _ in range(4))
            return self.tag("table", "<tr>" + "<tr>".join(cells))
        if which < 0.9:
            return self.tag("pre", text)
        if which < 0.93:
            return self.tag("figure", f"<img src=i.png><figcaption>{text}</figcaption>")
        return self.tag("div", text)

    def article(self) -> str:
        blocks = [self.block() for _ in range(self.dice.choice([1, 1, 2, 3, 5, 8, 14]))]
        for _ in range(self.dice.choice([0, 0, 0, 1, 1, 2])):
            blocks.insert(self.dice.randrange(len(blocks) + 1),
                          self.dice.choice([self.advert, self.advert, self.share, self.side, self.notice, self.form])())
        if self.chance(0.75):
            title = self.tag(self.dice.choice(["h1", "h1", "h2"]), MARK + self.escaped(self.prose()[:60]))
            blocks.insert(0, title)
        inside = "".join(blocks)
        if self.chance(0.15):
            inside = self.tag("div", inside, self.dice.choice(MAIN))
        if self.chance(0.1):
            inside += self.comments()
        if self.chance(0.1):
            return inside
        return self.named(inside, ("article", "article", "main", "div", "div", "div", "section", "td"), MAIN)

    def some(self, *parts) -> list[str]:
        return [part() for p, part in parts if self.chance(p)]

    def page(self) -> str:
        body = [self.article() for _ in range(0 if self.chance(0.05) else self.dice.choice([1, 1, 1, 1, 2]))]
        before = self.some(
            (0.5, self.header), (0.6, self.menu), (0.4, self.notice), (0.4, self.advert),
            (0.2, self.side), (0.15, self.form),
        )
        after = self.some(
            (0.4, self.side), (0.35, self.comments), (0.3, self.advert), (0.2, self.form),
            (0.2, self.share), (0.3, self.notice), (0.3, self.menu), (0.65, self.footer),
        )
        if self.chance(0.2):
            self.dice.shuffle(before)
        if self.chance(0.2):
            self.dice.shuffle(after)
        if self.chance(0.3):
            body = [self.tag("div", "".join(body), self.dice.choice(WRAPPERS))]
        inside = "".join([*before, *body, *after])
        for _ in range(self.dice.choice([0, 0, 1, 2])):
            inside = self.tag("div", inside, self.dice.choice(WRAPPERS))
        if self.chance(0.15):
            inside = f"<body>{inside}"
        else:
            head = f"<head><title>{self.escaped(self.short())}</title><style>p{{}}</style><script>var a='</p>';</script></head>"
            inside = f"<!DOCTYPE html><html>{head}<body>{inside}</body></html>"
        return inside
