"""Invented pages with labelled blocks: what the block labeller is trained on.

A page is put together from article, menus, headers, footers, sidebars, notices, adverts, forms and reader comments, in the
ways that sites write them: with meaning in the tags, with meaning in class names or ids, or with bare tables and boxes.
"""

from __future__ import annotations

import random

#: Class names or ids by kind of part.
NAMES = {
    "article": "article content post post-content entry entry-content article-body story main-content body-text text page-content blog-post markdown prose".split(),
    "menu": "nav menu navbar main-menu top-nav breadcrumbs breadcrumb navigation tabs pagination pager toolbar skip-links sub-menu".split(),
    "header": "header site-header masthead top topbar branding logo banner hero page-header".split(),
    "footer": "footer site-footer bottom copyright legal colophon credits foot imprint".split(),
    "sidebar": "sidebar aside widget related related-posts recent popular tags tag-cloud archive side rail also-read recommended most-read".split(),
    "notice": "notice cookie cookie-banner cookies consent gdpr alert popup modal overlay message warning paywall disclaimer newsletter".split(),
    "advert": "ad ads advert advertisement sponsor sponsored promo promotion banner-ad adsense dfp commercial partner".split(),
    "form": "form search search-form login signup subscribe contact-form newsletter-form register survey poll".split(),
    "comments": "comments comment comment-list comment-body replies reply discussion responses disqus reactions feedback reader-comments".split(),
    "share": "share social social-share sharing follow like-buttons byline meta post-meta".split(),
}
#: Names of bodies and boxes around everything, and endings of the names of a part's own parts: they tell nothing of what is main text.
OUTER = "home single page template theme no-js dark light layout wrapper container site app root inner main content content-area row col grid wide desktop logged-out lang-en front body index view section-news category-3 boxed".split()
ENDINGS = ("title", "body", "inner", "wrap", "area", "item", "list", "text", "box", "content", "head", "main")
TAGS = {"menu": ["nav"], "header": ["header"], "footer": ["footer"], "sidebar": ["aside"], "notice": ["aside", "dialog"], "advert": ["aside", "ins"], "form": ["form"], "comments": ["section", "aside"], "share": ["aside", "ul"]}
#: Short texts that such parts have.
PHRASES = {
    "menu": "Home|About|Contact|News|Sports|Login|Archive|Next|Previous|Blog|Products|Help|More|English|Search|Start|Accueil|Kontakt|Inicio".split("|"),
    "header": "Welcome to our site|Your daily news|Skip to content|The online magazine|Subscribe now|Since 1998".split("|"),
    "footer": "© 2021 All rights reserved|Privacy policy|Terms of use|Powered by software|Imprint|© example.com · contact|Copyright 2019".split("|"),
    "sidebar": "Related articles|Most read|Recent posts|Tags|Follow us|You may also like|Archive|Popular".split("|"),
    "notice": "We use cookies to improve your experience|Accept all|Please enable JavaScript|This site uses cookies|Your browser is outdated|Subscribe to our newsletter".split("|"),
    "advert": "Advertisement|Sponsored|Buy now|Best price, order today|Free shipping|Click here|50% off this week|Ad".split("|"),
    "form": "Search|Your name|E-mail|Send|Password|Submit|Sign up|Message|I agree to the terms".split("|"),
    "comments": "Great article, thanks!|I don't agree with this|Reply|anna wrote:|2 days ago|First!|Report|Load more comments|Posted by guest".split("|"),
    "share": "Share on social media|Tweet|Print|By the editor|3 min read|12 March 2020|Like|E-mail this".split("|"),
}


class Page:
    """Collects markup; what `text` gets is between marks, so that its label is known after parsing."""

    def __init__(self, rng: random.Random):
        self.rng, self.out, self.labels = rng, [], []
        letters = rng.choice(["aeioulnrst", "eainrtsldü", "aoesnrlcdñ", "eéèaistnru", "аеиностр", "thandeirosgl"])
        self.vocabulary = ["".join(rng.choice(letters) for _ in range(rng.randint(1, 9))) for _ in range(80)]

    def words(self, low: int, high: int) -> str:
        rng, n = self.rng, self.rng.randint(low, high)
        out = [rng.choice(self.vocabulary) for _ in range(n)]
        style = rng.random()
        if style < 0.05:
            out = [x.upper() + "!!" for x in out]
        elif style < 0.1:
            out = [x + rng.choice(["***", "%%%", "$$$", "###", "&amp;&amp;"]) for x in out]
        elif style < 0.13:
            out = out[:1] * n
        elif style < 0.17:
            out = [x + " |" for x in out]
        elif style < 0.25:
            out.insert(rng.randrange(n + 1), rng.choice(["+1 (555) 010-2020", "mail@example.com", "https://example.com/a", "1,204", "“quoted”", "3.5"]))
        for i in range(6, n, rng.randint(6, 14)):
            out[i] += rng.choice([".", ",", "."])
        return (" ".join(out)).capitalize() + rng.choice([".", ".", ".", "", "!", "?"])

    def tag(self, name: str, attrs: str = "") -> str:
        return f"<{name}{attrs}>"

    def text(self, label: int, value: str, tag: str, attrs: str = "", link: bool = False) -> None:
        self.labels.append(label)
        value = f"{len(self.labels) - 1}{value}"
        if link:
            value = f'<a href="/x">{value}</a>'
        elif self.rng.random() < 0.15:
            value = f"<b>{value}</b>" if self.rng.random() < 0.7 else f"<span>{value}</span>"
        close = "" if tag in ("p", "li") and self.rng.random() < 0.2 else f"</{tag}>"
        self.out.append(f"<{tag}{attrs}>{value}{close}")

    def attrs(self, kind: str, named: float) -> str:
        if self.rng.random() > named:
            return self.rng.choice(["", "", f' class="c{self.rng.randint(1, 99)}"', ' class="row"', ' class="box"', ' id="wrap"'])
        name = self.rng.choice(NAMES[kind])
        extra = self.rng.choice(["", "", " container", " col-8", " block", " js-x", " " + self.rng.choice(OUTER), " " + self.invented()])
        return f' {self.rng.choice(["class", "class", "id"])}="{name}{extra}"'

    def invented(self) -> str:
        """A name that nobody has seen."""
        return "".join(self.rng.choice("bcdfglmnprst") + self.rng.choice("aeiou") for _ in range(self.rng.randint(2, 4)))

    def outer(self) -> str:
        """Attributes of a body or of a box around everything."""
        names = [self.rng.choice(OUTER) if self.rng.random() < 0.7 else self.invented() for _ in range(self.rng.randint(1, 3))]
        return f' class="{" ".join(names)}"' if self.rng.random() < 0.7 else f' id="{names[0]}"'

    def own(self, kind: str) -> str:
        """Attributes of something inside a part: often the part's name with an ending."""
        if self.rng.random() < 0.7:
            return ""
        return f' class="{self.rng.choice(NAMES[kind])}-{self.rng.choice(ENDINGS)}"' if self.rng.random() < 0.6 else f' class="{self.rng.choice([*ENDINGS, self.invented()])}"'

    def part(self, kind: str, meaning: float, named: float) -> None:
        """A part that isn't the article."""
        rng = self.rng
        tag = rng.choice(TAGS[kind]) if rng.random() < meaning else rng.choice(["div", "div", "div", "section", "td", "ul"])
        attrs = self.attrs(kind, named if tag in ("div", "section", "td", "ul") else named * 0.6)
        self.out.append(self.tag(tag, attrs))
        linked = {"menu": 0.95, "sidebar": 0.7, "footer": 0.4, "header": 0.3, "share": 0.6}.get(kind, 0.15)
        listed = tag == "ul" or rng.random() < {"menu": 0.8, "sidebar": 0.5, "comments": 0.3}.get(kind, 0.1)
        if kind == "header" and rng.random() < 0.3:
            self.part("menu", meaning, named)
        if listed and tag != "ul":
            self.out.append(f"<ul{self.own(kind)}>")
        for _ in range(rng.randint(1, {"menu": 9, "sidebar": 7, "comments": 6, "footer": 4, "form": 5}.get(kind, 2))):
            long = {"comments": 0.7, "sidebar": 0.5, "advert": 0.7, "notice": 0.6, "footer": 0.5, "header": 0.4}.get(kind, 0.3)
            value = self.words(4, 30) if rng.random() < long else (rng.choice(PHRASES[kind]) if rng.random() < 0.6 else self.words(1, 3))
            if kind == "footer" and rng.random() < 0.3:
                value = f"&copy; {value}"
            inner = "li" if listed else rng.choice({"form": ["label", "div", "button", "p"], "comments": ["p", "div", "p"], "menu": ["a", "div", "span"]}.get(kind, ["p", "div", "h3", "p"]))
            if inner in ("a", "span") or (not listed and rng.random() < 0.25):
                self.labels.append(0)
                self.out.append(f"{len(self.labels) - 1}{value}" if rng.random() > linked else f'<a href="#">{len(self.labels) - 1}{value}</a>')
                self.out.append("<br>")
            else:
                self.text(0, value, inner, self.own(kind), link=rng.random() < linked)
        if listed and tag != "ul":
            self.out.append("</ul>")
        self.out.append(f"</{tag}>")

    def article(self, meaning: float, named: float) -> None:
        rng = self.rng
        tag = rng.choice(["article", "article", "main"]) if rng.random() < meaning else rng.choice(["div", "div", "section", "td"])
        self.out.append(self.tag(tag, self.attrs("article", named)))
        inner = rng.random() < 0.4
        late = inner and rng.random() < 0.4
        if inner and not late:
            self.out.append(self.tag("div", self.own("article") or self.attrs("article", named)))
        wrapped = rng.random() < 0.1
        if rng.random() < 0.85:
            self.out.append("<header>" if wrapped else "")
            self.text(1, self.words(1, 14), rng.choice(["h1", "h1", "h2"]), self.own("article"))
            self.out.append("</header>" if wrapped else "")
        if rng.random() < 0.15:
            self.part("share", meaning, 1.0)
        if late:
            self.out.append(self.tag("div", self.own("article") or self.attrs("article", named)))
        plain = rng.choice(["p", "p", "p", "p", "div"])
        for i in range(rng.choice([0, 1, 1, 2, 3, 4, 6, 9, 14, 22])):
            kind = rng.random()
            if kind < 0.08:
                self.text(1, self.words(1, 8), rng.choice(["h2", "h3"]))
            elif kind < 0.13:
                self.out.append("<ul>")
                for _ in range(rng.randint(2, 5)):
                    self.text(1, self.words(2, 15), "li")
                self.out.append("</ul>")
            elif kind < 0.16:
                self.text(1, self.words(5, 40), "blockquote")
            elif kind < 0.32 and i:
                self.part(rng.choice(["advert", "advert", "share", "notice", "sidebar"]), meaning, 1.0)
            elif kind < 0.36:
                self.text(1, rng.choice(["Released under the MIT License.", "Licensed under CC BY 4.0.", "Copyright is a right.", "Contact the author for news.", "Comments on history.", "Home is far."]), plain)
            else:
                value = self.words(*rng.choice([(1, 3), (4, 20), (15, 60), (20, 90)]))
                if rng.random() < 0.15:
                    value += ' <a href="/y">' + self.words(1, 4) + "</a> " + self.words(1, 9)
                if rng.random() < 0.1:
                    value += "<br>" + f"{len(self.labels)}" + self.words(2, 12)
                    self.labels.append(1)
                self.text(1, value, plain)
        if rng.random() < 0.1:
            self.part("comments", meaning, 1.0)
        if inner:
            self.out.append("</div>")
        self.out.append(f"</{tag}>")


def page(seed: int) -> tuple[str, list[int]]:
    """(html, label of each marked block): in the html, \\ue000 number \\ue001 stands before each block."""
    rng = random.Random(seed)
    new = Page(rng)
    meaning, named = rng.choice([(0.95, 0.5), (0.95, 0.9), (0.5, 0.9), (0.1, 0.95), (0.6, 0.6), (0.9, 0.1)])
    new.out.append("<!DOCTYPE html><html><head><title>" + new.words(1, 8) + "</title><style>p{margin:0}</style><script>var a='</div>';</script></head><body" + (new.outer() if rng.random() < 0.5 else "") + ">")
    wraps = rng.choice([0, 0, 0, 1, 1, 2])
    new.out += [f"<div{new.outer()}>" for _ in range(wraps)]
    for kind, chance in (("notice", 0.25), ("header", 0.5), ("menu", 0.75), ("advert", 0.35), ("form", 0.2), ("sidebar", 0.2)):
        if rng.random() < chance:
            new.part(kind, meaning, named)
    table = rng.random() < 0.1
    new.out.append("<table><tr><td>" if table else "")
    boxed = rng.random() < 0.3
    new.out.append(f"<div{new.outer()}>" if boxed else "")
    if rng.random() < 0.97:
        new.article(meaning, named)
    new.out.append("</div>" if boxed else "")
    new.out.append("</td></tr></table>" if table else "")
    for kind, chance in (("share", 0.2), ("comments", 0.35), ("sidebar", 0.45), ("form", 0.2), ("advert", 0.25), ("notice", 0.15), ("footer", 0.8)):
        if rng.random() < chance:
            new.part(kind, meaning, named)
    new.out.append("</div>" * wraps)
    new.out.append(rng.choice(["</body></html>", "</body></html>", ""]))
    return "".join(new.out), new.labels
