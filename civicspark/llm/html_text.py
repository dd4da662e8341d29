"""HTML extraction: a tree-structured graphical model over the DOM.

Every block element and every run of text between block tags is a node that is content or not. A node
sees its tag, the words of its class and id, and what its text looks like; potentials connect it to its
parent. Messages go up to the root and down again (sum-product), and runs whose marginal says content
are the text. Potentials are counted on labelled pages; one is set: what a page hides is never content.
"""

from __future__ import annotations

import html as entities
import random
import re
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: A quote opens a value only right after "="; anywhere else it is a character like others.
_TAG = re.compile(r"<!--(?:-?>|.*?(?:--!?>|\Z))|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:=\s*(?:\"[^\"]*\"|'[^']*')|[^>])*+)>|<[!?][^>]*>", re.S)
#: Elements whose inside is text for the parser: without an end tag they go to the page's end.
_RAW_END = {t: re.compile(rf"</{t}\b[^>]*>", re.I) for t in ("script", "style", "title", "textarea", "iframe")}
#: Elements that are never content; without an end tag of their own they end at the next block tag.
_ASIDE = frozenset("noscript template svg select button".split())
_BLOCKS = frozenset("html body div p article section main nav header footer aside ul ol li dl dt dd table thead tbody tfoot tr td th caption h1 h2 h3 h4 h5 h6 blockquote pre figure figcaption form fieldset address details summary dialog center hr menu".split())
_NAME = re.compile(r"(?:class|id|role|aria-label)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_HIDDEN = re.compile(r"(?:^|\s)hidden(?:\s|=|/|$)|display\s*:\s*none|aria-hidden\s*=\s*[\"']?true", re.I)
#: Words that names of elements are made of and that the model counts, each on its own. Fixed values.
_NAME_WORDS = frozenset(
    "ad ads advert advertisement banner sponsor sponsored promo nav navbar navigation menu breadcrumb breadcrumbs footer header masthead topbar sidebar side aside widget"
    " comment comments respond replies reply disqus discussion share sharing social related recommended newsletter subscribe signup login cookie cookies consent gdpr notice alert"
    " popup modal overlay search pagination pager tag tags copyright legal disclaimer toolbar skip print contentinfo complementary meta byline"
    " article content post entry story body text main blog prose page news copy hentry more".split()
)
#: Names that say what an article is about or how it is set, and not which part of a page it is.
_ABOUT = re.compile(r"(?:tag|category|type|status|format|author|post|has|no|with|without|is)[-_](?!cloud$|list$|links?$|box$|bio$|tags?$|meta$|nav\w*$|comments?$|footer$|header$|content$|body$|text$|share$|related$)\S*")
_PARTS = re.compile(r"[A-Z]?[a-z]+")

#: Headings of blocks that stand beside an article; a sentence is none.
_OPENS = re.compile(
    r"\W*(?:\d+\s+)?(?:(?:reader|user)s?'?\s+)?(?:comments?|replies|responses|leave a (?:comment|reply)|join the (?:discussion|conversation)|related|more (?:from|on|stories)|you (?:may|might)(?: also)? like"
    r"|recommended|most (?:read|popular)|trending|share(?: this)?|follow us|subscribe|sign up|newsletter|advertisement|sponsored|kommentare?|commentaires?|comentarios?)\b.{0,30}(?<![.!?])"
    r"|.{1,40}\b(?:says|wrote|replied|commented)\W*(?:\d.*)?",
    re.I | re.S,
)
#: Kinds of elements that stand in an article for different reasons.
_GROUPS = {t: g for g, ts in {"frame": "nav aside footer header form menu fieldset", "list": "ul ol dl table", "text": "p h1 h2 h3 h4 h5 h6 blockquote pre figure figcaption", "item": "li tr td th dt dd thead tbody tfoot caption", "story": "article main"}.items() for t in ts.split()}
GROUPS = ("frame", "list", "text", "item", "story", "box")
_CLOSES_P = _BLOCKS - {"html", "body"}
#: Marginal from which a run may be content where no run of a page has 0.5.
DOUBT = 0.03


class Node:
    __slots__ = ("parent", "tag", "names", "hidden", "parts", "linked", "size", "runs", "gold", "opens", "above")

    def __init__(self, parent: int, tag: str, names: tuple[str, ...] | None, hidden: bool, gold: int | None):
        self.parent, self.tag, self.names, self.hidden, self.gold = parent, tag, names, hidden, gold
        self.parts: list[str] = []
        self.linked = self.size = self.runs = 0  # characters below, those of them in links, and runs
        self.opens = ""  # what the first run below speaks for
        self.above = ""  # the group of the parent

    def text(self) -> str:
        return " ".join("".join(self.parts).split())


def _names(attributes: str) -> tuple[str, ...] | None:
    """The words that the names of an element are made of, of those that the model knows; None if it has no name."""
    names = " ".join(a or b or c for a, b, c in _NAME.findall(attributes)) if attributes else ""
    if not names.strip():
        return None
    words = {w.lower() for name in names.split() if not _ABOUT.fullmatch(name.lower()) for w in _PARTS.findall(name)}
    return tuple(sorted(words & _NAME_WORDS))


def _closed(page: str) -> dict[int, int]:
    """Start to end of the _ASIDE elements that have an end tag of their own: one that comes before the end of
    an element around them and, since they don't nest, before the next button or select."""
    ends: dict[int, int] = {}
    stack: list[tuple[str, int]] = []
    still: Counter = Counter()
    skip_to = 0

    def pop_to(tag: str) -> int:
        while True:
            top, start = stack.pop()
            still[top] -= 1
            if top == tag:
                return start

    for m in _TAG.finditer(page):
        tag = (m[2] or "").lower()
        if m.start() < skip_to or not tag:
            continue
        if m[1]:
            if still[tag]:
                start = pop_to(tag)
                if tag in _ASIDE:
                    ends[start] = m.end()
        elif tag in _RAW_END and not (m[3] or "").endswith("/"):
            end = _RAW_END[tag].search(page, m.end())
            skip_to = end.end() if end else len(page)
        elif tag in _ASIDE and not (m[3] or "").endswith("/") or tag in _BLOCKS and tag != "hr":
            if tag in ("button", "select") and still[tag]:
                pop_to(tag)
            stack.append((tag, m.start()))
            still[tag] += 1
    return ends


def parse(page: str) -> list[Node]:
    """Nodes in page order, each after its parent; text runs have the tag "#" and their parent's tag."""
    nodes = [Node(-1, "body", None, False, None)]
    stack, at, run, link, skip_to, ends, unclosed = [0], 0, -1, False, 0, None, False

    def add_text(chunk: str) -> None:
        nonlocal run
        if run < 0:
            if not chunk.strip():
                return
            owner = nodes[stack[-1]]
            nodes.append(Node(stack[-1], "#" + owner.tag, None, owner.hidden, owner.gold))
            run = len(nodes) - 1
        chunk = entities.unescape(chunk) if "&" in chunk else chunk
        nodes[run].parts.append(chunk)
        nodes[run].size += len(chunk)
        if link:
            nodes[run].linked += len(chunk)

    for m in _TAG.finditer(page):
        if m.start() < skip_to:
            continue
        tag = (m[2] or "").lower()
        if m.start() > at and not unclosed:
            add_text(page[at : m.start()])
        at = m.end()
        if not tag:
            continue
        if tag in _BLOCKS or tag in _ASIDE:
            unclosed = False
        if m[1]:
            if tag == "a":
                link = False
            elif tag in _BLOCKS:
                run = -1
                for depth in range(len(stack) - 1, 0, -1):
                    if nodes[stack[depth]].tag == tag:
                        del stack[depth:]
                        break
            continue
        attributes = m[3] or ""
        if tag in _RAW_END and not attributes.endswith("/"):
            end = _RAW_END[tag].search(page, at)
            at = skip_to = end.end() if end else len(page)
            continue
        if tag in _ASIDE and not attributes.endswith("/"):
            ends = _closed(page) if ends is None else ends
            at = skip_to = ends.get(m.start(), at)
            unclosed = m.start() not in ends
            continue
        if tag in _BLOCKS and tag not in ("html", "body"):
            run, link = -1, link and tag != "p"
            top = nodes[stack[-1]].tag
            if top == "p" and tag in _CLOSES_P or top == tag and tag in ("li", "tr", "td", "th", "dt", "dd"):
                stack.pop()
            if tag == "hr":
                continue
            above = nodes[stack[-1]]
            hidden = above.hidden or bool(attributes and _HIDDEN.search(attributes))
            gold = re.search(r'data-gold="(\d)"', attributes) if "data-gold" in attributes else None
            nodes.append(Node(stack[-1], tag, _names(attributes), hidden, int(gold[1]) if gold else above.gold))
            stack.append(len(nodes) - 1)
        elif tag == "a":
            link = True
        elif tag == "br":
            add_text(" ") if run >= 0 else None
    if at < len(page) and not unclosed:
        add_text(page[at:])
    for n in nodes:
        if n.tag[0] == "#":
            speaks, above = "aside" if n.size < 60 and _OPENS.fullmatch(n.text()) else "none", n.parent
            while above > 0 and not nodes[above].opens:
                nodes[above].opens = speaks
                if speaks == "aside" and _group(nodes[above]) not in ("text", "item"):
                    break  # a heading speaks for the block that it opens, and not for what that block opens
                above = nodes[above].parent
    for n in nodes[1:]:
        n.above = _group(nodes[n.parent]) if n.parent else "page"
    for n in reversed(nodes[1:]):
        nodes[n.parent].size += n.size
        nodes[n.parent].linked += n.linked
        nodes[n.parent].runs += n.runs + (n.tag[0] == "#")
    return nodes


def _group(n: Node) -> str:
    return _GROUPS.get(n.tag.lstrip("#"), "box")


def features(node: Node) -> list[tuple[str, str]]:
    """What a node shows beside its kind. An element shows nothing that its runs show again."""
    share = node.linked / node.size if node.size else 0.0
    links = "none" if share == 0 else "some" if share < 0.5 else "most"
    if node.tag[0] == "#":
        text = node.text()
        n = len(text)
        size = "tiny" if n < 20 else "short" if n < 80 else "middle" if n < 250 else "long"
        return [("links", links), ("shape", size + (" stop" if text[-1:] in ".!?…:;\"'”»)。！？" else ""))]
    if _group(node) in ("text", "item"):
        return [("opens", node.opens)]
    size = "none" if node.size == 0 else "short" if node.size < 80 else "few" if node.runs < 4 else "some" if node.runs < 10 else "many"
    return [("look", f"{links} {node.opens} {size}")]


class TreeModel:
    """Counted potentials: of a label at the root, of a child's label given its parent's (by the child's kind: a run,
    an element with a name or without, and its tag's group; and by the parent's group), of each feature's value given label and kind, and of each
    word of an element's names given label and group."""

    def __init__(self, pages: list[list[Node]]):
        self.root, edges, values, named = [1.0, 1.0], Counter(), Counter(), Counter()
        for nodes in pages:
            gold = [n.gold for n in nodes]
            self.root[gold[0]] += 1
            for n in nodes:
                group = _group(n)
                if n.parent >= 0:
                    for kind in (self._joint(n), self._kind(n)):
                        edges[kind, gold[n.parent], n.gold] += 1
                for name, value in features(n):
                    values[self._kind(n), name, value, n.gold] += 1
                if n.names is not None:
                    for g in (group, ""):
                        named[g, "", n.gold] += 1
                        named.update((g, w, n.gold) for w in n.names)
        total = Counter()
        for (kind, name, _, y), c in values.items():
            total[kind, name, y] += c
        self._values, self._total, self._named = values, total, named
        self._edge = {}
        for way in ("run", "named", "plain", "hidden"):
            for group in GROUPS:
                # A hidden element is never content. Kinds seen seldom below a parent lean on what they have below all.
                kind = (way, group)
                pooled = [[(edges[kind, a, b] + 0.5) / (edges[kind, a, 0] + edges[kind, a, 1] + 1.0) for b in (0, 1)] for a in (0, 1)]
                for above in ("page", *GROUPS):
                    joint = (way, group, above)
                    counted = [[(edges[joint, a, b] + 2 * pooled[a][b]) / (edges[joint, a, 0] + edges[joint, a, 1] + 2.0) for b in (0, 1)] for a in (0, 1)]
                    self._edge[joint] = [[0.999, 0.001], [0.999, 0.001]] if way == "hidden" else counted
        self._seen: dict = {}

    @staticmethod
    def _kind(n: Node) -> tuple[str, str]:
        return "hidden" if n.hidden else "run" if n.tag[0] == "#" else "plain" if n.names is None else "named", _group(n)

    def _joint(self, n: Node) -> tuple[str, str, str]:
        """The kind of the bond to the parent: the node's own, and the parent's group."""
        return *self._kind(n), n.above

    def _word(self, group: str, word: str, y: int) -> float:
        """How often an element of the group with this label has the word in its names; seldom seen groups lean on all."""
        every = (self._named["", word, y] + 0.5) / (self._named["", "", y] + 20.0)
        return (self._named[group, word, y] + 4 * every) / (self._named[group, "", y] + 4.0)

    def _local(self, n: Node) -> tuple[float, float]:
        # The runs of a text are much alike, so what each shows counts by half.
        kind, out = self._kind(n), [1.0, 1.0]
        key = (kind, n.names, *features(n))
        if (found := self._seen.get(key)) is None:
            for name, value in key[2:]:
                # A kind that has one label only says nothing by its values for the other.
                either = (self._values[kind, name, value, 0] + self._values[kind, name, value, 1] + 1.0) / (self._total[kind, name, 0] + self._total[kind, name, 1] + 8.0)
                for y in (0, 1):
                    out[y] *= (self._values[kind, name, value, y] + 8 * either) / (self._total[kind, name, y] + 8.0)
            for word in n.names or ():
                for y in (0, 1):
                    out[y] *= self._word(kind[1], word, y)
            found = self._seen[key] = (out[0] ** 0.5, out[1] ** 0.5) if n.tag[0] == "#" else (out[0], out[1])
        return found

    def marginals(self, nodes: list[Node]) -> list[float]:
        """P(content) of each node: messages from the leaves up, then from the root down."""
        n = len(nodes)
        up = [list(self._local(x)) for x in nodes]
        sent: list[tuple[float, float]] = [(1.0, 1.0)] * n
        for i in range(n - 1, 0, -1):
            u, e = up[i], self._edge[self._joint(nodes[i])]
            m0, m1 = e[0][0] * u[0] + e[0][1] * u[1], e[1][0] * u[0] + e[1][1] * u[1]
            scale = m0 + m1
            sent[i] = (m0 / scale, m1 / scale)
            p = up[nodes[i].parent]
            p[0] *= sent[i][0]
            p[1] *= sent[i][1]
            if (scale := p[0] + p[1]) < 1e-100:
                p[0], p[1] = p[0] / scale, p[1] / scale
        belief: list[tuple[float, float]] = [(0.0, 0.0)] * n
        out = [0.0] * n
        for i, x in enumerate(nodes):
            if i == 0:
                d0, d1 = self.root
            else:
                b, s, e = belief[x.parent], sent[i], self._edge[self._joint(x)]
                q0, q1 = b[0] / s[0], b[1] / s[1]
                d0, d1 = q0 * e[0][0] + q1 * e[1][0], q0 * e[0][1] + q1 * e[1][1]
            b0, b1 = d0 * up[i][0], d1 * up[i][1]
            belief[i] = (b0 / (b0 + b1), b1 / (b0 + b1))
            out[i] = belief[i][1]
        return out


#: Names of the parts of drawn pages, as pages use them. Fixed values.
MAIN_NAMES = (
    "post|post|content|entry-content|story-body|article|article-body|main|main-content|page-content|text|body-text|prose|blog-post|news|copy|post hentry|post meta|post tags|post-1 post tag-politics|post category-notice"
    "|tag-politics|category-news|post sidebar|legal-text|notice-text|print|print article|more-text|related-story|share-story|comment-article|x1|c7|lead|story alert|news sponsored|text legal|post comments-open|content side|page header-text"
)
PART_NAMES = "more-text|legal-text|notice-text|text|body|content|part|more|print|related-work|story-more|side-text|post-body|entry-text|share-text|section-2|copy|news-text|promo-text|x9"
NAV_NAMES = "nav|navbar|main-nav|navigation|site-navigation|menu|main-menu|page-menu|topbar|toolbar|skip|skip-links|breadcrumb|breadcrumbs|bar|pagination|pager|post-navigation|search|login|signup"
HEADER_NAMES = "|header|site-header|page-header|masthead|banner|site|main-header|blog-header"
AD_NAMES = "ad|ads|ads banner|advert|advertisement|ad-banner|promo|sponsor|sponsored|sponsored-content|content-ad|text-ad|post-ad|sponsored-post|promo-box"
NOTICE_NAMES = "cookie-notice|cookies|notice|alert|alert-text|consent|consent-banner|gdpr|popup|modal|overlay|notice-body|cookie-text|page-alert"
FOOTER_NAMES = "footer|site-footer|page-footer|footer-content|copyright|legal|legal copyright|disclaimer|contentinfo|end|footer-text|main-footer"
SIDE_NAMES = "sidebar|side|aside|widget|widget-text|related|related-posts|related-content|recommended|more|more-stories|newsletter|subscribe|share|sharing|share-post|social|social-links|tags|post-tags|tag-cloud|complementary|sidebar-content|page-sidebar|newsletter-text"
META_NAMES = "byline|byline meta|meta|post-meta|entry-meta|tags|entry-tags|print|share|story-share"
COMMENT_NAMES = "comments|comments|comment-list|comments-area|reader-comments|disqus_thread|responses comments|respond|replies|discussion|post-comments|comment-body|comment-text|reply-list"
#: Headings that stand beside an article, and now and then within one. Fixed values.
BESIDE = ["Comments", "Related work", "Newsletter", "More on this", "Share", "Related", "Responses", "Advertisement", "Recommended reading"]


def labelled_page(draw: random.Random) -> str:
    """A page whose parts carry their labels: layouts of common kinds, drawn from a rule."""

    def words(low: int, high: int) -> str:
        return " ".join("".join(draw.choice("aeiourstlnmd") for _ in range(draw.randint(2, 9))) for _ in range(draw.randint(low, high)))

    def named() -> str:
        return draw.choice(["", "", "", "", f' class="{draw.choice(["lead", "x1", "intro", "big", "row", "t-block"])}"', f' id="c{draw.randint(1, 99)}"'])

    def any_name(names: str) -> str:
        found = draw.choice(names.split("|"))
        return f'{found} {draw.choice(["x1", "row", "js-" + words(1, 1), "col-8"])}' if found and draw.random() < 0.15 else found

    def title(low: int, high: int) -> str:
        return words(low, high) + draw.choice(["", "", "", ".", "?", "!"])

    def sentence(low: int = 2, high: int = 25) -> str:
        return words(low, high).capitalize() + draw.choice(".....!?")

    def links(n: int) -> str:
        return "".join(f"<li><a href='#'>{words(1, 3)}</a></li>" for _ in range(n))

    def paragraphs(n: int, terse: bool = False) -> str:
        made = []
        for _ in range(n):
            body = " ".join(sentence() for _ in range(draw.choice([1, 1, 2, 4, 8])))
            kind = draw.random()
            if terse:  # lines rather than sentences
                body = title(1, 5)
                made.append(draw.choice([f"<p>{body}</p>", f"<p>{body}<br>{words(1, 3)}</p>", f"<div>{body}</div>", f"<pre>{body}</pre>", f"<h3>{body}</h3>", f"<p>{sentence(1, 4)}</p>"]))
            elif kind < 0.72:
                made.append(f"<p{named()}>{body if draw.random() < 0.8 else body + ' <a href=#>' + words(1, 3) + '</a> ' + sentence()}</p>")
            elif kind < 0.8:
                level = draw.randint(2, 4)
                made.append(f"<h{level}{named()}>{title(1, 8) if draw.random() < 0.85 else draw.choice(BESIDE)}</h{level}>")
            elif kind < 0.88:
                item = draw.choice([lambda: words(1, 2), lambda: words(2, 12), sentence, lambda: f"<a href='#'>{words(1, 6)}</a>{draw.choice(['', ' ' + sentence()])}"])
                kept = draw.choice(["ul", "ul", "ol"])
                made.append(f"<{kept}>" + "".join(f"<li>{item()}</li>" for _ in range(draw.randint(2, 6))) + f"</{kept}>")
            elif kind < 0.895:
                made.append(f"<p><a href=#>{draw.choice([words(1, 12), sentence()])}</a></p>")
            elif kind < 0.92:
                made.append(f"<blockquote>{draw.choice(['', '<p>'])}{body}</blockquote>")
            elif kind < 0.95:
                made.append(f"<pre>{words(5, 30)}</pre>")
            elif kind < 0.98:
                made.append("<table>" + "".join("<tr>" + "".join(f"<td>{words(1, 3)}</td>" for _ in range(3)) + "</tr>" for _ in range(3)) + "</table>")
            else:
                made.append(f"<figure><figcaption>{sentence()}</figcaption></figure>")
        at = draw.randint(0, len(made))
        if draw.random() < 0.3 and at < len(made):  # a part of its own, whatever its name
            tag, name = draw.choice(["div", "section"]), draw.choice([named(), f' class="{any_name(PART_NAMES)}"'])
            return "".join([*made[:at], f"<{tag}{name}>", *made[at:], f"</{tag}>"])
        return "".join(made)

    def off(tag: str, name: str, inside: str) -> str:
        shown = f' {draw.choice(["class", "id"])}="{name}"' if name else ""
        return f'<{tag}{shown} data-gold="0">{inside}</{tag}>'

    def text_off() -> str:
        return draw.choice([sentence(3, 14), f"<p>{sentence(3, 20)}</p>", f"<p>{sentence()} {sentence()}</p><a href='#'>{words(1, 2)}</a>", f"<h3>{words(1, 3)}</h3><p>{sentence()}</p>"])

    def comments() -> str:
        one = lambda: draw.choice(["<li>{}</li>", "<div class='comment'>{}</div>", "<article class='comment'>{}</article>", "<p>{}</p>"]).format(f"<p>{sentence()} {sentence()}</p>")
        if draw.random() < 0.2:
            said = "".join(f"<div><b>{words(1, 2)}</b> {draw.choice(['says', 'wrote', 'replied'])}:<p>{sentence()}</p></div>" for _ in range(draw.randint(1, 5)))
            return off("div", draw.choice(["", "b7", "comments", "zone"]), said)
        headed = draw.choice([words(1, 2), "Comments", f"{draw.randint(1, 99)} comments", "Reader comments", "Responses", "Leave a comment"])
        body = f"<h3>{headed}</h3>" + "".join(one() for _ in range(draw.randint(1, 6)))
        known = any_name(COMMENT_NAMES)
        return off(draw.choice(["section", "div", "ol", "div"]), known if headed[0].islower() or draw.random() < 0.5 else draw.choice(["", "b7", "lower", "zone"]), body)

    before = [
        off("nav", draw.choice(["", any_name(NAV_NAMES)]), f"<ul>{links(draw.randint(2, 9))}</ul>"),
        off("div", any_name(NAV_NAMES), draw.choice([f"<ul>{links(draw.randint(2, 9))}</ul>", f"<a href='#'>{words(1, 2)}</a> <a href='#'>{words(1, 2)}</a>"])),
        off(draw.choice(["header", "header", "div"]), any_name(HEADER_NAMES), draw.choice([text_off(), f"<h1>{words(1, 3)}</h1><a href='#'>{words(1, 2)}</a>", f"<a href='#'>{words(1, 2)}</a>"])),
        off("div", any_name(AD_NAMES), text_off()),
        off(draw.choice(["div", "section"]), any_name(NOTICE_NAMES), text_off()),
        off("form", draw.choice(["", "search", "f1", "login"]), f"<p>{words(1, 4)}</p>"),
        off("ul", draw.choice(["breadcrumb", "menu", ""]), links(3)),
    ]
    after = [
        off("footer", draw.choice(["", any_name(FOOTER_NAMES)]), draw.choice([text_off(), f"&copy; {words(1, 4)} &middot; {sentence()}", f"<ul>{links(4)}</ul>"])),
        off("div", any_name(FOOTER_NAMES), draw.choice([text_off(), f"&copy; {words(1, 4)} &middot; {sentence()}", f"<ul>{links(4)}</ul>"])),
        off("aside", draw.choice(["", "col2", any_name(SIDE_NAMES)]), draw.choice([f"<h3>{words(1, 2)}</h3><ul>{links(5)}</ul>", text_off()])),
        off(draw.choice(["div", "div", "section"]), any_name(SIDE_NAMES), draw.choice([f"<ul>{links(4)}</ul>", text_off()])),
        comments(),
        off("form", draw.choice(["", "newsletter", "f2"]), f"<p>{sentence()}</p>"),
        off("div", "", f"<ul>{links(6)}</ul>"),
        off(draw.choice(["div", "section"]), draw.choice(["", "zone"]), f"<h3>{draw.choice(['Related', 'Most read', 'More stories', 'Newsletter'])}</h3>{draw.choice([f'<ul>{links(4)}</ul>', text_off()])}"),
    ]
    terse = draw.random() < 0.15
    head = f"<h1{named()}>{title(1, 12) if draw.random() < 0.95 else draw.choice(BESIDE)}</h1>" if draw.random() < 0.8 else ""
    inside = [paragraphs(draw.choice([1, 2, 4, 8, 14]), terse)]
    for extra in draw.sample([off("div", any_name(AD_NAMES), text_off()), off("div", any_name(SIDE_NAMES), f"<ul>{links(3)}</ul>"), off("aside", draw.choice(["", "related"]), text_off()), comments(), off("nav", "", f"<ul>{links(3)}</ul>"), off("div", any_name(META_NAMES), words(1, 5)), off("footer", "", text_off())], draw.choice([0, 0, 1, 2])):
        inside.insert(draw.randint(0, 1), extra)
        inside.append(paragraphs(draw.choice([0, 0, 1, 3]), terse))
    tag = draw.choice(["article", "article", "article", "main", "div", "div", "div", "section", "td"])
    shown = any_name(MAIN_NAMES) if draw.random() < (0.8 if tag == "div" else 0.5) else ""
    name = f' {draw.choice(["class", "class", "id"])}="{shown}"' if shown else ""
    main = f'<{tag}{name} data-gold="1">{head}{"".join(inside)}</{tag}>'
    for wrap in draw.sample(["div", "main", "section", 'div class="page"', 'div id="wrapper"', 'div class="content has-sidebar"', 'body class="page no-comments"'], draw.choice([0, 0, 1, 2])):
        main = f'<{wrap} data-gold="1">{main}</{wrap.split()[0]}>'
    pick = lambda parts: "".join(draw.sample(parts, draw.randint(0, 4)))
    return f"{pick(before)}{main}{pick(after)}"


def train(pages: list[str]) -> TreeModel:
    """A model from pages whose elements carry data-gold; what has none above it is content's frame."""
    parsed = [parse(p) for p in pages]
    for nodes in parsed:
        for n in nodes:
            n.gold = 1 if n.gold is None else n.gold
    return TreeModel(parsed)


@lru_cache(maxsize=1)
def default_model() -> TreeModel:
    """From 1200 labelled pages drawn with a fixed seed; fitted once, on the driver."""
    draw = random.Random(11)
    return train([labelled_page(draw) for _ in range(1200)])


def chosen(nodes: list[Node], model: TreeModel) -> list[Node]:
    """The runs that are content: those with a marginal of 0.5 or more. A page where no run has that, and some are in
    doubt all the same, has those from DOUBT on as its text rather than none, but nothing of menus, forms and the like."""
    marginals, framed = model.marginals(nodes), [False] * len(nodes)
    for i, n in enumerate(nodes):
        framed[i] = _group(n) in ("frame", "list") or n.parent >= 0 and framed[n.parent]
    runs = [(n, p, f) for n, p, f in zip(nodes, marginals, framed, strict=True) if n.tag[0] == "#"]
    return [n for n, p, _ in runs if p >= 0.5] or [n for n, p, f in runs if p >= DOUBT and not f]


def main_text(page: str, model: TreeModel) -> str:
    """The runs that are content, each with its white space as single spaces, joined by line ends."""
    return "\n".join(t for x in chosen(parse(page), model) if (t := x.text())) if page else ""


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """id, url, text and n_chars (code points) of every row of pages, from its whole html.

    Null, empty and tag-only html give an empty text. Rows repeat as they come, ids and urls may be
    null; an empty table gives no rows; other columns aren't read.
    """
    id_type = pages.schema[id_col].dataType.simpleString()
    model = default_model()

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(h.as_py(), model) for h in batch.column(2)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], ["id", "url", "text", "n_chars"])

    found = pages.select(F.col(id_col), F.col(url_col), F.col(html_col)).mapInArrow(read, f"id {id_type}, url string, text string, n_chars long")
    return found.withColumnsRenamed({"id": id_col, "url": url_col})
