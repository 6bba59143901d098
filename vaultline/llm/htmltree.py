"""One page's element tree, as far as extraction needs it: which element covers which pieces of text.

A small reader of real-world HTML: raw text elements, comments, character references, implied ends of paragraphs, list
items, cells and options, end tags that don't match.  Every scan moves forward or remembers that there is nothing ahead,
and looks for open elements at most ``DEPTH`` levels up, so the time is linear in the page's length.
"""

from __future__ import annotations

import html
import re

import xxhash

DEPTH = 256

# Names of elements and attributes of HTML, and names that sites give to what isn't their article.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style title textarea xmp iframe noembed noframes".split())
BLOCK = set("address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure "
            "footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre "
            "search section summary table tbody td tfoot th thead tr ul".split())
CLOSES_P = BLOCK - set("caption html head body li dd dt legend optgroup option tbody td tfoot th thead tr".split()) | {"li", "dd", "dt"}
BARRIER = set("caption table td th marquee object template button".split())
IMPLIED = {"li": ({"li"}, {"ul", "ol", "menu"}), "dd": ({"dd", "dt"}, {"dl"}), "dt": ({"dd", "dt"}, {"dl"}),
           "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
           "tbody": ({"tbody", "thead", "tfoot", "tr", "td", "th"}, {"table"}), "tfoot": ({"tbody", "thead", "tr", "td", "th"}, {"table"}),
           "option": ({"option"}, {"select", "datalist"}), "optgroup": ({"option", "optgroup"}, {"select"})}
_P = {"p"}
SKIPPED = {"html", "head", "body"}
NEVER = set("nav footer aside form noscript template svg math canvas object button select datalist dialog menu audio video".split())
ROLES = set("navigation banner contentinfo complementary search dialog alertdialog alert menu menubar toolbar form".split())
FURNITURE = set("ad ads adv advert adverts advertisement advertisements advertising adsense banner sponsor sponsored promo promotion "
                "nav navbar navigation menu menubar breadcrumb breadcrumbs pager pagination topbar toolbar "
                "footer colophon copyright masthead sidebar widget widgets related recommended trending "
                "cookie cookies consent gdpr notice notices popup modal newsletter subscribe subscription signup signin login paywall "
                "share sharing social comment comments commentlist disqus respond reply replies".split())
COMMENTS = set("comment comments commentlist disqus respond reply replies".split())
STATES = set("no with without has is hide js wp".split())
ARTICLE_NAMES = set("article-body article-content post-content post-body entry-content story-body content-body main-content".split())

_TAG = re.compile(r"<(/?)([A-Za-z][^\s/>]*)")
_ATTRIBUTE = re.compile(r"""([^\s"'>/=]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
_RAW_END = {t: re.compile(rf"</{t}(?=[\s/>])", re.I) for t in RAW}
_PLAIN = re.compile(r"""[^"'>]*""")
_DIGITS = re.compile(r"\d+")
_WORD = re.compile(r"[a-z]+")


class Kind:
    """What a tag says by itself: read once for each spelling."""
    __slots__ = ("tag", "closing", "names", "mark", "bare", "article", "furniture", "aside", "block", "empty", "raw")

    def __init__(self, closing: bool, tag: str, attributes: str):
        self.tag, self.closing = tag, closing
        found = {a[0].lower(): a[1] or a[2] or a[3] for a in _ATTRIBUTE.findall(attributes)} if attributes and not closing else {}
        self.names = f"{found.get('class', '')} {found.get('id', '')}".lower().split()
        self.mark = f"{tag} {_DIGITS.sub('0', ' '.join(self.names))}".encode("utf-8", "surrogatepass")
        role = (found.get("role") or "").lower()
        self.bare = not self.names and not role
        self.block, self.raw = tag in BLOCK, tag in RAW
        self.empty = tag in VOID or (tag in ("path", "circle", "rect", "use") and attributes.endswith("/"))
        commented = any(n in COMMENTS for n in self.names)
        marked = tag in ("article", "main") or role in ("article", "main") or found.get("itemprop", "").lower() == "articlebody" \
            or any(n in ARTICLE_NAMES for n in self.names)
        self.aside = commented or tag in ("aside", "nav", "footer")
        self.article = marked and not commented
        self.furniture = commented if marked else (
            tag in NEVER or role in ROLES or "hidden" in found or found.get("aria-hidden") == "true"
            or "display:none" in found.get("style", "").replace(" ", "").lower() or any(map(_is_furniture, self.names)))


class Element:
    __slots__ = ("tag", "kind", "parent", "first", "end", "furniture", "article", "holds_article", "away", "texts", "linked", "digest", "parts")

    def __init__(self, kind: Kind, parent, first: int):
        self.tag, self.kind, self.parent, self.first, self.end = kind.tag, kind, parent, first, first
        self.digest, self.parts, self.texts, self.linked = b"", [], 0, 0
        self.furniture, self.article, self.holds_article = kind.furniture, kind.article, False
        #: lies in a side matter, whatever articles it holds
        self.away = parent is not None and (parent.away or parent.kind.aside)


_KINDS: dict[str, Kind] = {}
#: Spellings that a worker remembers, and their length.
REMEMBERED = 4096
LONGEST = 200


def _kind(spelling: str, closing: bool, tag: str, attributes: str) -> Kind:
    kind = Kind(closing, tag.lower(), attributes)
    if len(_KINDS) >= REMEMBERED:
        _KINDS.clear()
    if len(spelling) <= LONGEST and not spelling.count('"') % 2 and not spelling.count("'") % 2:
        _KINDS[spelling] = kind
    return kind


class Page:
    """``pieces``: texts, and None where a block begins or ends; ``elements``: what covers ``pieces[first:end]``, in order
    of their beginning; ``digest`` hashes an element's subtree (names, classes and texts, digits alike)."""

    def __init__(self, source: str):
        self.pieces: list[str | None] = []
        self.elements: list[Element] = []
        self._read(source)

    # -------------------------------------------------------------- reading
    def _read(self, s: str) -> None:
        self.root = Element(Kind(False, "", ""), None, 0)
        self.stack = [self.root]
        at, gt, no_quote = 0, -1, set()
        while True:
            lt = s.find("<", at)
            if lt < 0:
                self._text(s[at:])
                break
            if lt > at:
                self._text(s[at:lt])
            if gt < lt:
                gt = s.find(">", lt)
                if gt < 0:
                    gt = len(s)
            kind = _KINDS.get(s[lt:gt + 1]) if gt - lt < LONGEST else None
            if kind is not None:
                at = gt + 1
            else:
                m = _TAG.match(s, lt)
                if m is None:
                    if s.startswith("<!--", lt):
                        end = s.find("-->", lt + 2)
                        at = end + 3
                    elif s[lt + 1:lt + 2] in ("!", "?", "/"):
                        end = gt if gt < len(s) else -1
                        at = gt + 1
                    else:
                        self._text("<")
                        end, at = lt, lt + 1
                    if end < 0:  # the page ends within a comment
                        break
                    continue
                end, at = _tag_end(s, m.end(), no_quote)
                if at < 0:  # the page ends within a tag
                    break
                kind = _kind(s[lt:at], bool(m[1]), m[2], s[m.end():end])
            if kind.closing:
                self._close(kind)
            else:
                self._open(kind)
                if kind.raw:
                    found = _RAW_END[kind.tag].search(s, at)
                    if found is None:
                        break
                    at = found.start()
        while len(self.stack) > 1:
            self._pop()
        self.root.end = len(self.pieces)

    def _text(self, raw: str) -> None:
        if not raw:
            return
        text = html.unescape(raw) if "&" in raw else raw
        self.pieces.append(text)
        words = text.split()
        if words:
            own = self.stack[-1]
            own.texts += 1
            own.parts.append(xxhash.xxh3_64_digest(_DIGITS.sub("0", " ".join(words)).encode("utf-8", "surrogatepass")))

    def _open(self, kind: Kind) -> None:
        tag = kind.tag
        if kind.raw or tag in SKIPPED:
            return
        if tag in CLOSES_P:
            self._close_open(_P, BARRIER)
        if tag in IMPLIED:
            self._close_open(*IMPLIED[tag])
        if kind.block:
            self.pieces.append(None)
        if kind.empty:
            if tag == "br":
                self.pieces.append("\n")
            return
        e = Element(kind, self.stack[-1], len(self.pieces))
        if tag == "header" and not e.furniture and not e.article:
            e.furniture = not self._in_article()
        if e.article:
            up, n = e.parent, 0
            while up is not None and not up.holds_article and n < DEPTH:
                up.holds_article, up, n = True, up.parent, n + 1
        self.elements.append(e)
        self.stack.append(e)

    def _in_article(self) -> bool:
        return any(e.article for e in self.stack[-DEPTH:])

    def _close_open(self, which: set, stop: set) -> None:
        """Close the innermost open element of ``which`` and all within it, unless one of ``stop`` stands before it."""
        stack = self.stack
        for i in range(len(stack) - 1, max(len(stack) - DEPTH, 0), -1):
            if stack[i].tag in which:
                while i > 1 and stack[i - 1].tag in which and stack[i - 1].tag != "p":
                    i -= 1
                while len(stack) > i:
                    self._pop()
                return
            if stack[i].tag in stop:
                return

    def _close(self, kind: Kind) -> None:
        stack, tag = self.stack, kind.tag
        if tag == "br":
            self.pieces.append("\n")
        if tag in SKIPPED or kind.empty or kind.raw:
            return
        inline = not kind.block
        for i in range(len(stack) - 1, max(len(stack) - DEPTH, 0), -1):
            own = stack[i].tag
            if own == tag:
                while len(stack) > i:
                    self._pop()
                return
            if (inline and own in BLOCK) or (own in BARRIER and tag not in ("table", "tr", "tbody", "thead", "tfoot")):
                return

    def _pop(self) -> None:
        e = self.stack.pop()
        e.end = len(self.pieces)
        if e.kind.block:
            self.pieces.append(None)
        if e.parts:
            e.digest = xxhash.xxh3_64_digest(e.kind.mark + b"".join(e.parts))
            e.parent.parts.append(e.digest)
        e.parent.texts += e.texts
        e.parent.linked += e.texts if e.tag == "a" else e.linked
        e.parts = None

    # -------------------------------------------------------------- text
    def text(self, spans: list[tuple[int, int]], gone: list[tuple[int, int]]) -> str:
        """The blocks of the pieces within ``spans`` and outside of ``gone``, white space as one space, joined by a space."""
        keep = [0] * (len(self.pieces) + 1)
        for a, b in _merged(spans):
            keep[a] += 1
            keep[b] -= 1
        cut = [0] * (len(self.pieces) + 1)
        for a, b in gone:
            cut[a] += 1
            cut[b] -= 1
        out, inside, away = [], 0, 0
        for i, piece in enumerate(self.pieces):
            inside, away = inside + keep[i], away + cut[i]
            if piece is None or not inside or away:
                out.append(" ")
            else:
                out.append(piece)
        return " ".join("".join(out).split())


def _merged(spans):
    out = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], b))
        else:
            out.append((a, b))
    return out


def _tag_end(s: str, at: int, no_quote: set) -> tuple[int, int]:
    """(end of the attributes, place after the tag); a quoted value may hold a ``>``, an open quote does not."""
    while True:
        at = _PLAIN.match(s, at).end()
        if at == len(s):
            return -1, -1
        if s[at] == ">":
            return at, at + 1
        end = -1 if s[at] in no_quote else s.find(s[at], at + 1)
        if end < 0:
            no_quote.add(s[at])
        at = max(end, at) + 1


def _is_furniture(name: str) -> bool:
    words = _WORD.findall(name)
    return bool(words) and words[0] not in STATES and (words[0] in FURNITURE or words[-1] in FURNITURE)
