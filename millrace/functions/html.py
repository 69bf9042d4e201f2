"""What only a parser can tell of a page: Arrow-batched functions over html and the page's own URL."""

from __future__ import annotations

import re
from functools import lru_cache
from html import unescape
from html.parser import HTMLParser
from urllib.parse import parse_qsl, urlencode, urljoin, urlsplit

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from .lexicon import EMAIL

SCHEMA = "title string, meta_description string, links array<string>, scripts array<string>, iframes array<string>, footer string, emails array<string>, hits array<string>"
#: Characters of a page's text that the lexicons see where a sample is asked for; e-mail addresses are taken from all of it.
TEXT_CHARS = 8000
#: The last ones of what the lexicons see, in which the footer is.
FOOTER_CHARS = 4000


def host_of(place: str) -> str:
    host = place.strip().lower().strip(".").split(":")[0].strip(".")
    return host.removeprefix("www.")


def absolute(ref: str, base: str) -> str | None:
    """Normal form of a link on a page, null for what is no http(s) URL."""
    ref = ref.strip()
    if not ref or ref.startswith(("#", "javascript:", "mailto:")):
        return None
    try:
        parts = urlsplit(urljoin(base, f"https:{ref}" if ref.startswith("//") else ref))
        port, host = parts.port, host_of(parts.hostname or "")
    except ValueError:
        return None
    if parts.scheme not in ("http", "https") or not host:
        return None
    secure = port == 443 or (port is None and parts.scheme == "https")
    query = urlencode(sorted(parse_qsl(parts.query, keep_blank_values=True)))
    path = re.sub(";[^/]*$", "", parts.path) or "/"
    return f"http{'s' * secure}://{host}{'' if port in (None, 80, 443) else f':{port}'}{path}{'?' * bool(query)}{query}"


_ORIGIN = re.compile(r"https?://[a-zA-Z0-9.:-]+(?=[/?#]|\Z)")
_ROOTED = re.compile(r"(?:/[\w-][\w.-]*)+/?\Z")
_WHOLE = re.compile(r"(https?://)(?:www\.)?((?!www\.)[a-z0-9-]+(?:\.[a-z0-9-]+)+)((?:/[\w-][\w.-]*)*/?)\Z")
_absolute = lru_cache(1 << 14)(absolute)


class Links:
    """absolute() for the links of one page. What has nothing to be changed in it is put together at once."""

    def __init__(self, base: str) -> None:
        origin = _ORIGIN.match(base)
        self.base, self.origin = base, origin and f"{origin[0]}/"
        self.root = origin and (_absolute("/", self.origin) or "")[:-1]

    def of(self, ref: str) -> str | None:
        if self.root:
            if _ROOTED.match(ref):
                return self.root + ref
            if found := _WHOLE.match(ref):
                return f"{found[1]}{found[2]}{found[3] or '/'}"
            if ref[0] == "/" and ref[:2] != "//":  # takes no more than the origin from a page
                return _absolute(ref, self.origin)
        return absolute(ref, self.base)


_ATTRS = r'(?: +[a-z][a-z:-]*="[^"<>&]*(?:&(?:amp|lt|gt|quot);[^"<>&]*)*")*'
_ATTR = re.compile(r' +([a-z:-]+)="([^"]*)"')
_SILENT = r"[^<]*(?:<(?!/\s*(?i:script|style)|!--)[^<]*)*"  # of scripts and styles
#: What every version of the parser reads alike, from the start of a page: text, tag and attributes, title, and the first place that isn't so, with all that follows.
_TOKEN = re.compile(
    rf"([^<]+)|<(?:/(?!(?:script|style|title)>)[a-z][a-z0-9]*>|(a|area|link|meta)({_ATTRS}) */?>"
    rf"|(?!(?:script|style|iframe|title|textarea|xmp|noembed|noframes|noscript|plaintext)[ />])[a-z][a-z0-9]*{_ATTRS} */?>"
    rf"|(?:(script)({_ATTRS})|style{_ATTRS})>{_SILENT}</(?(4)script|style)>|(iframe)({_ATTRS})></iframe>|title>([^<]*)</title>"
    r"|!--(?!-?>)[^-]*(?:-[^-]+)*-->|!(?:DOCTYPE|doctype) [^<>]*>)|(<)(?s:.*)"
)


class _Page(HTMLParser):
    """Links of a and area, or of a and link; sources; title and description; visible text, the title's too."""

    def __init__(self, base: str) -> None:
        super().__init__(convert_charrefs=True)
        self.url = Links(base).of
        self.anchors, self.links, self.scripts, self.iframes = [], [], [], []
        self.description, self.title, self.text = "", [], []
        self.silent, self.in_title = 0, False

    def handle_starttag(self, tag, attrs):
        own = {k: v or "" for k, v in attrs}
        self.silent += tag in ("script", "style")
        self.in_title |= tag == "title"
        if tag == "meta" and own.get("content"):
            if own.get("name", "").lower() == "description" or (own.get("property", "").lower() == "og:description" and not self.description):
                self.description = own["content"].strip()
        for tags, name, out in ((("a", "area"), "href", self.anchors), (("a", "link"), "href", self.links), (("script",), "src", self.scripts), (("iframe",), "src", self.iframes)):
            if tag in tags and own.get(name) and (url := self.url(own[name])):
                out.append(url)

    def read(self, html: str) -> None:
        """A page of plain tokens by one expression, any other by the parser."""
        tokens = _TOKEN.findall(html)
        if tokens and tokens[-1][-1]:
            self.feed(html)
            self.close()
            return
        for text, tag, attrs, script, of_script, frame, of_frame, title, _ in tokens:
            if text or title:
                self.in_title = not text
                data = text or title
                self.handle_data(unescape(data) if "&" in data else data)
                self.in_title = False
            elif attrs or of_script or of_frame:
                self.handle_starttag(tag or script or frame, [(k, unescape(v) if "&" in v else v) for k, v in _ATTR.findall(attrs or of_script or of_frame)])
                self.silent = 0

    def handle_endtag(self, tag):
        self.silent = max(0, self.silent - (tag in ("script", "style")))
        self.in_title &= tag != "title"

    def handle_data(self, data):
        if self.silent:
            return
        if self.in_title:
            self.title.append(data)
        if data.strip():
            self.text.append(data)


def parsed(html: str | None, base: str | None) -> _Page:
    """As far as the parser gets: an error ends a page, not the job."""
    page = _Page(base or "")
    try:
        page.read(html or "")
    except Exception:  # noqa: BLE001
        pass
    return page


def text_of(html: str | None) -> str:
    """The text of signals_of()."""
    tokens = _TOKEN.findall(html or "")
    if tokens and tokens[-1][-1]:
        parts = parsed(html, None).text
    else:
        parts = [x[0] or x[7] for x in tokens]
        parts = [t for t in (unescape(t) if "&" in t else t for t in parts) if t.strip()]
    return " ".join("".join(parts).split())[:TEXT_CHARS]


def signals_of(html: str | None, base: str | None, chars: int | None = TEXT_CHARS) -> tuple:
    """Title, description, links, scripts, iframes, the first `chars` of the text (None: all of it) and the addresses of a page."""
    page = parsed(html, base)
    words = "".join(page.text).split()
    text, marked = " ".join(words), " ".join(w for w in words if "@" in w)  # an address has no white space
    return " ".join("".join(page.title).split()), page.description, page.links, page.scripts, page.iframes, text[:chars], sorted(set(re.findall(EMAIL, marked)))


def hits_in(text: str, terms: list[str]) -> list[str]:
    """As text.hits(), of a text that isn't in lower case yet."""
    low = text.lower()
    return [t for t in terms if t in low]


def page_signals(html: Column, base: Column, terms: list[str], chars: int | None = TEXT_CHARS) -> Column:
    """signals_of(), with the terms that the text holds, and its end, for the text itself."""
    terms = sorted(set(terms))

    @F.pandas_udf(SCHEMA)
    def signals(pages: pd.Series, bases: pd.Series) -> pd.DataFrame:
        names = [c.split()[0] for c in SCHEMA.split(", ")]
        made = (signals_of(p, b, chars) for p, b in zip(pages, bases))
        return pd.DataFrame([(*own, text[-FOOTER_CHARS:].strip(), emails, hits_in(text, terms)) for *own, text, emails in made], columns=names)

    return signals(html, base)


def page_hits(html: Column, terms: list[str]) -> Column:
    """The terms that a page's text holds, as page_signals() has them: no link is resolved for it."""
    terms = sorted(set(terms))

    @F.pandas_udf("array<string>")
    def hits(pages: pd.Series) -> pd.Series:
        return pd.Series([hits_in(text_of(p), terms) for p in pages], dtype=object)

    return hits(html)


def page_links(html: Column, base: Column) -> Column:
    """Targets of a and area in document order, each once."""

    @F.pandas_udf("array<string>")
    def links(pages: pd.Series, bases: pd.Series) -> pd.Series:
        return pd.Series([list(dict.fromkeys(parsed(p, b).anchors)) for p, b in zip(pages, bases)], dtype=object)

    return links(html, base)
