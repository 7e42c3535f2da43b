"""Main text of web pages by template deduction from token equivalence classes.

A page's tokens are its tags, each with the path of elements around it, and its
text runs.  A token's occurrence vector over the pages of a
host says how often it occurs in each.  Vectors are never held: they are added up as
a fingerprint (the sum of a hash of page and count), combined map-side, so a host
that holds a third of all pages costs no more per task than any other.  Tokens of a
host with equal fingerprints form an equivalence class.  A class is valid if it
occurs in enough of the host's pages and has a tag; a text run belongs to the
template if its class is valid, or if nearly all pages that have the text's element
have the text (some may be cut off).  Valid classes nest by the paths of their
tags into the host's template, and what lies between template tokens is a slot.

Of the template the extractor keeps the element whose slots hold the main text
(an article, else the main element, else the element under which most
of the host's free text lies) and the texts of the template.  A page's text
is what its slots in that element hold, without menus, headers, footers, asides,
notices, adverts, forms, comments, scripts and styles, nor template texts.  Inside an
article or main element a text is the template's only if FEW pages or more have it,
so hosts with few pages are read by tag names there; a page of nothing but template
texts there keeps them.  A page that lacks its host's element is read by the same rules on its own.

Templates are sent to all tasks if they are small (their size is checked), and
joined by host otherwise.

Cases: null and empty pages have no text and count in no vector; markup that is cut off or badly nested
is read as far as it goes; a null url's host is the empty one; repeated rows each
get their text (they count as one page in the vectors if page_id is equal);
extra columns don't matter; an empty table gives an empty result.
"""

from __future__ import annotations

import html
import re
import zlib
from collections import Counter

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skywave.llm.common import mapped, stored

#: Pages of a host that a class must occur in.
SUPPORT = 0.5
#: Share of an element's pages that a text must occur in to be the template's whatever its class.
NEARLY = 0.9
#: Pages that a text must occur in to count as the template's inside an article or main.
FEW = 10
#: Bytes of templates that may be broadcast.
BROADCAST = 16 << 20

#: A tag that isn't closed ends where the next one begins, so that no place is looked at again and again.
_TAG = re.compile(r"""<!--.*?(?:-->|\Z)|<!\[CDATA\[(.*?)(?:\]\]>|\Z)|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/<>]*)((?:[^<>"']|"[^"]*"|'[^']*')*)>""", re.S)
_ATTRIBUTE = re.compile(r"""([a-zA-Z-]+)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""")
_CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template textarea title iframe svg math object select".split())
SKIPPED = frozenset("nav header footer aside form button menu dialog head".split()) | RAW
INLINE = frozenset("a abbr b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp small span strong sub sup time tt u var wbr img".split())
CLOSES_P = frozenset("address article aside blockquote details div dl fieldset figure footer form h1 h2 h3 h4 h5 h6 header hr main nav ol p pre section table ul".split())
BOILERPLATE = re.compile(r"(?:^|[\s_-])(?:ads?|advert\w*|banner|promo\w*|sponsor\w*|nav\w*|menu|breadcrumbs?|sidebar|footer|header|masthead|cookies?|consent|notice|"
                         r"popup|modal|newsletter|subscribe|share|social|related|comments?|replies|disqus|pagination|pager|widget)(?:$|[\s_-])", re.I)
#: Names of layouts ('has-sidebar'), and boilerplate that never holds a page's main text.
LAYOUT = re.compile(r"(?:has|with|without|no)[_-]", re.I)
ASIDE = re.compile(r"(?:^|[\s_-])(?:ads?|advert\w*|promo\w*|sponsor\w*|cookies?|consent|popup|modal|newsletter|subscribe|share|social|related|comments?|replies|disqus|widget)(?:$|[\s_-])", re.I)
CONTENT = re.compile(r"(?:^|[\s_-])(?:article|post|entry|content|story|main)(?:$|[\s_-])", re.I)


class Page:
    """A page's tags with their counts, and its blocks of text outside boilerplate
    elements: (path of the element, text, in a link).  An element that only its class
    or id names boilerplate isn't skipped if it holds the page's article or main or
    more than half of its text."""

    def __init__(self, text: str):
        self.blocks: list[tuple[tuple[str, ...], str, bool]] = []
        self.tags: Counter[str] = Counter()
        self._run: list[str] = []
        self._found: list[tuple[tuple[str, ...], str, bool, tuple[int, ...]]] = []
        self._kinds: list[tuple[int, ...]] = []               # of each article or main, the elements around it that are boilerplate by name
        self._aside: list[bool] = []                          # of each such element
        # open elements: name, path of the non-inline ones, in boilerplate, in a link, elements around that are boilerplate by name
        stack: list[tuple[str, tuple[str, ...], bool, bool, tuple[int, ...]]] = [("", (), False, False, ())]
        at, size, search, run = 0, len(text), _TAG.search, self._run
        last = text.rfind(">") + 1                             # behind it are no tags, but a comment may begin there
        if (comment := text.find("<!--", last)) >= 0:
            size = comment
        while at < size:
            m = search(text, at, last)
            end = m.start() if m else size
            if end > at and not stack[-1][2]:
                run.append(text[at:end])
            if not m:
                break
            at = size if m.group().startswith("<!--") and not m.group().endswith("-->") else m.end()
            cdata, closing, name, attributes = m.groups()
            if cdata is not None and not stack[-1][2]:
                run.append(html.escape(cdata))
            if name is None:
                continue
            name = name.lower()
            inline = name in INLINE
            if run and not inline:
                self._close(stack[-1])
            if closing:
                for i in range(len(stack) - 1, 0, -1):
                    if stack[i][0] == name:
                        if inline and i < len(stack) - 1:      # inline elements end alone; what is open inside stays open
                            inner, own = stack[i + 1:], stack[i][2] and not stack[i - 1][2]
                            del stack[i:]
                            for n, path, skip, _, named in inner:
                                up = stack[-1]
                                stack.append((n, up[1] if n in INLINE else up[1] + path[-1:], up[2] or (n in SKIPPED if own else skip), up[3] or n == "a", named))
                        else:
                            del stack[i:]
                        break
                continue
            if name in CLOSES_P:
                for i in range(len(stack) - 1, 0, -1):
                    if stack[i][0] == "p":
                        del stack[i:]
                        break
                    if stack[i][0] not in INLINE:
                        break
            _, path, skip, linked, named = stack[-1]
            label, boiler, names = self._label(name, attributes) if attributes else (name, name in SKIPPED, "")
            if names and inline:
                boiler = True
            elif names and not boiler and not skip and name not in VOID:
                named = (*named, len(self._aside))
                self._aside.append(bool(ASIDE.search(names)))
            if not skip and not boiler and _kind((label,)):
                self._kinds.append(named)
            self.tags["/".join((*path, label))] += 1
            if name in RAW and not attributes.rstrip().endswith("/"):
                close = re.compile(f"</{re.escape(name)}[\\s>/]", re.I).search(text, at)
                at = text.find(">", close.start()) + 1 or size if close else size
            elif name not in VOID:
                stack.append((name, path if inline else (*path, label), skip or boiler, linked or name == "a", named))
        if run:
            self._close(stack[-1])
        free = self._freed() if self._aside else set()
        self.blocks = [b[:3] for b in self._found if free.issuperset(b[3])]

    def _freed(self) -> set[int]:
        """Elements that are boilerplate by name and hold the main text nevertheless, outermost first."""
        free: set[int] = set()
        first = lambda named: next((x for x in named if x not in free), None)
        size = sum(len(b[1]) for b in self._found if not b[2])
        while True:
            kinds = [first(k) for k in self._kinds]
            more = set() if None in kinds else set(kinds)
            chars: Counter[int | None] = Counter()
            for _, words, linked, named in self._found:
                chars[first(named)] += 0 if linked else len(words)
            more |= {x for x, n in chars.items() if x is not None and 2 * n > size}
            more = {x for x in more if not self._aside[x]}
            if not more:
                return free
            free |= more

    @staticmethod
    def _label(name: str, attributes: str) -> tuple[str, bool, str]:
        """The label, whether the element is boilerplate, and its class names and id if they say so."""
        boiler, label, named = name in SKIPPED, name, ""
        if "=" in attributes or "hidden" in attributes:
            found = {k.lower(): a or b or c for k, a, b, c in _ATTRIBUTE.findall(attributes)}
            names = _CAMEL.sub("-", f"{found.get('class', '')} {found.get('id', '')}".strip())
            if names and name not in INLINE:
                label = f"{name}.{' '.join(sorted(found.get('class', '').split()))}" if found.get("class") else name
            role = found.get("role", "").lower()
            if names and name not in ("html", "body", "article", "main"):
                named = " ".join(x for x in names.split() if BOILERPLATE.search(x) and not LAYOUT.match(x))
            boiler = boiler or role in ("navigation", "banner", "contentinfo", "complementary", "search", "form", "dialog", "alert")
            boiler = boiler or bool(re.search(r"(?:^|\s)hidden(?:\s|$|=)", attributes)) or "display:none" in found.get("style", "").replace(" ", "")
            if role == "main":
                label = "main"
            elif role == "article" or found.get("itemprop") == "articleBody":
                label = "article"
        return label, boiler, named

    def _close(self, element) -> None:
        words = " ".join(html.unescape("".join(self._run)).split())
        if words:
            self._found.append((element[1], words, element[3], element[4]))
        self._run.clear()


def _kind(path: tuple[str, ...]) -> str | None:
    """article or main, if the path goes through one."""
    return next((k for k in ("article", "main") if any(p == k or p.startswith(k + ".") for p in path)), None)


def _hash(*parts: str) -> int:
    """A 64-bit hash, signed."""
    raw = "\x1f".join(parts).encode(errors="surrogatepass")
    x = (zlib.crc32(raw) << 32 | zlib.crc32(raw[::-1], 0x5BD1E995)) * 0x9E3779B97F4A7C15 & (1 << 64) - 1
    x = (x ^ x >> 32) * 0xD6E8FEB86659FD93 & (1 << 64) - 1
    return (x ^ x >> 32) - (1 << 63)


def host(url: Column) -> Column:
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//(?:[^/@?#]*@)?([^/:?#]*)", 1))


def _tokens(batches):
    """(host, token, kind, pages, print, chars) summed over this batch; kind t: tag, x: text run, y: one in an article or main, p: the page itself."""
    for b in batches:
        sums: dict[tuple[str, str, str], list[int]] = {}
        for h, page_id, text in zip(*(b.column(i).to_pylist() for i in range(3))):
            page = Page(text or "")
            if not page.blocks and not page.tags:
                continue
            found: list[tuple[str, str, int, int]] = [("", "p", 1, 0)]
            chars: Counter[str] = Counter()
            texts: Counter[tuple[str, str]] = Counter()
            for path, words, linked in page.blocks:
                if not linked:
                    for i in range(len(path)):
                        chars["/".join(path[:i + 1])] += len(words)
                texts[f"{_hash('/'.join(path), words):x} {_hash('/'.join(path)):x}", "y" if _kind(path) else "x"] += 1
            found += [(t, "t", n, chars[t]) for t, n in page.tags.items()]
            found += [(t, k, n, 0) for (t, k), n in texts.items()]
            for token, kind, n, size in found:
                s = sums.setdefault((h, token, kind), [0, 0, 0])
                s[0] += 1
                s[1] += _hash(str(page_id), str(n)) >> 32  # 32 bits, so that the sum over all pages of a host stays a long
                s[2] += size
        keys = list(sums)
        yield pa.RecordBatch.from_arrays(
            [pa.array([k[j] for k in keys], pa.string()) for j in range(3)] + [pa.array([sums[k][j] for k in keys], pa.int64()) for j in range(3)],
            ["host", "token", "kind", "pages", "print", "chars"])


def deduce(tokens: list[dict]) -> dict:
    """The template of a host from its frequent tokens: the path of the element
    that holds the main text, and the texts that are its own."""
    pages = max((t["pages"] for t in tokens if t["kind"] == "p"), default=0)
    classes: dict[tuple[int, int], list[dict]] = {}
    for t in tokens:
        classes.setdefault((t["pages"], t["print"]), []).append(t)
    valid = [c for c in classes.values() if c[0]["pages"] >= SUPPORT * pages and any(t["kind"] == "t" for t in c)]
    # nest: a tag's parent is the nearest template tag that its path goes through
    template = {t["token"]: t for c in valid for t in c if t["kind"] == "t"}
    children: dict[str, list[str]] = {}
    for path in sorted(template):
        up = path
        while "/" in up:
            up = up.rpartition("/")[0]
            if up in template:
                break
        else:
            up = ""
        children.setdefault(up, []).append(path)

    def best(kind: str) -> str | None:
        paths = [p for p in template if (last := p.rpartition("/")[2]) == kind or last.startswith(kind + ".")]
        return max(paths, key=lambda p: (template[p]["chars"], -len(p), p), default=None)

    root = best("article") or best("main")
    if root is None:
        # down from the top into the child whose slots hold nearly all the free text
        root = max(children.get("", ()), key=lambda p: (template[p]["chars"], p), default=None)
        while root and (below := children.get(root)):
            inner = max(below, key=lambda p: (template[p]["chars"], p))
            if template[inner]["chars"] < 0.7 * template[root]["chars"] or inner.rpartition("/")[2].split(".")[0] in ("p", "h1", "li"):
                break
            root = inner
    least = {"x": 3, "y": FEW}
    of_tags = {(t["pages"], t["print"]) for t in template.values()}
    holders = {format(_hash(path), "x"): t["pages"] for path, t in template.items()}
    constant = []
    for t in tokens:
        if t["kind"] in least and t["pages"] >= max(least[t["kind"]], SUPPORT * pages):
            text, _, holder = t["token"].partition(" ")
            if (t["pages"], t["print"]) in of_tags or t["pages"] >= NEARLY * holders.get(holder, pages):
                constant.append(text)
    return {"element": root, "constant": constant}


def _deduced(batches):
    for b in batches:
        found = [deduce(t) for t in b.column("tokens").to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [b.column("host"), pa.array([f["element"] for f in found], pa.string()), pa.array([f["constant"] for f in found], pa.list_(pa.string()))],
            ["host", "element", "constant"])


def templates(pages: DataFrame) -> DataFrame:
    """(host, element, constant) from the pages (host, page_id, html)."""
    sums = (pages.select("host", "page_id", "html").transform(mapped, _tokens, "host string, token string, kind string, pages long, print long, chars long")
                 .groupBy("host", "token", "kind").agg(F.sum("pages").alias("pages"), F.sum("print").alias("print"), F.sum("chars").alias("chars")))
    whole = sums.filter("kind = 'p'").select("host", F.col("pages").alias("all"))
    # frequent tokens of a host: at most twice as many as a page has
    frequent = sums.join(whole, "host").filter(F.col("pages") >= SUPPORT * F.col("all"))
    return (frequent.groupBy("host").agg(F.collect_list(F.struct("token", "kind", "pages", "print", "chars")).alias("tokens"))
                    .transform(mapped, _deduced, "host string, element string, constant array<string>"))


def extract(text: str | None, element: str | None = None, constant: frozenset[str] = frozenset()) -> str:
    """The main text of a page under its host's template."""
    free = Page(text or "").blocks
    root = tuple(element.split("/")) if element else ()
    inside = [b for b in free if b[0][:len(root)] == root] if root else []
    if not inside or _kind(root) is None:
        for kind in ("article", "main"):
            if own := [b for b in free if _kind(b[0]) == kind]:
                inside = own
                break
    elif _kind(root) == "article":                       # a page with several articles of its own
        inside = [b for b in free if _kind(b[0]) == "article"]
    if not inside:
        inside = [b for b in free if any(CONTENT.search(p.partition(".")[2]) for p in b[0])] or free
    own = [b for b in inside if format(_hash("/".join(b[0]), b[1]), "x") not in constant] if constant else inside
    if any(_kind(b[0]) for b in inside):
        return "\n".join(words for _, words, _ in own or inside)
    return "\n".join(words for _, words, linked in own if not linked)


def _extracted(batches):
    for b in batches:
        texts = [extract(t, e, frozenset(c or ())) for t, e, c in zip(*(b.column(n).to_pylist() for n in ("html", "element", "constant")))]
        yield pa.RecordBatch.from_arrays([b.column("page_id"), b.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                                         ["page_id", "url", "text", "n_chars"])


def extracted(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars)."""
    rows = pages.select("page_id", F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"), host(F.col("url").cast("string")).alias("host"))
    known = stored(templates(rows))
    size = known.agg(F.sum(F.length(F.coalesce("element", F.lit(""))) + F.length("host") + 20 * F.size("constant"))).first()[0] or 0
    joined = rows.join(F.broadcast(known) if size <= BROADCAST else known, "host", "left")
    kind = rows.schema["page_id"].dataType.simpleString()
    return joined.select("page_id", "url", "html", "element", "constant").transform(mapped, _extracted, f"page_id {kind}, url string, text string, n_chars long")
