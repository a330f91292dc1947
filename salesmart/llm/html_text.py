"""Main text of pages by equivalence classes of tokens over a host's pages.

A page is a sequence of tokens: tags (name, class, id) and text blocks, each
told apart by the elements around it. Over all pages of a host every token has
an occurrence vector (how often it occurs on each page); tokens with the same
vector form an equivalence class. Vectors are never built: a class is known by
the xor of a hash of (page, count) over distinct pages, which partial aggregates
combine, so a host with a third of all pages is spread over its tokens. A class is valid when
``MIN_PAGES`` of the host's pages have it, however many others there are
(another layout, another site), and it holds at least two tokens; a text of
several words that most pages have is valid alone. On a page the tokens of a
class must stand in the order they have on the host's pages, and the other
classes must nest: all occurrences of a token in one gap between tokens of the
page's root class, the one on most of the host's pages. What is out of order or
not nested is no template there. The template's tokens (menus, notices and
frames that repeat) are taken out, and the slots between them are data.

Copies of an article repeat as well. Inside an article only texts that most of
the host's pages with an article have are template; of a page that the template
would empty, texts that only fewer pages have stay.

Of the slots the article is kept: those inside the page's ``article`` or
``main`` element where it has one, else those in the template's own slot: the
deepest place between block tags that most of the host's unmarked pages have and
that holds most of their text outside the template. Where no slot does, or it has
no text on the page, all slots that are not boilerplate are kept. An article of which the template would leave nothing keeps its text. Never kept are menus, headers, footers, side bars, notices, adverts,
forms, scripts, styles or reader comments, told by element, role, class and id. Inline tags join their text, other tags separate blocks.

Hosts are joined to their template by broadcast while the template table is
small, else by a salted join. Defined cases: null html is empty; a null url is
a host of its own; a page without text gives an empty string; markup that is
never closed ends with its parent; a tag without an end is text, and after a
quote in a tag that is never closed tags end at their first ``>``; repeated rows give repeated results; an
empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import html as htmllib
import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from itertools import accumulate

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesmart.llm.shared import salted_join, stored

MIN_PAGES = 5            # pages a host needs for a template
MOST_PAGES = 0.5         # share of them that is most of them
MIN_CLASS = 2            # tokens in a valid class
MOST_TEXT = 0.5          # share of the text of unmarked pages that their slot has
BROADCAST_TOKENS = 200_000
KNOWN_HOSTS = 1000       # templates a task remembers

_NAME = re.compile(r"</?([a-zA-Z][^\s/>]*)")
_QUOTE_OR_END = re.compile("[>\"']")
_ATTRIBUTE = re.compile(r"([^\s=/\"'<>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript textarea title template xmp iframe noembed noframes".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd mark q rp rt ruby s samp "
                   "small span strike strong sub sup time tt u var wbr".split())
OPTIONAL_END = frozenset("p li dt dd tr td th option thead tbody tfoot".split())
MAIN = frozenset("article main".split())
DROPPED = frozenset("nav aside footer form script style noscript template head title button select textarea iframe "
                    "object svg canvas audio video menu dialog datalist xmp noembed noframes".split())
ROLES = frozenset("navigation banner contentinfo complementary search dialog alertdialog alert form menu menubar".split())
BOILER = frozenset("ad ads advert adverts advertisement advertising adsense sponsor sponsored sponsors promo promotion banner "
                   "cookie cookies consent gdpr notice notices notification popup modal overlay newsletter subscribe "
                   "subscription signup login share sharing social sidebar menu navbar nav navigation breadcrumb "
                   "breadcrumbs footer header masthead related recommended recommendations widget widgets toolbar "
                   "pagination pager search disqus taboola outbrain".split())
COMMENTS = frozenset("comment comments reply replies respond discussion disqus".split())


# token -> (number of its class, that on most pages being 0; its place in the
# class; whether most pages have it)
Template = dict[int, tuple[int, int, bool]]


def as_template(tokens: list[tuple]) -> Template:
    """The template of a host from (token, vector, mean first position, pages,
    whether these are most): classes by pages and size, tokens by position."""
    classes: dict[tuple[int, int], list[tuple[float, int]]] = {}
    common: dict[int, bool] = {}
    for token, vector, position, *support in tokens:
        pages, common[token] = support or (0, True)
        classes.setdefault((pages, vector), []).append((position, token))
    ordered = sorted((-pages, -len(members), sorted(members)) for (pages, _), members in classes.items())
    return {token: (number, place, common[token]) for number, (_, _, members) in enumerate(ordered)
            for place, (_, token) in enumerate(members)}


def _in_order(seen: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The occurrences of a class less those out of order: a longest run of
    first occurrences with growing places, and their repetitions."""
    first: dict[int, int] = {}
    for position, place in seen:
        first.setdefault(place, position)
    ends: list[int] = []
    chains: list[tuple[int, int | None]] = []  # place, chain it continues
    tops: list[int] = []
    for place in first:  # by position
        k = bisect_left(ends, place)
        chains.append((place, tops[k - 1] if k else None))
        if k == len(ends):
            ends.append(place)
            tops.append(len(chains) - 1)
        else:
            ends[k], tops[k] = place, len(chains) - 1
    kept, at = set(), tops[-1] if tops else None
    while at is not None:
        kept.add(chains[at][0])
        at = chains[at][1]
    return [(position, place) for position, place in seen if place in kept]


class _Element:
    __slots__ = ("name", "parts", "role", "hidden", "start", "end", "parent", "closed", "main", "in_main", "path")

    def __init__(self, name: str, attributes: str, start: int, parent: int):
        self.name, self.start, self.end, self.parent, self.closed = name, start, -1, parent, False
        self.role, self.hidden, self.main = "", False, name in MAIN
        parts: list[str] = []
        if attributes.strip(" /"):
            for key, a, b, c in _ATTRIBUTE.findall(attributes):
                key, value = key.lower(), a or b or c
                if key in ("class", "id"):
                    parts += (p.lower() for p in _PART.findall(value))
                elif key == "role":
                    self.role = value.strip().lower()
                elif key == "hidden" or (key == "itemprop" and value == "articleBody"):
                    self.hidden, self.main = self.hidden or key == "hidden", self.main or key == "itemprop"
        self.parts = tuple(parts)
        self.main = self.main or self.role in ("main", "article")

    def token(self) -> str:
        return ".".join((self.name, *self.parts))


class _Scanner:
    """Finds the tags of a page. A tag ends at the first ``>`` outside quotes;
    from a tag on that never ends so, tags end at their first ``>``; a ``<``
    without one is text. So no part of a page is looked at again and again."""

    def __init__(self, source: str):
        self.source, self.quotes = source, True

    def next(self, at: int) -> tuple[str, int, int, int] | None:
        """The first tag from ``at`` on: kind (open, close, cdata or skip),
        start, end, end of its name."""
        source = self.source
        while (start := source.find("<", at)) >= 0:
            name = _NAME.match(source, start)
            if not name:
                for kind, opening, closing in (("skip", "<!--", "-->"), ("cdata", "<![CDATA[", "]]>")):
                    if source.startswith(opening, start):
                        end = source.find(closing, start + len(opening))
                        return kind, start, end + 3 if end >= 0 else len(source), start
            if name or source[start + 1:start + 2] in ("!", "?"):
                end = source.find(">", start)
                if end < 0:
                    return None
                if not name:
                    return "skip", start, end + 1, start
                return "close" if source[start + 1] == "/" else "open", start, self._end(name.end()) + 1, name.end()
            at = start + 1
        return None

    def _end(self, at: int) -> int:
        j = at
        while self.quotes:
            mark = _QUOTE_OR_END.search(self.source, j)
            if mark and mark[0] == ">":
                return mark.start()
            j = self.source.find(mark[0], mark.end()) + 1 if mark else 0
            self.quotes = j > 0
        return self.source.find(">", at)


class Page:
    """The tokens and elements of one page."""

    def __init__(self, source: str):
        self.elements: list[_Element] = []
        self.tokens: list[tuple[str, int, str]] = []  # kind (text, open, close, break), element, text
        stack: list[int] = []
        depths: dict[str, list[int]] = {}  # of the open elements, by name
        mains: list[int] = []              # depths of the open articles
        length = len(source)

        def text(piece: str) -> None:
            if piece:
                self.tokens.append(("text", stack[-1] if stack else -1, piece))

        def close(depth: int, proper: bool) -> None:
            while len(stack) > depth:
                e = self.elements[stack.pop()]
                depths[e.name].pop()
                if e.main:
                    mains.pop()
                e.end, e.closed = len(self.tokens), proper and len(stack) == depth

        scanner = _Scanner(source)
        at = 0
        while at < length:
            found = scanner.next(at)
            if not found:
                text(source[at:])
                break
            text(source[at:found[1]])
            kind, start, at, name_end = found
            if kind == "cdata":
                text(source[start + 9:at].removesuffix("]]>"))
            if kind not in ("open", "close"):
                continue
            name = source[start + (2 if kind == "close" else 1):name_end].lower()
            if kind == "close":
                depth = depths[name][-1] if depths.get(name) else None
                # A stray end tag never closes the article around it.
                if depth is not None and not (mains and mains[-1] > depth):
                    self.tokens.append(("break" if name in INLINE else "close", stack[depth], ""))
                    close(depth, True)
                elif name not in INLINE:
                    self.tokens.append(("close", -1, ""))
                continue
            if name in OPTIONAL_END and stack and name == self.elements[stack[-1]].name:
                close(len(stack) - 1, True)
            elif name not in INLINE and name not in VOID and depths.get("p"):
                close(depths["p"][-1], True)
            parent = stack[-1] if stack else -1
            element = _Element(name, source[name_end:at - 1], len(self.tokens), parent)
            above = self.elements[parent] if parent >= 0 else None
            element.in_main = bool(above) and (above.main or above.in_main)
            element.path = above.path if above else ""
            if name not in INLINE and name not in OPTIONAL_END:
                element.path = xxhash.xxh3_128_hexdigest(f"{element.path}/{element.token()}")
            self.elements.append(element)
            number = len(self.elements) - 1
            self.tokens.append(("break" if name in INLINE else "open", number, ""))
            if name in VOID or (source[at - 2] == "/" and name in ("svg", "path")):
                element.end, element.closed = len(self.tokens), True
            else:
                depths.setdefault(name, []).append(len(stack))
                if element.main:
                    mains.append(len(stack))
                stack.append(number)
                if name in RAW:
                    end = re.compile(rf"</{re.escape(name)}\s*>", re.I).search(source, at)
                    at = end.end() if end else length
                    self.tokens.append(("close", number, ""))
                    close(len(stack) - 1, bool(end))
        close(0, False)
        self._settle()

    def _settle(self) -> None:
        """Boilerplate elements, article elements, and each token's state."""
        sizes = [0]
        for kind, _, piece in self.tokens:
            sizes.append(sizes[-1] + (len(piece.strip()) if kind == "text" else 0))
        mains = [e for e in self.elements if e.main and not self._comments(e)]
        starts = [e.start for e in mains]  # ascending
        n = len(self.tokens)
        dropped, articles_at = [0] * (n + 1), [0] * (n + 1)  # 1 where an element starts, -1 where it ends
        for e in self.elements:
            end = e.end if e.end >= 0 else n
            k = bisect_right(starts, e.start)
            holds_main = k < len(starts) and starts[k] < end
            if self._comments(e) and not (holds_main and not e.closed):
                drop = not (e.name in ("html", "body") or holds_main and e.name not in ("section", "div", "ol", "ul", "aside"))
            elif e.name in DROPPED or e.role in ROLES or e.hidden:
                drop = not holds_main
            elif e.name == "header":
                drop = not holds_main and not e.in_main
            elif not e.main and e.name not in ("html", "body") and e.name not in INLINE and BOILER.intersection(e.parts):
                most = sizes[-1] and (sizes[end] - sizes[e.start]) > 0.6 * sizes[-1]
                drop = not holds_main and not (most and not mains)
            else:
                drop = False
            if drop:
                dropped[e.start] += 1
                dropped[end] -= 1
        articles = [e for e in mains if e.name != "main" and e.role != "main"] or mains
        for e in articles:
            end = e.end if e.end >= 0 else n
            articles_at[e.start] += 1
            articles_at[end] -= 1
        self.out, self.inside = ([around > 0 for around in accumulate(steps)] for steps in (dropped, articles_at))
        self.has_main = bool(articles)

    def _comments(self, e: _Element) -> bool:
        return bool(COMMENTS.intersection(e.parts))

    def slots(self, fixed: set[int] = frozenset()) -> dict[int, tuple[int, int, int, int]]:
        """The slots between the block tags: id -> depth, first token, end,
        characters of text that is neither boilerplate nor ``fixed``. A slot is
        told by the path of its element, each step numbered among its equals."""
        chars = [0, *accumulate(len(piece.strip()) if kind == "text" and not self.out[i] and i not in fixed else 0
                                for i, (kind, _, piece) in enumerate(self.tokens))]
        ids: list[tuple[int, int]] = []
        equals: dict[tuple[int, str], int] = {}
        found = {}
        for e in self.elements:
            slot, depth = ids[e.parent] if e.parent >= 0 else (0, 0)
            if e.name not in INLINE and e.name not in OPTIONAL_END and e.name not in VOID:
                nth = equals[slot, e.token()] = equals.get((slot, e.token()), 0) + 1
                slot, depth = xxhash.xxh3_64_intdigest(f"{slot}/{e.token()}#{nth}"), depth + 1
                end = e.end if e.end >= 0 else len(self.tokens)
                found[slot] = (depth, e.start, end, chars[end] - chars[e.start])
            ids.append((slot, depth))
        return found

    def template_tokens(self) -> Iterator[tuple[int, int]]:
        """(position, hash) of the tokens that could belong to a template:
        tags and text; text inside an article is another token."""
        for position, (kind, element, piece) in enumerate(self.tokens):
            if kind == "break" or (kind == "text" and not piece.strip()):
                continue
            label = " ".join(piece.split()) if kind == "text" else kind
            path, name = (self.elements[element].path, self.elements[element].name) if element >= 0 else ("", "")
            kind = "article" if kind == "text" and self.inside[position] else kind
            yield position, xxhash.xxh3_64_intdigest(f"{path}>{name}|{kind}|{label}")

    def nested(self, template: Template) -> set[int]:
        """Positions of the tokens that this page has as the template does:
        each class in order, tokens of all others nested in one gap of the
        root."""
        found: dict[int, list[tuple[int, int]]] = {}
        for position, h in self.template_tokens():
            if h in template:
                number, place, _ = template[h]
                found.setdefault(number, []).append((position, place))
        top = min(found, default=0)
        root = [position for position, place in _in_order(found.get(top, []))]
        fixed = set(root)
        for number, seen in found.items():
            if number != top:
                gaps: dict[int, set[int]] = {}
                for position, place in seen:
                    gaps.setdefault(place, set()).add(bisect_left(root, position))
                fixed.update(position for position, _ in _in_order([x for x in seen if len(gaps[x[1]]) == 1]))
        return fixed

    def _kept(self, fixed: set[int]) -> bool:
        """Whether a slot that may be the article's has text."""
        return any(kind == "text" and (self.inside[position] or not self.has_main) and not self.out[position]
                   and position not in fixed and piece.strip() for position, (kind, _, piece) in enumerate(self.tokens))

    def _fixed(self, template: Template) -> set[int]:
        """Positions of the template, less what may be copied text."""
        fixed = self.nested(template)
        rare = {position for position, h in self.template_tokens() if h in template and not template[h][2]}
        fixed -= {position for position in rare if self.inside[position]}
        if not self._kept(fixed):
            fixed = set() if self.has_main else fixed - rare
        return fixed

    def _wanted(self, slot: int | None, fixed: set[int]) -> list[bool]:
        """Where the article may be: in the marked article, else in the host's
        ``slot`` should it have text here, else anywhere."""
        if self.has_main:
            return self.inside
        _, start, end, chars = self.slots(fixed).get(slot, (0, 0, 0, 0)) if slot is not None else (0, 0, 0, 0)
        return [not chars or start <= position < end for position in range(len(self.tokens))]

    def text(self, template: Template, slot: int | None = None) -> str:
        """The article: the slots left when template and boilerplate go."""
        fixed = self._fixed(template) if template else set()
        wanted = self._wanted(slot, fixed)
        parts = []
        for position, (kind, _, piece) in enumerate(self.tokens):
            if kind == "break":
                continue
            if kind != "text":
                parts.append(" ")
            elif wanted[position] and not self.out[position] and position not in fixed:
                parts.append(htmllib.unescape(piece))
        return " ".join("".join(parts).split())


def _signed(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x


def _host(url: str | None) -> str:
    found = re.match(r"[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#]*)", url or "")
    return found[1].lower() if found else ""


def _host_tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per (host, token, page): how often the page has it, its first position,
    whether it is text inside an article and the words it counts for; tokens 0
    and 1 count the host's pages and those with an article. Pages of a host
    with the same html are one page."""
    names = ["host", "token", "page", "n", "position", "inside", "words"]
    for batch in batches:
        for i in range(0, len(batch), 64):
            rows: list[tuple] = []
            for url, source in zip(*(c.to_pylist() for c in batch.slice(i, 64).columns)):
                host, source = _host(url), source or ""
                digest, page = _signed(xxhash.xxh3_64_intdigest(source)), Page(source)
                counts, first = {0: 1, 1: 1} if page.has_main else {0: 1}, {0: (0, 0, 1), 1: (0, 0, 1)}
                for position, h in page.template_tokens():
                    counts[h] = counts.get(h, 0) + 1
                    if h not in first:
                        kind, _, piece = page.tokens[position]
                        text = kind == "text"
                        first[h] = position, int(text and page.inside[position]), len(piece.split()) if text else 1
                rows += [(host, _signed(token), digest, n, *first[token]) for token, n in counts.items()]
            if rows:
                host, *numbers = zip(*rows)
                yield pa.RecordBatch.from_arrays([pa.array(host, pa.string()), *(pa.array(c, pa.int64()) for c in numbers)], names)


def token_counts(pages: DataFrame) -> DataFrame:
    """Of every host the tokens on ``MIN_PAGES`` pages, stored; tokens 0 and 1
    stand for its pages and those with a marked article."""
    once = (pages.select("url", "html")
            .mapInArrow(_host_tokens, "host string, token long, page long, n long, position long, inside long, words long")
            .groupBy("host", "token", "page").agg(*(F.max(c).alias(c) for c in ("n", "position", "inside", "words"))))
    return stored(once.groupBy("host", "token").agg(
        F.bit_xor(F.xxhash64("page", "n")).alias("vector"), F.count("*").alias("pages"), F.avg("position").alias("position"),
        F.max("inside").alias("inside"), F.max("words").alias("words"))
        .where(f"token in (0, 1) or pages >= {MIN_PAGES}"), "html-tokens")


def host_templates(pages: DataFrame, counts: DataFrame | None = None) -> DataFrame:
    """(host, token, vector, position, pages, common) of every valid
    equivalence class, from columns url, html; position is the mean
    first one, common says that most pages have the token (of text inside
    articles: most pages with one)."""
    tokens = token_counts(pages) if counts is None else counts
    hosts = (tokens.where("token in (0, 1)").groupBy("host")
             .agg(F.max(F.expr("case when token = 0 then pages end")).alias("all_pages"),
                  F.max(F.expr("case when token = 1 then pages end")).alias("main_pages")).where(f"all_pages >= {MIN_PAGES}"))
    rows = tokens.where("token not in (0, 1)").join(hosts, "host").withColumn(
        "common", F.expr(f"pages >= {MOST_PAGES} * case when inside = 1 then main_pages else all_pages end"))
    classes = (rows.groupBy("host", "vector").agg(F.count("*").alias("n"), F.max(F.when(F.col("common"), F.col("words"))).alias("words"))
               .where(f"n >= {MIN_CLASS} or words >= {MIN_CLASS}").select("host", "vector"))
    return rows.join(classes, ["host", "vector"]).select("host", "token", "vector", "position", "pages", "common")


def _open_template(tokens: pa.ListScalar) -> Template:
    return as_template([(t["token"] & (1 << 64) - 1, t["vector"], t["position"], t["pages"], t["common"]) for t in tokens.as_py() or ()])


def _page_slots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per page without a marked article: its slots, with depth and characters
    of text outside the template; slot 0 has them all."""
    known: dict[str, Template] = {}
    for batch in batches:
        rows: list[tuple] = []
        tokens = batch.column(2)
        for k, (host, source) in enumerate(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())):
            page = Page(source or "")
            if page.has_main:
                continue
            if host not in known:
                if len(known) > KNOWN_HOSTS:
                    known.clear()
                known[host] = _open_template(tokens[k])
            slots = page.slots(page.nested(known[host]))
            rows.append((host, 0, 0, max((chars for _, _, _, chars in slots.values()), default=0)))
            rows += [(host, _signed(slot), depth, chars) for slot, (depth, _, _, chars) in slots.items()]
        if rows:
            host, *numbers = zip(*rows)
            yield pa.RecordBatch.from_arrays([pa.array(host, pa.string()), *(pa.array(c, pa.int64()) for c in numbers)],
                                             ["host", "slot", "depth", "chars"])


def host_slots(with_template: DataFrame) -> DataFrame:
    """(host, slot): the deepest slot that most of the host's pages without a
    marked article have and that holds most of their text outside the template.
    Slots with most of the text lie in one another. From host, html, tokens."""
    slots = (with_template.select("host", "html", "tokens").mapInArrow(_page_slots, "host string, slot long, depth long, chars long")
             .groupBy("host", "slot").agg(F.count("*").alias("pages"), F.max("depth").alias("depth"), F.sum("chars").alias("chars")))
    slots = stored(slots, "html-slots")
    every = slots.where("slot = 0").select("host", F.col("pages").alias("all_pages"), F.col("chars").alias("all_chars"))
    return (slots.where("slot <> 0").join(every, "host")
            .where(f"all_pages >= {MIN_PAGES} and pages >= {MOST_PAGES} * all_pages and chars > {MOST_TEXT} * all_chars")
            .groupBy("host").agg(F.max_by("slot", F.struct("depth", "chars", "slot")).alias("slot")))


def extract_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """One row per page: page_id, url, text, n_chars."""
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"))
    counts = token_counts(rows)
    templates = stored(host_templates(rows, counts).groupBy("host").agg(F.collect_list(F.struct("token", "vector", "position", "pages", "common")).alias("tokens")), "html-templates")
    host = F.coalesce(F.lower(F.regexp_extract("url", r"^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#]*)", 1)), F.lit(""))
    with_host = rows.withColumn("host", host)
    size = templates.agg(F.sum(F.size("tokens"))).first()[0] or 0

    def by_host(left: DataFrame, right: DataFrame, how: str) -> DataFrame:
        if size <= BROADCAST_TOKENS:
            return left.join(F.broadcast(right), "host", how)
        return salted_join(left, right, ["host"], ["page_id", "url"], how)

    # Only hosts that have a template and pages without a marked article.
    pages_of = [F.sum(F.when(F.col("token") == k, F.col("pages")).otherwise(0)) for k in (0, 1)]
    unmarked = counts.where("token in (0, 1)").groupBy("host").agg((pages_of[0] - pages_of[1]).alias("n")).where(f"n >= {MIN_PAGES}")
    slots = host_slots(by_host(with_host, templates.join(unmarked.select("host"), "host"), "inner"))
    joined = by_host(with_host, stored(templates.join(slots, "host", "left"), "html-host-slots"), "left")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, Template] = {}
        for batch in batches:
            for i in range(0, len(batch), 64):
                part = batch.slice(i, 64)
                out, tokens, slots = [], part.column(4), part.column(5).to_pylist()
                for k, (host, source) in enumerate(zip(part.column(3).to_pylist(), part.column(2).to_pylist())):
                    if host not in known:
                        if len(known) > KNOWN_HOSTS:
                            known.clear()
                        known[host] = _open_template(tokens[k])
                    out.append(Page(source or "").text(known[host], None if slots[k] is None else slots[k] & (1 << 64) - 1))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(out, pa.string()), pa.array([len(t) for t in out], pa.int64())],
                    ["page_id", "url", "text", "n_chars"])

    return joined.select("page_id", "url", "html", "host", "tokens", "slot").mapInArrow(
        run, "page_id long, url string, text string, n_chars long")
