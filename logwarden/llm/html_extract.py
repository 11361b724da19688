"""Main text of web pages, with wrappers inferred per host as union-free regular expressions.

The wrapper of a host tells whether a page fits it (``fits``). The text itself is chosen by marks
(article, main), by names that set parts apart, and, on pages without a mark, by which texts are
constant on the host's different pages and in which region the others lie; see the README.
"""

from __future__ import annotations

import hashlib
import html
import json
import re
from collections import Counter
from difflib import SequenceMatcher

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logwarden.llm.common import pieces, strings
from logwarden.operators.durable import durable

#: Wrappers of one host that one task aligns with each other in a round.
ALIGNED = 64

#: A text is part of a host's template if at least so many different pages and so large a share of them hold it.
LEAST_PAGES, TEMPLATE_SHARE = 3, 0.5

#: The host's region of content is left for a part of it only if the rest holds less than this share of its texts.
STRAY_SHARE = 0.05

#: Articles beside the longest one, of the same kind, are part of the text if they hold this share of its length.
SIBLING_SHARE = 0.25

#: Wrappers are broadcast only up to this many characters; beyond it pages and wrappers are joined by host.
BROADCAST_CHARS = 48_000_000

#: Longest repeated stretch of tokens that is folded into a group.
PERIOD = 24

#: Fixed values of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript template iframe xmp noembed noframes".split())
BLOCK = frozenset("""address article aside blockquote body caption center dd details dialog dir div dl dt fieldset
    figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre
    section summary table tbody td tfoot th thead tr ul""".split())
#: A start tag of the key closes open elements of the value, up to the nearest container.
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
          "th": {"td", "th"}, "option": {"option"}, "thead": {"tbody"}, "tbody": {"thead", "tbody"}}
CLOSES_P = BLOCK - {"body", "html", "caption", "td", "th", "tr", "tbody", "thead", "tfoot", "legend", "summary"}
HOLDS = frozenset("ul ol dl table td th div section article main body select aside nav header footer form".split())

#: Elements and names that hold no main text.
APART = frozenset("""head script style noscript template title nav footer aside form button select option input textarea
    iframe svg canvas object embed dialog menu label fieldset audio video map""".split())
APART_NAMES = frozenset("""ad ads adv advert adverts advertisement advertising banner sponsor sponsored promo promotion
    sidebar menu nav navbar navigation breadcrumb breadcrumbs header masthead topbar footer comment comments reply
    replies respond discussion disqus notice notices cookie cookies consent gdpr popup modal overlay newsletter
    subscribe subscription signup login share sharing social related recommended recommendations widget widgets search
    toolbar pagination pager copyright skip teaser outbrain taboola alert""".split())
#: Words that may stand beside an APART name in one class or id: such a name is still that of a part set apart.
BESIDE = frozenset("""area bar block box button buttons container group inner item items left link links list main outer
    panel posts primary right secondary section site top bottom wrap wrapper""".split())
#: Words before an APART name that say what it belongs to; with a header it is the title of the article itself.
BELONGS = frozenset("article content entry page post".split())
TITLES = frozenset("header banner masthead".split())
#: Names of parts that hold texts of others, articles included.
FOREIGN = frozenset("""ad ads adv advert adverts advertisement advertising comment comments consent cookie cookies discussion
    disqus gdpr outbrain promo promotion recommended related replies reply respond sponsor sponsored taboola teaser""".split())
#: Elements that may be all of a page, so that they are read if nothing else is left.
MAY_HOLD_ALL = frozenset("form fieldset aside header dialog label".split())
APART_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert menu menubar".split())

#: Possessive, so that a tag that never ends costs no more than its length. A quote counts only after =.
TAG = re.compile(r"<!--.*?(?:-->|$)|<!\[CDATA\[.*?(?:\]\]>|$)|<[!?][^>]*(?:>|$)"
                 r"|</([a-zA-Z][^\s/>]*)[^>]*(?:>|$)"
                 r"|<([a-zA-Z][^\s/<>]*+)((?:=\s*+\"[^\"]*\"|=\s*+'[^']*'|[^<>])*+)>", re.S)
ATTRIBUTE = re.compile(r"([^\s=\"'<>/]+)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+))?")
NAME = re.compile(r"[a-z]+")
WHITE = re.compile(r"[\s​﻿]+")


class Block:
    """One block of text, the elements around it, as (element number, tag, names, apart, hidden), and whether it is apart.

    An element is apart by what it is (1) or only by its name (2).
    """

    __slots__ = ("text", "around", "apart")

    def __init__(self, text: str, around: tuple):
        self.text, self.around = text, around
        self.apart = any(e[3] for e in around)

    def path(self) -> str:
        return "/".join(f"{tag}.{'.'.join(sorted(names))}" if names else tag for _, tag, names, *_ in self.around)


def _apart_name(token: str) -> bool:
    """Whether a whole class or id names a part set apart: sidebar or site-header, not has-sidebar or article-header."""
    words = NAME.findall(token)
    apart = [w for w in words if w in APART_NAMES]
    others = {w for w in words if w not in APART_NAMES} - BESIDE
    return bool(apart) and (not others or others <= BELONGS and not TITLES & set(apart))


def _attributes(text: str) -> tuple[frozenset, bool, bool]:
    """Words of class and id, whether role or hidden sets the element apart, and whether its name does."""
    names, apart, named = set(), False, False
    for key, value in ATTRIBUTE.findall(text):
        key, value = key.lower(), value.strip("\"'").lower()
        if key in ("class", "id"):
            names.update(NAME.findall(value))
            named = named or any(_apart_name(token) for token in value.split())
        elif key == "role":
            apart |= value in APART_ROLES
            if value == "main":
                names.add("main")
        elif key == "hidden" or key == "aria-hidden" and value == "true":
            apart = True
    return frozenset(names), apart, named


def _free(blocks: list[Block]) -> None:
    """Takes back names that would set apart the page's article or most of its text, or else leave nothing.

    An article in a part that holds texts of others (FOREIGN) must be longer than all that is open.
    If no text is left, the largest region set apart is read, what only frames a page included.
    """
    if not any(b.apart for b in blocks):
        return
    total = opened = 0
    below: Counter = Counter()
    articles: Counter = Counter()
    above: dict[int, tuple] = {}
    foreign: set[int] = set()
    for b in blocks:
        if any(e[3] == 1 for e in b.around):
            continue
        size = len(b.text)
        total += size
        opened += size * (not b.apart)
        for k, e in enumerate(b.around):
            if e[3]:
                below[e[0]] += size
                if e[2] & FOREIGN:
                    foreign.add(e[0])
            elif e[1] in ("article", "main"):
                articles[e[0]] += size
                above.setdefault(e[0], tuple(x[0] for x in b.around[:k] if x[3]))
    freed = {k for k, size in below.items() if 2 * size > total and k not in foreign}
    if articles:
        most = max(articles, key=lambda k: (articles[k], -k))
        if not foreign & set(above[most]) or articles[most] > opened:
            freed.update(above[most])
    for b in blocks:
        if b.apart and not any(e[3] and e[0] not in freed for e in b.around):
            b.apart = False
    if all(b.apart for b in blocks):
        regions: Counter = Counter()
        for b in blocks:
            held = next(e for e in b.around if e[3])
            if all(e[3] != 1 or e[1] in MAY_HOLD_ALL and not e[4] for e in b.around):
                regions[held[3], held[0]] += len(b.text)
        if regions:
            best = max(regions, key=lambda k: (k[0], regions[k], -k[1]))[1]
            inside = [b for b in blocks if any(e[0] == best for e in b.around)
                      and all(e[3] != 1 or e[1] in MAY_HOLD_ALL and not e[4] for e in b.around)]
            for b in inside:
                b.apart = False


def parse(page: str) -> tuple[list[Block], list[str]]:
    """Blocks of a page in order, and its tokens: block tags with their names, # for text."""
    blocks: list[Block] = []
    tokens: list[str] = []
    stack: list[tuple] = []
    held: list[str] = []
    count = articles = 0

    def flush():
        text = WHITE.sub(" ", html.unescape("".join(held))).strip()
        held.clear()
        if text:
            blocks.append(Block(text, tuple(stack)))
            if not any(e[3] and e[1] in RAW for e in stack):
                tokens.append("#")

    def close(k: int):
        nonlocal articles
        while len(stack) > k:
            articles -= stack[-1][1] in ("article", "main")
            if stack[-1][1] in BLOCK:
                flush()
                tokens.append(f"/{stack[-1][1]}")
            stack.pop()

    at, size = 0, len(page)
    while at < size:
        m = TAG.search(page, at)
        if m is None:
            held.append(page[at:])
            break
        held.append(page[at:m.start()])
        at = m.end()
        end, start, rest = m[1], m[2], m[3]
        if end:
            tag = end.lower()
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][1] == tag:
                    close(k)
                    break
                if stack[k][1] in ("td", "th", "table", "article", "main", "body") and tag in ("p", "li", "span", "b", "i", "em", "a"):
                    break
            if tag in BLOCK:
                flush()
        elif start:
            tag = start.lower()
            if tag in RAW:
                stop = re.compile(rf"</{re.escape(tag)}\s*[^>]*>", re.I).search(page, at)
                at = stop.end() if stop else size
                if tag in BLOCK:
                    flush()
                continue
            names, hidden, named = _attributes(rest)
            if tag in BLOCK:
                flush()
            if tag in CLOSES_P:
                for k in range(len(stack) - 1, -1, -1):
                    if stack[k][1] == "p":
                        close(k)
                        break
                    if stack[k][1] in HOLDS:
                        break
            if tag in CLOSES:
                for k in range(len(stack) - 1, -1, -1):
                    if stack[k][1] in CLOSES[tag]:
                        close(k)
                    elif stack[k][1] in HOLDS:
                        break
            if tag == "br":
                held.append(" ")
            if tag not in VOID:
                count += 1
                apart = 1 if hidden or tag in APART or tag == "header" and not articles else 2 if (
                    tag not in ("html", "body", "article", "main") and named
                    or tag == "article" and names & {"comment", "comments", "reply", "teaser", "related"}) else 0
                stack.append((count, tag, names, apart, hidden))
                articles += tag in ("article", "main")
                if tag in BLOCK:
                    tokens.append(".".join([tag, *sorted(names)]))
    close(0)
    flush()
    _free(blocks)
    return blocks, tokens


def fold(tokens: list) -> list:
    """Adjacent repeats of a stretch of tokens as one group ("+", stretch), until nothing repeats."""
    out: list = []
    for token in tokens:
        out.append(token)
        again = True
        while again:
            again = False
            for p in range(1, min(PERIOD, len(out)) + 1):
                tail = out[-p:]
                before = out[-p - 1] if len(out) > p else None
                if isinstance(before, tuple) and before[0] == "+" and list(before[1]) == tail:
                    del out[-p:]
                    again = True
                    break
                if len(out) >= 2 * p and out[-2 * p:-p] == tail and (p > 1 or tail[0] == "#" or isinstance(tail[0], tuple)):
                    del out[-2 * p:]
                    out.append(("+", tuple(tail)))
                    again = True
                    break
    return out


def align(wrapper: list, page: list) -> list:
    """The wrapper generalised so that it also matches the page.

    Tokens that match stay. Where they do not, a stretch that is one round of a group on the other
    side is taken into that group; any other stretch becomes optional. Nothing becomes a choice.
    """
    out: list = []
    plain = [x[1] if isinstance(x, tuple) and x[0] == "?" else (x,) for x in wrapper]
    names = [repr(p) for p in plain]
    matcher = SequenceMatcher(None, names, [repr((x,)) for x in page], autojunk=False)
    for kind, a, b, c, d in matcher.get_opcodes():
        if kind == "equal":
            out += wrapper[a:b]
            continue
        ours, theirs = wrapper[a:b], page[c:d]
        group = next((x for x in (*ours, *theirs) if isinstance(x, tuple) and x[0] == "+"), None)
        others = [x for x in (*ours, *theirs) if x != group]
        if group is not None and others == list(group[1]):
            out.append(group)
            continue
        for x in ours:
            out.append(x if isinstance(x, tuple) and x[0] == "?" else ("?", (x,)))
        known = {repr(x) for x in ours}
        out += [("?", (x,)) for x in theirs if repr(("?", (x,))) not in known]
    return out


def matches_wrapper(wrapper: list, page: list) -> bool:
    """Whether the folded tokens of a page fit the wrapper: only optional parts may be missing, none may be left."""
    i = 0
    for node in wrapper:
        optional = isinstance(node, tuple) and node[0] == "?"
        want = node[1][0] if optional else node
        here = page[i] if i < len(page) else None
        if here is not None and here == want:
            i += 1
        elif isinstance(want, tuple) and want[0] == "+" and page[i:i + len(want[1])] == list(want[1]):
            i += len(want[1])
        elif not optional:
            return False
    return i == len(page)


def _thaw(x):
    return tuple(_thaw(y) for y in x) if isinstance(x, list) else x


def load_wrapper(text: str) -> list:
    return [_thaw(x) for x in json.loads(text)]


def merge_wrappers(wrappers: list[str]) -> str:
    """Align wrappers (as JSON) with each other, in the order of their text so that tasks agree."""
    merged: list = []
    for text in sorted(wrappers):
        nodes = load_wrapper(text)
        if not merged:
            merged = nodes
        else:
            bare = [y for x in nodes for y in (x[1] if isinstance(x, tuple) and x[0] == "?" else (x,))]
            merged = align(merged, bare)
    return json.dumps(merged)


def _text_key(text: str) -> int:
    import zlib
    data = text.encode("utf-8", "surrogatepass")
    return zlib.crc32(data) << 31 ^ zlib.adler32(data)


def host_of(url: str | None) -> str:
    m = re.match(r"\s*(?:[a-zA-Z][\w+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)", url or "")
    return m[1].lower() if m else ""


def learn_templates(pages: DataFrame) -> DataFrame:
    """One row per host: host, wrapper, template (keys of its constant texts), main_path.

    Every page counts. Pages give their folded tokens, the keys of their texts outside marked
    articles, and where their plain text stands; equal ones are summed up before anything is
    shuffled. Different token streams of a host are aligned in rounds of at most ALIGNED
    wrappers, so that a host with a third of all pages is many small tasks and then one.
    """
    def seen(batches):
        for batch in batches:
            for part in pieces(batch, "html"):
                counts: Counter = Counter()
                for url, page in zip(part.column("url").to_pylist(), strings(part.column("html"))):
                    host = host_of(url)
                    blocks, tokens = parse(page)
                    counts[host, "page", "", 0] += 1
                    counts[host, "shape", json.dumps(fold(tokens)), 0] += 1
                    if not _marked(blocks):
                        plain = [b for b in blocks if not _apart(b)]
                        digest = hashlib.sha256("\n".join(b.text for b in plain).encode("utf-8", "surrogatepass")).hexdigest()
                        counts[host, "different", digest, 0] = 1  # copies of a page are one page
                        for key in {_text_key(b.text) for b in plain}:
                            counts[host, "text", digest, key] = 1
                        for b in plain:
                            counts[host, "path", _container(b), _text_key(b.text)] = 1
                keys = list(counts)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([k[i] for k in keys], t) for i, t in enumerate((pa.string(), pa.string(), pa.string(), pa.int64()))]
                    + [pa.array(counts.values(), pa.int64())], ["host", "kind", "value", "key", "n"])

    facts = durable(pages.select("url", "html").mapInArrow(
        seen, "host string, kind string, value string, key long, n long").groupBy("host", "kind", "value", "key").agg(
        F.sum("n").alias("n")), "html-facts")
    hosts = facts.where("kind = 'page'").select("host", F.col("n").alias("pages"))
    different = facts.where("kind = 'different'").groupBy("host").agg(F.count(F.lit(1)).alias("different"))
    held = facts.where("kind = 'text'").groupBy("host", "key").agg(F.count(F.lit(1)).alias("n"))
    common = held.join(different, "host").where(
        (F.col("n") >= LEAST_PAGES) & (F.col("n") >= TEMPLATE_SHARE * F.col("different"))).select("host", "key")
    template = common.groupBy("host").agg(F.sort_array(F.collect_list("key")).alias("template"))
    # each different text of a place counts once, texts of the template not at all; a host has few places
    places = facts.where("kind = 'path'").join(common, ["host", "key"], "left_anti").groupBy("host", "value").agg(
        F.count(F.lit(1)).alias("size"))
    place = places.groupBy("host").agg(F.collect_list(F.struct("value", "size")).alias("places")).select(
        "host", F.udf(region, "string", useArrow=False)("places").alias("main_path"))

    def aligned(group: pa.Table) -> pa.Table:
        return pa.table({"host": group.column("host").slice(0, 1),
                         "value": pa.array([merge_wrappers(group.column("value").to_pylist())])})

    wrappers = facts.where("kind = 'shape'").select("host", "value")
    while True:
        sizes = wrappers.groupBy("host").agg(F.count(F.lit(1)).alias("n"))
        most = sizes.agg(F.max("n")).first()[0] or 0
        if most <= 1:
            break
        wrappers = durable(wrappers.join(sizes, "host").withColumn(
            "part", F.pmod(F.xxhash64("value"), F.greatest(F.lit(1), F.ceil(F.col("n") / ALIGNED)))).groupBy(
            "host", "part").applyInArrow(aligned, "host string, value string"), "html-wrappers")
    return hosts.join(wrappers, "host", "left").join(template, "host", "left").join(place, "host", "left").select(
        "host", F.coalesce("value", F.lit("[]")).alias("wrapper"), F.coalesce("template", F.array().cast("array<long>")).alias("template"),
        F.coalesce("main_path", F.lit("")).alias("main_path"))


def region(places: list[tuple[str, int]]) -> str:
    """Path of the smallest part that holds a host's content: from the top down, a part is entered only
    if hardly any text (STRAY_SHARE) lies beside it."""
    total, path = sum(size for _, size in places), ""
    while True:
        inside: Counter = Counter()
        for value, size in places:
            if not path or value == path or value.startswith(path + "/"):
                rest = value[len(path) + 1:] if path else value
                if rest:
                    inside[rest.split("/")[0]] += size
        best = max(inside, key=lambda k: (inside[k], k), default=None)
        if best is None or inside[best] < (1 - STRAY_SHARE) * total:
            return path
        path = f"{path}/{best}" if path else best


def _apart(block: Block) -> bool:
    return block.apart


def _container(block: Block) -> str:
    """Path of the element that a block's own element lies in."""
    around = [e for e in block.around if e[1] in BLOCK]
    inner = around[:-1] if around and around[-1][1] not in HOLDS else around
    return "/".join(".".join([tag, *sorted(names)]) for _, tag, names, *_ in inner)


def _marked(blocks: list[Block]) -> frozenset[int]:
    """Numbers of the article (or else main) elements that are the text; none without a mark.

    That is the one with the most text that is not apart, and those beside it in the same element
    with the same names that hold at least SIBLING_SHARE of its length.
    """
    for wanted in (lambda e: e[1] == "article", lambda e: e[1] == "main" or "main" in e[2] and e[1] not in ("html", "body")):
        sizes: Counter = Counter()
        kinds: dict[int, tuple] = {}
        for b in blocks:
            if not _apart(b):
                k = next((k for k, e in enumerate(b.around) if wanted(e)), None)
                if k is not None:
                    root = b.around[k]
                    sizes[root[0]] += len(b.text)
                    kinds[root[0]] = (b.around[k - 1][0] if k else 0, root[1], root[2])
        if sizes:
            best = max(sizes, key=lambda k: (sizes[k], -k))
            return frozenset(k for k in sizes if kinds[k] == kinds[best] and sizes[k] >= SIBLING_SHARE * sizes[best])
    return frozenset()


def main_text(blocks: list[Block], template: frozenset = frozenset(), main_path: str = "") -> str:
    """Blocks of the page's main text, joined by an empty line.

    Marked articles are taken whole but for the parts set apart. Elsewhere texts that are the same
    on most different pages of the host are template, and all others that lie in the host's region
    of content are the text.
    """
    roots = _marked(blocks)
    plain = [b for b in blocks if not _apart(b)]
    if roots:
        return "\n\n".join(b.text for b in plain if any(e[0] in roots for e in b.around))
    slots = [b for b in plain if _text_key(b.text) not in template] or plain
    inside = [b for b in slots if main_path and (_container(b) + "/").startswith(main_path + "/")]
    return "\n\n".join(b.text for b in (inside or slots))


def extract_pages(pages: DataFrame) -> DataFrame:
    """One row per page: page_id, url, text, n_chars, fits (the page fits its host's wrapper).

    Null or empty html gives the empty text. A missing or odd url belongs to the host "". Pages
    without markup are one block. Repeated rows give repeated rows; an empty table gives no rows;
    other columns are ignored. Nothing of the main text is cut, however long the page.
    """
    learnt = durable(learn_templates(pages).select("host", "wrapper", "template", "main_path"), "html-templates")
    size = learnt.agg(F.sum(F.length("host") + F.length("main_path") + F.length("wrapper") + 20 * F.size("template") + 40)).first()[0] or 0
    read = pages.select(
        F.col("page_id").cast("long").alias("page_id"), "url", "html",
        F.lower(F.regexp_extract(F.coalesce("url", F.lit("")), r"^\s*(?:[a-zA-Z][\w+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)", 1)).alias("host"))
    joined = read.join(F.broadcast(learnt) if size <= BROADCAST_CHARS else learnt, "host", "left")

    def extracted(batches):
        for batch in batches:
            for part in pieces(batch, "html"):
                known: dict = {}
                texts, fits = [], []
                for host, page, wrapper, template, path in zip(
                        part.column("host").to_pylist(), strings(part.column("html")), part.column("wrapper").to_pylist(),
                        part.column("template").to_pylist(), part.column("main_path").to_pylist()):
                    if host not in known:
                        known[host] = frozenset(template or ()), load_wrapper(wrapper or "[]")
                    blocks, tokens = parse(page)
                    texts.append(main_text(blocks, known[host][0], path or ""))
                    fits.append(matches_wrapper(known[host][1], fold(tokens)))
                yield pa.RecordBatch.from_arrays(
                    [part.column("page_id"), part.column("url"), pa.array(texts, pa.string()),
                     pa.array([len(t) for t in texts], pa.int64()), pa.array(fits, pa.bool_())],
                    ["page_id", "url", "text", "n_chars", "fits"])

    return joined.select("page_id", "url", "html", "host", "wrapper", "template", "main_path").mapInArrow(
        extracted, "page_id long, url string, text string, n_chars long, fits boolean")
