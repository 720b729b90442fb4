"""HTML extraction by equivalence-class template deduction.

Every page is cut into tokens: tags with the path of containers they stand in, and words
with that path; inside an article or main element, where any word may come again by chance, a
word's role is told by its whole line, so a line (a text between two tags) is one token that
weighs as many as its words. Tokens of a host's pages whose occurrence vectors (how often in which page)
are equal form a class. Large, frequent classes nest into the host's template: the largest is
its frame, and another belongs to it if all its tokens stand in one gap of the frame. On a
page, a class counts if it is valid there: its tokens keep the host's order. What lies between
template tokens are slots.
Slots inside menus, headers, footers, sidebars, notices, adverts, forms, scripts, styles and
comments (by element, or by a class, id or role made of such names and of words for place and
layout alone) are boilerplate, as is text made of
template words alone and, inside an article or main element, a line that is a template token.
The remaining slots, in page order, are the main text; where a page has an article or main
element, those inside it.

Occurrence vectors are compared by 64-bit sums of (page, count) hashes, so a class is a
group-by with map-side combining: no host's pages meet in one task. The template is sent to
the extraction as 64-bit token keys when it has at most ``max_broadcast`` tokens in
all, else by a join on the host.

Defined results: null or empty html gives an empty text; pages without a usable URL share
the host ''; hosts with fewer than ``min_pages`` pages have no template; unclosed elements end
with the page; a ``>`` in a quoted attribute doesn't end a tag, a quote that is never closed
doesn't count; where all text stands in forms, headers or elements with a name that may
hold an article (``legal``), the one that holds most words is the main text; very long and very deep
pages take memory in proportion to their length; repeated rows are extracted one by one, rows
with a null page_id or url like any others; other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import html as entities
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written

RAW = "script|style|textarea|title|iframe|noscript|template|svg|xmp|noembed|noframes"
ATTRIBUTES = r"""(?:[^>=]|=\s*(?:"[^"]*"|'[^']*')?)*+"""
PART = re.compile(rf"<!--.*?(?:-->|\Z)|<({RAW})\b{ATTRIBUTES}>.*?(?:</\1\s*>|\Z)|<(/?)([a-zA-Z][^\s/>]*)({ATTRIBUTES})>|"
                  r"<[!?/][^>]*>|<(?=[a-zA-Z])[^>]*\Z|[^<]+|<", re.S | re.I)
CONTAINERS = {"html", "body", "div", "section", "article", "main", "nav", "header", "footer", "aside", "form", "ul", "ol",
              "dl", "table", "figure", "fieldset", "details", "dialog", "head", "menu", "blockquote", "center"}
BOILERPLATE = {"head", "nav", "footer", "aside", "form", "menu", "dialog", "button", "select", "option", "label", "object"}
VOID = {"br", "hr", "img", "input", "meta", "link", "area", "base", "col", "embed", "source", "track", "wbr"}
INLINE = {"a", "abbr", "acronym", "b", "bdi", "bdo", "big", "cite", "code", "del", "dfn", "em", "font", "i", "ins", "kbd", "mark",
          "q", "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time", "tt", "u", "var", "wbr", "nobr"}
NAMES = {"nav", "navbar", "navigation", "menu", "header", "masthead", "footer", "sidebar", "side", "banner", "ad", "ads", "advert",
         "adverts", "advertisement", "sponsor", "sponsored", "promo", "promotion", "cookie", "cookies", "consent", "gdpr", "notice",
         "notices", "alert", "popup", "modal", "overlay", "newsletter", "subscribe", "signup", "login", "share", "sharing", "social",
         "comment", "comments", "disqus", "reply", "replies", "breadcrumb", "breadcrumbs", "pagination", "pager", "related",
         "recommended", "widget", "toolbar", "search", "copyright", "legal", "disclaimer", "contentinfo", "complementary"}
# names of what readers and advertisers put on a page, known beside more words than the others
GUESTS = {"ad", "ads", "advert", "adverts", "advertisement", "sponsor", "sponsored", "promo", "comment", "comments", "commentlist",
          "disqus", "reply", "replies", "related", "recommended"}
PLACES = {"site", "page", "main", "primary", "secondary", "global", "mobile", "desktop", "top", "bottom", "left", "right", "upper",
          "lower", "sticky", "fixed", "floating", "user", "area", "bar", "block", "box", "container", "list", "panel", "section", "slot",
          "thread", "unit", "wrap", "wrapper", "zone", "links", "buttons", "button", "icons", "row", "inner", "outer"}
GUEST_PLACES = PLACES | {"article", "articles", "author", "blog", "body", "content", "count", "entry", "form", "item", "items", "label",
                         "meta", "post", "posts", "reader", "readers", "respond", "stories", "story", "text", "title"}
# names that a page's only text may stand in
MAY_HOLD = {"legal", "disclaimer", "copyright", "notice", "notices", "header", "search", "widget", "side", "modal", "overlay", "alert"}
MARK = re.compile(r"""(?<![\w:-])(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
WORDS = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+")
MAIN = {"article", "main"}
M64 = (1 << 64) - 1


def marked(attributes: str) -> str:
    """The class, id and role words of a start tag."""
    return " ".join(a or b or c for a, b, c in MARK.findall(attributes)) if "=" in attributes else ""


def named(mark: str, main: bool) -> set[str]:
    """The boilerplate names of the classes, id and role that are made of such names alone or of
    them and words for place and layout (cookie-notice, comment-list, adSlot, not has-sidebar);
    what an article calls its header is its own."""
    known = NAMES - {"header"} if main else NAMES
    found: set[str] = set()
    for t in mark.split():
        w = {x.lower() for x in WORDS.findall(t)}
        own = w & (known | GUESTS)
        if own and w - own <= (GUEST_PLACES if own & GUESTS else PLACES):
            found |= own
    return found


def steps_of(html: str) -> list:
    """The steps of ``walk``, where no element cut by its name, nor a form or header, holds the
    page's main element or, if all its articles stand in such elements and hold more words
    than the live text outside, its articles. Where no live text is left at all, the outermost
    form, header or element of a name in ``MAY_HOLD`` with most words isn't cut either."""
    held: list[tuple[str, frozenset]] = []
    words: Counter = Counter()
    steps = list(walk(html, held=held, words=words))
    if held:
        sure = frozenset().union(*[at for name, at in held if name == "main"])
        if sure:
            return list(walk(html, sure))
        if any(main and not out for _, _, _, out, main in steps):
            return steps
        size = lambda ss, inside: sum(len(v.split()) for kind, _, v, out, main in ss
                                      if kind == "x" and not out and main == inside)
        lifted = list(walk(html, frozenset().union(*[at for _, at in held])))
        return lifted if size(lifted, True) > size(steps, False) else steps
    if words and not any(kind == "x" and not out and value.strip() for kind, _, value, out, _ in steps):
        most = max(words, key=lambda at: (words[at], -at))
        return list(walk(html, frozenset([most])))
    return steps


def walk(html: str, lifted: frozenset = frozenset(), held: list | None = None, words: Counter | None = None):
    """(kind, path, value, out, main) of every tag and text: kind t(ag) or x (text), the digest of
    the path of open containers, whether it is boilerplate, and whether it is inside an article
    or main element. Tags come with their name. Elements that start at a place in ``lifted`` are not
    cut by their name; ``held`` gathers the articles and main elements that stand only in
    elements so cut, with the places of these; ``words`` counts the words that one cut alone
    takes away, by the place of that cut, if its name may hold a page's text."""
    stack: list[tuple[str, str, bool, bool]] = []    # name, path, boilerplate, main
    cuts: list[int | None] = []                        # start of a cut by name, -1 of another, beside the stack
    takes: list[int | None] = [None]                   # the only cut that takes the text here away, -1 if more or other
    live: Counter = Counter()                          # open elements by name
    path, out, main = "", False, False
    for m in PART.finditer(html):
        name = m[3]
        if name is None:
            s = m[0]
            if s[0] != "<" or s == "<":
                if words is not None and (takes[-1] or -1) >= 0 and not s.isspace():
                    words[takes[-1]] += len(s.split())
                yield "x", path, s, out, main
            elif m[1]:                                # a raw element breaks nothing but holds no text
                yield "t", path, m[1].lower(), out, main
            continue
        name = name.lower()
        if m[2]:
            while live[name]:                          # what is open inside it ends with it
                last = stack.pop()[0]
                cuts.pop(), takes.pop()
                live[last] -= 1
                path, out, main = stack[-1][1:] if stack else ("", False, False)
                if last == name:
                    break
            yield "t", path, "/" + name, out, main
            continue
        if stack and stack[-1][0] == "p" and name not in INLINE and name not in VOID:
            stack.pop(), cuts.pop(), takes.pop()      # a block ends an open paragraph
            live["p"] -= 1
            path, out, main = stack[-1][1:] if stack else ("", False, False)
        mark = marked(m[4])
        yield "t", path, name + ("." + mark if mark else ""), out, main
        hard = name in BOILERPLATE and name != "form"
        names = named(mark, main) if mark else set()
        soft = m.start() not in lifted and (name == "form" or (name == "header" and not main) or bool(names))
        bad = hard or soft
        if name not in VOID and (name in CONTAINERS or bad) and not m[4].endswith("/"):
            if name in ("html", "body"):
                bad = False
            path = xxhash.xxh64_hexdigest(f"{path}/{name}.{mark}".encode("utf-8", "replace"))
            cuts.append(None if not bad else -1 if hard else m.start())
            if held is not None and name in MAIN and (out or bad) and -1 not in cuts:
                held.append((name, frozenset(c for c in cuts if c is not None)))
            takes.append(takes[-1] if not bad else -1 if hard or out or not names <= MAY_HOLD else m.start())
            out, main = out or bad, main or (name in MAIN and not out and not bad)
            stack.append((name, path, out, main))
            live[name] += 1


def host(url) -> object:
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))


def key(where: str, token: str) -> int:
    return xxhash.xxh64_intdigest(f"{where}\0{token}".encode("utf-8", "replace"))


def text_tokens(path: str, value: str, main: bool) -> list[str]:
    """The tokens of a text: its words, or inside an article or main element its line."""
    ws = value.split()
    return [f"{path}>{w}" for w in ws] if not main else [f"{path}={' '.join(ws)}"] if ws else []


def tokens(where: str, steps: list):
    """(key, count, first place, weight) of the page's tokens."""
    seen: dict[str, tuple[int, int]] = {}
    count: Counter = Counter()
    for n, (kind, path, value, out, main) in enumerate(steps):
        if kind == "t":
            items, weight = [f"{path}<{value}"], 1
        else:
            items = text_tokens(path, value, main)
            weight = len(value.split()) if main else 1
        for t in items:
            seen.setdefault(t, (n, weight))
        count.update(items)
    return [(key(where, t), c, *seen[t]) for t, c in count.items()]


def templates(pages: DataFrame, min_pages: int = 4, support: float = 0.9, min_class: int = 3) -> DataFrame:
    """(host, token, cls, place): the template tokens of every host, their class and their mean
    place on a page."""
    def occurrences(batches):
        for b in batches:
            at: dict[tuple[str, int], list] = {}
            for h, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                if not text:
                    continue
                page = xxhash.xxh64_intdigest(text.encode("utf-8", "replace"))
                for t, c, first, weight in [*tokens(h, steps_of(text)), (0, 1, 0, 1)]:      # token 0 counts the host's pages
                    mixed = ((page ^ (c * 0x9E3779B97F4A7C15)) * 0xC2B2AE3D27D4EB4F) & M64
                    r = at.setdefault((h, t), [0, 0, page, page, 0, weight])
                    r[0] += 1
                    r[1] = (r[1] + (mixed ^ (mixed >> 31))) & M64
                    r[2], r[3] = min(r[2], page), max(r[3], page)
                    r[4] += first
            if at:
                u = lambda k: pa.array(np.array([r[k] for r in at.values()], np.uint64).view(np.int64))
                yield pa.RecordBatch.from_pydict({
                    "host": pa.array([k[0] for k in at], pa.string()),
                    "token": pa.array(np.array([k[1] for k in at], np.uint64).view(np.int64)),
                    "n": pa.array([r[0] for r in at.values()], pa.int64()), "sig": u(1), "low": u(2), "high": u(3),
                    "place": pa.array([r[4] for r in at.values()], pa.int64()),
                    "weight": pa.array([r[5] for r in at.values()], pa.int64())})

    # sums of signatures wrap around: split so that ANSI addition can't overflow
    occ = pages.select(host(F.col("url")).alias("host"), "html").mapInArrow(
        occurrences, "host string, token long, n long, sig long, low long, high long, place long, weight long")
    occ = occ.groupBy("host", "token").agg(
        F.sum("n").alias("n"), F.sum(F.col("sig").bitwiseAND(F.lit(0xFFFFFFFF))).alias("s0"),
        F.sum(F.shiftrightunsigned("sig", 32)).alias("s1"),
        F.min("low").alias("low"), F.max("high").alias("high"), F.sum("place").alias("place"),
        F.max("weight").alias("weight"))
    occ = occ.withColumn("sig", F.xxhash64((F.col("s0") + F.col("s1") % (1 << 31) * (1 << 31)) , "s1"))
    # read several times below, so that the pages are cut once; rarer tokens can't be frequent
    occ = written(occ.where((F.col("token") == 0) | (F.col("n") >= support * min_pages)), "page-tokens")
    total = occ.where("token = 0").select(F.col("host").alias("_h"), F.col("n").alias("pages"))
    frequent = (occ.where("token != 0 and low != high").join(total, F.col("host") == F.col("_h"))
                .where((F.col("pages") >= min_pages) & (F.col("n") >= support * F.col("pages"))))
    large = frequent.groupBy(F.col("host").alias("_h2"), F.col("sig").alias("_s2")).agg(
        F.sum("weight").alias("members")).where(F.col("members") >= min_class)
    members = frequent.join(large, (F.col("host") == F.col("_h2")) & (F.col("sig") == F.col("_s2"))).select(
        "host", "token", F.col("sig").alias("cls"), (F.col("place") / F.col("n")).alias("place"), "members")
    top = members.groupBy("host").agg(F.max(F.struct("members", "cls")).alias("t")).select(
        F.col("host").alias("_th"), F.col("t.cls").alias("top"))
    members = members.join(top, F.col("host") == F.col("_th")).drop("_th", "members")
    frame = members.where("cls = top").groupBy(F.col("host").alias("_fh")).agg(
        F.sort_array(F.collect_list("place")).alias("frame"))     # one class's tokens
    gap = F.size(F.filter("frame", lambda x: x < F.col("place")))
    nested = (members.join(frame, F.col("host") == F.col("_fh")).withColumn("gap", gap)
              .groupBy(F.col("host").alias("_nh"), F.col("cls").alias("_nc"))
              .agg(F.min("gap").alias("g0"), F.max("gap").alias("g1"), F.max(F.col("cls") == F.col("top")).alias("is_top"))
              .where("is_top or g0 = g1").select("_nh", "_nc"))
    return members.join(nested, (F.col("host") == F.col("_nh")) & (F.col("cls") == F.col("_nc")), "left_semi").select(
        "host", "token", "cls", "place")


def valid_here(where: str, steps: list, template: dict) -> set[int]:
    """The template tokens whose class keeps its order on this page."""
    places: dict[int, list] = {}
    for t, _, first, _ in tokens(where, steps):
        if t in template:
            cls, place = template[t]
            places.setdefault(cls, []).append((place, first, t))
    good = set()
    for seen in places.values():
        seen.sort()
        if all(a[1] <= b[1] for a, b in zip(seen, seen[1:])):
            good.update(t for _, _, t in seen)
    return good


def main_text(where: str, html: str, template: dict) -> str:
    """The page's main text under its host's template (token: class and place)."""
    parts, any_main, steps = [], False, steps_of(html)
    for kind, path, value, out, main in steps:
        any_main |= main
        if kind == "t":
            if value.lstrip("/").split(".")[0] not in INLINE:
                parts.append((" ", path, True))
        elif not out:
            parts.append((value, path, main))
    if template:
        fixed = valid_here(where, steps, template)
        parts = [(v, path, main) for v, path, main in parts if not v.strip() or (any_main and not main)
                 or not all(key(where, t) in fixed for t in text_tokens(path, v, main))]
    text = "".join(v for v, _, main in parts if main or not any_main)
    return " ".join(entities.unescape(text).split())


def entry(token: np.ndarray, cls: np.ndarray, place: np.ndarray) -> dict:
    return dict(zip(token.view(np.uint64).tolist(), zip(cls.tolist(), place.tolist())))


def extract(pages: DataFrame, max_broadcast: int = 200_000, **params) -> DataFrame:
    """(page_id, url, text)."""
    spark = pages.sparkSession
    tpl = written(templates(pages, **params), "page-templates")
    fields = "page_id long, url string, text string"
    d = pages.select(F.col("page_id").cast("long"), "url", host(F.col("url")).alias("host"), "html")

    def rows(b: pa.RecordBatch, template) -> pa.RecordBatch:
        out = [main_text(h, x, template(i)) if x else "" for i, (h, x) in
               enumerate(zip(b.column(2).to_pylist(), b.column(3).to_pylist()))]
        return pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(out, pa.string())], ["page_id", "url", "text"])

    if tpl.count() <= max_broadcast:
        known = tpl.select("token", "cls", "place").toArrow()
        shared = spark.sparkContext.broadcast([known.column(k).to_numpy() for k in range(3)])

        def with_all(batches):
            every = entry(*shared.value)              # keys hold the host
            for b in batches:
                yield rows(b, lambda i: every)
        return d.mapInArrow(with_all, fields)

    own = tpl.groupBy(F.col("host").alias("_h")).agg(
        F.collect_list("token").alias("tokens"), F.collect_list("cls").alias("classes"), F.collect_list("place").alias("places"))

    def with_own(batches):
        for b in batches:
            own = [b.column(k).to_pylist() for k in (4, 5, 6)]
            yield rows(b, lambda i: entry(*(np.array(x[i] or [], k) for x, k in zip(own, (np.int64, np.int64, float)))))
    return d.join(own, F.col("host") == F.col("_h"), "left").select(
        "page_id", "url", "host", "html", "tokens", "classes", "places").mapInArrow(with_own, fields)


def op6_pages(spark, sf_dir):
    pages = spark.read.parquet(f"{sf_dir.rstrip('/')}/pages.parquet")
    return extract(pages).withColumn("n_chars", F.length("text").cast("long"))
